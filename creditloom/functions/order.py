"""Exact order statistics without gathering a group in one task.

Three ideas carry all of it:

* hash order: rows are ranked by ``md5(seed|key)``. A histogram over the first
  hex digits, whose size is bounded, locates any rank; only rows of the few
  histogram cells that hold a wanted rank are looked at one by one.
* value order: boundaries from a quantile sketch cut the values into cells of
  bounded share. Sums inside a cell run in parallel, and each cell starts from
  the total of the cells before it. The sketch decides the balance of the work,
  never the result.
* radix order: the bits of a double, made to sort like the number, are settled from
  the highest down; every pass counts the next digit of the values that share the
  bits found so far.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .lookup import fitted

HASH_DIGITS = 4
SKETCH_ACCURACY = 10_000
DIGIT_BITS = 16


def key_hash(key: str, seed: int | str) -> Column:
    """Order of a row that depends on its key and the seed only."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string")))


def hash_rank_cuts(df: DataFrame, key: str, strata: list[str], seed: int | str, ranks: dict[str, str]) -> DataFrame:
    """The (hash, key) found at given ranks of the hash order of every stratum.

    ``ranks`` maps a cut name to an expression over ``n``, the stratum's row
    count. Returns one row per stratum and cut with rank >= 1: ``cut``,
    ``cut_hash``, ``cut_key``. Strata that are NULL form their own group.
    """
    rows = df.select(*strata, F.col(key).alias("k"), key_hash(key, seed).alias("h"))
    rows = rows.withColumn("cell", F.substring("h", 1, HASH_DIGITS))

    # At most 16**HASH_DIGITS cells per stratum.
    upto = W.partitionBy(*strata).orderBy("cell").rowsBetween(W.unboundedPreceding, 0)
    whole = W.partitionBy(*strata)
    cells = (rows.groupBy(*strata, "cell").agg(F.count("*").alias("rows_in_cell"))
             .withColumn("through", F.sum("rows_in_cell").over(upto))
             .withColumn("n", F.sum("rows_in_cell").over(whole)))
    wanted = F.array(*[F.struct(F.lit(c).alias("cut"), F.expr(f"CAST({r} AS BIGINT)").alias("rank"))
                       for c, r in ranks.items()])
    holding = (cells.withColumn("w", F.explode(wanted)).select("*", "w.*")
               .where("rank > through - rows_in_cell AND rank <= through")
               .select(*[F.col(s).alias(f"__{s}") for s in strata], F.col("cell").alias("__cell"), "cut",
                       F.expr("rank - (through - rows_in_cell)").alias("local_rank")))

    # Only the cells holding a cut are ranked row by row; equal keys are one entry with a count.
    holding, pinned = fitted(holding)
    same = [F.col(s).eqNullSafe(F.col(f"__{s}")) for s in strata] + [F.col("cell") == F.col("__cell")]
    candidates = rows.join(F.broadcast(holding) if pinned else holding, same)
    entries = candidates.groupBy(*strata, "cut", "local_rank", "h", "k").agg(F.count("*").alias("copies"))
    running = W.partitionBy(*strata, "cut").orderBy("h", "k").rowsBetween(W.unboundedPreceding, 0)
    reached = entries.withColumn("through", F.sum("copies").over(running))
    at_rank = reached.where("local_rank > through - copies AND local_rank <= through")
    return at_rank.select(*strata, "cut", F.col("h").alias("cut_hash"), F.col("k").alias("cut_key"))


def hash_places(df: DataFrame, key: str, seed: int | str, rows_per_cell: int = 50_000) -> DataFrame:
    """Adds ``place``, the position 1..n of a row in hash order of its key.

    Rows are counted in cells of their first hash digits, whose number follows
    from the row count, and every cell starts after the rows of the cells before.
    """
    rows = df.withColumn("__h", key_hash(key, seed))
    digits = 1
    n = rows.count()
    while 16 ** digits * rows_per_cell < n:
        digits += 1
    rows = rows.withColumn("__cell", F.substring("__h", 1, digits))
    before = W.orderBy("__cell").rowsBetween(W.unboundedPreceding, -1)
    starts = rows.groupBy("__cell").agg(F.count("*").alias("__n")).select(
        "__cell", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    inside = F.row_number().over(W.partitionBy("__cell").orderBy("__h", key))
    return rows.withColumn("place", inside).join(starts, "__cell").withColumn(
        "place", F.col("place") + F.col("__start")).drop("__h", "__cell", "__start")


def quantile_edges(df: DataFrame, col: str, cells: int) -> list[float]:
    """Distinct boundaries that cut ``col`` into about ``cells`` equally heavy cells."""
    points = [i / cells for i in range(1, cells)]
    found = df.agg(F.percentile_approx(col, points, SKETCH_ACCURACY)).first()[0]
    return sorted(set(found or []))


def with_cells(df: DataFrame, col: str, edges: list[float], name: str = "cell") -> DataFrame:
    """Number of the cell a value falls in, by binary search over the edges."""
    if not edges:
        return df.withColumn(name, F.lit(0.0))
    splits = [float("-inf"), *edges, float("inf")]
    return Bucketizer(splits=splits, inputCol=col, outputCol=name, handleInvalid="keep").transform(df)


def default_cells(df: DataFrame) -> int:
    """Four cells per shuffle partition, within the sketch's resolution."""
    return min(2_000, 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def running_totals(df: DataFrame, order: str, sums: list[str], by: list[str] = (), edges: list[float] | None = None,
                   last: list[str] = ()) -> DataFrame:
    """Cumulative sums in ascending ``order``, per group ``by``.

    Adds ``<s>_through`` (rows up to and including this one) and ``<s>_total``
    for every column in ``sums``, and ``prev_<c>``, the value of the row before,
    for every column in ``last``. ``order`` must be unique within a group.
    """
    by = list(by)
    if edges is None:
        edges = quantile_edges(df, order, default_cells(df))
    rows = with_cells(df, order, edges)

    before = W.partitionBy(*by).orderBy("cell").rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy(*by)
    following = W.partitionBy(*by).orderBy("cell")
    totals = rows.groupBy(*by, "cell").agg(
        *[F.sum(s).alias(f"{s}_cell") for s in sums],
        *[F.max_by(c, order).alias(f"{c}_at_end") for c in last])
    offsets = totals.select(
        *by, "cell",
        *[F.coalesce(F.sum(f"{s}_cell").over(before), F.lit(0)).alias(f"{s}_before") for s in sums],
        *[F.sum(f"{s}_cell").over(whole).alias(f"{s}_total") for s in sums],
        *[F.lag(f"{c}_at_end").over(following).alias(f"{c}_carried") for c in last])

    inside = W.partitionBy(*by, "cell").orderBy(order)
    upto = inside.rowsBetween(W.unboundedPreceding, 0)
    local = rows.withColumns(
        {f"{s}_local": F.sum(s).over(upto) for s in sums} | {f"prev_{c}": F.lag(c).over(inside) for c in last})
    joined = local.join(offsets, [*by, "cell"])
    return joined.select(
        *df.columns,
        *[(F.col(f"{s}_before") + F.col(f"{s}_local")).alias(f"{s}_through") for s in sums],
        *[f"{s}_total" for s in sums],
        *[F.coalesce(f"prev_{c}", f"{c}_carried").alias(f"prev_{c}") for c in last])


def _ordered_bits(x: np.ndarray) -> np.ndarray:
    """Doubles as unsigned numbers of the same order; -0 and 0 are one, NaN is above all."""
    bits = (x + 0.0).view(np.int64)
    return np.where(bits < 0, ~bits, bits ^ np.int64(-1 << 63)).view(np.uint64)


def _from_ordered_bits(key: int) -> float:
    bits = np.array([key], np.uint64).view(np.int64)
    return float(np.where(bits < 0, bits ^ np.int64(-1 << 63), ~bits).view(np.float64)[0])


def _digit_counts(df: DataFrame, prefixes: dict[str, list[int]], level: int) -> DataFrame:
    """``name, prefix, digit, n``: how often each next digit follows the wanted prefixes of each column; counted per task first."""
    names = list(prefixes)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = {(c, p): np.zeros(1 << DIGIT_BITS, np.int64) for c in names for p in prefixes[c]}
        for batch in batches:
            for i, c in enumerate(names):
                key = _ordered_bits(batch.column(i).drop_null().to_numpy(zero_copy_only=False).astype(np.float64))
                digit = (key >> np.uint64(64 - DIGIT_BITS * (level + 1))).astype(np.int64) & ((1 << DIGIT_BITS) - 1)
                for p in prefixes[c]:
                    own = digit if not level else digit[key >> np.uint64(64 - DIGIT_BITS * level) == np.uint64(p)]
                    totals[c, p] += np.bincount(own, minlength=1 << DIGIT_BITS)
        for (c, p), total in totals.items():
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([c] * len(used), pa.string()), pa.array([p] * len(used), pa.int64()),
                                              pa.array(used), pa.array(total[used])], names=["name", "prefix", "digit", "n"])

    doubles = df.select(*[F.expr(f"CAST(`{c}` AS DOUBLE)").alias(c) for c in names])
    found = doubles.mapInArrow(count, "name string, prefix long, digit long, n long")
    return found.groupBy("name", "prefix", "digit").agg(F.sum("n").alias("n"))


def exact_medians(df: DataFrame, cols: list[str]) -> dict[str, float | None]:
    """Exact medians (mean of the two middle values) of many columns at once, by radix selection.

    Four passes each settle 16 bits of the two middle values of every column: a
    task counts the next digit of the values that share the bits found so far, and
    only these counts, at most 2^16 per column and middle value, are shuffled.
    """
    counts = df.agg(*[F.count(c).alias(c) for c in cols]).first()
    wanted = [(c, 0, rank) for c in cols if counts[c] for rank in sorted({(counts[c] - 1) // 2 + 1, counts[c] // 2 + 1})]
    if not wanted:
        return dict.fromkeys(cols)
    for level in range(64 // DIGIT_BITS):
        prefixes: dict[str, list[int]] = {}
        for c, prefix, _ in wanted:
            if prefix not in prefixes.setdefault(c, []):
                prefixes[c].append(prefix)
        ranks = df.sparkSession.createDataFrame(wanted, "name string, prefix long, rank long")  # at most two per column
        upto = W.partitionBy("name", "prefix").orderBy("digit").rowsBetween(W.unboundedPreceding, 0)
        through = _digit_counts(df, prefixes, level).withColumn("through", F.sum("n").over(upto))
        found = through.join(F.broadcast(ranks), ["name", "prefix"]).where("rank > through - n AND rank <= through")
        wanted = [(r["name"], r["prefix"] << DIGIT_BITS | r["digit"], r["rank"] - (r["through"] - r["n"])) for r in found.collect()]
    middle: dict[str, list[float]] = {}
    for c, key, _ in wanted:
        middle.setdefault(c, []).append(_from_ordered_bits(key))
    return {c: sum(middle[c]) / len(middle[c]) if c in middle else None for c in cols}
