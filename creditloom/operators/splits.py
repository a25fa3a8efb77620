"""Deterministic stratified splits and folds.

A row's place depends on its key, the seed and the sizes of the strata only, so
neither row order nor partitioning matters. The exact cut points are found
first; assigning a row is then a comparison, without shuffling the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.lookup import lookup_join
from ..functions.order import hash_rank_cuts, key_hash

SEED = 42


def _assign(df: DataFrame, key: str, label: str, seed: int | str, ranks: dict[str, str],
            among: DataFrame | None = None) -> tuple[DataFrame, Column]:
    """Attach each stratum's cut points, found ``among`` other rows if given; returns the frame and the number of cuts a row
    lies beyond."""
    cuts = hash_rank_cuts(df if among is None else among, key, [label], seed, ranks)
    per_label = cuts.groupBy(label).agg(F.collect_list(F.struct("cut_hash", "cut_key")).alias("__cuts"))
    joined = lookup_join(df, per_label, [label])
    place = F.struct(key_hash(key, seed).alias("cut_hash"), F.col(key).alias("cut_key"))
    cuts_passed = F.size(F.filter(F.coalesce("__cuts", F.array()), lambda cut: cut < place))
    return joined, cuts_passed


def stratified_split(df: DataFrame, key: str = "loan_id", label: str = "target",
                     fractions: tuple[float, float, float] = (0.7, 0.1, 0.2), seed: int | str = SEED) -> DataFrame:
    """Add ``split``: train, val or test with exact shares in every stratum.

    The first ranks of the hash order are test, the next val, the rest train;
    sizes are rounded up.
    """
    _, val, test = fractions
    ranks = {"test": f"ceil(n * {test})", "val": f"ceil(n * {test}) + ceil(n * {val})"}
    joined, passed = _assign(df, key, label, seed, ranks)
    split = F.when(passed == 0, "test").when(passed == 1, "val").otherwise("train")
    return joined.withColumn("split", split).drop("__cuts")


def stratified_folds(df: DataFrame, k: int = 5, key: str = "loan_id", label: str = "target",
                     seed: int | str = SEED) -> DataFrame:
    """Add ``fold`` in 0..k-1: ``k`` equal runs of the hash order per stratum, the larger ones first."""
    ranks = {str(i): f"{i} * (n div {k}) + least({i}, n % {k})" for i in range(1, k)}
    joined, passed = _assign(df, key, label, seed, ranks)
    return joined.withColumn("fold", passed).drop("__cuts")


def early_stop_holdout(df: DataFrame, share: float = 0.1, key: str = "loan_id", label: str = "target",
                       seed: int | str = "holdout") -> DataFrame:
    """Add ``is_holdout``: the first ``share`` of every stratum, in an order of its own."""
    joined, passed = _assign(df, key, label, seed, {"holdout": f"ceil(n * {share})"})
    return joined.withColumn("is_holdout", passed == 0).drop("__cuts")


def fold_roles(folded: DataFrame, k: int, share: float = 0.1, key: str = "loan_id", label: str = "target") -> DataFrame:
    """Add ``role0`` to ``role{k}``: what a row of a table with ``fold`` is to the model of each fold, and to that of all rows.

    0 is left out, 1 learned from, 2 held out: :func:`early_stop_holdout` of the rows outside the fold.
    """
    for fold in range(k + 1):
        rest = folded.where(F.col("fold") != fold) if fold < k else folded
        joined, passed = _assign(folded, key, label, "holdout", {"holdout": f"ceil(n * {share})"}, rest.select(key, label))
        folded = joined.withColumn(f"role{fold}", F.when(F.col("fold") == fold, 0).when(passed == 0, 2).otherwise(1)).drop("__cuts")
    return folded


def split_report(split: DataFrame, label: str = "target") -> DataFrame:
    """Rows and target rate of every split."""
    return split.groupBy("split").agg(F.count("*").alias("n_rows"), F.avg(label).alias("target_rate"))
