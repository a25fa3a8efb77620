"""Moments of many columns, and co-moments of all their pairs over the rows where both are known, without expanding rows."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .numeric import named

#: A variance that is this small a part of the sum of squares is the rounding error of a constant.
NOTHING = 1e-13


def column_moments(df: DataFrame, cols: list[str]) -> dict[str, tuple[float | None, float | None]]:
    """Mean and population standard deviation of every column over its known values."""
    doubles = df.select(*[F.expr(f"CAST(`{c}` AS DOUBLE)").alias(c) for c in cols])
    means = doubles.agg(*[F.avg(c).alias(c) for c in cols]).first()
    shift = np.array([0.0 if means[c] is None else means[c] for c in cols])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s, q = (np.zeros(len(cols)) for _ in range(3))
        for batch in batches:
            for i, column in enumerate(batch.columns):
                x = column.drop_null().to_numpy(zero_copy_only=False).astype(np.float64) - shift[i]
                n[i], s[i], q[i] = n[i] + len(x), s[i] + x.sum(), q[i] + x @ x
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(cols))), *[pa.array(x) for x in (n, s, q)]], names=["i", "n", "s", "q"])

    sums = doubles.mapInArrow(add, "i long, n double, s double, q double").groupBy("i").agg(*[F.sum(c).alias(c) for c in "nsq"])
    out: dict[str, tuple[float | None, float | None]] = dict.fromkeys(cols, (None, None))
    for r in sums.where("n > 0").collect():  # one row per column
        spread = r["q"] - r["s"] ** 2 / r["n"]
        out[cols[r["i"]]] = (float(shift[r["i"]] + r["s"] / r["n"]), math.sqrt(spread / r["n"]) if spread > NOTHING * r["q"] else 0.0)
    return out


def co_moments(df: DataFrame, cols: list[str], against: str | None = None) -> DataFrame:
    """``a, b, n, known, rows, corr`` for every pair a <= b in the order of ``cols``, or for ``against`` and every column.

    ``n`` counts the rows where both are known, ``known`` those where b is, ``rows`` all of them.

    A task adds up products of its value and mask matrices, shifted by the columns'
    means so that no digits cancel, and sends one row per pair. ``corr`` is NULL where
    a column is constant over the pair's rows.
    """
    names = list(dict.fromkeys([against, *cols] if against else cols))
    doubles = df.select(*[F.expr(f"nanvl(CAST(`{c}` AS DOUBLE), NULL)").alias(c) for c in names])
    means = doubles.agg(*[F.avg(c).alias(c) for c in names]).first()
    shift = np.array([means[c] or 0.0 for c in names])
    left = [0] if against else range(len(names))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, rows = len(names), 0
        n, s, q, p = (np.zeros((len(left), size)) for _ in range(4))
        s_of_b, q_of_b, known_b = np.zeros_like(s), np.zeros_like(s), np.zeros(size)
        for batch in batches:
            rows += batch.num_rows
            x = np.stack([c.to_numpy(zero_copy_only=False).astype(np.float64) for c in batch.columns], 1) - shift
            known = ~np.isnan(x)
            x, known = np.where(known, x, 0.0), known.astype(np.float64)
            squares = x * x
            a, mask, square = x[:, :len(left)].T, known[:, :len(left)].T, squares[:, :len(left)].T
            known_b += known.sum(0)
            n += mask @ known
            s += a @ known
            q += square @ known
            p += a @ x
            s_of_b += mask @ x
            q_of_b += mask @ squares
        i, j = (k.ravel() for k in np.meshgrid(np.arange(len(left)), np.arange(size), indexing="ij"))
        pairs = np.flatnonzero(j >= i)
        sums = [m.ravel()[pairs] for m in (s, q, p, s_of_b, q_of_b)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(i[pairs]), pa.array(j[pairs]), pa.array(n.ravel()[pairs].astype(np.int64)), pa.array(known_b[j[pairs]].astype(np.int64)),
             pa.array(np.full(len(pairs), rows)), *[pa.array(x) for x in sums]], names=["i", "j", "n", "known", "rows", "s", "q", "p", "t", "r"])

    parts = doubles.mapInArrow(add, "i long, j long, n long, known long, rows long, s double, q double, p double, t double, r double")
    total = parts.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "known", "rows", "s", "q", "p", "t", "r")])
    spread = total.select("i", "j", "n", "known", "rows", *named({
        "cov": "p - s * t / nullif(n, 0)", "va": f"if(q - s * s / nullif(n, 0) > {NOTHING} * q, q - s * s / nullif(n, 0), NULL)",
        "vb": f"if(r - t * t / nullif(n, 0) > {NOTHING} * r, r - t * t / nullif(n, 0), NULL)"}))
    listed = F.array(*[F.lit(c) for c in names])
    return spread.select(F.element_at(listed, (F.col("i") + 1).cast("int")).alias("a"), F.element_at(listed, (F.col("j") + 1).cast("int")).alias("b"),
                         "n", "known", "rows", F.expr("cov / sqrt(va * vb)").alias("corr"))
