"""Joins of a large table with a fitted table of checked size."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import written

MAX_BROADCAST_ROWS = 200_000
MAX_BROADCAST_BYTES = 64 << 20
VARIABLE = (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.StructType)


def fitted(table: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> tuple[DataFrame, bool]:
    """Pin a small fitted table on the driver if its size, in rows and bytes, allows it.

    Returns the table and whether it is pinned. The table is computed once: its rows
    and bytes are counted by an aggregate that every task does for its own part, and
    what was counted is then pulled, or written to the shared folder if it is large.
    """
    own = table.storageLevel == StorageLevel.NONE
    held = table.persist(StorageLevel.MEMORY_AND_DISK) if own else table
    varies = any(isinstance(f.dataType, VARIABLE) for f in table.schema)
    weight = F.sum(F.octet_length(F.to_json(F.struct("*")))) if varies else F.lit(0)
    try:
        rows, size = held.agg(F.count("*"), weight).first()
        if rows > max_rows or (size or 0) > MAX_BROADCAST_BYTES:
            return written(held, "fitted"), False
        content = held.toArrow()
    finally:
        if own:
            held.unpersist()
    return table.sparkSession.createDataFrame(content, table.schema), True


def lookup_join(big: DataFrame, table: DataFrame, on: list[str], how: str = "left",
                max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Join ``big`` with a fitted table, null-safe on the keys.

    Broadcast when the table's size was checked to be small; otherwise a
    shuffled join, where adaptive execution splits skewed keys of ``big``.
    """
    return fitted_join(big, *fitted(table, max_rows), on, how)


def fitted_join(big: DataFrame, table: DataFrame, pinned: bool, on: list[str], how: str = "left") -> DataFrame:
    """:func:`lookup_join` with a table whose size is known already: ``pinned`` says that it is small."""
    keys = {k: f"__key_{k}" for k in on}
    small = table.withColumnsRenamed(keys)
    condition = [F.col(k).eqNullSafe(F.col(r)) for k, r in keys.items()]
    return big.join(F.broadcast(small) if pinned else small, condition, how).drop(*keys.values())
