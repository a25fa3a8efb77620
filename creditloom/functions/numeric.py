"""SQL expression text for the arithmetic the feature definitions need.

Expressions are text so that a wide projection is parsed in one step per column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def duck_round(value: str, digits: int) -> str:
    """Round a double by scaling in binary (0.285 at 2 digits gives 0.28).

    Spark's ``round(x, n)`` on a double works on its decimal text, which differs
    from ``round(x * 10**n) / 10**n`` for some values.
    """
    return f"round(({value}) * 1e{digits}, 0) / 1e{digits}"


def ratio(num: str, den: str, digits: int | None = None) -> str:
    """``num / den`` as a double, NULL where the denominator is zero or NULL."""
    value = f"({num}) / nullif(CAST({den} AS DOUBLE), 0e0)"
    return value if digits is None else duck_round(value, digits)


def share(condition: str, digits: int | None = None) -> str:
    """Aggregate: rows meeting ``condition`` over all rows of the group."""
    value = f"count_if({condition}) / count(*)"
    return value if digits is None else duck_round(value, digits)


def flag(condition: str) -> str:
    """1 where the condition holds, otherwise (also on NULL) 0."""
    return f"CASE WHEN {condition} THEN 1 ELSE 0 END"


def zero_if_null(value: str) -> str:
    return f"coalesce({value}, 0)"


def named(columns: dict[str, str]) -> list[Column]:
    """Columns from ``{output name: expression text}``."""
    return [F.expr(text).alias(name) for name, text in columns.items()]


def aggregate(df: DataFrame, keys: list[str], columns: dict[str, str]) -> DataFrame:
    """Group by ``keys`` and compute ``{output name: aggregate text}``."""
    return df.groupBy(*keys).agg(*named(columns))
