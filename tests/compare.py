"""Run a registered query and its DuckDB statement on the same tables and compare."""

from __future__ import annotations

import math
import os
from pathlib import Path

import duckdb

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def oracle_connection(folder: str = FOLDER) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "~"
    if isinstance(value, float):
        return repr(value + 0.0)
    return str(value)


def _rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def _equal(a: str, b: str, tolerance: float) -> bool:
    if a == b:
        return True
    try:
        return tolerance > 0 and abs(float(a) - float(b)) <= tolerance
    except ValueError:
        return False


def differences(query, sql: str, spark, con, folder: str = FOLDER, tolerance: float = 0.0) -> str | None:
    """A description of the first difference, or None if both results are equal."""
    df = query(spark, folder)
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    kinds = {d[0]: str(d[1]) for d in result.description}
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(set(names) ^ set(df.columns))}"
    mine, theirs = _rows(df.columns, df.collect()), _rows(names, result.fetchall())
    if len(mine) != len(theirs):
        return f"rows {len(mine)} != {len(theirs)}"
    spark_kinds = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    odd = {f.name: (f.dataType.simpleString(), kinds[f.name]) for f in df.schema
           if spark_kinds.get(f.dataType.simpleString(), "?") != kinds[f.name]}
    wrong = [(a, b) for a, b in zip(mine, theirs) if not all(_equal(x, y, tolerance) for x, y in zip(a, b))]
    if wrong:
        cols = sorted(names)
        a, b = wrong[0]
        return f"{len(wrong)} rows differ, first in {[(c, x, y) for c, x, y in zip(cols, a, b) if x != y][:6]}"
    return f"types {odd}" if odd else None
