"""Readers of the raw CSV tables, the column dictionary, and prepared parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .schemas import COLUMN_DICTIONARY, RAW_TABLES


def read_raw_csv(spark: SparkSession, path: str, table: str) -> DataFrame:
    """One raw table from CSV with a header, in the declared types.

    Columns are found by header name, so files may hold more columns, in any
    order; only the declared ones are parsed. A value that is not of its type
    becomes NULL; :func:`unparsed_values` counts such values. For profiles of a
    whole file see :func:`read_whole_csv`.
    """
    declared = {f.name: f.dataType for f in RAW_TABLES[table].fields}
    header = spark.read.option("header", True).csv(path).columns
    in_file = T.StructType([T.StructField(c, declared.get(c, T.StringType())) for c in header])
    missing = [c for c in declared if c not in header]
    if missing:
        raise ValueError(f"{table}: columns not in the file: {', '.join(missing)}")
    return spark.read.option("header", True).schema(in_file).csv(path).select(*declared)


# A column name that no file has, for the text of rows with too few or too many fields.
BROKEN_ROW = "__broken_row"


def _text_of(spark: SparkSession, path: str) -> tuple[DataFrame, list[str]]:
    """The file as strings with ``BROKEN_ROW``, and the columns of its header."""
    header = spark.read.option("header", True).csv(path).columns
    in_file = T.StructType([T.StructField(c, T.StringType()) for c in (*header, BROKEN_ROW)])
    return spark.read.options(header=True, columnNameOfCorruptRecord=BROKEN_ROW).schema(in_file).csv(path), header


def _cast_counts(text: DataFrame, columns: list[str]) -> DataFrame:
    """Values of every column that are known and that are a bigint, an int or a double: one scan, a small row per column."""
    quoted = [F.col(f"`{c}`").alias(c) for c in columns]
    long = text.select(*quoted).unpivot([], [F.col(f"`{c}`") for c in columns], "column_name", "value")
    return long.groupBy("column_name").agg(F.count("*").alias("n_rows"), F.count("value").alias("n_values"), *[
        F.count(F.col("value").try_cast(kind)).alias(kind) for kind in ("bigint", "int", "double")])


def read_whole_csv(spark: SparkSession, path: str, table: str) -> DataFrame:
    """All columns of a raw CSV in file order, for profiles: the declared ones in their types, the others as their values show.

    An undeclared column is a bigint if every row holds an integer, a double if
    every known value is a number, as in the published profile, else a string.
    """
    declared = {f.name: f.dataType for f in RAW_TABLES[table].fields}
    text, header = _text_of(spark, path)
    others = [c for c in header if c not in declared]
    counts = {r["column_name"]: r for r in _cast_counts(text, others).collect()} if others else {}  # one row per column

    def kind(c: str) -> T.DataType:
        n = counts.get(c)
        if c in declared or n is None:  # nothing is known of a file without rows
            return declared.get(c, T.StringType())
        if n["bigint"] == n["n_rows"]:
            return T.LongType()
        return T.DoubleType() if n["double"] == n["n_values"] else T.StringType()

    return text.select(*[F.col(f"`{c}`").try_cast(kind(c)).alias(c) for c in header])


def unparsed_values(spark: SparkSession, path: str, table: str) -> DataFrame:
    """``column_name, n_values, n_unparsed`` of every declared number column: known values that are no such number.

    The row of ``BROKEN_ROW`` counts the rows and those with too few or too many fields.
    """
    declared = {f.name: f.dataType.simpleString() for f in RAW_TABLES[table].fields if not isinstance(f.dataType, T.StringType)}
    text, header = _text_of(spark, path)
    counts = _cast_counts(text, [c for c in declared if c in header])
    of_kind = F.coalesce(*[F.when(F.col("column_name").isin([c for c in declared if declared[c] == k]), F.col(k))
                           for k in ("bigint", "int", "double")])
    whole = F.when(F.col(BROKEN_ROW).isNotNull(), F.hash(*[F.col(f"`{c}`") for c in header]))  # so that whole rows are parsed
    broken = text.agg(F.count("*").alias("n_values"), F.count(whole).alias("n_unparsed"))
    return counts.select("column_name", "n_values", (F.col("n_values") - of_kind).alias("n_unparsed")).unionByName(
        broken.select(F.lit(BROKEN_ROW).alias("column_name"), "n_values", "n_unparsed"))


def csv_folder(spark: SparkSession, folder: str):
    """A reader of raw tables for :func:`creditloom.plans.mart.credit_mart`, one CSV per table."""
    return lambda table: read_raw_csv(spark, f"{folder}/{table}.csv", table)


def parquet_folder(spark: SparkSession, folder: str):
    """The same over parquet: one dataset per raw table."""
    return lambda table: spark.read.schema(RAW_TABLES[table]).parquet(f"{folder}/{table}.parquet")


def read_column_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """The column dictionary: latin-1, with spaces around headers and table names."""
    raw = spark.read.options(header=True, encoding="ISO-8859-1", escape='"', multiLine=True).csv(path)
    tidy = raw.toDF(*[c.strip() for c in raw.columns])
    return tidy.select(*COLUMN_DICTIONARY.fieldNames()).withColumn("Table", F.trim("Table"))


def read_splits(spark: SparkSession, path: str, split: str) -> DataFrame:
    """One split of a table written by ``write_splits``; other splits' files are not opened."""
    return spark.read.parquet(path).where(F.col("split") == split).drop("split")
