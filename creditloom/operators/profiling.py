"""Exploratory profiles of a table, each from one scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T
from pyspark.sql import functions as F

from ..functions.lookup import lookup_join
from ..functions.moments import co_moments
from ..functions.numeric import duck_round

# Age bucket limits in years of 365 days, right-closed, and the overall rate drawn as a reference line.
AGE_BUCKETS = ((25, "<25"), (35, "25-35"), (45, "35-45"), (55, "45-55"), (100, ">55"))
AVERAGE_RATE = 0.081

# Two columns with this absolute correlation say the same.
REDUNDANT = 0.9

# Raw columns already used when candidates were looked for, and the columns of the correlation matrix.
ALREADY_USED = (
    "SK_ID_CURR TARGET NAME_CONTRACT_TYPE AMT_CREDIT AMT_ANNUITY AMT_INCOME_TOTAL AMT_GOODS_PRICE CODE_GENDER "
    "DAYS_BIRTH DAYS_EMPLOYED FLAG_MOBIL FLAG_EMAIL FLAG_OWN_CAR FLAG_OWN_REALTY"
).split()
KEY_FEATURES = (
    "TARGET AMT_INCOME_TOTAL AMT_CREDIT AMT_ANNUITY DAYS_BIRTH DAYS_EMPLOYED EXT_SOURCE_1 EXT_SOURCE_2 "
    "EXT_SOURCE_3 REGION_RATING_CLIENT_W_CITY"
).split()


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def _unpivoted(df: DataFrame, aggregates: dict[str, Column], value: str) -> DataFrame:
    """One aggregate per column, as rows ``column_name, value``."""
    wide = df.agg(*[agg.alias(c) for c, agg in aggregates.items()])
    return wide.unpivot([], list(aggregates), "column_name", value)


def shape_dtypes(df: DataFrame) -> DataFrame:
    """Row count, column count and columns per type."""
    types = [f.dataType.simpleString() for f in df.schema]
    facts = {"rows": F.count("*"), "columns": F.lit(len(types)).cast("bigint")}
    facts |= {f"dtype {t}": F.lit(types.count(t)).cast("bigint") for t in sorted(set(types))}
    return _unpivoted(df, facts, "value").withColumnRenamed("column_name", "fact")


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Rows and share of every value."""
    counts = df.groupBy(col).agg(F.count("*").alias("n_rows"))
    total = counts.agg(F.sum("n_rows")).scalar()
    return counts.select(col, "n_rows", (F.col("n_rows") / total).alias("share")).orderBy(F.desc("n_rows"), col)


def missing_rates(df: DataFrame) -> DataFrame:
    """Share of NULLs of every column that has any, highest first."""
    rates = _unpivoted(df, {c: F.avg(F.col(c).isNull().cast("int")) for c in df.columns}, "missing_rate")
    return rates.where("missing_rate > 0").orderBy(F.desc("missing_rate"), "column_name")


def candidate_columns(df: DataFrame, used: list[str] = ALREADY_USED, below: float = 0.2) -> DataFrame:
    """Columns with some, but less than ``below``, missing values that are not used yet."""
    return missing_rates(df).where((F.col("missing_rate") < below) & ~F.col("column_name").isin(*used))


def rate_by_group(df: DataFrame, by: list[str], label: str = "target", digits: int = 4) -> DataFrame:
    """Label mean, row count and label sum per group, highest mean first; NULL groups are left out."""
    known = df.na.drop("any", subset=by)
    grouped = known.groupBy(*by).agg(
        F.avg(label).alias("rate"), F.count(label).alias("n_rows"), F.sum(label).alias("n_positive"))
    return grouped.orderBy(F.desc("rate"), *by).withColumn("rate", F.expr(duck_round("rate", digits)))


def age_bucket(days_birth: str) -> Column:
    """Right-closed buckets of age in years of 365 days; NULL outside (0, 100]."""
    years = -F.col(days_birth) / F.lit(365)
    bucket = F.when(years <= 0, F.lit(None))
    for limit, name in AGE_BUCKETS:
        bucket = bucket.when(years <= limit, name)
    return bucket


def rate_by_age_bucket(df: DataFrame, days_birth: str = "days_birth", label: str = "target") -> DataFrame:
    return rate_by_group(df.withColumn("age_bucket", age_bucket(days_birth)), ["age_bucket"], label, 3)



def correlations_with(df: DataFrame, label: str, cols: list[str] | None = None, digits: int = 6) -> DataFrame:
    """Absolute Pearson correlation with the label over rows where both are known, and the share of NULLs.

    Rounded before ranking, so that equal correlations rank by name on any partitioning.
    """
    cols = cols or [c for c in numeric_columns(df) if c != label]
    moments = co_moments(df, cols, against=label).where(F.col("b") != label)
    return moments.select(F.col("b").alias("column_name"), F.expr(duck_round("abs(corr)", digits)).alias("abs_corr"),
                          F.expr("(rows - known) / nullif(rows, 0)").alias("missing_rate")).orderBy(
        F.desc_nulls_last("abs_corr"), "column_name")


def top_correlations(df: DataFrame, label: str, n: int = 20) -> DataFrame:
    return correlations_with(df, label).limit(n)


def corr_matrix(df: DataFrame, cols: list[str], digits: int = 2) -> DataFrame:
    """Pearson correlation of every pair of columns, each over rows where both are known."""
    upper = co_moments(df, cols).select("a", "b", F.expr(duck_round("corr", digits)).alias("corr"))
    return upper.unionByName(upper.where("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b"), "corr"))


def column_redundancy(df: DataFrame, cols: list[str] | None = None, least: float = REDUNDANT, digits: int = 6) -> DataFrame:
    """All pairs of numeric columns, strongest first: absolute correlation, rows where both are known, and whether one of the two
    can be left out."""
    pairs = co_moments(df, cols or numeric_columns(df)).where("a <> b")
    rows = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "n",
                        F.expr(duck_round("abs(corr)", digits)).alias("abs_corr"))
    return rows.withColumn("redundant", F.coalesce(F.col("abs_corr") >= least, F.lit(False))).orderBy(
        F.desc_nulls_last("abs_corr"), "a", "b")


def category_spread(df: DataFrame, label: str = "target", cols: list[str] | None = None) -> DataFrame:
    """Largest minus smallest group rate, and number of values, of every string column."""
    cols = cols or string_columns(df)
    long = df.select(label, *cols).unpivot([label], cols, "column_name", "value").where("value IS NOT NULL")
    rates = long.groupBy("column_name", "value").agg(F.avg(label).alias("rate"))
    return rates.groupBy("column_name").agg(
        (F.max("rate") - F.min("rate")).alias("spread"), F.count("*").alias("n_categories"))


def density_histogram(df: DataFrame, col: str, label: str = "target", bins: int = 50,
                      complete: list[str] | None = None) -> DataFrame:
    """Equal-width histogram per class on the class's own range, as a density.

    Rows with a NULL in any of ``complete`` are left out; the last bin includes
    the maximum; a constant class gets a range of one around its value; empty
    bins have density 0.
    """
    rows = df.select(label, F.col(col).cast("double").alias("x"), *[c for c in complete or [] if c not in (col, label)])
    rows = rows.na.drop("any").select(label, "x")
    low = F.min("x") - F.when(F.min("x") == F.max("x"), 0.5).otherwise(0.0)
    high = F.max("x") + F.when(F.min("x") == F.max("x"), 0.5).otherwise(0.0)
    ranges = rows.groupBy(label).agg(
        low.alias("low"), ((high - low) / bins).alias("width"), F.count("*").alias("n"))
    placed = lookup_join(rows, ranges, [label], "inner")
    guess = f"least(CAST(floor((x - low) / width) AS INT), {bins - 1})"
    counts = placed.selectExpr(label, "low", "width", "n", "x", f"{guess} AS g").selectExpr(
        label, "low", "width", "n",
        f"g - int(x < low + g * width) + int(g < {bins - 1} AND x >= low + (g + 1) * width) AS bin")
    filled = counts.groupBy(F.col(label).alias("__label"), F.col("bin").alias("__bin")).agg(F.count("*").alias("n_rows"))
    every = ranges.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    grouped = every.join(filled, F.expr(f"{label} <=> __label AND bin = __bin"), "left").na.fill(0, ["n_rows"])
    return grouped.selectExpr(label, "bin", "low + bin * width AS bin_start", "n_rows", "n_rows / (n * width) AS density")


def rate_vs_average(df: DataFrame, by: str, chosen: list[str] | None = None, average: float = AVERAGE_RATE,
                    label: str = "target") -> DataFrame:
    """Group rate, lowest first, and whether it lies above the average; optionally for chosen groups only."""
    rows = df if chosen is None else df.where(F.col(by).isin(*chosen))
    rates = rows.where(F.col(by).isNotNull()).groupBy(by).agg(F.avg(label).alias("rate"))
    return rates.orderBy("rate", by).withColumn("above_average", F.col("rate") > average)


def dictionary_search(df: DataFrame, equals: dict[str, str] | None = None, contains: dict[str, str] | None = None,
                      one_of: dict[str, list[str]] | None = None) -> DataFrame:
    """Rows matching all given conditions: equality, case-insensitive pattern, membership."""
    for col, value in (equals or {}).items():
        df = df.where(F.col(col) == value)
    for col, pattern in (contains or {}).items():
        df = df.where(F.col(col).rlike(f"(?i){pattern}"))
    for col, values in (one_of or {}).items():
        df = df.where(F.col(col).isin(*values))
    return df
