"""Encoders and imputers: fitted on one table, applied to any."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.lookup import fitted, fitted_join
from ..functions.moments import column_moments
from ..functions.order import exact_medians, key_hash
from .profiling import string_columns

# Order of the age groups, target-encoded columns and the constants of the blend.
AGE_GROUPS = ("young", "adult", "senior")
TARGET_ENCODED = ["occupation_type", "education_type", "family_status", "income_type", "organization_type"]
SMOOTHING = 10
MIN_SAMPLES = 20
UNKNOWN = "Unknown"


def ordinal_encode(df: DataFrame, col: str = "age_group", order: tuple[str, ...] = AGE_GROUPS) -> DataFrame:
    """Replace a category by its position; any other value fails the job."""
    code = F.when(F.lit(False), 0.0)
    for position, value in enumerate(order):
        code = code.when(F.col(col) == value, float(position))
    unknown = F.concat(F.lit(f"unknown category in {col}: "), F.coalesce(F.col(col), F.lit("NULL")))
    return df.withColumn(col, code.otherwise(F.raise_error(unknown).cast("double")))


@dataclass(frozen=True)
class TargetEncoder:
    """Smoothed category means: ``stats`` holds column_name, category, encoded; ``prior`` the overall mean.

    ``pinned`` says that ``stats`` was measured to be small.
    """

    stats: DataFrame
    prior: float
    cols: list[str]
    pinned: bool = False

    def transform(self, df: DataFrame) -> DataFrame:
        """Replace the columns; categories not seen when fitting get the prior.

        The lookups are broadcast when their measured size allows, otherwise shuffled.
        """
        for c in self.cols:
            table = self.stats.where(F.col("column_name") == c).select(F.col("category").alias(c), "encoded")
            joined = fitted_join(df, table, self.pinned, [c])
            df = joined.withColumn(c, F.coalesce("encoded", F.lit(self.prior))).drop("encoded")
        return df


def fit_target_encoder(df: DataFrame, label: str = "target", cols: list[str] | None = None,
                       smoothing: float = SMOOTHING, min_samples: float = MIN_SAMPLES) -> TargetEncoder:
    """Category statistics of all columns from one scan; NULL is a category of its own."""
    cols = TARGET_ENCODED if cols is None else cols
    prior = df.agg(F.avg(label)).first()[0]
    long = df.select(label, *cols).unpivot([label], cols, "column_name", "category")
    stats = long.groupBy("column_name", "category").agg(F.count("*").alias("n"), F.avg(label).alias("mean"))
    weight = 1 / (1 + F.exp(-(F.col("n") - min_samples) / smoothing))
    stats = stats.withColumn("encoded", F.lit(prior) * (1 - weight) + F.col("mean") * weight)
    small, pinned = fitted(stats.select("column_name", "category", "encoded"))  # too many for the driver: written, not pinned
    return TargetEncoder(small, prior, cols, pinned)


def ordered_target_stats(df: DataFrame, cols: list[str] | None = None, key: str = "loan_id", label: str = "target",
                         prior_rows: float = 1.0, seed: int | str = 42, rows_per_cell: int = 50_000) -> DataFrame:
    """``key, column_name, encoded``: the label's mean over the rows of the same category that come earlier in a hash order.

    The overall mean counts as ``prior_rows`` rows more; no row sees its own label.
    Rows are summed in cells of the hash, whose number follows from the row count, and
    a cell starts from the totals of those before it: a category may hold any share of
    the rows. NULL is a category of its own.
    """
    cols = TARGET_ENCODED if cols is None else cols
    rows = df.where(F.col(label).isNotNull()).select(F.col(key).alias("k"), F.col(label).alias("y"), key_hash(key, seed).alias("h"), *cols)
    n, prior = rows.agg(F.count("*"), F.avg("y")).first()
    digits = 1
    while 16 ** digits * rows_per_cell < n:
        digits += 1
    long = rows.withColumn("cell", F.substring("h", 1, digits)).unpivot(["k", "y", "h", "cell"], cols, "column_name", "category")
    before = W.rowsBetween(W.unboundedPreceding, -1)
    earlier = before.partitionBy("column_name", "category").orderBy("cell")
    cells = long.groupBy("column_name", "category", "cell").agg(F.sum("y").alias("s"), F.count("*").alias("m")).select(
        F.col("column_name").alias("__n"), F.col("category").alias("__c"), F.col("cell").alias("__cell"),
        F.coalesce(F.sum("s").over(earlier), F.lit(0)).alias("s_before"), F.coalesce(F.sum("m").over(earlier), F.lit(0)).alias("n_before"))
    met = long.join(cells, F.expr("column_name = __n AND category <=> __c AND cell = __cell"))
    inside = before.partitionBy("column_name", "category", "cell").orderBy("h", "k")
    seen = F.col("s_before") + F.coalesce(F.sum("y").over(inside), F.lit(0))
    rows_seen = F.col("n_before") + F.count("*").over(inside)
    return met.select(F.col("k").alias(key), "column_name", ((seen + F.lit(prior) * prior_rows) / (rows_seen + prior_rows)).alias("encoded"))


def fill_unknown(df: DataFrame, cols: list[str] | None = None, order: list[str] | None = None) -> DataFrame:
    """Fill missing categories with a fixed name and bring the columns into a given order."""
    filled = df.na.fill(UNKNOWN, cols or string_columns(df))
    return filled.select(*order) if order else filled


@dataclass(frozen=True)
class ColumnValues:
    """One fitted number, or pair of numbers, per column."""

    values: dict


def fit_medians(df: DataFrame, cols: list[str]) -> ColumnValues:
    return ColumnValues(exact_medians(df, cols))


def impute_median(df: DataFrame, medians: ColumnValues) -> DataFrame:
    """Fill NULLs with the fitted medians; a column without any value when fitting becomes 0."""
    return df.withColumns({
        c: F.expr(f"coalesce(CAST({c} AS DOUBLE), {float(m or 0.0)!r}D)") for c, m in medians.values.items()})


def fit_scaler(df: DataFrame, cols: list[str]) -> ColumnValues:
    """Mean and population standard deviation of every column."""
    return ColumnValues(column_moments(df, cols))


def standardize(df: DataFrame, scaler: ColumnValues) -> DataFrame:
    """Centre and scale with the fitted values; a constant column is only centred."""
    return df.withColumns({
        c: F.expr(f"({c} - {mean!r}D) / {sd or 1.0!r}D") for c, (mean, sd) in scaler.values.items() if mean is not None})
