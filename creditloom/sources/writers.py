"""Writers of tables and of small report artifacts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def register_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def write_splits(split: DataFrame, path: str) -> None:
    """One dataset with a folder per split."""
    split.write.mode("overwrite").partitionBy("split").parquet(path)


def write_metrics(metrics: DataFrame, aucs: DataFrame, path: str, model_name: str, threshold: float) -> None:
    """One JSON object: name, AUC, threshold, rates, and the confusion matrix as a nested object."""
    joined = metrics.withColumn("auc", F.round(aucs.select("auc").scalar(), 4))
    joined.select(
        F.lit(model_name).alias("model_name"), "auc", "accuracy", F.lit(round(threshold, 4)).alias("threshold"),
        "recall", "fpr", "fnr", F.struct("tn", "fp", "fn", "tp").alias("confusion_matrix"),
    ).coalesce(1).write.mode("overwrite").json(path)


def write_threshold(best: DataFrame, path: str, model_name: str) -> None:
    best.select("threshold", F.lit(model_name).alias("model")).coalesce(1).write.mode("overwrite").json(path)


def write_fairness(by_group: DataFrame, gaps: DataFrame, aucs: DataFrame, path: str, model_name: str,
                   group: str = "gender_clean") -> None:
    """One JSON object: rates by group, differences and AUC by group, keyed by metric and group."""
    def keyed(df: DataFrame, key: str, value: str):
        entries = F.map_from_entries(F.array_sort(F.collect_list(F.struct(key, F.round(value, 4)))))
        return df.agg(entries.alias("m")).scalar()

    metrics = ("selection_rate", "false_positive_rate", "false_negative_rate")
    rates = F.struct(*[keyed(by_group, group, m).alias(m) for m in metrics])
    one = by_group.sparkSession.range(1)
    one.select(
        F.lit(model_name).alias("model_name"), rates.alias("by_group"),
        keyed(gaps.where(F.col("metric").isin(*metrics)), "metric", "gap").alias("difference"),
        keyed(aucs.where(F.col(group) != "all"), group, "auc").alias("auc_by_gender"),
    ).coalesce(1).write.mode("overwrite").json(path)


def write_importance(importance: DataFrame, path: str) -> None:
    """One sorted CSV; the ranking has one row per feature, so a single file is small."""
    measure = importance.columns[1]
    importance.orderBy(F.desc(measure), "feature").coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int) -> DataFrame:
    """A table at ``path``, one sorted file per bucket of the key's hash, read back under ``name``."""
    df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).option("path", path).mode("overwrite").saveAsTable(name)
    return df.sparkSession.table(name)
