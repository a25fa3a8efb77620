"""Intermediate tables in the shared folder, and access to the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from creditloom.session import scratch_path


FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def given(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def kept(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """The same rows, written to the shared folder: computed once, and safe from lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(FREE_SHUFFLES, "false")
    spark.conf.set(FREE_SHUFFLES, "true")  # the table replaces them, so their disk is free again once it is written
    try:
        df.write.option("compression", compression).parquet(path)
    finally:
        spark.conf.set(FREE_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Delete the files of a table that ``kept`` wrote and nothing reads any more."""
    spark = df.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    folders = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
    for folder in folders:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)
