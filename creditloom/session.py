"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", name: str = "creditloom", **extra: str) -> SparkSession:
    """A local session for tests and the benchmark; a cluster brings its own."""
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.driver.memory": "12g",
        "spark.driver.host": "127.0.0.1",
        "spark.driver.bindAddress": "127.0.0.1",
        "spark.ui.enabled": "false",
    } | extra
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@cache
def _local_folder() -> str:
    """One folder for a process whose session is local and names none; removed when the process ends."""
    folder = tempfile.mkdtemp(prefix="creditloom-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints; a temporary one only for local sessions without any."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):  # one machine only
        return _local_folder()
    raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return os.path.join(shared_folder(spark), f"{name}-{uuid.uuid4().hex}")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: later work does not depend on its lineage."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
