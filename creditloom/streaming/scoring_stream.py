"""Scoring of a stream of request files.

Scoring is stateless: the batch function runs on the stream unchanged. The
query checkpoint makes each request file scored once across restarts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.scoring import REQUEST_SCHEMA, score_requests


def read_requests(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """JSON request files as they arrive; fields that are absent count as omitted."""
    return spark.readStream.schema(REQUEST_SCHEMA).option("maxFilesPerTrigger", files_per_batch).json(folder)


def start_scoring(spark: SparkSession, requests: str, decisions: str, checkpoint: str,
                  model: Callable[[DataFrame], DataFrame], threshold: float, once: bool = False) -> StreamingQuery:
    """Score requests from one folder into parquet decisions in another.

    With ``once`` the query handles what is there and stops.
    """
    answers = score_requests(read_requests(spark, requests), model, threshold)
    writer = answers.writeStream.format("parquet").option("path", decisions).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).outputMode("append").start()
