"""Documents that keep arriving: a landing folder as a stream, each document once within a watermark, outcomes by window.

An addition to the batch datasets, which need none of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "url string, status string, html string, landed_at timestamp"


def landing(spark: SparkSession, path: str, files_at_once: int = 100) -> DataFrame:
    """New JSON files of a landing folder, as they appear."""
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", files_at_once).json(path)


def once(stream: DataFrame, delay: str = "1 day") -> DataFrame:
    """Each URL once: later arrivals of the same URL within ``delay`` are dropped, and state older than that is let go."""
    return stream.withWatermark("landed_at", delay).dropDuplicatesWithinWatermark(["url"])


def outcomes(stream: DataFrame, window: str = "1 hour", delay: str = "1 day") -> DataFrame:
    """How many documents of each status landed in each window."""
    return stream.withWatermark("landed_at", delay).groupBy(F.window("landed_at", window), "status").agg(F.count("*").alias("n"))
