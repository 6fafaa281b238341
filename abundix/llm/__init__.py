"""Operators for preparing training text: deduplication, quality, mixing, packing and placement."""

from __future__ import annotations

from pyspark.sql import SparkSession

from abundix.session import apply_conf

# Texts can be long: batches to Python are bounded by their bytes, not only by their rows.
ARROW_BATCH_BYTES = "8m"


def text_conf(spark: SparkSession) -> SparkSession:
    """The session with the library's settings and those for long texts."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BATCH_BYTES)
    return apply_conf(spark)
