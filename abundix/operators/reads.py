"""Counts of reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def read_counts(reads: DataFrame, source: str = "source", query: str = "id") -> DataFrame:
    """Reads and distinct read ids per file."""
    return reads.groupBy(source).agg(
        F.count(F.lit(1)).alias("reads"), F.count_distinct(query).alias("distinct_reads")
    )
