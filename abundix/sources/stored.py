"""Hits and records stored in the layout that the profiles read them in.

What is worked out per read (weights, unaligned reads) needs the rows of a read together.  Stored in buckets by
the read's id they are, for every later job: reading such a table needs no shuffle by read, and two tables with
the same number of buckets are joined by read where they lie.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def store_by_query(rows: DataFrame, name: str, buckets: int, path: str | None = None, query: str = "query") -> DataFrame:
    """Write ``rows`` as table ``name`` in ``buckets`` by ``query``, and the table.

    One file per bucket, in order of the id.  ``path`` is a folder that all executors share; without it the table
    lies in the warehouse.  A bucket is read by one task, so their number should grow with the rows.
    """
    writer = rows.repartition(buckets, query).write.bucketBy(buckets, query).sortBy(query).mode("errorifexists").format("parquet")
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return stored(rows.sparkSession, name)


def stored(spark: SparkSession, name: str) -> DataFrame:
    """A table that ``store_by_query`` has written."""
    return spark.table(name)
