"""A cohort's feature table that grows by samples.

The long table lies in folders by bucket of the sample, and beside it what each bucket adds up to per feature.
Adding, replacing or removing samples rewrites the buckets they fall into and no other; sums, counts and extremes
over the cohort are merged from the buckets, one row per feature and bucket, without reading the cells.

``path/cells/bucket=n`` holds ``code, name, stratum, sample, value``, ``path/totals/bucket=n`` the features'
``sum, cells, low, high``.  The number of buckets is fixed when the cohort is made and kept in the names:
``path/buckets=n``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from abundix.functions.features import FEATURE
from abundix.operators.scaling import join_on
from abundix.operators.tables import join_tables
from abundix.session import cut_lineage

_FEATURE = list(FEATURE)
_CELLS = "code string, name string, stratum string, sample string, value double"
_TOTALS = "code string, name string, stratum string, sum double, cells long, low double, high double"


def _bucket(sample: Column | str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(sample), F.lit(buckets).cast("long")).cast("int")


def _write(cells: DataFrame, path: str) -> None:
    """Replace the buckets that ``cells`` (with ``bucket``) has, in both tables."""
    sums = cells.groupBy("bucket", *_FEATURE).agg(
        F.sum("value").alias("sum"), F.count("sample").alias("cells"), F.min("value").alias("low"), F.max("value").alias("high")
    )
    for rows, name in ((cells, "cells"), (sums, "totals")):
        # a file per bucket and task; the bucket decides the task, so a bucket is one file
        dealt = rows.repartition("bucket").sortWithinPartitions("bucket", *_FEATURE)
        dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(f"{path}/{name}")


def _stored(spark: SparkSession, path: str, name: str, schema: str) -> DataFrame:
    return spark.read.schema(f"{schema}, bucket int").parquet(f"{path}/{name}")


def buckets_of(spark: SparkSession, path: str) -> int:
    """The number of buckets the cohort was made with."""
    return spark.read.schema("buckets int").parquet(f"{path}/made").first().buckets


def create_cohort(table: DataFrame, path: str, buckets: int = 64) -> None:
    """Store ``table`` (code, name, stratum, sample, value) as a cohort in a new folder; repeated cells are summed."""
    spark = table.sparkSession
    spark.range(1).select(F.lit(buckets).alias("buckets")).write.parquet(f"{path}/made")
    cells = join_tables([table.select(*_FEATURE, "sample", F.col("value").cast("double").alias("value"))])
    _write(cut_lineage(cells.withColumn("bucket", _bucket("sample", buckets))), path)


def add_samples(spark: SparkSession, path: str, table: DataFrame) -> None:
    """Add the samples of ``table``; a sample that the cohort has is replaced."""
    buckets = buckets_of(spark, path)
    new = join_tables([table.select(*_FEATURE, "sample", F.col("value").cast("double").alias("value"))])
    new = cut_lineage(new.withColumn("bucket", _bucket("sample", buckets)))
    _rewrite(spark, path, new.select("sample", "bucket").distinct(), new)


def remove_samples(spark: SparkSession, path: str, samples: DataFrame) -> None:
    """Remove the samples named by ``samples(sample)``."""
    buckets = buckets_of(spark, path)
    named = samples.select("sample").distinct()
    _rewrite(spark, path, named.withColumn("bucket", _bucket("sample", buckets)), None)


def _rewrite(spark: SparkSession, path: str, samples: DataFrame, new: DataFrame | None) -> None:
    samples = cut_lineage(samples)
    # bounded by the number of buckets; as values they prune the folders that are read
    touched = [r.bucket for r in samples.select("bucket").distinct().collect()]
    if not touched:
        return
    stored = _stored(spark, path, "cells", _CELLS).where(F.col("bucket").isin(touched))
    kept = join_on(stored, samples.select("sample"), ["sample"], "left_anti", null_safe=True)
    cells = kept if new is None else kept.unionByName(new)
    # a bucket that loses its last sample still has to be replaced: by a row without a sample
    empty = spark.createDataFrame([(b,) for b in touched], "bucket int").select(
        *[F.lit(None).cast("string").alias(c) for c in (*_FEATURE, "sample")], F.lit(None).cast("double").alias("value"), "bucket"
    )
    # written first, as what is read is then replaced
    _write(cut_lineage(cells.unionByName(empty)), path)


def read_cohort(spark: SparkSession, path: str) -> DataFrame:
    """The cohort's cells: code, name, stratum, sample, value."""
    return _stored(spark, path, "cells", _CELLS).where(F.col("sample").isNotNull()).drop("bucket")


def cohort_totals(spark: SparkSession, path: str) -> DataFrame:
    """Per feature ``sum, cells, low, high`` over the cohort, merged from the buckets; no cell is read."""
    return _stored(spark, path, "totals", _TOTALS).where("cells > 0").groupBy(*_FEATURE).agg(
        F.sum("sum").alias("sum"), F.sum("cells").alias("cells"), F.min("low").alias("low"), F.max("high").alias("high")
    )
