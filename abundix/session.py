"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# AQE re-plans joins from measured sizes: small sides are broadcast, hot keys are split.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


_WRITTEN = "_abundix_written"


def apply_conf(spark: SparkSession) -> SparkSession:
    for key, value in RECOMMENDED_CONF.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, or set as the context's checkpoint folder."""
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if not context.getCheckpointDir():
            context.setCheckpointDir(configured)
        return configured
    current = context.getCheckpointDir()
    if current:
        return current
    raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder, in one folder per application."""
    return f"{_application_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _application_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark).rstrip('/')}/abundix-{spark.sparkContext.applicationId}"


def clear(spark: SparkSession) -> None:
    """Remove what this application has written to the shared folder.

    Frames that still read from it can no longer be computed.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(_application_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and go on from the written table.

    The files survive the loss of an executor, later reads prune columns, joins know the
    table's size, and values that depend on the physical layout (partition ids) are fixed
    once.  A frame that is such a table already is given back as it is.
    """
    if getattr(df, _WRITTEN, False):
        return df
    spark = df.sparkSession
    path = scratch_path(spark, "stage")
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    setattr(out, _WRITTEN, True)
    return out
