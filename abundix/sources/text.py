"""Line-oriented text: lines with their places and ragged rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

TAB = "\t"


def raw_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Lines of one or more (plain, gz or bz2) text files with their file and split."""
    return spark.read.text(path).select(
        F.regexp_replace("value", "\r$", "").alias("line"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
    )


def placed_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Lines with their place ``at`` in their file; places compare in file order.

    A split is read by one task in file order, and a frame keeps its list of splits, so
    places found in one scan can be compared with those of another scan of the frame.
    """
    at = F.struct("block", F.monotonically_increasing_id().alias("id"))
    return raw_lines(spark, path).select("file", "block", at.alias("at"), "line")


def fields(line: Column | str = "line", separator: str = TAB) -> Column:
    return F.split(line, separator)


def base_name(file: Column | str) -> Column:
    """File name without its folder and its last extension."""
    name = F.substring_index(file, "/", -1)
    return F.regexp_replace(F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B"))), r"\.[^.]*$", "")
