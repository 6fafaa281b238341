"""Readers of FASTA and FASTQ, and a FASTA writer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from abundix.functions.references import add_length_annotation
from abundix.sources.text import base_name


def read_fasta(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``id`` (header up to the first blank), ``header`` and the joined ``sequence``."""
    records = spark.read.option("lineSep", "\n>").text(path).select(
        F.regexp_replace("value", "^>", "").alias("record"),
        F.col("_metadata.file_path").alias("file"),
    )
    header = F.trim(F.regexp_replace(F.substring_index("record", "\n", 1), "\r$", ""))
    body = F.when(F.instr("record", "\n") > 0, F.expr("substring(record, instr(record, '\n') + 1)")).otherwise("")
    return (
        records.withColumn("header", header)
        .withColumn("sequence", F.regexp_replace(body, r"\s", ""))
        .where(F.length("header") > 0)
        .select(F.substring_index("header", " ", 1).alias("id"), "header", "sequence", base_name("file").alias("source"))
    )


def read_fastq(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``id`` and ``sequence`` of four-line records whose sequence is made of A, C, G, T and N.

    One scan and no shuffle: the text is cut where a line starts with ``@``, which is before every record, and
    before a quality line that happens to start so.  Such a line is a piece of its own, of one line; a record's
    piece goes on with the sequence, and is told by it.  Splits of a file end at the same cuts.
    """
    pieces = spark.read.option("lineSep", "\n@").text(path).select(
        F.split(F.regexp_replace("value", "\r(?=\n|$)", ""), "\n", 3).alias("lines"), F.col("_metadata.file_path").alias("file")
    )
    sequence = F.get("lines", F.lit(1))
    # only the first record of a file still has its sign
    name = F.rtrim(F.regexp_replace(F.get("lines", F.lit(0)), "^@", ""))
    return pieces.where(sequence.rlike("^[ACGTNacgtn]+$")).select(name.alias("id"), sequence.alias("sequence"), base_name("file").alias("source"))


def write_fasta(df: DataFrame, path: str, header: str = "header", sequence: str = "sequence", length: str | None = None) -> None:
    """Two-line records.  ``length`` names a column with the length of the read, to be appended to the id
    as the hit filters read it (``translate_frames`` loses it otherwise).
    """
    name = F.col(header) if length is None else add_length_annotation(header, length)
    df.select(F.concat(F.lit(">"), name, F.lit("\n"), F.col(sequence))).write.mode("errorifexists").text(path)
