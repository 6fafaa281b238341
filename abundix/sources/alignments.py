"""Readers of alignments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from abundix.functions.alignments import (
    cigar_aligned_length,
    cigar_identity,
    cigar_reference_length,
    evalue,
    match_count,
    md_tag,
)
from abundix.session import cut_lineage
from abundix.sources.text import fields, raw_lines

# The columns of both formats, and the SAM flag of an unmapped read.
M8_COLUMNS = (
    "query", "reference", "identity", "aligned_length", "mismatch", "gaps",
    "q_start", "q_end", "s_start", "s_end", "evalue", "bitscore",
)
SAM_COLUMNS = (
    "query", "flag", "reference", "pos", "mapq", "cigar", "rnext", "pnext", "tlen", "sequence", "quality",
)
UNMAPPED_FLAG = 4


def read_hits_m8(spark: SparkSession, path: str | Sequence[str], log_evalue: bool | None = None) -> DataFrame:
    """Hits of 12-column tables.

    Unless told, a file's e-values are taken as powers of ten when one of its ``#`` lines
    has ``log`` in the e-value column.  Unreadable identities and lengths are 0,
    unreadable e-values 1.
    """
    lines = raw_lines(spark, path).where(F.length("line") > 0)
    comment = F.col("line").startswith("#")

    def field(name: str):
        return F.get(fields(), F.lit(M8_COLUMNS.index(name)))

    def number(name: str, kind: str):
        return F.coalesce(field(name).try_cast(kind), F.lit(0).cast(kind)).alias(name)

    parsed = lines.select(
        "file",
        comment.alias("_comment"),
        F.coalesce(field("evalue"), F.lit("")).alias("_evalue"),
        field("query").alias("query"),
        field("reference").alias("reference"),
        number("identity", "double"),
        number("aligned_length", "double"),
        number("mismatch", "int"),
        number("gaps", "int"),
        *[number(c, "int") for c in ("q_start", "q_end", "s_start", "s_end")],
        number("bitscore", "double"),
    )
    log = log_evalue
    if log_evalue is None:
        # the text is read and parsed once; the few comment lines are then found by their mark
        parsed = cut_lineage(parsed)
        logged = parsed.where(F.col("_comment") & F.col("_evalue").contains("log"))
        logged = logged.select("file").distinct().withColumn("_log", F.lit(True))
        parsed = parsed.join(logged, "file", "left").withColumn("_log", F.coalesce("_log", F.lit(False)))
        log = F.col("_log")
    hits = parsed.where(~F.col("_comment")).withColumn("evalue", evalue("_evalue", log))
    return hits.select(*M8_COLUMNS)


def read_hits_sam(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """SAM records without the header lines; ``unmapped`` tells the 0x4 flag.

    Identity, aligned length and the subject interval come from CIGAR and MD tag.
    """
    lines = raw_lines(spark, path).where((F.length("line") > 0) & ~F.col("line").startswith("@"))
    row = lines.select(fields().alias("_f"))
    named = row.select(
        *[F.get("_f", F.lit(i)).alias(name) for i, name in enumerate(SAM_COLUMNS)],
        F.slice("_f", len(SAM_COLUMNS) + 1, F.greatest(F.lit(0), F.size("_f") - len(SAM_COLUMNS))).alias("tags"),
    )
    typed = named.withColumns(
        {c: F.coalesce(F.col(c).try_cast("int"), F.lit(0)) for c in ("flag", "pos", "mapq", "pnext", "tlen")}
    )
    measured = typed.withColumns(
        {
            "unmapped": F.col("flag").bitwiseAND(UNMAPPED_FLAG) != 0,
            "md": md_tag("tags"),
            "aligned_length": cigar_aligned_length("cigar"),
            "s_start": F.col("pos"),
            "s_end": F.col("pos") + cigar_reference_length("cigar"),
        }
    ).withColumn("identity", cigar_identity("cigar", "md"))
    return measured.withColumn("matches", match_count("identity", "aligned_length"))
