"""Readers and writers of feature tables.

Wide tables exist only at the edges: readers give the long form ``code, name, stratum,
sample, value``, writers pivot it back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from abundix.functions.features import (
    ALL,
    FEATURE,
    READS_UNMAPPED,
    clean_sample_name,
    feature_code,
    join_feature,
    significant,
    split_feature,
)
from abundix.operators.ordering import feature_sort_keys, profile_order
from abundix.session import cut_lineage
from abundix.sources.text import TAB, base_name, fields, placed_lines

_FEATURE = list(FEATURE)


def _cells(lines: DataFrame, header: DataFrame, name: str = "feature") -> DataFrame:
    """Cells of tab separated rows, named by the header line of their file."""
    names = header.select("file", F.posexplode(fields()).alias("_at", "sample")).where(F.col("_at") > 0)
    cells = lines.select(
        "file", F.get(fields(), F.lit(0)).alias(name), F.posexplode(fields()).alias("_at", "_text")
    ).where(F.col("_at") > 0)
    return cells.join(names, ["file", "_at"]).drop("_at")


def read_cells(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``feature, sample, value, source`` of wide tables.

    The header is the last of the leading ``#`` lines, or the first line when there is
    none.  Unreadable values are 0.  ``source`` is the file's base name.
    """
    # the text is read once; of the written lines the head is found by file, block and comment mark alone
    comment = F.col("comment")
    lines = cut_lineage(placed_lines(spark, path).withColumn("comment", F.col("line").startswith("#")))
    # the leading lines are in the first split of a file, where ids are consecutive
    start = lines.where(F.col("block") == 0)
    found = start.groupBy("file").agg(
        F.greatest(F.min(F.when(~comment, F.col("at.id"))) - 1, F.min("at.id")).alias("_header")
    )
    header = start.join(found, "file").where(F.col("at.id") == F.col("_header"))
    below = (F.col("block") > 0) | (F.col("at.id") > F.col("_header"))
    rows = lines.join(found, "file").where(below & (F.length("line") > 0))
    value = F.coalesce(F.col("_text").try_cast("double"), F.lit(0.0))
    return _cells(rows, header).select("feature", "sample", value.alias("value"), base_name("file").alias("source"))


def read_feature_table(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Wide feature tables (tsv, gz, bz2) in long form."""
    return split_feature(read_cells(spark, path)).select(*_FEATURE, "sample", "value", "source")


def read_gene_table(
    spark: SparkSession, path: str | Sequence[str], id_mapping: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Gene scores ``(sample, bug, gene, score)`` and the unmapped reads ``(sample, unmapped)``.

    Rows without a stratum belong to ``all``.  An id mapping overrides gene and organism.
    """
    cells = read_cells(spark, path)
    parts = F.split("feature", r"\|")
    gene, bug = F.get(parts, F.lit(0)), F.coalesce(F.get(parts, F.lit(1)), F.lit(ALL))
    if id_mapping is not None:
        known = id_mapping.select(
            F.col("reference").alias("feature"), F.col("gene").alias("_gene"), F.col("bug").alias("_bug")
        )
        cells = cells.join(known, "feature", "left")
        bug = F.when(F.col("_gene").isNotNull(), F.col("_bug")).otherwise(bug)
        gene = F.coalesce("_gene", gene)
    rows = cells.select("sample", bug.alias("bug"), feature_code(gene).alias("gene"), "value")
    unmapped = F.col("gene") == READS_UNMAPPED
    scores = rows.where(~unmapped).groupBy("sample", "bug", "gene").agg(F.sum("value").alias("score"))
    return scores, rows.where(unmapped).groupBy("sample").agg(F.sum("value").alias("unmapped"))


def read_metadata_table(
    spark: SparkSession, path: str | Sequence[str], last_metadata: str
) -> tuple[DataFrame, DataFrame]:
    """``(sample, key, value)`` metadata and ``(feature, sample, value)`` cells of a table.

    The first line holds the sample names; rows up to ``last_metadata`` are metadata.  A
    table in several files repeats these lines in each.
    """
    lines = cut_lineage(placed_lines(spark, path).where(F.length("line") > 0))
    name = F.get(fields(), F.lit(0))
    found = lines.groupBy("file").agg(
        F.min("at").alias("_header"), F.min(F.when(name == last_metadata, F.col("at"))).alias("_last")
    )
    placed = lines.where(F.length("line") > 0).join(found, "file")
    header = placed.where(F.col("at") == F.col("_header"))
    rows = placed.where(F.col("at") > F.col("_header"))
    cells = _cells(rows.where(F.col("at") <= F.col("_last")), header, "key")
    metadata = cells.select("sample", "key", F.col("_text").alias("value")).distinct()
    values = _cells(rows.where(F.col("at") > F.col("_last")), header)
    number = F.coalesce(F.col("_text").try_cast("double"), F.lit(0.0))
    return metadata, values.select("feature", "sample", number.alias("value"))


def to_wide(table: DataFrame, samples: Sequence[str]) -> DataFrame:
    """One column per given sample, missing cells 0."""
    wide = table.groupBy(*_FEATURE).pivot("sample", list(samples)).agg(F.sum("value"))
    return wide.fillna(0.0, subset=list(samples))


def _write_tsv(df: DataFrame, path: str, partition: str | None = None, header: bool = True) -> None:
    writer = df.write.mode("errorifexists")
    if partition:
        writer = writer.partitionBy(partition)
    # plain text: no quoting, also not of a header that starts with "#"
    options = {"sep": TAB, "header": str(header).lower(), "quote": "", "comment": "\u0001", "emptyValue": ""}
    writer.options(**options).csv(path)


def sample_row(table: DataFrame) -> Column:
    """The sorted sample names, the columns of the wide table, as one array."""
    names = cut_lineage(table.select("sample").distinct().agg(F.sort_array(F.collect_list("sample")).alias("names")))
    return names.scalar()


def wide_rows(table: DataFrame, names: Column, digits: int | None = 6) -> DataFrame:
    """One row per feature with the texts of its cells in the order of ``names``, as an array ``cells``.

    A feature's cells are what its line holds in any case; the plan has no part per sample.
    """
    total = F.sum("value")
    value = total if digits is None else significant(total, digits)
    cells = table.groupBy(*_FEATURE, "sample").agg(value.cast("double").cast("string").alias("text"))
    lines = cells.groupBy(*_FEATURE).agg(F.map_from_entries(F.collect_list(F.struct("sample", "text"))).alias("_cells"))
    texts = F.transform("_names", lambda s: F.coalesce(F.try_element_at("_cells", s), F.lit("0.0")))
    return lines.withColumn("_names", names).select(*_FEATURE, texts.alias("cells"))


def write_feature_table(table: DataFrame, path: str, digits: int | None = 6) -> None:
    """Wide tab separated table in feature order, values to ``digits`` significant digits.

    Every file begins with the header line.
    """
    names = sample_row(table)
    ordered = wide_rows(table, names, digits).orderBy(*feature_sort_keys())
    line = F.concat_ws(TAB, join_feature(), F.array_join("cells", TAB))
    header = F.concat_ws(TAB, F.lit("# Feature"), F.array_join(names, TAB))
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    lines = ordered.select(line.alias("line"), place.alias("place"))
    lines = lines.select(F.explode(F.when(F.col("place") == 0, F.array(header, F.col("line"))).otherwise(F.array("line"))))
    lines.write.mode("errorifexists").text(path)


def write_per_sample(table: DataFrame, path: str) -> None:
    """One folder per sample, named by the cleaned sample name: ``feature<TAB>value`` rows."""
    rows = table.select(
        clean_sample_name("sample").alias("sample_file"), join_feature().alias("# Feature"), "value"
    )
    # rebalancing keeps few files per sample and splits a sample that is too large
    _write_tsv(rows.hint("rebalance", "sample_file"), path, "sample_file")


def write_profile(
    table: DataFrame,
    path: str,
    special: Sequence[str] = (READS_UNMAPPED,),
    stratified: bool = True,
    digits: int = 10,
    header: str = "# Gene Family",
) -> None:
    """Profile in output order: special rows, then features by value with their strata.

    One folder per sample; the files of a folder are in line order.
    """
    rows = table if stratified else table.where(F.col("stratum").isNull())
    ordered = profile_order(rows, ("sample",), special)
    text = F.format_string(f"%.{digits}f", F.col("value").cast("double"))
    # sorted by the folder first, so the writer keeps the line order within a folder
    lines = ordered.withColumn("sample_file", clean_sample_name("sample")).orderBy(
        "sample_file", "sample", "position"
    )
    _write_tsv(lines.select("sample_file", join_feature().alias(header), text.alias("value")), path, "sample_file")
