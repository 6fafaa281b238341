"""Alignments: filters, coverage, weights and gene scores.

``hits`` has the columns ``query, gene, bug, matches, gene_length, aligned_length`` and,
for the filters, ``identity, evalue, q_start, q_end, q_length, s_start, s_end``.
``by`` names extra key columns such as ``sample``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from abundix.functions.alignments import (
    ADJUSTED_CPM,
    COUNTS,
    hit_score,
    match_count,
    normalized_length,
    query_coverage,
)
from abundix.functions.features import ALL, UNCLASSIFIED
from abundix.functions.references import annotated_id, annotated_length

By = Sequence[str]


def apply_id_mapping(df: DataFrame, mapping: DataFrame, reference: str = "reference") -> DataFrame:
    """Mapped gene, length and organism where the reference is mapped, the parsed ones elsewhere."""
    known = mapping.select(
        F.col("reference").alias(reference),
        F.col("gene").alias("_gene"),
        F.coalesce("length", F.lit(0)).alias("_length"),
        F.coalesce("bug", F.lit(UNCLASSIFIED)).alias("_bug"),
    )
    out = df.join(known, reference, "left")
    return out.withColumns(
        {
            "gene": F.coalesce("_gene", "gene"),
            "gene_length": F.when(F.col("_gene").isNotNull(), F.col("_length")).otherwise(F.col("gene_length")),
            "bug": F.when(F.col("_gene").isNotNull(), F.col("_bug")).otherwise(F.col("bug")),
        }
    ).drop("_gene", "_length", "_bug")


def annotate_queries(hits: DataFrame) -> DataFrame:
    """Split a length suffix off the query id and add the number of matches."""
    return hits.withColumns(
        {
            "q_length": annotated_length("query"),
            "query": annotated_id("query"),
            "matches": match_count("identity", "aligned_length"),
        }
    )


def filter_hits(
    hits: DataFrame,
    identity: float | None = None,
    evalue: float | None = None,
    query_coverage_threshold: float | None = None,
) -> DataFrame:
    """Keep hits at or above the identity and coverage and at or below the e-value threshold."""
    out = hits
    if identity is not None:
        out = out.where(F.col("identity") >= identity)
    if evalue is not None:
        out = out.where(F.col("evalue") <= evalue)
    if query_coverage_threshold is not None:
        covered = query_coverage("q_start", "q_end", "q_length")
        out = out.where(covered.isNull() | (covered >= query_coverage_threshold))
    return out


def _islands(intervals: DataFrame, keys: list[str], start: str, stop: str, tile: int, longest: str | None) -> DataFrame:
    """Islands within tiles: ``_tile``, ``island_start``, ``island_stop`` (and the longest ``longest``)."""
    first = F.floor(F.col(start) / tile)
    last = F.floor((F.col(stop) - 1) / tile)
    length = F.lit(None).cast("long") if longest is None else F.col(longest)
    pieces = (
        intervals.where(F.col(stop) > F.col(start))
        .withColumn("_tile", F.explode(F.sequence(first, last)))
        .select(
            *keys,
            "_tile",
            F.greatest(F.col(start), F.col("_tile") * tile).cast("long").alias("_start"),
            F.least(F.col(stop), (F.col("_tile") + 1) * tile).cast("long").alias("_stop"),
            length.alias("_length"),
        )
        .groupBy(*keys, "_tile", "_start")
        .agg(F.max("_stop").alias("_stop"), F.max("_length").alias("_length"))
    )
    ordered = Window.partitionBy(*keys, "_tile").orderBy("_start")
    reach = F.max("_stop").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    opened = pieces.withColumn("_reach", reach).withColumn(
        "_opens", (F.col("_reach").isNull() | (F.col("_start") > F.col("_reach"))).cast("int")
    )
    numbered = opened.withColumn("_island", F.sum("_opens").over(ordered))
    return numbered.groupBy(*keys, "_tile", "_island").agg(
        F.min("_start").alias("island_start"), F.max("_stop").alias("island_stop"), F.max("_length").alias("_length")
    )


def merge_intervals(
    intervals: DataFrame,
    keys: Sequence[str],
    start: str = "s_start",
    stop: str = "s_end",
    tile: int = 65_536,
) -> DataFrame:
    """Islands of the half-open intervals of each key: ``island_start``, ``island_stop``.

    Intervals are cut at fixed tile borders and reduced to the furthest stop per start
    before the shuffle.  A window partition is one tile, so it never holds more than
    ``tile`` rows however many hits a gene has.  Pieces of an island that were cut at a
    border are put together again, one row per tile and border.
    """
    keys = list(keys)
    islands = _islands(intervals, keys, start, stop, tile, None).select(*keys, "_tile", "island_start", "island_stop")
    at_left = F.col("island_start") == F.col("_tile") * tile
    at_right = F.col("island_stop") == (F.col("_tile") + 1) * tile
    # pieces that touch a border continue each other; only those go through a window per key
    inner = islands.where(~at_left & ~at_right).select(*keys, "island_start", "island_stop")
    cut = islands.where(at_left | at_right).select(*keys, "island_start", "island_stop")
    by_start = Window.partitionBy(*keys).orderBy("island_start")
    joined = (
        cut.withColumn("_before", F.lag("island_stop").over(by_start))
        .withColumn("_opens", F.coalesce((F.col("island_start") > F.col("_before")).cast("int"), F.lit(1)))
        .withColumn("_chain", F.sum("_opens").over(by_start))
        .groupBy(*keys, "_chain")
        .agg(F.min("island_start").alias("island_start"), F.max("island_stop").alias("island_stop"))
        .drop("_chain")
    )
    return inner.unionByName(joined)


def subject_coverage(
    hits: DataFrame,
    gene: str = "gene",
    nucleotide: bool = False,
    by: By = (),
    tile: int = 65_536,
) -> DataFrame:
    """Covered positions and percent coverage of each gene that has a valid interval.

    A gene seen with several lengths takes the longest of its valid hits.  Protein mode
    divides the (nucleotide) gene length by three.  The hits are read once.
    """
    keys = [*by, gene]
    out = _islands(hits, keys, "s_start", "s_end", tile, "gene_length").groupBy(*keys).agg(
        F.sum(F.col("island_stop") - F.col("island_start")).alias("covered"), F.max("_length").alias("_length")
    )
    length = F.col("_length") if nucleotide else F.col("_length") / 3
    coverage = F.when(length > 0, F.col("covered") / length * 100.0).otherwise(F.lit(0.0))
    return out.withColumn("coverage", coverage).drop("_length")


def filter_subject_coverage(
    hits: DataFrame, threshold: float, gene: str = "gene", nucleotide: bool = False, by: By = ()
) -> DataFrame:
    """Keep the hits of genes whose coverage reaches the threshold."""
    passed = subject_coverage(hits, gene, nucleotide, by).where(F.col("coverage") >= threshold)
    return hits.join(passed.select(*by, gene), [*by, gene], "left_semi")


def query_weights(hits: DataFrame, by: By = ()) -> DataFrame:
    """Add ``weight``: the hit's share of its query's total score, 1 for a single hit."""
    # a read has few hits, so its total is a window over them: one scan, one shuffle
    same = Window.partitionBy(*by, "query")
    scored = hits.withColumn("_score", hit_score("matches")).withColumns(
        {"_total": F.sum("_score").over(same), "_hits": F.count(F.lit(1)).over(same)}
    )
    share = F.when(F.col("_total") > 0, F.col("_score") / F.col("_total")).otherwise(F.lit(0.0))
    return scored.withColumn(
        "weight", F.when(F.col("_hits") == 1, F.lit(1.0)).otherwise(share)
    ).drop("_score", "_total", "_hits")


def gene_scores(hits: DataFrame, normalization: str = ADJUSTED_CPM, by: By = ()) -> DataFrame:
    """Score per (bug, gene), plus the pseudo-organism ``all``, from weighted hits.

    One aggregation gives both levels: each hit counts once for its organism and once
    for ``all``, and both are combined map-side.  ``Counts`` sums the weights alone.
    """
    weighted = query_weights(hits, by)
    if normalization == COUNTS:
        amount = F.col("weight")
    else:
        amount = F.col("weight") / normalized_length("gene_length", "aligned_length", normalization)
    return (
        weighted.select(*by, "gene", "bug", amount.alias("_amount"))
        .withColumn("bug", F.explode(F.array("bug", F.lit(ALL))))
        .groupBy(*by, "bug", "gene")
        .agg(F.sum("_amount").alias("score"))
    )


def adjusted_cpm(scores: DataFrame, by: By = (), value: str = "score") -> DataFrame:
    """Scale every score by a million over the community total; a zero total gives 0."""
    community = scores.where(F.col("bug") == ALL)
    total = F.sum(value)
    if by:
        out = scores.join(community.groupBy(*by).agg(total.alias("_total")), list(by), "left")
    else:
        out = scores.withColumn("_total", community.agg(total).scalar())
    scaled = F.when(F.col("_total") > 0, F.col(value) / F.col("_total") * 1e6).otherwise(F.lit(0.0))
    return out.withColumn(value, scaled).drop("_total")


def hit_summary(hits: DataFrame, by: By = ()) -> DataFrame:
    """Hits, queries and genes per organism."""
    return hits.groupBy(*by, "bug").agg(
        F.count(F.lit(1)).alias("hits"),
        F.count_distinct("query").alias("queries"),
        F.count_distinct("gene").alias("genes"),
    )


def run_summary(hits: DataFrame, unaligned: int | float = 0, by: By = ()) -> DataFrame:
    """Organisms, genes and the percentage of queries left unaligned."""
    counted = hits.groupBy(*by).agg(
        F.count_distinct("bug").alias("bugs"),
        F.count_distinct("gene").alias("genes"),
        F.count_distinct("query").alias("aligned"),
    )
    reads = F.col("aligned") + F.lit(unaligned)
    return counted.withColumn(
        "percent_unaligned", F.when(reads > 0, F.lit(100.0) * F.lit(unaligned) / reads).otherwise(F.lit(0.0))
    )


def filter_nucleotide_hits(
    records: DataFrame,
    identity: float = 0.0,
    subject_threshold: float = 50.0,
    query_threshold: float = 90.0,
    by: By = (),
) -> DataFrame:
    """Mark aligned SAM records with ``kept``.

    The gene must reach the subject coverage among the records at or above the identity
    threshold, the record itself must lie strictly above it.  The whole read is taken as
    aligned (start 0, stop length - 1), so only an empty alignment can miss the query
    coverage.  Unmapped records are never kept.
    """
    mapped = records.where(~F.col("unmapped"))
    allowed = (
        subject_coverage(filter_hits(mapped, identity), nucleotide=True, by=by)
        .where(F.col("coverage") >= subject_threshold)
        .select(*by, "gene", F.lit(True).alias("_allowed"))
    )
    span = F.abs(F.col("aligned_length") - 1) + 1
    covered = F.when(F.col("aligned_length") > 1, span / F.col("aligned_length") * 100.0)
    kept = (
        ~F.col("unmapped")
        & F.coalesce("_allowed", F.lit(False))
        & (covered.isNull() | (covered >= query_threshold))
        & (F.col("identity") > identity)
    )
    return (
        records.join(allowed, [*by, "gene"], "left")
        .withColumn("kept", F.coalesce(kept, F.lit(False)))
        .drop("_allowed")
    )


def unaligned_reads(
    records: DataFrame,
    translated_hits: DataFrame | None = None,
    query: str = "query",
    kept: str = "kept",
    by: By = (),
) -> DataFrame:
    """Distinct reads with a record that failed, minus the reads aligned by translation.

    A read with one failing and one passing record is both aligned and unaligned.
    """
    keys = [*by, query]
    failed = records.where(~F.col(kept)).select(*keys).distinct()
    if translated_hits is None:
        return failed
    return failed.join(translated_hits.select(*keys), keys, "left_anti")
