"""Whole profiles: hits to gene families to reactions to pathways, and cohort reports."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F

from abundix.functions.alignments import ADJUSTED_CPM
from abundix.functions.features import ALL, READS_UNMAPPED, UNGROUPED, UNINTEGRATED, UNMAPPED
from abundix.operators import associations, contributions, hits as hit_ops, pathways as pw, tables
from abundix.operators.ordering import feature_sort, profile_order
from abundix.session import cut_lineage
from abundix.sources.tables import read_feature_table

By = Sequence[str]


def scores_to_table(scores: DataFrame, feature: str, by: By = (), value: str = "score") -> DataFrame:
    """``(bug, feature, score)`` as feature rows; ``all`` is the community level."""
    stratum = F.when(F.col("bug") != ALL, F.col("bug"))
    return scores.select(
        *by,
        F.col(feature).alias("code"),
        F.lit(None).cast("string").alias("name"),
        stratum.alias("stratum"),
        F.col(value).alias("value"),
    )


def _special_row(df: DataFrame, code: str, value, by: By) -> DataFrame:
    none = F.lit(None).cast("string")
    return df.select(*by, F.lit(code).alias("code"), none.alias("name"), none.alias("stratum"), value.alias("value"))


def _unaligned_rows(table: DataFrame, unaligned: int | float | DataFrame, code: str, by: By) -> DataFrame:
    """The unaligned reads of every sample as a special row."""
    if by:
        samples = table.select(*by).distinct()
    else:
        samples = table.sparkSession.range(1).select()
    return _special_row(pw.with_unaligned(samples, unaligned, by), code, F.col("unaligned"), by)


def profile_gene_families(
    hits: DataFrame,
    normalization: str = ADJUSTED_CPM,
    identity: float | None = None,
    evalue: float | None = None,
    query_coverage: float | None = None,
    subject_coverage: float | None = None,
    nucleotide: bool = False,
    unaligned: int | float | DataFrame = 0,
    by: By = (),
    ordered: bool = True,
) -> DataFrame:
    """Filtered, weighted and normalised gene families with their strata.

    The unaligned reads come first, as READS_UNMAPPED and as a plain count.  The scale to a million belongs to the written profile; pathways use the unscaled
    ``gene_scores``.
    """
    kept = hit_ops.filter_hits(hits, identity, evalue, query_coverage)
    if subject_coverage is not None:
        kept = hit_ops.filter_subject_coverage(kept, subject_coverage, nucleotide=nucleotide, by=by)
    scores = cut_lineage(hit_ops.gene_scores(kept, normalization, by))
    return gene_family_table(scores, normalization, unaligned, by, ordered)


def gene_family_table(
    scores: DataFrame,
    normalization: str = ADJUSTED_CPM,
    unaligned: int | float | DataFrame = 0,
    by: By = (),
    ordered: bool = True,
) -> DataFrame:
    """The written profile of ``gene_scores``."""
    if normalization == ADJUSTED_CPM:
        scores = hit_ops.adjusted_cpm(scores, by)
    table = scores_to_table(scores, "gene", by).where(F.col("value") > 0)
    table = table.unionByName(_unaligned_rows(table, unaligned, READS_UNMAPPED, by))
    return profile_order(table, by, (READS_UNMAPPED,)) if ordered else table


def profile_reactions(
    gene_scores: DataFrame,
    reaction_genes: DataFrame | None = None,
    unaligned: int | float | DataFrame = 0,
    digits: int = 10,
    by: By = (),
) -> DataFrame:
    """Reaction abundances with the unaligned reads as UNMAPPED and the unused gene
    abundance as UNGROUPED."""
    gene_scores = cut_lineage(gene_scores)
    reactions = scores_to_table(pw.reaction_scores(gene_scores, reaction_genes, by), "reaction", by)
    unused = pw.unintegrated_genes(gene_scores, reaction_genes, by).withColumn("reaction", F.lit(UNGROUPED))
    unused = scores_to_table(unused, "reaction", by, "unintegrated")
    table = tables.nonzero_at_precision(reactions, digits).unionByName(unused)
    table = table.unionByName(_unaligned_rows(gene_scores, unaligned, UNMAPPED, by))
    return profile_order(table, by, (UNMAPPED, UNGROUPED))


class Profiles(NamedTuple):
    gene_families: DataFrame
    reactions: DataFrame
    pathways: DataFrame


def profile_alignments(
    records: DataFrame,
    translated: DataFrame,
    reaction_genes: DataFrame | None,
    pathway_reactions: DataFrame,
    pathway_nodes: DataFrame | None = None,
    names: DataFrame | None = None,
    nucleotide_identity: float = 0.0,
    nucleotide_subject_coverage: float = 50.0,
    nucleotide_query_coverage: float = 90.0,
    identity: float | None = None,
    evalue: float | None = 1.0,
    query_coverage: float | None = 90.0,
    subject_coverage: float | None = 50.0,
    normalization: str = ADJUSTED_CPM,
    parsimony: bool = True,
    fill_gaps: bool = True,
    by: By = (),
) -> Profiles:
    """From the alignments of a cohort to its three profiles.

    ``records`` are SAM records and ``translated`` hits of the translated search, both with their parsed
    references.  Records that pass the nucleotide filter and hits that pass the translated one are scored
    together; reads aligned by neither are counted per sample and go into every profile.
    """
    columns = [*by, "query", "gene", "bug", "matches", "gene_length", "aligned_length"]
    marked = hit_ops.filter_nucleotide_hits(
        records, nucleotide_identity, nucleotide_subject_coverage, nucleotide_query_coverage, by
    )
    # read for the scores and for the unaligned reads
    marked = cut_lineage(marked.select(*columns, "kept"))
    found = hit_ops.filter_hits(translated, identity, evalue, query_coverage)
    if subject_coverage is not None:
        found = hit_ops.filter_subject_coverage(found, subject_coverage, by=by)
    found = cut_lineage(found.select(*columns))
    hits = marked.where("kept").select(*columns).unionByName(found)
    scores = cut_lineage(hit_ops.gene_scores(hits, normalization, by))
    unaligned = hit_ops.unaligned_reads(marked, found, by=by).groupBy(*by).agg(F.count(F.lit(1)).alias("unaligned"))
    unaligned = cut_lineage(unaligned) if by else unaligned.first()["unaligned"]
    return Profiles(
        gene_family_table(scores, normalization, unaligned, by),
        profile_reactions(scores, reaction_genes, unaligned, by=by),
        profile_pathways(
            scores, reaction_genes, pathway_reactions, pathway_nodes, names, unaligned, parsimony, fill_gaps, by=by
        ),
    )


def pathway_abundance(
    scores: DataFrame,
    pathway_reactions: DataFrame,
    pathway_nodes: DataFrame | None = None,
    fill_gaps: bool = True,
    by: By = (),
) -> tuple[DataFrame, DataFrame]:
    """Abundance per (bug, pathway), and the reaction scores that go with it."""
    if pathway_nodes is None:
        return pw.flat_pathway_abundance(scores, pathway_reactions, by), scores
    keys = pw.key_reactions(pathway_nodes)
    filled = pw.gap_fill(scores, keys, by) if fill_gaps else scores
    return pw.structured_pathway_score(filled, pathway_nodes, by), scores


def profile_pathways(
    gene_scores: DataFrame,
    reaction_genes: DataFrame | None,
    pathway_reactions: DataFrame,
    pathway_nodes: DataFrame | None = None,
    names: DataFrame | None = None,
    unaligned: int | float | DataFrame = 0,
    parsimony: bool = True,
    fill_gaps: bool = True,
    digits: int = 10,
    by: By = (),
) -> DataFrame:
    """Pathway abundances with UNMAPPED and UNINTEGRATED rows, in output order.

    Without ``reaction_genes`` the pathways are defined on genes.
    """
    # each stage is read by several later ones, so it is written once
    gene_scores = cut_lineage(gene_scores)
    reactions = cut_lineage(pw.reaction_scores(gene_scores, reaction_genes, by))
    # written, so that its size is known: a small one is sent to the reactions
    pathway_reactions = cut_lineage(pathway_reactions.select("pathway", "reaction").distinct())
    # unless they are written, scores in pathways are many rows that only follow from few
    tasks = 0 if parsimony else pw.unfolding_tasks(reactions, pathway_reactions)
    selected = pw.select_pathways(reactions, pathway_reactions, parsimony, by=by, tasks=tasks)
    if parsimony:
        # all pathways of the reactions are found again faster than they are read
        selected = cut_lineage(selected)
    abundance, used = pathway_abundance(selected, pathway_reactions, pathway_nodes, fill_gaps, by)
    abundance = cut_lineage(abundance)
    present = pw.present_reactions(used, abundance, by, tasks)
    genes = pw.genes_in_pathways(gene_scores, reaction_genes, present, used, by)
    rest = pw.unmapped_unintegrated(abundance, genes, unaligned, by)

    rows = tables.nonzero_at_precision(scores_to_table(abundance, "pathway", by), digits)
    if names is not None:
        known = names.select(F.col("id").alias("code"), F.col("name").alias("_name"))
        rows = rows.join(known, "code", "left").withColumn("name", F.col("_name")).drop("_name")
    unintegrated = scores_to_table(rest.withColumn("pathway", F.lit(UNINTEGRATED)), "pathway", by, "unintegrated")
    unmapped = _special_row(rest.where(F.col("bug") == ALL), UNMAPPED, F.col("unmapped"), by)
    table = rows.unionByName(unintegrated).unionByName(unmapped)
    return profile_order(table, by, (UNMAPPED, UNINTEGRATED))


def profile_pathway_coverage(
    scores: DataFrame,
    pathway_reactions: DataFrame,
    pathway_nodes: DataFrame | None = None,
    digits: int = 10,
    by: By = (),
) -> DataFrame:
    """Coverage per (bug, pathway) that does not round to zero."""
    if pathway_nodes is None:
        coverage = pw.flat_pathway_coverage(scores, pathway_reactions, by)
    else:
        coverage = pw.structured_pathway_coverage(scores, pathway_nodes, by)
    return tables.nonzero_at_precision(coverage, digits, "coverage")


def associate(
    cells: DataFrame, metadata: DataFrame, kind: str = "categorical", fdr: float = 0.2
) -> DataFrame:
    """Community features associated with a metadatum at the false discovery rate.

    ``cells(feature, sample, value)``, ``metadata(sample, value)``.
    """
    community = cells.where(~F.col("feature").contains("|"))
    if kind == "continuous":
        stats = associations.spearman(community, associations.impute_metadata(metadata))
    elif kind == "categorical":
        stats = associations.kruskal_wallis(community, metadata)
    else:
        raise ValueError(f"unknown kind {kind!r}")
    return associations.fdr_select(associations.bh_qvalues(stats), fdr)


def associate_all(
    cells: DataFrame, metadata: DataFrame, kind: str = "categorical", fdr: float = 0.2
) -> DataFrame:
    """Community features associated with each of many metadata, q-values by metadatum.

    ``metadata(metadatum, sample, value)`` lists every sample for every metadatum.
    """
    community = cells.where(~F.col("feature").contains("|"))
    if kind == "continuous":
        stats = associations.spearman_all(community, associations.impute_all(metadata))
    elif kind == "categorical":
        stats = associations.kruskal_wallis_all(community, metadata)
    else:
        raise ValueError(f"unknown kind {kind!r}")
    return associations.bh_qvalues_by(stats, ["metadatum"]).where(F.col("q_value") <= fdr)


def contribution_table(
    table: DataFrame,
    code: str,
    metadata: DataFrame | None = None,
    genera: bool = False,
    exclude_unclassified: bool = False,
    remove_zeros: bool = True,
    sort: str = "sum",
    listed: DataFrame | None = None,
    taxa: int = 10,
    levels: int = 7,
    scaling: str = "original",
) -> DataFrame:
    """Strata of one feature, ready to be drawn: sample positions, top taxa, scaled values."""
    rows = contributions.focal_feature(table, code, exclude_unclassified)
    if genera:
        rows = rows.withColumn("stratum", F.substring_index("stratum", ".", 1))
        rows = rows.groupBy("stratum", "sample").agg(F.sum("value").alias("value"))
    if remove_zeros:
        rows = contributions.drop_zero_samples(rows)
    rows = cut_lineage(rows)
    order = contributions.order_samples(rows, sort, metadata, listed)
    scaled = contributions.contribution_scaling(contributions.top_taxa(rows, taxa), scaling)
    out = scaled.join(order, "sample")
    if metadata is not None:
        kept = metadata.join(order.select("sample"), "sample", "left_semi")
        level = associations.collapse_rare_levels(kept, levels).select("sample", F.col("value").alias("level"))
        out = out.join(level, "sample", "left")
    return out


def cohort_table(spark: SparkSession, paths: Sequence[str], dense: bool = False) -> DataFrame:
    """Joined feature table of many files, in feature order."""
    return feature_sort(tables.join_tables([read_feature_table(spark, list(paths))], dense))
