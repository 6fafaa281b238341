"""Genes to reactions to pathways, pathway abundance and coverage.

Frames: ``gene_scores(bug, gene, score)``, ``reaction_genes(reaction, gene)`` with
duplicates kept, ``pathway_reactions(pathway, reaction)``, and for structured pathways
``pathway_nodes(pathway, node_id, parent_id, depth, join, reaction, is_key)``.
``by`` names extra key columns such as ``sample``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from abundix.functions.features import ALL
from abundix.functions.statistics import chi2_cdf
from abundix.operators import cover
from abundix.operators.scaling import exact_median
from abundix.session import cut_lineage

By = Sequence[str]
AND, OR = "+", ","
#: Scores in pathways that a task sorts at once.
_UNFOLDED = 1 << 20


def harmonic_mean(value: Column | str) -> Column:
    """Aggregate: n over the sum of reciprocals; 0 when empty or when a value is not positive."""
    v = F.col(value) if isinstance(value, str) else value
    reciprocal = F.sum(F.when(v > 0, 1.0 / v))
    return F.when((F.count(v) > 0) & (F.min(v) > 0), F.count(v) / reciprocal).otherwise(F.lit(0.0))


def genes_to_reactions(gene_scores: DataFrame, reaction_genes: DataFrame) -> DataFrame:
    """Join positive gene scores to reactions; a gene listed twice counts twice."""
    pairs = reaction_genes.select("reaction", "gene")
    return gene_scores.where(F.col("score") > 0).join(pairs, "gene")


def reaction_scores(
    gene_scores: DataFrame, reaction_genes: DataFrame | None = None, by: By = ()
) -> DataFrame:
    """Positive score per (bug, reaction).  Without a gene map the genes are the reactions."""
    if reaction_genes is None:
        return gene_scores.where(F.col("score") > 0).withColumnRenamed("gene", "reaction")
    return (
        genes_to_reactions(gene_scores, reaction_genes)
        .groupBy(*by, "bug", "reaction")
        .agg(F.sum("score").alias("score"))
        .where(F.col("score") > 0)
    )


def unintegrated_genes(gene_scores: DataFrame, reaction_genes: DataFrame | None = None, by: By = ()) -> DataFrame:
    """Per organism, the summed score of genes that belong to no reaction; without a gene map, of all genes."""
    outside = gene_scores
    if reaction_genes is not None:
        outside = gene_scores.join(reaction_genes.select("gene"), "gene", "left_anti")
    return outside.groupBy(*by, "bug").agg(F.sum("score").alias("unintegrated"))


def reactions_to_pathways(scores: DataFrame, pathway_reactions: DataFrame) -> DataFrame:
    """Score per (bug, pathway, reaction)."""
    return scores.join(pathway_reactions.select("pathway", "reaction").distinct(), "reaction")


def gap_fill(scores: DataFrame, key_reactions: DataFrame, by: By = ()) -> DataFrame:
    """Fill a single missing key reaction, or raise the lowest one, per (bug, pathway).

    ``key_reactions(pathway, reaction)`` may list a reaction twice; each entry counts.
    One entry missing: it takes the smallest score of the others.  None missing: the
    entry with the lowest score takes the second lowest.  Otherwise nothing changes.
    """
    group = [*by, "bug", "pathway"]
    # a pathway lists few reactions, so its scores and its key entries are small arrays
    listed = key_reactions.groupBy("pathway").agg(F.collect_list("reaction").alias("_listed"))
    listed = listed.select(
        "pathway",
        F.transform(
            F.array_distinct("_listed"),
            lambda r: F.struct(r.alias("reaction"), F.size(F.filter("_listed", lambda x: x == r)).alias("times")),
        ).alias("_listed"),
    )
    rows = scores.groupBy(*group).agg(F.collect_list(F.struct("reaction", "score")).alias("_rows"))
    rows = rows.join(listed, "pathway", "left").withColumn("_listed", F.coalesce("_listed", F.expr("array()").cast(
        "array<struct<reaction:string,times:int>>"
    )))

    def score_of(reaction: Column) -> Column:
        return F.array_max(F.transform(F.filter("_rows", lambda x: x["reaction"] == reaction), lambda x: x["score"]))

    def times(entries: Column) -> Column:
        return F.aggregate(entries, F.lit(0), lambda n, k: n + k["times"])

    rows = rows.withColumn(
        "_keyed",
        F.transform("_listed", lambda k: F.struct(k["reaction"].alias("reaction"), k["times"].alias("times"), score_of(k["reaction"]).alias("score"))),
    ).withColumn("_found", F.filter("_keyed", lambda k: k["score"] > 0))
    rows = rows.withColumn("_low", F.array_min(F.transform("_found", lambda k: k["score"])))
    rows = rows.withColumns(
        {
            "_next": F.array_min(F.transform(F.filter("_found", lambda k: k["score"] > F.col("_low")), lambda k: k["score"])),
            "_gaps": times(F.col("_keyed")) - times(F.col("_found")),
            "_at_low": times(F.filter("_found", lambda k: k["score"] == F.col("_low"))),
        }
    )
    fills_gap = (F.col("_gaps") == 1) & F.col("_low").isNotNull()
    raises = (F.col("_gaps") == 0) & (F.col("_at_low") == 1) & F.col("_next").isNotNull()
    missing = F.filter("_keyed", lambda k: F.coalesce(k["score"] <= 0, F.lit(True)))
    lowest = F.filter("_found", lambda k: k["score"] == F.col("_low"))
    rows = rows.withColumns(
        {
            "_changed": F.when(fills_gap, F.get(missing["reaction"], F.lit(0))).when(raises, F.get(lowest["reaction"], F.lit(0))),
            "_new": F.when(fills_gap, F.col("_low")).when(raises, F.col("_next")),
        }
    )
    others = F.filter("_rows", lambda x: F.col("_changed").isNull() | (x["reaction"] != F.col("_changed")))
    changed = F.when(F.col("_changed").isNotNull(), F.array(F.struct(F.col("_changed").alias("reaction"), F.col("_new").alias("score"))))
    out = F.concat(others, F.coalesce(changed, F.slice(others, 1, 0)))
    return rows.select(*group, F.inline(out))


def key_reactions(pathway_nodes: DataFrame) -> DataFrame:
    """Key (required) entries of each pathway, one row per entry."""
    return pathway_nodes.where(F.col("is_key") & F.col("reaction").isNotNull()).select("pathway", "reaction")


_MEMBER = "struct<required:boolean,value:double>"


def _programs(pathway_nodes: DataFrame) -> DataFrame:
    """One row per pathway: its nodes as the steps of a stack machine.

    ``node_id`` numbers a pathway's nodes in the order of its text, so from the last to the first every
    list comes after all its members: a reaction pushes a value, a list takes as many values off the
    stack as it has members and pushes its own.
    """
    keys = key_reactions(pathway_nodes).distinct().withColumn("_key", F.lit(True))
    members = pathway_nodes.where(F.col("parent_id").isNotNull()).groupBy("pathway", F.col("parent_id").alias("node_id"))
    nodes = pathway_nodes.join(members.agg(F.count(F.lit(1)).cast("int").alias("_members")), ["pathway", "node_id"], "left")
    nodes = nodes.join(keys, ["pathway", "reaction"], "left")
    step = F.struct(
        (-F.col("node_id")).alias("place"),
        "reaction",
        F.coalesce("_key", F.lit(False)).alias("required"),
        (F.col("join") == OR).alias("any"),
        F.coalesce("_members", F.lit(0)).alias("members"),
    )
    return nodes.groupBy("pathway").agg(F.array_sort(F.collect_list(step)).alias("_program"))


def _list_value(members: Column, any_of: Column) -> Column:
    """OR: the largest member.  AND: harmonic mean of the required ones and of the optional ones above their mean."""
    zero = F.lit(0.0)

    def mean(n: Column, inverse: Column) -> Column:
        return F.when(n > 0, n / inverse).otherwise(zero)

    def inverse_sum(values: Column) -> Column:
        return F.aggregate(values, zero, lambda total, m: total + 1.0 / m["value"])

    required = F.filter(members, lambda m: m["required"])
    blocked = F.exists(required, lambda m: m["value"] <= 0)
    # a struct of one value keeps a result from being worked out again wherever it is used
    first = F.transform(F.array(required), lambda r: F.struct(F.size(r).alias("n"), inverse_sum(r).alias("inverse")))
    folded = F.transform(
        first,
        lambda f: F.aggregate(
            F.filter(members, lambda m: ~m["required"] & (m["value"] > mean(f["n"], f["inverse"]))),
            F.struct(f["n"].alias("n"), f["inverse"].alias("inverse")),
            lambda total, m: F.struct((total["n"] + 1).alias("n"), (total["inverse"] + 1.0 / m["value"]).alias("inverse")),
            lambda total: mean(total["n"], total["inverse"]),
        ),
    )
    largest = F.coalesce(F.array_max(F.transform(members, lambda m: m["value"])), zero)
    return F.when(any_of, largest).when(blocked, zero).otherwise(F.get(folded, F.lit(0)))


def structured_pathway_score(
    scores: DataFrame, pathway_nodes: DataFrame, by: By = (), medians: DataFrame | None = None
) -> DataFrame:
    """Evaluate every pathway's AND/OR tree for every organism, in one aggregation whatever the depth.

    OR takes the largest member.  AND takes the harmonic mean of the required members,
    then folds in the optional members above it.  A reaction that is a key entry anywhere
    in its pathway is required everywhere.  With ``medians(bug, median)`` the leaf values
    are first turned into chi-square probabilities (coverage).

    The scores of a pathway's reactions, few however many rows there are, become one map per organism and
    pathway, over which the pathway's nodes run as a program.
    """
    group = [*by, "bug", "pathway"]
    listed = pathway_nodes.where(F.col("reaction").isNotNull()).select("pathway", "reaction").distinct()
    valued = scores.select(*group, "reaction", "score").join(listed.withColumn("_listed", F.lit(True)), ["pathway", "reaction"], "left")
    if medians is not None:
        valued = valued.join(medians, [*by, "bug"], "left").withColumn("score", chi2_cdf("score", "median"))
    entry = F.when(F.col("_listed"), F.struct("reaction", "score"))
    found = valued.groupBy(*group).agg(F.map_from_entries(F.collect_list(entry)).alias("_scores"))

    def run(stack: Column, step: Column) -> Column:
        size = F.size(stack) - step["members"]
        leaf = F.struct(step["required"].alias("required"), F.coalesce(F.try_element_at("_scores", step["reaction"]), F.lit(0.0)).alias("value"))
        members = F.slice(stack, size + 1, step["members"])
        node = F.struct(F.lit(True).alias("required"), _list_value(members, step["any"]).alias("value"))
        pushed = F.when(step["reaction"].isNotNull(), leaf.cast(_MEMBER)).otherwise(node.cast(_MEMBER))
        return F.concat(F.slice(stack, F.lit(1), size), F.array(pushed))

    root = F.aggregate("_program", F.array().cast(f"array<{_MEMBER}>"), run)
    return found.join(_programs(pathway_nodes), "pathway").select(*group, F.get(root, F.lit(0))["value"].alias("score"))


def flat_pathway_abundance(scores: DataFrame, pathway_reactions: DataFrame, by: By = ()) -> DataFrame:
    """Mean of the upper half of a pathway's reaction scores, absent reactions counting 0."""
    group = [*by, "bug", "pathway"]
    sizes = (
        pathway_reactions.select("pathway", "reaction").distinct().groupBy("pathway").agg(F.count(F.lit(1)).alias("_size"))
    )
    # an organism has no more scores in a pathway than the pathway has reactions, so a window holds them
    by_score = Window.partitionBy(*group).orderBy(F.col("score").desc(), F.col("reaction").asc())
    ranked = scores.select(*group, "reaction", "score").withColumn("position", F.row_number().over(by_score))
    upper = F.col("_size") - F.floor(F.col("_size") / 2)
    return (
        ranked.join(sizes, "pathway")
        .where(F.col("position") <= upper)
        .groupBy(*group)
        .agg((F.sum("score") / F.first(upper)).alias("score"))
    )


def median_score(scores: DataFrame, by: By = ()) -> DataFrame:
    """Median over all (pathway, reaction) scores of an organism."""
    return exact_median(scores, [*by, "bug"], "score")


def max_median_score(scores: DataFrame, by: By = ()) -> DataFrame:
    """Median over the largest reaction score of each pathway of an organism."""
    largest = scores.groupBy(*by, "bug", "pathway").agg(F.max("score").alias("score"))
    return exact_median(largest, [*by, "bug"], "score")


def flat_pathway_coverage(scores: DataFrame, pathway_reactions: DataFrame, by: By = ()) -> DataFrame:
    """Share of a pathway's reactions that score above the organism's median."""
    group = [*by, "bug", "pathway"]
    sizes = pathway_reactions.groupBy("pathway").agg(F.count(F.lit(1)).alias("_size"))
    above = F.sum((F.col("score") > F.col("median")).cast("int"))
    return (
        scores.join(median_score(scores, by), [*by, "bug"])
        .groupBy(*group)
        .agg(above.alias("_above"))
        .join(sizes, "pathway")
        .select(*group, (F.col("_above") / F.col("_size")).alias("coverage"))
    )


def structured_pathway_coverage(scores: DataFrame, pathway_nodes: DataFrame, by: By = ()) -> DataFrame:
    """Tree score over chi-square probabilities of the gap-filled reaction scores."""
    medians = median_score(scores, by)
    filled = gap_fill(scores, key_reactions(pathway_nodes), by)
    return structured_pathway_score(filled, pathway_nodes, by, medians).withColumnRenamed("score", "coverage")


def present_reactions(
    scores: DataFrame, pathway_abundance: DataFrame, by: By = (), tasks: int = 0
) -> DataFrame:
    """Distinct reactions with a score in the pathways an organism has, per organism.

    Scores that are dealt out to ``tasks`` by organism already are not dealt out again: a reaction's pathways meet the
    list of those that its organism has.
    """
    keys, group = [*by, "bug"], [*by, "bug", "pathway"]
    found = pathway_abundance.where(F.col("score") > 0).select(*group)
    scored = scores.where(F.col("score") > 0)
    if not tasks:
        return scored.join(found, group, "left_semi").select(*keys, "reaction").distinct()
    listed = scored.groupBy(*keys, "reaction").agg(F.collect_set("pathway").alias("_owners"))
    held = found.repartition(tasks, *keys).groupBy(*keys).agg(F.collect_set("pathway").alias("_held"))
    return listed.join(held, keys).where(F.arrays_overlap("_owners", "_held")).select(*keys, "reaction")


def genes_in_pathways(
    gene_scores: DataFrame,
    reaction_genes: DataFrame | None,
    reactions_present: DataFrame,
    bugs: DataFrame,
    by: By = (),
) -> DataFrame:
    """Per organism with pathways: score of the distinct genes behind them, and the rest.

    Without a gene map the reactions are genes.  With one, each scored gene looks its own reactions up: the work
    follows the scored genes, not all the genes of an organism's reactions.
    """
    keys = [*by, "bug"]
    if reaction_genes is None:
        genes = reactions_present.select(*keys, F.col("reaction").alias("gene")).distinct()
        inside = gene_scores.join(genes, [*keys, "gene"], "left_semi")
    else:
        # written, so that its size is known: reactions are few, so rows are not dealt out by reaction
        present = cut_lineage(reactions_present.select(*keys, "reaction").distinct())
        pairs = reaction_genes.select("reaction", "gene").distinct()
        # one shuffle, by gene; a gene with several present reactions counts once
        scored = gene_scores.where(F.col("gene").isNotNull()).select(*keys, "gene", "score").repartition("gene")
        scored = scored.groupBy(*keys, "gene").agg(F.sum("score").alias("score"))
        found = scored.join(pairs, "gene").join(present, [*keys, "reaction"], "left_semi")
        inside = found.groupBy(*keys, "gene").agg(F.max("score").alias("score"))
    within = inside.groupBy(*keys).agg(F.sum("score").alias("_in"))
    totals = gene_scores.groupBy(*keys).agg(F.sum("score").alias("_sum"))
    zero = F.lit(0.0)
    return (
        bugs.select(*keys)
        .distinct()
        .join(totals, keys, "left")
        .join(within, keys, "left")
        .select(
            *keys,
            F.coalesce("_in", zero).alias("in_pathways"),
            (F.coalesce("_sum", zero) - F.coalesce("_in", zero)).alias("remaining"),
        )
    )


def with_unaligned(df: DataFrame, unaligned: int | float | DataFrame = 0, by: By = ()) -> DataFrame:
    """Add ``unaligned`` reads: one number, or a frame ``(*by, unaligned)`` for many samples."""
    if not isinstance(unaligned, DataFrame):
        return df.withColumn("unaligned", F.lit(float(unaligned)))
    counts = unaligned.select(*by, F.col("unaligned").cast("double").alias("unaligned"))
    return df.join(counts, list(by), "left").withColumn("unaligned", F.coalesce("unaligned", F.lit(0.0)))


def unmapped_unintegrated(
    pathway_abundance: DataFrame,
    gene_abundance: DataFrame,
    unaligned: int | float | DataFrame = 0,
    by: By = (),
) -> DataFrame:
    """Compression, unintegrated and (for ``all``) unmapped amount per organism.

    Compression is total pathway abundance over the gene abundance in pathways, 0 when
    there is none.
    """
    keys = [*by, "bug"]
    totals = pathway_abundance.where(F.col("score") > 0).groupBy(*keys).agg(F.sum("score").alias("_pathways"))
    compression = F.when(F.col("in_pathways") != 0, F.col("_pathways") / F.col("in_pathways")).otherwise(F.lit(0.0))
    zero = F.lit(0.0)
    return (
        with_unaligned(totals.join(gene_abundance, keys, "left"), unaligned, by)
        .withColumn("compression", F.coalesce(compression, zero))
        .select(
            *keys,
            "compression",
            (F.col("compression") * F.coalesce("remaining", zero)).alias("unintegrated"),
            F.when(F.col("bug") == ALL, F.col("compression") * F.col("unaligned")).alias("unmapped"),
        )
    )


def parsimonious_pathways(scores: DataFrame, pathway_reactions: DataFrame, by: By = ()) -> DataFrame:
    """The smallest set of pathways per organism that covers all its reactions.

    Of several smallest sets the one whose pathways come first by number of observed reactions, then
    name.  See :func:`pathway_cover` for the search and its limit.
    """
    return pathway_cover(scores, pathway_reactions, by).drop("proven")


def pathway_cover(scores: DataFrame, pathway_reactions: DataFrame, by: By = (), limit: int = cover.SEARCH_LIMIT) -> DataFrame:
    """Smallest covers with ``proven``: whether the search of the organism ended within ``limit``.

    Reactions with one owner, reactions and pathways that others stand for are settled first; what is left
    falls into components, which are searched by branch and bound.  An unproven cover is never larger
    than the greedy one.
    """
    return cover.organism_covers(scores, pathway_reactions, [*by, "bug"], lambda masks: cover.smallest(masks, limit))


def greedy_pathways(scores: DataFrame, pathway_reactions: DataFrame, by: By = ()) -> DataFrame:
    """A cover per organism without search: sole owners of a reaction, then always the pathway with the most
    uncovered reactions, ties by the number of observed reactions, then by name."""
    chosen = cover.organism_covers(scores, pathway_reactions, [*by, "bug"], lambda masks: (cover.greedy(masks), False))
    return chosen.drop("proven")


def well_supported_pathways(
    scores: DataFrame, pathway_reactions: DataFrame, share: float = 0.5, by: By = ()
) -> DataFrame:
    """Pathways with at least ``share`` of their distinct reactions observed."""
    # written, so that its size is known: a small one is sent to the scores, which are shuffled once, by organism
    members = cut_lineage(pathway_reactions.select("pathway", "reaction").distinct())
    sizes = members.groupBy("pathway").agg(F.count(F.lit(1)).alias("_size"))
    return (
        scores.select(*by, "bug", "reaction")
        .repartition(*by, "bug")
        .distinct()
        .join(members, "reaction")
        .groupBy(*by, "bug", "pathway")
        .agg(F.count(F.lit(1)).alias("_observed"))
        .join(sizes, "pathway")
        .where(F.col("_observed") >= F.col("_size") * share)
        .select(*by, "bug", "pathway")
    )


def add_well_supported(
    chosen: DataFrame, scores: DataFrame, pathway_reactions: DataFrame, share: float = 0.5, by: By = ()
) -> DataFrame:
    return chosen.unionByName(well_supported_pathways(scores, pathway_reactions, share, by)).distinct()


def unfolding_tasks(scores: DataFrame, pathway_reactions: DataFrame) -> int:
    """To how many tasks scores are dealt out, so that each can sort its own once they are unfolded into their pathways."""
    owners = pathway_reactions.groupBy("reaction").agg(F.count(F.lit(1)).alias("_n"))
    unfolded = scores.groupBy("reaction").agg(F.count(F.lit(1)).alias("_scores")).join(owners, "reaction")
    rows = unfolded.agg(F.sum(F.col("_scores") * F.col("_n"))).first()[0] or 0
    return max(int(scores.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // _UNFOLDED))


def select_pathways(
    scores: DataFrame,
    pathway_reactions: DataFrame,
    parsimony: bool = True,
    more_than: int = 3,
    by: By = (),
    tasks: int = 0,
) -> DataFrame:
    """Score per (bug, pathway, reaction) of the selected pathways.

    An organism with more than ``more_than`` reactions keeps the parsimonious and the
    well supported pathways, any other keeps every pathway of its reactions.  Without ``parsimony`` the scores
    are dealt out to ``tasks`` by organism, if any are named, before they are unfolded into their pathways.
    """
    if not parsimony:
        dealt = scores.repartition(tasks, *by, "bug") if tasks else scores
        return reactions_to_pathways(dealt, pathway_reactions)
    # read for the counts, the covers, the support and the rows
    scores = cut_lineage(scores)
    pathway_reactions = cut_lineage(pathway_reactions.select("pathway", "reaction").distinct())
    keys = [*by, "bug"]
    many = scores.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > more_than).select(*keys)
    large = scores.join(many, keys, "left_semi")
    chosen = add_well_supported(parsimonious_pathways(large, pathway_reactions, by), large, pathway_reactions, by=by)
    # a score meets its organism's choice before it is unfolded into its pathways, so only scores are shuffled
    owned = pathway_reactions.where(F.col("reaction").isNotNull()).groupBy("reaction")
    owned = cut_lineage(owned.agg(F.collect_set(F.struct("pathway")).alias("_owners")))
    kept = chosen.groupBy(*keys).agg(F.collect_set("pathway").alias("_chosen"))
    choices = cut_lineage(many.join(kept, keys, "left").select(*keys, F.lit(True).alias("_many"), "_chosen"))
    rest = [c for c in scores.columns if c not in (*keys, "reaction")]

    def selected(owner: Column) -> Column:
        return F.col("_many").isNull() | F.coalesce(F.array_contains("_chosen", owner["pathway"]), F.lit(False))

    return (
        scores.join(choices, keys, "left")
        .join(owned, "reaction")
        .select(*keys, F.inline(F.filter("_owners", selected)), "reaction", *rest)
    )
