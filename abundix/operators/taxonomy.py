"""Taxonomy trees, profiles and genus filters.

``taxonomy(taxid, name, rank, parent)`` is an adjacency table,
``family_lca(family, <lca columns>)`` gives a taxid per gene family.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from abundix.functions.features import (
    FEATURE,
    UNCLASSIFIED,
    UNMAPPED,
    genus_of,
    simplify_name,
)
from abundix.operators.scaling import ordered_prefix
from abundix.session import cut_lineage

ROOT = "Root"
_FEATURE = list(FEATURE)


def _known_parents(taxonomy: DataFrame, root: str) -> DataFrame:
    """``node, to``: the parent of every node below the root, null where it is the root or unknown."""
    below = taxonomy.where(F.col("taxid") != root)
    known = below.select(F.col("taxid").alias("to")).distinct()
    links = below.select(F.col("taxid").alias("node"), F.col("parent").alias("to"))
    missing = links.join(known, "to", "left_anti").select("node", F.lit(None).cast(links.schema["to"].dataType).alias("to"))
    return cut_lineage(links.join(known, "to").select("node", "to").unionByName(missing))


def _twice(jumps: DataFrame) -> DataFrame:
    """Jumps of twice the length; jumps beyond the root are left out."""
    further = jumps.select(F.col("node").alias("to"), F.col("to").alias("_to"))
    return cut_lineage(jumps.join(further, "to").select("node", F.col("_to").alias("to")))


def lineage(
    taxids: DataFrame, taxonomy: DataFrame, taxid: str = "taxid", root: str = ROOT
) -> DataFrame:
    """Ancestors of each distinct taxid, itself included: ``step, ancestor, rank, name``.

    Pointer doubling: after round k every walk has its first 2^k steps, and jumps of that length give as many
    again in one join.  A tree of any depth takes as many rounds as its depth has binary digits; every round
    is written once.  A walk longer than the tree has nodes is a cycle, and an error.
    """
    nodes = taxonomy.select(F.col("taxid").alias("ancestor"), "rank", "name").where(F.col("ancestor") != root)
    parents = _known_parents(taxonomy, root)
    jumps = parents.where(F.col("to").isNotNull())
    size = parents.count()
    starts = taxids.select(F.col(taxid).alias("taxid")).distinct().select("taxid", F.lit(0).alias("step"), F.col("taxid").alias("ancestor"))
    walks = cut_lineage(starts.join(parents.select(F.col("node").alias("ancestor")).distinct(), "ancestor", "left_semi"))
    length = 1
    while True:
        reach = jumps.select(F.col("node").alias("ancestor"), F.col("to").alias("_to"))
        more = walks.join(reach, "ancestor").select("taxid", (F.col("step") + length).alias("step"), F.col("_to").alias("ancestor"))
        more = cut_lineage(more)
        if more.isEmpty():
            break
        if length >= size:
            raise ValueError("the taxonomy has a cycle")
        walks = cut_lineage(walks.unionByName(more))
        jumps = _twice(jumps)
        length *= 2
    return walks.join(nodes, "ancestor").select("taxid", "step", "ancestor", "rank", "name")


def nearest_ancestor(taxids: DataFrame, taxonomy: DataFrame, wanted: Column, taxid: str = "taxid", root: str = ROOT) -> DataFrame:
    """``taxid, ancestor``: for each distinct taxid the first node for which ``wanted`` holds, from itself upwards.

    Every node points to its parent, a wanted one to itself; pointers are followed twice a round until all have
    come to a wanted node or have left the tree.  No lineage is written out, so the rows are those of the tree.
    """
    held = taxonomy.where(wanted).select(F.col("taxid").alias("node"), F.lit(True).alias("_held")).distinct()
    parents = _known_parents(taxonomy, root)
    links = parents.join(held, "node", "left")
    links = cut_lineage(links.select("node", F.when(F.col("_held"), F.col("node")).otherwise(F.col("to")).alias("to")).where(F.col("to").isNotNull()))
    ends = held.select(F.col("node").alias("to"), "_held")
    size, length = parents.count(), 1
    while True:
        # done once every pointer is at a wanted node; those that leave the tree are dropped on the way
        if links.join(ends, "to", "left_anti").isEmpty():
            break
        if length > size:
            raise ValueError("the taxonomy has a cycle")
        links = _twice(links)
        length *= 2
    asked = taxids.select(F.col(taxid).alias("node")).distinct()
    return asked.join(links, "node").select(F.col("node").alias("taxid"), F.col("to").alias("ancestor"))


def subtree_intervals(taxonomy: DataFrame, root: str = ROOT) -> DataFrame:
    """``taxid, enter, leave``: numbers of the nodes in preorder (siblings by taxid, from 1), and the last number below each.

    ``b`` is ``a`` or below it exactly if ``a.enter <= b.enter <= a.leave``.  Nodes whose parent is the root or
    unknown are the tops; the root itself has no number.  Sizes and numbers come from jumps that double, so
    a tree takes as many rounds as its depth has binary digits, and siblings may be any number.
    """
    parents = _known_parents(taxonomy, root)
    nodes = parents.count()
    sizes = parents.select("node", F.lit(1).cast("long").alias("size"))
    jumps, length = parents.where(F.col("to").isNotNull()), 1
    while not jumps.isEmpty():
        if length > nodes:
            raise ValueError("the taxonomy has a cycle")
        # a node's size within 2^(k+1) steps: within 2^k, and that of the nodes 2^k below it
        gained = jumps.join(sizes, "node").groupBy(F.col("to").alias("node")).agg(F.sum("size").alias("_more"))
        sizes = sizes.join(gained, "node", "left").select("node", (F.col("size") + F.coalesce("_more", F.lit(0))).alias("size"))
        sizes = cut_lineage(sizes)
        jumps, length = _twice(jumps), 2 * length
    placed = ordered_prefix(parents.join(sizes, "node"), ["to"], [F.col("node").asc()], "size", "sum", "before")
    # the number is what lies before on the way from the top: earlier siblings, and one for each ancestor
    sums = cut_lineage(placed.select("node", "to", "size", (F.col("before") + 1).alias("enter")))
    while not (open_ := sums.where(F.col("to").isNotNull())).isEmpty():
        above = sums.select(F.col("node").alias("to"), F.col("to").alias("_to"), F.col("enter").alias("_enter"))
        moved = open_.join(above, "to").select("node", F.col("_to").alias("to"), "size", (F.col("enter") + F.col("_enter")).alias("enter"))
        sums = cut_lineage(sums.where(F.col("to").isNull()).unionByName(moved))
    return sums.select(F.col("node").alias("taxid"), F.col("enter").cast("long").alias("enter"), (F.col("enter") + F.col("size") - 1).cast("long").alias("leave"))


def below(rows: DataFrame, taxonomy: DataFrame, top: str, taxid: str = "taxid", root: str = ROOT) -> DataFrame:
    """The ``rows`` whose taxid is ``top`` or lies below it, by one range test."""
    intervals = cut_lineage(subtree_intervals(taxonomy, root))
    if top == root:
        return rows.join(intervals.select(F.col("taxid").alias(taxid)), taxid, "left_semi")
    span = intervals.where(F.col("taxid") == top).agg(F.struct(F.min("enter").alias("enter"), F.min("leave").alias("leave")).alias("span")).scalar()
    inside = intervals.where(F.col("enter").between(span["enter"], span["leave"])).select(F.col("taxid").alias(taxid))
    return rows.join(inside, taxid, "left_semi")


def rank_label(rank: str, name: Column | str) -> Column:
    """``f__Name`` for a family, and so on."""
    return F.concat(F.lit(rank.lower()[0] + "__"), simplify_name(name))


def taxon_at_rank(taxids: DataFrame, taxonomy: DataFrame, rank: str, taxid: str = "taxid") -> DataFrame:
    """Nearest ancestor (or self) at ``rank`` of each taxid, as ``taxon``."""
    nearest = nearest_ancestor(taxids, taxonomy, (F.col("rank") == rank) & (F.col("taxid") != ROOT), taxid)
    names = taxonomy.select(F.col("taxid").alias("ancestor"), "name")
    return nearest.join(names, "ancestor").select("taxid", rank_label(rank, "name").alias("taxon"))


def unique_genera(taxonomy: DataFrame, genus_rank: str = "Genus") -> DataFrame:
    """Genus names that belong to exactly one taxid."""
    return (
        taxonomy.where(F.col("rank") == genus_rank)
        .groupBy(F.col("name").alias("genus"))
        .agg(F.count(F.lit(1)).alias("_n"), F.min("taxid").alias("taxid"))
        .where(F.col("_n") == 1)
        .select("genus", "taxid")
    )


def taxon_map(
    table: DataFrame,
    taxonomy: DataFrame,
    family_lca: DataFrame,
    rank: str = "Family",
    lca: str = "lca",
    family_marker: str = "UniRef",
) -> DataFrame:
    """Taxon of every gene family and genus stratum in use: ``key, taxon``."""
    families = table.select(F.col("code").alias("key")).where(F.col("code").contains(family_marker)).distinct()
    by_family = families.join(family_lca.select(F.col("family").alias("key"), F.col(lca).alias("taxid")), "key")
    strata = table.select(F.col("stratum").alias("key")).where(F.col("stratum").contains("g__")).distinct()
    strata = strata.withColumn("genus", genus_of("key"))
    if rank == "Genus":
        by_family = cut_lineage(by_family)
        taxa = taxon_at_rank(by_family, taxonomy, rank)
        inferred = strata.select("key", F.col("genus").alias("taxon"))
        return by_family.join(taxa, "taxid").select("key", "taxon").unionByName(inferred)
    by_genus = strata.withColumn("genus", F.replace("genus", F.lit("g__"), F.lit(""))).join(
        unique_genera(taxonomy), "genus"
    )
    keyed = cut_lineage(by_family.select("key", "taxid").unionByName(by_genus.select("key", "taxid")))
    return keyed.join(taxon_at_rank(keyed, taxonomy, rank), "taxid").select("key", "taxon")


def drop_rare_taxa(mapping: DataFrame, threshold: float = 1e-3) -> DataFrame:
    """Drop map entries whose taxon holds less than ``threshold`` of the entries."""
    mapping = cut_lineage(mapping)
    total = mapping.agg(F.count(F.lit(1))).scalar()
    common = mapping.groupBy("taxon").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") / total >= threshold)
    return mapping.join(common.select("taxon"), "taxon", "left_semi").select("key", "taxon")


def infer_taxonomy(
    table: DataFrame, mapping: DataFrame, mode: str = "totals", threshold: float = 1e-3
) -> DataFrame:
    """Replace or add strata by the taxa of ``mapping(key, taxon)``; equal rows are summed.

    ``totals`` keeps community rows and gives each one inferred stratum; ``stratified``
    keeps community rows and relabels the strata; ``unclassified`` turns only the
    unclassified strata into a total and an inferred stratum.  UNMAPPED is left alone.
    """
    if mode not in ("totals", "unclassified", "stratified"):
        raise ValueError(f"unknown mode {mode!r}")
    taxa = drop_rare_taxa(mapping, threshold).withColumnRenamed("key", "_key")
    community = F.col("stratum").isNull()
    unclassified = F.col("stratum") == UNCLASSIFIED
    key = F.when(community | unclassified, F.col("code")).otherwise(F.col("stratum"))
    rows = table.withColumn("_key", key).join(taxa, "_key", "left")
    inferred = F.coalesce("taxon", F.lit(UNCLASSIFIED))
    none = F.lit(None).cast("string")
    own = F.array(F.col("stratum"))
    nothing = F.array().cast("array<string>")
    if mode == "totals":
        strata = F.when(community, F.array(none, inferred)).otherwise(nothing)
    elif mode == "stratified":
        strata = F.when(community, own).otherwise(F.array(inferred))
    else:
        strata = F.when(unclassified, F.array(none, inferred)).otherwise(nothing)
    strata = F.when(F.col("code") == UNMAPPED, own).otherwise(strata)
    return (
        rows.withColumn("stratum", F.explode(strata))
        .groupBy(*_FEATURE, "sample")
        .agg(F.sum("value").alias("value"))
    )


def infer_taxonomy_report(table: DataFrame) -> DataFrame:
    """Strata, and those with a taxon."""
    strata = table.where(F.col("stratum").isNotNull()).select(*_FEATURE).distinct()
    resolved = F.count_if(F.col("stratum") != UNCLASSIFIED)
    return strata.agg(F.count(F.lit(1)).alias("strata"), resolved.alias("resolved")).withColumn(
        "percent", F.when(F.col("strata") > 0, F.lit(100.0) * F.col("resolved") / F.col("strata"))
    )


def expand_lineage(
    table: DataFrame, taxonomy: DataFrame, hidden: Sequence[str] = ("1", "131567"), no_rank: str = "no rank"
) -> DataFrame:
    """Replace species strata (``g__X.s__Y_z``) by ``rank__name|rank__name...``.

    Hidden and unranked nodes are left out; a species that is not in the taxonomy is
    replaced by its plain name.
    """
    species = F.replace(F.regexp_extract("stratum", r"\.s__(.*)$", 1), F.lit("_"), F.lit(" "))
    is_species = F.coalesce(F.col("stratum").startswith("g__") & F.col("stratum").contains(".s__"), F.lit(False))
    rows = table.withColumn("_species", F.when(is_species, species))
    wanted = rows.select(F.col("_species").alias("name")).where(F.col("name").isNotNull()).distinct()
    found = wanted.join(taxonomy.groupBy("name").agg(F.min("taxid").alias("taxid")), "name")
    shown = lineage(found, taxonomy, root="").where(
        ~F.col("ancestor").cast("string").isin(*hidden) & (F.col("rank") != no_rank)
    )
    # at most one entry per tree level, so the list is bounded by the depth of the tree
    entry = F.struct((-F.col("step")).alias("at"), F.concat_ws("__", "rank", "name").alias("label"))
    paths = shown.groupBy("taxid").agg(F.sort_array(F.collect_list(entry)).alias("_path"))
    labels = found.join(paths, "taxid").select(
        F.col("name").alias("_species"), F.array_join(F.col("_path.label"), "|").alias("_label")
    )
    return (
        rows.join(labels, "_species", "left")
        .withColumn("stratum", F.when(is_species, F.coalesce("_label", "_species")).otherwise(F.col("stratum")))
        .select(*table.columns)
    )


def select_clades(profile: DataFrame, read_length: int = 1, threshold: float = 0.5) -> DataFrame:
    """Clades of the profile (``s__`` and ``t__``) with enough coverage.

    ``coverage`` times the read length must reach the threshold.  Gives the clade id (the
    last part of the name) and the species above it.
    """
    name = F.col("clade")
    parts = F.split(name, r"\|")
    return profile.where(
        name.contains("t__") & name.contains("s__") & (F.col("coverage") * read_length >= threshold)
    ).withColumns(
        {
            "clade_id": F.substring_index(F.element_at(parts, -1), "__", -1),
            "species": F.coalesce(F.try_element_at(parts, F.lit(-2)), F.lit("")),
        }
    )


def clade_report(selected: DataFrame) -> DataFrame:
    return selected.agg(
        F.count(F.lit(1)).alias("clades"), F.coalesce(F.sum("abundance"), F.lit(0.0)).alias("abundance")
    )


def select_pangenomes(files: DataFrame, clades: DataFrame, file: str = "file", clade: str = "clade_id") -> DataFrame:
    """File names that hold a chosen clade id followed by ``_``, ignoring case.

    Every piece of a file name that ends before an underscore is a candidate id, so the
    substring test becomes an equi-join; the pieces are bounded by the name's length.
    """
    lowered = F.lower(file)
    ends = F.filter(
        F.sequence(F.lit(2), F.greatest(F.lit(2), F.length(lowered))),
        lambda i: F.substring(lowered, i, F.lit(1)) == "_",
    )
    pieces = F.flatten(
        F.transform(
            ends,
            lambda end: F.transform(
                F.sequence(F.lit(1), end - 1), lambda start: F.substring(lowered, start, end - start)
            ),
        )
    )
    candidates = files.withColumn("_piece", F.explode(F.array_distinct(pieces)))
    wanted = clades.select(F.lower(clade).alias("_piece")).distinct()
    return candidates.join(wanted, "_piece", "left_semi").select(*files.columns).distinct()


def select_genera(profile: DataFrame, threshold: float = 0.01) -> DataFrame:
    """Lower-cased genera of profile rows at or above the abundance threshold."""
    genus = F.regexp_extract("clade", r"(?:^|\|)([^|]*g__[^|]*)", 1)
    return (
        profile.where(F.col("clade").contains("g__") & (F.col("abundance") >= threshold))
        .select(F.lower(F.replace(genus, F.lit("g__"), F.lit(""))).alias("genus"))
        .distinct()
    )


def filter_sequences(
    sequences: DataFrame, genera: DataFrame, id_mapping: DataFrame | None = None, header: str = "header"
) -> DataFrame:
    """Sequences whose header words, or the words of their mapped taxon, name a genus."""
    words = F.col(header)
    rows = sequences
    if id_mapping is not None:
        taxa = id_mapping.select(F.col("reference").alias("id"), F.col("bug").alias("_bug"))
        rows = rows.join(taxa, "id", "left")
        words = F.coalesce("_bug", words)
    worded = rows.withColumn("genus", F.explode(F.array_distinct(F.split(F.lower(words), " "))))
    named = worded.join(genera, "genus", "left_semi").select("id").distinct()
    return sequences.join(named, "id", "left_semi")
