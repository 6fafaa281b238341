"""Feature tables in long form: ``code, name, stratum, sample, value``.

A missing (feature, sample) row means 0.  Operators use the sparse rows and work the
zeros into their formulas; only ``densify`` and what needs every cell write them out.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from abundix.functions.features import (
    ALL,
    FEATURE,
    MULTI_NAME_SEP,
    NO_NAME,
    SPECIAL,
    TOP_ORDER,
    UNCLASSIFIED,
    UNGROUPED,
    UNINTEGRATED,
    UNMAPPED,
    genus_of,
    level_of,
    round_to,
)
from abundix.functions.statistics import log_transform
from abundix.operators.scaling import join_on
from abundix.session import cut_lineage

_FEATURE = list(FEATURE)


def drop_special(table: DataFrame, special: Sequence[str] = SPECIAL) -> DataFrame:
    return table.where(~F.col("code").isin(*special))


def split_stratified(table: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stratified rows and community rows."""
    return table.where(F.col("stratum").isNotNull()), table.where(F.col("stratum").isNull())


def nonzero_at_precision(table: DataFrame, digits: int = 10, value: str = "value") -> DataFrame:
    """Drop rows that would be written as zero."""
    return table.where(F.round(value, digits) > 0)


def sample_names(table: DataFrame) -> Column:
    """The sorted sample names (the columns of the table) as one array."""
    return table.select("sample").distinct().agg(F.sort_array(F.collect_list("sample"))).scalar()


def densify(
    table: DataFrame,
    features: DataFrame | None = None,
    keys: Sequence[str] = FEATURE,
    fill: float | None = 0.0,
    samples: DataFrame | None = None,
) -> DataFrame:
    """One row per (feature, sample).  The result is as large as the wide table.

    For output that must hold every cell; no operator works on it.
    """
    keys = list(keys)
    rows = (table if features is None else features).select(*keys).distinct()
    grid = rows.withColumn("sample", F.explode(sample_names(table if samples is None else samples)))
    out = join_on(grid, table.select(*keys, "sample", "value"), [*keys, "sample"], "left", null_safe=True)
    return out if fill is None else out.withColumn("value", F.coalesce("value", F.lit(fill)))


def join_tables(tables: Sequence[DataFrame], dense: bool = False) -> DataFrame:
    """Full outer join of tables: a feature repeated within a sample is summed.

    Tables with a ``source`` column take the source as the sample name when all their
    sample names are equal.
    """
    out = stack_samples(tables)
    if "source" in out.columns:
        out = cut_lineage(out.select(*_FEATURE, "sample", "value", "source"))
        counts = out.agg(F.count_distinct("sample") == 1).scalar()
        out = out.withColumn("sample", F.when(counts, F.col("source")).otherwise(F.col("sample")))
    summed = out.groupBy(*_FEATURE, "sample").agg(F.sum("value").alias("value"))
    return densify(summed) if dense else summed


def stack_samples(tables: Sequence[DataFrame]) -> DataFrame:
    out = tables[0]
    for more in tables[1:]:
        out = out.unionByName(more, allowMissingColumns=True)
    return out


def feature_union(left: DataFrame, right: DataFrame, keys: Sequence[str] = FEATURE) -> DataFrame:
    """Distinct features of two tables."""
    return left.select(*keys).union(right.select(*keys)).distinct()


def rename_features(table: DataFrame, names: DataFrame) -> DataFrame:
    """Attach names from ``names(key, value)``: several joined by ``;``, none gives ``NO_NAME``.

    Names of one id are joined in name order.  Special codes keep their name.
    """
    joined = names.select("key", "value").distinct().groupBy("key").agg(
        F.array_join(F.sort_array(F.collect_list("value")), MULTI_NAME_SEP).alias("_name")
    )
    out = table.join(joined.withColumnRenamed("key", "code"), "code", "left")
    special = F.col("code").isin(*TOP_ORDER)
    name = F.when(special, F.col("name")).otherwise(F.coalesce("_name", F.lit(NO_NAME)))
    return out.withColumn("name", name).select(*table.columns)


def attach_names(df: DataFrame, names: DataFrame, key: str = "code") -> DataFrame:
    """Add ``label``: ``id: name``, or the id alone when it has no name."""
    known = names.select(F.col("id").alias(key), F.col("name").alias("_name"))
    label = F.when(
        F.length("_name") > 0, F.concat_ws(": ", F.col(key), F.col("_name"))
    ).otherwise(F.col(key))
    return df.join(known, key, "left").withColumn("label", label).drop("_name")


def regroup(
    table: DataFrame,
    groups: DataFrame,
    function: str = "sum",
    ungrouped: bool = False,
    protected: Sequence[str] = (UNMAPPED, UNINTEGRATED),
    precision: int | None = None,
) -> DataFrame:
    """Combine features into groups of ``groups(code, group)`` by ``sum`` or ``mean``.

    ``mean`` divides by the member rows of the group's stratum that the table has,
    whether or not they have a value in the sample.  Protected codes map to
    themselves; features without a group go to ``UNGROUPED`` when asked for.
    """
    mapping = groups.select("code", F.col("group").alias("_group"))
    if protected:
        kept = table.select("code").where(F.col("code").isin(*protected)).distinct()
        mapping = mapping.unionByName(kept.withColumn("_group", F.col("code")))
    mapping = mapping.distinct()
    joined = table.join(mapping, "code", "left" if ungrouped else "inner")
    joined = joined.withColumn("_group", F.coalesce("_group", F.lit(UNGROUPED)))
    key = ["_group", "stratum"]
    value = F.sum("value")
    out = joined.groupBy(*key, "sample").agg(value.alias("value"))
    if function == "mean":
        members = joined.select(*key, "code", "name").distinct().groupBy(*key).agg(F.count(F.lit(1)).alias("_members"))
        out = join_on(out, members, key, "left", null_safe=True)
        out = out.withColumn("value", F.col("value") / F.col("_members"))
    elif function != "sum":
        raise ValueError(f"unknown function {function!r}")
    return out.select(
        F.col("_group").alias("code"),
        F.lit(None).cast("string").alias("name"),
        "stratum",
        "sample",
        round_to("value", precision).alias("value"),
    )


def regroup_report(table: DataFrame, groups: DataFrame) -> DataFrame:
    """Features, and those with at least one and at least two groups."""
    pairs = groups.select("code", "group").distinct()
    sizes = pairs.groupBy("code").agg(F.count(F.lit(1)).alias("_groups"))
    per_code = table.select("code").distinct().join(sizes, "code", "left")
    times = F.coalesce("_groups", F.lit(0))
    return per_code.agg(
        F.count(F.lit(1)).alias("features"),
        F.count_if(times >= 1).alias("grouped"),
        F.count_if(times >= 2).alias("grouped_twice"),
    )


def renormalise(
    table: DataFrame,
    units: str = "cpm",
    mode: str = "community",
    special: bool = True,
    special_codes: Sequence[str] = SPECIAL,
) -> DataFrame:
    """Scale each sample to copies per million (``cpm``) or fractions (``relab``).

    ``community`` divides every row by the sample's community total, ``levelwise`` by
    the total of the row's own level.  A zero total divides by 1.
    """
    factor = {"cpm": 1e6, "relab": 1.0}[units]
    rows = table if special else drop_special(table, special_codes)
    rows = rows.withColumn("_level", level_of())
    if mode == "levelwise":
        keys, counted = ["sample", "_level"], rows
    elif mode == "community":
        keys, counted = ["sample"], rows.where(F.col("_level") == 1)
    else:
        raise ValueError(f"unknown mode {mode!r}")
    totals = counted.groupBy(*keys).agg(F.sum("value").alias("_total"))
    total = F.coalesce(F.nullif(F.col("_total"), F.lit(0.0)), F.lit(1.0))
    return (
        rows.join(totals, keys, "left")
        .withColumn("value", F.col("value") / total * factor)
        .select(*table.columns)
    )


def reduce_table(table: DataFrame, function: str = "max") -> DataFrame:
    """One value per feature over all samples; a missing cell counts as 0."""
    samples = table.agg(F.count_distinct("sample")).scalar()
    zero = F.lit(0.0)
    out = table.groupBy(*_FEATURE).agg(
        F.sum("value").alias("_sum"),
        F.min("value").alias("_min"),
        F.max("value").alias("_max"),
        F.count(F.lit(1)).alias("_cells"),
    ).withColumn("_sparse", F.col("_cells") < samples)
    value = {
        "sum": F.col("_sum"),
        "mean": F.col("_sum") / samples,
        "min": F.when(F.col("_sparse"), F.least("_min", zero)).otherwise(F.col("_min")),
        "max": F.when(F.col("_sparse"), F.greatest("_max", zero)).otherwise(F.col("_max")),
    }[function]
    return out.select(*_FEATURE, value.alias("value"))


def max_profile(profile: DataFrame, clade: str = "clade", value: str = "abundance") -> DataFrame:
    """Largest abundance of each clade over all samples."""
    return profile.groupBy(clade).agg(F.max(value).alias(value))


def to_genus_level(table: DataFrame) -> DataFrame:
    """Sum species strata into genera; community rows stay."""
    return (
        table.withColumn("stratum", genus_of())
        .groupBy(*_FEATURE, "sample")
        .agg(F.sum("value").alias("value"))
    )


def expand_cluster(table: DataFrame, clusters: DataFrame, requested: Sequence[str]) -> DataFrame:
    """Rows whose code shares a cluster of ``clusters(key, value)`` with a requested code."""
    wanted = clusters.where(F.col("value").isin(*requested)).select("key").distinct()
    members = clusters.join(wanted, "key", "left_semi").select(F.col("value").alias("code")).distinct()
    return table.join(members, "code", "left_semi")


def rebuild_totals(strata: DataFrame) -> DataFrame:
    """Community rows as sums of the strata, together with the strata.

    Every row counts for its stratum and for the community in one aggregation.
    """
    none = F.lit(None).cast("string")
    return (
        strata.withColumn("stratum", F.explode(F.array("stratum", none)))
        .groupBy(*_FEATURE, "sample")
        .agg(F.sum("value").alias("value"))
    )


class Filled(NamedTuple):
    """A table of every (feature, sample), kept sparse.

    ``cells`` has the cells of the input that are above 0; ``absent(sample, value)`` the value of every other
    cell of a sample.  ``fill_cells`` writes them out.
    """

    cells: DataFrame
    absent: DataFrame


def smooth(table: DataFrame, features: DataFrame, method: str = "laplace") -> Filled:
    """Smoothed values over the grid ``features`` x samples, of which only the real cells are made.

    ``laplace`` adds the sample's smallest positive value to every cell (0 for an
    all-zero sample).  ``witten_bell`` scales seen cells by N / (N + T) and shares the
    rest over the unseen ones.
    """
    seen = F.col("value") > 0
    if method == "laplace":
        per_sample = table.groupBy("sample").agg(
            F.coalesce(F.min(F.when(seen, F.col("value"))), F.lit(0.0)).alias("_absent"), F.lit(1.0).alias("_scale")
        )
        smoothed = F.col("value") + F.col("_absent")
    elif method == "witten_bell":
        features_total = features.select(*_FEATURE).distinct().agg(F.count(F.lit(1))).scalar()
        totals = table.groupBy("sample").agg(F.sum("value").alias("_n"), F.count_if(seen).alias("_t"))
        unseen = features_total - F.col("_t")
        norm = F.when(F.col("_n") + F.col("_t") > 0, F.col("_n") / (F.col("_n") + F.col("_t"))).otherwise(F.lit(0.0))
        epsilon = F.when(unseen > 0, norm * F.col("_t") / unseen).otherwise(F.lit(0.0))
        per_sample = totals.select("sample", epsilon.alias("_absent"), norm.alias("_scale"))
        smoothed = F.col("value") * F.col("_scale")
    else:
        raise ValueError(f"unknown method {method!r}")
    cells = table.where(seen).join(per_sample, "sample").select(*_FEATURE, "sample", smoothed.alias("value"))
    return Filled(cells, per_sample.select("sample", F.col("_absent").alias("value")))


def fill_cells(filled: Filled, features: DataFrame) -> DataFrame:
    """Every (feature, sample) of a sparse table; as large as the wide table, so for writing only."""
    grid = densify(filled.cells, features, fill=None, samples=filled.absent)
    absent = filled.absent.select("sample", F.col("value").alias("_absent"))
    return grid.join(absent, "sample", "left").withColumn("value", F.coalesce("value", "_absent")).drop("_absent")


def paired_tables(rna: DataFrame, dna: DataFrame) -> DataFrame:
    """Both tables aligned on (feature, sample); a missing side is 0."""
    key = [*_FEATURE, "sample"]
    left = rna.select(*key, F.col("value").alias("rna"))
    right = dna.select(*key, F.col("value").alias("dna"))
    zero = F.lit(0.0)
    both = left.unionByName(right, allowMissingColumns=True)
    return both.groupBy(*key).agg(
        F.coalesce(F.sum("rna"), zero).alias("rna"), F.coalesce(F.sum("dna"), zero).alias("dna")
    )


def relative_expression(
    rna: DataFrame,
    dna: DataFrame,
    method: str = "laplace",
    log: bool = False,
    base: float = 2.0,
    stratified: bool = False,
) -> Filled:
    """(RNA / DNA) x (total DNA / total RNA) per feature and sample, after smoothing.

    Features without RNA and DNA in a sample all have the ratio of the smoothed nothing, which is a
    number per sample; community rows of codes without any cell have it too.

    With ``stratified`` the community rows are dropped first and rebuilt from the
    smoothed strata.  Laplace totals include the added amounts, Witten-Bell totals are
    those of the input.
    """
    if stratified:
        rna, dna = split_stratified(rna)[0], split_stratified(dna)[0]
    # each table is read for its features, its totals and its cells
    rna, dna = (cut_lineage(t.select(*_FEATURE, "sample", "value")) for t in (rna, dna))
    features = cut_lineage(feature_union(rna, dna))
    cells = features.agg(F.count(F.lit(1))).scalar() if method == "laplace" else F.lit(0)
    added = F.coalesce(F.min(F.when(F.col("value") > 0, F.col("value"))), F.lit(0.0))
    key = [*_FEATURE, "sample"]
    sides, samples = [], None
    for name, table in (("rna", rna), ("dna", dna)):
        smoothed = smooth(table, features, method)
        sides.append(smoothed.cells.withColumnRenamed("value", name))
        # laplace adds the same amount to every cell of a sample
        totals = table.groupBy("sample").agg((F.sum("value") + added * cells).alias(f"_{name}_total"))
        own = smoothed.absent.withColumnRenamed("value", f"_{name}").join(totals, "sample")
        samples = own if samples is None else samples.join(own, "sample")
    samples = cut_lineage(samples)  # one row per sample

    pairs = sides[0].unionByName(sides[1], allowMissingColumns=True).groupBy(*key).agg(F.max("rna").alias("rna"), F.max("dna").alias("dna"))
    pairs = pairs.join(samples, "sample").withColumns(
        {name: F.coalesce(name, f"_{name}") for name in ("rna", "dna")}
    )
    if stratified:
        # a code's strata without a cell in the sample count with the absent value
        strata = features.groupBy("code", "name").agg(F.count(F.lit(1)).alias("_strata"))
        totals = pairs.groupBy("code", "name", "sample").agg(
            F.sum("rna").alias("rna"), F.sum("dna").alias("dna"), F.count(F.lit(1)).alias("_cells")
        )
        totals = join_on(totals, strata, ["code", "name"], "inner", null_safe=True).join(samples, "sample")
        rest = F.col("_strata") - F.col("_cells")
        totals = totals.withColumns({name: F.col(name) + rest * F.col(f"_{name}") for name in ("rna", "dna")})
        totals = totals.withColumn("stratum", F.lit(None).cast("string")).drop("_strata", "_cells")
        pairs = pairs.unionByName(totals)
    scale = F.try_divide(F.col("_dna_total"), F.col("_rna_total"))

    def ratio(one: str, other: str) -> Column:
        value = F.try_divide(scale * F.col(one), F.col(other))
        return (log_transform(value, base) if log else value).alias("value")

    return Filled(pairs.select(*key, ratio("rna", "dna")), samples.select("sample", ratio("_rna", "_dna")))


def strain_profiles(
    table: DataFrame,
    min_mean: float = 10.0,
    min_count: int = 500,
    prevalence: tuple[float, float] = (1e-10, 1.0),
    min_samples: int = 2,
    name: str | None = None,
) -> DataFrame:
    """Rows of each species that vary between the samples where it is well covered.

    A sample counts for a species with at least ``min_count`` nonzero genes whose mean
    is at least ``min_mean``.  Genes are kept whose share of nonzero values among those
    samples lies in ``prevalence``; a species needs ``min_samples`` such samples.
    """
    species = F.get(F.split("stratum", r"\."), F.lit(1))
    rows = table.where(F.col("stratum").isNotNull() & (F.col("stratum") != UNCLASSIFIED))
    rows = rows.withColumn("species", species).where(F.col("species").isNotNull())
    if name is not None:
        rows = rows.where(F.col("species").contains(name))
    # read for the choice of samples and for their rows
    rows = cut_lineage(rows)
    nonzero = F.when(F.col("value") > 0, F.col("value"))
    samples = (
        rows.groupBy("species", "sample")
        .agg(F.count(nonzero).alias("_count"), F.avg(nonzero).alias("_mean"))
        .where((F.col("_count") >= min_count) & (F.col("_mean") >= min_mean))
        .select("species", "sample")
    )
    samples = cut_lineage(samples)
    counts = samples.groupBy("species").agg(F.count(F.lit(1)).alias("_samples"))
    counts = counts.where(F.col("_samples") >= min_samples)
    covered = cut_lineage(rows.join(samples, ["species", "sample"], "left_semi").join(counts, "species"))
    gene = ["species", "code", "name", "stratum"]
    share = F.count(nonzero) / (F.lit(1e-10) + F.first("_samples"))
    genes = covered.groupBy(*gene).agg(share.alias("prevalence"))
    genes = genes.where(F.col("prevalence").between(*prevalence))
    return join_on(covered.drop("_samples"), genes, gene, "inner", null_safe=True)


def split_by_sample_rows(
    rows: DataFrame,
    taxonomy: Sequence[str] = ("Kingdom", "Phylum", "Class", "Order", "Family", "Genus", "Species"),
    level: str = "Genus",
    gene: str = "Gene",
    sample: str = "Sample",
    abundance: str = "CountContributedByOTU",
) -> DataFrame:
    """Contribution rows to a feature table: strata from ``level`` down, and community totals.

    An empty taxon (``g__``) is written as ``g__unclassified``; an unreadable abundance is 0.
    """
    ranks = list(taxonomy)[list(taxonomy).index(level):]

    def named(rank: str) -> Column:
        taxon = F.col(rank)
        last = F.element_at(F.split(taxon, "__"), -1)
        return F.when(last == "", F.concat(taxon, F.lit(UNCLASSIFIED))).otherwise(taxon)

    value = F.coalesce(F.col(abundance).try_cast("double"), F.lit(0.0))
    typed = rows.select(
        F.col(gene).alias("code"),
        F.lit(None).cast("string").alias("name"),
        F.concat_ws(".", *[named(rank) for rank in ranks]).alias("stratum"),
        F.col(sample).alias("sample"),
        value.alias("value"),
    )
    strata = typed.withColumn("stratum", F.explode(F.array("stratum", F.lit(None).cast("string"))))
    return strata.where(F.col("stratum").isNull() | (F.col("stratum") != "")).groupBy(*_FEATURE, "sample").agg(
        F.sum("value").alias("value")
    )


def split_by_sample_columns(
    wide: DataFrame, feature: str, taxonomy: str | None = None, taxonomy_index: int | None = None
) -> DataFrame:
    """Wide table to long rows, duplicate features summed.

    With ``taxonomy_index`` the feature is that level of the ``; `` separated
    ``taxonomy`` column; a level that does not exist is an error.
    """
    name = F.col(feature)
    if taxonomy_index is not None:
        levels = F.split(F.col(taxonomy), "; ")
        name = F.coalesce(
            F.try_element_at(levels, F.lit(taxonomy_index + 1 if taxonomy_index >= 0 else taxonomy_index)),
            F.raise_error(F.lit("the taxonomy index is not valid")).cast("string"),
        )
    samples = [c for c in wide.columns if c not in (feature, taxonomy)]
    number = [F.coalesce(F.col(c).try_cast("double"), F.lit(0.0)).alias(c) for c in samples]
    long = wide.select(name.alias("feature"), *number).unpivot("feature", samples, "sample", "value")
    return long.groupBy("feature", "sample").agg(F.sum("value").alias("value"))


def _gene_lists(members: DataFrame) -> DataFrame:
    """``(gene, pathways)`` of members in either form."""
    if "pathways" in members.columns:
        return members.select("gene", "pathways")
    return members.groupBy("gene").agg(F.collect_set("pathway").alias("pathways"))


def unpack_pathways(
    pathways: DataFrame,
    genes: DataFrame,
    pathway_genes: DataFrame,
    pathway_ecs: DataFrame | None = None,
    taxonomy: bool = True,
) -> DataFrame:
    """Pathway rows with the abundance of their genes.

    ``pathways`` and ``genes`` are one-sample (or keyed by sample) feature tables,
    ``pathway_genes(pathway, gene)`` and ``pathway_ecs(pathway, gene)`` the members, or
    the same as one list per gene, ``(gene, pathways)``.
    The gene map is used if any table id is in it, the EC map otherwise.  Rows:
    the community pathway, its strata, and ``pathway|bug|gene`` (without taxonomy:
    ``pathway|gene`` from community gene rows).

    Genes of the same pathways share one list of them.  Each list meets the pathways of an organism once, and the
    genes' values meet what is left of their lists, which is unfolded last: the many rows of the result are neither
    shuffled nor looked up one by one.
    """
    positive = F.col("value") > 0
    ids = (
        genes.where(positive)
        .withColumn("gene", F.explode(F.split("code", ",")))
        .withColumn("bug", F.coalesce("stratum", F.lit(ALL)))
    )
    gene_values = ids.groupBy("gene", "bug", "sample").agg(
        F.sum("value").alias("value"), F.max("name").alias("gene_name")
    )
    members = _gene_lists(pathway_genes)
    if pathway_ecs is not None:
        # read for the choice of the map and for the rows
        gene_values = cut_lineage(gene_values)
        if gene_values.select("gene").join(members, "gene", "left_semi").isEmpty():
            members = _gene_lists(pathway_ecs)
    # read for each level of the rows
    found = cut_lineage(pathways.where(positive).withColumnRenamed("code", "pathway"))
    community = found.where(F.col("stratum").isNull()).select("pathway", "name", "sample", "value")
    listed = community.select("pathway", "sample").distinct()
    text = F.lit(None).cast("string")
    out = community.select(
        "pathway", "name", text.alias("bug"), text.alias("gene"), text.alias("gene_name"), "sample", "value"
    )
    if taxonomy:
        strata = found.where(F.col("stratum").isNotNull()).join(listed, ["pathway", "sample"], "left_semi")
        strata = strata.select("pathway", F.col("stratum").alias("bug"), "sample", "value")
        out = out.unionByName(strata, allowMissingColumns=True)
        holders = strata.drop("value")
    else:
        holders = listed.withColumn("bug", F.lit(ALL))
    # written, so that its size is known when the join is planned
    holders = cut_lineage(holders.select("pathway", "bug", "sample"))
    members = members.select("gene", F.sort_array("pathways").alias("_list"))
    # written, so that a list keeps its number
    lists = cut_lineage(members.select("_list").distinct().withColumn("_at", F.monotonically_increasing_id()))
    gene_lists = members.join(lists, "_list").select("gene", "_at")
    entries = lists.select("_at", F.explode("_list").alias("pathway"))
    kept = entries.join(holders, "pathway").groupBy("_at", "bug", "sample")
    kept = cut_lineage(kept.agg(F.collect_list("pathway").alias("_pathways")))
    unpacked = (
        gene_values.join(gene_lists, "gene")
        .join(kept, ["_at", "bug", "sample"])
        .withColumn("pathway", F.explode("_pathways"))
        .drop("_at", "_pathways")
    )
    if not taxonomy:
        unpacked = unpacked.withColumn("bug", text)
    return out.unionByName(unpacked, allowMissingColumns=True)


def build_gene_map(
    clusters: DataFrame, gene_lengths: DataFrame, organisms: DataFrame
) -> DataFrame:
    """Id mapping (reference, gene, length, bug) from orthology clusters and protein lengths.

    ``clusters(ortholog, entries)`` lists ``organism#gene`` entries, ``gene_lengths(
    organism, gene, length_aa)`` protein lengths; genes without an ortholog are left out.
    An entry claimed by several orthologs takes the last one by name.
    """
    entries = clusters.withColumn("_entry", F.explode("entries")).select(
        F.concat_ws(
            ":",
            F.get(F.split("_entry", "#"), F.lit(0)),
            F.get(F.split("_entry", "#"), F.lit(1)),
        ).alias("_key"),
        "ortholog",
    )
    entries = entries.groupBy("_key").agg(F.max("ortholog").alias("ortholog"))
    keyed = gene_lengths.withColumn("_key", F.upper(F.concat_ws(":", "organism", "gene")))
    named = keyed.join(entries, "_key").join(
        organisms.select("organism", F.col("name").alias("_organism")), "organism", "left"
    )
    return named.select(
        F.concat_ws(":", "organism", "gene").alias("reference"),
        F.col("ortholog").alias("gene"),
        (F.col("length_aa") * 3).alias("length"),
        F.coalesce("_organism", "organism").alias("bug"),
    )
