"""Association of features with sample metadata.

Feature tables stay sparse: samples in which a feature has no row form one block of
tied zeros, whose rank sums follow from the totals.  All statistics are sums over
distinct values, so nothing is collected per feature.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from abundix.functions.features import OTHER
from abundix.functions.statistics import chi2_sf, spearman_p
from abundix.operators.scaling import distinct_weights, join_on, ordered_prefix, sorted_position, with_group_totals
from abundix.session import cut_lineage


def average_rank(df: DataFrame, value: str = "value", within: tuple[str, ...] = (), name: str = "rank") -> DataFrame:
    """Rank of each row in its group, ties sharing their mean rank."""
    keys = list(within)
    # ranks are joined back by value, so the values are computed once
    df = cut_lineage(df)
    blocks = distinct_weights(df, keys, value)
    ranks = blocks.select(
        *keys, value, (F.col("before") + (F.col("n") + 1) / 2.0).alias(name)
    )
    return join_on(df, ranks, [*keys, value], "left", null_safe=True)


def impute_metadata(metadata: DataFrame, allowed: float = 0.2) -> DataFrame:
    """Numeric ``value`` per sample; unreadable ones take the mean of the others.

    More than ``allowed`` unreadable values is an error.
    """
    number = metadata.select("sample", F.col("value").try_cast("double").alias("value"))
    good = number.agg(F.count("value") >= F.count(F.lit(1)) * (1 - allowed)).scalar()
    mean = number.agg(F.avg("value")).scalar()
    checked = F.when(good, F.coalesce("value", mean)).otherwise(
        F.raise_error(F.lit("too many metadata values are not numbers")).cast("double")
    )
    return number.withColumn("value", checked)


def spearman(table: DataFrame, metadata: DataFrame, feature: str = "feature") -> DataFrame:
    """Rank correlation of every feature with a numeric metadatum over all its samples.

    ``table(feature, sample, value)`` holds the cells, ``metadata(sample, value)`` every
    sample.  A constant feature has a null ``rho``.
    """
    ranked = average_rank(metadata.select("sample", F.col("value").alias("meta")), "meta", name="rank")
    ranked = cut_lineage(ranked.select("sample", "rank"))
    # one row: the number of samples and the sums of their ranks and squared ranks
    totals = ranked.agg(
        F.count(F.lit(1)).cast("double"), F.sum("rank"), F.sum(F.col("rank") * F.col("rank"))
    ).first()
    n, rank_sum, squares = (F.lit(float(total or 0)) for total in totals)

    cells = table.join(ranked, "sample")
    seen = cells.groupBy(feature, "value").agg(F.count(F.lit(1)).alias("n"), F.sum("rank").alias("ranks"))
    seen = cut_lineage(seen)
    rest = seen.groupBy(feature).agg(
        (n - F.sum("n")).cast("long").alias("n"), (rank_sum - F.sum("ranks")).alias("ranks")
    )
    zeros = rest.where(F.col("n") > 0).withColumn("value", F.lit(0.0))
    blocks = seen.unionByName(zeros).groupBy(feature, "value").agg(F.sum("n").alias("n"), F.sum("ranks").alias("ranks"))
    blocks = ordered_prefix(blocks, [feature], [F.col("value").asc()], "n", "sum", "before")
    rank = F.col("before") + (F.col("n") + 1) / 2.0
    sums = blocks.withColumn("_rank", rank).groupBy(feature).agg(
        F.sum(F.col("_rank") * F.col("ranks")).alias("_xy"),
        F.sum(F.col("_rank") * F.col("_rank") * F.col("n")).alias("_xx"),
    )
    mean = rank_sum / n
    covariance = F.col("_xy") - n * mean * mean
    spread = F.sqrt((F.col("_xx") - n * mean * mean) * (squares - n * mean * mean))
    rho = F.when(spread > 0, covariance / spread)
    out = sums.select(feature, rho.alias("rho"), n.cast("long").alias("samples"))
    return out.withColumn("p_value", spearman_p("rho", "samples"))


def kruskal_wallis(table: DataFrame, metadata: DataFrame, feature: str = "feature") -> DataFrame:
    """Tie-corrected Kruskal-Wallis H of every feature over the categories of a metadatum.

    A feature with one distinct value has no statistic and is left out.
    """
    levels = metadata.groupBy(F.col("value").alias("level")).agg(F.count(F.lit(1)).alias("_size"))
    levels = cut_lineage(levels)
    # one row: the number of samples and of levels
    totals = levels.agg(F.sum("_size"), F.count(F.lit(1))).first()
    n, level_count = F.lit(float(totals[0] or 0)), F.lit(totals[1]).cast("long")
    cells = table.join(metadata.select("sample", F.col("value").alias("level")), "sample")
    seen = cut_lineage(cells.groupBy(feature, "level", "value").agg(F.count(F.lit(1)).alias("n")))
    missing = seen.groupBy(feature).agg((n - F.sum("n")).cast("long").alias("_ties"))
    ties = (
        seen.groupBy(feature, "value")
        .agg(F.sum("n").alias("_ties"))
        .unionByName(missing.where(F.col("_ties") > 0).withColumn("value", F.lit(0.0)))
        .groupBy(feature, "value")
        .agg(F.sum("_ties").alias("_ties"))
    )
    ties = ordered_prefix(ties, [feature], [F.col("value").asc()], "_ties", "sum", "before")
    ties = ties.withColumn("_rank", F.col("before") + (F.col("_ties") + 1) / 2.0)
    cubes = F.sum(F.pow(F.col("_ties").cast("double"), F.lit(3.0)) - F.col("_ties"))
    per_feature = ties.groupBy(feature).agg(
        (1 - cubes / (n * n * n - n)).alias("_correction"),
        F.max(F.when(F.col("value") == 0, F.col("_rank"))).alias("_zero"),
    )
    # rank sum of a level: its cells, and the tied zeros of its samples without a cell
    present = (
        seen.join(ties.select(feature, "value", "_rank"), [feature, "value"])
        .groupBy(feature, "level")
        .agg(F.sum(F.col("n") * F.col("_rank")).alias("_ranks"), F.sum("n").alias("_present"))
        .join(levels, "level")
        .join(per_feature, feature)
        .withColumn("_zero", F.coalesce("_zero", F.lit(0.0)))
    )
    ranks = F.col("_ranks") + F.col("_zero") * (F.col("_size") - F.col("_present"))
    # a level without any cell holds zeros only: rank sum squared over size = zero^2 * size
    raw = present.groupBy(feature).agg(
        (
            F.sum(ranks * ranks / F.col("_size"))
            + F.first("_zero") * F.first("_zero") * (n - F.sum("_size"))
        ).alias("_sum"),
        F.first("_correction").alias("_correction"),
    )
    h = (12.0 / (n * (n + 1)) * F.col("_sum") - 3 * (n + 1)) / F.col("_correction")
    out = raw.where(F.col("_correction") > 1e-12).select(
        feature, h.alias("h"), level_count.alias("levels")
    )
    return out.withColumn("p_value", chi2_sf("h", F.col("levels") - 1))


def level_means(table: DataFrame, metadata: DataFrame, feature: str = "feature") -> DataFrame:
    """Mean of every feature in each metadata level, absent cells counting 0."""
    sizes = metadata.groupBy(F.col("value").alias("level")).agg(F.count(F.lit(1)).alias("_size"))
    return (
        table.join(metadata.select("sample", F.col("value").alias("level")), "sample")
        .groupBy(feature, "level")
        .agg(F.sum("value").alias("_sum"))
        .join(sizes, "level")
        .select(feature, "level", (F.col("_sum") / F.col("_size")).alias("mean"))
    )


def bh_qvalues(stats: DataFrame, p: str = "p_value", name: str = "feature") -> DataFrame:
    """Benjamini-Hochberg ``q_value``: p * n / rank, then the running minimum from the largest p.

    The tests are sorted and written once.  A rank is a partition's offset and the place in it; the minimum
    over what follows is one of the own partition and one over the later ones, of which there is a row each.
    """
    tests = stats.where(F.col(p).isNotNull()).orderBy(F.col(p).asc(), F.col(name).asc())
    rows = cut_lineage(
        tests.withColumn("_part", F.spark_partition_id()).withColumn("_line", F.monotonically_increasing_id())
    )
    total = rows.agg(F.count(F.lit(1))).scalar()
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"), F.min("_line").alias("_first"))
    parts = parts.withColumn("_rank", F.coalesce(F.sum("_size").over(earlier), F.lit(0)) - F.col("_first") + 1)
    scaled = rows.join(parts.select("_part", "_rank"), "_part")
    scaled = scaled.withColumn("_scaled", F.col(p) * total / (F.col("_rank") + F.col("_line")))
    later = Window.orderBy(F.col("_part").desc()).rowsBetween(Window.unboundedPreceding, -1)
    lowest = scaled.groupBy("_part").agg(F.min("_scaled").alias("_low")).withColumn("_later", F.min("_low").over(later))
    inside = Window.partitionBy("_part").orderBy(F.col("_line").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = scaled.withColumn("_own", F.min("_scaled").over(inside)).join(lowest.select("_part", "_later"), "_part")
    return out.withColumn("q_value", F.least("_own", "_later")).select(*stats.columns, "q_value")


def feature_ranks(table: DataFrame, samples: DataFrame, feature: str = "feature") -> DataFrame:
    """``feature, value, n, rank``: every distinct value of a feature over all ``samples``, the absent cells as zeros."""
    total = samples.agg(F.count(F.lit(1))).scalar()
    seen = cut_lineage(table.join(samples, "sample", "left_semi").groupBy(feature, "value").agg(F.count(F.lit(1)).alias("n")))
    zeros = seen.groupBy(feature).agg((total - F.sum("n")).alias("n")).where(F.col("n") > 0).withColumn("value", F.lit(0.0))
    blocks = seen.unionByName(zeros).groupBy(feature, "value").agg(F.sum("n").alias("n"))
    blocks = ordered_prefix(blocks, [feature], [F.col("value").asc()], "n", "sum", "before")
    return blocks.select(feature, "value", "n", (F.col("before") + (F.col("n") + 1) / 2.0).alias("rank"))


def _ranked_cells(table: DataFrame, metadata: DataFrame, feature: str) -> tuple[DataFrame, DataFrame]:
    """The ranks of the distinct values, and the cells' ranks; both are written and serve all metadata."""
    samples = cut_lineage(metadata.select("sample").distinct())
    blocks = cut_lineage(feature_ranks(table, samples, feature))
    cells = table.join(samples, "sample", "left_semi").join(blocks.select(feature, "value", "rank"), [feature, "value"])
    return blocks, cut_lineage(cells.select(feature, "sample", "rank"))


def _sample_count(metadata: DataFrame, *aggregates: Column) -> DataFrame:
    """Per metadatum its number of samples ``_n``, which has to be that of all."""
    every = metadata.agg(F.count_distinct("sample")).scalar()
    counts = metadata.groupBy("metadatum").agg(F.count(F.lit(1)).alias("_n"), *aggregates)
    odd = F.raise_error(F.lit("a metadatum has not one value for every sample")).cast("long")
    return counts.withColumn("_n", F.when(F.col("_n") == every, F.col("_n")).otherwise(odd).cast("double"))


def impute_all(metadata: DataFrame, allowed: float = 0.2) -> DataFrame:
    """``impute_metadata`` for each ``metadatum`` of ``metadata(metadatum, sample, value)``."""
    number = metadata.select("metadatum", "sample", F.col("value").try_cast("double").alias("value"))
    known = with_group_totals(number, ["metadatum"], _good=F.count("value") >= F.count(F.lit(1)) * (1 - allowed), _mean=F.avg("value"))
    bad = F.raise_error(F.lit("too many metadata values are not numbers")).cast("double")
    value = F.when(F.col("_good"), F.coalesce("value", "_mean")).otherwise(bad)
    return known.select("metadatum", "sample", value.alias("value"))


def spearman_all(table: DataFrame, metadata: DataFrame, feature: str = "feature") -> DataFrame:
    """``spearman`` of every feature with every metadatum of ``metadata(metadatum, sample, value)``.

    The features are ranked once.  A cell meets its sample's rank in each metadatum; absent cells share the
    rank of zero, so the sum over them follows from the metadatum's total.  Every metadatum lists all samples.
    """
    metadata = cut_lineage(metadata.select("metadatum", "sample", F.col("value").cast("double").alias("value")))
    blocks, cells = _ranked_cells(table, metadata, feature)
    ranked = average_rank(metadata, "value", within=("metadatum",), name="_other")
    ranked = cut_lineage(ranked.select("metadatum", "sample", "_other"))
    totals = _sample_count(ranked, F.sum("_other").alias("_sum"), F.sum(F.col("_other") * F.col("_other")).alias("_squares"))
    met = cells.join(ranked, "sample").groupBy(feature, "metadatum").agg(
        F.sum(F.col("rank") * F.col("_other")).alias("_xy"), F.sum("_other").alias("_seen")
    )
    own = blocks.groupBy(feature).agg(
        F.sum(F.col("rank") * F.col("rank") * F.col("n")).alias("_xx"),
        F.coalesce(F.max(F.when(F.col("value") == 0, F.col("rank"))), F.lit(0.0)).alias("_zero"),
    )
    rows = met.join(own, feature).join(totals, "metadatum")
    center = F.col("_sum") * F.col("_sum") / F.col("_n")
    covariance = F.col("_xy") + F.col("_zero") * (F.col("_sum") - F.col("_seen")) - center
    spread = F.sqrt((F.col("_xx") - center) * (F.col("_squares") - center))
    out = rows.select(feature, "metadatum", F.when(spread > 0, covariance / spread).alias("rho"), F.col("_n").cast("long").alias("samples"))
    return out.withColumn("p_value", spearman_p("rho", "samples"))


def kruskal_wallis_all(table: DataFrame, metadata: DataFrame, feature: str = "feature") -> DataFrame:
    """``kruskal_wallis`` of every feature over the levels of every metadatum of ``metadata(metadatum, sample, value)``.

    The features are ranked, and their ties counted, once.  Every metadatum lists all samples.
    """
    metadata = cut_lineage(metadata.select("metadatum", "sample", F.col("value").alias("level")))
    blocks, cells = _ranked_cells(table, metadata, feature)
    counted = _sample_count(metadata, F.count_distinct("level").alias("levels"))
    sizes = metadata.groupBy("metadatum", "level").agg(F.count(F.lit(1)).alias("_size"))
    ties = F.col("n").cast("double")
    own = blocks.groupBy(feature).agg(
        F.sum(ties * ties * ties - ties).alias("_cubes"),
        F.coalesce(F.max(F.when(F.col("value") == 0, F.col("rank"))), F.lit(0.0)).alias("_zero"),
    )
    levels = cells.join(metadata, "sample").groupBy(feature, "metadatum", "level").agg(
        F.sum("rank").alias("_ranks"), F.count(F.lit(1)).alias("_present")
    )
    levels = join_on(levels, sizes, ["metadatum", "level"], "inner", null_safe=True).join(own, feature)
    ranks = F.col("_ranks") + F.col("_zero") * (F.col("_size") - F.col("_present"))
    sums = levels.groupBy(feature, "metadatum").agg(
        F.sum(ranks * ranks / F.col("_size")).alias("_sum"),
        F.sum("_size").alias("_listed"),
        F.first("_zero").alias("_zero"),
        F.first("_cubes").alias("_cubes"),
    )
    rows = sums.join(counted, "metadatum")
    n = F.col("_n")
    # levels without any cell hold zeros only
    total = F.col("_sum") + F.col("_zero") * F.col("_zero") * (n - F.col("_listed"))
    correction = 1 - F.col("_cubes") / (n * n * n - n)
    h = (12.0 / (n * (n + 1)) * total - 3 * (n + 1)) / correction
    out = rows.where(correction > 1e-12).select(feature, "metadatum", h.alias("h"), F.col("levels").cast("long").alias("levels"))
    return out.withColumn("p_value", chi2_sf("h", F.col("levels") - 1))


def bh_qvalues_by(stats: DataFrame, by: Sequence[str], p: str = "p_value", name: str = "feature") -> DataFrame:
    """``bh_qvalues`` within each group of ``by``: a family of tests may be of any size."""
    keys = list(by)
    ranked = sorted_position(stats.where(F.col(p).isNotNull()), [F.col(p).asc(), F.col(name).asc()], keys, "_rank")
    scaled = with_group_totals(ranked, keys, True, _tests=F.count(F.lit(1)))
    value = F.col(p) * F.col("_tests") / F.col("_rank")
    out = ordered_prefix(scaled, keys, [F.col("_rank").desc()], value, "min", "q_value", inclusive=True)
    return out.select(*stats.columns, "q_value")


def fdr_select(stats: DataFrame, fdr: float = 0.2, q: str = "q_value", name: str = "feature") -> DataFrame:
    """Associations with a q-value of at most ``fdr``, smallest first."""
    return stats.where(F.col(q) <= fdr).orderBy(F.col(q).asc(), F.col(name).asc())


def rank_levels(metadata: DataFrame, n: int, value: str = "value") -> DataFrame:
    """The ``n`` commonest levels with their counts and positions (ties by name)."""
    counts = metadata.groupBy(F.col(value).alias("level")).agg(F.count(F.lit(1)).alias("count"))
    top = counts.orderBy(F.col("count").desc(), F.col("level").asc()).limit(n)
    listed = top.agg(
        F.sort_array(F.collect_list(F.struct((-F.col("count")).alias("less"), "level", "count"))).alias("_top")
    )
    return listed.select(F.posexplode("_top").alias("_at", "_level")).select(
        F.col("_level.level").alias("level"), F.col("_level.count").alias("count"), (F.col("_at") + 1).alias("position")
    )


def collapse_rare_levels(metadata: DataFrame, n: int, value: str = "value") -> DataFrame:
    """Keep the ``n`` commonest levels, the others become ``other``."""
    kept = rank_levels(metadata, n, value).select(F.col("level").alias(value), F.lit(True).alias("_kept"))
    out = metadata.join(kept, value, "left")
    return out.withColumn(value, F.when(F.col("_kept"), F.col(value)).otherwise(F.lit(OTHER))).select(*metadata.columns)
