"""Sorting of features, profiles and samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from abundix.functions.features import join_feature, level_of, top_rank
from abundix.operators.scaling import join_on, sorted_position

_SORTS = {
    "level": lambda feature: [F.size(F.split(feature, r"\|")).asc(), feature.asc()],
    "name": lambda feature: [feature.asc()],
    "value": lambda feature: [F.col("value").desc(), feature.asc()],
}


def double_sort(
    df: DataFrame, value: str = "value", name: str = "name", within: Sequence[str] = ()
) -> DataFrame:
    """Number rows by descending value, equal values by ascending name."""
    return sorted_position(df, [F.col(value).desc(), F.col(name).asc()], within)


def profile_order(
    table: DataFrame, within: Sequence[str] = ("sample",), special: Sequence[str] = ()
) -> DataFrame:
    """Line numbers of a profile: special codes, then features by descending community
    value, each followed by its strata by descending value."""
    keys = [*within, "code"]
    community = table.where(F.col("stratum").isNull()).groupBy(*keys).agg(F.sum("value").alias("_community"))
    rank = F.lit(len(special))
    for position, code in enumerate(special):
        rank = F.when(F.col("code") == code, F.lit(position)).otherwise(rank)
    rows = join_on(table, community, keys, "left").withColumns(
        {"_rank": rank, "_community": F.coalesce("_community", F.lit(0.0))}
    )
    order = [
        F.col("_rank").asc(),
        F.col("_community").desc(),
        F.col("code").asc(),
        level_of().asc(),
        F.col("value").desc(),
        F.col("stratum").asc(),
    ]
    return sorted_position(rows, order, within).drop("_rank", "_community")


def sort_by(df: DataFrame, how: str = "name", feature: Column | None = None) -> DataFrame:
    """Order reduced rows by ``level``, ``name`` or ``value`` (descending)."""
    feature = join_feature() if feature is None else feature
    return df.orderBy(*_SORTS[how](feature))


def feature_sort_keys() -> list[Column]:
    """Special codes first, then ``code: name`` and stratum compared as separate parts."""
    return [top_rank().asc(), F.split(join_feature(), r"\|").asc()]


def feature_sort(df: DataFrame) -> DataFrame:
    return df.orderBy(*feature_sort_keys())
