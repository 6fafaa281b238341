"""Building blocks that stay distributed when one group holds much of the data.

A window partitioned by a hot key sorts that whole group in one task.  The helpers
here replace such windows: totals are aggregated (with map-side combine) and joined
back, and ordered prefixes are computed over a range-partitioned sort, where a hot
group spans many partitions and only one row per (partition, group) is shuffled to
work out the offsets.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from abundix.functions.statistics import ordered_bits
from abundix.session import cut_lineage

_MERGE = {"sum": F.sum, "min": F.min, "max": F.max}


def join_on(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner", null_safe: bool = False
) -> DataFrame:
    """Equi-join that keeps the key columns of ``left``; no hint, sizes decide the strategy."""
    if not null_safe:
        return left.join(right, list(keys), how)
    renamed = right
    condition = F.lit(True)
    for i, key in enumerate(keys):
        renamed = renamed.withColumnRenamed(key, f"__k{i}")
        condition = condition & F.col(key).eqNullSafe(F.col(f"__k{i}"))
    return left.join(renamed, condition, how).drop(*[f"__k{i}" for i in range(len(keys))])


def with_group_totals(
    df: DataFrame, keys: Sequence[str], null_safe: bool = False, **aggregates: Column
) -> DataFrame:
    """Attach per-group aggregates to every row without a window over the group."""
    columns = [c.alias(name) for name, c in aggregates.items()]
    if not keys:
        out = df
        for name, c in aggregates.items():
            out = out.withColumn(name, df.agg(c.alias(name)).scalar())
        return out
    return join_on(df, df.groupBy(*keys).agg(*columns), keys, "left", null_safe)


def ordered_prefix(
    df: DataFrame,
    within: Sequence[str],
    order: Sequence[Column],
    value: Column | str,
    function: str = "sum",
    name: str = "prefix",
    inclusive: bool = False,
) -> DataFrame:
    """Running aggregate of ``value`` over the rows that come earlier in its group.

    The rows are range-sorted by (group, order), so a group of any size is spread over
    as many partitions as its share of the data.  The sorted rows are written once;
    per (partition, group) totals are then combined in partition order (at most one
    row per partition and group) and joined back as offsets.
    """
    merge = _MERGE[function]
    value = F.col(value) if isinstance(value, str) else value
    keys = list(within)
    ranged = (
        df.withColumn("_value", value)
        .orderBy(*[F.col(k).asc_nulls_first() for k in keys], *order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_line", F.monotonically_increasing_id())
    )
    rows = cut_lineage(ranged)

    per_part = rows.groupBy("_part", *keys).agg(merge("_value").alias("_part_value"))
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.withColumn("_offset", merge("_part_value").over(earlier)).drop("_part_value")

    last = 0 if inclusive else -1
    local = Window.partitionBy("_part", *keys).orderBy("_line").rowsBetween(Window.unboundedPreceding, last)
    out = rows.withColumn("_local", merge("_value").over(local))
    out = join_on(out, offsets, ["_part", *keys], "left", null_safe=True)
    if function == "sum":
        zero = F.lit(0)
        result = F.coalesce("_offset", zero) + F.coalesce("_local", zero)
    elif function == "min":
        result = F.least("_offset", "_local")
    else:
        result = F.greatest("_offset", "_local")
    return out.withColumn(name, result).drop("_value", "_part", "_line", "_offset", "_local")


def sorted_position(
    df: DataFrame, order: Sequence[Column], within: Sequence[str] = (), name: str = "position"
) -> DataFrame:
    """1-based position of each row in the order of its group."""
    out = ordered_prefix(df, within, order, F.lit(1).cast("long"), "sum", name)
    return out.withColumn(name, F.col(name) + 1)


def distinct_weights(
    df: DataFrame, within: Sequence[str], value: str, weight: Column | None = None
) -> DataFrame:
    """Distinct values per group with their row counts ``n`` and the rows ``before`` them."""
    count = F.count(F.lit(1)) if weight is None else F.sum(weight)
    ties = df.groupBy(*within, value).agg(count.cast("long").alias("n"))
    return ordered_prefix(ties, within, [F.col(value).asc()], "n", "sum", "before")


#: Leading bits of the values that the rounds of a median look at, and how many values are picked from at once.
_MEDIAN_SHIFTS = (52, 39, 26, 13, 0)
_MEDIAN_PICK = 4096


def exact_median(df: DataFrame, within: Sequence[str], value: str, name: str = "median") -> DataFrame:
    """Exact median per group by radix selection: no sort of the rows, and none written.

    The values of a group are counted by their leading bits, in the task that reads them; one row per group and
    prefix is shuffled.  Only the prefix that holds the middle is looked at again, by its next bits, until it
    holds one value or so few that they are picked from a list.  A group of any size never meets in one task.
    """
    keys = list(within)
    rows = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("_v"))
    rows = rows.withColumn("_bits", ordered_bits("_v"))
    low, high = F.floor((F.col("_total") + 1) / 2), F.floor(F.col("_total") / 2) + 1
    found, open_, last = [], None, 0
    for shift in _MEDIAN_SHIFTS:
        if open_ is None:
            counted = rows.groupBy(*keys, F.shiftright("_bits", shift).alias("_prefix"))
            extra = []
        else:
            part = _with_prefix(rows, last, open_.where(F.col("_n") > _MEDIAN_PICK), keys)
            counted = part.groupBy(*keys, F.shiftright("_bits", shift).alias("_prefix"))
            extra = [F.first("_total").alias("_total"), F.first("_before").alias("_start")]
        counted = counted.agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_low"), F.max("_v").alias("_high"), *extra)
        # rows are prefixes here, at most 2^13 per group
        all_of = Window.partitionBy(*keys)
        earlier = all_of.orderBy("_prefix").rowsBetween(Window.unboundedPreceding, -1)
        if open_ is None:
            counted = counted.withColumns({"_total": F.sum("_n").over(all_of), "_start": F.lit(0).cast("long")})
        counted = counted.withColumn("_before", F.col("_start") + F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        end = F.col("_before") + F.col("_n")
        has_low = (F.col("_before") < low) & (low <= end)
        has_high = (F.col("_before") < high) & (high <= end)
        # between two prefixes the middle is the last value of one and the first of the other
        middle = counted.where(has_low | has_high).withColumn(
            "_open", has_low & has_high & (F.col("_low") < F.col("_high"))
        )
        part_of = F.when(has_low & has_high, F.col("_low")).when(has_low, F.col("_high") / 2).otherwise(F.col("_low") / 2)
        middle = cut_lineage(middle.select(*keys, "_prefix", "_n", "_before", "_total", "_open", part_of.alias("_part")))
        found.append(middle.where(~F.col("_open")).groupBy(*keys).agg(F.sum("_part").alias(name)))
        open_, last = middle.where("_open").select(*keys, "_prefix", "_n", "_before", "_total"), shift
        few = open_.where(F.col("_n") <= _MEDIAN_PICK)
        if not few.isEmpty():
            listed = _with_prefix(rows, shift, few, keys).groupBy(*keys).agg(
                F.array_sort(F.collect_list("_v")).alias("_values"), F.first("_total").alias("_total"), F.first("_before").alias("_before")
            )
            at = [F.get("_values", (position - F.col("_before") - 1).cast("int")) for position in (low, high)]
            found.append(listed.select(*keys, ((at[0] + at[1]) / 2.0).alias(name)))
        if open_.where(F.col("_n") > _MEDIAN_PICK).isEmpty():
            break
    return reduce(DataFrame.unionByName, found)


def _with_prefix(rows: DataFrame, shift: int, wanted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows whose leading bits are the wanted ones of their group."""
    return join_on(rows.withColumn("_prefix", F.shiftright("_bits", shift)), wanted, [*keys, "_prefix"], "inner", null_safe=True)
