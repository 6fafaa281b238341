"""Telling rows apart by a list of their ids without shuffling the others' texts.

A Bloom filter of the listed ids, of bounded size, goes with every task.  Rows that miss it are certainly not
listed and stay where they are; only rows that may be listed need a join.  Beyond the filter's bound (about
6.7 million ids) it lets more and more rows through to the join, which stays exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from abundix.llm import urlfilter
from abundix.session import cut_lineage


def may_be_listed(ids: DataFrame, value: Column) -> Column:
    """Whether ``value`` may be among the single column of ``ids``; never false for one that is."""
    keys = cut_lineage(ids.select(F.xxhash64(F.col(ids.columns[0])).alias("key")))
    words = min(urlfilter.bloom_words(keys.count()), urlfilter.MAX_WORDS)
    filter_ = cut_lineage(urlfilter.bloom_filter(keys, 0, words))
    return urlfilter.bloom_passes(F.xxhash64(value), 0, filter_, words)


def split(rows: DataFrame, ids: DataFrame, value: Column) -> tuple[DataFrame, DataFrame]:
    """The rows whose ``value`` is certainly not in ``ids``, and the others.  Nulls count as a value."""
    maybe = may_be_listed(ids, value)
    return rows.where(~maybe), rows.where(maybe)
