"""URL filters: host rules, and a list of keys held as a Bloom filter cascade.

The cascade knows every key it will ever be asked about (the corpus's keys).  Its first filter
encodes the listed keys, the second the unlisted keys that pass the first by mistake, the third the
listed keys that pass the second, and so on until no mistake is left.  A key's answer is the parity of
the first filter that rejects it, so membership is exact over the corpus and needs no join: the
filters are single values of a few bytes per key, checked against ``MAX_WORDS`` before use.  Beyond
that size the key list itself is joined.

A rule is ``(verdict, host, path)``.  It fits its host and all subdomains when the url's path starts with
the rule's; the longest fitting rule wins, of equals the one with the longer host.

Defined cases: a null url, or one without ``://``, has an empty host and path; empty keys are keys like any
other; null listed keys are ignored; an empty list allows everything; repeated rows are judged alike.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from abundix.session import cut_lineage

BITS_PER_KEY = 10
HASHES = 5
MAX_WORDS = 1 << 20


def url_host(url: Column) -> Column:
    rest = F.regexp_extract(url, "^(?s:.*?)://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """(rule, verdict) of the longest rule that fits, or null."""
    order = sorted(rules, key=lambda r: (-len(r[1] + r[2]), -len(r[1]), r[1:]))
    found = [
        F.when(
            ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p)),
            F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict")),
        )
        for verdict, h, p in order
    ]
    return F.coalesce(*found) if found else F.lit(None).cast("struct<rule:string,verdict:string>")


def _positions(key: Column, level: int, bits: int) -> list[Column]:
    first = F.pmod(F.xxhash64(F.lit(2 * level), key), F.lit(bits).cast("long"))
    step = F.pmod(F.xxhash64(F.lit(2 * level + 1), key), F.lit(bits - 1).cast("long")) + 1
    return [F.pmod(first + step * i, F.lit(bits).cast("long")) for i in range(HASHES)]


def bloom_words(count: int) -> int:
    """64-bit words of a filter for so many keys."""
    return -(-count * BITS_PER_KEY // 64) + 1


def bloom_filter(keys: DataFrame, level: int, words: int) -> DataFrame:
    """One row with the filter of ``key`` as an array of 64-bit words; ``words`` is checked by the caller."""
    spots = keys.select(F.explode(F.array(*_positions(F.col("key"), level, words * 64))).alias("spot"))
    spots = spots.select(F.shiftright("spot", 6).alias("word"), F.expr("shiftleft(1L, int(spot & 63))").alias("bit"))
    set_ = spots.groupBy("word").agg(F.bit_or("bit").alias("bits"))
    every = keys.sparkSession.range(words).withColumnRenamed("id", "word")
    full = every.join(set_, "word", "left").select("word", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))
    return full.agg(F.transform(F.sort_array(F.collect_list(F.struct("word", "bits"))), lambda x: x["bits"]).alias("words"))


def bloom_passes(key: Column, level: int, filter_: DataFrame, words: int) -> Column:
    """Whether ``key`` may be among the filter's keys."""
    array = filter_.scalar()
    one = F.lit(1).cast("long")
    tests = [
        F.get(array, F.shiftright(p, 6).cast("int")).bitwiseAND(F.call_function("shiftleft", one, p.bitwiseAND(63).cast("int"))) != 0
        for p in _positions(key, level, words * 64)
    ]
    return reduce(lambda a, b: a & b, tests)


class Cascade:
    """Exact membership over the keys it was built from."""

    def __init__(self, levels: list[tuple[DataFrame, int]], keys: DataFrame | None):
        self.levels, self.keys = levels, keys

    def _passes(self, key: Column, level: int) -> Column:
        return bloom_passes(key, level, *self.levels[level])

    def with_membership(self, rows: DataFrame, key: Column, name: str = "listed") -> DataFrame:
        """``rows`` and whether ``key`` is listed."""
        if self.keys is not None:
            listed = self.keys.where("listed").select(F.col("key").alias("_key"), F.lit(True).alias("_listed"))
            return rows.join(listed, key == F.col("_key"), "left").withColumn(name, F.coalesce("_listed", F.lit(False))).drop("_key", "_listed")
        answer = F.lit(len(self.levels) % 2 == 1)
        for level in reversed(range(len(self.levels))):
            answer = F.when(~self._passes(key, level), F.lit(level % 2 == 1)).otherwise(answer)
        return rows.withColumn(name, answer)


def build_cascade(universe: DataFrame, listed: DataFrame, max_words: int = MAX_WORDS) -> Cascade:
    """``universe`` and ``listed`` have a column ``key``; listed keys outside the universe are never asked about."""
    keys = universe.select("key", F.lit(False).alias("listed"), F.lit(True).alias("known"))
    keys = keys.unionByName(listed.select("key", F.lit(True).alias("listed"), F.lit(False).alias("known"))).where("key is not null")
    keys = keys.groupBy("key").agg(F.max("listed").alias("listed"), F.max("known").alias("known")).where("known")
    keys = cut_lineage(keys.select("key", "listed"))
    inside, outside = keys.where("listed").select("key"), keys.where("not listed").select("key")
    levels: list[tuple[DataFrame, int]] = []
    while n := inside.count():
        words = bloom_words(n)
        if words > max_words:
            return Cascade([], keys)
        levels.append((cut_lineage(bloom_filter(inside, len(levels), words)), words))
        step = Cascade(levels, None)
        mistaken = cut_lineage(outside.where(step._passes(F.col("key"), len(levels) - 1)))
        inside, outside = mistaken, inside
    return Cascade(levels, None)


def judge_urls(
    pages: DataFrame, rules: Sequence[tuple[str, str, str]], listed: Column, page_id: str = "page_id", url: str = "url", max_words: int = MAX_WORDS
) -> DataFrame:
    """Per row: page_id, host, path, rule, verdict, and whether the key (host and path) is listed.

    ``listed`` marks the rows whose keys make up the list.  A url that no rule fits is blocked if its key is listed.
    """
    seen = pages.select(
        F.col(page_id).alias("page_id"), url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path"), F.coalesce(listed, F.lit(False)).alias("_mark")
    )
    key = F.concat("host", "path")
    keys = cut_lineage(seen.groupBy(key.alias("key")).agg(F.max("_mark").alias("mark")))
    cascade = build_cascade(keys.select("key"), keys.where("mark").select("key"), max_words)
    out = cascade.with_membership(seen, key).withColumn("_rule", fitting_rule(F.col("host"), F.col("path"), rules))
    verdict = F.coalesce(F.col("_rule.verdict"), F.when(F.col("listed"), "block").otherwise("allow"))
    return out.select("page_id", "host", "path", F.col("_rule.rule").alias("rule"), verdict.alias("verdict"), "listed")
