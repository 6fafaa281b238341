"""Mixing sources to target weights by min-cost flow.

A document can belong to several sources.  Documents are aggregated by membership pattern (their
set of sources); a pattern's words are its capacity, once per repetition.  Words flow from patterns
to the sources' targets; the first pass over a pattern is cheap and every further one dearer
(convex costs), so repetition is spread as evenly as the targets allow.  The flow says how often a
pattern is taken: whole passes, and for the rest documents in the order of a seeded hash, up to the
document that no longer fits, and one more that fills the gap best.

The flow network has a node per pattern and source; both are counted, and more than
``MAX_PATTERNS`` patterns are refused.  Documents never leave the executors: the hash value where a
pattern's pass stops is found from sums per hash range, refined twice, so no group is sorted in one
task.

Defined cases: null text has size 0; a document without sources belongs to the source null; rows
equal in id and text are taken together; sources of size 0 get target 0; an empty table gives no rows.
"""

from __future__ import annotations

import json
from collections import defaultdict, deque
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from abundix.session import cut_lineage

MAX_PATTERNS = 10_000
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_REPEATS = 2
_CELL_BITS = 12

_PLAN = "pattern string, source_size long, target double, passes long, rest long"


def word_count(text: Column) -> Column:
    """Number of words ``[^\\x20\\x09-\\x0D]+``; null has none.

    Every word with the space behind it becomes one letter, so no array of words is made.
    """
    trimmed = F.ltrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\f\r"))
    return F.octet_length(F.regexp_replace(trimmed, "[^\\x20\\x09-\\x0D]+[\\x20\\x09-\\x0D]*", "w")).cast("long")


def share_out(sizes: dict[str | None, int], weights: Sequence[float] = WEIGHTS, total: float = 0.0, limit: float = MAX_REPEATS) -> dict[str | None, float]:
    """Targets by weight, each at most ``limit`` times its source's size; what is over goes to the others by weight.

    Sources in code point order, null last, take the weights in turn.
    """
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    targets: dict[str | None, float] = {}
    open_, left = list(order), float(total)
    while open_:
        per = left / sum(weight[s] for s in open_)
        over = [s for s in open_ if per * weight[s] > limit * sizes[s]]
        if not over:
            targets |= {s: per * weight[s] for s in open_}
            break
        for s in over:
            targets[s] = float(limit * sizes[s])
            left -= targets[s]
            open_.remove(s)
        left = max(left, 0.0)
    return targets


def min_cost_flow(
    capacity: dict[str, int], members: dict[str, Sequence[str | None]], targets: dict[str | None, int], repeats: int
) -> dict[tuple[str, str | None], int]:
    """Words that each (pattern, source) carries: as much of the targets as can be met, at least cost.

    Successive shortest paths; pass r over a pattern costs r a word.
    """
    start, end = ("start",), ("end",)
    to: dict[tuple, list[int]] = defaultdict(list)
    head: list[tuple] = []
    room: list[int] = []
    cost: list[int] = []

    def arc(a: tuple, b: tuple, amount: int, price: int) -> int:
        for x, y, r, c in ((a, b, amount, price), (b, a, 0, -price)):
            to[x].append(len(head))
            head.append(y)
            room.append(r)
            cost.append(c)
        return len(head) - 2

    routes = {}
    for pattern, words in capacity.items():
        for r in range(repeats):
            arc(start, ("p", pattern), words, r + 1)
        for source in members[pattern]:
            routes[pattern, source] = arc(("p", pattern), ("s", source), words * repeats, 0)
    for source, words in targets.items():
        arc(("s", source), end, words, 0)
    while True:
        far, via, queue, waiting = {start: 0}, {}, deque([start]), {start}
        while queue:
            node = queue.popleft()
            waiting.discard(node)
            for k in to[node]:
                if room[k] > 0 and far[node] + cost[k] < far.get(head[k], 1 << 60):
                    far[head[k]] = far[node] + cost[k]
                    via[head[k]] = k
                    if head[k] not in waiting:
                        waiting.add(head[k])
                        queue.append(head[k])
        if end not in far:
            return {key: room[k ^ 1] for key, k in routes.items()}
        path, node = [], end
        while node != start:
            path.append(via[node])
            node = head[via[node] ^ 1]
        amount = min(room[k] for k in path)
        for k in path:
            room[k] -= amount
            room[k ^ 1] += amount


def pattern_of(sources: Column) -> Column:
    """The set of a document's sources as text; none at all is the source null."""
    known = F.array_sort(F.array_distinct(F.coalesce(sources, F.array().cast("array<string>"))))
    return F.to_json(F.when(F.size(known) == 0, F.array(F.lit(None).cast("string"))).otherwise(known))


def place(doc_id: Column, text: Column, seed: int) -> Column:
    """A document's place in the seeded order, 0 to 2**63 - 1."""
    return F.xxhash64(F.lit(seed), doc_id, text).bitwiseAND(F.lit((1 << 63) - 1))


def _stops(measured: DataFrame, plan: DataFrame) -> DataFrame:
    """Per pattern the first place that the last, partial pass leaves out, and the words still missing."""
    last = 63
    here = measured.join(F.broadcast(plan.where("rest > 0").select("pattern", F.col("rest").alias("need"))), "pattern")
    order = Window.partitionBy("pattern").orderBy("cell")
    for level in range(3):
        if level < 2:
            cell = F.shiftright("at", last - _CELL_BITS * (level + 1))
        else:
            cell = F.col("at")  # what is left is about a 16 millionth of the pattern
        sums = here.groupBy("pattern", "need", cell.alias("cell")).agg(F.sum("size").alias("words"))
        before = F.coalesce(F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        sums = sums.withColumn("before", before)
        cut = sums.where("before + words > need").groupBy("pattern").agg(
            F.min(F.struct("cell", (F.col("need") - F.col("before")).alias("need"))).alias("c")
        )
        cut = cut_lineage(cut.select("pattern", F.col("c.cell").alias("_cell"), F.col("c.need").alias("_need")))
        if level < 2:
            here = here.withColumn("_at", cell).drop("need").join(F.broadcast(cut), "pattern").where("_at = _cell")
            here = here.select("pattern", "at", "size", F.col("_need").alias("need"))
    return cut.select("pattern", F.col("_cell").alias("stop"), F.col("_need").alias("gap"))


def plan_mix(
    measured: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, repeats: int = MAX_REPEATS
) -> DataFrame:
    """Per pattern: whole passes, the place where the last one stops, and the place of one document more.

    ``measured``: pattern, at, size.
    """
    spark = measured.sparkSession
    rows = measured.groupBy("pattern").agg(F.sum("size").alias("words")).limit(MAX_PATTERNS + 1).collect()
    if len(rows) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} membership patterns")
    capacity = {r["pattern"]: int(r["words"]) for r in rows}
    members = {p: json.loads(p) for p in capacity}
    sizes: dict[str | None, int] = defaultdict(int)
    for pattern, words in capacity.items():
        for source in members[pattern]:
            sizes[source] += words
    targets = share_out(dict(sizes), weights, share * sum(capacity.values()), repeats)
    flow = min_cost_flow(capacity, members, {s: round(t) for s, t in targets.items()}, repeats)
    plan = []
    for pattern, words in capacity.items():
        take = sum(flow[pattern, s] for s in members[pattern])
        passes, rest = divmod(take, words) if words else (0, 0)
        own = members[pattern]
        plan.append((pattern, sizes[own[0]] if len(own) == 1 else None, targets[own[0]] if len(own) == 1 else None, passes, rest))
    plan = spark.createDataFrame(plan, _PLAN)
    stops = cut_lineage(_stops(measured, plan))
    left = measured.join(F.broadcast(stops), "pattern").where("at >= stop and size > 0")
    extra = left.groupBy("pattern").agg(F.min(F.struct(F.abs(F.col("size") - F.col("gap")).alias("off"), "at", "gap")).alias("x"))
    extra = extra.where("x.off < x.gap").select("pattern", F.col("x.at").alias("extra"))
    return cut_lineage(plan.join(stops.drop("gap"), "pattern", "left").join(extra, "pattern", "left"))


def _times() -> Column:
    """How often a document is taken: ``passes``, and once more before the stop."""
    more = F.coalesce((F.col("at") < F.col("stop")) | (F.col("at") == F.col("extra")), F.lit(False))
    return (F.col("passes") + more.cast("long")).cast("long")


def mix(
    docs: DataFrame, sources: Column, doc_id: str = "doc_id", text: str = "text", seed: int = 7, **options
) -> DataFrame:
    """Per row: ``doc_id``, ``size``, its pattern's ``source_size`` and ``target`` (null if it has several sources), ``times``, ``taken``."""
    measured = cut_lineage(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            pattern_of(sources).alias("pattern"),
            place(F.col(doc_id), F.col(text), seed).alias("at"),
            word_count(F.col(text)).alias("size"),
        )
    )
    plan = plan_mix(measured.select("pattern", "at", "size"), **options)
    out = measured.join(F.broadcast(plan), "pattern").withColumn("times", _times())
    return out.select("doc_id", "size", "source_size", "target", "times", (F.col("times") * F.col("size")).alias("taken"))


def mixed_documents(
    docs: DataFrame, sources: Column, doc_id: str = "doc_id", text: str = "text", seed: int = 7, **options
) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken."""
    where, pattern = place(F.col(doc_id), F.col(text), seed), pattern_of(sources)
    measured = cut_lineage(docs.select(pattern.alias("pattern"), where.alias("at"), word_count(F.col(text)).alias("size")))
    plan = plan_mix(measured, **options).select("pattern", "passes", "stop", "extra")
    plan = plan.toDF("_pattern", "passes", "stop", "extra")
    names = [F.col(f"_doc.{c}").alias(c) for c in docs.columns]
    rows = docs.select(F.struct(*docs.columns).alias("_doc"), pattern.alias("_pattern"), where.alias("at"))
    rows = rows.join(F.broadcast(plan), "_pattern").withColumn("times", _times()).where("times > 0")
    return rows.select("_doc", F.explode(F.sequence(F.lit(1).cast("long"), "times")).alias("_time")).select(*names)
