import itertools
import random

import pytest
from pyspark.sql import functions as F

from abundix.llm import mixing as m
from tests.llm.conftest import prose


def test_targets():
    got = m.share_out({"a": 100, "b": 100, None: 100}, total=450)
    assert got == {"a": 200, "b": 166 + 2 / 3, None: 83 + 1 / 3} or sum(got.values()) == pytest.approx(450)
    assert got["a"] == 200 and got["b"] / got[None] == pytest.approx(2)
    assert m.share_out({"a": 0, "b": 10}, total=15) == {"a": 0.0, "b": 15.0}
    assert m.share_out({}, total=0) == {}


def test_flow_spreads_repetition():
    flow = m.min_cost_flow({"a": 10, "ab": 20, "b": 5}, {"a": ["a"], "ab": ["a", "b"], "b": ["b"]}, {"a": 15, "b": 20}, 2)
    assert sum(flow[p, "a"] for p in ("a", "ab")) == 15 and sum(flow[p, "b"] for p in ("ab", "b")) == 20
    used = {"a": flow["a", "a"], "ab": flow["ab", "a"] + flow["ab", "b"], "b": flow["b", "b"]}
    assert used == {"a": 10, "ab": 20, "b": 5}  # no repetition is needed, so none is used
    short = m.min_cost_flow({"a": 10}, {"a": ["a"]}, {"a": 50}, 2)
    assert short == {("a", "a"): 20}


def test_mix(documents):
    rows = [(i, prose(20 + i * 7 % 90, i), None, ["a", "b", "c", "d", None][i % 5]) for i in range(1000)]
    df = documents(rows)
    out = m.mix(df, F.array("source"))
    got = {r.doc_id: r for r in out.collect()}
    assert len(got) == 1000 and all(r.size == len(rows[i][1].split()) and r.taken in (0, r.size, 2 * r.size) for i, r in got.items())
    sizes = {s: sum(got[i].size for i in got if rows[i][3] == s) for s in ("a", "b", "c", "d", None)}
    targets = m.share_out(sizes, total=1.5 * sum(sizes.values()))
    for s, target in targets.items():
        own = [r for i, r in got.items() if rows[i][3] == s]
        assert all(r.source_size == sizes[s] and r.target == pytest.approx(target) for r in own)
        assert sum(r.taken for r in own) == pytest.approx(target, abs=30)
    again = {r.doc_id: r.taken for r in m.mix(df.repartition(5), F.array("source")).collect()}
    assert again == {i: r.taken for i, r in got.items()}
    mixed = m.mixed_documents(df, F.array("source"))
    assert mixed.columns == df.columns
    times = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert times == {i: r.taken // r.size for i, r in got.items() if r.taken}


def test_overlapping_sources(documents):
    df = documents([(i, prose(30, i), None, "ab" if i % 3 else "b") for i in range(300)])
    out = m.mix(df, F.split("source", ""), repeats=3)
    per = out.withColumn("left", F.col("target").isNull()).groupBy("left").agg(F.sum("taken").alias("t"), F.sum("size").alias("s"))
    assert sum(r.t for r in per.collect()) == pytest.approx(1.5 * 300 * 30, rel=0.02)


def test_odd_rows(documents, odd_rows):
    out = m.mix(documents(odd_rows), F.array("source"))
    assert out.count() == len(odd_rows)
    assert all(0 <= r.taken <= 2 * r.size for r in out.collect())
    assert m.mixed_documents(documents(odd_rows), F.array("source")).columns == documents(odd_rows).columns


def test_empty_table(documents):
    df = documents([(1, "a", None, None)]).where("doc_id < 0")
    assert m.mix(df, F.array("source")).collect() == []
    assert m.mixed_documents(df, F.array("source")).count() == 0


def flow_cost(words, taken):
    passes, rest = divmod(taken, words) if words else (0, 0)
    return sum(r * words for r in range(1, passes + 1)) + (passes + 1) * rest


@pytest.mark.parametrize("seed", range(12))
def test_flow_is_the_cheapest_of_the_largest(seed):
    """Every way to send whole words, by hand: most words first, then least cost of repetition."""
    r = random.Random(seed)
    members = {"a": ["a"], "ab": ["a", "b"], "b": ["b"]}
    capacity = {p: r.randint(0, 3) for p in members}
    targets = {"a": r.randint(0, 6), "b": r.randint(0, 6)}
    best = None
    for a, x, y, b in itertools.product(*(range(2 * capacity[p] + 1) for p in ("a", "ab", "ab", "b"))):
        if a + x <= targets["a"] and y + b <= targets["b"] and x + y <= 2 * capacity["ab"]:
            cost = flow_cost(capacity["a"], a) + flow_cost(capacity["ab"], x + y) + flow_cost(capacity["b"], b)
            best = min(best or (0, 0), (-(a + x + y + b), cost)) if best else (-(a + x + y + b), cost)
    flow = m.min_cost_flow(capacity, members, targets, 2)
    taken = {p: sum(flow[p, s] for s in members[p]) for p in members}
    assert all(sum(flow[p, s] for p in members if s in members[p]) <= targets[s] for s in targets)
    assert (-sum(taken.values()), sum(flow_cost(capacity[p], taken[p]) for p in members)) == best


def test_the_last_pass_stops_where_plain_python_stops(documents):
    """Documents in seeded order until one no longer fits, and one more that fills the gap best."""
    rows = [(i, prose(1 + i * 13 % 60, i), None, ["a", "b", "c"][i % 7 % 3]) for i in range(200)]
    df = documents(rows)
    at = {r.doc_id: r.at for r in df.select("doc_id", m.place(F.col("doc_id"), F.col("text"), 7).alias("at")).collect()}
    size = {i: len(t.split()) for i, t, *_ in rows}
    words = {s: sum(size[i] for i, *_, x in rows if x == s) for s in "abc"}
    targets = m.share_out(words, total=1.5 * sum(words.values()))
    want = {}
    for s in "abc":
        passes, rest = divmod(round(targets[s]), words[s])
        own = sorted((i for i, *_, x in rows if x == s), key=at.get)
        chosen, stop = set(), len(own)
        for n, i in enumerate(own):
            if size[i] > rest:
                stop = n
                break
            chosen.add(i)
            rest -= size[i]
        late = [(abs(size[i] - rest), at[i], i) for i in own[stop:] if size[i]]
        if late and min(late)[0] < rest:
            chosen.add(min(late)[2])
        want |= {i: passes + (i in chosen) for i in own}
    assert {r.doc_id: r.times for r in m.mix(df, F.array("source")).collect()} == want
