import math
import re
from collections import Counter

from pyspark.sql import functions as F

from abundix.llm import quality as q
from abundix.llm.queries import QUERIES
from tests.llm.conftest import prose, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    w = WORD.findall(text)
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    seen, covered, lines, dup = Counter(windows), set(), set(), 0
    for i, x in enumerate(windows):
        if seen[x] > 1:
            covered |= {i, i + 1, i + 2}
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in lines
            lines.add(line)
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(covered), failed


def test_counts(documents, odd_rows, spark):
    repeats = ["a b c a b c", "a a a a", "x y z\nx y z\n\n\nx y z", "a b a b a", "# * $\n# * $ |<>&%"]
    rows = odd_rows + [(50 + i, t, None, None) for i, t in enumerate(repeats + [" ".join(words(400, 4, "ab"))])]
    labels = spark.createDataFrame([], "doc_id long, quality int")
    got = q.quality_verdicts(documents(rows), labels).collect()
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert Counter((r.doc_id, *[r[c] for c in columns]) for r in got) == Counter((i, *base(t)) for i, t, *_ in rows)
    assert all(r.kept == (not r.base_failed) for r in got)  # without labels no rule is safe


def test_binomial_tail(spark):
    p = 0.004
    cases = [(n, k) for n in (1, 7, 300, 5000, 200_000) for k in range(0, int(n * p) + 1, max(1, int(n * p / 7)))]
    df = spark.createDataFrame(cases, "n long, k long").withColumn("v", q.binomial_tail(F.col("n"), F.col("k"), p))
    for r in df.collect():
        terms = (math.lgamma(r.n + 1) - math.lgamma(i + 1) - math.lgamma(r.n - i + 1) + i * math.log(p) + (r.n - i) * math.log1p(-p) for i in range(r.k + 1))
        want = sum(map(math.exp, terms))
        assert abs(r.v - want) <= 1e-9 + 1e-8 * want


def test_thresholds_follow_labels(spark):
    """A stratum gets the strictest cutoff whose false rejections are provably few, others none."""
    rows = [(i, "big", 100 if i % 1000 else 600) for i in range(20_000)] + [(50_000 + i, "small", 0) for i in range(100)]
    features = spark.createDataFrame(rows, "doc_id long, stratum string, symbols long").withColumn("base_failed", F.lit(False))
    labels = features.select("doc_id", F.lit(1).alias("quality"))
    got = {r.stratum: r.max_symbols for r in q.thresholds(features, labels, ladders={"symbols": (50, 200, 500, 1000)}, risk=0.01).collect()}
    assert got == {"big": 200, "small": None}
    got = {r.stratum: r.max_symbols for r in q.thresholds(features, labels, ladders={"symbols": (50, 200, 500, 1000)}, risk=0.001).collect()}
    assert got == {"big": 1000, "small": None}


def test_joint_bound_needs_fewer_labels(spark):
    """Strata of some hundred labels get cutoffs; where the labels lose documents, or there are too few anywhere, none."""
    order = q.joint_steps(q.LADDERS)
    assert order[:6] == [("symbols", 2000), ("capitals", 5000), ("exclaims", 1000), ("word_length", 1200), ("repeats", 3000), ("symbols", 1000)]
    assert sorted(order) == sorted((rule, cut) for rule, ladder in q.LADDERS.items() for cut in ladder)
    sizes = {"de": 300, "es": 240, "noisy": 300, "tiny": 20, "torn": 20}
    rows = [(s, i, 1, 0) for s, n in sizes.items() for i in range(n)] + [(s, 1000 + i, 0, 9000) for s in ("de", "es", "tiny", "new") for i in range(9)]
    rows = [(s, i, g, 9000 if (s, i % 10, g) in (("noisy", 0, 1), ("torn", 0, 1)) else v) for s, i, g, v in rows]
    table = spark.createDataFrame([(f"{s}{i}", s, g, v) for s, i, g, v in rows], "doc_id string, stratum string, quality int, symbols long")
    table = table.select("*", F.lit(False).alias("base_failed"), *[F.lit(0).cast("long").alias(r) for r in q.LADDERS if r != "symbols"])
    features, labels = table.drop("quality"), table.where("stratum <> 'new'").select("doc_id", "quality")

    def cutoffs(choose, frame):
        return {r.stratum: r.max_symbols for r in choose(frame, labels).collect()}

    assert set(cutoffs(q.thresholds, features).values()) == {None}
    got = {r.stratum: (r.n_good, r.pooled, r.max_symbols) for r in q.joint_thresholds(features, labels).collect()}
    assert (got["de"], got["es"], got["noisy"]) == ((300, False, 200), (240, False, 200), (300, False, None))
    assert all(got[s] == (sizes.get(s, 0), True, None) for s in ("tiny", "torn", "new"))  # the pool loses more than the risk
    calm = cutoffs(q.joint_thresholds, features.where("stratum not in ('noisy', 'torn')"))
    assert calm == {"de": 200, "es": 200, "tiny": 200, "new": 200}
    calm = cutoffs(q.joint_thresholds, features.where("stratum <> 'noisy'"))
    assert calm["de"] == 200 and calm["torn"] is None
    assert cutoffs(q.joint_thresholds, features.where("stratum in ('tiny', 'new')")) == {"tiny": None, "new": None}


def test_joint_verdicts(documents, spark):
    rows = [(i, prose(80, i), "en", "a") for i in range(250)] + [(1000 + i, prose(80, i).replace(" ", " ## "), "en", "a") for i in range(5)]
    labels = spark.createDataFrame([(r[0], int(r[0] < 1000)) for r in rows], "doc_id long, quality int")
    ladders = {"symbols": (500, 1000), "exclaims": (300,), "capitals": (3000,)}
    out = q.quality_verdicts(documents(rows), labels, ladders=ladders, choose=q.joint_thresholds).collect()
    assert all(r.kept == (r.doc_id < 1000) for r in out)
    assert all(r.kept for r in q.quality_verdicts(documents(rows), labels, ladders=ladders).collect())
    empty = documents(rows).where("doc_id < 0")
    assert q.quality_verdicts(empty, labels, choose=q.joint_thresholds).collect() == []


def test_rejects_and_keeps(documents, spark):
    rows = [(i, prose(80, i), "en", "a") for i in range(40)] + [(1000 + i, prose(80, i).replace(" ", " ## "), "en", "a") for i in range(5)]
    features = [(i, 1) for i in range(40)] + [(i, 0) for i in range(1000, 1005)] + [(None, 1), (5, 1), (77777, 1), (6, None)]
    labels = spark.createDataFrame(features, "doc_id long, quality int")
    out = q.quality_verdicts(documents(rows), labels, ladders={"symbols": (500,)}, risk=0.3).collect()
    assert all(r.kept == (r.doc_id < 1000) for r in out)
    assert {r.rejected_by for r in out} == {"", "symbols"}


def test_empty_table(documents, spark):
    df = documents([(1, "a", None, None)]).where("doc_id < 0")
    assert q.quality_verdicts(df, spark.createDataFrame([], "doc_id long, quality int")).collect() == []


def test_query_rejects_by_its_rules(spark):
    """Every language has labels enough for cutoffs, and they reject more than the base rule does."""
    out = QUERIES["op3_quality_rules"](spark, "/root/testdata/sf0.01").collect()
    rejected = [r for r in out if r.rejected_by]
    labels = dict(spark.read.parquet("/root/testdata/sf0.01/labels.parquet").where("quality is not null").select("doc_id", "quality").collect())
    passed = [r for r in out if not r.base_failed]
    assert rejected and all(not r.kept for r in rejected) and all(r.kept for r in passed if not r.rejected_by)
    assert not [r for r in passed if labels.get(r.doc_id) == 0 and r.kept]
    good = [r for r in passed if labels.get(r.doc_id) == 1]
    assert sum(not r.kept for r in good) <= q.RISK * len(good)
