"""Alignments: weights, coverage and gene scores."""

import random

import pytest
from pyspark.sql import functions as F

from abundix.functions.alignments import COUNTS, RPK
from abundix.operators import hits as h
from abundix.plans.profiles import profile_gene_families
from abundix.sources.stored import store_by_query, stored
from tests.conftest import as_dict

HIT = "query string, gene string, bug string, matches double, gene_length int, aligned_length double"


@pytest.fixture(scope="module")
def two_hits(frame):
    return frame([("q1", "a", "b", 30.0, 1000, 30.0), ("q1", "b", "b", 40.0, 2000, 40.0)], HIT)


def test_weights(two_hits):
    assert as_dict(h.query_weights(two_hits), "gene", "weight") == pytest.approx({"a": 0.36, "b": 0.64})


def test_single_and_empty_hits(frame):
    hits = frame(
        [("one", "a", "b", 0.0, 1000, 1.0), ("two", "a", "b", 0.0, 1000, 1.0), ("two", "c", "b", 0.0, 1000, 1.0)], HIT
    )
    weights = as_dict(h.query_weights(hits), ("query", "gene"), "weight")
    assert weights == {("one", "a"): 1.0, ("two", "a"): 0.0, ("two", "c"): 0.0}


def test_gene_scores_and_cpm(two_hits):
    scores = h.gene_scores(two_hits, RPK)
    expected = {("b", "a"): 0.36, ("all", "a"): 0.36, ("b", "b"): 0.32, ("all", "b"): 0.32}
    assert as_dict(scores, ("bug", "gene"), "score") == pytest.approx(expected)
    cpm = as_dict(h.adjusted_cpm(scores), ("bug", "gene"), "score")
    assert cpm[("all", "a")] == pytest.approx(529411.764706)
    assert cpm[("b", "b")] == pytest.approx(470588.235294)
    assert as_dict(h.gene_scores(two_hits, COUNTS), ("bug", "gene"), "score")[("all", "b")] == pytest.approx(0.64)


def test_scores_per_sample_are_those_of_each_sample_alone(two_hits, frame):
    other = frame([("q1", "a", "c", 10.0, 500, 10.0)], HIT)
    both = two_hits.withColumn("sample", F.lit("x")).unionByName(other.withColumn("sample", F.lit("y")))
    together = as_dict(h.adjusted_cpm(h.gene_scores(both, by=["sample"]), ["sample"]), ("sample", "bug", "gene"), "score")
    for sample, hits in (("x", two_hits), ("y", other)):
        alone = as_dict(h.adjusted_cpm(h.gene_scores(hits)), ("bug", "gene"), "score")
        assert {k[1:]: v for k, v in together.items() if k[0] == sample} == pytest.approx(alone)


def test_weights_of_a_query_sum_to_one(spark):
    hits = spark.range(3000).select(
        # one query holds a third of all hits
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 97).cast("string")).alias("query"),
        F.col("id").cast("string").alias("gene"),
        F.lit("b").alias("bug"),
        (F.col("id") % 11 + 1).cast("double").alias("matches"),
    )
    sums = h.query_weights(hits).groupBy("query").agg(F.sum("weight").alias("w")).collect()
    assert len(sums) == 98
    assert all(r["w"] == pytest.approx(1.0) for r in sums)


def test_filters_keep_their_thresholds(frame):
    rows = [("a", 80.0, 0.1, 1, 10, 10), ("b", 79.9, 0.1, 1, 10, 10), ("c", 90.0, 0.2, 1, 10, 10),
            ("d", 90.0, 0.1, 1, 4, 10), ("e", 90.0, 0.1, 1, 1, 1)]
    hits = frame(rows, "query string, identity double, evalue double, q_start int, q_end int, q_length int")
    kept = {r["query"] for r in h.filter_hits(hits, 80, 0.1, 50).collect()}
    assert kept == {"a", "e"}


def test_subject_coverage_example(frame):
    hits = frame([("a", 100, 1, 31), ("a", 100, 21, 51), ("a", 100, 81, 91), ("b", 100, 5, 5), ("b", 100, 9, 3)],
                 "gene string, gene_length int, s_start int, s_end int")
    row = h.subject_coverage(hits, nucleotide=True).collect()
    assert [(r["gene"], r["covered"], r["coverage"]) for r in row] == [("a", 60, 60.0)]
    assert h.subject_coverage(hits).first()["coverage"] == pytest.approx(180.0)
    assert {r["gene"] for r in h.filter_subject_coverage(hits, 0, nucleotide=True).collect()} == {"a"}


@pytest.mark.parametrize("tile", [3, 16, 65_536])
def test_islands_match_brute_force(frame, tile):
    rng = random.Random(tile)
    rows = []
    for gene in "abcdefgh":
        for _ in range(rng.randint(1, 40)):
            start = rng.randint(0, 120)
            rows.append((gene, start, start + rng.randint(-3, 25)))
    # a third of all hits are on one gene
    rows += [("hot", s, s + 4) for s in (rng.randint(0, 300) for _ in range(len(rows) // 2))]
    df = frame(rows, "gene string, s_start int, s_end int").repartition(3)
    got = {(r["gene"], r["island_start"], r["island_stop"]) for r in h.merge_intervals(df, ["gene"], tile=tile).collect()}
    want = set()
    for gene in {r[0] for r in rows}:
        covered = sorted({p for g, s, e in rows if g == gene for p in range(s, e)})
        borders = [p for i, p in enumerate(covered) if i == 0 or covered[i - 1] != p - 1]
        for border in borders:
            stop = border
            while stop in set(covered):
                stop += 1
            want.add((gene, border, stop))
    assert got == want


def test_id_mapping(frame):
    hits = frame([("r1", "p1", 10, "x"), ("r2", "p2", 20, "y")], "reference string, gene string, gene_length int, bug string")
    mapping = frame([("r1", "m1", None, None)], "reference string, gene string, length int, bug string")
    rows = {r["reference"]: (r["gene"], r["gene_length"], r["bug"]) for r in h.apply_id_mapping(hits, mapping).collect()}
    assert rows == {"r1": ("m1", 0, "unclassified"), "r2": ("p2", 20, "y")}


def test_a_read_can_be_aligned_and_unaligned(frame):
    schema = "query string, gene string, unmapped boolean, identity double, aligned_length long, s_start int, s_end int, gene_length int"
    records = frame(
        [
            ("r1", "g", False, 95.0, 60, 0, 60, 100),
            ("r1", "g", False, 80.0, 60, 0, 60, 100),
            ("r2", "g", True, 0.0, 0, 0, 0, 100),
            ("r3", "h", False, 95.0, 10, 0, 10, 100),
        ],
        schema,
    )
    marked = h.filter_nucleotide_hits(records, identity=80.0, subject_threshold=50.0)
    assert {(r["query"], r["identity"]) for r in marked.where("kept").collect()} == {("r1", 95.0)}
    assert {r["query"] for r in h.unaligned_reads(marked).collect()} == {"r1", "r2", "r3"}
    aligned = frame([("r3",)], "query string")
    assert {r["query"] for r in h.unaligned_reads(marked, aligned).collect()} == {"r1", "r2"}


def test_profile_order(two_hits):
    lines = profile_gene_families(two_hits, RPK, unaligned=5).orderBy("position").collect()
    assert [(r["code"], r["stratum"]) for r in lines] == [
        ("READS_UNMAPPED", None), ("a", None), ("a", "b"), ("b", None), ("b", "b")
    ]
    assert lines[0]["value"] == 5.0


def test_profile_of_many_samples(two_hits, frame):
    both = two_hits.withColumn("sample", F.lit("x")).unionByName(two_hits.withColumn("sample", F.lit("y")))
    counts = frame([("x", 7)], "sample string, unaligned long")
    lines = profile_gene_families(both, by=["sample"], unaligned=counts)
    first = as_dict(lines.where("position = 1"), "sample", "value")
    assert first == {"x": 7.0, "y": 0.0}
    total = lines.where("stratum is null and position > 1").groupBy("sample").agg(F.sum("value").alias("v"))
    assert as_dict(total, "sample", "v") == pytest.approx({"x": 1e6, "y": 1e6})


def test_stored_hits_are_not_shuffled_by_read(spark, frame, tmp_path):
    rng = random.Random(21)
    rows = [(f"q{rng.randint(0, 40)}", f"g{rng.randint(0, 9)}", "b", float(rng.randint(1, 50)), 100 * rng.randint(1, 9), 30.0) for _ in range(300)]
    hits = frame(rows, "query string, gene string, bug string, matches double, gene_length int, aligned_length double").repartition(3)
    kept = store_by_query(hits, "stored_hits", 8, str(tmp_path / "hits"))
    records = hits.withColumn("kept", F.col("matches") > 20)
    stored_records = store_by_query(records, "stored_records", 8, str(tmp_path / "records"))
    try:
        assert as_dict(h.gene_scores(kept), ("bug", "gene"), "score") == pytest.approx(as_dict(h.gene_scores(hits), ("bug", "gene"), "score"))
        some = kept.where("gene < 'g3'")
        want = {r["query"] for r in h.unaligned_reads(records, hits.where("gene < 'g3'")).collect()}
        assert {r["query"] for r in h.unaligned_reads(stored_records, some).collect()} == want
        for df, exchanges in ((h.gene_scores(kept), 1), (h.unaligned_reads(stored_records, some), 0), (h.query_weights(stored(spark, "stored_hits")), 0)):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert plan.count("Exchange hashpartitioning") == exchanges and "hashpartitioning(query" not in plan
        with pytest.raises(Exception, match="already exists"):
            store_by_query(hits, "stored_hits", 8, str(tmp_path / "again"))
    finally:
        spark.sql("DROP TABLE IF EXISTS stored_hits")
        spark.sql("DROP TABLE IF EXISTS stored_records")
