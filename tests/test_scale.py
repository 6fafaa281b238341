"""Properties that must hold on a cluster: plans, hot groups, lineage."""

import math
import random
import statistics
import struct
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from abundix.functions.statistics import ordered_bits
from abundix.operators import scaling as sc
from abundix.session import shared_folder
from tests.conftest import as_dict

ROOT = Path(__file__).resolve().parents[1]
SMALL = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name",
    [
        "query_weight", "gene_scores", "adjusted_cpm", "subject_coverage", "regroup", "renormalise", "join_tables_dense",
        "relative_expression_stratified", "gap_fill", "structured_pathway_score", "spearman", "select_pangenomes",
        "braycurtis", "infer_taxonomy_totals",
    ],
)
def test_no_cross_join_in_plans(spark, name):
    text = plan(entry.queries()[name](spark, SMALL))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_filters_and_columns_reach_the_scan(spark):
    hits = entry.queries()["filter_hits"](spark, SMALL)
    text = hits._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in text.splitlines() if "FileScan parquet" in line and "l_orderkey" in line)
    assert "l_tax" in scan and "LessThanOrEqual(l_tax,0.05)" in scan
    assert "l_extendedprice" not in scan


def test_library_has_no_shortcuts():
    files = [p for p in (ROOT / "abundix").rglob("*.py") if p.parent.name != "llm"]
    text = "\n".join(p.read_text() for p in files)
    for word in ("localCheckpoint", "crossJoin", "toPandas", "broadcast(", ".rdd", ".sample(", "zipWithIndex", "toLocalIterator", "mkdtemp"):
        assert word not in text, word


@pytest.mark.parametrize("name", ["relative_expression_laplace", "relative_expression_stratified", "smooth_laplace", "join_tables"])
def test_sparse_tables_stay_sparse(spark, name):
    """No feature is multiplied by the list of samples, and inputs are scanned few times."""
    text = plan(entry.queries()[name](spark, SMALL))
    assert "collect_list(sample" not in text and text.count("FileScan") <= 40


@pytest.mark.parametrize("name", ["read_feature_table", "cohort_table", "read_metadata_table", "read_hits_m8", "read_taxonomy"])
def test_text_is_read_once(spark, name):
    """The lines are parsed into a written table; what comes after reads that."""
    assert "FileScan text" not in plan(entry.queries()[name](spark, SMALL))


def test_query_weight_is_a_window(spark):
    text = plan(entry.queries()["query_weight"](spark, SMALL))
    assert "Window" in text and text.count("FileScan") == 2


def test_clear_removes_the_written_stages(spark, tmp_path):
    from abundix.session import clear, cut_lineage, scratch_path

    cut_lineage(spark.range(3))
    folder = Path(scratch_path(spark, "x").removeprefix("file://")).parent
    assert list(folder.iterdir())
    clear(spark)
    assert not folder.exists()


@pytest.fixture(scope="module")
def skewed(spark):
    # one group holds half of the rows, with many equal values
    return spark.range(4000).select(
        F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise(F.concat(F.lit("g"), F.col("id") % 50)).alias("g"),
        (F.hash("id") % 37).cast("double").alias("v"),
        F.col("id"),
    )


def test_positions_in_hot_groups(skewed):
    got = as_dict(sc.sorted_position(skewed, [F.col("v").desc(), F.col("id").asc()], ["g"]), "id", "position")
    groups = {}
    for row in skewed.collect():
        groups.setdefault(row["g"], []).append((-row["v"], row["id"]))
    for rows in groups.values():
        for position, (_, i) in enumerate(sorted(rows), 1):
            assert got[i] == position


@pytest.mark.parametrize("function, fold", [("min", min), ("max", max), ("sum", lambda x: sum(x))])
@pytest.mark.parametrize("inclusive", [True, False])
def test_prefixes(skewed, function, fold, inclusive):
    out = sc.ordered_prefix(skewed, ["g"], [F.col("id").asc()], "v", function, "p", inclusive)
    got = as_dict(out, "id", "p")
    groups = {}
    for row in skewed.orderBy("id").collect():
        seen = groups.setdefault(row["g"], [])
        if inclusive:
            seen.append(row["v"])
        want = fold(seen) if seen else (0 if function == "sum" else None)
        assert got[row["id"]] == want
        if not inclusive:
            seen.append(row["v"])


def test_ordered_prefix_spreads_a_hot_group(spark, skewed, monkeypatch):
    parts = []
    cut = sc.cut_lineage

    def watch(df):
        out = cut(df)
        parts.append(out.where("g = 'hot'").select("_part").distinct().count())
        return out

    monkeypatch.setattr(sc, "cut_lineage", watch)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sc.sorted_position(skewed, [F.col("v").asc(), F.col("id").asc()], ["g"]).count()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert parts[0] > 1


def test_median_of_hot_groups(skewed):
    got = as_dict(sc.exact_median(skewed, ["g"], "v"), "g", "median")
    groups = {}
    for row in skewed.collect():
        groups.setdefault(row["g"], []).append(row["v"])
    assert got == {g: statistics.median(v) for g, v in groups.items()}


def test_ordered_bits(frame):
    rng = random.Random(8)
    values = [0.0, 5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.0, 1.7976931348623157e308, math.inf, 0.1, 3.0]
    values += [2.0**e * s for e in range(-1070, 1024, 37) for s in (1, 1 - 2**-53, 1 + 2**-52)]
    values += [math.ldexp(rng.random(), rng.randint(-1074, 1000)) for _ in range(3000)]
    values = sorted({v for x in values for v in (x, -x)})
    df = frame([(v,) for v in values], "v double").select("v", ordered_bits("v").alias("b"))
    for row in df.collect():
        assert row.b == (-1 if row.v < 0 else 1) * struct.unpack("<q", struct.pack("<d", abs(row.v)))[0]
    assert frame([(math.nan,), (math.inf,)], "v double").orderBy(ordered_bits("v")).first().v == math.inf


@pytest.mark.parametrize("pick", [0, 5, 4096])
def test_medians_by_radix_selection(frame, monkeypatch, pick):
    """Groups of one value, of values that differ in their last bits, of both signs; nulls and null groups."""
    monkeypatch.setattr(sc, "_MEDIAN_PICK", pick)
    rng = random.Random(9)
    groups = {
        "one": [3.5],
        "same": [2.0] * 50,
        "close": [math.nextafter(1.0, 2.0, steps=i) for i in range(41)],
        "pair": [1.0, math.nextafter(1.0, 2.0)],
        "signs": [-5.0, -1.0, 0.0, -0.0, 1e-320, 7.0, 8.0],
        None: [rng.uniform(-1, 1) for _ in range(300)],
        "many": [float(rng.randint(1, 40)) / 7 for _ in range(999)],
    }
    rows = [(g, 1, v) for g, values in groups.items() for v in values] + [("same", 1, None), ("empty", 1, None)]
    rng.shuffle(rows)
    out = sc.exact_median(frame(rows, "g string, h int, v double").repartition(5), ["g", "h"], "v")
    got = {r.g: r["median"] for r in out.collect()}
    assert got == {g: statistics.median(v) for g, v in groups.items()}
    assert sc.exact_median(frame(rows, "g string, h int, v double").where("false"), ["g"], "v").count() == 0


def test_results_do_not_depend_on_partitions(spark, frame):
    from abundix.operators.hits import gene_scores

    rng = random.Random(6)
    rows = [(f"q{rng.randint(0, 30)}", f"g{rng.randint(0, 9)}", "b", float(rng.randint(1, 50)), 100 * rng.randint(1, 9), 30.0) for _ in range(400)]
    hits = frame(rows, "query string, gene string, bug string, matches double, gene_length int, aligned_length double")
    one = as_dict(gene_scores(hits.coalesce(1)), ("bug", "gene"), "score")
    many = as_dict(gene_scores(hits.repartition(13)), ("bug", "gene"), "score")
    assert one == pytest.approx(many)


def test_null_groups(frame):
    df = frame([(None, 1.0), (None, 2.0), ("a", 3.0)], "g string, v double")
    totals = sc.with_group_totals(df, ["g"], True, total=F.sum("v"))
    assert sorted((r["v"], r["total"]) for r in totals.collect()) == [(1.0, 3.0), (2.0, 3.0), (3.0, 3.0)]
    assert as_dict(sc.sorted_position(df, [F.col("v").desc()], ["g"]), "v", "position") == {1.0: 2, 2.0: 1, 3.0: 1}


def test_shared_folder_is_the_configured_one(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    folder = shared_folder(spark)
    assert folder == configured or configured is None
