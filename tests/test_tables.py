"""Feature tables."""

import pytest
from pyspark.sql import functions as F

from abundix.operators import ordering as o, tables as t
from tests.conftest import as_dict

TABLE = "code string, name string, stratum string, sample string, value double"


def cells(df):
    return as_dict(df, ("code", "stratum", "sample"), "value")


@pytest.fixture(scope="module")
def table(frame):
    return frame(
        [
            ("A", None, None, "s", 3.0),
            ("A", None, "g__X.s__Y", "s", 2.0),
            ("A", None, "g__X.s__Z", "s", 1.0),
            ("B", None, None, "s", 1.0),
            ("UNMAPPED", None, None, "s", 4.0),
            ("A", None, None, "t", 0.0),
        ],
        TABLE,
    )


def test_renormalise(table):
    out = cells(t.renormalise(table, special=False))
    assert out[("A", None, "s")] == 750000 and out[("B", None, "s")] == 250000
    assert out[("A", "g__X.s__Y", "s")] == 500000
    assert out[("A", None, "t")] == 0.0
    level = cells(t.renormalise(table, "relab", "levelwise"))
    assert level[("A", "g__X.s__Y", "s")] == pytest.approx(2 / 3)
    assert level[("UNMAPPED", None, "s")] == 0.5


def test_community_fractions_sum_to_one(table):
    total = t.renormalise(table, "relab").where("stratum IS NULL AND sample = 's'").agg(F.sum("value")).first()[0]
    assert total == pytest.approx(1.0)


def test_regroup(table, frame):
    groups = frame([("A", "g1"), ("B", "g1"), ("A", "g2"), ("A", "g2")], "code string, group string")
    out = cells(t.regroup(table, groups))
    assert out[("g1", None, "s")] == 4.0 and out[("g2", None, "s")] == 3.0
    assert out[("UNMAPPED", None, "s")] == 4.0 and out[("g1", "g__X.s__Y", "s")] == 2.0
    mean = cells(t.regroup(table, groups, "mean", protected=()))
    assert mean[("g1", None, "s")] == 2.0 and ("UNMAPPED", None, "s") not in mean
    # a member without a row in the sample still counts
    assert mean[("g1", None, "t")] == 0.0
    lost = cells(t.regroup(table, groups.where("code = 'A'"), ungrouped=True, protected=()))
    assert lost[("UNGROUPED", None, "s")] == 5.0
    report = t.regroup_report(table, groups).first()
    assert (report["features"], report["grouped"], report["grouped_twice"]) == (3, 2, 1)


def test_regroup_by_a_partition_keeps_totals(table, frame):
    groups = frame([("A", "x"), ("B", "x"), ("UNMAPPED", "y")], "code string, group string")
    before = as_dict(table.where("stratum IS NULL").groupBy("sample").agg(F.sum("value").alias("v")), "sample", "v")
    after = t.regroup(table, groups, protected=()).where("stratum IS NULL").groupBy("sample").agg(F.sum("value").alias("v"))
    assert as_dict(after, "sample", "v") == before


def test_rename(table, frame):
    names = frame([("A", "one"), ("A", "two"), ("UNMAPPED", "none")], "key string, value string")
    out = {r["code"]: r["name"] for r in t.rename_features(table, names).collect()}
    assert out == {"A": "one;two", "B": "NO_NAME", "UNMAPPED": None}


def test_reduce_counts_missing_cells_as_zero(table):
    # B has no cell in sample t
    for function, value in (("min", 0.0), ("max", 1.0), ("mean", 0.5), ("sum", 1.0)):
        assert as_dict(t.reduce_table(table, function).where("code = 'B'"), "code", "value") == {"B": value}


def test_genus_level(table):
    out = cells(t.to_genus_level(table))
    assert out[("A", "g__X", "s")] == 3.0 and out[("A", None, "s")] == 3.0


def test_join_tables(frame):
    one = frame([("A", None, None, "s1", 1.0), ("A", None, None, "s1", 2.0)], TABLE)
    two = frame([("B", None, None, "s2", 5.0)], TABLE)
    assert cells(t.join_tables([one, two])) == {("A", None, "s1"): 3.0, ("B", None, "s2"): 5.0}
    dense = cells(t.join_tables([one, two], dense=True))
    assert dense[("A", None, "s2")] == 0.0 and len(dense) == 4
    same = [one.withColumn("source", F.lit("f1")), two.withColumns({"source": F.lit("f2"), "sample": F.lit("s1")})]
    assert cells(t.join_tables(same)) == {("A", None, "f1"): 3.0, ("B", None, "f2"): 5.0}


def test_witten_bell(frame):
    table = frame([("a", None, None, "s", 6.0), ("b", None, None, "s", 3.0), ("c", None, None, "s", 1.0)], TABLE)
    features = frame([(c, None, None) for c in "abcx"], "code string, name string, stratum string")
    sparse = t.smooth(table, features, "witten_bell")
    assert sparse.cells.count() == 3 and as_dict(sparse.absent, "sample", "value") == pytest.approx({"s": 30 / 13})
    out = as_dict(t.fill_cells(sparse, features), "code", "value")
    assert out == pytest.approx({"a": 60 / 13, "b": 30 / 13, "c": 10 / 13, "x": 30 / 13})
    assert sum(out.values()) == pytest.approx(10.0)
    laplace = as_dict(t.fill_cells(t.smooth(table, features, "laplace"), features), "code", "value")
    assert laplace == {"a": 7.0, "b": 4.0, "c": 2.0, "x": 1.0}


@pytest.mark.parametrize("method", ["laplace", "witten_bell"])
def test_relative_expression_of_equal_tables_is_one(frame, method):
    table = frame([("a", None, "x", "s", 6.0), ("b", None, "y", "s", 3.0), ("a", None, "x", "t", 2.0)], TABLE)
    out = t.relative_expression(table, table, method, stratified=True).cells.collect()
    assert {r["code"] for r in out} == {"a", "b"}
    assert all(r["value"] == pytest.approx(1.0) for r in out if method == "laplace" or r["sample"] == "s")


def test_all_zero_sample_gives_null_ratios(frame):
    table = frame([("a", None, None, "s", 1.0), ("a", None, None, "z", 0.0)], TABLE)
    out = t.relative_expression(table, table, "laplace")
    assert as_dict(out.cells, "sample", "value") == {"s": 1.0}
    assert as_dict(out.absent, "sample", "value") == {"s": 1.0, "z": None}


def test_strain_profiles(frame):
    rows = []
    for sample, values in {"s1": (5, 5, 0), "s2": (5, 0, 5), "s3": (1, 0, 0), "s4": (9, 9, 9)}.items():
        rows += [(g, None, "g__G.s__S", sample, float(x)) for g, x in zip("abc", values)]
    rows += [("a", None, "unclassified", "s1", 9.0), ("a", None, None, "s1", 14.0)]
    out = t.strain_profiles(frame(rows, TABLE), min_mean=5, min_count=2, prevalence=(0.5, 0.9))
    assert {(r["code"], r["sample"]) for r in out.collect()} == {(g, s) for g in "bc" for s in ("s1", "s2", "s4")}
    assert t.strain_profiles(frame(rows, TABLE), 5, 2, min_samples=4).count() == 0


def test_split_rows(frame):
    rows = frame([("K1", "s", "2", "g__A", "s__"), ("K1", "s", "x", "g__", "s__b")],
                 "Gene string, Sample string, Count string, Genus string, Species string")
    out = cells(t.split_by_sample_rows(rows, ("Genus", "Species"), "Genus", abundance="Count"))
    assert out == {
        ("K1", "g__A.s__unclassified", "s"): 2.0,
        ("K1", "g__unclassified.s__b", "s"): 0.0,
        ("K1", None, "s"): 2.0,
    }


def test_split_columns(frame):
    wide = frame([("1", "2", "a; b"), ("2", "?", "a; c"), ("3", "4", "a; b")], "id string, s string, tax string")
    assert as_dict(t.split_by_sample_columns(wide, "id", "tax", 1), "feature", "value") == {"b": 6.0, "c": 0.0}
    assert as_dict(t.split_by_sample_columns(wide.drop("tax"), "id"), "feature", "value") == {"1": 2.0, "2": 0.0, "3": 4.0}
    with pytest.raises(Exception, match="taxonomy index"):
        t.split_by_sample_columns(wide, "id", "tax", 2).collect()


def test_unpack_pathways_with_ecs(frame):
    pathways = frame([("P", "path", None, "s", 4.0), ("P", "path", "b", "s", 3.0), ("Q", None, None, "s", 0.0)], TABLE)
    genes = frame([("1.1.1.1,2.2.2.2", "ec", None, "s", 7.0), ("1.1.1.1", "ec", "b", "s", 2.0)], TABLE)
    members = frame([("P", "geneX")], "pathway string, gene string")
    ecs = frame([("P", "1.1.1.1"), ("P", "2.2.2.2")], "pathway string, gene string")
    full = {(r["pathway"], r["bug"], r["gene"], r["value"]) for r in t.unpack_pathways(pathways, genes, members, ecs).collect()}
    assert full == {("P", None, None, 4.0), ("P", "b", None, 3.0), ("P", "b", "1.1.1.1", 2.0)}
    flat = {(r["gene"], r["value"]) for r in t.unpack_pathways(pathways, genes, members, ecs, taxonomy=False).collect()}
    assert flat == {(None, 4.0), ("1.1.1.1", 7.0), ("2.2.2.2", 7.0)}


def test_double_sort(frame):
    df = frame([("b", 2.0), ("a", 2.0), ("c", 5.0)], "name string, value double")
    assert [r["name"] for r in o.double_sort(df).orderBy("position").collect()] == ["c", "a", "b"]


def test_feature_sort(frame):
    ids = [("11", None, None), ("1", None, "A"), ("1", None, None), ("UNINTEGRATED", None, None), ("UNMAPPED", None, None),
           ("UNGROUPED", None, None)]
    df = frame(ids, "code string, name string, stratum string")
    assert [(r["code"], r["stratum"]) for r in o.feature_sort(df).collect()] == [
        ("UNMAPPED", None), ("UNGROUPED", None), ("UNINTEGRATED", None), ("1", None), ("1", "A"), ("11", None)
    ]
    values = df.withColumn("value", F.length("code").cast("double"))
    assert o.sort_by(values, "value").first()["code"] == "UNINTEGRATED"
    assert [r["stratum"] for r in o.sort_by(values, "level").collect()][-1] == "A"


def test_expand_cluster(table, frame):
    clusters = frame([("c1", "A"), ("c1", "B"), ("c2", "UNMAPPED")], "key string, value string")
    assert {r["code"] for r in t.expand_cluster(table, clusters, ["B"]).collect()} == {"A", "B"}
