"""Association statistics."""

import random

import pytest
from pyspark.sql import functions as F

from abundix.operators import associations as a
from abundix.plans.profiles import associate, associate_all
from tests.conftest import as_dict


def ranks(values):
    order = sorted(values)
    return [order.index(v) + (order.count(v) + 1) / 2 for v in values]


def pearson(x, y):
    mx, my = sum(x) / len(x), sum(y) / len(y)
    cov = sum((i - mx) * (j - my) for i, j in zip(x, y))
    return cov / (sum((i - mx) ** 2 for i in x) * sum((j - my) ** 2 for j in y)) ** 0.5


@pytest.fixture(scope="module")
def cohort(frame):
    rng = random.Random(5)
    samples = [f"s{i}" for i in range(40)]
    meta = {s: float(rng.randint(1, 12)) for s in samples}
    category = {s: rng.choice("abc") for s in samples}
    dense = {
        "sparse": {s: float(rng.randint(0, 2)) for s in samples},
        "signed": {s: float(rng.randint(-3, 3)) for s in samples},
        "trend": {s: meta[s] * 2 + rng.random() for s in samples},
        "one": {s: 7.0 if s == "s3" else 0.0 for s in samples},
    }
    cells = [(f, s, v) for f, vs in dense.items() for s, v in vs.items() if v]
    table = frame(cells + [("trend|x", "s1", 5.0)], "feature string, sample string, value double").repartition(5)
    return table, meta, category, dense


def test_spearman(cohort, frame):
    table, meta, _, dense = cohort
    metadata = frame(list(meta.items()), "sample string, value double")
    got = as_dict(a.spearman(table.where("feature not like '%|%'"), metadata), "feature", "rho")
    for feature, values in dense.items():
        assert got[feature] == pytest.approx(pearson(ranks([values[s] for s in meta]), ranks(list(meta.values()))))


def test_constant_feature_has_no_rho(frame):
    metadata = frame([("s1", 1.0), ("s2", 2.0), ("s3", 3.0)], "sample string, value double")
    table = frame([("c", s, 4.0) for s in ("s1", "s2", "s3")], "feature string, sample string, value double")
    row = a.spearman(table, metadata).first()
    assert row["rho"] is None and row["p_value"] is None
    groups = frame([("s1", "x"), ("s2", "x"), ("s3", "y")], "sample string, value string")
    assert a.kruskal_wallis(table, groups).count() == 0


def test_kruskal_wallis(cohort, frame):
    table, _, category, dense = cohort
    metadata = frame(list(category.items()), "sample string, value string")
    got = as_dict(a.kruskal_wallis(table.where("feature not like '%|%'"), metadata), "feature", "h")
    n = len(category)
    for feature, values in dense.items():
        listed = [values[s] for s in category]
        r = ranks(listed)
        sums = {}
        for rank, s in zip(r, category):
            sums.setdefault(category[s], []).append(rank)
        h = 12 / (n * (n + 1)) * sum(sum(x) ** 2 / len(x) for x in sums.values()) - 3 * (n + 1)
        ties = sum(listed.count(v) ** 3 - listed.count(v) for v in set(listed))
        assert got[feature] == pytest.approx(h / (1 - ties / (n**3 - n)))


def test_level_means(cohort, frame):
    table, _, category, dense = cohort
    metadata = frame(list(category.items()), "sample string, value string")
    got = as_dict(a.level_means(table, metadata), ("feature", "level"), "mean")
    for level in "abc":
        members = [s for s in category if category[s] == level]
        assert got[("trend", level)] == pytest.approx(sum(dense["trend"][s] for s in members) / len(members))


def test_qvalues(frame):
    stats = frame([("a", 0.01), ("b", 0.04), ("c", 0.03), ("d", 0.20), ("e", None)], "feature string, p_value double")
    got = as_dict(a.bh_qvalues(stats), "feature", "q_value")
    assert got == pytest.approx({"a": 0.04, "b": 0.16 / 3, "c": 0.16 / 3, "d": 0.2})
    assert [r["feature"] for r in a.fdr_select(a.bh_qvalues(stats), 0.1).collect()] == ["a", "b", "c"]


def test_metadata(frame):
    values = frame([("s1", "1"), ("s2", "3"), ("s3", "NA"), ("s4", "5"), ("s5", "7")], "sample string, value string")
    assert as_dict(a.impute_metadata(values), "sample", "value")["s3"] == 4.0
    with pytest.raises(Exception, match="too many"):
        a.impute_metadata(values.where("sample <> 's5'")).collect()
    levels = frame([(str(i), v) for i, v in enumerate("aabbbcd")], "sample string, value string")
    assert [(r["level"], r["count"], r["position"]) for r in a.rank_levels(levels, 3).orderBy("position").collect()] == [
        ("b", 3, 1), ("a", 2, 2), ("c", 1, 3)
    ]
    assert sorted(r["value"] for r in a.collapse_rare_levels(levels, 2).collect()) == list("aabbb") + ["other", "other"]


def test_associate(cohort, frame):
    table, meta, _, _ = cohort
    metadata = frame([(s, str(v)) for s, v in meta.items()], "sample string, value string")
    found = associate(table, metadata, "continuous", 0.05).collect()
    assert found[0]["feature"] == "trend" and found[0]["p_value"] < 1e-6
    assert all("|" not in r["feature"] for r in found)


@pytest.fixture(scope="module")
def many(frame):
    rng = random.Random(11)
    samples = [f"s{i:02d}" for i in range(40)]
    cells = [(f"f{f}", s, float(rng.randint(0, 6))) for f in range(7) for s in samples if rng.random() < 0.5]
    cells += [("constant", s, 2.0) for s in samples] + [("f1", "unlisted", 9.0)]
    numbers = {"age": {s: rng.randint(20, 40) for s in samples}, "site": {s: i % 3 for i, s in enumerate(samples)}, "flat": dict.fromkeys(samples, 1)}
    rows = [(m, s, str(v)) for m, values in numbers.items() for s, v in values.items()]
    return frame(cells, "feature string, sample string, value double").repartition(3), frame(rows, "metadatum string, sample string, value string")


@pytest.mark.parametrize("kind", ["continuous", "categorical"])
def test_many_metadata_as_one_by_one(many, kind):
    """Ranks shared by all metadata give the statistics of each alone; q-values are by metadatum."""
    cells, metadata = many
    value = "rho" if kind == "continuous" else "h"
    got = {(r.metadatum, r.feature): r for r in associate_all(cells, metadata, kind, fdr=1.0).collect()}
    seen = set()
    for name in ("age", "site", "flat"):
        own = metadata.where(F.col("metadatum") == name).drop("metadatum")
        for r in associate(cells, own, kind, fdr=1.0).collect():
            seen.add((name, r.feature))
            other = got[name, r.feature]
            assert other.q_value == pytest.approx(r.q_value) and other.p_value == pytest.approx(r.p_value)
            assert other[value] == pytest.approx(r[value])
    assert set(got) == seen and {m for m, _ in seen} >= {"age", "site"}


def test_metadata_with_missing_samples_are_an_error(many):
    cells, metadata = many
    with pytest.raises(Exception, match="one value for every sample"):
        associate_all(cells, metadata.where("not (metadatum = 'age' and sample = 's03')")).collect()
    unread = metadata.withColumn("value", F.when(F.col("metadatum") == "age", F.lit("?")).otherwise(F.col("value")))
    with pytest.raises(Exception, match="not numbers"):
        associate_all(cells, unread, "continuous").collect()


def test_q_values_by_family(frame):
    rng = random.Random(12)
    rows = [(g, f"f{i}", rng.choice([0.01, 0.2, rng.random(), None])) for g in ("a", "b", None) for i in range(30)]
    got = {}
    for r in a.bh_qvalues_by(frame(rows, "g string, feature string, p_value double"), ["g"]).collect():
        got.setdefault(r.g, {})[r.feature] = r.q_value
    for g in ("a", "b", None):
        alone = a.bh_qvalues(frame([x[1:] for x in rows if x[0] == g], "feature string, p_value double")).collect()
        assert got[g] == pytest.approx({r.feature: r.q_value for r in alone})
