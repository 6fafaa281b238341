"""Taxonomies, profiles and sequences."""

import random

import pytest
from pyspark.sql import functions as F

from abundix.operators import contributions as c, taxonomy as tx
from abundix.session import cut_lineage
from tests.conftest import as_dict

TREE = [("Root", "root", "no rank", None), ("f1", "Fam one", "Family", "Root"), ("g1", "Gen", "Genus", "f1"),
        ("g2", "Twin", "Genus", "f1"), ("g3", "Twin", "Genus", "Root"), ("s1", "Gen spec", "Species", "g1")]
TABLE = "code string, name string, stratum string, sample string, value double"


@pytest.fixture(scope="module")
def tree(frame):
    return frame(TREE, "taxid string, name string, rank string, parent string")


def test_lineage(tree, frame):
    out = tx.lineage(frame([("s1",), ("s1",), ("nowhere",)], "taxid string"), tree)
    assert [(r["step"], r["ancestor"]) for r in out.orderBy("step").collect()] == [(0, "s1"), (1, "g1"), (2, "f1")]
    assert as_dict(tx.taxon_at_rank(tree, tree, "Family"), "taxid", "taxon") == dict.fromkeys(
        ["f1", "g1", "g2", "s1"], "f__Fam_one"
    )
    assert {r["genus"] for r in tx.unique_genera(tree).collect()} == {"Gen"}


def test_a_cycle_is_an_error(frame):
    loop = frame([("a", "A", "x", "b"), ("b", "B", "x", "a")], "taxid string, name string, rank string, parent string")
    with pytest.raises(ValueError, match="cycle"):
        tx.lineage(loop.limit(1), loop)
    with pytest.raises(ValueError, match="cycle"):
        tx.subtree_intervals(loop)
    with pytest.raises(ValueError, match="cycle"):
        tx.nearest_ancestor(loop, loop, F.col("rank") == "y")


NODE = "taxid string, name string, rank string, parent string"


def random_tree(seed, size):
    """Rows of a forest, and each node's way to the top."""
    rng = random.Random(seed)
    names = [f"n{i:03d}" for i in range(size)]
    rng.shuffle(names)
    rows, ways = [], {}
    for i, name in enumerate(names):
        parent = rng.choice([*names[max(0, i - 4) : i], "Root", "nowhere"]) if i % 9 else "Root"
        rows.append((name, name.upper(), rng.choice(["Family", "Genus", "no rank"]), parent))
        ways[name] = [name, *ways.get(parent, [])]
    return rows, ways


def test_random_trees(frame):
    rows, ways = random_tree(1, 120)
    ranks = {name: rank for name, _, rank, _ in rows}
    tree = frame(rows, NODE).repartition(3)
    got = tx.lineage(tree, tree).collect()
    assert {(r.taxid, r.step, r.ancestor) for r in got} == {(n, i, a) for n, way in ways.items() for i, a in enumerate(way)}
    assert len(got) == sum(map(len, ways.values()))
    nearest = {n: next((a for a in way if ranks[a] == "Family"), None) for n, way in ways.items()}
    want = {n: "f__" + a.upper() for n, a in nearest.items() if a}
    assert as_dict(tx.taxon_at_rank(tree, tree, "Family"), "taxid", "taxon") == want

    intervals = {r.taxid: (r.enter, r.leave) for r in tx.subtree_intervals(tree).collect()}
    assert sorted(enter for enter, _ in intervals.values()) == list(range(1, len(rows) + 1))
    for a, (low, high) in intervals.items():
        assert {n for n, (enter, _) in intervals.items() if low <= enter <= high} == {n for n, way in ways.items() if a in way}
    siblings = [(parent, intervals[name][0], name) for name, _, _, parent in rows if parent not in ("Root", "nowhere")]
    assert sorted(siblings) == sorted(siblings, key=lambda x: (x[0], x[2]))
    top = rows[0][0]
    found = tx.below(frame([(n, 1) for n in [*ways, "nowhere"]], "taxid string, x int"), tree, top).collect()
    assert {r.taxid for r in found} == {n for n, way in ways.items() if top in way}


def test_deep_trees_take_few_rounds(frame, monkeypatch):
    depth = 10_000
    chain = cut_lineage(frame([(f"c{i}", f"C{i}", "Family" if i == 0 else "x", f"c{i - 1}" if i else "Root") for i in range(depth)], NODE))
    rounds = []
    twice = tx._twice
    monkeypatch.setattr(tx, "_twice", lambda jumps: rounds.append(1) or twice(jumps))
    deepest = frame([(f"c{depth - 1}",)], "taxid string")
    got = tx.lineage(deepest, chain).agg(F.count("*"), F.max("step"), F.count_distinct("ancestor")).first()
    assert tuple(got) == (depth, depth - 1, depth) and len(rounds) <= 15
    rounds.clear()
    assert tx.taxon_at_rank(deepest, chain, "Family").first().taxon == "f__C0" and len(rounds) <= 15
    rounds.clear()
    bounds = tx.subtree_intervals(chain).agg(F.min("enter"), F.max("enter"), F.min("leave"), F.max("leave")).first()
    assert tuple(bounds) == (1, depth, depth, depth) and len(rounds) <= 15


@pytest.fixture(scope="module")
def families(frame):
    return frame(
        [
            ("UNMAPPED", None, None, "s", 9.0),
            ("UniRef90_a", None, None, "s", 6.0),
            ("UniRef90_a", None, "g__Gen.s__x", "s", 4.0),
            ("UniRef90_a", None, "g__Twin.s__x", "s", 1.0),
            ("UniRef90_a", None, "unclassified", "s", 1.0),
            ("UniRef90_b", None, None, "s", 2.0),
        ],
        TABLE,
    )


def test_modes(tree, families, frame):
    lca = frame([("UniRef90_a", "s1"), ("UniRef90_z", "g1")], "family string, lca string")
    mapping = tx.taxon_map(families, tree, lca)
    assert as_dict(mapping, "key", "taxon") == {"UniRef90_a": "f__Fam_one", "g__Gen.s__x": "f__Fam_one"}

    def rows(mode):
        return as_dict(tx.infer_taxonomy(families, mapping, mode), ("code", "stratum"), "value")

    community = {("UNMAPPED", None): 9.0, ("UniRef90_a", None): 6.0, ("UniRef90_b", None): 2.0}
    assert rows("totals") == {**community, ("UniRef90_a", "f__Fam_one"): 6.0, ("UniRef90_b", "unclassified"): 2.0}
    assert rows("stratified") == {**community, ("UniRef90_a", "f__Fam_one"): 5.0, ("UniRef90_a", "unclassified"): 1.0}
    assert rows("unclassified") == {("UNMAPPED", None): 9.0, ("UniRef90_a", None): 1.0, ("UniRef90_a", "f__Fam_one"): 1.0}
    report = tx.infer_taxonomy_report(tx.infer_taxonomy(families, mapping, "totals")).first()
    assert (report["strata"], report["resolved"], report["percent"]) == (2, 1, 50.0)
    genus = as_dict(tx.taxon_map(families, tree, lca, "Genus"), "key", "taxon")
    assert genus == {"UniRef90_a": "g__Gen", "g__Gen.s__x": "g__Gen", "g__Twin.s__x": "g__Twin"}


def test_rare_taxa(frame):
    mapping = frame([(str(i), "common") for i in range(9)] + [("x", "rare")], "key string, taxon string")
    assert tx.drop_rare_taxa(mapping, 0.2).count() == 9
    assert tx.drop_rare_taxa(mapping, 0.1).count() == 10


def test_profile_selection(frame):
    profile = frame(
        [("k__B|g__A|s__A_x|t__SGB12", 40.0, 0.9), ("k__B|g__A|s__A_y|t__SGB1", 20.0, 0.1), ("k__B|g__A", 60.0, 1.0),
         ("k__B|g__C|s__C_z", 5.0, 2.0)],
        "clade string, abundance double, coverage double",
    )
    chosen = tx.select_clades(profile, 1, 0.5)
    assert [(r["clade_id"], r["species"]) for r in chosen.collect()] == [("SGB12", "s__A_x")]
    assert tuple(tx.clade_report(chosen).first()) == (1, 40.0)
    assert {r["genus"] for r in tx.select_genera(profile, 10).collect()} == {"a"}
    files = frame([("g__A.s__x__SGB12_v1.fna",), ("sgb12.fna",), ("pre_SGB112_v1.fna",), ("xsgb12_y",)], "file string")
    assert {r["file"] for r in tx.select_pangenomes(files, chosen).collect()} == {"g__A.s__x__SGB12_v1.fna", "xsgb12_y"}


def test_filter_sequences(frame):
    sequences = frame([("1", "1 Homo sapiens", "A"), ("2", "2 Mus musculus", "C")], "id string, header string, sequence string")
    genera = frame([("mus",)], "genus string")
    mapping = frame([("1", "wild Mus"), ("2", "nothing")], "reference string, bug string")
    assert [r["id"] for r in tx.filter_sequences(sequences, genera).collect()] == ["2"]
    assert [r["id"] for r in tx.filter_sequences(sequences, genera, mapping).collect()] == ["1"]


def test_expand_lineage(frame):
    tree = frame([("1", "root", "no rank", None), ("131567", "cells", "domain", "1"), ("9", "Fam", "family", "131567"),
                  ("10", "X y", "species", "9")], "taxid string, name string, rank string, parent string")
    table = frame([("A", None, "g__X.s__X_y", "s", 1.0), ("A", None, "g__X.s__Z", "s", 2.0), ("A", None, None, "s", 3.0)], TABLE)
    assert as_dict(tx.expand_lineage(table, tree), "value", "stratum") == {1.0: "family__Fam|species__X y", 2.0: "Z", 3.0: None}


def test_contributions(frame):
    table = frame([("x", "s1", 4.0), ("y", "s1", 1.0), ("x", "s2", 1.0), ("y", "s2", 9.0), ("unclassified", "s2", 1.0),
                   ("z", "s3", 0.0), ("w", "s1", 1.0)], "stratum string, sample string, value double")
    assert {r["sample"] for r in c.drop_zero_samples(table).collect()} == {"s1", "s2"}
    top = as_dict(c.top_taxa(table, 1), ("stratum", "sample"), "value")
    assert top[("y", "s2")] == 9.0 and top[("other", "s1")] == 5.0 and top[("unclassified", "s2")] == 1.0
    none_left = c.top_taxa(table.where("stratum in ('x', 'z')"), 1)
    assert {r["stratum"] for r in none_left.collect()} == {"x"}
    order = as_dict(c.order_samples(table.where("value > 0"), "dominant"), "sample", "position")
    assert order == {"s2": 1, "s1": 2}
    assert as_dict(c.order_samples(table), "sample", "position") == {"s2": 1, "s1": 2, "s3": 3}
    stacked = as_dict(c.contribution_scaling(table, "logstack"), ("stratum", "sample"), "value")
    # floor is 0 (smallest total 6), so the stack of s2 is log10(11) high
    assert stacked[("y", "s2")] == pytest.approx(9 / 11 * 1.0413926851582251)


@pytest.mark.parametrize("relative", [True, False])
def test_braycurtis_over_many_blocks(frame, monkeypatch, relative):
    import random

    monkeypatch.setattr(c, "_BLOCK", 3)
    monkeypatch.setattr(c, "_CHUNK", 2)
    rng = random.Random(4)
    values = {(f"t{i}", f"s{j:02d}"): float(rng.randint(1, 9)) for i in range(7) for j in range(14) if rng.random() < 0.4 or i == 0}
    got = as_dict(c.braycurtis(frame([(*k, v) for k, v in values.items()], "stratum string, sample string, value double"),
                               relative), ("sample1", "sample2"), "distance")
    totals = {}
    for (_, s), v in values.items():
        totals[s] = totals.get(s, 0) + v
    names = sorted(totals)
    share = {k: v / totals[k[1]] if relative else v for k, v in values.items()}
    for i, one in enumerate(names):
        for two in names[i + 1:]:
            strata = {k[0] for k in share if k[1] in (one, two)}
            a = [share.get((t, one), 0) for t in strata]
            b = [share.get((t, two), 0) for t in strata]
            want = sum(abs(x - y) for x, y in zip(a, b)) / (sum(a) + sum(b))
            assert got.pop((one, two), 1.0) == pytest.approx(want)
    assert not got
