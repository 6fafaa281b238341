"""Rows that a query unfolds are not shuffled, and work follows the input."""

import re

import pytest

from abundix.operators import contributions as c, pathways as pw, scaling, tables as t
from abundix.session import cut_lineage
from abundix.sources.mappings import gene_pathways, pathway_members

FEATURES = "code string, name string, stratum string, sample string, value double"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def maps(frame):
    reactions = frame([("r1", "1.1,2.2", "a"), ("r2", "1.1", "a"), ("r2", "1.1", "a"), ("r1", "", "b"), ("r3", "3", None)], "reaction string, ec string, gene string")
    nodes = frame([("p", "r1"), ("p", "r2"), ("q", "r2"), (None, "r1"), ("z", "r3"), ("z", None)], "pathway string, reaction string")
    return reactions, nodes


def test_members_are_unfolded_after_the_shuffle(maps):
    genes, ecs = pathway_members(*maps)
    assert sorted(genes.collect(), key=str) == sorted(
        [("p", "a"), ("q", "a"), (None, "a"), ("p", "b"), (None, "b"), ("z", None)], key=str
    )
    assert sorted(ecs.collect(), key=str) == sorted(
        [("p", "1.1"), (None, "1.1"), ("p", "2.2"), (None, "2.2"), ("q", "1.1"), ("z", "3")], key=str
    )
    assert "hashpartitioning(pathway" not in plan(genes) and "hashpartitioning(reaction" not in plan(genes)


def test_unpacked_rows_are_not_shuffled(frame, maps):
    pathways = frame(
        [("p", None, None, "s", 5.0), ("p", None, "b1", "s", 2.0), ("q", None, None, "s", 1.0), ("q", None, "b2", "s", 1.0)], FEATURES
    )
    genes = frame([("a", None, "b1", "s", 3.0), ("a,b", None, "b2", "s", 4.0), ("b", None, None, "s", 9.0)], FEATURES)
    members = pathway_members(*maps)[0]
    rows = t.unpack_pathways(pathways, genes, gene_pathways(*maps))
    assert {(r.pathway, r.bug, r.gene, r.value) for r in rows.where("gene IS NOT NULL").collect()} == {("p", "b1", "a", 3.0), ("q", "b2", "a", 4.0)}
    assert sorted(rows.collect(), key=str) == sorted(t.unpack_pathways(pathways, genes, members).collect(), key=str)
    assert not re.search(r"hashpartitioning\(pathway#\d+, (bug|\d)", plan(rows))


def test_scored_genes_look_up_their_reactions(frame):
    genes = frame([("b", "g1", 1.0), ("b", "g1", 2.0), ("b", "g2", 4.0), ("b", None, 8.0), ("d", "g1", 16.0)], "bug string, gene string, score double")
    pairs = frame([("r1", "g1"), ("r2", "g1"), ("r2", "g1"), ("r3", "g2")], "reaction string, gene string")
    present = frame([("b", "r1"), ("b", "r2"), ("d", "r3")], "bug string, reaction string")
    out = pw.genes_in_pathways(genes, pairs, present, present)
    assert sorted(out.collect()) == [("b", 3.0, 12.0), ("d", 0.0, 16.0)]
    # the scored genes are dealt out by gene, whatever reactions they have
    assert "REPARTITION_BY_COL" in plan(out)


def test_selected_pathways_are_unfolded_last(frame):
    scores = frame([("b", f"r{i}", float(i)) for i in range(6)] + [("d", "r0", 1.0), ("d", "r0", 1.0)], "bug string, reaction string, score double")
    pairs = frame([("p", f"r{i}") for i in range(6)] + [("q", "r0")] + [("q", f"x{i}") for i in range(5)] + [(None, "r0")], "pathway string, reaction string")
    out = pw.select_pathways(scores, pairs)
    assert sorted(out.collect(), key=str) == sorted(
        [("b", "p", f"r{i}", float(i)) for i in range(6)] + 2 * [("d", p, "r0", 1.0) for p in ("p", "q", None)], key=str
    )
    assert "hashpartitioning(bug" in plan(out) or "BroadcastHashJoin" in plan(out)
    assert "pathway" not in "".join(line for line in plan(out).splitlines() if "hashpartitioning" in line)


def test_flat_abundance_writes_no_ranked_rows(frame, monkeypatch):
    def refuse(df):
        raise AssertionError("rows are written")

    monkeypatch.setattr(scaling, "cut_lineage", refuse)
    scores = frame([("b", "p", "r1", 4.0), ("b", "p", "r2", 2.0), ("b", "p", "r3", 1.0)], "bug string, pathway string, reaction string, score double")
    pairs = frame([("p", f"r{i}") for i in range(1, 5)], "pathway string, reaction string")
    assert pw.flat_pathway_abundance(scores, pairs).collect() == [("b", "p", 3.0)]


@pytest.mark.parametrize("strip", [1, 1 << 22])
def test_near_samples_by_blocks_and_strips(frame, monkeypatch, strip):
    monkeypatch.setattr(c, "_NEAR_BLOCKS", 3)
    monkeypatch.setattr(c, "_NEAR_STRIP", strip)
    cells = [(f"t{(i * j) % 7}", f"s{i:02d}", float(1 + (i + j) % 5)) for i in range(14) for j in range(4)]
    rows = [*cells, (None, "s00", 3.0), ("t1", None, 2.0)]
    values = {}
    for stratum, sample, value in rows:
        if sample is not None:
            values.setdefault(sample, {}).setdefault(stratum, 0.0)
            values[sample][stratum] += value
    want, near = {}, {s: [] for s in values}
    for a in values:
        for b in values:
            shared = sum(min(v, values[b].get(k, 0)) for k, v in values[a].items() if k is not None)
            if a != b and shared:
                d = 1 - 2 * shared / (sum(values[a].values()) + sum(values[b].values()))
                near[a].append((d, b))
                if a < b and d <= 0.45:
                    want[a, b] = d
    df = frame(rows, "stratum string, sample string, value double")
    got = c.similar_samples(df, 0.45, relative=False).collect()
    assert {(r.sample1, r.sample2): r.distance for r in got} == pytest.approx(want) and len(got) == len(want)
    ranks = {(r.sample, r.rank): r.neighbour for r in c.nearest_samples(df, 2, relative=False).collect()}
    assert ranks == {(s, i): b for s, found in near.items() for i, (_, b) in enumerate(sorted(found)[:2], 1)}


def test_near_samples_read_blocks_without_shuffling_them(frame, monkeypatch):
    """Blocks are not dealt out to pairs of blocks, and estimates in whole numbers lose no pair."""
    monkeypatch.setattr(c, "_NEAR_STRIP", 8)
    monkeypatch.setattr(c, "_NEAR_FIRST", 5)
    monkeypatch.setattr(c, "_NEAR_JOINED", 0)
    # values of all sizes, a sample of very many strata, one with nothing in common, equal ones and endless ones
    cells = {f"s{i:02d}": {f"t{(i * j * j) % 23}": 10.0 ** ((i + 5 * j) % 7 - 3) + i for j in range(1, 9)} for i in range(30)}
    cells["wide"] = {f"t{i}": 1 + i % 3 for i in range(300)}
    cells |= {"alone": {"own": 4.0}, "s00b": cells["s00"], "s07b": cells["s07"], "s09": {"t1": 2.0, "t2": float("inf")}}
    rows = [(t, s, float(v)) for s, held in cells.items() for t, v in held.items()]
    near = {s: [] for s in cells}
    for a in cells:
        for b in cells:
            shared = sum(min(v, cells[b].get(t, 0)) for t, v in cells[a].items())
            if a != b and shared:
                near[a].append((1 - 2 * shared / (sum(cells[a].values()) + sum(cells[b].values())), b))
    df = frame(rows, "stratum string, sample string, value double")
    got = c.similar_samples(df, 0.6, relative=False)
    want = {(a, b): d for a, found in near.items() for d, b in found if a < b and d <= 0.6}
    pairs = {(r.sample1, r.sample2): r.distance for r in got.collect()}
    assert pairs == pytest.approx(want) and got.count() == len(want)
    nearest = c.nearest_samples(df, 3, relative=False)
    assert {(r.sample, r.rank): r.distance for r in nearest.collect()} == pytest.approx(
        {(s, i): d for s, found in near.items() for i, (d, _) in enumerate(sorted(found)[:3], 1)}
    )
    assert "CartesianProduct" in plan(nearest)


def test_unfolded_scores_are_dealt_out_by_organism_only(frame):
    scores = frame([(f"b{i % 3}", f"r{i}", float(i)) for i in range(12)] + [("b0", "r5", -1.0), (None, "r1", 2.0)], "bug string, reaction string, score double")
    pairs = frame([(f"p{i % 4}", f"r{i}") for i in range(12)] + [("q", "r0"), ("q", "r1"), ("p3", None)], "pathway string, reaction string")
    pairs = cut_lineage(pairs)  # so that its size is known
    assert pw.unfolding_tasks(scores, pairs) == 4
    plain = pw.select_pathways(scores, pairs, False)
    dealt = pw.select_pathways(scores, pairs, False, tasks=7)
    assert sorted(dealt.collect(), key=str) == sorted(plain.collect(), key=str)
    abundance = pw.flat_pathway_abundance(dealt, pairs)
    assert sorted(abundance.collect(), key=str) == sorted(pw.flat_pathway_abundance(plain, pairs).collect(), key=str)
    some = abundance.where("pathway <> 'p1'")
    present = pw.present_reactions(dealt, some, tasks=7)
    assert sorted(present.collect()) == sorted(pw.present_reactions(plain, some).collect())
    for df in (abundance, present):
        assert not re.search(r"hashpartitioning\(bug#\d+, (pathway|reaction)", plan(df))


def test_lists_of_pathways_meet_an_organism_once(frame):
    """Genes of the same pathways share a list; pathways and genes listed twice still count twice."""
    pathways = frame(
        [(p, None, b, "s", 1.0) for p in ("p", "q", "r") for b in (None, "b1")] + [("p", None, "b2", "s", 1.0)] * 2, FEATURES
    )
    genes = frame([(g, None, b, s, 2.0) for g in ("a", "c", "d") for b in ("b1", "b2") for s in ("s", "z")], FEATURES)
    members = frame([("a", ["q", "p"]), ("c", ["p", "q"]), ("c", ["x"]), ("d", ["p", "p", None]), ("e", ["r"])], "gene string, pathways array<string>")
    rows = t.unpack_pathways(pathways, genes, members).where("gene IS NOT NULL")
    want = [("p", "b1", g) for g in "acdd"] + [("q", "b1", g) for g in "ac"] + 2 * [("p", "b2", g) for g in "acdd"]
    assert sorted((r.pathway, r.bug, r.gene) for r in rows.collect()) == sorted(want)
    joins = [line for line in plan(rows).splitlines() if "Join" in line]
    assert joins and not any("pathway#" in line for line in joins if "_at" not in line)
