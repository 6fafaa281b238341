"""Reactions and pathways."""

import itertools
import random
import statistics

import pytest
from pyspark.sql import functions as F

from abundix.operators import cover, pathways as pw
from abundix.plans import profiles as p
from abundix.sources.mappings import is_optional, pathway_nodes, pathway_tree
from abundix.session import cut_lineage
from tests.conftest import as_dict

SCORE = "bug string, pathway string, reaction string, score double"


def test_harmonic_mean(frame):
    df = frame([("a", 1.0), ("a", 2.0), ("a", 4.0), ("b", 1.0), ("b", 0.0)], "k string, v double")
    assert as_dict(df.groupBy("k").agg(pw.harmonic_mean("v").alias("m")), "k", "m") == pytest.approx({"a": 12 / 7, "b": 0.0})


@pytest.mark.parametrize(
    "scores, keys, expected",
    [
        ([0, 4, 6], "abc", [4, 4, 6]),
        ([2, 4, 6], "abc", [4, 4, 6]),
        ([2, 2, 6], "abc", [2, 2, 6]),
        ([0, 0, 6], "abc", [0, 0, 6]),
        ([5, 0, 0], "a", [5, 0, 0]),
        ([0, 5, 0], "a", [0, 5, 0]),
        ([2, 4, 6], "aabc", [2, 4, 6]),
        ([0, 4, 6], "aabc", [0, 4, 6]),
        ([1, 4, 6], "bc", [1, 6, 6]),
        ([3, 4, 0], "", [3, 4, 0]),
    ],
)
def test_gap_fill(frame, scores, keys, expected):
    rows = [("bug", "p", r, float(s)) for r, s in zip("abc", scores) if s]
    listed = frame([("p", k) for k in keys], "pathway string, reaction string")
    filled = as_dict(pw.gap_fill(frame(rows, SCORE), listed), "reaction", "score")
    assert [filled.get(r, 0) for r in "abc"] == expected


def evaluate(structure, scores):
    """Recursive evaluation over the token text."""
    tokens = [t for t in structure.split(" ") if t]
    keys = {t for t in tokens if t not in "()+," and not is_optional(t)}
    position = 0

    def harmonic(values):
        return len(values) / sum(1 / v for v in values) if values and min(values) > 0 else 0

    def read():
        nonlocal position
        required, optional, join = [], [], "+"
        while position < len(tokens):
            token = tokens[position]
            position += 1
            if token == "(":
                required.append(read())
            elif token == ")":
                break
            elif token in "+,":
                join = token
            else:
                name = token[1:] if is_optional(token) else token
                (required if name in keys else optional).append(scores.get(name, 0))
        if join == ",":
            return max(required + optional, default=0)
        h = harmonic(required)
        return harmonic(required + [v for v in optional if v > h])

    return read()


STRUCTURES = [
    "A B ( C , D )",
    "A B -C",
    "( A , B ) , ( C D )",
    "( ( A + -B ) , C ) ( D , ( A ( E , F ) ) )",
    "-A -B",
    "A",
    "( A B -A ) C",
    "( ( ( ( A , B ) C ) , D ) E ) F",
    "A ( -B , -C )",
    "---A B --C",
]


def test_tree_worked_values():
    assert evaluate("A B ( C , D )", {"A": 2, "B": 2, "C": 1, "D": 4}) == pytest.approx(2.4)
    assert evaluate("A B -C", {"A": 2, "B": 2, "C": 1}) == 2


def test_structured_scores_match_recursion(spark, frame):
    rng = random.Random(1)
    names = ["A", "B", "C", "D", "E", "F", "--C", "--A"]
    scores, want = [], {}
    for bug in range(12):
        for i, structure in enumerate(STRUCTURES):
            values = {n: float(rng.randint(1, 9)) for n in names if rng.random() < 0.7}
            if not values:
                continue
            scores += [(f"b{bug}", f"p{i}", n, v) for n, v in values.items()]
            want[(f"b{bug}", f"p{i}")] = evaluate(structure, values)
    nodes = pathway_nodes(frame([(f"p{i}", s) for i, s in enumerate(STRUCTURES)], "pathway string, structure string"))
    got = as_dict(pw.structured_pathway_score(frame(scores, SCORE).repartition(3), nodes), ("bug", "pathway"), "score")
    assert got == pytest.approx(want)


def test_tree_nodes():
    nodes = pathway_tree("p", "A ( B , -C )")
    assert [(n["node_id"], n["parent_id"], n["depth"], n["join"], n["reaction"], n["is_key"]) for n in nodes] == [
        (0, None, 0, "+", None, None),
        (1, 0, 1, None, "A", True),
        (2, 0, 1, ",", None, None),
        (3, 2, 2, None, "B", True),
        (4, 2, 2, None, "C", False),
    ]
    assert is_optional("-R") and is_optional("---R") and not is_optional("--R")
    assert not is_optional("-R", frozenset({"-R"}))


def test_flat_abundance(frame):
    members = frame([("p", r) for r in "abcd"], "pathway string, reaction string")
    scores = frame([("x", "p", "b", 1.0), ("x", "p", "c", 3.0), ("x", "p", "d", 5.0), ("y", "p", "a", 2.0)], SCORE)
    assert as_dict(pw.flat_pathway_abundance(scores, members), "bug", "score") == {"x": 4.0, "y": 1.0}


def test_medians(frame):
    rng = random.Random(2)
    rows = [(f"b{b}", f"p{i % 7}", f"r{i}", float(rng.randint(1, 30))) for b in range(5) for i in range(b * 9 + 1)]
    got = as_dict(pw.median_score(frame(rows, SCORE)), "bug", "median")
    assert got == {f"b{b}": statistics.median(r[3] for r in rows if r[0] == f"b{b}") for b in range(5)}
    largest = {}
    for bug, pathway, _, score in rows:
        largest[bug, pathway] = max(score, largest.get((bug, pathway), 0))
    got = as_dict(pw.max_median_score(frame(rows, SCORE)), "bug", "median")
    assert got == {f"b{b}": statistics.median(v for k, v in largest.items() if k[0] == f"b{b}") for b in range(5)}


def test_duplicate_genes_count_twice_but_not_in_pathways(frame):
    genes = frame([("b", "g", 2.0), ("b", "h", 5.0), ("b", "z", 0.0)], "bug string, gene string, score double")
    reactions = frame([("r", "g"), ("r", "g"), ("r", "z")], "reaction string, gene string")
    scores = pw.reaction_scores(genes, reactions)
    assert as_dict(scores, "reaction", "score") == {"r": 4.0}
    assert as_dict(pw.unintegrated_genes(genes, reactions), "bug", "unintegrated") == {"b": 5.0}
    row = pw.genes_in_pathways(genes, reactions, scores.select("bug", "reaction"), scores).first()
    assert (row["in_pathways"], row["remaining"]) == (2.0, 5.0)


def greedy(observed, members):
    """One pathway at a time: sole owners first, then the largest, ties by observed reactions, then name."""
    owners = {r: {p for p, rs in members.items() if r in rs} for r in observed}
    left = {r for r in observed if owners[r]}
    chosen = {next(iter(owners[r])) for r in left if len(owners[r]) == 1}
    left -= {r for r in left if owners[r] & chosen}
    while left:
        best = min(members, key=lambda p: (-len(members[p] & left), -len(members[p] & observed), p))
        chosen.add(best)
        left -= members[best]
    return chosen


def smallest(observed, members):
    """Every set of pathways by size, then by the rank of its members."""
    seen = {p: rs & observed for p, rs in members.items() if rs & observed}
    ranked = sorted(seen, key=lambda p: (-len(seen[p]), p))
    need = set().union(*seen.values())
    for n in range(len(ranked) + 1):
        for some in itertools.combinations(ranked, n):
            if set().union(*(seen[p] for p in some)) == need:
                return set(some)


def random_pathways(seed, pathways, reactions, organisms):
    rng = random.Random(seed)
    members = {f"p{i:02d}": {f"r{rng.randint(0, reactions)}" for _ in range(rng.randint(1, 9))} for i in range(pathways)}
    observed = {f"b{b}": {f"r{rng.randint(0, reactions + 5)}" for _ in range(rng.randint(1, 35))} for b in range(organisms)}
    return members, observed


@pytest.mark.parametrize("choose, expected, size", [(pw.greedy_pathways, greedy, 30), (pw.parsimonious_pathways, smallest, 12)])
def test_covers_match_plain_python(frame, choose, expected, size):
    members, observed = random_pathways(3, size, 40 if size == 30 else 18, 12)
    pairs = frame([(p_, r) for p_, rs in members.items() for r in rs], "pathway string, reaction string")
    scores = frame([(b, r, 1.0) for b, rs in observed.items() for r in rs], "bug string, reaction string, score double")
    got = choose(scores, pairs).collect()
    assert len(got) == len({(r["bug"], r["pathway"]) for r in got})
    want = {(b, p_) for b, rs in observed.items() for p_ in expected(rs, members)}
    assert {(r["bug"], r["pathway"]) for r in got} == want


def test_selected_pathways(frame):
    members, observed = random_pathways(4, 12, 18, 10)
    observed["few"] = {"r1", "r2"}
    pairs = frame([(p_, r) for p_, rs in members.items() for r in rs], "pathway string, reaction string")
    scores = frame([(b, r, 1.0) for b, rs in observed.items() for r in rs], "bug string, reaction string, score double")
    want = {(b, p_) for b, rs in observed.items() for p_ in smallest(rs, members)}
    supported = {(b, p_) for b, rs in observed.items() for p_, ms in members.items() if len(ms & rs) >= len(ms) / 2}
    added = pw.add_well_supported(pw.parsimonious_pathways(scores, pairs), scores, pairs)
    assert {(r["bug"], r["pathway"]) for r in added.collect()} == want | supported

    selected = {(r["bug"], r["pathway"]) for r in pw.select_pathways(scores, pairs).collect()}
    everything = {(b, p_) for b, rs in observed.items() for p_, ms in members.items() if ms & rs}
    few = {b for b, rs in observed.items() if len(rs) <= 3}
    assert selected == {k for k in everything if k[0] in few} | {k for k in (want | supported) & everything if k[0] not in few}


def test_smallest_covers_of_random_masks():
    rng = random.Random(5)
    for _ in range(1500):
        n = rng.randint(1, 9)
        masks = [sum(1 << i for i in rng.sample(range(n), rng.randint(1, min(n, 4)))) for _ in range(rng.randint(1, 12))]
        chosen, proven = cover.smallest(masks)
        sets = (sum(1 << i for i in some) for k in range(n + 1) for some in itertools.combinations(range(n), k))
        assert proven and chosen == next(s for s in sets if all(m & s for m in masks))


def test_a_cover_without_time_to_search_is_no_larger_than_the_greedy_one(frame):
    rng = random.Random(6)
    masks = [sum(1 << i for i in rng.sample(range(50), 3)) for _ in range(100)]
    chosen, proven = cover.smallest(masks, limit=1)
    assert all(m & chosen for m in masks) and chosen.bit_count() <= cover.greedy(masks).bit_count() and not proven
    better, proven = cover.smallest(masks)
    assert proven and better.bit_count() <= chosen.bit_count()


def test_covers_shuffle_once_by_organism(spark, frame):
    pairs = cut_lineage(frame([("p", "r1"), ("q", "r2")], "pathway string, reaction string"))
    scores = frame([("b", "r1", 1.0), ("b", "r3", 1.0), (None, "r2", 1.0)], "bug string, reaction string, score double")
    covers = pw.parsimonious_pathways(scores, pairs)
    plan = covers._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(bug") == 1
    assert {tuple(r) for r in covers.collect()} == {("b", "p"), (None, "q")}
    assert pw.parsimonious_pathways(scores.where("false"), pairs).count() == 0


def test_coverage(frame):
    scores = frame([("b", "p", "r1", 1.0), ("b", "p", "r2", 3.0), ("b", "q", "r2", 3.0)], SCORE)
    members = frame([("p", "r1"), ("p", "r2"), ("q", "r2"), ("q", "r3")], "pathway string, reaction string")
    assert as_dict(pw.flat_pathway_coverage(scores, members), "pathway", "coverage") == {"p": 0.0, "q": 0.0}
    scores = scores.unionByName(frame([("b", "q", "r4", 9.0)], SCORE))
    assert as_dict(pw.flat_pathway_coverage(scores, members), "pathway", "coverage") == {"p": 0.0, "q": 0.5}


def test_pathway_profile(frame):
    genes = [("x", "g1", 4.0), ("x", "g2", 6.0), ("x", "g3", 5.0)]
    rows = genes + [("all", g, s) for _, g, s in genes]
    scores = frame(rows, "bug string, gene string, score double")
    reactions = frame([("r1", "g1"), ("r2", "g2")], "reaction string, gene string")
    members = frame([("p", "r1"), ("p", "r2")], "pathway string, reaction string")
    nodes = pathway_nodes(frame([("p", "r1 r2")], "pathway string, structure string"))
    out = p.profile_pathways(scores, reactions, members, nodes, unaligned=10).orderBy("position").collect()
    # the lower reaction is raised to 6, so the pathway scores 6; 6 / 10 is the compression
    assert [(r["code"], r["stratum"], round(r["value"], 6)) for r in out] == [
        ("UNMAPPED", None, 6.0),
        ("UNINTEGRATED", None, 3.0),
        ("UNINTEGRATED", "x", 3.0),
        ("p", None, 6.0),
        ("p", "x", 6.0),
    ]


def test_profiles_of_samples_together_are_those_of_each_alone(frame):
    rng = random.Random(7)
    genes = [(s, b, f"g{g}", float(rng.randint(1, 20))) for s in "xy" for b in ("b1", "b2", "all") for g in range(12)
             if rng.random() < 0.8]
    scores = frame(genes, "sample string, bug string, gene string, score double")
    reactions = frame([(f"r{g // 2}", f"g{g}") for g in range(10)], "reaction string, gene string")
    structures = frame([("p", "r0 ( r1 , r2 ) -r3"), ("q", "r3 r4")], "pathway string, structure string")
    nodes = pathway_nodes(structures)
    members = frame([("p", f"r{i}") for i in range(4)] + [("q", "r3"), ("q", "r4")], "pathway string, reaction string")
    counts = frame([("x", 10), ("y", 20)], "sample string, unaligned long")
    together = p.profile_pathways(scores, reactions, members, nodes, unaligned=counts, by=["sample"])
    got = as_dict(together, ("sample", "code", "stratum"), "value")
    mixed = p.profile_reactions(scores, reactions, counts, by=["sample"])
    got_reactions = as_dict(mixed, ("sample", "code", "stratum"), "value")
    for sample, count in (("x", 10), ("y", 20)):
        own = scores.where(F.col("sample") == sample).drop("sample")
        alone = as_dict(p.profile_pathways(own, reactions, members, nodes, unaligned=count), ("code", "stratum"), "value")
        assert {k[1:]: v for k, v in got.items() if k[0] == sample} == pytest.approx(alone)
        alone = as_dict(p.profile_reactions(own, reactions, count), ("code", "stratum"), "value")
        assert {k[1:]: v for k, v in got_reactions.items() if k[0] == sample} == pytest.approx(alone)
