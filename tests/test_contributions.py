"""Near samples by Bray-Curtis dissimilarity."""

import random

import pytest

from abundix.operators import contributions as c

TABLE = "stratum string, sample string, value double"


def samples(seed, n=40, strata=30):
    """Some families of alike samples, samples of all sizes, one with nothing and one on its own."""
    rng = random.Random(seed)
    out = {}
    for i in range(n):
        if i % 4 and out:
            base = rng.choice(list(out.values()))
            out[f"s{i:02d}"] = {t: max(0, v + rng.randint(-2, 2)) for t, v in base.items()}
        else:
            out[f"s{i:02d}"] = {f"t{rng.randint(0, strata)}": rng.randint(1, 12) for _ in range(rng.randint(1, 15))} | {"t0": rng.randint(1, 30)}
    out["nothing"] = {"t1": 0}
    out["alone"] = {"own": 5}
    return {s: {t: v for t, v in cells.items()} for s, cells in out.items()}


def distances(table, relative):
    rows = {s: {t: v for t, v in cells.items() if v > 0} for s, cells in table.items()}
    rows = {s: cells for s, cells in rows.items() if cells}
    if relative:
        rows = {s: {t: v / sum(cells.values()) for t, v in cells.items()} for s, cells in rows.items()}
    out = {}
    for a in rows:
        for b in rows:
            shared = sum(min(v, rows[b].get(t, 0)) for t, v in rows[a].items())
            if a < b and shared:
                out[a, b] = 1 - 2 * shared / (sum(rows[a].values()) + sum(rows[b].values()))
    return out


def as_frame(frame, table):
    rows = [(t, s, float(v)) for s, cells in table.items() for t, v in cells.items()]
    rows += [(t, s, v) for t, s, v in rows[:1]]  # a repeated cell adds up
    table[rows[0][1]][rows[0][0]] += rows[0][2]
    return frame(rows, TABLE).repartition(3)


@pytest.mark.parametrize("relative", [True, False])
@pytest.mark.parametrize("most", [0.0, 0.2, 0.6])
def test_similar_samples_match_all_pairs(frame, relative, most):
    table = samples(1)
    df = as_frame(frame, table)
    want = {p: d for p, d in distances(table, relative).items() if d <= most}
    got = {(r.sample1, r.sample2): r.distance for r in c.similar_samples(df, most, relative).collect()}
    near_limit = {p for p, d in distances(table, relative).items() if abs(d - most) < 1e-9}
    assert set(got) - near_limit == set(want) - near_limit
    assert all(got[p] == pytest.approx(want[p]) for p in set(got) & set(want))


@pytest.mark.parametrize("k", [1, 4])
def test_nearest_samples_match_all_pairs(frame, k):
    table = samples(2)
    df = as_frame(frame, table)
    near = {}
    for (a, b), d in distances(table, False).items():
        near.setdefault(a, []).append((d, b))
        near.setdefault(b, []).append((d, a))
    want = {(s, i, b) for s, found in near.items() for i, (_, b) in enumerate(sorted(found)[:k], 1)}
    got = c.nearest_samples(df, k, relative=False, steps=(0.1, 0.3, 1.0)).collect()
    assert {(r.sample, r.rank, r.neighbour) for r in got} == want and len(got) == len(want)
    assert "alone" not in near and "nothing" not in near


def test_few_candidates_for_unlike_samples(frame, monkeypatch):
    """Samples that share only one common stratum are never compared at a small distance."""
    rows = [("all", f"s{i:03d}", 1.0) for i in range(120)] + [(f"own{i}", f"s{i:03d}", 9.0) for i in range(120)]
    rows += [("own0", "s000b", 9.0), ("all", "s000b", 1.0)]
    asked = []
    exact = c.braycurtis_pairs

    def watch(table, pairs, relative=True):
        asked.append(pairs.count())
        return exact(table, pairs, relative)

    monkeypatch.setattr(c, "braycurtis_pairs", watch)
    got = c.similar_samples(frame(rows, TABLE), 0.3).collect()
    assert [(r.sample1, r.sample2) for r in got] == [("s000", "s000b")] and asked == [1]


def test_empty_table_and_bad_limit(frame):
    df = frame([("t", "s", 1.0)], TABLE)
    assert c.similar_samples(df.where("false"), 0.5).count() == 0
    assert c.nearest_samples(df, 3).count() == 0
    with pytest.raises(ValueError):
        c.similar_samples(df, 1.0)
