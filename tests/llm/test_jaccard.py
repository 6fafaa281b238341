import itertools
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from abundix.llm import jaccard as j, textbytes
from tests.llm.conftest import prose, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sets_of(rows, width):
    out = {}
    for i, t in rows:
        w = WORD.findall("".join(c.lower() if c.isascii() else c for c in t or ""))
        s = {tuple(w[k : k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())
        out[i] = out.get(i, set()) | s
    return out


def brute(rows, width, num, den):
    sets = sets_of(rows, width)
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    shared, index = Counter(), defaultdict(list)
    for i, s in sets.items():
        for t in s:
            index[t].append(i)
    for ids in index.values():
        shared.update(itertools.combinations(sorted(ids), 2))
    for (a, b), c in shared.items():
        if den * c >= num * (len(sets[a]) + len(sets[b]) - c):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: (len(s), find(i)) for i, s in sets.items()}


def family(base, copies, edits, seed):
    r = random.Random(seed)
    out = []
    for _ in range(copies):
        w = base.split(" ")
        for _ in range(edits):
            w[r.randrange(len(w))] = "".join(r.choice("xyz") for _ in range(5))
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("width,num,den", [(3, 90, 100), (5, 8, 10), (1, 1, 2)])
def test_equals_brute_force(documents, width, num, den):
    texts = []
    for k in range(6):
        base = " ".join(words(60 + 90 * k, k))
        texts += [base] + family(base, 12, 1 + k % 3, k) + family(base, 3, 20, 50 + k)
    passage = " ".join(words(55, 99))
    texts += [" ".join(words(120, 200 + k)) + " " + passage for k in range(60)]
    texts += ["a b", "A B", "a", "", None, "a b c", "b a"] + [" ".join(words(9 + k, 300)) for k in range(12)]
    rows = list(enumerate(texts))
    got = j.jaccard_components(documents([(i, t, None, None) for i, t in rows]), width, num, den).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(rows, width, num, den)


def test_family_without_its_base(documents, monkeypatch):
    """No hub links such copies, so the trees have to find the few that link, over several blocks."""
    monkeypatch.setattr(j, "BLOCK", 16)
    base = " ".join(words(170, 1))
    texts = family(base, 90, 2, 5) + family(base, 40, 1, 6)
    rows = list(enumerate(texts))
    got = j.jaccard_components(documents([(i, t, None, None) for i, t in rows]), 3, 90, 100).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(rows, 3, 90, 100)


def test_buckets_follow_the_postings(documents, monkeypatch):
    """A bucket holds about as many postings however many shuffle partitions are set, and the estimate is no less than they are."""
    rows = list(enumerate(" ".join(words(40 + 37 * k, k)) for k in range(40)))
    rule = j.Rule(5, 8, 10)
    sets = j._sets(documents([(i, t, None, None) for i, t in rows]).select("doc_id", "text"), rule)
    monkeypatch.setattr(j, "_FLUSH", 100)
    count = j._bucket_count(sets, rule)
    bands = j._Bands(rule)
    posted = sum(sum(map(len, bands.keys(s))) for part in textbytes.slices(pa.array([t for _, t in rows])) for s in j.shingle_sets(part, 5))
    assert posted / 100 <= count <= 3 * posted / 100
    monkeypatch.setattr(j, "_FLUSH", 1 << 20)
    assert j._bucket_count(sets, rule) == 4
    monkeypatch.setattr(j, "_FLUSH", 50)
    got = j.jaccard_components(documents([(i, t, None, None) for i, t in rows + [(99, rows[3][1] + " x")]]), 5, 8, 10).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(rows + [(99, rows[3][1] + " x")], 5, 8, 10)


def test_odd_rows(documents, odd_rows):
    got = j.jaccard_components(documents(odd_rows), 3, 90, 100).collect()
    assert len(got) == len(odd_rows)
    want = brute([(i, t) for i, t, *_ in odd_rows if i is not None], 3, 90, 100)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None
        else:
            assert (r.n_shingles, r.component_id) == want[r.doc_id]
    out = j.drop_near_copies(documents(odd_rows))
    assert out.columns == documents(odd_rows).columns
    assert sorted(r.doc_id or -1 for r in out.collect()) == [-1, -1, 1, 2, 3, 4, 5, 7, 7, 10]


def test_empty_table(documents):
    df = documents([(1, "a", None, None)]).where("doc_id < 0")
    assert j.jaccard_components(df, 3, 90, 100).collect() == []
    assert j.drop_near_copies(df).count() == 0


def test_one_shared_part_is_certain():
    """Every pair that links shares a key: random pairs near the threshold."""
    r = np.random.default_rng(1)
    for num, den in ((90, 100), (8, 10), (1, 2)):
        rule, bands = j.Rule(3, num, den), j._Bands(j.Rule(3, num, den))
        for _ in range(400):
            n = int(r.integers(2, 400))
            inner = r.integers(0, 1 << 62, n).astype(np.uint64)
            spare = (den - num) * n // num
            left = r.integers(0, 1 << 62, int(r.integers(0, spare + 1))).astype(np.uint64)
            right = r.integers(0, 1 << 62, spare - len(left)).astype(np.uint64)
            a, b = np.unique(np.append(inner, left)), np.unique(np.append(inner, right))
            if np.array_equal(a, b) or den * n < num * (n + len(left) + len(right)):
                continue
            assert np.intersect1d(np.concatenate(bands.keys(a)), np.concatenate(bands.keys(b))).size


def test_traversal_loses_no_link():
    r = np.random.default_rng(2)
    rule = j.Rule(3, 8, 10)
    base = r.integers(0, 1 << 62, 120).astype(np.uint64)
    sets = [np.unique(np.append(base[r.random(120) > 0.08], r.integers(0, 1 << 62, int(r.integers(0, 12))).astype(np.uint64))) for _ in range(150)]
    sets += [np.unique(r.integers(0, 1 << 62, int(r.integers(1, 200))).astype(np.uint64)) for _ in range(150)]
    n = np.array([len(s) for s in sets])
    bitmap = np.stack([j.signature(s) for s in sets])
    component = r.integers(0, 250, len(sets))
    linked = set()
    for a, b in itertools.combinations(range(len(sets)), 2):
        c = np.intersect1d(sets[a], sets[b]).size
        if component[a] != component[b] and 10 * c >= 8 * (n[a] + n[b] - c):
            linked.add((a, b))
    tree = j.SignatureTree(n, bitmap, component)
    x, y = j.traverse(tree, tree, rule)
    found = {tuple(sorted(p)) for p in zip(x.tolist(), y.tolist())}
    assert linked and linked <= found and len(found) < 0.7 * len(sets) ** 2 / 2
    half = np.arange(len(sets)) < 40
    one, other = (j.SignatureTree(n[m], bitmap[m], component[m]) for m in (half, ~half))
    x, y = j.traverse(one, other, rule)
    cross = {(a, b) for a, b in linked if half[a] != half[b]}
    assert cross <= set(zip(x.tolist(), (y + 40).tolist()))


def test_words_of_stretches(monkeypatch):
    monkeypatch.setattr(textbytes, "_STRETCH", 50)
    texts = [None, "", "a", "  b c ", "x" * 500 + " y", "q", "q" * 49 + "  " + "z" * 300, "\x0b\x1ca b\xa0c", prose(50, 1)]
    for part in textbytes.slices(pa.array(texts), 60):
        found = textbytes.words(part)
        at = textbytes.row_bounds(found, part.rows)
        for i in range(part.rows):
            spans = zip(found.start[at[i] : at[i + 1]], found.end[at[i] : at[i + 1]])
            assert [bytes(part.data[a:b]).decode() for a, b in spans] == WORD.findall(texts[part.first + i] or "")
