import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from abundix.llm import packing as k, textbytes
from tests.llm.conftest import prose

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = str(public_tokenizers.path("word_bpe_49k.json"))
HARD = [
    "İstanbul ΑΣ's don't we'RE <|endoftext|> x<|startoftext|>y \x1c a\xa0b é é 日本語 😀!? 12a3 ​ a b",
    "'S 'tis ÀÉ. It's 100%<",
    "a\x85b ſ K ﬁ ÿÿ Ÿ",
    "",
]


@pytest.fixture(scope="module")
def tokenizer():
    return k.Tokenizer(PATH)


def test_tokens_are_the_librarys(tokenizer):
    r = random.Random(3)
    texts = HARD + [prose(200, i) for i in range(5)]
    texts += ["".join(chr(r.choice([r.randrange(32, 127), r.randrange(160, 0x250), r.randrange(32, 0x3000)])) for _ in range(200)) for _ in range(200)]
    with open(PATH, encoding="utf-8") as f:
        texts.append(f.read(300_000))
    got = [ids.tolist() for part in textbytes.slices(pa.array(texts), 5000) for ids in tokenizer.rows(part)]
    want = [e.ids for e in tokenizer.library.encode_batch(texts, add_special_tokens=False)]
    assert got == want


def test_forgetting_changes_nothing(tokenizer, monkeypatch):
    monkeypatch.setattr(k, "KNOWN_WORDS", 100)
    monkeypatch.setattr(k, "KNOWN_PIECES", 10)
    texts = [prose(60, i) for i in range(20)]
    got = [ids.tolist() for part in textbytes.slices(pa.array(texts), 500) for ids in tokenizer.rows(part)]
    assert got == [e.ids for e in tokenizer.library.encode_batch(texts, add_special_tokens=False)]


def best_cost(places, penalties, window, price):
    best = [0] + [10**9] * (len(places) - 1)
    powers = {1 << i for i in range(20) if window <= 64 << i <= 64 * window}
    for j in range(1, len(places)):
        for i in range(j):
            length = places[j] - places[i]
            if length <= window:
                padding = 0 if length in powers else window - length
                best[j] = min(best[j], best[i] + padding + penalties[j] + price)
    return best[-1]


def test_cuts_are_optimal():
    r = np.random.default_rng(1)
    for _ in range(150):
        window = int(r.choice([16, 64, 100]))
        places = np.concatenate([[0], np.cumsum(r.integers(1, window // 3, int(r.integers(1, 60))))])
        penalties = r.integers(0, 12, len(places))
        cuts = k.choose_cuts(places, penalties, window, 5)
        powers = {1 << i for i in range(20) if window <= 64 << i <= 64 * window}
        lengths = np.diff([0, *cuts])
        assert (lengths <= window).all() and cuts[-1] == places[-1]
        cost = sum(0 if n in powers else window - n for n in lengths.tolist()) + 5 * len(cuts)
        cost += sum(int(penalties[np.searchsorted(places, c)]) for c in cuts)
        assert cost == best_cost(places.tolist(), penalties.tolist(), window, 5)


def check(rows, got, library, window=k.WINDOW):
    sequences, docs = defaultdict(list), defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
        docs[r.doc_id].append(r)
    padding = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= window
        padding += 0 if at & (at - 1) == 0 else window - at
    for i, text in rows:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], dtype="<u4")
        at = 0
        for r in sorted(docs[i], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    return padding


def test_round_trip(documents, tokenizer):
    rows = [(i, prose(10 + 37 * i % 900, i)) for i in range(300)] + [(900 + i, t) for i, t in enumerate(HARD + [None])]
    rows += [(2000, prose(20_000, 7)), (2001, "word " * 9000)]
    got = k.pack_documents(documents([(i, t, None, None) for i, t in rows]), PATH).collect()
    padding = check(rows, got, tokenizer.library)
    assert padding < 0.05 * sum(r.length for r in got)


def test_stretches(documents, tokenizer, monkeypatch):
    monkeypatch.setattr(k, "STRETCH", 5000)
    packer = k._Packer(tokenizer, 512, 1)
    rows = [(i, prose(1 + 401 * i % 3000, i)) for i in range(12)]
    out = []
    for i, t in rows:
        out += list(packer.add(i, np.array([*tokenizer.library.encode(t).ids, 2], dtype=np.uint32)))
    out += [packer.pack()] if packer.held else []
    got = [type("Row", (), r)() for r in pa.Table.from_batches(out).to_pylist()]
    check(rows, got, tokenizer.library, 512)


def test_repeated_rows_null_ids_and_no_rows(documents, odd_rows):
    df = documents(odd_rows)
    got = k.pack_documents(df, PATH).collect()
    assert sum(r.start == 0 for r in got) == len(odd_rows)
    assert k.pack_documents(df.where("n_chars > 5"), PATH).collect() == []
