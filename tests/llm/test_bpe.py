import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from abundix.llm import bpe
from abundix.llm.queries import QUERIES

PATH = str(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def codec():
    return bpe.codec(PATH)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_random_texts_as_the_library(codec, library):
    r = random.Random(3)
    parts = ["a", "b", "aa", " ", "  ", "\n", "\t", "'s", "'", "é", "日本", "☃", "\xa0", " ", "\x85", "<|endoftext|>", "<|endof", "1", "²", "!", "??"]
    parts += ["\x1c", "​", "the", " the", "ing", "　", "A", "ß", "\U0001f600", "é", *map(chr, range(0x80, 0x250, 7))]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 14))) for _ in range(5000)]
    ids, begin = codec.encode(texts)
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [ids[a:b].tolist() for a, b in zip(begin, begin[1:])] == want
    assert [codec.decode(i) for i in want] == [library.decode(i, skip_special_tokens=False) for i in want]


def test_long_texts_and_long_words(codec, library):
    r = random.Random(4)
    word = "".join(r.choice("abcdefgh") for _ in range(50_000))
    prose = " ".join("".join(r.choice("aehinorst") for _ in range(r.randint(1, 9))) for _ in range(120_000))
    for text in (word, "-" * 30_000, prose, " " * 5000 + prose + "\n" * 5000):
        assert codec.encode([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids


def test_pairs_are_compatible_as_merging_says(codec):
    r = np.random.default_rng(5)
    tokens = [i for i in range(20_000) if codec.merges.merge(codec.spelled[i]) == [i]]
    u, v = r.choice(tokens, 4000), r.choice(tokens, 4000)
    want = [codec.merges.merge(codec.spelled[a] + codec.spelled[b]) == [a, b] for a, b in zip(u.tolist(), v.tolist())]
    assert codec.merges.compatible(u, v).tolist() == want
    assert 0 < sum(want) < 4000


def test_short_and_long_merging_agree(codec):
    r = random.Random(6)
    for _ in range(300):
        ids = [codec.merges._byte_list[b] for b in "".join(r.choice("aaabth ") for _ in range(r.randint(0, 40))).encode()]
        assert codec.merges._merge_short(list(ids)) == codec.merges._merge_long(list(ids))


def test_words_merged_together_are_merged_as_alone(codec):
    r = random.Random(7)
    lengths = [*range(1, 70), 64, 65, 200, 3000] * 5
    words = ["".join(r.choice("aaabthenr éß日") for _ in range(n)).encode()[: max(n, 1)] for n in lengths]
    tokens, owners = codec.merges.merge_all(words)
    assert [tokens[owners == i].tolist() for i in range(len(words))] == [codec.merges.merge(w) for w in words]
    assert [len(x) for x in codec.merges.merge_all([])] == [0, 0]


def test_short_words_are_not_merged_one_by_one(library, monkeypatch):
    r = random.Random(8)
    text = " ".join("".join(r.choice("aehinorst") for _ in range(r.randint(1, 12))) for _ in range(20_000))
    fresh = bpe.Codec(PATH)
    alone = []
    monkeypatch.setattr(fresh.merges, "merge", lambda word: alone.append(word))
    assert fresh.encode([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids
    assert not alone


def test_lists_are_decoded_from_their_flat_ids(codec):
    rows = [[72, None, 70_000, -1, 50_257], None, [], [162], [72, 73], None, [2**31 - 1], [15_496, 995]]
    want = ["" if row is None else codec.decode(row) for row in rows]
    assert want[:5] == ["i", "", "", "\ufffd", "ij"] and want[7] == "Hello world"
    ids = pa.array(rows, pa.list_(pa.int32()))
    for low in range(len(rows)):
        assert codec.decode_lists(ids[low:]) == want[low:] and codec.decode_lists(ids[:low]) == want[:low]
    empty = pa.ListArray.from_arrays(pa.array([0, 2, 3]), pa.array([72, 73, 74]), mask=pa.array([True, False]))
    assert codec.decode_lists(empty) == ["", codec.decode([74])]
    assert codec.decode_lists(pa.array([[], None])) == ["", ""]
    many = pa.array(rows * 200, pa.list_(pa.int32()))
    assert codec.decode_lists(many) == want * 200


def test_memory_for_words_is_bounded(library, monkeypatch):
    monkeypatch.setattr(bpe, "KNOWN_WORDS", 50)
    monkeypatch.setattr(bpe, "STRETCH", 64)
    small = bpe.Codec(PATH)
    texts = [" ".join(f"w{i * j}é☃" for j in range(40)) for i in range(30)]
    ids, begin = small.encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(begin, begin[1:])] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_vocabularies_that_are_not_plain_are_refused(tmp_path):
    with pytest.raises(ValueError):
        bpe.Codec(str(public_tokenizers.path("word_bpe_49k.json")))


def test_odd_rows(spark, documents, odd_rows, library):
    out = bpe.encode_documents(documents(odd_rows), PATH)
    assert out.columns == ["doc_id", "ids"]
    rows = sorted(((r.doc_id, tuple(r.ids)) for r in out.collect()), key=str)
    want = [(i, tuple(library.encode(t or "", add_special_tokens=False).ids)) for i, t, *_ in odd_rows]
    assert rows == sorted(want, key=str)
    assert bpe.encode_documents(documents(odd_rows).where("false"), PATH).count() == 0


def test_decoding_odd_ids(spark):
    df = spark.createDataFrame([(1, [72, None, 70_000, -1]), (2, None), (3, []), (4, [162])], "row long, ids array<int>")
    got = dict(df.select("row", bpe.decoder(PATH)(F.col("ids")).alias("text")).collect())
    assert got == {1: "i", 2: "", 3: "", 4: "�"}


def test_query_as_the_library(spark, library):
    folder = "/root/testdata/sf0.001"
    table = pq.read_table(f"{folder}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    want = set()
    for row in table:
        ids = library.encode(row["text"] or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want.add((row["doc_id"], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    got = [tuple(r) for r in QUERIES["op13_bpe_codec"](spark, folder).collect()]
    assert len(got) == len(table) and set(got) == want
