import math
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from abundix.llm import langid, textbytes, toxicity
from tests.llm.conftest import words


def labelled(n, seed=0):
    r = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        w = words(r.randint(20, 200), i)
        w = [x + ("." if k % 8 == 7 else "") for k, x in enumerate(w)]
        bad = i % 4 == 0
        if bad:
            for _ in range(r.randint(1, 4)):
                w[r.randrange(len(w))] = r.choice(["scoundrel", "villain,", "Knave.", "oafish", "oafs"])
        rows.append((i, " ".join(w), "en", "a"))
        labels.append((i, int(bad)))
    return rows, labels


def test_toxicity_on_held_out_documents(documents, spark):
    rows, labels = labelled(1500)
    df, marks = documents(rows), spark.createDataFrame(labels, "doc_id long, toxic int")
    may = toxicity.learnable(F.col("doc_id"), 3, 1)
    score = toxicity.scorer(spark, toxicity.fit(df, marks.where(may)))
    out = df.select("doc_id", "text", score("text").alias("s"), may.alias("may")).collect()
    truth = dict(labels)
    held = [r for r in out if not r.may]
    right = sum((r.s.score >= 0.7) == bool(truth[r.doc_id]) for r in held)
    assert right >= 0.97 * len(held) > 300
    assert all(0 <= r.s.score <= 1 for r in out)
    for r in held:  # the worst sentence holds the word
        if truth[r.doc_id] and r.s.score >= 0.7:
            part = r.text.encode()[r.s.worst_start : r.s.worst_start + r.s.worst_length].decode().lower()
            assert any(w in part for w in ("scoundrel", "villain", "knave", "oaf")) and r.s.n_offending >= 1


def test_toxicity_odd_rows(documents, odd_rows, spark):
    rows, labels = labelled(400)
    marks = spark.createDataFrame(labels + [(None, 1), (1, None), (99999, 1)], "doc_id long, toxic int")
    df = documents([(i + 100, *r) for i, *r in rows] + odd_rows)
    marks = marks.withColumn("doc_id", F.col("doc_id") + 100)
    out = toxicity.drop_toxic(df, marks)
    assert out.columns == df.columns
    left = sorted(r.doc_id or -1 for r in out.where("doc_id is null or doc_id < 100").collect())
    assert left == sorted(i or -1 for i, *_ in odd_rows)
    score = toxicity.scorer(spark, toxicity.fit(df, marks))
    blank = df.where("trim(replace(replace(coalesce(text, ''), '\n', ''), '\t', '')) = ''").select(score("text")["score"].alias("s"))
    assert {r.s for r in blank.collect()} == {0.0}


def test_toxicity_without_labels(documents, odd_rows, spark):
    df = documents(odd_rows)
    model = toxicity.fit(df, spark.createDataFrame([(5, 1)], "doc_id long, toxic int"))
    assert {r.s for r in df.select(toxicity.scorer(spark, model)("text")["score"].alias("s")).collect()} == {0.0}
    assert toxicity.drop_toxic(df.where("size > 5"), spark.createDataFrame([], "doc_id long, toxic int")).count() == 0


def test_noisy_or_gradient():
    """Training lowers the noisy-or loss and finds the sentence that carries the label."""
    r = np.random.default_rng(0)
    docs, per = 200, 5
    toxic = (np.arange(docs) % 2).astype(np.int64)
    doc = np.repeat(np.arange(docs), per)
    feature = r.integers(100, 5000, docs * per * 4)
    sentence = np.repeat(np.arange(docs * per), 4)
    bad = np.flatnonzero(toxic)[:, None] * per + r.integers(0, per, (toxic.sum(), 1))
    model = toxicity.train(np.append(feature, np.full(bad.size, 7)), np.append(sentence, bad.ravel()), doc, toxic, np.array([7, 100, 101]))
    assert model.weights[7] + model.bias > 2 and model.bias < -2


def speech(lang, n, seed):
    r = random.Random(seed)
    parts = {"aa": ["tha", "ing", "er", "wh"], "bb": ["sch", "ung", "ei", "pf"], "cc": ["ção", "é", "que", "ou"]}[lang]
    return " ".join("".join(r.choice(parts) for _ in range(r.randint(1, 3))) for _ in range(n))


def test_language(documents, odd_rows, spark):
    langs = ["aa", "bb", "cc"]
    rows = [(i, speech(langs[i % 3], 5 + i % 300, i), langs[i % 3], "a") for i in range(600)]
    df = documents(rows)
    may = toxicity.learnable(F.col("doc_id"), 4, 2)
    net = langid.fit(df.where(may))
    predict = langid.predictor(spark, net)
    out = df.where(~may).select("lang", predict(F.col("text")).alias("p")).collect()
    assert len(out) > 100 and sum(r.lang == r.p.lang_pred for r in out) >= 0.98 * len(out)
    assert all(0 < r.p.score <= 1 for r in out)
    odd = documents(odd_rows + [(20, "123 ... ☃", "aa", "a")]).select("doc_id", "text", predict(F.col("text")).alias("p")).collect()
    for r in odd:
        lettered = any(c.isalpha() for c in r.text or "")
        assert (r.p.lang_pred in langs and r.p.score > 0) if lettered else r.p == ("und", 0.0)


def test_language_with_nothing_to_learn(documents, spark):
    df = documents([(1, "abc", None, "a"), (2, None, "en", "a")])
    assert langid.fit(df) is None
    assert {tuple(r.p) for r in df.select(langid.predictor(spark, None)(F.col("text")).alias("p")).collect()} == {("und", 0.0)}


def test_windows_cover_every_place():
    texts = ["", None, "a", "b" * 255, "c" * 256, "d" * 257, "e" * 5000, "fg"]
    for part in textbytes.slices(pa.array(texts), 600):
        start, length, row = langid.cut_windows(part)
        for i in range(part.rows):
            own = [(a, n) for a, n, x in zip(start, length, row) if x == i]
            size = int(part.offsets[i + 1] - part.offsets[i])
            places = {p for a, n in own for p in range(a, a + n - 3)} if size >= 4 else set()
            assert places == (set(range(part.offsets[i], part.offsets[i] + size - 3)) if size >= 4 else set())
            assert bool(own) == (size > 0)


def test_tables_equal_the_convolution():
    r = np.random.default_rng(3)
    x = r.integers(0, 256, (5, langid.WINDOW)).astype(np.uint8)
    net = langid.train(x, np.array([0, 1, 0, 1, 1]), ["p", "q"], epochs=1)
    e, places = net.embedding[x], langid.WINDOW - max(langid.WIDTHS) + 1
    h = np.concatenate([(langid._patches(e, w) @ f)[:, :places].max(axis=1) for w, f in zip(langid.WIDTHS, net.filters)], axis=1)
    want = np.maximum(h + net.shifts, 0) @ net.output + net.bias
    assert np.allclose(langid._logits(net, langid._tables(net), x), want, atol=1e-4)


def by_hand(model, text):
    """Score, offending sentences and the worst one of a text, sentence by sentence in plain Python."""
    data = (text or "").encode()
    spans = [match.span() for match in re.finditer(rb"[^\x20\x09-\x0D]+", data)]
    sentences, held = [], []
    for a, b in spans:
        ends = held and (data[held[-1][1] - 1 : held[-1][1]] in (b".", b"!", b"?") or b"\n" in data[held[-1][1] : a] or len(held) == toxicity.LONGEST)
        if ends:
            sentences.append(held)
            held = []
        held = [*held, (a, b)]
    if held:
        sentences.append(held)
    edge = "".join(map(chr, np.flatnonzero(toxicity._EDGE))).encode()
    clean, offending, worst = 1.0, 0, (-1, 0, 0.0)
    for words_ in sentences:
        features = set()
        for a, b in words_:
            word = bytes(c + 32 if 65 <= c <= 90 else c for c in data[a:b])
            word = word.strip(edge) or word
            for i, part in enumerate((word, *(word[:n] for n in toxicity.HEADS))):
                features.add(feature_of(part, i))
        p = 1 / (1 + math.exp(-(sum(float(model.weights[f]) for f in features) + model.bias)))
        clean *= 1 - p
        offending += p >= 0.5
        if p > worst[2] + 1e-12:
            worst = (words_[0][0], words_[-1][1] - words_[0][0], p)
    return 1 - clean if sentences else 0.0, offending, worst


def feature_of(part, head):
    """The feature of a word's bytes: ``head`` 0 for the word, else the n-th of its beginnings."""
    text = textbytes.Text(0, 1, np.frombuffer(part, dtype=np.uint8), np.array([0, len(part)]))
    code = textbytes.words(text).code[0] + np.uint64(head)
    return int(textbytes.mix(np.array([code], dtype=np.uint64))[0] >> np.uint64(64 - toxicity.BITS))


def test_scores_of_whole_texts_by_hand():
    r = random.Random(9)
    vocabulary = ["good", "Villain", "villains", "(villain)", "oaf", "oafish!", "a", "no.", "so?", "...", "é!", "tail"]
    texts = [None, "", " \n ", "villain"] + ["".join(r.choice(vocabulary) + r.choice([" ", " ", " ", "\n", ". ", "\t"]) for _ in range(r.randint(1, 120))) for _ in range(60)]
    weights = np.zeros(1 << toxicity.BITS, dtype=np.float32)
    for word, w in (("villain", 4.0), ("oaf", 1.5), ("no", 0.5), ("good", 0.25)):
        weights[feature_of(word.encode(), 0)] = w
    for word, n in (("vill", 1), ("villa", 2), ("oafi", 1)):
        weights[feature_of(word.encode(), n)] = 2.0
    model = toxicity.Model(weights, -4.0)
    got = []
    for part in textbytes.slices(pa.array(texts), 500):
        got += list(zip(*toxicity._scored(model, part)))
    for text, (score, count, begin, length, worst) in zip(texts, got):
        want, offending, place = by_hand(model, text)
        assert abs(score - want) < 1e-9 and count == offending
        assert abs(worst - place[2]) < 1e-9
        if text and text.strip():
            assert (begin, length) == place[:2]


def test_language_of_whole_texts_by_hand():
    """The mean of the windows' answers, weighted by their lengths, worked out window by window."""
    r = np.random.default_rng(4)
    x = r.integers(0, 256, (6, langid.WINDOW)).astype(np.uint8)
    net = langid.train(x, np.array([0, 1, 2, 0, 1, 2]), ["p", "q", "s"], epochs=2)
    texts = ["a", "Grüße aus Köln. ", "x" * 255, "y" * 257, "Abc déf " * 300, speech("bb", 900, 1)]
    wide = max(langid.WIDTHS)
    step = langid.WINDOW - wide + 1
    for part in textbytes.slices(pa.array(texts), 3000):
        best, score = langid._predict(net, langid._tables(net), part)
        for i in range(part.rows):
            data = bytes(c + 32 if 65 <= c <= 90 else c for c in texts[part.first + i].encode())
            total, share, low = np.zeros(3), 0, 0
            while low == 0 or low < len(data) - wide + 1:
                window = data[low : low + langid.WINDOW]
                padded = np.frombuffer(window.ljust(langid.WINDOW), dtype=np.uint8)[None]
                e = net.embedding[padded]
                h = np.concatenate([(langid._patches(e, w) @ f)[0, :step].max(axis=0) for w, f in zip(langid.WIDTHS, net.filters)])
                total += (np.maximum(h + net.shifts, 0) @ net.output + net.bias) * len(window)
                share += len(window)
                low += step
            z = total / share
            p = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
            assert best[i] == p.argmax() and abs(score[i] - p.max()) < 1e-4


def test_language_of_an_empty_table(documents, spark):
    rows = [(i, speech(["aa", "bb"][i % 2], 40, i), ["aa", "bb"][i % 2], "a") for i in range(80)]
    predict = langid.predictor(spark, langid.fit(documents(rows)))
    assert documents(rows).where("doc_id < 0").select(predict(F.col("text")).alias("p")).collect() == []
    assert langid.fit(documents(rows).where("doc_id < 0")) is None
