"""Toxicity by multiple-instance learning.

Labels mark documents; what offends is a sentence.  A sentence's probability is logistic in its
words and word beginnings (hashed into a fixed table), and a document's is the noisy-or of its
sentences, 1 - product(1 - p).  The weights are trained from document labels through the noisy-or
on a bounded sample, so no sentence needs a label, and the trained sentences' probabilities then
locate what offends.

Only features that toxic documents of the sample have more often than chance allows get a weight;
they are found from counts per feature, so the driver sees no texts and few numbers.

The sample: at most ``SAMPLE`` toxic and twice as many other labelled documents, of at most
``SAMPLE_BYTES`` bytes each, first by a hash of the id.  Everything else sees all of all texts.

A sentence ends at ``.``, ``!``, ``?`` or a line's end, or after ``LONGEST`` words.

Defined cases: null and empty texts, and texts without words, score 0; null labels are ignored; of a
document's labels the highest counts; without labels of both kinds every score is 0.  Rows are scored one by
one, so repeated rows, null ids and extra columns change nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from abundix.llm import textbytes
from abundix.session import cut_lineage

SAMPLE = 2_000
SAMPLE_BYTES = 100_000
BITS = 18
LONGEST = 32
HEADS = (4, 5, 6)
THRESHOLD = 0.7

_EDGE = np.zeros(256, dtype=bool)
_EDGE[[ord(c) for c in "\"'()*,-.:;!?[]_`{|}~#$%&+/<=>@^\\"]] = True
_STOP = np.zeros(256, dtype=bool)
_STOP[[ord(c) for c in ".!?"]] = True


class Model(NamedTuple):
    weights: np.ndarray
    bias: float


class _Sentences(NamedTuple):
    found: textbytes.Words
    sentence: np.ndarray  # of each word
    row: np.ndarray  # of each sentence
    features: np.ndarray  # word x feature


def _sentences(text: textbytes.Text) -> _Sentences:
    found = textbytes.words(text, textbytes.LOWER, _EDGE, HEADS)
    n = len(found.code)
    if n == 0:
        none = np.zeros(0, dtype=np.int64)
        return _Sentences(found, none, none, np.zeros((0, len(HEADS) + 1), dtype=np.int64))
    lines = np.concatenate([[0], np.cumsum(text.data == 10)])
    begins = np.ones(n, dtype=bool)
    begins[1:] = _STOP[text.data[found.end[:-1] - 1]] | (lines[found.start[1:]] > lines[found.end[:-1]]) | (found.row[1:] != found.row[:-1])
    first = np.flatnonzero(begins)
    place = np.arange(n) - np.repeat(first, np.diff(np.append(first, n)))
    begins |= place % LONGEST == 0
    sentence = np.cumsum(begins) - 1
    codes = [found.code, *(h + np.uint64(i + 1) for i, h in enumerate(found.heads))]
    features = np.stack([(textbytes.mix(c) >> np.uint64(64 - BITS)).astype(np.int64) for c in codes], axis=1)
    return _Sentences(found, sentence, found.row[begins], features)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def telling(hit: np.ndarray, miss: np.ndarray, n: float, k: float, least: float = 18.0) -> np.ndarray:
    """Features more frequent in toxic documents than chance allows (likelihood ratio of at least ``least``).

    ``hit`` of ``n`` toxic and ``miss`` of ``k`` other documents have the feature.
    """

    def part(seen: np.ndarray, expected: np.ndarray) -> np.ndarray:
        return np.where(seen > 0, seen * np.log(np.maximum(seen, 1e-12) / np.maximum(expected, 1e-12)), 0.0)

    share = (hit + miss) / (n + k)
    ratio = 2 * (part(hit, n * share) + part(miss, k * share) + part(n - hit, n * (1 - share)) + part(k - miss, k * (1 - share)))
    return np.flatnonzero((hit * k > miss * n) & (ratio >= least))


def train(
    features: np.ndarray,
    sentence: np.ndarray,
    doc: np.ndarray,
    toxic: np.ndarray,
    kept: np.ndarray,
    rounds: int = 300,
    rate: float = 0.2,
    decay: float = 1e-5,
) -> Model:
    """Fit by projected Adam on the noisy-or likelihood, whole sample per step; weights are not negative.

    ``features`` and ``sentence``: one entry per (sentence, feature); ``doc``: of each sentence;
    ``toxic``: of each document; ``kept``: the features that get a weight.
    """
    index = np.full(1 << BITS, -1)
    index[kept] = np.arange(len(kept))
    use = index[features] >= 0
    pairs = np.unique(index[features[use]] * (len(doc) + 1) + sentence[use])
    features, sentence = pairs // (len(doc) + 1), pairs % (len(doc) + 1)
    weights = np.zeros(len(kept) + 1)
    weights[-1] = -7.0
    m, v = np.zeros_like(weights), np.zeros_like(weights)
    positive = toxic[doc] > 0
    for t in range(1, rounds + 1):
        p = _sigmoid(np.bincount(sentence, weights=weights[features], minlength=len(doc)) + weights[-1])
        clean = np.bincount(doc, weights=np.log1p(-np.minimum(p, 1 - 1e-12)), minlength=len(toxic))
        odds = 1 / np.expm1(np.minimum(-clean, 30) + 1e-12)  # (1-P)/P
        slope = np.where(positive, -odds[doc] * p, p) / len(toxic)
        grad = np.append(np.bincount(features, weights=slope[sentence], minlength=len(kept)), slope.sum())
        grad[:-1] += decay
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        weights -= rate * (1 - t / (rounds + 1)) * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
        weights[:-1] = np.maximum(weights[:-1], 0)
    table = np.zeros(1 << BITS, dtype=np.float32)
    table[kept] = weights[:-1]
    return Model(table, float(weights[-1]))


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", sample: int = SAMPLE) -> Model:
    """Train on the bounded sample; ``labels`` has ``doc_id`` and ``label``, and only rows that may be learned from."""
    marks = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    marks = marks.groupBy("doc_id").agg(F.max(label).alias("_toxic"))
    short = docs.where(F.octet_length(text) <= SAMPLE_BYTES)
    known = marks.join(short.select(F.col(doc_id).alias("doc_id")).distinct(), "doc_id", "left_semi")
    order = F.xxhash64("doc_id"), F.col("doc_id")
    some = known.where("_toxic = 1").orderBy(*order).limit(sample)
    some = some.unionByName(known.where("_toxic <> 1").orderBy(*order).limit(2 * sample))
    chosen = F.broadcast(some.withColumnRenamed("doc_id", "_id"))  # at most three times ``sample`` rows of two numbers
    rows = short.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(chosen, F.col("doc_id") == F.col("_id"))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Documents per feature and label; feature -1 counts all documents."""
        size = 1 << BITS
        for batch in batches:
            toxic = batch.column(1).to_numpy(zero_copy_only=False) == 1
            for part in textbytes.slices(batch.column(0)):
                s = _sentences(part)
                own = toxic[part.first : part.first + part.rows]
                seen = np.unique(s.features + (s.found.row << BITS)[:, None])
                of = own[seen >> BITS]
                hit = np.bincount(seen[of] & (size - 1), minlength=size)
                miss = np.bincount(seen[~of] & (size - 1), minlength=size)
                some = np.flatnonzero(hit + miss)
                yield pa.record_batch(
                    {
                        "feature": pa.array(np.append(some, -1), pa.int64()),
                        "hit": pa.array(np.append(hit[some], own.sum()), pa.int64()),
                        "miss": pa.array(np.append(miss[some], (~own).sum()), pa.int64()),
                    }
                )

    rows = cut_lineage(rows.select("text", "_toxic"))
    counts = rows.mapInArrow(textbytes.freeing(counted), "feature long, hit long, miss long").groupBy("feature").agg(F.sum("hit").alias("hit"), F.sum("miss").alias("miss"))
    counts = counts.toPandas().set_index("feature").reindex(range(-1, 1 << BITS), fill_value=0)  # as many rows as the table
    hit, miss = counts["hit"].to_numpy(dtype=float), counts["miss"].to_numpy(dtype=float)
    if not (hit[0] and miss[0]):
        return Model(np.zeros(1 << BITS, dtype=np.float32), -30.0)
    kept = telling(hit[1:], miss[1:], hit[0], miss[0])
    wanted = np.zeros(1 << BITS, dtype=bool)
    wanted[kept] = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in textbytes.slices(batch.column(0)):
                s = _sentences(part)
                word, column = np.nonzero(wanted[s.features])
                feature, sentence = s.features[word, column], s.sentence[word]
                at = np.searchsorted(s.found.row[word], np.arange(part.rows + 1))
                low = np.searchsorted(s.row, np.arange(part.rows + 1))
                yield pa.record_batch(
                    {
                        "toxic": batch.column(1).slice(part.first, part.rows).cast(pa.int32()),
                        "sentences": pa.array(np.diff(low), pa.int64()),
                        "sentence": pa.array([(sentence[a:b] - c).astype("<i4").tobytes() for a, b, c in zip(at[:-1], at[1:], low[:-1])], pa.binary()),
                        "features": pa.array([feature[a:b].astype("<i4").tobytes() for a, b in zip(at[:-1], at[1:])], pa.binary()),
                    }
                )

    got = rows.mapInArrow(textbytes.freeing(run), "toxic int, sentences long, sentence binary, features binary").toPandas()
    toxic = (got["toxic"].to_numpy(dtype=np.int64) == 1).astype(np.int64)
    starts = np.concatenate([[0], np.cumsum(got["sentences"].to_numpy())])
    sentence = np.concatenate([np.frombuffer(b, "<i4") + a for b, a in zip(got["sentence"], starts[:-1])])
    features = np.concatenate([np.frombuffer(b, "<i4") for b in got["features"]]).astype(np.int64)
    doc = np.repeat(np.arange(len(got)), np.diff(starts))
    return train(features, sentence.astype(np.int64), doc, toxic, kept)


def _scored(model: Model, part: textbytes.Text) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per row: probability, number of offending sentences, and the worst sentence's place in bytes, length and probability."""
    s = _sentences(part)
    score, count = np.zeros(part.rows), np.zeros(part.rows, dtype=np.int64)
    begin, length, worst = np.full(part.rows, -1), np.zeros(part.rows, dtype=np.int64), np.zeros(part.rows)
    if len(s.row) and model.bias > -30:
        # a feature counts once in a sentence
        n = len(s.row)
        flat = s.features + (s.sentence << BITS)[:, None]
        weight = model.weights[s.features]
        heavy = np.abs(weight) > 1e-6
        one = np.unique(flat[heavy])
        z = np.bincount(one >> BITS, weights=model.weights[one & ((1 << BITS) - 1)], minlength=n) + model.bias
        p = _sigmoid(z)
        score = -np.expm1(np.bincount(s.row, weights=np.log1p(-p), minlength=part.rows))
        count = np.bincount(s.row, weights=p >= 0.5, minlength=part.rows).astype(np.int64)
        order = np.lexsort((-p, s.row))
        rows, at = np.unique(s.row[order], return_index=True)
        top = order[at]
        first = np.searchsorted(s.sentence, top)
        last = np.searchsorted(s.sentence, top, side="right") - 1
        begin[rows] = s.found.start[first] - part.offsets[rows]
        length[rows] = s.found.end[last] - s.found.start[first]
        worst[rows] = p[top]
    return score, count, begin, length, worst


_RESULT = "score double, n_offending long, worst_start long, worst_length long, worst_score double"


def scorer(spark, model: Model):
    """A column function of a text: score, number of offending sentences, and the worst one's byte span and probability."""
    shared = spark.sparkContext.broadcast(model)

    names = ["score", "n_offending", "worst_start", "worst_length", "worst_score"]

    @F.arrow_udf(_RESULT)
    def score(texts: pa.Array) -> pa.Array:
        parts = [_scored(shared.value, part) for part in textbytes.slices(texts)]
        columns = [np.concatenate(c) for c in zip(*parts)] if parts else [np.zeros(0), *[np.zeros(0, dtype=np.int64)] * 3, np.zeros(0)]
        textbytes.release()
        return pa.StructArray.from_arrays([pa.array(c) for c in columns], names)

    return score


def learnable(doc_id: Column, folds: int, held: int) -> Column:
    """False for held-out rows: those whose crc32 of the id as text leaves ``held`` modulo ``folds``."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds != held, F.lit(False))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, text: str = "text", **options) -> DataFrame:
    """The rows whose score is below ``threshold``, with all their columns."""
    score = scorer(docs.sparkSession, fit(docs, labels, text=text, **options))
    return docs.where(score(F.col(text))["score"] < threshold)
