"""Language identification with a byte convolutional network.

A window of ``WINDOW`` bytes is embedded byte by byte, convolved with filters of several widths, each
filter's largest answer is kept (max pooling), and a softmax over the languages follows.  The network
is trained in numpy on windows of a bounded sample: at most ``SAMPLE`` texts per language, first by
a hash of the id, and ``VIEWS`` windows of each.

A text is read whole, in windows that overlap by the widest filter less one, so no filter misses a
place.  The windows' logits are averaged by their share of the text.  As a filter's answer is a sum
over its bytes, each (offset, byte) pair is worked out once as a table, and reading is table look-ups.

Defined cases: null text and text without a letter are ``und`` with score 0; so is every text if there is
nothing to learn from; null languages are not learned; rows are predicted one by one, so repeated rows,
null ids and extra columns change nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from abundix.llm import textbytes

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 8
EMBEDDING = 8
SAMPLE = 500
MAX_LANGUAGES = 500
VIEWS = 4
EPOCHS = 12
_BATCH = 32
_PAD = 32


class Network(NamedTuple):
    languages: list[str]
    embedding: np.ndarray  # byte x embedding
    filters: list[np.ndarray]  # per width: (width * embedding) x filter
    shifts: np.ndarray  # per filter
    output: np.ndarray  # filter x language
    bias: np.ndarray  # per language


def _patches(x: np.ndarray, width: int) -> np.ndarray:
    """windows x places x (width * embedding)"""
    view = np.lib.stride_tricks.sliding_window_view(x, width, axis=1)
    return np.ascontiguousarray(view.transpose(0, 1, 3, 2)).reshape(x.shape[0], -1, width * x.shape[2])


def train(windows: np.ndarray, labels: np.ndarray, languages: list[str], epochs: int = EPOCHS, rate: float = 0.01, seed: int = 1) -> Network:
    """Fit by Adam on the cross entropy; every language weighs the same."""
    rng = np.random.default_rng(seed)
    pooled = FILTERS * len(WIDTHS)
    parts = [rng.normal(0, 0.3, (256, EMBEDDING))]
    parts += [rng.normal(0, (w * EMBEDDING) ** -0.5, (w * EMBEDDING, FILTERS)) for w in WIDTHS]
    parts += [np.zeros(pooled), rng.normal(0, pooled**-0.5, (pooled, len(languages))), np.zeros(len(languages))]
    parts = [p.astype(np.float32) for p in parts]
    m, v, t = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts], 0
    weight = 1 / np.maximum(np.bincount(labels, minlength=len(languages)), 1)
    weight = (weight[labels] / weight[labels].mean()).astype(np.float32)
    total = epochs * -(-len(windows) // 64)
    for _ in range(epochs):
        order = rng.permutation(len(windows))
        for low in range(0, len(order), 64):
            batch = order[low : low + 64]
            x, y = windows[batch], labels[batch]
            embedding, filters, shifts, output, bias = parts[0], parts[1:-3], parts[-3], parts[-2], parts[-1]
            e = embedding[x]
            kept, patches = [], []
            for w, f in zip(WIDTHS, filters):
                p = _patches(e, w)
                answers = p @ f
                top = answers.argmax(axis=1)  # window x filter
                kept.append((top, np.take_along_axis(answers, top[:, None], 1)[:, 0]))
                patches.append(p)
            h = np.concatenate([k[1] for k in kept], axis=1) + shifts
            a = np.maximum(h, 0)
            z = a @ output + bias
            z = np.exp(z - z.max(axis=1, keepdims=True))
            d = z / z.sum(axis=1, keepdims=True)
            d[np.arange(len(y)), y] -= 1
            d *= weight[batch][:, None] / len(y)
            dh = (d @ output.T) * (h > 0)
            grads = [np.zeros_like(embedding)]
            for i, (w, f) in enumerate(zip(WIDTHS, filters)):
                top, own = kept[i][0], dh[:, i * FILTERS : (i + 1) * FILTERS]
                chosen = np.take_along_axis(patches[i], top[:, :, None], 1)  # window x filter x patch
                grads.append(np.einsum("bf,bfk->kf", own, chosen))
                back = (own[:, :, None] * f.T[None]).reshape(len(y), FILTERS, w, EMBEDDING)
                at = top[:, :, None] + np.arange(w)
                np.add.at(grads[0], np.take_along_axis(x, at.reshape(len(y), -1), 1), back.reshape(len(y), FILTERS * w, EMBEDDING))
            grads += [dh.sum(axis=0), a.T @ d, d.sum(axis=0)]
            t += 1
            step = rate * (1 - t / (total + 1))
            for k, g in enumerate(grads):
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.99 * v[k] + 0.01 * g * g
                parts[k] = parts[k] - step * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.99**t)) + 1e-8)
    return Network(languages, parts[0], list(parts[1:-3]), parts[-3], parts[-2], parts[-1])


def _tables(net: Network) -> list[np.ndarray]:
    """Per offset k: byte x filter, the filters wide enough to reach offset k, widest last."""
    out = []
    for k in range(max(WIDTHS)):
        reach = [net.embedding @ f[k * EMBEDDING : (k + 1) * EMBEDDING] for w, f in zip(WIDTHS, net.filters) if w > k]
        out.append(np.ascontiguousarray(np.concatenate(reach, axis=1), dtype=np.float32))
    return out


def cut_windows(text: textbytes.Text) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start of every window, its length, and its row; an empty row has none."""
    lengths = np.diff(text.offsets)
    step = WINDOW - max(WIDTHS) + 1
    count = np.where(lengths > 0, np.maximum(1, -(-(lengths - max(WIDTHS) + 1) // step)), 0)
    row = np.repeat(np.arange(text.rows), count)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    start = text.offsets[row] + nth * step
    return start, np.minimum(WINDOW, text.offsets[row + 1] - start), row


def window_bytes(text: textbytes.Text, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """windows x ``WINDOW``, in lower case, filled up with blanks."""
    place = np.arange(WINDOW)
    at = np.minimum(start[:, None] + place, len(text.data) - 1)
    return np.where(place < length[:, None], textbytes.LOWER[text.data[at]], _PAD).astype(np.uint8)


def _logits(net: Network, tables: list[np.ndarray], x: np.ndarray) -> np.ndarray:
    n, places = len(x), WINDOW - max(WIDTHS) + 1
    total = FILTERS * len(WIDTHS)
    answers = np.take(tables[0], x[:, :places], axis=0)
    for k in range(1, max(WIDTHS)):
        own = tables[k].shape[1]
        answers[:, :, total - own :] += np.take(tables[k], x[:, k : k + places], axis=0)
    return np.maximum(answers.max(axis=1) + net.shifts, 0) @ net.output + net.bias


def _predict(net: Network, tables: list[np.ndarray], text: textbytes.Text) -> tuple[np.ndarray, np.ndarray]:
    """Per row the index of the likeliest language and its probability."""
    start, length, row = cut_windows(text)
    sums = np.zeros((text.rows, len(net.languages)))
    for low in range(0, len(start), _BATCH):
        part = slice(low, low + _BATCH)
        z = _logits(net, tables, window_bytes(text, start[part], length[part]))
        np.add.at(sums, row[part], z * length[part, None])
    share = np.bincount(row, weights=length, minlength=text.rows)
    z = sums / np.maximum(share, 1)[:, None]
    p = np.exp(z - z.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    best = p.argmax(axis=1)
    return best, p[np.arange(text.rows), best]


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE) -> Network | None:
    """Train on a bounded sample of ``docs``, all of whose languages may be learned; None if there is no language."""
    known = docs.where(F.col(lang).isNotNull() & F.rlike(F.col(text), F.lit("\\p{L}")))
    sizes = dict(known.groupBy(lang).count().limit(MAX_LANGUAGES + 1).collect())
    languages = sorted(sizes)
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not languages:
        return None
    # of a large language only ids with a small hash, about four times the sample, come together to be ordered
    most = F.element_at(F.create_map(*[F.lit(x) for k in languages for x in (k, min(1.0, 4 * sample / sizes[k]))]), F.col("lang"))
    ids = known.select(F.col(doc_id).alias("doc_id"), F.col(lang).alias("lang"))
    ids = ids.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 32)) < most * (1 << 32))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    ids = ids.withColumn("_n", F.row_number().over(order))
    ids = F.broadcast(ids.where(F.col("_n") <= sample).select(F.col("doc_id").alias("_id")).distinct())
    rows = known.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    rows = rows.join(ids, F.col("doc_id") == F.col("_id"), "left_semi").select("text", "lang")

    def views(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in textbytes.slices(batch.column(0)):
                start, length, row = cut_windows(part)
                count = np.bincount(row, minlength=part.rows)
                nth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                keep = nth % np.maximum(1, -(-count // VIEWS))[row] == 0
                seen = window_bytes(part, start[keep], length[keep])
                yield pa.record_batch(
                    {
                        "lang": batch.column(1).slice(part.first, part.rows).take(pa.array(row[keep])),
                        "window": pa.array([w.tobytes() for w in seen], pa.binary()),
                    }
                )

    got = rows.mapInArrow(textbytes.freeing(views), "lang string, window binary").toPandas().sort_values(["lang", "window"])
    windows = np.frombuffer(b"".join(got["window"]), dtype=np.uint8).reshape(-1, WINDOW)
    labels = np.searchsorted(np.array(languages, dtype=object), got["lang"].to_numpy(dtype=object))
    return train(windows, labels, languages)


def predictor(spark, net: Network | None):
    """A column function of a text: (lang_pred, score)."""
    if net is None:
        return lambda text: F.struct(F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = spark.sparkContext.broadcast((net, _tables(net)))

    @F.arrow_udf("lang_pred string, score double")
    def predict(texts: pa.Array) -> pa.Array:
        net, tables = shared.value
        found = [_predict(net, tables, part) for part in textbytes.slices(texts)]
        best = np.concatenate([b for b, _ in found]) if found else np.zeros(0, dtype=np.int64)
        score = np.concatenate([p for _, p in found]) if found else np.zeros(0)
        return pa.StructArray.from_arrays([pa.array(net.languages, pa.string()).take(pa.array(best)), pa.array(score)], ["lang_pred", "score"])

    lettered = lambda text: F.coalesce(F.rlike(text, F.lit("\\p{L}")), F.lit(False))
    none = F.struct(F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    return lambda text: F.when(lettered(text), predict(text)).otherwise(none)
