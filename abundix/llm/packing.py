"""Order-preserving packing into token windows by dynamic programming.

The documents of a partition form one stream of tokens in their order.  A window may end where a
document or a sentence ends, and inside a sentence only where no such place is near.  The cuts are
chosen to minimise

    padding + a penalty for every cut inside a document + a small price per window,

where a window of length L is padded to ``window`` unless L is a power of two.  With
f(j) the best cost of cutting the stream up to place j,

    f(j) = penalty(j) + price + min( f(i) + window - (j - i)  over i within the window,
                                     f(j - 2^k) for 2^k from a 64th of the window ).

The first minimum is that of f(i) + i over a sliding range of places, which a monotone queue keeps
in constant time per place.

The stream is worked off in stretches of about a million tokens, each packed on its own, so memory
does not depend on the length of a partition or of a document.  Nothing is shuffled; a lost task
repeats the same cuts.

Words are tokenised once per distinct word: words are found and hashed as numpy arrays, known
words are looked up, and only new ones go through the vocabulary's merges.  The memory for known
words is bounded.

Defined cases: null text is empty; an empty text has the end token alone; a text of any length is cut;
rows are packed one by one, also when they share an id or have none; other columns are ignored.
"""

from __future__ import annotations

import json
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from abundix.llm import textbytes

WINDOW = 4096
END_ID = 2
CUT_SENTENCE = 8
CUT_INSIDE = 64
WINDOW_PRICE = 64
STRETCH = 1 << 20
KNOWN_WORDS = 4_000_000
KNOWN_PIECES = 500_000

_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class Tokenizer:
    """Ids of a byte-level BPE vocabulary with word ends, in lower case, white space dropped.

    Words of plain Latin text are merged with ranks taken from the vocabulary file; a word with any
    other character is left to the ``tokenizers`` library.  ``\\xff`` stands for the end of a word: it
    occurs in no UTF-8 text, and pairs with it rank first as their ids are the lowest after single bytes.
    """

    # Fixed value: how the vocabulary parts words.
    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
    WORD_END = "</w>"

    def __init__(self, path: str):
        import regex
        import tiktoken
        from tokenizers import Tokenizer as Library

        self.library = Library.from_file(path)
        with open(path, encoding="utf-8") as f:
            stored = json.load(f)
        special = {t["content"] for t in stored["added_tokens"]}
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        letters = {chr(b): b for b in plain}
        letters |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}
        ranks, self.size = {}, max(stored["model"]["vocab"].values()) + 1
        ends = np.zeros(self.size, dtype=bool)
        for token, i in stored["model"]["vocab"].items():
            if token in special:
                continue
            closed = token.endswith(self.WORD_END) and token != self.WORD_END
            name = token[: -len(self.WORD_END)] if closed else token
            ranks[bytes(letters[c] for c in name) + b"\xff" * closed] = i
            ends[i] = closed and name[-1] in ".!?"
        self.sentence_end = ends
        self._merge = tiktoken.Encoding("words", pat_str=self.PATTERN, mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece
        self._split = regex.compile("\n|" + self.PATTERN).findall
        self._simple = regex.compile("[!-;=-~¡-ɏ\n]+").fullmatch
        self._pieces: dict[str, list[int]] = {}
        self._forget()

    def _forget(self) -> None:
        self._codes = np.zeros(0, dtype=np.uint64)  # hashes of the known words, sorted
        self._begin = np.zeros(0, dtype=np.int64)
        self._count = np.zeros(0, dtype=np.int32)
        self._ids = np.zeros(0, dtype=np.uint32)

    def _piece(self, part: str) -> list[int]:
        ids = self._pieces.get(part)
        if ids is None:
            if len(self._pieces) >= KNOWN_PIECES:
                self._pieces.clear()
            ids = self._pieces[part] = self._merge(part.encode() + b"\xff")
        return ids

    def _words(self, new: list[str]) -> tuple[list[int], list[int]]:
        """Ids of the words one after the other, and where each word's end."""
        out: list[int] = []
        ends: list[int] = []
        joined = "\n".join(new)
        if self._simple(joined):
            for part in self._split(joined.lower()):
                if part == "\n":
                    ends.append(len(out))
                else:
                    out += self._piece(part)
            ends.append(len(out))
            return out, ends
        for word in new:
            if self._simple(word):
                for part in self._split(word.lower()):
                    out += self._piece(part)
            else:
                out += self.library.encode(word, add_special_tokens=False).ids
            ends.append(len(out))
        return out, ends

    def _learn(self, codes: np.ndarray, words: list[str]) -> None:
        """Add words; ``codes`` are sorted and unknown."""
        flat: list[int] = []
        counts = []
        for low in range(0, len(words), 256):
            ids, ends = self._words(words[low : low + 256])
            flat += ids
            counts.append(np.diff(ends, prepend=0))
        count = np.concatenate(counts).astype(np.int32)
        begin = len(self._ids) + np.cumsum(count) - count
        at = np.searchsorted(self._codes, codes)
        self._codes = np.insert(self._codes, at, codes)
        self._begin = np.insert(self._begin, at, begin)
        self._count = np.insert(self._count, at, count)
        self._ids = np.concatenate([self._ids, np.array(flat, dtype=np.uint32)])

    def rows(self, text: textbytes.Text) -> Iterator[np.ndarray]:
        """The ids of each row."""
        found = textbytes.words(text)
        bounds = textbytes.row_bounds(found, text.rows)
        if len(found.code) == 0:
            for _ in range(text.rows):
                yield np.zeros(0, dtype=np.uint32)
            return
        which, codes = pd.factorize(found.code)
        place = np.searchsorted(self._codes, codes)
        new = place == len(self._codes)
        new[~new] = self._codes[place[~new]] != codes[~new]
        if new.any():
            if len(self._codes) + int(new.sum()) > KNOWN_WORDS:
                self._forget()
                new[:] = True
            first = np.empty(len(codes), dtype=np.int64)
            first[which[::-1]] = np.arange(len(which) - 1, -1, -1)
            order = np.flatnonzero(new)
            order = order[np.argsort(codes[order])]
            data = text.data.tobytes()
            spans = zip(found.start[first[order]].tolist(), found.end[first[order]].tolist())
            self._learn(codes[order], [data[a:b].decode("utf-8", "replace") for a, b in spans])
            place = np.searchsorted(self._codes, codes)
        counts = self._count[place][which]
        edge = np.concatenate([[0], np.cumsum(counts)])
        source = np.repeat(self._begin[place][which] - edge[:-1], counts) + np.arange(edge[-1])
        ids = self._ids[source]
        limits = edge[bounds]
        for a, b in zip(limits[:-1].tolist(), limits[1:].tolist()):
            yield ids[a:b]


def choose_cuts(
    places: np.ndarray,
    penalties: np.ndarray,
    window: int = WINDOW,
    price: int = WINDOW_PRICE,
) -> list[int]:
    """The places (increasing, from 0, no gap above ``window``) where the windows end, at least total cost."""
    at = places.tolist()
    extra = penalties.tolist()
    index = {p: i for i, p in enumerate(at)}
    powers = [1 << k for k in range(window.bit_length()) if window <= 64 << k <= 64 * window]
    best, back = [0] * len(at), [0] * len(at)
    queue: deque[int] = deque([0])
    for j in range(1, len(at)):
        here = at[j]
        low = here - window
        while at[queue[0]] < low:
            queue.popleft()
        i = queue[0]
        cost, source = best[i] + window - here + at[i], i
        for p in powers:
            i = index.get(here - p)
            if i is not None and best[i] < cost:
                cost, source = best[i], i
        best[j] = cost + extra[j] + price
        back[j] = source
        key = best[j] + here
        while queue and best[queue[-1]] + at[queue[-1]] >= key:
            queue.pop()
        queue.append(j)
    cuts, j = [], len(at) - 1
    while j:
        cuts.append(at[j])
        j = back[j]
    return cuts[::-1]


def _places(ids: np.ndarray, doc_ends: np.ndarray, sentence_end: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Where a window may end, and the penalty there: documents, sentences, and steps inside long sentences."""
    total = len(ids)
    ends = np.flatnonzero(sentence_end[np.minimum(ids, len(sentence_end) - 1)]) + 1
    natural = np.union1d(np.concatenate([[0], ends]), doc_ends)
    step = max(1, window // 16)
    gaps = np.diff(natural)
    wide = np.flatnonzero(gaps > step)
    inner = [np.arange(natural[i] + step, natural[i + 1], step) for i in wide]
    inside = np.concatenate(inner) if inner else np.zeros(0, dtype=np.int64)
    places = np.union1d(natural, inside)
    penalty = np.full(len(places), CUT_SENTENCE, dtype=np.int64)
    penalty[np.searchsorted(places, inside)] = CUT_INSIDE
    penalty[np.searchsorted(places, doc_ends)] = 0
    penalty[places == total] = 0
    return places, penalty


class _Packer:
    """Packs a partition's stream, stretch by stretch."""

    def __init__(self, tokenizer: Tokenizer, window: int, partition: int):
        self.tokenizer, self.window = tokenizer, window
        self.sequence = partition << 40
        self.docs: list[tuple[int | None, int, int, int]] = []  # id, its ids before, ids here, all its ids
        self.ids: list[np.ndarray] = []
        self.held = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> Iterator[pa.RecordBatch]:
        start, total = 0, len(ids)
        while start < total:
            part = ids[start : start + STRETCH - self.held]
            self.docs.append((doc_id, start, len(part), total))
            self.ids.append(part)
            self.held += len(part)
            start += len(part)
            if self.held >= STRETCH:
                yield self.pack()

    def pack(self) -> pa.RecordBatch:
        ids = np.concatenate(self.ids) if self.ids else np.zeros(0, dtype=np.uint32)
        lengths = np.array([d[2] for d in self.docs], dtype=np.int64)
        doc_ends = np.cumsum(lengths)
        places, penalty = _places(ids, doc_ends, self.tokenizer.sentence_end, self.window)
        cuts = np.array(choose_cuts(places, penalty, self.window), dtype=np.int64)
        edges = np.union1d(np.concatenate([[0], doc_ends]), cuts)
        low, high = edges[:-1], edges[1:]
        doc = np.searchsorted(doc_ends, low, side="right")
        which = np.searchsorted(cuts, low, side="right")
        window_start = np.concatenate([[0], cuts])[which] if len(cuts) else low
        before = np.array([d[1] for d in self.docs], dtype=np.int64) - (doc_ends - lengths)
        raw = memoryview(np.ascontiguousarray(ids, dtype="<u4")).cast("B")
        out = pa.record_batch(
            {
                "doc_id": pa.array([self.docs[i][0] for i in doc.tolist()], pa.int64()),
                "start": before[doc] + low if len(low) else low,
                "length": high - low,
                "ids_crc32": pa.array([zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(low.tolist(), high.tolist())], pa.int64()),
                "doc_tokens": pa.array([self.docs[i][3] for i in doc.tolist()], pa.int64()),
                "sequence_id": self.sequence + which,
                "offset": low - window_start,
            }
        )
        self.sequence += len(cuts)
        self.docs, self.ids, self.held = [], [], 0
        return out


_TOKENIZERS: dict[str, Tokenizer] = {}


def pack_documents(
    docs: DataFrame, tokenizer_path: str, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, end_id: int = END_ID
) -> DataFrame:
    """Pieces of documents and their place in the sequences: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``tokenizer_path`` must exist on every executor.  Sequence ids are unique, with the partition in
    the high bits, and rise in the order of the stream within a partition.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        if tokenizer_path not in _TOKENIZERS:
            _TOKENIZERS[tokenizer_path] = Tokenizer(tokenizer_path)
        tokenizer = _TOKENIZERS[tokenizer_path]
        packer = _Packer(tokenizer, window, TaskContext.get().partitionId())
        end = np.array([end_id], dtype=np.uint32)
        for batch in batches:
            names = batch.column(0).to_pylist()
            for part in textbytes.slices(batch.column(1)):
                for i, ids in enumerate(tokenizer.rows(part)):
                    yield from packer.add(names[part.first + i], np.concatenate([ids, end]))
        if packer.held:
            yield packer.pack()

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(textbytes.freeing(run), _SCHEMA)
