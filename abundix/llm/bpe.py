"""Byte-pair encoding and decoding: speculate, verify, and merge exactly only what fails.

A text is cut into words as the vocabulary's pattern does.  For a batch of new words

1. *speculate*: the longest token that starts at each byte is found for all bytes at once in a trie held as
   arrays, and each word takes the longest match, then the longest match after it, and so on;
2. *verify*: the proposal of a word is what merging gives if, for every two neighbours, merging their joined
   bytes would leave them apart.  All pairs are tested together: the merges that made the two tokens are
   undone from the last to the first, and at no time may the pair at their border have a merge that comes
   earlier than the one just undone;
3. the words with a failing pair, and only these, are merged from their bytes: the short ones all at once, one
   merge of each word a round, the long ones one by one with a heap.

The test is exact for vocabularies in which every token is made by one merge, from parts made by earlier
merges (checked when the file is read; other vocabularies merge every word), and proposes only tokens that
merging gives for their own bytes.

Texts are taken in stretches that end before a word, so the memory for words does not depend on the length
of a text; a text's ids are one array.  Words seen before are looked up; the memory for them is bounded.  No
rows are shuffled and a lost task is repeated with the same result.

Defined cases: null text is empty and has no ids; an empty text has none; rows are encoded one by one, also
when they share an id or have none; texts of any length are encoded whole; an empty table gives an empty one;
other columns are ignored.  Null ids decode to an empty text, ids outside the vocabulary and null ones in a
list to nothing, bytes that are no UTF-8 to replacement characters.  Ids go to and from lists as flat arrays.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from abundix.llm import textbytes

STRETCH = 1 << 18
KNOWN_WORDS = 400_000
LONG_WORD = 1 << 10
SHORT_WORD = 64
DECODED_ROWS = 256
FAR = np.int64(1) << np.int64(40)

# The byte-level alphabet's printable bytes.
PRINTABLE = (range(33, 127), range(161, 173), range(174, 256))

# How the vocabulary parts words ('s|'t|'re|'ve|'m|'ll|'d, then letters, digits and other signs, each with a
# blank before it, then white space), with the letters and digits below U+0250 spelled out.  Other text is
# parted by the tokenizers library.
_LETTERS, _DIGITS, _SPACE = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼-¾", " \t-\r"
_LATIN_WORDS = re.compile(
    rf"'(?:[stmd]|re|ve|ll)| ?[{_LETTERS}]+| ?[{_DIGITS}]+| ?[^{_LETTERS}{_DIGITS}{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]"
).findall
_LATIN = re.compile(f"[!-~¡-ɏ{_SPACE}]*").fullmatch

# A run without white space and the blank before it; of white space before a run all but the last sign, which stands alone.
_RUNS = re.compile(rf" ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]").findall
_WIDE_SPACE = "\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_SAFE_CUT = re.compile(r"(?<=[!-~])(?= [A-Za-z0-9])")


def _letters() -> dict[str, int]:
    """The byte that each letter of the byte-level alphabet stands for."""
    plain = [b for part in PRINTABLE for b in part]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Merges:
    """The merge rules as arrays: what a token is made of, when, and which pairs merge."""

    def __init__(self, size: int, parts: list[tuple[int, int]], made: list[int], byte_ids: list[int], spelled: dict[int, bytes]):
        left, right = (np.array([p[i] for p in parts], dtype=np.int64) for i in (0, 1))
        made_ids = np.array(made, dtype=np.int64)
        self.left, self.right = np.full(size, -1), np.full(size, -1)
        self.rank = np.full(size, -1)
        self.left[made_ids], self.right[made_ids] = left, right
        self.rank[made_ids] = np.arange(len(made))
        self.byte_ids = np.array(byte_ids, dtype=np.int64)
        keys = left << 32 | right
        order = np.argsort(keys, kind="stable")
        self._keys, self._ranks = np.append(keys[order], np.int64(1) << 62), np.append(order, FAR)
        self._pairs = {pair: rank for rank, pair in reversed(list(enumerate(parts)))}
        self._made, self._made_ids, self._byte_list = made, made_ids, byte_ids
        earlier = np.maximum(self.rank[left], self.rank[right]) < np.arange(len(made))
        self.speculates = bool(len(np.unique(made_ids)) == len(made) and earlier.all() and (self.rank[self.byte_ids] < 0).all())
        self._build_trie(spelled)

    def _build_trie(self, spelled: dict[int, bytes]) -> None:
        alone = np.zeros(len(self.rank), dtype=bool)
        alone[self.byte_ids] = True
        if self.speculates:
            made = np.array(self._made, dtype=np.int64)
            kept = self.compatible(self.left[made], self.right[made], joined=True).tolist()
            for token, good in zip(self._made, kept):
                alone[token] = good and alone[self.left[token]] and alone[self.right[token]]
        steps: dict[int, int] = {}
        ends = {}
        for token in np.flatnonzero(alone).tolist():
            node = 0
            for byte in spelled[token]:
                node = steps.setdefault(node << 8 | byte, len(steps) + 1)
            ends[node] = token
        keys = np.array(sorted(steps), dtype=np.int64)
        self._step_keys = np.append(keys, np.int64(1) << 62)
        self._step_to = np.array([*(steps[k] for k in keys.tolist()), 0], dtype=np.int64)
        self._token = np.full(len(steps) + 1, -1)
        self._token[list(ends)] = list(ends.values())

    def _rank_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a << 32 | b
        at = np.searchsorted(self._keys, key)
        return np.where(self._keys[at] == key, self._ranks[at], FAR)

    def compatible(self, u: np.ndarray, v: np.ndarray, joined: bool = False) -> np.ndarray:
        """Whether merging the bytes of u and v together leaves the two tokens apart.

        ``joined``: whether they stay apart until both are whole, their own merge left aside.
        Ranks count twice, as of two merges of the same rank the left one comes first.
        """
        out = np.ones(len(u), dtype=bool)
        todo, a, b = np.arange(len(u)), u.astype(np.int64), v.astype(np.int64)
        limit = np.full(len(u), -1 if joined else 2 * FAR - 1)
        while len(todo):
            crossed = 2 * self._rank_of(a, b) < limit
            out[todo[crossed]] = False
            rank_a, rank_b = self.rank[a], self.rank[b]
            go = ~crossed & (np.maximum(rank_a, rank_b) >= 0)
            todo, a, b, rank_a, rank_b = todo[go], a[go], b[go], rank_a[go], rank_b[go]
            undo_left = rank_a > rank_b
            limit = np.where(undo_left, 2 * rank_a, 2 * rank_b + 1)
            a, b = np.where(undo_left, self.right[a], a), np.where(undo_left, b, self.left[b])
        return out

    def propose(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Longest matches one after the other: the tokens of all words, and each one's word.

        ``ends`` are where the words end in ``data``; no token goes beyond its word.
        """
        n = len(data)
        stop = np.repeat(ends, np.diff(ends, prepend=0))
        best, size = np.full(n, -1), np.zeros(n, dtype=np.int64)
        at, node, depth = np.arange(n), np.zeros(n, dtype=np.int64), 0
        while len(at):
            key = node << 8 | data[at + depth]
            found = np.searchsorted(self._step_keys, key)
            hit = self._step_keys[found] == key
            at, node, depth = at[hit], self._step_to[found[hit]], depth + 1
            token = self._token[node]
            whole = token >= 0
            best[at[whole]], size[at[whole]] = token[whole], depth
            more = at + depth < stop[at]
            at, node = at[more], node[more]
        picked = np.zeros(n, dtype=bool)
        here, end = np.append(0, ends[:-1]), ends
        for _ in range(SHORT_WORD):
            inside = here < end
            here, end = here[inside], end[inside]
            picked[here] = True
            here = here + size[here]
        for low, high in zip(here.tolist(), end.tolist()):
            steps = size[low:high].tolist()
            at = 0
            while at < high - low:
                picked[low + at] = True
                at += steps[at]
        chosen = np.flatnonzero(picked)
        return best[chosen], np.searchsorted(ends, chosen, side="right")

    def merge(self, word: bytes) -> list[int]:
        """Exact merging of one word: always the pair of the lowest rank, the leftmost first."""
        ids = [self._byte_list[b] for b in word]
        return self._merge_short(ids) if len(ids) <= SHORT_WORD else self._merge_long(ids)

    def merge_all(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Exact merging of each word by itself: the tokens of all words, and each one's word, a word's in order."""
        lengths = np.array([len(w) for w in words], dtype=np.int64)
        tokens, owners = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
        for i in np.flatnonzero(lengths > SHORT_WORD).tolist():
            ids = self.merge(words[i])
            tokens.append(np.array(ids, dtype=np.int64))
            owners.append(np.full(len(ids), i))
        for low in range(0, SHORT_WORD, 4):
            band = np.flatnonzero((low < lengths) & (lengths <= low + 4))
            if len(band):
                inside = np.arange(low + 4) < lengths[band, None]
                table = np.full(inside.shape, -1, dtype=np.int64)
                table[inside] = self.byte_ids[np.frombuffer(b"".join([words[i] for i in band.tolist()]), dtype=np.uint8)]
                for rows, ids in self._merge_table(table):
                    whole = ids >= 0
                    tokens.append(ids[whole])
                    owners.append(np.repeat(band[rows], whole.sum(axis=1)))
        return np.concatenate(tokens), np.concatenate(owners)

    def _merge_table(self, ids: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Merges all rows, filled up with -1, at once: each round merges one pair of each and is a column less."""
        rows = np.arange(len(ids))
        ranks = self._rank_of(ids[:, :-1], ids[:, 1:])
        while len(rows):
            here, at = np.arange(len(rows)), ranks.argmin(axis=1)
            low = ranks[here, at]
            ended = low == FAR
            if ended.any():
                yield rows[ended], ids[ended]
                go = ~ended
                rows, ids, ranks, at, low, here = rows[go], ids[go], ranks[go], at[go], low[go], here[: go.sum()]
            ids[here, at] = self._made_ids[low]
            ids, ranks = _without(ids, here, at + 1), _without(ranks, here, at)
            if not ranks.shape[1]:
                yield rows, ids
                return
            for first in (at - 1, at):
                good = (first >= 0) & (first < ranks.shape[1])
                r, f = here[good], first[good]
                ranks[r, f] = self._rank_of(ids[r, f], ids[r, f + 1])

    def _merge_short(self, ids: list[int]) -> list[int]:
        rank_of, made, none = self._pairs.get, self._made, len(self._made)
        ranks = [rank_of(p, none) for p in zip(ids, ids[1:])]
        while ranks and (low := min(ranks)) < none:
            i = ranks.index(low)
            ids[i : i + 2] = (made[low],)
            del ranks[i]
            if i:
                ranks[i - 1] = rank_of((ids[i - 1], ids[i]), none)
            if i < len(ranks):
                ranks[i] = rank_of((ids[i], ids[i + 1]), none)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same with a heap of pairs, for words of any length."""
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        pairs = self._pairs
        heap = [(pairs[p], i) for i, p in enumerate(zip(ids, ids[1:])) if p in pairs]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j >= n or pairs.get((ids[i], ids[j])) != rank:
                continue
            ids[i], ids[j] = self._made[rank], -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
            for x, y in ((before[i], i), (i, k)):
                if x >= 0 and y < n and (r := pairs.get((ids[x], ids[y]))) is not None:
                    heapq.heappush(heap, (r, x))
        return [i for i in ids if i >= 0]


def _without(table: np.ndarray, rows: np.ndarray, column: np.ndarray) -> np.ndarray:
    """The table without one entry of each row."""
    keep = np.ones(table.shape, dtype=bool)
    keep[rows, column] = False
    return table[keep].reshape(len(table), table.shape[1] - 1)


class _Growing:
    """An array that is appended to."""

    def __init__(self, kind: type):
        self._data, self.size = np.zeros(1024, dtype=kind), 0

    def extend(self, more) -> None:
        end = self.size + len(more)
        if end > len(self._data):
            grown = np.zeros(2 * end, dtype=self._data.dtype)
            grown[: self.size] = self._data[: self.size]
            self._data = grown
        self._data[self.size : end] = more
        self.size = end

    def values(self) -> np.ndarray:
        return self._data[: self.size]


class Codec:
    """Ids and bytes of a byte-level vocabulary file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            stored = json.load(f)
        model, letters = stored["model"], _letters()
        shape = stored["pre_tokenizer"] or {}
        odd = [k for k in ("unk_token", "dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges") if model.get(k)]
        odd += [k for t in stored["added_tokens"] for k in ("single_word", "lstrip", "rstrip") if t[k]]
        if odd or stored["normalizer"] or shape.get("type") != "ByteLevel" or shape.get("add_prefix_space") or not shape.get("use_regex"):
            raise ValueError(f"{path} is not a plain byte-level vocabulary: {odd or shape}")
        library = Tokenizer.from_file(path)
        library.no_truncation()
        library.no_padding()
        self._split = library.pre_tokenizer.pre_tokenize_str
        self._letters = letters
        vocab: dict[str, int] = model["vocab"]
        self._added = {t["content"]: t["id"] for t in stored["added_tokens"]}
        spelled = {i: bytes(letters[c] for c in t) for t, i in vocab.items() if t not in self._added}
        size = 1 + max([*vocab.values(), *self._added.values()])
        parts, made = [], []
        for pair in model["merges"]:
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            parts.append((vocab[a], vocab[b]))
            made.append(vocab[a + b])
        letter_of = {b: c for c, b in letters.items()}
        self.merges = Merges(size, parts, made, [vocab[letter_of[b]] for b in range(256)], spelled)
        self.spelled = [b""] * (size + 1)  # the last stands for ids outside the vocabulary
        for i, text in spelled.items():
            self.spelled[i] = text
        for content, i in self._added.items():
            self.spelled[i] = content.encode()
        names = "|".join(re.escape(t) for t in sorted(self._added, key=len, reverse=True))
        self._added_parts = re.compile(f"({names})" if names else "(?!)").split
        self._is_odd = re.compile(f"[{_WIDE_SPACE}]" + (f"|{names}" if names else "")).search
        self._cuts = not any(c.isspace() for t in self._added for c in t)
        self._parted: dict[str, list[str]] = {}
        self._forget()

    def _forget(self) -> None:
        """Start anew with the added tokens, which are words of their own."""
        self._number: dict[str, int] = {t: n for n, t in enumerate(self._added)}
        self._ids = _Growing(np.int32)
        self._begin, self._count = _Growing(np.int64), _Growing(np.int64)
        self._ids.extend(list(self._added.values()))
        self._begin.extend(range(len(self._added)))
        self._count.extend([1] * len(self._added))

    def _stretches(self, text: str) -> Iterator[str]:
        low = 0
        while len(text) - low > STRETCH and self._cuts:
            cut = _SAFE_CUT.search(text, low + STRETCH)
            if cut is None:
                break
            yield text[low : cut.start()]
            low = cut.start()
        yield text[low:] if low else text

    def _native(self, text: str) -> list[str]:
        """Words as the library's own splitter has them."""
        return [bytes(map(self._letters.__getitem__, word)).decode() for word, _ in self._split(text)]

    def _words(self, text: str) -> list[str]:
        """The words of a stretch, added tokens among them."""
        out: list[str] = []
        if self._is_odd(text):
            for i, part in enumerate(self._added_parts(text)):
                out += [part] if i % 2 else self._native(part)
        elif _LATIN(text):
            out = _LATIN_WORDS(text)
        else:
            if len(self._parted) > KNOWN_WORDS:
                self._parted.clear()
            for run in _RUNS(text):
                words = self._parted.get(run)
                if words is None:
                    words = _LATIN_WORDS(run) if _LATIN(run) else self._native(run)
                    if len(run) <= LONG_WORD:
                        self._parted[run] = words
                out += words
        return out

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of all words one after the other, and how many each has; each is encoded by itself."""
        spelled = [w.encode() for w in words]
        if self.merges.speculates:
            ends = np.cumsum([len(w) for w in spelled])
            tokens, word = self.merges.propose(np.frombuffer(b"".join(spelled), dtype=np.uint8), ends)
            within = np.flatnonzero(word[1:] == word[:-1])
            wrong = np.zeros(len(words), dtype=bool)
            wrong[word[within[~self.merges.compatible(tokens[within], tokens[within + 1])]]] = True
            right = ~wrong[word]
            tokens, word = tokens[right], word[right]
        else:
            wrong = np.ones(len(words), dtype=bool)
            tokens = word = np.zeros(0, dtype=np.int64)
        again = np.flatnonzero(wrong)
        merged, owner = self.merges.merge_all([spelled[i] for i in again.tolist()])
        word = np.concatenate([word, again[owner]])
        order = np.argsort(word, kind="stable")
        return np.concatenate([tokens, merged])[order], np.bincount(word, minlength=len(words))

    def _learn(self, words: list[str]) -> None:
        for low in range(0, len(words), 4096):
            part = words[low : low + 4096]
            ids, count = self.encode_words(part)
            first = self._count.size
            self._number.update(zip(part, range(first, first + len(part))))
            self._begin.extend(self._ids.size + np.cumsum(count) - count)
            self._count.extend(count)
            self._ids.extend(ids)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and where each text's begin, with the end of the last."""
        parts: list[np.ndarray] = []
        sizes = [0] * len(texts)
        words: list[str] = []
        spans: list[tuple[int, int]] = []
        held = 0
        for i, text in enumerate(texts):
            for stretch in self._stretches(text):
                found = self._words(stretch)
                words += found
                spans.append((i, len(found)))
                held += len(stretch)
                if held >= STRETCH:
                    parts.append(self._ids_of(words, spans, sizes))
                    words, spans, held = [], [], 0
        parts.append(self._ids_of(words, spans, sizes))
        return np.concatenate(parts), np.cumsum([0, *sizes])

    def _ids_of(self, words: list[str], spans: list[tuple[int, int]], sizes: list[int]) -> np.ndarray:
        """The ids of the words; ``spans`` are (text, words) in order, the texts' ``sizes`` grow by their ids."""
        if not words:
            return np.zeros(0, dtype=np.int32)
        if len(self._number) > KNOWN_WORDS:
            self._forget()
        which = np.fromiter(map(self._number.get, words, repeat(-1)), dtype=np.int64, count=len(words))
        missing = np.flatnonzero(which < 0)
        unknown = [words[i] for i in missing.tolist()]
        new = list(dict.fromkeys(unknown))
        if new:
            self._learn(new)
            which[missing] = [self._number[w] for w in unknown]
        counts = self._count.values()[which]
        edge = np.concatenate([[0], np.cumsum(counts)])
        out = self._ids.values()[np.repeat(self._begin.values()[which] - edge[:-1], counts) + np.arange(edge[-1])]
        word = 0
        for text, n in spans:
            sizes[text] += int(edge[word + n] - edge[word])
            word += n
        if max(map(len, new), default=0) > LONG_WORD:
            self._forget()
        return out

    def decode(self, ids: list[int | None]) -> str:
        return self.decode_lists(pa.array([ids], pa.list_(pa.int32())))[0]

    def decode_lists(self, ids: pa.ListArray) -> list[str]:
        """The text of each list."""
        none, spelled = len(self.spelled) - 1, self.spelled.__getitem__
        out = []
        for first in range(0, len(ids), DECODED_ROWS):
            part = ids[first : first + DECODED_ROWS]
            flat = part.flatten().cast(pa.int64()).fill_null(none).to_numpy(zero_copy_only=False)
            known = np.where((flat >= 0) & (flat < none), flat, none)
            low = 0
            for high in np.cumsum(part.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)).tolist():
                out.append(b"".join(map(spelled, known[low:high].tolist())).decode("utf-8", "replace"))
                low = high
        return out


_CODECS: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def encode_documents(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and ``ids``, the tokens of each whole text; ``path`` must exist on every executor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _by_size(batch):
                names, texts = part.columns
                ids, begin = codec(path).encode(texts.to_pylist())
                lists = pa.ListArray.from_arrays(pa.array(begin, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.record_batch({"doc_id": names, "ids": lists})

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.mapInArrow(textbytes.freeing(run), "doc_id long, ids array<int>")


def _by_size(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Consecutive rows with about a megabyte of text."""
    for part in textbytes.slices(batch.column(1)):
        yield batch.slice(part.first, part.rows)


def decoder(path: str) -> Callable[[Column], Column]:
    """A column function from ids to text."""

    @F.arrow_udf("string")
    def decode(ids: pa.Array) -> pa.Array:
        return pa.array(codec(path).decode_lists(ids), pa.string())

    return decode
