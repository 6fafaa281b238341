"""Exact n-gram Jaccard join with signature trees.

A document is its set of word shingles.  Two documents link when intersection / union reaches a
threshold; linked documents form components.  The join is exact:

1. Equal sets are one class (by a 128-bit fingerprint); its smallest id stands for it.
2. Routing.  Sets that link differ in at most D shingles, D known from their size.  Shingles are
   dealt by hash into more than D parts, so at least one part is the same in both.  A document is
   routed by the fingerprints of its first parts, of as many that one shared part with shingles in
   it is certain.  Documents that share a fingerprint form a run.  Shared passages rarely fill whole
   parts, so runs hold near copies and little else.
3. Hubs.  In every run the document that is in most runs is compared with the others.  A family of
   copies is mostly one component after that, and costs one comparison per copy.
4. Signature trees.  The runs that still span several components are worked off with trees: leaves
   are documents, nodes hold the bitwise OR of their documents' bitmaps, the range of their sizes and
   of their components.  Two trees (or one with itself) are traversed together; a pair of nodes is
   dropped when the sizes rule a link out, when the bits they share bound the overlap below what a
   link needs, or when both are within one component.  What reaches the leaves is compared.
5. Comparisons count common shingles exactly.

Runs above ``BLOCK`` documents are cut into blocks, and pairs of blocks are traversed by different
tasks; a block that lies in the hub's component is never paired with another such block.

Every table that a later step reads is written to the shared folder.

Defined cases: null text is empty; a document without words is in no run and its own component; a null
id gets a null component and links with nothing; rows that share an id count as one document, equal or
not; sets are compared by 64-bit hashes of their shingles.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from abundix.llm import listed, textbytes
from abundix.llm.components import connected_components
from abundix.session import cut_lineage

SIGNATURE_WORDS = 32
FANOUT = 8
BLOCK = 256
_BAND = 1.4
_FLUSH = 1 << 20
_KEY_BITS = 40


class Rule(NamedTuple):
    """Shingles of ``width`` words; a link needs ``den * intersection >= num * union``."""

    width: int
    num: int
    den: int

    def differ(self, size: int) -> int:
        """The most shingles in which a set of this size and a linked set not smaller can differ."""
        return size * (self.den - self.num) // self.num


def shingle_sets(text: textbytes.Text, width: int) -> Iterator[np.ndarray]:
    """Per row the sorted hashes of its distinct shingles, A-Z in lower case; all words as one if they are fewer than ``width``."""
    found = textbytes.words(text, textbytes.LOWER)
    bounds = textbytes.row_bounds(found, text.rows).tolist()
    code = found.code
    whole = code[: max(0, len(code) - width + 1)]
    for j in range(1, width):
        whole = textbytes.mix(whole * np.uint64(0x9E3779B97F4A7C15) + code[j : j + len(whole)])
    for low, high in zip(bounds[:-1], bounds[1:]):
        if high - low >= width:
            s = np.sort(whole[low : high - width + 1])
            yield s[np.concatenate([[True], s[1:] != s[:-1]])]
        elif high > low:
            one = code[low : low + 1]
            for j in range(low + 1, high):
                one = textbytes.mix(one * np.uint64(0x9E3779B97F4A7C15) + code[j : j + 1])
            yield textbytes.mix(one + np.uint64(high - low))
        else:
            yield code[:0]


class _Bands:
    """Ranges of set sizes; the number of parts is fixed within one."""

    def __init__(self, rule: Rule):
        self.rule, self.low = rule, [1]

    def of(self, size: int) -> int:
        while self.low[-1] <= size:
            self.low.append(max(self.low[-1] + 1, int(self.low[-1] * _BAND)))
        return int(np.searchsorted(self.low, size, side="right")) - 1

    def keys(self, tokens: np.ndarray) -> list[np.ndarray]:
        """Part fingerprints of a set, in every band in which a linked set not larger can be."""
        rule, n = self.rule, len(tokens)
        if rule.differ(n) == 0:
            return []  # only an equal set can link
        out = []
        for band in range(self.of(-(-n * rule.num // rule.den)), self.of(n) + 1):
            most = rule.differ(self.low[band + 1] - 1)
            differ = min(most, rule.differ(n))
            parts = -(-(most + 1) * 23 // 20) + 2
            part = ((tokens >> np.uint64(32)) % np.uint64(parts)).astype(np.int64)
            held = np.bincount(part, minlength=parts) > 0
            sums = np.zeros(parts, dtype=np.uint64)
            np.add.at(sums, part, textbytes.mix(tokens))
            sure = np.arange(1, parts + 1) - differ > np.cumsum(~held)
            if sure.any():
                use = np.flatnonzero(held[: int(sure.argmax()) + 1])
            else:
                use = np.arange(parts)
            out.append(textbytes.mix(sums[use] + textbytes.mix((use + (band << 32)).astype(np.uint64) + np.uint64(1))))
        return out


def _fingerprint(tokens: np.ndarray) -> tuple[int, int]:
    a = textbytes.mix(tokens + np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
    b = textbytes.mix(tokens ^ np.uint64(0x14057B7EF767814F)).sum(dtype=np.uint64)
    return int(np.int64(a)), int(np.int64(b))


def _sets(docs: DataFrame, rule: Rule) -> DataFrame:
    """doc_id, n_shingles and fingerprint per row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in textbytes.slices(batch.column(1)):
                sizes, prints = [], []
                for tokens in shingle_sets(part, rule.width):
                    sizes.append(len(tokens))
                    prints.append(_fingerprint(tokens))
                yield pa.record_batch(
                    {
                        "doc_id": batch.column(0).slice(part.first, part.rows),
                        "n_shingles": pa.array(sizes, pa.int64()),
                        "print1": pa.array([p[0] for p in prints], pa.int64()),
                        "print2": pa.array([p[1] for p in prints], pa.int64()),
                    }
                )

    return docs.mapInArrow(textbytes.freeing(run), "doc_id long, n_shingles long, print1 long, print2 long")


def _planes(values: np.ndarray, width: int) -> bytes:
    """The bytes of 64-bit integers, lowest bytes of all first: equal high bytes lie together and compress."""
    return values.view(np.uint8).reshape(-1, 8).T[:width].tobytes()


def _from_planes(data: list[bytes], width: int, dtype: type) -> np.ndarray:
    out = []
    for d in data:
        n = len(d) // width
        wide = np.zeros((n, 8), dtype=np.uint8)
        wide[:, :width] = np.frombuffer(d, dtype=np.uint8).reshape(width, n).T
        out.append(wide.reshape(-1).view(dtype))
    return np.concatenate(out) if out else np.zeros(0, dtype=dtype)


def _routed(docs: DataFrame, rule: Rule, buckets: int) -> DataFrame:
    """Packed (key, document) postings by bucket of the key; equal sets of a flush post once."""

    def flush(keys: list[np.ndarray], ids: list[int], counts: list[int]) -> pa.RecordBatch:
        key = np.concatenate(keys)
        doc = np.repeat(np.array(ids, dtype=np.int64), counts)
        bucket = ((key >> np.uint64(_KEY_BITS)) % np.uint64(buckets)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        key, doc, bucket = key[order], doc[order], bucket[order]
        first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
        last = np.append(first[1:], len(bucket))
        return pa.record_batch(
            {
                "bucket": pa.array(bucket[first]),
                "keys": pa.array([_planes(key[a:b], _KEY_BITS // 8) for a, b in zip(first, last)], pa.binary()),
                "docs": pa.array([_planes(doc[a:b], 8) for a, b in zip(first, last)], pa.binary()),
            }
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = _Bands(rule)
        keys, ids, counts, held, seen = [], [], [], 0, set()
        for batch in batches:
            names = batch.column(0).to_pylist()
            for part in textbytes.slices(batch.column(1)):
                for i, tokens in enumerate(shingle_sets(part, rule.width)):
                    own = bands.keys(tokens)
                    if not own or (print_ := _fingerprint(tokens)) in seen:
                        continue
                    seen.add(print_)
                    keys += own
                    ids.append(names[part.first + i])
                    counts.append(sum(map(len, own)))
                    held += counts[-1]
                    if held >= _FLUSH:
                        yield flush(keys, ids, counts)
                        keys, ids, counts, held, seen = [], [], [], 0, set()
        if held:
            yield flush(keys, ids, counts)

    return docs.where("doc_id is not null").mapInArrow(textbytes.freeing(run), "bucket int, keys binary, docs binary")


def _bucket_count(sets: DataFrame, rule: Rule) -> int:
    """Buckets of about ``_FLUSH`` postings, and as many as there are shuffle partitions at least.

    A set posts its parts in two bands at most, and has some more parts than shingles in which it may differ.
    """
    parts = F.col("n_shingles") * (1.15 * (rule.den - rule.num) / rule.num) + 4
    postings = sets.agg(F.sum(2 * parts).alias("n")).first().n or 0
    return max(int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(postings / _FLUSH))


def _runs(routed: DataFrame) -> DataFrame:
    """(run, doc): documents that share a key; runs of the same documents have the same name."""

    def find(table: pa.Table) -> pa.Table:
        key = _from_planes(table["keys"].to_pylist(), _KEY_BITS // 8, np.uint64)
        doc = _from_planes(table["docs"].to_pylist(), 8, np.int64)
        order = np.lexsort((doc, key))
        key, doc = key[order], doc[order]
        new = np.concatenate([[True], (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])])
        key, doc = key[new], doc[new]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        size = np.diff(np.append(first, len(key)))
        name = np.add.reduceat(textbytes.mix(doc.astype(np.uint64) + np.uint64(7)), first)
        name = textbytes.mix(name + size.astype(np.uint64))
        wanted = np.zeros(len(first), dtype=bool)
        wanted[np.unique(name, return_index=True)[1]] = True
        wanted &= size > 1
        rows = np.repeat(wanted, size)
        out = pa.table({"run": pa.array(np.repeat(name, size)[rows].view(np.int64)), "doc": pa.array(doc[rows])})
        textbytes.release()
        return out

    return routed.groupBy("bucket").applyInArrow(find, "run long, doc long")


def signature(tokens: np.ndarray) -> np.ndarray:
    bits = np.unique(tokens % np.uint64(SIGNATURE_WORDS * 64))
    words = np.zeros(SIGNATURE_WORDS, dtype=np.uint64)
    np.bitwise_or.at(words, (bits >> np.uint64(6)).astype(np.int64), np.uint64(1) << (bits & np.uint64(63)))
    return words


def _sketches(docs: DataFrame, wanted: DataFrame, rule: Rule) -> DataFrame:
    """Size and bitmap of the wanted documents and perhaps of others; no text is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in textbytes.slices(batch.column(1)):
                sets = list(shingle_sets(part, rule.width))
                yield pa.record_batch(
                    {
                        "doc": batch.column(0).slice(part.first, part.rows),
                        "n": pa.array([len(t) for t in sets], pa.int64()),
                        "bitmap": pa.array([signature(t).tobytes() for t in sets], pa.binary()),
                    }
                )

    rows = docs.where(listed.may_be_listed(wanted, F.col("doc_id")))
    return rows.mapInArrow(textbytes.freeing(run), "doc long, n long, bitmap binary")


def _shingles(docs: DataFrame, wanted: DataFrame, rule: Rule) -> DataFrame:
    """Shingles of the wanted documents and perhaps of others; no text is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in textbytes.slices(batch.column(1)):
                sets = [_planes(t, 8) for t in shingle_sets(part, rule.width)]
                yield pa.record_batch({"doc": batch.column(0).slice(part.first, part.rows), "shingles": pa.array(sets, pa.binary())})

    rows = docs.where(listed.may_be_listed(wanted, F.col("doc_id")))
    return rows.mapInArrow(textbytes.freeing(run), "doc long, shingles binary")


def possible(rule: Rule, n1: np.ndarray, n2: np.ndarray, least1: np.ndarray, least2: np.ndarray, shared: np.ndarray, loss: np.ndarray) -> np.ndarray:
    """Whether sets of sizes ``least1``..``n1`` and ``least2``..``n2`` can link.

    Their bitmaps share ``shared`` bits; ``loss`` is how many shingles one side has beyond its bits.
    """
    overlap = np.minimum(np.minimum(n1, n2), shared + loss)
    enough = overlap * (rule.num + rule.den) >= rule.num * (least1 + least2)
    return enough & (n1 * rule.den >= rule.num * least2) & (n2 * rule.den >= rule.num * least1)


class SignatureTree:
    """Documents in order of component and size, and levels of nodes above them."""

    def __init__(self, n: np.ndarray, bitmap: np.ndarray, component: np.ndarray):
        self.order = np.lexsort((n, component))
        n, bitmap, component = n[self.order], bitmap[self.order], component[self.order]
        loss = n - np.bitwise_count(bitmap).sum(axis=1, dtype=np.int64)
        self.levels = [(bitmap, n, n, component, component, loss)]
        while len(self.levels[-1][1]) > 1:
            b, low, high, c_low, c_high, loss = self.levels[-1]
            at = np.arange(0, len(low), FANOUT)
            self.levels.append(
                (
                    np.bitwise_or.reduceat(b, at, axis=0),
                    np.minimum.reduceat(low, at),
                    np.maximum.reduceat(high, at),
                    np.minimum.reduceat(c_low, at),
                    np.maximum.reduceat(c_high, at),
                    np.maximum.reduceat(loss, at),
                )
            )

    def level(self, k: int) -> tuple[np.ndarray, ...]:
        return self.levels[min(k, len(self.levels) - 1)]


def traverse(one: SignatureTree, other: SignatureTree, rule: Rule) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of documents (as numbered before ordering) of different components whose link cannot be ruled out."""
    same = one is other
    i, j = np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64)
    for k in range(max(len(one.levels), len(other.levels)) - 1, -1, -1):
        a, b = one.level(k), other.level(k)
        keep = []
        for low in range(0, len(i), 1 << 16):
            p, q = i[low : low + (1 << 16)], j[low : low + (1 << 16)]
            shared = np.bitwise_count(a[0][p] & b[0][q]).sum(axis=1, dtype=np.int64)
            ok = possible(rule, a[2][p], b[2][q], a[1][p], b[1][q], shared, np.minimum(a[5][p], b[5][q]))
            ok &= (a[3][p] != a[4][p]) | (b[3][q] != b[4][q]) | (a[3][p] != b[3][q])
            keep.append(ok)
        keep = np.concatenate(keep) if keep else np.zeros(0, dtype=bool)
        i, j = i[keep], j[keep]
        if k == 0:
            break
        for tree, first in ((one, True), (other, False)):
            if k >= len(tree.levels):
                continue  # the lower tree waits at its root
            below = len(tree.levels[k - 1][1])
            at = i if first else j
            child = (at[:, None] * FANOUT + np.arange(FANOUT)).ravel()
            i, j = (child, np.repeat(j, FANOUT)) if first else (np.repeat(i, FANOUT), child)
            ok = child < below
            i, j = i[ok], j[ok]
        if same:
            ok = i <= j
            i, j = i[ok], j[ok]
    if same:
        ok = i < j
        i, j = i[ok], j[ok]
    return one.order[i], other.order[j]


def _surviving(members: DataFrame, rule: Rule) -> DataFrame:
    """Distinct pairs (a, b) that the trees of the runs leave; ``members``: run, p, q, side, doc, component, n, bitmap."""

    def find(table: pa.Table) -> pa.Table:
        doc, n = table["doc"].to_numpy(), table["n"].to_numpy()
        component, side = table["component"].to_numpy(), table["side"].to_numpy()
        bitmap = np.frombuffer(b"".join(table["bitmap"].to_pylist()), dtype=np.uint64).reshape(-1, SIGNATURE_WORDS)
        trees = [np.flatnonzero(side == s) for s in np.unique(side)]
        built = [SignatureTree(n[t], bitmap[t], component[t]) for t in trees]
        i, j = traverse(built[0], built[-1], rule)
        x, y = doc[trees[0]][i], doc[trees[-1]][j]
        return pa.table({"a": pa.array(np.minimum(x, y)), "b": pa.array(np.maximum(x, y))})

    return members.groupBy("run", "p", "q").applyInArrow(find, "a long, b long").distinct()


def _linked(pairs: DataFrame, sketches: DataFrame, docs: DataFrame, rule: Rule) -> DataFrame:
    """The pairs (a, b) that link: first by sizes and bitmaps, then by counting common shingles.

    Shingles are worked out only for documents of pairs that their bitmaps leave.
    """

    def side(table: DataFrame, name: str, *columns: str) -> DataFrame:
        return table.select(F.col("doc").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in columns])

    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            n = [batch.column(c).to_numpy() for c in (2, 4)]
            bits = [np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint64).reshape(-1, SIGNATURE_WORDS) for c in (3, 5)]
            shared = np.bitwise_count(bits[0] & bits[1]).sum(axis=1, dtype=np.int64)
            loss = np.minimum(*[m - np.bitwise_count(b).sum(axis=1, dtype=np.int64) for m, b in zip(n, bits)])
            yield batch.select([0, 1]).filter(pa.array(possible(rule, n[0], n[1], n[0], n[1], shared, loss)))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                s, t = (_from_planes([v.as_buffer()], 8, np.uint64) for v in (x, y))
                at = np.searchsorted(t, s)
                both = int((t[np.minimum(at, len(t) - 1)] == s).sum()) if len(t) else 0
                keep.append(both > 0 and rule.den * both >= rule.num * (len(s) + len(t) - both))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    light = pairs.join(side(sketches, "a", "n", "bitmap"), "a").join(side(sketches, "b", "n", "bitmap"), "b")
    left = light.select("a", "b", "n_a", "bitmap_a", "n_b", "bitmap_b").mapInArrow(textbytes.freeing(likely), "a long, b long")
    left = cut_lineage(left.distinct())
    if left.isEmpty():
        return left
    wanted = left.select(F.explode(F.array("a", "b")).alias("doc")).distinct()
    sets = cut_lineage(_shingles(docs, wanted, rule).join(wanted, "doc", "left_semi"))
    full = left.join(side(sets, "a", "shingles"), "a").join(side(sets, "b", "shingles"), "b")
    return full.select("a", "b", "shingles_a", "shingles_b").mapInArrow(textbytes.freeing(counted), "a long, b long").distinct()


def _ordered(a: str, b: str) -> list:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _unsettled(members: DataFrame, hubs: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of the runs that span several components, dealt to pairs of blocks (p, q)."""
    named = members.join(labels.select(F.col("node").alias("doc"), "component"), "doc", "left")
    named = named.select("run", "doc", F.coalesce("component", "doc").alias("component"))
    hub = hubs.select("run", F.col("hub").alias("doc")).join(named.select("run", "doc", "component"), ["run", "doc"])
    hub = hub.select("run", F.col("component").alias("main"))
    # a join of its own stage, so that a run of many documents can be split
    named = cut_lineage(named.join(hub, "run").withColumn("settled", (F.col("component") == F.col("main")).cast("long")))
    sizes = named.groupBy("run").agg(F.sum("settled").alias("inside"), F.sum(1 - F.col("settled")).alias("outside")).where("outside > 0")
    small = F.col("inside") + F.col("outside") <= BLOCK
    sizes = sizes.select(
        "run",
        F.when(small, 0).otherwise(F.ceil(F.col("inside") / BLOCK)).alias("inner"),
        F.when(small, 1).otherwise(F.ceil(F.col("outside") / BLOCK)).alias("outer"),
    )
    # written, so that its size is known: where it is small, runs are not dealt out anew
    named = named.join(cut_lineage(sizes), "run")
    spread = F.pmod(F.xxhash64("doc"), F.greatest(F.when(F.col("settled") == 1, F.col("inner")).otherwise(F.col("outer")), F.lit(1)))
    own = F.when(F.col("inner") == 0, F.lit(0).cast("long")).when(F.col("settled") == 1, spread).otherwise(F.col("inner") + spread)
    # a settled block meets the unsettled ones; an unsettled block meets all
    partners = F.when((F.col("inner") > 0) & (F.col("settled") == 1), F.sequence("inner", F.col("inner") + F.col("outer") - 1)).otherwise(
        F.sequence(F.lit(0).cast("long"), F.col("inner") + F.col("outer") - 1)
    )
    named = named.withColumn("own", own).withColumn("other", F.explode(partners))
    return named.select("run", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"), F.col("own").alias("side"), "doc", "component")


def jaccard_components(docs: DataFrame, width: int, num: int, den: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (the smallest id reachable by links)."""
    rule = Rule(width, num, den)
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    sets = cut_lineage(_sets(docs, rule))
    buckets = _bucket_count(sets, rule)
    key = ["n_shingles", "print1", "print2"]
    classes = sets.where("n_shingles > 0 and doc_id is not null").groupBy(*key).agg(F.min("doc_id").alias("rep"))
    reps = cut_lineage(sets.join(classes, key, "left").select("doc_id", "n_shingles", "rep"))

    runs = cut_lineage(_runs(_routed(docs, rule, buckets)).distinct())
    known = reps.select(F.col("doc_id").alias("doc"), "rep").where("rep is not null").distinct()
    members = runs.join(known, "doc").select("run", F.col("rep").alias("doc")).distinct()
    wide = members.groupBy("run").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    members = cut_lineage(members.join(wide, "run").select("run", "doc"))
    degree = members.groupBy("doc").agg(F.count(F.lit(1)).alias("degree"))
    hubs = members.join(degree, "doc").groupBy("run").agg(F.max(F.struct("degree", (-F.col("doc")).alias("doc"))).alias("m"))
    hubs = cut_lineage(hubs.select("run", (-F.col("m.doc")).alias("hub")))
    sketches = cut_lineage(_sketches(docs, degree.select("doc"), rule))

    pairs = cut_lineage(members.join(hubs, "run").where("doc <> hub").select(*_ordered("doc", "hub")).distinct())
    links = cut_lineage(_linked(pairs, sketches, docs, rule))
    labels = connected_components(links)
    dealt = _unsettled(members, hubs, labels).join(sketches, "doc")
    more = cut_lineage(_surviving(dealt, rule).join(pairs, ["a", "b"], "left_anti"))
    if not more.isEmpty():
        more = cut_lineage(_linked(more, sketches, docs, rule))
        if not more.isEmpty():
            labels = connected_components(links.unionByName(more))
    named = labels.select(F.col("node").alias("rep"), "component")
    return reps.join(named, "rep", "left").select("doc_id", "n_shingles", F.coalesce("component", "rep", "doc_id").alias("component_id"))


def drop_near_copies(docs: DataFrame, width: int = 5, num: int = 8, den: int = 10, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stand for their component (smallest id), with all their columns; rows without an id stay."""
    found = cut_lineage(jaccard_components(docs, width, num, den, doc_id, text))
    gone = cut_lineage(found.where("doc_id <> component_id").select(F.col("doc_id").alias("_gone")).distinct())
    clear, maybe = listed.split(docs, gone, F.col(doc_id).cast("long"))
    return clear.unionByName(maybe.join(gone, F.col(doc_id) == F.col("_gone"), "left_anti"))
