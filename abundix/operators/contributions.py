"""Contribution of organisms to one feature: selection, order and scaling of its strata.

Tables here are ``(stratum, sample, value)``; absent cells are 0.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from abundix.functions.features import OTHER, UNCLASSIFIED
from abundix.operators.scaling import sorted_position, with_group_totals
from abundix.session import cut_lineage

_BLOCK = 256
_CHUNK = 4096


def focal_feature(table: DataFrame, code: str, exclude_unclassified: bool = False) -> DataFrame:
    """Strata of one feature."""
    rows = table.where((F.col("code") == code) & F.col("stratum").isNotNull())
    if exclude_unclassified:
        rows = rows.where(F.col("stratum") != UNCLASSIFIED)
    return rows.select("stratum", "sample", "value")


def drop_zero_samples(table: DataFrame) -> DataFrame:
    """Remove samples whose total is not positive."""
    kept = table.groupBy("sample").agg(F.sum("value").alias("_total")).where(F.col("_total") > 0)
    return table.join(kept.select("sample"), "sample", "left_semi")


def top_taxa(table: DataFrame, n: int) -> DataFrame:
    """The ``n`` strata with the largest mean (ties: last name first), the rest as ``other``.

    ``unclassified`` stays apart.  ``other`` is written only if it is not all zero.
    """
    table = cut_lineage(table)
    # every stratum is averaged over the same samples, so the sum ranks like the mean
    sums = table.where(F.col("stratum") != UNCLASSIFIED).groupBy("stratum").agg(F.sum("value").alias("_sum"))
    best = sums.orderBy(F.col("_sum").desc(), F.col("stratum").desc()).limit(n)
    best = best.select("stratum", F.lit(True).alias("_kept"))
    label = F.when(F.col("_kept") | (F.col("stratum") == UNCLASSIFIED), F.col("stratum")).otherwise(F.lit(OTHER))
    out = table.join(best, "stratum", "left").withColumn("stratum", label)
    out = out.groupBy("stratum", "sample").agg(F.sum("value").alias("value"))
    other_total = out.where(F.col("stratum") == OTHER).agg(F.coalesce(F.sum("value"), F.lit(0.0))).scalar()
    return out.where((F.col("stratum") != OTHER) | (other_total > 0))


def dominant_stratum(table: DataFrame) -> DataFrame:
    """Largest stratum of each sample, and the position of the sample.

    Samples are ordered by their dominant stratum's maximum over all samples, then by
    its amount in the sample, both descending (ties: the later name first).
    """
    dominant = table.groupBy("sample").agg(F.max(F.struct("value", "stratum")).alias("_top"))
    peaks = table.groupBy("stratum").agg(F.max("value").alias("_peak"))
    rows = dominant.select("sample", "_top.stratum", "_top.value").join(peaks, "stratum")
    order = [
        F.col("_peak").desc(), F.col("stratum").desc(), F.col("value").desc(), F.col("sample").asc()
    ]
    return sorted_position(rows, order).drop("_peak")


def order_samples(
    table: DataFrame,
    method: str = "sum",
    metadata: DataFrame | None = None,
    listed: DataFrame | None = None,
) -> DataFrame:
    """Position of every sample: by ``sum``, ``dominant``, ``metadata``, ``file`` or ``none``.

    ``metadata(sample, value)`` sorts by value, ``listed(sample, position)`` gives an
    order from a file.  Ties (and ``none``) go by sample name.
    """
    name = F.col("sample").asc()
    if method == "dominant":
        return dominant_stratum(table).select("sample", "position")
    if method == "sum":
        sums = table.groupBy("sample").agg(F.sum("value").alias("_key"))
        return sorted_position(sums, [F.col("_key").desc(), name]).drop("_key")
    samples = table.select("sample").distinct()
    if method == "none":
        return sorted_position(samples, [name])
    if method == "metadata":
        keyed = samples.join(metadata.select("sample", F.col("value").alias("_key")), "sample")
    elif method == "file":
        keyed = samples.join(listed.select("sample", F.col("position").alias("_key")), "sample")
    else:
        raise ValueError(f"cannot sort with {method!r}")
    return sorted_position(keyed, [F.col("_key").asc(), name]).drop("_key")


def contribution_scaling(table: DataFrame, scaling: str = "original") -> DataFrame:
    """Values as they are, as shares of the sample total, or as shares of its log height.

    ``logstack`` measures heights from the order of magnitude of the smallest positive
    sample total; a total at or below that floor has height 0.
    """
    if scaling == "original":
        return table
    totals = with_group_totals(table, ["sample"], _sum=F.sum("value"))
    total = F.when(F.col("_sum") > 0, F.col("_sum")).otherwise(F.lit(-1.0))
    share = F.col("value") / total
    if scaling == "totalsum":
        return totals.withColumn("value", share).drop("_sum")
    if scaling != "logstack":
        raise ValueError(f"unknown scaling {scaling!r}")
    sums = table.groupBy("sample").agg(F.sum("value").alias("_sum")).where(F.col("_sum") > 0)
    floor = sums.agg(F.floor(F.log10(F.min("_sum")))).scalar()
    crest = F.when(total > F.pow(F.lit(10.0), floor), F.log10(total)).otherwise(floor.cast("double"))
    return totals.withColumn("value", share * (crest - floor)).drop("_sum")


def _block_minima(pdf: pd.DataFrame) -> pd.DataFrame:
    """Sum of minima over one chunk of strata for the sample pairs of two blocks."""
    same_block = pdf["_low"].iat[0] == pdf["_high"].iat[0]
    left, right = pdf[pdf["_left"]], pdf[pdf["_right"]]
    rows, row_names = pd.factorize(left["sample"], sort=True)
    columns, column_names = pd.factorize(right["sample"], sort=True)
    strata = pd.Index(pd.unique(pdf["stratum"]))
    a = np.zeros((len(row_names), len(strata)))
    b = np.zeros((len(column_names), len(strata)))
    np.add.at(a, (rows, strata.get_indexer(left["stratum"])), left["value"].to_numpy())
    np.add.at(b, (columns, strata.get_indexer(right["stratum"])), right["value"].to_numpy())
    parts = []
    for i, name in enumerate(row_names):
        # the pairs of one block are found from both sides: keep the later partner only
        first = i + 1 if same_block else 0
        shared = np.minimum(a[i], b[first:]).sum(axis=1)
        hit = shared > 0
        parts.append(
            pd.DataFrame({"one": name, "two": column_names[first:][hit], "shared": shared[hit]})
        )
    return pd.concat(parts, ignore_index=True) if parts else pd.DataFrame(columns=["one", "two", "shared"])


def braycurtis_pairs(table: DataFrame, pairs: DataFrame, relative: bool = True) -> DataFrame:
    """Bray-Curtis dissimilarity of the wanted ``pairs(sample1, sample2)``, as ``distance``.

    The work follows the pairs and their samples' strata.  A pair that shares no stratum has distance 1, a pair
    with a sample that has nothing is left out.
    """
    cells = table.groupBy("stratum", "sample").agg(F.sum("value").alias("value")).where(F.col("value") > 0)
    if relative:
        cells = contribution_scaling(cells, "totalsum")
    cells = cut_lineage(cells)
    totals = cells.groupBy("sample").agg(F.sum("value").alias("total"))
    pairs = pairs.select("sample1", "sample2").distinct()

    def side(df: DataFrame, i: int, *columns: str) -> DataFrame:
        return df.select(F.col("sample").alias(f"sample{i}"), *[F.col(c).alias(f"_{c}{i}") for c in columns])

    one = pairs.join(side(cells, 1, "stratum", "value"), "sample1").withColumnRenamed("_stratum1", "_stratum")
    both = one.join(side(cells, 2, "stratum", "value").withColumnRenamed("_stratum2", "_stratum"), ["sample2", "_stratum"])
    shared = both.groupBy("sample1", "sample2").agg(F.sum(F.least("_value1", "_value2")).alias("_shared"))
    known = pairs.join(side(totals, 1, "total"), "sample1").join(side(totals, 2, "total"), "sample2")
    distance = 1 - 2 * F.coalesce("_shared", F.lit(0.0)) / (F.col("_total1") + F.col("_total2"))
    return known.join(shared, ["sample1", "sample2"], "left").select("sample1", "sample2", distance.alias("distance"))


#: Blocks that the samples are cut into if that leaves them large enough, and the most samples and cells of a block.
_NEAR_BLOCKS = 8
_NEAR_SAMPLES = 1 << 16
_NEAR_CELLS = 1 << 21
#: Samples that a sample is held against at once, and those of its block that its first bound comes from.
_NEAR_STRIP = 1 << 15
_NEAR_FIRST = 1 << 14
#: Pairs that are worked out again by joins.
_NEAR_JOINED = 1 << 16
#: Share of the sum a pair needs that the cells left out of its estimate may make up.
_NEAR_LEFT_OUT = 0.1
#: Pairs, and numbers of a table of samples and strata, that are worked out at once.
_NEAR_PAIRS = 1 << 13
_NEAR_TABLE = 1 << 20
#: Sums are held against limits with so much to spare for rounding.
_SPARE = 1 - 1e-9


def _positive_cells(table: DataFrame, relative: bool) -> DataFrame:
    cells = table.groupBy("stratum", "sample").agg(F.sum("value").alias("value")).where(F.col("value") > 0)
    return cut_lineage(contribution_scaling(cells, "totalsum") if relative else cells)


class _Block:
    """Samples with their totals, the distance up to which others count as near, and their cells by stratum."""

    lists = ("samples", "rank", "totals", "bound", "ends", "strata", "stratum", "value")

    def __init__(self, *lists: np.ndarray):
        for name, values in zip(self.lists, lists):
            setattr(self, name, values)
        self.finite = bool(np.isfinite(self.totals).all())
        # the cells of a sample, largest first
        self.owner = np.repeat(np.arange(len(self.samples)), np.diff(self.ends))
        self.largest = np.lexsort((-self.value, self.owner))

    @classmethod
    def of_samples(cls, rows: pa.Table, most: float) -> _Block:
        owner = np.repeat(np.arange(rows.num_rows), pc.list_value_length(rows["_cells"]).to_numpy())
        cells = pc.list_flatten(rows["_cells"]).combine_chunks()
        stratum, strata = pd.factorize(cells.field("stratum").to_pandas(), sort=True)
        value = cells.field("value").to_numpy(zero_copy_only=False)
        order = np.lexsort((stratum, owner))
        owner, stratum, value = owner[order], stratum[order], value[order]
        totals = np.bincount(owner, weights=value, minlength=rows.num_rows)
        known = stratum >= 0  # a cell without a stratum only counts for the total
        names = rows["sample"].to_pandas().to_numpy()
        _, rank = np.unique(names, return_inverse=True)
        ends = np.concatenate(([0], np.cumsum(np.bincount(owner[known], minlength=rows.num_rows))))
        bound = np.full(rows.num_rows, float(most))
        block = cls(names, rank, totals, bound, ends, np.asarray(strata), stratum[known], value[known])
        return block.ordered(np.argsort(totals, kind="stable"))

    @classmethod
    def of_row(cls, rows: pa.RecordBatch, side: str, at: int) -> _Block:
        lists = [rows.column(side + name)[at].values.to_numpy(zero_copy_only=False) for name in cls.lists]
        lists[3] = lists[3].copy()  # bounds become narrower
        return cls(*lists)

    def row(self, number: int, schema: pa.Schema) -> pa.RecordBatch:
        lists = [pa.array(getattr(self, name), schema.field(name).type.value_type) for name in self.lists]
        lists = [pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values) for values in lists]
        return pa.record_batch([pa.array([number], pa.int32()), *lists], schema=schema)

    def cells_of(self, samples: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the samples' cells, and which of the samples each belongs to."""
        counts = self.ends[samples + 1] - self.ends[samples]
        of = np.repeat(np.arange(len(samples)), counts)
        return np.arange(len(of)) + (self.ends[samples] - (np.cumsum(counts) - counts))[of], of

    def ordered(self, order: np.ndarray) -> _Block:
        """The same samples in another order."""
        cells, of = self.cells_of(order)
        ends = np.concatenate(([0], np.cumsum(np.bincount(of, minlength=len(order)))))
        parts = (self.samples, self.rank, self.totals, self.bound)
        return _Block(*[part[order] for part in parts], ends, self.strata, self.stratum[cells], self.value[cells])


class _Strip:
    """Some samples of a block, their values by stratum as small whole numbers of ``unit``, rounded up.

    Sums of minima of such numbers are too large by less than one unit per common stratum, and are worked out for
    all samples of the strip at once.  No sum with a sample of ``others`` exceeds the largest number of the type.
    """

    def __init__(self, block: _Block, start: int, stop: int, others: _Block):
        self.block, self.start, self.stop = block, start, stop
        width, cells = stop - start, slice(block.ends[start], block.ends[stop])
        totals = block.totals[start:stop]
        self.low, self.high = totals.min(), totals.max()
        self.loose = not (np.isfinite(self.high) and others.finite)
        if self.loose:
            return
        longest = int(min(np.diff(block.ends[start:stop + 1]).max(), np.diff(others.ends).max()))
        self.kind = next(kind for kind in (np.uint8, np.uint16, np.uint32) if longest <= np.iinfo(kind).max // 2)
        self.top = int(np.iinfo(self.kind).max)
        self.unit = min(self.high, others.totals.max()) / (self.top - 1 - longest)
        stratum, column = block.stratum[cells], block.owner[cells] - start
        level = np.clip(np.ceil(block.value[cells] / self.unit), 1, self.top).astype(self.kind)
        self.most = int(level.max(initial=1))
        counts = np.bincount(stratum, minlength=len(block.strata))
        self.rows: list = [None] * len(counts)
        self.held = counts > 0
        # strata of many samples are whole rows, at most 64 numbers per cell; others are lists
        dense = counts * 64 >= width
        self.whole = np.zeros(len(counts), bool) | (dense & self.held)
        place = np.cumsum(self.whole) - 1
        wide = -(-width // 8) * 8  # so that sums can be looked through eight at a time
        matrix = np.zeros((int(self.whole.sum()), wide), self.kind)
        inside = self.whole[stratum]
        matrix[place[stratum[inside]], column[inside]] = level[inside]
        for s in np.flatnonzero(self.whole):
            self.rows[s] = matrix[place[s]]
        rest = np.flatnonzero(~inside)
        rest = rest[np.argsort(stratum[rest], kind="stable")]
        few, begin = np.unique(stratum[rest], return_index=True)
        for s, part in zip(few, np.split(rest, begin[1:])):
            self.rows[s] = (column[part], level[part])
        self.levels = None
        if self.kind is np.uint8:
            # whole rows of one number: minima of two rows are much faster than those of a row and a number
            self.levels = list(np.repeat(np.arange(self.most + 1, dtype=self.kind)[:, None], wide, axis=1))
        self.sums, self.minima, self.enough = np.empty(wide, self.kind), np.empty(wide, self.kind), np.empty(wide, bool)

    def estimate(self, strata: list[int], levels: list[int]) -> np.ndarray:
        """Sums of the minima with every sample of the strip, in units and not too small."""
        sums, minima, rows, constant = self.sums, self.minima, self.rows, self.levels
        sums.fill(0)
        for s, v in zip(strata, levels):
            row = rows[s]
            if type(row) is tuple:
                sums[row[0]] += np.minimum(row[1], self.kind(v))
            else:
                np.minimum(row, constant[v] if constant is not None else self.kind(v), minima)
                np.add(sums, minima, sums)
        return sums

    def at_least(self, least: int) -> np.ndarray:
        """Samples whose last estimate is not below a number above 0, which are few."""
        np.greater_equal(self.sums, least, self.enough)
        near = np.flatnonzero(self.enough.view(np.uint64))[:, None] * 8 + np.arange(8)
        return near[self.enough[near]]


class _Held:
    """The samples of one block held against those of another."""

    def __init__(self, left: _Block, right: _Block):
        self.left, self.right = left, right
        to = pd.Index(right.strata).get_indexer(left.strata)
        self.to = to[left.stratum]
        kept = left.largest[self.to[left.largest] >= 0]
        self.owner, self.stratum, self.value = left.owner[kept], self.to[kept], left.value[kept]

    def distances(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Of samples on the left to samples on the right, in order of the left; infinite for pairs that share nothing."""
        left, right, width = self.left, self.right, len(self.right.strata)
        samples, place = np.unique(one, return_inverse=True)
        sums, step = np.zeros(len(one)), max(1, _NEAR_TABLE // max(1, width))
        for start in range(0, len(samples), step):
            table = np.zeros((min(step, len(samples) - start), width))
            cells, of = left.cells_of(samples[start:start + step])
            held = self.to[cells] >= 0
            table[of[held], self.to[cells[held]]] = left.value[cells[held]]
            low, high = np.searchsorted(place, (start, start + step))
            cells, of = right.cells_of(two[low:high])
            shared = np.minimum(table[place[low:high][of] - start, right.stratum[cells]], right.value[cells])
            sums[low:high] = np.bincount(of, shared, high - low)
        with np.errstate(invalid="ignore"):
            return np.where(sums > 0, 1 - 2 * sums / (left.totals[one] + right.totals[two]), np.inf)

    def rows(self, strip: _Strip, first: int, last: int, need: np.ndarray):
        """Estimates for samples on the left that need the sum ``need`` with a sample of the strip.

        Yields the sample, the least estimate in units that is enough for it, and the weight of its smallest cells, which
        the estimate leaves out.
        """
        low, high = np.searchsorted(self.owner, (first, last))
        owner, stratum, value = self.owner[low:high] - first, self.stratum[low:high], self.value[low:high]
        held = strip.held[stratum]
        owner, stratum, value = owner[held], stratum[held], value[held]
        ends = np.searchsorted(owner, np.arange(last - first + 1))
        so_far = np.concatenate(([0.0], np.cumsum(value)))
        left_out = so_far[ends[owner + 1]] - so_far[:-1] <= _NEAR_LEFT_OUT * need[owner]
        weight = np.bincount(owner[left_out], value[left_out], minlength=last - first)
        stop = ends[1:] - np.bincount(owner[left_out], minlength=last - first)
        least = np.maximum(np.ceil((need - weight) / strip.unit), 1)
        found = (stop > ends[:-1]) & (need <= self.left.totals[first:last]) & (need <= strip.high) & (least <= strip.top)
        level = np.clip(np.ceil(value / strip.unit), 1, strip.most).astype(int).tolist()
        stratum, start, stop = stratum.tolist(), ends.tolist(), stop.tolist()
        for i in np.flatnonzero(found).tolist():
            strip.estimate(stratum[start[i]:stop[i]], level[start[i]:stop[i]])
            yield first + i, int(least[i]), weight[i]

    def likely(self, strip: _Strip):
        """Samples on the left, each with samples of the strip whose estimate is enough for one of the two."""
        left, right, span = self.left, self.right, slice(strip.start, strip.stop)
        if strip.loose:
            yield from ((i, np.arange(strip.stop - strip.start)) for i in range(len(left.samples)))
            return
        mine, theirs = ((1 - bound) / 2 * _SPARE for bound in (left.bound, right.bound[span]))
        totals = right.totals[span]
        need = np.minimum(mine, theirs.min()) * (left.totals + strip.low)
        for i, least, weight in self.rows(strip, 0, len(left.samples), need):
            at = strip.at_least(least)
            if len(at):
                share = np.minimum(mine[i], theirs[at]) * (left.totals[i] + totals[at])
                yield i, at[strip.sums[at] * strip.unit + weight >= share]

    def pairs(self, strip: _Strip) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Samples on the left, samples of the strip that are near for one of the two, and distances.

        A pair is near if the sum of minima reaches a share of its totals.  Only pairs whose estimate does are worked out.
        """
        left, right, found, waiting = self.left, self.right, [], []

        def work_out():
            one = np.repeat([i for i, _ in waiting], [len(at) for _, at in waiting])
            two = np.concatenate([at for _, at in waiting])
            distance = self.distances(one, two)
            near = distance <= np.maximum(left.bound[one], right.bound[two])
            found.append((one[near], two[near], distance[near]))
            waiting.clear()

        count = 0
        for i, at in self.likely(strip):
            at = at + strip.start
            waiting.append((i, at[at > i] if left is right else at))
            count += len(waiting[-1][1])
            if count >= _NEAR_PAIRS:
                work_out()
                count = 0
        if count:
            work_out()
        if not found:
            return np.empty(0, int), np.empty(0, int), np.empty(0)
        return tuple(np.concatenate(column) for column in zip(*found))


def _first(group: np.ndarray, other: np.ndarray, distance: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` least distances of each group, of equals those that come first by ``other``."""
    order = np.lexsort((other, distance, group))
    group = group[order]
    return order[np.arange(len(group)) - np.searchsorted(group, group) < k]


def _narrow(block: _Block, sample: np.ndarray, distance: np.ndarray, k: int) -> None:
    """Samples that have found ``k`` others need none further off; pairs are in the order of :func:`_first`."""
    last = np.flatnonzero(np.arange(len(sample)) - np.searchsorted(sample, sample) == k - 1)
    block.bound[sample[last]] = np.minimum(block.bound[sample[last]], distance[last])


def _bounded(block: _Block, k: int, width: int) -> _Block:
    """Samples with a bound to their ``k`` nearest from the likeliest of some samples with like totals."""
    held = _Held(block, block)
    if block.finite:
        for start in range(0, len(block.samples), width):
            stop = min(start + width, len(block.samples))
            strip = _Strip(block, start, stop, block)
            scale = 1 / block.totals[start:stop]
            one, two = [], []
            for i, _, _ in held.rows(strip, start, stop, np.zeros(stop - start)):
                share = strip.sums[:stop - start] / (block.totals[i] + block.totals[start:stop])
                share[i - start] = -1
                likely = np.argpartition(share, -2 * k)[-2 * k:] if len(share) > 2 * k else np.arange(len(share))
                two.append(likely[likely != i - start] + start)
                one.append(np.full(len(two[-1]), i))
            if one:
                one, two = np.concatenate(one), np.concatenate(two)
                distance = held.distances(one, two)
                kept = _first(one, two, distance, k)
                _narrow(block, one[kept], distance[kept], k)
    # samples with like bounds are next to each other
    return block.ordered(np.lexsort((block.totals, block.bound)))


def _near_rows(cells: DataFrame, most: float, k: int | None) -> DataFrame:
    """``(one, two, distance)``: each pair up to ``most`` once, or with ``k`` each sample's nearest of every block.

    All pairs of samples are compared, so the work grows with the square of the samples; what a task holds does
    not, and the rows of arrays that the blocks become are read anew for each pair of blocks, not shuffled.  A block
    holds samples with like totals.  In a task, a sample meets some thousands of others at once by sums of small whole
    numbers that are never too small, and only pairs that could be near by them are worked out from the cells.
    """
    cells = cells.where(F.col("sample").isNotNull()).select("stratum", "sample", F.col("value").cast("double").alias("value"))
    cell = F.struct("stratum", "value")
    samples = cut_lineage(cells.groupBy("sample").agg(F.sum("value").alias("_total"), F.collect_list(cell).alias("_cells")))
    seen = samples.agg(F.count(F.lit(1)).alias("samples"), F.sum(F.size("_cells")).alias("cells")).first()
    size = min(_NEAR_SAMPLES, max(1, -(-seen["samples"] // _NEAR_BLOCKS)))
    blocks = max(1, -(-seen["samples"] // size), -(-(seen["cells"] or 0) // _NEAR_CELLS))
    strip, first = _NEAR_STRIP, _NEAR_FIRST
    name, stratum = (cells.schema[c].dataType.simpleString() for c in ("sample", "stratum"))
    kinds = (name, "int", "double", "double", "int", stratum, "int", "double")
    arrays = ", ".join(f"{column} array<{kind}>" for column, kind in zip(_Block.lists, kinds))
    packing = f"_block int, {arrays}"
    arrow = to_arrow_type(cells.schema["sample"].dataType)
    schema = pa.schema([("one", arrow), ("two", arrow), ("distance", pa.float64())])
    inner = (arrow, pa.int32(), pa.float64(), pa.float64(), pa.int32(), to_arrow_type(cells.schema["stratum"].dataType), pa.int32(), pa.float64())
    packed_schema = pa.schema([("_block", pa.int32()), *[(n, pa.list_(t)) for n, t in zip(_Block.lists, inner)]])

    def pack(batches):
        rows = list(batches)
        rows = pa.Table.from_batches(rows) if rows else None
        if rows is not None and rows.num_rows:
            block = _Block.of_samples(rows, most)
            if k is not None:
                block = _bounded(block, k, first)
            yield block.row(rows["_block"][0].as_py(), packed_schema)

    def found(left: _Block, right: _Block):
        held, sides, count = _Held(left, right), ([], []), len(right.samples)
        width = -(-count // -(-count // strip))
        for start in range(0, count, width):
            one, two, distance = held.pairs(_Strip(right, start, min(start + width, count), left))
            if k is None:
                yield left.samples[one], right.samples[two], distance
                continue
            for side, (mine, i, other, j) in enumerate(((left, one, right, two), (right, two, left, one))):
                near = distance <= mine.bound[i]
                sides[side].append((i[near], j[near], distance[near]))
                i, j, near = (np.concatenate(column) for column in zip(*sides[side]))
                kept = _first(i, other.rank[j], near, k)
                sides[side][:] = [(i[kept], j[kept], near[kept])]
                _narrow(mine, i[kept], near[kept], k)
        for side, mine, other in zip(sides, (left, right), (right, left)):
            for i, j, near in side:
                yield mine.samples[i], other.samples[j], near

    def compare(batches):
        left = number = None
        for rows in batches:
            for at in range(rows.num_rows):
                low, high = (rows.column(f"{side}_block")[at].as_py() for side in "lr")
                if low != number:
                    left, number = _Block.of_row(rows, "l", at), low
                for columns in found(left, left if low == high else _Block.of_row(rows, "r", at)):
                    yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    dealt = samples.repartitionByRange(blocks, "_total", F.xxhash64("sample")).withColumn("_block", F.spark_partition_id())
    packed = cut_lineage(dealt.select("_block", "sample", "_cells").mapInArrow(pack, packing))
    left, right = (packed.select(*[F.col(c).alias(side + c) for c in packed.columns]) for side in "lr")
    # no condition but the order of the blocks: their rows are read where they are held against each other
    both = left.hint("shuffle_replicate_nl").join(right, F.col("l_block") <= F.col("r_block"))
    return both.mapInArrow(compare, f"one {name}, two {name}, distance double")


def similar_samples(table: DataFrame, most: float, relative: bool = True) -> DataFrame:
    """All pairs ``sample1 < sample2`` with a Bray-Curtis ``distance`` up to ``most`` (below 1)."""
    if not 0 <= most < 1:
        raise ValueError("most must be at least 0 and below 1")
    cells = _positive_cells(table, relative)
    near = _near_rows(cells, most, None)
    near = cut_lineage(near.select(F.least("one", "two").alias("sample1"), F.greatest("one", "two").alias("sample2"), "distance"))
    if near.count() > _NEAR_JOINED:
        # joined with their cells, many pairs would unfold to a row per stratum
        return near
    return braycurtis_pairs(cells, near, relative=False).where(F.col("distance") <= most)


def nearest_samples(table: DataFrame, k: int = 5, relative: bool = True, steps: Sequence[float] = (0.25, 0.5, 0.75, 1.0)) -> DataFrame:
    """The ``k`` nearest other samples of each sample, ties by name: ``sample, rank, neighbour, distance``.

    Neighbours are at most as far as the last of ``steps``.  Samples that share no stratum are not neighbours.
    """
    near = _near_rows(_positive_cells(table, relative), steps[-1], k)
    order = Window.partitionBy("sample").orderBy("distance", "neighbour")
    near = near.select(F.col("one").alias("sample"), F.col("two").alias("neighbour"), "distance")
    ranked = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("sample", "rank", "neighbour", "distance")


def braycurtis(table: DataFrame, relative: bool = True) -> DataFrame:
    """Bray-Curtis dissimilarity of all sample pairs that share a stratum, ``sample1 < sample2``.

    The result grows with the square of the samples; for many samples name the pairs and take
    ``braycurtis_pairs``.

    The distance is 1 - 2 * sum(min) / (total1 + total2).  The matrix is sparse: a pair
    that is not listed shares no stratum and has distance 1.  Samples are hashed to
    blocks of about 256; one task takes two blocks and a chunk of strata, builds two
    matrices of bounded size and adds up the minima.  So neither a stratum found in all
    samples nor a sample with many strata ends up in one task, and a cell is copied once
    per block, not once per partner.
    """
    cells = table.groupBy("stratum", "sample").agg(F.sum("value").alias("value")).where(F.col("value") > 0)
    if relative:
        cells = contribution_scaling(cells, "totalsum")
    # read for the sizes, the blocks and the totals
    cells = cut_lineage(cells)
    samples = cells.agg(F.count_distinct("sample")).scalar()
    strata = cells.agg(F.approx_count_distinct("stratum")).scalar()

    def parts(count: Column, size: int) -> Column:
        return F.greatest(F.lit(1), F.ceil(count / F.lit(float(size))).cast("int"))

    spread = (
        cells.withColumns({"_blocks": parts(samples, _BLOCK), "_chunks": parts(strata, _CHUNK)})
        .withColumns(
            {
                "_block": F.pmod(F.hash("sample"), F.col("_blocks")),
                "_chunk": F.pmod(F.xxhash64("stratum"), F.col("_chunks").cast("long")),
            }
        )
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
        .withColumns({"_low": F.least("_block", "_other"), "_high": F.greatest("_block", "_other")})
        .select(
            "_low",
            "_high",
            "_chunk",
            "stratum",
            "sample",
            "value",
            (F.col("_block") == F.col("_low")).alias("_left"),
            (F.col("_block") == F.col("_high")).alias("_right"),
        )
    )
    minima = spread.groupBy("_low", "_high", "_chunk").applyInPandas(
        _block_minima, "one string, two string, shared double"
    )
    shared = minima.groupBy(F.least("one", "two").alias("sample1"), F.greatest("one", "two").alias("sample2")).agg(
        F.sum("shared").alias("shared")
    )
    totals = cells.groupBy("sample").agg(F.sum("value").alias("_total"))
    one = totals.select(F.col("sample").alias("sample1"), F.col("_total").alias("_one"))
    two = totals.select(F.col("sample").alias("sample2"), F.col("_total").alias("_two"))
    return (
        shared.join(one, "sample1")
        .join(two, "sample2")
        .select(
            "sample1",
            "sample2",
            (1 - 2 * F.col("shared") / (F.col("_one") + F.col("_two"))).alias("distance"),
        )
    )
