"""Exact deduplication by deterministic block naming.

A text's UTF-8 bytes are cut into blocks of a fixed size.  The distinct blocks of the corpus are
sorted and numbered; a text is then a sequence of block names.  Adjacent names are paired, the
distinct pairs are sorted and numbered in turn, and so on until one name is left: two texts have
the same length in blocks and the same last name exactly when they are equal.

Text is shuffled once, to number the distinct blocks, and every task drops its own repeats before
that.  A document takes part in the naming with 64-bit keys of its blocks.  A key that belongs to
one distinct block of the corpus stands for that block, so no digest is trusted: blocks that share
a key are found by counting and are told apart by their bytes.

Defined cases: null text counts as empty; empty texts are equal to each other; rows with the same
id and text are separate members of their group, of which one is kept; a null id is the smallest;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from abundix.llm import listed
from abundix.session import cut_lineage

BLOCK_BYTES = 4096


def _blocks(text: Column, size: int) -> Column:
    data = text.cast("binary")
    last = F.greatest(F.ceil(F.octet_length(data) / size), F.lit(1)) - 1
    return F.transform(
        F.sequence(F.lit(0).cast("long"), last.cast("long")), lambda i: F.substring(data, (i * size + 1).cast("int"), F.lit(size))
    )


def _numbered(distinct: DataFrame, order: list[str]) -> DataFrame:
    """Name distinct rows: sorted where the shuffle has put them, and numbered in that order from 1."""
    return distinct.sortWithinPartitions(*order).withColumn("name", F.monotonically_increasing_id() + 1)


def _block_names(blocks: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """The name of each key that has one block, and (key, block, name) of the blocks that share a key, if any."""
    named = cut_lineage(_numbered(blocks.select("key", "block").distinct(), ["block"]).select("key", "name"))
    shared = named.groupBy("key").count().where("count > 1").select("key")
    if shared.isEmpty():
        return named, None
    shared = cut_lineage(shared)
    alone = cut_lineage(named.join(shared, "key", "left_anti"))
    again = blocks.select("key", "block").join(shared, "key", "left_semi").distinct()
    return alone, cut_lineage(_numbered(again, ["block"]).withColumn("name", -F.col("name")))


def identities(
    docs: DataFrame, text: str = "text", block_bytes: int = BLOCK_BYTES, block_key: Callable[[Column], Column] = F.xxhash64, **keep: Column
) -> DataFrame:
    """One row per row of ``docs``: a row number, the columns of ``keep``, and (``rounds``, ``name``), equal for equal texts."""
    value = F.coalesce(F.col(text), F.lit(""))
    cut = docs.select(value.alias("_text"), *[c.alias(k) for k, c in keep.items()]).withColumn("_blocks", _blocks(F.col("_text"), block_bytes))
    alone, shared = _block_names(cut.select(F.explode("_blocks").alias("block")).withColumn("key", block_key(F.col("block"))))

    # Blocks travel with their document only if some key of the corpus is shared.
    block = F.lit(None).cast("binary") if shared is None else None
    keys = F.transform("_blocks", lambda b: F.struct(block_key(b).alias("key"), (b if block is None else block).alias("block")))
    numbered = cut.withColumn("row", F.monotonically_increasing_id())
    rows = cut_lineage(numbered.select("row", *keep, keys.alias("_keys")))
    parts = rows.select("row", F.posexplode("_keys").alias("at", "_key")).select("row", "at", "_key.key", "_key.block")
    names = parts.join(alone, "key").select("row", F.col("at").cast("long").alias("at"), "name")
    if shared is not None:
        names = names.unionByName(parts.join(shared, ["key", "block"]).select("row", F.col("at").cast("long").alias("at"), "name"))

    width = rows.select("row", F.size("_keys").alias("width"))
    last, rounds = None, 0
    names = names.join(width, "row")
    while True:
        names = cut_lineage(names)
        whole = names.where("width = 1").select("row", F.lit(rounds).alias("rounds"), "name")
        last = whole if last is None else last.unionByName(whole)
        names = names.where("width > 1")
        if names.isEmpty():
            break
        rounds += 1
        pairs = cut_lineage(
            names.groupBy("row", F.expr("at div 2").alias("at")).agg(
                F.max(F.when(F.col("at") % 2 == 0, F.col("name"))).alias("left"),
                F.coalesce(F.max(F.when(F.col("at") % 2 == 1, F.col("name"))), F.lit(0)).alias("right"),
                F.expr("(max(width) + 1) div 2").cast("int").alias("width"),
            )
        )
        numbers = cut_lineage(_numbered(pairs.select("left", "right").distinct(), ["left", "right"]))
        names = pairs.join(numbers, ["left", "right"]).select("row", "at", "name", "width")
    return rows.select("row", *keep).join(last, "row")


def exact_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Per row: ``doc_id``, ``keep_id``, ``group_size``, ``kept`` and the text's ``text_sha256``.

    The row with the largest id stays; of rows that share it, the first by row number.
    """
    value = F.coalesce(F.col(text), F.lit(""))
    named = cut_lineage(identities(docs, text, doc_id=F.col(doc_id), text_sha256=F.sha2(value.cast("binary"), 256), **options))
    groups = named.groupBy("rounds", "name").agg(
        F.max(F.struct("doc_id", (-F.col("row")).alias("row"))).alias("_best"), F.count(F.lit(1)).alias("group_size")
    )
    # written, so that the join is a stage of its own and a group of many rows can be split
    groups = cut_lineage(
        groups.select("rounds", "name", F.col("_best.doc_id").alias("keep_id"), F.col("_best.row").alias("_row"), "group_size")
    )
    return named.join(groups, ["rounds", "name"]).select(
        "doc_id", "keep_id", "group_size", (F.col("row") == -F.col("_row")).alias("kept"), "text_sha256"
    )


def drop_exact_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``exact_groups`` keeps, with all their columns.

    Rows equal in id and text are one document here: one of them stays.  Rows without an id stay only
    when no equal text has one.
    """
    groups = cut_lineage(exact_groups(docs, doc_id, text))
    gone = groups.where("not kept").select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha"), F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("_again"))
    gone = cut_lineage(gone.distinct())
    value = F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256)
    out = docs
    # texts of rows that are certainly not listed are not shuffled
    others = gone.where("not _again").drop("_again")
    if not others.isEmpty():
        clear, maybe = listed.split(out, others.select("_id"), F.col(doc_id))
        out = clear.unionByName(maybe.join(others, F.col(doc_id).eqNullSafe(F.col("_id")) & (value == F.col("_sha")), "left_anti"))
    again = gone.where("_again").drop("_again")
    if not again.isEmpty():
        clear, maybe = listed.split(out, again.select("_id"), F.col(doc_id))
        marked = maybe.withColumn("_text_sha", value).join(again, F.col(doc_id).eqNullSafe(F.col("_id")) & (F.col("_text_sha") == F.col("_sha")), "left")
        single = marked.where("_sha is not null").dropDuplicates([doc_id, "_sha"])
        out = clear.unionByName(marked.where("_sha is null").unionByName(single).select(*docs.columns))
    return out
