import hashlib
from collections import Counter

from pyspark.sql import functions as F

from abundix.llm import exact_dedup as e


def expected(rows):
    groups = {}
    for i, t, *_ in rows:
        groups.setdefault(t or "", []).append(i)
    out = Counter()
    for i, t, *_ in rows:
        ids = groups[t or ""]
        keep = max((x for x in ids if x is not None), default=None)
        out[i, keep, len(ids), hashlib.sha256((t or "").encode()).hexdigest()] += 1
    return out, len(groups)


def check(df, rows, **options):
    got = e.exact_groups(df, **options).collect()
    want, groups = expected(rows)
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    kept = [r for r in got if r.kept]
    assert len(kept) == groups and all(r.doc_id == r.keep_id for r in kept)


def test_odd_rows(documents, odd_rows):
    check(documents(odd_rows), odd_rows)


def test_small_blocks_and_shared_keys(documents, odd_rows):
    rows = odd_rows + [(100 + i, "ab" * i + "c" * (i % 3), None, None) for i in range(40)] * 2
    check(documents(rows), rows, block_bytes=64)
    check(documents(rows), rows, block_bytes=64, block_key=lambda b: F.octet_length(b).cast("long") % 5)


def test_block_ends(documents):
    rows = [(i, t, None, None) for i, t in enumerate(["x" * 64, "x" * 65, "x" * 63, "x" * 128, "x" * 128, "x" * 64 + "y" * 64, "y" * 64 + "x" * 64])]
    check(documents(rows), rows, block_bytes=64)


def test_empty_table(documents):
    df = documents([(1, "a", None, None)]).where("doc_id < 0")
    assert e.exact_groups(df).collect() == []
    assert e.drop_exact_copies(df).columns == df.columns and e.drop_exact_copies(df).count() == 0


def test_drop_keeps_one_row_of_each_text(documents, odd_rows):
    df = documents(odd_rows)
    out = e.drop_exact_copies(df)
    assert out.columns == df.columns
    got = sorted((r.doc_id or -1, r.text or "") for r in out.collect())
    best = {}
    for i, t, *_ in odd_rows:
        best[t or ""] = max(best.get(t or "", -1), i or -1)
    assert got == sorted((i, t) for t, i in best.items())


def test_large_group(spark):
    df = spark.range(6000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "same").otherwise(F.col("id").cast("string")).alias("text"))
    got = e.exact_groups(df).groupBy("group_size").count().collect()
    assert {(r.group_size, r["count"]) for r in got} == {(2000, 2000), (1, 4000)}
