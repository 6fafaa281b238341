import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from abundix.llm import licenses, sharding, urlfilter

RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))


def judged(url, listed):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [(h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    rule, verdict = max(fits, key=lambda x: len(x[0]), default=(None, None))
    return host, path, rule, verdict or ("block" if host + path in listed else "allow")


URLS = [
    None, "", "no scheme", "http://", "http://Example.ORG/es/1", "http://a.example.org/en/12?x=1", "http://badexample.org/es/",
    "https://org", "https://x.com/fr/1#a", "https://x.com/de/", "x://y://z/w", "http://h.net?utm_source=a", "http://h.net/p#://q",
    "http://É.com/de/ü", "http://user@h.net:80/p?utm_source=b", "a\nb://new.net/line",
]


def test_judged_like_brute_force(spark):
    urls = URLS + [f"http://s{i % 50}.net/{i % 700}{'?utm_source=f' if i % 7 == 0 else ''}" for i in range(3000)]
    df = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)] + [(0, None, "x", "y")], "page_id long, url string, host string, key string")
    listed = {"".join(judged(u, ())[:2]) for u in urls if u and "utm_source=" in u}
    for limit in (urlfilter.MAX_WORDS, 1):
        out = urlfilter.judge_urls(df, RULES, F.col("url").contains("utm_source="), max_words=limit).collect()
        assert len(out) == len(urls) + 1
        for r in out:
            assert (r.host, r.path, r.rule, r.verdict) == judged(urls[r.page_id], listed)


def test_cascade_is_exact_however_full(spark, monkeypatch):
    monkeypatch.setattr(urlfilter, "BITS_PER_KEY", 3)
    universe = spark.range(4000).select(F.concat(F.lit("k"), "id").alias("key")).cache()
    listed = universe.where("crc32(key) % 5 = 0").unionByName(spark.createDataFrame([("elsewhere",), (None,)], "key string"))
    cascade = urlfilter.build_cascade(universe, listed)
    assert len(cascade.levels) > 2
    got = cascade.with_membership(universe, F.col("key")).where("listed <> (crc32(key) % 5 = 0)").count()
    assert got == 0
    plan = cascade.with_membership(universe, F.col("key"))._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan


def test_cascade_of_nothing(spark):
    universe = spark.createDataFrame([("a",), ("",)], "key string")
    none = universe.where("key = 'q'")
    assert [r.listed for r in urlfilter.build_cascade(universe, none).with_membership(universe, F.col("key")).collect()] == [False, False]
    assert [r.listed for r in urlfilter.build_cascade(universe, universe).with_membership(universe, F.col("key")).collect()] == [True, True]
    pages = spark.createDataFrame([], "page_id long, url string")
    assert urlfilter.judge_urls(pages, RULES, F.lit(True)).collect() == []
    assert urlfilter.judge_urls(spark.createDataFrame([(1, "a://b")], "page_id long, url string"), (), F.lit(None).cast("boolean")).collect()[0].verdict == "allow"


def test_slot_table():
    table = sharding.slot_table(sharding.SHARDS)
    counts = Counter(table)
    assert set(counts) == set(range(len(sharding.SHARDS))) and max(counts.values()) - min(counts.values()) <= 1
    fewer = sharding.slot_table(sharding.SHARDS[:-1])
    moved = sum(a != b for a, b in zip(table, fewer) if a != len(sharding.SHARDS) - 1)
    assert moved < 0.1 * len(table)
    assert set(sharding.slot_table(["only"], 7)) == {0}
    for shards, slots in (([], 7), (["a"], 8), (["a", "b", "c"], 2)):
        with pytest.raises(ValueError):
            sharding.slot_table(shards, slots)


def test_placement(documents, odd_rows, tmp_path):
    df = documents(odd_rows + [(100 + i, "t", None, None) for i in range(2000)])
    out = sharding.place(df, slot="_s", shard="shard")
    rows = out.collect()
    table = sharding.slot_table(sharding.SHARDS)
    assert len(rows) == len(odd_rows) + 2000
    for r in rows:
        slot = sharding._hash("" if r.doc_id is None else str(r.doc_id)) % sharding.SLOTS
        assert (r._s, r.shard) == (slot, table[slot])
    assert sharding.place(df.where("size > 5")).count() == 0
    sharding.write_shards(df, str(tmp_path / "shards"))
    back = df.sparkSession.read.parquet(str(tmp_path / "shards"))
    assert back.count() == len(rows) and sorted(back.columns) == sorted([*df.columns, "shard"])


def test_licenses(documents, odd_rows):
    mit = licenses.KNOWN["MIT"][-1]
    rows = [
        (100, "Copyright (c) 2020 Someone\n\n" + mit.upper().replace(" ", "\n  "), None, None),
        (101, "text before " + mit, None, None),
        (102, "Hello.\nreleased under the MIT   licence\nLicensed under CC BY-NC 4.0.\nReleased under the MIT License.", None, None),
        (103, "This is licensed under the Apache License, Version 2.0, or not.", None, None),
        (104, "licensed under the apache licence version 2 0", None, None),
    ]
    got = {r.doc_id: r for r in licenses.scan_licenses(documents(odd_rows + rows)).collect()}
    assert (got[100].license, got[101].license) == ("MIT", None)
    assert got[102].statements == "CC-BY-NC-4.0,MIT" and got[103].statements == "" and got[104].license == "Apache-2.0"
    assert licenses.scan_licenses(documents(odd_rows)).count() == len(odd_rows)
    assert licenses.scan_licenses(documents(odd_rows).where("size > 5")).count() == 0
    own = {"own": ("Keep this text",)}
    assert licenses.scan_licenses(documents([(1, "a\nkeep THIS text!", None, None)]), known=own).collect()[0].statements == "own"
