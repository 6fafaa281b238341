"""A stored cohort that grows by samples."""

import os
import random

import pytest
from pyspark.sql import functions as F

from abundix.plans import cohort as co

TABLE = "code string, name string, stratum string, sample string, value double"


def table(seed, samples):
    rng = random.Random(seed)
    rows = [(f"c{rng.randint(0, 8)}", rng.choice([None, "n"]), rng.choice([None, "g__A", "g__B"]), s, float(rng.randint(0, 9))) for s in samples for _ in range(12)]
    return rows


def summed(rows):
    out = {}
    for *key, value in rows:
        out[tuple(key)] = out.get(tuple(key), 0.0) + value
    return out


def stored(spark, path):
    rows = [tuple(r) for r in co.read_cohort(spark, path).select("code", "name", "stratum", "sample", "value").collect()]
    assert len(rows) == len({r[:-1] for r in rows})
    return {r[:-1]: r[-1] for r in rows}


def totals(cells):
    out = {}
    for (code, name, stratum, _), v in cells.items():
        s, n, low, high = out.get((code, name, stratum), (0.0, 0, v, v))
        out[code, name, stratum] = (s + v, n + 1, min(low, v), max(high, v))
    return out


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_a_growing_cohort_is_the_joined_table(spark, frame, tmp_path):
    path = str(tmp_path / "cohort")
    first, second = table(1, [f"s{i}" for i in range(20)]), table(2, ["s3", "late"])
    co.create_cohort(frame(first, TABLE), path, buckets=8)
    assert stored(spark, path) == summed(first) and co.buckets_of(spark, path) == 8

    before = files(path)
    co.add_samples(spark, path, frame(second, TABLE))
    want = {k: v for k, v in summed(first).items() if k[3] != "s3"} | summed(second)
    assert stored(spark, path) == want
    buckets = {r.b for r in frame([("s3",), ("late",)], "sample string").select(co._bucket("sample", 8).alias("b")).collect()}
    same = {f for f, t in files(path).items() if before.get(f) == t}
    assert {f for f in before if f not in same} == {f for f in before if any(f"bucket={b}/" in f for b in buckets)} and same

    got = {(r.code, r["name"], r.stratum): (r["sum"], r.cells, r.low, r.high) for r in co.cohort_totals(spark, path).collect()}
    assert got == totals(want)

    co.remove_samples(spark, path, frame([("s3",), ("unknown",)], "sample string"))
    want = {k: v for k, v in want.items() if k[3] != "s3"}
    assert stored(spark, path) == want
    got = {(r.code, r["name"], r.stratum): (r["sum"], r.cells, r.low, r.high) for r in co.cohort_totals(spark, path).collect()}
    assert got == totals(want)


def test_buckets_can_become_empty(spark, frame, tmp_path):
    path = str(tmp_path / "cohort")
    rows = table(3, ["only", "other"])
    co.create_cohort(frame(rows, TABLE), path, buckets=64)
    co.remove_samples(spark, path, frame([("only",)], "sample string"))
    assert stored(spark, path) == {k: v for k, v in summed(rows).items() if k[3] == "other"}
    co.remove_samples(spark, path, frame([("other",)], "sample string"))
    assert stored(spark, path) == {} and co.cohort_totals(spark, path).count() == 0
    co.add_samples(spark, path, frame(rows, TABLE))
    assert stored(spark, path) == summed(rows)
    co.add_samples(spark, path, frame(rows, TABLE).where("false"))
    assert stored(spark, path) == summed(rows)


def test_only_touched_buckets_are_read(spark, frame, tmp_path):
    path = str(tmp_path / "cohort")
    co.create_cohort(frame(table(4, [f"s{i}" for i in range(30)]), TABLE), path, buckets=8)
    before = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    plan = co._stored(spark, path, "cells", co._CELLS).where(F.col("bucket").isin([3]))._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.maxMetadataStringLength", before)
    assert "PartitionFilters: [isnotnull(bucket" in plan or "PartitionFilters: [(bucket" in plan or "PartitionFilters: [bucket" in plan
    with pytest.raises(Exception):
        co.create_cohort(frame(table(4, ["s1"]), TABLE), path)
