from __future__ import annotations

import random

import math
import random

import pytest
from pyspark.sql import functions as F

from ledgerlark.operators import ranking as R


@pytest.mark.parametrize("buckets", [2, 7, 64])
def test_ranked_with_ties(spark, buckets):
    rng = random.Random(1)
    values = [rng.choice([5, 5, 5, rng.randrange(100)]) for _ in range(300)]  # a third and more are equal
    df = spark.createDataFrame(list(enumerate(values)), "id bigint, v bigint")
    for r in R.ranked(df, "v", buckets).collect():
        below = sum(x < r["v"] for x in values)
        assert r["rank"] == below + 1
        assert r["percent_rank"] == pytest.approx(below / (len(values) - 1))


def test_ranked_single_row(spark):
    assert R.ranked(spark.createDataFrame([(1,)], "v bigint"), "v").first()["percent_rank"] == 0.0


@pytest.mark.parametrize("ranges", [1, 3, 8, None])
@pytest.mark.parametrize("ids", [[7, 2, 900, 12, 5, 13], [hash((i, 7)) for i in range(50)]])
def test_dense_keys(spark, ranges, ids):
    df = spark.createDataFrame([(i,) for i in ids], "id bigint")
    got = {r["id"]: r["k"] for r in R.dense_keys(df, "id", "k", 100, ranges=ranges).collect()}
    assert got == {i: 101 + n for n, i in enumerate(sorted(ids))}


def test_dense_keys_compare_no_row_with_a_list(spark):
    df = spark.range(2000).select(F.xxhash64("id").alias("id"))
    keyed = R.dense_keys(df, "id", "k", ranges=7)
    plan = keyed._jdf.queryExecution().toString()
    assert "filter(array" not in plan.lower() and keyed.select("k").distinct().count() == 2000
    parts = R.in_ranges(df, "id", ranges=7).groupBy("_part").count().collect()
    assert len(parts) == 7 and max(r["count"] for r in parts) < 2000 / 3


def percentile(values, p):
    values, at = sorted(values), p * (len(values) - 1)
    low, high = values[math.floor(at)], values[math.ceil(at)]
    return low + (at - math.floor(at)) * (high - low)


POINTS = {"least": 0.0, "p50": 0.5, "p99": 0.99, "most": 1.0}


@pytest.mark.parametrize("margin", [0.01, -0.2])
def test_exact_percentiles(spark, monkeypatch, margin):
    """Also where the bounds miss the value; with a key of most rows, ties, one value, nulls and a null key."""
    monkeypatch.setattr(R, "MARGIN", margin)
    rnd = random.Random(1)
    groups = {"hot": [rnd.randrange(10**9) for _ in range(20_000)], "ties": [5] * 300 + [7] * 4, "one": [3], None: [1, 2], "none": []}
    rows = [(k, v) for k, vs in groups.items() for v in [*vs, None]]
    got = R.exact_percentiles(spark.createDataFrame(rows, "k string, v bigint").repartition(4), ["k"], "v", POINTS)
    for r in got.collect():
        vs = groups[r.k]
        assert r.n == len(vs)
        assert [r[p] for p in POINTS] == ([pytest.approx(percentile(vs, p)) for p in POINTS.values()] if vs else [None] * 4), r.k
    assert got.count() == len(groups)


def test_exact_percentiles_are_sparks_to_the_last_bit(spark):
    rows = spark.createDataFrame([(s // 300, s * 7919 % 1009) for s in range(0, 1500, 3)], "k bigint, v bigint")
    got = {r.k: r.p99 for r in R.exact_percentiles(rows, ["k"], "v", {"p99": 0.99}).collect()}
    assert got == {r.k: r.p99 for r in rows.groupBy("k").agg(F.percentile("v", F.lit(0.99)).alias("p99")).collect()}


def test_pages_cover_everything_once(spark):
    df = spark.createDataFrame([(i,) for i in (9, 4, 7, 1, 3)], "id bigint")
    last, seen = None, []
    while page := [r["id"] for r in R.page_after(df, "id", last, 2).collect()]:
        seen += page
        last = page[-1]
    assert seen == [1, 3, 4, 7, 9]


def test_distinct_estimates_make_one_sketch_per_group(spark):
    """Sketches are made of groups that were brought together, not of pairs (of a group and a value)."""
    from ledgerlark.registry import primitives
    from ledgerlark.sources.driver_tables import PaymentTables
    from conftest import DATA

    rows = spark.createDataFrame([("a", i % 700, i) for i in range(3000)] + [(None, 1, 1), (None, None, 2), ("b", None, None)],
                                 "k string, x int, y int").repartition(5)
    got = R.distinct_estimates(rows, ["k"], {"nx": "x", "ny": "y"})
    want = rows.groupBy("k").agg(F.approx_count_distinct("x", 0.01).alias("nx"), F.approx_count_distinct("y", 0.01).alias("ny"))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    plan = primitives.approx_distinct(PaymentTables(spark, DATA))._jdf.queryExecution().executedPlan().toString()
    sketching = [line for line in plan.splitlines() if "approx_count_distinct" in line and "keys=[" in line]
    assert sketching and not any("customer_id" in line.split("keys=[")[1].split("]")[0] for line in sketching)
    assert "REBALANCE_PARTITIONS_BY_COL" in plan
