"""Look-back operators against brute force, with no, some and all keys sliced."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ledgerlark.operators import timeslice as S

START = dt.datetime(2024, 1, 1)
HOT = [None, 0, 20]


@pytest.fixture(scope="module")
def data():
    """One key holds most rows; several rows share an instant."""
    rng = random.Random(7)
    out = []
    for i in range(160):
        key = "busy" if rng.random() < 0.7 else rng.choice("abc")
        at = START + dt.timedelta(minutes=rng.choice([rng.randrange(0, 600), 60 * rng.randrange(0, 10)]))
        out.append((i, key, at, rng.randrange(1, 50), rng.choice("xyz")))
    return out


@pytest.fixture(scope="module")
def frame(spark, data):
    return spark.createDataFrame(data, "id bigint, key string, ts timestamp, v bigint, kind string")


def window(data, row, seconds):
    _, key, at, *_ = row
    return [r for r in data if r[1] == key and at - dt.timedelta(seconds=seconds) <= r[2] < at]


@pytest.mark.parametrize("hot", HOT)
def test_rolling_sums(frame, data, hot):
    got = {r["id"]: (r["n"], r["s"]) for r in S.rolling_sums(
        frame, ["key"], "ts", "id", {"n": ("1", 3600), "s": ("v", 7200)}, hot_rows=hot).collect()}
    assert got == {r[0]: (len(window(data, r, 3600)), sum(x[3] for x in window(data, r, 7200))) for r in data}


@pytest.mark.parametrize("hot", HOT)
def test_rolling_distinct(frame, data, hot):
    got = {r["id"]: r["k"] for r in S.rolling_distinct(frame, ["key"], "ts", "id", {"k": ("kind", 1800)}, hot_rows=hot).collect()}
    assert got == {r[0]: len({x[4] for x in window(data, r, 1800)}) for r in data}


@pytest.mark.parametrize("seconds,length", [(3600, 3600), (3600, 10800), (600, 7200)])
def test_rolling_max(frame, data, seconds, length):
    got = {r["id"]: r["m"] for r in S.rolling_max(frame, ["key"], "ts", "id", F.col("v"), length, "m", seconds=seconds).collect()}
    assert got == {r[0]: max((x[3] for x in window(data, r, length)), default=None) for r in data}


@pytest.mark.parametrize("hot", HOT)
@pytest.mark.parametrize("strict", [False, True])
def test_asof_join(spark, frame, data, hot, strict):
    right = [r for r in data if r[0] % 3 == 0]
    r = spark.createDataFrame(right, "rid bigint, key string, rts timestamp, rv bigint, rk string")
    got = {x["id"]: x["rid"] for x in S.asof_join(frame, r, ["key"], "ts", "rts", ["rid", "rv"], strict=strict, tiebreak="rid",
                                                 hot_rows=hot).collect()}

    def expected(row):
        seen = [x for x in right if x[1] == row[1] and (x[2] < row[2] or (not strict and x[2] == row[2]))]
        return max(seen, key=lambda x: (x[2], x[0]))[0] if seen else None

    assert got == {x[0]: expected(x) for x in data}


@pytest.mark.parametrize("hot", HOT)
def test_neighbours(frame, data, hot):
    n = S.neighbours(frame.withColumn("_us", S.micros("ts")), ["key"], "_us", hot_rows=hot)
    got = sorted((r["key"], r["_us"], r["_prev"] or 0, r["_next"] or 0) for r in n.collect())
    want = []
    for key in {r[1] for r in data}:
        times = sorted(int((r[2] - dt.datetime(1970, 1, 1)).total_seconds() * 1e6) for r in data if r[1] == key)
        want += [(key, t, times[i - 1] if i else 0, times[i + 1] if i + 1 < len(times) else 0) for i, t in enumerate(times)]
    assert got == sorted(want)


def test_previous_within_crosses_slices(spark):
    rows = [(1, "a", START + dt.timedelta(seconds=299)), (2, "a", START + dt.timedelta(seconds=301)),
            (3, "a", START + dt.timedelta(seconds=700)), (4, "b", START), (5, "b", START)]
    df = spark.createDataFrame(rows, "id bigint, key string, ts timestamp")
    got = {r["id"] for r in S.previous_within(df, ["key"], "ts", "id", 300).collect()}
    assert got == {2, 5}


def test_busy_key_is_cut_and_others_are_not(frame):
    cut, any_cut = S.with_slices(frame.withColumn("us", S.micros("ts")), ["key"], "us", 50, 3600)
    slices = {r["key"]: r["n"] for r in cut.groupBy("key").agg(F.countDistinct("_slice").alias("n")).collect()}
    assert any_cut and slices["busy"] > 5 and all(n == 1 for k, n in slices.items() if k != "busy")


@pytest.mark.parametrize("hot_rows", [None, 0])
def test_rolling_rank_counts_what_is_not_larger(spark, hot_rows):
    import datetime as dt
    import random

    random.seed(1)
    start = dt.datetime(2024, 1, 1)
    data = [(i, i % 2, start + dt.timedelta(hours=random.randrange(200)), random.choice([-5, 0, 3, 17, 255, 256, 9_000_000, 4_000_000])) for i in range(80)]
    df = spark.createDataFrame(data, "id bigint, k int, ts timestamp, v bigint")
    got = {r["id"]: r["n"] for r in S.rolling_rank(df, ["k"], "ts", "id", "v", 3 * 86400, "n", hot_rows=hot_rows).collect()}
    for i, k, ts, v in data:
        assert got[i] == sum(q == k and ts - dt.timedelta(days=3) <= t < ts and w <= v for _, q, t, w in data)
