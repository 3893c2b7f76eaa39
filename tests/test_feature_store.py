"""Documents by payment: upserts, point reads, reads since an instant."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ledgerlark import session
from ledgerlark.plans.feature_store import FeatureStore


def documents(spark, rows):
    return spark.createDataFrame(rows, "payment_id bigint, computed_at string, score double, features struct<a:int>").withColumn(
        "computed_at", F.col("computed_at").cast("timestamp"))


def current(df):
    return sorted((r["payment_id"], r["score"], r["features"]["a"]) for r in df.collect())


def test_latest_computation_wins(spark):
    store = FeatureStore(spark, session.scratch(spark, "store"), buckets=4)
    store.upsert(documents(spark, [(1, "2024-01-02 00:00:00", 0.1, (1,)), (1, "2024-01-01 00:00:00", 0.9, (2,)),
                                   (2, "2024-01-02 00:00:00", 0.2, (3,)), (3, "2024-01-05 00:00:00", 0.3, (4,))]), 1)
    assert current(store.read()) == [(1, 0.1, 1), (2, 0.2, 3), (3, 0.3, 4)]
    second = documents(spark, [(1, "2024-01-03 00:00:00", 0.5, (5,)), (2, "2024-01-02 00:00:00", 0.6, (6,)),
                               (3, "2024-01-04 00:00:00", 0.7, (7,)), (4, "2024-01-01 00:00:00", 0.8, (8,))])
    for _ in range(2):  # a repeated batch replaces itself
        store.upsert(second, 2)
        assert current(store.read()) == [(1, 0.5, 5), (2, 0.6, 6), (3, 0.3, 4), (4, 0.8, 8)]
    assert current(store.read(F.lit("2024-01-03 00:00:00").cast("timestamp"))) == [(1, 0.5, 5), (3, 0.3, 4)]
    assert current(store.get(3)) == [(3, 0.3, 4)] and current(store.get(9)) == []
    plan = store.get(1)._jdf.queryExecution().executedPlan().toString()
    assert "bucket#" in plan.split("PartitionFilters")[1].split("]")[0]


def test_a_document_needs_its_payment(spark):
    store = FeatureStore(spark, session.scratch(spark, "store"), buckets=2)
    with pytest.raises(Exception, match="without payment_id"):
        store.upsert(documents(spark, [(None, "2024-01-02 00:00:00", 0.1, (1,))]), 1)
