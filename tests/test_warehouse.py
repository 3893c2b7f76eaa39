from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from ledgerlark.functions import expr as X
from ledgerlark.operators import quality as Q
from ledgerlark.operators import warehouse as L
from ledgerlark.plans import aggregates as G
from ledgerlark.plans import analytics as A
from ledgerlark.plans.calendar import build_dim_time
from ledgerlark.plans.nightly import CheckFailed, Watermarks, dated_load
from ledgerlark.session import materialise, scratch
from ledgerlark.sources.tables import PublishedTable

DIM = ("k int, id bigint, segment string, effective_date date, expiration_date date, is_current boolean, version int")
D = dt.date


def merge(spark, dim, updates, day):
    u = spark.createDataFrame(updates, "id bigint, segment string")
    return materialise(L.scd2_merge(dim, u, "id", "k", ["segment"], f"{day} 00:00:00"))


def test_scd2_worked_example(spark):
    dim = spark.createDataFrame([(1001, 123, "Regular", D(2024, 1, 1), None, True, 1)], DIM)
    got = rows(merge(spark, dim, [(123, "VIP")], "2025-10-16").select(
        "k", "id", "segment", "effective_date", "expiration_date", "is_current", "version"), "k")
    assert got == [(1001, 123, "Regular", D(2024, 1, 1), D(2025, 10, 16), False, 1),
                   (1002, 123, "VIP", D(2025, 10, 16), None, True, 2)]


def test_scd2_invariants(spark):
    dim = spark.createDataFrame([], DIM)
    steps = [("2024-01-01", [(1, "a"), (2, "a")]), ("2024-02-01", [(1, "b"), (3, "a")]), ("2024-03-01", [(1, "b"), (2, None)]),
             ("2024-04-01", [(1, "a"), (2, "a"), (3, "a")])]
    for day, updates in steps:
        dim = merge(spark, dim, updates, day)
    got = rows(dim.select("id", "version", "segment", "effective_date", "expiration_date", "is_current", "k"), "id", "version")
    assert len({r[6] for r in got}) == len(got)
    for i in (1, 2, 3):
        mine = [r for r in got if r[0] == i]
        assert [r[1] for r in mine] == list(range(1, len(mine) + 1))
        assert [r[5] for r in mine] == [False] * (len(mine) - 1) + [True]
        assert all(a[4] == b[3] for a, b in zip(mine, mine[1:])) and mine[-1][4] is None
    assert [r[2] for r in got if r[0] == 2] == ["a", None, "a"]
    again = merge(spark, dim, steps[-1][1], "2024-05-01")
    assert sorted(rows(again.select(dim.columns)), key=str) == sorted(rows(dim), key=str)


def test_version_at_boundaries(spark):
    dim = spark.createDataFrame([(1, 5, "old", D(2024, 1, 1), D(2024, 2, 1), False, 1), (2, 5, "new", D(2024, 2, 1), None, True, 2)], DIM)
    facts = spark.createDataFrame([(1, 5, D(2024, 1, 31)), (2, 5, D(2024, 2, 1)), (3, 5, D(2023, 1, 1))], "f int, id bigint, d date")
    found = L.version_at(facts, dim, "id", F.col("d"), ["segment", "k"], "k").select("f", "segment", "k")
    assert rows(found, "f")[2] == (3, None, -1) and [r[:2] for r in rows(found, "f")[:2]] == [(1, "old"), (2, "new")]


def test_open_rates(spark):
    rates = spark.createDataFrame([("EUR", D(2024, 1, 1), D(2024, 1, 3), 2.0), ("EUR", D(2024, 1, 3), None, 3.0)],
                                  "currency string, valid_from date, valid_to date, rate double")
    paid = spark.createDataFrame([(1, "EUR", D(2024, 1, 2), 10.0), (2, "EUR", D(2024, 5, 1), 10.0), (3, "EUR", D(2023, 1, 1), 1.0)],
                                 "id int, currency string, d date, amount double").withColumn("amount", F.col("amount").cast("decimal(18,2)"))
    got = rows(L.convert_currency(paid, rates, F.col("d")).select("id", F.col("converted_amount").cast("double")), "id")
    assert got == [(1, 20.0), (2, 30.0), (3, None)]


def test_changes_of_one_transaction(spark):
    log = spark.createDataFrame([(1, 5, 2, 2, "B"), (1, 5, 1, 2, "A"), (2, 5, 3, 2, "A"), (2, 5, 4, 1, "A")],
                                "payment_id bigint, lsn bigint, seqval bigint, op int, status string")
    assert [(r["payment_id"], r["status"]) for r in L.net_changes(log, "payment_id").collect()] == [(1, "B")]


LOG = "payment_id bigint, lsn bigint, op int, status string"


def test_net_changes(spark):
    log = spark.createDataFrame([
        (1, 1, 2, "PENDING"), (1, 2, 3, "PENDING"), (1, 3, 4, "SUCCEEDED"),  # insert, update
        (2, 4, 2, "PENDING"), (2, 5, 1, "PENDING"),  # gone again
        (3, 6, 3, "PENDING"), (3, 7, 4, "FAILED"),  # update only
        (4, 8, 1, "FAILED"),  # delete only
        (5, 9, 1, "OLD"), (5, 10, 2, "NEW"),  # deleted, then inserted again
    ], LOG)
    net = L.net_changes(log, "payment_id").select("payment_id", "status", "change_type")
    assert rows(net, "payment_id") == [(1, "SUCCEEDED", "INSERT"), (3, "FAILED", "UPDATE"), (4, "FAILED", "DELETE"), (5, "NEW", "UPDATE")]
    assert rows(L.net_changes(log, "payment_id", 2, 3).select("payment_id", "change_type")) == [(1, "UPDATE")]


def test_apply_is_idempotent(spark):
    target = spark.createDataFrame([(1, "A"), (2, "B"), (3, "C")], "payment_id bigint, status string")
    net = spark.createDataFrame([(1, "A2", "UPDATE"), (2, "B", "DELETE"), (9, "N", "INSERT")],
                                "payment_id bigint, status string, change_type string")
    once = L.apply_changes(target, net, "payment_id")
    assert rows(once, "payment_id") == [(1, "A2"), (3, "C"), (9, "N")] == rows(L.apply_changes(once, net, "payment_id"), "payment_id")


def test_failed_gate_keeps_table_and_watermark(spark):
    root = scratch(spark, "t")

    def gate(df):
        return Q.check_rules(df, "payments", {"status known": "status <> 'BAD'"})

    log = spark.createDataFrame([(1, 1, 2, "GOOD"), (2, 2, 2, "GOOD")], LOG)
    assert dated_load(log, root, "2024-01-01", "payments", "payment_id", gate)["extracted"] == 2
    worse = log.unionByName(spark.createDataFrame([(3, 3, 2, "BAD")], LOG))
    with pytest.raises(CheckFailed):
        dated_load(worse, root, "2024-01-02", "payments", "payment_id", gate)
    assert PublishedTable(spark, f"{root}/payments").read().count() == 2
    assert Watermarks(spark, f"{root}/watermarks").last("payments") == 2
    better = log.unionByName(spark.createDataFrame([(3, 3, 2, "GOOD")], LOG))
    done = dated_load(better, root, "2024-01-02", "payments", "payment_id", gate)
    assert (done["from_lsn"], done["to_lsn"], done["extracted"]) == (2, 3, 1)
    assert dated_load(better, root, "2024-01-03", "payments", "payment_id", gate)["extracted"] == 0
    full = dated_load(better, root, "2024-01-04", "payments", "payment_id", gate, force_full=True)
    assert full["extracted"] == 3 and PublishedTable(spark, f"{root}/payments").read().count() == 3


def test_calendar(spark):
    dim = build_dim_time(spark)
    assert dim.count() == 5844
    leap = dim.filter("time_key = 20240229").first()
    assert (leap["day_name"], leap["week_of_year"], leap["day_of_week"], leap["is_weekend"]) == ("Thursday", 9, 5, False)
    # 1 January is always in week one; the week changes on Sundays.
    assert dim.filter("time_key IN (20230101, 20240101, 20240106)").agg(F.max("week_of_year")).first()[0] == 1
    assert dim.filter("time_key = 20240107").first()["week_of_year"] == 2


FACT = ("time_key int, customer_key bigint, merchant_key bigint, amount decimal(18,2), net_amount decimal(18,2), "
        "processing_fee decimal(18,2), is_successful boolean, is_refunded boolean, is_disputed boolean, is_fraudulent boolean")


def fact(spark, *items):
    from decimal import Decimal

    return spark.createDataFrame(
        [(day, c, m, Decimal(a), Decimal(a), Decimal(0), good, False, False, False) for day, c, m, a, good in items], FACT)


def test_month_is_half_open_in_december(spark):
    f = fact(spark, (20231130, 1, 1, 5, True), (20231201, 1, 1, 10, True), (20231231, 2, 1, 20, True), (20240101, 3, 1, 40, True))
    got = G.monthly_metrics(f, 202312).first()
    assert (got["gross_revenue"], got["transaction_count"], got["new_customers"], got["returning_customers"]) == (30, 2, 1, 1)


def test_cohort_distance_crosses_the_year(spark):
    f = fact(spark, (20241215, 1, 1, 5, True), (20250110, 1, 1, 5, True), (20260301, 1, 1, 5, True))
    assert rows(A.cohort_retention(f).select("cohort_month", "months_since_cohort", "retention_rate")) == [
        (202412, 0, 100.0), (202412, 1, 100.0)]


def test_yoy_by_rows_and_by_calendar(spark):
    months = [(2023, m) for m in range(1, 13)] + [(2024, m) for m in range(2, 13)]
    f = fact(spark, *[(y * 10000 + m * 100 + 1, 1, 1, 100 + m, True) for y, m in months])
    dim = build_dim_time(spark, 2023, 2024)
    by_rows = A.monthly_revenue_yoy(f, dim, 2023).filter("year = 2024 AND month = 2").first()
    by_months = A.monthly_revenue_yoy(f, dim, 2023, calendar_months=True).filter("year = 2024 AND month = 2").first()
    assert by_rows["prev_year_revenue"] == 101 and by_months["prev_year_revenue"] == 102


def test_hour_boundaries_are_not_elapsed_hours(spark):
    df = spark.createDataFrame([("2024-01-01 10:59:59", "2024-01-01 11:00:01")], "a string, b string").select(
        F.col("a").cast("timestamp").alias("a"), F.col("b").cast("timestamp").alias("b"))
    assert df.select(X.hour_boundaries("a", "b")).first()[0] == 1


def test_currency_without_rate_is_null(spark):
    rates = spark.createDataFrame([("EUR", D(2024, 1, 1), D(2024, 1, 3), 1.1)], "currency string, valid_from date, valid_to date, rate double"
                                  ).withColumn("rate", F.col("rate").cast("decimal(9,4)"))
    paid = spark.createDataFrame([("EUR", D(2024, 1, 2)), ("EUR", D(2024, 1, 3)), ("USD", D(2024, 1, 9))], "currency string, d date"
                                 ).withColumn("amount", F.lit("10.05").cast("decimal(18,2)"))
    got = [str(r["converted_amount"]) for r in L.convert_currency(paid, rates, F.col("d")).orderBy("d").collect()]
    assert got == ["11.06", "None", "10.05"]


def test_unknown_keys(spark):
    dim = spark.createDataFrame([(10, 1, True), (11, 1, False)], "k bigint, id bigint, is_current boolean")
    got = L.lookup_key(spark.createDataFrame([(1,), (2,), (None,)], "id bigint"), dim, "id", "k")
    assert sorted(r["k"] for r in got.collect()) == [-1, -1, 10] and L.unresolved(got, "k").count() == 2


def test_reports_open_the_wanted_months_only(spark):
    path = scratch(spark, "fact")
    rows_ = [(y * 10000 + m * 100 + 1, y * 100 + m, 1, 10.0, True) for y in (2023, 2024) for m in (1, 2, 3)]
    fact = spark.createDataFrame(rows_, "time_key int, year_month int, merchant_key int, amount double, is_successful boolean")
    fact.write.partitionBy("year_month").parquet(path)
    from ledgerlark.plans.analytics import from_day

    plan = from_day(spark.read.parquet(path), 20240101, 20241231)._jdf.queryExecution().executedPlan().toString()
    assert "year_month" in plan.split("PartitionFilters:")[1].split("]")[0]
    assert from_day(spark.read.parquet(path), 20240201).count() == 2
