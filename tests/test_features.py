from __future__ import annotations

import datetime as dt
import ipaddress
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from ledgerlark.operators import addresses as A
from ledgerlark.operators import features as M
from ledgerlark.registry.features import RULES


@pytest.fixture(scope="module")
def plain(tables):
    return M.feature_vector(tables.payments(), tables.disputes(), tables.customers(), tables.merchants(), RULES)


def test_sliced_customers_give_the_same_vector(tables, plain):
    sliced = M.feature_vector(tables.payments(), tables.disputes(), tables.customers(), tables.merchants(), RULES, hot_rows=0)
    columns = ["payment_id", *[F.round(F.col(f).cast("double"), 6).alias(f) for f in M.FEATURES]]
    assert plain.select(columns).exceptAll(sliced.select(columns)).isEmpty()
    assert sliced.count() == tables.payments().count()


def test_some_busy_merchants(tables):
    a = M.merchant_features(tables.payments(), tables.disputes(), tables.merchants())
    b = M.merchant_features(tables.payments(), tables.disputes(), tables.merchants(), hot_rows=250)
    assert a.exceptAll(b).isEmpty()


def test_vector_has_the_model_order_and_no_nulls(plain):
    assert [c for c in plain.columns if c in M.FEATURES] == list(M.FEATURES) and len(M.FEATURES) == 45
    nulls = plain.agg(*[F.count_if(F.col(f).isNull()).alias(f) for f in M.FEATURES]).first()
    assert set(nulls) == {0}


def payments(spark, *items):
    base = {"customer_id": 1, "merchant_id": 1, "payment_method": "a", "amount_minor": 1000, "status": "SUCCEEDED",
            "ip_country": "FR", "card_country": "FR", "billing_country": "FR", "device_fingerprint": "d",
            "email": "x@gmail.com", "user_agent": "Chrome/120.0", "shipping_address": None, "billing_address": None}
    schema = ("payment_id bigint, ts timestamp, customer_id bigint, merchant_id bigint, payment_method string, amount_minor bigint, "
              "status string, ip_country string, card_country string, billing_country string, device_fingerprint string, "
              "email string, user_agent string, shipping_address string, billing_address string")
    names = [c.split()[0] for c in schema.split(", ")]
    data = [{**base, "payment_id": i, **item} for i, item in enumerate(items, 1)]
    return spark.createDataFrame([tuple(d[n] for n in names) for d in data], schema)


def at(*args):
    return dt.datetime(2024, 1, *args)


def test_history_excludes_the_payment_and_its_instant(spark, tables):
    p = payments(spark, {"ts": at(1, 10), "amount_minor": 100}, {"ts": at(1, 10), "amount_minor": 300},
                 {"ts": at(1, 11), "status": "FAILED"}, {"ts": at(1, 12, 0, 1), "amount_minor": 1_000_001, "ip_country": "US"})
    none = spark.createDataFrame([], "payment_id bigint, opened_at timestamp")
    v = {r["payment_id"]: r for r in M.feature_vector(p, none, tables.customers(), tables.merchants(), M.Rules(
        places={"FR": (46.0, 2.0), "US": (38.0, -97.0)})).collect()}
    assert (v[1]["transaction_count_1h"], v[1]["days_since_last_transaction"], v[1]["first_transaction_customer"]) == (0, 9999, 1)
    assert (v[1]["amount_percentile"], v[1]["avg_amount_7d"], v[1]["amount_ratio_to_avg"]) == (0.5, 1.0, 1.0)
    assert (v[2]["transaction_count_1h"], v[3]["transaction_count_1h"]) == (0, 2)  # the window's start belongs to it
    assert v[4]["transaction_count_1h"] == 0 and v[4]["transaction_count_24h"] == 3  # one second past the hour
    assert v[4]["avg_amount_7d"] == 2.0 and v[4]["stddev_amount_7d"] == pytest.approx(2**0.5)
    assert (v[4]["country_change_24h"], v[4]["high_value_flag"], v[4]["round_amount"], v[1]["round_amount"]) == (1, 1, 0, 1)
    assert v[4]["distance_km"] == pytest.approx(7550, rel=0.05) and v[4]["velocity_km_per_hour"] > 500
    assert v[4]["customer_success_rate"] == pytest.approx(2 / 3) and v[4]["shipping_address_mismatch"] == 0


def test_disputes_count_from_the_day_they_open(spark, tables):
    p = payments(spark, {"ts": at(1)}, {"ts": at(2)}, {"ts": at(4)}, {"ts": dt.datetime(2024, 2, 5)})
    d = spark.createDataFrame([(1, at(3))], "payment_id bigint, opened_at timestamp")
    v = rows(M.feature_vector(p, d, tables.customers(), tables.merchants()).select(
        "payment_id", "customer_dispute_history", "chargeback_rate_30d", "merchant_dispute_rate_30d"), "payment_id")
    assert v == [(1, 0, 0.0, 0.0), (2, 0, 0.0, 0.0), (3, 1, 0.5, 0.5), (4, 1, 0.0, 0.0)]


def test_device_email_browser(spark, tables):
    p = payments(spark, {"ts": at(1), "email": "nobody", "user_agent": None},
                 {"ts": at(3, 5), "email": "a@10minutemail.com", "user_agent": "Firefox/99.0"})
    v = rows(M.group("device_email", p, None, None, None, M.Rules(min_browser_version=100)), "payment_id")
    assert v == [(1, 0, 1, 365, 0, 0, 0), (2, 2, 0, 365, 0, 1, 1)]


def test_locate_addresses(spark):
    ranges = spark.createDataFrame([(167772160, 167903231, "FR", 46.0, 2.0), (3232235520, 3232235775, "US", 38.0, -97.0)],
                                   "start_ip bigint, end_ip bigint, country string, lat double, lon double")
    ips = spark.createDataFrame([("10.0.0.0",), ("10.1.255.255",), ("10.2.0.0",), ("192.168.0.7",), ("192.168.1.0",)], "ip_address string")
    assert rows(M.locate(ips, ranges).select("ip_address", "country"), "ip_address") == [
        ("10.0.0.0", "FR"), ("10.1.255.255", "FR"), ("10.2.0.0", None), ("192.168.0.7", "US"), ("192.168.1.0", None)]


def test_a_payment_disputed_twice_counts_once(spark, tables):
    p = payments(spark, {"ts": at(1, 10)}, {"ts": at(9, 10)})
    twice = spark.createDataFrame([(1, at(3, 1)), (1, at(4, 1))], "payment_id bigint, opened_at timestamp")
    v = {r["payment_id"]: r for r in M.feature_vector(p, twice, tables.customers(), tables.merchants()).collect()}
    assert (v[2]["merchant_dispute_rate_30d"], v[2]["merchant_chargeback_rate"], v[2]["chargeback_rate_30d"]) == (1.0, 1.0, 1.0)
    assert v[2]["customer_dispute_history"] == 2


def test_addresses_that_are_none(spark):
    ranges = spark.createDataFrame([(16777216, 16842751, "AU", -25.0, 133.0)], "start_ip bigint, end_ip bigint, country string, lat double, lon double")
    asked = spark.createDataFrame([("1.0.3.4",), ("::1",), ("1.0.0",), ("1.0.0.256",), ("1.0.x.1",), ("",), (None,), ("1.0.0.0.1",)], "ip_address string")
    assert [r["country"] for r in M.locate(asked, ranges).filter("country IS NOT NULL").collect()] == ["AU"]
    assert M.locate(asked, ranges).count() == 8


def test_longest_network_wins(spark):
    """Against the standard library's reading of addresses."""
    rnd = random.Random(6)
    nets = ["10.0.0.0/8", "10.1.0.0/16", "10.1.2.0/23", "10.1.2.128/25", "10.1.2.129/32", "0.0.0.0/1", "2001:db8::/32", "2001:db8:5::/48",
            "2001:db8:5:8000::/49", "2001:db8:5::1/128", "::/5"]
    asked = ["::ffff:10.1.2.129", "2001:DB8:5::1", "2001:db8:5:8001::9", " 10.1.3.255 ", "1::2::3", "10.1.2", "10.1.2.300", "g::1", "", None,
             "1:2:3:4:5:6:7", "1:2:3:4:5:6:7::", "::", "::1", "12345::", "200.1.1.1", "1:2:3:4:5:6:1.2.3.4", "1:2:3:4:5:6:7:8:9"]
    asked += [f"10.{rnd.choice([0, 1])}.{rnd.randint(0, 4)}.{rnd.randint(120, 135)}" for _ in range(60)]
    networks = spark.createDataFrame([(n, f"c{i}", float(i)) for i, n in enumerate(nets)], "network string, country string, lat double")
    got = A.locate_networks(spark.createDataFrame([(x,) for x in asked], "ip_address string"), networks, ["country", "lat"])

    def place(text):
        try:
            address = ipaddress.ip_address((text or "").strip())
        except ValueError:
            return None
        whole = int(address) if address.version == 6 else (0xFFFF << 32) + int(address)
        fits = []
        for i, n in enumerate(nets):
            net = ipaddress.ip_network(n, strict=False)
            base, bits = (int(net[0]), net.prefixlen) if net.version == 6 else ((0xFFFF << 32) + int(net[0]), net.prefixlen + 96)
            if whole >> (128 - bits) == base >> (128 - bits):
                fits.append((bits, f"c{i}"))
        return max(fits, default=(0, None))[1]

    assert sorted((str(r.ip_address), r.country) for r in got.collect()) == sorted((str(x), place(x)) for x in asked)


def test_two_cities_of_one_country_are_apart(spark):
    p = payments(spark, {"ts": at(1, 10)}, {"ts": at(1, 12)})
    placed = p.withColumn("latitude", F.when(F.col("payment_id") == 1, 48.86).otherwise(43.3)).withColumn(
        "longitude", F.when(F.col("payment_id") == 1, 2.35).otherwise(5.37))
    no_disputes = spark.createDataFrame([], "payment_id bigint, opened_at timestamp")
    v = {r.payment_id: r for r in M.group("geo", placed, no_disputes, None, None).collect()}
    assert v[1].distance_km == 0 and 650 < v[2].distance_km < 670 and 325 < v[2].velocity_km_per_hour < 335
