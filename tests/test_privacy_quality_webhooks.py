from __future__ import annotations

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from ledgerlark import schemas
from ledgerlark.operators import privacy as P
from ledgerlark.operators import quality as Q
from ledgerlark.operators import webhooks as W
from ledgerlark.plans import documents as D
from ledgerlark.sources import tables as T

NOW = "2024-06-01 00:00:00"


def day(text):
    return dt.datetime.fromisoformat(text)


def test_erasure_takes_children_of_erased_payments(spark):
    people = spark.createDataFrame([(1,), (2,), (3,)], "customer_id bigint")
    paid = spark.createDataFrame([(10, 1, day("2015-01-01")), (20, 2, day("2015-01-01")), (21, 2, day("2020-01-01"))],
                                 "transaction_id bigint, customer_id bigint, created_at timestamp")
    refunds = spark.createDataFrame([(100, 10), (200, 20)], "refund_id bigint, transaction_id bigint")
    d = P.erasure_decisions(people, paid, NOW)
    assert rows(d.select("customer_id", "status"), "customer_id") == [(1, "Completed"), (2, "Rejected"), (3, "Completed")]
    left = P.erase(d, {"customers": (people, "customer_id"), "transactions": (paid, "customer_id"), "refunds": (refunds, "")},
                   by_payment=["refunds"])
    assert [r["refund_id"] for r in left["refunds"].collect()] == [200] and [r["customer_id"] for r in left["customers"].collect()] == [2]
    assert left["transactions"].count() == 2


def test_anonymise_band_and_purge(spark):
    paid = spark.createDataFrame([(1, "4242", "x", day("2017-06-01")), (2, "4242", "x", day("2016-06-01")), (3, "4242", "x", day("2016-05-31"))],
                                 "customer_id bigint, last4 string, billing_address string, created_at timestamp")
    got = rows(P.anonymise_old(P.purge_payments(paid, NOW), NOW).select("customer_id", "last4", "billing_address"), "last4")
    assert got == [(1, "4242", "x"), (None, "XXXX", "REDACTED")]


def test_portability_document_is_complete(spark, tables):
    one = tables.customers().filter("customer_id = 1")
    doc = json.loads(P.portability_json(one, tables.customers(), tables.transactions(), tables.subscriptions(), NOW, "Example").first()["document"])
    assert set(doc) == {"customer", "payments", "subscriptions", "export_metadata"} and doc["customer"]["id"] == 1
    assert len(doc["payments"]) == tables.transactions().filter("customer_id = 1").count() > 0


def test_large_exports_come_in_parts(spark, tables):
    """Three records per part: everything once, and no part much larger."""
    docs = P.portability_json(tables.customers(), tables.customers(), tables.transactions(), tables.subscriptions(), NOW, "Example",
                              records_per_part=3).collect()
    ids = [p["id"] for d in docs for p in json.loads(d["document"])["payments"]]
    assert sorted(ids) == sorted(r[0] for r in tables.transactions().select("transaction_id").collect())
    assert max(d["parts"] for d in docs) > 3
    for d in docs:
        assert 1 <= d["part"] <= d["parts"] and json.loads(d["document"])["customer"]["id"] == d["customer_id"]


def test_masks_and_pseudonyms(spark):
    df = spark.createDataFrame([("john@x.com", "4242424242424242", None)], "email string, card string, note string")
    assert rows(P.mask_columns(df, {"email": "email", "card": "last4", "note": "redact"})) == [("jXXX@XXXX.com", "****4242", None)]
    a, b = (P.pseudonymise(spark.createDataFrame([(7,)], "id bigint"), ["id"], salt).first()[0] for salt in ("s", "t"))
    assert a != b and len(a) == 64


def test_detectors(spark):
    df = spark.createDataFrame([("mail me at a.b@c.org",), ("4111 1111 1111 1111",), ("FR7630006000011234567890189",), ("plain",)], "text string")
    found = {(r["kind"], r["hits"], r["protection"]) for r in P.classify_columns(df, "t").collect()}
    assert found == {("email", 1, "encrypt and mask"), ("card number", 1, "tokenise"), ("iban", 1, "tokenise")}


def test_severity_and_geo_jump(spark):
    i = spark.createDataFrame([(1, 99, False, False), (2, 100, False, False), (3, 1, True, False), (4, 1, False, True), (5, 10001, False, False)],
                              "incident_id int, records int, has_pii boolean, has_payment_data boolean")
    assert [r[4] for r in rows(P.breach_severity(i), "incident_id")] == ["Low", "Medium", "Medium", "High", "High"]
    seen = [(1, "p", day("2024-01-01 10:00"), "FR"), (2, "p", day("2024-01-01 10:59"), "US"), (3, "p", day("2024-01-01 12:00"), "FR")]
    a = spark.createDataFrame(seen, "id bigint, principal string, ts timestamp, country string")
    assert [r["id"] for r in P.geo_jump(a, "principal", "ts", "country", "id").collect()] == [2]
    twice = a.unionByName(a.filter("id = 3").selectExpr("4 AS id", "principal", "ts", "'DE' AS country"))
    assert sorted(r["id"] for r in P.geo_jump(twice, "principal", "ts", "country", "id").collect()) == [2, 4]


def test_rules_count_null_as_failure(spark):
    df = spark.createDataFrame([(1,), (None,), (-1,)], "amount int")
    assert rows(Q.check_rules(df, "t", {"positive": "amount > 0"})) == [("positive", "t", 2, 3, False)]
    assert Q.missing_values(df, "t", ["amount"]).first()["failed"] == 1


def test_foreign_key_with_a_busy_key(spark):
    child = spark.createDataFrame([(1,)] * 5 + [(9,)] * 3 + [(None,)], "parent bigint")
    parent = spark.createDataFrame([(1,), (1,), (2,)], "id bigint")
    assert rows(Q.foreign_key(child, "c", "parent", parent, "id")) == [("parent resolves", "c", 3, 8, False)]


def test_schema_rules(spark):
    df = spark.createDataFrame([], "customer_id bigint, Email string, DateOfBirth date")
    failed = {r["rule"] for r in Q.forbidden_columns(spark, df.schema, "c").filter("NOT passed").collect()}
    assert failed == {"no date_of_birth", "has country_code"}
    other = spark.createDataFrame([], "customer_id int").schema
    assert not Q.schema_matches(spark, df.schema, other, "c").first()["passed"]
    got = {r["rule"]: r["passed"] for r in Q.schema_matches(spark, df.schema, df.select("customer_id", "Email").schema, "c").collect()}
    assert got == {"customer_id is bigint": True, "Email is string": True, "DateOfBirth is declared": False}


def test_rows_that_break_the_schema_rules(spark):
    df = spark.createDataFrame([(1, "a", None), (2, None, "x"), (3, "c", "y")], "customer_id bigint, Email string, `Date_Of.Birth` string")
    got = {r["rule"]: (r["failed"], r["total"]) for r in Q.held_values(df, "c", ["date_of.birth", "gender"], ["e_mail", "country_code"]).collect()}
    assert got == {"no date_of.birth": (2, 3), "no gender": (0, 3), "has e_mail": (1, 3), "has country_code": (3, 3)}
    off = Q.rows_off_schema(df, "c", df.select("customer_id").schema).filter("NOT passed")
    assert sorted((r["rule"], r["failed"]) for r in off.collect()) == [("Date_Of.Birth is declared", 3), ("Email is declared", 3)]
    assert all(r["passed"] for r in Q.held_values(df.limit(0), "c").collect())


def test_declared_tables_parse_and_rules_compile(spark):
    for name, ddl in {**schemas.TABLES, **schemas.DOCUMENTS}.items():
        df = spark.createDataFrame([], ddl)
        assert df.columns
        if name in schemas.RULES:
            assert Q.check_rules(df, name, schemas.RULES[name]).filter("NOT passed").isEmpty()


def test_webhook_results(spark):
    w = spark.createDataFrame([(1, "pending", 0, None, None), (2, "failed", 4, None, None), (3, "failed", 5, None, None), (4, "pending", 0, None, None)],
                              "webhook_id bigint, status string, retry_count int, delivered_at timestamp, next_retry_at timestamp")
    r = spark.createDataFrame([(1, 200), (2, 500), (3, 500)], "webhook_id bigint, response_code int").withColumn(
        "finished_at", F.lit(NOW).cast("timestamp"))
    got = rows(W.apply_results(w, r).select("webhook_id", "status", "retry_count", "next_retry_at"), "webhook_id")
    assert got == [(1, "sent", 0, None), (2, "failed", 5, day(NOW) + dt.timedelta(minutes=16)), (3, "cancelled", 5, None),
                   (4, "pending", 0, None)]


def test_multi_line_documents_with_missing_fields(spark, tmp_path):
    docs = [
        {"session_id": "s1", "user_id": "u", "session_start": "2024-05-31T10:00:00.250Z", "last_activity": "2024-05-31T10:00:05.000Z",
         "duration_seconds": 5, "actions_count": 51, "device_type": "desktop",
         "events": [{"timestamp": "2024-05-31T10:00:00.250Z", "event_type": "login", "page": "/login", "details": {"a": 1}}],
         "page_views": [{"page": "/a", "count": 2, "total_time_seconds": 3}, {"page": "/b", "count": 1, "total_time_seconds": 1}]},
        {"session_id": "s2", "user_id": "u", "session_start": "2024-05-31T00:00:00Z", "session_end": "2024-05-31T09:00:00Z",
         "duration_seconds": 32400, "actions_count": 3, "device_type": "mobile", "page_views": []},
    ]
    (tmp_path / "sessions.json").write_text(json.dumps(docs, indent=2))
    df = T.scan_documents(spark, str(tmp_path), schemas.DOCUMENTS["user_sessions"])
    assert [r["session_id"] for r in D.active_sessions(df).collect()] == ["s1"]
    assert {r["session_id"] for r in D.suspicious_sessions(df, NOW).collect()} == {"s1", "s2"}
    assert rows(D.page_views(df, NOW).select("page", "count"), "page") == [("/a", 2), ("/b", 1)]
    assert df.select(F.variant_get(F.col("events")[0]["details"], "$.a", "int")).first()[0] == 1


@pytest.mark.parametrize("ids", [["pi_1", "pi_12", "pi_123_x", "pi_é"], ["aa", "aaa", "ab"], ["x", "yy"], ["only.one[1"]])
def test_mentions_are_what_contains_finds(spark, ids):
    """Inside longer words, overlapping, with other separators, and without a common beginning."""
    rnd = random.Random(4)
    pieces = [*ids, "pi_", "aaaa", "b", "_secret_", '"', "\n", "xpi_1y", "only.one[", "é"]
    bodies = [(i, "".join(rnd.choices(pieces, k=rnd.randint(0, 7)))) for i in range(150)] + [(999, None), (998, "")]
    refs = spark.createDataFrame([(x,) for x in ids], "payment_ref string")
    logs = spark.createDataFrame(bodies, "log_id bigint, request_body string")
    found = D.payment_mentions(logs, *D.id_shapes(refs, "payment_ref")).join(refs, "payment_ref")
    want = sorted((i, x) for i, b in bodies for x in ids if b and x in b)
    assert sorted((r.log_id, r.payment_ref) for r in found.collect()) == want


def test_exports_and_roles(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", 2)], "id int, name string, secret int")
    seen = T.project_for_role(df, "analyst", {"analyst": ("name", "id")})
    assert seen.columns == ["id", "name"]
    T.export_csv(seen, str(tmp_path / "c"))
    T.export_json(seen, str(tmp_path / "j"))
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).first()["name"] == "a"
    assert spark.read.json(str(tmp_path / "j")).first()["id"] == 1
