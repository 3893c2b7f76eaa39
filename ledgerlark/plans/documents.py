"""Reports over API logs, sessions, fraud-feature documents and webhook events.

A report for one merchant or user becomes a report for all of them: the id is a group key and,
when given, a pushed-down predicate.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.functions import expr as X
from ledgerlark.operators.ranking import top_n, top_n_per_group
from ledgerlark.plans.operations import only, since


# -- API logs --------------------------------------------------------------------
def logs_recent(logs, as_of, hours: int = 24, merchant_id=None) -> DataFrame:
    return (
        only(since(logs, as_of, hours, "HOUR", "ts"), merchant_id=merchant_id)
        .select("log_id", "merchant_id", "ts", "endpoint", "status_code", "latency_ms")
        .orderBy(F.desc("ts"))
    )


def errors_by_endpoint(logs, as_of, days: int = 7, merchant_id=None) -> DataFrame:
    return (
        only(since(logs, as_of, days, "DAY", "ts").filter(F.col("status_code") >= 500), merchant_id=merchant_id)
        .groupBy("merchant_id", "endpoint")
        .agg(F.count("*").alias("error_count"), X.mean("latency_ms").alias("avg_latency"),
             F.max("latency_ms").alias("max_latency"))
        .orderBy(F.desc("error_count"))
    )


def slowest_calls(logs, as_of, hours: int = 24, n: int = 100, per_merchant: bool = False) -> DataFrame:
    recent = since(logs, as_of, hours, "HOUR", "ts").select("log_id", "merchant_id", "ts", "endpoint", "latency_ms")
    order = (F.desc("latency_ms"), F.asc("log_id"))
    return top_n_per_group(recent, ["merchant_id"], n, *order) if per_merchant else top_n(recent, n, *order)


def success_rate_hourly(logs, as_of, hours: int = 24, merchant_id=None) -> DataFrame:
    good = F.col("status_code").between(200, 299)
    return (
        only(since(logs, as_of, hours, "HOUR", "ts"), merchant_id=merchant_id)
        .groupBy("merchant_id", F.hour("ts").alias("hour"))
        .agg(F.count("*").alias("total_requests"), F.count_if(good).alias("success_count"))
        .withColumn("success_rate", X.pct("success_count", "total_requests"))
        .orderBy(F.desc("hour"))
    )


# -- sessions -----------------------------------------------------------------------
def active_sessions(sessions, user_id=None) -> DataFrame:
    return (
        only(sessions.filter(F.col("session_end").isNull()), user_id=user_id)
        .select("user_id", "session_id", "session_start", "last_activity", "device_type")
        .orderBy(F.desc("last_activity"))
    )


def page_views(sessions, as_of, days: int = 30, user_id=None) -> DataFrame:
    return only(since(sessions, as_of, days, "DAY", "session_start"), user_id=user_id).select(
        "user_id", "session_id", "session_start", "duration_seconds", F.inline("page_views"))


def suspicious_sessions(sessions, as_of, days: int = 7, user_id=None, fast_seconds: int = 10, many_actions: int = 50,
                        long_seconds: int = 28800) -> DataFrame:
    seconds, actions = F.col("duration_seconds"), F.col("actions_count")
    odd = ((seconds < fast_seconds) & (actions > many_actions)) | (seconds > long_seconds)
    return (
        only(since(sessions, as_of, days, "DAY", "session_start").filter(odd), user_id=user_id)
        .select("user_id", "session_id", "session_start", "duration_seconds", "actions_count", "device_type")
        .orderBy(F.desc("session_start"))
    )


def engagement_by_device(sessions, as_of, days: int = 90, user_id=None) -> DataFrame:
    finished = since(sessions.filter(F.col("session_end").isNotNull()), as_of, days, "DAY", "session_start")
    return (
        only(finished, user_id=user_id)
        .groupBy("device_type")
        .agg(
            F.count("*").alias("session_count"),
            X.mean("duration_seconds").alias("avg_duration"),
            X.mean("actions_count").alias("avg_actions"),
            F.sum("duration_seconds").alias("total_time"),
        )
        .orderBy(F.desc("session_count"))
    )


# -- fraud-feature documents ------------------------------------------------------------
def _mean_score():
    """Scores have four digits, so their sum is exact."""
    return X.mean(F.col("fraud_score").cast("decimal(9,4)"))


def features_by_payment(documents, payment_id) -> DataFrame:
    return documents.filter(F.col("payment_id") == F.lit(payment_id))


def high_risk_payments(documents, as_of, hours: int = 24, at_least: float = 0.7, merchant_id=None) -> DataFrame:
    return (
        only(since(documents, as_of, hours, "HOUR", "computed_at"), merchant_id=merchant_id)
        .filter(F.col("fraud_score") >= at_least)
        .select("payment_id", "merchant_id", "customer_id", "fraud_score", "risk_level", "computed_at",
                "features.transaction_velocity_1h", "features.card_country_mismatch", "features.ip_country_mismatch")
        .orderBy(F.desc("fraud_score"))
    )


def fraud_patterns(documents, as_of, days: int = 7, merchant_id=None) -> DataFrame:
    return (
        only(since(documents, as_of, days, "DAY", "computed_at"), merchant_id=merchant_id)
        .groupBy("merchant_id", "risk_level")
        .agg(
            F.count("*").alias("payments"),
            _mean_score().alias("avg_score"),
            X.mean("features.transaction_velocity_1h").alias("avg_velocity_1h"),
            X.mean("features.transaction_velocity_24h").alias("avg_velocity_24h"),
            F.count_if("features.card_country_mismatch").alias("card_mismatch_count"),
            F.count_if("features.ip_country_mismatch").alias("ip_mismatch_count"),
        )
    )


def customers_with_disputes(documents, as_of, days: int = 90, merchant_id=None) -> DataFrame:
    return (
        only(since(documents, as_of, days, "DAY", "computed_at"), merchant_id=merchant_id)
        .groupBy("customer_id", F.col("features.customer_dispute_history").alias("disputes"))
        .agg(F.count("*").alias("payment_count"), _mean_score().alias("avg_fraud_score"))
        .filter(F.col("disputes") > 0)
        .orderBy(F.desc("disputes"))
    )


# -- webhook events --------------------------------------------------------------------------
def webhooks_to_retry(webhooks, as_of, max_retries: int = 5, merchant_id=None) -> DataFrame:
    due = (F.col("status") == "failed") & (F.col("retry_count") < max_retries) & (F.col("next_retry_at") <= X.ts(as_of))
    return (
        only(webhooks.filter(due), merchant_id=merchant_id)
        .select("webhook_id", "merchant_id", "event_type", "retry_count", "next_retry_at")
        .orderBy("next_retry_at")
    )


def webhook_stats(webhooks, as_of, days: int = 7, merchant_id=None) -> DataFrame:
    status = F.col("status")
    return (
        only(since(webhooks, as_of, days, "DAY"), merchant_id=merchant_id)
        .groupBy("merchant_id", "event_type")
        .agg(
            F.count("*").alias("total_events"),
            F.count_if(status == "sent").alias("sent_count"),
            F.count_if(status == "failed").alias("failed_count"),
            X.mean("response_time_ms").alias("avg_response_time"),
            X.mean("retry_count").alias("avg_retry_count"),
        )
        .withColumn("success_rate", X.pct("sent_count", "total_events"))
        .orderBy(F.desc("total_events"))
    )


def slow_webhooks(webhooks, as_of, hours: int = 24, slower_than: int = 5000, n: int = 50) -> DataFrame:
    slow = since(webhooks, as_of, hours, "HOUR").filter(
        (F.col("status") == "sent") & (F.col("response_time_ms") > slower_than))
    return top_n(slow.select("webhook_id", "merchant_id", "event_type", "response_time_ms", "created_at"), n,
                 F.desc("response_time_ms"), F.asc("webhook_id"))


def delivery_time(webhooks, as_of, hours: int = 24, merchant_id=None) -> DataFrame:
    sent = since(webhooks, as_of, hours, "HOUR").filter((F.col("status") == "sent") & F.col("delivered_at").isNotNull())
    return (
        only(sent, merchant_id=merchant_id)
        .select("webhook_id", "merchant_id", "event_type", "created_at", "delivered_at",
                X.seconds_between("created_at", "delivered_at").alias("delivery_time_seconds"), "retry_count")
        .orderBy(F.desc("delivery_time_seconds"))
    )


# -- across collections -----------------------------------------------------------------------
def id_shapes(ids: DataFrame, column: str) -> tuple[str, list[int]]:
    """What all ids of a column begin with, and their lengths: a handful of numbers, whatever the number of ids."""
    r = ids.agg(F.min(column).alias("a"), F.max(column).alias("b"), F.sort_array(F.collect_set(F.length(column))).alias("n")).first()
    return os.path.commonprefix([r["a"] or "", r["b"] or ""]), r["n"]


def payment_mentions(logs: DataFrame, prefix: str, lengths: Sequence[int]) -> DataFrame:
    """One row per log and text that could be a payment id in its body: every place where ``prefix`` stands, at every length ids have.

    An equality join with the ids then finds what a substring search for each id finds, also inside longer words.
    """
    longest = max(lengths, default=0)
    tails = F.regexp_extract_all("request_body", F.lit(f"(?s)(?=(\\Q{prefix}\\E.{{0,{max(longest - len(prefix), 0)}}}))"), F.lit(1))
    cut = F.transform(tails, lambda t: F.filter(F.array(*[F.left(t, F.lit(n)) for n in lengths]).cast("array<string>"),
                                                lambda x: x != ""))
    whole = F.filter(F.array_distinct(F.flatten(cut)), lambda x: F.length(x).isin(list(lengths)))
    return logs.withColumn("payment_ref", F.explode(whole))


def audit_trail(payments, logs, seconds: int = 60) -> DataFrame:
    """Logs of the payment's merchant within ``seconds`` of it whose body contains the payment's id.

    Candidates for ids are taken out of the body, so the two sides meet on (merchant, payment) instead of
    pairing every log of a merchant with every payment.
    """
    said = payment_mentions(logs, *id_shapes(payments, "payment_ref")).select(
        "merchant_id", "payment_ref", "log_id", F.col("ts").alias("logged_at"), "endpoint", "status_code", "latency_ms")
    apart = F.abs(F.unix_micros("logged_at") - F.unix_micros("paid_at"))
    return payments.join(said, ["merchant_id", "payment_ref"]).filter(apart <= seconds * 1_000_000)
