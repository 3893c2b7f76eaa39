"""Webhook queue: what is due, what a delivery result changes, and how healthy endpoints are."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.functions import expr as X

MAX_RETRIES = 5
BASE_DELAY_SECONDS = 60


def due(webhooks: DataFrame, as_of, max_retries: int = MAX_RETRIES) -> DataFrame:
    """New ones, and failed ones whose retry time has come."""
    retry = (F.col("status") == "failed") & (F.col("retry_count") < max_retries) & (F.col("next_retry_at") <= X.ts(as_of))
    return webhooks.filter((F.col("status") == "pending") | retry)


def backoff_seconds(retries_so_far: str | Column) -> Column:
    """1, 2, 4, 8, 16 minutes after 0, 1, 2, 3, 4 retries."""
    return (F.lit(BASE_DELAY_SECONDS) * F.pow(F.lit(2), X.col(retries_so_far))).cast("bigint")


def schedule(webhooks: DataFrame, max_retries: int = MAX_RETRIES) -> DataFrame:
    """Delay before the next attempt; null when the attempts are used up."""
    return webhooks.withColumn(
        "delay_seconds", F.when(F.col("retry_count") < max_retries, backoff_seconds("retry_count")))


def apply_results(webhooks: DataFrame, results: DataFrame, max_retries: int = MAX_RETRIES) -> DataFrame:
    """The queue after delivery: 200 is sent, anything else is retried later or cancelled.

    ``results``: webhook_id (once), response_code, finished_at. Webhooks without a result stay as they are.
    """
    r = results.select("webhook_id", "response_code", "finished_at")
    tried, good = F.col("finished_at").isNotNull(), F.col("response_code") == 200
    spent = F.col("retry_count") >= max_retries
    later = F.timestamp_seconds(F.unix_seconds("finished_at") + backoff_seconds("retry_count"))
    return webhooks.join(r, "webhook_id", "left").withColumns({
        "status": F.when(~tried, F.col("status")).when(good, "sent").when(spent, "cancelled").otherwise("failed"),
        "delivered_at": F.when(tried & good, F.col("finished_at")).otherwise(F.col("delivered_at")),
        "next_retry_at": F.when(~tried, F.col("next_retry_at")).when(~good & ~spent, later),
        "retry_count": F.when(tried & ~F.coalesce(good, F.lit(False)) & ~spent, F.col("retry_count") + 1).otherwise(
            F.col("retry_count")),
    }).drop("response_code", "finished_at")


def health(webhooks: DataFrame, notify_below: float = 95.0, disable_above: int = 100) -> DataFrame:
    status = F.col("status")
    action = (
        F.when(F.col("failed_count") > disable_above, "disable")
        .when(F.col("success_rate") < notify_below, "notify").otherwise("none"))
    return (
        webhooks.groupBy("merchant_id")
        .agg(F.count("*").alias("total"), F.count_if(status == "sent").alias("sent_count"),
             F.count_if(status == "failed").alias("failed_count"))
        .withColumn("success_rate", X.pct("sent_count", "total"))
        .withColumn("action", action)
    )


def dashboard(webhooks: DataFrame, max_retries: int = MAX_RETRIES) -> DataFrame:
    status = F.col("status")
    took = F.when(status == "sent", F.unix_millis("delivered_at") - F.unix_millis("created_at"))
    return webhooks.agg(
        F.count("*").alias("total_webhooks"),
        X.pct(F.count_if(status == "sent"), F.count("*")).alias("success_rate"),
        X.mean(took).alias("avg_delivery_ms"),
        F.count_if((status == "failed") & (F.col("retry_count") < max_retries)).alias("in_retry"),
        F.count_if((status == "failed") & (F.col("retry_count") >= max_retries)).alias("exhausted"),
    )
