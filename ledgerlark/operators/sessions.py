"""User sessions from single events: batch form, safe for busy users."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlark.functions import expr as X
from ledgerlark.operators.timeslice import HOT_ROWS, micros, neighbours, no_busy_keys, running_before

SESSION_GAP_SECONDS = 15 * 60


def session_numbers(events: DataFrame, user: str = "user_id", ts: str = "ts", gap: int = SESSION_GAP_SECONDS,
                    hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Add ``session_no`` (1, 2, ... per user) and ``stay_seconds`` until the next event of the session.

    As in Spark's session windows, events exactly ``gap`` apart are one session.
    """
    if hot_rows and no_busy_keys(events, [user], hot_rows):
        hot_rows = None
    span = F.lit(gap * 1_000_000)
    e = neighbours(events.withColumn("_us", micros(ts)), [user], "_us", hot_rows)
    e = e.withColumn("_starts", (F.col("_prev").isNull() | (F.col("_us") - F.col("_prev") > span)).cast("bigint"))
    e = running_before(e, [user], "_us", {"_started": "_starts"}, hot_rows=hot_rows)
    stay = F.when(F.col("_next") - F.col("_us") <= span, (F.col("_next") - F.col("_us")) / 1_000_000).otherwise(0.0)
    # Of rows of one instant only the first is seen to start the session; all of them belong to it.
    begins = F.max("_starts").over(Window.partitionBy(user, "_us"))
    return (
        e.withColumn("session_no", F.col("_started") + begins)
        .withColumn("stay_seconds", F.floor(stay))
        .drop("_us", "_prev", "_next", "_starts", "_started")
    )


def session_documents(events: DataFrame, as_of, gap: int = SESSION_GAP_SECONDS, ttl_days: int = 30,
                      with_events: bool = False, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """One document per session with its page views, one entry per page.

    Columns needed: user_id, ts, event_type, page, device_type. A session whose last activity
    is within the gap before ``as_of`` is still open and has no ``session_end``. ``with_events``
    adds the list of single events; leave it out where a user may never pause, because the list
    is as long as the session.
    """
    numbered = session_numbers(events, gap=gap, hot_rows=hot_rows)
    pages = numbered.groupBy("user_id", "session_no", "page").agg(
        F.count("*").alias("count"),
        F.sum("stay_seconds").alias("total_time_seconds"),
        F.min("ts").alias("_first"),
        F.max("ts").alias("_last"),
        F.max("device_type").alias("device_type"),
        *([F.collect_list(F.struct(F.col("ts").alias("timestamp"), "event_type", "page")).alias("_events")]
          if with_events else []),
    )
    docs = pages.groupBy("user_id", "session_no").agg(
        F.min("_first").alias("session_start"),
        F.max("_last").alias("last_activity"),
        F.sum("count").alias("actions_count"),
        F.max("device_type").alias("device_type"),
        *([F.sort_array(F.flatten(F.collect_list("_events"))).alias("events")] if with_events else []),
        F.sort_array(F.collect_list(F.struct("page", "count", "total_time_seconds"))).alias("page_views"),
    )
    closed = micros("last_activity") + gap * 1_000_000 <= micros(X.ts(as_of))
    return (
        docs.withColumn("session_id", F.concat_ws("_", F.lit("sess"), F.col("user_id"), F.col("session_no")))
        .withColumn("session_end", F.when(closed, F.col("last_activity")))
        .withColumn("duration_seconds", X.seconds_between("session_start", "last_activity"))
        .withColumn("ttl", F.lit(ttl_days * 86400))
    )
