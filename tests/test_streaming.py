from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from conftest import rows
from ledgerlark.operators import sessions as S
from ledgerlark.session import scratch
from ledgerlark.streaming import jobs as J

T0 = dt.datetime(2024, 1, 1)
LOGS = "ts timestamp, merchant_id bigint, endpoint string, status_code int, latency_ms bigint"


def feed(spark, schema, *batches):
    """Files that arrive one after the other."""
    path = scratch(spark, "feed")
    for batch in batches:
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(path)
    return J.file_stream(spark, path, schema, files_per_batch=1)


def log(seconds, status=200, latency=10):
    return (T0 + dt.timedelta(seconds=seconds), 1, "/v1", status, latency)


def test_closed_windows_equal_the_batch_form(spark):
    batch = [log(s, 500 if s % 3 == 0 else 200, s) for s in range(0, 1500, 7)]
    stream = J.watermarked(feed(spark, LOGS, batch[:100], batch[100:]))
    got = rows(J.run_available(J.api_performance(stream), "perf"), "window_end")
    newest = batch[-1][0] - dt.timedelta(seconds=30)
    want = [r for r in rows(J.api_performance(spark.createDataFrame(batch, LOGS)), "window_end") if r[0] <= newest]
    assert got == want and len(got) == 4


def test_late_rows_are_dropped(spark):
    stream = J.watermarked(feed(spark, LOGS, [log(10)], [log(700)], [log(710)], [log(20)], [log(1300)]))
    got = rows(J.run_available(J.api_performance(stream), "late"), "window_end")
    assert [(r[0].minute, r[3]) for r in got] == [(5, 1), (15, 2)]


def test_late_rows_of_every_batch_are_counted(spark):
    """More batches than a query keeps progress of."""
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    batches = [[log(10_000)]] + [[log(i), log(20_000)] for i in range(12)]
    heard, path = scratch(spark, "late"), scratch(spark, "late-out")
    listener = J.LateRows(spark, heard)
    spark.streams.addListener(listener)
    try:
        J.run_available(J.api_performance(J.watermarked(feed(spark, LOGS, *batches))), "late-rows", path)
        assert listener.wait()
    finally:
        spark.streams.removeListener(listener)
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    got = J.late_rows(spark, heard)
    # Spark judges a batch by the watermark of the batch before it, so the first old row still counts.
    assert got.select("batch").distinct().count() >= 13 and got.agg(F.sum("dropped")).first()[0] == 11


def test_sketched_windows_have_the_exact_percentile(spark):
    batch = [log(s, latency=(s * 7919) % 1009) for s in range(0, 1500, 3)]
    stream = J.watermarked(feed(spark, LOGS, batch[:300], batch[300:]))
    plan = J.api_performance_sketched(stream)
    got = J.with_exact_p99(J.run_available(plan, "sketched"), spark.createDataFrame(batch, LOGS))
    columns = ["window_end", "merchant_id", "endpoint", "request_count", "avg_latency", "p99_latency", "error_count"]
    newest = batch[-1][0] - dt.timedelta(seconds=30)
    want = [r for r in rows(J.api_performance(spark.createDataFrame(batch, LOGS)).select(columns), "window_end") if r[0] <= newest]
    assert rows(got.select(columns), "window_end") == want and len(got.columns) == 7


def test_alert_needs_neighbouring_windows(spark):
    bad = [log(5, 500), log(65, 500), log(185, 500), log(305, 500), log(365, 500), log(900)]
    stream = J.watermarked(feed(spark, LOGS, bad))
    got = [r[0].minute for r in rows(J.run_available(J.two_window_alerts(stream), "alerts"), "alert_from")]
    assert got == [0, 5]


def test_replayed_events_count_once(spark):
    schema = "event_id bigint, ts timestamp"
    one = [(i, T0 + dt.timedelta(seconds=i)) for i in range(5)]
    assert J.run_available(J.deduplicated(feed(spark, schema, one, one)), "dedup").count() == 5


def test_a_replay_after_days_counts_once(spark):
    schema = "event_id bigint, ts timestamp"
    later = [(9, T0 + dt.timedelta(days=6))]
    stream = J.deduplicated(feed(spark, schema, [(1, T0)], later, [(1, T0)], later))
    assert J.run_available(stream, "replay").count() == 2


def test_throughput_counts_every_batch(spark):
    """More batches than the query keeps progress of."""
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    path = scratch(spark, "throughput")
    batches = [[(f'{{"k": {i}}}',), ("{broken",)] for i in range(6)]
    counted = J.conversion(feed(spark, "props string", *batches), "props", "k BIGINT")
    J.run_each_batch(counted, "throughput", J.count_batches(f"{path}/counts"), path)
    spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert [(r["input_rows"], r["malformed"]) for r in J.throughput(spark, f"{path}/counts").collect()] == [(2, 1)] * 6


def test_sessions_stream_and_batch_agree(spark):
    schema = "user_id bigint, ts timestamp, event_type string"
    events = [(u, T0 + dt.timedelta(seconds=s), "view") for u in (1, 2) for s in (0, 60, 899, 3000, 3900, 90000 + u)]
    stream = J.watermarked(feed(spark, schema, events))
    got = rows(J.run_available(J.sessions(stream), "sessions").select("user_id", "session_start", "actions_count"), "user_id", "session_start")
    numbered = S.session_numbers(spark.createDataFrame(events, schema), hot_rows=0)
    batch = numbered.groupBy("user_id", "session_no").agg(F.min("ts").alias("session_start"), F.count("*").alias("actions_count"))
    want = [r for r in rows(batch.select("user_id", "session_start", "actions_count"), "user_id", "session_start")
            if r[1] < T0 + dt.timedelta(days=1)]
    assert got == want and [r[2] for r in got] == [3, 2, 3, 2]


def test_change_feed_replays_and_late_changes(spark):
    schema = "payment_id bigint, lsn bigint, op int, status string"
    first = [(1, 1, 2, "PENDING"), (2, 2, 2, "PENDING"), (3, 3, 2, "PENDING")]
    second = [(1, 4, 3, "PENDING"), (1, 5, 4, "SUCCEEDED"), (2, 6, 1, "PENDING")]
    table = scratch(spark, "applied")
    J.run_each_batch(feed(spark, schema, first, second, first), "apply", J.upsert_by_lsn(table, "payment_id", buckets=4))
    assert rows(J.current_rows(spark, table).select("payment_id", "status"), "payment_id") == [(1, "SUCCEEDED"), (3, "PENDING")]


def test_interval_join_bounds(spark):
    paid = feed(spark, "merchant_id bigint, payment_ref string, paid_at timestamp", [(1, "pi_1", T0), (1, "pi_2", T0)])
    said = feed(spark, "merchant_id bigint, payment_ref string, logged_at timestamp",
                [(1, "pi_1", T0 + dt.timedelta(seconds=60)), (1, "pi_2", T0 + dt.timedelta(seconds=61)), (2, "pi_1", T0)])
    joined = J.joined_logs(J.watermarked(paid, "paid_at"), J.watermarked(said, "logged_at"))
    assert [r["payment_ref"] for r in J.run_available(joined, "join").collect()] == ["pi_1"]


PAID, SAID = "merchant_id bigint, payment_ref string, paid_at timestamp", "merchant_id bigint, payment_ref string, logged_at timestamp"


def test_joined_batches_equal_the_stream_join(spark):
    """Rows of one and of several batches, late rows, a row without time, repeated rows; no state store is used."""
    def at(*seconds):
        return [(1, f"pi_{s % 7}", None if s is None else T0 + dt.timedelta(seconds=s)) for s in seconds]

    paid = [at(0, 30, 30), at(500, 10), at(2000, 505, 20), at(2050, 30, 700), [(2, "pi_1", None)]]
    said = [at(60, 91, 37), at(507, 40, 470), at(2030, 0, 560), at(2044, 2099, 30), at(9000)]

    def frames():
        return J.watermarked(feed(spark, PAID, *paid), "paid_at"), J.watermarked(feed(spark, SAID, *said), "logged_at")

    want = rows(J.run_available(J.joined_logs(*frames()), "stream-join"))
    path = scratch(spark, "batches")
    got = rows(J.run_joined_logs(*frames(), "batch-join", path=path))
    assert sorted(got) == sorted(want) and len(got) > 4
    from ledgerlark.session import folder_names
    assert "state" not in folder_names(spark, f"{path}/checkpoint")
    assert "batch=0" not in folder_names(spark, f"{path}/rows") and "batch=4" in folder_names(spark, f"{path}/rows")


def test_velocity_by_slides_equals_the_stream_windows(spark):
    """Several batches with late payments, null customers and amounts; no state store is used, and old slides are removed."""
    import random
    from ledgerlark.session import folder_names

    rnd, schema = random.Random(3), "ts timestamp, customer_id bigint, amount_minor bigint"
    batches = [[(T0 + dt.timedelta(seconds=at + rnd.randrange(-6000, 3000)), rnd.choice([1, 2, None]), rnd.choice([5, 7, None]))
                for _ in range(12)] + [(None, 1, 1)] for at in (0, 2000, 9000, 9500, 30000)]
    want = rows(J.run_available(J.velocity(J.watermarked(feed(spark, schema, *batches))), "windows"))
    path = scratch(spark, "slides")
    got = rows(J.run_velocity(J.watermarked(feed(spark, schema, *batches)), "slides", path=path))
    assert sorted(map(str, got)) == sorted(map(str, want)) and len(got) > 100
    assert "state" not in folder_names(spark, f"{path}/checkpoint") and "batch=0" not in folder_names(spark, f"{path}/panes")


def test_malformed_rows_are_marked(spark):
    df = spark.createDataFrame([('{"k": 1}',), ("{broken",), ('{"k": "x"}',)], "props string")
    assert [r["malformed"] for r in J.conversion(df, "props", "k BIGINT").collect()] == [False, True, True]
