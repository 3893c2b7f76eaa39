"""Streaming jobs over the event files, run to completion, and their checks.

A window is in the result once the watermark (newest event minus 30 seconds) has passed its end.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlark.operators import features as M
from ledgerlark.operators import models as T
from ledgerlark.operators import scoring as N
from ledgerlark.plans.documents import id_shapes, payment_mentions
from ledgerlark.registry import documents as D
from ledgerlark.registry import query
from ledgerlark.registry.features import RULES, back
from ledgerlark.registry.models import SMALL, quoted, training_rows
from ledgerlark.registry.fixture_sql import part
from ledgerlark.session import scratch
from ledgerlark.sources.driver_tables import API_LOG_COLUMNS, PAYMENT_COLUMNS
from ledgerlark.streaming import jobs as J
from ledgerlark.streaming.changes import ChangeStore
from ledgerlark.streaming import scoring as L
from ledgerlark.streaming import stateful as K

EVENT_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
CLOSED = "(SELECT max(ts) - INTERVAL 30 SECOND FROM events)"


def arriving(t):
    raw = J.file_stream(t.spark, t.path, EVENT_SCHEMA, "events.parquet")
    return raw.withColumn("ts", F.col("ts").cast("timestamp"))


def events(t):
    return J.watermarked(arriving(t))


def logs(t):
    return events(t).selectExpr(*API_LOG_COLUMNS)


def payments(t):
    return events(t).selectExpr(*PAYMENT_COLUMNS)


PERF_COLUMNS = ("window_end:t merchant_id:i endpoint:s request_count:i avg_latency:r p99_latency:r error_count:i")
PERF = """SELECT time_bucket(INTERVAL 5 MINUTE, ts, TIMESTAMP '2000-01-01') + INTERVAL 5 MINUTE AS window_end, merchant_id, endpoint,
    count(*) AS request_count, CAST(sum(latency_ms) AS DOUBLE) / count(*) AS avg_latency,
    quantile_cont(latency_ms, 0.99) AS p99_latency, count(*) FILTER (status_code >= 500) AS error_count
  FROM x_logs GROUP BY 1, 2, 3"""


@query("api_performance_fact", PERF_COLUMNS, PERF)
def api_performance_fact(t):
    return J.api_performance(t.api_logs())


@query("stream_api_perf_5m", PERF_COLUMNS, f"SELECT * FROM ({PERF}) WHERE window_end <= {CLOSED}")
def stream_api_perf(t):
    return J.with_exact_p99(J.run_available(J.api_performance_sketched(logs(t)), "api-perf"), t.api_logs())


def bucketed(width: str) -> str:
    return f"time_bucket(INTERVAL {width}, ts, TIMESTAMP '2000-01-01')"


def spikes(width: str) -> str:
    return f"""SELECT * FROM (SELECT {bucketed(width)} + INTERVAL {width} AS window_end, merchant_id, count(*) AS total_requests,
        count(*) FILTER (status_code >= 500) AS error_count,
        CAST(count(*) FILTER (status_code >= 500) AS DOUBLE) / count(*) AS error_rate FROM x_logs GROUP BY 1, 2)
      WHERE error_rate > 0.05"""


@query("stream_error_spike_1m", "window_end:t merchant_id:i total_requests:i error_count:i error_rate:r",
       f"SELECT * FROM ({spikes('1 MINUTE')}) WHERE window_end <= {CLOSED}")
def stream_error_spike(t):
    return J.run_available(J.error_spikes(logs(t)), "error-spikes")


ALERT_COLUMNS = "alert_from:t alert_to:t merchant_id:i error_count:i"
ALERTS = f"""SELECT window_end - INTERVAL 24 HOUR AS alert_from, window_end AS alert_to, merchant_id,
    error_count + before AS error_count
  FROM (SELECT *, lag(window_end) OVER w AS last_end, lag(error_count) OVER w AS before FROM ({spikes('12 HOUR')})
    WINDOW w AS (PARTITION BY merchant_id ORDER BY window_end))
  WHERE last_end = window_end - INTERVAL 12 HOUR"""


@query("consecutive_breaches", ALERT_COLUMNS, ALERTS)
def consecutive_breaches(t):
    """Half-day windows: events of one merchant are hours apart here."""
    return J.two_window_alerts(t.api_logs(), "12 hours", "24 hours")


@query("stream_alert_2_windows", ALERT_COLUMNS, f"SELECT * FROM ({ALERTS}) WHERE alert_to <= {CLOSED}")
def stream_alert(t):
    return J.run_available(J.two_window_alerts(logs(t), "12 hours", "24 hours"), "alerts")


@query("stream_dedup", "event_id:i ts:t user_id:i event_type:s", "SELECT * FROM events")
def stream_dedup(t):
    """The same events delivered twice."""
    return J.run_available(J.deduplicated(arriving(t).unionByName(arriving(t))), "dedup")


@query("stream_velocity", "window_start:t window_end:t customer_id:i payments:i amount_minor:i",
       f"""SELECT start AS window_start, start + INTERVAL 1 HOUR AS window_end, customer_id, count(*) AS payments,
            sum(amount_minor) AS amount_minor
          FROM (SELECT *, {bucketed('5 MINUTE')} - k * INTERVAL 5 MINUTE AS start FROM x_payments, range(12) AS r(k))
          GROUP BY 1, 2, 3 HAVING start + INTERVAL 1 HOUR <= {CLOSED}""")
def stream_velocity(t):
    return J.run_velocity(payments(t), "velocity")


@query("stream_failed_burst", "window_end:t customer_id:i failures:i first_at:t last_at:t",
       f"""SELECT start + INTERVAL 12 HOUR AS window_end, customer_id, count(*) AS failures, min(ts) AS first_at, max(ts) AS last_at
          FROM (SELECT *, {bucketed('6 HOUR')} - k * INTERVAL 6 HOUR AS start FROM x_payments, range(2) AS r(k)
            WHERE status = 'FAILED')
          GROUP BY start, customer_id HAVING count(*) > 1 AND start + INTERVAL 12 HOUR <= {CLOSED}""")
def stream_failed_burst(t):
    return J.run_available(J.failed_bursts(payments(t), "12 hours", "6 hours", more_than=1), "bursts")


@query("stream_sessionize", "user_id:i session_start:t last_activity:t actions_count:i duration_seconds:i",
       f"SELECT * FROM x_sessions WHERE last_activity + INTERVAL 6 HOUR <= {CLOSED}")
def stream_sessionize(t):
    return J.run_available(J.sessions(events(t), "6 hours"), "sessions")


part("x_rule_score", """SELECT p.*, coalesce(d.disputes, 0) AS disputes, 0.01 + 0.15 * CAST(card_country <> ip_country AS INT)
    + 0.20 * CAST(ip_country <> billing_country AS INT) + 0.15 * CAST(split_part(email, '@', 2) = 'tempmail.com' AS INT)
    + 0.40 * CAST(coalesce(d.disputes, 0) > 2 AS INT) AS score
  FROM x_payments p LEFT JOIN (SELECT q.payment_id, count(*) AS disputes FROM x_payments q
    JOIN x_disputed e ON e.customer_id = q.customer_id AND e.opened_at < q.ts GROUP BY 1) d USING (payment_id)""")


@query("stream_score_decide", "payment_id:i fraud_score:r risk_level:s decision:s",
       """SELECT payment_id, score AS fraud_score,
            CASE WHEN score >= 0.95 THEN 'critical' WHEN score >= 0.7 THEN 'high' WHEN score >= 0.4 THEN 'medium' ELSE 'low' END
              AS risk_level,
            CASE WHEN score >= 0.95 THEN 'decline' WHEN score >= 0.7 THEN 'review' WHEN score >= 0.4 THEN 'monitor' ELSE 'approve' END
              AS decision FROM x_rule_score""")
def stream_score_decide(t):
    owners = t.payments().select("payment_id", "customer_id")
    disputes = N.many_disputed(t.disputes().join(owners, "payment_id").select("customer_id", "opened_at"))
    return J.run_available(J.scored(payments(t), disputes, N.rule_score(), N.decide), "decisions")


@query("stream_cdc_apply", "payment_id:i status:s amount:d", "SELECT * FROM x_net")
def stream_cdc_apply(t):
    """The change log as a feed of files, in log order."""
    feed, store = scratch(t.spark, "feed"), ChangeStore(t.spark, scratch(t.spark, "applied"), "payment_id", buckets=8)
    log = t.change_log()
    log.repartitionByRange(6, "lsn").write.parquet(feed)
    J.run_each_batch(J.file_stream(t.spark, feed, log.schema, files_per_batch=2), "cdc-apply", store.handler(fold_every=2))
    return store.read()


@query("stream_join_payment_logs", "payment_id:i merchant_id:i paid_at:t log_id:i logged_at:t status_code:i",
       """SELECT p.payment_id, l.merchant_id, p.ts AS paid_at, l.log_id, l.ts AS logged_at, l.status_code
          FROM x_payments p JOIN x_logs l ON l.merchant_id = p.customer_id
            AND l.ts BETWEEN p.ts - INTERVAL 60 SECOND AND p.ts + INTERVAL 60 SECOND
            AND contains(l.request_body, 'pi_' || p.payment_id)""")
def stream_join_payment_logs(t):
    paid = payments(t).select("payment_id", F.concat(F.lit("pi_"), "payment_id").alias("payment_ref"),
                              F.col("customer_id").alias("merchant_id"), F.col("ts").alias("paid_at"))
    shapes = id_shapes(D.payment_refs(t), "payment_ref")
    said = payment_mentions(logs(t), *shapes).select("merchant_id", "payment_ref", "log_id", F.col("ts").alias("logged_at"), "status_code")
    return J.run_joined_logs(paid, said, "payment-logs")


@query("stream_throughput", "input_rows:i malformed:i",
       "SELECT count(*) AS input_rows, count(*) FILTER (NOT json_valid(props)) AS malformed FROM events")
def stream_throughput(t):
    path = scratch(t.spark, "throughput")
    J.run_each_batch(J.conversion(events(t), "props", "k BIGINT"), "throughput", J.count_batches(f"{path}/counts"), path)
    return J.throughput(t.spark, f"{path}/counts").agg(F.sum("input_rows").alias("input_rows"), F.sum("malformed").alias("malformed"))


# -- keyed state ------------------------------------------------------------------------------
def stateful(t, df, name):
    with K.state_store(t.spark):
        return J.run_available(df, name)


@query("stream_velocity_24h", "payment_id:i customer_id:i count_1h:i amount_minor_1h:i count_24h:i amount_minor_24h:i",
       f"""SELECT payment_id, customer_id, count(*) OVER h1 AS count_1h, coalesce(sum(amount_minor) OVER h1, 0) AS amount_minor_1h,
            count(*) OVER h24 AS count_24h, coalesce(sum(amount_minor) OVER h24, 0) AS amount_minor_24h FROM x_payments
          WINDOW h1 AS {back('INTERVAL 1 HOUR')}, h24 AS {back('INTERVAL 24 HOUR')} QUALIFY ts <= {CLOSED}""")
def stream_velocity_24h(t):
    """Exact counts and amounts before each payment, from keyed state."""
    sums = K.look_back_sums(payments(t), "customer_id", "payment_id", ["amount_minor"], {"1h": M.HOUR, "24h": M.DAY})
    return stateful(t, sums, "velocity-24h").withColumnsRenamed({"n_1h": "count_1h", "n_24h": "count_24h"})


def page_events(t):
    return events(t).withColumn("page", F.concat(F.lit("/"), "event_type")).withColumn(
        "device_type", F.expr("CASE user_id % 3 WHEN 0 THEN 'mobile' WHEN 1 THEN 'desktop' ELSE 'tablet' END"))


@query("stream_session_documents",
       "user_id:i session_start:t last_activity:t actions_count:i duration_seconds:i device_type:s events:s",
       f"""SELECT s.*, e.events FROM x_sessions s JOIN (SELECT user_id, session_no,
            string_agg(strftime(ts, '%H:%M:%S.%f') || event_type || page, ' ' ORDER BY ts, event_type, page) AS events FROM x_numbered GROUP BY 1, 2) e
          USING (user_id, session_no) WHERE last_activity + INTERVAL {D.GAP} SECOND <= {CLOSED}""")
def stream_session_documents(t):
    """Sessions closed by timer, in parts of five events that are put together again."""
    parts = stateful(t, K.session_documents(page_events(t), gap=D.GAP, chunk=5), "session-documents")
    told = F.transform("events", lambda e: F.concat(F.date_format(e["timestamp"], "HH:mm:ss.SSSSSS"), e["event_type"], e["page"]))
    texts = parts.groupBy("session_id").agg(F.array_sort(F.collect_list(F.struct("chunk", F.array_join(told, " ").alias("t")))).alias("all"))
    return parts.filter("closed").drop("events").join(
        texts.select("session_id", F.array_join(F.transform("all", lambda x: x["t"]), " ").alias("events")), "session_id")


@query("stream_page_views", "user_id:i session_start:t page:s count:i total_time_seconds:i",
       f"""SELECT s.user_id, s.session_start, p.* FROM x_sessions s JOIN (SELECT user_id, session_no, page, count(*) AS count,
            CAST(sum(stay) AS BIGINT) AS total_time_seconds FROM x_numbered GROUP BY 1, 2, 3) p USING (user_id, session_no)
          WHERE last_activity + INTERVAL {D.GAP} SECOND <= {CLOSED}""")
def stream_page_views(t):
    return K.whole_sessions(stateful(t, K.session_documents(page_events(t), gap=D.GAP, chunk=5), "page-views"))


LIVE_COLUMNS = "payment_id:i " + " ".join(f"{f}:r" for f in L.LIVE)


@query("stream_live_features", LIVE_COLUMNS, f"SELECT * FROM x_vector WHERE ts <= {CLOSED}")
def stream_live_features(t):
    return stateful(t, L.live_features(payments(t), RULES), "live-features")


LIVE_REASONS = ", ".join(f"CASE WHEN {rule} THEN {quoted(text)} END" for rule, text in N.REASONS if rule.split()[0] in L.LIVE)


@query("stream_score_model", "payment_id:i reasons:s same_score:b same_decision:b model_version:i",
       f"""SELECT payment_id, array_to_string(CASE WHEN len(r) = 0 THEN ['{N.NO_REASON}'] ELSE r[1:5] END, '; ') AS reasons,
            TRUE AS same_score, TRUE AS same_decision, 2 AS model_version
          FROM (SELECT payment_id, [x FOR x IN [{LIVE_REASONS}] IF x IS NOT NULL] AS r FROM x_vector WHERE ts <= {CLOSED})""")
def stream_score_model(t):
    """The second of two published models scores the stream; its scores and decisions next to those of the batch."""
    rows = training_rows(t)
    models_at, path = scratch(t.spark, "models"), scratch(t.spark, "scored")
    T.publish(T.train(rows, L.LIVE, params={**SMALL, "maxIter": 1}), models_at)
    model = T.train(rows, L.LIVE, params=SMALL)
    T.publish(model, models_at)
    with K.state_store(t.spark):
        J.run_each_batch(L.live_features(payments(t), RULES), "score-model", L.score_batches(models_at, f"{path}/rows"), path)
    streamed = t.spark.read.option("basePath", f"{path}/rows").parquet(f"{path}/rows")
    batch = N.decide(T.score(model, rows, L.LIVE, ["payment_id"]).withColumn("batch_score", F.col("fraud_score"))).select(
        "payment_id", "batch_score", F.col("decision").alias("batch_decision"))
    return streamed.join(batch, "payment_id", "left").select(
        "payment_id", F.array_join("reasons", "; ").alias("reasons"), (F.abs(F.col("exact_score") - F.col("batch_score")) < 1e-9).alias("same_score"),
        (F.col("decision") == F.col("batch_decision")).alias("same_decision"), "model_version")
