"""Document reports and their checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlark.functions import expr as X
from ledgerlark.operators import sessions as S
from ledgerlark.plans import documents as D
from ledgerlark.registry import query
from ledgerlark.registry.features import document_store
from ledgerlark.registry.fixture_sql import part
from ledgerlark.sources.driver_tables import AS_OF_EVENTS as NOW

AT = f"TIMESTAMP '{NOW}'"
GAP = 6 * 3600

part("x_numbered", f"""SELECT *, sum(CASE WHEN prev IS NULL OR ts > prev + INTERVAL {GAP} SECOND THEN 1 ELSE 0 END)
      OVER (PARTITION BY user_id ORDER BY ts) AS session_no,
    CASE WHEN next <= ts + INTERVAL {GAP} SECOND THEN floor((epoch_us(next) - epoch_us(ts)) / 1000000) ELSE 0 END AS stay
  FROM (SELECT *, '/' || event_type AS page, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS prev,
    lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS next FROM events)""")
part("x_sessions", f"""SELECT *, date_diff('second', date_trunc('second', session_start), date_trunc('second', last_activity))
      AS duration_seconds, 'sess_' || user_id || '_' || session_no AS session_id,
    CASE WHEN last_activity + INTERVAL {GAP} SECOND <= {AT} THEN last_activity END AS session_end
  FROM (SELECT user_id, CAST(session_no AS BIGINT) AS session_no, min(ts) AS session_start, max(ts) AS last_activity,
    count(*) AS actions_count, CASE user_id % 3 WHEN 0 THEN 'mobile' WHEN 1 THEN 'desktop' ELSE 'tablet' END AS device_type
    FROM x_numbered GROUP BY 1, 2, 6)""")


def sessions(t):
    events = t.events().withColumn("page", F.concat(F.lit("/"), "event_type")).withColumn(
        "device_type", F.expr("CASE user_id % 3 WHEN 0 THEN 'mobile' WHEN 1 THEN 'desktop' ELSE 'tablet' END"))
    return S.session_documents(events, NOW, gap=GAP)


@query("doc_api_logs_recent", "log_id:i merchant_id:i ts:t endpoint:s status_code:i latency_ms:i",
       f"SELECT * FROM x_logs WHERE ts >= {AT} - INTERVAL 24 HOUR")
def api_logs_recent(t):
    return D.logs_recent(t.api_logs(), NOW)


@query("doc_api_errors_by_endpoint", "merchant_id:i endpoint:s error_count:i avg_latency:r max_latency:i",
       f"""SELECT merchant_id, endpoint, count(*) AS error_count, CAST(sum(latency_ms) AS DOUBLE) / count(*) AS avg_latency,
            max(latency_ms) AS max_latency
          FROM x_logs WHERE status_code >= 500 AND ts >= {AT} - INTERVAL 7 DAY GROUP BY 1, 2""")
def api_errors_by_endpoint(t):
    return D.errors_by_endpoint(t.api_logs(), NOW)


@query("doc_slowest_calls", "log_id:i merchant_id:i ts:t endpoint:s latency_ms:i",
       f"""SELECT * FROM x_logs WHERE ts >= {AT} - INTERVAL 720 HOUR ORDER BY latency_ms DESC, log_id LIMIT 100""")
def slowest_calls(t):
    return D.slowest_calls(t.api_logs(), NOW, hours=720)


@query("doc_success_rate_hourly", "merchant_id:i hour:i total_requests:i success_count:i success_rate:r",
       f"""SELECT merchant_id, hour(ts) AS hour, count(*) AS total_requests,
            count(*) FILTER (status_code BETWEEN 200 AND 299) AS success_count,
            CAST(count(*) FILTER (status_code BETWEEN 200 AND 299) AS DOUBLE) / count(*) * 100 AS success_rate
          FROM x_logs WHERE ts >= {AT} - INTERVAL 720 HOUR GROUP BY 1, 2""")
def success_rate_hourly(t):
    return D.success_rate_hourly(t.api_logs(), NOW, hours=720)


@query("doc_active_sessions", "user_id:i session_id:s session_start:t last_activity:t device_type:s",
       "SELECT * FROM x_sessions WHERE session_end IS NULL")
def active_sessions(t):
    return D.active_sessions(sessions(t))


@query("doc_page_views",
       "user_id:i session_id:s session_start:t duration_seconds:i page:s count:i total_time_seconds:i",
       f"""SELECT s.*, p.page, p.count, p.total_time_seconds FROM x_sessions s
          JOIN (SELECT user_id, session_no, page, count(*) AS count, sum(stay) AS total_time_seconds FROM x_numbered
            GROUP BY 1, 2, 3) p USING (user_id, session_no)
          WHERE session_start >= {AT} - INTERVAL 30 DAY""")
def page_views(t):
    return D.page_views(sessions(t), NOW)


@query("doc_suspicious_sessions",
       "user_id:i session_id:s session_start:t duration_seconds:i actions_count:i device_type:s",
       f"""SELECT * FROM x_sessions WHERE session_start >= {AT} - INTERVAL 30 DAY
            AND (duration_seconds < 10 AND actions_count > 50 OR duration_seconds > 28800)""")
def suspicious_sessions(t):
    return D.suspicious_sessions(sessions(t), NOW, days=30)


@query("doc_engagement_by_device", "device_type:s session_count:i avg_duration:r avg_actions:r total_time:i",
       f"""SELECT device_type, count(*) AS session_count, CAST(sum(duration_seconds) AS DOUBLE) / count(*) AS avg_duration,
            CAST(sum(actions_count) AS DOUBLE) / count(*) AS avg_actions, sum(duration_seconds) AS total_time
          FROM x_sessions WHERE session_end IS NOT NULL AND session_start >= {AT} - INTERVAL 90 DAY GROUP BY 1""")
def engagement_by_device(t):
    return D.engagement_by_device(sessions(t), NOW)


@query("doc_features_by_payment", "payment_id:i customer_id:i fraud_score:r risk_level:s computed_at:t",
       "SELECT * FROM x_documents WHERE payment_id = (SELECT max(event_id) FROM events)")
def features_by_payment(t):
    """The newest payment's document."""
    newest = t.events().agg(F.max("event_id").alias("id")).scalar()
    return D.features_by_payment(document_store(t).get(newest), newest)


@query("doc_high_risk_payments",
       "payment_id:i merchant_id:i customer_id:i fraud_score:r risk_level:s computed_at:t transaction_velocity_1h:i "
       "card_country_mismatch:b ip_country_mismatch:b",
       f"""SELECT *, velocity_1h AS transaction_velocity_1h, card_mismatch AS card_country_mismatch,
            ip_mismatch AS ip_country_mismatch
          FROM x_documents WHERE fraud_score >= 0.5 AND computed_at >= {AT} - INTERVAL 720 HOUR""")
def high_risk_payments(t):
    return D.high_risk_payments(document_store(t).read(X.ago(NOW, 720, "HOUR")), NOW, hours=720, at_least=0.5)


@query("doc_fraud_patterns",
       "merchant_id:i risk_level:s payments:i avg_score:r avg_velocity_1h:r avg_velocity_24h:r card_mismatch_count:i "
       "ip_mismatch_count:i",
       f"""SELECT merchant_id, risk_level, count(*) AS payments, CAST(sum(CAST(fraud_score AS DECIMAL(9,4))) AS DOUBLE) / count(*) AS avg_score,
            CAST(sum(velocity_1h) AS DOUBLE) / count(*) AS avg_velocity_1h,
            CAST(sum(velocity_24h) AS DOUBLE) / count(*) AS avg_velocity_24h,
            count(*) FILTER (card_mismatch) AS card_mismatch_count, count(*) FILTER (ip_mismatch) AS ip_mismatch_count
          FROM x_documents WHERE computed_at >= {AT} - INTERVAL 7 DAY GROUP BY 1, 2""")
def fraud_patterns(t):
    return D.fraud_patterns(document_store(t).read(X.ago(NOW, 7, "DAY")), NOW)


@query("doc_dispute_customers", "customer_id:i disputes:i payment_count:i avg_fraud_score:r",
       f"""SELECT customer_id, customer_dispute_history AS disputes, count(*) AS payment_count,
            CAST(sum(CAST(fraud_score AS DECIMAL(9,4))) AS DOUBLE) / count(*) AS avg_fraud_score
          FROM x_documents WHERE customer_dispute_history > 0 AND computed_at >= {AT} - INTERVAL 90 DAY GROUP BY 1, 2""")
def dispute_customers(t):
    return D.customers_with_disputes(document_store(t).read(X.ago(NOW, 90, "DAY")), NOW)


@query("doc_webhooks_to_retry", "webhook_id:i merchant_id:i event_type:s retry_count:i next_retry_at:t",
       f"SELECT * FROM x_webhooks WHERE status = 'failed' AND retry_count < 5 AND next_retry_at <= {AT}")
def webhooks_to_retry(t):
    return D.webhooks_to_retry(t.webhooks(), NOW)


@query("doc_webhook_stats",
       "merchant_id:i event_type:s total_events:i sent_count:i failed_count:i success_rate:r avg_response_time:r "
       "avg_retry_count:r",
       f"""SELECT merchant_id, event_type, count(*) AS total_events, count(*) FILTER (status = 'sent') AS sent_count,
            count(*) FILTER (status = 'failed') AS failed_count,
            CAST(count(*) FILTER (status = 'sent') AS DOUBLE) / count(*) * 100 AS success_rate,
            CAST(sum(response_time_ms) AS DOUBLE) / count(*) AS avg_response_time,
            CAST(sum(retry_count) AS DOUBLE) / count(*) AS avg_retry_count
          FROM x_webhooks WHERE created_at >= {AT} - INTERVAL 7 DAY GROUP BY 1, 2""")
def webhook_stats(t):
    return D.webhook_stats(t.webhooks(), NOW)


@query("doc_slow_webhooks", "webhook_id:i merchant_id:i event_type:s response_time_ms:i created_at:t",
       f"""SELECT * FROM x_webhooks WHERE status = 'sent' AND response_time_ms > 5000
            AND created_at >= {AT} - INTERVAL 168 HOUR ORDER BY response_time_ms DESC, webhook_id LIMIT 50""")
def slow_webhooks(t):
    return D.slow_webhooks(t.webhooks(), NOW, hours=168)


@query("doc_delivery_time",
       "webhook_id:i merchant_id:i event_type:s created_at:t delivered_at:t delivery_time_seconds:i retry_count:i",
       f"""SELECT *, date_diff('second', created_at, delivered_at) AS delivery_time_seconds FROM x_webhooks
          WHERE status = 'sent' AND delivered_at IS NOT NULL AND created_at >= {AT} - INTERVAL 24 HOUR""")
def delivery_time(t):
    return D.delivery_time(t.webhooks(), NOW)


def payment_refs(t):
    return t.payments().select("payment_id", F.concat(F.lit("pi_"), "payment_id").alias("payment_ref"),
                               F.col("customer_id").alias("merchant_id"), F.col("ts").alias("paid_at"), "amount_minor")


@query("doc_audit_trail", "payment_id:i merchant_id:i paid_at:t log_id:i logged_at:t endpoint:s status_code:i latency_ms:i",
       """SELECT p.payment_id, l.merchant_id, p.ts AS paid_at, l.log_id, l.ts AS logged_at, l.endpoint, l.status_code,
            l.latency_ms
          FROM x_payments p JOIN x_logs l ON l.merchant_id = p.customer_id
            AND l.ts BETWEEN p.ts - INTERVAL 60 SECOND AND p.ts + INTERVAL 60 SECOND
            AND contains(l.request_body, 'pi_' || p.payment_id)""")
def audit_trail(t):
    return D.audit_trail(payment_refs(t), t.api_logs())
