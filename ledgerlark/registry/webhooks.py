"""Webhook queue and its checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlark.functions import expr as X
from ledgerlark.operators import warehouse as L
from ledgerlark.operators import webhooks as W
from ledgerlark.registry import query
from ledgerlark.registry.fixture_sql import part
from ledgerlark.sources.driver_tables import AS_OF_EVENTS as NOW

AT = f"TIMESTAMP '{NOW}'"
part("x_due", f"""SELECT * FROM x_webhooks WHERE status = 'pending'
  OR (status = 'failed' AND retry_count < 5 AND next_retry_at <= {AT})""")


@query("webhook_due", "webhook_id:i merchant_id:i status:s retry_count:i next_retry_at:t", "SELECT * FROM x_due")
def webhook_due(t):
    return W.due(t.webhooks(), NOW)


@query("webhook_apply_results", "webhook_id:i status:s retry_count:i delivered_at:t next_retry_at:t",
       f"""SELECT w.webhook_id,
            CASE WHEN d.webhook_id IS NULL THEN w.status WHEN w.event_type <> 'charge.error' THEN 'sent'
                 WHEN w.retry_count >= 5 THEN 'cancelled' ELSE 'failed' END AS status,
            CASE WHEN d.webhook_id IS NOT NULL AND w.event_type = 'charge.error' AND w.retry_count < 5 THEN w.retry_count + 1
                 ELSE w.retry_count END AS retry_count,
            CASE WHEN d.webhook_id IS NOT NULL AND w.event_type <> 'charge.error' THEN {AT} ELSE w.delivered_at END AS delivered_at,
            CASE WHEN d.webhook_id IS NULL THEN w.next_retry_at
                 WHEN w.event_type = 'charge.error' AND w.retry_count < 5
                   THEN {AT} + CAST(60 * power(2, w.retry_count) AS INT) * INTERVAL '1' SECOND END AS next_retry_at
          FROM x_webhooks w LEFT JOIN x_due d USING (webhook_id)""")
def webhook_apply_results(t):
    """Every due webhook was tried; error events answered 500."""
    results = W.due(t.webhooks(), NOW).select(
        "webhook_id", F.when(F.col("event_type") == "charge.error", 500).otherwise(200).alias("response_code"),
        X.ts(NOW).alias("finished_at"))
    return W.apply_results(t.webhooks(), results)


@query("webhook_backoff", "webhook_id:i retry_count:i delay_seconds:i",
       """SELECT webhook_id, retry_count, CASE retry_count WHEN 0 THEN 60 WHEN 1 THEN 120 WHEN 2 THEN 240 WHEN 3 THEN 480
            WHEN 4 THEN 960 END AS delay_seconds FROM x_webhooks""")
def webhook_backoff(t):
    return W.schedule(t.webhooks())


@query("webhook_health", "merchant_id:i total:i sent_count:i failed_count:i success_rate:r action:s",
       """SELECT *, CASE WHEN failed_count > 14 THEN 'disable' WHEN success_rate < 62 THEN 'notify' ELSE 'none' END AS action
          FROM (SELECT merchant_id, count(*) AS total, count(*) FILTER (status = 'sent') AS sent_count,
            count(*) FILTER (status = 'failed') AS failed_count,
            CAST(count(*) FILTER (status = 'sent') AS DOUBLE) / count(*) * 100 AS success_rate FROM x_webhooks GROUP BY 1)""")
def webhook_health(t):
    return W.health(t.webhooks(), notify_below=62, disable_above=14)


@query("webhook_dashboard", "total_webhooks:i success_rate:r avg_delivery_ms:r in_retry:i exhausted:i",
       """SELECT count(*) AS total_webhooks, CAST(count(*) FILTER (status = 'sent') AS DOUBLE) / count(*) * 100 AS success_rate,
            CAST(sum(epoch_ms(delivered_at) - epoch_ms(created_at)) AS DOUBLE) / count(*) FILTER (status = 'sent')
              AS avg_delivery_ms,
            count(*) FILTER (status = 'failed' AND retry_count < 5) AS in_retry,
            count(*) FILTER (status = 'failed' AND retry_count >= 5) AS exhausted FROM x_webhooks""")
def webhook_dashboard(t):
    return W.dashboard(t.webhooks())


@query("emit_events", "event_id:s payment_id:i event_type:s status:s retry_count:i",
       """SELECT 'evt_' || lsn AS event_id, payment_id,
            CASE status WHEN 'SUCCEEDED' THEN 'charge.succeeded' ELSE 'charge.pending' END AS event_type, 'pending' AS status,
            0 AS retry_count FROM x_net WHERE change_type <> 'DELETE'""")
def emit_events(t):
    return L.status_events(L.net_changes(t.change_log(), "payment_id"), "payment_id")
