"""Privacy operators and their checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlark.operators import privacy as P
from ledgerlark.operators import quality as Q
from ledgerlark.registry import query
from ledgerlark.registry.fixture_sql import part

LATER = "2007-06-01 00:00:00"
AT = f"TIMESTAMP '{LATER}'"


def requests(t, segment):
    """Customers of one market segment asked."""
    return t.customers().filter(F.col("customer_segment") == segment).select("customer_id")


@query("subject_export",
       "data_type:s customer_id:i record_id:i detail_1:s detail_2:s detail_3:s created_at:t",
       """WITH r AS (SELECT customer_id FROM x_customers WHERE customer_segment = 'BUILDING')
          SELECT 'Customer' AS data_type, customer_id, customer_id AS record_id, email AS detail_1,
            CAST(nationkey AS VARCHAR) AS detail_2, customer_segment AS detail_3, created_at FROM x_customers JOIN r USING (customer_id)
          UNION ALL SELECT 'Payments', customer_id, transaction_id, CAST(amount AS VARCHAR), currency, status, created_at
            FROM x_transactions JOIN r USING (customer_id)
          UNION ALL SELECT 'Subscriptions', customer_id, subscription_id, plan_name, status, CAST(current_period_end AS VARCHAR),
            created_at FROM x_subscriptions JOIN r USING (customer_id)""")
def subject_export(t):
    return P.subject_export(requests(t, "BUILDING"), t.customers(), t.transactions(), t.subscriptions())


@query("portability_json",
       "customer_id:i payment_count:i subscription_count:i email:s first_payment:i last_status:s exported_at:s",
       f"""SELECT c.customer_id, coalesce(n, 0) AS payment_count, coalesce(s.k, 0) AS subscription_count, c.email,
            p.first AS first_payment, p.last AS last_status, '2007-06-01T00:00:00Z' AS exported_at
          FROM x_customers c LEFT JOIN (SELECT customer_id, count(*) AS n, min(transaction_id) AS first,
              lower(arg_min(status, transaction_id)) AS last FROM x_transactions GROUP BY 1) p USING (customer_id)
          LEFT JOIN (SELECT customer_id, count(*) AS k FROM x_subscriptions GROUP BY 1) s USING (customer_id)""")
def portability_json(t):
    docs = P.portability_json(t.customers(), t.customers(), t.transactions(), t.subscriptions(), LATER, "Example Payments")
    return docs.select(
        "customer_id", "payment_count", "subscription_count",
        F.get_json_object("document", "$.customer.email").alias("email"),
        F.get_json_object("document", "$.payments[0].id").alias("first_payment"),
        F.get_json_object("document", "$.payments[0].status").alias("last_status"),
        F.get_json_object("document", "$.export_metadata.exported_at").alias("exported_at"))


part("x_erasure", f"""SELECT customer_id, CASE WHEN recent THEN 'Rejected' ELSE 'Completed' END AS status
  FROM (SELECT c.customer_id, coalesce(bool_or(t.created_at > {AT} - INTERVAL 7 YEAR), FALSE) AS recent
    FROM x_customers c LEFT JOIN x_transactions t USING (customer_id) WHERE c.customer_segment = 'MACHINERY' GROUP BY 1)""")


def decisions(t):
    return P.erasure_decisions(requests(t, "MACHINERY"), t.transactions(), LATER)


@query("erasure", "customer_id:i status:s reason:s processed_at:t",
       f"""SELECT *, CASE status WHEN 'Rejected' THEN 'Legal obligation: tax retention 7 years' END AS reason,
            {AT} AS processed_at FROM x_erasure""")
def erasure(t):
    return decisions(t)


@query("erasure_remaining", "table_name:s row_count:i",
       """WITH g AS (SELECT customer_id FROM x_erasure WHERE status = 'Completed'),
            gp AS (SELECT transaction_id FROM x_transactions JOIN g USING (customer_id))
          SELECT 'customers' AS table_name, count(*) AS row_count FROM x_customers WHERE customer_id NOT IN (FROM g)
          UNION ALL SELECT 'transactions', count(*) FROM x_transactions WHERE customer_id NOT IN (FROM g)
          UNION ALL SELECT 'subscriptions', count(*) FROM x_subscriptions WHERE customer_id NOT IN (FROM g)
          UNION ALL SELECT 'refunds', count(*) FROM x_refunds WHERE transaction_id NOT IN (FROM gp)""")
def erasure_remaining(t):
    left = P.erase(decisions(t), {
        "customers": (t.customers(), "customer_id"), "transactions": (t.transactions(), "customer_id"),
        "subscriptions": (t.subscriptions(), "customer_id"), "refunds": (t.refunds(), "customer_id")}, by_payment=["refunds"])
    return Q.union_results(*[
        df.agg(F.lit(name).alias("table_name"), F.count("*").alias("row_count")) for name, df in left.items()])


EARLY = "2003-06-01 00:00:00"
EARLY_AT = f"TIMESTAMP '{EARLY}'"


@query("retention_purge", "transaction_id:i created_at:t",
       f"SELECT * FROM x_transactions WHERE created_at >= {EARLY_AT} - INTERVAL 8 YEAR")
def retention_purge(t):
    return P.purge_payments(t.transactions(), EARLY)


@query("anonymise_old", "transaction_id:i customer_id:i last4:s billing_address:s",
       f"""SELECT transaction_id, CASE WHEN NOT old THEN customer_id END AS customer_id,
            CASE WHEN old THEN 'XXXX' ELSE right(payment_intent_id, 4) END AS last4,
            CASE WHEN old THEN 'REDACTED' ELSE 'nation ' || nationkey END AS billing_address
          FROM (SELECT *, created_at < {EARLY_AT} - INTERVAL 7 YEAR AND created_at >= {EARLY_AT} - INTERVAL 8 YEAR AS old
            FROM x_transactions)""")
def anonymise_old(t):
    rows = t.transactions().withColumns({"last4": F.right("payment_intent_id", F.lit(4)),
                                         "billing_address": F.concat(F.lit("nation "), "nationkey")})
    return P.anonymise_old(rows, EARLY)


part("x_activity", """SELECT c.customer_id, NOT c.is_deleted AND c.risk_score < 60 AS is_active, max(t.created_at) AS last_login_at,
    max(t.created_at) AS updated_at, max(t.created_at) + INTERVAL 400 DAY AS notified_at
  FROM x_customers c LEFT JOIN x_transactions t USING (customer_id) GROUP BY ALL""")


def activity(t):
    """Customers with the time of their last payment as last login."""
    last = t.transactions().groupBy("customer_id").agg(F.max("created_at").alias("last_login_at"))
    return t.customers().select("customer_id", (~F.col("is_deleted") & (F.col("risk_score") < 60)).alias("is_active")).join(
        last, "customer_id", "left").withColumns({
            "updated_at": F.col("last_login_at"), "notified_at": F.col("last_login_at") + F.expr("INTERVAL 400 DAYS")})


@query("retention_purge_customers", "customer_id:i is_active:b last_login_at:t",
       f"""SELECT * FROM x_activity WHERE NOT coalesce(NOT is_active AND last_login_at < {EARLY_AT} - INTERVAL 3 YEAR
            AND notified_at < {EARLY_AT} - INTERVAL 30 DAY, FALSE)""")
def retention_purge_customers(t):
    return P.purge_customers(activity(t), EARLY)


@query("mark_inactive", "customer_id:i is_active:b",
       f"""SELECT customer_id, is_active AND NOT coalesce(last_login_at < {EARLY_AT} - INTERVAL 2 YEAR, FALSE) AS is_active
          FROM x_activity""")
def mark_inactive(t):
    return P.mark_inactive(activity(t), EARLY)


@query("stale_notifications", "customer_id:i type:s message:s",
       f"""SELECT customer_id, 'DataUpdate' AS type, 'Please verify your account information' AS message FROM x_activity
          WHERE updated_at < {EARLY_AT} - INTERVAL 24 MONTH""")
def stale_notifications(t):
    return P.stale_notifications(activity(t), EARLY, months=24)


@query("mask_columns", "customer_id:i email:s full_name:s nationkey:s",
       """SELECT customer_id, substr(email, 1, 1) || 'XXX@XXXX.com' AS email, '****' || right(full_name, 4) AS full_name,
            'REDACTED' AS nationkey FROM x_customers""")
def mask_columns(t):
    masked = P.mask_columns(t.customers(), {"email": "email", "full_name": "last4", "customer_segment": "drop"})
    return masked.withColumn("nationkey", F.when(F.col("nationkey").isNotNull(), "REDACTED"))


@query("classify_columns", "table_name:s total:i column_name:s kind:s level:s hits:i protection:s",
       "SELECT *, CASE level WHEN 'P0' THEN 'tokenise' ELSE 'encrypt and mask' END AS protection FROM ("
       + " UNION ALL ".join(
           f"SELECT '{table}' AS table_name, count(*) AS total, '{c}' AS column_name, '{kind}' AS kind, '{level}' AS level, "
           f"count(*) FILTER (regexp_matches({c}, '{pattern}')) AS hits FROM {source}"
           for table, source, columns in (("customers", "x_customers", ("full_name", "email", "customer_segment")),
                                          ("documents", "documents", ("text", "lang", "source")))
           for c in columns for kind, level, pattern in P.DETECTORS) + ") WHERE hits > 0")
def classify_columns(t):
    return P.classify_columns(t.customers(), "customers").unionByName(P.classify_columns(t.raw("documents"), "documents"))


@query("pseudonymise", "customer_id:s full_name:s nationkey:i",
       "SELECT sha256(customer_id || 's1') AS customer_id, sha256(full_name || 's1') AS full_name, nationkey FROM x_customers")
def pseudonymise(t):
    return P.pseudonymise(t.customers(), ["customer_id", "full_name"], "s1")


part("x_incidents", """SELECT merchant_id AS incident_id, CAST(sum(latency_ms) AS BIGINT) AS records, max(latency_ms) > 20000 AS has_pii,
    max(latency_ms) > 32000 AS has_payment_data FROM x_logs WHERE status_code >= 500 GROUP BY 1""")


@query("breach_severity", "incident_id:i records:i has_pii:b has_payment_data:b severity:s",
       """SELECT *, CASE WHEN records > 10000 OR has_payment_data THEN 'High' WHEN records >= 100 OR has_pii THEN 'Medium'
            ELSE 'Low' END AS severity FROM x_incidents""")
def breach_severity(t):
    """One incident per merchant with server errors; the latencies stand for exposed records."""
    failed = t.api_logs().filter("status_code >= 500")
    incidents = failed.groupBy(F.col("merchant_id").alias("incident_id")).agg(
        F.sum("latency_ms").alias("records"), (F.max("latency_ms") > 20000).alias("has_pii"),
        (F.max("latency_ms") > 32000).alias("has_payment_data"))
    return P.breach_severity(incidents)


@query("breach_subjects", "customer_id:i email:s",
       "SELECT customer_id, email FROM x_customers WHERE customer_id IN (SELECT incident_id FROM x_incidents)")
def breach_subjects(t):
    failed = t.api_logs().filter("status_code >= 500").select(F.col("merchant_id").alias("customer_id"))
    return P.affected_subjects(failed, t.customers())


@query("request_sla", "request_type:s requests:i avg_days:r max_days:i late:i",
       """SELECT o_orderpriority AS request_type, count(*) AS requests, CAST(sum(d) AS DOUBLE) / count(*) AS avg_days,
            max(d) AS max_days, count(*) FILTER (d > 30) AS late
          FROM (SELECT *, CASE WHEN o_orderstatus = 'P' THEN date_diff('day', o_orderdate, TIMESTAMP '2001-08-02')
            ELSE o_custkey % 45 END AS d FROM orders) GROUP BY 1""")
def request_sla(t):
    log = t.raw("orders").selectExpr(
        "o_orderpriority AS request_type", "CAST(o_orderdate AS TIMESTAMP) AS requested_at",
        "CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS TIMESTAMP) + (o_custkey % 45) * INTERVAL '1' DAY END AS processed_at")
    return P.request_sla(log, "2001-08-02 00:00:00")


def access(t):
    return t.events().selectExpr(
        "event_id AS access_id", "user_id AS principal", "ts", "CASE event_type WHEN 'purchase' THEN 'export' ELSE 'read' END AS action",
        "CAST(round(value * 100) AS BIGINT) AS row_count", "event_type = 'view' AS has_pii")


@query("bulk_access", "access_id:i principal:i ts:t action:s row_count:i findings:s",
       """SELECT * FROM (SELECT *, array_to_string([x FOR x IN [CASE WHEN action = 'export' AND row_count > 10000 THEN 'bulk export' END,
            CASE WHEN has_pii AND row_count > 1000 THEN 'bulk personal data' END,
            CASE WHEN hour(ts) < 8 OR hour(ts) > 17 THEN 'after hours' END] IF x IS NOT NULL], ', ') AS findings
          FROM (SELECT event_id AS access_id, user_id AS principal, ts, CASE event_type WHEN 'purchase' THEN 'export' ELSE 'read' END AS action,
            CAST(round(value * 100) AS BIGINT) AS row_count, event_type = 'view' AS has_pii FROM events))
          WHERE findings <> ''""")
def bulk_access(t):
    return P.bulk_access(access(t))


@query("geo_jump", "payment_id:i customer_id:i seen_at:t country:s previous_country:s previous_seen_at:t",
       """SELECT * FROM (SELECT payment_id, customer_id, ts AS seen_at, ip_country AS country,
            lag(ip_country) OVER w AS previous_country, lag(ts) OVER w AS previous_seen_at FROM x_payments
            WINDOW w AS (PARTITION BY customer_id ORDER BY ts, payment_id))
          WHERE country <> previous_country AND seen_at - previous_seen_at <= INTERVAL 1 HOUR""")
def geo_jump(t):
    return P.geo_jump(t.payments(), "customer_id", "ts", "ip_country", "payment_id")


CONSENT = "CASE WHEN c_acctbal > 5000 THEN 1 WHEN c_acctbal > 0 THEN 0 ELSE 2 END"


def consent(t):
    return t.raw("customer").selectExpr("c_custkey AS customer_id", f"{CONSENT} AS marketing_consent")


@query("consent_check", "rule:s table_name:s failed:i total:i passed:b",
       f"""SELECT 'consent is 0 or 1' AS rule, 'customers' AS table_name, count(*) FILTER ({CONSENT} NOT IN (0, 1)) AS failed,
            count(*) AS total, count(*) FILTER ({CONSENT} NOT IN (0, 1)) = 0 AS passed FROM customer""")
def consent_check(t):
    return Q.check_rules(consent(t), "customers", {"consent is 0 or 1": "marketing_consent IN (0, 1)"})


@query("consented_customers", "customer_id:i", f"SELECT c_custkey AS customer_id FROM customer WHERE {CONSENT} = 1")
def consented_customers(t):
    return P.consented(consent(t))
