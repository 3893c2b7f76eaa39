"""The payment model of ``sources.driver_tables`` written for the SQL check."""

from __future__ import annotations

import re

FIXTURES = {
    "x_merchants": """SELECT s_suppkey AS merchant_id, s_suppkey AS merchant_key, s_name AS business_name,
        'm' || s_suppkey || '@example.com' AS email, s_nationkey AS nationkey,
        CASE s_suppkey % 5 WHEN 0 THEN 'Electronics' WHEN 1 THEN 'Clothing' WHEN 2 THEN 'Food & Beverage'
             WHEN 3 THEN 'travel' ELSE 'gambling' END AS industry,
        CASE s_suppkey % 10 WHEN 3 THEN 'Leisure' WHEN 4 THEN 'Leisure' ELSE 'Retail' END AS industry_group,
        CASE WHEN s_acctbal < 3000 THEN 'STARTUP' WHEN s_acctbal < 7000 THEN 'SMB' ELSE 'ENTERPRISE' END AS merchant_tier,
        TIMESTAMP '1994-06-01 00:00:00' + (s_suppkey % 200) * INTERVAL '1' DAY AS created_at,
        s_acctbal < -800 AS is_deleted
      FROM supplier""",
    "x_customers": """SELECT c_custkey AS customer_id, c_custkey AS customer_key, c_name AS full_name,
        split_part(c_name, '#', 1) AS first_name, split_part(c_name, '#', 2) AS last_name, '+44 20 ' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS phone,
        'c' || c_custkey || CASE c_custkey % 4 WHEN 0 THEN '@gmail.com' WHEN 1 THEN '@tempmail.com'
             ELSE '@example.com' END AS email,
        c_nationkey AS nationkey, c_mktsegment AS customer_segment,
        CAST(c_custkey % 101 AS DECIMAL(5,2)) AS risk_score,
        TIMESTAMP '1994-01-01 00:00:00' + (c_custkey % 365) * INTERVAL '1' DAY AS created_at,
        c_acctbal < -900 AS is_deleted
      FROM customer""",
    "x_geography": """SELECT n_nationkey AS geography_key, n_name AS country_name, r_name AS region, r_name AS continent,
        CASE n_nationkey % 3 WHEN 0 THEN 'EUR' WHEN 1 THEN 'USD' ELSE 'GBP' END AS currency_code
      FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "x_methods": """SELECT p_partkey AS payment_method_id, p_partkey AS payment_method_key,
        CASE p_size % 3 WHEN 0 THEN 'CARD' WHEN 1 THEN 'SEPA' ELSE 'WALLET' END AS type,
        CASE WHEN p_size % 3 = 0 THEN p_brand END AS card_brand, p_size % 3 = 2 AS is_digital_wallet,
        CAST(1 + p_partkey % 12 AS INT) AS exp_month, CAST(2002 + p_partkey % 6 AS INT) AS exp_year,
        lpad(CAST(p_partkey % 10000 AS VARCHAR), 4, '0') AS last4, p_partkey // 3 AS customer_id,
        p_size > 25 AS is_default, p_retailprice >= 905 AS is_active,
        TIMESTAMP '2001-01-01 00:00:00' + (p_partkey % 200) * INTERVAL '1' DAY AS created_at
      FROM part""",
    "x_products": """SELECT * FROM (VALUES (1, 'Card payments', 'payments'), (2, 'Billing', 'subscriptions'))
        AS t(product_key, product_name, product_category)""",
    "x_transactions": """SELECT *, CAST(amount - processing_fee AS DECIMAL(18,2)) AS net_amount FROM (
      SELECT o_orderkey AS transaction_id, o_custkey AS customer_id,
        o_orderkey % (SELECT count(*) FROM supplier) AS merchant_id,
        (o_orderkey * 7 + o_custkey) % (SELECT count(*) FROM part) AS payment_method_id,
        CAST(o_totalprice AS DECIMAL(18,2)) AS amount,
        CASE o_custkey % 3 WHEN 0 THEN 'EUR' WHEN 1 THEN 'USD' ELSE 'GBP' END AS currency,
        CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '5-LOW' THEN 'REFUNDED' WHEN o_orderstatus = 'F' THEN 'SUCCEEDED'
             WHEN o_orderstatus = 'O' THEN 'FAILED' ELSE 'PENDING' END AS status,
        'pi_' || o_orderkey AS payment_intent_id, o_orderkey % 25 AS nationkey,
        CASE WHEN o_orderstatus = 'O' THEN CASE o_orderpriority WHEN '1-URGENT' THEN 'insufficient_funds'
             WHEN '2-HIGH' THEN 'card_declined' ELSE 'processing_error' END END AS failure_code,
        CASE WHEN o_orderstatus = 'O' THEN 'refused: ' || o_orderpriority END AS failure_message,
        o_orderdate + (o_orderkey % 86400) * INTERVAL '1' SECOND AS created_at,
        o_orderdate + (o_orderkey % 86400) * INTERVAL '1' SECOND + (o_orderkey % 997) * INTERVAL '1' MILLISECOND AS updated_at,
        CAST(round(CAST(o_totalprice AS DECIMAL(18,2)) * CAST(0.0290 AS DECIMAL(5,4)), 2) AS DECIMAL(18,2)) AS processing_fee,
        o_totalprice < 5000 AS is_deleted
      FROM orders)""",
    "x_checks": """SELECT o_orderkey AS transaction_id, CAST(o_orderkey * 13 % 101 AS DECIMAL(5,2)) AS risk_score,
        CASE WHEN o_orderkey * 13 % 101 >= 95 THEN 'CRITICAL' WHEN o_orderkey * 13 % 101 >= 70 THEN 'HIGH'
             WHEN o_orderkey * 13 % 101 >= 40 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level,
        o_orderkey * 13 % 101 >= 70 AS is_flagged,
        CASE WHEN o_orderkey * 13 % 101 >= 95 THEN 'BLOCKED' WHEN o_orderkey * 13 % 101 >= 70 THEN 'REVIEW'
             ELSE 'APPROVED' END AS action_taken,
        CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderdate END AS reviewed_at
      FROM orders WHERE o_orderpriority <> '4-NOT SPECIFIED'""",
    "x_chargebacks": """SELECT o_orderkey AS chargeback_id, o_orderkey AS transaction_id,
        CAST(o_totalprice AS DECIMAL(18,2)) AS amount,
        CASE o_orderkey % 3 WHEN 0 THEN 'OPEN' WHEN 1 THEN 'WON' ELSE 'LOST' END AS status,
        CASE o_orderkey % 2 WHEN 0 THEN 'fraudulent' ELSE 'product_not_received' END AS reason_code,
        o_orderdate + INTERVAL 30 DAY AS evidence_due_date, o_orderdate + INTERVAL 10 DAY AS created_at
      FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' AND o_totalprice > 300000""",
    "x_refunds": """SELECT o_orderkey AS refund_id, o_orderkey AS transaction_id,
        CAST(round(CAST(o_totalprice AS DECIMAL(18,2)) * CAST(CASE WHEN o_orderkey % 2 = 0 THEN 1.0 ELSE 0.5 END
             AS DECIMAL(3,1)), 2) AS DECIMAL(18,2)) AS amount,
        CASE o_orderkey % 3 WHEN 0 THEN 'REQUESTED_BY_CUSTOMER' WHEN 1 THEN 'FRAUDULENT' ELSE 'DUPLICATE' END AS reason,
        CASE WHEN o_totalprice > 400000 THEN 'PENDING' ELSE 'SUCCEEDED' END AS status,
        o_orderdate + INTERVAL 5 DAY + (o_orderkey % 1440) * INTERVAL '1' MINUTE AS created_at
      FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '5-LOW'""",
    "x_subscriptions": """SELECT c_custkey AS subscription_id, c_custkey % (SELECT count(*) FROM supplier) AS merchant_id,
        c_custkey AS customer_id, 'plan_' || lower(c_mktsegment) AS plan_name,
        CAST(5 + c_custkey % 95 AS DECIMAL(18,2)) AS amount,
        CASE WHEN c_acctbal < 0 THEN 'CANCELED' WHEN c_acctbal < 1000 THEN 'PAUSED' ELSE 'ACTIVE' END AS status,
        TIMESTAMP '2000-01-01 00:00:00' + (c_custkey % 365) * INTERVAL '1' DAY AS created_at,
        TIMESTAMP '2001-08-02 00:00:00' + (c_custkey % 30) * INTERVAL '1' DAY AS current_period_end,
        CASE WHEN c_acctbal < 0 THEN TIMESTAMP '2001-01-01 00:00:00' + (c_custkey % 200) * INTERVAL '1' DAY END AS canceled_at,
        c_acctbal > 9000 AS cancel_at_period_end
      FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD')""",
    "x_subpayments": """SELECT o_orderkey AS subscription_payment_id, o_custkey AS subscription_id,
        CASE WHEN o_orderstatus = 'O' THEN 'FAILED' ELSE 'SUCCEEDED' END AS status,
        CAST(1 + o_orderkey % 5 AS INT) AS attempt_count,
        CASE WHEN o_orderstatus = 'O' THEN o_orderdate + INTERVAL 3 DAY END AS next_retry_at
      FROM orders""",
    "x_fact": """SELECT *, CAST(amount - processing_fee AS DECIMAL(18,2)) AS net_amount,
        CAST(strptime(CAST(time_key AS VARCHAR), '%Y%m%d') AS DATE) AS full_date,
        time_key // 10000 AS year, (time_key // 100) % 100 AS month FROM (
      SELECT l_orderkey AS transaction_id,
        year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) AS time_key,
        o_custkey AS customer_key, l_suppkey AS merchant_key, l_partkey AS payment_method_key,
        c_nationkey AS geography_key, l_linenumber % 2 + 1 AS product_key,
        CAST(l_extendedprice AS DECIMAL(18,2)) AS amount,
        CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(0.0290 AS DECIMAL(5,4)), 2) AS DECIMAL(18,2)) AS processing_fee,
        l_linestatus = 'F' AS is_successful, l_returnflag = 'R' AS is_refunded, l_discount >= 0.1 AS is_disputed,
        l_tax >= 0.08 AS is_fraudulent,
        o_orderdate + (l_orderkey * 37 % 86400) * INTERVAL '1' SECOND AS transaction_datetime
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey)""",
    "x_changes": """SELECT o_orderkey AS payment_id, 1 * 1000000000000 + o_orderkey AS lsn, 2 AS op, 'PENDING' AS status,
        CAST(o_totalprice AS DECIMAL(18,2)) AS amount FROM orders
      UNION ALL SELECT o_orderkey, 2 * 1000000000000 + o_orderkey, 3, 'PENDING', CAST(o_totalprice AS DECIMAL(18,2))
        FROM orders WHERE o_orderstatus = 'F'
      UNION ALL SELECT o_orderkey, 3 * 1000000000000 + o_orderkey, 4, 'SUCCEEDED', CAST(o_totalprice AS DECIMAL(18,2))
        FROM orders WHERE o_orderstatus = 'F'
      UNION ALL SELECT o_orderkey, 4 * 1000000000000 + o_orderkey, 1, 'SUCCEEDED', CAST(o_totalprice AS DECIMAL(18,2))
        FROM orders WHERE o_totalprice < 50000""",
    "x_logs": """SELECT event_id AS log_id, user_id AS merchant_id, ts, '/v1/' || event_type AS endpoint,
        CASE event_type WHEN 'error' THEN 500 WHEN 'signup' THEN 402 ELSE 200 END AS status_code,
        CAST(round(value * 100) AS BIGINT) AS latency_ms,
        '{"payment":"pi_' || event_id || '","props":' || props || '}' AS request_body
      FROM events""",
    "x_webhooks": """SELECT event_id AS webhook_id, user_id AS merchant_id, 'charge.' || event_type AS event_type,
        ts AS created_at,
        CASE WHEN event_id % 10 < 6 THEN 'sent' WHEN event_id % 10 < 8 THEN 'failed' WHEN event_id % 10 = 8 THEN 'pending'
             ELSE 'cancelled' END AS status,
        CAST(event_id % 6 AS INT) AS retry_count, CAST(round(value * 100) AS BIGINT) AS response_time_ms,
        CASE WHEN event_id % 10 < 6 THEN ts + (event_id % 120) * INTERVAL '1' SECOND END AS delivered_at,
        CASE WHEN event_id % 10 IN (6, 7) THEN ts + CAST(60 * power(2, event_id % 6) AS INT) * INTERVAL '1' SECOND END
          AS next_retry_at
      FROM events""",
    "x_payments": """SELECT event_id AS payment_id, user_id AS customer_id, event_id % 20 AS merchant_id,
        event_type AS payment_method, CAST(round(value * 100) AS BIGINT) AS amount_minor,
        CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCEEDED' END AS status, ts,
        CASE CAST(floor(value) AS BIGINT) % 4 WHEN 0 THEN 'US' WHEN 1 THEN 'FR' ELSE 'GB' END AS ip_country,
        CASE user_id % 3 WHEN 0 THEN 'US' WHEN 1 THEN 'FR' ELSE 'GB' END AS card_country,
        CASE user_id % 3 WHEN 0 THEN 'US' ELSE 'FR' END AS billing_country,
        'fp_' || user_id || '_' || (event_id % 4) AS device_fingerprint,
        'u' || user_id || CASE user_id % 4 WHEN 0 THEN '@gmail.com' WHEN 1 THEN '@tempmail.com' ELSE '@example.com' END AS email,
        'Mozilla/5.0 Chrome/' || (90 + event_id % 60) || '.0' AS user_agent,
        props AS shipping_address, CASE WHEN event_type = 'view' THEN '{}' ELSE props END AS billing_address
      FROM events""",
    "x_disputes": """SELECT event_id AS payment_id, ts + INTERVAL 2 DAY AS opened_at,
        CASE event_id % 2 WHEN 0 THEN 'fraudulent' ELSE 'product_not_received' END AS reason
      FROM events WHERE event_type = 'signup' AND value > 100""",
    "x_snapshots": """SELECT user_id AS customer_id, ts AS computed_at, CAST(round(value * 100) AS BIGINT) AS profile_score
      FROM events WHERE event_type = 'signup'""",
}

CASTS = {
    "i": "CAST({0} AS BIGINT)",
    "d": "CAST({0} AS DOUBLE)",
    # half up, spelled out so that both engines round the same way
    "r": "floor(CAST({0} AS DOUBLE) * 10000 + 0.5) / 10000",
    "s": "CAST({0} AS VARCHAR)",
    "b": "CAST({0} AS BOOLEAN)",
    "t": "strftime({0}, '%Y-%m-%d %H:%M:%S.%f')",
}

_parts: dict[str, str] = dict(FIXTURES)


def part(name: str, sql: str) -> None:
    """Register a named sub-query that several checks share."""
    _parts[name] = sql


def check(columns: str, body: str) -> str:
    """A full check query: typed output columns over ``body``, with the fixtures it uses.

    ``columns`` lists ``name:type`` with i=bigint, d=double, r=double rounded to 4,
    s=text, b=boolean, t=timestamp as text.
    """
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"\bx_\w+", text):
            if name in _parts and name not in needed:
                visit(_parts[name])
                if name not in needed:
                    needed.append(name)

    visit(body)
    outputs = ", ".join(
        f"{CASTS[kind].format(name)} AS {name}" for name, kind in (c.split(":") for c in columns.split())
    )
    ctes = ", ".join(f"{name} AS ({_parts[name]})" for name in needed)
    return (f"WITH {ctes} " if ctes else "") + f"SELECT {outputs} FROM ({body}) AS result"
