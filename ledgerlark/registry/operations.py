"""Operational reports and their checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlark.plans import operations as O
from ledgerlark.registry import query
from ledgerlark.sources.driver_tables import AS_OF_ORDERS as NOW

AT = f"TIMESTAMP '{NOW}'"
GOOD = "status = 'SUCCEEDED'"
PEOPLE = "JOIN x_customers c USING (customer_id) JOIN x_merchants m USING (merchant_id)"


def spend(column: str, name: str) -> str:
    return f"sum(CASE WHEN {GOOD} THEN {column} ELSE 0 END) AS {name}"


@query("oltp_transaction_details",
       "transaction_id:i payment_intent_id:s amount:d currency:s status:s created_at:t customer_email:s merchant_name:s "
       "card_brand:s last4:s risk_level:s",
       f"""SELECT t.*, c.email AS customer_email, m.business_name AS merchant_name, pm.card_brand, pm.last4, k.risk_level
          FROM x_transactions t {PEOPLE} JOIN x_methods pm USING (payment_method_id)
          LEFT JOIN x_checks k USING (transaction_id) WHERE NOT t.is_deleted""")
def transaction_details(t):
    return O.transaction_details(t.transactions(), t.customers(), t.merchants(), t.payment_methods(), t.fraud_checks())


@query("oltp_active_payment_methods",
       "customer_id:i payment_method_id:i type:s card_brand:s last4:s is_default:b created_at:t",
       "SELECT * FROM x_methods WHERE is_active")
def active_payment_methods(t):
    return O.active_payment_methods(t.payment_methods())


@query("oltp_duplicate_transactions",
       "transaction_id:i payment_intent_id:s customer_id:i merchant_id:i amount:d created_at:t previous_at:t",
       """SELECT * FROM (SELECT *, lag(created_at) OVER (PARTITION BY customer_id, merchant_id, amount
              ORDER BY created_at, transaction_id) AS previous_at FROM (
            SELECT l_orderkey AS transaction_id, 'pi_' || l_orderkey AS payment_intent_id, l_suppkey AS merchant_id,
              o_custkey AS customer_id, CAST(l_quantity AS DECIMAL(18,2)) AS amount, l_shipdate AS created_at
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus <> 'O'))
          WHERE previous_at >= created_at - INTERVAL 30 DAY""")
def duplicate_transactions(t):
    """Order lines as payments, thirty days apart: orders of one customer are never minutes apart here."""
    lines = t.raw("lineitem").join(t.raw("orders").filter("o_orderstatus <> 'O'"), F.expr("l_orderkey = o_orderkey")).selectExpr(
        "l_orderkey AS transaction_id", "concat('pi_', l_orderkey) AS payment_intent_id", "l_suppkey AS merchant_id",
        "o_custkey AS customer_id", "CAST(l_quantity AS DECIMAL(18,2)) AS amount", "'SUCCEEDED' AS status",
        "CAST(l_shipdate AS TIMESTAMP) AS created_at", "false AS is_deleted")
    return O.duplicate_transactions(lines, minutes=30 * 24 * 60)


@query("oltp_merchant_daily_revenue",
       "merchant_id:i transaction_date:s currency:s total_transactions:i successful_count:i gross_revenue:d fees:d net_revenue:d",
       f"""SELECT merchant_id, CAST(created_at AS DATE) AS transaction_date, currency, count(*) AS total_transactions,
            count(*) FILTER ({GOOD}) AS successful_count, {spend('amount', 'gross_revenue')},
            {spend('processing_fee', 'fees')}, {spend('net_amount', 'net_revenue')}
          FROM x_transactions WHERE NOT is_deleted AND created_at >= {AT} - INTERVAL 30 DAY GROUP BY 1, 2, 3""")
def merchant_daily_revenue(t):
    return O.merchant_daily_revenue(t.transactions(), NOW)


TOP = f"""SELECT customer_id, c.email, c.full_name AS customer_name, count(*) AS transaction_count,
    {spend('amount', 'total_spent')}, max(t.created_at) AS last_transaction_date
  FROM x_transactions t JOIN x_customers c USING (customer_id)
  WHERE NOT t.is_deleted AND NOT c.is_deleted AND t.created_at >= {AT} - INTERVAL 90 DAY GROUP BY 1, 2, 3
  ORDER BY total_spent DESC, customer_id LIMIT 10"""


@query("oltp_top_customers",
       "customer_id:i email:s customer_name:s transaction_count:i total_spent:d last_transaction_date:t", TOP)
def top_customers(t):
    return O.top_customers(t.transactions(), t.customers(), NOW)


@query("oltp_failed_analysis", "merchant_id:i failure_code:s failure_message:s failure_count:i lost_revenue:d avg_failed_amount:r",
       f"""SELECT merchant_id, failure_code, failure_message, count(*) AS failure_count, sum(amount) AS lost_revenue,
            CAST(sum(amount) AS DOUBLE) / count(*) AS avg_failed_amount
          FROM x_transactions WHERE NOT is_deleted AND status = 'FAILED' AND created_at >= {AT} - INTERVAL 7 DAY
          GROUP BY 1, 2, 3""")
def failed_analysis(t):
    return O.failed_analysis(t.transactions(), NOW)


@query("oltp_high_risk_review",
       "transaction_id:i payment_intent_id:s amount:d currency:s created_at:t customer_email:s customer_risk_score:d "
       "merchant_name:s transaction_risk_score:d risk_level:s country:i customer_country:i",
       f"""SELECT t.*, c.email AS customer_email, c.risk_score AS customer_risk_score, m.business_name AS merchant_name,
            k.risk_score AS transaction_risk_score, k.risk_level, t.nationkey AS country, c.nationkey AS customer_country
          FROM x_transactions t {PEOPLE} JOIN x_checks k USING (transaction_id)
          WHERE k.risk_level IN ('HIGH', 'CRITICAL') AND action_taken = 'REVIEW' AND reviewed_at IS NULL
            AND t.created_at >= {AT} - INTERVAL 720 HOUR""")
def high_risk_review(t):
    return O.high_risk_review(t.transactions(), t.customers(), t.merchants(), t.fraud_checks(), NOW, hours=720)


@query("oltp_card_testing",
       "customer_id:i email:s failed_attempts:i different_cards_used:i first_attempt:t last_attempt:t",
       f"""SELECT customer_id, c.email, count(*) AS failed_attempts,
            count(DISTINCT payment_method_id) AS different_cards_used, min(t.created_at) AS first_attempt,
            max(t.created_at) AS last_attempt
          FROM x_transactions t JOIN x_customers c USING (customer_id)
          WHERE NOT t.is_deleted AND status = 'FAILED' AND t.created_at >= {AT} - INTERVAL 8760 HOUR
          GROUP BY 1, 2 HAVING count(*) >= 3""")
def card_testing(t):
    return O.card_testing(t.transactions(), t.customers(), NOW, hours=8760)


@query("oltp_cross_border",
       "transaction_id:i amount:d created_at:t email:s customer_country:i transaction_country:i risk_score:d",
       f"""SELECT t.*, c.email, c.nationkey AS customer_country, t.nationkey AS transaction_country, k.risk_score
          FROM x_transactions t JOIN x_customers c USING (customer_id) JOIN x_checks k USING (transaction_id)
          WHERE c.nationkey <> t.nationkey AND amount > 500 AND NOT t.is_deleted
            AND t.created_at >= {AT} - INTERVAL 30 DAY""")
def cross_border(t):
    return O.cross_border(t.transactions(), t.customers(), t.fraud_checks(), NOW, days=30)


@query("oltp_subscriptions_expiring",
       "subscription_id:i plan_name:s amount:d current_period_end:t customer_email:s full_name:s merchant_name:s",
       f"""SELECT s.*, c.email AS customer_email, c.full_name, m.business_name AS merchant_name
          FROM x_subscriptions s {PEOPLE}
          WHERE status = 'ACTIVE' AND current_period_end BETWEEN {AT} AND {AT} + INTERVAL 7 DAY
            AND NOT cancel_at_period_end""")
def subscriptions_expiring(t):
    return O.subscriptions_expiring(t.subscriptions(), t.customers(), t.merchants(), NOW)


@query("oltp_dunning_queue",
       "subscription_payment_id:i subscription_id:i plan_name:s amount:d attempt_count:i next_retry_at:t customer_email:s "
       "merchant_name:s",
       f"""SELECT p.subscription_payment_id, s.*, p.attempt_count, p.next_retry_at, c.email AS customer_email,
            m.business_name AS merchant_name
          FROM x_subpayments p JOIN x_subscriptions s USING (subscription_id) {PEOPLE}
          WHERE p.status = 'FAILED' AND next_retry_at <= {AT} AND attempt_count < 4 AND s.status = 'ACTIVE'""")
def dunning_queue(t):
    return O.dunning_queue(t.subscription_payments(), t.subscriptions(), t.customers(), t.merchants(), NOW)


@query("oltp_subscription_churn", "cancel_year:i cancel_month:i canceled_count:i avg_lifetime_days:r lost_mrr:d",
       f"""SELECT year(canceled_at) AS cancel_year, month(canceled_at) AS cancel_month, count(*) AS canceled_count,
            CAST(sum(date_diff('day', created_at, canceled_at)) AS DOUBLE) / count(*) AS avg_lifetime_days,
            sum(amount) AS lost_mrr
          FROM x_subscriptions WHERE status = 'CANCELED' AND canceled_at >= {AT} - INTERVAL 12 MONTH GROUP BY 1, 2""")
def subscription_churn(t):
    return O.subscription_churn(t.subscriptions(), NOW)


@query("oltp_card_audit",
       "payment_method_id:i last4:s card_brand:s customer_email:s card_stored_date:t times_used:i",
       f"""SELECT payment_method_id, last4, card_brand, c.email AS customer_email, pm.created_at AS card_stored_date,
            count(t.transaction_id) AS times_used
          FROM x_methods pm JOIN x_customers c ON pm.customer_id = c.customer_id
          LEFT JOIN x_transactions t USING (payment_method_id)
          WHERE pm.created_at >= {AT} - INTERVAL 6 MONTH GROUP BY ALL""")
def card_audit(t):
    return O.card_audit(t.payment_methods(), t.customers(), t.transactions(), NOW)


EXPORT_COLUMNS = "data_type:s customer_id:i record_id:i detail_1:s detail_2:s detail_3:s detail_4:s detail_5:s created_at:t"
EXPORT = """SELECT 'Customer Info' AS data_type, customer_id, customer_id AS record_id, email AS detail_1,
    first_name AS detail_2, last_name AS detail_3, phone AS detail_4, CAST(nationkey AS VARCHAR) AS detail_5, created_at
    FROM x_customers
  UNION ALL SELECT 'Payment Methods', customer_id, payment_method_id, type, card_brand, last4, CAST(exp_month AS VARCHAR),
    CAST(exp_year AS VARCHAR), pm.created_at
    FROM x_methods pm JOIN x_customers USING (customer_id)
  UNION ALL SELECT 'Transactions', t.customer_id, transaction_id, CAST(amount AS VARCHAR), currency, status, business_name,
    NULL, t.created_at FROM x_transactions t JOIN x_customers USING (customer_id) JOIN x_merchants USING (merchant_id)"""


@query("oltp_customer_export", EXPORT_COLUMNS, EXPORT)
def customer_export(t):
    return O.customer_export(t.customers(), t.payment_methods(), t.transactions(), t.merchants())


@query("oltp_aml_large",
       "transaction_id:i payment_intent_id:s amount:d currency:s created_at:t customer_email:s customer_country:i "
       "merchant_name:s industry:s risk_score:d risk_level:s",
       f"""SELECT t.*, c.email AS customer_email, c.nationkey AS customer_country, m.business_name AS merchant_name, industry,
            k.risk_score, k.risk_level
          FROM x_transactions t {PEOPLE} JOIN x_checks k USING (transaction_id)
          WHERE amount >= 10000 AND {GOOD} AND t.created_at >= {AT} - INTERVAL 30 DAY AND NOT t.is_deleted""")
def aml_large(t):
    return O.aml_large(t.transactions(), t.customers(), t.merchants(), t.fraud_checks(), NOW)


@query("oltp_pending_refunds",
       "refund_id:i refund_amount:d currency:s reason:s requested_at:t hours_pending:i transaction_id:i payment_intent_id:s "
       "customer_email:s merchant_name:s",
       f"""SELECT r.refund_id, r.amount AS refund_amount, t.currency, r.reason, r.created_at AS requested_at,
            date_diff('hour', r.created_at, {AT}) AS hours_pending, transaction_id, payment_intent_id,
            c.email AS customer_email, m.business_name AS merchant_name
          FROM x_refunds r JOIN x_transactions t USING (transaction_id) {PEOPLE} WHERE r.status = 'PENDING'""")
def pending_refunds(t):
    return O.pending_refunds(t.refunds(), t.transactions(), t.customers(), t.merchants(), NOW)


@query("oltp_chargeback_rate",
       "merchant_id:i business_name:s industry:s total_transactions:i chargeback_count:i chargeback_rate:r "
       "total_disputed_amount:d",
       f"""SELECT merchant_id, business_name, industry, count(DISTINCT transaction_id) AS total_transactions,
            count(DISTINCT chargeback_id) AS chargeback_count,
            CAST(count(DISTINCT chargeback_id) AS DOUBLE) / count(DISTINCT transaction_id) * 100 AS chargeback_rate,
            sum(b.amount) AS total_disputed_amount
          FROM x_merchants m JOIN x_transactions t USING (merchant_id) LEFT JOIN x_chargebacks b USING (transaction_id)
          WHERE t.created_at >= {AT} - INTERVAL 12 MONTH AND NOT t.is_deleted AND NOT m.is_deleted
          GROUP BY 1, 2, 3 HAVING count(DISTINCT chargeback_id) > 0""")
def chargeback_rate(t):
    return O.chargeback_rate(t.transactions(), t.merchants(), t.chargebacks(), NOW, months=12)


@query("oltp_open_chargebacks",
       "chargeback_id:i disputed_amount:d reason_code:s evidence_due_date:t days_remaining:i transaction_id:i "
       "payment_intent_id:s transaction_date:t customer_email:s merchant_name:s merchant_email:s",
       f"""SELECT b.*, b.amount AS disputed_amount, date_diff('day', {AT}, evidence_due_date) AS days_remaining,
            payment_intent_id, t.created_at AS transaction_date, c.email AS customer_email,
            m.business_name AS merchant_name, m.email AS merchant_email
          FROM x_chargebacks b JOIN x_transactions t USING (transaction_id) {PEOPLE}
          WHERE b.status = 'OPEN' AND evidence_due_date IS NOT NULL""")
def open_chargebacks(t):
    return O.open_chargebacks(t.chargebacks(), t.transactions(), t.customers(), t.merchants(), NOW)


RISK = "CAST(sum(risk_score) AS DOUBLE) / nullif(count(risk_score), 0) AS avg_risk_score"
GOOD_AVG = f"CAST(sum(amount) FILTER ({GOOD}) AS DOUBLE) / nullif(count(*) FILTER ({GOOD}), 0)"


@query("oltp_hourly_volume",
       "transaction_hour:i transaction_count:i successful_count:i avg_transaction_amount:r avg_risk_score:r",
       f"""SELECT hour(created_at) AS transaction_hour, count(*) AS transaction_count,
            count(*) FILTER ({GOOD}) AS successful_count, {GOOD_AVG} AS avg_transaction_amount, {RISK}
          FROM x_transactions LEFT JOIN x_checks USING (transaction_id)
          WHERE NOT is_deleted AND created_at >= {AT} - INTERVAL 720 HOUR GROUP BY 1""")
def hourly_volume(t):
    return O.hourly_volume(t.transactions(), t.fraud_checks(), NOW, hours=720)


@query("oltp_method_performance",
       "type:s card_brand:s transaction_count:i successful_count:i failed_count:i success_rate:r avg_successful_amount:r",
       f"""SELECT type, card_brand, count(*) AS transaction_count, count(*) FILTER ({GOOD}) AS successful_count,
            count(*) FILTER (status = 'FAILED') AS failed_count,
            CAST(count(*) FILTER ({GOOD}) AS DOUBLE) / count(*) * 100 AS success_rate, {GOOD_AVG} AS avg_successful_amount
          FROM x_transactions t JOIN x_methods USING (payment_method_id)
          WHERE NOT t.is_deleted AND t.created_at >= {AT} - INTERVAL 1 MONTH GROUP BY 1, 2""")
def method_performance(t):
    return O.method_performance(t.payment_methods(), t.transactions(), NOW)


@query("oltp_geo_distribution",
       "country:i transaction_count:i unique_customers:i unique_merchants:i total_volume:d avg_transaction_amount:r "
       "avg_risk_score:r",
       f"""SELECT nationkey AS country, count(*) AS transaction_count, count(DISTINCT customer_id) AS unique_customers,
            count(DISTINCT merchant_id) AS unique_merchants, {spend('amount', 'total_volume')},
            CAST(sum(amount) AS DOUBLE) / count(*) AS avg_transaction_amount, {RISK}
          FROM x_transactions LEFT JOIN x_checks USING (transaction_id)
          WHERE NOT is_deleted AND created_at >= {AT} - INTERVAL 1 MONTH AND nationkey IS NOT NULL GROUP BY 1""")
def geo_distribution(t):
    return O.geo_distribution(t.transactions(), t.fraud_checks(), NOW)


@query("oltp_clv",
       "customer_id:i email:s country:i customer_since:t customer_age_days:i total_transactions:i total_spent:d "
       "avg_transaction_value:r last_transaction_date:t days_since_last_transaction:i",
       f"""SELECT customer_id, email, c.nationkey AS country, c.created_at AS customer_since,
            date_diff('day', c.created_at, {AT}) AS customer_age_days, count(DISTINCT transaction_id) AS total_transactions,
            {spend('amount', 'total_spent')}, {GOOD_AVG} AS avg_transaction_value,
            max(t.created_at) AS last_transaction_date,
            date_diff('day', max(t.created_at), {AT}) AS days_since_last_transaction
          FROM x_customers c LEFT JOIN (SELECT * FROM x_transactions WHERE NOT is_deleted) t USING (customer_id)
          WHERE NOT c.is_deleted GROUP BY 1, 2, 3, 4 HAVING count(DISTINCT transaction_id) > 0""")
def clv(t):
    return O.customer_lifetime_value(t.transactions(), t.customers(), NOW)


@query("oltp_method_diversity",
       "customer_id:i email:s total_payment_methods:i different_brands:i payment_types_used:s last_method_added:t",
       """SELECT customer_id, c.email, count(DISTINCT payment_method_id) AS total_payment_methods,
            count(DISTINCT card_brand) AS different_brands,
            array_to_string(list_sort(list_distinct(list(type))), ', ') AS payment_types_used,
            max(pm.created_at) AS last_method_added
          FROM x_methods pm JOIN x_customers c USING (customer_id) WHERE NOT c.is_deleted
          GROUP BY 1, 2 HAVING count(DISTINCT payment_method_id) > 1""")
def method_diversity(t):
    return O.method_diversity(t.customers(), t.payment_methods())


@query("oltp_repeat_rate", "customer_segment:s customer_count:i percentage:r",
       f"""SELECT customer_segment, count(*) AS customer_count,
            CAST(count(*) AS DOUBLE) / CAST(sum(count(*)) OVER () AS DOUBLE) * 100 AS percentage
          FROM (SELECT CASE WHEN count(*) = 1 THEN 'One-time' WHEN count(*) BETWEEN 2 AND 5 THEN 'Occasional'
                WHEN count(*) BETWEEN 6 AND 20 THEN 'Regular' ELSE 'Power User' END AS customer_segment
            FROM x_transactions WHERE {GOOD} AND NOT is_deleted AND created_at >= {AT} - INTERVAL 36 MONTH
            GROUP BY customer_id) GROUP BY 1""")
def repeat_rate(t):
    return O.repeat_rate(t.transactions(), NOW, months=36)


@query("oltp_processing_latency",
       "hour_of_day:i transaction_count:i avg_processing_ms:r max_processing_ms:i min_processing_ms:i",
       f"""SELECT hour(created_at) AS hour_of_day, count(*) AS transaction_count,
            CAST(sum(ms) AS DOUBLE) / count(*) AS avg_processing_ms, max(ms) AS max_processing_ms,
            min(ms) AS min_processing_ms
          FROM (SELECT *, epoch_ms(updated_at) - epoch_ms(created_at) AS ms FROM x_transactions)
          WHERE NOT is_deleted AND status IN ('SUCCEEDED', 'FAILED') AND created_at >= {AT} - INTERVAL 720 HOUR
          GROUP BY 1""")
def processing_latency(t):
    return O.processing_latency(t.transactions(), NOW, hours=720)


@query("oltp_health_check",
       "time_period:s total_transactions:i succeeded:i failed:i pending:i success_rate:r total_volume:d avg_risk_score:r",
       f"""SELECT 'Last Month' AS time_period, count(*) AS total_transactions, count(*) FILTER ({GOOD}) AS succeeded,
            count(*) FILTER (status = 'FAILED') AS failed, count(*) FILTER (status = 'PENDING') AS pending,
            CAST(count(*) FILTER ({GOOD}) AS DOUBLE) / count(*) * 100 AS success_rate, {spend('amount', 'total_volume')},
            {RISK}
          FROM x_transactions LEFT JOIN x_checks USING (transaction_id)
          WHERE NOT is_deleted AND created_at >= {AT} - INTERVAL 720 HOUR""")
def health_check(t):
    return O.health_check(t.transactions(), t.fraud_checks(), NOW, hours=720, label="Last Month")


@query("oltp_vw_active_transactions",
       "transaction_id:i payment_intent_id:s amount:d currency:s status:s created_at:t customer_id:i customer_email:s "
       "customer_name:s merchant_id:i merchant_name:s merchant_country:i payment_type:s card_brand:s last4:s risk_level:s "
       "risk_score:d",
       f"""SELECT t.*, c.email AS customer_email, c.full_name AS customer_name, m.business_name AS merchant_name,
            m.nationkey AS merchant_country, pm.type AS payment_type, pm.card_brand, pm.last4, k.risk_level, k.risk_score
          FROM x_transactions t {PEOPLE} JOIN x_methods pm USING (payment_method_id)
          LEFT JOIN x_checks k USING (transaction_id) WHERE NOT t.is_deleted""")
def vw_active_transactions(t):
    return O.active_transactions(t.transactions(), t.customers(), t.merchants(), t.payment_methods(), t.fraud_checks())


@query("oltp_vw_merchant_revenue",
       "merchant_id:i business_name:s country:i total_transactions:i total_revenue:d total_fees:d total_net:d refund_count:i "
       "failed_count:i",
       f"""SELECT m.merchant_id, business_name, m.nationkey AS country, count(transaction_id) AS total_transactions,
            {spend('amount', 'total_revenue')}, {spend('processing_fee', 'total_fees')}, {spend('net_amount', 'total_net')},
            count(*) FILTER (status = 'REFUNDED') AS refund_count, count(*) FILTER (status = 'FAILED') AS failed_count
          FROM x_merchants m LEFT JOIN x_transactions t ON m.merchant_id = t.merchant_id AND NOT t.is_deleted
          WHERE NOT m.is_deleted GROUP BY 1, 2, 3""")
def vw_merchant_revenue(t):
    return O.merchant_revenue(t.transactions(), t.merchants())


@query("oltp_vw_high_risk",
       "transaction_id:i payment_intent_id:s amount:d currency:s status:s created_at:t customer_email:s merchant_name:s "
       "risk_score:d risk_level:s is_flagged:b action_taken:s",
       f"""SELECT t.*, c.email AS customer_email, m.business_name AS merchant_name, k.risk_score, k.risk_level, k.is_flagged,
            k.action_taken
          FROM x_transactions t {PEOPLE} JOIN x_checks k USING (transaction_id)
          WHERE k.risk_level IN ('HIGH', 'CRITICAL') AND k.is_flagged AND NOT t.is_deleted""")
def vw_high_risk(t):
    return O.high_risk_transactions(t.transactions(), t.customers(), t.merchants(), t.fraud_checks())


@query("oltp_customer_history",
       "customer_id:i transaction_id:i payment_intent_id:s amount:d currency:s status:s created_at:t merchant_name:s "
       "payment_type:s last4:s",
       """SELECT t.*, m.business_name AS merchant_name, pm.type AS payment_type, pm.last4
          FROM x_transactions t JOIN x_merchants m USING (merchant_id) JOIN x_methods pm USING (payment_method_id)
          WHERE NOT t.is_deleted AND t.created_at >= TIMESTAMP '2000-01-01 00:00:00' AND status = 'SUCCEEDED'""")
def customer_history(t):
    return O.customer_history(t.transactions(), t.merchants(), t.payment_methods(), start="2000-01-01 00:00:00",
                              status="SUCCEEDED")


@query("oltp_merchant_metrics",
       "merchant_id:i total_transactions:i successful_transactions:i failed_transactions:i refunded_transactions:i "
       "total_revenue:d average_transaction_value:r total_processing_fees:d total_net_revenue:d success_rate:r",
       f"""SELECT merchant_id, count(*) AS total_transactions, count(*) FILTER ({GOOD}) AS successful_transactions,
            count(*) FILTER (status = 'FAILED') AS failed_transactions,
            count(*) FILTER (status = 'REFUNDED') AS refunded_transactions, {spend('amount', 'total_revenue')},
            {GOOD_AVG} AS average_transaction_value, {spend('processing_fee', 'total_processing_fees')},
            {spend('net_amount', 'total_net_revenue')},
            CAST(count(*) FILTER ({GOOD}) AS DOUBLE) / count(*) * 100 AS success_rate
          FROM x_transactions WHERE NOT is_deleted
            AND created_at BETWEEN TIMESTAMP '2000-01-01 00:00:00' AND TIMESTAMP '2000-12-31 23:59:59' GROUP BY 1""")
def merchant_metrics(t):
    return O.merchant_metrics(t.transactions(), "2000-01-01 00:00:00", "2000-12-31 23:59:59")
