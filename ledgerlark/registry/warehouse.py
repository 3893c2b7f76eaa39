"""Warehouse maintenance and its checks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ledgerlark.operators import quality as Q
from ledgerlark.operators import warehouse as L
from ledgerlark.operators.ranking import dense_keys
from ledgerlark.plans import aggregates as G
from ledgerlark.plans.calendar import dim_time_for
from ledgerlark.plans.nightly import dated_load
from ledgerlark.registry import query
from ledgerlark.registry.analytics import WEEK
from ledgerlark.registry.fixture_sql import part
from ledgerlark.session import scratch
from ledgerlark.sources import tables as T
from ledgerlark.sources.driver_tables import AS_OF_ORDERS as NOW
from ledgerlark.sources.driver_tables import LSN_STEP

AT = f"TIMESTAMP '{NOW}'"


@query("build_dim_time",
       "time_key:i full_date:s year:i quarter:i month:i month_name:s week_of_year:i day_of_month:i day_of_week:i day_name:s "
       "is_weekend:b is_holiday:b fiscal_year:i fiscal_quarter:i fiscal_period:i",
       f"""SELECT year(full_date) * 10000 + month(full_date) * 100 + day(full_date) AS time_key, full_date, year(full_date) AS year,
            quarter(full_date) AS quarter, month(full_date) AS month, monthname(full_date) AS month_name,
            {WEEK} AS week_of_year, day(full_date) AS day_of_month, dayofweek(full_date) + 1 AS day_of_week,
            dayname(full_date) AS day_name, dayofweek(full_date) IN (0, 6) AS is_weekend,
            full_date IN (DATE '1999-12-25', DATE '2000-01-01') AS is_holiday, year(full_date) AS fiscal_year,
            quarter(full_date) AS fiscal_quarter, month(full_date) AS fiscal_period
          FROM (SELECT CAST(unnest(generate_series(date_trunc('year', min(o_orderdate)),
            date_trunc('year', max(o_orderdate)) + INTERVAL 1 YEAR - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS full_date
            FROM orders)""")
def build_dim_time(t):
    return dim_time_for(t.raw("orders"), "o_orderdate", ("1999-12-25", "2000-01-01"))


# -- versions -------------------------------------------------------------------
part("x_segments", f"""SELECT customer_id, lifetime_value, first_payment_at,
    CASE WHEN lifetime_value >= 1000000 THEN 'VIP' WHEN first_payment_at >= {AT} - INTERVAL 720 DAY THEN 'New'
         ELSE 'Regular' END AS customer_segment
  FROM (SELECT customer_id, sum(CASE WHEN status = 'SUCCEEDED' THEN amount ELSE 0 END) AS lifetime_value,
    min(created_at) AS first_payment_at FROM x_transactions WHERE NOT is_deleted GROUP BY 1)""")
part("x_dim0", """SELECT row_number() OVER (ORDER BY c_custkey) AS customer_key, c_custkey AS customer_id,
    'Regular' AS customer_segment FROM customer WHERE c_acctbal >= 0""")
part("x_scd2", """SELECT customer_key, customer_id, d.customer_segment, DATE '2000-01-01' AS effective_date,
    CASE WHEN u.customer_segment <> 'Regular' THEN DATE '2001-01-01' END AS expiration_date,
    coalesce(u.customer_segment, 'Regular') = 'Regular' AS is_current, 1 AS version
  FROM x_dim0 d LEFT JOIN x_segments u USING (customer_id)
  UNION ALL SELECT (SELECT max(customer_key) FROM x_dim0) + row_number() OVER (ORDER BY u.customer_id), u.customer_id,
    u.customer_segment, DATE '2001-01-01', NULL, TRUE, CASE WHEN d.customer_id IS NULL THEN 1 ELSE 2 END
  FROM x_segments u LEFT JOIN x_dim0 d USING (customer_id)
  WHERE d.customer_id IS NULL OR u.customer_segment <> d.customer_segment""")


def segments(t):
    return L.segment_customers(t.transactions(), NOW, vip_from=1_000_000, new_days=720)


def customer_dim(t):
    """First load of the dimension, then one merge with the segments."""
    first = t.raw("customer").filter("c_acctbal >= 0").selectExpr(
        "c_custkey AS customer_id", "'Regular' AS customer_segment", "DATE'2000-01-01' AS effective_date",
        "CAST(NULL AS DATE) AS expiration_date", "true AS is_current", "1 AS version")
    dim = dense_keys(first, "customer_id", "customer_key")
    return L.scd2_merge(dim, segments(t), "customer_id", "customer_key", ["customer_segment"], "2001-01-01")


@query("scd2_merge",
       "customer_key:i customer_id:i customer_segment:s effective_date:s expiration_date:s is_current:b version:i",
       "SELECT * FROM x_scd2")
def scd2_merge(t):
    return customer_dim(t)


@query("scd2_pit_join", "transaction_id:i customer_id:i created_at:t customer_key:i customer_segment:s",
       """SELECT t.*, coalesce(d.customer_key, -1) AS customer_key, d.customer_segment
          FROM x_transactions t LEFT JOIN x_scd2 d ON t.customer_id = d.customer_id
            AND effective_date <= CAST(t.created_at AS DATE)
            AND (expiration_date IS NULL OR CAST(t.created_at AS DATE) < expiration_date)""")
def scd2_pit_join(t):
    return L.version_at(t.transactions(), customer_dim(t), "customer_id", F.to_date("created_at"),
                        ["customer_key", "customer_segment"], "customer_key")


@query("segment_customers", "customer_id:i lifetime_value:d first_payment_at:t customer_segment:s", "SELECT * FROM x_segments")
def segment_customers(t):
    return segments(t)


@query("classify_risk_category", "customer_id:i risk_score:d risk_category:s",
       """SELECT *, CASE WHEN risk_score >= 66 THEN 'HIGH' WHEN risk_score >= 33 THEN 'MEDIUM' ELSE 'LOW' END AS risk_category
          FROM x_customers""")
def classify_risk_category(t):
    return L.classify_risk(t.customers())


# -- fact -------------------------------------------------------------------------
part("x_loaded", """SELECT transaction_id, row_number() OVER (ORDER BY transaction_id) + 500 AS transaction_key,
    coalesce(pr.product_key, -1) AS product_key, year(t.created_at) * 10000 + month(t.created_at) * 100 + day(t.created_at) AS time_key,
    coalesce(c.customer_key, -1) AS customer_key, coalesce(m.merchant_key, -1) AS merchant_key,
    coalesce(p.payment_method_key, -1) AS payment_method_key, coalesce(g.geography_key, -1) AS geography_key, t.amount, t.processing_fee,
    t.net_amount, coalesce(r.v, 0) AS refund_amount, coalesce(b.v, 0) AS chargeback_amount,
    t.status IN ('SUCCEEDED', 'REFUNDED') AS is_successful, r.v IS NOT NULL AS is_refunded, b.v IS NOT NULL AS is_disputed,
    coalesce(b.fraud, FALSE) AS is_fraudulent, t.created_at AS transaction_datetime,
    TIMESTAMP '2001-08-01 00:00:00' AS inserted_at, t.updated_at
  FROM x_transactions t LEFT JOIN (SELECT geography_key, geography_key AS nationkey FROM x_geography WHERE region <> 'AFRICA') g USING (nationkey)
   LEFT JOIN (SELECT * FROM x_customers WHERE NOT is_deleted) c ON c.customer_id = t.customer_id
    AND CAST(c.created_at AS DATE) <= CAST(t.created_at AS DATE)
  LEFT JOIN (SELECT * FROM x_merchants WHERE NOT is_deleted) m ON m.merchant_id = t.merchant_id
    AND CAST(m.created_at AS DATE) <= CAST(t.created_at AS DATE)
  LEFT JOIN x_products pr ON pr.product_key = t.transaction_id % 3 LEFT JOIN x_methods p USING (payment_method_id)
  LEFT JOIN (SELECT transaction_id, sum(amount) AS v FROM x_refunds WHERE status = 'SUCCEEDED' GROUP BY 1) r USING (transaction_id)
  LEFT JOIN (SELECT transaction_id, sum(amount) AS v, bool_or(reason_code = 'fraudulent') AS fraud FROM x_chargebacks GROUP BY 1) b
    USING (transaction_id)""")


def loaded_fact(t, last_key: int | None = None):
    """The geography dimension does not know Africa yet; customers and merchants are valid from the day they came."""
    def versions(dim):
        return dim.filter("NOT is_deleted").withColumns(
            {"effective_date": F.to_date("created_at"), "expiration_date": F.lit(None).cast("date")})

    places = t.geography().filter("region <> 'AFRICA'").select("geography_key", F.col("geography_key").alias("nationkey"))
    products = t.products().select("product_key", F.col("product_key").cast("bigint").alias("product_id"))
    return L.load_fact(t.transactions().withColumn("product_id", F.col("transaction_id") % 3), versions(t.customers()),
                       versions(t.merchants()), t.payment_methods(), t.refunds(), t.chargebacks(), places, "2001-08-01 00:00:00",
                       products, last_key)


@query("load_fact",
       "transaction_id:i transaction_key:i time_key:i customer_key:i merchant_key:i payment_method_key:i geography_key:i "
       "product_key:i amount:d processing_fee:d net_amount:d refund_amount:d chargeback_amount:d is_successful:b is_refunded:b is_disputed:b "
       "is_fraudulent:b transaction_datetime:t inserted_at:t updated_at:t", "SELECT * FROM x_loaded")
def load_fact(t):
    return loaded_fact(t, last_key=500)


@query("surrogate_key_lookup", "transaction_id:i customer_id:i customer_key:i",
       """SELECT t.*, coalesce(c.customer_key, -1) AS customer_key FROM x_transactions t
          LEFT JOIN (SELECT * FROM x_customers WHERE NOT is_deleted) c USING (customer_id)""")
def surrogate_key_lookup(t):
    return L.lookup_key(t.transactions(), t.customers().filter("NOT is_deleted"), "customer_id", "customer_key")


@query("surrogate_key_gen", "customer_id:i customer_key:i",
       """SELECT c_custkey AS customer_id, (SELECT max(s_suppkey) FROM supplier) + row_number() OVER (ORDER BY c_custkey)
            AS customer_key FROM customer""")
def surrogate_key_gen(t):
    last = t.raw("supplier").agg(F.max("s_suppkey").alias("k")).scalar()
    return dense_keys(t.customers(), "customer_id", "customer_key", last, ranges=5)


RATES = [(c, y, f"{base + step * (y - 1995):.4f}") for c, base, step in (("EUR", 1.05, 0.02), ("GBP", 1.52, 0.03))
         for y in range(1995, 2002)]


@query("currency_convert", "transaction_id:i currency:s amount:d converted_amount:d",
       f"""SELECT t.*, CASE WHEN currency = 'USD' THEN amount ELSE round(amount * rate, 2) END AS converted_amount
          FROM x_transactions t LEFT JOIN (SELECT c, y, CAST(r AS DECIMAL(9,4)) AS rate FROM (VALUES
            {', '.join(f"('{c}', {y}, '{r}')" for c, y, r in RATES)}) AS v(c, y, r)) ON c = currency AND y = year(created_at)""")
def currency_convert(t):
    rows = [(c, dt.date(y, 1, 1), dt.date(y + 1, 1, 1), r) for c, y, r in RATES]
    rates = t.spark.createDataFrame(rows, "currency string, valid_from date, valid_to date, rate string").withColumn(
        "rate", F.col("rate").cast("decimal(9,4)"))
    return L.convert_currency(t.transactions(), rates, F.to_date("created_at"))


# -- aggregates --------------------------------------------------------------------
DAILY = ("date_key:i merchant_key:i geography_key:i payment_method_key:i transaction_count:i successful_count:i failed_count:i "
         "refunded_count:i total_amount:d total_fees:d total_net:d avg_transaction_amount:r max_transaction_amount:d "
         "min_transaction_amount:d unique_customers:i")
part("x_daily", """SELECT time_key AS date_key, merchant_key, geography_key, payment_method_key, count(*) AS transaction_count,
    count(*) FILTER (is_successful) AS successful_count, count(*) FILTER (NOT is_successful) AS failed_count,
    count(*) FILTER (is_refunded) AS refunded_count, sum(amount) AS total_amount, sum(processing_fee) AS total_fees,
    sum(net_amount) AS total_net, CAST(sum(amount) AS DOUBLE) / count(*) AS avg_transaction_amount,
    max(amount) AS max_transaction_amount, min(amount) AS min_transaction_amount, count(DISTINCT customer_key) AS unique_customers
  FROM x_fact GROUP BY 1, 2, 3, 4""")


@query("refresh_daily_aggregates", DAILY, "SELECT * FROM x_daily")
def refresh_daily_aggregates(t):
    return G.daily_revenue(t.fact())


@query("overwrite_partition", "year_month:i transaction_count:i total_amount:d",
       """SELECT time_key // 100 AS year_month, count(*) AS transaction_count, sum(amount) AS total_amount FROM x_fact GROUP BY 1""")
def overwrite_partition(t):
    """The whole aggregate, then the newest month once more: the table must not change."""
    path = scratch(t.spark, "daily")
    daily = T.by_month(G.daily_revenue(t.fact()), "date_key")
    T.write_partitions(daily, path, ["year_month"], sort=["merchant_key"])
    newest = t.spark.read.parquet(path).agg(F.max("year_month").alias("m")).first()["m"]
    T.write_partitions(daily.filter(F.col("year_month") == newest), path, ["year_month"])
    return t.spark.read.parquet(path).groupBy("year_month").agg(
        F.sum("transaction_count").alias("transaction_count"), F.sum("total_amount").alias("total_amount"))


@query("calculate_monthly_metrics",
       "year_month:i merchant_key:i gross_revenue:d net_revenue:d transaction_count:i unique_customers:i new_customers:i "
       "returning_customers:i avg_order_value:r customer_lifetime_value:r churn_rate:d refund_rate:r chargeback_rate:r "
       "fraud_rate:r", "SELECT * FROM x_monthly")
def calculate_monthly_metrics(t):
    return G.monthly_metrics(t.sales())


@query("daily_merchant_summary",
       "merchant_key:i time_key:i transaction_count:i successful_count:i total_revenue:d net_revenue:d "
       "avg_transaction_amount:r unique_customers:i", "SELECT * FROM x_daily_summary")
def daily_merchant_summary(t):
    return G.daily_merchant_summary(t.sales())


@query("daily_revenue_fraud",
       "merchant_key:i time_key:i transaction_count:i total_amount:d total_fees:d unique_customers:i fraud_count:i",
       """SELECT merchant_key, time_key, count(*) AS transaction_count, sum(amount) AS total_amount,
            sum(processing_fee) AS total_fees, count(DISTINCT customer_key) AS unique_customers,
            count(*) FILTER (is_fraudulent) AS fraud_count FROM x_fact GROUP BY 1, 2""")
def daily_revenue_fraud(t):
    return G.daily_revenue_fraud(t.sales())


# -- change capture --------------------------------------------------------------------
NET = """SELECT *, CASE WHEN last_op = 1 THEN 'DELETE' WHEN first_op = 2 THEN 'INSERT' ELSE 'UPDATE' END AS change_type
  FROM (SELECT payment_id, max(lsn) AS lsn, arg_min(op, lsn) AS first_op, arg_max(op, lsn) AS last_op,
    arg_max(status, lsn) AS status, arg_max(amount, lsn) AS amount FROM x_changes WHERE op <> 3 {} GROUP BY 1)
  WHERE NOT (first_op = 2 AND last_op = 1)"""
part("x_net", NET.format(""))
part("x_net_late", NET.format(f"AND lsn >= {2 * LSN_STEP}"))


@query("cdc_changes", "payment_id:i lsn:i op:i status:s amount:d operation:s",
       f"""SELECT *, CASE op WHEN 1 THEN 'DELETE' WHEN 2 THEN 'INSERT' WHEN 3 THEN 'UPDATE_BEFORE' ELSE 'UPDATE_AFTER' END
            AS operation FROM x_changes WHERE lsn BETWEEN {2 * LSN_STEP} AND {5 * LSN_STEP}""")
def cdc_changes(t):
    return L.changes(t.change_log(), 2 * LSN_STEP, 5 * LSN_STEP)


NET_COLUMNS = "payment_id:i lsn:i status:s amount:d change_type:s"


@query("cdc_net_changes", NET_COLUMNS, "SELECT * FROM x_net")
def cdc_net_changes(t):
    return L.net_changes(t.change_log(), "payment_id")


@query("cdc_net_changes_range", NET_COLUMNS, "SELECT * FROM x_net_late")
def cdc_net_changes_range(t):
    """From the first update on: no inserts, so updates and deletes remain."""
    return L.net_changes(t.change_log(), "payment_id", from_lsn=2 * LSN_STEP)


def known_payments(t):
    """The table before the late changes: every order's payment but those above 450,000."""
    return t.raw("orders").filter("o_totalprice <= 450000").selectExpr(
        "o_orderkey AS payment_id", "'PENDING' AS status", "CAST(o_totalprice AS DECIMAL(18,2)) AS amount")


part("x_known", """SELECT o_orderkey AS payment_id, 'PENDING' AS status, CAST(o_totalprice AS DECIMAL(18,2)) AS amount
  FROM orders WHERE o_totalprice <= 450000""")


@query("apply_changes", "payment_id:i status:s amount:d",
       """SELECT * FROM x_known WHERE payment_id NOT IN (SELECT payment_id FROM x_net_late)
          UNION ALL SELECT payment_id, status, amount FROM x_net_late WHERE change_type <> 'DELETE'""")
def apply_changes(t):
    return L.apply_changes(known_payments(t), cdc_net_changes_range(t), "payment_id")


@query("apply_changes_report", "action:s rows:i",
       """SELECT CASE WHEN change_type = 'DELETE' AND k.payment_id IS NOT NULL THEN 'deleted' WHEN change_type = 'DELETE' THEN 'missing'
              WHEN k.payment_id IS NOT NULL THEN 'updated' ELSE 'inserted' END AS action, count(*) AS rows
          FROM x_net_late n LEFT JOIN x_known k USING (payment_id) GROUP BY 1""")
def apply_changes_report(t):
    return L.change_report(known_payments(t), cdc_net_changes_range(t), "payment_id")


def payments_gate(written):
    return Q.union_results(
        Q.check_rules(written, "payments", {"amount positive": "amount > 0", "status known": "status IN ('PENDING', 'SUCCEEDED')"}),
        Q.duplicate_keys(written, "payments", ["payment_id"]))


@query("dated_load", NET_COLUMNS.replace(" change_type:s", "").replace("lsn:i ", ""),
       "SELECT * FROM x_net")
def run_dated_load(t):
    """Two nights: the inserts, then everything after the watermark."""
    root, log = scratch(t.spark, "nightly"), t.change_log()
    dated_load(log, root, "2001-08-01", "payments", "payment_id", payments_gate, to_lsn=2 * LSN_STEP - 1)
    dated_load(log, root, "2001-08-02", "payments", "payment_id", payments_gate)
    return T.PublishedTable(t.spark, f"{root}/payments").read()


@query("cdc_watermark", "table_name:s last_lsn:i rows_processed:i",
       """SELECT 'payments' AS table_name, (SELECT max(lsn) FROM x_changes) AS last_lsn,
            (SELECT count(*) FROM x_net) AS rows_processed""")
def cdc_watermark(t):
    root = scratch(t.spark, "nightly")
    dated_load(t.change_log(), root, "2001-08-02", "payments", "payment_id", payments_gate, force_full=True)
    return T.PublishedTable(t.spark, f"{root}/watermarks").read()


# -- keys under load, deletes ----------------------------------------------------------------
@query("salted_key", "merchant_key:i row_count:i total_amount:d distinct_values:i",
       """SELECT merchant_key, count(*) AS row_count, sum(amount) AS total_amount, count(DISTINCT customer_key) AS distinct_values
          FROM x_fact GROUP BY 1""")
def salted_key(t):
    return L.salted_totals(t.sales(), "merchant_key", "customer_key", "amount")


@query("hot_key_report", "event_type:s row_count:i share_pct:r over_rule:b over_watch:b",
       """SELECT *, share_pct > 20 AS over_rule, share_pct > 10 AS over_watch FROM (SELECT event_type, count(*) AS row_count,
            CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM events) * 100 AS share_pct FROM events GROUP BY 1)""")
def hot_key_report(t):
    return L.hot_keys(t.events(), "event_type")


@query("soft_delete", "customer_id:i is_deleted:b deleted_at:t",
       f"""SELECT c.customer_id, is_deleted OR s.customer_id IS NOT NULL AS is_deleted,
            CASE WHEN NOT is_deleted AND s.customer_id IS NOT NULL THEN {AT} END AS deleted_at
          FROM x_customers c LEFT JOIN (SELECT customer_id FROM x_subscriptions WHERE status = 'CANCELED') s USING (customer_id)""")
def soft_delete(t):
    return L.soft_delete(t.customers(), t.subscriptions().filter("status = 'CANCELED'"), "customer_id", NOW)


# -- partitions ------------------------------------------------------------------------------
def monthly_fact_table(t):
    path = scratch(t.spark, "fact")
    T.write_partitions(T.by_month(t.sales()).select("year_month", "merchant_key", "customer_key", "amount"), path, ["year_month"],
                       sort=["merchant_key"])
    return path


@query("partitioned_scan", "year_month:i rows:i revenue:d",
       """SELECT time_key // 100 AS year_month, count(*) AS rows, sum(amount) AS revenue FROM x_fact
          WHERE time_key BETWEEN 20000101 AND 20001231 GROUP BY 1""")
def partitioned_scan(t):
    """Only the year's partitions are listed and read."""
    fact = t.spark.read.parquet(monthly_fact_table(t))
    return fact.filter(F.col("year_month").between(200001, 200012)).groupBy("year_month").agg(
        F.count("*").alias("rows"), F.sum("amount").alias("revenue"))


@query("archive_partitions", "place:s year_month:i rows:i",
       """SELECT CASE WHEN time_key // 100 < 199908 THEN 'archive' ELSE 'current' END AS place, time_key // 100 AS year_month,
            count(*) AS rows FROM x_fact GROUP BY 1, 2""")
def archive_partitions(t):
    keep, archive = scratch(t.spark, "fact-current"), scratch(t.spark, "fact-archive")
    T.archive_partitions(t.spark, monthly_fact_table(t), keep, archive, "year_month", 199908)

    def counts(path, place):
        return t.spark.read.parquet(path).groupBy("year_month").agg(F.count("*").alias("rows")).withColumn("place", F.lit(place))

    return counts(keep, "current").unionByName(counts(archive, "archive"))
