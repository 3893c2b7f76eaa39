"""Single building blocks that no report isolates, and their checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlark import schemas
from ledgerlark.functions import expr as X
from ledgerlark.operators import ranking as R
from ledgerlark.operators import timeslice as S
from ledgerlark.operators.scoring import latency_percentiles
from ledgerlark.registry import query
from ledgerlark.session import scratch
from ledgerlark.sources import tables as T
from ledgerlark.sources.driver_tables import AS_OF_ORDERS


@query("ttl_filter", "log_id:i ts:t", "SELECT log_id, ts FROM x_logs WHERE ts >= TIMESTAMP '2024-04-15 00:00:00' - INTERVAL 90 DAY")
def ttl_filter(t):
    return T.within_ttl(t.api_logs(), "api_logs", "ts", "2024-04-15 00:00:00")


ANALYST = {"analyst": ("customer_key", "full_name", "nationkey")}


@query("column_projection_by_role", "customer_key:i full_name:s nationkey:i",
       "SELECT customer_key, full_name, nationkey FROM x_customers")
def column_projection_by_role(t):
    return T.project_for_role(t.customers(), "analyst", ANALYST)


@query("row_filter_by_tenant", "merchant_key:i time_key:i amount:d",
       "SELECT * FROM x_fact WHERE merchant_key = (SELECT max(s_suppkey) FROM supplier)")
def row_filter_by_tenant(t):
    """The newest merchant sees its own rows."""
    newest = t.raw("supplier").agg(F.max("s_suppkey").alias("k")).scalar()
    return T.rows_of_tenant(t.sales(), "merchant_key", newest)


@query("pit_feature_asof", "payment_id:i customer_id:i ts:t computed_at:t profile_score:i",
       """SELECT p.payment_id, p.customer_id, p.ts, s.computed_at, s.profile_score
          FROM x_payments p ASOF LEFT JOIN x_snapshots s ON p.customer_id = s.customer_id AND p.ts >= s.computed_at""")
def pit_feature_asof(t):
    """Every customer is sliced over time here, as a busy one would be."""
    snapshots = t.snapshots().withColumn("at", F.col("computed_at"))
    return S.asof_join(t.payments(), snapshots, ["customer_id"], "ts", "at", ["computed_at", "profile_score"],
                       tiebreak="profile_score", hot_rows=0)


@query("percentile_cont", "merchant_id:i endpoint:s requests:i p99:r",
       """SELECT merchant_id, endpoint, count(*) AS requests, quantile_cont(latency_ms, 0.99) AS p99 FROM x_logs GROUP BY 1, 2""")
def percentile_cont(t):
    return latency_percentiles(t.api_logs(), ["merchant_id", "endpoint"], "latency_ms", {"p99": 0.99})


@query("multi_dim_cube", "region:s merchant_tier:s level:i revenue:d transaction_count:i",
       """SELECT region, merchant_tier, grouping_id(region, merchant_tier) AS level, sum(amount) AS revenue,
            count(*) AS transaction_count
          FROM x_fact JOIN x_geography USING (geography_key) JOIN x_merchants USING (merchant_key)
          GROUP BY CUBE (region, merchant_tier)""")
def multi_dim_cube(t):
    """Totals per (geography, merchant) first, so the cube expands few rows."""
    totals = t.fact().groupBy("geography_key", "merchant_key").agg(F.sum("amount").alias("v"), F.count("*").alias("n"))
    named = totals.join(t.geography().select("geography_key", "region"), "geography_key").join(
        t.merchants().select("merchant_key", "merchant_tier"), "merchant_key")
    return named.cube("region", "merchant_tier").agg(
        F.grouping_id().alias("level"), F.sum("v").alias("revenue"), F.sum("n").alias("transaction_count"))


@query("approx_distinct", "merchant_id:i customers:i customers_close:b payments_close:b",
       """SELECT merchant_id, count(DISTINCT customer_id) AS customers, TRUE AS customers_close, TRUE AS payments_close
          FROM x_transactions GROUP BY 1""")
def approx_distinct(t):
    """The estimates next to exact counts: within 5 %, or 3 for small counts."""
    def close(estimate, exact):
        return F.abs(F.col(estimate) - F.col(exact)) <= F.greatest(0.05 * F.col(exact), F.lit(3))

    rows = t.transactions()
    pairs = rows.groupBy("merchant_id", "customer_id").agg(F.count("transaction_id").alias("payments"))
    exact = pairs.groupBy("merchant_id").agg(F.count("customer_id").alias("customers"), F.sum("payments").alias("payments"))
    estimates = R.distinct_estimates(rows, ["merchant_id"], {"about_customers": "customer_id", "about_payments": "transaction_id"})
    return exact.join(estimates.withColumnRenamed("merchant_id", "_m"), F.col("merchant_id").eqNullSafe(F.col("_m"))).select(
        "merchant_id", "customers", close("about_customers", "customers").alias("customers_close"),
        close("about_payments", "payments").alias("payments_close"))


BACK = "(PARTITION BY customer_id ORDER BY ts RANGE BETWEEN INTERVAL {} PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING)"


@query("rolling_range_count", "payment_id:i n_1h:i n_24h:i n_7d:i amount_24h:i max_24h:i",
       f"""SELECT payment_id, count(*) OVER h1 AS n_1h, count(*) OVER h24 AS n_24h, count(*) OVER d7 AS n_7d,
            coalesce(sum(amount_minor) OVER h24, 0) AS amount_24h, max(amount_minor) OVER h24 AS max_24h
          FROM x_payments WINDOW h1 AS {BACK.format('1 HOUR')}, h24 AS {BACK.format('24 HOUR')}, d7 AS {BACK.format('7 DAY')}""")
def rolling_range_count(t):
    """Sums by expiry and maxima by slices, with every customer sliced."""
    p = t.payments()
    sums = S.rolling_sums(p, ["customer_id"], "ts", "payment_id", {
        "n_1h": ("1", 3600), "n_24h": ("1", 86400), "n_7d": ("1", 7 * 86400), "amount_24h": ("amount_minor", 86400)}, hot_rows=0)
    return sums.join(S.rolling_max(p, ["customer_id"], "ts", "payment_id", F.col("amount_minor"), 86400, "max_24h"), "payment_id")


@query("rolling_distinct", "payment_id:i methods_7d:i merchants_30d:i",
       f"""SELECT payment_id, count(DISTINCT payment_method) OVER d7 AS methods_7d,
            count(DISTINCT merchant_id) OVER d30 AS merchants_30d
          FROM x_payments WINDOW d7 AS {BACK.format('7 DAY')}, d30 AS {BACK.format('30 DAY')}""")
def rolling_distinct(t):
    return S.rolling_distinct(t.payments(), ["customer_id"], "ts", "payment_id", {
        "methods_7d": ("payment_method", 7 * 86400), "merchants_30d": ("merchant_id", 30 * 86400)}, hot_rows=0)


@query("latest_per_key", "customer_id:i payment_id:i ts:t ip_country:s",
       """SELECT customer_id, arg_max(payment_id, ts) AS payment_id, max(ts) AS ts, arg_max(ip_country, ts) AS ip_country
          FROM x_payments GROUP BY 1""")
def latest_per_key(t):
    return R.latest_per_key(t.payments().select("customer_id", "payment_id", "ts", "ip_country"), ["customer_id"], "ts",
                            "payment_id")


@query("top_n_per_group", "merchant_id:i customer_id:i total:d position:i",
       """SELECT * FROM (SELECT merchant_id, customer_id, sum(amount) AS total,
            row_number() OVER (PARTITION BY merchant_id ORDER BY sum(amount) DESC, customer_id) AS position
          FROM x_transactions GROUP BY 1, 2) WHERE position <= 3""")
def top_n_per_group(t):
    spend = t.transactions().groupBy("merchant_id", "customer_id").agg(F.sum("amount").alias("total"))
    return R.top_n_per_group(spend, ["merchant_id"], 3, F.desc("total"), F.asc("customer_id"))


@query("paged_scan", "log_id:i merchant_id:i endpoint:s",
       """SELECT * FROM x_logs WHERE log_id > (SELECT CAST(floor(avg(event_id)) AS BIGINT) FROM events) ORDER BY log_id LIMIT 100""")
def paged_scan(t):
    """The page that follows the middle of the ids."""
    middle = t.events().agg(F.floor(F.avg("event_id")).alias("k")).scalar()
    return R.page_after(t.api_logs(), "log_id", middle, 100)


@query("point_lookup_by_intent", "transaction_id:i payment_intent_id:s amount:d",
       """SELECT * FROM x_transactions WHERE payment_intent_id = (SELECT max(payment_intent_id) FROM x_transactions)""")
def point_lookup_by_intent(t):
    rows = t.transactions()
    return rows.filter(F.col("payment_intent_id") == rows.agg(F.max("payment_intent_id").alias("k")).scalar())


@query("hours_and_weeks", "transaction_id:i hours:i week:i weekday:i",
       f"""SELECT transaction_id, date_diff('hour', created_at, TIMESTAMP '{AS_OF_ORDERS}') AS hours,
            CAST(floor((dayofyear(created_at) - 1 + dayofweek(date_trunc('year', created_at))) / 7) + 1 AS BIGINT) AS week,
            dayofweek(created_at) + 1 AS weekday FROM x_transactions""")
def hours_and_weeks(t):
    """Date arithmetic with the reference dialect's meaning: boundaries crossed, weeks from 1 January."""
    at = F.to_date("created_at")
    return t.transactions().select("transaction_id", X.hour_boundaries("created_at", X.ts(AS_OF_ORDERS)).alias("hours"),
                                   X.week_from_jan1(at).alias("week"), F.dayofweek(at).alias("weekday"))


@query("scan_json_docs", "log_id:s merchant_id:s timestamp:t endpoint:s status_code:i latency_ms:i payment:s k:i",
       """SELECT log_id, merchant_id, ts AS timestamp, endpoint, status_code, latency_ms,
            request_body ->> '$.payment' AS payment, request_body ->> '$.props.k' AS k FROM x_logs""")
def scan_json_docs(t):
    """The logs written as JSON documents and read with the declared schema; the body is free-form."""
    path = scratch(t.spark, "documents")
    docs = t.api_logs().withColumnRenamed("ts", "timestamp").withColumn("request_body", F.parse_json("request_body"))
    docs.write.option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").json(path)
    read = T.scan_documents(t.spark, path, schemas.DOCUMENTS["api_logs"], multiline=False)
    return read.withColumns({"payment": F.variant_get("request_body", "$.payment", "string"),
                             "k": F.variant_get("request_body", "$.props.k", "bigint")})


@query("replace_staging", "status:s payments:i amount:d",
       "SELECT status, count(*) AS payments, sum(amount) AS amount FROM x_transactions WHERE status <> 'SUCCEEDED' GROUP BY status")
def replace_staging(t):
    """A staging table that held all payments, emptied and filled with those that did not succeed."""
    path = scratch(t.spark, "staged")
    rows = t.transactions().select("transaction_id", "status", "amount")
    T.replace_staging(rows, path)
    T.replace_staging(rows.filter("status <> 'SUCCEEDED'"), path)
    return T.scan(t.spark, path, rows.schema).groupBy("status").agg(F.count("*").alias("payments"), F.sum("amount").alias("amount"))


@query("staging_folders", "run_date:s transaction_id:i amount:d",
       """SELECT CAST(CAST(date_trunc('month', created_at) AS DATE) AS VARCHAR) AS run_date, transaction_id, amount
          FROM x_transactions""")
def staging_folders(t):
    """Everything landed under its month, the newest month once more, and read back as one folder."""
    path = scratch(t.spark, "staging")
    rows = t.transactions().select(F.trunc("created_at", "MONTH").alias("run_date"), "transaction_id", "amount")
    T.write_partitions(rows, path, ["run_date"])
    newest = rows.agg(F.max("run_date").alias("d")).first()["d"]
    T.append_staging(rows.filter(F.col("run_date") == newest).drop("run_date"), path, newest.isoformat())
    files = T.read_folder(t.spark, path, "transaction_id BIGINT, amount DECIMAL(18,2)")
    return files.withColumn("run_date", F.regexp_extract(F.input_file_name(), r"run_date=([0-9-]+)", 1))
