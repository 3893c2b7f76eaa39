"""Fraud features and their checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlark.operators import addresses as A
from ledgerlark.operators import features as M
from ledgerlark.operators import scoring as N
from ledgerlark.operators.ranking import latest_per_key
from ledgerlark.plans.feature_store import FeatureStore
from ledgerlark.registry import query
from ledgerlark.registry.fixture_sql import part
from ledgerlark.session import materialise, scratch

RULES = M.Rules(
    high_risk_countries=("FR",),
    holidays=("2024-01-01", "2024-01-15"),
    min_browser_version=100,
    domain_ages={"example.com": 4000},
    places={"US": (38.0, -97.0), "FR": (46.0, 2.0), "GB": (54.0, -2.0)},
)


def back(span: str) -> str:
    return (f"(PARTITION BY customer_id ORDER BY ts RANGE BETWEEN {span} PRECEDING "
            "AND INTERVAL 1 MICROSECOND PRECEDING)")


OK = "FILTER (status = 'SUCCEEDED')"

part("x_state", f"""SELECT *, epoch_us(ts) AS us,
    count(*) OVER h1 AS n_1h, count(*) OVER h24 AS n_24h, count(*) OVER d7 AS n_7d, count(*) OVER d30 AS n_30d,
    count(DISTINCT payment_method) OVER d30 AS cards, count(DISTINCT merchant_id) OVER d30 AS shops,
    count(*) {OK} OVER d7 AS ok_7d, CAST(sum(amount_minor) {OK} OVER d7 AS DOUBLE) AS sum_7d,
    stddev_samp(CAST(amount_minor AS DOUBLE)) {OK} OVER d7 AS dev_7d, max(amount_minor) {OK} OVER d30 AS max_30d,
    count(*) {OK} OVER d30 AS ok_30d, CAST(sum(amount_minor) {OK} OVER d30 AS DOUBLE) AS sum_30d,
    stddev_samp(CAST(amount_minor AS DOUBLE)) {OK} OVER d30 AS dev_30d,
    list(amount_minor) OVER d30 AS amounts,
    list(ip_country) OVER h24 AS countries, arg_max(ip_country, ts) OVER ever AS last_country, max(ts) OVER ever AS last_ts,
    list(hour(ts)) OVER ever AS hours, count(*) OVER ever AS n_all, count(*) {OK} OVER ever AS ok_all,
    sum(amount_minor) OVER ever AS sum_all,
    min(ts) OVER (PARTITION BY customer_id, device_fingerprint) AS device_ts
  FROM x_payments
  WINDOW h1 AS {back('INTERVAL 1 HOUR')}, h24 AS {back('INTERVAL 24 HOUR')}, d7 AS {back('INTERVAL 7 DAY')},
    d30 AS {back('INTERVAL 30 DAY')}, ever AS {back('UNBOUNDED')}""")

part("x_disputed", """SELECT d.payment_id, d.opened_at, q.customer_id, q.merchant_id, q.ts AS paid_at
  FROM x_disputes d JOIN x_payments q USING (payment_id)""")


def disputed(key: str) -> str:
    return f"""SELECT p.payment_id, count(d.payment_id) AS disputes, count(DISTINCT d.payment_id) AS known,
        count(DISTINCT d.payment_id) FILTER (d.paid_at >= p.ts - INTERVAL 30 DAY) AS recent
      FROM x_payments p LEFT JOIN x_disputed d ON d.{key} = p.{key} AND d.opened_at < p.ts GROUP BY 1"""


def floor_days(a: str, b: str) -> str:
    return f"greatest(CAST(floor((epoch_us({b}) - epoch_us({a})) / 86400000000) AS BIGINT), 0)"


VELOCITY = """n_1h AS transaction_count_1h, n_24h AS transaction_count_24h, n_7d AS transaction_count_7d,
  n_30d AS transaction_count_30d, cards AS unique_cards_30d, shops AS unique_merchants_30d"""
AVG = "CASE WHEN ok_7d > 0 THEN sum_7d / ok_7d ELSE CAST(amount_minor AS DOUBLE) END"
DEV = "coalesce(dev_7d, 0)"
AMOUNT = f"""{AVG} / 100 AS avg_amount_7d, {DEV} / 100 AS stddev_amount_7d,
  coalesce(max_30d, amount_minor) / 100.0 AS max_amount_30d,
  CASE WHEN {AVG} > 0 THEN amount_minor / ({AVG}) ELSE 1 END AS amount_ratio_to_avg,
  CASE WHEN {DEV} > 0 THEN (amount_minor - ({AVG})) / {DEV} ELSE 0 END AS amount_zscore,
  CAST(amount_minor % 100 = 0 AS INT) AS round_amount, CAST(amount_minor > 1000000 AS INT) AS high_value_flag,
  CASE WHEN n_30d > 0 THEN CAST(len([x FOR x IN amounts IF x <= amount_minor]) AS DOUBLE) / n_30d
    ELSE 0.5 END AS amount_percentile"""
LAT = "CASE {} WHEN 'US' THEN 38.0 WHEN 'FR' THEN 46.0 ELSE 54.0 END"
LON = "CASE {} WHEN 'US' THEN -97.0 WHEN 'FR' THEN 2.0 ELSE -2.0 END"
HAV = (f"(pow(sin(radians(({LAT.format('ip_country')}) - ({LAT.format('last_country')})) / 2), 2) + "
       f"cos(radians({LAT.format('last_country')})) * cos(radians({LAT.format('ip_country')})) * "
       f"pow(sin(radians(({LON.format('ip_country')}) - ({LON.format('last_country')})) / 2), 2))")
KM = f"CASE WHEN last_country IS NULL THEN 0 ELSE 6371.0 * 2 * atan2(sqrt({HAV}), sqrt(1 - {HAV})) END"
GAP = "((us - epoch_us(last_ts)) / 3600000000.0)"
GEO = f"""CAST(card_country <> ip_country AS INT) AS card_country_mismatch,
  CAST(ip_country <> billing_country AS INT) AS ip_country_mismatch, {KM} AS distance_km,
  CASE WHEN {GAP} > 0 THEN ({KM}) / {GAP} ELSE 0 END AS velocity_km_per_hour,
  CAST(ip_country = 'FR' AS INT) AS high_risk_country,
  CAST(len([x FOR x IN coalesce(countries, []) IF x <> ip_country]) > 0 AS INT) AS country_change_24h,
  CASE WHEN n_all = 0 THEN 0 ELSE CAST(CAST(len([x FOR x IN hours IF x = hour(ts)]) AS DOUBLE) / n_all < 0.05 AS INT) END
    AS timezone_anomaly"""
DOMAIN = "split_part(s.email, '@', 2)"
DEVICE = f"""{floor_days('device_ts', 'ts')} AS device_fingerprint_age_days,
  CAST({floor_days('device_ts', 'ts')} < 1 AS INT) AS device_fingerprint_new,
  CASE {DOMAIN} WHEN 'example.com' THEN 4000 ELSE 365 END AS email_domain_age_days,
  CAST({DOMAIN} IN ('gmail.com', 'yahoo.com', 'hotmail.com', 'outlook.com', 'aol.com') AS INT) AS email_domain_free,
  CAST({DOMAIN} IN ('tempmail.com', '10minutemail.com', 'guerrillamail.com') AS INT) AS email_domain_disposable,
  CAST(CAST(regexp_extract(user_agent, 'Chrome/(\\d+)', 1) AS INT) < 100 AS INT) AS browser_version_outdated"""
AGE = floor_days("c.created_at", "ts")
CUSTOMER = f"""coalesce({AGE}, 0) AS customer_age_days, CAST(n_all = 0 AS INT) AS first_transaction_customer,
  k.disputes AS customer_dispute_history, CASE WHEN n_all > 0 THEN CAST(ok_all AS DOUBLE) / n_all ELSE 0 END
    AS customer_success_rate, CASE WHEN last_ts IS NULL THEN 9999 ELSE {floor_days('last_ts', 'ts')} END AS days_since_last_transaction,
  coalesce(sum_all, 0) / 100.0 AS customer_lifetime_value,
  CASE WHEN {AGE} > 0 THEN n_all / (CAST({AGE} AS DOUBLE) / 30) ELSE 0 END AS avg_transaction_per_month,
  CASE WHEN n_30d > 0 THEN CAST(k.recent AS DOUBLE) / n_30d ELSE 0 END AS chargeback_rate_30d"""
CONTEXT = """hour(ts) AS time_of_day, (dayofweek(ts) + 6) % 7 AS day_of_week,
  CAST((dayofweek(ts) + 6) % 7 >= 5 AS INT) AS is_weekend,
  CAST(CAST(ts AS DATE) IN (DATE '2024-01-01', DATE '2024-01-15') AS INT) AS is_holiday,
  CAST(shipping_address IS DISTINCT FROM billing_address AS INT) AS shipping_address_mismatch"""
SINCE = floor_days("m.created_at", "ts")
MERCHANT = f"""coalesce({SINCE}, 0) AS merchant_age_days,
  CASE WHEN w.n > 0 THEN CAST(k2.recent AS DOUBLE) / w.n ELSE 0 END AS merchant_dispute_rate_30d,
  CASE WHEN w.n_ever > 0 THEN CAST(k2.known AS DOUBLE) / w.n_ever ELSE 0 END AS merchant_chargeback_rate,
  CASE WHEN w.n > 0 THEN CAST(w.total AS DOUBLE) / w.n / 100 ELSE 0 END AS merchant_avg_ticket,
  CASE WHEN lower(industry) IN ('gambling', 'cryptocurrency', 'adult_content') THEN 2
       WHEN lower(industry) IN ('travel', 'electronics', 'jewelry') THEN 1 ELSE 0 END AS merchant_industry_risk"""
OF_CUSTOMER = f"LEFT JOIN x_customers c USING (customer_id) JOIN ({disputed('customer_id')}) k USING (payment_id)"
OF_MERCHANT = f"""LEFT JOIN x_merchants m USING (merchant_id) JOIN ({disputed('merchant_id')}) k2 USING (payment_id)
  JOIN (SELECT payment_id, count(*) OVER r AS n, sum(amount_minor) OVER r AS total, count(*) OVER e AS n_ever FROM x_payments
    WINDOW r AS (PARTITION BY merchant_id ORDER BY ts RANGE BETWEEN INTERVAL 30 DAY PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING),
      e AS (PARTITION BY merchant_id ORDER BY ts RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING)) w
    USING (payment_id)"""


def bind(group: str, columns: str, select: str, joins: str = ""):
    @query(f"feat_{group}", "payment_id:i " + columns, f"SELECT payment_id, {select} FROM x_state s {joins}")
    def run(t):
        return M.group(group, t.payments(), t.disputes(), t.customers(), t.merchants(), RULES)

    return columns


COLUMNS = [
    bind("velocity", "transaction_count_1h:i transaction_count_24h:i transaction_count_7d:i transaction_count_30d:i "
                     "unique_cards_30d:i unique_merchants_30d:i", VELOCITY),
    bind("amount", "avg_amount_7d:r stddev_amount_7d:r max_amount_30d:r amount_ratio_to_avg:r amount_zscore:r "
                   "round_amount:i high_value_flag:i amount_percentile:r", AMOUNT),
    bind("geo", "card_country_mismatch:i ip_country_mismatch:i distance_km:r velocity_km_per_hour:r high_risk_country:i "
                "country_change_24h:i timezone_anomaly:i", GEO),
    bind("device_email", "device_fingerprint_age_days:i device_fingerprint_new:i email_domain_age_days:i "
                         "email_domain_free:i email_domain_disposable:i browser_version_outdated:i", DEVICE),
    bind("customer", "customer_age_days:i first_transaction_customer:i customer_dispute_history:i customer_success_rate:r "
                     "days_since_last_transaction:i customer_lifetime_value:r avg_transaction_per_month:r "
                     "chargeback_rate_30d:r", CUSTOMER, OF_CUSTOMER),
    bind("merchant", "merchant_age_days:i merchant_dispute_rate_30d:r merchant_chargeback_rate:r merchant_avg_ticket:r "
                     "merchant_industry_risk:i", MERCHANT, OF_MERCHANT),
    bind("context", "time_of_day:i day_of_week:i is_weekend:i is_holiday:i shipping_address_mismatch:i", CONTEXT),
]

part("x_vector", f"""SELECT payment_id, customer_id, merchant_id, ts, amount_minor, {VELOCITY}, {AMOUNT}, {GEO}, {DEVICE},
    {CUSTOMER}, {MERCHANT}, {CONTEXT},
    CASE WHEN ok_30d > 0 THEN sum_30d / ok_30d ELSE CAST(amount_minor AS DOUBLE) END / 100 AS avg_amount_30d,
    coalesce(dev_30d, 0) / 100 AS stddev_amount_30d,
    CAST(floor((us - epoch_us(last_ts)) / 1000000) AS BIGINT) AS time_since_last_seconds
  FROM x_state s {OF_CUSTOMER} {OF_MERCHANT}""")


def vector(t):
    return M.feature_vector(t.payments(), t.disputes(), t.customers(), t.merchants(), RULES)


query("feature_vector", "payment_id:i " + " ".join(COLUMNS), "SELECT * FROM x_vector")(vector)

# Score used where no trained model is given: the additive risk formula of ``scoring``.
RISK = """0.01 + 0.15 * card_country_mismatch + 0.20 * ip_country_mismatch + 0.10 * device_fingerprint_new
  + 0.15 * email_domain_disposable + 0.10 * high_risk_country
  + 0.05 * CASE WHEN velocity_km_per_hour > 500 THEN 1 ELSE 0 END"""
part("x_risk", f"SELECT *, least(greatest({RISK}, 0.0), 1.0) AS risk FROM x_vector")
part("x_documents", """SELECT 'feat_' || payment_id AS feature_id, payment_id, customer_id, merchant_id, ts AS computed_at,
    risk AS fraud_score, CASE WHEN risk >= 0.7 THEN 'high' WHEN risk >= 0.4 THEN 'medium' ELSE 'low' END AS risk_level,
    transaction_count_1h AS velocity_1h, transaction_count_24h AS velocity_24h, avg_amount_30d, stddev_amount_30d,
    card_country_mismatch = 1 AS card_mismatch, ip_country_mismatch = 1 AS ip_mismatch,
    customer_dispute_history, time_since_last_seconds, 15552000 AS ttl FROM x_risk""")


def documents(t):
    return M.feature_document(vector(t), N.risk_probability(), "rules-1")


_stores: dict[tuple[str, str], FeatureStore] = {}


def document_store(t) -> FeatureStore:
    """The documents of all payments, computed and stored at their first use in a session."""
    place = (t.spark.sparkContext.applicationId, t.path)
    if place not in _stores:
        store = FeatureStore(t.spark, scratch(t.spark, "documents"), buckets=8)
        store.upsert(documents(t), 1)
        _stores[place] = store
    return _stores[place]


@query("feature_store_payments", "payment_id:i customer_id:i fraud_score:r risk_level:s computed_at:t", "SELECT * FROM x_documents")
def feature_store_payments(t):
    """A first batch with scores of yesterday, then all documents again; both written, the later computation of each payment read."""
    found = materialise(documents(t), "documents")
    store = FeatureStore(t.spark, scratch(t.spark, "documents"), buckets=8)
    store.upsert(found.withColumn("computed_at", F.expr("computed_at - INTERVAL 1 DAY")).withColumn("fraud_score", F.col("fraud_score") * 0), 2)
    store.upsert(found, 1)
    return store.read()


@query("feature_document",
       "feature_id:s payment_id:i customer_id:i merchant_id:i computed_at:t fraud_score:r risk_level:s velocity_1h:i "
       "velocity_24h:i avg_amount_30d:r stddev_amount_30d:r card_mismatch:b ip_mismatch:b customer_dispute_history:i "
       "time_since_last_seconds:i ttl:i",
       "SELECT * FROM x_documents")
def feature_document(t):
    return documents(t).select(
        "feature_id", "payment_id", "customer_id", "merchant_id", "computed_at", "fraud_score", "risk_level", "ttl",
        F.col("features.transaction_velocity_1h").alias("velocity_1h"),
        F.col("features.transaction_velocity_24h").alias("velocity_24h"),
        F.col("features.avg_transaction_amount_30d").alias("avg_amount_30d"),
        F.col("features.transaction_amount_stddev_30d").alias("stddev_amount_30d"),
        F.col("features.card_country_mismatch").alias("card_mismatch"),
        F.col("features.ip_country_mismatch").alias("ip_mismatch"),
        "features.customer_dispute_history",
        F.col("features.time_since_last_transaction_seconds").alias("time_since_last_seconds"),
    )


@query("feature_store_upsert", "customer_id:i computed_at:t profile_score:i",
       """SELECT customer_id, max(computed_at) AS computed_at, arg_max(profile_score, computed_at) AS profile_score
          FROM x_snapshots GROUP BY 1""")
def feature_store_upsert(t):
    """Latest computed version of every key wins."""
    return latest_per_key(t.snapshots(), ["customer_id"], "computed_at", "profile_score")


@query("feat_time_since_last", "payment_id:i customer_id:i time_since_last_seconds:i",
       """SELECT payment_id, customer_id, CAST(floor((epoch_us(ts) - epoch_us(lag(ts) OVER (
            PARTITION BY customer_id ORDER BY ts))) / 1000000) AS BIGINT) AS time_since_last_seconds FROM x_payments""")
def time_since_last(t):
    return M.time_since_last(t.payments(), hot_rows=0)


# -- places of addresses ----------------------------------------------------------------------
ADDRESS = """CASE payment_id % 3 WHEN 0 THEN concat('2001:db8:', lower(hex(payment_id % 30)), ':', lower(hex(payment_id % 65536)), '::7')
  ELSE concat('10.', payment_id % 30, '.', payment_id % 256, '.7') END"""


def addressed(t):
    return t.payments().withColumn("ip_address", F.expr(ADDRESS))


def networks(t):
    """A network per nation in each family, and one of a city inside the first of every other nation."""
    return t.raw("nation").selectExpr("n_name AS country", "n_nationkey AS k").selectExpr("country", """inline(filter(array(
        named_struct('network', concat('10.', k, '.0.0/16'), 'latitude', k * 1D, 'longitude', k * 2D),
        named_struct('network', concat('2001:db8:', lower(hex(k)), '::/48'), 'latitude', k * 1D, 'longitude', k * 2D),
        CASE WHEN k % 2 = 0 THEN named_struct('network', concat('10.', k, '.64.0/18'), 'latitude', k + 0.5D, 'longitude', k * 2D) END),
        x -> x IS NOT NULL))""")


part("x_located", """SELECT p.*, n_name AS country, CAST(n_nationkey AS DOUBLE) + CASE WHEN p.payment_id % 3 <> 0 AND n_nationkey % 2 = 0
    AND p.payment_id % 256 BETWEEN 64 AND 127 THEN 0.5 ELSE 0 END AS latitude, CAST(n_nationkey * 2 AS DOUBLE) AS longitude
  FROM x_payments p LEFT JOIN nation ON n_nationkey = p.payment_id % 30""")


@query("locate", "payment_id:i country:s latitude:d longitude:d", "SELECT * FROM x_located")
def locate(t):
    return A.locate_networks(addressed(t), networks(t), ["country", "latitude", "longitude"])


@query("feat_geo_located", "payment_id:i distance_km:r",
       """SELECT payment_id, coalesce(6371 * 2 * atan2(sqrt(h), sqrt(1 - h)), 0) AS distance_km FROM (
            SELECT payment_id, sin(radians(latitude - la) / 2) ** 2 + cos(radians(la)) * cos(radians(latitude)) * sin(radians(longitude - lo) / 2) ** 2 AS h
            FROM (SELECT *, lag(latitude) OVER w AS la, lag(longitude) OVER w AS lo FROM x_located WINDOW w AS (PARTITION BY customer_id ORDER BY ts)))""")
def feat_geo_located(t):
    """Kilometres from the place of the customer's payment before, by addresses."""
    placed = A.locate_networks(addressed(t), networks(t), ["latitude", "longitude"])
    return M.group("geo", placed, t.disputes(), t.customers(), t.merchants(), RULES)
