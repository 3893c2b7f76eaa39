"""Star-schema reports and their checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlark.plans import analytics as A
from ledgerlark.plans.calendar import build_dim_time
from ledgerlark.plans.stored import StoredAggregates, days_of
from ledgerlark.registry import query
from ledgerlark.registry.fixture_sql import part
from ledgerlark.session import scratch
from ledgerlark.sources.driver_tables import AS_OF_ORDERS

RATES = """CAST(count(*) FILTER (is_successful) AS DOUBLE) / nullif(CAST(count(*) AS DOUBLE), 0) * 100 AS success_rate,
  CAST(count(*) FILTER (is_refunded) AS DOUBLE) / nullif(CAST(count(*) FILTER (is_successful) AS DOUBLE), 0) * 100 AS refund_rate,
  CAST(count(*) FILTER (is_disputed) AS DOUBLE) / nullif(CAST(count(*) FILTER (is_successful) AS DOUBLE), 0) * 100 AS chargeback_rate,
  CAST(count(*) FILTER (is_fraudulent) AS DOUBLE) / nullif(CAST(count(*) AS DOUBLE), 0) * 100 AS fraud_rate"""


def calendar(t):
    return build_dim_time(t.spark, 1994, 2003)


_stored: dict[tuple[str, str], StoredAggregates] = {}


def stored(t) -> StoredAggregates:
    """The stored aggregates of the given tables, made at their first use in a session. The bench times that apart."""
    place = (t.spark.sparkContext.applicationId, t.path)
    if place not in _stored:
        made = StoredAggregates(t.spark, scratch(t.spark, "aggregates"))
        made.refresh(t.fact())
        _stored[place] = made
    return _stored[place]


@query("olap_monthly_revenue_yoy",
       "year:i month:i month_name:s gross_revenue:d net_revenue:d transaction_count:i unique_customers:i "
       "prev_year_revenue:d yoy_growth_rate:r",
       """SELECT *, CASE WHEN prev_year_revenue > 0 THEN (CAST(gross_revenue AS DOUBLE) / prev_year_revenue - 1) * 100 END
            AS yoy_growth_rate
          FROM (SELECT *, lag(gross_revenue, 12) OVER (ORDER BY year, month) AS prev_year_revenue FROM (
            SELECT year, month, monthname(full_date) AS month_name, sum(amount) AS gross_revenue,
              sum(net_amount) AS net_revenue, count(*) AS transaction_count,
              count(DISTINCT customer_key) AS unique_customers
            FROM x_fact WHERE is_successful AND year >= 1995 GROUP BY ALL))""")
def monthly_revenue_yoy(t):
    return A.monthly_revenue_yoy(t.sales(), calendar(t), 1995)


@query("olap_revenue_by_geography",
       "continent:s region:s country_name:s currency_code:s total_revenue:d transaction_count:i unique_customers:i "
       "unique_merchants:i avg_transaction_value:r pct_of_total_revenue:r revenue_rank:i",
       """SELECT *, CAST(total_revenue AS DOUBLE) / CAST(sum(total_revenue) OVER () AS DOUBLE) * 100 AS pct_of_total_revenue,
            rank() OVER (ORDER BY total_revenue DESC) AS revenue_rank
          FROM (SELECT continent, region, country_name, currency_code, sum(amount) AS total_revenue,
            count(*) AS transaction_count, count(DISTINCT customer_key) AS unique_customers,
            count(DISTINCT merchant_key) AS unique_merchants,
            CAST(sum(amount) AS DOUBLE) / count(*) AS avg_transaction_value
          FROM x_fact JOIN x_geography USING (geography_key)
          WHERE is_successful AND time_key >= 20000101 GROUP BY ALL)""")
def revenue_by_geography(t):
    return A.revenue_by_geography(t.fact(), t.geography(), 20000101)


@query("olap_revenue_by_tier_industry",
       "merchant_tier:s industry:s industry_group:s merchant_count:i total_revenue:d avg_transaction_value:r revenue_per_merchant:r "
       "market_share_pct:r",
       """SELECT *, CAST(total_revenue AS DOUBLE) / merchant_count AS revenue_per_merchant,
            CAST(total_revenue AS DOUBLE) / CAST(sum(total_revenue) OVER () AS DOUBLE) * 100 AS market_share_pct
          FROM (SELECT merchant_tier, industry, industry_group, count(DISTINCT f.merchant_key) AS merchant_count,
            sum(amount) AS total_revenue, CAST(sum(amount) AS DOUBLE) / count(*) AS avg_transaction_value
          FROM x_fact f JOIN x_merchants m ON f.merchant_key = m.merchant_key
          WHERE is_successful AND time_key >= 20000101 GROUP BY ALL)""")
def revenue_by_tier_industry(t):
    return A.revenue_by_tier_industry(t.sales(), t.merchants(), 20000101)


@query("olap_customer_segmentation",
       "customer_segment:s customer_count:i avg_lifetime_value:r avg_transaction_count:r avg_order_value:r "
       "avg_days_since_purchase:r high_value_customers:i active_customers:i at_risk_customers:i",
       """SELECT customer_segment, count(*) AS customer_count,
            CAST(sum(spent) AS DOUBLE) / count(*) AS avg_lifetime_value,
            CAST(sum(n) AS DOUBLE) / count(*) AS avg_transaction_count, avg(CAST(spent AS DOUBLE) / n) AS avg_order_value,
            CAST(sum(idle) AS DOUBLE) / count(*) AS avg_days_since_purchase,
            count(*) FILTER (spent > 10000) AS high_value_customers, count(*) FILTER (idle <= 30) AS active_customers,
            count(*) FILTER (idle > 90) AS at_risk_customers
          FROM (SELECT customer_key, count(*) AS n, sum(amount) AS spent,
              date_diff('day', max(full_date), DATE '2001-08-02') AS idle
            FROM x_fact WHERE is_successful GROUP BY customer_key)
          JOIN x_customers USING (customer_key) GROUP BY customer_segment""")
def customer_segmentation(t):
    return A.customer_segmentation(t.sales(), t.customers(), calendar(t), AS_OF_ORDERS)


@query("olap_cohort_retention", "cohort_month:i months_since_cohort:i active_customers:i retention_rate:r",
       """SELECT cohort_month, gap AS months_since_cohort, n AS active_customers,
            CAST(n AS DOUBLE) / first_value(n) OVER (PARTITION BY cohort_month ORDER BY gap) * 100 AS retention_rate
          FROM (SELECT first_day // 100 AS cohort_month,
              (year * 12 + month) - (first_day // 10000 * 12 + first_day // 100 % 100) AS gap,
              count(DISTINCT customer_key) AS n
            FROM x_fact JOIN (SELECT customer_key, min(time_key) AS first_day FROM x_fact WHERE is_successful GROUP BY 1)
              USING (customer_key)
            WHERE is_successful GROUP BY 1, 2)
          WHERE gap <= 12""")
def cohort_retention(t):
    return A.cohort_retention(t.sales())


@query("olap_churn_indicators",
       "customer_key:i full_name:s email:s customer_segment:s total_transactions:i total_spent:d last_transaction_date:s "
       "days_inactive:i avg_days_between_purchases:r revenue_this_year:d revenue_last_year:d yoy_revenue_change:r churn_risk:s",
       """SELECT a.*, c.full_name, c.email, c.customer_segment,
            CASE WHEN revenue_last_year > 0 THEN (CAST(revenue_this_year AS DOUBLE) / CAST(revenue_last_year AS DOUBLE) - 1) * 100
              END AS yoy_revenue_change,
            CASE WHEN days_inactive > 180 THEN 'High Risk' WHEN days_inactive > 90 THEN 'Medium Risk' ELSE 'Low Risk' END
              AS churn_risk
          FROM (SELECT customer_key, count(*) AS total_transactions, sum(amount) AS total_spent,
              max(full_date) AS last_transaction_date,
              date_diff('day', max(full_date), DATE '2001-08-02') AS days_inactive,
              avg(gap) AS avg_days_between_purchases,
              sum(CASE WHEN year = 2001 THEN amount ELSE 0 END) AS revenue_this_year,
              sum(CASE WHEN year = 2000 THEN amount ELSE 0 END) AS revenue_last_year
            FROM (SELECT *, date_diff('day', lag(full_date) OVER (PARTITION BY customer_key ORDER BY full_date), full_date) AS gap
              FROM x_fact WHERE is_successful)
            GROUP BY customer_key) a JOIN x_customers c USING (customer_key)
          WHERE days_inactive > 60""")
def churn_indicators(t):
    return A.churn_indicators(t.sales(), t.customers(), calendar(t), AS_OF_ORDERS, 2001)


@query("olap_payment_method_by_geo",
       "region:s country_name:s type:s card_brand:s transaction_count:i successful_count:i success_rate:r total_volume:d "
       "avg_transaction_amount:r pct_of_region:r",
       """SELECT *, CAST(transaction_count AS DOUBLE) / CAST(sum(transaction_count) OVER (PARTITION BY region) AS DOUBLE) * 100 AS pct_of_region FROM (
            SELECT region, country_name, type, card_brand, count(*) AS transaction_count,
              count(*) FILTER (is_successful) AS successful_count,
              CAST(count(*) FILTER (is_successful) AS DOUBLE) / count(*) * 100 AS success_rate, sum(amount) AS total_volume,
              CAST(sum(amount) AS DOUBLE) / count(*) AS avg_transaction_amount
            FROM x_fact JOIN x_geography USING (geography_key) JOIN x_methods USING (payment_method_key)
            WHERE time_key >= 20000101 GROUP BY ALL HAVING count(*) > 10)""")
def payment_method_by_geo(t):
    return A.payment_method_by_geo(t.fact(), t.geography(), t.payment_methods(), 20000101, more_than=10)


@query("olap_wallet_adoption",
       "year:i quarter:i total_transactions:i digital_wallet_count:i digital_wallet_adoption_rate:r prev_year_adoption_rate:r",
       """SELECT *, lag(digital_wallet_adoption_rate, 4) OVER (ORDER BY year, quarter) AS prev_year_adoption_rate FROM (
            SELECT year, quarter(full_date) AS quarter, count(*) AS total_transactions,
              count(*) FILTER (is_digital_wallet) AS digital_wallet_count,
              CAST(count(*) FILTER (is_digital_wallet) AS DOUBLE) / count(*) * 100 AS digital_wallet_adoption_rate
            FROM x_fact JOIN x_methods USING (payment_method_key) WHERE is_successful GROUP BY ALL)""")
def wallet_adoption(t):
    return A.wallet_adoption(t.sales(), t.payment_methods(), calendar(t))


@query("olap_fraud_by_geo_method",
       "country_name:s region:s type:s card_brand:s total_transactions:i fraud_count:i fraud_rate:r fraud_amount:d "
       "fraud_rate_vs_avg:r",
       """SELECT *, fraud_rate - avg(fraud_rate) OVER () AS fraud_rate_vs_avg FROM (
            SELECT country_name, region, type, card_brand, count(*) AS total_transactions,
              count(*) FILTER (is_fraudulent) AS fraud_count,
              CAST(count(*) FILTER (is_fraudulent) AS DOUBLE) / count(*) * 100 AS fraud_rate,
              sum(CASE WHEN is_fraudulent THEN amount ELSE 0 END) AS fraud_amount
            FROM x_fact JOIN x_geography USING (geography_key) JOIN x_methods USING (payment_method_key)
            WHERE time_key >= 20000101 GROUP BY ALL HAVING count(*) > 10)""")
def fraud_by_geo_method(t):
    return A.fraud_by_geo_method(t.fact(), t.geography(), t.payment_methods(), 20000101, more_than=10)


@query("olap_fraud_by_time",
       "day_name:s hour_of_day:i transaction_count:i fraud_count:i fraud_rate:r avg_transaction_amount:r",
       """SELECT dayname(transaction_datetime) AS day_name, hour(transaction_datetime) AS hour_of_day,
            count(*) AS transaction_count, count(*) FILTER (is_fraudulent) AS fraud_count,
            CAST(count(*) FILTER (is_fraudulent) AS DOUBLE) / count(*) * 100 AS fraud_rate,
            CAST(sum(amount) AS DOUBLE) / count(*) AS avg_transaction_amount
          FROM x_fact WHERE time_key >= 19980901 GROUP BY ALL""")
def fraud_by_time(t):
    return A.fraud_by_time(t.sales(), 19980901)


@query("olap_exec_kpis",
       "year:i month:i month_name:s gross_revenue:d net_revenue:d total_fees:d total_transactions:i unique_customers:i "
       "active_merchants:i avg_transaction_value:r revenue_per_customer:r success_rate:r refund_rate:r chargeback_rate:r "
       "fraud_rate:r mom_revenue_growth:r",
       f"""SELECT *, CAST(gross_revenue AS DOUBLE) / total_transactions AS avg_transaction_value,
            CAST(gross_revenue AS DOUBLE) / unique_customers AS revenue_per_customer,
            (CAST(gross_revenue AS DOUBLE) - CAST(lag(gross_revenue) OVER (ORDER BY year, month) AS DOUBLE))
              / nullif(CAST(lag(gross_revenue) OVER (ORDER BY year, month) AS DOUBLE), 0) * 100 AS mom_revenue_growth
          FROM (SELECT year, month, monthname(full_date) AS month_name, sum(amount) AS gross_revenue,
              sum(net_amount) AS net_revenue, sum(processing_fee) AS total_fees, count(*) AS total_transactions,
              count(DISTINCT customer_key) AS unique_customers, count(DISTINCT merchant_key) AS active_merchants, {RATES}
            FROM x_fact WHERE year >= 1996 GROUP BY ALL)""")
def exec_kpis(t):
    return A.exec_kpis(t.sales(), calendar(t), 1996)


@query("olap_merchant_leaderboard",
       "business_name:s industry:s merchant_tier:s country_name:s transaction_count:i total_revenue:d avg_transaction_value:r "
       "unique_customers:i success_rate:r refund_rate:r revenue_percentile:r performance_tier:s",
       f"""SELECT *, CASE WHEN revenue_percentile >= 0.9 THEN 'Top 10%' WHEN revenue_percentile >= 0.75 THEN 'Top 25%'
              WHEN revenue_percentile <= 0.1 THEN 'Bottom 10%' ELSE 'Middle 50%' END AS performance_tier
          FROM (SELECT *, percent_rank() OVER (ORDER BY total_revenue) AS revenue_percentile
            FROM (SELECT merchant_key, count(*) AS transaction_count, sum(amount) AS total_revenue,
                CAST(sum(amount) AS DOUBLE) / count(*) AS avg_transaction_value,
                count(DISTINCT customer_key) AS unique_customers, {RATES}
              FROM x_fact WHERE time_key >= 20000101 GROUP BY 1 HAVING count(*) > 10)
            JOIN x_merchants USING (merchant_key) LEFT JOIN x_geography g ON g.geography_key = nationkey)""")
def merchant_leaderboard(t):
    return A.merchant_leaderboard(t.sales(), t.merchants(), t.geography(), 20000101)


@query("olap_daily_moving_avg",
       "full_date:s day_name:s is_weekend:b daily_revenue:d transaction_count:i ma_7day:r ma_30day:r dod_growth_rate:r",
       """SELECT *, CAST(sum(daily_revenue) OVER w7 AS DOUBLE) / count(*) OVER w7 AS ma_7day,
            CAST(sum(daily_revenue) OVER w30 AS DOUBLE) / count(*) OVER w30 AS ma_30day,
            (CAST(daily_revenue AS DOUBLE) - CAST(lag(daily_revenue) OVER d AS DOUBLE))
              / nullif(CAST(lag(daily_revenue) OVER d AS DOUBLE), 0) * 100 AS dod_growth_rate
          FROM (SELECT full_date, dayname(full_date) AS day_name, dayofweek(full_date) IN (0, 6) AS is_weekend,
              sum(amount) AS daily_revenue, count(*) AS transaction_count
            FROM x_fact WHERE is_successful AND full_date >= DATE '2001-08-02' - INTERVAL 90 DAY GROUP BY ALL)
          WINDOW d AS (ORDER BY full_date), w7 AS (ORDER BY full_date ROWS 6 PRECEDING),
            w30 AS (ORDER BY full_date ROWS 29 PRECEDING)""")
def daily_moving_avg(t):
    return A.daily_moving_avg(t.sales(), calendar(t), AS_OF_ORDERS)


WEEK = "CAST(floor((dayofyear(full_date) - 1 + dayofweek(date_trunc('year', full_date))) / 7) + 1 AS BIGINT)"


@query("olap_seasonality",
       "month:i month_name:s week_of_year:i avg_daily_revenue:r min_daily_revenue:d max_daily_revenue:d "
       "stddev_daily_revenue:r coefficient_of_variation:r",
       f"""SELECT month, month_name, week_of_year, CAST(sum(v) AS DOUBLE) / count(*) AS avg_daily_revenue,
            min(v) AS min_daily_revenue, max(v) AS max_daily_revenue, stddev_samp(CAST(v AS DOUBLE)) AS stddev_daily_revenue,
            CASE WHEN sum(v) > 0 THEN stddev_samp(CAST(v AS DOUBLE)) / (CAST(sum(v) AS DOUBLE) / count(*)) * 100 END
              AS coefficient_of_variation
          FROM (SELECT full_date, month, monthname(full_date) AS month_name, {WEEK} AS week_of_year, sum(amount) AS v
            FROM x_fact WHERE is_successful AND year >= 1996 GROUP BY ALL)
          GROUP BY ALL""")
def seasonality(t):
    return A.seasonality(t.sales(), calendar(t), 1996)


part("x_daily_summary", """SELECT merchant_key, time_key, full_date, count(*) AS transaction_count,
    count(*) AS successful_count, sum(amount) AS total_revenue, sum(net_amount) AS net_revenue,
    CAST(sum(amount) AS DOUBLE) / count(*) AS avg_transaction_amount, count(DISTINCT customer_key) AS unique_customers
  FROM x_fact WHERE is_successful GROUP BY ALL""")


@query("olap_daily_merchant_summary",
       "business_name:s full_date:s transaction_count:i total_revenue:d net_revenue:d avg_transaction_amount:r unique_customers:i",
       """SELECT business_name, d.* FROM x_daily_summary d JOIN x_merchants USING (merchant_key)
          WHERE full_date >= DATE '2001-08-02' - INTERVAL 7 DAY""")
def daily_merchant_summary(t):
    return A.daily_merchant_report(stored(t).summary(20010726), t.merchants(), calendar(t), AS_OF_ORDERS)


part("x_monthly", """SELECT f.year * 100 + f.month AS year_month, merchant_key, sum(amount) AS gross_revenue,
    sum(net_amount) AS net_revenue, count(*) AS transaction_count, count(DISTINCT customer_key) AS unique_customers,
    count(DISTINCT customer_key) FILTER (first_day >= (f.year * 100 + f.month) * 100 + 1) AS new_customers,
    count(DISTINCT customer_key) FILTER (first_day < (f.year * 100 + f.month) * 100 + 1) AS returning_customers,
    CAST(sum(amount) AS DOUBLE) / count(*) AS avg_order_value,
    CAST(sum(amount) AS DOUBLE) / count(DISTINCT customer_key) AS customer_lifetime_value, 0 AS churn_rate,
    CAST(count(*) FILTER (is_refunded) AS DOUBLE) / count(*) * 100 AS refund_rate,
    CAST(count(*) FILTER (is_disputed) AS DOUBLE) / count(*) * 100 AS chargeback_rate,
    CAST(count(*) FILTER (is_fraudulent) AS DOUBLE) / count(*) * 100 AS fraud_rate
  FROM x_fact f JOIN (SELECT customer_key, min(time_key) AS first_day FROM x_fact GROUP BY 1) USING (customer_key)
  WHERE is_successful GROUP BY 1, 2""")


@query("olap_monthly_kpis_from_agg",
       "year_month:i business_name:s industry:s gross_revenue:d net_revenue:d transaction_count:i unique_customers:i "
       "new_customers:i returning_customers:i avg_order_value:r customer_lifetime_value:r refund_rate:r chargeback_rate:r "
       "fraud_rate:r",
       "SELECT m.*, business_name, industry FROM x_monthly m JOIN x_merchants USING (merchant_key) WHERE year_month >= 200001")
def monthly_kpis_from_agg(t):
    return A.monthly_kpis(stored(t).monthly(200001), t.merchants(), 200001)


@query("olap_revenue_by_month", "year:i month:i revenue:d transaction_count:i",
       """SELECT year, month, sum(amount) AS revenue, count(*) AS transaction_count FROM x_fact
          WHERE is_successful AND year = 2000 GROUP BY 1, 2""")
def revenue_by_month(t):
    return A.revenue_by_month(t.sales(), calendar(t), 2000)


@query("olap_top_merchants_from_agg", "merchant_key:i business_name:s total_revenue:d transaction_count:i",
       """SELECT merchant_key, business_name, sum(amount) AS total_revenue, count(*) AS transaction_count
          FROM x_fact JOIN x_merchants USING (merchant_key) WHERE year = 2000 GROUP BY 1, 2
          ORDER BY total_revenue DESC, merchant_key LIMIT 10""")
def top_merchants_from_agg(t):
    return A.top_merchants_from_daily(stored(t).daily(20000101, 20001231), t.merchants(), 2000)


@query("olap_vw_transaction_details",
       "transaction_id:i full_date:s year:i quarter:i month:i month_name:s day_name:s customer_id:i customer_name:s "
       "customer_email:s customer_segment:s merchant_id:i merchant_name:s industry:s merchant_tier:s transaction_country:s "
       "region:s continent:s currency_code:s payment_type:s card_brand:s product_name:s product_category:s amount:d "
       "processing_fee:d net_amount:d is_successful:b is_refunded:b is_disputed:b is_fraudulent:b transaction_datetime:t",
       """SELECT f.*, quarter(full_date) AS quarter, monthname(full_date) AS month_name, dayname(full_date) AS day_name,
            c.customer_id, c.full_name AS customer_name, c.email AS customer_email, customer_segment, m.merchant_id,
            m.business_name AS merchant_name, industry, merchant_tier, country_name AS transaction_country, region, continent,
            currency_code, pm.type AS payment_type, pm.card_brand, product_name, product_category
          FROM x_fact f JOIN x_customers c USING (customer_key) JOIN x_merchants m USING (merchant_key)
          JOIN x_geography USING (geography_key) JOIN x_methods pm USING (payment_method_key)
          JOIN x_products USING (product_key)""")
def vw_transaction_details(t):
    return A.transaction_details(t.fact(), calendar(t), t.customers(), t.merchants(), t.geography(), t.payment_methods(),
                                 t.products())


@query("olap_vw_merchant_performance",
       "merchant_id:i business_name:s industry:s merchant_tier:s total_transactions:i successful_transactions:i "
       "failed_transactions:i gross_revenue:d total_fees:d net_revenue:d avg_transaction_value:r unique_customers:i "
       "success_rate:r refund_rate:r fraud_rate:r",
       f"""SELECT merchant_id, business_name, industry, merchant_tier, count(*) AS total_transactions,
            count(*) FILTER (is_successful) AS successful_transactions,
            count(*) FILTER (NOT is_successful) AS failed_transactions, sum(amount) AS gross_revenue,
            sum(processing_fee) AS total_fees, sum(net_amount) AS net_revenue,
            CAST(sum(amount) AS DOUBLE) / count(*) AS avg_transaction_value,
            count(DISTINCT customer_key) AS unique_customers, {RATES}
          FROM x_fact JOIN x_merchants USING (merchant_key) GROUP BY 1, 2, 3, 4""")
def vw_merchant_performance(t):
    return A.merchant_performance(t.sales(), t.merchants())


@query("olap_vw_geographic_revenue",
       "country_name:s region:s continent:s currency_code:s year:i quarter:i month:i transaction_count:i total_revenue:d "
       "avg_transaction_value:r unique_customers:i unique_merchants:i",
       """SELECT country_name, region, continent, currency_code, year, quarter(full_date) AS quarter, month,
            count(*) AS transaction_count, sum(amount) AS total_revenue,
            CAST(sum(amount) AS DOUBLE) / count(*) AS avg_transaction_value,
            count(DISTINCT customer_key) AS unique_customers, count(DISTINCT merchant_key) AS unique_merchants
          FROM x_fact JOIN x_geography USING (geography_key) WHERE is_successful GROUP BY ALL""")
def vw_geographic_revenue(t):
    return A.geographic_revenue(t.fact(), t.geography(), calendar(t))


@query("olap_geo_rollup", "continent:s region:s country_name:s level:i revenue:d transaction_count:i",
       """SELECT continent, region, country_name, grouping_id(continent, region, country_name) AS level,
            sum(amount) AS revenue, count(*) AS transaction_count
          FROM x_fact JOIN x_geography USING (geography_key) WHERE is_successful
          GROUP BY ROLLUP (continent, region, country_name)""")
def geo_rollup(t):
    return A.geo_rollup(t.fact(), t.geography())


@query("olap_product_performance",
       "product_key:i product_name:s product_category:s transaction_count:i successful_count:i revenue:d fees:d success_rate:r",
       """SELECT product_key, product_name, product_category, count(*) AS transaction_count,
            count(*) FILTER (is_successful) AS successful_count, sum(amount) FILTER (is_successful) AS revenue,
            sum(processing_fee) FILTER (is_successful) AS fees,
            CAST(count(*) FILTER (is_successful) AS DOUBLE) / count(*) * 100 AS success_rate
          FROM x_fact JOIN x_products USING (product_key) GROUP BY 1, 2, 3""")
def product_performance(t):
    return A.product_performance(t.sales(), t.products())


@query("olap_conversion_rate", "year_month:i attempted:i succeeded:i conversion_rate:r",
       """SELECT time_key // 100 AS year_month, count(*) AS attempted, count(*) FILTER (is_successful) AS succeeded,
            CAST(count(*) FILTER (is_successful) AS DOUBLE) / count(*) * 100 AS conversion_rate FROM x_fact GROUP BY 1""")
def conversion_rate(t):
    return A.conversion_rate(t.sales())


@query("olap_filtered_sum", "total_amount:d transaction_count:i",
       "SELECT sum(amount) AS total_amount, count(*) AS transaction_count FROM x_fact WHERE is_successful")
def filtered_sum(t):
    return A.completed_volume(t.sales())


@query("olap_country_month_fraud",
       "country_name:s year:i month:i total_revenue:d transaction_count:i unique_customers:i fraud_count:i fraud_rate:r",
       """SELECT country_name, year, month, sum(amount) AS total_revenue, count(*) AS transaction_count,
            count(DISTINCT customer_key) AS unique_customers, count(*) FILTER (is_fraudulent) AS fraud_count,
            CAST(count(*) FILTER (is_fraudulent) AS DOUBLE) / count(*) * 100 AS fraud_rate
          FROM x_fact JOIN x_geography USING (geography_key) WHERE is_successful GROUP BY 1, 2, 3""")
def country_month_fraud(t):
    return A.country_month_fraud(t.fact(), t.geography(), calendar(t))


@query("olap_top_merchants_from_fact", "merchant_key:i business_name:s total_revenue:d transaction_count:i",
       """SELECT merchant_key, business_name, sum(amount) AS total_revenue, count(*) AS transaction_count
          FROM x_fact JOIN x_merchants USING (merchant_key) WHERE year = 2000 GROUP BY 1, 2
          ORDER BY total_revenue DESC, merchant_key LIMIT 10""")
def top_merchants_from_fact(t):
    return A.top_merchants(t.sales(), t.merchants(), 2000)


@query("refresh_stored_aggregates",
       "year_month:i merchant_key:i gross_revenue:d transaction_count:i unique_customers:i new_customers:i returning_customers:i "
       "daily_amount:d daily_count:i",
       """SELECT m.*, daily_amount, daily_count FROM x_monthly m JOIN (
            SELECT year * 100 + month AS year_month, merchant_key, sum(amount) AS daily_amount, count(*) AS daily_count
            FROM x_fact GROUP BY 1, 2) USING (year_month, merchant_key)""")
def refresh_stored_aggregates(t):
    """The years from 2000 first, then the days before them arrive late and move the first days of customers."""
    fact = t.fact()
    tables = StoredAggregates(t.spark, scratch(t.spark, "aggregates"))
    tables.refresh(fact.filter("time_key >= 20000101"))
    tables.refresh(fact, days_of(fact.filter("time_key < 20000101")))
    by_month = tables.daily().groupBy(F.floor(F.col("date_key") / 100).cast("int").alias("year_month"), "merchant_key").agg(
        F.sum("total_amount").alias("daily_amount"), F.sum("transaction_count").alias("daily_count"))
    return tables.monthly().join(by_month, ["year_month", "merchant_key"])
