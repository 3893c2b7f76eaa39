"""Reports over the star schema.

Facts are aggregated on their keys first where the dimension attributes depend on the
key alone, so that only one row per key meets a large dimension. Windows without a
partition run on frames whose size is fixed by the calendar or the list of countries;
rankings over merchants use ``operators.ranking``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlark.functions import expr as X
from ledgerlark.operators.ranking import ranked
from ledgerlark.plans.aggregates import rows_by_day, runs, with_two_distincts
from ledgerlark.session import discard, materialise, scratch, tidy

def ok():
    return F.col("is_successful")

def from_day(fact: DataFrame, first: int, last: int | None = None) -> DataFrame:
    """Facts from ``first`` (to ``last``), as yyyymmdd keys. A fact stored by ``year_month`` is also filtered on
    that column, so that Spark opens the wanted months only."""
    key = F.col("time_key")
    inside = key >= first if last is None else key.between(first, last)
    if "year_month" in fact.columns:
        month = F.col("year_month")
        inside &= month >= first // 100 if last is None else month.between(first // 100, last // 100)
    return fact.filter(inside)


def everything():
    """Window over a whole frame; used on aggregated frames of bounded size only."""
    return Window.partitionBy()


def _rates(df: DataFrame) -> DataFrame:
    """Success, refund, chargeback and fraud percentages from the counts next to them."""
    return (
        df.withColumn("success_rate", X.pct("n_success", "n_all"))
        .withColumn("refund_rate", X.pct("n_refund", "n_success"))
        .withColumn("chargeback_rate", X.pct("n_dispute", "n_success"))
        .withColumn("fraud_rate", X.pct("n_fraud", "n_all"))
    )


def rate_counts():
    return (
        F.count("*").alias("n_all"),
        F.count_if("is_successful").alias("n_success"),
        F.count_if("is_refunded").alias("n_refund"),
        F.count_if("is_disputed").alias("n_dispute"),
        F.count_if("is_fraudulent").alias("n_fraud"),
    )


# -- revenue ---------------------------------------------------------------
def monthly_revenue_yoy(fact, dim_time, since_year: int, calendar_months: bool = False) -> DataFrame:
    """Monthly revenue and the value twelve rows earlier.

    ``calendar_months`` first fills months without sales from the calendar, so that
    twelve rows are always twelve months.
    """
    months = (
        from_day(fact, since_year * 10000 + 101).filter(ok())
        .join(dim_time, "time_key")
        .filter(F.col("year") >= since_year)
        .groupBy("year", "month", "month_name")
        .agg(
            F.sum("amount").alias("gross_revenue"),
            F.sum("net_amount").alias("net_revenue"),
            F.count("*").alias("transaction_count"),
            F.countDistinct("customer_key").alias("unique_customers"),
        )
    )
    if calendar_months:
        spine = dim_time.filter(F.col("year") >= since_year).select("year", "month", "month_name").distinct()
        months = spine.join(months, ["year", "month", "month_name"], "left")
    prev = F.lag("gross_revenue", 12).over(Window.orderBy("year", "month"))
    return (
        months.withColumn("prev_year_revenue", prev)
        .withColumn(
            "yoy_growth_rate",
            F.when(F.col("prev_year_revenue") > 0,
                   (X.ratio("gross_revenue", "prev_year_revenue") - 1) * 100),
        )
        .orderBy("year", "month")
    )


def revenue_by_geography(fact, geography, since_key: int) -> DataFrame:
    total = F.sum("total_revenue").over(everything())
    sold = from_day(fact, since_key).filter(ok()).join(geography, "geography_key")
    return (
        _with_customers_and_merchants(sold, ["continent", "region", "country_name", "currency_code"])
        .withColumn("pct_of_total_revenue", X.pct("total_revenue", total))
        .withColumn("revenue_rank", F.rank().over(Window.orderBy(F.desc("total_revenue"))))
        .orderBy(F.desc("total_revenue"))
    )


def revenue_by_tier_industry(fact, merchants, since_key: int) -> DataFrame:
    """Aggregated per merchant before the dimension join; a merchant belongs to one group."""
    per_merchant = (
        from_day(fact, since_key).filter(ok())
        .groupBy("merchant_key")
        .agg(F.sum("amount").alias("revenue"), F.count("*").alias("n"))
    )
    groups = (
        per_merchant.join(merchants.filter("is_current"), "merchant_key")
        .groupBy("merchant_tier", "industry", "industry_group")
        .agg(
            F.count("*").alias("merchant_count"),
            F.sum("revenue").alias("total_revenue"),
            X.ratio(F.sum("revenue"), F.sum("n")).alias("avg_transaction_value"),
        )
    )
    return (
        groups.withColumn("revenue_per_merchant", X.ratio("total_revenue", "merchant_count"))
        .withColumn("market_share_pct", X.pct("total_revenue", F.sum("total_revenue").over(everything())))
        .orderBy(F.desc("total_revenue"))
    )


def revenue_by_month(fact, dim_time, year: int) -> DataFrame:
    return (
        from_day(fact, year * 10000 + 101, year * 10000 + 1231).filter(ok())
        .join(dim_time, "time_key")
        .groupBy("year", "month")
        .agg(F.sum("amount").alias("revenue"), F.count("*").alias("transaction_count"))
        .orderBy("year", "month")
    )


def completed_volume(fact) -> DataFrame:
    return fact.filter(ok()).agg(F.sum("amount").alias("total_amount"), F.count("*").alias("transaction_count"))


def country_month_fraud(fact, geography, dim_time) -> DataFrame:
    """Revenue, average and fraud per country and month."""
    return (
        fact.filter(ok())
        .join(geography, "geography_key")
        .join(dim_time, "time_key")
        .groupBy("country_name", "year", "month")
        .agg(
            F.sum("amount").alias("total_revenue"),
            F.count("*").alias("transaction_count"),
            F.countDistinct("customer_key").alias("unique_customers"),
            F.count_if("is_fraudulent").alias("fraud_count"),
        )
        .withColumn("fraud_rate", X.pct("fraud_count", "transaction_count"))
        .orderBy("country_name", "year", "month")
    )


def top_merchants(fact, merchants, year: int, n: int = 10) -> DataFrame:
    """The largest merchants of a year straight from the fact."""
    return (
        from_day(fact, year * 10000 + 101, year * 10000 + 1231)
        .groupBy("merchant_key")
        .agg(F.sum("amount").alias("total_revenue"), F.count("*").alias("transaction_count"))
        .orderBy(F.desc("total_revenue"), "merchant_key")
        .limit(n)
        .join(merchants, "merchant_key")
        .select("merchant_key", "business_name", "total_revenue", "transaction_count")
    )


def product_performance(fact, products) -> DataFrame:
    return (
        fact.groupBy("product_key")
        .agg(
            F.count("*").alias("transaction_count"),
            F.sum(F.when(ok(), F.col("amount"))).alias("revenue"),
            F.sum(F.when(ok(), F.col("processing_fee"))).alias("fees"),
            F.count_if(ok()).alias("successful_count"),
        )
        .join(products, "product_key")
        .withColumn("success_rate", X.pct("successful_count", "transaction_count"))
        .orderBy(F.desc("revenue"))
    )


def conversion_rate(fact) -> DataFrame:
    """Succeeded over attempted per month."""
    return (
        fact.groupBy(F.floor(F.col("time_key") / 100).alias("year_month"))
        .agg(F.count("*").alias("attempted"), F.count_if(ok()).alias("succeeded"))
        .withColumn("conversion_rate", X.pct("succeeded", "attempted"))
        .orderBy("year_month")
    )


# -- customers ---------------------------------------------------------------
def customer_segmentation(fact, customers, dim_time, as_of, high_value=10000, active_days=30, risk_days=90) -> DataFrame:
    metrics = (
        fact.filter(ok())
        .groupBy("customer_key")
        .agg(
            F.count("*").alias("n"),
            F.sum("amount").alias("total_spent"),
            F.max("time_key").alias("last_key"),
        )
        .join(customers.filter("is_current"), "customer_key")
        .join(dim_time.select(F.col("time_key").alias("last_key"), F.col("full_date").alias("last_date")), "last_key")
        .withColumn("avg_order", X.ratio("total_spent", "n"))
        .withColumn("idle", X.days_between("last_date", X.ts(as_of)))
    )
    return (
        metrics.groupBy("customer_segment")
        .agg(
            F.count("*").alias("customer_count"),
            X.mean("total_spent").alias("avg_lifetime_value"),
            X.mean("n").alias("avg_transaction_count"),
            F.avg("avg_order").alias("avg_order_value"),
            X.mean("idle").alias("avg_days_since_purchase"),
            F.count_if(F.col("total_spent") > high_value).alias("high_value_customers"),
            F.count_if(F.col("idle") <= active_days).alias("active_customers"),
            F.count_if(F.col("idle") > risk_days).alias("at_risk_customers"),
        )
        .orderBy(F.desc("avg_lifetime_value"))
    )


def cohort_retention(fact, max_months: int = 12) -> DataFrame:
    """Active customers per cohort and month; month distance is a real month count.

    The fact is first reduced to distinct (customer, month) pairs.
    """
    active = (
        fact.filter(ok())
        .select("customer_key", F.floor(F.col("time_key") / 100).alias("activity_month"))
        .distinct()
    )
    cohorts = active.groupBy("customer_key").agg(F.min("activity_month").alias("cohort_month"))
    distance = X.month_index("activity_month") - X.month_index("cohort_month")
    sizes = (
        active.join(cohorts, "customer_key")
        .withColumn("months_since_cohort", distance)
        .filter(F.col("months_since_cohort") <= max_months)
        .groupBy("cohort_month", "months_since_cohort")
        .agg(F.count("*").alias("active_customers"))
    )
    base = F.first("active_customers").over(Window.partitionBy("cohort_month").orderBy("months_since_cohort"))
    return sizes.withColumn("retention_rate", X.pct("active_customers", base)).orderBy(
        "cohort_month", "months_since_cohort"
    )


def churn_indicators(fact, customers, dim_time, as_of, this_year: int, idle_days: int = 60) -> DataFrame:
    """Inactive customers with spend trend.

    Consecutive gaps add up to last minus first date, so their mean needs no window.
    """
    year = F.floor(F.col("time_key") / 10000)
    per_customer = (
        fact.filter(ok())
        .groupBy("customer_key")
        .agg(
            F.count("*").alias("total_transactions"),
            F.sum("amount").alias("total_spent"),
            F.min("time_key").alias("first_key"),
            F.max("time_key").alias("last_key"),
            X.sum_if(year == this_year, "amount").alias("revenue_this_year"),
            X.sum_if(year == this_year - 1, "amount").alias("revenue_last_year"),
        )
    )
    first = dim_time.select(F.col("time_key").alias("first_key"), F.col("full_date").alias("first_date"))
    last = dim_time.select(F.col("time_key").alias("last_key"), F.col("full_date").alias("last_transaction_date"))
    idle = F.col("days_inactive")
    return (
        per_customer.join(first, "first_key")
        .join(last, "last_key")
        .withColumn("days_inactive", X.days_between("last_transaction_date", X.ts(as_of)))
        .filter(idle > idle_days)
        .join(customers.filter("is_current"), "customer_key")
        .withColumn(
            "avg_days_between_purchases",
            X.ratio(X.days_between("first_date", "last_transaction_date"), F.col("total_transactions") - 1),
        )
        .withColumn(
            "yoy_revenue_change",
            F.when(F.col("revenue_last_year") > 0, (X.ratio("revenue_this_year", "revenue_last_year") - 1) * 100),
        )
        .withColumn("churn_risk", F.when(idle > 180, "High Risk").when(idle > 90, "Medium Risk").otherwise("Low Risk"))
        .select(
            "customer_key", "full_name", "email", "customer_segment", "total_transactions", "total_spent",
            "last_transaction_date", "days_inactive", "avg_days_between_purchases", "revenue_this_year",
            "revenue_last_year", "yoy_revenue_change", "churn_risk",
        )
        .orderBy(F.desc("days_inactive"), F.desc("total_spent"))
    )


# -- payment methods -----------------------------------------------------------
def _by_method_and_place(fact, methods) -> DataFrame:
    """Counts per (geography, type, brand), before the small geography join."""
    return (
        fact.join(methods.select("payment_method_key", "type", "card_brand"), "payment_method_key")
        .groupBy("geography_key", "type", "card_brand")
        .agg(
            F.count("*").alias("n"),
            F.count_if(ok()).alias("n_success"),
            F.sum("amount").alias("volume"),
            F.count_if("is_fraudulent").alias("n_fraud"),
            X.sum_if(F.col("is_fraudulent"), "amount").alias("fraud_volume"),
        )
    )


def payment_method_by_geo(fact, geography, methods, since_key: int, more_than: int = 100) -> DataFrame:
    grouped = (
        _by_method_and_place(from_day(fact, since_key), methods)
        .join(geography, "geography_key")
        .groupBy("region", "country_name", "type", "card_brand")
        .agg(
            F.sum("n").alias("transaction_count"),
            F.sum("n_success").alias("successful_count"),
            F.sum("volume").alias("total_volume"),
        )
        .filter(F.col("transaction_count") > more_than)
    )
    in_region = F.sum("transaction_count").over(Window.partitionBy("region"))
    return (
        grouped.withColumn("success_rate", X.pct("successful_count", "transaction_count"))
        .withColumn("avg_transaction_amount", X.ratio("total_volume", "transaction_count"))
        .withColumn("pct_of_region", X.pct("transaction_count", in_region))
        .orderBy("region", F.desc("transaction_count"))
    )


def wallet_adoption(fact, methods, dim_time) -> DataFrame:
    quarters = (
        fact.filter(ok())
        .join(methods.select("payment_method_key", "is_digital_wallet"), "payment_method_key")
        .join(dim_time, "time_key")
        .groupBy("year", "quarter")
        .agg(F.count("*").alias("total_transactions"), F.count_if("is_digital_wallet").alias("digital_wallet_count"))
        .withColumn("digital_wallet_adoption_rate", X.pct("digital_wallet_count", "total_transactions"))
    )
    prev = F.lag("digital_wallet_adoption_rate", 4).over(Window.orderBy("year", "quarter"))
    return quarters.withColumn("prev_year_adoption_rate", prev).orderBy("year", "quarter")


# -- fraud -----------------------------------------------------------------------
def fraud_by_geo_method(fact, geography, methods, since_key: int, more_than: int = 50) -> DataFrame:
    """Difference to the mean rate of the groups that pass the size filter.

    Groups are (country, type, brand): the countries are a fixed list and brands few.
    """
    grouped = (
        _by_method_and_place(from_day(fact, since_key), methods)
        .join(geography, "geography_key")
        .groupBy("country_name", "region", "type", "card_brand")
        .agg(
            F.sum("n").alias("total_transactions"),
            F.sum("n_fraud").alias("fraud_count"),
            F.sum("fraud_volume").alias("fraud_amount"),
        )
        .filter(F.col("total_transactions") > more_than)
        .withColumn("fraud_rate", X.pct("fraud_count", "total_transactions"))
    )
    return grouped.withColumn("fraud_rate_vs_avg", F.col("fraud_rate") - F.avg("fraud_rate").over(everything())).orderBy(
        F.desc("fraud_rate")
    )


def fraud_by_time(fact, since_key: int) -> DataFrame:
    at = F.col("transaction_datetime")
    return (
        from_day(fact, since_key)
        .groupBy(F.date_format(at, "EEEE").alias("day_name"), F.hour(at).alias("hour_of_day"))
        .agg(
            F.count("*").alias("transaction_count"),
            F.count_if("is_fraudulent").alias("fraud_count"),
            X.mean("amount").alias("avg_transaction_amount"),
        )
        .withColumn("fraud_rate", X.pct("fraud_count", "transaction_count"))
        .orderBy(F.desc("fraud_rate"))
    )


# -- key figures -------------------------------------------------------------------
def exec_kpis(fact, dim_time, since_year: int) -> DataFrame:
    """Customers and merchants of a month are counted from one row per month and key, so that no fact row is repeated
    for a distinct count."""
    fact = from_day(fact, since_year * 10000 + 101).withColumn("_m", F.floor(F.col("time_key") / 100))
    sums = {"gross_revenue": "amount", "net_revenue": "net_amount", "total_fees": "processing_fee"}
    counts = ("n_all", "n_success", "n_refund", "n_dispute", "n_fraud")
    per_customer = fact.groupBy("_m", "customer_key").agg(*[F.sum(c).alias(n) for n, c in sums.items()], *rate_counts())
    totals = per_customer.groupBy("_m").agg(
        *[F.sum(c).alias(c) for c in (*sums, *counts)], F.count("customer_key").alias("unique_customers"))
    merchants = fact.groupBy("_m", "merchant_key").agg(F.lit(1)).groupBy("_m").agg(F.count("merchant_key").alias("active_merchants"))
    names = dim_time.filter(F.col("year") >= since_year).select(
        "year", "month", "month_name", F.floor(F.col("time_key") / 100).alias("_m")).distinct()
    months = totals.join(merchants, "_m").join(names, "_m").drop("_m")
    prev = F.lag("gross_revenue").over(Window.orderBy("year", "month"))
    return (
        _rates(months)
        .withColumn("total_transactions", F.col("n_all"))
        .withColumn("avg_transaction_value", X.ratio("gross_revenue", "n_all"))
        .withColumn("revenue_per_customer", X.ratio("gross_revenue", "unique_customers"))
        .withColumn("mom_revenue_growth", X.growth_pct("gross_revenue", prev))
        .drop("n_all", "n_success", "n_refund", "n_dispute", "n_fraud")
        .orderBy("year", "month")
    )


def _merchant_metrics(fact, merchants) -> DataFrame:
    per_merchant = fact.groupBy("merchant_key").agg(
        F.sum("amount").alias("total_revenue"),
        F.sum("processing_fee").alias("total_fees"),
        F.sum("net_amount").alias("net_revenue"),
        F.countDistinct("customer_key").alias("unique_customers"),
        *rate_counts(),
    )
    return (
        _rates(per_merchant)
        .withColumn("transaction_count", F.col("n_all"))
        .withColumn("failed_transactions", F.col("n_all") - F.col("n_success"))
        .withColumn("avg_transaction_value", X.ratio("total_revenue", "n_all"))
        .join(merchants.filter("is_current"), "merchant_key")
    )


def merchant_leaderboard(fact, merchants, geography, since_key: int, more_than: int = 10) -> DataFrame:
    country = geography.select(F.col("geography_key").alias("nationkey"), "country_name")
    metrics = (
        _merchant_metrics(from_day(fact, since_key), merchants)
        .filter(F.col("transaction_count") > more_than)
        .join(country, "nationkey", "left")
        .select("merchant_key", "business_name", "industry", "merchant_tier", "country_name", "transaction_count", "total_revenue",
                "avg_transaction_value", "unique_customers", "success_rate", "refund_rate")
    )
    p = F.col("revenue_percentile")
    return (
        ranked(metrics, "total_revenue")
        .withColumnRenamed("percent_rank", "revenue_percentile")
        .drop("rank")
        .withColumn(
            "performance_tier",
            F.when(p >= 0.9, "Top 10%").when(p >= 0.75, "Top 25%").when(p <= 0.1, "Bottom 10%").otherwise("Middle 50%"),
        )
        .orderBy(F.desc("total_revenue"))
    )


def merchant_performance(fact, merchants) -> DataFrame:
    return _merchant_metrics(fact, merchants).select(
        "merchant_id", "business_name", "industry", "merchant_tier",
        F.col("transaction_count").alias("total_transactions"),
        F.col("n_success").alias("successful_transactions"), "failed_transactions",
        F.col("total_revenue").alias("gross_revenue"), "total_fees", "net_revenue", "avg_transaction_value",
        "unique_customers", "success_rate", "refund_rate", "fraud_rate",
    )


# -- time series ------------------------------------------------------------------------
def daily_moving_avg(fact, dim_time, as_of, days: int = 90) -> DataFrame:
    daily = (
        fact.filter(ok())
        .join(dim_time, "time_key")
        .filter(F.col("full_date") >= X.ago(as_of, days, "DAY"))
        .groupBy("full_date", "day_name", "is_weekend")
        .agg(F.sum("amount").alias("daily_revenue"), F.count("*").alias("transaction_count"))
    )
    by_day = Window.orderBy("full_date")
    return (
        daily.withColumn("ma_7day", _mean_over("daily_revenue", by_day.rowsBetween(-6, 0)))
        .withColumn("ma_30day", _mean_over("daily_revenue", by_day.rowsBetween(-29, 0)))
        .withColumn("dod_growth_rate", X.growth_pct("daily_revenue", F.lag("daily_revenue").over(by_day)))
        .orderBy("full_date")
    )


def _mean_over(c: str, window) -> Column:
    return X.ratio(F.sum(c).over(window), F.count(c).over(window))


def seasonality(fact, dim_time, since_year: int) -> DataFrame:
    daily = (
        from_day(fact, since_year * 10000 + 101).filter(ok())
        .join(dim_time, "time_key")
        .filter(F.col("year") >= since_year)
        .groupBy("full_date", "month", "month_name", "week_of_year")
        .agg(F.sum("amount").alias("revenue"))
    )
    return (
        daily.groupBy("month", "month_name", "week_of_year")
        .agg(
            X.mean("revenue").alias("avg_daily_revenue"),
            F.min("revenue").alias("min_daily_revenue"),
            F.max("revenue").alias("max_daily_revenue"),
            F.stddev_samp("revenue").alias("stddev_daily_revenue"),
        )
        .withColumn(
            "coefficient_of_variation",
            F.when(F.col("avg_daily_revenue") > 0, X.pct("stddev_daily_revenue", "avg_daily_revenue")),
        )
        .orderBy("month", "week_of_year")
    )


# -- from pre-aggregates ------------------------------------------------------------------
def daily_merchant_report(summary, merchants, dim_time, as_of, days: int = 7) -> DataFrame:
    recent = dim_time.filter(F.col("full_date") >= X.ago(as_of, days, "DAY"))
    return (
        summary.join(recent, "time_key")
        .join(merchants.filter("is_current"), "merchant_key")
        .select("business_name", "full_date", "transaction_count", "total_revenue", "net_revenue",
                "avg_transaction_amount", "unique_customers")
        .orderBy("business_name", "full_date")
    )


def monthly_kpis(agg_monthly, merchants, since_month: int) -> DataFrame:
    return (
        agg_monthly.filter(F.col("year_month") >= since_month)
        .join(merchants.filter("is_current").select("merchant_key", "business_name", "industry"), "merchant_key")
        .drop("merchant_key", "churn_rate")
        .orderBy("year_month", F.desc("gross_revenue"))
    )


def top_merchants_from_daily(agg_daily, merchants, year: int, n: int = 10) -> DataFrame:
    return (
        agg_daily.filter(F.col("date_key").between(year * 10000 + 101, year * 10000 + 1231))
        .groupBy("merchant_key")
        .agg(F.sum("total_amount").alias("total_revenue"), F.sum("transaction_count").alias("transaction_count"))
        .orderBy(F.desc("total_revenue"), "merchant_key")
        .limit(n)
        .join(merchants, "merchant_key")
        .select("merchant_key", "business_name", "total_revenue", "transaction_count")
    )


# -- views -----------------------------------------------------------------------------------
def transaction_details(fact, dim_time, customers, merchants, geography, methods, products) -> DataFrame:
    """The denormalised fact; current dimension versions only.

    A few days at a time are joined and written, so that the shuffles of these days only lie on disk. Dimensions come narrow ones first.
    The calendar and the countries are broadcast, whose size is bounded.
    """
    days = dim_time.select("time_key", "full_date", "year", "quarter", "month", "month_name", "day_name")
    places = geography.withColumnRenamed("country_name", "transaction_country")
    sellers = merchants.filter("is_current").select(
        "merchant_key", "merchant_id", F.col("business_name").alias("merchant_name"), "industry", "merchant_tier")
    means = methods.select("payment_method_key", F.col("type").alias("payment_type"), "card_brand")
    buyers = customers.filter("is_current").select(
        "customer_key", "customer_id", F.col("full_name").alias("customer_name"), F.col("email").alias("customer_email"), "customer_segment")
    keys = ["customer_key", "payment_method_key", "merchant_key", "product_key", "geography_key", "time_key"]
    columns = [*keys, *[c for x in (fact, days, places, products, sellers, means, buyers) for c in x.columns if c not in keys]]
    rows = materialise(fact.sortWithinPartitions("time_key"), "fact", "zstd")
    sizes = rows_by_day(rows)
    path = scratch(rows.sparkSession, "details")
    for run in runs(sorted(d for d in sizes if d is not None), sizes):
        some = rows.filter(F.col("time_key").between(run[0], run[-1]) if run else F.lit(False))
        wide = (
            some.join(means, "payment_method_key")
            .join(sellers, "merchant_key")
            .join(buyers, "customer_key")
            .join(products, "product_key")
            .join(F.broadcast(places), "geography_key")
            .join(F.broadcast(days), "time_key")
            .select(*columns)
        )
        with tidy(rows.sparkSession):
            wide.write.mode("append").option("compression", "zstd").parquet(path)
    discard(rows)
    return rows.sparkSession.read.schema(wide.schema).parquet(path)


def geographic_revenue(fact, geography, dim_time) -> DataFrame:
    sold = fact.filter(ok()).join(geography, "geography_key").join(dim_time, "time_key")
    return _with_customers_and_merchants(sold, ["country_name", "region", "continent", "currency_code", "year", "quarter", "month"])


def _with_customers_and_merchants(sold: DataFrame, by: list[str]) -> DataFrame:
    counted = with_two_distincts(sold, by, {"unique_customers": "customer_key", "unique_merchants": "merchant_key"},
                                 {"total_revenue": F.col("amount"), "_n_amount": F.col("amount").isNotNull().cast("bigint")})
    return (
        counted.withColumnRenamed("n", "transaction_count")
        .withColumn("avg_transaction_value", X.ratio("total_revenue", "_n_amount"))
        .drop("_n_amount")
    )


def geo_rollup(fact, geography) -> DataFrame:
    """Totals at every level of continent > region > country."""
    return (
        fact.filter(ok())
        .groupBy("geography_key")
        .agg(F.sum("amount").alias("revenue"), F.count("*").alias("n"))
        .join(geography, "geography_key")
        .rollup("continent", "region", "country_name")
        .agg(F.grouping_id().alias("level"), F.sum("revenue").alias("revenue"), F.sum("n").alias("transaction_count"))
    )
