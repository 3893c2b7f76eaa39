"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the data, BENCH_CPUS the local cores. Every query runs once to warm up and
is then timed into a sink that reads all rows and columns; eager steps are part of the time.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from ledgerlark import session  # noqa: E402
from ledgerlark.plans import analytics  # noqa: E402
from ledgerlark.plans.calendar import build_dim_time  # noqa: E402
from ledgerlark.plans.stored import StoredAggregates  # noqa: E402
from ledgerlark.registry import QUERIES, load_all  # noqa: E402
from ledgerlark.sources import tables as T  # noqa: E402
from ledgerlark.sources.driver_tables import PaymentTables  # noqa: E402

HEADLINE = (
    "olap_filtered_sum",
    "olap_country_month_fraud",
    "olap_monthly_revenue_yoy",
    "olap_top_merchants_from_fact",
    "olap_top_merchants_from_agg",
    "olap_exec_kpis",
    "olap_cohort_retention",
    "olap_merchant_leaderboard",
    "oltp_clv",
    "oltp_customer_export",
    "calculate_monthly_metrics",
    "cdc_net_changes",
    "load_fact",
    "scd2_merge",
    "feature_vector",
    "stream_api_perf_5m",
)


def stored_queries(spark, path: str) -> dict:
    """The warehouse as users query it: a fact stored by month, and its aggregates, whose making is timed as a query of its own."""
    t = PaymentTables(spark, path)
    fact_path = session.scratch(spark, "fact")
    T.write_partitions(T.by_month(t.fact()), fact_path, ["year_month"])
    fact = spark.read.parquet(fact_path)
    days = build_dim_time(spark, 1994, 2003)
    kept = StoredAggregates(spark, session.scratch(spark, "aggregates"))
    kept.refresh(fact)

    def build():
        made = StoredAggregates(spark, session.scratch(spark, "aggregates"))
        made.refresh(fact)
        return made.monthly()

    return {
        "stored_aggregates_build": build,
        "stored_filtered_sum": lambda: analytics.completed_volume(fact),
        "stored_country_month_fraud": lambda: analytics.country_month_fraud(fact, t.geography(), days),
        "stored_monthly_revenue_yoy": lambda: analytics.monthly_revenue_yoy(fact, days, 1995),
        "stored_revenue_of_a_year": lambda: analytics.revenue_by_month(fact, days, 2000),
        "stored_top_merchants_from_fact": lambda: analytics.top_merchants(fact, t.merchants(), 2000),
        "stored_top_merchants_from_agg": lambda: analytics.top_merchants_from_daily(
            kept.daily(20000101, 20001231), t.merchants(), 2000),
    }


def main() -> None:
    path = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session.build(f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "12g",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    load_all()

    def run(build) -> float:
        start = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    jobs = {name: (lambda q=QUERIES[name]: q(spark, path)) for name in HEADLINE}
    for name, build in {**jobs, **stored_queries(spark, path)}.items():
        run(build)
        seconds[name] = round(run(build), 3)
    sf = re.search(r"sf([\d.]+)", path)
    print(json.dumps({"metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": float(sf.group(1)) if sf else path}))
    spark.stop()


if __name__ == "__main__":
    main()
