"""The dated load: extract, stage, merge, check, publish, advance the watermark."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.operators import warehouse as L
from ledgerlark.sources import tables as T

WATERMARK_SCHEMA = "table_name string, last_lsn bigint, last_time timestamp, rows_processed bigint"


class CheckFailed(Exception):
    """The new version did not pass; the published version and the watermark are unchanged."""


class Watermarks:
    """Last processed change per table, kept as a published table of one row per name."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.table = spark, T.PublishedTable(spark, root)

    def last(self, name: str) -> int | None:
        rows = self.table.read()
        row = rows.filter(F.col("table_name") == name).select("last_lsn").first() if rows is not None else None
        return row["last_lsn"] if row else None

    def advance(self, name: str, lsn: int, at, rows: int) -> None:
        new = self.spark.createDataFrame([(name, lsn, rows)], "table_name string, last_lsn bigint, rows_processed bigint")
        new = new.select("table_name", "last_lsn", F.lit(str(at)).cast("timestamp").alias("last_time"), "rows_processed")
        old = self.table.read()
        if old is not None:
            new = old.filter(F.col("table_name") != name).unionByName(new)
        self.table.publish(new)


def dated_load(log: DataFrame, root: str, run_date: str, name: str, key: str, gate: Callable[[DataFrame], DataFrame],
               force_full: bool = False, to_lsn: int | None = None) -> dict:
    """Apply the changes after the watermark to the published table ``name``; returns what was done.

    ``force_full`` reads the log from its beginning and rebuilds the table. The steps follow each
    other through written data only; a failed step leaves watermark and published table as they were.
    """
    spark = log.sparkSession
    marks, target = Watermarks(spark, f"{root}/watermarks"), T.PublishedTable(spark, f"{root}/{name}")
    last = None if force_full else marks.last(name)
    upper = log.filter(F.col("lsn") <= to_lsn) if to_lsn is not None else log
    if last is not None:
        upper = upper.filter(F.col("lsn") > last)
    newest = upper.agg(F.max("lsn").alias("lsn")).first()["lsn"]
    if newest is None:
        return {"run_date": run_date, "from_lsn": last, "to_lsn": last, "extracted": 0}

    net = L.net_changes(log, key, None if last is None else last + 1, newest)
    staging = f"{root}/staging/{name}"
    T.append_staging(net, staging, run_date)
    staged = spark.read.parquet(staging).filter(F.col("run_date") == run_date).drop("run_date")
    extracted = staged.count()

    columns = [c for c in staged.columns if c != "change_type"]
    current = None if force_full else target.read()
    if current is None:
        current = staged.select(columns).limit(0)
    if not target.publish(L.apply_changes(current.select(columns), staged, key), gate=gate):
        raise CheckFailed(f"{name} {run_date}: quality rules failed")
    marks.advance(name, newest, f"{run_date} 00:00:00", extracted)
    return {"run_date": run_date, "from_lsn": last, "to_lsn": newest, "extracted": extracted}
