"""Streaming jobs. Each is a function of DataFrames that also runs on batch input.

Sources are watermarked by the caller through ``watermarked``; results are appended when their
window closes. Aggregations combine map-side before they reach the state store.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.types import StructType

from ledgerlark.functions import expr as X
from ledgerlark.operators.ranking import latest_per_key, percentiles_within, value_sketch
from ledgerlark.operators.warehouse import log_order
from ledgerlark.session import folder_names, materialise, remove_folder, scratch, tidy
from ledgerlark.sources.tables import read_folder, write_partitions

WATERMARK = "30 seconds"
#: Retention of the event topic, which is how late a replayed event can come.
REPLAY = "7 days"


# -- sources and sinks --------------------------------------------------------------
def file_stream(spark: SparkSession, folder: str, schema: StructType | str, pattern: str = "*.parquet",
                files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def topic_stream(spark: SparkSession, servers: str, topic: str, schema: StructType | str) -> DataFrame:
    """JSON messages of a Kafka topic; needs the Kafka connector on the class path."""
    raw = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic).load()
    return raw.select(F.from_json(F.col("value").cast("string"), schema).alias("_m")).select("_m.*")


class LateRows(StreamingQueryListener):
    """Writes how many rows the watermark dropped, one row per batch and stateful operator, for all batches of the queries it hears of.

    Add it with ``spark.streams.addListener`` before the query starts; ``late_rows`` reads what it wrote. A batch that is done again
    replaces its row.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self._ended = spark, path, threading.Event()

    def onQueryStarted(self, event) -> None:
        self._ended.clear()

    def onQueryProgress(self, event) -> None:
        p = event.progress
        counts = [(i, s.numRowsDroppedByWatermark) for i, s in enumerate(p.stateOperators)]
        if counts:
            self.spark.createDataFrame(counts, "operator int, dropped bigint").coalesce(1).write.mode("overwrite").option(
                "partitionOverwriteMode", "static").parquet(f"{self.path}/query={p.id}/batch={p.batchId}")

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._ended.set()

    def wait(self, seconds: float = 60) -> bool:
        """Until the last query that ended has been heard to the end."""
        return self._ended.wait(seconds)


def late_rows(spark: SparkSession, path: str) -> DataFrame:
    """(query, batch, operator, dropped) of every batch that a ``LateRows`` listener wrote."""
    return spark.read.schema("operator int, dropped bigint, query string, batch bigint").parquet(path)


def watermarked(df: DataFrame, ts: str = "ts", delay: str = WATERMARK) -> DataFrame:
    return df.withWatermark(ts, delay)


def run_available(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Process everything that is there into a parquet table and read it back.

    The checkpoint lives next to the table in the shared folder, so a restart continues.
    """
    spark = df.sparkSession
    path = path or scratch(spark, name)
    query = (
        df.writeStream.queryName(name.replace("-", "_")).outputMode("append").format("parquet")
        .option("path", f"{path}/table").option("checkpointLocation", f"{path}/checkpoint")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{path}/table")


def run_each_batch(df: DataFrame, name: str, handle: Callable[[DataFrame, int], None], path: str | None = None):
    path = path or scratch(df.sparkSession, name)
    query = (
        df.writeStream.queryName(name.replace("-", "_")).foreachBatch(handle)
        .option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query


# -- API performance -------------------------------------------------------------------
def api_performance(logs: DataFrame, width: str = "5 minutes") -> DataFrame:
    """Requests, mean and P99 latency and server errors per merchant, endpoint and window."""
    return (
        logs.groupBy(F.window("ts", width), "merchant_id", "endpoint")
        .agg(
            F.count("*").alias("request_count"),
            X.mean("latency_ms").alias("avg_latency"),
            F.percentile("latency_ms", F.lit(0.99)).alias("p99_latency"),
            F.count_if(F.col("status_code") >= 500).alias("error_count"),
        )
        .select(F.col("window.end").alias("window_end"), "merchant_id", "endpoint", "request_count", "avg_latency",
                "p99_latency", "error_count")
    )


def api_performance_sketched(logs: DataFrame, width: str = "5 minutes") -> DataFrame:
    """``api_performance`` with a sketch of the latencies in place of their percentile: the state of a window is a few kilobytes."""
    return (
        logs.groupBy(F.window("ts", width), "merchant_id", "endpoint")
        .agg(F.count("*").alias("request_count"), X.mean("latency_ms").alias("avg_latency"),
             F.count_if(F.col("status_code") >= 500).alias("error_count"), value_sketch("latency_ms").alias("latency_sketch"))
        .select(F.col("window.end").alias("window_end"), "merchant_id", "endpoint", "request_count", "avg_latency", "error_count",
                "latency_sketch")
    )


def with_exact_p99(performance: DataFrame, logs: DataFrame, width: str = "5 minutes") -> DataFrame:
    """Closed windows with their exact P99, counted in the stored ``logs`` between the bounds of each window's sketch."""
    keys = ["window_end", "merchant_id", "endpoint"]
    timed = logs.withColumn("window_end", F.window("ts", width)["end"])
    p99 = percentiles_within(timed, performance, keys, "latency_ms", "latency_sketch", {"p99_latency": 0.99})
    return performance.drop("latency_sketch").join(p99, keys, "left")


def _error_windows(logs: DataFrame, width: str, threshold: float) -> DataFrame:
    return (
        logs.groupBy(F.window("ts", width), "merchant_id")
        .agg(F.count("*").alias("total_requests"), F.count_if(F.col("status_code") >= 500).alias("error_count"))
        .withColumn("error_rate", X.ratio("error_count", "total_requests"))
        .filter(F.col("error_rate") > threshold)
    )


def error_spikes(logs: DataFrame, width: str = "1 minute", threshold: float = 0.05) -> DataFrame:
    """Windows of a merchant whose error rate is above the threshold."""
    return _error_windows(logs, width, threshold).select(
        F.col("window.end").alias("window_end"), "merchant_id", "total_requests", "error_count", "error_rate")


def two_window_alerts(logs: DataFrame, width: str = "1 minute", double: str = "2 minutes", threshold: float = 0.05) -> DataFrame:
    """Alert when two consecutive windows breach: a window of twice the width holds two breaches."""
    breaches = _error_windows(logs, width, threshold)
    return (
        breaches.groupBy(F.window(F.window_time("window"), double, width).alias("pair"), "merchant_id")
        .agg(F.count("*").alias("breaches"), F.sum("error_count").alias("error_count"))
        .filter(F.col("breaches") == 2)
        .select(F.col("pair.start").alias("alert_from"), F.col("pair.end").alias("alert_to"), "merchant_id", "error_count")
    )


# -- events --------------------------------------------------------------------------------
def deduplicated(events: DataFrame, event_id: str = "event_id", ts: str = "ts", remember: str = REPLAY) -> DataFrame:
    """First arrival of every id of a stream without watermark. Ids are remembered for as long as the topic can
    replay them; the state store holds that many ids."""
    return events.withWatermark(ts, remember).dropDuplicatesWithinWatermark([event_id])


def velocity(payments: DataFrame, width: str = "1 hour", slide: str = "5 minutes") -> DataFrame:
    """Payments and amount per customer in sliding windows."""
    return (
        payments.groupBy(F.window("ts", width, slide), "customer_id")
        .agg(F.count("*").alias("payments"), F.sum("amount_minor").alias("amount_minor"))
        .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "customer_id",
                "payments", "amount_minor")
    )


def run_velocity(payments: DataFrame, name: str, width: int = 3600, slide: int = 300, delay_seconds: int = 30,
                 path: str | None = None) -> DataFrame:
    """``velocity`` of everything that is there, into a parquet table that is read back; ``width`` is a whole number of ``slide`` seconds.

    A payment lies in many windows, which a state store would all hold. Here a batch is added up per customer and slide, and windows are
    made of these sums when the watermark closes them. As in the stream's own windows, batch n closes by the watermark of the batches before
    and still counts in what it closes; after the last one the watermark of all closes. A restart makes that part again.
    """
    if width % slide:
        raise ValueError("the window must be a whole number of slides")
    spark = payments.sparkSession
    path = path or scratch(spark, name)
    schema = "customer_id " + payments.schema["customer_id"].dataType.simpleString() + ", at bigint, payments bigint, amount_minor bigint"

    def marks(session: SparkSession) -> dict[int, int]:
        """Of every batch that had payments, the newest instant in milliseconds."""
        stored = session.read.schema("batch bigint, ms bigint").option("recursiveFileLookup", True).parquet(f"{path}/marks")
        return {r["batch"]: r["ms"] for r in stored.collect()}

    def watermark(found: dict[int, int], before: int) -> int | None:
        return max((ms - 1000 * delay_seconds for b, ms in found.items() if b < before), default=None)

    def close(session: SparkSession, n: int) -> None:
        """Write what batch ``n`` closes."""
        found = {b: ms for b, ms in marks(session).items() if b <= n}
        last, now = watermark(found, n - 1), watermark(found, n)
        stale = [b for b, ms in found.items() if last is not None and ms + 1000 * width <= last]
        live = [f"{path}/panes/batch={b}" for b in found if b not in stale]
        panes = session.read.schema(schema).parquet(*(live or [f"{path}/none"]))
        windows = sliding_sums(panes, width, slide)
        end = F.unix_micros("window_end")
        closed = windows.filter((end <= 1000 * now) & (end > 1000 * last if last is not None else F.lit(True)) if now is not None else F.lit(False))
        closed.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path}/table/batch={n}")
        for b in stale:
            remove_folder(session, f"{path}/panes/batch={b}")

    def handle(batch: DataFrame, n: int) -> None:
        session = batch.sparkSession
        timed = batch.filter(F.col("ts").isNotNull())
        start = F.unix_micros(F.window("ts", f"{slide} seconds")["start"])
        sums = timed.groupBy("customer_id", start.alias("at")).agg(
            F.count("*").alias("payments"), F.sum("amount_minor").alias("amount_minor"), F.max("ts").alias("newest"))
        with tidy(session):
            sums.write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", "zstd").parquet(f"{path}/panes/batch={n}")
            newest = session.read.schema("newest timestamp").parquet(f"{path}/panes/batch={n}").agg(F.unix_millis(F.max("newest"))).first()[0]
            if newest is not None:
                session.createDataFrame([(n, newest)], "batch bigint, ms bigint").coalesce(1).write.mode("overwrite").option(
                    "partitionOverwriteMode", "static").parquet(f"{path}/marks/b{n}")
            close(session, n)

    none = spark.createDataFrame([], schema)
    made = sliding_sums(none, width, slide).schema
    for where, empty in ((f"{path}/none", schema), (f"{path}/marks/none", "batch bigint, ms bigint"), (f"{path}/table/none", made)):
        spark.createDataFrame([], empty).coalesce(1).write.mode("overwrite").parquet(where)
    run_each_batch(payments.select("customer_id", "ts", F.col("amount_minor").cast("bigint")), name, handle, path)
    with tidy(spark):
        close(spark, max(marks(spark), default=-1) + 1)
    return read_folder(spark, f"{path}/table", made)


def sliding_sums(panes: DataFrame, width: int, slide: int) -> DataFrame:
    """Windows of ``width`` seconds that begin every ``slide`` seconds, from sums (customer_id, at, payments, amount_minor) of slides that begin
    ``at`` (microseconds). A slide is sent to its customer once; a row holds all windows that begin within one width, of which it has two."""
    million, n = 1_000_000, width // slide
    place = F.floor(F.pmod("at", F.lit(width * million)) / (slide * million))
    block = F.col("at") - F.pmod("at", F.lit(width * million)) - F.col("back") * (width * million)
    dealt = panes.repartition("customer_id").select("*", place.alias("place"), F.explode(F.array(F.lit(0), F.lit(1))).alias("back"))
    dealt = dealt.withColumn("block", block)

    def inside(j: int) -> Column:
        return ((F.col("back") == 0) & (F.col("place") >= j)) | ((F.col("back") == 1) & (F.col("place") < j))

    sums = dealt.groupBy("customer_id", "block").agg(*[F.sum(F.when(inside(j), F.col(c))).alias(f"{c}_{j}")
                                                       for j in range(n) for c in ("payments", "amount_minor")])
    windows = F.array(*[F.struct((F.col("block") + j * slide * million).alias("us"), F.col(f"payments_{j}").alias("payments"),
                                 F.col(f"amount_minor_{j}").alias("amount_minor")) for j in range(n)])
    each = sums.select("customer_id", F.inline(windows)).filter(F.col("payments").isNotNull())
    return each.select(F.timestamp_micros("us").alias("window_start"), F.timestamp_micros(F.col("us") + width * million).alias("window_end"),
                       "customer_id", "payments", "amount_minor")


def failed_bursts(payments: DataFrame, width: str = "5 minutes", slide: str = "1 minute", more_than: int = 5) -> DataFrame:
    """Windows in which a customer failed more than ``more_than`` times."""
    return (
        payments.filter(F.col("status") == "FAILED")
        .groupBy(F.window("ts", width, slide), "customer_id")
        .agg(F.count("*").alias("failures"), F.min("ts").alias("first_at"), F.max("ts").alias("last_at"))
        .filter(F.col("failures") > more_than)
        .select(F.col("window.end").alias("window_end"), "customer_id", "failures", "first_at", "last_at")
    )


def sessions(events: DataFrame, gap: str = "15 minutes") -> DataFrame:
    """Sessions of a user that end after ``gap`` without an event."""
    return (
        events.groupBy(F.session_window("ts", gap), "user_id")
        .agg(F.count("*").alias("actions_count"), F.min("ts").alias("session_start"), F.max("ts").alias("last_activity"))
        .select("user_id", "session_start", "last_activity", "actions_count",
                X.seconds_between("session_start", "last_activity").alias("duration_seconds"))
    )


def scored(payments: DataFrame, customers: DataFrame, score, decide) -> DataFrame:
    """Payments enriched from static tables, scored and decided; keeps no state."""
    return decide(payments.join(customers, "customer_id", "left").withColumn("fraud_score", score))


def joined_logs(payments: DataFrame, mentions: DataFrame, seconds: int = 60) -> DataFrame:
    """Interval join of two streams on (merchant, payment): logs within ``seconds`` of the payment.

    ``payments`` has merchant_id, payment_ref, paid_at; ``mentions`` has merchant_id, payment_ref,
    logged_at. The bounds let both sides drop old state.
    """
    near = F.expr(f"logged_at >= paid_at - INTERVAL {int(seconds)} SECONDS AND logged_at <= paid_at + INTERVAL {int(seconds)} SECONDS")
    m = mentions.withColumnRenamed("merchant_id", "_m").withColumnRenamed("payment_ref", "_r")
    same = (F.col("merchant_id") == F.col("_m")) & (F.col("payment_ref") == F.col("_r"))
    return payments.join(m, same & near).drop("_m", "_r")


def run_joined_logs(payments: DataFrame, mentions: DataFrame, name: str, seconds: int = 60, delay_seconds: int = 30,
                    path: str | None = None) -> DataFrame:
    """``joined_logs`` of everything that is there, batch by batch, into a parquet table that is read back.

    A state store holds every candidate of a batch in memory. Here a batch's rows are written and meet one another and those of earlier
    batches that are near enough in a plain join, which spills; batches that nothing can meet any more are removed. As in the stream's own
    join, a row is late when it is not after the watermark (the older of the newest payment and mention, less the delay) of two batches before.
    """
    spark = payments.sparkSession
    path = path or scratch(spark, name)
    ts = {"paid": "paid_at", "said": "logged_at"}
    frames = {"paid": payments, "said": mentions}

    def tagged(mine: str) -> DataFrame:
        sides = [F.struct(*f.columns).alias(side) if side == mine else F.lit(None).cast(f.schema.simpleString()).alias(side)
                 for side, f in frames.items()]
        return frames[mine].select(F.lit(mine).alias("side"), *sides)

    def kept(session: SparkSession, side: str, batches: list[int]) -> DataFrame:
        where = [f"{path}/rows/batch={b}/side={side}" for b in batches]
        stored = f"{side} {frames[side].schema.simpleString()}"
        return session.read.schema(stored).parquet(*[w for w in where if _there(session, w)] or [f"{path}/none/side={side}"]).select(f"{side}.*")

    def handle(batch: DataFrame, n: int) -> None:
        session = batch.sparkSession
        marks = {r["batch"]: {s: r[s] for s in ts} for r in session.read.schema(_MARKS).option("recursiveFileLookup", True).parquet(
            f"{path}/marks").collect() if r["batch"] < n}  # one row per batch that is kept
        newest = {s: max((m[s] for b, m in marks.items() if b < n - 1 and m[s] is not None), default=None) for s in ts}
        late = None if None in newest.values() else min(newest.values()) - 1000 * delay_seconds
        at = F.unix_micros(F.coalesce(*[F.col(f"{s}.{c}") for s, c in ts.items()]))
        fresh = batch.filter(F.col("paid.paid_at").isNotNull() | F.col("said.logged_at").isNotNull())
        with tidy(session):
            (fresh if late is None else fresh.filter(at > 1000 * late)).write.mode("overwrite").option("partitionOverwriteMode", "static").option(
                "compression", "zstd").partitionBy("side").parquet(f"{path}/rows/batch={n}")
            mark = [kept(session, s, [n]).agg((F.unix_micros(F.max(c)) / 1000).cast("bigint")).first()[0] for s, c in ts.items()]
            session.createDataFrame([(n, *mark)], _MARKS).coalesce(1).write.mode("overwrite").option(
                "partitionOverwriteMode", "static").parquet(f"{path}/marks/b{n}")
            sides = {}
            for s, c in ts.items():
                rows = kept(session, s, [n]).withColumn(f"_new_{s}", F.lit(True))
                old = kept(session, s, sorted(marks)).withColumn(f"_new_{s}", F.lit(False)) if marks else None
                if old is not None:
                    near = F.lit(True) if late is None else F.unix_micros(c) >= 1000 * (late - 1000 * seconds)
                    rows = rows.unionByName(old.filter(near))
                sides[s] = rows
            found = joined_logs(sides["paid"], sides["said"], seconds).filter(F.col("_new_paid") | F.col("_new_said"))
            found.drop("_new_paid", "_new_said").write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path}/table/batch={n}")
        if late is not None:
            for b, m in marks.items():
                if b < n - 1 and all(m[s] is None or m[s] + 1 < late - 1000 * seconds for s in ts):
                    remove_folder(session, f"{path}/rows/batch={b}")

    empty = joined_logs(*[spark.createDataFrame([], f.schema) for f in frames.values()], seconds)
    for where, schema in ((f"{path}/table/none", empty.schema), (f"{path}/marks/none", _MARKS), *[
            (f"{path}/none/side={s}", f"{s} {f.schema.simpleString()}") for s, f in frames.items()]):
        spark.createDataFrame([], schema).coalesce(1).write.mode("overwrite").parquet(where)
    run_each_batch(tagged("paid").unionByName(tagged("said")), name, handle, path)
    return read_folder(spark, f"{path}/table", empty.schema)


#: Of a batch, the newest instants of both sides in milliseconds.
_MARKS = "batch bigint, paid bigint, said bigint"


def _there(spark: SparkSession, path: str) -> bool:
    return bool(folder_names(spark, path))


# -- change feed ----------------------------------------------------------------------------
def upsert_by_lsn(path: str, key: str, buckets: int = 64) -> Callable[[DataFrame, int], None]:
    """Batch handler that keeps the latest image per key, rewriting only the touched buckets.

    Deleted keys stay as marked rows, so replays and late changes cannot bring them back.
    """
    def handle(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        after = batch.filter(F.col("op") != 3).withColumn("is_deleted", F.col("op") == 1).drop("op")
        new = materialise(
            latest_per_key(after, [key], *log_order(after)).withColumn("bucket", F.pmod(F.hash(key), F.lit(buckets))), "changes")
        touched = [r["bucket"] for r in new.select("bucket").distinct().collect()]  # at most ``buckets`` numbers
        if not touched:
            return
        schema = spark.createDataFrame([], new.schema).schema
        spark.createDataFrame([], schema).write.mode("append").partitionBy("bucket").parquet(path)  # makes the folder
        old = spark.read.schema(schema).parquet(path).filter(F.col("bucket").isin(touched))
        merged = latest_per_key(old.unionByName(new), [key], *log_order(new)).select(new.columns)
        write_partitions(materialise(merged, "merged"), path, ["bucket"])

    return handle


def current_rows(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).filter(~F.col("is_deleted")).drop("is_deleted", "bucket")


# -- measurements -----------------------------------------------------------------------------
def conversion(events: DataFrame, text: str, schema: str) -> DataFrame:
    """Rows whose JSON text does not parse are marked, not dropped."""
    parsed = F.from_json(F.col(text), f"{schema}, _corrupt STRING",
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    return events.withColumn("_p", parsed).withColumn("malformed", F.col("_p._corrupt").isNotNull()).drop("_p")


def count_batches(path: str) -> Callable[[DataFrame, int], None]:
    """Batch handler that writes how many rows came in and how many were malformed; a repeated batch replaces its own counts."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        counts = batch.agg(F.count("*").alias("input_rows"), F.count_if("malformed").alias("malformed"))
        counts.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path}/batch={batch_id}")

    return handle


def throughput(spark: SparkSession, path: str) -> DataFrame:
    """One row per micro-batch ever counted below ``path``, however many there were and across restarts."""
    return spark.read.schema("input_rows bigint, malformed bigint, batch bigint").parquet(path)
