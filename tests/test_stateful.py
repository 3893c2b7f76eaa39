"""Keyed state: order, exact look-back sums, restarts, sessions in parts, published models."""

from __future__ import annotations

import datetime as dt
import random
import sys

from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from ledgerlark.operators import models, timeslice
from ledgerlark.operators import sessions as S
from ledgerlark.session import scratch
from ledgerlark.streaming import jobs as J
from ledgerlark.streaming import scoring as L
from ledgerlark.streaming import stateful as K

cloudpickle.register_pickle_by_value(sys.modules[__name__])
T0 = dt.datetime(2024, 1, 1)
PAID = "ts timestamp, customer_id bigint, payment_id bigint, amount_minor bigint"


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def write(spark, path, schema, *batches):
    for batch in batches:
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(path)


def run(spark, path, schema, build, name, at_path):
    stream = J.watermarked(J.file_stream(spark, path, schema, files_per_batch=1), delay="10 minutes")
    with K.state_store(spark):
        return J.run_available(build(stream), name, at_path)


def payments(n=400, seed=1):
    """Late by up to ten minutes, many at one instant, a third of them of one customer."""
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        second = i * 700 + rnd.choice([0, 0, 300])
        out.append((at(second - second % 100), rnd.choice([1, rnd.randint(2, 9), rnd.randint(2, 9)]), i, rnd.choice([None, rnd.randint(1, 10**12)])))
        out.append((out[-1][0], 1, n + i, 5))
    for i in range(0, len(out) - 1, 5):
        if abs((out[i][0] - out[i + 1][0]).total_seconds()) < 600:
            out[i], out[i + 1] = out[i + 1], out[i]
    return out


def look_back(stream):
    return K.look_back_sums(stream, "customer_id", "payment_id", ["amount_minor"], {"1h": 3600, "24h": 86400})


COLUMNS = ["payment_id", "n_1h", "amount_minor_1h", "n_24h", "amount_minor_24h"]


def batch_sums(spark, data):
    df = spark.createDataFrame(data, PAID)
    return timeslice.rolling_sums(df.na.fill(0, ["amount_minor"]), ["customer_id"], "ts", "payment_id", {
        "n_1h": ("1", 3600), "amount_minor_1h": ("amount_minor", 3600), "n_24h": ("1", 86400), "amount_minor_24h": ("amount_minor", 86400)})


def test_look_back_equals_the_batch_over_restarts(spark):
    data, path, out = payments(), scratch(spark, "feed"), scratch(spark, "velocity")
    write(spark, path, PAID, data[:100], data[100:300])
    run(spark, path, PAID, look_back, "velocity", out)
    write(spark, path, PAID, data[300:301], data[301:650])
    first = run(spark, path, PAID, look_back, "velocity", out).count()
    write(spark, path, PAID, data[650:], [(at(10**7), 99, -1, 0)])
    got = rows(run(spark, path, PAID, look_back, "velocity", out).select(COLUMNS), "payment_id")
    assert got == rows(batch_sums(spark, data).select(COLUMNS), "payment_id") and 0 < first < len(got) == len(data)


def test_idle_keys_leave_no_state(spark):
    path, out = scratch(spark, "feed"), scratch(spark, "idle")
    write(spark, path, PAID, [(at(0), 1, 1, 5), (at(60), 2, 2, 5)], [(at(10 * 86400), 3, 3, 5)], [(at(20 * 86400), 4, 4, 5)], [(at(20 * 86400 + 1), 4, 5, 5)])
    run(spark, path, PAID, look_back, "idle", out)
    state = spark.read.format("statestore").option("path", f"{out}/checkpoint")
    left = {name: {r.key[0] for r in state.option("stateVarName", name).load().collect()} for name in ("sums", "log", "pending")}
    assert left["sums"] == set() and left["log"] == set() and left["pending"] == {4}


class Gaps(K.InOrder):
    """Seconds since the key's row before."""

    def prepare(self, handle):
        self.last = handle.getValueState("last", "us bigint")

    def in_order(self, key, rows, mark):
        last = self.last.get()
        for us, row_id in rows:
            yield *key, row_id, None if last is None else (us - last[0]) // 1_000_000
            last = (us,)
        if rows:
            self.last.update(last)


def test_own_processors_see_rows_in_order(spark):
    schema = "ts timestamp, k string, row_id bigint"
    path = scratch(spark, "feed")
    write(spark, path, schema, [(at(50), "a", 2), (at(10), "a", 1), (at(0), "b", 3), (at(70), None, 6)], [(at(400), "b", 4), (at(20), "a", 5)],
          [(at(9000), "z", 0)])
    held, output = T.StructType.fromDDL("us bigint, row_id bigint"), T.StructType.fromDDL("k string, row_id bigint, gap bigint")
    got = run(spark, path, schema, lambda s: K.in_event_order(s, "k", Gaps(held, output)), "gaps", scratch(spark, "gaps"))
    assert rows(got, "row_id") == [("a", 1, None), ("a", 2, 30), ("b", 3, None), ("b", 4, 400), ("a", 5, 10), (None, 6, None)]


EVENTS = "ts timestamp, user_id bigint, event_type string, page string, device_type string"


def clicks():
    rnd = random.Random(3)
    out = []
    for user in range(4):
        second = rnd.randint(0, 50)
        for _ in range(60):
            second += rnd.choice([0, 5, 61, 899, 900, 901, 2000])
            out.append((at(second), user, rnd.choice(["view", "click"]), ["/a", "/b", None][second % 3], rnd.choice(["tv", "phone", None])))
    out += [(at(i * 30), 7, "view", "/long", "tv") for i in range(2000)]
    return sorted(out, key=lambda r: r[0])


def test_sessions_in_parts_equal_the_batch(spark):
    data, path, out = clicks(), scratch(spark, "feed"), scratch(spark, "sessions")

    def build(stream):
        return K.session_documents(stream, gap=900, chunk=50)

    write(spark, path, EVENTS, data[:700], data[700:1500])
    run(spark, path, EVENTS, build, "sessions", out)
    write(spark, path, EVENTS, data[1500:], [(at(10**7), 99, "end", "/", None)])
    got = run(spark, path, EVENTS, build, "sessions", out)
    assert got.agg(F.max(F.size("events"))).first()[0] == 50
    long = rows(got.filter("user_id = 7").select("chunk", "closed", F.size("events")), "chunk")
    assert long == [(i, i == 39, 50) for i in range(40)]
    batch = S.session_documents(spark.createDataFrame(data, EVENTS), "2030-01-01 00:00:00", gap=900)
    facts = ["user_id", "session_start", "last_activity", "actions_count", "duration_seconds", "device_type"]
    assert rows(got.filter("closed").select(facts), *facts[:2]) == rows(batch.select(facts), *facts[:2])
    page = ["user_id", "session_start", "page", "count", "total_time_seconds"]
    want = batch.select("user_id", "session_start", F.inline("page_views"))
    assert rows(K.whole_sessions(got).select(page), *page) == rows(want.select(page), *page)
    seen = [(r.timestamp, r.user_id, r.event_type, r.page) for r in got.select("user_id", F.inline("events")).collect()]
    assert sorted(seen, key=str) == sorted((r[:4] for r in data), key=str)


def test_a_new_model_is_used_from_the_next_batch_on(spark, tables):
    from ledgerlark.registry.features import RULES
    from ledgerlark.registry.models import SMALL, training_rows

    training = training_rows(tables)
    folder, path, feed = scratch(spark, "models"), scratch(spark, "scored"), scratch(spark, "feed")
    one, two = (models.train(training, L.LIVE, params={**SMALL, "maxIter": n}) for n in (1, 3))
    paid = tables.payments().orderBy("ts")
    for low, high in ((0, 300), (300, 600)):
        paid.filter(F.col("payment_id").between(low, high - 1)).coalesce(1).write.mode("append").parquet(feed)
    assert models.publish(one, folder) == 1
    handle, versions = L.score_batches(folder, path), []

    def publish_between(batch, batch_id):
        handle(batch, batch_id)
        if not versions:
            versions.append(models.publish(two, folder))

    stream = J.watermarked(J.file_stream(spark, feed, paid.schema, files_per_batch=1))
    with K.state_store(spark):
        J.run_each_batch(L.live_features(stream, RULES), "versions", publish_between, path=scratch(spark, "versions"))
    got = spark.read.option("basePath", path).parquet(f"{path}/*")
    by = {r.model_version: r.n for r in got.groupBy("model_version").agg(F.count("*").alias("n")).collect()}
    assert set(by) <= {1, 2} and by[2] > 200
    late = got.filter("model_version = 2")
    same = late.join(models.score(two, training, L.LIVE, ["payment_id"]).withColumnRenamed("fraud_score", "batch_score"), "payment_id")
    assert same.filter(F.abs(F.col("exact_score") - F.col("batch_score")) > 1e-9).count() == 0 and same.count() == by[2]
