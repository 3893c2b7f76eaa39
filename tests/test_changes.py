"""A table kept from a change feed against a plain replay of the log."""

from __future__ import annotations

import random

from conftest import rows
from ledgerlark.operators import warehouse as L
from ledgerlark.session import folder_names, scratch
from ledgerlark.streaming.changes import ChangeStore

LOG = "payment_id bigint, lsn bigint, op int, status string"


def plain(log):
    last = {}
    for key, lsn, op, status in sorted(log, key=lambda r: r[1]):
        if op != 3:
            last[key] = (op, status)
    return sorted((k, s) for k, (op, s) in last.items() if op != 1)


def shown(store):
    return rows(store.read().select("payment_id", "status"), "payment_id")


def test_versions_equal_a_replay_and_the_folder_stays_small(spark):
    rnd = random.Random(9)
    store, log = ChangeStore(spark, scratch(spark, "changes"), "payment_id", buckets=2), []
    assert store.read() is None and store.get(1) is None and store.unfolded() == 0
    store.fold(5)
    handle, sizes = store.handler(fold_every=3), []
    for batch in range(10):
        # Late changes come in later batches, with smaller numbers than what is there already.
        part = [(rnd.randint(1, 12), 1000 * (batch - rnd.choice([0, 0, 2])) + 40 * i + batch, rnd.choice([1, 2, 3, 4, 4]), f"s{batch}-{i}")
                for i in range(6)]
        log += part
        handle(spark.createDataFrame(part, LOG), batch)
        assert shown(store) == plain(log)
        sizes.append(len(folder_names(spark, f"{store.root}/batches")) + len(folder_names(spark, f"{store.root}/base")))
    # Two bases and the pointers; three batches that the last fold replaced, and fewer than three after it.
    assert max(sizes) <= 3 + 3 + 2 and sizes[-1] < 10
    for key in (1, 5, 12):
        assert rows(store.get(key).select("payment_id", "status")) == [r for r in plain(log) if r[0] == key]


def test_replays_empty_batches_and_untouched_files(spark):
    store = ChangeStore(spark, scratch(spark, "changes"), "payment_id", buckets=2)
    first = spark.createDataFrame([(1, 1, 2, "A"), (2, 2, 2, "A"), (None, 3, 2, "N")], LOG)
    store.apply(first, 0)
    written = sorted(store.spark.read.parquet(f"{store.batches}/batch=0").inputFiles())
    store.apply(spark.createDataFrame([(1, 4, 4, "B"), (2, 5, 1, "A")], LOG), 1)
    assert sorted(store.spark.read.parquet(f"{store.batches}/batch=0").inputFiles()) == written
    store.apply(first.limit(0), 2)
    want = [(None, "N"), (1, "B")]
    assert shown(store) == want
    store.fold(2)
    store.apply(first, 0)  # a replay of what is folded
    assert shown(store) == want and store.unfolded() == 0
    store.apply(first, 3)  # the same changes once more, as a new batch: the deleted key stays deleted
    assert shown(store) == want and rows(store.get(None).select("status")) == [("N",)]
    plan = store.get(1)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan


def test_binary_sequence_numbers(spark):
    """Ten-byte numbers compare by their unsigned bytes."""
    def lsn(n):
        return bytearray(n.to_bytes(10, "big"))

    log = spark.createDataFrame([(1, lsn(0x7F), 2, "A"), (1, lsn(0x80), 4, "B"), (1, lsn(1 << 72), 4, "C"), (2, lsn(0xFF), 2, "A"),
                                 (2, lsn(0x100), 4, "B")], "payment_id bigint, lsn binary, op int, status string")
    net = L.net_changes(log, "payment_id").select("payment_id", "status")
    assert rows(net, "payment_id") == [(1, "C"), (2, "B")]
    some = L.net_changes(log, "payment_id", from_lsn=lsn(0x80), to_lsn=lsn(0xFF)).select("payment_id", "status", "change_type")
    assert rows(some, "payment_id") == [(1, "B", "UPDATE"), (2, "A", "INSERT")]
    store = ChangeStore(spark, scratch(spark, "changes"), "payment_id")
    store.apply(log, 0)
    assert shown(store) == [(1, "C"), (2, "B")]
