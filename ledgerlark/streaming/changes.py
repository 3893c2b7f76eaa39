"""A table kept from a change feed: batches are appended as versions, reads take the latest image of a key, folding is apart.

A batch writes its own rows only; nothing that lies there is read or rewritten, so a batch costs what it brings. ``fold`` merges the
versions into a base now and then; the base becomes visible by its pointer, and what it replaces stays until the next one, for readers
that began before. A write that fails leaves no pointer and no trace in results.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.operators.ranking import latest_per_key
from ledgerlark.operators.warehouse import log_order
from ledgerlark.session import folder_names, remove_folder
from ledgerlark.sources.tables import PublishedTable


class ChangeStore:
    """Rows by ``key`` below ``root``, from changes with ``op`` and ``lsn`` (and ``seqval`` where the log has it).

    Batches are known by number; writing one again replaces it, and one that is folded already is ignored. Deleted keys stay as marked
    rows, so replays and late changes cannot bring them back. Images of equal order go by the later batch. Rows lie in hash buckets of
    the key; take their number so that a bucket of the base is some hundred MB. A null key is a key like any other. One writer at a time.
    """

    def __init__(self, spark: SparkSession, root: str, key: str, buckets: int = 64):
        self.spark, self.root, self.key, self.buckets = spark, root.rstrip("/"), key, buckets
        self.base, self.batches = PublishedTable(spark, f"{self.root}/base"), f"{self.root}/batches"

    def _bucket(self, key):
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def apply(self, changes: DataFrame, batch: int) -> None:
        after = changes.filter(F.col("op") != 3).withColumn("is_deleted", F.col("op") == 1).drop("op")
        rows = latest_per_key(after, [self.key], *log_order(after)).withColumn("bucket", self._bucket(F.col(self.key)))
        rows.hint("rebalance", "bucket").sortWithinPartitions("bucket", self.key).write.mode("overwrite").option(
            "partitionOverwriteMode", "static").partitionBy("bucket").parquet(f"{self.batches}/batch={int(batch)}")

    def _versions(self) -> DataFrame | None:
        """The base and the batches after it, with ``batch``; None before the first row."""
        base = self.base.read()
        if base is None:
            try:
                return self.spark.read.parquet(self.batches)
            except AnalysisException as e:
                if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                    return None
                raise
        upto, base = self._folded(base), base.drop("folded")
        later = self.spark.read.schema(base.schema).parquet(self.batches).filter(F.col("batch") > upto)
        return base.unionByName(later)

    @staticmethod
    def _folded(base: DataFrame) -> int:
        """The last batch that a base contains; -1 where it has no rows, which no batch can change."""
        row = base.select("folded").first()
        return row["folded"] if row else -1

    def _latest(self, rows: DataFrame) -> DataFrame:
        columns = rows.columns
        return latest_per_key(rows, [self.key], *log_order(rows), "batch").select(*columns)

    def _shown(self, rows: DataFrame) -> DataFrame:
        return self._latest(rows).filter(~F.col("is_deleted")).drop("is_deleted", "bucket", "batch")

    def read(self) -> DataFrame | None:
        """The current rows; None before the first."""
        rows = self._versions()
        return None if rows is None else self._shown(rows)

    def get(self, key) -> DataFrame | None:
        """The row of one key; one bucket of the base and of each batch is opened."""
        rows = self._versions()
        if rows is None:
            return None
        value = F.lit(key).cast(rows.schema[self.key].dataType)
        return self._shown(rows.filter((F.col("bucket") == self._bucket(value)) & F.col(self.key).eqNullSafe(value)))

    def _numbers(self) -> list[int]:
        return sorted(int(n.removeprefix("batch=")) for n in folder_names(self.spark, self.batches) if n.startswith("batch="))

    def unfolded(self) -> int:
        base = self.base.read()
        upto = -1 if base is None else self._folded(base)
        return sum(n > upto for n in self._numbers())

    def fold(self, upto: int) -> None:
        """Make a base of everything up to batch ``upto``; remove what the base before this one had replaced."""
        rows = self._versions()
        if rows is None:
            return
        before = self.base.read()
        replaced = -1 if before is None else self._folded(before)
        if upto <= replaced:
            return
        merged = self._latest(rows.filter(F.col("batch") <= upto)).withColumn("folded", F.lit(int(upto)))
        self.base.publish(merged.hint("rebalance", "bucket").sortWithinPartitions("bucket", self.key), by=["bucket"])
        for n in self._numbers():
            if n <= replaced:
                remove_folder(self.spark, f"{self.batches}/batch={n}")
        if self.base.version > 2:
            remove_folder(self.spark, f"{self.base.root}/v{self.base.version - 2}")

    def handler(self, fold_every: int = 16) -> Callable[[DataFrame, int], None]:
        """For ``foreachBatch``: apply, and fold once ``fold_every`` batches lie there."""
        def handle(changes: DataFrame, batch: int) -> None:
            self.apply(changes, batch)
            if self.unfolded() >= fold_every:
                self.fold(batch)

        return handle
