"""Keyed state in streams: rows of a key in event-time order, exact look-back sums, and session documents.

``InOrder`` is the hook for custom operators: it holds a key's rows until the watermark has passed them and then hands them over sorted,
so that a subclass sees each row once and in order, however late inside the watermark it came. State lives in the RocksDB store; timers
wake a key when its next row is due or its state can go, which is the event-time form of a time to live.

Times are microseconds (``us``) inside the processors. The code of this module travels with the job; a module with processors of its own
is shipped with the job or registered with ``cloudpickle.register_pickle_by_value``.
"""

from __future__ import annotations

import sys
from bisect import bisect_right
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from decimal import Decimal

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ledgerlark.functions import expr as X

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
MILLION = 1_000_000


@contextmanager
def state_store(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB, which keyed state needs and which may exceed the memory."""
    before = {k: spark.conf.get(k, None) for k in _STORE}
    for k, v in _STORE.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _order(row: tuple) -> tuple:
    return tuple((x is not None, x) for x in row)


class InOrder(StatefulProcessor):
    """Base of processors whose keys see rows in the order of ``us``; rows of one instant in the order of their other columns.

    ``schema`` are the columns to hold, ``us`` first. Subclasses give ``in_order`` and may give ``prepare`` and ``wake_at``.
    """

    def __init__(self, schema: T.StructType, output: T.StructType):
        self.schema = schema
        self.output = output

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pending = handle.getListState("pending", self.schema)
        self.alarm = handle.getValueState("alarm", "at bigint")
        self.prepare(handle)

    def prepare(self, handle: StatefulProcessorHandle) -> None:
        """Declare further state."""

    def in_order(self, key: tuple, rows: list[tuple], mark: int) -> Iterator[tuple]:
        """Output rows; ``rows`` are all up to ``mark`` that were not seen before; called without rows when the key wakes."""
        raise NotImplementedError

    def wake_at(self) -> int | None:
        """When, later than the mark, the key wants to be called without rows."""
        return None

    def _arm(self, us: int) -> None:
        at, now = -(-us // 1000), self.alarm.get()
        if now is None or at < now[0]:
            if now is not None:
                self.handle.deleteTimer(now[0])
            self.handle.registerTimer(at)
            self.alarm.update((at,))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        arrived = [tuple(r[f.name] for f in self.schema) for r in rows]
        self.pending.appendList(arrived)
        self._arm(min(r[0] for r in arrived))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        self.alarm.clear()
        rows = sorted((tuple(r) for r in self.pending.get()), key=_order) if self.pending.exists() else []
        due = bisect_right(rows, mark, key=lambda r: r[0])
        if rows[due:]:
            self.pending.put(rows[due:])
        else:
            self.pending.clear()
        made = Row(*self.output.names)
        for values in self.in_order(key, rows[:due], mark):
            yield made(*values)
        later = [r[0] for r in rows[due:due + 1]] + [x for x in (self.wake_at(),) if x is not None]
        if later:
            self._arm(max(min(later), mark + 1))

    def close(self) -> None:
        pass


def in_event_order(df: DataFrame, key: str, processor: InOrder, ts: str = "ts") -> DataFrame:
    """Run ``processor`` per ``key`` over a watermarked stream that has the processor's columns."""
    return df.withColumn("us", F.unix_micros(ts)).groupBy(key).transformWithState(processor, processor.output, "append", "EventTime")


# -- look-back sums ------------------------------------------------------------------
class LookBack(InOrder):
    """Exact sums over the rows of the last ``spans`` seconds strictly before each row.

    The log of a key is kept in buckets; every span has a running sum and a place in the log up to which rows have left it, so a
    row is added once and taken out once per span, and a call reads only the buckets at these places. Rows have ``us``, the row's
    id, the numbers to be summed, and what else shall come out with the sums. With ``ever`` the sums of all times stay, one row per key; without, an idle key leaves nothing.
    """

    BUCKETS = 144

    def __init__(self, schema: T.StructType, output: T.StructType, spans: Mapping[str, int], numbers: int, ever: bool = False):
        super().__init__(schema, output)
        self.spans = {n: s * MILLION for n, s in spans.items()}
        self.longest = max(self.spans.values())
        self.width = max(self.longest // self.BUCKETS, 1)
        self.ever = ever
        self.numbers = numbers

    def prepare(self, handle: StatefulProcessorHandle) -> None:
        values = T.ArrayType(T.ArrayType(T.DecimalType(38, 0)))
        place = T.ArrayType(T.LongType())
        self.log = handle.getMapState("log", "bucket bigint", T.StructType(
            [T.StructField("us", place), T.StructField("numbers", T.ArrayType(place))]))
        self.sums = handle.getValueState("sums", T.StructType([
            T.StructField("sums", values), T.StructField("bucket", place), T.StructField("offset", place), T.StructField("last", T.LongType())]))

    def in_order(self, key: tuple, rows: list[tuple], mark: int) -> Iterator[tuple]:
        names, end = [*self.spans, *(["all"] if self.ever else [])], 2 + self.numbers
        held = self.sums.get()
        if held is None:
            if not rows:
                return
            held = ([[0] * (self.numbers + 1) for _ in names], [-1] * len(self.spans), [0] * len(self.spans), None)
        sums = [[int(x) for x in s] for s in held[0]]
        at, offset, last = list(held[1]), list(held[2]), held[3]
        buckets = sorted(k[0] for k in self.log.keys())
        read, changed = {}, set()

        def bucket(k: int) -> tuple[list, list]:
            if k not in read:
                found = self.log.getValue((k,)) if k in buckets else None
                read[k] = ([], []) if found is None else (list(found[0]), [list(n) for n in found[1]])
            return read[k]

        def leave(now: int) -> None:
            """Take out of each sum what is older than its span at ``now``."""
            for i, span in enumerate(self.spans.values()):
                while True:
                    if at[i] not in buckets:
                        following = bisect_right(buckets, at[i])
                        if following == len(buckets):
                            break
                        at[i], offset[i] = buckets[following], 0
                    us, numbers = bucket(at[i])
                    if offset[i] == len(us):
                        following = bisect_right(buckets, at[i])
                        if following == len(buckets):
                            break
                        at[i], offset[i] = buckets[following], 0
                        continue
                    if us[offset[i]] >= now - span:
                        break
                    sums[i] = [a - b for a, b in zip(sums[i], [1, *numbers[offset[i]]], strict=True)]
                    offset[i] += 1

        first = 0
        while first < len(rows):
            now, after = rows[first][0], first
            while after < len(rows) and rows[after][0] == now:
                after += 1
            leave(now)
            for row in rows[first:after]:
                yield *key, row[1], now, last, *[Decimal(x) for s in sums for x in s], *row[end:]
            k = now // self.width
            us, numbers = bucket(k)
            if not buckets or buckets[-1] < k:
                buckets.append(k)
            for row in rows[first:after]:
                us.append(now)
                numbers.append(list(row[2:end]))
                sums = [[a + b for a, b in zip(s, [1, *row[2:end]], strict=True)] for s in sums]
            changed.add(k)
            last, first = now, after
        leave(mark)
        oldest = min(at)
        for k in buckets:
            if k < oldest or (k + 1) * self.width <= mark - self.longest:
                self.log.removeKey((k,))
                changed.discard(k)
        for k in changed:
            self.log.updateValue((k,), read[k])
        if not self.ever and last < mark - self.longest:
            self.sums.clear()
        else:
            self.sums.update(([[Decimal(x) for x in s] for s in sums], at, offset, last))

    def wake_at(self) -> int | None:
        held = self.sums.get()
        return None if held is None or not any(self.log.keys()) else held[3] + self.longest + MILLION


def look_back_sums(df: DataFrame, key: str, row_id: str, numbers: list[str], spans: Mapping[str, int], ever: bool = False,
                   ts: str = "ts", carry: Sequence[str] = ()) -> DataFrame:
    """``row_id`` with ``n_<span>`` and one ``<number>_<span>`` per number: what the key's earlier rows of the span add up to.

    A row comes out once the watermark has passed it, with its ``carry`` columns. ``numbers`` are whole numbers, a null counts as 0; sums are
    exact (decimals). ``last_us`` is the instant of the key's row before, as far as the longest span reaches back (with ``ever``: always).
    """
    names = [*spans, *(["all"] if ever else [])]
    values = [F.coalesce(F.col(n).cast("bigint"), F.lit(0)).alias(n) for n in numbers]
    source = df.select(key, ts, row_id, *values, *[F.col(c).alias(f"c_{c}") for c in carry])
    held = source.select(F.unix_micros(ts).alias("us"), row_id, *numbers, *[f"c_{c}" for c in carry]).schema
    output = T.StructType([df.schema[key], df.schema[row_id], T.StructField("us", T.LongType()), T.StructField("last_us", T.LongType()),
                           *[T.StructField(f"{n}_{s}", T.DecimalType(38, 0)) for s in names for n in ("n", *numbers)],
                           *[T.StructField(f"c_{c}", df.schema[c].dataType) for c in carry]])
    summed = in_event_order(source, key, LookBack(held, output, spans, len(numbers), ever), ts)
    return summed.withColumnsRenamed({f"c_{c}": c for c in carry})


# -- session documents ---------------------------------------------------------------
_EVENT = "struct<us: bigint, event_type: string, page: string>"
_PAGE = "struct<page: string, count: bigint, total_time_seconds: bigint>"
_DOCUMENT = (f"session_us bigint, chunk bigint, closed boolean, last_us bigint, actions_count bigint, device_type string, "
             f"events array<{_EVENT}>, page_views array<{_PAGE}>")


class Sessions(InOrder):
    """Gathers a user's events until ``gap`` seconds pass without one. A document holds at most ``chunk`` events, so a session that never
    pauses comes out in numbered parts, the last of them ``closed``. Events have ``us``, event_type, page and device_type."""

    def __init__(self, schema: T.StructType, output: T.StructType, gap: int, chunk: int):
        super().__init__(schema, output)
        self.gap, self.chunk = gap * MILLION, chunk

    def prepare(self, handle: StatefulProcessorHandle) -> None:
        self.open = handle.getValueState("open", "start bigint, last bigint, part bigint, actions bigint, device string")
        self.events = handle.getListState("events", "us bigint, event_type string, page string, stay bigint")

    def _document(self, key: tuple, session: tuple, events: list[tuple], closed: bool) -> tuple:
        start, last, part, actions, device = session
        pages: dict = {}
        for _, _, page, stay in events:
            n, seconds = pages.get(page, (0, 0))
            pages[page] = (n + 1, seconds + stay)
        views = [(p, *pages[p]) for p in sorted(pages, key=lambda p: (p is not None, p))]
        return (*key, start, part, closed, last, actions, device, [e[:3] for e in events], views)

    def in_order(self, key: tuple, rows: list[tuple], mark: int) -> Iterator[tuple]:
        session = self.open.get()
        events = [tuple(e) for e in self.events.get()] if session is not None else []
        for us, event_type, page, device in rows:
            if session is not None:
                start, last, part, actions, held = session
                if us - last > self.gap:
                    yield self._document(key, session, events, True)
                    session, events = None, []
                else:
                    events[-1] = (*events[-1][:3], (us - last) // MILLION)
                    if len(events) == self.chunk:
                        yield self._document(key, session, events, False)
                        part, events = part + 1, []
                    newest = held if device is None or (held is not None and held > device) else device
                    session = (start, us, part, actions + 1, newest)
            if session is None:
                session = (us, us, 0, 1, device)
            events.append((us, event_type, page, 0))
        if session is not None and mark >= session[1] + self.gap:
            yield self._document(key, session, events, True)
            session, events = None, []
        if session is None:
            self.open.clear()
            self.events.clear()
        else:
            self.open.update(session)
            self.events.put(events)

    def wake_at(self) -> int | None:
        session = self.open.get()
        return None if session is None else session[1] + self.gap


def session_documents(events: DataFrame, gap: int = 15 * 60, chunk: int = 1000, user: str = "user_id", ts: str = "ts") -> DataFrame:
    """Documents of closed sessions and of the full parts of open ones, from columns user, ts, event_type, page, device_type.

    ``actions_count``, ``last_activity``, ``device_type`` and ``duration_seconds`` of the closed part are those of the whole session; ``events``
    and ``page_views`` are the part's own (see ``whole_sessions``). Seconds on a page run to the next event of the session.
    """
    source = events.select(user, ts, "event_type", "page", "device_type")
    held = source.select(F.unix_micros(ts).alias("us"), "event_type", "page", "device_type").schema
    output = T.StructType([source.schema[user], *T.StructType.fromDDL(_DOCUMENT)])
    found = in_event_order(source, user, Sessions(held, output, gap, chunk), ts)
    start, last = F.timestamp_micros("session_us"), F.timestamp_micros("last_us")
    return found.select(
        F.concat_ws("_", F.lit("sess"), user, "session_us").alias("session_id"), user, start.alias("session_start"), "chunk", "closed",
        last.alias("last_activity"), "actions_count", X.seconds_between(start, last).alias("duration_seconds"), "device_type",
        F.transform("events", lambda e: F.struct(F.timestamp_micros(e["us"]).alias("timestamp"), e["event_type"].alias("event_type"),
                                                 e["page"].alias("page"))).alias("events"), "page_views")


def whole_sessions(documents: DataFrame, user: str = "user_id") -> DataFrame:
    """One row per closed session and page, with the counts and seconds of all its parts."""
    closed = documents.filter("closed").select(
        "session_id", user, "session_start", "last_activity", "actions_count", "duration_seconds", "device_type")
    pages = documents.select("session_id", F.inline("page_views")).groupBy("session_id", "page").agg(
        F.sum("count").alias("count"), F.sum("total_time_seconds").alias("total_time_seconds"))
    return closed.join(pages, "session_id")
