"""Look-back, running and as-of operators over event time that stay safe for busy keys.

A plain window holds one key in one task. Here a key with more than ``hot_rows`` rows is cut
into time slices that are processed apart, and what earlier slices contribute is carried over
through one summary row per (key, slice); the number of slices of a key is bounded by the
calendar. Without busy keys the plan is the plain window with a single shuffle. ``hot_rows=0``
slices every key, ``None`` none. Keys must not be null.

A sliding sum is a running sum with expiries: a row adds its value at its own time and takes
it back ``seconds`` later. Look-back windows are ``[t - seconds, t)``: rows at the same instant
do not see each other.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOT_ROWS = 1_000_000
SLICE_SECONDS = 3600
BROADCAST_KEYS = 100_000


def micros(c: str | Column) -> Column:
    return F.unix_micros(F.col(c) if isinstance(c, str) else c)


def _slice(us: Column, seconds: int) -> Column:
    size = F.lit(seconds * 1_000_000)
    return ((us - F.pmod(us, size)) / size).cast("bigint")


def busy_keys(df: DataFrame, keys: Sequence[str], hot_rows: int) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("_n")).filter(F.col("_n") > hot_rows).select(*keys)


def no_busy_keys(df: DataFrame, keys: Sequence[str], hot_rows: int | None) -> bool:
    """Whether every key stays within ``hot_rows``. Then finer keys do too, and ``hot_rows=None`` skips their count."""
    return hot_rows is None or (hot_rows > 0 and busy_keys(df, keys, hot_rows).isEmpty())


def with_slices(df: DataFrame, keys: Sequence[str], us: str, hot_rows: int | None, seconds: int) -> tuple[DataFrame, bool]:
    """Add ``_slice``; True when some key was cut. The list of busy keys is broadcast after counting it."""
    if hot_rows is None:
        return df.withColumn("_slice", F.lit(0).cast("bigint")), False
    if hot_rows <= 0:
        return df.withColumn("_slice", _slice(F.col(us), seconds)), True
    busy = busy_keys(df, keys, hot_rows)
    n = busy.count()
    if n == 0:
        return df.withColumn("_slice", F.lit(0).cast("bigint")), False
    busy = busy.withColumn("_busy", F.lit(True))
    marked = df.join(F.broadcast(busy) if n <= BROADCAST_KEYS else busy, list(keys), "left")
    cut = F.when(F.col("_busy"), _slice(F.col(us), seconds)).otherwise(F.lit(0))
    return marked.withColumn("_slice", cut.cast("bigint")).drop("_busy"), True


def running_before(df: DataFrame, keys: Sequence[str], us: str, sums: Mapping[str, str], latest: Mapping[str, str] = {},
                   hot_rows: int | None = HOT_ROWS, seconds: int = SLICE_SECONDS) -> DataFrame:
    """Add values over the rows of the key strictly before this instant.

    ``sums`` maps a new column to the SQL expression to add up; ``latest`` maps a new column to a
    struct that starts with the time, of which the largest (= latest) one is taken. The rows are
    shuffled as they come; the expressions are evaluated behind the shuffle.
    """
    df, cut = with_slices(df, keys, us, hot_rows, seconds)
    by = ", ".join(keys)
    df = df.repartition(*keys, "_slice") if cut else df.repartition(*keys)
    inside = f"PARTITION BY {by}, _slice ORDER BY {us} RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    out = df.selectExpr(
        "*",
        *[f"coalesce(sum({c}) OVER ({inside}), 0) AS {o}" for o, c in sums.items()],
        *[f"max({c}) OVER ({inside}) AS {o}" for o, c in latest.items()],
    )
    if cut:
        earlier = f"PARTITION BY {by} ORDER BY _slice ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
        totals = df.groupBy(*keys, "_slice").agg(
            *[F.expr(f"sum({c}) AS _t_{o}") for o, c in sums.items()],
            *[F.expr(f"max({c}) AS _t_{o}") for o, c in latest.items()])
        carried = totals.selectExpr(
            *keys, "_slice", *[f"coalesce(sum(_t_{o}) OVER ({earlier}), 0) AS _c_{o}" for o in sums],
            *[f"max(_t_{o}) OVER ({earlier}) AS _c_{o}" for o in latest])
        out = out.join(carried, [*keys, "_slice"]).selectExpr(
            *df.columns, *[f"{o} + _c_{o} AS {o}" for o in sums], *[f"coalesce({o}, _c_{o}) AS {o}" for o in latest])
    return out.drop("_slice")


def with_expiries(df: DataFrame, us: str, lengths: Sequence[int], keep: Sequence[str], carry: Sequence[str]) -> DataFrame:
    """Every row at its own time (``_after`` 0) and once more ``_after`` seconds later per window length.

    ``keep`` are the columns the expiries need; the ``carry`` columns are null on expiries.
    """
    after = ", ".join(f"{s}L" for s in [0, *sorted(set(lengths))])
    return df.select("*", F.expr(f"explode(array({after})) AS _after")).selectExpr(
        *keep, "_after", f"{us} + _after * 1000000 AS _us", *[f"CASE WHEN _after = 0 THEN {c} END AS {c}" for c in carry])


def look_back(value: str, seconds: int | None) -> str:
    """What a row of ``with_expiries`` adds to the sum of ``value`` over the last ``seconds`` (None: ever)."""
    expiry = f" WHEN _after = {seconds} THEN -({value})" if seconds else ""
    return f"CASE WHEN _after = 0 THEN {value}{expiry} END"


def rolling_sums(df: DataFrame, keys: Sequence[str], ts: str, row_id: str, windows: Mapping[str, tuple[str, int]],
                 hot_rows: int | None = HOT_ROWS, seconds: int = SLICE_SECONDS) -> DataFrame:
    """``row_id`` with one look-back sum per entry of ``windows`` (name: (column, seconds)); column ``1`` counts."""
    values = sorted({c for c, _ in windows.values() if c != "1"} - set(keys))
    stream = with_expiries(df.withColumn("_t", micros(ts)), "_t", [s for _, s in windows.values()], [*keys, *values], [row_id])
    sums = {f"_r_{m}": look_back("1L" if c == "1" else c, s) for m, (c, s) in windows.items()}
    found = running_before(stream, keys, "_us", sums, hot_rows=hot_rows, seconds=seconds)
    return found.filter("_after = 0").select(row_id, *[F.col(f"_r_{m}").alias(m) for m in windows])


def rolling_rank(df: DataFrame, keys: Sequence[str], ts: str, row_id: str, value: str, seconds: int, name: str,
                 hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """``row_id`` with the number of rows of the look-back window whose integer ``value`` is not above the row's own.

    Values are read as hexadecimal digits. The rows below a value are, digit by digit, those that share the digits before it
    and have a smaller one there, which is a running count per (key, shared digits); the rows per task stay bounded
    as for the other running sums, and a row is repeated once per digit of the largest value.
    """
    ends = df.agg(F.min(value).alias("lo"), F.max(value).alias("hi")).first()
    low, digits = ends["lo"] or 0, max(1, -(-((ends["hi"] or 0) - (ends["lo"] or 0)).bit_length() // 4))
    v = F.col(value) - low
    places = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.shiftright(v, 4 * (i + 1)).alias("shared"),
                                          F.shiftright(v, 4 * i).bitwiseAND(F.lit(15)).alias("digit")) for i in range(digits)]))
    cut = df.filter(F.col(value).isNotNull()).select(*keys, row_id, micros(ts).alias("_t"), places.alias("_p")).select(
        *keys, row_id, "_t", F.col("_p.i").alias("_i"), F.col("_p.shared").alias("_shared"), F.col("_p.digit").alias("_digit"))
    stream = with_expiries(cut, "_t", [seconds], [*keys, "_i", "_shared", "_digit"], [row_id])
    sums = {f"_d{j}": look_back(f"CASE WHEN _digit = {j} THEN 1L END", seconds) for j in range(16)}
    found = running_before(stream, [*keys, "_i", "_shared"], "_us", sums, hot_rows=hot_rows).filter("_after = 0")
    not_above = sum((F.when((F.col("_digit") > j) | ((F.col("_digit") == j) & (F.col("_i") == 0)), F.col(f"_d{j}")).otherwise(0)
                     for j in range(16)), F.lit(0))
    return found.groupBy(row_id).agg(F.sum(not_above).alias(name))


def neighbours(df: DataFrame, keys: Sequence[str], us: str, hot_rows: int | None = HOT_ROWS,
               seconds: int = SLICE_SECONDS) -> DataFrame:
    """Add ``_prev`` and ``_next``: times of the neighbouring rows of the key in time order."""
    df, cut = with_slices(df, keys, us, hot_rows, seconds)
    inside = Window.partitionBy(*keys, "_slice").orderBy(us)
    out = df.select("*", F.lag(us).over(inside).alias("_prev"), F.lead(us).over(inside).alias("_next"))
    if cut:
        across = Window.partitionBy(*keys).orderBy("_slice")
        ends = df.groupBy(*keys, "_slice").agg(F.min(us).alias("_lo"), F.max(us).alias("_hi"))
        around = ends.select(*keys, "_slice", F.lag("_hi").over(across).alias("_before"),
                             F.lead("_lo").over(across).alias("_behind"))
        out = (
            out.join(around, [*keys, "_slice"])
            .withColumn("_prev", F.coalesce("_prev", "_before"))
            .withColumn("_next", F.coalesce("_next", "_behind"))
            .drop("_before", "_behind")
        )
    return out.drop("_slice")


def distinct_deltas(df: DataFrame, keys: Sequence[str], value: str, us: str, length: int, hot_rows: int | None = HOT_ROWS,
                    seconds: int = SLICE_SECONDS) -> DataFrame:
    """Changes of the number of distinct ``value`` in a look-back window: (keys, ``_us``, ``_delta``).

    A value counts from its occurrence until ``length`` seconds after the last occurrence of an
    unbroken run, so only the ends of runs matter.
    """
    span = F.lit(length * 1_000_000)
    seen = neighbours(df.select(*keys, value, us).filter(F.col(value).isNotNull()), [*keys, value], us, hot_rows, seconds)
    starts = F.when(F.col("_prev").isNull() | (F.col(us) - F.col("_prev") > span),
                    F.struct(F.col(us).alias("at"), F.lit(1).alias("step")))
    stops = F.when(F.col("_next").isNull() | (F.col("_next") - F.col(us) > span),
                   F.struct((F.col(us) + span).alias("at"), F.lit(-1).alias("step")))
    return (
        seen.select(*keys, F.explode(F.array_compact(F.array(starts, stops))).alias("_e"))
        .select(*keys, F.col("_e.at").alias("_us"), F.col("_e.step").cast("bigint").alias("_delta"))
    )


def rolling_distinct(df: DataFrame, keys: Sequence[str], ts: str, row_id: str, counts: Mapping[str, tuple[str, int]],
                     hot_rows: int | None = HOT_ROWS, seconds: int = SLICE_SECONDS) -> DataFrame:
    """``row_id`` with the number of distinct values per entry of ``counts`` (name: (column, seconds))."""
    base = df.withColumn("_us", micros(ts))
    rows = base.select(*keys, "_us", row_id, *[F.lit(0).cast("bigint").alias(m) for m in counts])
    for name, (value, length) in counts.items():
        deltas = distinct_deltas(base, keys, value, "_us", length, hot_rows, seconds)
        rows = rows.unionByName(deltas.select(*keys, "_us", F.col("_delta").alias(name)), allowMissingColumns=True)
    sums = running_before(rows, keys, "_us", {f"_r_{m}": m for m in counts}, hot_rows=hot_rows, seconds=seconds)
    return sums.filter(F.col(row_id).isNotNull()).select(row_id, *[F.col(f"_r_{m}").alias(m) for m in counts])


def rolling_max(df: DataFrame, keys: Sequence[str], ts: str, row_id: str, value: Column, length: int, out: str,
                seconds: int = SLICE_SECONDS) -> DataFrame:
    """``row_id`` with the largest ``value`` in the look-back window; ``length`` is a multiple of ``seconds``.

    The window is the end of the slice where it opens, whole slices in between, and the start
    of the current slice; each part is a running maximum.
    """
    if length % seconds:
        raise ValueError("the window must be a whole number of slices")
    n = length // seconds
    opens = F.col("_back") == 1
    points = (
        df.select(*keys, row_id, micros(ts).alias("_t"), value.alias("_v"))
        .withColumn("_back", F.explode(F.array(F.lit(0), F.lit(1))))
        .withColumn("_v", F.when(~opens, F.col("_v")))
        .withColumn("_us", F.col("_t") - F.col("_back") * F.lit(length * 1_000_000))
        .withColumn("_slice", _slice(F.col("_us"), seconds))
    )
    part = Window.partitionBy(*keys, "_slice")
    head = F.max("_v").over(part.orderBy("_us").rangeBetween(Window.unboundedPreceding, -1))
    tail = F.max("_v").over(part.orderBy(F.desc("_us")).rangeBetween(Window.unboundedPreceding, 0))
    whole = points.groupBy(*keys, "_slice").agg(F.max("_v").alias("_top"))
    between = Window.partitionBy(*keys).orderBy("_slice").rangeBetween(1 - n, -1)
    middle = whole.select(*keys, "_slice", F.max("_top").over(between).alias("_middle") if n > 1
                          else F.lit(None).cast(whole.schema["_top"].dataType).alias("_middle"))
    found = points.select(*keys, row_id, "_slice", "_back", F.when(opens, tail).otherwise(head).alias("_edge")).join(
        middle, [*keys, "_slice"])
    best = F.when(opens, F.col("_edge")).otherwise(F.greatest("_edge", "_middle"))
    return found.groupBy(row_id).agg(F.max(best).alias(out))


def asof_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_ts: str, right_ts: str,
              columns: Sequence[str], strict: bool = False, tiebreak: str | None = None,
              hot_rows: int | None = HOT_ROWS, seconds: int = SLICE_SECONDS) -> DataFrame:
    """``left`` with ``columns`` of the latest ``right`` row of the key at or before (``strict``: before) its time.

    Several right rows at one instant are ordered by ``tiebreak``.
    """
    order = F.col(tiebreak).cast("bigint") if tiebreak else F.lit(0).cast("bigint")
    right_rank, left_rank = (1, 0) if strict else (0, 1)
    payload = F.struct(*[F.col(c) for c in columns])
    r = right.select(*keys, micros(right_ts).alias("_us"), F.lit(right_rank).alias("_rank"), order.alias("_tie"),
                     payload.alias("_right"))
    l = left.select(*keys, micros(left_ts).alias("_us"), F.lit(left_rank).alias("_rank"),
                    F.lit(None).cast("bigint").alias("_tie"), F.struct("*").alias("_left"))
    both, cut = with_slices(l.unionByName(r, allowMissingColumns=True), keys, "_us", hot_rows, seconds)
    inside = Window.partitionBy(*keys, "_slice").orderBy("_us", "_rank", "_tie").rowsBetween(Window.unboundedPreceding, 0)
    out = both.withColumn("_found", F.last("_right", ignorenulls=True).over(inside))
    if cut:
        # Rows of the left side have no time in the summary: max_by skips them.
        at = F.when(F.col("_right").isNotNull(), F.struct("_us", "_tie"))
        ends = both.groupBy(*keys, "_slice").agg(F.max_by("_right", at).alias("_end"))
        earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
        carried = ends.select(*keys, "_slice", F.last("_end", ignorenulls=True).over(earlier).alias("_carried"))
        out = out.join(carried, [*keys, "_slice"]).withColumn("_found", F.coalesce("_found", "_carried"))
    return out.filter(F.col("_left").isNotNull()).select("_left.*", *[F.col(f"_found.{c}").alias(c) for c in columns])


def previous_row(df: DataFrame, keys: Sequence[str], ts: str, columns: Sequence[str], prefix: str = "previous_",
                 tiebreak: str | None = None, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Add ``columns`` of the key's latest row strictly before this instant."""
    renamed = df.select(*keys, *[F.col(c).alias(prefix + c) for c in columns], F.col(ts).alias("_at"),
                        *([F.col(tiebreak).alias("_by")] if tiebreak else []))
    return asof_join(df, renamed, keys, ts, "_at", [prefix + c for c in columns], strict=True,
                     tiebreak="_by" if tiebreak else None, hot_rows=hot_rows)


def previous_within(df: DataFrame, keys: Sequence[str], ts: str, row_id: str, seconds: int,
                    columns: Sequence[str] = ()) -> DataFrame:
    """Rows whose predecessor (by time, then id) in the group is at most ``seconds`` older; adds ``previous_at`` and
    the predecessor's ``columns`` with the prefix ``previous_``.

    The predecessor is in the same or the previous slice of that length, so the shuffle key is
    (group, slice) and a busy group is spread over time.
    """
    cut = df.withColumn("_slice", _slice(micros(ts), seconds))
    inside = Window.partitionBy(*keys, "_slice").orderBy(ts, row_id)
    seen = F.struct(F.col(ts).alias("at"), *[F.col(c).alias(c) for c in columns])
    last = cut.groupBy(*keys, "_slice").agg(F.max_by(seen, F.struct(ts, row_id)).alias("_last")).withColumn(
        "_slice", F.col("_slice") + 1)
    return (
        cut.withColumn("_lag", F.lag(seen).over(inside))
        .join(last, [*keys, "_slice"], "left")
        .withColumn("_lag", F.coalesce("_lag", "_last"))
        .withColumns({"previous_at": F.col("_lag.at"), **{f"previous_{c}": F.col(f"_lag.{c}") for c in columns}})
        .filter(micros("previous_at") >= micros(ts) - seconds * 1_000_000)
        .drop("_slice", "_lag", "_last")
    )
