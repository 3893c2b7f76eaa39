"""Ranking, surrogate keys, top-n and paging without a single-task sort of the data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlark.session import materialise


def ranked(df: DataFrame, value: str, buckets: int = 64) -> DataFrame:
    """Add ``rank`` and ``percent_rank`` of ``value`` (ascending, ties equal, value not null).

    Distinct values are split into ranges at approximate quantiles; each range is counted
    on its own and shifted by the size of the ranges below. The cut points (a list of at
    most ``buckets`` numbers) are the only thing brought to the driver, and the result is
    exact wherever they fall.
    """
    df = materialise(df, "ranked")
    steps = [i / buckets for i in range(1, buckets)]
    cuts = df.agg(F.percentile_approx(F.col(value).cast("double"), steps, 1000)).first()[0] or []
    cut_array = F.lit(sorted(set(cuts))).cast("array<double>")
    below = F.filter(cut_array, lambda c: c < F.col(value).cast("double"))

    values = df.groupBy(value).agg(F.count("*").alias("n")).withColumn("bucket", F.size(below))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        values.groupBy("bucket")
        .agg(F.sum("n").alias("size"))
        .withColumn("offset", F.coalesce(F.sum("size").over(before), F.lit(0)))
        .withColumn("total", F.sum("size").over(Window.partitionBy()))
    )
    inside = Window.partitionBy("bucket").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    ranks = values.join(offsets, "bucket").select(
        value,
        (F.col("offset") + F.coalesce(F.sum("n").over(inside), F.lit(0)) + 1).alias("rank"),
        F.col("total"),
    )
    return (
        df.join(ranks, value)
        .withColumn(
            "percent_rank",
            F.when(F.col("total") > 1, (F.col("rank") - 1).cast("double") / (F.col("total") - 1)).otherwise(F.lit(0.0)),
        )
        .drop("total")
    )


def in_ranges(df: DataFrame, *order: str, ranges: int | None = None) -> DataFrame:
    """``df`` as a written table in the order of ``order``, with ``_part`` (ranges of about equal size, whatever the values) and
    ``_row`` (0, 1, ... inside the range). Spark samples the values for the borders; the cost per row is that of one shuffle and sort."""
    dealt = df.repartitionByRange(ranges, *order) if ranges else df.repartitionByRange(*order)
    numbered = dealt.sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())
    return materialise(numbered, "ranges").withColumns({
        "_part": F.shiftright("_id", 33), "_row": F.col("_id").bitwiseAND((1 << 33) - 1)}).drop("_id")


def dense_keys(df: DataFrame, business_id: str, key: str, start: int | Column = 0, ranges: int | None = None) -> DataFrame:
    """Consecutive surrogate keys ``start+1, start+2, ...`` in order of a unique id.

    Rows are dealt to ranges of the id and numbered where they are; each range is shifted by the sizes of those before it, a list with one
    number per range.
    """
    df = in_ranges(df, business_id, ranges=ranges)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    offsets = df.groupBy("_part").agg(F.count("*").alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    start = start if isinstance(start, Column) else F.lit(start)
    return df.join(F.broadcast(offsets), "_part").withColumn(
        key, (start + F.col("_offset") + F.col("_row") + 1).cast("bigint")).drop("_part", "_row", "_offset")


def top_n(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """``order`` must end in a unique column, so that the cut is the same every time."""
    return df.orderBy(*order).limit(n)


def top_n_per_group(df: DataFrame, keys: list[str], n: int, *order: Column | str) -> DataFrame:
    """Spark keeps ``n`` rows per group on the map side before it shuffles."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("position", F.row_number().over(w)).filter(F.col("position") <= n)


def page_after(df: DataFrame, key: str, last, size: int = 100) -> DataFrame:
    """The next page in key order; ``last`` is the key the previous page ended with."""
    if last is not None:
        df = df.filter(F.col(key) > F.lit(last))
    return df.orderBy(key).limit(size)


def latest_per_key(df: DataFrame, keys: list[str], *order: str) -> DataFrame:
    """Last row per key as an aggregation, combined map-side (no window, no sort)."""
    rest = [c for c in df.columns if c not in keys]
    return (
        df.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_last"))
        .select(*keys, "_last.*")
    )


# -- distinct counts ----------------------------------------------------------------
def distinct_estimates(df: DataFrame, keys: Sequence[str], columns: Mapping[str, str], error: float = 0.01) -> DataFrame:
    """``keys`` and one estimate of distinct values per entry of ``columns`` (name: column), as ``approx_count_distinct`` gives them.

    A sketch of one percent is 13 kilobytes, so a task must not make one for every group of the table. Rows of a group are brought
    together before they are sketched; a partition of a busy group is cut, and its sketches are merged.
    """
    together = df.select(*dict.fromkeys([*keys, *columns.values()])).hint("rebalance", *keys)
    return together.groupBy(*keys).agg(*[F.approx_count_distinct(c, error).alias(name) for name, c in columns.items()])


# -- exact percentiles ---------------------------------------------------------------
#: Size of the sketches; their rank error is about 2.3 / k ** 0.9, well below the margin on either side.
SKETCH_K = 800
MARGIN = 0.01


def value_sketch(value: str) -> Column:
    """A KLL sketch of whole numbers: a few kilobytes, whatever is counted; mergeable, also in the state of a stream."""
    return F.kll_sketch_agg_bigint(value, F.lit(SKETCH_K))


def _bounds(sketched: DataFrame, keys: Sequence[str], sketch: str, points: Mapping[str, float]) -> DataFrame:
    """Per key and point the rank that is asked for and values between which it lies, by the sketch."""
    def at(share: float) -> Column:
        return F.when(n > 0, F.kll_sketch_get_quantile_bigint(sketch, F.lit(min(max(share, 0.0), 1.0))))

    n = F.kll_sketch_get_n_bigint(sketch)
    asked = F.array(*[F.struct(F.lit(name).alias("_point"), F.lit(p).alias("_p"), at(p - MARGIN).alias("_low"), at(p + MARGIN).alias("_high"))
                      for name, p in points.items()])
    return sketched.select(*keys, n.alias("_n"), F.inline(asked)).withColumn("_rank", F.col("_p") * (F.col("_n") - 1))


def _inside(rows: DataFrame, bounds: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Exact values at the ranks of ``bounds``, null where the bounds miss them. Of a key's rows only those between the bounds are
    told apart by value; all others are one count per task."""
    renamed = bounds.withColumnsRenamed({k: f"_k_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    v = F.col(value)
    near = F.when(v < F.col("_low"), F.lit(None)).when(v <= F.col("_high"), v)
    counted = rows.filter(v.isNotNull()).select(*keys, value).join(renamed, same).filter(v <= F.col("_high")).groupBy(
        *keys, "_point", "_rank", near.alias("_v")).agg(F.count("*").alias("_c"))
    by_value = Window.partitionBy(*keys, "_point").orderBy(F.col("_v").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    ranked_values = counted.withColumn("_from", F.coalesce(F.sum("_c").over(by_value), F.lit(0)))

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("_from") <= rank) & (rank < F.col("_from") + F.col("_c")), F.col("_v")))

    low, high = F.floor("_rank"), F.ceil("_rank")
    found = ranked_values.groupBy(*keys, "_point", "_rank").agg(at(low).alias("_a"), at(high).alias("_b"))
    # As ``percentile`` adds them up, to the last bit.
    between = (high - F.col("_rank")) * F.col("_a") + (F.col("_rank") - low) * F.col("_b")
    return found.select(*keys, "_point", F.when(F.col("_a") == F.col("_b"), F.col("_a").cast("double")).otherwise(between).alias("_x"))


def percentiles_within(rows: DataFrame, sketched: DataFrame, keys: Sequence[str], value: str, sketch: str,
                       points: Mapping[str, float]) -> DataFrame:
    """``keys`` and one interpolated percentile per point, exact, from ``rows`` and the sketches of their groups.

    A sketch bounds the value; the rows between its bounds are counted. Where a sketch was off by more than the margin, which the counts
    show, the group is counted over all of its values.
    """
    bounds = materialise(_bounds(sketched, keys, sketch, points), "bounds")
    first = materialise(_inside(rows, bounds, keys, value), "percentiles")
    fine = first.filter(F.col("_x").isNotNull())
    missed = bounds.join(fine.select(*[F.col(k).alias(f"_m_{k}") for k in keys], F.col("_point").alias("_m")),
                         [F.col(k).eqNullSafe(F.col(f"_m_{k}")) for k in keys] + [F.col("_point") == F.col("_m")], "left_anti")
    wide = missed.filter(F.col("_n") > 0).withColumns({"_low": F.lit(-(1 << 63)), "_high": F.lit((1 << 63) - 1)})
    both = fine if wide.isEmpty() else fine.unionByName(_inside(rows, wide, keys, value))
    named = F.map_from_entries(F.collect_list(F.struct("_point", "_x")))
    return both.groupBy(*keys).agg(named.alias("_all")).select(*keys, *[F.try_element_at("_all", F.lit(p)).alias(p) for p in points])


def exact_percentiles(rows: DataFrame, keys: Sequence[str], value: str, points: Mapping[str, float]) -> DataFrame:
    """``keys``, ``n`` and exact percentiles of a column of whole numbers, in two passes and without holding a group's values."""
    sketched = materialise(rows.groupBy(*keys).agg(F.count(value).alias("n"), value_sketch(value).alias("_sketch")), "sketches")
    found = percentiles_within(rows, sketched, keys, value, "_sketch", points).withColumnsRenamed({k: f"_j_{k}" for k in keys})
    return sketched.join(found, [F.col(k).eqNullSafe(F.col(f"_j_{k}")) for k in keys], "left").select(*keys, "n", *points)
