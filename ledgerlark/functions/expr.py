"""Column expressions shared by the query packs. All of them stay inside codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(n: str | Column, d: str | Column) -> Column:
    """``n / d`` as double; NULL when ``d`` is zero (ANSI mode would raise)."""
    return col(n).cast("double") / F.nullif(col(d).cast("double"), F.lit(0.0))


def pct(n: str | Column, d: str | Column) -> Column:
    return ratio(n, d) * 100


def growth_pct(now: str | Column, before: str | Column) -> Column:
    """Percent change; NULL when there is no previous value or it is zero."""
    now, before = col(now).cast("double"), col(before).cast("double")
    return (now - before) / F.nullif(before, F.lit(0.0)) * 100


def mean(c: str | Column) -> Column:
    """Exact sum over non-null count, in double (no decimal rounding in between)."""
    c = col(c)
    return F.sum(c).cast("double") / F.nullif(F.count(c).cast("double"), F.lit(0.0))


def sum_if(p: Column, c: str | Column) -> Column:
    c = col(c)
    return F.sum(F.when(p, c).otherwise(F.lit(0).cast("decimal(18,2)")))


def ts(value) -> Column:
    """A timestamp literal from ``'YYYY-MM-DD HH:MM:SS'``; columns pass through."""
    return value if isinstance(value, Column) else F.lit(str(value)).cast("timestamp")


def ago(as_of, n: int, unit: str) -> Column:
    """``as_of`` minus ``n`` units; months and years clamp at the month end."""
    return ts(as_of) - F.expr(f"INTERVAL {int(n)} {unit}")


def date_key(d: str | Column) -> Column:
    d = col(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def month_index(yyyymm: str | Column) -> Column:
    """Months since year 0, so that differences are right across years."""
    c = col(yyyymm)
    return F.floor(c / 100) * 12 + c % 100


def week_from_jan1(d: Column) -> Column:
    """Week number counted from 1 January with weeks starting on Sunday."""
    jan1 = F.trunc(d, "YEAR")
    return (F.floor((F.dayofyear(d) - 1 + F.dayofweek(jan1) - 1) / 7) + 1).cast("int")


def days_between(a: str | Column, b: str | Column) -> Column:
    return F.datediff(F.to_date(col(b)), F.to_date(col(a)))


def hour_boundaries(a: str | Column, b: str | Column) -> Column:
    """Clock-hour boundaries crossed from ``a`` to ``b`` (not full hours elapsed)."""
    def hours(c):
        return F.floor(F.unix_seconds(col(c)) / 3600)

    return hours(b) - hours(a)


def seconds_between(a: str | Column, b: str | Column) -> Column:
    return F.unix_seconds(col(b)) - F.unix_seconds(col(a))


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    dlat, dlon = F.radians(col(lat2) - col(lat1)), F.radians(col(lon2) - col(lon1))
    a = F.sin(dlat / 2) ** 2 + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.sin(dlon / 2) ** 2
    return EARTH_RADIUS_KM * 2 * F.atan2(F.sqrt(a), F.sqrt(1 - a))


def email_domain(c: str | Column) -> Column:
    """Part after the ``@``; empty when there is none."""
    c = col(c)
    return F.when(F.contains(c, F.lit("@")), F.substring_index(c, "@", -1)).otherwise("")


def mask_email(c: str | Column) -> Column:
    return F.concat(F.substring(col(c), 1, 1), F.lit("XXX@XXXX.com"))


def pseudonym(c: str | Column, salt: str) -> Column:
    """Salted one-way id; the same salt in two tables keeps them joinable."""
    return F.sha2(F.concat(col(c).cast("string"), F.lit(salt)), 256)


def uniform(seed: int, row_id: str | Column) -> Column:
    """Number in [0, 1) that depends on the seed and the id only, in any engine that has MD5."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), col(row_id).cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)
