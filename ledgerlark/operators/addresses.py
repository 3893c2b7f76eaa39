"""Places of IPv4 and IPv6 addresses by their longest network prefix."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: An IPv4 address as the last 32 bits of an IPv6 one.
V4_PREFIX = "0" * 20 + "ffff"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, however often it occurs there."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _v4_digits(text: Column) -> Column:
    """Eight hexadecimal digits of a dotted address, null for anything else."""
    def joined(octets: Column) -> Column:
        return F.when((F.size(octets) == 4) & F.forall(octets, lambda o: o <= 255),
                      F.array_join(F.transform(octets, lambda o: F.lpad(F.lower(F.hex(o)), 2, "0")), ""))

    dotted = text.rlike(r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$")
    return F.when(dotted, _let(F.transform(F.split(text, r"\."), lambda x: x.cast("int")), joined))


def _groups(text: Column) -> Column:
    return F.when(F.coalesce(text, F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.split(text, ":", -1))


def _v6_digits(plain: Column) -> Column:
    """Of an address without a dotted end; ``::`` stands for the groups that are missing."""
    def filled(halves: Column) -> Column:
        def whole(sides: Column) -> Column:
            left, right = sides["left"], sides["right"]
            zeros = F.lit(8) - F.size(left) - F.size(right)
            fits = F.when(F.size(halves) == 1, zeros == 0).otherwise((F.size(halves) == 2) & (zeros >= 1))
            return F.when(fits, F.concat(left, F.array_repeat(F.lit("0"), F.greatest(zeros, F.lit(0))), right))

        return _let(F.struct(_groups(F.get(halves, F.lit(0))).alias("left"), _groups(F.get(halves, F.lit(1))).alias("right")), whole)

    def joined(groups: Column) -> Column:
        return F.when(F.forall(groups, lambda g: g.rlike("^[0-9a-f]{1,4}$")), F.array_join(F.transform(groups, lambda g: F.lpad(g, 4, "0")), ""))

    return _let(_let(F.split(plain, "::", -1), filled), joined)


def address_digits(ip: Column) -> Column:
    """An address as 32 hexadecimal digits; null where it is none. IPv4 addresses and their IPv6 forms are the same address."""
    def with_dotted_end(text: Column, tail: Column) -> Column:
        return _let(_v4_digits(tail), lambda v4: F.concat(F.left(text, F.length(text) - F.length(tail)), F.left(v4, F.lit(4)), F.lit(":"),
                                                          F.right(v4, F.lit(4))))

    def digits(text: Column) -> Column:
        plain = _let(F.regexp_extract(text, r"([0-9]+\.[0-9.]+)$", 1), lambda tail: F.when(tail == "", text).otherwise(with_dotted_end(text, tail)))
        return F.when(F.contains(text, F.lit(":")), _let(plain, _v6_digits)).otherwise(F.concat(F.lit(V4_PREFIX), _v4_digits(text)))

    return _let(F.lower(F.btrim(ip)), digits)


def _first_bits(digits: Column, bits: Column) -> Column:
    """The first ``bits`` bits: whole digits, and the last one with its other bits cleared."""
    whole, rest = F.floor(bits / 4).cast("int"), (bits % 4).cast("int")
    digit = F.conv(F.substring(digits, whole + 1, F.lit(1)), 16, 10).cast("int")
    step = F.pow(F.lit(2), 4 - rest).cast("int")
    return F.concat(F.left(digits, whole), F.when(rest > 0, F.lower(F.hex((digit / step).cast("int") * step))).otherwise(""))


def network_keys(networks: DataFrame, network: str = "network") -> DataFrame:
    """Adds ``bits`` and ``prefix`` to networks written as address/length."""
    digits = address_digits(F.substring_index(network, "/", 1))
    length = F.element_at(F.split(network, "/"), -1).try_cast("int")
    bits = F.when(F.contains(network, F.lit(":")), length).otherwise(length + 96)
    return networks.withColumn("bits", bits).withColumn("prefix", _first_bits(digits, F.col("bits"))).filter("prefix IS NOT NULL")


def locate_networks(rows: DataFrame, networks: DataFrame, found: Sequence[str], ip: str = "ip_address", network: str = "network") -> DataFrame:
    """``rows`` with the ``found`` columns of the longest network that holds the address; null without one.

    Addresses are looked up once each, under the first bits for every prefix length that occurs (129 at most), so the search is one
    equality join. Of networks with one prefix the smallest row counts.
    """
    keyed = network_keys(networks, network)
    unique = keyed.groupBy("bits", "prefix").agg(F.min(F.struct(*found)).alias("place"))
    lengths = sorted(r["bits"] for r in keyed.select("bits").distinct().collect())
    address = "_address"
    asked = rows.select(ip).distinct().select(address_digits(F.col(ip)).alias(address)).filter(F.col(address).isNotNull()).distinct()
    cut = asked.withColumn("bits", F.explode(F.array(*[F.lit(n) for n in lengths]).cast("array<int>")))
    hits = cut.withColumn("prefix", _first_bits(F.col(address), F.col("bits"))).join(unique, ["bits", "prefix"])
    best = hits.groupBy(address).agg(F.max_by("place", "bits").alias("place"))
    out = rows.withColumn(address, address_digits(F.col(ip))).join(best, address, "left")
    return out.select(*rows.columns, *[F.col("place")[c].alias(c) for c in found])
