"""Format-preserving pseudonyms for personal numbers, dates and mail names in texts.

A candidate is found by shape and then validated (Luhn digit, octet range, calendar date, digit counts). A valid one is
written as digits of mixed radix and goes through a keyed Feistel network over those digits, so the result has the same
format, is valid in the same way, differs for different values, and is the same for equal values wherever they occur. With
the key the permutation can be undone (``restore``). No table of values exists, so nothing is shuffled.

| kind | permuted | stays |
|---|---|---|
| email | letters and digits of the local part, each within its class (script and case) | punctuation, domain |
| ip | the four octets | |
| date | day number within the 400 years from 1800-01-01 | order and separators; with slashes MM/dd, or dd/MM after the 12th |
| ssn | area, group and serial, each within its valid range | |
| phone | all digits after the country code | country code, punctuation |
| card | all digits but the check digit, which is computed anew | length, separators |

A slash date whose first number is over 12 is read day first and permuted among such dates, so it never turns into a date that reads
month first. A mail name without any letter or digit of a class (such as one of punctuation) has nothing to permute: it stays and is
not counted.

The key is a column, so that it can come from a table or a scalar subquery instead of standing in the plan as a literal.
"""

from __future__ import annotations

import json
import unicodedata
from collections import defaultdict
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.common import fresh

ROUNDS = 8

#: The shapes of the kinds, in the order in which they are tried at one place.
SHAPES = {
    "email": r"(?<![\p{L}0-9._%+-])[\p{L}0-9._%+-]{1,64}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9-])",
    "ip": r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])(?![0-9]|\.[0-9])",
    "date": r"(?<![0-9.-])(?:(?:18|19|20|21)[0-9]{2}([-/])[0-9]{2}\1[0-9]{2}|[0-9]{2}\.[0-9]{2}\.(?:18|19|20|21)[0-9]{2}|[0-9]{2}/[0-9]{2}/(?:18|19|20|21)[0-9]{2})(?![0-9-])",
    "ssn": r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])",
    "phone": r"(?<![0-9+])(?:\+[0-9]{1,3}[ .-]?(?:\([0-9]{2,4}\)|[0-9]{2,4})(?:[ .-]?[0-9]{2,4}){2,3}|\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}|[0-9]{3}-[0-9]{3}-[0-9]{4})(?![0-9])",
    "card": r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9])",
}
KINDS = tuple(SHAPES)
#: Formats of the dates by length and separator.
DATE_FORMATS = {r"^[0-9]{4}-": "yyyy-MM-dd", r"^[0-9]{4}/": "yyyy/MM/dd", r"^[0-9]{2}\.": "dd.MM.yyyy", r"^[0-9]{2}/": "MM/dd/yyyy"}
#: Character classes that a character stays in, as first code point and size.
CLASSES = ((48, 10), (65, 26), (97, 26), (0xC0, 23), (0xD8, 7), (0xE0, 23), (0xF8, 8))
#: 400 Gregorian years have 146,097 = 627 * 233 days.
DATE_RADIX = (627, 233)
#: Dates whose slash form can only be read day first, and the 88,497 = 9 * 9,833 days after the 12th of a month in 400 years.
DAY_FIRST = "^(?:1[3-9]|2[0-9]|3[01])/"
LATE_RADIX = (9, 9833)
FIRST_DAY = "1800-01-01"


def _all_shapes() -> str:
    # The date's back reference is its own group; joined, it is the first group as no other shape captures.
    return "|".join(f"(?:{s})" for s in SHAPES.values())


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    return F.call_function("luhn_check", digits)


def _date(m: Column) -> Column:
    out = F.lit(None).cast("date")
    for shape, form in DATE_FORMATS.items():
        out = F.when(m.rlike(shape), F.try_to_date(m, form)).otherwise(out)
    return F.when(m.rlike(DAY_FIRST), F.try_to_date(m, "dd/MM/yyyy")).otherwise(out)


def _late_rank(date: Column) -> Column:
    """Number of a day among the days after the 12th of a month."""
    months = (F.year(date) - 1800) * 12 + F.month(date)
    return F.date_diff(date, F.lit(FIRST_DAY).cast("date")) - 12 * months


def _late_day(rank: Column) -> Column:
    """The day of that number. Months have 18.4 such days on average, and no month is two months off the average."""
    first = F.lit(FIRST_DAY).cast("date")
    near = F.floor(rank * 4800 / (LATE_RADIX[0] * LATE_RADIX[1])).cast("int")

    def before(m: Column) -> Column:
        return F.date_diff(F.add_months(first, m), first) - 12 * m

    month = F.array_max(F.filter(F.sequence(F.greatest(near - 2, F.lit(0)), near + 2), lambda m: before(m) <= rank))
    return _let(month, lambda m: F.date_add(F.add_months(first, m), (rank - before(m) + 12).cast("int")))


def kind_of(m: Column) -> Column:
    """The kind of a candidate, or null when it does not hold."""
    valid = {
        "email": _permutable(F.regexp_extract(m, "^[^@]*", 0)), "ip": F.lit(True), "date": _date(m).isNotNull(), "ssn": F.lit(True),
        "phone": F.length(_digits(m)).between(8, 15), "card": _luhn(_digits(m)),
    }
    out = F.lit(None).cast("string")
    for kind in reversed(KINDS):
        out = F.when(m.rlike(f"^(?:{SHAPES[kind]})$"), F.when(valid[kind], F.lit(kind))).otherwise(out)
    return out


def _split_kept(kind: Column, m: Column) -> tuple[Column, Column, Column]:
    """What stays in front, what is permuted, what stays behind."""
    front = F.when(kind == "phone", F.regexp_extract(m, r"^\+[0-9]{1,3}(?=[ .(-])", 0)).otherwise("")
    back = F.when(kind == "email", F.regexp_extract(m, "@.*$", 0)).when(kind == "card", F.substring(m, -1, 1)).otherwise("")
    middle = F.substr(m, F.length(front) + 1, F.length(m) - F.length(front) - F.length(back))
    return front, middle, back


@cache
def letter_ranges() -> list[tuple[int, int, int, int, int]]:
    """Letters outside ``CLASSES`` as (class, class size, first code point, last one, number of the first in its class). A class is the
    letters of one script (the first word of their names) and case; scripts with a single one share a class. Letters are those of
    Unicode 3.2, which every regular expression engine in use takes as letters."""
    classes = defaultdict(list)
    for code in range(0x80, 0x30000):
        char = chr(code)
        if unicodedata.ucd_3_2_0.category(char)[0] == "L" == unicodedata.category(char)[0] and not any(
                a <= code < a + n for a, n in CLASSES):
            classes[unicodedata.name(char).split()[0].split("-")[0], unicodedata.category(char)].append(code)
    alone = sorted(c for codes in classes.values() if len(codes) == 1 for c in codes)
    out = []
    for i, codes in enumerate([*(c for c in classes.values() if len(c) > 1), alone]):
        begin = 0
        for k in range(1, len(codes) + 1):
            if k == len(codes) or codes[k] != codes[k - 1] + 1:
                out.append((i, len(codes), codes[begin], codes[k - 1], begin))
                begin = k
    return out


def _ranges() -> Column:
    rows = [dict(zip(("c", "size", "lo", "hi", "at"), r, strict=True)) for r in letter_ranges()]
    return F.from_json(F.lit(json.dumps(rows)), "array<struct<c:int,size:int,lo:int,hi:int,at:int>>")


def _range_of(code: Column) -> Column:
    return F.get(F.filter(_ranges(), lambda r: (r["lo"] <= code) & (code <= r["hi"])), F.lit(0))


def _in_class(code: Column) -> Column:
    """The class of a code point: (first code point or null, number of the class or null, size, number of the code point in it)."""
    def made(first, c, size, at):
        return F.struct(F.lit(first).cast("int").alias("first"), c.cast("int").alias("c"), size.cast("int").alias("size"),
                        at.cast("int").alias("at"))

    none = F.lit(None)
    out = F.when(code < 0x80, made(None, none, F.lit(1), F.lit(0))).otherwise(
        _let(_range_of(code), lambda r: made(None, r["c"], F.coalesce(r["size"], F.lit(1)), F.coalesce(code - r["lo"] + r["at"], F.lit(0)))))
    for first, size in CLASSES:
        out = F.when(code.between(first, first + size - 1), made(first, none, F.lit(size), code - first)).otherwise(out)
    return out


def _written(code: Column, v: Column) -> Column:
    """The character number ``v`` of the class of ``code``."""
    def character(c: Column) -> Column:
        return F.when(c < 0x80, F.char(c)).otherwise(F.decode(F.unhex(F.lpad(F.hex(c), 8, "0")), "UTF-32"))

    def other(k: Column) -> Column:
        return _let(F.get(F.filter(_ranges(), lambda r: (r["c"] == k["c"]) & v.between(r["at"], r["at"] + r["hi"] - r["lo"])), F.lit(0)),
                    lambda r: F.when(r["lo"].isNull(), code).otherwise(r["lo"] + v - r["at"]))

    return _let(_in_class(code), lambda k: _let(
        F.when(k["first"].isNotNull(), k["first"] + v).when(k["c"].isNotNull(), other(k)).otherwise(code), character))


def _codes(text: Column) -> Column:
    return F.transform(F.filter(F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1))), lambda i: i <= F.length(text)),
                       lambda i: F.ascii(F.substr(text, i, F.lit(1))))


def _permutable(text: Column) -> Column:
    return text.rlike("[A-Za-z0-9]") | F.exists(_codes(text), lambda c: _in_class(c)["size"] > 1)


def _numbers(m: Column, pattern: str, less: int = 0) -> Column:
    return F.transform(F.split(m, pattern), lambda x: x.cast("int") - less)


def _encode(kind: Column, m: Column, middle: Column) -> tuple[Column, Column]:
    """Digits of mixed radix and their radices."""
    day = F.date_diff(_date(m), F.lit(FIRST_DAY).cast("date"))
    late, rank = (kind == "date") & m.rlike(DAY_FIRST), _late_rank(_date(m))
    digits = (F.when(kind == "ip", _numbers(m, r"\."))
              .when(late, F.array((rank / LATE_RADIX[1]).cast("int"), rank % LATE_RADIX[1]))
              .when(kind == "date", F.array((day / DATE_RADIX[1]).cast("int"), day % DATE_RADIX[1]))
              .when(kind == "ssn", F.array(
                  F.substring(m, 1, 3).cast("int") - F.when(F.substring(m, 1, 3) > "666", 2).otherwise(1),
                  F.substring(m, 5, 2).cast("int") - 1, F.substring(m, 8, 4).cast("int") - 1))
              .otherwise(F.transform(_codes(middle), lambda c: _in_class(c)["at"])))
    radices = (F.when(kind == "ip", F.array_repeat(F.lit(256), 4))
               .when(late, F.array(*map(F.lit, LATE_RADIX)))
               .when(kind == "date", F.array(*map(F.lit, DATE_RADIX)))
               .when(kind == "ssn", F.array(F.lit(898), F.lit(99), F.lit(9999)))
               .otherwise(F.transform(_codes(middle), lambda c: _in_class(c)["size"])))
    return digits, radices


def _check_digit(payload: Column) -> Column:
    ten = F.sequence(F.lit(0), F.lit(9))
    return F.get(F.filter(ten, lambda d: _luhn(F.concat(_digits(payload), d.cast("string")))), F.lit(0)).cast("string")


def _decode(kind: Column, m: Column, out: Column, middle: Column, back: Column, front: Column) -> Column:
    text = F.array_join(F.transform(F.arrays_zip(_codes(middle).alias("c"), out.alias("v")),
                                    lambda x: _written(x["c"], x["v"])), "")
    area = F.get(out, F.lit(0)) + 1
    area = F.when(area >= 666, area + 1).otherwise(area)
    day = F.date_add(F.lit(FIRST_DAY).cast("date"), F.get(out, F.lit(0)) * DATE_RADIX[1] + F.get(out, F.lit(1)))
    date = F.lit("")
    for shape, form in DATE_FORMATS.items():
        date = F.when(m.rlike(shape), F.date_format(day, form)).otherwise(date)
    late = F.get(out, F.lit(0)) * LATE_RADIX[1] + F.get(out, F.lit(1))
    date = F.when(m.rlike(DAY_FIRST), F.date_format(_late_day(late), "dd/MM/yyyy")).otherwise(date)
    return (F.when(kind == "ip", F.array_join(F.transform(out, lambda x: x.cast("string")), "."))
            .when(kind == "date", date)
            .when(kind == "ssn", F.concat_ws("-", F.lpad(area.cast("string"), 3, "0"),
                                             F.lpad((F.get(out, F.lit(1)) + 1).cast("string"), 2, "0"),
                                             F.lpad((F.get(out, F.lit(2)) + 1).cast("string"), 4, "0")))
            .when(kind == "card", _let(text, lambda payload: F.concat(payload, _check_digit(payload))))
            .otherwise(F.concat(front, text, back)))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def feistel(digits: Column, radices: Column, tweak: Column, key: Column, undo: bool = False) -> Column:
    """The permuted digits: in turn one half gets a keyed hash of the other half added, digit by digit."""
    half = F.floor(F.size(digits) / 2).cast("int")

    def halves(x: Column, name: str) -> tuple[Column, Column]:
        return F.slice(x, F.lit(1), half).alias(name + "1"), F.slice(x, half + 1, F.size(digits) - half).alias(name + "2")

    def shifted(own: Column, size: Column, other: Column, turn: Column) -> Column:
        digest = F.sha2(F.concat_ws("|", key, tweak, turn.cast("string"), F.array_join(
            F.transform(other, lambda x: x.cast("string")), ",")), 512)
        sign = -1 if undo else 1

        def add(h: Column) -> Column:
            return F.transform(own, lambda v, i: F.pmod(v + sign * F.conv(F.substr(h, i * 4 + 1, F.lit(4)), 16, 10).cast("int"),
                                                        F.get(size, i)))

        return _let(digest, add)

    def turn(s: Column, r: Column) -> Column:
        a, b, p, q = s["a1"], s["a2"], s["r1"], s["r2"]
        first = F.struct(shifted(a, p, b, r).alias("a1"), b.alias("a2"), p.alias("r1"), q.alias("r2"))
        second = F.struct(a.alias("a1"), shifted(b, q, a, r).alias("a2"), p.alias("r1"), q.alias("r2"))
        return F.when(r % 2 == 0, first).otherwise(second)

    order = F.sequence(F.lit(ROUNDS - 1), F.lit(0)) if undo else F.sequence(F.lit(0), F.lit(ROUNDS - 1))
    start = F.struct(*halves(digits, "a"), *halves(radices, "r"))
    return F.aggregate(order, start, turn, lambda s: F.concat(s["a1"], s["a2"]))


def pseudonyms_of(found: Column, key: Column, undo: bool = False) -> Column:
    """What stands in place of each of an array of (m, kind): a pseudonym of the same kind and format, or m itself when
    the kind is null; ``undo`` gives the values back. Each step binds what the next one uses more than once."""

    def split(x: Column) -> Column:
        front, middle, back = _split_kept(x["kind"], x["m"])
        return F.struct(x["m"].alias("m"), x["kind"].alias("kind"), front.alias("f"), middle.alias("t"), back.alias("b"))

    def encode(x: Column) -> Column:
        digits, radices = _encode(x["kind"], x["m"], x["t"])
        return F.struct(x.alias("x"), digits.alias("d"), radices.alias("r"))

    def permute(y: Column) -> Column:
        tweak = F.concat_ws("/", y["x"]["kind"], y["x"]["f"], F.array_join(
            F.transform(y["r"], lambda v: v.cast("string")), ","))
        return F.struct(y["x"].alias("x"), feistel(y["d"], y["r"], tweak, key, undo).alias("o"))

    def decode(z: Column) -> Column:
        x = z["x"]
        return _decode(x["kind"], x["m"], z["o"], x["t"], x["b"], x["f"])

    def one(x: Column) -> Column:
        return F.when(x["kind"].isNull(), x["m"]).otherwise(_let(split(x), lambda y: _let(
            encode(y), lambda z: _let(permute(z), decode))))

    return F.transform(found, one)


def pseudonymise_texts(docs: DataFrame, key: Column | str, text: str = "text", undo: bool = False) -> DataFrame:
    """``docs`` with ``text`` pseudonymised and ``n_<kind>`` valid values per kind.

    A null text stays null and an empty one empty, both with zeros; repeated rows are treated alike; columns of ``docs`` named
    like the added ones are replaced; an empty table gives an empty result. A candidate that fails its check is left as it is.
    """
    key = F.lit(key) if isinstance(key, str) else key
    docs = docs.drop(*[f"n_{k}" for k in KINDS])
    found, gaps, new = fresh(docs, "found", "gaps", "new")
    shapes = F.lit(_all_shapes())
    likely = F.col(text).rlike("[0-9@]")
    rows = docs.withColumn(found, F.when(likely, F.regexp_extract_all(F.col(text), shapes, F.lit(0))))
    rows = rows.withColumn(found, F.when(F.size(found) > 0, F.transform(
        F.col(found), lambda m: F.struct(m.alias("m"), kind_of(m).alias("kind")))))
    rows = rows.withColumn(gaps, F.when(F.col(found).isNotNull(), F.split(F.col(text), _all_shapes(), -1)))
    rows = rows.withColumn(new, pseudonyms_of(F.col(found), key, undo))
    joined = F.concat(F.get(F.col(gaps), F.lit(0)), F.array_join(F.transform(
        F.col(new), lambda m, i: F.concat(m, F.get(F.col(gaps), i + 1))), ""))

    def count(kind: str) -> Column:
        hits = F.size(F.filter(F.col(found), lambda x: x["kind"] == kind))
        return F.when(F.col(found).isNull(), 0).otherwise(hits)

    counts = {f"n_{k}": count(k) for k in KINDS}
    return rows.withColumns(counts).withColumn(text, F.when(F.col(found).isNull(), F.col(text)).otherwise(joined)).drop(
        found, gaps, new)


def restore(docs: DataFrame, key: Column | str, text: str = "text") -> DataFrame:
    """Texts with the values back in place of their pseudonyms."""
    return pseudonymise_texts(docs, key, text, undo=True)
