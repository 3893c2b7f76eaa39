"""What several corpus operators share: Arrow passes over texts, vectorised words, hashing, work tables.

Words are found on the UTF-8 bytes of a chunk of texts at once; a word is known by a 64-bit hash of its bytes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Bytes of text that a Python worker holds as numbers at once (one longer text is a chunk of its own).
CHUNK = 2 << 20

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
NOT_SPACE = ~SPACE
#: 0-9, a-z and every byte of a non-ASCII character.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

SAME = np.arange(256, dtype=np.uint8)
LOWER = SAME.copy()
LOWER[0x41:0x5B] += 32
#: Lower case, every digit a 0: the normal form of a line.
LINE_FORM = LOWER.copy()
LINE_FORM[0x30:0x3A] = 0x30

_BASE = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE = mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * _BASE)


def unmix(x: np.ndarray) -> np.ndarray:
    """What ``mix`` made ``x`` of."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(31) ^ x >> np.uint64(62)
    x *= np.uint64(pow(0x94D049BB133111EB, -1, 1 << 64))
    x ^= x >> np.uint64(27) ^ x >> np.uint64(54)
    x *= np.uint64(pow(0xBF58476D1CE4E5B9, -1, 1 << 64))
    x ^= x >> np.uint64(30) ^ x >> np.uint64(60)
    return x


def powers(n: int, base: np.uint64 = _STEP) -> np.ndarray:
    """base ** 0 .. base ** (n - 1), modulo 2 ** 64."""
    out = np.full(max(n, 1), base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class Texts(NamedTuple):
    """UTF-8 bytes of consecutive texts and where each begins (one more offset than texts)."""

    data: np.ndarray
    offsets: np.ndarray

    @property
    def count(self) -> int:
        return len(self.offsets) - 1


class Words(NamedTuple):
    """Words of a chunk: hash, first and last byte + 1, and where each text's words begin."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    offsets: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.offsets)

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.offsets) - 1), self.counts())


def spans_of(texts: Texts, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last byte + 1 of the maximal runs of bytes that are ``inside``, and where each text's runs begin; a text's border ends a run."""
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    borders = texts.offsets[(texts.offsets > 0) & (texts.offsets < len(inside))]
    first[borders] = inside[borders]
    last[borders - 1] = inside[borders - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, texts.offsets)


def words_of(texts: Texts, member: np.ndarray = NOT_SPACE, form: np.ndarray = SAME) -> Words:
    """Maximal runs of ``member`` bytes after ``form`` was applied; a text's border ends a word."""
    b = form[texts.data]
    inside = member[b]
    starts, ends, offsets = spans_of(texts, inside)
    if not len(starts):
        return Words(np.zeros(0, np.uint64), starts, ends, offsets)
    lengths = ends - starts
    begins = np.cumsum(lengths) - lengths
    place = np.arange(lengths.sum()) - np.repeat(begins, lengths)
    values = _BYTE[b[inside]] * powers(int(lengths.max()))[place]
    return Words(mix(np.add.reduceat(values, begins) + lengths.astype(np.uint64) * _BASE), starts, ends, offsets)


#: Words of up to so many bytes are hashed eight bytes at a time.
_SHORT = 64
_FIRST_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def lower_words(texts: Texts) -> Words:
    """Words between white space after A-Z became lower case. Their hashes are not those of ``words_of`` and take a third of the time."""
    b = np.zeros(len(texts.data) + 8, np.uint8)
    b[:len(texts.data)] = texts.data + ((texts.data - np.uint8(0x41) < 26).view(np.uint8) << np.uint8(5))
    starts, ends, offsets = spans_of(texts, (texts.data != 0x20) & (texts.data - np.uint8(0x09) > 4))
    lengths = ends - starts
    eight = np.ndarray(len(texts.data) + 1, np.dtype("<u8"), b, strides=(1,))
    hashes = lengths.astype(np.uint64) * _BASE
    live = np.flatnonzero(lengths <= _SHORT)
    for k in range(0, _SHORT, 8):
        live = live[lengths[live] > k] if k else live
        if not len(live):
            break
        part = eight[starts[live] + k] & _FIRST_BYTES[np.minimum(lengths[live] - k, 8)]
        hashes[live] = mix(hashes[live] * _STEP + part)
    long = np.flatnonzero(lengths > _SHORT)
    if len(long):
        sizes = lengths[long]
        begins = np.cumsum(sizes) - sizes
        place = np.arange(sizes.sum()) - np.repeat(begins, sizes)
        values = _BYTE[b[np.repeat(starts[long], sizes) + place]] * powers(int(sizes.max()))[place]
        hashes[long] = mix(np.add.reduceat(values, begins) + hashes[long])
    return Words(hashes, starts, ends, offsets)


def windows(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``size`` words inside one text, and the index of its first word."""
    n = len(words.hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = np.zeros(n, np.uint64)
    for j in range(size):
        h = h * _STEP + words.hashes[j:j + n]
    end = np.repeat(words.offsets[1:], words.counts())
    at = np.flatnonzero(np.arange(n) + size <= end[:n])
    return mix(h[at]), at


def per_text(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between consecutive offsets; 0 where a text has none."""
    total = np.concatenate([[0], np.cumsum(values)])
    return total[offsets[1:]] - total[offsets[:-1]]


def ragged(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list per text."""
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64, copy=False).view(np.int64)


def _chunks(column: pa.Array, limit: int) -> Iterator[tuple[int, int, Texts]]:
    """Row ranges of about ``limit`` bytes, with their texts; null reads as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null(b"")
    if not len(column):
        return
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    start = 0
    while start < len(column):
        stop = max(start + 1, int(np.searchsorted(ends, ends[start] + limit, side="right")) - 1)
        yield start, stop, Texts(data[ends[start]:ends[stop]], ends[start:stop + 1] - ends[start])
        start = stop


def map_texts(df: DataFrame, carry: list[str], fn: Callable[[Texts], list[pa.Array]], fields: list[T.StructField],
              text: str = "text", limit: int = CHUNK) -> DataFrame:
    """``carry`` columns and what ``fn`` makes of each text, one Arrow array per field; a narrow pass.

    A carried column that is named like a field, in any case, gives way to it.
    """
    made = {f.name.lower() for f in fields}
    carry = [c for c in carry if c.lower() not in made]
    source = df.select(*[df[c] for c in carry], df[text].cast("binary").alias("__text"))
    n = len(carry)
    schema = T.StructType([*source.schema.fields[:n], *fields])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop, texts in _chunks(batch.column(n), limit):
                kept = batch.slice(start, stop - start).columns[:n]
                yield pa.RecordBatch.from_arrays(
                    [a.cast(f.type) for a, f in zip([*kept, *fn(texts)], arrow, strict=True)], schema=arrow)

    return source.mapInArrow(run, schema)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that ``df`` does not have, in any case, for columns that are added for a while."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def bucket(column: str, parts: int):
    """crc32 of the column as text, modulo ``parts``; a null counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % parts
