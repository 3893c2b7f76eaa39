"""Exact duplicates by composable polynomial fingerprints, confirmed by comparing the texts.

A text's bytes, A-Z lower-cased, are cut into blocks. All blocks of a batch are hashed at once: a block is a polynomial in four bases
modulo 2 ** 31 - 1, which a product of the bytes with a table of powers gives exactly. Blocks compose: the fingerprint of a text is the
sum of its block hashes, each shifted by its base to the power of the bytes that follow. So neither the size of a text nor where it was
cut matters, and a document that is stored in several rows is hashed where its parts are (``fingerprint_parts``).

Texts with equal fingerprint and length are then compared: the chunks of such texts stream through an aggregation that keeps the smallest
and the largest chunk of each place, so copies fold together before the shuffle and a group of any size costs one row per task and
chunk. Smallest and largest differ only where two different texts share a fingerprint; then the bases are replaced and the search is
done again. So groups are exact whatever the hash does.

Null counts as the empty text, and empty texts are copies of each other. Rows that repeat are copies; of rows with the largest id of their
group one stays. A null id is smaller than any other. Very long texts are hashed block by block. An empty table gives an empty result.
Columns named like an added one are replaced.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ledgerlark.llm.common import LOWER, Texts, fresh, map_texts
from ledgerlark.session import materialise

PRIME = np.uint64((1 << 31) - 1)
#: 255 * 2 ** 31 * BLOCK is below 2 ** 53, so products summed as doubles are exact.
BLOCK = 1024
LANES = 4
#: Blocks whose bytes are held as doubles at once.
STRIP = 1024
#: Bytes that one row of the comparison holds.
PIECE = 1 << 16
#: Bits of the filter of fingerprints that occur more than once (1 MB). A fuller filter only lets more texts be compared.
FILTER_BITS = 23
#: Groups with a larger share of the rows are at most so many, and join by broadcast.
HOT_GROUPS = 1000

FINGERPRINT = ["fp_high", "fp_low", "n_bytes"]


def bases(attempt: int = 0) -> np.ndarray:
    """Four bases; others for each attempt."""
    return np.random.default_rng(attempt + 1).integers(1 << 20, int(PRIME) - 1, LANES, dtype=np.uint64)


def power(base: np.ndarray, exponent: np.ndarray) -> np.ndarray:
    """base ** exponent modulo PRIME, one row per exponent and one column per base."""
    out = np.ones((len(exponent), len(base)), np.uint64)
    square, left = base.copy(), exponent.astype(np.uint64)
    while left.any():
        odd = (left & np.uint64(1)).astype(bool)
        out[odd] = out[odd] * square % PRIME
        square = square * square % PRIME
        left = left >> np.uint64(1)
    return out


def shifted_sum(hashes: np.ndarray, after: np.ndarray, owner: np.ndarray, n: int, base: np.ndarray) -> np.ndarray:
    """Per owner the composed hash of its pieces, each followed by ``after`` bytes of the same owner."""
    out = np.zeros((n, len(base)), np.uint64)
    np.add.at(out, owner, hashes * power(base, after) % PRIME)
    return out % PRIME


def polynomials(texts: Texts, base: np.ndarray) -> np.ndarray:
    """The hashes of whole texts, a row each."""
    sizes = np.diff(texts.offsets)
    blocks = -(-sizes // BLOCK)
    owner = np.repeat(np.arange(texts.count), blocks)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    start = texts.offsets[:-1][owner] + number * BLOCK
    end = np.minimum(start + BLOCK, texts.offsets[1:][owner])
    table = np.stack([power(np.array([b]), np.arange(BLOCK)[::-1])[:, 0] for b in base], axis=1).astype(np.float64)
    padded = np.concatenate([np.zeros(BLOCK, np.uint8), texts.data])
    ending_at = np.lib.stride_tricks.sliding_window_view(padded, BLOCK)
    hashes = np.zeros((len(owner), len(base)), np.uint64)
    for a in range(0, len(owner), STRIP):
        strip = LOWER[ending_at[end[a:a + STRIP]]]
        strip[np.arange(BLOCK) < BLOCK - (end - start)[a:a + STRIP, None]] = 0
        hashes[a:a + STRIP] = (strip.astype(np.float64) @ table).astype(np.uint64) % PRIME
    return shifted_sum(hashes, texts.offsets[1:][owner] - end, owner, texts.count, base)


def packed(lanes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Four lanes of 31 bits as two numbers."""
    x = lanes.astype(np.int64)
    return x[:, 0] << 31 | x[:, 1], x[:, 2] << 31 | x[:, 3]


def _fields(names: list[str], kinds: list[T.DataType]) -> list[T.StructField]:
    return [T.StructField(n, k) for n, k in zip(names, kinds, strict=True)]


def fingerprints(docs: DataFrame, carry: list[str], base: np.ndarray, text: str = "text", names: list[str] | None = None) -> DataFrame:
    """``carry``, two numbers of 62 bits, the length in bytes and the SHA-256 of each whole text. One narrow pass."""
    def fn(texts: Texts) -> list[pa.Array]:
        high, low = packed(polynomials(texts, base))
        data, ends = memoryview(LOWER[texts.data]), texts.offsets
        digests = [hashlib.sha256(data[a:b]).hexdigest() for a, b in zip(ends[:-1], ends[1:], strict=True)]
        return [pa.array(high), pa.array(low), pa.array(np.diff(ends)), pa.array(digests)]

    names = names or [*FINGERPRINT, "text_sha256"]
    return map_texts(docs, carry, fn, _fields(names, [T.LongType()] * 3 + [T.StringType()]), text)


def fingerprint_parts(parts: DataFrame, key: str, order: str, base: np.ndarray | None = None, text: str = "text") -> DataFrame:
    """``key`` and the fingerprint of documents that are stored in parts, one row each; equal to that of the whole text.

    Parts are hashed where they are; only their hashes meet. ``order`` numbers the parts of a document and has no ties.
    """
    base = bases() if base is None else base
    hashed = fingerprints(parts, [key, order], base, text)
    lists = hashed.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(
        order, "n_bytes", "fp_high", "fp_low"))).alias("parts"))
    fields = [lists.schema[key], *_fields(FINGERPRINT, [T.LongType()] * 3)]

    def run(batches):
        for batch in batches:
            column = batch.column(1)
            flat, ends = column.flatten(), np.asarray(column.offsets) - column.offsets[0].as_py()
            sizes, high, low = (np.asarray(flat.field(i)) for i in (1, 2, 3))
            total = np.concatenate([[0], np.cumsum(sizes)])
            owner = np.repeat(np.arange(len(column)), np.diff(ends))
            after = total[ends[1:]][owner] - total[1:]
            mask = (1 << 31) - 1
            lanes = np.stack([high >> 31, high & mask, low >> 31, low & mask], axis=1).astype(np.uint64)
            h, l = packed(shifted_sum(lanes, after, owner, len(column), base))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(h), pa.array(l), pa.array(total[ends[1:]] - total[ends[:-1]])],
                                             names=[f.name for f in fields])

    return lists.mapInArrow(run, T.StructType(fields))


def _filter(groups: DataFrame) -> np.ndarray:
    """A bit per value of the low bits of ``fp_high``, set where a group has it; 2 ** FILTER_BITS bits at any size."""
    place = F.col("fp_high").bitwiseAND((1 << FILTER_BITS) - 1) + 1
    rows = groups.groupBy(F.bitmap_bucket_number(place).alias("b")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")).collect()
    size = 1 << 12
    out = np.zeros(max(1, (1 << FILTER_BITS) // 8 // size) * size, np.uint8)
    for r in rows:
        out[(r["b"] - 1) * size:r["b"] * size] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return out


def differing(docs: DataFrame, groups: DataFrame, base: np.ndarray, text: str = "text") -> DataFrame:
    """Fingerprints of ``groups`` under which not all texts are equal, byte for byte."""
    bits = docs.sparkSession.sparkContext.broadcast(_filter(groups))
    schema = T.StructType([*_fields([*FINGERPRINT, "place"], [T.LongType()] * 4), T.StructField("piece", T.BinaryType())])

    def fn(texts: Texts) -> list[pa.Array]:
        high, low = packed(polynomials(texts, base))
        at = high & ((1 << FILTER_BITS) - 1)
        found = np.flatnonzero(bits.value[at >> 3] >> (at & 7) & 1)
        data, sizes = LOWER[texts.data], np.diff(texts.offsets)
        pieces = [[] for _ in range(texts.count)]
        for i in found:
            a, n = texts.offsets[i], int(sizes[i])
            pieces[i] = [{"fp_high": int(high[i]), "fp_low": int(low[i]), "n_bytes": n, "place": k,
                          "piece": data[a + p:a + min(p + PIECE, n)].tobytes()} for k, p in enumerate(range(0, max(n, 1), PIECE))]
        return [pa.array(pieces, pa.list_(kind))]

    kind = to_arrow_type(schema)
    listed = map_texts(docs, [], fn, [T.StructField("pieces", T.ArrayType(schema))], text)
    pieces = listed.select(F.explode("pieces").alias("p")).select("p.*")
    compared = pieces.groupBy(*FINGERPRINT, "place").agg(F.min("piece").alias("least"), F.max("piece").alias("most"))
    return compared.filter(F.col("least") != F.col("most")).select(*FINGERPRINT).distinct()


def mark_copies(docs: DataFrame, carry: list[str], key: str = "doc_id", text: str = "text", attempt: int = 0,
                choose=bases) -> DataFrame:
    """A row per row of ``docs``: ``carry``, ``keep_id`` (the ``key`` of the row that stays), ``group_size``, ``kept``, ``text_sha256``."""
    added = ["keep_id", "group_size", "kept", "text_sha256"]
    carry = [c for c in carry if c.lower() not in added]
    id_, row, *names = fresh(docs, "the_id", "the_row", *FINGERPRINT, "the_text_sha256")
    while True:
        base = choose(attempt)
        marks = fingerprints(docs.withColumns({id_: F.col(key)}), [*carry, id_], base, text, names)
        marks = materialise(marks.withColumn(row, F.monotonically_increasing_id()), "fingerprints")
        prints = marks.select(*[F.col(n).alias(f) for n, f in zip(names, FINGERPRINT, strict=False)], F.struct(
            F.col(id_).alias("id"), F.col(row).alias("row")).alias("who"))
        groups = prints.groupBy(*FINGERPRINT).agg(F.count("*").alias("size"), F.max("who").alias("keeper"))
        groups = materialise(groups.filter(F.col("size") > 1), "copies")
        if differing(docs, groups, base, text).isEmpty():
            break
        attempt += 1
    hot = F.col("size") * HOT_GROUPS > marks.count()
    size, keeper = fresh(marks, "group_rows", "keeper")
    shared = {**dict(zip(FINGERPRINT, names, strict=False)), "size": size, "keeper": keeper}
    large, small = (groups.filter(which).withColumnsRenamed(shared) for which in (hot, ~hot))
    first = marks.join(F.broadcast(large), names[:3], "left")
    busy = first.filter(F.col(size).isNotNull())
    rest = first.filter(F.col(size).isNull()).drop(size, keeper).join(small, names[:3], "left")
    stays = F.coalesce(keeper, F.struct(F.col(id_).alias("id"), F.col(row).alias("row")))
    return busy.unionByName(rest).select(
        *carry, stays["id"].alias("keep_id"), F.coalesce(size, F.lit(1)).alias("group_size"),
        (stays["row"] == F.col(row)).alias("kept"), F.col(names[3]).alias("text_sha256"))


def drop_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the rows whose text another row keeps; writes its columns once to the work folder."""
    shadow = fresh(docs, *(f"_{c}" for c in docs.columns))
    held = docs.select("*", *[F.col(c).alias(s) for c, s in zip(docs.columns, shadow, strict=True)])
    marked = mark_copies(held, shadow, key, text)
    return marked.filter("kept").select(*[F.col(s).alias(c) for c, s in zip(docs.columns, shadow, strict=True)])
