"""Search for benchmark passages in documents by a prefix-filtered set join.

An item is cut into windows of 13 consecutive words (a shorter item is one window). A window's tokens are its shingles of up
to three words, ordered by rarity in the whole corpus. Containment must be complete, so the necessary prefix of a window is
its rarest shingle alone: only places where a document has that shingle are joined. The shingle's place in the window says
where the window would begin; starts before the text's first word or ends after its last are dropped, and what remains is
compared word by word.

The benchmark is the stated query set. It goes to the executors in blocks of at most ``BLOCK_BYTES`` of item text, and all
documents are searched for each block, so memory is bounded whatever its size; nothing is shuffled but the counts of the
benchmark's own shingles and, with several blocks, the hits.

Texts or items that are null or have no words hit nothing. Items that share an id count as one; items without an id mark
words but are not listed. Rows that repeat get equal results.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ledgerlark.llm import common as C
from ledgerlark.session import materialise

WINDOW = 13
SHINGLE = 3
#: Text of the benchmark that a worker holds at once, with the windows made of it.
BLOCK_BYTES = 4 << 20

SPAN = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
FIELDS = [T.StructField("n_words", T.LongType()), T.StructField("spans", T.ArrayType(SPAN))]


class Windows(NamedTuple):
    """Windows of one length: their words, the items they come from, and their shingles."""

    size: int
    words: np.ndarray
    item_offsets: np.ndarray
    items: np.ndarray
    shingles: np.ndarray


class Probe(NamedTuple):
    """A sorted key list behind a bitmap of their low bits."""

    keys: np.ndarray
    bits: np.ndarray

    @staticmethod
    def of(keys: np.ndarray) -> Probe:
        bits = np.zeros(1 << max(12, int(len(keys) * 16).bit_length()), bool)
        bits[keys & np.uint64(len(bits) - 1)] = True
        return Probe(np.sort(keys), bits)

    def find(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``values`` whose value is a key, and the key's index."""
        at = np.flatnonzero(self.bits[values & np.uint64(len(self.bits) - 1)])
        if not len(self.keys) or not len(at):
            return at[:0], at[:0]
        index = np.minimum(np.searchsorted(self.keys, values[at]), len(self.keys) - 1)
        same = self.keys[index] == values[at]
        return at[same], index[same]


def _texts(items: list[bytes]) -> C.Texts:
    return C.Texts(np.frombuffer(b"".join(items), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in items])]).astype(np.int64))


def item_windows(ids: list[int | None], items: list[bytes]) -> list[Windows]:
    """The distinct windows of the items, by length."""
    words = C.words_of(_texts(items), C.ALNUM, C.LOWER)
    counts, out = words.counts(), []
    for size in sorted({int(min(n, WINDOW)) for n in counts if n}):
        wanted = counts >= WINDOW if size == WINDOW else counts == size
        _, first = C.windows(words, size)
        owner = words.text_of()[first]
        first, owner = first[wanted[owner]], owner[wanted[owner]]
        rows, which = np.unique(words.hashes[first[:, None] + np.arange(size)], axis=0, return_inverse=True)
        known = np.array([i is not None for i in ids], bool)[owner]
        pairs = np.unique(np.stack([which.reshape(-1)[known], np.array([i or 0 for i in ids], np.int64)[owner[known]]]), axis=1)
        offsets = np.searchsorted(pairs[0], np.arange(len(rows) + 1))
        each = min(SHINGLE, size)
        flat = C.Words(rows.reshape(-1), np.zeros(0), np.zeros(0), np.arange(len(rows) + 1) * size)
        out.append(Windows(size, rows, offsets, pairs[1], C.windows(flat, each)[0].reshape(len(rows), size - each + 1)))
    return out


def _counter(blocks: list[Windows]):
    """Per chunk, how often each shingle of the benchmark occurs: (size, key, n)."""
    probes = {size: Probe.of(np.unique(np.concatenate([b.shingles.reshape(-1) for b in blocks if min(SHINGLE, b.size) == size])))
              for size in {min(SHINGLE, b.size) for b in blocks}}

    def count(batches):
        totals = {size: np.zeros(len(p.keys), np.int64) for size, p in probes.items()}
        for batch in batches:
            for _, _, texts in C._chunks(batch.column(0), C.CHUNK):
                words = C.words_of(texts, C.ALNUM, C.LOWER)
                for size, probe in probes.items():
                    totals[size] += np.bincount(probe.find(C.windows(words, size)[0])[1], minlength=len(probe.keys))
        for size, total in totals.items():
            seen = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(seen), size, np.int64)), pa.array(C.signed(probes[size].keys[seen])),
                                              pa.array(total[seen])], names=["size", "key", "n"])

    return count


def rarest(block: Windows, counts: dict[tuple[int, int], int]) -> np.ndarray:
    """For each window the place of its rarest shingle; ties go to the smaller hash."""
    each = min(SHINGLE, block.size)
    keys = C.signed(np.ascontiguousarray(block.shingles))
    n = np.array([counts.get((each, k), 0) for k in keys.reshape(-1).tolist()], np.int64).reshape(keys.shape)
    least = n == n.min(axis=1, keepdims=True)
    return np.where(least, block.shingles, np.uint64(2 ** 64 - 1)).argmin(axis=1)


def _search(blocks: list[Windows], places: list[np.ndarray], names: pa.Array):
    """``names`` are the ids of the items, which the windows know by number."""
    index = []
    for block, place in zip(blocks, places, strict=True):
        anchor = block.shingles[np.arange(len(place)), place]
        order = np.argsort(anchor, kind="stable")
        keys, begins = np.unique(anchor[order], return_index=True)
        index.append((block, place, Probe.of(keys), order, np.append(begins, len(order))))

    def search(texts: C.Texts) -> list[pa.Array]:
        words = C.words_of(texts, C.ALNUM, C.LOWER)
        cover = np.zeros(len(words.hashes) + 1, np.int64)
        owner, docs, items = words.text_of(), [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        shingles = {}
        for block, place, probe, order, begins in index:
            each = min(SHINGLE, block.size)
            if each not in shingles:
                shingles[each] = C.windows(words, each)
            keys, at = shingles[each]
            hit, key = probe.find(keys)
            several = begins[key + 1] - begins[key]
            nth = np.arange(several.sum()) - np.repeat(np.cumsum(several) - several, several)
            window = order[np.repeat(begins[key], several) + nth]
            anchor = np.repeat(at[hit], several)
            start, text = anchor - place[window], owner[anchor]
            fits = (start >= words.offsets[text]) & (start + block.size <= words.offsets[text + 1])
            start, window, text = start[fits], window[fits], text[fits]
            if not len(start):
                continue
            same = (words.hashes[start[:, None] + np.arange(block.size)] == block.words[window]).all(axis=1)
            start, window, text = start[same], window[same], text[same]
            np.add.at(cover, start, 1)
            np.add.at(cover, start + block.size, -1)
            n = block.item_offsets[window + 1] - block.item_offsets[window]
            nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            docs.append(np.repeat(text, n))
            items.append(block.items[np.repeat(block.item_offsets[window], n) + nth])
        hit = np.cumsum(cover)[:-1] > 0
        edge = np.ones(len(hit) + 1, bool)
        edge[1:-1] = (hit[1:] != hit[:-1]) | (owner[1:] != owner[:-1])
        runs = np.flatnonzero(edge)
        begin, end = runs[:-1], runs[1:]
        begin, end = begin[hit[begin]], end[hit[begin]]
        spans = pa.StructArray.from_arrays([pa.array(begin - words.offsets[owner[begin]]), pa.array(end - words.offsets[owner[begin]])],
                                           ["start", "end"])
        pairs = np.unique(np.stack([np.concatenate(docs), np.concatenate(items)]), axis=1)
        borders = np.arange(texts.count + 1)
        return [pa.array(words.counts().astype(np.int64)),
                pa.ListArray.from_arrays(pa.array(np.searchsorted(owner[begin], borders), pa.int32()), spans),
                pa.ListArray.from_arrays(pa.array(np.searchsorted(pairs[0], borders), pa.int32()), names.take(pa.array(pairs[1])))]

    return search


def find_passages(docs: DataFrame, benchmark: DataFrame, carry: list[str], text: str = "text", item: str = "item_id",
                  item_text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``carry`` and, per row, ``n_words``, ``spans`` of hit words, ``items`` found, ``n_hit`` and ``contaminated``
    (a hit, and at least one word in twenty hit). Items keep the type of their ids; items of one id are one item.

    A carried column that is named like one of these gives way to it. Very long texts are searched whole, each a chunk of its own; items
    are taken in blocks of ``block_bytes``. An empty table of documents gives an empty result, without items nothing is hit.
    """
    carry = [c for c in carry if c.lower() not in ("n_words", "spans", "items", "n_hit", "contaminated")]
    queries = benchmark.select(F.col(item).alias("id"), F.coalesce(item_text, F.lit("")).cast("binary").alias("t"))
    size = queries.agg(F.coalesce(F.sum(F.length("t")), F.lit(0)).alias("n")).first()["n"]
    n_blocks = max(1, -(-size // block_bytes))
    rows, keep, kind = docs, list(carry), queries.schema["id"].dataType
    fields = [*FIELDS, T.StructField("items", T.ArrayType(kind))]
    if n_blocks > 1:
        row = C.fresh(docs, "passage_row")[0]
        rows = materialise(docs.select(*dict.fromkeys([*carry, text])).withColumn(row, F.monotonically_increasing_id()), "passages")
        keep.append(row)
    found = []
    for b in range(n_blocks):
        part = queries.filter(F.pmod(F.xxhash64("id", "t"), F.lit(n_blocks)) == b).collect()
        numbers = {x: i for i, x in enumerate(dict.fromkeys(r["id"] for r in part if r["id"] is not None))}
        blocks = item_windows([numbers.get(r["id"]) for r in part], [bytes(r["t"]) for r in part])
        counts = {}
        if blocks:
            counted = rows.select(F.col(text).cast("binary")).mapInArrow(_counter(blocks), "size bigint, key bigint, n bigint")
            counts = {(r["size"], r["key"]): r["n"] for r in counted.groupBy("size", "key").agg(F.sum("n").alias("n")).collect()}
        names = pa.array(list(numbers), to_arrow_type(kind))
        found.append(C.map_texts(rows, keep, _search(blocks, [rarest(x, counts) for x in blocks], names), fields, text))
    out = found[0]
    if n_blocks > 1:
        merged = found[0]
        for f in found[1:]:
            merged = merged.unionByName(f)
        out = merged.groupBy(row).agg(*[F.first(c).alias(c) for c in [*carry, "n_words"]],
                                      F.flatten(F.collect_list("spans")).alias("spans"),
                                      F.array_distinct(F.flatten(F.collect_list("items"))).alias("items")).drop(row)
    zero = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("reach"))
    hit = F.aggregate(F.array_sort("spans"), zero, lambda s, x: F.struct(
        (s["n"] + F.greatest(x["end"] - F.greatest(x["start"], s["reach"]), F.lit(0))).alias("n"),
        F.greatest(s["reach"], x["end"]).alias("reach")), lambda s: s["n"])
    return out.withColumn("n_hit", hit).withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))
