"""Maximal periodic runs of words, found with a dictionary of basic factors.

A run is a stretch of words with smallest period q that is at least ``2 * q`` and ``min_length`` words long and that neither neighbouring
word extends. The factors of each power-of-two length get names, equal factors equal ones: a name of length 2k is the pair of two names of
length k. Factors that occur once are left out, so the dictionary of ordinary prose ends after a few lengths.

A run of period q holds the same factor of length 2 ** k <= q < 2 ** (k + 1) twice, q words apart. Occurrences of a factor that overlap by
half or more form an arithmetic progression of its own period; such progressions stand more than half a length apart. So, per factor,
only the next three progressions lie within twice the length, and the distances between the members of two of them are again a
progression: these are the proposed periods. A proposal is extended both ways by comparing names from the longest down, and kept
if it is a run; proposals with equal borders are one run, whose period is the smallest.

All texts of a chunk are searched at once; names hold the text, so no factor spans two. Words are compared by 64-bit hashes.

Null and empty texts have no words and no runs. A very long text is a chunk of its own, searched whole. Rows that repeat get equal
answers; two runs never tie in both borders. An empty table gives an empty result. Columns named like an added one are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ledgerlark.llm.common import Texts, map_texts, mix, words_of

RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])


def basic_factors(symbols: np.ndarray) -> list[np.ndarray]:
    """Names of the factors of length 1, 2, 4, ... at each position; -1 where a factor occurs once or does not fit."""
    n = len(symbols)
    at, keys, levels = np.arange(n), symbols, []
    while len(at):
        _, name, count = np.unique(keys, return_inverse=True, return_counts=True)
        again = count[name] > 1
        names = np.full(n, -1, np.int32)
        names[at[again]] = name[again]
        if not again.any():
            break
        half = 1 << len(levels)
        levels.append(names)
        at = at[again]
        at = at[at + half < n]
        at = at[names[at + half] >= 0]
        keys = names[at].astype(np.int64) * n + names[at + half]
    return levels


def _progressions(names: np.ndarray, half: int) -> tuple[np.ndarray, ...]:
    """First and last member, size, step and name of the progressions of a length, by name and place."""
    at = np.flatnonzero(names >= 0)
    at = at[np.argsort(names[at], kind="stable")]
    name, gap = names[at], np.diff(at)
    begins = np.concatenate([[True], (name[1:] != name[:-1]) | (gap > half)])
    heads = np.flatnonzero(begins)
    tails = np.concatenate([heads[1:], [len(at)]]) - 1
    size = tails - heads + 1
    return at[heads], at[tails], size, (at[tails] - at[heads]) // np.maximum(size - 1, 1), name[heads]


def _proposals(names: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and distances, from ``length`` up to twice it, at which factors recur; one place of each stretch of places."""
    first, last, size, step, name = _progressions(names, length // 2)
    places, distances = [], []
    for ahead in (1, 2, 3):
        a = np.flatnonzero(name[ahead:] == name[:-ahead])
        b = a + ahead
        base, most = first[b] - last[a], size[a] + size[b] - 2
        s = np.maximum(np.maximum(step[a], step[b]), 1)
        low = np.maximum(-((base - length) // s), 0)
        high = np.minimum((2 * length - 1 - base) // s, most)
        n = np.maximum(high - low + 1, 0)
        pair = np.repeat(np.arange(len(a)), n)
        t = np.arange(len(pair)) - np.repeat(np.cumsum(n) - n, n) + low[pair]
        back = np.minimum(t, size[a][pair] - 1)
        places.append(last[a][pair] - back * s[pair])
        distances.append(base[pair] + t * s[pair])
    place, distance = np.concatenate(places), np.concatenate(distances)
    order = np.lexsort((place, distance))
    place, distance = place[order], distance[order]
    new = np.ones(len(place), bool)
    new[1:] = (distance[1:] != distance[:-1]) | (np.diff(place) > length)
    return place[new], distance[new]


def _matching(levels: list[np.ndarray], i: np.ndarray, j: np.ndarray, forward: bool) -> np.ndarray:
    """How many words from i on (or before i) equal those from j on (or before j)."""
    total = np.zeros(len(i), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        names, size = levels[k], 1 << k
        x, y = (i + total, j + total) if forward else (i - total - size, j - total - size)
        inside = (np.minimum(x, y) >= 0) & (np.maximum(x, y) < len(names))
        x, y = names[np.where(inside, x, 0)], names[np.where(inside, y, 0)]
        total += np.where(inside & (x >= 0) & (x == y), size, 0)
    return total


def runs_of(symbols: np.ndarray, min_length: int = 12) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and period of every run, by start and period."""
    levels = basic_factors(symbols)
    found = [np.zeros((3, 0), np.int64)]
    for k, names in enumerate(levels):
        i, period = _proposals(names, 1 << k)
        before = _matching(levels, i, i + period, False)
        length = period + before + _matching(levels, i, i + period, True)
        run = length >= np.maximum(2 * period, min_length)
        found.append(np.stack([i - before, length, period])[:, run])
    start, length, period = np.concatenate(found, axis=1)
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    new = np.ones(len(start), bool)
    new[1:] = (np.diff(start) != 0) | (np.diff(length) != 0)
    start, length, period = start[new], length[new], period[new]
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def _joined(texts: Texts, words, kept: np.ndarray) -> pa.Array:
    """The kept words of each text with one space between them."""
    count = np.concatenate([[0], np.cumsum(kept)])[words.offsets]
    starts, sizes = words.starts[kept], (words.ends - words.starts)[kept] + 1
    ends = np.cumsum(sizes)
    at = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes, sizes) + np.repeat(starts, sizes)
    data = np.concatenate([texts.data, np.zeros(1, np.uint8)])[at]
    data[ends - 1] = 0x20
    borders = np.concatenate([[0], ends])[count]
    filled = borders[1:] > borders[:-1]
    left = np.ones(len(data), bool)
    left[borders[1:][filled] - 1] = False
    offsets = np.concatenate([[0], np.cumsum(np.diff(borders) - filled)]).astype(np.int32)
    return pa.StringArray.from_buffers(texts.count, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data[left].tobytes()))


def find_runs(docs: DataFrame, carry: list[str], min_length: int = 12, text: str = "text") -> DataFrame:
    """``carry``, ``n_words``, ``runs`` (start, length and period in words, by start and period) and ``collapsed``: the words that no
    run holds beyond its first period, with one space between them. A narrow pass over whole texts."""
    def fn(texts: Texts) -> list[pa.Array]:
        words = words_of(texts)
        n = len(words.hashes)
        start, length, period = runs_of(words.hashes ^ mix(words.text_of().astype(np.uint64)), min_length)
        change = np.zeros(n + 1, np.int64)
        np.add.at(change, start + period, 1)
        np.add.at(change, start + length, -1)
        owner = np.searchsorted(words.offsets, start, side="right") - 1
        parts = [start - words.offsets[owner], length, period]
        listed = pa.StructArray.from_arrays([pa.array(p, pa.int64()) for p in parts], names=RUN.names)
        borders = np.searchsorted(start, words.offsets).astype(np.int32)
        return [pa.array(words.counts().astype(np.int64)), pa.ListArray.from_arrays(pa.array(borders), listed),
                _joined(texts, words, np.cumsum(change[:-1]) == 0)]

    fields = [T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(RUN)), T.StructField("collapsed", T.StringType())]
    return map_texts(docs, carry, fn, fields, text)
