"""Quality rules by the frequency of lines across the documents of a host.

Lines are compared in a normal form (letters A-Z in lower case, digits as 0, runs of white space as one space) by a 64-bit
hash. Per host the distinct documents of each line are counted; a line found in more than ``max_docs`` of them is boilerplate
of that host and is taken out; a document that keeps too few words, or loses too large a part, is depleted and rejected.
The limit counts documents, so it means the same at every size. ``host_line_rules`` reports on every row, ``without_frequent_lines``
gives the documents that remain, with the text they keep.

Next to it stand plain counts of a text: words, characters in words, symbols, repeated lines and words in repeated windows.
Counting goes by (host, line, document), so a line that is everywhere is combined before it is shuffled, and a host that
holds a third of all rows is many keys. Finding a document's frequent lines is an ordinary equality join whose large
partitions Spark splits.

Null or empty texts have no words and fail the base rule. A null host is a host of its own. Rows that repeat are judged
alike and count as one document; a row without doc_id is a document of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ledgerlark.llm import common as C
from ledgerlark.session import materialise

_SYMBOLS = np.zeros(256, dtype=bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_NOT_NEWLINE = np.ones(256, dtype=bool)
_NOT_NEWLINE[10] = False
_BLANK = b" \t\n\v\f\r"

WINDOW = 5

FIELDS = [T.StructField(n, T.LongType()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")] + [
    T.StructField("lines", T.ArrayType(T.StructType([T.StructField("line", T.LongType()), T.StructField("words", T.LongType())])))]


def _repeated(keys: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which keys occur before in their group, and which occur twice or more in it."""
    order = np.lexsort((keys, groups))
    k, g = keys[order], groups[order]
    same = (k[1:] == k[:-1]) & (g[1:] == g[:-1])
    later, several = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    later[order[1:][same]] = True
    several[order[1:][same]] = True
    several[order[:-1][same]] = True
    return later, several


def repeated_words(words: C.Words, size: int = WINDOW) -> np.ndarray:
    """Which words lie in a window of ``size`` words found twice or more in the same text."""
    keys, at = C.windows(words, size)
    cover = np.zeros(len(words.hashes) + 1, np.int64)
    if len(at):
        _, several = _repeated(keys, words.text_of()[at])
        np.add.at(cover, at[several], 1)
        np.add.at(cover, at[several] + size, -1)
    return np.cumsum(cover)[:-1] > 0


def lines_of(texts: C.Texts, words: C.Words) -> tuple[C.Words, np.ndarray, np.ndarray, np.ndarray]:
    """The \\n-split lines that are not empty, which of them have words, and those lines' normal form and number of words."""
    raw = C.words_of(texts, _NOT_NEWLINE)
    first = np.searchsorted(words.starts, raw.starts)
    at = np.flatnonzero(np.searchsorted(words.starts, raw.ends) > first)
    formed = C.words_of(texts, C.NOT_SPACE, C.LINE_FORM).hashes
    in_line = np.diff(np.append(first[at], len(formed)))
    line = np.zeros(0, np.uint64)
    if len(at):
        place = np.arange(len(formed)) - np.repeat(first[at], in_line)
        line = C.mix(np.add.reduceat(formed * C.powers(int(in_line.max()))[place], first[at]))
    return raw, at, line, in_line


def measure(texts: C.Texts) -> list[pa.Array]:
    """The plain counts of each text, and its distinct lines in normal form with their words."""
    words = C.words_of(texts)
    heads = (texts.data & 0xC0) != 0x80
    code_points = np.concatenate([[0], np.cumsum(heads)])
    chars = code_points[words.ends] - code_points[words.starts]
    symbols = C.per_text(_SYMBOLS[texts.data], texts.offsets)

    raw, at, line, in_line = lines_of(texts, words)
    owner = raw.text_of()
    later = np.zeros(len(raw.hashes), bool)
    later[at] = _repeated(raw.hashes[at], owner[at])[0]
    size = in_line
    repeated, _ = _repeated(line, owner[at])
    once = ~repeated
    # A line counts with all its words, however often the text repeats it.
    total = np.zeros(0, np.int64)
    if len(at):
        order = np.lexsort((repeated, line, owner[at]))
        begin = np.flatnonzero(once[order])
        total = np.zeros(len(at), np.int64)
        total[order[begin]] = np.add.reduceat(size[order], begin)
    offsets = np.concatenate([[0], np.cumsum(np.bincount(owner[at][once], minlength=texts.count))])
    lines = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(
        [pa.array(C.signed(line[once])), pa.array(total[once] if len(at) else total)], ["line", "words"]))
    numbers = (words.counts(), C.per_text(chars, words.offsets), symbols, C.per_text(later, raw.offsets),
               C.per_text(repeated_words(words), words.offsets))
    return [*[pa.array(x.astype(np.int64)) for x in numbers], lines]


def frequent_lines(lines: DataFrame, max_docs: int) -> DataFrame:
    """(host, line, docs) of lines in more than ``max_docs`` distinct documents, from rows of (host, line, doc)."""
    return lines.groupBy("host", "line").agg(F.count_distinct("doc").alias("docs")).filter(F.col("docs") > max_docs)


def host_line_rules(docs: DataFrame, max_docs: int = 20, min_words: int = 10, max_removed: float = 0.5,
                    key: str = "doc_id", host: str = "source", text: str = "text") -> DataFrame:
    """Per row: the key, the plain counts, ``words_left`` after the host's frequent lines went, ``n_frequent_lines`` and
    ``depleted`` (fewer than ``min_words`` left, or more than ``max_removed`` of the words gone).

    Any names will do for key, host and text; the host's column is left out where it is named like a result. Very long texts are
    measured whole, each a chunk of its own. An empty table gives an empty result."""
    named = docs.select(F.col(key).alias("the_key"), F.col(host).alias("the_host"), F.col(text).alias("the_text"))
    base = C.map_texts(named, ["the_key", "the_host"], measure, FIELDS, "the_text")
    base = materialise(base.withColumn("row", F.monotonically_increasing_id()), "line-rules")
    document = F.struct(F.col("the_key"), F.when(F.col("the_key").isNull(), F.col("row")))
    lines = base.select("row", document.alias("doc"), F.col("the_host").alias("host"), F.inline("lines"))
    known = frequent_lines(lines, max_docs)
    same = F.col("a.host").eqNullSafe(F.col("b.host")) & (F.col("a.line") == F.col("b.line"))
    found = lines.alias("a").join(known.alias("b"), same)
    gone = found.groupBy("row").agg(F.sum("words").alias("gone"), F.count("*").alias("n_frequent_lines"))
    judged = base.drop("lines").join(gone, "row", "left").fillna({"gone": 0, "n_frequent_lines": 0})
    left = F.col("n_words") - F.col("gone")
    depleted = (left < min_words) | (F.col("gone") > F.col("n_words") * F.lit(max_removed))
    out = judged.withColumns({"words_left": left, "depleted": depleted}).drop("row", "gone")
    results = [c for c in out.columns if c not in ("the_key", "the_host") and c.lower() != key.lower()]
    shown = [] if host.lower() in (key.lower(), *(c.lower() for c in results)) else [F.col("the_host").alias(host)]
    return out.select(F.col("the_key").alias(key), *shown, *results)


def _without(texts: C.Texts, gone: list[np.ndarray | None]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Each text without the lines in its list of hashes, its words before, and the words that went."""
    words = C.words_of(texts)
    raw, at, line, in_line = lines_of(texts, words)
    begin = np.searchsorted(raw.text_of()[at], np.arange(texts.count + 1))
    kept, lost = [], np.zeros(texts.count, np.int64)
    for i, hashes in enumerate(gone):
        data = texts.data[texts.offsets[i]:texts.offsets[i + 1]].tobytes()
        if hashes is not None:
            span = slice(begin[i], begin[i + 1])
            drop = np.isin(line[span], hashes)
            lost[i] = in_line[span][drop].sum()
            verdicts = iter(drop)
            data = b"\n".join([part for part in data.split(b"\n") if not part.strip(_BLANK) or not next(verdicts)])
        kept.append(data)
    return kept, words.counts(), lost


def _drop_lines(df: DataFrame, text: str, gone: str, min_words: int, max_removed: float) -> DataFrame:
    """``df`` without ``gone``, the hashes of the lines to drop from ``text``; depleted rows go."""
    at, lists = [c.lower() for c in df.columns].index(text.lower()), df.columns.index(gone)
    names = [c for c in df.columns if c != gone]
    schema = df.select(*names).schema
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(at).cast(pa.binary())
            for start, stop, texts in C._chunks(column, C.CHUNK):
                rows = batch.slice(start, stop - start)
                hashes = [np.asarray(x.values).view(np.uint64) if x.is_valid else None for x in rows.column(lists)]
                kept, n, lost = _without(texts, hashes)
                left = n - lost
                fine = pa.array(~((left < min_words) | (lost > n * max_removed)))
                cleaned = pa.array(kept, pa.binary()).cast(pa.string())
                arrays = [cleaned if i == at else rows.column(i) for i in range(rows.num_columns) if i != lists]
                yield pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip(arrays, arrow, strict=True)],
                                                 schema=arrow).filter(fine)

    return df.mapInArrow(run, schema)


def without_frequent_lines(docs: DataFrame, max_docs: int = 20, min_words: int = 10, max_removed: float = 0.5,
                           key: str = "doc_id", host: str = "source", text: str = "text") -> DataFrame:
    """The documents that are not depleted, all their columns, ``text`` without the frequent lines of their host.

    The verdict is that of ``host_line_rules``. Lines without words stay. Which lines go depends on host and text alone, so the
    lists are made once per distinct text of a host and joined by a hash of it; copies share one. A null text has no words and goes
    with the depleted ones, unless ``min_words`` is 0, and is empty then. Very long texts are a chunk of their own; extra columns
    may have any names; an empty table gives an empty result of the same columns."""
    whole = F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256))
    named = docs.select(F.col(key).alias("the_key"), F.col(host).alias("the_host"), whole.alias("the_print"),
                        F.col(text).alias("the_text"))
    base = C.map_texts(named, ["the_key", "the_host", "the_print"], measure, FIELDS, "the_text")
    base = materialise(base.withColumn("row", F.monotonically_increasing_id()), "frequent-lines")
    document = F.struct(F.col("the_key"), F.when(F.col("the_key").isNull(), F.col("row")))
    lines = base.select("the_print", document.alias("doc"), F.col("the_host").alias("host"), F.inline("lines"))
    known = frequent_lines(lines, max_docs)
    same = F.col("a.host").eqNullSafe(F.col("b.host")) & (F.col("a.line") == F.col("b.line"))
    lists = lines.alias("a").join(known.alias("b"), same).groupBy("a.host", "a.the_print").agg(
        F.collect_set("a.line").alias("gone"))
    mark, place, gone = C.fresh(docs, "text_mark", "host_mark", "gone_lines")
    lists = lists.select(F.col("host").alias(place), F.col("the_print").alias(mark), F.col("gone").alias(gone))
    marked = docs.withColumn(mark, whole).alias("d")
    found = marked.join(lists.alias("l"), F.col(f"d.`{mark}`").eqNullSafe(F.col(f"l.`{mark}`"))
                        & F.col(f"d.`{host}`").eqNullSafe(F.col(f"l.`{place}`")), "left")
    found = found.select(*[F.col(f"d.`{c}`") for c in docs.columns], F.col(f"l.`{gone}`"))
    return _drop_lines(found, text, gone, min_words, max_removed)
