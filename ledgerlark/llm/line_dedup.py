"""Removal of lines that many sites share, by sketches of the sites of each line.

A page is the set of its lines. Copies of a page on several sites are one page, which counts for its first site; without that, every copy
of a page would lose all of its lines and nothing would be left for a near-duplicate operator to pick. So a line is spread
if different pages have it on ``min_sites`` sites or more, and it is removed from every document, copies included.

Per line hash a HyperLogLog sketch of the sites is built where the rows are and merged by the aggregation, so a line that is
everywhere costs one small sketch per task. Lines whose estimate is near the limit get an exact distinct count; the others
are decided by the estimate, whose error is a small part of the margin. Lines are compared without white space at their
ends; blank lines are neither counted nor removed. A site that is null counts for no line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.common import fresh
from ledgerlark.session import materialise

#: Sketch size (2 ** 12 registers): a relative standard error of 1.6 %, so the margin below is over ten of them.
LOG_REGISTERS = 12
MARGIN = 0.2

_BLANK = " \t\r\x0b\x0c"


def _trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(_BLANK))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _pages(lines: DataFrame) -> DataFrame:
    """(line, site) once per page, with the page's first site; copies of a page fold where the rows are."""
    return lines.groupBy("line", "page").agg(F.min("site").alias("site"))


def spread_lines(lines: DataFrame, min_sites: int) -> DataFrame:
    """``line`` hashes that different pages have on ``min_sites`` sites or more, from rows of (line, page, site)."""
    estimated = _pages(lines).groupBy("line").agg(F.hll_sketch_agg("site", F.lit(LOG_REGISTERS)).alias("sketch")).select(
        "line", F.hll_sketch_estimate("sketch").alias("sites"))
    estimated = materialise(estimated.filter(F.col("sites") >= min_sites * (1 - MARGIN)), "spread")
    sure = estimated.filter(F.col("sites") > min_sites * (1 + MARGIN)).select("line")
    near = estimated.filter(F.col("sites") <= min_sites * (1 + MARGIN)).select("line")
    exact = _pages(lines.join(near, "line", "left_semi")).groupBy("line").agg(F.count_distinct("site").alias("sites"))
    return sure.unionByName(exact.filter(F.col("sites") >= min_sites).select("line"))


def remove_spread_lines(docs: DataFrame, min_sites: int = 10, text: str = "text", site: str = "source",
                        key: str = "doc_id") -> DataFrame:
    """``docs`` with ``text`` cleaned, and ``n_lines`` (not blank) and ``n_removed``.

    Null texts stay null with 0 lines; empty texts stay empty; a text of spread lines only becomes empty. Rows that repeat are treated
    alike; their sites count once. Very long texts are one row each, with one row per distinct line on the way.
    Columns of ``docs`` named like the added ones are replaced. An empty table gives an empty result.
    """
    docs = docs.drop("n_lines", "n_removed")
    row, gone, kept = fresh(docs, "row_hash", "gone", "kept_lines")
    rows = docs.withColumn(row, F.xxhash64(docs[key], docs[text]))
    hashed = F.array_distinct(F.transform(F.filter(_lines(F.col(text)), lambda x: _trimmed(x) != ""), lambda x: F.xxhash64(_trimmed(x))))
    listed = rows.select(F.col(key).alias("id"), F.col(row).alias("row"), F.col(site).alias("site"), hashed.alias("lines"))
    paged = listed.withColumn("page", F.xxhash64(F.array_sort("lines")))
    lines = materialise(paged.select("id", "row", "page", "site", F.explode("lines").alias("line")), "lines")
    found = spread_lines(lines, min_sites)
    per_doc = lines.join(found, "line").groupBy("id", "row").agg(F.collect_set("line").alias(gone))
    wide = rows.join(per_doc, rows[key].eqNullSafe(per_doc["id"]) & (rows[row] == per_doc["row"]), "left").select(
        *[rows[c] for c in rows.columns], per_doc[gone])

    whole = _lines(F.col(text))
    wide = wide.withColumn(kept, F.when(F.col(gone).isNotNull(), F.filter(
        whole, lambda x: ~F.array_contains(F.col(gone), F.xxhash64(_trimmed(x))))))
    filled = F.aggregate(whole, F.lit(0), lambda total, x: total + F.when(_trimmed(x) != "", 1).otherwise(0))
    wide = wide.withColumn("n_lines", filled)
    cut = F.col(kept).isNotNull()
    cleaned = F.when(cut, F.array_join(F.col(kept), "\n")).otherwise(F.col(text))
    removed = F.when(cut, F.size(whole) - F.size(kept)).otherwise(0)
    return wide.withColumn("n_removed", removed).withColumn(text, cleaned).drop(row, gone, kept)
