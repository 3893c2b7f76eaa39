"""The corpus pipeline: from raw documents to token ids.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept; each result is written as Parquet and read
again. All stages but the last return the columns of ``documents``.

1. ``quality``: the positive-unlabelled classifier, learned from these documents and their labels, rejects documents.
2. ``lines``: lines of many sites are removed; ``n_chars`` follows the text.
3. ``near_duplicates``: of documents whose sets of five-word shingles are similar by 0.8 or more, the one with the smallest id stays.
4. ``benchmark``: documents with benchmark passages in one word of twenty or more are dropped.
5. ``tokens``: the documents with their piece ids.

Null or empty texts: the classifier scores them like any text; later stages keep them, without lines, shingles, hits or tokens. Rows
that repeat get equal answers at every stage, so they stay or go together, except that of equal texts under different ids one stays.
Rows without an id are kept unless a document with an id has a similar text. An empty table gives an empty result of the same columns.
Extra columns of the documents pass through, but for those named like a column that a stage adds, which the stage replaces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.llm import quality_model
from ledgerlark.llm.common import bucket, fresh
from ledgerlark.llm.decontaminate import find_passages
from ledgerlark.llm.line_dedup import remove_spread_lines
from ledgerlark.llm.near_dup import drop_near_duplicates
from ledgerlark.llm.piece_tokens import encode
from ledgerlark.llm.queries_models import ACCEPTED, PIECES
from ledgerlark.llm.queries_native import MIN_SITES
from ledgerlark.llm.registry import table
from ledgerlark.session import materialise

SHINGLE_WORDS = 5
SIMILAR_PERCENT = 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = materialise(quality_model.featurise(docs, ["doc_id"]), "features")
    model = quality_model.train(rows, table(spark, sf_dir, "labels"), bucket("doc_id", 5) != 0)
    score = fresh(docs, "score")[0]
    scored = quality_model.score_texts(docs, model, name=score)
    return scored.filter(F.col(score) >= ACCEPTED).select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cleaned = remove_spread_lines(docs, MIN_SITES)
    return cleaned.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("bigint")).otherwise(
        F.col("n_chars"))).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_duplicates(docs, SHINGLE_WORDS, SIMILAR_PERCENT)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = find_passages(docs, table(spark, sf_dir, "benchmark"), docs.columns)
    return found.filter(~F.col("contaminated")).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = [c for c in docs.columns if c.lower() not in ("ids", "n_tokens")]
    return encode(docs, PIECES, kept).withColumn("n_tokens", F.size("ids"))


STAGES = [("quality", quality), ("lines", lines), ("near_duplicates", near_duplicates), ("benchmark", benchmark), ("tokens", tokens)]

#: The classifier's fit has no SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
