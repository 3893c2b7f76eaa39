"""Queries over the models: quality classifier, suffix tree, piece tokens."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlark.llm import quality_model as Q
from ledgerlark.llm.common import bucket
from ledgerlark.llm.piece_tokens import encode
from ledgerlark.llm.registry import query, table
from ledgerlark.llm.suffix_tree import score_texts
from ledgerlark.session import materialise

ACCEPTED = 0.3
PIECES = "/opt/tokenizers/piece_bpe_32k.model"


@query("op9_lm_scoring")
def op9(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    fold = bucket("doc_id", 10)
    scored = score_texts(docs, fold != 0, ["doc_id"])
    return scored.select("doc_id", (fold == 0).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query("op5_quality_classifier")
def op5(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    fold = bucket("doc_id", 5)
    rows = materialise(Q.featurise(docs, ["doc_id"]), "features")
    scored = Q.add_scores(rows, Q.train(rows, labels, fold != 0), ["doc_id"])
    return scored.select("doc_id", (fold == 0).alias("held_out"), "score", (F.col("score") >= ACCEPTED).cast("int").alias("predicted"))


@query("op10_piece_tokens")
def op10(spark, sf_dir):
    """Ids of every whole text, and whether decoding them gives the text back."""
    encoded = encode(table(spark, sf_dir, "documents"), PIECES, ["doc_id"], check="round_trip")
    return encoded.select("doc_id", F.size("ids").alias("n_tokens"), "ids", "round_trip")
