"""A quality classifier learned from trusted positives and unlabelled text.

Non-negative positive-unlabelled learning: with the logistic loss l, the class prior p and a linear score g, the risk

    p * E_positive[l(g)] + max(0, E_unlabelled[l(-g)] - p * E_positive[l(-g)])

is minimised. While the second term, the estimated risk of the negatives, is positive, the unbiased risk is convex and its Newton
step needs only means over the data; a step after which that term would be negative is shortened. Every term is a sum over all
training rows, made by Spark from one table of features; the driver holds a matrix of features by features.

The prior is estimated from the same data: a first model is fitted with a low prior, and among the sets "score above t" the least
ratio of the unlabelled to the positive share is the largest share of positives that the unlabelled can hold. Only sets that keep
85 % of the positives or more are used, because ratios of smaller sets are noisy and their least one falls too low; a set that is left
out can only have had a lower ratio, so the estimate errs towards a higher prior, which accepts more documents.

Features are counts on the text alone: rates of symbols, capitals, digits and line ends, and shares of repeated words. A null
or empty text has the features of an empty text and gets a score like any other. Rows that repeat count as often as they occur.
Keys with contradicting labels, null labels or label 0 are no trusted positives; labelled rows are not in the unlabelled part. Without
positives, or without any unlabelled row, all scores are 0.5.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlark.llm import common as C
from ledgerlark.llm.line_rules import repeated_words
from ledgerlark.session import materialise

SYMBOLS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
N_FEATURES = 8 + len(SYMBOLS) + 1
RIDGE = 1e-4
STEPS = 15
#: The rate at which a feature is half of its greatest value.
HALF = 0.1
FIRST_PRIOR = 0.5
BINS = 400
KEPT_SHARE = 0.85

_UPPER, _LOWER, _DIGIT, _LINE, _HIGH = len(SYMBOLS), len(SYMBOLS) + 1, len(SYMBOLS) + 2, len(SYMBOLS) + 3, len(SYMBOLS) + 4
_CLASSES = len(SYMBOLS) + 6
_CLASS = np.full(256, _CLASSES - 1, np.int64)
_CLASS[list(SYMBOLS)] = np.arange(len(SYMBOLS))
_CLASS[0x41:0x5B], _CLASS[0x61:0x7B], _CLASS[0x30:0x3A], _CLASS[10], _CLASS[0x80:] = _UPPER, _LOWER, _DIGIT, _LINE, _HIGH


def features(texts: C.Texts) -> np.ndarray:
    """A row per text; all features are bounded, the last one is constant."""
    owner = np.repeat(np.arange(texts.count), np.diff(texts.offsets))
    counts = np.bincount(owner * _CLASSES + _CLASS[texts.data], minlength=texts.count * _CLASSES).reshape(texts.count, _CLASSES)
    words = C.words_of(texts)
    n = words.counts()
    per_word = counts[:, :len(SYMBOLS)] / np.maximum(n, 1)[:, None]
    whose = words.text_of()
    follows = np.zeros(len(whose), np.int64)
    follows[1:] = (words.hashes[1:] == words.hashes[:-1]) & (whose[1:] == whose[:-1])
    order = np.lexsort((words.hashes, whose))
    h, w = words.hashes[order], whose[order]
    again = np.zeros(len(whose), np.int64)
    again[1:] = (h[1:] == h[:-1]) & (w[1:] == w[:-1])
    again = np.bincount(w, again, texts.count)
    letters = np.maximum(counts[:, _UPPER] + counts[:, _LOWER] + counts[:, _HIGH], 1)
    shares = [counts[:, _UPPER] / letters, counts[:, _DIGIT] / np.maximum(n, 1), counts[:, _LINE] / np.maximum(n, 1),
              counts[:, _HIGH] / letters, C.per_text(follows, words.offsets) / np.maximum(n, 1), again / np.maximum(n, 1),
              C.per_text(repeated_words(words).astype(np.int64), words.offsets) / np.maximum(n, 1), np.log1p(n) / 10]
    rates = np.column_stack([*shares[:-1], per_word])
    return np.column_stack([rates / (rates + HALF), shares[-1], np.ones(texts.count)])


def _as_lists(texts: C.Texts) -> list[pa.Array]:
    x = features(texts)
    return [C.ragged(x.reshape(-1), np.arange(texts.count + 1) * N_FEATURES, pa.float32())]


class Model(NamedTuple):
    weights: np.ndarray
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x @ self.weights, -35, 35)))


def _matrix(column) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.float64)


def _summed(table: DataFrame, part) -> np.ndarray:
    """The sum over all rows of what ``part(x, positive)`` adds up for a batch, as one vector."""

    def run(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                add = part(_matrix(batch.column(0)), batch.column(1).to_numpy(zero_copy_only=False).astype(bool))
                total = add if total is None else total + add
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], names=["i", "v"])

    parts = table.select("x", "positive").mapInArrow(run, "i int, v double")
    rows = parts.groupBy("i").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(len(rows))
    for r in rows:
        out[r["i"]] = r["v"]
    return out


def _soft(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, z)


def fit_weights(table: DataFrame, n_pos: float, n_un: float, mean_pos: np.ndarray, prior: float, start: np.ndarray) -> np.ndarray:
    """Newton steps on the unbiased risk, each shortened until the negatives' estimated risk is not negative."""
    d = N_FEATURES
    penalty = np.full(d, RIDGE)
    penalty[-1] = 0

    def terms(weights: list[np.ndarray]):
        w = np.stack(weights, axis=1)

        def part(x, positive):
            z = x @ w
            un = ~positive
            s = 1 / (1 + np.exp(-np.clip(z[un, 0], -35, 35)))
            xu = x[un]
            return np.concatenate([_soft(z[un]).sum(axis=0), _soft(z[positive]).sum(axis=0), s @ xu,
                                   ((xu * (s * (1 - s))[:, None]).T @ xu).reshape(-1)])

        total, k = _summed(table, part), len(weights)
        un, pos, slope, curve = total[:k] / n_un, total[k:2 * k] / n_pos, total[2 * k:2 * k + d] / n_un, total[2 * k + d:] / n_un
        return un, pos, slope, curve.reshape(d, d)

    def risk(w, un, pos):
        # l(g) - l(-g) = -g, so the positives' part is linear where the negatives' part is not cut off.
        return -prior * (mean_pos @ w) + prior * pos + max(0.0, un - prior * pos) + 0.5 * (penalty * w * w).sum()

    w = start
    un, pos, slope, curve = terms([w])
    at = risk(w, un[0], pos[0])
    for _ in range(STEPS):
        step = np.linalg.solve(curve + np.diag(penalty + 1e-9), prior * mean_pos - slope - penalty * w)
        tries = [w + step * f for f in (1.0, 0.5, 0.25, 0.0625)]
        un, pos, _, _ = terms(tries)
        risks = [risk(t, a, b) if a - prior * b >= 0 else np.inf for t, a, b in zip(tries, un, pos, strict=True)]
        best = int(np.argmin(risks))
        if not risks[best] < at - 1e-6:
            break
        w, at = tries[best], risks[best]
        _, _, slope, curve = terms([w])
    return w


def estimate_prior(table: DataFrame, weights: np.ndarray, n_pos: float, n_un: float) -> float:
    def part(x, positive):
        bin_ = np.clip(((x @ weights) + 20) / 40 * BINS, 0, BINS - 1).astype(int)
        return np.concatenate([np.bincount(bin_[positive], minlength=BINS), np.bincount(bin_[~positive], minlength=BINS)]).astype(float)

    hist = _summed(table, part)
    pos, un = (np.cumsum(h[::-1]) / n for h, n in ((hist[:BINS], n_pos), (hist[BINS:], n_un)))
    used = pos >= KEPT_SHARE
    return float(np.clip((un[used] / pos[used]).min(), 0.01, 0.99))


def fit(table: DataFrame) -> Model | None:
    """A model from rows of (x, positive); None without positives or unlabelled rows."""
    d = N_FEATURES

    def part(x, positive):
        return np.concatenate([[positive.sum(), (~positive).sum()], x[positive].sum(axis=0)]).astype(float)

    total = _summed(table, part)
    if len(total) == 0 or not total[0] or not total[1]:
        return None
    n_pos, n_un, mean_pos = total[0], total[1], total[2:] / total[0]
    first = fit_weights(table, n_pos, n_un, mean_pos, FIRST_PRIOR, np.zeros(d))
    prior = estimate_prior(table, first, n_pos, n_un)
    return Model(fit_weights(table, n_pos, n_un, mean_pos, prior, np.zeros(d)), prior)


def featurise(docs: DataFrame, carry: list[str], text: str = "text") -> DataFrame:
    return C.map_texts(docs, carry, _as_lists, [T.StructField("x", T.ArrayType(T.FloatType()))], text)


def train(rows: DataFrame, labels: DataFrame, training: Column, key: str = "doc_id") -> Model | None:
    """Fit on ``rows`` of (key, x) where ``training`` holds; ``labels`` are (key, quality)."""
    known = labels.groupBy(F.col(key).alias("labelled")).agg((F.coalesce(F.min("quality"), F.lit(0)) == 1).alias("good"))
    learned = rows.filter(training)
    joined = learned.join(known, learned[key] == known["labelled"], "left")
    used = joined.filter(F.col("labelled").isNull() | F.col("good")).select("x", F.col("labelled").isNotNull().alias("positive"))
    return fit(materialise(used, "learned"))


def add_scores(rows: DataFrame, model: Model | None, carry: list[str]) -> DataFrame:
    """``carry`` and ``score`` from rows with features ``x``."""
    if model is None:
        return rows.select(*carry, F.lit(0.5).alias("score"))
    weights = F.array(*[F.lit(float(w)) for w in model.weights])
    z = F.aggregate(F.zip_with("x", weights, lambda a, b: a.cast("double") * b), F.lit(0.0), lambda s, v: s + v)
    return rows.select(*carry, (1 / (1 + F.exp(-F.greatest(F.least(z, F.lit(35.0)), F.lit(-35.0))))).alias("score"))


def score_texts(docs: DataFrame, model: Model | None, text: str = "text", name: str = "score") -> DataFrame:
    """All columns of ``docs`` and the score, in one narrow pass over the texts; a column of that name is replaced."""
    carry = [c for c in docs.columns if c.lower() != name.lower()]
    if model is None:
        return docs.select(*carry, F.lit(0.5).alias(name))

    def score(texts: C.Texts) -> list[pa.Array]:
        return [pa.array(model.score(features(texts).astype(np.float32).astype(np.float64)))]

    return C.map_texts(docs, carry, score, [T.StructField(name, T.DoubleType())], text)
