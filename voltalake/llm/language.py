"""Language identification by sparse multinomial logistic regression.

Features are hashed character n-grams of words, weighted by TF-IDF (a feature's
share of the text times its inverse document frequency, counted over all
documents that may be learnt from). The weights are learnt with
follow-the-regularised-leader under an elastic net, from at most ``rows``
documents of each language, and a temperature fitted on every fourth of them
calibrates the probabilities.

Null texts and texts without a letter get ``und`` with score 0, and so do all
if there is nothing to learn from. Ties go to the language that sorts first.
Repeated rows are predicted one by one; other columns are ignored.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltalake.llm.linear import Features, Sparse, collect_sample
from voltalake.llm.text import LETTER, Batch, held_out, map_batches, portions, texts

UNKNOWN = "und"
ROWS = 1000
FEATURES = Features(LETTER, bits=15, sizes=(1, 2, 3), whole=False, lower=True)
SCALE = 30.0
ASCII_LETTERS = bytes(b for b in range(128) if chr(b).isalpha())
RESULT = "doc_id long, lang_pred string, score double"


class Model(NamedTuple):
    languages: list[str]
    weights: np.ndarray  # a column for each language, with the inverse frequencies in it
    bias: np.ndarray
    temperature: float


def has_letter(text: bytes) -> bool:
    if len(text.translate(None, ASCII_LETTERS)) < len(text):
        return True
    return any(map(str.isalpha, text.decode()))


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """In how many documents each feature occurs, and how many documents there are.

    Each Arrow batch gives a row for each feature at most, so what is gathered
    is bounded by the number of features and what is shuffled by the batches.
    """
    size = 1 << FEATURES.bits

    def count(batch: Batch) -> Batch:
        total = np.zeros(size, np.int64)
        of = texts(batch)
        for part in portions(of, count=256):
            idx, text = FEATURES.of_texts(part)
            present = np.zeros((len(part), size), bool)
            present[text, idx] = True
            total += present.sum(axis=0)
        feature = np.flatnonzero(total)
        rows = np.append(feature, -1), np.append(total[feature], len(of))
        return pa.record_batch([pa.array(x, pa.int64()) for x in rows], ["feature", "n"])

    rows = map_batches(docs.select("text"), "feature long, n long", count)
    out, n = np.zeros(size), 0
    for x in rows.groupBy("feature").agg(F.sum("n").alias("n")).collect():
        if x["feature"] < 0:
            n = x["n"]
        else:
            out[x["feature"]] = x["n"]
    return out, n


class Leader:
    """Follow the regularised leader, with an elastic net, a row at a time."""

    def __init__(self, size: int, classes: int, l1: float, l2: float, alpha: float):
        self.z = np.zeros((size, classes))
        self.n = np.zeros((size, classes))
        self.l1, self.l2, self.alpha, self.beta = l1, l2, alpha, 1.0

    def weights(self, idx: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, n = self.z[idx], self.n[idx]
        w = (np.sign(z) * self.l1 - z) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def learn(self, idx: np.ndarray, x: np.ndarray, label: int) -> None:
        w = self.weights(idx)
        error = softmax((x @ w)[None, :])[0]
        error[label] -= 1
        g = x[:, None] * error
        n = self.n[idx]
        self.z[idx] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[idx] = n + g * g


def softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


def fit(
    sample: Sparse,
    languages: list[str],
    idf: np.ndarray,
    l1: float = 0.02,
    l2: float = 0.02,
    epochs: int = 2,
) -> Model:
    """Weights from three quarters of the sample, the temperature from the rest."""
    size, k = len(idf), len(languages)
    x = sample.shares()
    value = x.value * idf[x.idx] * SCALE
    x = x._replace(value=value)
    holds = np.arange(len(x.label)) % 4 == 3
    leader = Leader(size + 1, k, l1, l2, alpha=0.5)
    for epoch in range(epochs):
        # Rows come sorted by label, so they are dealt in another order.
        order = np.random.default_rng(epoch).permutation(np.flatnonzero(~holds))
        for row in order:
            idx, of = x.row(row)
            leader.learn(np.append(idx, size), np.append(of, 1.0), x.label[row])
    w = leader.weights()
    logit = np.column_stack([
        np.bincount(x.of, x.value * w[x.idx, c], len(x.label)) + w[size, c] for c in range(k)
    ])
    temperatures = np.geomspace(0.2, 5, 41)
    label = x.label[holds]
    losses = [
        -np.log(np.maximum(softmax(logit[holds] / t)[np.arange(len(label)), label], 1e-12)).sum()
        for t in temperatures
    ]
    t = float(temperatures[int(np.argmin(losses))]) if len(label) else 1.0
    return Model(languages, w[:size] * idf[:, None] * SCALE, w[size], t)


def learn(docs: DataFrame, rows: int = ROWS) -> Model | None:
    """Learn from documents with a language, at most ``rows`` of each in the mean."""
    spark = docs.sparkSession
    known = docs.filter("lang is not null").filter(~held_out(F.col("doc_id")))
    counts = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()
    if not counts:
        return None
    languages = sorted(x["lang"] for x in counts)
    n = {x["lang"]: x["n"] for x in counts}
    share = spark.createDataFrame(
        [(x, k, min(1.0, rows / n[x])) for k, x in enumerate(languages)],
        "lang string, label int, share double",
    )
    draw = F.pmod(F.xxhash64("doc_id", F.lit("draw")), F.lit(1 << 20)) / (1 << 20)
    drawn = (
        known.select("doc_id", "lang")
        .join(F.broadcast(share), "lang")
        .filter(draw < F.col("share"))
        .select("doc_id", "label")
    )
    found, total = document_frequencies(known)
    idf = np.log((1 + total) / (1 + found)) * (found > 0)
    sample = collect_sample(docs, FEATURES, drawn, 2 * rows * len(languages))
    return fit(sample, languages, idf)


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """A row for each document: the likeliest language and its calibrated probability."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batch: Batch) -> Batch:
        fitted = shared.value
        of = texts(batch)
        lettered = np.array([has_letter(x) for x in of], bool)
        if fitted is None:
            lettered[:] = False
            best, p = np.zeros(len(of), np.int64), np.zeros(len(of))
            names = [UNKNOWN]
        else:
            sums = FEATURES.sums(of, fitted.weights)
            logit = sums[:, :-1] / np.maximum(sums[:, -1:], 1) + fitted.bias
            all_p = softmax(logit / fitted.temperature)
            best, names = all_p.argmax(axis=1), fitted.languages
            p = all_p[np.arange(len(of)), best]
        found = [names[b] if x else UNKNOWN for b, x in zip(best, lettered, strict=True)]
        return pa.record_batch(
            [batch.column("doc_id"), pa.array(found), pa.array(np.where(lettered, p, 0.0))],
            ["doc_id", "lang_pred", "score"],
        )

    return map_batches(docs.select("doc_id", "text"), RESULT, score)
