"""Quality rules: exact base counts, and a calibrated logistic regression.

Words are runs of anything but white space (blank, and bytes 9 to 13). The
regression reads hashed words and their character n-grams as shares of the
text, learns from at most ``rows`` labelled documents, and is calibrated on a
quarter of them that it has not seen. Texts are scored in Arrow batches against
fixed thresholds.

A null text has no words; such texts, and all of fewer than ``MIN_WORDS``
words, fail the base rules. Without labels of both kinds the score is 0.5 for
all and only the base rules decide. Repeated rows are judged one by one; other
columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from voltalake.llm.linear import Adam, Features, Sparse, collect_sample, platt, sigmoid
from voltalake.llm.text import BLANKS, NOT_BLANK, Batch, grams, map_batches, texts

SAMPLE_ROWS = 4000
MIN_WORDS = 20
MAX_REPEATED = 30  # hundredths of the words
THRESHOLD = 0.5
SYMBOLS = b"#*$%&|<>"
WINDOW = 8
FEATURES = Features(NOT_BLANK, bits=18, sizes=(2, 3))
RESULT = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, base_failed boolean, score double, kept boolean"
)


def repeated_words(words: list[bytes]) -> int:
    """Words covered by windows of ``WINDOW`` words that occur twice or more."""
    if len(words) <= WINDOW:
        return 0
    # The words' hashes are compared within this text alone.
    hashes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    keys = grams(hashes, WINDOW)
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    if not same.any():
        return 0
    starts = order[np.append(same, False) | np.append(False, same)]
    edges = np.bincount(starts, minlength=len(words) + 1) - np.bincount(
        starts + WINDOW, minlength=len(words) + 1
    )
    return int((np.cumsum(edges) > 0).sum())


def base_counts(text: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    words = text.split()
    lines = [line for line in text.split(b"\n") if line.strip(BLANKS)]
    return (
        len(words),
        len(text.translate(None, BLANKS).decode()),
        len(text) - len(text.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


class Model(NamedTuple):
    weights: np.ndarray
    slope: float
    shift: float


def fit(sample: Sparse, rounds: int = 60, l2: float = 1e-6) -> Model:
    """Class-weighted logistic regression; every fourth row calibrates."""
    size = 1 << FEATURES.bits
    x = sample.shares()
    holds = np.arange(len(x.label)) % 4 == 3
    y = (x.label == 1).astype(float)
    if len(set(y[~holds])) < 2 or len(set(y[holds])) < 2:
        return Model(np.zeros(size), 0.0, 0.0)
    weight = np.where(y == 1, 0.5 / y[~holds].sum(), 0.5 / (1 - y[~holds]).sum()) * ~holds
    w, adam, of = np.zeros(size), Adam(size, 2.0), x.of
    for _ in range(rounds):
        logit = np.bincount(of, x.value * w[x.idx], len(y))
        error = (sigmoid(logit) - y) * weight
        w -= adam.step(np.bincount(x.idx, x.value * error[of], size) + l2 * w)
    logit = np.bincount(of, x.value * w[x.idx], len(y))
    return Model(w.astype(np.float32), *platt(logit[holds], y[holds]))


def learn(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Model:
    """Fit on at most ``rows`` labelled documents."""
    wanted = labels.selectExpr("doc_id", "quality as label")
    return fit(collect_sample(docs, FEATURES, wanted, rows))


def judge(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """A row for each document: base counts, score, and whether it is kept."""
    spark: SparkSession = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)

    def score(batch: Batch) -> Batch:
        fitted = shared.value
        of = texts(batch)
        counts = np.array([base_counts(x) for x in of], np.int64).reshape(-1, 5)
        failed = (counts[:, 0] < MIN_WORDS) | (
            100 * counts[:, 4] > MAX_REPEATED * counts[:, 0]
        )
        sums = FEATURES.sums(of, fitted.weights)
        logit = sums[:, 0] / np.maximum(sums[:, 1], 1)
        p = sigmoid(fitted.slope * logit + fitted.shift)
        columns = [batch.column("doc_id"), *map(pa.array, counts.T), pa.array(failed), pa.array(p)]
        kept = ~failed & (p >= threshold)
        names = [x.split(" ")[0] for x in RESULT.split(", ")]
        return pa.record_batch([*columns, pa.array(kept)], names)

    return map_batches(docs.select("doc_id", "text"), RESULT, score)
