"""Toxicity by non-negative positive-unlabelled learning.

A linear model over words (letters and digits, A-Z in lower case) and their
character n-grams, repeated ones damped, is trained with numpy from confirmed
toxic texts and unlabelled ones. The risk of the negative class is what unlabelled texts show, less the
class prior's share of what toxic texts show, and where that estimate falls
below zero the step goes the other way, so that it is not driven below zero.

Null and empty texts get the score of a text without words. Without confirmed
toxic texts, or without others, all scores are 0. Repeated rows are scored one
by one; other columns are ignored.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltalake.llm.linear import Adam, Features, Sparse, collect_sample, sigmoid
from voltalake.llm.text import ALPHANUMERIC, Batch, held_out, map_batches, texts

TOXIC_ROWS = 2000
UNLABELLED_ROWS = 4000
FEATURES = Features(ALPHANUMERIC, bits=18, sizes=(5,), lower=True, damped=True)
RESULT = "doc_id long, score double, predicted int"


class Model(NamedTuple):
    weights: np.ndarray
    bias: float


def fit(
    toxic: Sparse,
    unlabelled: Sparse,
    prior: float,
    rounds: int = 100,
    l1: float = 1e-3,
    least: float = 0.02,
) -> Model:
    """Minimise the non-negative risk by proximal Adam steps.

    Features in less than a share ``least`` of the toxic texts are left out, as
    too few texts would speak for them, and so are those that are not at least
    twice as frequent in toxic texts.
    """
    size = 1 << FEATURES.bits
    n_p, n_u = len(toxic.label), len(unlabelled.label)
    if not n_p or not n_u or not 0 < prior < 1:
        return Model(np.zeros(size, np.float32), -np.inf)
    has_p = np.bincount(toxic.idx, minlength=size)
    has_u = np.bincount(unlabelled.idx, minlength=size)
    used = (has_p >= max(3, n_p * least)) & (has_p / n_p >= 2 * has_u / n_u)
    toxic, unlabelled = toxic.only(used), unlabelled.only(used)
    of_p, of_u = toxic.of, unlabelled.of
    w, bias = np.zeros(size), np.log(prior / (1 - prior))
    adam, adam_bias = Adam(size, 0.1), Adam(1, 0.1)
    for k in range(rounds):
        adam.rate = adam_bias.rate = 0.1 / np.sqrt(1 + k / 10)
        f_p = np.bincount(of_p, toxic.value * w[toxic.idx], n_p) + bias
        f_u = np.bincount(of_u, unlabelled.value * w[unlabelled.idx], n_u) + bias
        # Logistic loss: toxic as 1 on the positives, as 0 on either set.
        negative = np.logaddexp(0, f_u).mean() - prior * np.logaddexp(0, f_p).mean()
        d_p, d_u = -prior * sigmoid(f_p) / n_p, sigmoid(f_u) / n_u
        if negative < 0:
            d_p, d_u = -d_p, -d_u
        else:
            d_p = d_p - prior * sigmoid(-f_p) / n_p
        g = np.bincount(toxic.idx, toxic.value * d_p[of_p], size) + np.bincount(
            unlabelled.idx, unlabelled.value * d_u[of_u], size
        )
        w = w - adam.step(g)
        w = np.sign(w) * np.maximum(np.abs(w) - l1, 0)
        bias -= float(adam_bias.step(np.array([d_p.sum() + d_u.sum()]))[0])
    return Model(w.astype(np.float32), float(bias))


def learn(
    docs: DataFrame,
    labels: DataFrame,
    toxic_rows: int = TOXIC_ROWS,
    unlabelled_rows: int = UNLABELLED_ROWS,
) -> Model:
    """Learn from at most so many rows, none of them held out.

    The class prior is the toxic share of all labels that may be learnt from.
    """
    known = labels.filter("toxic is not null").filter(~held_out(F.col("doc_id")))
    prior = known.agg(F.avg((F.col("toxic") == 1).cast("int"))).first()[0] or 0.0
    confirmed = known.filter("toxic = 1").select("doc_id", F.lit(1).alias("label"))
    others = docs.select("doc_id", F.lit(0).alias("label")).filter(~held_out(F.col("doc_id")))
    return fit(
        collect_sample(docs, FEATURES, confirmed, toxic_rows),
        collect_sample(docs, FEATURES, others, unlabelled_rows),
        prior,
    )


def score(docs: DataFrame, model: Model) -> DataFrame:
    """A row for each document: how likely it is toxic, and 1 from 0.5 on."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def judge(batch: Batch) -> Batch:
        fitted = shared.value
        p = sigmoid(FEATURES.sums(texts(batch), fitted.weights)[:, 0] + fitted.bias)
        return pa.record_batch(
            [batch.column("doc_id"), pa.array(p), pa.array((p >= 0.5).astype(np.int32))],
            ["doc_id", "score", "predicted"],
        )

    return map_batches(docs.select("doc_id", "text"), RESULT, judge)
