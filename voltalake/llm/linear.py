"""Hashed features of words and linear scores of whole texts.

A text's features are its words and their character n-grams. All of them are
hashed as arrays, a portion of texts at a time.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltalake.llm.text import K1, Batch, Portion, map_batches, mixed, portions, read, texts

SAMPLE = "label int, idx binary, value binary"


class Features(NamedTuple):
    """How texts become features: which characters make words, ``bits`` of hash,
    character n-gram ``sizes`` (of a word between two marks), and whether the
    word itself counts."""

    members: np.ndarray
    bits: int
    sizes: tuple[int, ...] = ()
    whole: bool = True
    lower: bool = False
    damped: bool = False  # a feature that occurs n times counts log2(1 + n)

    def of_texts(self, of: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All features of some texts, and the number of the text that each belongs to."""
        part = read(of, self.members, self.lower)
        shift = np.uint64(64 - self.bits)
        idx, text = [], []
        if self.whole:
            idx.append(part.hashes() >> shift)
            text.append(part.text)
        if self.sizes:
            owner = np.repeat(
                np.arange(len(of)), np.diff(part.first, append=len(part.values))
            )
            for n in self.sizes:
                at = self._inside(part, n)
                key = np.full(len(at), n, np.uint64)
                for k in range(n):
                    key = key * K1 + part.values[at + k]
                idx.append(mixed(key) >> shift)
                text.append(owner[at])
        return np.concatenate(idx).astype(np.int64), np.concatenate(text)

    @staticmethod
    def _inside(part: Portion, n: int) -> np.ndarray:
        """Where runs of ``n`` characters begin that lie in a marked word."""
        inside, size = part.inside, len(part.inside) - n + 1
        if size <= 0:
            return np.zeros(0, np.int64)
        fits = inside[:size] | inside[n - 1 :]
        for k in range(1, n - 1):
            fits &= inside[k : k + size]
        return np.flatnonzero(fits)

    def counted(self, of: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct features of each text, their texts (in order), and how often they occur."""
        idx, text = self.of_texts(of)
        key, n = np.unique((text << self.bits) | idx, return_counts=True)
        n = np.log2(1 + n) if self.damped else n
        return key & ((1 << self.bits) - 1), key >> self.bits, n

    def sums(self, of: list[bytes], weights: np.ndarray) -> np.ndarray:
        """For each text: sums of each column of weights, and the number of features."""
        table = np.asarray(weights, float).reshape(1 << self.bits, -1)
        out = [np.zeros((0, table.shape[1] + 1))]
        for part in portions(of):
            if self.damped:
                idx, text, n = self.counted(part)
                columns = [np.bincount(text, w[idx] * n, len(part)) for w in table.T]
            else:
                idx, text = self.of_texts(part)
                columns = [np.bincount(text, w[idx], len(part)) for w in table.T]
            out.append(np.column_stack([*columns, np.bincount(text, minlength=len(part))]))
        return np.concatenate(out)


class Sparse(NamedTuple):
    """Rows of sparse features with their labels."""

    label: np.ndarray
    ends: np.ndarray
    idx: np.ndarray
    value: np.ndarray

    def row(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        part = slice(self.ends[k - 1] if k else 0, self.ends[k])
        return self.idx[part], self.value[part]

    @property
    def of(self) -> np.ndarray:
        """The row of each stored feature."""
        return np.repeat(np.arange(len(self.ends)), np.diff(self.ends, prepend=0))

    def only(self, used: np.ndarray) -> Sparse:
        """Without features that are not used."""
        kept = used[self.idx]
        ends = np.append(0, np.cumsum(kept))[self.ends]
        return Sparse(self.label, ends, self.idx[kept], self.value[kept])

    def shares(self) -> Sparse:
        """Each feature's share of its row."""
        total = np.bincount(self.of, self.value, len(self.ends))
        return self._replace(value=self.value / np.maximum(total, 1)[self.of])


def collect_sample(docs: DataFrame, features: Features, labelled: DataFrame, rows: int) -> Sparse:
    """Features of at most ``rows`` labelled documents, the first by a hash of the id.

    ``labelled`` has doc_id and an integer label, or null for a row that is not
    to be learnt from. The ids are bounded by ``rows``, so they are broadcast
    and only sampled texts are turned into features.
    """
    chosen = (
        labelled.filter("doc_id is not null and label is not null")
        .select("doc_id", F.col("label").cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "label")
        .limit(rows)
    )

    def count(batch: Batch) -> Batch:
        idx, value = [], []
        for part in portions(texts(batch)):
            found, text, n = features.counted(part)
            cuts = np.searchsorted(text, np.arange(1, len(part)))
            idx += [x.tobytes() for x in np.split(found.astype(np.int32), cuts)]
            value += [x.tobytes() for x in np.split(n.astype(np.float32), cuts)]
        return pa.record_batch(
            [batch.column("label"), pa.array(idx, pa.binary()), pa.array(value, pa.binary())],
            ["label", "idx", "value"],
        )

    joined = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    table = map_batches(joined.select("label", "text"), SAMPLE, count).toArrow().combine_chunks()
    # The order of rows must not depend on which task came first.
    order = sorted(
        zip(*(table.column(k).to_pylist() for k in ("label", "idx", "value")), strict=True)
    )
    idx = [np.frombuffer(x[1], np.int32) for x in order]
    value = [np.frombuffer(x[2], np.float32) for x in order]
    return Sparse(
        np.array([x[0] for x in order], np.int64),
        np.cumsum([len(x) for x in idx], dtype=np.int64),
        np.concatenate([*idx, np.zeros(0, np.int32)]),
        np.concatenate([*value, np.zeros(0, np.float32)]).astype(float),
    )


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * np.asarray(x, float)))


class Adam:
    """Step sizes from running moments of the gradient."""

    def __init__(self, size: int, rate: float):
        self.m, self.v, self.t, self.rate = np.zeros(size), np.zeros(size), 0, rate

    def step(self, gradient: np.ndarray) -> np.ndarray:
        self.t += 1
        self.m = 0.9 * self.m + 0.1 * gradient
        self.v = 0.999 * self.v + 0.001 * gradient**2
        m, v = self.m / (1 - 0.9**self.t), self.v / (1 - 0.999**self.t)
        return self.rate * m / (np.sqrt(v) + 1e-8)


def platt(logits: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift that turn logits into probabilities, by Newton's method
    on smoothed targets."""
    n1, n0 = labels.sum(), (1 - labels).sum()
    target = np.where(labels == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.column_stack([logits, np.ones(len(logits))])
    w = np.array([1.0, 0.0])
    for _ in range(50):
        p = sigmoid(x @ w)
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, x.T @ (p - target) + 1e-3 * (w - [1.0, 0.0]))
        w = w - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return float(w[0]), float(w[1])
