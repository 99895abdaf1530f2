"""Quality classifier by importance resampling.

Hashed word and word-pair counts make one generative model of the target text
(documents labelled good) and one of the raw text (all documents). A document's
log weight is the log of the ratio of the two probabilities (tempered for texts
of more than ``LENGTH`` features); adding a Gumbel
draw (fixed by the document's id and a seed) and keeping the k largest samples
without replacement, in proportion to the weights.

k is the number of documents whose log weight reaches the level that parts good
from bad labelled rows best, or what the caller says.

Null and empty texts have log weight 0, as nothing speaks against them. Ties go
to the smaller doc_id; repeated rows share their fate. Without good labels all
weights are 0. Other columns pass through ``keep`` as they are.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from voltalake.llm.text import Batch, map_batches, mixed, packed, portions, read, texts, unpacked
from voltalake.session import stage

BUCKETS = 1 << 14
# A longer text weighs as if it had so many features, so that a slight tilt of the
# raw model, towards texts with many copies, does not add up over its length.
LENGTH = 50
SEED = 7
SCORES = "doc_id long, log_weight double, key double"
ACCURACY = 10_000
# A clean document lost counts as much as so many poor ones kept.
CLEAN = 50
# Below the level: a Gumbel draw lies under -1.5 in one case of ninety.
MARGIN = 1.5


class Model(NamedTuple):
    """Log ratio of the two models for each bucket."""

    ratio: np.ndarray


def features(of: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words and word pairs, and the text that each belongs to."""
    part = read(of)
    hashes = part.hashes()
    paired = part.text[1:] == part.text[:-1]
    pairs = mixed(hashes[:-1]) + hashes[1:]
    keys = np.concatenate([hashes, pairs[paired]]) % np.uint64(BUCKETS)
    return keys.astype(np.int64), np.concatenate([part.text, part.text[1:][paired]])


def bucket_counts(docs: DataFrame, column: str = "text") -> np.ndarray:
    """How often each bucket occurs in texts, or in texts compressed as ``packed``; a row
    for each bucket and Arrow batch is shuffled."""

    def count(batch: Batch) -> Batch:
        total = np.zeros(BUCKETS, np.int64)
        for part in portions(unpacked(batch) if column == "packed" else texts(batch)):
            total += np.bincount(features(part)[0], minlength=BUCKETS)
        bucket = np.flatnonzero(total)
        return pa.record_batch([pa.array(bucket), pa.array(total[bucket])], ["bucket", "n"])

    rows = map_batches(docs.select(column), "bucket long, n long", count)
    out = np.zeros(BUCKETS)
    for x in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[x["bucket"]] = x["n"]
    return out


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    """The raw model from all documents, the target model from all good ones."""
    good = labels.filter("doc_id is not null and quality = 1").select("doc_id")
    learnt = packed(docs).join(good.hint("merge"), "doc_id", "left_semi")
    target = bucket_counts(learnt, "packed")
    raw = bucket_counts(docs)
    if not target.any():
        return Model(np.zeros(BUCKETS))
    smooth = 1.0
    p = (target + smooth) / (target.sum() + smooth * BUCKETS)
    q = (raw + smooth) / (raw.sum() + smooth * BUCKETS)
    return Model(np.log(p / q))


def _keys(doc_ids: list[int | None], weights: np.ndarray, seed: int) -> np.ndarray:
    """Log weights with a Gumbel draw; a null id draws as 0."""
    ids = np.array([x or 0 for x in doc_ids], np.int64).view(np.uint64)
    bits = mixed(ids * np.uint64(2) + mixed(np.full(1, seed, np.uint64))) >> np.uint64(11)
    uniform = (bits.astype(float) + 0.5) / 2.0**53
    return weights - np.log(-np.log(uniform))


def scores(docs: DataFrame, model: Model, seed: int = SEED) -> DataFrame:
    """(doc_id, log_weight, key) of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batch: Batch) -> Batch:
        weights = _weights(texts(batch), shared.value)
        ids = batch.column("doc_id")
        key = _keys(ids.to_pylist(), weights, seed)
        return pa.record_batch([ids, pa.array(weights), pa.array(key)], SCORE_NAMES)

    return map_batches(docs.select("doc_id", "text"), SCORES, score)


SCORE_NAMES = [x.split(" ")[0] for x in SCORES.split(", ")]


def _weights(of: list[bytes], model: Model) -> np.ndarray:
    out = [np.zeros(0)]
    for part in portions(of):
        idx, text = features(part)
        n = np.bincount(text, minlength=len(part))
        total = np.bincount(text, model.ratio[idx], len(part))
        out.append(total * np.minimum(1, LENGTH / np.maximum(n, 1)))
    return np.concatenate(out)


def level(scored: DataFrame, labels: DataFrame) -> float:
    """The log weight that parts good from bad labelled rows with the best mean recall.

    All labelled rows count, also those learnt from. Of equally good levels the
    lowest is taken, in favour of keeping. Distinct weights are sorted over the whole
    cluster, and what lies below each is summed by sorted part.
    """
    known = labels.filter("doc_id is not null and quality is not null")
    good = F.col("quality") == 1
    counted = (
        scored.select("doc_id", "log_weight")
        .join(known.select("doc_id", "quality"), "doc_id")
        .groupBy("log_weight")
        .agg(F.count_if(good).alias("good"), F.count_if(~good).alias("bad"))
    )
    at = F.monotonically_increasing_id().alias("at")
    ordered = stage(counted.orderBy("log_weight").select("*", at), "levels")
    ordered = ordered.withColumn("part", F.shiftright("at", 33))
    # A row for each task of the sort.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = ordered.groupBy("part").agg(
        F.sum("good").alias("goods"), F.sum("bad").alias("bads"), F.max("log_weight").alias("last")
    )
    n_good, n_bad = parts.agg(F.sum("goods"), F.sum("bads")).first()
    if not n_good or not n_bad:
        return -np.inf
    offsets = parts.select(
        "part", *[F.sum(x).over(before).alias(x) for x in ("goods", "bads")],
        F.max("last").over(before).alias("last"),
    )
    inside = Window.partitionBy("part").orderBy("at")
    above = inside.rowsBetween(Window.unboundedPreceding, -1)

    def below(count: str):
        found = [F.coalesce(x, F.lit(0)) for x in (F.sum(count).over(above), F.col(f"{count}s"))]
        return (found[0] + found[1]).cast("decimal(19,0)")

    # The recalls times both numbers of rows. To cut above all rows is never best.
    gain = below("bad") * F.lit(n_good) - below("good") * F.lit(CLEAN * n_bad)
    cuts = ordered.join(F.broadcast(offsets), "part").select(
        F.coalesce(F.lag("log_weight").over(inside), F.col("last")).alias("under"),
        F.col("log_weight").alias("edge"),
        gain.alias("gain"),
    )
    best = cuts.agg(F.max(F.struct("gain", (-F.col("edge")).alias("lowest"), "under"))).first()[0]
    if best["under"] is None:
        return -np.inf
    return (best["under"] - best["lowest"]) / 2 - MARGIN


class Cut(NamedTuple):
    """Kept are keys above ``key``, and at ``key`` the ids up to ``doc_id``."""

    key: float
    doc_id: int


def top_k(scored: DataFrame, k: int) -> Cut:
    """Where the k-th largest key lies, without sorting the corpus.

    Approximate quantiles bracket it; only the rows in the bracket, a few in
    ``ACCURACY``, are put in order.
    """
    n = scored.count()
    if k >= n:
        return Cut(-np.inf, -(2**63))
    if k <= 0:
        return Cut(np.inf, -(2**63))
    q = 1 - k / n
    near = [max(0.0, q - 2 / ACCURACY), min(1.0, q + 2 / ACCURACY)]
    low, high = scored.agg(F.percentile_approx("key", near, ACCURACY)).first()[0]
    above = scored.filter(F.col("key") > high).count()
    inside = scored.filter(F.col("key").between(low, high)).select("key", "doc_id")
    ranked = inside.orderBy(F.desc("key"), F.asc_nulls_first("doc_id")).limit(max(1, k - above))
    last = ranked.agg(F.min(F.struct("key", (-F.col("doc_id")).alias("id"))).alias("x")).first()[0]
    return Cut(last["key"], -(last["id"] or 0))


def kept(key, doc_id, cut: Cut):
    """Whether a row lies in the sample, as a column."""
    at = (key == cut.key) & (F.coalesce(doc_id, F.lit(0)) <= cut.doc_id)
    return (key > cut.key) | at


def sample(
    docs: DataFrame, labels: DataFrame, k: int | None = None, seed: int = SEED
) -> tuple[Model, DataFrame, Cut]:
    """The model, the stored scores of all documents, and where the sample ends."""
    model = learn(docs, labels)
    scored = stage(scores(docs, model, seed), "weights")
    if k is None:
        k = scored.filter(F.col("log_weight") >= level(scored, labels)).count()
    return model, scored, top_k(scored, k)


def resample(docs: DataFrame, labels: DataFrame, k: int | None = None, seed: int = SEED):
    """A row for each document: log weight, key, and whether it is in the sample."""
    _, scored, cut = sample(docs, labels, k, seed)
    return scored.withColumn("kept", kept(F.col("key"), F.col("doc_id"), cut))


def keep(docs: DataFrame, labels: DataFrame, k: int | None = None, seed: int = SEED) -> DataFrame:
    """The sampled documents with all their columns; texts are scored again, not shuffled."""
    model, _, cut = sample(docs, labels, k, seed)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def choose(batch: Batch) -> Batch:
        ids = batch.column("doc_id").to_pylist()
        key = _keys(ids, _weights(texts(batch), shared.value), seed)
        at = (key == cut.key) & (np.array([x or 0 for x in ids]) <= cut.doc_id)
        return batch.filter(pa.array((key > cut.key) | at))

    return map_batches(docs, docs.schema, choose)
