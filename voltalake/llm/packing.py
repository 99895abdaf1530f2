"""Best-fit packing planned on the histogram of lengths.

Documents become pieces of at most ``capacity`` tokens. Only the number of
pieces of each length (at most ``capacity`` rows, whatever the corpus) goes to
the driver, where best-fit decreasing works on whole runs of equal pieces and
equal rooms. The plan says for each length which ranks go to which sequences;
each piece takes the slot of its rank within its length.

Null and empty texts are documents of the end token alone. Repeated rows are
packed as often as they occur. Other columns are ignored. An empty table gives
no rows.
"""

from __future__ import annotations

import json
import re
import zlib
from bisect import bisect_left, insort
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from voltalake.llm.text import Batch, map_batches, texts
from voltalake.session import stage

CAPACITY = 1024
END_ID = 2
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
# Pre-tokenization of the byte-level vocabulary (fixed value).
PATTERN = (
    r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
)
# White space of this length is not for the pattern's engine.
LONG_BLANK = 10_000
_LONG_BLANK = re.compile(rf"\s{{{LONG_BLANK}}}")


def _byte_of() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


@lru_cache(maxsize=1)
def encoding(path: str) -> tiktoken.Encoding:
    """Encoder from a byte-level BPE file in the JSON form, one per worker.

    The vocabulary's order is its merge order, so ``tiktoken`` gives the ids that
    ``tokenizers`` gives, special tokens in the text included.
    """
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    special = {x["content"]: x["id"] for x in spec["added_tokens"]}
    byte_of = _byte_of()
    ranks = {
        bytes(byte_of[c] for c in token): rank
        for token, rank in spec["model"]["vocab"].items()
        if token not in special
    }
    return tiktoken.Encoding(
        "packing", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special
    )


@lru_cache(maxsize=1)
def whole_tokenizer(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


def token_ids(path: str, text: str) -> bytes:
    """Ids as little-endian unsigned 32-bit numbers.

    The pattern's engine keeps a stack over a run of white space, which ends the
    task where the run has some hundred thousand characters. Texts with long runs
    go to ``tokenizers``, which gives the same ids at a fifth of the speed.
    """
    if len(text) >= LONG_BLANK and _LONG_BLANK.search(text):
        ids = np.array(whole_tokenizer(path).encode(text, add_special_tokens=False).ids, "<u4")
    else:
        ids = encoding(path).encode_to_numpy(text, allowed_special="all")
    return ids.astype("<u4", copy=False).tobytes()


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID):
    """A row for each piece; a cut document's first piece takes the odd length."""

    def cut(batch: Batch) -> Batch:
        rows: list[tuple[int, int, int, int, int]] = []
        end = end_id.to_bytes(4, "little")
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts(batch), strict=True):
            ids = token_ids(tokenizer, text.decode()) + end
            n = len(ids) // 4
            start = 0
            length = (n - 1) % capacity + 1
            for piece in range(-(-n // capacity)):
                part = ids[4 * start : 4 * (start + length)]
                rows.append((doc_id, piece, start, length, zlib.crc32(part)))
                start, length = start + length, capacity
        names = ["doc_id", "piece", "start", "length", "ids_crc32"]
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        columns = zip(*rows, strict=True)
        return pa.record_batch(
            [pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], names=names
        )

    return map_batches(docs.select("doc_id", "text"), PIECES, cut)


class Slots(NamedTuple):
    """Ranks ``first`` up to ``last`` (not included) of a length fill sequences from
    ``sequence`` on, ``each`` in a sequence, side by side from ``offset``."""

    length: int
    first: int
    last: int
    each: int
    sequence: int
    offset: int


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[Slots]:
    """Best-fit decreasing over counts.

    ``open_runs`` holds runs of sequences with equal room, ordered by room; the
    work grows with the number of lengths and not with the counts.
    """
    slots: list[Slots] = []
    open_runs: list[tuple[int, int, int]] = []  # room, first sequence, sequences
    used = 0
    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            at = bisect_left(open_runs, (length, -1, -1))
            if at < len(open_runs):
                room, first, n = open_runs.pop(at)
            else:
                room, first, n = capacity, used, -(-left // (capacity // length))
                used += n
            each = room // length
            full = min(n, left // each)
            if full:
                slots.append(Slots(length, rank, rank + full * each, each, first, capacity - room))
                _keep(open_runs, room - each * length, first, full)
                rank, left = rank + full * each, left - full * each
            some = min(left, each - 1) if full < n else 0
            if some:
                slots.append(
                    Slots(length, rank, rank + some, some, first + full, capacity - room)
                )
                _keep(open_runs, room - some * length, first + full, 1)
                rank, left = rank + some, left - some
            _keep(open_runs, room, first + full + (some > 0), n - full - (some > 0))
    return slots


def _keep(open_runs: list[tuple[int, int, int]], room: int, first: int, n: int) -> None:
    if room and n:
        insort(open_runs, (room, first, n))


def pack(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID
) -> DataFrame:
    """Pieces with their ``sequence_id`` and ``offset``.

    The rank within a length is the rank within a part of it, by a hash of the
    piece, plus the sizes of the parts before; so a length that a third of all
    pieces have is numbered by as many tasks as the others.
    """
    spark = docs.sparkSession
    parts = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    cut = pieces(docs, tokenizer, capacity, end_id)
    part = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(parts)).cast("int")
    rows = stage(cut.withColumn("part", part), "pieces")
    counts = rows.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    counts = stage(counts, "piece-counts")  # at most capacity x parts rows
    histogram = {
        x["length"]: x["n"] for x in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()
    }
    slots = plan(histogram, capacity)
    schema = "length long, first long, last long, each long, sequence long, at long"
    planned = spark.createDataFrame(slots, schema)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    base = counts.select(
        "length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")
    )
    order = Window.partitionBy("length", "part").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (
        rows.withColumn("place", F.row_number().over(order) - 1)
        .join(base, ["length", "part"])
        .withColumn("rank", F.col("base") + F.col("place"))
    )
    inside = F.col("rank") - F.col("first")
    # The plan's size follows from the capacity alone, so it is broadcast.
    return ranked.join(
        F.broadcast(planned.withColumnRenamed("length", "of")),
        (F.col("length") == F.col("of"))
        & (F.col("rank") >= F.col("first"))
        & (F.col("rank") < F.col("last")),
    ).select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        (F.col("sequence") + F.floor(inside / F.col("each"))).cast("long").alias("sequence_id"),
        (F.col("at") + inside % F.col("each") * F.col("length")).cast("long").alias("offset"),
    )
