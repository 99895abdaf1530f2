"""Shards of near equal bytes that keep linked documents together.

Documents with equal texts are linked. Balanced label propagation decides:

1. *Start.* Linked documents are dealt out largest first, to the shard with the
   fewest bytes so far, so that the shards start level.
2. *Rounds.* Documents of one text count, by an aggregate, how many bytes of that
   text each shard holds. A join tells each document the fullest such shard with
   room, and it asks to move there. Requests are summed by shard, target and
   bucket of a hash; those are granted that keep the target within its quota, the
   even share and half a percent, where what moves away makes room. Rounds end
   when nothing moves. A text too large for one shard fills one after the other.
3. *Filling.* Documents without a link are dealt out last, largest first, and
   level the shards: at the end they differ by less than the largest of these, or
   by the half percent where too few of them are left.

The driver gets sums for shards, classes of sizes and buckets, which are bounded
by their numbers and not by the corpus. Sizes below ``EXACT`` are classes of their
own, larger ones differ by less than 0.04 % within a class. Documents meet their
shard by their rank within the class, and their slot is their rank within the
shard; both ranks are counted in parts, so that no class or shard is one task's
work. All of it is built-in DataFrame functions.

Null and empty texts are equal texts of size 1. Rows that repeat an id, or have
none, are documents of their own. Other columns are ignored. An empty table
gives no rows.
"""

from __future__ import annotations

from heapq import heapify, heapreplace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from voltalake.session import stage

SHARDS = 16
ROUNDS = 12
EXACT = 4096
STEPS = 2048  # classes of sizes for each doubling beyond ``EXACT``
BUCKETS = 256
# A text moves as a whole unless what one shard has of it is more than this part
# of a shard; then its documents move one by one.
WHOLE = 64
# A shard takes linked documents up to this part more than its even share.
SLACK = 200
TEXT = ["hash", "size", "text_crc32"]
PLAN = "of long, first long, last long, shard int"


def vertices(docs: DataFrame, parts: int) -> DataFrame:
    """A row for each document, without its text."""
    text = F.coalesce("text", F.lit(""))
    size_class = F.when(F.col("size") < EXACT, F.col("size")).otherwise(
        F.floor(F.log2("size") * STEPS) + EXACT
    )
    return (
        docs.select(
            "doc_id",
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.xxhash64(text).alias("hash"),
            F.monotonically_increasing_id().alias("row"),
        )
        .withColumn("class", size_class)
        .withColumn("part", F.pmod(F.xxhash64("row"), F.lit(parts)))
    )


def ranked(rows: DataFrame, key: str, name: str) -> DataFrame:
    """``rows`` with their rank from 0 within ``key``, counted in parts."""
    counts = stage(rows.groupBy(key, "part").agg(F.count(F.lit(1)).alias("n")), "part-counts")
    before = Window.partitionBy(key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select(key, "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    order = Window.partitionBy(key, "part").orderBy("doc_id", "row")
    placed = rows.withColumn("place", F.row_number().over(order) - 1).join(base, [key, "part"])
    return placed.withColumn(name, F.col("base") + F.col("place")).drop("base", "place")


def deal(classes: list[tuple[int, int, int]], loads: list[int]) -> list[tuple[int, int, int, int]]:
    """(class, first rank, last rank, shard), the largest documents first, each to
    the shard with the fewest bytes. ``classes`` are (class, documents, bytes);
    ``loads`` are the bytes of the shards and are brought up to date.

    A class with very many documents first fills the shards up to one level at once.
    """
    plan = []
    for of, count, total in sorted(classes, key=lambda x: (-x[2] / x[1], x[0])):
        each = max(1, total // count)
        given = [0] * len(loads)
        left = count
        while left >= 4 * len(loads):
            level = (sum(loads) + left * each) // len(loads)
            wanted = [max(0, (level - x) // each) for x in loads]
            scale = max(1.0, sum(wanted) / left)
            for k, n in enumerate(wanted):
                n = int(n / scale)
                given[k] += n
                loads[k] += n * each
                left -= n
            if not any(wanted):
                break
        heap = [(x, k) for k, x in enumerate(loads)]
        heapify(heap)
        for _ in range(left):
            load, k = heap[0]
            given[k] += 1
            loads[k] += each
            heapreplace(heap, (load + each, k))
        rank = 0
        for k, n in enumerate(given):
            if n:
                plan.append((of, rank, rank + n, k))
                rank += n
    return plan


def dealt(rows: DataFrame, loads: list[int]) -> DataFrame:
    """``rows`` with the ``shard`` that ``deal`` gives them."""
    found = rows.groupBy("class").agg(F.count(F.lit(1)), F.sum("size")).collect()
    plan = rows.sparkSession.createDataFrame(deal([tuple(x) for x in found], loads), PLAN)
    rank = F.col("rank")
    # Classes are bounded in number and each has a row for a shard at most.
    return (
        ranked(rows, "class", "rank")
        .join(
            F.broadcast(plan),
            (F.col("class") == F.col("of")) & (rank >= F.col("first")) & (rank < F.col("last")),
        )
        .drop("of", "first", "last", "rank")
    )


def accepted(
    asked: list[tuple[int, int, int, int]], loads: list[int], limit: int
) -> list[tuple[int, int, int]]:
    """(shard, target, bucket) of requests that keep every target within ``limit`` bytes.

    ``asked`` are (bucket, shard, target, bytes), taken in this order. What leaves a
    shard makes room there, so passes go on while they find something. ``loads`` are
    brought up to date.
    """
    out, waiting = [], sorted(asked)
    while waiting:
        refused = []
        for bucket, shard, target, n in waiting:
            if loads[target] + n <= limit:
                loads[target] += n
                loads[shard] -= n
                out.append((shard, target, bucket))
            else:
                refused.append((bucket, shard, target, n))
        if len(refused) == len(waiting):
            break
        waiting = refused
    return out


def requests(placed: DataFrame, room: list[int], share: int, turn: int) -> DataFrame:
    """Rows with the ``target`` that each would move to (null: none) and a ``bucket``."""
    held = placed.groupBy(*TEXT, "shard").agg(F.sum("size").alias("bytes"))
    order = F.struct("bytes", F.xxhash64("hash", "shard").alias("tie"), "shard")
    shards = held.groupBy(*TEXT).agg(F.sort_array(F.collect_list(order), False).alias("shards"))
    rooms = F.array(*[F.lit(x) for x in room])
    at = F.posexplode("shards").alias("at", "own")
    fuller = F.slice("shards", 1, F.col("at"))
    free = F.filter(fuller, lambda x: F.get(rooms, x["shard"]) >= F.col("size"))
    best = F.coalesce(F.get(free, F.lit(0)), F.get(fuller, F.lit(0)))
    moves = (
        shards.filter(F.size("shards") > 1)
        .select(*TEXT, "shards", at)
        .filter("at > 0")
        .select(
            *TEXT,
            F.col("own.shard").alias("shard"),
            best["shard"].alias("target"),
            (F.col("own.bytes") <= share // WHOLE).alias("whole"),
        )
    )
    moves = stage(moves, "moves")
    key = F.when(F.col("whole"), F.xxhash64("hash", F.lit(turn))).otherwise(
        F.xxhash64("row", F.lit(turn))
    )
    return placed.join(moves, [*TEXT, "shard"], "left").withColumn(
        "bucket", F.pmod(key, F.lit(BUCKETS)).cast("int")
    )


def bytes_of(placed: DataFrame, shards: int) -> list[int]:
    loads = [0] * shards
    for x in placed.groupBy("shard").agg(F.sum("size").alias("n")).collect():
        loads[x["shard"]] = x["n"]
    return loads


def propagate(placed: DataFrame, shards: int, share: int) -> DataFrame:
    """Linked documents after the rounds; ``share`` is a shard's even part of all bytes."""
    spark = placed.sparkSession
    limit = share + share // SLACK
    for turn in range(ROUNDS):
        loads = bytes_of(placed, shards)
        room = [max(0, limit - x) for x in loads]
        wishes = stage(requests(placed, room, share, turn), "requests")
        sums = wishes.filter("target is not null").groupBy("bucket", "shard", "target")
        asked = [tuple(x) for x in sums.agg(F.sum("size")).collect()]
        taken = accepted(asked, loads, limit)
        placed = wishes.drop("target", "whole", "bucket")
        if not taken:
            break
        moving = spark.createDataFrame(taken, "shard int, target int, bucket int")
        # At most a row for each pair of shards and bucket.
        moving = F.broadcast(moving.withColumn("moves", F.lit(True)))
        placed = (
            wishes.join(moving, ["shard", "target", "bucket"], "left")
            .withColumn("shard", F.when(F.col("moves"), F.col("target")).otherwise(F.col("shard")))
            .select(placed.columns)
        )
    return stage(placed, "placed")


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every document."""
    parts = max(8, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = stage(vertices(docs, parts), "vertices")
    texts = rows.groupBy(*TEXT).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    texts = stage(texts, "linked-texts")
    total = rows.agg(F.sum("size")).first()[0] or 0
    linked = stage(rows.join(texts, TEXT, "left_semi"), "linked")
    single = rows.join(texts, TEXT, "left_anti")
    placed = propagate(dealt(linked, [0] * shards), shards, -(-total // shards))
    loads = bytes_of(placed, shards)
    filled = dealt(stage(single, "single"), loads)
    columns = ["doc_id", "size", "text_crc32", "row", "part", "shard"]
    everything = stage(placed.select(columns).unionByName(filled.select(columns)), "sharded")
    return ranked(everything, "shard", "slot").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
