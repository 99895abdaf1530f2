"""Benchmark decontamination by a prefix-filtered set join.

A benchmark item becomes windows of ``width`` words. Containing a window means
containing all its shingles, so one necessary shingle is enough to find it: the
one that the fewest documents have (the prefix of a set ordered by rarity, for
a containment of 1). Documents are joined on those prefix shingles; a match at
word p of a shingle that lies at word j of a window is kept only if p - j is at
least 0 and p - j + the window's length fits in the document (positional and
length bounds); then the words are compared one by one.

The prefix tokens are held in memory block by block: a block has at most
``BLOCK_BYTES`` of benchmark words, and a larger benchmark takes more passes.
Documents are never shuffled unless there are several blocks.

Null and empty texts have no words and are clean; items without words have no
window and hit nothing. Equal windows of several items hit for each of them.
Repeated document rows are judged one by one.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from itertools import chain

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltalake.llm.text import ALNUM, Batch, map_batches, texts
from voltalake.session import stage

WIDTH = 13
SHINGLE = 2
BLOCK_BYTES = 16 * 1024 * 1024

Words = list[bytes]
Gram = tuple[bytes, ...]
RESULT = (
    "row_id long, doc_id long, n_words long, n_hit long, n_items long, "
    "items_sha256 string, contaminated boolean, items array<long>"
)
FOUND = (
    "row_id long, doc_id long, n_words long, hit array<struct<first:long,last:long>>, "
    "items array<long>"
)


def words(text: bytes) -> Words:
    return text.translate(ALNUM).split()


def shingles(of: Words, size: int = SHINGLE) -> Iterator[Gram]:
    """Runs of ``size`` words; a single word is a run of its own."""
    if len(of) < size:
        return iter([tuple(of)])
    return zip(*(of[k:] for k in range(size)), strict=False)


def window_table(benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """(item_id, window): the words of each window, joined by blanks."""

    def cut(batch: Batch) -> Batch:
        items, windows = [], []
        for item, text in zip(batch.column("item_id").to_pylist(), texts(batch), strict=True):
            of = words(text)
            for k in range(max(1, len(of) - width + 1) if of else 0):
                items.append(item)
                windows.append(b" ".join(of[k : k + width]))
        return pa.record_batch(
            [pa.array(items, pa.int64()), pa.array(windows, pa.binary())], ["item_id", "window"]
        )

    rows = map_batches(benchmark.select("item_id", "text"), "item_id long, window binary", cut)
    return rows.distinct()


def shingle_counts(docs: DataFrame, wanted: Broadcast) -> DataFrame:
    """(shingle, documents): in how many documents each wanted shingle occurs.

    Each task adds up its own documents first, so a shingle that every document
    has costs a row for each Arrow batch.
    """

    def count(batch: Batch) -> Batch:
        pairs, single = wanted.value
        total: Counter[Gram] = Counter()
        for text in texts(batch):
            of = words(text)
            total.update(pairs.intersection(zip(of, of[1:], strict=False)))
            if single:
                total.update((w,) for w in single.intersection(of))
        return pa.record_batch(
            [
                pa.array([b" ".join(g) for g in total], pa.binary()),
                pa.array(total.values(), pa.int64()),
            ],
            ["shingle", "n"],
        )

    rows = map_batches(docs.select("text"), "shingle binary, n long", count)
    return rows.groupBy("shingle").agg(F.sum("n").alias("documents"))


def prefixes(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """(window, offset, items): where in each window its rarest shingle lies."""

    def split(batch: Batch) -> Batch:
        rows = [
            (window, b" ".join(gram), k)
            for window in batch.column("window").to_pylist()
            for k, gram in enumerate(shingles(window.split(b" ")))
        ]
        columns = list(zip(*rows, strict=True)) or [(), (), ()]
        kinds = [pa.binary(), pa.binary(), pa.int32()]
        return pa.record_batch(
            [pa.array(x, k) for x, k in zip(columns, kinds, strict=True)],
            ["window", "shingle", "place"],
        )

    of_window = windows.groupBy("window").agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    parts = map_batches(
        of_window.select("window"), "window binary, shingle binary, place int", split
    )
    rarest = F.min(F.struct(F.coalesce("documents", F.lit(0)), "shingle", "place"))
    prefix = parts.join(counts, "shingle", "left").groupBy("window").agg(rarest.alias("p"))
    return of_window.join(prefix, "window").select(
        "window", F.col("p.place").alias("place"), "items"
    )


def _blocks(windows: DataFrame) -> DataFrame:
    """The windows dealt by hash into blocks of about ``BLOCK_BYTES``."""
    total = windows.agg(F.sum(F.length("window"))).first()[0] or 0
    block = F.pmod(F.xxhash64("window"), F.lit(-(-total // BLOCK_BYTES) or 1))
    return windows.withColumn("block", block)


def _hits(of: list[bytes], index: tuple) -> tuple[list[int], list, list[list[int]]]:
    """Of each text: its words, the runs of words that an index's windows hit, and the items."""
    by_shingle, pairs, single = index
    counts, hits, found = [], [], []
    for text in of:
        in_text = words(text)
        counts.append(len(in_text))
        at: list[tuple[int, Gram]] = []
        if present := pairs.intersection(zip(in_text, in_text[1:], strict=False)):
            two = zip(in_text, in_text[1:], strict=False)
            at += [(p, g) for p, g in enumerate(two) if g in present]
        if present := single.intersection(in_text):
            at += [(p, (w,)) for p, w in enumerate(in_text) if w in present]
        runs: list[tuple[int, int]] = []
        items: set[int] = set()
        for p, gram in at:
            for window, place, owners in by_shingle[gram]:
                first = p - place
                last = first + len(window)
                if first >= 0 and last <= len(in_text) and in_text[first:last] == window:
                    runs.append((first, last))
                    items.update(owners)
        hits.append(_united(runs))
        found.append(sorted(items))
    return counts, hits, found


def _contaminated(n_words: int, hit: list[tuple[int, int]]) -> bool:
    """Whether any word is hit and at least a twentieth of all."""
    n_hit = sum(b - a for a, b in hit)
    return n_hit > 0 and 20 * n_hit >= n_words


def _find(docs: DataFrame, index: Broadcast) -> DataFrame:
    """Hit words and items of one block's windows, as runs and ids, in each document."""

    def search(batch: Batch) -> Batch:
        counts, hits, found = _hits(texts(batch), index.value)
        struct = pa.struct([("first", pa.int64()), ("last", pa.int64())])
        return pa.record_batch(
            [
                batch.column("row_id"),
                batch.column("doc_id"),
                pa.array(counts, pa.int64()),
                pa.array(
                    [[{"first": a, "last": b} for a, b in x] for x in hits], pa.list_(struct)
                ),
                pa.array(found, pa.list_(pa.int64())),
            ],
            ["row_id", "doc_id", "n_words", "hit", "items"],
        )

    return map_batches(docs.select("row_id", "doc_id", "text"), FOUND, search)


def _united(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The same words as disjoint runs in order."""
    out: list[tuple[int, int]] = []
    for first, last in sorted(runs):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(last, out[-1][1]))
        else:
            out.append((first, last))
    return out


def _verdicts(found: DataFrame) -> DataFrame:
    def judge(batch: Batch) -> Batch:
        n_words = batch.column("n_words").to_pylist()
        runs = [
            _united([(x["first"], x["last"]) for x in hit])
            for hit in batch.column("hit").to_pylist()
        ]
        items = [sorted(set(x)) for x in batch.column("items").to_pylist()]
        n_hit = [sum(b - a for a, b in x) for x in runs]
        digest = [
            hashlib.sha256(",".join(sorted(map(str, x))).encode()).hexdigest() for x in items
        ]
        bad = [_contaminated(n, x) for n, x in zip(n_words, runs, strict=True)]
        return pa.record_batch(
            [
                batch.column("row_id"),
                batch.column("doc_id"),
                pa.array(n_words, pa.int64()),
                pa.array(n_hit, pa.int64()),
                pa.array(map(len, items), pa.int64()),
                pa.array(digest),
                pa.array(bad, pa.bool_()),
                pa.array(items, pa.list_(pa.int64())),
            ],
            [x.split(" ")[0] for x in RESULT.split(", ")],
        )

    return map_batches(found, RESULT, judge)


def _indexes(docs: DataFrame, benchmark: DataFrame, width: int) -> list[Broadcast]:
    """The windows by their prefix shingle, block by block."""
    spark = docs.sparkSession
    windows = stage(_blocks(stage(window_table(benchmark, width), "windows")), "blocks")
    last = windows.agg(F.max("block")).first()[0]
    if last is None:
        return [spark.sparkContext.broadcast(({}, frozenset(), frozenset()))]
    out = []
    for block in range(int(last) + 1):
        part = windows.filter(F.col("block") == block)
        texts_of = [bytes(x["window"]) for x in part.select("window").distinct().toLocalIterator()]
        grams = set(chain.from_iterable(shingles(x.split(b" ")) for x in texts_of))
        wanted = spark.sparkContext.broadcast((
            frozenset(g for g in grams if len(g) == SHINGLE),
            frozenset(g[0] for g in grams if len(g) == 1),
        ))
        counts = shingle_counts(docs, wanted)
        by_shingle: dict[Gram, list[tuple[Words, int, list[int]]]] = {}
        for x in prefixes(part, counts).toLocalIterator():
            window = bytes(x["window"]).split(b" ")
            gram = tuple(window[x["place"] : x["place"] + SHINGLE])
            by_shingle.setdefault(gram, []).append((window, x["place"], x["items"]))
        out.append(spark.sparkContext.broadcast((
            by_shingle,
            frozenset(g for g in by_shingle if len(g) == SHINGLE),
            frozenset(g[0] for g in by_shingle if len(g) == 1),
        )))
    return out


def _judged(rows: DataFrame, indexes: list[Broadcast]) -> DataFrame:
    """The verdict on each of ``rows`` (row_id, doc_id, text), whose numbers are stored."""
    if len(indexes) == 1:
        return _verdicts(_find(rows, indexes[0]))
    found = [stage(_find(rows, index), "hits") for index in indexes]
    return _verdicts(
        reduce(DataFrame.unionByName, found).groupBy("row_id", "doc_id").agg(
            F.max("n_words").alias("n_words"),
            F.flatten(F.collect_list("hit")).alias("hit"),
            F.flatten(F.collect_list("items")).alias("items"),
        )
    )


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """A row for each document: its words, hit words, items and verdict.

    A document is contaminated if any word is hit and at least a twentieth of
    its words are. Rows are judged one by one, whatever their ids.
    """
    indexes = _indexes(docs, benchmark, width)
    # A number for each row tells repeated doc_ids apart where blocks meet again.
    rows = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row_id"))
    if len(indexes) > 1:
        rows = stage(rows, "numbered")  # the numbers are made once for all blocks
    return _judged(rows, indexes).drop("row_id")


def clean(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """The documents that are not contaminated, with all their columns.

    Each row goes or stays by its own text: a null id is no exception, and of rows
    that repeat an id one may go and another stay.
    """
    indexes = _indexes(docs, benchmark, width)
    if len(indexes) == 1:
        index = indexes[0]

        def choose(batch: Batch) -> Batch:
            counts, hits, _ = _hits(texts(batch), index.value)
            good = [not _contaminated(n, x) for n, x in zip(counts, hits, strict=True)]
            return batch.filter(pa.array(good, pa.bool_()))

        return map_batches(docs, docs.schema, choose)
    # The columns travel as one, so that none of their names can clash.
    row = F.struct(*docs.columns).alias("row")
    numbered = stage(docs.select(row, F.monotonically_increasing_id().alias("row_id")), "numbered")
    rows = numbered.select("row_id", "row.doc_id", "row.text")
    bad = stage(_judged(rows, indexes).filter("contaminated").select("row_id"), "contaminated")
    return numbered.join(bad, "row_id", "left_anti").select("row.*")
