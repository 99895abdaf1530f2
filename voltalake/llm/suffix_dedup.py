"""Removal of repeated substrings by prefix-free parsing.

Every byte covered by a string of ``MATCH`` bytes that also starts in a document
with a smaller id goes. Texts are taken as UTF-8 bytes and judged as they came.

1. *Parse.* A rolling hash triggers phrase ends; a phrase reaches ``MATCH - 1``
   bytes into the next one, so each string of ``MATCH`` bytes starts in exactly
   one phrase and lies in it whole, and equal content is cut alike.
2. *Dictionary.* Equal phrases meet by their hash. All but the one in the
   smallest document are repeats as a whole, and only distinct phrases go on:
   highly repetitive text costs one row for each phrase.
3. *Candidates.* In distinct phrases each string of ``MATCH`` bytes, that is each
   suffix of a phrase cut to that length, is known by its least hashed gram of
   ``GRAM`` bytes. Neighbours with one gram are a piece, a phrase in small: equal
   pieces meet by their hash, and only distinct ones go on, if their gram occurs in
   another content too.
4. *Order.* The suffixes are put in order so that equal ones stand together, first
   by each task, which keeps only those in its smallest document, then by a shuffle
   of those. The parse gives each its document; all but those in the smallest are
   repeats.

The order is by 64-bit hashes of the cut suffixes rather than by their bytes: only
whether two suffixes agree in ``MATCH`` bytes is asked, never which is smaller, and
their bytes would be six times as much to shuffle. So the suffix array of dictionary
and parse is there as an order of those suffixes that matter; it is not stored.
A phrase, gram or string that very many documents share reaches its key's task once
for each ``CHUNK`` strings of a task.

Null and empty texts have nothing to remove. Rows with a null id are never
matched and stay whole. Rows that repeat an id must repeat the text too; they
do not match each other and get equal results. Other columns pass through
``without_repeats`` as they are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from voltalake.llm.text import (
    K1,
    K2,
    Batch,
    compressed,
    map_batches,
    map_tasks,
    mixed,
    packed,
    portions,
    powers,
    texts,
    unpacked,
)
from voltalake.session import stage

MATCH = 50
GRAM = 24  # a multiple of 8
PHRASE = 128  # mean length
CHUNK = 250_000  # keys or strings a task puts in order at a time
PORTION = 1 << 17  # bytes of texts that are parsed at a time; a long text stays whole
OUTPUT = 1 << 16  # rows of a batch that goes back to Spark
SLICE = 500  # documents cut at a time
KEYS = "key long, content long, doc_id long, state byte"
STRINGS = "key long, doc_id long, first int, last int"
SHARED, SURE = 1, 2  # states of keys
RESULT = (
    "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
)

_SCRAMBLED = mixed(np.arange(1, 257, dtype=np.uint64) * K1)


class Parse(NamedTuple):
    """Strings of ``MATCH`` bytes of several texts, by where they start."""

    data: bytes
    first: np.ndarray  # where each text begins
    starts: np.ndarray
    text: np.ndarray  # the text of each string
    gram: np.ndarray  # its least gram
    phrase: np.ndarray  # the number of its phrase
    keys: np.ndarray  # of phrases
    opens: np.ndarray  # the first string of each phrase


def _words(data: bytes) -> np.ndarray:
    """The eight bytes from each place on, as a number."""
    out = np.empty(len(data) - 7, np.uint64)
    for k in range(8):
        part = np.frombuffer(data, np.uint64, offset=k, count=(len(data) - k) // 8)
        out[k::8] = part
    return out


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each run of ``width`` values."""
    n = 1
    out = x
    while 2 * n <= width:
        out = np.minimum(out[:-n], out[n:])
        n *= 2
    return np.minimum(out[: len(x) - width + 1], out[width - n :]) if n < width else out


def _sums(data: bytes) -> np.ndarray:
    """Running sums for the hash of any part of the data."""
    power, _ = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_SCRAMBLED[np.frombuffer(data, np.uint8)] * power[:-1], out=total[1:])
    return total


def _hashed(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    _, inverse = powers(len(sums))
    return mixed((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def parse(of: list[bytes]) -> Parse:
    data = b"".join(of)
    sizes = np.fromiter(map(len, of), np.int64, len(of))
    first = np.cumsum(sizes) - sizes
    none = np.zeros(0, np.int64)
    if not len(sizes) or sizes.max() < MATCH:
        empty = np.zeros(0, np.uint64)
        return Parse(data, first, none, none, empty, none, empty, none)
    n = np.maximum(sizes - MATCH + 1, 0)
    text = np.repeat(np.arange(len(of)), n)
    starts = np.arange(len(text)) + np.repeat(first - (np.cumsum(n) - n), n)
    words = _words(data)
    rolled = mixed(words)
    grams = rolled[: len(data) - GRAM + 1]
    for k in range(8, GRAM, 8):
        grams = mixed(grams * K2 + words[k : k + len(grams)])
    gram = _least(grams, MATCH - GRAM + 1)[starts]
    opens = rolled[starts] >> np.uint64(40) & np.uint64(PHRASE - 1) == 0
    opens[0] = True
    opens[1:] |= text[1:] != text[:-1]
    phrase = np.cumsum(opens) - 1
    opens = np.flatnonzero(opens)
    last = np.append(opens[1:], len(starts)) - 1
    keys = _hashed(_sums(data), starts[opens], starts[last] + MATCH)
    return Parse(data, first, starts, text, gram, phrase, keys, opens)


def _phrase_key(x: np.ndarray) -> np.ndarray:
    return (x & ~np.uint64(3)).view(np.int64)


def _piece_key(x: np.ndarray) -> np.ndarray:
    return (x & ~np.uint64(3) | np.uint64(2)).view(np.int64)


def _gram_key(x: np.ndarray) -> np.ndarray:
    return (x | np.uint64(1)).view(np.int64)


class Pieces(NamedTuple):
    """Neighbouring strings of a phrase with one gram."""

    first: np.ndarray  # number of the first string
    sizes: np.ndarray
    gram: np.ndarray  # keys
    content: np.ndarray


def pieces(found: Parse, sums: np.ndarray) -> Pieces:
    first = _begin(found.phrase, found.gram)
    ends = np.append(first[1:], len(found.starts))
    content = _hashed(sums, found.starts[first], found.starts[ends - 1] + MATCH)
    return Pieces(first, ends - first, _gram_key(found.gram[first]), _piece_key(content))


def _heads(*columns: np.ndarray) -> np.ndarray:
    """Whether any of the columns changes."""
    flag = np.zeros(len(columns[0]), bool)
    flag[:1] = True
    for x in columns:
        flag[1:] |= x[1:] != x[:-1]
    return flag


def _begin(*columns: np.ndarray) -> np.ndarray:
    """Where any of the columns changes."""
    return np.flatnonzero(_heads(*columns))


def _keys(batches: Iterator[Batch]) -> Iterator[Batch]:
    """Phrases and grams of each document; of equal ones only the first asks.

    A gram comes with the content of its piece. Of equal phrases or pieces at hand
    the smallest document's row is shuffled; the others are sure repeats. A gram of
    several contents in several documents is marked as shared.
    """
    rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    size = 0
    for batch in batches:
        ids = np.array(batch.column("doc_id").to_pylist(), np.int64)
        at = 0
        for of in portions(_each(batch.column("text")), PORTION):
            found = parse(of)
            own = ids[at : at + len(of)]
            at += len(of)
            if not len(found.starts):
                continue
            cut = pieces(found, _sums(found.data))
            phrase = _phrase_key(found.keys)
            rows.append((phrase, np.zeros(len(phrase), np.int64), own[found.text[found.opens]]))
            rows.append((cut.gram, cut.content, own[found.text[cut.first]]))
            size += len(phrase) + len(cut.gram)
            if size >= CHUNK:
                yield from _sliced(_asked(rows))
                size = 0
    if rows:
        yield from _sliced(_asked(rows))


def _sliced(batch: Batch) -> Iterator[Batch]:
    """The batch in parts, as each is held once more on its way to Spark."""
    for k in range(0, batch.num_rows, OUTPUT):
        yield batch.slice(k, OUTPUT)


def _joined(parts: list[tuple[np.ndarray, ...]], width: int) -> list[np.ndarray]:
    """Each column of the parts in one array. The list is emptied, so that no column is
    held twice."""
    columns = [[x[k] for x in parts] for k in range(width)]
    parts.clear()
    out = []
    for k in range(width):
        out.append(np.concatenate(columns[k] or [np.zeros(0, np.int64)]))
        columns[k] = []
    return out


def _each(column: pa.Array) -> Iterator[bytes]:
    """UTF-8 bytes of texts, one at a time; null counts as empty."""
    for x in column:
        yield (x.as_py() or "").encode()


def _asked(rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Batch:
    """Keys of some documents by ``KEYS``; the list is emptied."""
    key, content, doc = _joined(rows, 3)
    order = np.lexsort((doc, content, key))
    # One at a time, so that no two columns are held twice.
    key = key[order]
    content = content[order]
    doc = doc[order]
    del order
    distinct = _heads(key, content, doc)
    key = key[distinct]
    content = content[distinct]
    doc = doc[distinct]
    first = _heads(key, content)
    heads = _begin(key)
    sizes = np.diff(np.append(heads, len(key)))
    least = doc[first][np.cumsum(first) - 1]  # of the same content
    apart = (content != np.repeat(content[heads], sizes)) & (least != np.repeat(doc[heads], sizes))
    shared = np.repeat(np.maximum.reduceat(apart, heads), sizes) if len(heads) else apart
    repeat = ~first
    key[repeat & (content != 0)] = content[repeat & (content != 0)]
    state = (shared * SHARED + repeat * SURE).astype(np.int8)
    columns = (key, content, doc, state)
    return pa.record_batch(list(map(pa.array, columns)), _names(KEYS))


def _names(schema: str) -> list[str]:
    return [x.split(" ")[0] for x in schema.split(", ")]


def _grouped(batches: Iterator[Batch]) -> Iterator[pa.Table]:
    """Sorted rows in tables that never part a key."""
    held: list[Batch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        table = pa.Table.from_batches(held).combine_chunks()
        key = table.column("key").to_numpy()
        cut = int(np.searchsorted(key, key[-1]))
        if cut:
            yield table.slice(0, cut)
        held = table.slice(cut).to_batches()
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _settled(batches: Iterator[Batch]) -> Iterator[Batch]:
    """(doc_id, key) of phrases and pieces that a smaller document has, and of grams
    with several contents in several documents. A content has a row for each task and
    batch at most, but for those that are sure already."""
    for table in _grouped(batches):
        key, content, doc, state = (table.column(k).to_numpy() for k in _names(KEYS))
        shared, sure = state & SHARED > 0, state & SURE > 0
        heads = _begin(key)
        sizes = np.diff(np.append(heads, len(key)))
        first = _heads(key, content)
        least = doc[first][np.cumsum(first) - 1]
        apart = content != np.repeat(content[heads], sizes)
        apart &= least != np.repeat(doc[heads], sizes)
        several = np.repeat(np.maximum.reduceat(shared | apart, heads), sizes)
        repeat = sure | (doc > least)
        out = repeat | several & (key & 1 == 1)
        key = np.where(repeat & ~sure & (content != 0), content, key)
        yield pa.record_batch([pa.array(doc[out]), pa.array(key[out])], ["doc_id", "key"])


def _own(text: np.ndarray, key: np.ndarray) -> np.ndarray:
    """One number for a text of the portion and a key."""
    return mixed(key.view(np.uint64) + text.astype(np.uint64) * K2)


def _runs(doc: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, ...]:
    """Adjoining places of a document as (doc, first, last), the last not included."""
    order = np.lexsort((place, doc))
    doc, place = doc[order], place[order]
    heads = _begin(doc, place - np.arange(len(place)))
    ends = np.append(heads[1:], len(place))
    return doc[heads], place[heads], place[ends - 1] + 1 if len(place) else place


class _Suffixes:
    """Strings of a task that wait to be put in order, in arrays of bounded size."""

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.whole: list[tuple[np.ndarray, ...]] = []
        self.open: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def add(self, ids: np.ndarray, found: Parse, allowed: np.ndarray) -> None:
        """Strings of a portion: those of phrases and pieces that a smaller document has
        are repeats; of the others those wait whose gram is shared."""
        sums = _sums(found.data)
        cut = pieces(found, sums)
        text = found.text[cut.first]
        repeats = np.isin(_own(found.text[found.opens], _phrase_key(found.keys)), allowed)
        repeats = repeats[found.phrase[cut.first]] | np.isin(_own(text, cut.content), allowed)
        shared = ~repeats & np.isin(_own(text, cut.gram), allowed)
        whole = np.repeat(repeats, cut.sizes)
        doc, place = ids[found.text], found.starts - found.first[found.text]
        runs = _runs(doc[whole], place[whole])
        self.whole.append(runs)
        shared = np.repeat(shared, cut.sizes)
        starts = found.starts[shared]
        key = _hashed(sums, starts, starts + MATCH)
        self.open.append((key.view(np.int64), doc[shared], place[shared]))
        self.size += len(starts) + len(runs[0])

    def take(self) -> Batch:
        """All of them by ``STRINGS``: of equal strings those that are not in the smallest
        document here are sure repeats, and only the others ask elsewhere."""
        key, doc, place = _joined(self.open, 3)
        order = np.lexsort((doc, key))
        heads = _begin(key[order])
        least = np.repeat(doc[order][heads], np.diff(np.append(heads, len(order))))
        sure = np.zeros(len(order), bool)
        sure[order] = doc[order] > least
        del order, heads, least
        self.whole.append(_runs(doc[sure], place[sure]))
        done, first, last = _joined(self.whole, 3)
        key = key[~sure]
        doc = doc[~sure]
        place = place[~sure]
        self.clear()
        # Sure ones are dealt out too, by a number of their own, and have an end.
        mark = _own(first, done).view(np.int64)
        last = np.append(last, np.zeros(len(key), np.int64))
        return pa.record_batch(
            [
                pa.array(np.append(mark, key)),
                pa.array(np.append(done, doc)),
                pa.array(np.append(first, place).astype(np.int32)),
                pa.array(last.astype(np.int32), mask=np.arange(len(last)) >= len(mark)),
            ],
            _names(STRINGS),
        )


def _candidates(batches: Iterator[Batch]) -> Iterator[Batch]:
    """The strings of documents with the phrases and grams that they are to look for."""
    held = _Suffixes()
    for batch in batches:
        batch = batch.filter(batch.column("keys").is_valid())
        ids = np.array(batch.column("doc_id").to_pylist(), np.int64)
        lists = batch.column("keys")
        at = 0
        coder = zstandard.ZstdDecompressor()
        for of in portions((coder.decompress(x.as_py()) for x in batch.column("packed")), PORTION):
            found = parse(of)
            listed = lists.slice(at, len(of))
            owner = np.repeat(np.arange(len(of)), listed.value_lengths().to_numpy(False))
            allowed = _own(owner, listed.flatten().to_numpy(False))
            own = ids[at : at + len(of)]
            at += len(of)
            if len(found.starts):
                held.add(own, found, allowed)
            if held.size >= CHUNK:
                yield from _sliced(held.take())
    yield from _sliced(held.take())


def repeats(docs: DataFrame, carried: DataFrame | None = None) -> DataFrame:
    """(doc_id, first, last): runs of starts of strings that a smaller document has.

    ``carried`` are the documents with ``packed`` texts, if the caller has them too:
    both joins by id then use one shuffle of them.
    """
    carried = packed(docs) if carried is None else carried
    docs = docs.filter("doc_id is not null").select("doc_id", "text")
    keys = map_tasks(docs, KEYS, _keys)
    sure = F.col("state").bitwiseAND(F.lit(SURE)) > 0
    dealt = keys.repartition(F.when(sure, F.col("doc_id")).otherwise(F.col("key")))
    ordered = dealt.sortWithinPartitions("key", "content", "doc_id")
    settled = map_tasks(ordered, "doc_id long, key long", _settled)
    # A document has at most one key for each of its bytes.
    listed = stage(settled.groupBy("doc_id").agg(F.collect_set("key").alias("keys")), "keys")
    strings = map_tasks(carried.join(listed, "doc_id", "left"), STRINGS, _candidates)
    placed = strings.withColumn("least", F.min("doc_id").over(Window.partitionBy("key")))
    return placed.filter("last is not null or doc_id > least").select(
        "doc_id", "first", F.coalesce("last", F.col("first") + 1).alias("last")
    )


def _cut(text: bytes, first: np.ndarray, last: np.ndarray) -> tuple[int, int, bytes]:
    """Removed bytes, maximal runs of them, and what is left."""
    if not len(first):
        return 0, 0, text
    edges = np.zeros(len(text) + 1, np.int64)
    np.add.at(edges, np.minimum(first, len(text)), 1)
    np.add.at(edges, np.minimum(last + MATCH - 1, len(text)), -1)
    gone = np.cumsum(edges[:-1]) > 0
    spans = int(np.diff(gone.astype(np.int8), prepend=0).clip(0).sum())
    return int(gone.sum()), spans, np.frombuffer(text, np.uint8)[~gone].tobytes()


def _all_cut(batch: Batch) -> Iterator[tuple[bytes, tuple[int, int, bytes]]]:
    """Each text of the batch, and what ``_cut`` makes of it."""
    runs = batch.column("runs")
    sizes = np.append(0, np.cumsum(runs.value_lengths().fill_null(0).to_numpy(False)))
    items = runs.flatten()
    first, last = (items.field(k).to_numpy(False) for k in (0, 1))
    for k, text in enumerate(unpacked(batch)):
        part = slice(sizes[k], sizes[k + 1])
        yield text, _cut(text, first[part], last[part])


def _in_slices(function: Callable[[Batch], Batch]) -> Callable:
    """The function on some documents at a time, as what it gives is held with what it got."""

    def run(batches: Iterator[Batch]) -> Iterator[Batch]:
        for batch in batches:
            for k in range(0, batch.num_rows, SLICE):
                yield function(batch.slice(k, SLICE))

    return run


def deduplicated(docs: DataFrame) -> DataFrame:
    """A row for each document: bytes, removed bytes, spans, and what is kept."""
    carried = packed(docs)
    listed = repeats(docs, carried).groupBy("doc_id").agg(
        F.collect_list(F.struct("first", "last")).alias("runs")
    )

    def cut(batch: Batch) -> Batch:
        of, rows = zip(*_all_cut(batch), strict=True)
        return pa.record_batch(
            [
                batch.column("doc_id"),
                pa.array(map(len, of), pa.int64()),
                pa.array([x[0] for x in rows], pa.int64()),
                pa.array([x[1] for x in rows], pa.int64()),
                pa.array([hashlib.sha256(x[2]).hexdigest() for x in rows], pa.string()),
                pa.array([x[2] for x in rows], pa.binary()),
            ],
            _names(RESULT),
        )

    joined = carried.join(listed, "doc_id", "left").select("doc_id", "packed", "runs")
    return map_tasks(joined, RESULT, _in_slices(cut))


def without_repeats(docs: DataFrame) -> DataFrame:
    """The documents with what is kept as their text, and ``n_chars`` (if any) to match.

    A character that a cut leaves in part goes whole.
    """
    # The columns travel as one, so that none of their names can clash.
    row = F.struct(*(c for c in docs.columns if c != "text")).alias("row")
    boxed = docs.select("doc_id", "text", F.col("text").isNull().alias("blank"), row)

    def pack(batch: Batch) -> Batch:
        small = compressed(texts(batch))
        columns = [batch.column("doc_id"), small, batch.column("blank"), batch.column("row")]
        return pa.record_batch(columns, ["doc_id", "packed", "blank", "row"])

    kind = boxed.schema["row"].dataType.simpleString()
    rows = map_batches(boxed, f"doc_id long, packed binary, blank boolean, row {kind}", pack)
    listed = repeats(docs, rows).groupBy("doc_id").agg(
        F.collect_list(F.struct("first", "last")).alias("runs")
    )

    def cut(batch: Batch) -> Batch:
        kept = [x[2].decode(errors="ignore") for _, x in _all_cut(batch)]
        blank = batch.column("blank").to_pylist()
        kept = [None if x else y for x, y in zip(blank, kept, strict=True)]
        return pa.record_batch([pa.array(kept, pa.string()), batch.column("row")], ["text", "row"])

    joined = rows.join(listed, "doc_id", "left").select("packed", "blank", "row", "runs")
    done = map_tasks(joined, f"text string, row {kind}", _in_slices(cut))
    columns = {
        "text": F.col("text"),
        "n_chars": F.length("text").cast(docs.schema["n_chars"].dataType)
        if "n_chars" in docs.columns
        else None,
    }
    return done.select(
        *(columns.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns)
    )
