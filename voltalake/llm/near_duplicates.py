"""Near-duplicate documents by an LSH forest over MinHash signatures.

A text is a set of shingles of ``SHINGLE`` words. Two texts are linked if
``100 * intersection >= SIMILAR * union``; a document's component is everything
that can be reached over links.

1. Documents with equal sets are one class, and only its smallest id goes on.
2. Each class stands in ``TREES`` sorted orders. An order begins with other
   values of its signature; classes that share the first ``DEPTH`` values of an
   order are a region of that tree.
3. First round: each class is compared with the first of its region and with
   its neighbours in the region's sorted order, which have the longest common
   prefixes. Signatures rank these pairs, and each class's ``BEST`` likeliest
   pairs are confirmed on the full sets. Components collapse.
4. Second round: where a region still holds several components, all classes
   outside its largest one are strangers, and their marks are compared with
   every other's in the region, block by block. Of a region with more than
   ``CROWD`` strangers the blocks are dealt out over tasks, so that all its pairs
   are compared as in any other. Likely pairs are confirmed on full sets.

Pairs whose signatures differ too much (an estimate under ``LIKELY``, five
standard deviations below the threshold), whose least hashes do (``DEVIATIONS``
below it) or whose sizes rule a link out are not confirmed. A pair at the threshold
shares a region with probability 1 - (1 - 0.8^4)^24 = 0.999997, whatever the regions'
sizes: none is narrowed for its size. Equal texts are never paired.

Null, empty and blank texts have an empty set and are linked with nothing.
Null ids are linked with nothing and stay. Repeated rows get equal results.
Other columns are ignored. Hashes of 64 bits stand for shingles in sets' sizes,
classes and signatures; links are confirmed on the words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from voltalake.llm.components import components
from voltalake.llm.text import (
    LOWER,
    Batch,
    map_batches,
    mixed,
    packed,
    portions,
    read,
    texts,
    unpacked,
)
from voltalake.session import stage

SHINGLE = 5
SIMILAR = 80  # hundredths
TREES, DEPTH, TAIL = 24, 4, 8
VALUES = TREES * DEPTH
NEIGHBOURS = 2
BEST = 4
CROWD = 4096
BLOCK = 256
DEVIATIONS = 4.5
LIKELY = 0.6
SLICE = 4096
SAMPLE = 192  # least hashes of a set that are kept: smaller sets are kept whole
MARK = ("signature", "sketch", "heads", "sample")
PROFILE = "doc_id long, n_shingles long, set_key binary" + "".join(
    f", {x} binary" for x in MARK
)

_RANDOM = np.random.default_rng(20240501)
XORS = _RANDOM.integers(0, 1 << 32, VALUES, dtype=np.uint32)
FACTORS = _RANDOM.integers(0, 1 << 31, VALUES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def shingle_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Distinct shingles of a text from its words' hashes, in order."""
    if len(hashes) > size:
        out = hashes[: len(hashes) - size + 1]
        for k in range(1, size):
            out = mixed(out) + hashes[k : len(hashes) - size + 1 + k]
    elif len(hashes):
        out = hashes[:1]
        for k in range(1, len(hashes)):
            out = mixed(out) + hashes[k : k + 1]
    else:
        return hashes
    return np.unique(mixed(out))


def shingle_set(words: list[bytes], size: int) -> set[tuple[bytes, ...]]:
    """The same set, of words."""
    if len(words) < size:
        return {tuple(words)} if words else set()
    return set(zip(*(words[k:] for k in range(size)), strict=False))


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """A row of ``VALUES`` minima for each set, none of them empty."""
    x = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    first = np.cumsum([0, *map(len, sets[:-1])])
    out = np.empty((len(sets), VALUES), np.uint32)
    for k in range(VALUES):
        out[:, k] = np.minimum.reduceat((x ^ XORS[k]) * FACTORS[k], first)
    return out


def _marks(sets: list[np.ndarray]) -> Iterator[tuple[bytes, ...]]:
    """For each set: its signature, one byte of each value, a hash of what each tree's
    order begins with, and the set's least hashes."""
    rows = signatures(sets)
    heads = np.zeros((len(sets), TREES), np.uint64)
    for k in range(DEPTH):
        heads = mixed(heads + rows[:, k::DEPTH])
    for x, row, head in zip(sets, rows, heads, strict=True):
        sample = (x[:SAMPLE] >> np.uint64(32)).astype("<u4")
        signed = row.astype("<u4").tobytes()
        yield signed, signed[::4], head.astype("<u4").tobytes(), sample.tobytes()


def profiles(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """Set size, a key of the whole set, and its marks, of each document."""

    def profile(batch: Batch) -> Batch:
        n: list[int] = []
        keys: list[bytes | None] = []
        marks: list[tuple[bytes | None, ...]] = []
        for of in portions(texts(batch)):
            part = read(of, lower=True)
            hashes, cuts = part.hashes(), part.per_text()
            sets = [
                shingle_hashes(hashes[a:b], size)
                for a, b in zip(cuts[:-1], cuts[1:], strict=True)
            ]
            n += map(len, sets)
            keys += [xxhash.xxh128_digest(x.tobytes()) if len(x) else None for x in sets]
            full = [x for x in sets if len(x)]
            found = iter(_marks(full) if full else ())
            marks += [next(found) if len(x) else (None,) * len(MARK) for x in sets]
        columns = [pa.array(x, pa.binary()) for x in zip(*marks, strict=True)]
        ids, sizes = batch.column("doc_id"), pa.array(n, pa.int64())
        return pa.record_batch(
            [ids, sizes, pa.array(keys, pa.binary()), *columns],
            ["doc_id", "n_shingles", "set_key", *MARK],
        )

    return map_batches(docs.select("doc_id", "text"), PROFILE, profile)


def _tree_rows(classes: DataFrame) -> DataFrame:
    """Each class in each tree: the region's key, and the values that follow."""
    circle = F.concat("signature", "signature")
    at = F.col("tree") * (4 * DEPTH) + 1
    return classes.select(
        "id", "n", "signature", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree")
    ).select(
        "id",
        "n",
        "tree",
        F.xxhash64("tree", F.substring(circle, at, F.lit(4 * DEPTH))).alias("region"),
        F.substring(circle, at + 4 * DEPTH, F.lit(4 * TAIL)).alias("tail"),
    )


def _members(classes: DataFrame) -> DataFrame:
    """Rows of regions with several classes, with the region's first class and size."""
    rows = _tree_rows(classes)
    regions = (
        rows.groupBy("region")
        .agg(F.count(F.lit(1)).alias("size"), F.min(F.struct("n", "id")).alias("first"))
        .filter("size > 1")
    )
    return rows.join(regions, "region").select(
        "region",
        "tree",
        "tail",
        "id",
        "n",
        "size",
        F.col("first.id").alias("first_id"),
        F.col("first.n").alias("first_n"),
    )


def _possible(n: Column, m: Column) -> Column:
    """Whether sets of these sizes can be similar."""
    return 100 * F.least(n, m) >= SIMILAR * F.greatest(n, m)


def _ordered(a: Column, b: Column) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _near_pairs(members: DataFrame) -> DataFrame:
    """(a, b): each class with its regions' first classes, and with the neighbours
    before it in sorted order; at most ``NEIGHBOURS + 1`` for each tree.

    A crowded region is dealt out in slices, in each of which it is sorted.
    """
    firsts = members.filter(
        (F.col("id") != F.col("first_id")) & _possible(F.col("n"), F.col("first_n"))
    )
    pairs = firsts.select(F.col("id").alias("a"), F.col("first_id").alias("b"))
    cut = F.when(
        F.col("size") > SLICE,
        F.pmod(F.xxhash64("id"), F.ceil(F.col("size") / SLICE)),
    ).otherwise(0)
    order = Window.partitionBy("region", "slice").orderBy("tail", "id")
    others = members.filter("size > 2").withColumn("slice", cut)
    for k in range(1, NEIGHBOURS + 1):
        others = others.withColumn(f"near{k}", F.lag(F.struct("id", "n"), k).over(order))
    near = others.select(
        "id", "n", F.explode(F.array(*(f"near{k}" for k in range(1, NEIGHBOURS + 1)))).alias("o")
    ).filter(F.col("o").isNotNull() & _possible(F.col("n"), F.col("o.n")))
    near = near.select(F.col("id").alias("a"), F.col("o.id").alias("b"))
    return pairs.unionByName(near).distinct()


def _estimated(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs that are likely enough, with the estimate from the signatures' sketches."""

    def compare(batch: Batch) -> Batch:
        x, y = (
            np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8).reshape(-1, VALUES)
            for k in ("x", "y")
        )
        same = (x == y).mean(axis=1)
        estimate = (same - 1 / 256) / (1 - 1 / 256)
        rows = [batch.column("a"), batch.column("b"), pa.array(estimate)]
        return pa.record_batch(rows, ["a", "b", "estimate"]).filter(pa.array(estimate >= LIKELY))

    one = classes.select(F.col("id").alias("a"), F.col("sketch").alias("x"))
    two = classes.select(F.col("id").alias("b"), F.col("sketch").alias("y"))
    both = pairs.join(one, "a").join(two, "b").select("a", "b", "x", "y")
    return map_batches(both, "a long, b long, estimate double", compare)


def confirmed(pairs: DataFrame, docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """The pairs whose full sets are similar enough.

    Only texts that occur in a pair go on. A text joins its pairs row by row, so
    one with very many partners can be split over tasks.
    """
    ids = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    # The same plan at every size: all texts move once by id, compressed.
    needed = packed(docs).join(ids.hint("merge"), "doc_id", "left_semi")
    needed = needed.dropDuplicates(["doc_id"])
    one = needed.select(F.col("doc_id").alias("a"), F.col("packed").alias("x"))
    two = needed.select(F.col("doc_id").alias("b"), F.col("packed").alias("y"))

    def check(batch: Batch) -> Batch:
        sets: dict[int, set[tuple[bytes, ...]]] = {}
        good = []
        ids = zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True)
        for (a, b), x, y in zip(ids, unpacked(batch, "x"), unpacked(batch, "y"), strict=True):
            if b not in sets:  # rows come sorted by b
                sets = {b: shingle_set(y.translate(LOWER).split(), size)}
            of = shingle_set(x.translate(LOWER).split(), size)
            both = len(of & sets[b])
            good.append(100 * both >= SIMILAR * (len(of) + len(sets[b]) - both))
        kept = pa.record_batch([batch.column("a"), batch.column("b")], ["a", "b"])
        return kept.filter(pa.array(good, pa.bool_()))

    both = pairs.select("a", "b").join(one, "a").join(two, "b").select("a", "b", "x", "y")
    return map_batches(both, "a long, b long", check)


def _best_pairs(pairs: DataFrame) -> DataFrame:
    """The likeliest pairs of each class, the smaller id first."""
    likely = F.reverse(F.array_sort(F.collect_list(F.struct("estimate", "b"))))
    best = pairs.groupBy("a").agg(F.slice(likely, 1, BEST).alias("found"))
    best = best.select("a", F.explode("found.b").alias("b"))
    return best.select(*_ordered(F.col("a"), F.col("b"))).distinct()


def _open_regions(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Rows of regions that hold several components.

    A class outside its region's largest component is a stranger there.
    """
    rows = members.select("region", "tree", "id", "n").join(
        roots.select(F.col("a").alias("id"), F.col("b").alias("root")), "id", "left"
    )
    rows = rows.withColumn("root", F.coalesce("root", "id"))
    regions = (
        rows.groupBy("region", "root")
        .agg(F.count(F.lit(1)).alias("n_root"))
        .groupBy("region")
        .agg(
            F.sum("n_root").alias("all"),
            F.max(F.struct("n_root", "root")).alias("most"),
            F.count(F.lit(1)).alias("roots"),
        )
        .filter("roots > 1")
        .select(
            "region",
            "all",
            F.col("most.root").alias("largest"),
            (F.col("all") - F.col("most.n_root")).alias("strangers"),
        )
    )
    return stage(rows.join(regions, "region"), "open")


def _open_pairs(members: DataFrame, roots: DataFrame, classes: DataFrame) -> DataFrame:
    """Likely pairs of different components that share a region.

    Strangers meet all classes of their region, in blocks of some ``BLOCK`` each,
    whose marks are compared at once. Only pairs that are likely by their
    sketches and by their sets' least hashes become rows, each in the first tree
    that has both in one region. A crowd's blocks of strangers are dealt out in
    shares of some ``CROWD`` strangers, each of which meets the whole region.
    """
    rows = _open_regions(members, roots)
    marked = rows.join(classes.select("id", "sketch", "heads", "sample"), "id")

    shares, cells = F.ceil(F.col("strangers") / CROWD), F.ceil(F.col("all") / CROWD)

    def blocks(of: DataFrame, size: Column, name: str) -> DataFrame:
        part = F.pmod(F.xxhash64("id"), F.ceil(size / BLOCK))
        entry = F.struct("id", "n", "root", "sketch", "heads", "sample")
        return of.groupBy(
            "region", "tree", "largest", shares.alias("shares"), cells.alias("cells"),
            part.alias("part"),
        ).agg(F.collect_list(entry).alias(name))

    def every(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))

    strangers = blocks(marked.filter("root <> largest"), F.col("strangers"), "x").select(
        "region", "tree", "largest", "x", F.pmod("part", "shares").alias("share"),
        every("cells").alias("cell"),
    )
    everyone = blocks(marked, F.col("all"), "y").select(
        "region", "y", F.pmod("part", "cells").alias("cell"), every("shares").alias("share")
    )
    keys = ["region", "share", "cell"]
    both = strangers.join(everyone, keys).select("tree", "largest", "x", "y")

    def compare(batch: Batch) -> Batch:
        trees = batch.column("tree").to_pylist()
        largest = batch.column("largest").to_pylist()
        x, y = _Block(batch.column("x")), _Block(batch.column("y"))
        found: list[np.ndarray] = [np.zeros((2, 0), np.int64)]
        for row, (tree, most) in enumerate(zip(trees, largest, strict=True)):
            ys = y.of(row)
            for k in range(x.of(row).start, x.of(row).stop):
                same = (y.sketch[ys] == x.sketch[k]).mean(axis=1)
                good = (same - 1 / 256) / (1 - 1 / 256) >= LIKELY
                good &= y.root[ys] != x.root[k]
                n, m = x.n[k], y.n[ys]
                good &= 100 * np.minimum(n, m) >= SIMILAR * np.maximum(n, m)
                # Two strangers meet twice.
                good &= (y.root[ys] == most) | (x.id[k] < y.id[ys])
                if tree:
                    good &= ~(y.heads[ys, :tree] == x.heads[k, :tree]).any(axis=1)
                others = np.flatnonzero(good) + ys.start
                others = others[_similar(x.sample[k], [y.sample[j] for j in others])]
                found.append(np.stack([np.full(len(others), x.id[k]), y.id[others]]))
        pairs = np.sort(np.concatenate(found, axis=1), axis=0)
        return pa.record_batch([pa.array(pairs[0]), pa.array(pairs[1])], ["a", "b"])

    return map_batches(both, "a long, b long", compare).distinct()


def _similar(one: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """Which others may be similar to one, by their least hashes.

    Up to the smaller of two ends both samples are whole, so what they share
    there estimates the similarity, with the deviation of a sample of that size;
    sets of less than ``SAMPLE`` shingles are compared whole.
    """
    if not others:
        return np.zeros(0, bool)
    full = np.uint32(0xFFFFFFFF)
    end = np.array([x[-1] if len(x) == SAMPLE else full for x in others])
    end = np.minimum(end, one[-1] if len(one) == SAMPLE else full)
    flat = np.concatenate(others)
    owner = np.repeat(np.arange(len(others)), [len(x) for x in others])
    inside = flat <= end[owner]
    at = np.minimum(np.searchsorted(one, flat), len(one) - 1)
    both = np.bincount(owner, inside & (one[at] == flat), len(others))
    union = np.searchsorted(one, end, "right") + np.bincount(owner, inside, len(others)) - both
    slack = np.where(end == full, 0.01, DEVIATIONS * 0.4 / np.sqrt(np.maximum(union, 1)))
    return both >= (SIMILAR / 100 - slack) * union


class _Block:
    """Lists of classes as arrays."""

    def __init__(self, lists: pa.ListArray):
        self.ends = np.cumsum(lists.value_lengths().to_numpy(False))
        values = lists.flatten()
        self.id, self.n, self.root = (
            values.field(k).to_numpy(False) for k in ("id", "n", "root")
        )
        sketch, heads, sample = (
            values.field(k).to_pylist() for k in ("sketch", "heads", "sample")
        )
        self.sketch = np.frombuffer(b"".join(sketch), np.uint8).reshape(-1, VALUES)
        self.heads = np.frombuffer(b"".join(heads), "<u4").reshape(-1, TREES)
        self.sample = [np.frombuffer(x, "<u4") for x in sample]

    def of(self, row: int) -> slice:
        return slice(int(self.ends[row - 1]) if row else 0, int(self.ends[row]))


def link(docs: DataFrame, size: int = SHINGLE) -> tuple[DataFrame, DataFrame]:
    """Stored profiles of all documents, and (a, b): class and smallest class it reaches."""
    found = stage(profiles(docs, size), "profiles")
    classes = stage(
        found.filter("doc_id is not null and set_key is not null")
        .groupBy("set_key")
        .agg(
            F.min("doc_id").alias("id"),
            F.first("n_shingles").alias("n"),
            *(F.first(x).alias(x) for x in MARK),
        ),
        "classes",
    )
    members = stage(_members(classes), "members")
    first = _best_pairs(_estimated(_near_pairs(members), classes))
    judged = stage(first, "best")
    links = stage(confirmed(judged, docs, size), "confirmed")
    roots = components(links)
    more = _open_pairs(members, roots, classes).join(judged, ["a", "b"], "left_anti")
    more = stage(more, "open-pairs")
    links = links.unionByName(confirmed(more, docs, size))
    return found.join(
        classes.select("set_key", F.col("id").alias("class_id")), "set_key", "left"
    ), components(links)


def near_duplicates(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """A row for each document: set size, class, component, and whether it is the
    component's smallest id."""
    found, roots = link(docs, size)
    joined = found.join(
        roots.select(F.col("a").alias("class_id"), F.col("b").alias("root")), "class_id", "left"
    )
    component = F.coalesce("root", "class_id", "doc_id")
    component = F.when(F.col("doc_id").isNotNull(), component)
    return joined.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
        "class_id",
    )


def without_copies(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """The documents that are their component's smallest id, with all their columns."""
    copies = near_duplicates(docs, size).filter("not kept").select("doc_id").distinct()
    return docs.join(stage(copies, "copies"), "doc_id", "left_anti").select(docs.columns)
