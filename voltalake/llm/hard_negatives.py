"""Hard negatives by threshold joins of anchors with all vectors.

An anchor's positives are the ``positives`` other rows of its label with the
highest inner products. For each positive with score ``s`` its negatives are the
``negatives`` best rows of other labels with a score from ``LOW`` to ``HIGH``
percent of ``s``.

Both searches are threshold joins. Rows are dealt into cells of about ``CELL``
rows and anchors into blocks of about ``BLOCK``; each block meets each cell (in
the first search only those of its label) once, and the best of all cells are
kept. Within a cell:

1. *Index.* Dimensions go from the most to the least energy. A row is in the
   inverted lists of its first dimensions only: those from which on the norm of
   its rest times that of the longest anchor's rest stays below the lowest
   threshold are left out.
2. *Accumulation.* Lists add partial scores, a few dimensions at a time. A row
   goes as soon as no anchor's partial score plus the product of the remaining
   norms reaches that anchor's threshold.
3. *Verification.* Pairs that could still reach the threshold get their exact
   score, in whole numbers.
4. *Lowering.* Where a window is not filled by what lies above the threshold, it
   is lowered, for these anchors only, down to the window's lower end.

Rows with a null id, label or vector, or a component that is null or not finite
take no part. Components are floors of ``SCALE`` times the value and saturate at
2**27 in size; shorter vectors count as filled up with zeros. Rows that repeat an
id are rows of their own: each is an anchor, and a copy of an anchor is one of
its positives. Ties go by the smaller id. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from voltalake.session import stage

SCALE = 256
LARGEST = 1 << 27
LOW, HIGH = 50, 95
CELL = 4096
BLOCK = 2048
TILE = 256  # anchors that a task looks at together
STEP = 16  # dimensions added at a time
EXACT = float(1 << 53)
NEAR = "anchor_row long, anchor_id long, positive_id long, score long"
FAR = (
    "anchor_row long, place int, anchor_id long, positive_id long, positive_score long, "
    "negative_id long, negative_score long"
)


class Pairs(NamedTuple):
    """Pairs of an anchor and a row with their score, by anchor, then the best first."""

    anchor: np.ndarray
    row: np.ndarray
    score: np.ndarray


def vectors(rows: DataFrame) -> DataFrame:
    """(row, vec_id, label, vector) of the rows that take part."""
    usable = F.forall(
        "embedding",
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))),
    )

    def whole(x):
        limit = float(LARGEST)
        scaled = F.greatest(F.least(x.cast("double") * SCALE, F.lit(limit)), F.lit(-limit))
        return F.floor(scaled).cast("int")

    taken = rows.filter("vec_id is not null and label is not null").filter(usable)
    return taken.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        F.transform("embedding", whole).alias("vector"),
    )


def shifted(rows: DataFrame, every: int = 7, labels: int = 10) -> DataFrame:
    """The test corpus' labels: where ``every`` divides the id, the next label."""
    moved = F.when(F.col("vec_id") % every == 0, (F.col("label") + 1) % labels)
    return rows.withColumn("label", F.coalesce(moved, F.col("label")))


def _matrix(table: pa.Table, width: int) -> np.ndarray:
    """Vectors as rows of a matrix of 64-bit numbers."""
    column = table.column("vector").combine_chunks()
    out = np.zeros((table.num_rows, width), np.int64)
    sizes = column.value_lengths().to_numpy(False)
    inside = np.arange(width) < sizes[:, None]
    out[inside] = column.flatten().to_numpy(False)
    return out


def _width(*tables: pa.Table) -> int:
    sizes = [t.column("vector").combine_chunks().value_lengths().to_numpy(False) for t in tables]
    return max([1, *(int(x.max()) for x in sizes if len(x))])


def _rests(x: np.ndarray) -> np.ndarray:
    """Norms of what follows each step of dimensions, the whole vector first."""
    squares = x * x
    steps = np.add.reduceat(squares, np.arange(0, x.shape[1], STEP), axis=1)
    tails = np.cumsum(steps[:, ::-1], axis=1)[:, ::-1]
    return np.sqrt(np.hstack([tails, np.zeros((len(x), 1))]))


class Cell:
    """The rows of a cell, ready for searches."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray):
        self.whole = rows
        self.ids = ids
        energy = (rows.astype(np.float64) ** 2).sum(axis=0)
        self.order = np.argsort(-energy, kind="stable")
        self.rows = rows[:, self.order].astype(np.float64)
        self.rests = _rests(self.rows)
        self.largest = float(np.abs(rows).max(initial=0))

    def above(self, anchors: np.ndarray, bar: np.ndarray) -> Pairs:
        """All pairs with a score of at least the anchor's ``bar``."""
        q = anchors[:, self.order].astype(np.float64)
        rests = _rests(q)
        slack = 1e-9 * rests[:, 0].max(initial=0) * self.rests[:, 0].max(initial=0) + 1e-6
        floor = bar - slack
        # How many steps of dimensions each row has in the index.
        reach = self.rests * rests.max(axis=0)
        depth = (reach >= floor.min()).sum(axis=1) if floor.min() > 0 else None
        steps = self.rests.shape[1] - 1
        depth = np.full(len(self.rows), steps) if depth is None else np.minimum(depth, steps)
        rows = np.argsort(-depth, kind="stable")
        depth = depth[rows]
        rows = rows[: np.count_nonzero(depth)]
        depth = depth[: len(rows)]
        score = np.zeros((len(q), len(rows)))
        for k in range(steps):
            listed = int(np.searchsorted(-depth, -k, "left"))  # rows with more than k steps
            part = slice(k * STEP, (k + 1) * STEP)
            score[:, :listed] += q[:, part] @ self.rows[rows[:listed], part].T
            # What a row's lists have not yet given.
            left = self.rests[rows, np.minimum(k + 1, depth)]
            tail = rests[:, np.minimum(k + 1, depth)] if listed < len(rows) else rests[:, [k + 1]]
            possible = score + tail * left >= floor[:, None]
            alive = possible.any(axis=0)
            if k == steps - 1:
                anchor, at = np.nonzero(possible)
            elif 4 * np.count_nonzero(alive) < 3 * len(rows):
                rows, depth, score = rows[alive], depth[alive], score[:, alive]
        row = rows[at]
        exact = self.exact(anchors, anchor, row, score[anchor, at], depth[at] == steps)
        enough = exact >= bar[anchor]
        return self.sorted(anchor[enough], row[enough], exact[enough])

    def exact(self, anchors, anchor, row, score, complete) -> np.ndarray:
        """Scores as whole numbers; sums of doubles below 2**53 are whole already."""
        out = np.zeros(len(row), np.int64)
        small = self.largest * np.abs(anchors).max(initial=0) * anchors.shape[1] < EXACT
        if small:
            out[complete] = np.rint(score[complete]).astype(np.int64)
        for at in _slices(np.flatnonzero(~complete) if small else np.arange(len(row))):
            out[at] = (anchors[anchor[at]] * self.whole[row[at]]).sum(axis=1)
        return out

    def sorted(self, anchor: np.ndarray, row: np.ndarray, score: np.ndarray) -> Pairs:
        order = np.lexsort((self.ids[row], -score, anchor))
        return Pairs(anchor[order], row[order], score[order])


def _slices(at: np.ndarray, size: int = 1 << 16) -> Iterator[np.ndarray]:
    return (at[k : k + size] for k in range(0, len(at), size))


def _first(pairs: Pairs, k: int) -> Pairs:
    """The first ``k`` pairs of each anchor."""
    start = np.searchsorted(pairs.anchor, pairs.anchor)
    return Pairs(*(x[np.arange(len(start)) - start < k] for x in pairs))


def nearest(cell: Cell, anchors: np.ndarray, allowed, k: int) -> Pairs:
    """The best ``k`` rows of each anchor among those that ``allowed`` lets pass."""
    out = []
    open_ = np.arange(len(anchors))
    longest = cell.rests[:, 0].max(initial=0)
    share = 0.4
    while len(open_):
        last = share < 0.02 or len(cell.ids) <= 4 * k
        norms = np.sqrt((anchors[open_].astype(np.float64) ** 2).sum(axis=1))
        bar = np.full(len(open_), -np.inf) if last else share * longest * norms
        found = cell.above(anchors[open_], bar)
        found = Pairs(open_[found.anchor], found.row, found.score)
        passed = allowed(found.anchor, found.row)
        found = _first(Pairs(*(x[passed] for x in found)), k)
        done = np.bincount(found.anchor, minlength=len(anchors)) >= k
        done |= last
        out.append(Pairs(*(x[done[found.anchor]] for x in found)))
        open_ = open_[~done[open_]]
        share *= 0.6
    return Pairs(*map(np.concatenate, zip(*out, strict=True)))


class Filled(NamedTuple):
    """Rows in windows: the anchor, the number of the window, row and score."""

    anchor: np.ndarray
    window: np.ndarray
    row: np.ndarray
    score: np.ndarray


def within(
    cell: Cell, anchors: np.ndarray, allowed, low: np.ndarray, high: np.ndarray, k: int
) -> Filled:
    """The best ``k`` rows from ``low`` to ``high`` for each anchor (line) and window
    (column); a window with ``low`` above ``high`` is empty."""
    out = [(np.zeros(0, np.int64),) * 4]
    open_ = low <= high
    share = 0.97
    while open_.any():
        who = np.flatnonzero(open_.any(axis=1))
        top = np.where(open_[who], high[who], np.iinfo(np.int64).max).min(axis=1)
        end = np.where(open_[who], low[who], np.iinfo(np.int64).max).min(axis=1)
        bar = np.maximum(end, np.floor(top * share)) if share > 0.5 else end
        found = cell.above(anchors[who], bar.astype(np.float64))
        passed = allowed(who[found.anchor], found.row)
        found = Pairs(*(x[passed] for x in found))
        edges = np.searchsorted(found.anchor, np.arange(len(who) + 1))
        for j, a in enumerate(who.tolist()):
            part = slice(edges[j], edges[j + 1])
            score = found.score[part]
            for w in np.flatnonzero(open_[a]).tolist():
                first = int(np.searchsorted(-score, -high[a, w]))
                last = min(first + k, int(np.searchsorted(-score, -low[a, w], "right")))
                if last - first < k and bar[j] > low[a, w]:
                    continue
                open_[a, w] = False
                n = last - first
                rows = found.row[part][first:last]
                out.append((np.full(n, a), np.full(n, w), rows, score[first:last]))
        share *= 0.92
    return Filled(*map(np.concatenate, zip(*out, strict=True)))


def _numbers(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy().astype(np.int64, copy=False)


def _table(columns: list[np.ndarray], schema: str) -> pa.Table:
    kinds = {"long": pa.int64(), "int": pa.int32()}
    fields = [x.split(" ") for x in schema.split(", ")]
    return pa.table(
        [pa.array(c, kinds[kind]) for c, (_, kind) in zip(columns, fields, strict=True)],
        names=[name for name, _ in fields],
    )


def _tiles(queries: pa.Table, rows: pa.Table):
    """The cell, and its anchors some at a time."""
    width = _width(queries, rows)
    cell = Cell(_matrix(rows, width), _numbers(rows, "vec_id"))
    for at in range(0, queries.num_rows, TILE):
        part = queries.slice(at, TILE)
        yield cell, part, _matrix(part, width)


def best_of_label(k: int):
    """The ``k`` best other rows of a label's cell for each anchor of a block."""

    def search(queries: pa.Table, rows: pa.Table) -> pa.Table:
        out = [[np.zeros(0, np.int64)] for _ in range(4)]
        if queries.num_rows and rows.num_rows:
            own = _numbers(rows, "row")
            for cell, part, anchors in _tiles(queries, rows):
                self_ = _numbers(part, "row")
                found = nearest(cell, anchors, lambda a, r: self_[a] != own[r], k)  # noqa: B023
                ids = _numbers(part, "vec_id")[found.anchor]
                columns = (self_[found.anchor], ids, cell.ids[found.row], found.score)
                for x, y in zip(out, columns, strict=True):
                    x.append(y)
        return _table([np.concatenate(x) for x in out], NEAR)

    return search


def best_of_others(k: int, low: int, high: int):
    """The ``k`` best rows of a cell in each window of each anchor of a block."""

    def search(queries: pa.Table, rows: pa.Table) -> pa.Table:
        out = [[np.zeros(0, np.int64)] for _ in range(7)]
        if queries.num_rows and rows.num_rows:
            labels = _numbers(rows, "label")
            for cell, part, anchors in _tiles(queries, rows):
                own = _numbers(part, "label")
                positives = part.column("positives").to_pylist()
                width = max(map(len, positives))
                score = np.full((len(positives), width), -1, np.int64)
                ids = np.zeros_like(score)
                for j, of in enumerate(positives):
                    for w, x in enumerate(of):
                        score[j, w], ids[j, w] = x["score"], x["positive_id"]
                # Whole numbers from low to high percent; none where the score is negative.
                bottom = np.where(score < 0, 1, -(-low * score // 100))
                top = np.where(score < 0, 0, high * score // 100)
                other = lambda a, r: own[a] != labels[r]  # noqa: B023, E731
                found = within(cell, anchors, other, bottom, top, k)
                at = (found.anchor, found.window)
                columns = (
                    _numbers(part, "row")[found.anchor], found.window,
                    _numbers(part, "vec_id")[found.anchor], ids[at], score[at],
                    cell.ids[found.row], found.score,
                )
                for x, y in zip(out, columns, strict=True):
                    x.append(y)
        return _table([np.concatenate(x) for x in out], FAR)

    return search


def _part(n, salt: int = 0):
    return F.pmod(F.xxhash64("row", F.lit(salt)), n).cast("int")


def _spread(n):
    """A copy of the row for each of ``n`` parts."""
    return F.explode(F.sequence(F.lit(0), (n - 1).cast("int")))


def _parts(n, size: int):
    return F.greatest(F.lit(1), F.ceil(n / size)).cast("int")


def _top(rows: DataFrame, keys: list[str], score: str, tie: str, k: int, name: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.col(score).desc(), tie)
    return rows.withColumn(name, F.row_number().over(order)).filter(F.col(name) <= k)


def hard_negatives(
    rows: DataFrame, every: int = 50, positives: int = 5, negatives: int = 3
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``rows`` are those of ``vectors``, staged; anchors are those whose id ``every``
    divides.
    """
    # Columns of their own, as both sides of a cogroup come from the same rows.
    anchors = rows.toDF(*rows.columns).filter(F.col("vec_id") % every == 0)
    # First search: blocks and cells of one label, as many as its rows ask for.
    sizes = rows.groupBy("label").agg(
        _parts(F.count(F.lit(1)), CELL).alias("cells"),
        _parts(F.count_if(F.col("vec_id") % every == 0), BLOCK).alias("blocks"),
    )
    sizes = stage(sizes, "label-sizes")
    keys = ["label", "cell", "block"]
    base = (
        rows.join(sizes, "label")
        .withColumn("cell", _part(F.col("cells")))
        .withColumn("block", _spread(F.col("blocks")))
    )
    asked = (
        anchors.join(sizes.toDF(*sizes.columns), "label")
        .withColumn("block", _part(F.col("blocks"), 1))
        .withColumn("cell", _spread(F.col("cells")))
    )
    columns = [*keys, "row", "vec_id", "vector"]
    near = (
        asked.select(columns)
        .groupBy(keys)
        .cogroup(base.select(columns).groupBy(keys))
        .applyInArrow(best_of_label(positives), NEAR)
    )
    best = _top(near, ["anchor_row"], "score", "positive_id", positives, "place")
    listed = best.groupBy("anchor_row").agg(
        F.sort_array(F.collect_list(F.struct("place", "positive_id", "score"))).alias("positives")
    )
    listed = stage(listed.withColumnRenamed("anchor_row", "row"), "positives")
    # Second search: all blocks and all cells.
    count = rows.agg(F.count(F.lit(1)), F.count_if(F.col("vec_id") % every == 0)).first()
    cells, blocks = max(1, -(-count[0] // CELL)), max(1, -(-count[1] // BLOCK))
    keys = ["cell", "block"]
    base = rows.withColumn("cell", _part(F.lit(cells))).withColumn("block", _spread(F.lit(blocks)))
    asked = (
        anchors.join(listed, "row")
        .withColumn("block", _part(F.lit(blocks), 1))
        .withColumn("cell", _spread(F.lit(cells)))
    )
    columns = [*keys, "row", "vec_id", "label", "vector"]
    far = (
        asked.select(*columns, "positives")
        .groupBy(keys)
        .cogroup(base.select(columns).groupBy(keys))
        .applyInArrow(best_of_others(negatives, LOW, HIGH), FAR)
    )
    best = _top(far, ["anchor_row", "place"], "negative_score", "negative_id", negatives, "rank")
    return best.select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id",
        "positive_score", "negative_score",
    )


def mined(embeddings: DataFrame, every: int = 50) -> DataFrame:
    """Hard negatives of the test corpus: shifted labels, floors of components."""
    return hard_negatives(stage(shifted(vectors(embeddings)), "vectors"), every)
