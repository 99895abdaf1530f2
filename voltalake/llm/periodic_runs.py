"""Periodic runs of words, found on a grammar of each document.

A run is a stretch of words with smallest period ``q`` and at least
``max(LEAST, TIMES * q)`` words that no neighbouring word extends.

1. *Grammar.* Re-Pair on word ids: pairs of neighbours that a document holds more
   than once become nonterminals, the most frequent first, in rounds that replace
   all pairs that no more frequent neighbour overlaps. A pair of symbols that
   occurs once never repeats later, so each round looks only at what still does.
   What is left of a document is paired up until one symbol spans it.
2. *Boundaries.* A run lies whole in the least symbol that spans it and crosses
   the boundary of that symbol's two parts, with two periods or more on one side.
   So each nonterminal is looked at once, where it first occurs: periods whose
   pair of words recurs beside the boundary, then whether the two halves of a
   square agree, then how far the period reaches inside the nonterminal.
3. *Positions.* What a nonterminal holds is translated to all places where it was
   put; of intervals with one period only those stay that no other contains, and
   of periods of one interval the smallest.

Words are compared by 64-bit hashes, stretches by two sums modulo primes of 31
bits. A document is one task's work, whatever its length; the work grows with
its length times its logarithm.

Null and empty texts have no words and no runs. Rows that repeat an id are judged
one by one; a null id is allowed and its words stay as they came. Other columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from voltalake.llm.text import Batch, crc, map_batches, mixed, portions, read, texts

LEAST = 6
TIMES = 4
CHUNK = 1 << 19  # candidates looked at together
# Moduli and bases of the sums that compare stretches.
PRIMES = ((2_147_483_647, 1_103_515_245), (2_147_483_629, 1_664_525_013))
RESULT = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
    "runs_sha256 string, collapsed_sha256 string"
)


class Rules(NamedTuple):
    """Nonterminals by their first occurrence, and all places of each."""

    start: np.ndarray
    middle: np.ndarray  # where the second part begins
    stop: np.ndarray
    rule: np.ndarray  # of each place
    place: np.ndarray


class Runs(NamedTuple):
    start: np.ndarray
    stop: np.ndarray
    period: np.ndarray


def _spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each of ``counts[k]`` items: k, and its number from 0."""
    owner = np.repeat(np.arange(len(counts)), counts)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)


def _heads(*columns: np.ndarray) -> np.ndarray:
    """Whether any column differs from the item before."""
    flag = np.ones(len(columns[0]), bool)
    flag[1:] = False
    for x in columns:
        flag[1:] |= x[1:] != x[:-1]
    return flag


class _Sequence:
    """Symbols of several documents during the replacement of pairs."""

    def __init__(self, words: np.ndarray, doc: np.ndarray):
        self.symbol = words
        self.doc = doc
        self.start = np.arange(len(words))
        self.stop = self.start + 1
        self.next = int(words.max()) + 1 if len(words) else 0
        self.alive = np.zeros(len(words), bool)  # whether the pair from here may repeat
        self.alive[:-1] = doc[1:] == doc[:-1]

    def __len__(self) -> int:
        return len(self.symbol)

    def select(self, keep: np.ndarray) -> None:
        for name in ("symbol", "doc", "start", "stop", "alive"):
            setattr(self, name, getattr(self, name)[keep])

    def repeated(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where pairs that occur twice or more begin, their codes and frequencies."""
        at = np.flatnonzero(self.alive)
        code = self.symbol[at] << 32 | self.symbol[at + 1]
        order = np.argsort(code)
        first = np.flatnonzero(_heads(code[order]))
        sizes = np.diff(np.append(first, len(code)))
        count = np.empty(len(code), np.int64)
        count[order] = np.repeat(sizes, sizes)
        several = count > 1
        self.alive[at[~several]] = False
        return at[several], code[several], count[several]

    def replace(self, at: np.ndarray, symbols: np.ndarray) -> None:
        """Put a symbol in place of each pair; no two of them overlap."""
        self.symbol[at] = symbols
        self.stop[at] = self.stop[at + 1]
        self.alive[at] = self.alive[at + 1]
        keep = np.ones(len(self), bool)
        keep[at + 1] = False
        self.select(keep)


def _chosen(at: np.ndarray, code: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Pairs that no more frequent pair overlaps; of overlapping equal ones each second."""
    weight = count.astype(np.uint64) << np.uint64(36) | mixed(code.view(np.uint64)) >> np.uint64(28)
    beside = np.zeros(len(at), bool)  # overlaps the one before
    beside[1:] = at[1:] == at[:-1] + 1
    head = ~beside
    head[1:] |= weight[1:] != weight[:-1]
    first = np.flatnonzero(head)
    sizes = np.diff(np.append(first, len(at)))
    before = np.where(beside[first], weight[first - 1], np.uint64(0))
    last = first + sizes - 1
    after_at = np.minimum(last + 1, len(at) - 1)
    after = np.where((after_at > last) & beside[after_at], weight[after_at], np.uint64(0))
    best = (weight[first] > before) & (weight[first] > after)
    owner, inside = _spread(sizes)
    return best[owner] & (inside % 2 == 0)


def grammar(words: np.ndarray, doc: np.ndarray) -> Rules:
    """Re-Pair of documents side by side; a word of two documents is two numbers."""
    seq = _Sequence(words, doc)
    at, code, count = seq.repeated()
    # Without a pair that repeats a document has no run, and it needs no grammar.
    useful = np.zeros(int(doc[-1]) + 1 if len(doc) else 0, bool)
    useful[doc[at]] = True
    seq.select(useful[doc])
    first, middle, stop, rule, place = [], [], [], [], []
    rules = 0

    def record(chosen: np.ndarray, which: np.ndarray, example: np.ndarray) -> None:
        nonlocal rules
        first.append(seq.start[example])
        middle.append(seq.start[example + 1])
        stop.append(seq.stop[example + 1])
        rule.append(rules + which)
        place.append(seq.start[chosen])
        rules += len(example)

    while True:
        at, code, count = seq.repeated()
        if not len(at):
            break
        taken = _chosen(at, code, count)
        chosen = at[taken]
        _, example, which = np.unique(code[taken], return_index=True, return_inverse=True)
        record(chosen, which, chosen[example])
        seq.replace(chosen, seq.next + which)
        seq.next += len(example)
    while True:
        begins = np.flatnonzero(_heads(seq.doc))
        _, inside = _spread(np.diff(np.append(begins, len(seq))))
        pair = np.zeros(len(seq), bool)
        pair[:-1] = (inside[:-1] % 2 == 0) & (seq.doc[1:] == seq.doc[:-1])
        chosen = np.flatnonzero(pair)
        if not len(chosen):
            break
        record(chosen, np.arange(len(chosen)), chosen)
        seq.replace(chosen, seq.next + np.arange(len(chosen)))
        seq.next += len(chosen)
    none = [np.zeros(0, np.int64)]
    return Rules(*(np.concatenate(none + x) for x in (first, middle, stop, rule, place)))


class _Stretches:
    """Whether two stretches of words are equal."""

    def __init__(self, words: np.ndarray):
        value = mixed(words.astype(np.uint64) + np.uint64(1)) >> np.uint64(33)
        self.sums = []
        for prime, base in PRIMES:
            power = np.ones(len(words) + 1, np.int64)
            n = 1
            while n < len(power):  # a power for each place, by doubling
                more = power[: min(n, len(power) - n)]
                power[n : n + len(more)] = more * (int(power[n - 1]) * base % prime) % prime
                n += len(more)
            total = np.zeros(len(words) + 1, np.int64)
            np.cumsum(value.astype(np.int64) % prime * power[:-1] % prime, out=total[1:])
            self.sums.append((total, power, prime))

    def equal(self, start: np.ndarray, n: np.ndarray, period: np.ndarray) -> np.ndarray:
        """Whether the ``n`` words from ``start`` are those ``period`` words later."""
        same = np.ones(len(start), bool)
        for total, power, prime in self.sums:
            here = (total[start + n] - total[start]) % prime * power[period] % prime
            there = (total[start + period + n] - total[start + period]) % prime
            same &= here == there
        return same

    def reach(
        self, x: np.ndarray, period: np.ndarray, most: np.ndarray, forward: bool
    ) -> np.ndarray:
        """How many words from ``x`` on, or before it, are those ``period`` later."""
        low, high = np.zeros(len(x), np.int64), most.copy()
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                return low
            n = (low[open_] + high[open_] + 1) // 2
            start = x[open_] if forward else x[open_] - n
            same = self.equal(start, n, period[open_])
            low[open_] = np.where(same, n, low[open_])
            high[open_] = np.where(same, high[open_], n - 1)


def _squares(
    pairs: np.ndarray, rules: Rules, long: np.ndarray, right: bool
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rule, period) of words beside the boundary that recur a period farther on."""
    start, middle, stop = (x[long] for x in rules[:3])
    side = stop - middle if right else middle - start
    counts = np.minimum((stop - start) // TIMES, side // 2)
    cuts = np.searchsorted(np.cumsum(counts), np.arange(0, counts.sum() + CHUNK, CHUNK), "right")
    cuts[-1] = len(counts)
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        owner, period = _spread(counts[a:b])
        owner, period = owner + a, period + 1
        anchor = middle[owner] if right else middle[owner] - 2
        other = anchor + period if right else np.maximum(anchor - period, 0)
        found = pairs[anchor] == pairs[other]
        yield long[owner[found]], period[found]


def runs(words: np.ndarray, doc: np.ndarray) -> Runs:
    """All runs, in order of start and period; ``doc`` numbers the documents from 0."""
    none = np.zeros(0, np.int64)
    if len(words) < LEAST:
        return Runs(none, none, none)
    rules = grammar(words, doc)
    pairs = np.full(len(words), -1, np.int64)
    pairs[:-1] = words[:-1] << 32 | words[1:]
    stretches = _Stretches(words)
    long = np.flatnonzero(rules.stop - rules.start >= LEAST)
    found = [(none, none, none, none)]
    for right in (True, False):
        for rule, period in _squares(pairs, rules, long, right):
            start, middle, stop = (x[rule] for x in rules[:3])
            x = middle if right else middle - period
            square = stretches.equal(x if right else x - period, period, period)
            rule, period, start, stop, x = (
                y[square] for y in (rule, period, start, stop, x)
            )
            r = x + period + stretches.reach(x, period, stop - x - period, True)
            l = x - stretches.reach(x, period, x - start, False)  # noqa: E741
            whole = r - l >= np.maximum(LEAST, TIMES * period)
            found.append((rule[whole], l[whole] - start[whole], r[whole] - l[whole], period[whole]))
    rule, offset, length, period = map(np.concatenate, zip(*found, strict=True))
    # Of several periods of one interval in a nonterminal the smallest.
    order = np.lexsort((period, length, offset, rule))
    rule, offset, length, period = (x[order] for x in (rule, offset, length, period))
    head = _heads(rule, offset, length)
    return _maximal(*_placed(rules, rule[head], offset[head], length[head], period[head]))


def _placed(rules: Rules, rule, offset, length, period) -> Runs:
    """Intervals of nonterminals at all places of these."""
    order = np.argsort(rules.rule, kind="stable")
    of, place = rules.rule[order], rules.place[order]
    first, last = np.searchsorted(of, rule), np.searchsorted(of, rule, "right")
    owner, inside = _spread(last - first)
    start = place[first[owner] + inside] + offset[owner]
    return Runs(start, start + length[owner], period[owner])


def _maximal(start: np.ndarray, stop: np.ndarray, period: np.ndarray) -> Runs:
    order = np.lexsort((-stop, start, period))
    start, stop, period = start[order], stop[order], period[order]
    if len(start):
        group = np.cumsum(_heads(period)) * (int(stop.max()) + 1)
        far = np.maximum.accumulate(group + stop)
        outside = np.ones(len(start), bool)
        outside[1:] = group[1:] + stop[1:] > far[:-1]
        start, stop, period = start[outside], stop[outside], period[outside]
    order = np.lexsort((period, stop, start))
    start, stop, period = start[order], stop[order], period[order]
    least = _heads(start, stop)
    start, stop, period = start[least], stop[least], period[least]
    order = np.lexsort((period, start))
    return Runs(start[order], stop[order], period[order])


def looped(doc_id: int | None, n: int) -> np.ndarray | None:
    """The test corpus' rule: for a tenth of the ids, words from ``a`` on repeat with
    period ``p``. Gives the number of the word to take in each place, or None."""
    h = crc(doc_id)
    if doc_id is None or h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    out = np.arange(n)
    out[a:] = a + (out[a:] - a) % p
    return out


def _row(found: Runs, base: int, words: list[bytes], taken: np.ndarray | None) -> tuple:
    """The digest columns of a document."""
    start, stop, period = found.start - base, found.stop - base, found.period
    length = stop - start
    lines = "".join(
        f"{a},{n},{q}\n"
        for a, n, q in zip(start.tolist(), length.tolist(), period.tolist(), strict=True)
    )
    if taken is not None:
        words = [words[k] for k in taken.tolist()]
    best: tuple[int | None, ...] = (None, None, None, None)
    if len(start):
        edges = np.zeros(len(words) + 1, np.int64)
        np.add.at(edges, start + period, 1)
        np.add.at(edges, stop, -1)
        kept = np.flatnonzero(np.cumsum(edges[:-1]) == 0)
        words = [words[k] for k in kept.tolist()]
        k = int(np.lexsort((period, start, -length))[0])
        n, q = int(length[k]), int(period[k])
        best = (int(start[k]), n, q, 1000 * n // q)
    collapsed = hashlib.sha256(b" ".join(words)).hexdigest()
    return len(start), *best, hashlib.sha256(lines.encode()).hexdigest(), collapsed


def document_runs(docs: DataFrame, loop: bool = False) -> DataFrame:
    """A row for each document: its number of runs, the longest, and digests of all
    runs and of the text without the words that repeat in a run.

    With ``loop`` the words of a tenth of the documents are first made periodic,
    by the rule of ``looped``.
    """

    def find(batch: Batch) -> Batch:
        rows: list[tuple] = []
        ids = batch.column("doc_id").to_pylist()
        for of in portions(texts(batch)):
            portion = read(of)
            hashes, cuts = portion.hashes(), portion.per_text()
            sources: list[np.ndarray | None] = []
            place = np.arange(len(hashes))
            for k in range(len(of)):
                a, b = int(cuts[k]), int(cuts[k + 1])
                taken = looped(ids[len(rows) + k], b - a) if loop else None
                if taken is not None:
                    place[a:b] = a + taken
                sources.append(taken)
            doc = np.repeat(np.arange(len(of)), np.diff(cuts))
            own = hashes[place] ^ mixed(doc.astype(np.uint64) + np.uint64(1))
            words = np.unique(own, return_inverse=True)[1].astype(np.int64)
            found = runs(words, doc)
            edges = np.searchsorted(found.start, cuts)
            for k, text in enumerate(of):
                part = Runs(*(x[edges[k] : edges[k + 1]] for x in found))
                rows.append(_row(part, int(cuts[k]), text.split(), sources[k]))
        columns = list(zip(*rows, strict=True))
        kinds = [*[pa.int64()] * 5, pa.string(), pa.string()]
        return pa.record_batch(
            [batch.column("doc_id"), *(pa.array(x, t) for x, t in zip(columns, kinds, strict=True))],
            [x.split(" ")[0] for x in RESULT.split(", ")],
        )

    return map_batches(docs.select("doc_id", "text"), RESULT, find)
