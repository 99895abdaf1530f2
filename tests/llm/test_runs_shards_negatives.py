"""Periodic runs, shards and hard negatives: brute force, invariants, odd rows."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from test_operators import LONG, ODD, documents
from voltalake.llm import balanced_shards, hard_negatives, periodic_runs


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(*x, "en", 1, 2, b"k", "r", 3) for x in ODD]
    schema = (
        "doc_id long, text string, lang string, size long, start long, hash binary, row string, "
        "shard int"
    )
    return spark.createDataFrame(rows, schema)


# --- periodic runs ---------------------------------------------------------------
def brute_runs(words):
    """(start, length, smallest period) of all runs."""
    n, least = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                least.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted((*key, q) for key, q in least.items())


def brute_row(doc_id, text, loop):
    words = (text or "").encode().split()
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if loop and doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
    found = sorted(brute_runs(words), key=lambda x: (x[0], x[2]))
    gone = {k for s, length, q in found for k in range(s + q, s + length)}
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    best = min(found, key=lambda x: (-x[1], x[0], x[2])) if found else None
    kept = b" ".join(w for k, w in enumerate(words) if k not in gone)
    return (
        doc_id, len(found),
        *((best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4),
        hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest(),
    )


def repetitive(rng, words):
    """Words with some stretches put in again and again."""
    out = rng.choices(words, k=rng.randint(0, 40))
    for _ in range(rng.randint(0, 4)):
        unit = rng.choices(words, k=rng.randint(1, 8))
        at = rng.randint(0, len(out))
        out[at:at] = (unit * rng.randint(2, 9))[: rng.randint(1, 60)]
    return out


def test_runs_match_brute_force(spark):
    rng = random.Random(11)
    texts = [" ".join(repetitive(rng, "abcdefgh"[: rng.randint(1, 8)])) for _ in range(600)]
    texts += ["a " * 5, "a\x0bb " * 200 + "c", "x  y\n" * 3 + "x  y", None, "", " "]
    for loop in (False, True):
        found = periodic_runs.document_runs(documents(spark, texts), loop).orderBy("doc_id")
        expected = [brute_row(k, x, loop) for k, x in enumerate(texts)]
        assert [tuple(x) for x in found.collect()] == expected


def test_runs_of_famous_words():
    """Fibonacci words have no run of four periods, Thue-Morse words none of two."""
    a, b = [0], [0, 1]
    while len(b) < 20_000:
        a, b = b, b + a
    parity = [bin(k).count("1") % 2 for k in range(1 << 15)]
    doc = np.zeros(50_000, np.int64)
    for words in (b, parity):
        assert not len(periodic_runs.runs(np.array(words), doc[: len(words)]).start)
    found = periodic_runs.runs(np.tile(np.arange(100), 400), doc[:40_000])
    assert [x.tolist() for x in found] == [[0], [40_000], [100]]
    found = periodic_runs.runs(doc, doc)
    assert [x.tolist() for x in found] == [[0], [50_000], [1]]


def test_runs_inside_nested_repeats():
    """Runs whose period holds runs, cut by a word in their midst."""
    unit = [1] * 9 + [2, 3] * 5 + [4]
    words = unit * 6 + [9] + unit * 5
    found = periodic_runs.runs(np.array(words), np.zeros(len(words), np.int64))
    rows = sorted(zip(found.start.tolist(), (found.stop - found.start).tolist(),
                      found.period.tolist(), strict=True))
    assert rows == brute_runs(words)


def test_runs_of_odd_rows(spark, odd):
    found = periodic_runs.document_runs(odd, loop=True).collect()
    expected = [brute_row(*x, True) for x in ODD if x[1] != LONG]
    assert sorted((tuple(x) for x in found if x["doc_id"] != 4), key=str) == sorted(expected, key=str)
    assert periodic_runs.document_runs(odd.filter("false")).collect() == []


# --- shards ----------------------------------------------------------------------
def check_shards(rows, texts, shards=16):
    """Every document once, slots gapless, sizes and checksums right, sizes level."""
    expected = Counter(
        (k, len((x or "").encode()) + 1, zlib.crc32((x or "").encode())) for k, x in texts
    )
    assert Counter((x["doc_id"], x["size"], x["text_crc32"]) for x in rows) == expected
    slots, loads = defaultdict(list), [0] * shards
    for x in rows:
        assert (x["law"], x["grown_shard"]) == ("bytes", None)
        slots[x["shard"]].append(x["slot"])
        loads[x["shard"]] += x["size"]
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    assert max(loads) - min(loads) <= max(x["size"] for x in rows)
    return loads


def shards_of_texts(rows):
    out = defaultdict(set)
    for x in rows:
        out[x["size"], x["text_crc32"]].add(x["shard"])
    return list(out.values())


def test_linked_documents_share_a_shard(spark):
    rng = random.Random(12)
    base = ["".join(rng.choices("abc de", k=rng.randint(1, 900))) for _ in range(300)]
    texts = base + [rng.choice(base) for _ in range(500)]
    rows = balanced_shards.shard_documents(documents(spark, texts)).collect()
    loads = check_shards(rows, list(enumerate(texts)))
    assert max(loads) - min(loads) < 0.01 * sum(loads) / 16
    groups = shards_of_texts(rows)
    assert sum(len(x) == 1 for x in groups) >= 0.95 * len(groups)


def test_a_text_of_a_third_of_all_rows_fills_few_shards(spark):
    rng = random.Random(13)
    texts = ["hot " * 20] * 700 + ["".join(rng.choices("abcdef", k=80)) for _ in range(1400)]
    rows = balanced_shards.shard_documents(documents(spark, texts)).collect()
    loads = check_shards(rows, list(enumerate(texts)))
    assert max(loads) - min(loads) <= 100
    # A third of 16 shards is a little over five.
    assert max(len(x) for x in shards_of_texts(rows)) <= 7


def test_linked_documents_only(spark):
    """No single document is there to level the shards."""
    texts = [f"text {k % 400} " * (1 + k % 7) for k in range(800)]
    rows = balanced_shards.shard_documents(documents(spark, texts)).collect()
    loads = check_shards(rows, list(enumerate(texts)))
    assert max(loads) <= 1.02 * sum(loads) / 16
    groups = shards_of_texts(rows)
    assert sum(len(x) == 1 for x in groups) >= 0.8 * len(groups)


def test_shards_of_odd_rows(spark, odd):
    check_shards(balanced_shards.shard_documents(odd).collect(), ODD)
    assert balanced_shards.shard_documents(odd.filter("false")).collect() == []


@pytest.mark.parametrize("loads", [[0, 0, 0], [5, 900, 3]])
def test_dealing_levels_loads(loads):
    rng = random.Random(14)
    classes = [(k, n := rng.choice([1, 3, 500]), n * (k + 1)) for k in range(40)]
    before = sum(loads)
    plan = balanced_shards.deal(classes, loads)
    assert sum(loads) == before + sum(x[2] for x in classes)
    assert max(loads) - min(loads) <= 40
    for of, count, _ in classes:
        ranks = sorted(x[1:3] for x in plan if x[0] == of)
        assert ranks[0][0] == 0 and ranks[-1][1] == count
        assert all(a[1] == b[0] for a, b in zip(ranks, ranks[1:], strict=False))


def test_quotas_keep_to_the_limit():
    loads = [100, 60, 90]
    asked = [(0, 2, 0, 10), (1, 1, 0, 30), (2, 0, 1, 40), (3, 2, 1, 10), (4, 0, 2, 5)]
    taken = balanced_shards.accepted(asked, loads, 100)
    # What 0 gives to 1 makes room for what 1 and 2 ask of 0, as far as it goes.
    assert taken == [(0, 1, 2), (0, 2, 4), (2, 0, 0), (1, 0, 1), (2, 1, 3)]
    assert loads == [95, 80, 75]


# --- hard negatives --------------------------------------------------------------
def brute_negatives(rows, every=50):
    """``rows`` are (vec_id, vector, label)."""
    usable = []
    for vec_id, vector, label in rows:
        if vec_id is None or vector is None or label is None:
            continue
        if any(x is None or not np.isfinite(x) for x in vector):
            continue
        label = (label + 1) % 10 if vec_id % 7 == 0 else label
        usable.append((vec_id, label, [int(np.floor(256 * float(np.float32(x)))) for x in vector]))
    width = max(len(x[2]) for x in usable)
    usable = [(a, b, v + [0] * (width - len(v))) for a, b, v in usable]
    out = []
    for k, (anchor, label, v) in enumerate(usable):
        if anchor % every:
            continue
        scored = sorted(
            (-sum(x * y for x, y in zip(v, w, strict=True)), other, of)
            for j, (other, of, w) in enumerate(usable)
            if j != k
        )
        for s, positive, _ in [x for x in scored if x[2] == label][:5]:
            found = [
                x for x in scored if x[2] != label and 50 * -s <= 100 * -x[0] <= 95 * -s
            ][:3]
            out += [(anchor, positive, r + 1, x[1], -s, -x[0]) for r, x in enumerate(found)]
    return sorted(out)


def mined(spark, rows):
    schema = "vec_id long, embedding array<float>, label int, row string, cell string, score int"
    table = spark.createDataFrame([(*x, "r", "c", 1) for x in rows], schema)
    return sorted(tuple(x) for x in hard_negatives.mined(table).collect())


def clustered(n, seed, width=24, spread=0.4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(10, width))
    label = rng.integers(0, 10, n)
    x = centres[rng.integers(0, 10, n)] + spread * rng.normal(size=(n, width))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    return [(k, x[k].astype(np.float32).tolist(), int(label[k])) for k in range(n)]


@pytest.mark.parametrize("cell,block,tile", [(4096, 2048, 256), (50, 3, 2)])
def test_negatives_match_brute_force(spark, monkeypatch, cell, block, tile):
    for name, value in (("CELL", cell), ("BLOCK", block), ("TILE", tile)):
        monkeypatch.setattr(hard_negatives, name, value)
    rows = clustered(600, 1)
    assert mined(spark, rows) == brute_negatives(rows)


def test_negatives_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = clustered(160, 2, 5)
    rows += [(None, [1.0] * 5, 1), (200, None, 1), (250, [1.0] * 5, None), (300, [1.0, nan], 1)]
    rows += [(350, [inf] * 5, 2), (400, [None, 1.0], 2), (450, [], 3), (500, [0.0] * 5, 3)]
    rows += [(550, [0.5], 3), (-50, [0.3] * 5, -3), rows[50], rows[50], rows[51], rows[52]]
    rows += [(600, [3e4] * 5, 1), (601, [2.5e4] * 5, 1), (602, [2e4] * 5, 2), (603, [-3e4] * 5, 2)]
    assert mined(spark, rows) == brute_negatives(rows)
    assert mined(spark, []) == []
    assert mined(spark, [(50, [1.0], 1)]) == []
    # Beyond the range components saturate.
    assert mined(spark, [(50, [3e38], 1), (1, [1e37], 1), (2, [471_859.0], 2)]) == [
        (50, 1, 1, 2, 2**54, 2**27 * 256 * 471_859)
    ]


def test_index_leaves_out_what_bounds_cover():
    """All pairs above a threshold are found while most of the lists stay empty."""
    rng = np.random.default_rng(3)
    rows = (rng.normal(size=(500, 64)) * np.geomspace(200, 0.5, 64)).astype(np.int64)
    cell = hard_negatives.Cell(rows, np.arange(500))
    anchors = rows[:40]
    whole = anchors @ rows.T
    for share in (0.9, 0.5, 0.2, -0.1):
        bar = share * whole.max(axis=1)
        found = cell.above(anchors, bar)
        expected = {(a, r) for a, r in zip(*np.nonzero(whole >= bar[:, None]), strict=True)}
        assert set(zip(found.anchor.tolist(), found.row.tolist(), strict=True)) == expected
        assert (found.score == whole[found.anchor, found.row]).all()
