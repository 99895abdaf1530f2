"""Each operator against brute force, and on odd rows."""

import hashlib
import random
import time
import tracemalloc
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models, pre_tokenizers

from voltalake.llm import (
    decontamination,
    extraction,
    language,
    near_duplicates,
    packing,
    quality_rules,
    resampling,
    suffix_dedup,
    token_counts,
    toxicity,
)
from voltalake.llm.components import components
from voltalake.llm.text import compressed, held_out, read

BPE = str(public_tokenizers.path("byte_bpe_50k.json"))
PIECES = str(public_tokenizers.path("piece_bpe_32k.model"))
WORDS = "the of and river stone cloud green house walks under seven lights again".split()
LONG = " ".join(f"word{k % 977} and{k % 31}" for k in range(40_000))
# A null id, null, empty, blank and long texts, repeated rows, ties, other scripts.
ODD = [
    (None, "a null id with some words in it"),
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, LONG),
    (5, "same text"),
    (6, "same text"),
    (6, "same text"),
    (7, "漢字 и слова é́ 😀 <|endoftext|> x"),
    (8, "one"),
    (9, "\x00\x02\x03 control"),
]


@pytest.fixture(scope="module")
def odd(spark):
    """Odd rows, with columns whose names operators use themselves."""
    rows = [(*x, "en", "s", 1, b"k", "r") for x in ODD]
    schema = (
        "doc_id long, text string, lang string, source string, n_chars long, key binary, row string"
    )
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(k, k % 2, (k + 1) % 2) for k in range(1, 10)] + [(None, 1, 1), (4, None, None)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def benchmark(spark):
    items = [(1, "one"), (2, None), (3, ""), (4, " ".join(LONG.split()[:40])), (5, "one"), (6, "!")]
    return spark.createDataFrame(items, "item_id long, text string")


def apply(name, docs, labels, benchmark):
    """Rows of the operator with that name."""
    return {
        "token_counts": lambda: token_counts.token_counts(docs, PIECES),
        "resampling": lambda: resampling.resample(docs, labels),
        "suffix_dedup": lambda: suffix_dedup.deduplicated(docs),
        "toxicity": lambda: toxicity.score(docs, toxicity.learn(docs, labels)),
        "language": lambda: language.predict(docs, language.learn(docs)),
        "packing": lambda: packing.pack(docs, BPE).filter("piece = 0"),
        "near_duplicates": lambda: near_duplicates.near_duplicates(docs),
        "quality_rules": lambda: quality_rules.judge(docs, quality_rules.learn(docs, labels)),
        "decontamination": lambda: decontamination.contamination(docs, benchmark),
    }[name]()


NAMES = [
    "token_counts", "resampling", "suffix_dedup", "toxicity", "language", "packing",
    "near_duplicates", "quality_rules", "decontamination",
]


@pytest.mark.parametrize("name", NAMES)
def test_odd_rows(odd, labels, benchmark, name):
    ids = [x["doc_id"] for x in apply(name, odd, labels, benchmark).collect()]
    assert sorted(ids, key=str) == sorted((x[0] for x in ODD), key=str)


@pytest.mark.parametrize("name", NAMES)
def test_empty_tables(odd, labels, benchmark, name):
    nothing = [x.filter("false") for x in (odd, labels, benchmark)]
    assert apply(name, *nothing).collect() == []


def test_odd_pages(spark):
    """Nulls, repeats, markup without an end, deep nesting, clashing columns."""
    pages = [
        (None, "http://a.b/c", "<p>x</p>"), (1, None, "<p>y"), (2, "http://a.b/d", None),
        (3, "http://[", ""), (4, "http://a.b/e", "<a " * 300_000), (5, "", "&#" + "9" * 9000 + ";"),
        (6, "http://a.b/f", "<div>" * 100_000 + "deep"), (7, "x", "<p>" + "<b" * 9 + "\n \t" * 99_999),
        (8, "http://a.b/g", "<p>same"), (8, "http://a.b/g", "<p>same"), (9, "y", "z <!-- never <p>q"),
    ]
    schema = "page_id long, url string, html string, host string, path string, keys int, shown int"
    table = spark.createDataFrame([(*x, "h", "p", 1, 2) for x in pages], schema)
    found = {}
    for x in extraction.main_text(table).collect():
        found.setdefault(x["page_id"], []).append((x["url"], x["text"], x["n_chars"]))
    assert {k: [x[1] for x in v] for k, v in found.items()} == {
        None: ["x"], 1: ["y"], 2: [""], 3: [""], 4: [""], 5: ["\ufffd"], 6: ["deep"], 7: [""],
        8: ["same", "same"], 9: ["z"],
    }
    assert all(n == len(text) for v in found.values() for _, text, n in v)
    assert extraction.main_text(table.filter("false")).collect() == []


def test_extraction_takes_linear_time():
    for page in ("<a " * 350_000, "<div>" * 100_000, '<a "' * 250_000, "</p><p>a" * 100_000):
        start = time.perf_counter()
        extraction.all_lines_of(page)
        assert time.perf_counter() - start < 10  # the square would take many minutes


def test_passing_on_all_columns(odd, labels, benchmark):
    for kept in (
        resampling.keep(odd, labels),
        near_duplicates.without_copies(odd),
        suffix_dedup.without_repeats(odd),
        decontamination.clean(odd, benchmark),
    ):
        assert kept.columns == odd.columns
        assert kept.schema["key"].dataType == odd.schema["key"].dataType
        assert {x["row"] for x in kept.collect()} == {"r"}


def documents(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def some_texts(seed, n=60):
    """Texts with copies, near copies and shared passages."""
    rng = random.Random(seed)
    base = [" ".join(rng.choices(WORDS, k=rng.randint(0, 90))) for _ in range(n // 3)]
    out = list(base)
    while len(out) < n:
        words = rng.choice(base).split()
        for _ in range(rng.randint(0, 3)):
            if words:
                words[rng.randrange(len(words))] = rng.choice(WORDS)
        out.append(" ".join(words) + rng.choice(["", " é", "\n", " " + rng.choice(base)[:80]]))
    rng.shuffle(out)
    return out


# --- token counts ----------------------------------------------------------------
def test_token_counts_match_the_tokenizer(spark):
    pieces = token_counts.vocabulary(PIECES)
    every = [("<unk>", 0.0), *pieces, *((f"<0x{b:02X}>", -2e9) for b in range(256))]
    unigram = Tokenizer(models.Unigram(every, unk_id=0, byte_fallback=True))
    unigram.pre_tokenizer = pre_tokenizers.Metaspace(
        replacement="▁", prepend_scheme="always", split=False
    )
    rng = random.Random(1)
    letters = "aab bc▁éß漢字😀́xyz1.  \n\t\r\x0b\u3000"
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 40))) for _ in range(300)]
    texts += ["a\n\nb", "x = 1\n\ty = 2", "    ", " a", "\n", "", "def f(x):\n        return x\n" * 9]
    found = token_counts.token_counts(documents(spark, texts), PIECES)
    expected = [len(unigram.encode(x, add_special_tokens=False).ids) for x in texts]
    assert [x["n_tokens"] for x in found.orderBy("doc_id").collect()] == expected


def test_token_counts_of_long_parts_take_linear_time():
    start = time.perf_counter()
    counter = token_counts.counter(PIECES)
    for text in ("\u1234" * 300_000, "a" * 300_000, "\n" * 300_000, " " * 300_000):
        assert counter.of_text(text)[1] > 0
    assert time.perf_counter() - start < 60  # the square would take many minutes


# --- importance resampling ---------------------------------------------------------
@pytest.mark.parametrize("k", [0, 1, 17, 299, 300, 400])
def test_top_k_is_exact(spark, k):
    keys = [random.Random(2).choice([0.5, 1.5, x / 7]) for x in range(300)]
    scored = spark.createDataFrame(
        [(i, 0.0, float(x)) for i, x in enumerate(keys)], "doc_id long, log_weight double, key double"
    )
    cut = resampling.top_k(scored, k)
    found = scored.filter(resampling.kept(F.col("key"), F.col("doc_id"), cut)).collect()
    expected = sorted(range(300), key=lambda i: (-keys[i], i))[:k]
    assert sorted(x["doc_id"] for x in found) == sorted(expected)


def test_resampling_parts_good_from_bad(spark):
    rng = random.Random(3)
    texts = [
        " ".join(rng.choices(WORDS if i % 4 else ["###", "buy!!", "$$$"], k=40)) for i in range(400)
    ]
    docs = documents(spark, texts)
    labels = docs.filter("doc_id < 200").selectExpr("doc_id", "cast(doc_id % 4 > 0 as int) quality")
    found = resampling.resample(docs, labels).collect()
    assert all(x["kept"] == (x["doc_id"] % 4 > 0) for x in found)
    kept = resampling.keep(docs, labels)
    assert {x["doc_id"] for x in kept.collect()} == {x["doc_id"] for x in found if x["kept"]}


def test_all_labels_count(spark):
    """The level and the target model come from all labels, however many."""
    n = 30_000
    scored = spark.range(n).selectExpr("id as doc_id", "cast(id div 3 as double) as log_weight")
    labels = spark.range(n).selectExpr("id as doc_id", "cast(id >= 600 as int) as quality")
    labels = labels.unionByName(spark.sql("select null as doc_id, 0 as quality union all select 9, null"))
    assert resampling.level(scored, labels) == (199 + 200) / 2 - resampling.MARGIN
    assert resampling.level(scored, labels.filter("quality = 1")) == -np.inf
    docs = spark.range(n).selectExpr("id as doc_id", "concat('w', id) as text")
    good = spark.range(n).selectExpr("id as doc_id", "1 as quality")
    assert not resampling.learn(docs, good).ratio.any()


@pytest.mark.parametrize("seed", range(4))
def test_level_matches_brute_force(spark, seed):
    rng = random.Random(seed)
    rows = [(k, rng.choice([float(rng.randrange(9)), rng.random() * 9])) for k in range(200)]
    marks = [(rng.randrange(220), int(rng.random() < 0.02 * seed * (k % 40))) for k in range(150)]
    of = dict(rows)
    known = [(of[i], q) for i, q in marks if i in of]
    n_good = sum(q for _, q in known)
    n_bad = len(known) - n_good
    edges = sorted({w for w, _ in known})

    def gain(edge):
        below = [q for w, q in known if w < edge]
        return below.count(0) * n_good - resampling.CLEAN * below.count(1) * n_bad

    best = max(range(len(edges)), key=lambda k: (gain(edges[k]), -k))
    expected = (edges[best - 1] + edges[best]) / 2 - resampling.MARGIN
    if not best or not n_good or not n_bad:
        expected = -np.inf
    scored = spark.createDataFrame(rows, "doc_id long, log_weight double").repartition(7)
    labels = spark.createDataFrame(marks, "doc_id long, quality int")
    assert resampling.level(scored, labels) == expected


# --- repeated substrings -------------------------------------------------------------
def brute_cut(texts):
    """Kept bytes, removed bytes and spans of each text."""
    first, out = {}, []
    for text in texts:
        data = (text or "").encode()
        gone = [False] * len(data)
        for k in range(len(data) - 49):
            first.setdefault(data[k : k + 50], len(out))
            if first[data[k : k + 50]] < len(out):
                gone[k : k + 50] = [True] * 50
        kept = bytes(b for b, x in zip(data, gone, strict=True) if not x)
        spans = sum(x and not y for x, y in zip(gone, [False, *gone], strict=False))
        out.append((kept, sum(gone), spans))
    return out


@pytest.mark.parametrize("chunk", [1_000_000, 100])
def test_suffix_dedup_matches_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(suffix_dedup, "CHUNK", chunk)
    texts = [*some_texts(4), "x" * 500, "x" * 60, None, "é" * 40, "aé" + "é" * 40]
    found = suffix_dedup.deduplicated(documents(spark, texts)).orderBy("doc_id").collect()
    expected = brute_cut(texts)
    assert [(x["kept_sha256"], x["n_removed"], x["n_spans"]) for x in found] == [
        (hashlib.sha256(kept).hexdigest(), gone, spans) for kept, gone, spans in expected
    ]
    kept = suffix_dedup.without_repeats(documents(spark, texts)).orderBy("doc_id").collect()
    assert [x["text"] for x in kept] == [
        None if t is None else k.decode(errors="ignore")
        for t, (k, _, _) in zip(texts, expected, strict=True)
    ]


def test_rows_of_a_shared_passage_grow_with_its_documents(spark):
    rng = random.Random(9)
    letters = lambda n: "".join(rng.choices("abcdefgh ij", k=n))
    passage = letters(3000)
    texts = [letters(200) + passage + letters(200) for _ in range(2000)]
    few, many = (suffix_dedup.repeats(documents(spark, texts[:n])).count() for n in (500, 2000))
    assert many < 6 * few and many < 8 * len(texts)


def test_suffix_dedup_holds_little_at_a_time():
    """A task's arrays stay small, whatever its rows, and so do the batches that it gives."""
    rng = np.random.default_rng(5)
    texts = [rng.integers(97, 123, 3_000, np.uint8).tobytes().decode() for _ in range(6_000)]
    rows = [
        pa.record_batch({"doc_id": range(k, k + 500), "text": texts[k : k + 500]})
        for k in range(0, len(texts), 500)
    ]
    keys = [
        pa.array([suffix_dedup._gram_key(suffix_dedup.parse([x.encode()]).gram) for x in of])
        for of in (texts[k : k + 500] for k in range(0, 1_500, 500))
    ]
    carried = [
        pa.record_batch(
            [x.column("doc_id"), compressed([y.encode() for y in x.column("text").to_pylist()]), y],
            ["doc_id", "packed", "keys"],
        )
        for x, y in zip(rows, keys, strict=False)
    ]
    for function, given in ((suffix_dedup._keys, rows), (suffix_dedup._candidates, carried)):
        tracemalloc.start()
        sizes = [x.num_rows for x in function(iter(given))]
        _, peak = tracemalloc.get_traced_memory()
        tracemalloc.stop()
        assert sum(sizes) > 1_000_000
        assert peak < 60e6 and max(sizes) <= 100_000, (function, peak, max(sizes))


# --- near duplicates -----------------------------------------------------------------
def brute_components(texts, size):
    sets = [
        near_duplicates.shingle_set((x or "").lower().encode().split(), size) for x in texts
    ]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, x in enumerate(sets):
        for b, y in enumerate(sets[:a]):
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return [find(x) for x in range(len(texts))], list(map(len, sets))


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates_match_brute_force(spark, monkeypatch, size):
    monkeypatch.setattr(near_duplicates, "CROWD", 2)
    monkeypatch.setattr(near_duplicates, "SLICE", 3)
    monkeypatch.setattr(near_duplicates, "BLOCK", 4)
    texts = [*some_texts(5, 120), "ONE two", "one TWO", None, "", "", "single", "single"]
    found = near_duplicates.near_duplicates(documents(spark, texts), size)
    rows = found.orderBy("doc_id").collect()
    roots, sizes = brute_components(texts, size)
    assert [x["component_id"] for x in rows] == roots
    assert [x["n_shingles"] for x in rows] == sizes
    assert [x["kept"] for x in rows] == [k == x for k, x in enumerate(roots)]


def test_crowds_are_compared_whole(spark):
    """A pair in a region of more than ``CROWD`` strangers, which no longer prefix joins."""
    rng = np.random.default_rng(5)
    n, depth, values = 4200, near_duplicates.DEPTH, near_duplicates.VALUES
    signed = rng.integers(0, 1 << 32, (n, values), dtype=np.uint32)
    signed[1] = signed[0]
    signed[1, ::depth] += 1  # in each tree the pair parts at the first value
    signed[:, :depth] = 7  # but in this one all are in one region
    heads = np.zeros((n, near_duplicates.TREES), np.uint64)
    for k in range(depth):
        heads = near_duplicates.mixed(heads + signed[:, k::depth])
    samples = rng.integers(0, 1 << 32, (n, 50), dtype=np.uint32)
    samples[1] = samples[0]
    samples.sort(axis=1)
    rows = [
        (k, 50, row.tobytes(), row.tobytes()[::4], head.tobytes(), sample.tobytes())
        for k, (row, head, sample) in enumerate(
            zip(signed, heads.astype("<u4"), samples, strict=True)
        )
    ]
    schema = "id long, n long, signature binary, sketch binary, heads binary, sample binary"
    classes = spark.createDataFrame(rows, schema)
    roots = spark.createDataFrame([], "a long, b long")
    members = near_duplicates._members(classes)
    found = near_duplicates._open_pairs(members, roots, classes)
    assert [tuple(x) for x in found.collect()] == [(0, 1)]


def test_components_of_long_paths(spark):
    edges = [(k, k + 1) for k in range(100, 140)] + [(5, 7), (7, 5), (9, 9)]
    found = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {(x["a"], x["b"]) for x in found} == {(k, 100) for k in range(101, 141)} | {(7, 5)}


# --- toxicity, language and quality: held-out accuracy --------------------------------
def test_toxicity_learns_from_confirmed_and_unlabelled(spark):
    rng = random.Random(6)
    texts, toxic = [], []
    for k in range(1500):
        words = rng.choices(WORDS, k=30)
        toxic.append(k % 5 == 0)
        if toxic[-1]:
            words[rng.randrange(30)] = rng.choice(["Vilest,", "scorned!"])
        texts.append(" ".join(words))
    docs = documents(spark, texts)
    labels = docs.selectExpr("doc_id", "cast(doc_id % 5 = 0 as int) toxic").filter("doc_id < 900")
    found = toxicity.score(docs, toxicity.learn(docs, labels))
    rows = found.filter(held_out(F.col("doc_id"))).collect()
    right = [x["predicted"] == toxic[x["doc_id"]] for x in rows]
    assert np.mean(right) > 0.97
    assert all(0 <= x["score"] <= 1 and x["predicted"] == (x["score"] >= 0.5) for x in rows)


def test_language_of_held_out_texts(spark):
    rng = random.Random(7)
    parts = {"aa": ["tor", "mek", "lu"], "bb": ["schi", "wen", "zö"], "cc": ["ña", "quo", "ció"]}
    rows = []
    for k in range(600):
        lang = rng.choice(sorted(parts))
        word = lambda p=parts[lang]: "".join(rng.choices(p, k=3))
        rows.append((k, " ".join(word() for _ in range(12)), lang))
    rows += [(600, None, "aa"), (601, "123 ...", "bb"), (602, "—", "cc")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = {x["doc_id"]: x for x in language.predict(docs, language.learn(docs)).collect()}
    right = [found[k]["lang_pred"] == x for k, _, x in rows if k < 600 and zlib.crc32(str(k).encode()) % 5 == 0]
    assert np.mean(right) > 0.97
    assert {found[k]["lang_pred"] for k in (600, 601, 602)} == {"und"}


def test_labels_of_held_out_rows_change_nothing(spark):
    docs = documents(spark, some_texts(8)).withColumn("lang", F.lit("aa"))
    other = docs.withColumn("lang", F.when(held_out(F.col("doc_id")), "zz").otherwise(F.col("lang")))
    one, two = (language.predict(docs, language.learn(x)).orderBy("doc_id") for x in (docs, other))
    assert one.collect() == two.collect()


def brute_base(text):
    data = (text or "").encode()
    words = data.split()
    covered, windows = set(), defaultdict(list)
    for k in range(len(words) - 7):
        windows[tuple(words[k : k + 8])].append(k)
    for at in windows.values():
        if len(at) > 1:
            covered.update(j for k in at for j in range(k, k + 8))
    lines = [x for x in data.split(b"\n") if x.split()]
    chars = sum(len(w.decode()) for w in words)
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(words), chars, symbols, len(lines) - len(set(lines)), len(covered)


def test_quality_base_counts(spark):
    rng = random.Random(9)
    texts = [None, "", "a#b\n \na#b\n\x0b|c", "  no-break space", "r " * 9, *some_texts(9)]
    texts += [" ".join(rng.choices("ab", k=60)) for _ in range(20)]
    model = quality_rules.Model(np.zeros(1 << 18, np.float32), 0.0, 0.0)
    rows = quality_rules.judge(documents(spark, texts), model).orderBy("doc_id").collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert [tuple(x[n] for n in names) for x in rows] == list(map(brute_base, texts))
    for x in rows:
        failed = x["n_words"] < 20 or 100 * x["n_repeat_words"] > 30 * x["n_words"]
        assert x["base_failed"] == failed and x["kept"] == (not failed)


# --- page differencing ---------------------------------------------------------------
def test_lines_of_pages():
    page = (
        "<head><title>T</title></head><nav>menu<p>x</nav><article><header><h1>A &amp; b</h1></header>"
        "<p><b>one <i>two</i><br>z<p>three<script>if(a<b){'</p>'}</script> four"
        "<div class='comments'><p>c</div></article><footer>f</footer>"
    )
    assert extraction.lines_of(page) == (["A & b", "one two z", "three four"], True)
    assert extraction.lines_of("a &lt;b&gt; 3 < 4<p>x") == (["a <b> 3 < 4", "x"], False)
    assert extraction.lines_of("")[0] == []


def test_common_lines_are_a_longest_common_subsequence():
    rng = random.Random(10)
    for _ in range(200):
        a, b = (rng.sample(range(12), rng.randint(0, 12)) for _ in range(2))
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1, j + 1] = max(
                    table[i, j] + 1 if x == y else 0, table[i, j + 1], table[i + 1, j]
                )
        found = extraction.common(a, b)
        assert len(found) == table[-1, -1]
        places = [b.index(a[k]) for k in found]
        assert places == sorted(places) and found == sorted(found)


def test_shared_lines_go(spark):
    def page(*lines):
        return "".join(f"<p>{x}</p>" for x in ("Our site", *lines, "Contact us"))

    pages = [
        (1, "http://a.example/news/1", page("first story, which is quite long")),
        (2, "http://a.example/news/2?x=1", page("second story, which is quite long")),
        (3, "http://a.example/news/2#top", page("second story, which is quite long")),
        (4, "http://b.example/only", page("lonely")),
        (5, None, None),
        (6, "http://c.example/x", page("a copy of a page, all the same")),
        (7, "http://c.example/y", page("a copy of a page, all the same")),
        (8, "::bad::", ""),
    ]
    docs = spark.createDataFrame(pages, "page_id long, url string, html string")
    rows = {x["page_id"]: x["text"] for x in extraction.main_text(docs).collect()}
    assert rows[1] == "first story, which is quite long"
    assert rows[2] == rows[3] == "second story, which is quite long"
    assert rows[4] == "Our site\nlonely\nContact us"
    assert rows[5] == rows[8] == ""
    assert rows[6] == rows[7] == "Our site\na copy of a page, all the same\nContact us"
    assert extraction.main_text(docs.filter("false")).collect() == []


def test_short_articles_lose_their_boilerplate(spark):
    """Under a menu, a notice and a footer of more text, and beside a page that names its parts."""
    menu = [f"Entry {k} of the menu" for k in range(10)]
    notice = "We keep small files on your device to count visits and to show you this notice. " * 3
    menu_html = "".join(f"<div>{x}</div>" for x in [*menu, notice])
    plain = menu_html + "<p>{0} is a short article.<p>Its second line is on {0}.<div>The end</div>"
    named = (
        f"<nav>{menu_html}<script>x</script></nav><main><p>{{0}}</main><footer>The end</footer>"
    )
    rows = [
        (k, f"http://{host}.org/a/{k}", of.format(name))
        for k, (host, of, name) in enumerate([
            ("a", plain, "Rain"), ("a", plain, "Snow"), ("b", plain, "Wind"), ("b", named, "Hail"),
            ("c", plain, "Frost"), ("c", plain + "<p>More", "Frost"),
        ])
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {x["page_id"]: x["text"] for x in extraction.main_text(pages).collect()}
    short = "{0} is a short article.\nIts second line is on {0}."
    assert [found[k] for k in range(3)] == [short.format(x) for x in ("Rain", "Snow", "Wind")]
    assert found[3] == "Hail"
    assert menu[0] in found[4] and "Frost" in found[4]  # a copy stays whole


def test_named_main_parts_are_differenced_by_blocks(spark):
    """What the design repeats inside ``article`` goes; quotes, teasers and copies stay."""
    quote = "<p>A passage that both articles quote.</p>"
    design = "<div id='top-{k}'><div><p>Read us every day<p>In all towns</div>since 1900</div>"
    page = (
        "<nav>menu</nav><article><h1>{name}</h1>" + design + "<div class='body'><p>All about {name}, "
        "at some length, as such articles are.</p>" + quote + "</div>" + quote
        + "<div>Printed by us</div>{more}</article><div>{other}, in brief</div>"
    )
    body = "<article><div>{0}</div></article>"
    rows = [
        (1, "http://a.org/x/1", page.format(k=1, name="Rain", other="Snow", more="<div>x</div>")),
        (2, "http://a.org/x/2", page.format(k=2, name="Snow", other="Rain", more="<div>Snow, in brief</div>")),
        (3, "http://b.org/x/1", body.format("the same article")),
        (4, "http://b.org/x/2", body.format("the same article")),
        (5, "http://c.org/x/1", "<main><div class=a>Same words</div><p>one, which is long enough</main>"),
        (6, "http://c.org/x/2", "<main><div class=b>Same words</div><p>two, which is long enough</main>"),
        (7, "http://d.org/x/1", "<main><p><div>Alone"),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {x["page_id"]: x["text"] for x in extraction.main_text(pages).collect()}
    said = "A passage that both articles quote."
    about = "{0}\nAll about {0}, at some length, as such articles are.\n" + f"{said}\n{said}\n"
    assert found[1] == about.format("Rain") + "x"
    assert found[2] == about.format("Snow") + "Snow, in brief"
    assert found[3] == found[4] == "the same article"
    assert found[5] == "Same words\none, which is long enough"
    assert found[6] == "Same words\ntwo, which is long enough"
    assert found[7] == "Alone"


def test_blocks_have_the_lines_between_their_tags():
    rng = random.Random(11)
    for _ in range(100):
        html, ends, stack, n = "", [], [], 0
        for _ in range(rng.randint(0, 40)):
            kind = rng.choice("<<>>p")
            if kind == "<":
                stack.append(n)
                html += "<div>"
            elif kind == ">" and stack:
                html += "</div>"
                ends.append((stack.pop(), n))
            elif kind == "p":
                html += f"<p>line {rng.randint(0, 2)}</p>"
                n += 1
        ends += [(start, n) for start in stack[::-1]]
        lines, _, _, blocks = extraction.all_lines_of(f"<main>{html}</main>")
        assert [(b.start, b.end) for b in blocks] == [x for x in ends if x[0] < x[1]]
        kept = extraction.kept_blocks(
            ["long " * 90] * 3 + lines, [b.key for b in blocks],
            [x + 3 for b in blocks for x in (b.start, b.end)], [b.key for b in blocks],
        )
        inside = {k for start, end in ends for k in range(start, end)}
        assert kept[3:] == [x for k, x in enumerate(lines) if k not in inside]


# --- packing ---------------------------------------------------------------------------
def test_token_ids_match_the_tokenizer():
    texts = [x or "" for _, x in ODD] + ["a  b", " a", "a ", "a\x1c b", "a\n b", "don't 'S 12", *some_texts(11)]
    reference = Tokenizer.from_file(BPE)
    for text in texts:
        ids = np.frombuffer(packing.token_ids(BPE, text), np.uint32).tolist()
        assert ids == reference.encode(text, add_special_tokens=False).ids


def test_plan_fills_without_gaps():
    rng = random.Random(12)
    for capacity in (1, 7, 64, 1024):
        histogram = {rng.randint(1, capacity): rng.randint(1, 200) for _ in range(capacity // 2 + 1)}
        placed, sequences = defaultdict(int), defaultdict(list)
        for x in packing.plan(histogram, capacity):
            for r in range(x.last - x.first):
                place = (x.offset + r % x.each * x.length, x.length)
                sequences[x.sequence + r // x.each].append(place)
                placed[x.length] += 1
        assert placed == histogram
        for parts in sequences.values():
            at = 0
            for offset, length in sorted(parts):
                assert offset == at
                at += length
            assert at <= capacity
        rooms, used = [], 0  # best-fit decreasing, one by one
        for length in sorted((x for x, n in histogram.items() for _ in range(n)), reverse=True):
            fits = [r for r in rooms if r >= length]
            used += not fits
            room = min(fits, default=capacity)
            if fits:
                rooms.remove(room)
            rooms.append(room - length)
        assert len(sequences) == used


def test_pieces_of_long_documents(spark, odd):
    rows = packing.pack(odd.filter("doc_id = 4"), BPE).orderBy("piece").collect()
    assert [x["piece"] for x in rows] == list(range(len(rows)))
    assert {x["length"] for x in rows[1:]} == {1024}
    ids = Tokenizer.from_file(BPE).encode(LONG, add_special_tokens=False).ids + [2]
    for x in rows:
        part = np.array(ids[x["start"] : x["start"] + x["length"]], "<u4").tobytes()
        assert x["ids_crc32"] == zlib.crc32(part)
    assert sum(x["length"] for x in rows) == len(ids)


# --- decontamination ---------------------------------------------------------------------
def brute_hits(texts, items):
    split = lambda x: "".join(c if ord(c) > 127 or c.isalnum() else " " for c in (x or "").lower()).split(" ")
    out = []
    for text in texts:
        words, hit, found = [w for w in split(text) if w], set(), set()
        for item, source in items:
            of = [w for w in split(source) if w]
            for k in range(max(1, len(of) - 12) if of else 0):
                window = of[k : k + 13]
                for p in range(len(words) - len(window) + 1):
                    if words[p : p + len(window)] == window:
                        hit.update(range(p, p + len(window)))
                        found.add(item)
        out.append((len(words), len(hit), sorted(found)))
    return out


@pytest.mark.parametrize("block", [1 << 24, 200])
def test_decontamination_matches_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", block)
    texts = [*some_texts(13, 40), "Stone, cloud; GREEN-house", None, ""]
    items = [(k, x) for k, x in enumerate(some_texts(13, 40)[:12])]
    items += [(50, "cloud green"), (51, None), (52, "again"), (53, "AGAIN!")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontamination.contamination(documents(spark, texts), benchmark)
    rows = found.orderBy("doc_id").collect()
    expected = brute_hits(texts, items)
    assert [(x["n_words"], x["n_hit"], x["items"]) for x in rows] == expected
    for x, (n, hit, ids) in zip(rows, expected, strict=True):
        text = ",".join(sorted(map(str, ids)))
        assert x["items_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert x["contaminated"] == (hit > 0 and 20 * hit >= n)


def test_words_are_told_apart_by_their_hashes():
    part = read(["ab a é ab".encode(), b"", b"ab"])
    hashes = part.hashes()
    assert hashes[0] == hashes[3] == hashes[4] and len(set(hashes.tolist())) == 3
    assert part.words.tolist() == [4, 0, 1]


@pytest.mark.parametrize("block", [1 << 24, 200])
def test_rows_are_judged_by_their_own_text(spark, monkeypatch, block):
    """Null and repeated ids, one or several blocks, rows in another order each time."""
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", block)
    rng = random.Random(15)
    items = [" ".join(rng.choices(WORDS, k=20)) for _ in range(20)]
    bad = [f"{x} more words" for x in items]
    good = [" ".join(rng.choices(["other", "words", "entirely"], k=30)) for _ in range(20)]
    rows = [(None, bad[0]), (None, good[0]), (2, bad[1]), (2, good[1]), (3, bad[0]), (3, bad[0])]
    rows += [(k + 9, x) for k, x in enumerate(bad + good)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("row_id", F.lit("r"))
    table = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    kept = decontamination.clean(docs.repartition(7), table)
    assert kept.columns == docs.columns
    expected = sorted([x for x in rows if x[1] in good], key=str)
    assert sorted([(x["doc_id"], x["text"]) for x in kept.collect()], key=str) == expected
    found = decontamination.contamination(docs.repartition(7), table).collect()
    verdicts = sorted([(x["doc_id"], x["n_hit"], x["contaminated"]) for x in found], key=str)
    assert verdicts == sorted([(k, 20 * (x in bad), x in bad) for k, x in rows], key=str)


@pytest.mark.parametrize("blank", [" ", "\n", "\t", " \n", "\u3000"])
def test_long_white_space_has_the_tokenizers_ids(blank):
    tokenizer = Tokenizer.from_file(BPE)
    for text in (f"x{blank * 600_000}a b", blank * 20_000, f"a{blank * 9_990} {blank * 20}b"):
        ids = np.frombuffer(packing.token_ids(BPE, text), "<u4").tolist()
        assert ids == tokenizer.encode(text, add_special_tokens=False).ids


def test_quality_of_held_out_texts(spark):
    """The classifier parts rows that it has not learnt from, and is calibrated on them."""
    rng = random.Random(16)
    junk = "click here now win free prize offer deal cheap".split()
    good = [k % 3 > 0 for k in range(900)]
    texts = [" ".join(rng.choices(WORDS if x else WORDS + 2 * junk, k=60)) for x in good]
    docs = documents(spark, texts)
    labels = docs.selectExpr("doc_id", "cast(doc_id % 3 > 0 as int) quality").filter("doc_id < 450")
    found = quality_rules.judge(docs, quality_rules.learn(docs, labels)).orderBy("doc_id").collect()
    held = [(x["score"], x["kept"], good[x["doc_id"]]) for x in found if x["doc_id"] >= 450]
    assert np.mean([kept == is_good for _, kept, is_good in held]) > 0.95
    sure = [is_good for score, _, is_good in held if score > 0.8]
    assert len(sure) > 100 and np.mean(sure) > 0.9
    poor = [is_good for score, _, is_good in held if score < 0.2]
    assert len(poor) > 50 and np.mean(poor) < 0.1
