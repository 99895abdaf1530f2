"""Each stage of the pipeline against brute force on what the stage before kept."""

from pathlib import Path

import pytest

import corpus_pipeline
from test_operators import brute_components, brute_cut

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="driver tables not present")


@pytest.fixture(scope="module")
def stages(spark):
    """Input of the first stage and output of each, in order of id."""
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = rows.columns
    out = [rows.orderBy("doc_id").collect()]
    for k, (_, function) in enumerate(corpus_pipeline.STAGES):
        rows = corpus_pipeline.stage(function(spark, rows, FOLDER), "tested")
        assert rows.columns == columns or k == 4
        out.append(rows.orderBy("doc_id").collect())
    yield out
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_quality_rejects_poor_and_keeps_clean(spark, stages):
    kept = {x["doc_id"] for x in stages[1]}
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").collect()
    good = [x["doc_id"] in kept for x in labels if x["quality"] == 1]
    poor = [x["doc_id"] in kept for x in labels if x["quality"] == 0]
    assert sum(good) >= 0.98 * len(good) and sum(poor) <= 0.5 * len(poor)


def test_one_of_each_group_stays(stages):
    ids = [x["doc_id"] for x in stages[1]]
    roots, _ = brute_components([x["text"] for x in stages[1]], 5)
    expected = [x for k, x in enumerate(ids) if roots[k] == k]
    assert [x["doc_id"] for x in stages[2]] == expected


def test_repeats_are_cut(stages):
    expected = [kept.decode(errors="ignore") for kept, _, _ in brute_cut([x["text"] for x in stages[2]])]
    assert [x["text"] for x in stages[3]] == expected
    assert all(x["n_chars"] == len(x["text"]) for x in stages[3])


def test_contaminated_documents_go(spark, stages):
    split = lambda x: "".join(c if ord(c) > 127 or c.isalnum() else " " for c in x.lower()).split(" ")
    words = lambda x: [w for w in split(x) if w]
    windows = {
        tuple(of[k : k + 13])
        for x in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()
        for of in [words(x["text"])]
        for k in range(max(1, len(of) - 12) if of else 0)
    }
    sizes = {len(x) for x in windows}
    clean = []
    for x in stages[3]:
        of, hit = words(x["text"]), set()
        for n in sizes:
            for p in range(len(of) - n + 1):
                if tuple(of[p : p + n]) in windows:
                    hit.update(range(p, p + n))
        if not hit or 20 * len(hit) < len(of):
            clean.append(x["doc_id"])
    assert [x["doc_id"] for x in stages[4]] == clean


def test_all_documents_are_packed(stages):
    assert {x["doc_id"] for x in stages[5]} == {x["doc_id"] for x in stages[4]}
    used = {}
    for x in stages[5]:
        used[x["sequence_id"]] = used.get(x["sequence_id"], 0) + x["length"]
    assert max(used.values()) <= 1024


def test_stages_take_empty_tables_and_odd_rows(spark):
    """Nulls in all columns, blank and long texts, repeats; each stage gets what the last kept."""
    schema = spark.read.parquet(f"{FOLDER}/documents.parquet").schema
    assert schema.names == ["doc_id", "text", "lang", "source", "n_chars"]
    good = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(20).collect()
    rows = [tuple(x) for x in good] + [
        (None, None, None, None, None), (None, good[0]["text"], None, None, 1),
        (5_001, "", "en", "s", 0), (5_002, " \n" * 400_000, "en", "s", 800_000),
        (5_003, "word " * 60_000, "en", "s", 300_000), (5_004, "\u6f22\U0001f600 x", None, "s", 4),
        (5_005, good[1]["text"], "en", "s", 1), (5_005, good[1]["text"], "en", "s", 1),
    ]
    try:
        for start in ([], rows):
            docs = spark.createDataFrame(start, schema)
            for k, (name, function) in enumerate(corpus_pipeline.STAGES):
                docs = corpus_pipeline.stage(function(spark, docs, FOLDER), "odd")
                assert docs.columns == schema.names or k == 4, name
                assert docs.count() > 0 or not start, name
            if not start:
                assert docs.count() == 0
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
