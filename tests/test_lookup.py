import random

import pytest
from pyspark.sql import functions as F

from conftest import plan_of, values
from voltalake.operators import lookup


def brute_force(left, right, null_safe):
    joined = []
    for row in left:
        matches = [
            other for other in right
            if (row[1] == other[0] if row[1] is not None and other[0] is not None
                else null_safe and row[1] is None and other[0] is None)
        ]
        joined += [(*row, *other) for other in matches] or [(*row, None, None)]
    return sorted(joined, key=repr)


@pytest.fixture(scope="module")
def tables(spark):
    """A key holds over a third of the rows; keys are missing on either side."""
    chooser = random.Random(5)
    left = [(i, chooser.choice(["hot", "hot", "a", "b", "c", None])) for i in range(300)]
    right = [("hot", 1), ("hot", 2), ("a", 3), ("z", 4), (None, 5)]
    return (
        left,
        right,
        spark.createDataFrame(left, "id int, k string"),
        spark.createDataFrame(right, "name string, v int"),
    )


@pytest.mark.parametrize("null_safe", [False, True])
@pytest.mark.parametrize("limit", [0, lookup.BROADCAST_BYTES])
def test_both_forms_equal_brute_force(tables, null_safe, limit):
    left, right, left_df, right_df = tables
    joined = lookup.lookup_join(
        left_df, right_df, "k", "name", spread_by="id", null_safe=null_safe,
        max_broadcast_bytes=limit,
    )
    assert sorted(values(joined), key=repr) == brute_force(left, right, null_safe)
    assert joined.columns == ["id", "k", "name", "v"]


def test_the_measured_size_decides(tables):
    _, _, left, right = tables
    size = lookup.measured_bytes(right.where("name IS NOT NULL"))

    def salted(limit):
        joined = lookup.lookup_join(
            left, right, "k", "name", spread_by="id", max_broadcast_bytes=limit
        )
        return "_left_salt" in plan_of(joined, "extended")

    assert not salted(size) and salted(size - 1)


@pytest.mark.parametrize("hot", ["hot", None])
def test_no_task_holds_a_hot_key_whole(spark, hot):
    """Two thirds of the rows have one key; the tasks still get even shares."""
    left = spark.range(6000).selectExpr(
        "id", f"CASE WHEN id % 3 < 2 THEN {repr(hot) if hot else 'NULL'} ELSE 'k' || id END AS k"
    )
    right = spark.range(6000).selectExpr("'k' || id AS name", "id AS v")
    unchanged = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {key: spark.conf.get(key) for key in unchanged}
    for key, value in unchanged.items():
        spark.conf.set(key, value)
    try:
        joined = lookup.lookup_join(
            left, right, "k", "name", spread_by="id", max_broadcast_bytes=0
        )
        assert "SortMergeJoin" in plan_of(joined)
        shares = joined.groupBy(F.spark_partition_id().alias("task")).count().collect()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert sum(row["count"] for row in shares) == 6000
    assert max(row["count"] for row in shares) < 6000 * 0.4


def test_which_keys_are_hot_changes_nothing(tables, monkeypatch):
    left, right, left_df, right_df = tables
    for chosen in ([], [("a", 5), ("absent", 3)], [(None, 7), ("hot", 1)]):
        monkeypatch.setattr(lookup, "hot_keys", lambda *_: chosen)
        joined = lookup.lookup_join(
            left_df, right_df, "k", "name", spread_by="id", null_safe=True, max_broadcast_bytes=0
        )
        assert sorted(values(joined), key=repr) == brute_force(left, right, True)


def test_hot_keys_fill_more_than_a_task(spark):
    rows = spark.createDataFrame(
        [("a",)] * 50 + [(None,)] * 30 + [("b",)] * 10 + [(str(i),) for i in range(10)], "k string"
    )
    assert lookup.hot_keys(rows, "k", 10) == [("a", 5), (None, 3)]
    assert lookup.hot_keys(rows, "k", 1) == []
    assert lookup.hot_keys(rows.where("false"), "k", 10) == []


def test_measured_bytes_counts_text_and_rows(spark):
    df = spark.createDataFrame([("añb", 1), (None, 22)], "t string, n int")
    assert lookup.measured_bytes(df) == 4 + 1 + 2 + 2 * 16
    assert lookup.measured_bytes(df.where("n > 99")) == 0
