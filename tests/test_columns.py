import random
from datetime import date

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import values
from voltalake.functions import columns as C
from voltalake.functions import exact
from voltalake.functions.exact import exact_avg, exact_sum


def apply(spark, function, inputs, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    return [row[0] for row in df.orderBy("i").select(function(F.col("v"))).collect()]


def test_volume_band_edges(spark):
    kwh = [999.99, 1000.0, 100000.0, 100000.01, None]
    expected = ["pequeña", "mediana", "mediana", "grande", None]
    assert apply(spark, C.volume_band, kwh, "double") == expected


def test_day_takes_only_the_iso_form(spark):
    texts = ["2024-02-29", "2023-02-29", "31/12/2024", "2024-1-5", "", None]
    assert apply(spark, C.day, texts) == [date(2024, 2, 29), None, None, None, None, None]


def test_numbers_and_flags_that_do_not_parse_are_null(spark):
    assert apply(spark, C.number, ["1.5", " 2 ", "n/d", "", None]) == [1.5, 2.0, None, None, None]
    assert apply(spark, C.flag, ["true", "false", "quizas", None]) == [True, False, None, None]


def test_mask_shows_the_last_four_characters(spark):
    ids = ["900123456-1", "1234", "abc", None]
    assert apply(spark, C.masked, ids) == ["****56-1", "****1234", "****abc", None]


def test_title_case_is_per_blank_separated_word(spark):
    names = [" bogotá ", "SANTA marta", "s.a. bogotá-cali"]
    assert apply(spark, C.tidy_title, names) == ["Bogotá", "Santa Marta", "S.a. Bogotá-cali"]


def test_tidy_keeps_tabs(spark):
    assert apply(spark, C.tidy, ["  a\t ", "b"]) == ["a\t", "b"]


def test_percentage_over_zero_is_null(spark):
    df = spark.createDataFrame([(5.0, 4.0), (5.0, 0.0), (None, 2.0)], "v double, m double")
    assert [r[0] for r in df.select(C.pct_over(F.col("v"), F.col("m"))).collect()] == [
        25.0, None, None,
    ]


ODD_NUMBERS = [
    0.0, -0.0, 0.005, -0.005, 0.015, 1.005, 2.675, -2.675, 1e9, 1e9 - 0.01, 999999999.99, -1e9, 0.1 + 0.2,
    1e10 - 0.005, 1e10 + 0.005, 123456789.125, 1e15 + 0.5, 1e17, -1e21, 1e22, 1e300, 4.35, -0.001, 1e-9,
    float("nan"), float("inf"), float("-inf"), None,
]


def test_rounded_is_round(spark):
    rng = random.Random(7)
    numbers = ODD_NUMBERS + [
        value * sign
        for k in range(4000)
        for value in (rng.random() * 10 ** (k % 16), rng.randint(0, 10 ** (k % 14)) / 1000)
        for sign in (1, -1)
    ]
    df = spark.createDataFrame([(x,) for x in numbers], "v double")
    found = df.select(C.rounded(F.col("v")), F.round("v", 2), "v").collect()
    assert [x for x in found if str(x[0]) != str(x[1])] == []  # with the sign of a zero


def test_totals_are_those_of_the_parts(spark):
    rng = random.Random(8)
    groups = [[x] for x in ODD_NUMBERS] + [[None, None], [0.1, None, 1e9, 0.125]]
    for k in range(200):
        kinds = (rng.randint(-10**8, 10**13) / 100, rng.random() * 10**k, float(rng.randint(0, 10**12)))
        groups.append([rng.choice(kinds[: 1 + k % 3]) * rng.choice((1, -1)) for _ in range(k % 7)])
    groups.append([999999999.99] * 3000 + [-0.01])
    rows = [(k, x) for k, group in enumerate(groups) for x in group]
    df = spark.createDataFrame(rows, "k int, v double").repartition(1, "k")
    v = F.col("v")
    found = df.groupBy("k").agg(
        exact.decimal_total(v), F.sum(exact.decimal_part(v)),
        exact.double_total(v), F.sum(exact.double_part(v)),
    )
    assert found.dtypes[1][1] == found.dtypes[2][1]
    assert [x for x in found.collect() if str(x[1:4:2]) != str(x[2:5:2])] == []


def test_exact_sum_keeps_values_without_a_decimal_form(spark):
    df = spark.createDataFrame([(1e30,), (0.1,), (None,)], "v double")
    assert df.agg(exact_sum(F.col("v"))).first()[0] == pytest.approx(1e30)
    infinite = spark.createDataFrame([(float("inf"),), (1.0,)], "v double")
    assert infinite.agg(exact_sum(F.col("v"))).first()[0] == float("inf")
    empty = df.where("v IS NULL")
    assert values(empty.agg(exact_sum(F.col("v")), exact_avg(F.col("v")))) == [(None, None)]


@settings(max_examples=8, deadline=None)
@given(cents=st.lists(st.integers(-10**12, 10**12), min_size=1, max_size=60))
def test_exact_sum_does_not_depend_on_the_partitioning(spark, cents):
    df = spark.createDataFrame([(c / 100,) for c in cents], "v double")
    sums = {
        df.repartition(n).agg(exact_sum(F.col("v"))).first()[0] for n in (1, 3)
    }
    assert sums == {sum(cents) / 100}


def test_exact_sum_keeps_small_digits(spark):
    df = spark.range(100_000).selectExpr("4e-7D AS v")
    assert df.agg(exact_sum(F.col("v"))).first()[0] == pytest.approx(0.04)
    mixed = df.unionByName(spark.createDataFrame([(1e9,), (0.25,)], "v double"))
    found = [mixed.repartition(n).agg(exact_sum(F.col("v"))).first()[0] for n in (1, 50)]
    assert found == [pytest.approx(1e9 + 0.29, abs=1e-9)] * 2
