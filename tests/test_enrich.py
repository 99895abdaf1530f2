from pyspark.sql import functions as F

from conftest import DAY, plan_of, values
from voltalake import schemas as S
from voltalake.operators import enrich
from voltalake.plans import star

_STATS = (
    "id_transaccion", "precio_promedio_tipo_energia", "sobre_precio_promedio",
    "desviacion_precio_pct",
)


def priced(spark, rows):
    schema = "id_transaccion string, tipo_energia string, precio_cop_kwh double"
    return spark.createDataFrame(rows, schema)


def test_dirty_transactions(dirty):
    table = enrich.enrich_transactions(dirty["transacciones"], DAY)
    assert [n for n, _ in table.dtypes] == list(S.PROCESSED["transacciones"])
    assert table.dtypes == list(S.PROCESSED["transacciones"].items())
    rows = {r["id_transaccion"]: r for r in table.collect()}
    assert len(rows) == 5
    assert rows["TRX-001"]["valor_total_cop"] == 142_750_000.0
    assert rows["TRX-001"]["precio_promedio_tipo_energia"] == 347.75
    assert rows["TRX-001"]["sobre_precio_promedio"] is False
    assert rows["TRX-002"]["sobre_precio_promedio"] is True
    assert rows["TRX-002"]["desviacion_precio_pct"] == 17.9
    assert rows["TRX-005"]["tipo_transaccion"] == "compra"
    assert rows["TRX-005"]["nombre_cliente_proveedor"] == "NuclearPower"
    bands = {k: r["clasificacion_volumen"] for k, r in rows.items()}
    assert bands == {
        "TRX-001": "grande", "TRX-002": "pequeña", "TRX-003": "grande",
        "TRX-004": "mediana", "TRX-005": "grande",
    }
    first = rows["TRX-001"]
    assert (first["anio"], first["mes"], first["dia_semana"]) == (2024, 1, 6)


def test_average_is_taken_after_the_deduplication(raw):
    def row(key, price):
        return (key, "compra", "x", "10", price, "eolica", "2024-01-05", "completada", "mayorista")

    rows = raw("transacciones", [row("1", "1"), row("1", "1"), row("2", "4")])
    table = enrich.enrich_transactions(rows, DAY)
    assert {r[0] for r in values(table, "precio_promedio_tipo_energia")} == {2.5}


def test_broadcast_salted_and_window_forms_agree(spark):
    energies = ["eolica"] * 60 + ["nuclear", None, "otro", "otro"] * 10
    rows = priced(
        spark, [(str(i), e, None if i % 17 == 0 else i * 1.37) for i, e in enumerate(energies)]
    )
    averages = enrich.price_averages(rows)
    by_broadcast = enrich.with_price_stats(rows, averages)
    by_salt = enrich.with_price_stats(rows, averages, max_broadcast_bytes=0)
    by_window = enrich.with_price_stats_by_window(rows)
    expected = sorted(values(by_window, *_STATS))
    assert sorted(values(by_broadcast, *_STATS)) == expected
    assert sorted(values(by_salt, *_STATS)) == expected
    assert len(expected) == 100


def test_zero_average_has_no_deviation(spark):
    rows = priced(spark, [("1", "eolica", -1.0), ("2", "eolica", 1.0)])
    table = enrich.with_price_stats(rows, enrich.price_averages(rows))
    assert sorted(values(table, *_STATS)) == [("1", 0.0, False, None), ("2", 0.0, True, None)]


def test_comparison_moves_no_transactions(spark):
    rows = priced(spark, [("1", "eolica", 1.0)])
    plan = plan_of(enrich.with_price_stats(rows, enrich.price_averages(rows)))
    assert "BroadcastHashJoin" in plan
    assert "Window" not in plan and "SortMergeJoin" not in plan


def test_deduplication_limits_groups_before_the_shuffle(dirty):
    plan = plan_of(enrich.clean_transactions(dirty["transacciones"]), "simple")
    before_shuffle = plan[plan.index("Exchange hashpartitioning"):]
    assert "WindowGroupLimit" in before_shuffle


def test_flag_agrees_with_the_sign_of_the_deviation(dirty):
    table = enrich.enrich_transactions(dirty["transacciones"], DAY)
    assert table.where(F.col("sobre_precio_promedio") & (F.col("desviacion_precio_pct") <= 0)).isEmpty()


def test_derived_columns_are_not_staged(spark, sample, tmp_path):
    """The clean rows are written and read for the averages; what follows from a row is not."""
    enrich.enrich_transactions(sample["transacciones"], DAY, str(tmp_path))
    staged = spark.read.parquet(f"{tmp_path}/transacciones")
    assert staged.columns == list(S.RAW_COLUMNS["transacciones"])


def test_orders_meet_customers_before_items(spark, tmp_path):
    """Or all items are shuffled by customer once more."""
    tables = {
        "lineitem": "1L l_orderkey, 1 l_linenumber, 2L l_suppkey, 3L l_partkey, 2.0D l_quantity, "
        "'O' l_linestatus, 'R' l_returnflag, DATE'2024-01-05' l_shipdate",
        "orders": "1L o_orderkey, 4L o_custkey, 'F' o_orderstatus, '1-URGENT' o_orderpriority",
        "customer": "4L c_custkey, 'Ana' c_name",
        "supplier": "2L s_suppkey, 'Sol' s_name",
        "part": "3L p_partkey, 5 p_size, 300.5D p_retailprice",
    }
    for name, columns in tables.items():
        spark.sql(f"SELECT {columns}").write.parquet(f"{tmp_path}/{name}.parquet")
    rows = star.raw_transactions(spark, str(tmp_path))
    assert [x["nombre_cliente_proveedor"] for x in rows.collect()] == ["Sol "]
    plan = plan_of(rows, "extended")
    joins = [x for x in plan.split("Optimized Logical Plan")[1].split("\n") if "Join Inner" in x]
    by_order, by_customer = (
        next(k for k, x in enumerate(joins) if name in x) for name in ("o_orderkey", "o_custkey")
    )
    assert by_order < by_customer
