from decimal import Decimal

import pytest

from conftest import DAY, plan_of, values
from voltalake import schemas as S
from voltalake.plans import daily, warehouse
from voltalake.sources import warehouse as tables


@pytest.fixture(scope="module")
def processed(spark, sample, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake"))
    daily.run_load(sample, root, DAY)
    return daily.processed_tables(spark, root, DAY)


@pytest.mark.parametrize("mode", ["static", "dynamic"])
def test_load_replaces_the_content(spark, processed, tmp_path, mode):
    database = f"dwh_{mode}"
    tables.create_tables(spark, database, str(tmp_path / "dwh"))
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    try:
        status = tables.load(spark, processed, database)
        assert {r["estado"] for r in status.collect()} == {"ok"}
        fewer = {**processed}
        fewer["transacciones"] = processed["transacciones"].where("fecha_transaccion < '2024-01-07'")
        fewer["clientes"] = processed["clientes"].where("false")
        shifted = fewer["transacciones"].selectExpr("* EXCEPT (mes)", "mes + 1 AS mes")
        fewer["transacciones"] = shifted
        again = dict(values(tables.load(spark, fewer, database), "tabla", "estado"))
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert again["dim_clientes"] == "omitido"
    assert spark.table(f"{database}.dim_clientes").count() == 10
    facts = spark.table(f"{database}.fact_transacciones")
    assert facts.count() == 4
    assert facts.where("mes = 2").count() == 4


def test_types(spark, processed):
    tables.create_tables(spark, "dwh_types")
    described = {
        r["col_name"]: r["data_type"]
        for r in spark.sql("DESCRIBE dwh_types.fact_transacciones_cargas").collect()
    }
    for name, kind in S.WAREHOUSE["fact_transacciones"].items():
        assert described[name] == kind.removesuffix(" not null")
    rows = warehouse.warehouse_rows(processed["transacciones"], "fact_transacciones")
    first = rows.where("id_transaccion = 'TRX-2024-0001'").first()
    assert first["valor_total_cop"] == Decimal("142750000.00")
    assert first["precio_cop_kwh"] == Decimal("285.5000")


def test_number_too_large_becomes_null(spark, processed):
    huge = processed["proveedores"].selectExpr("* EXCEPT (capacidad_mw)", "1e15D AS capacidad_mw")
    rows = warehouse.warehouse_rows(huge, "dim_proveedores")
    assert set(values(rows, "capacidad_mw")) == {(None,)}


def test_numbers_at_the_limit_are_counted_as_the_cast_has_them(spark, processed):
    near = [1e10, 1e10 - 0.004, 1e10 - 0.006, 1e10 - 1, 1e10 - 2, -1e10, -1e10 + 0.006, 0.0, None]
    near += [float("nan"), float("inf"), float("-inf"), 1e300, 1e10 + 5]
    rows = spark.createDataFrame([(x,) for x in near], "capacidad_mw double")
    table = processed["proveedores"].limit(1).drop("capacidad_mw").crossJoin(rows)
    lost = warehouse.warehouse_rows(table, "dim_proveedores").where("capacidad_mw IS NULL").count() - 1
    assert tables.checked(table, "dim_proveedores") == lost > 0


def test_text_too_long_fails_the_load(spark, processed):
    tables.create_tables(spark, "dwh_long")
    wide = processed["proveedores"].selectExpr(
        "* EXCEPT (pais_origen)", "repeat('x', 101) AS pais_origen"
    )
    with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH"):
        tables.load(spark, {**processed, "proveedores": wide}, "dwh_long")


def test_failed_load_leaves_all_content(spark, processed):
    tables.create_tables(spark, "dwh_kept")
    tables.load(spark, processed, "dwh_kept")
    for column, value in (("id_transaccion", "repeat('x', 101)"), ("id_transaccion", "NULL")):
        wide = processed["transacciones"].selectExpr(
            f"* EXCEPT ({column})", f"CAST({value} AS STRING) AS {column}"
        )
        with pytest.raises(ValueError, match=column):
            tables.load(spark, {**processed, "transacciones": wide}, "dwh_kept")
        assert spark.table("dwh_kept.fact_transacciones").count() == 15
        assert spark.table("dwh_kept.dim_proveedores").count() == 10


def test_load_counts_numbers_that_do_not_fit(spark, processed):
    tables.create_tables(spark, "dwh_lost")
    huge = processed["proveedores"].selectExpr("* EXCEPT (capacidad_mw)", "1e15D AS capacidad_mw")
    status = tables.load(spark, {**processed, "proveedores": huge}, "dwh_lost")
    assert dict(values(status, "tabla", "no_caben"))["dim_proveedores"] == 10


def test_facts_are_gathered_by_month_and_split_if_large(processed):
    rows = warehouse.warehouse_rows(processed["transacciones"], "fact_transacciones")
    plan = plan_of(tables.laid_out(rows, "fact_transacciones"))
    assert "REBALANCE_PARTITIONS_BY_COL" in plan


def test_a_load_that_fails_midway_leaves_all_content(spark, processed, monkeypatch):
    tables.create_tables(spark, "dwh_midway")
    tables.load(spark, processed, "dwh_midway")
    before = {t: values(spark.table(f"dwh_midway.{t}")) for t in S.WAREHOUSE}
    append = tables._append
    done = []

    def failing(rows, database, table, lot):
        if len(done) == 3:
            raise RuntimeError("lost")
        done.append(table)
        append(rows, database, table, lot)

    fewer = {name: rows.limit(1) for name, rows in processed.items()}
    with monkeypatch.context() as patched:
        patched.setattr(tables, "_append", failing)
        with pytest.raises(RuntimeError, match="lost"):
            tables.load(spark, fewer, "dwh_midway")
    assert {t: values(spark.table(f"dwh_midway.{t}")) for t in S.WAREHOUSE} == before
    # The next load drops what that one left behind.
    for _ in range(3):
        tables.load(spark, fewer, "dwh_midway")
    for table in S.WAREHOUSE:
        assert spark.table(f"dwh_midway.{table}").count() == 1
        assert spark.table(f"dwh_midway.{table}_cargas").select("lote").distinct().count() == 2


def test_only_the_shown_load_is_read(spark, processed):
    tables.create_tables(spark, "dwh_pruned")
    for _ in range(2):
        tables.load(spark, processed, "dwh_pruned")
    plan = plan_of(spark.table("dwh_pruned.fact_transacciones").where("anio = 2024"))
    assert "PartitionFilters: [isnotnull(lote" in plan and "subquery" in plan.lower()


def test_stored_views_equal_the_functions(spark, processed):
    tables.create_tables(spark, "dwh_views")
    tables.load(spark, processed, "dwh_views")
    margin = warehouse.margin_view(spark.table("dwh_views.agg_metricas_energia"))
    summary = warehouse.daily_summary_view(spark.table("dwh_views.fact_transacciones"))
    for name, expected in (("v_margen_energia", margin), ("v_resumen_diario", summary)):
        found = spark.table(f"dwh_views.{name}")
        assert found.dtypes == expected.dtypes
        assert sorted(values(found), key=str) == sorted(values(expected), key=str)
