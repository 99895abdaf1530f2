"""The sample files through the whole lake, against known results."""

from datetime import date
from decimal import Decimal

import pytest

from conftest import DAY, values
from voltalake import schemas as S
from voltalake.operators import integrate
from voltalake.plans import analytics, daily, warehouse


@pytest.fixture(scope="module")
def lake(spark, sample, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake"))
    counts = daily.run_load(sample, root, DAY)
    return root, counts, daily.processed_tables(spark, root, DAY)


@pytest.fixture(scope="module")
def results(lake):
    return analytics.run_queries(lake[2], DAY)


def test_counts_of_the_load(lake):
    assert dict(values(lake[1], "tabla", "filas")) == {
        "proveedores": 10, "clientes": 10, "transacciones": 15,
        "metricas_energia": 6, "metricas_segmento": 3,
    }


def test_declared_schemas(lake):
    for name, table in lake[2].items():
        assert table.dtypes == list(S.PROCESSED[name].items())


def test_bands_and_averages(lake):
    trades = lake[2]["transacciones"]
    assert dict(values(integrate.band_counts(trades))) == {
        "grande": 8, "mediana": 4, "pequeña": 3
    }
    assert set(values(trades, "tipo_energia", "precio_promedio_tipo_energia")) == {
        ("eolica", 347.75), ("hidroelectrica", 312.0), ("nuclear", 316.38),
    }


def test_energy_metrics(lake):
    rows = lake[2]["metricas_energia"].drop("_fecha_ingesta", "_tipo_metrica")
    assert sorted(values(rows)) == [
        ("eolica", "compra", 3, 1_000_000.0, 283_910_000.0, 284.5, 278.0, 290.0),
        ("eolica", "venta", 3, 1_040.0, 426_980.0, 411.0, 408.0, 415.0),
        ("hidroelectrica", "compra", 3, 2_550_000.0, 661_500_000.0, 259.0, 255.0, 262.0),
        ("hidroelectrica", "venta", 2, 107_000.0, 41_831_000.0, 391.5, 388.0, 395.0),
        ("nuclear", "compra", 2, 2_300_000.0, 475_900_000.0, 207.75, 205.0, 210.5),
        ("nuclear", "venta", 2, 23_500.0, 10_020_000.0, 425.0, 420.0, 430.0),
    ]


def test_segment_metrics(lake):
    rows = lake[2]["metricas_segmento"].drop("_fecha_ingesta")
    assert sorted(values(rows)) == [
        ("comercial", "nuclear", 2, 23_500.0, 10_020_000.0, 5_010_000.0, "por_segmento"),
        ("industrial", "hidroelectrica", 2, 107_000.0, 41_831_000.0, 20_915_500.0, "por_segmento"),
        ("residencial", "eolica", 3, 1_040.0, 426_980.0, 142_326.67, "por_segmento"),
    ]


def test_purchases_find_their_supplier(lake):
    tables = lake[2]
    joined = integrate.supplier_purchases(tables["transacciones"], tables["proveedores"])
    assert joined.count() == 8
    assert joined.where("nombre_proveedor IS NULL").isEmpty()


def test_q1(results):
    assert values(results["q1"]) == [
        ("hidroelectrica", 3, 2_550_000.0, 661_500_000.0, 259.0),
        ("eolica", 3, 1_000_000.0, 283_910_000.0, 284.5),
        ("nuclear", 1, 800_000.0, 168_400_000.0, 210.5),
    ]


def test_q2(results):
    rows = values(results["q2"], "cliente", "num_compras", "total_kwh_consumido",
                  "clasificacion_volumen")
    assert rows == [
        ("Textiles Modernos Ltda.", 1, 62_000.0, "mediana"),
        ("Industrias Metálicas S.A.", 1, 45_000.0, "mediana"),
        ("Hotel Grand Palace", 1, 15_000.0, "mediana"),
        ("Supermercados El Ahorro", 1, 8_500.0, "mediana"),
        ("Jean Pierre Dupont", 1, 410.0, "pequeña"),
    ]


def test_q3(results):
    assert values(results["q3"]) == [
        ("eolica", "mayorista", "compra", 284.5, 278.0, 290.0, 3),
        ("eolica", "minorista", "venta", 411.0, 408.0, 415.0, 3),
        ("hidroelectrica", "mayorista", "compra", 259.0, 255.0, 262.0, 3),
        ("hidroelectrica", "minorista", "venta", 391.5, 388.0, 395.0, 2),
        ("nuclear", "mayorista", "compra", 210.5, 210.5, 210.5, 1),
        ("nuclear", "minorista", "venta", 425.0, 420.0, 430.0, 2),
    ]


def test_q4(results):
    assert values(results["q4"]) == [
        ("TRX-2024-0011", "compra", "AtomEnergy Inc.", 1_500_000.0, 307_500_000.0, "nuclear",
         date(2024, 1, 10), 5),
    ]


def test_q5(results):
    assert values(results["q5"]) == [
        ("nuclear", 210.5, 425.0, 214.5, 101.9, 800_000.0, 23_500.0),
        ("hidroelectrica", 259.0, 391.5, 132.5, 51.16, 2_550_000.0, 107_000.0),
        ("eolica", 284.5, 411.0, 126.5, 44.46, 1_000_000.0, 1_040.0),
    ]


def test_q6(results):
    assert values(results["q6"], "segmento", "ciudad", "num_clientes", "consumo_total_kwh") == [
        ("comercial", "Cartagena", 1, 15_000.0),
        ("comercial", "Barranquilla", 1, 8_500.0),
        ("industrial", "Pereira", 1, 62_000.0),
        ("industrial", "Medellín", 1, 45_000.0),
        ("industrial", "Santa Marta", 1, 38_000.0),
        ("residencial", "Bogotá", 2, 760.0),
        ("residencial", "Bucaramanga", 1, 320.0),
        ("residencial", "Cali", 1, 280.0),
        ("residencial", "Manizales", 1, 190.0),
    ]


def test_q7(results):
    names = [r[0] for r in values(results["q7"], "nombre_proveedor")]
    assert len(names) == 9 and "SolarPeak Ltd." not in names
    assert (names[0], names[-1]) == ("AtomEnergy Inc.", "VientoNorte Ltda.")


def test_margin_view(lake):
    rows = warehouse.warehouse_rows(lake[2]["metricas_energia"], "agg_metricas_energia")
    margins = {
        r["tipo_energia"]: (r["precio_compra_kwh"], r["margen_cop_kwh"], r["margen_pct"])
        for r in warehouse.margin_view(rows).collect()
    }
    assert margins == {
        "nuclear": (Decimal("207.7500"), Decimal("217.2500"), Decimal("104.57")),
        "hidroelectrica": (Decimal("259.0000"), Decimal("132.5000"), Decimal("51.16")),
        "eolica": (Decimal("284.5000"), Decimal("126.5000"), Decimal("44.46")),
    }


def test_daily_summary_view(lake):
    facts = warehouse.warehouse_rows(lake[2]["transacciones"], "fact_transacciones")
    days = values(warehouse.daily_summary_view(facts))
    assert len(days) == 14
    assert days[0] == (date(2024, 1, 12), "hidroelectrica", "compra", 1, Decimal("750000.00"),
                       Decimal("196500000.00"), Decimal("262.0000"))


def test_second_run_replaces_the_first(spark, sample, lake):
    daily.run_load(sample, lake[0], DAY)
    assert daily.processed_tables(spark, lake[0], DAY)["transacciones"].count() == 15


def test_unknown_query_is_an_error():
    assert analytics.selected("q1, q3") == ["q1", "q3"]
    assert analytics.selected() == ["q1", "q2", "q3", "q4", "q5", "q6", "q7"]
    with pytest.raises(ValueError, match="q9"):
        analytics.selected("q1,q9")


def test_margin_needs_deals_on_both_sides(spark):
    rows = [
        ("eolica", "compra", "completada", 2.0, 1.0), ("eolica", "venta", "pendiente", 3.0, 1.0),
        ("nuclear", "compra", "completada", 0.0, 1.0), ("nuclear", "venta", "completada", 3.0, 1.0),
        (None, "compra", "completada", 2.0, 1.0), (None, "venta", "completada", 3.0, 1.0),
    ]
    trades = spark.createDataFrame(
        rows,
        "tipo_energia string, tipo_transaccion string, estado string, precio_cop_kwh double, "
        "cantidad_kwh double",
    )
    assert values(analytics.margins(trades)) == [("nuclear", 0.0, 3.0, 3.0, None, 1.0, 1.0)]
