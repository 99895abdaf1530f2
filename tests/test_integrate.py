from pyspark.sql import functions as F

from conftest import DAY, values
from voltalake import schemas as S
from voltalake.functions.exact import exact_avg, exact_sum
from voltalake.operators import enrich, integrate
from voltalake.operators.normalize import normalize_customers, normalize_suppliers


def sales(raw, rows):
    full = [
        (key, "venta", name, kwh, price, energy, "2024-01-05", "completada", "minorista")
        for key, name, kwh, price, energy in rows
    ]
    return enrich.derived(enrich.clean_transactions(raw("transacciones", full)))


def customers(raw, rows):
    full = [
        ("CC", str(i), name, "cali", segment, "2020-01-01", "10")
        for i, (name, segment) in enumerate(rows)
    ]
    return normalize_customers(raw("clientes", full), DAY, DAY)


def metrics_from_detail(transactions, people):
    """The same metrics, aggregated from the joined rows."""
    kwh, cop = F.col("cantidad_kwh"), F.col("valor_total_cop")
    return (
        integrate.customer_sales(transactions, people)
        .where("segmento IS NOT NULL")
        .groupBy("segmento", "tipo_energia")
        .agg(
            F.count(F.lit(1)),
            F.round(exact_sum(kwh), 2),
            F.round(exact_sum(cop), 2),
            F.round(exact_avg(cop), 2),
        )
    )


def test_names_shared_by_customers_count_once_per_holder(raw):
    trades = sales(raw, [
        (str(i), name, kwh, price, energy)
        for i, (name, kwh, price, energy) in enumerate([
            ("Ana", "10", "1.11", "eolica"), ("Ana", "20.5", "2", "eolica"),
            ("Ana", "n/d", "3", "nuclear"), ("Luis", "7", "1.005", "eolica"),
            ("Nadie", "9", "9", "eolica"), (None, "9", "9", "eolica"),
        ])
    ])
    people = customers(raw, [
        ("Ana", "residencial"), ("Ana", "residencial"), ("Ana", "comercial"),
        ("Luis", "comercial"), ("Luis", None), ("Otro", "industrial"), (None, "industrial"),
    ])
    table = integrate.segment_metrics(trades, people, DAY)
    assert table.dtypes == list(S.PROCESSED["metricas_segmento"].items())
    got = sorted(values(table.drop("_fecha_ingesta", "_tipo_metrica")))
    assert got == sorted(values(metrics_from_detail(trades, people)))
    assert ("residencial", "nuclear", 2, None, None, None) in got
    assert ("residencial", "eolica", 4, 61.0, 104.2, 26.05) in got


def test_sales_keep_rows_without_a_customer(raw):
    trades = sales(raw, [("1", "Ana", "1", "1", "eolica"), ("2", "Nadie", "1", "1", "eolica")])
    people = customers(raw, [("Ana", "residencial"), ("Ana", "comercial")])
    for limit in (0, 10**6):
        joined = integrate.customer_sales(trades, people, max_broadcast_bytes=limit)
        assert sorted(values(joined, "id_transaccion", F.coalesce("segmento", F.lit("-")))) == [
            ("1", "comercial"), ("1", "residencial"), ("2", "-"),
        ]


def test_purchases_take_capacity_and_country(dirty):
    trades = enrich.derived(enrich.clean_transactions(dirty["transacciones"]))
    joined = integrate.supplier_purchases(
        trades, normalize_suppliers(dirty["proveedores"], DAY)
    )
    assert sorted(values(joined, "id_transaccion", "capacidad_mw", "pais_origen"), key=repr) == [
        ("TRX-001", 350.0, "Colombia"), ("TRX-003", 1200.0, "Colombia"), ("TRX-005", None, None),
    ]


def test_band_counts(dirty):
    trades = enrich.derived(enrich.clean_transactions(dirty["transacciones"]))
    assert dict(values(integrate.band_counts(trades))) == {"grande": 3, "mediana": 1, "pequeña": 1}
