from conftest import DAY, plan_of, values
from voltalake.operators import enrich, quality
from voltalake.operators.normalize import normalize_customers, normalize_suppliers, typed


def failing(report):
    return {r["regla"]: r["filas_malas"] for r in report.where("NOT cumple").collect()}


def test_clean_sample_has_no_findings(sample):
    tables = {
        "proveedores": normalize_suppliers(sample["proveedores"], DAY),
        "clientes": normalize_customers(sample["clientes"], DAY, DAY),
        "transacciones": enrich.enrich_transactions(sample["transacciones"], DAY),
    }
    for name, table in tables.items():
        assert failing(quality.quality_report(table, name)) == {}
        assert quality.uniqueness_report(table, name).isEmpty()


def test_findings_are_counted(raw):
    rows = raw("transacciones", [
        ("1", "compra", "x", "0", "1", "eolica", "2024-01-05", "completada", "mayorista"),
        ("2", "regalo", "x", "1", "-1", "carbon", "2024-01-05", "completada", "mayorista"),
        (None, "venta", "x" * 201, "1e17", "1", "eolica", "2024-01-05", "completada", "mayorista"),
    ])
    report = quality.quality_report(enrich.enrich_transactions(rows, DAY), "transacciones")
    assert failing(report) == {
        "id_no_nulo": 1, "tipo_energia_valido": 1, "tipo_transaccion_valido": 1,
        "cantidad_positiva": 1, "precio_positivo": 1, "nombre_cliente_proveedor_cabe": 1,
        "cantidad_kwh_cabe": 1,
    }


def test_dropped_and_merged_rows_are_counted(raw):
    suppliers = raw("proveedores", [
        (None, "eolica", "Colombia", "1", "2021-03-15", "true"),
        (None, " EOLICA", "Colombia", "1", "2021-03-16", "true"),
        ("x", "carbon", "Colombia", "1", "2021-03-15", "true"),
        ("x", None, "Colombia", "1", "2021-03-15", "true"),
    ])
    report = quality.source_report(typed(suppliers, "proveedores"), "proveedores")
    assert failing(report) == {
        "tipo_energia_valido": 1, "tipo_energia_no_nulo": 1, "nombre_no_nulo": 2,
    }
    customers = raw("clientes", [
        ("CC", None, "a", "cali", "residencial", "2020-01-01", "1"),
        ("cc ", None, "b", "cali", "residencial", "2020-01-01", "1"),
        ("RC", "1", "c", "cali", "residencial", "2020-01-01", "1"),
        (None, "2", "d", "cali", "residencial", "2020-01-01", "1"),
    ])
    report = quality.source_report(typed(customers, "clientes"), "clientes")
    assert failing(report) == {
        "tipo_identificacion_valido": 1, "tipo_identificacion_no_nulo": 1,
        "identificacion_no_nula": 2,
    }
    sale = ("venta", "x", "1", "1", "eolica", "2024-01-05", "completada", "mayorista")
    sales = raw("transacciones", [(None, *sale), (None, *sale)])
    report = quality.source_report(typed(sales, "transacciones"), "transacciones")
    assert failing(report) == {"id_no_nulo": 2}


def test_missing_column_and_empty_table(sample):
    table = normalize_suppliers(sample["proveedores"], DAY)
    report = quality.quality_report(table.drop("activo"), "proveedores")
    assert values(report) == [("proveedores", "columna_activo", None, False)]
    assert failing(quality.quality_report(table.where("false"), "proveedores")) == {"no_vacia": 1}


def test_short_identification_and_future_customer(raw):
    rows = raw("clientes", [("CC", "123", "Ana", "cali", "residencial", "2030-01-01", "1")])
    report = quality.quality_report(normalize_customers(rows, DAY, DAY), "clientes")
    assert failing(report) == {"identificacion_se_enmascara": 1, "antiguedad_no_negativa": 1}


def test_report_reads_the_table_once(sample):
    report = quality.quality_report(normalize_suppliers(sample["proveedores"], DAY), "proveedores")
    assert plan_of(report, "simple").count("FileScan csv") == 1


def test_repeated_keys_and_names(dirty):
    assert values(quality.uniqueness_report(dirty["transacciones"], "transacciones")) == [
        ("transacciones", "TRX-001", 2)
    ]
    assert quality.shared_names(dirty["clientes"]).isEmpty()
