from datetime import date

from pyspark.sql import functions as F

from conftest import DAY, values
from voltalake import schemas as S
from voltalake.operators.dedup import keep_first
from voltalake.operators.normalize import (
    RULES,
    normalize_customers,
    normalize_suppliers,
    quarantine,
    readable,
    typed,
)


def test_suppliers(dirty):
    clean = normalize_suppliers(dirty["proveedores"], DAY)
    assert clean.dtypes == list(S.PROCESSED["proveedores"].items())
    assert sorted(values(clean, "nombre_proveedor", "tipo_energia", "capacidad_mw")) == [
        ("EnerSol Caribe", "eolica", 350.0),
        ("HidroAndes S.A.", "hidroelectrica", 1200.0),
        ("NuclearPower Co.", "nuclear", 2000.0),
        ("VientoNorte Ltda.", "eolica", 180.0),
    ]
    assert {r[0] for r in values(clean, "_fecha_ingesta")} == {date(2024, 1, 15)}


def test_customers(dirty):
    clean = normalize_customers(dirty["clientes"], DAY, DAY)
    assert clean.dtypes == list(S.PROCESSED["clientes"].items())
    rows = values(
        clean.orderBy("nombre"),
        "nombre", "tipo_identificacion", "ciudad", "segmento", "identificacion_enmascarada",
        "antiguedad_dias",
    )
    assert rows == [
        ("Carlos Ruiz", "CC", "Cali", "residencial", "****4321", 1041),
        ("Industrias S.A.", "NIT", "Medellín", "industrial", "****56-1", 2035),
        ("María López", "CC", "Bogotá", "residencial", "****6789", 1461),
    ]


def test_cleaning_again_changes_nothing(dirty):
    clean = normalize_suppliers(dirty["proveedores"], DAY)
    as_text = clean.select(*[F.col(c).cast("string") for c in S.RAW_COLUMNS["proveedores"]])
    assert sorted(values(normalize_suppliers(as_text, DAY))) == sorted(values(clean))


def test_rules_cover_only_known_columns():
    for dataset, rules in RULES.items():
        assert set(rules) <= set(S.RAW_COLUMNS[dataset])


def test_keep_first_takes_the_earliest_and_then_the_rest_in_order(spark):
    rows = [("a", 3, "z"), ("a", 1, "y"), ("a", 1, "x"), ("b", None, "q"), ("b", 9, "r"),
            (None, 2, "m"), (None, 1, "n")]
    df = spark.createDataFrame(rows, "k string, d int, v string")
    for n in (1, 3):
        first = keep_first(df.repartition(n), ["k"], ["d"])
        assert set(values(first)) == {("a", 1, "x"), ("b", 9, "r"), (None, 1, "n")}


def test_every_row_is_accounted_for(dirty):
    rows = dirty["clientes"]
    kept = normalize_customers(rows, DAY, DAY).count()
    cleaned = typed(rows, "clientes")
    known = cleaned.where(F.col("tipo_identificacion").isin(*S.ID_TYPES))
    filtered = cleaned.count() - known.count()
    repeats = known.count() - known.select(*S.KEYS["clientes"]).distinct().count()
    assert kept + filtered + repeats == rows.count()


def test_quarantine_names_the_failing_columns(raw):
    rows = raw("transacciones", [
        ("1", "compra", "x", "n/d", "1.0", "eolica", "31/12/2024", "completada", "mayorista"),
        ("2", "compra", "x", "5", None, "eolica", "2024-01-05", "completada", "mayorista"),
    ])
    assert values(quarantine(rows, "transacciones"), "id_transaccion", "motivo") == [
        ("1", "cantidad_kwh,fecha_transaccion")
    ]
    assert typed(rows, "transacciones").count() == 2


def test_lines_of_the_wrong_shape_are_set_aside(spark):
    schema = S.raw_schema("proveedores")
    rows = spark.createDataFrame(
        [("a", "eolica", "x", "1", "2024-01-01", "true", None),
         ("b", "eolica", None, None, None, None, "b,eolica")],
        schema,
    )
    assert values(readable(rows), "nombre_proveedor") == [("a",)]
    assert values(quarantine(rows, "proveedores"), "nombre_proveedor", "motivo") == [
        ("b", S.CORRUPT)
    ]
