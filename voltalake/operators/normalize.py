"""Cleaning of suppliers and customers, and the report of values that fail."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltalake import schemas as S
from voltalake.functions import columns as C
from voltalake.operators.dedup import keep_first

# How each raw column becomes a typed one. Columns without an entry pass as they are.
RULES = {
    "proveedores": {
        "nombre_proveedor": C.tidy,
        "tipo_energia": C.tidy_lower,
        "pais_origen": C.tidy,
        "capacidad_mw": C.number,
        "fecha_registro": C.day,
        "activo": C.flag,
    },
    "clientes": {
        "tipo_identificacion": C.tidy_upper,
        "nombre": C.tidy,
        "ciudad": C.tidy_title,
        "segmento": C.tidy_lower,
        "fecha_vinculacion": C.day,
        "consumo_promedio_kwh": C.number,
    },
    "transacciones": {
        "tipo_transaccion": C.tidy_lower,
        "nombre_cliente_proveedor": C.tidy,
        "cantidad_kwh": C.number,
        "precio_cop_kwh": C.number,
        "tipo_energia": C.tidy_lower,
        "fecha_transaccion": C.day,
        "estado": C.tidy_lower,
        "mercado": C.tidy_lower,
    },
}
_TYPING_RULES = (C.number, C.day, C.flag)


def _as_is(column: Column) -> Column:
    return column


def typed(raw: DataFrame, dataset: str) -> DataFrame:
    """The dataset's columns, cleaned and typed; all rows stay."""
    rules = RULES[dataset]
    return raw.select(
        *[rules.get(name, _as_is)(F.col(name)).alias(name) for name in S.RAW_COLUMNS[dataset]]
    )


def unique(rows: DataFrame, dataset: str) -> DataFrame:
    """One row per natural key: the one with the earliest date."""
    return keep_first(rows, S.KEYS[dataset], (S.AGE_COLUMN[dataset],))


def known(raw: DataFrame, dataset: str) -> DataFrame:
    """Typed rows of a known category; transactions have all."""
    rows = typed(raw, dataset)
    if dataset == "proveedores":
        return rows.where(F.col("tipo_energia").isin(*S.ENERGY_TYPES))
    if dataset == "clientes":
        return rows.where(F.col("tipo_identificacion").isin(*S.ID_TYPES))
    return rows


def normalize_suppliers(raw: DataFrame, load_date: str | date) -> DataFrame:
    """Suppliers of the known energy types, one per name."""
    return finished_suppliers(known(raw, "proveedores"), load_date)


def finished_suppliers(rows: DataFrame, load_date: str | date) -> DataFrame:
    return unique(rows, "proveedores").select(
        "*",
        C.day_literal(load_date).alias("_fecha_ingesta"),
        F.lit(S.SUPPLIER_SOURCE).alias("_fuente"),
    )


def normalize_customers(raw: DataFrame, load_date: str | date, as_of: str | date) -> DataFrame:
    """Customers with a known kind of identification, one per identification.

    ``as_of`` is the day to which the tenure in days is counted.
    """
    return finished_customers(known(raw, "clientes"), load_date, as_of)


def finished_customers(rows: DataFrame, load_date: str | date, as_of: str | date) -> DataFrame:
    tenure = C.days_between(F.col("fecha_vinculacion"), C.day_literal(as_of))
    return unique(rows, "clientes").select(
        "*",
        tenure.cast("bigint").alias("antiguedad_dias"),
        C.masked(F.col("identificacion")).alias("identificacion_enmascarada"),
        C.day_literal(load_date).alias("_fecha_ingesta"),
    )


def quarantine(raw: DataFrame, dataset: str) -> DataFrame:
    """Raw rows with something that cannot be read, and why (``motivo``).

    A reason is the name of a column whose text does not take its type, or
    the corrupt-record column for a line of the wrong shape.
    """
    failures = [
        F.when(F.col(name).isNotNull() & rule(F.col(name)).isNull(), F.lit(name))
        for name, rule in RULES[dataset].items()
        if rule in _TYPING_RULES
    ]
    kept = list(S.RAW_COLUMNS[dataset])
    if S.CORRUPT in raw.columns:
        failures.append(F.when(F.col(S.CORRUPT).isNotNull(), F.lit(S.CORRUPT)))
        kept.append(S.CORRUPT)
    reasons = F.concat_ws(",", *failures)
    return raw.select(*kept, reasons.alias("motivo")).where("motivo <> ''")


def readable(raw: DataFrame) -> DataFrame:
    """Rows whose line had the right shape; the others are in ``quarantine``."""
    if S.CORRUPT not in raw.columns:
        return raw
    return raw.where(F.col(S.CORRUPT).isNull()).drop(S.CORRUPT)
