"""Data-quality checks, reported as rows. Each table is read once."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltalake import schemas as S
from voltalake.operators.dedup import repeated_keys

REQUIRED_COLUMNS = {
    "proveedores": ("nombre_proveedor", "tipo_energia", "capacidad_mw", "activo"),
    "clientes": ("tipo_identificacion", "identificacion", "nombre", "segmento"),
    "transacciones": ("id_transaccion", "tipo_transaccion", "cantidad_kwh", "precio_cop_kwh"),
}

# Checks whose bad rows the cleaning drops or merges.
SOURCE_RULES = {
    "proveedores": ("tipo_energia_valido", "tipo_energia_no_nulo", "nombre_no_nulo"),
    "clientes": (
        "tipo_identificacion_valido", "tipo_identificacion_no_nulo", "identificacion_no_nula",
    ),
    "transacciones": ("id_no_nulo", "tipo_energia_valido", "tipo_transaccion_valido"),
}


def row_checks(dataset: str) -> dict[str, Column]:
    """Condition that makes a row bad, by check."""
    c = F.col
    if dataset == "proveedores":
        return {
            "tipo_energia_valido": ~c("tipo_energia").isin(*S.ENERGY_TYPES),
            "nombre_no_nulo": c("nombre_proveedor").isNull(),
            "tipo_energia_no_nulo": c("tipo_energia").isNull(),
            "capacidad_positiva": c("capacidad_mw") <= 0,
        }
    if dataset == "clientes":
        return {
            "tipo_identificacion_valido": ~c("tipo_identificacion").isin(*S.ID_TYPES),
            "tipo_identificacion_no_nulo": c("tipo_identificacion").isNull(),
            "identificacion_no_nula": c("identificacion").isNull(),
            "identificacion_se_enmascara": F.length("identificacion") <= S.MASK_TAIL,
            "antiguedad_no_negativa": c("antiguedad_dias") < 0,
        }
    return {
        "id_no_nulo": c("id_transaccion").isNull(),
        "tipo_energia_valido": ~c("tipo_energia").isin(*S.ENERGY_TYPES),
        "tipo_transaccion_valido": ~c("tipo_transaccion").isin(*S.TRANSACTION_TYPES),
        "cantidad_positiva": c("cantidad_kwh") <= 0,
        "precio_positivo": c("precio_cop_kwh") <= 0,
        "desviacion_coherente": (c("sobre_precio_promedio") & (c("desviacion_precio_pct") < 0))
        | (~c("sobre_precio_promedio") & (c("desviacion_precio_pct") > 0)),
        # Above the average by less than the rounding shows.
        "desviacion_redondeada": c("sobre_precio_promedio") & (c("desviacion_precio_pct") == 0),
    }


def _fit_checks(dataset: str) -> dict[str, Column]:
    """Values that the warehouse column of the same name cannot hold."""
    checks = {}
    for name, kind in S.WAREHOUSE[S.WAREHOUSE_OF[dataset]].items():
        text = re.match(r"varchar\((\d+)\)", kind)
        if text:
            checks[f"{name}_cabe"] = F.length(name) > int(text[1])
        elif kind.startswith("decimal"):
            checks[f"{name}_cabe"] = F.col(name).isNotNull() & F.col(name).try_cast(kind).isNull()
    return checks


def quality_report(table: DataFrame, dataset: str) -> DataFrame:
    """One row per check: ``tabla, regla, filas_malas, cumple``.

    One aggregate over the table, without a shuffle of its rows.
    """
    missing = [c for c in REQUIRED_COLUMNS[dataset] if c not in table.columns]
    if missing:
        return table.sparkSession.createDataFrame(
            [(dataset, f"columna_{name}", None, False) for name in missing],
            "tabla string, regla string, filas_malas bigint, cumple boolean",
        )
    checks = {**row_checks(dataset), **_fit_checks(dataset)}
    counted = table.agg(
        F.count_if(F.lit(True)).alias("_rows"),
        *[F.count_if(bad).alias(rule) for rule, bad in checks.items()],
    ).withColumn("no_vacia", F.when(F.col("_rows") == 0, 1).otherwise(0).cast("bigint"))
    present = {f"columna_{name}": F.lit(0).cast("bigint") for name in REQUIRED_COLUMNS[dataset]}
    counted = counted.withColumns(present)
    return _as_rules(counted, dataset, ["no_vacia", *present, *checks])


def source_report(typed: DataFrame, dataset: str) -> DataFrame:
    """Unknown categories and null keys of all typed rows, before any is dropped or
    merged: the same columns as ``quality_report``."""
    every = row_checks(dataset)
    rules = SOURCE_RULES[dataset]
    counted = typed.agg(*[F.count_if(every[rule]).alias(rule) for rule in rules])
    return _as_rules(counted, dataset, list(rules))


def _as_rules(counted: DataFrame, dataset: str, rules: list[str]) -> DataFrame:
    return counted.unpivot([], rules, "regla", "filas_malas").select(
        F.lit(dataset).alias("tabla"),
        "regla",
        "filas_malas",
        (F.col("filas_malas") == 0).alias("cumple"),
    )


def uniqueness_report(table: DataFrame, dataset: str) -> DataFrame:
    """Repeated natural keys: ``tabla, clave, filas``."""
    return _as_report(table, dataset, S.KEYS[dataset])


def shared_names(customers: DataFrame) -> DataFrame:
    """Names held by several customers: each sale to one appears once per holder."""
    return _as_report(customers, "clientes_nombre", ("nombre",))


def _as_report(table: DataFrame, label: str, keys: tuple[str, ...]) -> DataFrame:
    return repeated_keys(table, keys).select(
        F.lit(label).alias("tabla"), F.concat_ws("|", *keys).alias("clave"), "filas"
    )
