"""The seven analytical queries over the processed tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voltalake import schemas as S
from voltalake.functions import columns as C
from voltalake.functions.exact import exact_avg, exact_sum

_PRICE, _KWH, _COP = "precio_cop_kwh", "cantidad_kwh", "valor_total_cop"


def _rows() -> Column:
    return F.count(F.lit(1))


def _total(column: str) -> Column:
    return F.round(exact_sum(F.col(column)), 2)


def _mean(column: str) -> Column:
    return F.round(exact_avg(F.col(column)), 2)


def _is(column: str, value: str) -> Column:
    return F.col(column) == value


def purchased_energy(transactions: DataFrame) -> DataFrame:
    """q1: completed purchases per energy type, the largest volume first."""
    bought = transactions.where(_is("tipo_transaccion", S.BUY) & _is("estado", S.DONE))
    return (
        bought.groupBy("tipo_energia")
        .agg(
            _rows().alias("num_transacciones"),
            _total(_KWH).alias("total_kwh"),
            _total(_COP).alias("total_cop"),
            _mean(_PRICE).alias("precio_promedio_kwh"),
        )
        .orderBy(F.col("total_kwh").desc_nulls_last(), "tipo_energia")
    )


def top_customers(transactions: DataFrame, k: int = 5) -> DataFrame:
    """q2: the ``k`` customer and volume-class pairs with the highest consumption."""
    sold = transactions.where(_is("tipo_transaccion", S.SELL) & _is("estado", S.DONE))
    return (
        sold.groupBy(F.col("nombre_cliente_proveedor").alias("cliente"), "clasificacion_volumen")
        .agg(
            _rows().alias("num_compras"),
            _total(_KWH).alias("total_kwh_consumido"),
            _total(_COP).alias("total_pagado_cop"),
        )
        .select(
            "cliente",
            "num_compras",
            "total_kwh_consumido",
            "total_pagado_cop",
            "clasificacion_volumen",
        )
        .orderBy(
            F.col("total_kwh_consumido").desc_nulls_last(),
            F.col("cliente").asc_nulls_first(),
            F.col("clasificacion_volumen").asc_nulls_first(),
        )
        .limit(k)
    )


def market_prices(transactions: DataFrame) -> DataFrame:
    """q3: price statistics of completed deals per energy, market and type."""
    keys = ("tipo_energia", "mercado", "tipo_transaccion")
    return (
        transactions.where(_is("estado", S.DONE))
        .groupBy(*keys)
        .agg(
            _mean(_PRICE).alias("precio_promedio"),
            F.round(F.min(_PRICE), 2).alias("precio_min"),
            F.round(F.max(_PRICE), 2).alias("precio_max"),
            _rows().alias("num_operaciones"),
        )
        .orderBy(*[F.col(key).asc_nulls_last() for key in keys])
    )


def pending_transactions(transactions: DataFrame, as_of: str | date) -> DataFrame:
    """q4: pending transactions with their age in days on ``as_of``, oldest first."""
    return (
        transactions.where(_is("estado", S.PENDING))
        .select(
            "id_transaccion",
            "tipo_transaccion",
            "nombre_cliente_proveedor",
            F.round(_KWH, 2).alias("kwh"),
            F.round(_COP, 2).alias("valor_cop"),
            "tipo_energia",
            "fecha_transaccion",
            C.days_between(F.col("fecha_transaccion"), C.day_literal(as_of)).alias(
                "dias_pendiente"
            ),
        )
        .orderBy(
            F.col("dias_pendiente").desc_nulls_last(),
            F.col("valor_cop").desc_nulls_last(),
            "id_transaccion",
        )
    )


def margins(transactions: DataFrame) -> DataFrame:
    """q5: average sale price over average purchase price per energy type.

    Both sides come out of one pass; an energy type needs deals on both.
    """
    kind = "tipo_transaccion"
    bought, sold = _is(kind, S.BUY), _is(kind, S.SELL)
    gain = F.col("precio_venta") - F.col("precio_compra")

    def side(of: Column, value: str) -> Column:
        return F.max(F.when(of, F.col(value)))

    # Sums by energy and side, so that each value is split and added once; then at
    # most two rows for an energy type meet.
    by_side = (
        transactions.where(
            _is("estado", S.DONE) & (bought | sold) & F.col("tipo_energia").isNotNull()
        )
        .groupBy("tipo_energia", kind)
        .agg(F.round(exact_avg(F.col(_PRICE)), 4).alias("precio"), exact_sum(F.col(_KWH)).alias("kwh"))
    )
    return (
        by_side.groupBy("tipo_energia")
        .agg(
            side(bought, "precio").alias("precio_compra"),
            side(sold, "precio").alias("precio_venta"),
            side(bought, "kwh").alias("kwh_comprado"),
            side(sold, "kwh").alias("kwh_vendido"),
            F.count_if(bought).alias("_buys"),
            F.count_if(sold).alias("_sells"),
        )
        .where("_buys > 0 AND _sells > 0")
        .select(
            "tipo_energia",
            "precio_compra",
            "precio_venta",
            F.round(gain, 4).alias("margen_cop_kwh"),
            C.pct_over(F.col("precio_venta"), F.col("precio_compra")).alias("margen_pct"),
            "kwh_comprado",
            "kwh_vendido",
        )
        .orderBy(F.col("margen_pct").desc_nulls_last(), "tipo_energia")
    )


def customer_distribution(customers: DataFrame) -> DataFrame:
    """q6: customers and their consumption per segment and city."""
    use = "consumo_promedio_kwh"
    return (
        customers.groupBy("segmento", "ciudad")
        .agg(
            _rows().alias("num_clientes"),
            _mean(use).alias("consumo_promedio_kwh"),
            _total(use).alias("consumo_total_kwh"),
        )
        .orderBy(
            F.col("segmento").asc_nulls_last(),
            F.col("consumo_total_kwh").desc_nulls_last(),
            F.col("ciudad").asc_nulls_last(),
        )
    )


def active_suppliers(suppliers: DataFrame) -> DataFrame:
    """q7: active suppliers, the largest capacity first."""
    return (
        suppliers.where("activo")
        .select("nombre_proveedor", "tipo_energia", "pais_origen", "capacidad_mw", "fecha_registro")
        .orderBy(F.col("capacidad_mw").desc_nulls_last(), "nombre_proveedor")
    )


@dataclass(frozen=True)
class Analytic:
    title: str
    table: str
    build: Callable[..., DataFrame]
    needs_day: bool = False

    def __call__(self, table: DataFrame, as_of: str | date) -> DataFrame:
        return self.build(table, as_of) if self.needs_day else self.build(table)


REGISTRY = {
    "q1": Analytic("Purchased energy by type", "transacciones", purchased_energy),
    "q2": Analytic("Top customers by consumption", "transacciones", top_customers),
    "q3": Analytic("Prices by energy and market", "transacciones", market_prices),
    "q4": Analytic("Pending transactions", "transacciones", pending_transactions, needs_day=True),
    "q5": Analytic("Margin by energy type", "transacciones", margins),
    "q6": Analytic("Customers by segment and city", "clientes", customer_distribution),
    "q7": Analytic("Active suppliers by capacity", "proveedores", active_suppliers),
}


def selected(ids: str | Iterable[str] = "all") -> list[str]:
    """Query ids from ``"all"``, ``"q1,q3"`` or a list; an unknown one is an error."""
    if isinstance(ids, str):
        ids = list(REGISTRY) if ids == "all" else [i.strip() for i in ids.split(",")]
    chosen = list(ids)
    unknown = [i for i in chosen if i not in REGISTRY]
    if unknown:
        raise ValueError(f"unknown queries {unknown}; choose from {list(REGISTRY)}")
    return chosen


def run_queries(
    tables: Mapping[str, DataFrame], as_of: str | date, ids: str | Iterable[str] = "all"
) -> dict[str, DataFrame]:
    """The chosen queries over processed tables given by name."""
    return {i: REGISTRY[i](tables[REGISTRY[i].table], as_of) for i in selected(ids)}


def tables_of(spark: SparkSession, database: str) -> dict[str, DataFrame]:
    """The processed tables of a catalog database."""
    return {name: spark.table(f"{database}.{name}") for name in S.PROCESSED}
