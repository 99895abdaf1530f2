"""Joins of transactions to customers and suppliers, and the two metric tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltalake import schemas as S
from voltalake.functions import columns as C
from voltalake.functions.exact import (
    decimal_total,
    double_total,
    exact_avg,
    exact_sum,
    joined_total,
)
from voltalake.operators.lookup import BROADCAST_BYTES, lookup_join

_PARTY = "nombre_cliente_proveedor"


def customer_sales(
    transactions: DataFrame, customers: DataFrame, max_broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Sales with the customer's data; a name shared by customers gives a row for each."""
    facts = customers.select(
        F.col("nombre").alias("nombre_cliente"), "ciudad", "segmento", "consumo_promedio_kwh"
    )
    return lookup_join(
        transactions.where(F.col("tipo_transaccion") == S.SELL),
        facts,
        _PARTY,
        "nombre_cliente",
        spread_by="id_transaccion",
        max_broadcast_bytes=max_broadcast_bytes,
    )


def supplier_purchases(
    transactions: DataFrame, suppliers: DataFrame, max_broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Purchases with the supplier's capacity and country."""
    return lookup_join(
        transactions.where(F.col("tipo_transaccion") == S.BUY),
        suppliers.select("nombre_proveedor", "capacidad_mw", "pais_origen"),
        _PARTY,
        "nombre_proveedor",
        spread_by="id_transaccion",
        max_broadcast_bytes=max_broadcast_bytes,
    )


def energy_metrics(transactions: DataFrame, load_date: str | date) -> DataFrame:
    """Volume, value and price range per energy and transaction type."""
    price = F.col("precio_cop_kwh")
    return transactions.groupBy("tipo_energia", "tipo_transaccion").agg(
        F.count(F.lit(1)).alias("num_transacciones"),
        F.round(exact_sum(F.col("cantidad_kwh")), 2).alias("total_kwh"),
        F.round(exact_sum(F.col("valor_total_cop")), 2).alias("total_cop"),
        F.round(exact_avg(price), 2).alias("precio_promedio_kwh"),
        F.round(F.min(price), 2).alias("precio_min_kwh"),
        F.round(F.max(price), 2).alias("precio_max_kwh"),
    ).select(
        "*",
        C.day_literal(load_date).alias("_fecha_ingesta"),
        F.lit("por_energia").alias("_tipo_metrica"),
    )


def segment_metrics(
    transactions: DataFrame, customers: DataFrame, load_date: str | date
) -> DataFrame:
    """Volume, value and average ticket per customer segment and energy type.

    Equal to aggregating ``customer_sales`` over known segments, but both
    sides are reduced to totals per name before they meet, so a name with
    very many sales or customers is one row and not a hot task.
    """
    kwh, cop = F.col("cantidad_kwh"), F.col("valor_total_cop")
    per_name = (
        transactions.where(F.col("tipo_transaccion") == S.SELL)
        .groupBy(F.col(_PARTY).alias("nombre"), "tipo_energia")
        .agg(
            F.count(F.lit(1)).alias("n"),
            decimal_total(kwh).alias("kwh"),
            double_total(kwh).alias("kwh_rest"),
            decimal_total(cop).alias("cop"),
            double_total(cop).alias("cop_rest"),
            F.count(cop).alias("cop_n"),
        )
    )
    holders = (
        customers.where(F.col("segmento").isNotNull())
        .groupBy("nombre", "segmento")
        .agg(F.count(F.lit(1)).alias("holders"))
    )
    times = F.col("holders")

    def total(name: str):
        decimals = F.sum(F.col(name) * times)
        return joined_total(decimals, F.sum(F.col(f"{name}_rest") * times))

    return (
        per_name.join(holders, "nombre")
        .groupBy("segmento", "tipo_energia")
        .agg(
            F.sum(F.col("n") * times).alias("num_transacciones"),
            F.round(total("kwh"), 2).alias("total_kwh"),
            F.round(total("cop"), 2).alias("total_cop"),
            F.round(F.try_divide(total("cop"), F.sum(F.col("cop_n") * times)), 2).alias(
                "ticket_promedio_cop"
            ),
        )
        .select(
            "*",
            C.day_literal(load_date).alias("_fecha_ingesta"),
            F.lit("por_segmento").alias("_tipo_metrica"),
        )
    )


def band_counts(transactions: DataFrame) -> DataFrame:
    """Number of transactions per volume class."""
    return transactions.groupBy("clasificacion_volumen").agg(F.count(F.lit(1)).alias("n"))
