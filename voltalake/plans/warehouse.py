"""Warehouse tables (typed projections) and the two views over them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltalake import schemas as S
from voltalake.functions import columns as C


def warehouse_rows(
    processed: DataFrame, table: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """The processed rows in the column order and types of a warehouse table.

    ``columns`` are those wanted, by default all. A number too large for its
    DECIMAL becomes NULL; the quality report counts those, and the text
    values that are too long.
    """
    kinds = S.WAREHOUSE[table]
    return processed.select(*[_fitted(name, kinds[name]).alias(name) for name in columns or kinds])


def _fitted(name: str, kind: str):
    plain = kind.removesuffix(" not null")
    return F.col(name) if plain.startswith("varchar") else F.col(name).try_cast(plain)


def margin_view(energy_metrics: DataFrame) -> DataFrame:
    """Margin per energy type and load date, over the energy metrics."""
    on = ["tipo_energia", "_fecha_ingesta"]

    def side(kind: str, price: str, volume: str) -> DataFrame:
        return energy_metrics.where(F.col("tipo_transaccion") == kind).select(
            *on,
            F.col("precio_promedio_kwh").alias(price),
            F.col("total_kwh").alias(volume),
        )

    bought = side(S.BUY, "precio_compra_kwh", "kwh_comprado")
    sold = side(S.SELL, "precio_venta_kwh", "kwh_vendido")
    buy, sell = F.col("precio_compra_kwh"), F.col("precio_venta_kwh")
    return bought.join(sold, on).select(
        "tipo_energia",
        "precio_compra_kwh",
        "precio_venta_kwh",
        F.round(sell - buy, 4).cast("decimal(13,4)").alias("margen_cop_kwh"),
        C.pct_over(sell, buy).cast("decimal(20,2)").alias("margen_pct"),
        "kwh_comprado",
        "kwh_vendido",
        "_fecha_ingesta",
    )


# Columns of the fact table that the daily summary reads.
SUMMARY_COLUMNS = (
    "fecha_transaccion", "tipo_energia", "tipo_transaccion", "estado",
    "cantidad_kwh", "precio_cop_kwh", "valor_total_cop",
)


def daily_summary_view(facts: DataFrame) -> DataFrame:
    """Completed transactions per day, energy and type, the last day first."""
    return (
        facts.where(F.col("estado") == S.DONE)
        .groupBy("fecha_transaccion", "tipo_energia", "tipo_transaccion")
        .agg(
            F.count(F.lit(1)).alias("num_transacciones"),
            F.sum("cantidad_kwh").alias("total_kwh"),
            F.sum("valor_total_cop").alias("total_cop"),
            F.round(F.avg("precio_cop_kwh"), 4).cast("decimal(12,4)").alias("precio_promedio"),
        )
        .orderBy(
            F.col("fecha_transaccion").desc_nulls_last(),
            F.col("tipo_energia").asc_nulls_last(),
            F.col("tipo_transaccion").asc_nulls_last(),
        )
    )


# The same two views over the stored tables of a database, for readers of SQL.
VIEWS = {
    "v_margen_energia": f"""
        SELECT tipo_energia, precio_compra_kwh, precio_venta_kwh,
            CAST(round(precio_venta_kwh - precio_compra_kwh, 4) AS decimal(13,4)) AS margen_cop_kwh,
            CAST(round(try_divide(precio_venta_kwh - precio_compra_kwh, precio_compra_kwh) * 100, 2)
                AS decimal(20,2)) AS margen_pct,
            kwh_comprado, kwh_vendido, _fecha_ingesta
        FROM (SELECT tipo_energia, _fecha_ingesta, precio_promedio_kwh AS precio_compra_kwh,
                total_kwh AS kwh_comprado
            FROM {{db}}.agg_metricas_energia WHERE tipo_transaccion = '{S.BUY}')
        JOIN (SELECT tipo_energia, _fecha_ingesta, precio_promedio_kwh AS precio_venta_kwh,
                total_kwh AS kwh_vendido
            FROM {{db}}.agg_metricas_energia WHERE tipo_transaccion = '{S.SELL}')
        USING (tipo_energia, _fecha_ingesta)
    """,
    "v_resumen_diario": f"""
        SELECT fecha_transaccion, tipo_energia, tipo_transaccion,
            count(*) AS num_transacciones, sum(cantidad_kwh) AS total_kwh,
            sum(valor_total_cop) AS total_cop,
            CAST(round(avg(precio_cop_kwh), 4) AS decimal(12,4)) AS precio_promedio
        FROM {{db}}.fact_transacciones WHERE estado = '{S.DONE}'
        GROUP BY fecha_transaccion, tipo_energia, tipo_transaccion
        ORDER BY fecha_transaccion DESC NULLS LAST, tipo_energia NULLS LAST,
            tipo_transaccion NULLS LAST
    """,
}


def analyst_customers(customers: DataFrame) -> DataFrame:
    """Customers without the full identification."""
    return customers.drop("identificacion")
