"""Enrichment of transactions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voltalake import schemas as S
from voltalake.functions import columns as C
from voltalake.functions.exact import exact_avg
from voltalake.operators.lookup import BROADCAST_BYTES, lookup_join
from voltalake.operators.normalize import typed, unique
from voltalake.session import stage

_AVERAGE = "precio_promedio_tipo_energia"


def clean_transactions(raw: DataFrame) -> DataFrame:
    """Typed transactions, one per identifier."""
    return unique(typed(raw, "transacciones"), "transacciones")


def with_total_value(df: DataFrame) -> DataFrame:
    value = C.rounded(F.col("cantidad_kwh") * F.col("precio_cop_kwh"))
    return df.withColumn("valor_total_cop", value)


def with_volume_band(df: DataFrame) -> DataFrame:
    return df.withColumn("clasificacion_volumen", C.volume_band(F.col("cantidad_kwh")))


def with_calendar(df: DataFrame) -> DataFrame:
    """Year, month and day of the week (Sunday is 1)."""
    traded = F.col("fecha_transaccion")
    return df.withColumns(
        {"anio": F.year(traded), "mes": F.month(traded), "dia_semana": F.dayofweek(traded)}
    )


def derived(clean: DataFrame) -> DataFrame:
    """All columns that follow from the row alone."""
    return with_calendar(with_volume_band(with_total_value(clean)))


def price_averages(df: DataFrame) -> DataFrame:
    """Average price per energy type, two decimals; NULL is a type of its own."""
    return df.groupBy(F.col("tipo_energia").alias("_energia")).agg(
        F.round(exact_avg(F.col("precio_cop_kwh")), 2).alias(_AVERAGE)
    )


def _compared(df: DataFrame) -> DataFrame:
    price, average = F.col("precio_cop_kwh"), F.col(_AVERAGE)
    return df.withColumns(
        {
            "sobre_precio_promedio": price > average,
            "desviacion_precio_pct": C.rounded(C.share_over(price, average)),
        }
    )


def with_price_stats(
    df: DataFrame, averages: DataFrame, max_broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Each price against the average of its energy type.

    A window over the energy type would move a third of all rows to one task;
    the averages are a short table, so the transactions stay where they are.
    """
    joined = lookup_join(
        df,
        averages,
        "tipo_energia",
        "_energia",
        spread_by="id_transaccion",
        null_safe=True,
        max_broadcast_bytes=max_broadcast_bytes,
    )
    return _compared(joined.drop("_energia"))


def with_price_stats_by_window(df: DataFrame) -> DataFrame:
    """The same by a window: for small tables, and as a cross-check."""
    over_type = Window.partitionBy("tipo_energia")
    average = F.round(F.avg("precio_cop_kwh").over(over_type), 2)
    return _compared(df.withColumn(_AVERAGE, average))


def enrich_transactions(
    raw: DataFrame, load_date: str | date, folder: str | None = None
) -> DataFrame:
    """Clean, derive, and compare prices.

    The clean rows, without what is derived from them, are staged once (in ``folder``, if given): the averages
    then read two columns of the files, and the deduplication does not run
    again for the join.
    """
    return enriched(typed(raw, "transacciones"), load_date, folder)


def enriched(rows: DataFrame, load_date: str | date, folder: str | None = None) -> DataFrame:
    """The same from typed rows."""
    rows = stage(unique(rows, "transacciones"), "transacciones", folder)
    averages = stage(price_averages(rows), "precios", folder)
    return with_price_stats(derived(rows), averages).withColumn(
        "_fecha_ingesta", C.day_literal(load_date)
    )
