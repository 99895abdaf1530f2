"""Raw energy datasets derived from a TPC-H-like star schema.

Suppliers, customers and line items become the three raw datasets, as text
with the usual defects: outer blanks, mixed case, unknown categories,
unparseable numbers and repeated keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voltalake.session import stage
from voltalake.sources.files import spread


def _text(column: Column, kind: str) -> Column:
    return column.cast(kind).cast("string")


def _pick(value: Column, choices: dict[int | str, str], otherwise: str) -> Column:
    picked = F
    for key, label in choices.items():
        picked = picked.when(value == key, label)
    return picked.otherwise(otherwise)


def _synthetic_day(key: Column, day: str) -> Column:
    year, month = 10 + key % 14, 1 + key % 9
    return F.concat(
        F.lit("20"), year.cast("string"), F.lit("-0"), month.cast("string"), F.lit(day)
    )


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def raw_suppliers(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("s_suppkey")
    nations = _table(spark, folder, "nation")
    rows = _table(spark, folder, "supplier").join(
        nations, F.col("s_nationkey") == F.col("n_nationkey")
    )
    energy = {0: "EOLICA ", 1: "Hidroelectrica", 2: " nuclear"}
    capacity = _text(F.col("s_acctbal"), "decimal(12,2)")
    return rows.select(
        F.concat(F.lit("  "), "s_name", F.lit(" ")).alias("nombre_proveedor"),
        _pick(key % 4, energy, "carbon").alias("tipo_energia"),
        F.concat(F.lit(" "), "n_name").alias("pais_origen"),
        F.when(key % 25 == 0, "n/d").otherwise(capacity).alias("capacidad_mw"),
        _synthetic_day(key, "-15").alias("fecha_registro"),
        F.when(key % 10 == 0, "false").otherwise("true").alias("activo"),
    )


def raw_customers(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of customers share one identification."""
    key = F.col("c_custkey")
    even = key - key % 2
    nations = _table(spark, folder, "nation")
    rows = _table(spark, folder, "customer").join(
        nations, F.col("c_nationkey") == F.col("n_nationkey")
    )
    kinds = {0: " cc", 2: "NIT", 4: "CE ", 6: "pp", 8: "TI"}
    use = _text(F.col("c_acctbal"), "decimal(12,2)")
    return rows.select(
        _pick(even % 12, kinds, "RC").alias("tipo_identificacion"),
        (even + 1_000_000).cast("string").alias("identificacion"),
        F.concat(F.lit(" "), "c_name", F.lit("  ")).alias("nombre"),
        F.lower("n_name").alias("ciudad"),
        F.concat("c_mktsegment", F.lit(" ")).alias("segmento"),
        _synthetic_day(key, "-20").alias("fecha_vinculacion"),
        F.when(key % 50 == 0, "n/d").otherwise(use).alias("consumo_promedio_kwh"),
    )


def raw_transactions(spark: SparkSession, folder: str, work: str | None = None) -> DataFrame:
    """One row per line item; order and line number repeat, so identifiers do.

    With a ``work`` folder the items that met their orders are staged there, so that
    what they shuffled is gone from the disks when they are shuffled to their parts.
    """
    items = spread(_table(spark, folder, "lineitem"), "l_orderkey", "l_linenumber").withColumns({
        "bought": F.col("l_linestatus") == "O",
        "shipped": F.col("l_shipdate").cast("date"),
    })
    # Orders meet their customers first, or all items would travel by customer too.
    orders = _table(spark, folder, "orders").join(
        _table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    # Items travel with one name and with flags to the parts, and not with all texts.
    met = (
        items.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(_table(spark, folder, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_returnflag",
            "shipped", "bought",
            F.when(F.col("bought"), F.concat("s_name", F.lit(" ")))
            .otherwise(F.col("c_name"))
            .alias("party"),
            (F.col("o_orderstatus") == "O").alias("pending"),
            (F.col("o_orderpriority") < "3").alias("wholesale"),
        )
    )
    met = met if work is None else stage(met, "ordenes", work)
    rows = met.join(_table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey"))
    energy = {"R": "EOLICA ", "A": "hidroelectrica"}
    return rows.select(
        F.concat_ws("-", F.lit("TRX"), "l_orderkey", "l_linenumber").alias("id_transaccion"),
        F.when(F.col("bought"), " COMPRA").otherwise("venta ").alias("tipo_transaccion"),
        F.col("party").alias("nombre_cliente_proveedor"),
        _text(F.col("l_quantity") * F.col("p_size") * 100, "bigint").alias("cantidad_kwh"),
        _text(F.col("p_retailprice"), "decimal(12,2)").alias("precio_cop_kwh"),
        _pick(F.col("l_returnflag"), energy, "Nuclear").alias("tipo_energia"),
        F.col("shipped").cast("string").alias("fecha_transaccion"),
        F.when(F.col("pending"), "PENDIENTE").otherwise("completada").alias("estado"),
        F.when(F.col("wholesale"), "Mayorista ").otherwise("minorista").alias("mercado"),
    )


def raw_datasets(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {
        "proveedores": raw_suppliers(spark, folder),
        "clientes": raw_customers(spark, folder),
        "transacciones": raw_transactions(spark, folder),
    }
