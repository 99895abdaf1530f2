"""

The three raw datasets are derived by Spark from the driver's tables
(``voltalake.plans.star``); each query runs one operator, or a composition of
them, over all their rows.
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from functools import reduce
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from oracles import LOAD_DATE, ORACLES, SECOND_DATE  # noqa: E402
from voltalake import schemas as S  # noqa: E402
from voltalake.functions import columns as C  # noqa: E402
from voltalake.operators import enrich, integrate, normalize, quality  # noqa: E402
from voltalake.plans import analytics, daily, star, warehouse  # noqa: E402
from voltalake.session import fresh_folder, ship, stage, work_folder  # noqa: E402
from voltalake.sources import catalog, files  # noqa: E402
from voltalake.sources import warehouse as warehouse_tables  # noqa: E402
from voltalake.streaming import ingest, unique  # noqa: E402

try:
    from voltalake.llm import queries as corpus
except ImportError:
    corpus = None
try:
    import corpus_pipeline
except ImportError:
    corpus_pipeline = None

Query = Callable[[SparkSession, str], DataFrame]


# --- tables that several queries start from ---------------------------------
def suppliers(spark: SparkSession, sf: str) -> DataFrame:
    return normalize.normalize_suppliers(star.raw_suppliers(spark, sf), LOAD_DATE)


def customers(spark: SparkSession, sf: str, day: str = LOAD_DATE) -> DataFrame:
    return normalize.normalize_customers(star.raw_customers(spark, sf), day, day)


def clean(spark: SparkSession, sf: str) -> DataFrame:
    return enrich.clean_transactions(star.raw_transactions(spark, sf))


def transactions(spark: SparkSession, sf: str) -> DataFrame:
    """Transactions with all columns that follow from the row alone."""
    return enrich.derived(clean(spark, sf))


def enriched(spark: SparkSession, sf: str) -> DataFrame:
    return enrich.enrich_transactions(star.raw_transactions(spark, sf), LOAD_DATE)


def energy_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return integrate.energy_metrics(transactions(spark, sf), LOAD_DATE)


def segment_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return integrate.segment_metrics(transactions(spark, sf), customers(spark, sf), LOAD_DATE)


def loaded(spark: SparkSession, sf: str) -> tuple[str, DataFrame]:
    """Run the daily load into a fresh folder."""
    root = fresh_folder(spark, "lake")
    return root, daily.run_load(star.raw_datasets(spark, sf), root, LOAD_DATE)


def _stack(tables: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, tables)


# --- sources and sinks --------------------------------------------------------
def scan_csv(spark: SparkSession, sf: str) -> DataFrame:
    root = fresh_folder(spark, "landing")
    files.land({"transacciones": star.raw_transactions(spark, sf)}, spark, root, LOAD_DATE)
    return normalize.readable(files.scan_csv(spark, root, "transacciones", LOAD_DATE))


def scan_partition(spark: SparkSession, sf: str) -> DataFrame:
    """Two loads of a table, of which one is read."""
    root = fresh_folder(spark, "lake")
    for day in (LOAD_DATE, SECOND_DATE):
        files.write_processed(customers(spark, sf, day), root, "clientes", day)
    return files.read_processed(spark, root, "clientes", SECOND_DATE)


def sink_parquet(spark: SparkSession, sf: str) -> DataFrame:
    """A load written twice: the second run replaces the first."""
    root = fresh_folder(spark, "lake")
    rows = enriched(spark, sf)
    for _ in range(2):
        files.write_processed(rows, root, "transacciones", LOAD_DATE)
    return files.read_processed(spark, root, "transacciones")


def ingest_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Landed files taken in by two runs; the second finds nothing new."""
    landing, root = fresh_folder(spark, "landing"), fresh_folder(spark, "lake")
    checkpoint = fresh_folder(spark, "ingest")
    files.land({"transacciones": star.raw_transactions(spark, sf)}, spark, landing, LOAD_DATE)
    for _ in range(2):
        ingest.ingest(spark, "transacciones", landing, root, checkpoint, LOAD_DATE)
    rows = ingest.read_ingested(spark, root, "transacciones", LOAD_DATE)
    return normalize.readable(rows).drop("_origen", "_ingerido_en")


def partner_landing(spark: SparkSession, sf: str) -> str:
    """A lake that took in, by two runs, landings and what partners left beside them.

    Suppliers come in a file of reversed columns, and with a file of another table in
    their folder; customers are landed twice for one hour, the second time without rows,
    and once for another hour.
    """
    landing, root = fresh_folder(spark, "landing"), fresh_folder(spark, "lake")
    checkpoint = fresh_folder(spark, "ingest")
    raw = star.raw_datasets(spark, sf)
    reversed_ = raw["proveedores"].select(*S.RAW_COLUMNS["proveedores"][::-1])
    reversed_.write.options(**files.CSV_WRITE).csv(f"{landing}/raw/proveedores/socio")
    nations = spark.read.parquet(f"{sf}/nation.parquet").select("n_name").coalesce(1)
    nations.write.option("header", True).csv(f"{landing}/raw/proveedores/ajeno")
    files.land(raw, spark, landing, LOAD_DATE, 8)
    files.land({"proveedores": raw["proveedores"].limit(0)}, spark, landing, LOAD_DATE, 8)
    files.land({"clientes": raw["clientes"]}, spark, landing, LOAD_DATE, 9)
    ingest.ingest_all(spark, landing, root, checkpoint, LOAD_DATE)
    files.land({"clientes": raw["clientes"].limit(0)}, spark, landing, LOAD_DATE, 9)
    ingest.ingest_all(spark, landing, root, checkpoint, LOAD_DATE)
    return root


def ingest_reordenado(spark: SparkSession, sf: str) -> DataFrame:
    """All suppliers, from the file with reversed columns."""
    rows = ingest.read_ingested(spark, partner_landing(spark, sf), "proveedores", LOAD_DATE)
    return normalize.readable(rows).select(*S.RAW_COLUMNS["proveedores"])


def ingest_cuarentena(spark: SparkSession, sf: str) -> DataFrame:
    """Rows that each dataset took in, and the lines of files that it could not."""
    root = partner_landing(spark, sf)
    taken = _stack([
        ingest.read_ingested(spark, root, name).agg(
            F.lit(name).alias("tabla"), F.lit("ingerido").alias("motivo"),
            F.count(F.lit(1)).alias("lineas"),
        )
        for name in S.RAW_COLUMNS
    ])
    letters = _stack([
        ingest.read_dead_letters(spark, root, name).select(F.lit(name).alias("tabla"), "motivo")
        for name in S.RAW_COLUMNS
    ])
    return taken.unionByName(letters.groupBy("tabla", "motivo").agg(F.count(F.lit(1)).alias("lineas")))


def stream_unique(spark: SparkSession, sf: str) -> DataFrame:
    """Identifiers that a stream keeps of transactions of which a part is sent again."""
    landing, root = fresh_folder(spark, "landing"), fresh_folder(spark, "lake")
    checkpoint = fresh_folder(spark, "ingest")

    def land(sent: DataFrame, hour: int) -> None:
        files.land({"transacciones": sent}, spark, landing, LOAD_DATE, hour)

    def take() -> None:
        ingest.ingest(spark, "transacciones", landing, root, checkpoint, LOAD_DATE)
        unique.unique_rows(
            spark, root, "transacciones", f"{checkpoint}/unique",
            bytes_per_core=unique.BYTES_PER_CORE,
        )

    with work_folder(spark, "enviadas") as sending:
        # Joined once, and what the joins leave is gone before the rest is on disk.
        with work_folder(spark, "juntas") as joining:
            rows = stage(star.raw_transactions(spark, sf, joining), "transacciones", sending)
        land(rows, 8)
        take()
        land(rows.where("estado = 'completada'"), 9)
    take()
    kept = unique.read_unique(spark, root, "transacciones")
    return kept.groupBy("id_transaccion").agg(F.count(F.lit(1)).alias("filas"))


def landing_layout(spark: SparkSession, sf: str) -> DataFrame:
    root = fresh_folder(spark, "landing")
    return files.land(star.raw_datasets(spark, sf), spark, root, LOAD_DATE, "08")


def catalog_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """Status of the processed zone after a load, with the rows the catalog sees."""
    root, _ = loaded(spark, sf)
    database = Path(root).name.replace("-", "_")
    status = catalog.refresh(spark, root, database, "processed")
    rows = _stack([
        spark.table(f"{database}_processed.{name}").agg(
            F.lit(name).alias("tabla"), F.count(F.lit(1)).alias("filas")
        )
        for name in S.PROCESSED
    ])
    return status.drop("zona").join(rows, "tabla")


def catalog_zones(spark: SparkSession, sf: str) -> DataFrame:
    """Status of all zones after an ingest, a load and a stored query; refreshed twice."""
    landing, root = fresh_folder(spark, "landing"), fresh_folder(spark, "lake")
    files.land(star.raw_datasets(spark, sf), spark, landing, LOAD_DATE)
    ingest.ingest_all(spark, landing, root, fresh_folder(spark, "ingest"), LOAD_DATE)
    daily.load_ingested(spark, root, LOAD_DATE)
    results = analytics.run_queries(daily.processed_tables(spark, root, LOAD_DATE), LOAD_DATE, "q7")
    files.write_curated(results["q7"], root, "q7")
    database = Path(root).name.replace("-", "_")
    catalog.refresh(spark, root, database)
    status = catalog.refresh(spark, root, database).where("estado = 'SUCCEEDED'")
    rows = _stack([
        spark.table(f"{database}_{zone}.{name}").agg(
            F.lit(zone).alias("zona"), F.lit(name).alias("tabla"),
            F.count(F.lit(1)).alias("filas"),
        )
        for zone, names in (("raw", S.RAW_COLUMNS), ("processed", S.PROCESSED), ("curated", ["q7"]))
        for name in names
    ])
    return status.join(rows, ["zona", "tabla"])


def run_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return loaded(spark, sf)[1]


def stored_warehouse(spark: SparkSession, sf: str) -> str:
    """The warehouse database of a fresh daily load, loaded twice."""
    root, _ = loaded(spark, sf)
    location = fresh_folder(spark, "dwh")
    database = Path(location).name.replace("-", "_")
    warehouse_tables.create_tables(spark, database, location)
    for _ in range(2):
        tables = daily.processed_tables(spark, root, LOAD_DATE)
        warehouse_tables.load(spark, tables, database)
    return database


def warehouse_load(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of each warehouse table after a load, with a sum over hashes of all columns."""
    database = stored_warehouse(spark, sf)

    def summed(table: str) -> DataFrame:
        texts = [
            F.coalesce(F.col(name).cast("string"), F.lit("")) for name in S.WAREHOUSE[table]
        ]
        digits = F.conv(F.substring(F.md5(F.concat_ws("|", *texts)), 1, 12), 16, 10)
        return spark.table(f"{database}.{table}").agg(
            F.lit(table).alias("tabla"),
            F.count(F.lit(1)).alias("filas"),
            F.sum(digits.cast("decimal(20,0)")).cast("decimal(38,0)").alias("huella"),
        )

    return _stack([summed(table) for table in S.WAREHOUSE])


def stored_margin(spark: SparkSession, sf: str) -> DataFrame:
    return spark.table(f"{stored_warehouse(spark, sf)}.v_margen_energia")


def stored_summary(spark: SparkSession, sf: str) -> DataFrame:
    return spark.table(f"{stored_warehouse(spark, sf)}.v_resumen_diario")


def export_result(spark: SparkSession, sf: str) -> DataFrame:
    folder = fresh_folder(spark, "export")
    result = pending(spark, sf)
    files.export(result, folder, "csv")
    return spark.read.schema(result.schema).options(**files.CSV_READ).csv(folder)


def export_json(spark: SparkSession, sf: str) -> DataFrame:
    folder = fresh_folder(spark, "export")
    result = pending(spark, sf)
    files.export(result, folder, "json")
    return spark.read.schema(result.schema).json(folder)


def cataloged(spark: SparkSession, sf: str) -> str:
    """The catalog database of a fresh daily load."""
    root, _ = loaded(spark, sf)
    database = Path(root).name.replace("-", "_")
    catalog.refresh(spark, root, database, "processed")
    return f"{database}_processed"


def catalog_listing(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.listing(spark, [cataloged(spark, sf)]).drop("base")


def analyst_views(spark: SparkSession, sf: str) -> DataFrame:
    """The analysts' view of the stored customers, without the partition columns."""
    database = cataloged(spark, sf)
    catalog.create_analyst_views(spark, database, f"{database}_analistas")
    return spark.table(f"{database}_analistas.clientes_analista").drop(*S.DAY_PARTITION)


def stored_queries(spark: SparkSession, sf: str) -> DataFrame:
    """Chosen queries over the stored tables of the catalog."""
    tables = analytics.tables_of(spark, cataloged(spark, sf))
    chosen = analytics.run_queries(tables, LOAD_DATE, "q1,q3")
    return chosen["q3"]


def ingest_otros(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of a file of no declared table, beside files of a declared one."""
    landing, root = fresh_folder(spark, "landing"), fresh_folder(spark, "lake")
    checkpoint = fresh_folder(spark, "ingest")
    files.land({"proveedores": star.raw_suppliers(spark, sf)}, spark, landing, LOAD_DATE)
    nations = spark.read.parquet(f"{sf}/nation.parquet").select("n_name")
    nations.write.csv(f"{landing}/varios/Paises.csv")
    for _ in range(2):
        ingest.ingest_other(spark, landing, root, checkpoint, LOAD_DATE)
    return ingest.read_ingested(spark, root, ingest.LINES).select("tabla", "linea")


# --- columns of transactions and customers ------------------------------------
def mask_id(spark: SparkSession, sf: str) -> DataFrame:
    return normalize.typed(star.raw_customers(spark, sf), "clientes").select(
        "nombre",
        "identificacion",
        C.masked(F.col("identificacion")).alias("identificacion_enmascarada"),
    )


def tx_valor_total(spark: SparkSession, sf: str) -> DataFrame:
    return enrich.with_total_value(clean(spark, sf)).select(
        "id_transaccion", "cantidad_kwh", "precio_cop_kwh", "valor_total_cop"
    )


def tx_band(spark: SparkSession, sf: str) -> DataFrame:
    return enrich.with_volume_band(clean(spark, sf)).select(
        "id_transaccion", "cantidad_kwh", "clasificacion_volumen"
    )


def tx_calendar(spark: SparkSession, sf: str) -> DataFrame:
    return enrich.with_calendar(clean(spark, sf)).select(
        "id_transaccion", "fecha_transaccion", "anio", "mes", "dia_semana"
    )


def tx_price_stats(spark: SparkSession, sf: str) -> DataFrame:
    return enriched(spark, sf).select(
        "id_transaccion",
        "tipo_energia",
        "precio_cop_kwh",
        "precio_promedio_tipo_energia",
        "sobre_precio_promedio",
        "desviacion_precio_pct",
    )


# --- joins, views and reports ---------------------------------------------------
def ventas_cliente(spark: SparkSession, sf: str) -> DataFrame:
    return integrate.customer_sales(transactions(spark, sf), customers(spark, sf))


def compras_proveedor(spark: SparkSession, sf: str) -> DataFrame:
    return integrate.supplier_purchases(transactions(spark, sf), suppliers(spark, sf))


def pending(spark: SparkSession, sf: str) -> DataFrame:
    return analytics.pending_transactions(transactions(spark, sf), LOAD_DATE)


def agg_metricas_energia(spark: SparkSession, sf: str) -> DataFrame:
    return warehouse.warehouse_rows(energy_metrics(spark, sf), "agg_metricas_energia")


def fact_transacciones(spark: SparkSession, sf: str) -> DataFrame:
    return warehouse.warehouse_rows(enriched(spark, sf), "fact_transacciones")


def v_margen_energia(spark: SparkSession, sf: str) -> DataFrame:
    """The view joins the stored metrics to themselves."""
    return warehouse.margin_view(stage(agg_metricas_energia(spark, sf), "metricas"))


def v_resumen_diario(spark: SparkSession, sf: str) -> DataFrame:
    facts = warehouse.warehouse_rows(
        transactions(spark, sf), "fact_transacciones", warehouse.SUMMARY_COLUMNS
    )
    return warehouse.daily_summary_view(facts)


def dq_report(spark: SparkSession, sf: str) -> DataFrame:
    tables = {
        "proveedores": suppliers(spark, sf),
        "clientes": customers(spark, sf),
        "transacciones": enriched(spark, sf),
    }
    return _stack([quality.quality_report(table, name) for name, table in tables.items()])


def dq_source(spark: SparkSession, sf: str) -> DataFrame:
    """Unknown categories and null keys of all rows, before the filters and the deduplication."""
    return _stack([
        quality.source_report(normalize.typed(raw, name), name)
        for name, raw in star.raw_datasets(spark, sf).items()
    ])


def dq_unique(spark: SparkSession, sf: str) -> DataFrame:
    """Keys that repeat before the deduplication, and names that customers share."""
    typed = {
        name: normalize.typed(raw, name) for name, raw in star.raw_datasets(spark, sf).items()
    }
    return _stack([
        *[quality.uniqueness_report(table, name) for name, table in typed.items()],
        quality.shared_names(typed["clientes"]),
    ])


def quarantine(spark: SparkSession, sf: str) -> DataFrame:
    labels = {
        "proveedores": "nombre_proveedor",
        "clientes": "identificacion",
        "transacciones": "id_transaccion",
    }
    return _stack([
        normalize.quarantine(raw, name).select(
            F.lit(name).alias("tabla"), F.col(labels[name]).alias("clave"), "motivo"
        )
        for name, raw in star.raw_datasets(spark, sf).items()
    ])


def entry(spark: SparkSession) -> DataFrame:
    """Completed purchases per energy type (q1) on the smallest data."""
    return queries()["q1"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    """One callable per operator of the inventory, and those on corpora if they are there."""
    return own_queries() | corpus_queries()


def corpus_queries() -> dict[str, Query]:
    """Their functions run in Python workers, so each sends the package first."""
    found = dict(corpus.queries()) if corpus else {}
    if corpus_pipeline:
        found["pipeline"] = corpus_pipeline.run

    def shipped(query: Query) -> Query:
        def run(spark: SparkSession, sf: str) -> DataFrame:
            ship(spark)
            return query(spark, sf)

        return run

    return {name: shipped(query) for name, query in found.items()}


def own_queries() -> dict[str, Query]:
    return {
        "scan_csv": scan_csv,
        "scan_partition": scan_partition,
        "sink_parquet": sink_parquet,
        "ingest_stream": ingest_stream,
        "ingest_reordenado": ingest_reordenado,
        "ingest_cuarentena": ingest_cuarentena,
        "stream_unique": stream_unique,
        "landing_layout": landing_layout,
        "catalog_refresh": catalog_refresh,
        "catalog_zones": catalog_zones,
        "run_metrics": run_metrics,
        "warehouse_load": warehouse_load,
        "stored_margin": stored_margin,
        "stored_summary": stored_summary,
        "export_result": export_result,
        "export_json": export_json,
        "catalog_listing": catalog_listing,
        "analyst_views": analyst_views,
        "stored_queries": stored_queries,
        "ingest_otros": ingest_otros,
        "norm_proveedores": suppliers,
        "norm_clientes": customers,
        "mask_id": mask_id,
        "dedup_tx": clean,
        "tx_valor_total": tx_valor_total,
        "tx_band": tx_band,
        "tx_calendar": tx_calendar,
        "tx_price_stats": tx_price_stats,
        "enrich_transacciones": enriched,
        "band_counts": lambda spark, sf: integrate.band_counts(transactions(spark, sf)),
        "ventas_cliente": ventas_cliente,
        "compras_proveedor": compras_proveedor,
        "metricas_energia": energy_metrics,
        "metricas_segmento": segment_metrics,
        "q1": lambda spark, sf: analytics.purchased_energy(transactions(spark, sf)),
        "q2": lambda spark, sf: analytics.top_customers(transactions(spark, sf)),
        "q3": lambda spark, sf: analytics.market_prices(transactions(spark, sf)),
        "q4": pending,
        "q5": lambda spark, sf: analytics.margins(transactions(spark, sf)),
        "q6": lambda spark, sf: analytics.customer_distribution(customers(spark, sf)),
        "q7": lambda spark, sf: analytics.active_suppliers(suppliers(spark, sf)),
        "v_margen_energia": v_margen_energia,
        "v_resumen_diario": v_resumen_diario,
        "dim_proveedores": lambda spark, sf: warehouse.warehouse_rows(
            suppliers(spark, sf), "dim_proveedores"
        ),
        "dim_clientes": lambda spark, sf: warehouse.warehouse_rows(
            customers(spark, sf), "dim_clientes"
        ),
        "fact_transacciones": fact_transacciones,
        "agg_metricas_energia": agg_metricas_energia,
        "agg_metricas_segmento": lambda spark, sf: warehouse.warehouse_rows(
            segment_metrics(spark, sf), "agg_metricas_segmento"
        ),
        "dq_report": dq_report,
        "dq_source": dq_source,
        "dq_unique": dq_unique,
        "quarantine": quarantine,
        "clientes_analista": lambda spark, sf: warehouse.analyst_customers(customers(spark, sf)),
    }


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL for each query."""
    found = dict(ORACLES) | (corpus.oracle_sql() if corpus else {})
    sql = corpus_pipeline.ORACLE_SQL if corpus_pipeline else None
    return found | ({"pipeline": sql} if sql else {})
