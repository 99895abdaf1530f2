"""The daily load: raw datasets of one date to the five processed tables."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from voltalake.operators import normalize
from voltalake.operators.enrich import enriched
from voltalake.operators.integrate import energy_metrics, segment_metrics
from voltalake.schemas import PROCESSED, RAW_COLUMNS
from voltalake.session import work_folder
from voltalake.sources.files import read_processed, write_processed, write_rejected
from voltalake.streaming.ingest import read_ingested

METRICS = (
    "tabla string, leidas bigint, ilegibles bigint, filtradas bigint, fusionadas bigint, "
    "filas bigint"
)


class _Watch:
    """Rows that pass some points of a plan, counted while it runs."""

    def __init__(self) -> None:
        self.points: dict[str, Observation] = {}

    def __call__(self, rows: DataFrame, point: str) -> DataFrame:
        self.points[point] = Observation()
        return rows.observe(self.points[point], F.count(F.lit(1)).alias("n"))

    def count(self, point: str) -> int:
        return self.points[point].get.get("n", 0)


def run_load(
    raw: Mapping[str, DataFrame],
    root: str,
    load_date: str | date,
    as_of: str | date | None = None,
    rejects: bool = False,
) -> DataFrame:
    """Write the processed tables of ``load_date`` under ``root``.

    Each table is written once, and the metrics read the written tables and
    not the raw data again. A second run replaces the first. With ``rejects`` the
    raw rows that have something unreadable are kept too, with the reason, under
    ``root/rejected``, which reads the raw rows once more.

    Returns a row per table, counted while writing: rows read (``leidas``), lines of
    the wrong shape (``ilegibles``), rows of unknown categories (``filtradas``), rows
    merged into another with their key (``fusionadas``), and rows loaded (``filas``).
    The first is the sum of the others; metrics have only the last.
    """
    spark = next(iter(raw.values())).sparkSession
    as_of = as_of or load_date
    counts: dict[str, tuple[int | None, ...]] = {}
    watch = {name: _Watch() for name in RAW_COLUMNS}

    def known(name: str) -> DataFrame:
        good = normalize.readable(watch[name](raw[name], "leidas"))
        return watch[name](normalize.known(watch[name](good, "legibles"), name), "conocidas")

    def save(dataset: str, rows: DataFrame) -> DataFrame:
        loaded = write_processed(rows, root, dataset, load_date)
        counts[dataset] = (None, None, None, None, loaded)
        if dataset in watch:
            points = ("leidas", "legibles", "conocidas")
            read, readable, kept = (watch[dataset].count(x) for x in points)
            counts[dataset] = (read, read - readable, readable - kept, kept - loaded, loaded)
        return read_processed(spark, root, dataset, load_date)

    save("proveedores", normalize.finished_suppliers(known("proveedores"), load_date))
    customers = save(
        "clientes", normalize.finished_customers(known("clientes"), load_date, as_of)
    )
    with work_folder(spark, "load") as folder:
        transactions = save("transacciones", enriched(known("transacciones"), load_date, folder))
    save("metricas_energia", energy_metrics(transactions, load_date))
    save("metricas_segmento", segment_metrics(transactions, customers, load_date))
    if rejects:
        for name, rows in raw.items():
            write_rejected(normalize.quarantine(rows, name), root, name, load_date)
    return spark.createDataFrame([(k, *v) for k, v in counts.items()], METRICS)


def load_ingested(
    spark: SparkSession, root: str, load_date: str | date, as_of: str | date | None = None
) -> DataFrame:
    """The load of the rows that were ingested under ``root`` on a day, with its rejects."""
    raw = {name: read_ingested(spark, root, name, load_date) for name in RAW_COLUMNS}
    return run_load(raw, root, load_date, as_of, rejects=True)


def processed_tables(
    spark: SparkSession, root: str, load_date: str | date
) -> dict[str, DataFrame]:
    """The processed tables of one load."""
    return {name: read_processed(spark, root, name, load_date) for name in PROCESSED}
