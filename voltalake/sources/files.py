"""CSV and Parquet datasets partitioned by load date."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltalake import schemas as S
from voltalake.session import freed_shuffles
from voltalake.sources import csv_files, layout, storage
from voltalake.sources.csv_files import CSV_READ

# ``land`` names its files so, which tells them from part files of other writers. A
# manifest beside them says which ones count; it comes last.
LANDED = "carga"
MANIFEST = ".manifiesto"
CSV_WRITE = {
    "header": "true",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
# What ``land`` writes takes a fifth of its text. A file is one task's work then, as it
# was to write.
LANDED_WRITE = {**CSV_WRITE, "compression": "gzip"}


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Share out a scan that has fewer pieces than the session has cores.

    That is so for a small input, and for one large file that cannot be split.
    A scan with pieces enough stays as it is, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, *keys)


def scan_csv(
    spark: SparkSession, root: str, dataset: str, load_date: str | date | None = None
) -> DataFrame:
    """Raw text rows of ``root/raw/dataset``: those of one load date, or all.

    Columns are mapped by the name in each file's header, and records may span
    lines. Lines of a file with another header come in the corrupt-record column.
    """
    folder = f"{root}/raw/{dataset}"
    if load_date is not None:
        folder = f"{folder}/{layout.as_path(layout.day_parts(load_date))}"
    return rows_of(spark, dataset, _data_files(csv_files.files_under(spark, folder)))


def _data_files(paths: list[str]) -> list[str]:
    return [x for x in paths if not x.endswith(MANIFEST)]


def rows_of(spark: SparkSession, dataset: str, paths: list[str]) -> DataFrame:
    """Raw text rows of some files, those of rejected files as corrupt records."""
    found = csv_files.sort_files(spark, dataset, paths)
    rows = csv_files.read_sorted(spark, dataset, found)
    if not found.rejected:
        return rows
    lines = csv_files.lines_of(spark, found.rejected)
    missing = [F.lit(None).cast("string").alias(x) for x in S.RAW_COLUMNS[dataset]]
    text = F.coalesce("linea", F.concat_ws(": ", "ruta", "motivo")).alias(S.CORRUPT)
    return rows.unionByName(lines.select(*missing, text))


def land(
    sources: Mapping[str, DataFrame | str],
    spark: SparkSession,
    root: str,
    load_date: str | date,
    hour: str | int = 0,
    dry_run: bool = False,
) -> DataFrame:
    """Write the three raw datasets as CSV into the landing layout.

    A source is a DataFrame or the path of a CSV; a missing one is reported
    as ``omitido``. Landing an hour again replaces it, also by no rows: the files
    come first and then a manifest with their names and the number of rows, which
    is what an ingest goes by. With ``dry_run`` nothing is written. Returns
    ``dataset, destino, filas, estado``.
    """
    results = []
    parts = layout.hour_parts(load_date, hour)
    for dataset in S.RAW_COLUMNS:
        target = layout.landing_path(dataset, load_date, hour)
        rows = _landing_source(sources.get(dataset), spark, dataset)
        if rows is None:
            results.append((dataset, target, None, "omitido"))
        elif dry_run:
            results.append((dataset, target, rows.count(), "simulado"))
        else:
            seen = Observation()
            folder = f"{root}/raw/{dataset}/{layout.as_path(parts)}"
            with freed_shuffles(spark):
                (
                    rows.observe(seen, F.count(F.lit(1)).alias("filas"))
                    .write.mode("overwrite")
                    .options(**LANDED_WRITE)
                    .option("mapreduce.output.basename", LANDED)
                    .csv(folder)
                )
            _declare(spark, folder, seen.get["filas"])
            results.append((dataset, target, seen.get["filas"], "ok"))
    return spark.createDataFrame(
        results, "dataset string, destino string, filas bigint, estado string"
    )


def _declare(spark: SparkSession, folder: str, rows: int) -> None:
    """Put the manifest of a landing into its folder."""
    found = [x for x in storage.names(spark, folder) if x.startswith(f"{LANDED}-")]
    name = uuid.uuid4().hex
    manifest = {"id": name, "archivos": found, "filas": rows}
    storage.write_text(spark, f"{folder}/{LANDED}-{name}{MANIFEST}", json.dumps(manifest))


def _landing_source(
    source: DataFrame | str | None, spark: SparkSession, dataset: str
) -> DataFrame | None:
    """Rows to land. A file that cannot be read is an error here, as nothing is taken yet."""
    if source is None or isinstance(source, DataFrame):
        return source
    try:
        paths = _data_files(csv_files.files_under(spark, source))
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    found = csv_files.sort_files(spark, dataset, paths)
    if found.rejected:
        raise ValueError(f"{found.rejected[0].path}: {found.rejected[0].reason}")
    return csv_files.read_sorted(spark, dataset, found).drop(S.CORRUPT)


def write_processed(
    df: DataFrame, root: str, dataset: str, load_date: str | date
) -> int:
    """Write one load of a processed table and return its number of rows.

    The folder of the load date is replaced and no other, so a load can run again,
    also with no rows. The rows are counted on the way.
    """
    parts = layout.day_parts(load_date)
    seen = Observation()
    (
        df.observe(seen, F.count(F.lit(1)).alias("filas"))
        .write.mode("overwrite")
        .option("compression", "snappy")
        .parquet(f"{root}/processed/{dataset}/{layout.as_path(parts)}")
    )
    return seen.get["filas"]


def write_rejected(df: DataFrame, root: str, dataset: str, load_date: str | date) -> None:
    """Keep the rejected raw rows of a load, with their reasons; a second run replaces them."""
    place = layout.as_path(layout.day_parts(load_date))
    df.write.mode("overwrite").parquet(f"{root}/rejected/{dataset}/{place}")


def read_rejected(
    spark: SparkSession, root: str, dataset: str, load_date: str | date
) -> DataFrame:
    place = layout.as_path(layout.day_parts(load_date))
    schema = S.raw_schema(dataset).add("motivo", "string")
    return spark.read.schema(schema).parquet(f"{root}/rejected/{dataset}/{place}")


def read_processed(
    spark: SparkSession, root: str, dataset: str, load_date: str | date | None = None
) -> DataFrame:
    """One load of a processed table, or all with their partition columns.

    The declared schema keeps the partition values as zero-padded text and
    spares the reading of file footers.
    """
    schema = S.processed_schema(dataset)
    for name in S.DAY_PARTITION:
        schema = schema.add(name, T.StringType())
    rows = spark.read.schema(schema).parquet(f"{root}/processed/{dataset}")
    if load_date is None:
        return rows
    return rows.where(layout.matches(layout.day_parts(load_date))).drop(*S.DAY_PARTITION)


def write_curated(df: DataFrame, root: str, name: str) -> None:
    """Store the result of a query under ``root/curated/name``, replacing the last one."""
    df.write.mode("overwrite").option("compression", "snappy").parquet(f"{root}/curated/{name}")


def export(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Write a result as CSV with header, or as JSON lines."""
    if fmt not in ("csv", "json"):
        raise ValueError(f"unknown export format {fmt!r}; choose csv or json")
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer.options(**CSV_WRITE).csv(path)
    else:
        writer.option("ignoreNullFields", "false").json(path)
