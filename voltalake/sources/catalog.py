"""Registration of lake folders as tables, and their refresh."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltalake import schemas as S
from voltalake.plans.analytics import REGISTRY
from voltalake.plans.warehouse import analyst_customers
from voltalake.sources import storage

# Datasets and partition columns of each zone.
ZONES = {
    "raw": (tuple(S.RAW_COLUMNS), ("fecha", "lote", "carga")),
    "processed": (tuple(S.PROCESSED), S.DAY_PARTITION),
    "curated": (tuple(REGISTRY), ()),
}
# Table property: the last change of a partition's folder that a refresh has seen.
SEEN = "voltalake.visto"
STATEMENT = 500
STATUS = "zona string, tabla string, columnas int, particiones bigint, estado string"


def refresh(
    spark: SparkSession, root: str, database: str, zone: str = "all", again: bool = False
) -> DataFrame:
    """Bring the catalog up to date with the folders ``root/zone``, of one or all.

    New tables, partitions and columns are added, and partitions whose folder is gone
    go. Folders are listed; file footers are read only in those that are new or have
    changed since the last refresh (``again``: in all, for stores whose folders have no
    time of change). The tables of a zone are in ``<database>_<zone>``. Returns one
    status row per table; a folder that is not there is ``FAILED`` and stops nothing.
    """
    if zone != "all" and zone not in ZONES:
        raise ValueError(f"unknown zone {zone!r}; choose from {[*ZONES, 'all']}")
    status = []
    for name in ZONES if zone == "all" else (zone,):
        datasets, partitions = ZONES[name]
        spark.sql(
            f"CREATE DATABASE IF NOT EXISTS {database}_{name} LOCATION '{root}/catalog/{name}'"
        )
        for dataset in datasets:
            status.append(
                (name, dataset, *_refresh_table(
                    spark, f"{database}_{name}.{dataset}", f"{root}/{name}/{dataset}",
                    partitions, again,
                ))
            )
    return spark.createDataFrame(status, STATUS)


def _partition_folders(
    spark: SparkSession, folder: str, partitions: tuple[str, ...]
) -> dict[tuple[str, ...], int]:
    """Values of all partitions under a folder, with the time of their last change."""
    found: dict[tuple[str, ...], int] = {(): 0}
    for key in partitions:
        found = {
            (*values, name.removeprefix(f"{key}=")): changed
            for values in found
            for name, changed in storage.folders(
                spark, "/".join([folder, *_parts(partitions, values)])
            ).items()
            if name.startswith(f"{key}=")
        }
    return found


def _parts(partitions: tuple[str, ...], values: tuple[str, ...]) -> list[str]:
    return [f"{k}={v}" for k, v in zip(partitions, values)]


def _columns_in(
    spark: SparkSession, folders: list[str], partitions: tuple[str, ...]
) -> dict[str, str]:
    """Columns of the files in some folders, from their footers."""
    found = spark.read.option("mergeSchema", "true").parquet(*folders)
    return {f.name: f.dataType.simpleString() for f in found.schema if f.name not in partitions}


def _refresh_table(
    spark: SparkSession, table: str, folder: str, partitions: tuple[str, ...], again: bool
) -> tuple[int | None, int | None, str]:
    known = spark.catalog.tableExists(table)
    found = _partition_folders(spark, folder, partitions) if partitions else {}
    seen = int(_property(spark, table) or -1) if known else -1
    listed = _known_partitions(spark, table) if known and partitions else set()
    new = [x for x in found if x not in listed]
    changed = [x for x, at in found.items() if again or x not in listed or at > seen]
    opened = ["/".join([folder, *_parts(partitions, x)]) for x in changed]
    if not partitions or not known:
        opened = opened or [folder]
    try:
        columns = _columns_in(spark, opened, partitions) if opened else {}
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        if not known:
            return None, None, "FAILED"
        columns = {}
    if known:
        _add_columns(spark, table, columns)
    else:
        spark.sql(_create_statement(table, folder, columns, partitions))
    if partitions:
        _partitions(spark, table, "ADD IF NOT EXISTS", partitions, new)
        gone = sorted(listed - set(found))
        _partitions(spark, table, "DROP IF EXISTS", partitions, gone)
        newest = max([seen, *found.values()])
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{SEEN}' = '{newest}')")
    spark.catalog.refreshTable(table)
    count = len(found) if partitions else None
    return len(spark.table(table).columns), count, "SUCCEEDED"


def _property(spark: SparkSession, table: str) -> str | None:
    rows = spark.sql(f"SHOW TBLPROPERTIES {table}").where(F.col("key") == SEEN)
    return next((x["value"] for x in rows.collect()), None)


def _known_partitions(spark: SparkSession, table: str) -> set[tuple[str, ...]]:
    rows = spark.sql(f"SHOW PARTITIONS {table}").collect()
    return {tuple(part.split("=", 1)[1] for part in x[0].split("/")) for x in rows}


def _partitions(
    spark: SparkSession, table: str, what: str, partitions: tuple[str, ...], values: list
) -> None:
    """Add or drop partitions, some hundred in a statement."""
    for k in range(0, len(values), STATEMENT):
        specs = [
            "PARTITION (" + ", ".join(f"{c} = '{v}'" for c, v in zip(partitions, x)) + ")"
            for x in values[k : k + STATEMENT]
        ]
        separator = " " if what.startswith("ADD") else ", "
        spark.sql(f"ALTER TABLE {table} {what} {separator.join(specs)}")


def _create_statement(
    table: str, folder: str, columns: dict[str, str], partitions: tuple[str, ...]
) -> str:
    """External table; partition keys are text, so ``month=01`` stays ``01``."""
    typed = {**columns, **dict.fromkeys(partitions, "string")}
    fields = ", ".join(f"`{name}` {kind}" for name, kind in typed.items())
    keys = f"PARTITIONED BY ({', '.join(partitions)})" if partitions else ""
    return f"CREATE TABLE {table} ({fields}) USING parquet {keys} LOCATION '{folder}'"


def _add_columns(spark: SparkSession, table: str, columns: dict[str, str]) -> None:
    present = set(spark.table(table).columns)
    new = [f"`{name}` {kind}" for name, kind in columns.items() if name not in present]
    if new:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(new)})")


def listing(spark: SparkSession, databases: Iterable[str]) -> DataFrame:
    """Tables of the databases with their number of columns."""
    rows = [
        (database, table.name, len(spark.catalog.listColumns(f"{database}.{table.name}")))
        for database in databases
        for table in spark.catalog.listTables(database)
        if not table.isTemporary
    ]
    return spark.createDataFrame(rows, "base string, tabla string, columnas int")


def create_analyst_views(spark: SparkSession, database: str, target: str) -> None:
    """Database of views for analysts: all processed tables, customers without the
    full identification."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {target}")
    for table in S.PROCESSED:
        source = spark.table(f"{database}.{table}")
        shown = analyst_customers(source) if table == "clientes" else source
        view = "clientes_analista" if table == "clientes" else table
        fields = ", ".join(f"`{c}`" for c in shown.columns)
        spark.sql(
            f"CREATE OR REPLACE VIEW {target}.{view} AS SELECT {fields} FROM {database}.{table}"
        )
