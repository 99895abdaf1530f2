"""Loading of the warehouse tables, all of them in one step.

Each table is stored by load (``<table>_cargas``, partitioned by ``lote``). The table
``versiones`` says which load each shows, and the tables that readers use are
views that look there. A load writes all its rows beside the old ones and then adds
one row to ``versiones``; before that nothing has changed for any reader, after it all.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltalake import schemas as S
from voltalake.plans.warehouse import VIEWS, warehouse_rows
from voltalake.session import stage
from voltalake.sources import storage

# The fact table lies by month, sorted by day inside each file. The others
# are small and have no partitions.
_PARTITIONS = {"fact_transacciones": ("anio", "mes")}
LOAD_STATUS = "dataset string, tabla string, estado string, no_caben bigint"


STORED = "{}_cargas"
VERSIONS = "versiones"
# Loads whose rows stay besides the one that is shown, for readers that are at it.
KEPT = 1


def create_tables(spark: SparkSession, database: str, location: str | None = None) -> None:
    """Create the database, its tables and its views where they do not exist."""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{place}")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {database}.{VERSIONS} "
        "(orden bigint, lotes map<string, string>) USING parquet"
    )
    shown = f"(SELECT max_by(lotes, orden) AS lotes FROM {database}.{VERSIONS})"
    for table, columns in S.WAREHOUSE.items():
        stored = f"{database}.{STORED.format(table)}"
        fields = ", ".join(f"`{name}` {kind}" for name, kind in columns.items())
        keys = ", ".join(("lote", *_PARTITIONS.get(table, ())))
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {stored} ({fields}, lote string) USING parquet "
            f"PARTITIONED BY ({keys})"
        )
        # The folder of the load is chosen before the files are listed.
        spark.sql(
            f"CREATE OR REPLACE VIEW {database}.{table} AS SELECT {', '.join(columns)} "
            f"FROM {stored} WHERE lote = (SELECT lotes['{table}'] FROM {shown})"
        )
    for view, text in VIEWS.items():
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{view} AS {text.format(db=database)}")


def shown_loads(spark: SparkSession, database: str, back: int = 0) -> dict[str, str]:
    """The load that each table shows, or showed ``back`` loads ago."""
    rows = spark.table(f"{database}.{VERSIONS}").orderBy(F.desc("orden")).take(back + 1)
    return rows[back]["lotes"] if len(rows) > back else {}


def load(
    spark: SparkSession, processed: Mapping[str, DataFrame], database: str
) -> DataFrame:
    """Replace the content of all warehouse tables by their processed datasets.

    All tables are checked, then written beside the old content, then shown together.
    A load that fails at any point leaves the old content everywhere; what it wrote
    goes with the next one. A dataset without rows is skipped and the old content
    stays. Returns ``dataset, tabla, estado, no_caben``, the last being the numbers
    that their columns cannot hold and that become NULL.
    """
    status, full = [], {}
    for dataset, table in S.WAREHOUSE_OF.items():
        if processed[dataset].isEmpty():
            status.append((dataset, table, "omitido", None))
        else:
            status.append((dataset, table, "ok", checked(processed[dataset], table)))
            full[table] = processed[dataset]
    lot = uuid.uuid4().hex
    loads = dict(shown_loads(spark, database))
    for table, rows in full.items():
        _append(rows, database, table, lot)
        loads[table] = lot
    if full:
        _show(spark, database, loads)
        _forget(spark, database)
    return spark.createDataFrame(status, LOAD_STATUS)


def _append(rows: DataFrame, database: str, table: str, lot: str) -> None:
    """Add the rows of a load, which no one sees yet."""
    stored = f"{database}.{STORED.format(table)}"
    typed = laid_out(warehouse_rows(rows, table), table).withColumn("lote", F.lit(lot))
    order = typed.sparkSession.table(stored).columns
    typed.select(*order).write.insertInto(stored)


def _show(spark: SparkSession, database: str, loads: Mapping[str, str]) -> None:
    """The one step that changes what readers see: a row in a file of its own."""
    last = spark.table(f"{database}.{VERSIONS}").agg(F.max("orden")).first()[0] or 0
    row = spark.createDataFrame([(last + 1, dict(loads))], "orden bigint, lotes map<string, string>")
    row.coalesce(1).write.insertInto(f"{database}.{VERSIONS}")


def _forget(spark: SparkSession, database: str) -> None:
    """Drop the rows of loads that no table shows or showed ``KEPT`` loads ago."""
    for table in S.WAREHOUSE:
        kept = {shown_loads(spark, database, k).get(table) for k in range(KEPT + 1)}
        stored = f"{database}.{STORED.format(table)}"
        parts = spark.sql(f"SHOW PARTITIONS {stored}").collect()
        found = {x[0].split("/")[0].removeprefix("lote=") for x in parts}
        place = spark.sql(f"DESCRIBE FORMATTED {stored}").where("col_name = 'Location'")
        for lot in found - kept:
            spark.sql(f"ALTER TABLE {stored} DROP IF EXISTS PARTITION (lote = '{lot}')")
            storage.delete(spark, f"{place.first()['data_type']}/lote={lot}")


def checked(rows: DataFrame, table: str) -> int:
    """How many numbers do not fit in the table's columns.

    A missing value in a required column or a text that is too long is an error.
    """
    numbers, errors = [F.lit(0)], {}
    for name, kind in S.WAREHOUSE[table].items():
        plain = kind.removesuffix(" not null")
        if plain != kind:
            errors[f"{name} is missing"] = F.col(name).isNull()
        if plain.startswith("varchar"):
            limit = int(plain[len("varchar(") : -1])
            errors[f"{name} EXCEED_LIMIT_LENGTH {limit}"] = F.length(name) > limit
        elif plain.startswith("decimal"):
            lost = F.col(name).isNotNull() & F.col(name).try_cast(plain).isNull()
            # What is smaller by one than the limit fits; the cast takes its time.
            digits, scale = map(int, plain[len("decimal(") : -1].split(","))
            fits = F.abs(F.col(name)) < float(10 ** (digits - scale) - 1)
            numbers.append(F.when(fits, 0).otherwise(lost.cast("int")))
    counted = rows.agg(
        F.sum(sum(numbers[1:], numbers[0])).alias("_lost"),
        *[F.count_if(bad).alias(what) for what, bad in errors.items()],
    ).first()
    wrong = {what: counted[what] for what in errors if counted[what]}
    if wrong:
        raise ValueError(f"{table} cannot be loaded; rows by fault: {wrong}")
    return counted["_lost"] or 0


def laid_out(rows: DataFrame, table: str) -> DataFrame:
    """Rows in the file layout of a table: sorted, and the facts gathered by month.

    ``rebalance`` gathers a month's rows into few files and, unlike a plain
    repartition, splits a month that is too large for one task.
    """
    if table in _PARTITIONS:
        rows = rows.hint("rebalance", *_PARTITIONS[table])
    return rows.sortWithinPartitions(*_PARTITIONS.get(table, ()), *S.WAREHOUSE_SORT[table])


def load_jdbc(
    processed: Mapping[str, DataFrame], url: str, schema: str, properties: dict[str, str]
) -> None:
    """The same load into an external database: check, stage, truncate, insert."""
    for dataset, table in S.WAREHOUSE_OF.items():
        if processed[dataset].isEmpty():
            continue
        checked(processed[dataset], table)
        rows = stage(warehouse_rows(processed[dataset], table), f"jdbc-{table}")
        rows.write.mode("overwrite").option("truncate", "true").jdbc(
            url, f"{schema}.{table}", properties=properties
        )
