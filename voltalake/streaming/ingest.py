"""File-arrival ingest: landed CSV files to the raw zone.

Each run takes the files that arrived since the last one and stops. A stream sees
only names, and its checkpoint remembers them; each batch of names is read and
written by functions that give the same result when a batch is repeated after a
failure. So a file is taken once, and a file that cannot be read stops no other.

*Routing.* A file belongs to a dataset if it lies under ``raw/<dataset>/``,
whatever its name, or else if its stem is the dataset's name. All other CSV files
are kept as lines under their own table.

*Landings.* Files that ``files.land`` wrote count by their manifest alone, which
comes last: it names the files, and takes back what was ingested of the folder's
landing before, from whatever day. Files of other writers all count.

*Dead letters.* A file whose header does not name the dataset's columns, or that
cannot be read in several attempts, goes to ``root/quarantine/<dataset>`` with
its lines and the reason.

*Raw zone.* ``root/raw/<dataset>/fecha=<day>/lote=<batch>/carga=<landing>``: a
batch replaces its own folder and no other, and a day is read by listing that day.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable
from datetime import date, datetime, timezone
from functools import partial
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltalake import schemas as S
from voltalake.session import settings
from voltalake.sources import csv_files, storage
from voltalake.sources.files import LANDED, MANIFEST
from voltalake.sources.layout import table_name

LINES = "otros"
ALL = (*S.RAW_COLUMNS, LINES)
FILES_PER_BATCH = 10_000
# Of rows as they came; a quarter less on disk than by default, in the same time.
COMPRESSION = "zstd"
# A task's files are of few landings, so it writes to their folders at once. It would
# sort all its rows by folder, and spill them; what has more folders is still sorted.
WRITERS = {"spark.sql.maxConcurrentOutputFileWriters": "4"}
# By default Spark passes over files a week older than the newest one seen. No
# file is older than this, which is beyond the epoch.
MAX_FILE_AGE = "1000000d"
# Landing that files of other writers belong to.
LOOSE = "sueltos"
DEAD_LETTERS = "ruta string, motivo string, intentos int, linea string"
_NAMES = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("modificationTime", T.TimestampType()),
    T.StructField("length", T.LongType()),
    T.StructField("content", T.BinaryType()),
])


class Job(NamedTuple):
    """What the batches of a run share."""

    spark: SparkSession
    datasets: tuple[str, ...]
    root: str
    checkpoint: str
    load_date: str | None
    archive: tuple[str, str] | None  # landing and the folder that taken files move to


class Landing(NamedTuple):
    folder: str
    id: str
    files: list[str]


def route(path: str) -> str | None:
    """The dataset of a file, ``LINES`` for a CSV file of no dataset, else None."""
    own = re.search(rf"/raw/({'|'.join(S.RAW_COLUMNS)})/", path)
    if own:
        return own[1]
    name = path.rsplit("/", 1)[-1].lower()
    if not name.endswith(".csv"):
        return None
    stem = name.removesuffix(".csv")
    return stem if stem in S.RAW_COLUMNS else LINES


def ingest(
    spark: SparkSession,
    dataset: str,
    landing: str,
    root: str,
    checkpoint: str,
    load_date: str | date | None = None,
    files_per_batch: int = FILES_PER_BATCH,
    archive: str | None = None,
) -> None:
    """Ingest the new files of a dataset into ``root/raw/dataset/fecha=...``.

    Lines of the wrong shape are kept, with their text in the corrupt-record column.
    With ``archive``, a folder outside the landing, files move there when their
    batch is done, so that listings stay short.
    """
    _run(
        spark, (dataset,), landing, root, f"{checkpoint}/{dataset}", load_date,
        files_per_batch, archive,
    )


def ingest_other(
    spark: SparkSession,
    landing: str,
    root: str,
    checkpoint: str,
    load_date: str | date | None = None,
    files_per_batch: int = FILES_PER_BATCH,
) -> None:
    """Keep the lines of CSV files of any other table, by table and day.

    Such files have no declared columns, so their lines are stored as text.
    """
    _run(
        spark, (LINES,), landing, root, f"{checkpoint}/{LINES}", load_date, files_per_batch, None
    )


def ingest_all(
    spark: SparkSession,
    landing: str,
    root: str,
    checkpoint: str,
    load_date: str | date | None = None,
    files_per_batch: int = FILES_PER_BATCH,
    archive: str | None = None,
) -> None:
    """All datasets and other tables in one run, with one listing of the landing."""
    _run(
        spark, ALL, landing, root, f"{checkpoint}/todos", load_date, files_per_batch, archive
    )


def _run(
    spark: SparkSession,
    datasets: tuple[str, ...],
    landing: str,
    root: str,
    checkpoint: str,
    load_date: str | date | None,
    files_per_batch: int,
    archive: str | None,
) -> None:
    """Run the stream of names over the waiting files, batch by batch, and stop."""
    day = None if load_date is None else date.fromisoformat(str(load_date)).isoformat()
    moved = (landing, archive) if archive else None
    job = Job(spark, datasets, root, checkpoint, day, moved)
    storage.make_folder(spark, landing)  # a stream needs its folder
    seen = (
        spark.readStream.format("binaryFile")
        .schema(_NAMES)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files_per_batch)
        .option("maxFileAge", MAX_FILE_AGE)
        .load(landing)
        # No content: a batch holds a row of names for each file, and reads none.
        .select(F.col("_metadata.file_path").alias("ruta"))
    )
    query = (
        seen.writeStream.foreachBatch(partial(_take, job))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _take(job: Job, seen: DataFrame, batch: int) -> None:
    """Read and write what arrived in one batch; at most ``files_per_batch`` names."""
    paths = sorted(x["ruta"] for x in seen.collect())
    day, lot = _named(job, batch)
    taken: list[str] = []
    for dataset in job.datasets:
        own = [x for x in paths if route(x) == dataset]
        if not own:
            continue
        if dataset == LINES:
            _keep_lines(job, own, day, lot)
            taken += own
        else:
            taken += _keep_rows(job, dataset, own, day, lot)
    if job.archive:
        landing, target = job.archive
        for path in map(unquote, taken):
            inner = path.split(landing.rstrip("/") + "/", 1)[-1]
            storage.move(job.spark, path, f"{target}/{inner}")


def _named(job: Job, batch: int) -> tuple[str, str]:
    """Day and name of a batch, the same when it is repeated: the day is noted before
    anything is written, and the stream's own id parts batches of other checkpoints."""
    note = f"{job.checkpoint}/dias/{batch}"
    day = storage.read_text(job.spark, note)
    if day is None:
        day = job.load_date or datetime.now(timezone.utc).date().isoformat()
        storage.write_text(job.spark, note, day)
    stream = json.loads(storage.read_text(job.spark, f"{job.checkpoint}/metadata"))["id"]
    return day, f"{stream}-{batch}"


def _manifests(job: Job, paths: Iterable[str]) -> list[Landing]:
    """Landings of the batch. A manifest that is gone was replaced by a later one."""
    out = []
    for path in paths:
        text = storage.read_text(job.spark, unquote(path))
        if text is not None:
            of, folder = json.loads(text), path.rsplit("/", 1)[0]
            files = [f"{folder}/{x}" for x in of["archivos"]]
            out.append(Landing(folder, of["id"], files))
    return out


def _place(job: Job, zone: str, dataset: str, day: str, lot: str) -> str:
    return f"{job.root}/{zone}/{dataset}/fecha={day}/lote={lot}"


def _keep_rows(job: Job, dataset: str, paths: list[str], day: str, lot: str) -> list[str]:
    """Write the rows and dead letters of a batch; gives the files that it took."""
    spark = job.spark
    landings = _manifests(job, [x for x in paths if x.endswith(MANIFEST)])
    landed = [x for of in landings for x in of.files]
    loose = [
        x for x in paths
        if not x.endswith(MANIFEST) and not x.rsplit("/", 1)[-1].startswith(f"{LANDED}-")
    ]
    found = csv_files.sort_files(spark, dataset, [*landed, *loose])
    # At most a row for each folder of the batch.
    ids = spark.createDataFrame([(x.folder, x.id) for x in landings], "carpeta string, id string")
    origin = F.col("_metadata.file_path")
    # By place and not by pattern: a pattern on each row's path took most of the time.
    name = F.substring_index(origin, "/", -1)
    parent = F.left(origin, F.length(origin) - F.length(name) - 1)
    folder = F.when(name.startswith(f"{LANDED}-"), parent)
    rows = csv_files.read_sorted(
        spark, dataset, found,
        F.lit(dataset).alias("tabla"),
        origin.alias("_origen"),
        F.current_timestamp().alias("_ingerido_en"),
        folder.alias("carpeta"),
    )
    marked = rows.join(F.broadcast(ids), "carpeta", "left").withColumn(
        "carga", F.coalesce("id", F.lit(LOOSE))
    )
    target = _place(job, "raw", dataset, day, lot)
    with settings(spark, WRITERS):
        (
            marked.drop("carpeta", "id")
            .write.mode("overwrite")
            .option("compression", COMPRESSION)
            .partitionBy("carga")
            .parquet(target)
        )
    if found.rejected:
        letters = csv_files.lines_of(spark, found.rejected)
        letters.write.mode("overwrite").parquet(_place(job, "quarantine", dataset, day, lot))
    for of in landings:
        _replace(job, dataset, of, f"{target}/carga={of.id}")
    return [*landed, *loose]


def _replace(job: Job, dataset: str, landing: Landing, rows: str) -> None:
    """Drop what was ingested of a folder's landing before this one.

    The new rows are there already; a repeated batch drops nothing twice.
    """
    key = hashlib.md5(landing.folder.encode()).hexdigest()
    note = f"{job.root}/cargas/{dataset}/{key[:2]}/{key}.json"
    last = json.loads(storage.read_text(job.spark, note) or "{}")
    if last.get("filas_en") not in (None, rows):
        storage.delete(job.spark, last["filas_en"])
    now = {"carpeta": landing.folder, "carga": landing.id, "filas_en": rows}
    storage.write_text(job.spark, note, json.dumps(now))


def _keep_lines(job: Job, paths: list[str], day: str, lot: str) -> None:
    good, rejected = csv_files.readable(job.spark, paths)
    if good:
        path = F.col("_metadata.file_path")
        lines = job.spark.read.text([csv_files.plain(x) for x in good]).select(
            F.col("value").alias("linea"),
            table_name(path).alias("tabla"),
            path.alias("_origen"),
            F.current_timestamp().alias("_ingerido_en"),
        )
        target = _place(job, "raw", LINES, day, lot)
        lines.write.mode("overwrite").partitionBy("tabla").parquet(target)
    if rejected:
        letters = csv_files.lines_of(job.spark, rejected)
        letters.write.mode("overwrite").parquet(_place(job, "quarantine", LINES, day, lot))


def raw_columns(dataset: str) -> T.StructType:
    """Stored columns of the raw zone, without those that folders give."""
    if dataset == LINES:
        schema = T.StructType().add("linea", "string")
    else:
        schema = S.raw_schema(dataset).add("tabla", "string")
    return schema.add("_origen", "string").add("_ingerido_en", "timestamp")


def _read(spark: SparkSession, folder: str, schema: T.StructType, day: str | None) -> DataFrame:
    """Rows of a folder of days, or of the one day; none if it is not there."""
    path = folder if day is None else f"{folder}/fecha={day}"
    try:
        return spark.read.schema(schema).option("basePath", folder).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def _day(load_date: str | date | None) -> str | None:
    return None if load_date is None else date.fromisoformat(str(load_date)).isoformat()


def read_ingested(
    spark: SparkSession, root: str, dataset: str, load_date: str | date | None = None
) -> DataFrame:
    """Ingested rows, of one day or all, with ``tabla``, ``_origen``, ``_ingerido_en``
    and ``fecha``. A day's rows are found by listing that day's folder."""
    stored = raw_columns(dataset)
    schema = T.StructType(list(stored.fields))
    for name in ("fecha", "lote", "tabla" if dataset == LINES else "carga"):
        schema = schema.add(name, "string")
    rows = _read(spark, f"{root}/raw/{dataset}", schema, _day(load_date))
    first = ["linea", "tabla"] if dataset == LINES else stored.names[:-2]
    return rows.select(*first, "_origen", "_ingerido_en", F.to_date("fecha").alias("fecha"))


def read_dead_letters(
    spark: SparkSession, root: str, dataset: str, load_date: str | date | None = None
) -> DataFrame:
    """(ruta, motivo, intentos, linea, fecha) of files that an ingest could not read."""
    schema = T.StructType.fromDDL(DEAD_LETTERS).add("fecha", "string").add("lote", "string")
    rows = _read(spark, f"{root}/quarantine/{dataset}", schema, _day(load_date))
    return rows.withColumn("fecha", F.to_date("fecha")).drop("lote")
