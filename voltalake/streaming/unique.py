"""Deduplication of ingested rows as they arrive.

A stream over the raw zone keeps the natural keys that it has seen for a while in
state, so a file that is sent again adds nothing, however often. What comes after
the keys have been forgotten is told by ``missed``, which compares with what is
stored; the stream only counts it.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltalake import schemas as S
from voltalake.session import freed_shuffles, settings
from voltalake.sources import storage
from voltalake.streaming.ingest import COMPRESSION, raw_columns, read_ingested

KEPT_FOR = "7 days"
# Keys of a week are more than the executors' memory holds, so they lie on their disks,
# but for 16 MB of new ones in each task's store (64 by default).
# A checkpoint goes on with the store that it began with. Nobody asks how many there
# are, and to count them each key would be read before it is put.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB": "16",
}
# The counts of a run add up those of its batches, so none is let go while it runs.
PROGRESS = {"spark.sql.streaming.numRecentProgressUpdates": "100000"}
# A core's share of a batch for runs that are to go easy on the executors' disks.
BYTES_PER_CORE = 32 * 1024 * 1024
COUNTS = "leidas bigint, repetidas bigint, tardias bigint"


def unique_rows(
    spark: SparkSession,
    root: str,
    dataset: str,
    checkpoint: str,
    kept_for: str = KEPT_FOR,
    bytes_per_core: int | None = None,
) -> DataFrame:
    """Add the newly ingested rows to ``root/unique/dataset``, the first of each key.

    A key is remembered for ``kept_for`` after the ingest of its row. Lines of the
    wrong shape have no key and stay out. Returns the rows that this run read, those
    that repeat a remembered key, and those that came too late to tell.

    A batch shuffles its rows by key, and by default all that waits is one batch. With
    ``bytes_per_core`` a batch takes that much of the raw zone for each core, whole
    files, the oldest first. Keys are forgotten between batches, so what waits should
    then not be of more days than ``kept_for``, or repeats further apart stay.
    """
    place = f"{checkpoint}/{dataset}"
    storage.make_folder(spark, f"{root}/raw/{dataset}")  # a stream needs its folder

    def add(rows: DataFrame, batch: int) -> None:
        stream = json.loads(storage.read_text(spark, f"{place}/metadata"))["id"]
        target = f"{root}/unique/{dataset}/lote={stream}-{batch}"
        rows.write.mode("overwrite").option("compression", COMPRESSION).parquet(target)

    schema = raw_columns(dataset)
    waiting = spark.readStream.schema(schema)
    if bytes_per_core is not None:
        cores = spark.sparkContext.defaultParallelism
        waiting = waiting.option("maxBytesPerTrigger", bytes_per_core * cores)
    kept = (
        waiting.parquet(f"{root}/raw/{dataset}")
        .select(*schema.names)
        .where(F.col(S.CORRUPT).isNull())
        .drop(S.CORRUPT)
        .withWatermark("_ingerido_en", kept_for)
        .dropDuplicatesWithinWatermark(list(S.KEYS[dataset]))
        .writeStream.foreachBatch(add)
        .option("checkpointLocation", place)
        .trigger(availableNow=True)
    )
    with settings(spark, PROGRESS):
        with settings(spark, STATE), freed_shuffles(spark):
            query = kept.start()
        query.awaitTermination()
    read = repeated = late = 0
    for progress in query.recentProgress:
        read += progress.numInputRows
        for operator in progress.stateOperators:
            late += operator.numRowsDroppedByWatermark
            repeated += operator.customMetrics.get("numDroppedDuplicateRows", 0)
    return spark.createDataFrame([(read, repeated, late)], COUNTS)


def read_unique(spark: SparkSession, root: str, dataset: str) -> DataFrame:
    schema = raw_columns(dataset)
    names = [x for x in schema.names if x != S.CORRUPT]
    return spark.read.schema(schema).parquet(f"{root}/unique/{dataset}").select(*names)


def missed(spark: SparkSession, root: str, dataset: str) -> DataFrame:
    """Ingested rows whose key ``unique_rows`` has not stored: what came too late, or
    has not been read yet. A null in a key equals a null."""
    keys = S.KEYS[dataset]
    rows = read_ingested(spark, root, dataset).where(F.col(S.CORRUPT).isNull()).drop(S.CORRUPT)
    stored = read_unique(spark, root, dataset).select(*[F.col(k).alias(f"_{k}") for k in keys])
    same = F.lit(True)
    for key in keys:
        same &= F.col(key).eqNullSafe(F.col(f"_{key}"))
    return rows.join(stored, same, "left_anti")
