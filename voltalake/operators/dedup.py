"""Removal of rows that repeat a key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the first by ``order``, then by all other columns.

    The order is total, so the result does not depend on the partitioning.
    Spark turns the filter on the row number into a group limit that runs
    before the shuffle too: a task sends one row per key at most, however
    often a key repeats.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    ranking = Window.partitionBy(*keys).orderBy(
        *[F.col(c).asc_nulls_last() for c in (*order, *rest)]
    )
    return df.withColumn("_rank", F.row_number().over(ranking)).where("_rank = 1").drop("_rank")


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("filas")).where("filas > 1")
