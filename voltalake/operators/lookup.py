"""Left join of a large table to a reference table, safe under skew.

The reference side is measured first. If it is small it is broadcast and the
large side stays where it is. If not, both sides are shuffled, and each key
of the large side that fills more than one task is split by a salt.
"""

from __future__ import annotations

from functools import reduce
from math import ceil
from operator import add

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 * 1024 * 1024
_ROW_OVERHEAD = 16


def measured_bytes(df: DataFrame) -> int:
    """Bytes of all values as text plus a fixed overhead per row, by one aggregate."""
    widths = [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in df.columns]
    width = reduce(add, widths).cast("bigint") + _ROW_OVERHEAD
    return df.agg(F.coalesce(F.sum(width), F.lit(0)).alias("bytes")).first()["bytes"]


def hot_keys(df: DataFrame, key: str, tasks: int) -> list[tuple]:
    """Keys with more rows than an even share of a task, as ``(key, pieces)``.

    A key is cut into as many pieces as it fills tasks. There are fewer such
    keys than tasks, so the largest ``tasks`` keys hold them all; NULL is a key
    too.
    """
    seen = Observation()
    largest = (
        df.groupBy(key)
        .agg(F.count(F.lit(1)).alias("n"))
        .observe(seen, F.sum("n").alias("rows"))
        .orderBy(F.col("n").desc())
        .limit(tasks)
        .collect()
    )
    share = (seen.get["rows"] or 0) / tasks
    return [(row[key], ceil(row["n"] / share)) for row in largest if row["n"] > share]


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    *,
    spread_by: str,
    null_safe: bool = False,
    max_broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``left LEFT JOIN right``; all columns of both sides, one row per match.

    ``spread_by`` is a column of ``left`` that differs within a key (its
    unique identifier): the salt is a hash of it, so a retried task sends
    each row to the same place. With ``null_safe`` NULL keys match each other.
    Both sides are read twice (measured or counted, then joined), so they had
    better be stored tables.
    """
    if not null_safe:
        right = right.where(F.col(right_key).isNotNull())
    if measured_bytes(right) <= max_broadcast_bytes:
        matches = _equal(left[left_key], right[right_key], null_safe)
        return left.join(F.broadcast(right), matches, "left")
    return _salted_join(left, right, left_key, right_key, spread_by, null_safe)


def _equal(a: Column, b: Column, null_safe: bool) -> Column:
    return a.eqNullSafe(b) if null_safe else a == b


def _salted_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    spread_by: str,
    null_safe: bool,
) -> DataFrame:
    """Hot keys are cut in pieces by a salt, and their matches copied to each piece.

    All pieces together are about as many as the tasks of the shuffle, which
    bounds the copies. Which keys count as hot only moves work around; the
    result is the same.
    """
    spark = left.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    kind = left.schema[left_key].dataType.simpleString()
    hot = F.broadcast(
        spark.createDataFrame(hot_keys(left, left_key, tasks), f"_hot {kind}, _pieces int")
    )

    def with_pieces(df: DataFrame, key: str) -> DataFrame:
        return df.join(hot, df[key].eqNullSafe(hot["_hot"]), "left").drop("_hot")

    pieces = F.coalesce(F.col("_pieces"), F.lit(1))
    cut = with_pieces(left, left_key).withColumn(
        "_left_salt", F.pmod(F.xxhash64(F.col(spread_by)), pieces).cast("int")
    )
    copied = with_pieces(right, right_key).withColumn(
        "_right_salt", F.explode(F.sequence(F.lit(0), pieces - 1))
    )
    cut, copied = cut.drop("_pieces"), copied.drop("_pieces")
    matches = _equal(cut[left_key], copied[right_key], null_safe) & (
        cut["_left_salt"] == copied["_right_salt"]
    )
    return cut.join(copied, matches, "left").drop("_left_salt", "_right_salt")
