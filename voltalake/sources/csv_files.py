"""CSV files of one dataset, each read by the header that it has.

A first pass over the lines, without parsing them, gives for each file its header
and whether its records span lines. Files with one header and one kind of records
are then parsed together, with columns mapped by name. What cannot be read that
way is named with a reason and stops nothing else.
"""

from __future__ import annotations

import csv
import re
from collections import defaultdict
from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltalake import schemas as S

# Quotes are doubled inside quoted text; outer blanks are data. The header is
# compared here, by name. columnPruning=false: the shape of a line is checked
# whichever columns a query needs.
CSV_READ = {
    "header": "true",
    "escape": '"',
    "columnPruning": "false",
    "columnNameOfCorruptRecord": S.CORRUPT,
}
ATTEMPTS = 3
UNREADABLE = "ilegible"
FILE = "_archivo"


class Layout(NamedTuple):
    """What files have in common: the columns in their order, and records over lines."""

    columns: tuple[str, ...]
    spans: bool


class Rejected(NamedTuple):
    """A file that is not read, why, and how often it was tried."""

    path: str
    reason: str
    attempts: int


class Sorted(NamedTuple):
    """Files by layout, and those that have none."""

    layouts: dict[Layout, list[str]]
    rejected: list[Rejected]


def plain(path: str) -> str:
    """A path as readers take it, from the URI that ``_metadata`` gives; glob signs are kept."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(path))


def columns_of(header: str, dataset: str) -> tuple[str, ...]:
    """The dataset's columns in a header's order; another header is a ``ValueError``."""
    found = [x.strip().lower() for x in next(csv.reader([header.removeprefix("﻿")]), [])]
    wanted = S.RAW_COLUMNS[dataset]
    faults = {
        "columnas desconocidas": sorted(set(found) - set(wanted)),
        "columnas que faltan": [x for x in wanted if x not in found],
        "columnas repetidas": sorted({x for x in found if found.count(x) > 1}),
    }
    wrong = "; ".join(f"{what}: {', '.join(x)}" for what, x in faults.items() if x)
    if wrong:
        raise ValueError(wrong)
    return tuple(found)


def _headers(spark: SparkSession, paths: Sequence[str]) -> list:
    """(file, header, spans): the first line with text, and whether records span lines.

    That is so where lines hold an odd number of quotes and the file an even one. A
    quote that nothing closes spoils its own line only. The lines themselves stay
    where they are: a task sends a row for each of its files.
    """
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    lines = spark.read.text([plain(x) for x in paths]).select(
        F.col("_metadata.file_path").alias(FILE),
        F.col("_metadata.file_block_start").alias("block"),
        F.when((F.col("_metadata.file_block_start") == 0) & (F.trim("value") != ""), F.col("value"))
        .alias("header"),
        F.monotonically_increasing_id().alias("order"),
        quotes.alias("quotes"),
    )
    found = lines.groupBy(FILE).agg(
        F.min_by("header", F.when(F.col("header").isNotNull(), F.col("order"))).alias("header"),
        (F.max(F.col("quotes") % 2) == 1).alias("odd"),
        (F.sum("quotes") % 2 == 0).alias("closed"),
    )
    return found.select(FILE, "header", (F.col("odd") & F.col("closed")).alias("spans")).collect()


def _tried(spark: SparkSession, paths: Sequence[str], attempts: int):
    """Headers of the files that can be read, and the others. Halves are tried apart
    until a file that cannot be read stands alone."""
    if not paths:
        return [], []
    for attempt in range(1, attempts + 1):
        try:
            return _headers(spark, paths), []
        except (PySparkException, Py4JJavaError) as error:
            if len(paths) == 1 and attempt == attempts:
                cause = str(error).strip().split("\n")[0][:300]
                return [], [Rejected(paths[0], f"{UNREADABLE}: {cause}", attempt)]
            if len(paths) > 1:
                break
    half = len(paths) // 2
    one, two = (_tried(spark, x, attempts) for x in (paths[:half], paths[half:]))
    return one[0] + two[0], one[1] + two[1]


def readable(
    spark: SparkSession, paths: Sequence[str], attempts: int = ATTEMPTS
) -> tuple[list[str], list[Rejected]]:
    """Files with lines that can be read, and those that cannot."""
    found, rejected = _tried(spark, paths, attempts)
    return [x[0] for x in found], rejected


def sort_files(
    spark: SparkSession, dataset: str, paths: Sequence[str], attempts: int = ATTEMPTS
) -> Sorted:
    """Files of a dataset by layout. A file without a line has none and is not rejected."""
    found, rejected = _tried(spark, paths, attempts)
    layouts: dict[Layout, list[str]] = defaultdict(list)
    for path, header, spans in found:
        if header is None:
            continue
        try:
            layouts[Layout(columns_of(header, dataset), spans)].append(path)
        except ValueError as error:
            rejected.append(Rejected(path, str(error), 1))
    return Sorted(dict(layouts), rejected)


def read_sorted(spark: SparkSession, dataset: str, files: Sorted, *more: Column) -> DataFrame:
    """Raw text rows of the files, with ``more`` columns that may ask for ``_metadata``."""
    parts = []
    for layout, paths in files.layouts.items():
        schema = T.StructType([T.StructField(x, T.StringType()) for x in layout.columns])
        reader = spark.read.schema(schema.add(S.CORRUPT, T.StringType())).options(**CSV_READ)
        rows = reader.option("multiLine", str(layout.spans).lower()).csv([plain(x) for x in paths])
        parts.append(rows.select(*S.RAW_COLUMNS[dataset], S.CORRUPT, *more))
    if not parts:
        nothing = spark.createDataFrame([], S.raw_schema(dataset).add("_metadata", _METADATA))
        return nothing.select(*S.RAW_COLUMNS[dataset], S.CORRUPT, *more)
    return reduce(DataFrame.unionByName, parts)


_METADATA = T.StructType([T.StructField("file_path", T.StringType())])


def lines_of(spark: SparkSession, rejected: Sequence[Rejected]) -> DataFrame:
    """(ruta, motivo, intentos, linea): the lines of rejected files, or one row
    without a line for a file that cannot be read."""
    schema = "ruta string, motivo string, intentos int"
    named = spark.createDataFrame(list(rejected), schema)
    readable = [plain(x.path) for x in rejected if not x.reason.startswith(UNREADABLE)]
    if not readable:
        return named.withColumn("linea", F.lit(None).cast("string"))
    lines = spark.read.text(readable).select(
        F.col("_metadata.file_path").alias("ruta"), F.col("value").alias("linea")
    )
    # The names are at most those of one run's files.
    return lines.join(F.broadcast(named), "ruta", "right").select(*named.columns, "linea")


def files_under(spark: SparkSession, *folders: str) -> list[str]:
    """URIs of the data files under folders, whatever their depth."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    found = reader.load(list(folders)).select("_metadata.file_path", "length")
    return sorted(x[0] for x in found.collect())
