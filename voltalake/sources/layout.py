"""Where data lies: one layout for landing, raw and processed."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_parts(load_date: str | date) -> dict[str, str]:
    """Partition values of a day, zero-padded; a malformed day is an error."""
    day = date.fromisoformat(str(load_date))
    return {"year": f"{day:%Y}", "month": f"{day:%m}", "day": f"{day:%d}"}


def hour_parts(load_date: str | date, hour: str | int) -> dict[str, str]:
    return {**day_parts(load_date), "hour": f"{int(hour):02d}"}


def as_path(parts: dict[str, str]) -> str:
    return "/".join(f"{name}={value}" for name, value in parts.items())


def landing_path(dataset: str, load_date: str | date, hour: str | int, filename: str = "") -> str:
    return f"raw/{dataset}/{as_path(hour_parts(load_date, hour))}/{filename}"


def literals(parts: dict[str, str]) -> dict[str, Column]:
    """Partition columns of one load."""
    return {name: F.lit(value) for name, value in parts.items()}


def matches(parts: dict[str, str]) -> Column:
    """Partition predicate of one load."""
    condition = F.lit(True)
    for name, value in parts.items():
        condition &= F.col(name) == value
    return condition


def table_name(path: Column) -> Column:
    """Table that a landed CSV belongs to: its lower-cased file stem.

    A CSV that Spark wrote is a folder ``name.csv`` of part files.
    """
    stem = F.regexp_extract(path, r"(?i)([^/]+)\.csv/part-[^/]*$", 1)
    return F.lower(F.when(stem != "", stem).otherwise(F.regexp_extract(path, r"(?i)([^/]+)\.csv$", 1)))
