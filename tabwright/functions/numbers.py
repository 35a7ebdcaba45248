"""Number functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNITS = ("Bytes", "KB", "MB", "GB", "TB", "PB")


def file_size(size: Column) -> Column:
    """Bytes for people: the largest unit that leaves one or more, up to two decimals."""
    unit = F.when(size > 0, F.least(F.floor(F.log(1024.0, size)), F.lit(len(UNITS) - 1))).otherwise(0).cast("int")
    value = F.round(size / F.pow(F.lit(1024.0), unit), 2)
    return F.concat(F.regexp_replace(value.cast("decimal(20,2)").cast("string"), r"\.?0+$", ""), F.lit(" "), F.element_at(F.array(*map(F.lit, UNITS)), unit + 1))


def clamp(value: Column, low: int, high: int) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), value))


def chunk_size(total: Column, workers: int, most: int = 128) -> Column:
    """Rows for a worker at a time: 1 to ``most``."""
    return clamp(F.floor(total / workers).cast("int"), 1, most)


def coordinate(text: Column, places: int = 5) -> Column:
    """Degrees rounded half to even; null unless a number."""
    return F.bround(text.try_cast("double"), places)


def integer(text: Column) -> Column:
    return F.trim(text).try_cast("bigint")
