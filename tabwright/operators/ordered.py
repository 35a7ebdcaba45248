"""Operators on ordered rows. ``within`` names what an order belongs to (a file, a user); only an empty ``within`` puts a
whole table in one order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec


def _order(within: Sequence[str], order: Sequence[str]) -> WindowSpec:
    return Window.partitionBy(*within).orderBy(*order)


def forward_fill(rows: DataFrame, column: str, within: Sequence[str], order: Sequence[str], empty: Column | None = None) -> DataFrame:
    """Empty cells take the last value before them; ``unfilled`` where there is none."""
    blank = F.col(column).isNull() if empty is None else empty
    value = F.last(F.when(~blank, F.col(column)), ignorenulls=True).over(_order(within, order).rowsBetween(Window.unboundedPreceding, 0))
    filled = rows.withColumn("__v", value)
    return filled.withColumn("unfilled", F.col("__v").isNull()).withColumn(column, F.coalesce("__v", column)).drop("__v")


def runs(rows: DataFrame, column: str, within: Sequence[str], order: Sequence[str], name: str = "run") -> DataFrame:
    """Numbers of the runs of equal values, from 1."""
    window = _order(within, order)
    changed = rows.withColumn("__c", (~F.col(column).eqNullSafe(F.lag(column).over(window)) | (F.row_number().over(window) == 1)).cast("int"))
    return changed.withColumn(name, F.sum("__c").over(window.rowsBetween(Window.unboundedPreceding, 0))).drop("__c")


def carried(rows: DataFrame, group: str, values: Sequence[str], within: Sequence[str], order: Sequence[str]) -> DataFrame:
    """While the group stays, its first row's values hold."""
    marked = runs(rows, group, within, order, "__run")
    first = Window.partitionBy(*within, "__run").orderBy(*order)
    return marked.select(*[F.first(c).over(first).alias(c) if c in values else F.col(c) for c in rows.columns])


def without_ends(rows: DataFrame, within: Sequence[str], order: Sequence[str], first: int = 0, last: int = 0) -> DataFrame:
    numbered = rows.withColumn("__n", F.row_number().over(_order(within, order))).withColumn("__all", F.count(F.lit(1)).over(Window.partitionBy(*within)))
    return numbered.where((F.col("__n") > first) & (F.col("__n") <= F.col("__all") - last)).drop("__n", "__all")


def sections(rows: DataFrame, starts: Column, within: Sequence[str], order: Sequence[str], width: Column | None = None) -> DataFrame:
    """section: rows from one start to the next (0 before any); with ``width``, section_width as of its start."""
    upto = _order(within, order).rowsBetween(Window.unboundedPreceding, 0)
    marked = rows.withColumn("section", F.sum(starts.cast("int")).over(upto))
    return marked if width is None else marked.withColumn("section_width", F.last(F.when(starts, width), ignorenulls=True).over(upto))


def ensure_header(rows: DataFrame, header: Sequence[str], cells: str = "cells", order: str = "pos") -> DataFrame:
    """The header at position -1 unless the first row is it."""
    expected = F.array(*map(F.lit, header))
    has = rows.agg(F.min_by(F.slice(cells, 1, len(header)) == expected, order).alias("has")).where("not coalesce(has, false)")
    kinds = dict(rows.dtypes)
    own = has.select(*[expected.alias(c) if c == cells else F.lit(-1).cast(kinds[c]).alias(c) if c == order else F.lit(None).cast(kinds[c]).alias(c) for c in rows.columns])
    return rows.unionByName(own)


def single_header(rows: DataFrame, table: str, order: str) -> DataFrame:
    """Without the first row of all tables but the first."""
    first = rows.agg(F.min(table).alias("__t"))
    numbered = rows.withColumn("__n", F.row_number().over(Window.partitionBy(table).orderBy(order))).crossJoin(F.broadcast(first))  # one row
    return numbered.where((F.col("__n") > 1) | (F.col(table) == F.col("__t"))).drop("__n", "__t")


def drop_same_as_first(rows: DataFrame, within: Sequence[str], code: str, order: Sequence[str]) -> DataFrame:
    """Later rows whose code is the first one's of the group go; other codes stay."""
    window = _order(within, order)
    marked = rows.withColumn("__n", F.row_number().over(window)).withColumn("__first", F.first(code).over(window))
    return marked.where((F.col("__n") == 1) | ~F.col(code).eqNullSafe(F.col("__first"))).drop("__n", "__first")


def release_order(name: Column) -> list[Column]:
    """Sort keys: the base release, then extraN by number, then what isn't known."""
    extra = F.regexp_extract(name, r"extra(\d+)", 1).try_cast("int")
    return [F.when(name.contains("extra"), F.coalesce(extra, F.lit(2**31 - 1))).when(name.endswith("base") | ~name.contains("-"), F.lit(-1)).otherwise(F.lit(2**31 - 1)).asc(), name.asc()]


def newest_first(day: str) -> list[Column]:
    return [F.col(day).desc_nulls_last()]


def joined_path(parts: Column) -> Column:
    return F.array_join(parts, " ")


def date_union(*dates: Column) -> Column:
    return F.array_sort(F.array_distinct(F.concat(*dates)))
