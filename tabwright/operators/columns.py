"""Projections and per-row repairs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.functions import arrays
from tabwright.operators.aggregates import one_each


def project(rows: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Canonical name -> source column."""
    return rows.select(*[F.col(f"`{old}`").alias(new) for new, old in names.items()])


def keep_or_drop(rows: DataFrame, keep: Sequence[str] | None = None, drop: Sequence[str] | None = None) -> DataFrame:
    """A keep-list (unknown names don't count) or a drop-list; both raise."""
    if keep and drop:
        raise ValueError("either keep or drop")
    if keep:
        return rows.select(*[f"`{c}`" for c in keep if c in rows.columns])
    return rows.drop(*(drop or ()))


def enrich(rows: DataFrame, constants: Mapping[str, str]) -> DataFrame:
    """Constant text columns at the end, trimmed."""
    return rows.select("*", *[F.lit(v.strip()).alias(k) for k, v in constants.items()])


def enrich_from_parent(rows: DataFrame, parents: DataFrame, key: str, columns: Mapping[str, str]) -> DataFrame:
    """Columns of the parent record (output name -> parent's column) on every child row; children without one get nulls."""
    own = parents.select(F.col(key), *[F.col(old).alias(new) for new, old in columns.items()])
    return rows.join(one_each(own, [key]), key, "left")


def enrich_or_fail(rows: DataFrame, parents: DataFrame, key: str, columns: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """(enriched rows, keys without a parent)."""
    own = parents.select(F.col(key), *[F.col(old).alias(new) for new, old in columns.items()])
    own = one_each(own, [key])
    return rows.join(own, key), rows.select(key).distinct().join(own, key, "left_anti")


def promote(rows: DataFrame, first: Sequence[str]) -> DataFrame:
    return rows.select(*first, *[c for c in rows.columns if c not in first])


def clean_cells(rows: DataFrame, remove: str = "\n") -> DataFrame:
    """Text columns without ``remove``, trimmed."""
    return rows.select(*[F.trim(F.regexp_replace(c, remove, "")).alias(c) if t == "string" else F.col(c) for c, t in rows.dtypes])


def split_table(rows: DataFrame, cells: str, left: tuple[int, int | None], right: tuple[int, int | None]) -> tuple[DataFrame, DataFrame]:
    """Two tables from ranges of the cells of one."""
    return tuple(rows.withColumn(cells, arrays.part(F.col(cells), *r)) for r in (left, right))


def widen(cells: Column, narrow: int, at: int, header: Column, name: str) -> Column:
    """Rows of ``narrow`` cells get one more: ``name`` in a header row, else empty."""
    return F.when(F.size(cells) == narrow, arrays.insert_cell(cells, at, F.when(header, F.lit(name)).otherwise(F.lit("")))).otherwise(cells)


def unspill(cells: Column, columns: Sequence[int]) -> Column:
    """Left to right: an empty cell takes the last line of the cell before it, if that has several lines."""

    def moved(cells: Column, at: int) -> Column:
        before = F.coalesce(F.try_element_at(cells, F.lit(at)), F.lit(""))
        lines = F.split(before, "\n")
        moves = (F.coalesce(F.try_element_at(cells, F.lit(at + 1)), F.lit("")) == "") & (F.size(lines) > 1)
        kept = F.array_join(F.slice(lines, F.lit(1), F.greatest(F.size(lines) - 1, F.lit(1))), "\n")
        return F.when(moves, F.transform(cells, lambda c, i: F.when(i == at - 1, kept).when(i == at, F.element_at(lines, -1)).otherwise(c))).otherwise(cells)

    return reduce(moved, columns, cells)


def override_from_path(rows: DataFrame, column: str, value: Column, flag: Column) -> DataFrame:
    """``value`` in place of the column where the file's flag says that it lacks its own."""
    return rows.withColumn(column, F.when(flag, value).otherwise(F.col(column)))


def default(column: str, value: str) -> Column:
    return F.when(F.coalesce(column, F.lit("")) == "", F.lit(value)).otherwise(F.col(column)).alias(column)


def patch(rows: DataFrame, edits: DataFrame, key: str) -> DataFrame:
    """edits(key, changes map column -> value): the new value where there is one; of several edits of a key the one whose
    JSON is least."""
    one = edits.groupBy(key).agg(F.min_by("changes", F.to_json("changes")).alias("__changes"))
    met = rows.join(one, key, "left")
    new = [c if c == key else F.coalesce(F.try_element_at("__changes", F.lit(c)), F.col(f"`{c}`")).alias(c) for c in rows.columns]
    return met.select(*new)


def correct(rows: DataFrame, edits: DataFrame, deletions: DataFrame, additions: DataFrame, key: str) -> DataFrame:
    """Deleted rows go, edited ones change, added ones come last."""
    kept = patch(rows.join(deletions.select(key), key, "left_anti"), edits, key).select(*rows.columns)
    return kept.unionByName(additions, allowMissingColumns=True).na.fill("")


def override_records(rows: DataFrame, overrides: DataFrame, key: str) -> DataFrame:
    """overrides(key, record struct or null): the whole record, or none, in place of the row's."""
    rest = [c for c in rows.columns if c != key]
    met = rows.join(overrides.select(key, F.col("record").alias("__record"), F.lit(True).alias("__over")), key, "left")
    return met.where("__over is null or __record is not null").select(key, *[F.when(F.col("__over"), F.col("__record")[c]).otherwise(F.col(c)).alias(c) for c in rest]).select(*rows.columns)


def suggestion(label: Column, description: Column, instance_of: Column, parent: Column, inception: Column, code: Column, code_property: str) -> Column:
    """What an entity that is missing should say, as one struct."""
    return F.struct(label.alias("label"), description.alias("description"), instance_of.alias("instance_of"), parent.alias("located_in"), inception.alias("inception"), code.alias("code"), F.lit(code_property).alias("property"))
