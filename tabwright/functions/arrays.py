"""Functions on positional rows (arrays of text), maps and stacks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_width(cells: Column, width: int) -> Column:
    """Exactly ``width`` cells: short rows get empty ones, long rows lose their end; null cells are empty."""
    return F.transform(F.sequence(F.lit(1), F.lit(width)), lambda i: F.coalesce(F.try_element_at(cells, i), F.lit("")))


def all_empty(cells: Column) -> Column:
    return F.forall(cells, lambda c: F.coalesce(c, F.lit("")) == "")


def any_empty(cells: Column) -> Column:
    return F.exists(cells, lambda c: F.coalesce(c, F.lit("")) == "")


def part(cells: Column, low: int, high: int | None = None) -> Column:
    """Cells ``low`` up to ``high`` (from 0, without it)."""
    end = F.size(cells) if high is None else F.least(F.lit(high), F.size(cells))
    return F.slice(cells, F.lit(low + 1), F.greatest(end - low, F.lit(0)))


def insert_cell(cells: Column, at: int, value: Column) -> Column:
    return F.concat(part(cells, 0, at), F.array(value), part(cells, at))


def with_member(members: Column, value: Column) -> Column:
    """With ``value`` at the end unless it is there."""
    return F.array_union(members, F.array(value))


def merge_maps(*maps: Column) -> Column:
    """Later maps win, whatever the session says of duplicate keys."""

    def both(first: Column, second: Column) -> Column:
        return F.map_concat(F.map_filter(first, lambda k, _: ~F.map_contains_key(second, k)), second)

    return reduce(both, maps)


def stack_level(stack: Column, level: str) -> Column:
    """The first entry of an array of structs whose ``level`` field says so."""
    return F.try_element_at(F.filter(stack, lambda s: s["level"] == level), F.lit(1))


def flatten_stack(stack: Column, levels: Sequence[str], fields: Sequence[str]) -> list[Column]:
    """One column ``level_field`` for each level and field; empty text where the level is missing."""
    return [F.coalesce(stack_level(stack, lv)[f].cast("string"), F.lit("")).alias(f"{lv}_{f}") for lv in levels for f in fields]
