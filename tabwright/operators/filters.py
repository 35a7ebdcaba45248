"""Predicates on rows; all take and give columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.functions import arrays


def not_empty(column: str) -> Column:
    return F.coalesce(F.col(f"`{column}`"), F.lit("")) != ""


def of_type(column: str, code: str) -> Column:
    return F.col(column) == code


def total_row(cells: Column, words: Sequence[str] = ("Total", "Grand Total")) -> Column:
    """The first cell begins with one of the words."""
    first = F.trim(F.coalesce(F.try_element_at(cells, F.lit(1)), F.lit("")))
    found = F.lit(False)
    for word in words:
        found = found | first.startswith(word)
    return found


def closing_total(cells: Column, page: Column, pages: Column) -> Column:
    """On the last page: the second cell is empty and the first holds Total."""
    return (page == pages - 1) & (F.coalesce(F.try_element_at(cells, F.lit(2)), F.lit("")) == "") & F.coalesce(F.try_element_at(cells, F.lit(1)), F.lit("")).contains("Total")


def section_row(cells: Column) -> Column:
    """Text in the first cell alone."""
    return (F.coalesce(F.try_element_at(cells, F.lit(1)), F.lit("")) != "") & arrays.all_empty(arrays.part(cells, 1))


def header_row(cells: Column, prefixes: Sequence[str], page: Column | None = None, row: Column | None = None) -> Column:
    """By the first cell's lower-case beginning, or by place (first row of the first page)."""
    first = F.lower(F.trim(F.coalesce(F.try_element_at(cells, F.lit(1)), F.lit(""))))
    found = F.lit(False)
    for prefix in prefixes:
        found = found | first.startswith(prefix)
    return found if page is None or row is None else found | ((page == 0) & (row == 0))


def holds(cells: Column, parts: Sequence[str]) -> Column:
    """Some cell contains one of the parts: links, footnotes."""
    return F.exists(cells, lambda c: reduce(Column.__or__, [c.contains(p) for p in parts], F.lit(False)))


def without_listed(rows: DataFrame, deny: DataFrame, on: Sequence[str]) -> DataFrame:
    return rows.join(deny.select(*on).distinct(), list(on), "left_anti")


def allowed_pair(one: Column, two: Column, pairs: Sequence[tuple[str, str]]) -> Column:
    """Case doesn't count."""
    found = F.lit(False)
    for a, b in pairs:
        found = found | ((F.lower(one) == a.lower()) & (F.lower(two) == b.lower()))
    return found


def ends_with_word(label: Column, suffix: Column | str) -> Column:
    """Case doesn't count; the suffix is a word of its own."""
    word = F.lit(suffix) if isinstance(suffix, str) else suffix
    return F.upper(label).endswith(F.concat(F.lit(" "), F.upper(word)))


def of_month(name: Column, month: str) -> Column:
    return name.endswith(f"{month}.csv.7z")


def of_release(name: Column, prefix: str) -> Column:
    """The prefix itself, or with a hyphen and more."""
    return (name == prefix) | name.startswith(prefix + "-")
