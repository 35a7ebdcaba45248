"""Aggregations; lists are in an explicit order, as Spark has none."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def grouped_list(rows: DataFrame, key: Sequence[str], value: str, order: str, name: str = "values") -> DataFrame:
    pairs = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(value).alias("v"))))
    return rows.groupBy(*key).agg(F.transform(pairs, lambda p: p["v"]).alias(name))


def counts(rows: DataFrame, key: Sequence[str], name: str = "n") -> DataFrame:
    return rows.groupBy(*key).agg(F.count(F.lit(1)).alias(name))


def _nth(rows: DataFrame, key: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    return rows.withColumn("__nth", F.row_number().over(Window.partitionBy(*key).orderBy(*order)))


def one_each(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row for each key, the least in its other columns: the same one in every run. Combined before the shuffle."""
    rest = [c for c in rows.columns if c not in key]
    if not rest:
        return rows.distinct()
    return rows.groupBy(*key).agg(F.min(F.struct(*rest)).alias("__row")).select(*[F.col(c) if c in key else F.col("__row")[c].alias(c) for c in rows.columns])


def numbered(rows: DataFrame, within: Sequence[str], order: Sequence[str], name: str = "n") -> DataFrame:
    """Row numbers from 1 in ``order``, within what they belong to."""
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(*within).orderBy(*order)))


def first_match(rows: DataFrame, wanted: Column, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Of each key the first row that is wanted."""
    return keep_first(rows.where(wanted), key, order)


def keep_first(rows: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    return _nth(rows, key, order).where("__nth = 1").drop("__nth")


def first_and_repeats(rows: DataFrame, key: Sequence[str], order: Sequence[str], prev: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(first row of each key, later rows with prev_ columns of the first)."""
    window = Window.partitionBy(*key).orderBy(*order)
    marked = rows.select("*", F.row_number().over(window).alias("__nth"), *[F.first(c).over(window).alias(f"prev_{c}") for c in prev])
    return marked.where("__nth = 1").select(*rows.columns), marked.where("__nth > 1").drop("__nth")


def distinct_rows(rows: DataFrame, keep_raw: bool = False) -> DataFrame:
    return rows if keep_raw else rows.distinct()


def first_seen(rows: DataFrame, date: str) -> DataFrame:
    """Each row without its date, with the first date."""
    return rows.groupBy(*[c for c in rows.columns if c != date]).agg(F.min(date).alias(date))


def nested(rows: DataFrame, parent: str, child: str, name: str) -> DataFrame:
    """parent -> map child -> name (of several, the least)."""
    pairs = F.array_sort(F.collect_list(F.struct(child, name)))
    return rows.groupBy(parent, child).agg(F.min(name).alias(name)).groupBy(parent).agg(F.map_from_entries(pairs).alias("children"))


def wrong_count(values: Column, expected: int = 1) -> Column:
    return F.size(values) != expected


def count_if(values: Column, wanted: str) -> Column:
    return F.size(F.filter(values, lambda v: v == wanted))


def latest(rows: DataFrame, key: Sequence[str], name: str, date: Column) -> DataFrame:
    """The name of the latest date of each key; the greater name wins ties."""
    return rows.groupBy(*key).agg(F.max_by(name, F.struct(date, F.col(name))).alias(name))


def bounds(rows: DataFrame, key: Sequence[str], date: str) -> DataFrame:
    return rows.groupBy(*key).agg(F.min(date).alias("first"), F.max(date).alias("last"))


def key_value_pivot(rows: DataFrame, file: str, key: str, value: str, order: str, keys: Sequence[str] | None = None) -> DataFrame:
    """One record for each file; the first file's keys are the columns unless they are given."""
    if keys is None:
        first = rows.agg(F.min(file)).first()[0]
        own = rows.where(F.col(file) == first).groupBy(key).agg(F.min(order).alias("at")).orderBy("at")
        keys = [r[0] for r in own.collect()]
    return rows.groupBy(file).pivot(key, list(keys)).agg(F.min_by(value, order))


def complete(expected: DataFrame, done: DataFrame, group: str, member: str) -> DataFrame:
    """group, complete: whether all expected members are done."""
    met = expected.join(done.select(group, member, F.lit(True).alias("__done")).distinct(), [group, member], "left")
    return met.groupBy(group).agg(F.bool_and(F.coalesce("__done", F.lit(False))).alias("complete"))


def by_day(rows: DataFrame, day: str, name: str) -> DataFrame:
    """y, m, d, files: newest first."""
    listed = rows.groupBy(F.year(day).alias("y"), F.month(day).alias("m"), F.dayofmonth(day).alias("d")).agg(F.array_sort(F.collect_list(name)).alias("files"))
    return listed.orderBy(F.desc("y"), F.desc("m"), F.desc("d"))


def status(expected: DataFrame, present: DataFrame, component: str, child: str) -> DataFrame:
    """component, status, children map: COMPLETE where all are present."""
    met = expected.join(present.select(component, child, F.lit(True).alias("__p")).distinct(), [component, child], "left")
    state = F.when(F.col("__p"), "COMPLETE").otherwise("INCOMPLETE")
    return met.groupBy(component).agg(F.when(F.bool_and(F.coalesce("__p", F.lit(False))), "COMPLETE").otherwise("INCOMPLETE").alias("status"), F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col(child), state.alias("s"))))).alias("children"))


def observed(rows: DataFrame, name: str):
    """(rows, observation): counts rows as they pass, without another job."""
    from pyspark.sql import Observation

    seen = Observation(name)
    return rows.observe(seen, F.count(F.lit(1)).alias("rows")), seen
