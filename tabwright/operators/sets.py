"""Set operations, snapshots and differences."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_all(parts: Sequence[DataFrame], strict: bool = True) -> DataFrame:
    """By column name; a column that some part lacks raises unless not strict."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=not strict), parts)


def added_removed(old: DataFrame, new: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of new alone, rows of old alone), as sets: how often a row stands in a snapshot doesn't count."""
    own = new.select(*old.columns)
    return own.subtract(old), old.subtract(own)


def changes(old: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """key, change: added (new alone) or removed (old alone)."""
    a, b = old.select(*key).distinct(), new.select(*key).distinct()
    added = b.join(a, list(key), "left_anti").withColumn("change", F.lit("added"))
    return added.unionByName(a.join(b, list(key), "left_anti").withColumn("change", F.lit("removed")))


def first_wins(previous: DataFrame, current: DataFrame, key: Sequence[str]) -> DataFrame:
    """All previous rows, then current ones with unseen keys."""
    return previous.unionByName(current.join(previous.select(*key).distinct(), list(key), "left_anti").select(*previous.columns))


class Vanished(ValueError):
    """Rows of an earlier snapshot are gone that may not go."""


def same_columns(previous: DataFrame, current: DataFrame) -> None:
    if previous.columns != current.columns:
        raise ValueError(f"columns differ: {previous.columns} and {current.columns}")


def merge_snapshots(previous: DataFrame, current: DataFrame, date: str, may_vanish: Column) -> DataFrame:
    """First-seen merge of two snapshots; other columns than the date are the key. Raises Vanished if a previous row is
    gone that isn't let go."""
    same_columns(previous, current)
    key = [c for c in previous.columns if c != date]
    gone = previous.join(current.select(*key).distinct(), key, "left_anti").where(~may_vanish)
    count = gone.count()
    if count:
        raise Vanished(f"{count} rows vanished")
    return first_wins(previous, current, key)


def extend_dates(catalog: DataFrame, dates: DataFrame, key: str) -> DataFrame:
    """catalog(key, dates), dates(key, dates): the distinct union, in order."""
    met = catalog.join(dates.withColumnRenamed("dates", "__new"), key, "full_outer")
    none = F.array().cast("array<string>")
    return met.select(key, F.array_sort(F.array_distinct(F.concat(F.coalesce("dates", none), F.coalesce("__new", none)))).alias("dates"))


def path_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """old and new(path, value): path, kind (add, remove, change), old, new."""
    met = old.select("path", F.col("value").alias("old"), F.lit(True).alias("__o")).join(new.select("path", F.col("value").alias("new"), F.lit(True).alias("__n")), "path", "full_outer")
    kind = F.when(F.col("__o").isNull(), "add").when(F.col("__n").isNull(), "remove").when(~F.col("old").eqNullSafe(F.col("new")), "change")
    return met.select("path", kind.alias("kind"), "old", "new").where("kind is not null")


def json_paths(document: Column, depth: int = 8) -> Column:
    """Not an array walk: leaf paths of a JSON object as array of struct(path, value), by levels of objects. A document
    of more levels than ``depth`` raises when it is computed."""
    level = F.transform(F.map_entries(F.from_json(document, "map<string,string>")), lambda e: F.struct(e["key"].alias("path"), e["value"].alias("value")))
    for _ in range(depth - 1):

        def deeper(e: Column) -> Column:
            inner = F.from_json(e["value"], "map<string,string>", {"mode": "PERMISSIVE"})
            own = F.transform(F.map_entries(inner), lambda k: F.struct(F.concat(e["path"], F.lit("."), k["key"]).alias("path"), k["value"].alias("value")))
            return F.when(e["value"].startswith("{") & inner.isNotNull(), own).otherwise(F.array(e))

        level = F.flatten(F.transform(level, deeper))
    unread = F.exists(level, lambda e: e["value"].startswith("{") & F.from_json(e["value"], "map<string,string>").isNotNull())
    return F.when(F.coalesce(unread, F.lit(False)), F.raise_error(F.lit(f"a document has more than {depth} levels")).cast("array<struct<path:string,value:string>>")).otherwise(level)


def common(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.intersect(right)
