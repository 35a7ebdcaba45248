"""Joins that route what doesn't match. Which join runs is left to the optimiser: sizes decide, and AQE splits skewed keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tabwright.functions.distance import distance


def to_parent(children: DataFrame, parents: DataFrame, key: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(children with their parent's columns, children without one)."""
    marked = children.join(parents.withColumn("__found", F.lit(True)), list(key), "left")
    return marked.where("__found").drop("__found"), marked.where("__found is null").select(*children.columns)


def first_failing(rules: Mapping[str, Column], ok: str = "ok") -> Column:
    """Name of the first rule that fails (its column is true); rules are tried in order."""
    kind: Column | None = None
    for name, fails in rules.items():
        kind = F.when(fails, F.lit(name)) if kind is None else kind.when(fails, F.lit(name))
    return F.lit(ok) if kind is None else kind.otherwise(F.lit(ok))


def verified(children: DataFrame, parents: DataFrame, on: Column, missing: Column, rules: Mapping[str, Column], name: str = "issue_kind") -> DataFrame:
    """Left join with ``issue_kind``: parent_missing, else the first rule that fails, else ok."""
    return children.join(parents, on, "left").withColumn(name, first_failing({"parent_missing": missing, **rules}))


def missing_both_ways(left: DataFrame, right: DataFrame, key: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(keys of left alone, keys of right alone)."""
    a, b = left.select(*key).distinct(), right.select(*key).distinct()
    return a.join(b, list(key), "left_anti"), b.join(a, list(key), "left_anti")


def members(rows: DataFrame, listed: DataFrame, key: Sequence[str]) -> DataFrame:
    return rows.join(listed.select(*key).distinct(), list(key), "left_semi")


def on_path(rows: DataFrame, paths: DataFrame, code: str, path: Sequence[str]) -> DataFrame:
    """Whether the row's own path is one of its code's (one row for each path in ``paths``): known, matches."""
    known = paths.select(code, F.lit(True).alias("known")).distinct()
    right = paths.select(code, *path, F.lit(True).alias("matches")).distinct()
    met = rows.join(known, code, "left").join(right, [code, *path], "left")
    return met.withColumn("known", F.coalesce("known", F.lit(False))).withColumn("matches", F.coalesce("matches", F.lit(False)))


def fan_out(bodies: DataFrame, paths: DataFrame, key: str) -> DataFrame:
    """Each body once for each of its paths."""
    return bodies.join(paths, key)


def via_middle(rows: DataFrame, middles: DataFrame, parent: str, out: str) -> DataFrame:
    """middles(id, super): the parent's super where the parent is a middle, else the parent itself."""
    above = middles.select(F.col("id").alias(parent), F.col("super").alias("__super"))
    return rows.join(above, parent, "left").withColumn(out, F.coalesce("__super", parent)).drop("__super")


def reconciled(entities: DataFrame, register: DataFrame, code: str) -> DataFrame:
    """Full outer join on a code with ``status``: matched, unknown (no such code), missing (no entity), no_code."""
    left = entities.withColumn("__entity", F.lit(True))
    right = register.withColumn("__register", F.lit(True))
    met = left.join(right, code, "full_outer")
    status = F.when(F.col("__entity").isNull(), "missing").when(F.col(code).isNull(), "no_code").when(F.col("__register").isNull(), "unknown").otherwise("matched")
    return met.withColumn("status", status).drop("__entity", "__register")


def bridge(pairs: DataFrame, left: str, right: str) -> tuple[DataFrame, DataFrame]:
    """An M:N table both ways: left with its rights, right with its lefts, in order."""
    one = pairs.select(left, right).distinct()
    return one.groupBy(left).agg(F.array_sort(F.collect_list(right)).alias(f"{right}s")), one.groupBy(right).agg(F.array_sort(F.collect_list(left)).alias(f"{left}s"))


def one_to_one(pairs: DataFrame, left: str, right: str) -> DataFrame:
    """Pairs whose members have no other partner."""
    one = pairs.select(left, right).distinct()
    counted = one.withColumn("__l", F.count(F.lit(1)).over(Window.partitionBy(left))).withColumn("__r", F.count(F.lit(1)).over(Window.partitionBy(right)))
    return counted.where("__l = 1 and __r = 1").select(left, right)


def required(rows: DataFrame, register: DataFrame, key: Sequence[str]) -> DataFrame:
    """Inner join; a row without a partner raises when the result is computed."""
    met = rows.join(register.withColumn("__found", F.lit(True)), list(key), "left")
    checked = F.when(F.col("__found").isNull(), F.raise_error(F.concat(F.lit("no partner for "), F.to_json(F.struct(*key))))).otherwise(F.lit(True))
    return met.where(checked.cast("boolean")).drop("__found")


def zipped(sections: DataFrame, section: str, order: str, columns: Sequence[str], most: int = 1000) -> DataFrame:
    """Sections side by side: n, then sNN_column for every section; unequal lengths raise, and so do more than ``most``
    sections, as each makes columns."""
    numbered = sections.withColumn("n", F.row_number().over(Window.partitionBy(section).orderBy(order)))
    counted = sections.groupBy(section).agg(F.count(F.lit(1)).alias("n")).limit(most + 1).collect()
    if len(counted) > most:
        raise ValueError(f"there are more than {most} sections")
    names, sizes = sorted(r[0] for r in counted), [r["n"] for r in counted]
    if len(set(sizes)) > 1:
        raise ValueError(f"sections have {sorted(sizes)} rows")
    wide = numbered.groupBy("n").pivot(section, names).agg(*[F.first(c).alias(c) for c in columns], F.lit(1).alias("__one"))
    return wide.select("n", *[F.col(f"`{s}_{c}`").alias(f"{s}_{c}") for s in names for c in columns])


def side_by_side(left: DataFrame, right: DataFrame, key: str = "pos", cells: str = "cells") -> DataFrame:
    """Rows joined by place with an empty cell between them; a place in one alone raises."""
    met = left.select(key, F.col(cells).alias("__l")).join(right.select(key, F.col(cells).alias("__r")), key, "full_outer")
    both = F.when(F.col("__l").isNull() | F.col("__r").isNull(), F.raise_error(F.lit("the tables have other lengths")).cast("array<string>")).otherwise(F.concat("__l", F.array(F.lit("")), "__r"))
    return met.select(key, both.alias(cells))


def lookup(rows: DataFrame, dimension: DataFrame, key: str, column: str, otherwise: str) -> DataFrame:
    """The dimension's column (of several, the least), or a default."""
    one = dimension.groupBy(key).agg(F.min(column).alias(column))
    return rows.join(one, key, "left").withColumn(column, F.coalesce(column, F.lit(otherwise)))


def sets_compared(expected: DataFrame, current: DataFrame, key: str, member: str) -> DataFrame:
    """key, missing, extra: members expected but not there, and the other way; only keys that differ."""
    a = expected.groupBy(key).agg(F.collect_set(member).alias("__e"))
    b = current.groupBy(key).agg(F.collect_set(member).alias("__c"))
    none = F.array().cast(f"array<{dict(expected.dtypes)[member]}>")
    met = a.join(b, key, "full_outer").select(key, F.coalesce("__e", none).alias("e"), F.coalesce("__c", none).alias("c"))
    return met.select(key, F.array_sort(F.array_except("e", "c")).alias("missing"), F.array_sort(F.array_except("c", "e")).alias("extra")).where("size(missing) + size(extra) > 0")


def closest_name(rows: DataFrame, key: Sequence[str], register_name: str, names: str) -> DataFrame:
    """rows(key, register name, names array) -> with match and match_distance: the closest of label and aliases by the weighted
    distance; the first wins ties."""
    each = rows.select(*key, register_name, F.posexplode_outer(names).alias("__at", "__name"))
    scored = each.withColumn("__d", distance(F.col(register_name), F.col("__name")))
    best = scored.groupBy(*key).agg(F.min(F.struct(F.col("__d").isNull().alias("none"), F.col("__d").alias("d"), F.col("__at").alias("at"), F.col("__name").alias("name"))).alias("__b"))
    return rows.join(best, list(key), "left").select(*rows.columns, F.col("__b.name").alias("match"), F.col("__b.d").alias("match_distance"))
