"""Reconciliation of a register with an entity graph: issues(kind, key, payload JSON).

Entities have the schema of operators.entities; registers are tables with a code and a name. ``relations`` names the
columns that hierarchy checks compare, so one implementation serves every kind of entity.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tabwright.functions import text
from tabwright.operators import entities as E
from tabwright.operators.aggregates import one_each
from tabwright.operators.filters import ends_with_word
from tabwright.operators.joins import closest_name, sets_compared


def issue(rows: DataFrame, kind: str, key: Column, **payload: Column) -> DataFrame:
    return rows.select(F.lit(kind).alias("kind"), key.cast("string").alias("key"), F.to_json(F.struct(*[v.alias(k) for k, v in payload.items()])).alias("payload"))


def _all(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out


def graph_checks(entities: DataFrame, expected_parent: Callable[[Column], Column] | None = None, expected: str = "") -> DataFrame:
    """not_in_india, multiple_located_in (any number but one), wrong_kind_of_located_in, no_single_preferred_rank_for_located_in
    (one current parent, several claims, not one preferred), multiple_instance_of. An entity can raise several."""
    base = entities.select("id", E.label().alias("label"), E.in_country().alias("home"), E.item_ids(E.LOCATED_IN).alias("parents"), E.item_ids(E.INSTANCE_OF).alias("classes"), E.ranks().alias("ranks"))
    who = {"entity": F.col("id"), "label": F.col("label")}
    single = base.where("size(parents) = 1").withColumn("parent", F.element_at("parents", 1)).withColumn("preferred", F.size(F.filter("ranks", lambda r: r == "preferred")))
    parts = [
        issue(base.where("not home"), "not_in_india", F.col("id"), **who),
        issue(base.where("size(parents) != 1"), "multiple_located_in", F.col("id"), **who, located_in=F.col("parents")),
        issue(single.where("size(ranks) > 1 and preferred != 1"), "no_single_preferred_rank_for_located_in", F.col("id"), **who, num_preferred=F.col("preferred"), expected_preferred=F.col("parent")),
        issue(base.where("size(classes) != 1"), "multiple_instance_of", F.col("id"), **who, inst_of=F.col("classes")),
    ]
    if expected_parent is not None:
        parts.append(issue(single.where(~expected_parent(F.col("parent"))), "wrong_kind_of_located_in", F.col("id"), **who, located_in=F.col("parent"), expected=F.lit(expected)))
    return _all(parts)


def code_checks(
    entities: DataFrame, register: DataFrame, code: str, name: str, code_type: str = "localbody",
    prefixes: Sequence[str] = (), suffixes: Sequence[str] = (), threshold: float = 0.0, order: str = "pos",
) -> DataFrame:
    """no_lgd_id, multiple_lgd_ids (with unknown_lgd_id for each unknown one among them), unknown_lgd_id, duplicate_lgd_id (for
    each later holder, with the one before), name_mismatch (first holders alone) and missing.

    ``order`` is the entities' order. Entities of several codes hold none, so their codes are missing too.
    """
    base = entities.select("id", F.col(order).alias("order"), E.label().alias("label"), E.names().alias("names"), E.codes(code_type).alias("codes"))
    known = register.select(F.col(f"`{code}`").alias("code"), F.col(f"`{name}`").alias("name"))
    known = one_each(known, ["code"])
    who = {"entity": F.col("id"), "label": F.col("label")}
    several = base.where("size(codes) > 1").withColumn("code", F.explode("codes")).join(known, "code", "left")
    listed = several.groupBy("id", "label").agg(F.array_sort(F.collect_list(F.struct("code", F.coalesce("name", F.lit("NA")).alias("name")))).alias("entries"))
    single = base.where("size(codes) = 1").withColumn("code", F.element_at("codes", 1)).join(known, "code", "left")
    held = single.where("name is not null")
    window = Window.partitionBy("code").orderBy("order")
    placed = held.withColumn("n", F.row_number().over(window)).withColumn("prev", F.first("id").over(window)).withColumn("prev_label", F.first("label").over(window))
    first = placed.where("n = 1")
    tidy = first.withColumn("clean", text.clean_name(F.col("name"), prefixes, suffixes)).withColumn("cleaned", F.transform("names", lambda n: text.clean_name(n, prefixes, suffixes, folded=False)))
    folded = tidy.select("id", "label", "code", "name", "clean", "cleaned")
    scored = closest_name(folded, ["id"], "clean", "cleaned")
    entry = F.struct(F.col("code"), F.col("name"))
    missing = known.join(first.select("code"), "code", "left_anti")
    return _all([
        issue(base.where("size(codes) = 0"), "no_lgd_id", F.col("id"), **who),
        issue(listed, "multiple_lgd_ids", F.col("id"), **who, lgd_entries=F.col("entries")),
        issue(several.where("name is null"), "unknown_lgd_id", F.col("id"), **who, lgd_code=F.col("code")),
        issue(single.where("name is null"), "unknown_lgd_id", F.col("id"), **who, lgd_code=F.col("code")),
        issue(placed.where("n > 1"), "duplicate_lgd_id", F.col("code"), lgd_entry=entry, curr=F.col("id"), curr_label=F.col("label"), prev=F.col("prev"), prev_label=F.col("prev_label")),
        issue(scored.where(F.col("match_distance") > threshold), "name_mismatch", F.col("id"), **who, lgd_entry=entry, match=F.col("match"), distance=F.col("match_distance")),
        issue(missing, "missing", F.col("code"), lgd_entry=entry),
    ])


def hierarchy_check(found: DataFrame, expected: DataFrame, key: str, parent: str) -> DataFrame:
    """found and expected(key, parent): wrong_hierarchy where both have the key and the parents differ. NA is no parent."""
    a = found.where(F.col(parent) != "NA").select(key, F.col(parent).alias("current"))
    b = expected.where(F.col(parent) != "NA").select(key, F.col(parent).alias("expected"))
    b = one_each(b, [key])
    return issue(a.join(b, key).where("current != expected"), "wrong_hierarchy", F.col(key), current=F.col("current"), expected=F.col("expected"))


def suffix_check(entities: DataFrame, suffix: str | DataFrame, state: str | None = None) -> DataFrame:
    """entities(id, label, and ``state``): wrong_suffix unless the label ends with the suffix, fixed or by state: a table
    (state, suffix). States without one don't count."""
    if isinstance(suffix, str):
        met = entities.withColumn("suffix", F.lit(suffix))
    else:
        met = entities.join(one_each(suffix.select(state, "suffix"), [state]), state).where("coalesce(suffix, '') != ''")
    return issue(met.where(~ends_with_word(F.col("label"), F.col("suffix"))), "wrong_suffix", F.col("id"), label=F.col("label"), expected=F.col("suffix"))


def class_check(entities: DataFrame, classes: DataFrame, state: str) -> DataFrame:
    """entities(id, label, classes array, state), classes(state, class): wrong_inst_of unless one of the state's classes is there."""
    allowed = classes.groupBy(state).agg(F.collect_set("class").alias("allowed"))
    met = entities.join(allowed, state)
    return issue(met.where(~F.arrays_overlap("classes", "allowed")), "wrong_inst_of", F.col("id"), label=F.col("label"), current=F.array_sort("classes"), expected=F.array_sort("allowed"))


def contains_kind_check(entities: DataFrame, valid: DataFrame) -> DataFrame:
    """entities(id, label, contains array), valid(node): wrong_kind_of_contains with the contained items of another kind."""
    wrong = entities.select("id", "label", F.explode("contains").alias("node")).join(valid.select("node"), "node", "left_anti")
    listed = wrong.groupBy("id", "label").agg(F.array_sort(F.collect_set("node")).alias("nodes"))
    return issue(listed, "wrong_kind_of_contains", F.col("id"), label=F.col("label"), contains=F.col("nodes"))


def contains_inverse(parents: DataFrame, children: DataFrame, in_main_hierarchy: bool = True) -> DataFrame:
    """parents(id, contains array), children(id, located_in array): in_multiple_contains; missing_in_contains (the child says
    its parent, the parent doesn't say the child); missing_contained_in (the other way, unless such parents aren't in
    the main hierarchy)."""
    down = parents.select(F.col("id").alias("parent"), F.explode("contains").alias("child")).distinct()
    up = children.select(F.col("id").alias("child"), F.explode("located_in").alias("parent")).join(parents.select(F.col("id").alias("parent")), "parent", "left_semi").distinct()
    many = down.groupBy("child").agg(F.array_sort(F.collect_set("parent")).alias("parents")).where("size(parents) > 1")
    parts = [issue(many, "in_multiple_contains", F.col("child"), parents=F.col("parents")), issue(up.join(down, ["parent", "child"], "left_anti"), "missing_in_contains", F.col("parent"), child=F.col("child"))]
    if in_main_hierarchy:
        own = down.join(children.select(F.col("id").alias("child")), "child", "left_semi")
        parts.append(issue(own.join(up, ["parent", "child"], "left_anti"), "missing_contained_in", F.col("child"), parent=F.col("parent")))
    return _all(parts)


def completeness(expected: DataFrame, current: DataFrame, key: str, member: str, kind: str = "contains_mismatch") -> DataFrame:
    """expected and current(key, member): what is missing and extra for each key that differs."""
    return issue(sets_compared(expected, current, key, member), kind, F.col(key), missing=F.col("missing"), extra=F.col("extra"))


def overlap_check(expected: DataFrame, current: DataFrame, key: str, member: str) -> DataFrame:
    return completeness(expected, current, key, member, "wrong_territory_overlaps")


def coextensive_check(pairs: DataFrame, current: DataFrame, left: str, right: str) -> DataFrame:
    """pairs(left, right) that ought to be one to one, current(left, right): wrong_coextensive where they differ. Off by default in
    reports; ids are compared as text."""
    from tabwright.operators.joins import one_to_one

    a = one_to_one(pairs, left, right).select(F.col(left).cast("string").alias("l"), F.col(right).cast("string").alias("expected"))
    b = current.select(F.col(left).cast("string").alias("l"), F.col(right).cast("string").alias("current"))
    b = one_each(b, ["l"])
    met = a.join(b, "l", "left")
    return issue(met.where(~F.col("expected").eqNullSafe(F.col("current"))), "wrong_coextensive", F.col("l"), expected=F.col("expected"), current=F.col("current"))


def rollup(issues: DataFrame) -> DataFrame:
    return issues.groupBy("kind").agg(F.count(F.lit(1)).alias("n"))
