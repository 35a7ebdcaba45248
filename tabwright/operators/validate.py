"""Row validation: a row is accepted, or becomes an issue of the first rule that it breaks.

Issues have kind, scope, key, message, row (JSON) and prev (JSON of the row that was there first, or null).
A row is accepted only if it passes all rules, and dimensions are accepted before children join them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tabwright.functions import arrays
from tabwright.operators.aggregates import one_each
from tabwright.operators.joins import first_failing

ISSUE = ("kind", "scope", "key", "message", "row", "prev")


def issues(rows: DataFrame, kind: Column, scope: str, key: Column, message: Column, row: Column, prev: Column | None = None) -> DataFrame:
    return rows.select(kind.alias("kind"), F.lit(scope).alias("scope"), key.alias("key"), message.alias("message"), F.to_json(row).alias("row"), (F.to_json(prev) if prev is not None else F.lit(None).cast("string")).alias("prev"))


def _row(columns: Sequence[str]) -> Column:
    return F.struct(*[F.col(f"`{c}`") for c in columns])


def child_table(
    children: DataFrame, scope: str, code: str, order: Sequence[str],
    parent: DataFrame | None = None, parent_code: str | None = None, agreeing: Mapping[str, str] | None = None,
    name: str | None = None, name_within: Sequence[str] = (), names_unique: bool = True, same_name_same_code: str = "code_repeat", code_unique: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """(accepted, issues) of a register's rows, in ``order``.

    Rules, the first that fails counts: unknown_parent; NAME_mismatch for each child column in ``agreeing`` that differs
    from the parent's column; name_repeat (a name seen before in ``name_within`` with another code; with the same
    code it is ``same_name_same_code``); code_repeat. Repeats are judged among the rows that pass the rules before,
    as a rejected row doesn't take a place.
    """
    own = children.columns
    met = children
    rules: dict[str, Column] = {}
    if parent is not None:
        up = parent.select(F.col(parent_code).alias("__parent"), *[F.col(c).alias(f"__up_{i}") for i, c in enumerate((agreeing or {}).values())], F.lit(True).alias("__found"))
        up = one_each(up, ["__parent"])
        met = children.join(up, F.col(f"`{parent_code}`") == F.col("__parent"), "left")
        rules["unknown_parent"] = F.col("__found").isNull()
        for i, column in enumerate(agreeing or {}):
            rules[f"{column}_mismatch"] = ~F.col(f"`{column}`").eqNullSafe(F.col(f"__up_{i}"))
    met = met.withColumn("__kind", first_failing(rules))
    bad, good = met.where("__kind != 'ok'"), met.where("__kind = 'ok'")
    out = issues(bad, F.col("__kind"), scope, F.col(f"`{code}`"), F.concat(F.lit(f"{scope}: "), F.col("__kind")), _row(own))
    if name is not None and names_unique:
        window = Window.partitionBy(*name_within, name).orderBy(*order)
        good = good.withColumn("__n", F.row_number().over(window)).withColumn("__prev", F.first(_row(own)).over(window))
        same = F.col("__prev")[code].eqNullSafe(F.col(f"`{code}`"))
        repeated = good.where("__n > 1")
        out = out.unionByName(issues(repeated, F.when(same, F.lit(same_name_same_code)).otherwise(F.lit("name_repeat")), scope, F.col(f"`{code}`"), F.concat(F.lit(f"{scope}: repeated name "), F.col(f"`{name}`")), _row(own), F.col("__prev")))
        good = good.where("__n = 1").drop("__n", "__prev")
    if code_unique:
        window = Window.partitionBy(code).orderBy(*order)
        good = good.withColumn("__n", F.row_number().over(window)).withColumn("__prev", F.first(_row(own)).over(window))
        out = out.unionByName(issues(good.where("__n > 1"), F.lit("code_repeat"), scope, F.col(f"`{code}`"), F.concat(F.lit(f"{scope}: repeated code "), F.col(f"`{code}`")), _row(own), F.col("__prev")))
        good = good.where("__n = 1").drop("__n", "__prev")
    return good.select(*own), out


def spanning_table(children: DataFrame, scope: str, code: str, path: Sequence[str], order: Sequence[str], parent: DataFrame, parent_code: str, agreeing: Mapping[str, str], name: str, name_within: Sequence[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(accepted, issues, paths) where one code may be under several parents: one row in ``paths`` for each of its paths."""
    good, out = child_table(children, scope, code, order, parent, parent_code, agreeing, name, name_within, True, "code_repeat", False)
    window = Window.partitionBy(*path, code).orderBy(*order)
    marked = good.withColumn("__n", F.row_number().over(window))
    repeated = marked.where("__n > 1")
    out = out.unionByName(issues(repeated, F.lit("code_repeat"), scope, F.col(f"`{code}`"), F.concat(F.lit(f"{scope}: repeated code "), F.col(f"`{code}`")), _row(children.columns)))
    good = marked.where("__n = 1").drop("__n")
    return good, out, good.select(code, *path).distinct()


def coverage(expected: DataFrame, found: DataFrame, code: str, scope: str) -> DataFrame:
    """Codes of one side alone, as issues not_covered and not_expected."""
    a, b = expected.select(code).distinct(), found.select(code).distinct()
    row = F.struct(F.col(f"`{code}`"))
    left = issues(a.join(b, code, "left_anti"), F.lit("not_covered"), scope, F.col(f"`{code}`"), F.lit(f"{scope}: not covered"), row)
    return left.unionByName(issues(b.join(a, code, "left_anti"), F.lit("not_expected"), scope, F.col(f"`{code}`"), F.lit(f"{scope}: not expected"), row))


def member_mapping(
    rows: DataFrame, scope: str, member: str, member_paths: DataFrame, path: Sequence[str], order: Sequence[str],
    group: str | None = None, group_paths: DataFrame | None = None, group_path: Sequence[str] = (), body: str | None = None, name: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(accepted, issues) of a table that maps members (villages) to groups (blocks) or bodies.

    Rows without member code and ``name`` don't count. A member's later rows are skipped, and are an issue
    member_repeat only if the body is the same too. Then, first failing: unknown_member; path_mismatch;
    no_group (empty group); unknown_group; group_path_mismatch (no path of the group fits the row).
    """
    own = rows.columns
    empty = lambda c: F.coalesce(F.col(f"`{c}`"), F.lit("")) == ""
    kept = rows.where(~(empty(member) & empty(name))) if name else rows
    window = Window.partitionBy(member).orderBy(*order)
    kept = kept.withColumn("__n", F.row_number().over(window)).withColumn("__prev", F.first(_row(own)).over(window))
    again = kept.where("__n > 1")
    same = F.col("__prev")[body].eqNullSafe(F.col(f"`{body}`")) if body else F.lit(True)
    out = issues(again.where(same), F.lit("member_repeat"), scope, F.col(f"`{member}`"), F.lit(f"{scope}: repeated member"), _row(own), F.col("__prev"))
    met = kept.where("__n = 1").drop("__n", "__prev")
    known = member_paths.select(F.col(member).alias("__m"), *[F.col(c).alias(f"__p{i}") for i, c in enumerate(path)], F.lit(True).alias("__known"))
    known = one_each(known, ["__m"])
    met = met.join(known, F.col(f"`{member}`") == F.col("__m"), "left")
    off = F.lit(False)
    for i, column in enumerate(path):
        off = off | ~F.col(f"`{column}`").eqNullSafe(F.col(f"__p{i}"))
    rules = {"unknown_member": F.col("__known").isNull(), "path_mismatch": off}
    if group is not None and group_paths is not None:
        groups = group_paths.select(F.col(group).alias("__g")).distinct().withColumn("__group", F.lit(True))
        fits = group_paths.select(F.col(group).alias("__h"), *[F.col(c).alias(f"__q{i}") for i, c in enumerate(group_path)]).distinct().withColumn("__fits", F.lit(True))
        on = F.col(f"`{group}`") == F.col("__h")
        for i, column in enumerate(group_path):
            on = on & (F.col(f"`{column}`") == F.col(f"__q{i}"))
        met = met.join(groups, F.col(f"`{group}`") == F.col("__g"), "left").join(fits, on, "left")
        rules |= {"no_group": empty(group), "unknown_group": F.col("__group").isNull(), "group_path_mismatch": F.col("__fits").isNull()}
    met = met.withColumn("__kind", first_failing(rules))
    bad = met.where("__kind != 'ok'")
    out = out.unionByName(issues(bad, F.col("__kind"), scope, F.col(f"`{member}`"), F.concat(F.lit(f"{scope}: "), F.col("__kind")), _row(own)))
    return met.where("__kind = 'ok'").select(*own), out


def must_exist(rows: DataFrame, scope: str, code: str, register: DataFrame, where: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows (those that ``where`` picks) whose code the register has; the others are unknown_code issues."""
    chosen = rows if where is None else rows.where(where)
    known = register.select(code).distinct()
    bad = chosen.join(known, code, "left_anti").select(*rows.columns)
    return chosen.join(known, code, "left_semi").select(*rows.columns), issues(bad, F.lit("unknown_code"), scope, F.col(f"`{code}`"), F.lit(f"{scope}: unknown code"), _row(rows.columns))


def deepest(columns: Mapping[str, str]) -> Column:
    """struct(level, code) of the last column, in order from the top, that isn't empty; null if all are."""
    found: Column = F.lit(None).cast("struct<level:string,code:string>")
    for level, column in columns.items():
        found = F.when(F.coalesce(F.col(f"`{column}`"), F.lit("")) != "", F.struct(F.lit(level).alias("level"), F.col(f"`{column}`").alias("code"))).otherwise(found)
    return found


def attach_deepest(rows: DataFrame, scope: str, body: str, levels: Mapping[str, str], leaf: str, order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with level and code of the deepest non-empty level, issues): no_level, and leaf_in_two_bodies for a leaf
    that an earlier row gave to another body."""
    met = rows.withColumn("__d", deepest(levels)).select("*", F.col("__d.level").alias("level"), F.col("__d.code").alias("code"))
    window = Window.partitionBy("level", "code").orderBy(*order)
    met = met.withColumn("__first", F.first(body).over(window))
    twice = (F.col("level") == leaf) & (F.col("__first") != F.col(body))
    kind = first_failing({"no_level": F.col("level").isNull(), "leaf_in_two_bodies": twice})
    met = met.withColumn("__kind", kind)
    bad = issues(met.where("__kind != 'ok'"), F.col("__kind"), scope, F.col(body), F.concat(F.lit(f"{scope}: "), F.col("__kind")), _row(rows.columns))
    return met.where("__kind = 'ok'").drop("__d", "__first", "__kind"), bad


# Page-table rows: messages on positional cells; no message means that the row passes.


def _empty(cells: Column, at: int) -> Column:
    return F.coalesce(F.try_element_at(cells, F.lit(at + 1)), F.lit("")) == ""


def required_cells(cells: Column, columns: Sequence[int], blank_passes: bool = True, text: str = "col {} is empty") -> Column:
    """A message for each empty cell of the columns; rows of empty cells pass unless they may not."""
    none = F.array().cast("array<string>")
    found = F.concat(*[F.when(_empty(cells, c), F.array(F.lit(text.format(c)))).otherwise(none) for c in columns])
    return F.when(arrays.all_empty(cells), none).otherwise(found) if blank_passes else found


def must_be_empty(cells: Column, columns: Sequence[int]) -> Column:
    none = F.array().cast("array<string>")
    return F.concat(*[F.when(~_empty(cells, c), F.array(F.lit(f"col {c} expected to be empty"))).otherwise(none) for c in columns])


def all_or_none(cells: Column, columns: Sequence[int]) -> Column:
    """Either all cells of the columns have text or none has."""
    some, lacking = F.lit(False), F.lit(False)
    for c in columns:
        some, lacking = some | ~_empty(cells, c), lacking | _empty(cells, c)
    return F.when(some & lacking, F.array(F.lit(f"cols {min(columns)} to {max(columns)} are neither all set nor all empty"))).otherwise(F.array().cast("array<string>"))


def required_if_any(cells: Column, columns: Sequence[int], start: int) -> Column:
    """The columns are required if any cell from ``start`` on has text."""
    later = ~arrays.all_empty(arrays.part(cells, start))
    return F.when(later, required_cells(cells, columns, False)).otherwise(F.array().cast("array<string>"))


def expected_counts(pages: DataFrame, document: str, expected: DataFrame) -> DataFrame:
    """expected(document, pages), pages(document, page): documents whose pages aren't all there."""
    have = pages.groupBy(document).agg(F.countDistinct("page").alias("found"))
    return expected.join(have, document, "left").withColumn("found", F.coalesce("found", F.lit(0))).where("found != pages")
