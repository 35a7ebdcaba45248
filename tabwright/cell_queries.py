"""Queries of the functions and per-row operators: text, dates, numbers, cells, filters, projections, registers' rarer rules."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.functions import arrays, dates, numbers, text
from tabwright.operators import aggregates, columns, filters, hierarchy, joins, ordered, sets, validate
from tabwright.plans import selection
from tabwright.registry import big, load, query
from tabwright.sources import tables


def _tagged(parts: dict[str, DataFrame]) -> DataFrame:
    """Tables of equal columns under each other, each with its name in ``of``."""
    return reduce(DataFrame.unionByName, [rows.withColumn("of", F.lit(name)) for name, rows in parts.items()])


# Text, dates and numbers


@query("""
    SELECT c_custkey AS k, 'Zurich oe ' || c_custkey AS folded, upper(c_name) || ' X' AS canon, CASE WHEN c_custkey % 2 = 0 THEN 'FIXED' ELSE 'NAME ' || c_custkey END AS corrected,
    'VILLAGE ' || c_custkey AS coded, 'a b' || chr(10) || 'c' AS spaces, c_name AS head, 'Phase ' || c_custkey AS rest, c_name AS bare, 'blocks' AS prefix, '0' || c_custkey % 9 + 1 || 'May2024' AS date,
    'page_' || c_custkey || '.html' AS file, 'http://h/p?old=1&id=' || c_custkey || '&q=a+%26+b' AS url, 'Q' || c_custkey AS item, c_custkey AS number, CASE c_custkey % 4 WHEN 0 THEN 'English' WHEN 1 THEN 'Espanol' WHEN 2 THEN 'Deutsch' ELSE 'NA' END AS label,
    CASE WHEN c_custkey % 3 = 0 THEN CAST(c_custkey AS VARCHAR) END AS session, c_custkey % 5 AS pages FROM customer""")
def more_text_functions(spark, d):
    k = F.col("c_custkey")
    n = k.cast("string")
    head = text.head_and_rest(F.concat(F.lit("  "), "c_name", F.lit("  Phase \t"), n))
    name = text.file_name_parts(F.concat(F.lit("blocks.0"), (k % 9 + 1).cast("string"), F.lit("May2024.csv.7z")))
    labels = F.map_from_entries(F.filter(F.array(
        F.when(k % 4 == 0, F.struct(F.lit("en").alias("a"), F.lit("English").alias("b"))), F.when(k % 4 == 1, F.struct(F.lit("es").alias("a"), F.lit("Español").alias("b"))),
        F.when(k % 4 < 3, F.struct(F.lit("de").alias("a"), F.lit("Deutsch").alias("b"))), F.struct(F.lit("ru").alias("a"), F.lit("Слово").alias("b")),
    ), lambda e: e.isNotNull()))
    url = text.with_query(F.concat(F.lit("http://h/p?old=1&id=0#top"), F.lit("")), {"id": n, "q": F.lit("a & b")})
    return load(spark, d, "customer").select(
        k.alias("k"), text.ascii_fold(F.concat(F.lit("Zürich œ "), n)).alias("folded"), text.canon(F.concat(F.lit(" "), "c_name", F.lit("  \tx "))).alias("canon"),
        text.canon(F.when(k % 2 == 0, "wrong  name").otherwise(F.concat(F.lit("Name "), n)), {"WRONG NAME": "FIXED"}).alias("corrected"), text.drop_trailing_code(F.concat(F.lit("Village "), n, F.lit(" (1234567890123456) "))).alias("coded"),
        text.collapse_spaces(F.lit("a   b\nc")).alias("spaces"), head["head"].alias("head"), head["rest"].alias("rest"), text.without(F.concat("c_name", F.lit(" District")), " District").alias("bare"),
        name["prefix"].alias("prefix"), name["date"].alias("date"), text.coded_file_name("page_", n, ".html").alias("file"), url.alias("url"), text.entity_id(k).alias("item"), text.entity_number(text.entity_id(k)).alias("number"),
        text.best_label(labels, ["de", "es"]).alias("label"), text.extract(F.concat(F.when(k % 3 == 0, "session=").otherwise("none="), n, F.lit(";")), "session=(\\d+);").alias("session"),
        big(text.page_count(F.transform(F.sequence(F.lit(0), (k % 5).cast("int")), lambda i: i.cast("string")))).alias("pages"),
    )


@query("""
    SELECT event_id, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS shown, date_trunc('second', ts) - INTERVAL 330 MINUTE AS east, date_trunc('second', ts) + INTERVAL 60 MINUTE AS west, date_trunc('day', ts) AS day,
    CAST(CAST(ts AS DATE) - 2 AS VARCHAR) || ',' || CAST(CAST(ts AS DATE) - 1 AS VARCHAR) || ',' || CAST(CAST(ts AS DATE) AS VARCHAR) AS last, CASE WHEN event_id % 2 = 0 THEN strftime(ts, '%Y-%m-%d') ELSE strftime(ts, '%Y-%m') END AS listed, CAST(ts AS DATE) - 1 AS run_for FROM events""")
def more_date_functions(spark, d):
    at = F.date_format("ts", "yyyyMMddHHmmss")
    even = F.col("event_id") % 2 == 0
    return load(spark, d, "events").select(
        "event_id", dates.from_millis(F.unix_millis(F.col("ts").cast("timestamp"))).alias("shown"), dates.document_date(F.concat(F.lit("D:"), at, F.lit("+05'30'"))).cast("timestamp_ntz").alias("east"),
        dates.document_date(F.concat(F.lit("D:"), at, F.lit("-01'00'"))).cast("timestamp_ntz").alias("west"), dates.document_date(F.date_format("ts", "yyyyMMdd")).cast("timestamp_ntz").alias("day"),
        F.array_join(F.transform(dates.last_days(F.col("ts").cast("date"), 3), lambda x: x.cast("string")), ",").alias("last"), dates.listed(F.when(even, dates.show(F.col("ts"), dates.COMPACT)).otherwise(dates.show(F.col("ts"), dates.MONTH))).alias("listed"),
        dates.run_day(F.col("ts").cast("date"), 1).alias("run_for"),
    )


@query("""
    SELECT p_partkey AS k, CASE p_partkey % 4 WHEN 0 THEN '0 Bytes' WHEN 1 THEN p_partkey % 1000 + 1 || ' Bytes' WHEN 2 THEN p_partkey || '.5 KB' ELSE '3 GB' END AS size, CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE CAST(p_partkey % 90 AS DOUBLE) + 0.12346 END AS degrees,
    CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_partkey END AS whole FROM part WHERE p_partkey < 1000""")
def more_number_functions(spark, d):
    k = F.col("p_partkey")
    size = F.when(k % 4 == 0, F.lit(0)).when(k % 4 == 1, k % 1000 + 1).when(k % 4 == 2, k * 1024 + 512).otherwise(F.lit(3 * 1024**3))
    word = F.when(k % 3 == 0, "n/a").otherwise(F.concat((k % 90).cast("string"), F.lit(".123457")))
    return load(spark, d, "part").where("p_partkey < 1000").select(k.alias("k"), numbers.file_size(size).alias("size"), numbers.coordinate(word).alias("degrees"), numbers.integer(F.when(k % 3 == 0, "x").otherwise(F.concat(F.lit(" "), k.cast("string")))).alias("whole"))


@query("""
    SELECT event_id, event_type || '||' || user_id AS cells, false AS none, true AS some, event_type AS first, '|' || user_id AS rest, event_type || '|new||' || user_id AS put, CASE WHEN event_type = 'click' THEN 'click,view' ELSE event_type || ',view,click' END AS members,
    'a=1,b=' || event_id || ',c=3' AS merged, CAST(user_id AS VARCHAR) AS state_code, '' AS block_code, CAST(event_id AS VARCHAR) AS block_name, '' AS hab_code FROM events WHERE event_type <> 'view'""")
def more_array_functions(spark, d):
    cells = F.array("event_type", F.lit(""), F.col("user_id").cast("string"))
    shown = lambda m: F.array_join(F.transform(F.array_sort(F.map_entries(m)), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")
    merged = arrays.merge_maps(F.create_map(F.lit("a"), F.lit("1"), F.lit("b"), F.lit("2")), F.create_map(F.lit("b"), F.col("event_id").cast("string"), F.lit("c"), F.lit("3")))
    entry = lambda level, code, name: F.struct(F.lit(level).alias("level"), code.alias("code"), name.alias("name"))
    stack = F.array(entry("state", F.col("user_id").cast("string"), F.lit("s")), entry("block", F.lit(None).cast("string"), F.col("event_id").cast("string")))
    flat = {c: column for c, column in zip(("state_code", "state_name", "block_code", "block_name", "hab_code"), arrays.flatten_stack(stack, ["state", "block", "hab"], ["code", "name"]), strict=False)}
    join = lambda a: F.array_join(a, "|")
    members = arrays.with_member(F.when(F.col("event_type") == "click", F.array(F.lit("click"), F.lit("view"))).otherwise(F.array("event_type", F.lit("view"))), F.lit("click"))
    return load(spark, d, "events").where("event_type != 'view'").select(
        "event_id", join(cells).alias("cells"), arrays.all_empty(cells).alias("none"), arrays.any_empty(cells).alias("some"), join(arrays.part(cells, 0, 1)).alias("first"), join(arrays.part(cells, 1)).alias("rest"), join(arrays.insert_cell(cells, 1, F.lit("new"))).alias("put"),
        F.array_join(members, ",").alias("members"), shown(merged).alias("merged"), flat["state_code"].alias("state_code"), flat["block_code"].alias("block_code"), flat["block_name"].alias("block_name"), flat["hab_code"].alias("hab_code"),
    )


# Filters


_FILTERS = {
    "not_empty": "k % 5 <> 0", "of_type": "k % 3 = 1", "total": "k % 4 = 0", "closing": "k % 4 = 0 AND k % 5 = 0 AND k % 7 = 6", "section": "k % 5 = 0 AND k % 6 = 0", "header": "k % 4 = 1 OR (k % 7 = 0 AND k % 8 = 0)", "holds": "k % 9 = 0",
    "listed": "k % 10 <> 3", "month": "k % 11 = 0", "release": "k % 12 < 2", "empty": "k % 4 = 3 AND k % 5 = 0 AND k % 6 = 0", "transform": "k % 5 <> 0",
}


@query(" UNION ALL ".join(f"SELECT '{name}' AS of, k FROM (SELECT c_custkey AS k FROM customer) WHERE {rule}" for name, rule in _FILTERS.items()))
def row_filters(spark, d):
    k = F.col("k")
    first = F.when(k % 4 == 0, F.concat(F.lit("Total "), k.cast("string"))).when(k % 4 == 1, " State name").when(k % 4 == 3, "").otherwise("x")
    last = F.when(k % 9 == 0, "see http://x").when(k % 6 == 0, "").otherwise("v")
    cells = F.array(first, F.when(k % 5 == 0, "").otherwise("y"), last)
    rows = load(spark, d, "customer").select(F.col("c_custkey").alias("k")).withColumn("hab", F.when(k % 5 != 0, "h")).withColumn("kind", (k % 3).cast("string")).withColumn("cells", cells)
    rows = rows.withColumn("file", F.when(k % 11 == 0, "blocks.May2024.csv.7z").otherwise("blocks.01May2024.7z")).withColumn("tag", F.when(k % 12 == 0, "base").when(k % 12 == 1, "base-extra").otherwise("basement"))
    own = F.col("cells")
    section_cells = F.array(F.lit("Block"), own[1], F.when(k % 6 == 0, "").otherwise("v"))
    chosen = {
        "not_empty": filters.not_empty("hab"), "of_type": filters.of_type("kind", "1"), "total": filters.total_row(own), "closing": filters.closing_total(own, k % 7, F.lit(7)), "section": filters.section_row(section_cells),
        "header": filters.header_row(own, ["state", "gram"], k % 7, k % 8), "holds": filters.holds(own, ["http", "*"]), "month": filters.of_month(F.col("file"), "May2024"), "release": filters.of_release(F.col("tag"), "base"),
        "empty": arrays.all_empty(F.array(first, F.when(k % 5 == 0, "").otherwise("y"), F.when(k % 6 == 0, "").otherwise("v"))),
    }
    parts = {name: rows.where(keep).select("k") for name, keep in chosen.items()}
    deny = rows.where("k % 10 = 3").select("k")
    parts["listed"] = filters.without_listed(rows, deny, ["k"]).select("k")
    parts["transform"] = tables.named_transform("ignore_if_empty_field", "hab")(rows).select("k")
    return _tagged(parts).select("of", "k")


# Projections and repairs


@query("""
    SELECT p_partkey AS code, trim(p_name) || 'x' AS name, CASE WHEN p_size % 3 = 0 THEN '0' ELSE CAST(p_size AS VARCHAR) END AS size, CASE WHEN p_size % 4 = 0 THEN 'path' ELSE p_brand END AS brand, 'kept' AS source FROM part""")
def cell_columns(spark, d):
    rows = load(spark, d, "part").select("p_partkey", F.concat(F.lit(" "), "p_name", F.lit("\nx ")).alias("p name"), F.when(F.col("p_size") % 3 != 0, F.col("p_size").cast("string")).otherwise("").alias("size"), "p_brand", F.lit("drop me").alias("more"), (F.col("p_size") % 4 == 0).alias("flag"))
    named = columns.project(rows, {"size": "size", "code": "p_partkey", "name": "p name", "brand": "p_brand", "flag": "flag", "more": "more"})
    named = columns.clean_cells(columns.keep_or_drop(named, drop=["more"]))
    named = columns.override_from_path(named, "brand", F.lit("path"), F.col("flag")).withColumn("size", columns.default("size", "0"))
    named = columns.enrich(columns.promote(named, ["code", "name"]), {"source": " kept "})
    return columns.keep_or_drop(named, keep=["code", "name", "size", "brand", "source", "nowhere"])


@query("""
    SELECT c_custkey AS k, 'a|b' AS left_cells, 'd' || c_custkey AS right_cells, CASE WHEN c_custkey % 2 = 0 THEN 'a|Name|b' ELSE 'a||b' END AS wide, CASE WHEN c_custkey % 3 = 0 THEN 'one|two|x' WHEN c_custkey % 3 = 1 THEN 'one' || chr(10) || 'two|three|x' ELSE 'one||x' END AS unspilled FROM customer""")
def cell_repairs(spark, d):
    k = F.col("k")
    rows = load(spark, d, "customer").select(F.col("c_custkey").alias("k")).withColumn("cells", F.array(F.lit("a"), F.lit("b"), F.lit("c"), F.concat(F.lit("d"), k)))
    left, right = columns.split_table(rows, "cells", (0, 2), (3, None))
    join = lambda a: F.array_join(a, "|")
    spilled = F.when(k % 3 == 0, F.array(F.lit("one\ntwo"), F.lit(""), F.lit("x"))).when(k % 3 == 1, F.array(F.lit("one\ntwo"), F.lit("three"), F.lit("x"))).otherwise(F.array(F.lit("one"), F.lit(""), F.lit("x")))
    both = left.select("k", join("cells").alias("left_cells")).join(right.select("k", join("cells").alias("right_cells")), "k")
    return both.withColumn("wide", join(columns.widen(F.array(F.lit("a"), F.lit("b")), 2, 1, k % 2 == 0, "Name"))).withColumn("unspilled", join(columns.unspill(spilled, [1, 2])))


@query("""
    SELECT c_custkey AS k, CASE WHEN c_custkey % 5 = 1 THEN 'patched' WHEN c_custkey % 5 = 2 THEN 'whole' ELSE c_name END AS name, CASE WHEN c_custkey % 5 = 2 THEN 'SEGMENT' ELSE c_mktsegment END AS segment,
    CASE WHEN c_nationkey < 20 THEN 'NATION_' || c_nationkey END AS parent FROM customer WHERE c_custkey % 5 <> 3 AND c_nationkey < 23""")
def record_edits(spark, d):
    rows = load(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("n"))
    edits = rows.where("k % 5 = 1").select("k", F.create_map(F.lit("name"), F.lit("patched")).alias("changes"))
    whole = F.struct(F.lit("whole").alias("name"), F.lit("SEGMENT").alias("segment"), F.col("n").alias("n"))
    overrides = rows.where("k % 5 in (2, 3)").select("k", F.when(F.col("k") % 5 == 2, whole).alias("record"))
    done = columns.override_records(columns.patch(rows, edits, "k"), overrides, "k")
    nation = load(spark, d, "nation").select(F.col("n_nationkey").alias("n"), F.col("n_name").alias("name_of"))
    kept, lacking = columns.enrich_or_fail(done, nation.where("n < 23"), "n", {"there": "n"})
    known = kept.join(lacking, "n", "left_anti").drop("there")
    # A nation that is listed twice gives the lesser name.
    twice = nation.where("n < 20").unionByName(nation.where("n < 20").withColumn("name_of", F.lit("Z")))
    return columns.enrich_from_parent(known, twice, "n", {"parent": "name_of"}).select("k", "name", "segment", "parent")


# Joins, order and sets


@query("""
    SELECT 'any_path' AS of, CAST(c_custkey AS VARCHAR) AS k, CASE WHEN c_nationkey >= 20 THEN 'unknown' WHEN c_custkey % 2 = c_nationkey % 2 OR c_custkey % 3 = 0 THEN 'fits' ELSE 'other' END AS v FROM customer UNION ALL
    SELECT 'fan_out', CAST(n_nationkey AS VARCHAR), CAST(s_suppkey AS VARCHAR) FROM nation JOIN supplier ON s_nationkey = n_nationkey UNION ALL
    SELECT 'required', CAST(s_suppkey AS VARCHAR), n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey UNION ALL
    SELECT 'side_by_side', CAST(n_nationkey AS VARCHAR), n_name || '||' || (n_nationkey * 2) FROM nation UNION ALL
    SELECT 'first_match', CAST(c_nationkey AS VARCHAR), CAST(min(c_custkey) AS VARCHAR) FROM customer WHERE c_acctbal > 0 GROUP BY c_nationkey UNION ALL
    SELECT 'numbered', CAST(n_nationkey AS VARCHAR), CAST(row_number() OVER (PARTITION BY n_regionkey ORDER BY n_name) AS VARCHAR) FROM nation UNION ALL
    SELECT 'wrong_count', CAST(n_regionkey AS VARCHAR), CAST(count(*) <> 5 AS VARCHAR) FROM nation WHERE n_nationkey <> 7 GROUP BY n_regionkey""")
def rarer_joins(spark, d):
    customer, nation, supplier = load(spark, d, "customer"), load(spark, d, "nation"), load(spark, d, "supplier")
    both = lambda rows, k, v: rows.select(F.col(k).cast("string").alias("k"), v.cast("string").alias("v"))
    # Every nation below 20 has the path of its parity, and all of them path 9.
    paths = nation.where("n_nationkey < 20").select(F.col("n_nationkey").alias("c_nationkey"), F.explode(F.array((F.col("n_nationkey") % 2).cast("int"), F.lit(9))).alias("path"))
    met = joins.on_path(customer.withColumn("path", F.when(F.col("c_custkey") % 3 == 0, F.lit(9)).otherwise((F.col("c_custkey") % 2).cast("int"))), paths, "c_nationkey", ["path"])
    nations = nation.select(F.col("n_nationkey").alias("key"), "n_name", "n_regionkey")
    suppliers = supplier.select("s_suppkey", F.col("s_nationkey").alias("key"))
    left, right = nations.select(F.col("key").alias("pos"), F.array("n_name").alias("cells")), nations.select(F.col("key").alias("pos"), F.array((F.col("key") * 2).cast("string")).alias("cells"))
    lists = aggregates.grouped_list(nations.where("key != 7"), ["n_regionkey"], "key", "key")
    return _tagged({
        "any_path": both(met, "c_custkey", F.when(~F.col("known"), "unknown").when(F.col("matches"), "fits").otherwise("other")),
        "fan_out": both(joins.fan_out(nations, suppliers, "key"), "key", F.col("s_suppkey")),
        "required": both(joins.required(suppliers, nations, ["key"]), "s_suppkey", F.col("n_name")),
        "side_by_side": both(joins.side_by_side(left, right), "pos", F.array_join("cells", "|")),
        "first_match": both(aggregates.first_match(customer, F.col("c_acctbal") > 0, ["c_nationkey"], ["c_custkey"]), "c_nationkey", F.col("c_custkey")),
        "numbered": both(aggregates.numbered(nations, ["n_regionkey"], ["n_name"]), "key", F.col("n")),
        "wrong_count": both(lists, "n_regionkey", aggregates.wrong_count(F.col("values"), 5)),
    }).select("of", "k", "v")


@query("""
    SELECT 'release' AS of, CAST(row_number() OVER (ORDER BY CASE WHEN n_nationkey = 0 THEN -1 WHEN n_nationkey % 5 = 4 THEN 99999 ELSE n_nationkey END, CASE WHEN n_nationkey % 5 = 4 THEN 'r-other' || n_nationkey END) AS VARCHAR) AS k, CASE WHEN n_nationkey = 0 THEN 'r' WHEN n_nationkey % 5 = 4 THEN 'r-other' || n_nationkey ELSE 'r-extra' || n_nationkey END AS v FROM nation UNION ALL
    SELECT 'newest', CAST(row_number() OVER (ORDER BY o_orderdate DESC, o_orderkey) AS VARCHAR), CAST(o_orderkey AS VARCHAR) FROM orders UNION ALL
    SELECT 'joined', CAST(n_nationkey AS VARCHAR), n_regionkey || ' ' || n_name FROM nation UNION ALL
    SELECT 'dates', CAST(n_nationkey AS VARCHAR), CASE WHEN n_nationkey % 2 = 0 THEN '2024-01-01,2024-01-02' ELSE '2024-01-01,2024-01-02,2024-01-03' END FROM nation UNION ALL
    SELECT 'headed', CAST(n_nationkey AS VARCHAR), n_name FROM nation UNION ALL SELECT 'headed', '-1', 'Name' UNION ALL SELECT 'has header', '-1', 'Name' UNION ALL SELECT 'has header', CAST(n_nationkey AS VARCHAR), n_name FROM nation""")
def rarer_orders(spark, d):
    from pyspark.sql.window import Window

    nation, orders = load(spark, d, "nation"), load(spark, d, "orders")
    n = F.col("n_nationkey")
    both = lambda rows, k, v: rows.select(k.cast("string").alias("k"), v.cast("string").alias("v"))
    named = nation.select(F.when(n == 0, "r").when(n % 5 == 4, F.concat(F.lit("r-other"), n)).otherwise(F.concat(F.lit("r-extra"), n)).alias("name"))
    ordered_names = named.withColumn("at", F.row_number().over(Window.orderBy(*ordered.release_order(F.col("name")))))  # releases are few
    newest = aggregates.numbered(orders, [], [*ordered.newest_first("o_orderdate"), F.col("o_orderkey")], "at")
    one, two, three = (F.lit(f"2024-01-0{i}") for i in (1, 2, 3))
    days = ordered.date_union(F.array(two, one), F.when(n % 2 == 0, F.array(two)).otherwise(F.array(three, one)))
    cells = nation.select(n.alias("pos"), F.array("n_name").alias("cells"))
    headed = ordered.ensure_header(cells, ["Name"])
    return _tagged({
        "release": both(ordered_names, F.col("at"), F.col("name")), "newest": both(newest, F.col("at"), F.col("o_orderkey")), "joined": both(nation, n, ordered.joined_path(F.array(F.col("n_regionkey").cast("string"), F.col("n_name")))),
        "dates": both(nation, n, F.array_join(days, ",")), "headed": both(headed, F.col("pos"), F.col("cells")[0]), "has header": both(ordered.ensure_header(headed, ["Name"]), F.col("pos"), F.col("cells")[0]),
    }).select("of", "k", "v")


@query("""
    SELECT 'merged' AS of, CAST(c_custkey AS VARCHAR) AS k, CASE WHEN c_custkey % 3 <> 0 THEN '2024-01-01' ELSE '2024-02-01' END AS v FROM customer UNION ALL
    SELECT 'refused', 'rows', CAST(count(*) AS VARCHAR) || ' rows vanished' FROM customer WHERE c_custkey % 5 = 1 AND c_custkey % 3 <> 0 UNION ALL
    SELECT 'columns', 'names', 'columns differ' UNION ALL
    SELECT 'catalog', CAST(n_nationkey AS VARCHAR), CASE WHEN n_nationkey % 3 = 0 THEN '2024-01-01' WHEN n_nationkey % 3 = 1 THEN '2024-01-01,2024-01-02' ELSE '2024-01-02' END FROM nation""")
def snapshot_gates(spark, d):
    customer = load(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"))
    previous, current = customer.where("k % 3 != 0").withColumn("date", F.lit("2024-01-01")), customer.withColumn("date", F.lit("2024-02-01"))
    merged = sets.merge_snapshots(previous, current.where("k % 5 != 1 or k % 3 = 0"), "date", F.col("k") % 5 == 1).unionByName(current.where("k < 0"))
    said = {}
    for name, old, new in (("refused", previous, current.where("k % 5 != 1")), ("columns", previous, current.drop("name"))):
        try:
            sets.merge_snapshots(old, new, "date", F.lit(False))
        except ValueError as refusal:  # a gate that holds is what this query shows
            said[name] = str(refusal).split(":")[0]
    say = spark.range(1).select(F.explode(F.array(*[F.struct(F.lit(n).alias("of"), F.lit({"refused": "rows", "columns": "names"}[n]).alias("k"), F.lit(v).alias("v")) for n, v in said.items()])).alias("s")).select("s.*")
    n = F.col("key")
    nation = load(spark, d, "nation").select(F.col("n_nationkey").alias("key"))
    one, two = F.array(F.lit("2024-01-01")), F.array(F.lit("2024-01-02"))
    catalog = sets.extend_dates(nation.where("key % 3 < 2").select("key", one.alias("dates")), nation.where("key % 3 > 0").select("key", F.when(n % 3 == 1, F.concat(two, one)).otherwise(two).alias("dates")), "key")
    both = lambda rows, k, v: rows.select(F.col(k).cast("string").alias("k"), v.alias("v"))
    return _tagged({"merged": both(merged, "k", F.col("date")), "catalog": both(catalog, "key", F.array_join("dates", ","))}).unionByName(say).select("of", "k", "v")


@query("""
    SELECT * FROM (VALUES ('selected', 'b,c'), ('needed', 'a,b,c,e'), ('clash', 'a'), ('order', 'a|b,e|c'), ('both', 'either include or exclude'), ('unknown', 'unknown components'), ('cycle', 'CycleError'),
      ('packed', 'n0:r,n1:r,n2:r-extra1,n3:r-extra1,n4:r-extra2'), ('moves', 'n4>r,n3>r')) t(of, v)""")
def plans(spark, d):
    """Driver-side algebra on a handful of names."""
    needs = {"c": ["b", "e"], "b": ["a"], "e": ["a"]}
    out = {
        "selected": ",".join(sorted(selection.select_components("abc", exclude="a"))), "needed": ",".join(sorted(selection.with_dependencies("c", needs))), "clash": ",".join(sorted(selection.excluded_but_needed("c", "ad", needs))),
        "order": "|".join(",".join(w) for w in selection.run_order("abce", needs)),
    }
    for name, call in (("both", lambda: selection.select_components("ab", "a", "b")), ("unknown", lambda: selection.select_components("ab", "z")), ("cycle", lambda: selection.run_order("ab", {"a": ["b"], "b": ["a"]}))):
        try:
            call()
        except ValueError as refusal:
            out[name] = type(refusal).__name__ if name == "cycle" else str(refusal).split(":")[0]
    placed, _ = hierarchy.pack([f"n{i}" for i in range(5)], {"r": 8}, {"r": 10}, 2, "r")
    out["packed"] = ",".join(f"{n}:{b}" for n, b in placed.items())
    bins: dict[str, list[str]] = {}
    for name, target in placed.items():
        bins.setdefault(target, []).append(name)
    out["moves"] = ",".join(f"{n}>{to}" for n, _, to in hierarchy.rebalance(bins, {"r": 4, "r-extra1": 2, "r-extra2": 2}))
    return spark.createDataFrame(list(out.items()), "of string, v string")


# Registers' rarer rules


@query("""
    WITH rows AS (SELECT c_custkey AS code, c_nationkey AS parent, CASE WHEN c_custkey % 4 = 0 THEN 'N' || c_custkey - 4 * (c_custkey // 8 % 2) ELSE 'N' || c_custkey END AS name FROM customer)
    SELECT 'unknown_parent' AS kind, code FROM rows WHERE parent >= 20 UNION ALL
    SELECT 'flag_mismatch', code FROM rows WHERE parent < 20 AND code % 6 = 5 AND parent % 2 = 0 UNION ALL
    SELECT 'ok', code FROM rows WHERE parent < 20 AND NOT (code % 6 = 5 AND parent % 2 = 0)""")
def spanning_register(spark, d):
    """A code under several parents is one row for each path; agreeing columns and unknown parents are checked first."""
    k = F.col("c_custkey")
    rows = load(spark, d, "customer").select(k.alias("code"), F.col("c_nationkey").alias("parent"), F.concat(F.lit("N"), k).alias("name"), F.when(k % 6 == 5, F.lit(1)).otherwise(F.col("c_nationkey") % 2).alias("flag"))
    parent = load(spark, d, "nation").where("n_nationkey < 20").select(F.col("n_nationkey").alias("parent"), (F.col("n_nationkey") % 2).alias("up_flag"))
    good, issues, paths = validate.spanning_table(rows, "sub", "code", ["parent"], ["code"], parent, "parent", {"flag": "up_flag"}, "name", ["parent"])
    met = good.join(paths, ["code", "parent"], "left_semi")
    return issues.select("kind", F.col("key").cast("bigint").alias("code")).unionByName(met.select(F.lit("ok").alias("kind"), "code"))


_BODY = "(SELECT c_custkey AS k, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE 's' || c_nationkey END AS s, CASE WHEN c_custkey % 4 = 2 THEN 'd' || c_nationkey END AS t, CASE WHEN c_custkey % 4 = 3 THEN 'v' || c_custkey // 8 END AS v, 'b' || c_custkey % 3 AS body FROM customer)"


@query(f"""
    WITH leaf AS (SELECT k, v, body, first(body) OVER (PARTITION BY v ORDER BY k) AS f FROM {_BODY} WHERE v IS NOT NULL)
    SELECT 'no_level' AS kind, body AS key, count(*) AS n FROM {_BODY} WHERE s IS NULL AND t IS NULL AND v IS NULL GROUP BY 2 UNION ALL
    SELECT 'leaf_in_two_bodies', body, count(*) FROM leaf WHERE f <> body GROUP BY 2 UNION ALL
    SELECT 'village', body, count(*) FROM leaf WHERE f = body GROUP BY 2 UNION ALL
    SELECT CASE WHEN t IS NOT NULL THEN 'subdistrict' ELSE 'state' END, body, count(*) FROM {_BODY} WHERE v IS NULL AND (s IS NOT NULL OR t IS NOT NULL) GROUP BY 1, 2 UNION ALL
    SELECT 'unknown_code', CAST(s_nationkey AS VARCHAR), count(*) FROM supplier WHERE s_suppkey % 2 = 0 AND s_nationkey >= 15 GROUP BY 2 UNION ALL
    SELECT 'known', CAST(s_nationkey AS VARCHAR), count(*) FROM supplier WHERE s_suppkey % 2 = 0 AND s_nationkey < 15 GROUP BY 2 UNION ALL
    SELECT 'pages', CAST(l_orderkey AS VARCHAR), count(DISTINCT l_linenumber) FROM lineitem GROUP BY l_orderkey HAVING count(DISTINCT l_linenumber) <> l_orderkey % 5 UNION ALL
    SELECT 'pages', CAST(o_orderkey AS VARCHAR), 0 FROM orders WHERE o_orderkey % 5 > 0 AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""")
def body_rules(spark, d):
    k = F.col("c_custkey")
    rows = load(spark, d, "customer").select(
        k.alias("k"), F.when(k % 4 != 0, F.concat(F.lit("s"), "c_nationkey")).alias("s"), F.when(k % 4 == 2, F.concat(F.lit("d"), "c_nationkey")).alias("t"), F.when(k % 4 == 3, F.concat(F.lit("v"), F.floor(k / 8))).alias("v"), F.concat(F.lit("b"), k % 3).alias("body"),
    )
    good, bad = validate.attach_deepest(rows, "ulb", "body", {"state": "s", "subdistrict": "t", "village": "v"}, "village", ["k"])
    known, unknown = validate.must_exist(load(spark, d, "supplier").select("s_suppkey", "s_nationkey"), "bodies", "s_nationkey", load(spark, d, "nation").where("n_nationkey < 15").select(F.col("n_nationkey").alias("s_nationkey")), F.col("s_suppkey") % 2 == 0)
    pages = load(spark, d, "lineitem").select(F.col("l_orderkey").alias("doc"), F.col("l_linenumber").alias("page"))
    ids = load(spark, d, "orders").select(F.col("o_orderkey").alias("doc")).unionByName(pages.select("doc")).distinct()
    gate = validate.expected_counts(pages, "doc", ids.withColumn("pages", F.col("doc") % 5))
    count = lambda rows, kind, key: rows.groupBy(kind.alias("kind"), key.cast("string").alias("key")).agg(F.count(F.lit(1)).alias("n"))
    return (
        count(bad, F.col("kind"), F.col("key")).unionByName(count(good, F.col("level"), F.col("body"))).unionByName(count(unknown, F.col("kind"), F.col("key")))
        .unionByName(count(known, F.lit("known"), F.col("s_nationkey"))).unionByName(gate.select(F.lit("pages").alias("kind"), F.col("doc").cast("string").alias("key"), big("found").alias("n")))
    )


@query("""
    SELECT CASE WHEN c_custkey % 3 = 0 THEN 'region' ELSE 'nation' END AS level, CASE WHEN c_custkey % 3 = 0 THEN CAST(n_regionkey AS VARCHAR) ELSE CAST(n_nationkey AS VARCHAR) END AS id FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2""")
def done_ledger(spark, d):
    met = load(spark, d, "customer").join(load(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return hierarchy.done_ids(met.select(F.col("n_regionkey").alias("region"), F.when(F.col("c_custkey") % 3 != 0, F.col("n_nationkey")).alias("nation")), {"region": "region", "nation": "nation"})


@query("""
    SELECT 'member_repeat' AS kind, count(*) AS n FROM customer WHERE c_custkey % 10 = 1 UNION ALL SELECT 'unknown_member', count(*) FROM customer WHERE c_nationkey >= 22 UNION ALL
    SELECT 'no_group', count(*) FROM customer WHERE c_nationkey < 22 AND c_custkey % 8 = 0 UNION ALL SELECT 'unknown_group', count(*) FROM customer WHERE c_nationkey < 22 AND c_custkey % 8 = 1 UNION ALL
    SELECT 'group_path_mismatch', count(*) FROM customer WHERE c_nationkey < 22 AND c_custkey % 8 > 1 AND c_custkey % 3 = 2 AND c_nationkey % 2 = 1 UNION ALL
    SELECT 'ok', count(*) FROM customer WHERE c_nationkey < 22 AND c_custkey % 8 > 1 AND NOT (c_custkey % 3 = 2 AND c_nationkey % 2 = 1)""")
def group_mapping(spark, d):
    """Members mapped to groups that have one or two paths: path 0 and, of group g1, path 1 too."""
    k = F.col("c_custkey")
    rows = load(spark, d, "customer").select(k.cast("string").alias("m"), F.when(k % 8 == 0, "").when(k % 8 == 1, "g9").when(k % 3 == 2, "g0").otherwise("g1").alias("g"), (F.col("c_nationkey") % 2).alias("path"), F.col("c_nationkey").alias("n"), k.alias("pos"), F.lit(0).alias("again"))
    every = rows.unionByName(rows.where("pos % 10 = 1").withColumn("again", F.lit(1)))
    members = rows.where("n < 22").select("m", "n")
    groups = spark.createDataFrame([("g0", 0), ("g1", 0), ("g1", 1)], "g string, path int")
    good, issues = validate.member_mapping(every, "map", "m", members, ["n"], ["pos", "again"], group="g", group_paths=groups, group_path=["path"], body="g")
    found = issues.select("kind").unionByName(good.select(F.lit("ok").alias("kind")))
    return found.groupBy("kind").agg(F.count(F.lit(1)).alias("n"))
