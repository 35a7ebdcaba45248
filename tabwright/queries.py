"""Queries of the library's operators over the driver's tables, each with its SQL for DuckDB where SQL can say it."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabwright.functions import arrays, dates, distance, numbers, text
from tabwright.operators import aggregates, columns, filters, hierarchy, joins, ordered, reconcile, sets, validate
from tabwright.registry import ORACLES, QUERIES, Query, big, load, query
from tabwright.sources import documents, tables
from tabwright.streaming import incremental

#: A total order of lineitem rows; rows alike in all of it are alike.
LINE_ORDER = ("l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus")
LINE_SQL = ", ".join(LINE_ORDER)
CUT = "1996-01-01"


# Joins and validation


@query("""
    SELECT CASE WHEN o_orderkey IS NULL THEN 'parent_missing' WHEN l_shipdate < o_orderdate THEN 'ship_before_order' ELSE 'ok' END AS issue_kind, count(*) AS n
    FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""")
def verified_join_issues(spark, d):
    orders = load(spark, d, "orders").select("o_orderkey", "o_orderdate")
    met = joins.verified(load(spark, d, "lineitem").select("l_orderkey", "l_shipdate"), orders, F.col("l_orderkey") == F.col("o_orderkey"), F.col("o_orderkey").isNull(), {"ship_before_order": F.col("l_shipdate") < F.col("o_orderdate")})
    return reconcile.rollup(met.select(F.col("issue_kind").alias("kind"))).withColumnRenamed("kind", "issue_kind")


@query("""
    SELECT CAST(c_custkey AS VARCHAR) AS code, r_regionkey || '/' || n_nationkey || '/' || c_custkey AS path
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def hierarchy_path(spark, d):
    made = hierarchy.paths([(load(spark, d, "region"), "r_regionkey", None), (load(spark, d, "nation"), "n_nationkey", "n_regionkey"), (load(spark, d, "customer"), "c_custkey", "c_nationkey")])
    return made.where("level = 2").select("code", F.array_join("path", "/").alias("path"))


@query("""
    SELECT 'child' AS side, count(*) AS n FROM (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F'))
    UNION ALL SELECT 'parent', count(*) FROM (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F' AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem))""")
def orphan_children(spark, d):
    parents = load(spark, d, "orders").where("o_orderstatus <> 'F'").select(F.col("o_orderkey").alias("k"))
    children = load(spark, d, "lineitem").select(F.col("l_orderkey").alias("k"))
    a, b = joins.missing_both_ways(children, parents, ["k"])
    return a.agg(F.lit("child").alias("side"), F.count(F.lit(1)).alias("n")).select("side", "n").unionByName(b.agg(F.lit("parent").alias("side"), F.count(F.lit(1)).alias("n")).select("side", "n"))


@query("""
    SELECT c_custkey, CASE WHEN n.n_nationkey IS NULL THEN 'unknown_parent' ELSE 'found' END AS routed
    FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_regionkey < 3) n ON c_nationkey = n.n_nationkey""")
def routed_children(spark, d):
    nations = load(spark, d, "nation").where("n_regionkey < 3").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    good, bad = joins.to_parent(load(spark, d, "customer"), nations, ["c_nationkey"])
    return good.select("c_custkey", F.lit("found").alias("routed")).unionByName(bad.select("c_custkey", F.lit("unknown_parent").alias("routed")))


@query("SELECT s_suppkey, s_name FROM supplier WHERE s_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1)")
def semi_join_members(spark, d):
    listed = load(spark, d, "nation").where("n_regionkey = 1").select(F.col("n_nationkey").alias("s_nationkey"))
    return joins.members(load(spark, d, "supplier"), listed, ["s_nationkey"]).select("s_suppkey", "s_name")


@query("""
    SELECT n_nationkey AS nation, CASE WHEN s.k IS NULL THEN 'no_supplier' WHEN c.k IS NULL THEN 'no_customer' ELSE 'both' END AS status
    FROM nation LEFT JOIN (SELECT DISTINCT s_nationkey AS k FROM supplier WHERE s_acctbal > 0) s ON s.k = n_nationkey
    LEFT JOIN (SELECT DISTINCT c_nationkey AS k FROM customer WHERE c_acctbal < 0) c ON c.k = n_nationkey WHERE s.k IS NOT NULL OR c.k IS NOT NULL""")
def reconcile_codes(spark, d):
    a = load(spark, d, "supplier").where("s_acctbal > 0").select(F.col("s_nationkey").alias("nation")).distinct()
    b = load(spark, d, "customer").where("c_acctbal < 0").select(F.col("c_nationkey").alias("nation")).distinct()
    names = {"matched": "both", "unknown": "no_customer", "missing": "no_supplier"}
    return joins.reconciled(a, b, "nation").replace(names, subset=["status"]).select("nation", "status")


@query("""
    SELECT l_suppkey, count(*) AS n_parts, string_agg(l_partkey, ',' ORDER BY l_partkey) AS parts
    FROM (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem WHERE l_quantity > 45) GROUP BY 1""")
def bridge_lists(spark, d):
    pairs = load(spark, d, "lineitem").where("l_quantity > 45").select("l_suppkey", "l_partkey")
    listed, _ = joins.bridge(pairs, "l_suppkey", "l_partkey")
    return listed.select("l_suppkey", big(F.size("l_partkeys")).alias("n_parts"), F.array_join(F.transform("l_partkeys", lambda x: x.cast("string")), ",").alias("parts"))


@query("""
    WITH p AS (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem WHERE l_quantity > 49 AND l_discount > 0.08)
    SELECT l_suppkey, l_partkey FROM p WHERE l_suppkey IN (SELECT l_suppkey FROM p GROUP BY 1 HAVING count(*) = 1) AND l_partkey IN (SELECT l_partkey FROM p GROUP BY 1 HAVING count(*) = 1)""")
def one_to_one_pairs(spark, d):
    return joins.one_to_one(load(spark, d, "lineitem").where("l_quantity > 49 and l_discount > 0.08"), "l_suppkey", "l_partkey")


@query("""
    SELECT r_regionkey, coalesce(list_aggregate(list_sort(list_filter(c, lambda x: NOT list_contains(s, x))), 'string_agg', ','), '') AS missing, coalesce(list_aggregate(list_sort(list_filter(s, lambda x: NOT list_contains(c, x))), 'string_agg', ','), '') AS extra
    FROM (SELECT n_regionkey AS r_regionkey, list(DISTINCT n_name) AS c FROM nation JOIN customer ON c_nationkey = n_nationkey WHERE c_acctbal > 9000 GROUP BY 1) a
    JOIN (SELECT n_regionkey AS k, list(DISTINCT n_name) AS s FROM nation JOIN supplier ON s_nationkey = n_nationkey WHERE s_acctbal > 2000 GROUP BY 1) b ON k = r_regionkey
    WHERE list_sort(c) <> list_sort(s)""")
def array_set_compare(spark, d):
    nation = load(spark, d, "nation").select("n_nationkey", "n_name", F.col("n_regionkey").alias("r_regionkey"))
    a = nation.join(load(spark, d, "customer").where("c_acctbal > 9000"), F.col("c_nationkey") == F.col("n_nationkey"))
    b = nation.join(load(spark, d, "supplier").where("s_acctbal > 2000"), F.col("s_nationkey") == F.col("n_nationkey"))
    found = joins.sets_compared(a.select("r_regionkey", "n_name"), b.select("r_regionkey", "n_name"), "r_regionkey", "n_name")
    both = a.select("r_regionkey").distinct().join(b.select("r_regionkey").distinct(), "r_regionkey")
    return found.join(both, "r_regionkey").select("r_regionkey", F.array_join("missing", ",").alias("missing"), F.array_join("extra", ",").alias("extra"))


@query("SELECT p_partkey, CASE WHEN n_name IS NULL THEN 'NA' ELSE n_name END AS n_name FROM part LEFT JOIN nation ON p_size = n_nationkey")
def dimension_default(spark, d):
    nation = load(spark, d, "nation").select(F.col("n_nationkey").alias("p_size"), "n_name")
    return joins.lookup(load(spark, d, "part").select("p_partkey", "p_size"), nation, "p_size", "n_name", "NA").select("p_partkey", "n_name")


@query("""
    SELECT a.n, a.n_name AS s0_name, b.n_name AS s1_name FROM (SELECT row_number() OVER (ORDER BY n_nationkey) AS n, n_name FROM nation WHERE n_regionkey = 0) a
    JOIN (SELECT row_number() OVER (ORDER BY n_nationkey) AS n, n_name FROM nation WHERE n_regionkey = 1) b ON a.n = b.n""")
def zip_sections(spark, d):
    rows = load(spark, d, "nation").where("n_regionkey < 2").select(F.col("n_regionkey").cast("string").alias("s"), "n_nationkey", F.col("n_name").alias("name"))
    return joins.zipped(rows, "s", "n_nationkey", ["name"]).select(big("n").alias("n"), F.col("0_name").alias("s0_name"), F.col("1_name").alias("s1_name"))


@query("""
    SELECT n.n_nationkey AS node, coalesce(m.super, n.n_regionkey + 100) AS top FROM nation n LEFT JOIN (SELECT 100 + r_regionkey AS id, 1000 + r_regionkey % 2 AS super FROM region WHERE r_regionkey < 3) m ON m.id = n.n_regionkey + 100""")
def two_hop_parent(spark, d):
    middles = load(spark, d, "region").where("r_regionkey < 3").select((F.col("r_regionkey") + 100).alias("id"), (F.lit(1000) + F.col("r_regionkey") % 2).alias("super"))
    rows = load(spark, d, "nation").select(F.col("n_nationkey").alias("node"), (F.col("n_regionkey") + 100).alias("parent"))
    return joins.via_middle(rows, middles, "parent", "top").select("node", "top")


_ACCEPTED = """
    WITH o AS (SELECT c_custkey AS code, c_name AS name, c_nationkey AS up, c_mktsegment AS seg FROM customer),
    j AS (SELECT o.*, n_regionkey FROM o LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 4) n ON up = n_nationkey),
    k AS (SELECT *, row_number() OVER (PARTITION BY up, seg ORDER BY code) AS nth FROM j WHERE n_regionkey IS NOT NULL)
"""


@query(_ACCEPTED + """
    SELECT 'accepted' AS kind, count(*) AS n FROM k WHERE nth = 1 HAVING count(*) > 0 UNION ALL SELECT 'unknown_parent', count(*) FROM j WHERE n_regionkey IS NULL HAVING count(*) > 0
    UNION ALL SELECT 'name_repeat', count(*) FROM k WHERE nth > 1 HAVING count(*) > 0""")
def register_validation(spark, d):
    children = load(spark, d, "customer").select(F.col("c_custkey").alias("code"), F.col("c_mktsegment").alias("seg"), F.col("c_nationkey").alias("up"))
    parents = load(spark, d, "nation").where("n_regionkey <> 4").select(F.col("n_nationkey").alias("up"))
    good, bad = validate.child_table(children, "customer", "code", ["code"], parents, "up", name="seg", name_within=["up"])
    return reconcile.rollup(bad.select("kind").unionByName(good.select(F.lit("accepted").alias("kind"))))


@query(f"""
    SELECT kind, count(*) AS n FROM (
      SELECT CASE WHEN nth > 1 THEN 'member_repeat' WHEN p_partkey IS NULL THEN 'unknown_member' WHEN p_size <> l_linenumber THEN 'path_mismatch' ELSE 'accepted' END AS kind
      FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey, l_linenumber, {LINE_SQL}) AS nth FROM lineitem) LEFT JOIN (SELECT * FROM part WHERE p_size < 40) ON l_partkey = p_partkey) GROUP BY 1""")
def mapping_validation(spark, d):
    rows = load(spark, d, "lineitem").withColumn("member", F.col("l_partkey")).withColumn("place", F.col("l_linenumber"))
    members = load(spark, d, "part").where("p_size < 40").select(F.col("p_partkey").alias("member"), F.col("p_size").alias("place"))
    good, bad = validate.member_mapping(rows, "line", "member", members, ["place"], ["l_orderkey", "l_linenumber", *LINE_ORDER])
    return reconcile.rollup(bad.select("kind").unionByName(good.select(F.lit("accepted").alias("kind"))))


@query("""
    SELECT kind, count(*) AS n FROM (SELECT 'not_covered' AS kind FROM (SELECT c_custkey AS k FROM customer WHERE c_acctbal > 0 EXCEPT SELECT o_custkey FROM orders WHERE o_totalprice > 200000)
    UNION ALL SELECT 'not_expected' FROM (SELECT o_custkey AS k FROM orders WHERE o_totalprice > 200000 EXCEPT SELECT c_custkey FROM customer WHERE c_acctbal > 0)) GROUP BY 1""")
def coverage_issues(spark, d):
    a = load(spark, d, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("k"))
    b = load(spark, d, "orders").where("o_totalprice > 200000").select(F.col("o_custkey").alias("k"))
    return reconcile.rollup(validate.coverage(a, b, "k", "customer"))


@query("""
    SELECT p_partkey, list_aggregate(list_filter([CASE WHEN p_size = 1 THEN 'col 1 is empty' END, CASE WHEN p_brand = 'Brand#11' THEN 'col 2 is empty' END], lambda x: x IS NOT NULL), 'string_agg', ';') AS messages
    FROM part WHERE p_size = 1 OR p_brand = 'Brand#11'""")
def row_validation(spark, d):
    cells = F.array(F.col("p_name"), F.when(F.col("p_size") == 1, "").otherwise(F.col("p_size").cast("string")), F.when(F.col("p_brand") == "Brand#11", "").otherwise(F.col("p_brand")))
    rows = load(spark, d, "part").select("p_partkey", validate.required_cells(cells, [0, 1, 2]).alias("m"))
    return rows.where("size(m) > 0").select("p_partkey", F.array_join("m", ";").alias("messages"))


@query("""
    SELECT kind, count(*) AS n FROM (
      SELECT 'neither' AS kind FROM part WHERE (p_size < 25) <> (p_retailprice < 1200) UNION ALL
      SELECT 'needed' FROM part WHERE p_retailprice < 1200 AND p_size >= 25) GROUP BY 1""")
def group_validation(spark, d):
    cells = F.array(F.lit("a"), F.when(F.col("p_size") < 25, "x").otherwise(""), F.when(F.col("p_retailprice") < 1200, "y").otherwise(""))
    part = load(spark, d, "part").select(validate.all_or_none(cells, [1, 2]).alias("a"), validate.required_if_any(cells, [1], 2).alias("b"))
    rows = part.where("size(a) > 0").select(F.lit("neither").alias("kind")).unionByName(part.where("size(b) > 0").select(F.lit("needed").alias("kind")))
    return reconcile.rollup(rows)


@query("SELECT count(*) AS n, CASE WHEN p_size > 40 THEN 'size' WHEN p_brand = 'Brand#11' THEN 'brand' ELSE 'name' END AS level FROM part GROUP BY 2")
def level_pick(spark, d):
    part = load(spark, d, "part").select(F.col("p_name").alias("name"), F.when(F.col("p_brand") == "Brand#11", F.col("p_brand")).alias("brand"), F.when(F.col("p_size") > 40, F.col("p_size").cast("string")).alias("size"))
    return aggregates.counts(part.select(validate.deepest({"name": "name", "brand": "brand", "size": "size"})["level"].alias("level")), ["level"])


@query("""
    SELECT kind, count(*) AS n FROM (SELECT 'below_zero' AS kind FROM customer WHERE c_acctbal < 0 UNION ALL SELECT 'below_zero' FROM supplier WHERE s_acctbal < 0 UNION ALL SELECT 'no_orders' FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)) GROUP BY 1""")
def distinct_issue_rollup(spark, d):
    customer, supplier, orders = (load(spark, d, t) for t in ("customer", "supplier", "orders"))
    row = lambda key: F.struct(F.col(key).alias("key"))
    make = lambda rows, kind, key: validate.issues(rows, F.lit(kind), "t", F.col(key).cast("string"), F.lit(kind), row(key))
    parts = [make(customer.where("c_acctbal < 0"), "below_zero", "c_custkey"), make(supplier.where("s_acctbal < 0"), "below_zero", "s_suppkey"), make(customer.join(orders, F.col("c_custkey") == F.col("o_custkey"), "left_anti"), "no_orders", "c_custkey")]
    return reconcile.rollup(sets.union_all(parts))


# Aggregations


@query(f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LINE_SQL}) AS nth FROM lineitem) WHERE nth = 1")
def dup_key_first(spark, d):
    rows = load(spark, d, "lineitem")
    return aggregates.keep_first(rows, ["l_orderkey", "l_linenumber"], LINE_ORDER).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query(f"""
    SELECT l_orderkey, l_linenumber, l_partkey, prev_l_partkey FROM (SELECT *, row_number() OVER w AS nth, first_value(l_partkey) OVER w AS prev_l_partkey
    FROM lineitem WINDOW w AS (PARTITION BY l_orderkey, l_linenumber ORDER BY {LINE_SQL})) WHERE nth > 1""")
def dup_key_issues(spark, d):
    _, later = aggregates.first_and_repeats(load(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], LINE_ORDER, ["l_partkey"])
    return later.select("l_orderkey", "l_linenumber", "l_partkey", "prev_l_partkey")


@query("SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS nth FROM events) WHERE nth = 1")
def keep_last(spark, d):
    return tables.keep_last(load(spark, d, "events"), ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "event_type")


@query("SELECT user_id, event_type, min(ts) AS ts FROM events GROUP BY 1, 2")
def first_seen(spark, d):
    return aggregates.first_seen(load(spark, d, "events").select("user_id", "event_type", "ts"), "ts")


@query("SELECT n_regionkey, string_agg(n_name, ',' ORDER BY n_nationkey) AS names FROM nation GROUP BY 1")
def grouped_list(spark, d):
    return aggregates.grouped_list(load(spark, d, "nation"), ["n_regionkey"], "n_name", "n_nationkey").select("n_regionkey", F.array_join("values", ",").alias("names"))


@query("SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1")
def group_counts(spark, d):
    return aggregates.counts(load(spark, d, "orders"), ["o_orderpriority"])


@query("SELECT user_id, event_type AS name FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_type DESC) AS nth FROM events) WHERE nth = 1")
def latest_by_prefix(spark, d):
    return aggregates.latest(load(spark, d, "events").withColumnRenamed("event_type", "name"), ["user_id"], "name", F.col("ts"))


@query("SELECT o_custkey, min(o_orderdate) AS first, max(o_orderdate) AS last FROM orders GROUP BY 1")
def date_bounds(spark, d):
    return aggregates.bounds(load(spark, d, "orders"), ["o_custkey"], "o_orderdate")


_TYPES = ("click", "login", "purchase", "search", "view")


@query("SELECT user_id, " + ", ".join(f"arg_min(value, event_id) FILTER (event_type = '{t}') AS {t}" for t in _TYPES) + " FROM events GROUP BY 1")
def kv_pivot(spark, d):
    return aggregates.key_value_pivot(load(spark, d, "events"), "user_id", "event_type", "value", "event_id", _TYPES)


@query("SELECT c_nationkey, bool_and(c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 100000)) AS complete FROM customer GROUP BY 1")
def completeness(spark, d):
    expected = load(spark, d, "customer").select("c_nationkey", "c_custkey")
    done = expected.join(load(spark, d, "orders").where("o_totalprice > 100000"), F.col("c_custkey") == F.col("o_custkey"), "left_semi")
    return aggregates.complete(expected, done, "c_nationkey", "c_custkey")


@query("""
    SELECT n_regionkey, CASE WHEN bool_and(p) THEN 'COMPLETE' ELSE 'INCOMPLETE' END AS status, count(*) FILTER (p) AS present
    FROM (SELECT n_regionkey, n_nationkey IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 1000) AS p FROM nation) GROUP BY 1""")
def component_status(spark, d):
    expected = load(spark, d, "nation").select("n_regionkey", "n_nationkey")
    present = expected.join(load(spark, d, "supplier").where("s_acctbal > 1000"), F.col("s_nationkey") == F.col("n_nationkey"), "left_semi")
    made = aggregates.status(expected, present, "n_regionkey", "n_nationkey")
    return made.select("n_regionkey", "status", big(F.size(F.filter(F.map_values("children"), lambda v: v == "COMPLETE"))).alias("present"))


@query("SELECT CAST(year(ts) AS INT) AS y, CAST(month(ts) AS INT) AS m, CAST(day(ts) AS INT) AS d, string_agg(event_id, ',' ORDER BY event_id) AS files FROM events WHERE event_type = 'purchase' GROUP BY 1, 2, 3")
def day_listing(spark, d):
    made = aggregates.by_day(load(spark, d, "events").where("event_type = 'purchase'"), "ts", "event_id")
    return made.select("y", "m", "d", F.array_join(F.transform("files", lambda f: f.cast("string")), ",").alias("files"))


@query("SELECT DISTINCT text FROM documents")
def text_dedupe(spark, d):
    return aggregates.distinct_rows(load(spark, d, "documents").select("text"))


@query("SELECT n_regionkey, count(*) AS n, min(n_name) AS first FROM nation GROUP BY 1")
def nested_maps(spark, d):
    made = aggregates.nested(load(spark, d, "nation"), "n_regionkey", "n_nationkey", "n_name")
    return made.select("n_regionkey", big(F.size("children")).alias("n"), F.array_min(F.map_values("children")).alias("first"))


# Ordered rows


@query("""
    SELECT event_id, last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS value FROM events""")
def forward_fill(spark, d):
    rows = load(spark, d, "events").withColumn("value", F.when(F.col("event_type") == "purchase", F.col("value")))
    return ordered.forward_fill(rows, "value", ["user_id"], ["ts", "event_id"]).select("event_id", "value")


@query("""
    SELECT event_id, CAST(sum(c) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS run
    FROM (SELECT *, CASE WHEN event_type IS DISTINCT FROM lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) THEN 1 ELSE 0 END AS c FROM events)""")
def run_sections(spark, d):
    return ordered.runs(load(spark, d, "events"), "event_type", ["user_id"], ["ts", "event_id"]).select("event_id", big("run").alias("run"))


@query("""
    SELECT event_id, CAST(sum(CASE WHEN event_type = 'login' THEN 1 ELSE 0 END) OVER w AS BIGINT) AS section, last_value(CASE WHEN event_type = 'login' THEN event_id END IGNORE NULLS) OVER w AS section_width
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)""")
def header_sections(spark, d):
    made = ordered.sections(load(spark, d, "events"), F.col("event_type") == "login", ["user_id"], ["ts", "event_id"], F.col("event_id"))
    return made.select("event_id", big("section").alias("section"), "section_width")


@query("""
    SELECT event_id, first_value(value) OVER (PARTITION BY user_id, run ORDER BY ts, event_id) AS value FROM (
      SELECT *, sum(c) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS run
      FROM (SELECT *, CASE WHEN event_type IS DISTINCT FROM lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) THEN 1 ELSE 0 END AS c FROM events))""")
def carry_forward(spark, d):
    return ordered.carried(load(spark, d, "events"), "event_type", ["value"], ["user_id"], ["ts", "event_id"]).select("event_id", "value")


@query("""
    SELECT event_id FROM (SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS a, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS z FROM events) WHERE a > 2 AND z > 3""")
def drop_ends(spark, d):
    return ordered.without_ends(load(spark, d, "events"), ["user_id"], ["ts", "event_id"], 2, 3).select("event_id")


@query("""
    SELECT event_id FROM (SELECT event_id, event_type, row_number() OVER w AS nth, first_value(event_type) OVER w AS f FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) WHERE nth = 1 OR event_type <> f""")
def same_as_first(spark, d):
    return ordered.drop_same_as_first(load(spark, d, "events"), ["user_id"], "event_type", ["ts", "event_id"]).select("event_id")


@query("SELECT n_nationkey FROM (SELECT n_nationkey, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS nth, n_regionkey = min(n_regionkey) OVER () AS f FROM nation) WHERE f OR nth > 1")
def single_header(spark, d):
    return ordered.single_header(load(spark, d, "nation"), "n_regionkey", "n_nationkey").select("n_nationkey")


# Sets and snapshots

_OLD, _NEW = f"(SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderdate < TIMESTAMP '{CUT}' OR o_orderkey % 5 = 0)", f"(SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '{CUT}' OR o_orderkey % 7 = 0)"


def _snapshots(spark, d):
    orders = load(spark, d, "orders")
    pick = lambda condition: orders.where(condition).select("o_orderkey", "o_custkey", "o_totalprice")
    old, new = pick(f"o_orderdate < timestamp_ntz '{CUT}' or o_orderkey % 5 = 0"), pick(f"o_orderdate >= timestamp_ntz '{CUT}' or o_orderkey % 7 = 0")
    return old, new


def _repeated(spark, d):
    """Snapshots in which some rows stand twice or three times."""
    old, new = _snapshots(spark, d)
    return old.unionByName(old.where("o_orderkey % 11 = 0")), new.unionByName(new.where("o_orderkey % 3 = 0")).unionByName(new.where("o_orderkey % 3 = 0"))


@query(f"SELECT * FROM {_NEW} EXCEPT SELECT * FROM {_OLD}")
def snapshot_diff_added(spark, d):
    return sets.added_removed(*_repeated(spark, d))[0]


@query(f"SELECT * FROM {_OLD} EXCEPT SELECT * FROM {_NEW}")
def snapshot_diff_removed(spark, d):
    return sets.added_removed(*_repeated(spark, d))[1]


@query(f"SELECT * FROM {_OLD} UNION ALL SELECT * FROM {_NEW} n WHERE o_orderkey NOT IN (SELECT o_orderkey FROM {_OLD})")
def first_wins_merge(spark, d):
    return sets.first_wins(*_snapshots(spark, d), ["o_orderkey"])


@query(f"SELECT o_orderkey, 'added' AS change FROM (SELECT o_orderkey FROM {_NEW} EXCEPT SELECT o_orderkey FROM {_OLD}) UNION ALL SELECT o_orderkey, 'removed' FROM (SELECT o_orderkey FROM {_OLD} EXCEPT SELECT o_orderkey FROM {_NEW})")
def change_report(spark, d):
    return sets.changes(*_snapshots(spark, d), ["o_orderkey"])


@query("SELECT a.path AS path, 'change' AS kind, a.v AS old, b.v AS new FROM (SELECT o_orderkey AS path, o_totalprice AS v FROM orders WHERE o_orderkey % 3 <> 0) a JOIN (SELECT o_orderkey AS path, o_totalprice * (1 + o_orderkey % 2) AS v FROM orders WHERE o_orderkey % 4 <> 0) b ON a.path = b.path AND a.v <> b.v UNION ALL SELECT o_orderkey, 'add', NULL, o_totalprice * (1 + o_orderkey % 2) FROM orders WHERE o_orderkey % 3 = 0 AND o_orderkey % 4 <> 0 UNION ALL SELECT o_orderkey, 'remove', o_totalprice, NULL FROM orders WHERE o_orderkey % 3 <> 0 AND o_orderkey % 4 = 0")
def path_diff(spark, d):
    orders = load(spark, d, "orders")
    a = orders.where("o_orderkey % 3 <> 0").select(F.col("o_orderkey").alias("path"), F.col("o_totalprice").alias("value"))
    b = orders.where("o_orderkey % 4 <> 0").select(F.col("o_orderkey").alias("path"), (F.col("o_totalprice") * (1 + F.col("o_orderkey") % 2)).alias("value"))
    return sets.path_diff(a, b)


@query("SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag AS flag, n_name FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey")
def union_enrich(spark, d):
    nations = load(spark, d, "supplier").join(load(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_suppkey").alias("l_suppkey"), "n_name")
    lines = load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_suppkey", "l_returnflag")
    parts = [columns.enrich(lines.where(F.col("l_returnflag") == flag).drop("l_returnflag"), {"flag": f" {flag} "}) for flag in ("A", "N", "R")]
    return columns.enrich_from_parent(sets.union_all(parts), nations, "l_suppkey", {"n_name": "n_name"}).drop("l_suppkey")


@query("SELECT o_custkey FROM orders WHERE o_totalprice > 300000 INTERSECT SELECT c_custkey FROM customer WHERE c_acctbal < 0")
def intersection(spark, d):
    return sets.common(load(spark, d, "orders").where("o_totalprice > 300000").select("o_custkey"), load(spark, d, "customer").where("c_acctbal < 0").select("c_custkey"))


@query("""
    SELECT c_custkey, CASE WHEN c_custkey % 10 = 2 THEN 'patched' ELSE c_name END AS c_name FROM customer WHERE c_custkey % 10 <> 1 UNION ALL SELECT -1, 'added'""")
def corrections(spark, d):
    rows = load(spark, d, "customer").select("c_custkey", "c_name")
    edits = rows.where("c_custkey % 10 = 2").select("c_custkey", F.create_map(F.lit("c_name"), F.lit("patched")).alias("changes"))
    added = spark.range(1).select(F.lit(-1).cast("bigint").alias("c_custkey"), F.lit("added").alias("c_name"))
    return columns.correct(rows, edits, rows.where("c_custkey % 10 = 1"), added, "c_custkey")


# Scalars


@query("SELECT p_partkey, replace(trim(regexp_replace(CASE WHEN starts_with(upper(p_name), 'A') THEN substr(upper(p_name), 2) ELSE upper(p_name) END, '\\s+', ' ', 'g')), '-', ' ') AS name, regexp_replace(p_brand, '[^0-9]', '', 'g') AS number FROM part")
def canon_name(spark, d):
    return load(spark, d, "part").select("p_partkey", text.clean_name(F.col("p_name"), ["A"]).alias("name"), text.digits(F.col("p_brand")).alias("number"))


@query("""
    SELECT s_suppkey, n_name, d AS distance FROM (SELECT s_suppkey, n_name, d, row_number() OVER (PARTITION BY s_suppkey ORDER BY d, n_name) AS nth
    FROM (SELECT s_suppkey, n_name, CAST(levenshtein(n_name, upper(s_name)) AS BIGINT) AS d FROM supplier, nation)) WHERE nth = 1""")
def lev_best_match(spark, d):
    names = load(spark, d, "nation").agg(F.array_sort(F.collect_list("n_name")).alias("hay"))
    rows = load(spark, d, "supplier").crossJoin(F.broadcast(names))  # one row: the array of nation names
    best = distance.closest_of(F.col("hay"), F.upper("s_name"))
    return rows.select("s_suppkey", best["name"].alias("n_name"), big(best["distance"]).alias("distance"))


@query()
def masala_match(spark, d):
    """Weighted distances within blocks of part names that begin with the same two letters (the rule of this query alone;
    joins.closest_name compares whatever names it is given); each distinct pair is computed once."""
    names = load(spark, d, "part").select(F.upper("p_name").alias("name")).distinct()
    pairs = names.withColumn("k", F.substring("name", 1, 2)).alias("a").join(names.withColumn("k", F.substring("name", 1, 2)).alias("b"), "k").select(F.col("a.name").alias("one"), F.col("b.name").alias("two"))
    return pairs.select("one", "two", F.round(distance.distance(F.col("one"), F.col("two")), 6).alias("distance"))


@query("""
    SELECT o_orderkey, strftime(o_orderdate, '%d%b%Y') AS compact, strftime(o_orderdate, '%d/%m/%Y') AS slashed, strftime(o_orderdate, '+%Y-%m-%dT00:00:00Z/11') AS inception,
    strftime(date_trunc('month', o_orderdate) - INTERVAL 2 MONTH, '%b%Y') AS back, CAST(o_orderdate AS DATE) AS day FROM orders""")
def date_formats(spark, d):
    day = F.col("o_orderdate").cast("date")
    compact = dates.show(day, dates.COMPACT)
    return load(spark, d, "orders").select("o_orderkey", compact.alias("compact"), dates.reformat(compact, dates.COMPACT, dates.SLASHED).alias("slashed"), dates.inception(day).alias("inception"), dates.months_back(day, 2).alias("back"), dates.parse(compact, dates.COMPACT).alias("day"))


@query("SELECT event_id, CAST(props ->> '$.k' AS BIGINT) AS k FROM events")
def json_prop(spark, d):
    return load(spark, d, "events").select("event_id", numbers.integer(F.get_json_object("props", "$.k")).alias("k"))


@query("""
    SELECT doc_id, greatest(1, least(128, n_chars // 50)) AS chunk, CAST(round(n_chars / 1024.0, 2) AS DOUBLE) AS kb, least(5, greatest(2, n_chars % 9)) AS clamped FROM documents""")
def number_functions(spark, d):
    return load(spark, d, "documents").select("doc_id", big(numbers.chunk_size(F.col("n_chars"), 50)).alias("chunk"), F.round(F.col("n_chars") / 1024.0, 2).alias("kb"), numbers.clamp(F.col("n_chars") % 9, 2, 5).alias("clamped"))


@query("""
    SELECT page_id, regexp_replace(regexp_extract(url, '[^/]*$'), '[?#].*$', '') AS tail, split_part(url, '/', 3) AS host FROM pages""")
def text_functions(spark, d):
    tail = F.regexp_replace(text.after_last(F.col("url"), "/", " "), "[?#].*$", "")
    return load(spark, d, "pages").select("page_id", tail.alias("tail"), text.field(F.col("url"), "/", 2).alias("host"))


@query("SELECT event_id, list_aggregate(list_slice(list_concat([event_type, CAST(user_id AS VARCHAR)], ['', '', '']), 1, 4), 'string_agg', '|') AS cells FROM events")
def fixed_width(spark, d):
    cells = arrays.to_width(F.array("event_type", F.col("user_id").cast("string")), 4)
    return load(spark, d, "events").select("event_id", F.array_join(cells, "|").alias("cells"))


@query("SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM orders WHERE (lower(o_orderstatus) = 'f' AND lower(o_orderpriority) = '1-urgent') OR (lower(o_orderstatus) = 'o' AND lower(o_orderpriority) = '5-low') GROUP BY 1, 2")
def allowed_pairs(spark, d):
    rows = load(spark, d, "orders").where(filters.allowed_pair(F.col("o_orderstatus"), F.col("o_orderpriority"), [("F", "1-URGENT"), ("O", "5-LOW")]))
    return aggregates.counts(rows, ["o_orderpriority", "o_orderstatus"])


@query("SELECT p_partkey FROM part WHERE upper(p_name) LIKE '% ' || upper('a') OR p_type LIKE 'S%'")
def suffix_filter(spark, d):
    return load(spark, d, "part").where(filters.ends_with_word(F.col("p_name"), "a") | F.col("p_type").startswith("S")).select("p_partkey")


# Graphs and increments


@query("""
    WITH RECURSIVE e AS (SELECT 1000 + n_regionkey AS dst, n_nationkey AS src FROM nation UNION ALL SELECT n_nationkey, 10000 + c_custkey FROM nation JOIN customer ON c_nationkey = n_nationkey),
    r AS (SELECT 1001 AS node, 0 AS depth UNION ALL SELECT e.src, r.depth + 1 FROM e JOIN r ON e.dst = r.node) SELECT CAST(node AS BIGINT) AS node, depth FROM r""")
def recursive_closure(spark, d):
    nation, customer = load(spark, d, "nation"), load(spark, d, "customer")
    up = nation.select(big("n_nationkey").alias("src"), big(F.lit(1000) + F.col("n_regionkey")).alias("dst"))
    down = customer.select((F.lit(10000) + F.col("c_custkey")).alias("src"), big("c_nationkey").alias("dst"))
    return hierarchy.closure(up.unionByName(down), spark.range(1).select(F.lit(1001).cast("bigint").alias("node")))


@query("""
    SELECT c_custkey FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_mktsegment <> 'BUILDING' AND (c_acctbal > 9000 OR n_nationkey NOT IN (1, 3))""")
def hier_undo(spark, d):
    rows = load(spark, d, "customer").join(load(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    code = F.when(F.col("c_mktsegment") == "BUILDING", "NA").when(F.col("c_acctbal") > 9000, F.col("c_custkey").cast("string")).otherwise("")
    rows = rows.select("c_custkey", F.col("n_regionkey").cast("string").alias("region"), F.col("n_nationkey").cast("string").alias("nation"), code.alias("leaf_code"))
    gone = spark.range(1).select(F.explode(F.array(F.lit("1"), F.lit("3"))).alias("id"))
    return hierarchy.undo(rows, {"nation": gone}, "leaf_code", ["region", "nation"]).select("c_custkey")


@query("SELECT CAST(x AS DATE) AS date FROM range(DATE '2024-02-09' - INTERVAL 39 DAY, DATE '2024-02-10', INTERVAL 1 DAY) t(x) WHERE CAST(x AS DATE) NOT IN (SELECT CAST(ts AS DATE) FROM events)")
def ledger_antijoin(spark, d):
    covered = load(spark, d, "events").select(F.col("ts").cast("date").alias("date")).distinct()
    return incremental.due_dates(spark, "2024-02-09", 40, covered).select("date")


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def resume_unseen(spark, d):
    return incremental.unseen(load(spark, d, "documents"), load(spark, d, "labels"), ["doc_id"]).select("doc_id")


@query("SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def windowed_counts(spark, d):
    return incremental.windowed_counts(load(spark, d, "events"), "ts", "event_type")


@query(r"""
    SELECT page_id, 1 AS "table", "row", cells FROM (
      SELECT page_id, 0 AS "row", 'Page|Address|Kind' AS cells FROM pages UNION ALL
      SELECT page_id, 1, CAST(page_id AS VARCHAR) || '|' || trim(regexp_replace(url, '\s+', ' ', 'g')) || '|odd ' || page_id % 2 FROM pages UNION ALL
      SELECT page_id, 2, 'a & b' || chr(10) || 'c|' || page_id * 2 || '|' FROM pages WHERE page_id % 3 = 0)""")
def html_table_extract(spark, d):
    """Every page gets a table before its own content (one of another id before it, a header cell that a td closes, hidden
    divs, rows of one cell), which is found again by its id."""
    safe = F.replace(F.replace(F.replace("url", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit('"'), F.lit("&quot;"))
    more = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("<tr><td><div>a &amp; b</div><div style='visibility: hidden'>no</div><div>c</div></td><td>"), F.col("page_id") * 2, F.lit("</td><td></td></tr>"))).otherwise("<tr><td>one</td></tr>")
    table = F.concat(F.lit("<table id=x><tr><td>no</td><td>no</td></tr></table><table id=t><tr><th>Page</th><th>Address</td><th>Kind</th></tr><tr><td>"), F.col("page_id"), F.lit("</td><td>"), safe, F.lit("</td><td>odd "), F.col("page_id") % 2, F.lit("</td></tr>"), more, F.lit("</table>"))
    pages = load(spark, d, "pages").select("page_id", documents.repair_html(F.concat(table, F.coalesce("html", F.lit("")))).alias("html"))
    rows = documents.decoded(pages, "page_id", "html", lambda html: documents.page_tables(html, "t"))
    return rows.select("page_id", "table", "row", F.array_join("cells", "|").alias("cells"))


from tabwright import cell_queries, entity_queries, source_queries  # noqa: E402, F401  they list themselves


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
