"""Queries of the entity operators and of the reconciler. Their entities are made of customers: each one's key decides what is
wrong with it. They are written as JSON lines and read back, and so is the register of customers that they are held against."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.functions import text
from tabwright.operators import entities as E
from tabwright.operators import aggregates, columns, joins, reconcile
from tabwright.registry import big, load, query
from tabwright.session import scratch_dir
from tabwright.sources import sinks, tables

#: One row for each entity, in DuckDB: its number, its nation's number, and what its key decides.
_E = """(SELECT c_custkey AS k, 'Q' || c_custkey AS id, c_nationkey + 10 AS n, CASE WHEN c_custkey % 11 = 0 THEN 'NA' ELSE c_name END AS label,
  CASE WHEN c_custkey % 5 = 0 THEN ['ALIAS ' || c_custkey] ELSE [] END AS aliases, c_custkey % 13 = 0 AS dead, c_custkey % 7 <> 0 AS home,
  CASE WHEN c_custkey % 6 = 0 THEN [] WHEN c_custkey % 6 = 1 THEN [c_nationkey + 10, c_nationkey + 11] ELSE [c_nationkey + 10] END AS parents,
  CASE WHEN c_custkey % 6 = 0 THEN [] WHEN c_custkey % 6 = 1 THEN ['normal', 'normal'] WHEN c_custkey % 6 = 2 THEN [CASE WHEN c_custkey % 4 = 0 THEN 'preferred' ELSE 'normal' END, 'normal'] ELSE ['normal'] END AS ranks,
  CASE WHEN c_custkey % 9 = 0 THEN [1149652, 5] WHEN c_custkey % 9 = 1 THEN [1149652, 64728694] ELSE [1149652] END AS classes,
  CASE WHEN c_custkey % 8 = 0 THEN [] WHEN c_custkey % 8 = 1 THEN [CAST(c_custkey AS VARCHAR), 'U' || c_custkey] WHEN c_custkey % 8 = 2 THEN ['X' || c_custkey]
    WHEN c_custkey % 8 = 3 THEN [CAST(c_custkey + 1 AS VARCHAR)] ELSE [CAST(c_custkey AS VARCHAR)] END AS codes FROM customer)"""
_LIVE = f"(SELECT * FROM {_E} WHERE NOT dead AND k % 9 <> 1)"
_WHO = """'{"entity":"' || id || '","label":"' || label || '"'"""


def _claim(value: Column, rank: str | Column = "normal", ended: Column | None = None) -> Column:
    ends = F.array(F.struct(F.struct(F.lit("t").alias("value")).alias("datavalue")))
    qualifiers = F.when(ended, F.create_map(F.lit(E.END_TIME), ends)) if ended is not None else F.lit(None).cast("map<string,array<struct<datavalue:struct<value:string>>>>")
    return F.struct((F.lit(rank) if isinstance(rank, str) else rank).alias("rank"), F.struct(F.struct(value.cast("string").alias("value")).alias("datavalue")).alias("mainsnak"), qualifiers.alias("qualifiers"))


def _item(number: Column) -> Column:
    return F.concat(F.lit('{"numeric-id":'), number.cast("string"), F.lit("}"))


def _some(*choices: tuple[Column, list[Column]]) -> Column:
    """The claims of the first choice that holds, none else."""
    none = F.array().cast("array<struct<rank:string,mainsnak:struct<datavalue:struct<value:string>>,qualifiers:map<string,array<struct<datavalue:struct<value:string>>>>>>")
    out = none
    for holds, listed in reversed(choices):
        out = F.when(holds, F.array(*listed) if listed else none).otherwise(out)
    return out


def entity_lines(customers: DataFrame) -> DataFrame:
    """customers -> pos, value: JSON lines of entities."""
    k, n = F.col("c_custkey"), F.col("c_nationkey") + 10
    claims = {
        E.COUNTRY: F.array(_claim(_item(F.when(k % 7 == 0, 843).otherwise(668)))),
        E.LOCATED_IN: _some(
            (k % 6 == 0, []), (k % 6 == 1, [_claim(_item(n)), _claim(_item(n + 1))]),
            (k % 6 == 2, [_claim(_item(n), F.when(k % 4 == 0, "preferred").otherwise("normal")), _claim(_item(n + 1), "normal", F.lit(True))]), (F.lit(True), [_claim(_item(n))]),
        ),
        E.INSTANCE_OF: _some((k % 9 == 0, [_claim(_item(F.lit(1149652))), _claim(_item(F.lit(5)))]), (k % 9 == 1, [_claim(_item(F.lit(1149652))), _claim(_item(F.lit(E.PROPOSED)))]), (F.lit(True), [_claim(_item(F.lit(1149652)))])),
        E.DISSOLVED: _some((k % 13 == 0, [_claim(F.lit("x"))])),
        E.CODES["district"]: _some((k % 8 == 0, []), (k % 8 == 1, [_claim(k), _claim(F.concat(F.lit("U"), k))]), (k % 8 == 2, [_claim(F.concat(F.lit("X"), k))]), (k % 8 == 3, [_claim(k + 1)]), (F.lit(True), [_claim(k)])),
        E.CENSUS_CODE: _some((k % 3 == 0, [_claim(k), _claim(k + 5)])),
        E.COORDINATES: F.array(_claim(F.concat(F.lit('{"latitude":'), n, F.lit('.5,"longitude":'), k % 180, F.lit("}")))),
    }
    have = F.map_filter(F.create_map(*[x for p, c in claims.items() for x in (F.lit(p), c)]), lambda _, c: F.size(c) > 0)
    word = lambda v: F.struct(F.lit("en").alias("language"), v.alias("value"))
    labels = F.when(k % 11 != 0, F.create_map(F.lit("en"), word(F.col("c_name"))))
    aliases = F.when(k % 5 == 0, F.create_map(F.lit("en"), F.array(word(F.concat(F.lit("ALIAS "), k)))))
    data = F.struct(labels.alias("labels"), aliases.alias("aliases"), have.alias("claims"))
    return customers.select(k.alias("pos"), F.to_json(F.struct(F.concat(F.lit("Q"), k).alias("id"), data.alias("data"))).alias("value"))


def _entities(spark, d) -> DataFrame:
    """Landed with blank lines and an earlier line of each seventh id, which the later one replaces; read back."""
    folder = scratch_dir(spark, "entities")
    lines = entity_lines(load(spark, d, "customer"))
    early = lines.where("pos % 7 = 3").select((F.col("pos") - 0.5).alias("pos"), F.concat(F.lit('{"id":"Q'), "pos", F.lit('","data":{"labels":{}}}\n\n')).alias("value"))
    # One key's lines are neighbours in one file.
    every = lines.select(F.col("pos").cast("double").alias("pos"), "value").unionByName(early)
    every.repartitionByRange(4, F.ceil("pos")).sortWithinPartitions("pos").select("value").write.text(f"{folder}/lines")
    return E.read_entities(spark, f"{folder}/lines").withColumn("pos", text.entity_number(F.col("id")))


def _live(spark, d) -> DataFrame:
    return _entities(spark, d).where(E.instance_of([1149652]))


def _joined(values: Column) -> Column:
    return F.array_join(F.transform(values, lambda v: v.cast("string")), ",")


@query(f"""
    SELECT k, label, list_aggregate(list_concat([label], aliases), 'string_agg', ',') AS names, coalesce(list_aggregate(codes, 'string_agg', ','), '') AS codes, CASE WHEN len(codes) = 1 THEN codes[1] ELSE 'NA' END AS code,
    CASE WHEN dead THEN '' ELSE coalesce(list_aggregate(parents, 'string_agg', ','), '') END AS parents, CASE WHEN dead THEN '' ELSE coalesce(list_aggregate(ranks, 'string_agg', ','), '') END AS ranks,
    CASE WHEN dead THEN 0 ELSE len(list_filter(ranks, lambda r: r = 'preferred')) END AS preferred, CASE WHEN dead THEN '' ELSE coalesce(list_aggregate(classes, 'string_agg', ','), '') END AS classes,
    CASE WHEN k % 3 = 0 THEN CAST(k + 5 AS VARCHAR) ELSE 'NA' END AS census, CAST(n + 0.5 AS DOUBLE) AS latitude, CAST(k % 180 AS DOUBLE) AS longitude, dead AS inactive, NOT dead AND k % 9 <> 1 AS member, home FROM {_E}""")
def entity_fields(spark, d):
    place = E.coordinates()
    return _entities(spark, d).select(
        F.col("pos").alias("k"), E.label().alias("label"), _joined(E.names()).alias("names"), _joined(E.codes("district")).alias("codes"), E.single_code("district").alias("code"),
        _joined(E.item_ids(E.LOCATED_IN)).alias("parents"), _joined(E.ranks()).alias("ranks"), big(aggregates.count_if(E.ranks(), "preferred")).alias("preferred"), _joined(E.item_ids(E.INSTANCE_OF)).alias("classes"),
        E.census_code().alias("census"), place["latitude"].alias("latitude"), place["longitude"].alias("longitude"), E.inactive().alias("inactive"), E.instance_of([1149652]).alias("member"), E.in_country().alias("home"),
    )


@query(f"""
    SELECT k AS src, 'P131' AS prop, CAST(unnest(parents) AS BIGINT) AS dst, unnest(ranks) AS "rank", true AS "current" FROM {_E} WHERE k % 6 <> 2 UNION ALL
    SELECT k, 'P131', n, ranks[1], true FROM {_E} WHERE k % 6 = 2 UNION ALL SELECT k, 'P131', n + 1, 'normal', false FROM {_E} WHERE k % 6 = 2 UNION ALL
    SELECT k, 'P31', unnest(classes), 'normal', true FROM {_E}""")
def entity_edges(spark, d):
    return E.edges(_entities(spark, d), [E.LOCATED_IN, E.INSTANCE_OF])


@query(f"""
    SELECT 'not_in_india' AS kind, id AS key, {_WHO} || '}}' AS payload FROM {_LIVE} WHERE NOT home UNION ALL
    SELECT 'multiple_located_in', id, {_WHO} || ',"located_in":[' || coalesce(list_aggregate(parents, 'string_agg', ','), '') || ']}}' FROM {_LIVE} WHERE len(parents) <> 1 UNION ALL
    SELECT 'no_single_preferred_rank_for_located_in', id, {_WHO} || ',"num_preferred":0,"expected_preferred":' || n || '}}' FROM {_LIVE} WHERE k % 6 = 2 AND k % 4 <> 0 UNION ALL
    SELECT 'multiple_instance_of', id, {_WHO} || ',"inst_of":[1149652,5]}}' FROM {_LIVE} WHERE len(classes) <> 1 UNION ALL
    SELECT 'wrong_kind_of_located_in', id, {_WHO} || ',"located_in":' || n || ',"expected":"a state"}}' FROM {_LIVE} WHERE len(parents) = 1 AND n >= 30""")
def graph_checks(spark, d):
    return reconcile.graph_checks(_live(spark, d), lambda parent: parent < 30, "a state")


_HELD = f"(SELECT l.*, codes[1] AS code, c_name AS name FROM {_LIVE} l JOIN customer ON codes[1] = CAST(c_custkey AS VARCHAR) AND c_custkey % 10 <> 4 WHERE len(codes) = 1)"


@query(f"""
    WITH register AS (SELECT CAST(c_custkey AS VARCHAR) AS code, c_name AS name FROM customer WHERE c_custkey % 10 <> 4),
    placed AS (SELECT *, row_number() OVER w AS nth, first(id) OVER w AS prev, first(label) OVER w AS prev_label FROM {_HELD} WINDOW w AS (PARTITION BY code ORDER BY k))
    SELECT 'no_lgd_id' AS kind, id AS key, {_WHO} || '}}' AS payload FROM {_LIVE} WHERE len(codes) = 0 UNION ALL
    SELECT 'multiple_lgd_ids', id, {_WHO} || ',"lgd_entries":[{{"code":"' || k || '","name":"' || coalesce(name, 'NA') || '"}},{{"code":"U' || k || '","name":"NA"}}]}}' FROM {_LIVE} LEFT JOIN register ON code = CAST(k AS VARCHAR) WHERE len(codes) = 2 UNION ALL
    SELECT 'unknown_lgd_id', id, {_WHO} || ',"lgd_code":"' || c || '"}}' FROM (SELECT id, label, unnest(codes) AS c FROM {_LIVE}) WHERE c NOT IN (SELECT code FROM register) UNION ALL
    SELECT 'duplicate_lgd_id', code, '{{"lgd_entry":{{"code":"' || code || '","name":"' || name || '"}},"curr":"' || id || '","curr_label":"' || label || '","prev":"' || prev || '","prev_label":"' || prev_label || '"}}' FROM placed WHERE nth > 1 UNION ALL
    SELECT 'name_mismatch', id, NULL FROM placed WHERE nth = 1 AND label <> name UNION ALL
    SELECT 'missing', code, '{{"lgd_entry":{{"code":"' || code || '","name":"' || name || '"}}}}' FROM register WHERE code NOT IN (SELECT code FROM placed)""")
def code_checks(spark, d):
    """Payloads of name_mismatch hold a weighted distance, which SQL can't compute; their kind and key are compared."""
    register = load(spark, d, "customer").where("c_custkey % 10 <> 4").select(F.col("c_custkey").cast("string").alias("code"), F.col("c_name").alias("name"))
    found = reconcile.code_checks(_live(spark, d), register, "code", "name", "district")
    return found.withColumn("payload", F.when(F.col("kind") != "name_mismatch", F.col("payload")))


_PEOPLE = "(SELECT c_custkey AS k, c_nationkey AS n, 'Q' || c_custkey AS id, CASE WHEN c_custkey % 4 = 0 THEN c_name || ' District' WHEN c_custkey % 4 = 1 THEN c_name || ' TALUK' ELSE c_name END AS label FROM customer)"


def _people(spark, d) -> DataFrame:
    k = F.col("c_custkey")
    label = F.concat("c_name", F.when(k % 4 == 0, " District").when(k % 4 == 1, " TALUK").otherwise(""))
    return load(spark, d, "customer").select(k.alias("k"), F.col("c_nationkey").alias("n"), F.concat(F.lit("Q"), k).alias("id"), label.alias("label"), F.col("c_nationkey").cast("string").alias("state"))


@query(f"""
    SELECT 'hierarchy' AS of, 'wrong_hierarchy' AS kind, CAST(k AS VARCHAR) AS key, '{{"current":"' || (n + k % 3) || '","expected":"' || n || '"}}' AS payload FROM {_PEOPLE} WHERE k % 3 <> 0 AND k % 7 <> 0 UNION ALL
    SELECT 'suffix', 'wrong_suffix', id, '{{"label":"' || label || '","expected":"district"}}' FROM {_PEOPLE} WHERE k % 4 <> 0 UNION ALL
    SELECT 'state suffix', 'wrong_suffix', id, '{{"label":"' || label || '","expected":"' || CASE n % 3 WHEN 0 THEN 'District' ELSE 'Taluk' END || '"}}' FROM {_PEOPLE} WHERE n < 20 AND n % 3 < 2 AND k % 4 <> n % 3 UNION ALL
    SELECT 'class', 'wrong_inst_of', id, '{{"label":"' || label || '","current":[' || (k % 5) || ',' || (k % 5 + 10) || '],"expected":[' || CASE WHEN n % 2 = 0 THEN '1,3' ELSE '1' END || ']}}' FROM {_PEOPLE} WHERE n < 20 AND k % 5 <> 1 AND NOT (n % 2 = 0 AND k % 5 = 3)""")
def attribute_checks(spark, d):
    people = _people(spark, d)
    found = people.select("k", F.when(F.col("k") % 7 == 0, "NA").otherwise((F.col("n") + F.col("k") % 3).cast("string")).alias("p"))
    meant = people.select("k", F.col("n").cast("string").alias("p"))
    nations = load(spark, d, "nation").where("n_nationkey < 20")
    third = F.col("n_nationkey") % 3
    config = tables.state_config(nations.select(
        F.col("n_nationkey").cast("string").alias("state"), F.when(third == 0, "District").when(third == 1, "Taluk").alias("suffix"),
        F.lit(1).cast("bigint").alias("class"), F.when(F.col("n_nationkey") % 2 == 0, F.array(F.lit(3).cast("bigint"))).alias("alternates"),
    ))
    classed = people.select("id", "label", "state", F.array(F.col("k") % 5, F.col("k") % 5 + 10).alias("classes"))
    parts = {
        "hierarchy": reconcile.hierarchy_check(found, meant, "k", "p"),
        "suffix": reconcile.suffix_check(people, "district"),
        "state suffix": reconcile.suffix_check(people.select("id", "label", "state"), config, "state"),
        "class": reconcile.class_check(classed, tables.state_classes(config), "state"),
    }
    return reduce(DataFrame.unionByName, [rows.select(F.lit(name).alias("of"), "kind", "key", "payload") for name, rows in parts.items()])


#: Nations contain their customers but each fifth, and each sixth of the next nation; a customer says its nation unless its key is a multiple of 4.
_DOWN = "(SELECT c_nationkey AS parent, c_custkey AS child FROM customer WHERE c_custkey % 5 <> 0 UNION SELECT (c_nationkey + 1) % 25, c_custkey FROM customer WHERE c_custkey % 6 = 0)"
_UP = "(SELECT c_nationkey AS parent, c_custkey AS child FROM customer WHERE c_custkey % 4 <> 0)"
_LISTED = "string_agg(CAST({0} AS VARCHAR), ',' ORDER BY {0})"


@query(f"""
    SELECT 'in_multiple_contains' AS kind, CAST(child AS VARCHAR) AS key, '{{"parents":[' || {_LISTED.format('parent')} || ']}}' AS payload FROM {_DOWN} GROUP BY child HAVING count(*) > 1 UNION ALL
    SELECT 'missing_in_contains', CAST(parent AS VARCHAR), '{{"child":' || child || '}}' FROM (SELECT * FROM {_UP} EXCEPT SELECT * FROM {_DOWN}) UNION ALL
    SELECT 'missing_contained_in', CAST(child AS VARCHAR), '{{"parent":' || parent || '}}' FROM (SELECT * FROM {_DOWN} EXCEPT SELECT * FROM {_UP}) UNION ALL
    SELECT 'wrong_kind_of_contains', CAST(parent AS VARCHAR), '{{"label":"NATION_' || parent || '","contains":[' || {_LISTED.format('child')} || ']}}' FROM {_DOWN} WHERE child % 10 = 1 GROUP BY parent""")
def contains_checks(spark, d):
    customer = load(spark, d, "customer").select(big("c_custkey").alias("child"), F.col("c_nationkey").alias("parent"))
    down = customer.where("child % 5 <> 0").unionByName(customer.where("child % 6 = 0").select("child", F.expr("(parent + 1) % 25").alias("parent")))
    parents = load(spark, d, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("label")).join(down.groupBy(F.col("parent").alias("id")).agg(F.collect_list("child").alias("contains")), "id")
    children = customer.select(F.col("child").alias("id"), F.when(F.col("child") % 4 != 0, F.array("parent")).otherwise(F.array().cast("array<int>")).alias("located_in"))
    valid = customer.where("child % 10 <> 1").select(F.col("child").alias("node"))
    return reconcile.contains_inverse(parents, children).unionByName(reconcile.contains_kind_check(parents, valid))


def _set_sql(kind: str, expected: str, current: str) -> str:
    listed = "'[' || coalesce(string_agg(CAST({0} AS VARCHAR), ',' ORDER BY {0}), '') || ']'"
    return f"""SELECT '{kind}' AS kind, CAST(k AS VARCHAR) AS key, '{{"missing":' || {listed.format('a')} || ',"extra":' || {listed.format('b')} || '}}' AS payload FROM (
      SELECT coalesce(e.k, c.k) AS k, CASE WHEN c.k IS NULL THEN e.m END AS a, CASE WHEN e.k IS NULL THEN c.m END AS b FROM (SELECT DISTINCT * FROM {expected}) e FULL JOIN (SELECT DISTINCT * FROM {current}) c ON e.k = c.k AND e.m = c.m) GROUP BY k HAVING count(a) + count(b) > 0"""


_WANT = "(SELECT c_nationkey AS k, c_custkey % 40 AS m FROM customer)"
_HAVE = "(SELECT c_nationkey AS k, c_custkey % 42 AS m FROM customer WHERE c_custkey % 9 <> 0)"
_ONE = "(SELECT p_partkey AS l, p_partkey * 2 AS r FROM part UNION SELECT p_partkey, p_partkey * 2 + 1 FROM part WHERE p_partkey % 3 = 0 UNION SELECT p_partkey, p_partkey * 2 + 2 FROM part WHERE p_partkey % 5 = 1)"
_MATES = f"(SELECT l, r FROM {_ONE} WHERE l IN (SELECT l FROM {_ONE} GROUP BY l HAVING count(*) = 1) AND r IN (SELECT r FROM {_ONE} GROUP BY r HAVING count(*) = 1))"


@query(
    _set_sql("contains_mismatch", _WANT, _HAVE) + " UNION ALL " + _set_sql("wrong_territory_overlaps", _HAVE, _WANT)
    + f""" UNION ALL SELECT 'wrong_coextensive', CAST(l AS VARCHAR), CASE WHEN l % 7 = 0 THEN '{{"expected":"' || r || '"}}' ELSE '{{"expected":"' || r || '","current":"' || (r + 1) || '"}}' END FROM {_MATES} WHERE l % 7 = 0 OR l % 4 = 0"""
)
def set_checks(spark, d):
    customer, part = load(spark, d, "customer"), load(spark, d, "part")
    want = customer.select(F.col("c_nationkey").alias("k"), (F.col("c_custkey") % 40).alias("m"))
    have = customer.where("c_custkey % 9 <> 0").select(F.col("c_nationkey").alias("k"), (F.col("c_custkey") % 42).alias("m"))
    one = part.select(F.col("p_partkey").alias("l"), F.expr("explode(concat(array(2 * p_partkey), if(p_partkey % 3 = 0, array(2 * p_partkey + 1), array()), if(p_partkey % 5 = 1, array(2 * p_partkey + 2), array())))").alias("r"))
    says = part.where("p_partkey % 7 <> 0").select(F.col("p_partkey").alias("l"), F.expr("2 * p_partkey + if(p_partkey % 4 = 0, 1, 0)").alias("r"))
    parts = [reconcile.completeness(want, have, "k", "m"), reconcile.overlap_check(have, want, "k", "m"), reconcile.coextensive_check(one, says, "l", "r")]
    return reduce(DataFrame.unionByName, parts)


@query(f"""
    SELECT 'report' AS of, 'not_in_india' AS kind, '[' || string_agg({_WHO} || '}}', ',' ORDER BY {_WHO} || '}}') || ']' AS text FROM {_LIVE} WHERE NOT home UNION ALL
    SELECT 'line', 'not_in_india', id || '|P17|Q668' FROM {_LIVE} WHERE NOT home UNION ALL
    SELECT 'line', 'multiple_instance_of', '-' || id || '|P31|Q5' FROM {_LIVE} WHERE len(classes) <> 1""")
def issue_reports(spark, d):
    """Issues as JSON by kind, and as correction lines of the kinds that have a template."""
    issues = reconcile.graph_checks(_live(spark, d)).where("kind in ('not_in_india', 'multiple_instance_of', 'multiple_located_in')")
    report = sinks.report_json(issues.where("kind = 'not_in_india'")).select(F.lit("report").alias("of"), "kind", F.col("json").alias("text"))
    entity = F.get_json_object("payload", "$.entity")
    lines = sinks.quick_statements(issues, {"not_in_india": F.concat(entity, F.lit("|P17|Q668")), "multiple_instance_of": F.concat(F.lit("-"), entity, F.lit("|P31|Q5"))})
    return report.unionByName(lines.select(F.lit("line").alias("of"), "kind", F.col("line").alias("text")))


@query("""SELECT c_custkey AS k, c_name AS label, 'a ' || lower(c_mktsegment) AS description, 1149652 AS instance_of, c_nationkey AS located_in, '+1998-07-01T00:00:00Z/11' AS inception, CAST(c_custkey AS VARCHAR) AS code, 'P12746' AS property FROM customer""")
def suggestions(spark, d):
    said = columns.suggestion(F.col("c_name"), F.concat(F.lit("a "), F.lower("c_mktsegment")), F.lit(1149652), F.col("c_nationkey"), F.lit("+1998-07-01T00:00:00Z/11"), F.col("c_custkey").cast("string"), E.CODES["district"])
    return load(spark, d, "customer").select(F.col("c_custkey").alias("k"), said.alias("s")).select("k", "s.*")


@query("""
    SELECT c_custkey AS k, CASE WHEN c_custkey % 3 = 0 THEN c_name WHEN c_custkey % 3 = 1 THEN 'ALIAS' END AS match, CASE WHEN c_custkey % 3 = 0 THEN 0.0 END AS distance FROM customer""")
def closest_names(spark, d):
    """A name's own spelling is at distance 0 and the first of equal ones wins; other distances aren't SQL's to compute."""
    k = F.col("c_custkey")
    names = F.when(k % 3 == 0, F.array(F.lit("ALIAS"), F.col("c_name"), F.col("c_name"))).when(k % 3 == 1, F.array(F.lit("ALIAS"))).otherwise(F.array().cast("array<string>"))
    rows = load(spark, d, "customer").select(k.alias("k"), "c_name", names.alias("names"))
    met = joins.closest_name(rows, ["k"], "c_name", "names")
    return met.select("k", "match", F.when(F.col("k") % 3 == 0, F.col("match_distance")).alias("distance"))
