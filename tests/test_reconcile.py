"""Entities made by hand that raise each kind of issue."""

import json

import pytest
from pyspark.sql import functions as F

from tabwright.operators import entities as E
from tabwright.operators import reconcile


def claim(value, rank="normal", ended=False, kind=None):
    data = value if isinstance(value, str) else json.dumps(kind or {"numeric-id": value})
    qualifiers = {E.END_TIME: [{"datavalue": {"value": "t"}}]} if ended else {}
    return {"rank": rank, "mainsnak": {"datavalue": {"value": data}}, "qualifiers": qualifiers}


def entity(number, label=None, code=(), country=(668,), parents=(10,), classes=(1149652,), **more):
    claims = {E.CODES["district"]: [claim(c) for c in code], E.COUNTRY: [claim(c) for c in country], E.LOCATED_IN: [c if isinstance(c, dict) else claim(c) for c in parents], E.INSTANCE_OF: [c if isinstance(c, dict) else claim(c) for c in classes]}
    claims |= {k: v for k, v in more.items() if k[0] == "P"}
    claims = {k: v for k, v in claims.items() if v}
    labels = {"en": {"language": "en", "value": label}} if label else {}
    aliases = {"en": [{"language": "en", "value": a} for a in more.get("aliases", ())]}
    return json.dumps({"id": f"Q{number}", "data": {"labels": labels, "aliases": aliases, "claims": claims}})


LINES = [
    entity(1, "Solan District", ["25"]),
    entity(2, "Solan again", ["25"]),
    entity(3, "Nowhere", ["999"]),
    entity(4, "Two codes", ["26", "998"]),
    entity(5, "No code"),
    entity(6, "Mandi", ["27"], country=(843,), parents=()),
    entity(7, None, ["28"], parents=(claim(10), claim(11)), classes=(1149652, 5)),
    entity(8, "Una", ["29"], parents=(claim(10), claim(12, ended=True)), aliases=["UNAA"]),
    entity(9, "Kullu", ["30"], P576=[claim("x")]),
    entity(10, "Planned", ["31"], classes=(1149652, 64728694)),
    entity(11, "Wrong parent", ["32"], parents=(99,)),
    entity(12, "Ended class", ["33"], classes=(claim(1149652, ended=True),)),
]
REGISTER = [("25", "SOLAN"), ("26", "TWO CODES"), ("27", "MANDI"), ("28", "X"), ("29", "UNA"), ("32", "WRONG PARENT"), ("40", "MISSING")]


@pytest.fixture(scope="module")
def graph(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("e") / "e.jsonl"
    path.write_text("\n\n".join([*LINES, entity(1, "Solan District", ["25"])]))
    return E.read_entities(spark, str(path)).withColumn("pos", E.label().isNull().cast("int") + F.expr("try_cast(substr(id, 2) as int)")).cache()


def found(frame):
    out = {}
    for r in frame.collect():
        out.setdefault(r.kind, []).append(r.key)
    return {k: sorted(v) for k, v in out.items()}


def test_filters(graph):
    assert graph.count() == 12
    assert sorted(r.id for r in graph.where(E.instance_of([1149652])).collect()) == sorted(f"Q{n}" for n in (1, 2, 3, 4, 5, 6, 7, 8, 11))
    assert [r.id for r in graph.where(E.inactive()).collect()] == ["Q9"]
    assert graph.where(E.single_code("district") == "NA").count() == 2
    with pytest.raises(KeyError):
        E.codes("galaxy")
    row = graph.where("id = 'Q8'").select(E.names().alias("n"), E.item_ids(E.LOCATED_IN).alias("p"), E.ranks().alias("r"), E.census_code().alias("c")).first()
    assert (row.n, row.p, row.r, row.c) == (["Una", "UNAA"], [10], ["normal", "normal"], "NA")
    place = json.loads(entity(1))
    place["data"]["claims"][E.COORDINATES] = [claim(0, kind={"latitude": 1.5, "longitude": 2.5})]
    spark = graph.sparkSession
    one = spark.createDataFrame([(json.dumps(place),)], "j string").select(F.from_json("j", E.SCHEMA).alias("e")).select("e.*").select(E.coordinates().alias("c")).first()["c"]
    assert tuple(one) == (1.5, 2.5)
    assert E.edges(graph, [E.LOCATED_IN]).where("not current").count() == 1


def test_graph_checks(graph):
    active = graph.where(E.instance_of([1149652]))
    got = found(reconcile.graph_checks(active, lambda p: p.isin(10, 11, 12), "state"))
    assert got == {"not_in_india": ["Q6"], "multiple_located_in": ["Q6", "Q7"], "multiple_instance_of": ["Q7"], "no_single_preferred_rank_for_located_in": ["Q8"], "wrong_kind_of_located_in": ["Q11"]}


def test_code_checks(spark, graph):
    register = spark.createDataFrame(REGISTER, "code string, name string")
    active = graph.where(E.instance_of([1149652]))
    got = found(reconcile.code_checks(active, register, "code", "name", "district", suffixes=[" DISTRICT"]))
    assert got == {"duplicate_lgd_id": ["25"], "unknown_lgd_id": ["Q3", "Q4"], "multiple_lgd_ids": ["Q4"], "no_lgd_id": ["Q5"], "name_mismatch": ["Q7"], "missing": ["26", "40"]}


def test_relations(spark):
    make = lambda rows, schema: spark.createDataFrame(rows, schema)
    assert found(reconcile.hierarchy_check(make([("1", "A"), ("2", "B"), ("3", "NA")], "k string, p string"), make([("1", "A"), ("2", "C"), ("3", "D")], "k string, p string"), "k", "p")) == {"wrong_hierarchy": ["2"]}
    labelled = make([("1", "Solan District", "s1"), ("2", "Mandi", "s1"), ("3", "Una taluk", "s2"), ("4", "x", "s9")], "id string, label string, state string")
    assert found(reconcile.suffix_check(labelled, "district")) == {"wrong_suffix": ["2", "3", "4"]}
    assert found(reconcile.suffix_check(labelled, make([("s1", "District"), ("s2", "Taluk"), ("s3", "")], "state string, suffix string"), "state")) == {"wrong_suffix": ["2"]}
    classed = make([("1", "a", [5], "s1"), ("2", "b", [6], "s1")], "id string, label string, classes array<int>, state string")
    assert found(reconcile.class_check(classed, make([("s1", 5)], "state string, class int"), "state")) == {"wrong_inst_of": ["2"]}
    holders = make([(1, "p", [10, 11, 99]), (2, "q", [11])], "id int, label string, contains array<int>")
    assert found(reconcile.contains_kind_check(holders, make([(10,), (11,)], "node int"))) == {"wrong_kind_of_contains": ["1"]}
    kids = make([(10, [2]), (11, [1]), (12, [1])], "id int, located_in array<int>")
    assert found(reconcile.contains_inverse(holders, kids)) == {"in_multiple_contains": ["11"], "missing_in_contains": ["1", "2"], "missing_contained_in": ["10", "11"]}
    assert "missing_contained_in" not in found(reconcile.contains_inverse(holders, kids, False))
    a, b = make([("s", 1), ("s", 2), ("t", 3)], "k string, m int"), make([("s", 2), ("s", 4), ("t", 3)], "k string, m int")
    row = reconcile.completeness(a, b, "k", "m").first()
    assert row.key == "s" and json.loads(row.payload) == {"missing": [1], "extra": [4]}
    assert found(reconcile.overlap_check(a, b, "k", "m")) == {"wrong_territory_overlaps": ["s"]}
    pairs = make([("p1", 1), ("p2", 2), ("p3", 3), ("p3", 4)], "l string, r int")
    assert found(reconcile.coextensive_check(pairs, make([("p1", 1)], "l string, r int"), "l", "r")) == {"wrong_coextensive": ["p2"]}
    assert {r.kind: r.n for r in reconcile.rollup(make([("a",), ("a",), ("b",)], "kind string")).collect()} == {"a": 2, "b": 1}
