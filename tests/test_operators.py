"""Operators on small tables made by hand, edge cases included."""

import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tabwright.functions import arrays, dates, distance, numbers, text
from tabwright.operators import aggregates, columns, filters, hierarchy, joins, ordered, sets, validate
from tabwright.plans import selection


def one(spark, column, **values):
    """Value of a column expression over one row."""
    row = spark.range(1).select(*[(F.lit(v) if not isinstance(v, list) else F.array(*map(F.lit, v))).alias(k) for k, v in values.items()])
    return row.select(column.alias("x")).first()["x"]


def cells(*values):
    return F.array(*[F.lit(v).cast("string") for v in values])


# Text


def test_clean_name(spark):
    assert one(spark, text.clean_name(F.col("s"), ["THE ", "OLD "], [" TOWN", " CITY"]), s="the Old  Köln-Ehrenfeld City Town") == "KOLN EHRENFELD"
    assert one(spark, text.clean_name(F.col("s"), ["B", "A"]), s="ab") == "B"  # B is tried before A
    assert one(spark, text.canon(F.col("s"), {"ABC D": "ABCD"}), s="  abc d ") == "ABCD"
    assert one(spark, text.drop_trailing_code(F.col("s")), s="Name  (1234567890123456)") == "NAME"
    assert one(spark, text.collapse_spaces(F.col("s")), s="a  b\t\tc") == "a b\t\tc"
    assert one(spark, text.digits(F.col("s")), s="a1b22") == "122"
    assert one(spark, text.after_last(F.col("s")), s="x: y: 12.5 )") == "12.5"
    assert one(spark, text.without(F.col("s"), " District"), s="Foo District") == "Foo"
    assert tuple(one(spark, text.head_and_rest(F.col("s")), s="KERALA Phase  II")) == ("KERALA", "Phase II")
    assert tuple(one(spark, text.file_name_parts(F.col("s")), s="blocks.09May2024.csv.7z")) == ("blocks", "09May2024")
    assert one(spark, text.coded_file_name("list_", F.col("s"), ".csv"), s="07") == "list_07.csv"
    assert one(spark, text.with_query(F.col("s"), {"a": "x y", "n": "1"}), s="http://h/p?a=1&b=2#t") == "http://h/p?b=2&a=x+y&n=1"
    assert one(spark, text.entity_number(text.entity_id(F.lit(42))), s="") == 42
    assert one(spark, text.field(F.col("s"), "#", 6), s="1#2#3#4#5#6#seven") == "seven"
    labels = F.create_map(F.lit("de"), F.lit("Köln"), F.lit("zz"), F.lit("q"))
    assert one(spark, text.best_label(labels, ["de", "fr"]), s="") == "Koln"
    assert one(spark, text.best_label(F.create_map(F.lit("zz"), F.lit("q")), ["de"]), s="") == "NA"
    assert one(spark, text.page_count(F.col("s")), s=["a", "b", "c"]) == 2


def test_fold():
    assert text.fold("Straße Ærø Łódź") == "Strasse AEro Lodz" and text.fold(None) is None


# Dates and numbers


def test_dates(spark):
    assert one(spark, dates.reformat(F.col("s"), dates.COMPACT, dates.ISO), s="09May2024") == "2024-05-09"
    assert one(spark, dates.parse(F.col("s"), dates.SLASHED), s="31/02/2024x") is None
    assert one(spark, dates.inception(F.lit("2024-05-09").cast("date")), s="") == "+2024-05-09T00:00:00Z/11"
    assert one(spark, dates.from_millis(F.lit(86_400_000)), s="") == "1970-01-02 00:00:00"
    assert one(spark, dates.document_date(F.col("s")), s="D:20240509120000+05'30'") == datetime.datetime(2024, 5, 9, 6, 30)
    assert one(spark, dates.document_date(F.col("s")), s="D:2024") == datetime.datetime(2024, 1, 1)
    assert one(spark, dates.document_date(F.col("s")), s="nonsense") is None
    assert [str(x) for x in one(spark, dates.last_days(F.lit("2024-03-01").cast("date"), 3), s="")] == ["2024-02-28", "2024-02-29", "2024-03-01"]
    assert one(spark, dates.months_back(F.lit("2024-03-31").cast("date"), 1), s="") == "Feb2024"
    assert one(spark, dates.listed(F.col("s")), s="May2024") == "2024-05" and one(spark, dates.listed(F.col("s")), s="09May2024") == "2024-05-09"


def test_numbers(spark):
    assert [one(spark, numbers.file_size(F.lit(n)), s="") for n in (0, 1, 1536, 1048576, 5_000_000_000)] == ["0 Bytes", "1 Bytes", "1.5 KB", "1 MB", "4.66 GB"]
    assert one(spark, numbers.coordinate(F.col("s")), s="12.3456789") == 12.34568 and one(spark, numbers.coordinate(F.col("s")), s="NA") is None
    assert one(spark, numbers.integer(F.col("s")), s=" 012 ") == 12 and one(spark, numbers.integer(F.col("s")), s="1.5") is None
    assert [one(spark, numbers.chunk_size(F.lit(n), 8), s="") for n in (3, 80, 10**6)] == [1, 10, 128]


# Arrays


@settings(max_examples=15, deadline=None)
@given(st.lists(st.sampled_from(["", "a", "b"]), max_size=6), st.integers(1, 5))
def test_to_width(spark, values, width):
    got = one(spark, arrays.to_width(cells(*values) if values else F.array().cast("array<string>"), width), s="")
    assert got == (values + [""] * width)[:width]


def test_arrays(spark):
    assert one(spark, arrays.all_empty(cells("", None)), s="") and not one(spark, arrays.all_empty(cells("", "x")), s="")
    assert one(spark, arrays.any_empty(cells("x", None)), s="")
    assert one(spark, arrays.part(cells("a", "b", "c"), 1), s="") == ["b", "c"] and one(spark, arrays.part(cells("a"), 2, 5), s="") == []
    assert one(spark, arrays.insert_cell(cells("a", "b"), 1, F.lit("x")), s="") == ["a", "x", "b"]
    assert one(spark, arrays.merge_maps(F.create_map(F.lit("a"), F.lit(1)), F.create_map(F.lit("a"), F.lit(2), F.lit("b"), F.lit(3))), s="") == {"a": 2, "b": 3}
    stack = F.array(F.struct(F.lit("state").alias("level"), F.lit("S").alias("name")), F.struct(F.lit("dist").alias("level"), F.lit("D").alias("name")))
    row = spark.range(1).select(*arrays.flatten_stack(stack, ["state", "dist", "block"], ["name"])).first()
    assert tuple(row) == ("S", "D", "")


# Distance


@settings(max_examples=60, deadline=None)
@given(st.text("AEHNUCKSZOW ", max_size=8), st.text("AEHNUCKSZOW ", max_size=8))
def test_distance_bounds(a, b):
    d = distance.name_distance(a, b)
    assert 0 <= d <= max(len(a), len(b)) + 1 and distance.name_distance(a, a) == 0


def test_distance_costs():
    d = distance.name_distance
    assert d("RAM", "RAM ") == pytest.approx(0.01) and d("RAM", "RAAM") == pytest.approx(0.1) and d("CAT", "KAT") == pytest.approx(0.45)
    assert d("XA", "KSA") == pytest.approx(0.2) and d("KSA", "XA") == pytest.approx(0.2) and d("BRAMA", "BRMAA") <= 0.45
    assert d("JS", "SJ") == pytest.approx(0.45) and d("ZS", "SZ") == pytest.approx(0.2) and d("PQ", "QP") == pytest.approx(0.45)
    assert d("J", "S") == pytest.approx(0.45) and d("S", "J") == pytest.approx(1.0)  # one way only


def test_best_matches(spark):
    assert tuple(one(spark, distance.closest_of(cells("abc", "abd", "abd"), F.lit("abd")), s="")) == (0, 1, "abd")
    assert one(spark, distance.closest_of(F.array().cast("array<string>"), F.lit("x")), s="") is None
    rows = spark.createDataFrame([(1, "RAMPUR", ["RAMPURA", "RAAMPUR", "RAAMPUR"]), (2, "X", [])], "id int, name string, names array<string>")
    got = {r.id: (r.match, r.match_distance and round(r.match_distance, 6)) for r in joins.closest_name(rows, ["id"], "name", "names").collect()}
    assert got == {1: ("RAAMPUR", 0.1), 2: (None, None)}


# Columns and filters


def test_columns(spark):
    assert one(spark, columns.unspill(cells("a\nb", "", "x"), [1, 2]), s="") == ["a", "b", "x"]
    assert one(spark, columns.unspill(cells("a\nb\nc", "", ""), [1, 2]), s="") == ["a\nb", "c", ""]
    assert one(spark, columns.widen(cells("a", "b", "c"), 3, 1, F.lit(True), "Name"), s="") == ["a", "Name", "b", "c"]
    rows = spark.createDataFrame([(" a\n", "", 1)], "x string, y string, n int")
    assert tuple(columns.clean_cells(rows).first()) == ("a", "", 1)
    assert rows.select(columns.default("y", "0")).first()[0] == "0"
    assert columns.keep_or_drop(rows, keep=["n", "zz"]).columns == ["n"] and columns.keep_or_drop(rows, drop=["n"]).columns == ["x", "y"]
    with pytest.raises(ValueError):
        columns.keep_or_drop(rows, ["x"], ["y"])
    assert columns.promote(rows, ["n"]).columns == ["n", "x", "y"]
    over = spark.createDataFrame([(1, ("new", "z")), (2, None)], "n int, record struct<x:string,y:string>")
    many = spark.createDataFrame([("a", "b", 1), ("c", "d", 2), ("e", "f", 3)], "x string, y string, n int")
    assert sorted(map(tuple, columns.override_records(many, over, "n").collect())) == [("e", "f", 3), ("new", "z", 1)]
    good, bad = columns.enrich_or_fail(many, spark.createDataFrame([(1, "S")], "n int, state string"), "n", {"state_name": "state"})
    assert [r.state_name for r in good.collect()] == ["S"] and sorted(r.n for r in bad.collect()) == [2, 3]


def test_filters(spark):
    assert one(spark, filters.total_row(cells("Grand Total", "1")), s="") and not one(spark, filters.total_row(cells("Totally" [:3], "1")), s="")
    assert one(spark, filters.closing_total(cells("a Total", ""), F.lit(2), F.lit(3)), s="") and not one(spark, filters.closing_total(cells("a Total", ""), F.lit(1), F.lit(3)), s="")
    assert one(spark, filters.section_row(cells("North", "", "")), s="") and not one(spark, filters.section_row(cells("", "", "")), s="")
    assert one(spark, filters.header_row(cells("State Name", "x"), ["state"]), s="") and one(spark, filters.holds(cells("a", "see http://x"), ["http"]), s="")
    assert one(spark, filters.ends_with_word(F.lit("Foo district"), "District"), s="") and not one(spark, filters.ends_with_word(F.lit("Subdistrict"), "District"), s="")
    assert one(spark, filters.of_release(F.lit("reg-extra1"), "reg"), s="") and not one(spark, filters.of_release(F.lit("regx"), "reg"), s="")


# Joins


def test_joins(spark):
    parents = spark.createDataFrame([("1", "A"), ("2", "B")], "code string, pname string")
    kids = spark.createDataFrame([("x", "1"), ("y", "9"), ("z", None)], "kid string, code string")
    good, bad = joins.to_parent(kids, parents, ["code"])
    assert [r.kid for r in good.collect()] == ["x"] and sorted(r.kid for r in bad.collect()) == ["y", "z"]
    paths = spark.createDataFrame([("b1", "s1", "d1"), ("b1", "s1", "d2")], "block string, s string, d string")
    rows = spark.createDataFrame([("b1", "s1", "d2"), ("b1", "s2", "d2"), ("b9", "s1", "d1")], "block string, s string, d string")
    assert sorted((r.block, r.s, r.known, r.matches) for r in joins.on_path(rows, paths, "block", ["s", "d"]).collect()) == [("b1", "s1", True, True), ("b1", "s2", True, False), ("b9", "s1", False, False)]
    with pytest.raises(Exception, match="no partner"):
        joins.required(kids, parents, ["code"]).collect()
    uneven = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")], "s string, pos int, v string")
    with pytest.raises(ValueError):
        joins.zipped(uneven, "s", "pos", ["v"])
    left = spark.createDataFrame([(0, ["a"]), (1, ["b"])], "pos int, cells array<string>")
    assert sorted(r.cells for r in joins.side_by_side(left, left).collect()) == [["a", "", "a"], ["b", "", "b"]]
    with pytest.raises(Exception, match="other lengths"):
        joins.side_by_side(left, left.where("pos = 0")).collect()


# Ordered rows, sets, aggregates


def test_ordered(spark):
    rows = spark.createDataFrame([("f", 0, ""), ("f", 1, "a"), ("f", 2, ""), ("g", 0, "b")], "file string, pos int, v string")
    got = ordered.forward_fill(rows, "v", ["file"], ["pos"], F.col("v") == "").collect()
    assert sorted((r.file, r.pos, r.v, r.unfilled) for r in got) == [("f", 0, "", True), ("f", 1, "a", False), ("f", 2, "a", False), ("g", 0, "b", False)]
    page = spark.createDataFrame([(0, ["x", "1"])], "pos int, cells array<string>")
    assert sorted((r.pos, r.cells) for r in ordered.ensure_header(page, ["Name", "ID"]).collect()) == [(-1, ["Name", "ID"]), (0, ["x", "1"])]
    headed = spark.createDataFrame([(0, ["Name", "ID"]), (1, ["x", "1"])], "pos int, cells array<string>")
    assert ordered.ensure_header(headed, ["Name", "ID"]).count() == 2
    names = spark.createDataFrame([("reg-extra10",), ("reg",), ("reg-extra2",), ("reg-odd",)], "n string")
    assert [r.n for r in names.orderBy(*ordered.release_order(F.col("n"))).collect()] == ["reg", "reg-extra2", "reg-extra10", "reg-odd"]


def test_snapshots(spark):
    old = spark.createDataFrame([("a", "op1", "d1"), ("b", "op2", "d1")], "k string, op string, date string")
    new = spark.createDataFrame([("a", "op1", "d2"), ("c", "op1", "d2")], "k string, op string, date string")
    may = F.lower("op") == "op2"
    assert sorted(map(tuple, sets.merge_snapshots(old, new, "date", may).collect())) == [("a", "op1", "d1"), ("b", "op2", "d1"), ("c", "op1", "d2")]
    with pytest.raises(sets.Vanished):
        sets.merge_snapshots(old, new, "date", F.lit(False))
    with pytest.raises(ValueError):
        sets.merge_snapshots(old, new.withColumnRenamed("op", "operator"), "date", may)
    a = spark.createDataFrame([("x", ["2"])], "comp string, dates array<string>")
    b = spark.createDataFrame([("x", ["1", "2"]), ("y", ["3"])], "comp string, dates array<string>")
    assert {r.comp: r.dates for r in sets.extend_dates(a, b, "comp").collect()} == {"x": ["1", "2"], "y": ["3"]}
    doc = one(spark, sets.json_paths(F.lit('{"a": {"b": "1", "c": {"d": "2"}}, "e": "3"}')), s="")
    assert sorted((p.path, p.value) for p in doc) == [("a.b", "1"), ("a.c.d", "2"), ("e", "3")]


def test_pivot_takes_the_first_files_keys(spark):
    rows = spark.createDataFrame([("f1", 0, "agency", "A"), ("f1", 1, "phone", "1"), ("f2", 0, "phone", "2"), ("f2", 1, "other", "3")], "file string, pos int, k string, v string")
    got = aggregates.key_value_pivot(rows, "file", "k", "v", "pos")
    assert got.columns == ["file", "agency", "phone"] and sorted(map(tuple, got.collect())) == [("f1", "A", "1"), ("f2", None, "2")]
    seen, count = aggregates.observed(rows, "rows")
    seen.collect()
    assert count.get["rows"] == 4


# Validation


def kinds(frame):
    return sorted((r.kind, r.key) for r in frame.collect())


def test_child_table(spark):
    parents = spark.createDataFrame([("1", "NORTH"), ("2", "SOUTH")], "state string, state_name string")
    kids = spark.createDataFrame(
        [(1, "01", "A", "1", "NORTH"), (2, "02", "A", "1", "NORTH"), (3, "01", "B", "1", "NORTH"), (4, "03", "C", "9", "NORTH"), (5, "04", "D", "2", "NORTH"), (6, "01", "A", "1", "NORTH"), (7, "05", "A", "2", "SOUTH")],
        "pos int, code string, name string, state string, state_name string",
    )
    good, bad = validate.child_table(kids, "district", "code", ["pos"], parents, "state", {"state_name": "state_name"}, "name", ["state"])
    assert sorted(r.pos for r in good.collect()) == [1, 7]
    assert kinds(bad) == [("code_repeat", "01"), ("code_repeat", "01"), ("name_repeat", "02"), ("state_name_mismatch", "04"), ("unknown_parent", "03")]
    assert good.count() + bad.count() == kids.count()
    assert '"pos":1' in next(r.prev for r in bad.collect() if r.kind == "name_repeat")


def test_spanning_table_and_mapping(spark):
    parents = spark.createDataFrame([("d1", "s1"), ("d2", "s1")], "d string, s string")
    blocks = spark.createDataFrame([(1, "b1", "B", "d1", "s1"), (2, "b1", "B", "d2", "s1"), (3, "b1", "B2", "d1", "s1"), (4, "b2", "X", "d1", "s9")], "pos int, b string, name string, d string, s string")
    good, bad, paths = validate.spanning_table(blocks, "block", "b", ["s", "d"], ["pos"], parents, "d", {"s": "s"}, "name", ["d"])
    assert sorted(r.pos for r in good.collect()) == [1, 2] and paths.count() == 2 and kinds(bad) == [("code_repeat", "b1"), ("s_mismatch", "b2")]
    villages = spark.createDataFrame([("v1", "s1", "d1"), ("v2", "s1", "d2"), ("v3", "s1", "d1")], "v string, s string, d string")
    rows = spark.createDataFrame(
        [(1, "v1", "n", "s1", "d1", "b1", "g1"), (2, "v1", "n", "s1", "d1", "b1", "g1"), (3, "v1", "n", "s1", "d1", "b1", "g2"), (4, "v9", "n", "s1", "d1", "b1", "g1"), (5, "v2", "n", "s1", "d1", "b1", "g1"), (6, "v3", "n", "s1", "d1", "", "g1"), (7, "", "", "s1", "d1", "b1", "g1")],
        "pos int, v string, vn string, s string, d string, b string, g string",
    )
    ok, out = validate.member_mapping(rows, "vb", "v", villages, ["s", "d"], ["pos"], "b", paths, ["s", "d"], body="g", name="vn")
    assert [r.pos for r in ok.collect()] == [1] and kinds(out) == [("member_repeat", "v1"), ("no_group", "v3"), ("path_mismatch", "v2"), ("unknown_member", "v9")]


def test_attach_and_messages(spark):
    rows = spark.createDataFrame([(1, "u1", "d1", "", ""), (2, "u1", "d1", "s1", "v1"), (3, "u2", "d1", "s1", "v1"), (4, "u3", "", "", "")], "pos int, u string, d string, s string, v string")
    ok, out = validate.attach_deepest(rows, "ulb", "u", {"district": "d", "subdistrict": "s", "village": "v"}, "village", ["pos"])
    assert sorted((r.pos, r.level, r["code"]) for r in ok.collect()) == [(1, "district", "d1"), (2, "village", "v1")]
    assert kinds(out) == [("leaf_in_two_bodies", "u2"), ("no_level", "u3")]
    assert one(spark, validate.required_cells(cells("", "a", ""), [0, 1, 2]), s="") == ["col 0 is empty", "col 2 is empty"]
    assert one(spark, validate.required_cells(cells("", ""), [0, 1]), s="") == [] and one(spark, validate.required_cells(cells("", ""), [0], False), s="") == ["col 0 is empty"]
    assert one(spark, validate.must_be_empty(cells("a", "x"), [1]), s="") == ["col 1 expected to be empty"]
    assert len(one(spark, validate.all_or_none(cells("a", ""), [0, 1]), s="")) == 1 and one(spark, validate.all_or_none(cells("", ""), [0, 1]), s="") == []
    assert one(spark, validate.required_if_any(cells("a", "", "x"), [1], 2), s="") == ["col 1 is empty"]
    good, bad = validate.must_exist(spark.createDataFrame([("1", "3"), ("2", "3"), ("9", "1")], "c string, t string"), "body", "c", spark.createDataFrame([("1",)], "c string"), F.col("t") == "3")
    assert good.count() == 1 and kinds(bad) == [("unknown_code", "2")]
    pages = spark.createDataFrame([("a", 0), ("a", 1), ("b", 0)], "doc string, page int")
    assert [r.doc for r in validate.expected_counts(pages, "doc", spark.createDataFrame([("a", 2), ("b", 2)], "doc string, pages int")).collect()] == ["b"]


# Hierarchies and plans


def test_closure_with_a_cycle(spark):
    edges = spark.createDataFrame([(2, 1), (3, 2), (1, 3), (9, 8)], "src int, dst int")
    got = hierarchy.closure(edges, spark.createDataFrame([(1,)], "node int")).collect()
    assert {r.node: r.depth for r in got} == {1: 0, 2: 1, 3: 2}


def test_undo(spark):
    rows = spark.createDataFrame([("s1", "", "", "NA"), ("s1", "", "", ""), ("s2", "", "", ""), ("s1", "d1", "", ""), ("s2", "d2", "v1", "77"), ("", "", "", ""), ("s2", "d2", "v2", "")], "state string, dist string, village string, reg string")
    got = hierarchy.undo(rows, {"state": spark.createDataFrame([("s1",)], "id string"), "village": spark.createDataFrame([("v1",), ("v2",)], "id string")}, "reg", ["state", "dist", "village"])
    assert sorted(map(tuple, got.collect())) == [("s1", "d1", "", ""), ("s2", "", "", ""), ("s2", "d2", "v1", "77")]
    done = hierarchy.done_ids(rows, {"state": "state", "dist": "dist", "village": "village"}).collect()
    assert {(r.level, r.id) for r in done} == {("state", "s1"), ("state", "s2"), ("dist", "d1"), ("village", "v1"), ("village", "v2")}


def test_packing():
    placed, counts = hierarchy.pack(["a", "b", "c"], {"rel": 1}, {"rel": 2}, 1, "rel")
    assert placed == {"a": "rel", "b": "rel-extra1", "c": "rel-extra2"} and counts == {"rel": 2, "rel-extra1": 1, "rel-extra2": 1}
    assert hierarchy.rebalance({"r": ["x"], "e1": ["y"], "e2": ["z"]}, {"r": 2, "e1": 2, "e2": 2}) == [("z", "e2", "r")]


def test_selection():
    needs = {"c": ["b"], "b": ["a"], "x": ["y"], "y": ["x"]}
    assert selection.select_components("abc", exclude=["b"]) == {"a", "c"} and selection.with_dependencies(["c"], needs) == {"a", "b", "c"}
    assert selection.with_dependencies(["x"], needs) == {"x", "y"} and selection.excluded_but_needed(["c"], ["a"], needs) == {"a"}
    assert selection.run_order("abc", needs) == [["a"], ["b"], ["c"]]
    for bad in (dict(include=["a"], exclude=["b"]), dict(include=["zz"])):
        with pytest.raises(ValueError):
            selection.select_components("abc", **bad)
