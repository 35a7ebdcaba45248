"""Files: CSV, JSON, spreadsheets, text documents, pages; writers; increments."""

import datetime
import io
import json
import os
import zipfile

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tabwright.sources import documents, sinks, tables
from tabwright.streaming import incremental


def write(path, content):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as file:
        file.write(content if isinstance(content, bytes) else content.encode())
    return str(path)


def test_header_csv(spark, tmp_path):
    path = write(f"{tmp_path}/x/a.csv", 'Sub District Code;Name  (In\nEnglish) \n01695;"Ziro; HQ"\n"";\n'.replace("Name  (In\nEnglish) ", '"Name  (In\nEnglish) "'))
    rows = tables.read_csv(spark, path, ";", {"Sub District Code": "code"})
    assert rows.columns == ["code", "Name (In English)"]
    assert [tuple(r) for r in rows.collect()] == [("01695", "Ziro; HQ"), ("", "")]
    with pytest.raises(AnalysisException):
        tables.read_csv(spark, f"{tmp_path}/nothing.csv")


def test_keyed_and_recursive_csv(spark, tmp_path):
    path = write(f"{tmp_path}/d/s1/t1/p.csv", "k,v\n1,a\n2,b\n1,c\n")
    write(f"{tmp_path}/d/s2/t1/p.csv", "k,v\n3,d\n")
    assert sorted(map(tuple, tables.keyed_csv(spark, path, "k", F.col("v") != "b").collect())) == [("1", "c")]
    both = tables.read_csv(spark, f"{tmp_path}/d", recursive=True).withColumn("file", F.input_file_name())
    named = tables.with_path_columns(both, {"state": 2, "type": 1, "page": 0}, ["v"])
    assert named.columns == ["state", "type", "page", "v", "k"] and {r.state for r in named.collect()} == {"s1", "s2"}


def test_positional_cells_and_headers(spark, tmp_path):
    path = write(f"{tmp_path}/c/page 1.csv", 'State,,\nName,"GP\nID",x\na,"1,5"\nb,2,3,4\n')
    rows = tables.read_cells(spark, path)
    assert [r.cells for r in rows.orderBy("pos").collect()] == [["State", "", ""], ["Name", "GP\nID", "x"], ["a", "1,5"], ["b", "2", "3", "4"]]
    named = tables.with_header(rows, 2)
    assert named.columns == ["State Name", "GP ID", "x"] and sorted(map(tuple, named.collect())) == [("a", "1,5", ""), ("b", "2", "3")]
    assert tables.with_header(rows.limit(0)).columns == []
    with pytest.raises(ValueError):
        tables.with_header(rows, 0)


def test_json_lists_and_catalogs(spark, tmp_path):
    write(f"{tmp_path}/j/S 1/D1/1.json", json.dumps([{"a": "1"}, {"a": "2"}]))
    rows = tables.with_path_columns(tables.read_json(spark, f"{tmp_path}/j/*/*/*.json", "a string"), {"state": 2, "district": 1})
    assert sorted(map(tuple, rows.collect())) == [("S 1", "D1", "1"), ("S 1", "D1", "2")]
    for name in ("30Apr2024", "02May2024", "notes"):
        os.makedirs(f"{tmp_path}/snap/{name}")
    assert tables.latest_folder(spark, f"file://{tmp_path}/snap").endswith("/02May2024")
    assert tables.latest_folder(spark, f"file://{tmp_path}/snap/notes") is None
    listing = write(f"{tmp_path}/l/listing.csv", "name,size,url\nblocks.09May2024.csv.7z,10,u1\nblocks.Apr2024.7z,20,u2\nchanges.csv,5,u3\n")
    got = {r.name: (r.component, r.date, str(r.day), r.monthly, r["size"]) for r in tables.read_listing(spark, listing).collect()}
    assert got == {"blocks.09May2024.csv.7z": ("blocks", "09May2024", "2024-05-09", False, 10), "blocks.Apr2024.7z": ("blocks", "Apr2024", "2024-04-01", True, 20), "changes.csv": ("changes", None, "None", False, 5)}
    site = write(f"{tmp_path}/s/map.json", json.dumps([{"comp": "A", "file": "a", "desc": "d", "fields": {"x": {"description": "an x"}}}, {"comp": "IGNORE", "file": "b"}, {"file": "c"}, {"comp": "IGNORE", "file": "e", "fields": {"y": {"description": ""}}}]))
    assert [r.comp for r in tables.read_site_map(spark, site).collect()] == ["A"]
    assert sorted(r.file for r in tables.read_site_map(spark, site, by_file=True).collect()) == ["a", "e"]
    assert "| x | an x |" in sinks.data_dictionary(tables.read_site_map(spark, site)).first()["markdown"]
    assert sorted(map(tuple, tables.literal_table(spark, "S. No.\tName\n1\ta\n2").collect())) == [("1", "a"), ("2", "")]
    lines = write(f"{tmp_path}/i/ignore.txt", " a \n\nb\na\n")
    assert sorted(r.line for r in tables.read_lines(spark, lines).collect()) == ["a", "b"]


def test_named_transforms(spark):
    rows = spark.createDataFrame([("", 1), ("x", 2)], "f string, n int")
    assert tables.named_transform("ignore_if_empty_field", "f")(rows).count() == 1 and tables.named_transform("identity")(rows).count() == 2
    with pytest.raises(KeyError):
        tables.named_transform("nothing")


SS = """<?xml version="1.0"?><Workbook xmlns="urn:schemas-microsoft-com:office:spreadsheet" xmlns:ss="urn:schemas-microsoft-com:office:spreadsheet"><Worksheet><Table>
<Row><Cell><Data>only one</Data></Cell></Row><Row><Cell><Data>Code</Data></Cell><Cell><Data>Name</Data></Cell><Cell><Data>Z</Data></Cell></Row>
<Row><Cell><Data>01</Data></Cell><Cell ss:Index="3"><Data>z</Data></Cell></Row><Row><Cell/><Cell/></Row></Table></Worksheet></Workbook>"""


def package(**members):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, content in members.items():
            z.writestr(name.replace("__", "/").replace("_dot_", "."), content)
    return out.getvalue()


def test_spreadsheets(spark, tmp_path):
    write(f"{tmp_path}/x/a.xls", SS)
    rows = documents.read_documents(spark, f"{tmp_path}/x", documents.spreadsheet_xml)
    assert [r.cells for r in rows.orderBy("row").collect()] == [["Code", "Name", "Z"], ["01", "", "z"]]
    assert sorted(map(tuple, tables.with_header(rows, 1, order="row").collect())) == [("01", "", "z")]
    xl = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    book = package(
        xl__sharedStrings_dot_xml=f"<sst {xl}><si><t>Code</t></si><si><r><t>Na</t></r><r><t>me</t></r></si></sst>",
        xl__worksheets__sheet1_dot_xml=f'<worksheet {xl}><sheetData><row><c r="A1" t="s"><v>0</v></c><c r="C1" t="s"><v>1</v></c></row><row><c r="A2"><v>12</v></c><c r="B2" t="inlineStr"><is><t>in</t></is></c></row></sheetData></worksheet>',
        docProps__core_dot_xml='<c xmlns:dcterms="http://purl.org/dc/terms/"><dcterms:modified>2024-05-09T00:00:00Z</dcterms:modified></c>',
    )
    assert list(documents.workbook(book)) == [(0, ["Code", "", "Name"]), (0, ["12", "in"])]
    assert documents.workbook_modified(book) == "2024-05-09T00:00:00Z"
    assert documents.single_member(package(a_dot_txt="x")) == b"x"
    with pytest.raises(ValueError):
        documents.single_member(package(a="x", b="y"))


def test_text_documents(spark, tmp_path):
    row = lambda *c: "<table:table-row>" + "".join(c) + "</table:table-row>"
    cell = lambda t, extra="": f"<table:table-cell {extra}><text:p>{t}</text:p></table:table-cell>"
    table = lambda *r: "<table:table>" + "".join(r) + "</table:table>"
    head = row(cell("H1"), cell("H2"))
    body = "".join([table(row(cell("skip"), cell("me"))), table(row(cell("and"), cell("me"))), table(head, row(cell("a", 'table:number-columns-repeated="2"')), row(cell(""))), table(head, row(cell("#note"), cell("b"), cell("c", 'table:number-columns-spanned="2"'), "<table:covered-table-cell/>"))])
    xml = f'<d xmlns:table="urn:oasis:names:tc:opendocument:xmlns:table:1.0" xmlns:text="urn:oasis:names:tc:opendocument:xmlns:text:1.0">{body}</d>'
    write(f"{tmp_path}/o/a.odt", package(content_dot_xml=xml))
    rows = documents.tables_between(documents.read_documents(spark, f"{tmp_path}/o", documents.text_document), "file", 2, 0)
    assert [r.cells for r in rows.orderBy("row").collect()] == [["H1", "H2"], ["a", "a"], ["b", "c", "c"]]


PAGE = """<html><script>var x="<table>";</script><table id="t1"><tr><th>Code</th><th>Name</td></tr><tr><td><div>1</div></td><td><div>a &amp; b</div><div style="visibility: hidden">no</div><div>c</div></td></tr><tr><td>one</td></tr></table>
<table id="t2"><tr id="hab"><td>Effective Date</td><td>09/05/2024</td></tr></table><form><input type="hidden" name="tok" value="v"></form></html>"""


def test_pages(spark):
    pages = spark.createDataFrame([(1, PAGE), (2, None), (3, "no tables")], "page_id int, html string").withColumn("html", documents.repair_html(F.col("html")))
    got = documents.decoded(pages, "page_id", "html", lambda h: documents.page_tables(h, "t1"))
    assert [(r.page_id, r.cells) for r in got.orderBy("row").collect()] == [(1, ["Code", "Name"]), (1, ["1", "a & b\nc"])]
    assert documents.labelled_value(PAGE, "Effective Date") == "09/05/2024" and documents.labelled_value(PAGE, "x y") is None
    assert documents.hidden_fields(PAGE) == {"tok": "v"}
    assert documents.profile(PAGE, {"hab": "dates"}) == {"dates": ["Effective Date", "09/05/2024"]}
    with pytest.raises(ValueError):
        documents.profile(PAGE, {"other": "x"})
    two = "<table><tr><th rowspan=2>Name</th><th colspan=2>Water</th></tr><tr><th>pH</th><th>Iron</th></tr><tr><td>n</td><td>7</td><td>0</td></tr></table>"
    assert documents.two_level_table(two) == [{"Name": {"Name": "n"}, "Water": {"pH": "7", "Iron": "0"}}]
    text = spark.range(1).select(documents.postback_triples(F.lit("9|x|hiddenField|__VS|abc|hiddenField|__EV||")).alias("m")).first()["m"]
    assert text == {"__VS": "abc", "__EV": ""}


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("k1", "a;b", ""), ("k2", 'say "x"', "z")], "k string, v string, w string")
    sinks.write_csv(rows, f"{tmp_path}/out", ";")
    assert sorted(map(tuple, tables.read_csv(spark, f"{tmp_path}/out", ";").collect())) == sorted(map(tuple, rows.collect()))
    sinks.convert_delimiter(spark, f"{tmp_path}/out", f"{tmp_path}/comma")
    assert sorted(map(tuple, tables.read_csv(spark, f"{tmp_path}/comma").collect())) == sorted(map(tuple, rows.collect()))
    issues = spark.createDataFrame([("b", '{"x":2}'), ("a", '{"x":1}'), ("b", '{"x":1}')], "kind string, payload string")
    assert {r.kind: json.loads(r.json) for r in sinks.report_json(issues).collect()} == {"a": [{"x": 1}], "b": [{"x": 1}, {"x": 2}]}
    errors = spark.createDataFrame([("0", 1, "m2"), ("0", 1, "m1"), ("2", 5, "m")], "page string, row int, message string")
    assert {r.page: json.loads(r.json) for r in sinks.errors_json(errors).collect()} == {"0": {"1": ["m1", "m2"]}, "2": {"5": ["m"]}}
    ledger = spark.createDataFrame([("k1",)], "k string")
    written = sinks.append_unseen(rows, ledger, ["k"], f"{tmp_path}/app")
    assert [r.k for r in written.collect()] == ["k2"]
    assert sinks.missing_inputs(rows, ledger, "k") == ["k2"]
    rows.write.parquet(f"{tmp_path}/new")
    sinks.replace_path(spark, f"{tmp_path}/new", f"{tmp_path}/final")
    assert spark.read.parquet(f"{tmp_path}/final").count() == 2
    lines = sinks.quick_statements(issues, {"a": F.concat_ws(",", F.lit("Q1"), "payload")})
    assert [r.line for r in lines.collect()] == ['Q1,{"x":1}']


def test_increments(spark, tmp_path):
    covered = spark.createDataFrame([("2024-05-08",)], "date string")
    due = incremental.due_dates(spark, "2024-05-09", 3, covered).orderBy("date").collect()
    assert [(str(r.date), str(r["from"])) for r in due] == [("2024-05-07", "2024-05-06"), ("2024-05-09", "2024-05-08")]
    rows = spark.createDataFrame([("1", "d1"), ("2", "d1"), ("2", "d1")], "id string, date string")
    target, ledger = f"{tmp_path}/t", f"{tmp_path}/l"
    assert incremental.load_batch(rows, target, ledger, ["id"], "date") == 2 and incremental.load_batch(rows, target, ledger, ["id"], "date") == 0
    assert spark.read.parquet(target).count() == 2 and spark.read.parquet(ledger).count() == 1
    made = []
    make = lambda: made.append(1) or rows
    assert incremental.memoised(spark, f"{tmp_path}/m", make).count() == 3 and incremental.memoised(spark, f"{tmp_path}/m", make).count() == 3 and made == [1]
    cache = spark.createDataFrame([("1", "one")], "id string, v string")
    both, fresh = incremental.through_cache(spark.createDataFrame([("1",), ("2",)], "id string"), cache, lambda ids: ids.withColumn("v", F.lit("new")), "id")
    assert sorted(map(tuple, both.collect())) == [("1", "one"), ("2", "new")] and fresh.count() == 1
    names = spark.createDataFrame([("a.csv",), ("changes.csv",), ("b.csv",)], "name string")
    assert sorted(r.name for r in incremental.to_publish(names, names.where("name <> 'b.csv'")).collect()) == ["b.csv", "changes.csv"]
    old = spark.createDataFrame([(1, '{"a":1,"b":2}'), (2, '{"a":1}')], "id int, doc string")
    new = spark.createDataFrame([(1, '{"b": 2, "a": 1}'), (2, '{"a":2}'), (3, "{}")], "id int, doc string")
    assert sorted(r.id for r in incremental.changed_documents(old, new, "id", "doc").collect()) == [2, 3]


def test_streams(spark, tmp_path):
    folder = f"{tmp_path}/in"
    write(f"{folder}/1.json", '{"id":"1","date":"d1"}\n{"id":"2","date":"d1"}\n')
    schema = "id string, date string"
    run = lambda: incremental.stream_into(incremental.stream_json(spark, folder, schema), f"{tmp_path}/t", f"{tmp_path}/l", f"{tmp_path}/c", ["id"], "date")
    run()
    write(f"{folder}/2.json", '{"id":"2","date":"d2"}\n{"id":"3","date":"d2"}\n')
    run()
    run()
    assert sorted(r.id for r in spark.read.parquet(f"{tmp_path}/t").collect()) == ["1", "2", "3"] and sorted(r.date for r in spark.read.parquet(f"{tmp_path}/l").collect()) == ["d1", "d2"]
    seen = incremental.stream_first_seen(incremental.stream_json(spark, folder, schema), ["id"], "date")
    query = seen.writeStream.format("memory").queryName("seen").outputMode("complete").trigger(availableNow=True).start()
    query.awaitTermination()
    assert {r.id: r.date for r in spark.table("seen").collect()} == {"1": "d1", "2": "d1", "3": "d2"}
    write(f"{tmp_path}/ev/1.json", "\n".join(json.dumps({"ts": f"2024-01-01T0{h}:30:00", "t": "a"}) for h in (1, 1, 2, 9)))
    events = incremental.stream_json(spark, f"{tmp_path}/ev", "ts timestamp, t string")
    query = incremental.windowed_counts(events, "ts", "t").writeStream.format("memory").queryName("win").outputMode("append").option("checkpointLocation", f"{tmp_path}/wc").trigger(availableNow=True).start()
    query.awaitTermination()
    got = {(r.start, r.n) for r in spark.table("win").collect()}
    assert (datetime.datetime(2024, 1, 1, 1), 2) in got and all(s < datetime.datetime(2024, 1, 1, 9) for s, _ in got)
