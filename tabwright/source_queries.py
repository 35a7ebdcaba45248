"""Queries of the readers, writers and increments: each lands files of the driver's tables in the shared folder and reads them
back, so that a row that a reader or writer loses, doubles or spells otherwise is missing from the result."""

from __future__ import annotations

import io
import zipfile
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from tabwright.operators import filters, ordered, sets
from tabwright.registry import big, load, query
from tabwright.session import scratch_dir
from tabwright.sources import documents, sinks, tables
from tabwright.streaming import incremental


def _text(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")


def _under(parts: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [rows.select(F.lit(name).alias("of"), *rows.columns) for name, rows in parts.items()])


def _put(lines: DataFrame, folder: str) -> str:
    """One text file of each row's ``value`` (its own line ends inside), in one folder for each ``name``; returns the folder."""
    lines.select("name", "value").repartition("name").write.partitionBy("name").option("lineSep", "\n").text(folder)
    return folder


# Tabular files


@query("SELECT n_nationkey, n_name, 'a;b, ' || n_nationkey AS note, CASE WHEN n_nationkey % 2 = 0 THEN '' ELSE '0' || n_nationkey END AS code FROM nation")
def delimited_round_trip(spark, d):
    """Semicolons with untidy headers, read, converted to commas and read again; codes keep their zeros, empty stays empty."""
    folder, n = scratch_dir(spark, "csv"), _text("n_nationkey")
    rows = load(spark, d, "nation").select(n.alias("Nation  Key "), F.col("n_name").alias("Name (In\nEnglish)"), F.concat(F.lit("a;b, "), n).alias(" note"), F.when(F.col("n_nationkey") % 2 == 0, "").otherwise(F.concat(F.lit("0"), n)).alias("code"))
    sinks.write_csv(rows, f"{folder}/semicolon", ";")
    sinks.convert_delimiter(spark, f"{folder}/semicolon", f"{folder}/comma")
    aliases = {"Nation Key": "n_nationkey", "Name (In English)": "n_name"}
    one, two = tables.read_csv(spark, f"{folder}/semicolon", ";", aliases), tables.read_csv(spark, f"{folder}/comma", ",", aliases)
    return one.intersect(two).select(F.col("n_nationkey").cast("int"), "n_name", "note", "code")


@query("SELECT c_nationkey, CAST(max(c_custkey) AS BIGINT) AS c_custkey FROM customer WHERE c_custkey % 3 <> 0 GROUP BY 1")
def keyed_rows(spark, d):
    """Of the rows that are let through, the last in the file for each key."""
    folder = scratch_dir(spark, "keyed")
    rows = load(spark, d, "customer").coalesce(1).sortWithinPartitions("c_custkey").select(_text("c_nationkey").alias("k"), _text("c_custkey").alias("v"))
    sinks.write_csv(rows, f"{folder}/one", single=True)
    return tables.keyed_csv(spark, f"{folder}/one", "k", F.col("v").cast("int") % 3 != 0).select(F.col("k").cast("int").alias("c_nationkey"), big("v").alias("c_custkey"))


@query("SELECT 'region ' || n_regionkey AS region, n_name, n_nationkey, n_nationkey * 2 AS twice FROM nation")
def partitioned_files(spark, d):
    """One folder for each region, found at any depth; the region comes from the path, promoted columns come first."""
    folder = scratch_dir(spark, "tree")
    rows = load(spark, d, "nation").select(F.concat(F.lit("region "), "n_regionkey").alias("of"), _text("n_nationkey").alias("key"), (F.col("n_nationkey") * 2).cast("string").alias("twice"), F.col("n_name").alias("name"))
    rows.repartition("of").write.partitionBy("of").option("header", True).csv(f"{folder}/a/b")
    read = tables.read_csv(spark, f"{folder}/a", recursive=True).withColumn("file", F.input_file_name())
    named = tables.with_path_columns(read, {"region": 1}, ["name"])
    return named.select(F.regexp_replace("region", "^of=", "").alias("region"), F.col("name").alias("n_name"), F.col("key").cast("int").alias("n_nationkey"), F.col("twice").cast("int").alias("twice"))


@query("""
    SELECT 'N' || n_nationkey AS code, n_name AS name, 80 AS wide, 'v' || n_nationkey || chr(10) || '"w"' AS last, CASE WHEN n_nationkey % 3 = 0 THEN '' ELSE 'x' END AS short FROM nation""")
def positional_cells(spark, d):
    """Rows of 80 cells with quoted line ends under two lines of notes and a header of two rows; some rows are short."""
    folder, n = scratch_dir(spark, "cells"), F.col("n_nationkey")
    row = lambda first, second, third: F.concat(first, F.lit(","), second, F.lit("," * 78), third)
    head = F.concat(F.lit("note\nmore, notes\n"), row(F.lit("Co"), F.lit("Na"), F.lit("la")), F.lit("\n"), row(F.lit("de"), F.lit("me"), F.lit("st")), F.lit("\n"))
    body = F.concat(row(F.concat(F.lit("N"), n), F.col("n_name"), F.concat(F.lit('"v'), n, F.lit('\n""w"""'))), F.when(n % 3 == 0, F.concat(F.lit("\nS"), n)).otherwise(F.concat(F.lit("\nS"), n, F.lit(",x"))))
    pages = load(spark, d, "nation").select(F.concat(F.lit("p"), n).alias("name"), F.concat(head, body).alias("value"))
    rows = tables.read_cells(spark, _put(pages, f"{folder}/pages")).withColumn("page", tables.path_part(F.col("file"), 1))
    parts = []
    for page in ("name=p0", "name=p1"):  # a page's own header names its columns
        one = tables.skip_then_header(rows.where(F.col("page") == page), 2, 2)
        parts.append(one.select("Co de", "Na me", "la st").where("`la st` != ''"))
    named = parts[0].unionByName(parts[1])
    own = rows.where("pos >= 4").withColumn("code", F.col("cells")[0])
    full = own.where("size(cells) = 80").select("page", F.col("code"), F.col("cells")[1].alias("name"), F.size("cells").alias("wide"), F.col("cells")[79].alias("last"))
    short = own.where("size(cells) < 80").select("page", F.coalesce(F.try_element_at("cells", F.lit(2)), F.lit("")).alias("short"))
    met = full.join(short, "page")
    held = named.select(F.col("Co de").alias("code"), F.col("Na me").alias("by_head"), F.col("la st").alias("last_by_head"))
    # Where a page was read by its header too, that reading counts.
    both = met.join(held, "code", "left")
    return both.select("code", F.coalesce("by_head", "name").alias("name"), "wide", F.coalesce("last_by_head", "last").alias("last"), "short")


@query("""
    SELECT 'array' AS of, CAST(n_regionkey AS VARCHAR) AS place, n_name AS v FROM nation UNION ALL SELECT 'lines', CAST(n_regionkey AS VARCHAR), n_name FROM nation UNION ALL
    SELECT 'listed', '', 'r' || n_regionkey FROM nation GROUP BY n_regionkey UNION ALL SELECT 'latest', '', '02May2024' UNION ALL SELECT 'literal', '1', 'a' UNION ALL SELECT 'literal', '2', ''""")
def json_and_lists(spark, d):
    folder = scratch_dir(spark, "json")
    nation = load(spark, d, "nation").select(_text("n_regionkey").alias("name"), F.struct(F.col("n_name").alias("v")).alias("r"))
    _put(nation.groupBy("name").agg(F.to_json(F.collect_list("r")).alias("value")), f"{folder}/arrays")
    sinks.append_json(nation.select(F.col("name").alias("place"), F.col("r.v").alias("v")).where("v < 'NATION_2'"), f"{folder}/lines")
    sinks.append_json(nation.select(F.col("name").alias("place"), F.col("r.v").alias("v")).where("v >= 'NATION_2'"), f"{folder}/lines")
    nation.select(F.concat(F.lit(" r"), "name", F.lit(" \n\n")).alias("value")).write.text(f"{folder}/list")
    for name in ("30Apr2024", "02May2024", "not a date"):
        nation.limit(1).select("name").write.mode("overwrite").text(f"{folder}/days/{name}")
    arrays = tables.with_path_columns(tables.read_json(spark, f"{folder}/arrays/*/*", "v string"), {"place": 1}).withColumn("place", F.regexp_replace("place", "name=", ""))
    lines = tables.read_json(spark, f"{folder}/lines", "place string, v string", lines=True).drop("file")
    return _under({
        "array": arrays.select("place", "v"), "lines": lines, "listed": tables.read_lines(spark, f"{folder}/list").select(F.lit("").alias("place"), F.col("line").alias("v")),
        "latest": spark.range(1).select(F.lit("").alias("place"), F.lit(tables.latest_folder(spark, f"{folder}/days").rsplit("/", 1)[1]).alias("v")),
        "literal": tables.literal_table(spark, "S. No.\tName\n1\ta\n2").toDF("place", "v"),
    })


@query("""
    SELECT 'listing' AS of, 'blocks.' || CASE WHEN n_nationkey % 2 = 0 THEN '0' || n_nationkey % 9 + 1 || 'May2024' ELSE 'Apr2024' END || '.' || n_nationkey || '.7z' AS name, 'blocks' AS comp, CASE WHEN n_nationkey % 2 = 0 THEN '2024-05-0' || n_nationkey % 9 + 1 ELSE '2024-04-01' END AS v FROM nation UNION ALL
    SELECT 'listing', 'changes.csv', 'changes', NULL UNION ALL
    SELECT 'sites', 'f' || n_nationkey, 'c' || n_nationkey, 'd' FROM nation WHERE n_nationkey % 5 <> 0 AND n_nationkey % 3 <> 0 UNION ALL
    SELECT 'site files', 'f' || n_nationkey, CASE WHEN n_nationkey % 3 = 0 THEN 'IGNORE' ELSE 'c' || n_nationkey END, 'd' FROM nation WHERE n_nationkey % 5 <> 0 AND n_nationkey % 4 <> 0 AND (n_nationkey % 3 <> 0 OR n_nationkey % 2 = 0) UNION ALL
    SELECT 'dictionary', NULL, 'c' || n_nationkey, '### c' || n_nationkey || chr(10) || chr(10) || 'd' || chr(10) || chr(10) || '| Field | Description |' || chr(10) || '| --- | --- |' || chr(10) || CASE WHEN n_nationkey % 2 = 0 THEN '| x | an x ' || n_nationkey || ' |' || chr(10) || '| y |  |' ELSE '' END FROM nation WHERE n_nationkey % 5 <> 0 AND n_nationkey % 3 <> 0""")
def catalogs(spark, d):
    folder, n = scratch_dir(spark, "catalog"), F.col("n_nationkey")
    nation = load(spark, d, "nation")
    date = F.when(n % 2 == 0, F.concat(F.lit("0"), n % 9 + 1, F.lit("May2024"))).otherwise("Apr2024")
    names = nation.select(F.concat(F.lit("blocks."), date, F.lit("."), n, F.lit(".7z")).alias("name"), _text(n).alias("size"), F.lit("u").alias("url"))
    sinks.write_csv(names.unionByName(spark.range(1).select(F.lit("changes.csv").alias("name"), F.lit("5").alias("size"), F.lit("u").alias("url"))), f"{folder}/listing")
    listed = tables.read_listing(spark, f"{folder}/listing").withColumn("date", F.when(F.col("component") != "changes", F.col("day")).cast("string"))
    described = lambda v: F.struct(v.alias("description"))
    fields = F.when(n % 2 == 0, F.create_map(F.lit("x"), described(F.concat(F.lit("an x "), n)), F.lit("y"), described(F.lit(""))))
    sites = nation.select(F.when(n % 5 != 0, F.when(n % 3 == 0, "IGNORE").otherwise(F.concat(F.lit("c"), n))).alias("comp"), F.when(n % 4 != 0, F.concat(F.lit("f"), n)).alias("file"), F.lit("d").alias("desc"), fields.alias("fields"))
    _put(sites.agg(F.to_json(F.collect_list(F.struct("*"))).alias("value")).withColumn("name", F.lit("map")), f"{folder}/map")
    by_comp, by_file = tables.read_site_map(spark, f"{folder}/map"), tables.read_site_map(spark, f"{folder}/map", by_file=True)
    number = F.concat(F.lit("f"), F.substring("comp", 2, 9))
    return _under({
        "listing": listed.select("name", F.col("component").alias("comp"), F.col("date").alias("v")),
        "sites": by_comp.select(number.alias("name"), "comp", F.col("desc").alias("v")), "site files": by_file.select(F.col("file").alias("name"), "comp", F.col("desc").alias("v")),
        "dictionary": sinks.data_dictionary(by_comp).select(F.lit(None).cast("string").alias("name"), F.col("component").alias("comp"), F.col("markdown").alias("v")),
    })


# Office files and pages


def _zipped(member: str):
    """Text -> a zip with one member of it."""

    @pandas_udf("binary")
    def pack(texts):
        def one(text):
            out = io.BytesIO()
            with zipfile.ZipFile(out, "w") as package:
                package.writestr(member, text)
            return out.getvalue()

        return texts.map(one)

    return pack


@query("""
    SELECT 'xml' AS of, n_nationkey AS k, n_name || '||' || n_regionkey AS cells FROM nation UNION ALL SELECT 'xml', n_nationkey, 'Code|Name|Z' FROM nation UNION ALL
    SELECT 'book', n_nationkey, n_name || '||' || n_regionkey FROM nation UNION ALL SELECT 'book', n_nationkey, 'in' || n_nationkey || '|7' FROM nation UNION ALL
    SELECT 'text', n_nationkey, 'H1|H2' FROM nation UNION ALL SELECT 'text', n_nationkey, n_name || 'two|' || n_name || 'two|x|x|x' FROM nation UNION ALL SELECT 'text', n_nationkey, 'again|' || n_regionkey FROM nation UNION ALL
    SELECT 'member', n_nationkey, n_name FROM nation""")
def office_files(spark, d):
    """Each nation's own spreadsheet (XML and XLSX), text document and zip: gaps, shared and inline strings, repeats and spans,
    comments, tables before the ones that count, first headers alone."""
    nation = load(spark, d, "nation").select(F.col("n_nationkey").alias("k"), "n_name", _text("n_regionkey").alias("r"))
    say = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    name, region, k = F.col("n_name"), F.col("r"), _text("k")
    ss = 'xmlns="urn:schemas-microsoft-com:office:spreadsheet" xmlns:ss="urn:schemas-microsoft-com:office:spreadsheet"'
    sheet = say(f"<Workbook {ss}><Worksheet><Table><Row><Cell><Data>only one</Data></Cell></Row><Row><Cell><Data>Code</Data></Cell><Cell><Data>Name</Data></Cell><Cell><Data>Z</Data></Cell></Row><Row><Cell><Data>", name, '</Data></Cell><Cell ss:Index="3"><Data>', region, "</Data></Cell></Row><Row><Cell/><Cell/></Row></Table></Worksheet></Workbook>")
    xl = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    book = say(f'<worksheet {xl}><sheetData><row><c r="A1" t="inlineStr"><is><t>', name, '</t></is></c><c r="C1"><v>', region, '</v></c></row><row><c r="A2" t="inlineStr"><is><t>in</t></is><is><t>', k, "</t></is></c><c><v>7</v></c></row></sheetData></worksheet>")
    cell = lambda *t: ("<table:table-cell><text:p>", *t, "</text:p></table:table-cell>")
    head = ("<table:table-row>", *cell("H1"), *cell("H2"), "</table:table-row>")
    early = "<table:table><table:table-row><table:table-cell><text:p>skip</text:p></table:table-cell></table:table-row></table:table>"
    first = ("<table:table>", *head, '<table:table-row><table:table-cell table:number-columns-repeated="2"><text:p>', name, "</text:p><text:p><text:span>two</text:span></text:p></table:table-cell>", *cell("#comment"), '<table:table-cell table:number-columns-spanned="3"><text:p>x</text:p></table:table-cell><table:covered-table-cell><text:p>covered</text:p></table:covered-table-cell></table:table-row><table:table-row>', *cell(""), "</table:table-row></table:table>")
    second = ("<table:table>", *head, "<table:table-row>", *cell("again"), *cell(region), "</table:table-row></table:table>")
    odt = say('<d xmlns:table="urn:oasis:names:tc:opendocument:xmlns:table:1.0" xmlns:text="urn:oasis:names:tc:opendocument:xmlns:text:1.0">', early, early, *first, *second, "</d>")
    made = nation.select("k", F.encode(sheet, "UTF-8").alias("xml"), _zipped("xl/worksheets/sheet1.xml")(book).alias("book"), _zipped("content.xml")(odt).alias("odt"), _zipped("a.txt")(name).alias("zip"))
    read = lambda column, decoder: documents.decoded(made.select("k", column), "k", column, decoder)
    shown = lambda rows: rows.select("k", F.array_join("cells", "|").alias("cells"))
    text = documents.tables_between(read("odt", documents.text_document), "k", 2, 0)
    return _under({"xml": shown(read("xml", documents.spreadsheet_xml)), "book": shown(read("book", documents.workbook)), "text": shown(text), "member": shown(read("zip", lambda data: [(0, [documents.single_member(data).decode()])]))})


@query("""
    SELECT 'sheet' AS of, n_nationkey AS k, 'c0|c1|c2|c3|c4|c5|c6|c7|c8|c9|c' || n_nationkey AS cells FROM nation UNION ALL
    SELECT 'modified', n_nationkey, '2024-05-0' || n_nationkey % 9 + 1 FROM nation UNION ALL SELECT 'landed', n_regionkey, 'true' FROM nation GROUP BY n_regionkey""")
def sheet_trimming(spark, d):
    """A sheet without its first two rows, its blank rows, what is beyond column eleven and its last row."""
    nation = load(spark, d, "nation").select(F.col("n_nationkey").alias("k"), F.col("n_regionkey").alias("r"))
    row = F.transform(F.sequence(F.lit(0), F.lit(13)), lambda i: F.concat(F.lit("c"), F.when(i == 10, F.col("k")).otherwise(i)))
    blank = F.array_repeat(F.lit(""), 14)
    rows = nation.select("k", F.posexplode(F.array(F.array(F.lit("title")), F.array(F.lit("date")), blank, row, blank, F.array(F.lit("end")))).alias("row", "cells"))
    from tabwright.functions import arrays

    kept = ordered.without_ends(rows, ["k"], ["row"], 2, 1).where(~arrays.all_empty(F.col("cells")))
    core = F.concat(F.lit('<c xmlns:t="http://purl.org/dc/terms/"><t:modified>2024-05-0'), F.col("k") % 9 + 1, F.lit("</t:modified></c>"))
    books = nation.select("k", _zipped("docProps/core.xml")(core).alias("book"))
    said = documents.decoded(books, "k", "book", lambda data: [(0, [documents.workbook_modified(data)])])
    folder = scratch_dir(spark, "landed")
    _put(nation.select(_text("r").alias("name"), F.lit("x").alias("value")).distinct(), f"{folder}/f")
    times = documents.file_times(spark, f"{folder}/f/*/*.txt").select(F.regexp_extract("file", r"name=(\d+)", 1).cast("int").alias("k"), (F.col("modified") > "2020-01-01").cast("string").alias("cells"))
    return _under({"sheet": kept.select("k", F.array_join(arrays.part(F.col("cells"), 0, 11), "|").alias("cells")), "modified": said.select("k", F.col("cells")[0].alias("cells")), "landed": times})


@query("""
    SELECT 'levels' AS of, n_nationkey AS k, 'Name/Name=' || n_name || ',Water/Iron=' || n_regionkey || ',Water/pH=7' AS v FROM nation UNION ALL
    SELECT 'profile', n_nationkey, 'dates=Effective Date;' || n_regionkey || '/05/2024' FROM nation UNION ALL SELECT 'label', n_nationkey, n_regionkey || '/05/2024' FROM nation UNION ALL
    SELECT 'hidden', n_nationkey, 'tok=' || n_name FROM nation UNION ALL SELECT 'postback', n_nationkey, '__EV=,__VS=' || n_name FROM nation UNION ALL
    SELECT 'report', n_nationkey, n_name || '|' || n_regionkey FROM nation""")
def page_parts(spark, d):
    nation = load(spark, d, "nation").select(F.col("n_nationkey").alias("k"), "n_name", _text("n_regionkey").alias("r"))
    say = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    name, region = F.col("n_name"), F.col("r")
    two = say("<table><tr><th rowspan=2>Name</th><th colspan=2>Water</th></tr><tr><th>pH</th><th>Iron</th></tr><tr><td>", name, "</td><td>7</td><td>", region, "</td></tr></table>")
    page = say("<table><tr id=hab><td>Effective Date</td><td>", region, '/05/2024</td></tr><tr id=more><td>x</td><td>y</td></tr></table><input type="hidden" name="tok" value="', name, '"><input name="shown" value="z">')
    report = say("<script>var t='<table>';</script><table id=r><tr><td>", name, "</td><td>", region, "</td></tr></table>")
    rows = nation.select("k", two.alias("two"), page.alias("page"), report.alias("report"), say("9|x|hiddenField|__VS|", name, "|hiddenField|__EV||").alias("post"))
    read = lambda column, decoder: documents.decoded(rows, "k", column, decoder).select("k", F.array_join("cells", "|").alias("v"))
    levels = read("two", lambda html: [(0, [",".join(sorted(f"{o}/{i}={v}" for o, inner in row.items() for i, v in inner.items()))]) for row in documents.two_level_table(html)])
    profile = read("page", lambda html: [(0, ["".join(f"{k}={';'.join(v)}" for k, v in documents.profile(html, {"hab": "dates"}, ["more"]).items())])])
    label = read("page", lambda html: [(0, [documents.labelled_value(html, "Effective Date")])])
    hidden = read("page", lambda html: [(0, [",".join(f"{k}={v}" for k, v in sorted(documents.hidden_fields(html).items()))])])
    post = rows.select("k", F.array_join(F.transform(F.array_sort(F.map_entries(documents.postback_triples(F.col("post")))), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",").alias("v"))
    return _under({"levels": levels, "profile": profile, "label": label, "hidden": hidden, "postback": post, "report": read("report", lambda html: documents.page_tables(html, "r"))})


# Writers and increments


@query("""
    SELECT 'appended' AS of, CAST(c_custkey AS VARCHAR) AS k, c_name AS v FROM customer WHERE c_custkey % 4 <> 0 OR c_custkey % 8 = 0 UNION ALL
    SELECT 'errors', CAST(c_nationkey AS VARCHAR), '{' || string_agg('"' || c_custkey || '":["m1","m2"]', ',' ORDER BY CAST(c_custkey AS VARCHAR)) || '}' FROM customer WHERE c_custkey % 5 = 0 GROUP BY c_nationkey UNION ALL
    SELECT 'merged', CAST(c_nationkey AS VARCHAR), string_agg(c_name || '=e' || c_custkey, ',' ORDER BY c_name) FROM customer WHERE c_custkey % 5 = 0 GROUP BY c_nationkey UNION ALL
    SELECT 'lacking', '', string_agg(CAST(n_nationkey AS VARCHAR), ',' ORDER BY CAST(n_nationkey AS VARCHAR)) FROM nation WHERE n_nationkey % 6 = 1 UNION ALL
    SELECT 'replaced', CAST(n_nationkey AS VARCHAR), 'new' FROM nation""")
def written_files(spark, d):
    folder = scratch_dir(spark, "sinks")
    customer, nation = load(spark, d, "customer"), load(spark, d, "nation").select(_text("n_nationkey").alias("k"), F.col("n_nationkey").alias("n"))
    rows = customer.select(_text("c_custkey").alias("k"), F.col("c_name").alias("v"))
    ledger = rows.where("cast(k as int) % 4 = 0").select("k")
    sinks.append_unseen(rows, ledger, ["k"], f"{folder}/appended", F.col("k").cast("int") % 8 == 0)
    fifth = customer.where("c_custkey % 5 = 0").select(_text("c_nationkey").alias("page"), F.col("c_custkey").alias("row"), F.col("c_name").alias("file"), F.explode(F.array(F.lit("m2"), F.lit("m1"))).alias("message"))
    errors = sinks.errors_json(fifth).select(F.col("page").alias("k"), F.col("json").alias("v"))
    per_file = customer.select(F.concat(_text("c_nationkey"), F.lit("/"), "c_name").alias("path"), F.col("c_name").alias("file"), F.when(F.col("c_custkey") % 5 == 0, F.concat(F.lit("e"), "c_custkey")).alias("errors"))
    merged = sinks.merge_errors(per_file, F.substring_index("path", "/", 1)).select(F.col("key").alias("k"), F.array_join(F.transform(F.array_sort(F.map_entries("errors")), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",").alias("v"))
    lacking = sinks.missing_inputs(nation, nation.where("n % 6 != 1"), "k")
    for name, value in (("old", "old"), ("new", "new")):
        nation.select("k", F.lit(value).alias("v")).write.parquet(f"{folder}/{name}")
    sinks.replace_path(spark, f"{folder}/old", f"{folder}/final")
    sinks.replace_path(spark, f"{folder}/new", f"{folder}/final")
    return _under({
        "appended": tables.read_csv(spark, f"{folder}/appended").select("k", "v"), "errors": errors, "merged": merged, "lacking": spark.range(1).select(F.lit("").alias("k"), F.lit(",".join(lacking)).alias("v")),
        "replaced": spark.read.parquet(f"{folder}/final"),
    })


@query("""
    SELECT 'loaded' AS of, CAST(event_id AS VARCHAR) AS k, CAST(CAST(ts AS DATE) AS VARCHAR) AS v FROM events UNION ALL
    SELECT 'ledger', CAST(CAST(ts AS DATE) AS VARCHAR), '' FROM events GROUP BY 2 UNION ALL
    SELECT 'memo', CAST(n_nationkey AS VARCHAR), 'made' FROM nation UNION ALL
    SELECT 'latin', n_name, CASE WHEN n_nationkey % 2 = 0 THEN 'cached' ELSE 'ne ' || n_name END FROM nation UNION ALL SELECT 'fetched', n_name, 'ne ' || n_name FROM nation WHERE n_nationkey % 2 = 1 UNION ALL SELECT 'refused', '', 'no transliteration for xx' UNION ALL
    SELECT 'publish', 'c.' || n_nationkey, '' FROM nation WHERE n_nationkey % 3 = 0 UNION ALL SELECT 'publish', 'changes.csv', '' UNION ALL
    SELECT 'changed', CAST(n_nationkey AS VARCHAR), '' FROM nation WHERE n_nationkey % 4 = 0""")
def increments(spark, d):
    """Loads that overlap and repeat, a memo that is made once, a cache, what is to be published and which documents changed."""
    folder = scratch_dir(spark, "loads")
    events = load(spark, d, "events").select(_text("event_id").alias("k"), F.col("ts").cast("date").cast("string").alias("v"), F.col("event_id").alias("n"))
    for part in ("n % 3 < 2", "n % 3 > 0", "n % 3 < 2"):
        incremental.load_batch(events.where(part).select("k", "v"), f"{folder}/target", f"{folder}/ledger", ["k"], "v")
    nation = load(spark, d, "nation").select(F.col("n_nationkey").alias("n"), F.col("n_name").alias("text"), _text("n_nationkey").alias("k"))
    incremental.memoised(spark, f"{folder}/memo", lambda: nation.select("k", F.lit("made").alias("v")))
    memo = incremental.memoised(spark, f"{folder}/memo", lambda: nation.select("k", F.lit("made again").alias("v")))
    cache = nation.where("n % 2 = 0").select(F.lit("ne").alias("language"), "text", F.lit("cached").alias("latin")).unionByName(nation.select(F.lit("hi").alias("language"), "text", F.lit("other").alias("latin")))
    both, fresh = incremental.transliterated(nation, cache, lambda texts, code: texts.select("text", F.concat(F.lit(code + " "), "text").alias("latin")), "new", ["ne", "hi"])
    try:
        refused = incremental.service_language("xx", ["ne"])
    except ValueError as refusal:
        refused = str(refusal)
    names = nation.select(F.concat(F.lit("c."), "n").alias("name"), "n").unionByName(spark.range(1).select(F.lit("changes.csv").alias("name"), F.lit(1).alias("n")))
    publish = incremental.to_publish(names.select("name"), names.where("n % 3 != 0").select("name"))
    old = nation.select("k", F.concat(F.lit('{"a":1,"b":'), "n", F.lit("}")).alias("doc"))
    new = nation.select("k", F.concat(F.lit('{"b": '), F.when(F.col("n") % 4 == 0, F.col("n") + 100).otherwise(F.col("n")), F.lit(', "a":1}')).alias("doc"))
    empty = F.lit("").alias("v")
    return _under({
        "loaded": spark.read.parquet(f"{folder}/target").select("k", "v"), "ledger": spark.read.parquet(f"{folder}/ledger").select(F.col("v").alias("k"), empty) if "v" in spark.read.parquet(f"{folder}/ledger").columns else spark.read.parquet(f"{folder}/ledger").select(F.col("date").alias("k"), empty),
        "memo": memo, "latin": both.select(F.col("text").alias("k"), F.col("latin").alias("v")), "fetched": fresh.select(F.col("text").alias("k"), F.col("latin").alias("v")), "refused": spark.range(1).select(F.lit("").alias("k"), F.lit(refused).alias("v")),
        "publish": publish.select(F.col("name").alias("k"), empty), "changed": incremental.changed_documents(old, new, "k", "doc").select("k", empty),
    })


@query("""
    SELECT user_id AS k, min(CAST(CAST(ts AS DATE) AS VARCHAR)) AS first_day, count(*) AS n FROM events GROUP BY 1""")
def streamed_rows(spark, d):
    """Files of events arrive twice, with rows that come again; the target holds each once."""
    folder = scratch_dir(spark, "stream")
    events = load(spark, d, "events").select(F.col("event_id").alias("id"), F.col("user_id").alias("k"), F.col("ts").cast("date").cast("string").alias("date"))
    for part in ("id % 3 < 2", "id % 3 > 0"):
        sinks.append_json(events.where(part), f"{folder}/in")
        incremental.stream_into(incremental.stream_json(spark, f"{folder}/in", "id long, k long, date string"), f"{folder}/target", f"{folder}/ledger", f"{folder}/state", ["id"], "date")
    loaded = spark.read.parquet(f"{folder}/target")
    return loaded.groupBy("k").agg(F.min("date").alias("first_day"), F.count(F.lit(1)).alias("n"))


@query("""
    SELECT 'added' AS change, n_nationkey AS k FROM nation WHERE n_nationkey % 4 = 3 UNION ALL SELECT 'removed', n_nationkey FROM nation WHERE n_nationkey % 4 = 1""")
def monitored_catalog(spark, d):
    """Releases that a filter lets through, held against the known ones by sets; rows stand in a listing several times."""
    n = F.col("n_nationkey")
    names = load(spark, d, "nation").select(n.alias("k"), F.concat(F.lit("c."), n, F.lit("May2024.csv.7z")).alias("name")).where(filters.of_month(F.col("name"), "May2024"))
    old, new = names.where("k % 4 < 3"), names.where("k % 4 != 1")
    added, removed = sets.added_removed(old.unionByName(old), new.unionByName(new).unionByName(new))
    return added.select(F.lit("added").alias("change"), "k").unionByName(removed.select(F.lit("removed").alias("change"), "k"))
