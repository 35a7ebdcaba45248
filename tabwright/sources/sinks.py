"""Writers. Spark's committer makes them atomic: a folder without _SUCCESS isn't there."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def write_csv(rows: DataFrame, path: str, sep: str = ",", mode: str = "errorifexists", single: bool = False, **options: str) -> None:
    """CSV with a header; empty text stays empty. ``single``: one file, for small outputs."""
    out = rows.coalesce(1) if single else rows
    out.write.mode(mode).options(header=True, sep=sep, emptyValue="", escape='"', **options).csv(path)


def convert_delimiter(spark: SparkSession, source: str, target: str, old: str = ";", new: str = ",") -> None:
    from tabwright.sources.tables import read_csv

    write_csv(read_csv(spark, source, old), target, new)


def append_json(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").json(path)


def report_json(issues: DataFrame, kind: str = "kind", payload: str = "payload") -> DataFrame:
    """Issues (kind, payload struct or JSON) -> one row for each kind with its payloads in a fixed order, as JSON.

    A kind's payloads make one JSON value, as its readers expect; issues are few against the registers.
    """
    body = F.col(payload) if dict(issues.dtypes)[payload] == "string" else F.to_json(payload)
    listed = issues.groupBy(kind).agg(F.array_sort(F.collect_list(body)).alias("items"))
    return listed.select(kind, F.concat(F.lit("["), F.array_join("items", ","), F.lit("]")).alias("json"))


def errors_json(errors: DataFrame) -> DataFrame:
    """errors(page, row, message) -> page, json of row -> messages."""
    rows = errors.groupBy("page", "row").agg(F.array_sort(F.collect_list("message")).alias("messages"))
    return rows.groupBy("page").agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col("row").cast("string"), "messages"))))).alias("json"))


def merge_errors(errors: DataFrame, key: Column) -> DataFrame:
    """Per-file errors(file, errors) under a derived key; nothing where there are none."""
    return errors.where(F.col("errors").isNotNull()).groupBy(key.alias("key")).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("file", "errors")))).alias("errors"))


def append_unseen(rows: DataFrame, ledger: DataFrame, key: list[str], path: str, leaf: Column | None = None) -> DataFrame:
    """Appends rows whose key the ledger lacks (and ``leaf`` rows in any case); returns what was written."""
    fresh = rows.join(ledger.select(*key).distinct(), key, "left_anti")
    if leaf is not None:
        seen = rows.where(leaf).join(ledger.select(*key).distinct(), key, "left_semi")
        fresh = fresh.unionByName(seen)
    fresh.write.mode("append").option("header", True).csv(path)
    return fresh


def missing_inputs(expected: DataFrame, present: DataFrame, key: str) -> list[str]:
    """Names expected but not present: an archive with any isn't made."""
    return sorted(r[0] for r in expected.select(key).distinct().join(present.select(key), key, "left_anti").collect())


def data_dictionary(catalog: DataFrame) -> DataFrame:
    """Source catalog -> component, Markdown of its description and fields."""
    fields = F.array_sort(F.transform(F.map_entries(F.coalesce("fields", F.from_json(F.lit("{}"), "map<string,struct<description:string>>"))), lambda e: F.concat(F.lit("| "), e["key"], F.lit(" | "), F.coalesce(e["value"]["description"], F.lit("")), F.lit(" |"))))
    head = F.concat(F.lit("### "), F.col("comp"), F.lit("\n\n"), F.coalesce("desc", F.lit("")), F.lit("\n\n| Field | Description |\n| --- | --- |\n"))
    return catalog.select(F.col("comp").alias("component"), F.concat(head, F.array_join(fields, "\n")).alias("markdown"))


def replace_path(spark: SparkSession, staged: str, final: str) -> None:
    """Puts a finished staging folder in the place of the final one. The old one is moved aside first and comes back if the
    new one can't take its place; a crash between the two moves leaves both, the old one as ``final.old``."""
    jvm = spark._jvm
    new, old = jvm.org.apache.hadoop.fs.Path(staged), jvm.org.apache.hadoop.fs.Path(final)
    files = new.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(new):
        raise FileNotFoundError(staged)
    aside = jvm.org.apache.hadoop.fs.Path(f"{final}.old")
    if files.exists(old):
        files.delete(aside, True)
        if not files.rename(old, aside):
            raise OSError(f"{final} could not be moved aside")
    if not files.rename(new, old):
        if files.exists(aside):
            files.rename(aside, old)
        raise OSError(f"{staged} could not become {final}")
    files.delete(aside, True)


def quick_statements(issues: DataFrame, templates: Mapping[str, Column]) -> DataFrame:
    """Correction lines of the kinds that have a template; a null line is none."""
    line: Column = F.lit(None).cast("string")
    for kind, template in templates.items():
        line = F.when(F.col("kind") == kind, template).otherwise(line)
    return issues.select("kind", line.alias("line")).where("line is not null")
