"""The registered queries on the smallest tables: columns of their contracts, whole results, and SQL where there is some."""

import os
import re
import zlib

import duckdb
import pytest

from tabwright.llm import queries

SF = "/root/testdata/sf0.001"
pytest.importorskip("public_tokenizers")
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="no test tables")

COLUMNS = {
    "op1": ("documents", {"doc_id": "bigint", "item_id": "bigint"}),
    "op2": ("documents", {"doc_id": "bigint", "class_id": "bigint", "kept": "boolean"}),
    "op3": ("documents", {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"}),
    "op4": ("documents", {"doc_id": "bigint", "start": "bigint", "n_tokens": "bigint", "ids_crc32": "bigint"}),
    "op5": ("documents", {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint", "grown_shard": "int"}),
    "op6": ("documents", {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"}),
    "op7": ("documents", {"doc_id": "bigint", "n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint", "kept_sha256": "string"}),
    "op8": ("documents", {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"}),
    "op9": ("pages", {"page_id": "bigint", "host": "string", "path": "string", "rule": "string", "verdict": "string"}),
    "op10": ("embeddings", {"vec_id": "bigint", "n_links": "bigint", "component_id": "bigint", "kept": "boolean"}),
}


def test_one_query_for_each_operator():
    assert sorted(n.split("_")[0] for n in queries.queries()) == sorted(COLUMNS)


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_columns_and_rows(spark, name):
    table, columns = COLUMNS[name.split("_")[0]]
    got = queries.queries()[name](spark, SF)
    kinds = dict(got.dtypes)
    assert {c: kinds.get(c) for c in columns} == columns
    rows = got.collect()
    whole = spark.read.parquet(f"{SF}/{table}.parquet").collect()
    key = next(iter(columns))
    if name.startswith("op1_"):
        assert {r.doc_id for r in rows} <= {r.doc_id for r in whole}
    else:
        assert sorted(r[key] for r in rows) == sorted(r[key] for r in whole)
    if "held_out" in columns:
        folds, held, cut = (5, 0, 0.3) if name.startswith("op3_") else (3, 1, 0.7)
        for r in rows:
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % folds == held) and r.predicted == int(r.score >= cut) and 0 <= r.score <= 1
    if name.startswith("op8_"):
        words = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for r in whole}
        assert all(r["size"] == words[r.doc_id] and r.taken <= 3 * r["size"] for r in rows)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_against_duckdb(spark, name):
    con = duckdb.connect()
    for t in ("pages", "labels", "documents", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = queries.queries()[name](spark, SF)
    want = con.execute(queries.oracle_sql()[name])
    assert sorted(got.columns) == sorted(c[0] for c in want.description)
    names = sorted(got.columns)
    at = [[c[0] for c in want.description].index(n) for n in names]
    assert sorted((tuple(r[n] for n in names) for r in got.collect()), key=repr) == sorted((tuple(r[i] for i in at) for r in want.fetchall()), key=repr)
