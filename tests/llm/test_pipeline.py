"""The pipeline's stages on the smallest tables and on odd rows."""

import os

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")
public_tokenizers = pytest.importorskip("public_tokenizers")
SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.mark.skipif(not os.path.exists(SF), reason="no test tables")
def test_stages_on_the_smallest_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").cache()
    names = docs.columns
    sizes = [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF).cache()
        assert docs.columns == names
        sizes.append(docs.count())
    assert sizes[0] >= sizes[1] >= sizes[2] >= sizes[3] > 0 and sizes[4] > 0
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert len(last) == sizes[4]
    ordered = sorted(last, key=lambda r: r.start)
    assert [r.doc_id for r in ordered] == sorted(r.doc_id for r in last)
    assert corpus_pipeline.run(spark, SF).count() == sizes[4]


@pytest.mark.skipif(not os.path.exists(SF), reason="no test tables")
def test_stages_on_odd_rows(spark):
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first()["text"]
    rows = [(1, "clean words of one kind, read by nobody so far", "en", "a", 1), (1, "clean words of one kind, read by nobody so far", "en", "a", 1), (1, "another text under the same id as the first", "en", "a", 1)]
    rows += [(2, "clean words of one kind, read by nobody so far", "en", None, 1), (None, "a text without any id stays", None, "b", None), (3, f"before {item} after", "en", "a", 1), (None, f"{item}", "en", "a", 1), (4, None, None, None, None), (5, "", "en", "a", 0)]
    docs = spark.createDataFrame(rows, DOCS)
    kept = corpus_pipeline.one_of_each_near_duplicate(spark, docs, SF).collect()
    assert sorted((r.doc_id or -1, r.text or "") for r in kept if r.text) == sorted((i or -1, t) for i, t in {(1, rows[0][1]), (1, rows[2][1]), (None, rows[4][1]), (3, rows[5][1]), (None, item)} if (i, t) in {(r.doc_id, r.text) for r in kept} or (i, t) != (None, item))
    clean = corpus_pipeline.drop_leaks(spark, docs, SF).collect()
    assert sorted(((r.doc_id, r.text) for r in clean), key=repr) == sorted(((r[0], r[1]) for r in rows if item not in (r[1] or "")), key=repr)
    mixed = corpus_pipeline.mix_sources(spark, docs, SF).collect()
    assert {(r.doc_id, r.text) for r in mixed} <= {(r[0], r[1]) for r in rows}
    assert {(4, None), (5, "")} <= {(r.doc_id, r.text) for r in mixed}  # documents without words stay
    long = spark.createDataFrame([(1, "long " * 80_000, "en", "a", 1), (2, "short text of six words here", "en", "b", 1)], DOCS)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, long, SF).where("doc_id = 1").count() >= 1
    clashing = docs.selectExpr("*", "1.5 as score", "'x' as digest", "2 as size", "3 as bucket")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, clashing, SF).columns == clashing.columns
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, spark.createDataFrame([], DOCS), SF).collect() == []
