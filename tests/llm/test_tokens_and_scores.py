"""The token store against the library itself; the classifiers against their labels."""

import random
import zlib

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

from tabwright.llm import quality_ranking, token_store, toxicity  # noqa: E402
from tabwright.llm.encoding import Encoder  # noqa: E402

PATH = public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def odd_texts():
    draw = random.Random(3)
    parts = ["a", "the", " ", "  ", "   ", "\n", "\n ", "\t", " ", " ", "　", "é", "Öß", "'s", "'re", "12", "!!", "\x1c", "\x85", "<|endoftext|>", "日本", "x́", "\r\n", "​", "᠎", "🙂", "%%%", "\x00", "don't", "foo,", "bar!!", "x\ny", "end.\nStart", "\n\n", "naïve-", "ſt", "ǀ", "K", "ª", "²", "'", "_", "l'été"]
    return ["".join(draw.choices(parts, k=draw.randrange(0, 14))) for _ in range(1500)] + ["", " ", "  ", " a", "a ", "a  b", "a\n  b", "word " * 20000]


def test_encoder_equals_the_library(library):
    encoder = Encoder(open(PATH, encoding="utf-8").read(), bound=200)
    texts = odd_texts()
    for i in range(0, len(texts), 100):
        for text, raw in zip(texts[i : i + 100], encoder.encode(texts[i : i + 100]), strict=True):
            assert np.frombuffer(raw, "<u2").tolist() == library.encode(text, add_special_tokens=False).ids, repr(text[:60])


def test_crc_parts():
    draw = random.Random(5)
    parts = [draw.randbytes(draw.randrange(0, 500)) for _ in range(50)]
    after = [sum(map(len, parts[i + 1 :])) for i in range(50)]
    got = token_store.crc_before(np.array([zlib.crc32(p) for p in parts]), np.array(after))
    assert int(np.bitwise_xor.reduce(got)) == zlib.crc32(b"".join(parts))


def test_cut_points_follow_content():
    draw = np.random.default_rng(1)
    body = draw.integers(0, 50_000, 20_000).astype(np.uint16)
    one = token_store.cut_points(body, np.array([0, len(body)]))
    assert one[0][0] == 0 and one[-1][1] == len(body) and all(a[1] == b[0] for a, b in zip(one, one[1:], strict=False))
    assert all(token_store.MIN <= b - a <= token_store.MAX for a, b in one[:-1])
    moved = np.concatenate([draw.integers(0, 50_000, 77).astype(np.uint16), body])
    two = token_store.cut_points(moved, np.array([0, len(moved)]))
    same = {body[a:b].tobytes() for a, b in one} & {moved[a:b].tobytes() for a, b in two}
    assert len(same) > 0.8 * len(one)


def test_store_round_trip(spark, library, tmp_path):
    long = " ".join("word%d" % (i % 997) for i in range(9000))
    rows = [(i, t) for i, t in enumerate(odd_texts()[:200])] + [(500, long), (501, long), (502, "x " + long), (None, "no id"), (550, "again"), (550, "again"), (600, None), (601, "")]
    frame = spark.createDataFrame([(i, t, None, None, 1) for i, t in rows], DOCS).repartition(3)
    folder = str(tmp_path / "store")
    token_store.write_store(frame, folder, PATH)
    got = sorted(token_store.read_index(spark, folder).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i))
    ids = {i: [*library.encode(t or "", add_special_tokens=False).ids, 0] for i, t in rows}
    at = 0
    for r in got:
        assert (r.start, r.n_tokens) == (at, len(ids[r.doc_id]))
        assert r.ids_crc32 == zlib.crc32(np.array(ids[r.doc_id], "<u4").tobytes())
        at += r.n_tokens
    rebuilt = token_store.read_documents(spark, folder).collect()
    assert len(rebuilt) == len(rows) and all(r.ids == ids[r.doc_id] for r in rebuilt)
    stored = token_store.chunks(spark, folder).collect()
    assert len({r.address for r in stored}) == len(stored)
    assert sum(len(r.payload) for r in stored) // 2 < sum(map(len, ids.values())) * 0.75  # the long text's copies share chunks
    whole = spark.read.parquet(folder + "/manifest").where("part = -1")
    assert whole.where(f"level = {whole.agg({'level': 'max'}).first()[0]}").count() == 1
    assert len({r.root for r in got if r.doc_id in (500, 501)}) == 1


def test_manifest_climbs_to_one_root(spark, tmp_path):
    frame = spark.createDataFrame([(i, "text %d" % i, None, None, 1) for i in range(300)], DOCS)
    folder = str(tmp_path / "store")
    token_store.write_store(frame, folder, PATH)
    got = token_store.manifest(spark, folder, fan=3).collect()
    sizes = {r["part"]: r.n for r in spark.read.parquet(folder + "/recipes").groupBy("part").agg({"slot": "count"}).toDF("part", "n").collect()} | {-1: len({r.part for r in got} - {-1})}
    for part, n in sizes.items():
        level = 0
        while level == 0 or n > 1:
            n, level = -(-n // 3), level + 1
            assert len([r for r in got if (r.part, r.level) == (part, level)]) == n


def _changed(spark, folder, name, change):
    """The store's files ``name``, read, changed and written back."""
    import shutil

    change(spark.read.parquet(f"{folder}/{name}")).write.parquet(f"{folder}/changed")
    shutil.rmtree(f"{folder}/{name}")
    shutil.move(f"{folder}/changed", f"{folder}/{name}")


@pytest.mark.parametrize("damage", ["recipe", "swapped", "manifest", "missing", "payload"])
def test_damaged_stores_raise(spark, tmp_path, damage):
    from pyspark.sql import functions as F

    frame = spark.createDataFrame([(i, "some text %d" % i * 40, None, None, 1) for i in range(20)], DOCS)
    folder = str(tmp_path / "store")
    token_store.write_store(frame, folder, PATH)
    assert token_store.read_index(spark, folder).count() == 20
    if damage == "recipe":
        _changed(spark, folder, "recipes", lambda r: r.withColumn("addresses", F.when(F.col("doc_id") == 3, F.reverse(F.concat("addresses", "addresses"))).otherwise(F.col("addresses"))))
    elif damage == "swapped":  # two documents change their ids' places, each recipe whole in itself
        _changed(spark, folder, "recipes", lambda r: r.withColumn("slot", F.when(F.col("slot") < 2, 1 - F.col("slot")).otherwise(F.col("slot"))))
    elif damage == "manifest":
        _changed(spark, folder, "manifest", lambda r: r.where("part != -1"))
    elif damage == "missing":
        _changed(spark, folder, "objects", lambda r: r.where("kind = 1 or payload is not null and crc32(key) % 2 = 0"))
    else:
        _changed(spark, folder, "objects", lambda r: r.withColumn("payload", F.when(F.col("kind") == 0, F.concat("payload", F.lit(b"\0\0")))))
    with pytest.raises(Exception, match="manifest|recipe|chunk"):
        token_store.read_index(spark, folder).collect()


def test_store_has_one_file_a_task(spark, tmp_path):
    from pathlib import Path

    folder = tmp_path / "store"
    token_store.write_store(spark.createDataFrame([(i, "some text %d" % i * 40, None, None, 1) for i in range(200)], DOCS).repartition(3), str(folder), PATH)
    files = [p for p in Path(folder).rglob("*") if p.is_file() and p.name != "_SUCCESS"]
    assert [p.name for p in files if p.suffix != ".parquet"] == []
    assert len([p for p in files if p.is_relative_to(folder / "objects")]) <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert token_store.read_index(spark, str(folder)).count() == 200


def test_a_changed_byte_of_an_id_raises(spark, tmp_path):
    """Nothing but the pages' checksums stands for the ids: chunks, recipes' roots and their order are as they were."""
    import shutil

    import pyarrow.parquet as pq

    folder = str(tmp_path / "store")
    token_store.write_store(spark.createDataFrame([(10 * i, "text %d" % i, None, None, 1) for i in range(50)], DOCS), folder, PATH)
    token_store._read(spark, f"{folder}/recipes").coalesce(1).write.options(**token_store.FILES | {"compression": "none", "parquet.enable.dictionary": "false"}).parquet(f"{folder}/plain")
    shutil.rmtree(f"{folder}/recipes")
    shutil.move(f"{folder}/plain", f"{folder}/recipes")
    assert sorted(r.doc_id for r in token_store.read_index(spark, folder).collect()) == [10 * i for i in range(50)]
    (path,) = (tmp_path / "store" / "recipes").glob("*.parquet")
    group = pq.ParquetFile(path).metadata.row_group(0)
    column = next(group.column(i) for i in range(group.num_columns) if group.column(i).path_in_schema == "doc_id")
    raw = bytearray(path.read_bytes())
    raw[column.data_page_offset + column.total_compressed_size - 8] ^= 1  # the last id
    path.write_bytes(raw)
    with pytest.raises(Exception, match="verify page integrity"):
        token_store.read_index(spark, folder).collect()


def test_store_with_clashing_columns_and_one_id(spark, library, tmp_path):
    rows = [(7, "text %d" % i, i, "s", "m") for i in range(400)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, start int, root string, key string").repartition(5)
    token_store.write_store(frame, str(tmp_path / "s"), PATH)
    got = token_store.read_index(spark, str(tmp_path / "s")).collect()
    want = [zlib.crc32(np.array([*library.encode(r[1], add_special_tokens=False).ids, 0], "<u4").tobytes()) for r in rows]
    assert sorted(r.ids_crc32 for r in got) == sorted(want) and {r.doc_id for r in got} == {7}


def test_empty_store(spark, tmp_path):
    token_store.write_store(spark.createDataFrame([], DOCS), str(tmp_path / "s"), PATH)
    assert token_store.read_index(spark, str(tmp_path / "s")).collect() == []


def corpus(spark, toxic):
    draw = random.Random(11)
    words = ["w%d" % i for i in range(400)]
    rows, labels = [], []
    for i in range(800):
        body = draw.choices(words, k=draw.randrange(20, 200))
        bad = i % 5 == 0
        if bad and toxic:
            for _ in range(3):
                body.insert(draw.randrange(len(body)), draw.choice(["vilest", "rotter", "fiendish"]) + draw.choice(["", ",", "!"]))
        if bad and not toxic:
            body = [w.upper() + "!!" for w in body] if i // 10 % 2 else [w for w in body for _ in range(5)]
        rows.append((i, " ".join(body), None, None, 0))
        labels.append((i, int(not bad if not toxic else True), int(bad and toxic)))
    return spark.createDataFrame([*rows, (9001, None, None, None, 0), (9002, "", None, None, 0), (3, "twice", None, None, 0)], DOCS), spark.createDataFrame([*labels, (5000, None, None), (6000, 1, 1)], "doc_id long, quality int, toxic int")


def test_toxicity_held_out(spark):
    documents, labels = corpus(spark, True)
    model = toxicity.fit(documents, labels.where("doc_id % 2 = 1"))
    got = toxicity.score(documents, model).collect()
    assert len(got) == 803 and all(0 <= r.score <= 1 for r in got)
    wrong = sum((r.score >= 0.7) != (r.doc_id % 5 == 0) for r in got if r.doc_id % 2 == 0 and r.doc_id < 800)
    assert wrong <= 8
    assert len(model.accuracies) == len(model.correlations)


def test_quality_held_out(spark):
    documents, labels = corpus(spark, False)
    model = quality_ranking.fit(documents, labels.where("doc_id % 2 = 1"))
    got = quality_ranking.score(documents, model).collect()
    assert len(got) == 803 and all(0 <= r.score <= 1 for r in got)
    wrong = sum((r.score >= 0.3) != (r.doc_id % 5 != 0) for r in got if r.doc_id % 2 == 0 and r.doc_id < 800)
    assert wrong <= 8


def test_classifiers_without_examples(spark):
    documents, labels = corpus(spark, True)
    none = labels.where("doc_id < 0")
    assert {r.score for r in quality_ranking.score(documents, quality_ranking.fit(documents, none)).collect()} == {0.5}
    assert len({r.score for r in toxicity.score(documents, toxicity.fit(documents, none)).collect()}) <= 2
    empty = documents.where("doc_id < 0")
    assert toxicity.score(empty, toxicity.fit(empty, labels)).collect() == []


def test_label_model_finds_accuracies():
    draw = np.random.default_rng(2)
    truth = draw.random(4000) < 0.2
    votes = np.stack([np.where(draw.random(4000) < a, truth, draw.random(4000) < 0.05) for a in (0.9, 0.8, 0.7, 0.6)], 1).astype(float)
    votes = np.concatenate([votes, votes[:, :1]], 1)  # a voter that copies another
    posterior, accuracy, corr = toxicity.label_model(votes)
    assert ((posterior > 0.5) == truth).mean() > 0.93
    assert corr[0, 4] > 0.9 and accuracy[0] > accuracy[3]


def test_term_rows_go_out_in_parts():
    import pyarrow as pa

    texts = [f"Some text, number {i % 7} of some more words than that" for i in range(40)] + [None, ""]
    batch = pa.RecordBatch.from_pydict({"text": texts, "toxic": [i % 2 for i in range(len(texts))]})
    whole = list(toxicity._term_rows(iter([batch])))
    parts = list(toxicity._term_rows(iter([batch]), most=10))
    assert len(whole) == 1 and len(parts) > 20 and all(p.num_rows < 80 for p in parts)
    rows = [{tuple(r.values()) for p in some for r in p.to_pylist()} for some in (whole, parts)]
    assert rows[0] == rows[1] and len(rows[0]) == whole[0].num_rows


def test_texts_that_are_kept_go_to_python_once(spark):
    documents, labels = corpus(spark, True)
    model = toxicity.fit(documents, labels)
    got = toxicity.score(documents, model, ("lang", "text", "doc_id"), "toxicity")
    assert got.columns == ["lang", "text", "doc_id", "toxicity"]
    assert "__text" not in got._jdf.queryExecution().analyzed().toString()
    want = toxicity.score(documents, model).join(documents.select("doc_id").where("doc_id <> 3"), "doc_id").collect()
    assert {(r.doc_id, r.toxicity) for r in got.where("doc_id <> 3").collect()} == {(r.doc_id, r.score) for r in want} and len(want) == 801
    assert sorted((r.doc_id, r.text or "") for r in got.collect()) == sorted((r.doc_id, r.text or "") for r in documents.collect())


def test_top_word_is_the_most_frequent_one_in_any_order():
    from tabwright.llm.quality_ranking import FEATURES, features

    words = ["w%d" % i for i in range(85)] + ["junk"] * 15
    at = FEATURES.index("top_word")
    assert features(" ".join(words))[at] == features(" ".join(words[::-1]))[at] == 0.15


def test_labelled_texts_are_bounded_by_ids(spark):
    from tabwright.llm.common import labelled_texts

    documents = spark.createDataFrame([(1, "copy %d" % (i % 3)) for i in range(3000)] + [(2, None), (None, "x")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (1, 1), (2, 0), (None, 1), (3, 1), (4, None)], "doc_id long, toxic int")
    got = sorted(tuple(r) for r in labelled_texts(documents, labels, "toxic", 10).collect())
    assert got == [("", 0), (min(("copy %d" % i for i in range(3)), key=lambda t: zlib.crc32(t.encode())), 1)]


def test_labelled_texts_beyond_a_broadcast(spark, monkeypatch):
    from tabwright.llm import common

    documents, labels = corpus(spark, False)
    want = sorted(tuple(r) for r in common.labelled_texts(documents, labels, "quality").collect())
    monkeypatch.setattr(common, "BROADCAST_IDS", 10)
    assert sorted(tuple(r) for r in common.labelled_texts(documents, labels, "quality").collect()) == want and len(want) == 800


def test_quality_learns_from_all_labelled_ids(spark):
    from pyspark.sql import functions as F

    # The 2,000 bad texts are those whose ids have the largest hashes, behind 20,000 good ones.
    ids = [r[0] for r in spark.range(22_000).orderBy(F.xxhash64("id"), "id").collect()]
    documents = spark.createDataFrame([(i, "JUNK!! JUNK!! %d" % i if at >= 20_000 else "plain words of a text, no %d" % i) for at, i in enumerate(ids)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(at < 20_000)) for at, i in enumerate(ids)], "doc_id long, quality int")
    got = {r.doc_id: r.score for r in quality_ranking.score(documents, quality_ranking.fit(documents, labels)).collect()}
    assert len(got) == 22_000 and all((got[i] >= 0.3) == (at < 20_000) for at, i in enumerate(ids))


def test_quality_fits_all_pairs(spark):
    documents, labels = corpus(spark, False)
    labels = labels.where("doc_id % 2 = 1 and doc_id < 800")
    model = quality_ranking.fit(documents, labels)
    got = sorted(documents.join(labels, "doc_id").collect(), key=lambda r: zlib.crc32(r.text.encode()), reverse=True)
    got = list({r.doc_id: r for r in got}.values())  # an id's text with the least crc32
    x, y = np.array([quality_ranking.features(r.text) for r in got]), np.array([r.quality for r in got])
    assert len(y) == 400 and np.allclose(model.centre, x.mean(0), atol=1e-5) and np.allclose(model.scale, np.maximum(x.std(0), 1e-6), atol=1e-4)
    z = np.clip((x - model.centre) / model.scale, -20, 20)
    gap = z[y == 1][:, None] - z[y == 0][None]  # every pair
    slope = -(gap / (1 + np.exp(gap @ model.weights))[..., None]).mean((0, 1)) + 1e-4 * model.weights
    assert np.abs(slope).max() < 1.2e-4
    worth = (x - model.centre) / model.scale @ model.weights
    assert np.isclose(model.threshold, np.quantile(worth, (y == 0).mean())) and np.isclose(model.slope, 2 / (np.median(worth[y == 1]) - model.threshold))


def test_values_at_ranks_are_exact(spark):
    values = sorted([1e-9 * i for i in range(300)] + [5.0] * 40 + [-3.25, 1e6, 5.000000001])
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    assert [quality_ranking.value_at(frame, "v", i) for i in (0, 1, 150, 299, 300, 301, 341, 342)] == [values[i] for i in (0, 1, 150, 299, 300, 301, 341, 342)]
    assert np.isclose(quality_ranking.quantile(frame, "v", len(values), 0.8775), np.quantile(values, 0.8775), rtol=1e-12)


def test_classifiers_with_long_texts_and_clashing_columns(spark):
    documents, labels = corpus(spark, True)
    documents = documents.selectExpr("*", "1 as label", "'x' as score", "2 as toxic", "3 as quality", "'t' as term").union(documents.limit(1).selectExpr("77777L", "repeat('word vilest ', 60000)", "lang", "source", "n_chars", "1", "'x'", "2", "3", "'t'"))
    model = toxicity.fit(documents, labels)
    got = {r.doc_id: r.score for r in toxicity.score(documents, model).collect()}
    assert len(got) == 803 and got[77777] >= 0.7
    ranked = quality_ranking.score(documents, quality_ranking.fit(documents, labels))
    assert ranked.columns == ["doc_id", "score"] and ranked.count() == 804
    none = documents.where("doc_id < 0")
    assert quality_ranking.score(none, quality_ranking.fit(none, labels)).collect() == []
