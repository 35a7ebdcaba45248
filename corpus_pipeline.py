"""A training corpus in five stages: toxicity, near-duplicates, decontamination, mixing, token store.

Every stage reads what its predecessor wrote as Parquet; all but the last return the columns of documents.
Rows that share an id are told apart by the crc32 of their texts, and rows alike in both are one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tabwright.llm import decontamination, minhash_dedup, mixing, token_store, toxicity
from tabwright.llm.common import crc_fold, cut, scratch_dir, table
from tabwright.llm.queries import vocabulary

#: Texts at or over this toxicity go.
TOXIC = 0.7
#: Ids go to all executors only up to this number (16 bytes each); beyond it the texts are shuffled.
BROADCAST_ROWS = 500_000
#: A whole copy in the sums of parts.
WHOLE = 1 << 24
ORACLE_SQL = None


def _key(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.col(doc_id).cast("long"), F.lit(-(2**63))).alias("__key")


def _crc() -> Column:
    return F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("__crc")


def _small(ids: DataFrame) -> DataFrame:
    return F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids


def _one_of_alike(rows: DataFrame) -> DataFrame:
    """The first of the rows that share __key and __crc, if there are any such rows at all."""
    alike = rows.groupBy("__key", "__crc").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if not alike.limit(1).count():
        return rows
    first = F.row_number().over(Window.partitionBy("__key", "__crc").orderBy("__key"))
    return rows.withColumn("__row", first).where("__row = 1").drop("__row")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents under the toxicity threshold. The model learns from folds 0 and 2 of 3."""
    labels = table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.where(crc_fold(F.col("doc_id"), 3) != 1))
    return toxicity.score(docs, model, tuple(docs.columns), "__score").where(F.col("__score") < TOXIC).drop("__score")


def one_of_each_near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the least id, of each class of near-duplicates."""
    found = minhash_dedup.near_duplicates(docs).where("kept")
    kept = found.select(_key(), F.col("text_crc").alias("__crc")).distinct()
    own = docs.select("*", _key(), _crc()).join(kept, ["__key", "__crc"], "left_semi")
    return _one_of_alike(own).select(*docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, verbatim or with other values in its slots."""
    leaks = decontamination.find_leaks(docs, table(spark, sf_dir, "benchmark"))
    ids = cut(leaks.select(_key(), F.col("text_crc").alias("__crc")).distinct())  # else the search runs for the count and for the join
    return docs.select("*", _key(), _crc()).join(_small(ids), ["__key", "__crc"], "left_anti").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes its words: the whole times, and a last one by systematic rounding. Along a
    source's documents in order of size the parts of a copy left over are added up, and where the sum passes a half over a
    whole number the document takes the copy; as neighbours are of like size, a source's words come about as near as its longest
    document. Documents without words, of which the mix takes none, stay once."""
    mixed, _ = mixing.mix(docs)
    own = mixed.groupBy(_key(), F.col("crc").alias("__crc")).agg(F.min("source").alias("source"), F.sum("taken").alias("taken"), F.max("size").alias("size"))
    source = [F.col("source").isNull().alias("no_source"), F.coalesce("source", F.lit("")).alias("name")]
    left = cut(own.select("*", *source, F.expr(f"if(size > 0, taken % size * {WHOLE} div size, 0)").alias("left"), F.xxhash64("__key", "__crc").alias("place")))
    # Some hundred classes of like size, each in 4 parts by hash: no task gets a whole source, and a source has few groups.
    summed = mixing.running_before(left, mixing.SOURCE, ["size", "place", "__key", "__crc"], F.floor(16 * F.log2(F.col("size") + 1)) * 4 + F.pmod("place", F.lit(4)), "left", "before")
    wanted = summed.select("__key", "__crc", F.expr(f"if(size > 0, taken div size + (before + left + {WHOLE // 2}) div {WHOLE} - (before + {WHOLE // 2}) div {WHOLE}, 1)").cast("int").alias("__copies")).where("__copies > 0")
    rows = _one_of_alike(docs.select("*", _key(), _crc())).join(wanted, ["__key", "__crc"])
    return rows.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies")))).select(*docs.columns)


def store_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token store's index, read back from its files."""
    folder = f"{scratch_dir(spark, 'token-store')}/store"
    token_store.write_store(docs, folder, vocabulary(), end_id=0)
    return token_store.read_index(spark, folder)


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash_dedup", one_of_each_near_duplicate),
    ("decontamination", drop_leaks),
    ("mixing", mix_sources),
    ("token_store", store_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents; each one's rows are written to the shared folder and read again."""
    folder = scratch_dir(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
