"""What the training-data operators share: lineage cuts, table reading and id arithmetic."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Labelled ids go to all executors only up to this number (some 30 bytes each); beyond it the texts are shuffled.
BROADCAST_IDS = 500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables, read by Spark alone."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a folder of our own where that is unset."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        context = spark.sparkContext._jsc.sc()
        current = context.getCheckpointDir()
        if current.isDefined():
            return current.get()
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="tabwright-")
        spark.sparkContext.setCheckpointDir(found)
    return found


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder name in the shared folder, whose files go when the driver ends: results that are still to be computed
    read them until then."""
    folder = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path)  # only what exists can be marked
    files.deleteOnExit(path)
    return folder


def cut(frame: DataFrame) -> DataFrame:
    """Materialise in the shared checkpoint folder: survives lost executors and ends the lineage."""
    spark = frame.sparkSession
    folder = shared_dir(spark)
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(folder)
    return frame.checkpoint()


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def crc_fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id's decimal digits modulo ``folds``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def labelled_texts(documents: DataFrame, labels: DataFrame, label: str, most: int | None = None) -> DataFrame:
    """documents(doc_id, text), labels(doc_id, ``label``) -> text, ``label`` of all labelled ids, or of at most ``most``, those
    with the smallest hashes. An id with several texts gives the one with the least crc32, one with several labels the highest."""
    chosen = labels.where(F.col(label).isNotNull()).groupBy("doc_id").agg(F.max(label).cast("int").alias(label))
    chosen = cut(chosen) if most is None else chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    few = most is not None or chosen.count() <= BROADCAST_IDS
    met = documents.select("doc_id", text_or_empty().alias("text")).join(F.broadcast(chosen) if few else chosen, "doc_id")
    return met.groupBy("doc_id", label).agg(F.min(F.struct(F.crc32(F.col("text").cast("binary")), "text")).alias("first")).select("first.text", label)
