"""Increments: ledgers, resumed loads and snapshot merges, in batch and as streams.

Late rows of the streaming first-seen merge: a row's first date is the least seen up to a batch; a later, lesser date
makes the row come out again with it (append by key and date; readers take the least).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.operators.aggregates import one_each


def due_dates(spark: SparkSession, today: str, days: int, covered: DataFrame) -> DataFrame:
    """due: the last ``days`` dates up to today that the ledger(date) lacks, with the range (from the day before) to ask for."""
    every = spark.range(1).select(F.explode(F.sequence(F.date_sub(F.lit(today).cast("date"), days - 1), F.lit(today).cast("date"))).alias("date"))
    return every.join(covered.select(F.col("date").cast("date")), "date", "left_anti").select("date", F.date_sub("date", 1).alias("from"))


def load_batch(rows: DataFrame, target: str, ledger: str, key: Sequence[str], date: str) -> int:
    """Appends rows with unseen keys, then commits their dates to the ledger. A crash between the two repeats the load, which
    the keys make harmless. Returns how many rows were new."""
    spark = rows.sparkSession

    def read(path: str, schema) -> DataFrame:
        try:
            return spark.read.schema(schema).parquet(path)
        except Exception as missing:  # noqa: BLE001  a target that isn't there yet
            if "PATH_NOT_FOUND" not in str(missing):
                raise
            return spark.createDataFrame([], schema)

    old = read(target, rows.schema)
    one = one_each(rows, key)
    fresh = one.join(old.select(*key), list(key), "left_anti").persist()
    n = fresh.count()
    if n:
        fresh.write.mode("append").parquet(target)
    dates = rows.select(F.col(date).alias("date")).distinct()
    dates.join(read(ledger, dates.schema), "date", "left_anti").coalesce(1).write.mode("append").parquet(ledger)
    fresh.unpersist()
    return n


def unseen(rows: DataFrame, done: DataFrame, key: Sequence[str]) -> DataFrame:
    return rows.join(done.select(*key).distinct(), list(key), "left_anti")


def exists(spark: SparkSession, path: str) -> bool:
    """A finished output: its folder holds _SUCCESS, or it is a file."""
    jvm = spark._jvm
    own = jvm.org.apache.hadoop.fs.Path(path)
    files = own.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.exists(own) and (files.getFileStatus(own).isFile() or files.exists(jvm.org.apache.hadoop.fs.Path(path + "/_SUCCESS")))


def memoised(spark: SparkSession, path: str, make: Callable[[], DataFrame]) -> DataFrame:
    """What is there, or else made, written and read."""
    if not exists(spark, path):
        make().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def through_cache(wanted: DataFrame, cache: DataFrame, fetch: Callable[[DataFrame], DataFrame], key: str) -> tuple[DataFrame, DataFrame]:
    """(rows for all wanted keys, rows to append to the cache)."""
    fresh = fetch(wanted.join(cache, key, "left_anti"))
    return wanted.join(cache, key).unionByName(fresh), fresh


#: Language codes that a transliteration service knows under another name.
LANGUAGE_ALIASES = {"new": "ne", "bho": "hi"}


def service_language(code: str, supported: Sequence[str]) -> str:
    """The service's code for a language; one that it doesn't support raises."""
    known = LANGUAGE_ALIASES.get(code, code)
    if known not in supported:
        raise ValueError(f"no transliteration for {code}")
    return known


def transliterated(wanted: DataFrame, cache: DataFrame, fetch: Callable[[DataFrame, str], DataFrame], language: str, supported: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """wanted(text), cache(language, text, latin), fetch(texts, language) -> (text, latin of all, rows to append to the cache)."""
    code = service_language(language, supported)
    own = cache.where(F.col("language") == code).select("text", "latin")
    both, fresh = through_cache(wanted.select("text").distinct(), own, lambda texts: fetch(texts, code), "text")
    return both, fresh.select(F.lit(code).alias("language"), "text", "latin")


def to_publish(names: DataFrame, listed: DataFrame, always: Sequence[str] = ("changes",)) -> DataFrame:
    """Names that aren't listed, and those that are always replaced."""
    fresh = names.join(listed, "name", "left_anti")
    return fresh.unionByName(names.where(F.split("name", r"\.")[0].isin(list(always)))).distinct()


def changed_documents(old: DataFrame, new: DataFrame, key: str, document: str) -> DataFrame:
    """Documents whose canonical JSON differs (keys in order, at the top level)."""

    def canonical(column: str) -> Column:
        return F.sha2(F.to_json(F.map_from_entries(F.array_sort(F.map_entries(F.from_json(column, "map<string,string>"))))), 256)

    a = old.select(key, canonical(document).alias("__old"))
    met = new.withColumn("__new", canonical(document)).join(a, key, "left")
    return met.where(~F.col("__new").eqNullSafe(F.col("__old"))).drop("__new", "__old")


def stream_json(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """New files of JSON lines, once each."""
    return spark.readStream.schema(schema).json(folder)


def stream_distinct(rows: DataFrame, key: Sequence[str], time: str | None = None, late: str = "1 day") -> DataFrame:
    """One row for each key; with a time column, keys are forgotten once the watermark is past them."""
    if time is None:
        return rows.dropDuplicates(list(key))
    return rows.withWatermark(time, late).dropDuplicatesWithinWatermark(list(key))


def stream_into(rows: DataFrame, target: str, ledger: str, checkpoint: str, key: Sequence[str], date: str):
    """Drains what is there into the target with load_batch; rerunning after a crash is harmless."""
    query = rows.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(lambda batch, _: load_batch(batch, target, ledger, key, date)).start()
    query.awaitTermination()
    return query


def stream_first_seen(rows: DataFrame, key: Sequence[str], date: str) -> DataFrame:
    """First date of each key so far (update mode): state is one row for each key."""
    return rows.groupBy(*key).agg(F.min(date).alias(date))


def windowed_counts(events: DataFrame, time: str, key: str, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Events for each tumbling window and key; an addition to the library's own scope, for streams with event time."""
    return events.withWatermark(time, late).groupBy(F.window(time, width), key).agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("start"), key, "n")
