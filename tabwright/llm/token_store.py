"""Content-addressed store of token ids.

Every text is encoded and ends with an end id. A rolling hash over the last ``WINDOW`` ids cuts a document's ids
into chunks (about ``AVERAGE`` ids; MIN to MAX). A chunk's address is the hash of its bytes, and chunks are
stored once. A document's recipe lists its chunks' addresses and lengths, with their Merkle root; recipes are
written in ascending id order with the number of ids before each document, and Merkle nodes over runs of
recipes up to one root for each part, and over the parts up to one root for the store, make the manifest. Reading checks
all of it: chunks against their addresses, recipes against their roots, the recipes' order against the manifest.

Layout under a folder: ``objects`` chunks (kind 0: address, payload of little-endian ids), then recipes as they were
made (kind 1), one file for each task; ``recipes`` the same in order (part, doc_id, slot, start, n_tokens, addresses,
lengths, root), ``manifest`` (part, level, node, root; part -1 stands over the parts). Reading also checks the checksums
of Parquet's pages, on every file system; the local one keeps no .crc files beside them.

Defined results: a null or empty text holds the end id alone; null ids come first; repeated rows have a recipe
each, and a range of the order may end between rows of one id; an empty table makes an empty store. Files that don't fit
each other raise. Only the columns named are read, so extra columns may clash freely.
"""

from __future__ import annotations

import hashlib
import itertools
import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import LongType
from pyspark.sql.window import Window

from tabwright.llm.common import cut
from tabwright.llm.encoding import Encoder, shared_encoder, text_groups

WINDOW, MIN, AVERAGE, MAX = 8, 64, 512, 4096
#: Addresses that a task remembers, so that a chunk which many of its documents hold leaves the task once.
SEEN = 200_000
ADDRESS = 16
OBJECTS = "kind int, key binary, doc_id long, width int, payload binary, addresses array<binary>, lengths array<int>, root binary"
#: Hadoop's local file system makes a .crc file with each file, and starts a process (chmod) for either, which while it starts
#: counts with all of the executor's memory. Files of the raw one are single; page checksums stand in for the .crc files.
FILES = {"compression": "zstd", "parquet.page.write-checksum.enabled": "true", "fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}
CHECKED = {"parquet.page.verify-checksum.enabled": "true"}
_ODD = np.uint64(0x9E3779B97F4A7C15)
_POWERS: list[np.ndarray] = []


def address(payload: bytes) -> bytes:
    return hashlib.blake2b(payload, digest_size=ADDRESS).digest()


def merkle(leaves: list[bytes]) -> bytes:
    """Pairs are hashed level by level; an odd node goes up as it is; no leaf gives the hash of nothing."""
    if not leaves:
        return address(b"")
    while len(leaves) > 1:
        leaves = [address(b"".join(leaves[i : i + 2])) if i + 1 < len(leaves) else leaves[i] for i in range(0, len(leaves), 2)]
    return leaves[0]


def _powers(n: int) -> np.ndarray:
    """_ODD ** 0 .. n-1, wrapping."""
    if not _POWERS or len(_POWERS[0]) < n:
        with np.errstate(over="ignore"):
            _POWERS[:] = [np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(max(n, 1 << 16), _ODD)]))]
    return _POWERS[0][:n]


def cut_points(ids: np.ndarray, bounds: np.ndarray) -> list[tuple[int, int]]:
    """Chunks [from, to) of the documents that ``bounds`` cuts the ids into."""
    n = len(ids)
    hits = np.zeros(0, np.int64)
    if n >= WINDOW:
        with np.errstate(over="ignore"):
            mixed = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
            mixed ^= mixed >> np.uint64(29)
            power = _powers(WINDOW)
            rolled = np.zeros(n - WINDOW + 1, np.uint64)
            for k in range(WINDOW):
                rolled += mixed[k : k + len(rolled)] * power[k]
            rolled ^= rolled >> np.uint64(32)
            hits = np.flatnonzero((rolled & np.uint64(AVERAGE - 1)) == 0) + WINDOW  # a chunk ends after its window
    cuts = hits.tolist()
    chunks, at = [], 0
    for low, high in itertools.pairwise(bounds.tolist()):
        start = low
        while high - start > MAX or (at < len(cuts) and cuts[at] < high):
            while at < len(cuts) and cuts[at] < start + MIN:
                at += 1
            if at < len(cuts) and cuts[at] < high and cuts[at] - start <= MAX:
                end = cuts[at]
            elif high - start > MAX:
                end = start + MAX
            else:
                break
            chunks.append((start, end))
            start = end
        if start < high:
            chunks.append((start, high))
    return chunks


def _objects(spec, end_id: int):
    """mapInArrow: documents to chunk and recipe rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with shared_encoder(spec.value) as encoder:
            yield from stored(batches, encoder)

    def stored(batches: Iterator[pa.RecordBatch], encoder: Encoder) -> Iterator[pa.RecordBatch]:
        width = encoder.dtype.itemsize
        end = np.array([end_id], encoder.dtype).tobytes()
        task = TaskContext.get().partitionId()
        seen: dict[bytes, None] = {}
        made = 0
        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for low, high in text_groups(texts):
                out: dict[str, list] = {k: [] for k in ("kind", "key", "doc_id", "width", "payload", "addresses", "lengths", "root")}

                def put(*row, out=out):
                    for column, x in zip(out.values(), row, strict=True):
                        column.append(x)

                coded = [x + end for x in encoder.encode(texts[low:high])]
                sizes = np.array([len(x) // width for x in coded], np.int64)
                bounds = np.concatenate([[0], np.cumsum(sizes)])
                whole = b"".join(coded)
                chunks = cut_points(np.frombuffer(whole, encoder.dtype), bounds)
                own: list[tuple[bytes, int]] = []
                doc = 0
                for start, stop in chunks:
                    payload = whole[start * width : stop * width]
                    digest = address(payload)
                    own.append((digest, stop - start))
                    if digest not in seen:
                        if len(seen) >= SEEN:
                            seen.clear()
                        seen[digest] = None
                        put(0, digest, None, width, payload, None, None, None)
                    if stop == bounds[doc + 1]:
                        addresses = [d for d, _ in own]
                        put(1, b"%d-%d" % (task, made), doc_ids[low + doc], width, None, addresses, [k for _, k in own], merkle(addresses))
                        made, doc, own = made + 1, doc + 1, []
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(out["kind"], pa.int32()), pa.array(out["key"], pa.binary()), pa.array(out["doc_id"], pa.int64()), pa.array(out["width"], pa.int32()),
                        pa.array(out["payload"], pa.binary()), pa.array(out["addresses"], pa.list_(pa.binary())), pa.array(out["lengths"], pa.list_(pa.int32())), pa.array(out["root"], pa.binary()),
                    ],
                    names=list(out),
                )

    return run


def _write(frame: DataFrame, path: str, **options: str) -> None:
    frame.write.options(**FILES, **options).parquet(path)


def _read(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read.options(**CHECKED)
    return (reader.schema(schema) if schema else reader).parquet(path)


def write_store(documents: DataFrame, folder: str, vocabulary: str, end_id: int = 0) -> None:
    """documents(doc_id, text) -> a store in ``folder``. vocabulary: a file of the tokenizers library, on the driver."""
    spark = documents.sparkSession
    with open(vocabulary, encoding="utf-8") as file:
        spec = spark.sparkContext.broadcast(file.read())  # one vocabulary file, of 1.6 MB
    made = documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(_objects(spec, end_id), OBJECTS)
    # Chunks meet by address and the first stays; recipes have keys of their own. Tasks have left out what they have
    # sent before, so a second pass over their rows ahead of the shuffle, as dropDuplicates makes, would find little.
    first = F.lag("key").over(Window.partitionBy("kind", "key").orderBy("key")).isNull()
    _write(made.withColumn("first", first).where("first").drop("first"), f"{folder}/objects", **{"parquet.compression.codec.zstd.level": "1"})
    recipes = _read(spark, f"{folder}/objects", OBJECTS).where("kind = 1")
    n_tokens = F.aggregate("lengths", F.lit(0).cast("long"), lambda s, n: s + n)
    order = ["doc_id", "n_tokens", "root", "key"]
    recipes = recipes.select("doc_id", n_tokens.alias("n_tokens"), "key", "addresses", "lengths", "root")
    ordered = recipes.repartitionByRange(*order).sortWithinPartitions(*order)
    _write(ordered.withColumn("part", F.spark_partition_id()), f"{folder}/unnumbered")
    parts = _read(spark, f"{folder}/unnumbered")
    sums = parts.groupBy("part").agg(F.sum("n_tokens").alias("ids"))
    before = F.coalesce(F.sum("ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    within = Window.partitionBy("part").orderBy(*order)
    started = parts.join(F.broadcast(sums.select("part", before.alias("before"))), "part")  # one row for each part
    start = F.col("before") + F.coalesce(F.sum("n_tokens").over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    numbered = started.select("part", (F.row_number().over(within) - 1).alias("slot"), "doc_id", start.alias("start"), "n_tokens", "addresses", "lengths", "root")
    _write(numbered, f"{folder}/recipes")
    _write(manifest(spark, folder), f"{folder}/manifest")


def manifest(spark: SparkSession, folder: str, fan: int = 256) -> DataFrame:
    """part, level, node, root: Merkle nodes over runs of ``fan`` recipes, level by level up to one root for each part, then
    over runs of parts (as part -1) up to one root for the store."""
    recipes = _read(spark, f"{folder}/recipes")
    last = recipes.agg(F.coalesce(F.max("slot"), F.lit(0)).cast("long").alias("slot"), F.coalesce(F.max("part"), F.lit(0)).cast("long").alias("part")).first()
    levels: list[DataFrame] = []

    def climb(level: DataFrame, top: int) -> DataFrame:
        """Nodes numbered 0 .. top in each part, up to one node."""
        depth = 0
        while not depth or top:
            kids = F.array_sort(F.collect_list(F.struct("node", "root")))  # ``fan`` at most
            level = level.groupBy("part", F.expr(f"node div {fan}").alias("up")).agg(F.sha2(F.array_join(F.transform(kids, lambda x: x["root"]), ""), 256).alias("root"))
            level = cut(level.withColumnRenamed("up", "node"))
            depth, top = depth + 1, top // fan
            levels.append(level.select("part", F.lit(depth).alias("level"), "node", "root"))
        return level

    roots = climb(recipes.select(F.col("part").cast("long"), F.col("slot").cast("long").alias("node"), F.hex("root").alias("root")), last["slot"])
    climb(roots.select(F.lit(-1).cast("long").alias("part"), F.col("part").alias("node"), "root"), last["part"])
    return reduce(DataFrame.unionByName, levels)


def check_manifest(spark: SparkSession, folder: str) -> None:
    """Raises unless the manifest is that of the recipes in their order."""
    stored, made = _read(spark, f"{folder}/manifest"), manifest(spark, folder)
    if not stored.exceptAll(made).unionByName(made.exceptAll(stored)).isEmpty():
        raise ValueError(f"the recipes in {folder} aren't those of its manifest")


def chunks(spark: SparkSession, folder: str) -> DataFrame:
    """address, width, payload of every stored chunk."""
    return _read(spark, f"{folder}/objects", OBJECTS).where("kind = 0").select(F.col("key").alias("address"), "width", "payload")


def _checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks read back: the address has to fit the payload; crc32 of the ids as unsigned 32-bit."""
    for batch in batches:
        crcs = []
        for key, width, payload in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if address(payload) != key:
                raise ValueError(f"stored chunk {key.hex()} has other bytes than its address says")
            crcs.append(zlib.crc32(np.frombuffer(payload, f"<u{width}").astype("<u4").tobytes()))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(crcs, pa.int64())], names=["address", "crc"])


def _checked_recipes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """start, n_tokens, addresses, lengths, root -> start, address, after: a row for each chunk, with the bytes that follow it
    in its document. The root has to fit the addresses, the lengths their sum."""
    for batch in batches:
        n = batch.num_rows
        for low in range(0, n, 2000):
            starts, found, after = [], [], []
            for start, tokens, addresses, lengths, root in zip(*[c.to_pylist() for c in batch.slice(low, 2000).columns], strict=True):
                if merkle(addresses) != root or sum(lengths) != tokens or len(lengths) != len(addresses):
                    raise ValueError(f"the recipe at {start} has other chunks than its root says")
                starts += [start] * len(addresses)
                found += addresses
                for size in lengths:
                    tokens -= size
                    after.append(4 * tokens)
            yield pa.RecordBatch.from_arrays([pa.array(starts, pa.int64()), pa.array(found, pa.binary()), pa.array(after, pa.int64())], names=["start", "address", "after"])


_SHIFTS: list[np.ndarray] = []


def _shift_tables() -> list[np.ndarray]:
    """For 2 ** k zero bytes: what each byte of a crc32 becomes, as 4 x 256 tables."""
    if not _SHIFTS:
        columns = np.zeros(32, np.uint32)  # what one zero bit makes of each bit of the crc
        columns[0] = 0xEDB88320
        columns[1:] = np.uint32(1) << np.arange(31, dtype=np.uint32)

        def table(cols: np.ndarray) -> np.ndarray:
            out = np.zeros((4, 256), np.uint32)
            for byte in range(4):
                for bit in range(8):
                    out[byte] ^= np.where((np.arange(256) >> bit) & 1 == 1, cols[8 * byte + bit], np.uint32(0)).astype(np.uint32)
            return out

        now = table(columns)
        for _ in range(3):  # one bit to eight
            now = table(_apply(now, _apply(now, np.uint32(1) << np.arange(32, dtype=np.uint32))))
        for _ in range(45):
            _SHIFTS.append(now)
            now = table(_apply(now, _apply(now, np.uint32(1) << np.arange(32, dtype=np.uint32))))
    return _SHIFTS


def _apply(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return table[0][crc & 255] ^ table[1][(crc >> 8) & 255] ^ table[2][(crc >> 16) & 255] ^ table[3][crc >> 24]


def crc_before(crc: np.ndarray, n_bytes: np.ndarray) -> np.ndarray:
    """The part that a piece with this crc32 has in the whole's crc32 if ``n_bytes`` follow it. The parts xor to the whole's."""
    out = crc.astype(np.uint32)
    for k, table in enumerate(_shift_tables()):
        on = (n_bytes >> k) & 1 == 1
        if on.any():
            out[on] = _apply(table, out[on])
        if not (n_bytes >> (k + 1)).any():
            break
    return out


@pandas_udf(LongType())
def _crc_part(crc, n_bytes):
    import pandas as pd

    return pd.Series(crc_before(crc.to_numpy().astype(np.uint32), n_bytes.to_numpy().astype(np.int64)).astype(np.int64))


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    """From the files alone: doc_id, start, n_tokens, ids_crc32, root of every document. Raises, now or when it is computed, if
    manifest, recipes and chunks don't fit each other."""
    check_manifest(spark, folder)
    recipes = _read(spark, f"{folder}/recipes")
    parts = recipes.select("start", "n_tokens", "addresses", "lengths", "root").mapInArrow(_checked_recipes, "start long, address binary, after long")
    stored = chunks(spark, folder).mapInArrow(_checked, "address binary, crc long")
    crc = parts.join(stored, "address").groupBy("start").agg(F.bit_xor(_crc_part("crc", "after")).alias("ids_crc32"), F.count(F.lit(1)).alias("found"))
    whole = recipes.join(crc, "start", "left")
    complete = F.when(F.col("found") == F.size("addresses"), F.col("ids_crc32")).otherwise(F.raise_error(F.lit("a chunk of a recipe is missing")).cast("long"))
    return whole.select("doc_id", "start", "n_tokens", complete.alias("ids_crc32"), F.hex("root").alias("root"))


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, ids: whole documents rebuilt from recipes and chunks."""
    recipes = _read(spark, f"{folder}/recipes")
    parts = recipes.select("doc_id", "start", F.posexplode("addresses").alias("at", "address"))
    met = parts.join(chunks(spark, folder), "address")
    ordered = F.array_sort(F.collect_list(F.struct("at", "width", "payload")))

    @pandas_udf("array<long>")
    def join_ids(pieces):
        return pieces.map(lambda row: np.concatenate([np.frombuffer(p["payload"], f"<u{p['width']}") for p in row]).astype(np.int64))

    return met.groupBy("doc_id", "start").agg(ordered.alias("pieces")).select("doc_id", "start", join_ids("pieces").alias("ids"))
