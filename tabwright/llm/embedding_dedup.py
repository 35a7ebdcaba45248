"""Embedding near-duplicates by cross-polytope hashing.

Equal vectors are one class with a multiplicity. Each class is rotated by random signs and fast Hadamard
transforms (three of each); the nearest signed axis is one hash, ``hashes`` of them make a bucket of a table,
and each class also probes the buckets with its second nearest axis in one of the hashes. Classes that meet
in a bucket, at least one of them at home there, are compared in double precision in blocks; a pair counts in
the first table, and there in the least bucket, in which it meets. Blocks give sums of links and
edges that span what they link; components follow from these edges.

The number of hashes follows the number of classes. The number of tables follows the chance that a pair just at the
threshold meets in one table, which is drawn for the vectors' width and the number of hashes (``meeting_chance``), so that
such a pair meets somewhere with the probability ``recall``.

Classes find their blocks by id alone; vectors are fetched once the blocks are dealt out, as they came in single
precision where that is exact, and become units in double precision where they are compared.

Defined results: vectors that are null, empty, zero or hold null or non-finite components link with nothing;
vectors of different lengths don't link; rows alike are vectors of their own that link; a cosine of just the threshold
links; with a null id a row is never kept, and components take their least id that isn't null. Empty tables give empty
results. Only the columns named are read, so extra columns may clash freely.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.llm.common import cut
from tabwright.llm.components import components
from tabwright.llm.grouped import in_blocks, per_group


def hadamard(rows: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row; the width is a power of two."""
    n, width = rows.shape
    step = 1
    while step < width:
        pairs = rows.reshape(n, -1, 2, step)
        rows = np.concatenate([pairs[:, :, :1] + pairs[:, :, 1:], pairs[:, :, :1] - pairs[:, :, 1:]], axis=2).reshape(n, width)
        step *= 2
    return rows


def width_bits(dim: int) -> int:
    """Of the power of two that rotations work in: 64 at least, as there are too few of them in narrow ones."""
    return max(6, (dim - 1).bit_length())


def hash_codes(units: np.ndarray, tables: int, hashes: int, seed: int = 1) -> np.ndarray:
    """(vectors, tables, 1 + hashes) buckets: the home bucket, then the probes."""
    n, dim = units.shape
    width = 1 << width_bits(dim)
    padded = np.zeros((n, width))
    padded[:, :dim] = units
    signs = np.random.default_rng([seed, dim]).choice([-1.0, 1.0], (tables, hashes, 3, width))
    out = np.zeros((n, tables, 1 + hashes), np.int64)
    for t in range(tables):
        best, second = [], []
        for h in range(hashes):
            turned = padded
            for s in signs[t, h]:
                turned = hadamard(turned * s)
            size = np.abs(turned)
            top = size.argmax(1)
            rows = np.arange(n)
            best.append(2 * top + (turned[rows, top] > 0))
            size[rows, top] = -1
            top = size.argmax(1)
            second.append(2 * top + (turned[rows, top] > 0))
        for probe in range(1 + hashes):
            code = np.zeros(n, np.int64)
            for h in range(hashes):
                code = code * (2 * width) + (second[h] if probe == h + 1 else best[h])
            out[:, t, probe] = code
    return out


def meeting_chance(dim: int, hashes: int, threshold: float, pairs: int = 4000) -> float:
    """The share of random pairs at the threshold that meet in a table."""
    draw = np.random.default_rng([7, dim, hashes])
    x, z = draw.standard_normal((2, pairs, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z -= (z * x).sum(1, keepdims=True) * x
    z /= np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-12)
    a, b = (hash_codes(v, 1, hashes)[:, 0] for v in (x, threshold * x + math.sqrt(1 - threshold**2) * z))
    return float(((a == b[:, :1]) | (b == a[:, :1])).any(1).mean())


def tables_for(dim: int, hashes: int, threshold: float, recall: float) -> int:
    """The number of tables in which such a pair meets at least once with the probability ``recall``."""
    chance = min(max(meeting_chance(dim, hashes, threshold), 1e-3), 0.999)
    return math.ceil(math.log(1 - recall) / math.log(1 - chance))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """vec_id, embedding -> vec_id, digest, dim, vector (bytes of singles where these are exact, else of doubles); nulls for
    vectors that link with nothing."""
    for batch in batches:
        digests, dims, vectors = [], [], []
        for row in batch.column(1).to_pylist():
            digest = dim = raw = None
            if row and None not in row:
                vector = np.array(row, np.float64)
                if np.isfinite(vector).all() and vector.any():
                    with np.errstate(over="ignore", under="ignore"):
                        single = vector.astype(np.float32)
                    digest, dim = hashlib.blake2b(vector.tobytes(), digest_size=16).digest(), len(row)
                    raw = (single if (single == vector).all() else vector).tobytes()
            digests.append(digest)
            dims.append(dim)
            vectors.append(raw)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(digests, pa.binary()), pa.array(dims, pa.int32()), pa.array(vectors, pa.binary())], names=["vec_id", "digest", "dim", "vector"])


def units(vectors: list[bytes], dim: int) -> np.ndarray:
    """Unit vectors in double precision."""
    rows = np.stack([np.frombuffer(v, np.float32 if len(v) == 4 * dim else np.float64).astype(np.float64) for v in vectors])
    rows /= np.abs(rows).max(1, keepdims=True)  # neither overflow nor underflow in the norm
    return rows / np.sqrt((rows * rows).sum(1, keepdims=True))


def _coded(tables: int, hashes: int, kind: str):
    """node, times, dim, vector -> also codes (packed) and buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("vector").to_pylist()
            dims = batch.column("dim").to_numpy()
            codes: list[np.ndarray] = [np.zeros(0, np.int64)] * len(vectors)
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                for i, c in zip(at, hash_codes(units([vectors[i] for i in at], dim), tables, hashes), strict=True):
                    codes[i] = c.ravel()
            packed = [c.astype(kind).tobytes() for c in codes]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(packed, pa.binary()), pa.array(codes, pa.list_(pa.int64()))], names=[*batch.schema.names, "codes", "buckets"])

    return run


def _links(threshold: float, tables: int, probes: int, kind: str):
    """Work on the rows of one block pair of one bucket: links of each class and edges that span them."""

    def work(rows: pa.Table) -> dict[str, list] | None:
        n = rows.num_rows
        home = np.array(rows.column("home").to_pylist(), bool)
        if n < 2 or not home.any():
            return None
        turned = units(rows.column("vector").to_pylist(), rows.column("dim")[0].as_py())
        close = turned @ turned.T >= threshold
        own = np.array(rows.column("own_block").to_pylist())
        if rows.column("left")[0].as_py() != rows.column("right")[0].as_py():
            close &= own[:, None] != own[None, :]  # rows of one block meet in its own pair
        close &= home[:, None] | home[None, :]
        x, y = np.nonzero(np.triu(close, 1))
        if not len(x):
            return None
        codes = np.frombuffer(b"".join(rows.column("codes").to_pylist()), kind).astype(np.int64).reshape(n, tables, probes)
        table, bucket = rows.column("table")[0].as_py(), rows.column("bucket")[0].as_py()
        keep = []
        for low in range(0, len(x), 20_000):
            a, b = codes[x[low : low + 20_000]], codes[y[low : low + 20_000]]
            at_b = (a == b[:, :, :1]).any(2)  # a is in b's home bucket
            at_a = (b == a[:, :, :1]).any(2)
            first = (at_a | at_b).argmax(1) == table
            # In one table a pair can meet in both home buckets; the lesser one counts.
            where = np.minimum(np.where(at_a[:, table], a[:, table, 0], np.iinfo(np.int64).max), np.where(at_b[:, table], b[:, table, 0], np.iinfo(np.int64).max))
            keep.append(first & (where == bucket))
        kept = np.concatenate(keep)
        x, y = x[kept], y[kept]
        if not len(x):
            return None
        times = np.array(rows.column("times").to_pylist(), np.int64)
        links = np.bincount(x, times[y], n) + np.bincount(y, times[x], n)
        root = np.arange(n)

        def find(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        for i, j in zip(x.tolist(), y.tolist(), strict=True):
            i, j = find(i), find(j)
            if i != j:
                root[max(i, j)] = min(i, j)
        digests = rows.column("digest").to_pylist()
        on = np.flatnonzero(links)
        return {"digest": [digests[i] for i in on], "links": links[on].astype(np.int64).tolist(), "root": [digests[find(i)] for i in on]}

    return work


def near_duplicates(embeddings: DataFrame, threshold: float = 0.95, block: int = 512, hashes: int | None = None, recall: float = 0.998) -> DataFrame:
    """embeddings(vec_id, embedding) -> vec_id, n_links, component_id, kept."""
    rows = embeddings.select(F.col("vec_id").cast("long"), "embedding").mapInArrow(_read, "vec_id long, digest binary, dim int, vector binary")
    classes = rows.where("digest is not null").groupBy("digest", "dim").agg(F.count(F.lit(1)).alias("times"), F.min("vec_id").alias("least"), F.first("vector").alias("vector"))
    # A node's bytes begin with its least id, so the least node of a component names its least id (null ids are last).
    sortable = F.lpad(F.hex(F.coalesce("least", F.lit(2**63 - 1)).bitwiseXOR(F.lit(-(2**63)))), 16, "0")
    classes = cut(classes.withColumn("node", F.concat(F.unhex(sortable), F.when(F.col("least").isNull(), F.unhex(F.lit("01"))).otherwise(F.unhex(F.lit("00"))), "digest")))
    seen = classes.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.max("dim"), F.lit(2)).alias("dim")).first()
    bits = width_bits(seen["dim"]) + 1  # of one hash: an axis and its sign
    if hashes is None:
        # About 64 classes at home in a bucket, if they are spread evenly; codes have 62 bits at most.
        hashes = min(62 // bits, max(2, math.ceil(math.log2(max(seen["n"], 2) / 64) / bits)))
    tables = tables_for(seen["dim"], hashes, threshold, recall)
    kind = "<i2" if bits * hashes < 16 else "<i4" if bits * hashes < 32 else "<i8"
    coded = cut(classes.select("node", "times", "dim", "vector").mapInArrow(_coded(tables, hashes, kind), "node binary, times long, dim int, vector binary, codes binary, buckets array<long>"))
    met = coded.select("node", "dim", F.posexplode("buckets").alias("at", "bucket"))
    met = met.select("node", "dim", F.expr(f"at div {1 + hashes}").cast("int").alias("table"), (F.col("at") % (1 + hashes) == 0).alias("home"), "bucket")
    key = ["dim", "table", "bucket"]
    dealt = in_blocks(met, key, F.col("node"), block).join(coded.select("node", "times", "vector", "codes"), "node").withColumnRenamed("node", "digest")
    arrow = pa.schema([("digest", pa.binary()), ("links", pa.int64()), ("root", pa.binary())])
    found = cut(per_group(dealt, [*key, "left", "right"], _links(threshold, tables, 1 + hashes, kind), "digest binary, links long, root binary", arrow))
    joined = components(found.select(F.col("digest").alias("a"), F.col("root").alias("b")))
    totals = found.groupBy("digest").agg(F.sum("links").alias("links")).withColumnRenamed("digest", "node")
    named = classes.select("digest", "node", "times").join(totals, "node", "left").join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = F.conv(F.hex(F.substring("component", 1, 8)), 16, -10).cast("bigint").bitwiseXOR(F.lit(-(2**63)))
    named = named.select("digest", (F.col("times") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.when(F.hex(F.substring("component", 9, 1)) == "00", least).alias("component_id"))
    ids = rows.select("vec_id", "digest")
    out = ids.join(named, "digest", "left")
    component = F.when(F.col("digest").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
