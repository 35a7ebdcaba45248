"""Near-duplicate texts by ProbMinHash.

A text is its runs of ``SHINGLE`` words, weighted by how often each stands in it. Every shingle sends arrivals of a
Poisson process, whose rate is its weight, to random registers; a register keeps the shingle that arrives first,
and a shingle stops once its next arrival comes after the last register's. Two texts agree in a register
with the probability of their probability Jaccard similarity, which is the plain one where all weights are
equal.

Equal word sequences are one class. Classes whose registers agree in a whole band share a bucket:

1. In each bucket all classes are compared with its pivot, the class with the least document.
2. What is linked so far is joined. In each bucket that still holds several components, every two classes of
   different components whose registers agree to the threshold less three standard deviations are compared, in
   blocks; the largest component's classes meet those of the others, not each other. A pair that shares several buckets is compared in that of its first band. Where a block pair links two
   components, they are one for the rest of it, and only the links leave it.

A comparison computes the exact probability Jaccard similarity of whole texts; a link needs ``threshold``.
Components of the links are the near-duplicate classes.

Defined results: texts of fewer than ``SHINGLE`` words have one shingle, all their words; texts without words
(null, empty, white space) are alike; rows alike are one class; a class is named by its least id that isn't
null, and only a class without any other id keeps a null one. Empty tables give empty results. Only the columns named
are read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.llm.common import cut
from tabwright.llm.components import components
from tabwright.llm.encoding import text_groups
from tabwright.llm.grouped import across_parts, per_group, small
from tabwright.llm.words import WordTable, mix, window_hashes

SHINGLE = 5
BANDS, ROWS = 20, 6
REGISTERS = BANDS * ROWS
_STEP, _PLACE = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def shingle_hashes(words: np.ndarray) -> np.ndarray:
    """One hash for each run of five words; fewer words make one shingle; no words, none."""
    return window_hashes(words, min(SHINGLE, len(words))) if len(words) else np.zeros(0, np.uint64)


def prob_min_hash(shingles: np.ndarray, weights: np.ndarray, owner: np.ndarray, texts: int) -> np.ndarray:
    """(texts, registers) hashes of the shingles that arrive first. owner: the text of each shingle; registers of
    texts without shingles stay 0."""
    first = np.full(texts * REGISTERS, np.inf)
    names = np.zeros(texts * REGISTERS, np.uint64)
    time = np.zeros(len(shingles))
    state = shingles.copy()
    rate = weights.astype(np.float64)
    name, own = shingles, owner
    while len(name):
        with np.errstate(over="ignore"):
            state = mix(state + _STEP)
            place = (mix(state ^ _PLACE) >> np.uint64(32)) % np.uint64(REGISTERS)
        time = time - np.log((state >> np.uint64(11)).astype(np.float64) * 2.0**-53 + 2.0**-54) / rate
        at = own * REGISTERS + place.astype(np.int64)
        np.minimum.at(first, at, time)
        won = first[at] == time
        names[at[won]] = name[won]
        last = first.reshape(texts, REGISTERS).max(1)
        going = time < last[own]
        name, own, time, state, rate = name[going], own[going], time[going], state[going], rate[going]
    return names.reshape(texts, REGISTERS)


def weighted(shingles: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (owner, shingle) with counts, ordered by owner, then shingle."""
    order = np.lexsort((shingles, owner))
    shingles, owner = shingles[order], owner[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (shingles[1:] != shingles[:-1])
    at = np.flatnonzero(new)
    return shingles[at], np.diff(np.append(at, len(owner))), owner[at]


def probability_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Of two texts' (sorted distinct shingles, counts): the sum over common ones of 1 / sum of max(x' / x, y' / y)."""
    (one, x), (two, y) = a, b
    if not len(one) or not len(two):
        return float(len(one) == len(two))
    _, i, j = np.intersect1d(one, two, assume_unique=True, return_indices=True)
    if not len(i):
        return 0.0
    x, y = x / x.sum(), y / y.sum()
    ratio = y[j] / x[i]
    order = np.argsort(ratio, kind="stable")
    ratio, px, py = ratio[order], x[i][order], y[j][order]
    # What stands in one text alone has the ratio 0 or infinity, so it is always on the same side.
    below = np.append(0, np.cumsum(px)) + (1 - px.sum())
    above = np.append(np.cumsum(py[::-1])[::-1], 0) + (1 - py.sum())
    at = np.searchsorted(ratio, ratio, "left")
    return float((1 / (above[at] / py + below[at] / px)).sum())


_SKETCH = "doc_id long, text_crc long, digest binary, bands array<long>, registers binary"


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, text -> doc_id, crc32 of the text, digest of the words, band hashes, registers as 8 bits each. Within a task's batch, the
    sketch of a word sequence goes out once."""
    table = WordTable()
    for batch in batches:
        ids = batch.column(0).to_pylist()
        texts = [t or "" for t in batch.column(1).to_pylist()]
        for low, high in text_groups(texts, 2_000_000):
            parts, digests, fresh, crcs = [], [], [], []
            seen: set[bytes] = set()
            for text in texts[low:high]:
                words = table.read(text.split())[0]
                digest = hashlib.blake2b(words.tobytes(), digest_size=16).digest()
                digests.append(digest)
                crcs.append(zlib.crc32(text.encode()))
                fresh.append(digest not in seen)
                if fresh[-1]:
                    seen.add(digest)
                    parts.append(shingle_hashes(words))
            owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
            names, counts, owner = weighted(np.concatenate(parts), owner)
            registers = prob_min_hash(names, counts, owner, len(parts))
            bands = np.zeros((len(parts), BANDS), np.uint64)
            for k in range(BANDS):
                with np.errstate(over="ignore"):
                    held = np.full(len(parts), k + 1, np.uint64)
                    for r in range(ROWS):
                        held = mix((held + registers[:, k * ROWS + r]) * _STEP)
                    bands[:, k] = held
            short = (registers & np.uint64(0xFF)).astype(np.uint8)
            made = iter(range(len(parts)))
            out_bands, out_registers = [], []
            for new in fresh:
                k = next(made) if new else None
                out_bands.append(bands[k].astype(np.int64).tolist() if new else None)
                out_registers.append(short[k].tobytes() if new else None)
            yield pa.RecordBatch.from_arrays([pa.array(ids[low:high], pa.int64()), pa.array(crcs, pa.int64()), pa.array(digests, pa.binary()), pa.array(out_bands, pa.list_(pa.int64())), pa.array(out_registers, pa.binary())], names=["doc_id", "text_crc", "digest", "bands", "registers"])


def _shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """text -> digest, shingles (sorted, 8 bytes each), counts (4 bytes each)."""
    table = WordTable()
    for batch in batches:
        for low in range(0, batch.num_rows, 256):
            digests, names, counts = [], [], []
            for text in batch.column(0).slice(low, 256).to_pylist():
                words = table.read((text or "").split())[0]
                digests.append(hashlib.blake2b(words.tobytes(), digest_size=16).digest())
                own, times = np.unique(shingle_hashes(words), return_counts=True)
                names.append(own.tobytes())
                counts.append(times.astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array(names, pa.binary()), pa.array(counts, pa.binary())], names=["digest", "shingles", "counts"])


def _arrays(row: dict) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(row["shingles"], np.uint64), np.frombuffer(row["counts"], "<u4").astype(np.float64)


def _verify(threshold: float):
    """Work on one pivot's rows: the pivot itself first, then those to compare with it."""

    def work(rows: pa.Table) -> dict[str, list] | None:
        listed = rows.select(["is_pivot", "digest", "shingles", "counts"]).to_pylist()
        pivot = next((r for r in listed if r["is_pivot"]), None)
        if pivot is None:
            return None
        mine = _arrays(pivot)
        others = [r for r in listed if not r["is_pivot"]]
        # Rounded, so that a similarity of just the threshold isn't lost to the last bits of a sum.
        close = [round(probability_jaccard(mine, _arrays(r)), 9) for r in others]
        return {"a": [pivot["digest"]] * len(others), "b": [r["digest"] for r in others], "similarity": close}

    return work


def _open_pairs(rows: pa.Table, component: np.ndarray, floor: float) -> Iterator[tuple[int, np.ndarray]]:
    """Of one block pair of a bucket: rows with the later rows that they are to be compared with, which are those of
    other components (as ``component`` says by then) with registers alike, unless an earlier band has the pair too."""
    n = rows.num_rows
    registers = np.frombuffer(b"".join(rows.column("registers").to_pylist()), np.uint8).reshape(n, REGISTERS)
    bands = rows.column("bands").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(n, BANDS)
    band = int(np.flatnonzero(bands[0] == rows.column("bucket")[0].as_py())[0])
    own = rows.column("own_block").to_numpy()
    across = rows.column("left")[0].as_py() != rows.column("right")[0].as_py()  # two rows of one block meet where it is paired with itself
    for i in range(n - 1):
        at = np.flatnonzero((component[i + 1 :] != component[i]) & ((own[i + 1 :] != own[i]) if across else True)) + i + 1
        at = at[(registers[at] == registers[i]).mean(1) >= floor]
        at = at[(bands[at, :band] != bands[i, :band]).all(1)]
        if len(at):
            yield i, at


def _numbered(rows: pa.Table) -> np.ndarray:
    return np.unique(np.array(rows.column("component").to_pylist(), object), return_inverse=True)[1]


def _open(floor: float):
    """Work on one block pair: its classes that are to be compared with any other."""

    def work(rows: pa.Table) -> dict[str, list] | None:
        wanted = np.zeros(rows.num_rows, bool)
        for i, at in _open_pairs(rows, _numbered(rows), floor):
            wanted[i] = wanted[at] = True
        found = rows.select(["bucket", "digest", "component"]).filter(pa.array(wanted))
        return {name: found.column(name).to_pylist() for name in found.column_names} if found.num_rows else None

    return work


def _links(threshold: float, floor: float):
    """Work on one block pair with its shingles: the verified links that join its components."""

    def work(rows: pa.Table) -> dict[str, list] | None:
        texts = [_arrays(r) for r in rows.select(["shingles", "counts"]).to_pylist()]
        component = _numbered(rows)
        ends = np.cumsum([len(names) for names, _ in texts])
        numbers = np.split(np.unique(np.concatenate([names for names, _ in texts]), return_inverse=True)[1], ends[:-1])
        shares = [counts / counts.sum() for _, counts in texts]
        even = [bool((counts == counts[0]).all()) if len(counts) else False for _, counts in texts]
        mine = np.zeros(max((int(n.max()) for n in numbers if len(n)), default=0) + 1)
        digests = rows.column("digest").to_pylist()
        a, b = [], []
        for i, at in _open_pairs(rows, component, floor):
            mine[numbers[i]] = shares[i]
            for j in at.tolist():
                if component[i] == component[j]:
                    continue
                theirs = mine[numbers[j]]
                if even[i] and even[j]:
                    common = np.count_nonzero(theirs)
                    close = common / (len(numbers[i]) + len(numbers[j]) - common)
                elif np.minimum(theirs, shares[j]).sum() < threshold - 1e-6:
                    continue  # texts can't agree in a register more often than their distributions overlap
                else:
                    close = probability_jaccard(texts[i], texts[j])
                if round(close, 9) >= threshold:
                    component[component == component[j]] = component[i]
                    a.append(digests[i])
                    b.append(digests[j])
            mine[numbers[i]] = 0
        return {"a": a, "b": b} if a else None

    return work


def near_duplicates(documents: DataFrame, threshold: float = 0.8, block: int = 256, broadcast_ids: int = 500_000) -> DataFrame:
    """documents(doc_id, text) -> doc_id, text_crc (crc32 of the text), class_id, kept, exact_copies (rows of the same words).

    kept: the one of the class with the least id, null ids last, and of equal ids the least crc32. Rows alike in both
    are told apart by whoever takes one of them.
    """
    docs = documents.select(F.col("doc_id").cast("long"), "text")
    sketched = cut(docs.mapInArrow(_sketches, _SKETCH))
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_crc")
    classes = sketched.groupBy("digest").agg(F.min("doc_id").alias("least"), F.min(place).alias("place"), F.count(F.lit(1)).alias("copies"))
    sketches = sketched.where("bands is not null").dropDuplicates(["digest"]).select("digest", "bands", "registers")
    classes = cut(classes.join(sketches, "digest"))
    in_bucket = classes.select("digest", "least", F.explode("bands").alias("bucket"))
    order = F.struct(F.coalesce("least", F.lit(2**63 - 1)).alias("least"), "digest")
    pivots = in_bucket.groupBy("bucket").agg(F.min(order).alias("pivot"), F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket", F.col("pivot.digest").alias("pivot"))
    met = cut(in_bucket.join(pivots, "bucket").select("bucket", "digest", "pivot"))

    def shingles_of(wanted: DataFrame) -> DataFrame:
        """wanted(digest), distinct -> digest, shingles, counts."""
        sources = cut(classes.join(wanted, "digest").select(F.coalesce("least", F.lit(-(2**63))).alias("least")).distinct())
        # Ids go to all executors only up to a stated number (8 bytes each); beyond it the texts are shuffled.
        small = F.broadcast(sources) if sources.count() <= broadcast_ids else sources
        texts = docs.withColumn("least", F.coalesce("doc_id", F.lit(-(2**63)))).join(small, "least", "left_semi")
        shingles = texts.select("text").mapInArrow(_shingles, "digest binary, shingles binary, counts binary").dropDuplicates(["digest"])
        return cut(shingles.join(wanted, "digest", "left_semi"))

    def compared(pairs: DataFrame) -> DataFrame:
        """pairs(pivot, digest), distinct -> a, b, similarity."""
        pairs = cut(pairs)
        shingles = shingles_of(pairs.select("digest").union(pairs.select("pivot")).distinct())
        # Only pivots of many pairs are dealt into parts, so that no task gets all the rows of one; parts are smaller than
        # blocks, as a part costs one more row of the pivot only and several of them meet in a task by hash.
        part = max(block // 4, 1)
        heavy = cut(pairs.groupBy("pivot").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > part).select("pivot", F.ceil(F.col("n") / part).cast("int").alias("parts")))
        parted = pairs.join(F.broadcast(heavy) if heavy.count() <= broadcast_ids else heavy, "pivot", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
        heads = parted.select("pivot", "parts").distinct().select("pivot", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
        heads = heads.join(shingles, heads.pivot == shingles.digest).select("pivot", "part", F.lit(True).alias("is_pivot"), "digest", "shingles", "counts")
        members = parted.select("pivot", F.pmod(F.xxhash64("digest"), F.col("parts")).cast("int").alias("part"), "digest")
        members = members.join(shingles, "digest").select("pivot", "part", F.lit(False).alias("is_pivot"), "digest", "shingles", "counts")
        fields = pa.schema([("a", pa.binary()), ("b", pa.binary()), ("similarity", pa.float64())])
        return cut(per_group(heads.unionByName(members), ["pivot", "part"], _verify(threshold), "a binary, b binary, similarity double", fields))

    tested = compared(met.where("digest != pivot").select("pivot", "digest").distinct())
    joined = components(tested.where(F.col("similarity") >= threshold).select("a", "b"))
    floor = threshold - 3 * (threshold * (1 - threshold) / REGISTERS) ** 0.5
    placed = met.select("bucket", "digest").join(joined.withColumnRenamed("node", "digest"), "digest", "left").withColumn("component", F.coalesce("component", "digest"))
    # Buckets of several components, as rows of (bucket, class).
    several = placed.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low != high").select("bucket")
    apart = cut(placed.join(small(cut(several), broadcast_ids), "bucket"))
    if not apart.isEmpty():
        signs, key = classes.select("digest", "bands", "registers"), ["bucket", "left", "right"]
        dealt = across_parts(apart, ["bucket"], "component", F.col("digest"), block).join(signs, "digest")
        fields = pa.schema([("bucket", pa.int64()), ("digest", pa.binary()), ("component", pa.binary())])
        # Shingles go only to the buckets where a class has something to be compared with.
        left = cut(per_group(dealt, key, _open(floor), "bucket long, digest binary, component binary", fields).distinct())
        shingles = shingles_of(left.select("digest").distinct())
        dealt = across_parts(left, ["bucket"], "component", F.col("digest"), block).join(signs, "digest").join(shingles, "digest")
        fields = pa.schema([("a", pa.binary()), ("b", pa.binary())])
        linked = cut(per_group(dealt, key, _links(threshold, floor), "a binary, b binary", fields).distinct())
        # What is joined already stands for its edges.
        joined = components(joined.toDF("a", "b").union(linked))
    named = classes.select("digest", "place", "copies").join(joined.withColumnRenamed("node", "digest"), "digest", "left").withColumn("component", F.coalesce("component", "digest"))
    named = named.join(named.groupBy("component").agg(F.min("place").alias("first")), "component").select("digest", "first", "copies")
    out = sketched.select("doc_id", "text_crc", "digest").join(named, "digest")
    kept = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_crc") == F.col("first.text_crc"))
    return out.select("doc_id", "text_crc", F.col("first.doc_id").alias("class_id"), kept.alias("kept"), F.col("copies").alias("exact_copies"))
