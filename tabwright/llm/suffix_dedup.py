"""Exact repeats of ``length`` bytes by distributed prefix doubling over thinned positions.

Plain prefix doubling sorts a (position, rank) pair for every byte in every round, some twenty bytes of shuffle
for each byte of text. Here the first round, over the cluster, ranks positions that are thinned so that no
repeat is lost, and the later rounds go on with what it leaves:

1. Of the ``GRAM``-byte strings in a window of ``length`` bytes, the one with the least name is its anchor.
   Equal windows have equal anchors, at the same offset. Neighbouring windows that share an anchor are a run,
   and the bytes under a run are its context. A position with its names (anchor, context) stands for a run:
   one for some 32 bytes of text.
2. Spark deals the (position, rank) pairs out by rank, the anchor's name, and sorts them. A rank that stands once is
   unique and done. Of the runs with equal contexts the first one stays and all windows of the others are repeats.
3. First runs whose anchor also has other contexts may share single windows with those. Their contexts are
   read again and dealt out by rank, and the windows' positions are ranked by doubling: bytes at 8 bytes, then pairs
   (rank, rank at the offset) at the offsets 8, 16, 32 .. and last ``length`` less the length reached. After each round
   a position whose rank is unique drops out with its pairs; at ``length`` all but the first of a rank are repeats. These
   ranks are exact: no fingerprint stands for bytes.

Within a batch of documents equal contexts (and windows) are settled before anything is sent, so a string that
many documents hold leaves a batch once. Windows of anchors with more than ``crowd`` contexts are dealt out by their own
digests. Anchors only bring together what may be equal; contexts are equal by anchor and a 64-bit keyed digest.

Windows are in order of (doc_id, start); null ids come first. A byte is removed if a repeat covers it.

Defined results: null and empty texts have no bytes; texts shorter than ``length`` keep all; rows with equal ids
and equal texts are one document (each gets what it keeps); rows with equal ids and other texts are
ordered by their crc32; empty tables give empty results. Only the columns named are read, so extra columns may clash freely.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.llm.common import scratch_dir
from tabwright.llm.words import mix

GRAM = 32
#: Bytes that are worked on at a time.
GROUP = 1 << 19
_LOW = np.uint64((1 << 32) - 1)
_SPANS = "doc_id long, tie long, low int, n int, ask boolean, crowd boolean, anchor long"
_SPAN_FIELDS = pa.schema([("doc_id", pa.int64()), ("tie", pa.int64()), ("low", pa.int32()), ("n", pa.int32()), ("ask", pa.bool_()), ("crowd", pa.bool_()), ("anchor", pa.int64())])
_PAIR = np.dtype([("anchor", "<u8"), ("name", "<u8"), ("doc_id", "<i8"), ("tie", "<u4"), ("low", "<u4"), ("n", "<u2"), ("settled", "u1")])


class Names:
    """Fingerprints of substrings of a byte array by wrapping prefix sums; ``salt`` picks the function."""

    _powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __init__(self, data: np.ndarray, salt: int):
        base = int(mix(np.array([2 * salt + 1], np.uint64))[0]) | 1
        n = len(data) + 1
        known = self._powers.get(salt)
        if known is None or len(known[0]) < n:
            size = max(n, 2 * GROUP)
            with np.errstate(over="ignore"):
                up = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size, base, np.uint64)]))
                down = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size, pow(base, -1, 1 << 64), np.uint64)]))
            known = (up, down)
            if size <= 1 << 23:
                self._powers[salt] = known
        self.down = known[1]
        letters = mix(np.arange(256, dtype=np.uint64) + np.uint64((salt + 1) << 32))
        self.sums = np.zeros(n, np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum(letters[data] * known[0][: n - 1], out=self.sums[1:])

    def every(self, size: int) -> np.ndarray:
        """Names of all substrings of ``size`` bytes."""
        with np.errstate(over="ignore"):
            return mix((self.sums[size:] - self.sums[:-size]) * self.down[: len(self.sums) - size])


def sliding_least(keys: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours, by doubling."""
    now, reach = keys, 1
    while reach * 2 <= width:
        now = np.minimum(now[:-reach], now[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(now[: len(now) - rest], now[rest:]) if rest else now


def runs(data: np.ndarray, bounds: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Runs of windows that share an anchor, of the texts that ``bounds`` cuts the data into:
    (text, first window's place in the data, windows, anchor's name, context's name)."""
    none = tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    if len(data) < length:
        return none
    names = Names(data, 0)
    gram = names.every(GRAM)
    keys = (gram & ~_LOW) | np.arange(len(gram), dtype=np.uint64)  # of equal beginnings the leftmost
    anchor = (sliding_least(keys, length - GRAM + 1) & _LOW).astype(np.int64)
    n = len(anchor)
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    inside = text[:n] == text[length - 1 : length - 1 + n]
    new = np.ones(n, bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (inside[1:] != inside[:-1]) | (text[1:n] != text[: n - 1])
    low = np.flatnonzero(new)
    size = np.diff(np.append(low, n))
    ok = inside[low]
    low, size = low[ok], size[ok]
    raw, ends = memoryview(data), low + size + (length - 1)
    digests = b"".join(hashlib.blake2b(raw[i:j], digest_size=8, key=b"context").digest() for i, j in zip(low.tolist(), ends.tolist(), strict=True))
    return text[low], low, size, gram[anchor[low]], np.frombuffer(digests, np.uint64)


def _grouped(ids: list, texts: list) -> Iterator[tuple[np.ndarray, np.ndarray, list[bytes]]]:
    """(ids, ties, bytes) of slices of about GROUP bytes. A null id counts as the least number."""
    held: list[bytes] = []
    own: list[int] = []
    size = 0
    for doc_id, text in zip(ids, texts, strict=True):
        raw = (text or "").encode("utf-8", "surrogatepass")
        held.append(raw)
        own.append(-(2**63) if doc_id is None else doc_id)
        size += len(raw)
        if size >= GROUP:
            yield np.array(own, np.int64), np.array([zlib.crc32(r) for r in held], np.int64), held
            held, own, size = [], [], 0
    if held:
        yield np.array(own, np.int64), np.array([zlib.crc32(r) for r in held], np.int64), held


def _pairs(length: int, buckets: int):
    """doc_id, text -> bucket, packed pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices = (whole.slice(at, 2000) for whole in batches for at in range(0, whole.num_rows, 2000))
        for batch in slices:  # a worker holds the pairs of one slice at a time
            parts = []
            for ids, ties, raw in _grouped(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                bounds = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
                text, low, size, anchor, context = runs(np.frombuffer(b"".join(raw), np.uint8), bounds, length)
                made = np.zeros(len(text), _PAIR)
                made["anchor"], made["name"], made["doc_id"], made["tie"] = anchor, context, ids[text], ties[text]
                made["low"], made["n"] = low - bounds[text], size
                parts.append(made)
            if not parts:
                continue
            pairs = np.concatenate(parts)
            if not len(pairs):
                continue
            pairs = pairs[np.lexsort((pairs["low"], pairs["tie"], pairs["doc_id"], pairs["name"], pairs["anchor"]))]
            again = np.zeros(len(pairs), bool)
            again[1:] = (pairs["anchor"][1:] == pairs["anchor"][:-1]) & (pairs["name"][1:] == pairs["name"][:-1])
            # Equal contexts of one place are one document's; else the batch's first one stands for all.
            same = np.zeros(len(pairs), bool)
            same[1:] = again[1:] & (pairs["doc_id"][1:] == pairs["doc_id"][:-1]) & (pairs["tie"][1:] == pairs["tie"][:-1]) & (pairs["low"][1:] == pairs["low"][:-1])
            pairs, again = pairs[~same], again[~same]
            pairs["settled"][again] = 1
            bucket = (pairs["anchor"] % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            pairs, bucket = pairs[order], bucket[order]
            at = np.flatnonzero(np.diff(bucket, prepend=-1))
            ends = np.append(at[1:], len(bucket))
            # Columns one after the other, so that the shuffle's compression sees like with like.
            blobs = [b"".join(pairs[name][a:b].tobytes() for name in _PAIR.names) for a, b in zip(at, ends, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(bucket[at], pa.int32()), pa.array((ends - at).astype(np.int32), pa.int32()), pa.array(blobs, pa.binary())], names=["bucket", "rows", "pairs"])

    return run


def _unpacked(rows: list[int], blobs: list[bytes]) -> np.ndarray:
    out = np.zeros(sum(rows), _PAIR)
    at = 0
    for n, blob in zip(rows, blobs, strict=True):
        place = 0
        for name in _PAIR.names:
            kind = _PAIR[name]
            out[name][at : at + n] = np.frombuffer(blob, kind, n, place)
            place += n * kind.itemsize
        at += n
    return out


def _rank_bucket(pairs: np.ndarray, crowd: int) -> dict[str, np.ndarray]:
    """Spans of windows that are repeats (ask false), and of those to be looked at one by one (ask true)."""
    pairs = pairs[np.lexsort((pairs["low"], pairs["tie"], pairs["doc_id"], pairs["name"], pairs["anchor"]))]
    n = len(pairs)
    anchor = np.ones(n, bool)
    anchor[1:] = pairs["anchor"][1:] != pairs["anchor"][:-1]
    context = anchor.copy()
    context[1:] |= pairs["name"][1:] != pairs["name"][:-1]
    one = context.copy()
    for name in ("doc_id", "tie", "low"):
        one[1:] |= pairs[name][1:] != pairs[name][:-1]
    pairs, anchor, context = pairs[one], anchor[one], context[one]
    group = np.cumsum(anchor) - 1
    contexts = np.bincount(group, context, len(pairs))[group]
    settled = pairs["settled"].astype(bool) | ~context
    ask = ~settled & (contexts > 1)
    keep = settled | ask
    pairs, ask, contexts = pairs[keep], ask[keep], contexts[keep]
    return {"doc_id": pairs["doc_id"], "tie": pairs["tie"].astype(np.int64), "low": pairs["low"].astype(np.int32), "n": pairs["n"].astype(np.int32), "ask": ask, "crowd": ask & (contexts > crowd), "anchor": np.where(ask, pairs["anchor"].view(np.int64), 0)}


def _ranked(crowd: int):
    """Sorted rows of buckets -> spans, bucket by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: int | None = None
        rows: list[int] = []
        blobs: list[bytes] = []

        def done() -> Iterator[pa.RecordBatch]:
            if rows:
                made = _rank_bucket(_unpacked(rows, blobs), crowd)
                yield from pa.table({k: pa.array(v) for k, v in made.items()}).cast(_SPAN_FIELDS).to_batches(max_chunksize=100_000)

        for batch in batches:
            for bucket, n, blob in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if bucket != now:
                    yield from done()
                    now, rows, blobs = bucket, [], []
                rows.append(n)
                blobs.append(blob)
        yield from done()

    return run


def first_windows(data: bytes, sizes: np.ndarray, order: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of several contexts, laid end to end -> (context, window in it, is a repeat of one before it).

    ``order`` ranks the contexts' places; a window's place is (order, window), and contexts don't overlap in place.
    """
    array = np.frombuffer(data, np.uint8)
    starts = np.cumsum(sizes) - sizes
    counts = sizes - (length - 1)
    owner = np.repeat(np.arange(len(sizes)), counts)
    window = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    left = rank_by_doubling(array, starts[owner] + window, length)
    again = np.zeros(len(owner), bool)
    at, rank = left
    by_place = np.lexsort((window[at], order[owner[at]], rank))
    same = rank[by_place[1:]] == rank[by_place[:-1]]
    again[at[by_place[1:][same]]] = True
    return owner, window, again


def _ranks(keys: np.ndarray) -> np.ndarray:
    """Numbers of the keys in order, equal for equal keys."""
    order = np.argsort(keys)
    listed = keys[order]
    out = np.zeros(len(keys), np.int64)
    out[order[1:]] = np.cumsum(listed[1:] != listed[:-1])
    return out


def _surviving(rank: np.ndarray) -> np.ndarray:
    """Whether another position has the same rank."""
    return (np.bincount(rank) > 1)[rank] if len(rank) else np.zeros(0, bool)


def rank_by_doubling(data: np.ndarray, windows: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows of ``length`` bytes that start at ``windows`` -> those that aren't unique (by number), and their ranks.

    A round pairs each position's rank with the rank one offset on and ranks the pairs. Positions are needed
    while a surviving window still reaches over them.
    """
    alive = np.arange(len(windows))
    padded = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    keys = np.zeros(len(data), np.uint64)
    for k in range(8):
        keys = (keys << np.uint64(8)) | padded[k : k + len(data)]
    rank, reach = _ranks(keys), 8  # of every position
    alive = alive[_surviving(rank[windows])]
    while len(alive) and reach < length:
        step = min(reach, length - reach)
        # The positions over which the next rounds still pair: all that a surviving window covers.
        start = windows[alive]
        ends = start + (length - reach - step) + 1
        cover = np.cumsum(np.bincount(start, minlength=len(data) + 1) - np.bincount(ends, minlength=len(data) + 1))
        at = np.flatnonzero(cover > 0)
        pair = rank[at] * np.int64(int(rank.max()) + 1) + rank[at + step]
        now = np.full(len(data), -1, np.int64)
        now[at] = _ranks(pair)
        rank, reach = now, reach + step
        alive = alive[_surviving(rank[windows[alive]])]
    return alive, rank[windows[alive]]


def _span_list(doc_id: np.ndarray, tie: np.ndarray, low: np.ndarray, owner: np.ndarray, window: np.ndarray, again: np.ndarray) -> dict[str, np.ndarray]:
    """Repeats among windows as spans of neighbours."""
    at = np.flatnonzero(again)
    own, place = owner[at], window[at]
    new = np.ones(len(at), bool)
    new[1:] = (own[1:] != own[:-1]) | (place[1:] != place[:-1] + 1)
    first = np.flatnonzero(new)
    n = np.diff(np.append(first, len(at)))
    own = own[first]
    return {"doc_id": doc_id[own], "tie": tie[own], "low": (low[own] + place[first]).astype(np.int32), "n": n.astype(np.int32)}


_CONTEXT = "anchor long, doc_id long, tie long, low int, bytes binary, found boolean, n int"
_CONTEXT_FIELDS = pa.schema([("anchor", pa.int64()), ("doc_id", pa.int64()), ("tie", pa.int64()), ("low", pa.int32()), ("bytes", pa.binary()), ("found", pa.bool_()), ("n", pa.int32())])


def _contexts(length: int):
    """doc_id, tie, text, asked spans -> contexts to be compared (found false) and repeats settled here (found true)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for piece in range(0, whole.num_rows, 1000):
                batch = whole.slice(piece, 1000)
                cuts, doc_ids, ties, lows, anchors, crowds = [], [], [], [], [], []
                for doc_id, tie, text, spans in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                    raw = (text or "").encode("utf-8", "surrogatepass")
                    for s in spans:
                        cuts.append(raw[s["low"] : s["low"] + s["n"] - 1 + length])
                        doc_ids.append(doc_id)
                        ties.append(tie)
                        lows.append(s["low"])
                        anchors.append(s["anchor"])
                        crowds.append(s["crowd"])
                if not cuts:
                    continue
                doc_id, tie, low = np.array(doc_ids, np.int64), np.array(ties, np.int64), np.array(lows, np.int64)
                order = np.empty(len(cuts), np.int64)
                by_place = np.lexsort((low, tie, doc_id))
                # Rows of one document and place are one place.
                step = np.ones(len(cuts), np.int64)
                same = (doc_id[by_place[1:]] == doc_id[by_place[:-1]]) & (tie[by_place[1:]] == tie[by_place[:-1]]) & (low[by_place[1:]] == low[by_place[:-1]])
                step[1:] = ~same
                order[by_place] = np.cumsum(step)
                single = np.zeros(len(cuts), bool)
                single[by_place[1:]] = same
                kept = np.flatnonzero(~single)
                sizes = np.array([len(cuts[k]) for k in kept], np.int64)
                owner, window, again = first_windows(b"".join(cuts[k] for k in kept), sizes, order[kept], length)
                spans = _span_list(doc_id[kept], tie[kept], low[kept], owner, window, again)
                m = len(spans["low"])
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(m, pa.int64()), pa.array(spans["doc_id"]), pa.array(spans["tie"]), pa.array(spans["low"]), pa.nulls(m, pa.binary()), pa.array(np.ones(m, bool)), pa.array(spans["n"])],
                    schema=_CONTEXT_FIELDS,
                )
                # A context goes on unless all its windows are settled; in a crowd its open windows go on alone.
                open_windows = np.bincount(owner, ~again, len(kept))
                crowd = np.array(crowds, bool)[kept]
                out: dict[str, list] = {"anchor": [], "doc_id": [], "tie": [], "low": [], "bytes": []}

                def send(anchor, k, low_at, raw, out=out, doc_ids=doc_ids, ties=ties):
                    for name, value in zip(out, (anchor, doc_ids[k], ties[k], low_at, raw), strict=True):
                        out[name].append(value)

                for i in np.flatnonzero((open_windows > 0) & ~crowd).tolist():
                    k = int(kept[i])
                    send(anchors[k], k, lows[k], cuts[k])
                for j in np.flatnonzero(~again & crowd[owner]).tolist():
                    k, w = int(kept[owner[j]]), int(window[j])
                    raw = cuts[k][w : w + length]
                    send(int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "little", signed=True), k, lows[k] + w, raw)
                m = len(out["low"])
                columns = [pa.array(out[f.name], f.type) for f in list(_CONTEXT_FIELDS)[:5]]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(np.zeros(m, bool)), pa.nulls(m, pa.int32())], schema=_CONTEXT_FIELDS)

    return run


_REPEATS = "doc_id long, tie long, low int, n int"


def _compared(length: int):
    """Sorted contexts, dealt by anchor -> spans of repeated windows. Whole anchors are compared at a time."""

    def settle(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held)
        if table.num_rows < 2:
            return
        doc_id, tie, low = (table.column(c).to_numpy().astype(np.int64) for c in ("doc_id", "tie", "low"))
        raw = table.column("bytes").to_pylist()
        order = np.empty(len(raw), np.int64)
        order[np.lexsort((low, tie, doc_id))] = np.arange(len(raw))
        owner, window, again = first_windows(b"".join(raw), np.array([len(r) for r in raw], np.int64), order, length)
        spans = _span_list(doc_id, tie, low, owner, window, again)
        if len(spans["low"]):
            yield pa.RecordBatch.from_pydict({k: pa.array(v) for k, v in spans.items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for whole in batches:
            for piece in range(0, whole.num_rows, 4000):
                batch = whole.slice(piece, 4000)
                anchors = batch.column("anchor").to_numpy()
                cut = int(np.searchsorted(anchors, anchors[-1], "left"))  # the last anchor may go on
                if cut or (held and held[-1].column("anchor")[-1].as_py() != anchors[0]):
                    if cut:
                        held.append(batch.slice(0, cut))
                    yield from settle(held)
                    held = []
                held.append(batch.slice(cut))
        if held:
            yield from settle(held)

    return run


_RESULT = "doc_id long, n_bytes long, removed array<struct<start:long,end:long>>, kept binary"


def _without(length: int):
    """doc_id, text, repeated spans -> what is removed and what is kept."""
    fields = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("removed", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for piece in range(0, whole.num_rows, 1000):
                batch = whole.slice(piece, 1000)
                sizes, removed, kept = [], [], []
                for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
                    raw = (text or "").encode("utf-8", "surrogatepass")
                    sizes.append(len(raw))
                    cuts: list[dict[str, int]] = []
                    for low, n in sorted((s["low"], s["n"]) for s in spans or ()):
                        if cuts and low <= cuts[-1]["end"]:
                            cuts[-1]["end"] = max(cuts[-1]["end"], low + n - 1 + length)
                        else:
                            cuts.append({"start": low, "end": low + n - 1 + length})
                    removed.append(cuts)
                    at, parts = 0, []
                    for c in cuts:
                        parts.append(raw[at : c["start"]])
                        at = c["end"]
                    kept.append(b"".join([*parts, raw[at:]]))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(removed, fields.field("removed").type), pa.array(kept, pa.binary())], schema=fields)

    return run


def remove_repeats(documents: DataFrame, length: int = 100, bucket_bytes: int = 8 << 20, crowd: int = 512) -> DataFrame:
    """documents(doc_id, text) -> doc_id, n_bytes, removed (maximal runs of removed bytes), kept (the other bytes)."""
    if length < GRAM + 8:
        raise ValueError(f"repeats have {GRAM + 8} bytes at least")
    spark = documents.sparkSession
    docs = documents.select(F.col("doc_id").cast("long"), "text")
    total = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    # A pair stands for about (length - GRAM + 2) / 2 bytes of text.
    buckets = max(24, -(-total * 2 * _PAIR.itemsize // (length - GRAM + 2) // bucket_bytes))
    pairs = docs.mapInArrow(_pairs(length, buckets), "bucket int, rows int, pairs binary")
    spans = pairs.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(_ranked(crowd), _SPANS)
    folder = f"{scratch_dir(spark, 'repeats')}/spans"
    spans.write.option("compression", "zstd").parquet(folder)
    spans = spark.read.schema(_SPANS).parquet(folder)

    keyed = docs.select(F.coalesce("doc_id", F.lit(-(2**63))).alias("key"), F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("tie"), "doc_id", "text")
    asked = spans.where("ask").groupBy("doc_id", "tie").agg(F.collect_list(F.struct("low", "n", "crowd", "anchor")).alias("spans"))
    asked = asked.withColumnRenamed("doc_id", "key")
    contexts = keyed.join(asked, ["key", "tie"]).select("key", "tie", "text", "spans").mapInArrow(_contexts(length), _CONTEXT)
    folder = f"{scratch_dir(spark, 'repeats')}/contexts"
    contexts.write.partitionBy("found").option("compression", "zstd").parquet(folder)
    contexts = spark.read.schema(_CONTEXT).parquet(folder)
    shared = contexts.where("not found").select("anchor", "doc_id", "tie", "low", "bytes")
    late = shared.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(_compared(length), _REPEATS)
    early = contexts.where("found").select("doc_id", "tie", "low", "n")
    repeats = spans.where("not ask").select("doc_id", "tie", "low", "n").unionByName(early).unionByName(late)
    listed = repeats.distinct().groupBy("doc_id", "tie").agg(F.collect_list(F.struct("low", "n")).alias("spans")).withColumnRenamed("doc_id", "key")
    return keyed.join(listed, ["key", "tie"], "left").select("doc_id", "text", "spans").mapInArrow(_without(length), _RESULT)
