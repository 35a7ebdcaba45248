"""Sharding by a consistent-hash ring with virtual nodes and bounded loads (DataFrame functions only).

The ring has ``slots`` equal arcs; every shard owns the arcs from its virtual nodes up to the next virtual
node clockwise. Rows hash to an arc and are ordered on it by hash. A shard has a fixed capacity in rows;
rows that overflow a full shard go on clockwise to the next one that has room. The walk is decided on the
arcs' row counts alone (``slots`` numbers, a parameter, whatever the input's size): an arc is cut into runs
of ranks, and each run has its shard and its first slot number there. Rows then look up their run by rank.

With capacities of floor(n/k) or ceil(n/k) rows the law is ``rows``: counts at most one apart.

Defined results: a null text has size 1 and the crc32 of no bytes; rows are placed by id and text together, so that
neither many rows of one id (or none) nor many of one text meet on an arc; rows alike in both are interchangeable;
empty tables give empty results. Only the columns named are read, so extra columns may clash freely.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def ring_owners(shards: int, vnodes: int, slots: int) -> list[list[int]]:
    """For every arc: all shards in the order in which they come clockwise."""
    placed: dict[int, tuple[int, int]] = {}
    for shard in range(shards):
        for replica in range(vnodes):
            digest = hashlib.sha256(f"shard {shard} replica {replica}".encode()).digest()
            at = int.from_bytes(digest[:8], "big") % slots
            rank = int.from_bytes(digest[8:16], "big")
            if at not in placed or (rank, shard) < placed[at]:
                placed[at] = (rank, shard)
    points = [placed[at][1] for at in sorted(placed)]
    starts = sorted(placed)
    after = []  # the clockwise order of shards from each virtual node on
    for i in range(len(points)):
        seen = list(dict.fromkeys(points[i:] + points[:i]))
        after.append(seen + [s for s in range(shards) if s not in seen])
    owners, i = [], 0
    for arc in range(slots):
        while i < len(starts) and starts[i] < arc:
            i += 1
        owners.append(after[i % len(starts)])
    return owners


def bounded_runs(counts: dict[int, int], capacity: list[int], owners: list[list[int]]) -> list[tuple[int, int, int, int, int, bool]]:
    """Runs (arc, first rank, end rank, shard, first slot in the shard, moved) of the bounded-load walk.

    Every round offers each waiting run to the next shard clockwise; shards take runs in ring order until full.
    """
    room, filled = list(capacity), [0] * len(capacity)
    waiting = [(arc, 0, n, 0) for arc, n in sorted(counts.items()) if n]
    runs = []
    while waiting:
        left = []
        for arc, low, high, step in waiting:
            shard = owners[arc][step]
            take = min(room[shard], high - low)
            if take:
                runs.append((arc, low, low + take, shard, filled[shard], step > 0))
                room[shard] -= take
                filled[shard] += take
            if low + take < high:
                left.append((arc, low + take, high, step + 1))
        waiting = left
    return runs


def shard_rows(documents: DataFrame, shards: int = 8, vnodes: int = 64, slots: int = 4096) -> DataFrame:
    """documents(doc_id, text) -> doc_id, size, text_crc32, law, shard, slot, grown_shard, home_shard.

    ``home_shard`` is the ring's own choice, before any overflow.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    placed = F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("?")), F.crc32(text.cast("binary")))
    arc = F.shiftrightunsigned(placed, 44).cast("long") % slots
    counts = {int(r["arc"]): int(r["n"]) for r in documents.select(arc.alias("arc")).groupBy("arc").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(counts.values())
    capacity = [total // shards + (s < total % shards) for s in range(shards)]
    owners = ring_owners(shards, vnodes, slots)
    runs = bounded_runs(counts, capacity, owners)
    fields = "arc long, low long, high long, shard int, base long, home int"
    rows = json.dumps([dict(zip(("arc", "low", "high", "shard", "base", "home"), (a, lo, hi, s, base, owners[a][0]), strict=True)) for a, lo, hi, s, base, _ in runs])
    spark = documents.sparkSession
    # At most ``slots`` runs and one more for each time that a shard fills up: a few hundred KB, whatever the input.
    table = spark.range(1).select(F.inline(F.from_json(F.lit(rows), f"array<struct<{fields.replace(' ', ':').replace(',:', ',')}>>")))
    base = documents.select(
        F.col("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        placed.alias("placed"),
        arc.alias("arc"),
    )
    order = Window.partitionBy("arc").orderBy("placed", "doc_id", "size", "text_crc32")
    ranked = base.withColumn("rank", F.row_number().over(order) - 1)
    found = ranked.join(F.broadcast(table.withColumnRenamed("arc", "run_arc")), (F.col("arc") == F.col("run_arc")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")))
    return found.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
        (F.col("base") + F.col("rank") - F.col("low")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), F.col("home").alias("home_shard"),
    )
