"""Arrow processing of many small key groups in sorted partitions, and the dealing of large groups into blocks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.llm.common import cut


def in_blocks(rows: DataFrame, key: list[str], member: Column, block: int) -> DataFrame:
    """Rows of groups (by ``key``) of two and more -> the same with ``left`` and ``right`` block numbers.

    A group of n rows has ceil(n / block) blocks, and every row is in each pair of blocks that holds its own, so
    that any two rows of a group meet in a pair of blocks, and no pair of blocks holds many more than 2 x block
    rows. Groups of up to ``block`` rows have the one pair (0, 0). ``member`` deals rows to blocks.
    """
    counts = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("group_rows")).where("group_rows > 1")
    kept = rows.join(counts, key)
    blocks = F.ceil(F.col("group_rows") / block).cast("int")
    own = F.pmod(F.xxhash64(member), blocks).cast("int")
    dealt = kept.withColumn("own_block", own).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    return dealt.select("*", F.least("own_block", "other").alias("left"), F.greatest("own_block", "other").alias("right")).drop("other", "group_rows")


def small(rows: DataFrame, most: int = 500_000) -> DataFrame:
    """Materialised rows, marked for a broadcast if there are at most ``most`` (of some ten bytes each)."""
    return F.broadcast(rows) if rows.count() <= most else rows


def across_parts(rows: DataFrame, key: list[str], part: str, member: Column, block: int) -> DataFrame:
    """As ``in_blocks``, for groups whose rows are compared with those of other ``part``s alone: rows of a group's largest
    part don't meet each other, so that a group that is nearly one part isn't dealt out in all its pairs of blocks."""
    sizes = rows.groupBy(*key, part).agg(F.count(F.lit(1)).alias("n"))
    groups = sizes.groupBy(*key).agg(F.max(F.struct("n", part)).alias("main"), F.sum("n").alias("all_rows"), F.count(F.lit(1)).alias("parts")).where("parts > 1")
    met = rows.join(small(cut(groups)), key)  # a large group's rows stay where they are
    is_main = F.col(part) == F.col(f"main.{part}")
    mains, others = (F.ceil(n / block).cast("int") for n in (F.col("main.n"), F.col("all_rows") - F.col("main.n")))
    own = F.when(is_main, others + F.pmod(F.xxhash64(member), mains)).otherwise(F.pmod(F.xxhash64(member), others)).cast("int")
    last = F.when(is_main, others).otherwise(others + mains) - 1
    dealt = met.withColumn("own_block", own).withColumn("other", F.explode(F.sequence(F.lit(0), last)))
    return dealt.select("*", F.least("own_block", "other").alias("left"), F.greatest("own_block", "other").alias("right")).drop("other", "main", "all_rows", "parts")


def per_group(rows: DataFrame, key: list[str], work: Callable[[pa.Table], dict[str, list] | None], schema: str, arrow: pa.Schema) -> DataFrame:
    """Deal rows out by key, sort, and call ``work`` on each key's rows; groups may run over Arrow batches.

    ``work`` gets the rows of a key as a table and returns columns of output rows, or None.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def groups(table: pa.Table, closed: bool):
            """Whole groups of the table; the last one only if nothing can follow."""
            n = table.num_rows
            change = None
            for name in key:
                column = table.column(name).combine_chunks()
                differs = pc.fill_null(pc.not_equal(column.slice(1), column.slice(0, n - 1)), True)
                change = differs if change is None else pc.or_(change, differs)
            ends = [i + 1 for i in pc.indices_nonzero(change).to_pylist()] if n > 1 else []
            starts = [0, *ends]
            stops = [*ends, n]
            last = len(starts) if closed else len(starts) - 1
            return [(starts[i], stops[i]) for i in range(last)], starts[-1]

        def emit(table: pa.Table, spans: list[tuple[int, int]]) -> Iterator[pa.RecordBatch]:
            out: dict[str, list] = {name: [] for name in arrow.names}
            for low, high in spans:
                made = work(table.slice(low, high - low))
                if made:
                    for name in arrow.names:
                        out[name].extend(made[name])
            if out[arrow.names[0]]:
                yield from pa.table(out, schema=arrow).to_batches()

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            table = pa.Table.from_batches(held).combine_chunks()
            spans, rest = groups(table, False)
            yield from emit(table, spans)
            held = table.slice(rest).to_batches()
        if held:
            table = pa.Table.from_batches(held).combine_chunks()
            yield from emit(table, groups(table, True)[0])

    return rows.repartition(*key).sortWithinPartitions(*key).mapInArrow(run, schema)
