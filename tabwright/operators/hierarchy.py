"""Closures, hierarchical undo, levels, and packing of a small catalog."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.session import shared_dir


def paths(levels: Sequence[tuple[DataFrame, str, str | None]]) -> DataFrame:
    """levels from the top: (table, code, parent's code or None) -> code, level, path (codes from the top)."""
    out: DataFrame | None = None
    above: DataFrame | None = None
    for depth, (rows, code, parent) in enumerate(levels):
        if above is None or parent is None:
            own = rows.select(F.col(code).cast("string").alias("code"), F.lit(depth).alias("level"), F.array(F.col(code).cast("string")).alias("path"))
        else:
            up = above.select(F.col("code").alias("__up"), F.col("path").alias("__path"))
            own = rows.join(up, F.col(parent).cast("string") == F.col("__up")).select(F.col(code).cast("string").alias("code"), F.lit(depth).alias("level"), F.concat("__path", F.array(F.col(code).cast("string"))).alias("path"))
        out = own if out is None else out.unionByName(own)
        above = own
    return out


def closure(edges: DataFrame, roots: DataFrame, most_rounds: int = 64) -> DataFrame:
    """edges(src, dst), roots(node): node and depth of everything from which a root is reached, the roots too. Cycles end.

    Each round's new nodes alone are cut with a checkpoint, so plans stay small however deep the graph is.
    """
    shared_dir(edges.sparkSession)
    layers = [roots.select("node").distinct().withColumn("depth", F.lit(0)).checkpoint()]
    for depth in range(1, most_rounds):
        nearer = edges.join(layers[-1].select(F.col("node").alias("dst")), "dst").select(F.col("src").alias("node")).distinct()
        found = reduce(DataFrame.unionByName, layers)
        fresh = nearer.join(found, "node", "left_anti").withColumn("depth", F.lit(depth)).checkpoint()
        if fresh.isEmpty():
            return found
        layers.append(fresh)
    raise RuntimeError("the closure is deeper than most_rounds")


def deepest_level(levels: Sequence[str]) -> Column:
    """Name of the last level, from the top, whose column isn't empty."""
    found: Column = F.lit(None).cast("string")
    for level in levels:
        found = F.when(F.coalesce(F.col(level).cast("string"), F.lit("")) != "", F.lit(level)).otherwise(found)
    return found


def undo(rows: DataFrame, undone: Mapping[str, DataFrame], leaf_code: str, levels: Sequence[str]) -> DataFrame:
    """Rows that survive an undo: a leaf code of NA never does; a leaf that has a code does; any other row does unless the
    id of its deepest level is in that level's undo table(id). Rows without any level go."""
    met = rows.withColumn("__level", deepest_level(levels)).withColumn("__undone", F.lit(False))
    for level, ids in undone.items():
        mark = ids.select(F.col("id").alias(level)).distinct().withColumn("__hit", F.lit(True))
        met = met.join(mark, level, "left").withColumn("__undone", F.col("__undone") | ((F.col("__level") == level) & F.coalesce("__hit", F.lit(False)))).drop("__hit")
    code = F.coalesce(F.col(leaf_code), F.lit(""))
    keep = F.when(code == "NA", False).when(code != "", True).when(F.col("__level").isNull(), False).otherwise(~F.col("__undone"))
    return met.where(keep).select(*rows.columns)


def done_ids(rows: DataFrame, levels: Mapping[str, str]) -> DataFrame:
    """Ledger of finished ids: level and id of each row's deepest level."""
    level = deepest_level(list(levels))
    ident: Column = F.lit(None).cast("string")
    for name, column in levels.items():
        ident = F.when(level == name, F.col(column).cast("string")).otherwise(ident)
    return rows.select(level.alias("level"), ident.alias("id")).where("level is not null").distinct()


def pack(names: Sequence[str], used: Mapping[str, int], capacity: Mapping[str, int], spare: int, prefix: str) -> tuple[dict[str, str], dict[str, int]]:
    """First fit of names into bins of a catalog, a driver-side table: (name -> bin, bin -> count). Full bins make a new
    one, prefix-extraN, of ``spare`` places."""
    counts, room, placed = dict(used), dict(capacity), {}
    for name in names:
        target = next((b for b in room if counts.get(b, 0) < room[b]), None)
        if target is None:
            target = f"{prefix}-extra{sum(b.startswith(prefix + '-extra') for b in room) + 1}"
            room[target] = spare
        placed[name] = target
        counts[target] = counts.get(target, 0) + 1
    return placed, counts


def rebalance(bins: Mapping[str, Sequence[str]], capacity: Mapping[str, int]) -> list[tuple[str, str, str]]:
    """Moves (name, from, to) that fill earlier bins' free places from the last bins backwards."""
    order, held, moves = list(bins), {b: list(n) for b, n in bins.items()}, []
    low, high = 0, len(order) - 1
    while low < high:
        if len(held[order[low]]) >= capacity[order[low]]:
            low += 1
        elif not held[order[high]]:
            high -= 1
        else:
            name = held[order[high]].pop()
            held[order[low]].append(name)
            moves.append((name, order[high], order[low]))
    return moves
