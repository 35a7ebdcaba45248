"""Weighted edit distance of transliterated names, and best matches by it or by the plain one."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType

# Fixed values.
#: Letters that stand for each other at SUBSTITUTION.
ALIKE = set("YE EY UW WU DT TD AE AI AO AU EA EI EO EU IA IE IO IU OA OE OI OU UA UE UI UO SZ ZS BV VB OW WO YI IY RD DR CK KC CS SC GJ JG ZJ JZ XZ ZX XS SX XJ JS KQ QK WV VW PF FP KG GK".split())
#: Neighbours that trade places at the low price.
TRADING = set("EV EO CK KC KQ QK PF FP GJ JG BV VB VW WV BW WB JZ ZJ XZ ZX XS SX ZS SZ SC CS YU UY AU UA EU UE IU UI IO OI".split())
#: A letter and the two that it stands for at CONTRACTION.
CONTRACTED = {("O", "OW"), ("U", "UW"), ("U", "OO"), ("E", "IY"), ("I", "IY"), ("X", "KS"), ("E", "EE"), ("O", "OO"), ("S", "SC"), ("X", "XC"), ("I", "EE"), ("A", "YA"), ("L", "ZH")}
#: Letters that may be left out cheaply.
OMITTED = {"A": 0.2, "E": 0.2, "H": 0.2, "U": 0.3, "N": 0.45, " ": 0.01, "(": 0.01, ")": 0.01, "[": 0.01, "]": 0.01, ".": 0.01, "-": 0.01, "*": 0.01}
SWAP, SUBSTITUTION, TRADE, CONTRACTION, DOUBLED = 0.45, 0.45, 0.2, 0.2, 0.1
GIVE_UP = 100.0


def name_distance(one: str, two: str) -> float:
    """Cost of turning ``one`` into ``two``; not symmetric, as some pairs run one way only.

    Both get a space at the end. Costs spread from each cell, row by row and in place, to the cells that
    a step reaches; the last row and column are reached only.
    """
    one, two = one + " ", two + " "
    width, height = len(one), len(two)
    cost = [[float(r + c) for c in range(width + 1)] for r in range(height + 1)]
    for r in range(height):
        row, below = cost[r], cost[r + 1]
        second = cost[r + 2] if r + 2 <= height else None
        b, b2 = two[r], two[r : r + 2]
        for c in range(width):
            here = row[c]
            a, a2 = one[c], one[c : c + 2]
            steps = [
                (below, c, min(1.0, OMITTED.get(b, 1.0))),
                (row, c + 1, min(1.0, OMITTED.get(a, 1.0))),
                (below, c + 1, 0.0 if a == b else SUBSTITUTION if a + b in ALIKE else 1.0),
            ]
            if second is not None and r < height - 1:
                if (a, b2) in CONTRACTED:
                    steps.append((second, c + 1, CONTRACTION))
                if b2 == a + a:
                    steps.append((second, c + 1, DOUBLED))
            if c < width - 1:
                if (b, a2) in CONTRACTED:
                    steps.append((below, c + 2, CONTRACTION))
                if a2 == b + b:
                    steps.append((below, c + 2, DOUBLED))
                if second is not None and a2 == b2[::-1] and len(b2) == 2:
                    steps.append((second, c + 2, TRADE if a2 in TRADING else SWAP))
            for line, at, price in steps:
                if here + price < line[at]:
                    line[at] = here + price
        if min(row) >= GIVE_UP:
            return GIVE_UP
    return cost[height][width]


@pandas_udf(DoubleType())
def _distance(ones, twos):
    import pandas as pd

    known: dict[tuple[str, str], float] = {}
    out = []
    for pair in zip(ones, twos, strict=True):
        if pair[0] is None or pair[1] is None:
            out.append(None)
            continue
        if pair not in known:
            known[pair] = 0.0 if pair[0] == pair[1] else name_distance(*pair)
        out.append(known[pair])
    return pd.Series(out, dtype="float64")


def distance(register_name: Column, other: Column) -> Column:
    """Weighted distance; the register's name comes first. Null if either is."""
    return _distance(register_name, other)


def closest_of(hay: Column, needle: Column) -> Column:
    """struct(distance, index, name) of the array's member with the least plain edit distance; the first wins ties;
    null for an empty array."""
    scored = F.transform(hay, lambda h, i: F.struct(F.levenshtein(h, needle).alias("distance"), i.alias("index"), h.alias("name")))
    return F.array_min(scored)
