"""Quality by Bradley-Terry pairwise ranking.

A text's features are counts that don't depend on its language: marks, capitals, repeats, lengths. Preference
pairs set each labelled good text against each labelled bad one; the logistic loss on the difference of their
features teaches a linear worth. The threshold is the quantile of the worth at the share of bad texts among
what was learned from, and the published score is a logistic curve that takes the value ``cut`` there.

All labelled ids teach, an id by one text (the one with the least crc32), and so do all pairs of a good and a bad one.
Their features stay in the cluster. A pair's chance depends on the two worths alone, so for each step of the fit the texts
are summed by kind in cells of 1 / ``CELLS`` of worth, and pairs of cells stand for pairs of texts at the cells' mean
worths, which is off by some 1e-6 of the loss. Threshold and slope are exact quantiles of all worths. The model scores
whole texts of every document.

Defined results: null and empty texts have zero features and score as such; null labels teach nothing, of an id's conflicting labels the higher counts;
without examples of both kinds every score is 0.5. Repeated rows score alike. Only the columns named are read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.llm.common import cut as materialised
from tabwright.llm.common import labelled_texts

#: Cells of worth for each unit of it; of more than ``MOST_CELLS`` of a kind neighbours are put together.
CELLS = 64
MOST_CELLS = 2048
#: Labelled texts that one task sums in a step of the fit, 14 MB of features.
TASK_ROWS = 50_000

CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MARKS = "!?.,;:|#$%&*@=+()\"'<>_/-"
FEATURES = ("length", "words", "word_length", "distinct_words", "repeated_next", "distinct_lines", "upper", "digits", "upper_words", "top_word", *MARKS)


def features(text: str) -> list[float]:
    """The features of one text; each is a rate or a logarithm, so that long texts don't outweigh short ones."""
    if not text:
        return [0.0] * len(FEATURES)
    n = len(text)
    words = text.split()
    k = len(words) or 1
    distinct = set(words)
    lines = text.split("\n")
    repeated = sum(map(str.__eq__, words, words[1:])) / k
    upper = sum(map(str.isupper, words))
    raw = text.encode("utf-8", "surrogatepass")
    capitals = len(raw) - len(raw.translate(None, CAPITALS))
    top = max(Counter(words).values()) / k if k > 8 else 0.0
    out = [math.log1p(n), math.log1p(k), n / k / 10, math.log(len(distinct) + 1) / math.log(k + 2), repeated, len(set(lines)) / len(lines), capitals / n * 2, sum(map(text.count, "0123456789")) / n * 4, upper / k, top]
    # The square root lets a few marks in a long text count.
    return out + [math.sqrt(text.count(m) / k) for m in MARKS]


@dataclass
class Model:
    centre: np.ndarray = field(default_factory=lambda: np.zeros(len(FEATURES)))
    scale: np.ndarray = field(default_factory=lambda: np.ones(len(FEATURES)))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(len(FEATURES)))
    threshold: float = 0.0
    slope: float = 1.0
    cut: float = 0.5

    def scores(self, rows: np.ndarray) -> np.ndarray:
        worth = ((rows - self.centre) / self.scale) @ self.weights
        z = (worth - self.threshold) * self.slope + math.log(self.cut / (1 - self.cut))
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [features(t or "") for t in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64())), batch.column(1)], names=["x", "quality"])


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(FEATURES))


def _moments(rows: DataFrame) -> tuple[int, int, np.ndarray, np.ndarray]:
    """x, quality -> numbers of bad and good texts, mean and deviation of each feature; these as 32-bit numbers, as the order
    of rows decides on the last digits of a sum."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, good, total, squares = 0, 0, np.zeros(len(FEATURES)), np.zeros(len(FEATURES))
        for batch in batches:
            x = _matrix(batch)
            n, good, total, squares = n + len(x), good + int(np.sum(batch.column(1).to_numpy(zero_copy_only=False))), total + x.sum(0), squares + (x * x).sum(0)
        yield pa.RecordBatch.from_pydict({"n": [n], "good": [good], "total": [total], "squares": [squares]})

    parts = rows.mapInArrow(run, "n long, good long, total array<double>, squares array<double>").collect()  # one of each task
    n, good = sum(p["n"] for p in parts), sum(p["good"] for p in parts)
    mean, square = (np.array([math.fsum(c) for c in zip(*(p[k] for p in parts), strict=True)]) / max(n, 1) for k in ("total", "squares"))
    narrow = lambda a: a.astype(np.float32).astype(np.float64)
    return n - good, good, narrow(mean), narrow(np.maximum(np.sqrt(np.maximum(square - mean * mean, 0)), 1e-6))


def _cells(rows: DataFrame, centre: np.ndarray, scale: np.ndarray, weights: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """x, quality -> for bad and for good texts the number and the summed features of each cell of worth, in order."""
    names = [f"z{i}" for i in range(len(FEATURES))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # In whole parts of 2**-20, so that sums don't depend on the order of rows.
            z = np.round(np.clip((_matrix(batch) - centre) / scale, -20, 20) * 2**20) / 2**20
            key = np.floor((z * weights).sum(1) * CELLS).astype(np.int64) * 2 + batch.column(1).to_numpy(zero_copy_only=False)
            order = np.argsort(key, kind="stable")
            keys, starts, n = np.unique(key[order], return_index=True, return_counts=True)
            sums = np.add.reduceat(z[order], starts) if len(keys) else z
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n, pa.int64()), *(pa.array(np.ascontiguousarray(c)) for c in sums.T)], names=["key", "n", *names])

    summed = rows.mapInArrow(run, "key long, n long, " + ", ".join(f"{c} double" for c in names)).groupBy("key").agg(*(F.sum(c).alias(c) for c in ["n", *names]))
    got = np.array([tuple(r) for r in summed.collect()], np.float64).reshape(-1, len(names) + 2)
    got = got[np.argsort(got[:, 0])]
    out = []
    for kind in (0, 1):
        own = got[got[:, 0] % 2 == kind][:, 1:]
        own = np.add.reduceat(own, np.arange(0, len(own), -(-len(own) // MOST_CELLS)))
        out.append((own[:, 0], own[:, 1:]))
    return out


def pair_loss(cells: list[tuple[np.ndarray, np.ndarray]], weights: np.ndarray, ridge: float = 1e-4) -> tuple[float, np.ndarray]:
    """Mean logistic loss of all pairs of a good and a bad text, given in cells, and its gradient."""
    (bad, bad_sums), (good, good_sums) = cells
    # Bradley-Terry: the better one wins with probability 1 / (1 + exp(-(worth difference))).
    gap = ((good_sums @ weights) / good)[:, None] - ((bad_sums @ weights) / bad)[None, :]
    lost = 1 / (1 + np.exp(np.clip(gap, -50, 50)))
    pairs = good.sum() * bad.sum()
    grad = ((good @ lost) @ bad_sums - (lost @ bad) @ good_sums) / pairs
    return float(good @ np.logaddexp(0, -gap) @ bad / pairs + ridge / 2 * weights @ weights), grad + ridge * weights


def descend(loss: Callable[[np.ndarray], tuple[float, np.ndarray]], width: int, steps: int, flat: float = 1e-4) -> np.ndarray:
    """Where a convex loss is least, by BFGS from 0 until no slope is over ``flat``."""
    w, inverse = np.zeros(width), np.eye(width)
    value, grad = loss(w)
    for step in range(steps):
        if np.abs(grad).max() <= flat:
            break
        way, far = -inverse @ grad, 1.0
        while True:
            to_value, to_grad = loss(w + far * way)
            if to_value <= value + 1e-4 * far * (grad @ way) or far < 1e-3:
                break
            far /= 2
        moved, turned = far * way, to_grad - grad
        if (bend := moved @ turned) > 1e-12:
            if not step:
                inverse *= bend / (turned @ turned)
            turn = np.eye(width) - np.outer(moved, turned) / bend
            inverse = turn @ inverse @ turn.T + np.outer(moved, moved) / bend
        w, value, grad = w + moved, to_value, to_grad
    return w


def value_at(values: DataFrame, name: str, rank: int) -> float:
    """The value at ``rank``, from 0 in ascending order, exactly: the cell around it is narrowed until it holds one value."""
    inside, low, width = values, 0.0, 1 / CELLS
    while True:
        cells = inside.groupBy(F.floor((F.col(name) - low) / width).alias("cell")).agg(F.count(F.lit(1)).alias("n"), F.min(name).alias("low"), F.max(name).alias("high"))
        for cell in sorted(cells.collect(), key=lambda c: c["cell"]):
            if rank < cell["n"]:
                break
            rank -= cell["n"]
        low, high = cell["low"], cell["high"]
        if low == high:
            return low
        inside, width = values.where(F.col(name).between(low, high)), (high - low) / 1000


def quantile(values: DataFrame, name: str, n: int, share: float) -> float:
    """As numpy's, of ``n`` values: between two ranks in proportion."""
    at = share * (n - 1)
    low = value_at(values, name, math.floor(at))
    return low if at == math.floor(at) else low + (at - math.floor(at)) * (value_at(values, name, math.floor(at) + 1) - low)


def fit(documents: DataFrame, labels: DataFrame, cut: float = 0.3, steps: int = 400) -> Model:
    """documents(doc_id, text) and labels(doc_id, quality), of training rows alone -> a model.

    All labelled texts and all their pairs teach; the driver gets sums by cells of worth.
    """
    sample = labelled_texts(documents, labels.where("quality in (0, 1)"), "quality")
    rows = materialised(sample.select("text", "quality").mapInArrow(_feature_rows, "x array<double>, quality int"))
    bad, good, centre, scale = _moments(rows)
    if not bad or not good:
        return Model()
    rows = rows.coalesce(-(-(bad + good) // TASK_ROWS))
    w = descend(lambda w: pair_loss(_cells(rows, centre, scale, w), w), len(FEATURES), steps)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(((_matrix(batch) - centre) / scale * w).sum(1))], names=["quality", "worth"])

    worth = materialised(rows.mapInArrow(run, "quality int, worth double"))
    threshold = quantile(worth, "worth", bad + good, bad / (bad + good))
    slope = 2 / max(quantile(worth.where("quality = 1"), "worth", good, 0.5) - threshold, 1e-6)
    return Model(centre, scale, w, threshold, slope, cut)


def score(documents: DataFrame, model: Model) -> DataFrame:
    """documents(doc_id, text) -> doc_id, score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.array([features(t or "") for t in batch.column(1).to_pylist()]).reshape(batch.num_rows, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.scores(rows), pa.float64())], names=["doc_id", "score"])

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double")
