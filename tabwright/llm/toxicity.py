"""Toxicity by weak supervision.

1. Terms: words and word beginnings, present or dense (twice at least and ``DENSE`` of the words), that mark
   toxic labelled training texts far more often than the others become the entries of lexicon voters. A term
   counts once for each distinct neighbourhood (the words around it), so that copies of one text prove nothing
   twice.
2. Voters: the terms, dealt over ``VOTERS`` lexicon voters by kind, and pattern voters (shouting, repeated
   marks, tables, addresses, digits). Each votes on each document.
3. Label model: a two-class mixture with a rate of votes for each class and voter, fitted by expectation
   maximisation on the votes alone. Voters that still correlate within the classes share their say: a voter's
   evidence is divided by one plus its summed correlations with others. The result is a posterior for each text.
4. A logistic classifier on term and pattern features is trained on the posterior labels and scores every text.

Voters don't abstain: one without a hit votes clean, and its two rates say how much that means. Accuracies are the
model's own estimates of how often a voter agrees with the class.

Everything that is learned from labels comes from at most ``max_labelled`` labelled training ids (those
with the smallest hashes), an id by one text (the one with the least crc32); the classifier is applied to whole texts
of every document.

Defined results: null and empty texts score as texts without any feature; null labels and labels of documents
that aren't there teach nothing, of an id's conflicting labels the higher counts; without toxic examples every score is
the base rate. Repeated rows score alike. Only the columns named are read, so extra columns may clash freely.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tabwright.llm.common import cut, labelled_texts

VOTERS = 6
DENSE = 0.006
KINDS = "w45d"
#: Rows of terms that a task holds before they go out, some 20 MB, besides those of one text.
HELD = 100_000
EDGES = ".,;:!?\"'()[]{}<>|*#$%&-_=+/\\"
PATTERNS = ("shouting", "repeated_marks", "table", "address", "digits")
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_MARKS = re.compile(r"[!?$%&*#]{2}")


def word_terms(token: str) -> list[str]:
    """A token's terms: its word, and the word's first four and five letters."""
    word = token.strip(EDGES)
    if not word:
        return []
    out = ["w:" + word]
    if len(word) >= 4:
        out.append("4:" + word[:4])
    if len(word) >= 5:
        out.append("5:" + word[:5])
    return out


def pattern_votes(text: str) -> list[bool]:
    raw = text.encode("utf-8", "surrogatepass")
    capitals = len(raw) - len(raw.translate(None, CAPITALS))
    return [capitals > 0.25 * len(text), _MARKS.search(text) is not None, " | " in text, "@" in text, sum(map(text.count, "0123456789")) > 4]


@dataclass
class Model:
    terms: dict[str, int] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(len(PATTERNS)))
    bias: float = 0.0
    accuracies: list[float] = field(default_factory=list)
    correlations: list[list[float]] = field(default_factory=list)

    def score(self, hits: list[int]) -> float:
        return float(1 / (1 + np.exp(-(self.bias + self.weights[hits].sum()))))


def _is_dense(count: int, words: int) -> bool:
    return count >= 2 and count >= DENSE * words


def term_hits(texts: list[str], terms: dict[str, int]) -> Iterator[list[int]]:
    """For each text the features it has: term numbers, then patterns numbered after them."""
    known: dict[str, tuple[str, ...]] = {}
    wanted = {t.removeprefix("d") for t in terms}
    n = len(terms)
    for text in texts:
        if len(known) > 400_000:
            known.clear()
        words = text.lower().split()
        counts: Counter[str] = Counter()
        for token, times in Counter(words).items():
            hit = known.get(token)
            if hit is None:
                hit = known[token] = tuple(t for t in word_terms(token) if t in wanted)
            for t in hit:
                counts[t] += times
        found = [terms[t] for t in counts if t in terms] + [terms["d" + t] for t, c in counts.items() if "d" + t in terms and _is_dense(c, len(words))]
        yield sorted(found) + [n + i for i, yes in enumerate(pattern_votes(text)) if yes]


def _term_rows(batches: Iterator[pa.RecordBatch], most: int = HELD) -> Iterator[pa.RecordBatch]:
    """text, toxic -> term, toxic, place: each term of a document once, with a hash of the words around its first place. A
    neighbourhood that stands in several documents goes out once for every ``most`` rows or so."""
    import xxhash

    def listed(found: dict[tuple[str, int, int], None]) -> pa.RecordBatch:
        terms, toxics, places = zip(*found, strict=True) if found else ((), (), ())
        return pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), pa.array(toxics, pa.int32()), pa.array(places, pa.int64())], names=["term", "toxic", "place"])

    for batch in batches:
        found: dict[tuple[str, int, int], None] = {}
        for text, toxic in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
            words = (text.as_py() or "").lower().split()
            first: dict[str, int] = {}
            for i, token in enumerate(words):
                first.setdefault(token, i)
            times = Counter(words)
            counts: dict[str, list[int]] = {}
            for token, i in first.items():
                for term in word_terms(token):
                    counts.setdefault(term, [0, i])[0] += times[token]
            for term, (c, i) in counts.items():
                place = xxhash.xxh32_intdigest(" ".join(words[max(0, i - 1) : i + 2]))
                for t in (term, "d" + term) if _is_dense(c, len(words)) else (term,):
                    found[t, toxic, place] = None
            if len(found) >= most:
                yield listed(found)
                found = {}
        yield listed(found)


def label_model(votes: np.ndarray, rounds: int = 50) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """votes (documents x voters, 0/1) -> posterior of class 1, accuracies, correlations within the classes."""
    n, k = votes.shape
    # Voters start as if each were somewhat right; fitting decides.
    posterior = np.clip(votes.mean(1) / max(votes.mean(1).max(), 1e-9), 0.01, 0.99) * 0.9
    say = np.ones(k)
    corr = np.zeros((k, k))
    for turn in range(rounds):
        mass = np.stack([1 - posterior, posterior])
        rate = (mass @ votes + 0.5) / (mass.sum(1, keepdims=True) + 1.0)
        base = float(np.clip(posterior.mean(), 1e-3, 0.5))
        if turn % 10 == 9:
            rest = votes - (mass.T @ rate)
            spread = np.maximum((rest**2).mean(0), 1e-9)
            corr = (rest.T @ rest) / n / np.sqrt(np.outer(spread, spread))
            np.fill_diagonal(corr, 0)
            say = 1 / (1 + np.where(np.abs(corr) > 0.2, np.abs(corr), 0).sum(1))
        on = np.log(rate[1] / rate[0]) * say
        off = np.log((1 - rate[1]) / (1 - rate[0])) * say
        odds = np.log(base / (1 - base)) + votes @ on + (1 - votes) @ off
        posterior = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    return posterior, (posterior @ votes + (1 - posterior) @ (1 - votes)) / n, corr


def logistic(rows: list[list[int]], labels: np.ndarray, width: int, steps: int = 300, ridge: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights and bias on 0/1 features by Adam on the logistic loss of soft labels."""
    at = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    cols = np.array([c for r in rows for c in r], np.int64)
    base = float(np.clip(labels.mean(), 1e-4, 1 - 1e-4))
    w, b = np.zeros(width), np.log(base / (1 - base))
    first, second = np.zeros(width + 1), np.zeros(width + 1)
    for step in range(1, steps + 1):
        z = b + np.bincount(at, w[cols], len(rows))
        gap = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels
        grad = np.append(np.bincount(cols, gap[at], width) / len(rows) + ridge * w, gap.mean())
        first, second = 0.9 * first + 0.1 * grad, 0.99 * second + 0.01 * grad * grad
        move = 0.2 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return w, b


def fit(documents: DataFrame, labels: DataFrame, max_labelled: int = 20_000, min_places: int = 4) -> Model:
    """documents(doc_id, text) and labels(doc_id, toxic), of training rows alone -> a model.

    ``max_labelled`` bounds what is learned from, and so what the driver collects: features of as many texts and their
    terms of at least ``min_places`` neighbourhoods in toxic ones.
    """
    sample = cut(labelled_texts(documents, labels, "toxic", max_labelled))
    count = {int(r["toxic"]): r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = count.get(1, 0), count.get(0, 0)
    model = Model(bias=float(np.log((n1 + 0.5) / (n0 + 9.5))))
    if not n1 or not n0:
        return model
    rows = sample.select("text", "toxic").mapInArrow(_term_rows, "term string, toxic int, place long")
    places = rows.groupBy("term", "toxic", "place").agg(F.lit(1).alias("one"))
    counted = places.groupBy("term").agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good"))
    lift = F.log((F.col("bad") + 0.5) / (n1 + 1)) - F.log((F.col("good") + 0.5) / (n0 + 1))
    kept = counted.where((F.col("bad") >= min_places) & (lift > 2.0)).orderBy(F.desc(F.col("bad") * lift), "term")
    listed = kept.select("term").collect()
    model.terms = {r["term"]: i for i, r in enumerate(listed)}
    terms = model.terms

    def hits_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(list(term_hits(texts, terms)), pa.list_(pa.int32()))], names=["hits"])

    hits = [r["hits"] for r in sample.select("text").mapInArrow(hits_of, "hits array<int>").collect()]
    n, width = len(terms), len(terms) + len(PATTERNS)
    voter_of = np.array([KINDS.index(t[0]) * VOTERS + i % VOTERS for t, i in terms.items()] + [len(KINDS) * VOTERS + i for i in range(len(PATTERNS))], np.int64)
    votes = np.zeros((len(hits), len(KINDS) * VOTERS + len(PATTERNS)))
    for i, row in enumerate(hits):
        votes[i, voter_of[row]] = 1
    posterior, accuracy, corr = label_model(votes)
    model.accuracies, model.correlations = accuracy.tolist(), corr.round(3).tolist()
    model.weights, model.bias = logistic(hits, posterior, width)
    assert len(model.weights) == n + len(PATTERNS)
    return model


def score(documents: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",), name: str = "score") -> DataFrame:
    """documents(doc_id, text, ..) -> the columns ``keep`` and ``name``. Other columns of the table aren't read."""
    at = keep.index("text") if "text" in keep else len(keep)  # texts go to Python once
    chosen = documents.select(*keep, *([F.col("text").alias("__text")] if at == len(keep) else []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(at).to_pylist()]
            scores = [model.score(h) for h in term_hits(texts, model.terms)]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(scores, pa.float64())], names=[*keep, name])

    return chosen.mapInArrow(run, StructType([*chosen.schema.fields[: len(keep)], StructField(name, DoubleType())]))
