"""Embedding near-duplicates against all pairs."""

import numpy as np

from tabwright.llm.components import components
from tabwright.llm.embedding_dedup import hadamard, hash_codes, near_duplicates, tables_for


def brute(rows, threshold=0.95):
    good = {}
    for k, (_, v) in enumerate(rows):
        if v and None not in v:
            x = np.array(v, np.float64)
            if np.isfinite(x).all() and (x != 0).any():
                good[k] = x / np.linalg.norm(x)
    root = {k: k for k in range(len(rows))}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    links = dict.fromkeys(root, 0)
    for i in good:
        for j in good:
            if i < j and len(good[i]) == len(good[j]) and good[i] @ good[j] >= threshold:
                links[i] += 1
                links[j] += 1
                root[find(j)] = find(i)
    least = {}
    for k in root:
        least.setdefault(find(k), []).append(rows[k][0])
    return sorted((rows[k][0], links[k], min((i for i in least[find(k)] if i is not None), default=None)) for k in root if rows[k][0] is not None)


def vectors():
    draw = np.random.default_rng(4)
    rows = []
    for centre in draw.normal(size=(30, 64)):
        for _ in range(int(draw.integers(1, 12))):
            rows.append((len(rows), (centre + draw.normal(size=64) * draw.choice([0.05, 0.2, 0.24])).astype(np.float32).tolist()))
    rows += [(len(rows) + i, draw.normal(size=64).astype(np.float32).tolist()) for i in range(200)]
    rows += [(1000 + i, rows[3][1]) for i in range(40)] + [(3, rows[3][1])]
    rows += [(2000, None), (2001, []), (2002, [0.0] * 64), (2003, [None] + [1.0] * 63), (2004, [float("nan")] * 64), (2005, [float("inf")] + [1.0] * 63), (2006, [1.0, 2.0, 3.0]), (2007, [1.0, 2.0, 3.01]), (2008, [3e38] * 64), (2009, [1e-40] * 64)]
    return rows


def test_against_all_pairs(spark):
    rows = vectors()
    frame = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, digest string").repartition(5)
    for block in (512, 16):
        got = near_duplicates(frame, block=block).collect()
        assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == brute(rows)
        assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_null_id_and_empty(spark):
    kind = "vec_id long, embedding array<float>"
    assert near_duplicates(spark.createDataFrame([], kind)).collect() == []
    got = near_duplicates(spark.createDataFrame([(None, [1.0, 0.0]), (5, [1.0, 0.01]), (None, None)], kind)).collect()
    assert sorted((r.vec_id or -1, r.n_links, r.component_id, r.kept) for r in got if r.n_links) == [(-1, 1, 5, False), (5, 1, 5, True)]
    assert len(got) == 3


def test_ties_at_the_threshold_link(spark):
    rows = [(1, [1.0, 0.0, 0.0, 0.0]), (2, [2.0, 2.0, 2.0, 2.0]), (3, [1.0, 1.0, 1.0, -1.0]), (4, [0.0, 3.0, 0.0, 0.0]), (5, [1.0, 1.0, 1.0, 0.9])]
    frame = spark.createDataFrame([(i, v, 1, "b", 2) for i, v in rows], "vec_id long, embedding array<double>, dim int, bucket string, node int")
    got = near_duplicates(frame, threshold=0.5, hashes=1, recall=1 - 1e-9).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == brute(rows, 0.5)
    assert {r.vec_id: r.n_links for r in got}[1] == 3


def test_wide_vectors(spark):
    draw = np.random.default_rng(6)
    rows = []
    for _ in range(60):
        x, z = draw.standard_normal((2, 700))
        x /= np.linalg.norm(x)
        z -= (z @ x) * x
        z /= np.linalg.norm(z)
        rows += [(len(rows), x.tolist()), (len(rows) + 1, (0.952 * x + np.sqrt(1 - 0.952**2) * z).tolist())]
    got = near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == brute(rows)


def test_tables_reach_the_recall_at_any_width():
    draw = np.random.default_rng(5)
    for dim, hashes in ((3, 2), (64, 2), (384, 2), (768, 3)):
        tables = tables_for(dim, hashes, 0.95, 0.99)
        x, z = draw.standard_normal((2, 600, dim))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        z -= (z * x).sum(1, keepdims=True) * x
        z /= np.linalg.norm(z, axis=1, keepdims=True)
        a, b = (hash_codes(v, tables, hashes, seed=9) for v in (x, 0.95 * x + np.sqrt(1 - 0.95**2) * z))
        assert ((a == b[:, :, :1]) | (b == a[:, :, :1])).any((1, 2)).mean() > 0.97, (dim, hashes, tables)


def test_hadamard_keeps_angles():
    x = np.random.default_rng(0).normal(size=(5, 16))
    assert np.allclose(hadamard(x) @ hadamard(x).T, 16 * x @ x.T)


def test_components(spark):
    draw = np.random.default_rng(8)
    edges = [(int(a), int(b)) for a, b in draw.integers(0, 400, (300, 2))] + [(i, i + 1) for i in range(1000, 1200)] + [(2000, 2000 + i) for i in range(300)] + [(5, 5)]
    root = {}

    def find(k):
        root.setdefault(k, k)
        while root[k] != k:
            k = root[k]
        return k

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    want = {k: find(k) for k in list(root)}
    for few in (10, 10_000):
        got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long"), few).collect()}
        assert all(got.get(k, k) == v for k, v in want.items()) and set(got) <= set(want)
        assert components(spark.createDataFrame([], "a long, b long"), few - 11).collect() == []
