"""Exact top-k against all inner products."""

import math

import numpy as np
import pytest

from tillmart.llm.vector_search import build_index, choose_pivots, keyed_vectors, top_k, whole_vectors

EVERY = "vec_id % 100 = 0"
SCHEMA = "vec_id long, embedding array<double>, label int, row string"


def brute(rows, k=10, scale=1024):
    """Sorted (query_id, rank, vec_id, score); ids may repeat, so rows are told apart by their place."""
    used = [
        (i, [math.floor(scale * x) for x in v]) for i, v in rows
        if v is not None and all(x is not None and math.isfinite(x) and abs(x) * scale < 2**31 for x in v) and sum((x * scale)**2 for x in v) < 2**61
    ]
    out = []
    for at, (query, q) in enumerate(used):
        if query is None or query % 100:
            continue
        scores = [(-sum(map(int.__mul__, q, x)), i is None, i or 0) for n, (i, x) in enumerate(used) if n != at and len(x) == len(q)]
        out += [(query, r, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=repr)


def run(spark, rows, partitions=3, **options):
    frame = spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0, "x") for i, v in rows], SCHEMA)
    got = top_k(frame.repartition(partitions), EVERY, **options)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(map(tuple, got.collect()), key=repr)


def unit(rng, n, dim):
    x = rng.normal(size=(n, dim))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def test_clusters_copies_and_ties(spark):
    rng = np.random.default_rng(4)
    centres = unit(rng, 6, 12)
    points = np.concatenate([centres[rng.integers(0, 6, 1500)] + rng.normal(scale=0.02, size=(1500, 12)), unit(rng, 300, 12), np.repeat(centres[:1], 1400, 0)])
    order = rng.permutation(len(points))
    rows = [(int(i) - 300, points[j].tolist()) for i, j in enumerate(order)]
    assert run(spark, rows) == brute(rows)


def test_waves_and_more_than_the_sample(spark):
    rng = np.random.default_rng(5)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.integers(-3, 4, size=(900, 3)) / 1024)]
    assert run(spark, rows, wave_bytes=200, sample_rows=20, pivots=4, k=7) == brute(rows, 7)


def test_odd_vectors(spark):
    rng = np.random.default_rng(6)
    nan, inf = float("nan"), float("inf")
    rows = [(0, None), (100, [nan, 1.0]), (200, [inf, 1.0]), (300, [None, 1.0]), (400, [1.0, 2.0]), (400, [1.0, 2.0]), (None, [1.0, 2.0])]
    rows += [(500, []), (501, []), (600, [1.0]), (-100, [-0.0004, 0.0]), (700, [2e6, 1.0]), (701, [2e6, -2e6]), (702, [3e6, 0.0]), (800, [0.0, 0.0])]
    rows += [(1000 + i, v.tolist()) for i, v in enumerate(rng.normal(size=(40, 2)))]
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows, sample_rows=1) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(1, [1.0])], [(100, [1.0])], [(0, None)]])
def test_few_rows(spark, rows):
    assert run(spark, rows, partitions=1) == []


def test_every_row_is_indexed(spark):
    rng = np.random.default_rng(7)
    points = np.concatenate([rng.normal(size=(2000, 4)), np.zeros((1500, 4))])
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(points)], "vec_id long, embedding array<double>")
    whole = whole_vectors(frame)
    index = build_index(keyed_vectors(whole, choose_pivots(whole))).collect()
    ids = np.concatenate([np.frombuffer(b["id"], "<i8") for b in index])
    assert sorted(ids.tolist()) == list(range(3500))
    for b in index:
        dist = np.frombuffer(b["dist"], "<f8")
        assert (np.diff(dist) >= 0).all() and (dist[0], dist[-1]) == (b["low"], b["high"]) and len(dist) <= 1024
