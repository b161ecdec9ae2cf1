import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import ann, topk


def corpus(n, d=24):
    rng = random.Random(n)
    rows = [(i, [rng.gauss(0, 0.2) for _ in range(d)]) for i in range(n)]
    rows += [(n + i, rows[20][1]) for i in range(n // 3)]  # one vector that a quarter of the rows share
    rows += [(5000, None), (5010, []), (5020, [0.0] * d), (5030, [math.nan] * d), (5040, [1.0] * (d - 1) + [None]), (5060, [math.inf] * d), (5080, [0.3] * (d - 4)), (None, [0.1] * d)]
    return [*rows, rows[20], rows[3]]


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("x")).repartition(5)


def usable(rows):
    return {i: v for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)}


def test_exact_top_k(spark):
    rows = corpus(900)
    vectors = {i: [math.floor(64 * x) for x in v] for i, v in usable(rows).items()}
    expected = []
    for q, v in vectors.items():
        if q % 20 == 0:
            all_ = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), i) for i, w in vectors.items() if i != q)
            expected += [(q, r + 1, i, -s) for r, (s, i) in enumerate(all_[:20])]
    assert sorted(tuple(r) for r in topk.top_k(frame(spark, rows), "vec_id % 20 = 0", 20).collect()) == sorted(expected)


@pytest.mark.parametrize("kind", ["double", "float"])
def test_neighbours(spark, kind):
    rows = corpus(900)
    if kind == "float":
        rows = [(i, v and [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    vectors = {i: np.array(v + [0.0] * (24 - len(v))) for i, v in usable(rows).items() if any(v)}
    found: dict = {}
    given = frame(spark, rows).withColumn("embedding", F.col("embedding").cast(f"array<{kind}>"))
    for r in ann.neighbours(given, "vec_id % 50 = 0", 5).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(found) == {i for i in vectors if i % 50 == 0}
    hits = total = 0
    for q, got in found.items():
        cos = {i: float((vectors[q] * v).sum() / (np.linalg.norm(vectors[q]) * np.linalg.norm(v))) for i, v in vectors.items() if i != q}
        best = sorted(cos, key=lambda i: (-round(cos[i], 12), i))[:5]
        got.sort()
        assert [r for r, _, _ in got] == [1, 2, 3, 4, 5]
        assert all(abs(s - cos[i]) < 1e-12 for _, i, s in got)
        assert [i for _, i, _ in got] == sorted([i for _, i, _ in got], key=lambda i: (-round(cos[i], 12), i))
        hits, total = hits + len({i for _, i, _ in got} & set(best)), total + 5
    assert hits >= 0.9 * total


def test_few_and_none(spark):
    few = frame(spark, [(0, [1.0, 0.0]), (50, [-1.0, 0.0]), (7, [0.0, 1.0])])
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in ann.neighbours(few, "vec_id % 50 = 0", 5).collect()) == [(0, 1, 7), (0, 2, 50), (50, 1, 7), (50, 2, 0)]
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in topk.top_k(few, "vec_id = 0", 5).collect()) == [(0, 1, 7), (0, 2, 50)]
    for none in (few.limit(0), frame(spark, [(0, None)])):
        assert ann.neighbours(none, "vec_id % 50 = 0", 5).count() == topk.top_k(none, "vec_id = 0", 5).count() == 0


def test_bounds_prune_clustered_vectors():
    rng = np.random.default_rng(3)
    centres = rng.integers(-200, 200, (16, 24))
    vectors = np.concatenate([c + rng.integers(-8, 9, (topk.BLOCK, 24)) for c in centres])
    ids, asks = np.arange(len(vectors)), np.arange(0, len(vectors), 20)
    cuts = range(0, len(vectors), topk.BLOCK)
    most, least = (np.stack([f(vectors[i : i + topk.BLOCK], axis=0) for i in cuts]) for f in (np.max, np.min))
    scored = topk.Scored(ids[asks], np.full(len(asks), topk.NOTHING), 20)
    pairs = topk.search(scored, vectors[asks], ids, vectors, most, least)
    assert pairs < 0.25 * len(asks) * len(cuts)
    products = vectors[asks] @ vectors.T
    for i, q in enumerate(asks):
        expected = sorted((-s, c) for c, s in enumerate(products[i].tolist()) if c != q)[:20]
        at = scored.query == i
        assert sorted(zip((-scored.score[at]).tolist(), scored.found[at].tolist(), strict=True)) == expected


def test_tiles_pass_queries_and_lanes(spark, monkeypatch):
    monkeypatch.setattr(topk, "TILE_QUERIES", 1)
    monkeypatch.setattr(topk, "ROW", 300)
    test_exact_top_k(spark)


def test_recall_of_clustered_vectors(spark):
    """Where vectors have near neighbours, buckets hold most of them and few others."""
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(60, 32))
    vectors = np.concatenate([c + 0.15 * rng.normal(size=(40, 32)) for c in centres])
    given = spark.createDataFrame(list(enumerate(vectors.tolist())), "vec_id long, embedding array<double>").repartition(4)
    hashing, found = ann.Hashing(hashes=8, width=1.0, probes=8), {}
    for r in ann.neighbours(given, "vec_id % 50 = 0", 5, hashing).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    unit = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    hits = seen = 0
    for q, got in found.items():
        cos = unit @ unit[q]
        cos[q] = -2
        hits += len(got & set(np.argsort(-cos)[:5].tolist()))
        held = [np.isin(hashing.own(unit, t), hashing.visited(unit[q : q + 1], t)) for t in range(hashing.tables)]
        seen += np.any(held, axis=0).sum()
    assert len(found) == 48 and hits >= 0.95 * 5 * 48 and seen < 0.05 * 48 * len(unit)


def test_rows_that_repeat_in_any_order_count_once(spark):
    """(1, A), (1, B), (1, A) of one sign code, which a sort by code and id alone may leave in this order."""
    a, b = [0.5, 0.25, 1.0], [0.5, 0.375, 1.0]
    rows = [(1, a), (1, b), (1, a), (20, [1.0, 1.0, 1.0]), (1, b), (1, a), (20, [1.0, 1.0, 1.0])]
    found = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>").coalesce(1), "vec_id = 20", 9).collect()
    score = lambda v: sum(64 * math.floor(64 * x) for x in v)
    assert sorted((r["rank"], r.vec_id, r.score) for r in found) == [(1, 1, score(b)), (2, 1, score(a))]


@pytest.mark.parametrize("size", [1, 300, 1 << 20, 1 << 40])
def test_integers_travel_in_the_narrowest_type(size):
    m = np.array([[0, -size, size - 1], [5, 6, -7]])
    data = topk.narrow(m)
    assert (topk.opened(data, 3) == m).all() and len(data) == 1 + 6 * (2 if size < 1 << 15 else 4 if size < 1 << 31 else 8)


def test_rows_of_the_index_that_no_query_needs_do_not_travel(spark, monkeypatch):
    """Clusters far apart: by the bounds, a group of queries needs few rows."""
    monkeypatch.setattr(topk, "ROW", 64)
    monkeypatch.setattr(topk, "BLOCK", 16)
    rng = np.random.default_rng(3)
    rows = [(i, (np.eye(8)[i % 8] * 40 + rng.normal(0, 0.1, 8)).tolist()) for i in range(2000)]
    given = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    told = []
    save = topk.Scratch.save
    monkeypatch.setattr(topk.Scratch, "save", lambda self, df, name, *a: (lambda t: told.append((name, t.count())) or t)(save(self, df, name, *a)))
    found = topk.top_k(given, "vec_id = 8", 5).collect()
    q = np.floor(64 * np.array(rows[8][1]))
    best = sorted((-int(q @ np.floor(64 * np.array(v))), i) for i, v in rows if i != 8)[:5]
    assert [(r.vec_id, r.score) for r in sorted(found, key=lambda r: r["rank"])] == [(i, -s) for s, i in best]
    assert dict(told)["wanted"] < dict(told)["index"] / 3
