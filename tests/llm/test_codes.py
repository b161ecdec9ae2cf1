"""Vector codes against plain Lloyd, and the heaps against full scans."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import codes


def plain(rows, scale, positions, entries, rounds):
    kept = [(i, v, label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = max(1, -(-max(len(v) for _, v, _ in kept) // positions))
    x = [[math.floor(scale * c) for c in v] + [0] * (width * positions - len(v)) for _, v, _ in kept]
    order = sorted(range(len(kept)), key=lambda j: (kept[j][0] is None, kept[j][0] or 0, kept[j][1]))[:entries]
    parts = [[v[p * width : (p + 1) * width] for v in x] for p in range(positions)]
    books = [[parts[p][j] for j in order] for p in range(positions)]
    dist = lambda a, b: sum((m - n) ** 2 for m, n in zip(a, b, strict=True))
    assign = lambda: [[min(range(len(books[p])), key=lambda e: (dist(v, books[p][e]), e)) for v in parts[p]] for p in range(positions)]  # noqa: E731, B023
    for _ in range(rounds):
        own = assign()
        for p in range(positions):
            for e in range(len(books[p])):
                mine = [parts[p][j] for j in range(len(x)) if own[p][j] == e]
                if mine:
                    books[p][e] = [sum(c) // len(mine) for c in zip(*mine, strict=True)]
    own = assign()
    error = [sum(dist(parts[p][j], books[p][own[p][j]]) for p in range(positions)) for j in range(len(x))]
    of: dict = {}
    for (_, _, label), e in zip(kept, error, strict=True):
        of[label] = of.get(label, 0) + e
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return [(i, "".join(f"{own[p][j]:02x}" for p in range(positions)), error[j], of[label], sha) for j, (i, _, label) in enumerate(kept)]


def corpus(n, d, spread=1.0):
    rng = random.Random(n)
    centres = [[rng.gauss(0, 4) for _ in range(d)] for _ in range(9)]
    rows = [(3 * i, [c + rng.gauss(0, spread) for c in rng.choice(centres)], rng.choice([0, 0, 0, 1, 2, None])) for i in range(n)]
    rows += [(7000 + i, rows[5][1], i % 40 + 3) for i in range(n // 3)]  # one vector that a quarter of the rows share
    odd = [(8000, None, 1), (8001, [math.nan] * d, 1), (8002, [1.0] * (d - 1) + [None], 1), (8003, [math.inf] * d, 2), (8004, [0.5] * (d - 1), 1), (8005, [], None), (None, [0.1] * d, 1), (None, [0.2] * d, None)]
    return [*rows, *odd, rows[4], rows[4], (rows[4][0], rows[9][1], 1)]


@pytest.mark.parametrize("kind,block,hot", [("double", 1 << 13, 1000), ("double", 37, 10), ("float", 50, 3)])
def test_codes(spark, monkeypatch, kind, block, hot):
    monkeypatch.setattr(codes, "BLOCK", block)
    monkeypatch.setattr(codes, "HOT", hot)
    rows = corpus(240, 10)
    if kind == "float":
        rows = [(i, v and [None if x is None else float(np.float32(x)) for x in v], label) for i, v, label in rows]
    given = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("embedding", F.col("embedding").cast(f"array<{kind}>"))
    found = codes.compress(given.withColumn("code", F.lit("x")).withColumn("n", F.lit(1)).repartition(5), 64, 4, 16, 3)
    assert found.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(plain(rows, 64, 4, 16, 3), key=repr)


def test_few_vectors_and_none(spark):
    rows = [(4, [1.0, -2.0], 1), (2, [0.25, 0.5], None)]
    schema = "vec_id long, embedding array<float>, label int"
    assert sorted(map(tuple, codes.compress(spark.createDataFrame(rows, schema)).collect())) == sorted(plain(rows, 1024, 4, 256, 4))
    assert codes.compress(spark.createDataFrame([], schema)).count() == 0
    assert codes.compress(spark.createDataFrame([(1, None, 1)], schema)).count() == 0
    with pytest.raises(ValueError):
        codes.compress(spark.createDataFrame([(1, [1e30], 1)], schema)).count()


def test_large_components_are_exact(spark):
    rng = random.Random(3)
    rows = [(i, [float(rng.randrange(-(1 << 28), 1 << 28)) for _ in range(8)], 0) for i in range(40)]
    found = codes.compress(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), 1, 2, 7, 2)
    assert sorted(map(tuple, found.collect())) == sorted(plain(rows, 1, 2, 7, 2))


@pytest.mark.parametrize("spread,most", [(0.3, 0.5), (40.0, 1.0)])
def test_heaps_leave_alone_what_cannot_change(spread, most):
    """After each round the codes are those of a full scan; on clusters most parts are never popped again."""
    rng = np.random.default_rng(5)
    centres = rng.integers(-4000, 4000, (64, 8))
    x = (np.repeat(centres, 60, axis=0) + rng.normal(0, 100 * spread, (64 * 60, 8))).astype(np.int64)
    books = codes.Codebooks.first(x[::60], 1)
    heaps, popped = codes.Heaps.built(x, books, 0), 0
    for _ in range(6):
        own = heaps.codes.astype(int)
        n = np.bincount(own, minlength=64)
        sums = np.zeros((64, 8), np.int64)
        np.add.at(sums, own, x)
        books = books.moved(sums[None], n[None])
        popped += heaps.run(x, books, 0)
        assert (heaps.codes == codes.nearest(x, books.entries[0])[0]).all()
        for e in range(64):
            assert (np.diff(heaps.keys[heaps.codes[heaps.heap] == e]) >= 0).all()
    assert popped <= most * 6 * len(x)
