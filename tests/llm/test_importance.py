"""Importance resampling against a plain version, on rows with every irregularity."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from corpusloom.llm import importance


def plain(documents, target, percent, least, longest, buckets):
    def features(text):
        words = re.findall(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        return len(words), [" ".join(words[i : i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1)]

    of = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = Counter(), Counter()
    for _, text in documents:
        s.update(map(of, features(text)[1]))
    for (text,) in target:
        t.update(map(of, features(text)[1]))
    total = float(sum(s.values()) + buckets), float(sum(t.values()) + buckets)
    gain = [math.floor(1000 * math.log((t[b] + 1) * total[0] / ((s[b] + 1) * total[1]))) for b in range(buckets)]
    rows = []
    for i, text in documents:
        n, found = features(text)
        h = int(hashlib.sha256(f"2024:{'null' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[of(f)] for f in found)
        rows.append([i, n, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    order = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2], r[3]))
    drawn = [id(r) for r in order[: percent * len(order) // 100]]
    return [(*r, drawn.index(id(r)) + 1 if id(r) in drawn else None) for r in rows]


def corpus(n):
    rng = random.Random(n)
    vocabulary = [f"wort{i}" for i in range(60)] + ["É", "straße", "x9", "日本", "a b"]
    rows = [(i, rng.choice([" ", ", ", "\n"]).join(rng.choice(vocabulary) for _ in range(rng.randint(1, 60))).title()) for i in range(n)]
    rows += [(n + i, rows[3][1]) for i in range(n // 2)]  # a third of the rows are copies of one text
    rows += [(9000, None), (9001, ""), (9002, "... --- ..."), (None, rows[4][1] + " more"), (None, rows[4][1] + " more"), (5, rows[6][1]), (5, rows[5][1]), (9003, "Viel " * 30_000)]
    return rows, [(" ".join(rng.choice(vocabulary[:20]) for _ in range(40)),) for _ in range(5)] + [(None,), ("",)]


@pytest.mark.parametrize("longest,cell", [(1, 1 << 18), (2, 1 << 18), (1, 2)])
def test_draw(spark, monkeypatch, longest, cell):
    monkeypatch.setattr(importance, "CELL", cell)
    rows, target = corpus(200)
    documents = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("x")).withColumn("words", F.lit(1)).repartition(5)
    found = importance.resample(documents, spark.createDataFrame(target, "text string"), 30, 20, longest, 500)
    assert found.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(plain(rows, target, 30, 20, longest, 500), key=repr)


def test_hot_scores_are_numbered_in_cells(spark, monkeypatch):
    """All rows of one score: noise is taken out, weights are equal."""
    monkeypatch.setattr(importance, "CELL", 7)
    scored = importance.scored
    monkeypatch.setattr(importance, "scored", lambda *a: scored(*a).withColumn("score", F.col("weight")))
    rows = [(i * i, "one two three " * 8) for i in range(100)] + [(None, "one two three " * 8)] * 2
    documents = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = importance.resample(documents, spark.createDataFrame([("one",)], "text string"), 100, 20).collect()
    assert sorted((r["rank"], r.doc_id) for r in found)[:100] == [(i + 1, i * i) for i in range(100)]
    assert sorted(r["rank"] for r in found if r.doc_id is None) == [101, 102]


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    assert importance.resample(none, some).count() == 0
    assert [tuple(r)[:4] + (r["rank"],) for r in importance.resample(some, none).orderBy("doc_id").collect()][1] == (2, 0, 0, 0, None)
