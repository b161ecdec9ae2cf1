import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import suffix
from corpusloom.llm.packing import pack, unpack, xxhash64


def brute(rows, n):
    """(doc_id, bytes, removed spans, kept) by a table of all strings."""
    first = {}
    for doc, text in rows:
        data = (text or "").encode()
        if doc is not None:
            for i in range(len(data) - n + 1):
                first[data[i : i + n]] = min(doc, first.get(data[i : i + n], doc))
    out = []
    for doc, text in rows:
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        if doc is not None:
            for i in range(len(data) - n + 1):
                if first[data[i : i + n]] < doc:
                    gone[i : i + n] = True
        edges = np.flatnonzero(np.diff(np.r_[0, gone.astype(int), 0]))
        out.append((doc, len(data), [(int(a), int(b - a)) for a, b in zip(edges[::2], edges[1::2])], bytes(np.frombuffer(data, np.uint8)[~gone])))
    return sorted(out, key=repr)


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice(["the", "of", "ä", "漢字", "tion", "er", "an", "a" * 30, "\n", "on"])
    passages = [" ".join(word() for _ in range(rng.randint(5, 40))) for _ in range(12)]
    rows = []
    for i in range(150):
        kind = rng.random()
        if kind < 0.2 and rows:
            text = list(rng.choice(rows)[1] or "")
            for _ in range(rng.randint(0, 4)):
                text.insert(rng.randrange(len(text) + 1), rng.choice("xyz é"))
            text = "".join(text)
        else:
            text = "".join(rng.choice([rng.choice(passages), " ".join(word() for _ in range(rng.randint(1, 20)))]) for _ in range(rng.randint(0, 5)))
        rows.append((i * 7 % 1009 - 300, text))
    return rows + [(5000, None), (5001, ""), (5002, "ab" * 400), (5003, "ab" * 300), (None, "ab" * 300), (5002, "ab" * 400)]


@pytest.mark.parametrize(("seed", "n", "gram"), [(1, 50, 20), (2, 20, 8), (3, 12, 12)])
def test_against_brute_force(spark, seed, n, gram):
    rows = corpus(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("kept", F.lit(1)).repartition(3)
    found = sorted(((r.doc_id, r.n_bytes, [(x.start, x.length) for x in r.removed], bytes(r.kept)) for r in suffix.without_repeats(df, n, gram).collect()), key=repr)
    assert found == brute(rows, n)


def test_empty(spark):
    assert suffix.without_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_maximal_repeats_of_one_text():
    text = b"xabcdyabcdzabcwabq"
    data = np.frombuffer(text, np.uint8)
    order, common = suffix.suffix_array(data, np.arange(len(data)), len(data) - np.arange(len(data)))
    assert order.tolist() == sorted(range(len(text)), key=lambda i: text[i:])
    left = np.array([data[i - 1] if i else -1 for i in order])
    found = {(text[order[a] : order[a] + n], tuple(sorted(order[a : b + 1].tolist()))) for n, a, b in suffix.maximal_repeats(common, left, 2)}
    assert found == {(b"abcd", (1, 6)), (b"abc", (1, 6, 11)), (b"ab", (1, 6, 11, 15))}


def test_packing(spark):
    a, b = np.array([0, 5, 255, 1 << 40], np.uint64), np.array([-1, 1, 7, -(1 << 62)], np.int64)
    x, y = unpack(pa.array([pack([a, b], (6, 8)), pack([a, b], (6, 8))]), (6, 8))
    assert x.tolist() == a.tolist() * 2 and y.view(np.int64).tolist() == b.tolist() * 2
    assert [r.h for r in spark.createDataFrame([(int(i),) for i in b], "x long").select(F.xxhash64("x").alias("h")).collect()] == xxhash64(b).tolist()


def results(spark, rows, n=50, gram=20, **more):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = suffix.without_repeats(df, n, gram, **more).collect()
    return sorted(((r.doc_id, r.n_bytes, [(x.start, x.length) for x in r.removed], bytes(r.kept)) for r in found), key=repr)


def test_many_texts_of_one_id_keep_their_own(spark):
    rng = random.Random(5)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(90))
    rows = [(7, "".join(rng.choice("xyz é") for _ in range(80)) + (passage if i % 2 else "")) for i in range(300)]
    rows += [(7, rows[3][1]), (6, passage), (8, rows[5][1]), (9, None), (9, "")]
    assert results(spark, rows) == brute(rows, 50)


@pytest.mark.parametrize("hot", [40, 1 << 12])
def test_an_anchor_of_many_contexts_is_split(spark, hot):
    """A passage in many documents: its edges have as many contexts as documents, equal only in part."""
    limits = suffix.Limits(strings=300, hot=hot)
    rng = random.Random(8)
    passage = " ".join(rng.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(20))
    around = lambda: "".join(rng.choice("01") for _ in range(rng.randint(0, 30)))
    rows = [(i, f"{around()}{passage}{around()}") for i in range(200)]
    find = suffix.Repeats(50, 20, 4, 4, False, limits)
    asked = find.match(pa.concat_tables(map(pa.Table.from_batches, [[b] for b in find.scan([as_batch(rows)]) if b["bin"][0].as_py() >= 0])))
    assert suffix.ASKED_STRINGS in asked["kind"].to_pylist()
    assert results(spark, rows, limits=limits) == brute(rows, 50)


def as_batch(rows):
    return pa.record_batch({"doc_id": pa.array([r[0] for r in rows], pa.int64()), "text": pa.array([r[1] for r in rows], pa.string())})


def test_a_text_of_many_blocks_and_flushes(spark):
    rng = random.Random(3)
    long = "".join(rng.choice("abcd é") for _ in range(3000))
    rows = [(1, long), (2, long[700:1900] + "zz" + long[100:160]), (3, "q" + long), (4, long[:10])]
    assert results(spark, rows, limits=suffix.Limits(block=256, flush=64)) == brute(rows, 50)


def test_other_columns_go_along(spark):
    rows = [(1, "ab" * 40, "x", 1), (2, "ab" * 40, None, 2)]
    df = spark.createDataFrame(rows, "doc_id int, text string, bin string, kept long")
    found = suffix.without_repeats(df, rest=True).collect()
    assert sorted((r.doc_id, r.rest.bin, r.rest.kept, len(r.kept)) for r in found) == [(1, "x", 1, 80), (2, None, 2, 0)]
