import random

import numpy as np
import pyarrow as pa
import pytest

from corpusloom.llm import jaccard
from corpusloom.llm.components import components
from corpusloom.llm.scratch import Scratch


def sets_of(text, k):
    words = (text or "").encode().lower().split()
    if not words:
        return set()
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} or {tuple(words)}


def brute(rows, k, percent):
    sets = {i: sets_of(t, k) for i, t in rows if i is not None}
    part = {i: i for i in sets}

    def root(i):
        while part[i] != i:
            i = part[i]
        return i

    ids = sorted(sets)
    for x in ids:
        for y in ids:
            if x < y and sets[x] and 100 * len(sets[x] & sets[y]) >= percent * len(sets[x] | sets[y]):
                a, b = sorted((root(x), root(y)))
                part[b] = a
    return sorted((i, len(sets_of(t, k)), root(i)) for i, t in rows if i is not None)


def corpus(seed, n=260):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(60)]
    bases = [[rng.choice(vocab) for _ in range(rng.choice([3, 5, 8, 14, 30, 70, 150, 400]))] for _ in range(25)]
    passage = [rng.choice(vocab) for _ in range(60)]
    big, rows = [rng.choice(vocab) for _ in range(90)], [(i, t) for i, t in enumerate([None, "", "  \t", "one", "ONE", "one two", "a b c d", "a b c d"])]
    for _ in range(n):
        words = list(big if rng.random() < 0.5 else rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 4, 9])):
            at = rng.randrange(len(words) + 1)
            words[at : at + rng.randint(0, 1)] = [rng.choice(vocab)]
        if rng.random() < 0.2:
            words += passage
        rows.append((len(rows), " ".join(words)))
    ids = rng.sample(range(10_000), len(rows))
    return [(ids[i], t) for i, (_, t) in enumerate(rows)]


@pytest.mark.parametrize(("seed", "k", "percent"), [(1, 4, 85), (2, 5, 80), (3, 2, 60)])
def test_components_match_brute_force(spark, seed, k, percent):
    rows = corpus(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.near_duplicates(df, k, percent).collect())
    assert found == brute(rows, k, percent)


def test_linked_sets_share_a_signature():
    rng, rule = np.random.default_rng(1), jaccard.Rule(85)
    for size in [*range(1, 60), 90, 200, 701, 3000]:
        for _ in range(6):
            common, total = size, 2 * size
            while 100 * common < 85 * total:
                total -= 1
            own = int(rng.integers(0, total - common + 1))
            pool = rng.integers(0, 1 << 63, total, dtype=np.int64).astype(np.uint64)
            x, y = np.sort(pool[: common + own]), np.sort(np.r_[pool[:common], pool[common + own :]])
            if len(x) != len(np.unique(x)) or np.array_equal(x, y):
                continue
            a, b = (dict(zip(*jaccard.signatures(s, rule), strict=True)) for s in (x, y))
            assert any(a[k] & 2 and b[k] & 1 or b[k] & 2 and a[k] & 1 for k in a.keys() & b.keys()), (size, own)
            s = jaccard.folded([jaccard.sketch(x), jaccard.sketch(y)])
            assert jaccard._near(rule, np.int64(len(x)), np.int64(len(y)), np.bitwise_count(s[0] ^ s[1]).sum())


def test_odd_tables(spark):
    df = spark.createDataFrame([(None, "a b c d e", 1), (1, "a b c d e", 2), (1, "a b c d e", 3), (2, None, 4)], "doc_id long, text string, n long")
    found = sorted(jaccard.near_duplicates(df, 4, 85).collect(), key=repr)
    assert [tuple(r) for r in found] == [(1, 2, 1), (1, 2, 1), (2, 0, 2), (None, 2, None)]
    assert jaccard.near_duplicates(df.limit(0), 4, 85).count() == 0


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (200, 150), (150, 170), (150, 200)]
    found = dict(components(spark.createDataFrame(chain, "a long, b long"), Scratch(spark, "t")).collect())
    assert found == {i: 0 for i in range(1, 41)} | {i: 100 for i in range(101, 140)} | {170: 150, 200: 150}


def test_texts_of_one_id_all_count(spark):
    a, b = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    rows = [(3, a), (3, b), (7, b), (9, b + " more"), (5, a + " more"), (11, "c d e f g")]
    for given in (rows, rows[::-1]):
        df = spark.createDataFrame(given, "doc_id long, text string").repartition(3)
        found = {(r.doc_id, r.component_id) for r in jaccard.near_duplicates(df, 4, 85).collect()}
        assert found == {(3, 3), (7, 3), (9, 3), (5, 3), (11, 11)}


def test_short_sets_meet_by_what_they_hold():
    """Sets of other elements share no signature, however many have an empty part in common."""
    rule, rng, counts = jaccard.Rule(80), np.random.default_rng(5), {}
    for n in (500, 2000):
        texts = [" ".join(map(str, rng.integers(0, 1 << 40, int(rng.integers(6, 40))))) for _ in range(n)]
        given = pa.record_batch({"doc_id": pa.array(range(n), pa.int64()), "text": pa.array(texts)})
        made = pa.Table.from_batches(list(jaccard._profile(rule, 5, 1)(iter([given])))).select(["kind", "bin", "packed"]).to_pylist()
        rows = [r for r in made if r["kind"] == 1]
        counts[n] = len(jaccard._shared(pa.table({"bin": pa.array([r["bin"] for r in rows], pa.int64()), "packed": pa.array([r["packed"] for r in rows], pa.binary())})))
    assert counts == {500: 0, 2000: 0}


def test_keys_that_are_dealt_over_salts_are_not_broadcast(spark):
    members = spark.range(50).selectExpr("id % 7 as key", "id as doc")
    joined = jaccard._with(members, members.groupBy("key").count())
    assert joined.count() == 50 and "Broadcast" not in joined._jdf.queryExecution().executedPlan().toString()
