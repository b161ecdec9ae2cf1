"""Operators that work row by row or by sums: shards, licences, mixing, toxicity, language ID."""

import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import bpe, langid, licences, materialise, mixing, toxicity

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PINNED = [0, 4, 2, 5, 6, 1, 7, 3], [281036, 731005, 425186]
EN = "the quick brown fox jumps over the lazy dog and then the dog barks at the other foxes with what they had".split()
DE = "der schnelle braune fuchs springt über den faulen hund und dann bellt der hund die anderen füchse nicht an".split()


def prose(rng, words, n):
    return " ".join(rng.choice(words) for _ in range(n))


# Shards in training order.


@pytest.mark.parametrize("n", [1, 2, 3, 5, 64, 1000, 4097])
def test_slots_are_a_permutation(n):
    slots = materialise.permute(np.arange(n), n, 7)
    assert sorted(slots.tolist()) == list(range(n))
    assert n < 64 or slots.tolist() != materialise.permute(np.arange(n), n, 8).tolist()


def test_shards_hold_every_sequence(spark, tmp_path):
    rng = random.Random(1)
    rows = [(i, prose(rng, EN, rng.randint(1, 60)), i) for i in range(60)] + [(7, "again and again", 0), (None, "no id", 0), (90, None, 0), (91, "", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, slot int").repartition(3)
    uri = f"file://{tmp_path}/shards"
    index = materialise.materialise(df, PATH, public_tokenizers.PATTERN, uri, length=16, per_shard=32, waves=3).collect()
    assert sorted(r.slot for r in index) == list(range(len(index)))
    read = list(materialise.read(uri, 0, 10_000, 16, 32))
    assert len(read) == len(index)
    encoder, parts = bpe.load(PATH, public_tokenizers.PATTERN), {}
    for r in index:
        assert (r.shard, r.offset) == (materialise.name(r.slot // 32), r.slot % 32 * 32)
        assert set(read[r.slot][r.n_tokens :].tolist()) <= {50256}
        parts.setdefault(r.doc_id, []).append((r.seq_no, read[r.slot][: r.n_tokens].tolist()))
    for i, text, _ in rows[:60]:
        if i != 7:
            assert sum((t for _, t in sorted(parts[i])), []) == [*encoder.encode(text), 50256]
    assert 90 not in parts and 91 not in parts and None in parts
    assert [x.tolist() for x in materialise.read(uri, 40, 5, 16, 32)] == [x.tolist() for x in read[40:45]]
    assert materialise.materialise(df.limit(0), PATH, public_tokenizers.PATTERN).count() == 0
    for end in (0, 1 << 16):
        with pytest.raises(ValueError):
            materialise.materialise(df, PATH, public_tokenizers.PATTERN, end=end)


def test_slots_come_from_key_and_corpus_alone(spark, monkeypatch):
    monkeypatch.setattr(materialise, "RANGE_BYTES", 1 << 10)
    rng = random.Random(4)
    rows = [(i, prose(rng, EN, rng.randint(1, 50))) for i in range(80)] + [(None, prose(rng, DE, 30 + i)) for i in range(40)] + [(7, "one more text of this id")] + [(9, "twice the same")] * 2
    rows += [(500, prose(rng, EN, 20_000))]
    shuffled = rows[:]
    rng.shuffle(shuffled)
    layouts = (spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), spark.createDataFrame(shuffled, "doc_id long, text string").repartition(7))
    found = [sorted((r.slot, r.doc_id or -1, r.seq_no, r.n_tokens) for r in materialise.materialise(x, PATH, public_tokenizers.PATTERN, length=16, per_shard=32).collect()) for x in layouts]
    assert found[0] == found[1] and [r[0] for r in found[0]] == list(range(len(found[0])))


def test_slots_are_pinned():
    """Slots of a key never change: shards that were written stay readable by arithmetic."""
    assert materialise.permute(np.arange(8), 8, 1).tolist() == PINNED[0]
    assert materialise.permute(np.array([0, 1, 999_999]), 1_000_000, 42).tolist() == PINNED[1]


# Licences.


def test_licences(spark):
    rows = [
        (1, "Some prose.\nReleased under the MIT License.\nMore prose here and there."), (2, "released UNDER the mit -- license"), (3, "Licensed under CC BY-NC 4.0.\nLicensed under CC BY-NC 4.0."),
        (4, "the mit license"), (5, None), (6, ""), (7, "word " * 3000 + "\n" + licences.TEMPLATES["MIT"][2]), (7, "Licensed under the Apache License, Version 2.0."), (None, "Licensed under the Apache License, Version 3.0."),
    ]
    found = {(r.doc_id, r.licence, r.line_no, r.n_notices) for r in licences.scan(spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, dice int")).collect()}
    assert found == {(1, "MIT", 2, 1), (2, "MIT", 0, 1), (3, "CC-BY-NC-4.0", 1, 2), (4, None, None, 0), (5, None, None, 0), (6, None, None, 0), (7, "MIT", 2, 1), (7, "Apache-2.0", 0, 1), (None, None, None, 0)}
    assert licences.scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_wrapped_and_embedded_licences(spark):
    import textwrap

    both = [(k, t) for m in (licences.TEMPLATES, licences.PASSAGES) for k, texts in m.items() for t in texts]
    prose_ = " ".join(f"word{i}" for i in range(300))
    rows, want = [], {}
    for k, t in both:
        for form in (prose_ + "\n" + "\n".join("# " + x for x in textwrap.wrap(t, 40)) + "\n" + prose_, f"{prose_} {t} {prose_}"):
            want[len(rows)] = (k, 2 if "\n" in form else 1, 1)
            rows.append((len(rows), form))
    two = "\n".join(textwrap.wrap(licences.TEMPLATES["ISC"][0], 60))
    for text, found in (
        ("Copyright X. Licensed under the MIT License. See the file.", ("MIT", 1, 1)),
        (f"{prose_}\n{two}\n{prose_}\n{two}\n{prose_}", ("ISC", 2, 2)),
        (f"{prose_}\nReleased under the MIT License.\n{two}\n{prose_}", ("MIT", 2, 2)),
        (f"{prose_} of the software and to permit persons. In the License and use of the work, the terms of it. {prose_}", (None, None, 0)),
    ):
        want[len(rows)] = found
        rows.append((len(rows), text))
    found = {r.doc_id: (r.licence, r.line_no, r.n_notices) for r in licences.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == want


# Mixing.


def resharing(sizes, weights, cap):
    """Targets by rounds: shares of what is left by weight, until none is above its cap."""
    total, order = sum(sizes.values()), sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, left, open_ = {}, float(total), set(order)
    while open_:
        share = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if weight[s] * share > cap * sizes[s]}
        if not over:
            return target | {s: weight[s] * share for s in open_}
        for s in over:
            target[s] = float(cap * sizes[s])
            left -= target[s]
        open_ -= over
    return target


def test_mix(spark):
    rng = random.Random(2)
    names = ["b", "a", "é", "Z", None, "c", "only"]
    rows = [(i, rng.choice(names[:6] + ["b"] * 6), prose(rng, EN, rng.randint(0, 80))) for i in range(800)] + [(900, "only", "x y"), (901, "only", None), (902, "none", None), (903, "none", " \t "), (904, "b", "w " * 3000)]
    df = spark.createDataFrame([(*r, 5) for r in rows], "doc_id long, source string, text string, size int").repartition(4)
    found = [r.asDict() for r in mixing.mix(df).collect()]
    sizes = {}
    for _, s, t in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want = resharing(sizes, (5, 2, 1), 3)
    assert len(found) == len(rows)
    for s in sizes:
        own = [r for r in found if r["source"] == s]
        assert all(r["source_size"] == sizes[s] and abs(r["target"] - want[s]) < 1e-6 for r in own)
        assert abs(sum(r["taken"] for r in own) - want[s]) <= max(r["size"] for r in own) / 2 + 1e-6
        assert all(r["taken"] % r["size"] == 0 and r["taken"] <= 3 * r["size"] if r["size"] else r["taken"] == 0 for r in own)
    assert sorted(map(repr, found)) == sorted(repr(r.asDict()) for r in mixing.mix(df.repartition(2)).collect())
    copies = mixing.mixed(df).groupBy("doc_id").count().collect()
    assert {r.doc_id: r["count"] for r in copies} == {r["doc_id"]: r["taken"] // r["size"] for r in found if r["taken"]}
    assert mixing.mix(df.limit(0)).count() == mixing.mixed(df.limit(0)).count() == 0


# Toxicity.


def test_toxicity(spark):
    rng = random.Random(3)
    bad, groups = ["vilest", "vileness", "scumbag", "scumbags"], ["women", "muslims", "refugees"]
    rows = []
    for i in range(900):
        own = [rng.choice(EN) for _ in range(rng.randint(5, 60))]
        toxic = i % 4 == 0
        if toxic:
            own.insert(rng.randrange(len(own)), rng.choice(bad))
        if rng.random() < (0.6 if toxic else 0.02):  # mentions go along with insults, but aren't one
            own.append(groups[0])
        rows.append((i, " ".join(own), int(toxic)))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows if r[0] % 3] + [(None, 1), (5, None), (8, 7)], "doc_id long, label int")
    model, free = (toxicity.learn(docs, labels, toxicity.Settings(swap=w)) for w in (5.0, 0.0))
    clashing = docs.withColumn("score", F.lit("x")).withColumn("label", F.lit(1)).withColumn("words", F.lit("y"))
    found = toxicity.score(clashing.union(clashing.where("doc_id = 7")), model)
    assert found.columns == ["doc_id", "label", "words", "score"] and found.where("doc_id = 7").count() == 2
    got = {r.doc_id: r.score for r in found.collect()}
    held = [(got[i], t) for i, _, t in rows if i % 3 == 0]
    assert sum((s >= 0.7) == bool(t) for s, t in held) >= 0.95 * len(held)
    neutral = "the women and the dog"
    assert model.scorer()(neutral) < free.scorer()(neutral)
    assert all(model.scorer()(f"the {g} and the dog") < 0.7 for group in toxicity.IDENTITIES for g in group)
    assert model.scorer()(None) == model.scorer()("") and 0 <= model.scorer()("") <= 1
    assert toxicity.score(docs.limit(0), model).count() == 0
    none = toxicity.learn(docs, labels.where("label = 0"))
    assert {r.score < 0.01 for r in toxicity.score(docs, none).collect()} == {True}


def sparse(lists, width):
    return toxicity.Sparse(np.cumsum([0, *map(len, lists)]), np.array([c for x in lists for c in x], np.int32), width)


def test_gradient_is_that_of_the_loss():
    rng = np.random.default_rng(5)
    own = [sorted(rng.choice(8, rng.integers(0, 5), replace=False).tolist()) for _ in range(30)]
    other = [sorted(rng.choice(8, 3, replace=False).tolist()) for _ in range(10)]
    labels, cost, settings = (rng.random(30) < 0.4).astype(float), rng.random(30), toxicity.Settings(swap=0.7, l2=0.3)
    dense = lambda lists: np.array([[float(c in x) for c in range(8)] for x in lists])

    def loss(at):
        w, c = at[:-1], at[-1]
        p = 1 / (1 + np.exp(-(dense(own) @ w + c)))
        change = (dense(own[:10]) - dense(other)) @ w
        return -(cost * (labels * np.log(p) + (1 - labels) * np.log(1 - p))).sum() + 0.15 * (w * w).sum() + 0.7 * (change * change).mean()

    at = rng.normal(size=9)
    slope = [(loss(at + e) - loss(at - e)) / 2e-6 for e in np.eye(9) * 1e-6]
    got = toxicity.gradient(at[:-1], at[-1], labels, cost, sparse(own, 8), sparse(own[:10], 8), sparse(other, 8), settings)
    assert np.allclose(got, slope, atol=1e-6)


def slow_toxicity(texts, labels, settings):
    """Scores of all texts by a dense fit, with features counted one by one."""
    import math
    import re

    def grams(words):
        return {f for w in words for f in [w] + [w[:n] + "*" for n in (4, 5, 6) if len(w) > n]}

    words = {i: set(re.findall(r"\w+", (t or "").lower())) for i, t in texts.items()}
    share, far = sum(labels.values()) / len(labels), {}
    for f in sorted(set().union(*(grams(words[i]) for i in labels))):
        has = [y for i, y in labels.items() if f in grams(words[i])]
        if sum(has) >= settings.least:
            far[f] = abs(sum(has) - share * len(has)) / math.sqrt(share * (1 - share) * len(has) + 1e-9)
    kept = sorted((f for f in far if far[f] > 4), key=lambda f: (far[f], f), reverse=True)[: settings.features]
    known = sorted({*kept, *(t for g in settings.identities for t in g)})
    place = {f: i for i, f in enumerate(known)}
    swap = {t: g[(i + 1 + len(g) // 3) % len(g)] for g in settings.identities for i, t in enumerate(g)}

    def row(words):
        out = np.zeros(len(known) + 1)
        out[[place[f] for f in grams(words) if f in place]] = 1
        out[-1] = 1
        return out

    rows = {i: row(w) for i, w in words.items()}
    x, y = np.array([rows[i] for i in sorted(labels)]), np.array([float(labels[i]) for i in sorted(labels)])
    change = [rows[i] - row({swap.get(w, w) for w in words[i]}) for i in labels if words[i] & set(swap)]
    cost = np.where(y == 1, math.sqrt((1 - share) / share), 1.0)
    cost, w = cost / cost.sum(), np.r_[np.zeros(len(known)), math.log(share / (1 - share))]
    m = v = np.zeros(len(w))
    for step in range(1, settings.steps + 1):
        g = x.T @ (cost * (1 / (1 + np.exp(-x @ w)) - y)) + settings.l2 * np.r_[w[:-1], 0]
        for d in change:
            g = g + 2 * settings.swap / len(change) * d * (d @ w)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w = w - 0.1 * (1 - step / (settings.steps + 1)) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
    return {i: 1 / (1 + math.exp(-(r @ w))) for i, r in rows.items()}


def test_toxicity_against_brute_force(spark):
    rng = random.Random(6)
    rows = [(i, prose(rng, EN, rng.randint(3, 30)) + (" Vilest scumbags" if i % 3 == 0 else "") + rng.choice(["", "", " women", " blind men"])) for i in range(240)]
    rows += [(300, None), (301, ""), (302, "scumbag " * 20_000 + "ünïcode"), (303, "scumbags")]
    labels = {i: int(i % 3 == 0) for i in range(0, 240, 2)} | {300: 0, 301: 1}
    settings = toxicity.Settings(steps=40)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    given = spark.createDataFrame([*labels.items(), (2, None), (999, 1)], "doc_id long, label int")
    found = {r.doc_id: r.score for r in toxicity.score(docs, toxicity.learn(docs, given, settings)).collect()}
    want = slow_toxicity(dict(rows), labels, settings)
    assert found.keys() == want.keys() and all(abs(found[i] - want[i]) < 1e-6 for i in want)


def test_rare_toxic_features_are_compared_whatever_their_number(spark):
    common = " ".join("".join(chr(97 + i // 26**k % 26) for k in (3, 2, 1, 0)) + "xyz" for i in range(36_000))  # four features each
    rows = [(i, common if i < 4 or 7 <= i < 15 else "a dog", int(i < 7)) for i in range(100)]
    rows = [(i, t + " scumbag" if i in (4, 5, 6) else t, label) for i, t, label in rows]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, label int")
    model = toxicity.learn(docs, labels)
    assert "scumbag" in model.vocabulary and "aaaaxyz" not in model.vocabulary


# Language ID.


def slow_profile(texts, size):
    from collections import Counter

    n = Counter()
    for t in texts:
        words = "".join(c if c.isalpha() else " " for c in t.lower()).split()
        for w in words:
            n.update(w)
            n.update(f" {w} "[i : i + 2] for i in range(len(w) + 1))
            n.update(f" {w} "[i : i + 3] for i in range(len(w)))
    key = lambda g: int.from_bytes(b"".join(ord(c).to_bytes(4, "big") for c in g), "big")
    pack = lambda g: sum(ord(c) << 21 * (len(g) - 1 - i) for i, c in enumerate(g))
    assert key("a")
    return [pack(g) for g, _ in sorted(n.items(), key=lambda x: (-x[1], pack(x[0])))[:size]]


def test_language_id(spark):
    rng = random.Random(4)
    rows = [(i, prose(rng, DE if i % 3 else EN, rng.randint(3, 60)), "de" if i % 3 else "en") for i in range(120)]
    rows += [(200, None, "en"), (201, "", "en"), (202, "123 !!", "de"), (203, "der hund und die füchse", None), (None, "the dog", "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    learned = langid.learn(df, 50)
    texts = {k: [t for _, t, g in rows if g == k and t] for k in ("en", "de")}
    want = {k: slow_profile(v, 50) for k, v in texts.items()}
    have = {k: [r.gram for r in learned.where(learned.lang == k).orderBy("rank").collect()] for k in want}
    assert have == want
    found = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(df, learned, 50).collect()}
    for i, text, lang in rows:
        own = slow_profile([text or ""], 50)
        if not own:
            assert found[i] == ("und", 0.0)
            continue
        off = {k: sum(abs(r - want[k].index(g)) if g in want[k] else 50 for r, g in enumerate(own)) for k in want}
        best = min(off, key=lambda k: (off[k], k))
        assert found[i][0] == best and abs(found[i][1] - (1 - off[best] / (50 * len(own)))) < 1e-12
    assert sum(found[i][0] == g for i, _, g in rows[:120]) >= 115
    clashing = df.withColumns({c: F.lit("x") for c in ("lang_pred", "score", "gram", "rank", "h")})
    again = langid.identify(clashing, learned, 50)
    assert {(r.doc_id, r.lang_pred, r.score) for r in again.collect()} == {(i, *f) for i, f in found.items()}
    assert {r.rank for r in again.collect()} == {"x"}
    assert langid.identify(df.limit(0), learned).count() == 0
    assert {r.lang_pred for r in langid.identify(df, learned.limit(0)).collect()} == {"und"}


def test_blocks_of_long_texts_end_between_words(monkeypatch):
    rng = random.Random(8)
    text = "".join(rng.choice(["wort", "straße", "x", "été", " ", ", ", "7", "_", "'", "漢字", "。", "\n"]) for _ in range(900)) + "z" * 400 + " end"
    keys, n = langid.counted(langid.grams([text]))
    for size in (1, 7, 64, 10_000):
        monkeypatch.setattr(langid, "BLOCK", size)
        parts = list(langid.blocks(text))
        assert "".join(parts) == text and (size > len(text) or len(parts) > 1)
        found, m = langid.counted(np.concatenate([langid.grams([p]) for p in parts]))
        assert found.tolist() == keys.tolist() and m.tolist() == n.tolist()


def test_clashing_columns_give_way_to_the_results(spark):
    rows = [(1, prose(random.Random(1), EN, 30), "en", "old", 7.0), (2, prose(random.Random(2), DE, 30), "de", "old", 7.0), (2, prose(random.Random(2), DE, 30), "de", "old", 7.0), (None, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred string, score double")
    found = langid.identify(docs, langid.learn(docs))
    assert sorted(found.columns) == ["doc_id", "lang", "lang_pred", "score"]
    assert sorted((r.doc_id or 0, r.lang_pred) for r in found.collect()) == [(0, "und"), (1, "en"), (2, "de"), (2, "de")]
    assert langid.identify(docs.limit(0), langid.learn(docs)).count() == 0
