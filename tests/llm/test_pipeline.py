import corpus_pipeline
import public_tokenizers
from test_jaccard import brute as components_of
from test_suffix import brute as repeats_of

from corpusloom.llm import bpe

EN = "it was the best of times and it was the worst of times so they say in the old book".split()


def documents(spark):
    import random

    rng = random.Random(9)
    line = lambda n: " ".join(rng.choice(EN) + rng.choice(["", "s", "ed", "ing"]) for _ in range(n))
    passage, base = line(60), line(120)
    rows = [(i, line(rng.randint(20, 90)), "en", f"src{i % 3}", 1) for i in range(40)]
    rows += [(100, base, "en", "src0", 1), (101, base + " end", "en", "src1", 1), (102, base, "en", "src0", 1)]
    rows += [(110 + i, f"{line(30)} é{passage} {line(20)}", "en", "src2", 1) for i in range(4)]
    rows += [(120, None, "en", "src0", 0), (121, "12 34", "en", "src0", 5), (122, passage, None, None, 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def test_stages(spark, tmp_path):
    docs = documents(spark)
    columns, out = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        path = f"{tmp_path}/{name}"
        stage(spark, docs, "").write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
        out[name] = docs.collect()
        assert name == "byte_bpe" or docs.columns == columns
    first = {r.doc_id: r.text for r in out["language_id"]}
    assert 120 not in first and 121 not in first and len(first) == 48

    kept = [i for i, _, c in components_of(list(first.items()), 5, 80) if i == c]
    assert sorted(r.doc_id for r in out["near_duplicates"]) == kept and 101 not in kept and 102 not in kept

    want = {i: k.decode(errors="ignore") for i, _, _, k in repeats_of([(i, first[i]) for i in kept], 100)}
    got = {r.doc_id: r.text for r in out["suffix_dedup"]}
    assert got == {i: t for i, t in want.items() if t.split()}
    assert 122 not in got or len(got[122]) < len(first[122])
    assert all(r.n_chars == len(r.text) for r in out["suffix_dedup"] if r.text != first[r.doc_id])

    mixed = [r.doc_id for r in out["mix_sources"]]
    assert set(mixed) <= set(got) and all(1 <= mixed.count(i) <= 3 for i in set(mixed))
    encoder = bpe.load(public_tokenizers.path(corpus_pipeline.RANKS), public_tokenizers.PATTERN)
    assert sorted(r.doc_id for r in out["byte_bpe"]) == sorted(mixed)
    assert all(r.lossless and list(r.ids) == encoder.encode(got[r.doc_id]) and r.n_tokens == len(r.ids) for r in out["byte_bpe"])


def test_rows_of_one_id_keep_their_own_texts(spark):
    passage = "".join(f"ab{i}é " for i in range(60))
    rows = [(1, passage), (2, f"first \ufffd own {passage} end"), (2, f"second own text {passage}"), (2, "third, without a repeat"), (3, f"q {passage}\ufffd"), (None, passage)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted((r.doc_id or 0, r.text) for r in corpus_pipeline.suffix_dedup(spark, docs, "").collect())
    assert len(found) == 6 and (0, passage) in found and (1, passage) in found and (2, "third, without a repeat") in found
    own = [t for i, t in found if i == 2]
    assert any(t.startswith("first \ufffd own") for t in own) and any(t.startswith("second own text") for t in own)
    assert next(t for i, t in found if i == 3).endswith("\ufffd") and sum(passage in t for _, t in found) == 2


def test_a_character_goes_whole(spark):
    shared = "".join(f"x{i}é" for i in range(50))
    rows = [(1, "é" + shared + "é1"), (2, "\ufffd ü" + shared + "è2")]  # é and è, é and ü share their first byte
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.text for r in corpus_pipeline.suffix_dedup(spark, docs, "").collect()} == {1: rows[0][1], 2: "\ufffd ü2"}


def test_documents_without_any_language_stay(spark):
    rows = [(1, "some words", None), (2, None, None), (3, "12 34", None), (4, "мир", None), (5, "12", "en")]
    for given in (rows[:4], rows):
        docs = spark.createDataFrame(given, "doc_id long, text string, lang string")
        found = corpus_pipeline.language_id(spark, docs, "")
        assert found.columns == docs.columns
        assert sorted(tuple(r) for r in found.collect()) == [rows[0], rows[3]]


def test_clashing_columns_stay(spark):
    rows = [(1, "some words here", "en", 7.5, "x", "own"), (2, "more words there", None, 8.5, "y", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double, lang_pred string, row string")
    found = corpus_pipeline.language_id(spark, docs, "")
    assert found.columns == docs.columns
    assert sorted(tuple(r) for r in found.collect()) == [rows[0], (2, "more words there", "en", 8.5, "y", None)]
