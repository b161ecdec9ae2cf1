import random

import public_tokenizers
import pytest
import regex
import tiktoken

from corpusloom.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def own():
    return bpe.load(PATH, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def theirs(own):
    return tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=own.ranks, special_tokens={})


def texts():
    rng = random.Random(5)
    alphabet = ["a", "e", "th", " ", "  ", "\n", "'", "'re", "'ll", "'s", "1", "23", "!", "é", "ß", "漢", "字", "😀", " ", " ", "\t", "\x1c", "́", "\x00"]
    yield from ["", " ", "  ", "a", "'", "'r", "'re", "it's we'll  they're\n\n x", "a" * 3000, " " * 700 + "x", "ab" * 1500, "é" * 900, "x" + "'" * 333 + "re"]
    for _ in range(400):
        yield "".join(rng.choice(alphabet) for _ in range(rng.randint(1, 120)))


def test_any_split_gives_the_tokens_of_the_library(own, theirs):
    small = bpe.Encoder(own.ranks, public_tokenizers.PATTERN, text_leaf=4, match_leaf=2)
    middle = bpe.Encoder(own.ranks, public_tokenizers.PATTERN, text_leaf=37, match_leaf=9)
    for text in texts():
        expected = theirs.encode_ordinary(text)
        for encoder in (own, small, middle):
            for ids in (encoder.encode(text), encoder.by_halves(text), encoder.by_matches(text)):
                assert ids == expected, text
                assert encoder.decode(ids) == text.encode()


def test_every_character_splits_as_in_the_library(own, theirs):
    text = "".join(f"a{chr(i)}a {chr(i)}1{chr(i)} " for i in range(0x3100) if regex.match(r"\p{Cn}", chr(i)) is None)
    assert own.by_halves(text) == own.by_matches(text) == theirs.encode_ordinary(text)


def test_merge_of_long_matches(own):
    rng = random.Random(3)
    tokens = [t for t in own.ranks if t.isalpha()]
    for _ in range(30):
        data = b"".join(rng.choice(tokens) for _ in range(200))
        assert bpe.Encoder(own.ranks, public_tokenizers.PATTERN, match_leaf=8).tree(data) == own.merge(data)


def test_nulls_empty_and_repeats(spark):
    rows = [(1, None, "x"), (2, "", "y"), (None, "a b", None), (3, "a b", "z"), (3, "a b", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    found = {(r.doc_id, r.n_tokens) for r in bpe.digests(df, PATH, public_tokenizers.PATTERN).collect()}
    assert found == {(1, 0), (2, 0), (None, 2), (3, 2)}
    tokens = bpe.encode(df, PATH, public_tokenizers.PATTERN)
    assert tokens.count() == 5
    assert sorted(bytes(r.bytes) for r in bpe.decode(tokens, PATH, public_tokenizers.PATTERN).collect()) == [b"", b"", b"a b", b"a b", b"a b"]
    assert bpe.digests(df.limit(0), PATH, public_tokenizers.PATTERN).count() == 0


def test_patterns_whose_scan_looks_far_are_refused(own):
    assert not bpe.unfit(public_tokenizers.PATTERN)
    for pattern in (r"\p{L}+|\s*[\r\n]+|\s+(?!\S)|\s+", r"(?<=a)\p{L}+|.", r"\s++$x|\S+", r"[a-z ]+|."):
        with pytest.raises(ValueError, match="window"):
            bpe.Encoder(own.ranks, pattern)


def test_few_bytes_merge_as_many_do(own, monkeypatch):
    rng = random.Random(4)
    few = [bytes(rng.choice(b"aeinrst \xc3\xa9") for _ in range(rng.randint(1, 32))) for _ in range(2000)]
    expected = [own.merge_few(x) for x in few]
    monkeypatch.setattr(bpe, "MATCH_LEAF", 0)  # so that all go through the heap
    assert [own.merge(x) for x in few] == expected


def test_null_ids_and_null_documents(spark):
    rows = spark.createDataFrame([(None, None), (1, []), (2, [64])], "doc_id long, ids array<int>")
    found = bpe.decode(rows, PATH, public_tokenizers.PATTERN).collect()
    assert sorted((r.doc_id or 0, len(r.bytes)) for r in found) == [(0, 0), (1, 0), (2, 1)]
    checked = bpe.checked(spark.createDataFrame([(None, None), (1, "a b")], "doc_id long, text string"), PATH, public_tokenizers.PATTERN)
    assert sorted((r.doc_id or 0, r.n_tokens, r.lossless) for r in checked.collect()) == [(0, 0, True), (1, 2, True)]
