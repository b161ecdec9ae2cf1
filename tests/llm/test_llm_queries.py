"""The registered queries of the subpackage that SQL can express, against it on the smallest tables."""

import hashlib
import math
import os

import duckdb
import pytest

from corpusloom.llm import queries

DATA = "/root/testdata/sf0.001"


def plain(v):
    return float(f"{v:.9g}") if isinstance(v, float) and not math.isnan(v) else v


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables")
@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark"):
        con.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    df = queries.QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    expected = con.sql(queries.ORACLE[name])
    assert sorted(expected.columns) == columns
    rows = expected.select(*[f'"{c}"' for c in columns]).fetchall()
    found = df.select(*columns).collect()
    assert sorted(([plain(v) for v in r] for r in found), key=repr) == sorted(([plain(v) for v in r] for r in rows), key=repr)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables")
def test_held_out_rows_are_those_of_the_checksum(spark):
    import zlib

    for name, n, remainder in (("op9_toxicity", 3, 1), ("op10_language_id", 4, 2)):
        for r in queries.QUERIES[name](spark, DATA).select("doc_id", "held_out").collect():
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % n == remainder)


def test_licence_sql_on_wrapped_and_embedded_notices(spark, tmp_path):
    """The SQL finds runs of words too, not only lines and whole texts."""
    mit = queries.licences.TEMPLATES["MIT"][2]
    words = mit.split()
    texts = [
        "a b c\n" + " ".join(words[:20]) + "\n" + " ".join(words[20:]) + "\nmore words here", "x " + mit + " y " + mit, "\n".join(words), mit, "", None,
        queries.licences.TEMPLATES["Apache-2.0"][0] + "\n" + "zz " * 30 + "Licensed under the MIT License. and so on " + "q " * 50,
    ]
    rows = spark.createDataFrame([(i // 2, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rows.write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    found = queries.op6_licence_scan(spark, str(tmp_path)).collect()
    expected = con.sql(queries.ORACLE["op6_licence_scan"]).fetchall()
    assert sum(r.licence is not None for r in found) == 5
    assert sorted(([plain(v) for v in r] for r in found), key=repr) == sorted(([plain(v) for v in r] for r in expected), key=repr)


def planted(spark, tmp_path, rows):
    """A folder with a table of documents."""
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    return str(tmp_path)


PASSAGE = "this passage of more than fifty bytes stands in several documents, é and ß included; "
DOCUMENTS = [
    (5, "Some words first. " + PASSAGE + "And an end.", "en", "a", 1), (1, PASSAGE * 2, "en", "a", 1), (9, "Other words, " + PASSAGE[:60] + " cut", None, None, 1),
    (2, None, "en", "b", 0), (3, "", "en", "b", 0), (7, "wörter und zahlen 12345 \u00a0 \n\n  'll " * 300, "de", "b", 1), (8, "x" * 9000, "en", "c", 1), (10, "Some words first. " + PASSAGE, "en", None, 1),
]


def test_bpe_digests_are_those_of_the_library(spark, tmp_path):
    import public_tokenizers
    import tiktoken

    from corpusloom.llm import bpe

    own = bpe.load(public_tokenizers.path(queries.RANKS), public_tokenizers.PATTERN)
    theirs = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=own.ranks, special_tokens={})
    found = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in queries.op2_byte_bpe(spark, planted(spark, tmp_path, DOCUMENTS)).collect()}
    sha = lambda b: hashlib.sha256(b).hexdigest()
    for i, text, *_ in DOCUMENTS:
        ids = theirs.encode_ordinary(text or "")
        assert found[i] == (len(ids), sha(",".join(map(str, ids)).encode()), sha((text or "").encode()))


def test_removed_bytes_are_those_of_brute_force(spark, tmp_path):
    seen, expected = set(), {}
    for i, text, *_ in sorted(DOCUMENTS, key=lambda r: r[0]):
        data = (text or "").encode()
        strings = [data[k : k + 50] for k in range(len(data) - 49)]
        gone = [any(strings[k] in seen for k in range(max(0, p - 49), min(p, len(strings) - 1) + 1)) for p in range(len(data))]
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        expected[i] = (len(data), sum(gone), sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone)), hashlib.sha256(kept).hexdigest())
        seen.update(strings)
    found = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in queries.op3_suffix_dedup(spark, planted(spark, tmp_path, DOCUMENTS)).collect()}
    assert found == expected and sum(e[1] > 0 for e in expected.values()) >= 3


def test_the_pipeline_runs_as_a_whole(spark, tmp_path):
    import corpus_pipeline

    found = corpus_pipeline.run(spark, planted(spark, tmp_path / "some", DOCUMENTS)).collect()
    assert {r.doc_id for r in found} <= {1, 5, 7, 8, 9, 10} and all(r.lossless and len(r.ids) == r.n_tokens > 0 for r in found) and len(found) >= 4
    assert corpus_pipeline.run(spark, planted(spark, tmp_path / "none", [])).count() == 0
