"""A corpus pipeline over the operators of ``corpusloom.llm``: from documents to token ids.

Each stage is written as Parquet and read again, so that a lost executor costs no more than a stage's tasks. All stages
but the last return the columns of their input.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import bpe, jaccard, langid, mixing, suffix
from corpusloom.llm.scratch import Scratch

RANKS = "byte_bpe_multi_50k.tiktoken"
#: Words of a shingle and percent of similarity of near duplicates.
SHINGLE, SIMILAR = 5, 80
#: Bytes from which a repeat is removed: 50 words and the white space between them have no fewer.
REPEAT = 100


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents whose language can't be told: null texts and texts without a letter. A null ``lang`` becomes
    the prediction, and stays null where no document states a language; stated languages stay."""
    learned = langid.learn(docs)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")  # apart from what the operator adds
    found = langid.identify(docs.select(row, "text"), learned)
    if learned.limit(1).count():
        found = found.where(F.col("lang_pred") != langid.UNKNOWN)
    else:  # no document states a language, so none is told from another
        letter = F.regexp_like("row.text", F.lit(r"\p{L}"))
        found = found.where(letter).withColumn("lang_pred", F.lit(None).cast("string"))
    columns = {c: F.col(f"row.`{c}`") for c in docs.columns}
    if "lang" in columns:
        columns["lang"] = F.coalesce("row.lang", "lang_pred")
    return found.select(*[c.alias(k) for k, c in columns.items()])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document of the smallest id stays. Rows without an id, and documents without
    a word, are in no group."""
    found = jaccard.near_duplicates(docs, SHINGLE, SIMILAR)
    others = found.where("component_id <> doc_id").select("doc_id").distinct()
    return docs.join(others, "doc_id", "left_anti").select(*docs.columns)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes from each text what repeats from a document of a smaller id. A character of which a byte goes, goes;
    documents of which nothing but white space is left go, and so do those that had no word before. Rows of one id keep
    their own texts and don't take from each other; other columns stay, but ``n_chars`` of a cut text is counted
    anew."""
    found = suffix.without_repeats(docs, REPEAT, characters=True, rest=True)
    text = F.col("kept").cast("string")
    cut = F.size("removed") > 0
    columns = {c: F.col(f"rest.`{c}`") for c in docs.columns} | {
        "doc_id": F.col("doc_id").cast(docs.schema["doc_id"].dataType),
        "text": F.when(F.col("n_bytes") > 0, text),
    }
    if "n_chars" in columns:
        columns["n_chars"] = F.when(cut, F.length(text).cast(docs.schema["n_chars"].dataType)).otherwise(columns["n_chars"])
    return found.where(F.regexp_like(text, F.lit(mixing.WORD))).select(*[c.alias(k) for k, c in columns.items()])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mix takes it, which is none for one without a word. Null sources are one source
    and null ids one id; rows that repeat an id are taken alike; an empty table gives no rows."""
    return mixing.mixed(docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids, lossless`` of each row, null ids and repeated rows included; a null text has no token.
    Other columns go, whatever they are named; an empty table gives no rows."""
    return bpe.checked(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("suffix_dedup", suffix_dedup),
    ("mix_sources", mix_sources),
    ("byte_bpe", byte_bpe),
]

#: SQL can express neither rank-order profiles nor BPE; tests/llm/test_pipeline.py has brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``; each is written to the shared folder and read again."""
    scratch, docs = Scratch(spark, "pipeline"), spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = scratch.save(stage(spark, docs, sf_dir), f"{i}_{name}")
        if i > 1:
            scratch.drop(f"{i - 1}_{STAGES[i - 1][0]}")
    return docs
