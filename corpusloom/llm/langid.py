"""Language identification by rank-order profiles of character n-grams."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.scratch import Scratch, bound_batches, lean

#: Longest n-gram, in characters (three code points of 21 bits fill a key), and n-grams in a profile.
LONGEST, PROFILE = 3, 400
#: Characters that are counted at once, and where a text may be cut: at what is no letter.
BLOCK, _CUT = 1 << 20, re.compile(r"[\W\d_]")
UNKNOWN = "und"
_letters: np.ndarray | None = None


def letters() -> np.ndarray:
    """For each code point, whether it is a letter."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _letters


def grams(texts: list[str]) -> np.ndarray:
    """Keys of the 1- to 3-grams of words of ``texts``; a word is a run of letters, lower-cased, with a blank at each
    end; n-grams hold no blank but at an end."""
    code = np.frombuffer(f" {' '.join(texts)} ".lower().encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    code = np.where(letters()[code], code, np.uint64(32))
    blank = code == 32
    keep = ~(blank[1:] & blank[:-1])
    code, blank = code[np.r_[True, keep]], blank[np.r_[True, keep]]
    one = code[~blank]
    two = (code[:-1] << np.uint64(21)) | code[1:]
    three = ((code[:-2] << np.uint64(42)) | (code[1:-1] << np.uint64(21)) | code[2:])[~blank[1:-1]]
    return np.concatenate([one, two, three])


def blocks(text: str) -> Iterator[str]:
    """A text in parts of BLOCK characters or a little more: each ends between words, so the parts have the text's words."""
    at = 0
    while at < len(text):
        cut = _CUT.search(text, at + BLOCK)
        end = cut.end() if cut else len(text)
        yield text[at:end]
        at = end


def counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and how often each occurs."""
    keys = np.sort(keys)
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.empty(0, int)
    return keys[starts], np.diff(np.r_[starts, len(keys)])


def top(keys: np.ndarray, counts: np.ndarray, n: int) -> np.ndarray:
    """The n most frequent keys, most frequent first, ties to the smaller key."""
    return keys[np.lexsort((keys, -counts))[:n]]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def flush(lang: str, texts: list[str]) -> pa.RecordBatch:
        keys, n = counted(grams(texts))
        return pa.record_batch({"lang": pa.array([lang] * len(keys), pa.string()), "gram": pa.array(keys.astype(np.int64)), "n": pa.array(n.astype(np.int64))})

    waiting: dict[str, list[str]] = {}
    size: dict[str, int] = {}
    for batch in batches:
        for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist(), strict=True):
            for part in blocks(text):
                waiting.setdefault(lang, []).append(part)
                size[lang] = size.get(lang, 0) + len(part)
                if size[lang] >= BLOCK:
                    yield flush(lang, waiting.pop(lang))
                    size[lang] = 0
    for lang, texts in waiting.items():
        yield flush(lang, texts)


def profiles(labelled: DataFrame, size: int = PROFILE) -> DataFrame:
    """``lang, text`` to ``lang, rank, gram``: the ``size`` most frequent n-grams of each language, counted over all of
    its texts. Null texts and null languages are skipped."""
    bound_batches(labelled.sparkSession)
    counts = labelled.select("lang", "text").where("lang is not null and text is not null").mapInArrow(lean(_count), "lang string, gram bigint, n bigint")
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    return counts.groupBy("lang", "gram").agg(F.sum("n").alias("n")).withColumn("rank", F.row_number().over(order) - 1).where(F.col("rank") < size).select("lang", "rank", "gram")


class Classifier:
    """Out-of-place distances to fixed profiles."""

    def __init__(self, rows: list[tuple[str, int, int]], size: int):
        self.size, self.langs = size, sorted({r[0] for r in rows})
        self.keys = np.array(sorted({r[2] for r in rows}), np.uint64)
        self.ranks = np.full((len(self.keys) + 1, len(self.langs)), -1, np.int64)  # the last row: of n-grams of no profile
        at = {k: i for i, k in enumerate(self.keys.tolist())}
        of = {k: i for i, k in enumerate(self.langs)}
        for lang, rank, gram in rows:
            self.ranks[at[gram], of[lang]] = rank

    def predict(self, text: str | None) -> tuple[str, float]:
        """The nearest profile's language (ties: the first in code point order) and 1 - distance / largest distance."""
        if text is None or not self.langs:
            return UNKNOWN, 0.0
        parts = [counted(grams([part])) for part in blocks(text)] or [(np.empty(0, np.uint64), np.empty(0, np.int64))]
        keys, n = parts[0]
        if len(parts) > 1:
            keys, back = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            n = np.bincount(back, np.concatenate([p[1] for p in parts])).astype(np.int64)
        own = top(keys, n, self.size)
        if not len(own):
            return UNKNOWN, 0.0
        i = np.searchsorted(self.keys, own)
        i = np.where(self.keys[np.minimum(i, len(self.keys) - 1)] == own, i, len(self.keys))
        theirs = self.ranks[i]
        off = np.where(theirs < 0, self.size, np.abs(theirs - np.arange(len(own))[:, None])).sum(0)
        best = int(off.argmin())
        return self.langs[best], float(1 - off[best] / (self.size * len(own)))


def identify(documents: DataFrame, learned: DataFrame, size: int = PROFILE) -> DataFrame:
    """``doc_id, text`` with ``learned`` (of :func:`profiles`) to ``doc_id, lang_pred, score``; extra columns go along, but for ones named
    ``lang_pred`` or ``score``, in whose place the results stand.

    The profiles are collected: ``size`` rows for each language. Null texts and texts without a letter are ``und`` with
    score 0, and so is every text if nothing was learned; equal texts get equal results. Texts are read whole. Rows that
    repeat, and rows without an id, each get theirs; an empty table gives no rows.
    """
    bound_batches(documents.sparkSession)
    known = Classifier([(r.lang, r.rank, r.gram) for r in learned.collect()], size)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [known.predict(t.as_py()) for t in batch["text"]]
            kept = {k: batch[k] for k in batch.schema.names if k != "text"}
            yield pa.record_batch(kept | {"lang_pred": pa.array([x[0] for x in found], pa.string()), "score": pa.array([x[1] for x in found], pa.float64())})

    kept = [f for f in documents.schema if f.name not in ("text", "lang_pred", "score")]
    out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return documents.select(*[f"`{f.name}`" for f in kept], "text").mapInArrow(lean(predict), f"{out}, lang_pred string, score double")


def learn(documents: DataFrame, size: int = PROFILE) -> DataFrame:
    """Profiles of ``documents`` (``lang, text``), written once: what is learned is read again for each use."""
    return Scratch(documents.sparkSession, "langid").save(profiles(documents, size), "profiles")
