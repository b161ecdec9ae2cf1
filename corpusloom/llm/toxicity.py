"""Toxicity by a counterfactually regularised linear classifier.

A logistic regression over the distinct words of a text and their first letters. Besides the labels it learns from
counterfactuals: in each labelled text that mentions a group, identity terms are swapped for others, and the squared
change of the logit is penalised. So a mention of a group as such adds little to a score.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.scratch import FILTER_BITS, Scratch, bound_batches, id_filter, lean

# Terms for groups of people, by kind. A term is swapped for another of its kind.
IDENTITIES = (
    ("women", "men", "girls", "boys", "woman", "man", "frauen", "männer", "femmes", "hommes", "mujeres", "hombres", "transgender", "nonbinary"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "muslims", "christians", "jews", "hindus", "buddhists", "atheists", "muslime", "christen", "juden", "musulmans", "chrétiens", "juifs", "musulmanes", "cristianos", "judíos"),
    ("black", "white", "asian", "latino", "arab", "african", "european", "american", "schwarze", "weiße", "asiaten", "noirs", "blancs", "asiatiques", "negros", "blancos", "asiáticos"),
    ("gay", "lesbian", "straight", "bisexual", "heterosexual", "homosexual", "queer", "schwul", "lesbisch", "lesbienne", "gays", "lesbians"),
    ("immigrant", "immigrants", "refugee", "refugees", "foreigner", "foreigners", "migranten", "flüchtlinge", "ausländer", "immigrés", "réfugiés", "étrangers", "inmigrantes", "refugiados", "extranjeros"),
    ("old", "young", "elderly", "disabled", "blind", "deaf", "poor", "rich"),
)

WORDS = re.compile(r"\w+").findall
#: Words that a worker remembers.
REMEMBERED = 400_000


@dataclass(frozen=True)
class Settings:
    """``rows``: most labelled rows the weights are fitted on, chosen by a hash of their ids (all counts cover every
    labelled row, and every feature of at least ``least`` toxic rows); ``features``: most features that get a weight;
    ``swap``: weight of the counterfactual penalty; ``l2``: of the squared weights."""

    rows: int = 20_000
    features: int = 1 << 13
    least: int = 3
    swap: float = 0.1
    l2: float = 2e-4
    steps: int = 300
    identities: Sequence[Sequence[str]] = field(default=IDENTITIES)


def words(text: str | None) -> set[str]:
    return set(WORDS((text or "").lower()))


def features(word: str) -> list[str]:
    """The word, and its first 4, 5 and 6 letters if there are more, marked."""
    return [word, *(f"{word[:n]}*" for n in (4, 5, 6) if len(word) > n)]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Features of the rows, each once a row, to how many rows of each label have them."""
    counts: tuple[Counter[str], Counter[str]] = Counter(), Counter()

    def flush() -> pa.RecordBatch:
        clean, toxic = counts
        own = list(clean.keys() | toxic.keys())
        return pa.record_batch({"feature": pa.array(own, pa.string()), "clean": pa.array([clean[f] for f in own], pa.int64()), "toxic": pa.array([toxic[f] for f in own], pa.int64())})

    for batch in batches:
        for own, label in zip(batch["words"].to_pylist(), batch["label"].to_pylist(), strict=True):
            counts[label].update({f for w in own.split() for f in features(w)})
            if len(counts[0]) + len(counts[1]) >= REMEMBERED:
                yield flush()
                counts[0].clear()
                counts[1].clear()
    yield flush()


class Extractor:
    """Texts to the places of known features."""

    def __init__(self, vocabulary: Sequence[str]):
        self.place = {f: i for i, f in enumerate(vocabulary)}
        self.known: dict[str, tuple[int, ...]] = {}

    def __call__(self, own: set[str]) -> set[int]:
        known, found = self.known, set()
        for w in own:
            at = known.get(w)
            if at is None:
                at = tuple(self.place[f] for f in features(w) if f in self.place)
                if len(known) >= REMEMBERED:
                    known.clear()
                known[w] = at
            if at:
                found.update(at)
        return found


def _sampled(vocabulary: list[str], identities: Sequence[Sequence[str]]):
    """Rows to places of features, and the same after the swap of identity terms (null if there are none)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        extract, other = Extractor(vocabulary), {}
        for group in identities:
            other |= {t: group[(i + 1 + len(group) // 3) % len(group)] for i, t in enumerate(group)}
        for batch in batches:
            at, swapped = [], []
            for own in batch["words"].to_pylist():
                own = own.split()
                at.append(sorted(extract(own)))
                changed = [other.get(w, w) for w in own]
                swapped.append(sorted(extract(changed)) if changed != own else None)
            kind = pa.list_(pa.int32())
            yield pa.record_batch({"doc_id": batch["doc_id"], "label": batch["label"], "at": pa.array(at, kind), "swapped": pa.array(swapped, kind)})

    return run


class Sparse:
    """Rows of places, in Arrow's layout: where each row begins, and all places."""

    def __init__(self, begin: np.ndarray, col: np.ndarray, width: int):
        self.n, self.width, self.col = len(begin) - 1, width, col.astype(np.int32)
        self.row = np.repeat(np.arange(self.n, dtype=np.int32), np.diff(begin))

    @classmethod
    def of(cls, lists: pa.ListArray, width: int) -> Sparse:
        return cls(np.asarray(lists.offsets) - lists.offsets[0].as_py(), lists.flatten().to_numpy(), width)

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, w[self.col], self.n)

    def back(self, g: np.ndarray) -> np.ndarray:
        return np.bincount(self.col, g[self.row], self.width)


def gradient(w: np.ndarray, c: float, labels: np.ndarray, cost: np.ndarray, x: Sparse, a: Sparse, b: Sparse, settings: Settings) -> np.ndarray:
    """Of the loss by the weights and the intercept: log loss of the rows, each of its cost; half of ``l2`` times the
    squared weights; ``swap`` times the mean squared change of the logit from ``a`` to ``b``."""
    off = cost * (1 / (1 + np.exp(-(x.dot(w) + c))) - labels)
    grad = x.back(off) + settings.l2 * w
    if a.n:
        change = 2 * settings.swap / a.n * (a.dot(w) - b.dot(w))
        grad += a.back(change) - b.back(change)
    return np.r_[grad, off.sum()]


def fit(labels: np.ndarray, x: Sparse, a: Sparse, b: Sparse, settings: Settings) -> tuple[np.ndarray, float]:
    """Weights and intercept: mean log loss, classes weighted by the root of their odds, plus the penalties (Adam). ``a``
    has the rows that mention a group, ``b`` the same after the swap."""
    width, toxic = x.width, max(1e-9, labels.mean())
    cost = np.where(labels == 1, np.sqrt((1 - toxic) / toxic), 1.0)
    cost /= cost.sum()
    w, c, m, v = np.zeros(width), float(np.log(toxic / max(1e-9, 1 - toxic))), np.zeros(width + 1), np.zeros(width + 1)
    for step in range(1, settings.steps + 1):
        g = gradient(w, c, labels, cost, x, a, b, settings)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        move = 0.1 * (1 - step / (settings.steps + 1)) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
        w, c = w - move[:-1], c - move[-1]
    return w, c


@dataclass(frozen=True)
class Model:
    vocabulary: list[str]
    weights: np.ndarray
    intercept: float

    def scorer(self):
        extract, w, c = Extractor(self.vocabulary), self.weights.tolist(), self.intercept

        def score(text: str | None) -> float:
            z = c + sum(map(w.__getitem__, sorted(extract(words(text)))))
            return float(1 / (1 + np.exp(-max(-700.0, min(700.0, z)))))

        return score


def learn(documents: DataFrame, labels: DataFrame, settings: Settings | None = None) -> Model:
    """``doc_id, text`` and ``doc_id, label`` (0 or 1) to a model.

    Rows of null id, null label or other labels are skipped; of several labels of a document the largest counts. The
    texts of labelled documents are reduced to their words before they are joined; their ids are first tested against a
    filter of fixed size. To the driver come at most ``settings.features`` features and ``settings.rows`` rows of
    places. Without a toxic label every score is 0 but for rounding.
    """
    spark, settings = documents.sparkSession, settings or Settings()
    bound_batches(spark)
    scratch = Scratch(spark, "toxicity")
    known = scratch.save(labels.where("doc_id is not null and label in (0, 1)").groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max("label").cast("int").alias("label")), "labels")
    bits = id_filter(known.select("doc_id"))

    def reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some = batch.take(pa.array(np.flatnonzero(bits[batch["h"].to_numpy(zero_copy_only=False)])))
            yield pa.record_batch({"doc_id": some["doc_id"].cast(pa.int64()), "words": pa.array([" ".join(sorted(words(t.as_py()))) for t in some["text"]], pa.string())})

    texts = documents.select("doc_id", "text").where("doc_id is not null").withColumn("h", F.pmod(F.xxhash64(F.col("doc_id").cast("bigint")), F.lit(FILTER_BITS)))
    rows = scratch.save(texts.mapInArrow(lean(reduced), "doc_id bigint, words string").join(known, "doc_id"), "rows")
    total = dict(rows.groupBy("label").count().collect())
    if not total.get(1):
        return Model([], np.zeros(0), -40.0)
    counted = rows.select("words", "label").mapInArrow(lean(_count), "feature string, clean bigint, toxic bigint").groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).where(F.col("toxic") >= settings.least)
    share = total[1] / sum(total.values())
    # How far a feature's toxic rows exceed or fall short of its share of all rows, in standard deviations.
    n = F.col("clean") + F.col("toxic")
    far = counted.select("feature", (F.abs(F.col("toxic") - F.lit(share) * n) / F.sqrt(F.lit(share * (1 - share)) * n + F.lit(1e-9))).alias("z"))
    chosen = [r.feature for r in far.where(F.col("z") > 4).orderBy(F.desc("z"), F.desc("feature")).limit(settings.features).select("feature").collect()]
    vocabulary = sorted({*chosen, *(t for group in settings.identities for t in group)})
    part = min(1.0, settings.rows / sum(total.values()))
    sample = rows.where(F.pmod(F.xxhash64("doc_id", F.lit(9)), F.lit(1 << 30)) < int(part * (1 << 30)) + (part == 1.0)).select("doc_id", "words", "label")
    got = sample.mapInArrow(lean(_sampled(vocabulary, settings.identities)), "doc_id bigint, label int, at array<int>, swapped array<int>").toArrow()
    got = got.sort_by("doc_id").combine_chunks()  # the same sums whatever the order of rows
    lists = lambda t, c: Sparse.of(t[c].chunk(0) if t.num_rows else pa.array([], pa.list_(pa.int32())), len(vocabulary))
    pairs = got.filter(got["swapped"].is_valid()).combine_chunks()
    weights, intercept = fit(got["label"].to_numpy().astype(float), lists(got, "at"), lists(pairs, "at"), lists(pairs, "swapped"), settings)
    return Model(vocabulary, weights, intercept)


def score(documents: DataFrame, model: Model) -> DataFrame:
    """``doc_id, text`` to ``doc_id, score`` between 0 and 1; extra columns go along, but for one named ``score``. Null
    and empty texts get the score of no word; texts are read whole; equal texts get equal scores. Rows that repeat stay;
    an empty table gives no rows."""
    bound_batches(documents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = model.scorer()
        for batch in batches:
            kept = {k: batch[k] for k in batch.schema.names if k != "text"}
            yield pa.record_batch(kept | {"score": pa.array([of(t.as_py()) for t in batch["text"]], pa.float64())})

    kept = [f for f in documents.schema if f.name not in ("text", "score")]
    out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return documents.select(*[f"`{f.name}`" for f in kept], "text").mapInArrow(lean(run), f"{out}, score double")
