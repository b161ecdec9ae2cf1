"""Importance resampling towards a target distribution, by hashed n-gram features. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.scratch import Scratch

#: A word, after A-Z became a-z: a run of other characters than ASCII ones that are no digit and no small letter.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rows of one score that a window numbers at once; scores of more rows are cut by ranges of their ids.
CELL = 1 << 18


def constant(numbers: list[int]) -> Column:
    """An array that Catalyst folds into one constant."""
    return F.split(F.lit(",".join(map(str, numbers or [0]))), ",").cast("array<bigint>")


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def _joined(names: list[str]):
    return lambda z: F.concat_ws(" ", *[z[x] for x in names])


def features(of: Column, longest: int) -> Column:
    """All runs of 1 to ``longest`` of an array of words, joined by one blank. Shifted copies are zipped: a lambda that
    named the array itself would make it anew for each word."""
    runs = of
    for k in range(2, longest + 1):
        n = F.greatest(F.size(of) - k + 1, F.lit(0))
        names = [f"w{i}" for i in range(k)]
        shifted = F.arrays_zip(*[F.slice(of, i + 1, n).alias(x) for i, x in enumerate(names)])
        runs = F.concat(runs, F.transform(shifted, _joined(names)))
    return runs


def bucket(feature: Column, buckets: int) -> Column:
    return (F.crc32(feature.cast("binary")) % buckets).cast("int")


def counts(texts: DataFrame, longest: int, buckets: int) -> DataFrame:
    """``bucket, n`` of all features of ``text``; counted before the shuffle, so at most ``buckets`` rows a task."""
    each = texts.select(F.explode(features(words(F.col("text")), longest)).alias("feature"))
    return each.groupBy(bucket(F.col("feature"), buckets).alias("bucket")).agg(F.count("*").alias("n"))


def gains(documents: DataFrame, target: DataFrame, longest: int, buckets: int) -> list[int]:
    """What a feature of each bucket adds to a weight: 1000 times the logarithm of how much more often the target has
    it, both counts smoothed by one; ``buckets`` numbers, whatever the tables hold."""
    source = counts(documents, longest, buckets).withColumnRenamed("n", "s")
    wanted = counts(target, longest, buckets).withColumnRenamed("n", "t")
    rows = source.join(wanted, "bucket", "full").select("bucket", *[F.coalesce(c, F.lit(0)).cast("double").alias(c) for c in ("s", "t")])
    found = Scratch(documents.sparkSession, "importance").save(rows, "buckets")
    total = found.agg(*[(F.coalesce(F.sum(c), F.lit(0.0)) + float(buckets)).alias(c) for c in ("s", "t")]).first()
    gain = F.floor(1000 * F.ln((F.col("t") + 1) * F.lit(total.s) / ((F.col("s") + 1) * F.lit(total.t))))
    every = documents.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    full = every.join(found, "bucket", "left").select("bucket", F.coalesce("s", F.lit(0.0)).alias("s"), F.coalesce("t", F.lit(0.0)).alias("t"))
    return [r.gain for r in full.select("bucket", gain.alias("gain")).orderBy("bucket").collect()]


def scored(documents: DataFrame, gain: list[int], longest: int, seed: int) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score``: a text's buckets look their gains up in one array; the score adds
    Gumbel noise, made of seed and id, so that the highest scores are a draw by weight."""
    array = constant(gain)
    rows = documents.select("doc_id", words(F.col("text")).alias("words")).select("doc_id", F.size("words").cast("bigint").alias("n_words"), features(F.col("words"), longest).alias("features"))
    weight = F.aggregate("features", F.lit(0).cast("bigint"), lambda a, f: a + F.get(array, bucket(f, len(gain))))
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.ln(-F.ln((h + 0.5) / 4294967296.0)))
    return rows.select("doc_id", "n_words", F.size("features").cast("bigint").alias("n_features"), weight.alias("weight")).withColumn("score", F.col("weight") + noise)


def histogram(scores: DataFrame, scratch: Scratch) -> DataFrame:
    """``score, n, lo, hi, above``: rows of each score, their smallest and largest id and how many rows score higher.

    The suffix sums run in two levels: over ranges of scores, written once so that their borders stay, and within each.
    To the driver comes one sum for each range."""
    each = scores.groupBy("score").agg(F.count("*").alias("n"), F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
    ranged = scratch.save(each.repartitionByRange(F.desc("score")).withColumn("range", F.spark_partition_id()), "scores")
    sums = {r["range"]: r.n for r in ranged.groupBy("range").agg(F.sum("n").alias("n")).collect()}
    before, total = [], 0
    for i in range(max(sums, default=-1) + 1):
        before.append(total)
        total += sums.get(i, 0)
    higher = Window.partitionBy("range").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)
    offset = F.get(constant(before), F.col("range"))
    return ranged.select("score", "n", "lo", "hi", (offset + F.coalesce(F.sum("n").over(higher), F.lit(0))).alias("above"))


def resample(documents: DataFrame, target: DataFrame, percent: int = 10, least: int = 20, longest: int = 1, buckets: int = 10_000, seed: int = 2024) -> DataFrame:
    """Draws ``percent`` of the ``documents`` of at least ``least`` words towards the distribution of ``target``:
    ``doc_id, n_words, n_features, weight, score, rank`` of every document; ``rank`` is null where it isn't drawn.

    ``documents`` has ``doc_id, text``, ``target`` ``text``; other columns are ignored. Gains of all buckets come from
    counts over both whole tables. The drawn are found without a sort of all rows: a histogram of the integer scores
    tells how many rows score higher than each score, and so the score at which the draw ends; only rows from that score
    on are numbered, by id within each score, on top of the score's offset. A score of more than ``CELL`` rows is
    numbered in ranges of its ids.

    Null texts have no words, weight 0 and no part in the draw, which is also what short and empty texts get. Rows that
    repeat an id are drawn each for itself, by text length and weight where their scores tie; null ids count as one id
    that comes last. An empty target gives gains of its smoothing alone; an empty table gives no rows.
    """
    scratch = Scratch(documents.sparkSession, "importance")
    gain = gains(documents, target, longest, buckets)
    scores = scratch.save(scored(documents.select("doc_id", "text"), gain, longest, seed), "scored")
    long_enough = F.col("n_words") >= least
    steps = scratch.save(histogram(scores.where(long_enough), scratch), "histogram")
    n = steps.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    draw = percent * n // 100
    cut = steps.where((F.col("above") < draw) & (F.col("above") + F.col("n") >= draw)).first()
    none = F.lit(None).cast("bigint")
    out = ["doc_id", "n_words", "n_features", "weight", "score"]
    if cut is None:  # nothing is drawn
        return scores.select(*out, none.alias("rank"))
    survives = long_enough & (F.col("score") >= cut.score)
    surviving = scores.where(survives).join(steps.where(F.col("score") >= cut.score), "score")
    # A score's ids in so many even ranges; each range's rows are counted, so that the next knows its offset.
    parts = F.ceil(F.col("n") / CELL)
    cell = F.when(F.col("doc_id").isNull(), parts).otherwise(F.floor((F.col("doc_id").cast("double") - F.col("lo")) / (F.col("hi").cast("double") - F.col("lo") + 1) * parts))
    placed = surviving.withColumn("cell", F.when(parts > 1, cell).otherwise(F.lit(0)).cast("bigint"))
    order = Window.partitionBy("score", "cell").orderBy(F.asc_nulls_last("doc_id"), "n_features", "weight")
    sizes = placed.where(F.col("n") > CELL).groupBy("score", "cell").agg(F.count("*").alias("m"))
    lower = Window.partitionBy("score").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    lower = sizes.select("score", "cell", F.coalesce(F.sum("m").over(lower), F.lit(0)).alias("lower"))
    rank = F.col("above") + F.coalesce("lower", F.lit(0)) + F.row_number().over(order)
    hot = steps.where((F.col("score") >= cut.score) & (F.col("n") > CELL)).limit(1).count()
    placed = placed.join(lower, ["score", "cell"], "left") if hot else placed.withColumn("lower", F.lit(0).cast("bigint"))
    drawn = placed.withColumn("rank", rank).select(*out, F.when(F.col("rank") <= draw, F.col("rank")).alias("rank"))
    return drawn.union(scores.where(~survives).select(*out, none.alias("rank")))
