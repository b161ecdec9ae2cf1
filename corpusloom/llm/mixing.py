"""Mixing sources to target weights, by hash-threshold histograms. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.scratch import Scratch

#: A word is a run of other characters than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Bits of the hash that a level resolves, and levels. After the last, a bin of a source of 2**36 rows holds one row.
LEVEL_BITS, LEVELS = 12, 3


def hash36(doc_id: Column, seed: int) -> Column:
    """36 bits of the MD5 of seed and id: the same in every run and every engine."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text), 1, 9), 16, 10).cast("bigint")


def targets(sizes: DataFrame, weights: Sequence[int], cap: int) -> DataFrame:
    """``skey, source_size`` to ``skey, source_size, target``.

    Sources in order of ``skey`` weigh ``weights``, repeating, and share the sum of all sizes; a target stops at
    ``cap`` times its source's size and the excess is shared anew. The limit of that resharing is the water level
    ``l`` with ``sum(min(weight * l, cap * size)) = total``: with sources in order of ``cap * size / weight``, the
    largest ``l[k] = (total - what the first k - 1 may take) / weight of the others`` that source k can hold. The windows
    run over one row for each source.
    """
    everything = Window.partitionBy(F.lit(0))
    ranked = sizes.withColumn(
        "weight",
        F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("skey")) - 1) % len(weights) + 1).cast("int")).cast("bigint"),
    ).withColumn("most", F.col("source_size") * cap)
    order = Window.partitionBy(F.lit(0)).orderBy(F.col("most") / F.col("weight"), "skey")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(0, Window.unboundedFollowing)
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(before), F.lit(0))) / F.sum("weight").over(after)
    held = ranked.withColumn("level", level).withColumn("level", F.max(F.when(F.col("level") * F.col("weight") <= F.col("most"), F.col("level"))).over(everything))
    return held.select("skey", "source_size", F.coalesce(F.least(F.col("level") * F.col("weight"), F.col("most").cast("double")), F.col("most").cast("double")).alias("target"))


def _skey(source: Column) -> Column:
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source))


def _plan(documents: DataFrame, weights: Sequence[int], cap: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """(sizes and hashes of the rows; for each source its size, target, whole epochs and the hash below which a document
    is taken once more)."""
    scratch = Scratch(documents.sparkSession, "mix")
    rows = scratch.save(
        documents.select("doc_id", "source", _skey(F.col("source")).alias("skey"), F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"), hash36(F.col("doc_id"), seed).alias("h")),
        "sizes",
    )
    epochs = F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(cap))).otherwise(0).cast("bigint")
    plan = scratch.save(
        targets(rows.groupBy("skey").agg(F.sum("size").alias("source_size")), weights, cap)
        .withColumn("epochs", epochs)
        .withColumn("left", F.col("target") - F.col("epochs") * F.col("source_size"))
        .withColumn("prefix", F.lit(0).cast("bigint")),
        "plan0",
    )
    for level in range(1, LEVELS + 1):
        shift = LEVEL_BITS * (LEVELS - level)
        binned = rows.select("skey", "size", F.shiftright("h", shift).alias("bin")).join(plan.select("skey", "prefix"), "skey").where(F.shiftright("bin", LEVEL_BITS) == F.col("prefix"))
        run = Window.partitionBy("skey").orderBy("bin")
        summed = binned.groupBy("skey", "bin").agg(F.sum("size").alias("size")).withColumn("upto", F.sum("size").over(run)).join(plan, "skey")
        ends = summed.where((F.col("upto") - F.col("size") <= F.col("left")) & (F.col("left") < F.col("upto")))
        found = ends.select("skey", F.col("bin"), (F.col("left") - (F.col("upto") - F.col("size"))).alias("rest"), F.col("size").alias("bin_size"))
        # A source without words has no bin that ends the budget: it takes nothing more.
        plan = scratch.save(
            plan.drop("bin_size").join(found, "skey", "left").select(
                "skey", "source_size", "target", "epochs", F.coalesce("rest", F.lit(0.0)).alias("left"), F.coalesce("bin", F.lit(0)).cast("bigint").alias("prefix"), "bin_size"
            ),
            f"plan{level}",
        )
    limit = F.when(F.coalesce(F.col("bin_size") - F.col("left") < F.col("left"), F.lit(False)), F.col("prefix") + 1).otherwise(F.col("prefix"))
    return rows, plan.select("skey", "source_size", "target", "epochs", limit.alias("limit"))


def _copies() -> Column:
    return F.col("epochs") + F.when(F.col("h") < F.col("limit"), 1).otherwise(0)


def mix(documents: DataFrame, weights: Sequence[int] = (5, 2, 1), cap: int = 3, seed: int = 0) -> DataFrame:
    """Takes each source's documents near its target: ``doc_id, source, size, source_size, target, taken``.

    ``documents`` has ``doc_id, source, text``; other columns are ignored. A document is taken whole, as many times as
    its source's target holds the source, and once more where its hash is below the source's threshold. The threshold
    comes from sums of sizes by source and hash bin: the bin in which the budget ends is found, only its rows are
    binned again by the next bits, and after the last bits the bin is taken if that is nearer to the target.
    Documents aren't sorted; an input's rows are read once, then a table of ids and sizes.

    Null texts and texts of no word have size 0, null sources form one source that comes last, rows that repeat an id
    share its decision, null ids are hashed as one id. An empty table gives no rows.
    """
    rows, plan = _plan(documents, weights, cap, seed)
    return rows.join(plan, "skey").select("doc_id", "source", "size", "source_size", "target", (F.col("size") * _copies()).alias("taken"))


def mixed(documents: DataFrame, weights: Sequence[int] = (5, 2, 1), cap: int = 3, seed: int = 0) -> DataFrame:
    """The rows of ``documents``, with all of their columns, each as many times as :func:`mix` takes it. What has no
    word isn't taken."""
    _, plan = _plan(documents, weights, cap, seed)
    held = F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("held")
    tagged = documents.where(F.coalesce(F.regexp_like("text", F.lit(WORD)), F.lit(False))).select(held, _skey(F.col("source")).alias("skey"), hash36(F.col("doc_id"), seed).alias("h"))
    return tagged.join(plan, "skey").select("held", F.explode(F.sequence(F.lit(0).cast("bigint"), _copies())).alias("copy")).where("copy > 0").select("held.*")
