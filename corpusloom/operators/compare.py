"""Comparison of two corpora by the ids of their articles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.ids import detect_id_type, filled, normalize_id, normalize_pmcid, strip


def parse_ids(lines: DataFrame, column: str = "value") -> DataFrame:
    """Lines to ``id, id_type``; blank lines and comments go. Repeats stay, as types are counted by occurrence."""
    t = strip(column)
    return lines.where((t != "") & ~t.startswith("#")).select(normalize_id(column).alias("id"), detect_id_type(column).alias("id_type"))


def type_counts(ids: DataFrame) -> DataFrame:
    return ids.groupBy("id_type").agg(F.count("*").alias("n"))


def flagged(reference: DataFrame, candidate: DataFrame) -> DataFrame:
    """``id, in_reference, in_candidate`` of each distinct id: one shuffle of both sides for all that follows."""
    both = reference.select("id", F.lit(True).alias("r"), F.lit(False).alias("c")).union(candidate.select("id", F.lit(False).alias("r"), F.lit(True).alias("c")))
    return both.groupBy("id").agg(F.bool_or("r").alias("in_reference"), F.bool_or("c").alias("in_candidate"))


def overlap(reference: DataFrame, candidate: DataFrame) -> DataFrame:
    return flagged(reference, candidate).where("in_reference and in_candidate").select("id")


def only_reference(reference: DataFrame, candidate: DataFrame) -> DataFrame:
    return flagged(reference, candidate).where("in_reference and not in_candidate").select("id")


def only_candidate(reference: DataFrame, candidate: DataFrame) -> DataFrame:
    return flagged(reference, candidate).where("in_candidate and not in_reference").select("id")


def ratio(part: Column, whole: Column) -> Column:
    """0 where there is nothing to divide by."""
    return F.when(whole == 0, F.lit(0.0)).otherwise(part.cast("double") / whole)


def metrics(reference: DataFrame, candidate: DataFrame) -> DataFrame:
    """One row: sizes of both sets, of their overlap and differences, Jaccard, recall and precision."""
    n = lambda condition: F.count_if(F.expr(condition))
    counts = flagged(reference, candidate).agg(
        n("in_reference").alias("reference_count"), n("in_candidate").alias("candidate_count"), n("in_reference and in_candidate").alias("overlap_count"),
        n("in_reference and not in_candidate").alias("reference_only_count"), n("in_candidate and not in_reference").alias("candidate_only_count"),
    )
    o = F.col("overlap_count")
    return counts.select(
        "*",
        ratio(o, o + F.col("reference_only_count") + F.col("candidate_only_count")).alias("jaccard"),
        ratio(o, F.col("reference_count")).alias("recall"),
        ratio(o, F.col("candidate_count")).alias("precision"),
    )


def report(reference: DataFrame, candidate: DataFrame) -> DataFrame:
    """One row with the JSON of the comparison. It holds all ids of the differences, so it is for corpora that a document
    can list; the tables above are for others."""
    ids = flagged(reference, candidate)
    listed = ids.agg(
        F.sort_array(F.collect_list(F.when(F.expr("in_reference and not in_candidate"), F.col("id")))).alias("reference_only"),
        F.sort_array(F.collect_list(F.when(F.expr("in_candidate and not in_reference"), F.col("id")))).alias("candidate_only"),
    )
    rounded = [F.bround(c, 4).alias(c) for c in ("jaccard", "recall", "precision")]
    row = metrics(reference, candidate).select("reference_count", "candidate_count", "overlap_count", "reference_only_count", "candidate_only_count", *rounded)
    return row.join(listed).select(F.to_json(F.struct("*")).alias("json"))


def write_report(reference: DataFrame, candidate: DataFrame, path: str) -> DataFrame:
    """The comparison of corpora of any size below ``path``: the ids of the overlap and of both differences as sorted text
    files, written by ranges, and the numbers as JSON. Returns the numbers."""
    spark, rounded = reference.sparkSession, [F.bround(c, 4).alias(c) for c in ("jaccard", "recall", "precision")]
    ids = flagged(reference, candidate)
    which = F.when(F.expr("in_reference and in_candidate"), "overlap").when(F.col("in_reference"), "reference_only").otherwise("candidate_only")
    dealt = ids.select("id", which.alias("list")).repartitionByRange("list", "id").sortWithinPartitions("list", "id")
    dealt.write.mode("overwrite").partitionBy("list").text(f"{path}/ids")
    counts = [F.col(f"{k}_count") for k in ("reference", "candidate", "overlap", "reference_only", "candidate_only")]
    metrics(reference, candidate).select(*counts, *rounded).coalesce(1).write.mode("overwrite").json(f"{path}/metrics")
    schema = ", ".join([f"{k}_count bigint" for k in ("reference", "candidate", "overlap", "reference_only", "candidate_only")] + [f"{k} double" for k in ("jaccard", "recall", "precision")])
    return spark.read.schema(schema).json(f"{path}/metrics")


def resolve(ids: DataFrame, articles: DataFrame) -> DataFrame:
    """``id`` to ``id, resolved``: the PMCID of the article that has it as its DOI or PMID, else the id as it is.
    ``articles`` has ``pmcid, doi, pmid``."""
    known = (
        articles.select(normalize_pmcid("pmcid").alias("pmcid"), F.array(normalize_id("doi"), normalize_id("pmid")).alias("keys"))
        .where("pmcid is not null").select("pmcid", F.explode("keys").alias("id")).where(filled("id").isNotNull())
        .groupBy("id").agg(F.min("pmcid").alias("pmcid"))
    )
    return ids.select(normalize_id("id").alias("id")).distinct().join(known, "id", "left").select("id", F.when(detect_id_type("id") == "pmcid", F.col("id")).otherwise(F.coalesce("pmcid", "id")).alias("resolved"))
