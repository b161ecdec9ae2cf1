"""Reports on files and addresses: what is valid and why not, which of several PDF addresses is an article's own."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.xml import jats_facts

#: Where addresses come from, in the order in which they are preferred.
KINDS = ("oa", "meta", "index")
_ROOT = "https://pmc.ncbi.nlm.nih.gov"


def file_report(files: DataFrame) -> DataFrame:
    """``path, length, content`` to ``path, length, status, errors``: what can't be read as UTF-8 is invalid."""
    text = F.when(F.is_valid_utf8(F.col("content").cast("string")), F.col("content").cast("string"))
    judged = files.withColumn("__f", jats_facts(text))
    broken = F.col("content").isNotNull() & text.isNull()
    errors = F.when(broken, F.array(F.lit("not UTF-8"))).otherwise(F.col("__f.errors"))
    return judged.select("path", "length", F.col("__f.status").alias("status"), errors.alias("errors"))


def report_counts(report: DataFrame) -> DataFrame:
    """One row: files, bytes, and how many are valid or not. The lists of files are the report itself."""
    valid = F.col("status") == "valid"
    return report.agg(F.count("*").alias("total_files"), F.coalesce(F.sum("length"), F.lit(0)).alias("total_bytes"), F.count_if(valid).alias("valid_count"), F.count_if(~valid).alias("invalid_count"))


def _attribute(tag: str, name: str):
    return F.regexp_extract(tag, rf"""(?i)\b{name}\s*=\s*["']([^"']*)["']""", 1)


def pdf_addresses(answers: DataFrame) -> DataFrame:
    """``pmcid, kind, body`` to ``pmcid, url, ordinal, is_primary``: the addresses of an article's PDF files in order of
    preference, each once.

    ``kind`` tells the answer: ``oa``, a list of links with formats; ``meta``, the article's page, which may name one;
    ``index``, a page of links. The primary one is the first that looks like a file below ``/pdf/`` and isn't a
    supplement, or else the first. Relative addresses are those of the service."""
    patterns = {"oa": r"(?i)(<link\b[^>]*>)", "meta": r"(?i)(<meta\b[^>]*>)", "index": r"(?i)(<a\b[^>]*>)"}
    tags = F.lit(None).cast("array<string>")
    for k, p in patterns.items():
        tags = F.when(F.col("kind") == k, F.regexp_extract_all("body", F.lit(p), F.lit(1))).otherwise(tags)
    each = answers.select("pmcid", "kind", F.posexplode(tags).alias("at", "tag"))
    href, content = _attribute("tag", "href"), _attribute("tag", "content")
    found = (
        F.when((F.col("kind") == "oa") & (F.lower(_attribute("tag", "format")) == "pdf"), href)
        .when((F.col("kind") == "meta") & (F.lower(_attribute("tag", "name")) == "citation_pdf_url"), content)
        .when((F.col("kind") == "index") & F.lower(href).rlike(r"[.]pdf([?#].*)?\z"), href)
    )
    at_index = F.concat(F.lit(f"{_ROOT}/articles/"), F.col("pmcid"), F.lit("/pdf/"))
    whole = F.when(found.rlike(r"(?i)^[a-z][a-z0-9+.-]*://"), found).when(found.startswith("//"), F.concat(F.lit("https:"), found)).when(found.startswith("/"), F.concat(F.lit(_ROOT), found))
    url = whole.otherwise(F.concat(F.when(F.col("kind") == "index", at_index).otherwise(F.lit(f"{_ROOT}/")), found))
    rank = F.when(F.col("kind") == KINDS[0], 0).when(F.col("kind") == KINDS[1], 1).otherwise(2)
    once = each.withColumn("url", url).where(found.isNotNull() & (found != "")).groupBy("pmcid", "url").agg(F.min(F.struct(rank.alias("rank"), "at")).alias("place"))
    own = F.col("url").rlike(r"(?i)/pdf/[^/]+[.]pdf") & ~F.col("url").rlike(r"(?i)/suppl")
    by = Window.partitionBy("pmcid")
    placed = once.withColumn("ordinal", F.row_number().over(by.orderBy("place"))).withColumn("first", F.min(F.when(own, F.col("ordinal"))).over(by))
    return placed.select("pmcid", "url", "ordinal", (F.col("ordinal") == F.coalesce("first", F.lit(1))).alias("is_primary"))
