"""Identifiers of articles as column functions: canonical forms, kinds, identity. No UDFs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Python's ``str.strip`` has it, for use after ``(?U)``.
WS = r"[\s\x1c-\x1f]"
_CHEMRXIV = "item_"


def col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip(x: Column | str) -> Column:
    return F.regexp_replace(col(x), rf"(?U)^{WS}+|{WS}+\z", "")


def filled(x: Column | str) -> Column:
    """Null instead of an empty string."""
    return F.nullif(col(x), F.lit(""))


def normalize_pmcid(x: Column | str) -> Column:
    """``PMC`` and the digits, leading zeros kept; null if it isn't a PMCID."""
    return F.concat(F.lit("PMC"), filled(F.regexp_extract(col(x).cast("string"), rf"(?U)^{WS}*(?:[pP][mM][cC])?([0-9]+){WS}*\z", 1)))


def detect_id_type(x: Column | str) -> Column:
    """pmcid, doi, pmid or unknown; the first that fits, in this order."""
    t = strip(x)
    return (
        F.when(F.upper(t).startswith("PMC"), "pmcid")
        .when(t.contains("/"), "doi")
        .when(t.rlike(r"(?U)^\p{Nd}{7,}\z"), "pmid")
        .otherwise("unknown")
    )


def normalize_id(x: Column | str) -> Column:
    """Upper-case PMCIDs, lower-case DOIs, others without white space around them. Doesn't check digits."""
    t, kind = strip(x), detect_id_type(x)
    return F.when(kind == "pmcid", F.upper(t)).when(kind == "doi", F.lower(t)).otherwise(t)


def doi_key(x: Column | str) -> Column:
    """The key by which DOIs are the same; null if there is none."""
    return filled(F.lower(strip(x)))


def biorxiv_doi(x: Column | str) -> Column:
    """Without resolver and scheme, each taken off once, in this order; case is kept."""
    return F.regexp_replace(strip(x), r"^(https://doi\.org/)?(http://doi\.org/)?(doi:)?", "")


def arxiv_link_doi(x: Column | str) -> Column:
    return F.replace(F.replace(col(x), F.lit("http://dx.doi.org/"), F.lit("")), F.lit("https://doi.org/"), F.lit(""))


def chemrxiv_id(x: Column | str) -> Column:
    """The last part of a URL's path that looks like an item, with the item prefix."""
    t = strip(x)
    parts = F.filter(F.split(t, "/"), lambda p: p.startswith(_CHEMRXIV) | p.contains("202"))
    found = F.when(t.startswith("http"), F.coalesce(F.try_element_at(parts, F.lit(-1)), t)).otherwise(t)
    return F.when(found.startswith(_CHEMRXIV), found).otherwise(F.concat(F.lit(_CHEMRXIV), found))


def id_key(value: Column | str, kind: Column | str) -> Column:
    """The key by which a converter's answer is matched to the request."""
    t = strip(value)
    return F.when(col(kind) == "doi", F.lower(t)).when(col(kind) == "pmcid", F.coalesce(normalize_pmcid(t), F.upper(t))).otherwise(F.upper(t))


def best_id(source: Column | str, id_: Column | str, pmid: Column | str, pmcid: Column | str) -> Column:
    """The source and id under which citations of a record are looked up; null if it has none."""
    source, id_, pmid, pmcid = filled(source), filled(id_), filled(pmid), filled(pmcid)
    named = lambda s, i: F.when(i.isNotNull(), F.struct(s.alias("source"), i.alias("id")))
    other = source.isNotNull() & ~source.isin("MED", "PMC")
    return F.coalesce(
        F.when(source == "MED", named(F.lit("MED"), F.coalesce(pmid, id_))),
        F.when(source == "PMC", named(F.lit("PMC"), F.coalesce(normalize_pmcid(pmcid), normalize_pmcid(id_)))),
        F.when(other, named(source, id_)),
        named(F.lit("PMC"), normalize_pmcid(pmcid)),
        named(F.lit("MED"), F.coalesce(pmid, id_)),
    )


def identity_keys(source: Column | str, id_: Column | str, doi: Column | str, pmid: Column | str, pmcid: Column | str) -> Column:
    """Every key a record is known by; two records that share one are the same paper."""
    source, id_, doi, pmid, pmcid = filled(source), filled(id_), filled(doi), filled(pmid), filled(pmcid)
    return F.array_distinct(
        F.array_compact(
            F.array(
                F.concat(F.lit("doi:"), F.lower(strip(doi))),
                F.concat(F.lit("pmcid:"), normalize_pmcid(pmcid)),
                F.when(source == "PMC", F.concat(F.lit("pmcid:"), normalize_pmcid(id_))),
                F.concat(F.lit("pmid:"), strip(pmid)),
                F.when(source == "MED", F.concat(F.lit("pmid:"), strip(id_))),
                F.when(~source.isin("MED", "PMC"), F.concat(source, F.lit(":"), strip(id_))),
            )
        )
    )


def article_file_key(pmcid: Column | str, pmid: Column | str, id_: Column | str) -> Column:
    return F.coalesce(filled(pmcid), F.concat(F.lit("PMID"), filled(pmid)), F.concat(F.lit("EPMC"), col(id_)))


def without_version(x: Column | str) -> Column:
    return F.regexp_replace(col(x), r"v\d+\z", "")


def safe_file_name(source: Column | str, doi: Column | str) -> Column:
    return F.concat(col(source), F.lit("_"), F.translate(col(doi), "/:", "__"), F.lit(".xml"))


def cache_key(stem: Column | str, content: Column | str) -> Column:
    """Of a converted file: its stem and the full hash of its bytes."""
    return F.concat_ws(".", col(stem), F.sha1(col(content)), F.lit("tei.xml"))


def path_stem(path: Column | str) -> Column:
    return F.regexp_extract(col(path), r"([^/]+?)(\.[^./]*)?\z", 1)


def manifest_entry_id(pmcid: Column | str, doi: Column | str, path: Column | str) -> Column:
    """PMCID, else DOI, else the stem of the path if that is of a known kind."""
    stem = path_stem(path)
    return F.coalesce(normalize_id(filled(pmcid)), normalize_id(filled(doi)), F.when(detect_id_type(stem) != "unknown", normalize_id(stem)))
