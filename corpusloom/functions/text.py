"""Text, names, dates and hashes as column functions; Unicode forms as pandas UDFs."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.ids import WS, col, filled, strip


def clean_spaces(x: Column | str) -> Column:
    """White space collapsed and trimmed; no-break spaces become spaces, zero-width spaces go; null becomes empty."""
    t = F.replace(F.replace(F.coalesce(col(x), F.lit("")), F.lit(" "), F.lit(" ")), F.lit("​"), F.lit(""))
    return strip(F.regexp_replace(t, rf"(?U){WS}+", " "))


def _clean(text: str | None, ascii_only: bool) -> str:
    t = unicodedata.normalize("NFKC", text or "").replace(" ", " ").replace("​", "")
    t = re.sub(r"\s+", " ", t).strip()
    return transliterated(t) if ascii_only else t


# Letters whose decomposition leaves no ASCII letter.
LETTERS = {"ß": "ss", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "ø": "o", "Ø": "O", "đ": "d", "Đ": "D", "ł": "l", "Ł": "L", "þ": "th", "Þ": "Th", "ð": "d", "Ð": "D", "ı": "i", "–": "-", "—": "--", "‘": "'", "’": "'", "“": '"', "”": '"', "…": "..."}


def transliterated(text: str) -> str:
    """ASCII: letters without their marks, the table's replacements; other characters go."""
    t = unicodedata.normalize("NFKD", "".join(LETTERS.get(c, c) for c in text))
    return "".join(LETTERS.get(c, c) for c in t if not unicodedata.combining(c)).encode("ascii", "ignore").decode()


@F.pandas_udf(T.StringType())
def clean_text(x: pd.Series) -> pd.Series:
    """NFKC, then white space as :func:`clean_spaces`."""
    return x.map(lambda t: _clean(t, False))


@F.pandas_udf(T.StringType())
def clean_ascii(x: pd.Series) -> pd.Series:
    return x.map(lambda t: _clean(t, True))


def extract_doi(x: Column | str) -> Column:
    """The first DOI in a text, without the punctuation after it; null if there is none."""
    return filled(F.rtrim(F.regexp_extract(col(x), r"(?i)10\.\d{4,9}/[-._;()/:A-Z0-9]+", 0), F.lit(" .;,)\n\r")))


def extract_year(x: Column | str) -> Column:
    return filled(F.regexp_extract(col(x), r"(19|20|21)\d{2}", 0))


def split_names(x: Column | str, separator: str) -> Column:
    return F.filter(F.transform(F.split(col(x), separator), strip), lambda n: n != "")


def joined_names(people: Column | str, first: str = "firstName", last: str = "lastName") -> Column:
    names = F.transform(col(people), lambda p: strip(F.concat_ws(" ", p[first], p[last])))
    return F.filter(names, lambda n: n != "")


def slash_date(x: Column | str) -> Column:
    return F.replace(col(x), F.lit("-"), F.lit("/"))


def iso_date(x: Column | str) -> Column:
    return F.replace(col(x), F.lit("/"), F.lit("-"))


def is_slash_date(x: Column | str) -> Column:
    return col(x).rlike(r"^\d{4}/\d{2}/\d{2}\z")


def compact_date(x: Column | str) -> Column:
    return F.date_format(col(x), "yyyyMMdd")


def parsed_time(x: Column | str, *formats: str) -> Column:
    """By the first format that fits; null instead of an error."""
    return F.coalesce(*[F.try_to_timestamp(col(x), F.lit(f)) for f in formats])


def date_prefix(x: Column | str) -> Column:
    return F.left(col(x), F.lit(10))


def category_key(x: Column | str) -> Column:
    return F.translate(F.lower(col(x)), " -", "__")


def duration(seconds: Column | str) -> Column:
    """``45.0s``, ``m:ss`` or ``h:mm:ss``."""
    s = col(seconds)
    whole = s.cast("long")
    return (
        F.when(s < 60, F.format_string("%.1fs", s.cast("double")))
        .when(s < 3600, F.format_string("%d:%02d", F.floor(whole / 60), whole % 60))
        .otherwise(F.format_string("%d:%02d:%02d", F.floor(whole / 3600), F.floor(whole % 3600 / 60), whole % 60))
    )


def is_full_text(x: Column | str) -> Column:
    """Whether a response is an article and not an error page."""
    t, low = col(x), F.lower(col(x))
    return (F.length(t) >= 100) & ~low.contains("<error>") & ~low.contains("id not found") & (t.contains("<article") | t.contains("<pmc-articleset"))


def hrefs(html: Column | str) -> Column:
    """Targets of links, in order, each once."""
    return F.array_distinct(F.regexp_extract_all(col(html), F.lit(r'href="([^"]+)"'), F.lit(1)))


def page_title(html: Column | str) -> Column:
    return F.regexp_extract(col(html), "<title>([^<]*)</title>", 1)


def rag_document(full_text: Column, title: Column | str, abstract: Column | str) -> Column:
    """``origin, body``: the full text where there is one, else title and abstract."""
    told = filled(full_text).isNotNull()
    parts = F.concat(F.coalesce(col(title), F.lit("")), F.coalesce(col(abstract), F.lit("")))
    origin = F.when(told, "text").otherwise("title_abstract")
    return F.struct(origin.alias("origin"), F.when(told, full_text).otherwise(parts).alias("body"))
