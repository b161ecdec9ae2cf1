"""One search configuration, compiled to the query languages of the repositories and to predicates on columns."""

from __future__ import annotations

import dataclasses
import hashlib
import json
import re
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

SOURCES = ("pmc", "europepmc", "biorxiv", "medrxiv", "arxiv", "chemrxiv")
CATEGORIES = ("keywords", "virus_keywords", "disease_keywords", "vaccine_keywords")
_DATE = re.compile(r"\d{4}/\d{2}/\d{2}")


class SearchError(ValueError):
    """A configuration that can't be searched."""


@dataclass(frozen=True)
class DateRange:
    start: str
    end: str

    def __post_init__(self) -> None:
        for d in (self.start, self.end):
            if not _DATE.fullmatch(d):
                raise SearchError(f"not a date as YYYY/MM/DD: {d!r}")

    def iso(self, which: str) -> str:
        return getattr(self, which).replace("/", "-")


@dataclass(frozen=True)
class SourceOptions:
    categories: tuple[str, ...] = ()
    extra_keywords: tuple[str, ...] = ()
    max_results: int | None = None


def _any(parts: list[str]) -> str:
    return parts[0] if len(parts) == 1 else f"({' OR '.join(parts)})"


@dataclass(frozen=True)
class Search:
    """What to look for, and where."""

    name: str = ""
    description: str = ""
    author: str | None = None
    keywords: tuple[str, ...] = ()
    virus_keywords: tuple[str, ...] = ()
    disease_keywords: tuple[str, ...] = ()
    vaccine_keywords: tuple[str, ...] = ()
    arxiv_categories: tuple[str, ...] = ()
    date_range: DateRange | None = None
    sources: tuple[str, ...] = ()
    source_options: dict[str, SourceOptions] = field(default_factory=dict)
    max_results_per_source: int | None = None
    open_access_only: bool = False
    deduplicate_by_doi: bool = True
    expand_references: bool = False
    expand_citations: bool = False
    expansion_depth: int = 1
    max_expansion: int | None = None

    # JSON.

    @classmethod
    def from_dict(cls, raw: dict[str, Any]) -> Search:
        """Unknown keys are ignored; missing ones get their defaults."""
        known = {f.name for f in dataclasses.fields(cls)}
        own = {k: tuple(v) if isinstance(v, list) else v for k, v in raw.items() if k in known and v is not None}
        if own.get("date_range"):
            own["date_range"] = DateRange(own["date_range"]["start"], own["date_range"]["end"])
        own["source_options"] = {
            k: SourceOptions(tuple(v.get("categories") or ()), tuple(v.get("extra_keywords") or ()), v.get("max_results")) for k, v in (own.get("source_options") or {}).items()
        }
        return cls(**own)

    @classmethod
    def from_json(cls, text: str) -> Search:
        try:
            return cls.from_dict(json.loads(text))
        except json.JSONDecodeError as e:
            raise SearchError(f"not JSON: {e}") from e

    def to_dict(self) -> dict[str, Any]:
        """Without what has its default."""

        def plain(x: Any) -> Any:
            if dataclasses.is_dataclass(x):
                return {f.name: plain(v) for f in dataclasses.fields(x) if (v := getattr(x, f.name)) not in (None, ())}
            return [plain(v) for v in x] if isinstance(x, tuple) else {k: plain(v) for k, v in x.items()} if isinstance(x, dict) else x

        blank = Search()
        return {f.name: plain(v) for f in dataclasses.fields(self) if (v := getattr(self, f.name)) != getattr(blank, f.name)}

    def config_hash(self) -> str:
        """16 hexadecimal digits that tell configurations apart."""
        return hashlib.sha256(json.dumps(self.to_dict(), sort_keys=True).encode()).hexdigest()[:16]

    # Parts.

    @property
    def all_keywords(self) -> list[str]:
        return [k for c in CATEGORIES for k in getattr(self, c)]

    @property
    def keyword_groups(self) -> list[tuple[str, ...]]:
        return [g for c in CATEGORIES if (g := getattr(self, c))]

    def problems(self) -> list[str]:
        return [] if self.author or self.all_keywords else ["at least one of author and keywords is needed"]

    def _checked(self) -> None:
        if found := self.problems():
            raise SearchError("; ".join(found))

    # Query languages.

    def _pubmed(self, groups: list) -> str:
        self._checked()
        parts = [f"{self.author}[au]"] if self.author else []
        parts += [_any([f'"{k}"[tiab]' for k in g]) for g in groups if g]
        if self.date_range:
            parts.append(f"{self.date_range.start}:{self.date_range.end}[dp]")
        return " AND ".join(parts)

    def pubmed(self) -> str:
        """All keywords are alternatives."""
        return self._pubmed([self.all_keywords])

    def pubmed_by_category(self) -> str:
        """Alternatives within a category, all categories together."""
        return self._pubmed(self.keyword_groups)

    def pubmed_legacy(self) -> str:
        """Viruses or diseases, with vaccines, in a range of publication dates."""
        first = " OR ".join([*self.virus_keywords, *self.disease_keywords])
        parts = [f"(({first}))"] if first else []
        parts += [f"({' OR '.join(self.vaccine_keywords)})"] if self.vaccine_keywords else []
        parts += [f'("{self.date_range.start}"[PDAT] : "{self.date_range.end}"[PDAT])'] if self.date_range else []
        return " AND ".join(parts)

    def europepmc(self) -> str:
        parts = [f'AUTH:"{self.author}"'] if self.author else []
        parts += [_any([f'"{k}"' for k in g]) for g in self.keyword_groups]
        if self.date_range:
            parts.append(f"FIRST_PDATE:[{self.date_range.iso('start')} TO {self.date_range.iso('end')}]")
        return " AND ".join([*parts, *(["OPEN_ACCESS:Y"] if self.open_access_only else []), "HAS_FT:Y"])

    def arxiv(self) -> str:
        if not (self.author or self.all_keywords or self.arxiv_categories):
            raise SearchError("at least one of author, keywords and arxiv_categories is needed")
        return arxiv_query(author=self.author, everywhere=self.all_keywords, categories=self.arxiv_categories)

    def _limit(self, source: str) -> int | None:
        own = self.source_options.get(source)
        return own.max_results if own and own.max_results is not None else self.max_results_per_source

    def biorxiv(self, server: str = "biorxiv") -> dict[str, Any]:
        """The service has no search: the first category and the dates."""
        own = self.source_options.get(server, SourceOptions())
        out: dict[str, Any] = {"max_results": self._limit(server)}
        if own.categories:
            out["category"] = own.categories[0]
        return out | ({"start_date": self.date_range.iso("start"), "end_date": self.date_range.iso("end")} if self.date_range else {})

    def chemrxiv(self) -> dict[str, Any]:
        out: dict[str, Any] = {"max_results": self._limit("chemrxiv")}
        if self.all_keywords:
            out["term"] = " ".join(self.all_keywords)
        if own := self.source_options.get("chemrxiv", SourceOptions()).categories:
            out["category_ids"] = chemrxiv_categories(own)
        return out | ({"date_from": self.date_range.iso("start"), "date_to": self.date_range.iso("end")} if self.date_range else {})

    def unknown_categories(self) -> dict[str, list[str]]:
        """Categories that a source's vocabulary doesn't have, by source: the services would find nothing in them."""
        known = {"biorxiv": BIORXIV, "medrxiv": MEDRXIV, "chemrxiv": tuple(CHEMRXIV)}
        missing = {s: [c for c in o.categories if category_key(c) not in known[s]] for s, o in self.source_options.items() if s in known}
        return {s: names for s, names in missing.items() if names}

    # Predicates.

    def predicate(self, mode: str = "category", text: tuple[str, ...] = ("title", "abstract"), authors: str | None = None, date: str | None = None, open_access: str | None = None) -> Column:
        """The same search on columns. ``mode``: "any" as :meth:`pubmed`, "category" as :meth:`pubmed_by_category`,
        "legacy". Keywords are sought in lower case anywhere in the text columns."""
        self._checked()
        low = [F.lower(F.coalesce(F.col(c), F.lit(""))) for c in text]
        has = lambda words: reduce(lambda a, b: a | b, [t.contains(w.lower()) for w in words for t in low])
        groups = {"any": [self.all_keywords], "category": self.keyword_groups, "legacy": [[*self.virus_keywords, *self.disease_keywords], self.vaccine_keywords]}[mode]
        parts = [has(g) for g in groups if g]
        if self.author and authors:
            parts.append(F.exists(authors, lambda a: F.lower(a).contains(self.author.lower())))
        if self.date_range and date:
            parts.append(in_dates(F.col(date), self.date_range.iso("start"), self.date_range.iso("end")))
        if self.open_access_only and open_access:
            parts.append(F.col(open_access))
        return reduce(lambda a, b: a & b, parts, F.lit(True))


def in_dates(date: Column, start: str | None, end: str | None) -> Column:
    """Both ends included; a missing end, or ``*``, is open."""
    parts = [date >= F.lit(start).cast("date")] if start and start != "*" else []
    parts += [date <= F.lit(end).cast("date")] if end and end != "*" else []
    return reduce(lambda a, b: a & b, parts, F.lit(True))


def europepmc_query(author: str | None = None, keywords: list[str] | None = None, title: list[str] | None = None, start: str | None = None, end: str | None = None, open_access: bool = False, full_text: bool = False) -> str:
    """The client's own builder: keywords always in parentheses, title words together, open ends as ``*``."""
    parts = [f'AUTH:"{author}"'] if author else []
    parts += [f"({' OR '.join(f'"{k}"' for k in keywords)})"] if keywords else []
    parts += [f'TITLE:"{k}"' for k in title or ()]
    parts += [f"FIRST_PDATE:[{start or '*'} TO {end or '*'}]"] if start or end else []
    return " AND ".join([*parts, *(["OPEN_ACCESS:Y"] if open_access else []), *(["HAS_FT:Y"] if full_text else [])]) or "*"


def arxiv_query(author: str | None = None, title: list[str] | None = None, abstract: list[str] | None = None, everywhere: list[str] | None = None, categories: tuple[str, ...] | list[str] | None = None) -> str:
    parts = [f'au:"{author}"'] if author else []
    for prefix, words in (("ti", title), ("abs", abstract), ("all", everywhere)):
        if words:
            parts.append(f"({' OR '.join(f'{prefix}:"{w}"' for w in words)})")
    if categories:
        parts.append(f"({' OR '.join(f'cat:{c}' for c in categories)})")
    return " AND ".join(parts)


def pubmed_since(query: str, date: str) -> str:
    """Only what is new since the day ``date``."""
    return f"({query}) AND {date.replace('-', '/')}:3000/12/31[dp]"


def arxiv_since(query: str, date: str) -> str:
    return f"({query}) AND submittedDate:[{date.replace('-', '')} TO *]"


# The subject categories of ChemRxiv with their ids, of bioRxiv and of medRxiv.
CHEMRXIV = {
    "analytical_chemistry": 1,
    "biochemistry": 2,
    "biological_chemistry": 3,
    "catalysis": 4,
    "chemical_biology": 5,
    "chemical_engineering": 6,
    "chemical_physics": 7,
    "computational_chemistry": 8,
    "earth_space_chemistry": 9,
    "electrochemistry": 10,
    "energy": 11,
    "environmental_chemistry": 12,
    "inorganic_chemistry": 13,
    "materials_chemistry": 14,
    "medicinal_chemistry": 15,
    "nanoscience": 16,
    "organic_chemistry": 17,
    "organometallic_chemistry": 18,
    "physical_chemistry": 19,
    "polymer_chemistry": 20,
    "supramolecular_chemistry": 21,
    "theoretical_chemistry": 22,
}
BIORXIV = (
    "animal_behavior_and_cognition", "biochemistry", "bioengineering", "bioinformatics", "biophysics", "cancer_biology", "cell_biology",
    "clinical_trials", "developmental_biology", "ecology", "epidemiology", "evolutionary_biology", "genetics", "genomics", "immunology",
    "microbiology", "molecular_biology", "neuroscience", "paleontology", "pathology", "pharmacology_and_toxicology", "physiology",
    "plant_biology", "scientific_communication_and_education", "synthetic_biology", "systems_biology", "zoology",
)
MEDRXIV = (
    "addiction_medicine", "allergy_and_immunology", "anesthesia", "cardiovascular_medicine", "dentistry_and_oral_medicine", "dermatology",
    "emergency_medicine", "endocrinology", "epidemiology", "forensic_medicine", "gastroenterology", "genetic_and_genomic_medicine",
    "geriatric_medicine", "health_economics", "health_informatics", "health_policy", "health_systems_and_quality_improvement", "hematology",
    "hiv_aids", "infectious_diseases", "intensive_care_and_critical_care_medicine", "medical_education", "medical_ethics", "nephrology",
    "neurology", "nursing", "nutrition", "obstetrics_and_gynecology", "occupational_and_environmental_health", "oncology", "ophthalmology",
    "orthopedics", "otolaryngology", "pain_medicine", "palliative_medicine", "pathology", "pediatrics", "pharmacology_and_therapeutics",
    "primary_care_research", "psychiatry_and_clinical_psychology", "public_and_global_health", "radiology_and_imaging",
    "rehabilitation_medicine_and_physical_therapy", "respiratory_medicine", "rheumatology", "sexual_and_reproductive_health",
    "sports_medicine", "surgery", "toxicology", "transplantation", "urology",
)


def category_key(name: str) -> str:
    return name.lower().replace(" ", "_").replace("-", "_")


def preprint_category(name: Column, server: str) -> Column:
    """A category in the form that the server's service takes, null for what its vocabulary doesn't have."""
    key = F.translate(F.lower(name), " -", "__")
    return F.when(key.isin(*(BIORXIV if server == "biorxiv" else MEDRXIV)), key)


def chemrxiv_categories(names: tuple[str, ...] | list[str]) -> list[int]:
    """Ids of named categories; unknown names are left out."""
    return [CHEMRXIV[k] for n in names if (k := category_key(n)) in CHEMRXIV]


def chemrxiv_category(name: Column) -> Column:
    """The same on a column: null for unknown names."""
    table = F.create_map(*[F.lit(x) for kv in CHEMRXIV.items() for x in kv])
    return F.try_element_at(table, F.translate(F.lower(name), " -", "__"))
