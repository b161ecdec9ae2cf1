"""Functions for SQL: registered in a session, they can be called from any query text."""

from __future__ import annotations

import importlib
from collections.abc import Callable, Iterator

from pyspark.sql import Row, SparkSession
from pyspark.sql import types as T
from pyspark.sql.functions import udtf
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from corpusloom.functions import text, xml
from corpusloom.sources.archives import members_of

#: Scalar functions by their names in SQL.
SCALAR = {
    "clean_text": text.clean_text, "clean_ascii": text.clean_ascii, "validate_jats": xml.validate_jats, "jats_facts": xml.jats_facts,
    "jats_doi": xml.jats_doi, "tei_metadata": xml.tei_fields, "tei_to_jats": xml.jats_of_tei,
}
RESULT = [T.StructField("status", T.StringType()), T.StructField("body_chars", T.IntegerType()), T.StructField("errors", T.ArrayType(T.StringType()))]
NAMES = frozenset(f.name for f in RESULT)
JATS = "corpusloom.functions.xml:facts"


def loaded(name: str) -> Callable[[str | None], dict]:
    """A validator by ``module:function``: from a text to a dict with ``status``, ``body_chars`` and ``errors``."""
    module, colon, attribute = name.partition(":")
    found = getattr(importlib.import_module(module), attribute, None) if colon else None
    if not callable(found):
        raise ValueError(f"not a validator as module:function: {name!r}")
    return found


@udtf
class ValidateWith:
    """``validate_with(table, column, validator)``: the rows of any table with ``status, body_chars, errors`` of the text in
    a column, by any validator that executors can import. The schema follows the table's."""

    @staticmethod
    def analyze(table: AnalyzeArgument, column: AnalyzeArgument, validator: AnalyzeArgument) -> AnalyzeResult:
        fields = [f for f in table.dataType.fields if f.name not in NAMES]
        if column.value not in table.dataType.names:
            raise ValueError(f"the table has no column {column.value!r}")
        loaded(validator.value)
        return AnalyzeResult(T.StructType([*fields, *RESULT]))

    def __init__(self) -> None:
        self.validators: dict[str, Callable] = {}

    def eval(self, row: Row, column: str, validator: str) -> Iterator[tuple]:
        judge = self.validators.setdefault(validator, loaded(validator))
        found = judge(row[column])
        kept = [v for k, v in row.asDict().items() if k not in NAMES]
        yield (*kept, found["status"], found["body_chars"], found["errors"])


@udtf(returnType="name string, size bigint, body binary, error string")
class ArchiveMembers:
    """``archive_members(content)``: files of an archive, and why it can't be read on if it can't."""

    def eval(self, content: bytes) -> Iterator[tuple]:
        import io
        import tarfile

        if content is not None:
            for r in members_of("", lambda: tarfile.open(fileobj=io.BytesIO(bytes(content)), mode="r:*")):
                yield r["name"], r["size"], r["body"], r["error"]


def register(spark: SparkSession) -> None:
    """Makes the functions known to a session's SQL."""
    for name, f in SCALAR.items():
        spark.udf.register(name, f)
    spark.udtf.register("validate_with", ValidateWith)
    spark.udtf.register("archive_members", ArchiveMembers)
