"""Files as tables: id lists, file lists, article trees, archives, JSON state."""

from __future__ import annotations

import io
import json
import tarfile
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.ids import detect_id_type, filled, manifest_entry_id, normalize_id, path_stem
from corpusloom.operators.compare import parse_ids
from corpusloom.sources.archives import in_values, members

ARCHIVES = (".tar.gz", ".tgz", ".tar.bz2", ".tbz2", ".tar.xz", ".txz", ".tar")


def id_list(spark: SparkSession, path: str) -> DataFrame:
    return parse_ids(spark.read.text(path))


def file_list(spark: SparkSession, path: str, subset: str) -> DataFrame:
    """The CSV of a mirror's files; rows without a file or an accession go."""
    names = {"File": "filename", "Article Citation": "citation", "Accession ID": "accession_id", "PMID": "pmid", "License": "license"}
    raw = spark.read.csv(path, header=True, escape='"')
    last = next((c for c in raw.columns if c.startswith("Last Updated")), None)
    cols = [(F.col(f"`{k}`") if k in raw.columns else F.lit(None).cast("string")).alias(v) for k, v in names.items()]
    last = F.col(f"`{last}`") if last else F.lit(None).cast("string")
    out = raw.select(*cols, last.alias("last_updated"), F.try_to_timestamp(last, F.lit("yyyy-MM-dd HH:mm:ss")).alias("last_updated_ts"), F.lit(subset).alias("subset"))
    return out.where(filled("filename").isNotNull() & filled("accession_id").isNotNull())


def file_lists(spark: SparkSession, paths: dict[str, str]) -> tuple[DataFrame | None, dict[str, str]]:
    """The union of the lists that can be read, and why the others can't."""
    out, failed = None, {}
    for subset, path in paths.items():
        try:
            one = file_list(spark, path, subset)
        except Exception as e:  # noqa: BLE001
            failed[subset] = str(e).splitlines()[0]
            continue
        out = one if out is None else out.unionByName(one)
    return out, failed


def tree(spark: SparkSession, paths: list[str], pattern: str = "*.xml", include_incomplete: bool = False) -> DataFrame:
    """``path, length, modificationTime, content`` of files below folders, each once; folders that aren't there are
    skipped, and files below a folder ``incomplete`` unless asked for."""
    conf, there = spark._jsc.hadoopConfiguration(), []
    for p in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(p)
        if at.getFileSystem(conf).exists(at):
            there.append(p)
    if not there:
        return spark.createDataFrame([], "path string, modificationTime timestamp, length bigint, content binary")
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(there)
    if not include_incomplete:
        found = found.where(~F.array_contains(F.split("path", "/"), "incomplete"))
    return found.dropDuplicates(["path"]) if len(there) > 1 else found


def pdfs(spark: SparkSession, root: str, only: tuple[str, ...] = ()) -> DataFrame:
    """PDF files below a folder in any case of the suffix, or those of the given names."""
    found = tree(spark, [root], "*.[pP][dD][fF]", include_incomplete=True)
    return found.where(F.lower(F.regexp_extract("path", r"([^/]+)\z", 1)).isin([n.lower() for n in only])) if only else found


def tar_members(archives: DataFrame) -> DataFrame:
    """``path, content`` to ``path, name, size, body, error``."""
    return in_values(archives)


_FILE = "struct<pmcid: string, doi: string, path: string, filename: string>"
_MANIFEST = f"struct<files: array<{_FILE}>, articles: array<{_FILE}>, per_source: map<string, struct<articles: array<{_FILE}>, files: array<{_FILE}>>>>"


def archive_ids(members: DataFrame) -> DataFrame:
    """``path, id, id_type`` of archives: from the first member that ends in ``manifest.json``, in any of its three forms;
    if that gives no id, the stems of XML members. Repeats stay."""
    first = members.where(F.col("name").endswith("manifest.json")).groupBy("path").agg(F.min_by(F.col("body").cast("string"), "name").alias("json"))
    m = first.select("path", F.from_json("json", _MANIFEST).alias("m"))
    empty = F.array().cast(f"array<{_FILE}>")
    nested = F.flatten(F.transform(F.map_values("m.per_source"), lambda s: F.concat(F.coalesce(s["articles"], empty), F.coalesce(s["files"], empty))))
    entries = m.select("path", F.explode(F.concat(F.coalesce("m.files", empty), F.coalesce("m.articles", empty), F.coalesce(nested, empty))).alias("e"))
    listed = entries.select("path", manifest_entry_id("e.pmcid", "e.doi", F.coalesce(filled("e.path"), F.col("e.filename"))).alias("id")).where("id is not null")
    stems = members.where(F.col("name").endswith(".xml")).join(listed.select("path").distinct(), "path", "left_anti").select("path", normalize_id(path_stem("name")).alias("id"))
    return listed.union(stems).select("path", "id", detect_id_type("id").alias("id_type"))


def corpus_ids(spark: SparkSession, path: str) -> DataFrame:
    """``id, id_type`` of an archive or an id list, by the suffix."""
    if path.lower().endswith(ARCHIVES):
        return archive_ids(members(spark, path)).select("id", "id_type")
    return id_list(spark, path)


def archive_documents(members: DataFrame, folder: str = ".provenance") -> DataFrame:
    """``path, name, json`` of the provenance documents in archives."""
    inside = F.col("name").rlike(rf"(^|/){folder.replace('.', '[.]')}/[^/]+[.]json\z")
    return members.where(inside).select("path", path_stem("name").alias("name"), F.col("body").cast("string").alias("json"))


def json_state(spark: SparkSession, path: str, schema: str, strict: bool = False) -> DataFrame:
    """Rows of a JSON document; of one that is corrupt or isn't there none, unless ``strict``."""
    mode = "FAILFAST" if strict else "DROPMALFORMED"
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not strict and not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(path, multiLine=True, mode=mode)


def write_archive(rows: Iterator, path: str, documents: dict[str, dict], folder: str = ".provenance", compression: str = "gz") -> dict:
    """Writes ``name, body`` rows (of ``toLocalIterator()``) and JSON documents about them to an archive on the driver.
    Names that repeat get a number, so none is lost. It appears whole or not at all."""
    import os

    seen: dict[str, int] = {}
    stats = {"files": 0, "bytes": 0}
    temp = f"{path}.part"
    with tarfile.open(temp, f"w:{compression}" if compression != "none" else "w") as tar:

        def add(name: str, body: bytes) -> None:
            info = tarfile.TarInfo(name)
            info.size = len(body)
            tar.addfile(info, io.BytesIO(body))

        for r in rows:
            n = seen[r.name] = seen.get(r.name, -1) + 1
            stem, dot, suffix = r.name.rpartition(".")
            add(r.name if not n else f"{stem}-{n}{dot}{suffix}", bytes(r.body))
            stats["files"] += 1
            stats["bytes"] += len(r.body)
        for name, doc in documents.items():
            add(f"{folder}/{name}.json", json.dumps(doc, indent=2, sort_keys=True).encode())
    os.replace(temp, path)
    return stats


#: Folders of a corpus that never go into an archive of it.
CONTROL = ("valid", "incomplete", "_duplicates")


def archive_folder(root: str, path: str, exclude: tuple[str, ...] = CONTROL, compression: str = "gz") -> int:
    """Archives the files of a local folder, in order of their names, without those of control folders. Returns how many.
    The archive appears whole or not at all."""
    import os
    from pathlib import Path

    top, n = Path(root), 0
    with tarfile.open(f"{path}.part", f"w:{compression}" if compression != "none" else "w") as tar:
        for p in sorted(x for x in top.rglob("*") if x.is_file()):
            name = p.relative_to(top)
            if name.parts[0] not in exclude:
                tar.add(p, str(name))
                n += 1
    os.replace(f"{path}.part", path)
    return n


def embed_documents(path: str, documents: dict[str, dict], folder: str = ".provenance") -> int:
    """Puts JSON documents into an existing archive, in place of those that it has in ``folder``; members stay as they
    are. Returns how many members stayed. A broken archive raises and stays."""
    import os

    kept = 0
    mode = "gz" if path.endswith("gz") else "xz" if path.endswith("xz") else "bz2" if path.endswith("bz2") else ""
    with tarfile.open(path) as old, tarfile.open(f"{path}.part", f"w:{mode}") as new:
        for m in old:
            if not m.name.startswith(f"{folder}/"):
                new.addfile(m, old.extractfile(m) if m.isfile() else None)
                kept += 1
        for name, doc in documents.items():
            body = json.dumps(doc, indent=2, sort_keys=True).encode()
            info = tarfile.TarInfo(f"{folder}/{name}.json")
            info.size = len(body)
            new.addfile(info, io.BytesIO(body))
    os.replace(f"{path}.part", path)
    return kept
