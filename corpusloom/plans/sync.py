"""Bringing a mirror of remote files up to date."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators import graph, mirror
from corpusloom.operators.commits import KeyedTable

MANIFEST = "accession_id string, filename string, subset string, size_bytes bigint, sha256 string, source_updated string"
#: Files after which the manifest is saved.
EVERY = 100


@dataclass
class Synced:
    downloaded: int = 0
    bytes: int = 0
    failed: tuple[str, ...] = ()
    #: Why a file failed, where it is known.
    reasons: dict[str, str] = field(default_factory=dict)


class Mirror:
    """Files below ``root`` and the manifest of what is there, a table in hash buckets: a save writes the buckets of its
    entries anew and commits them at once, so a run that is lost loses what came after its last save, no more."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.entries = KeyedTable(spark, f"{self.root}/manifest", MANIFEST, "accession_id")

    def _fs(self):
        jvm = self.spark._jvm.org.apache.hadoop.fs
        return jvm.Path(self.root).getFileSystem(self.spark._jsc.hadoopConfiguration()), jvm.Path

    def manifest(self) -> DataFrame:
        return self.entries.table()

    def save(self, done: list[tuple] | DataFrame) -> list[int]:
        """Puts in or replaces entries; returns the buckets that were written."""
        rows = done if isinstance(done, DataFrame) else self.spark.createDataFrame(done, MANIFEST)
        return self.entries.upsert(rows)

    def take_in(self, remote: DataFrame) -> DataFrame:
        """Files that are there already but not in the manifest, with the remote entry of their name if any; matched ones
        are put into the manifest. Returns ``filename, accession_id, matched``."""
        here = self.files()
        known = graph._write(self.spark, mirror.imported(here, remote))
        entry = remote.select("accession_id", "subset", "last_updated").dropDuplicates(["accession_id"])
        rows = known.where("matched").join(here, "filename").join(entry, "accession_id")
        self.save(rows.select("accession_id", "filename", "subset", F.col("length").alias("size_bytes"), F.lit(None).cast("string").alias("sha256"), F.col("last_updated").alias("source_updated")))
        return known

    def pending(self, remote: DataFrame) -> DataFrame:
        return mirror.updates(remote, self.manifest())

    def sync(self, remote: DataFrame, fetch: Callable[[str], "bytes | None"], limit: int | None = None) -> Synced:
        """Downloads what is new or newer: ``remote`` has ``accession_id, filename, subset, last_updated``, ``fetch`` gives a
        file's bytes. One after the other, as the remote side allows; a file that fails doesn't stop the others."""
        todo = self.pending(remote).orderBy("filename")
        out, done, failed = Synced(), [], []
        fs, path = self._fs()
        for r in (todo.limit(limit) if limit is not None else todo).toLocalIterator():
            try:
                if ".." in r.filename.split("/") or r.filename.startswith("/"):
                    raise ValueError("a name that leads out of the mirror")
                body = fetch(r.filename)
            except Exception as e:  # noqa: BLE001
                body, out.reasons[r.filename] = None, str(e) or type(e).__name__
            if body is None:
                failed.append(r.filename)
                continue
            part, whole = path(f"{self.root}/files/{r.filename}.part"), path(f"{self.root}/files/{r.filename}")
            with_stream = fs.create(part, True)
            with_stream.write(bytearray(body))
            with_stream.close()
            fs.delete(whole, False)
            fs.rename(part, whole)
            done.append((r.accession_id, r.filename, r.subset, len(body), hashlib.sha256(body).hexdigest(), r.last_updated))
            out.downloaded, out.bytes = out.downloaded + 1, out.bytes + len(body)
            if len(done) >= EVERY:
                self.save(done)
                done = []
        if done:
            self.save(done)
        out.failed = tuple(failed)
        return out

    def files(self) -> DataFrame:
        """``filename, length`` of what is there."""
        fs, path = self._fs()
        schema = "filename string, length bigint"
        if not fs.exists(path(f"{self.root}/files")):
            return self.spark.createDataFrame([], schema)
        found = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{self.root}/files")
        return found.select(F.regexp_extract("path", r"/files/(.*)\z", 1).alias("filename"), "length")

    def verify(self) -> DataFrame:
        return mirror.verify(self.manifest(), self.files())

    def status(self) -> DataFrame:
        return mirror.status(self.manifest())
