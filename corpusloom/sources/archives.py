"""Members of archives as rows, read by tasks: plain archives are split between members, compressed ones are streamed.

No archive is ever one value of a row: the files are listed by Spark without their content, and tasks open them through
Arrow's file systems. An archive that ends too early or isn't one tells so in a row of its own.
"""

from __future__ import annotations

import gzip
import io
import re
import tarfile
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of member bodies in a batch of rows, and in a range of a plain archive that one task reads.
BATCH_BYTES, RANGE_BYTES = 8 << 20, 64 << 20
#: Members in a batch of rows, and rows of a batch that are Python's at once.
BATCH_ROWS, SLICE = 4096, 64
MEMBER = "path string, name string, size bigint, body binary, error string"
_MEMBER = pa.schema([("path", pa.string()), ("name", pa.string()), ("size", pa.int64()), ("body", pa.binary()), ("error", pa.string())])
_INDEX = "path string, name string, size bigint, offset bigint, error string"


def broken(e: BaseException) -> str:
    return f"{type(e).__name__}: {e}" if str(e) else type(e).__name__


def members_of(path: str, opened: Callable[[], tarfile.TarFile], bodies: bool = True) -> Iterator[dict]:
    """Rows of an archive's files in its order: ``path, name, size, body, offset, error``. What makes it unreadable comes as
    a last row with ``error``, after all members that are whole."""
    row = {"path": path, "name": None, "size": None, "body": None, "offset": None, "error": None}
    try:
        with opened() as tar:
            for m in tar:
                if m.isfile():
                    body = tar.extractfile(m).read() if bodies else None
                    if body is not None and len(body) < m.size:
                        raise EOFError(f"{m.name} ends after {len(body)} of {m.size} bytes")
                    yield row | {"name": m.name, "size": m.size, "body": body, "offset": m.offset_data}
            if not _ended(tar):
                raise EOFError("no end of archive")
    except (tarfile.TarError, EOFError, OSError, ValueError) as e:
        yield row | {"error": broken(e)}


def _ended(tar: tarfile.TarFile) -> bool:
    """Whether a block of zeros ended the archive, which was read then: at a bare end of file nothing was."""
    return tar.fileobj.tell() > tar.offset


def batched(rows: Iterator[dict]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for r in rows:
        held.append({k: r[k] for k in _MEMBER.names})
        size += len(r["body"] or b"")
        if size >= BATCH_BYTES or len(held) >= BATCH_ROWS:
            yield pa.RecordBatch.from_pylist(held, _MEMBER)
            held, size = [], 0
    yield pa.RecordBatch.from_pylist(held, _MEMBER)


def packed(members: Iterable[tuple[str, bytes]], compressed: bool = False) -> bytes:
    """A small archive as a value. It is compressed as a whole: files of gzip hold themselves, and their buffers of some
    hundred KB would stay until Python looks for such circles."""
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w") as tar:
        for name, body in members:
            info = tarfile.TarInfo(name)
            info.size = len(body)
            tar.addfile(info, io.BytesIO(body))
    return gzip.compress(out.getvalue()) if compressed else out.getvalue()


def rows_of(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    """Rows of batches, of which only some at once are Python's."""
    for b in batches:
        for i in range(0, b.num_rows, SLICE):
            yield from b.slice(i, SLICE).to_pylist()


def _opened(path: str, seekable: bool):  # noqa: ANN202
    """A file of any system that Arrow knows. Spark writes local paths with one slash."""
    from pyarrow import fs

    where, name = fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", path))
    return where.open_input_file(name) if seekable else where.open_input_stream(name, compression=None)


def in_values(archives: DataFrame) -> DataFrame:
    """``path, content`` to MEMBER, for small archives that are values of rows already."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[dict]:
            for b in batches:
                for path, content in zip(b["path"], b["content"], strict=True):
                    data = content.as_py()
                    if data is not None:
                        yield from members_of(path.as_py(), lambda data=data: tarfile.open(fileobj=io.BytesIO(data), mode="r:*"))

        yield from batched(rows())

    return archives.select("path", "content").mapInArrow(run, MEMBER)


def archive_files(spark: SparkSession, *paths: str) -> DataFrame:
    """``path, length`` of the archives at paths, folders or patterns; contents aren't read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(list(paths))
    return found.select("path", "length").where(F.lower("path").rlike(r"[.](tar([.](gz|bz2|xz))?|tgz|tbz2|txz)\z"))


def index(plain: DataFrame) -> DataFrame:
    """``path, name, size, offset, error`` of the members of plain archives: only their headers are read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("path", pa.string()), ("name", pa.string()), ("size", pa.int64()), ("offset", pa.int64()), ("error", pa.string())])
        for b in batches:
            for path, length in zip(b["path"].to_pylist(), b["length"].to_pylist(), strict=True):
                held = []
                for r in members_of(path, lambda path=path: tarfile.open(fileobj=_opened(path, True), mode="r:"), bodies=False):
                    if r["name"] is not None and r["offset"] + r["size"] > length:
                        r |= {"name": None, "size": None, "offset": None, "error": f"EOFError: {r['name']} ends beyond {length} bytes"}
                    held.append({k: r[k] for k in schema.names})
                    if r["error"]:
                        break
                    if len(held) >= 10_000:
                        yield pa.RecordBatch.from_pylist(held, schema)
                        held = []
                yield pa.RecordBatch.from_pylist(held, schema)

    return plain.repartition("path").mapInArrow(run, _INDEX)


def members(spark: SparkSession, *paths: str, only: str | None = None) -> DataFrame:
    """MEMBER rows of all archives at ``paths``. ``only`` is a pattern that names must match: of plain archives nothing
    else is read. Plain archives are split into ranges of about RANGE_BYTES by their index, each range is a task's; a
    compressed one is streamed by one task, member after member."""
    found = archive_files(spark, *paths)
    wanted = F.lit(True) if only is None else F.col("name").rlike(only)
    plain = F.lower("path").endswith(".tar")

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path in b["path"].to_pylist():
                yield from batched(members_of(path, lambda path=path: tarfile.open(fileobj=_opened(path, False), mode="r|*")))

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[dict]:
            at, file = None, None
            for b in batches:
                for r in b.to_pylist():
                    if r["path"] != at:
                        at, file = r["path"], _opened(r["path"], True)
                    file.seek(r["offset"])
                    yield {"path": at, "name": r["name"], "size": r["size"], "body": file.read(r["size"]), "error": None}

        yield from batched(rows())

    streamed = found.where(~plain).repartition("path").mapInArrow(stream, MEMBER)
    listed = index(found.where(plain))
    piece = F.floor(F.col("offset") / RANGE_BYTES)
    dealt = listed.where(F.col("error").isNull() & wanted).repartition("path", piece).sortWithinPartitions("path", "offset")
    read = dealt.mapInArrow(ranges, MEMBER)
    failed = listed.where("error is not null").select("path", "name", "size", F.lit(None).cast("binary").alias("body"), "error")
    return streamed.where(wanted | F.col("error").isNotNull()).union(read).union(failed)


def write_parts(rows: DataFrame, uri: str, parts: int = 8, documents: dict[str, dict] | None = None, folder: str = ".provenance") -> DataFrame:
    """Writes ``name, body`` rows to ``parts`` compressed archives below ``uri``, each by one task: ``archive, files, bytes``.

    Rows are dealt by name and written in its order, so the same rows give the same archives; of rows of one name each is
    kept, numbered. Every archive has the JSON documents about the whole in ``folder``. An archive appears whole or not at
    all, whichever attempt of a task ends first."""
    import json
    import uuid

    extra = [(f"{folder}/{k}.json", json.dumps(v, indent=2, sort_keys=True).encode()) for k, v in (documents or {}).items()]
    told = pa.schema([("archive", pa.string()), ("files", pa.int64()), ("bytes", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        from pyspark import TaskContext

        where, root = fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", uri))
        where.create_dir(root, recursive=True)
        name = f"part-{TaskContext.get().partitionId():05d}.tar.gz"
        temp, last, again, files, size = f"{root}/.{name}-{uuid.uuid4().hex}", None, 0, 0, 0
        with where.open_output_stream(temp, compression=None) as out, tarfile.open(fileobj=out, mode="w|gz") as tar:

            def add(as_name: str, body: bytes) -> None:
                info = tarfile.TarInfo(as_name)
                info.size = len(body)
                tar.addfile(info, io.BytesIO(body))

            for b in batches:
                for own, body in zip(b["name"].to_pylist(), b["body"], strict=True):
                    again, last = (again + 1, own) if own == last else (0, own)
                    stem, dot, suffix = own.rpartition(".")
                    data = body.as_py() or b""
                    add(own if not again else f"{stem}-{again}{dot}{suffix}" if dot else f"{own}-{again}", data)
                    files, size = files + 1, size + len(data)
            for as_name, data in extra:
                add(as_name, data)
        where.move(temp, f"{root}/{name}")
        yield pa.RecordBatch.from_pylist([{"archive": name, "files": files, "bytes": size}], told)

    dealt = rows.select("name", "body").repartitionById(parts, F.pmod(F.xxhash64("name"), F.lit(parts)).cast("int")).sortWithinPartitions("name")
    return dealt.mapInArrow(run, "archive string, files bigint, bytes bigint")
