"""Compression of vectors to codes of 8 bits a part (product quantisation), trained by Lloyd's method with heaps.

Between two rounds an entry moves by its drift. A part that has an upper bound of the distance to its own entry and a
lower bound of that to all others keeps its entry as long as the upper bound stays below the lower one, so a part is
touched again only when the drifts since its last scan have used up its slack, lower minus upper. Each block of vectors
keeps one heap for each entry of each part position, whose key is the slack plus the drifts that the entry had seen by
then: an entry pops keys up to the drifts that it has seen now and leaves the rest of its heap alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.scratch import Scratch, bound_batches, lean
from corpusloom.llm.vectors import valid_rows

#: Vectors of a block, whose heaps are one row of a table.
BLOCK = 1 << 13
#: Slack below which a bound is not trusted: more than the rounding of square roots and sums of drifts of a round.
MARGIN = 1e-6
#: A label that holds more than one in so many rows is joined by broadcast: there are fewer than so many of them.
HOT = 1000

_BLOCKS = "ids binary, labels binary, parts binary, codes binary, heap binary, keys binary, popped bigint"
_ARROW = pa.schema([(k, pa.binary()) for k in ("ids", "labels", "parts", "codes", "heap", "keys")] + [("popped", pa.int64())])
_SUMS = "entry int, n bigint, sums array<bigint>"


class Codebooks(NamedTuple):
    """Entries of every part position, ``(positions, entries, width)`` integers, and what the heaps need of them."""

    entries: np.ndarray
    #: For each position and entry, what its parts' slack has lost so far: its own drift and the largest of the others.
    lost: np.ndarray

    @classmethod
    def first(cls, vectors: np.ndarray, positions: int) -> Codebooks:
        entries = np.ascontiguousarray(vectors.reshape(len(vectors), positions, -1).swapaxes(0, 1))
        return cls(entries, np.zeros(entries.shape[:2]))

    def moved(self, sums: np.ndarray, n: np.ndarray) -> Codebooks:
        """Entries become the floor of their parts' means; unused ones stay."""
        entries = np.where(n[:, :, None] > 0, sums // np.maximum(n, 1)[:, :, None], self.entries)
        drift = np.sqrt(((entries - self.entries).astype(np.float64) ** 2).sum(axis=2))
        largest = np.sort(drift, axis=1)[:, ::-1]
        others = np.repeat(largest[:, :1], drift.shape[1], axis=1)
        if drift.shape[1] > 1:
            others[np.arange(len(drift)), drift.argmax(axis=1)] = largest[:, 1]
        # Rounded up: the heaps may pop a part too much, never one too few.
        return Codebooks(entries, (self.lost + drift + others) * (1 + 1e-12))

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def distances(parts: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of all pairs, exact: in doubles where no term can leave their 53 bits, else in integers."""
    largest = max(int(np.abs(parts).max(initial=0)), int(np.abs(entries).max(initial=0)))
    if 4 * parts.shape[1] * largest * largest < 1 << 53:
        a, b = parts.astype(np.float64), entries.astype(np.float64)
        return (a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)
    out = np.zeros((len(parts), len(entries)), np.int64)
    for i in range(parts.shape[1]):
        out += (parts[:, i, None].astype(np.int64) - entries[None, :, i]) ** 2
    return out


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each part's nearest entry (ties: the lower index) and its slack: how much farther the second nearest is."""
    codes, slack = np.empty(len(parts), np.int64), np.full(len(parts), np.inf)
    for i in range(0, len(parts), 4096):
        d = distances(parts[i : i + 4096], entries)
        rows = np.arange(len(d))
        own = d.argmin(axis=1)
        codes[i : i + 4096] = own
        if len(entries) > 1:
            best = np.sqrt(d[rows, own].astype(np.float64))
            d = d.astype(np.float64)
            d[rows, own] = np.inf
            slack[i : i + 4096] = np.sqrt(d.min(axis=1)) - best - MARGIN * (1 + best)
    return codes, slack


class Heaps:
    """The heaps of a block at one position: a run of part numbers for each entry, ascending by key.

    An ascending run is a heap whose top is its first element; what must be popped is a prefix, and what comes back is
    merged in by key.
    """

    def __init__(self, codes: np.ndarray, heap: np.ndarray, keys: np.ndarray, entries: int):
        self.codes, self.heap, self.keys, self.entries = codes, heap, keys, entries

    @classmethod
    def built(cls, parts: np.ndarray, books: Codebooks, at: int) -> Heaps:
        codes, slack = nearest(parts, books.entries[at])
        keys = slack + books.lost[at][codes]
        order = np.lexsort((keys, codes))
        return cls(codes.astype(np.uint8), order.astype(np.int32), keys[order], len(books.entries[at]))

    def run(self, parts: np.ndarray, books: Codebooks, at: int) -> int:
        """Pops what the drifts have violated, scans it exactly and puts it back; returns how many parts that were."""
        ends = np.cumsum(np.bincount(self.codes, minlength=self.entries))
        begins = ends - np.diff(np.r_[0, ends])
        popped = [np.arange(b, b + np.searchsorted(self.keys[b:e], lost, "right")) for b, e, lost in zip(begins, ends, books.lost[at], strict=True) if e > b]
        places = np.concatenate(popped) if popped else np.empty(0, np.int64)
        if not len(places):
            return 0
        who = self.heap[places]
        codes, slack = nearest(parts[who], books.entries[at])
        self.codes[who] = codes
        heap, keys = np.delete(self.heap, places), np.delete(self.keys, places)
        heap, keys = np.r_[heap, who], np.r_[keys, slack + books.lost[at][codes]]
        order = np.lexsort((keys, self.codes[heap]))
        self.heap, self.keys = heap[order], keys[order]
        return len(places)


def _opened(r: dict, positions: int, width: int, kind: str) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray], list[np.ndarray]]:
    x = np.frombuffer(r["parts"], kind).reshape(positions, -1, width)
    n = x.shape[1]
    split = lambda name, t: list(np.frombuffer(r[name], t).reshape(positions, n).copy())
    return x, split("codes", np.uint8), split("heap", np.int32), split("keys", np.float64)


def _integers(column: pa.Array, scale: int, length: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the kept vectors and their integer components, filled with zeros up to ``length``."""
    at, x = valid_rows(column, np.ones(len(column), bool))
    x = np.floor(scale * x)
    if len(x) and np.abs(x).max(initial=0) > most:
        raise ValueError(f"a component beyond {most / scale:g}: squared distances would not fit 63 bits")
    return at, np.pad(x.astype(np.int64), ((0, 0), (0, max(0, length - x.shape[1]))))[:, :length]


def compress(vectors: DataFrame, scale: int = 1024, positions: int = 4, entries: int = 256, rounds: int = 4) -> DataFrame:
    """``vec_id, embedding, label`` to ``vec_id, code, error, label_error, codebooks_sha256``; other columns are ignored.

    Components become ``floor(scale * x)``; vectors are cut into ``positions`` equal consecutive parts, each coded by the
    nearest of at most ``entries`` (up to 256) integer entries, which start as the parts of the vectors of smallest id
    and are moved ``rounds`` times to the floor of their parts' mean. All decisions are exact: the bounds only tell which
    parts can't have changed. Each round reads a table of blocks (vectors, codes, heaps) and writes the next, so that a
    lost executor costs a round's tasks; what reaches the driver is one sum for each entry.

    Rows with a null vector, or one with a null or non-finite component, are dropped. Shorter vectors count as filled
    with zeros up to the longest, and that up to a multiple of ``positions``. Rows that repeat an id count each; for the
    first entries they are ordered by their components; null ids come last there and stay null. Null labels are summed
    together. With fewer vectors than ``entries``, codebooks are smaller; an empty table gives no rows. Components too
    large for squared distances of 63 bits are an error.
    """
    if not 0 < entries <= 256:
        raise ValueError("codes have 8 bits: 1 to 256 entries")
    spark = vectors.sparkSession
    bound_batches(spark)
    scratch = Scratch(spark, "codes")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    kept = vectors.select("vec_id", "embedding", "label").where(F.col("embedding").isNotNull() & finite)
    facts = kept.agg(F.max(F.size("embedding")), F.max(F.array_max(F.transform("embedding", lambda x: F.abs(F.floor(scale * x.cast("double")).cast("double")))))).first()
    empty = spark.createDataFrame([], f"vec_id {kept.schema['vec_id'].dataType.simpleString()}, code string, error bigint, label_error bigint, codebooks_sha256 string")
    if facts[0] is None:
        return empty
    width = max(1, -(-facts[0] // positions))
    length, kind = width * positions, "<i2" if (facts[1] or 0) < 1 << 15 else "<i4" if (facts[1] or 0) < 1 << 31 else "<i8"
    most = int(((1 << 61) / length) ** 0.5 / 2)

    def block(ids: pa.Array, labels: pa.Array, x: np.ndarray, books: Codebooks) -> dict:
        own = np.ascontiguousarray(x.reshape(len(x), positions, width).swapaxes(0, 1))
        heaps = [Heaps.built(own[p], books, p) for p in range(positions)]
        return {"ids": _stream(ids), "labels": _stream(labels), "parts": own.astype(kind).tobytes()} | packed(heaps)

    def packed(heaps: list[Heaps]) -> dict:
        return {"codes": b"".join(h.codes.tobytes() for h in heaps), "heap": b"".join(h.heap.astype(np.int32).tobytes() for h in heaps), "keys": b"".join(h.keys.tobytes() for h in heaps)}

    def summed(x: np.ndarray, codes: list[np.ndarray], n: np.ndarray, sums: np.ndarray) -> None:
        for p in range(positions):
            n[p] += np.bincount(codes[p], minlength=n.shape[1])
            order = np.argsort(codes[p], kind="stable")
            used, first = np.unique(codes[p][order], return_index=True)
            if len(used):
                sums[p, used] += np.add.reduceat(x[p][order].astype(np.int64), first, axis=0)

    id_type, label_type = kept.schema["vec_id"].dataType.simpleString(), kept.schema["label"].dataType.simpleString()

    def pack(books: Codebooks):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                at, x = _integers(batch["embedding"], scale, length, most)
                for i in range(0, len(at), BLOCK):
                    some = pa.array(at[i : i + BLOCK])
                    row = block(batch["vec_id"].take(some), batch["label"].take(some), x[i : i + BLOCK], books)
                    yield pa.RecordBatch.from_pylist([row | {"popped": len(some) * positions}], _ARROW)

        return run

    def advance(books: Codebooks):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for r in batch.to_pylist():
                    x, codes, heap, keys = _opened(r, positions, width, kind)
                    heaps = [Heaps(codes[p], heap[p], keys[p], books.entries.shape[1]) for p in range(positions)]
                    popped = sum(h.run(x[p], books, p) for p, h in enumerate(heaps))
                    yield pa.RecordBatch.from_pylist([r | packed(heaps) | {"popped": popped}], _ARROW)

        return run

    def totals(size: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            n, sums = np.zeros((positions, size), np.int64), np.zeros((positions, size, width), np.int64)
            for batch in batches:
                for r in batch.to_pylist():
                    x = np.frombuffer(r["parts"], kind).reshape(positions, -1, width)
                    summed(x, list(np.frombuffer(r["codes"], np.uint8).reshape(positions, -1)), n, sums)
            used = np.flatnonzero(n.ravel())
            yield pa.record_batch({"entry": pa.array(used.astype(np.int32)), "n": pa.array(n.ravel()[used]), "sums": pa.array(list(sums.reshape(-1, width)[used]), pa.list_(pa.int64()))})

        return run

    def means(table: DataFrame, books: Codebooks) -> Codebooks:
        """The sums of each entry: one row a task and entry, added up by Spark, then one a entry for the driver."""
        size = books.entries.shape[1]
        partial = table.select("parts", "codes").mapInArrow(lean(totals(size)), _SUMS)
        rows = partial.groupBy("entry").agg(F.sum("n").alias("n"), *[F.sum(F.get("sums", F.lit(i))).alias(f"s{i}") for i in range(width)]).collect()
        n, sums = np.zeros(positions * size, np.int64), np.zeros((positions * size, width), np.int64)
        for r in rows:
            n[r["entry"]], sums[r["entry"]] = r["n"], r[2:]
        return books.moved(sums.reshape(positions, size, width), n.reshape(positions, size))

    smallest = kept.select("vec_id", "embedding").orderBy(F.asc_nulls_last("vec_id"), "embedding").limit(entries).collect()
    first = _integers(pa.array([r.embedding for r in smallest], pa.list_(pa.float64())), scale, length, most)[1]
    books = Codebooks.first(first, positions)
    table = scratch.save(kept.mapInArrow(lean(pack(books)), _BLOCKS), "round0")
    for i in range(1, rounds + 1):
        books = means(table, books)
        table = scratch.save(table.mapInArrow(lean(advance(books)), _BLOCKS), f"round{i}")
        scratch.drop(f"round{i - 1}")

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                x, codes, _, _ = _opened(r, positions, width, kind)
                error = sum(((x[p].astype(np.int64) - books.entries[p][codes[p]]) ** 2).sum(axis=1) for p in range(positions))
                text = np.ascontiguousarray(np.stack(codes, axis=1)).tobytes().hex()
                step = 2 * positions
                yield pa.record_batch({
                    "vec_id": _column(r["ids"]), "label": _column(r["labels"]),
                    "code": pa.array([text[i : i + step] for i in range(0, len(text), step)], pa.string()), "error": pa.array(error),
                })

    found = scratch.save(table.mapInArrow(lean(coded), f"vec_id {id_type}, label {label_type}, code string, error bigint"), "coded")
    return with_label_error(found, scratch).withColumn("codebooks_sha256", F.lit(books.sha256()))


def _stream(column: pa.Array) -> bytes:
    """A column of any type as bytes."""
    batch, sink = pa.RecordBatch.from_arrays([column], ["column"]), pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _column(data: bytes) -> pa.Array:
    """What :func:`_stream` made bytes of."""
    with pa.ipc.open_stream(data) as reader:
        return reader.read_all().column(0).combine_chunks()


def with_label_error(found: DataFrame, scratch: Scratch) -> DataFrame:
    """``vec_id, code, error, label_error``: the error summed over the rows of equal label, null ones together.

    Labels of more than one in ``HOT`` rows are fewer than ``HOT``, so their sums are broadcast; the others' rows are
    shuffled to theirs, where no label weighs much."""
    sums = scratch.save(found.groupBy("label").agg(F.sum("error").alias("label_error"), F.count("*").alias("n")), "labels")
    least = found.count() // HOT
    hot, rest = sums.where(F.col("n") > least).drop("n"), sums.where(F.col("n") <= least).drop("n")
    one = found.alias("f")
    by_label = lambda s: F.col("f.label").eqNullSafe(F.col("s.label"))
    marked = one.join(F.broadcast(hot.alias("s")), by_label(hot), "left").select("f.*", "s.label_error")
    out = ["vec_id", "code", "error", "label_error"]
    others = marked.where("label_error is null").drop("label_error").alias("f")
    return marked.where("label_error is not null").select(*out).union(others.join(rest.alias("s"), by_label(rest)).select("f.vec_id", "f.code", "f.error", "s.label_error"))
