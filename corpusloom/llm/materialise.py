"""Token sequences in training order, as binary shards of fixed stride.

Every sequence has a dense number: documents are put in order of their id and a hash of their text, by ranges, and each
range numbers its sequences behind those of the ranges before it. The numbers are the corpus's own, however Spark splits
the input. A keyed Feistel network over the next power of four permutes the numbers; walking its cycle until a number below the count comes up makes that a
permutation of the numbers themselves. The result is the sequence's slot, and each shard holds a range of slots: the
sequence of a slot lies at a place that arithmetic gives, so reading goes on from any step without an index.
"""

from __future__ import annotations

import bisect
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm import bpe
from corpusloom.llm.packing import U, mix
from corpusloom.llm.scratch import Scratch, bins, bound_batches, lean

ROUNDS = 6
#: Characters that the library encodes at once: this operator is about order, not about encoding.
LEAF = 16_384
#: Input bytes of a range of documents, and keys of the sample that its borders come from.
RANGE_BYTES, SAMPLE = 64 << 20, 1 << 15
CUT = "range int, doc_id bigint, h bigint, n bigint, tokens binary"
STAGED = "part bigint, first bigint, doc_id bigint, n bigint, tokens binary"
SLOTTED = "shard bigint, slot bigint, doc_id bigint, seq_no bigint, n_tokens bigint, tokens binary"
INDEX = "slot bigint, doc_id bigint, seq_no bigint, n_tokens bigint, shard string, offset bigint"


def permute(x: np.ndarray, n: int, key: int) -> np.ndarray:
    """The slots of the numbers ``x`` below ``n``."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    low = U((1 << half) - 1)
    keys = mix(np.arange(ROUNDS, dtype=U) + U(key % (1 << 56) << 4))
    out = np.ascontiguousarray(x).astype(U)
    todo = np.arange(len(out))
    with np.errstate(over="ignore"):
        while len(todo):
            left, right = out[todo] >> U(half), out[todo] & low
            for k in keys:
                left, right = right, left ^ (mix(right + k) & low)
            out[todo] = (left << U(half)) | right
            todo = todo[out[todo] >= n]
    return out.astype(np.int64)


def _key(doc: int | None, h: int) -> tuple[bool, int, int]:
    """Order of documents: those without an id first."""
    return doc is not None, doc or 0, h


def borders(documents: DataFrame, ranges: int) -> list[tuple[bool, int, int]]:
    """Keys that cut the documents into about even ranges, from at most about SAMPLE keys. Where they lie only deals the
    work; the order is that of the keys."""
    keys = documents.select("doc_id", F.xxhash64("text").alias("h"))
    every = max(1, keys.count() // SAMPLE)
    some = sorted(_key(*r) for r in keys.where(F.pmod(F.xxhash64("doc_id", "h"), F.lit(every)) == 0).collect())
    return sorted({some[len(some) * i // ranges] for i in range(1, ranges)}) if some else []


def _cut(path: str, pattern: str, length: int, end: int, at: list[tuple[bool, int, int]]):
    """Tokens of each document, and the range that it belongs to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = bpe.load(path, pattern, LEAF)
        for batch in batches:
            out = []
            for doc, h, text in zip(batch["doc_id"].to_pylist(), batch["h"].to_pylist(), batch["text"], strict=True):
                ids = encoder.encode(text.as_py() or "")
                if ids:
                    out.append((bisect.bisect_right(at, _key(doc, h)), doc, h, -(-(len(ids) + 1) // length), np.array([*ids, end], np.uint16).tobytes()))
            cols = list(zip(*out, strict=True)) or [[]] * 5
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.record_batch({k: pa.array(c, t) for k, c, t in zip(("range", "doc_id", "h", "n", "tokens"), cols, kinds, strict=True)})

    return run


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first number of each document within its range, whose documents come in order."""
    first = 0
    for batch in batches:
        n = batch["n"].to_numpy(zero_copy_only=False)
        begin = first + np.cumsum(n) - n
        first += int(n.sum())
        yield pa.record_batch({"part": batch["range"].cast(pa.int64()), "first": pa.array(begin, pa.int64()), "doc_id": batch["doc_id"], "n": batch["n"], "tokens": batch["tokens"]})


def _slots(offsets: dict[int, int], total: int, key: int, length: int, per_shard: int, lowest: int, highest: int):
    """Sequences whose slots lie in a range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part, first, n = (batch[c].to_numpy(zero_copy_only=False) for c in ("part", "first", "n"))
            begin = np.array([offsets[p] for p in part.tolist()], np.int64) + first
            row = np.repeat(np.arange(len(n)), n)
            seq = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            slot = permute(begin[row] + seq, total, key)
            at = np.flatnonzero((slot >= lowest) & (slot < highest))
            row, seq, slot = row[at], seq[at], slot[at]
            tokens = [batch["tokens"][r].as_buffer() for r in range(len(n))]
            cut = [tokens[r][2 * length * s : 2 * length * (s + 1)] for r, s in zip(row.tolist(), seq.tolist(), strict=True)]
            doc = batch["doc_id"].take(pa.array(row))
            yield pa.record_batch({"shard": slot // per_shard, "slot": slot, "doc_id": doc, "seq_no": seq, "n_tokens": pa.array([len(c) // 2 for c in cut], pa.int64()), "tokens": pa.array([c.to_pybytes() for c in cut], pa.binary())})

    return run


def _write(uri: str, length: int, per_shard: int, pad: int):
    """Writes each shard, whose rows come in order of their slots, and moves it into place: a task that runs again, or
    twice at once, leaves the same file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(uri)
        store.create_dir(root, recursive=True)
        current, out, temp = None, None, ""

        def close() -> None:
            out.close()
            store.move(temp, f"{root}/{name(current)}")

        for batch in batches:
            shard, tokens = batch["shard"].to_pylist(), batch["tokens"].to_pylist()
            for s, t in zip(shard, tokens, strict=True):
                if s != current:
                    if out:
                        close()
                    current, temp = s, f"{root}/.{name(s)}-{uuid.uuid4().hex}"
                    out = store.open_output_stream(temp)
                out.write(t + np.full(length - len(t) // 2, pad, np.uint16).tobytes())
            slot = batch["slot"].to_numpy(zero_copy_only=False)
            yield pa.record_batch({"slot": slot, "doc_id": batch["doc_id"], "seq_no": batch["seq_no"], "n_tokens": batch["n_tokens"], "shard": pa.array([name(s) for s in shard], pa.string()), "offset": slot % per_shard * 2 * length})
        if out:
            close()

    return run


def name(shard: int) -> str:
    return f"shard-{shard:08d}.bin"


def materialise(documents: DataFrame, path: str, pattern: str, out: str | None = None, *, key: int = 1, length: int = 256, per_shard: int = 8192, end: int = 50256, waves: int = 4) -> DataFrame:
    """Writes the token sequences of ``doc_id, text`` below ``out`` (a URI; by default in the shared folder) and returns
    ``slot, doc_id, seq_no, n_tokens, shard, offset``; other columns are ignored.

    A document's tokens and ``end`` are cut into sequences of ``length`` tokens of two bytes, the last one filled with
    ``end``; ``n_tokens`` tells how many count. Sequence ``slot`` lies in shard ``slot // per_shard`` at byte ``offset``.
    Slots depend on the key and the corpus alone: sequences are numbered in order of the ids and hashes of their
    documents (rows of one id and text are alike). Shards are written in ``waves`` of slots, so that only a part of the
    tokens is being shuffled at a time, by ranges of shards. To the driver come a bounded sample of keys and a number for
    each range. Null and empty texts have no sequence; rows that repeat, and rows without an id, have sequences of their own. Texts are cut,
    never shortened. An empty table gives no shard and no row. Ranks that two bytes can't hold, and an ``end`` that is a
    rank, are refused.
    """
    spark = documents.sparkSession
    known = set(bpe.load(path, pattern, LEAF).ranks.values())
    if end in known or max(end, *known) >= 1 << 16:
        raise ValueError(f"tokens take two bytes, and {end} must not be one of the ranks of {path}")
    bound_batches(spark)
    scratch = Scratch(spark, "materialise")
    uri = out or scratch.path("shards")
    given = documents.select("doc_id", "text")
    at = borders(given, bins(given, RANGE_BYTES))
    cut = given.select("doc_id", "text", F.xxhash64("text").alias("h")).mapInArrow(lean(_cut(path, pattern, length, end, at)), CUT)
    ordered = cut.repartitionById(len(at) + 1, "range").sortWithinPartitions("doc_id", "h")
    staged = scratch.save(ordered.mapInArrow(_number, STAGED), "staged")
    counts = staged.groupBy("part").agg(F.max(F.col("first") + F.col("n")).alias("n")).orderBy("part").collect()
    offsets, total = {}, 0
    for r in counts:
        offsets[r.part], total = total, total + r.n
    found = []
    shards = -(-total // per_shard)
    for wave in range(waves):
        lowest, highest = shards * wave // waves, shards * (wave + 1) // waves
        if lowest < highest:
            cut = staged.mapInArrow(_slots(offsets, total, key, length, per_shard, lowest * per_shard, highest * per_shard), SLOTTED)
            n = max(1, min(highest - lowest, int(spark.conf.get("spark.sql.shuffle.partitions"))))
            range_ = F.floor((F.col("shard") - lowest) * n / (highest - lowest)).cast("int")
            dealt = cut.repartitionById(n, range_).sortWithinPartitions("slot")
            found.append(scratch.save(dealt.mapInArrow(_write(uri, length, per_shard, end), INDEX), f"index{wave}"))
    scratch.drop("staged")
    index = found[0] if found else spark.createDataFrame([], INDEX)
    for x in found[1:]:
        index = index.union(x)
    return index


def read(uri: str, slot: int, n: int, length: int = 256, per_shard: int = 8192) -> Iterator[np.ndarray]:
    """``n`` sequences from ``slot`` on, or as many as there are: one seek for each shard."""
    from pyarrow import fs

    store, root = fs.FileSystem.from_uri(uri)
    while n > 0:
        file = f"{root}/{name(slot // per_shard)}"
        if store.get_file_info(file).type == fs.FileType.NotFound:
            return
        with store.open_input_file(file) as data:
            data.seek(slot % per_shard * 2 * length)
            rows = np.frombuffer(data.read(2 * length * min(n, per_shard - slot % per_shard)), np.uint16).reshape(-1, length)
        yield from rows
        if not len(rows):
            return
        slot, n = slot + len(rows), n - len(rows)
