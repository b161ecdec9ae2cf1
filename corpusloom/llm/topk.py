"""Exact top-k inner products by block-at-a-time pruning.

Vectors of integers are documents whose terms are the dimensions. They are put in ranges, in order of a sign code that
brings near vectors together, and cut into blocks that keep each term's largest and smallest weight besides the forward
index, the vectors themselves. A query's sum of term maxima bounds what a block can score. Each query first scores its
own range, whose k-th score is a threshold that holds everywhere. Then groups of queries meet lanes of ranges in tiles: a
tile goes through its ranges, scores blocks in order of their bounds until the bounds fall below a query's k-th score so
far, and passes that threshold on to its next range. A query gets at most k candidates from each lane. Before that, the
groups meet the bounds of all blocks alone, so that only rows of the index that some query of a group may need travel to
it. Integers travel in the narrowest type that holds them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.scratch import Scratch, bins, bound_batches
from corpusloom.llm.vectors import best, valid_rows, wide

#: Vectors in a block, in a row of the index, and queries in a row.
BLOCK, ROW, QUERIES = 256, 4096, 512
#: Input bytes of a range, and bits of the sign code.
RANGE_BYTES, CODE_BITS = 16 << 20, 16
#: Rows of queries in a tile, and input bytes of a lane: more of them make longer tasks, fewer more copies and candidates.
TILE_QUERIES, LANE_BYTES = 8, 1 << 30
#: Most partitions that tiles are dealt to; beyond it, a task has several tiles, one after the other.
TASKS = 1 << 14
NOTHING = -(1 << 62)
PACKED = "kind int, part bigint, row bigint, d int, ids binary, vectors binary, most binary, least binary, floor binary"
FOUND = "query_id bigint, vec_id bigint, score bigint"


def exact(m: np.ndarray, other: np.ndarray) -> type:
    """A type in which the inner products of integers are exact: in floats if nothing can exceed their mantissa."""
    most = float(np.abs(m).max(initial=0)) * float(np.abs(other).max(initial=0)) * m.shape[1]
    return np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else np.int64


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    kind = exact(a, b)
    return (a.astype(kind) @ b.astype(kind).T).astype(np.int64)


KINDS = (np.int16, np.int32, np.int64)


def narrow(m: np.ndarray) -> bytes:
    """A matrix of integers in the narrowest type that holds it; the first byte tells which. Equal rows give equal bytes."""
    most = max(int(m.max(initial=0)), -int(m.min(initial=0)))
    kind = next(t for t in KINDS if most <= np.iinfo(t).max)
    return bytes([np.dtype(kind).itemsize]) + np.ascontiguousarray(m.astype(kind)).tobytes()


def opened(data: bytes, d: int) -> np.ndarray:
    """What :func:`narrow` made, in rows of ``d``."""
    kind = next(t for t in KINDS if np.dtype(t).itemsize == data[0])
    return np.frombuffer(data, kind, offset=1).reshape(-1, d)


class Scored:
    """The best candidates so far of a batch of queries, and each query's threshold."""

    def __init__(self, ids: np.ndarray, floor: np.ndarray, k: int):
        self.ids, self.floor, self.k = ids, floor.copy(), k
        self.query, self.found, self.score = (np.empty(0, np.int64) for _ in range(3))

    def add(self, query: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        q, c = np.nonzero((scores >= self.floor[query][:, None]) & (ids[None, :] != self.ids[query][:, None]))
        if not len(q):
            return
        touched = np.zeros(len(self.ids), bool)
        touched[query[q]] = True
        again = touched[self.query]
        merged = [np.r_[old[again], new] for old, new in zip(self.parts(), (query[q], ids[c], scores[q, c]), strict=True)]
        at = best(*merged, self.k)
        merged = [m[at] for m in merged]
        self.query, self.found, self.score = (np.r_[old[~again], m] for old, m in zip(self.parts(), merged, strict=True))
        n = np.bincount(merged[0], minlength=len(self.ids))
        full = n == self.k
        self.floor[full] = np.maximum(self.floor[full], merged[2][np.cumsum(n)[full] - 1])

    def parts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self.query, self.found, self.score

    def batch(self) -> pa.RecordBatch:
        return pa.record_batch({"query_id": self.ids[self.query], "vec_id": self.found, "score": self.score})


def bounds(queries: np.ndarray, most: np.ndarray, least: np.ndarray) -> np.ndarray:
    """What each query's inner product with a vector of each block can't exceed."""
    queries, most = wide(queries, most)
    _, least = wide(queries, least)
    return products(np.maximum(queries, 0), most) + products(np.minimum(queries, 0), least)


def search(scored: Scored, queries: np.ndarray, cand: np.ndarray, vectors: np.ndarray, most: np.ndarray, least: np.ndarray) -> int:
    """Scores a row of the index, block by block in order of each query's bounds. Returns how many pairs of query and
    block were scored."""
    pairs = 0
    queries, vectors = wide(queries, vectors)
    bound = bounds(queries, most, least)
    order, every = np.argsort(-bound, axis=1, kind="stable"), np.arange(len(queries))
    for turn in range(order.shape[1]):
        block = order[:, turn]
        live = np.flatnonzero(bound[every, block] >= scored.floor)
        if not len(live):
            break
        pairs += len(live)
        for b in np.unique(block[live]):
            some = live[block[live] == b]
            at = slice(b * BLOCK, (b + 1) * BLOCK)
            scored.add(some, cand[at], products(queries[some], vectors[at]))
    return pairs


def top_k(vectors: DataFrame, is_query: str, k: int, scale: float = 64.0) -> DataFrame:
    """``vec_id, embedding`` to ``query_id, rank, vec_id, score``; other columns are ignored.

    Components are ``floor(scale * x)``, x as double. Queries are the rows for which the SQL condition ``is_query``
    on ``vec_id`` holds; candidates are all rows but those of the query's id. Each query gets its k highest integer
    inner products, or all if there are fewer, ties to the smaller id. Rows without an id, null vectors and vectors
    with a null or non-finite component, and empty ones, take no part; vectors of different lengths meet as if filled with
    zeros; rows that repeat an id and a vector count once. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    bound_batches(spark)
    scratch = Scratch(spark, "topk")
    ranges, lanes = bins(vectors, RANGE_BYTES), bins(vectors, LANE_BYTES)
    axes = np.random.default_rng(7).choice([-1.0, 1.0], (4096, CODE_BITS))

    def quantise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some = np.array(batch["vec_id"].is_valid()) & (np.array(batch["embedding"].value_lengths().fill_null(0)) > 0)
            at, x = valid_rows(batch["embedding"], some)
            x = np.floor(scale * x)
            folded = x if x.shape[1] <= len(axes) else x[:, : len(axes)]
            code = ((folded @ axes[: folded.shape[1]]) > 0) @ (1 << np.arange(CODE_BITS))
            some = batch.take(pa.array(at))
            length = np.where(x != 0, np.arange(1, x.shape[1] + 1), 1).max(axis=1, initial=1)  # without zeros at the end
            q = pa.array([narrow(row[:n]) for row, n in zip(x.astype(np.int64), length.tolist(), strict=True)], pa.binary())
            yield pa.record_batch({"vec_id": some["vec_id"].cast(pa.int64()), "asks": some["asks"], "code": pa.array(code.astype(np.int64)), "q": q})

    def packed(kind: int, ids: np.ndarray, m: np.ndarray, part: int | None = None, floor: np.ndarray | None = None, row: int | None = None) -> dict:
        cuts = range(0, len(ids), BLOCK)
        ends = lambda f: narrow(np.stack([f(m[i : i + BLOCK], axis=0) for i in cuts])) if kind == 0 else None
        return {"kind": kind, "part": part, "row": row, "d": m.shape[1], "ids": ids.tobytes(), "vectors": narrow(m), "most": ends(np.max), "least": ends(np.min), "floor": None if floor is None else floor.tobytes()}

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, n = TaskContext.get().partitionId(), 0
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        last = None

        def flush() -> pa.RecordBatch:
            nonlocal n
            d = max(m.shape[1] for _, _, m in held)
            ids, asks = (np.concatenate([h[i] for h in held]) for i in (0, 1))
            m = np.concatenate([np.pad(x, ((0, 0), (0, d - x.shape[1]))) for _, _, x in held])
            row = packed(0, ids, m, part, row=(part << 32) + n)
            out, n = [row], n + 1
            own = np.flatnonzero(asks)
            for i in range(0, len(own), QUERIES):
                some = own[i : i + QUERIES]
                home = Scored(ids[some], np.full(len(some), NOTHING), k)
                search(home, m[some], ids, m, opened(row["most"], d), opened(row["least"], d))
                out.append(packed(1, ids[some], m[some], None, home.floor))
            return pa.RecordBatch.from_pylist(out, schema)

        schema = pa.schema([("kind", pa.int32()), ("part", pa.int64()), ("row", pa.int64()), ("d", pa.int32()), *((c, pa.binary()) for c in ("ids", "vectors", "most", "least", "floor"))])
        for batch in batches:
            ids, asks, q = batch["vec_id"].to_numpy(zero_copy_only=False), np.array(batch["asks"]), batch["q"].to_pylist()
            keep = np.ones(len(ids), bool)
            for i, row in enumerate(zip(ids.tolist(), q, strict=True)):
                keep[i], last = row != last, row
            rows = [opened(q[i], (len(q[i]) - 1) // q[i][0])[0] for i in np.flatnonzero(keep)]
            m = np.zeros((len(rows), max(map(len, rows), default=0)), np.int64)
            for i, row in enumerate(rows):
                m[i, : len(row)] = row
            held.append((ids[keep].astype(np.int64), asks[keep], m))
            if sum(len(h[0]) for h in held) >= ROW:
                yield flush()
                held.clear()
        if held and sum(len(h[0]) for h in held):
            yield flush()

    def needed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of the rows of the index, by their blocks' bounds alone, those that a query of the group may need."""
        group, asked = None, []
        for batch in batches:
            found = []
            for r in batch.to_pylist():
                if r["group"] != group:
                    group, asked = r["group"], []
                if r["kind"] == 1:
                    asked.append((opened(r["vectors"], r["d"]), np.frombuffer(r["floor"], np.int64)))
                elif any((bounds(q, opened(r["most"], r["d"]), opened(r["least"], r["d"])) >= floor[:, None]).any() for q, floor in asked):
                    found.append((group, r["row"]))
            yield pa.record_batch({"group": pa.array([g for g, _ in found], pa.int64()), "row": pa.array([x for _, x in found], pa.int64())})

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Tiles, one after the other; in each the queries come first."""
        tile, asked, scored, queries = None, [], None, None
        for batch in batches:
            for r in batch.to_pylist():
                if r["tile"] != tile:
                    if scored:
                        yield scored.batch()
                    tile, asked, scored = r["tile"], [], None
                ids, m = np.frombuffer(r["ids"], np.int64), opened(r["vectors"], r["d"])
                if r["kind"] == 1:
                    asked.append((ids, m, np.frombuffer(r["floor"], np.int64)))
                    continue
                if asked:
                    width = max(q.shape[1] for _, q, _ in asked)
                    queries = np.concatenate([np.pad(q, ((0, 0), (0, width - q.shape[1]))) for _, q, _ in asked])
                    scored = Scored(np.concatenate([a[0] for a in asked]), np.concatenate([a[2] for a in asked]), k)
                    asked = []
                if scored:
                    search(scored, queries, ids, m, opened(r["most"], r["d"]), opened(r["least"], r["d"]))
        if scored:
            yield scored.batch()

    rows = vectors.select("vec_id", "embedding", F.coalesce(F.expr(is_query), F.lit(False)).alias("asks")).mapInArrow(quantise, "vec_id bigint, asks boolean, code bigint, q binary")
    # Rows that repeat an id and a vector come one after the other.
    ranged = rows.repartitionByRange(ranges, "code", "vec_id").sortWithinPartitions("code", "vec_id", "q")
    table = scratch.save(ranged.mapInArrow(index, PACKED), "index")
    groups = max(1, -(-table.where("kind = 1").count() // TILE_QUERIES))
    # Each group of queries meets each lane: a stated query set against all rows, in blocks.
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint")))
    columns = ("tile", "kind", "d", "ids", "vectors", "most", "least", "floor")
    group = F.pmod(F.xxhash64("ids"), F.lit(groups))
    asked = table.where("kind = 1").withColumn("lane", every(lanes)).withColumn("tile", group * lanes + F.col("lane"))
    blocks = table.where("kind = 0").withColumn("group", every(groups)).select("group", "kind", "row", "d", F.lit(None).cast("binary").alias("vectors"), "most", "least", "floor")
    queries = table.where("kind = 1").select(group.alias("group"), "kind", "row", "d", "vectors", "most", "least", "floor")
    met = queries.union(blocks).repartitionById(min(groups, TASKS), F.pmod("group", F.lit(min(groups, TASKS))).cast("int")).sortWithinPartitions("group", F.desc("kind"))
    wanted = scratch.save(met.mapInArrow(needed, "group bigint, row bigint"), "wanted")
    index_rows = table.where("kind = 0").join(wanted, "row").withColumn("tile", F.col("group") * lanes + F.col("part") % lanes)
    tiles = asked.select(*columns).union(index_rows.select(*columns))
    tasks = min(groups * lanes, TASKS)
    dealt = tiles.repartitionById(tasks, F.pmod("tile", F.lit(tasks)).cast("int")).sortWithinPartitions("tile", F.desc("kind"))
    found = dealt.mapInArrow(score, FOUND)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
