"""Exact Jaccard join of word n-gram sets by universe-partition pigeonhole.

Two sets with at most H elements in only one of them agree in some of H + 1 parts of the universe of hashes, and differ
by one element at most in some of (H + 1) / 2 parts. H follows from the sizes, so sets are put into bands of sizes such
that partners lie in the same band or in the next, and each band has its own partition (:class:`Scheme`). A set is
indexed under its own band; it probes its own band and the next. Candidates are checked against a bound from parity
sketches and then exactly.

Hashed n-grams of 64 bits stand for the n-grams; equal sets are told by 128 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.llm.components import components
from corpusloom.llm.packing import U, dealt, mix, pack, starts, unpack
from corpusloom.llm.scratch import FILTER_BITS, Scratch, bins, bound_batches, id_filter, lean

#: Signatures that a task sorts at once, and input bytes for each bin they are dealt to.
FLUSH, BIN_BYTES = 1 << 19, 8 << 20
#: Bytes that a byte of the written tables becomes: ids are packed well.
PACKED_BY = 8.0
#: Sets that share a signature and are kept as one list; larger groups are kept as rows, compared chunk by chunk.
LIST, CHUNK = 64, 1024
#: What a row costs against a set that shares a part by chance, and the chance that two sets share an element of it:
#: for the choice between whole parts and one-deletion neighbourhoods.
CHANCE_COST, CHANCE = 10.0, 0.5
#: Rounds in which each member of an open group is compared with its nearest alone.
NEAREST = 1
#: Parts over which the members of one signature are dealt when they meet what is known of it.
SALTS = 32
#: Sets made at once when they are fetched.
FETCHED = 256
INDEX, PROBE, HEAVY = 1, 2, 4
#: Bytes of a packed signature: its upper bits, the document, the flags.
PACKED = (6, 8, 1)


def utf8(text: pa.StringScalar) -> bytes:
    return text.as_buffer().to_pybytes() if text.is_valid else b""


def shingles(text: bytes, k: int) -> np.ndarray:
    """Hashes of the distinct k-word shingles, ascending; of fewer words, the hash of all of them; else none."""
    words = text.lower().split()  # bytes: ASCII letters and ASCII white space only
    if not words:
        return np.empty(0, U)
    if len(words) < k:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), len(words))], U)
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), U, len(words))
    with np.errstate(over="ignore"):
        s = h[: len(h) - k + 1].copy()
        for i in range(1, k):
            s = mix(s) + h[i : len(h) - k + 1 + i]
    s = np.sort(mix(s))
    return s[np.r_[True, s[1:] != s[:-1]]]


class Rule:
    """``100 * intersection >= percent * union``."""

    def __init__(self, percent: int):
        self.p = percent

    def apart(self, total):
        """Most elements in only one of two linked sets whose sizes sum to ``total``; also for arrays."""
        return total - 2 * -(-self.p * total // (100 + self.p))

    def bound(self, total: int) -> int:
        """The same for all sums up to ``total``."""
        return total * (100 - self.p) // (100 + self.p)

    @lru_cache(maxsize=None)  # noqa: B019
    def edges(self) -> np.ndarray:
        """First sizes of the bands: partners of a set lie in its band or a neighbour."""
        found = [1]
        while found[-1] < 1 << 40:
            found.append(found[-1] * 100 // self.p + 1)
        return np.array(found)

    @lru_cache(maxsize=None)  # noqa: B019
    def scheme(self, band: int) -> Scheme:
        most = int(self.edges()[band + 1]) - 1
        return Scheme(band, most, self.bound(2 * most))


class Scheme:
    """The partition of a band, and whether its parts are compared whole or by one-deletion neighbourhoods: what costs
    less, counting a set's rows and the sets that share a signature with it by chance."""

    def __init__(self, band: int, most: int, apart: int):
        self.band, self.apart = band, apart
        whole = apart + 1 + 2 + (apart + 1) // 16  # spare parts, so that no set has to probe an empty one but rarely
        near = -(-(apart + 1) // 2)
        cost = lambda parts, rows: rows + CHANCE_COST * parts * CHANCE ** (most / parts)
        self.deletions = cost(near, near + most) < cost(whole, whole)
        self.parts = near if self.deletions else whole
        self.salt = mix(np.arange(self.parts, dtype=U) + U(band << 32))
        self.bare = mix(np.array([(band << 32) + (1 << 32) - 1], U))

    def split(self, s: np.ndarray, g: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The part of each element, and each part's count and sum of g."""
        part = (((s >> U(32)) * U(self.parts)) >> U(32)).astype(np.int64)
        n = np.bincount(part, minlength=self.parts)
        upto = np.r_[U(0), np.cumsum(g)]
        ends = np.cumsum(n)
        return part, n, upto[ends] - upto[ends - n]

    def keys(self, s: np.ndarray, g: np.ndarray, index: bool, probes: int, prefix: int) -> tuple[np.ndarray, np.ndarray]:
        """Signatures and flags. ``probes``: parts to probe if compared whole; ``prefix``: how many of the least elements
        of two linked sets have one in common.

        An empty part tells nothing of a set, so it has no signature. Two sets that agree in empty parts alone have both
        fewer filled parts than ``probes`` (compared whole: they agree in all but ``apart`` parts), or both a part of one
        element at most (one-deletion neighbourhoods): such sets are few, and meet by the elements of their prefixes."""
        with np.errstate(over="ignore"):
            part, n, sums = self.split(s, g)
            whole = mix(sums ^ self.salt)
            both = np.uint8(INDEX | PROBE)
            flags = np.full(self.parts, np.uint8(INDEX if index else 0))
            if self.deletions:
                less = mix((sums[part] - g) ^ self.salt[part])[n[part] > 1]
                filled, bare = n > 0, bool((n < 2).any())
                key, flag = np.r_[whole[filled], less], np.full(int(filled.sum()) + len(less), both)
            else:
                chosen, bare = np.argsort(-n, kind="stable")[:probes], int((n > 0).sum()) < probes
                flags[chosen] |= np.uint8(PROBE)
                keep = (n > 0) & (flags > 0)
                key, flag = whole[keep], flags[keep]
            if bare:
                own = mix(g[:prefix] ^ self.bare)
                key, flag = np.r_[key, own], np.r_[flag, np.full(len(own), both if index else np.uint8(PROBE))]
        return key, flag


def signatures(s: np.ndarray, rule: Rule) -> tuple[np.ndarray, np.ndarray]:
    size, g = len(s), mix(s)
    band = int(np.searchsorted(rule.edges(), size, "right")) - 1
    own, up = rule.scheme(band), rule.scheme(band + 1)
    largest, prefix = size * 100 // rule.p, size - -(-rule.p * size // 100) + 1
    found = [own.keys(s, g, True, own.apart + 1, prefix)] if own.apart else []
    if largest >= rule.edges()[band + 1] and up.apart:
        found.append(up.keys(s, g, False, min(up.apart, rule.bound(size + largest)) + 1, prefix))
    return (np.concatenate([x[0] for x in found]), np.concatenate([x[1] for x in found])) if found else (np.empty(0, U), np.empty(0, np.uint8))


def sketch(s: np.ndarray) -> bytes:
    """Parities of how many elements fall on each bit: two sets differ by as many elements at least as their sketches
    differ by bits. Wider sketches fold into narrower ones."""
    width = 1 << min(17, max(6, (2 * len(s) - 1).bit_length()))
    return np.packbits((np.bincount((s & U(width - 1)).astype(np.int64), minlength=width) & 1).astype(np.uint8), bitorder="little").tobytes()


def folded(sketches: list[bytes]) -> np.ndarray:
    """As rows of 64-bit words, of the narrowest's width."""
    width = min(map(len, sketches))
    return np.stack([np.bitwise_xor.reduce(np.frombuffer(x, U).reshape(-1, width // 8), axis=0) for x in sketches])


def _profile(rule: Rule, k: int, n_bins: int):
    """Rows of documents (kind 0) and packed signatures (kind 1), dealt by signature.

    Of the documents of a flush with equal sets only the smallest id goes on; those are linked by their sets' hash. A
    signature that more than LIST documents of a flush have goes on for the smallest only, marked; all of its documents
    go as rows (negative bins), dealt without regard to the signature."""
    schema = pa.schema([("kind", pa.int32()), ("doc_id", pa.int64()), ("n", pa.int64()), ("fp1", pa.int64()), ("fp2", pa.int64()), ("sketch", pa.binary()), ("bin", pa.int64()), ("packed", pa.binary())])

    def deal(keys: list, docs: list, flags: list) -> Iterator[pa.RecordBatch]:
        key, doc, flag = np.concatenate(keys), np.concatenate(docs), np.concatenate(flags)
        order = np.lexsort((doc, key))
        key, doc, flag = key[order], doc[order], flag[order]
        start = starts(key)
        count = np.diff(np.r_[start, len(key)])
        many = np.repeat(count > LIST, count)
        first = np.zeros(len(key), bool)
        first[start] = True
        flag = np.where(many, np.repeat(np.bitwise_or.reduceat(flag, start), count) | np.uint8(HEAVY), flag)
        rows = []
        if many.any():
            rows.append((-1 - int(mix(doc[many][:1].view(U))[0] % U(n_bins)), key[many], doc[many], flag[many]))
        keep = ~many | first
        key, doc, flag = key[keep], doc[keep], flag[keep]
        rows += [(b, key[at], doc[at], flag[at]) for b, at in dealt((key % U(n_bins)).astype(np.int64), n_bins)]
        for i in range(0, len(rows), 64):
            some = rows[i : i + 64]
            nulls = pa.nulls(len(some), pa.int64())
            packed = [pack([x[1] >> U(16), x[2], x[3].astype(U)], PACKED) for x in some]
            yield pa.record_batch([pa.array([1] * len(some), pa.int32()), nulls, nulls, nulls, nulls, pa.nulls(len(some), pa.binary()), pa.array([x[0] for x in some], pa.int64()), pa.array(packed, pa.binary())], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[tuple[int, int], tuple[int, np.ndarray, np.ndarray]] = {}
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            if held:
                own = [x for x in waiting.values() if len(x[1])]
                yield from deal([x[1] for x in own], [np.full(len(x[1]), x[0], np.int64) for x in own], [x[2] for x in own])

        for batch in batches:
            ids, out = batch["doc_id"].to_pylist(), []
            for doc, text in zip(ids, batch["text"], strict=True):
                if held >= FLUSH or len(waiting) >= FLUSH >> 3:
                    yield from flush()
                    waiting, held = {}, 0
                s = shingles(utf8(text), k)
                fp = xxhash.xxh3_128_intdigest(s.tobytes())
                fp1, fp2 = (fp >> 64) - (1 << 63), (fp & (1 << 64) - 1) - (1 << 63)
                out.append((len(s), fp1, fp2, sketch(s)))
                if len(s) and doc is not None:
                    if (seen := waiting.get((fp1, fp2))) is None:
                        key, flag = signatures(s, rule)
                        held += len(key)
                        waiting[fp1, fp2] = (doc, key, flag)
                    elif doc < seen[0]:
                        waiting[fp1, fp2] = (doc, *seen[1:])
            yield pa.record_batch([pa.array([0] * len(out), pa.int32()), batch["doc_id"].cast(pa.int64()), *(pa.array([x[i] for x in out], pa.int64()) for i in range(3)), pa.array([x[3] for x in out], pa.binary()), pa.nulls(len(out), pa.int64()), pa.nulls(len(out), pa.binary())], schema=schema)
        yield from flush()

    return run


PROFILED = "kind int, doc_id bigint, n bigint, fp1 bigint, fp2 bigint, sketch binary, bin bigint, packed binary"
GROUPED = "kind int, key bigint, docs array<bigint>"
PAIRED = "a bigint, b bigint"


def _shared(table: pa.Table) -> pa.Table:
    """A bin's packed signatures to lists of documents that share one (kind 1) and rows of large groups (2)."""
    key, doc, flag = unpack(table["packed"], PACKED)
    doc, flag = doc.view(np.int64), flag.astype(np.uint8)
    out: list[tuple[int, int, list[int]]] = []
    if table["bin"][0].as_py() < 0:
        out = [(2, k, [d]) for k, d in zip(key.view(np.int64).tolist(), doc.tolist(), strict=True)]
    else:
        order = np.lexsort((doc, key))
        key, doc, flag = key[order], doc[order], flag[order]
        start = starts(key)
        count = np.diff(np.r_[start, len(key)])
        any_ = np.bitwise_or.reduceat(flag, start)
        lists: set[tuple[int, ...]] = set()
        for i in np.flatnonzero((count > 1) & (any_ & (INDEX | PROBE) == INDEX | PROBE) | (any_ & HEAVY > 0)):
            at = slice(start[i], start[i] + count[i])
            ids = np.unique(doc[at])
            if len(ids) > LIST or any_[i] & HEAVY:
                k = int(key[start[i]].view(np.int64))
                out += [(2, k, [d]) for d in ids.tolist()]
            elif len(ids) > 1:
                lists.add(tuple(ids.tolist()))
        out += [(1, 0, list(x)) for x in lists]
    return pa.table({"kind": pa.array([x[0] for x in out], pa.int32()), "key": pa.array([x[1] for x in out], pa.int64()), "docs": pa.array([x[2] for x in out], pa.list_(pa.int64()))})


def _near(rule: Rule, na: np.ndarray, nb: np.ndarray, apart: np.ndarray) -> np.ndarray:
    """Which pairs of sizes, with so many bits apart in their sketches, may be linked; broadcasts."""
    fits = (100 * np.minimum(na, nb) >= rule.p * np.maximum(na, nb)) & (np.minimum(na, nb) > 0)
    return fits & (apart <= rule.apart(na + nb))


def _pairs(a: list[int], b: list[int]) -> pa.RecordBatch:
    return pa.record_batch({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _prune_pairs(rule: Rule):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [], []
            for x in batch.to_pylist():
                s = folded([x["sketch"], x["sketch2"]])
                if _near(rule, np.int64(x["n"]), np.int64(x["n2"]), np.bitwise_count(s[0] ^ s[1]).sum()):
                    a.append(x["a"])
                    b.append(x["b"])
            yield _pairs(a, b)

    return run


def _prune_members(rule: Rule, nearest: bool):
    """Members (component, id, size, sketch) of two groups that share a signature, to the pairs across components that
    may be linked: for each member on the left the nearest by its sketch, or all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in batch.to_pylist():
                left, right = x["left"], x["right"]
                s = folded([m["sketch"] for m in left + right])
                comp, doc, n = (np.array([m[k] for m in left + right]) for k in ("component", "doc", "n"))
                j, cut = slice(len(left), None), max(1, (1 << 20) // (len(right) * s.shape[1]))
                for at in range(0, len(left), cut):
                    i = slice(at, min(at + cut, len(left)))
                    total, apart = n[i, None] + n[None, j], np.bitwise_count(s[i, None] ^ s[None, j]).sum(-1)
                    fits = _near(rule, n[i, None], n[None, j], apart) & (comp[i, None] != comp[None, j])
                    if nearest:
                        far = np.where(fits, apart / total, 2.0)
                        p = np.flatnonzero(fits.any(axis=1))
                        q = far.argmin(axis=1)[p]
                    else:
                        p, q = np.nonzero(fits)
                    a, b = doc[i][p], doc[j][q]
                    yield _pairs(np.minimum(a, b).tolist(), np.maximum(a, b).tolist())

    return run


def _fetch(k: int, bits: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            asked = pa.array(np.flatnonzero(bits[batch["h"].to_numpy(zero_copy_only=False)]))
            for i in range(0, len(asked), FETCHED):
                some = batch.take(asked[i : i + FETCHED])
                elements = pa.array([shingles(utf8(t), k).tobytes() for t in some["text"]], pa.binary())
                yield pa.record_batch({"doc_id": some["doc_id"].cast(pa.int64()), "elements": elements})

    return run


def _verify(rule: Rule):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [], []
            for x, y, s, t in zip(batch["a"].to_pylist(), batch["b"].to_pylist(), batch["elements"], batch["elements2"], strict=True):
                s, t = np.frombuffer(s.as_buffer(), U), np.frombuffer(t.as_buffer(), U)
                both = np.sort(np.concatenate([s, t]))
                same = int((both[1:] == both[:-1]).sum())
                if 100 * same >= rule.p * (len(both) - same):
                    a.append(x)
                    b.append(y)
            yield _pairs(a, b)

    return run


def _with(members: DataFrame, keys: DataFrame) -> DataFrame:
    """``members`` (``key, doc``) with the one row of their ``key``. A key of very many members is dealt over SALTS. Spark
    takes the repeated keys for as few as they were and would broadcast them, so the sort-merge join is asked for."""
    salt, salts = F.pmod(F.xxhash64("doc"), F.lit(SALTS)).cast("int"), F.sequence(F.lit(0), F.lit(SALTS - 1))
    each = keys.withColumn("salt", F.explode(salts))
    return members.withColumn("salt", salt).join(each.hint("merge"), ["key", "salt"]).drop("salt")


class _Join:
    def __init__(self, documents: DataFrame, k: int, percent: int):
        self.spark: SparkSession = documents.sparkSession
        bound_batches(self.spark)
        self.rule, self.k, self.scratch = Rule(percent), k, Scratch(self.spark, "jaccard", PACKED_BY)
        self.texts = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")

    def verified(self, pairs: DataFrame, name: str) -> DataFrame:
        """The pairs whose sets are linked. Only the sets of their documents are made again and shuffled."""
        pairs = self.scratch.save(pairs, f"{name}_pairs")
        ids = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
        fetch = lean(_fetch(self.k, id_filter(ids)))
        some = self.texts.where("doc_id is not null").withColumn("h", F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS)))
        sets = some.mapInArrow(fetch, "doc_id bigint, elements binary").join(ids.hint("merge"), "doc_id", "left_semi")
        sets = self.scratch.save(sets, f"{name}_sets")
        other = sets.select(F.col("doc_id").alias("b"), F.col("elements").alias("elements2"))
        joined = pairs.join(sets.withColumnRenamed("doc_id", "a"), "a").join(other, "b")
        linked = joined.select("a", "b", "elements", "elements2").mapInArrow(lean(_verify(self.rule)), PAIRED)
        edges = self.scratch.save(linked, f"{name}_edges")
        self.scratch.drop(f"{name}_sets", f"{name}_pairs")
        return edges

    def copies(self, profile: DataFrame, n_bins: int) -> DataFrame:
        """Links between equal sets. A group of copies is dealt by id first, then only the smallest ids meet."""
        salt = F.pmod(F.xxhash64("doc_id"), F.lit(n_bins))
        own = Window.partitionBy("fp1", "fp2", "salt")
        some = profile.select("doc_id", "fp1", "fp2", salt.alias("salt")).withColumn("a", F.min("doc_id").over(own))
        every = Window.partitionBy("fp1", "fp2")
        heads = some.where("a = doc_id").select("doc_id", "fp1", "fp2").distinct()
        heads = heads.withColumn("a", F.min("doc_id").over(every))
        pairs = some.select("a", F.col("doc_id").alias("b")).union(heads.select("a", F.col("doc_id").alias("b")))
        return pairs.where("a <> b")

    def run(self) -> tuple[DataFrame, DataFrame]:
        """(doc_id, n of each row; doc_id, component_id of documents that aren't the smallest of theirs)."""
        n_bins, save = bins(self.texts, BIN_BYTES), self.scratch.save
        made = save(self.texts.mapInArrow(lean(_profile(self.rule, self.k, n_bins)), PROFILED), "made")
        packed = made.where("kind = 1").select("bin", "packed")
        groups = save(packed.groupBy("bin").applyInArrow(lean(_shared), GROUPED), "groups")
        rows = save(made.where("kind = 0").select("doc_id", "n"), "rows")
        known = made.where("kind = 0 and doc_id is not null and n > 0")
        profile = known.groupBy("doc_id", "fp1", "fp2", "n").agg(F.first("sketch").alias("sketch"))
        profile = save(profile, "profile")
        self.scratch.drop("made")
        lists = groups.where("kind = 1").select("docs").distinct().select(F.xxhash64("docs").alias("key"), "docs")
        large = groups.where("kind = 2").select("key", F.col("docs")[0].alias("doc")).distinct()

        # First each member against the smallest of its group.
        heads = large.groupBy("key").agg(F.min("doc").alias("a"))
        others = F.explode(F.slice("docs", F.lit(2), F.lit(LIST)))
        stars = (
            lists.select(F.col("docs")[0].alias("a"), others.alias("b"))
            .union(_with(large, heads).where("a <> doc").select("a", F.col("doc").alias("b")))
            .distinct()
        )
        mine = profile.withColumnRenamed("doc_id", "a")
        other = profile.toDF("b", "fp12", "fp22", "n2", "sketch2")
        fits = "(fp1 <> fp12 or fp2 <> fp22) and 100 * least(n, n2) >= %d * greatest(n, n2)" % self.rule.p
        fit = stars.join(mine, "a").join(other, "b").where(fits).select("a", "b", "n", "n2", "sketch", "sketch2")
        first = self.verified(fit.mapInArrow(lean(_prune_pairs(self.rule)), PAIRED).distinct(), "first")
        found = components(self.copies(profile, n_bins).union(first), self.scratch, "first_components")

        # Then across components, where any other link joins what is joined already: a few rounds of each member's
        # nearest, which leave large groups of near copies in one component, and all pairs of what remains apart.
        for turn, nearest in enumerate((True,) * NEAREST + (False,)):
            across = self.across(profile, lists, large, found, nearest, f"open{turn}")
            more = self.verified(across, f"more{turn}")
            joined = found.select(F.col("component").alias("a"), F.col("node").alias("b")).union(more)
            found = components(joined, self.scratch, f"components{turn}_")
        return rows, found.select(F.col("node").alias("doc_id"), F.col("component").alias("component_id"))

    def across(self, profile: DataFrame, lists: DataFrame, large: DataFrame, found: DataFrame, nearest: bool, name: str) -> DataFrame:
        """Pairs of documents of different components that share a signature and may be linked."""
        # An id has one row of each of these tables, and no more than a few lists: no join by it has a hot key or needs a
        # broadcast, whose size would follow the input.
        known = self.scratch.save(
            profile.select(F.col("doc_id").alias("doc"), "n", "sketch").join(found.withColumnRenamed("node", "doc").hint("merge"), "doc", "left").withColumn("component", F.coalesce("component", "doc")), f"{name}_known"
        )
        member = F.struct("component", "doc", "n", "sketch")
        # Whether a list is open shows without the sketches, which only open lists need.
        placed = lists.select("key", F.explode("docs").alias("doc")).join(known.select("doc", "component").hint("merge"), "doc")
        apart = placed.groupBy("key").agg(F.min("component").alias("c1"), F.max("component").alias("c2")).where("c1 <> c2").select("key")
        open_lists = placed.select("key", "doc").join(apart, "key").join(known.hint("merge"), "doc").groupBy("key").agg(F.collect_list(member).alias("left")).select("left", F.col("left").alias("right"))
        tagged = large.join(known.select("doc", "component").hint("merge"), "doc")
        sizes = tagged.groupBy("key", "component").agg(F.count("*").alias("m"))
        open_keys = sizes.groupBy("key").agg(F.count("*").alias("c"), F.sum("m").alias("m"), F.max_by("component", "m").alias("main")).where("c > 1").select("key", "m", "main")
        members = self.scratch.save(
            _with(tagged, open_keys).withColumn("chunk", F.pmod(F.xxhash64("doc"), F.ceil(F.col("m") / CHUNK))).join(known.drop("component").hint("merge"), "doc"), name
        )
        chunks = members.groupBy("key", "chunk").agg(F.collect_list(member).alias("right"))
        few = members.where("component <> main").groupBy("key", "chunk").agg(F.collect_list(member).alias("left")).drop("chunk")
        pairs = open_lists.union(few.join(chunks, "key").select("left", "right"))
        return pairs.mapInArrow(lean(_prune_members(self.rule, nearest)), PAIRED).distinct()


def near_duplicates(documents: DataFrame, k: int, percent: int) -> DataFrame:
    """``doc_id, text`` to ``doc_id, n_shingles, component_id``, a row for each row; other columns are ignored.

    Words are runs of other bytes than ASCII white space, A-Z in lower case; a document's set holds its distinct
    k-word shingles, or all of its words as one if it has fewer. Documents link where
    ``100 * intersection >= percent * union``; ``component_id`` is the smallest id reachable by links, itself included.
    Null, empty and blank texts have an empty set and no links. Rows of one id count as one document, which has the
    links of all of their texts; rows without an id link with nothing and have no component. Texts are read whole; no
    group is capped. An empty table gives no rows.
    """
    rows, found = _Join(documents, k, percent).run()
    return rows.join(found.hint("merge"), "doc_id", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))
