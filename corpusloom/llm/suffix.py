"""Repeated substrings by enhanced suffix arrays, and their removal.

:func:`maximal_repeats` scans a suffix array with its common-prefix lengths: a stack gives the tree of intervals that
share a prefix, and an interval whose occurrences differ in the byte before them is a maximal repeat, with all of its
occurrences.

Over a corpus, the suffixes to sort together are found by anchors. The anchor of a string of ``min_len`` bytes is the
place of its least hashed gram, so equal strings have equal anchors. Each anchor stands for a run of strings, and its
context is the bytes they cover:

1. Contexts that are equal as a whole need only hashes: all of their strings repeat.
2. Where anchors are equal but contexts differ, the bytes of one context of each kind are fetched, and the suffix array
   of those contexts gives the repeats that they share.
3. An anchor whose contexts have more than ``Limits.strings`` strings (the edge of a passage that very many documents share) is
   split by string: equal strings meet by their hashes, which are combined where they are made.

Texts are dealt to bins by id, anchors and strings by their hash, all packed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.packing import U, dealt, mix, pack, spans, starts, unpack, xxhash64
from corpusloom.llm.scratch import Scratch, bins, bound_batches, lean

#: Input bytes for each bin of anchors, and of texts.
ANCHOR_BYTES, TEXT_BYTES = 2 << 20, 2 << 20
#: Kinds of packed rows. GIVEN has the contexts' bytes behind its columns.
ANCHORS, SPANS, ASKED, GIVEN, SPLIT, ASKED_STRINGS, STRINGS = range(7)
_ODD = 0x9E3779B97F4A7C15
_TABLE, _TABLE2 = (mix(np.arange(1, 257, dtype=U) * U(x)) for x in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F))
_powers: list[np.ndarray] = []


@dataclass(frozen=True)
class Limits:
    """What a task holds at once; results don't depend on it."""

    #: Bytes hashed together; longer texts are hashed in overlapping pieces.
    block: int = 1 << 18
    #: Anchors packed together.
    flush: int = 1 << 19
    #: Strings of an anchor that are sorted together. One that has more is split.
    strings: int = 1 << 16
    #: Strings of smaller anchors that are sorted together.
    together: int = 1 << 14
    #: Strings of one anchor above which a flush splits it, so that its bin gets no more of it from any task.
    hot: int = 1 << 12


def powers(n: int) -> list[np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2**64."""
    if not _powers or len(_powers[0]) < n:
        n = 1 << n.bit_length()
        inverse = pow(_ODD, -1, 1 << 64)
        with np.errstate(over="ignore"):
            _powers[:] = [np.cumprod(np.r_[U(1), np.full(n - 1, x, U)]) for x in (_ODD, inverse)]
    return _powers


def suffix_array(data: np.ndarray, at: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes that start ``at`` and have these lengths, in order; what each shares with the one before it."""
    width = -(-int(length.max()) // 8) * 8
    if len(data) < int(at.max()) + width:
        data = np.r_[data, np.zeros(width, np.uint8)]
    rows = np.lib.stride_tricks.sliding_window_view(data, width)[at]
    rows[np.arange(width) >= length[:, None]] = 0
    words = rows.view(">u8").astype(U)
    order = np.lexsort((length, *words.T[::-1]))
    rows = rows[order]
    same = np.ones((len(at), width + 1), bool)
    same[1:, :width] = rows[1:] == rows[:-1]
    same[:, width] = False
    same[0] = False
    common = np.argmin(same, axis=1)
    length = length[order]
    common[1:] = np.minimum(common[1:], np.minimum(length[1:], length[:-1]))
    return order, common


def maximal_repeats(common: np.ndarray, left: np.ndarray, min_len: int) -> Iterator[tuple[int, int, int]]:
    """(length, first, last) of the intervals of a suffix array that are maximal repeats of ``min_len`` at least.

    ``common``: shared prefix with the suffix before; ``left``: the byte before each suffix, or below 0 where there is
    none, which differs from everything. Every interval of the tree ends where its occurrences part on the right; it
    is reported if they part on the left as well. Equal suffixes count as parting on the right."""
    long = np.flatnonzero(common >= min_len)
    if not len(long):
        return
    runs = np.split(long, np.flatnonzero(np.diff(long) > 1) + 1)
    for run in runs:
        first, last = int(run[0]) - 1, int(run[-1])
        shared, lefts = common[first + 1 : last + 1].tolist(), left[first : last + 1].tolist()
        stack: list[list] = []  # [shared, first, byte before all, or None if they differ]
        for i, depth in enumerate([*shared, 0]):
            at, before = i, lefts[i] if lefts[i] >= 0 else None
            while stack and stack[-1][0] > depth:
                top = stack.pop()
                if top[2] != before:
                    top[2] = None
                if top[2] is None:
                    yield top[0], first + top[1], first + i
                at, before = top[1], top[2]
            if depth:
                if stack and stack[-1][0] == depth:
                    if stack[-1][2] != before:
                        stack[-1][2] = None
                else:
                    stack.append([depth, at, before])


class Repeats:
    """Strings of ``min_len`` bytes, their grams of ``gram`` bytes, and the numbers of bins.

    A text is known by its document's id and a tag. Where no two texts share an id, the tag is 0 and takes no room;
    else it is a hash of the text (``tagged``)."""

    def __init__(self, min_len: int, gram: int, anchor_bins: int, text_bins: int, tagged: bool, limits: Limits):
        self.min_len, self.gram, self.anchor_bins, self.text_bins = min_len, gram, anchor_bins, text_bins
        self.tagged, self.limits = tagged, limits
        t = 8 if tagged else 0
        self.widths = {
            ANCHORS: (6, 6, 8, t, 5, 2, 2),  # key, context, doc, tag, start, strings, place of the anchor
            SPANS: (8, t, 5, 5),  # doc, tag, start, length
            ASKED: (6, 8, t, 5, 2),  # key, doc, tag, start, strings
            SPLIT: (6,),  # key
            STRINGS: (6, 6, 8, t, 5),  # two hashes, doc, tag, start
        }
        self.widths[ASKED_STRINGS] = self.widths[GIVEN] = self.widths[ASKED]

    def tag(self, text: bytes) -> int:
        return xxhash.xxh3_64_intdigest(text) if self.tagged else 0

    def text_bin(self, doc: np.ndarray) -> np.ndarray:
        return np.mod(xxhash64(doc), self.text_bins)

    def anchor_bin(self, key: np.ndarray) -> np.ndarray:
        return (key % U(self.anchor_bins)).astype(np.int64)

    def packed(self, bin_: np.ndarray, n: int, columns: list[np.ndarray], kind: int) -> list[tuple[int, int, bytes]]:
        """Rows (bin, kind, packed columns), one for each bin that has any."""
        return [(b, kind, pack([c[at] for c in columns], self.widths[kind])) for b, at in dealt(bin_, n)]

    def unpacked(self, table: pa.Table, kind: int) -> list[np.ndarray]:
        return unpack(table.filter(pc.equal(table["kind"], kind))["packed"], self.widths[kind])

    def merged(self, doc: np.ndarray, tag: np.ndarray, start: np.ndarray, strings: np.ndarray) -> list[np.ndarray]:
        """Spans of runs of strings, sorted; runs that follow each other in a text become one."""
        order = np.lexsort((start, tag, doc))
        doc, tag, start, strings = (x[order] for x in (doc, tag, start, strings))
        end = start + strings
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1]) | (start[1:] != end[:-1])
        first = np.flatnonzero(new)
        last = np.r_[first[1:], len(doc)] - 1
        length = end[last] - start[first] + U(self.min_len - 1) if len(first) else end[:0]
        return [doc[first], tag[first], start[first], length]

    def anchors(self, texts: list[bytes]) -> tuple[np.ndarray, ...]:
        """key, context, text, start, strings and place of the anchors of texts."""
        size, window = np.array([len(t) for t in texts]), self.min_len - self.gram + 1
        begin = np.cumsum(size) - size
        data = np.frombuffer(b"".join(texts), np.uint8)
        n, (up, down) = len(data), powers(len(data) + 1)
        with np.errstate(over="ignore"):
            upto = np.r_[U(0), np.cumsum(_TABLE[data] * up[:n])]
            key = mix((upto[self.gram :] - upto[: -self.gram]) * down[: n - self.gram + 1])
            low = U((1 << 34) - 1)  # the grams' upper 30 bits, then their place: the first of the least
            least = (key & ~low) | np.arange(len(key), dtype=U)
            step = 1
            while step * 2 <= window:
                least = np.minimum(least[:-step], least[step:])
                step *= 2
            if step < window:
                least = np.minimum(least[: len(least) - (window - step)], least[window - step :])
            counts = np.maximum(size - self.min_len + 1, 0)
            text = np.repeat(np.arange(len(texts)), counts)
            start = spans(begin, counts)  # of each string that lies in one text
            place = (least[start] & low).astype(np.int64)
            run = starts(text, place)
            strings = np.diff(np.r_[run, len(start)])
            first, place = start[run], place[run]
            key = key[place]
            whole = mix((upto[first + strings - 1 + self.min_len] - upto[first]) * down[first])
            context = whole ^ mix((strings << 8 | place - first).astype(U))
            return key >> U(16), context >> U(16), text[run], first - begin[text[run]], strings, place - first

    def scan(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Documents to packed anchors. Of equal contexts of a flush, those of the smallest id go on; the others repeat
        already, and their spans go along. What a flush has too much of one anchor goes to bins of its own (below 0),
        dealt without regard to the anchor, whose bin gets a note that it is split."""
        kept: list[list[np.ndarray]] = []

        def flush() -> Iterator[pa.RecordBatch]:
            cols = [np.concatenate(x) for x in zip(*kept, strict=True)]
            kept.clear()
            order = np.lexsort((cols[2].view(np.int64), cols[1], cols[0]))
            cols = [c[order] for c in cols]
            doc, run = cols[2].view(np.int64), starts(cols[0], cols[1])
            later = doc > np.repeat(doc[run], np.diff(np.r_[run, len(order)]))
            gone, cols = self.merged(*(c[later] for c in cols[2:6])), [c[~later] for c in cols]
            run = starts(cols[0])
            hot = np.add.reduceat(cols[5], run) > self.limits.hot
            split = np.repeat(hot, np.diff(np.r_[run, len(cols[0])]))
            key = cols[0]
            out = self.packed(self.anchor_bin(key[~split]), self.anchor_bins, [c[~split] for c in cols], ANCHORS)
            if hot.any():
                spread = self.anchor_bin(mix(cols[2][split]))
                some = self.packed(spread, self.anchor_bins, [c[split] for c in cols], ANCHORS)
                out += [(-1 - b, kind, value) for b, kind, value in some]
                out += self.packed(self.anchor_bin(key[run[hot]]), self.anchor_bins, [key[run[hot]]], SPLIT)
            bin_ = self.text_bin(gone[0].view(np.int64)) % self.anchor_bins
            out += self.packed(bin_, self.anchor_bins, gone, SPANS)
            for i in range(0, len(out), 256):
                yield from binned(out[i : i + 256]).to_batches()

        def hashed(pieces: list[tuple[int, int, int, bytes]]) -> None:
            ids, tags, begin, texts = zip(*pieces, strict=True)
            key, context, text, start, strings, place = self.anchors(texts)
            start = (start + np.array(begin)[text]).astype(U)
            doc, tag = np.array(ids, np.int64).view(U), np.array(tags, U)
            kept.append([key, context, doc[text], tag[text], start, strings.astype(U), place.astype(U)])

        pieces, size, held = [], 0, 0
        for batch in batches:
            for doc, value in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                if doc is None or not value.is_valid or len(data := value.as_buffer().to_pybytes()) < self.min_len:
                    continue
                tag, strings = self.tag(data), len(data) - self.min_len + 1
                for i in range(0, strings, self.limits.block):
                    pieces.append((doc, tag, i, data[i : i + self.limits.block + self.min_len - 1]))
                    size += len(pieces[-1][3])
                    if size >= self.limits.block:
                        hashed(pieces)
                        held += len(kept[-1][0])
                        pieces, size = [], 0
                    if held >= self.limits.flush:
                        yield from flush()
                        held = 0
        if pieces:
            hashed(pieces)
        if kept:
            yield from flush()

    def match(self, table: pa.Table) -> pa.Table:
        """A bin of anchors to spans that repeat and to contexts to be fetched, as a whole or as their strings."""
        gone = self.unpacked(table, SPANS)
        out = self.packed(self.text_bin(gone[0].view(np.int64)), self.text_bins, gone, SPANS)
        key, context, doc, tag, start, strings, _ = self.unpacked(table, ANCHORS)
        doc = doc.view(np.int64)
        if table["bin"][0].as_py() < 0:
            out += self.packed(self.text_bin(doc), self.text_bins, [key, doc.view(U), tag, start, strings], ASKED_STRINGS)
            return binned(out)
        order = np.lexsort((doc, context, key))
        key, context, doc, tag, start, strings = (x[order] for x in (key, context, doc, tag, start, strings))
        run = starts(key, context)
        later = doc > np.repeat(doc[run], np.diff(np.r_[run, len(doc)]))
        gone = [doc[later].view(U), tag[later], start[later], strings[later] + U(self.min_len - 1)]
        out += self.packed(self.text_bin(doc[later]), self.text_bins, gone, SPANS)
        key, doc, tag, start, strings = (x[~later] for x in (key, doc, tag, start, strings))
        run = starts(key)
        if len(run):
            split = np.isin(key[run], self.unpacked(table, SPLIT)[0])
            split |= np.add.reduceat(strings, run) > self.limits.strings
            mixed = np.maximum.reduceat(doc, run) > np.minimum.reduceat(doc, run)
            count = np.diff(np.r_[run, len(key)])
            for kind, chosen in ((ASKED, mixed & ~split), (ASKED_STRINGS, split)):
                some = np.repeat(chosen, count)
                asked = [key[some], doc[some].view(U), tag[some], start[some], strings[some]]
                out += self.packed(self.text_bin(doc[some]), self.text_bins, asked, kind)
        return binned(out)

    def fetch(self, documents: pa.Table, asked: pa.Table) -> pa.Table:
        """A bin of texts and the contexts asked of it to contexts with their bytes, dealt by anchor, and to strings,
        dealt by hash."""
        if not asked.num_rows or not documents.num_rows:
            return binned([])
        texts = Texts(documents, self.tag)
        key, doc, tag, start, strings = self.unpacked(asked, ASKED)
        at, length = texts.at(doc, tag, start), strings.astype(np.int64) + self.min_len - 1
        out = []
        for b, some in dealt(self.anchor_bin(key), self.anchor_bins):
            columns = pack([key[some], doc[some], tag[some], start[some], strings[some]], self.widths[GIVEN])
            given = texts.data[spans(at[some], length[some])].tobytes()
            out.append((b, GIVEN, np.int64(len(some)).tobytes() + columns + given))
        key, doc, tag, start, strings = self.unpacked(asked, ASKED_STRINGS)
        upto = np.cumsum(strings)
        i = 0
        while i < len(key):
            j = max(i + 1, int(np.searchsorted(upto, upto[i] + U(self.limits.strings), "right")))
            some = slice(i, j)
            out += self.strings(texts, doc[some], tag[some], start[some], strings[some].astype(np.int64))
            i = j
        return binned(out)

    def strings(self, texts: Texts, doc: np.ndarray, tag: np.ndarray, start: np.ndarray, strings: np.ndarray) -> list:
        """Contexts to their strings' hashes. Of equal strings those of the smallest id go on, the others repeat."""
        length = strings + self.min_len - 1
        data = texts.data[spans(texts.at(doc, tag, start), length)]
        at, (up, down) = spans(np.cumsum(length) - length, strings), powers(len(data) + 1)
        with np.errstate(over="ignore"):
            hashes = []
            for table in (_TABLE, _TABLE2):
                upto = np.r_[U(0), np.cumsum(table[data] * up[: len(data)])]
                hashes.append(mix((upto[at + self.min_len] - upto[at]) * down[at]) >> U(16))
        start = np.repeat(start, strings) + spans(np.zeros(len(strings), np.int64), strings).astype(U)
        doc, tag = np.repeat(doc, strings), np.repeat(tag, strings)
        gone, cols = self.repeating(*hashes, doc, tag, start)
        out = self.packed(self.text_bin(gone[0].view(np.int64)), self.text_bins, gone, SPANS)
        return out + self.packed(self.anchor_bin(cols[0]), self.anchor_bins, cols, STRINGS)

    def repeating(self, h1: np.ndarray, h2: np.ndarray, doc: np.ndarray, tag: np.ndarray, start: np.ndarray) -> tuple:
        """Spans of the strings that a smaller id has too, and the columns of the others."""
        order = np.lexsort((doc.view(np.int64), h2, h1))
        h1, h2, doc, tag, start = (x[order] for x in (h1, h2, doc, tag, start))
        run, signed = starts(h1, h2), doc.view(np.int64)
        later = signed > np.repeat(signed[run], np.diff(np.r_[run, len(doc)]))
        gone = self.merged(doc[later], tag[later], start[later], np.ones(later.sum(), U))
        return gone, [x[~later] for x in (h1, h2, doc, tag, start)]

    def repeated(self, table: pa.Table) -> pa.Table:
        """A bin of contexts and strings to the spans of repeats that also occur in a document of a smaller id, and
        spans as they are."""
        out = list(zip(*(table.filter(pc.equal(table["kind"], SPANS))[c].to_pylist() for c in ("bin", "kind", "packed"))))
        gone, _ = self.repeating(*self.unpacked(table, STRINGS))
        out += self.packed(self.text_bin(gone[0].view(np.int64)), self.text_bins, gone, SPANS)
        cols, data = [], []
        for value in table.filter(pc.equal(table["kind"], GIVEN))["packed"]:
            raw = value.as_buffer()
            n = int(np.frombuffer(raw, np.int64, 1)[0])
            cut = 8 + n * sum(self.widths[GIVEN])
            cols.append(unpack([raw.slice(8, cut - 8)], self.widths[GIVEN]))
            data.append(np.frombuffer(raw, np.uint8, offset=cut))
        if not cols:
            return binned(out)
        key, doc, tag, start, strings = map(np.concatenate, zip(*cols, strict=True))
        strings = strings.astype(np.int64)
        data = np.concatenate([*data, np.zeros(2 * self.min_len + 8, np.uint8)])  # room for the widest suffix
        size = strings + self.min_len - 1
        begin = np.cumsum(size) - size
        order = np.argsort(key, kind="stable")
        key, doc, tag, start, strings, size, begin = (x[order] for x in (key, doc, tag, start, strings, size, begin))
        run = np.r_[starts(key), len(key)]
        upto = np.r_[0, np.cumsum(strings)][run]  # strings before each anchor
        found: list[np.ndarray] = []
        i = 0
        while i < len(run) - 1:  # whole anchors, of which none has more than `strings`
            j = max(i + 1, int(np.searchsorted(upto, upto[i] + self.limits.together, "right")) - 1)
            some = slice(run[i], run[j])
            spans_ = self.spans_of(data, doc[some].view(np.int64), size[some], begin[some])
            spans_[:, 0] += run[i]
            found.append(spans_)
            i = j
        context, at, length = np.concatenate(found).T
        gone = [doc[context], tag[context], start[context] + at.astype(U), length.astype(U)]
        return binned(out + self.packed(self.text_bin(gone[0].view(np.int64)), self.text_bins, gone, SPANS))

    def spans_of(self, data: np.ndarray, doc: np.ndarray, size: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """(context, place in it, length) of repeats of these contexts that a smaller document has too."""
        strings = size - self.min_len + 1
        owner, place = np.repeat(np.arange(len(size)), strings), spans(np.zeros(len(size), np.int64), strings)
        order, common = suffix_array(data, begin[owner] + place, size[owner] - place)
        owner, place = owner[order], place[order]
        left = np.where(place > 0, data[begin[owner] + place - 1].astype(np.int64), -1)
        docs, out = doc[owner], []
        for length, a, b in maximal_repeats(common, left, self.min_len):
            some = np.arange(a, b + 1)
            later = some[docs[some] > docs[some].min()]
            if len(later):
                out.append(np.stack([owner[later], place[later], np.full(len(later), length)], axis=1))
        return np.concatenate(out) if out else np.empty((0, 3), np.int64)

    def cut(self, documents: pa.Table, removed: pa.Table, characters: bool, rest: bool) -> pa.Table:
        """A bin of texts and its removed spans to what is kept, and the spans merged. By ``characters``: the bytes of
        a character stay or go together in what is kept."""
        texts = Texts(documents, self.tag)
        mask = np.zeros(len(texts.data) + 1, np.int32)
        if removed.num_rows and documents.num_rows:
            doc, tag, start, length = unpack(removed["packed"], self.widths[SPANS])
            at = texts.at(doc, tag, start)
            np.add.at(mask, at, 1)
            np.add.at(mask, at + length.astype(np.int64), -1)
        gone = np.cumsum(mask)[:-1] > 0
        left = gone
        if characters and len(gone):
            of = np.cumsum((texts.data & 0xC0) != 0x80) - 1
            of -= of.min()
            left = np.bincount(of[gone], minlength=of[-1] + 1)[of] > 0
        kept, where = [], []
        for a, size in zip(texts.begin[texts.same].tolist(), texts.size.tolist(), strict=True):
            own, data = gone[a : a + size], texts.data[a : a + size]
            if own.any():
                edges = np.flatnonzero(np.diff(np.r_[False, own, False].astype(np.int8)))
                pairs = zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True)
                where.append([{"start": s, "length": e - s} for s, e in pairs])
                data = data[~left[a : a + size]]
            else:
                where.append([])
            kept.append(data.tobytes())
        kinds = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))
        out = {
            "doc_id": documents["doc_id"], "n_bytes": pa.array(texts.size, pa.int64()),
            "kept": pa.array(kept, pa.binary()), "removed": pa.array(where, kinds),
        }
        return pa.table(out | ({"rest": documents["rest"]} if rest else {}))


class Texts:
    """The texts of a bin, as one array of bytes. Rows that repeat an id and a text share the first one's bytes."""

    def __init__(self, table: pa.Table, tag):
        values = [v.as_buffer().to_pybytes() if v.is_valid else b"" for v in table["text"]]
        self.data, self.size = np.frombuffer(b"".join(values), np.uint8), np.array([len(v) for v in values], np.int64)
        self.begin = np.cumsum(self.size) - self.size
        place: dict[tuple, int] = {}
        # A row without an id shares nothing.
        known = [None if d is None else (d, tag(v)) for d, v in zip(table["doc_id"].to_pylist(), values, strict=True)]
        self.same = [i if k is None else place.setdefault(k, i) for i, k in enumerate(known)]
        for i, j in enumerate(self.same):
            if values[i] != values[j]:
                raise ValueError(f"two texts of document {known[i][0]} have the same 64-bit hash")
        ids = sorted((*k, i) for k, i in place.items())
        self.doc = np.array([k[0] for k in ids], np.int64)
        self.tags = np.array([k[1] for k in ids], U)
        self.row = np.array([k[2] for k in ids], np.int64)

    def at(self, doc: np.ndarray, tag: np.ndarray, start: np.ndarray) -> np.ndarray:
        """Where ``start`` of each text lies in the data."""
        if len(self.doc) == len(np.unique(self.doc)):
            row = self.row[np.searchsorted(self.doc, doc.view(np.int64))]
        else:
            texts = zip(self.doc.tolist(), self.tags.tolist(), self.row.tolist(), strict=True)
            place = {(d, t): i for d, t, i in texts}
            known = zip(doc.view(np.int64).tolist(), tag.tolist(), strict=True)
            row = np.fromiter((place[k] for k in known), np.int64, len(doc))
        return self.begin[row] + start.astype(np.int64)


def binned(rows: list[tuple[int, int, bytes]]) -> pa.Table:
    columns = zip(("bin", "kind", "packed"), (pa.int64(), pa.int32(), pa.binary()), strict=True)
    return pa.table({name: pa.array([x[i] for x in rows], type_) for i, (name, type_) in enumerate(columns)})


BINNED = "bin bigint, kind int, packed binary"


def without_repeats(
    documents: DataFrame,
    min_len: int = 50,
    gram: int = 20,
    characters: bool = False,
    rest: bool = False,
    limits: Limits | None = None,
) -> DataFrame:
    """``doc_id, text`` to ``doc_id, n_bytes, kept, removed``, a row for each row.

    Texts are UTF-8 bytes. Every byte goes that is covered by a string of ``min_len`` bytes that also starts in a
    document of a smaller id; overlaps count and the strings are those of the input. ``kept`` has the remaining bytes,
    ``removed`` the maximal removed spans (start, length). Null, empty and short texts lose nothing. By
    ``characters``, a character of which a byte goes is not in ``kept``. Other columns are ignored, or go along as the
    struct ``rest``, whatever their names. Rows that repeat an id don't take from each other, and each has its own
    text's result; rows without an id neither lose nor take. Texts are read whole. An empty table gives no rows.
    """
    spark = documents.sparkSession
    bound_batches(spark)
    scratch = Scratch(spark, "suffix")
    others = [F.col(f"`{c}`") for c in documents.columns if c not in ("doc_id", "text")]
    carried = [F.struct(*(others or [F.lit(0).alias("none")])).alias("rest")] if rest else []
    texts = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", *carried)
    # Whether two texts share an id: their hashes tell, combined before they are shuffled.
    own = texts.where("doc_id is not null").select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"))
    clash = own.groupBy("doc_id").agg(F.min("h").alias("a"), F.max("h").alias("b")).where("a <> b").limit(1).count()
    sizes = bins(documents, ANCHOR_BYTES), bins(documents, TEXT_BYTES)
    find = Repeats(min_len, min(gram, min_len), *sizes, clash > 0, limits or Limits())
    narrow = texts.select("doc_id", "text")
    anchors = narrow.mapInArrow(lean(find.scan), BINNED)
    matched = scratch.save(anchors.groupBy("bin").applyInArrow(lean(lambda t: find.match(t)), BINNED), "matched")
    # The bin that text_bin() gives; rows without an id, which nothing asks for, are dealt by their text.
    bin_ = F.pmod(F.xxhash64(F.coalesce("doc_id", F.xxhash64("text"))), F.lit(find.text_bins))
    asked = matched.where(F.col("kind").isin(ASKED, ASKED_STRINGS))
    given = narrow.withColumn("bin", bin_).groupBy("bin").cogroup(asked.groupBy("bin"))
    fetched = given.applyInArrow(lean(lambda t, a: find.fetch(t, a)), BINNED)
    # Spans are dealt by text already: they pass, so that only contexts and strings meet by their bin.
    at = F.when(F.col("kind") == SPANS, -1 - F.col("bin")).otherwise(F.col("bin"))
    shared = scratch.save(fetched.groupBy(at).applyInArrow(lean(lambda t: find.repeated(t)), BINNED), "shared")
    removed = matched.where(F.col("kind") == SPANS).union(shared).select("bin", "packed")
    span = T.StructType().add("start", "long").add("length", "long")
    schema = T.StructType().add("doc_id", "long").add("n_bytes", "long").add("kept", "binary")
    schema = schema.add("removed", T.ArrayType(span))
    if rest:
        schema = schema.add(texts.schema["rest"])
    cut = texts.withColumn("bin", bin_).groupBy("bin").cogroup(removed.groupBy("bin"))
    return cut.applyInArrow(lean(lambda t, r: find.cut(t, r, characters, rest)), schema)
