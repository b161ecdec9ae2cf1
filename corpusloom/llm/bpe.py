"""Byte-level BPE encoding and decoding as a monoid over pieces of text.

A text is encoded by halves down to small leaves. Two neighbours are joined by encoding a window around their border
again, which grows until the tokens outside it provably stay as they are:

* Between words. Patterns for byte-level vocabularies start a match at each blank behind a printable ASCII character
  (a border), whatever comes before or after, since scanning has no memory. The window grows on both sides until
  it ends at such borders (:meth:`Encoder.joined`).
* Where a text has no such border for a long stretch, halves are lists of matches. A match of the left part stands if
  its scan never looked past the part's end (:meth:`Encoder.stable`), and every match of the right part stands from the
  first border that the window's scan shares with it.
* Within one long match. A sequence of tokens is the BPE encoding of its bytes if each pair of neighbours encodes to
  itself: the first merge across a border would also come first when those two tokens are encoded alone, since merges
  go by rank and then from the left. So the window is enough as soon as the pairs at its two ends pass that test.

Patterns for which this does not hold are refused (:func:`unfit`).
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from corpusloom.llm.scratch import bound_batches, lean

#: Characters of a text, and bytes of one match, that are encoded at once.
TEXT_LEAF, MATCH_LEAF = 256, 32
#: Matches and tokens of the first window.
WINDOW = 4
#: The longest stretch of bytes without a border for which windows grow to it.
STRETCH = 4096
#: Matches whose tokens a worker remembers.
REMEMBERED = 1 << 16


def unfit(pattern: str) -> bool:
    """Whether the proofs may not hold for ``pattern``: a scan that looks back, or further than one character past its
    match (a repeated class of white space that something else must follow), or a match that goes on over a border."""
    import regex

    if regex.search(r"\\s[*+]{1,2}(?!\(\?!\\S\))(?=[^|)$])|\(\?<", pattern):
        return True
    find = regex.compile(pattern)
    for c in map(chr, range(33, 127)):
        for before, after in ((c, " "), (f"a{c}", " a"), (f"1 {c}", " 1"), (f"'{c}", "  '"), (f"é\n{c}", " \n")):
            if len(before) not in {m.end() for m in find.finditer(before + after)}:
                return True
    return False


class Encoder:
    """Ranks (bytes to id) and the pattern that splits texts."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, text_leaf: int = TEXT_LEAF, match_leaf: int = MATCH_LEAF):
        import regex

        import tiktoken

        if unfit(pattern):
            raise ValueError(f"the borders of matches of {pattern!r} can't be proved from a window")
        self.leaf = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.ranks, self.findall = ranks, regex.compile(pattern).findall
        self.text_leaf, self.match_leaf = max(4, text_leaf), max(2, match_leaf)
        self.bytes_of = {v: k for k, v in ranks.items()}
        self.none = max(self.bytes_of, default=0) + 1
        tokens = [self.bytes_of.get(i, b"") for i in range(self.none)]
        self.blank = [t[:1] == b" " for t in tokens]
        self.plain = [b"!" <= t[-1:] <= b"~" for t in tokens]
        self.known: dict[str, tuple[int, ...]] = {}

    # One match.

    def merge(self, data: bytes) -> list[int]:
        """Merges the neighbours of lowest rank, the leftmost first, until no pair is left."""
        if len(data) <= MATCH_LEAF:
            return self.merge_few(data)
        ends = list(range(1, len(data) + 1))
        before, alive = list(range(-1, len(data) - 1)), [True] * len(data)
        rank = self.ranks.get
        heap = [(r, i, i + 2) for i in range(len(data) - 1) if (r := rank(data[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, end = heapq.heappop(heap)
            if not alive[i] or ends[i] >= len(data) or ends[ends[i]] != end:  # a part of it has been merged meanwhile
                continue
            alive[ends[i]], ends[i] = False, end
            if end < len(data):
                before[end] = i
                if (r := rank(data[i : ends[end]])) is not None:
                    heapq.heappush(heap, (r, i, ends[end]))
            if (j := before[i]) >= 0 and (r := rank(data[j:end])) is not None:
                heapq.heappush(heap, (r, j, end))
        found, i = [], 0
        while i < len(data):
            found.append(self.ranks[data[i : ends[i]]])
            i = ends[i]
        return found

    def merge_few(self, data: bytes) -> list[int]:
        """The same for a few bytes, looking at all pairs each time."""
        rank, none = self.ranks.get, self.none
        parts = [data[i : i + 1] for i in range(len(data))]
        pairs = [rank(data[i : i + 2], none) for i in range(len(data) - 1)]
        while pairs and (least := min(pairs)) < none:
            i = pairs.index(least)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i:
                pairs[i - 1] = rank(parts[i - 1] + parts[i], none)
            if i < len(pairs):
                pairs[i] = rank(parts[i] + parts[i + 1], none)
        return [self.ranks[x] for x in parts]

    def match(self, data: bytes) -> list[int]:
        whole = self.ranks.get(data)
        return self.tree(data) if whole is None else [whole]

    def tree(self, data: bytes) -> list[int]:
        if len(data) <= self.match_leaf:
            return self.merge(data)
        half = len(data) // 2
        return self.join(self.tree(data[:half]), self.tree(data[half:]))

    def join(self, left: list[int], right: list[int]) -> list[int]:
        n = WINDOW
        while True:
            window = self.merge(self.decode(left[-n:] + right[:n]))
            if (n >= len(left) or self.stands(left[-n - 1], window[0])) and (n >= len(right) or self.stands(window[-1], right[n])):
                return left[:-n] + window + right[n:]
            n *= 2

    def stands(self, a: int, b: int) -> bool:
        return self.merge(self.bytes_of[a] + self.bytes_of[b]) == [a, b]

    # Whole texts.

    def split(self, text: str) -> list[str]:
        """The matches of the pattern in ``text``."""
        if len(text) <= self.text_leaf:
            return self.findall(text)
        half = len(text) // 2
        return self.spliced(self.split(text[:half]), self.split(text[half:]))

    @staticmethod
    def stable(matches: list[str]) -> int:
        """How many leading matches stay whatever follows. A scan looks at most one character past its match, and
        at three characters from its start where a contraction could be; the last match reaches the end itself."""
        kept, length = len(matches) - 1, len(matches[-1])
        while kept > 0 and length + len(matches[kept - 1]) < 3:
            kept -= 1
            length += len(matches[kept])
        return max(0, kept)

    def spliced(self, left: list[str], right: list[str]) -> list[str]:
        kept, n = self.stable(left), WINDOW
        head = "".join(left[kept:])
        while True:
            window = self.findall(head + "".join(right[:n]))
            whole = n >= len(right)
            borders, at = {}, len(head)
            for i, m in enumerate(right[:n]):
                borders[at] = i
                at += len(m)
            at = 0
            for i, m in enumerate(window if whole else window[: self.stable(window)]):
                if at in borders and (at or not head):
                    return left[:kept] + window[:i] + right[borders[at] :]
                at += len(m)
            if whole:
                return left[:kept] + window
            n *= 2

    def by_matches(self, text: str) -> list[int]:
        """The tokens of the matches of ``text``, which are joined up the tree."""
        known, ids = self.known, []
        for m in self.split(text):
            found = known.get(m)
            if found is None:
                found = tuple(self.match(m.encode("utf-8", "replace")))
                if len(m) <= 64:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[m] = found
            ids += found
        return ids

    def joined(self, left: list[int], right: list[int]) -> list[int]:
        """The window grows to the last border of the left part and the first one of the right. A border lies between
        a token that ends in a printable character and one that starts with a blank."""
        plain, blank = self.plain, self.blank
        a, b = len(left) - 1, 1
        while a > 0 and not (blank[left[a]] and plain[left[a - 1]]):
            a -= 1
        while b < len(right) and not (blank[right[b]] and plain[right[b - 1]]):
            b += 1
        window = b"".join(map(self.bytes_of.__getitem__, left[a:] + right[:b]))
        return left[:a] + self.leaf(window.decode()) + right[b:]

    def by_halves(self, text: str) -> list[int]:
        if len(text) <= self.text_leaf:
            return self.leaf(text)
        half = len(text) // 2
        return self.joined(self.by_halves(text[:half]), self.by_halves(text[half:]))

    def encode(self, text: str) -> list[int]:
        if len(text) <= self.text_leaf:
            return self.leaf(text)
        data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
        borders = np.flatnonzero((data[1:] == 32) & (data[:-1] > 32) & (data[:-1] < 127))
        stretch = np.diff(borders, prepend=0, append=len(data)).max()
        return self.by_halves(text) if stretch <= STRETCH else self.by_matches(text)

    def decode(self, ids: list[int]) -> bytes:
        """The bytes of ``ids``, concatenated up a tree of halves."""
        if len(ids) <= self.text_leaf:
            return b"".join(map(self.bytes_of.__getitem__, ids))
        return self.decode(ids[: len(ids) // 2]) + self.decode(ids[len(ids) // 2 :])


_loaded: dict[tuple, Encoder] = {}


def load(path: str, pattern: str, text_leaf: int = TEXT_LEAF) -> Encoder:
    """The encoder of a rank file: lines of base64 and rank. A worker loads each once."""
    if (path, pattern, text_leaf) not in _loaded:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
        _loaded[path, pattern, text_leaf] = Encoder(ranks, pattern, text_leaf)
    return _loaded[path, pattern, text_leaf]


def encode(documents: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, text`` to ``doc_id, ids`` (array of int); other columns are ignored.

    ``path`` is the rank file, which every executor has. Null and empty texts have no ids; rows that repeat give
    repeated rows; texts are encoded whole. Nothing is shuffled.
    """
    bound_batches(documents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = load(path, pattern)
        for batch in batches:
            ids = [encoder.encode(t.as_py() or "") for t in batch["text"]]
            yield pa.record_batch({"doc_id": batch["doc_id"], "ids": pa.array(ids, pa.list_(pa.int32()))})

    return documents.select("doc_id", "text").mapInArrow(lean(run), f"doc_id {documents.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def checked(documents: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, text`` to ``doc_id, n_tokens, ids, lossless``: the ids and whether they decode to the text.

    Null and empty texts have no ids and are lossless; rows that repeat give repeated rows; an empty table gives no
    rows; other columns are ignored, whatever their names. Texts are read whole, however long."""
    bound_batches(documents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = load(path, pattern)
        for batch in batches:
            texts = [t.as_py() or "" for t in batch["text"]]
            ids = [encoder.encode(t) for t in texts]
            same = [encoder.decode(i) == t.encode("utf-8", "replace") for i, t in zip(ids, texts, strict=True)]
            yield pa.record_batch({"doc_id": batch["doc_id"], "n_tokens": pa.array(map(len, ids), pa.int64()), "ids": pa.array(ids, pa.list_(pa.int32())), "lossless": pa.array(same)})

    return documents.select("doc_id", "text").mapInArrow(lean(run), f"doc_id {documents.schema['doc_id'].dataType.simpleString()}, n_tokens bigint, ids array<int>, lossless boolean")


def decode(tokens: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, ids`` to ``doc_id, bytes``. Null ids give no bytes."""
    bound_batches(tokens.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = load(path, pattern)
        for batch in batches:
            yield pa.record_batch({"doc_id": batch["doc_id"], "bytes": pa.array([encoder.decode(x.as_py() or []) for x in batch["ids"]], pa.binary())})

    return tokens.select("doc_id", "ids").mapInArrow(lean(run), f"doc_id {tokens.schema['doc_id'].dataType.simpleString()}, bytes binary")


def digests(documents: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: encodes each text, decodes the ids and hashes both (the
    decimal ids joined by commas, and the bytes) without shipping either.

    Null and empty texts: no tokens and the hash of nothing. Rows that repeat give repeated rows; an empty table gives
    no rows; other columns are ignored, whatever their names. Texts are read whole, however long."""
    bound_batches(documents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = load(path, pattern)
        shown = {i: str(i) for i in encoder.bytes_of}.__getitem__
        for batch in batches:
            n, own, back = [], [], []
            for text in batch["text"]:
                ids = encoder.encode(text.as_py() or "")
                n.append(len(ids))
                own.append(hashlib.sha256(",".join(map(shown, ids)).encode()).hexdigest())
                back.append(hashlib.sha256(encoder.decode(ids)).hexdigest())
            yield pa.record_batch({"doc_id": batch["doc_id"], "n_tokens": pa.array(n, pa.int64()), "ids_sha256": pa.array(own), "decoded_sha256": pa.array(back)})

    return documents.select("doc_id", "text").mapInArrow(lean(run), f"doc_id {documents.schema['doc_id'].dataType.simpleString()}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
