"""Columns of numbers packed into one binary value, byte by byte, so that their constant bytes compress.

Rows that go through a shuffle by the million are dealt to bins and packed per bin, which spares the cost of each row.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that scatters (SplitMix64's)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
        return x ^ (x >> U(31))


def xxhash64(x: np.ndarray) -> np.ndarray:
    """Spark's function of that name, of longs: XXH64 of 8 bytes with seed 42."""
    p1, p2, p3, p4, p5 = U(0x9E3779B185EBCA87), U(0xC2B2AE3D27D4EB4F), U(0x165667B19E3779F9), U(0x85EBCA77C2B2AE63), U(0x27D4EB2F165667C5)
    turn = lambda v, n: (v << U(n)) | (v >> U(64 - n))
    with np.errstate(over="ignore"):
        h = (U(42) + p5 + U(8)) ^ (turn(np.ascontiguousarray(x).view(U) * p2, 31) * p1)
        h = turn(h, 27) * p1 + p4
        h = (h ^ (h >> U(33))) * p2
        h = (h ^ (h >> U(29))) * p3
        return (h ^ (h >> U(32))).view(np.int64)


def pack(columns: Sequence[np.ndarray], widths: Sequence[int]) -> bytes:
    """The low ``widths`` bytes of columns of 64-bit integers."""
    return b"".join(np.ascontiguousarray(np.ascontiguousarray(c).view(np.uint8).reshape(-1, 8)[:, :w].T).tobytes() for c, w in zip(columns, widths, strict=True))


def unpack(packed, widths: Sequence[int]) -> list[np.ndarray]:
    """What :func:`pack` packed, as unsigned numbers; ``packed`` is an Arrow column of binary values, or buffers."""
    parts: list[list[np.ndarray]] = [[] for _ in widths]
    for value in packed:
        data = np.frombuffer(value.as_buffer() if hasattr(value, "as_buffer") else value, np.uint8)
        n, at = len(data) // sum(widths), 0
        for out, w in zip(parts, widths, strict=True):
            wide = np.zeros((n, 8), np.uint8)
            wide[:, :w] = data[at : at + n * w].reshape(w, n).T
            out.append(wide.view(U).ravel())
            at += n * w
    return [np.concatenate(x) if x else np.empty(0, U) for x in parts]


def dealt(bins: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each bin that has rows, with their places."""
    order = np.argsort(bins, kind="stable")
    ends = np.cumsum(np.bincount(bins, minlength=n))
    for b in np.flatnonzero(np.diff(np.r_[0, ends])).tolist():
        yield b, order[ends[b - 1] if b else 0 : ends[b]]


def starts(*sorted_columns: np.ndarray) -> np.ndarray:
    """Where a run of equal rows starts."""
    n = len(sorted_columns[0])
    new = np.ones(n, bool)
    if n:
        new[1:] = False
        for c in sorted_columns:
            new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def spans(begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The numbers of each span, one span after the other."""
    ends = np.cumsum(length)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) - np.repeat(ends - length - begin, length)
