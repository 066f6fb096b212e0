"""Words of many texts at once, in numpy: where they are and a 64-bit hash of each.

A word is a run of bytes other than blank and the control characters 9 to 13, with A-Z lower-cased
(on UTF-8 bytes this equals the rule on code points). The hash of a word is a polynomial over its
bytes modulo 2**64, taken from one running sum over the whole block, then mixed with its length.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_U = np.uint64
#: Bytes of text whose words are held at once.
BLOCK_BYTES = 1 << 18
try:
    _LIBC = ctypes.CDLL("libc.so.6")
    # Arrays of a block are reused within a task, larger ones go back to the system when they are freed:
    # 3 is the size from which they are mapped one by one, 1 the free room at the top that is kept.
    _LIBC.mallopt(-3, 1 << 24)
    _LIBC.mallopt(-1, 1 << 25)
except (OSError, AttributeError):
    _LIBC = None


def release() -> None:
    """Give free memory back, for workers that stay while other stages run."""
    pa.default_memory_pool().release_unused()
    if _LIBC is not None:
        _LIBC.malloc_trim(0)


def lean(run):
    """A mapInArrow function that gives its free memory back when its task ends."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release()

    return task


_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}


def _table(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers["up"]) < n:
        size = max(n, BLOCK_BYTES + 1)
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(size, base, dtype=_U)
            steps[0] = 1
            _powers[name] = np.cumprod(steps, dtype=_U)
    return _powers["up"], _powers["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def run_hashes(units: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """uint64 hashes of units[start:end], equal for equal runs wherever they stand."""
    up, down = _table(len(units) + 1)
    sums = np.zeros(len(units) + 1, dtype=_U)
    np.cumsum((units.astype(_U) + _U(1)) * up[: len(units)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(_U) * _U(0xD6E8FEB86659FD93))


@dataclass
class Words:
    """Words of the texts lo to hi-1 of a batch: doc counts from 0 at lo; data are the lower-cased bytes."""

    lo: int
    hi: int
    doc: np.ndarray
    hash: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    data: np.ndarray

    @property
    def docs(self) -> int:
        return self.hi - self.lo

    def counts(self) -> np.ndarray:
        return np.bincount(self.doc, minlength=self.docs).astype(np.int64)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts (null: none) and where each begins, with the end last."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def blocks(at: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about most bytes each; a longer text is a range of its own."""
    lo, n = 0, len(at) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + most, side="right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def words(texts: pa.Array, most: int = BLOCK_BYTES, marks: bool = True) -> Iterator[Words]:
    """Without marks a word holds ASCII letters, digits and bytes of other scripts alone."""
    raw, at = text_bytes(texts)
    for lo, hi in blocks(at, most):
        data = raw[at[lo] : at[hi]].copy()
        own = at[lo : hi + 1] - at[lo]
        upper = (data >= 65) & (data <= 90)
        data[upper] += 32
        inside = np.zeros(len(data) + 2, dtype=bool)
        inside[1:-1] = (data != 32) & ((data < 9) | (data > 13))
        if not marks:
            inside[1:-1] = ((data >= 97) & (data <= 122)) | ((data >= 48) & (data <= 57)) | (data >= 128)
        begin = np.zeros(len(data) + 1, dtype=bool)
        begin[own] = True
        first = inside[1:] & (~inside[:-1] | begin)
        last = inside[:-1] & (~inside[1:] | begin)
        starts, ends = np.flatnonzero(first), np.flatnonzero(last)
        doc = np.searchsorted(own, starts, side="right") - 1
        yield Words(lo, hi, doc, run_hashes(data, starts, ends), starts, ends, data)


def shingles(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Document numbers and 64-bit hashes of all runs of size words, in order.

    A text with fewer words, but one at least, has its whole sequence as its one run.
    """
    n = w.counts()
    if not len(w.hash):
        return np.zeros(0, np.int64), np.zeros(0, _U)
    end = np.repeat(np.cumsum(n), n)
    at = np.arange(len(w.hash))
    sums = np.zeros(len(w.hash), dtype=_U)
    for k in range(size):
        ok = at + k < end
        sums[ok] = mix(sums[ok] * _U(0x9FB21C651E98DF25) + w.hash[at[ok] + k] + _U(k + 1))
    first = np.repeat(np.cumsum(n) - n, n)
    take = (at + size <= end) | ((at == first) & (end - first < size))
    return w.doc[take], sums[take]


def distinct_by_doc(doc: np.ndarray, h: np.ndarray, docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Per document the distinct hashes in ascending order: all of them, and the offsets (docs + 1)."""
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])
    doc, h = doc[new], h[new]
    return h, np.searchsorted(doc, np.arange(docs + 1))


def ragged(at: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Positions at[0], ..., at[0]+n[0]-1, at[1], ... of runs laid one after another."""
    total = int(n.sum())
    shift = np.repeat(at - (np.cumsum(n) - n), n)
    return np.arange(total, dtype=np.int64) + shift
