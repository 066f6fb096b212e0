"""Texts to token ids where a word's ids depend on the word alone.

The published byte-pair vocabularies first split a text by a pattern and then merge within each
match. So each distinct match is encoded once by a worker, and a text's ids are gathered from
those, which gives the same ids as encoding the whole text.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np

from .wordvec import ragged, run_hashes

OTHER, LETTER, NUMBER, SPACE = range(4)
#: Code points with the White_Space property (fixed values).
WHITE_SPACE = [9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
#: Characters taken at once, and distinct matches that a worker remembers at most.
BLOCK_CHARS, REMEMBERED = 1 << 20, 1_000_000


@cache
def classes() -> np.ndarray:
    kinds = np.zeros(0x110000, dtype=np.uint8)
    of = {"L": LETTER, "N": NUMBER}
    for point in range(0x110000):
        kinds[point] = of.get(unicodedata.category(chr(point))[0], OTHER)
    kinds[WHITE_SPACE] = SPACE
    return kinds


@cache
def library_classes() -> np.ndarray:
    """The classes as the tokenizers library's own patterns see them, whose Unicode tables may be newer."""
    from tokenizers import Regex
    from tokenizers.pre_tokenizers import Split

    kinds = np.full(0x110000, OTHER, dtype=np.uint8)
    # Beyond these planes no letter, number or space is assigned.
    for lo in (x for x in range(0, 0x40000, 1 << 11) if not 0xD800 <= x < 0xE000):
        text = "".join(map(chr, range(lo, lo + (1 << 11))))
        for kind, pattern in ((LETTER, r"[^\p{L}]+"), (NUMBER, r"[^\p{N}]+"), (SPACE, r"\S+")):
            for _, (a, b) in Split(Regex(pattern), "removed").pre_tokenize_str(text):
                kinds[lo + a : lo + b] = kind
    return kinds


def points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts and where each begins, with the end last."""
    n = np.fromiter((len(t) for t in texts), dtype=np.int64, count=len(texts))
    at = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum(n, out=at[1:])
    return np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32), at


def match_starts(cps: np.ndarray, at: np.ndarray, spaced: bool, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the pattern's matches begin, and each one's class at its first character.

    spaced: the pattern of the rank files (a blank goes with the run behind it, digits stay
    together); otherwise that of the word vocabulary (each digit alone; the caller drops white space).
    """
    n = len(cps)
    kind = kinds[cps]
    begin = np.zeros(n + 1, dtype=bool)
    begin[at] = True
    run = np.ones(n + 1, dtype=bool)
    run[1:n] = kind[1:] != kind[:-1]
    run |= begin
    last = run[1:]
    ended = begin[1:].copy()
    ended[n - 1 :] = True
    starts = run[:n].copy()
    if spaced:
        tail = (kind == SPACE) & last & ~ended
        starts |= tail
        joins = tail & (cps == 32)
        starts[1:] &= ~joins[:-1]
    else:
        starts |= kind == NUMBER
    marks = np.flatnonzero((cps == 39) & starts & last & ~ended)
    if len(marks):
        one = cps[marks + 1]
        more = (marks + 2 < n) & ~begin[np.minimum(marks + 2, n)]
        two = np.where(more, cps[np.minimum(marks + 2, n - 1)], 0)
        length = np.zeros(len(marks), dtype=np.int64)
        length[np.isin(one, [ord(c) for c in "stmd"])] = 2
        for a, b in ("re", "ve", "ll"):
            length[(one == ord(a)) & (two == ord(b))] = 3
        marks, length = marks[length > 0], length[length > 0]
        starts[marks + 1] = False
        after = marks + length
        starts[after[after < n]] = True
    found = np.flatnonzero(starts)
    return found, kind[found]


class Remembered:
    """Ids of the distinct matches that this worker has met, in one flat array."""

    def __init__(self, encode: Callable[[str], list[int]], limit: int = REMEMBERED, kinds: np.ndarray | None = None):
        self.encode, self.limit = encode, limit
        self.kinds = classes() if kinds is None else kinds
        self.clear()

    def clear(self) -> None:
        self.known = np.zeros(0, dtype=np.uint64)
        self.slot = np.zeros(0, dtype=np.int32)
        self.at = np.zeros(1, dtype=np.int64)
        self.ids = np.zeros(0, dtype=np.int32)

    def slots(self, hashes: np.ndarray, piece: Callable[[int], str]) -> np.ndarray:
        """The slot of each of the distinct, ascending hashes; piece(i) is the i-th one's text."""
        if len(self.known) + len(hashes) > self.limit:
            self.clear()
        place = np.searchsorted(self.known, hashes)
        found = np.zeros(len(hashes), dtype=bool)
        inside = place < len(self.known)
        found[inside] = self.known[place[inside]] == hashes[inside]
        new = np.flatnonzero(~found)
        if len(new):
            coded = [self.encode(piece(i)) for i in new.tolist()]
            n = np.fromiter((len(c) for c in coded), dtype=np.int64, count=len(coded))
            flat = np.fromiter((x for c in coded for x in c), dtype=np.int32, count=int(n.sum()))
            first = len(self.at) - 1
            self.at = np.concatenate([self.at, self.at[-1] + np.cumsum(n)])
            self.ids = np.concatenate([self.ids, flat])
            self.known = np.insert(self.known, place[new], hashes[new])
            self.slot = np.insert(self.slot, place[new], np.arange(first, first + len(new), dtype=np.int32))
            place = np.searchsorted(self.known, hashes)
        return self.slot[place]


def encode_texts(texts: list[str], memory: Remembered, spaced: bool) -> tuple[np.ndarray, np.ndarray]:
    """All ids (int32) of the texts one after another, and the offsets of each text's."""
    cps, at = points(texts)
    if not len(cps):
        return np.zeros(0, dtype=np.int32), np.zeros(len(texts) + 1, dtype=np.int64)
    starts, kind = match_starts(cps, at, spaced, memory.kinds)
    ends = np.append(starts[1:], len(cps))
    if not spaced:
        keep = kind != SPACE
        starts, ends = starts[keep], ends[keep]
    hashes, first, inverse = np.unique(run_hashes(cps, starts, ends), return_index=True, return_inverse=True)
    lo, hi = starts[first].tolist(), ends[first].tolist()
    slots = memory.slots(hashes, lambda i: cps[lo[i] : hi[i]].tobytes().decode("utf-32-le"))
    slots = slots[inverse]
    n = memory.at[slots + 1] - memory.at[slots]
    ids = memory.ids[ragged(memory.at[slots], n)]
    total = np.zeros(len(n) + 1, dtype=np.int64)
    np.cumsum(n, out=total[1:])
    return ids, total[np.searchsorted(starts, at)]


def in_blocks(texts: list[str], most: int = BLOCK_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of about most characters; a longer text is a range of its own."""
    lo, size = 0, 0
    for i, t in enumerate(texts):
        if i > lo and size + len(t) > most:
            yield lo, i
            lo, size = i, 0
        size += len(t)
    if lo < len(texts):
        yield lo, len(texts)


@cache
def byte_letters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, extra = {b: chr(b) for b in plain}, 256
    for b in range(256):
        if b not in letters:
            letters[b] = chr(extra)
            extra += 1
    return [letters[b] for b in range(256)]


@cache
def library_memory(path: str) -> Remembered:
    """A worker's memory of matches encoded by the tokenizers library's model at path."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    model, letters = tokenizer.model, byte_letters()

    def encode(piece: str) -> list[int]:
        return [t.id for t in model.tokenize("".join([letters[b] for b in piece.encode()]))]

    memory = Remembered(encode, kinds=library_classes())
    memory.tokenizer = tokenizer
    return memory


def lowered(text: str, memory: Remembered) -> str:
    """The text as the vocabulary's own normaliser leaves it, but for white space."""
    return text.lower() if text.isascii() else memory.tokenizer.normalizer.normalize_str(text)
