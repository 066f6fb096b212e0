"""Byte-level BPE by dynamic programming over prefixes.

For each prefix of a match's bytes one vocabulary token can be the last of its encoding: the one
that ends there and whose pair with the last token of the rest encodes to itself. These last
tokens, one per byte, are the whole state. The encoding is read from them backwards; a text can be
appended to or edited, and only the bytes behind the first change are worked out anew.

Defined results: a null text is empty (no ids); rows that repeat are treated alike; extra columns
are ignored; marks of special tokens are ordinary text.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import only, read_table
from .pretoken import Remembered, encode_texts, in_blocks

VOCABULARY = "byte_bpe_50k.tiktoken"
#: Pairs of tokens whose verdict is remembered at most.
REMEMBERED_PAIRS = 1_000_000


class Ranks:
    """The vocabulary: bytes to rank, how each token arises, and whether two may stand side by side."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.rank = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.bytes_of = {r: b for b, r in self.rank.items()}
        self.longest = max(map(len, self.rank))
        self.pairs: dict[int, bool] = {}
        self.parents = {r: parts for b, r in self.rank.items() if len(parts := self.merged(b, r)) <= 2}
        self._right: dict[int, list] = {}
        self._left: dict[int, list] = {}

    def merged(self, piece: bytes, below: int = 1 << 30) -> list[int]:
        """The definition: merge the neighbours of least rank, if below the limit, until none has one."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            best, i = min((self.rank.get(parts[i] + parts[i + 1], below), i) for i in range(len(parts) - 1))
            if best >= below:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [self.rank[p] for p in parts]

    def stands(self, token: int) -> bool:
        """Whether merging the token's own bytes gives the token."""
        return token in self.parents

    def edge(self, token: int, side: int) -> list[tuple[bytes, int]]:
        """The symbols that hold the token's last (side 1) or first (side 0) byte while it is merged,
        each with the rank of the merge that ends it."""
        memo = self._right if side else self._left
        found = memo.get(token)
        if found is None:
            found, upper = [], 1 << 30
            while True:
                found.append((self.bytes_of[token], upper))
                parts = self.parents[token]
                if len(parts) < 2:
                    break
                upper, token = token, parts[side]
            found.reverse()
            memo[self.rank[found[-1][0]]] = found
        return found

    def follows(self, left: int, right: int) -> bool:
        """Whether the bytes of both, merged together, give just these two: no merge across their
        border comes before the merges that each makes on its own side (the left one first on a tie)."""
        key = left << 32 | right
        ok = self.pairs.get(key)
        if ok is None:
            if len(self.pairs) >= REMEMBERED_PAIRS:
                self.pairs.clear()
            ok = self.pairs[key] = left in self.parents and right in self.parents and self._apart(left, right)
        return ok

    def _apart(self, left: int, right: int) -> bool:
        xs, ys, rank = self.edge(left, 1), self.edge(right, 0), self.rank
        i = j = 0
        while True:
            (x, x_ends), (y, y_ends) = xs[i], ys[j]
            across = rank.get(x + y)
            if across is not None and across < x_ends and across <= y_ends:
                return False
            if x_ends == y_ends == 1 << 30:
                return True
            if x_ends <= y_ends:
                i += 1
            else:
                j += 1


class PrefixEncoder:
    """The last token of each prefix of one piece, kept under appends and edits."""

    def __init__(self, ranks: Ranks, piece: bytes = b""):
        self.ranks, self.data, self.last = ranks, bytearray(), []
        self.append(piece)

    def append(self, more: bytes) -> None:
        self.data += more
        rank, last, data, longest = self.ranks.rank, self.last, bytes(self.data), self.ranks.longest
        follows, stands = self.ranks.follows, self.ranks.stands
        for end in range(len(last) + 1, len(data) + 1):
            for begin in range(max(0, end - longest), end):
                token = rank.get(data[begin:end])
                if token is not None and (follows(last[begin - 1], token) if begin else stands(token)):
                    last.append(token)
                    break
            else:
                raise ValueError("the vocabulary cannot encode these bytes")

    def replace(self, begin: int, end: int, new: bytes) -> int:
        """Put new in place of the bytes begin to end; returns the number of prefixes kept."""
        tail = bytes(self.data[end:])
        del self.data[begin:], self.last[begin:]
        self.append(new + tail)
        return begin

    def ids(self) -> list[int]:
        out, at = [], len(self.data)
        while at:
            token = self.last[at - 1]
            out.append(token)
            at -= len(self.ranks.bytes_of[token])
        return out[::-1]


def encode_piece(ranks: Ranks, piece: bytes) -> list[int]:
    """A match that is itself a token is that token; any other goes by its prefixes."""
    whole = ranks.rank.get(piece)
    return [whole] if whole is not None else PrefixEncoder(ranks, piece).ids()


@cache
def worker_memory(path: str) -> tuple[Ranks, Remembered, np.ndarray]:
    ranks = Ranks(path)
    table = np.empty(max(ranks.bytes_of) + 1, dtype=object)
    for token, piece in ranks.bytes_of.items():
        table[token] = piece
    return ranks, Remembered(lambda piece: encode_piece(ranks, piece.encode())), table


def decode(table: np.ndarray, ids: np.ndarray) -> bytes:
    return b"".join(table[ids].tolist())


def round_trip(path: str):
    """For mapInArrow: rows (doc_id, text) to doc_id, n_tokens, ids_sha256, decoded_sha256."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, memory, table = worker_memory(path)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            n, coded, back = [], [], []
            for lo, hi in in_blocks(texts):
                ids, at = encode_texts(texts[lo:hi], memory, spaced=True)
                raw, pieces = memoryview(ids.astype("<u4").tobytes()), table[ids].tolist()
                bounds = at.tolist()
                for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                    n.append(b - a)
                    coded.append(hashlib.sha256(raw[4 * a : 4 * b]).hexdigest())
                    back.append(hashlib.sha256(b"".join(pieces[a:b])).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(n, pa.int64()), pa.array(coded, pa.string()), pa.array(back, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return run


def bpe_round_trip(docs: DataFrame, path: str) -> DataFrame:
    return only(docs, "doc_id", "text").mapInArrow(round_trip(path), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op6_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_round_trip(read_table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))
