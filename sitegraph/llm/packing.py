"""Packing documents into sequences by linear grouping, configurations, substitution and best fit.

Documents become token ids with an end id; longer ones than a sequence are cut, nothing else is.
All that the plan needs is how many pieces there are of each length, at most CAPACITY numbers, so
the plan is made on the driver and its size does not grow with the input:

1. linear grouping: pieces longer than CAPACITY // LARGE_PARTS are sorted and cut into GROUPS
   groups of equal cardinality; in each all lengths are rounded up to the longest;
2. configurations of the few rounded sizes are optimised by column generation (a simplex whose
   new columns come from a knapsack), and taken as often as the whole part of the solution says;
3. substitution: actual pieces take the places of a configuration, the last place the longest
   piece that still fits, which wins back what rounding took;
4. best fit: all pieces left, longest first, go where the least room that suffices is left.

A piece finds its place by its rank among the pieces of its length, ranked in bounded buckets.

Defined results: a null text is empty and has the end id alone; rows that repeat are packed each
for itself; null ids are ids like others; an empty table gives no sequence; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import read_table, stage_table
from .pretoken import encode_texts, in_blocks, library_memory, lowered
from .wordvec import lean

VOCABULARY, CAPACITY, END_ID = "word_bpe_49k.json", 2048, 0
GROUPS, LARGE_PARTS, STEPS = 40, 8, 400
#: Rows of one length that one task ranks, about.
BUCKET_ROWS = 512
#: Rows of a batch whose texts are Python strings at once.
SLICE_ROWS = 256


def cut_pieces(path: str, capacity: int, end_id: int):
    """For mapInArrow: rows (doc_id, text) to the rows of their pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = library_memory(path)
        for batch in (b.slice(i, SLICE_ROWS) for b in batches for i in range(0, b.num_rows, SLICE_ROWS)):
            docs = batch.column("doc_id").to_pylist()
            texts = [lowered(t or "", memory) for t in batch.column("text").to_pylist()]
            for lo, hi in in_blocks(texts):
                ids, at = encode_texts(texts[lo:hi], memory, spaced=False)
                raw = memoryview(np.insert(ids, at[1:], end_id).astype("<u4").tobytes())
                own, rows = at + np.arange(hi - lo + 1), []
                for d, a, b in zip(docs[lo:hi], own[:-1].tolist(), own[1:].tolist(), strict=True):
                    for k, p in enumerate(range(a, b, capacity)):
                        q = min(b, p + capacity)
                        rows.append((d, k, p - a, q - p, zlib.crc32(raw[4 * p : 4 * q])))
                names, kinds = ["doc_id", "piece", "start", "length", "ids_crc32"], [pa.int64(), pa.int32(), *[pa.int64()] * 3]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return run


def pieces_of(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    return docs.select(F.col("`doc_id`").cast("long").alias("doc_id"), F.col("`text`")).mapInArrow(lean(cut_pieces(path, capacity, end_id)), schema)


def configurations(sizes: list[int], need: list[int], capacity: int, steps: int = STEPS) -> list[tuple[list[int], float]]:
    """Configurations (how many of each size) and how often each is used, few in all.

    Columns are added while one betters the solution, steps at most: every step leaves a solution
    that covers the need, so the bound costs room and never a piece.
    """
    k = len(sizes)
    size, d = np.array(sizes), np.array(need, dtype=float)
    basis = np.diag([float(capacity // s) for s in sizes])
    for _ in range(steps):
        inverse = np.linalg.inv(basis)
        use = inverse @ d
        worth = np.ones(k) @ inverse
        best, pick = np.zeros(capacity + 1), np.full(capacity + 1, -1)
        for room in range(int(size.min()), capacity + 1):
            fits = size <= room
            value = np.where(fits, best[np.maximum(room - size, 0)] + worth, -1.0)
            i = int(value.argmax())
            best[room] = best[room - 1]
            if value[i] > best[room] + 1e-12:
                best[room], pick[room] = value[i], i
        if best[capacity] <= 1 + 1e-7:
            break
        column, room = np.zeros(k), capacity
        while room > 0:
            if pick[room] < 0:
                room -= 1
                continue
            column[pick[room]] += 1
            room -= int(size[pick[room]])
        step = inverse @ column
        ratio = np.where(step > 1e-9, use / np.maximum(step, 1e-9), np.inf)
        basis[:, int(ratio.argmin())] = column
    use = np.linalg.inv(basis) @ d
    return [([int(round(x)) for x in basis[:, j]], float(use[j])) for j in range(k)]


class Plan:
    """Runs (length, first rank, count, first sequence, offset): the r-th piece of a length, for r in
    a run, lies in sequence first sequence + r - first rank at the offset."""

    def __init__(self, capacity: int):
        self.capacity, self.runs, self.sequences = capacity, [], 0
        self.rooms: list[list[list[int]]] = [[] for _ in range(capacity + 1)]
        self.open = np.zeros(capacity + 1, dtype=bool)

    def keep(self, first: int, count: int, used: int) -> None:
        """Sequences first to first + count - 1 are filled up to used."""
        if count and used < self.capacity:
            self.rooms[self.capacity - used].append([first, count])
            self.open[self.capacity - used] = True

    def fill(self, lengths: list[int], count: int, taken: np.ndarray) -> None:
        """count new sequences, each of pieces of the lengths; taken[n] of length n are placed already."""
        used = 0
        for n in lengths:
            self.runs.append((n, int(taken[n]), count, self.sequences, used))
            taken[n] += count
            used += n
        self.keep(self.sequences, count, used)
        self.sequences += count

    def best_fit(self, length: int, rank: int, count: int) -> None:
        while count:
            free = np.flatnonzero(self.open[length:])
            if not len(free):
                each = self.capacity // length
                n, left = divmod(count, each)
                for k in range(each):
                    if n:
                        self.runs.append((length, rank + k * n, n, self.sequences, k * length))
                self.keep(self.sequences, n, each * length)
                self.sequences += n
                for k in range(left):
                    self.runs.append((length, rank + each * n + k, 1, self.sequences, k * length))
                if left:
                    self.keep(self.sequences, 1, left * length)
                    self.sequences += 1
                return
            room = length + int(free[0])
            first, size = self.rooms[room].pop()
            self.open[room] = bool(self.rooms[room])
            n, used = min(size, count), self.capacity - room
            self.runs.append((length, rank, n, first, used))
            self.keep(first, n, used + length)
            self.keep(first + n, size - n, used)
            rank, count = rank + n, count - n


def plan_packing(counts: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS) -> Plan:
    """The plan for so many pieces of each length; every length is 1 to capacity."""
    plan = Plan(capacity)
    least = capacity // LARGE_PARTS
    have = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in counts.items():
        have[length] = n
    full, have[capacity] = int(have[capacity]), 0
    if full:
        plan.fill([capacity], full, np.zeros(capacity + 1, dtype=np.int64))
    large = have.copy()
    large[: least + 1] = 0
    taken = np.zeros(capacity + 1, dtype=np.int64)
    if large.any():
        group = np.ceil(np.cumsum(large) * groups / large.sum()).astype(int)
        sizes = sorted({int(np.flatnonzero((group == g) & (large > 0)).max()) for g in np.unique(group[large > 0])})
        need = np.diff([0, *np.cumsum(large)[sizes]]).tolist()
        for shape, times in sorted(configurations(sizes, need, capacity), key=lambda x: -x[1]):
            wanted = [s for s, k in zip(sizes, shape, strict=True) for _ in range(k)][::-1]
            left = int(times + 1e-9)
            while left:
                chosen, room = [], capacity
                for i, size in enumerate(wanted):
                    most = min(room, size) if i < len(wanted) - 1 else room
                    free = large[: most + 1] > 0
                    for c in set(chosen):
                        if c <= most:
                            free[c] = large[c] > chosen.count(c)
                    fits = np.flatnonzero(free)
                    if len(fits):
                        chosen.append(int(fits[-1]))
                        room -= chosen[-1]
                if not chosen:
                    break
                n = min(left, *(int(large[c]) // chosen.count(c) for c in set(chosen)))
                plan.fill(chosen, n, taken)
                for c in chosen:
                    large[c] -= n
                left -= n
    rest = large
    rest[: least + 1] = have[: least + 1]
    for length in np.flatnonzero(rest)[::-1].tolist():
        plan.best_fit(length, int(taken[length]), int(rest[length]))
    return plan


def ranked(pieces: DataFrame, most: int) -> DataFrame:
    """Adds rank: each piece's place, from 0, among those of its length."""
    buckets = max(1, -(-most // BUCKET_ROWS))
    rows = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    firsts = sizes.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    within = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32"))
    rows = rows.withColumn("within", within).join(firsts, ["length", "bucket"])
    return rows.withColumn("rank", F.col("first") + F.col("within") - 1).drop("bucket", "within", "first")


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for every piece."""
    pieces = stage_table(pieces_of(docs, path, capacity, end_id), "pieces")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = plan_packing(counts, capacity)
    schema = "p_length long, lo long, hi long, base long, offset long"
    runs = [(length, rank, rank + n, seq - rank, used) for length, rank, n, seq, used in plan.runs]
    plans = pieces.sparkSession.createDataFrame(runs, schema)
    here = (F.col("length") == F.col("p_length")) & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi"))
    return ranked(pieces, max(counts.values(), default=0)).join(F.broadcast(plans), here).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("rank")).alias("sequence_id"), "offset"
    )


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))
