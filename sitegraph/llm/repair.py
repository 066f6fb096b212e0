"""Token ids in Re-Pair compressed blocks, readable document by document.

Documents are encoded with a published vocabulary, an end id is appended to each, and the ids are
laid down in ascending doc_id order. A shard is one range of doc_ids, written as blocks of about
BLOCK_IDS ids. In a block the most frequent pairs of neighbouring symbols are replaced by nonterminals
until none pays any more: a rule pays from LEAST occurrences on, and as long as symbols need not get
wider for it; a pass pays if it removes one symbol in LEAST_GAIN. The block keeps the rules, the length that each nonterminal expands to, and where each
document's symbols begin, so that any document can be decoded alone.

Defined results: a null text is empty and has the end id alone; null ids come first; rows that
repeat a doc_id follow one another in the order of their texts; extra columns are ignored. Marks of
special tokens within a text are ordinary text.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import only, read_table, shared_dir, shuffle_partitions
from .pretoken import encode_texts, in_blocks, library_memory
from .wordvec import ragged

BLOCK_IDS = 1 << 20
#: Most rules a pass; fewest occurrences of a pair worth the twelve bytes of a rule.
RULES_PER_PASS, LEAST, LEAST_GAIN = 8192, 8, 1000
_MAGIC, _HEAD, _BUCKET_BITS = b"RPB1", "<4sIIIII", 18
VOCABULARY = "byte_bpe_50k.json"
BLOCK_SCHEMA = "shard int, block int, before long, n_ids long, payload binary"


def frequent_pairs(bucket: np.ndarray, seq: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (their two symbols as one number) of LEAST occurrences at least, the most frequent of
    their pass, with the places of each and its number. bucket: each place's, the last one for none.

    Places are counted by bucket and the fullest buckets are looked into: one of each's pairs is
    counted exactly. Where none of those is frequent enough, all of their pairs are.
    """
    none = np.zeros(0, dtype=np.int64)
    n = np.bincount(bucket, minlength=(1 << _BUCKET_BITS) + 1)
    n[-1] = 0
    full = np.flatnonzero(n >= LEAST)
    if not len(full):
        return none, none, none
    if len(full) > most:
        full = full[np.argsort(-n[full], kind="stable")[:most]]
    number = np.full(len(n), -1, dtype=np.int32)
    number[full] = np.arange(len(full), dtype=np.int32)
    own = number[bucket]
    at = np.flatnonzero(own >= 0)
    own, key = own[at], (seq[at].astype(np.int64) << 32) | seq[at + 1]
    pairs = np.zeros(len(full), dtype=np.int64)
    pairs[own[::-1]] = key[::-1]
    hit = key == pairs[own]
    times = np.bincount(own[hit], minlength=len(full))
    if not (times >= LEAST).any():
        at = np.flatnonzero(bucket < 1 << _BUCKET_BITS)
        key = (seq[at].astype(np.int64) << 32) | seq[at + 1]
        every, own, times = np.unique(key, return_inverse=True, return_counts=True)
        best = np.argsort(-times, kind="stable")[:most]
        best = best[times[best] >= LEAST]
        number = np.full(len(every), -1, dtype=np.int64)
        number[best] = np.arange(len(best))
        own = number[own]
        return every[best], at[own >= 0], own[own >= 0]
    number = np.cumsum(times >= LEAST) - 1
    hit &= times[own] >= LEAST
    return pairs[times >= LEAST], at[hit], number[own[hit]]


def compress_pairs(seq: np.ndarray, last: np.ndarray, first_rule: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols, their last-of-document marks and the rules (n x 2); no pair goes across a mark.

    Each pass hashes otherwise, so that a pair that shares a bucket gets its turn.
    """
    seq, rules, nxt = seq.astype(np.uint32), [], first_rule
    limit = 1 << (16 if first_rule <= 1 << 16 else 32)
    rng = np.random.default_rng(len(seq))
    while len(seq) > 1 and nxt < limit:
        odd = rng.integers(1 << 31, 1 << 32, 2, dtype=np.uint32) | np.uint32(1)
        bucket = ((seq[:-1] * odd[0] + seq[1:] * odd[1]) >> np.uint32(32 - _BUCKET_BITS)).astype(np.int64)
        bucket[last[:-1]] = 1 << _BUCKET_BITS
        pairs, at, own = frequent_pairs(bucket, seq, min(RULES_PER_PASS, limit - nxt))
        if not len(at):
            break
        # Where replacements would overlap, every second one of a run is taken.
        fresh = np.ones(len(at), dtype=bool)
        fresh[1:] = at[1:] != at[:-1] + 1
        run = np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
        free = (np.arange(len(at)) - run) % 2 == 0
        at, own = at[free], own[free]
        used = np.zeros(len(pairs), dtype=bool)
        used[own] = True
        rule = np.cumsum(used) - 1
        rules.append(np.stack([pairs[used] >> 32, pairs[used] & 0xFFFFFFFF], axis=1))
        seq[at] = (nxt + rule[own]).astype(np.uint32)
        last = last.copy()
        last[at] = last[at + 1]
        stay = np.ones(len(seq), dtype=bool)
        stay[at + 1] = False
        seq, last = seq[stay], last[stay]
        nxt += int(used.sum())
        if LEAST_GAIN * len(at) < len(stay):
            break
    return seq.astype(np.int64), last, np.concatenate(rules) if rules else np.zeros((0, 2), dtype=np.int64)


def by_depth(rules: np.ndarray, base: int) -> Iterator[np.ndarray]:
    """The rules' numbers, those first whose symbols are plain, then those whose symbols came before."""
    known, left = np.zeros(len(rules), dtype=bool), np.arange(len(rules))
    while len(left):
        s = rules[left] - base
        ready = ((s < 0) | known[np.maximum(s, 0)]).all(axis=1)
        if not ready.any():
            raise ValueError("a rule refers to itself")
        yield left[ready]
        known[left[ready]] = True
        left = left[~ready]


def pack_block(doc_ids: list, ids: np.ndarray, ends: np.ndarray) -> bytes:
    """ends: for each document one past its last id."""
    first_rule = int(ids.max()) + 1 if len(ids) else 0
    last = np.zeros(len(ids), dtype=bool)
    last[ends - 1] = True
    symbols, marks, rules = compress_pairs(ids, last, first_rule)
    size = np.ones(first_rule + len(rules), dtype=np.int64)
    for ready in by_depth(rules, first_rule):
        size[first_rule + ready] = size[rules[ready]].sum(axis=1)
    lengths = size[first_rule:]
    width = 2 if first_rule + len(rules) <= 1 << 16 else 4
    parts = [
        struct.pack(_HEAD, _MAGIC, len(doc_ids), len(rules), len(symbols), first_rule, width),
        np.array([d is None for d in doc_ids], dtype=np.uint8).tobytes(),
        np.array([0 if d is None else d for d in doc_ids], dtype="<i8").tobytes(),
        (np.flatnonzero(marks) + 1).astype("<u4").tobytes(),
        rules.astype("<u4").tobytes(),
        lengths.astype("<u4").tobytes(),
        symbols.astype(f"<u{width}").tobytes(),
    ]
    return b"".join(parts)


class Block:
    """A block read back; ids(i) decodes document i alone, all_ids() every document."""

    def __init__(self, payload: bytes):
        magic, docs, rules, symbols, self.first_rule, width = struct.unpack_from(_HEAD, payload)
        if magic != _MAGIC:
            raise ValueError("not a block of this format")
        at = struct.calcsize(_HEAD)

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(payload, dtype=kind, count=n, offset=at)
            at += out.nbytes
            return out

        null, own = take("u1", docs), take("<i8", docs)
        self.doc_ids = [None if z else int(d) for z, d in zip(null, own, strict=True)]
        self.ends = np.concatenate([[0], take("<u4", docs)]).astype(np.int64)
        self.rules = take("<u4", 2 * rules).reshape(-1, 2).astype(np.int64)
        self.lengths = take("<u4", rules).astype(np.int64)
        self.symbols = take(f"<u{width}", symbols).astype(np.int64)
        self._flat: tuple[np.ndarray, np.ndarray] | None = None

    def expanded(self) -> tuple[np.ndarray, np.ndarray]:
        """Every nonterminal's ids in one array, and where each begins."""
        if self._flat is None:
            at = np.concatenate([[0], np.cumsum(self.lengths)]).astype(np.int64)
            flat, base = np.zeros(int(at[-1]), dtype=np.int64), self.first_rule
            for ready in by_depth(self.rules, base):
                put = at[ready]
                for side in (0, 1):
                    s = self.rules[ready, side]
                    plain = s < base
                    flat[put[plain]] = s[plain]
                    inner = s[~plain] - base
                    n = self.lengths[inner]
                    flat[ragged(put[~plain], n)] = flat[ragged(at[inner], n)]
                    step = np.ones(len(s), dtype=np.int64)
                    step[~plain] = n
                    put = put + step
            self._flat = flat, at
        return self._flat

    def decode(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the symbols, and how many each gave."""
        flat, at = self.expanded()
        rule = symbols >= self.first_rule
        n = np.ones(len(symbols), dtype=np.int64)
        n[rule] = self.lengths[symbols[rule] - self.first_rule]
        pool = np.concatenate([symbols, flat])
        begin = np.arange(len(symbols))
        begin[rule] = len(symbols) + at[symbols[rule] - self.first_rule]
        return pool[ragged(begin, n)], n

    def ids(self, i: int) -> np.ndarray:
        return self.decode(self.symbols[self.ends[i] : self.ends[i + 1]])[0]

    def all_ids(self) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all documents and the offsets of each one's."""
        ids, n = self.decode(self.symbols)
        total = np.concatenate([[0], np.cumsum(n)])
        return ids, total[self.ends]


def encode_partition(path: str, end_id: int):
    """For mapInArrow: rows (shard, doc_id, text) in order to rows of blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = library_memory(path)
        shard, block, before, held = 0, 0, 0, 0
        doc_ids: list = []
        kept: list[np.ndarray] = []
        sizes: list[np.ndarray] = []

        def row() -> pa.RecordBatch:
            nonlocal block, before, held
            ends = np.cumsum(np.concatenate(sizes))
            payload = pack_block(doc_ids, np.concatenate(kept), ends)
            out = [[shard], [block], [before], [held], [payload]]
            block, before, held = block + 1, before + held, 0
            doc_ids.clear(), kept.clear(), sizes.clear()
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out, kinds, strict=True)], ["shard", "block", "before", "n_ids", "payload"])

        for batch in batches:
            ids_of = batch.column("doc_id").to_pylist()
            texts = [t or "" for t in batch.column("text").to_pylist()]
            if ids_of:
                shard = batch.column("shard")[0].as_py()
            for lo, hi in in_blocks(texts):
                ids, at = encode_texts(texts[lo:hi], memory, spaced=True)
                ids = np.insert(ids, at[1:], end_id)
                doc_ids += ids_of[lo:hi]
                kept.append(ids)
                sizes.append(np.diff(at) + 1)
                held += len(ids)
                if held >= BLOCK_IDS:
                    yield row()
        if doc_ids:
            yield row()

    return run


def write_shards(docs: DataFrame, folder: str, path: str, end_id: int = 0, shards: int | None = None) -> DataFrame:
    """Write docs(doc_id, text) to folder and return the table of blocks that is read back."""
    spark = docs.sparkSession
    ordered = (
        only(docs, "doc_id", "text")
        .repartitionByRange(shards or shuffle_partitions(spark), "doc_id")
        .sortWithinPartitions("doc_id", "text")
        .withColumn("shard", F.spark_partition_id())
    )
    ordered.mapInArrow(encode_partition(path, end_id), BLOCK_SCHEMA).write.parquet(folder)
    return spark.read.schema(BLOCK_SCHEMA).parquet(folder)


def digest_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow: rows (base, payload) to a row for each document."""
    for batch in batches:
        for base, payload in zip(batch.column("base").to_pylist(), batch.column("payload"), strict=True):
            block = Block(payload.as_buffer())
            ids, at = block.all_ids()
            raw, n = memoryview(ids.astype("<u4").tobytes()), np.diff(at)
            crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(block.doc_ids, pa.int64()), pa.array(base + at[:-1], pa.int64()), pa.array(n, pa.int64()), pa.array(crc, pa.int64())],
                ["doc_id", "start", "n_tokens", "ids_crc32"],
            )


def token_digests(blocks: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of all documents of a table of blocks.

    Only each shard's number of ids goes to the driver: as many numbers as shuffle partitions.
    """
    sizes = {r["shard"]: r["n"] for r in blocks.groupBy("shard").agg(F.sum("n_ids").alias("n")).collect()}
    first, total = [], 0
    for shard in sorted(sizes):
        first.append((shard, total))
        total += sizes[shard]
    starts = blocks.sparkSession.createDataFrame(first or [(0, 0)], "shard int, first long")
    rows = blocks.join(F.broadcast(starts), "shard").select((F.col("first") + F.col("before")).alias("base"), "payload")
    return rows.mapInArrow(digest_blocks, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op5_repair_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = write_shards(read_table(spark, sf_dir, "documents"), f"{shared_dir(spark)}/token_shards", public_tokenizers.path(VOCABULARY))
    return token_digests(blocks)
