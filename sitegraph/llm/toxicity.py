"""Toxicity scores by FTRL-proximal logistic regression.

A document's features are the distinct hashed words, pairs of neighbours and pairs with one word
between (words without marks, A-Z lower-cased) of its whole text. FTRL-proximal gives each
coordinate a learning rate of its own, and its L1 term leaves most weights at zero, so the model
that is sent to the executors is a short list of coordinates, at most 2**BITS.

The fit takes a bounded sample, TRAIN_ROWS labelled rows by hash of their id, outside the held-out
fold. Labels, language, source and id are never part of a score.

Defined results: a null or empty text has no features and gets the score of the bias; rows that
repeat are scored alike; several labels of one id count as toxic if one is; null labels and ids
are no labels; with no labels at all every score is the prior's; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fold, only, read_table
from .wordvec import lean, mix, words

#: Hashed coordinates are 2**BITS; labelled rows that the fit takes at most; passes over them.
BITS, TRAIN_ROWS, PASSES = 20, 8192, 3
ALPHA, BETA, L1, L2 = 1.0, 1.0, 8.0, 0.1
FOLDS, HELD = 5, 0


def features(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Blocks of texts: how many, and pairs (text of the block, coordinate), not yet distinct."""
    shift = np.uint64(64 - BITS)
    for w in words(texts, marks=False):
        docs, codes = [w.doc], [w.hash >> shift]
        for gap, salt in ((1, 0x51ED270B), (2, 0xA24BAED5)):
            same = w.doc[gap:] == w.doc[:-gap]
            pair = mix(w.hash[:-gap] * np.uint64(0x9FB21C651E98DF25) + w.hash[gap:] + np.uint64(salt))
            docs.append(w.doc[gap:][same])
            codes.append(pair[same] >> shift)
        yield w.docs, np.concatenate(docs), np.concatenate(codes).astype(np.int64)


@dataclass
class Model:
    """The bias, and the coordinates with a weight other than zero."""

    bias: float
    at: np.ndarray
    weight: np.ndarray

    def scores(self, texts: pa.Array) -> np.ndarray:
        place = np.full(1 << BITS, -1, dtype=np.int32)
        place[self.at] = np.arange(len(self.at))
        out = []
        for n, doc, code in features(texts):
            slot = place[code]
            hit = slot >= 0
            pairs = np.unique(doc[hit].astype(np.int64) * (len(self.at) + 1) + slot[hit])
            total = np.bincount(pairs // (len(self.at) + 1), weights=self.weight[pairs % (len(self.at) + 1)], minlength=n)
            out.append(1 / (1 + np.exp(-(self.bias + total))))
        return np.concatenate(out) if out else np.zeros(0)


def fit(rows: list[tuple[np.ndarray, int]], passes: int = PASSES, seed: int = 7) -> Model:
    """FTRL-proximal over rows (distinct coordinates, label)."""
    share = (sum(y for _, y in rows) + 0.5) / (len(rows) + 1.0)
    bias, bias_sq = float(np.log(share / (1 - share))), 1.0
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
    order = np.random.default_rng(seed)
    for _ in range(passes):
        for i in order.permutation(len(rows)):
            at, y = rows[i]
            zi, ni = z[at], n[at]
            root = np.sqrt(ni)
            w = np.where(np.abs(zi) <= L1, 0.0, -(zi - np.sign(zi) * L1) / ((BETA + root) / ALPHA + L2))
            p = 1 / (1 + np.exp(-np.clip(bias + w.sum(), -30, 30)))
            g = p - y
            z[at] = zi + g - (np.sqrt(ni + g * g) - root) / ALPHA * w
            n[at] = ni + g * g
            bias_sq += g * g
            bias -= 0.05 * g / np.sqrt(bias_sq)
    at = np.flatnonzero(np.abs(z) > L1)
    w = -(z[at] - np.sign(z[at]) * L1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2)
    return Model(bias, at, w)


def feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lo = 0
        for n, doc, code in features(batch.column("text")):
            pairs = np.unique(doc.astype(np.int64) << BITS | code)
            cut = np.searchsorted(pairs >> BITS, np.arange(n + 1))
            flat = pa.array((pairs & ((1 << BITS) - 1)).astype(np.int32))
            rows = pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), flat)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, n), batch.column("toxic").slice(lo, n), rows], ["doc_id", "toxic", "at"])
            lo += n


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """Fit on the labelled rows outside the held-out fold, rows of them at most."""
    marked = only(labels, "doc_id", "toxic").where("doc_id IS NOT NULL AND toxic IN (0, 1)").groupBy("doc_id")
    marked = marked.agg(F.max("toxic").cast("int").alias("toxic")).where(fold("doc_id", FOLDS) != HELD)
    taken = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    texts = only(docs, "doc_id", "text").where("text IS NOT NULL").join(F.broadcast(taken), "doc_id").withColumn("doc_id", F.col("doc_id").cast("long"))
    got = texts.mapInArrow(lean(feature_rows), "doc_id long, toxic int, at array<int>").dropDuplicates(["doc_id"]).toArrow()
    ids, y, at = got.column("doc_id").to_numpy(), got.column("toxic").to_numpy(), got.column("at").combine_chunks()
    flat, cut = at.values.to_numpy(), at.offsets.to_numpy()
    return fit([(flat[cut[i] : cut[i + 1]], int(y[i])) for i in np.argsort(ids)])


def score_rows(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = model.scores(batch.column("text"))
            yield pa.RecordBatch.from_arrays([*(c for n, c in zip(batch.schema.names, batch.columns, strict=True) if n != "text"), pa.array(scores)], [*(n for n in batch.schema.names if n != "text"), "score"])

    return run


def toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted for every row."""
    rows = only(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), (fold("doc_id", FOLDS) == HELD).alias("held_out"), "text")
    scored = rows.mapInArrow(lean(score_rows(model)), "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_clean(docs: DataFrame, model: Model, limit: float) -> DataFrame:
    """The rows of docs, whole, whose score is below the limit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(model.scores(batch.column("text")) < limit))

    return docs.mapInArrow(lean(run), docs.schema)


def op2_ftrl_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return toxicity(docs, train(docs, read_table(spark, sf_dir, "labels")))
