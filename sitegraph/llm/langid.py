"""Language of documents by a linear-chain conditional random field over their words.

Each word gets a language: its scores come from hashed affixes, letter n-grams and the word itself
(the lexicon), and learned transitions tie neighbours, so that code-switched text is labelled word
by word with forward-backward. A document's language is the one with the largest share of its
words' probability.

A text is one chain, however long. Chains are worked through in segments of SEGMENT words side by
side: each segment's transfer matrix carries the exact messages over its borders, and the words
inside are then done from those. The fit takes a bounded sample, TRAIN_DOCS rows of each language by hash of their
id outside the held-out fold, and splices segments of different languages to learn transitions.

Defined results: a null text or one without a letter is `und` with score 0; a text with letters but
no word is the first language with an equal share; a null lang is no label; with no labels at all
every text is `und`; rows that repeat are labelled alike; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import fold, only, read_table
from .wordvec import Words, lean, mix, ragged, words

BITS, SEGMENT = 18, 256
#: Labelled rows of each language that the fit takes at most; passes; words of a training chain.
TRAIN_DOCS, PASSES, CHAIN = 384, 2, 48
FOLDS, HELD = 4, 2
#: Bytes of text whose features are held at once.
BLOCK_BYTES = 1 << 18
_LETTER = regex.compile(r"\p{L}")


def word_features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Coordinates of each word's features one after another, and how many each word has.

    Features: the word, prefixes of 1 to 3 and suffixes of 1 to 4 bytes, all runs of 2 and 3 bytes.
    """
    n = ends - starts
    word, salted = [], []

    def add(rows: np.ndarray, begin: np.ndarray, size: int, salt: int) -> None:
        h = np.zeros(len(rows), dtype=np.uint64)
        for k in range(size):
            h = h * np.uint64(0x100000001B3) + data[begin + k].astype(np.uint64) + np.uint64(1)
        word.append(rows)
        salted.append(mix(h + np.uint64(salt << 40)))

    word.append(np.arange(len(n)))
    salted.append(code)
    for size in (1, 2, 3):
        rows = np.flatnonzero(n >= size)
        add(rows, starts[rows], size, size)
    for size in (1, 2, 3, 4):
        rows = np.flatnonzero(n >= size)
        add(rows, ends[rows] - size, size, 8 + size)
    for size in (2, 3):
        many = np.maximum(n - size + 1, 0)
        add(np.repeat(np.arange(len(n)), many), ragged(starts, many), size, 16 + size)
    rows, at = np.concatenate(word), np.concatenate(salted)
    order = np.argsort(rows, kind="stable")
    return (at[order] >> np.uint64(64 - BITS)).astype(np.int32), np.bincount(rows, minlength=len(n))


def distinct_words(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of the block's distinct words, and for each word the number of its distinct one."""
    code, first, inverse = np.unique(w.hash, return_index=True, return_inverse=True)
    at, n = word_features(w.data, w.starts[first], w.ends[first], code)
    return at, n, inverse


def live_counts(n: np.ndarray) -> np.ndarray:
    """For each step how many of the chains, the longest first, still have a word there."""
    return np.searchsorted(-n, -np.arange(int(n[0]) if len(n) else 0), side="left")


def segments(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The chain, the number within it and the length of each segment of chains with so many words."""
    parts = -(-counts // SEGMENT)
    chain = np.repeat(np.arange(len(counts)), parts)
    k = ragged(np.zeros(len(counts), dtype=np.int64), parts)
    return chain, k, np.minimum(SEGMENT, counts[chain] - k * SEGMENT)


def border_messages(local: np.ndarray, trans: np.ndarray, s0: np.ndarray, chain: np.ndarray, k: np.ndarray, length: np.ndarray):
    """For each segment: the factor at its first word, and the message that reaches its last one from behind."""
    labels = local.shape[1]
    first, last = np.tile(s0, (len(chain), 1)), np.full((len(chain), labels), 1.0 / labels)
    long = np.flatnonzero(np.bincount(chain)[chain] > 1)
    if not len(long):
        return first, last
    order = long[np.argsort(-length[long], kind="stable")]
    begin = (np.cumsum(length) - length)[order]
    live = live_counts(length[order])
    carry = np.where((k[order] == 0)[:, None, None], np.eye(labels), trans) * local[begin][:, None, :]
    for t in range(1, len(live)):
        m = live[t]
        step = (carry[:m] @ trans) * local[begin[:m] + t][:, None, :]
        carry[:m] = step / step.sum(axis=(1, 2), keepdims=True)
    matrix = np.empty((len(chain), labels, labels))
    matrix[order] = carry
    reach = np.tile(s0, (len(chain), 1))
    for i in range(1, int(k.max()) + 1):
        at = np.flatnonzero(k == i)
        ends = np.einsum("ni,nij->nj", reach[at - 1], matrix[at - 1])
        reach[at] = ends / ends.sum(axis=1, keepdims=True)
        first[at] = reach[at] @ trans
    for i in range(int(k.max()), 0, -1):
        at = np.flatnonzero(k == i)
        back = np.einsum("nij,nj->ni", matrix[at], last[at])
        last[at - 1] = back / back.sum(axis=1, keepdims=True)
    return first, last


def marginals(emit: np.ndarray, length: np.ndarray, start: np.ndarray, move: np.ndarray, pairs: np.ndarray | None = None) -> np.ndarray:
    """Forward-backward over chains laid one after another (emit: words x labels, log scale).

    All segments go step by step together, the longest first. Returns each word's probabilities;
    adds the expected number of each transition to pairs if given (chains of one segment only).
    """
    local = np.exp(emit - emit.max(axis=1, keepdims=True))
    trans, s0 = np.exp(move - move.max()), np.exp(start - start.max())
    chain, k, size = segments(length)
    first, last = border_messages(local, trans, s0, chain, k, size)
    order = np.argsort(-size, kind="stable")
    n = size[order]
    begin = (np.cumsum(size) - size)[order]
    first, last = first[order], last[order]
    ahead, back = np.empty_like(local), np.empty_like(local)
    live = live_counts(n)
    for t in range(len(live)):
        at = begin[: live[t]] + t
        a = local[at] * (first[: live[t]] if t == 0 else ahead[at - 1] @ trans)
        ahead[at] = a / a.sum(axis=1, keepdims=True)
    for t in range(len(live) - 1, -1, -1):
        m = live[t]
        at = begin[:m] + t
        b = last[:m].copy()
        more = live[t + 1] if t + 1 < len(live) else 0
        if more:
            nxt = local[at[:more] + 1] * back[at[:more] + 1]
            b[:more] = nxt @ trans.T
            if pairs is not None:
                joint = ahead[at[:more]][:, :, None] * trans[None] * nxt[:, None, :]
                pairs += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
            b /= b.sum(axis=1, keepdims=True)
        back[at] = b
    p = ahead * back
    return p / p.sum(axis=1, keepdims=True)


@dataclass
class Crf:
    langs: list[str]
    weight: np.ndarray
    start: np.ndarray
    move: np.ndarray

    def emissions(self, at: np.ndarray, n: np.ndarray) -> np.ndarray:
        sums = np.zeros((len(at) + 1, len(self.langs)))
        np.cumsum(self.weight[at], axis=0, out=sums[1:])
        end = np.cumsum(n)
        return sums[end] - sums[end - n]

    def label(self, w: Words) -> np.ndarray:
        """Each word's probabilities."""
        if not len(w.hash):
            return np.zeros((0, len(self.langs)))
        at, n, inverse = distinct_words(w)
        return marginals(self.emissions(at, n)[inverse], w.counts(), self.start, self.move)

    def shares(self, texts: pa.Array) -> np.ndarray:
        """texts x languages: the mean probability over the text's words."""
        out = []
        for w in words(texts, most=BLOCK_BYTES, marks=False):
            p, n = self.label(w), w.counts()
            own = np.stack([np.bincount(w.doc, weights=p[:, j], minlength=w.docs) for j in range(len(self.langs))], axis=1)
            out.append(np.where(n[:, None] > 0, own / np.maximum(n, 1)[:, None], 1.0 / len(self.langs)))
        return np.concatenate(out) if out else np.zeros((0, len(self.langs)))


def fit(texts: list[str], langs: list[str], passes: int = PASSES, seed: int = 5) -> Crf:
    """Likelihood ascent with a rate for each coordinate, on chains of one language and spliced ones."""
    names = sorted(set(langs))
    label = {name: i for i, name in enumerate(names)}
    k = len(names)
    crf = Crf(names, np.zeros((1 << BITS, k), dtype=np.float64), np.zeros(k), np.eye(k))
    if k < 2:
        return crf
    rng = np.random.default_rng(seed)
    feats, counts, owner, base, of_word = [], [], [], 0, []
    for w in words(pa.array(texts, pa.string()), most=BLOCK_BYTES, marks=False):
        at, n, inverse = distinct_words(w)
        feats.append(at)
        counts.append(n)
        of_word.append((inverse + base).astype(np.int32))
        owner.append(np.array([label[x] for x in langs[w.lo : w.hi]], dtype=np.int32)[w.doc])
        base += len(n)
    flat, n_of = np.concatenate(feats), np.concatenate(counts)
    feats.clear()
    first = np.cumsum(n_of) - n_of
    word, gold = np.concatenate(of_word), np.concatenate(owner)
    whole = len(word) // CHAIN * CHAIN
    pieces = np.arange(whole).reshape(-1, CHAIN)
    sq, sq_move, sq_start = np.full((1 << BITS, k), 1e-3), np.full((k, k), 1e-3), np.full(k, 1e-3)
    for _ in range(passes):
        half = CHAIN // 2
        mixed = pieces.copy()
        swap = rng.random(len(pieces)) < 0.25
        mixed[swap, half:] = pieces[rng.permutation(len(pieces))[swap], half:]
        order = rng.permutation(len(mixed))
        for lo in range(0, len(order), 128):
            rows = mixed[order[lo : lo + 128]]
            ids, y = word[rows.ravel()], gold[rows.ravel()]
            at = flat[ragged(first[ids], n_of[ids])]
            expected = np.zeros((k, k))
            p = marginals(crf.emissions(at, n_of[ids]), np.full(len(rows), CHAIN), crf.start, crf.move, expected)
            g = -p
            g[np.arange(len(y)), y] += 1
            y2 = y.reshape(rows.shape)
            seen = np.zeros((k, k))
            np.add.at(seen, (y2[:, :-1].ravel(), y2[:, 1:].ravel()), 1)
            scale = 1.0 / len(y)
            rep, up = np.repeat(g, n_of[ids], axis=0), np.empty((1 << BITS, k))
            for j in range(k):
                up[:, j] = np.bincount(at, weights=rep[:, j], minlength=1 << BITS)
            up *= scale
            sq += up * up
            crf.weight += 0.1 * up / np.sqrt(sq)
            gm = (seen - expected) * scale
            sq_move += gm * gm
            crf.move += 0.1 * gm / np.sqrt(sq_move)
            gs = (np.bincount(y2[:, 0], minlength=k) - p.reshape(*rows.shape, k)[:, 0].sum(axis=0)) * scale
            sq_start += gs * gs
            crf.start += 0.1 * gs / np.sqrt(sq_start)
    return crf


def train(docs: DataFrame, rows: int = TRAIN_DOCS) -> Crf | None:
    """Fit on rows of each language outside the held-out fold; None without any label."""
    known = only(docs, "doc_id", "text", "lang").where((fold("doc_id", FOLDS) != HELD) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    # One pass takes the least id hashes of every language: the rank's limit goes before the shuffle.
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id"))
    taken = known.select("doc_id", "lang").withColumn("place", place).where(F.col("place") <= rows).select("doc_id", "lang").distinct()
    chosen = known.join(F.broadcast(taken), ["doc_id", "lang"]).select("doc_id", "lang", "text")
    got = sorted(chosen.dropDuplicates(["doc_id", "lang"]).collect())
    return fit([r["text"] for r in got], [r["lang"] for r in got]) if got else None


def label_rows(crf: Crf | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            slices = (texts.slice(i, 256).to_pylist() for i in range(0, len(texts), 256))
            letter = np.array([bool(t) and _LETTER.search(t) is not None for part in slices for t in part], dtype=bool)
            names, score = np.full(len(texts), "und", dtype=object), np.zeros(len(texts))
            if crf is not None and len(texts):
                share = crf.shares(texts)
                best = share.argmax(axis=1)
                names[letter] = np.array(crf.langs, dtype=object)[best[letter]]
                score[letter] = np.clip(share.max(axis=1)[letter], 0.0, 1.0)
            yield pa.RecordBatch.from_arrays([*(c for n, c in zip(batch.schema.names, batch.columns, strict=True) if n != "text"), pa.array(names, pa.string()), pa.array(score)], [*(n for n in batch.schema.names if n != "text"), "lang_pred", "score"])

    return run


def languages(docs: DataFrame, crf: Crf | None) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row."""
    rows = only(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), (fold("doc_id", FOLDS) == HELD).alias("held_out"), "text")
    return rows.mapInArrow(lean(label_rows(crf)), "doc_id long, held_out boolean, lang_pred string, score double")


def keep_known(docs: DataFrame, crf: Crf | None) -> DataFrame:
    """The rows of docs, whole, in whose text a language is found."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.select(["text"])
            found = next(label_rows(crf)(iter([rows]))).column("lang_pred")
            yield batch.filter(pc.not_equal(found, "und"))

    return docs.mapInArrow(lean(run), docs.schema)


def op8_crf_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return languages(docs, train(docs))
