"""Encoders, their files and the packing, against the libraries that define the ids."""

import base64
import hashlib
import random
import unicodedata
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from sitegraph.llm import bpe_prefix, packing, pretoken, repair


def library(name):
    t = Tokenizer.from_file(P.path(name))
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def reference():
    with open(P.path(bpe_prefix.VOCABULARY), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def strange(n, seed):
    rng = random.Random(seed)
    parts = ["a", "B", "é", "1", "22", "٣", " ", "  ", "\n", "\t", "'", "'s", "'re", "'LL", "!", "?!", " ", "中", "Σ", "İ", "ﬁ", "😀", "\r\n", "²", "the", " worth"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 60))) for _ in range(n)]


@pytest.mark.parametrize("name,spaced", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_same_ids_as_the_library(name, spaced):
    encode, memory, texts = library(name), pretoken.library_memory(P.path(name)), strange(1500, 3)
    ids, at = pretoken.encode_texts([t if spaced else pretoken.lowered(t, memory) for t in texts], memory, spaced)
    assert all(ids[at[i] : at[i + 1]].tolist() == encode(t) for i, t in enumerate(texts))


@pytest.mark.parametrize("name,spaced", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_every_code_point(name, spaced):
    """Beside a letter, a digit and a blank, each code point is split and normalised as the library does."""
    encode, memory = library(name), pretoken.library_memory(P.path(name))
    points = [chr(p) for p in range(1, 0x110000) if not 0xD800 <= p < 0xE000]
    points = [c for c in points if unicodedata.category(c) not in ("Co", "Cn") or ord(c) < 0x20000]
    texts = ["".join(f"a{c}1 {c}" for c in points[i : i + 128]) for i in range(0, len(points), 128)]
    for t in texts:
        ids, _ = pretoken.encode_texts([t if spaced else pretoken.lowered(t, memory)], memory, spaced)
        assert ids.tolist() == encode(t)


def test_prefix_encoding_is_tiktokens():
    encoding, texts = reference(), [*strange(1500, 5), "a" * 3000, "-=" * 900, "abc" * 1000]
    _, memory, table = bpe_prefix.worker_memory(P.path(bpe_prefix.VOCABULARY))
    ids, at = pretoken.encode_texts(texts, memory, spaced=True)
    for i, t in enumerate(texts):
        own = ids[at[i] : at[i + 1]]
        assert own.tolist() == encoding.encode_ordinary(t)
        assert bpe_prefix.decode(table, own) == t.encode()


def test_appends_and_edits_keep_the_encoding():
    ranks, rng = bpe_prefix.Ranks(P.path(bpe_prefix.VOCABULARY)), random.Random(1)
    enc = bpe_prefix.PrefixEncoder(ranks, b"unbelievable")
    for _ in range(60):
        if rng.random() < 0.5:
            enc.append(bytes(rng.choice(b"abetion") for _ in range(rng.randint(0, 4))))
        else:
            a = rng.randint(0, len(enc.data))
            assert enc.replace(a, min(len(enc.data), a + 2), b"in") == a
        assert enc.ids() == ranks.merged(bytes(enc.data))


def test_small_memory_gives_the_same():
    path, texts = P.path("byte_bpe_50k.json"), strange(300, 9)
    encode = pretoken.library_memory(path).encode
    few = pretoken.Remembered(encode, limit=40)
    for t in texts:
        a, _ = pretoken.encode_texts([t], few, True)
        b, _ = pretoken.encode_texts([t], pretoken.library_memory(path), True)
        assert a.tolist() == b.tolist()


def test_repair_round_trip_and_random_access():
    rng = np.random.default_rng(0)
    docs = [np.append(rng.integers(0, 30, rng.integers(0, 400)), 0) for _ in range(200)] + [np.append(np.tile([5, 6], 4000), 0), np.array([0])]
    ids = np.concatenate(docs)
    payload = repair.pack_block([None, *range(len(docs) - 1)], ids, np.cumsum([len(d) for d in docs]))
    block = repair.Block(payload)
    assert block.doc_ids[0] is None and block.doc_ids[1:] == list(range(len(docs) - 1))
    assert len(block.rules) and len(payload) < 2 * len(ids)
    assert all((block.ids(i) == d).all() for i, d in enumerate(docs))
    assert (block.all_ids()[0] == ids).all()
    with pytest.raises(ValueError):
        repair.Block(b"XXXX" + payload[4:])


def test_repair_stops_only_where_no_pair_pays():
    """Of a block of words no pair of neighbours in a document is left LEAST times, nor is it larger than its plain ids."""
    rng = random.Random(2)
    memory, lexicon = pretoken.library_memory(P.path(repair.VOCABULARY)), strange(60, 4)
    texts = [" ".join(rng.choice(lexicon) for _ in range(30)) for _ in range(150)]
    ids, at = pretoken.encode_texts(texts, memory, True)
    ids, ends = np.insert(ids, at[1:], 0), at[1:] + np.arange(1, len(texts) + 1)
    assert len(repair.pack_block(list(range(len(texts))), ids, ends)) < 0.4 * 2 * len(ids)
    last = np.zeros(len(ids), dtype=bool)
    last[ends - 1] = True
    with pytest.MonkeyPatch.context() as m:
        m.setattr(repair, "LEAST_GAIN", 1 << 40)
        seq, marks, rules = repair.compress_pairs(ids, last, int(ids.max()) + 1)
    pairs = (seq[:-1] << 32 | seq[1:])[~marks[:-1] & (seq[:-1] != seq[1:])]
    assert len(rules) and np.unique(pairs, return_counts=True)[1].max() < repair.LEAST


def test_repair_query(odd, nulls, none, spark, tmp_path):
    encode = library(repair.VOCABULARY)
    for n, docs in enumerate((odd, nulls, none)):
        got = repair.token_digests(repair.write_shards(docs, f"file://{tmp_path}/{n}", P.path(repair.VOCABULARY), shards=3)).collect()
        start, want = 0, []
        for r in sorted(docs.collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["text"] or "")):
            ids = np.array([*encode(r["text"]), 0], dtype="<u4")
            want.append((r["doc_id"], start, len(ids), zlib.crc32(ids.tobytes())))
            start += len(ids)
        assert sorted(((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in got), key=lambda x: x[1]) == want


def test_prefix_query(odd, nulls, none):
    encoding = reference()
    for docs in (odd, nulls, none):
        got = sorted(map(tuple, bpe_prefix.bpe_round_trip(docs, P.path(bpe_prefix.VOCABULARY)).collect()), key=str)
        want = []
        for r in docs.collect():
            ids = np.array(encoding.encode_ordinary(r["text"] or ""), dtype="<u4")
            want.append((r["doc_id"], len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((r["text"] or "").encode()).hexdigest()))
        assert got == sorted(want, key=str)


def test_packing_query(odd, nulls, none):
    encode = library(packing.VOCABULARY)
    for docs in (odd, nulls, none):
        got = packing.pack(docs, P.path(packing.VOCABULARY)).collect()
        want, places = [], defaultdict(list)
        for r in docs.collect():
            ids = np.array([*encode(r["text"]), 0], dtype="<u4")
            want += [(r["doc_id"], k, a, len(ids[a : a + 2048]), zlib.crc32(ids[a : a + 2048].tobytes())) for k, a in enumerate(range(0, len(ids), 2048))]
        assert sorted((tuple(r)[:5] for r in got), key=str) == sorted(want, key=str)
        for r in got:
            places[r["sequence_id"]].append((r["offset"], r["length"]))
        for runs in places.values():
            at = 0
            for offset, length in sorted(runs):
                assert offset == at
                at += length
            assert at <= 2048


@pytest.mark.parametrize("seed", range(4))
def test_plan_places_every_piece_once(seed):
    rng = np.random.default_rng(seed)
    lengths = np.minimum(2048, 1 + rng.exponential([300, 900, 2000, 60][seed], 8000)).astype(int)
    counts = {int(a): int(b) for a, b in zip(*np.unique(lengths, return_counts=True), strict=True)}
    plan, seen, fill = packing.plan_packing(counts), defaultdict(set), defaultdict(int)
    for length, rank, n, seq, offset in plan.runs:
        for i in range(n):
            assert rank + i not in seen[length]
            seen[length].add(rank + i)
            fill[seq + i] = max(fill[seq + i], offset + length)
    assert {k: len(v) for k, v in seen.items()} == counts
    assert max(fill.values()) <= 2048 and len(fill) == plan.sequences
    assert plan.sequences <= 1.06 * -(-int(lengths.sum()) // 2048) + 1
