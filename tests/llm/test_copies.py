"""Exact copies, fingerprints and shards against plain Python."""

import hashlib
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from sitegraph.llm import exact_dedup, merkle, sharding


def plain(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def check_dedup(rows, got):
    groups = defaultdict(list)
    for r in rows:
        groups[plain(r["text"])].append(r["doc_id"])
    want = []
    for r in rows:
        own = groups[plain(r["text"])]
        keep = min((x for x in own if x is not None), default=None)
        want.append((r["doc_id"], keep, len(own), r["doc_id"] == keep, hashlib.sha256(plain(r["text"]).encode()).hexdigest()))
    order = lambda x: (x[0] is None, x[0] or 0, x[4])
    have = [(r["doc_id"], r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in got]
    assert sorted(have, key=order) == sorted(want, key=order)


@pytest.mark.parametrize("key", ["xxhash64", "weak"])
def test_dedup(odd, nulls, none, key):
    weak = lambda c: F.crc32(F.col(c) if isinstance(c, str) else c) % 7
    key_of = weak if key == "weak" else F.xxhash64
    for docs in (odd, nulls, none):
        check_dedup(docs.collect(), exact_dedup.exact_dedup(docs, key_of).collect())


def test_merkle(odd, none):
    rows = sorted(odd.dropDuplicates(["doc_id"]).collect(), key=lambda r: r["doc_id"])
    got = merkle.edited_fingerprints(odd).collect()
    assert len(got) == odd.count()
    by_id = {r["doc_id"]: r for r in got}
    for i, r in enumerate(rows):
        text, nxt = r["text"] or "", rows[(i + 1) % len(rows)]["text"] or ""
        k = len(text) // 4
        edited = text[: len(text) - k] + nxt[:k]
        mine = by_id[r["doc_id"]]
        assert mine["n_chars"] == len(text)
        assert mine["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert (mine["fingerprint"] == mine["edited_fingerprint"]) == (text == edited)
        assert 0 <= mine["near_edited"] <= 1 and 0 <= mine["near_next"] <= 1
    assert by_id[1]["fingerprint"] == by_id[3]["fingerprint"] != by_id[2]["fingerprint"]
    assert by_id[11]["near_next"] == 1.0 and by_id[9]["near_edited"] > 0.5 > by_id[8]["near_next"]
    assert merkle.edited_fingerprints(none).collect() == []


def test_merkle_null_id_and_single(nulls, spark):
    assert merkle.edited_fingerprints(nulls).count() == 4
    one = merkle.edited_fingerprints(spark.createDataFrame([(7, "one. text. alone.")], "doc_id long, text string")).first()
    assert one["near_next"] == 1.0


def test_unequal_texts_have_unequal_roots(spark):
    """These two share the first 40 bits of their digests."""
    rows = spark.createDataFrame([(1, "para 908510."), (2, "para 2383121."), (3, "para 908510.")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in merkle.edited_fingerprints(rows).collect()}
    assert got[1]["fingerprint"] == got[3]["fingerprint"] != got[2]["fingerprint"]
    assert got[1]["near_next"] == 0.0 and got[3]["near_next"] == 1.0


def test_rows_that_share_an_id(spark):
    """Rows of one id follow one another by their texts, null ids come first."""
    rows = [(7, "b. c."), (7, "a. d."), (None, "x."), (9, None)]
    got = sorted(merkle.edited_fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect(), key=str)
    assert len(got) == 4 and sorted(r["n_chars"] for r in got) == [0, 2, 5, 5]
    prints = {r["fingerprint"] for r in got}
    assert len(prints) == 4


def test_merkle_finds_the_edit(spark):
    a, b = "one.\ntwo. three.\nfour.", "one.\ntwo. 3.\nfour."
    rows = spark.createDataFrame([(1, a), (2, b)], "doc_id long, text string")
    prints = {r["doc_id"]: r["fingerprint"] for r in merkle.fingerprints(rows).collect()}
    pair = spark.createDataFrame([(prints[1], prints[2])], "a string, b string")
    out = pair.select(merkle.differing(F.col("a"), F.col("b")).alias("d"), merkle.likeness(F.col("a"), F.col("b")).alias("l")).first()
    assert out["d"] == [1] and out["l"] == pytest.approx(2 * 3 / 8)


def check_shards(rows, got):
    have = defaultdict(list)
    for r in got:
        have[r["shard"]].append(r["slot"])
    counts = [len(have[s]) for s in range(16)]
    assert sum(counts) == len(rows) and max(counts) - min(counts) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in have.values())
    order = lambda x: (x[0] is None, x)
    want = [(r["doc_id"] or 0, len((r["text"] or "").encode()) + 1, zlib.crc32((r["text"] or "").encode())) for r in rows]
    assert sorted(want, key=order) == sorted([(r["doc_id"] or 0, r["size"], r["text_crc32"]) for r in got], key=order)


def test_shards(odd, nulls, none):
    for docs in (odd, nulls, none):
        check_shards(docs.collect(), sharding.balanced_shards(docs).collect())


def test_shards_keep_groups_and_split_a_hot_one(spark):
    rows = [(i, "hot" if i % 3 == 0 else f"text {i // 4}" if i % 2 else f"alone {i}") for i in range(2400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sharding.balanced_shards(docs).collect()
    check_shards(docs.collect(), got)
    shards = defaultdict(set)
    for r in got:
        shards[rows[r["doc_id"]][1]].add(r["shard"])
    small = [len(s) for t, s in shards.items() if t.startswith("text")]
    assert sum(n > 1 for n in small) <= 0.02 * len(small)
    assert len(shards["hot"]) <= 9
