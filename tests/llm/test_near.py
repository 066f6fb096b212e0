"""The near-copy join and the pipeline against brute force."""

import itertools
import random
import re
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sitegraph.llm import components, langid, packing, tgm_join, toxicity


def shingles(text, size):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else [])


def brute(rows, size, percent):
    """doc_id, set size, component and number of links of each row that has an id."""
    sets = [(r["doc_id"], shingles(r["text"], size)) for r in rows if r["doc_id"] is not None]
    root = {i: i for i, _ in sets}

    def head(x):
        while root[x] != x:
            x = root[x]
        return x

    links = [0] * len(sets)
    for (i, (a, s)), (j, (b, t)) in itertools.combinations(enumerate(sets), 2):
        both = len(s & t)
        if s and t and 100 * both >= percent * (len(s) + len(t) - both):
            links[i] += 1
            links[j] += 1
            x, y = head(a), head(b)
            root[max(x, y)] = min(x, y)
    return sorted((i, len(s), head(i), n) for (i, s), n in zip(sets, links, strict=True))


def check(docs, size, percent):
    got = tgm_join.ngram_jaccard(docs, size, percent).collect()
    assert len(got) == docs.count()
    assert sorted(tuple(r) for r in got if r["doc_id"] is not None) == brute(docs.collect(), size, percent)
    assert all(r["component_id"] is None for r in got if r["doc_id"] is None)


@pytest.mark.parametrize("size,percent", [(3, 90), (5, 80)])
def test_odd(odd, nulls, none, size, percent):
    for docs in (odd, nulls, none):
        check(docs, size, percent)


def family(seed, n=160):
    """Texts with edits of every strength around the threshold, shared passages and copies."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    passage, bases = [word() for _ in range(40)], [[word() for _ in range(rng.randint(5, 150))] for _ in range(8)]
    rows = []
    for i in range(n):
        w = list(rng.choice(bases))
        for _ in range(rng.randint(0, 8)):
            w[rng.randrange(len(w))] = word()
        if rng.random() < 0.3:
            w += passage
        rows.append((i, " ".join(w)))
    return rows + [(n + i, t) for i, (_, t) in enumerate(rows[:20])]


@pytest.mark.parametrize("seed", [1, 2])
def test_families(spark, seed, monkeypatch):
    monkeypatch.setattr(tgm_join, "BLOCK", 8)
    check(spark.createDataFrame(family(seed), "doc_id long, text string"), 3, 90)
    check(spark.createDataFrame(family(seed), "doc_id long, text string"), 3, 60)


def test_ids_that_several_texts_share(spark):
    a, b = " ".join(f"a{i}" for i in range(60)), " ".join(f"b{i}" for i in range(60))
    rows = [(1, a), (5, a), (5, b), (7, b), (3, b + " c"), (7, ""), (9, None), (9, "alone with some words"), (11, "  ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    check(docs, 3, 90)
    got = {(r["doc_id"], r["component_id"]) for r in tgm_join.ngram_jaccard(docs, 3, 90).collect()}
    assert {(i, 1) for i in (1, 5, 7, 3)} <= got


def test_large_family(spark):
    """2000 near copies: their groups stay few, and so do the cells that are met."""
    rng = random.Random(4)
    base = [f"w{i}" for i in range(80)]
    rows = []
    for i in range(2000):
        w = list(base)
        w[rng.randrange(len(w))] = f"x{i % 900}"
        rows.append((i, " ".join(w)))
    rows += [(3000 + i, " ".join(base[:40] + [f"y{i}z{j}" for j in range(40)])) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    classes = docs.mapInArrow(tgm_join.class_rows(5, 80, np.zeros(0, np.uint64), np.zeros(0, np.int64)), "doc_id long, n long, node binary, bands array<long>, first array<long>")
    classes = classes.dropDuplicates(["node"]).withColumn("c", F.xxhash64("node"))
    groups = tgm_join.grouped(classes).groupBy("g").count().collect()
    assert sorted(r["count"] for r in groups)[-1] > 0.9 * 1900
    check(docs, 5, 80)


def test_bound_between_the_sizes():
    """No member of any size needs fewer shared first tokens than the bound of its group asks."""
    for percent in (80, 90):
        need = lambda n, m: -(-(n + m) * percent // (100 + percent))
        rest = lambda n: -(-n * percent // 100) - 1
        asked = lambda n, m: need(n, m) - max(rest(n), rest(m))
        for n in range(1, 200):
            least, most = -(-n * percent // 100), n * 100 // percent
            for lo in range(least, most + 1):
                bound = min(asked(n, lo), asked(n, most)) - (most > n)
                assert bound <= min(asked(n, m) for m in range(lo, most + 1))


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, j) for j in range(101, 140)] + [(200, 201), (201, 202), (202, 200), (300, 300)]
    random.Random(0).shuffle(edges)
    got = {r["vertex"]: r["component"] for r in components.connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{j: 100 for j in range(100, 140)}, 200: 200, 201: 200, 202: 200}
    assert components.connected(spark.createDataFrame([], "a long, b long")).count() == 0


def test_pipeline_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    crf, model = langid.train(docs), toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    rows = docs.collect()
    known = {r["doc_id"] for r in langid.languages(docs, crf).collect() if r["lang_pred"] != "und"}
    clean = {r["doc_id"] for r in toxicity.toxicity(docs, model).collect() if r["score"] < corpus_pipeline.TOXIC}
    rows = [r for r in rows if r["doc_id"] in known & clean]
    first = {}
    for r in sorted(rows, key=lambda r: r["doc_id"]):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", r["text"] or ""), r)
    rows = list(first.values())
    rows = [r for r, (i, _, comp, _) in zip(sorted(rows, key=lambda r: r["doc_id"]), brute(rows, corpus_pipeline.SHINGLE, corpus_pipeline.PERCENT), strict=True) if i == comp]
    got = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r["doc_id"] for r in got} == {r["doc_id"] for r in rows}
    encode = packing.library_memory(P.path(packing.VOCABULARY)).tokenizer
    sizes = {r["doc_id"]: len(encode.encode(r["text"], add_special_tokens=False).ids) + 1 for r in rows}
    total = defaultdict(int)
    for r in got:
        total[r["doc_id"]] += r["length"]
    assert total == sizes
    assert len({r["sequence_id"] for r in got}) <= 1.05 * np.ceil(sum(sizes.values()) / 2048) + 1


def test_pipeline_stages_on_odd_rows(spark, odd, none, nulls, labels, tmp_path):
    odd.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    for start in (odd, none, nulls):
        docs = start
        for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
            docs = stage(spark, docs, str(tmp_path))
            if i < 4:
                assert docs.columns == list(corpus_pipeline.COLUMNS)
        docs.collect()
