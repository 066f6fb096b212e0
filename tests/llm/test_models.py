"""The trained operators: held-out quality, and defined results on odd input."""

import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest

from sitegraph.llm import attention_lm, langid, packing, toxicity

SF = "/root/testdata/sf0.01"


def fold(doc_id, m):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % m


def test_toxicity_held_out(spark):
    got = toxicity.op2_ftrl_toxicity(spark, SF).toPandas()
    assert (got.held_out == [fold(i, 5) == 0 for i in got.doc_id]).all()
    assert got.score.between(0, 1).all() and ((got.score >= 0.5) == (got.predicted == 1)).all()
    rows = spark.read.parquet(f"{SF}/labels.parquet").toPandas().merge(got[got.held_out], on="doc_id")
    y, rank = rows.toxic == 1, rows.score.rank()
    assert (rank[y].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (~y).sum()) > 0.9


def test_toxicity_odd(odd, nulls, none, labels):
    model = toxicity.train(odd, labels)
    for docs in (odd, nulls, none):
        got = toxicity.toxicity(docs, model).toPandas()
        assert len(got) == docs.count() and got.score.between(0, 1).all()
        assert toxicity.keep_clean(docs, model, 2.0).count() == docs.count()
        assert toxicity.keep_clean(docs, model, 0.0).count() == 0
    empty = toxicity.train(none, labels.limit(0))
    assert set(toxicity.toxicity(odd, empty).toPandas().score) == {0.5}


@pytest.mark.parametrize("kind", ["int", "decimal(20,0)"])
def test_ids_of_another_type(odd, labels, kind):
    """The pipeline's typed stages on ids that are no longs."""
    docs = odd.withColumn("doc_id", odd.doc_id.cast(kind))
    model, own = toxicity.train(odd, labels), toxicity.train(docs, labels.withColumn("doc_id", labels.doc_id.cast(kind)))
    assert own.bias == model.bias and (own.at == model.at).all() and (own.weight == model.weight).all()
    assert toxicity.keep_clean(docs, own, 2.0).schema["doc_id"] == docs.schema["doc_id"]
    path = P.path(packing.VOCABULARY)
    for run in (lambda d: toxicity.toxicity(d, model), lambda d: langid.languages(d, None), lambda d: packing.pack(d, path).drop("sequence_id", "offset")):
        assert sorted(map(str, run(docs).collect())) == sorted(map(str, run(odd).collect()))


def test_langid_held_out(spark):
    got = langid.op8_crf_langid(spark, SF).toPandas()
    assert (got.held_out == [fold(i, 4) == 2 for i in got.doc_id]).all() and got.score.between(0, 1).all()
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").toPandas().merge(got[got.held_out], on="doc_id")
    assert (rows.lang == rows.lang_pred).mean() > 0.97


def test_langid_odd(odd, nulls, none):
    crf = langid.train(odd)
    got = {r["doc_id"]: r for r in langid.languages(odd, crf).collect()}
    assert {i for i, r in got.items() if r["lang_pred"] == "und"} == {4, 5, 6, 8}
    assert all(r["score"] == 0 for r in got.values() if r["lang_pred"] == "und")
    assert sorted(r["doc_id"] for r in langid.keep_known(odd, crf).collect()) == [1, 2, 3, 7, 9, 10, 11, 12, 13, 13, 14, 15]
    assert langid.train(none) is None
    assert {r["lang_pred"] for r in langid.languages(odd, None).collect()} == {"und"}
    assert langid.languages(none, crf).count() == 0 and langid.languages(nulls, crf).count() == 4


def test_forward_backward_is_enumeration():
    rng = np.random.default_rng(0)
    emit, start, move = rng.normal(size=(7, 3)), rng.normal(size=3), rng.normal(size=(3, 3))
    lengths, pairs = np.array([4, 1, 2]), np.zeros((3, 3))
    got, want, want_pairs, at = langid.marginals(emit, lengths, start, move, pairs), np.zeros((7, 3)), np.zeros((3, 3)), 0
    for n in lengths:
        total, own, two = 0.0, np.zeros((n, 3)), np.zeros((3, 3))
        for path in np.ndindex(*[3] * n):
            w = math.exp(start[path[0]] + sum(emit[at + t, path[t]] for t in range(n)) + sum(move[path[t], path[t + 1]] for t in range(n - 1)))
            total += w
            for t in range(n):
                own[t, path[t]] += w
                if t:
                    two[path[t - 1], path[t]] += w
        want[at : at + n], want_pairs, at = own / total, want_pairs + two / total, at + n
    assert np.allclose(got, want) and np.allclose(pairs, want_pairs)


@pytest.mark.parametrize("size", [1, 2, 5, 7])
def test_messages_over_the_borders_of_segments_are_exact(size, monkeypatch):
    rng = np.random.default_rng(size)
    lengths = np.array([1, 40, 5, 7, 14, 23, 2])
    emit, start, move = rng.normal(size=(lengths.sum(), 4)) * 3, rng.normal(size=4), rng.normal(size=(4, 4)) * 2
    whole = langid.marginals(emit, lengths, start, move)
    monkeypatch.setattr(langid, "SEGMENT", size)
    assert np.allclose(langid.marginals(emit, lengths, start, move), whole, atol=1e-12)


def test_code_switch_is_labelled_word_by_word(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    crf = langid.train(docs)
    some = {lang: docs.where(f"lang = '{lang}' AND n_chars > 2000").first()["text"].split()[:60] for lang in ("en", "fr")}
    text = " ".join(some["en"] + some["fr"])
    w = next(langid.words(pa.array([text]), marks=False))
    best = crf.label(w).argmax(axis=1)
    half = len(best) // 2
    assert (best[: half - 10] == crf.langs.index("en")).mean() > 0.9 and (best[half + 10 :] == crf.langs.index("fr")).mean() > 0.9


def small_model(steps=60):
    texts = [f"the cat number {i % 17} sat on the red mat. " * 3 for i in range(200)]
    units = attention_lm.Units(P.path(attention_lm.VOCABULARY), attention_lm.encode_texts(attention_lm.plain(pa.array(texts)), attention_lm.library_memory(P.path(attention_lm.VOCABULARY)), True)[0])
    return attention_lm.fit(*units.encode(attention_lm.plain(pa.array(texts))), steps=steps), units


def test_gradients_are_differences():
    rng = np.random.default_rng(0)
    p = {k: v.astype(np.float64) for k, v in attention_lm.start_weights().items()}
    shape = (3, attention_lm.WINDOW)
    one, two, target = (rng.integers(0, attention_lm.UNITS, shape) for _ in range(3))
    inside = np.ones(shape, dtype=bool)
    inside[0, :5] = False
    g = attention_lm.gradients(p, one, two, target, inside, inside)

    def loss():
        z = attention_lm.forward(p, one, two, inside)["z"][inside]
        t = target[inside]
        log_softmax = lambda x: x - np.log(np.exp(x).sum())
        total = 0.0
        for state, unit in zip(z, t, strict=True):
            c, m = divmod(unit, attention_lm.MEMBERS)
            total += log_softmax(state @ p["c"] + p["cb"])[c] + log_softmax(state @ p["m"][c] + p["mb"][c])[m]
        return -total / len(t)

    for name, at in (("q", (1, 2)), ("k", (3, 4)), ("v", (0, 5)), ("o", (2, 2)), ("h", (1, 7)), ("u", (3, 3)), ("pos", (9, 1)), ("c", (0, 3)), ("one", (int(one[1, 4]), 2)), ("m", (int(target[1, 1]) // attention_lm.MEMBERS, 3, 5))):
        kept = p[name][at]
        p[name][at] = kept + 1e-5
        up = loss()
        p[name][at] = kept - 1e-5
        down = loss()
        p[name][at] = kept
        assert (up - down) / 2e-5 == pytest.approx(g[name][at], rel=2e-3, abs=1e-7), name


@pytest.mark.parametrize("scale", [1.0, 6.0])
def test_passes_are_a_plain_loop_over_places(scale):
    """States and log probabilities against one place at a time, with exponents in and out of the safe range."""
    rng = np.random.default_rng(5)
    p = {k: v.astype(np.float64) * scale for k, v in attention_lm.start_weights().items()}
    w, d, members = attention_lm.WINDOW, attention_lm.WIDTH, attention_lm.MEMBERS
    one, two, target = (rng.integers(0, attention_lm.UNITS, (2, w)) for _ in range(3))
    inside = np.ones((2, w), dtype=bool)
    inside[0, :6] = False
    got = attention_lm.forward(p, one, two, inside)["z"]
    logs = attention_lm.log_probs(p, got[inside], target[inside])
    want, want_logs = [], []
    for i in range(2):
        x = [p["one"][one[i, j]] + p["two"][two[i, j]] + p["pos"][j] for j in range(w)]
        for j in np.flatnonzero(inside[i]):
            of = [k for k in range(j + 1) if inside[i, k]]
            a = np.array([(x[j] @ p["q"]) @ (x[k] @ p["k"]) / d**0.5 for k in of])
            a = np.exp(a - a.max())
            y = x[j] + (sum(b * (x[k] @ p["v"]) for b, k in zip(a, of, strict=True)) / a.sum()) @ p["o"]
            z = y + np.maximum(y @ p["h"] + p["hb"], 0) @ p["u"]
            c, m = divmod(target[i, j], members)
            log = 0.0
            for e, at in ((z @ p["c"] + p["cb"], c), (z @ p["m"][c] + p["mb"][c], m)):
                log += e[at] - e.max() - np.log(np.exp(e - e.max()).sum())
            want.append(z)
            want_logs.append(log)
    assert np.allclose(got[inside], want, rtol=1e-6, atol=1e-9)
    assert np.allclose(logs, want_logs, rtol=1e-6)


def test_probabilities_of_a_next_unit_sum_to_one():
    p, units = small_model()
    z = np.random.default_rng(1).standard_normal((1, attention_lm.WIDTH)).astype(np.float32)
    every = np.arange(attention_lm.UNITS)
    logs = attention_lm.log_probs(p, np.repeat(z, len(every), axis=0), every)
    assert np.exp(logs).sum() == pytest.approx(1.0, abs=1e-4)
    cut = np.concatenate([[0], np.cumsum([5, 1, 400, 33])])
    u = np.random.default_rng(2).integers(0, 300, cut[-1])
    alone = [attention_lm.text_scores(p, u[a:b], np.array([0, b - a]))[0] for a, b in zip(cut[:-1], cut[1:], strict=True)]
    assert np.allclose(attention_lm.text_scores(p, u, cut), alone, rtol=1e-4)


def check_base(rows, got):
    words = [[*(r["text"] or "").encode().lower().split(), None] for r in rows]
    c = Counter(w for r, own in zip(rows, words, strict=True) if fold(r["doc_id"], 10) for w in own)
    total = sum(c.values())
    want = sorted((str(r["doc_id"]), len(own), sum(c[w] > 0 for w in own), round(sum(math.log10((c[w] + 0.1) / (total + 0.1 * (len(c) + 1))) for w in own), 4)) for r, own in zip(rows, words, strict=True))
    have = sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], round(r["base_score"], 4)) for r in got)
    assert have == want and all(r["train_tokens"] == total for r in got)
    assert all(r["held_out"] == (fold(r["doc_id"], 10) == 0) and r["score"] < 0 for r in got)


def test_lm_odd(odd, nulls, none, monkeypatch):
    monkeypatch.setattr(attention_lm, "FREQUENT", 5)
    weights, units = small_model(5)
    monkeypatch.setattr(attention_lm, "train", lambda *a: (weights, units))
    for docs in (odd, nulls, none):
        check_base(docs.collect(), attention_lm.score_texts(docs, P.path(attention_lm.VOCABULARY)).collect())


def test_lm_beats_the_base_on_held_out(spark):
    got = attention_lm.op7_attention_lm(spark, SF).collect()
    check_base(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect(), got)
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
