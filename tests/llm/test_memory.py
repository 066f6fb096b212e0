"""That Python workers hold a bounded part of the texts at once."""

import sys
from pathlib import Path

import public_tokenizers as P
import pyarrow as pa
import pytest

from sitegraph.llm import langid, packing
from sitegraph.llm.common import shared_dir

sys.path.insert(0, str(Path(__file__).parents[2]))
import corpus_pipeline  # noqa: E402


@pytest.mark.parametrize("before, after", [("10000", 1000), ("0", 1000), ("300", 300)])
def test_pipeline_batches_are_small(spark, monkeypatch, before, after):
    monkeypatch.setattr(langid, "train", lambda docs: langid.fit(["word"], ["en"]))
    was = spark.conf.get(corpus_pipeline.BATCH_SETTING)
    try:
        spark.conf.set(corpus_pipeline.BATCH_SETTING, before)
        spark.range(1).selectExpr("id AS doc_id", "'a' AS text").write.parquet(path := f"{shared_dir(spark)}/documents.parquet")
        docs = spark.range(0, 2500, 1, 1).selectExpr("id AS doc_id", "concat('word ', id) AS text")
        out = corpus_pipeline.language_id(spark, docs, path.removesuffix("/documents.parquet"))
        sizes = docs.mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"n": pa.array([b.num_rows])}) for b in batches), "n long")
        assert max(r["n"] for r in sizes.collect()) == after
        assert out.count() == 2500
    finally:
        spark.conf.set(corpus_pipeline.BATCH_SETTING, was)


def test_packing_takes_a_batch_in_slices(monkeypatch):
    texts = [None if i % 50 == 0 else f"word {i} " * (i % 7) for i in range(1000)]
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(1000)), "text": pa.array(texts)})
    run, taken = packing.cut_pieces(P.path(packing.VOCABULARY), 8, 0), []
    encode = packing.encode_texts
    alone = [r for i in range(1000) for b in run(iter([batch.slice(i, 1)])) for r in b.to_pylist()]
    monkeypatch.setattr(packing, "encode_texts", lambda t, *a, **k: taken.append(len(t)) or encode(t, *a, **k))
    assert [r for b in run(iter([batch])) for r in b.to_pylist()] == alone
    assert sum(taken) == 1000 and max(taken) <= 256
