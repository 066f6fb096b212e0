"""The corpus pipeline: documents to packed sequences, one operator a stage.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame.
run() writes each stage's result as Parquet to the shared folder and rereads it for the next one.
All but the last return the columns of documents.

Defined results: rows that the language and toxicity stages keep include those without a label;
rows with a null doc_id pass the first two stages like others and are kept by the two copy stages;
of equal texts the least id stays, of near copies the least id of a group; rows that share an
id share its fate; further columns are dropped; the models learn from the documents and labels of sf_dir, not from what a stage was given.
Texts go to Python workers whole, in batches of BATCH_ROWS rows at most: the first stage lowers the session's
setting, where it is larger, and leaves it so, as its result is read later.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitegraph.llm import exact_dedup, langid, packing, tgm_join, toxicity
from sitegraph.llm.common import read_table, shared_dir

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Documents with a score of at least this are rejected as toxic.
TOXIC = 0.5
#: Words of a shingle and per cent of similarity of near copies.
SHINGLE, PERCENT = 5, 80
#: Rows that a Python worker gets at once; each batch is held by the executor and by its worker.
BATCH_ROWS, BATCH_SETTING = 1000, "spark.sql.execution.arrow.maxRecordsPerBatch"


def _columns(docs: DataFrame) -> DataFrame:
    return docs.select(*[F.col(f"`{c}`") for c in COLUMNS if c in docs.columns])


def _small_batches(spark: SparkSession) -> None:
    if not 0 < int(spark.conf.get(BATCH_SETTING)) <= BATCH_ROWS:
        spark.conf.set(BATCH_SETTING, BATCH_ROWS)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Labels every text; those in which no language is found (no letters) go."""
    _small_batches(spark)
    crf = langid.train(read_table(spark, sf_dir, "documents"))
    docs = _columns(docs)
    return langid.keep_known(docs, crf)


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Scores every text; toxic ones go."""
    model = toxicity.train(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(_columns(docs), model, TOXIC)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal after their white space, the row with the least id stays."""
    return _kept(_columns(docs), exact_dedup.exact_dedup(docs).where("NOT kept"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked near copies, the document with the least id stays."""
    found = tgm_join.ngram_jaccard(docs, SHINGLE, PERCENT)
    return _kept(_columns(docs), found.where("component_id <> doc_id"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs all documents that are left; a row for each piece."""
    return packing.pack(docs, public_tokenizers.path(packing.VOCABULARY))


def _kept(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """docs without the dropped ids."""
    gone = dropped.select(F.col("doc_id").alias("gone_id")).distinct()
    return docs.join(gone, F.col("doc_id") == F.col("gone_id"), "left_anti")


STAGES = [
    ("language_id", language_id),
    ("toxicity", toxicity_filter),
    ("exact_dedup", exact_copies),
    ("ngram_jaccard_join", near_copies),
    ("best_fit_packing", best_fit_packing),
]

#: The models and the packing are beyond SQL; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, folder = read_table(spark, sf_dir, "documents"), shared_dir(spark)
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        out = stage(spark, docs, sf_dir)
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
