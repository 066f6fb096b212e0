"""The learned ranker of candidate hosts: boosted trees over search features, checked by folds of companies."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .discovery import top_candidates

FEATURES = [
    "sim_title", "sim_host", "sim_snippet", "city_in", "plz_in", "street_in", "best_rank", "n_hits",
    "n_queries", "listed", "host_freq", "tld_de", "label_len", "label_is_key", "legal_form_in_title", "n_engines",
]
FOLDS = 5


def fit(rows: DataFrame, features: list[str] = FEATURES, trees: int = 60, depth: int = 4, rate: float = 0.1) -> PipelineModel:
    """Trees over rows(label 0/1, features); a null feature counts as -1.

    label: whether the host is the company's verified one, so nothing is labelled by hand.
    """
    model = GBTClassifier(featuresCol="features", labelCol="label", maxIter=trees, maxDepth=depth, stepSize=rate, seed=0)
    return Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="features"), model]).fit(_plain(rows, features).withColumn("label", F.col("label").cast("double")))


def _plain(rows: DataFrame, features: list[str]) -> DataFrame:
    return rows.withColumns({f: F.coalesce(F.col(f).cast("double"), F.lit(-1.0)) for f in features})


def score(model: PipelineModel, rows: DataFrame, features: list[str] = FEATURES) -> DataFrame:
    """rows with p, the probability that a host is the company's own."""
    own = [F.col(f"own.{c}").alias(c) for c in rows.columns]
    out = model.transform(_plain(rows.withColumn("own", F.struct(*rows.columns)), features))
    return out.select(*own, vector_to_array("probability")[1].alias("p"))


def out_of_fold(rows: DataFrame, features: list[str] = FEATURES, folds: int = FOLDS, **trees) -> DataFrame:
    """rows(id, host, label, features) with p of a model that has not seen the company."""
    dealt = rows.withColumn("fold", F.pmod(F.xxhash64("id"), F.lit(folds)))
    out = None
    for k in range(folds):
        # A fold model costs a few passes over the others; the number of folds is fixed.
        scored = score(fit(dealt.where(F.col("fold") != k), features, **trees), dealt.where(F.col("fold") == k), features)
        out = scored if out is None else out.unionByName(scored)
    return out.drop("fold")


def group_metrics(scored: DataFrame, sure: float = 0.5) -> DataFrame:
    """One row: companies, how many have their host among the candidates (found), how often the best one is right
    (top1), how often it is sure (n_sure), and right where it is sure (sure_right). Of equal p the first host is best."""
    best = scored.groupBy("id").agg(
        F.max("label").alias("found"), F.min_by("label", F.struct(-F.col("p"), "host")).alias("right"), F.max("p").alias("p")
    )
    sure_one = F.col("p") >= sure
    return best.agg(
        F.count("*").alias("companies"),
        F.coalesce(F.sum("found"), F.lit(0)).cast("long").alias("found"),
        F.coalesce(F.sum("right"), F.lit(0)).cast("long").alias("top1"),
        F.count_if(sure_one).alias("n_sure"),
        F.coalesce(F.sum(F.when(sure_one, F.col("right"))), F.lit(0)).cast("long").alias("sure_right"),
    )


def candidates(model: PipelineModel, rows: DataFrame, least: float = 0.3, top: int = 3, features: list[str] = FEATURES) -> DataFrame:
    """The hosts to verify for each company, at most top of those with a probability of least and on no list."""
    return top_candidates(score(model, rows, features).withColumn("listed", F.col("listed") > 0), least, top)
