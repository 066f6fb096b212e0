"""Exact de-duplication by recipes of content-defined chunks (DataFrame functions only).

Every normalised text is cut where its own content says so, so that equal passages give equal
chunks wherever they stand. The texts are read once, for their recipes: a key and a SHA-256 digest
for each chunk. Each distinct key and digest is moved once, to give the chunk a verified identifier;
texts are then compared as ordered identifier lists, which are about a hundredth of their length.
An identifier is (64-bit key, variant): where chunks of one key differ in their digests, the
variant tells them apart, so that a key collision cannot merge texts.

Defined results: a null text counts as empty, all empty texts are equal; rows that repeat a
doc_id share its fate; null ids sort after all others and stay only where no row of the group has
an id; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BLANKS, only, read_table, stage_table

#: Fewest and most characters of a chunk, and the character pair that ends one.
MIN_CHUNK, MAX_CHUNK = 192, 3072
END_PAIR = r"[aeiou .][dhnrst.!]"


def chunk_pattern(least: int = MIN_CHUNK, most: int = MAX_CHUNK, end_pair: str = END_PAIR) -> str:
    return rf"(?s).{{{least},{most - 2}}}?(?:{end_pair}|\z)|.{{1,{most}}}"


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, " ")


def chunks_of(norm: Column) -> Column:
    """The cut follows the words: a chunk runs to the first end pair beyond the least length."""
    return F.regexp_extract_all(norm, F.lit(chunk_pattern()), F.lit(0))


def clashing_chunks(made: DataFrame) -> DataFrame:
    """key, variant, clash_digest of the keys that several distinct chunks have; variants 0, 1, ...
    go in digest order. No chunk's bytes are moved, and each distinct digest once."""
    keyed = made.select(F.explode("recipe").alias("r")).select("r.key", "r.digest").distinct()
    several = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    return (
        keyed.join(several, "key", "left_semi")
        .groupBy("key")
        .agg(F.array_sort(F.collect_list("digest")).alias("same"))
        .select("key", F.posexplode("same").alias("variant", "clash_digest"))
    )


def chunk_recipes(docs: DataFrame, key_of=F.xxhash64) -> DataFrame:
    """doc_id, text_sha256, keys, variants: the ordered identifiers of each row's chunks.

    variants lists (position, variant) where a key has several chunks, and is empty elsewhere.
    """
    base = only(docs, "doc_id", "text").select("doc_id", normalised(F.col("text")).alias("norm"))
    recipe = F.transform(chunks_of(F.col("norm")), lambda c: F.struct(key_of(c).alias("key"), F.unhex(F.sha2(c, 256)).alias("digest")))
    made = stage_table(base.select("doc_id", F.sha2("norm", 256).alias("text_sha256"), recipe.alias("recipe")), "recipes")
    recipes = made.select("doc_id", "text_sha256", F.col("recipe.key").alias("keys"))
    clash = stage_table(clashing_chunks(made), "clashing_chunks")
    if clash.isEmpty():
        return recipes.withColumn("variants", F.lit(""))
    variants = (
        made.select("text_sha256", F.posexplode("recipe").alias("pos", "r"))
        .join(clash, (F.col("r.key") == F.col("key")) & (F.col("r.digest") == F.col("clash_digest")))
        .where("variant > 0")
        .groupBy(F.col("text_sha256").alias("v_sha"))
        .agg(F.to_json(F.array_sort(F.collect_set(F.struct("pos", "variant")))).alias("variants"))
    )
    return recipes.join(variants, F.col("text_sha256") == F.col("v_sha"), "left").select(
        "doc_id", "text_sha256", "keys", F.coalesce("variants", F.lit("")).alias("variants")
    )


def exact_dedup(docs: DataFrame, key_of=F.xxhash64) -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, text_sha256, n_chunks.

    The groups are counted with partial sums before the shuffle; the join back is one that Spark
    can split where a group holds a large share of the rows.
    """
    recipes = chunk_recipes(docs, key_of)
    groups = recipes.groupBy(F.col("keys").alias("g_keys"), F.col("variants").alias("g_variants")).agg(
        F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size")
    )
    same = (F.col("keys") == F.col("g_keys")) & (F.col("variants") == F.col("g_variants"))
    return recipes.join(groups, same).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
        F.size("keys").cast("long").alias("n_chunks"),
    )


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read_table(spark, sf_dir, "documents")).drop("n_chunks")


ORACLE_SQL = r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
)
SELECT doc_id,
       min(doc_id) OVER (PARTITION BY norm) AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY norm) AS kept,
       sha256(norm) AS text_sha256
FROM n
"""
