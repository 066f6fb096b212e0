"""Merkle fingerprints over paragraphs and sections (DataFrame functions only).

A text's lines are its sections; a section's paragraphs are its sentences, cut again where one
runs past LEAF_CHARS. The tree's root is a digest of the section digests, a section's a digest of
its paragraph digests, all of them whole. Equal roots mean equal texts; where roots differ, the
sections and then the paragraphs that differ tell where the edit is (see differing()).

The fingerprint is the tree as text: the root, then each section's and its paragraphs' digests, of
which SECTION_HEX and LEAF_HEX digits are written. Its likeness to another is the Dice measure of
the two sets of written paragraph digests.

Defined results: a null text counts as empty; the empty text has one empty section; two empty
texts have likeness 1; the row after the last is the first, so a table of one row follows itself;
rows that repeat a doc_id are ordered by a hash of their text; a null id comes first; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import only, read_table, stage_table

#: Most characters of a paragraph leaf, and hex digits written of a leaf's and a section's digest.
LEAF_CHARS, LEAF_HEX, SECTION_HEX = 96, 16, 16
#: Stands for a null id in joins.
NO_ID = -(1 << 63)
LEAF = rf"[^.!?]{{1,{LEAF_CHARS}}}[.!?]*|[.!?]+"


def leaf_digests(text: Column) -> Column:
    """array<array<string>>: for each section the whole digests of its paragraphs."""
    return F.transform(
        F.split(text, "\n", -1),
        lambda s: F.transform(F.regexp_extract_all(s, F.lit(LEAF), F.lit(0)), lambda p: F.md5(p)),
    )


def written(leaves: Column) -> Column:
    """What a fingerprint holds of each paragraph's digest."""
    return F.transform(leaves, lambda x: F.substring(x, 1, LEAF_HEX))


def fingerprint_of(leaves: Column) -> Column:
    """root|section:leaf,leaf,...;section:leaf,... from leaf_digests()."""
    sections = F.transform(leaves, lambda s: F.md5(F.array_join(s, ",")))
    body = F.transform(
        F.arrays_zip(sections.alias("x"), leaves.alias("y")),
        lambda z: F.concat(F.substring(z["x"], 1, SECTION_HEX), F.lit(":"), F.array_join(written(z["y"]), ",")),
    )
    return F.concat(F.sha2(F.array_join(sections, ";"), 256), F.lit("|"), F.array_join(body, ";"))


def leaf_set(fingerprint: Column) -> Column:
    """The distinct paragraph digests that a fingerprint holds."""
    body = F.regexp_replace(F.substring_index(fingerprint, "|", -1), rf"[0-9a-f]{{{SECTION_HEX}}}:", "")
    return F.filter(F.array_distinct(F.split(body, "[,;]")), lambda x: x != "")


def set_likeness(a: Column, b: Column) -> Column:
    both = F.size(a) + F.size(b)
    return F.when(both == 0, F.lit(1.0)).otherwise(2.0 * F.size(F.array_intersect(a, b)) / both)


def likeness(a: Column, b: Column) -> Column:
    """0 to 1 from two fingerprints alone; 1 where they are equal."""
    return F.when(a == b, F.lit(1.0)).otherwise(set_likeness(leaf_set(a), leaf_set(b)))


def differing(a: Column, b: Column) -> Column:
    """The numbers (from 0) of a's sections whose digests differ from b's at the same place."""
    parts = lambda f: F.split(F.substring_index(f, "|", -1), ";")
    return F.filter(
        F.transform(F.arrays_zip(parts(a).alias("x"), parts(b).alias("y")), lambda z, i: F.when(z["x"].eqNullSafe(z["y"]), F.lit(-1)).otherwise(i)),
        lambda i: i >= 0,
    )


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, fingerprint for each row of docs(doc_id, text)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return only(docs, "doc_id", "text").select(
        "doc_id", F.length(text).cast("long").alias("n_chars"), fingerprint_of(leaf_digests(text)).alias("fingerprint")
    )


def row_places(base: DataFrame) -> tuple[DataFrame, int]:
    """k, h, n, at of the distinct rows of base(k, h, n), at being the place by (k, h) from 0.

    Only ids, digests and lengths are sorted; each range of the sort is numbered on its own, and
    the ranges' sizes, one number for each shuffle partition, are summed on the driver.
    """
    ids = stage_table(
        base.distinct().orderBy("k", "h", "n").withColumn("mid", F.monotonically_increasing_id()),
        "order",
    ).withColumn("part", F.shiftright("mid", 33))
    sizes = {r["part"]: r["rows"] for r in ids.groupBy("part").agg(F.count("*").alias("rows")).collect()}
    first, total = [], 0
    for part in sorted(sizes):
        first.append((part, total))
        total += sizes[part]
    starts = base.sparkSession.createDataFrame(first or [(0, 0)], "part long, first long")
    at = F.col("first") + F.col("mid").bitwiseAND(F.lit((1 << 33) - 1))
    return ids.join(F.broadcast(starts), "part").select("k", "h", "n", at.alias("at")), total


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Each row's tree, its edited text's tree, and the likeness of its tree to that and the next row's.

    The texts are shuffled once, by id; what a row needs of the next one (its first characters and
    its paragraph digests) travels to it alone, so that no order of whole texts is ever formed.
    """
    text = F.coalesce("text", F.lit(""))
    base = only(docs, "doc_id", "text").select(
        F.coalesce("doc_id", F.lit(NO_ID)).alias("k"), F.xxhash64(text, F.isnull("doc_id")).alias("h"), text.alias("text")
    )
    places, total = row_places(base.select("k", "h", F.length("text").cast("long").alias("n")))
    before = places.select(
        F.col("k").alias("b_k"), F.col("h").alias("b_h"), F.floor(F.col("n") / 4).alias("need"), ((F.col("at") + 1) % F.lit(max(total, 1))).alias("at")
    )
    links = places.join(before, "at").select("k", "h", "b_k", "b_h", "need")
    texts = base.join(links, ["k", "h"])
    sent = texts.select(
        F.col("b_k").alias("k"),
        F.col("b_h").alias("h"),
        F.expr("substring(text, 1, cast(need AS int))").alias("head"),
        F.array_join(F.array_distinct(written(F.flatten(leaf_digests(F.col("text"))))), ",").alias("next_leaves"),
    ).dropDuplicates(["k", "h"])
    rows = texts.join(sent, ["k", "h"]).withColumn("n", F.length("text").cast("long"))
    rows = rows.withColumn("doc_id", F.when(F.col("k") != NO_ID, F.col("k")))
    rows = rows.select(
        "doc_id",
        "n",
        "next_leaves",
        leaf_digests(F.col("text")).alias("leaves"),
        F.concat(F.expr("substring(text, 1, cast(n - floor(n / 4) AS int))"), "head").alias("edited"),
    )
    rows = rows.withColumn("edited_leaves", leaf_digests(F.col("edited"))).withColumn("edited_sha256", F.sha2("edited", 256)).drop("edited")
    own = F.array_distinct(written(F.flatten("leaves")))
    changed = F.array_distinct(written(F.flatten("edited_leaves")))
    theirs = F.filter(F.split("next_leaves", ","), lambda x: x != "")
    return rows.select(
        "doc_id",
        F.col("n").alias("n_chars"),
        "edited_sha256",
        fingerprint_of(F.col("leaves")).alias("fingerprint"),
        fingerprint_of(F.col("edited_leaves")).alias("edited_fingerprint"),
        set_likeness(own, changed).alias("near_edited"),
        set_likeness(own, theirs).alias("near_next"),
    )


def op4_merkle_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(read_table(spark, sf_dir, "documents"))


_LEAF = LEAF.replace("{", "{{").replace("}", "}}")
_TREE = f"""list_transform(string_split({{t}}, chr(10)), lambda s: list_transform(regexp_extract_all(s, '{_LEAF}'), lambda p: md5(p)))"""
_ROOT = """sha256(array_to_string(list_transform({l}, lambda s: md5(array_to_string(s, ','))), ';'))"""
_BODY = f"""list_transform({{l}}, lambda s: substr(md5(array_to_string(s, ',')), 1, {SECTION_HEX}) || ':' || array_to_string(list_transform(s, lambda x: substr(x, 1, {LEAF_HEX})), ','))"""
_SET = f"""list_distinct(list_transform(flatten({{l}}), lambda x: substr(x, 1, {LEAF_HEX})))"""
_PRINT = f"""{_ROOT} || '|' || array_to_string({_BODY}, ';')"""
_NEAR = """CASE WHEN len({a}) + len({b}) = 0 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE * len(list_intersect({a}, {b})) / (len({a}) + len({b})) END"""

ORACLE_SQL = f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, ''))::BIGINT AS n FROM documents
), e AS (
  SELECT *, lead(t) OVER (ORDER BY doc_id) AS nt, first_value(t) OVER (ORDER BY doc_id) AS ft FROM d
), f AS (
  SELECT doc_id, t, n, coalesce(nt, ft) AS nx, substr(t, 1, n - n // 4) || substr(coalesce(nt, ft), 1, n // 4) AS ed FROM e
), g AS (
  SELECT doc_id, n, ed, {_TREE.format(t="t")} AS l, {_TREE.format(t="ed")} AS el, {_TREE.format(t="nx")} AS nl FROM f
), h AS (
  SELECT doc_id, n, ed, {_PRINT.format(l="l")} AS p, {_PRINT.format(l="el")} AS ep,
         {_SET.format(l="l")} AS a, {_SET.format(l="el")} AS ea, {_SET.format(l="nl")} AS na FROM g
)
SELECT doc_id, n AS n_chars, sha256(ed) AS edited_sha256, p AS fingerprint, ep AS edited_fingerprint,
       {_NEAR.format(a="a", b="ea")} AS near_edited, {_NEAR.format(a="a", b="na")} AS near_next
FROM h
"""
