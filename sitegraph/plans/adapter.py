"""Company-shaped frames derived from the test tables, in Spark and, word for word, in SQL.

A document is a record of a company: its name is its text's first words, its place follows from
the name, so that copies of a text lie close together, up to 133 m apart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import LEGAL_FORM_TOKENS, NAME_NOISE_TOKENS

FORMS = ["GmbH", "AG", "GmbH & Co. KG", "e.K.", ""]
SOURCES = ["osm", "ied", "abwaerme", "mastr", "overture"]
STATES = ["Bremen", "Hamburg", "Berlin", "Hessen", "Bayern", "Sachsen"]
TYPES = ["office", "shop", "craft", "industrial"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: A text up to the end of its third word; the two other letters hold an ASCII one in lower case.
HEAD = r"^(?:[^A-Za-z0-9\u212A\u0130]*+[A-Za-z0-9\u212A\u0130]++){0,3}+"


def _pick(values: list[str], at) -> F.Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (at + 1).cast("int"))


def companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    words = F.slice(F.split(F.trim(F.regexp_replace(F.lower(F.regexp_extract("text", HEAD, 0)), "[^a-z0-9]+", " ")), " "), 1, 3)
    base = F.array_join(words, " ")
    d = d.select("doc_id", "source", base.alias("base")).withColumn("h", F.conv(F.substring(F.md5("base"), 1, 6), 16, 10).cast("long"))
    typo = F.when((F.col("doc_id") % 5 == 0) & (F.length("base") > 6), F.concat(F.substring("base", 1, 4), F.expr("substring(base, 6)"))).otherwise(F.col("base"))
    name = F.trim(F.concat(typo, F.lit(" "), _pick(FORMS, F.col("doc_id") % 5)))
    return d.select(
        F.concat(F.lit("doc_"), F.col("doc_id").cast("string")).alias("id"),
        "doc_id",
        "h",
        name.alias("name"),
        _pick(SOURCES, F.substring("source", 4, 9).cast("long") % 5).alias("source"),
        (F.lit(8.0) + (F.col("h") % 1000).cast("double") / F.lit(1000.0)).alias("longitude"),
        (F.lit(53.0) + (F.floor(F.col("h") / 1000) % 1000).cast("double") / F.lit(1000.0) + (F.col("doc_id") % 13).cast("double") * F.lit(0.0001)).alias("latitude"),
        (F.lit(10000) + F.col("h") % 900).cast("string").alias("postcode"),
        F.concat(F.lit("Stadt "), F.substring("base", 1, 3)).alias("city"),
        F.when(F.col("doc_id") % 4 != 0, F.concat(F.lit("Haupt-Str. "), (F.col("h") % 40 + 1).cast("string"))).alias("street"),
        _pick(STATES, F.col("h") % 6).alias("state"),
        F.concat(F.lit("Kreis "), (F.col("h") % 24).cast("string")).alias("district"),
        _pick(TYPES, F.col("doc_id") % 4).alias("business_type"),
        F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("https://www."), F.replace("base", F.lit(" "), F.lit("-")), F.lit(".de/"))).alias("website"),
        F.when(F.col("doc_id") % 7 < 3, F.concat(F.lit("+49"), F.col("h").cast("string"))).alias("phone"),
        F.when(F.col("doc_id") % 6 == 1, (F.col("h") % 5000 + 10).cast("double")).alias("area"),
    )


def _sql_pick(values: list[str], at: str) -> str:
    return f"([{', '.join(repr(v) for v in values)}])[({at})::INT + 1]"


COMPANIES_SQL = f"""
co0 AS (
  SELECT doc_id, source,
         array_to_string((string_split(trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g')), ' '))[1:3], ' ') AS base
  FROM documents
), co1 AS (
  SELECT *, ('0x' || substr(md5(base), 1, 6))::BIGINT AS h FROM co0
), co AS (
  SELECT 'doc_' || doc_id AS id, doc_id, h,
         trim((CASE WHEN doc_id % 5 = 0 AND length(base) > 6 THEN substr(base, 1, 4) || substr(base, 6) ELSE base END)
              || ' ' || {_sql_pick(FORMS, "doc_id % 5")}) AS name,
         {_sql_pick(SOURCES, "substr(source, 4)::BIGINT % 5")} AS source,
         8::DOUBLE + (h % 1000)::DOUBLE / 1000::DOUBLE AS longitude,
         53::DOUBLE + ((h // 1000) % 1000)::DOUBLE / 1000::DOUBLE + (doc_id % 13)::DOUBLE * 0.0001::DOUBLE AS latitude,
         (10000 + h % 900)::VARCHAR AS postcode,
         'Stadt ' || substr(base, 1, 3) AS city,
         CASE WHEN doc_id % 4 <> 0 THEN 'Haupt-Str. ' || (h % 40 + 1) END AS street,
         {_sql_pick(STATES, "h % 6")} AS state,
         'Kreis ' || (h % 24) AS district,
         {_sql_pick(TYPES, "doc_id % 4")} AS business_type,
         CASE WHEN doc_id % 3 = 0 THEN 'https://www.' || replace(base, ' ', '-') || '.de/' END AS website,
         CASE WHEN doc_id % 7 < 3 THEN '+49' || h END AS phone,
         CASE WHEN doc_id % 6 = 1 THEN (h % 5000 + 10)::DOUBLE END AS area
  FROM co1
)"""

_FORMS_SQL = ", ".join(f"'{t}'" for t in LEGAL_FORM_TOKENS)
_NOISE_SQL = ", ".join(f"'{t}'" for t in NAME_NOISE_TOKENS)


def name_key_sql(name: str, strip_noise: bool = True) -> str:
    """The name key as SQL, for names whose dotted abbreviations have two letters."""
    text = f"regexp_replace(replace(replace(replace(replace(lower({name}), 'ä', 'ae'), 'ö', 'oe'), 'ü', 'ue'), 'ß', 'ss'), '\\bco\\.?\\s*kg\\b', ' cokg ', 'g')"
    text = f"regexp_replace(regexp_replace({text}, '\\b([a-z])\\.\\s?([a-z])(\\b|\\.)', '\\1\\2 ', 'g'), '[^a-z0-9 ]+', ' ', 'g')"
    drop = _FORMS_SQL + (", " + _NOISE_SQL if strip_noise else "")
    return f"array_to_string(list_filter(string_split({text}, ' '), lambda t: t <> '' AND t NOT IN ({drop})), ' ')"


def common_sql(s: str, t: str) -> str:
    """Length of the longest common subsequence of two texts, as SQL: a fold over the letters of t
    whose state is the row of lengths for the prefixes of s."""
    zero = f"list_transform(range(0, length({s}) + 1), lambda x: 0::BIGINT)"
    letters = f"list_transform(string_split({t}, ''), lambda c: [ascii(c)::BIGINT])"
    places = f"list_transform(range(1, length({s}) + 1), lambda i: [i::BIGINT])"
    step = f"greatest(acc[len(acc)], r[i[1] + 1], CASE WHEN ascii(substr({s}, i[1], 1)) = c[1] THEN r[i[1]] + 1 ELSE 0 END)"
    inner = f"list_reduce(list_prepend([0::BIGINT], {places}), lambda acc, i: list_append(acc, {step}))"
    return f"list_max(list_reduce(list_prepend({zero}, {letters}), lambda r, c: {inner}))"
