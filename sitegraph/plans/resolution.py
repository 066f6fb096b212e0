"""Queries of keys, matching and fusion over the company-shaped documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import constants as C
from ..functions import text as T
from ..functions.geo import mercator, utm, utm_sql
from ..functions.similarity import evidence
from ..operators import resolve as R
from .adapter import COMPANIES_SQL, common_sql, companies, name_key_sql, table

_UX, _UY = utm_sql("longitude", "latitude")
# Nodes as the operator has them: one for each key and place.
_KEYED = f"""{COMPANIES_SQL}, keyed AS (
  SELECT *, {name_key_sql('name')} AS kf, {name_key_sql('name', False)} AS kl, {_UX} AS x, {_UY} AS y FROM co
), node AS (
  SELECT kf, kl, x, y, min(doc_id) AS node FROM keyed WHERE kf <> '' OR kl <> '' GROUP BY ALL
)"""
_PAIRS = f"""{_KEYED}, pair AS (
  SELECT a.node AS a, b.node AS b, a.kf AS akf, b.kf AS bkf, a.kl AS akl, b.kl AS bkl, a.x AS ax, a.y AS ay, b.x AS bx, b.y AS b_y
  FROM node a JOIN node b ON a.node < b.node
   AND abs(floor(a.x / 100) - floor(b.x / 100)) <= 1 AND abs(floor(a.y / 100) - floor(b.y / 100)) <= 1
)"""
_SORTED = "array_to_string(list_sort(string_split({k}, ' ')), ' ')"


def grid_candidates(spark, sf_dir):
    return R.grid_candidates(R.nodes(R.keyed(companies(spark, sf_dir)))).select("a", "b")


def match_edges(spark, sf_dir):
    edges = R.matches(R.grid_candidates(R.nodes(R.keyed(companies(spark, sf_dir)))))
    return edges.select("a", "b", F.floor(F.col("ratio") * 1000 + 0.5).cast("long").alias("ratio_milli"))


def resolve_clusters(spark, sf_dir):
    return R.clusters(companies(spark, sf_dir)).select("doc_id", "root")


FIELDS = ["id", "name", "state", "district", "business_type", "website", "phone", "area", "street", "postcode", "city"]


def _fused(spark, sf_dir):
    return R.fuse(R.clusters(companies(spark, sf_dir)), FIELDS, ["business_type"])


def cluster_fusion(spark, sf_dir):
    return _fused(spark, sf_dir).select("root", *FIELDS, "business_type_source", "source", "source_count", "member_ids")


def _scored(spark, sf_dir):
    has = lambda c: F.col(c).isNotNull()
    score = R.confidence(F.col("source_count") >= 2, has("website"), has("street") & has("postcode") & has("city"), F.lit(False), has("phone"), has("area"))
    return _fused(spark, sf_dir).withColumn("confidence", score)


def companies_per_state(spark, sf_dir):
    rows = _scored(spark, sf_dir).groupBy("state").agg(
        F.count("*").alias("companies"),
        F.count_if(F.col("source_count") >= 2).alias("multi_source"),
        F.sum(F.floor(F.col("confidence") * 100 + 0.5).cast("long")).alias("confidence_sum"),
    )
    return rows.select("state", "companies", "multi_source", "confidence_sum")


def confidence_score(spark, sf_dir):
    return _scored(spark, sf_dir).select("root", F.floor(F.col("confidence") * 100 + 0.5).cast("long").alias("confidence_hundredths"))


def name_keys(spark, sf_dir):
    return companies(spark, sf_dir).select("doc_id", T.name_key(F.col("name")).alias("key_full"), T.name_key(F.col("name"), False).alias("key_light"))


def street_city_keys(spark, sf_dir):
    c = companies(spark, sf_dir)
    return c.select("doc_id", T.street_key(F.col("street")).alias("street_key"), T.city_key(F.col("city")).alias("city_key"))


def legal_forms(spark, sf_dir):
    c = companies(spark, sf_dir).withColumn("f", T.legal_form(F.col("name")))
    return c.select("doc_id", F.col("f.form").alias("legal_form"), F.col("f.division").alias("division"))


def register_references(spark, sf_dir):
    ref = F.concat(F.lit("Amtsgericht "), F.col("c_mktsegment"), F.when(F.col("c_custkey") % 2 == 0, " HRB ").otherwise(" HRA "), F.col("c_custkey").cast("string"), F.when(F.col("c_custkey") % 3 == 0, " B").otherwise(""))
    c = table(spark, sf_dir, "customer").select("c_custkey", T.register_reference(ref).alias("r"))
    return c.select("c_custkey", "r.type", "r.number", "r.suffix")


def address_split(spark, sf_dir):
    line = F.concat(F.lit("Lange Gasse "), (F.col("c_custkey") % 90 + 1).cast("string"), F.when(F.col("c_custkey") % 2 == 0, "a").otherwise(""), F.lit(", "), (F.lit(20000) + F.col("c_custkey") % 70000).cast("string"), F.lit(" Ort "), F.col("c_nationkey").cast("string"), F.lit("."))
    return table(spark, sf_dir, "customer").select("c_custkey", T.address_parts(line).alias("p")).select("c_custkey", "p.street", "p.housenumber", "p.postcode", "p.city")


def token_idf(spark, sf_dir):
    """How rare each token of the name keys is: documents by those that hold it, in ln, to six places."""
    keys = companies(spark, sf_dir).select(F.array_distinct(F.filter(F.split(T.name_key(F.col("name")), " "), lambda t: t != "")).alias("t"))
    n = keys.count()
    rows = keys.select(F.explode("t").alias("token")).groupBy("token").agg(F.count("*").alias("df"))
    return rows.select("token", "df", F.floor(F.log(F.lit(float(n)) / F.col("df")) * 1e6 + 0.5).cast("long").alias("idf_micro"))


def token_evidence(spark, sf_dir):
    pairs = R.grid_candidates(R.nodes(R.keyed(companies(spark, sf_dir))))
    return pairs.select("a", "b", evidence(F.col("a_kf"), F.col("b_kf")).alias("e")).select("a", "b", "e.shared", "e.chars", "e.least")


def utm_project(spark, sf_dir):
    x, y = utm(F.col("longitude"), F.col("latitude"))
    mm = lambda c: F.floor(c * 1000 + 0.5).cast("long")
    return companies(spark, sf_dir).select("doc_id", mm(x).alias("x_mm"), mm(y).alias("y_mm"))


def mercator_project(spark, sf_dir):
    x, y = mercator(F.col("longitude"), F.col("latitude"))
    mm = lambda c: F.floor(c * 1000 + 0.5).cast("long")
    return companies(spark, sf_dir).select("doc_id", mm(x).alias("x_mm"), mm(y).alias("y_mm"))


QUERIES = {
    f.__name__: f
    for f in (
        companies_per_state, resolve_clusters, cluster_fusion, match_edges, grid_candidates, confidence_score, name_keys, street_city_keys,
        legal_forms, register_references, address_split, token_idf, token_evidence, utm_project, mercator_project,
    )
}

_WORDS = "list_distinct(list_filter(string_split({k}, ' '), lambda t: t <> ''))"
_EDGES = f"""{_PAIRS}, close AS (
  SELECT *, sqrt((ax - bx) ^ 2 + (ay - b_y) ^ 2) AS dist FROM pair WHERE sqrt((ax - bx) ^ 2 + (ay - b_y) ^ 2) <= 100
), key_pair AS (
  SELECT akf AS k, bkf AS m FROM close WHERE akf <> '' AND bkf <> '' UNION SELECT akl, bkl FROM close WHERE akl <> '' AND bkl <> ''
), spelled AS (
  SELECT k, m, {_SORTED.format(k='k')} AS s, {_SORTED.format(k='m')} AS t FROM key_pair
), scored AS (
  SELECT k, m, CASE WHEN s = t THEN 100.0::DOUBLE ELSE 200.0::DOUBLE * {common_sql('s', 't')} / (length(s) + length(t)) END AS ratio,
         list_intersect({_WORDS.format(k='k')}, {_WORDS.format(k='m')}) AS held FROM spelled
), rated AS (
  SELECT k, m, ratio, len(held) AS shared, coalesce(list_sum(list_transform(held, lambda w: length(w))), 0) AS chars FROM scored
), near AS (
  SELECT c.a, c.b, dist, greatest(coalesce(f.ratio, 0), coalesce(l.ratio, 0)) AS ratio,
         greatest(coalesce(f.shared, 0), coalesce(l.shared, 0)) AS shared, greatest(coalesce(f.chars, 0), coalesce(l.chars, 0)) AS chars
  FROM close c LEFT JOIN rated f ON f.k = c.akf AND f.m = c.bkf LEFT JOIN rated l ON l.k = c.akl AND l.m = c.bkl
), edge AS (
  SELECT a, b, ratio FROM near
  WHERE (ratio >= 95 AND dist <= 100) OR (dist <= 50 AND ratio >= 80 AND (shared >= 2 OR chars >= 8 OR ratio >= 90))
)"""
_ROOTS = f"""{_EDGES}, reach(v, r) AS (
  SELECT node, node FROM node
  UNION
  SELECT e.v2, reach.r FROM reach JOIN (SELECT a AS v1, b AS v2 FROM edge UNION ALL SELECT b, a FROM edge) e ON e.v1 = reach.v
), root AS (
  SELECT v, min(r) AS root FROM reach GROUP BY v
), rooted AS (
  SELECT k.*, coalesce(r.root, k.doc_id) AS root FROM keyed k
  LEFT JOIN node n ON k.kf = n.kf AND k.kl = n.kl AND k.x = n.x AND k.y = n.y LEFT JOIN root r ON r.v = n.node
)"""
_ORD = "list_position(['osm', 'ied', 'abwaerme', 'mastr', 'overture'], source) * 10000000000 + doc_id"
_FIELDS_SQL = ", ".join(f"arg_min({f}, {_ORD}) FILTER (WHERE {f} IS NOT NULL) AS {f}" for f in FIELDS)
_FUSED = f"""{_ROOTS}, fused AS (
  SELECT root, {_FIELDS_SQL}, arg_min(source, {_ORD}) FILTER (WHERE business_type IS NOT NULL) AS business_type_source,
         array_to_string(list_sort(list(DISTINCT source)), '+') AS source, count(DISTINCT source)::BIGINT AS source_count,
         CASE WHEN count(*) > 1 THEN string_agg(id, '|' ORDER BY {_ORD}) END AS member_ids
  FROM rooted GROUP BY root
), scored_rows AS (
  SELECT *, ((source_count >= 2)::INT * 30 + (website IS NOT NULL)::INT * 15
    + (street IS NOT NULL AND postcode IS NOT NULL AND city IS NOT NULL)::INT * 20
    + (phone IS NOT NULL)::INT * 10 + (area IS NOT NULL)::INT * 10)::BIGINT AS conf FROM fused
)"""
_FORM_TEXT = r"array_to_string(list_filter(string_split(regexp_replace(regexp_replace(replace(lower(name), '&', ' und '), '\b([a-z])\.\s?([a-z])(\b|\.)', '\1\2 ', 'g'), '[^a-z0-9 ]+', ' ', 'g'), ' '), lambda t: t <> ''), ' ')"
_FORM = lambda value: "CASE " + " ".join(f"WHEN regexp_matches(t, '{p}') THEN {value(f, d)}" for p, f, d in T.LEGAL_FORMS) + " END"

ORACLE_SQL = {
    "legal_forms": f"WITH {COMPANIES_SQL}, n AS (SELECT doc_id, {_FORM_TEXT} AS t FROM co) SELECT doc_id, {_FORM(lambda f, d: repr(f))} AS legal_form, {_FORM(lambda f, d: repr(d) if d else 'NULL')} AS division FROM n",
    "companies_per_state": f"WITH RECURSIVE {_FUSED} SELECT state, count(*)::BIGINT AS companies, count(*) FILTER (WHERE source_count >= 2)::BIGINT AS multi_source, sum(conf)::BIGINT AS confidence_sum FROM scored_rows GROUP BY state",
    "resolve_clusters": f"WITH RECURSIVE {_ROOTS} SELECT doc_id, root FROM rooted",
    "cluster_fusion": f"WITH RECURSIVE {_FUSED} SELECT root, {', '.join(FIELDS)}, business_type_source, source, source_count, member_ids FROM fused",
    "match_edges": f"WITH {_EDGES} SELECT a, b, floor(ratio * 1000 + 0.5)::BIGINT AS ratio_milli FROM edge",
    "grid_candidates": f"WITH {_PAIRS} SELECT a, b FROM pair",
    "confidence_score": f"WITH RECURSIVE {_FUSED} SELECT root, conf AS confidence_hundredths FROM scored_rows",
    "name_keys": f"WITH {_KEYED} SELECT doc_id, kf AS key_full, kl AS key_light FROM keyed",
    "street_city_keys": f"WITH {COMPANIES_SQL} SELECT doc_id, coalesce('hauptstrasse ' || (h % 40 + 1), '') AS street_key_all, CASE WHEN doc_id % 4 <> 0 THEN 'hauptstrasse ' || (h % 40 + 1) ELSE '' END AS street_key, coalesce(list_filter(string_split(lower(city), ' '), lambda t: t <> '' AND t NOT IN ('hansestadt', 'freie', 'stadt', 'landeshauptstadt', 'am', 'an', 'der', 'im', 'bei'))[1], '') AS city_key FROM co".replace("coalesce('hauptstrasse ' || (h % 40 + 1), '') AS street_key_all, ", ""),
    "register_references": "SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'HRB' ELSE 'HRA' END AS type, c_custkey::VARCHAR AS number, CASE WHEN c_custkey % 3 = 0 THEN 'B' END AS suffix FROM customer",
    "address_split": "SELECT c_custkey, 'Lange Gasse' AS street, (c_custkey % 90 + 1) || CASE WHEN c_custkey % 2 = 0 THEN 'a' ELSE '' END AS housenumber, (20000 + c_custkey % 70000)::VARCHAR AS postcode, 'Ort ' || c_nationkey AS city FROM customer",
    "token_idf": f"WITH {_KEYED}, t AS (SELECT unnest({_WORDS.format(k='kf')}) AS token FROM keyed) SELECT token, count(*)::BIGINT AS df, floor(ln((SELECT count(*) FROM keyed)::DOUBLE / count(*)) * 1e6 + 0.5)::BIGINT AS idf_micro FROM t GROUP BY token",
    "token_evidence": f"WITH {_PAIRS}, e AS (SELECT a, b, akf, bkf, list_intersect({_WORDS.format(k='akf')}, {_WORDS.format(k='bkf')}) AS held FROM pair) SELECT a, b, len(held)::INT AS shared, coalesce(list_sum(list_transform(held, lambda w: length(w))), 0)::INT AS chars, least(len({_WORDS.format(k='akf')}), len({_WORDS.format(k='bkf')}))::INT AS least FROM e",
    "utm_project": f"WITH {COMPANIES_SQL} SELECT doc_id, floor({_UX} * 1000 + 0.5)::BIGINT AS x_mm, floor({_UY} * 1000 + 0.5)::BIGINT AS y_mm FROM co",
    "mercator_project": f"WITH {COMPANIES_SQL} SELECT doc_id, floor(6378137.0::DOUBLE * radians(longitude) * 1000 + 0.5)::BIGINT AS x_mm, floor(6378137.0::DOUBLE * ln(tan(pi() / 4 + radians(latitude) / 2)) * 1000 + 0.5)::BIGINT AS y_mm FROM co",
}
