"""Queries of filters, joins, aggregates, ranking and serving, over the test tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import text as T
from ..functions import url as U
from ..functions.geo import ring_area
from ..operators import geometry, serve
from .adapter import COMPANIES_SQL, companies, name_key_sql, table


def _flat(spark, sf_dir):
    """Companies as one source each, with the columns that selections ask for."""
    return companies(spark, sf_dir).withColumns({"source_count": F.lit(1).cast("long"), "is_industrial": F.col("source").isin(C.INDUSTRIAL_SOURCES)})


def url_normalize(spark, sf_dir):
    raw = F.concat(F.col("url"), F.when(F.col("page_id") % 3 == 0, "#top").when(F.col("page_id") % 3 == 1, " ").otherwise(", http://b.de"))
    return table(spark, sf_dir, "pages").select("page_id", U.normalize_url(raw).alias("normalized"))


def url_host(spark, sf_dir):
    h = U.plain_host(F.col("url"))
    return table(spark, sf_dir, "pages").select("page_id", h.alias("host"), U.registered(h).alias("registered"))


def website_propagate(spark, sf_dir):
    """Rows without a site take that of the first row with their name key and postcode."""
    c = companies(spark, sf_dir).withColumn("key", T.name_key(F.col("name")))
    donors = c.where("website IS NOT NULL AND key <> ''").groupBy(F.col("key").alias("d_key"), F.col("postcode").alias("d_postcode")).agg(F.min_by("website", "doc_id").alias("donor"))
    out = c.join(donors, (F.col("key") == F.col("d_key")) & (F.col("postcode") == F.col("d_postcode")), "left")
    kind = F.when(F.col("website").isNotNull(), "extract").when(F.col("donor").isNotNull(), "propagated")
    return out.select("doc_id", F.coalesce("website", "donor").alias("website"), kind.alias("website_source"))


def site_aggregate(spark, sf_dir):
    """Sums, a weighted mean and the first distinct names of each site; a supplier's lines are its units."""
    li = table(spark, sf_dir, "lineitem")
    weight = F.floor(F.col("l_quantity") + 0.5).cast("long")
    degree = F.floor(F.col("l_discount") * 100 + 0.5).cast("long")
    g = li.groupBy("l_suppkey").agg(
        F.sum(weight).alias("heat"), F.sum(weight * degree).alias("moment"), F.count("*").alias("units"),
        F.slice(F.array_sort(F.collect_set("l_returnflag")), 1, 5).alias("names"),
    )
    return g.select("l_suppkey", "heat", "units", F.floor(F.col("moment") * 1000 / F.col("heat") + 0.5).cast("long").alias("mean_milli"), F.array_join("names", ", ").alias("names"))


def unit_detail(spark, sf_dir):
    """Each order's units by kind, ordered by number, as one text."""
    li = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_returnflag").agg(F.array_join(F.transform(F.array_sort(F.collect_list("l_linenumber")), lambda x: x.cast("string")), ",").alias("units"))
    g = li.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.concat_ws(":", "l_returnflag", "units"))).alias("d"))
    return g.select("l_orderkey", F.array_join("d", ";").alias("detail"))


def latest_version(spark, sf_dir):
    """The latest row of each user: by time, then by number, the last one wins."""
    w = Window.partitionBy("user_id").orderBy(F.desc("ts"), F.desc("event_id"))
    return table(spark, sf_dir, "events").withColumn("rn", F.row_number().over(w)).where("rn = 1").select("user_id", "event_id", "event_type")


def keep_first_id(spark, sf_dir):
    """Of rows with one id from overlapping extracts the first stays."""
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus")
    return o.groupBy("o_custkey").agg(F.min("o_orderkey").alias("o_orderkey"), F.min_by("o_orderstatus", "o_orderkey").alias("o_orderstatus"))


def cache_upsert(spark, sf_dir):
    """Old and new cache rows, the last one of each key stays."""
    e = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type")
    old, new = e.where("event_type <> 'click'"), e.where("event_type = 'click'").withColumn("event_id", F.col("event_id") + 1_000_000_000)
    return old.unionByName(new).groupBy("user_id").agg(F.max_by("event_type", "event_id").alias("event_type"), F.max("event_id").alias("event_id"))


def _register(spark, sf_dir):
    c = companies(spark, sf_dir)
    names = c.select("doc_id", "postcode", T.name_key(F.col("name")).alias("rkf"), T.name_key(F.col("name"), False).alias("rkl"))
    names = names.where("rkf <> '' OR rkl <> ''").groupBy("postcode", "rkf", "rkl").agg(F.concat(F.lit("hr_"), F.min("doc_id").cast("string")).alias("hr_id"))
    left = c.where("source <> 'overture'").select("id", "postcode", T.name_key(F.col("name")).alias("kf"), T.name_key(F.col("name"), False).alias("kl"))
    return left, names


def register_only(spark, sf_dir):
    """Register entries that no company of the map has: an anti join on the key."""
    left, names = _register(spark, sf_dir)
    return names.join(left.select(F.col("kf").alias("rkf"), "postcode"), ["rkf", "postcode"], "left_anti").select("hr_id", "rkf", "postcode")


def address_geocode(spark, sf_dir):
    """Places by exact address, else by the street's centre in its postcode; whole numbers keep the means exact."""
    c = companies(spark, sf_dir).withColumns({"skey": T.street_key(F.col("street")), "m": F.floor(F.col("latitude") * 10000 + 0.5).cast("long")})
    c = c.withColumn("road", F.regexp_replace("skey", " [0-9]+[a-z]?$", ""))
    index = c.where("skey <> '' AND source = 'osm'")
    exact = index.groupBy("postcode", "skey").agg(F.sum("m").alias("s"), F.count("*").alias("n"))
    area = index.groupBy(F.col("postcode").alias("a_postcode"), F.col("road").alias("a_road")).agg(F.sum("m").alias("as"), F.count("*").alias("an"))
    out = c.where("source <> 'osm'").join(exact, ["postcode", "skey"], "left").join(area, (F.col("postcode") == F.col("a_postcode")) & (F.col("road") == F.col("a_road")), "left")
    mean = lambda s, n: F.floor(F.col(s) / F.col(n) + 0.5).cast("long")
    return out.select("doc_id", F.coalesce(mean("s", "n"), mean("as", "an")).alias("lat_e4"), F.when(F.col("n") > 0, "exact").when(F.col("an") > 0, "street").otherwise("none").alias("method"))


def postcode_district(spark, sf_dir):
    """The most common district of each postcode, the lesser one on a tie."""
    g = companies(spark, sf_dir).groupBy("postcode", "district").agg(F.count("*").alias("n"))
    best = F.min(F.struct((-F.col("n")).alias("neg"), "district"))
    return g.groupBy("postcode").agg(best.alias("b")).select("postcode", F.col("b.district").alias("district"))


def objective_industrial(spark, sf_dir):
    purpose = F.concat(F.lit("Herstellung von Möbeln "), F.col("business_type"), F.when(F.col("doc_id") % 3 == 0, " und Vermietung").otherwise(""))
    words = F.when(F.col("doc_id") % 2 == 0, purpose).otherwise(F.concat(F.lit("Handel "), F.col("name")))
    return companies(spark, sf_dir).select("doc_id", T.objective_industrial(words).alias("industrial"))


def industrial_flag(spark, sf_dir):
    """Rows that their source or their tags make industrial; the tags are a JSON text."""
    tags = F.to_json(F.create_map(F.lit("man_made"), F.when(F.col("doc_id") % 5 == 0, "works").when(F.col("doc_id") % 5 == 1, "silo").otherwise("mast")))
    c = companies(spark, sf_dir).withColumn("tags", F.from_json(tags, "map<string,string>"))
    holds = lambda sets: F.exists(F.array(*[F.coalesce(F.try_element_at("tags", F.lit(k)).isin(v), F.lit(False)) for k, v in sets.items()]), lambda x: x)
    named = F.trim(F.coalesce("name", F.lit(""))) != ""
    by_source = F.arrays_overlap(F.split("source", r"\+"), F.array(*[F.lit(s) for s in C.INDUSTRIAL_SOURCES]))
    return c.select("doc_id", (by_source | holds(C.INDUSTRIAL_TAGS) | (named & holds(C.INDUSTRIAL_TAGS_NAMED))).alias("is_industrial"))


def validate_contract(spark, sf_dir):
    """All violations of the contract in one aggregate."""
    c = companies(spark, sf_dir)
    outside = lambda v, b: (F.col(v) < b[0]) | (F.col(v) > b[1])
    return c.agg(
        F.count_if(F.col("id").isNull()).alias("null_ids"),
        (F.count("id") - F.count_distinct("id")).alias("duplicate_ids"),
        F.count_if(F.col("source").isNull()).alias("null_sources"),
        F.count_if(outside("latitude", C.LAT_BOUNDS) | outside("longitude", C.LON_BOUNDS)).alias("outside"),
        F.count_if((F.col("area") <= 0) | (F.col("area") * 20_000 > C.AREA_MAX_M2)).alias("odd_areas"),
    )


def display_filter(spark, sf_dir):
    pick = serve.Selection(datasets=[serve.Dataset("osm", groups=["shop", "office"]), serve.Dataset("ied"), serve.Dataset("mastr", only=False), serve.Dataset("overture", groups=[])])
    return _flat(spark, sf_dir).where(pick.where()).select("id", "source", "business_type")


def selection_filters(spark, sf_dir):
    pick = serve.Selection(state="Bremen", industrial=True, bbox=(8.1, 53.0, 8.9, 53.9), q="e")
    return _flat(spark, sf_dir).where(pick.where()).select("id", "name", "state")


def name_search(spark, sf_dir):
    return serve.search(_flat(spark, sf_dir), " th", 25).select("id", "name")


def serving_page(spark, sf_dir):
    return serve.page(_flat(spark, sf_dir), 20, 50).select("id", "state", "district")


def extract_cube(spark, sf_dir):
    return serve.extract_cube(_flat(spark, sf_dir), "de").groupBy("area", "sector").agg(F.count("*").alias("n"))


def nest_counts(spark, sf_dir):
    """Companies by name key with their members nested by source; the members of each source counted."""
    c = companies(spark, sf_dir).withColumn("key", T.name_key(F.col("name")))
    clusters = c.groupBy("key").agg(F.min("id").alias("id"), F.array_join(F.array_sort(F.collect_list("id")), "|").alias("member_ids"))
    out = serve.nest_members(clusters, c.select("id", "source", "name"), ["name"])
    n = lambda s: F.size(F.coalesce(F.try_element_at("nested", F.lit(s)), F.array())).cast("long")
    return out.select("id", n("osm").alias("osm"), n("ied").alias("ied"), n("mastr").alias("mastr"))


def raw_fields(spark, sf_dir):
    """Each customer's cells as a map without blanks, printed in the order of the names."""
    c = table(spark, sf_dir, "customer")
    names = ["c_name", "c_mktsegment", "c_nationkey"]
    cells = F.map_filter(F.map_from_arrays(F.array(*[F.lit(n) for n in names]), F.array(*[T.cell_text(F.col(n)) for n in names])), lambda k, v: v.isNotNull())
    return c.select("c_custkey", F.array_join(F.transform(F.array_sort(F.map_entries(cells)), lambda e: F.concat_ws("=", e["key"], e["value"])), ";").alias("fields"))


def summary_counts(spark, sf_dir):
    c = _flat(spark, sf_dir)
    parts = [c.groupBy(F.lit(k).alias("kind"), F.col(k).cast("string").alias("value")).agg(F.count("*").alias("n")) for k in ("state", "business_type", "source", "is_industrial")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


def field_coverage(spark, sf_dir):
    fields = ["website", "phone", "area", "street"]
    row = companies(spark, sf_dir).agg(F.count("*").alias("all"), *[F.count(f).alias(f) for f in fields])
    return row.select(F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("n"), F.floor(F.col(f) * 10000 / F.col("all") + 0.5).cast("long").alias("share_e4")) for f in fields])).alias("r")).select("r.*")


def area_distribution(spark, sf_dir):
    q = F.percentile("area", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    milli = lambda c: F.floor(c * 1000 + 0.5).cast("long")
    a = companies(spark, sf_dir).agg(F.count("area").alias("n"), F.min("area").alias("least"), F.max("area").alias("most"), q.alias("q"))
    return a.select("n", milli(F.col("least")).alias("least"), *[milli(F.col("q")[i]).alias(f"p{p}") for i, p in enumerate((25, 50, 75))], milli(F.col("most")).alias("most"))


def state_boxes(spark, sf_dir):
    return serve.extents(companies(spark, sf_dir), "state")


def toggle_counts(spark, sf_dir):
    c = companies(spark, sf_dir).withColumn("key", T.name_key(F.col("name")))
    per = c.groupBy("key").agg(F.collect_set("source").alias("sources"))
    return per.select(F.explode("sources").alias("source"), F.size("sources").alias("k")).groupBy("source").agg(F.count("*").alias("n"), F.count_if(F.col("k") > 1).alias("matched"), F.count_if(F.col("k") == 1).alias("only"))


_BOXES = [("west", 8.0, 53.0, 8.5, 54.1), ("east", 8.5, 53.0, 9.1, 54.1), ("core", 8.25, 53.25, 8.75, 53.75)]


def smallest_zone(spark, sf_dir):
    """The smallest zone that holds each company."""
    boxes = spark.createDataFrame([(n, [(w, s), (e, s), (e, t), (w, t)]) for n, w, s, e, t in _BOXES], "zone string, ring array<struct<x:double,y:double>>")
    boxes = boxes.withColumn("size", ring_area(F.col("ring")))
    points = companies(spark, sf_dir).select(F.col("doc_id").alias("id"), (F.col("longitude") + 0.0003).alias("x"), (F.col("latitude") + 0.0003).alias("y"))
    return geometry.points_in_polygons(points, boxes, "size", 0.25).select("id", "zone")


def host_features(spark, sf_dir):
    """What each host of the pages shows over users: counts, distinct values, the best rank."""
    p = table(spark, sf_dir, "pages").select(U.registered(U.plain_host(F.col("url"))).alias("host"), "page_id", (F.col("page_id") % 5).alias("engine"))
    return p.groupBy("host").agg(F.count("*").alias("hits"), F.count_distinct("engine").alias("engines"), F.min("page_id").alias("best_rank"), F.max(F.col("engine") == 0).alias("first_engine"))


def domain_candidates(spark, sf_dir):
    """Each company with the hosts whose label begins with its whole name key in one word or with the key's
    first token, of three letters at least: an equi-join on three letters, then the prefix test."""
    hosts = table(spark, sf_dir, "pages").select(U.registered(U.plain_host(F.col("url"))).alias("host")).distinct().withColumn("label", F.substring_index("host", ".", 1))
    hosts = hosts.withColumn("block", F.substring("label", 1, 3))
    c = companies(spark, sf_dir).withColumn("key", T.name_key(F.col("name")))
    # The whole key begins with the first token, so it decides only where that token is too short.
    first, whole = F.substring_index("key", " ", 1), F.replace("key", F.lit(" "), F.lit(""))
    start = F.when(F.length(first) >= 3, first).otherwise(whole)
    names = c.select("doc_id", start.alias("start")).where("length(start) >= 3").withColumn("block", F.substring("start", 1, 3))
    # Equal starts meet the hosts once.
    met = names.select("block", "start").distinct().join(hosts, "block").where(F.startswith("label", "start")).select("start", "host")
    return names.join(met, "start").select("doc_id", "host")


def quality_checks(spark, sf_dir):
    o = table(spark, sf_dir, "lineitem")
    return o.groupBy("l_returnflag").agg(
        F.count("*").alias("n"),
        F.count_if(~F.col("l_linestatus").rlike("^[OP]$")).alias("bad_status"),
        F.count_if(~F.col("l_quantity").between(1, 40)).alias("out_of_range"),
        F.count_distinct("l_suppkey").alias("suppliers"),
        F.floor(F.percentile("l_quantity", F.lit(0.99)) * 1000 + 0.5).cast("long").alias("p99_milli"),
    )


def pair_agreement(spark, sf_dir):
    """Pairs that two ways of grouping agree on: by name key and postcode, and by name key and state."""
    c = companies(spark, sf_dir).select("doc_id", T.name_key(F.col("name")).alias("key"), "postcode", "state").where("key <> ''")
    pairs = lambda *by: F.sum(F.col("n") * (F.col("n") - 1) / 2).cast("long")
    count = lambda name, *by: c.groupBy(*by).agg(F.count("*").alias("n")).agg(F.coalesce(pairs(), F.lit(0)).alias(name))
    return count("first", "key", "postcode").crossJoin(count("second", "key", "state")).crossJoin(count("both", "key", "postcode", "state"))


QUERIES = {
    f.__name__: f
    for f in (
        url_normalize, url_host, website_propagate, site_aggregate, unit_detail, latest_version, keep_first_id, cache_upsert,
        register_only, address_geocode, postcode_district, objective_industrial, industrial_flag,
        validate_contract, display_filter, selection_filters, name_search, serving_page, extract_cube, nest_counts, raw_fields, summary_counts,
        field_coverage, area_distribution, state_boxes, toggle_counts, smallest_zone, host_features, domain_candidates, quality_checks, pair_agreement,
    )
}

_HOST = "regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]*)', 1)), '^www\\.', '')"
_REG = f"array_to_string((string_split({_HOST}, '.'))[-2:], '.')"
_CO = f"WITH {COMPANIES_SQL}, f AS (SELECT *, 1::BIGINT AS source_count, source IN ('ied', 'abwaerme', 'mastr') AS is_industrial FROM co)"
_KEYS = f"WITH {COMPANIES_SQL}, k AS (SELECT *, {name_key_sql('name')} AS key FROM co)"
_E6 = "floor(quantile_cont({0}, {1}) * 1e6 + 0.5)::BIGINT"

ORACLE_SQL = {
    "url_host": f"SELECT page_id, {_HOST} AS host, {_REG} AS registered FROM pages",
    "url_normalize": "WITH p AS (SELECT page_id, regexp_extract(url, '^([A-Za-z]+)://([^/?#]*)([^?#]*)[?]?([^#]*)', ['scheme', 'host', 'path', 'query']) AS u FROM pages), q AS (SELECT page_id, u, array_to_string(list_filter(string_split(u.query, '&'), lambda x: x <> '' AND NOT regexp_matches(lower(x), '^(utm_|fbclid|gclid|mc_cid|mc_eid|ref)')), '&') AS kept FROM p) SELECT page_id, lower(u.scheme) || '://' || lower(u.host) || rtrim(u.path, '/') || CASE WHEN kept <> '' THEN '?' || kept ELSE '' END AS normalized FROM q",
    "website_propagate": f"{_KEYS}, d AS (SELECT key, postcode, arg_min(website, doc_id) AS donor FROM k WHERE website IS NOT NULL AND key <> '' GROUP BY ALL) SELECT doc_id, coalesce(website, donor) AS website, CASE WHEN website IS NOT NULL THEN 'extract' WHEN donor IS NOT NULL THEN 'propagated' END AS website_source FROM k LEFT JOIN d USING (key, postcode)",
    "site_aggregate": "WITH g AS (SELECT l_suppkey, sum(floor(l_quantity + 0.5)::BIGINT)::BIGINT AS heat, sum(floor(l_quantity + 0.5)::BIGINT * floor(l_discount * 100 + 0.5)::BIGINT)::BIGINT AS moment, count(*)::BIGINT AS units, list_sort(list(DISTINCT l_returnflag))[1:5] AS names FROM lineitem GROUP BY 1) SELECT l_suppkey, heat, units, floor(moment::DOUBLE * 1000 / heat + 0.5)::BIGINT AS mean_milli, array_to_string(names, ', ') AS names FROM g",
    "unit_detail": "WITH u AS (SELECT l_orderkey, l_returnflag, string_agg(l_linenumber::VARCHAR, ',' ORDER BY l_linenumber) AS units FROM lineitem GROUP BY 1, 2) SELECT l_orderkey, string_agg(l_returnflag || ':' || units, ';' ORDER BY l_returnflag || ':' || units) AS detail FROM u GROUP BY 1",
    "latest_version": "SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1",
    "keep_first_id": "SELECT o_custkey, min(o_orderkey) AS o_orderkey, arg_min(o_orderstatus, o_orderkey) AS o_orderstatus FROM orders GROUP BY 1",
    "cache_upsert": "WITH e AS (SELECT user_id, event_type, event_id + CASE WHEN event_type = 'click' THEN 1000000000 ELSE 0 END AS event_id FROM events) SELECT user_id, arg_max(event_type, event_id) AS event_type, max(event_id)::BIGINT AS event_id FROM e GROUP BY 1",
    "register_only": f"{_KEYS}, n AS (SELECT postcode, key, {name_key_sql('name', False)} AS kl, min(doc_id) AS m FROM k WHERE key <> '' OR {name_key_sql('name', False)} <> '' GROUP BY ALL) SELECT 'hr_' || m AS hr_id, key AS rkf, postcode FROM n WHERE (key, postcode) NOT IN (SELECT key, postcode FROM k WHERE source <> 'overture')",
    "address_geocode": f"WITH {COMPANIES_SQL}, c AS (SELECT *, CASE WHEN street IS NULL THEN '' ELSE 'hauptstrasse ' || (h % 40 + 1) END AS skey, CASE WHEN street IS NULL THEN '' ELSE 'hauptstrasse' END AS road, floor(latitude * 10000 + 0.5)::BIGINT AS m FROM co), i AS (SELECT * FROM c WHERE skey <> '' AND source = 'osm'), x AS (SELECT postcode, skey, sum(m)::DOUBLE AS s, count(*) AS n FROM i GROUP BY ALL), a AS (SELECT postcode, road, sum(m)::DOUBLE AS s, count(*) AS n FROM i GROUP BY ALL) SELECT doc_id, coalesce(floor(x.s / x.n + 0.5)::BIGINT, floor(a.s / a.n + 0.5)::BIGINT) AS lat_e4, CASE WHEN x.n > 0 THEN 'exact' WHEN a.n > 0 THEN 'street' ELSE 'none' END AS method FROM c LEFT JOIN x ON c.postcode = x.postcode AND c.skey = x.skey LEFT JOIN a ON c.postcode = a.postcode AND c.road = a.road WHERE source <> 'osm'",
    "postcode_district": f"WITH {COMPANIES_SQL}, g AS (SELECT postcode, district, count(*) AS n FROM co GROUP BY ALL) SELECT postcode, district FROM g QUALIFY row_number() OVER (PARTITION BY postcode ORDER BY n DESC, district) = 1",
    "objective_industrial": f"WITH {COMPANIES_SQL}, w AS (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'herstellung von moebeln ' || business_type || CASE WHEN doc_id % 3 = 0 THEN ' und vermietung' ELSE '' END ELSE 'handel ' || lower(name) END AS t FROM co) SELECT doc_id, list_bool_or(list_transform([{', '.join(map(repr, C.OBJECTIVE_KEYWORDS))}], lambda k: contains(t, k))) AND NOT list_bool_or(list_transform([{', '.join(map(repr, C.OBJECTIVE_EXCLUDE))}], lambda k: contains(t, k))) AS industrial FROM w",
    "validate_contract": f"WITH {COMPANIES_SQL} SELECT count(*) FILTER (WHERE id IS NULL)::BIGINT AS null_ids, (count(id) - count(DISTINCT id))::BIGINT AS duplicate_ids, count(*) FILTER (WHERE source IS NULL)::BIGINT AS null_sources, count(*) FILTER (WHERE latitude < 45 OR latitude > 56 OR longitude < 4 OR longitude > 17)::BIGINT AS outside, count(*) FILTER (WHERE area <= 0 OR area * 20000 > 50000000)::BIGINT AS odd_areas FROM co",
    "industrial_flag": f"WITH {COMPANIES_SQL} SELECT doc_id, (source IN ('ied', 'abwaerme', 'mastr') OR doc_id % 5 = 0 OR (doc_id % 5 = 1 AND trim(name) <> '')) AS is_industrial FROM co",
    "display_filter": f"{_CO} SELECT id, source, business_type FROM f WHERE (source = 'osm' AND business_type IN ('shop', 'office')) OR source = 'ied' OR (source = 'mastr' AND source_count >= 2)",
    "selection_filters": f"{_CO} SELECT id, name, state FROM f WHERE state = 'Bremen' AND is_industrial AND longitude BETWEEN 8.1::DOUBLE AND 8.9::DOUBLE AND latitude BETWEEN 53.0::DOUBLE AND 53.9::DOUBLE AND contains(lower(name), 'e')",
    "name_search": f"{_CO} SELECT id, name FROM f WHERE contains(lower(name), 'th') ORDER BY starts_with(lower(name), 'th') DESC, length(name), id LIMIT 25",
    "serving_page": f"{_CO} SELECT id, state, district FROM f ORDER BY state NULLS LAST, district NULLS LAST, id LIMIT 50 OFFSET 20",
    "extract_cube": f"{_CO}, a AS (SELECT unnest([state, 'de']) AS area, business_type, is_industrial FROM f), s AS (SELECT area, unnest(list_filter([business_type, CASE WHEN is_industrial THEN 'is_industrial' END, 'all'], lambda x: x IS NOT NULL)) AS sector FROM a) SELECT area, sector, count(*)::BIGINT AS n FROM s GROUP BY ALL",
    "nest_counts": f"{_KEYS} SELECT min(id) AS id, count(*) FILTER (WHERE source = 'osm')::BIGINT AS osm, count(*) FILTER (WHERE source = 'ied')::BIGINT AS ied, count(*) FILTER (WHERE source = 'mastr')::BIGINT AS mastr FROM k GROUP BY key",
    "raw_fields": "SELECT c_custkey, concat_ws(';', 'c_mktsegment=' || c_mktsegment, 'c_name=' || c_name, 'c_nationkey=' || c_nationkey) AS fields FROM customer",
    "summary_counts": f"{_CO} SELECT 'state' AS kind, state AS value, count(*)::BIGINT AS n FROM f GROUP BY 2 UNION ALL SELECT 'business_type', business_type, count(*) FROM f GROUP BY 2 UNION ALL SELECT 'source', source, count(*) FROM f GROUP BY 2 UNION ALL SELECT 'is_industrial', is_industrial::VARCHAR, count(*) FROM f GROUP BY 2",
    "field_coverage": f"{_CO}, n AS (SELECT unnest([{{'field': 'website', 'n': count(website)}}, {{'field': 'phone', 'n': count(phone)}}, {{'field': 'area', 'n': count(area)}}, {{'field': 'street', 'n': count(street)}}]) AS r, count(*) AS total FROM f) SELECT r.field AS field, r.n::BIGINT AS n, floor(r.n::DOUBLE * 10000 / total + 0.5)::BIGINT AS share_e4 FROM n",
    "area_distribution": f"{_CO} SELECT count(area)::BIGINT AS n, floor(min(area) * 1000 + 0.5)::BIGINT AS least, floor(quantile_cont(area, 0.25) * 1000 + 0.5)::BIGINT AS p25, floor(quantile_cont(area, 0.5) * 1000 + 0.5)::BIGINT AS p50, floor(quantile_cont(area, 0.75) * 1000 + 0.5)::BIGINT AS p75, floor(max(area) * 1000 + 0.5)::BIGINT AS most FROM f",
    "state_boxes": f"{_CO} SELECT state, count(*)::BIGINT AS n, {_E6.format('longitude', 0.005)} AS west, {_E6.format('longitude', 0.995)} AS east, {_E6.format('latitude', 0.005)} AS south, {_E6.format('latitude', 0.995)} AS north FROM f GROUP BY state",
    "toggle_counts": f"{_KEYS}, p AS (SELECT key, list(DISTINCT source) AS s FROM k GROUP BY key), u AS (SELECT unnest(s) AS source, len(s) AS k FROM p) SELECT source, count(*)::BIGINT AS n, count(*) FILTER (WHERE k > 1)::BIGINT AS matched, count(*) FILTER (WHERE k = 1)::BIGINT AS only FROM u GROUP BY 1",
    "smallest_zone": f"WITH {COMPANIES_SQL}, p AS (SELECT doc_id AS id, longitude + 0.0003::DOUBLE AS x, latitude + 0.0003::DOUBLE AS y FROM co) SELECT id, CASE WHEN x > 8.25 AND x < 8.75 AND y > 53.25 AND y < 53.75 THEN 'core' WHEN x > 8.0 AND x < 8.5 AND y > 53.0 AND y < 54.1 THEN 'west' WHEN x > 8.5 AND x < 9.1 AND y > 53.0 AND y < 54.1 THEN 'east' END AS zone FROM p",
    "host_features": f"SELECT {_REG} AS host, count(*)::BIGINT AS hits, count(DISTINCT page_id % 5)::BIGINT AS engines, min(page_id) AS best_rank, bool_or(page_id % 5 = 0) AS first_engine FROM pages GROUP BY 1",
    "domain_candidates": f"{_KEYS}, h AS (SELECT DISTINCT {_REG} AS host FROM pages), s AS (SELECT doc_id, string_split(key, ' ')[1] AS first, replace(key, ' ', '') AS whole FROM k) SELECT doc_id, host FROM s JOIN h ON (length(first) >= 3 AND starts_with(string_split(host, '.')[1], first)) OR (length(whole) >= 3 AND starts_with(string_split(host, '.')[1], whole))",
    "quality_checks": "SELECT l_returnflag, count(*)::BIGINT AS n, count(*) FILTER (WHERE NOT regexp_matches(l_linestatus, '^[OP]$'))::BIGINT AS bad_status, count(*) FILTER (WHERE NOT l_quantity BETWEEN 1 AND 40)::BIGINT AS out_of_range, count(DISTINCT l_suppkey)::BIGINT AS suppliers, floor(quantile_cont(l_quantity, 0.99) * 1000 + 0.5)::BIGINT AS p99_milli FROM lineitem GROUP BY 1",
    "pair_agreement": f"{_KEYS}, a AS (SELECT count(*) AS n FROM k WHERE key <> '' GROUP BY key, postcode), b AS (SELECT count(*) AS n FROM k WHERE key <> '' GROUP BY key, state), c AS (SELECT count(*) AS n FROM k WHERE key <> '' GROUP BY key, postcode, state) SELECT (SELECT sum(n * (n - 1) // 2) FROM a)::BIGINT AS first, (SELECT sum(n * (n - 1) // 2) FROM b)::BIGINT AS second, (SELECT sum(n * (n - 1) // 2) FROM c)::BIGINT AS both",
}
