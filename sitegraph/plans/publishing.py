"""Queries of the contract, the published tiers and files, and selections from them."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import constants as C
from ..functions import text as T
from ..operators import publish, serve
from .adapter import COMPANIES_SQL, companies, name_key_sql, table
from .identity import cases
from .registers import FORM_NAME
from .staging import shared_folder

ITEM, OPERATOR, BRAND = cases(["Q1", None, "Q7", None, None]), cases([None, "Q2", "Q3", "Q8"]), cases(["Q4", None, None, "Q2", "Q5", "Q1"])
MATCH = cases(["name_plz", "none", "ambiguous", None, "exact_hrb", "n/a", "none"])
COORDS = cases(["Point(8.5 53.5)", "Point(8.2 53.9)", None, "Point(1 1)", "point(8.9 53.1)"], "r")
RING = [(8.1, 53.1), (8.7, 53.2), (8.9, 53.9), (8.3, 53.6)]
SCOPE = [[(8.0, 53.0), (8.5, 53.0), (8.5, 53.5), (8.0, 53.5)], [(8.5, 53.5), (9.1, 53.5), (9.1, 54.2), (8.5, 54.2)]]


def _rows(spark, sf_dir):
    """Companies as rows of the merged table."""
    c = companies(spark, sf_dir).withColumnRenamed("area", "grounds_area_m2")
    made = {"email": "'a@b.de'", "wd_id": ITEM, "wd_operator_id": OPERATOR, "wd_brand_id": BRAND, "register_match": MATCH}
    return c.withColumns({**{k: F.expr(v) for k, v in made.items()}, "source_count": F.when(F.col("doc_id") % 4 == 0, 2).otherwise(1), "is_industrial": F.col("source").isin(C.INDUSTRIAL_SOURCES)})


def _items(spark, sf_dir):
    n = table(spark, sf_dir, "nation").select(F.concat(F.lit("Q"), F.col("n_nationkey").cast("string")).alias("qid"), F.col("n_name").alias("label"), (F.col("n_nationkey") % 5).alias("r"))
    return n.select("qid", "label", F.expr(COORDS).alias("coord"), F.when(F.col("r") % 2 == 0, F.concat(F.lit("https://"), F.lower("label"), F.lit(".de"))).alias("website"))


def conform_contract(spark, sf_dir):
    """The contract's columns of a table that lacks some and has others as other types."""
    c = _rows(spark, sf_dir).select("id", "name", F.col("source_count").cast("string").alias("source_count"), "latitude", "source", F.lit("x").alias("own"))
    return publish.conform(c).select("id", "email", "confidence_score", "is_industrial", "source_count", "own", "website", F.floor(F.col("latitude") * 10_000 + 0.5).cast("long").alias("lat_e4"))


def flat_tier(spark, sf_dir):
    """The public tier as it is written and read: public columns alone."""
    rows = publish.conform(_rows(spark, sf_dir))
    folder = shared_folder(spark)
    publish.write_tier(rows.select(publish.public_columns(rows.columns, ["wd_id", "register_match"])), folder, "flat")
    return spark.read.parquet(f"{folder}/flat").select("id", "state", "district", "business_type", "source_count", "wd_id", "register_match")


def extract_files(spark, sf_dir):
    """The extracts of every area and sector, read back from their files."""
    folder = f"{shared_folder(spark)}/extracts"
    publish.write_cube(serve.extract_cube(_rows(spark, sf_dir).select("id", "state", "business_type", "is_industrial"), "de"), folder)
    return spark.read.parquet(folder).groupBy("area", "sector").agg(F.count("*").alias("n"), F.min("id").alias("first_id"))


def polygon_side_file(spark, sf_dir):
    """Rows with a polygon of their own, for the side file."""
    rows = _rows(spark, sf_dir).withColumn("grounds_area_source", F.expr(cases(["own_polygon", "landuse_zone", None])))
    return rows.where("grounds_area_source = 'own_polygon'").select("id", "source", "state")


def search_index(spark, sf_dir):
    return _rows(spark, sf_dir).select("id", "name", T.name_key(F.col("name")).alias("name_key"), F.floor(F.col("longitude") * 1000 + 0.5).cast("long").alias("lon_e3"))


def search_display(spark, sf_dir):
    """Hits of the search index with the display columns of the flat tier."""
    rows = _rows(spark, sf_dir)
    index = rows.select("id", "name", T.name_key(F.col("name")).alias("name_key"))
    hits = serve.search(index, "the", 40).select("id", "name")
    return hits.join(rows.select("id", "state", "source", "business_type"), "id", "left")


def display_props(spark, sf_dir):
    """What the map needs of each row, and whether it shows it as confirmed."""
    rows = _rows(spark, sf_dir)
    label = F.coalesce(F.nullif(F.trim("name"), F.lit("")), F.col("business_type"))
    return rows.select("id", label.alias("label"), F.concat(F.lit("+"), F.col("source"), F.lit("+")).alias("sources"), publish.shown_as_matched().alias("matched"), F.col("is_industrial").cast("int").alias("industrial"))


def props_semi_join(spark, sf_dir):
    """Rows whose display properties pass a test, by a semi join on the id."""
    props = _rows(spark, sf_dir).select("id", publish.shown_as_matched().alias("matched"), "business_type")
    wanted = props.where("matched AND business_type <> 'shop'")
    return companies(spark, sf_dir).join(wanted.select("id"), "id", "left_semi").select("id", "name")


def layer_features(spark, sf_dir):
    """Features of two layers, as lines for the tile builder."""
    rows = _rows(spark, sf_dir).withColumns({"longitude": F.when(F.col("doc_id") % 9 > 0, F.col("doc_id") % 50 / F.lit(2.0)), "latitude": F.lit(53.5)})
    cols = ["id", "name", "phone", "longitude", "latitude"]
    f = publish.layered_features({"points": rows.where("NOT is_industrial").select(cols), "sites": rows.where("is_industrial").select("id", "state", "longitude", "latitude")})
    return f.select("layer", "id", F.md5("feature").alias("feature_md5"))


def record_texts(spark, sf_dir):
    """JSON records and CSV cells of rows with dates, bytes, nested and missing values."""
    e = table(spark, sf_dir, "events").select("event_id", F.col("ts"), F.to_date("ts").alias("day"), F.unhex(F.hex("user_id")).alias("raw"), F.when(F.col("event_id") % 3 == 0, F.lit(float("nan"))).otherwise(F.col("event_id") % 8 / F.lit(2.0)).alias("v"), F.array("user_id", "event_id").alias("ids"))
    e = e.withColumn("as_csv", F.col("ids"))
    texts = publish.flat_text(e.select("event_id", "as_csv")).withColumnRenamed("event_id", "c_id")
    e = e.drop("as_csv").join(texts, F.col("event_id") == F.col("c_id"))
    return publish.json_records(e.select("event_id", "ts", "day", "raw", "v", "ids", "as_csv"))


def manifest_sums(spark, sf_dir):
    """Files that a version lists with sizes and sums that match what is there."""
    folder = shared_folder(spark)
    table(spark, sf_dir, "nation").coalesce(1).write.parquet(f"{folder}/v1/nation")
    publish.publish_version(spark, folder, "v1")
    listed = spark.read.schema("path string, size long, sha256 string, version string").json(f"{folder}/v1/manifest")
    again = publish.file_sums(spark, f"{folder}/v1").select(F.col("path").alias("p"), F.col("sha256").alias("s"))
    now = publish.current_version(spark, folder, ["v1"])
    return listed.join(again, F.col("path") == F.col("p")).select(F.col("version"), F.lit(now).alias("current"), (F.col("sha256") == F.col("s")).alias("same"), F.startswith("path", F.lit("nation/")).alias("inside"))


def drawn_selection(spark, sf_dir):
    """Rows within a polygon that a reader drew."""
    rows = _rows(spark, sf_dir).withColumns({"longitude": F.col("longitude") + 0.00037, "latitude": F.col("latitude") + 0.00041})
    return publish.within(rows, RING).select("id")


def scope_clip(spark, sf_dir):
    """Positions outside the scope are blanked, and rows without a state are taken by their position."""
    rows = _rows(spark, sf_dir).withColumns({"longitude": F.col("longitude") + 0.00037, "latitude": F.col("latitude") + 0.00041, "state": F.when(F.col("doc_id") % 3 > 0, F.col("state"))})
    kept = publish.scoped(rows, ["Bremen", "Berlin"], SCOPE).select(F.col("id").alias("k_id"))
    return publish.clipped(rows, SCOPE).join(kept, F.col("id") == F.col("k_id"), "left").select("id", F.col("longitude").isNotNull().alias("placed"), F.col("k_id").isNotNull().alias("kept"))


def nested_source_rows(spark, sf_dir):
    """The members of each company with their raw records and potentials, as one list a source."""
    o = table(spark, sf_dir, "orders")
    members = o.select(F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("company"), F.expr(cases(["osm", "mastr"], "o_orderkey")).alias("source"), F.concat(F.lit("m"), F.col("o_orderkey").cast("string")).alias("id"))
    li = table(spark, sf_dir, "lineitem")
    raw = li.where("l_linenumber < 3").select(F.concat(F.lit("m"), F.col("l_orderkey").cast("string")).alias("id"), F.lit("unit").alias("record"), F.concat(F.lit("k"), F.col("l_linenumber").cast("string")).alias("key"), F.create_map(F.lit("flag"), F.col("l_returnflag")).alias("fields"))
    heat = li.where("l_linenumber = 1 AND l_partkey % 3 = 0").select(F.concat(F.lit("m"), F.col("l_orderkey").cast("string")).alias("site_id"), F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("potential"), (F.col("l_partkey") % 7).alias("heat"))
    n = publish.nested_records(members, raw, heat)
    return n.select("company", "source", F.size("rows").cast("long").alias("members"), F.md5(F.to_json("rows")).alias("rows_md5"))


def item_roles(spark, sf_dir):
    return publish.linked_items(_rows(spark, sf_dir), _items(spark, sf_dir))


def item_attributes(spark, sf_dir):
    """Attributes from a row's own item, else from its operator's; an empty website is filled from them."""
    out = publish.picked_attributes(_rows(spark, sf_dir).select("id", "website", "wd_id", "wd_operator_id"), _items(spark, sf_dir), ["label", "website"])
    fill = F.col("website").isNull() & F.col("wd_website").isNotNull()
    return out.select("id", "wd_label", F.coalesce("website", "wd_website").alias("website"), F.when(fill, "wikidata").alias("website_source"))


def unplaced_items(spark, sf_dir):
    """Items known as operator or brand of rows here, that no row is itself."""
    return publish.unplaced_items(_rows(spark, sf_dir), _items(spark, sf_dir))


def item_sets(spark, sf_dir):
    """The distinct items of each role, in one pass."""
    ids = lambda c: F.array_join(F.array_sort(F.collect_set(c)), " ")
    return _rows(spark, sf_dir).agg(ids("wd_id").alias("entities"), ids("wd_operator_id").alias("operators"), ids("wd_brand_id").alias("brands"))


def pair_scores(spark, sf_dir):
    """Links by name key and postcode against links by name key and state: precision and recall."""
    c = companies(spark, sf_dir).select("doc_id", T.name_key(F.col("name")).alias("key"), "postcode", "state", "street").where("key <> ''")
    def pairs(*by):
        other = c.select(*by, F.col("doc_id").alias("b"))
        return c.select(*by, F.col("doc_id").alias("a")).join(other, list(by)).where("a < b").select("a", "b")
    return publish.pair_scores(pairs("key", "postcode", "street"), pairs("key", "state"))


def reconcile_report(spark, sf_dir):
    """Register entries that the map lacks, by district and legal form, the first eight forms."""
    c = _rows(spark, sf_dir).withColumn("form", T.legal_form(F.expr(FORM_NAME))["form"]).where("coalesce(register_match, '') IN ('', 'none', 'n/a')")
    forms = c.groupBy("form").agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.asc_nulls_last("form")).limit(8)
    return c.groupBy(F.lit("district").alias("what"), F.col("district").alias("value")).agg(F.count("*").alias("n")).unionByName(forms.select(F.lit("form").alias("what"), F.col("form").alias("value"), "n"))


def ui_boxes(spark, sf_dir):
    """The extent of each state and of all of them, for the map's start."""
    boxes = serve.extents(companies(spark, sf_dir), "state").drop("n")
    return boxes.unionByName(boxes.agg(F.lit("all").alias("state"), F.min("west").alias("west"), F.max("east").alias("east"), F.min("south").alias("south"), F.max("north").alias("north")))


def toggle_groups(spark, sf_dir):
    """Rows of each source and group, all and those of several sources."""
    rows = _rows(spark, sf_dir)
    return rows.withColumn("part", F.explode(F.split("source", r"\+"))).groupBy("part", "business_type").agg(F.count("*").alias("n"), F.count_if(F.col("source_count") > 1).alias("matched"))


def display_toggles(spark, sf_dir):
    """Rows that a choice of datasets shows, by how many sources they have."""
    pick = serve.Selection(datasets=[serve.Dataset("osm", only=False), serve.Dataset("ied", matched=False, groups=["craft", "office"]), serve.Dataset("mastr", matched=False, only=False), serve.Dataset("overture", groups=[])])
    return _rows(spark, sf_dir).where(pick.where()).select("id", "source", "source_count")


def selection_all(spark, sf_dir):
    """Rows by district, sector and a list of ids at once."""
    ids = [f"doc_{i}" for i in range(0, 2000, 2)]
    pick = serve.Selection(district="Kreis 3", sector="craft", ids=ids)
    other = serve.Selection(district="Kreis 6", industrial=False)
    rows = _rows(spark, sf_dir)
    return rows.where(pick.where()).unionByName(rows.where(other.where())).select("id", "district")


QUERIES = {
    f.__name__: f
    for f in (
        conform_contract, flat_tier, extract_files, polygon_side_file, search_index, search_display, display_props, props_semi_join, layer_features, record_texts,
        manifest_sums, drawn_selection, scope_clip, nested_source_rows, item_roles, item_attributes, unplaced_items, item_sets, pair_scores, reconcile_report, ui_boxes,
        toggle_groups, display_toggles, selection_all,
    )
}

_R = f"""WITH {COMPANIES_SQL}, r AS (
  SELECT *, {ITEM} AS wd_id, {OPERATOR} AS wd_operator_id, {BRAND} AS wd_brand_id, {MATCH} AS register_match, CASE WHEN doc_id % 4 = 0 THEN 2 ELSE 1 END AS source_count, source IN ('ied', 'abwaerme', 'mastr') AS is_industrial FROM co
), i AS (SELECT 'Q' || n_nationkey AS qid, n_name AS label, n_nationkey % 5 AS r FROM nation), it AS (SELECT qid, label, {COORDS} AS coord, CASE WHEN r % 2 = 0 THEN 'https://' || lower(label) || '.de' END AS website FROM i)"""
_MATCHED = "(source_count > 1 OR coalesce(register_match IN ('name_plz', 'exact_hrb'), false) OR wd_id IS NOT NULL OR wd_operator_id IS NOT NULL)"
_E6 = "floor(quantile_cont({0}, {1}) * 1e6 + 0.5)::BIGINT"


def _ring_sql(ring: list[tuple[float, float]]) -> str:
    tests = []
    for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1], strict=True):
        tests.append(f"(({ay}::DOUBLE > y) <> ({by}::DOUBLE > y) AND x < ({bx}::DOUBLE - {ax}::DOUBLE) * (y - {ay}::DOUBLE) / ({by}::DOUBLE - {ay}::DOUBLE) + {ax}::DOUBLE)::INT" if ay != by else "0")
    return f"(({' + '.join(tests)}) % 2 = 1)"


ORACLE_SQL = {
    "conform_contract": f"{_R} SELECT id, NULL::VARCHAR AS email, 0.0::DOUBLE AS confidence_score, false AS is_industrial, source_count::BIGINT AS source_count, 'x' AS own, NULL::VARCHAR AS website, floor(latitude * 10000 + 0.5)::BIGINT AS lat_e4 FROM r",
    "flat_tier": f"{_R} SELECT id, state, district, business_type, source_count::BIGINT AS source_count, wd_id, register_match FROM r",
    "extract_files": f"{_R}, a AS (SELECT id, unnest([state, 'de']) AS area, business_type, is_industrial FROM r), s AS (SELECT id, area, unnest(list_filter([business_type, CASE WHEN is_industrial THEN 'is_industrial' END, 'all'], lambda x: x IS NOT NULL)) AS sector FROM a) SELECT area, sector, count(*)::BIGINT AS n, min(id) AS first_id FROM s GROUP BY 1, 2",
    "polygon_side_file": f"{_R} SELECT id, source, state FROM r WHERE doc_id % 3 = 0",
    "search_index": f"{_R} SELECT id, name, {name_key_sql('name')} AS name_key, floor(longitude * 1000 + 0.5)::BIGINT AS lon_e3 FROM r",
    "search_display": f"{_R}, h AS (SELECT id, name FROM r WHERE contains(lower(name), 'the') ORDER BY starts_with(lower(name), 'the') DESC, length(name), id LIMIT 40) SELECT h.id, h.name, state, source, business_type FROM h JOIN r ON h.id = r.id",
    "display_props": f"{_R} SELECT id, coalesce(nullif(trim(name), ''), business_type) AS label, '+' || source || '+' AS sources, {_MATCHED} AS matched, is_industrial::INT AS industrial FROM r",
    "props_semi_join": f"{_R} SELECT id, name FROM r WHERE {_MATCHED} AND business_type <> 'shop'",
    "layer_features": f"""{_R}, p AS (SELECT *, '{{"type":"Feature","geometry":{{"type":"Point","coordinates":[' || (doc_id % 50 / 2)::DOUBLE || ',53.5]}},"properties":{{"id":"' || id || '"' AS head FROM r WHERE doc_id % 9 > 0) SELECT CASE WHEN is_industrial THEN 'sites' ELSE 'points' END AS layer, id, md5(head || CASE WHEN is_industrial THEN ',"state":"' || state || '"' ELSE ',"name":"' || name || '"' || coalesce(',"phone":"' || phone || '"', '') END || '}}}}') AS feature_md5 FROM p""",
    "record_texts": """SELECT '{"event_id":' || event_id || ',"ts":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || '","day":"' || strftime(ts, '%Y-%m-%d') || '","raw":"' || CASE WHEN length(printf('%x', user_id)) % 2 = 1 THEN '0' ELSE '' END || printf('%x', user_id) || '"' || CASE WHEN event_id % 3 = 0 THEN '' ELSE ',"v":' || (event_id % 8 / 2)::DOUBLE END || ',"ids":[' || user_id || ',' || event_id || '],"as_csv":"[' || user_id || ',' || event_id || ']"}' AS record FROM events""",
    "manifest_sums": "SELECT 'v1' AS version, 'v1' AS current, true AS same, true AS inside",
    "drawn_selection": f"{_R}, p AS (SELECT id, longitude + 0.00037::DOUBLE AS x, latitude + 0.00041::DOUBLE AS y FROM r) SELECT id FROM p WHERE {_ring_sql(RING)}",
    "scope_clip": f"{_R}, p AS (SELECT id, CASE WHEN doc_id % 3 > 0 THEN state END AS st, longitude + 0.00037::DOUBLE AS x, latitude + 0.00041::DOUBLE AS y FROM r), q AS (SELECT *, {_ring_sql(SCOPE[0])} OR {_ring_sql(SCOPE[1])} AS inside FROM p) SELECT id, inside AS placed, coalesce(st IN ('Bremen', 'Berlin') , inside) AS kept FROM q",
    "nested_source_rows": """WITH r AS (SELECT 'm' || l_orderkey AS id, '[' || string_agg('{"record":"unit","key":"k' || l_linenumber || '","fields":[{"key":"flag","value":"' || l_returnflag || '"}]}', ',' ORDER BY l_linenumber, l_returnflag) || ']' AS raw FROM lineitem WHERE l_linenumber < 3 GROUP BY 1),
 h AS (SELECT 'm' || l_orderkey AS id, '[' || string_agg('{"potential":"p' || l_partkey || '","heat":' || (l_partkey % 7) || '}', ',' ORDER BY 'p' || l_partkey) || ']' AS pot FROM lineitem WHERE l_linenumber = 1 AND l_partkey % 3 = 0 GROUP BY 1),
 m AS (SELECT 'c' || o_custkey AS company, CASE o_orderkey % 2 WHEN 0 THEN 'osm' ELSE 'mastr' END AS source, 'm' || o_orderkey AS id FROM orders)
 SELECT company, source, count(*)::BIGINT AS members, md5('[' || string_agg('{"id":"' || m.id || '"' || coalesce(',"potentials":' || pot, '') || coalesce(',"raw":' || raw, '') || '}', ',' ORDER BY m.id) || ']') AS rows_md5 FROM m LEFT JOIN r ON r.id = m.id LEFT JOIN h ON h.id = m.id GROUP BY 1, 2""",
    "item_roles": f"{_R} SELECT id AS company, 'entity' AS role, qid, label FROM r JOIN it ON qid = wd_id UNION ALL SELECT id, 'operator', qid, label FROM r JOIN it ON qid = wd_operator_id UNION ALL SELECT id, 'brand', qid, label FROM r JOIN it ON qid = wd_brand_id",
    "item_attributes": f"{_R} SELECT r.id, coalesce(a.label, b.label) AS wd_label, coalesce(r.website, a.website, b.website) AS website, CASE WHEN r.website IS NULL AND coalesce(a.website, b.website) IS NOT NULL THEN 'wikidata' END AS website_source FROM r LEFT JOIN it a ON a.qid = wd_id LEFT JOIN it b ON b.qid = wd_operator_id",
    "unplaced_items": f"{_R}, p AS (SELECT qid, regexp_extract(lower(coord), 'point\\(([0-9.]+) ([0-9.]+)\\)', 1)::DOUBLE AS lon, regexp_extract(lower(coord), 'point\\(([0-9.]+) ([0-9.]+)\\)', 2)::DOUBLE AS lat FROM it WHERE coord IS NOT NULL), b AS (SELECT quantile_cont(longitude, 0.005) - 0.03 AS w, quantile_cont(latitude, 0.005) - 0.02 AS s, quantile_cont(longitude, 0.995) + 0.03 AS e, quantile_cont(latitude, 0.995) + 0.02 AS n FROM r) SELECT qid, CASE WHEN qid IN (SELECT wd_operator_id FROM r WHERE wd_operator_id IS NOT NULL) THEN 'operator' ELSE 'brand' END AS role, lon, lat FROM p, b WHERE qid NOT IN (SELECT wd_id FROM r WHERE wd_id IS NOT NULL) AND qid IN (SELECT wd_operator_id FROM r UNION SELECT wd_brand_id FROM r) AND lon BETWEEN w AND e AND lat BETWEEN s AND n",
    "item_sets": f"{_R} SELECT string_agg(DISTINCT wd_id, ' ' ORDER BY wd_id) AS entities, string_agg(DISTINCT wd_operator_id, ' ' ORDER BY wd_operator_id) AS operators, string_agg(DISTINCT wd_brand_id, ' ' ORDER BY wd_brand_id) AS brands FROM r",
    "pair_scores": f"{_R}, k AS (SELECT *, {name_key_sql('name')} AS key FROM r), c AS (SELECT * FROM k WHERE key <> ''), f AS (SELECT a.doc_id AS a, b.doc_id AS b FROM c a JOIN c b USING (key, postcode, street) WHERE a.doc_id < b.doc_id), t AS (SELECT a.doc_id AS a, b.doc_id AS b FROM c a JOIN c b USING (key, state) WHERE a.doc_id < b.doc_id), n AS (SELECT (SELECT count(*) FROM f) AS found, (SELECT count(*) FROM t) AS true_, (SELECT count(*) FROM f JOIN t USING (a, b)) AS both_) SELECT found::BIGINT AS found, true_::BIGINT AS \"true\", both_::BIGINT AS both, coalesce(floor(both_ * 10000.0 / nullif(found, 0) + 0.5), 0)::BIGINT AS precision_e4, coalesce(floor(both_ * 10000.0 / nullif(true_, 0) + 0.5), 0)::BIGINT AS recall_e4 FROM n",
    "reconcile_report": f"{_R}, c AS (SELECT *, ([{', '.join(['''GmbH''', '''AG''', '''GmbH & Co. KG''', '''e.K.'''])}, NULL])[1] AS x FROM r WHERE coalesce(register_match, '') IN ('', 'none', 'n/a')), f AS (SELECT CASE doc_id % 5 WHEN 0 THEN 'GmbH' WHEN 1 THEN 'AG' WHEN 2 THEN 'GmbH & Co. KG' WHEN 3 THEN 'e.K.' END AS form FROM r WHERE coalesce(register_match, '') IN ('', 'none', 'n/a')), g AS (SELECT form, count(*) AS n FROM f GROUP BY 1 ORDER BY n DESC, form NULLS LAST LIMIT 8) SELECT 'district' AS what, district AS value, count(*)::BIGINT AS n FROM r WHERE coalesce(register_match, '') IN ('', 'none', 'n/a') GROUP BY 2 UNION ALL SELECT 'form', form, n::BIGINT FROM g",
    "ui_boxes": f"{_R}, b AS (SELECT state, {_E6.format('longitude', 0.005)} AS west, {_E6.format('longitude', 0.995)} AS east, {_E6.format('latitude', 0.005)} AS south, {_E6.format('latitude', 0.995)} AS north FROM r GROUP BY 1) SELECT * FROM b UNION ALL SELECT 'all', min(west), max(east), min(south), max(north) FROM b",
    "toggle_groups": f"{_R} SELECT source AS part, business_type, count(*)::BIGINT AS n, count(*) FILTER (WHERE source_count > 1)::BIGINT AS matched FROM r GROUP BY 1, 2",
    "display_toggles": f"{_R} SELECT id, source, source_count FROM r WHERE (source = 'osm' AND source_count >= 2) OR (source = 'ied' AND source_count < 2 AND business_type IN ('craft', 'office'))",
    "selection_all": f"{_R} SELECT id, district FROM r WHERE (district = 'Kreis 3' AND business_type = 'craft' AND doc_id % 2 = 0 AND doc_id < 2000) OR (district = 'Kreis 6' AND NOT is_industrial)",
}
ORACLE_SQL["reconcile_report"] = ORACLE_SQL["reconcile_report"].replace("c AS (SELECT *, ([GmbH, AG, GmbH & Co. KG, e.K., NULL])[1] AS x FROM r WHERE coalesce(register_match, '') IN ('', 'none', 'n/a')), ", "")
