"""Queries of the source adapters and register tables, over the test tables as their raw rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import constants as C
from ..functions import text as T
from ..operators import sources
from .adapter import COMPANIES_SQL, companies, name_key_sql, table
from .identity import PLACE_TAGS, cases

TECH = "(CASE l_orderkey % 6 WHEN 0 THEN 'wind' WHEN 1 THEN 'solar' WHEN 2 THEN 'storage' WHEN 3 THEN 'nuclear' WHEN 4 THEN 'gas_consumption' ELSE 'electricity_consumption' END)"
UNIT = "concat(cast(l_orderkey AS string), '-', cast(l_linenumber AS string))"
STATUS = "(CASE WHEN l_linestatus = 'O' THEN 'In Betrieb' WHEN l_linenumber = 1 THEN '35' ELSE 'Stillgelegt' END)"
PLACE = "(CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE concat('L', cast(l_partkey % 40 AS string)) END)"
KW = "cast(floor(l_extendedprice / 100) AS bigint)"
FORM_NAME = "concat('Firma ', cast(o_orderkey % 7 AS string), CASE o_orderkey % 4 WHEN 0 THEN ' GmbH' WHEN 1 THEN ' AG' WHEN 2 THEN ' gmbh' ELSE '' END)"
_milli = lambda c: F.floor(F.col(c) * 1000 + 0.5).cast("long")


def _units(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    made = {"unit": UNIT, "place": PLACE, "tech": TECH, "status": STATUS, "kw": KW}
    return li.select(
        *[F.expr(v).alias(k) for k, v in made.items()], (F.col("l_suppkey") % 20).alias("operator"), F.when(F.col("l_linenumber") % 3 == 1, F.concat(F.lit("Park "), F.col("l_linenumber").cast("string"))).alias("name"),
        F.when(F.col("l_partkey") % 4 > 0, F.lit(50.0) + F.col("l_partkey") % 8).alias("lat"), F.when(F.col("l_partkey") % 4 > 0, F.lit(8.0) + F.col("l_partkey") % 16).alias("lon"),
        F.concat(F.lit("D"), (F.col("l_suppkey") % 4).cast("string")).alias("district"),
    )


def _districts(spark):
    ring = lambda w, s, e, t: [(w, s), (e, s), (e, t), (w, t)]
    return spark.createDataFrame([("D0", ring(8.0, 50.0, 14.0, 53.0)), ("D1", ring(8.0, 52.0, 11.95, 56.0)), ("D2", ring(4.0, 45.0, 17.0, 56.0))], "district string, ring array<struct<x:double,y:double>>")


def unit_floors(spark, sf_dir):
    """Units in operation above their kind's floor, by kind."""
    return sources.units_kept(_units(spark, sf_dir)).groupBy("tech").agg(F.count("*").alias("units"), F.sum("kw").alias("kw"))


def unit_positions(spark, sf_dir):
    """Positions that are outside the country or far from the district that a unit names."""
    return sources.plausible_units(_units(spark, sf_dir), _districts(spark)).groupBy("district", "dropped").agg(F.count("*").alias("n"), F.count("lat").alias("placed"))


def unit_sites(spark, sf_dir):
    """One row an operator and place, with the detail of its units as JSON."""
    u = sources.plausible_units(sources.units_kept(_units(spark, sf_dir)), _districts(spark))
    s = sources.unit_sites(u, ["kw"])
    return s.select("operator", "place", "techs", "consumer_only", "units", F.md5("detail").alias("detail_md5"), "name", _milli("lat").alias("lat"), _milli("lon").alias("lon"), "coord_dropped")


def storage_fill(spark, sf_dir):
    """Units without a capacity take that of their plant's first row."""
    p = table(spark, sf_dir, "part")
    units = p.select(F.col("p_partkey").alias("unit"), F.concat(F.lit("S"), (F.col("p_partkey") % 50).cast("string")).alias("plant"), F.when(F.col("p_partkey") % 3 == 0, F.col("p_size").cast("long")).alias("capacity"))
    plants = p.select(F.concat(F.lit("S"), (F.col("p_partkey") % 60 + 10).cast("string")).alias("plant"), F.when(F.col("p_partkey") % 2 == 0, F.col("p_size").cast("long") * 100).alias("capacity"), F.col("p_partkey").alias("row"))
    return sources.storage_filled(units, plants)


def grid_layer(spark, sf_dir):
    """Connection points at the mean position of their place's units, with their grid's name."""
    u = _units(spark, sf_dir)
    means = sources.place_means([u.where("tech = 'wind'"), u.where("tech = 'solar'"), u.where("tech = 'storage'")])
    points = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.concat(F.lit("L"), (F.col("c_custkey") % 60).cast("string")).alias("place"), F.col("c_nationkey").alias("grid"))
    grids = table(spark, sf_dir, "nation").where("n_nationkey % 3 > 0").select(F.col("n_nationkey").alias("grid"), F.col("n_name").alias("grid_name"))
    return sources.grid_points(points, means, grids).select("id", "place", _milli("lat").alias("lat"), _milli("lon").alias("lon"), "grid_name")


def legal_operators(spark, sf_dir):
    a = table(spark, sf_dir, "supplier").select("s_suppkey", F.when(F.col("s_suppkey") % 7 > 0, F.col("s_name")).alias("name"), F.expr(cases(["Natürliche Person", "Juristische Person", None], "s_suppkey")).alias("person"))
    return sources.legal_operators(a)


def report_rows(spark, sf_dir):
    """Installations of the last report year that are in use."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.year("o_orderdate").alias("year"), F.expr(cases(["IED", "E-PRTR"], "o_orderkey")).alias("kind"), F.expr(cases(["functional", "disused", "functional"], "o_custkey")).alias("status"))
    return sources.report_rows(o).select("o_orderkey", F.col("year").cast("long").alias("year"))


def heat_site_totals(spark, sf_dir):
    """Waste heat by site: sums, the weighted temperature, the first potentials."""
    li = table(spark, sf_dir, "lineitem")
    raw = li.select(
        (F.col("l_suppkey") % 15).alias("uid"), F.expr(cases([" Am Kai ", "am kai", "Werkstr. 2"], "l_partkey")).alias("street"), F.expr(cases(["28195", " 28195"], "l_linenumber")).alias("postcode"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("row"), F.concat(F.lit("Firma "), (F.col("l_suppkey") % 15).cast("string")).alias("name"),
        F.when(F.col("l_linenumber") == 3, "a@b.de").alias("email"), F.when(F.col("l_partkey") % 6 > 0, F.concat(F.lit("Ofen "), (F.col("l_partkey") % 9).cast("string"))).alias("potential"),
        F.when(F.col("l_suppkey") % 15 > 1, F.floor("l_quantity").cast("long")).alias("heat"), F.floor(F.col("l_quantity") * 2).cast("long").alias("power"),
        F.when(F.col("l_linenumber") % 2 == 0, F.floor(F.col("l_discount") * 1000).cast("long")).alias("temperature"),
    )
    s = sources.heat_sites(raw)
    return s.select("key", "name", "email", "heat", "power", _milli("temperature").alias("temperature"), "potentials", "potential_names")


def potential_rows(spark, sf_dir):
    """Every cell of the workbook, as numbers or texts, under its site's id."""
    raw = table(spark, sf_dir, "documents").select((F.col("doc_id") % 9).alias("uid"), F.lit("Am Kai").alias("street"), F.expr(cases(["1", " 2 "])).alias("postcode"), F.expr(cases(["12", "n/a", " 7.5", "", None])).alias("heat"), F.expr(cases([" Ofen ", "nan", "", None, "NaN"])).alias("potential"))
    return sources.potentials(raw, ["heat", "uid"]).select("site_id", "uid", "heat", "potential", "postcode")


def _register_tables(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    companies_ = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("company"), F.expr(cases(["2020-01-01", "", None, None], "c_custkey")).alias("dissolved"))
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    names = o.select(F.col("o_custkey").alias("company"), F.expr(FORM_NAME).alias("name"), day.alias("valid_from"), (F.col("o_orderkey") % 5 == 0).alias("current"), F.col("o_orderkey").alias("row"))
    addresses = o.select(F.col("o_custkey").alias("company"), F.expr(cases(["Am Kai 12 a", "Hauptstr.", ""], "o_orderkey")).alias("address"), F.expr(cases(["28195", ""], "o_orderkey")).alias("zip"), F.expr(cases(["28195 Bremen", "Hamburg", ""], "o_orderkey")).alias("place"), day.alias("valid_from"), (F.col("o_orderkey") % 4 == 0).alias("current"), F.col("o_orderkey").alias("row"))
    refs = o.select(F.col("o_custkey").alias("company"), F.concat(F.expr(cases(["Bremen HRB ", "HRA ", "ohne "], "o_orderkey")), F.col("o_orderkey").cast("string"), F.lit(" HB")).alias("reference"), F.expr(cases(["Bremen", "Oldenburg"], "o_orderkey")).alias("court"), (F.col("o_orderkey") % 3 == 0).alias("open"), day.alias("seen"), F.col("o_orderkey").alias("row"))
    return companies_, names, addresses, refs


def register_build(spark, sf_dir):
    """A register's companies with their current name, address and reference, and the names before."""
    r = sources.register_2022(*_register_tables(spark, sf_dir))
    return r.select("company", "name", "previous_names", "street", "housenumber", "postcode", "city", "court", "hr_registration", "register_division", "legal_form", "status", "key_full", "street_key")


def name_variants(spark, sf_dir):
    """The spellings of each company's name that give keys of their own."""
    tables = _register_tables(spark, sf_dir)
    return sources.name_variants(sources.register_2022(*tables), tables[1])


def tag_rows(spark, sf_dir):
    """Places whose tags tell a business."""
    d = table(spark, sf_dir, "documents").select(F.concat(F.lit("node/"), F.col("doc_id").cast("string")).alias("id"), F.from_json(F.expr(PLACE_TAGS), "map<string,string>").alias("tags"), F.lit(8.0).alias("lon"), F.lit(53.0).alias("lat"))
    return sources.tag_rows(d, ["office", "shop", "craft", "industrial", "amenity", "man_made"], ["no", "vacant"]).select("id", "name", "business_type", "business_subtype", "phone")


def taxonomy_rows(spark, sf_dir):
    """Named places of the country that are sure enough, with their type."""
    made = {"name": cases(["A", " ", None, "B"]), "category": cases(["bakery", "plant", "x", None, "gym"]), "root": cases(["retail", "industry", "geographic", "retail"]), "country": cases(["DE", None, "NL"]), "status": cases(["open", None, "permanently_closed"], "(doc_id + 1)"), "region": cases(["DE-HB", "NL-1", None], "(doc_id + 2)")}
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), (F.col("doc_id") % 10 / F.lit(10.0)).alias("confidence"), *[F.expr(v).alias(k) for k, v in made.items()])
    return sources.taxonomy_rows(d, {"bakery": "shop", "plant": "industrial", "retail": "shop", "industry": "industrial"}, ["geographic"], 0.5, ["DE-HB"]).select("id", "business_type", "state")


def lei_rows(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", F.expr(cases(["DE", "NL", "DE"], "c_nationkey")).alias("country"))
    return sources.lei_rows(c, "DE", "20240131-0000-golden-copy.csv.zip").select("c_custkey", "snapshot_date")


def admin_levels(spark, sf_dir):
    """The first state and district that hold each company."""
    ring = lambda w, s, e, t: [(w, s), (e, s), (e, t), (w, t)]
    schema = "ring array<struct<x:double,y:double>>, place long, name string"
    states = spark.createDataFrame([(ring(8.0, 53.0, 8.6, 54.2), 0, "W"), (ring(8.4, 53.0, 9.2, 54.2), 1, "E")], schema)
    districts = spark.createDataFrame([(ring(8.0, 53.0, 8.3, 53.5), 0, "w1"), (ring(8.2, 53.1, 8.9, 53.7), 1, "m")], schema)
    points = companies(spark, sf_dir).select(F.col("doc_id").alias("id"), (F.col("longitude") + 0.0003).alias("x"), (F.col("latitude") + 0.00003).alias("y"))
    return sources.first_holder(points, [states, districts], 0.25).select("id", F.col("level_0").alias("state"), F.col("level_1").alias("district"))


QUERIES = {
    f.__name__: f
    for f in (
        unit_floors, unit_positions, unit_sites, storage_fill, grid_layer, legal_operators, report_rows, heat_site_totals, potential_rows, register_build, name_variants,
        tag_rows, taxonomy_rows, lei_rows, admin_levels,
    )
}

_V = lambda s: s.replace("AS string)", "AS VARCHAR)")
_U = _V(f"""u AS (SELECT {UNIT} AS unit, {PLACE} AS place, {TECH} AS tech, {STATUS} AS status, {KW} AS kw, l_suppkey % 20 AS operator, CASE WHEN l_linenumber % 3 = 1 THEN 'Park ' || l_linenumber END AS name,
  CASE WHEN l_partkey % 4 > 0 THEN 50.0::DOUBLE + l_partkey % 8 END AS lat, CASE WHEN l_partkey % 4 > 0 THEN 8.0::DOUBLE + l_partkey % 16 END AS lon, 'D' || (l_suppkey % 4) AS district FROM lineitem)""")
_KEPT = "kept AS (SELECT * FROM u WHERE (status IN ('In Betrieb', '35') OR tech = 'nuclear') AND (CASE tech WHEN 'wind' THEN kw >= 50 WHEN 'solar' THEN kw >= 100 WHEN 'storage' THEN kw >= 100 ELSE true END))"
_BOX = "sqrt(pow(greatest({w} - lon, 0, lon - {e}) * cos(radians(lat)) * 111320, 2) + pow(greatest({s} - lat, 0, lat - {t}) * 110540, 2)) > 10000"
_WHY = f"CASE WHEN lon IS NULL THEN NULL WHEN lat < 45 OR lat > 56 OR lon < 4 OR lon > 17 THEN 'bounds' WHEN district = 'D0' AND {_BOX.format(w=8.0, e=14.0, s=50.0, t=53.0)} THEN 'district' WHEN district = 'D1' AND {_BOX.format(w=8.0, e=11.95, s=52.0, t=56.0)} THEN 'district' END"
_M = "floor({0} * 1000 + 0.5)::BIGINT"
_FN = _V(FORM_NAME)
_FORM = "CASE o_orderkey % 4 WHEN 0 THEN 'GmbH' WHEN 1 THEN 'AG' WHEN 2 THEN 'GmbH' END"
_PICK = lambda name, *cols: f"{name} AS (SELECT o_custkey AS company, {', '.join(cols)} FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY "
_NOW = f"""{_PICK('nm', f'{_FN} AS name', f'{_FORM} AS form')} o_orderkey % 5 = 0 DESC, strftime(o_orderdate, '%Y-%m-%d') DESC, o_orderkey DESC) = 1),
 pv AS (SELECT company, string_agg(DISTINCT {_FN}, ' | ' ORDER BY {_FN}) AS previous_names FROM orders JOIN nm ON o_custkey = company WHERE {_FN} <> name GROUP BY 1),
 ad AS (SELECT o_custkey AS company, o_orderkey % 3 AS a, o_orderkey % 2 AS z FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey % 4 = 0 DESC, strftime(o_orderdate, '%Y-%m-%d') DESC, o_orderkey DESC) = 1),
 rf AS (SELECT o_custkey AS company, o_orderkey AS k, {cases(['Bremen', 'Oldenburg'], 'o_orderkey')} AS court FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey % 3 = 0 DESC, strftime(o_orderdate, '%Y-%m-%d') DESC, o_orderkey DESC) = 1)"""

ORACLE_SQL = {
    "unit_floors": f"WITH {_U}, {_KEPT} SELECT tech, count(*)::BIGINT AS units, sum(kw)::BIGINT AS kw FROM kept GROUP BY 1",
    "unit_positions": f"WITH {_U}, w AS (SELECT *, {_WHY} AS dropped FROM u) SELECT district, dropped, count(*)::BIGINT AS n, count(lat) FILTER (WHERE dropped IS NULL)::BIGINT AS placed FROM w GROUP BY 1, 2",
    "unit_sites": f"""WITH {_U}, {_KEPT}, w AS (SELECT *, {_WHY} AS dropped, coalesce(place, unit) AS p FROM kept), t AS (
  SELECT operator, p, tech, '"' || tech || '":[' || string_agg('{{"unit":"' || unit || '","kw":' || kw || '}}', ',' ORDER BY unit, kw) || ']' AS j FROM w GROUP BY operator, p, tech
), d AS (SELECT operator, p, '{{' || string_agg(j, ',' ORDER BY tech) || '}}' AS detail, string_agg(tech, '+' ORDER BY tech) AS techs, bool_and(tech IN ('gas_consumption', 'electricity_consumption')) AS consumer_only FROM t GROUP BY operator, p), g AS (
  SELECT operator, p, count(*)::BIGINT AS units, arg_min(name, unit) FILTER (WHERE name IS NOT NULL) AS name, {_M.format("avg(CASE WHEN dropped IS NULL THEN lat END)")} AS lat, {_M.format("avg(CASE WHEN dropped IS NULL THEN lon END)")} AS lon, count(dropped)::BIGINT AS coord_dropped FROM w GROUP BY operator, p
) SELECT operator, p AS place, techs, consumer_only, units, md5(detail) AS detail_md5, name, lat, lon, coord_dropped FROM d JOIN g USING (operator, p)""",
    "storage_fill": "WITH q AS (SELECT 'S' || (p_partkey % 60 + 10) AS plant, arg_min(p_size::BIGINT * 100, p_partkey) AS own FROM part WHERE p_partkey % 2 = 0 GROUP BY 1) SELECT p_partkey AS unit, 'S' || (p_partkey % 50) AS plant, coalesce(CASE WHEN p_partkey % 3 = 0 THEN p_size::BIGINT END, own) AS capacity FROM part LEFT JOIN q ON q.plant = 'S' || (p_partkey % 50)",
    "grid_layer": f"WITH {_U}, m AS (SELECT place, avg(lat) AS lat, avg(lon) AS lon FROM u WHERE tech IN ('wind', 'solar', 'storage') AND lon IS NOT NULL AND place IS NOT NULL GROUP BY 1) SELECT c_custkey AS id, place, {_M.format('lat')} AS lat, {_M.format('lon')} AS lon, n_name AS grid_name FROM customer JOIN m ON place = 'L' || (c_custkey % 60) LEFT JOIN nation ON n_nationkey = c_nationkey AND n_nationkey % 3 > 0",
    "legal_operators": f"SELECT s_suppkey, s_name AS name, {cases(['Natürliche Person', 'Juristische Person', None], 's_suppkey')} AS person FROM supplier WHERE s_suppkey % 7 > 0 AND s_suppkey % 3 > 0",
    "report_rows": "SELECT o_orderkey, year(o_orderdate)::BIGINT AS year FROM orders WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders) AND o_orderkey % 2 = 0 AND o_custkey % 3 <> 1",
    "heat_site_totals": f"""WITH r AS (SELECT l_suppkey % 15 AS uid, lower(trim({cases([' Am Kai ', 'am kai', 'Werkstr. 2'], 'l_partkey')})) AS street, l_orderkey * 10 + l_linenumber AS row, CASE WHEN l_linenumber = 3 THEN 'a@b.de' END AS email,
  CASE WHEN l_partkey % 6 > 0 THEN 'Ofen ' || (l_partkey % 9) END AS pot, CASE WHEN l_suppkey % 15 > 1 THEN floor(l_quantity)::BIGINT END AS heat, floor(l_quantity * 2)::BIGINT AS power, CASE WHEN l_linenumber % 2 = 0 THEN floor(l_discount * 1000)::BIGINT END AS t FROM lineitem
), k AS (SELECT *, uid || '|' || street || '|28195' AS key FROM r), n AS (SELECT key, pot, min(row) AS at_row FROM k WHERE pot IS NOT NULL GROUP BY ALL), nn AS (SELECT key, array_to_string((list(pot ORDER BY at_row))[1:5], '|') AS names FROM n GROUP BY 1), s AS (
  SELECT key, 'Firma ' || min(uid) AS name, max(email) AS email, sum(heat)::BIGINT AS heat, sum(power)::BIGINT AS power, coalesce(sum(heat * t) FILTER (WHERE heat > 0 AND t IS NOT NULL)::DOUBLE / sum(heat) FILTER (WHERE heat > 0 AND t IS NOT NULL), avg(t)) AS t, count(*)::BIGINT AS potentials FROM k GROUP BY 1
) SELECT key, name, email, heat, power, {_M.format('t')} AS temperature, potentials, coalesce(names, '') AS potential_names FROM s LEFT JOIN nn USING (key)""",
    "potential_rows": f"SELECT 'abw_' || (doc_id % 9) || '_' || substr(md5('am kai|' || trim({cases(['1', ' 2 '])})), 1, 8) AS site_id, (doc_id % 9)::DOUBLE AS uid, try_cast({cases(['12', 'n/a', ' 7.5', '', None])} AS DOUBLE) AS heat, CASE WHEN doc_id % 5 = 0 THEN 'Ofen' END AS potential, trim({cases(['1', ' 2 '])}) AS postcode FROM documents",
    "register_build": f"""WITH {_NOW} SELECT c_custkey AS company, name, previous_names, CASE a WHEN 0 THEN 'Am Kai' WHEN 1 THEN 'Hauptstr' END AS street, CASE a WHEN 0 THEN '12 a' END AS housenumber, CASE z WHEN 0 THEN '28195' END AS postcode,
  CASE WHEN a = 0 AND z = 0 THEN 'Bremen' WHEN a = 0 THEN '28195 Bremen' WHEN a = 1 THEN 'Hamburg' END AS city, court,
  CASE k % 3 WHEN 0 THEN 'HRB ' || k || ' HB' WHEN 1 THEN 'HRA ' || k || ' HB' END AS hr_registration, coalesce(CASE k % 3 WHEN 0 THEN 'HRB' WHEN 1 THEN 'HRA' END, CASE WHEN form IS NOT NULL THEN 'HRB' END) AS register_division, form AS legal_form,
  CASE WHEN c_custkey % 4 = 0 THEN 'dissolved' ELSE 'active' END AS status, coalesce({name_key_sql('name')}, '') AS key_full, CASE a WHEN 0 THEN 'am kai 12a' WHEN 1 THEN 'hauptstrasse' ELSE '' END AS street_key
  FROM customer LEFT JOIN nm ON nm.company = c_custkey LEFT JOIN pv ON pv.company = c_custkey LEFT JOIN ad ON ad.company = c_custkey LEFT JOIN rf ON rf.company = c_custkey""",
    "name_variants": f"WITH {_NOW}, v AS (SELECT company, name, true AS current FROM nm JOIN customer ON c_custkey = company UNION ALL SELECT o_custkey, {_FN}, false FROM orders JOIN customer ON c_custkey = o_custkey), k AS (SELECT *, {name_key_sql('name')} AS key_full, {name_key_sql('name', False)} AS key_light FROM v) SELECT company, key_full, key_light, name, current FROM k QUALIFY row_number() OVER (PARTITION BY company, key_full, key_light ORDER BY current DESC, name) = 1",
    "tag_rows": "SELECT 'osm_node/' || doc_id AS id, CASE doc_id % 5 WHEN 2 THEN 'x' END AS name, CASE doc_id % 5 WHEN 0 THEN 'office' WHEN 1 THEN 'industrial' WHEN 3 THEN 'shop' ELSE 'man_made' END AS business_type, CASE doc_id % 5 WHEN 0 THEN 'company' WHEN 1 THEN 'factory' WHEN 3 THEN ' bakery' ELSE 'works' END AS business_subtype, CASE doc_id % 5 WHEN 3 THEN '12' WHEN 4 THEN '3' END AS phone FROM documents WHERE doc_id % 5 <> 2",
    "taxonomy_rows": "SELECT doc_id AS id, CASE doc_id % 5 WHEN 0 THEN 'shop' WHEN 1 THEN 'industrial' ELSE CASE WHEN doc_id % 4 IN (0, 3) THEN 'shop' WHEN doc_id % 4 = 1 THEN 'industrial' END END AS business_type, CASE WHEN (doc_id + 2) % 3 = 0 THEN 'DE-HB' END AS state FROM documents WHERE doc_id % 4 IN (0, 3) AND doc_id % 10 >= 5 AND doc_id % 3 < 2 AND (doc_id + 1) % 3 < 2 AND doc_id % 4 <> 2",
    "lei_rows": "SELECT c_custkey, '2024-01-31' AS snapshot_date FROM customer WHERE c_nationkey % 3 <> 1",
    "admin_levels": f"WITH {COMPANIES_SQL}, p AS (SELECT doc_id AS id, longitude + 0.0003::DOUBLE AS x, latitude + 0.00003::DOUBLE AS y FROM co) SELECT id, CASE WHEN x < 8.6 AND y < 54.2 THEN 'W' WHEN x < 9.2 AND y < 54.2 THEN 'E' END AS state, CASE WHEN x < 8.3 AND y < 53.5 THEN 'w1' WHEN x > 8.2 AND x < 8.9 AND y > 53.1 AND y < 53.7 THEN 'm' END AS district FROM p",
}
