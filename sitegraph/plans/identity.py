"""Queries of ids, labels and fields of source records. Inputs are texts chosen by a row's number, written
once as an expression that both engines read."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import constants as C
from ..functions import record as R
from ..functions import text as T
from .adapter import table


def cases(values: list[str | None], by: str = "doc_id") -> str:
    """CASE over the remainder of a number: an SQL text that Spark and DuckDB read alike."""
    arms = " ".join(f"WHEN {i} THEN " + ("NULL" if v is None else "'" + v.replace("'", "''") + "'") for i, v in enumerate(values))
    return f"(CASE {by} % {len(values)} {arms} END)"


STREET = cases(["Am Kai", "  HAUPTSTR. ", "Werkstraße", None, "a|b"])
NUMBER = cases(["1", " 12 a", None, ""])
POSTCODE = cases(["28195", "01001", None, " 99998 "])
CITY = cases(["Bremen", None, "  ", "Bad Zwischenahn"])
URL = cases(["https://registry.gdi-de.org/id/de.sh/50000083_515_0", "https://registry.gdi-de.org/id/de.hb/de.hb.pf/2000058/0/", "http://other.org/id/7", "plain/9", "https://registry.gdi-de.org/id/x//"])
TAGS = cases(['{"wikidata":" Q12 ;Q13","brand:wikidata":"q5"}', '{"operator:wikidata":"Q77","wikidata":"Q1x"}', '{"brand:wikidata":"Q9;Q8"}', '{"name":"x"}', '{"wikidata":"","operator:wikidata":";Q3"}'])
POINT = cases(["Point(8.8 53.08)", "point( -1.5   2.25 )", "Point(8)", None, "POINT(9.99 50)", "x Point(1 2)"])
ACTIVITY = cases(["6.4(b)(ii)", "6.4(b)", "1.1", "6.6(a)", " 5.3 ", None, "9.9", "", "4.1(a)(i)"])
HEAT = cases(["12", "999.9", "1000", "9999.99", "100000", "99999", "x", None])
SECTION = cases(["Abschnitt C – Verarbeitendes Gewerbe", "Abschnitt D – Energieversorgung", "Abschnitt G – Handel", "Baugewerbe", "Abschnitt S – Sonstiges", "nichts", None, "Abschnitt E – Wasserversorgung; Handel"])
MATCH = cases(["name_plz", "ambiguous", "none", "n/a", "", None, "exact_hrb"])
STATUS = cases(["active", "dissolved", "unknown", None])
TECHS = cases(["solar+wind", "", None, "+storage+", "a++b"])
PLACE_TAGS = cases(['{"office":"company","shop":"no"}', '{"shop":"vacant","craft":" ","industrial":"factory"}', '{"name":"x"}', '{"shop":" bakery","phone":"","contact:phone":" 12 "}', '{"amenity":"no","man_made":"works","phone":"3"}'])
LABELS = {"6.4": "Nahrung", "6.4(b)": "Lebensmittel", "1.1": "Feuerung", "4.1(a)": "Kohlenwasserstoffe"}
KINDS, NEVER, PHONES = ["office", "shop", "craft", "industrial", "amenity", "man_made"], ["no", "vacant"], ["phone", "contact:phone"]


def _docs(spark, sf_dir, **made):
    return table(spark, sf_dir, "documents").select("doc_id", *[F.expr(v).alias(k) for k, v in made.items()])


def site_ids(spark, sf_dir):
    d = _docs(spark, sf_dir, street=STREET, postcode=POSTCODE)
    return d.select("doc_id", R.site_id(F.col("doc_id") % 50, F.coalesce("street", F.lit("")), F.coalesce("postcode", F.lit(""))).alias("site_id"))


def registry_ids(spark, sf_dir):
    return _docs(spark, sf_dir, url=URL).select("doc_id", R.registry_id(F.col("url")).alias("id"))


def item_ids(spark, sf_dir):
    """Items named by a row's tags: the thing itself, its operator, its brand (else another source's)."""
    d = _docs(spark, sf_dir, tags=TAGS, other=cases(["Q100", "x", None]))
    brand = F.coalesce(R.item_id(F.col("tags"), "brand:wikidata"), F.when(F.col("other").rlike(r"^Q\d+$"), F.col("other")))
    return d.select("doc_id", R.item_id(F.col("tags"), "wikidata").alias("wd_id"), R.item_id(F.col("tags"), "operator:wikidata").alias("wd_operator_id"), brand.alias("wd_brand_id"))


def item_points(spark, sf_dir):
    return _docs(spark, sf_dir, p=POINT).select("doc_id", R.point_of(F.col("p")).alias("at")).select("doc_id", "at.lon", "at.lat")


def row_classes(spark, sf_dir):
    d = _docs(spark, sf_dir, match=MATCH, status=STATUS, techs=TECHS, entity=cases(["Q1", None, ""]), operator=cases([None, "Q2"]), origin=cases(["wikidata", "extract", None]))
    links = R.item_links(F.col("entity"), F.col("operator"), F.lit(None).cast("string"), F.col("origin"))
    return d.select("doc_id", R.register_class(F.col("match"), F.col("status")).alias("register"), links.alias("links"), R.delimited(F.split("techs", r"\+")).alias("techs"))


def activity_classes(spark, sf_dir):
    d = _docs(spark, sf_dir, code=ACTIVITY, heat=HEAT)
    return d.select("doc_id", R.activity_group(F.col("code")).alias("activity"), R.probed_label(F.col("code"), LABELS).alias("label"), R.heat_band(F.col("heat")).alias("band"))


def section_types(spark, sf_dir):
    return _docs(spark, sf_dir, s=SECTION).select("doc_id", R.section_type(F.col("s")).alias("business_type"), R.label_key(F.col("s")).alias("key"))


def address_lines(spark, sf_dir):
    d = _docs(spark, sf_dir, s=STREET, n=NUMBER, p=POSTCODE, c=CITY)
    line = R.address_line(F.col("s"), F.col("n"), F.col("p"), F.col("c"))
    return d.select("doc_id", line.alias("line"), R.cache_key(F.col("s"), F.col("p"), F.col("c")).alias("key"), R.slug(line).alias("slug"))


def tag_values(spark, sf_dir):
    d = _docs(spark, sf_dir, t=PLACE_TAGS).withColumn("m", F.from_json("t", "map<string,string>"))
    return d.select("doc_id", R.business_kind(F.col("m"), KINDS, NEVER).alias("b"), R.first_tag(F.col("m"), PHONES).alias("phone")).select("doc_id", "b.kind", "b.value", "phone")


FORM_NAMES = cases([
    "Müller GmbH & Co. KG", "Nord g.G.m.b.H.", "Beispiel KGaA", "Muster UG (haftungsbeschränkt)", "Hafen AG", "Euro SE", "Alt OHG", "Neu KG", "Kauf e.K.",
    "Acker eG", "Verein Nord e.V.", "Stiftung Meer", "Weber GbR", "Zweckverband Abwasser", "Import Ltd.", "Ohne Form", "Acme, Inc.", "Werk G.m.b.H.", "VVaG Nord", "Kanzlei PartG",
])
FORMS_WANTED = [
    "GmbH & Co. KG/HRA", "gGmbH/HRB", "KGaA/HRB", "UG (haftungsbeschränkt)/HRB", "AG/HRB", "SE/HRB", "OHG/HRA", "KG/HRA", "e.K./HRA",
    "eG/GnR", "e.V./VR", "Stiftung/", "GbR/", "Körperschaft/Anstalt öR/", "foreign/", "/", "foreign/", "GmbH/HRB", "VVaG/HRB", "PartG/PR",
]


def form_labels(spark, sf_dir):
    """The legal form of a name and its register, for a name of every kind."""
    d = _docs(spark, sf_dir, name=FORM_NAMES).select("doc_id", T.legal_form(F.col("name")).alias("f"))
    return d.select("doc_id", F.concat(F.coalesce("f.form", F.lit("")), F.lit("/"), F.coalesce("f.division", F.lit(""))).alias("form"))


QUERIES = {f.__name__: f for f in (site_ids, registry_ids, item_ids, item_points, row_classes, activity_classes, section_types, address_lines, tag_values, form_labels)}

_QID = "CASE WHEN regexp_full_match(trim(string_split(trim(json_extract_string({t}, '$.\"{k}\"')), ';')[1]), 'Q[0-9]+') THEN trim(string_split(trim(json_extract_string({t}, '$.\"{k}\"')), ';')[1]) END"
_SOME = "nullif(trim({0}), '')"
_LINE = "nullif(concat_ws(', ', nullif(concat_ws(' ', nullif(trim(s), ''), nullif(trim(n), '')), ''), nullif(concat_ws(' ', nullif(trim(p), ''), nullif(trim(c), '')), '')), '')"
_PLAIN = "trim(regexp_replace(lower(coalesce({0}, '')), '\\s+', ' ', 'g'))"
_SEC = " ".join(f"WHEN contains(lower(s), '{w}') THEN '{k}'" for w, k in C.SECTION_TYPES)
_LAB = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in LABELS.items()) + "}"
_TAG = "json_extract_string(t, '$.\"{0}\"')"
_KIND = " ".join(f"WHEN trim(coalesce({_TAG.format(k)}, '')) <> '' AND {_TAG.format(k)} NOT IN ('no', 'vacant') THEN {{{'{'}kind': '{k}', 'value': {_TAG.format(k)}{'}'}}}" for k in KINDS).replace("{{", "{").replace("}}", "}").replace("{kind'", "{'kind'")

ORACLE_SQL = {
    "site_ids": f"SELECT doc_id, 'abw_' || (doc_id % 50) || '_' || substr(md5(lower(coalesce({STREET}, '') || '|' || coalesce({POSTCODE}, ''))), 1, 8) AS site_id FROM documents",
    "registry_ids": f"WITH u AS (SELECT doc_id, rtrim({URL}, '/') AS u FROM documents) SELECT doc_id, 'ied_' || CASE WHEN starts_with(u, 'https://registry.gdi-de.org/id/') THEN substr(u, 32) ELSE list_last(string_split(u, '://')) END AS id FROM u",
    "item_ids": f"WITH d AS (SELECT doc_id, {TAGS} AS t, {cases(['Q100', 'x', None])} AS o FROM documents) SELECT doc_id, {_QID.format(t='t', k='wikidata')} AS wd_id, {_QID.format(t='t', k='operator:wikidata')} AS wd_operator_id, coalesce({_QID.format(t='t', k='brand:wikidata')}, CASE WHEN regexp_full_match(o, 'Q[0-9]+') THEN o END) AS wd_brand_id FROM d",
    "item_points": f"WITH d AS (SELECT doc_id, regexp_extract(lower({POINT}), '^point\\(\\s*(-?[0-9.]+)\\s+(-?[0-9.]+)\\s*\\)', ['a', 'b']) AS m FROM documents) SELECT doc_id, try_cast(m.a AS DOUBLE) AS lon, try_cast(m.b AS DOUBLE) AS lat FROM d",
    "row_classes": f"WITH d AS (SELECT doc_id, {MATCH} AS m, {STATUS} AS s, {TECHS} AS t, {cases(['Q1', None, ''])} AS e, {cases([None, 'Q2'])} AS o, {cases(['wikidata', 'extract', None])} AS w FROM documents), l AS (SELECT *, concat_ws('+', CASE WHEN e <> '' THEN 'e' END, CASE WHEN o <> '' THEN 'o' END, CASE WHEN w = 'wikidata' THEN 'w' END) AS k, array_to_string(list_filter(string_split(t, '+'), lambda x: x <> ''), '+') AS u FROM d) SELECT doc_id, CASE WHEN m IN ('ambiguous', 'none') THEN m WHEN m IS NULL OR m IN ('', 'n/a') THEN NULL WHEN s = 'dissolved' THEN 'matched_dissolved' ELSE 'matched_active' END AS register, CASE WHEN k <> '' THEN '+' || k || '+' END AS links, CASE WHEN u <> '' THEN '+' || u || '+' END AS techs FROM l",
    "activity_classes": f"WITH d AS (SELECT doc_id, nullif(trim({ACTIVITY}), '') AS c, try_cast({HEAT} AS DOUBLE) AS h, {_LAB} AS l FROM documents), p AS (SELECT *, [c, regexp_extract(c, '^([^(]*\\([^(]*)', 1), regexp_extract(c, '^([^(]*)', 1)] AS probes FROM d) SELECT doc_id, CASE WHEN c LIKE '6.6%' THEN 'livestock' ELSE (MAP {{'1': 'energy', '2': 'metals', '3': 'minerals', '4': 'chemicals', '5': 'waste', '6': 'other'}})[c[1]] END AS activity, CASE WHEN c IS NULL THEN NULL WHEN l[probes[1]] IS NOT NULL THEN c || ' – ' || l[probes[1]] WHEN l[probes[2]] IS NOT NULL THEN c || ' – ' || l[probes[2]] WHEN l[probes[3]] IS NOT NULL THEN c || ' – ' || l[probes[3]] ELSE c END AS label, CASE WHEN h IS NULL THEN NULL WHEN h < 1000 THEN '< 1 GWh/a' WHEN h < 10000 THEN '1–10 GWh/a' WHEN h < 100000 THEN '10–100 GWh/a' ELSE '> 100 GWh/a' END AS band FROM p",
    "section_types": f"WITH d AS (SELECT doc_id, {SECTION} AS s FROM documents) SELECT doc_id, CASE {_SEC} END AS business_type, trim(regexp_replace(replace(lower(s), '–', '-'), '[^\\p{{L}}\\p{{N}}_]+', ' ', 'g')) AS key FROM d",
    "address_lines": f"WITH d AS (SELECT doc_id, {STREET} AS s, {NUMBER} AS n, {POSTCODE} AS p, {CITY} AS c FROM documents), l AS (SELECT *, {_LINE} AS line FROM d) SELECT doc_id, line, {_PLAIN.format('s')} || '|' || {_PLAIN.format('p')} || '|' || {_PLAIN.format('c')} AS key, regexp_replace(line, '[^A-Za-z0-9ÄÖÜäöüß_-]+', '-', 'g') AS slug FROM l",
    "tag_values": f"WITH d AS (SELECT doc_id, {PLACE_TAGS} AS t FROM documents), k AS (SELECT *, CASE {_KIND} END AS b FROM d) SELECT doc_id, b.kind AS kind, b.value AS value, coalesce({_SOME.format(_TAG.format('phone'))}, {_SOME.format(_TAG.format('contact:phone'))}) AS phone FROM k",
    "form_labels": f"SELECT doc_id, {cases(FORMS_WANTED)} AS form FROM documents",
}
