"""Queries of website hygiene, imprint texts and the discovery of sites."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import constants as C
from ..functions import site as S
from ..functions.text import legal_form, name_key
from ..functions.url import listed, plain_host
from ..operators import discovery, hygiene, ranker
from ..sources import remote
from .adapter import COMPANIES_SQL, companies, name_key_sql, table
from .identity import cases
from .staging import shared_folder, staged

DIRECTORIES, CHAINS = ["gelbeseiten.de", "google.com"], ["drk.de"]
SITE = (
    "(CASE doc_id % 10 WHEN 0 THEN 'https://www.gelbeseiten.de/x' WHEN 1 THEN 'https://maps.google.com/?q=1' WHEN 2 THEN 'http://sites.google.com/b'"
    " WHEN 3 THEN 'https://facebook.com/a' WHEN 4 THEN concat('https://filiale', cast(doc_id % 3 AS string), '.drk.de/') WHEN 5 THEN 'https://shop.stadt-kette.de/'"
    " WHEN 6 THEN 'https://verzeichnis.org/e' WHEN 7 THEN concat('https://firma', cast(doc_id AS string), '.de') WHEN 8 THEN 'https://paketshop.myhermes.de' END)"
)
ROW_NAME = "(CASE WHEN doc_id % 10 = 5 THEN concat('Stadt-Kette Filiale ', cast(doc_id % 4 AS string)) ELSE concat('Eintrag ', cast(doc_id AS string)) END)"


def _kinds(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.expr(ROW_NAME).alias("name"), plain_host(F.expr(SITE)).alias("host"))
    return hygiene.host_kinds(rows, hygiene.Seeds(directory=DIRECTORIES, chain=CHAINS))


def host_kinds(spark, sf_dir):
    return _kinds(spark, sf_dir).select("id", "host", "kind")


def hygiene_report(spark, sf_dir):
    """How many rows each kind has, and the first hosts of the learned kinds."""
    k = _kinds(spark, sf_dir)
    counts = k.groupBy(F.coalesce("kind", F.lit("none")).alias("kind")).agg(F.count("*").alias("n")).select(F.lit("kind").alias("what"), "kind", F.lit("").alias("host"), "n")
    return counts.unionByName(hygiene.top_hosts(k, 2).select(F.lit("top").alias("what"), "kind", "host", "n"))


LISTED = cases(["maps.google.com", "sites.google.com", "de.wikipedia.org", "x.com", "a.b.x.com", "firma.de", "myhermes.de", "notx.com"])


def listed_hosts(spark, sf_dir):
    """Hosts in a list or below one, and those that a search leaves out."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.expr(LISTED).alias("h"))
    lists = C.SOCIAL_HOSTS + C.PARCEL_HOSTS
    return d.select("doc_id", listed(F.col("h"), [*lists, "google.com"], C.OWN_HOSTS).alias("below"), S.listed_host(F.col("h"), lists).alias("skipped"))


def page_texts(spark, sf_dir):
    t = S.page_text(F.col("html"))
    return table(spark, sf_dir, "pages").select("page_id", F.md5(t).alias("text_md5"), F.size(F.split(t, "\n")).cast("long").alias("lines"), F.array_join(S.postcodes(t), ",").alias("postcodes"))


IMPRINTS = [
    "Nord GmbH | Am Kai 1 | 28195 Bremen | Amtsgericht Bremen HRB 1234 | USt-IdNr. DE 123 456 789",
    "Registergericht: Hamburg, HRA Nr. 98.765, 20095 Hamburg",
    "Tel. 0421/12345 Fax 28195-2",
    "Handelsregister Oldenburg HRB: 202125 OL 26122 Oldenburg",
    "PLZ 00999 Nirgendwo, DE1234567890",
    "Genossenschaft GnR 17 beim Amtsgericht Walsrode",
]
#: court, VAT id, postcode, city, type, number and score of each, as read by eye.
IMPRINTS_READ = [
    "Bremen;DE123456789;28195;Bremen;HRB;1234;100", "Hamburg;;20095;Hamburg;HRA;98765;80", ";;;;;;0", "Oldenburg;;26122;Oldenburg;HRB;202125;80", ";;;;;;0", "Walsrode;;;;GnR;17;40",
]


def imprint_fields(spark, sf_dir):
    f = S.imprint_fields(F.expr(cases(IMPRINTS)))
    d = table(spark, sf_dir, "documents").select("doc_id", f.alias("f"))
    keys = ["court", "vat_id", "postcode", "city", "register_type", "register_no"]
    return d.select("doc_id", F.concat_ws(";", *[F.coalesce(F.col(f"f.{k}"), F.lit("")) for k in keys], F.col("f.score").cast("string")).alias("fields"))


LINK_PAGES = [
    '<a href="/kontakt">Kontakt</a> <a href="/ueber/impressum.html#top">Über uns</a>',
    '<a class=x href="https://www.other.org/impressum">Impressum</a><a href="mailto:a@b.de">Impressum</a>',
    "<a href='legal-notice?a=1&amp;b=2'><b>Notice</b></a><a href=\"//sub.firma.de/imprint\">i</a>",
    "<p>nothing</p>",
    '<a href="/a/impressum">x</a><a href="/impressum">y</a><a href="/impressum">z</a>',
]
LINKS_READ = [
    "https://www.firma.de/ueber/impressum.html https://www.firma.de/kontakt", "", "https://sub.firma.de/imprint https://www.firma.de/x/legal-notice?a=1&b=2", "",
    "https://www.firma.de/impressum https://www.firma.de/a/impressum",
]


def imprint_links(spark, sf_dir):
    links = S.imprint_links(F.expr(cases(LINK_PAGES)), F.lit("https://www.firma.de/x/seite?q=1"))
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(links, " ").alias("links"))


FIRM = cases(["Seehafen Umschlag GmbH", "Kiosk Müller", "TX Logistik AG", "Windkraft Nordsee GmbH & Co. KG", None, "Hafen 24", "Reederei Hansen Söhne OHG", "Umspannwerk Nord", "Farge", "Acme Pumpenbau e.K."])
PLACES = ["farge", "bremen nord"]


def name_searches(spark, sf_dir):
    """What of a name can be searched for, hosts guessed from it, or why it is left out."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.expr(FIRM).alias("n"))
    place = name_key(F.col("n")).isin(PLACES) | F.array_join(S.distinctive(F.col("n")), " ").isin(PLACES)
    return d.select(
        "doc_id", F.array_join(S.name_tokens(F.col("n")), " ").alias("tokens"), S.skip_reason(F.col("n"), place).alias("skipped"),
        F.array_join(S.domain_guesses(F.col("n"), F.lit(None).cast("string")), " ").alias("guesses"),
    )


SAID, OWN_CODE, CODE = cases(["ok", "ok_redirected", "dead", None, "parked", "ok", "ok"]), cases(["28195", None, "1"]), cases(["28195", " 28195 ", None, "27000"])
TOKENS = cases(["seehafen umschlag", "mueller", "windkraft", "reederei hansen soehne", "", "acme pumpenbau", "tx"], "(doc_id + 3)")


def site_verdicts(spark, sf_dir):
    """Whether a row's site names it and its postcode."""
    d = table(spark, sf_dir, "documents").select("doc_id", *[F.expr(v).alias(k) for k, v in {"n": FIRM, "s": SAID, "o": OWN_CODE, "c": CODE, "t": TOKENS}.items()])
    v = S.verdict(F.col("s"), S.words(F.col("t")), F.col("o"), F.array(F.lit("27000")), F.col("n"), F.col("c"))
    text, final = F.concat(F.col("t"), F.lit(" 28195 bremen")), F.when(F.col("doc_id") % 3 == 0, "www.neu.org").otherwise("a.alt.de")
    page = S.verified(final, F.lit("alt.de"), text, F.col("n"), F.col("c"), F.lit("Bremen"))
    return d.select("doc_id", v.alias("verdict"), page.alias("page"))


LEGAL = cases(["Seehafen Umschlag GmbH", None, "Hafen Verein e.V.", "Acme Pumpenbau Service e.K.", "Reederei Hansen OHG"])
LABEL = cases(["seehafenumschlag", "reederei-hansen-soehne", "acme", "windkraftnordsee"], "(doc_id + 1)")


def discovery_accept(spark, sf_dir):
    """Whether a site that was found by search is taken for a company's own."""
    d = table(spark, sf_dir, "documents").select("doc_id", *[F.expr(v).alias(k) for k, v in {"n": FIRM, "l": LEGAL, "b": LABEL, "v": cases(["name", "name+plz", "plz", "name", "name"])}.items()])
    ok = S.accepted(F.col("v"), F.col("n"), F.col("b"), F.col("l"), legal_form(F.col("l"))["division"])
    return d.select("doc_id", F.coalesce(ok, F.lit(False)).alias("accepted"))


def search_queries(spark, sf_dir):
    """The queries asked for each company, and whether an answer is about them."""
    d = table(spark, sf_dir, "documents").select("doc_id", *[F.expr(v).alias(k) for k, v in {"n": FIRM, "l": LEGAL, "c": cases(["Bremen", None, " "]), "s": cases(["Am Kai 1", ""])}.items()])
    q = S.search_queries(F.col("n"), F.col("l"), F.col("c"), F.lit("Kreis Süd"), F.col("s"))
    texts = F.when(F.col("doc_id") % 4 == 0, F.array().cast("array<string>")).otherwise(F.array(F.lit("https://currenttime.now Die Zeit"), F.when(F.col("doc_id") % 4 == 1, "Seehafen GmbH und Reederei").otherwise("Bremen")))
    return d.select("doc_id", F.array_join(q, " | ").alias("queries"), S.relevant(F.coalesce("n", F.lit("")), texts, ["bremen"]).alias("relevant"))


def label_candidates(spark, sf_dir):
    """Existing labels for each company's name; the labels are other companies' names with endings."""
    c = companies(spark, sf_dir)
    rows = c.select("id", F.concat(F.col("name"), F.lit(" Seehafen")).alias("name"), F.lit(None).cast("string").alias("form"), F.lit("Bremen").alias("city"))
    base = F.replace(name_key(F.col("name")), F.lit(" "), F.lit(""))
    end = F.expr(cases(["seehafen", "seehafen-gmbh", "-bremen", "24", "werkstoff", "seehafenundnochetwasmehr"], "(doc_id + 2)"))
    return discovery.label_candidates(rows, c.select(F.concat(base, end).alias("label")))


def _hits(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    c = companies(spark, sf_dir).select("doc_id", "name", "city", "postcode", "street").withColumnRenamed("name", "firm")
    p = p.select((F.col("page_id") % 20).alias("id"), "page_id", F.regexp_replace("url", r"\.example\.com", ".de").alias("url"), (F.col("page_id") % 3).alias("query"), (F.col("page_id") % 10).alias("rank"), (F.col("page_id") % 4).alias("engine"))
    content = F.concat(F.lit("Adresse "), "postcode", F.lit(" "), F.when(F.col("page_id") % 2 == 0, F.col("city")).otherwise("Ort"))
    return p.join(c, F.col("page_id") == F.col("doc_id")).select("id", "query", "rank", "engine", "url", F.col("firm").alias("name"), "city", "postcode", "street", F.when(F.col("page_id") % 5 > 0, F.col("firm")).otherwise("Andere").alias("title"), content.alias("content"))


def search_features(spark, sf_dir):
    f = discovery.search_features(_hits(spark, sf_dir), ["x.com"])
    seen = discovery.host_frequency(_hits(spark, sf_dir))
    keys = ["best_rank", "n_hits", "n_queries", "n_engines", "city_in", "plz_in", "name_in_title", "listed", "tld_de", "label_len"]
    return f.join(seen, "host").select("id", "host", *[F.col(k).cast("long").alias(k) for k in keys], F.col("companies").alias("host_freq"))


def verified_hosts(spark, sf_dir):
    """The candidate host that wins each user, of events as candidates."""
    e = table(spark, sf_dir, "events")
    said = F.when(F.col("event_type") == "click", "name+plz").when(F.col("event_type") == "view", "name").otherwise("plz")
    c = e.select(F.col("user_id").alias("id"), F.col("event_id").alias("place"), F.concat(F.lit("h"), (F.col("event_id") % 9).cast("string")).alias("host"), said.alias("said"), (F.col("event_id") % 3 > 0).alias("ok"))
    return discovery.best_verified(c)


def top_candidates(spark, sf_dir):
    e = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id"), F.col("o_orderkey").cast("string").alias("host"), (F.col("o_orderkey") % 100 / F.lit(100.0)).alias("p"), (F.col("o_orderkey") % 7 == 0).alias("listed"))
    return discovery.top_candidates(e, 0.3, 3).select("id", "host", F.col("place").cast("long").alias("place"))


def residual_rows(spark, sf_dir):
    c = companies(spark, sf_dir).withColumns({"website_verified": F.expr(cases(["name+plz", "mismatch", None, "dead", "plz"])), "is_industrial": F.col("source").isin(C.INDUSTRIAL_SOURCES)})
    return discovery.residual(c, ["mismatch", "dead", "parked", "redirect_offdomain", "no_impressum", "blocked", "plz", "robots"], True).select("id")


def ranked_hosts(spark, sf_dir):
    """The hosts that a ranker, learned from the companies with an even number, finds for the others."""
    hits = _hits(spark, sf_dir).withColumn("form", F.lit("GmbH"))
    f = discovery.search_features(hits, ["x.com"]).join(discovery.host_frequency(hits).withColumnRenamed("companies", "host_freq"), "host")
    f = staged(f.withColumn("label", (F.col("sim_title") >= 1).cast("int")), "features")
    model = ranker.fit(f.where("id % 2 = 0"), RANKED_BY, trees=5, depth=2)
    return ranker.candidates(model, f.where("id % 2 = 1"), features=RANKED_BY).select("id", "host", F.col("place").cast("long").alias("place"))


#: The title's likeness is left out: it is what the label is made of.
RANKED_BY = [f for f in ranker.FEATURES if f != "sim_title"]


def ranker_metrics(spark, sf_dir):
    """How often the best-scored order of a customer is the right one."""
    e = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("id"), F.col("o_orderkey").cast("string").alias("host"), (F.col("o_orderkey") % 100 / F.lit(100.0)).alias("p"), (F.col("o_orderkey") % 3 == 0).cast("int").alias("label")
    )
    return ranker.group_metrics(e)


def _made_up_web(url, params):
    """Ten kinds of hosts, by the last digit of the name."""
    host, _, path = url.split("//", 1)[1].partition("/")
    kind = host.split(".")[0][-1]
    if path == "robots.txt":
        return (200, url, b"User-agent: *\nDisallow: /") if kind == "0" else (404, url, b"")
    if kind == "1" or (kind == "2" and url.startswith("https")):
        return None
    if kind == "3":
        return 403, url, b""
    if path:
        return (500, url, b"") if kind == "5" else (200, url, b"<p>Firma GmbH</p><p>28195 Bremen</p>")
    if kind == "4":
        return 200, url, b"<p>This domain is for sale</p>"
    link = b"<p>Willkommen</p><a href='/impressum'>Impressum</a>"
    return {
        "6": (200, url, b"<p>Angaben gem\xc3\xa4\xc3\x9f Gesetz</p>"), "7": (200, url, b"<p>Nur Bilder</p>"),
        "8": (200, "https://www.andere.org/", link), "9": (200, "https://www.andere.org/", b"<p>Nur Bilder</p>"),
    }.get(kind, (200, url, link))


def fetched_sites(spark, sf_dir):
    """Records of hosts that were asked in two runs; the second one asks only for what the first one lacks."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("firma"), (F.col("doc_id") % 50).cast("string"), F.lit(".de")).alias("host"))
    folder = shared_folder(spark)
    remote.fetch_sites(spark, d.where("doc_id % 3 = 0"), folder, _made_up_web)
    return remote.fetch_sites(spark, d, folder, _made_up_web)


QUERIES = {
    f.__name__: f
    for f in (
        host_kinds, hygiene_report, listed_hosts, page_texts, imprint_fields, imprint_links, name_searches, site_verdicts, discovery_accept, search_queries,
        label_candidates, search_features, verified_hosts, top_candidates, residual_rows,
        ranked_hosts, ranker_metrics, fetched_sites,
    )
}


def _in(values: list[str]) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def _list(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


_SITE = SITE.replace("AS string", "AS VARCHAR")
_NAME = ROW_NAME.replace("AS string", "AS VARCHAR")
_HOSTED = f"d AS (SELECT doc_id AS id, {_NAME} AS name, regexp_replace(nullif(regexp_extract({_SITE}, '^https?://([^/?#:]*)', 1), ''), '^www\\.', '') AS host FROM documents)"
_ENDS = "(host = '{0}' OR ends_with(host, '.{0}'))"
_SEEDED = f"s AS (SELECT *, CASE WHEN host IS NULL THEN NULL WHEN host IN {_in(C.OWN_HOSTS)} THEN 'own' WHEN {_ENDS.format('drk.de')} THEN 'chain' WHEN {_ENDS.format('myhermes.de')} THEN 'parcel' WHEN {_ENDS.format('facebook.com')} THEN 'social' WHEN {_ENDS.format('gelbeseiten.de')} OR {_ENDS.format('google.com')} THEN 'directory' ELSE 'own' END AS seeded FROM d)"
_BRAND = f"list_filter(flatten(list_transform(string_split(regexp_replace(host, '\\.[^.]*$', ''), '.'), lambda x: regexp_split_to_array(x, '[-_0-9]+'))), lambda t: length(t) >= 2 AND t NOT IN {_in(C.BRAND_STOP)})"
_STATS = f"t AS (SELECT host, count(*) AS n, count(DISTINCT nullif({name_key_sql('name')}, '')) AS k, avg(CASE WHEN len(list_filter({_BRAND}, lambda t: contains(regexp_replace(lower(name), '[^a-z0-9]', '', 'g'), t))) > 0 THEN 1.0 ELSE 0.0 END) AS b FROM s WHERE seeded = 'own' AND host NOT IN {_in(C.OWN_HOSTS)} GROUP BY host HAVING count(*) >= 20)"
_KINDS = f"WITH {_HOSTED}, {_SEEDED}, {_STATS}, k AS (SELECT id, s.host, coalesce(CASE WHEN n >= 100 AND k >= 0.9 * n AND b <= 0.3 THEN 'directory' WHEN n IS NOT NULL THEN 'chain' END, seeded) AS kind FROM s LEFT JOIN t ON s.host = t.host)"
_PAGE = "regexp_replace(regexp_replace(regexp_replace(html, '<script.*?</script>|<style.*?</style>|<!--.*?-->', ' ', 'gis'), '</?(?:" + "|".join(S.LINE_TAGS) + ")\\b[^>]*>', chr(10), 'gi'), '<[^>]+>', ' ', 'g')"
for _a, _b in S.ENTITIES.items():
    _PAGE = f"replace({_PAGE}, '{_a}', " + (f"'{_b}'" if _b != "'" else "chr(39)") + ")"
_LINES = f"array_to_string(list_filter(list_transform(string_split(replace({_PAGE}, chr(13), ''), chr(10)), lambda x: trim(regexp_replace(x, '[ \\t\u00a0]+', ' ', 'g'))), lambda x: x <> ''), chr(10))"
_TOKS = f"list_filter(string_split({name_key_sql('n')}, ' '), lambda t: length(t) >= 3 AND t NOT IN {_in(C.GENERIC_WORDS)} AND NOT regexp_full_match(t, '[0-9]+'))"
_OWN = f"list_filter(toks, lambda t: t NOT IN {_in(C.TRADE_WORDS)})"
_CO = f"WITH {COMPANIES_SQL}"
_HITS = "h0 AS (SELECT page_id % 20 AS id, page_id, replace(url, '.example.com', '.de') AS url, page_id % 3 AS query, page_id % 10 AS rank, page_id % 4 AS engine FROM pages), h AS (SELECT h0.*, co.name, co.city, co.postcode, co.street, CASE WHEN page_id % 5 > 0 THEN co.name ELSE 'Andere' END AS title, 'Adresse ' || co.postcode || ' ' || CASE WHEN page_id % 2 = 0 THEN co.city ELSE 'Ort' END AS content, array_to_string((string_split(regexp_replace(lower(regexp_extract(url, '^[A-Za-z]+://([^/?#:]*)', 1)), '^www\\.', ''), '.'))[-2:], '.') AS host FROM h0 JOIN co ON h0.page_id = co.doc_id)"
_TEXT = f"concat_ws(' ', {name_key_sql('title')}, {name_key_sql('content')}, lower(url))"
_LABELS = f"""{_CO}, k AS (SELECT *, {name_key_sql("name")} AS key FROM co), l AS (
  SELECT DISTINCT replace(key, ' ', '') || {cases(['seehafen', 'seehafen-gmbh', '-bremen', '24', 'werkstoff', 'seehafenundnochetwasmehr'], '(doc_id + 2)')} AS label FROM k
), l2 AS (SELECT label FROM l WHERE regexp_full_match(label, '[a-z0-9-]+')), n AS (
  SELECT id, name || ' Seehafen' AS n FROM co
), a AS (SELECT id, n, {_TOKS} AS toks FROM n), b AS (
  SELECT *, array_to_string(toks, '') AS j, array_to_string(toks, '-') AS y, {_OWN} AS own FROM a
), c AS (SELECT * FROM b WHERE len(own) > 0 AND length(j) >= 5), g AS (
  SELECT id, unnest(CASE WHEN length(j) BETWEEN 5 AND 40 AND list_max(list_transform(toks, lambda t: length(t))) >= 5
    THEN [{{'pos': 0, 'l': j}}, {{'pos': 1, 'l': y}}, {{'pos': 2, 'l': CASE WHEN len(toks) > 2 THEN toks[1] || toks[2] END}}, {{'pos': 4, 'l': CASE WHEN contains(lower(n), 'gmbh') THEN j || '-gmbh' END}}] ELSE [] END) AS r FROM c WHERE len(toks) > 1
), p AS (
  SELECT id, 1 AS stage, j AS start, 50 AS most, NULL::VARCHAR[] AS others FROM c WHERE len(toks) > 1
  UNION ALL SELECT id, 2, y, 50, NULL FROM c WHERE len(toks) > 1 AND y <> j
  UNION ALL SELECT id, 3, own[1], 200, list_concat(toks[2:], {_list(C.LABEL_SUFFIXES)}) FROM c WHERE len(toks) > 1 AND length(own[1]) >= 6
), m AS (
  SELECT start, most, label FROM (SELECT DISTINCT start, most FROM p) JOIN l2 ON starts_with(label, start) QUALIFY row_number() OVER (PARTITION BY start, most ORDER BY label) <= most
), f AS (
  SELECT id, label, stage, length(label) AS pos, trim(substr(label, length(p.start) + 1), '-') AS rest, others, p.start FROM p JOIN m ON m.start = p.start AND m.most = p.most
), e AS (
  SELECT id, j AS label, 0 AS stage, 0 AS pos FROM c JOIN l2 ON l2.label = j WHERE len(toks) = 1 AND length(j) >= 7
  UNION ALL SELECT id, r.l, 0, r.pos FROM g JOIN l2 ON l2.label = r.l
  UNION ALL SELECT id, label, stage, pos FROM f WHERE CASE WHEN stage < 3 THEN length(label) <= length(start) + 12
    ELSE rest = '' OR list_contains(others, rest) OR list_contains(others, regexp_replace(rest, '[-0-9]', '', 'g')) OR len(list_filter(others, lambda o: length(o) >= 4 AND starts_with(rest, o))) > 0 END
), q AS (SELECT id, label, min(stage * 100000 + pos) AS best FROM e GROUP BY ALL), r AS (
  SELECT id, label, best, row_number() OVER (PARTITION BY id ORDER BY best, label) AS place, count(*) FILTER (WHERE best < 300000) OVER (PARTITION BY id) AS earlier FROM q
) SELECT id, label, place::INT AS place FROM r WHERE place <= 5 AND (best < 300000 OR earlier < 5)"""
_DOCS = "SELECT doc_id, {0} FROM documents"

ORACLE_SQL = {
    "host_kinds": f"{_KINDS} SELECT id, host, kind FROM k",
    "hygiene_report": f"{_KINDS}, c AS (SELECT kind, host, count(*)::BIGINT AS n FROM k WHERE kind IN ('directory', 'chain') GROUP BY ALL) SELECT 'kind' AS what, coalesce(kind, 'none') AS kind, '' AS host, count(*)::BIGINT AS n FROM k GROUP BY 2 UNION ALL (SELECT 'top', kind, host, n FROM c QUALIFY row_number() OVER (PARTITION BY kind ORDER BY n DESC, host) <= 2)",
    "listed_hosts": f"WITH d AS (SELECT doc_id, {LISTED} AS h FROM documents) SELECT doc_id, h IN ('maps.google.com', 'x.com', 'a.b.x.com', 'myhermes.de') AS below, h IN ('maps.google.com', 'sites.google.com', 'de.wikipedia.org', 'x.com', 'a.b.x.com', 'myhermes.de') AS skipped FROM d",
    "page_texts": f"WITH p AS (SELECT page_id, {_LINES} AS t FROM pages) SELECT page_id, md5(t) AS text_md5, len(string_split(t, chr(10)))::BIGINT AS lines, array_to_string(list_sort(list_distinct(list_filter(list_filter(regexp_extract_all(t, '[0-9]+'), lambda x: length(x) = 5), lambda x: x::INT BETWEEN 1001 AND 99998))), ',') AS postcodes FROM p",
    "imprint_fields": _DOCS.format(cases(IMPRINTS_READ) + " AS fields"),
    "imprint_links": _DOCS.format(cases(LINKS_READ) + " AS links"),
    "name_searches": f"WITH d AS (SELECT doc_id, {FIRM} AS n FROM documents), t AS (SELECT *, coalesce({_TOKS}, []) AS toks, {name_key_sql('n')} AS key FROM d), o AS (SELECT *, {_OWN} AS own, array_to_string(toks, '') AS j, array_to_string(toks, '-') AS y FROM t) SELECT doc_id, array_to_string(toks, ' ') AS tokens, CASE WHEN coalesce(trim(n), '') = '' THEN 'no name' WHEN len(own) = 0 THEN 'generic name' WHEN key IN {_in(PLACES)} OR array_to_string(own, ' ') IN {_in(PLACES)} THEN 'place name' END AS skipped, CASE WHEN length(j) BETWEEN 5 AND 40 AND list_max(list_transform(toks, lambda t: length(t))) >= 5 THEN concat_ws(' ', j || '.de', CASE WHEN y <> j THEN y || '.de' END, CASE WHEN len(toks) > 2 THEN toks[1] || toks[2] || '.de' END, j || '.com', CASE WHEN contains(lower(n), 'gmbh') THEN j || '-gmbh.de' END) ELSE '' END AS guesses FROM o",
    "site_verdicts": f"WITH d AS (SELECT doc_id, {FIRM} AS n, {SAID} AS s, {OWN_CODE} AS o, trim({CODE}) AS c, {TOKENS} AS t FROM documents), t AS (SELECT *, coalesce({_TOKS}, []) AS toks FROM d), h AS (SELECT *, len(list_filter(toks, lambda x: list_contains(string_split(t, ' '), x))) AS hits, len(list_filter(toks, lambda x: contains(t || ' 28195 bremen', x))) AS inside, (c IS NOT NULL AND (c = '27000' OR c IS NOT DISTINCT FROM o)) AS placed FROM t) SELECT doc_id, CASE WHEN s IS NULL THEN 'dead' WHEN s NOT LIKE 'ok%' THEN s WHEN hits > 0 AND hits >= least(2, len(toks)) THEN CASE WHEN placed THEN 'name+plz' ELSE 'name' END WHEN s = 'ok_redirected' THEN 'redirect_offdomain' WHEN placed THEN 'plz' ELSE 'mismatch' END AS verdict, CASE WHEN doc_id % 3 = 0 THEN 'redirect_offdomain' WHEN inside > 0 AND inside >= least(2, len(toks)) THEN 'name+plz' WHEN inside >= 2 THEN 'name' ELSE 'mismatch' END AS page FROM h",
    "discovery_accept": f"WITH d AS (SELECT doc_id, {FIRM} AS n, {LEGAL} AS l, {LABEL} AS b, {cases(['name', 'name+plz', 'plz', 'name', 'name'])} AS v FROM documents), t AS (SELECT *, coalesce({_TOKS}, []) AS toks FROM d), o AS (SELECT *, list_distinct({_OWN}) AS own, list_distinct(list_filter(string_split({name_key_sql('l')}, ' '), lambda t: length(t) >= 3 AND t NOT IN {_in(C.GENERIC_WORDS + C.TRADE_WORDS)})) AS theirs FROM t), s AS (SELECT *, len(list_intersect(own, theirs)) AS k FROM o) SELECT doc_id, coalesce(v = 'name+plz' OR (v = 'name' AND CASE WHEN l IS NOT NULL THEN NOT contains(l, 'e.V.') AND len(own) > 0 AND len(theirs) > 0 AND k >= least(2, len(own)) AND k * 2 >= len(theirs) ELSE len(own) >= 2 AND (b = array_to_string(toks, '') OR b = array_to_string(toks, '-')) END), false) AS accepted FROM s",
    "search_queries": f"WITH d AS (SELECT doc_id, {FIRM} AS n, {LEGAL} AS l, coalesce(nullif(trim({cases(['Bremen', None, ' '])}), ''), 'Kreis Süd') AS c, nullif({cases(['Am Kai 1', ''])}, '') AS s FROM documents), b AS (SELECT *, coalesce(l, n) AS base FROM d) SELECT doc_id, CASE WHEN base IS NULL THEN '' ELSE array_to_string((list_filter([base || ' ' || c, base || ' ' || c || ' impressum', CASE WHEN {name_key_sql('n')} <> {name_key_sql('l')} THEN n || ' ' || c END, base || ' ' || s], lambda x: x IS NOT NULL))[1:4], ' | ') END AS queries, (doc_id % 4 = 0 OR len(list_filter(regexp_extract_all(lower(coalesce(n, '')), '[a-zäöüß0-9]{{4,}}'), lambda t: t NOT IN {_in(C.QUERY_WORDS + ['bremen'])})) = 0 OR len(list_filter(regexp_extract_all(lower(coalesce(n, '')), '[a-zäöüß0-9]{{4,}}'), lambda t: t NOT IN {_in(C.QUERY_WORDS + ['bremen'])} AND contains('https://currenttime.now die zeit ' || CASE WHEN doc_id % 4 = 1 THEN 'seehafen gmbh und reederei' ELSE 'bremen' END, t))) > 0) AS relevant FROM b",
    "label_candidates": _LABELS,
    "search_features": f"{_CO}, {_HITS}, f AS (SELECT id, host, min(rank)::BIGINT AS best_rank, count(*)::BIGINT AS n_hits, count(DISTINCT query)::BIGINT AS n_queries, count(DISTINCT engine)::BIGINT AS n_engines, max(CASE WHEN {name_key_sql('city')} <> '' AND contains({_TEXT}, {name_key_sql('city')}) THEN 1 ELSE 0 END)::BIGINT AS city_in, max(CASE WHEN contains(title || ' ' || content, postcode) THEN 1 ELSE 0 END)::BIGINT AS plz_in, max(CASE WHEN {name_key_sql('name')} <> '' AND contains({name_key_sql('title')}, {name_key_sql('name')}) THEN 1 ELSE 0 END)::BIGINT AS name_in_title FROM h GROUP BY ALL), q AS (SELECT host, count(DISTINCT id)::BIGINT AS host_freq FROM h GROUP BY 1) SELECT f.*, (f.host IN ('x.com'))::BIGINT AS listed, ends_with(f.host, '.de')::BIGINT AS tld_de, length(string_split(f.host, '.')[1])::BIGINT AS label_len, host_freq FROM f JOIN q USING (host)",
    "ranker_metrics": "WITH e AS (SELECT o_custkey AS id, o_orderkey % 100 / 100.0 AS p, (o_orderkey % 3 = 0)::INT AS label, o_orderkey::VARCHAR AS host FROM orders), b AS (SELECT id, max(label) AS found, max(p) AS p, first(label ORDER BY p DESC, host) AS hit FROM e GROUP BY id) SELECT count(*)::BIGINT AS companies, sum(found)::BIGINT AS found, sum(hit)::BIGINT AS top1, count(*) FILTER (p >= 0.5)::BIGINT AS n_sure, coalesce(sum(hit) FILTER (p >= 0.5), 0)::BIGINT AS sure_right FROM b",
    "fetched_sites": "WITH h AS (SELECT DISTINCT doc_id % 50 % 10 AS k, 'firma' || (doc_id % 50) || '.de' AS host FROM documents) SELECT host, CASE k WHEN 0 THEN 'robots' WHEN 1 THEN 'dead' WHEN 3 THEN 'blocked' WHEN 4 THEN 'parked' WHEN 7 THEN 'no_impressum' WHEN 8 THEN 'ok_redirected' WHEN 9 THEN 'redirect_offdomain' ELSE 'ok' END AS status, CASE WHEN k IN (8, 9) THEN 'andere.org' WHEN k NOT IN (0, 1, 3) THEN host END AS final_host, CASE k WHEN 2 THEN 'http://' || host || '/impressum' WHEN 5 THEN 'https://' || host || '/' WHEN 6 THEN 'https://' || host || '/' WHEN 8 THEN 'https://www.andere.org/impressum' END AS imprint_url, CASE WHEN k IN (2, 8) THEN 'Firma GmbH' || chr(10) || '28195 Bremen' WHEN k = 5 THEN 'Willkommen' || chr(10) || 'Impressum' WHEN k = 6 THEN 'Angaben gemäß Gesetz' WHEN k IN (7, 9) THEN 'Nur Bilder' END AS text FROM h",
    "verified_hosts": "WITH c AS (SELECT user_id AS id, event_id, 'h' || (event_id % 9) AS host, CASE event_type WHEN 'click' THEN 'name+plz' WHEN 'view' THEN 'name' ELSE 'plz' END AS said FROM events WHERE event_id % 3 > 0) SELECT id, host, said FROM c QUALIFY row_number() OVER (PARTITION BY id ORDER BY said <> 'name+plz', event_id, host) = 1",
    "top_candidates": "SELECT o_custkey AS id, o_orderkey::VARCHAR AS host, row_number() OVER w AS place FROM orders WHERE o_orderkey % 100 >= 30 AND o_orderkey % 7 <> 0 WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey % 100 DESC, o_orderkey::VARCHAR) QUALIFY row_number() OVER w <= 3",
    "residual_rows": f"{_CO} SELECT id FROM co WHERE trim(name) <> '' AND source IN ('ied', 'abwaerme', 'mastr') AND (website IS NULL OR {cases(['name+plz', 'mismatch', None, 'dead', 'plz'])} IN ('mismatch', 'dead', 'plz'))",
}
