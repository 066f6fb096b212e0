"""Web pages, hosts and what they say about a firm, as Column functions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as C
from .text import folded, name_key
from .url import host, plain_host, registered

# The entities that pages use, and the tags that end a line.
ENTITIES = {"&nbsp;": " ", "&quot;": '"', "&#39;": "'", "&lt;": "<", "&gt;": ">", "&auml;": "ä", "&ouml;": "ö", "&uuml;": "ü", "&Auml;": "Ä", "&Ouml;": "Ö", "&Uuml;": "Ü", "&szlig;": "ß", "&amp;": "&"}
LINE_TAGS = ["br", "p", "div", "li", "ul", "ol", "tr", "td", "th", "h[1-6]", "section", "article", "header", "footer", "address", "table", "dd", "dt"]


def words(c: Column) -> Column:
    return F.filter(F.split(c, " "), lambda t: t != "")


def among(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def unescaped(c: Column) -> Column:
    return reduce(lambda x, e: F.replace(x, F.lit(e[0]), F.lit(e[1])), ENTITIES.items(), c)


def page_text(html: Column) -> Column:
    """What a page shows, a line for each block, blanks collapsed and empty lines left out."""
    t = F.regexp_replace(F.coalesce(html, F.lit("")), r"(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->", " ")
    t = F.regexp_replace(t, rf"(?i)</?(?:{'|'.join(LINE_TAGS)})\b[^>]*>", "\n")
    t = F.replace(unescaped(F.regexp_replace(t, "<[^>]+>", " ")), F.lit("\r"), F.lit(""))
    lines = F.transform(F.split(t, "\n"), lambda x: F.trim(F.regexp_replace(x, "[ \\t\u00a0]+", " ")))
    return F.array_join(F.filter(lines, lambda x: x != ""), "\n")


def text_tokens(text: Column) -> Column:
    """The distinct runs of three letters or more of a text's light key, in order."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(name_key(text, False), F.lit("[a-z]{3,}"), F.lit(0))))


def postcodes(text: Column) -> Column:
    """The distinct plausible postcodes of a text, in order."""
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"(?<!\d)(\d{5})(?!\d)"), F.lit(1))
    return F.array_sort(F.array_distinct(F.filter(found, lambda p: p.cast("int").between(1001, 99998))))


def name_tokens(name: Column) -> Column:
    """The tokens of a name that can be searched for."""
    return F.filter(words(name_key(name)), lambda t: (F.length(t) >= 3) & ~t.isin(C.GENERIC_WORDS) & ~t.rlike("^[0-9]+$"))


def distinctive(name: Column) -> Column:
    return F.filter(name_tokens(name), lambda t: ~t.isin(C.TRADE_WORDS))


def skip_reason(name: Column, is_place: Column) -> Column:
    """Why a name is not worth a search; null if it is."""
    blank = F.trim(F.coalesce(name, F.lit(""))) == ""
    return F.when(blank, "no name").when(F.size(distinctive(name)) == 0, "generic name").when(is_place, "place name")


def domain_guesses(name: Column, form: Column) -> Column:
    """Hosts that a firm of this name may have, none where the name says too little."""
    toks = name_tokens(name)
    joined, hyphen = F.array_join(toks, ""), F.array_join(toks, "-")
    longest = F.coalesce(F.array_max(F.transform(toks, F.length)), F.lit(0))
    limited = F.lower(F.concat_ws(" ", form, name)).contains("gmbh")
    two = F.when(F.size(toks) > 2, F.array_join(F.slice(toks, 1, 2), ""))
    out = F.array(
        F.concat(joined, F.lit(".de")), F.concat(hyphen, F.lit(".de")), F.concat(two, F.lit(".de")),
        F.concat(joined, F.lit(".com")), F.when(limited, F.concat(joined, F.lit("-gmbh.de"))),
    )
    plausible = F.array_distinct(F.filter(out, lambda h: h.isNotNull() & h.rlike(r"^[a-z0-9-]+\.(de|com)$")))
    return F.when(F.length(joined).between(5, 40) & (longest >= 5), plausible).otherwise(F.array().cast("array<string>"))


def verdict(status: Column, tokens: Column, own_postcode: Column, codes: Column, name: Column, postcode: Column) -> Column:
    """What a site's imprint says about a row: its name, its postcode, both or neither."""
    toks = name_tokens(name)
    hits = F.size(F.filter(toks, lambda t: F.array_contains(F.coalesce(tokens, F.array().cast("array<string>")), t)))
    named = (hits > 0) & (hits >= F.least(F.lit(2), F.size(toks)))
    plz = F.trim(F.coalesce(postcode, F.lit("")))
    placed = (plz != "") & (plz.eqNullSafe(own_postcode) | F.coalesce(F.array_contains(codes, plz), F.lit(False)))
    fetched = status.isin("ok", "ok_redirected")
    return (
        F.when(~F.coalesce(fetched, F.lit(False)), F.coalesce(status, F.lit("dead")))
        .when(named & placed, "name+plz").when(named, "name").when(status == "ok_redirected", "redirect_offdomain")
        .when(placed, "plz").otherwise("mismatch")
    )


def verified(final: Column, asked: Column, text: Column, name: Column, postcode: Column, city: Column) -> Column:
    """What a fetched page proves about a guessed host."""
    toks = name_tokens(name)
    hits = F.size(F.filter(toks, lambda t: text.contains(t)))
    plz, place = F.trim(F.coalesce(postcode, F.lit(""))), name_key(city)
    located = ((plz != "") & text.contains(plz)) | ((place != "") & text.contains(place))
    return (
        F.when(registered(final) != registered(asked), "redirect_offdomain")
        .when((hits > 0) & (hits >= F.least(F.lit(2), F.size(toks))) & located, "name+plz")
        .when(hits >= 2, "name").otherwise("mismatch")
    )


def accepted(said: Column, name: Column, label: Column, legal_name: Column, division: Column) -> Column:
    """Whether a discovered site is taken: by name and postcode always, by name alone where the
    imprint's registered name is the firm's or, without one, the label is the firm's key."""
    own, theirs = F.array_distinct(distinctive(name)), F.array_distinct(distinctive(legal_name))
    shared = F.size(F.array_intersect(own, theirs))
    by_name = (
        F.coalesce(division.isin("HRA", "HRB", "GnR", "PR"), F.lit(False)) & (F.size(own) > 0) & (F.size(theirs) > 0)
        & (shared >= F.least(F.lit(2), F.size(own))) & (shared * 2 >= F.size(theirs))
    )
    toks = name_tokens(name)
    by_label = (F.size(distinctive(name)) >= 2) & ((label == F.array_join(toks, "")) | (label == F.array_join(toks, "-")))
    with_line = F.coalesce(legal_name, F.lit("")) != ""
    return (said == "name+plz") | ((said == "name") & F.when(with_line, by_name).otherwise(by_label))


def search_queries(name: Column, legal_name: Column, city: Column, district: Column, street: Column) -> Column:
    """The queries for one firm, the best evidence first, four at most."""
    some = lambda c: F.nullif(F.trim(c), F.lit(""))
    base, place = F.coalesce(some(legal_name), some(name)), F.coalesce(some(city), some(district))
    first = F.concat_ws(" ", base, place)
    renamed = some(name).isNotNull() & some(legal_name).isNotNull() & (name_key(name) != name_key(legal_name))
    out = F.array(
        first, F.concat(first, F.lit(" impressum")), F.when(renamed, F.concat_ws(" ", some(name), place)),
        F.when(some(street).isNotNull(), F.concat(base, F.lit(" "), some(street))),
    )
    return F.when(base.isNull(), F.array().cast("array<string>")).otherwise(F.slice(F.array_compact(out), 1, 4))


def relevant(query: Column, texts: Column, towns: list[str]) -> Column:
    """Whether an answer is about its query: no results, nothing to ask for, or a result (its address,
    title and text in one) that holds a distinctive word of the query."""
    asked = F.regexp_extract_all(F.lower(query), F.lit("[a-zäöüß0-9]{4,}"), F.lit(0))
    asked = F.filter(asked, lambda t: ~t.isin(C.QUERY_WORDS + towns))
    met = F.exists(texts, lambda x: F.exists(asked, lambda t: F.lower(x).contains(t)))
    return (F.size(texts) == 0) | (F.size(asked) == 0) | met


def brand_tokens(name: Column) -> Column:
    """The parts of a host's labels below its suffix that can name a brand."""
    labels = F.split(name, r"\.")
    labels = F.slice(labels, 1, F.greatest(F.size(labels) - 1, F.lit(1)))
    labels = F.when((F.size(labels) >= 2) & F.element_at(labels, -1).isin("co", "com", "org", "net"), F.slice(labels, 1, F.greatest(F.size(labels) - 1, F.lit(1)))).otherwise(labels)
    parts = F.flatten(F.transform(labels, lambda x: F.split(x, "[-_0-9]+")))
    return F.filter(parts, lambda t: (F.length(t) >= 2) & ~t.isin(C.BRAND_STOP))


def names_brand(name: Column, tokens: Column) -> Column:
    """Whether a name, run together, holds one of a host's brand tokens."""
    plain = F.regexp_replace(folded(F.coalesce(name, F.lit(""))), "[^a-z0-9]", "")
    return F.exists(tokens, lambda t: plain.contains(t))


def imprint_links(html: Column, base: Column) -> Column:
    """The links of a page to an imprint on its own registered domain: the best word first, then the shortest."""
    anchors = F.regexp_extract_all(html, F.lit(r"""(?is)(<a\b[^>]*?href\s*=\s*["']?[^"'\s>]+["']?[^>]*>.*?</a>)"""), F.lit(1))
    origin = F.regexp_extract(base, "^([A-Za-z]+://[^/?#]+)", 1)

    def link(a: Column) -> Column:
        href = unescaped(F.regexp_extract(a, r"""(?is)href\s*=\s*["']?([^"'\s>]+)""", 1))
        said = F.lower(F.trim(F.regexp_replace(unescaped(F.regexp_replace(F.regexp_extract(a, r"(?is)^<a\b[^>]*>(.*)</a>$", 1), "<[^>]+>", " ")), "[ \\t]+", " ")))
        url = F.when(href.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), href).when(href.startswith("//"), F.concat(F.regexp_extract(base, "^([A-Za-z]+:)", 1), href))
        url = url.when(href.startswith("/"), F.concat(origin, href)).otherwise(F.concat(F.regexp_replace(F.regexp_replace(base, "[?#].*$", ""), "(?<=[^/])/[^/]*$", ""), F.lit("/"), href))
        url = F.substring_index(url, "#", 1)
        path = F.lower(F.regexp_extract(url, r"^[^/]*//[^/?#]*([^?#]*)", 1))
        rank = F.lit(None).cast("int")
        for i, w in reversed(list(enumerate(C.IMPRINT_WORDS))):
            rank = F.when(said.contains(w) | path.contains(w.replace(" ", "-")) | path.contains(w.replace(" ", "")), i).otherwise(rank)
        same = registered(plain_host(url)).eqNullSafe(registered(plain_host(base))) & host(url).isNotNull()
        other = F.lower(href).rlike("^(mailto:|tel:|javascript:|#)")
        return F.struct(F.when(same & ~other, rank).alias("rank"), F.length(url).alias("size"), url.alias("url"))

    ranked = F.array_sort(F.filter(F.transform(anchors, link), lambda x: x["rank"].isNotNull()))
    return F.array_distinct(F.transform(ranked, lambda x: x["url"]))


def imprint_fields(text: Column) -> Column:
    """struct of what an imprint's text tells: register type and number, court, VAT id, postcode, city,
    and the share of those five groups that it has."""
    some = lambda p, i: F.nullif(F.regexp_extract(text, p, i), F.lit(""))
    number = r"\b(HRA|HRB|GnR|PR|VR|GsR)[\s:.-]*(?:Nr\.?\s*)?([0-9][0-9.]{0,8})"
    court = r"(?:Amtsgericht|Registergericht|Handelsregister)[\s:]+(?:des |beim |in )?(?!Amtsgericht|Nr|HR[AB])([A-ZÄÖÜ][A-Za-zäöüß-]+)"
    place = r"(?<![\d/-])(\d{5})\s+([A-ZÄÖÜ][A-Za-zäöüß.-]+)"
    vat = F.regexp_replace(F.nullif(F.regexp_extract(text, r"\b(DE\s?\d{3}\s?\d{3}\s?\d{3})(?!\d)", 1), F.lit("")), r"\s", "")
    code = some(place, 1)
    code = F.when(code.cast("int").between(1001, 99998), code)
    own = {"court": some(court, 1), "vat_id": vat, "postcode": code, "city": F.when(code.isNotNull(), some(place, 2)), "register_type": some(number, 1), "register_no": F.nullif(F.replace(F.regexp_extract(text, number, 2), F.lit(".")), F.lit(""))}
    has = [own["court"], own["vat_id"], own["postcode"], own["city"], own["register_no"]]
    score = reduce(lambda a, b: a + b, [F.when(c.isNotNull(), 20).otherwise(0) for c in has])
    return F.struct(*[c.alias(k) for k, c in own.items()], score.alias("score"))


def listed_host(name: Column, lists: list[str]) -> Column:
    """A host that is, or whose registered domain is, among the lists or a search engine's."""
    reg = registered(name)
    return name.isin(lists) | reg.isin(lists) | reg.isin(C.SEARCH_HOSTS)
