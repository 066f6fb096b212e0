"""Ids, labels and fields of source records, as Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as C


def some(c: Column) -> Column:
    """The trimmed text, null if there is none."""
    return F.nullif(F.trim(c), F.lit(""))


def site_id(uid: Column, street: Column, postcode: Column) -> Column:
    """A site's stable id from its company's and its address."""
    return F.concat(F.lit("abw_"), uid.cast("string"), F.lit("_"), F.substring(F.md5(F.lower(F.concat(street, F.lit("|"), postcode))), 1, 8))


def registry_id(url: Column, registry: str = "https://registry.gdi-de.org/id/") -> Column:
    """The whole path of a registry's address, without any prefix that is not the registry's."""
    u = F.rtrim(url, F.lit("/"))
    tail = F.when(u.startswith(registry), F.substring(u, len(registry) + 1, 10_000)).otherwise(F.substring_index(u, "://", -1))
    return F.concat(F.lit("ied_"), tail)


def item_id(tags: Column, key: str) -> Column:
    """The first item number of a tag in a JSON text, null where it is none."""
    first = F.trim(F.substring_index(F.trim(F.try_element_at(F.from_json(tags, "map<string,string>"), F.lit(key))), ";", 1))
    return F.when(first.rlike(r"^Q\d+$"), first)


def point_of(text: Column) -> Column:
    """struct(lon, lat) of a text "Point(x y)"."""
    pattern = r"(?i)^Point\(\s*(-?[\d.]+)\s+(-?[\d.]+)\s*\)"
    at = lambda i: F.regexp_extract(text, pattern, i).try_cast("double")
    return F.when(text.rlike(pattern), F.struct(at(1).alias("lon"), at(2).alias("lat")))


def delimited(parts: Column) -> Column:
    """+a+b+ of an array's texts, null without one: a filter can look for +a+."""
    own = F.filter(parts, lambda t: t.isNotNull() & (t != ""))
    return F.when(F.size(own) > 0, F.concat(F.lit("+"), F.array_join(own, "+"), F.lit("+")))


def item_links(entity: Column, operator: Column, brand: Column, website_source: Column) -> Column:
    """Which links to items a row has: e, o, b, and w for a website taken from one."""
    flag = lambda c, k: F.when(F.coalesce(c, F.lit("")) != "", k)
    return delimited(F.array(flag(entity, "e"), flag(operator, "o"), flag(brand, "b"), F.when(website_source == "wikidata", "w")))


def register_class(match: Column, status: Column) -> Column:
    """A row's class by its register verdict; null for rows that were not asked about."""
    return F.when(match.isin("ambiguous", "none"), match).when(
        ~F.coalesce(match, F.lit("")).isin("", "n/a"), F.when(status == "dissolved", "matched_dissolved").otherwise("matched_active")
    )


def activity_group(code: Column) -> Column:
    """The chapter of an activity's code; livestock stands apart."""
    c = some(code)
    chapters = F.create_map(*[F.lit(x) for kv in C.ACTIVITY_GROUPS.items() for x in kv])
    return F.when(c.startswith("6.6"), "livestock").otherwise(F.try_element_at(chapters, F.substring(c, 1, 1)))


def probed_label(code: Column, labels: dict[str, str]) -> Column:
    """The code with the label of the longest part of it that has one: 6.4(b)(ii), 6.4(b), 6.4."""
    c = some(code)
    table = F.create_map(*[F.lit(x) for kv in labels.items() for x in kv])
    depth = F.size(F.split(c, r"\("))
    label = F.coalesce(*[F.when(depth >= k, F.try_element_at(table, F.substring_index(c, "(", k))) for k in (4, 3, 2, 1)])
    return F.when(label.isNotNull(), F.concat(c, F.lit(" – "), label)).otherwise(c)


def heat_band(mwh: Column) -> Column:
    v = mwh.try_cast("double")
    out = F.when(v.isNull() | F.isnan(v), F.lit(None).cast("string"))
    for limit, label in C.HEAT_BANDS:
        out = out.when(v < limit, label)
    return out.otherwise("> 100 GWh/a")


def section_type(label: Column) -> Column:
    """The business type of an industry section, by the first word that it holds."""
    out, low = F.lit(None).cast("string"), F.lower(label)
    for word, kind in reversed(C.SECTION_TYPES):
        out = F.when(low.contains(word), kind).otherwise(out)
    return out


def label_key(label: Column) -> Column:
    """An industry label's key: dashes alike, no punctuation, single blanks."""
    t = F.regexp_replace(F.regexp_replace(F.lower(label), "[–—]", "-"), r"\s*-\s*", "-")
    return F.trim(F.regexp_replace(t, r"(?U)[^\w]+", " "))


def address_line(street: Column, number: Column, postcode: Column, city: Column) -> Column:
    """"street number, postcode city" of the parts that are there; null without any."""
    return some(F.concat_ws(", ", some(F.concat_ws(" ", some(street), some(number))), some(F.concat_ws(" ", some(postcode), some(city)))))


def cache_key(*parts: Column) -> Column:
    return F.concat_ws("|", *[F.trim(F.regexp_replace(F.lower(F.coalesce(p, F.lit(""))), r"\s+", " ")) for p in parts])


def first_tag(tags: Column, keys: list[str]) -> Column:
    return F.coalesce(*[some(F.try_element_at(tags, F.lit(k))) for k in keys])


def business_kind(tags: Column, keys: list[str], never: list[str]) -> Column:
    """struct(kind, value) of the first key whose value says what a place is."""
    out = F.lit(None).cast("struct<kind:string,value:string>")
    for k in reversed(keys):
        v = F.try_element_at(tags, F.lit(k))
        out = F.when(some(v).isNotNull() & ~v.isin(never), F.struct(F.lit(k).alias("kind"), v.alias("value"))).otherwise(out)
    return out


def slug(text: Column) -> Column:
    """A text as part of a file's name."""
    return F.regexp_replace(text, r"[^A-Za-z0-9ÄÖÜäöüß_-]+", "-")
