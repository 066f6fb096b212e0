"""Web addresses and hosts, as Column functions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import TRACKING


def host(url: Column) -> Column:
    """The lower-cased host of an address, without a port."""
    return F.nullif(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def plain_host(url: Column) -> Column:
    return F.regexp_replace(host(url), r"^www\.", "")


def registered(name: Column) -> Column:
    """The last two labels of a host."""
    return F.substring_index(name, ".", -2)


def normalize_url(raw: Column) -> Column:
    """The first address of a field: scheme, host in lower case, path without its end slash, query
    without tracking; null where there is no plausible host or no number after the host's colon."""
    first = F.element_at(F.split(F.trim(raw), r"[,;\s]+"), 1)
    url = F.when(first.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), first).otherwise(F.concat(F.lit("https://"), F.ltrim(first, F.lit("/"))))
    name = host(url)
    scheme = F.lower(F.regexp_extract(url, "^([A-Za-z][A-Za-z0-9+.-]*)://", 1))
    scheme = F.when(scheme.isin("http", "https"), scheme).otherwise("https")
    port = F.regexp_extract(url, r"^[^/]*//(?:[^/?#@]*@)?[^/?#:]*:(\d+)", 1)
    path = F.rtrim(F.regexp_extract(url, r"^[^/]*//[^/?#]*([^?#]*)", 1), F.lit("/"))
    query = F.filter(
        F.split(F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1), "&"),
        lambda q: (q != "") & ~reduce(lambda a, b: a | b, [F.lower(q).startswith(t) for t in TRACKING]),
    )
    out = F.concat(
        scheme, F.lit("://"), name,
        F.when((port != "") & ~port.isin("80", "443"), F.concat(F.lit(":"), port)).otherwise(""),
        path,
        F.when(F.size(query) > 0, F.concat(F.lit("?"), F.array_join(query, "&"))).otherwise(""),
    )
    return F.when(name.rlike(r"^[a-z0-9.-]+\.[a-z]{2,}$"), out)


def listed(name: Column, hosts: list[str], own: list[str] = ()) -> Column:
    """A host that is in the list or below one that is, unless it is excepted."""
    labels = F.split(name, r"\.")
    parents = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1))), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    inside = F.arrays_overlap(parents, F.array(*[F.lit(h) for h in hosts]))
    return inside & ~name.isin(list(own)) if own else inside
