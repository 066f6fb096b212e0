"""Sources behind a network: items, positions of addresses, pages of hosts, search results, names.

Every source asks only for what its table of answers lacks (an anti join), asks in a bounded number of tasks,
and adds the answers to the table; a question that failed leaves no row and is asked again by the next run.
How a request is made is a parameter: get(url, params) gives (status, final url, body), or None where
nothing came back. It must be picklable; http_get is the one for the real network.
"""

from __future__ import annotations

import json
import socket
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import constants as C
from ..functions import site as S
from ..functions.url import plain_host, registered

Get = Callable[[str, dict], tuple[int, str, bytes] | None]
#: Bytes read of a page, pauses between tries in seconds.
PAGE_BYTES, PAUSES = 150_000, (5, 15, 45)
_BUSY = (429, 502, 503, 504)


def http_get(url: str, params: dict, timeout: float = 30.0) -> tuple[int, str, bytes] | None:
    """One request; a status of 400 or more comes back without a body."""
    full = f"{url}?{urllib.parse.urlencode(params)}" if params else url
    try:
        request = urllib.request.Request(full, headers={"User-Agent": "sitegraph/1.0"})
        with urllib.request.urlopen(request, timeout=timeout) as r:
            return r.status, r.url, r.read() if params else r.read(PAGE_BYTES)
    except urllib.error.HTTPError as e:
        return e.code, url, b""
    except (OSError, ValueError):
        return None


def persistent(get: Get, url: str, params: dict, pauses: tuple[float, ...] = PAUSES) -> bytes:
    """The body of a request that is made again after a pause while the service is busy; stops the job if it stays so."""
    for pause in (0, *pauses):
        time.sleep(pause)
        got = get(url, params)
        if got and got[0] < 400:
            return got[2]
        if got and got[0] not in _BUSY:
            raise RuntimeError(f"{url} answered {got[0]}")
    raise RuntimeError(f"{url} gave no answer; what was answered before is kept")


def ask_missing(
    spark: SparkSession, wanted: DataFrame, key: str, folder: str, ask: Callable[[pd.DataFrame], Iterator[dict]], schema: str, tasks: int = 4, batch: int = 150
) -> DataFrame:
    """The answers to all wanted rows, one a key: those in the folder, and new ones, which are added to it.

    ask gets up to batch rows of wanted and gives a row of schema for each that it could answer.
    """
    try:
        have = spark.read.schema(schema).parquet(folder)
        wanted_new = wanted.join(have.select(key), key, "left_anti")
    except Exception as e:  # the first run has no folder
        if "PATH_NOT_FOUND" not in str(e):
            raise
        wanted_new = wanted
    names = StructType.fromDDL(schema).names

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for lo in range(0, len(frame), batch):
                rows = list(ask(frame.iloc[lo : lo + batch]))
                if rows:
                    yield pd.DataFrame([[r.get(n) for n in names] for r in rows], columns=names, dtype=object)

    fresh = wanted_new.where(F.col(key).isNotNull()).dropDuplicates([key]).repartition(tasks, key)
    fresh.mapInPandas(run, schema).write.mode("append").parquet(folder)
    return spark.read.schema(schema).parquet(folder).join(wanted.select(key).distinct(), key, "left_semi")


ITEM_FIELDS = ("label", "website", "industry", "lei", "legal_form", "parent", "parent_id", "inception", "dissolved", "coord", "hq", "opencorporates")
ITEMS = "qid string, " + ", ".join(f"{f} string" for f in ITEM_FIELDS)


def ask_items(get: Get, endpoint: str, query: str, pauses: tuple[float, ...] = PAUSES):
    """For ask_missing: items by their ids from a SPARQL service. query holds {ids}; an id that the service does
    not know gets a row of nulls, so that it is not asked for again."""

    def ask(rows: pd.DataFrame) -> Iterator[dict]:
        ids = [q for q in rows["qid"] if q[:1] == "Q" and q[1:].isdigit()]
        if not ids:
            return
        body = persistent(get, endpoint, {"query": query.replace("{ids}", " ".join(f"wd:{q}" for q in ids)), "format": "json"}, pauses)
        found: dict[str, dict] = {}
        for b in json.loads(body)["results"]["bindings"]:
            value = {k: v["value"] for k, v in b.items()}
            own = {"qid": value["item"].rsplit("/", 1)[-1], **{f: value.get(f) for f in ITEM_FIELDS}}
            for day in ("inception", "dissolved"):
                own[day] = (own[day] or "")[:10] or None
            if own["parent_id"]:
                own["parent_id"] = own["parent_id"].rsplit("/", 1)[-1]
            found.setdefault(own["qid"], own)
        for q in ids:
            yield found.get(q, {"qid": q})

    return ask


POSITIONS = "key string, latitude double, longitude double, precision string, state string"
# Kinds of a found place that are no house.
_STREET_KINDS = ("road", "street", "pedestrian", "highway")


def address_key(street: Column, postcode: Column, city: Column) -> Column:
    """What answers about an address are kept under."""
    return F.array_join(F.array(*[F.trim(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"\s+", " ")) for c in (street, postcode, city)]), "|")


def ask_positions(get: Get, endpoint: str, pauses: tuple[float, ...] = PAUSES, gap: float = 1.0):
    """For ask_missing over rows (key, street, postcode, city): the position by the whole address, else by
    postcode and city, else by the city; an address that none finds gets a row of nulls."""

    def ask(rows: pd.DataFrame) -> Iterator[dict]:
        for r in rows.fillna("").to_dict("records"):
            steps = [("postcode", {"postalcode": r["postcode"], "city": r["city"]}), ("city", {"city": r["city"]})]
            if r["street"]:
                steps.insert(0, ("house", {"street": r["street"], **steps[0][1]}))
            own = {"key": r["key"]}
            for precision, params in steps:
                time.sleep(gap)
                places = json.loads(persistent(get, endpoint, {"format": "jsonv2", "limit": 1, "countrycodes": "de", "addressdetails": 1, **params}, pauses))
                if places:
                    p = places[0]
                    if precision == "house" and p.get("addresstype") in _STREET_KINDS:
                        precision = "street"
                    own |= {"latitude": float(p["lat"]), "longitude": float(p["lon"]), "precision": precision, "state": p.get("address", {}).get("state")}
                    break
            yield own

    return ask


ANSWERS = "query string, hits array<struct<rank: int, url: string, title: string, content: string, engines: array<string>>>"


def ask_searches(get: Get, endpoint: str):
    """For ask_missing over rows (query): a search service's hits. A refusal or silence of its engines is no answer."""

    def ask(rows: pd.DataFrame) -> Iterator[dict]:
        for query in rows["query"]:
            got = get(endpoint, {"q": query, "format": "json", "language": "de-DE"})
            try:
                data = json.loads(got[2]) if got and got[0] < 400 else None
            except ValueError:
                data = None
            if data is None or (not data.get("results") and data.get("unresponsive_engines")):
                continue
            hits = []
            for i, h in enumerate(data.get("results", []), 1):
                if str(h.get("url")).startswith("http"):
                    hits.append((min(h.get("positions") or [i]), h["url"], h.get("title") or "", h.get("content") or "", h.get("engines") or []))
            yield {"query": query, "hits": hits}

    return ask


def robots_allow(text: str) -> bool:
    """Only a rule for all agents that shuts the whole host counts."""
    for_all = False
    for line in text.lower().splitlines()[:400]:
        name, _, value = (part.strip() for part in line.partition(":"))
        if name == "user-agent":
            for_all = value == "*"
        elif name == "disallow" and for_all and value == "/":
            return False
    return True


HOMES = "host string, status string, url string, html string"


def ask_homes(get: Get):
    """For ask_missing over rows (host): the first page; status robots, blocked, dead, or null where it came."""

    def ask(rows: pd.DataFrame) -> Iterator[dict]:
        for host in rows["host"]:
            rules = get(f"https://{host}/robots.txt", {})
            if rules and rules[0] == 200 and not robots_allow(rules[2].decode("utf-8", "replace")):
                yield {"host": host, "status": "robots"}
                continue
            codes = []
            for scheme in ("https", "http"):
                got = get(f"{scheme}://{host}/", {})
                if got and got[0] < 400:
                    yield {"host": host, "url": got[1], "html": got[2][:PAGE_BYTES].decode("utf-8", "replace")}
                    break
                codes += [got[0]] if got else []
            else:
                yield {"host": host, "status": "blocked" if codes and all(c in (401, 403, 429, 503) for c in codes) else "dead"}

    return ask


IMPRINTS = "host string, imprint_url string, imprint_html string"


def ask_imprints(get: Get):
    """For ask_missing over rows (host, links): the first of two linked pages that comes, else nulls."""

    def ask(rows: pd.DataFrame) -> Iterator[dict]:
        for host, links in zip(rows["host"], rows["links"], strict=True):
            for url in list(links)[:2]:
                got = get(url, {})
                if got and got[0] < 400:
                    yield {"host": host, "imprint_url": got[1], "imprint_html": got[2][:PAGE_BYTES].decode("utf-8", "replace")}
                    break
            else:
                yield {"host": host}

    return ask


def site_records(homes: DataFrame, imprints: DataFrame) -> DataFrame:
    """host, status, final_host, imprint_url, text of homes (HOMES) and imprints (IMPRINTS).

    status: what the fetch said; parked; ok or ok_redirected with an imprint, on a page of its own or on the
    first one; else redirect_offdomain or no_impressum, with the first page's text.
    """
    own = S.page_text(F.col("html"))
    said = F.lower(own)
    any_of = lambda words: F.exists(F.array(*map(F.lit, words)), lambda w: said.contains(w))
    final = plain_host(F.col("url"))
    h = homes.withColumns({"final_host": final, "moved": F.coalesce(registered(final) != registered(F.col("host")), F.lit(False)), "home": own}).withColumns(
        {"parked": (F.length("home") < 2000) & any_of(C.PARKED_WORDS), "here": any_of(["impressum", "angaben gemäß"])}
    )
    h = h.join(imprints, "host", "left")
    linked, shut = F.col("imprint_html").isNotNull(), F.col("status").isNotNull() | F.col("parked")
    status = (
        F.when(F.col("status").isNotNull(), F.col("status"))
        .when(F.col("parked"), "parked")
        .when(linked | F.col("here"), F.when(F.col("moved"), "ok_redirected").otherwise("ok"))
        .otherwise(F.when(F.col("moved"), "redirect_offdomain").otherwise("no_impressum"))
    )
    return h.select(
        "host",
        status.alias("status"),
        "final_host",
        F.when(~shut, F.when(linked, F.col("imprint_url")).when(F.col("here"), F.col("url"))).alias("imprint_url"),
        F.when(~shut, F.when(linked, S.page_text(F.col("imprint_html"))).otherwise(F.col("home"))).alias("text"),
    )


def fetch_sites(spark: SparkSession, hosts: DataFrame, folder: str, get: Get = http_get, tasks: int = 4) -> DataFrame:
    """site_records of hosts (host); first pages and imprints are kept below the folder and asked for once."""
    homes = ask_missing(spark, hosts.select("host"), "host", f"{folder}/homes", ask_homes(get), HOMES, tasks)
    links = homes.where("status IS NULL").select("host", S.imprint_links(F.col("html"), F.col("url")).alias("links")).where("size(links) > 0")
    return site_records(homes, ask_missing(spark, links, "host", f"{folder}/imprints", ask_imprints(get), IMPRINTS, tasks))


def resolve(host: str) -> bool:
    try:
        return bool(socket.getaddrinfo(host, 443, proto=socket.IPPROTO_TCP))
    except OSError:
        return False


NAMES = "host string, exists boolean"


def ask_names(known: Callable[[str], bool] = resolve):
    """For ask_missing over rows (host): whether the name resolves."""

    def ask(rows: pd.DataFrame) -> Iterator[dict]:
        for host in rows["host"]:
            yield {"host": host, "exists": known(host)}

    return ask
