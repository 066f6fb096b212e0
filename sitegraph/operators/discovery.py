"""Sites for companies without one: labels that exist, hosts from searches, and which of them wins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import site as S
from ..functions.similarity import partial_ratio, ratio, token_set_ratio
from ..functions.url import plain_host, registered

#: Letters that blocks of the prefix join share, labels looked at for a name and for its first word, labels kept.
BLOCK, NAME_LABELS, WORD_LABELS, KEPT = 5, 50, 200, 5


def label_candidates(companies: DataFrame, labels: DataFrame) -> DataFrame:
    """id, label, place: existing labels (label) that look like a company's name (id, name, form, city).

    Guessed labels come first, then labels that begin with the whole name, then those that begin with its
    first distinctive word and go on with another word of it; shorter ones first, KEPT at most. Prefixes
    meet labels by an equi-join on their first letters, each distinct prefix once.
    """
    c = companies.select(
        "id", S.name_tokens(F.col("name")).alias("toks"), S.distinctive(F.col("name")).alias("own"),
        S.domain_guesses(F.col("name"), F.col("form")).alias("guesses"), S.name_tokens(F.col("city")).alias("town"),
    )
    c = c.withColumns({"joined": F.array_join("toks", ""), "hyphen": F.array_join("toks", "-")}).where((F.size("own") > 0) & (F.length("joined") >= 5))
    one, many = c.where((F.size("toks") == 1) & (F.length("joined") >= 7)), c.where(F.size("toks") > 1)
    labels = labels.where(F.col("label").rlike("^[a-z0-9-]+$")).select("label").distinct()
    exact = one.select("id", F.col("joined").alias("label"), F.lit(0).alias("stage"), F.lit(0).alias("at"))
    guessed = many.select("id", F.posexplode("guesses").alias("at", "host")).where(F.col("host").endswith(".de"))
    guessed = guessed.select("id", F.expr("left(host, length(host) - 3)").alias("label"), F.lit(0).alias("stage"), "at")
    known = exact.unionByName(guessed).join(labels, "label")
    starts = many.select("id", F.posexplode(F.array_distinct(F.array("joined", "hyphen"))).alias("at", "start"))
    starts = starts.select("id", (F.col("at") + 1).alias("stage"), "start", F.lit(NAME_LABELS).alias("most"), F.lit(None).cast("array<string>").alias("others"))
    first = F.element_at("own", 1)
    others = F.array_union(F.array_union(F.slice("toks", 2, F.greatest(F.size("toks") - 1, F.lit(1))), S.among(C.LABEL_SUFFIXES)), F.coalesce("town", F.array().cast("array<string>")))
    word = many.where(F.length(first) >= 6).select("id", F.lit(3).alias("stage"), first.alias("start"), F.lit(WORD_LABELS).alias("most"), others.alias("others"))
    asked = starts.unionByName(word)
    prefixes = asked.select("start", "most").distinct().withColumn("block", F.substring("start", 1, BLOCK))
    met = prefixes.join(labels.withColumn("block", F.substring("label", 1, BLOCK)), "block").where(F.startswith("label", "start"))
    met = met.withColumn("nth", F.row_number().over(Window.partitionBy("start", "most").orderBy("label"))).where("nth <= most")
    found = asked.join(met.select("start", "most", "label"), ["start", "most"])
    rest = F.trim(F.expr("substring(label, length(start) + 1)"), F.lit("-"))
    bare = F.regexp_replace(rest, "[-0-9]", "")
    goes_on = (rest == "") | F.array_contains("others", rest) | F.array_contains("others", bare) | F.exists("others", lambda o: (F.length(o) >= 4) & rest.startswith(o))
    fits = F.when(F.col("stage") < 3, F.length("label") <= F.length("start") + 12).otherwise(goes_on)
    found = found.where(fits).select("id", "label", "stage", F.length("label").alias("at"))
    every = known.unionByName(found).groupBy("id", "label").agg(F.min(F.struct("stage", "at")).alias("best"))
    order = Window.partitionBy("id").orderBy("best", "label")
    ranked = every.withColumn("place", F.row_number().over(order)).withColumn("earlier", F.count_if(F.col("best.stage") < 3).over(Window.partitionBy("id")))
    # The last way is tried only where the others leave room.
    return ranked.where((F.col("place") <= KEPT) & ((F.col("best.stage") < 3) | (F.col("earlier") < KEPT))).select("id", "label", "place")


def host_frequency(hits: DataFrame) -> DataFrame:
    """host, companies: over how many companies a registered domain was found."""
    return hits.groupBy(registered(plain_host(F.col("url"))).alias("host")).agg(F.count_distinct("id").alias("companies")).where("host IS NOT NULL")


def search_features(hits: DataFrame, lists: list[str]) -> DataFrame:
    """What a company's (id, name, city, postcode, street) hits (query, rank, engine, url, title, content)
    show of each registered domain: counts, the best rank, which facts are met (the legal form where hits have
    a form), and how alike its titles, texts and label are to the name."""
    h = hits.withColumn("host", registered(plain_host(F.col("url")))).where("host IS NOT NULL")
    title, text = S.name_key(F.col("title")), F.concat_ws(" ", S.name_key(F.col("title")), S.name_key(F.col("content")), F.lower("url"))
    holds = lambda c: (c != "") & text.contains(c)
    raw = F.concat_ws(" ", "title", "content")
    label = F.substring_index("host", ".", 1)
    toks = S.name_tokens(F.col("name"))
    flags = {
        "city_in": holds(S.name_key(F.col("city"))),
        "plz_in": (F.trim(F.coalesce("postcode", F.lit(""))) != "") & raw.contains(F.trim("postcode")),
        "street_in": holds(S.name_key(F.col("street"))),
        "label_is_key": (label == F.array_join(toks, "")) | (label == F.array_join(toks, "-")),
        "name_in_title": (S.name_key(F.col("name")) != "") & title.contains(S.name_key(F.col("name"))),
    }
    if "form" in hits.columns:
        flags["legal_form_in_title"] = (F.trim("form") != "") & F.lower("title").contains(F.lower("form"))
    likeness = {
        "sim_title": token_set_ratio(S.name_key(F.col("name")), title) / 100,
        "sim_snippet": partial_ratio(S.name_key(F.col("name")), S.name_key(F.col("content"))) / 100,
        "sim_host": ratio(F.array_join(toks, ""), F.replace(label, F.lit("-"), F.lit(""))) / 100,
    }
    h = h.withColumns({k: F.coalesce(v, F.lit(False)).cast("int") for k, v in flags.items()} | likeness)
    return h.groupBy("id", "host").agg(
        F.min("rank").alias("best_rank"), F.count("*").alias("n_hits"), F.count_distinct("query").alias("n_queries"), F.count_distinct("engine").alias("n_engines"),
        *[F.max(k).alias(k) for k in [*flags, *likeness]],
    ).withColumns({"listed": F.coalesce(S.listed_host(F.col("host"), lists), F.lit(False)).cast("int"), "tld_de": F.col("host").endswith(".de").cast("int"), "label_len": F.length(F.substring_index("host", ".", 1))})


def best_verified(candidates: DataFrame) -> DataFrame:
    """Of each company's candidates (id, place, host, said, ok) the one taken: name and postcode before
    the name alone, then the earlier one."""
    taken = candidates.where(F.col("ok"))
    best = F.min_by(F.struct("host", "said"), F.struct(F.when(F.col("said") == "name+plz", 0).otherwise(1), F.col("place"), F.col("host")))
    return taken.groupBy("id").agg(best.alias("b")).select("id", "b.host", "b.said")


def top_candidates(scored: DataFrame, least: float, top: int) -> DataFrame:
    """The hosts of most probability of each company (id, host, p, listed); top is the feature."""
    order = Window.partitionBy("id").orderBy(F.desc("p"), "host")
    return scored.where((F.col("p") >= least) & ~F.col("listed")).withColumn("place", F.row_number().over(order)).where(F.col("place") <= top)


def residual(rows: DataFrame, verdicts: list[str], industrial: bool | None = None) -> DataFrame:
    """Named rows without a verified site that a further route may find one for."""
    blank = lambda c: F.trim(F.coalesce(c, F.lit(""))) == ""
    tests = [~blank(F.col("name")), F.col("website").isNull() | F.coalesce(F.col("website_verified").isin(verdicts), F.lit(False))]
    if industrial is not None:
        tests.append(F.col("is_industrial") == industrial)
    return rows.where(reduce(lambda a, b: a & b, tests))
