"""Classes of website hosts: seeded lists, and what the rows that share a host tell."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import site as S
from ..functions.text import name_key
from ..functions.url import listed


@dataclass
class Seeds:
    """Hosts known beforehand; a host below one of them counts as well. Later lists win."""

    directory: list[str] = field(default_factory=list)
    social: list[str] = field(default_factory=lambda: C.SOCIAL_HOSTS)
    parcel: list[str] = field(default_factory=lambda: C.PARCEL_HOSTS)
    chain: list[str] = field(default_factory=list)
    own: list[str] = field(default_factory=lambda: C.OWN_HOSTS)


def host_statistics(rows: DataFrame) -> DataFrame:
    """host, rows, names, brand_share of rows(host, name): one partial aggregate, no list of names."""
    named = rows.select("host", F.nullif(name_key(F.col("name")), F.lit("")).alias("key"), S.names_brand(F.col("name"), S.brand_tokens(F.col("host"))).cast("int").alias("hit"))
    return named.groupBy("host").agg(F.count("*").alias("rows"), F.count_distinct("key").alias("names"), F.avg("hit").alias("brand_share"))


def host_kinds(rows: DataFrame, seeds: Seeds) -> DataFrame:
    """rows(id, name, host) with kind: own, directory, social, parcel or chain; null without a host.

    A host that many rows share is a directory where nearly all of them have names of their own and
    few name its brand, else a chain.
    """
    seeded = F.lit("own")
    for kind in ("directory", "social", "parcel", "chain"):
        hosts = getattr(seeds, kind)
        if hosts:
            seeded = F.when(listed(F.col("host"), hosts, seeds.own), kind).otherwise(seeded)
    rows = rows.withColumn("seeded", F.when(F.col("host").isNotNull(), seeded))
    free = (F.col("seeded") == "own") & ~F.col("host").isin(seeds.own)
    stats = host_statistics(rows.where(free)).where(F.col("rows") >= C.CHAIN_ROWS)
    directory = (F.col("rows") >= C.DIRECTORY_ROWS) & (F.col("names") >= C.DIRECTORY_NAMES * F.col("rows")) & (F.col("brand_share") <= C.DIRECTORY_BRAND)
    learned = stats.select(F.col("host").alias("l_host"), F.when(directory, "directory").otherwise("chain").alias("learned"))
    out = rows.join(learned, F.col("host") == F.col("l_host"), "left")
    return out.withColumn("kind", F.coalesce("learned", "seeded")).drop("l_host", "learned", "seeded")


def top_hosts(kinds: DataFrame, top: int) -> DataFrame:
    """The hosts of most rows of each learned kind; the limit is the feature."""
    counts = kinds.where("kind IN ('directory', 'chain')").groupBy("kind", "host").agg(F.count("*").alias("n"))
    order = Window.partitionBy("kind").orderBy(F.desc("n"), "host")
    return counts.withColumn("place", F.row_number().over(order)).where(F.col("place") <= top)
