"""Selections, extracts and nested tiers of the published table."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass
class Dataset:
    """A toggle: which rows of one source are shown. matched and only look at the number of sources;
    groups None shows all groups, an empty list none."""

    source: str
    matched: bool = True
    only: bool = True
    groups: list[str] | None = None
    column: str = "business_type"


@dataclass
class Selection:
    """What a reader of the table asked for; conditions are joined by AND, datasets by OR."""

    state: str | None = None
    district: str | None = None
    sector: str | None = None
    industrial: bool | None = None
    bbox: tuple[float, float, float, float] | None = None
    ids: list[str] | None = None
    q: str | None = None
    datasets: list[Dataset] | None = field(default=None)

    def where(self) -> Column:
        tests = [F.lit(True)]
        if self.state:
            tests.append(F.col("state") == self.state)
        if self.district:
            tests.append(F.col("district_ags" if self.district.isdigit() else "district") == self.district)
        if self.sector:
            tests.append(F.col("business_type") == self.sector)
        if self.industrial is not None:
            tests.append(F.col("is_industrial") == self.industrial)
        if self.bbox:
            west, south, east, north = self.bbox
            tests.append(F.col("longitude").between(west, east) & F.col("latitude").between(south, north))
        if self.ids is not None:
            tests.append(F.col("id").isin(self.ids))
        if self.q:
            tests.append(F.lower("name").contains(self.q.lower()))
        if self.datasets is not None:
            tests.append(reduce(lambda a, b: a | b, [self._shown(d) for d in self.datasets], F.lit(False)))
        return reduce(lambda a, b: a & b, tests)

    @staticmethod
    def _shown(d: Dataset) -> Column:
        inside = F.array_contains(F.split("source", r"\+"), d.source)
        if d.groups is not None:
            inside = inside & (F.col(d.column).isin(d.groups) if d.groups else F.lit(False))
        if not d.matched:
            inside = inside & (F.col("source_count") < 2)
        if not d.only:
            inside = inside & (F.col("source_count") >= 2)
        return inside if d.matched or d.only else F.lit(False)


def extract_cube(rows: DataFrame, scope: str) -> DataFrame:
    """Each row under (its state, the whole scope) x (its sector, is_industrial if it is, all)."""
    areas = F.array_compact(F.array(F.col("state"), F.lit(scope)))
    sectors = F.array_compact(F.array(F.col("business_type"), F.when(F.col("is_industrial"), "is_industrial"), F.lit("all")))
    return rows.withColumn("area", F.explode(areas)).withColumn("sector", F.explode(sectors))


def extents(rows: DataFrame, by: str, low: float = 0.005, high: float = 0.995) -> DataFrame:
    """Per group n, and west, east, south, north: the quantiles low and high of longitude and latitude, in millionths.

    A quantile lies between the two values around its rank and is rounded once (a fused multiply-add): positions
    on half a millionth are common and go up or down by the last bit. Equal values are counted before they are ordered.
    """
    axes = F.array(*[F.struct(F.lit(c).alias("axis"), F.col(c).alias("v")) for c in ("longitude", "latitude")])
    counts = rows.select(by, F.inline(axes)).groupBy(by, "axis", "v").agg(F.count("*").alias("c"))
    group = Window.partitionBy(by, "axis")
    upto = F.sum("c").over(group.orderBy(F.asc_nulls_last("v")))
    counts = counts.withColumns({"total": F.sum(F.when(F.col("v").isNotNull(), F.col("c"))).over(group), "upto": upto})
    rank = {"low": (F.col("total") - 1) * F.lit(low), "high": (F.col("total") - 1) * F.lit(high)}
    value = lambda r: F.min(F.when(F.col("upto") > r, F.col("v")))
    ends = [value(cut(r)).alias(f"{end}_{cut.__name__}") for end, r in rank.items() for cut in (F.floor, F.ceil)]
    ends = counts.groupBy(by, "axis", "total").agg(F.sum("c").alias("n"), *ends)
    part = {end: r - F.floor(r) for end, r in rank.items()}
    fused = lambda end: F.java_method(F.lit("java.lang.Math"), F.lit("fma"), F.col(f"{end}_floor"), F.lit(1.0) - part[end], F.col(f"{end}_ceil") * part[end]).cast("double")
    found = ends.select(by, "axis", "n", *[F.floor(F.when(F.col("total") > 0, fused(end)) * 1e6 + 0.5).cast("long").alias(end) for end in rank])
    side = lambda axis, end, name: F.max(F.when(F.col("axis") == axis, F.col(end))).alias(name)
    return found.groupBy(by).agg(
        F.max("n").alias("n"), side("longitude", "low", "west"), side("longitude", "high", "east"), side("latitude", "low", "south"), side("latitude", "high", "north")
    )


def search(rows: DataFrame, q: str, limit: int) -> DataFrame:
    """Names that hold q, those that begin with it first, then the shorter ones; limit is the feature."""
    q = q.strip().lower()
    if len(q) < 2:
        return rows.limit(0)
    name = F.lower("name")
    return rows.where(name.contains(q)).orderBy(F.desc(name.startswith(q)), F.length("name"), "id").limit(limit)


def page(rows: DataFrame, offset: int, limit: int | None) -> DataFrame:
    """The serving order, and a part of it."""
    out = rows.orderBy(F.asc_nulls_last("state"), F.asc_nulls_last("district"), "id").offset(offset)
    return out if limit is None else out.limit(limit)


def nest_members(clusters: DataFrame, members: DataFrame, fields: list[str]) -> DataFrame:
    """clusters (id, member_ids) with one list of structs per source, null where a source has none."""
    links = clusters.select(F.col("id").alias("company"), F.explode(F.split("member_ids", r"\|")).alias("member"))
    rows = links.join(members, F.col("member") == F.col("id")).groupBy("company", "source").agg(
        F.array_sort(F.collect_list(F.struct(F.col("member").alias("id"), *[F.col(f) for f in fields]))).alias("rows")
    )
    nested = rows.groupBy("company").agg(F.map_from_entries(F.collect_list(F.struct("source", "rows"))).alias("nested"))
    return clusters.join(nested, F.col("id") == F.col("company"), "left").drop("company")
