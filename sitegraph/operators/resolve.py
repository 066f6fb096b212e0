"""Entity resolution: blocking by grid cells, the match rules, components and fusion.

Records with equal keys at equal places are one node, so that a name that thousands share does not
make the square of its records in pairs. Nodes meet in 100 m cells and their eight neighbours by an
equi-join; distance is tested before names, names by their lengths before their ratio.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..functions.geo import in_ring, utm
from ..functions.similarity import evidence, reaches, token_sort_ratio
from ..functions.text import name_key
from ..plans.staging import staged


def keyed(companies: DataFrame) -> DataFrame:
    """Adds full and light keys and metric x, y; a frame may bring a ring, dedup_anchor or neither."""
    x, y = utm(F.col("longitude"), F.col("latitude"))
    return companies.withColumns({"kf": name_key(F.col("name")), "kl": name_key(F.col("name"), False), "x": x, "y": y})


def nodes(rows: DataFrame, extra: list[str] = ()) -> DataFrame:
    """Distinct (kf, kl, x, y, extra) of the named rows that may match, node being their least id."""
    anchored = F.coalesce(F.col("dedup_anchor"), F.lit(True)) if "dedup_anchor" in rows.columns else F.lit(True)
    named = (F.col("kf") != "") | (F.col("kl") != "")
    return rows.where(named & anchored).groupBy("kf", "kl", "x", "y", *extra).agg(F.min("doc_id").alias("node"))


def grid_candidates(points: DataFrame) -> DataFrame:
    """Pairs (a, b, a < b) of nodes in the same or neighbouring cells, with both sides' columns.

    A point has one cell; a row with a ring has every cell of its extent, 41 to an axis at most.
    """
    cols = [c for c in points.columns if c != "node"]
    cell = lambda v: F.floor(v / C.GRID_M)
    if "ring" in cols:
        ends = lambda f, k: F.coalesce(f(F.transform("ring", lambda p: p[k])), F.col(k))
        box = [ends(F.array_min, "x"), ends(F.array_max, "x"), ends(F.array_min, "y"), ends(F.array_max, "y")]
    else:
        box = [F.col("x"), F.col("x"), F.col("y"), F.col("y")]
    x0, y0 = cell(box[0]), cell(box[2])
    points = points.withColumns({"x0": x0, "x1": F.least(cell(box[1]), x0 + C.GRID_SPAN), "y0": y0, "y1": F.least(cell(box[3]), y0 + C.GRID_SPAN)})
    left = points.select("*", F.explode(F.sequence("x0", "x1")).alias("cx")).select("*", F.explode(F.sequence("y0", "y1")).alias("cy"))
    wide = points.select("*", F.explode(F.sequence(F.col("x0") - 1, F.col("x1") + 1)).alias("cx")).select(
        "*", F.explode(F.sequence(F.col("y0") - 1, F.col("y1") + 1)).alias("cy")
    )
    a = left.select(F.col("node").alias("a"), "cx", "cy", *[F.col(c).alias(f"a_{c}") for c in cols])
    b = wide.select(F.col("node").alias("b"), "cx", "cy", *[F.col(c).alias(f"b_{c}") for c in cols])
    found = a.join(b, ["cx", "cy"]).where("a < b").drop("cx", "cy")
    return found.dropDuplicates(["a", "b"]) if "ring" in cols else found


def matches(pairs: DataFrame, contains: Column | None = None) -> DataFrame:
    """(a, b, ratio) of the pairs that the rules accept; contains: one side's ring holds the other's point."""
    dist = F.sqrt(F.pow(F.col("a_x") - F.col("b_x"), 2) + F.pow(F.col("a_y") - F.col("b_y"), 2))
    inside = contains if contains is not None else F.lit(False)
    near = pairs.withColumns({"dist": dist, "inside": inside}).where((F.col("dist") <= C.SAME_M) | F.col("inside"))
    floor = F.when(F.col("inside"), C.CONTAIN_RATIO).otherwise(C.NEAR_RATIO)
    long_enough = reaches(F.col("a_kf"), F.col("b_kf"), C.CONTAIN_RATIO) | reaches(F.col("a_kl"), F.col("b_kl"), C.CONTAIN_RATIO)
    near = near.where(long_enough)
    equal = ((F.col("a_kf") == F.col("b_kf")) & (F.col("a_kf") != "")) | ((F.col("a_kl") == F.col("b_kl")) & (F.col("a_kl") != ""))
    ratio = F.greatest(token_sort_ratio("a_kf", "b_kf"), token_sort_ratio("a_kl", "b_kl"))
    full, light = evidence(F.col("a_kf"), F.col("b_kf")), evidence(F.col("a_kl"), F.col("b_kl"))
    scored = near.withColumn("equal", equal).withColumn("ratio", ratio).where(F.col("ratio") >= floor)
    best = lambda f: F.greatest(full[f], light[f])
    substance = (best("shared") >= C.SHARED_TOKENS) | (best("chars") >= C.SHARED_CHARS) | (F.col("ratio") >= C.SPELLING_RATIO)
    same = (F.col("ratio") >= C.SAME_RATIO) & (F.col("dist") <= C.SAME_M)
    close = (F.col("dist") <= C.NEAR_M) & (F.col("ratio") >= C.NEAR_RATIO) & substance
    held = F.col("inside") & (best("least") >= C.CONTAIN_TOKENS) & (F.col("ratio") >= C.CONTAIN_RATIO)
    return scored.where(same | close | held).select("a", "b", "ratio")


def ring_contains() -> Column:
    """For pairs with a_ring and b_ring: the ring of one holds the other's point, null rings hold none."""
    one = F.coalesce(in_ring(F.col("b_x"), F.col("b_y"), F.col("a_ring")), F.lit(False))
    two = F.coalesce(in_ring(F.col("a_x"), F.col("a_y"), F.col("b_ring")), F.lit(False))
    return one | two


def components(edges: DataFrame, most_rounds: int = 50) -> DataFrame:
    """(vertex, root) of all vertices of edges (a, b): the least vertex of each component.

    Each round a vertex takes the least label around it and then that label's own label, so the
    number of rounds follows the logarithm of the longest path.
    """
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    both = staged(both.where("u <> v").distinct(), "edges")
    labels = staged(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("root")).withColumnRenamed("u", "vertex"), "labels")
    for _ in range(most_rounds):
        around = both.join(labels, both.v == labels.vertex).groupBy("u").agg(F.min("root").alias("near"))
        step = labels.join(around, F.col("vertex") == F.col("u")).select("vertex", "root", F.least("root", "near").alias("next"))
        heads = labels.select(F.col("vertex").alias("h"), F.col("root").alias("h_root"))
        after = step.join(heads, F.col("next") == F.col("h"), "left").select("vertex", F.coalesce("h_root", "next").alias("root"), (F.coalesce("h_root", "next") != F.col("root")).alias("moved"))
        after = staged(after, "labels")
        moved = after.where("moved").limit(1).count()
        labels = after.select("vertex", "root")
        if not moved:
            return labels
    raise RuntimeError("the components did not settle")


def clusters(companies: DataFrame) -> DataFrame:
    """Each row of companies with root, the least doc_id of its cluster."""
    rows = keyed(companies)
    extra = ["ring"] if "ring" in rows.columns else []
    points = nodes(rows, extra)
    edges = matches(grid_candidates(points), ring_contains() if extra else None)
    roots = components(edges.select("a", "b"))
    keys = ["kf", "kl", "x", "y", *extra]
    near = points.join(roots, F.col("node") == F.col("vertex"), "left").select(*[F.col(k).alias(f"n_{k}") for k in keys], F.coalesce("root", "node").alias("node_root"))
    same = None
    for k in keys:
        test = F.col(k).eqNullSafe(F.col(f"n_{k}"))
        same = test if same is None else same & test
    out = rows.join(near, same, "left")
    anchored = F.coalesce(F.col("dedup_anchor"), F.lit(True)) if "dedup_anchor" in rows.columns else F.lit(True)
    return out.select(*companies.columns, F.when(anchored, F.col("node_root")).otherwise(F.lit(None)).alias("r")).withColumn("root", F.coalesce("r", "doc_id")).drop("r")


def priority(source: Column) -> Column:
    """The place of a row's first source in the order that decides fields."""
    first = F.split(source, r"\+")[0]
    at = F.array_position(F.array(*[F.lit(s) for s in C.SOURCE_PRIORITY]), first)
    return F.when(at > 0, at - 1).otherwise(len(C.SOURCE_PRIORITY)).cast("int")


def fuse(rows: DataFrame, fields: list[str], provenance: list[str] = ()) -> DataFrame:
    """One row a root: each field from the first member, by source priority and doc_id, that has it."""
    rows = rows.withColumn("ord", F.struct(priority(F.col("source")).alias("p"), "doc_id"))
    first = lambda c, k: F.min_by(c, F.when(F.col(k).isNotNull(), F.col("ord"))).alias
    sources = F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.split("source", r"\+")))))
    members = F.transform(F.array_sort(F.collect_list(F.struct("ord", "id"))), lambda m: m["id"])
    out = rows.groupBy("root").agg(
        *[first(F.col(f), f)(f) for f in fields],
        *[first(F.col("source"), f)(f"{f}_source") for f in provenance],
        sources.alias("sources"),
        members.alias("members"),
    )
    return out.withColumns(
        {
            "source": F.array_join("sources", "+"),
            "source_count": F.size("sources").cast("long"),
            "member_ids": F.when(F.size("members") > 1, F.array_join("members", "|")),
        }
    ).drop("sources", "members")


def confidence(multi: Column, website: Column, address: Column, polygon: Column, phone: Column, area: Column, coarse: Column | None = None) -> Column:
    """The sum of the weights that hold, in hundredths and back, capped where the position is coarse."""
    w, has = C.CONFIDENCE_WEIGHTS, {"multi_source": multi, "has_website": website, "has_address": address, "has_polygon": polygon, "has_phone": phone, "has_area": area}
    total = sum((F.when(F.coalesce(test, F.lit(False)), round(100 * w[k])).otherwise(0) for k, test in has.items()), F.lit(0))
    score = total.cast("double") / F.lit(100.0)
    return score if coarse is None else F.when(F.coalesce(coarse, F.lit(False)), F.least(score, F.lit(C.COARSE_CAP))).otherwise(score)
