"""The published tables: contract, tiers, files, their manifest, and selections from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as C
from ..functions.geo import in_ring
from ..functions.record import point_of

#: Column, type and default of the contract that every table of companies follows, in order.
CONTRACT = [
    ("id", "string", None), ("name", "string", None), ("business_type", "string", None), ("state", "string", None), ("district", "string", None),
    ("website", "string", None), ("phone", "string", None), ("email", "string", None), ("latitude", "double", None), ("longitude", "double", None),
    ("grounds_area_m2", "double", None), ("legal_form", "string", None), ("source", "string", None), ("source_count", "long", 1),
    ("confidence_score", "double", 0.0), ("is_industrial", "boolean", False),
]


def conform(rows: DataFrame, contract: list[tuple] = CONTRACT) -> DataFrame:
    """The contract's columns in its order and types, defaults for those that lack, further columns behind."""
    own = [F.col(f"`{n}`").cast(t).alias(n) if n in rows.columns else F.lit(v).cast(t).alias(n) for n, t, v in contract]
    names = {n for n, _, _ in contract}
    return rows.select(*own, *[F.col(f"`{c}`") for c in rows.columns if c not in names])


def public_columns(columns: list[str], extra: list[str], contract: list[tuple] = CONTRACT) -> list[str]:
    """What may be published: the contract without private columns, and those of extra that are there."""
    names = [n for n, _, _ in contract]
    return [n for n in names if n in columns and n not in C.PRIVATE_COLUMNS] + [c for c in extra if c in columns and c not in names]


def chosen(rows: DataFrame, fields: list[str]) -> DataFrame:
    """The named fields; names that the table lacks are told all at once."""
    unknown = [f for f in fields if f not in rows.columns]
    if unknown:
        raise ValueError(f"unknown fields: {', '.join(sorted(unknown))}")
    return rows.select(*[F.col(f"`{f}`") for f in fields])


def bbox_of(text: str) -> tuple[float, float, float, float]:
    """west, south, east, north of "w,s,e,n"; anything else is an error."""
    try:
        w, s, e, n = (float(x) for x in text.split(","))
    except ValueError:
        raise ValueError("a box has four numbers: west,south,east,north") from None
    if not (-180 <= w < e <= 180 and -90 <= s < n <= 90):
        raise ValueError("the box is empty or outside the globe")
    return w, s, e, n


def write_tier(rows: DataFrame, folder: str, name: str, by: list[str] = ("state", "district", "id")) -> None:
    """A tier in serving order: ranges of it are files, sorted within, so that readers skip what they need not."""
    order = [F.asc_nulls_last(c) for c in by]
    rows.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").option("compression", "zstd").parquet(f"{folder}/{name}")


def write_cube(cube: DataFrame, folder: str) -> None:
    """An extract for each area and sector, in one pass."""
    cube.withColumns({"for_area": F.col("area"), "for_sector": F.col("sector")}).repartition("area", "sector").write.mode("overwrite").partitionBy("for_area", "for_sector").parquet(folder)


def flat_text(rows: DataFrame) -> DataFrame:
    """Nested columns as JSON texts, for CSV."""
    nested = ("array", "map", "struct")
    return rows.select(*[F.to_json(f"`{n}`").alias(n) if t.startswith(nested) else F.col(f"`{n}`") for n, t in rows.dtypes])


def json_records(rows: DataFrame) -> DataFrame:
    """One JSON text a row: dates as ISO, numbers that are none as nothing, bytes as hex, nulls left out."""
    def plain(name: str, kind: str) -> Column:
        c = F.col(f"`{name}`")
        if kind in ("double", "float"):
            return F.when(~F.isnan(c), c).alias(name)
        if kind == "binary":
            return F.lower(F.hex(c)).alias(name)
        return c.alias(name)

    return rows.select(F.to_json(F.struct(*[plain(n, k) for n, k in rows.dtypes])).alias("record"))


def features(rows: DataFrame, properties: list[str]) -> DataFrame:
    """A GeoJSON feature for each row that has a position; properties without a value are left out."""
    geometry = F.struct(F.lit("Point").alias("type"), F.array("longitude", "latitude").alias("coordinates"))
    body = F.struct(F.lit("Feature").alias("type"), geometry.alias("geometry"), F.struct(*[F.col(p) for p in properties]).alias("properties"))
    return rows.where("longitude IS NOT NULL AND latitude IS NOT NULL").select("id", F.to_json(body).alias("feature"))


def layered_features(layers: dict[str, DataFrame]) -> DataFrame:
    """layer, id, feature of several layers, for a tile builder that reads lines."""
    parts = [features(rows, [c for c in rows.columns if c not in ("longitude", "latitude")]).select(F.lit(k).alias("layer"), "id", "feature") for k, rows in layers.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def file_sums(spark: SparkSession, folder: str) -> DataFrame:
    """path within the folder, size and SHA-256 of every data file; the files are hashed where they are read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(folder)
    return files.select(F.regexp_replace("path", "^.*?" + folder.split("://")[-1].rstrip("/").replace(".", r"\.") + "/", "").alias("path"), F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"))


def publish_version(spark: SparkSession, root: str, version: str) -> None:
    """Writes the manifest of root/version, then the pointer that readers follow: a version without a manifest is
    never taken."""
    file_sums(spark, f"{root}/{version}").withColumn("version", F.lit(version)).coalesce(1).write.mode("overwrite").json(f"{root}/{version}/manifest")
    spark.createDataFrame([(version,)], "version string").coalesce(1).write.mode("overwrite").json(f"{root}/current")


def current_version(spark: SparkSession, root: str, versions: list[str]) -> str | None:
    """The version that the pointer names, else the last one that has a manifest."""
    def there(path: str) -> bool:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)

    if there(f"{root}/current/_SUCCESS"):
        return spark.read.schema("version string").json(f"{root}/current").first()["version"]
    ready = [v for v in sorted(versions) if there(f"{root}/{v}/manifest/_SUCCESS")]
    return ready[-1] if ready else None


def within(rows: DataFrame, ring: list[tuple[float, float]]) -> DataFrame:
    """Rows inside a polygon that a reader drew: the box first, which prunes files, then the ring."""
    xs, ys = [p[0] for p in ring], [p[1] for p in ring]
    box = F.col("longitude").between(min(xs), max(xs)) & F.col("latitude").between(min(ys), max(ys))
    shape = F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in ring])
    return rows.where(box).where(in_ring(F.col("longitude"), F.col("latitude"), shape))


def clipped(rows: DataFrame, rings: list[list[tuple[float, float]]]) -> DataFrame:
    """Positions outside all rings of the scope become null."""
    inside = F.lit(False)
    for ring in rings:
        shape = F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in ring])
        inside = inside | F.coalesce(in_ring(F.col("longitude"), F.col("latitude"), shape), F.lit(False))
    return rows.withColumns({"longitude": F.when(inside, F.col("longitude")), "latitude": F.when(inside, F.col("latitude"))})


def nested_records(members: DataFrame, raw: DataFrame, potentials: DataFrame) -> DataFrame:
    """members(company, source, id) with each one's raw records and potentials, as a list a company and source.

    A record that several members share stands under each of them; partial lists are made before the join.
    """
    records = raw.groupBy(F.col("id").alias("r_id")).agg(F.array_sort(F.collect_list(F.struct("record", "key", F.map_entries("fields").alias("fields")))).alias("raw"))
    heat = potentials.groupBy(F.col("site_id").alias("p_id")).agg(F.array_sort(F.collect_list(F.struct("potential", "heat"))).alias("potentials"))
    rows = members.join(records, F.col("id") == F.col("r_id"), "left").join(heat, F.col("id") == F.col("p_id"), "left")
    return rows.groupBy("company", "source").agg(F.array_sort(F.collect_list(F.struct("id", "potentials", "raw"))).alias("rows"))


def linked_items(rows: DataFrame, items: DataFrame) -> DataFrame:
    """company, role, qid and label of the items that a row names as itself, its operator or its brand."""
    parts = [rows.select(F.col("id").alias("company"), F.lit(role).alias("role"), F.col(c).alias("q")).where("q IS NOT NULL") for role, c in (("entity", "wd_id"), ("operator", "wd_operator_id"), ("brand", "wd_brand_id"))]
    links = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return links.join(items, F.col("q") == F.col("qid")).select("company", "role", "qid", "label")


def picked_attributes(rows: DataFrame, items: DataFrame, columns: list[str]) -> DataFrame:
    """Each attribute from the row's own item, else from its operator's."""
    side = lambda key: items.select(F.col("qid").alias(f"{key}_qid"), *[F.col(c).alias(f"{key}_{c}") for c in columns])
    out = rows.join(side("own"), F.col("wd_id") == F.col("own_qid"), "left").join(side("op"), F.col("wd_operator_id") == F.col("op_qid"), "left")
    return out.select(*rows.columns, *[F.coalesce(f"own_{c}", f"op_{c}").alias(f"wd_{c}") for c in columns])


def unplaced_items(rows: DataFrame, items: DataFrame) -> DataFrame:
    """Items that rows name as operator or brand, never as themselves, within the rows' extent: qid, role, lon, lat."""
    q = lambda c, p: F.percentile(c, F.lit(p))
    box = rows.agg((q("longitude", 0.005) - 0.03).alias("w"), (q("latitude", 0.005) - 0.02).alias("s"), (q("longitude", 0.995) + 0.03).alias("e"), (q("latitude", 0.995) + 0.02).alias("n"))
    named = lambda c: rows.select(F.col(c).alias("q")).where("q IS NOT NULL").distinct()
    roles = named("wd_operator_id").withColumn("r", F.lit(1)).unionByName(named("wd_brand_id").withColumn("r", F.lit(2))).groupBy("q").agg(F.min("r").alias("r"))
    at = point_of(F.col("coord"))
    placed = items.withColumn("at", at).where("at IS NOT NULL").join(named("wd_id"), F.col("qid") == F.col("q"), "left_anti").join(roles, F.col("qid") == F.col("q"))
    return placed.join(F.broadcast(box)).where("at.lon BETWEEN w AND e AND at.lat BETWEEN s AND n").select("qid", F.when(F.col("r") == 1, "operator").otherwise("brand").alias("role"), "at.lon", "at.lat")


def pair_scores(found: DataFrame, truth: DataFrame) -> DataFrame:
    """Precision and recall, in ten-thousandths, of the pairs (a, b) of one linking against another's."""
    f, t = found.distinct().withColumn("f", F.lit(1)), truth.distinct().withColumn("t", F.lit(1))
    n = f.join(t, ["a", "b"], "full").agg(F.count("f").alias("found"), F.count("t").alias("true"), F.count(F.col("f") + F.col("t")).alias("both"))
    part = lambda d: F.coalesce(F.floor(F.try_divide(F.col("both") * 10_000, F.col(d)) + 0.5), F.lit(0)).cast("long")
    return n.select("found", "true", "both", part("found").alias("precision_e4"), part("true").alias("recall_e4"))


def scoped(rows: DataFrame, states: list[str], rings: list[list[tuple[float, float]]]) -> DataFrame:
    """Rows of the wanted states, and those without a state that lie within their boundary."""
    inside = F.lit(False)
    for ring in rings:
        shape = F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in ring])
        inside = inside | F.coalesce(in_ring(F.col("longitude"), F.col("latitude"), shape), F.lit(False))
    return rows.where(F.col("state").isin(states) | (F.col("state").isNull() & inside))


def shown_as_matched() -> Column:
    """Whether the map shows a row as confirmed: several sources, the register, or an item of its own or its operator's."""
    filled = lambda c: F.coalesce(F.col(c), F.lit("")) != ""
    register = F.coalesce(F.col("register_match").isin([*C.MATCH_RANKS, "exact_hrb"]), F.lit(False))
    return (F.col("source_count") > 1) | register | filled("wd_id") | filled("wd_operator_id")
