"""From the sources' own tables to rows of companies: filters, site aggregates and register tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import record as R
from ..functions import text as T
from ..functions.geo import metres_to_ring


def first_of(column: str, order: str) -> Column:
    """The first value of a group that is there, in the order of another column."""
    return F.min_by(column, F.when(F.col(column).isNotNull(), F.col(order)))


def report_rows(raw: DataFrame) -> DataFrame:
    """Rows of the latest report year that are installations in use: raw(year, kind, status, ...)."""
    last = raw.agg(F.max("year").alias("last"))
    return raw.join(F.broadcast(last), F.col("year") == F.col("last")).where("kind = 'IED' AND status = 'functional'").drop("last")


def potentials(raw: DataFrame, numbers: list[str]) -> DataFrame:
    """Every column of the workbook with its site's id; numbers as such, other cells trimmed, blanks as nulls."""
    cells = [
        F.col(c).try_cast("double").alias(c) if c in numbers else F.when(~F.lower(F.trim(c)).isin("", "nan"), F.trim(c)).alias(c)
        for c in raw.columns
    ]
    return raw.select(R.site_id(F.col("uid"), F.col("street"), F.trim("postcode")).alias("site_id"), *cells)


def heat_sites(raw: DataFrame) -> DataFrame:
    """One row a site of raw(uid, street, postcode, row, name, email, potential, heat, power, temperature): sums,
    the temperature weighted by heat (a plain mean where no heat is given), the first potentials' names."""
    key = F.concat_ws("|", F.col("uid").cast("string"), F.lower(F.trim("street")), F.trim("postcode"))
    weight = F.when((F.col("heat") > 0) & F.col("temperature").isNotNull(), F.col("heat"))
    rows = raw.withColumns({"key": key, "w": weight, "wt": weight * F.col("temperature")})
    names = rows.where("potential IS NOT NULL").groupBy("key", "potential").agg(F.min("row").alias("at")).groupBy("key").agg(
        F.array_join(F.slice(F.transform(F.array_sort(F.collect_list(F.struct("at", "potential"))), lambda x: x["potential"]), 1, 5), "|").alias("potential_names")
    )
    # With heat and temperatures in the site but on no common row, the plain mean holds.
    mean = F.coalesce(F.try_divide(F.sum("wt"), F.sum("w")), F.avg("temperature"))
    sites = rows.groupBy("key").agg(
        F.min_by("name", "row").alias("name"), first_of("email", "row").alias("email"), F.sum("heat").alias("heat"),
        F.sum("power").alias("power"), mean.alias("temperature"), F.count("*").alias("potentials"),
    )
    return sites.join(names, "key", "left").withColumn("potential_names", F.coalesce("potential_names", F.lit("")))


def legal_operators(actors: DataFrame) -> DataFrame:
    """Operators that are neither natural persons nor without a name."""
    return actors.where(~F.coalesce(F.lower("person").contains("natürliche"), F.lit(False)) & F.col("name").isNotNull())


def units_kept(units: DataFrame, any_status: list[str] = ("nuclear",)) -> DataFrame:
    """Units in operation that reach their kind's floor. A kind that the states would drop altogether raises:
    the source has changed its words."""
    runs = F.col("status").isin(C.IN_OPERATION) | F.col("tech").isin(list(any_status))
    lost = units.groupBy("tech").agg(F.count_if(runs).alias("kept")).where("kept = 0").select("tech").collect()
    if lost:
        raise ValueError(f"no unit in operation among {sorted(r['tech'] for r in lost)}")
    floors = F.create_map(*[F.lit(x) for kv in C.FLOOR_KW.items() for x in kv])
    floor = F.try_element_at(floors, F.col("tech"))
    return units.where(runs & (floor.isNull() | F.coalesce(F.col("kw") >= floor, F.lit(False))))


def storage_filled(units: DataFrame, plants: DataFrame) -> DataFrame:
    """units(unit, plant, capacity) with the capacity of the plant's first row where they have none."""
    first = plants.where("capacity IS NOT NULL").groupBy(F.col("plant").alias("p")).agg(F.min_by("capacity", "row").alias("own"))
    return units.join(first, F.col("plant") == F.col("p"), "left").withColumn("capacity", F.coalesce("capacity", "own")).drop("p", "own")


def plausible_units(units: DataFrame, districts: DataFrame, most_metres: float = 10_000.0) -> DataFrame:
    """units(district, lon, lat) with dropped: why a position is not believed; such positions become null.

    A position outside the country's bounds goes, and one too far from the district that the unit names."""
    out = units.join(F.broadcast(districts.select(F.col("district").alias("d"), "ring")), F.col("district") == F.col("d"), "left")
    outside = ~(F.col("lat").between(*C.LAT_BOUNDS) & F.col("lon").between(*C.LON_BOUNDS))
    far = F.col("ring").isNotNull() & (metres_to_ring(F.col("lon"), F.col("lat"), F.col("ring")) > most_metres)
    why = F.when(F.col("lon").isNull() | F.col("lat").isNull(), F.lit(None).cast("string")).when(outside, "bounds").when(far, "district")
    out = out.withColumn("dropped", why)
    clear = lambda c: F.when(F.col("dropped").isNull(), F.col(c))
    return out.withColumns({"lon": clear("lon"), "lat": clear("lat")}).drop("d", "ring")


def unit_sites(units: DataFrame, fields: list[str]) -> DataFrame:
    """One row an operator and place of units(unit, operator, place, tech, name, lat, lon, dropped, *fields).

    A unit without a place is a place of its own. detail is a JSON text: for each kind its units by number,
    each with the fields that it has.
    """
    u = units.withColumn("place", F.coalesce("place", "unit"))
    record = F.struct(F.col("unit"), *[F.col(f) for f in fields])
    techs = u.groupBy("operator", "place", "tech").agg(
        F.array_sort(F.collect_list(record)).alias("list"), F.count("*").alias("n"), first_of("name", "unit").alias("name"),
        F.min(F.when(F.col("name").isNotNull(), F.col("unit"))).alias("name_at"), F.sum("lat").alias("lat"), F.sum("lon").alias("lon"),
        F.count("lat").alias("placed"), F.count("dropped").alias("dropped"),
    )
    return techs.groupBy("operator", "place").agg(
        F.array_join(F.array_sort(F.collect_list("tech")), "+").alias("techs"),
        (F.count_if(~F.col("tech").isin(C.CONSUMERS)) == 0).alias("consumer_only"),
        F.sum("n").alias("units"),
        F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("tech", "list"))))).alias("detail"),
        F.min_by("name", "name_at").alias("name"),
        F.try_divide(F.sum("lat"), F.sum("placed")).alias("lat"),
        F.try_divide(F.sum("lon"), F.sum("placed")).alias("lon"),
        F.sum("dropped").alias("coord_dropped"),
    )


def place_means(frames: list[DataFrame]) -> DataFrame:
    """place, lat, lon: the mean position of each place over several tables of units."""
    every = frames[0].select("place", "lat", "lon")
    for f in frames[1:]:
        every = every.unionByName(f.select("place", "lat", "lon"))
    return every.where("lon IS NOT NULL AND place IS NOT NULL").groupBy("place").agg(F.avg("lat").alias("lat"), F.avg("lon").alias("lon"))


def grid_points(points: DataFrame, means: DataFrame, grids: DataFrame) -> DataFrame:
    """Connection points(id, place, grid) where their place is known, with the grid's name."""
    names = grids.select(F.col("grid").alias("g"), "grid_name")
    return points.join(means, "place").join(names, F.col("grid") == F.col("g"), "left").drop("g")


def latest(rows: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """One row a key: the first in the order."""
    w = Window.partitionBy(key).orderBy(*order)
    return rows.withColumn("nth", F.row_number().over(w)).where("nth = 1").drop("nth")


def register_2022(companies: DataFrame, names: DataFrame, addresses: DataFrame, refs: DataFrame) -> DataFrame:
    """The register's companies (company, dissolved) with their current name, address and reference, and the names
    that they had: names(company, name, valid_from, current, row), addresses(company, address, zip, place, ...),
    refs(company, reference, court, open, seen, row)."""
    current = [F.desc("current"), F.desc_nulls_last("valid_from"), F.desc("row")]
    now = latest(names, "company", current).select("company", "name")
    before = names.join(now.withColumnRenamed("name", "now"), "company").where("name <> now").groupBy("company").agg(F.array_join(F.array_sort(F.collect_set("name")), " | ").alias("previous_names"))
    place = latest(addresses, "company", current).select("company", "address", "zip", "place")
    ref = latest(refs, "company", [F.desc("open"), F.desc("seen"), F.desc("row")])
    parsed = T.register_reference(F.col("reference"))
    ref = ref.select("company", "court", parsed["type"].alias("register_type"), F.concat_ws(" ", parsed["number"], parsed["suffix"]).alias("register_number"))
    out = companies
    for part in (now, place, ref, before):
        out = out.join(part, "company", "left")
    street = T.address_parts(F.col("address"))
    city = R.some(F.when(F.startswith("place", "zip"), F.expr("substring(place, length(zip) + 1)")).otherwise(F.col("place")))
    form = T.legal_form(F.col("name"))
    return out.withColumns({
        "street": street["street"], "housenumber": street["housenumber"], "postcode": F.nullif("zip", F.lit("")), "city": city,
        "status": F.when(F.nullif("dissolved", F.lit("")).isNotNull(), "dissolved").otherwise("active"),
        "legal_form": form["form"], "register_division": F.coalesce("register_type", form["division"]),
        "hr_registration": F.nullif(F.trim(F.concat_ws(" ", "register_type", "register_number")), F.lit("")),
        "key_full": T.name_key(F.col("name")), "key_light": T.name_key(F.col("name"), False),
        "street_key": T.street_key(F.concat_ws(" ", street["street"], street["housenumber"])),
    }).drop("zip", "place", "address")


def name_variants(companies: DataFrame, names: DataFrame) -> DataFrame:
    """Every spelling of a company's name that gives other keys, the current one first."""
    cur = companies.select("company", "name", F.lit(True).alias("current"))
    old = names.join(companies.select("company"), "company", "left_semi").select("company", "name", F.lit(False).alias("current"))
    every = cur.unionByName(old).where("trim(coalesce(name, '')) <> ''")
    every = every.withColumns({"key_full": T.name_key(F.col("name")), "key_light": T.name_key(F.col("name"), False)})
    best = F.min(F.struct((~F.col("current")).alias("old"), "name"))
    return every.groupBy("company", "key_full", "key_light").agg(best.alias("b")).select("company", "key_full", "key_light", F.col("b.name").alias("name"), (~F.col("b.old")).alias("current"))


def register_2019(raw: DataFrame) -> DataFrame:
    """Rows of the nested JSON of 2019, flat; its officers are never read."""
    a = F.col("all_attributes")
    address = T.address_parts(F.col("registered_address"))
    status = F.when(F.lower("current_status").contains("registered"), "active").when(F.col("current_status").isNotNull(), "dissolved").otherwise("unknown")
    return raw.select(
        F.col("company_number").alias("company"), "name", status.alias("status"), a["_registerArt"].alias("register_type"),
        F.concat_ws(" ", a["_registerNummer"], a["_registerNummerSuffix"]).alias("register_number"), a["registrar"].alias("court"),
        address["postcode"].alias("postcode"), F.coalesce(address["city"], a["registered_office"]).alias("city"), address["street"].alias("street"),
        F.array_join(F.transform("previous_names", lambda p: p["company_name"]), " | ").alias("previous_names"),
    )


def lei_rows(raw: DataFrame, country: str, file_name: str) -> DataFrame:
    """The entities of one country, with the date that the file's name begins with."""
    day = F.regexp_extract(F.lit(file_name), r"(\d{4})-?(\d{2})-?(\d{2})", 0)
    return raw.where(F.col("country") == country).withColumn("snapshot_date", F.regexp_replace(day, r"^(\d{4})-?(\d{2})-?(\d{2})$", "$1-$2-$3"))


def tag_rows(raw: DataFrame, kinds: list[str], never: list[str]) -> DataFrame:
    """Places of raw(id, tags, lon, lat): the first of several tags for each field, only those with a business."""
    t, first = F.col("tags"), lambda *k: R.first_tag(F.col("tags"), list(k))
    kind = R.business_kind(t, kinds, never)
    return raw.where(kind.isNotNull()).select(
        F.concat(F.lit("osm_"), "id").alias("id"), first("name", "brand", "operator").alias("name"), kind["kind"].alias("business_type"), kind["value"].alias("business_subtype"),
        first("website", "contact:website", "url").alias("website"), first("phone", "contact:phone").alias("phone"),
        R.address_line(first("addr:street"), first("addr:housenumber"), first("addr:postcode"), first("addr:city")).alias("address"), "lon", "lat",
    )


def taxonomy_rows(raw: DataFrame, types: dict[str, str], dropped: list[str], least: float, states: list[str]) -> DataFrame:
    """Places of raw(id, name, category, root, confidence, country, status, region): named, sure enough, of the
    country, not closed, with their category's type or else their root's; roots that are no business go."""
    table = F.create_map(*[F.lit(x) for kv in types.items() for x in kv])
    kept = (R.some(F.col("name")).isNotNull()) & (F.col("confidence") >= least) & (F.col("country").isNull() | (F.col("country") == "DE"))
    kept = kept & ~F.coalesce(F.col("status").isin("permanently_closed", "temporarily_closed"), F.lit(False)) & ~F.coalesce(F.col("root").isin(dropped), F.lit(False))
    return raw.where(kept).withColumns({
        "business_type": F.coalesce(F.try_element_at(table, F.col("category")), F.try_element_at(table, F.col("root"))),
        "state": F.when(F.col("region").isin(states), F.col("region")),
    })


def first_holder(points: DataFrame, levels: list[DataFrame], cell: float) -> DataFrame:
    """points (id, x, y) with the name of the first polygon (ring, place, name) of each level that holds them."""
    from .geometry import points_in_polygons

    out = points
    for i, polygons in enumerate(levels):
        held = points_in_polygons(points, polygons.select("ring", "place", F.col("name").alias(f"level_{i}")), "place", cell)
        out = out.join(held.select("id", f"level_{i}"), "id", "left")
    return out
