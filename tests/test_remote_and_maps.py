"""Map extracts, shape files, sources behind a network and the ranker, on small files and made-up services."""

import json
import struct
import sys
import zlib

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from sitegraph.operators import ranker
from sitegraph.sources import maps, remote

# The workers cannot import this file.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def varint(n):
    n &= (1 << 64) - 1
    out = b""
    while n > 127:
        out += bytes([n & 127 | 128])
        n >>= 7
    return out + bytes([n])


def zigzag(n):
    return varint((n << 1) ^ (n >> 63))


def field(number, value):
    if isinstance(value, int):
        return varint(number << 3) + varint(value)
    return varint(number << 3 | 2) + varint(len(value)) + value


def deltas(xs):
    return b"".join(zigzag(b - a) for a, b in zip([0, *xs], xs, strict=False))


class Extract:
    """Writes blocks of elements in the public format."""

    def __init__(self):
        self.out = self.blob(b"OSMHeader", b"")

    @staticmethod
    def blob(kind, data, plain=False):
        body = field(1, data) if plain else field(2, len(data)) + field(3, zlib.compress(data))
        head = field(1, kind) + field(3, len(body))
        return struct.pack(">I", len(head)) + head + body

    def block(self, dense=(), nodes=(), ways=(), relations=(), plain=False):
        table = [""]

        def at(s):
            if s not in table:
                table.append(s)
            return table.index(s)

        pack = lambda xs: b"".join(varint(x) for x in xs)
        tags = lambda t: field(2, pack([at(k) for k in t])) + field(3, pack([at(v) for v in t.values()]))
        place = lambda d: round(d * 1e7)
        group = b""
        if dense:
            marks = [m for _, _, _, t in dense for m in [*(x for k, v in t.items() for x in (at(k), at(v))), 0]]
            group += field(2, field(1, deltas([n[0] for n in dense])) + field(8, deltas([place(n[2]) for n in dense])) + field(9, deltas([place(n[1]) for n in dense])) + field(10, pack(marks)))
        for i, lon, lat, t in nodes:
            number = lambda k, v: varint(k << 3) + zigzag(v)
            group += field(1, number(1, i) + tags(t) + number(8, place(lat)) + number(9, place(lon)))
        for i, t, refs in ways:
            group += field(3, field(1, i) + tags(t) + field(8, deltas(refs)))
        for i, t, members in relations:
            kinds = ["node", "way", "relation"]
            group += field(4, field(1, i) + tags(t) + field(8, pack([at(m[2]) for m in members])) + field(9, deltas([m[1] for m in members])) + field(10, pack([kinds.index(m[0]) for m in members])))
        strings = b"".join(field(1, s.encode()) for s in table)
        self.out += self.blob(b"OSMData", field(1, strings) + field(2, group), plain)


@pytest.fixture(scope="module")
def extract(spark, tmp_path_factory):
    e = Extract()
    corners = [(1, 8.0, 53.0, {}), (2, 8.5, 53.0, {}), (3, 8.5, 53.5, {"shop": "bäcker", "name": "Süd"}), (4, 8.0, 53.5, {})]
    e.block(dense=corners, plain=True)
    e.block(nodes=[(9_000_000_000, -70.1, -33.25, {"office": "it"})])
    e.block(ways=[(10, {"landuse": "industrial"}, [1, 2, 3, 4, 1]), (11, {}, [1, 2, 3]), (12, {}, [1, 4, 3]), (13, {"highway": "road"}, [1, 2])])
    e.block(
        relations=[
            (20, {"type": "boundary", "name": "Land"}, [("way", 11, "outer"), ("way", 12, "outer"), ("node", 1, "label")]),
            (21, {"type": "multipolygon"}, [("way", 13, "outer")]),
        ]
    )
    path = tmp_path_factory.mktemp("map") / "x.osm.pbf"
    path.write_bytes(e.out)
    maps.register(spark)
    return str(path)


def test_extract(spark, extract):
    rows = spark.read.format("osmpbf").option("path", extract).option("blobs", 1).load()
    assert rows.rdd.getNumPartitions() == 4
    got = {(r["kind"], r["id"]): r for r in rows.collect()}
    assert len(got) == 11
    south, far = got["node", 3], got["node", 9_000_000_000]
    assert (south["lon"], south["lat"], south["tags"]) == (pytest.approx(8.5), pytest.approx(53.5), {"shop": "bäcker", "name": "Süd"})
    assert (far["lon"], far["lat"], far["tags"]) == (pytest.approx(-70.1), pytest.approx(-33.25), {"office": "it"})
    assert got["way", 12]["refs"] == [1, 4, 3] and got["way", 11]["tags"] == {}
    assert [tuple(m) for m in got["relation", 20]["members"]] == [("way", 11, "outer"), ("way", 12, "outer"), ("node", 1, "label")]
    some = spark.read.format("osmpbf").option("path", extract).option("keys", "shop,office").option("kinds", "node,way").load()
    assert sorted(r["id"] for r in some.collect()) == [3, 9_000_000_000]


def test_areas(spark, extract):
    rows = maps.areas(spark.read.format("osmpbf").option("path", extract).load())
    got = {(r["kind"], r["id"]): [[(p["x"], p["y"]) for p in ring] for ring in r["rings"]] for r in rows.collect()}
    assert set(got) == {("way", 10), ("relation", 20)}
    near = lambda ring: [(pytest.approx(x), pytest.approx(y)) for x, y in ring]
    assert got["way", 10] == [near([(8.0, 53.0), (8.5, 53.0), (8.5, 53.5), (8.0, 53.5), (8.0, 53.0)])]
    assert got["relation", 20] == got["way", 10]


def test_packed_and_rings():
    values = [0, 1, 127, 128, 300, 1 << 40, (1 << 63) - 1]
    assert maps.packed(b"".join(map(varint, values))).tolist() == values
    assert maps.signed(maps.packed(b"".join(map(zigzag, [0, -1, 1, -(1 << 62)])))).tolist() == [0, -1, 1, -(1 << 62)]
    a, b, c, d = (0, 0), (1, 0), (1, 1), (0, 1)
    assert maps.closed_rings([[a, b], [c, b], [c, d, a]]) == [[a, b, c, d, a]]
    assert maps.closed_rings([[a, b], [b, c]]) == [] and maps.closed_rings([]) == []


def test_shapes(spark, tmp_path):
    rings = [[(0.0, 0.0), (0.0, 2.0), (2.0, 2.0), (0.0, 0.0)], [(0.5, 1.0), (1.0, 1.5), (0.5, 1.5), (0.5, 1.0)]]
    body = struct.pack("<i4d2i2i", 5, 0, 0, 2, 2, 2, 8, 0, 4) + b"".join(struct.pack("<2d", *p) for r in rings for p in r)
    records = [body, struct.pack("<i", 0), body]
    shp, shx = b"\0" * 100, b"\0" * 100
    for i, r in enumerate(records):
        shx += struct.pack(">2i", len(shp) // 2, len(r) // 2)
        shp += struct.pack(">2i", i + 1, len(r) // 2) + r
    cols = [(b"AGS", 5), (b"NAME", 8)]
    head = struct.pack("<B3xIHH20x", 3, 3, 32 + 32 * len(cols) + 1, 14) + b"".join(n.ljust(11, b"\0") + b"C" + b"\0" * 4 + bytes([w]) + b"\0" * 15 for n, w in cols) + b"\r"
    rows = b"".join(f + a.ljust(5) + n.ljust(8) for f, a, n in [(b" ", b"04011", "Süd".encode("latin-1")), (b" ", b"04012", b""), (b"*", b"1", b"gone")])
    for ending, data in ((".shp", shp), (".shx", shx), (".dbf", head + rows)):
        (tmp_path / f"k{ending}").write_bytes(data)
    maps.register(spark)
    got = spark.read.format("shapefile").option("path", str(tmp_path / "k.shp")).option("encoding", "latin-1").option("shapes", 1).load().orderBy("AGS").collect()
    assert [(r["AGS"], r["NAME"]) for r in got] == [("04011", "Süd"), ("04012", None)]
    assert [[tuple(p) for p in ring] for ring in got[0]["rings"]] == rings and got[1]["rings"] is None


def items(url, params):
    if "Q3" in params["query"]:
        return 500, url, b""
    found = [q[3:] for q in params["query"].split() if q.startswith("wd:") and q != "wd:Q2"]
    rows = [{"item": {"value": f"http://x/{q}"}, "label": {"value": f"Firma {q}"}, "parent_id": {"value": "http://x/Q9"}, "inception": {"value": "1999-01-02T00:00:00Z"}} for q in found]
    return 200, url, json.dumps({"results": {"bindings": rows * 2}}).encode()


def test_items(spark, tmp_path):
    folder = str(tmp_path / "items")
    ask = lambda ids: remote.ask_missing(
        spark, spark.createDataFrame([(i,) for i in ids], "qid string"), "qid", folder, remote.ask_items(items, "http://s", "VALUES {ids} x", ()), remote.ITEMS
    )
    got = {r["qid"]: r for r in ask(["Q1", "Q2", "Q1", "no id", None]).collect()}
    assert set(got) == {"Q1", "Q2"} and got["Q2"]["label"] is None
    assert (got["Q1"]["label"], got["Q1"]["parent_id"], got["Q1"]["inception"]) == ("Firma Q1", "Q9", "1999-01-02")
    assert {r["qid"] for r in ask(["Q2", "Q4"]).collect()} == {"Q2", "Q4"}
    assert spark.read.parquet(folder).count() == 3
    with pytest.raises(Exception, match="answered 500"):
        ask(["Q3"])


def places(url, params):
    known = {"street": [{"lat": "53.1", "lon": "8.1", "addresstype": "road", "address": {"state": "Bremen"}}], "postalcode": [{"lat": "53.2", "lon": "8.2"}], "city": []}
    if params.get("street") == "Nirgends 1":
        return 200, url, b"[]" if "street" in params else b""
    step = "street" if "street" in params else "postalcode" if params.get("postalcode") == "28195" else "city"
    return 200, url, json.dumps(known[step]).encode()


def test_positions(spark, tmp_path):
    rows = spark.createDataFrame([("Kai  1", "28195", "Bremen"), ("", "28195", "Bremen"), ("Nirgends 1", "28195", "Bremen"), (None, "1", "X")], "street string, postcode string, city string")
    rows = rows.select(remote.address_key(F.col("street"), F.col("postcode"), F.col("city")).alias("key"), "street", "postcode", "city")
    got = remote.ask_missing(spark, rows, "key", str(tmp_path / "p"), remote.ask_positions(places, "http://n", (), 0.0), remote.POSITIONS).collect()
    assert {r["key"]: (r["precision"], r["latitude"], r["state"]) for r in got} == {
        "kai 1|28195|bremen": ("street", 53.1, "Bremen"), "|28195|bremen": ("postcode", 53.2, None), "nirgends 1|28195|bremen": ("postcode", 53.2, None), "|1|x": (None, None, None),
    }


def searches(url, params):
    if params["q"] == "refused":
        return 200, url, json.dumps({"results": [], "unresponsive_engines": [["a", "too many requests"]]}).encode()
    if params["q"] == "broken":
        return 200, url, b"<html>"
    hits = [{"url": "https://a.de/", "title": "A", "positions": [3, 2], "engines": ["x"]}, {"url": "ftp://b"}, {"url": "http://c.de", "content": "C"}]
    return 200, url, json.dumps({"results": hits}).encode()


def test_searches_and_names(spark, tmp_path):
    rows = spark.createDataFrame([("refused",), ("broken",), ("firma",)], "query string")
    got = remote.ask_missing(spark, rows, "query", str(tmp_path / "s"), remote.ask_searches(searches, "http://s"), remote.ANSWERS).collect()
    assert [r["query"] for r in got] == ["firma"]
    assert [(h["rank"], h["url"], h["content"], h["engines"]) for h in got[0]["hits"]] == [(2, "https://a.de/", "", ["x"]), (3, "http://c.de", "C", [])]
    hosts = spark.createDataFrame([("a.de",), ("b.de",)], "host string")
    names = remote.ask_missing(spark, hosts, "host", str(tmp_path / "n"), remote.ask_names(lambda h: h == "a.de"), remote.NAMES).collect()
    assert {r["host"]: r["exists"] for r in names} == {"a.de": True, "b.de": False}


@pytest.mark.parametrize(
    "text,allowed",
    [("User-agent: *\nDisallow: /", False), ("User-agent: x\nDisallow: /", True), ("User-agent: *\nDisallow: /a", True), ("User-Agent: x\nUser-agent: *\n disallow:  / ", False), ("", True)],
)
def test_robots(text, allowed):
    assert remote.robots_allow(text) == allowed


def test_ranker(spark):
    rows = spark.range(240).select(
        (F.col("id") / 4).cast("int").alias("id"), F.concat(F.lit("h"), F.col("id") % 4).alias("host"), (F.col("id") % 4 == 1).cast("int").alias("label"),
        F.when(F.col("id") % 4 == 1, 0.9).when(F.col("id") % 4 > 1, 0.2).alias("sim_title"), (F.col("id") % 3).alias("best_rank"), F.lit(0).alias("listed"),
    )
    features = ["sim_title", "best_rank"]
    scored = ranker.out_of_fold(rows, features, folds=2, trees=3, depth=2)
    got = ranker.group_metrics(scored).first().asDict()
    assert got == {"companies": 60, "found": 60, "top1": 60, "n_sure": 60, "sure_right": 60}
    best = ranker.candidates(ranker.fit(rows, features, 3, 2), rows, 0.3, 3, features)
    assert {(r["host"], r["place"]) for r in best.collect()} == {("h1", 1)} and best.count() == 60
