"""Keys, match rules, fusion, sources and the streaming upsert on small hand-made rows."""

import itertools
import sqlite3
import zipfile

import pytest
from pyspark.sql import functions as F

from sitegraph.functions import similarity, text, url
from sitegraph.operators import resolve, serve
from sitegraph.sources import files
from sitegraph.streaming import upsert


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "name,full,light",
    [
        ("Müller & Söhne G.m.b.H.", "mueller soehne", "mueller soehne"),
        ("Dr. med. Hans Groß e.K.", "hans gross", "dr med hans gross"),
        ("Bau GmbH & Co. KG", "bau", "bau"),
        ("Dr. Prof.", "", "dr prof"),
        (None, "", ""),
    ],
)
def test_name_key(spark, name, full, light):
    assert one(spark, text.name_key(F.lit(name).cast("string"))) == full
    assert one(spark, text.name_key(F.lit(name).cast("string"), False)) == light


@pytest.mark.parametrize("street,key", [("Bahnhof-Str. 12 a", "bahnhofstrasse 12a"), ("Hauptstr. 3", "hauptstrasse 3"), ("Lange Straße", "lange strasse"), (None, "")])
def test_street_key(spark, street, key):
    assert one(spark, text.street_key(F.lit(street).cast("string"))) == key


@pytest.mark.parametrize("name,form", [("X GmbH & Co. KG", ("GmbH & Co. KG", "HRA")), ("X e.V.", ("e.V.", "VR")), ("X GbR", ("GbR", None)), ("nothing", None)])
def test_legal_form(spark, name, form):
    got = one(spark, text.legal_form(F.lit(name)))
    assert (tuple(got) if got else None) == form


@pytest.mark.parametrize(
    "raw,want",
    [
        ("WWW.Example.DE/", "https://www.example.de"),
        ("http://a.de:80/x/?utm_source=1&b=2#f", "http://a.de/x?b=2"),
        ("https://a.de:8080/p; https://b.de", "https://a.de:8080/p"),
        ("not a host", None),
        ("", None),
        (None, None),
    ],
)
def test_normalize_url(spark, raw, want):
    assert one(spark, url.normalize_url(F.lit(raw).cast("string"))) == want


def test_listed_hosts(spark):
    assert one(spark, url.listed(F.lit("maps.google.com"), ["google.com"], ["sites.google.com"]))
    assert not one(spark, url.listed(F.lit("sites.google.com"), ["google.com"], ["sites.google.com"]))
    assert not one(spark, url.listed(F.lit("notgoogle.com"), ["google.com"]))


def test_ratio_is_the_common_subsequence():
    def slow(a, b):
        best = 0
        for n in range(len(a), -1, -1):
            for pick in itertools.combinations(range(len(a)), n):
                it = iter(b)
                if all(a[i] in it for i in pick):
                    return n
        return best

    for a, b in [("abcde", "badce"), ("aab", "aba"), ("x", "y"), ("hello", "yellow")]:
        assert similarity.sorted_ratio(a, b) == pytest.approx(200 * slow(a, b) / (len(a) + len(b)))
    assert similarity.sorted_ratio("b a", "a b") == 100 and similarity.sorted_ratio("", "") == 0 and similarity.sorted_ratio(None, "a") == 0


LAT, LON = 53.08, 8.80


def at(i, name, metres=0.0, source="osm", ring=None, anchor=True):
    return (i, f"{source}_{i}", name, source, LON, LAT + metres / 111_280.0, ring, anchor)


def roots(spark, *rows):
    df = spark.createDataFrame(rows, "doc_id long, id string, name string, source string, longitude double, latitude double, ring array<struct<x:double,y:double>>, dedup_anchor boolean")
    return [r["root"] for r in resolve.clusters(df).orderBy("doc_id").collect()]


@pytest.mark.parametrize(
    "a,b,metres,same",
    [
        ("Stahlwerk Nord GmbH", "Stahlwerk Nord", 22, True),
        ("Markt Filiale", "Markt Filiale", 78, True),
        ("Markt Filiale", "Markt Filiale", 178, False),
        ("Stahlwerk Nord", "Stahlwerk Nord", 220, False),
        ("GEW Bremen", "NGG Bremen", 10, False),
        ("Erotic", "Erotik", 10, False),
        ("Veronikas Treff", "Veronikaas Treff", 10, True),
        ("", "", 5, False),
        (None, None, 5, False),
    ],
)
def test_match_rules(spark, a, b, metres, same):
    got = roots(spark, at(1, a), at(2, b, metres))
    assert (got[0] == got[1]) == same


def test_a_ring_holds_a_point_and_anchors_count(spark):
    x, y = (one(spark, c) for c in resolve.utm(F.lit(LON), F.lit(LAT)))
    ring = [(x - 300, y - 300), (x + 300, y - 300), (x + 300, y + 300), (x - 300, y + 300)]
    assert len(set(roots(spark, at(1, "Werk Nord Stahl", ring=ring), at(2, "Werk Nord Stahlbau", 200)))) == 1
    assert len(set(roots(spark, at(1, "Werk Nord Stahl"), at(2, "Werk Nord Stahlbau", 200)))) == 2
    assert len(set(roots(spark, at(1, "Werk Nord"), at(2, "Werk Nord", anchor=False)))) == 2


def test_utm_of_a_known_place(spark):
    x, y = (one(spark, c) for c in resolve.utm(F.lit(9.0), F.lit(0.0)))
    assert x == pytest.approx(500000) and y == pytest.approx(0, abs=1e-6)
    # A degree of latitude at 53 N on this ellipsoid is about 111.28 km.
    a, b = (one(spark, resolve.utm(F.lit(9.0), F.lit(lat))[1]) for lat in (52.5, 53.5))
    assert (b - a) / 0.9996 == pytest.approx(111_280, rel=2e-4)


def test_fusion_takes_each_field_from_the_first_that_has_it(spark):
    rows = spark.createDataFrame(
        [(1, 5, "ied_5", "ied", None, "b"), (1, 7, "osm_7", "osm", "a", None), (1, 2, "ovt_2", "overture", "c", "d"), (2, 9, "x_9", "other", None, None)],
        "root long, doc_id long, id string, source string, phone string, website string",
    )
    got = {r["root"]: r for r in resolve.fuse(rows, ["id", "phone", "website"], ["website"]).collect()}
    assert (got[1]["id"], got[1]["phone"], got[1]["website"], got[1]["website_source"]) == ("osm_7", "a", "b", "ied")
    assert (got[1]["source"], got[1]["source_count"], got[1]["member_ids"]) == ("ied+osm+overture", 3, "osm_7|ied_5|ovt_2")
    assert got[2]["member_ids"] is None and got[2]["phone"] is None


def test_display_model(spark):
    rows = spark.createDataFrame([("a", "osm+ied", 2, "shop"), ("b", "osm", 1, "office"), ("c", "mastr", 1, "x")], "id string, source string, source_count long, business_type string")
    shown = lambda *d: sorted(r["id"] for r in rows.where(serve.Selection(datasets=list(d)).where()).collect())
    assert shown() == [] and shown(serve.Dataset("osm")) == ["a", "b"]
    assert shown(serve.Dataset("osm", matched=False)) == ["b"] and shown(serve.Dataset("osm", only=False)) == ["a"]
    assert shown(serve.Dataset("osm", groups=[]), serve.Dataset("mastr")) == ["c"]
    assert rows.where(serve.Selection().where()).count() == 3


def workbook(path):
    cell = lambda ref, v: f'<c r="{ref}" t="inlineStr"><is><t>{v}</t></is></c>' if isinstance(v, str) else f'<c r="{ref}"><v>{v}</v></c>'
    rows = [["Jahr", "Name\nBetrieb", "Ort"], [2024, "​Werk", "Bremen"], [2023, "Alt", None], [2024, None, "Kiel"]]
    body = "".join(f'<row r="{i}">' + "".join(cell(f"{'ABC'[j]}{i}", v) for j, v in enumerate(r) if v is not None) + "</row>" for i, r in enumerate(rows, 1))
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>{body}</sheetData></worksheet>')


def test_file_sources(spark, tmp_path):
    files.register(spark)
    workbook(tmp_path / "a.xlsx")
    x = spark.read.format("xlsx").load(str(tmp_path / "a.xlsx"))
    assert x.columns == ["Jahr", "Name Betrieb", "Ort"] and x.collect()[0][1] == "Werk" and x.count() == 3
    with sqlite3.connect(tmp_path / "a.db") as con:
        con.execute("CREATE TABLE t (a INTEGER, b TEXT)")
        con.executemany("INSERT INTO t VALUES (?, ?)", [(i, None if i % 2 else f"v{i}") for i in range(25)])
    q = spark.read.format("sqlite").options(path=str(tmp_path / "a.db"), table="t", columns="a,b,missing", rows=10).load()
    assert q.count() == 25 and q.where("b IS NULL").count() == 12 and q.where("missing IS NOT NULL").count() == 0 and q.rdd.getNumPartitions() == 3
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("one.csv", "LEI,Country\n1,DE\n2,\n")
        z.writestr("two.csv", "LEI,Country\n3,NL\n")
    c = spark.read.format("zipcsv").options(path=str(tmp_path / "a.zip"), columns="Country,LEI").load()
    assert sorted(map(tuple, c.collect()), key=str) == [("DE", "1"), ("NL", "3"), (None, "2")]


def test_domain_labels(spark, tmp_path):
    (tmp_path / "v.tsv").write_text("0\tde.b\n1\tde.a.www\n2\tcom.x\n3\tde.a\n")
    assert [r["label"] for r in files.domain_labels(spark, str(tmp_path / "v.tsv")).collect()] == ["a", "b"]


def test_streaming_upsert(spark, tmp_path):
    schema = "k long, v string, at long"
    for i, rows in enumerate(([(1, "a", 1), (2, "b", 1)], [(1, "c", 2), (3, "d", 2), (2, "old", 0)])):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        q = upsert.start_upsert(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"), f"{tmp_path}/out", "k", "at", f"{tmp_path}/ck")
        q.awaitTermination()
    assert sorted((r["k"], r["v"]) for r in spark.read.parquet(f"{tmp_path}/out/1").collect()) == [(1, "c"), (2, "b"), (3, "d")]
