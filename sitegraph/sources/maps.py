"""Scans of map extracts (PBF) and of shape files, decoded by tasks of their own.

Register with register(spark), then spark.read.format("osmpbf" | "shapefile"). The files must lie at a
path that every executor can open (a mounted share); the driver reads only the lengths between blocks.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource
from pyspark.sql.types import ArrayType, DoubleType, StringType, StructField, StructType

from .files import _Reader, local

ELEMENTS = (
    "kind string, id long, lon double, lat double, tags map<string,string>, refs array<long>, "
    "members array<struct<kind: string, ref: long, role: string>>"
)
_KINDS = ("node", "way", "relation")
POINT = StructType([StructField("x", DoubleType()), StructField("y", DoubleType())])
RINGS = ArrayType(ArrayType(POINT))


def _varint(buf: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        b = buf[at]
        value |= (b & 127) << shift
        at, shift = at + 1, shift + 7
        if b < 128:
            return value, at


def fields(buf: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of each field of a protocol buffer message."""
    at = 0
    while at < len(buf):
        key, at = _varint(buf, at)
        kind = key & 7
        if kind == 0:
            value, at = _varint(buf, at)
        elif kind in (1, 5):
            size = 8 if kind == 1 else 4
            value, at = buf[at : at + size], at + size
        elif kind == 2:
            size, at = _varint(buf, at)
            value, at = buf[at : at + size], at + size
        else:
            raise ValueError(f"unknown wire type {kind}")
        yield key >> 3, value


def packed(buf: bytes) -> np.ndarray:
    """All variable-length integers of a packed field."""
    b = np.frombuffer(buf, dtype=np.uint8)
    if not len(b):
        return np.zeros(0, dtype=np.int64)
    last = np.flatnonzero(b < 128)
    first = np.append(0, last[:-1] + 1)
    shift = (np.arange(len(b)) - np.repeat(first, last - first + 1)) * 7
    return np.add.reduceat((b & 127).astype(np.uint64) << shift.astype(np.uint64), first).view(np.int64)


def signed(x):
    """Zigzag integers, one or an array."""
    return (x >> 1) ^ -(x & 1)


def _deltas(buf: bytes) -> np.ndarray:
    return np.cumsum(signed(packed(buf)))


def _signed64(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def blob_places(path: str) -> list[tuple[int, int]]:
    """Offset and size of each data blob; reads the headers alone."""
    out = []
    with open(path, "rb") as f:
        while head := f.read(4):
            kind, size = b"", 0
            for number, value in fields(f.read(struct.unpack(">I", head)[0])):
                if number == 1:
                    kind = value
                elif number == 3:
                    size = value
            if kind == b"OSMData":
                out.append((f.tell(), size))
            f.seek(size, os.SEEK_CUR)
    return out


def _inflate(blob: bytes) -> bytes:
    for number, value in fields(blob):
        if number == 1:
            return value
        if number == 3:
            return zlib.decompress(value)
        if number > 3:
            raise ValueError("the blob is neither plain nor zlib")
    return b""


def block_elements(block: bytes) -> Iterator[tuple]:
    """The elements of a block as rows of ELEMENTS."""
    table, groups, grain, lat0, lon0 = [], [], 100, 0, 0
    for number, value in fields(block):
        if number == 1:
            table = [s.decode("utf-8", "replace") for n, s in fields(value) if n == 1]
        elif number == 2:
            groups.append(value)
        elif number == 17:
            grain = value
        elif number == 19:
            lat0 = _signed64(value)
        elif number == 20:
            lon0 = _signed64(value)
    degrees = lambda v, base: (base + grain * v) * 1e-9

    def tags(own: dict[int, bytes]) -> dict[str, str]:
        return {table[k]: table[v] for k, v in zip(packed(own.get(2, b"")), packed(own.get(3, b"")), strict=True)}

    for group in groups:
        for number, value in fields(group):
            own = dict(fields(value))
            if number == 1:
                lat, lon = signed(own[8]), signed(own[9])
                yield "node", signed(own[1]), degrees(lon, lon0), degrees(lat, lat0), tags(own), None, None
            elif number == 2:
                ids = _deltas(own.get(1, b"")).tolist()
                lats = degrees(_deltas(own.get(8, b"")), lat0).tolist()
                lons = degrees(_deltas(own.get(9, b"")), lon0).tolist()
                marks, at = packed(own.get(10, b"")).tolist(), 0
                for i, lat, lon in zip(ids, lats, lons, strict=True):
                    found = {}
                    while at < len(marks) and marks[at]:
                        found[table[marks[at]]] = table[marks[at + 1]]
                        at += 2
                    at += 1
                    yield "node", i, lon, lat, found, None, None
            elif number == 3:
                yield "way", _signed64(own[1]), None, None, tags(own), _deltas(own.get(8, b"")).tolist(), None
            elif number == 4:
                parts = zip(packed(own.get(10, b"")).tolist(), _deltas(own.get(9, b"")).tolist(), packed(own.get(8, b"")).tolist(), strict=True)
                yield "relation", _signed64(own[1]), None, None, tags(own), None, [(_KINDS[k], ref, table[role]) for k, ref, role in parts]


class PbfSource(DataSource):
    """Options: path; kinds (comma-separated, default all); keys (comma-separated: only elements with one
    of these tags); blobs (of a task, default 16)."""

    @classmethod
    def name(cls):
        return "osmpbf"

    def schema(self):
        return ELEMENTS

    def reader(self, schema):
        path, step = local(self.options["path"]), int(self.options.get("blobs", 16))
        split = lambda o: {c.strip() for c in self.options.get(o, "").split(",") if c.strip()}
        kinds, keys = split("kinds") or set(_KINDS), split("keys")
        places = blob_places(path)

        def read(part):
            with open(path, "rb") as f:
                for offset, size in part:
                    f.seek(offset)
                    for row in block_elements(_inflate(f.read(size))):
                        if row[0] in kinds and (not keys or not keys.isdisjoint(row[4])):
                            yield row

        return _Reader([places[i : i + step] for i in range(0, len(places), step)], read)


def _attributes(path: str) -> tuple[list[tuple[str, int]], int, int]:
    """Names and widths of a dBase table's columns, the length of its head and of a row."""
    with open(path, "rb") as f:
        head = f.read(32)
        head_size, row_size = struct.unpack("<HH", head[8:12])
        cols, rest = [], f.read(head_size - 32)
    for at in range(0, len(rest) - 31, 32):
        if rest[at] == 0x0D:
            break
        cols.append((rest[at : at + 11].split(b"\0")[0].decode("ascii"), rest[at + 16]))
    return cols, head_size, row_size


def _rings(shape: bytes) -> list[list[tuple[float, float]]] | None:
    """The rings of a polygon's record (types 5, 15 and 25); none for an empty shape."""
    kind = struct.unpack("<i", shape[:4])[0]
    if kind == 0:
        return None
    if kind not in (5, 15, 25):
        raise ValueError(f"shape type {kind} is not a polygon")
    parts, points = struct.unpack("<ii", shape[36:44])
    start = [*struct.unpack(f"<{parts}i", shape[44 : 44 + 4 * parts]), points]
    xy = np.frombuffer(shape, dtype="<f8", count=2 * points, offset=44 + 4 * parts).reshape(-1, 2).tolist()
    return [[tuple(p) for p in xy[a:b]] for a, b in zip(start, start[1:], strict=False)]


class ShapeSource(DataSource):
    """Options: path of the .shp file, encoding of its table (default UTF-8), shapes (of a task, default 1000).

    Rows: rings (of polygons) and the columns of the .dbf file beside it, as strings. The index (.shx) gives
    the places of the shapes; rows marked as deleted are left out.
    """

    @classmethod
    def name(cls):
        return "shapefile"

    def _beside(self, ending: str) -> str:
        return os.path.splitext(local(self.options["path"]))[0] + ending

    def schema(self):
        names = [n for n, _ in _attributes(self._beside(".dbf"))[0]]
        return StructType([StructField("rings", RINGS), *[StructField(n, StringType()) for n in names]])

    def reader(self, schema):
        path, table, coding = self._beside(".shp"), self._beside(".dbf"), self.options.get("encoding", "utf-8")
        cols, head, width = _attributes(table)
        with open(self._beside(".shx"), "rb") as f:
            index = np.frombuffer(f.read()[100:], dtype=">i4").reshape(-1, 2).astype(np.int64) * 2
        places, step = index.tolist(), int(self.options.get("shapes", 1000))

        def read(lo):
            with open(path, "rb") as shp, open(table, "rb") as dbf:
                for i, (offset, size) in enumerate(places[lo : lo + step], lo):
                    dbf.seek(head + i * width)
                    row = dbf.read(width)
                    if row[:1] == b"*":
                        continue
                    cells, at = [], 1
                    for _, n in cols:
                        cells.append(row[at : at + n].decode(coding, "replace").strip(" \0") or None)
                        at += n
                    shp.seek(offset + 8)
                    yield (_rings(shp.read(size)), *cells)

        return _Reader(list(range(0, len(places), step)), read)


def register(spark: SparkSession) -> None:
    for source in (PbfSource, ShapeSource):
        spark.dataSource.register(source)


def way_lines(ways: DataFrame, nodes: DataFrame) -> DataFrame:
    """id, line of each way (id, refs): the points (x, y) of its nodes (id, lon, lat) in order.

    One shuffle on the node's id and one on the way's. A node that the extract lacks is left out of its line.
    """
    steps = ways.select("id", F.posexplode("refs").alias("at", "node"))
    placed = steps.join(nodes.select(F.col("id").alias("node"), F.struct(F.col("lon").alias("x"), F.col("lat").alias("y")).alias("p")), "node")
    line = F.transform(F.sort_array(F.collect_list(F.struct("at", "p"))), lambda s: s["p"])
    return placed.groupBy("id").agg(line.alias("line"))


def closed_rings(lines: list[list[tuple]]) -> list[list[tuple]]:
    """Rings made of lines that meet at their ends, in either direction; what does not close is left out."""
    ends: dict[tuple, set[int]] = {}
    for i, line in enumerate(lines):
        for p in (line[0], line[-1]):
            ends.setdefault(p, set()).add(i)
    free, out = set(range(len(lines))), []
    for i in range(len(lines)):
        if i not in free:
            continue
        free.discard(i)
        ring = list(lines[i])
        while ring[0] != ring[-1]:
            follow = min((j for j in ends[ring[-1]] if j in free), default=None)
            if follow is None:
                break
            free.discard(follow)
            own = lines[follow]
            ring += own[1:] if own[0] == ring[-1] else own[-2::-1]
        if ring[0] == ring[-1] and len(ring) >= 4:
            out.append(ring)
    return out


@F.udf(RINGS, useArrow=True)
def _join_lines(lines):
    return closed_rings([[(p["x"], p["y"]) for p in line] for line in lines if len(line) > 1])


def areas(elements: DataFrame) -> DataFrame:
    """kind, id, tags, rings: closed ways with tags, and relations that are areas, by their outer members.

    elements: rows of the osmpbf source, nodes and ways with them unfiltered by tags. Relations count when their
    type is multipolygon or boundary; those without a closed ring are left out.
    """
    nodes, ways = elements.where("kind = 'node'"), elements.where("kind = 'way'")
    shut = ways.where("size(refs) >= 4 AND refs[0] = element_at(refs, -1) AND size(tags) > 0")
    parts = (
        elements.where("kind = 'relation' AND tags['type'] IN ('multipolygon', 'boundary')")
        .select(F.col("id").alias("relation"), F.posexplode("members").alias("at", "m"))
        .where("m.kind = 'way' AND m.role IN ('outer', '')")
        .select("relation", "at", F.col("m.ref").alias("id"))
    )
    needed = shut.select("id").union(parts.select("id")).distinct()
    lines = way_lines(ways.join(needed, "id", "left_semi"), nodes)
    simple = shut.select("kind", "id", "tags").join(lines.select("id", F.array("line").alias("rings")), "id")
    of = parts.join(lines, "id").groupBy(F.col("relation").alias("id")).agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "line"))), lambda s: s["line"]).alias("lines"))
    joined = elements.where("kind = 'relation'").select("kind", "id", "tags").join(of.select("id", _join_lines("lines").alias("rings")), "id")
    return simple.select("kind", "id", "tags", "rings").union(joined.where("size(rings) > 0").select("kind", "id", "tags", "rings"))
