"""Python data sources for the file kinds that Spark does not read: workbooks, SQLite, zipped CSV.

Register them with register(spark), then spark.read.format("xlsx" | "sqlite" | "zipcsv"). All cells
are strings (null where empty); casts are the caller's. Tables in SQLite are read in ranges of rowids,
so that a large table is read by many tasks.
"""

from __future__ import annotations

import csv
import io
import re
import sqlite3
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StringType, StructField, StructType

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_HIDDEN = re.compile("[​‌‍﻿]")


def local(path: str) -> str:
    return path.removeprefix("file://")


def strings(names: list[str]) -> StructType:
    return StructType([StructField(n, StringType()) for n in names])


def column_number(ref: str) -> int:
    n = 0
    for c in re.match("[A-Z]+", ref)[0]:
        n = n * 26 + ord(c) - 64
    return n - 1


def sheet_rows(path: str, sheet: int = 1) -> Iterator[list[str | None]]:
    """The rows of a sheet as texts, from the workbook's own XML."""
    with zipfile.ZipFile(local(path)) as z:
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            for si in ElementTree.parse(z.open("xl/sharedStrings.xml")).getroot():
                shared.append("".join(t.text or "" for t in si.iter(f"{_MAIN}t")))
        for _, row in ElementTree.iterparse(z.open(f"xl/worksheets/sheet{sheet}.xml")):
            if row.tag != f"{_MAIN}row":
                continue
            out: list[str | None] = []
            for cell in row.iter(f"{_MAIN}c"):
                at = column_number(cell.get("r"))
                out += [None] * (at + 1 - len(out))
                kind, value = cell.get("t"), cell.find(f"{_MAIN}v")
                if kind == "inlineStr":
                    out[at] = "".join(t.text or "" for t in cell.iter(f"{_MAIN}t"))
                elif value is not None:
                    out[at] = shared[int(value.text)] if kind == "s" else value.text
            yield out
            row.clear()


class _Reader(DataSourceReader):
    def __init__(self, parts, read):
        self._parts, self._read = parts, read

    def partitions(self):
        return [InputPartition(p) for p in self._parts]

    def read(self, partition):
        return self._read(partition.value)


class XlsxSource(DataSource):
    """Options: path, sheet (from 1), header (rows of the header, joined by a blank, default 1)."""

    @classmethod
    def name(cls):
        return "xlsx"

    def _head(self) -> tuple[list[str], int]:
        n, rows = int(self.options.get("header", 1)), sheet_rows(self.options["path"], int(self.options.get("sheet", 1)))
        head = [row for _, row in zip(range(n), rows)]
        width = max(map(len, head))
        names = [" ".join(re.sub(r"\s+", " ", r[i]).strip() for r in head if i < len(r) and r[i]) or f"column_{i + 1}" for i in range(width)]
        return names, n

    def schema(self):
        return strings(self._head()[0])

    def reader(self, schema):
        path, sheet, skip = self.options["path"], int(self.options.get("sheet", 1)), int(self.options.get("header", 1))
        width = len(schema.fields)

        def read(_):
            for i, row in enumerate(sheet_rows(path, sheet)):
                if i >= skip and any(row):
                    cells = [_HIDDEN.sub("", c).strip() or None if c is not None else None for c in row[:width]]
                    yield tuple(cells + [None] * (width - len(cells)))

        return _Reader([0], read)


class SqliteSource(DataSource):
    """Options: path, table, columns (comma-separated; those that the table lacks are null), rows (of a task)."""

    @classmethod
    def name(cls):
        return "sqlite"

    def _columns(self) -> list[str]:
        with sqlite3.connect(f"file:{local(self.options['path'])}?mode=ro", uri=True) as con:
            return [r[1] for r in con.execute(f'PRAGMA table_info("{self.options["table"]}")')]

    def schema(self):
        wanted = self.options.get("columns")
        return strings([c.strip() for c in wanted.split(",")] if wanted else self._columns())

    def reader(self, schema):
        path, table, have = local(self.options["path"]), self.options["table"], set(self._columns())
        step = int(self.options.get("rows", 200_000))
        cols = ", ".join(f'CAST("{f.name}" AS TEXT)' if f.name in have else "NULL" for f in schema.fields)
        with sqlite3.connect(f"file:{path}?mode=ro", uri=True) as con:
            low, high = con.execute(f'SELECT coalesce(min(rowid), 1), coalesce(max(rowid), 0) FROM "{table}"').fetchone()

        def read(lo):
            with sqlite3.connect(f"file:{path}?mode=ro", uri=True) as con:
                yield from con.execute(f'SELECT {cols} FROM "{table}" WHERE rowid >= ? AND rowid < ? ORDER BY rowid', (lo, lo + step))

        return _Reader(list(range(low, high + 1, step)), read)


class ZipCsvSource(DataSource):
    """Options: path, columns (comma-separated, default all): the CSV files of an archive, one task each."""

    @classmethod
    def name(cls):
        return "zipcsv"

    def _members(self) -> list[str]:
        with zipfile.ZipFile(local(self.options["path"])) as z:
            return sorted(n for n in z.namelist() if n.lower().endswith(".csv"))

    def _head(self) -> list[str]:
        with zipfile.ZipFile(local(self.options["path"])) as z, z.open(self._members()[0]) as f:
            return next(csv.reader(io.TextIOWrapper(f, "utf-8-sig", newline="")))

    def schema(self):
        head, wanted = self._head(), self.options.get("columns")
        names = [c.strip() for c in wanted.split(",")] if wanted else head
        missing = [n for n in names if n not in head]
        if missing:
            raise ValueError(f"the archive lacks the columns {missing}")
        return strings(names)

    def reader(self, schema):
        path, names = local(self.options["path"]), [f.name for f in schema.fields]

        def read(member):
            with zipfile.ZipFile(path) as z, z.open(member) as f:
                for row in csv.DictReader(io.TextIOWrapper(f, "utf-8-sig", newline="")):
                    yield tuple(row.get(n) or None for n in names)

        return _Reader(self._members(), read)


def register(spark: SparkSession) -> None:
    for source in (XlsxSource, SqliteSource, ZipCsvSource):
        spark.dataSource.register(source)


def domain_labels(spark: SparkSession, path: str, suffix: str = "de") -> DataFrame:
    """Labels under a suffix from a table of reversed hosts (tab-separated, gzip or plain), sorted."""
    from pyspark.sql import functions as F

    host = F.col("_c1")
    rows = spark.read.csv(path, sep="\t").where(host.startswith(f"{suffix}."))
    return rows.select(F.split(host, r"\.")[1].alias("label")).distinct().orderBy("label")
