"""Vector files as rows: shapefiles (also in zip archives) and GeoPackages. A file is read by one task and must fit in its memory.

Rows have file, layer, geometry_type, properties (a JSON object) and shape (WKB; null for other kinds than polygons in shapefiles).
Files that can't be read are an error that names them. Empty layers give no rows.
"""

from __future__ import annotations

import io
import json
import os
import re
import sqlite3
import struct
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alluvia.functions import geometry as G
from alluvia.sources.staging import ship_package

SCHEMA = "file string, layer string, geometry_type string, properties string, shape binary"
ROWS = 1000


def dbf_rows(raw: bytes, encoding: str = "utf-8") -> Iterator[dict]:
    """The rows of a dBASE table: texts trimmed, numbers as numbers, dates as text, empty values as None; deleted rows are left out."""
    n, head, size = struct.unpack_from("<IHH", raw, 4)
    fields, at = [], 32
    while raw[at] != 0x0D:
        fields.append((raw[at : at + 11].split(b"\0")[0].decode(encoding, "replace"), chr(raw[at + 11]), raw[at + 16]))
        at += 32
    for k in range(n):
        at = head + k * size
        if raw[at : at + 1] == b"*":
            continue
        row, at = {}, at + 1
        for name, kind, width in fields:
            text = raw[at : at + width].decode(encoding, "replace").strip(" \0")
            at += width
            if kind in "NF":
                row[name] = None if not re.search(r"\d", text) else float(text) if re.search(r"[.eE]", text) else int(text)
            elif kind == "L":
                row[name] = {"T": True, "Y": True, "F": False, "N": False}.get(text.upper())
            else:
                row[name] = text or None
        yield row


def shp_shapes(raw: bytes) -> Iterator[bytes | None]:
    """The polygons of a shapefile as WKB, None for other kinds of shapes."""
    at = 100
    while at < len(raw):
        [words] = struct.unpack_from(">I", raw, at + 4)
        body, at = at + 8, at + 8 + 2 * words
        [kind] = struct.unpack_from("<I", raw, body)
        if kind not in (5, 15, 25):
            yield None
            continue
        parts, points = struct.unpack_from("<II", raw, body + 36)
        begins = [*struct.unpack_from(f"<{parts}I", raw, body + 44), points]
        xy = struct.unpack_from(f"<{2 * points}d", raw, body + 44 + 4 * parts)
        rings = [list(zip(xy[2 * a : 2 * b : 2], xy[2 * a + 1 : 2 * b : 2])) for a, b in zip(begins[:-1], begins[1:])]
        yield G.write([r[:-1] if r[0] == r[-1] else r for r in rings])


def shapefile_rows(file: str, layer: str, shp: bytes, dbf: bytes | None) -> Iterator[tuple]:
    shapes = list(shp_shapes(shp))
    table = list(dbf_rows(dbf)) if dbf else [{}] * len(shapes)
    for row, shape in zip(table, shapes):
        yield file, layer, "Polygon" if shape else "Other", json.dumps(row), shape


def zip_rows(file: str, raw: bytes) -> Iterator[tuple]:
    """All shapefiles of an archive, each a layer."""
    with zipfile.ZipFile(io.BytesIO(raw)) as archive:
        names = {n.lower(): n for n in archive.namelist()}
        for low, name in sorted(names.items()):
            if low.endswith(".shp"):
                dbf = names.get(low[:-4] + ".dbf")
                yield from shapefile_rows(file, os.path.basename(name)[:-4], archive.read(name), archive.read(dbf) if dbf else None)


def geopackage_rows(file: str, raw: bytes, kinds: tuple[str, ...] = ()) -> Iterator[tuple]:
    """All feature layers of a GeoPackage, or those of some kinds of geometry."""
    base = sqlite3.connect(":memory:")
    base.deserialize(raw)
    layers = base.execute("SELECT g.table_name, g.column_name, g.geometry_type_name FROM gpkg_geometry_columns g JOIN gpkg_contents c ON c.table_name = g.table_name AND c.data_type = 'features' ORDER BY 1").fetchall()
    for layer, column, kind in layers:
        if kinds and kind.upper() not in {k.upper() for k in kinds}:
            continue
        found = base.execute('SELECT * FROM "{}"'.format(layer.replace('"', '""')))
        names = [d[0] for d in found.description]
        for values in found:
            row = dict(zip(names, values))
            blob = row.pop(column)
            shape = None
            if blob:
                size = (0, 32, 48, 48, 64)[blob[3] >> 1 & 7]
                shape = bytes(blob[8 + size :])
            yield file, layer, kind, json.dumps(row, default=str), shape
    base.close()


def _parsed(files: DataFrame, rows) -> DataFrame:
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        for part in parts:
            for record in part.itertuples(index=False):
                some = []
                try:
                    for row in rows(*record):
                        some.append(row)
                        if len(some) == ROWS:
                            yield pd.DataFrame(some, columns=names)
                            some = []
                except Exception as error:
                    raise ValueError(f"{record[0]} can't be read: {error}") from error
                if some:
                    yield pd.DataFrame(some, columns=names)

    ship_package()
    return files.mapInPandas(run, SCHEMA)


def _files(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path).select(F.col("path").alias("file"), "content")


def read_zipped_shapefiles(spark: SparkSession, path: str) -> DataFrame:
    return _parsed(_files(spark, path, "*.zip"), zip_rows)


def read_shapefiles(spark: SparkSession, path: str) -> DataFrame:
    """Shapefiles below a path with the tables beside them."""
    stem = F.regexp_replace("file", r"\.[^.]*$", "")
    shp, dbf = (_files(spark, path, p).withColumn("stem", stem) for p in ("*.shp", "*.dbf"))
    both = shp.join(dbf.select("stem", F.col("content").alias("dbf")), "stem", "left").select("file", F.regexp_extract("stem", "[^/]*$", 0).alias("layer"), "content", "dbf")
    return _parsed(both, shapefile_rows)


def read_geopackages(spark: SparkSession, path: str, kinds: tuple[str, ...] = ()) -> DataFrame:
    """GeoPackages below a path; kinds of geometry to read, all if none are named."""
    return _parsed(_files(spark, path, "*.gpkg"), lambda file, raw: geopackage_rows(file, raw, kinds))


def properties(df: DataFrame, schema: str) -> DataFrame:
    """df with the wanted properties as columns; others aren't parsed."""
    return df.withColumn("__p", F.from_json("properties", schema)).select(*[c for c in df.columns if c != "properties"], "__p.*")
