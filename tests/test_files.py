import io
import json
import struct
import zipfile
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from alluvia.functions import geometry as G
from alluvia.plans.storage_queries import geopackage
from alluvia.sources import raster, sinks, vector


def shapefile(rings_of):
    body = b""
    for k, rings in enumerate(rings_of):
        closed = [[*r, r[0]] for r in rings]
        points = [p for r in closed for p in r]
        starts = np.cumsum([0, *map(len, closed)])[:-1]
        content = struct.pack("<I4d2I", 5, 0, 0, 0, 0, len(closed), len(points)) + struct.pack(f"<{len(starts)}I", *starts) + struct.pack(f"<{2 * len(points)}d", *(c for p in points for c in p))
        body += struct.pack(">II", k + 1, len(content) // 2) + content
    return struct.pack(">7I", 9994, 0, 0, 0, 0, 0, 50 + len(body) // 2) + struct.pack("<II8d", 1000, 5, *[0.0] * 8) + body


def dbf(rows):
    fields = b"ID".ljust(11, b"\0") + b"N" + bytes(4) + bytes([6, 0]) + bytes(14) + b"NAME".ljust(11, b"\0") + b"C" + bytes(4) + bytes([10, 0]) + bytes(14)
    head = struct.pack("<B3BIHH20x", 3, 24, 1, 1, len(rows), 32 + len(fields) + 1, 17)
    return head + fields + b"\r" + b"".join(b" " + str(i).rjust(6).encode() + n.encode().ljust(10) for i, n in rows)


def test_shapefiles_and_archives(spark, tmp_path):
    shp, table = shapefile([G.box(0, 0, 2, 1), G.difference(G.box(0, 0, 4, 4), G.box(1, 1, 2, 2))]), dbf([(1, "one"), (2, "Köln")])
    (tmp_path / "plain").mkdir()
    (tmp_path / "plain" / "basins.shp").write_bytes(shp)
    (tmp_path / "plain" / "basins.dbf").write_bytes(table)
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w") as z:
        z.writestr("a/first.SHP", shp), z.writestr("a/first.dbf", table), z.writestr("b/second.shp", shp), z.writestr("readme.txt", "x")
    (tmp_path / "all.zip").write_bytes(raw.getvalue())
    plain = vector.properties(vector.read_shapefiles(spark, str(tmp_path / "plain")), "ID LONG, NAME STRING").select("layer", "ID", "NAME", G.st_area(F.col("shape")).alias("area")).orderBy("ID").collect()
    assert [tuple(r) for r in plain] == [("basins", 1, "one", 2.0), ("basins", 2, "Köln", 15.0)]
    zipped = vector.read_zipped_shapefiles(spark, str(tmp_path))
    assert sorted((r["layer"], r["geometry_type"]) for r in zipped.collect()) == [("first", "Polygon")] * 2 + [("second", "Polygon")] * 2
    (tmp_path / "broken.zip").write_bytes(b"nothing")
    with pytest.raises(Exception, match="broken.zip"):
        vector.read_zipped_shapefiles(spark, str(tmp_path)).count()


def test_geopackage_layers(spark, tmp_path):
    (tmp_path / "x.gpkg").write_bytes(geopackage([(1, "a", G.write(G.box(0, 0, 1, 1)))]))
    rows = vector.read_geopackages(spark, str(tmp_path)).collect()
    assert sorted((r["layer"], r["shape"] is None) for r in rows) == [("basins", False), ("gauges", True)]
    assert vector.read_geopackages(spark, str(tmp_path), ("MultiPolygon",)).count() == 1


def lzw(raw):
    """Codes of nine bits, with the table cleared before it grows."""
    codes, out = [], 0
    for k, b in enumerate(raw):
        codes += [256] * (k % 100 == 0) + [b]
    codes.append(257)
    n = 0
    for c in codes:
        out, n = out << 9 | c, n + 9
    return (out << -n % 8).to_bytes((n + 7) // 8, "big")


def tiff(bands, compression, kind="f", predictor=1):
    """A tiled big-endian file with interleaved bands."""
    count, height, width = bands.shape
    tile, parts = 16, []
    padded = np.zeros((count, -(-height // tile) * tile, -(-width // tile) * tile), f">{kind}4")
    padded[:, :height, :width] = bands
    for y in range(0, padded.shape[1], tile):
        for x in range(0, padded.shape[2], tile):
            part = np.ascontiguousarray(padded[:, y : y + tile, x : x + tile].transpose(1, 2, 0))
            if predictor == 2:
                part[:, 1:] -= part[:, :-1].copy()
            parts.append({1: bytes, 5: lzw, 8: zlib.compress}[compression](part.tobytes()))
    entries = [(256, "I", (width,)), (257, "I", (height,)), (258, "H", (32,) * count), (259, "H", (compression,)), (277, "H", (count,)), (317, "H", (predictor,)), (322, "I", (tile,)), (323, "I", (tile,)), (324, "I", None), (325, "I", tuple(map(len, parts))), (339, "H", ({"f": 3, "i": 2}[kind],) * count), (33550, "d", (0.5, 0.5, 0.0)), (33922, "d", (0, 0, 0, 10.0, 50.0, 0.0)), (42113, "s", (b"-1\0\0\0",))]
    offsets, at = [], 8
    for p in parts:
        offsets.append(at)
        at += len(p)
    entries = [(t, c, tuple(offsets) if v is None else v) for t, c, v in entries]
    more, after, table = b"", at + 6 + 12 * len(entries), struct.pack(">H", len(entries))
    for tag, code, values in entries:
        raw = values[0] if code == "s" else struct.pack(f">{len(values)}{code}", *values)
        field = raw.ljust(4, b"\0") if len(raw) <= 4 else struct.pack(">I", after + len(more))
        more += raw if len(raw) > 4 else b""
        table += struct.pack(">HHI", tag, {"I": 4, "H": 3, "d": 12, "s": 2}[code], len(values[0]) if code == "s" else len(values)) + field
    return struct.pack(">2sHI", b"MM", 42, at) + b"".join(parts) + table + struct.pack(">I", 0) + more


@pytest.mark.parametrize(("compression", "kind", "predictor"), [(1, "f", 1), (5, "f", 1), (8, "i", 2)])
def test_geotiff_bands(spark, tmp_path, compression, kind, predictor):
    bands = np.arange(2 * 21 * 18).reshape(2, 21, 18).astype(f"{kind}4")
    bands[0, 3, 4] = -1
    (tmp_path / "a.tif").write_bytes(tiff(bands, compression, kind, predictor))
    rows = {(r["row"], r["col"]): r for r in raster.read_rasters(spark, str(tmp_path), 3).collect()}
    assert len(rows) == 21 * 18 and rows[3, 4]["b1"] is None and rows[3, 4]["b3"] is None
    assert all(r["b2"] == bands[1, i, j] and (r["x"], r["y"]) == (10 + (j + 0.5) / 2, 50 - (i + 0.5) / 2) for (i, j), r in rows.items())


def test_zarr_chunks(spark, tmp_path):
    folder = tmp_path / "cube.zarr" / "t2m"
    folder.mkdir(parents=True)
    values = np.arange(5 * 7).reshape(5, 7).astype("<i2")
    values[2, 3] = -32768
    (folder / ".zarray").write_text(json.dumps({"zarr_format": 2, "shape": [5, 7], "chunks": [3, 4], "dtype": "<i2", "order": "C", "fill_value": -32768, "compressor": {"id": "zlib", "level": 1}, "filters": None}))
    (folder / ".zattrs").write_text(json.dumps({"scale_factor": 0.5, "add_offset": 10.0}))
    padded = np.zeros((6, 8), "<i2")
    padded[:5, :7] = values
    for i in range(2):
        for j in range(2):
            (folder / f"{i}.{j}").write_bytes(zlib.compress(np.ascontiguousarray(padded[3 * i : 3 * i + 3, 4 * j : 4 * j + 4]).tobytes()))
    got = {(r["time"], r["cell"]): r["value"] for r in raster.read_zarr(spark, str(tmp_path / "cube.zarr"), "t2m", ("time", "cell")).collect()}
    assert got == {(i, j): None if values[i, j] == -32768 else 10 + 0.5 * values[i, j] for i in range(5) for j in range(7)}


def test_netcdf_series(spark, tmp_path):
    def name(x):
        return struct.pack(">I", len(x)) + x.encode() + bytes(-len(x) % 4)

    flow = np.array([1.5, -9.0, 2.5], ">f4")
    body = b"CDF\x01" + struct.pack(">III", 0, 10, 1) + name("date") + struct.pack(">III", 3, 0, 0) + struct.pack(">II", 11, 2)
    first = name("date") + struct.pack(">II", 1, 0) + struct.pack(">III", 0, 0, 4) + struct.pack(">I", 12)
    second = name("streamflow") + struct.pack(">II", 1, 0) + struct.pack(">II", 12, 1) + name("_FillValue") + struct.pack(">II", 5, 1) + struct.pack(">f", -9.0) + struct.pack(">II", 5, 12)
    at = len(body) + len(first) + 4 + len(second) + 4
    (tmp_path / "camels_1.nc").write_bytes(body + first + struct.pack(">I", at) + second + struct.pack(">I", at + 12) + np.array([0, 1, 31], ">i4").tobytes() + flow.tobytes())
    paths = spark.createDataFrame([("g1", str(tmp_path), "camels_1"), ("g2", str(tmp_path), "camels_2")], "id string, folder string, stem string")
    got = [(r["id"], str(r["date"]), r["streamflow"]) for r in raster.read_series(spark, paths, ["streamflow"]).orderBy("date").collect()]
    assert got == [("g1", "1951-01-01", 1.5), ("g1", "1951-01-02", None), ("g1", "1951-02-01", 2.5)]


def test_appending_refuses_earlier_days(spark, tmp_path):
    rows = spark.range(10).select(F.date_add(F.lit("2020-01-05"), F.col("id").cast("int")).alias("date"))
    path = str(tmp_path / "days")
    assert [sinks.append_days(rows, path), sinks.append_days(rows, path)] == [10, 0]
    with pytest.raises(ValueError, match="before"):
        sinks.append_days(rows.select(F.date_sub("date", 1).alias("date")), path)
    with pytest.raises(ValueError, match="no finite value"):
        sinks.write_finite(spark.createDataFrame([(float("nan"),)], "v double"), str(tmp_path / "v"), ["v"])


def test_extent_reaches_the_scan(spark, capsys):
    from alluvia.plans.storage_queries import shapes_in_extent

    found = shapes_in_extent(spark, "/root/testdata/sf0.001")
    found.explain("formatted")
    plan = capsys.readouterr().out
    assert "PushedFilters" in plan and "LessThanOrEqual(minx,20.0)" in plan and "shape" not in plan.split("ReadSchema")[1].split("\n")[0]
