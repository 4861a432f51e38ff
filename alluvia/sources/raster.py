"""Rasters and cubes as rows of cells: GeoTIFF, Zarr (version 2) and NetCDF (classic). A file or chunk is read by one task.

Cells without data (NaN, the fill value) are null. Not read: GeoTIFF with other compressions than none, LZW and deflate, Zarr
chunks packed with Blosc, NetCDF of version 4 (HDF5), GRIB; they are an error that says so.
"""

from __future__ import annotations

import gzip
import json
import math
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alluvia.sources.staging import ship_package

# Sizes of the types of a TIFF, and its tags.
TIFF_TYPES = {1: "B", 2: "s", 3: "H", 4: "I", 5: "II", 6: "b", 8: "h", 9: "i", 11: "f", 12: "d", 16: "Q"}
WIDTH, HEIGHT, BITS, COMPRESSION, STRIPS, SAMPLES, ROWS_A_STRIP, STRIP_SIZES, PLANAR, PREDICTOR = 256, 257, 258, 259, 273, 277, 278, 279, 284, 317
TILE_WIDTH, TILE_HEIGHT, TILES, TILE_SIZES, FORMAT, SCALE, TIE_POINT, NO_DATA = 322, 323, 324, 325, 339, 33550, 33922, 42113


def _unpacked_lzw(raw: bytes) -> bytes:
    out, table, width, bits, held, before = [], [], 9, 0, 0, None
    for byte in raw:
        held, bits = held << 8 | byte, bits + 8
        while bits >= width:
            code = held >> (bits - width) & ((1 << width) - 1)
            bits -= width
            held &= (1 << bits) - 1
            if code == 257:
                return b"".join(out)
            if code == 256:
                table, width, before = [bytes([k]) for k in range(256)] + [b"", b""], 9, None
                continue
            if before is None:
                entry = table[code]
            else:
                entry = table[code] if code < len(table) else before + before[:1]
                table.append(before + entry[:1])
            out.append(entry)
            before = entry
            width = 9 + (len(table) >= 511) + (len(table) >= 1023) + (len(table) >= 2047)
    return b"".join(out)


def read_geotiff(raw: bytes) -> tuple[np.ndarray, tuple[float, float, float, float]]:
    """Bands (band, row, column) as doubles with NaN for no data, and west, north and the cell's width and height."""
    order = {b"II": "<", b"MM": ">"}[raw[:2]]
    if struct.unpack_from(order + "H", raw, 2)[0] != 42:
        raise ValueError("no plain TIFF")
    [at] = struct.unpack_from(order + "I", raw, 4)
    tags = {}
    for k in range(struct.unpack_from(order + "H", raw, at)[0]):
        tag, kind, n = struct.unpack_from(order + "HHI", raw, at + 2 + 12 * k)
        code = TIFF_TYPES[kind]
        form = f"{order}{n}s" if code == "s" else f"{order}{n * len(code)}{code[0]}"
        place = at + 10 + 12 * k if struct.calcsize(form) <= 4 else struct.unpack_from(order + "I", raw, at + 10 + 12 * k)[0]
        tags[tag] = struct.unpack_from(form, raw, place)
    width, height, samples = tags[WIDTH][0], tags[HEIGHT][0], tags.get(SAMPLES, (1,))[0]
    kind = np.dtype(f"{order}{ {1: 'u', 2: 'i', 3: 'f'}[tags.get(FORMAT, (1,))[0]] }{tags[BITS][0] // 8}")
    tiled = TILES in tags
    w, h = (tags[TILE_WIDTH][0], tags[TILE_HEIGHT][0]) if tiled else (width, tags.get(ROWS_A_STRIP, (height,))[0])
    across, down = math.ceil(width / w), math.ceil(height / h)
    apart = tags.get(PLANAR, (1,))[0] == 2
    bands = np.full((samples, down * h, across * w), np.nan)
    unpack = {1: bytes, 5: _unpacked_lzw, 8: zlib.decompress, 32946: zlib.decompress}.get(tags.get(COMPRESSION, (1,))[0])
    predictor = tags.get(PREDICTOR, (1,))[0]
    if unpack is None or predictor > 2:
        raise ValueError("a compression that isn't read")
    for k, (place, size) in enumerate(zip(tags[TILES if tiled else STRIPS], tags[TILE_SIZES if tiled else STRIP_SIZES])):
        band, k = divmod(k, across * down) if apart else (0, k)
        n = 1 if apart else samples
        part = np.frombuffer(unpack(raw[place : place + size]), kind)
        part = part[: len(part) // (w * n) * w * n].reshape(-1, w, n)[:h]
        if predictor == 2:
            part = np.cumsum(part, 1, dtype=kind)
        y, x = k // across * h, k % across * w
        for s in range(n):
            bands[band + s, y : y + len(part), x : x + w] = part[:, :, s]
    bands = bands[:, :height, :width]
    if NO_DATA in tags:
        text = tags[NO_DATA][0].split(b"\0")[0].strip()
        bands = np.where(bands == float(text), np.nan, bands) if text else bands
    scale, tie = tags.get(SCALE, (1.0, 1.0, 0.0)), tags.get(TIE_POINT, (0.0,) * 6)
    return bands, (tie[3] - tie[0] * scale[0], tie[4] + tie[1] * scale[1], scale[0], scale[1])


def write_geotiff(band: np.ndarray, west: float, north: float, width: float, height: float) -> bytes:
    """One band of 32-bit numbers as a deflated GeoTIFF in degrees (EPSG:4326), NaN for no data."""
    data = zlib.compress(np.ascontiguousarray(band, "<f4").tobytes())
    keys = (1, 1, 0, 3, 1024, 0, 1, 2, 1025, 0, 1, 1, 2048, 0, 1, 4326)
    entries = [
        (WIDTH, "I", (band.shape[1],)), (HEIGHT, "I", (band.shape[0],)), (BITS, "H", (32,)), (COMPRESSION, "H", (8,)), (262, "H", (1,)), (STRIPS, "I", (8,)), (SAMPLES, "H", (1,)),
        (ROWS_A_STRIP, "I", (band.shape[0],)), (STRIP_SIZES, "I", (len(data),)), (FORMAT, "H", (3,)), (SCALE, "d", (width, height, 0.0)), (TIE_POINT, "d", (0.0, 0.0, 0.0, west, north, 0.0)),
        (34735, "H", keys), (NO_DATA, "s", (b"nan\0",)),
    ]
    start = 8 + len(data) + len(data) % 2
    more, after = b"", start + 6 + 12 * len(entries)
    table = struct.pack("<H", len(entries))
    for tag, code, values in entries:
        body = values[0] if code == "s" else struct.pack(f"<{len(values)}{code}", *values)
        n = len(values[0]) if code == "s" else len(values)
        if len(body) > 4:
            field = struct.pack("<I", after + len(more))
            more += body + bytes(len(body) % 2)
        else:
            field = body.ljust(4, b"\0")
        table += struct.pack("<HHI", tag, {"I": 4, "H": 3, "d": 12, "s": 2}[code], n) + field
    return struct.pack("<2sHI", b"II", 42, start) + data + bytes(len(data) % 2) + table + struct.pack("<I", 0) + more


def raster_cells(files: DataFrame, bands: int) -> DataFrame:
    """file, row, col, x and y of the centre, and b1, b2 ... of files (file, content), band by band as columns; rasters with fewer bands have nulls."""
    names = [f"b{k + 1}" for k in range(bands)]
    schema = "file string, row long, col long, x double, y double, " + ", ".join(f"{n} double" for n in names)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for file, raw in part.itertuples(index=False):
                cells, (west, north, width, height) = read_geotiff(raw)
                step = max(1, 100_000 // cells.shape[2])
                for top in range(0, cells.shape[1], step):
                    some = cells[:, top : top + step]
                    row, col = (v.ravel() for v in np.indices(some.shape[1:]))
                    found = {"file": file, "row": row + top, "col": col, "x": west + (col + 0.5) * width, "y": north - (row + top + 0.5) * height}
                    yield pd.DataFrame(found | {n: some[k].ravel() if k < len(some) else np.nan for k, n in enumerate(names)})

    ship_package()
    return _without_nan(files.select("file", "content").mapInPandas(run, schema), names)


def _without_nan(df: DataFrame, names: list[str]) -> DataFrame:
    return df.withColumns({n: F.when(~F.isnan(n), F.col(n)) for n in names})


def read_rasters(spark: SparkSession, path: str, bands: int = 1) -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.tif").option("recursiveFileLookup", "true").load(path)
    return raster_cells(files.select(F.col("path").alias("file"), "content"), bands)


def encoded_rasters(cells: DataFrame, value: str, step: float) -> DataFrame:
    """file and content: each file's cells (file, row, col, value, west, north) as a GeoTIFF; one task holds a file, so files should be tiles."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        band = np.full((int(pdf["row"].max()) + 1, int(pdf["col"].max()) + 1), np.nan, np.float32)
        band[pdf["row"], pdf["col"]] = pdf[value].astype(float)
        return pd.DataFrame({"file": pdf["file"].iloc[:1], "content": [write_geotiff(band, float(pdf["west"].iloc[0]), float(pdf["north"].iloc[0]), step, step)]})

    ship_package()
    return cells.groupBy("file").applyInPandas(run, "file string, content binary")


def _json_file(spark: SparkSession, name: str) -> dict | None:
    """A small JSON file, which Spark's readers would pass over as its name begins with a point; None if it isn't there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        return None
    stream = files.open(path)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def read_zarr(spark: SparkSession, path: str, variable: str, dims: tuple[str, ...]) -> DataFrame:
    """One row per cell of a variable: its place along each dimension, and value, unpacked by scale, offset and fill value. Only chunks that are there are read."""
    meta, attributes = _json_file(spark, f"{path}/{variable}/.zarray"), _json_file(spark, f"{path}/{variable}/.zattrs") or {}
    if meta is None:
        raise ValueError(f"no Zarr array {variable} in {path}")
    packer = (meta.get("compressor") or {}).get("id")
    if packer not in (None, "zlib", "gzip", "zstd") or meta.get("filters") or meta["zarr_format"] != 2:
        raise ValueError(f"chunks packed with {packer} aren't read")
    shape, chunk, kind, order, fill = meta["shape"], meta["chunks"], meta["dtype"], meta["order"], meta["fill_value"]
    scale, offset, missing = attributes.get("scale_factor", 1.0), attributes.get("add_offset", 0.0), attributes.get("_FillValue", fill)
    separator = meta.get("dimension_separator", ".")

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for name, raw in part.itertuples(index=False):
                if packer == "zstd":
                    import zstandard

                    raw = zstandard.ZstdDecompressor().decompress(raw, max_output_size=math.prod(chunk) * np.dtype(kind).itemsize)
                elif packer:
                    raw = {"zlib": zlib.decompress, "gzip": gzip.decompress}[packer](raw)
                values = np.frombuffer(raw, kind).reshape(chunk, order=order)
                first = [int(k) * c for k, c in zip(name.split(separator), chunk)]
                values = values[tuple(slice(0, s - f) for s, f in zip(shape, first))]
                at = np.indices(values.shape)
                stored = values.ravel().astype(float)
                unpacked = np.where(stored == float(missing), np.nan, stored * scale + offset) if missing is not None else stored * scale + offset
                yield pd.DataFrame({d: at[k].ravel() + first[k] for k, d in enumerate(dims)} | {"value": unpacked})

    tail = r"([0-9]+(?:" + ("/" if separator == "/" else r"\.") + r"[0-9]+)*)$"
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{path}/{variable}")
    files = files.select(F.regexp_extract("path", tail, 1).alias("name"), "content").where("name <> ''")
    ship_package()
    return _without_nan(files.mapInPandas(run, ", ".join(f"{d} long" for d in dims) + ", value double"), ["value"])


def netcdf_variables(raw: bytes) -> tuple[dict[str, np.ndarray], dict[str, dict]]:
    """Variables and their attributes of a classic NetCDF file."""
    if raw[:3] != b"CDF" or raw[3] not in (1, 2):
        raise ValueError("no classic NetCDF")
    at, wide = 4, raw[3] == 2
    kinds = {1: "i1", 2: "S1", 3: ">i2", 4: ">i4", 5: ">f4", 6: ">f8"}

    def number(form: str = ">I") -> int:
        nonlocal at
        [value] = struct.unpack_from(form, raw, at)
        at += struct.calcsize(form)
        return value

    def name() -> str:
        nonlocal at
        n = number()
        text = raw[at : at + n].decode()
        at += n + -n % 4
        return text

    def attributes() -> dict:
        nonlocal at
        number()
        out = {}
        for _ in range(number()):
            key, kind, n = name(), number(), number()
            size = n * np.dtype(kinds[kind]).itemsize
            values = np.frombuffer(raw[at : at + size], kinds[kind])
            out[key] = raw[at : at + size].decode() if kind == 2 else values.tolist()[0] if n == 1 else values.tolist()
            at += size + -size % 4
        return out

    records = number()
    number()
    dims = [(name(), number()) for _ in range(number())]
    attributes()
    number()
    found = [(name(), [number() for _ in range(number())], attributes(), number(), number(), number(">Q" if wide else ">I")) for _ in range(number())]
    step = sum(size for _, d, _, _, size, _ in found if d and dims[d[0]][1] == 0)
    values, told = {}, {}
    for key, d, attrs, kind, _, begin in found:
        shape, item = [dims[k][1] for k in d], np.dtype(kinds[kind])
        told[key] = attrs
        if d and shape[0] == 0:  # one slab a record
            each = math.prod(shape[1:])
            slabs = [np.frombuffer(raw, item, each, begin + r * step) for r in range(records)]
            values[key] = np.concatenate(slabs).reshape(records, *shape[1:]) if slabs else np.zeros(0, item)
        else:
            values[key] = np.frombuffer(raw, item, math.prod(shape), begin).reshape(shape)
    return values, told


def read_series(spark: SparkSession, paths: DataFrame, variables: list[str], time: str = "date", epoch: str = "1951-01-01") -> DataFrame:
    """id, date and variables of classic NetCDF files with one series each, for the ids of paths (id, folder, stem) whose file is there; dates are days since the epoch."""
    folders = [r[0] for r in paths.select("folder").distinct().collect()]
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.nc").load(folders).select(F.regexp_extract("path", r"([^/]*)\.nc$", 1).alias("stem"), "content")

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for key, raw in part.itertuples(index=False):
                values, told = netcdf_variables(raw)
                out = {"id": key, "__n": values[time].astype(int)}
                for v in variables:
                    x = values[v].astype(float) if v in values else np.full(len(values[time]), np.nan)
                    fill = told.get(v, {}).get("_FillValue")
                    out[v] = np.where(x == fill, np.nan, x) if fill is not None else x
                yield pd.DataFrame(out)

    ship_package()
    rows = files.join(paths.select("id", "stem"), "stem").select("id", "content").mapInPandas(run, "id string, __n int, " + ", ".join(f"{v} double" for v in variables))
    return _without_nan(rows.withColumn("date", F.date_add(F.to_date(F.lit(epoch)), F.col("__n"))).select("id", "date", *variables), variables)
