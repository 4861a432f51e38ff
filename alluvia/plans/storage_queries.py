"""Queries that write tables or files in the shared folder and read them back, each with its DuckDB SQL."""

from __future__ import annotations

import json
import sqlite3
import struct

from pyspark.sql import functions as F

from alluvia.functions import geometry as G
from alluvia.operators import spatial as S
from alluvia.plans.registry import BOXES, FLOOD, boxes, flood, query
from alluvia.sources import raster, sinks, vector
from alluvia.sources.staging import csv_union, json_documents, shared_path, table


def put(spark, path: str, raw: bytes) -> None:
    """Bytes as a file of whatever file system the path names."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark._jsc.hadoopConfiguration()).create(p)
    out.write(raw)
    out.close()


@query("SELECT c_custkey, c_name, c_acctbal + 1 AS c_acctbal FROM customer")
def swapped_in_place(spark, d):
    root = shared_path(spark, "customers")
    first = sinks.swap_table(table(spark, d, "customer", "c_custkey", "c_name", "c_acctbal"), root)
    return sinks.swap_table(first.withColumn("c_acctbal", F.col("c_acctbal") + 1), root)


@query(f"WITH {FLOOD} SELECT archive AS source_data, CAST(basin % 5 AS INTEGER) AS event_name, count(*) AS n FROM flood GROUP BY ALL")
def events_by_folder(spark, d):
    path = shared_path(spark, "events")
    sinks.write_events(flood(spark, d).select("basin", F.col("archive").alias("source_data"), (F.col("basin") % 5).alias("event_name")), path)
    return spark.read.parquet(path).groupBy("source_data", "event_name").agg(F.count("*").alias("n"))


@query("SELECT 'one' AS layer, count(*) AS n FROM nation WHERE n_regionkey = 2 UNION ALL SELECT 'two', count(*) FROM region")
def layers_of_a_table(spark, d):
    path = shared_path(spark, "layers")
    nation, region = table(spark, d, "nation", "n_name", "n_regionkey"), table(spark, d, "region").select(F.col("r_name").alias("n_name"), F.lit(0).alias("n_regionkey"))
    for df, layer in ((nation, "one"), (region, "two"), (nation.where("n_regionkey = 2"), "one")):
        sinks.write_layer(df, path, layer)
    return spark.read.parquet(path).groupBy("layer").agg(F.count("*").alias("n"))


@query("SELECT n_nationkey, n_name, n_regionkey FROM nation UNION ALL SELECT r_regionkey, r_name, -1 FROM region")
def csv_files_as_one(spark, d):
    path = shared_path(spark, "csv")
    sinks.write_csv(table(spark, d, "nation"), f"{path}/a", "n_nationkey")
    sinks.write_csv(table(spark, d, "region").withColumn("n", F.lit(-1)), f"{path}/b", "r_regionkey")
    return csv_union(spark, f"{path}/*", "n_nationkey INT, n_name STRING, n_regionkey INT")


@query("SELECT 'EVENT_' || r_regionkey AS stem, r_name AS event_type, r_regionkey * 1.5::DOUBLE AS west FROM region")
def json_by_stem(spark, d):
    path = shared_path(spark, "json")
    for r in table(spark, d, "region").collect():  # five rows
        put(spark, f"{path}/EVENT_{r['r_regionkey']}.json", json.dumps({"event type": r["r_name"], "bounding box": {"west": r["r_regionkey"] * 1.5}}, indent=1).encode())
    docs = json_documents(spark, path, "`event type` STRING, `bounding box` STRUCT<west: DOUBLE>")
    return docs.select("stem", F.col("event type").alias("event_type"), F.col("bounding box")["west"].alias("west"))


@query("SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n FROM events GROUP BY 1")
def days_appended(spark, d):
    path = shared_path(spark, "days")
    rows = table(spark, d, "events", "event_id", "ts").select("event_id", F.to_date("ts").alias("date"))
    for last in ("2024-01-10", "2024-01-08", "2024-12-31"):
        sinks.append_days(rows.where(F.col("date") <= last), path)
    return spark.read.parquet(path).groupBy(F.col("date").cast("string").alias("day")).agg(F.count("*").alias("n"))


@query("SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n FROM orders WHERE o_orderdate < TIMESTAMP '1995-06-01' GROUP BY 1")
def months_loaded_once(spark, d):
    path = shared_path(spark, "months")
    rows = table(spark, d, "orders", "o_orderkey", "o_orderdate").where("o_orderdate < '1995-06-01'").select("o_orderkey", F.to_date("o_orderdate").alias("date"))
    sinks.load_months(rows.where("date < '1995-03-01'"), f"{path}/data", f"{path}/done")
    sinks.load_months(rows, f"{path}/data", f"{path}/done")
    again = sinks.load_months(rows.limit(10), f"{path}/data", f"{path}/done")
    assert not again
    return spark.read.parquet(f"{path}/data").groupBy("month").agg(F.count("*").alias("n"))


@query("SELECT CAST((row_number() OVER (ORDER BY p_partkey) - 1) // 500 AS INTEGER) AS chunk, p_partkey FROM part")
def chunks_exported(spark, d):
    path = shared_path(spark, "chunks")
    sinks.export_chunks(table(spark, d, "part", "p_partkey"), "p_partkey", path, 500)
    return spark.read.parquet(path).select("chunk", "p_partkey")


@query("SELECT o_custkey % 10 AS basin, count(*) AS n FROM orders GROUP BY ALL")
def written_finite(spark, d):
    path = shared_path(spark, "finite")
    sinks.write_finite(table(spark, d, "orders", "o_custkey", "o_totalprice"), path, ["o_totalprice"])
    return spark.read.parquet(path).groupBy((F.col("o_custkey") % 10).alias("basin")).agg(F.count("*").alias("n"))


@query("SELECT 'f' || l_suppkey % 3 AS file, l_partkey % 30 AS col, l_orderkey % 30 AS row, max(l_quantity)::FLOAT::DOUBLE AS b1 FROM lineitem GROUP BY ALL")
def geotiff_round_trip(spark, d):
    c = F.col
    cells = table(spark, d, "lineitem", "l_suppkey", "l_partkey", "l_orderkey", "l_quantity").groupBy(F.concat(F.lit("f"), (c("l_suppkey") % 3).cast("string")).alias("file"), (c("l_partkey") % 30).alias("col"), (c("l_orderkey") % 30).alias("row")).agg(F.max("l_quantity").alias("v"))
    files = raster.encoded_rasters(cells.withColumns({"west": F.lit(10.0), "north": F.lit(50.0)}), "v", 0.5)
    return raster.raster_cells(files, 1).where("b1 IS NOT NULL").select("file", "col", "row", "b1")


def geopackage(rows, kind: str = "MULTIPOLYGON") -> bytes:
    """A GeoPackage with a layer of shapes (id, name, WKB) and one without geometries of that kind."""
    base = sqlite3.connect(":memory:")
    base.executescript(
        "CREATE TABLE gpkg_contents (table_name TEXT, data_type TEXT); CREATE TABLE gpkg_geometry_columns (table_name TEXT, column_name TEXT, geometry_type_name TEXT);"
        f"INSERT INTO gpkg_contents VALUES ('basins', 'features'), ('gauges', 'features'); INSERT INTO gpkg_geometry_columns VALUES ('basins', 'geom', '{kind}'), ('gauges', 'geom', 'POINT');"
        "CREATE TABLE basins (fid INTEGER PRIMARY KEY, id INTEGER, name TEXT, geom BLOB); CREATE TABLE gauges (fid INTEGER PRIMARY KEY, geom BLOB); INSERT INTO gauges VALUES (1, NULL);"
    )
    head = struct.pack("<2sBBI", b"GP", 0, 1, 4326)
    base.executemany("INSERT INTO basins (id, name, geom) VALUES (?, ?, ?)", [(i, n, head + w) for i, n, w in rows])
    base.commit()
    return base.serialize()


@query(f"WITH {BOXES} SELECT id, x0::DOUBLE AS minx, y0::DOUBLE AS miny FROM boxes WHERE x0 <= 20 AND x1 >= 10 AND y0 <= 9 AND y1 >= 3")
def shapes_in_extent(spark, d):
    """Shapes stored with their bounds; an extent's comparisons reach the scan, which reads no shape."""
    path = shared_path(spark, "shapes")
    b = boxes(spark, d, "a")
    corners = [F.col(f"a_{k}").cast("double") for k in ("x0", "y0", "x1", "y1")]
    b.select(F.col("a_id").alias("id"), *[c.alias(n) for c, n in zip(corners, ("minx", "miny", "maxx", "maxy"))], G.st_box(*corners).alias("shape")).sortWithinPartitions("minx").write.parquet(path)
    return S.in_extent(spark.read.parquet(path), 10, 3, 20, 9).select("id", "minx", "miny")


@query("SELECT s_suppkey AS id, s_name AS name, 'basins' AS layer, 1.0::DOUBLE + s_suppkey % 4 AS area FROM supplier WHERE s_suppkey <= 100")
def geopackage_layer(spark, d):
    path = shared_path(spark, "gpkg")
    rows = table(spark, d, "supplier", "s_suppkey", "s_name").where("s_suppkey <= 100").collect()  # at most 100 rows
    put(spark, f"{path}/basins.gpkg", geopackage([(r["s_suppkey"], r["s_name"], G.write(G.box(0, 0, 1 + r["s_suppkey"] % 4, 1))) for r in rows]))
    layer = vector.read_geopackages(spark, path, ("Polygon", "MultiPolygon"))
    return vector.properties(layer, "id LONG, name STRING").select("id", "name", "layer", F.round(G.st_area(F.col("shape")), 6).alias("area"))


@query(
    """WITH g AS (SELECT l_partkey % 60 AS col, l_orderkey % 60 AS row, max(l_quantity) AS v FROM lineitem GROUP BY ALL), p AS (SELECT s_suppkey AS id, s_suppkey % 61 + 0.25 AS px, s_suppkey // 61 % 60 + 0.75 AS py FROM supplier)
    SELECT id, (SELECT CASE WHEN count(v) = 4 THEN CAST(sum(v * (1 - abs(px - 0.5 - col)) * (1 - abs(py - 0.5 - row))) AS DOUBLE) END FROM g WHERE abs(px - 0.5 - col) < 1 AND abs(py - 0.5 - row) < 1) AS value FROM p"""
)
def raster_window_resampled(spark, d):
    """A raster written and read as a file, resampled at points; beyond its edge and beside cells without data there is no value."""
    c = F.col
    cells = table(spark, d, "lineitem", "l_partkey", "l_orderkey", "l_quantity").groupBy((c("l_partkey") % 60).alias("col"), (c("l_orderkey") % 60).alias("row")).agg(F.max("l_quantity").alias("v"))
    files = raster.encoded_rasters(cells.withColumns({"file": F.lit("hand"), "west": F.lit(0.0), "north": F.lit(0.0)}), "v", 1.0)
    grid = raster.raster_cells(files, 1).select(c("col").alias("x"), c("row").alias("y"), c("b1").alias("v")).where("v IS NOT NULL")
    k = c("s_suppkey")
    points = table(spark, d, "supplier", "s_suppkey").select(k.alias("id"), (k % 61 + F.lit(0.25)).alias("px"), (F.floor(k / 61) % 60 + F.lit(0.75)).alias("py"))
    return S.bilinear(points, grid).select("id", "value")
