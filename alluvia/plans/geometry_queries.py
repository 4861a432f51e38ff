"""Queries over polygons, cells and networks of basins with shapes, each with its DuckDB SQL.

Polygons are the boxes of the registry under a linear map (x + y / 2, y + x / 4), which multiplies areas by 7/8 and keeps who meets whom.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from alluvia.functions import geometry as G
from alluvia.functions.scalars import half_even
from alluvia.operators import spatial as S
from alluvia.operators.linking import link_floods_by_basin
from alluvia.plans.registry import BOXES, ORACLES, PAIRS, ZONES, boxes, query, zones
from alluvia.sources.staging import table

SHEAR = "0.875::DOUBLE"
Q = "(0.9933056200098587 * (sin(radians({0})) / (1 - 0.0066943799901413165 * sin(radians({0})) ** 2) + atanh(0.0818191908426215 * sin(radians({0}))) / 0.0818191908426215))"
K = "(cos(radians(30)) / sqrt(1 - 0.0066943799901413165 / 4))"
AREA = "20340315795384.5 * radians({1} - {0}) * (" + Q.format("{3}") + " - " + Q.format("{2}") + ")"


def _ring(x0, y0, x1, y1):
    corners = [(x0, y0), (x1, y0), (x1, y1), (x0, y1)]
    x = F.array(*[(a + b / 2).cast("double") for a, b in corners])
    y = F.array(*[(b + a / 4).cast("double") for a, b in corners])
    return G.st_polygon(x, y)


def shapes(spark, d, prefix, where):
    c = [F.col(f"{prefix}_{k}") for k in ("x0", "y0", "x1", "y1")]
    return S.spread(boxes(spark, d, prefix).where(where)).select(f"{prefix}_id", f"{prefix}_brand", _ring(*c).alias(f"{prefix}_shape"))


def _sides(spark, d, others="b_brand LIKE 'Brand#2%'"):
    return shapes(spark, d, "a", "a_brand = 'Brand#11'"), shapes(spark, d, "b", others)


def _all_sides(spark, d):
    """As PAIRS has it: one brand's boxes against all the others', so that each row of the table is on one side."""
    return _sides(spark, d, "b_brand <> 'Brand#11'")


FEW = PAIRS.replace("brand <> 'Brand#11'", "brand LIKE 'Brand#2%'")


@query(f"WITH {FEW} SELECT a_id, b_id, round(shared * {SHEAR}, 6) AS shared, round(shared / (aa + ba - shared), 8) AS iou FROM pairs")
def polygon_overlaps(spark, d):
    rounded = lambda p: S.polygon_iou(p).select("a_key", "b_key", F.round("shared", 6).alias("shared"), F.round("iou", 8).alias("iou"))
    return S.overlap_pairs(*_sides(spark, d), 8, rounded).select("a_id", "b_id", "shared", "iou")


@query(f"WITH {PAIRS}, s AS (SELECT a_id, b_id, round(shared / (aa + ba - shared), 8) AS iou FROM pairs) SELECT a_id, b_id, iou FROM s QUALIFY row_number() OVER (PARTITION BY a_id ORDER BY iou DESC, b_id) = 1 AND iou >= 0.5")
def polygon_best_match(spark, d):
    return S.best_polygon_match(*_all_sides(spark, d), 8, 0.5)


@query(f"WITH {BOXES} SELECT a.id AS a_id, b.id AS b_id FROM (SELECT * FROM boxes WHERE brand = 'Brand#11') a JOIN (SELECT * FROM boxes WHERE brand = 'Brand#21') b ON least(a.x1, b.x1) >= greatest(a.x0, b.x0) AND least(a.y1, b.y1) >= greatest(a.y0, b.y0)")
def polygon_intersects(spark, d):
    return S.polygon_join(shapes(spark, d, "a", "a_brand = 'Brand#11'"), shapes(spark, d, "b", "b_brand = 'Brand#21'"), 8).select("a_id", "b_id")


@query(f"WITH {PAIRS} SELECT a_id, b_id, round((aa + ba - shared) * {SHEAR}, 6) AS union_area, round((aa - shared) * {SHEAR}, 6) AS difference_area, round(round_even(shared * 100 / aa * 100, 0) / 100, 2) AS percentage, shared / aa >= 0.95 AS covered FROM pairs")
def polygon_set_operations(spark, d):
    areas = F.col("areas")

    def measured(p):
        overlaid = p.withColumn("areas", G.st_overlay_areas(F.col("a_shape"), F.col("b_shape")))
        held = overlaid.select("a_key", "b_key", F.round(areas[0], 6).alias("union_area"), F.round(areas[1], 6).alias("difference_area"), F.round(areas[2], 6).alias("i"), F.round("a_area", 6).alias("w"))
        return held.select("a_key", "b_key", "union_area", "difference_area", half_even(F.col("i") * 100 / F.col("w")).alias("percentage"), (F.col("i") / F.col("w") >= 0.95).alias("covered"))

    return S.overlap_pairs(*_all_sides(spark, d), 8, measured).select("a_id", "b_id", "union_area", "difference_area", "percentage", "covered")


@query(ORACLES["non_overlapping_outlets"])
def non_overlapping_shapes(spark, d):
    """The outlets of the registry's query as polygons: a linear map leaves all shares as they are."""
    k = F.col("s_suppkey")
    x, y = k * 37 % 101, k * 53 % 89
    return S.non_dominated_shapes(table(spark, d, "supplier", "s_suppkey").select(k.alias("id"), _ring(x, y, x + 3 + k % 11, y + 3 + k % 7).alias("shape")), 12)


@query(f"WITH {BOXES}, cells AS (SELECT DISTINCT brand, cx, cy FROM boxes, range(0, 60) a(cx), range(0, 50) b(cy) WHERE cx >= x0 AND cx < x1 AND cy >= y0 AND cy < y1 AND brand LIKE 'Brand#1%') SELECT brand, round(count(*) * {SHEAR}, 6) AS area FROM cells GROUP BY brand")
def dissolved_brands(spark, d):
    united = S.dissolved(shapes(spark, d, "a", "a_brand LIKE 'Brand#1%'").withColumnRenamed("a_brand", "brand"), ["brand"], "a_shape", 16)
    return united.select("brand", F.round(G.st_area(F.col("shape")), 6).alias("area"))


@query(f"WITH {BOXES} SELECT id, round(x0 + y0 / 2::DOUBLE, 6) AS minx, round(y0 + x0 / 4::DOUBLE, 6) AS miny, round(x1 + y1 / 2::DOUBLE, 6) AS maxx, round(y1 + x1 / 4::DOUBLE, 6) AS maxy, 'MultiPolygon' AS kind, TRUE AS valid FROM boxes WHERE brand = 'Brand#31'")
def polygon_bounds(spark, d):
    s, b = F.col("a_shape"), F.col("b")
    held = shapes(spark, d, "a", "a_brand = 'Brand#31'").withColumn("b", G.st_bounds(s))
    return held.select(F.col("a_id").alias("id"), *[F.round(b[k], 6).alias(k) for k in ("minx", "miny", "maxx", "maxy")], G.st_type(s).alias("kind"), G.st_is_valid(s).alias("valid"))


@query("SELECT s_suppkey, round(2.0 * (1 + s_suppkey % 7) ** 2, 6) AS repaired_area, FALSE AS was_valid, round(4.0 * (1 + s_suppkey % 7) ** 2, 6) AS simplified_area, round((1 + s_suppkey % 7) ** 2 * 3.0, 6) AS geojson_area FROM supplier")
def repaired_polygons(spark, d):
    r = (1 + F.col("s_suppkey") % 7).cast("double")
    zero = r * 0
    # a bow tie, whose bytes are written as they are; a square with points on its sides; a square with a hole as GeoJSON
    bow = F.concat(F.unhex(F.lit("0103000000" + "01000000" + "05000000")), *[F.unhex(F.lit("0000000000000000")) if v is None else _bytes(v) for v in (None, None, 2 * r, 2 * r, 2 * r, None, None, 2 * r, None, None)])
    dotted = G.st_polygon(F.array(zero, r, 2 * r, 2 * r, 2 * r, zero), F.array(zero, zero, zero, r, 2 * r, 2 * r))
    json = F.format_string('{"type": "Polygon", "coordinates": [[[0, 0], [%1$s, 0], [%1$s, %1$s], [0, %1$s], [0, 0]], [[%2$s, %2$s], [%2$s, %3$s], [%3$s, %3$s], [%3$s, %2$s], [%2$s, %2$s]]]}', 2 * r, r / 2, 3 * r / 2)
    return table(spark, d, "supplier", "s_suppkey").select(
        "s_suppkey", F.round(G.st_area(G.st_make_valid(bow)), 6).alias("repaired_area"), G.st_is_valid(bow).alias("was_valid"), F.round(G.st_area(G.st_simplify(dotted, 0.1, None)), 6).alias("simplified_area"),
        F.round(G.st_area(G.st_from_geojson(json)), 6).alias("geojson_area"),
    )


def _bytes(v):
    """The eight little-endian bytes of an even whole number from 2 to 14 as a double."""
    known = {2: "0000000000000040", 4: "0000000000001040", 6: "0000000000001840", 8: "0000000000002040", 10: "0000000000002440", 12: "0000000000002840", 14: "0000000000002C40"}
    text = F.coalesce(*[F.when(v == k, F.lit(h)) for k, h in known.items()])
    return F.unhex(text)


@query(f"SELECT s_suppkey, round({AREA.format('0', '(1 + s_suppkey % 3)', '(s_suppkey % 80)', '(s_suppkey % 80 + 2)')} / 1e6, 3) AS km2, round({AREA.format('0', '0.1', '(-90 + s_suppkey % 170 * 0.1)', '(-90 + s_suppkey % 170 * 0.1 + 0.1)')}, 1) AS cell_m2 FROM supplier")
def ellipsoid_areas(spark, d):
    k = F.col("s_suppkey")
    shape = G.st_box(F.lit(0.0), k % 80, 1 + k % 3, k % 80 + 2)
    return table(spark, d, "supplier", "s_suppkey").select("s_suppkey", F.round(G.st_ellipsoid_area(shape) / 1e6, 3).alias("km2"), F.round(S.cell_area(k % 170, 0.1), 1).alias("cell_m2"))


@query(f"SELECT s_suppkey, round(6378137 * {K} * radians(s_suppkey % 90), 0) AS x, round(6378137 * {Q.format('(s_suppkey % 45)')} / (2 * {K}), -1) AS y FROM supplier")
def equal_area_bounds(spark, d):
    k = F.col("s_suppkey")
    moved = G.st_transform_bounds(F.lit(0.0), F.lit(0.0), k % 90, k % 45, "equal_area")
    return table(spark, d, "supplier", "s_suppkey").select("s_suppkey", moved.alias("b")).select("s_suppkey", F.round(F.get("b", F.lit(2)), 0).alias("x"), F.round(F.get("b", F.lit(3)), -1).alias("y"))


@query(f"WITH {BOXES} SELECT min(x0)::DOUBLE AS minx, min(y0)::DOUBLE AS miny, max(x1)::DOUBLE AS maxx, max(y1)::DOUBLE AS maxy FROM boxes WHERE x0 <= 20 AND x1 >= 10 AND y0 <= 9 AND y1 >= 3")
def extent_clip_bounds(spark, d):
    b = boxes(spark, d, "a").select(*[F.col(f"a_{k}").cast("double").alias(n) for k, n in (("x0", "minx"), ("y0", "miny"), ("x1", "maxx"), ("y1", "maxy"))])
    return S.total_bounds(S.in_extent(b, 10, 3, 20, 9))


@query(f"WITH {BOXES} SELECT id, x0 >= 5 AND y0 >= 4 AND x1 <= 40 AND y1 <= 38 AS contained, round((greatest(least(x1, 40) - greatest(x0, 5), 0) * greatest(least(y1, 38) - greatest(y0, 4), 0)) / ((x1 - x0) * (y1 - y0)), 8) AS coverage FROM boxes")
def extent_containment(spark, d):
    extent = boxes(spark, d, "b").withColumns({"a_x0": F.lit(5), "a_y0": F.lit(4), "a_x1": F.lit(40), "a_y1": F.lit(38)})
    return extent.select(F.col("b_id").alias("id"), S.contains_box("a", "b").alias("contained"), F.round(F.try_divide(S.overlap_area(), S.box_area("b")), 8).alias("coverage"))


BRIDGE = f"{ZONES}, touch AS (SELECT z.*, cx AS x, cy AS y, cx + 0.5 >= x0 AND cx + 0.5 < x1 AND cy + 0.5 >= y0 AND cy + 0.5 < y1 AS inside FROM zones z, range(0, 70) a(cx), range(0, 70) b(cy) WHERE cx >= floor(x0) AND cx <= ceil(x1) - 1 AND cy >= floor(y0) AND cy <= ceil(y1) - 1), bridge AS (SELECT zone, x, y, NOT bool_or(inside) OVER (PARTITION BY zone) AS used_fallback FROM touch WHERE x < 40 AND y < 40 QUALIFY inside OR NOT bool_or(inside) OVER (PARTITION BY zone))"


@query(f"WITH {BRIDGE} SELECT zone, x, y, used_fallback FROM bridge")
def polygon_zone_cells(spark, d):
    z = zones(spark, d).select("zone", G.st_box(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1")).alias("shape"))
    return S.polygon_cells(z, "shape", 1.0, 0.0, 0.0, 40, 40)


@query(f"WITH {BRIDGE}, c AS (SELECT zone, count(*) AS n_cells, bool_or(used_fallback) AS used_fallback FROM bridge GROUP BY zone) SELECT z.zone, coalesce(n_cells, 0) AS n_cells, coalesce(used_fallback, FALSE) AS used_fallback FROM zones z LEFT JOIN c USING (zone) WHERE used_fallback OR n_cells IS NULL")
def zone_report(spark, d):
    z = zones(spark, d)
    return S.zone_report(z, S.zone_cells(z, 40, 40)).select("zone", "n_cells", "used_fallback")


@query("SELECT s_suppkey, greatest(0, floor((x - -180) / 0.1) - 1)::BIGINT AS col_low, least(3600, ceil((x + 0.75 - -180) / 0.1) + 1)::BIGINT AS col_high, greatest(0, floor((90 - (y + 0.5)) / 0.1) - 1)::BIGINT AS row_low, least(1501, ceil((90 - y) / 0.1) + 1)::BIGINT AS row_high FROM (SELECT s_suppkey, (s_suppkey % 36 * 10 - 180)::DOUBLE AS x, (s_suppkey % 30 * 5 - 60)::DOUBLE AS y FROM supplier)")
def pixel_windows(spark, d):
    k = F.col("s_suppkey")
    x, y = (k % 36 * 10 - 180).cast("double"), (k % 30 * 5 - 60).cast("double")
    return table(spark, d, "supplier", "s_suppkey").select("s_suppkey", S.pixel_window(x, y, x + 0.75, y + 0.5, -180.0, 90.0, 0.1, 3600, 1501).alias("w")).select("s_suppkey", *[F.col(f"w.{c}").cast("long").alias(c) for c in ("col_low", "col_high", "row_low", "row_high")])


RASTER = "raster AS (SELECT l_suppkey % 4 AS file, l_partkey % 60 AS x, l_orderkey % 60 AS y, max(CASE WHEN l_quantity >= 44 THEN 1.0 WHEN l_quantity < 2 THEN NULL ELSE 0.0 END)::DOUBLE AS flooded, CASE WHEN max(l_linenumber) = 7 THEN NULL ELSE (min(l_tax) >= 0.07)::INT::DOUBLE END AS permanent, bool_and(l_returnflag = 'R') AS lake, CASE WHEN min(l_discount) = 0.05 THEN NULL ELSE min(l_discount) * 300 END AS height FROM lineitem GROUP BY ALL)"


def raster(spark, d):
    c = F.col
    rows = table(spark, d, "lineitem").groupBy((c("l_suppkey") % 4).alias("file"), (c("l_partkey") % 60).alias("x"), (c("l_orderkey") % 60).alias("y"))
    flooded = F.max(F.when(c("l_quantity") >= 44, 1.0).when(c("l_quantity") >= 2, 0.0))
    permanent = F.when(F.max("l_linenumber") != 7, (F.min("l_tax") >= 0.07).cast("double"))
    height = F.when(F.min("l_discount") != 0.05, F.min("l_discount") * 300)
    return rows.agg(flooded.alias("flooded"), permanent.alias("permanent"), F.bool_and(c("l_returnflag") == "R").alias("lake"), height.alias("height"))


CLEAN = f"{RASTER}, dry AS (SELECT file, x, y, height, CASE WHEN permanent IS NOT NULL AND flooded = 1 AND (permanent = 1 OR lake) THEN 0.0 ELSE flooded END AS flooded FROM raster), connected AS (SELECT d.file, d.x, d.y, d.height, CASE WHEN d.flooded = 1 AND NOT EXISTS (SELECT 1 FROM dry n WHERE n.flooded = 1 AND n.file = d.file AND n.x BETWEEN d.x - 1 AND d.x + 1 AND n.y BETWEEN d.y - 1 AND d.y + 1 AND (n.x <> d.x OR n.y <> d.y)) THEN 0.0 ELSE d.flooded END AS flooded FROM dry d), clean AS (SELECT file, x, y, CASE WHEN flooded = 1 AND NOT coalesce(height <= 15, FALSE) THEN 0.0 ELSE flooded END::DOUBLE AS flooded FROM connected)"


@query(f"WITH {CLEAN} SELECT * FROM clean")
def cleaned_flood(spark, d):
    return S.cleaned_flood(raster(spark, d))


@query(f"WITH {RASTER}, hand AS (SELECT l_suppkey % 4 AS file, l_partkey % 60 AS x, l_orderkey % 60 AS y, avg(l_tax) AS hand FROM lineitem WHERE l_linenumber < 4 GROUP BY ALL) SELECT r.file, r.x, r.y, CASE WHEN flooded = 1 AND NOT coalesce(hand <= 0.04, FALSE) THEN 0.0 ELSE flooded END::DOUBLE AS flooded FROM raster r LEFT JOIN hand USING (file, x, y)")
def rasters_aligned(spark, d):
    """Two rasters joined cell by cell; a cell that the second one lacks has no height."""
    c = F.col
    hand = table(spark, d, "lineitem").where("l_linenumber < 4").groupBy((c("l_suppkey") % 4).alias("file"), (c("l_partkey") % 60).alias("x"), (c("l_orderkey") % 60).alias("y")).agg(F.avg("l_tax").alias("hand"))
    both = raster(spark, d).join(hand, ["file", "x", "y"], "left")
    return both.select("file", "x", "y", S.low_enough(c("flooded"), c("hand"), 0.04).alias("flooded"))


@query(f"WITH {CLEAN} SELECT file, x // 16 AS tile_x, y // 16 AS tile_y, count(*)::DOUBLE AS area FROM clean WHERE flooded = 1 GROUP BY ALL")
def flood_outlines(spark, d):
    wet = S.cleaned_flood(raster(spark, d)).where("flooded = 1")
    return S.outlines(wet, ["file"], 1.0, 16).select("file", "tile_x", "tile_y", F.round(G.st_area(F.col("shape")), 6).alias("area"))


@query(f"WITH {BRIDGE}, {RASTER} SELECT r.file, r.x, r.y, EXISTS (SELECT 1 FROM bridge b WHERE b.x = r.x AND b.y = r.y) AS lake FROM raster r")
def lake_cells(spark, d):
    z = zones(spark, d).select("zone", G.st_box(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1")).alias("shape"))
    lakes = S.polygon_cells(z, "shape", 1.0, 0.0, 0.0, 40, 40).select("x", "y").distinct().withColumn("__lake", F.lit(True))
    return raster(spark, d).select("file", "x", "y").join(lakes, ["x", "y"], "left").select("file", "x", "y", F.coalesce("__lake", F.lit(False)).alias("lake"))


LINKED = f"""WITH RECURSIVE basins AS (SELECT s_suppkey + 1 AS id, (s_suppkey + 1) // 2 AS next_down, (s_suppkey + 1) % 40 AS x0, (s_suppkey + 1) // 40 % 25 AS y0 FROM supplier),
    floods AS (SELECT e AS event, e * 6 AS x0, 0.25 AS y0, e * 6 + 9.5 AS x1, 2.5 AS y1, e * 6 - 20 AS ex0, -1 AS ey0, e * 6 + 25 AS ex1, 26 AS ey1 FROM range(0, 6) t(e)),
    hits AS (SELECT event, id AS basin FROM floods f JOIN basins b ON b.x0 <= f.x1 AND b.x0 + 1 >= f.x0 AND b.y0 <= f.y1 AND b.y0 + 1 >= f.y0),
    up AS (SELECT DISTINCT basin, basin AS upstream FROM hits UNION SELECT basin, id FROM up JOIN basins ON next_down = upstream),
    judged AS (SELECT h.event, h.basin, count(*) - 1 AS n_upstream, min(b.x0) >= any_value(f.ex0) AND min(b.y0) >= any_value(f.ey0) AND max(b.x0 + 1) <= any_value(f.ex1) AND max(b.y0 + 1) <= any_value(f.ey1) AS used,
      sum(CASE WHEN least(b.x0 + 1, f.x1) > greatest(b.x0, f.x0) AND least(b.y0 + 1, f.y1) > greatest(b.y0, f.y0) THEN {AREA.format("greatest(b.x0, f.x0)", "least(b.x0 + 1, f.x1)", "greatest(b.y0, f.y0)", "least(b.y0 + 1, f.y1)")} ELSE 0 END) AS area, sum({AREA.format("b.x0", "(b.x0 + 1)", "b.y0", "(b.y0 + 1)")}) AS whole
      FROM hits h JOIN up u USING (basin) JOIN basins b ON b.id = u.upstream JOIN floods f ON f.event = h.event GROUP BY h.event, h.basin)"""


def _linked(spark, d):
    k = F.col("s_suppkey") + 1
    x, y = k % 40, F.floor(k / 40) % 25
    basins = table(spark, d, "supplier", "s_suppkey").select(k.alias("id"), F.floor(k / 2).cast("long").alias("next_down"), G.st_box(x, y, x + 1, y + 1).alias("shape"))
    e = F.col("id")
    events = spark.range(6)
    floods = events.select(e.alias("event"), G.st_box(e * 6, F.lit(0.25), e * 6 + 9.5, F.lit(2.5)).alias("shape"))
    extents = events.select(e.alias("event"), G.st_box(e * 6 - 20, F.lit(-1.0), e * 6 + 25, F.lit(26.0)).alias("shape"))
    return link_floods_by_basin(basins, floods, extents, 4)


@query(f"{LINKED} SELECT event, basin, n_upstream = 0 AS headwater, n_upstream, round(area, -1) AS area_m2, round(round_even(area * 100 / floor(whole) * 100, 0) / 100, 2) AS percentage FROM judged WHERE used AND area > 0")
def flood_basin_links(spark, d):
    linked, _ = _linked(spark, d)
    return linked.select("event", "basin", "headwater", "n_upstream", F.round("area_m2", -1).alias("area_m2"), "percentage")


@query(f"{LINKED} SELECT event, basin, CASE WHEN used THEN 'used' ELSE 'not_used' END AS status FROM judged")
def flood_basin_usage(spark, d):
    return _linked(spark, d)[1]
