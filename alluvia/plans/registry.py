"""Registered queries over the driver's tables, each with its DuckDB SQL: the domain's operators on stand-in relations.

Roles: flood rows are lineitem (basin l_suppkey + 1, event l_orderkey, share l_discount * 10); the network is supplier as a heap
(id = key + 1, downstream id // 2); boxes are part; series are events by user.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from alluvia.functions import scalars as S
from alluvia.operators import network as N
from alluvia.operators import relational as R
from alluvia.operators import series as T
from alluvia.operators import spatial as G
from alluvia.sources.staging import staged, table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

FLOOD = "flood AS (SELECT l_suppkey + 1 AS basin, CAST(l_shipdate AS DATE) AS day, l_orderkey AS event, l_linenumber AS line, l_discount * 10 AS pct, l_extendedprice AS area, l_returnflag AS archive, l_linestatus AS satellite FROM lineitem)"
EDGES = "edges AS (SELECT s_suppkey + 1 AS id, (s_suppkey + 1) // 2 AS next_down FROM supplier)"
BOXES = "boxes AS (SELECT p_partkey AS id, p_size AS x0, p_partkey % 40 AS y0, p_size + 3 + p_partkey % 3 AS x1, p_partkey % 40 + 4 AS y1, p_brand AS brand FROM part)"
CELLS = "cells AS (SELECT DISTINCT l_partkey % 60 AS x, l_orderkey % 60 AS y FROM lineitem WHERE l_quantity >= 45)"
GRID = "grid AS (SELECT l_partkey % 60 AS x, l_orderkey % 60 AS y, l_extendedprice AS v, l_returnflag AS kind FROM lineitem)"


def query(sql: str | None):
    """Register a query under its function's name with its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def flood(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select(
        (F.col("l_suppkey") + 1).alias("basin"), F.to_date("l_shipdate").alias("day"), F.col("l_orderkey").alias("event"), F.col("l_linenumber").alias("line"),
        (F.col("l_discount") * 10).alias("pct"), F.col("l_extendedprice").alias("area"), F.col("l_returnflag").alias("archive"), F.col("l_linestatus").alias("satellite"),
    )


def edges(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("s_suppkey") + 1
    return table(spark, d, "supplier", "s_suppkey").select(key.alias("id"), F.floor(key / 2).cast("long").alias("next_down"))


def boxes(spark: SparkSession, d: str, prefix: str) -> DataFrame:
    key, size = F.col("p_partkey"), F.col("p_size").cast("long")
    return table(spark, d, "part").select(
        key.alias(f"{prefix}_id"), size.alias(f"{prefix}_x0"), (key % 40).alias(f"{prefix}_y0"), (size + 3 + key % 3).alias(f"{prefix}_x1"), (key % 40 + 4).alias(f"{prefix}_y1"), F.col("p_brand").alias(f"{prefix}_brand")
    )


def cells(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").where("l_quantity >= 45").select((F.col("l_partkey") % 60).alias("x"), (F.col("l_orderkey") % 60).alias("y")).distinct()


def grid(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select((F.col("l_partkey") % 60).alias("x"), (F.col("l_orderkey") % 60).alias("y"), F.col("l_extendedprice").alias("v"), F.col("l_returnflag").alias("kind"))


def series(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", F.col("user_id").alias("basin"), "ts", "event_type", "value")


def best_flood(spark: SparkSession, d: str) -> DataFrame:
    rows = flood(spark, d).na.drop(subset=["basin", "day", "event"]).withColumn("pct", S.finite(F.col("pct")))
    return R.keep_best(rows, ["basin", "day", "event"], F.desc_nulls_last("pct"), F.asc("line"))


BEST = f"{FLOOD}, best AS (SELECT * FROM flood QUALIFY row_number() OVER (PARTITION BY basin, day, event ORDER BY pct DESC, line) = 1)"


@query(
    f"""WITH RECURSIVE {BEST}, {EDGES}, big AS (SELECT * FROM best WHERE pct >= 0.1),
    kept AS (SELECT DISTINCT id FROM edges JOIN big ON id = basin),
    ke AS (SELECT e.id, CASE WHEN k.id IS NULL THEN 0 ELSE e.next_down END AS next_down FROM edges e SEMI JOIN kept ON e.id = kept.id LEFT JOIN kept k ON e.next_down = k.id),
    up AS (SELECT id AS basin, id AS upstream FROM ke UNION SELECT basin, ke.id FROM up JOIN ke ON ke.next_down = up.upstream),
    counts AS (SELECT basin, count(*) - 1 AS n_upstream FROM up GROUP BY basin),
    told AS (SELECT basin, string_agg(DISTINCT CAST(day AS VARCHAR), ', ' ORDER BY CAST(day AS VARCHAR)) AS flood_event_dates, count(DISTINCT day) AS n_flood_events,
      count(DISTINCT (day, event)) AS n_floodmaps, string_agg(DISTINCT archive, ', ' ORDER BY archive) AS sources FROM big GROUP BY basin)
    SELECT row_number() OVER (ORDER BY basin) AS dense_id, basin, n_flood_events, n_floodmaps, flood_event_dates, sources, n_upstream FROM told JOIN counts USING (basin) JOIN kept ON id = basin"""
)
def basin_flood_summary(spark, d):
    big = staged(best_flood(spark, d).where(S.at_least(F.col("pct"), 0.1)).select("basin", "event", "archive", F.col("day").cast("string").alias("date")), "best")
    told = big.groupBy("basin").agg(
        R.sorted_list("date").alias("flood_event_dates"), F.countDistinct("date").alias("n_flood_events"), F.countDistinct(F.struct("date", "event")).alias("n_floodmaps"), R.sorted_list("archive").alias("sources")
    )
    kept = edges(spark, d).join(big.select(F.col("basin").alias("id")).distinct(), "id", "left_semi")
    counts = N.upstream_counts(N.kept_edges(edges(spark, d), kept)).drop("headwater")
    rows = R.in_any(told, kept.withColumnRenamed("id", "basin"), "basin").join(counts, "basin")
    return R.dense_ids(rows, "basin").select("dense_id", "basin", "n_flood_events", "n_floodmaps", "flood_event_dates", "sources", "n_upstream")


@query(f"WITH {BEST} SELECT basin, CAST(day AS VARCHAR) AS day, event, pct, archive FROM best WHERE pct >= 0.1")
def keep_best_inundation(spark, d):
    return best_flood(spark, d).where(S.at_least(F.col("pct"), 0.1)).select("basin", F.col("day").cast("string").alias("day"), "event", "pct", "archive")


@query(f"WITH {FLOOD} SELECT archive AS source_data, basin, 'used' AS status, count(*) AS n FROM flood WHERE pct >= 0.5 GROUP BY ALL UNION ALL SELECT NULL, basin, 'not_used', count(*) FROM flood WHERE pct < 0.5 GROUP BY basin")
def usage_union_by_archive(spark, d):
    f = flood(spark, d)
    used = f.where("pct >= 0.5").groupBy(F.col("archive").alias("source_data"), "basin").agg(F.count("*").alias("n")).withColumn("status", F.lit("used"))
    rest = f.where("pct < 0.5").groupBy("basin").agg(F.count("*").alias("n")).withColumn("status", F.lit("not_used"))
    return R.union_drifting(used, rest).select("source_data", "basin", "status", "n")


@query(f"WITH {FLOOD} SELECT basin, event, archive FROM flood QUALIFY row_number() OVER (PARTITION BY basin ORDER BY CASE archive WHEN 'R' THEN 0 WHEN 'A' THEN 1 ELSE 2 END, event, line) = 1")
def first_seen_basin(spark, d):
    rank = F.when(F.col("archive") == "R", 0).when(F.col("archive") == "A", 1).otherwise(2)
    return R.keep_best(flood(spark, d), ["basin"], rank, F.asc("event"), F.asc("line")).select("basin", "event", "archive")


@query(f"WITH {FLOOD}, {EDGES}, hit AS (SELECT basin FROM flood WHERE pct >= 0.95) SELECT id, id IN (SELECT basin FROM hit) AS flooded FROM edges")
def semi_anti_basins(spark, d):
    hit = flood(spark, d).where("pct >= 0.95").select(F.col("basin").alias("id"))
    e = edges(spark, d).select("id")
    return R.in_any(e, hit, "id").withColumn("flooded", F.lit(True)).unionByName(R.in_none(e, hit, "id").withColumn("flooded", F.lit(False)))


@query(f"WITH {FLOOD} SELECT basin, string_agg(DISTINCT CAST(day AS VARCHAR), ', ' ORDER BY CAST(day AS VARCHAR)) AS dates, count(DISTINCT (day, event)) AS n_maps, string_agg(DISTINCT satellite, ', ' ORDER BY satellite) AS satellites FROM flood GROUP BY basin")
def flood_lists(spark, d):
    f = flood(spark, d).withColumn("date", F.col("day").cast("string"))
    return f.groupBy("basin").agg(R.sorted_list("date").alias("dates"), F.countDistinct(F.struct("date", "event")).alias("n_maps"), R.sorted_list("satellite").alias("satellites"))


CLOSURE = f"WITH RECURSIVE {EDGES}, up AS (SELECT id AS basin, id AS upstream FROM edges UNION SELECT basin, e.id FROM up JOIN edges e ON e.next_down = up.upstream AND e.next_down <> 0)"


@query(f"{CLOSURE} SELECT basin, upstream FROM up")
def upstream_closure(spark, d):
    return N.upstream_closure(edges(spark, d))


@query(f"{CLOSURE} SELECT basin, count(*) - 1 AS n_upstream, count(*) = 1 AS headwater FROM up GROUP BY basin")
def upstream_counts(spark, d):
    return N.upstream_counts(edges(spark, d))


@query(
    f"""WITH RECURSIVE {EDGES}, kept AS (SELECT id FROM edges WHERE id % 3 <> 0),
    ke AS (SELECT e.id, CASE WHEN k.id IS NULL THEN 0 ELSE e.next_down END AS next_down FROM edges e JOIN kept USING (id) LEFT JOIN kept k ON e.next_down = k.id),
    up AS (SELECT id AS basin, id AS upstream FROM ke UNION SELECT basin, ke.id FROM up JOIN ke ON ke.next_down = up.upstream AND ke.next_down <> 0)
    SELECT basin, count(*) - 1 AS n_upstream FROM up GROUP BY basin"""
)
def kept_subgraph_upstream(spark, d):
    e = edges(spark, d)
    return N.upstream_counts(N.kept_edges(e, e.where("id % 3 <> 0"))).drop("headwater")


@query(f"WITH RECURSIVE {EDGES}, path AS (SELECT id AS basin, 0 AS step, id AS place FROM edges UNION ALL SELECT basin, step + 1, e.next_down FROM path JOIN edges e ON e.id = path.place AND e.next_down <> 0) SELECT basin, step, place FROM path")
def downstream_path(spark, d):
    e = edges(spark, d)
    return N.downstream_paths(e, e.select("id"))


@query(f"WITH {EDGES} SELECT count(*) FILTER (next_down = 0) AS n_outlets, count(*) FILTER (next_down IN (SELECT id FROM edges)) AS n_inside, count(*) FILTER (next_down <> 0 AND next_down NOT IN (SELECT id FROM edges)) AS n_missing, count(*) FILTER (next_down IN (SELECT id FROM edges)) * 100.0::DOUBLE / count(*) FILTER (next_down <> 0) AS inside_percentage FROM edges")
def network_referential(spark, d):
    return N.referential_counts(edges(spark, d))


@query("SELECT p_partkey, row_number() OVER (ORDER BY p_partkey) AS dense_id, (row_number() OVER (ORDER BY p_partkey) - 1) // 500 AS chunk FROM part")
def dense_ids_and_chunks(spark, d):
    rows = R.dense_ids(table(spark, d, "part", "p_partkey"), "p_partkey")
    return rows.select("p_partkey", "dense_id", F.floor((F.col("dense_id") - 1) / 500).alias("chunk"))


PAIRS = f"{BOXES}, pairs AS (SELECT a.id AS a_id, b.id AS b_id, (least(a.x1, b.x1) - greatest(a.x0, b.x0)) * (least(a.y1, b.y1) - greatest(a.y0, b.y0)) AS shared, (a.x1 - a.x0) * (a.y1 - a.y0) AS aa, (b.x1 - b.x0) * (b.y1 - b.y0) AS ba, a.x0 <= b.x0 AND a.y0 <= b.y0 AND a.x1 >= b.x1 AND a.y1 >= b.y1 AS holds FROM (SELECT * FROM boxes WHERE brand = 'Brand#11') a JOIN (SELECT * FROM boxes WHERE brand <> 'Brand#11') b ON least(a.x1, b.x1) > greatest(a.x0, b.x0) AND least(a.y1, b.y1) > greatest(a.y0, b.y0))"


def _sides(spark, d):
    return boxes(spark, d, "a").where("a_brand = 'Brand#11'"), boxes(spark, d, "b").where("b_brand <> 'Brand#11'")


def _pairs(spark, d, **measures):
    """Pairs of boxes with measures, which are computed once for boxes in one place."""
    return G.box_join(*_sides(spark, d), 5, measure=lambda p: p.withColumns(measures)).select("a_id", "b_id", *measures)


@query(f"WITH {PAIRS} SELECT a_id, b_id, shared FROM pairs")
def spatial_join_boxes(spark, d):
    return _pairs(spark, d, shared=G.overlap_area())


@query(f"WITH {PAIRS}, s AS (SELECT a_id, b_id, shared / (aa + ba - shared) AS iou FROM pairs) SELECT a_id, b_id, iou FROM s QUALIFY row_number() OVER (PARTITION BY a_id ORDER BY iou DESC, b_id) = 1 AND iou >= 0.5")
def iou_best_match(spark, d):
    return G.best_box_match(*_sides(spark, d), 5, 0.5)


@query(f"WITH {PAIRS} SELECT a_id, b_id, holds, round_even(shared * 100 / ba * 100, 0) / 100 AS clip_percentage, shared / ba >= 0.95 AS covered FROM pairs")
def flood_clip_percentage(spark, d):
    share = F.try_divide(G.overlap_area(), G.box_area("b"))
    return _pairs(spark, d, holds=G.contains_box("a", "b"), clip_percentage=S.percentage(G.overlap_area(), G.box_area("b")), covered=share >= 0.95)


@query(f"WITH {CELLS} SELECT x, y FROM cells c WHERE EXISTS (SELECT 1 FROM cells n WHERE abs(n.x - c.x) <= 1 AND abs(n.y - c.y) <= 1 AND (n.x <> c.x OR n.y <> c.y))")
def isolated_cells(spark, d):
    return G.without_isolated(cells(spark, d))


@query("SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity < 5 THEN NULL WHEN l_quantity < 25 THEN 0.0::DOUBLE WHEN l_linenumber = 7 THEN (l_tax * 100 <= 4)::INT::DOUBLE WHEN l_linestatus = 'O' OR l_returnflag = 'N' THEN 0.0::DOUBLE ELSE (l_tax * 100 <= 4)::INT::DOUBLE END AS flooded FROM lineitem")
def mask_algebra(spark, d):
    c = F.col
    band = F.when(c("l_quantity") < 5, F.lit(float("nan"))).otherwise((c("l_quantity") >= 25).cast("double"))
    permanent = F.when(c("l_linenumber") != 7, (c("l_linestatus") == "O").cast("double"))
    flooded = G.low_enough(G.without_water(band, permanent, c("l_returnflag") == "N"), c("l_tax") * 100, 4.0)
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", flooded.alias("flooded"))


ZONES = "zones AS (SELECT s_suppkey AS zone, (s_suppkey % 30) * 1.5 AS x0, (s_suppkey % 20) * 2.25 AS y0, (s_suppkey % 30) * 1.5 + CASE WHEN s_suppkey % 5 = 0 THEN 0.4 ELSE 6.5 END AS x1, (s_suppkey % 20) * 2.25 + CASE WHEN s_suppkey % 5 = 0 THEN 0.2 ELSE 4.0 END AS y1 FROM supplier)"
BRIDGE = f"{ZONES}, touch AS (SELECT z.*, cx AS x, cy AS y, cx + 0.5 >= x0 AND cx + 0.5 < x1 AND cy + 0.5 >= y0 AND cy + 0.5 < y1 AS inside FROM zones z, range(0, 70) a(cx), range(0, 70) b(cy) WHERE cx >= floor(x0) AND cx <= ceil(x1) - 1 AND cy >= floor(y0) AND cy <= ceil(y1) - 1), bridge AS (SELECT zone, x, y, NOT bool_or(inside) OVER (PARTITION BY zone) AS used_fallback FROM touch QUALIFY inside OR NOT bool_or(inside) OVER (PARTITION BY zone))"


def zones(spark, d):
    k = F.col("s_suppkey")
    x, y = (k % 30) * F.lit(1.5), (k % 20) * F.lit(2.25)
    small = k % 5 == 0
    return table(spark, d, "supplier", "s_suppkey").select(k.alias("zone"), x.alias("x0"), y.alias("y0"), (x + F.when(small, 0.4).otherwise(6.5)).alias("x1"), (y + F.when(small, 0.2).otherwise(4.0)).alias("y1"))


@query(f"WITH {BRIDGE} SELECT zone, x, y, used_fallback FROM bridge")
def zonal_fallback(spark, d):
    return G.zone_cells(zones(spark, d))


@query(f"WITH {BRIDGE}, {GRID} SELECT zone, kind, round(avg(v), 8) AS mean_value, count(v) AS n_cells FROM grid JOIN bridge USING (x, y) GROUP BY zone, kind")
def zonal_mean(spark, d):
    return G.zonal_mean(grid(spark, d), G.zone_cells(zones(spark, d)), ["zone", "kind"], "v").withColumn("mean_value", F.round("mean_value", 8))


@query("SELECT user_id AS basin, event_type, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, round(avg(value), 6) AS mean_value FROM events GROUP BY ALL")
def daily_mean(spark, d):
    return T.daily_mean(series(spark, d), ["basin", "event_type"], "ts", "value").select("basin", "event_type", F.col("day").cast("string").alias("day"), F.round("mean_value", 6).alias("mean_value"))


@query("SELECT user_id AS basin, event_type, CAST(CAST(ts AS DATE) - 1 AS VARCHAR) AS day, value AS last_value FROM events WHERE value IS NOT NULL QUALIFY row_number() OVER (PARTITION BY user_id, event_type, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) = 1")
def daily_last_shifted(spark, d):
    return T.daily_last(series(spark, d), ["basin", "event_type"], "ts", "value", "event_id").withColumn("day", F.col("day").cast("string"))


DAYS = "days AS (SELECT user_id AS basin, CAST(ts AS DATE) AS day, round(sum(value), 6) AS value FROM events GROUP BY ALL)"


def _days(spark, d):
    return series(spark, d).groupBy("basin", F.to_date("ts").alias("day")).agg(F.round(F.sum("value"), 6).alias("value"))


@query(f"WITH {DAYS}, r AS (SELECT basin, min(day) AS a, max(day) AS b FROM days GROUP BY basin), c AS (SELECT basin, CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS day FROM r) SELECT basin, CAST(day AS VARCHAR) AS day, coalesce(value, 0) AS value FROM c LEFT JOIN days USING (basin, day)")
def densified_daily(spark, d):
    days = _days(spark, d)
    return R.daily_calendar(days, ["basin"], "day").join(days, ["basin", "day"], "left").select("basin", F.col("day").cast("string").alias("day"), F.coalesce("value", F.lit(0.0)).alias("value"))


@query(f"WITH {DAYS}, e AS (SELECT basin, day AS event_day FROM days QUALIFY row_number() OVER (PARTITION BY basin ORDER BY value DESC, day) = 1) SELECT basin, CAST(event_day AS VARCHAR) AS event_day, CAST(day - event_day AS BIGINT) AS day_offset, value, round(sum(value) OVER (PARTITION BY basin ORDER BY day ROWS UNBOUNDED PRECEDING), 6) AS running, round(sum(value) FILTER (day <= event_day) OVER (PARTITION BY basin), 6) AS until_event FROM days JOIN e USING (basin) WHERE abs(day - event_day) <= 5")
def event_window(spark, d):
    days = _days(spark, d)
    peak = R.keep_best(days, ["basin"], F.desc("value"), F.asc("day")).select("basin", F.col("day").alias("event_day"))
    w = T.event_windows(days, peak, "basin", 5)
    return w.select("basin", F.col("event_day").cast("string").alias("event_day"), F.col("offset").cast("long").alias("day_offset"), "value", F.round("running", 6).alias("running"), F.round("until_event", 6).alias("until_event"))


@query("SELECT event_id, CASE event_type WHEN 'view' THEN value * 1000 WHEN 'click' THEN value - 273.15 ELSE -value END AS converted, CAST(round_even(value / 0.05, 0) AS INTEGER) AS stored FROM events")
def unit_conversion(spark, d):
    v = F.col("value")
    converted = F.when(F.col("event_type") == "view", v * 1000).when(F.col("event_type") == "click", v - 273.15).otherwise(-v)
    return series(spark, d).select("event_id", converted.alias("converted"), S.packed(v, 0.05, 0.0).alias("stored"))


SIM = "raw AS (SELECT o_custkey % 25 AS basin, CASE WHEN o_orderkey % 11 = 0 THEN 'nan'::DOUBLE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_totalprice END AS s, o_totalprice * (1 + (o_orderkey % 7 - 3) / 100.0::DOUBLE) + CASE WHEN o_orderkey % 7 = 3 THEN 0.004 ELSE 0 END AS o FROM orders), pairs AS (SELECT *, CASE WHEN abs(s - o) <= 0.01 THEN 0 ELSE s - o END AS d, greatest(s, o) >= 200000 AS loud FROM raw WHERE s IS NOT NULL AND NOT isnan(s))"


@query(f"WITH {SIM} SELECT basin, count(*) AS n, count(*) FILTER (loud) AS n_pbias, round(sqrt(avg(d * d)), 4) AS rmse, CASE WHEN count(*) FILTER (loud) = 0 THEN 0.0 ELSE round(100 * sum(d) FILTER (loud) / sum(o) FILTER (loud), 6) END AS pbias, round(avg(s), 4) AS mean_simulated, round(avg(o), 4) AS mean_observed, round(covar_pop(s, o) / nullif(stddev_pop(s) * stddev_pop(o), 0), 8) AS corr, round(stddev_pop(s) / nullif(stddev_pop(o), 0), 8) AS std_ratio FROM pairs GROUP BY basin")
def skill_metrics(spark, d):
    k, price = F.col("o_orderkey"), F.col("o_totalprice")
    simulated = F.when(k % 11 == 0, F.lit(float("nan"))).when(k % 13 != 0, price)
    observed = price * (1 + (k % 7 - 3) / 100.0) + F.when(k % 7 == 3, 0.004).otherwise(0.0)
    out = T.skill(table(spark, d, "orders").select((F.col("o_custkey") % 25).alias("basin"), simulated.alias("s"), observed.alias("o")), ["basin"], "s", "o", signal=200000.0)
    return out.select("basin", "n", "n_pbias", F.round("mean_simulated", 4).alias("mean_simulated"), F.round("mean_observed", 4).alias("mean_observed"), F.round("rmse", 4).alias("rmse"), F.round("pbias", 6).alias("pbias"), F.round("corr", 8).alias("corr"), F.round("std_ratio", 8).alias("std_ratio"))


@query("SELECT l_returnflag AS variable, count(DISTINCT l_suppkey) AS n_basins, median(l_quantity) AS median_value, min(l_quantity) AS min_value, max(l_quantity) AS max_value, round(avg(l_quantity), 6) AS mean_value FROM lineitem GROUP BY l_returnflag")
def skill_summary(spark, d):
    q = F.col("l_quantity")
    return table(spark, d, "lineitem").groupBy(F.col("l_returnflag").alias("variable")).agg(
        F.countDistinct("l_suppkey").alias("n_basins"), F.median(q).alias("median_value"), F.min(q).alias("min_value"), F.max(q).alias("max_value"), F.round(F.avg(q), 6).alias("mean_value")
    )


@query(f"WITH {FLOOD} SELECT archive, count(*) AS n, count(DISTINCT basin) AS n_basins, count(DISTINCT event) AS n_events, count(*) / count(DISTINCT basin) AS per_basin, count(DISTINCT (basin, day)) AS n_days FROM flood GROUP BY archive")
def source_summary(spark, d):
    n, b = F.count("*"), F.countDistinct("basin")
    return flood(spark, d).groupBy("archive").agg(n.alias("n"), b.alias("n_basins"), F.countDistinct("event").alias("n_events"), (n / b).alias("per_basin"), F.countDistinct(F.struct("basin", "day")).alias("n_days"))


@query(f"WITH {FLOOD}, y AS (SELECT year(day) AS y, archive FROM flood), c AS (SELECT unnest(generate_series(min(y), max(y))) AS year FROM y) SELECT CAST(year AS BIGINT) AS year, count(*) FILTER (archive = 'A') AS a, count(*) FILTER (archive = 'N') AS n, count(*) FILTER (archive = 'R') AS r FROM c LEFT JOIN y ON y.y = c.year GROUP BY year")
def events_per_year_pivot(spark, d):
    counts = R.pivot_counts(flood(spark, d).withColumn("year", F.year("day").cast("long")), "year", "archive", ["A", "N", "R"])
    years = counts.agg(F.explode(F.sequence(F.min("year"), F.max("year"))).alias("year"))
    return years.join(counts, "year", "left").na.fill(0).select("year", F.col("A").alias("a"), F.col("N").alias("n"), F.col("R").alias("r"))


@query(f"WITH {FLOOD} SELECT basin, count(*) AS n FROM flood GROUP BY basin ORDER BY n DESC, basin LIMIT 10")
def top_basins(spark, d):
    return flood(spark, d).groupBy("basin").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "basin").limit(10)


@query("SELECT t AS token, count(*) AS n FROM (SELECT unnest(list_filter(list_transform(string_split(p_type || ', ' || p_name, ' '), lambda x: trim(x)), lambda x: x <> '')) AS t FROM part) GROUP BY t")
def token_counts(spark, d):
    items = S.tokens(F.concat_ws(", ", "p_type", "p_name"), " ")
    return table(spark, d, "part").select(F.explode(items).alias("token")).groupBy("token").agg(F.count("*").alias("n"))


TOKENS = ["Sentinel-1", "VIIRS_NOAA", "noaa/viirs", "NOO-VIIRS", " COSMO-SkyMed Second Generation", "35", " Multi-Sensors ", "multi sensor", "", "Landsat 8"]


@query(
    f"""WITH t AS (SELECT p_partkey, array_to_string(list_transform(range(0, 5), lambda i: {TOKENS!r}[1 + (p_partkey * (i + 1) + i * i) % 10]), ',') AS names FROM part),
    u AS (SELECT p_partkey, replace(regexp_replace(names, 'VIIRS-NOAA|VIIRS_NOAA|NOO-VIIRS|NOAA/VIIRS|NOAA_VIIRS', 'NOAA-VIIRS', 'gi'), 'COSMO-SkyMed Second Generation', 'COSMO-SkyMed SG') AS names FROM t),
    x AS (SELECT p_partkey, unnest(string_split(names, ',')) AS token, generate_subscripts(string_split(names, ','), 1) AS i FROM u),
    y AS (SELECT p_partkey, i, regexp_replace(trim(token), '^(35|42|44|58|multi[ _-]*sensors?)$', 'Other', 'i') AS token FROM x WHERE trim(token) <> ''),
    z AS (SELECT p_partkey, token, min(i) AS i FROM y GROUP BY p_partkey, token)
    SELECT p_partkey, coalesce(string_agg(token, ', ' ORDER BY i), '') AS names FROM (SELECT p_partkey FROM part) p LEFT JOIN z USING (p_partkey) GROUP BY p_partkey"""
)
def satellite_normalise(spark, d):
    known = F.array(*map(F.lit, TOKENS))
    names = F.concat_ws(",", *[F.element_at(known, (1 + (F.col("p_partkey") * (i + 1) + i * i) % 10).cast("int")) for i in range(5)])
    return table(spark, d, "part", "p_partkey").select("p_partkey", S.satellites(names).alias("names"))


@query(
    """WITH t AS (SELECT l_orderkey, l_linenumber, l_returnflag, CASE l_returnflag WHEN 'R' THEN 'DFO_' || l_partkey || CASE WHEN l_linenumber = 1 THEN '_Form_x' ELSE '_From_2001' END
    WHEN 'A' THEN l_partkey || CASE WHEN l_linenumber = 1 THEN 'x' ELSE '_map' END ELSE 'EMSR' || l_partkey || '_AOI' || l_linenumber || '_floodmap' END AS stem FROM lineitem)
    SELECT l_orderkey, l_linenumber, CASE l_returnflag WHEN 'R' THEN coalesce(nullif(regexp_extract(stem, '^(DFO_[0-9]+)_From', 1), ''), stem) WHEN 'A' THEN coalesce('UNOSAT_' || nullif(regexp_extract(stem, '^([0-9]+)_', 1), ''), stem)
    ELSE coalesce('EMSR_' || nullif(regexp_extract(stem, '^EMSR([0-9]+)_', 1), ''), stem) END AS event_id, split_part(stem, '_', 1) AS prefix, regexp_replace(stem, '_floodmap$', '') AS stem FROM t"""
)
def event_id_extract(spark, d):
    c, one = F.col, F.col("l_linenumber") == 1
    key = c("l_partkey").cast("string")
    stem = F.when(c("l_returnflag") == "R", F.concat(F.lit("DFO_"), key, F.when(one, "_Form_x").otherwise("_From_2001"))).when(c("l_returnflag") == "A", F.concat(key, F.when(one, "x").otherwise("_map")))
    stem = stem.otherwise(F.concat(F.lit("EMSR"), key, F.lit("_AOI"), c("l_linenumber").cast("string"), F.lit("_floodmap")))
    archive = F.when(c("l_returnflag") == "R", "GFD").when(c("l_returnflag") == "A", "Unosat").otherwise("WorldFloods")
    return table(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_returnflag", "l_partkey").select("l_orderkey", "l_linenumber", S.event_id(stem, archive).alias("event_id"), F.split_part(stem, F.lit("_"), F.lit(1)).alias("prefix"), S.without_suffix(stem, "_floodmap").alias("stem"))


@query("""SELECT c_custkey, coalesce(nullif(regexp_replace(regexp_replace(regexp_replace(CASE WHEN c_custkey % 10 = 0 THEN ' (!) ' ELSE c_mktsegment || ' é' || chr(9) || c_name || ' ' END, '[^\\p{L}\\p{N}_\\s-]', '', 'g'), '\\s+', '_', 'g'), '^_+|_+$', '', 'g'), ''), 'unknown') AS safe_name FROM customer""")
def name_sanitise(spark, d):
    name = F.when(F.col("c_custkey") % 10 == 0, " (!) ").otherwise(F.concat("c_mktsegment", F.lit(" é\t"), "c_name", F.lit(" ")))
    return table(spark, d, "customer").select("c_custkey", S.safe_name(name).alias("safe_name"))


@query("SELECT l_suppkey AS basin, round(sum(l_quantity * l_extendedprice * 0.0001::DOUBLE) / sum(l_extendedprice * 0.0001::DOUBLE), 6) AS weighted_mean FROM lineitem WHERE l_linenumber <> 7 AND l_tax >= 0.03 GROUP BY l_suppkey")
def weighted_mean_sentinel(spark, d):
    rows = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("basin"), F.when(F.col("l_linenumber") == 7, -999.0).otherwise(F.col("l_quantity")).alias("v"), (F.col("l_extendedprice") * 0.0001).alias("w"), "l_tax")
    return T.weighted_mean(rows, ["basin"], "v", "w", "l_tax", 0.03).where("weighted_mean IS NOT NULL").select("basin", F.round("weighted_mean", 6).alias("weighted_mean"))


@query("WITH s AS (SELECT o_custkey % 50 AS basin, CASE WHEN o_orderkey % 3 = 0 THEN 13 ELSE o_custkey % 7 END AS kind, round(sum(o_totalprice), 4) AS weight FROM orders GROUP BY ALL) SELECT basin, kind, weight FROM s QUALIFY row_number() OVER (PARTITION BY basin ORDER BY weight DESC, kind) = 1")
def majority_class(spark, d):
    rows = table(spark, d, "orders").select((F.col("o_custkey") % 50).alias("basin"), F.when(F.col("o_orderkey") % 3 == 0, -999).otherwise(F.col("o_custkey") % 7).alias("kind"), "o_totalprice")
    return T.majority_class(rows, ["basin"], "kind", "o_totalprice", -999, 13).withColumn("weight", F.round("weight", 4))


@query("SELECT p_partkey, CAST(p_retailprice > 950 AS INTEGER) + CAST(p_retailprice > 1100 AS INTEGER) + CAST(p_retailprice > 1500 AS INTEGER) + CAST(p_retailprice > 1800 AS INTEGER) AS band FROM part")
def area_bands(spark, d):
    return table(spark, d, "part").select("p_partkey", S.band(F.col("p_retailprice"), (950, 1100, 1500, 1800)).alias("band"))


@query(
    """WITH e AS (SELECT user_id AS basin, event_type, CAST(ts AS DATE) AS day FROM events), a AS (SELECT basin, min(day) AS a0, max(day) AS b0 FROM e WHERE event_type = 'view' GROUP BY basin),
    b AS (SELECT basin, min(day) AS a1, max(day) AS b1 FROM e WHERE event_type = 'click' GROUP BY basin)
    SELECT basin, CASE WHEN greatest(a0, a1) <= least(b0, b1) THEN CAST(greatest(a0, a1) AS VARCHAR) END AS first_day, CASE WHEN greatest(a0, a1) <= least(b0, b1) THEN CAST(least(b0, b1) AS VARCHAR) END AS last_day FROM a JOIN b USING (basin)"""
)
def overlap_range(spark, d):
    days = series(spark, d).withColumn("day", F.to_date("ts"))
    out = T.overlap_range(days.where("event_type = 'view'"), days.where("event_type = 'click'"), ["basin"])
    return out.select("basin", F.col("first_day").cast("string").alias("first_day"), F.col("last_day").cast("string").alias("last_day"))


@query("SELECT 'doc_id' AS column_name, count(*) FILTER (doc_id IS NULL) AS n_null, count(*) AS n, count(*) FILTER (doc_id IS NULL) / count(*) AS null_rate FROM labels UNION ALL SELECT 'quality', count(*) FILTER (quality IS NULL), count(*), count(*) FILTER (quality IS NULL) / count(*) FROM labels UNION ALL SELECT 'toxic', count(*) FILTER (toxic IS NULL), count(*), count(*) FILTER (toxic IS NULL) / count(*) FROM labels")
def null_rates(spark, d):
    return R.null_rates(table(spark, d, "labels"), ["doc_id", "quality", "toxic"])


@query(
    "SELECT 'area_positive' AS check_name, count(*) FILTER (NOT (l_extendedprice > 0)) = 0 AS passed, count(*) FILTER (NOT (l_extendedprice > 0)) AS n_failed FROM lineitem UNION ALL SELECT 'share_below_half', count(*) FILTER (NOT (l_discount < 0.05)) = 0, count(*) FILTER (NOT (l_discount < 0.05)) FROM lineitem UNION ALL SELECT 'known_source', count(*) FILTER (l_returnflag NOT IN ('A', 'N', 'R')) = 0, count(*) FILTER (l_returnflag NOT IN ('A', 'N', 'R')) FROM lineitem"
)
def quality_checks(spark, d):
    c = F.col
    return R.checks(table(spark, d, "lineitem"), {"area_positive": c("l_extendedprice") > 0, "share_below_half": c("l_discount") < 0.05, "known_source": c("l_returnflag").isin("A", "N", "R")}).select("check_name", "passed", "n_failed")


@query("SELECT o_orderkey, CAST(try_strptime(CASE WHEN o_orderkey % 3 = 0 THEN 'unknown' ELSE strftime(o_orderdate, '%Y-%m-%d') END, '%Y-%m-%d')::DATE AS VARCHAR) AS day FROM orders")
def lenient_dates(spark, d):
    text = F.when(F.col("o_orderkey") % 3 == 0, "unknown").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return table(spark, d, "orders").select("o_orderkey", S.lenient_date(text).cast("string").alias("day"))


@query("SELECT event_id, json_extract_string(props, '$.page') AS page, json_extract_string(props, '$.k') AS k FROM events")
def json_metadata(spark, d):
    return table(spark, d, "events").select("event_id", F.get_json_object("props", "$.page").alias("page"), F.get_json_object("props", "$.k").alias("k"))


@query("SELECT x AS minx, y AS miny, least(x + 7, 180) AS maxx, least(y + 7, 90) AS maxy, printf('hand_lon%+04d_lat%+03d_lon%+04d_lat%+03d.tif', x, y, least(x + 7, 180), least(y + 7, 90)) AS name FROM (SELECT x::INT AS x, y::INT AS y FROM range(-180, 180, 7) a(x), range(-90, 90, 7) b(y))")
def world_tiles(spark, d):
    from alluvia.sources.staging import world_tiles as tiles

    c = F.col
    return tiles(spark, 7).withColumn("name", S.tile_name(c("minx"), c("miny"), c("maxx"), c("maxy")))


@query("WITH m AS (SELECT user_id AS basin, avg(value) FILTER (event_type = 'view') AS a, avg(value) FILTER (event_type = 'click') AS b FROM events GROUP BY user_id) SELECT basin, round((coalesce(a, 0) + coalesce(b, 0)) / nullif((a IS NOT NULL)::INT + (b IS NOT NULL)::INT, 0), 6) AS layer_mean FROM m")
def row_mean_layers(spark, d):
    t = F.col("event_type")
    m = series(spark, d).groupBy("basin").agg(F.avg(F.when(t == "view", F.col("value"))).alias("a"), F.avg(F.when(t == "click", F.col("value"))).alias("b"))
    return m.select("basin", F.round(S.row_mean(F.col("a"), F.col("b")), 6).alias("layer_mean"))


@query(f"WITH {DAYS} SELECT basin, CAST(day AS VARCHAR) AS day, round(sum(value) OVER (PARTITION BY basin ORDER BY day ROWS UNBOUNDED PRECEDING), 6) AS cumulative FROM days")
def cumulative_series(spark, d):
    w = Window.partitionBy("basin").orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    return _days(spark, d).select("basin", F.col("day").cast("string").alias("day"), F.round(F.sum("value").over(w), 6).alias("cumulative"))


OUTLETS = """b AS (SELECT s_suppkey AS id, s_suppkey * 37 % 101 AS x0, s_suppkey * 53 % 89 AS y0, s_suppkey * 37 % 101 + 3 + s_suppkey % 11 AS x1, s_suppkey * 53 % 89 + 3 + s_suppkey % 7 AS y1 FROM supplier),
    r AS (SELECT *, (x1 - x0) * (y1 - y0) AS area, row_number() OVER (ORDER BY (x1 - x0) * (y1 - y0) DESC, id) AS rn FROM b),
    over AS (SELECT j.rn, list(i.rn) AS by_ FROM r i JOIN r j ON i.rn < j.rn AND greatest(least(i.x1, j.x1) - greatest(i.x0, j.x0), 0) * greatest(least(i.y1, j.y1) - greatest(i.y0, j.y0), 0) > j.area * 0.5 GROUP BY j.rn),
    cur AS (SELECT r.rn, r.id, coalesce(by_, []) AS by_ FROM r LEFT JOIN over USING (rn))"""


@query(
    f"""WITH RECURSIVE {OUTLETS}, s AS (SELECT CAST(0 AS BIGINT) AS rn, CAST([] AS BIGINT[]) AS kept UNION ALL
    SELECT cur.rn, CASE WHEN list_has_any(s.kept, cur.by_) THEN s.kept ELSE list_append(s.kept, cur.rn) END FROM s JOIN cur ON cur.rn = s.rn + 1)
    SELECT id FROM cur WHERE rn IN (SELECT unnest(kept) FROM (SELECT kept FROM s ORDER BY rn DESC LIMIT 1))"""
)
def non_overlapping_outlets(spark, d):
    k = F.col("s_suppkey")
    x, y = k * 37 % 101, k * 53 % 89
    b = table(spark, d, "supplier", "s_suppkey").select(k.alias("id"), x.alias("x0"), y.alias("y0"), (x + 3 + k % 11).alias("x1"), (y + 3 + k % 7).alias("y1"))
    return G.non_dominated(b, 8)


@query(
    """WITH g AS (SELECT l_partkey % 60 AS x, l_orderkey % 60 AS y, max(l_quantity) AS v FROM lineitem GROUP BY ALL),
    p AS (SELECT s_suppkey AS id, s_suppkey % 61 + 0.25 AS px, s_suppkey // 61 % 60 + 0.75 AS py FROM supplier)
    SELECT id, (SELECT CASE WHEN count(v) = 4 THEN CAST(sum(v * (1 - abs(px - 0.5 - x)) * (1 - abs(py - 0.5 - y))) AS DOUBLE) END FROM g
    WHERE abs(px - 0.5 - x) < 1 AND abs(py - 0.5 - y) < 1) AS value FROM p"""
)
def bilinear_resample(spark, d):
    top = table(spark, d, "lineitem", "l_partkey", "l_orderkey", "l_quantity").groupBy((F.col("l_partkey") % 60).alias("x"), (F.col("l_orderkey") % 60).alias("y")).agg(F.max("l_quantity").alias("v"))
    k = F.col("s_suppkey")
    p = table(spark, d, "supplier", "s_suppkey").select(k.alias("id"), (k % 61 + F.lit(0.25)).alias("px"), (F.floor(k / 61) % 60 + F.lit(0.75)).alias("py"))
    return G.bilinear(p, top).select("id", "value")


@query("SELECT o_orderkey, o_custkey FROM orders QUALIFY count(*) OVER (PARTITION BY o_custkey, o_orderpriority) > 1")
def repeated_keys(spark, d):
    return R.repeated_keys(table(spark, d, "orders"), "o_custkey", "o_orderpriority").select("o_orderkey", "o_custkey")


@query("SELECT p_partkey, round(2 + 8 * (ln(1 + p_size) - a) / (b - a), 9) AS scaled FROM part, (SELECT ln(1 + min(p_size)) AS a, ln(1 + max(p_size)) AS b FROM part)")
def log_scaled_size(spark, d):
    return R.log_scaled(table(spark, d, "part", "p_partkey", "p_size"), "p_size", 2.0, 10.0).select("p_partkey", F.round("scaled", 9).alias("scaled"))


@query("SELECT column_name, value, count(DISTINCT f) AS n_files, count(*) AS n FROM (SELECT 'l_returnflag' AS column_name, l_returnflag AS value, l_suppkey AS f FROM lineitem UNION ALL SELECT 'l_linestatus', l_linestatus, l_suppkey FROM lineitem) GROUP BY column_name, value")
def value_profile(spark, d):
    return R.value_profile(table(spark, d, "lineitem", "l_returnflag", "l_linestatus", "l_suppkey"), ["l_returnflag", "l_linestatus"], "l_suppkey")
