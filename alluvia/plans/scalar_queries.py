"""Queries over scalar functions, filters and tables put together, each with its DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from alluvia.functions import scalars as S
from alluvia.operators import relational as R
from alluvia.operators import series as T
from alluvia.plans.registry import FLOOD, flood, query
from alluvia.sources.staging import grid_axes, months, table

NAMES = ["Flood_Extent", "PreFlood_water", "flood_cloud", "ST1_FloodDamage", "Flood_Analysis_Extent", "river", "flood 2021"]
DATES = ["2021-02-03", "2021-02-30", "n/a!", "", "2020-12-31 10:11:12"]


def _pick(values: list[str], key: str):
    return F.element_at(F.array(*map(F.lit, values)), (1 + F.col(key) % len(values)).cast("int"))


@query(f"SELECT p_partkey, lower({NAMES!r}[1 + p_partkey % 7]) LIKE '%flood%' AND NOT regexp_matches(lower({NAMES!r}[1 + p_partkey % 7]), 'preflood|analysis_extent|analysisextent|cloud|damage') AS is_flood FROM part")
def flood_layer_names(spark, d):
    return table(spark, d, "part", "p_partkey").select("p_partkey", S.is_flood_layer(_pick(NAMES, "p_partkey")).alias("is_flood"))


@query(
    f"""WITH t AS (SELECT s_suppkey, {DATES!r}[1 + s_suppkey % 5] AS d, 'a/b/unosat_filesystem/' || s_suppkey || '/x.zip' AS p FROM supplier)
    SELECT s_suppkey, CASE s_suppkey % 5 WHEN 0 THEN '20210203' WHEN 1 THEN '20210230' WHEN 2 THEN 'na' WHEN 3 THEN 'nodate' ELSE '20201231' END AS compact, split_part('2021-05-06T07:08:09', 'T', 1) AS prefix,
    CASE WHEN s_suppkey % 2 = 0 THEN CAST(s_suppkey AS VARCHAR) END AS folder, CAST(DATE '1951-01-01' + CAST(s_suppkey AS INT) AS VARCHAR) AS day,
    CAST(CAST(date_trunc('month', DATE '1951-01-01' + CAST(s_suppkey AS INT)) + INTERVAL 1 MONTH AS DATE) AS VARCHAR) AS next_month, 'http://x/' || s_suppkey || '/N_shp.zip' AS second_candidate FROM t"""
)
def dates_and_paths(spark, d):
    key = F.col("s_suppkey").cast("string")
    path = F.concat(F.when(F.col("s_suppkey") % 2 == 0, "a/b/unosat_filesystem/").otherwise("a/b/other/"), key, F.lit("/x.zip"))
    day = S.epoch_day(F.col("s_suppkey"))
    return table(spark, d, "supplier", "s_suppkey").select(
        "s_suppkey", S.compact_date(_pick(DATES, "s_suppkey")).alias("compact"), S.date_prefix(F.lit("2021-05-06T07:08:09")).alias("prefix"), S.path_part(path, 3, 2, "unosat_filesystem").alias("folder"),
        day.cast("string").alias("day"), S.next_month(day).cast("string").alias("next_month"), F.get(S.url_candidates("http://x", key, F.lit("N")), F.lit(1)).alias("second_candidate"),
    )


VARIABLES = ["total_evaporation", "surface_net_solar_radiation", "snow_depth_water_equivalent", "surface_pressure", "2m_temperature"]


@query(
    f"""WITH t AS (SELECT event_id, value, {VARIABLES!r}[1 + event_id % 5] AS variable FROM events)
    SELECT event_id, round_even(CASE variable WHEN 'total_evaporation' THEN -value WHEN 'surface_net_solar_radiation' THEN value * (1 / 86400::DOUBLE) WHEN 'snow_depth_water_equivalent' THEN value * 1000 WHEN 'surface_pressure' THEN value * 0.001::DOUBLE ELSE value END * 100, 0) / 100 AS published,
    CASE WHEN variable IN ('total_evaporation', 'snow_depth_water_equivalent') THEN round_even(value, 0) ELSE round_even(value * 100, 0) / 100 END AS rounded,
    CASE WHEN abs(value - 50) <= 0.5 THEN 0 ELSE value - 50 END AS difference, greatest(0, least(100, 100 - abs(value))) AS agreement, CASE WHEN value > 50 THEN round(log10(value), 9) END AS log_value,
    CASE variable WHEN 'total_evaporation' THEN 'e' WHEN 'surface_net_solar_radiation' THEN 'ssr' WHEN 'snow_depth_water_equivalent' THEN 'sd' WHEN 'surface_pressure' THEN 'sp' ELSE 't2m' END AS short_name,
    CASE variable WHEN 'surface_net_solar_radiation' THEN 'surface_net_solar_radiation_mean' WHEN 'snow_depth_water_equivalent' THEN 'snow_depth_water_equivalent_mean' WHEN 'surface_pressure' THEN 'surface_pressure_mean' WHEN '2m_temperature' THEN 'temperature_2m_mean' END AS compared FROM t"""
)
def published_values(spark, d):
    v, variable = F.col("value"), _pick(VARIABLES, "event_id")
    short = {long: s for s, long in S.LONG_NAMES.items()}
    return table(spark, d, "events", "event_id", "value").select(
        "event_id", S.published(variable, v).alias("published"), S.by_variable(variable, v).alias("rounded"), S.dead_band(v - 50, 0.5).alias("difference"), S.agreement(v).alias("agreement"),
        F.round(S.log10_positive(F.when(v > 50, v).otherwise(-v)), 9).alias("log_value"), S.chosen(variable, short, F.lit(None)).alias("short_name"),
        F.when(variable != "total_evaporation", S.chosen(variable, S.COMPARED, F.lit(None))).alias("compared"),
    )


@query("SELECT event_id, CAST(round_even(value / 0.05, 0) AS INTEGER) AS stored, round(CAST(round_even(value / 0.05, 0) AS INTEGER) * 0.05::DOUBLE, 6) AS again FROM events WHERE event_id % 7 <> 0 UNION ALL SELECT event_id, -32768, NULL FROM events WHERE event_id % 7 = 0")
def packed_round_trip(spark, d):
    stored = table(spark, d, "events", "event_id", "value").select("event_id", S.packed(F.when(F.col("event_id") % 7 == 0, F.lit(float("nan"))).otherwise(F.col("value")), 0.05, 0.0).alias("stored"))
    return stored.withColumn("again", F.round(S.unpacked(F.col("stored"), 0.05, 0.0), 6))


@query("SELECT c_custkey, c_name FROM customer")
def without_empty_columns(spark, d):
    c = table(spark, d, "customer", "c_custkey", "c_name", "c_mktsegment").withColumn("grdc_id", F.lit(None).cast("long"))
    return R.without_empty_columns(c, "c_mktsegment", "not_there")


@query(
    """WITH t AS (SELECT p_partkey, p_size % 10 AS layer, CASE WHEN p_size % 10 < 5 THEN p_type END AS first_class, p_brand AS second_class FROM part),
    h AS (SELECT layer, bool_or(coalesce(first_class LIKE 'PROMO%', FALSE)) AS hit FROM t GROUP BY layer)
    SELECT p_partkey, layer FROM t JOIN h USING (layer) WHERE CASE WHEN hit THEN first_class LIKE 'PROMO%' ELSE second_class = 'Brand#11' END"""
)
def probed_class_column(spark, d):
    p = table(spark, d, "part", "p_partkey", "p_size", "p_type", "p_brand")
    kinds = [r[0] for r in p.where("p_type LIKE 'PROMO%'").select("p_type").distinct().collect()]  # a closed set of classes
    p = p.select("p_partkey", (F.col("p_size") % 10).alias("layer"), F.when(F.col("p_size") % 10 < 5, F.col("p_type")).alias("first_class"), F.col("p_brand").alias("second_class"))
    return R.probed_class(p, "layer", "first_class", "second_class", [*kinds, "Brand#11"]).select("p_partkey", "layer")


@query("SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey <> 7 AND c_mktsegment IN ('BUILDING', 'MACHINERY') ORDER BY c_custkey LIMIT 50")
def first_customers(spark, d):
    c = table(spark, d, "customer", "c_custkey", "c_mktsegment").where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY") & (F.col("c_custkey") != 7))
    return R.first_rows(c, 50, F.asc("c_custkey"))


@query("SELECT l_orderkey, l_linenumber, round_even(l_quantity, 0)::BIGINT AS l_quantity, round_even(l_tax * 100, 0) / 100 AS l_tax, l_comment_mm FROM (SELECT *, round_even(l_extendedprice, 0)::BIGINT AS l_comment_mm FROM lineitem)")
def columns_by_pattern(spark, d):
    rows = table(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_tax", "l_returnflag").withColumnRenamed("l_extendedprice", "l_comment_mm")
    kept = R.properties_left(rows, ["l_returnflag"])
    whole = [c for c in R.columns_like(rows, "_mm") + ["l_quantity"]]
    digits = [c for c in R.columns_like(rows, "l_t", numeric=True) if c not in whole]
    return rows.select(*kept).withColumns({c: S.half_even(F.col(c), 0).cast("long") for c in whole} | {c: S.half_even(F.col(c)) for c in digits})


@query("SELECT d.doc_id, coalesce(l.quality, -1) AS quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id)")
def labels_with_defaults(spark, d):
    return R.with_defaults(table(spark, d, "documents", "doc_id"), table(spark, d, "labels"), "doc_id", {"quality": -1, "toxic": None}).select("doc_id", "quality", "toxic")


@query(f"WITH {FLOOD}, p AS (SELECT basin, count(*) FILTER (archive = 'A') AS a, count(*) FILTER (archive = 'N') AS n, count(*) FILTER (archive = 'R') AS r FROM flood GROUP BY basin) SELECT *, a + n + r AS total FROM p ORDER BY total DESC, basin")
def satellite_pivot_ranked(spark, d):
    counts = R.pivot_counts(flood(spark, d), "basin", "archive", ["A", "N", "R"]).select("basin", F.col("A").alias("a"), F.col("N").alias("n"), F.col("R").alias("r"))
    return R.by_row_total(counts, "basin", ["a", "n", "r"])


@query(f"WITH {FLOOD} SELECT count(*) AS rows_before, count(DISTINCT basin) AS keys_before, count(*) FILTER (pct >= 0.95) AS rows_after, count(DISTINCT basin) FILTER (pct >= 0.95) AS keys_after, round(count(*) FILTER (pct >= 0.95) * 100.0::DOUBLE / count(*), 9) AS rows_kept, round(count(DISTINCT basin) FILTER (pct >= 0.95) * 100.0::DOUBLE / count(DISTINCT basin), 9) AS keys_kept FROM flood")
def kept_shares(spark, d):
    f = flood(spark, d)
    return R.kept_shares(f, f.where(S.at_least(F.col("pct"), 0.95)), "basin").withColumns({c: F.round(c, 9) for c in ("rows_kept", "keys_kept")})


@query("SELECT l_orderkey AS event, CAST(CAST(arg_min(l_shipdate, (l_linenumber, l_shipdate)) AS DATE) AS VARCHAR) AS first_day FROM lineitem WHERE l_returnflag <> 'N' GROUP BY l_orderkey UNION ALL SELECT l_orderkey, NULL FROM lineitem GROUP BY l_orderkey HAVING bool_and(l_returnflag = 'N')")
def first_valid_date(spark, d):
    rows = table(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_shipdate", "l_returnflag").withColumn("day", F.when(F.col("l_returnflag") != "N", F.to_date("l_shipdate"))).withColumn("at", F.struct("l_linenumber", "l_shipdate"))
    return rows.groupBy(F.col("l_orderkey").alias("event")).agg(R.first_valid("day", "at").cast("string").alias("first_day"))


@query("SELECT CAST(p_partkey AS VARCHAR) AS id, row_number() OVER (ORDER BY CAST(p_partkey AS VARCHAR)) AS place FROM part")
def ids_sorted_as_text(spark, d):
    return R.dense_ids(table(spark, d, "part", "p_partkey").select(F.col("p_partkey").cast("string").alias("id")), "id", "place").select("id", "place")


@query("SELECT l_suppkey, l_orderkey, l_linenumber FROM lineitem WHERE l_quantity >= 49 ORDER BY l_suppkey, l_orderkey, l_linenumber")
def sorted_by_keys(spark, d):
    return table(spark, d, "lineitem", "l_suppkey", "l_orderkey", "l_linenumber", "l_quantity").where("l_quantity >= 49").select("l_suppkey", "l_orderkey", "l_linenumber").orderBy("l_suppkey", "l_orderkey", "l_linenumber")


@query("SELECT p_partkey, round(1 + 9 * (p_retailprice - a) / (b - a), 9) AS scaled FROM part, (SELECT min(p_retailprice) AS a, max(p_retailprice) AS b FROM part)")
def linear_scaled_price(spark, d):
    return R.linear_scaled(table(spark, d, "part", "p_partkey", "p_retailprice"), "p_retailprice", 1.0, 10.0).select("p_partkey", F.round("scaled", 9).alias("scaled"))


@query(
    """WITH a AS (SELECT user_id, CAST(ts AS DATE) AS day, max(value) AS v FROM events WHERE event_type = 'view' GROUP BY ALL), b AS (SELECT user_id, CAST(ts AS DATE) AS day, max(value) AS v FROM events WHERE event_type = 'click' GROUP BY ALL),
    k AS (SELECT user_id, day FROM a UNION SELECT user_id, day FROM b)
    SELECT k.user_id AS basin, CAST(k.day AS VARCHAR) AS day, coalesce(a.v, b.v) AS value, coalesce(b.v, a.v) AS later FROM k LEFT JOIN a ON k.user_id = a.user_id AND k.day = a.day LEFT JOIN b ON k.user_id = b.user_id AND k.day = b.day"""
)
def merged_series(spark, d):
    days = table(spark, d, "events").groupBy(F.col("user_id").alias("basin"), "event_type", F.to_date("ts").cast("string").alias("day")).agg(F.max("value").alias("value"))
    one, other = (days.where(F.col("event_type") == t).select("basin", "day", "value", F.concat_ws("|", F.col("basin").cast("string"), "day").alias("k")) for t in ("view", "click"))
    later = R.later_wins([one, other], "k").select("basin", "day", F.col("value").alias("later"))
    return R.merged([one, other], ["basin", "day"], "value").join(later, ["basin", "day"])


@query("SELECT event_id, CAST(ts + to_hours(event_id % 24) AS TIMESTAMP) AS valid_time, value FROM events UNION ALL SELECT -event_id, CAST(ts AS TIMESTAMP), value FROM events WHERE event_type = 'view'")
def valid_times(spark, d):
    e = table(spark, d, "events", "event_id", "ts", "value", "event_type")
    steps = e.select("event_id", F.col("ts").alias("time"), (F.col("event_id") % 24).cast("int").alias("step_hours"), "value")
    again = e.where("event_type = 'view'").select((-F.col("event_id")).alias("event_id"), F.col("ts").alias("time"), F.lit(0).alias("step_hours"), "value")
    return T.valid_times(steps.union(again)).select("event_id", "valid_time", "value")


@query("SELECT event_id, CAST(CAST(date_trunc('month', CASE WHEN event_id % 5 = 0 THEN TIMESTAMP '2024-02-01 00:00:00' - INTERVAL 1 SECOND ELSE ts END) AS DATE) AS VARCHAR) AS month FROM events")
def month_of_accumulation(spark, d):
    e = table(spark, d, "events", "event_id", "ts").withColumn("ts", F.when(F.col("event_id") % 5 == 0, F.timestamp_add("DAY", F.lit(0), F.lit("2024-02-01").cast("timestamp"))).otherwise(F.col("ts")))
    return T.with_next_month_start(e, "month", "ts").select("event_id", F.col("month").cast("string").alias("month"))


@query("SELECT r AS row, c AS col, 90 - r * 2.5::DOUBLE AS latitude, -180 + c * 2.5::DOUBLE AS longitude FROM (SELECT CAST(a.r AS BIGINT) AS r, CAST(b.c AS INTEGER) AS c FROM range(0, 61) a(r), range(0, 144) b(c))")
def grid_axes_of_the_world(spark, d):
    return grid_axes(spark, 2.5).select("row", "col", "latitude", "longitude")


@query("SELECT CAST(CAST(m AS DATE) AS VARCHAR) AS month FROM range(TIMESTAMP '1999-01-01', TIMESTAMP '2026-06-01', INTERVAL 1 MONTH) t(m)")
def months_of_the_archive(spark, d):
    return months(spark, "1999-01-01", "2026-05-31").select(F.col("month").cast("string").alias("month"))


@query("SELECT user_id AS basin, count(*) AS n FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-09' GROUP BY user_id")
def date_slice(spark, d):
    return table(spark, d, "events", "user_id", "ts").where((F.col("ts") >= "2024-01-05") & (F.col("ts") < "2024-01-10")).groupBy(F.col("user_id").alias("basin")).agg(F.count("*").alias("n"))


@query("SELECT w.id AS id, c.c_name AS name, c.c_custkey IS NOT NULL AS found FROM (VALUES (3::BIGINT), (-1::BIGINT)) w(id) LEFT JOIN customer c ON c.c_custkey = w.id")
def point_lookup(spark, d):
    c = table(spark, d, "customer", "c_custkey", "c_name")
    hits = c.where(F.col("c_custkey").isin(3, -1))
    asked = spark.createDataFrame([(3,), (-1,)], "id long")
    return asked.join(hits, asked.id == hits.c_custkey, "left").select("id", F.col("c_name").alias("name"), F.col("c_custkey").isNotNull().alias("found"))


@query("WITH m AS (SELECT o_custkey % 25 AS basin, o_orderpriority AS variable, sqrt(avg((o_totalprice - 1000) ** 2)) AS rmse, avg(o_totalprice) AS mean_observed FROM orders GROUP BY ALL) SELECT variable, round(median(rmse / abs(mean_observed)), 8) AS median_nrmse FROM m GROUP BY variable")
def median_relative_error(spark, d):
    p = F.col("o_totalprice")
    m = table(spark, d, "orders").groupBy((F.col("o_custkey") % 25).alias("basin"), F.col("o_orderpriority").alias("variable")).agg(F.sqrt(F.avg((p - 1000) * (p - 1000))).alias("rmse"), F.avg(p).alias("mean_observed"))
    return T.median_relative_error(m, "variable").withColumn("median_nrmse", F.round("median_nrmse", 8))


@query(
    """WITH a AS (SELECT user_id AS basin, CAST(ts AS DATE) AS day, max(value) AS simulated FROM events WHERE event_type = 'view' GROUP BY ALL), b AS (SELECT user_id AS basin, CAST(ts AS DATE) AS day, max(value) AS observed FROM events WHERE event_type = 'click' GROUP BY ALL)
    SELECT basin, CAST(day AS VARCHAR) AS day, simulated, observed FROM a JOIN b USING (basin, day)"""
)
def aligned_series(spark, d):
    days = table(spark, d, "events").groupBy(F.col("user_id").alias("basin"), "event_type", F.to_date("ts").alias("day")).agg(F.max("value").alias("value"))
    return T.aligned(days.where("event_type = 'view'"), days.where("event_type = 'click'"), ["basin"]).withColumn("day", F.col("day").cast("string"))


FRAGMENTS = "fragments AS (SELECT l_suppkey % 20 AS basin, l_orderkey % 40 + 1 AS id, (l_orderkey % 40 + 1) // 2 AS next_down, round(sum(l_quantity), 4) AS overlap, round(sum(l_quantity) * (1 + (l_orderkey % 40) % 4), 4) AS area, CASE WHEN l_orderkey % 40 % 9 = 0 THEN -999.0 ELSE round(sum(l_extendedprice), 4) END AS value FROM lineitem GROUP BY l_suppkey % 20, l_orderkey % 40)"


def fragments(spark, d):
    k = F.col("k")
    rows = table(spark, d, "lineitem", "l_suppkey", "l_orderkey", "l_quantity", "l_extendedprice").groupBy((F.col("l_suppkey") % 20).alias("basin"), (F.col("l_orderkey") % 40).alias("k"))
    summed = rows.agg(F.sum("l_quantity").alias("q"), F.sum("l_extendedprice").alias("p"))
    return summed.select("basin", (k + 1).alias("id"), F.floor((k + 1) / 2).alias("next_down"), F.round("q", 4).alias("overlap"), F.round(F.col("q") * (1 + k % 4), 4).alias("area"), F.when(k % 9 == 0, -999.0).otherwise(F.round("p", 4)).alias("value"))


WALK = f"""WITH RECURSIVE {FRAGMENTS}, start AS (SELECT basin, id AS place FROM fragments QUALIFY row_number() OVER (PARTITION BY basin ORDER BY overlap DESC, id) = 1),
    walk AS (SELECT basin, place, 0 AS step FROM start UNION ALL SELECT w.basin, f.next_down, step + 1 FROM walk w JOIN fragments f ON f.basin = w.basin AND f.id = w.place JOIN fragments g ON g.basin = w.basin AND g.id = f.next_down AND g.overlap >= 0.5 * g.area WHERE f.next_down <> 0),
    ends AS (SELECT basin, place FROM walk QUALIFY row_number() OVER (PARTITION BY basin ORDER BY step DESC) = 1),
    points AS (SELECT basin, place, FALSE AS feeder FROM ends UNION ALL SELECT f.basin, f.id, TRUE FROM fragments f JOIN ends e ON f.basin = e.basin AND f.next_down = e.place)"""


@query(f"{WALK} SELECT basin, place, feeder FROM points")
def pour_points(spark, d):
    from alluvia.operators.network import pour_points as walk

    return walk(fragments(spark, d)).select("basin", "place", "feeder")


@query(f"{WALK}, fed AS (SELECT basin, bool_or(feeder) AS fed FROM points GROUP BY basin) SELECT f.basin, round(sum(value) FILTER (value > -999), 4) AS value FROM fragments f JOIN points p ON f.basin = p.basin AND f.id = p.place JOIN fed ON fed.basin = p.basin AND p.feeder = fed.fed GROUP BY f.basin")
def pour_point_sum(spark, d):
    from alluvia.operators.network import pour_points as walk

    f = fragments(spark, d)
    return T.pour_point_sums(f, walk(f), "value").withColumn("value", F.round("value", 4))


@query(f"WITH {FRAGMENTS} SELECT basin, round(sum(area), 4) AS area, round(sum(area) FILTER (overlap >= 0.5 * area) / sum(area), 8) AS used_fraction FROM fragments GROUP BY basin")
def used_fraction(spark, d):
    out = T.used_fraction(fragments(spark, d), ["basin"], F.col("overlap") >= 0.5 * F.col("area"), "area")
    return out.select("basin", F.round("area", 4).alias("area"), F.round("used_fraction", 8).alias("used_fraction"))


@query(f"WITH {FLOOD} SELECT event, CAST(min(day) AS VARCHAR) AS first_day, string_agg(DISTINCT satellite, ', ' ORDER BY satellite) AS sensors FROM flood GROUP BY event")
def sensors_by_event(spark, d):
    return flood(spark, d).groupBy("event").agg(F.min("day").cast("string").alias("first_day"), R.sorted_list("satellite").alias("sensors"))
