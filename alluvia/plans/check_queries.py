"""Checks of tables as queries, each with its DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from alluvia.functions import geometry as G
from alluvia.operators import checks as C
from alluvia.plans.registry import BOXES, boxes, flood_lists, query
from alluvia.sources.staging import table


def _sql(rows: dict[str, str], source: str, before: str = "") -> str:
    """One row for each check; a failure count is computed once from the source."""
    one = ", ".join(f"coalesce(({v})::BIGINT, 0) AS {k}" for k, v in rows.items())
    return f"WITH {before}counts AS (SELECT {one} FROM {source}) " + " UNION ALL ".join(f"SELECT '{k}' AS check_name, {k} = 0 AS passed, {k} AS n_failed FROM counts" for k in rows)


@query(_sql({"key_unique": "count(*) - count(DISTINCT (l_orderkey, l_linenumber))", "dense_unique": "count(*) - count(DISTINCT l_linenumber)", "dense_from_one": "(min(l_linenumber) <> 1)::INT", "dense_to_n": "(max(l_linenumber) <> count(*))::INT"}, "lineitem"))
def key_checks(spark, d):
    return C.key_checks(table(spark, d, "lineitem", "l_orderkey", "l_linenumber"), ["l_orderkey", "l_linenumber"], "l_linenumber")


@query(_sql({"shape_not_null": "count(*) FILTER (id % 7 = 0)", "shape_not_empty": "0", "shape_valid": "0", "longitude_in_range": "count(*) FILTER (id % 7 <> 0 AND x1 * 4 > 180)", "latitude_in_range": "count(*) FILTER (id % 7 <> 0 AND y1 * 3 > 90)"}, "boxes", f"{BOXES}, "))
def geometry_checks(spark, d):
    b = boxes(spark, d, "a")
    shape = F.when(F.col("a_id") % 7 != 0, G.st_box(F.col("a_x0") * 4, F.col("a_y0") * 3, F.col("a_x1") * 4, F.col("a_y1") * 3))
    return C.geometry_checks(b.select(shape.alias("shape")), "shape")


LISTS = "l AS (SELECT l_suppkey + 1 AS basin, CASE WHEN l_suppkey % 9 = 0 THEN 'z, , b' ELSE string_agg(DISTINCT CAST(CAST(l_shipdate AS DATE) AS VARCHAR), ', ' ORDER BY CAST(CAST(l_shipdate AS DATE) AS VARCHAR)) END AS dates, count(DISTINCT CAST(l_shipdate AS DATE)) AS n FROM lineitem GROUP BY l_suppkey), "


def _lists(spark, d):
    held = flood_lists(spark, d).select("basin", "dates", F.size(F.split("dates", ", ")).cast("long").alias("n"))
    return held.withColumn("dates", F.when((F.col("basin") - 1) % 9 == 0, "z, , b").otherwise(F.col("dates")))


@query(_sql({"list_length_is_count": "count(*) FILTER (dates = 'z, , b' AND n <> 2)", "list_not_empty": "0", "list_sorted": "count(*) FILTER (dates = 'z, , b')", "items_not_empty": "count(*) FILTER (dates = 'z, , b')"}, "l", LISTS))
def list_checks(spark, d):
    return C.list_checks(_lists(spark, d), "dates", "n")


@query(_sql({"dates_parse": "count(*) FILTER (try_cast(item AS DATE) IS NULL)", "not_before_first": "count(*) FILTER (try_cast(item AS DATE) < DATE '1993-01-01')", "not_after_today": "count(*) FILTER (try_cast(item AS DATE) > DATE '1997-06-01')"}, "(SELECT unnest(string_split(replace(dates, ', ,', ','), ', ')) AS item FROM l)", LISTS))
def date_checks(spark, d):
    return C.date_checks(_lists(spark, d), "dates", "1993-01-01", "1997-06-01")


@query(
    _sql(
        {
            "area_positive": "count(*) FILTER (NOT m2 > 0)", "units_agree": "count(*) FILTER (NOT abs(m2 / 1e6 - km2) < 0.01)", "units_agree_when_small": "count(*) FILTER (NOT (abs(m2 / 1e6 - km2) <= 0.005 OR abs(m2 / 1e6 - km2) <= 0.1 * (m2 / 1e6)))",
            "percentage_up_to_100": "count(*) FILTER (pct > 100)", "area_within_factor_two": "count(*) FILTER (NOT again / m2 BETWEEN 0.5 AND 2.0)", "percentage_within_a_point": "count(*) FILTER (NOT abs(m2 * 100 / whole - pct) <= 1)",
        },
        "(SELECT o_totalprice * 100 AS m2, CASE WHEN o_orderkey % 5 = 0 THEN o_totalprice / 1e4 + 0.02 ELSE round_even(o_totalprice / 1e4 * 100, 0) / 100 END AS km2, o_totalprice / 4000.0::DOUBLE AS pct, o_totalprice * (o_orderkey % 9) * 25 AS again, CASE WHEN o_orderkey % 4 = 0 THEN 300000.0::DOUBLE ELSE 400000.0::DOUBLE END * 100 AS whole FROM orders)",
    )
)
def area_checks(spark, d):
    price, k = F.col("o_totalprice"), F.col("o_orderkey")
    rows = table(spark, d, "orders", "o_orderkey", "o_totalprice").select(
        (price * 100).alias("m2"), F.when(k % 5 == 0, price / 1e4 + 0.02).otherwise(F.rint(price / 1e4 * 100) / 100).alias("km2"), (price / 4000.0).alias("pct"), (price * (k % 9) * 25).alias("again"),
        (F.when(k % 4 == 0, 300000.0).otherwise(400000.0) * 100).alias("whole"),
    )
    return C.area_checks(rows, "m2", "km2", "pct", "again", "whole")


@query(_sql({"value_known": "count(*) FILTER (l_returnflag NOT IN ('A', 'N', 'X'))", "occurs_A": "(count(*) FILTER (l_returnflag = 'A') = 0)::INT", "occurs_N": "(count(*) FILTER (l_returnflag = 'N') = 0)::INT", "occurs_X": "(count(*) FILTER (l_returnflag = 'X') = 0)::INT"}, "lineitem"))
def domain_checks(spark, d):
    return C.domain_checks(table(spark, d, "lineitem", "l_returnflag"), "l_returnflag", ["A", "N", "X"])


@query("SELECT 'key_known' AS check_name, n = 0 AS passed, n AS n_failed, round(c, 8) AS coverage_percentage FROM (SELECT count(*) FILTER (o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 7 <> 0)) AS n, (SELECT count(*) FILTER (c_custkey IN (SELECT o_custkey FROM orders)) * 100.0::DOUBLE / count(*) FROM customer WHERE c_custkey % 7 <> 0) AS c FROM orders)")
def reference_checks(spark, d):
    known = table(spark, d, "customer", "c_custkey").where("c_custkey % 7 <> 0").withColumnRenamed("c_custkey", "o_custkey")
    return C.reference_checks(table(spark, d, "orders", "o_custkey"), "o_custkey", known).withColumn("coverage_percentage", F.round("coverage_percentage", 8))


@query("SELECT l_orderkey, l_linenumber, l_tax FROM lineitem WHERE l_tax > 0.07")
def guarded_table(spark, d):
    rows = table(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_tax")
    return C.with_finite(C.with_columns_present(rows, ["l_orderkey", "l_tax"]), ["l_tax"]).where("l_tax > 0.07")
