"""Registered queries on tables grown by shifted keys, on which rows repeat places that are distinct in the small ones."""

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from alluvia.functions import geometry as G
from alluvia.operators import spatial as S
from alluvia.operators.linking import link_floods, link_floods_by_basin
from alluvia.plans.catalogue import ORACLES, QUERIES

from test_registry import plain


@pytest.fixture(scope="module")
def grown(tmp_path_factory):
    folder = tmp_path_factory.mktemp("grown")
    pq.write_table(pa.table({"s_suppkey": list(range(1400))}), folder / "supplier.parquet")
    part = pq.read_table("/root/testdata/sf0.001/part.parquet")
    n = part.num_rows
    shifted = [part.set_column(part.schema.get_field_index("p_partkey"), "p_partkey", pa.array([v + k * 120 * n for v in part["p_partkey"].to_pylist()])) for k in range(3)]
    pq.write_table(pa.concat_tables(shifted), folder / "part.parquet")
    return str(folder)


def same_as_sql(spark, folder, name):
    con = duckdb.connect()
    for t in ("part", "supplier"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    expected = con.execute(ORACLES[name])
    names = [c[0] for c in expected.description]
    got = QUERIES[name](spark, folder)
    rows = plain([tuple(r) for r in got.collect()], got.columns)
    assert rows == plain(expected.fetchall(), names)
    return rows


def test_basins_that_overlap_count_in_full(spark, grown):
    assert same_as_sql(spark, grown, "flood_basin_links")


def test_links_by_basin_are_those_of_united_catchments(spark):
    def at(rows, key):
        return spark.createDataFrame([(k, G.write(G.box(*b))) for k, *b in rows], f"{key} long, shape binary")

    basins = at([(1, 0, 0, 1, 1), (2, 1, 0, 2, 1), (3, 2, 0, 3, 1), (4, 8, 0, 9, 1)], "id").join(spark.createDataFrame([(1, 0), (2, 1), (3, 2), (4, 1)], "id long, next_down long"), "id")
    floods, extents = at([(7, 0.5, 0.25, 2.5, 0.75), (7, 2, 0.25, 2.75, 0.75)], "event"), at([(7, 0, 0, 5, 5)], "event")
    (one, used), (two, also) = link_floods(basins, floods, extents, 2), link_floods_by_basin(basins, floods, extents, 2)
    keys = ["event", "basin", "headwater", "n_upstream", F.round("area_m2", 3), "area_km2", "percentage"]
    told = sorted(map(tuple, two.select(*keys).collect()))
    assert told == sorted(map(tuple, one.select(*keys).collect())) and [r[1] for r in told] == [2, 3]
    assert sorted(map(tuple, used.collect())) == sorted(map(tuple, also.collect()))


@pytest.mark.parametrize("name", ["flood_clip_percentage", "iou_best_match", "spatial_join_boxes", "polygon_intersects", "polygon_best_match", "polygon_overlaps", "polygon_set_operations", "non_overlapping_shapes"])
def test_boxes_that_repeat_give_all_their_rows(spark, grown, name):
    same_as_sql(spark, grown, name)


def parts(folder, *rows):
    """A folder with a table of parts (key, brand) of one size."""
    keys, brands = zip(*rows)
    pq.write_table(pa.table({"s_suppkey": [0]}), folder / "supplier.parquet")
    pq.write_table(pa.table({"p_partkey": list(keys), "p_brand": list(brands), "p_size": pa.array([5] * len(rows), pa.int32())}), folder / "part.parquet")
    return str(folder)


def test_best_polygon_match_is_sought_in_all_other_brands(spark, tmp_path):
    folder = parts(tmp_path, (1, "Brand#11"), (121, "Brand#31"), (241, "Brand#21"), (5, "Brand#11"), (125, "Brand#55"), (9, "Brand#11"), (129, "Brand#11"))
    same_as_sql(spark, folder, "polygon_best_match")
    assert sorted(map(tuple, QUERIES["polygon_best_match"](spark, folder).collect())) == [(1, 121, 1.0), (5, 125, 1.0)]


def test_polygon_set_operations_have_all_rows_of_both_sides(spark, tmp_path):
    folder = parts(tmp_path, (1, "Brand#11"), (2, "Brand#11"), (3, "Brand#11"), (122, "Brand#31"), (243, "Brand#55"), (1, "Brand#21"), (20, "Brand#31"))
    same_as_sql(spark, folder, "polygon_set_operations")
    got = QUERIES["polygon_set_operations"](spark, folder).select("a_id", "b_id")
    assert sorted(map(tuple, got.collect())) == [(a, b) for a in (1, 2, 3) for b in (1, 122, 243)]


def test_areas_of_an_overlay_are_those_of_its_shapes():
    holed, bar, far = [*G.box(0, 0, 6, 6), *G.box(2, 2, 4, 4)], G.box(1, 3, 7, 5), G.box(9, 9, 10, 10)
    for a, b in ((holed, bar), (bar, holed), (holed, holed), (holed, far), (holed, []), ([], [])):
        assert G.overlay_areas(a, b) == pytest.approx([G.area(r) for r in (G.union([a, b]), G.difference(a, b), G.intersection(a, b))], abs=1e-12)


def squares(spark, prefix, n, low):
    df = spark.range(n).select(F.col("id").alias(f"{prefix}_id"), *[F.lit(float(v)).alias(f"{prefix}_{k}") for k, v in (("x0", low), ("y0", low), ("x1", low + 2), ("y1", low + 2))])
    return df.withColumn(f"{prefix}_shape", G.st_box(*[F.col(f"{prefix}_{k}") for k in ("x0", "y0", "x1", "y1")]))


def test_boxes_in_one_place_are_measured_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def area(x):
        seen.add(1)
        return float(x)

    a, b = squares(spark, "a", 700, 0).drop("a_shape"), squares(spark, "b", 30, 1).drop("b_shape")
    measure = lambda p: p.withColumn("m", area.asNondeterministic()(S.overlap_area()))
    got = S.staged(S.box_join(a, b, 5, measure=lambda p: S.staged(measure(p), "measured")).select("a_id", "b_id", "m"), "told")
    assert got.distinct().count() == got.count() == 21_000 and got.where("m <> 1").isEmpty() and seen.value == 1


def test_best_matches_of_equal_boxes_and_shapes_go_to_the_least_id(spark):
    a, b = squares(spark, "a", 5, 0), squares(spark, "b", 7, 0).unionByName(squares(spark, "b", 3, 1).withColumn("b_id", F.col("b_id") - 9))
    for found in (S.best_box_match(a, b, 3, 0.5), S.best_polygon_match(a.select("a_id", "a_shape"), b.select("b_id", "b_shape"), 3, 0.5)):
        assert sorted(map(tuple, found.collect())) == [(k, 0, 1.0) for k in range(5)]


def test_equal_shapes_are_compared_once(spark):
    a, b = squares(spark, "a", 40, 0).select("a_id", "a_shape"), squares(spark, "b", 50, 1).select("b_id", "b_shape")
    counts = []

    def measure(p):
        counts.append(p.count())
        return p

    pairs = S.overlap_pairs(a, b, 3, measure).select("a_id", "b_id", F.round("shared", 9).alias("shared"))
    assert pairs.distinct().count() == pairs.count() == 2000 and pairs.where("shared <> 1").isEmpty() and counts == [1]
    assert S.polygon_join(a, b.withColumn("b_id", F.lit(1)), 3).count() == 2000


def test_shapes_decided_in_batches_are_those_decided_at_once(spark):
    k = F.col("id")
    x, y = k * 37 % 31, k * 53 % 29
    some = spark.range(400).select("id", G.st_box(x, y, x + 3 + k % 5, y + 3 + k % 4).alias("shape"))
    odd = spark.createDataFrame([(900, None), (901, bytes.fromhex("0101000000000000000000f03f000000000000f03f"))], "id long, shape binary")
    df = some.unionByName(some.withColumn("id", F.col("id") + 1000)).unionByName(odd)
    one, few = (sorted(r["id"] for r in S.non_dominated_shapes(df, 6, first=n).collect()) for n in (100_000, 20))
    boxes = spark.range(400).select("id", x.alias("x0"), y.alias("y0"), (x + 3 + k % 5).alias("x1"), (y + 3 + k % 4).alias("y1"))
    assert one == few == sorted([900, 901, *(r["id"] for r in S.non_dominated(boxes, 6).collect())])
