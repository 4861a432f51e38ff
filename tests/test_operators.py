import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from alluvia.functions import scalars
from alluvia.operators import checks, network, relational, series
from alluvia.sources.staging import shared_path
from alluvia.streaming.daily import daily_stream, load_available


def test_dense_ids_of_a_million_rows(spark):
    keys = spark.range(1_000_000, numPartitions=7).select(((F.col("id") * 7919) % 1_000_003).alias("key"))
    out = relational.dense_ids(keys, "key")
    told = out.agg(F.countDistinct("dense_id").alias("n"), F.min("dense_id").alias("a"), F.max("dense_id").alias("b"), F.countDistinct(F.col("__p") if "__p" in out.columns else F.lit(1)).alias("p")).first()
    assert (told["n"], told["a"], told["b"]) == (1_000_000, 1, 1_000_000)
    broken = out.join(out.select((F.col("dense_id") - 1).alias("dense_id"), F.col("key").alias("next")), "dense_id").where("next <= key")
    assert broken.count() == 0


def test_sums_keep_small_values(spark):
    df = spark.createDataFrame([(1, 0.0031, 0.003), (1, 0.0042, 0.001), (1, float("nan"), 5.0), (1, -999.0, 9.0)], "basin long, v double, w double")
    day = df.where("v > -999").withColumn("ts", F.lit("2020-01-01").cast("timestamp"))
    assert series.daily_mean(day, ["basin"], "ts", "v").first()["mean_value"] == pytest.approx(0.00365)
    assert series.weighted_mean(df, ["basin"], "v", "w").first()["weighted_mean"] == pytest.approx((0.0031 * 0.003 + 0.0042 * 0.001) / 0.004)
    assert series.weighted_mean(df.where("v = -999"), ["basin"], "v", "w").first()["weighted_mean"] is None


@pytest.mark.parametrize("signal", [None, 1.0, 100.0])
def test_skill_against_numpy(spark, signal):
    rng = np.random.default_rng(3)
    s, o = rng.random(500) * 3, rng.random(500) * 3
    o[:50] = s[:50] + 0.005
    s[100], o[101], s[102] = np.nan, np.inf, -np.inf
    rows = [(1, float(a), float(b)) for a, b in zip(s, o)] + [(2, 5.0, 7.0), (2, 5.0, 8.0), (3, float("nan"), 1.0), (4, None, 1.0)]
    got = {r["k"]: r for r in series.skill(spark.createDataFrame(rows, "k long, s double, o double"), ["k"], "s", "o", signal=signal).collect()}
    keep = np.isfinite(s) & np.isfinite(o)
    s, o = s[keep], o[keep]
    d = np.where(np.abs(s - o) <= 0.01, 0, s - o)
    loud = np.maximum(s, o) >= (signal or -1)
    r = got[1]
    assert (r["n"], r["n_pbias"]) == (len(s), int(loud.sum())) and r["rmse"] == pytest.approx(np.sqrt((d**2).mean()))
    assert r["pbias"] == pytest.approx(100 * d[loud].sum() / o[loud].sum() if loud.any() else 0.0)
    assert r["corr"] == pytest.approx(np.corrcoef(s, o)[0, 1]) and r["std_ratio"] == pytest.approx(s.std() / o.std())
    assert got[2]["corr"] is None and got[2]["std_ratio"] is None and set(got) == {1, 2}


def test_nan_neither_passes_nor_wins(spark):
    df = spark.createDataFrame([(1, float("nan")), (1, 0.5), (1, None), (2, float("nan"))], "k long, pct double")
    assert df.where(scalars.at_least(F.col("pct"), 0.1)).count() == 1
    best = relational.keep_best(df.withColumn("pct", scalars.finite(F.col("pct"))), ["k"], F.desc_nulls_last("pct"))
    assert {r["k"]: r["pct"] for r in best.collect()} == {1: 0.5, 2: None}


def brute_counts(edges):
    up = {}
    for i, d in edges:
        up.setdefault(d, set()).add(i)
    out = {}
    for i, _ in edges:
        seen, todo = {i}, [i]
        while todo:
            for j in up.get(todo.pop(), ()):
                if j not in seen and j != 0:
                    seen.add(j)
                    todo.append(j)
        out[i] = len(seen) - 1
    return out


def test_upstream_counts_of_forests_chains_and_cycles(spark):
    rng = random.Random(5)
    edges = [(i, rng.randrange(0, i)) for i in range(1, 300)]
    edges += [(1000 + i, 1000 + i + 1) for i in range(150)] + [(1150, 0)]  # a chain
    edges += [(2000 + i, 2000 + (i + 1) % 5) for i in range(5)] + [(2100, 2000), (2101, 2100)]  # a cycle and what drains into it
    edges += [(3000, 9999)]  # downstream basin is missing
    df = spark.createDataFrame(edges, "id long, next_down long")
    expected = brute_counts(edges)
    got = {r["basin"]: (r["n_upstream"], r["headwater"]) for r in network.upstream_counts(df).collect()}
    assert got == {k: (n, n == 0) for k, n in expected.items()}
    some = {2000, 2101, 1100, 7}
    closure = network.upstream_closure(df, spark.createDataFrame([(x,) for x in some], "id long"))
    assert {r["basin"]: r["n"] for r in closure.groupBy("basin").agg((F.count("*") - 1).alias("n")).collect()} == {k: expected[k] for k in some}
    assert network.upstream_counts(spark.createDataFrame([], "id long, next_down long")).collect() == []


def test_pour_points_stop_at_the_edge(spark):
    rows = [(1, 4, 3, 9.0, 10.0), (1, 3, 2, 8.0, 10.0), (1, 2, 1, 4.0, 10.0), (1, 5, 3, 1.0, 10.0), (2, 7, 0, 3.0, 3.0), (3, 8, 9, 5.0, 5.0), (3, 9, 8, 4.0, 5.0)]
    got = sorted(tuple(r) for r in network.pour_points(spark.createDataFrame(rows, "basin long, id long, next_down long, overlap double, area double")).select("basin", "place", "feeder").collect())
    assert got == [(1, 3, False), (1, 4, True), (1, 5, True), (2, 7, False), (3, 8, False), (3, 9, True)]


def test_names_dates_and_packing(spark):
    one = spark.range(1)
    value = lambda c: one.select(c.alias("x")).first()["x"]
    assert value(scalars.safe_name(F.lit("Überflutung\t(Köln) 2021! "))) == "Überflutung_Köln_2021" and value(scalars.safe_name(F.lit(" !"))) == "unknown"
    assert value(scalars.satellites(F.lit("35, Sentinel-1,noaa/viirs , multi-sensor, Sentinel-1"))) == "Other, Sentinel-1, NOAA-VIIRS"
    assert value(scalars.event_id(F.lit("DFO_12_From_2"), F.lit("GFD"))) == "DFO_12" and value(scalars.event_id(F.lit("x"), F.lit("Unosat"))) == "x"
    assert value(scalars.packed(F.lit(float("nan")), 0.1, 0.0)) == -32768 and value(scalars.unpacked(F.lit(-32768), 0.1, 0.0)) is None
    with pytest.raises(Exception, match="packed range"):
        value(scalars.packed(F.lit(1e9), 0.1, 0.0))
    schema = spark.createDataFrame([], "a string, sensor_dat string, made timestamp").schema
    assert scalars.date_column(schema) == "made" and scalars.date_column(schema[:2]) == "sensor_dat" and scalars.date_column(schema[:1]) is None


def test_guards(spark):
    df = spark.createDataFrame([(1, float("nan"))], "a long, b double")
    with pytest.raises(ValueError, match="no finite value in b"):
        checks.with_finite(df, ["a", "b"])
    with pytest.raises(ValueError, match="no column c"):
        checks.with_columns_present(df, ["a", "c"])
    assert [r["present"] for r in checks.paths_present(spark, ["/root/testdata/sf0.001", "/nowhere"]).collect()] == [True, False]


def test_event_windows_meet_only_near_days(spark):
    rng = random.Random(2)
    days = [(k, d, rng.random()) for k in range(3) for d in range(60)]
    events = [(k, d) for k in range(3) for d in (0, 7, 8, 30, 59)]
    as_day = F.date_add(F.lit("2020-01-01"), F.col("d")).alias("day")
    got = series.event_windows(spark.createDataFrame(days, "k long, d int, value double").select("k", as_day, "value"), spark.createDataFrame(events, "k long, d int").select("k", as_day.alias("event_day")), "k", 4).collect()
    assert len(got) == sum(abs(d - e) <= 4 for k, d, _ in days for j, e in events if j == k)
    for r in got:
        e = (r["event_day"] - r["day"]).days
        assert r["offset"] == -e
    first = [r for r in got if r["k"] == 0 and r["event_day"].day == 8 and r["event_day"].month == 1]
    assert max(r["running"] for r in first) == pytest.approx(sum(v for k, d, v in days if k == 0 and abs(d - 7) <= 4))
    assert first[0]["until_event"] == pytest.approx(sum(v for k, d, v in days if k == 0 and 3 <= d <= 7))


def test_daily_stream_counts_late_rows(spark, tmp_path):
    checkpoint = shared_path(spark, "stream")

    def arrive(rows):
        df = spark.createDataFrame(rows, "basin long, at string, value double").select("basin", F.col("at").cast("timestamp").alias("ts"), "value")
        df.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    def load():
        stream = spark.readStream.schema("basin long, ts timestamp, value double").parquet(str(tmp_path / "in"))
        load_available(daily_stream(stream, ["basin"], "ts", "value"), str(tmp_path / "out"), checkpoint)
        return spark.read.parquet(str(tmp_path / "out")).where("day < '2024-01-20'").agg(F.sum("n"), F.sum("total")).first()

    arrive([(i % 2, f"2024-01-0{1 + i % 3} 0{i % 9}:00:00", i + 0.0031) for i in range(40)])
    load()
    arrive([(0, "2024-01-02 05:00:00", 0.0042), (0, "2024-01-02 06:00:00", float("nan"))])  # late, within the watermark
    load()
    arrive([(0, "2024-02-01 00:00:00", 1.0)])
    for _ in range(2):  # a second start finds nothing new
        n, total = load()
        assert n == 41 and math.isclose(total, sum(i + 0.0031 for i in range(40)) + 0.0042)
