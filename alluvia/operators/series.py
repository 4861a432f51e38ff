"""Time series: daily values, event windows, skill metrics and weighted attributes. Sums are doubles; results are rounded by who asks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from alluvia.functions.scalars import dead_band, finite
from alluvia.operators.relational import keep_best


def daily_mean(df: DataFrame, keys: list[str], ts: str, value: str) -> DataFrame:
    """Mean of each day's finite values; null if there are none."""
    v = finite(F.col(value))
    return df.groupBy(*keys, F.to_date(ts).alias("day")).agg(F.avg(v).alias("mean_value"))


def daily_last(df: DataFrame, keys: list[str], ts: str, value: str, tie: str) -> DataFrame:
    """The last value of each day after a shift by one day back, for values that accumulate until midnight."""
    shifted = df.where(finite(F.col(value)).isNotNull()).withColumn("day", F.date_sub(F.to_date(ts), 1))
    return keep_best(shifted, [*keys, "day"], F.desc(ts), F.desc(tie)).select(*keys, "day", F.col(value).alias("last_value"))


def with_next_month_start(months: DataFrame, month: str, ts: str) -> DataFrame:
    """Rows by the month that they count for: those of the first moment of a month belong to the month before, so that accumulations to midnight are whole."""
    at_start = F.col(ts) == F.trunc(ts, "month").cast("timestamp")
    return months.withColumn(month, F.trunc(F.when(at_start, F.date_sub(F.to_date(ts), 1)).otherwise(F.to_date(ts)), "month"))


def valid_times(df: DataFrame, time: str = "time", step: str = "step_hours") -> DataFrame:
    """df with valid_time, the time plus the step, instead of both."""
    return df.withColumn("valid_time", F.timestamp_add("HOUR", F.col(step), F.col(time))).drop(time, step)


def event_windows(series: DataFrame, events: DataFrame, key: str, days: int) -> DataFrame:
    """Rows of a series within so many days of an event, with the offset, the running sum, and the sum up to the event's day.

    Joined on the key and a band of 2 * days + 1 days, of which an event meets two at most, so that a key's days only meet the events near them.
    """
    width = 2 * days + 1
    band = lambda day: F.floor(F.datediff(day, F.lit("1970-01-01")) / width)
    near = events.withColumn("__band", F.explode(F.sequence(band(F.date_sub("event_day", days)), band(F.date_add("event_day", days)))))
    joined = series.withColumn("__band", band(F.col("day"))).join(near, [key, "__band"]).drop("__band").where(F.abs(F.datediff("day", "event_day")) <= days)
    group = Window.partitionBy(key, "event_day")
    running = F.sum("value").over(group.orderBy("day").rowsBetween(Window.unboundedPreceding, 0))
    until = F.sum(F.when(F.col("day") <= F.col("event_day"), F.col("value"))).over(group)
    return joined.withColumn("offset", F.datediff("day", "event_day")).withColumn("running", running).withColumn("until_event", until)


def aligned(one: DataFrame, other: DataFrame, keys: list[str], day: str = "day", value: str = "value") -> DataFrame:
    """simulated and observed of the days that both series have."""
    return one.select(*keys, day, F.col(value).alias("simulated")).join(other.select(*keys, day, F.col(value).alias("observed")), [*keys, day])


def overlap_range(one: DataFrame, other: DataFrame, keys: list[str], day: str = "day") -> DataFrame:
    """first_day and last_day that both series of a key span, null for both if they span none."""
    ends = lambda df, x: df.groupBy(*keys).agg(F.min(day).alias(f"a{x}"), F.max(day).alias(f"b{x}"))
    both = ends(one, 0).join(ends(other, 1), keys)
    first, last = F.greatest("a0", "a1"), F.least("b0", "b1")
    return both.select(*keys, F.when(first <= last, first).alias("first_day"), F.when(first <= last, last).alias("last_day"))


def skill(pairs: DataFrame, keys: list[str], simulated: str, observed: str, negligible: float = 0.01, signal: float | Column | None = None) -> DataFrame:
    """n, n_pbias, rmse, pbias in per cent, corr, std_ratio and both means of the pairs that are finite on both sides.

    Differences of at most negligible are 0 in rmse and pbias. With a signal, pbias counts the pairs of which one side at least
    reaches it; it is 0 if none does. What isn't defined is null (no pair, a sum of 0, a constant series).
    """
    s, o = finite(F.col(simulated).cast("double")), finite(F.col(observed).cast("double"))
    both = pairs.select(*keys, s.alias("s"), o.alias("o"), *([] if signal is None else [(signal if isinstance(signal, Column) else F.lit(signal)).alias("least")])).where("s IS NOT NULL AND o IS NOT NULL")
    s, o = F.col("s"), F.col("o")
    d = dead_band(s - o, negligible)
    loud = F.lit(True) if signal is None else F.col("least").isNull() | (F.greatest(s, o) >= F.col("least"))
    bias = F.try_divide(100 * F.sum(F.when(loud, d)), F.nullif(F.sum(F.when(loud, o)), F.lit(0.0)))
    both_vary = (F.stddev_pop(s) > 0) & (F.stddev_pop(o) > 0)
    return both.groupBy(*keys).agg(
        F.count("*").alias("n"),
        F.count_if(loud).alias("n_pbias"),
        F.sqrt(F.avg(d * d)).alias("rmse"),
        F.when(F.count_if(loud) == 0, F.lit(0.0)).otherwise(bias).alias("pbias"),
        F.when(both_vary, F.try_divide(F.covar_pop(s, o), F.nullif(F.stddev_pop(s) * F.stddev_pop(o), F.lit(0.0)))).alias("corr"),
        F.when(both_vary, F.try_divide(F.stddev_pop(s), F.nullif(F.stddev_pop(o), F.lit(0.0)))).alias("std_ratio"),
        F.avg(s).alias("mean_simulated"),
        F.avg(o).alias("mean_observed"),
    )


def median_relative_error(metrics: DataFrame, key: str) -> DataFrame:
    """Median by key of rmse over the amount of the observed mean; rows with a mean of 0 are left out."""
    return metrics.groupBy(key).agg(F.median(F.try_divide(F.col("rmse"), F.nullif(F.abs("mean_observed"), F.lit(0.0)))).alias("median_nrmse"))


MISSING = -999.0


def weighted_mean(df: DataFrame, keys: list[str], value: str, weight: str, overlap: str | None = None, least: float = 0.0, missing: float = MISSING) -> DataFrame:
    """Weighted mean of the values above the sentinel, of rows whose overlap reaches the least; null if no weight is left."""
    there = finite(F.col(value)) > missing
    if overlap:
        there &= F.col(overlap) >= least
    return df.groupBy(*keys).agg(F.try_divide(F.sum(F.when(there, F.col(value) * F.col(weight))), F.nullif(F.sum(F.when(there, F.col(weight))), F.lit(0.0))).alias("weighted_mean"))


def majority_class(df: DataFrame, keys: list[str], kind: str, weight: str, missing: object = None, instead: object = None) -> DataFrame:
    """The class of most weight, ties to the least class. Rows of the missing class are left out, or count as another if one is named."""
    named = F.col(kind) if missing is None else F.when(F.col(kind) == missing, F.lit(instead)).otherwise(F.col(kind))
    sums = df.withColumn(kind, named).where(F.col(kind).isNotNull()).groupBy(*keys, kind).agg(F.sum(weight).alias("weight"))
    return keep_best(sums, keys, F.desc("weight"), F.asc(kind))


def used_fraction(df: DataFrame, keys: list[str], used: Column, area: str) -> DataFrame:
    """The area of all fragments, and the share of it that is used."""
    total = F.sum(area)
    return df.groupBy(*keys).agg(total.alias("area"), F.try_divide(F.sum(F.when(used, F.col(area)).otherwise(0.0)), F.nullif(total, F.lit(0.0))).alias("used_fraction"))


def pour_point_sums(fragments: DataFrame, points: DataFrame, value: str, missing: float = MISSING) -> DataFrame:
    """Sum by basin of the values (above the sentinel) of the fragments that feed its pour point, or of the point itself if none do."""
    fed = points.groupBy("basin").agg(F.max("feeder").alias("fed"))
    taken = points.join(fed, "basin").where("feeder = fed").select("basin", F.col("place").alias("id"))
    there = fragments.join(taken, ["basin", "id"], "left_semi")
    return there.groupBy("basin").agg(F.sum(F.when(finite(F.col(value)) > missing, F.col(value))).alias(value))
