"""Keep-best, first-seen, lists by key, dense ids, densified calendars and pivots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from alluvia.sources.staging import staged


def keep_best(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each key by a total order."""
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("__n = 1").drop("__n")


def sorted_list(column: str, separator: str = ", ") -> Column:
    """Distinct values of a group, sorted and joined."""
    return F.array_join(F.array_sort(F.collect_set(column)), separator)


def dense_ids(df: DataFrame, key: str, name: str = "dense_id") -> DataFrame:
    """Ids 1..N in key order without moving all rows to one task: counts by range partition are added up, ranks are local.

    The rows are dealt by ranges once and written with their range's number, as dealing them again may cut the ranges elsewhere.
    """
    ranged = staged(df.repartitionByRange(key).withColumn("__p", F.spark_partition_id()), "ranged")
    counts = ranged.groupBy("__p").agg(F.count("*").alias("__c"))
    before = counts.select(F.col("__p"), F.coalesce(F.sum("__c").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    local = ranged.withColumn("__n", F.row_number().over(Window.partitionBy("__p").orderBy(key)))
    return local.join(F.broadcast(before), "__p").withColumn(name, F.col("__before") + F.col("__n")).drop("__p", "__n", "__before")  # one row for each partition


def in_any(df: DataFrame, others: DataFrame, key: str) -> DataFrame:
    return df.join(others.select(key).distinct(), key, "left_semi")


def in_none(df: DataFrame, others: DataFrame, key: str) -> DataFrame:
    return df.join(others.select(key).distinct(), key, "left_anti")


def without_empty_columns(df: DataFrame, *also: str) -> DataFrame:
    """df without the columns that are null in all rows (or listed), found in one pass; a table without rows keeps its columns."""
    filled = df.agg(F.count("*").alias("__n"), *[F.count(F.col(c)).alias(c) for c in df.columns]).first()
    empty = [c for c in df.columns if filled["__n"] and not filled[c]]
    return df.drop(*empty, *also)


def probed_class(df: DataFrame, layer: str, first: str, second: str, wanted: list[str]) -> DataFrame:
    """Rows of the wanted classes: by the first class column in layers where it has any of them, by the second in the others."""
    hits = df.groupBy(layer).agg(F.max(F.col(first).isin(*wanted)).alias("__by_first"))
    return df.join(hits, layer).where(F.when(F.coalesce("__by_first", F.lit(False)), F.col(first).isin(*wanted)).otherwise(F.col(second).isin(*wanted))).drop("__by_first")


def first_rows(df: DataFrame, n: int | None, *order: Column, matched: Column | None = None) -> DataFrame:
    """The first n rows in order, or only the matched ones if there is no n."""
    return df.orderBy(*order).limit(n) if n is not None else df if matched is None else df.where(matched)


def columns_like(df: DataFrame, part: str = "", numeric: bool = False) -> list[str]:
    """Names of columns that hold a part, or are numbers."""
    from pyspark.sql.types import NumericType

    return [f.name for f in df.schema if part in f.name and (not numeric or isinstance(f.dataType, NumericType))]


def properties_left(df: DataFrame, *without: list[str]) -> list[str]:
    """Columns in order that no list names."""
    gone = {c for names in without for c in names}
    return [c for c in df.columns if c not in gone]


def with_defaults(df: DataFrame, others: DataFrame, key: str, defaults: dict[str, object]) -> DataFrame:
    """df with columns of others by key; a default where there is no row or value."""
    joined = df.join(others.select(key, *defaults), key, "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items() if v is not None})


def union_drifting(*frames: DataFrame) -> DataFrame:
    """UNION ALL by name; columns that a frame lacks are null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def daily_calendar(df: DataFrame, keys: list[str], day: str) -> DataFrame:
    """All days of each key's range."""
    ranges = df.groupBy(*keys).agg(F.min(day).alias("__a"), F.max(day).alias("__b"))
    return ranges.select(*keys, F.explode(F.sequence("__a", "__b", F.expr("interval 1 day"))).alias(day))


def pivot_counts(df: DataFrame, key: str, column: str, values: list[str]) -> DataFrame:
    """Counts of each value as columns, 0 where there are none."""
    return df.groupBy(key).agg(*[F.count_if(F.col(column) == v).alias(v) for v in values])


def null_rates(df: DataFrame, columns: list[str]) -> DataFrame:
    """column_name, n_null, n and null_rate (null without rows) of each column, from one pass."""
    one = df.agg(F.count("*").alias("n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return one.select("n", F.explode(F.map_from_arrays(F.array(*map(F.lit, columns)), F.array(*columns))).alias("column_name", "n_null")).withColumn("null_rate", F.try_divide("n_null", "n"))


def checks(df: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """check_name, passed and n_failed of row conditions, from one pass; a condition that is null fails."""
    one = df.agg(*[F.count_if(~F.coalesce(c, F.lit(False))).alias(k) for k, c in conditions.items()])
    pairs = F.map_from_arrays(F.array(*map(F.lit, conditions)), F.array(*conditions))
    return one.select(F.explode(pairs).alias("check_name", "n_failed")).withColumn("passed", F.col("n_failed") == 0)


def repeated_keys(df: DataFrame, *keys: str) -> DataFrame:
    """All rows whose key occurs more than once; counts are joined back, so that no task holds a hot key."""
    more = df.groupBy(*keys).agg(F.count("*").alias("__c")).where("__c > 1").select(*keys)
    return df.join(more, list(keys), "left_semi")


def log_scaled(df: DataFrame, column: str, low: float, high: float, name: str = "scaled") -> DataFrame:
    """log(1 + column) mapped from the table's range to low..high; low where the range is a point."""
    ends = df.agg(F.log1p(F.min(column)).alias("__a"), F.log1p(F.max(column)).alias("__b"))
    share = F.coalesce(F.try_divide(F.log1p(column) - F.col("__a"), F.col("__b") - F.col("__a")), F.lit(0.0))
    return df.join(F.broadcast(ends)).withColumn(name, F.when(F.col(column).isNotNull(), low + share * (high - low))).drop("__a", "__b")  # one row


def linear_scaled(df: DataFrame, column: str, low: float, high: float, name: str = "scaled") -> DataFrame:
    """column mapped from the table's range to low..high; low where the range is a point."""
    ends = df.agg(F.min(column).alias("__a"), F.max(column).alias("__b"))
    share = F.coalesce(F.try_divide(F.col(column) - F.col("__a"), F.col("__b") - F.col("__a")), F.lit(0.0))
    return df.join(F.broadcast(ends)).withColumn(name, F.when(F.col(column).isNotNull(), low + share * (high - low))).drop("__a", "__b")  # one row


def by_row_total(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Rows by the sum of the columns, the largest first, ties by key."""
    total = sum((F.col(c) for c in columns[1:]), F.col(columns[0]))
    return df.withColumn("total", total).orderBy(F.desc("total"), key)


def kept_shares(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """Rows and keys before and after a filter, and the share of each that is left in per cent (null: there were none)."""
    counts = lambda df, x: df.agg(F.count("*").alias(f"rows_{x}"), F.countDistinct(key).alias(f"keys_{x}"))
    both = counts(before, "before").join(F.broadcast(counts(after, "after")))  # one row each
    return both.withColumns({f"{x}_kept": F.try_divide(F.col(f"{x}_after") * 100.0, F.col(f"{x}_before")) for x in ("rows", "keys")})


def first_valid(value: str, position: str) -> Column:
    """The first value of a group that isn't null, by position."""
    return F.min_by(value, F.when(F.col(value).isNotNull(), F.col(position)))


def merged(frames: list[DataFrame], keys: list[str], column: str) -> DataFrame:
    """One column of many frames by keys; where several have a value, the first frame's counts."""
    ranked = [f.select(*keys, F.col(column), F.lit(k).alias("__rank")) for k, f in enumerate(frames)]
    out = ranked[0]
    for f in ranked[1:]:
        out = out.unionByName(f)
    return out.groupBy(*keys).agg(F.min_by(column, F.when(F.col(column).isNotNull(), F.col("__rank"))).alias(column))


def later_wins(frames: list[DataFrame], key: str) -> DataFrame:
    """All rows by key; of rows with one key the last frame's count, ties within a frame are kept."""
    out = None
    for f in frames:
        out = f if out is None else out.join(f.select(key).distinct(), key, "left_anti").unionByName(f)
    return out


def value_profile(df: DataFrame, columns: list[str], file: str) -> DataFrame:
    """column_name, value, n_files and n of every value of the columns."""
    items = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns])
    return df.select(file, F.explode(items).alias("i")).groupBy("i.column_name", "i.value").agg(F.countDistinct(file).alias("n_files"), F.count("*").alias("n"))
