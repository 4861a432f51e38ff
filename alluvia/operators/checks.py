"""Checks of published tables, each as rows (check_name, passed, n_failed); nothing is raised but by the guards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alluvia.functions import geometry as G
from alluvia.functions.scalars import finite, lenient_date, tokens


def counted(df: DataFrame, failures: dict[str, Column]) -> DataFrame:
    """check_name, passed and n_failed from aggregates that count what fails, in one pass."""
    one = df.agg(*[F.coalesce(c.cast("long"), F.lit(0)).alias(k) for k, c in failures.items()])
    pairs = F.map_from_arrays(F.array(*map(F.lit, failures)), F.array(*failures))
    return one.select(F.explode(pairs).alias("check_name", "n_failed")).withColumn("passed", F.col("n_failed") == 0).select("check_name", "passed", "n_failed")


def _fails(condition: Column) -> Column:
    return F.count_if(~F.coalesce(condition, F.lit(False)))


def key_checks(df: DataFrame, key: list[str], dense: str | None = None) -> DataFrame:
    """Whether keys are unique, and whether a dense id is unique and runs from 1 to the number of rows."""
    found = {"key_unique": F.count("*") - F.countDistinct(F.struct(*key))}
    if dense:
        found |= {"dense_unique": F.count("*") - F.countDistinct(dense), "dense_from_one": (F.min(dense) != 1).cast("int"), "dense_to_n": (F.max(dense) != F.count("*")).cast("int")}
    return counted(df, found)


def geometry_checks(df: DataFrame, shape: str) -> DataFrame:
    """Null, empty and invalid geometries, and those beyond the degrees there are."""
    kind, b = G.st_type(F.col(shape)), G.st_bounds(F.col(shape))
    read = df.select(kind.alias("kind"), G.st_is_valid(F.col(shape)).alias("valid"), b.alias("b"))
    there = (F.col("kind") != "Empty") & F.col("kind").isNotNull()
    return counted(read, {
        "shape_not_null": F.count_if(F.col("kind").isNull()), "shape_not_empty": F.count_if(F.col("kind") == "Empty"), "shape_valid": F.count_if(there & ~F.col("valid")),
        "longitude_in_range": F.count_if((F.col("b.minx") < -180) | (F.col("b.maxx") > 180)), "latitude_in_range": F.count_if((F.col("b.miny") < -90) | (F.col("b.maxy") > 90)),
    })


def list_checks(df: DataFrame, items: str, n: str) -> DataFrame:
    """Joined lists against their counts: as long, not empty, sorted, without empty items."""
    found = tokens(F.col(items))
    return counted(df, {
        "list_length_is_count": _fails(F.size(found) == F.col(n)), "list_not_empty": _fails(F.size(found) >= 1), "list_sorted": _fails(found == F.array_sort(found)),
        "items_not_empty": _fails(F.size(F.split(items, ",")) == F.size(found)),
    })


def date_checks(df: DataFrame, items: str, first: str, today: str) -> DataFrame:
    """Dates in joined lists: those that aren't dates, those before the first that may be, and those after today (a parameter)."""
    day = lenient_date(F.col("item"))
    each = df.select(F.explode(tokens(F.col(items))).alias("item")).withColumn("day", day)
    return counted(each, {"dates_parse": F.count_if(F.col("day").isNull()), "not_before_first": F.count_if(F.col("day") < first), "not_after_today": F.count_if(F.col("day") > today)})


def area_checks(df: DataFrame, m2: str, km2: str, percentage: str | None = None, again: str | None = None, whole: str | None = None) -> DataFrame:
    """Areas above 0, both units within 0.01 or within a tenth where they are small, percentages up to 100, and, with an area computed again, areas within a factor of two and percentages within a point."""
    a, b = F.col(m2) / 1e6, F.col(km2)
    found = {
        "area_positive": _fails(F.col(m2) > 0), "units_agree": _fails(F.abs(a - b) < 0.01),
        "units_agree_when_small": _fails((F.abs(a - b) <= 0.005) | (F.abs(a - b) <= 0.1 * a)),
    }
    if percentage:
        found["percentage_up_to_100"] = F.count_if(F.col(percentage) > 100)
    if again:
        found["area_within_factor_two"] = _fails(F.try_divide(F.col(again), F.col(m2)).between(0.5, 2.0))
    if percentage and whole:
        found["percentage_within_a_point"] = _fails(F.abs(F.try_divide(F.col(m2) * 100.0, F.col(whole)) - F.col(percentage)) <= 1)
    return counted(df, found)


def domain_checks(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    """Values out of a closed set, and values of the set that don't occur."""
    found = {"value_known": F.count_if(~F.col(column).isin(*values))}
    return counted(df, found | {f"occurs_{v}": (F.count_if(F.col(column) == v) == 0).cast("int") for v in values})


def reference_checks(df: DataFrame, key: str, others: DataFrame) -> DataFrame:
    """Rows whose key the other table lacks, and the share of the other table's keys that occur in per cent."""
    known = others.select(F.col(key)).distinct()
    missing = df.join(known, key, "left_anti").agg(F.count("*").alias("n_failed"))
    share = known.join(df.select(key).distinct().withColumn("__there", F.lit(1)), key, "left").agg(F.try_divide(F.count("__there") * 100.0, F.count("*")).alias("coverage_percentage"))
    return missing.join(F.broadcast(share)).select(F.lit("key_known").alias("check_name"), (F.col("n_failed") == 0).alias("passed"), "n_failed", "coverage_percentage")  # one row each


def with_finite(df: DataFrame, columns: list[str]) -> DataFrame:
    """df as it is; an error if a column has rows but no finite value, as after a write of a template only."""
    found = df.agg(F.count("*").alias("__n"), *[F.count(finite(F.col(c).cast("double"))).alias(c) for c in columns]).first()
    empty = [c for c in columns if found["__n"] and not found[c]]
    if empty:
        raise ValueError(f"no finite value in {', '.join(empty)}")
    return df


def with_columns_present(df: DataFrame, columns: list[str]) -> DataFrame:
    """df as it is; an error if a column is missing."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"no column {', '.join(missing)}")
    return df


def paths_present(spark, paths: list[str]) -> DataFrame:
    """path and present, on whatever file system a path names."""

    def there(path: str) -> bool:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        return bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p))

    return spark.createDataFrame([(p, there(p)) for p in paths], "path string, present boolean")
