"""Tables written so that a failed or repeated run leaves no half result. Paths may be on any file system that Spark writes to."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alluvia.functions.scalars import finite
from alluvia.operators.relational import dense_ids


def _path(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def exists(spark: SparkSession, name: str) -> bool:
    files, path = _path(spark, name)
    return files.exists(path)


def replace_table(df: DataFrame, path: str, *partitions: str) -> None:
    """Overwrite a table; with partition columns only the partitions that df holds. df must not read the same path."""
    writer = df.write.mode("overwrite")
    if partitions:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(*partitions)
    writer.parquet(path)


def current(spark: SparkSession, root: str) -> DataFrame:
    """The version of a table that swap_table() last made current."""
    name = spark.read.text(f"{root}/_versions").agg(F.max_by(F.split_part("value", F.lit(" "), F.lit(2)), F.split_part("value", F.lit(" "), F.lit(1)).cast("long"))).first()[0]
    return spark.read.parquet(f"{root}/{name}")


def swap_table(df: DataFrame, root: str) -> DataFrame:
    """A new version of a table, which df may read itself: it is written beside the others and then named the current one."""
    spark = df.sparkSession
    name = f"version-{uuid.uuid4().hex}"
    df.write.parquet(f"{root}/{name}")
    n = spark.read.text(f"{root}/_versions").count() if exists(spark, f"{root}/_versions") else 0
    spark.createDataFrame([(f"{n + 1} {name}",)], "value string").coalesce(1).write.mode("append").text(f"{root}/_versions")
    return current(spark, root)


def write_events(df: DataFrame, path: str) -> None:
    """One folder for each archive and event that has rows."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("source_data", "event_name").parquet(path)


def write_layer(df: DataFrame, path: str, layer: str) -> None:
    """Add a layer to a table of layers; a layer of this name is replaced."""
    replace_table(df.withColumn("layer", F.lit(layer)), path, "layer")


def write_csv(df: DataFrame, path: str, *order: str) -> None:
    """One file with a header, for small tables: all rows go through one task."""
    df.coalesce(1).sortWithinPartitions(*order).write.mode("overwrite").csv(path, header=True)


def write_finite(df: DataFrame, path: str, columns: list[str]) -> None:
    """Write a table, read it back and fail if a column has no finite value."""
    df.write.mode("overwrite").parquet(path)
    found = df.sparkSession.read.parquet(path).agg(*[F.count(finite(F.col(c).cast("double"))).alias(c) for c in columns]).first()
    empty = [c for c in columns if not found[c]]
    if empty:
        raise ValueError(f"no finite value in {', '.join(empty)} of {path}")


def append_days(df: DataFrame, path: str, day: str = "date") -> int:
    """Append the rows after the table's last day, partitioned by month; how many days were added. Days before the table's first are refused."""
    spark = df.sparkSession
    monthly = df.withColumn("month", F.date_format(day, "yyyy-MM"))
    if exists(spark, path):
        ends = spark.read.parquet(path).agg(F.min(day), F.max(day)).first()
        first = df.agg(F.min(day)).first()[0]
        if first is not None and ends[0] is not None and first < ends[0]:
            raise ValueError(f"{first} is before the table's first day {ends[0]}: delete the table to start anew")
        if ends[1] is not None:
            monthly = monthly.where(F.col(day) > ends[1])
    days = monthly.select(day).distinct().count()
    if days:
        monthly.write.mode("append").partitionBy("month").parquet(path)
    return days


def load_months(df: DataFrame, path: str, manifest: str, day: str = "date") -> list[str]:
    """Load the months that the manifest doesn't list as done, each replacing its partition, and list them; the months loaded."""
    spark = df.sparkSession
    monthly = df.withColumn("month", F.date_format(day, "yyyy-MM"))
    if exists(spark, manifest):
        monthly = monthly.join(spark.read.parquet(manifest).select("month").distinct(), "month", "left_anti")
    months = sorted(r[0] for r in monthly.select("month").distinct().collect())  # a bounded list: months of a calendar
    if months:
        replace_table(monthly, path, "month")
        spark.createDataFrame([(m,) for m in months], "month string").coalesce(1).write.mode("append").parquet(manifest)
    return months


def export_chunks(df: DataFrame, key: str, path: str, size: int = 5000) -> None:
    """Folders of so many rows each, in key order."""
    numbered = dense_ids(df, key, "__row").withColumn("chunk", F.floor((F.col("__row") - 1) / size)).drop("__row")
    numbered.write.mode("overwrite").partitionBy("chunk").parquet(path)
