"""Readers, and tables written once in the folder that all executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """A Parquet table of a folder, only the named columns if any are named."""
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    return df.select(*columns) if columns else df


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder of spark.checkpoint.dir. Where it is unset, a session in one process (as in tests) gets a temporary folder; others must set it."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="alluvia-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return f"{folder}/alluvia/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """df written in the shared folder and read back: its lineage ends."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def json_documents(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON metadata documents, keyed by file stem."""
    df = spark.read.schema(schema).json(path, multiLine=True)
    return df.withColumn("stem", F.regexp_replace(F.col("_metadata.file_name"), r"\.[^.]*$", ""))


def csv_union(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All CSV files with a header below a path as one table."""
    return spark.read.schema(schema).csv(path, header=True)


def months(spark: SparkSession, first: str, last: str) -> DataFrame:
    """The first days of all months from first to last."""
    return spark.range(1).select(F.explode(F.sequence(F.trunc(F.to_date(F.lit(first)), "month"), F.to_date(F.lit(last)), F.expr("interval 1 month"))).alias("month"))


def grid_axes(spark: SparkSession, step: float = 0.1, north: float = 90.0, south: float = -60.0, west: float = -180.0, east: float = 180.0) -> DataFrame:
    """row, col, latitude and longitude of all cells of a regular grid from the north-west, the eastern end left out; a lazy product of two sequences."""
    rows, cols = round((north - south) / step) + 1, round((east - west) / step)
    lat = spark.range(rows).select(F.col("id").alias("row"), F.round(north - F.col("id") * step, 6).alias("latitude"))
    return lat.select("*", F.explode(F.sequence(F.lit(0), F.lit(cols - 1))).alias("col")).withColumn("longitude", F.round(west + F.col("col") * step, 6))


def world_tiles(spark: SparkSession, step: int = 2) -> DataFrame:
    """Tiles of step degrees over the world, upper bounds clamped."""
    lon = F.explode(F.sequence(F.lit(-180), F.lit(179), F.lit(step))).alias("minx")
    lat = F.explode(F.sequence(F.lit(-90), F.lit(89), F.lit(step))).alias("miny")
    tiles = spark.range(1).select(lon).select("minx", lat)
    return tiles.withColumn("maxx", F.least(F.col("minx") + step, F.lit(180))).withColumn("maxy", F.least(F.col("miny") + step, F.lit(90)))


def ship_package() -> None:
    """Give the executors this package, once for each application, for functions that run there in Python."""
    import zipfile
    from pathlib import Path

    spark = SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()
    context = spark.sparkContext
    if getattr(context, "_alluvia_sent", False):
        return
    package = Path(__file__).resolve().parents[1]
    path = Path(tempfile.mkdtemp(prefix="alluvia-")) / "alluvia_sent.zip"
    with zipfile.ZipFile(path, "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, str(file.relative_to(package.parent)))
    context.addPyFile(str(path))
    context._alluvia_sent = True
