"""Tables that several plans read, written once in the folder that all executors share."""

from __future__ import annotations

import re
import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Where it is unset, a session in one process (as in tests) gets a temporary one; others must set it."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="alluvia-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
TEXT_ROWS = 1000  # rows of an Arrow batch of whole texts


_owner: ContextVar[str] = ContextVar("owner", default="")
_written: dict[str, list[str]] = {}


@contextmanager
def owned(owner: str):
    """Tables that are written inside belong to this owner, for release()."""
    before = _owner.set(owner)
    try:
        yield
    finally:
        _owner.reset(before)


def release(spark: SparkSession, owner: str) -> None:
    """Delete the tables that materialise() has written for this owner, but those it was told to keep; results that read them must have been written. Tables without an owner stay."""
    for path in _written.pop(owner, []):
        _delete(spark, path)


def _delete(spark: SparkSession, name: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialise(df: DataFrame, name: str, batch_rows: int = 0, keep: bool = False) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: the lineage ends, and lost executors lose nothing.

    batch_rows bounds the rows of an Arrow batch for this one write, for rows that may be long; the setting is put back.
    keep spares the table from release().
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/alluvia/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(BATCH_ROWS)
    try:
        if batch_rows:
            spark.conf.set(BATCH_ROWS, str(batch_rows))
        df.write.parquet(path)
        if not keep:
            _written.setdefault(_owner.get(), []).append(path)
    finally:
        spark.conf.set(BATCH_ROWS, before)
    table = spark.read.schema(df.schema).parquet(path)
    table.alluvia_path = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete tables of materialise() that no later plan reads, so that they don't take disk until the end."""
    for table in tables:
        _delete(table.sparkSession, table.alluvia_path)
        for paths in _written.values():
            if table.alluvia_path in paths:
                paths.remove(table.alluvia_path)


def with_row_numbers(df: DataFrame, name: str) -> DataFrame:
    """df with a column of unique numbers that are the same whenever it is read.

    Rows of a plain Parquet table are numbered by file and place in the file: nothing is copied. The files' names come to
    the driver, which lists them for every read anyhow. Anything else is numbered and written.
    """
    relation = df._jdf.queryExecution().analyzed()
    if relation.nodeName() != "LogicalRelation" or "_metadata" in df.columns or "parquet" not in relation.relation().toString().lower():
        return materialise(df.withColumn(name, F.monotonically_increasing_id()), "numbered")
    path = f"{name}_path"
    files = sorted(r[0] for r in df.select(F.col("_metadata.file_path")).distinct().collect())
    numbers = df.sparkSession.createDataFrame(list(enumerate(files)), f"{name}_file long, {path} string")
    placed = df.select("*", F.col("_metadata.file_path").alias(path), F.col("_metadata.row_index").alias(f"{name}_at"))
    number = F.shiftleft(F.col(f"{name}_file"), 40).bitwiseOR(F.col(f"{name}_at")).alias(name)
    return placed.join(numbers, path).select(*df.columns, number)


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, once for each application, whatever their Python path is."""
    import zipfile
    from pathlib import Path

    context = spark.sparkContext
    if getattr(context, "_alluvia_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    path = Path(tempfile.mkdtemp(prefix="alluvia-")) / "alluvia_package.zip"
    with zipfile.ZipFile(path, "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, str(file.relative_to(package.parent)))
    context.addPyFile(str(path))
    context._alluvia_shipped = True
