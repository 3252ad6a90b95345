"""Sinks: partitioned Parquet, small result tables, JSON metrics, plan text, and what they hold."""

from __future__ import annotations

import io
from contextlib import redirect_stdout

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MODES = ("overwrite", "errorifexists")


def _checked(mode: str) -> str:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    return mode


# Bytes of a row group of clustered files: a file of a day holds several, so that a filter on the hour can skip most.
ROW_GROUP_BYTES = 16 << 20


def write_partitioned(
    df: DataFrame, path: str, by=(), mode: str = "errorifexists", *, cluster=(), row_group_bytes: int = ROW_GROUP_BYTES
) -> None:
    """Parquet, in one folder per value of the ``by`` columns, rows in order of the ``cluster`` columns inside each file.

    The rebalance hint brings the rows of a folder together, so that not every task writes a
    small file into every folder, and lets adaptive execution split a folder that is larger
    than the advisory partition size over several tasks: no folder is the work of one task.

    The order costs no shuffle: a task sorts its own rows, by folder (as writing into folders needs anyway) and then by
    ``cluster``.  Each row group then holds a narrow range, and filters on those columns that reach the scan skip
    the row groups and pages that have none of their values.
    """
    by = [by] if isinstance(by, str) else list(by)
    cluster = [cluster] if isinstance(cluster, str) else list(cluster)
    rows = df.hint("rebalance", *by) if by else df
    if cluster:
        rows = rows.sortWithinPartitions(*by, *cluster)
    writer = rows.write.mode(_checked(mode))
    if cluster:
        writer = writer.option("parquet.block.size", row_group_bytes)
    (writer.partitionBy(*by) if by else writer).parquet(path)


def write_csv_table(
    df: DataFrame, path: str, mode: str = "errorifexists", *, single_file: bool = False
) -> None:
    """A headed CSV result table.  ``single_file`` is for limited or grouped results only."""
    out = df.coalesce(1) if single_file else df
    out.write.mode(_checked(mode)).option("header", True).csv(path)


def write_json_document(row: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A one-row table as one JSON document; NULL fields are kept."""
    row.coalesce(1).write.mode(_checked(mode)).option("ignoreNullFields", False).json(path)


def write_text(spark: SparkSession, text: str, path: str, mode: str = "overwrite") -> None:
    """A short text, such as a query plan, as one file."""
    line = spark.range(1, numPartitions=1).select(F.lit(text).alias("value"))
    line.write.mode(_checked(mode)).text(path)


def plan_text(df: DataFrame, mode: str = "extended") -> str:
    """The query plan as Spark explains it."""
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


def dataset_footprint(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """One row: path, total bytes and number of data files, 0 for a path that does not exist.

    File contents are not read.
    """
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        zero = F.lit(0).cast("long")
        return spark.range(1).select(F.lit(path).alias("path"), zero.alias("bytes"), zero.alias("files"))
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(path)
    )
    return files.agg(
        F.lit(path).alias("path"),
        F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"),
        F.count(F.lit(1)).alias("files"),
    )
