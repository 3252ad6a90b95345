"""Readers for raw files, typed tables, result tables and run metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from curbflow.contracts import RAW_ZONES, TripSpec


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, *, drop_short_lines: bool = False
) -> DataFrame:
    """A headed CSV file or folder under an explicit all-text schema.

    Missing fields of short lines are NULL.  With ``drop_short_lines`` lines of the wrong
    length are left out.
    """
    reader = spark.read.schema(schema).option("header", True)
    if drop_short_lines:
        # A pruned parse would not see that a line is short.
        reader = reader.option("mode", "DROPMALFORMED").option("columnPruning", False)
    return reader.csv(path)


def read_raw_trips(spark: SparkSession, path: str, spec: TripSpec, **options) -> DataFrame:
    return read_csv(spark, path, spec.raw_schema, **options)


def read_raw_zones(spark: SparkSession, path: str, **options) -> DataFrame:
    return read_csv(spark, path, RAW_ZONES, **options)


def read_parquet(spark: SparkSession, path: str, columns=None) -> DataFrame:
    """A typed table, optionally only some of its columns."""
    table = spark.read.parquet(path)
    return table.select(*columns) if columns else table


def read_result_table(spark: SparkSession, path: str) -> DataFrame:
    """A result table written by ``writers.write_csv_table``, with its types inferred.

    Result tables are small; big tables are read under a contract.
    """
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def read_run_metrics(spark: SparkSession, path: str) -> DataFrame:
    """All metrics documents under a folder, one row each."""
    return (
        spark.read.option("multiLine", True)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.json")
        .json(path)
    )
