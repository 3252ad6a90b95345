"""The ingest run: raw file to partitioned table, and the report row about it."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbflow.contracts import TripSpec
from curbflow.operators.ingest import ingest_quality, ingest_trips, ingest_zones
from curbflow.sources.readers import read_parquet, read_raw_trips, read_raw_zones
from curbflow.sources.writers import dataset_footprint, write_partitioned


def _described(spark: SparkSession, name: str, source: str, path: str) -> list:
    rows = read_parquet(spark, path).agg(F.count(F.lit(1))).scalar()
    size = dataset_footprint(spark, path)
    return [
        F.lit(name).alias("dataset"),
        F.lit(source).alias("input_path"),
        F.lit(path).alias("output_path"),
        rows.alias("prepared_row_count"),
        size.select("bytes").scalar().alias("parquet_output_size_bytes"),
        size.select("files").scalar().alias("parquet_file_count"),
    ]


def run_trip_ingest(
    spark: SparkSession, source: str, path: str, spec: TripSpec, mode: str = "errorifexists"
) -> DataFrame:
    """Write the typed trips of a raw file, partitioned and clustered as the spec says.

    Returns one row on what was read and written.  The raw text is read twice, once to write
    and once (a single column) for its quality counts; row count and size come from what was
    written.
    """
    raw = read_raw_trips(spark, source, spec)
    started = time.monotonic()
    write_partitioned(ingest_trips(raw, spec), path, spec.partition_by, mode, cluster=spec.cluster_by or ())
    written = [
        F.lit(round(time.monotonic() - started, 3)).alias("conversion_time_seconds"),
        F.array(F.lit(spec.partition_by)).alias("partition_columns"),
        F.lit(spec.time_pattern).alias("timestamp_format"),
    ]
    return ingest_quality(raw, spec).select(*_described(spark, spec.name, source, path), *written, "*")


def run_zone_ingest(
    spark: SparkSession, source: str, path: str, mode: str = "errorifexists"
) -> DataFrame:
    """Write the typed zone lookup; returns one row on it."""
    raw = read_raw_zones(spark, source)
    write_partitioned(ingest_zones(raw), path, mode=mode)
    counted = raw.agg(F.count(F.lit(1)).alias("raw_row_count"))
    return counted.select(*_described(spark, "zones", source, path), "*")
