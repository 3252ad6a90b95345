import datetime as dt
from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from curbflow.contracts import RAW_ZONES, TRIPS_GEO, TRIPS_ZONED, ZONES
from curbflow.operators import ingest
from curbflow.operators.ingest import ingest_quality, ingest_trips, ingest_zones
from curbflow.plans.ingest import run_trip_ingest, run_zone_ingest
from curbflow.sources import readers, writers
from tests.conftest import one, rows_of

ZONED_LINES = [
    "1,2024-03-26T22:00:00.000,2024-03-26T22:10:00.000,1.0,2.5,1,N,132,7,1,10.0,1.0,0.5,2.0,0.0,1.0,14.5,2.5,1.75",
    "2,2024-03-26T23:59:30,2024-03-27T00:10:30,,0.0,,,99,,2,-3.0,,,,,,-3.0,,",
    "1,26/03/2024 22:00,2024-03-26T22:10:00.000,x,y,1,N,132,7,1,10.0,1.0,0.5,2.0,0.0,1.0,14.5,2.5,0.0",
    "1,2024-02-30T22:00:00.000,2024-03-26T22:10:00.000,1,1,1,N,132,7,1,10.0,1.0,0.5,2.0,0.0,1.0,14.5,2.5,0.0",
    "1,2002-12-31T16:46:07.000,2002-12-31T17:00:00.000,1,1,1,N,132,7,1,10.0,1.0,0.5,2.0,0.0,1.0,14.5,2.5,0.0",
    "1,2026-06-26T23:53:12.000,2026-06-27T00:00:00.000,1,1,1,N,132,7,1,10.0,1.0,0.5,2.0,0.0,1.0,14.5,2.5,0.0",
    "1,2024-03-26T22:00:00.000,2024-03-26T22:10:00.000",
]
GEO_LINES = [
    "2,2015-01-15 19:05:39,2015-01-15 19:23:42,1,1.59,-73.99,40.75,1,N,-73.97,40.75,1,12,1,0.5,3.25,0,0.3,17.05",
    "1,2015-01-10 20:33:38,2015-01-10 20:53:28,1,1e7,0,0,1,N,0,0,2,15,0.5,0.5,0,0,0.3,16.3",
    "1,2015-01-10T20:33:38.000,2015-01-10 20:53:28,1,3,0,0,1,N,0,0,2,15,0.5,0.5,0,0,0.3,16.3",
]


def write_lines(path, spec_fields, lines):
    header = ",".join(raw for raw, _, _ in spec_fields)
    Path(path).write_text("\n".join([header, *lines]) + "\n")
    return str(path)


@pytest.fixture
def zoned_csv(folder):
    return write_lines(f"{folder}/zoned.csv", TRIPS_ZONED.fields, ZONED_LINES)


def test_typed_zoned_trips(spark, zoned_csv):
    raw = readers.read_raw_trips(spark, zoned_csv, TRIPS_ZONED)
    assert raw.count() == len(ZONED_LINES)
    trips = ingest_trips(raw, TRIPS_ZONED)
    assert [(f.name, f.dataType) for f in trips.schema] == [
        (f.name, f.dataType) for f in TRIPS_ZONED.typed_schema
    ]
    (first,) = trips.filter("vendor_id = 1 AND fare_amount = 10").collect()
    (second,) = trips.filter("vendor_id = 2").collect()
    (short,) = trips.filter("fare_amount IS NULL").collect()
    assert (first.passenger_count, first.pu_location_id, first.duration_minutes) == (1, 132, 10.0)
    assert (first.pickup_date, first.pickup_day, first.pickup_hour) == (dt.date(2024, 3, 26), 26, 22)
    # No fraction of a second, empty fields, a trip over midnight.
    assert (second.pickup_hour, second.duration_minutes, second.passenger_count) == (23, 11.0, None)
    assert second.do_location_id is None and second.fare_amount == -3.0
    # A short line keeps what it has.
    assert short.pickup_day == 26 and short.trip_distance is None
    assert trips.count() == 3
    assert ingest_trips(raw, TRIPS_ZONED, year=None).count() == len(ZONED_LINES)
    assert ingest_trips(raw, TRIPS_ZONED, year=2026).count() == 1


def test_short_lines_can_be_dropped(spark, zoned_csv):
    raw = readers.read_raw_trips(spark, zoned_csv, TRIPS_ZONED, drop_short_lines=True)
    assert raw.columns == TRIPS_ZONED.raw_schema.fieldNames()
    assert raw.count() == len(ZONED_LINES) - 1
    assert raw.select("VendorID").count() == len(ZONED_LINES) - 1


def test_typed_geo_trips(spark, folder):
    path = write_lines(f"{folder}/geo.csv", TRIPS_GEO.fields, GEO_LINES)
    raw = readers.read_raw_trips(spark, path, TRIPS_GEO)
    trips = ingest_trips(raw, TRIPS_GEO).orderBy("pickup_ts")
    assert trips.schema == TRIPS_GEO.typed_schema
    assert rows_of(trips, "trip_distance", "pickup_longitude", "duration_minutes") == [
        (1e7, 0.0, pytest.approx(1190 / 60)),
        (1.59, -73.99, pytest.approx(1083 / 60)),
    ]
    assert one(ingest_quality(raw, TRIPS_GEO)).bad_or_null_pickup_ts_count == 1


def test_quality(spark, zoned_csv):
    row = one(ingest_quality(readers.read_raw_trips(spark, zoned_csv, TRIPS_ZONED), TRIPS_ZONED))
    assert tuple(row) == (
        7,
        2,
        2,
        dt.datetime(2002, 12, 31, 16, 46, 7),
        dt.datetime(2026, 6, 26, 23, 53, 12),
    )


def test_run_trip_ingest(spark, zoned_csv, folder):
    report = one(run_trip_ingest(spark, zoned_csv, f"{folder}/trips", TRIPS_ZONED))
    assert (report.raw_row_count, report.prepared_row_count, report.wrong_year_rejected_count) == (7, 3, 2)
    assert report.parquet_file_count == 1 and report.parquet_output_size_bytes > 0
    trips = readers.read_parquet(spark, f"{folder}/trips")
    assert trips.select(*TRIPS_ZONED.typed_schema.fieldNames()).schema == TRIPS_ZONED.typed_schema
    assert readers.read_parquet(spark, f"{folder}/trips", ["pickup_day"]).distinct().count() == 1
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        run_trip_ingest(spark, zoned_csv, f"{folder}/trips", TRIPS_ZONED)
    every_year = replace(TRIPS_ZONED, year=None)
    report = one(run_trip_ingest(spark, zoned_csv, f"{folder}/trips", every_year, mode="overwrite"))
    assert (report.prepared_row_count, report.wrong_year_rejected_count) == (7, 0)
    with pytest.raises(ValueError):
        writers.write_partitioned(trips, f"{folder}/x", mode="append")


def test_run_zone_ingest(spark, folder):
    Path(f"{folder}/zones.csv").write_text(
        'LocationID,Borough,Zone,service_zone\n1,EWR,Newark Airport,EWR\nx,Queens,"A, B",Boro Zone\n'
    )
    report = one(run_zone_ingest(spark, f"{folder}/zones.csv", f"{folder}/zones"))
    assert (report.dataset, report.raw_row_count, report.prepared_row_count) == ("zones", 2, 2)
    zones = readers.read_parquet(spark, f"{folder}/zones")
    assert zones.schema == ZONES
    assert sorted(rows_of(zones, "location_id", "zone"), key=repr) == [(1, "Newark Airport"), (None, "A, B")]
    assert RAW_ZONES.fieldNames() == ["LocationID", "Borough", "Zone", "service_zone"]
    assert ingest_zones(readers.read_raw_zones(spark, f"{folder}/zones.csv")).schema == ZONES


def test_a_folder_with_most_rows_is_split_over_tasks(spark, folder):
    """A partition value that holds most rows becomes several files, a small one stays one file."""
    rows = spark.range(400000).select(
        F.when(F.col("id") % 100 == 0, 2).otherwise(1).alias("day"), F.sha2(F.col("id").cast("string"), 256).alias("x")
    )
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4MB")
    try:
        writers.write_partitioned(rows.repartition(16), f"{folder}/t", "day")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    files = {d: len(list(Path(f"{folder}/t/day={d}").glob("*.parquet"))) for d in (1, 2)}
    assert files[1] > 3 and files[2] <= 2
    assert spark.read.parquet(f"{folder}/t").count() == 400000


def test_footprint(spark, folder):
    writers.write_partitioned(spark.range(10).withColumn("d", F.col("id") % 2), f"{folder}/t", "d")
    files = list(Path(f"{folder}/t").rglob("*.parquet"))
    assert rows_of(writers.dataset_footprint(spark, f"{folder}/t")) == [
        (f"{folder}/t", sum(f.stat().st_size for f in files), len(files))
    ]
    assert "content" not in writers.plan_text(writers.dataset_footprint(spark, f"{folder}/t"), "simple")


def test_result_table_round_trip(spark, folder):
    table = spark.createDataFrame([(1, "a,b", 0.5), (2, None, 1.0)], "k int, name string, v double")
    writers.write_csv_table(table, f"{folder}/r", single_file=True)
    assert len(list(Path(f"{folder}/r").glob("part-*.csv"))) == 1
    assert sorted(rows_of(readers.read_result_table(spark, f"{folder}/r"))) == [(1, "a,b", 0.5), (2, None, 1.0)]
    writers.write_csv_table(table.repartition(2), f"{folder}/r", "overwrite", single_file=False)
    assert readers.read_result_table(spark, f"{folder}/r").count() == 2
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        readers.read_result_table(spark, f"{folder}/nothing")


def test_texts_that_are_not_finite_are_null(spark, folder):
    raw = spark.createDataFrame([("NaN",), ("Infinity",), ("-Infinity",), ("1.5",), ("x",)], "fare_amount string")
    typed = raw.select(ingest._typed("fare_amount", "fare_amount", "double", ""))
    assert rows_of(typed) == [(None,), (None,), (None,), (1.5,), (None,)]
    assert rows_of(writers.dataset_footprint(spark, f"{folder}/nothing")) == [(f"{folder}/nothing", 0, 0)]


def test_odd_numbers_and_times(spark):
    times = ["2024-01-01T00:00:00", "2024-12-31T23:59:59.999\n", "2023-12-31T23:59:59.999", "2025-01-01T00:00:00", "", None, "x2024-01-01T00:00:00"]
    numbers = ["-0.0", "Infinity", "1", "1", "-inf", "NaN", "1e400"]
    raw = spark.createDataFrame([(t, n) for t, n in zip(times, numbers)], "tpep_pickup_datetime string, fare_amount string")
    raw = raw.withColumns({f: F.lit(None).cast("string") for f in TRIPS_ZONED.raw_schema.fieldNames() if f not in raw.columns})
    year = ingest_trips(raw, TRIPS_ZONED).orderBy("pickup_ts")
    assert rows_of(year, "pickup_ts", "fare_amount") == [
        (dt.datetime(2024, 1, 1), -0.0),
        (dt.datetime(2024, 12, 31, 23, 59, 59, 999000), None),
    ]
    every = ingest_trips(raw, TRIPS_ZONED, year=None)
    assert every.filter("pickup_ts IS NULL AND fare_amount IS NULL").count() == 3
