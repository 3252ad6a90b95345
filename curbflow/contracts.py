"""Table contracts: one field list per dataset drives reading, typing and checking."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Raw CSV header, typed column name and type, in file order.
GEO_FIELDS = (
    ("VendorID", "vendor_id", "int"),
    ("tpep_pickup_datetime", "pickup_ts", "timestamp"),
    ("tpep_dropoff_datetime", "dropoff_ts", "timestamp"),
    ("passenger_count", "passenger_count", "int"),
    ("trip_distance", "trip_distance", "double"),
    ("pickup_longitude", "pickup_longitude", "double"),
    ("pickup_latitude", "pickup_latitude", "double"),
    ("RateCodeID", "rate_code_id", "int"),
    ("store_and_fwd_flag", "store_and_fwd_flag", "string"),
    ("dropoff_longitude", "dropoff_longitude", "double"),
    ("dropoff_latitude", "dropoff_latitude", "double"),
    ("payment_type", "payment_type", "int"),
    ("fare_amount", "fare_amount", "double"),
    ("extra", "extra", "double"),
    ("mta_tax", "mta_tax", "double"),
    ("tip_amount", "tip_amount", "double"),
    ("tolls_amount", "tolls_amount", "double"),
    ("improvement_surcharge", "improvement_surcharge", "double"),
    ("total_amount", "total_amount", "double"),
)

ZONED_FIELDS = (
    ("VendorID", "vendor_id", "int"),
    ("tpep_pickup_datetime", "pickup_ts", "timestamp"),
    ("tpep_dropoff_datetime", "dropoff_ts", "timestamp"),
    ("passenger_count", "passenger_count", "int"),
    ("trip_distance", "trip_distance", "double"),
    ("RatecodeID", "rate_code_id", "int"),
    ("store_and_fwd_flag", "store_and_fwd_flag", "string"),
    ("PULocationID", "pu_location_id", "int"),
    ("DOLocationID", "do_location_id", "int"),
    ("payment_type", "payment_type", "int"),
    ("fare_amount", "fare_amount", "double"),
    ("extra", "extra", "double"),
    ("mta_tax", "mta_tax", "double"),
    ("tip_amount", "tip_amount", "double"),
    ("tolls_amount", "tolls_amount", "double"),
    ("improvement_surcharge", "improvement_surcharge", "double"),
    ("total_amount", "total_amount", "double"),
    ("congestion_surcharge", "congestion_surcharge", "double"),
    ("Airport_fee", "airport_fee", "double"),
)

ZONE_FIELDS = (
    ("LocationID", "location_id", "int"),
    ("Borough", "borough", "string"),
    ("Zone", "zone", "string"),
    ("service_zone", "service_zone", "string"),
)

# Columns added to every typed trip table.
DERIVED_FIELDS = (
    ("pickup_date", "date"),
    ("pickup_day", "int"),
    ("pickup_hour", "int"),
    ("duration_minutes", "double"),
    ("trip_distance_km", "double"),
)

# Timestamp text of the two file generations, yyyy-MM-dd HH:mm:ss and
# yyyy-MM-dd'T'HH:mm:ss.SSS.  The second is read with or without its fraction of a second.
GEO_TIME = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"
ZONED_TIME = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{3})?$"

_TYPES = {
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}


def raw_schema(fields) -> T.StructType:
    """All-string schema of a raw file, so that no row is lost to a type error."""
    return T.StructType([T.StructField(raw, T.StringType()) for raw, _, _ in fields])


def typed_schema(fields, derived=()) -> T.StructType:
    """Schema of the typed table made from ``fields``."""
    named = [(name, kind) for _, name, kind in fields] + list(derived)
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in named])


@dataclass(frozen=True)
class TripSpec:
    """How one generation of trip files becomes a typed, partitioned table."""

    name: str
    fields: tuple
    time_pattern: str
    year: int | None
    partition_by: str
    # Order of the rows inside each file.
    cluster_by: str | None = None

    @property
    def raw_schema(self) -> T.StructType:
        return raw_schema(self.fields)

    @property
    def typed_schema(self) -> T.StructType:
        return typed_schema(self.fields, DERIVED_FIELDS)


TRIPS_GEO = TripSpec("trips_geo", GEO_FIELDS, GEO_TIME, 2015, "pickup_hour", "pickup_day")
TRIPS_ZONED = TripSpec("trips_zoned", ZONED_FIELDS, ZONED_TIME, 2024, "pickup_day", "pickup_hour")

RAW_ZONES = raw_schema(ZONE_FIELDS)
ZONES = typed_schema(ZONE_FIELDS)
