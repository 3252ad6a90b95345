"""Adapters: trips, zones and raw trip text made from order, line item and nation tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curbflow.contracts import GEO_FIELDS, ZONED_FIELDS
from curbflow.functions.columns import with_derived


# The columns of the tables used here.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_nationkey int",
    "supplier": "s_suppkey bigint, s_nationkey int",
    "orders": "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderdate timestamp_ntz",
    "lineitem": """l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,
        l_quantity double, l_extendedprice double""",
    "events": """event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double,
        props string""",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One table under its known schema, so that no job is run to find it out."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def trips_like(spark: SparkSession, folder: str) -> DataFrame:
    """One trip per line item: picked up where the customer lives, dropped where the supplier is.

    Orders and customers are joined first, so line items are shuffled once, by order.
    """
    buyer = table(spark, folder, "orders").join(
        table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    supplier = table(spark, folder, "supplier")
    line = (
        table(spark, folder, "lineitem")
        .join(buyer, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    )
    pickup = "o_orderdate + make_dt_interval(0, 0, cast((l_orderkey * 7 + l_partkey) % 1440 as int))"
    minutes = "((l_partkey * 13 + l_linenumber * 11) % 95 - 2)"
    trips = line.selectExpr(
        "cast(l_suppkey % 2 + 1 as int) AS vendor_id",
        f"{pickup} AS pickup_ts",
        f"{pickup} + make_dt_interval(0, 0, cast({minutes} as int)) AS dropoff_ts",
        f"cast({minutes} as double) AS duration_minutes",
        "if(l_orderkey % 10 = 0, NULL, l_linenumber) AS passenger_count",
        "(l_quantity - 1) / 4 AS trip_distance",
        "if(l_orderkey % 97 = 0, 99, c_nationkey) AS pu_location_id",
        "s_nationkey AS do_location_id",
        "cast(l_orderkey % 4 + 1 as int) AS payment_type",
        "cast(floor(l_extendedprice / 1000) - 2 as double) AS fare_amount",
        "0.5D AS extra",
        "0.5D AS mta_tax",
        "if(l_orderkey % 4 = 0, cast(floor(l_quantity / 4) as double), 0D) AS tip_amount",
        "0D AS tolls_amount",
        "if(l_linenumber = 1, NULL, 1D) AS improvement_surcharge",
        "fare_amount + tip_amount + 1 AS total_amount",
        "if(l_linenumber = 2, NULL, 2D) AS congestion_surcharge",
        "if(c_nationkey IN (3, 11), 1.75D, 0D) AS airport_fee",
        "-74.30D + (o_custkey * 7 % 720) / 1000D AS pickup_longitude",
        "40.45D + (l_partkey * 3 % 520) / 1000D AS pickup_latitude",
        "-74.30D + (l_partkey * 11 % 720) / 1000D AS dropoff_longitude",
        "40.45D + (o_custkey * 5 % 520) / 1000D AS dropoff_latitude",
    )
    return with_derived(trips)


def zones_like(spark: SparkSession, folder: str) -> DataFrame:
    """One zone per nation, its region as borough."""
    region = table(spark, folder, "region")
    nation = table(spark, folder, "nation")
    key = F.col("n_nationkey")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        key.alias("location_id"),
        F.col("r_name").alias("borough"),
        F.col("n_name").alias("zone"),
        F.when(key % 3 == 0, "Boro Zone").otherwise("Yellow Zone").alias("service_zone"),
    )


def raw_trips_like(spark: SparkSession, folder: str, *, geo: bool = False) -> DataFrame:
    """The trips as all-text rows of a raw file, zone style or coordinate style, flaws included.

    Where the pickup hour is 5, times are written without a fraction (zone style only); where
    it is 7, the pickup time is unreadable; whole numbers are written as ``1.0``.
    """
    trips = trips_like(spark, folder).withColumns(
        {"rate_code_id": F.lit(1), "store_and_fwd_flag": F.lit("N")}
    )
    separator = " " if geo else "'T'"
    plain = f"yyyy-MM-dd{separator}HH:mm:ss"

    def time_text(name: str) -> Column:
        text = F.date_format(name, plain)
        if geo:
            return text
        return F.concat(text, F.when(F.col("pickup_hour") == 5, "").otherwise(".000"))

    def as_text(name: str, kind: str) -> Column:
        if name == "pickup_ts":
            return F.when(F.col("pickup_hour") == 7, "unreadable").otherwise(time_text(name))
        if kind == "timestamp":
            return time_text(name)
        if kind == "int":
            return F.col(name).cast("double").cast("string")
        return F.col(name).cast("string")

    fields = GEO_FIELDS if geo else ZONED_FIELDS
    return trips.select(*[as_text(name, kind).alias(raw) for raw, name, kind in fields])
