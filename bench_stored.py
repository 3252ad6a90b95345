"""Time the questions over a stored, partitioned trip table of the published size.

The trips of a test folder are repeated (times shifted by seconds, a third of all pickups moved
to one hot zone) and written once as typed Parquet, by day and by hour; then every question runs
on what was written.  Prints one JSON line.

BENCH_SF_DIR   folder of the test tables (default /root/testdata/sf0.1)
BENCH_COPIES   how often the trips are repeated (default 60: 36 million trips at sf0.1)
BENCH_CPUS     local threads (default 8)
BENCH_TABLES   folder for the tables it writes, which stay there (default: a new one; it runs on one machine)
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbflow.functions.columns import with_derived
from curbflow.operators import demand, flows, imbalance, od_change, payments, profile, revenue, speed
from curbflow.sources.readers import read_parquet
from curbflow.sources.starschema import trips_like, zones_like
from curbflow.sources.writers import write_partitioned

HOT_ZONE = 3


def repeated(trips: DataFrame, copies: int) -> DataFrame:
    copy = F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))
    base = trips.drop("pickup_date", "pickup_day", "pickup_hour", "trip_distance_km")
    shifted = base.withColumn("copy", copy).withColumns(
        {
            "pickup_ts": F.col("pickup_ts") + F.make_dt_interval(secs=F.col("copy").cast("decimal(8,6)")),
            "dropoff_ts": F.col("dropoff_ts") + F.make_dt_interval(secs=F.col("copy").cast("decimal(8,6)")),
            "pu_location_id": F.when(F.col("copy") % 3 == 0, HOT_ZONE).otherwise(F.col("pu_location_id")),
        }
    )
    return with_derived(shifted.drop("copy"))


def main() -> None:
    source = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    copies = int(os.environ.get("BENCH_COPIES", "60"))
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench_stored")
        .config("spark.sql.shuffle.partitions", str(4 * int(cpus)))
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    folder = os.environ.get("BENCH_TABLES") or tempfile.mkdtemp(prefix="run-")
    seconds = {}

    def timed(name, action):
        started = time.perf_counter()
        action()
        seconds[name] = round(time.perf_counter() - started, 3)

    def consumed(df: DataFrame):
        return lambda: df.write.format("noop").mode("overwrite").save()

    source_trips = trips_like(spark, source).repartition(4 * int(cpus))
    write_partitioned(repeated(source_trips, 1), f"{folder}/warm-up", "pickup_day")
    timed("write_by_day_unordered", lambda: write_partitioned(repeated(source_trips, copies), f"{folder}/unordered", "pickup_day"))
    timed(
        "write_by_day",
        lambda: write_partitioned(repeated(source_trips, copies), f"{folder}/day", "pickup_day", cluster="pickup_hour"),
    )
    by_day = read_parquet(spark, f"{folder}/day")
    timed("write_by_hour", lambda: write_partitioned(by_day, f"{folder}/hour", "pickup_hour", cluster="pickup_day"))
    by_hour = read_parquet(spark, f"{folder}/hour")
    zones = zones_like(spark, source)
    geometry = speed.with_trip_geometry(by_hour)
    groups = flows.flow_groups(by_day, zones)
    imbalances = imbalance.zone_imbalance(by_day, zones)
    change = od_change.od_period_change(by_day)
    questions = {
        "demand_top_hours": demand.demand_top_hours(by_day),
        "demand_by_band": demand.demand_by_band(by_day),
        "speed_by_hour": speed.speed_by_hour(geometry),
        "slowest_trips": speed.extreme_trips(geometry, "slowest"),
        "fastest_trips": speed.extreme_trips(geometry, "fastest"),
        "top_total_revenue": revenue.rank_zone_revenue(revenue.zone_revenue(by_day, zones)),
        "top_revenue_per_mile": revenue.rank_zone_revenue(revenue.zone_revenue(by_day, zones), "revenue_per_mile"),
        "payment_mix_by_hour": payments.payment_mix_by_hour(by_day),
        "payment_mix_by_vendor": payments.payment_mix_by_vendor(by_day),
        "card_vs_cash": payments.card_vs_cash(by_day),
        "borough_flows": flows.borough_flows(groups),
        "airport_routes": flows.airport_routes(groups),
        "imbalance_top_abs": imbalance.rank_imbalance(imbalances, "absolute"),
        "imbalance_by_hour": imbalance.imbalance_by_hour(imbalances),
        "od_top_increase": od_change.rank_od_change(change, "increase"),
        "null_profile": profile.null_profile(by_day, "trips"),
        "hour_distribution": profile.value_distribution(by_day, "pickup_hour", "trips"),
        "numeric_summary": profile.numeric_summary(by_day, "trips"),
        "log_histogram": profile.log_histogram(by_day, "trips"),
        "sign_counts": profile.sign_counts(by_day, "trips"),
        "joinability": profile.joinability(by_day, zones, "pu_location_id", "location_id"),
        "top_keys": profile.top_keys(by_day, zones),
        "anomaly_samples": profile.anomaly_samples(by_day, "trips"),
    }
    for name, df in questions.items():
        timed(name, consumed(df))
    unordered = read_parquet(spark, f"{folder}/unordered")
    timed("card_vs_cash_unordered", consumed(payments.card_vs_cash(unordered)))
    rows = by_day.count()
    print(json.dumps({"metric": "stored_questions", "rows": rows, "unit": "sec", "queries": seconds}))
    spark.stop()


if __name__ == "__main__":
    main()
