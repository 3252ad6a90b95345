"""Demand: how many trips, by whom and for how much, per hour and per band of the day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbflow.functions import columns as C
from curbflow.functions import measures as M
from curbflow.functions.predicates import question_trips
from curbflow.params import TripWindow

SHARE = "trips_share_in_personal_window"


def _demand(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(
        M.trips(),
        F.countDistinct("pu_location_id").alias("unique_pickup_zones"),
        M.amount(F.avg("passenger_count"), "avg_passenger_count"),
        M.amount(M.mean_minutes(), "avg_duration_minutes"),
        M.amount(M.exact_mean("trip_distance"), "avg_trip_distance"),
        M.amount(M.exact_mean("total_amount"), "avg_total_amount"),
        M.amount(M.exact_sum("total_amount"), "total_revenue"),
    )


def demand_by_hour(trips: DataFrame, window: TripWindow = TripWindow()) -> DataFrame:
    """Every date and hour of the window with its demand and its share of all window trips.

    Weekday and band depend on date and hour only, so they are added to the groups
    rather than computed for every trip.
    """
    valid = question_trips(trips, "demand", window)
    # Result columns, in order.
    return _demand(valid, "pickup_date", "pickup_hour").select(
        "pickup_date",
        "pickup_hour",
        C.weekday("pickup_date").alias("weekday"),
        C.is_weekend("pickup_date").alias("is_weekend"),
        C.time_band().alias("time_band"),
        "trips",
        "unique_pickup_zones",
        "avg_passenger_count",
        "avg_duration_minutes",
        "avg_trip_distance",
        "avg_total_amount",
        "total_revenue",
        M.share(M.part_of_whole("trips"), SHARE),
    )


def demand_top_hours(trips: DataFrame, window: TripWindow = TripWindow()) -> DataFrame:
    """The ``top_k`` busiest date-hours of the window."""
    return (
        demand_by_hour(trips, window)
        .orderBy(F.desc("trips"), F.desc("total_revenue"), "pickup_date", "pickup_hour")
        .limit(window.top_k)
    )


def demand_by_band(trips: DataFrame, window: TripWindow = TripWindow()) -> DataFrame:
    """Demand per time band, busiest band first."""
    valid = question_trips(trips, "demand", window).withColumn("time_band", C.time_band())
    return (
        _demand(valid, "time_band")
        .withColumn(SHARE, M.share(M.part_of_whole("trips"), SHARE))
        .orderBy(F.desc("trips"), "time_band")
    )


def demand_events_hourly(
    events: DataFrame,
    ts: str = "ts",
    actor: str = "user_id",
    amount: str = "value",
    digits: int | None = 2,
) -> DataFrame:
    """The same summary for any stream of events: one row per date and hour.

    ``digits`` sums the amount as a decimal of that scale; ``None`` keeps it as it is.
    """
    slots = events.select(
        F.to_date(ts).alias("event_date"),
        F.hour(ts).alias("event_hour"),
        F.col(actor).alias("actor"),
        M.as_exact(amount, digits).alias("amount"),
    ).filter(F.col("event_date").isNotNull())
    grouped = slots.groupBy("event_date", "event_hour").agg(
        F.count(F.lit(1)).alias("events"),
        F.countDistinct("actor").alias("unique_actors"),
        F.sum("amount").alias("total"),
        F.count("amount").alias("amounts"),
    )
    return grouped.select(
        "event_date",
        "event_hour",
        C.weekday("event_date").alias("weekday"),
        C.is_weekend("event_date").alias("is_weekend"),
        C.time_band("event_hour").alias("time_band"),
        "events",
        "unique_actors",
        M.amount(F.try_divide("total", "amounts"), "avg_amount").cast("double").alias("avg_amount"),
        M.amount(F.col("total"), "total_amount").cast("double").alias("total_amount"),
        M.share(M.part_of_whole("events"), "event_share"),
    ).orderBy("event_date", "event_hour")
