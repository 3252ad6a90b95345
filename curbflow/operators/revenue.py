"""Revenue: income per pickup zone and distance bucket, and its rankings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbflow.functions import columns as C
from curbflow.functions import measures as M
from curbflow.functions.joins import dimension
from curbflow.functions.predicates import question_trips
from curbflow.params import TripWindow

KEYS = ["pickup_borough", "pickup_zone", "distance_bucket"]
METRICS = ("total_revenue", "revenue_per_mile", "revenue_per_minute")

# A ranking of rates wants 1 % of all trips in a group, but at least 10 and at most 50.
SUPPORT_SHARE, SUPPORT_FLOOR, SUPPORT_CEILING = 0.01, 10, 50


def zone_revenue(
    trips: DataFrame, zones: DataFrame, window: TripWindow = TripWindow(), *, strategy="auto"
) -> DataFrame:
    """Revenue, rates and surcharge share per pickup borough, zone and distance bucket.

    Trips are summed per location id before the zone names are joined: the join sees one
    row per id and bucket, however many trips a hot zone has.  Ids that share a name are
    added up after it, and ids without a zone become ``Unknown``.
    """
    valid = question_trips(trips, "revenue", window)
    per_id = valid.groupBy("pu_location_id", C.distance_bucket().alias("distance_bucket")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(M.scaled("total_amount")).alias("revenue"),
        F.sum(M.scaled("trip_distance")).alias("miles"),
        F.sum(C.whole_seconds()).alias("seconds"),
        F.sum(M.scaled("fare_amount")).alias("fares"),
        F.sum(M.scaled("tip_amount")).alias("tips"),
        F.count(M.scaled("tip_amount")).alias("tipped"),
        F.sum(M.scaled(C.surcharge_total(valid))).alias("surcharges"),
    )
    names = zones.select(
        F.col("location_id").alias("pu_location_id"),
        F.col("borough").alias("pickup_borough"),
        F.col("zone").alias("pickup_zone"),
    )
    named = C.fill_unknown(
        per_id.join(dimension(names, strategy), "pu_location_id", "left"), "pickup_borough", "pickup_zone"
    )
    n, revenue = F.sum("n"), M.unscaled(F.sum("revenue"))
    return named.groupBy(*KEYS).agg(
        n.alias("trips"),
        M.amount(revenue, "total_revenue"),
        M.amount(revenue / n, "avg_revenue_per_trip"),
        M.amount(M.total_ratio("revenue", "miles"), "revenue_per_mile"),
        M.amount(F.try_divide(revenue * 60, F.sum("seconds")), "revenue_per_minute"),
        M.amount(M.unscaled(F.sum("fares")) / n, "avg_fare_amount"),
        M.amount(F.try_divide(M.unscaled(F.sum("tips")), F.sum("tipped")), "avg_tip_amount"),
        M.share(M.total_ratio("surcharges", "revenue"), "surcharge_share"),
    )


def _threshold(all_trips: str):
    return F.greatest(
        F.lit(SUPPORT_FLOOR),
        F.least(F.lit(SUPPORT_CEILING), F.floor(F.col(all_trips) * SUPPORT_SHARE)),
    )


def supported(grouped: DataFrame) -> DataFrame:
    """Groups with enough trips for their rates to mean something."""
    total = M.whole("trips")
    return (
        grouped.withColumn("all_trips", total)
        .filter(F.col("trips") >= _threshold("all_trips"))
        .drop("all_trips")
    )


def support_threshold(grouped: DataFrame) -> DataFrame:
    """One number: the trips that a group needs to be ``supported``."""
    total = grouped.agg(F.coalesce(F.sum("trips"), F.lit(0)).alias("all_trips"))
    return total.select(_threshold("all_trips").alias("support_threshold"))


def rank_zone_revenue(
    grouped: DataFrame, metric: str = "total_revenue", k: int = 20, support: bool | None = None
) -> DataFrame:
    """The ``k`` best groups of ``zone_revenue`` by a metric.

    Rates are ranked among supported groups, total revenue among all, unless ``support`` says otherwise.
    """
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {METRICS}")
    if support is None:
        support = metric != "total_revenue"
    ranked = supported(grouped) if support else grouped
    return ranked.orderBy(F.desc(metric), F.desc("trips"), *KEYS).limit(k)
