"""Imbalance: pickups against dropoffs per zone and hour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbflow.functions import columns as C
from curbflow.functions import measures as M
from curbflow.functions.joins import dimension
from curbflow.functions.predicates import question_trips
from curbflow.params import TripWindow

# Fixed value: zone-hours with fewer pickups plus dropoffs are too quiet to compare.
ACTIVITY_THRESHOLD = 30

KINDS = ("positive", "negative", "absolute")


def zone_activity(trips: DataFrame, window: TripWindow = TripWindow()) -> DataFrame:
    """Pickups and dropoffs per pickup hour and zone, from one scan and one shuffle.

    Each trip counts once at either end and the counts are combined before the shuffle.
    Unknown (NULL) zones of pickups and dropoffs are not known to be the same place and stay
    two rows, as they would in an outer join of the two counts.
    """
    pickup, dropoff = "pu_location_id", "do_location_id"
    ends = (
        question_trips(trips, "imbalance", window)
        .select(F.col("pickup_hour").alias("hour"), pickup, dropoff)
        .unpivot("hour", [pickup, dropoff], "end", "location_id")
    )
    picked = F.col("end") == pickup
    return (
        ends.groupBy("hour", "location_id", (F.col("location_id").isNull() & picked).alias("unknown_pickup"))
        .agg(F.count_if(picked).alias("pickups"), F.count_if(~picked).alias("dropoffs"))
        .drop("unknown_pickup")
    )


def zone_imbalance(
    trips: DataFrame,
    zones: DataFrame,
    window: TripWindow = TripWindow(),
    *,
    threshold: int = ACTIVITY_THRESHOLD,
    strategy: str = "auto",
) -> DataFrame:
    """Zone-hours with at least ``threshold`` pickups and dropoffs, and how one-sided they are."""
    ratio = F.try_divide("net_pickups", "activity")
    measured = (
        zone_activity(trips, window)
        .withColumns(
            {
                "activity": F.col("pickups") + F.col("dropoffs"),
                "net_pickups": F.col("pickups") - F.col("dropoffs"),
            }
        )
        .filter(F.col("activity") >= threshold)
        .withColumn("imbalance_ratio", F.round(ratio, M.SHARE_DIGITS))
    )
    names = zones.select("location_id", "borough", "zone", "service_zone")
    named = measured.join(dimension(names, strategy), "location_id", "left")
    # Result columns, in order.
    return C.fill_unknown(named, "borough", "zone", "service_zone").select(
        "hour",
        "location_id",
        "borough",
        "zone",
        "service_zone",
        "pickups",
        "dropoffs",
        "activity",
        "net_pickups",
        "imbalance_ratio",
        F.abs("imbalance_ratio").alias("abs_imbalance_ratio"),
    )


def rank_imbalance(imbalance: DataFrame, kind: str, k: int = 20) -> DataFrame:
    """The ``k`` zone-hours with the largest surplus of pickups (``positive``) or of dropoffs
    (``negative``), or the most one-sided ones (``absolute``)."""
    net, one_sided = F.col("net_pickups"), F.col("abs_imbalance_ratio")
    keep, order = {
        "positive": (net > 0, net.desc()),
        "negative": (net < 0, net.asc()),
        "absolute": (one_sided.isNotNull(), one_sided.desc()),
    }[kind]
    return imbalance.filter(keep).orderBy(order, "hour", "location_id", "zone", "pickups").limit(k)


def imbalance_by_hour(imbalance: DataFrame) -> DataFrame:
    """Total and mean imbalance over the zones of each hour, most one-sided hour first."""
    return (
        imbalance.groupBy("hour")
        .agg(
            F.sum(F.abs("net_pickups")).alias("total_abs_net_pickups"),
            M.share(F.avg(F.try_divide(F.abs("net_pickups"), "activity")), "mean_abs_imbalance_ratio"),
        )
        .orderBy(F.desc("mean_abs_imbalance_ratio"), "hour")
    )
