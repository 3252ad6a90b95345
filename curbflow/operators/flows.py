"""Flows: who travels between which boroughs and zones, and what airports have to do with it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbflow.functions import columns as C
from curbflow.functions import measures as M
from curbflow.functions.joins import dimension
from curbflow.functions.predicates import question_trips
from curbflow.params import TripWindow

NAMES = ("borough", "zone", "service_zone")


def _end(zones: DataFrame, side: str, pattern: str, special: Column | None) -> DataFrame:
    """The zone table as seen from one end of a trip.

    Whether a zone is an airport is a fact about the zone, so the pattern is tested once per
    zone here and not once per trip after the join.
    """
    return zones.select(
        F.col("location_id").alias(f"{side}_location_id"),
        *[F.col(name).alias(f"{side}_{name}") for name in NAMES],
        C.airport_zone(pattern=pattern, special=special).alias(f"{side}_at_airport"),
    )


def with_endpoints(
    trips: DataFrame,
    zones: DataFrame,
    window: TripWindow = TripWindow(),
    *,
    airport_pattern: str = C.AIRPORT_PATTERN,
    airport_special: Column | None = None,
    strategy: str = "auto",
) -> DataFrame:
    """Valid trips of the window with zone names of both ends and airport flags.

    A pickup also counts as an airport pickup when an airport fee was paid; a dropoff does
    not, as the fee is charged where the trip starts.
    """
    rows = question_trips(trips, "flows", window)
    return _named(rows, zones, F.col("airport_fee") > 0, airport_pattern, airport_special, strategy)


def _named(rows: DataFrame, zones: DataFrame, paid: Column, pattern: str, special: Column | None, strategy: str) -> DataFrame:
    """Rows with location ids, with the names of both ends and airport flags; ``paid``: an airport fee was paid."""
    for side in ("pu", "do"):
        rows = rows.join(dimension(_end(zones, side, pattern, special), strategy), f"{side}_location_id", "left")
    named = C.fill_unknown(rows, *[f"{side}_{name}" for side in ("pu", "do") for name in NAMES])
    false = F.lit(False)
    pickup = F.coalesce("pu_at_airport", false) | F.coalesce(paid, false)
    dropoff = F.coalesce("do_at_airport", false)
    return named.withColumns(
        {
            "pu_is_airport": pickup.cast("int"),
            "do_is_airport": dropoff.cast("int"),
            "airport_trip": (pickup | dropoff).cast("int"),
        }
    ).drop("pu_at_airport", "do_at_airport")


def flow_groups(
    trips: DataFrame,
    zones: DataFrame,
    window: TripWindow = TripWindow(),
    *,
    airport_pattern: str = C.AIRPORT_PATTERN,
    airport_special: Column | None = None,
    strategy: str = "auto",
) -> DataFrame:
    """The trips of ``with_endpoints``, summed by both location ids and whether an airport fee was paid.

    Trips are added up before the zones are joined: at most two rows per pair of zones meet the
    zone table, however many trips a zone has and whichever join is asked for.  Amounts are summed as whole
    units of the fourth digit (``measures.scaled``).
    """
    paid = F.coalesce(F.col("airport_fee") > 0, F.lit(False)).alias("fee_paid")
    values = {
        "total_amount": M.scaled("total_amount"),
        "trip_distance": M.scaled("trip_distance"),
        "airport_fee": M.scaled(F.coalesce("airport_fee", F.lit(0.0))),
        "duration_seconds": C.whole_seconds("duration_minutes"),
    }
    sums = [part for name, value in values.items() for part in (F.sum(value).alias(name), F.count(value).alias(f"{name}_n"))]
    groups = question_trips(trips, "flows", window).groupBy("pu_location_id", "do_location_id", paid).agg(M.trips(), *sums)
    return _named(groups, zones, F.col("fee_paid"), airport_pattern, airport_special, strategy)


def _mean(name: str) -> Column:
    """Mean amount over all trips of some groups, from their exact sums."""
    return F.try_divide(M.unscaled(F.sum(name)), F.sum(f"{name}_n"))


def _mean_minutes() -> Column:
    return F.try_divide(F.sum("duration_seconds"), F.lit(60.0) * F.sum("duration_seconds_n"))


def borough_flow_table(groups: DataFrame) -> DataFrame:
    """All borough-to-borough flows of ``flow_groups``, with their share of all trips."""
    return (
        groups.groupBy("pu_borough", "do_borough")
        .agg(
            F.sum("trips").alias("trips"),
            M.amount(M.unscaled(F.sum("total_amount")), "total_revenue"),
            M.amount(_mean("total_amount"), "avg_total_amount"),
            M.amount(_mean("trip_distance"), "avg_trip_distance"),
            M.amount(_mean_minutes(), "avg_duration_minutes"),
            M.share(M.total_ratio(F.col("airport_trip") * F.col("trips"), "trips"), "airport_trip_share"),
        )
        # Result columns, in order.
        .select(
            "pu_borough",
            "do_borough",
            "trips",
            M.share(M.part_of_whole("trips"), "trip_share"),
            "total_revenue",
            "avg_total_amount",
            "avg_trip_distance",
            "avg_duration_minutes",
            "airport_trip_share",
        )
    )


def borough_flows(groups: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` largest borough-to-borough flows."""
    return (
        borough_flow_table(groups)
        .orderBy(F.desc("trips"), F.desc("total_revenue"), "pu_borough", "do_borough")
        .limit(k)
    )


def airport_routes(groups: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` busiest zone-to-zone routes among airport trips."""
    return (
        groups.filter(F.col("airport_trip") == 1)
        .groupBy("pu_zone", "do_zone")
        .agg(
            F.sum("trips").alias("trips"),
            M.amount(_mean("airport_fee"), "avg_airport_fee"),
            M.amount(_mean("total_amount"), "avg_total_amount"),
            M.amount(_mean_minutes(), "avg_duration_minutes"),
            M.amount(_mean("trip_distance"), "avg_trip_distance"),
        )
        .orderBy(F.desc("trips"), F.desc("avg_total_amount"), "pu_zone", "do_zone")
        .limit(k)
    )


def airport_zones(
    zones: DataFrame,
    n: int = 10,
    *,
    airport_pattern: str = C.AIRPORT_PATTERN,
    airport_special: Column | None = None,
) -> DataFrame:
    """The first ``n`` zones taken for airports, to check the rule."""
    return (
        zones.filter(C.airport_zone(pattern=airport_pattern, special=airport_special))
        .select("location_id", "borough", "zone", "service_zone")
        .orderBy("borough", "zone", "location_id")
        .limit(n)
    )
