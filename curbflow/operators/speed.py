"""Speed: trip geometry, speed and congestion per hour, extreme trips."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbflow.functions import columns as C
from curbflow.functions import measures as M
from curbflow.functions.predicates import question_trips
from curbflow.functions.quantiles import point_quantiles, rank_points, value_at, with_cumulative
from curbflow.params import TripWindow

# Columns of an extreme trip, in order.
EXTREME_COLUMNS = [
    "vendor_id",
    "pickup_ts",
    "dropoff_ts",
    "pickup_hour",
    "trip_distance",
    "trip_distance_km",
    "duration_minutes",
    "duration_per_km",
    "speed_kmh",
    "haversine_km",
    "distance_gap_km",
    "detour_ratio",
    "pickup_longitude",
    "pickup_latitude",
    "dropoff_longitude",
    "dropoff_latitude",
]
# Derived values that are summed: by name of the sum.
DERIVED = {
    "speed": "speed_kmh",
    "km": "trip_distance_km",
    "straight": "haversine_km",
    "gap": "distance_gap_km",
    "detour": "detour_ratio",
}
EXTREMES = {"slowest": "duration_per_km", "fastest": "speed_kmh"}


def with_trip_geometry(
    trips: DataFrame,
    window: TripWindow = TripWindow(),
    *,
    year: int | None = None,
    min_straight_km: float = C.MIN_STRAIGHT_KM,
    distance=C.haversine_km,
) -> DataFrame:
    """Valid trips of the window's hours (all days) with straight-line and driven geometry.

    ``min_straight_km`` is the straight distance a detour ratio needs; ``distance`` makes
    the straight distance from the four coordinate columns and may be ``haversine_udf``.
    """
    straight = distance("pickup_latitude", "pickup_longitude", "dropoff_latitude", "dropoff_longitude")
    valid = question_trips(trips, "speed", window, days=False, year=year)
    measured = valid.withColumns(
        {
            "haversine_km": straight,
            "speed_kmh": F.col("trip_distance_km") * 60 / F.col("duration_minutes"),
            "duration_per_km": F.col("duration_minutes") / F.col("trip_distance_km"),
        }
    )
    far_enough = F.col("haversine_km") > min_straight_km
    slow = (F.col("speed_kmh") < C.SLOW_KMH) & (F.col("trip_distance_km") >= C.SLOW_MIN_KM)
    return measured.withColumns(
        {
            "haversine_mi": F.col("haversine_km") * C.MILES_PER_KM,
            "distance_gap_km": F.col("trip_distance_km") - F.col("haversine_km"),
            "detour_ratio": F.when(far_enough, F.try_divide("trip_distance_km", "haversine_km")),
            "congestion_candidate": slow.cast("int"),
        }
    )


def speed_by_hour(geometry: DataFrame, accuracy: int | None = None) -> DataFrame:
    """Duration, speed, detour and congestion per pickup hour, over ``with_trip_geometry`` rows.

    Trips are first summed per hour and whole second of duration.  The median and the 90th
    percentile are then exact, and the shuffled table has as many rows as there are distinct
    durations.  ``accuracy`` uses ``percentile_approx`` of that accuracy instead.
    """
    if accuracy is not None:
        return _speed_by_hour_approx(geometry, accuracy)
    per_second = geometry.groupBy("pickup_hour", C.whole_seconds().alias("seconds")).agg(
        M.trips(),
        *[part for name, value in DERIVED.items() for part in _sum_and_count(name, value)],
        F.sum("congestion_candidate").alias("slow"),
    )
    n, seconds = F.sum("trips"), F.sum(F.col("trips") * F.col("seconds"))
    km = M.unscaled(F.sum("km"), M.DERIVED_DIGITS)
    return (
        with_cumulative(per_second, ["pickup_hour"], "seconds", "trips")
        .groupBy("pickup_hour")
        .agg(
            n.alias("trips"),
            M.amount(seconds / (60.0 * n), "avg_duration_minutes"),
            M.amount(value_at(0.5, "seconds", "cumulative", "total") / 60.0, "median_duration_minutes"),
            M.amount(value_at(0.9, "seconds", "cumulative", "total") / 60.0, "p90_duration_minutes"),
            M.amount(_mean("speed"), "avg_speed_kmh"),
            M.amount(F.try_divide(km * 3600, seconds), "agg_speed_kmh"),
            M.amount(_mean("straight"), "avg_haversine_km"),
            M.amount(_mean("gap"), "avg_distance_gap_km"),
            M.amount(_mean("detour"), "avg_detour_ratio"),
            M.share(F.sum("slow") / n, "congestion_candidate_share"),
        )
        .orderBy("pickup_hour")
    )


def _sum_and_count(name: str, value: str) -> tuple:
    """Exact sum of a derived value, and how many values it has."""
    whole = M.scaled(value, M.DERIVED_DIGITS)
    return F.sum(whole).alias(name), F.count(whole).alias(f"{name}_n")


def _mean(name: str):
    return F.try_divide(M.unscaled(F.sum(name), M.DERIVED_DIGITS), F.sum(f"{name}_n"))


def _speed_by_hour_approx(geometry: DataFrame, accuracy: int) -> DataFrame:
    means = {name: M.exact_mean(value, M.DERIVED_DIGITS) for name, value in DERIVED.items()}
    per_hour = geometry.groupBy("pickup_hour").agg(
        M.trips(),
        M.amount(M.mean_minutes(), "avg_duration_minutes"),
        M.amount(means["speed"], "avg_speed_kmh"),
        M.amount(
            F.try_divide(M.exact_sum("trip_distance_km", M.DERIVED_DIGITS) * 3600, F.sum(C.whole_seconds())), "agg_speed_kmh"
        ),
        M.amount(means["straight"], "avg_haversine_km"),
        M.amount(means["gap"], "avg_distance_gap_km"),
        M.amount(means["detour"], "avg_detour_ratio"),
        M.share(F.avg("congestion_candidate"), "congestion_candidate_share"),
    )
    deciles = {"median_duration_minutes": 0.5, "p90_duration_minutes": 0.9}
    points = rank_points(geometry, ["pickup_hour"], "duration_minutes", accuracy)
    found = point_quantiles(points, ["pickup_hour"], deciles)
    return (
        per_hour.join(found.select("pickup_hour", *[M.amount(F.col(name), name) for name in deciles]), "pickup_hour")
        .select("pickup_hour", "trips", "avg_duration_minutes", *deciles, *per_hour.columns[3:])
        .orderBy("pickup_hour")
    )


def extreme_trips(geometry: DataFrame, kind: str, n: int = 5) -> DataFrame:
    """The ``n`` slowest trips per kilometre or the ``n`` fastest trips.

    Ties are settled by all other columns, so the rows returned are always the same.
    """
    metric = EXTREMES[kind]
    ties = [c for c in EXTREME_COLUMNS if c != metric]
    return geometry.select(*EXTREME_COLUMNS).orderBy(F.desc(metric), *ties).limit(n)
