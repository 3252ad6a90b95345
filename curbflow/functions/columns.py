"""Row-level columns, all built from JVM expressions so that scans stay in one codegen stage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Units, earth radius, city box and slow-traffic limits (10 mph over at least one mile).
KM_PER_MILE = 1.609344
MILES_PER_KM = 0.621371
EARTH_RADIUS_KM = 6371.0
LONGITUDE_BOX = (-74.30, -73.60)
LATITUDE_BOX = (40.45, 40.95)
SLOW_KMH = 16.09344
SLOW_MIN_KM = 1.609344
MIN_STRAIGHT_KM = 0.2

# First and last hour of each named band; every other hour is "Late".
TIME_BANDS = (("Morning", 6, 11), ("Afternoon", 12, 16), ("Evening", 17, 21))
OTHER_BAND = "Late"

# Exclusive upper limit in miles of each distance bucket; beyond them, and NULL, is "long".
DISTANCE_BUCKETS = (("very_short", 1), ("short", 3), ("medium", 10))
OTHER_BUCKET = "long"

# Payment codes.
CARD, CASH = 1, 2

# Amounts that count as surcharges.
SURCHARGES = (
    "extra",
    "mta_tax",
    "tolls_amount",
    "improvement_surcharge",
    "congestion_surcharge",
    "airport_fee",
)

# What makes a zone an airport zone.
AIRPORT_PATTERN = "jfk|laguardia|newark|airport"
AIRPORT_BOROUGH = "ewr"


def _first_match(branches, otherwise) -> Column:
    """CASE over ``(condition, label)`` pairs."""
    head, *tail = branches
    case = F.when(head[0], F.lit(head[1]))
    for condition, label in tail:
        case = case.when(condition, F.lit(label))
    return case.otherwise(F.lit(otherwise))


def duration_minutes(start="pickup_ts", end="dropoff_ts") -> Column:
    return (F.unix_timestamp(end) - F.unix_timestamp(start)) / 60.0


def whole_seconds(minutes="duration_minutes") -> Column:
    """Duration as whole seconds: sums of it are exact, whatever order partitions arrive in."""
    return F.floor(F.col(minutes) * 60 + 0.5)


DERIVED = {
    "pickup_date": lambda: F.to_date("pickup_ts"),
    "pickup_day": lambda: F.dayofmonth("pickup_ts"),
    "pickup_hour": lambda: F.hour("pickup_ts"),
    "duration_minutes": duration_minutes,
    "trip_distance_km": lambda: F.col("trip_distance") * KM_PER_MILE,
}


def with_derived(df: DataFrame, *names: str) -> DataFrame:
    """Add the named derived columns (all of them by default) that ``df`` lacks.

    A column already there is kept: recomputing a partition column would hide it
    from the optimizer and lose partition pruning.
    """
    missing = {n: DERIVED[n]() for n in (names or DERIVED) if n not in df.columns}
    return df.withColumns(missing) if missing else df


def weekday(ts="pickup_ts") -> Column:
    return F.date_format(ts, "E")


def is_weekend(ts="pickup_ts") -> Column:
    return F.weekday(ts) >= 5


def time_band(hour="pickup_hour") -> Column:
    hour = F.col(hour)
    return _first_match([(hour.between(lo, hi), name) for name, lo, hi in TIME_BANDS], OTHER_BAND)


def distance_bucket(miles="trip_distance") -> Column:
    return _first_match([(F.col(miles) < top, name) for name, top in DISTANCE_BUCKETS], OTHER_BUCKET)


def payment_label(code="payment_type") -> Column:
    code = F.col(code)
    return _first_match([(code == CARD, "card"), (code == CASH, "cash")], "other")


def surcharge_total(df: DataFrame) -> Column:
    """Sum of the surcharge columns ``df`` has, NULLs as zero."""
    total = F.lit(0.0)
    for name in existing(df, SURCHARGES):
        total = total + F.coalesce(name, F.lit(0.0))
    return total


def existing(df: DataFrame, wanted) -> list[str]:
    """The wanted columns that are present, in the wanted order."""
    return [name for name in wanted if name in df.columns]


def airport_zone(
    zone="zone", borough="borough", pattern=AIRPORT_PATTERN, special: Column | None = None
) -> Column:
    """True for airport zones by name pattern, or by ``special`` (the airport borough by default)."""
    if special is None:
        special = F.lower(borough) == AIRPORT_BOROUGH
    named = F.lower(zone).rlike(pattern)
    return F.coalesce(named, F.lit(False)) | F.coalesce(special, F.lit(False))


def in_city_box() -> Column:
    """Both trip ends inside the city box, borders included; NULL coordinates are not."""
    return (
        F.col("pickup_longitude").between(*LONGITUDE_BOX)
        & F.col("dropoff_longitude").between(*LONGITUDE_BOX)
        & F.col("pickup_latitude").between(*LATITUDE_BOX)
        & F.col("dropoff_latitude").between(*LATITUDE_BOX)
    )


def haversine_km(
    lat_from="pickup_latitude",
    lon_from="pickup_longitude",
    lat_to="dropoff_latitude",
    lon_to="dropoff_longitude",
) -> Column:
    """Great-circle distance; NULL when a coordinate is NULL."""
    phi_from, phi_to = F.radians(lat_from), F.radians(lat_to)
    half_dphi = (phi_to - phi_from) / 2
    half_dlambda = (F.radians(lon_to) - F.radians(lon_from)) / 2
    chord = F.sin(half_dphi) * F.sin(half_dphi) + F.cos(phi_from) * F.cos(phi_to) * F.sin(
        half_dlambda
    ) * F.sin(half_dlambda)
    # least/greatest skip NULLs, so the NULL of a missing coordinate is restored by the guard.
    clamped = F.when(chord.isNotNull(), F.least(F.greatest(chord, F.lit(0.0)), F.lit(1.0)))
    return 2 * EARTH_RADIUS_KM * F.atan2(F.sqrt(clamped), F.sqrt(1 - clamped))



def fill_unknown(df: DataFrame, *names: str) -> DataFrame:
    """Name the NULLs an outer join leaves in name columns."""
    return df.fillna("Unknown", subset=list(names))
