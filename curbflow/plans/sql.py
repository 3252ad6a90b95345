"""The question operators as SQL over the temp views ``trips`` and ``zones``.

Values are bound as named parameters, never pasted into the text.  Each query is a final
SELECT over named steps; amounts are doubles (``60D``, not ``60.0``, which is a decimal) that are summed as whole units.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curbflow.functions import columns as C
from curbflow.functions import measures as M
from curbflow.operators.imbalance import ACTIVITY_THRESHOLD
from curbflow.operators.speed import DERIVED
from curbflow.params import TripWindow

_TIMED = """pickup_ts IS NOT NULL AND dropoff_ts IS NOT NULL
    AND pickup_ts <= dropoff_ts AND duration_minutes > 0"""
_WINDOW = "array_contains(:days, pickup_day) AND array_contains(:hours, pickup_hour)"


def _scaled(value: str, digits: int = M.AMOUNT_DIGITS) -> str:
    """A value as a whole number of units of the scale, as in ``measures.scaled``."""
    return f"CASE WHEN abs({value}) < 1e{17 - digits}D THEN floor({value} * 1e{digits}D + 0.5D) END"


def _unscaled(total: str, digits: int = M.AMOUNT_DIGITS) -> str:
    return f"(CAST({total} AS double) / 1e{digits}D)"


def _exact(value: str, digits: int = M.AMOUNT_DIGITS) -> str:
    """Sum of an amount, added up exactly; the mean likewise."""
    return _unscaled(f"sum({_scaled(value, digits)})", digits)


def _exact_mean(value: str, digits: int = M.AMOUNT_DIGITS, where: str = "") -> str:
    kept = f" FILTER (WHERE {where})" if where else ""
    whole = _scaled(value, digits)
    return f"try_divide({_unscaled(f'sum({whole}){kept}', digits)}, count({whole}){kept})"


_TIP_RATE = "try_divide(tip_amount, fare_amount)"
_SECONDS = "floor(duration_minutes * 60 + 0.5D)"
_MEAN_MINUTES = f"round(try_divide(sum({_SECONDS}), 60D * count(duration_minutes)), 4)"
_DEMAND = f"""count(*) AS trips,
    count(DISTINCT pu_location_id) AS unique_pickup_zones,
    round(avg(passenger_count), 4) AS avg_passenger_count,
    {_MEAN_MINUTES} AS avg_duration_minutes,
    round({_exact_mean("trip_distance")}, 4) AS avg_trip_distance,
    round({_exact_mean("total_amount")}, 4) AS avg_total_amount,
    round({_exact("total_amount")}, 4) AS total_revenue"""
_MIX = f"""count(*) AS trips,
    round({_exact_mean("fare_amount")}, 4) AS avg_fare_amount,
    round({_exact_mean("total_amount")}, 4) AS avg_total_amount,
    round({_exact_mean("tip_amount")}, 4) AS avg_tip_amount,
    round({_exact_mean(_TIP_RATE, M.RATIO_DIGITS)}, 6) AS tip_rate,
    round(avg(if(tip_amount = 0, 1D, 0D)), 6) AS zero_tip_share"""
_LABEL = "CASE payment_type WHEN 1 THEN 'card' WHEN 2 THEN 'cash' ELSE 'other' END AS payment_label"


def _band(hour: str) -> str:
    """The time bands as a CASE expression."""
    whens = " ".join(f"WHEN {hour} BETWEEN {lo} AND {hi} THEN '{name}'" for name, lo, hi in C.TIME_BANDS)
    return f"CASE {whens} ELSE '{C.OTHER_BAND}' END"


def _bucket(miles: str) -> str:
    """The distance buckets as a CASE expression."""
    whens = " ".join(f"WHEN {miles} < {top} THEN '{name}'" for name, top in C.DISTANCE_BUCKETS)
    return f"CASE {whens} ELSE '{C.OTHER_BUCKET}' END"


def _box(name: str, limits: tuple[float, float]) -> str:
    return f"{name} BETWEEN {limits[0]}D AND {limits[1]}D"


def _derived(value: str) -> str:
    return _scaled(value, M.DERIVED_DIGITS)


def _mean_of(total: str, digits: int = M.AMOUNT_DIGITS) -> str:
    """Mean over groups that hold a scaled sum and how many values it has."""
    return f"try_divide({_unscaled(f'sum({total})', digits)}, sum({total}_n))"


# Amounts of a trip that flows sum.
_FLOW_AMOUNTS = {"total": "total_amount", "miles": "trip_distance", "fee": "coalesce(airport_fee, 0D)"}

STEPS = {
    "demand_trips": f"""
SELECT * FROM trips
WHERE {_WINDOW} AND {_TIMED} AND trip_distance > 0 AND total_amount > 0""",
    "date_hours": f"""
SELECT pickup_date, pickup_hour, {_DEMAND} FROM demand_trips GROUP BY pickup_date, pickup_hour""",
    "bands": f"""
SELECT {_band("pickup_hour")} AS time_band, {_DEMAND} FROM demand_trips GROUP BY 1""",
    "boxed_trips": f"""
SELECT *,
    sin(radians(dropoff_latitude - pickup_latitude) / 2) AS half_lat,
    sin(radians(dropoff_longitude - pickup_longitude) / 2) AS half_lon
FROM trips
WHERE array_contains(:hours, pickup_hour) AND {_TIMED} AND trip_distance > 0
    AND {_box("pickup_longitude", C.LONGITUDE_BOX)} AND {_box("dropoff_longitude", C.LONGITUDE_BOX)}
    AND {_box("pickup_latitude", C.LATITUDE_BOX)} AND {_box("dropoff_latitude", C.LATITUDE_BOX)}""",
    "straight_trips": f"""
SELECT *, 2 * {C.EARTH_RADIUS_KM}D * atan2(sqrt(chord), sqrt(1 - chord)) AS haversine_km
FROM (
    SELECT *, least(1D, greatest(0D, half_lat * half_lat
        + cos(radians(pickup_latitude)) * cos(radians(dropoff_latitude)) * half_lon * half_lon)) AS chord
    FROM boxed_trips
)""",
    "geometry": """
SELECT *,
    trip_distance_km * 60 / duration_minutes AS speed_kmh,
    duration_minutes / trip_distance_km AS duration_per_km,
    trip_distance_km - haversine_km AS distance_gap_km,
    CASE WHEN haversine_km > :min_straight_km
        THEN try_divide(trip_distance_km, haversine_km) END AS detour_ratio
FROM straight_trips""",
    "per_second": f"""
SELECT pickup_hour, {_SECONDS} AS seconds, count(*) AS n,
    {", ".join(f"sum({_derived(value)}) AS {name}, count({_derived(value)}) AS {name}_n" for name, value in DERIVED.items())},
    count_if(speed_kmh < {C.SLOW_KMH}D AND trip_distance_km >= {C.SLOW_MIN_KM}D) AS slow
FROM geometry GROUP BY ALL""",
    "running": """
SELECT *, sum(n) OVER (PARTITION BY pickup_hour ORDER BY seconds) AS upto,
    sum(n) OVER (PARTITION BY pickup_hour) AS whole
FROM per_second""",
    "revenue_per_id": f"""
SELECT pu_location_id, {_bucket("trip_distance")} AS distance_bucket,
    count(*) AS n, sum({_scaled("total_amount")}) AS revenue, sum({_scaled("trip_distance")}) AS miles,
    sum({_SECONDS}) AS seconds, sum({_scaled("fare_amount")}) AS fares,
    sum({_scaled("tip_amount")}) AS tips, count({_scaled("tip_amount")}) AS tips_n,
    sum({_scaled("(" + " + ".join(f"coalesce({name}, 0D)" for name in C.SURCHARGES) + ")")}) AS surcharges
FROM trips
WHERE {_WINDOW} AND {_TIMED} AND trip_distance > 0 AND fare_amount > 0 AND total_amount > 0
GROUP BY ALL""",
    "zone_revenue": f"""
SELECT coalesce(borough, 'Unknown') AS pickup_borough, coalesce(zone, 'Unknown') AS pickup_zone,
    distance_bucket, sum(n) AS trips,
    round({_unscaled("sum(revenue)")}, 4) AS total_revenue,
    round({_unscaled("sum(revenue)")} / sum(n), 4) AS avg_revenue_per_trip,
    round(try_divide(CAST(sum(revenue) AS double), sum(miles)), 4) AS revenue_per_mile,
    round(try_divide({_unscaled("sum(revenue)")} * 60, sum(seconds)), 4) AS revenue_per_minute,
    round({_unscaled("sum(fares)")} / sum(n), 4) AS avg_fare_amount,
    round({_mean_of("tips")}, 4) AS avg_tip_amount,
    round(try_divide(CAST(sum(surcharges) AS double), sum(revenue)), 6) AS surcharge_share
FROM revenue_per_id LEFT JOIN zones ON pu_location_id = location_id
GROUP BY ALL""",
    "supported_revenue": """
SELECT * EXCEPT (all_trips)
FROM (SELECT *, sum(trips) OVER () AS all_trips FROM zone_revenue)
WHERE trips >= greatest(10, least(50, floor(all_trips * 0.01D)))""",
    "paid_trips": f"""
SELECT * FROM trips
WHERE {_WINDOW} AND {_TIMED} AND trip_distance > 0 AND fare_amount > 0 AND total_amount > 0
    AND payment_type IN (1, 2)""",
    "marked_zones": """
SELECT *, coalesce(lower(zone) RLIKE :airport_pattern, false)
    OR coalesce(lower(borough) = :airport_borough, false)
    OR coalesce(lower(zone) = :airport_zone, false) AS at_airport
FROM zones""",
    "pairs": f"""
SELECT pu_location_id, do_location_id, coalesce(airport_fee > 0, false) AS fee_paid, count(*) AS n,
    {", ".join(f"sum({_scaled(value)}) AS {name}, count({_scaled(value)}) AS {name}_n" for name, value in _FLOW_AMOUNTS.items())},
    sum({_SECONDS}) AS seconds, count(duration_minutes) AS seconds_n
FROM trips
WHERE {_WINDOW} AND {_TIMED} AND trip_distance > 0 AND total_amount > 0
GROUP BY ALL""",
    "named_pairs": """
SELECT g.*,
    coalesce(p.borough, 'Unknown') AS pu_borough, coalesce(p.zone, 'Unknown') AS pu_zone,
    coalesce(d.borough, 'Unknown') AS do_borough, coalesce(d.zone, 'Unknown') AS do_zone,
    coalesce(p.at_airport, false) OR g.fee_paid OR coalesce(d.at_airport, false) AS airport_trip
FROM pairs g
LEFT JOIN marked_zones p ON g.pu_location_id = p.location_id
LEFT JOIN marked_zones d ON g.do_location_id = d.location_id""",
    "activity": f"""
SELECT hour, location_id, sum(pickup) AS pickups, sum(dropoff) AS dropoffs,
    sum(pickup) + sum(dropoff) AS activity, sum(pickup) - sum(dropoff) AS net_pickups
FROM (
    SELECT pickup_hour AS hour,
        stack(2, pu_location_id, 1, 0, do_location_id, 0, 1) AS (location_id, pickup, dropoff)
    FROM trips
    WHERE {_WINDOW} AND pickup_ts IS NOT NULL AND duration_minutes > 0 AND total_amount > 0
)
GROUP BY hour, location_id, location_id IS NULL AND pickup = 1
HAVING activity >= :threshold""",
    "zone_imbalance": """
SELECT hour, a.location_id, coalesce(borough, 'Unknown') AS borough, coalesce(zone, 'Unknown') AS zone,
    coalesce(service_zone, 'Unknown') AS service_zone, pickups, dropoffs, activity, net_pickups,
    round(try_divide(net_pickups, activity), 6) AS imbalance_ratio,
    abs(round(try_divide(net_pickups, activity), 6)) AS abs_imbalance_ratio
FROM activity a LEFT JOIN zones z ON a.location_id = z.location_id""",
}

_SPEED = ("boxed_trips", "straight_trips", "geometry")
_REVENUE = ("revenue_per_id", "zone_revenue")
_FLOWS = ("marked_zones", "pairs", "named_pairs")
_IMBALANCE = ("activity", "zone_imbalance")
_TRIP = """vendor_id, pickup_ts, dropoff_ts, pickup_hour, trip_distance, trip_distance_km, duration_minutes,
    duration_per_km, speed_kmh, haversine_km, distance_gap_km, detour_ratio, pickup_longitude,
    pickup_latitude, dropoff_longitude, dropoff_latitude"""
_SHARE = "round(trips / sum(trips) OVER (), 6) AS trips_share_in_personal_window"
_KEYS = "trips DESC, pickup_borough, pickup_zone, distance_bucket"

QUERIES = {
    "demand_top_hours": (
        ("demand_trips", "date_hours"),
        f"""
SELECT pickup_date, pickup_hour, date_format(pickup_date, 'E') AS weekday,
    weekday(pickup_date) >= 5 AS is_weekend, {_band("pickup_hour")} AS time_band,
    * EXCEPT (pickup_date, pickup_hour), {_SHARE}
FROM date_hours
ORDER BY trips DESC, total_revenue DESC, pickup_date, pickup_hour
LIMIT :top_k""",
    ),
    "demand_by_band": (
        ("demand_trips", "bands"),
        f"SELECT *, {_SHARE} FROM bands ORDER BY trips DESC, time_band",
    ),
    "speed_by_hour": (
        (*_SPEED, "per_second", "running"),
        f"""
SELECT pickup_hour, sum(n) AS trips,
    round(sum(n * seconds) / (60D * sum(n)), 4) AS avg_duration_minutes,
    round(min(seconds) FILTER (WHERE upto >= whole * 0.5D) / 60D, 4) AS median_duration_minutes,
    round(min(seconds) FILTER (WHERE upto >= whole * 0.9D) / 60D, 4) AS p90_duration_minutes,
    round({_mean_of("speed", M.DERIVED_DIGITS)}, 4) AS avg_speed_kmh,
    round(try_divide({_unscaled("sum(km)", M.DERIVED_DIGITS)} * 3600, sum(n * seconds)), 4) AS agg_speed_kmh,
    round({_mean_of("straight", M.DERIVED_DIGITS)}, 4) AS avg_haversine_km,
    round({_mean_of("gap", M.DERIVED_DIGITS)}, 4) AS avg_distance_gap_km,
    round({_mean_of("detour", M.DERIVED_DIGITS)}, 4) AS avg_detour_ratio,
    round(sum(slow) / sum(n), 6) AS congestion_candidate_share
FROM running GROUP BY pickup_hour ORDER BY pickup_hour""",
    ),
    "slowest_trips": (
        _SPEED,
        f"SELECT {_TRIP} FROM geometry ORDER BY duration_per_km DESC, {_TRIP} LIMIT :samples",
    ),
    "fastest_trips": (
        _SPEED,
        f"SELECT {_TRIP} FROM geometry ORDER BY speed_kmh DESC, {_TRIP} LIMIT :samples",
    ),
    "zone_revenue": (_REVENUE, "SELECT * FROM zone_revenue"),
    "top_total_revenue": (
        _REVENUE,
        f"SELECT * FROM zone_revenue ORDER BY total_revenue DESC, {_KEYS} LIMIT :top_k",
    ),
    "top_revenue_per_mile": (
        (*_REVENUE, "supported_revenue"),
        f"SELECT * FROM supported_revenue ORDER BY revenue_per_mile DESC, {_KEYS} LIMIT :top_k",
    ),
    "top_revenue_per_minute": (
        (*_REVENUE, "supported_revenue"),
        f"SELECT * FROM supported_revenue ORDER BY revenue_per_minute DESC, {_KEYS} LIMIT :top_k",
    ),
    "payment_mix_by_hour": (
        ("paid_trips",),
        f"""
SELECT *, {_LABEL}, round(trips / sum(trips) OVER (PARTITION BY pickup_hour), 6) AS payment_share_in_hour
FROM (
    SELECT pickup_hour, payment_type, {_MIX}, round({_exact_mean("trip_distance")}, 4) AS avg_trip_distance,
        {_MEAN_MINUTES} AS avg_duration_minutes
    FROM paid_trips GROUP BY pickup_hour, payment_type
)
ORDER BY pickup_hour, payment_type""",
    ),
    "payment_mix_by_vendor": (
        ("paid_trips",),
        f"""
SELECT *, {_LABEL}, round(trips / sum(trips) OVER (PARTITION BY vendor_id), 6) AS payment_share_in_vendor
FROM (SELECT vendor_id, payment_type, {_MIX} FROM paid_trips GROUP BY vendor_id, payment_type)
ORDER BY vendor_id, payment_type""",
    ),
    "card_vs_cash": (
        ("paid_trips",),
        f"""
SELECT pickup_hour,
    count_if(payment_type = 1) AS card_trips,
    count_if(payment_type = 2) AS cash_trips,
    round(count_if(payment_type = 1) / count(*), 6) AS card_share,
    round({_exact_mean("total_amount", where="payment_type = 1")}, 4) AS avg_total_card,
    round({_exact_mean("total_amount", where="payment_type = 2")}, 4) AS avg_total_cash,
    round({_exact_mean("fare_amount", where="payment_type = 1")}, 4) AS avg_fare_card,
    round({_exact_mean("fare_amount", where="payment_type = 2")}, 4) AS avg_fare_cash,
    round({_exact_mean(_TIP_RATE, M.RATIO_DIGITS, "payment_type = 1")}, 6) AS avg_tip_rate_card
FROM paid_trips GROUP BY pickup_hour ORDER BY pickup_hour""",
    ),
    "borough_flows": (
        _FLOWS,
        f"""
SELECT *, round(trips / sum(trips) OVER (), 6) AS trip_share
FROM (
    SELECT pu_borough, do_borough, sum(n) AS trips,
        round({_unscaled("sum(total)")}, 4) AS total_revenue,
        round({_mean_of("total")}, 4) AS avg_total_amount,
        round({_mean_of("miles")}, 4) AS avg_trip_distance,
        round(try_divide(sum(seconds), 60D * sum(seconds_n)), 4) AS avg_duration_minutes,
        round(try_divide(CAST(sum(if(airport_trip, n, 0)) AS double), sum(n)), 6) AS airport_trip_share
    FROM named_pairs GROUP BY pu_borough, do_borough
)
ORDER BY trips DESC, total_revenue DESC, pu_borough, do_borough
LIMIT :top_k""",
    ),
    "airport_routes": (
        _FLOWS,
        f"""
SELECT pu_zone, do_zone, sum(n) AS trips,
    round({_mean_of("fee")}, 4) AS avg_airport_fee,
    round({_mean_of("total")}, 4) AS avg_total_amount,
    round(try_divide(sum(seconds), 60D * sum(seconds_n)), 4) AS avg_duration_minutes,
    round({_mean_of("miles")}, 4) AS avg_trip_distance
FROM named_pairs WHERE airport_trip
GROUP BY pu_zone, do_zone
ORDER BY trips DESC, avg_total_amount DESC, pu_zone, do_zone
LIMIT :top_k""",
    ),
    "airport_zones": (
        ("marked_zones",),
        """
SELECT location_id, borough, zone, service_zone FROM marked_zones WHERE at_airport
ORDER BY borough, zone, location_id LIMIT :examples""",
    ),
    "zone_imbalance": (_IMBALANCE, "SELECT * FROM zone_imbalance"),
    "imbalance_top_positive": (
        _IMBALANCE,
        """
SELECT * FROM zone_imbalance WHERE net_pickups > 0
ORDER BY net_pickups DESC, hour, location_id, zone, pickups LIMIT :top_k""",
    ),
    "imbalance_top_negative": (
        _IMBALANCE,
        """
SELECT * FROM zone_imbalance WHERE net_pickups < 0
ORDER BY net_pickups, hour, location_id, zone, pickups LIMIT :top_k""",
    ),
    "imbalance_top_abs": (
        _IMBALANCE,
        """
SELECT * FROM zone_imbalance WHERE abs_imbalance_ratio IS NOT NULL
ORDER BY abs_imbalance_ratio DESC, hour, location_id, zone, pickups LIMIT :top_k""",
    ),
    "imbalance_by_hour": (
        _IMBALANCE,
        """
SELECT hour, sum(abs(net_pickups)) AS total_abs_net_pickups,
    round(avg(try_divide(abs(net_pickups), activity)), 6) AS mean_abs_imbalance_ratio
FROM zone_imbalance GROUP BY hour ORDER BY mean_abs_imbalance_ratio DESC, hour""",
    ),
}

# Defaults of the parameters that are not part of the window.
PARAMETERS = {
    "min_straight_km": C.MIN_STRAIGHT_KM,
    "samples": 5,
    "examples": 10,
    "threshold": ACTIVITY_THRESHOLD,
    "airport_pattern": C.AIRPORT_PATTERN,
    "airport_borough": C.AIRPORT_BOROUGH,
    "airport_zone": "",
}


def register_views(trips: DataFrame, zones: DataFrame | None = None) -> None:
    """Offer the tables to ``question_sql`` and to SQL of one's own."""
    C.with_derived(trips).createOrReplaceTempView("trips")
    if zones is not None:
        zones.createOrReplaceTempView("zones")


def sql_text(name: str) -> str:
    """The SQL of a question, with named parameters."""
    steps, final = QUERIES[name]
    return "WITH " + ",\n".join(f"{step} AS ({STEPS[step]}\n)" for step in steps) + "\n" + final.strip()


def _array(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def question_sql(
    spark: SparkSession, name: str, window: TripWindow = TripWindow(), **parameters
) -> DataFrame:
    """Run a question's SQL over the registered views."""
    unknown = set(parameters) - set(PARAMETERS)
    if unknown:
        raise ValueError(f"unknown parameters: {sorted(unknown)}")
    args = {
        **PARAMETERS,
        **parameters,
        "days": _array(window.days),
        "hours": _array(window.hours),
        "top_k": window.top_k,
    }
    text = sql_text(name)
    # A list of placeholders as long as the window: still bound, and unlike an array it reaches the scan.
    for part, column, values in (("days", "pickup_day", window.days), ("hours", "pickup_hour", window.hours)):
        bound = {f"{part}_{k}": value for k, value in enumerate(values)}
        if bound:
            text = text.replace(f"array_contains(:{part}, {column})", f"{column} IN ({', '.join(f':{k}' for k in bound)})")
            args |= bound
    return spark.sql(text, args={k: v for k, v in args.items() if re.search(rf":{k}\b", text)})
