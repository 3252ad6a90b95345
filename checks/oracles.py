"""DuckDB SQL for every registered query, written from the definition of each result.

The texts do not follow the Spark plans: pickups and dropoffs are two aggregates and a full
join here, month halves are two scans and a join, quantiles are DuckDB's own.
"""

from __future__ import annotations

WINDOW = "pickup_day IN (26, 27, 28) AND pickup_hour IN (21, 22, 23, 0)"
HOURS = "pickup_hour IN (21, 22, 23, 0)"
TIMED = """pickup_ts IS NOT NULL AND dropoff_ts IS NOT NULL AND pickup_ts <= dropoff_ts
  AND duration_minutes > 0"""


def r(expression: str, digits: int = 4) -> str:
    """Half-up rounding in decimals, so that a midpoint is a midpoint."""
    return f"CAST(round(CAST({expression} AS DECIMAL(28, 10)), {digits}) AS DOUBLE)"


def big(expression: str) -> str:
    return f"CAST({expression} AS BIGINT)"


BASE_TRIPS = """
base_trips AS (
  SELECT CAST(l_suppkey % 2 + 1 AS INT) AS vendor_id,
    o_orderdate + to_minutes(CAST((l_orderkey * 7 + l_partkey) % 1440 AS INT)) AS pickup_ts,
    o_orderdate + to_minutes(CAST((l_orderkey * 7 + l_partkey) % 1440 AS INT))
      + to_minutes(CAST((l_partkey * 13 + l_linenumber * 11) % 95 - 2 AS INT)) AS dropoff_ts,
    CASE WHEN l_orderkey % 10 = 0 THEN NULL ELSE l_linenumber END AS passenger_count,
    (l_quantity - 1) / 4 AS trip_distance,
    CASE WHEN l_orderkey % 97 = 0 THEN 99 ELSE c_nationkey END AS pu_location_id,
    s_nationkey AS do_location_id,
    CAST(l_orderkey % 4 + 1 AS INT) AS payment_type,
    CAST(floor(l_extendedprice / 1000) - 2 AS DOUBLE) AS fare_amount,
    0.5::DOUBLE AS extra, 0.5::DOUBLE AS mta_tax,
    CASE WHEN l_orderkey % 4 = 0 THEN CAST(floor(l_quantity / 4) AS DOUBLE) ELSE 0::DOUBLE END AS tip_amount,
    0::DOUBLE AS tolls_amount,
    CASE WHEN l_linenumber = 1 THEN NULL ELSE 1::DOUBLE END AS improvement_surcharge,
    CASE WHEN l_linenumber = 2 THEN NULL ELSE 2::DOUBLE END AS congestion_surcharge,
    CASE WHEN c_nationkey IN (3, 11) THEN 1.75::DOUBLE ELSE 0::DOUBLE END AS airport_fee,
    -74.30::DOUBLE + ((o_custkey * 7) % 720) / 1000::DOUBLE AS pickup_longitude,
    40.45::DOUBLE + ((l_partkey * 3) % 520) / 1000::DOUBLE AS pickup_latitude,
    -74.30::DOUBLE + ((l_partkey * 11) % 720) / 1000::DOUBLE AS dropoff_longitude,
    40.45::DOUBLE + ((o_custkey * 5) % 520) / 1000::DOUBLE AS dropoff_latitude
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN supplier ON l_suppkey = s_suppkey
)"""
TRIPS = f"""{BASE_TRIPS},
trips AS (
  SELECT *, fare_amount + tip_amount + 1 AS total_amount,
    CAST(pickup_ts AS DATE) AS pickup_date,
    CAST(day(pickup_ts) AS INT) AS pickup_day,
    CAST(hour(pickup_ts) AS INT) AS pickup_hour,
    (epoch(dropoff_ts) - epoch(pickup_ts)) / 60.0::DOUBLE AS duration_minutes,
    trip_distance * 1.609344::DOUBLE AS trip_distance_km
  FROM base_trips
)"""
ZONES = """
zones AS (
  SELECT n_nationkey AS location_id, r_name AS borough, n_name AS zone,
    CASE WHEN n_nationkey % 3 = 0 THEN 'Boro Zone' ELSE 'Yellow Zone' END AS service_zone
  FROM nation JOIN region ON n_regionkey = r_regionkey
)"""
BAND = """CASE WHEN pickup_hour BETWEEN 6 AND 11 THEN 'Morning' WHEN pickup_hour BETWEEN 12 AND 16 THEN 'Afternoon'
  WHEN pickup_hour BETWEEN 17 AND 21 THEN 'Evening' ELSE 'Late' END"""


def steps(*named: str) -> str:
    return "WITH " + ",".join(named)


# Demand ------------------------------------------------------------------------------------

_DEMAND_TRIPS = f"""
demand_trips AS (
  SELECT *, {BAND} AS time_band FROM trips
  WHERE {WINDOW} AND {TIMED} AND trip_distance > 0 AND total_amount > 0
)"""
_DEMAND = f"""count(*) AS trips, count(DISTINCT pu_location_id) AS unique_pickup_zones,
  {r("avg(passenger_count)")} AS avg_passenger_count,
  {r("avg(duration_minutes)")} AS avg_duration_minutes,
  {r("avg(trip_distance)")} AS avg_trip_distance,
  {r("avg(total_amount)")} AS avg_total_amount,
  {r("sum(total_amount)")} AS total_revenue,
  {r("count(*) / sum(count(*)) OVER ()", 6)} AS trips_share_in_personal_window"""

DEMAND_BY_HOUR = f"""{steps(TRIPS, _DEMAND_TRIPS)}
SELECT pickup_date, pickup_hour, strftime(pickup_date, '%a') AS weekday,
  dayofweek(pickup_date) IN (0, 6) AS is_weekend, time_band, {_DEMAND}
FROM demand_trips GROUP BY pickup_date, pickup_hour, time_band"""
DEMAND_TOP_HOURS = f"""{DEMAND_BY_HOUR}
ORDER BY trips DESC, total_revenue DESC, pickup_date, pickup_hour LIMIT 20"""
DEMAND_BY_BAND = f"{steps(TRIPS, _DEMAND_TRIPS)} SELECT time_band, {_DEMAND} FROM demand_trips GROUP BY time_band"
DEMAND_EVENTS = f"""
WITH slots AS (
  SELECT CAST(ts AS DATE) AS event_date, CAST(hour(ts) AS INT) AS event_hour, CAST(hour(ts) AS INT) AS pickup_hour,
    user_id, CAST(value AS DECIMAL(18, 2)) AS amount
  FROM events WHERE ts IS NOT NULL
)
SELECT event_date, event_hour, strftime(event_date, '%a') AS weekday,
  dayofweek(event_date) IN (0, 6) AS is_weekend, {BAND} AS time_band,
  count(*) AS events, count(DISTINCT user_id) AS unique_actors,
  {r("sum(amount)::DOUBLE / count(amount)")} AS avg_amount,
  CAST(sum(amount) AS DOUBLE) AS total_amount,
  {r("count(*) / sum(count(*)) OVER ()", 6)} AS event_share
FROM slots GROUP BY event_date, event_hour, pickup_hour"""

# Speed -------------------------------------------------------------------------------------


def _geometry(min_straight_km: float = 0.2, question: bool = True) -> str:
    where = (
        f"""WHERE {HOURS} AND {TIMED} AND trip_distance > 0
  AND pickup_longitude BETWEEN -74.30 AND -73.60 AND dropoff_longitude BETWEEN -74.30 AND -73.60
  AND pickup_latitude BETWEEN 40.45 AND 40.95 AND dropoff_latitude BETWEEN 40.45 AND 40.95"""
        if question
        else ""
    )
    return f"""
angles AS (
  SELECT *, least(1.0, greatest(0.0,
      pow(sin(radians(dropoff_latitude - pickup_latitude) / 2), 2)
      + cos(radians(pickup_latitude)) * cos(radians(dropoff_latitude))
      * pow(sin(radians(dropoff_longitude - pickup_longitude) / 2), 2))) AS chord
  FROM trips {where}
),
straight AS (
  SELECT *, 6371.0::DOUBLE * 2 * atan2(sqrt(chord), sqrt(1 - chord)) AS haversine_km FROM angles
),
geometry AS (
  SELECT *, haversine_km * 0.621371::DOUBLE AS haversine_mi,
    trip_distance_km * 60 / duration_minutes AS speed_kmh,
    duration_minutes / trip_distance_km AS duration_per_km,
    trip_distance_km - haversine_km AS distance_gap_km,
    CASE WHEN haversine_km > {min_straight_km} THEN trip_distance_km / haversine_km END AS detour_ratio
  FROM straight
)"""


def _speed_by_hour(min_straight_km: float, exact: bool = True) -> str:
    median, p90 = (r(f"quantile_disc(duration_minutes, {p})") if exact else "true" for p in (0.5, 0.9))
    return f"""{steps(TRIPS, _geometry(min_straight_km))}
SELECT pickup_hour, count(*) AS trips,
  {r("avg(duration_minutes)")} AS avg_duration_minutes,
  {median} AS median_duration_minutes,
  {p90} AS p90_duration_minutes,
  {r("avg(speed_kmh)")} AS avg_speed_kmh,
  {r("sum(trip_distance_km) / (sum(duration_minutes) / 60)")} AS agg_speed_kmh,
  {r("avg(haversine_km)")} AS avg_haversine_km,
  {r("avg(distance_gap_km)")} AS avg_distance_gap_km,
  {r("avg(detour_ratio)")} AS avg_detour_ratio,
  {r("avg(CASE WHEN speed_kmh < 16.09344 AND trip_distance_km >= 1.609344 THEN 1 ELSE 0 END)", 6)}
    AS congestion_candidate_share
FROM geometry GROUP BY pickup_hour"""


_TIES = """vendor_id, pickup_ts, dropoff_ts, pickup_hour, trip_distance, trip_distance_km, duration_minutes"""
_TRIP = f"""{_TIES}, duration_per_km, speed_kmh, haversine_km, distance_gap_km, detour_ratio, pickup_longitude,
  pickup_latitude, dropoff_longitude, dropoff_latitude"""
_TRIP_ROUNDED = f"""{_TIES}, {r("duration_per_km", 6)} AS duration_per_km, {r("speed_kmh", 6)} AS speed_kmh,
  {r("haversine_km", 6)} AS haversine_km, {r("distance_gap_km", 6)} AS distance_gap_km,
  {r("detour_ratio", 6)} AS detour_ratio, pickup_longitude, pickup_latitude, dropoff_longitude, dropoff_latitude"""


def _extremes(metric: str) -> str:
    return f"""{steps(TRIPS, _geometry())}
SELECT {_TRIP_ROUNDED} FROM (SELECT {_TRIP} FROM geometry ORDER BY {metric} DESC, {_TRIP} LIMIT 5)"""


GEOMETRY = f"""{steps(TRIPS, _geometry())}
SELECT {_TIES}, round(duration_per_km, 6) AS duration_per_km, round(speed_kmh, 6) AS speed_kmh,
  round(haversine_km, 6) AS haversine_km, round(haversine_mi, 6) AS haversine_mi,
  round(distance_gap_km, 6) AS distance_gap_km, round(detour_ratio, 6) AS detour_ratio,
  pickup_longitude, pickup_latitude, dropoff_longitude, dropoff_latitude,
  CASE WHEN speed_kmh < 16.09344 AND trip_distance_km >= 1.609344 THEN 1 ELSE 0 END AS congestion_candidate
FROM geometry"""
HAVERSINE = f"""{steps(TRIPS, _geometry(question=False))}
SELECT vendor_id, pickup_ts, pickup_longitude, pickup_latitude, dropoff_longitude, dropoff_latitude,
  round(haversine_km, 6) AS haversine_km
FROM straight"""

# Revenue -----------------------------------------------------------------------------------

_REVENUE = f"""
revenue_trips AS (
  SELECT *, CASE WHEN trip_distance < 1 THEN 'very_short' WHEN trip_distance < 3 THEN 'short'
      WHEN trip_distance < 10 THEN 'medium' ELSE 'long' END AS distance_bucket,
    coalesce(extra, 0) + coalesce(mta_tax, 0) + coalesce(tolls_amount, 0) + coalesce(improvement_surcharge, 0)
      + coalesce(congestion_surcharge, 0) + coalesce(airport_fee, 0) AS surcharges
  FROM trips
  WHERE {WINDOW} AND {TIMED} AND trip_distance > 0 AND fare_amount > 0 AND total_amount > 0
),
zone_revenue AS (
  SELECT coalesce(borough, 'Unknown') AS pickup_borough, coalesce(zone, 'Unknown') AS pickup_zone, distance_bucket,
    count(*) AS trips,
    {r("sum(total_amount)")} AS total_revenue,
    {r("avg(total_amount)")} AS avg_revenue_per_trip,
    {r("sum(total_amount) / sum(trip_distance)")} AS revenue_per_mile,
    {r("sum(total_amount) / sum(duration_minutes)")} AS revenue_per_minute,
    {r("avg(fare_amount)")} AS avg_fare_amount,
    {r("avg(tip_amount)")} AS avg_tip_amount,
    {r("sum(surcharges) / sum(total_amount)", 6)} AS surcharge_share
  FROM revenue_trips LEFT JOIN zones ON pu_location_id = location_id
  GROUP BY 1, 2, 3
)"""


def _top_revenue(metric: str, support: bool) -> str:
    enough = (
        """WHERE trips >= greatest(10, least(50,
  (SELECT CAST(floor(count(*) * 0.01) AS BIGINT) FROM revenue_trips)))"""
        if support
        else ""
    )
    return f"""{steps(TRIPS, ZONES, _REVENUE)}
SELECT * FROM zone_revenue {enough}
ORDER BY {metric} DESC, trips DESC, pickup_borough, pickup_zone, distance_bucket LIMIT 20"""


# Payments ----------------------------------------------------------------------------------

_PAID = f"""
paid AS (
  SELECT *, CASE payment_type WHEN 1 THEN 'card' ELSE 'cash' END AS payment_label FROM trips
  WHERE {WINDOW} AND {TIMED} AND trip_distance > 0 AND fare_amount > 0 AND total_amount > 0
    AND payment_type IN (1, 2)
)"""


def _mix(key: str, share: str, more: str = "") -> str:
    return f"""{steps(TRIPS, _PAID)},
totals AS (SELECT {key}, count(*) AS n FROM paid GROUP BY {key})
SELECT {key}, payment_type, payment_label, count(*) AS trips,
  {r("count(*) / n", 6)} AS {share},
  {r("avg(fare_amount)")} AS avg_fare_amount,
  {r("avg(total_amount)")} AS avg_total_amount,
  {r("avg(tip_amount)")} AS avg_tip_amount,
  {r("avg(tip_amount / fare_amount)", 6)} AS tip_rate,
  {r("avg(CASE WHEN tip_amount = 0 THEN 1.0 ELSE 0.0 END)", 6)} AS zero_tip_share {more}
FROM paid JOIN totals USING ({key}) GROUP BY {key}, payment_type, payment_label, n"""


MIX_BY_HOUR = _mix(
    "pickup_hour",
    "payment_share_in_hour",
    f""", {r("avg(trip_distance)")} AS avg_trip_distance, {r("avg(duration_minutes)")} AS avg_duration_minutes""",
)
CARD_VS_CASH = f"""{steps(TRIPS, _PAID)}
SELECT pickup_hour,
  count(*) FILTER (WHERE payment_type = 1) AS card_trips,
  count(*) FILTER (WHERE payment_type = 2) AS cash_trips,
  {r("count(*) FILTER (WHERE payment_type = 1) / count(*)", 6)} AS card_share,
  {r("avg(CASE WHEN payment_type = 1 THEN total_amount END)")} AS avg_total_card,
  {r("avg(CASE WHEN payment_type = 2 THEN total_amount END)")} AS avg_total_cash,
  {r("avg(CASE WHEN payment_type = 1 THEN fare_amount END)")} AS avg_fare_card,
  {r("avg(CASE WHEN payment_type = 2 THEN fare_amount END)")} AS avg_fare_cash,
  {r("avg(CASE WHEN payment_type = 1 THEN tip_amount / fare_amount END)", 6)} AS avg_tip_rate_card
FROM paid GROUP BY pickup_hour"""

# Flows -------------------------------------------------------------------------------------

_AIRPORTS = """
marked AS (
  SELECT *, regexp_matches(lower(zone), 'nation_(3|11)$') OR lower(zone) = 'nation_20' AS airport FROM zones
)"""
_ENDS = f"""
ends AS (
  SELECT t.*, coalesce(p.borough, 'Unknown') AS pu_borough, coalesce(p.zone, 'Unknown') AS pu_zone,
    coalesce(d.borough, 'Unknown') AS do_borough, coalesce(d.zone, 'Unknown') AS do_zone,
    CASE WHEN coalesce(p.airport, false) OR coalesce(airport_fee, 0) > 0 OR coalesce(d.airport, false)
      THEN 1 ELSE 0 END AS airport_trip
  FROM trips t
  LEFT JOIN marked p ON t.pu_location_id = p.location_id
  LEFT JOIN marked d ON t.do_location_id = d.location_id
  WHERE {WINDOW} AND {TIMED} AND trip_distance > 0 AND total_amount > 0
)"""
ENDPOINTS = f"""{steps(TRIPS, ZONES, _AIRPORTS)}
SELECT pickup_ts, dropoff_ts, trip_distance, pu_location_id, do_location_id,
  coalesce(p.borough, 'Unknown') AS pu_borough, coalesce(p.zone, 'Unknown') AS pu_zone,
  coalesce(p.service_zone, 'Unknown') AS pu_service_zone,
  coalesce(d.borough, 'Unknown') AS do_borough, coalesce(d.zone, 'Unknown') AS do_zone,
  coalesce(d.service_zone, 'Unknown') AS do_service_zone,
  CAST(coalesce(p.airport, false) OR airport_fee > 0 AS INT) AS pu_is_airport,
  CAST(coalesce(d.airport, false) AS INT) AS do_is_airport,
  CAST(coalesce(p.airport, false) OR airport_fee > 0 OR coalesce(d.airport, false) AS INT) AS airport_trip
FROM trips t
LEFT JOIN marked p ON t.pu_location_id = p.location_id
LEFT JOIN marked d ON t.do_location_id = d.location_id
WHERE {WINDOW} AND {TIMED} AND trip_distance > 0 AND total_amount > 0"""
_FLOWS = f"""
flows AS (
  SELECT pu_borough, do_borough, count(*) AS trips,
    {r("count(*) / (SELECT count(*) FROM ends)", 6)} AS trip_share,
    {r("sum(total_amount)")} AS total_revenue,
    {r("avg(total_amount)")} AS avg_total_amount,
    {r("avg(trip_distance)")} AS avg_trip_distance,
    {r("avg(duration_minutes)")} AS avg_duration_minutes,
    {r("avg(airport_trip)", 6)} AS airport_trip_share
  FROM ends GROUP BY pu_borough, do_borough
)"""
_ALL_FLOWS = steps(TRIPS, ZONES, _AIRPORTS, _ENDS, _FLOWS)
BOROUGH_FLOWS = f"""{_ALL_FLOWS}
SELECT * FROM flows ORDER BY trips DESC, total_revenue DESC, pu_borough, do_borough LIMIT 20"""
AIRPORT_ROUTES = f"""{steps(TRIPS, ZONES, _AIRPORTS, _ENDS)}
SELECT pu_zone, do_zone, count(*) AS trips,
  {r("avg(coalesce(airport_fee, 0))")} AS avg_airport_fee,
  {r("avg(total_amount)")} AS avg_total_amount,
  {r("avg(duration_minutes)")} AS avg_duration_minutes,
  {r("avg(trip_distance)")} AS avg_trip_distance
FROM ends WHERE airport_trip = 1 GROUP BY pu_zone, do_zone
ORDER BY trips DESC, avg_total_amount DESC, pu_zone, do_zone LIMIT 20"""
AIRPORT_ZONES = f"""{steps(ZONES, _AIRPORTS)}
SELECT location_id, borough, zone, service_zone FROM marked WHERE airport
ORDER BY borough, zone, location_id LIMIT 10"""
_BOROUGHS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST", "Unknown"]


def _flow_matrix(boroughs) -> str:
    listed = ", ".join(f"'{b}'" for b in boroughs)
    names = [(b, f"do_borough = '{b}'") for b in boroughs] + [("other", f"coalesce(do_borough NOT IN ({listed}), true)")]
    columns = ", ".join(f"""{big(f"coalesce(sum(trips) FILTER (WHERE {where}), 0)")} AS "{name}\"""" for name, where in names)
    return f"{_ALL_FLOWS} SELECT pu_borough, {columns} FROM flows GROUP BY pu_borough"


FLOW_MATRIX, FLOW_MATRIX_OTHER = _flow_matrix(_BOROUGHS), _flow_matrix(_BOROUGHS[1:3])

# Imbalance ---------------------------------------------------------------------------------

_IMBALANCE = f"""
kept AS (
  SELECT * FROM trips WHERE {WINDOW} AND pickup_ts IS NOT NULL AND duration_minutes > 0 AND total_amount > 0
),
p AS (SELECT pickup_hour AS hour, pu_location_id AS location_id, count(*) AS n FROM kept GROUP BY 1, 2),
d AS (SELECT pickup_hour AS hour, do_location_id AS location_id, count(*) AS n FROM kept GROUP BY 1, 2),
both_ends AS (
  SELECT coalesce(p.hour, d.hour) AS hour, coalesce(p.location_id, d.location_id) AS location_id,
    coalesce(p.n, 0) AS pickups, coalesce(d.n, 0) AS dropoffs
  FROM p FULL JOIN d ON p.hour = d.hour AND p.location_id = d.location_id
),
imbalance AS (
  SELECT hour, b.location_id, coalesce(borough, 'Unknown') AS borough, coalesce(zone, 'Unknown') AS zone,
    coalesce(service_zone, 'Unknown') AS service_zone, pickups, dropoffs,
    pickups + dropoffs AS activity, pickups - dropoffs AS net_pickups,
    {r("(pickups - dropoffs) / (pickups + dropoffs)", 6)} AS imbalance_ratio,
    {r("abs(pickups - dropoffs) / (pickups + dropoffs)", 6)} AS abs_imbalance_ratio
  FROM both_ends b LEFT JOIN zones z ON b.location_id = z.location_id
  WHERE pickups + dropoffs >= 15
)"""
_ALL_IMBALANCE = steps(TRIPS, ZONES, _IMBALANCE)


def _top_imbalance(where: str, order: str) -> str:
    return f"""{_ALL_IMBALANCE}
SELECT * FROM imbalance WHERE {where} ORDER BY {order}, hour, location_id, zone, pickups LIMIT 20"""


IMBALANCE_BY_HOUR = f"""{_ALL_IMBALANCE}
SELECT hour, {big("sum(abs(net_pickups))")} AS total_abs_net_pickups,
  {r("avg(abs(net_pickups) / activity)", 6)} AS mean_abs_imbalance_ratio
FROM imbalance GROUP BY hour"""


def _imbalance_matrix(hours) -> str:
    names = [(f"h{h}", f"hour = {h}") for h in hours] + [("other", f"hour NOT IN {hours}")]
    columns = ", ".join(f"{r(f'avg(imbalance_ratio) FILTER (WHERE {where})', 6)} AS {name}" for name, where in names)
    return f"""{_ALL_IMBALANCE},
top_zones AS (
  SELECT zone FROM imbalance GROUP BY zone
  ORDER BY round(avg(abs(imbalance_ratio)), 10) DESC, zone LIMIT 20
)
SELECT zone, {columns} FROM imbalance WHERE zone IN (SELECT zone FROM top_zones) GROUP BY zone"""


IMBALANCE_MATRIX, IMBALANCE_MATRIX_OTHER = _imbalance_matrix((21, 22, 23, 0)), _imbalance_matrix((21, 22))

# Change between month halves ---------------------------------------------------------------

_KEYS = "pu_location_id, do_location_id, pickup_hour"


def _half(name: str, rule: str) -> str:
    return f"""
{name} AS (
  SELECT {_KEYS}, count(*) AS trips, avg(fare_amount) AS fare, avg(total_amount) AS total FROM trips
  WHERE duration_minutes > 0 AND trip_distance > 0 AND fare_amount > 0 AND pickup_day IS NOT NULL
    AND pickup_hour IS NOT NULL AND pu_location_id IS NOT NULL AND do_location_id IS NOT NULL AND {rule}
  GROUP BY {_KEYS}
)"""


OD_CHANGE = f"""{steps(TRIPS, _half("h1", "pickup_day <= 15"), _half("h2", "pickup_day > 15"))}
SELECT {_KEYS}, h1.trips AS trips_h1, h2.trips AS trips_h2,
  {r("(h2.trips - h1.trips) * 100.0::DOUBLE / h1.trips")} AS trips_change_pct,
  {r("h1.fare")} AS avg_fare_h1, {r("h2.fare")} AS avg_fare_h2,
  CASE WHEN h1.fare > 0 THEN {r("(h2.fare - h1.fare) * 100 / h1.fare")} END AS fare_change_pct,
  {r("h1.total")} AS avg_total_h1, {r("h2.total")} AS avg_total_h2,
  CASE WHEN h1.total > 0 THEN {r("(h2.total - h1.total) * 100 / h1.total")} END AS total_amount_change_pct
FROM h1 JOIN h2 USING ({_KEYS}) WHERE h1.trips >= 2 AND h2.trips >= 2"""
OD_INCREASE = f"{OD_CHANGE} ORDER BY trips_change_pct DESC, trips_h2 DESC, {_KEYS} LIMIT 20"
OD_DECREASE = f"{OD_CHANGE} ORDER BY trips_change_pct, trips_h1 DESC, {_KEYS} LIMIT 20"

# Profiles ----------------------------------------------------------------------------------

_TRIP_COLUMNS = ("vendor_id", "pickup_ts", "dropoff_ts", "passenger_count", "trip_distance", "pu_location_id", "do_location_id", "payment_type", "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge", "total_amount", "congestion_surcharge", "airport_fee", "pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude", "pickup_date", "pickup_day", "pickup_hour", "duration_minutes", "trip_distance_km")
_ZONE_COLUMNS = ("location_id", "borough", "zone", "service_zone")
_EVENT_COLUMNS = ("event_id", "ts", "user_id", "event_type", "value", "props")


def _nulls(dataset: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{dataset}' AS dataset, '{c}' AS column_name,
  count(*) - count({c}) AS null_count, (count(*) - count({c})) / count(*) * 100.0::DOUBLE AS null_percentage
FROM {dataset}"""
        for c in columns
    )


_ALL_NULLS = " UNION ALL ".join(
    [_nulls("trips", _TRIP_COLUMNS), _nulls("zones", _ZONE_COLUMNS), _nulls("events", _EVENT_COLUMNS)]
)
NULL_PROFILE = f"{steps(TRIPS, ZONES)} {_ALL_NULLS}"


def _null_matrix(datasets) -> str:
    listed = ", ".join(f"'{d}'" for d in datasets)
    names = [(d, f"dataset = '{d}'") for d in datasets] + [("other", f"dataset NOT IN ({listed})")]
    columns = ", ".join(f"coalesce(avg(null_percentage) FILTER (WHERE {where}), 0) AS {name}" for name, where in names)
    return f"{steps(TRIPS, ZONES)} SELECT column_name, {columns} FROM ({_ALL_NULLS}) GROUP BY column_name"


NULL_MATRIX, NULL_MATRIX_OTHER = _null_matrix(("trips", "zones", "events")), _null_matrix(("zones",))


HOUR_DISTRIBUTION = f"""{steps(TRIPS)}
SELECT 'trips' AS dataset, pickup_hour, count(*) AS trip_count FROM trips GROUP BY pickup_hour
UNION ALL
SELECT 'events' AS dataset, CAST(hour(ts) AS INT) AS pickup_hour, count(*) AS trip_count FROM events GROUP BY 2"""
DAY_DISTRIBUTION = f"""{steps(TRIPS)}
SELECT 'trips' AS dataset, pickup_day, count(*) AS trip_count FROM trips GROUP BY pickup_day"""


def _day_dense(first: int, end: int) -> str:
    return f"""SELECT 'events' AS dataset, coalesce(d.day, e.day) AS pickup_day, coalesce(n, 0) AS trip_count
FROM (SELECT CAST(day AS INT) AS day FROM range({first}, {end}) d(day)) d
FULL JOIN (SELECT CAST(day(ts) AS INT) AS day, count(*) AS n FROM events GROUP BY 1) e ON d.day = e.day"""


DAY_DENSE, DAY_DENSE_FROM_20 = _day_dense(1, 32), _day_dense(20, 40)


_SUMMARY = ("trip_distance", "trip_distance_km", "duration_minutes", "fare_amount", "tip_amount", "total_amount")


def _numeric_summary(exact: bool) -> str:
    def quartile(c: str, p: float) -> str:
        return f"quantile_disc({c}, {p})" if exact else "true"

    return f"""{steps(TRIPS)} {" UNION ALL ".join(
        f'''SELECT 'trips' AS dataset, '{c}' AS column_name, count({c}) AS non_null_count, min({c}) AS min,
  {quartile(c, 0.25)} AS p25, {quartile(c, 0.5)} AS median, {quartile(c, 0.75)} AS p75,
  max({c}) AS max, {r(f"avg({c})", 6)} AS avg
FROM trips'''
        for c in _SUMMARY
    )}"""


NUMERIC_SUMMARY, NUMERIC_SUMMARY_KEPT = _numeric_summary(True), _numeric_summary(False)


def _histogram(dataset: str, column: str, source: str) -> str:
    return f"""SELECT '{dataset}' AS dataset, '{column}' AS column_name,
  CAST(floor(log10({column})) AS INT) AS log10_floor_bucket, count(*) AS "count"
FROM {source} WHERE {column} > 0 GROUP BY 3"""


LOG_HISTOGRAM = f"""{steps(TRIPS)}
{_histogram("trips", "trip_distance", "trips")} UNION ALL {_histogram("trips", "total_amount", "trips")}
UNION ALL {_histogram("lineitem", "l_extendedprice", "lineitem")}"""
HISTOGRAM_DENSE = f"""{steps(TRIPS)},
hist AS (
  {_histogram("trips", "total_amount", "trips")}
  UNION ALL {_histogram("orders", "total_amount", "(SELECT o_totalprice AS total_amount FROM orders)")}
)
SELECT b.dataset, b.column_name, b.log10_floor_bucket, coalesce(h."count", 0) AS "count"
FROM (SELECT DISTINCT column_name, log10_floor_bucket, unnest(['trips', 'orders']) AS dataset FROM hist) b
LEFT JOIN hist h ON h.dataset = b.dataset AND h.column_name = b.column_name
  AND h.log10_floor_bucket = b.log10_floor_bucket"""
SIGN_COUNTS = f"""{steps(TRIPS)} {" UNION ALL ".join(
    f'''SELECT 'trips' AS dataset, '{c}' AS column_name, count(*) FILTER (WHERE {c} < 0) AS negative_count,
  count(*) FILTER (WHERE {c} = 0) AS zero_count, count(*) FILTER (WHERE {c} > 0) AS positive_count,
  count(*) AS total_rows FROM trips'''
    for c in ("trip_distance", "fare_amount", "total_amount")
)}"""
JOINABILITY = f"""{steps(TRIPS, ZONES)}
SELECT count(*) AS total_rows, count(location_id) AS matched_rows, count(*) - count(location_id) AS unmatched_rows,
  count(location_id) / count(*) * 100.0::DOUBLE AS matched_percentage
FROM trips LEFT JOIN (SELECT DISTINCT location_id FROM zones) ON pu_location_id = location_id"""
TOP_KEYS = f"""{steps(TRIPS, ZONES)}
SELECT pu_location_id, borough, zone, service_zone, count(*) AS trip_count
FROM trips LEFT JOIN zones ON pu_location_id = location_id
GROUP BY 1, 2, 3, 4 ORDER BY trip_count DESC, pu_location_id LIMIT 10"""

_RECORD = """vendor_id, pickup_ts, dropoff_ts, pickup_day, pickup_hour, trip_distance, duration_minutes, fare_amount,
  tip_amount, total_amount, pickup_longitude, pickup_latitude, dropoff_longitude, dropoff_latitude,
  pu_location_id, do_location_id"""
_KINDS = (
    ("largest_trip_distance", "trip_distance IS NOT NULL", "trip_distance DESC"),
    ("largest_duration_minutes", "duration_minutes IS NOT NULL", "duration_minutes DESC"),
    ("negative_fare_amount", "fare_amount < 0", "fare_amount"),
    ("zero_or_negative_duration", "duration_minutes <= 0", "duration_minutes"),
    ("negative_total_amount", "total_amount < 0", "total_amount"),
)
ANOMALIES = f"""{steps(TRIPS)} {" UNION ALL ".join(
    f'''SELECT * FROM (SELECT 'trips' AS dataset, '{kind}' AS category,
  CAST(row_number() OVER (ORDER BY {order}, {_RECORD}) AS INT) AS rank, {_RECORD}
FROM trips WHERE {where}) WHERE rank <= 5'''
    for kind, where, order in _KINDS
)}"""
_MEASURES = (("count", "count"), ("mean", "avg"), ("stddev", "stddev_samp"), ("min", "min"), ("max", "max"))


def _describe(source: str, numbers, texts=()) -> str:
    def columns(fn: str) -> str:
        of_texts = {"avg": "CAST(NULL AS VARCHAR)", "stddev_samp": "CAST(NULL AS VARCHAR)"}
        cells = [f"{r(f'{fn}({c})', 6)} AS {c}" for c in numbers]
        cells += [f"{of_texts.get(fn, f'CAST({fn}({c}) AS VARCHAR)')} AS {c}" for c in texts]
        return ", ".join(cells)

    return " UNION ALL ".join(f"SELECT '{name}' AS summary, {columns(fn)} FROM {source}" for name, fn in _MEASURES)


_TIMES = ("pickup_ts", "dropoff_ts", "pickup_date")
DESCRIBE = f"{steps(TRIPS)} {_describe('trips', [c for c in _TRIP_COLUMNS if c not in _TIMES])}"
DESCRIBE_EVENTS = _describe("events", ("event_id", "user_id", "value"), ("event_type", "props"))
SCHEMA = """WITH fields AS (
  SELECT row_number() OVER () AS place, column_name AS name,
    CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string' ELSE 'timestamp_ntz' END AS kind
  FROM (DESCRIBE events)
),
named AS (SELECT *, replace(kind, 'bigint', 'long') AS long_kind FROM fields)
SELECT 'root' || chr(10) || string_agg(' |-- ' || name || ': ' || long_kind || ' (nullable = true)' || chr(10), '' ORDER BY place) AS tree_string,
  'struct<' || string_agg(name || ':' || kind, ',' ORDER BY place) || '>' AS simple_string,
  '{"fields":[' || string_agg('{"metadata":{},"name":"' || name || '","nullable":true,"type":"' || long_kind || '"}', ',' ORDER BY place)
    || '],"type":"struct"}' AS json
FROM named"""

# Ingest ------------------------------------------------------------------------------------

QUALITY = f"""{steps(TRIPS)},
seen AS (SELECT CASE WHEN pickup_hour <> 7 THEN pickup_ts END AS pickup_ts FROM trips)
SELECT count(*) AS raw_row_count, count(*) - count(pickup_ts) AS bad_or_null_pickup_ts_count,
  count(*) FILTER (WHERE year(pickup_ts) <> 1998) AS wrong_year_rejected_count,
  min(pickup_ts) AS min_pickup_ts, max(pickup_ts) AS max_pickup_ts
FROM seen"""
_ZONED = """vendor_id, pickup_ts, dropoff_ts, passenger_count, trip_distance, 1 AS rate_code_id,
  'N' AS store_and_fwd_flag, pu_location_id, do_location_id, payment_type, fare_amount, extra, mta_tax, tip_amount,
  tolls_amount, improvement_surcharge, total_amount, congestion_surcharge, airport_fee"""
_GEO = """vendor_id, pickup_ts, dropoff_ts, passenger_count, trip_distance, pickup_longitude, pickup_latitude,
  1 AS rate_code_id, 'N' AS store_and_fwd_flag, dropoff_longitude, dropoff_latitude, payment_type, fare_amount, extra,
  mta_tax, tip_amount, tolls_amount, improvement_surcharge, total_amount"""


def _ingested(columns: str) -> str:
    return f"""{steps(TRIPS)}
SELECT {columns}, pickup_date, pickup_day, pickup_hour, duration_minutes, trip_distance_km
FROM trips WHERE pickup_hour <> 7 AND year(pickup_ts) = 1998"""


# Labels ------------------------------------------------------------------------------------

LABELS = f"""{steps(TRIPS, ZONES, _AIRPORTS, _ENDS, _FLOWS, _REVENUE)},
counts AS (SELECT pu_location_id, count(*) AS n FROM trips GROUP BY 1)
SELECT 'flow' AS kind, pu_borough || ' → ' || do_borough AS label, trips FROM flows
UNION ALL
SELECT 'revenue', pickup_borough || ' : ' || pickup_zone || ' - ' || distance_bucket, trips FROM zone_revenue
UNION ALL
SELECT 'zone', coalesce(zone || ' (' || borough || ')', CAST(pu_location_id AS VARCHAR)), n
FROM counts LEFT JOIN zones ON pu_location_id = location_id
UNION ALL
SELECT 'zone_hour', coalesce(zone, 'Unknown') || ' (h=' || pickup_hour || ')', count(*)
FROM trips LEFT JOIN zones ON pu_location_id = location_id GROUP BY zone, pickup_hour"""

_QUESTIONS = {
    "demand_top_hours": DEMAND_TOP_HOURS,
    "demand_by_band": DEMAND_BY_BAND,
    "speed_by_hour": _speed_by_hour(0.2),
    "slowest_trips": _extremes("duration_per_km"),
    "fastest_trips": _extremes("speed_kmh"),
    "zone_revenue": f"{steps(TRIPS, ZONES, _REVENUE)} SELECT * FROM zone_revenue",
    "top_total_revenue": _top_revenue("total_revenue", support=False),
    "top_revenue_per_mile": _top_revenue("revenue_per_mile", support=True),
    "top_revenue_per_minute": _top_revenue("revenue_per_minute", support=True),
    "payment_mix_by_hour": MIX_BY_HOUR,
    "payment_mix_by_vendor": _mix("vendor_id", "payment_share_in_vendor"),
    "card_vs_cash": CARD_VS_CASH,
    "borough_flows": BOROUGH_FLOWS,
    "airport_routes": AIRPORT_ROUTES,
    "airport_zones": AIRPORT_ZONES,
    "zone_imbalance": f"{_ALL_IMBALANCE} SELECT * FROM imbalance",
    "imbalance_top_positive": _top_imbalance("net_pickups > 0", "net_pickups DESC"),
    "imbalance_top_negative": _top_imbalance("net_pickups < 0", "net_pickups"),
    "imbalance_top_abs": _top_imbalance("abs_imbalance_ratio IS NOT NULL", "abs_imbalance_ratio DESC"),
    "imbalance_by_hour": IMBALANCE_BY_HOUR,
}

ORACLES = {
    **_QUESTIONS,
    **{f"sql_{name}": text for name, text in _QUESTIONS.items()},
    "demand_by_hour": DEMAND_BY_HOUR,
    "demand_events_hourly": DEMAND_EVENTS,
    "speed_by_hour_approx": _speed_by_hour(0.2, exact=False),
    "speed_by_hour_any_detour": _speed_by_hour(0.0),
    "with_trip_geometry": GEOMETRY,
    "with_endpoints": ENDPOINTS,
    "haversine_native": HAVERSINE,
    "haversine_udf": HAVERSINE,
    "speed_by_hour_udf": _speed_by_hour(0.2),
    "borough_flows_merge_join": BOROUGH_FLOWS,
    "od_change": OD_CHANGE,
    "od_top_increase": OD_INCREASE,
    "od_top_decrease": OD_DECREASE,
    "null_profile": NULL_PROFILE,
    "hour_distribution": HOUR_DISTRIBUTION,
    "day_distribution": DAY_DISTRIBUTION,
    "day_distribution_dense": DAY_DENSE,
    "day_distribution_dense_from_20": DAY_DENSE_FROM_20,
    "numeric_summary": NUMERIC_SUMMARY,
    "numeric_summary_approx": NUMERIC_SUMMARY_KEPT,
    "log_histogram": LOG_HISTOGRAM,
    "log_histogram_dense": HISTOGRAM_DENSE,
    "sign_counts": SIGN_COUNTS,
    "joinability": JOINABILITY,
    "top_keys": TOP_KEYS,
    "anomaly_samples": ANOMALIES,
    "describe_table": DESCRIBE,
    "describe_events": DESCRIBE_EVENTS,
    "schema_table": SCHEMA,
    "ingest_quality": QUALITY,
    "ingest_trips_zoned": _ingested(_ZONED),
    "ingest_trips_geo": _ingested(_GEO),
    "ingest_zones": f"{steps(ZONES)} SELECT * FROM zones",
    "flow_matrix": FLOW_MATRIX,
    "flow_matrix_other": FLOW_MATRIX_OTHER,
    "imbalance_matrix": IMBALANCE_MATRIX,
    "imbalance_matrix_other": IMBALANCE_MATRIX_OTHER,
    "null_matrix": NULL_MATRIX,
    "null_matrix_other": NULL_MATRIX_OTHER,
    "display_labels": LABELS,
}
