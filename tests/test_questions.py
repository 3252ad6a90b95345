import datetime as dt
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from curbflow.operators import demand, flows, imbalance, od_change, payments, reshape, revenue, speed
from curbflow.params import TripWindow
from tests.conftest import at, one, rows_of


# Demand


def test_demand_top_hours(make_trips):
    trips = make_trips(
        {"passenger_count": None},
        {"passenger_count": 4, "pu_location_id": None, "minutes": 5, "trip_distance": 1.0},
        {"pickup_ts": at(26, 23, 30), "total_amount": 30.0},
        {"pickup_ts": at(26, 0), "total_amount": 30.0},
        {"pickup_ts": at(27, 0), "trip_distance": 0.0},
    )
    rows = rows_of(demand.demand_top_hours(trips))
    day = dt.date(2024, 3, 26)
    assert rows == [
        (day, 22, "Tue", False, "Late", 2, 1, 4.0, 7.5, 1.5, 14.5, 29.0, 0.5),
        (day, 0, "Tue", False, "Late", 1, 1, 1.0, 10.0, 2.0, 30.0, 30.0, 0.25),
        (day, 23, "Tue", False, "Late", 1, 1, 1.0, 10.0, 2.0, 30.0, 30.0, 0.25),
    ]
    assert demand.demand_top_hours(trips, TripWindow(top_k=1)).count() == 1


def test_average_of_nothing_is_null(make_trips):
    assert one(demand.demand_by_band(make_trips({"passenger_count": None})))["avg_passenger_count"] is None


def test_demand_by_band(make_trips):
    trips = make_trips({"pickup_ts": at(26, 21)}, {}, {"pickup_ts": at(28, 0)}, {"pickup_ts": at(27, 12)})
    rows = rows_of(demand.demand_by_band(trips), "time_band", "trips", "trips_share_in_personal_window")
    assert rows == [("Late", 2, 0.666667), ("Evening", 1, 0.333333)]


def test_demand_of_events_is_exact(spark):
    events = spark.createDataFrame(
        [(dt.datetime(2024, 1, 6, 9, 1), 1, 0.1), (dt.datetime(2024, 1, 6, 9, 2), 1, 0.2), (None, 2, 5.0)],
        "ts timestamp, user_id int, value double",
    )
    row = one(demand.demand_events_hourly(events))
    assert (row.weekday, row.is_weekend, row.time_band) == ("Sat", True, "Morning")
    assert (row.events, row.unique_actors, row.avg_amount, row.total_amount) == (2, 1, 0.15, 0.3)


# Speed


def test_geometry(make_trips):
    trips = make_trips(
        {"pickup_longitude": -73.95, "pickup_latitude": 40.77},
        {"pickup_longitude": -73.95, "pickup_latitude": 40.769},
        {"minutes": 1, "trip_distance": 1.0},
        {"pickup_ts": at(3)},
        {"pickup_longitude": 0.0},
    )
    geometry = speed.with_trip_geometry(trips)
    same, near, fast, other_day = geometry.orderBy("haversine_km", "duration_minutes").collect()
    assert same.haversine_km == 0 and same.detour_ratio is None
    assert near.haversine_km == pytest.approx(0.111, abs=0.001) and near.detour_ratio is None
    assert fast.speed_kmh == pytest.approx(96.56064) and fast.congestion_candidate == 0
    assert {other_day.pickup_ts.day, fast.pickup_ts.day} == {3, 26}
    assert same.speed_kmh == pytest.approx(19.312128)
    loose = speed.with_trip_geometry(trips, min_straight_km=0.0)
    assert loose.filter("detour_ratio IS NULL").count() == 1
    assert speed.with_trip_geometry(trips, year=2015).count() == 0


def test_congestion_needs_a_mile_and_low_speed(make_trips):
    trips = make_trips(
        {"trip_distance": 1.0, "minutes": 7},
        {"trip_distance": 0.99, "minutes": 7},
        {"trip_distance": 1.0, "minutes": 5},
    )
    flags = rows_of(speed.with_trip_geometry(trips).orderBy("duration_minutes", "trip_distance"))
    column = speed.with_trip_geometry(trips).columns.index("congestion_candidate")
    assert [row[column] for row in flags] == [0, 0, 1]


def test_speed_by_hour_quantiles(make_trips):
    trips = make_trips(*[{"minutes": m} for m in (1, 2, 3, 4, 5, 6, 7, 8, 9, 10)], {"pickup_ts": at(2, 0)})
    geometry = speed.with_trip_geometry(trips)
    late = {r.pickup_hour: r for r in speed.speed_by_hour(geometry).collect()}
    assert (late[22].trips, late[22].avg_duration_minutes) == (10, 5.5)
    assert (late[22].median_duration_minutes, late[22].p90_duration_minutes) == (5.0, 9.0)
    assert late[22].agg_speed_kmh == pytest.approx(10 * 2 * 1.609344 / (55 / 60), abs=1e-4)
    assert late[0].median_duration_minutes == 10.0
    assert rows_of(speed.speed_by_hour(geometry)) == rows_of(speed.speed_by_hour(geometry, accuracy=10000))


def test_extreme_trips_settle_ties(make_trips):
    trips = make_trips(*[{"vendor_id": v} for v in (7, 3, 5)], {"minutes": 50}, {"minutes": 1})
    geometry = speed.with_trip_geometry(trips)
    assert rows_of(speed.extreme_trips(geometry, "slowest", 3), "vendor_id", "duration_minutes") == [
        (1, 50.0),
        (3, 10.0),
        (5, 10.0),
    ]
    assert rows_of(speed.extreme_trips(geometry, "fastest", 1), "duration_minutes") == [(1.0,)]


# Revenue


def test_zone_revenue(make_trips, zones):
    trips = make_trips(
        {"pu_location_id": 5, "total_amount": 20.0, "tip_amount": None},
        {"pu_location_id": 6, "total_amount": 10.0, "trip_distance": 1.0, "minutes": 5},
        {"pu_location_id": 99},
        {"pu_location_id": None},
        {"pu_location_id": 1, "trip_distance": 12.0},
        {"fare_amount": -1.0},
    )
    rows = {tuple(r)[:3]: r for r in revenue.zone_revenue(trips, zones).collect()}
    assert set(rows) == {
        ("Queens", "Corona", "short"),
        ("Unknown", "Unknown", "short"),
        ("Queens", "JFK Airport", "long"),
    }
    corona = rows[("Queens", "Corona", "short")]
    assert (corona.trips, corona.total_revenue, corona.avg_revenue_per_trip) == (2, 30.0, 15.0)
    assert (corona.revenue_per_mile, corona.revenue_per_minute) == (10.0, 2.0)
    assert (corona.avg_tip_amount, corona.surcharge_share) == (2.0, 0.166667)
    assert rows[("Unknown", "Unknown", "short")].trips == 2


def test_zone_revenue_with_a_repeated_zone_id(make_trips, zones):
    twice = zones.union(zones.filter("location_id = 1").withColumn("zone", F.lit("Kennedy")))
    rows = revenue.zone_revenue(make_trips({}, {}), twice)
    assert sorted(rows_of(rows, "pickup_zone", "trips")) == [("JFK Airport", 2), ("Kennedy", 2)]


@pytest.mark.parametrize(
    "total, threshold", [(0, 10), (999, 10), (1000, 10), (3000, 30), (5000, 50), (10000, 50)]
)
def test_support_threshold(spark, total, threshold):
    counts = [threshold - 1, threshold, total - 2 * threshold + 1] if total else []
    grouped = spark.createDataFrame([(c,) for c in counts], "trips bigint")
    kept = sorted(c for (c,) in rows_of(revenue.supported(grouped), "trips"))
    assert kept == sorted(c for c in counts if c >= threshold)


def test_revenue_rankings(spark):
    grouped = spark.createDataFrame(
        [("A", "x", "short", 5, 100.0, 9.0), ("A", "y", "short", 900, 90.0, 1.0), ("A", "w", "short", 900, 90.0, 1.0)],
        "pickup_borough string, pickup_zone string, distance_bucket string, trips bigint, "
        "total_revenue double, revenue_per_mile double",
    )
    assert rows_of(revenue.rank_zone_revenue(grouped, "total_revenue"), "pickup_zone") == [("x",), ("w",), ("y",)]
    assert rows_of(revenue.rank_zone_revenue(grouped, "revenue_per_mile"), "pickup_zone") == [("w",), ("y",)]
    assert revenue.rank_zone_revenue(grouped, "revenue_per_mile", support=False).count() == 3
    with pytest.raises(ValueError):
        revenue.rank_zone_revenue(grouped, "trips")


# Payments


def test_payment_mix(make_trips):
    trips = make_trips(
        {"tip_amount": 5.0},
        {"tip_amount": 0.0},
        {"payment_type": 2, "tip_amount": 0.0, "vendor_id": 2},
        {"payment_type": 2, "pickup_ts": at(27, 0), "tip_amount": 0.0},
        {"payment_type": 4},
    )
    by_hour = {(r.pickup_hour, r.payment_label): r for r in payments.payment_mix_by_hour(trips).collect()}
    card = by_hour[(22, "card")]
    assert (card.trips, card.payment_share_in_hour, card.tip_rate, card.zero_tip_share) == (2, 0.666667, 0.25, 0.5)
    assert by_hour[(0, "cash")].payment_share_in_hour == 1.0
    by_vendor = rows_of(
        payments.payment_mix_by_vendor(trips), "vendor_id", "payment_type", "trips", "payment_share_in_vendor"
    )
    assert by_vendor == [(1, 1, 2, 0.666667), (1, 2, 1, 0.333333), (2, 2, 1, 1.0)]
    cash_only, both = payments.card_vs_cash(trips).collect()
    assert (cash_only.card_trips, cash_only.cash_trips, cash_only.card_share) == (0, 1, 0.0)
    assert cash_only.avg_total_card is None and cash_only.avg_tip_rate_card is None
    assert (both.card_share, both.avg_tip_rate_card) == (0.666667, 0.25)


# Flows


def test_endpoints_and_airport_flags(make_trips, zones):
    trips = make_trips(
        {"pu_location_id": 2, "do_location_id": 3},
        {"pu_location_id": 2, "do_location_id": 3, "airport_fee": 1.75},
        {"pu_location_id": 2, "do_location_id": 1},
        {"pu_location_id": 99, "do_location_id": 4},
        {"pu_location_id": None, "do_location_id": None},
    )
    ends = flows.with_endpoints(trips, zones)
    names = ("pu_zone", "do_zone", "pu_is_airport", "do_is_airport", "airport_trip")
    assert sorted(rows_of(ends, *names)) == [
        ("Midtown", "Harlem", 0, 0, 0),
        ("Midtown", "Harlem", 1, 0, 1),
        ("Midtown", "JFK Airport", 0, 1, 1),
        ("Unknown", "Newark", 0, 1, 1),
        ("Unknown", "Unknown", 0, 0, 0),
    ]
    groups = flows.flow_groups(trips, zones)
    table = rows_of(flows.borough_flows(groups), "pu_borough", "do_borough", "trips", "trip_share", "airport_trip_share")
    assert table == [
        ("Manhattan", "Manhattan", 2, 0.4, 0.5),
        ("Manhattan", "Queens", 1, 0.2, 1.0),
        ("Unknown", "EWR", 1, 0.2, 1.0),
        ("Unknown", "Unknown", 1, 0.2, 0.0),
    ]
    routes = rows_of(flows.airport_routes(groups, 2), "pu_zone", "do_zone", "trips", "avg_airport_fee")
    assert routes == [("Midtown", "Harlem", 1, 1.75), ("Midtown", "JFK Airport", 1, 0.0)]
    merged = flows.flow_groups(trips, zones, strategy="merge")
    assert rows_of(flows.borough_flows(merged)) == rows_of(flows.borough_flows(groups))


def test_airport_zone_list(zones):
    assert rows_of(flows.airport_zones(zones), "location_id") == [(4,), (1,)]
    assert rows_of(flows.airport_zones(zones, airport_pattern="corona$", n=1), "location_id") == [(4,)]


# Imbalance


def test_imbalance_keeps_unknown_ends_apart(make_trips, zones):
    trips = make_trips(
        *[{"pu_location_id": None, "do_location_id": 2}] * 2,
        {"pu_location_id": 2, "do_location_id": None},
        {"pu_location_id": 2, "do_location_id": 2, "pickup_ts": at(28, 0)},
    )
    rows = rows_of(
        imbalance.zone_imbalance(trips, zones, threshold=1).orderBy("hour", "location_id", "pickups"),
        "hour", "location_id", "zone", "pickups", "dropoffs", "net_pickups", "imbalance_ratio",
    )
    assert rows == [
        (0, 2, "Midtown", 1, 1, 0, 0.0),
        (22, None, "Unknown", 0, 1, -1, -1.0),
        (22, None, "Unknown", 2, 0, 2, 1.0),
        (22, 2, "Midtown", 1, 2, -1, -0.333333),
    ]


def test_imbalance_equals_an_outer_join(make_trips, zones):
    rng = random.Random(3)
    places = [1, 2, 3, 4, 5, 99, None]
    changes = [
        {"pu_location_id": rng.choice(places), "do_location_id": rng.choice(places), "pickup_ts": at(26, rng.choice([0, 22]))}
        for _ in range(300)
    ]
    pickups = Counter((c["pickup_ts"].hour, c["pu_location_id"]) for c in changes)
    dropoffs = Counter((c["pickup_ts"].hour, c["do_location_id"]) for c in changes)
    expected = []
    for key in set(pickups) | set(dropoffs):
        if key[1] is None:
            expected += [(*key, pickups[key], 0), (*key, 0, dropoffs[key])]
        else:
            expected.append((*key, pickups[key], dropoffs[key]))
    answer = imbalance.zone_imbalance(make_trips(*changes), zones, threshold=40)
    assert sorted(rows_of(answer, "hour", "location_id", "pickups", "dropoffs"), key=repr) == sorted(
        (row for row in expected if row[2] + row[3] >= 40), key=repr
    )


def _imbalance(spark, rows):
    schema = """hour int, location_id int, borough string, zone string, service_zone string, pickups bigint,
        dropoffs bigint, activity bigint, net_pickups bigint, imbalance_ratio double, abs_imbalance_ratio double"""
    full = []
    for hour, location, zone, p, d in rows:
        ratio = round((p - d) / (p + d), 6)
        full.append((hour, location, "B", zone, "S", p, d, p + d, p - d, ratio, abs(ratio)))
    return spark.createDataFrame(full, schema)


def test_imbalance_rankings(spark):
    table = _imbalance(spark, [(1, 8, "a", 9, 1), (1, 7, "b", 9, 1), (2, 5, "c", 1, 3), (2, 6, "d", 2, 2)])
    rank = imbalance.rank_imbalance
    assert rows_of(rank(table, "positive"), "location_id") == [(7,), (8,)]
    assert rows_of(rank(table, "negative"), "location_id") == [(5,)]
    assert rows_of(rank(table, "absolute", 3), "location_id") == [(7,), (8,), (5,)]
    assert rows_of(imbalance.imbalance_by_hour(table)) == [(1, 16, 0.8), (2, 2, 0.25)]


def test_matrices(spark):
    table = _imbalance(spark, [(1, 8, "a", 9, 1), (2, 8, "a", 1, 9), (1, 7, "b", 9, 1), (1, 5, "c", 5, 4)])
    assert rows_of(reshape.imbalance_matrix(table, (1, 2), n=2)) == [("a", 0.8, -0.8, None), ("b", 0.8, None, None)]
    assert rows_of(reshape.imbalance_matrix(table, (1,), n=2)) == [("a", 0.8, -0.8), ("b", 0.8, None)]
    table = spark.createDataFrame([("A", "B", 3), ("A", "A", 1), ("C", "B", 2)], "pu_borough string, do_borough string, trips bigint")
    assert rows_of(reshape.flow_matrix(table, ["A", "B"])) == [("A", 1, 3, 0), ("C", 0, 2, 0)]
    assert rows_of(reshape.flow_matrix(table.unionByName(table.selectExpr("pu_borough", "NULL AS do_borough", "trips")), ["A"])) == [("A", 1, 7), ("C", 0, 4)]
    nulls = spark.createDataFrame(
        [("x", "a", 10.0), ("y", "a", 5.0), ("y", "b", 1.0)], "dataset string, column_name string, null_percentage double"
    )
    assert rows_of(reshape.null_matrix(nulls, ["x", "y"])) == [("a", 10.0, 5.0, 0.0), ("b", 0.0, 1.0, 0.0)]
    assert rows_of(reshape.null_matrix(nulls, ["x"])) == [("a", 10.0, 5.0), ("b", 0.0, 1.0)]


# Change between month halves


def test_od_change(make_trips):
    trips = make_trips(
        {"pickup_ts": at(15, 5), "fare_amount": 10.0, "total_amount": 0.0},
        *[{"pickup_ts": at(16, 5), "fare_amount": f, "total_amount": 9.0} for f in (10.0, 20.0, 30.0)],
        {"pickup_ts": at(1, 6)},
        {"pickup_ts": at(20, 7)},
        {"pickup_ts": at(20, 5), "do_location_id": None},
    )
    row = one(od_change.od_period_change(trips, min_trips=1))
    assert tuple(row) == (1, 2, 5, 1, 3, 200.0, 10.0, 20.0, 100.0, 0.0, 9.0, None)
    # Nothing can be compared with an absent half, whatever the threshold.
    assert od_change.od_period_change(trips, min_trips=0).count() == 1
    assert od_change.od_period_change(trips, min_trips=2).count() == 0


def test_od_change_equals_two_scans_and_a_join(make_trips):
    rng = random.Random(5)
    changes = [
        {
            "pu_location_id": rng.randint(1, 3),
            "do_location_id": rng.randint(1, 2),
            "pickup_ts": at(rng.randint(1, 28), rng.choice([3, 4])),
            "fare_amount": float(rng.randint(-2, 30)),
            "total_amount": float(rng.randint(-5, 40)),
        }
        for _ in range(400)
    ]
    halves = defaultdict(lambda: ([], []))
    for c in changes:
        if c["fare_amount"] > 0:
            key = (c["pu_location_id"], c["do_location_id"], c["pickup_ts"].hour)
            halves[key][c["pickup_ts"].day > 12].append((c["fare_amount"], c["total_amount"]))
    expected = {}
    for key, (first, second) in halves.items():
        if min(len(first), len(second)) >= 5:
            fares = [sum(f for f, _ in half) / len(half) for half in (first, second)]
            expected[key] = (len(first), len(second), fares, (fares[1] - fares[0]) * 100 / fares[0])
    answer = od_change.od_period_change(make_trips(*changes), split_day=12, min_trips=5).collect()
    assert {tuple(r)[:3] for r in answer} == set(expected)
    for r in answer:
        n1, n2, fares, change = expected[tuple(r)[:3]]
        assert (r.trips_h1, r.trips_h2) == (n1, n2)
        assert [r.avg_fare_h1, r.avg_fare_h2, r.fare_change_pct] == pytest.approx([*fares, change], abs=6e-5)


def test_od_rankings(spark):
    table = spark.createDataFrame(
        [(1, 1, 1, 50.0, 10, 15), (1, 1, 2, 50.0, 20, 30), (1, 1, 3, -50.0, 20, 10), (1, 1, 0, -50.0, 20, 10)],
        "pu_location_id int, do_location_id int, pickup_hour int, trips_change_pct double, trips_h1 int, trips_h2 int",
    )
    assert rows_of(od_change.rank_od_change(table, "increase", 2), "pickup_hour") == [(2,), (1,)]
    assert rows_of(od_change.rank_od_change(table, "decrease", 2), "pickup_hour") == [(0,), (3,)]
