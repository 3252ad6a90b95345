import math

import pytest
from pyspark.sql import functions as F

from curbflow.functions import columns as C
from curbflow.functions import labels, measures, predicates
from curbflow.functions.udf import haversine_udf
from curbflow.params import TripWindow
from tests.conftest import at, rows_of


def test_window_wraps_at_midnight():
    assert TripWindow.spanning(21, 26) == TripWindow()
    assert TripWindow.spanning(23, 1, top_k=5).hours == (23, 0, 1, 2)


def test_window_from_seed():
    # 46 = 24 + 22 = 26 + 20 = 4 * 11 + 2
    assert TripWindow.from_seed(46) == TripWindow((21, 22, 23), (22, 23, 0, 1), 12)


def test_time_bands(spark):
    bands = dict(rows_of(spark.range(24).select(F.col("id").cast("int").alias("h"), C.time_band("id"))))
    assert [h for h in bands if bands[h] == "Morning"] == list(range(6, 12))
    assert [h for h in bands if bands[h] == "Afternoon"] == list(range(12, 17))
    assert [h for h in bands if bands[h] == "Evening"] == list(range(17, 22))
    assert [h for h in bands if bands[h] == "Late"] == [0, 1, 2, 3, 4, 5, 22, 23]


def test_distance_buckets(spark):
    miles = [(0.99,), (1.0,), (2.99,), (3.0,), (9.99,), (10.0,), (None,)]
    df = spark.createDataFrame(miles, "trip_distance double")
    assert [b for (b,) in rows_of(df.select(C.distance_bucket()))] == [
        "very_short",
        "short",
        "short",
        "medium",
        "medium",
        "long",
        "long",
    ]


def test_payment_labels(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (None,)], "payment_type int")
    assert rows_of(df.select(C.payment_label())) == [("card",), ("cash",), ("other",), ("other",)]


def test_weekdays(make_trips):
    # 26 March 2024 is a Tuesday, 28 April 2024 a Sunday, 27 July 2024 a Saturday.
    df = make_trips({}, {"pickup_ts": at(28, month=4)}, {"pickup_ts": at(27, month=7)})
    assert rows_of(df.select(C.weekday(), C.is_weekend())) == [("Tue", False), ("Sun", True), ("Sat", True)]


def test_derived_columns_are_computed_once(make_trips):
    df = make_trips({"pickup_ts": at(26, 23, 58), "minutes": 2.5})
    assert rows_of(df, "pickup_day", "pickup_hour", "duration_minutes", "trip_distance_km") == [
        (26, 23, 2.5, 3.218688)
    ]
    kept = C.with_derived(df.withColumn("pickup_day", F.lit(-1)))
    assert rows_of(kept, "pickup_day") == [(-1,)]
    assert C.with_derived(df) is df


def test_surcharges_skip_absent_and_null_columns(make_trips):
    df = make_trips({}, {"congestion_surcharge": 2.5, "airport_fee": 1.75})
    assert rows_of(df.select(C.surcharge_total(df))) == [(2.5,), (6.75,)]
    fewer = df.drop("congestion_surcharge", "airport_fee")
    assert rows_of(fewer.select(C.surcharge_total(fewer))) == [(2.5,), (2.5,)]


def test_airport_zones_by_name_borough_and_null(spark):
    df = spark.createDataFrame(
        [("JFK Airport", "Queens"), ("LaGuardia", None), ("Midtown", "Manhattan"), (None, "EWR"), (None, None)],
        "zone string, borough string",
    )
    assert [a for (a,) in rows_of(df.select(C.airport_zone()))] == [True, True, False, True, False]


def test_haversine_and_its_udf(spark):
    df = spark.createDataFrame(
        [
            (40.75, -73.98, 40.75, -73.98),
            (0.0, 0.0, 0.0, 180.0),
            (40.6413, -73.7781, 40.7769, -73.8740),
            (None, -73.98, 40.75, -73.98),
        ],
        "a double, b double, c double, d double",
    )
    native = [d for (d,) in rows_of(df.select(C.haversine_km("a", "b", "c", "d")))]
    vectorised = [d for (d,) in rows_of(df.select(haversine_udf("a", "b", "c", "d")))]
    assert native[0] == 0
    assert native[1] == pytest.approx(math.pi * 6371)
    assert native[2] == pytest.approx(17.1, abs=0.2)
    assert native[3] is None and vectorised[3] is None
    assert native[:3] == pytest.approx(vectorised[:3])


def test_box_includes_its_borders(make_trips):
    df = make_trips(
        {"pickup_longitude": -74.30, "dropoff_longitude": -73.60, "pickup_latitude": 40.45, "dropoff_latitude": 40.95},
        {"pickup_longitude": -74.31},
        {"dropoff_latitude": 0.0},
        {"dropoff_latitude": None},
    )
    assert df.filter(C.in_city_box()).count() == 1


FLAWS = {
    "pickup known": {"pickup_ts": None},
    "dropoff known": {"dropoff_ts": None},
    "takes time": {"minutes": 0},
    "ends after start": {"minutes": -3},
    "covers distance": {"trip_distance": 0.0},
    "has fare": {"fare_amount": 0.0},
    "has total": {"total_amount": -1.0},
    "card or cash": {"payment_type": 3},
    "ends known": {"do_location_id": None},
    "inside city": {"pickup_latitude": 0.0},
    "day and hour known": {"pickup_ts": None},
}


@pytest.mark.parametrize("question", predicates.VALIDITY)
def test_validity_rules(make_trips, question):
    rules = predicates.VALIDITY[question]
    # A trip without a pickup time has no duration, and one that ends early takes negative time.
    implied = {"pickup known": "takes time", "dropoff known": "takes time", "ends after start": "takes time"}
    implied["day and hour known"] = "takes time"
    for rule, flaw in FLAWS.items():
        kept = predicates.question_trips(make_trips({}, flaw), question).count()
        broken = rule in rules or implied.get(rule) in rules
        assert kept == (1 if broken else 2), (question, rule)


def test_window_takes_listed_days_of_every_month(make_trips):
    df = make_trips(
        {"pickup_ts": at(26, 21)},
        {"pickup_ts": at(28, 0, month=7)},
        {"pickup_ts": at(29, 0)},
        {"pickup_ts": at(26, 20)},
    )
    window = TripWindow()
    assert predicates.question_trips(df, "demand", window).count() == 2
    assert predicates.question_trips(df, "demand", window, days=False).count() == 3
    assert predicates.question_trips(df, "demand", window, year=2015).count() == 0


def test_labels(spark):
    df = spark.createDataFrame([("Queens", "JFK", 7, 132), (None, None, 7, 132)], "b string, z string, h int, k int")
    assert rows_of(
        df.select(
            labels.zone_bucket_label("b", "z", "h"),
            labels.flow_label("b", "z"),
            labels.zone_hour_label("z", "h"),
            labels.zone_label("z", "b", "k"),
        )
    ) == [
        ("Queens : JFK - 7", "Queens → JFK", "JFK (h=7)", "JFK (Queens)"),
        ("Unknown : Unknown - 7", "Unknown → Unknown", "Unknown (h=7)", "132"),
    ]


def test_sums_of_cents_do_not_depend_on_partitions(spark):
    cents = spark.range(20_000).selectExpr("cast(id * 7919 % 100003 as double) / 100 AS total_amount", "id % 3 AS k")
    sums = [
        rows_of(cents.repartition(n).groupBy("k").agg(measures.exact_sum("total_amount"), measures.exact_mean("total_amount")).orderBy("k"))
        for n in (1, 64)
    ]
    assert sums[0] == sums[1]
