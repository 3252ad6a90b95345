import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
import pytest

from curbflow.functions import quantiles
from curbflow.functions.quantiles import frequency_quantiles
from curbflow.operators import profile
from tests.conftest import at, one, rows_of


def test_null_profile(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, `b.c` string")
    assert rows_of(profile.null_profile(df, "t")) == [
        ("t", "b.c", 2, 2 / 3 * 100),
        ("t", "a", 1, 1 / 3 * 100),
    ]
    assert rows_of(profile.null_profile(df.limit(0), "t")) == [("t", "a", 0, 0.0), ("t", "b.c", 0, 0.0)]


def test_value_distribution(make_trips):
    trips = make_trips({}, {}, {"pickup_ts": at(26, 1)}, {"pickup_ts": None, "dropoff_ts": None})
    assert rows_of(profile.value_distribution(trips, "pickup_hour", "t")) == [
        ("t", None, 1),
        ("t", 1, 1),
        ("t", 22, 2),
    ]
    dense = rows_of(profile.value_distribution(trips, "pickup_hour", "t", densify=range(24)))
    assert [h for _, h, _ in dense] == [None, *range(24)]
    assert {h: n for _, h, n in dense if n} == {None: 1, 1: 1, 22: 2}
    narrow = rows_of(profile.value_distribution(trips, "pickup_hour", "t", densify=range(20, 22)))
    assert {h: n for _, h, n in narrow} == {None: 1, 1: 1, 20: 0, 21: 0, 22: 2}


def test_numbers_that_are_not_finite(spark):
    rows = [(float("inf"),), (float("nan"),), (float("-inf"),), (12.0,), (0.0,), (None,)]
    df = spark.createDataFrame(rows, "fare_amount double")
    assert rows_of(profile.log_histogram(df, "t", ["fare_amount"])) == [("t", "fare_amount", None, 2), ("t", "fare_amount", 1, 1)]
    histogram = profile.log_histogram(df, "t", ["fare_amount"])
    assert profile.densify_histogram(histogram, ["t", "u"]).agg(F.sum("count")).first()[0] == 3
    assert rows_of(profile.sign_counts(df, "t", ["fare_amount"])) == [("t", "fare_amount", 1, 1, 2, 6)]
    finite = df.filter("abs(fare_amount) < 1e9 or isnan(fare_amount)")
    assert rows_of(profile.numeric_summary(finite, "t", ["fare_amount"]))[0][2:] == (2, 0.0, 0.0, 0.0, 12.0, 12.0, 6.0)


@pytest.mark.parametrize("accuracy", [None, 10000])
def test_numeric_summary(spark, accuracy):
    df = spark.createDataFrame([(float(v), None) for v in range(1, 11)] + [(None, None)], "fare_amount double, tip_amount double")
    assert rows_of(profile.numeric_summary(df, "t", accuracy=accuracy)) == [
        ("t", "fare_amount", 10, 1.0, 3.0, 5.0, 8.0, 10.0, 5.5)
    ]


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    values=st.lists(
        st.one_of(
            st.integers(-5, 5).map(float),
            st.floats(allow_nan=False, width=64),
            st.floats(0.999, 1.001),
        ),
        min_size=1,
        max_size=60,
    )
)
def test_frequency_quantiles_are_exact(spark, values):
    df = spark.createDataFrame([(1, v) for v in values], "k int, value double")
    freq = df.groupBy("k", "value").agg(F.count(F.lit(1)).alias("n"))
    probabilities = {"low": 0.1, "median": 0.5, "high": 0.9, "last": 1.0}
    row = one(frequency_quantiles(freq, ["k"], "value", "n", probabilities))
    ordered = sorted(v + 0.0 for v in values)
    for name, p in probabilities.items():
        assert row[name] == ordered[math.ceil(p * len(ordered)) - 1], name


def test_one_value_held_by_most_rows(spark):
    df = spark.range(30000).select(F.lit(1).alias("k"), F.when(F.col("id") % 3 == 0, 7.0).otherwise(F.col("id") / 9).alias("value"))
    freq = df.groupBy("k", "value").agg(F.count(F.lit(1)).alias("n"))
    exact = df.agg(F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY value)")).first()[0]
    assert one(frequency_quantiles(freq, ["k"], "value", "n", {"m": 0.5})).m == exact


def test_a_narrow_column_is_split(spark, monkeypatch):
    """Many values in few cells: only a small part of them is put in order."""
    values = F.col("id") * 0.12 / 200_000 - 74.02
    freq = spark.range(200_000).select(F.lit(1).alias("k"), values.alias("value"), (F.col("id") % 3 + 1).alias("n"))
    ordered = []
    grouped = quantiles._reached
    monkeypatch.setattr(quantiles, "_reached", lambda cells, keys: ordered.append(grouped(cells, keys)) or ordered[-1])
    row = one(frequency_quantiles(freq, ["k"], "value", "n", {"low": 0.25, "median": 0.5}))
    counted = freq.select(F.explode(F.array_repeat("value", F.col("n").cast("int"))).alias("value"))
    exact = counted.agg(*[F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY value)") for p in (0.25, 0.5)]).first()
    assert [row.low, row.median] == list(exact)
    cells, parts = (df.select("low", "high").collect() for df in ordered)
    inside = lambda r: freq.filter(F.col("value").between(r.low, r.high)).count()
    assert min(map(inside, cells)) > 1000 and max(map(inside, parts)) < 50


def test_errors_of_approximate_quartiles(spark):
    df = spark.range(5000).select(F.pow(F.col("id") % 1237, 2).cast("double").alias("fare_amount"))
    sketch = profile.numeric_summary(df, "t", ["fare_amount"], accuracy=20)
    coarse = one(profile.quartile_errors(df, sketch))
    assert coarse.total == 5000 and all(coarse[q] <= 1 / 20 + 1 / 5000 for q in profile.QUARTILES)
    exact = one(profile.quartile_errors(df, profile.numeric_summary(df, "t", ["fare_amount"])))
    assert [exact[q] for q in profile.QUARTILES] == [0.0, 0.0, 0.0]
    wrong = sketch.withColumn("median", F.lit(-1.0))
    assert one(profile.quartile_errors(df, wrong)).median == 0.5


def test_log_histogram(spark):
    df = spark.createDataFrame([(v,) for v in (0.001, 0.5, 1.0, 9.99, 10.0, 1e7, 0.0, -3.0, None)], "trip_distance double")
    histogram = profile.log_histogram(df, "t")
    assert rows_of(histogram, "log10_floor_bucket", "count") == [(-3, 1), (-1, 1), (0, 2), (1, 1), (7, 1)]
    other = profile.log_histogram(df.filter("trip_distance < 5"), "u")
    dense = profile.densify_histogram(histogram.unionByName(other), ["t", "u", "v"])
    assert dense.count() == 15
    assert rows_of(dense.filter("dataset = 'v'").agg(F.sum("count"))) == [(0,)]
    assert rows_of(dense.filter("dataset = 'u' AND log10_floor_bucket = 7"), "count") == [(0,)]


def test_sign_counts(spark):
    df = spark.createDataFrame([(-1.0, 2.0), (0.0, 3.0), (None, 4.0)], "fare_amount double, other double")
    assert rows_of(profile.sign_counts(df, "t")) == [("t", "fare_amount", 1, 1, 0, 3)]


def test_joinability(make_trips, zones):
    trips = make_trips({}, {}, {"pu_location_id": 99}, {"pu_location_id": None})
    twice = zones.union(zones)
    assert rows_of(profile.joinability(trips, twice, "pu_location_id", "location_id")) == [(4, 2, 2, 50.0)]
    nobody = profile.joinability(trips.limit(0), zones, "pu_location_id", "location_id")
    assert rows_of(nobody) == [(0, 0, 0, 0.0)]


def test_top_keys(make_trips, zones):
    trips = make_trips({}, {}, {"pu_location_id": 99}, {"pu_location_id": 3}, {"pu_location_id": 2})
    assert rows_of(profile.top_keys(trips, zones, 3), "pu_location_id", "zone", "trip_count") == [
        (1, "JFK Airport", 2),
        (2, "Midtown", 1),
        (3, "Harlem", 1),
    ]
    assert (99, None, 1) in rows_of(profile.top_keys(trips, zones), "pu_location_id", "zone", "trip_count")


def test_anomaly_samples(make_trips):
    trips = make_trips(
        *[{"vendor_id": v} for v in (9, 4, 6)],
        {"fare_amount": -5.0, "total_amount": -1.0},
        {"minutes": 0, "trip_distance": None},
        {"minutes": -4},
        {"trip_distance": 1e7, "minutes": 600},
    )
    samples = profile.anomaly_samples(trips, "t", 2)
    rows = rows_of(samples, "category", "rank", "vendor_id", "trip_distance", "duration_minutes", "fare_amount")
    assert rows == [
        ("largest_duration_minutes", 1, 1, 1e7, 600.0, 10.0),
        ("largest_duration_minutes", 2, 1, 2.0, 10.0, -5.0),
        ("largest_trip_distance", 1, 1, 1e7, 600.0, 10.0),
        ("largest_trip_distance", 2, 1, 2.0, -4.0, 10.0),
        ("negative_fare_amount", 1, 1, 2.0, 10.0, -5.0),
        ("negative_total_amount", 1, 1, 2.0, 10.0, -5.0),
        ("zero_or_negative_duration", 1, 1, 2.0, -4.0, 10.0),
        ("zero_or_negative_duration", 2, 1, None, 0.0, 10.0),
    ]


def test_anomaly_samples_rank_all_ties(make_trips):
    trips = make_trips(*[{"vendor_id": v} for v in range(40, 0, -1)])
    rows = rows_of(profile.anomaly_samples(trips, "t", 3).filter("category = 'largest_trip_distance'"), "vendor_id")
    assert rows == [(1,), (2,), (3,)]


def test_describe_and_schema(make_trips):
    trips = make_trips({}, {"trip_distance": 4.0})
    described = {r.summary: r.trip_distance for r in profile.describe_table(trips.select("trip_distance")).collect()}
    assert (described["count"], described["mean"], described["max"]) == ("2", "3.0", "4.0")
    row = one(profile.schema_table(trips.select("vendor_id")))
    assert row.simple_string == "struct<vendor_id:int>"
    assert "vendor_id: integer" in row.tree_string and '"vendor_id"' in row.json
