"""Sums that do not depend on partition order, quantile sketches that merge in a tree, clustered files."""

import math
import random
from decimal import ROUND_FLOOR, Decimal

import pyarrow.parquet as pq
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from curbflow.functions import measures as M
from curbflow.functions import quantiles as Q
from curbflow.operators import flows, od_change, payments, profile, reshape, revenue, speed
from curbflow.plans.sql import question_sql, register_views
from curbflow.sources import readers, writers
from tests.conftest import at, one, rows_of

# Whole units


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.one_of(st.none(), st.integers(-(10**9), 10**9).map(lambda k: k / 100), st.floats(-1e6, 1e6)), max_size=30))
def test_scaled_sums_are_exact(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    units = [int((Decimal(v * 10000.0) + Decimal("0.5")).to_integral_value(ROUND_FLOOR)) for v in values if v is not None]
    row = one(df.agg(M.exact_sum("v").alias("sum"), M.exact_mean("v").alias("mean")))
    assert row.sum == (sum(units) / 10000 if units else None)
    assert row.mean == (sum(units) / 10000 / len(units) if units else None)


def test_scaled_values_out_of_range(spark):
    df = spark.createDataFrame([(float("inf"),), (float("nan"),), (1e13,), (-1e300,), (None,), (0.00005,), (-0.00005,)], "v double")
    assert [r.u for r in df.select(M.scaled("v").alias("u")).collect()] == [None, None, None, None, None, 1, 0]


def test_a_sum_that_leaves_a_long_is_an_error(spark):
    rows = spark.range(0, 1000, 1, 4).select(F.lit(9.9e12).alias("v"))
    with pytest.raises(Exception, match="ARITHMETIC_OVERFLOW"):
        rows.agg(M.exact_sum("v")).collect()


def test_means_of_values_far_out(spark):
    """Values beyond the range are added as doubles, so that a profile has their mean."""
    df = spark.createDataFrame([(1e15,), (3e15,), (0.5,)], "fare_amount double")
    for accuracy in (None, 100):
        assert one(profile.numeric_summary(df, "t", ["fare_amount"], accuracy))["avg"] == pytest.approx(4e15 / 3, rel=1e-12)


# Sums in any order


def many_trips(make_trips):
    """Amounts whose double sums depend on the order of adding."""
    rng = random.Random(7)
    rows = []
    for k in range(600):
        amounts = {name: round(rng.uniform(0, 90) * 10 ** rng.choice([0, 0, 3]), 2) for name in ("fare_amount", "total_amount", "tip_amount")}
        rows.append(
            amounts
            | {
                "pickup_ts": at(rng.choice([10, 26, 27]), rng.choice([21, 22])),
                "minutes": rng.randint(1, 90),
                "vendor_id": k % 3,
                "payment_type": 1 + k % 2,
                "trip_distance": rng.uniform(0.1, 20),
                "pu_location_id": k % 4,
                "do_location_id": k % 3,
                "airport_fee": rng.choice([None, 1.75]),
                "extra": rng.uniform(0, 3),
                "pickup_longitude": -73.9 - rng.random() / 10,
                "dropoff_latitude": 40.7 + rng.random() / 10,
            }
        )
    return make_trips(*rows)


TABLES = {
    "mix_by_hour": lambda t, z: payments.payment_mix_by_hour(t),
    "mix_by_vendor": lambda t, z: payments.payment_mix_by_vendor(t),
    "card_vs_cash": lambda t, z: payments.card_vs_cash(t),
    "speed_by_hour": lambda t, z: speed.speed_by_hour(speed.with_trip_geometry(t)),
    "zone_revenue": lambda t, z: revenue.zone_revenue(t, z),
    "borough_flows": lambda t, z: flows.borough_flows(flows.flow_groups(t, z)),
    "airport_routes": lambda t, z: flows.airport_routes(flows.flow_groups(t, z)),
    "od_change": lambda t, z: od_change.od_period_change(t, min_trips=1),
    "numeric_summary": lambda t, z: profile.numeric_summary(t, "t"),
}
SQL = ("payment_mix_by_hour", "payment_mix_by_vendor", "card_vs_cash", "speed_by_hour", "zone_revenue", "borough_flows", "airport_routes")


def unrounded(monkeypatch):
    """Rounding would hide a sum that differs in its last digits."""
    monkeypatch.setattr(M, "amount", lambda value, name: (F.col(value) if isinstance(value, str) else value).alias(name))
    monkeypatch.setattr(M, "share", lambda value, name: (F.col(value) if isinstance(value, str) else value).alias(name))


@pytest.mark.parametrize("name", TABLES)
def test_results_do_not_depend_on_partitions(spark, make_trips, zones, monkeypatch, name):
    unrounded(monkeypatch)
    trips = many_trips(make_trips)
    one_task, many = [sorted(rows_of(TABLES[name](trips.repartition(n, F.rand(n)), zones)), key=repr) for n in (1, 64)]
    assert one_task and one_task == many


@pytest.mark.parametrize("name", SQL)
def test_sql_results_do_not_depend_on_partitions(spark, make_trips, zones, name):
    found = []
    for n in (1, 64):
        register_views(many_trips(make_trips).repartition(n, F.rand(n)), zones)
        found.append(sorted(rows_of(question_sql(spark, name)), key=repr))
    assert found[0] and found[0] == found[1]


def test_sql_sums_are_those_of_the_operators(spark, make_trips, zones):
    trips = many_trips(make_trips)
    register_views(trips, zones)
    names = TABLES["borough_flows"](trips, zones).columns
    assert rows_of(question_sql(spark, "borough_flows"), *names) == rows_of(TABLES["borough_flows"](trips, zones))
    names = payments.payment_mix_by_hour(trips).columns
    assert rows_of(question_sql(spark, "payment_mix_by_hour"), *names) == rows_of(TABLES["mix_by_hour"](trips, zones))


# Quantiles


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    values=st.lists(
        st.one_of(st.integers(-5, 5).map(float), st.floats(allow_nan=False), st.integers(0, 40).map(lambda k: 1 + k * 2.0**-52), st.floats(-1e-310, 1e-310)),
        min_size=1,
        max_size=60,
    )
)
def test_selected_quantiles_are_exact(spark, values):
    df = spark.createDataFrame([(k, v * (3 - 2 * k)) for v in values for k in (1, 2)], "k int, value double")
    cells = df.groupBy("k", Q.select_cell("value").alias("cell")).agg(
        F.count(F.lit(1)).alias("in_cell"), F.min("value").alias("low"), F.max("value").alias("high")
    )
    probabilities = {"low": 0.1, "median": 0.5, "high": 0.9, "last": 1.0}
    rows = Q.selected_quantiles(df, cells, ["k"], "value", probabilities, {"n": F.sum("in_cell")}).collect()
    assert len(rows) == 2
    for row in rows:
        ordered = sorted(v * (3 - 2 * row.k) + 0.0 for v in values)
        assert row.n == len(ordered)
        for name, p in probabilities.items():
            assert row[name] == ordered[math.ceil(p * len(ordered)) - 1], name


@settings(max_examples=200, deadline=None)
@given(st.floats(allow_nan=False), st.floats(allow_nan=False))
def test_cells_rise_with_their_values(a, b):
    """The rounding of the first pass, in plain Python."""

    def cell(v):
        shifted = v * (2.0**Q.SELECT_DROPPED_BITS + 1)
        return shifted - (shifted - v) if abs(v) < 2.0**960 else v

    low, high = sorted((a, b))
    assert cell(low) <= cell(high)
    if 1e-300 < abs(a) < 1e300:
        assert abs(cell(a) - a) <= abs(a) * 2.0**-11


def rank_error(ordered, value, p):
    below = sum(v < value for v in ordered)
    upto = sum(v <= value for v in ordered)
    return max(below - p * len(ordered), p * len(ordered) - upto, 0) / len(ordered)


ASKED = {f"q{k}": k / 20 for k in range(1, 20)}


@pytest.mark.parametrize("tasks", [1, 7, 70])
def test_rank_points_keep_their_error(spark, tasks):
    accuracy = 50
    rows = spark.range(0, 6000, 1, tasks).select((F.col("id") % 2).alias("k"), F.pow(F.col("id") % 997, 2).cast("double").alias("v"))
    points = Q.rank_points(rows, ["k"], "v", accuracy)
    for row in Q.point_quantiles(points, ["k"], ASKED).collect():
        ordered = sorted(r.v for r in rows.filter(F.col("k") == row.k).collect())
        assert max(rank_error(ordered, row[q], p) for q, p in ASKED.items()) <= 1 / accuracy + 1 / len(ordered)
    assert {r.n for r in points.collect()} == {3000}


def test_no_task_merges_more_than_a_fixed_number_of_sketches(spark, monkeypatch, folder):
    """Each merge writes down how many sketches it had."""
    sort = Q.np.argsort
    seen = f"{folder}/merged"

    class Counted:
        def __getattr__(self, name):
            return getattr(__import__("numpy"), name)

        @staticmethod
        def stack(values):
            with open(seen, "a") as f:
                f.write(f"{len(values)}\n")
            return __import__("numpy").stack(values)

    monkeypatch.setattr(Q, "np", Counted())
    assert sort is __import__("numpy").argsort
    rows = spark.range(0, 4000, 1, 200).select(F.lit(1).alias("k"), F.col("id").cast("double").alias("v"))
    row = one(Q.point_quantiles(Q.rank_points(rows, ["k"], "v", 10), ["k"], {"m": 0.5}))
    assert abs(row.m - 2000) <= 400
    with open(seen) as f:
        sizes = sorted(int(line) for line in f)
    # 200 tasks: six full merges and one of eight, then seven, then one.
    assert sizes == [1, 7, 8, 32, 32, 32, 32, 32, 32]


def test_stored_sketches_of_days_merge(spark, folder):
    accuracy, days = 40, range(50)
    for day in (0, 1):
        rows = spark.range(0, 25_000, 1, 5).select((F.col("id") % 25 + 25 * day).alias("day"), (F.col("id") * 37 % 1009 + 100.0 * day).alias("v"))
        Q.rank_points(rows, ["day"], "v", accuracy).write.mode("append").parquet(f"{folder}/sketches")
    kept = readers.read_parquet(spark, f"{folder}/sketches")
    assert kept.count() == len(days)
    whole = Q.merge_points(kept.withColumn("month", F.lit(3)), ["month"])
    row = one(Q.point_quantiles(whole, ["month"], ASKED))
    ordered = sorted(k * 37 % 1009 + 100.0 * day for day in (0, 1) for k in range(25_000))
    # The error of the days and that of three more levels.
    assert max(rank_error(ordered, row[q], p) for q, p in ASKED.items()) <= (1 + 3 / Q.POINTS) / accuracy
    assert one(whole).n == 50_000


# Files


def test_row_groups_hold_few_hours(spark, folder):
    trips = spark.range(0, 400_000, 1, 4).select(
        (F.col("id") % 2 + 26).alias("pickup_day"), (F.col("id") * 7 % 24).cast("int").alias("pickup_hour"), F.xxhash64("id").alias("payload")
    )
    writers.write_partitioned(trips, f"{folder}/t", "pickup_day", cluster="pickup_hour", row_group_bytes=200_000)
    files = readers.read_parquet(spark, f"{folder}/t").inputFiles()
    kept = total = 0
    for file in files:
        meta = pq.ParquetFile(file.removeprefix("file://")).metadata
        place = next(k for k in range(meta.num_columns) if meta.schema.column(k).name == "pickup_hour")
        ranges = [(s.min, s.max) for k in range(meta.num_row_groups) for s in [meta.row_group(k).column(place).statistics]]
        assert ranges == sorted(ranges) and len(ranges) > 4
        total += len(ranges)
        kept += sum(low <= 22 <= high for low, high in ranges)
    assert kept * 4 < total
    back = readers.read_parquet(spark, f"{folder}/t")
    assert back.count() == 400_000 and back.filter("pickup_hour = 22").count() == trips.filter("pickup_hour = 22").count()


def test_unclustered_writes_are_as_before(spark, folder):
    writers.write_partitioned(spark.range(100).withColumn("d", F.col("id") % 3), f"{folder}/t", "d")
    assert readers.read_parquet(spark, f"{folder}/t").count() == 100


def test_a_listed_value_named_other_is_refused(spark):
    with pytest.raises(ValueError, match="other"):
        reshape.null_matrix(spark.createDataFrame([], "column_name string, dataset string, null_percentage double"), ["trips", "other"])
