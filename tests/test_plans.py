"""What the plans must show: pruning, one scan, the join asked for, work combined before shuffles."""

import json
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from curbflow.operators import demand, flows, imbalance, od_change, payments, profile, revenue, speed
from curbflow.functions.udf import haversine_udf
from curbflow.plans.catalog import registered
from curbflow.plans.questions import answer
from curbflow.plans.report import _fields, run_report, scaling_report
from curbflow.plans.sql import QUERIES, question_sql, register_views, sql_text
from curbflow.sources import readers, writers
from curbflow.sources.writers import plan_text
from tests.conftest import at, one, rows_of


@pytest.fixture
def stored(spark, make_trips, folder):
    """Typed trips on disk, partitioned by day, read back."""
    trips = make_trips(*[{"pickup_ts": at(day, hour)} for day in (1, 26, 27) for hour in (3, 22)])
    writers.write_partitioned(trips, f"{folder}/trips", "pickup_day")
    return readers.read_parquet(spark, f"{folder}/trips")


@pytest.fixture
def zones(zones, spark, folder):
    """Zones on disk, so that Spark knows their size."""
    zones.write.parquet(f"{folder}/zones")
    return readers.read_parquet(spark, f"{folder}/zones")


def trip_scans(df):
    return [scan for scan in scans(df) if "/trips" in scan]


def scans(df):
    return re.findall(r"FileScan parquet [^\n]*", plan_text(df, "simple"))


WINDOWED = {
    "demand": lambda t, z: demand.demand_top_hours(t),
    "bands": lambda t, z: demand.demand_by_band(t),
    "revenue": lambda t, z: revenue.zone_revenue(t, z),
    "mix": lambda t, z: payments.payment_mix_by_hour(t),
    "vendor": lambda t, z: payments.payment_mix_by_vendor(t),
    "cards": lambda t, z: payments.card_vs_cash(t),
    "flows": lambda t, z: flows.borough_flows(flows.flow_groups(t, z)),
    "routes": lambda t, z: flows.airport_routes(flows.flow_groups(t, z)),
    "imbalance": lambda t, z: imbalance.zone_imbalance(t, z),
}


@pytest.mark.parametrize("name", WINDOWED)
def test_day_partitions_are_pruned_and_scanned_once(stored, zones, name):
    df = WINDOWED[name](stored, zones)
    (scan,) = trip_scans(df)
    assert re.search(r"PartitionFilters: \[[^]]*pickup_day#\d+ IN \(26,27,28\)", scan), scan
    details = plan_text(df, "formatted")
    assert "In(pickup_hour, [0,21,22,23])" in details
    assert "GreaterThan(duration_minutes,0.0)" in details
    assert "mta_tax" not in scan or name == "revenue"


WINDOWED_SQL = [name for name in QUERIES if ":days" in sql_text(name)]


@pytest.mark.parametrize("name", WINDOWED_SQL)
def test_sql_prunes_day_partitions(spark, stored, zones, name):
    register_views(stored, zones)
    answer = question_sql(spark, name)
    (scan,) = trip_scans(answer)
    assert re.search(r"PartitionFilters: \[[^]]*pickup_day#\d+ IN \(26,27,28\)", scan), scan
    assert "In(pickup_hour, [0,21,22,23])" in plan_text(answer, "formatted")


def test_hour_partitions_are_pruned(spark, make_trips, folder):
    trips = make_trips(*[{"pickup_ts": at(2, hour)} for hour in (3, 22)])
    writers.write_partitioned(trips, f"{folder}/by_hour", "pickup_hour")
    geometry = speed.with_trip_geometry(readers.read_parquet(spark, f"{folder}/by_hour"))
    (scan,) = scans(speed.speed_by_hour(geometry))
    assert re.search(r"PartitionFilters: \[[^]]*pickup_hour#\d+ IN \(21,22,23,0\)", scan), scan


def test_recomputing_the_partition_column_would_lose_pruning(stored):
    shadowed = stored.withColumn("pickup_day", F.dayofmonth("pickup_ts"))
    (scan,) = scans(demand.demand_top_hours(shadowed))
    assert "PartitionFilters: []" in scan


def test_filters_and_columns_reach_the_scan(stored):
    (scan,) = scans(payments.card_vs_cash(stored))
    assert "GreaterThan(fare_amount,0.0)" in plan_text(payments.card_vs_cash(stored), "formatted")
    assert "passenger_count" not in scan and "airport_fee" not in scan


def test_one_scan_for_change_and_profiles(stored, zones):
    for df in (
        od_change.od_period_change(stored),
        profile.null_profile(stored, "t"),
        profile.sign_counts(stored, "t"),
        profile.log_histogram(stored, "t"),
        profile.joinability(stored, zones, "pu_location_id", "location_id"),
        profile.top_keys(stored, zones),
    ):
        assert len(trip_scans(df)) == 1


def test_change_has_no_join(stored):
    assert "Join" not in plan_text(od_change.od_period_change(stored), "simple")


def test_summary_shuffles_no_values(stored):
    """Every exchange has cells or parts of cells as its key, and each pass is combined in the tasks before it."""
    summary = profile.numeric_summary(stored, "t")
    initial = plan_text(summary, "simple")
    keys = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", initial)
    assert keys and not any("value#" in key for key in keys)
    assert not re.search(r"RoundRobin|rangepartitioning\([^)]*value#", initial)
    summary.collect()
    final, _ = plan_text(summary, "simple").split("== Initial Plan ==")
    # One scan: the other passes are not run when every cell with a rank holds one value.
    assert final.count("FileScan parquet") == 1


def test_summary_runs_a_last_pass_for_values_next_to_each_other(spark, folder):
    steps = [1.0 + k * 2.0**-52 for k in range(40)] + [0.5, 3.0]
    spark.createDataFrame([(v,) for v in steps], "fare_amount double").write.parquet(f"{folder}/close")
    summary = profile.numeric_summary(readers.read_parquet(spark, f"{folder}/close"), "t", ["fare_amount"])
    row = one(summary)
    ordered = sorted(steps)
    assert [row.p25, row.median, row.p75] == [ordered[10], ordered[20], ordered[31]]
    assert row.min == 0.5 and row.max == 3.0
    summary.collect()
    assert plan_text(summary, "simple").split("== Initial Plan ==")[0].count("FileScan parquet") > 1


def joins_below_first_aggregate(plan):
    """The text of the plan below the aggregate that reads trips, up to the trips themselves."""
    start = [m.start() for m in re.finditer(r"partial_sum\(CASE WHEN \(abs\(total_amount", plan)][-1]
    below = plan[start:]
    return below[: below.index("/trips")].count("Join")


@pytest.mark.parametrize("name", ["borough_flows", "airport_routes"])
def test_sql_flows_join_groups_not_trips(spark, stored, zones, name):
    register_views(stored, zones)
    answer = question_sql(spark, name)
    plan = plan_text(answer, "simple")
    assert plan.count("Join ") >= 2 and joins_below_first_aggregate(plan) == 0 and len(trip_scans(answer)) == 1


def test_join_strategy(stored, zones):
    auto = plan_text(flows.with_endpoints(stored, zones), "simple")
    merge = plan_text(flows.with_endpoints(stored, zones, strategy="merge"), "simple")
    assert auto.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in auto
    assert merge.count("SortMergeJoin") == 2 and "BroadcastHashJoin" not in merge
    with pytest.raises(ValueError):
        flows.with_endpoints(stored, zones, strategy="cross")


def test_a_large_dimension_is_not_broadcast(spark, stored, zones):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ends = flows.with_endpoints(stored, zones)
        assert "BroadcastHashJoin" not in plan_text(ends, "simple")
        assert ends.count() == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_hot_zone_is_split_in_the_merge_join(spark, make_trips, zones):
    """A pickup zone that holds most trips must not be the work of one task."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    n = F.explode(F.sequence(F.lit(0), F.lit(39999)))
    trips = make_trips({}).withColumn("n", n).repartition(8)
    trips = trips.withColumn("pu_location_id", F.when(F.col("n") % 3 < 2, 2).otherwise(F.col("n") % 50))
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        ends = flows.with_endpoints(trips, zones, strategy="merge").select("pu_zone", "do_zone", "vendor_id")
        assert len(ends.collect()) == 40000
        assert "skew=true" in plan_text(ends, "simple")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_revenue_joins_groups_not_trips(stored, zones):
    plan = plan_text(revenue.zone_revenue(stored, zones), "simple")
    assert plan.index("BroadcastHashJoin") < plan.index("partial_sum(CASE WHEN (abs(total_amount")


@pytest.mark.parametrize("strategy", ["auto", "merge"])
@pytest.mark.parametrize("table", [flows.borough_flows, flows.airport_routes])
def test_flows_join_groups_not_trips(stored, zones, table, strategy):
    plan = plan_text(table(flows.flow_groups(stored, zones, strategy=strategy)), "simple")
    below = plan[plan.index("partial_sum(CASE WHEN (abs(total_amount") :]
    assert "Join" in plan and len(trip_scans(table(flows.flow_groups(stored, zones, strategy=strategy)))) == 1
    # Indented further than the aggregate of trips: what it reads, up to the next branch of the plan.
    assert "Join" not in below[: below.index("/trips")]


def test_samples_are_limited_before_the_shuffle(stored):
    samples = profile.anomaly_samples(stored, "t")
    assert "WindowGroupLimit" in plan_text(samples, "simple")
    samples.collect()
    # One pass for the edges of all kinds, one for the records, however many kinds there are.
    assert plan_text(samples, "simple").count("ReusedSubquery") >= 4


def test_rankings_take_their_top_per_task(stored, zones):
    for df in (
        demand.demand_top_hours(stored),
        speed.extreme_trips(speed.with_trip_geometry(stored), "slowest"),
        imbalance.rank_imbalance(imbalance.zone_imbalance(stored, zones), "absolute"),
    ):
        assert "TakeOrderedAndProject" in plan_text(df, "simple")


def test_native_geometry_stays_in_the_jvm(stored):
    native = plan_text(speed.speed_by_hour(speed.with_trip_geometry(stored)), "simple")
    assert "Python" not in native
    vectorised = plan_text(speed.with_trip_geometry(stored, distance=haversine_udf), "simple")
    assert "ArrowEvalPython" in vectorised and "BatchEvalPython" not in vectorised


def test_nothing_runs_until_asked(spark, stored, zones):
    before = len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    for build in WINDOWED.values():
        build(stored, zones)
    profile.numeric_summary(stored, "t")
    profile.anomaly_samples(stored, "t")
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) == before


# SQL forms


@pytest.mark.parametrize("name", QUERIES)
def test_sql_answers_empty_tables(spark, make_trips, zones, name):
    register_views(make_trips({}).limit(0), zones.limit(0))
    assert question_sql(spark, name).count() == 0


def test_sql_parameters_are_bound(spark, make_trips, zones):
    register_views(make_trips({}, {"pickup_ts": at(3, 4)}), zones)
    assert ":top_k" in sql_text("demand_top_hours")
    hostile = question_sql(spark, "airport_zones", airport_pattern="' OR true --", airport_borough="ewr")
    assert rows_of(hostile, "location_id") == [(4,)]
    with pytest.raises(ValueError):
        question_sql(spark, "airport_zones", no_such_parameter=1)


# Reports


def test_report(spark, stored, zones, folder):
    tables = {
        "top_hours": demand.demand_top_hours(stored),
        "bands": demand.demand_by_band(stored),
    }
    run = {"config": "A", "run_type": "cold", "executor_config_expected": {"instances": 2, "cores": 2}}
    paths = run_report("demand", tables, f"{folder}/out", {"days": [26, 27], "top_k": 20}, run=run, shared=(stored,))
    assert readers.read_result_table(spark, paths["table:top_hours"]).count() == 2
    plan = "\n".join(p.read_text() for p in Path(paths["plan:bands"]).glob("part-*"))
    assert "== Optimized Logical Plan ==" in plan and "== Physical Plan ==" in plan
    (file,) = Path(paths["metrics"]).glob("part-*.json")
    document = json.loads(file.read_text())
    assert document["job"] == "demand" and document["params"] == {"days": [26, 27], "top_k": 20}
    assert document["row_counts"] == {"top_hours": 2, "bands": 1}
    assert [r["trips"] for r in document["top_hours_preview"]] == [1, 1]
    assert document["executor_config_expected"] == {"instances": 2, "cores": 2}
    assert document["elapsed_seconds"] > 0
    assert not stored.is_cached


@pytest.mark.parametrize("family", ["demand", "speed", "payments", "od_halves"])
def test_input_is_counted_in_one_scan(spark, stored, zones, family):
    found = answer(family, stored, zones)
    assert list(found.counts)[0] == "trips" and found.counts["trips"].columns == ["input_rows", "filtered_rows"]
    document = spark.range(1).select(*_fields({"trips": found.counts["trips"]}))
    document.collect()
    text = plan_text(document, "simple")
    assert len(set(re.findall(r"FileScan parquet [^\n]*/trips", text.split("== Initial Plan ==")[0]))) == 1
    assert text.split("== Initial Plan ==")[0].count("ReusedSubquery") >= 1
    row = one(document)
    assert row.input_rows == 6 and row.filtered_rows == found.counts["trips"].first().filtered_rows


def test_scaling_report(spark, folder):
    runs = [("A", "cold", 2, 355.798), ("B", "cold", 4, 133.326), ("C", "cold", 8, 100.972), ("A", "warm", 2, 225.216)]
    for config, kind, instances, elapsed in runs:
        document = {
            "config": config,
            "run_type": kind,
            "executor_config_expected": {"instances": instances, "cores": 2},
            "elapsed_seconds": elapsed,
        }
        Path(f"{folder}/{config}_{kind}.json").write_text(json.dumps(document, indent=2))
    assert rows_of(scaling_report(spark, folder), "config", "run_type", "instances", "speedup") == [
        ("A", "cold", 2, 1.0),
        ("B", "cold", 4, 2.67),
        ("C", "cold", 8, 3.52),
        ("A", "warm", 2, 1.0),
    ]


def test_json_documents_keep_nulls(spark, folder):
    writers.write_json_document(spark.range(1).select(F.lit(None).cast("int").alias("a")), f"{folder}/d")
    assert one(spark.read.text(f"{folder}/d")).value == '{"a":null}'


@pytest.mark.parametrize("name", ["ingest_trips_zoned", "ingest_trips_geo"])
@pytest.mark.parametrize("broadcast", ["10485760", "-1"])
def test_ingest_compiles_and_names_the_time_text_once(spark, name, broadcast):
    names = "spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold"
    before = [spark.conf.get(n) for n in names]
    try:
        for n, value in zip(names, ("false", broadcast)):
            spark.conf.set(n, value)
        df = registered()[name](spark, "/root/testdata/sf0.001")
        sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", plan_text(df, "codegen"))]
        (condition,) = re.findall(r"Join condition: [^N].*", plan_text(df, "formatted"))
    finally:
        for n, value in zip(names, before):
            spark.conf.set(n, value)
    # HotSpot interprets methods of more than 8,000 bytes.
    assert sizes and max(sizes) <= 8000
    assert condition.count("date_format(") == 1
