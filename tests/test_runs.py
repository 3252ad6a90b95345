"""Whole runs: raw file to result tables."""

import json
from dataclasses import replace
from pathlib import Path

import pytest

from curbflow.contracts import TRIPS_GEO, TRIPS_ZONED
from curbflow.operators import demand_top_hours, ingest_trips
from curbflow.plans.ingest import run_trip_ingest
from curbflow.plans.questions import FAMILIES, answer, run_profile, run_question
from curbflow.sources import readers
from curbflow.sources.starschema import raw_trips_like, trips_like, zones_like
from curbflow.sources.writers import plan_text
from tests.conftest import rows_of

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


@pytest.mark.parametrize("family", FAMILIES)
def test_run_question(spark, folder, family):
    trips, zones = trips_like(spark, FOLDER), zones_like(spark, FOLDER)
    expected = {name: df.count() for name, df in answer(family, trips, zones).tables.items()}
    paths = run_question(family, trips, zones, folder)
    assert {k.partition(":")[2] for k in paths if k.startswith("table:")} == set(expected)
    (file,) = Path(paths["metrics"]).glob("part-*.json")
    document = json.loads(file.read_text())
    assert document["row_counts"] == expected
    counts = document["counts"]
    assert counts["input_rows"] == trips.count() >= counts["filtered_rows"] > 0
    more = {
        "revenue": {"groups", "support_threshold"},
        "imbalance": {"compared_zone_hours", "activity_threshold"},
        "od_halves": {"compared_pairs", "least_trips"},
    }
    assert set(counts) == {"input_rows", "filtered_rows"} | more.get(family, set())
    assert None not in counts.values() and 10 <= counts.get("support_threshold", 10) <= 50
    assert document["params"] == {"days": [26, 27, 28], "hours": [21, 22, 23, 0], "top_k": 20}
    for name, rows in expected.items():
        assert len(list(Path(paths[f"table:{name}"]).glob("part-*.csv"))) == 1
        if rows:
            assert readers.read_result_table(spark, paths[f"table:{name}"]).count() == rows


@pytest.mark.parametrize("family", [f for f in FAMILIES if f != "od_halves"])
def test_tables_of_a_question_share_grouped_frames_only(spark, folder, family):
    trips_like(spark, FOLDER).write.parquet(f"{folder}/trips")
    trips, zones = readers.read_parquet(spark, f"{folder}/trips"), zones_like(spark, FOLDER)
    found = answer(family, trips, zones)
    if family in ("demand", "speed", "payments"):
        # Nothing grouped to share: each table reads its pruned columns once, and no trips are kept.
        assert not found.shared
        for df in found.tables.values():
            assert plan_text(df, "simple").count(f"{folder}/trips"[:20]) == 1
        return
    (shared,) = found.shared
    assert "HashAggregate" in plan_text(shared, "simple")
    shared.persist()
    try:
        for name, df in answer(family, trips, zones).tables.items():
            scans = plan_text(df, "simple").count("InMemoryTableScan")
            assert scans >= 1 or name == "airport_zone_examples"
    finally:
        shared.unpersist()


def test_text_and_stored_trips_give_the_same_answer(spark, folder):
    spec = replace(TRIPS_ZONED, year=1998)
    raw_trips_like(spark, FOLDER).write.option("header", True).csv(f"{folder}/raw")
    run_trip_ingest(spark, f"{folder}/raw", f"{folder}/trips", spec)
    from_text = demand_top_hours(ingest_trips(readers.read_raw_trips(spark, f"{folder}/raw", spec), spec))
    from_table = demand_top_hours(readers.read_parquet(spark, f"{folder}/trips"))
    assert rows_of(from_text) == rows_of(from_table) != []


def test_run_profile(spark, folder):
    raw_trips_like(spark, FOLDER, geo=True).write.option("header", True).csv(f"{folder}/raw")
    spec = replace(TRIPS_GEO, year=None)
    geo = ingest_trips(readers.read_raw_trips(spark, f"{folder}/raw", spec), spec)
    zoned, zones = trips_like(spark, FOLDER), zones_like(spark, FOLDER)
    paths = run_profile({"geo": geo, "zoned": zoned}, zones, folder, zoned="zoned")
    nulls = readers.read_result_table(spark, paths["table:null_percentages"])
    assert {d for (d,) in rows_of(nulls.select("dataset").distinct())} == {"geo", "zoned", "zones"}
    hours = readers.read_result_table(spark, paths["table:pickup_hour_distribution"])
    assert rows_of(hours.groupBy("dataset").sum("trip_count").orderBy("dataset")) == [
        ("geo", zoned.count()),
        ("zoned", zoned.count()),
    ]
    (file,) = Path(paths["metrics"]).glob("part-*.json")
    document = json.loads(file.read_text())
    assert document["row_counts"]["joinability"] == 1
    assert len(document["anomalies_geo_preview"]) > 5
