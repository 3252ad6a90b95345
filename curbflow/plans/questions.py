"""Question families: the result tables of each, and the runs that write them.

Only grouped frames are kept for several tables; trips are read again, pruned, rather than kept.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbflow.functions import columns as C
from curbflow.functions.predicates import question_rule
from curbflow.operators import demand, flows, imbalance, od_change, payments, profile, revenue, speed
from curbflow.params import TripWindow
from curbflow.plans.report import rows, run_report


@dataclass(frozen=True)
class Answer:
    """Result tables by name, the grouped frames that several of them are made from, and numbers about the input."""

    tables: dict[str, DataFrame]
    shared: tuple[DataFrame, ...] = field(default=())
    counts: dict[str, DataFrame | int] = field(default_factory=dict)


def _counts(trips: DataFrame, kept: Column, **more) -> dict[str, DataFrame | int]:
    """Rows read and rows that meet the rule, counted in one scan, and further numbers."""
    counted = trips.agg(F.count(F.lit(1)).alias("input_rows"), F.count_if(kept).alias("filtered_rows"))
    return {"trips": counted, **more}


def _demand(trips, zones, window) -> Answer:
    return Answer(
        {
            "top_hours": demand.demand_top_hours(trips, window),
            "time_band_summary": demand.demand_by_band(trips, window),
        },
        counts=_counts(trips, question_rule("demand", window)),
    )


def _speed(trips, zones, window) -> Answer:
    geometry = speed.with_trip_geometry(trips, window).select(*speed.EXTREME_COLUMNS, "congestion_candidate")
    return Answer(
        {
            "by_hour": speed.speed_by_hour(geometry),
            "slowest_per_km": speed.extreme_trips(geometry, "slowest"),
            "fastest": speed.extreme_trips(geometry, "fastest"),
        },
        counts=_counts(trips, question_rule("speed", window, days=False)),
    )


def _revenue(trips, zones, window) -> Answer:
    grouped = revenue.zone_revenue(trips, zones, window)
    return Answer(
        {f"top_{m}": revenue.rank_zone_revenue(grouped, m, window.top_k) for m in revenue.METRICS},
        (grouped,),
        _counts(
            trips,
            question_rule("revenue", window),
            groups=rows(grouped),
            support_threshold=revenue.support_threshold(grouped),
        ),
    )


def _payments(trips, zones, window) -> Answer:
    return Answer(
        {
            "by_hour_payment": payments.payment_mix_by_hour(trips, window),
            "vendor_payment": payments.payment_mix_by_vendor(trips, window),
            "card_vs_cash": payments.card_vs_cash(trips, window),
        },
        counts=_counts(trips, question_rule("payments", window)),
    )


def _flows(trips, zones, window) -> Answer:
    groups = flows.flow_groups(trips, zones, window)
    return Answer(
        {
            "borough_flows": flows.borough_flows(groups, window.top_k),
            "airport_routes": flows.airport_routes(groups, window.top_k),
            "airport_zone_examples": flows.airport_zones(zones),
        },
        (groups,),
        _counts(trips, question_rule("flows", window)),
    )


def _imbalance(trips, zones, window) -> Answer:
    table = imbalance.zone_imbalance(trips, zones, window)
    return Answer(
        {
            "top_positive": imbalance.rank_imbalance(table, "positive", window.top_k),
            "top_negative": imbalance.rank_imbalance(table, "negative", window.top_k),
            "top_abs": imbalance.rank_imbalance(table, "absolute", window.top_k),
            "hourly_summary": imbalance.imbalance_by_hour(table),
        },
        (table,),
        _counts(
            trips,
            question_rule("imbalance", window),
            compared_zone_hours=rows(table),
            activity_threshold=imbalance.ACTIVITY_THRESHOLD,
        ),
    )


def _od_halves(trips, zones, window) -> Answer:
    change = od_change.od_period_change(trips)
    return Answer(
        {
            "top_increase": od_change.rank_od_change(change, "increase", window.top_k),
            "top_decrease": od_change.rank_od_change(change, "decrease", window.top_k),
        },
        (change,),
        _counts(
            trips, question_rule("od_change"), compared_pairs=rows(change), least_trips=od_change.MIN_TRIPS
        ),
    )


FAMILIES = {
    "demand": _demand,
    "speed": _speed,
    "revenue": _revenue,
    "payments": _payments,
    "flows": _flows,
    "imbalance": _imbalance,
    "od_halves": _od_halves,
}


def answer(family: str, trips: DataFrame, zones: DataFrame, window: TripWindow = TripWindow()) -> Answer:
    """The result tables of a question family.  Nothing runs yet."""
    return FAMILIES[family](C.with_derived(trips), zones, window)


def run_question(
    family: str,
    trips: DataFrame,
    zones: DataFrame,
    folder: str,
    window: TripWindow = TripWindow(),
    **report,
) -> dict[str, str]:
    """Answer a question family and write its tables, plans and metrics document."""
    found = answer(family, trips, zones, window)
    params = {"days": window.days, "hours": window.hours, "top_k": window.top_k}
    return run_report(family, found.tables, folder, params, shared=found.shared, counts=found.counts, **report)


def _union(frames) -> DataFrame:
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame)
    return first


def profile_tables(
    datasets: dict[str, DataFrame],
    zones: DataFrame,
    *,
    zoned: str,
    zones_name: str = "zones",
) -> dict[str, DataFrame]:
    """Every profile of the trip datasets and the zone lookup, datasets told apart by name.

    ``zoned`` names the dataset with location ids.
    """

    def of_each(make):
        return _union(make(df, name) for name, df in datasets.items())

    by_zone = datasets[zoned]
    return {
        "null_percentages": of_each(profile.null_profile).unionByName(profile.null_profile(zones, zones_name)),
        "pickup_hour_distribution": of_each(
            lambda df, name: profile.value_distribution(df, "pickup_hour", name)
        ),
        "pickup_day_distribution": profile.value_distribution(by_zone, "pickup_day", zoned),
        "numeric_summary": of_each(profile.numeric_summary),
        "log_histograms": of_each(profile.log_histogram),
        "sign_counts": of_each(profile.sign_counts),
        "joinability": profile.joinability(by_zone, zones, "pu_location_id", "location_id"),
        "top_pickup_zones": profile.top_keys(by_zone, zones),
        "schemas": of_each(
            lambda df, name: profile.schema_table(df).select(F.lit(name).alias("dataset"), "*")
        ),
        **{f"anomalies_{name}": profile.anomaly_samples(df, name) for name, df in datasets.items()},
        **{f"describe_{name}": profile.describe_table(df) for name, df in datasets.items()},
    }


def run_profile(
    datasets: dict[str, DataFrame], zones: DataFrame, folder: str, *, zoned: str, **report
) -> dict[str, str]:
    """Profile the datasets and write the tables, plans and metrics document."""
    return run_report("profile", profile_tables(datasets, zones, zoned=zoned), folder, **report)
