"""The registered queries: every operator over the star-schema test tables."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbflow.contracts import TRIPS_GEO, TRIPS_ZONED, ZONE_FIELDS
from curbflow.functions import columns as C
from curbflow.functions import labels
from curbflow.functions.quantiles import rank_errors
from curbflow.functions.udf import haversine_udf
from curbflow.operators import demand, flows, imbalance, ingest, od_change, payments, profile, reshape, revenue, speed
from curbflow.params import TripWindow
from curbflow.plans.sql import QUERIES, question_sql, register_views
from curbflow.sources.starschema import raw_trips_like, table, trips_like, zones_like

WINDOW = TripWindow()
YEAR = 1998
# Of quantile sketches, whose ranks are off by at most this part of all rows.
ACCURACY = 10_000
# The published thresholds are meant for millions of trips.
ACTIVITY, MIN_TRIPS = 15, 2
AIRPORT = "nation_(3|11)$"
AIRPORT_ZONE = "nation_20"
BOROUGHS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST", "Unknown"]


def _airport_rule() -> dict:
    return {"airport_pattern": AIRPORT, "airport_special": F.lower("zone") == AIRPORT_ZONE}


def _on_trips(operator, *args, **kwargs):
    return lambda spark, folder: operator(trips_like(spark, folder), *args, **kwargs)


def _on_both(operator, *args, **kwargs):
    return lambda spark, folder: operator(
        trips_like(spark, folder), zones_like(spark, folder), *args, **kwargs
    )


def _geometry(spark, folder, **kwargs) -> DataFrame:
    return speed.with_trip_geometry(trips_like(spark, folder), WINDOW, **kwargs)


def _rounded_extremes(trips: DataFrame) -> DataFrame:
    """Trigonometry differs in the last digits between engines."""
    names = ("duration_per_km", "speed_kmh", "haversine_km", "distance_gap_km", "detour_ratio")
    return trips.withColumns({name: F.round(name, 6) for name in names})


def _extremes(kind):
    return lambda spark, folder: _rounded_extremes(speed.extreme_trips(_geometry(spark, folder), kind))


def _haversine(distance):
    coordinates = ["pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude"]

    def query(spark, folder):
        km = distance("pickup_latitude", "pickup_longitude", "dropoff_latitude", "dropoff_longitude")
        return trips_like(spark, folder).select(
            "vendor_id", "pickup_ts", *coordinates, F.round(km, 6).alias("haversine_km")
        )

    return query


def _ends(spark, folder, **kwargs) -> DataFrame:
    return flows.with_endpoints(
        trips_like(spark, folder), zones_like(spark, folder), WINDOW, **_airport_rule(), **kwargs
    )


def _flow_groups(spark, folder, **kwargs) -> DataFrame:
    return flows.flow_groups(
        trips_like(spark, folder), zones_like(spark, folder), WINDOW, **_airport_rule(), **kwargs
    )


def _geometry_rows(spark, folder) -> DataFrame:
    geometry = _geometry(spark, folder).select(
        *speed.EXTREME_COLUMNS, F.round("haversine_mi", 6).alias("haversine_mi"), "congestion_candidate"
    )
    return _rounded_extremes(geometry)


def _endpoint_rows(spark, folder) -> DataFrame:
    return _ends(spark, folder).select(
        "pickup_ts",
        "dropoff_ts",
        "trip_distance",
        *[f"{side}_{name}" for side in ("pu", "do") for name in ("location_id", *flows.NAMES, "is_airport")],
        "airport_trip",
    )


def _revenue(spark, folder) -> DataFrame:
    return revenue.zone_revenue(trips_like(spark, folder), zones_like(spark, folder), WINDOW)


def _imbalance(spark, folder) -> DataFrame:
    return imbalance.zone_imbalance(
        trips_like(spark, folder), zones_like(spark, folder), WINDOW, threshold=ACTIVITY
    )


def _od_change(spark, folder) -> DataFrame:
    return od_change.od_period_change(trips_like(spark, folder), min_trips=MIN_TRIPS)


def _null_profile(spark, folder) -> DataFrame:
    """One tagged profile per dataset, put together by column name."""
    return (
        profile.null_profile(trips_like(spark, folder), "trips")
        .unionByName(profile.null_profile(zones_like(spark, folder), "zones"))
        .unionByName(profile.null_profile(table(spark, folder, "events"), "events"))
    )


def _hour_distribution(spark, folder) -> DataFrame:
    events = table(spark, folder, "events").select(F.hour("ts").alias("pickup_hour"))
    return profile.value_distribution(trips_like(spark, folder), "pickup_hour", "trips").unionByName(
        profile.value_distribution(events, "pickup_hour", "events")
    )


def _day_distribution_dense(days):
    def query(spark, folder):
        events = table(spark, folder, "events").select(F.dayofmonth("ts").alias("pickup_day"))
        return profile.value_distribution(events, "pickup_day", "events", densify=days)

    return query


def _numeric_summary(spark, folder) -> DataFrame:
    return profile.numeric_summary(trips_like(spark, folder), "trips").withColumn("avg", F.round("avg", 6))


def _within(names) -> dict:
    """Whether the ranks keep what the sketch promises, up to one row."""
    return {name: F.col(name) <= 1 / ACCURACY + 1 / F.col("total") for name in names}


def _numeric_summary_approx(spark, folder) -> DataFrame:
    """Approximate quartiles are stated as kept promises: their values may differ from run to run."""
    trips = trips_like(spark, folder)
    summary = profile.numeric_summary(trips, "trips", accuracy=ACCURACY)
    kept = profile.quartile_errors(trips, summary).withColumns(_within(profile.QUARTILES)).drop("total")
    exact = summary.drop(*profile.QUARTILES).withColumn("avg", F.round("avg", 6))
    return exact.join(kept, "column_name")


def _speed_by_hour_approx(spark, folder) -> DataFrame:
    quantiles = {"median_duration_minutes": 0.5, "p90_duration_minutes": 0.9}
    geometry = _geometry(spark, folder)
    answer = speed.speed_by_hour(geometry, accuracy=ACCURACY)
    minutes = F.round("duration_minutes", 4).alias("minutes")
    freq = geometry.groupBy("pickup_hour", minutes).agg(F.count(F.lit(1)).alias("n"))
    errors = rank_errors(freq, answer.select("pickup_hour", *quantiles), ["pickup_hour"], "minutes", "n", quantiles)
    return answer.drop(*quantiles).join(errors.withColumns(_within(quantiles)).drop("total"), "pickup_hour")


def _log_histogram(spark, folder) -> DataFrame:
    prices = profile.log_histogram(table(spark, folder, "lineitem"), "lineitem", ["l_extendedprice"])
    return profile.log_histogram(trips_like(spark, folder), "trips").unionByName(prices)


def _log_histogram_dense(spark, folder) -> DataFrame:
    orders = table(spark, folder, "orders").select(F.col("o_totalprice").alias("total_amount"))
    both = profile.log_histogram(trips_like(spark, folder), "trips", ["total_amount"]).unionByName(
        profile.log_histogram(orders, "orders", ["total_amount"])
    )
    return profile.densify_histogram(both, ["trips", "orders"])


def _describe(make):
    """Numeric columns rounded: sums differ in the last digits between engines."""

    def query(spark, folder):
        df = make(spark, folder)
        described = profile.describe_table(df)
        numbers = [n for n in described.columns[1:] if df.schema[n].dataType.simpleString() != "string"]
        return described.withColumns({n: F.round(F.col(n).cast("double"), 6) for n in numbers})

    return query


def _ingest_quality(spark, folder) -> DataFrame:
    return ingest.ingest_quality(raw_trips_like(spark, folder), TRIPS_ZONED, year=YEAR)


def _ingest_trips(spec, geo):
    spec = replace(spec, year=YEAR)
    return lambda spark, folder: ingest.ingest_trips(raw_trips_like(spark, folder, geo=geo), spec)


def _ingest_zones(spark, folder) -> DataFrame:
    zones = zones_like(spark, folder)
    raw = zones.select(*[F.col(name).cast("string").alias(raw) for raw, name, _ in ZONE_FIELDS])
    return ingest.ingest_zones(raw)


def _display_labels(spark, folder) -> DataFrame:
    trips, zones = trips_like(spark, folder), zones_like(spark, folder)

    def labelled(kind, rows, label):
        return rows.select(F.lit(kind).alias("kind"), label.alias("label"), "trips")

    counts = trips.groupBy("pu_location_id", "pickup_hour").agg(F.count(F.lit(1)).alias("trips"))
    named = counts.join(zones, F.col("pu_location_id") == F.col("location_id"), "left")
    per_zone = named.groupBy("pu_location_id", "zone", "borough").agg(F.sum("trips").alias("trips"))
    hours = named.groupBy("zone", F.col("pickup_hour").alias("hour")).agg(F.sum("trips").alias("trips"))
    return (
        labelled("flow", flows.borough_flow_table(_flow_groups(spark, folder)), labels.flow_label())
        .unionByName(labelled("revenue", _revenue(spark, folder), labels.zone_bucket_label()))
        .unionByName(labelled("zone", per_zone, labels.zone_label()))
        .unionByName(labelled("zone_hour", hours, labels.zone_hour_label()))
    )


def _by_sql(name):
    def query(spark, folder):
        register_views(trips_like(spark, folder), zones_like(spark, folder))
        answer = question_sql(
            spark,
            name,
            WINDOW,
            threshold=ACTIVITY,
            airport_pattern=AIRPORT,
            airport_borough="",
            airport_zone=AIRPORT_ZONE,
        )
        return _rounded_extremes(answer) if name in ("slowest_trips", "fastest_trips") else answer

    return query


def registered() -> dict:
    """Query name to ``(spark, folder) -> DataFrame``."""
    return {
        "demand_top_hours": _on_trips(demand.demand_top_hours, WINDOW),
        "demand_by_hour": _on_trips(demand.demand_by_hour, WINDOW),
        "demand_by_band": _on_trips(demand.demand_by_band, WINDOW),
        "demand_events_hourly": lambda s, d: demand.demand_events_hourly(table(s, d, "events")),
        "speed_by_hour": lambda s, d: speed.speed_by_hour(_geometry(s, d)),
        "speed_by_hour_approx": _speed_by_hour_approx,
        "speed_by_hour_any_detour": lambda s, d: speed.speed_by_hour(_geometry(s, d, min_straight_km=0.0)),
        "speed_by_hour_udf": lambda s, d: speed.speed_by_hour(_geometry(s, d, distance=haversine_udf)),
        "with_trip_geometry": _geometry_rows,
        "slowest_trips": _extremes("slowest"),
        "fastest_trips": _extremes("fastest"),
        "haversine_native": _haversine(C.haversine_km),
        "haversine_udf": _haversine(haversine_udf),
        "zone_revenue": _revenue,
        **{
            f"top_{metric}": lambda s, d, m=metric: revenue.rank_zone_revenue(_revenue(s, d), m, WINDOW.top_k)
            for metric in revenue.METRICS
        },
        "payment_mix_by_hour": _on_trips(payments.payment_mix_by_hour, WINDOW),
        "payment_mix_by_vendor": _on_trips(payments.payment_mix_by_vendor, WINDOW),
        "card_vs_cash": _on_trips(payments.card_vs_cash, WINDOW),
        "with_endpoints": _endpoint_rows,
        "borough_flows": lambda s, d: flows.borough_flows(_flow_groups(s, d), WINDOW.top_k),
        "borough_flows_merge_join": lambda s, d: flows.borough_flows(
            _flow_groups(s, d, strategy="merge"), WINDOW.top_k
        ),
        "airport_routes": lambda s, d: flows.airport_routes(_flow_groups(s, d), WINDOW.top_k),
        "airport_zones": lambda s, d: flows.airport_zones(zones_like(s, d), **_airport_rule()),
        "zone_imbalance": _imbalance,
        "imbalance_top_positive": lambda s, d: imbalance.rank_imbalance(_imbalance(s, d), "positive"),
        "imbalance_top_negative": lambda s, d: imbalance.rank_imbalance(_imbalance(s, d), "negative"),
        "imbalance_top_abs": lambda s, d: imbalance.rank_imbalance(_imbalance(s, d), "absolute"),
        "imbalance_by_hour": lambda s, d: imbalance.imbalance_by_hour(_imbalance(s, d)),
        "od_change": _od_change,
        "od_top_increase": lambda s, d: od_change.rank_od_change(_od_change(s, d), "increase"),
        "od_top_decrease": lambda s, d: od_change.rank_od_change(_od_change(s, d), "decrease"),
        "null_profile": _null_profile,
        "hour_distribution": _hour_distribution,
        "day_distribution": _on_trips(profile.value_distribution, "pickup_day", "trips"),
        "day_distribution_dense": _day_distribution_dense(range(1, 32)),
        "day_distribution_dense_from_20": _day_distribution_dense(range(20, 40)),
        "numeric_summary": _numeric_summary,
        "numeric_summary_approx": _numeric_summary_approx,
        "log_histogram": _log_histogram,
        "log_histogram_dense": _log_histogram_dense,
        "sign_counts": _on_trips(profile.sign_counts, "trips"),
        "joinability": _on_both(profile.joinability, "pu_location_id", "location_id"),
        "top_keys": _on_both(profile.top_keys),
        "anomaly_samples": _on_trips(profile.anomaly_samples, "trips"),
        "describe_table": _describe(trips_like),
        "describe_events": _describe(lambda s, d: table(s, d, "events")),
        "schema_table": lambda s, d: profile.schema_table(table(s, d, "events")),
        "ingest_quality": _ingest_quality,
        "ingest_trips_zoned": _ingest_trips(TRIPS_ZONED, geo=False),
        "ingest_trips_geo": _ingest_trips(TRIPS_GEO, geo=True),
        "ingest_zones": _ingest_zones,
        "flow_matrix": lambda s, d: reshape.flow_matrix(flows.borough_flow_table(_flow_groups(s, d)), BOROUGHS),
        # Lists that leave values out: those are in the column `other`.
        "flow_matrix_other": lambda s, d: reshape.flow_matrix(flows.borough_flow_table(_flow_groups(s, d)), BOROUGHS[1:3]),
        "imbalance_matrix_other": lambda s, d: reshape.imbalance_matrix(_imbalance(s, d), WINDOW.hours[:2]),
        "null_matrix_other": lambda s, d: reshape.null_matrix(_null_profile(s, d), ["zones"]),
        "imbalance_matrix": lambda s, d: reshape.imbalance_matrix(_imbalance(s, d), WINDOW.hours),
        "null_matrix": lambda s, d: reshape.null_matrix(_null_profile(s, d), ["trips", "zones", "events"]),
        "display_labels": _display_labels,
        **{f"sql_{name}": _by_sql(name) for name in QUERIES},
    }
