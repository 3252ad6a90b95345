"""Question, profiling and ingest operators: one function per result table."""

from curbflow.operators.demand import (
    demand_by_band,
    demand_by_hour,
    demand_events_hourly,
    demand_top_hours,
)
from curbflow.operators.flows import (
    airport_routes,
    airport_zones,
    borough_flow_table,
    borough_flows,
    flow_groups,
    with_endpoints,
)
from curbflow.operators.imbalance import imbalance_by_hour, rank_imbalance, zone_activity, zone_imbalance
from curbflow.operators.ingest import ingest_quality, ingest_trips, ingest_zones
from curbflow.operators.od_change import od_period_change, rank_od_change
from curbflow.operators.payments import card_vs_cash, payment_mix_by_hour, payment_mix_by_vendor
from curbflow.operators.profile import (
    anomaly_samples,
    densify_histogram,
    describe_table,
    joinability,
    log_histogram,
    null_profile,
    numeric_summary,
    quartile_errors,
    schema_table,
    sign_counts,
    top_keys,
    value_distribution,
)
from curbflow.operators.reshape import flow_matrix, imbalance_matrix, null_matrix
from curbflow.operators.revenue import rank_zone_revenue, zone_revenue
from curbflow.operators.speed import extreme_trips, speed_by_hour, with_trip_geometry

__all__ = [
    "airport_routes",
    "airport_zones",
    "anomaly_samples",
    "borough_flow_table",
    "borough_flows",
    "card_vs_cash",
    "demand_by_band",
    "demand_by_hour",
    "demand_events_hourly",
    "demand_top_hours",
    "densify_histogram",
    "describe_table",
    "extreme_trips",
    "flow_matrix",
    "imbalance_by_hour",
    "imbalance_matrix",
    "ingest_quality",
    "ingest_trips",
    "ingest_zones",
    "joinability",
    "log_histogram",
    "null_matrix",
    "null_profile",
    "numeric_summary",
    "quartile_errors",
    "od_period_change",
    "payment_mix_by_hour",
    "payment_mix_by_vendor",
    "rank_imbalance",
    "rank_od_change",
    "rank_zone_revenue",
    "schema_table",
    "sign_counts",
    "speed_by_hour",
    "top_keys",
    "value_distribution",
    "flow_groups",
    "with_endpoints",
    "with_trip_geometry",
    "zone_activity",
    "zone_imbalance",
    "zone_revenue",
]
