"""Payments: card and cash mix and tipping, per hour and per vendor."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbflow.functions import columns as C
from curbflow.functions import measures as M
from curbflow.functions.predicates import question_trips
from curbflow.params import TripWindow


def _tip_rate():
    return F.try_divide("tip_amount", "fare_amount")


def _mix(trips: DataFrame, window: TripWindow, key: str, share_name: str, *extra) -> DataFrame:
    """Payment mix within each ``key``; the share is a window over the few grouped rows."""
    grouped = (
        question_trips(trips, "payments", window)
        .groupBy(key, "payment_type")
        .agg(
            M.trips(),
            M.amount(M.exact_mean("fare_amount"), "avg_fare_amount"),
            M.amount(M.exact_mean("total_amount"), "avg_total_amount"),
            M.amount(M.exact_mean("tip_amount"), "avg_tip_amount"),
            M.share(M.exact_mean(_tip_rate(), M.RATIO_DIGITS), "tip_rate"),
            M.share(M.share_where(F.col("tip_amount") == 0), "zero_tip_share"),
            *extra,
        )
    )
    return grouped.withColumns(
        {
            "payment_label": C.payment_label(),
            share_name: M.share(M.part_of_whole("trips", key), share_name),
        }
    )


def payment_mix_by_hour(trips: DataFrame, window: TripWindow = TripWindow()) -> DataFrame:
    """Card and cash trips of each pickup hour: shares, averages, tip rate and untipped share."""
    mix = _mix(
        trips,
        window,
        "pickup_hour",
        "payment_share_in_hour",
        M.amount(M.exact_mean("trip_distance"), "avg_trip_distance"),
        M.amount(M.mean_minutes(), "avg_duration_minutes"),
    )
    # Result columns, in order.
    return mix.select(
        "pickup_hour",
        "payment_type",
        "payment_label",
        "trips",
        "payment_share_in_hour",
        "avg_fare_amount",
        "avg_total_amount",
        "avg_tip_amount",
        "tip_rate",
        "zero_tip_share",
        "avg_trip_distance",
        "avg_duration_minutes",
    ).orderBy("pickup_hour", "payment_type")


def payment_mix_by_vendor(trips: DataFrame, window: TripWindow = TripWindow()) -> DataFrame:
    """Card and cash trips of each vendor."""
    return (
        _mix(trips, window, "vendor_id", "payment_share_in_vendor")
        # Result columns, in order.
        .select(
            "vendor_id",
            "payment_type",
            "payment_label",
            "trips",
            "payment_share_in_vendor",
            "avg_total_amount",
            "avg_fare_amount",
            "avg_tip_amount",
            "tip_rate",
            "zero_tip_share",
        )
        .orderBy("vendor_id", "payment_type")
    )


def card_vs_cash(trips: DataFrame, window: TripWindow = TripWindow()) -> DataFrame:
    """Card against cash side by side, one row per pickup hour."""
    card, cash = F.col("payment_type") == C.CARD, F.col("payment_type") == C.CASH
    return (
        question_trips(trips, "payments", window)
        .groupBy("pickup_hour")
        .agg(
            F.count_if(card).alias("card_trips"),
            F.count_if(cash).alias("cash_trips"),
            M.share(F.count_if(card) / F.count(F.lit(1)), "card_share"),
            M.amount(M.exact_mean_where(card, F.col("total_amount")), "avg_total_card"),
            M.amount(M.exact_mean_where(cash, F.col("total_amount")), "avg_total_cash"),
            M.amount(M.exact_mean_where(card, F.col("fare_amount")), "avg_fare_card"),
            M.amount(M.exact_mean_where(cash, F.col("fare_amount")), "avg_fare_cash"),
            M.share(M.exact_mean_where(card, _tip_rate(), M.RATIO_DIGITS), "avg_tip_rate_card"),
        )
        .orderBy("pickup_hour")
    )
