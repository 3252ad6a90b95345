"""Named validity rules, and which of them each question applies."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbflow.functions import columns as C
from curbflow.params import TripWindow

RULES = {
    "pickup known": lambda: F.col("pickup_ts").isNotNull(),
    "dropoff known": lambda: F.col("dropoff_ts").isNotNull(),
    "ends after start": lambda: F.col("pickup_ts") <= F.col("dropoff_ts"),
    "takes time": lambda: F.col("duration_minutes") > 0,
    "covers distance": lambda: F.col("trip_distance") > 0,
    "has fare": lambda: F.col("fare_amount") > 0,
    "has total": lambda: F.col("total_amount") > 0,
    "card or cash": lambda: F.col("payment_type").isin(C.CARD, C.CASH),
    "inside city": C.in_city_box,
    "day and hour known": lambda: F.col("pickup_day").isNotNull() & F.col("pickup_hour").isNotNull(),
    "ends known": lambda: F.col("pu_location_id").isNotNull() & F.col("do_location_id").isNotNull(),
}

_TIMED = ("pickup known", "dropoff known", "ends after start", "takes time")
_MOVING = (*_TIMED, "covers distance")

# The questions clean their input differently; the differences are part of their results.
VALIDITY = {
    "demand": (*_MOVING, "has total"),
    "speed": (*_MOVING, "inside city"),
    "revenue": (*_MOVING, "has fare", "has total"),
    "payments": (*_MOVING, "has fare", "has total", "card or cash"),
    "flows": (*_MOVING, "has total"),
    "imbalance": ("pickup known", "takes time", "has total"),
    "od_change": ("takes time", "covers distance", "has fare", "day and hour known", "ends known"),
}


def valid(question: str) -> Column:
    return reduce(and_, (RULES[name]() for name in VALIDITY[question]))


def in_window(window: TripWindow, days=True) -> Column:
    hours = F.col("pickup_hour").isin(*window.hours)
    return F.col("pickup_day").isin(*window.days) & hours if days else hours


def in_year(year: int) -> Column:
    """A half-open range, which the scan can use; NULL for a NULL timestamp."""
    first, end = (F.expr(f"TIMESTAMP '{y:04d}-01-01 00:00:00'") for y in (year, year + 1))
    return (F.col("pickup_ts") >= first) & (F.col("pickup_ts") < end)


def question_rule(question: str, window: TripWindow | None = None, *, days=True, year=None) -> Column:
    """What a trip with derived columns must meet for a question to look at it."""
    keep = valid(question)
    if window is not None:
        keep = in_window(window, days) & keep
    if year is not None:
        keep = keep & in_year(year)
    return keep


def question_trips(
    trips: DataFrame, question: str, window: TripWindow | None = None, *, days=True, year=None
) -> DataFrame:
    """The trips a question looks at: derived columns added where absent, then one combined filter."""
    return C.with_derived(trips).filter(question_rule(question, window, days=days, year=year))
