"""Change of trips, fares and totals per origin, destination and hour between two parts of the month."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbflow.functions import measures as M
from curbflow.functions.predicates import question_trips

KEYS = ["pu_location_id", "do_location_id", "pickup_hour"]

# Last day of the first half, and the trips a key needs in both halves.
SPLIT_DAY, MIN_TRIPS = 15, 30

DIRECTIONS = {"increase": (F.desc, "trips_h2"), "decrease": (F.asc, "trips_h1")}


def _change(before: str, before_n: str, after: str, after_n: str) -> Column:
    """Change of a mean in percent, from the sums and counts behind it.

    With one division the result is as exact as the sums; NULL unless the mean before is positive.
    """
    old = F.col(before) * F.col(after_n)
    new = F.col(after) * F.col(before_n)
    return F.when(F.col(before) > 0, F.try_divide((new - old) * 100, old))


def _mean(total: str, n: str, name: str) -> Column:
    return M.amount(F.try_divide(total, n), name)


def od_period_change(trips: DataFrame, split_day: int = SPLIT_DAY, min_trips: int = MIN_TRIPS) -> DataFrame:
    """Keys with at least ``min_trips`` trips in both halves, and how the second half differs.

    One scan and one shuffle: both halves are summed side by side per key, instead of being
    aggregated apart and joined.  A key without trips in one half has no change and is left out.
    """
    first = F.col("pickup_day") <= split_day
    sums = []
    for half, rows in (("h1", first), ("h2", ~first)):
        total = F.when(rows, F.col("total_amount"))
        sums += [
            F.count_if(rows).alias(f"trips_{half}"),
            M.exact_sum(F.when(rows, F.col("fare_amount"))).alias(f"fare_{half}"),
            M.exact_sum(total).alias(f"total_{half}"),
            F.count(total).alias(f"totals_{half}"),
        ]
    enough = max(1, min_trips)
    compared = (
        question_trips(trips, "od_change")
        .groupBy(*KEYS)
        .agg(*sums)
        .filter((F.col("trips_h1") >= enough) & (F.col("trips_h2") >= enough))
    )

    grown = F.try_divide((F.col("trips_h2") - F.col("trips_h1")) * 100, "trips_h1")
    # Result columns, in order.
    return compared.select(
        *KEYS,
        "trips_h1",
        "trips_h2",
        M.amount(grown, "trips_change_pct"),
        _mean("fare_h1", "trips_h1", "avg_fare_h1"),
        _mean("fare_h2", "trips_h2", "avg_fare_h2"),
        M.amount(_change("fare_h1", "trips_h1", "fare_h2", "trips_h2"), "fare_change_pct"),
        _mean("total_h1", "totals_h1", "avg_total_h1"),
        _mean("total_h2", "totals_h2", "avg_total_h2"),
        M.amount(_change("total_h1", "totals_h1", "total_h2", "totals_h2"), "total_amount_change_pct"),
    )


def rank_od_change(change: DataFrame, direction: str, k: int = 20) -> DataFrame:
    """The ``k`` keys whose trips grew most (``increase``) or shrank most (``decrease``)."""
    order, busiest = DIRECTIONS[direction]
    return change.orderBy(order("trips_change_pct"), F.desc(busiest), *KEYS).limit(k)
