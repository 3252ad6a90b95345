"""Matrix forms of result tables.

Columns are named up front, so no job is run to find them; whatever is not named, NULL included, is in the column
``other``, so that no row of the input is lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbflow.functions import measures as M


def _spread(key: str, names: list, value: str, aggregate) -> list[tuple[str, Column]]:
    """The aggregate of ``value`` for each name of ``key``, and for all others together."""
    if "other" in map(str, names):
        raise ValueError("a listed value named 'other' would clash with the column of all others")
    listed = F.coalesce(F.col(key).isin(list(names)), F.lit(False))
    columns = [(str(name), aggregate(F.when(F.col(key) == name, F.col(value)))) for name in names]
    return [*columns, ("other", aggregate(F.when(~listed, F.col(value))))]


def null_matrix(nulls: DataFrame, datasets: list[str]) -> DataFrame:
    """Mean NULL percentage per column (rows) and dataset (columns), 0 for columns a dataset lacks."""
    columns = _spread("dataset", datasets, "null_percentage", F.avg)
    wide = nulls.groupBy("column_name").agg(*[value.alias(name) for name, value in columns])
    return wide.fillna(0.0).orderBy("column_name")


def flow_matrix(flows: DataFrame, boroughs: list[str]) -> DataFrame:
    """Trips per pickup borough (rows) and dropoff borough (columns), 0 where there are none."""
    columns = _spread("do_borough", boroughs, "trips", F.sum)
    wide = flows.groupBy("pu_borough").agg(*[value.alias(name) for name, value in columns])
    return wide.fillna(0, subset=[name for name, _ in columns]).orderBy("pu_borough")


def imbalance_matrix(imbalance: DataFrame, hours, n: int = 20) -> DataFrame:
    """Mean imbalance ratio of the ``n`` most one-sided zones (rows) per hour (columns ``h0`` …)."""
    zones = (
        imbalance.groupBy("zone")
        .agg(F.avg(F.abs("imbalance_ratio")).alias("one_sided"))
        .filter(F.col("one_sided").isNotNull())
        .orderBy(F.round("one_sided", 10).desc(), "zone")
        .limit(n)
    )
    columns = _spread("hour", list(hours), "imbalance_ratio", lambda ratio: M.exact_mean(ratio, M.SHARE_DIGITS))
    named = [M.share(value, name if name == "other" else f"h{name}") for name, value in columns]
    return imbalance.join(zones, "zone", "left_semi").groupBy("zone").agg(*named).orderBy("zone")
