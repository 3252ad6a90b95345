"""How a question joins a dimension table."""

from __future__ import annotations

from pyspark.sql import DataFrame


def dimension(dim: DataFrame, strategy: str = "auto") -> DataFrame:
    """``auto`` leaves the choice to Spark, which broadcasts only below its size threshold
    (checked against statistics, and again at run time by adaptive execution) and otherwise
    shuffles with skewed partitions split.  ``merge`` asks for the sort-merge join."""
    if strategy == "auto":
        return dim
    if strategy == "merge":
        return dim.hint("merge")
    raise ValueError(f"unknown join strategy {strategy!r}")
