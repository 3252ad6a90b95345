"""Ingest: raw all-text rows to typed trips and zones, and the quality of what came in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbflow.contracts import ZONE_FIELDS, TripSpec
from curbflow.functions.columns import with_derived
from curbflow.functions.predicates import in_year

SPEC_YEAR = "spec"


def parsed_time(column: str, pattern: str) -> Column:
    """Text of the expected shape as a timestamp, NULL for other shapes and impossible times.

    A pattern and a cast cost a fraction of a formatter, which throws inside for each text
    that does not fit.  The text is named once: a filter on the time moves below the projection
    that makes the text, and makes it anew for every place that names it.
    """
    return F.regexp_extract(F.col(column), pattern, 0).try_cast("timestamp")


def _parsed(raw_name: str, name: str, kind: str, time_pattern: str) -> Column:
    """Text to type, with NULL for text that does not fit; whole numbers may come as ``1.0``."""
    text = F.col(f"`{raw_name}`")
    if kind == "timestamp":
        value = parsed_time(raw_name, time_pattern)
    elif kind == "int":
        value = text.try_cast("double").try_cast("int")
    elif kind == "string":
        value = text
    else:
        value = text.try_cast(kind)
    return value.alias(name)


def _finite(value: Column, kind: str) -> Column:
    """NULL for infinity and NaN: one of them would spoil every sum it is in."""
    return F.when(F.abs(value) < float("inf"), value) if kind in ("double", "float") else value


def _typed(raw_name: str, name: str, kind: str, time_pattern: str) -> Column:
    """Text to type as ``_parsed`` has it; texts that read as infinity or NaN do not fit either."""
    return _finite(_parsed(raw_name, name, kind, time_pattern), kind).alias(name)


def ingest_trips(raw: DataFrame, spec: TripSpec, year: int | str | None = SPEC_YEAR) -> DataFrame:
    """Typed trips with derived columns, kept only when picked up in the year.

    ``year`` is that of the spec unless another is given; ``None`` keeps every row.
    """
    parsed = raw.select(*[_parsed(*field, spec.time_pattern) for field in spec.fields])
    # Tested in a step of its own, so that no text is parsed again for the test: with the doubled code a method came
    # to more than 8,000 bytes, which the JVM interprets instead of compiling.
    typed = parsed.select(*[_finite(F.col(name), kind).alias(name) for _, name, kind in spec.fields])
    wanted = spec.year if year == SPEC_YEAR else year
    # Not a range, which names the time twice: no scan can use one on parsed text.
    kept = typed if wanted is None else typed.filter(F.year("pickup_ts") == wanted)
    return with_derived(kept)


def ingest_zones(raw: DataFrame) -> DataFrame:
    """Typed zone lookup."""
    return raw.select(*[_typed(*field, "") for field in ZONE_FIELDS])


def ingest_quality(raw: DataFrame, spec: TripSpec, year: int | str | None = SPEC_YEAR) -> DataFrame:
    """Raw rows, unreadable and wrong-year pickups, first and last pickup: one pass, one row.

    ``year`` is that of the spec unless another is given; with ``None`` no year is wrong.

    A pass of its own rather than counters hung on the write job: counters of a retried
    task may count twice, an aggregate may not.
    """
    pickup = next(raw_name for raw_name, name, _ in spec.fields if name == "pickup_ts")
    times = raw.select(parsed_time(pickup, spec.time_pattern).alias("pickup_ts"))
    expected = spec.year if year == SPEC_YEAR else year
    wrong_year = F.lit(False) if expected is None else ~in_year(expected)
    return times.agg(
        F.count(F.lit(1)).alias("raw_row_count"),
        F.count_if(F.col("pickup_ts").isNull()).alias("bad_or_null_pickup_ts_count"),
        F.count_if(wrong_year).alias("wrong_year_rejected_count"),
        F.min("pickup_ts").alias("min_pickup_ts"),
        F.max("pickup_ts").alias("max_pickup_ts"),
    )
