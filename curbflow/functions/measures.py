"""Aggregate expressions shared by the questions."""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from curbflow.functions import columns as C

# Decimals kept for amounts and averages, and for shares and ratios.
AMOUNT_DIGITS = 4
SHARE_DIGITS = 6

# Digits that sums keep of speeds, distances and other derived values, and of ratios: two beyond what is shown.
DERIVED_DIGITS = 6
RATIO_DIGITS = 8


def amount(value, name: str) -> Column:
    """Rounded amount or average."""
    return F.round(value, AMOUNT_DIGITS).alias(name)


def share(value, name: str) -> Column:
    """Rounded share or ratio."""
    return F.round(value, SHARE_DIGITS).alias(name)


def _in_range(column: Column, digits: int) -> Column:
    """Whether a value at the scale takes at most 17 digits, so that many fit in the sum; NaN and infinities do not."""
    return F.abs(column) < float(10 ** (17 - digits))


def scaled(value, digits: int = AMOUNT_DIGITS) -> Column:
    """A value as a whole number of units of the scale, rounded half up: its sums do not depend on partition order.

    Whole numbers of 64 bits add up without objects, unlike decimals; a sum that leaves their range is an error under
    Spark's default ANSI mode, never a wrong number.  Values with more digits need a larger scale; values beyond
    ten to the power of 17 - digits and what is not finite become NULL.
    """
    column = F.col(value) if isinstance(value, str) else value
    return F.when(_in_range(column, digits), F.floor(column * float(10**digits) + 0.5))


def unscaled(total, digits: int = AMOUNT_DIGITS) -> Column:
    """A sum of scaled values as a double: one division, after all adding."""
    total = F.col(total) if isinstance(total, str) else total
    return total.cast("double") / float(10**digits)


def exact_sum(value, digits: int = AMOUNT_DIGITS) -> Column:
    """Sum of an amount, added up exactly and then turned into a double once."""
    return unscaled(F.sum(scaled(value, digits)), digits)


def exact_mean(value, digits: int = AMOUNT_DIGITS) -> Column:
    """Mean of an amount, from its exact sum."""
    return F.try_divide(exact_sum(value, digits), F.count(scaled(value, digits)))


def mean_parts(value: str, digits: int) -> tuple[Column, Column]:
    """Aggregates for a mean that add up over levels: the exact sum of values in range, and that of the others as a double."""
    return (
        F.sum(scaled(value, digits)).alias("near"),
        F.sum(F.when(~_in_range(F.col(value), digits), F.col(value))).alias("far"),
    )


def mean_of_parts(count: str, digits: int) -> Column:
    """The mean, from a count and ``mean_parts``."""
    zero = F.lit(0.0)
    return F.try_divide(F.coalesce(unscaled("near", digits), zero) + F.coalesce("far", zero), F.col(count))


def trips() -> Column:
    return F.count(F.lit(1)).alias("trips")


def mean_minutes(minutes="duration_minutes") -> Column:
    """Average duration from an exact sum of whole seconds."""
    return F.try_divide(F.sum(C.whole_seconds(minutes)), F.lit(60.0) * F.count(minutes))


def exact_mean_where(condition: Column, value, digits: int = AMOUNT_DIGITS) -> Column:
    return exact_mean(F.when(condition, value), digits)


def share_where(condition: Column) -> Column:
    """Share of rows that meet a condition; rows where it is NULL do not meet it."""
    return F.avg(F.when(condition, 1.0).otherwise(0.0))


def total_ratio(numerator, denominator) -> Column:
    """Ratio of two sums, NULL when the lower one is zero."""
    return F.try_divide(F.sum(numerator).cast("double"), F.sum(denominator).cast("double"))


def whole(count: str, *within: str) -> Column:
    """Grouped counts added up over their partition, or over all groups.

    Meant for already grouped rows: the window sees one row per group, never one per trip.
    """
    return F.sum(count).over(Window.partitionBy(*within))


def part_of_whole(count: str, *within: str) -> Column:
    """Share of a grouped count in its partition, or in all groups."""
    return F.try_divide(F.col(count), whole(count, *within))


def as_exact(value: str, digits: int | None) -> Column:
    """The amount itself, or as a decimal so that its sums do not depend on partition order."""
    return F.col(value) if digits is None else F.col(value).cast(f"decimal(18,{digits})")
