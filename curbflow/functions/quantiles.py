"""Exact quantiles by counting, and approximate ones from sketches that merge in a tree.

A sketch per task and group (``percentile_approx``) has to be merged by one task per group.
``selected_quantiles`` counts rows per cell of close values instead, pass by pass, each pass in the cells that
hold a rank; no value is shuffled.  ``frequency_quantiles`` does the same for a table that is already counted by value.
``rank_points`` keep sketches as rows that merge a bounded number at a time, also from stored tables.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CELLS_PER_OCTAVE = 4096
# Equal parts into which the range of one such cell is cut.
PARTS_PER_CELL = 4096


def value_at(probability: float, value: str, cumulative: str, total: str) -> Column:
    """Aggregate: smallest value whose cumulative count reaches the probability."""
    reached = F.col(cumulative) >= F.col(total) * probability
    return F.min(F.when(reached, F.col(value)))


def with_cumulative(freq: DataFrame, keys: list[str], value: str, count: str) -> DataFrame:
    """Add ``cumulative`` and ``total`` counts per key to a frequency table ordered by value."""
    group = Window.partitionBy(*keys)
    upto = group.orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return freq.withColumns(
        {"cumulative": F.sum(count).over(upto), "total": F.sum(count).over(group)}
    )


def _cell(value: str) -> Column:
    """A number that never falls while the value rises, equal for values within about 0.02 %.

    Never NULL, so that a join on it asks for no filter of its own and the frequency table
    below both of its uses stays one shuffle.
    """
    magnitude = F.floor(F.log2(F.abs(value)) * CELLS_PER_OCTAVE).cast("double") + 1100 * CELLS_PER_OCTAVE
    return F.coalesce(F.signum(value) * magnitude, F.lit(0.0))


def frequency_quantiles(
    freq: DataFrame, keys: list[str], value: str, count: str, probabilities: dict[str, float]
) -> DataFrame:
    """One row per key with one exact quantile column per entry of ``probabilities``.

    For any number of distinct values: counts per cell of close values find the cell each
    quantile lies in, counts per equal part of that cell's own range find the part, and only the values of
    those few parts are put in order.  A narrow column, all of it in a handful of cells, is split by the second step.
    """
    wanted = F.array(
        *[
            F.struct(F.lit(name).alias("quantile"), F.lit(p).alias("p"))
            for name, p in probabilities.items()
        ]
    )
    celled = freq.withColumn("cell", _cell(value))
    targets = (
        _counted(celled, [*keys], "cell", value, count)
        .select("*", F.inline(wanted))
        .withColumn("rank", F.col("p") * F.col("total"))
    )
    inside = celled.join(_reached(targets, [*keys, "cell", "quantile"]), [*keys, "cell"])
    width = F.col("high") - F.col("low")
    part = F.when(width > 0, F.floor((F.col(value) - F.col("low")) / width * PARTS_PER_CELL)).otherwise(F.lit(0))
    inside = inside.select(*keys, "quantile", value, count, "rank", F.coalesce(part, F.lit(0)).alias("part"))
    group = [*keys, "quantile"]
    ranks = F.first("rank").alias("rank")
    parts = _reached(_counted(inside, group, "part", value, count, ranks), [*group, "part"])
    order = Window.partitionBy(*group).orderBy(value)
    found = (
        inside.drop("rank")
        .join(parts.drop("low", "high"), [*group, "part"])
        .withColumn("cumulative", F.sum(count).over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .filter(F.col("cumulative") >= F.col("rank"))
    )
    return found.groupBy(*keys).agg(
        *[F.min(F.when(F.col("quantile") == name, F.col(value))).alias(name) for name in probabilities]
    )


def _counted(rows: DataFrame, keys: list[str], cell: str, value: str, count: str, *more: Column) -> DataFrame:
    """Counts of each cell and of those before it, and its smallest and largest value."""
    ends = (F.min(value).alias("low"), F.max(value).alias("high"))
    cells = rows.groupBy(*keys, cell).agg(F.sum(count).alias("in_cell"), *ends, *more)
    cells = with_cumulative(cells, keys, cell, "in_cell")
    return cells.withColumn("before", F.col("cumulative") - F.col("in_cell"))


def _reached(cells: DataFrame, keys: list[str]) -> DataFrame:
    """The cells in which their rank lies, and the rank within the cell."""
    reached = (F.col("before") < F.col("rank")) & (F.col("rank") <= F.col("cumulative"))
    return cells.filter(reached).select(*keys, "low", "high", (F.col("rank") - F.col("before")).alias("rank"))


# Bits of a double that the first pass leaves out, and equal parts of a cell's own range in each later one: after two of them a
# part is narrower than the distance of neighbouring doubles, so it holds one value.
SELECT_DROPPED_BITS, SELECT_PARTS, SELECT_PASSES = 41, 1 << 22, 2


def select_cell(value: str) -> Column:
    """The value rounded to 12 significant bits, by adding and taking away a multiple of it: never falls while the value rises.

    Two multiplications' worth of work, no logarithm, and at most 2048 cells per power of two.  Values from 2**960 on, whose
    multiple would overflow, and infinities are cells of their own.
    """
    shifted = F.col(value) * (2.0**SELECT_DROPPED_BITS + 1)
    return F.when(F.abs(value) < 2.0**960, shifted - (shifted - F.col(value))).otherwise(F.col(value))


def selected_quantiles(
    rows: DataFrame, cells: DataFrame, keys: list[str], value: str, probabilities: dict[str, float], totals: dict[str, Column] | None = None
) -> DataFrame:
    """One row per key with one exact quantile column per entry of ``probabilities``, without a shuffle by value.

    ``cells`` counts the rows of each key by ``select_cell``: ``cell``, ``in_cell``, and the smallest and largest value as ``low``
    and ``high``.  ``totals`` are aggregates of the cells of each key that the result has as well, from the same pass.
    Each further pass reads the rows again and counts equal parts of the ranges that hold a rank.  Counting is combined in
    the tasks: what is shuffled is bounded by the number of cells, whatever the values, and a value held by a third of all rows is
    one row per task.  A pass is dropped at run time when those before have found all ranks (ranges of one value).

    NULL and NaN must be filtered out before.  One row per key and quantile is broadcast: keys are columns or hours, not ids.
    """
    totals = totals or {}
    wanted = F.array(*[F.struct(F.lit(name).alias("quantile"), F.lit(p).alias("p")) for name, p in probabilities.items()])
    counted = with_cumulative(cells, keys, "cell", "in_cell").withColumn("before", F.col("cumulative") - F.col("in_cell"))
    counted = counted.withColumns({name: total.over(Window.partitionBy(*keys)) for name, total in totals.items()})
    targets = counted.select("*", F.inline(wanted)).withColumn("rank", F.col("p") * F.col("total"))
    hits, rows = _reached(targets, [*keys, "quantile", "cell", *totals]), rows.withColumn("cell", select_cell(value))
    found = hits.filter("low = high")
    for left in reversed(range(SELECT_PASSES)):
        hits = _narrowed(rows, hits.filter("low < high"), keys, value, list(totals))
        found = found.unionByName(hits.filter("low = high") if left else hits)
    values = [F.min(F.when(F.col("quantile") == name, F.col("high"))).alias(name) for name in probabilities]
    return found.groupBy(*keys).agg(*values, *[F.first(name).alias(name) for name in totals])


def _narrowed(rows: DataFrame, hits: DataFrame, keys: list[str], value: str, totals: list[str]) -> DataFrame:
    """The part of each hit's range that holds its rank: one scan, one count per part."""
    group = [*keys, "quantile", "cell"]
    inside = rows.join(F.broadcast(hits), [*keys, "cell"]).filter(F.col(value).between(F.col("low"), F.col("high")))
    part = F.floor((F.col(value) - F.col("low")) / (F.col("high") - F.col("low")) * SELECT_PARTS)
    inside = inside.withColumns({"part": part, "one": F.lit(1)})
    carried = [F.first(name).alias(name) for name in ("rank", *totals)]
    return _reached(_counted(inside, group, "part", value, "one", *carried), [*group, *totals])


# Sketches that one task merges at most, and levels of such merges: enough for FANIN ** LEVELS tasks of a scan.
FANIN, MERGE_LEVELS = 32, 3
# Points of a sketch, and accuracy of those a task takes of its own rows, for each unit of the accuracy asked for.
POINTS, OWN_ACCURACY = 5, 10


def rank_points(rows: DataFrame, keys: list[str], value: str, accuracy: int) -> DataFrame:
    """Quantile sketches, one row per key: ``n`` and ``points``, the values at equal steps of rank.

    Quantiles read from it are off by at most ``1 / accuracy`` of the rows (plus one row).  Each task of the scan takes the points of its
    own rows; sketches then merge by salt, ``FANIN`` at a time, down to one per key, so no task merges the sketches of all
    others.  A level costs at most ``1 / (POINTS * accuracy)``.  The result can be stored and merged with others (``merge_points``).
    """
    salt = F.pmod(F.spark_partition_id(), F.lit(FANIN**MERGE_LEVELS)).alias("salt")
    own = F.percentile_approx(value, _steps(accuracy), OWN_ACCURACY * accuracy).alias("points")
    points = rows.filter(F.col(value).isNotNull()).groupBy(*keys, salt).agg(F.count(F.lit(1)).alias("n"), own)
    return _merged(points, keys)


def merge_points(points: DataFrame, keys: list[str]) -> DataFrame:
    """Stored sketches of one accuracy, of any number of days or tables, as one per key: a union, merged in the same tree.

    Each of the levels adds at most ``1 / (POINTS * accuracy)`` to the error of the sketches that go in.
    """
    numbered = F.row_number().over(Window.partitionBy(*keys).orderBy(F.xxhash64("points"), "n")) - 1
    return _merged(points.withColumn("salt", numbered), keys)


def point_quantiles(points: DataFrame, keys: list[str], probabilities: dict[str, float]) -> DataFrame:
    """One row per key with one quantile column per entry of ``probabilities``, read from sketches."""
    last = F.size("points") - 1
    place = {name: F.ceil(F.round(last * p, 6)).cast("int") for name, p in probabilities.items()}
    return points.select(*keys, *[F.get("points", at).alias(name) for name, at in place.items()])


def _steps(accuracy: int) -> Column:
    """Equal steps from 0 to 1 as one constant: a text, as an array of so many literals would slow every rule of the optimizer."""
    last = POINTS * accuracy
    return F.split(F.lit(",".join(f"{k / last:.12g}" for k in range(last + 1))), ",").cast("array<double>")


def _merged(points: DataFrame, keys: list[str]) -> DataFrame:
    schema = points.select(*keys, F.col("salt").cast("long").alias("salt"), "n", F.col("points").cast("array<double>").alias("points")).schema

    def merge(table: pa.Table) -> pa.Table:
        sizes = table.column("n").to_numpy()
        values = np.stack(table.column("points").to_numpy())
        last, total = values.shape[1] - 1, int(sizes.sum())
        # A point stands for the ranks up to it from the one before; the first is the smallest value only.
        every, weight = values[:, 1:].ravel(), np.repeat(sizes, last)
        order = np.argsort(every, kind="stable")
        upto = np.cumsum(weight[order])
        # Whole numbers throughout: step k wants k * total of last * total.
        taken = every[order][np.searchsorted(upto, np.arange(1, last + 1) * total)]
        row = {"n": pa.array([total], pa.int64()), "points": pa.array([np.concatenate([[values[:, 0].min()], taken])], pa.list_(pa.float64()))}
        return pa.table({name: row.get(name, table.column(name).slice(0, 1)) for name in schema.names})

    for _ in range(MERGE_LEVELS):
        near = points.withColumn("salt", F.floor(F.col("salt") / FANIN).cast("long")).withColumn("points", F.col("points").cast("array<double>"))
        points = near.select(*schema.names).groupBy(*keys, "salt").applyInArrow(merge, schema)
    return points.drop("salt")


def rank_errors(
    freq: DataFrame, estimates: DataFrame, keys: list[str], value: str, count: str, probabilities: dict[str, float]
) -> DataFrame:
    """How far each estimated quantile is from its rank, as a share of the key's ``total`` count; 0 if exact.

    ``estimates`` has one row per key and one column per entry of ``probabilities``.
    """
    joined = freq.join(estimates, keys)
    below = [F.sum(F.when(F.col(value) < F.col(q), F.col(count)).otherwise(0)).alias(f"below_{q}") for q in probabilities]
    upto = [F.sum(F.when(F.col(value) <= F.col(q), F.col(count)).otherwise(0)).alias(f"upto_{q}") for q in probabilities]
    ranked = joined.groupBy(*keys).agg(F.sum(count).alias("total"), *below, *upto)
    errors = []
    for q, p in probabilities.items():
        rank = F.col("total") * p
        off = F.greatest(F.col(f"below_{q}") - rank, rank - F.col(f"upto_{q}"), F.lit(0.0))
        errors.append((off / F.col("total")).alias(q))
    return ranked.select(*keys, "total", *errors)
