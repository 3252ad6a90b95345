"""Profiling: what a table holds and what is wrong with it.

Each profile is one pass over its table; several columns are profiled in the same pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curbflow.functions import columns as C
from curbflow.functions.joins import dimension
from curbflow.functions import measures as M
from curbflow.functions.quantiles import point_quantiles, rank_errors, rank_points, select_cell, selected_quantiles

# Columns profiled by default, and columns shown for a suspicious trip.
SUMMARY_COLUMNS = (
    "trip_distance",
    "trip_distance_km",
    "duration_minutes",
    "fare_amount",
    "tip_amount",
    "total_amount",
)
HISTOGRAM_COLUMNS = ("trip_distance", "total_amount")
SIGN_COLUMNS = ("trip_distance", "fare_amount", "total_amount")
RECORD_COLUMNS = (
    "vendor_id",
    "pickup_ts",
    "dropoff_ts",
    "pickup_day",
    "pickup_hour",
    "trip_distance",
    "duration_minutes",
    "fare_amount",
    "tip_amount",
    "total_amount",
    "pickup_longitude",
    "pickup_latitude",
    "dropoff_longitude",
    "dropoff_latitude",
    "pu_location_id",
    "do_location_id",
)
QUARTILES = {"p25": 0.25, "median": 0.5, "p75": 0.75}


def _long(df: DataFrame, names: list[str]) -> DataFrame:
    """One row per input row and column: its ``position`` in ``names`` and its ``value`` as double.

    A number is a far cheaper grouping key than a name; ``_name`` turns it back.
    """
    pairs = [part for i, name in enumerate(names) for part in (F.lit(i), F.col(name).cast("double"))]
    return df.select(F.stack(F.lit(len(names)), *pairs).alias("position", "value"))


def _name(names: list[str]) -> Column:
    return F.array(*[F.lit(name) for name in names])[F.col("position")].alias("column_name")


def null_profile(df: DataFrame, dataset: str) -> DataFrame:
    """NULL count and percentage of every column, emptiest column first."""
    # Numbered, so that names with dots or quotes need no care.
    numbered = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    nulls = [
        F.struct(F.lit(name).alias("column_name"), F.count_if(F.col(f"c{i}").isNull()).alias("null_count"))
        for i, name in enumerate(df.columns)
    ]
    counted = numbered.agg(F.count(F.lit(1)).alias("rows"), F.array(*nulls).alias("columns"))
    percentage = F.coalesce(F.try_divide("null_count", "rows") * 100.0, F.lit(0.0))
    return (
        counted.select("rows", F.inline("columns"))
        .select(
            F.lit(dataset).alias("dataset"),
            "column_name",
            "null_count",
            percentage.alias("null_percentage"),
        )
        .orderBy(F.desc("null_percentage"), F.desc("null_count"), "column_name")
    )


def value_distribution(df: DataFrame, key: str, dataset: str, densify: range | None = None) -> DataFrame:
    """Rows per value of ``key``; ``densify`` adds the absent values of that range with 0.

    Values outside the range and NULL stay, so the counts always add up to the input.
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("trip_count"))
    if densify is not None:
        spine = df.sparkSession.range(densify.start, densify.stop, densify.step, 1)
        counts = spine.select(F.col("id").cast("int").alias(key)).join(counts, key, "full")
    return counts.select(
        F.lit(dataset).alias("dataset"), key, F.coalesce("trip_count", F.lit(0)).alias("trip_count")
    ).orderBy(key)


def numeric_summary(
    df: DataFrame, dataset: str, cols=SUMMARY_COLUMNS, accuracy: int | None = None, *, digits: int = M.DERIVED_DIGITS
) -> DataFrame:
    """Count, minimum, quartiles, maximum and mean of each column.

    Quartiles are exact: one pass counts cells of close values, and up to two more count parts of the cells that hold a
    quartile, so no value is shuffled and no task merges the sketches of all others.  ``accuracy`` takes
    quartiles from rank points instead, which is one pass and leaves sketches that can be stored.
    """
    names = C.existing(df, cols)
    # NaN is no value: it would be the maximum and turn the mean into NaN.
    values = _long(df, names).filter(F.col("value").isNotNull() & ~F.isnan("value"))
    if accuracy is not None:
        moments = values.groupBy("position").agg(
            F.count("value").alias("non_null_count"),
            F.min("value").alias("min"),
            F.max("value").alias("max"),
            *M.mean_parts("value", digits),
        )
        moments = moments.withColumn("avg", M.mean_of_parts("non_null_count", digits))
        points = rank_points(values, ["position"], "value", accuracy)
        summary = moments.join(point_quantiles(points, ["position"], QUARTILES), "position")
    else:
        cells = values.groupBy("position", select_cell("value").alias("cell")).agg(
            F.count(F.lit(1)).alias("in_cell"), F.min("value").alias("low"), F.max("value").alias("high"), *M.mean_parts("value", digits)
        )
        totals = {
            "non_null_count": F.sum("in_cell"),
            "min": F.min("low"),
            "max": F.max("high"),
            "near": F.sum("near"),
            "far": F.sum("far"),
        }
        summary = selected_quantiles(values, cells, ["position"], "value", QUARTILES, totals)
        summary = summary.withColumn("avg", M.mean_of_parts("non_null_count", digits))
    return summary.select(
        F.lit(dataset).alias("dataset"), _name(names), "non_null_count", "min", *QUARTILES, "max", "avg"
    ).orderBy("column_name")


def quartile_errors(df: DataFrame, summary: DataFrame) -> DataFrame:
    """How far the quartiles of a ``numeric_summary`` are from their ranks, as a share of each column's values.

    Exact quartiles have 0; those of sketches are promised to be off by at most ``1 / accuracy``.
    """
    names = C.existing(df, SUMMARY_COLUMNS)
    values = _long(df, names).filter(F.col("value").isNotNull() & ~F.isnan("value"))
    freq = values.groupBy("position", "value").agg(F.count(F.lit(1)).alias("n")).select(_name(names), "value", "n")
    return rank_errors(freq, summary.select("column_name", *QUARTILES), ["column_name"], "value", "n", QUARTILES)


def log_histogram(df: DataFrame, dataset: str, cols=HISTOGRAM_COLUMNS) -> DataFrame:
    """Positive values counted by the power of ten they lie above; infinity and NaN have the bucket NULL."""
    names = C.existing(df, cols)
    finite = F.col("value") < float("inf")
    bucket = F.when(finite, F.floor(F.log10("value")).try_cast("int"))
    return (
        _long(df, names)
        .filter(F.col("value") > 0)
        .groupBy("position", bucket.alias("log10_floor_bucket"))
        .agg(F.count(F.lit(1)).alias("count"))
        .select(F.lit(dataset).alias("dataset"), _name(names), "log10_floor_bucket", "count")
        .orderBy("column_name", "log10_floor_bucket")
    )


def densify_histogram(histogram: DataFrame, datasets: list[str]) -> DataFrame:
    """A union of ``log_histogram`` tables with every bucket for every dataset, 0 where absent."""
    keys = ["column_name", "log10_floor_bucket"]
    names = F.explode(F.array(*[F.lit(d) for d in datasets])).alias("dataset")
    spine = histogram.select(*keys).distinct().select(names, *keys)
    same = [spine[name].eqNullSafe(histogram[name]) for name in ("dataset", *keys)]
    return (
        spine.join(histogram, same, "left")
        .select(*[spine[name] for name in ("dataset", *keys)], F.coalesce("count", F.lit(0)).alias("count"))
        .orderBy("dataset", *keys)
    )


def sign_counts(df: DataFrame, dataset: str, cols=SIGN_COLUMNS) -> DataFrame:
    """Negative, zero and positive values per column; NULL and NaN are in the total only."""
    per_column = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.count_if(F.col(c) < 0).alias("negative_count"),
            F.count_if(F.col(c) == 0).alias("zero_count"),
            F.count_if((F.col(c) > 0) & ~F.isnan(c)).alias("positive_count"),
            F.count(F.lit(1)).alias("total_rows"),
        )
        for c in C.existing(df, cols)
    ]
    return df.agg(F.array(*per_column).alias("signs")).select(
        F.lit(dataset).alias("dataset"), F.inline("signs")
    )


def joinability(fact: DataFrame, dim: DataFrame, fk: str, pk: str, *, strategy="auto") -> DataFrame:
    """How many fact rows find their key in the dimension.

    Rows are counted per key before the join, so a key held by a third of all rows is one row.
    """
    counts = fact.groupBy(F.col(fk).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    known = dim.select(F.col(pk).alias("key")).dropDuplicates().withColumn("known", F.lit(True))
    total, matched = F.sum("n"), F.sum(F.when(F.col("known"), F.col("n")))
    return (
        counts.join(dimension(known, strategy), "key", "left")
        .agg(
            F.coalesce(total, F.lit(0)).alias("total_rows"),
            F.coalesce(matched, F.lit(0)).alias("matched_rows"),
        )
        .select(
            "total_rows",
            "matched_rows",
            (F.col("total_rows") - F.col("matched_rows")).alias("unmatched_rows"),
            F.coalesce(F.try_divide("matched_rows", "total_rows") * 100.0, F.lit(0.0)).alias(
                "matched_percentage"
            ),
        )
    )


def top_keys(
    fact: DataFrame, zones: DataFrame, k: int = 10, fk: str = "pu_location_id", *, strategy="auto"
) -> DataFrame:
    """The ``k`` most frequent location ids with their zone names."""
    counts = fact.groupBy(fk).agg(F.count(F.lit(1)).alias("trip_count"))
    names = zones.select(F.col("location_id").alias(fk), "borough", "zone", "service_zone")
    return (
        counts.join(dimension(names, strategy), fk, "left")
        .select(fk, "borough", "zone", "service_zone", "trip_count")
        .orderBy(F.desc("trip_count"), fk, "zone")
        .limit(k)
    )


# Groups over which rows are dealt out per record of a sample.
GROUPS_PER_SAMPLE = 32

# Kinds of suspicious trips: the column that shows it, whether its largest or smallest values
# are the worst, and the rule a value must meet.
ANOMALIES = {
    "largest_trip_distance": ("trip_distance", "largest", lambda c: c.isNotNull()),
    "largest_duration_minutes": ("duration_minutes", "largest", lambda c: c.isNotNull()),
    "negative_fare_amount": ("fare_amount", "smallest", lambda c: c < 0),
    "zero_or_negative_duration": ("duration_minutes", "smallest", lambda c: c <= 0),
    "negative_total_amount": ("total_amount", "smallest", lambda c: c < 0),
}


def _edges(df: DataFrame, n: int) -> DataFrame:
    """One row: per kind of anomaly a value that its ``n`` worst rows reach; NULL where any row may be among them.

    Rows are dealt out over groups and the worst value of each group is kept, in one aggregate over
    the columns concerned: the n-th worst of these is reached by at least ``n`` rows, and by hardly more.
    """
    names = list(dict.fromkeys(name for name, _, _ in ANOMALIES.values()))
    group = F.pmod(F.xxhash64(*names), F.lit(GROUPS_PER_SAMPLE * n))
    worst, nth = [], []
    for kind, (name, end, rule) in ANOMALIES.items():
        value, largest = F.when(rule(F.col(name)), F.col(name)), end == "largest"
        worst.append((F.max(value) if largest else F.min(value)).alias(kind))
        nth.append(F.get(F.sort_array(F.collect_list(kind), asc=not largest), n - 1).alias(kind))
    return df.groupBy(group).agg(*worst).agg(*nth)


def anomaly_samples(df: DataFrame, dataset: str, n: int = 5) -> DataFrame:
    """The ``n`` most suspicious records of each kind, numbered from the worst.

    Values that the worst records reach are found in one pass over four columns.  Whole records are
    then read once, and only those that reach such a value, ties included, are ranked.
    """
    record = C.existing(df, RECORD_COLUMNS)
    edges = _edges(df, n)
    reached, entries = F.lit(False), []
    for kind, (name, end, rule) in ANOMALIES.items():
        value, largest = F.col(name), end == "largest"
        edge = edges.select(kind).scalar()
        reached |= rule(value) & (edge.isNull() | (value >= edge if largest else value <= edge))
        entry = F.struct(
            F.lit(kind).alias("category"),
            F.when(F.lit(largest), value).alias("high"),
            F.when(F.lit(not largest), value).alias("low"),
        )
        entries.append(F.when(rule(value), entry))
    order = Window.partitionBy("category").orderBy(F.desc("high"), F.asc("low"), *record)
    return (
        df.filter(reached)
        .select(*record, F.inline(F.array_compact(F.array(*entries))))
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= n)
        .select(F.lit(dataset).alias("dataset"), "category", "rank", *record)
        .orderBy("category", "rank")
    )


def describe_table(df: DataFrame) -> DataFrame:
    """Count, mean, deviation, minimum and maximum of numeric and text columns."""
    return df.describe()


def schema_table(df: DataFrame) -> DataFrame:
    """One row: the schema as a tree, as one line and as JSON."""
    schema = df.schema
    tree = schema.treeString()
    return df.sparkSession.range(1).select(
        F.lit(tree).alias("tree_string"),
        F.lit(schema.simpleString()).alias("simple_string"),
        F.lit(schema.json()).alias("json"),
    )
