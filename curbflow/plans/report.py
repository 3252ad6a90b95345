"""Report runs: result tables, query plans and a metrics document, written in one go."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curbflow.sources.readers import read_run_metrics
from curbflow.sources.writers import plan_text, write_csv_table, write_json_document, write_text


def run_report(
    name: str,
    tables: dict[str, DataFrame],
    folder: str,
    params: dict[str, str | int | float | bool] | None = None,
    *,
    shared: tuple[DataFrame, ...] = (),
    counts: dict[str, DataFrame | int] | None = None,
    run: dict | None = None,
    preview_rows: int = 20,
    mode: str = "overwrite",
) -> dict[str, str]:
    """Write each result table as CSV, its plan as text, and one JSON document about the run.

    ``tables`` are result tables: limited or grouped, small.  They are kept while the report
    runs, so that writing, counting and previewing them computes them once.  ``shared`` are
    inputs several tables are made from, already reduced to the columns needed; they are kept
    too.  ``counts`` are numbers, or frames of one row, about the input: rows read, rows
    kept, thresholds; a frame of several columns gives a field for each, from one run of it.  ``run`` adds fields such as ``config``, ``run_type`` or ``executor_config_expected``.
    """
    spark = next(iter(tables.values())).sparkSession
    paths = {f"table:{t}": f"{folder}/tables/{name}/{t}" for t in tables}
    paths |= {f"plan:{t}": f"{folder}/plans/{name}/{t}" for t in tables}
    paths["metrics"] = f"{folder}/metrics/{name}"
    # Explained before anything is kept in memory: the plan that shows pruning and joins.
    plans = {t: plan_text(df) for t, df in tables.items()}
    started = time.monotonic()
    kept = [df.persist() for df in (*shared, *tables.values())]
    try:
        for t, df in tables.items():
            write_csv_table(df, paths[f"table:{t}"], mode, single_file=True)
            write_text(spark, plans[t], paths[f"plan:{t}"], mode)
        elapsed = round(time.monotonic() - started, 3)
        previews = [_preview(df, preview_rows).alias(f"{t}_preview") for t, df in tables.items()]
        result_rows = [rows(df).scalar().alias(t) for t, df in tables.items()]
        document = spark.range(1).select(
            F.lit(name).alias("job"),
            F.lit(spark.sparkContext.applicationId).alias("spark_application_id"),
            *_fields(run),
            F.struct(*_fields(params)).alias("params") if params else F.lit(None).cast("string").alias("params"),
            F.struct(*result_rows).alias("row_counts"),
            *([F.struct(*_fields(counts)).alias("counts")] if counts else []),
            F.struct(*_fields(paths)).alias("output_paths"),
            *previews,
            F.lit(elapsed).alias("elapsed_seconds"),
        )
        write_json_document(document, paths["metrics"], mode)
    finally:
        for df in reversed(kept):
            df.unpersist()
    return paths


def rows(df: DataFrame) -> DataFrame:
    """The number of rows, as a frame."""
    return df.agg(F.count(F.lit(1)).alias("rows"))


def _preview(df: DataFrame, rows: int):
    """The first rows of a result table as one array value."""
    return df.limit(rows).agg(F.collect_list(F.struct("*"))).scalar()


def _fields(values: dict | None) -> list:
    fields = []
    for key, value in (values or {}).items():
        if isinstance(value, DataFrame) and len(value.columns) > 1:
            # One subquery for all of its columns: Spark runs equal subqueries once.
            row = value.select(F.struct("*").alias("row")).scalar()
            fields += [row[name].alias(name) for name in value.columns]
        else:
            fields.append(_literal(value).alias(key))
    return fields


def _literal(value):
    if isinstance(value, DataFrame):
        return value.scalar()
    if isinstance(value, dict):
        return F.struct(*_fields(value))
    if isinstance(value, (list, tuple)):
        return F.array(*[_literal(v) for v in value])
    return F.lit(value)


def scaling_report(spark: SparkSession, metrics_folder: str) -> DataFrame:
    """Elapsed time and speed-up per configuration and run type, from stored metrics documents.

    The speed-up is against the run with the fewest executors of the same run type.
    """
    runs = read_run_metrics(spark, metrics_folder).select(
        "config",
        "run_type",
        F.col("executor_config_expected.instances").cast("int").alias("instances"),
        F.col("elapsed_seconds").alias("elapsed"),
    )
    smallest = Window.partitionBy("run_type").orderBy("instances", "config")
    return (
        runs.filter(F.col("elapsed").isNotNull())
        .withColumn(
            "speedup",
            F.round(F.try_divide(F.first("elapsed").over(smallest), "elapsed"), 2),
        )
        .orderBy("run_type", "instances", "config")
    )
