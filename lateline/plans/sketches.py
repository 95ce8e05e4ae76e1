"""Profiles from stored sketches: one small row for each month, from which any span of months is summed up.

A sketch of a set of values is a few kilobytes whatever the set, and the sketch of a union is made from the sketches of
its parts. So observations are read once, when their month is loaded; reports over many months read one row a month.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lateline.functions import observation as obs
from lateline.functions.months import expand_months
from lateline.plans.monthly_run import Store
from lateline.plans.profiling import CARDINALITY_COLUMNS, MONTH, sketch_of
from lateline.sources.raw import read_raw, replace_months
from lateline.workspace import configure

TABLE = "month_sketches"

# The reports' names for approximate counts of these columns.
OVERVIEW = {"eva": "approx_distinct_eva", "train_line_ride_id": "approx_distinct_rides", "train_number": "approx_distinct_train_numbers"}
TOTAL = ["eva", "train_line_ride_id"]


def month_sketches(observations: DataFrame) -> DataFrame:
    """By month: rows, times, canceled rows, calendar days, and a sketch of each profiled column."""
    time = obs.decode_ns_truncated(F.col("time"))
    return observations.groupBy(MONTH).agg(
        F.count("*").alias("row_count"),
        F.min(time).alias("minimum_time"),
        F.max(time).alias("maximum_time"),
        F.count_if("is_canceled").alias("canceled_rows"),
        F.collect_set(F.to_date(time)).alias("service_dates"),  # a few dozen days
        *[sketch_of(c).alias(f"sketch_{c}") for c in CARDINALITY_COLUMNS],
    )


def refresh_sketches(spark: SparkSession, store: Store, months: Iterable[str]) -> None:
    """Sketches the given months of the raw table anew; the rows of other months are neither read nor replaced."""
    configure(spark)
    months = expand_months(months)
    raw = read_raw(spark, store.raw).where(F.col(MONTH).isin(months))
    replace_months(month_sketches(raw), MONTH, store.table(TABLE), many=False)


def read_sketches(spark: SparkSession, store: Store) -> DataFrame:
    return spark.read.parquet(store.table(TABLE)).withColumn(MONTH, F.col(MONTH).cast("string"))


def _estimate(column: str):
    return F.hll_sketch_estimate(f"sketch_{column}")


def overview(sketches: DataFrame) -> DataFrame:
    """The monthly overview, one row of the table each."""
    return sketches.select(
        MONTH,
        "row_count",
        "minimum_time",
        "maximum_time",
        F.size("service_dates").cast("long").alias("distinct_service_dates"),
        *[_estimate(c).alias(name) for c, name in OVERVIEW.items()],
        "canceled_rows",
        obs.pct(F.col("canceled_rows"), F.col("row_count"), 4).alias("cancellation_rate_pct"),
    )


def cardinalities(sketches: DataFrame) -> DataFrame:
    counted = sketches.select(MONTH, *[_estimate(c).alias(c) for c in CARDINALITY_COLUMNS])
    return counted.unpivot([MONTH], CARDINALITY_COLUMNS, "column_name", "approx_distinct_count")


def total(sketches: DataFrame) -> DataFrame:
    """The whole span: values that several months have count once."""
    return sketches.agg(
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("row_count"),
        F.min("minimum_time").alias("minimum_time"),
        F.max("maximum_time").alias("maximum_time"),
        F.size(F.array_distinct(F.flatten(F.collect_list("service_dates")))).cast("long").alias("distinct_service_dates"),
        *[F.hll_sketch_estimate(F.hll_union_agg(f"sketch_{c}")).alias(OVERVIEW[c]) for c in TOTAL],
    )
