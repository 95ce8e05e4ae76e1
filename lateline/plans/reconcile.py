"""The monthly reconciliation: the loaded months against an official release."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lateline.functions.months import expand_months
from lateline.operators.observations import DEDUPED_COLUMNS, dedup_latest
from lateline.operators.reconciliation import Tolerance, differences, reconcile, verdicts
from lateline.operators.staging import stage_observations, union_sources
from lateline.plans.monthly_run import ENRICHED, Store
from lateline.sources.bronze import scan_nanos_parquet
from lateline.sources.raw import derive_source_month, replace_months
from lateline.workspace import configure, sized_shuffles, stored_bytes

REPORT, DIFFERENCES = "reconciliation", "reconciliation_differences"


def official_stops(observations: DataFrame) -> DataFrame:
    """An official release brought to the grain of the stored stops, by the same rules."""
    return dedup_latest(union_sources(official=stage_observations(derive_source_month(observations))))


def reconcile_months(
    spark: SparkSession, store: Store, releases: Iterable[str], months: Iterable[str], *, tolerance: Tolerance = Tolerance()
) -> DataFrame:
    """Compares the stored stops of ``months`` with the release files; writes and returns the report of these months.

    Months are those of the rows' own time. Files of neighbouring months may hold rows of a month, so they belong among
    the ``releases`` too; rows of other months are left out. The report and the differing stops replace earlier ones of
    the same months.
    """
    configure(spark)
    months, releases = expand_months(months), list(releases)
    stored = spark.read.parquet(store.table(ENRICHED)).withColumn("source_month", F.col("source_month").cast("string"))
    here = stored.where(F.col("source_month").isin(months)).select(*DEDUPED_COLUMNS)
    there = official_stops(scan_nanos_parquet(spark, *releases)).where(F.col("source_month").isin(months))
    with sized_shuffles(spark, stored_bytes(spark, *releases)):
        replace_months(verdicts(reconcile(here, there), tolerance), "source_month", store.table(REPORT), many=True)
        replace_months(differences(here, there), "source_month", store.table(DIFFERENCES), many=True)
    report = spark.read.parquet(store.table(REPORT))
    return report.withColumn("source_month", F.col("source_month").cast("string")).where(F.col("source_month").isin(months))

