"""Profiles landed months and exports what was found."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from lateline.operators import quality
from lateline.plans import catalog, profiling
from lateline.sources import sinks
from lateline.sources.bronze import file_sizes, month_folder, read_landed
from lateline.workspace import Workspace, sized_shuffles, stored_bytes


def month_schemas(spark: SparkSession, bronze_root: str, months: list[str]) -> DataFrame:
    folders: Mapping[str, str] = {month: month_folder(bronze_root, month) for month in months}
    return catalog.schema_rows(spark, catalog.read_schemas(spark, folders))


def profile_reports(spark: SparkSession, bronze_root: str, space: Workspace) -> dict[str, DataFrame]:
    """The exported reports. Those made of plain counters share one scan, whose result is stored first."""
    filed = read_landed(spark, bronze_root)
    counters = space.table("profile_counters", lambda: profiling.monthly_counters(filed))
    months = sorted(r[profiling.MONTH] for r in counters.select(profiling.MONTH).collect())
    schemas = month_schemas(spark, bronze_root, months)
    return {
        "schema_month_summary": catalog.schema_month_summary(schemas, months[0]),
        "schema_field_comparison": catalog.schema_field_comparison(schemas, months[0]),
        "monthly_overview": profiling.monthly_overview(filed, file_sizes(spark, bronze_root)),
        "cardinality_profile": profiling.cardinality_profile(filed),
        "line_null_by_train_type": profiling.line_null_by_train_type(filed),
        "id_key_profile": profiling.id_key_profile(filed),
        "ride_stop_duplicate_summary": profiling.ride_stop_duplicate_summary(filed),
        "time_match_profile": profiling.time_match_profile(filed),
        "delay_profile": profiling.delay_profile(filed),
        "cancellation_profile": profiling.cancellation_profile(filed),
        "daily_coverage_summary": profiling.daily_coverage_summary(profiling.daily_coverage(filed)),
        "modelling_decisions": catalog.decision_register(spark),
        **profiling.reports_from_counters(counters),
    }


def catalog_tables(spark: SparkSession, bronze_root: str) -> dict[str, DataFrame]:
    filed = read_landed(spark, bronze_root)
    summary = profiling.dataset_summary(filed, file_sizes(spark, bronze_root))
    months = sorted(r.source_month for r in summary.select("source_month").collect())
    schemas = month_schemas(spark, bronze_root, months)
    assessment = quality.key_assessment(filed)
    return {
        "dataset_catalog": catalog.dataset_catalog(summary, quality.key_verdicts(assessment)),
        "column_catalog": catalog.column_catalog(
            schemas.where(schemas["period"] == months[-1]), catalog.documented_columns(spark)
        ),
        "sample_summary": summary,
        "schema_comparison": catalog.schema_field_comparison(schemas, months[0]),
        "key_assessment": assessment,
    }


def export_profile(spark: SparkSession, bronze_root: str, out_root: str, space: Workspace) -> None:
    with sized_shuffles(spark, stored_bytes(spark, bronze_root)):
        sinks.export_reports(profile_reports(spark, bronze_root, space), out_root)


def export_catalog(spark: SparkSession, bronze_root: str, out_root: str) -> None:
    """The tables, and the catalog once more as nested JSON."""
    with sized_shuffles(spark, stored_bytes(spark, bronze_root)):
        sinks.export_reports(catalog_tables(spark, bronze_root), out_root)
    stored = {name: spark.read.parquet(f"{out_root}/{name}_parquet") for name in ("column_catalog", "dataset_catalog")}
    sinks.export_json(catalog.catalog_document(**stored), f"{out_root}/catalog_json")
