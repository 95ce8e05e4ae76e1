"""The data catalog: schemas compared, columns documented, dataset facts."""

from __future__ import annotations

import json
from collections import defaultdict
from collections.abc import Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lateline import contract
from lateline.sources.bronze import scan_nanos_parquet

# Role of each column.
COLUMN_ROLES = {
    "station_name": "dimension",
    "xml_station_name": "dimension",
    "eva": "identifier",
    "train_number": "identifier",
    "line_number": "dimension",
    "final_destination_station": "dimension",
    "delay_in_min": "measure",
    "time": "event_time",
    "is_canceled": "flag",
    "train_type": "dimension",
    "train_line_ride_id": "parent_identifier",
    "train_line_station_num": "sequence",
    "arrival_planned_time": "event_time",
    "arrival_change_time": "event_time",
    "departure_planned_time": "event_time",
    "departure_change_time": "event_time",
    "id": "row_identifier",
}

# Column -> (description, unit or format, source, note on quality).
_NS = "nanoseconds since the epoch, wall clock without zone"
COLUMN_NOTES = {
    "station_name": ("Name looked up by station code", "text", "station code lookup", "NULL where the lookup fails"),
    "xml_station_name": ("Name as the timetable feed spells it", "text", "feed, station attribute", "Spelling may differ"),
    "eva": ("Station code", "text, keeps leading zeros", "station register", "Always present"),
    "train_number": ("Number of the train run", "text", "feed, tl.n", "Repeats across days and train types"),
    "line_number": ("Line the train runs on", "text", "feed, ar.l or dp.l", "NULL for long-distance types"),
    "final_destination_station": ("Where the train ends", "text", "monthly processing", "Free spelling"),
    "delay_in_min": ("Published delay", "whole minutes", "planned and effective times", "Negative means early"),
    "time": ("Effective event time, departure before arrival", _NS, "departure else arrival", "Always present"),
    "is_canceled": ("Whether the stop was canceled", "boolean", "feed, ar.clt or dp.clt", "Always present"),
    "train_type": ("Train category code", "text", "feed, tl.c", "New codes appear"),
    "train_line_ride_id": ("One ride of one train", "text", "monthly processing", "Shared by all stops of the ride"),
    "train_line_station_num": ("Position of the stop in the ride", "whole number", "stop id", "Repeats per snapshot"),
    "arrival_planned_time": ("Planned arrival", _NS, "feed, ar.pt", "NULL at the first stop"),
    "arrival_change_time": ("Effective arrival", _NS, "feed, ar.ct else ar.pt", "Equal to planned without news"),
    "departure_planned_time": ("Planned departure", _NS, "feed, dp.pt", "NULL at the last stop"),
    "departure_change_time": ("Effective departure", _NS, "feed, dp.ct else dp.pt", "Equal to planned without news"),
    "id": ("One snapshot of one stop", "text", "monthly processing", "Unique"),
}


def read_schemas(spark: SparkSession, paths: Mapping[str, str], at_once: int = 16) -> dict[str, T.StructType]:
    """The schema of each path from a file footer. Spark reads one footer per path; several paths at a time."""
    with ThreadPoolExecutor(at_once) as pool:
        schemas = pool.map(lambda path: scan_nanos_parquet(spark, path).schema, paths.values())
        return dict(zip(paths, schemas, strict=True))


def file_schemas(spark: SparkSession, files: Iterable[str], at_once: int = 16) -> dict[str, list[str]]:
    """The files by schema, schemas as JSON. Every footer is read, several at a time; what stays on the driver is one
    text for each different schema and the files' names."""
    files, found = list(files), defaultdict(list)
    with ThreadPoolExecutor(at_once) as pool:
        for file, schema in zip(files, pool.map(lambda file: scan_nanos_parquet(spark, file).schema.json(), files), strict=True):
            found[schema].append(file)
    return dict(found)


def data_files(spark: SparkSession, *paths: str) -> list[str]:
    """All Parquet files below the paths; one of them is opened to find out."""
    return sorted(scan_nanos_parquet(spark, *paths).inputFiles())


DRIFT = "file string, column_name string, drift string, expected string, found string"


def schema_drift(spark: SparkSession, schemas: Mapping[str, list[str]], reference: T.StructType = contract.OBSERVATION_SCHEMA) -> DataFrame:
    """What each file has otherwise than the reference: columns that are ``missing``, ``unexpected``, of another
    ``type`` or, among those both have, at another ``position`` (from 1). A file without drift has no row."""
    expected = {f.name: f.dataType.simpleString() for f in reference}
    rows = []
    for text, files in schemas.items():
        schema = T.StructType.fromJson(json.loads(text))
        found = {f.name: f.dataType.simpleString() for f in schema}
        drift = [(c, "missing", kind, None) for c, kind in expected.items() if c not in found]
        drift += [(c, "unexpected", None, kind) for c, kind in found.items() if c not in expected]
        drift += [(c, "type", kind, found[c]) for c, kind in expected.items() if c in found and found[c] != kind]
        shared, order = [c for c in expected if c in found], [c for c in found if c in expected]
        drift += [(c, "position", str(at), str(order.index(c) + 1)) for at, c in enumerate(shared, 1) if order[at - 1] != c]
        rows += [(file, *d) for file in files for d in drift]
    return spark.createDataFrame(rows, DRIFT)


def schema_rows(spark: SparkSession, schemas: Mapping[str, T.StructType]) -> DataFrame:
    """Schemas as rows. They come from file footers: one small record per column, whatever the files hold."""
    rows = [
        (period, at, f.name, f.dataType.simpleString(), f.nullable)
        for period, schema in schemas.items()
        for at, f in enumerate(schema, start=1)
    ]
    return spark.createDataFrame(
        rows, "period string, ordinal_position int, column_name string, spark_data_type string, nullable boolean"
    )


def schema_month_summary(schemas: DataFrame, reference_period: str) -> DataFrame:
    """Per month: column count, same fields as the reference month, contract names in contract order, and strays."""
    field = F.struct("ordinal_position", "column_name", "spark_data_type", "nullable")
    per_month = schemas.groupBy("period").agg(
        F.count("*").cast("int").alias("column_count"), F.sort_array(F.collect_list(field)).alias("fields")
    )
    reference = per_month.where(F.col("period") == reference_period).select(F.col("fields").alias("reference_fields"))
    expected = F.array(*[F.lit(c) for c in contract.OBSERVATION_COLUMNS])
    names = F.col("fields.column_name")
    return per_month.select(
        "period",
        "column_count",
        (F.col("fields") == reference.scalar()).alias("matches_reference_schema"),
        (names == expected).alias("matches_catalog_column_order"),
        F.concat_ws(", ", F.sort_array(F.array_except(expected, names))).alias("missing_expected_columns"),
        F.concat_ws(", ", F.sort_array(F.array_except(names, expected))).alias("unexpected_columns"),
    ).orderBy("period")


def schema_field_comparison(schemas: DataFrame, reference_period: str) -> DataFrame:
    """Month by field against the reference month, absent fields included on either side."""
    definition = F.struct("spark_data_type", "nullable")
    reference = schemas.where(F.col("period") == reference_period).select(
        "column_name", definition.alias("reference_definition")
    )
    observed = schemas.select("period", "column_name", definition.alias("definition"))
    periods = schemas.agg(F.collect_set("period")).scalar()
    wanted = reference.select(F.explode(periods).alias("period"), "column_name", "reference_definition")
    return wanted.join(observed, ["period", "column_name"], "full").select(
        "period",
        "column_name",
        F.col("definition.spark_data_type").alias("spark_data_type"),
        F.col("definition.nullable").alias("nullable"),
        F.col("definition").eqNullSafe(F.col("reference_definition")).alias("matches_reference"),
    )


def schema_differences(comparison: DataFrame) -> DataFrame:
    return comparison.where(~F.col("matches_reference")).orderBy("period", "column_name")


def documented_columns(spark: SparkSession) -> DataFrame:
    rows = [(name, COLUMN_ROLES[name], *notes, "source_documented") for name, notes in COLUMN_NOTES.items()]
    return spark.createDataFrame(
        rows,
        "column_name string, business_role string, description string, unit_or_format string, "
        "source_or_derivation string, data_quality_notes string, verification_status string",
    )


def column_catalog(schema: DataFrame, documented: DataFrame) -> DataFrame:
    """Columns as read, with what is known of them; what is not documented says so."""
    fallback = {
        "business_role": "unknown",
        "description": "Not documented yet.",
        "unit_or_format": "unknown",
        "source_or_derivation": "unknown",
        "data_quality_notes": "Not reviewed",
        "verification_status": "to_verify",
    }
    return (
        schema.select("ordinal_position", "column_name", "spark_data_type", "nullable")
        .join(documented, "column_name", "left")
        .fillna(fallback)
        .select("ordinal_position", "column_name", "spark_data_type", "nullable", *fallback)
        .orderBy("ordinal_position")
    )


def catalog_coverage(schema: DataFrame, documented: DataFrame) -> DataFrame:
    """Undocumented columns, notes without a column, and the share of columns that is documented."""
    read = schema.select("column_name", F.lit(True).alias("physical"))
    noted = documented.select("column_name", F.lit(True).alias("documented"))
    both = read.join(noted, "column_name", "full")
    physical, known = F.col("physical").isNotNull(), F.col("documented").isNotNull()
    return both.agg(
        F.concat_ws(", ", F.sort_array(F.collect_list(F.when(physical & ~known, F.col("column_name"))))).alias(
            "columns_without_documentation"
        ),
        F.concat_ws(", ", F.sort_array(F.collect_list(F.when(known & ~physical, F.col("column_name"))))).alias(
            "documentation_without_column"
        ),
        F.try_divide(F.lit(100.0) * F.count_if(physical & known), F.count_if(physical)).alias("coverage_pct"),
    )


def dataset_catalog(summary: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Dataset facts as attribute and value, nested values as JSON, all taken from the profiled files."""
    facts = summary.agg(
        F.to_json(F.sort_array(F.collect_list("source_month"))).alias("sample_periods"),
        F.to_json(F.map_from_entries(F.sort_array(F.collect_list(F.struct("source_month", "row_count"))))).alias(
            "sample_row_counts"
        ),
        F.to_json(
            F.map_from_entries(F.sort_array(F.collect_list(F.struct("source_month", "distinct_service_dates"))))
        ).alias("sample_distinct_service_dates"),
        F.concat_ws(" to ", F.min("minimum_time").cast("string"), F.max("maximum_time").cast("string")).alias(
            "sample_time_scope"
        ),
        F.max("column_count").cast("string").alias("column_count"),
    )
    primary = verdicts.where(F.col("key_name") == "id").select(F.col("passes_all_samples").cast("string"))
    facts = facts.select(
        "*",
        F.lit("id").alias("candidate_primary_key"),
        primary.scalar().alias("candidate_primary_key_passes_samples"),
        F.lit("one snapshot of one ride at one stop of its sequence").alias("grain_hypothesis"),
        F.lit("Parquet").alias("source_format"),
        F.lit("Nanoseconds").alias("timestamp_storage"),
        F.lit(contract.COVERAGE_CUTOVER.isoformat()).alias("coverage_transition_date"),
    )
    return facts.select(F.lit(1).alias("one"), "*").unpivot(
        ["one"], facts.columns, "catalog_attribute", "catalog_value"
    ).drop("one")


def decision_register(spark: SparkSession) -> DataFrame:
    """Which report settles which modelling question, and the rule that came of it."""
    rows = [
        ("row key", "Is id present and unique?", "id_key_profile", "not null and unique on id"),
        ("stop grain", "Why do stops repeat?", "ride_stop_duplicate_summary", "unique grain after deduplication"),
        ("precedence", "Are repeats later snapshots?", "ride_stop_groups", "latest time, then larger id"),
        ("service time", "Which event does time follow?", "time_match_profile", "departure before arrival"),
        ("delay", "Do event times give the published delay?", "delay_recompute_validation", "departure must match"),
        ("delay range", "How extreme are delays?", "delay_profile", "bounds from the extremes seen"),
        ("cancellation", "Do canceled stops have a delay?", "cancellation_profile", "kept out of delay measures"),
        ("station", "Does a code have several names?", "eva_station_name_profile", "one name per code"),
        ("line", "Which types lack a line?", "line_null_by_train_type", "NULL only for long-distance types"),
        ("calendar", "Do rows stay in their month?", "service_date_scope_check", "gate on the month bounds"),
        ("coverage", "When did coverage change?", "dataset_catalog", "era by service date"),
    ]
    return spark.createDataFrame(rows, "area string, question string, evidence string, rule string")


def catalog_document(column_catalog: DataFrame, dataset_catalog: DataFrame) -> DataFrame:
    """The whole catalog as one nested row, for the JSON export. Its size follows the column count."""
    columns = column_catalog.agg(
        F.sort_array(F.collect_list(F.struct(*column_catalog.columns))).alias("column_metadata")
    )
    dataset = dataset_catalog.agg(
        F.map_from_entries(F.collect_list(F.struct("catalog_attribute", "catalog_value"))).alias("catalog")
    )
    return dataset.select("catalog", columns.scalar().alias("column_metadata"))
