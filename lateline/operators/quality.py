"""Audits. Every audit is a DataFrame of (check, severity, failing_rows) computed by Spark.

Checks that look at one row at a time go into a single aggregate over the table, however many there are. Checks for
unique keys group by the key; Spark counts on the map side first, so a key repeated by a third of all rows is still
one small record per task.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lateline import contract
from lateline.functions.months import month_bounds_ns
from lateline.functions.observation import decode_ns_truncated, month_of

ERROR, WARN = "error", "warn"


@dataclass(frozen=True)
class RowCheck:
    name: str
    fails: Column
    severity: str = ERROR


def not_null(columns: Iterable[str]) -> list[RowCheck]:
    return [RowCheck(f"not_null:{c}", F.col(c).isNull()) for c in columns]


def accepted_values(column: str, values: Sequence[str]) -> RowCheck:
    """NULL passes."""
    return RowCheck(f"accepted_values:{column}", ~F.col(column).isin(*values))


def delay_bounds(bounds: tuple[int, int] = contract.DELAY_SANITY_RANGE) -> RowCheck:
    low, high = bounds
    delay = F.col("delay_recomputed_min")
    return RowCheck("delay_sanity_bounds", (delay < low) | (delay > high))


def departure_matches_published() -> RowCheck:
    return RowCheck(
        "departure_delay_matches_published",
        (F.col("delay_basis") == "departure") & (F.col("delay_recomputed_min") != F.col("delay_in_min")),
    )


def line_null_iff_long_distance(types: Sequence[str] = tuple(contract.LONG_DISTANCE_TYPES)) -> RowCheck:
    far, missing = F.col("train_type").isin(*types), F.col("line_number").isNull()
    return RowCheck("line_number_null_matches_train_type", (far & ~missing) | (~far & missing), WARN)


def check_rows(table: DataFrame, checks: Sequence[RowCheck]) -> DataFrame:
    counted = table.agg(*[F.count_if(c.fails).alias(f"c{i}") for i, c in enumerate(checks)])
    return counted.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c.name).alias("check"),
                        F.lit(c.severity).alias("severity"),
                        F.col(f"c{i}").alias("failing_rows"),
                    )
                    for i, c in enumerate(checks)
                ]
            )
        )
    )


def failing_rows(table: DataFrame, check: RowCheck) -> DataFrame:
    return table.where(check.fails)


def repeated_keys(table: DataFrame, key: Sequence[str]) -> DataFrame:
    return table.groupBy(*key).agg(F.count("*").alias("row_count")).where(F.col("row_count") > 1)


def _count_as_check(failing: DataFrame, name: str, severity: str = ERROR) -> DataFrame:
    return failing.agg(
        F.lit(name).alias("check"), F.lit(severity).alias("severity"), F.count("*").alias("failing_rows")
    )


def unique(table: DataFrame, column: str) -> DataFrame:
    """NULLs do not count as repeats of each other."""
    return _count_as_check(repeated_keys(table.where(F.col(column).isNotNull()), [column]), f"unique:{column}")


def ids_loaded_before(fresh: DataFrame, others: DataFrame) -> DataFrame:
    """Ids of newly loaded rows that other months hold too.

    The new months are the small side, so Spark can send them, or a Bloom filter of them, to the scan of the others.
    """
    met = others.select("id").join(fresh.select("id").distinct(), "id", "left_semi")
    return _count_as_check(met, "unique:id_across_months").select(
        F.lit("raw_observations").alias("table_name"), "check", "severity", "failing_rows"
    )


def unique_grain(table: DataFrame, key: Sequence[str], severity: str = ERROR) -> DataFrame:
    """NULLs in a compound key are equal."""
    return _count_as_check(repeated_keys(table, key), f"unique_grain:{'+'.join(key)}", severity)


@dataclass(frozen=True)
class TableChecks:
    rows: tuple[RowCheck, ...] = ()
    unique_columns: tuple[str, ...] = ()
    grain: tuple[str, ...] = ()
    coarse_grain: tuple[str, ...] = ()  # may repeat, with a warning


def table_checks(table: str) -> TableChecks:
    """The declared checks of each stored table."""
    mart = ["service_month", "observation_count", "eligible_for_ranking"]
    era = "station_coverage_era"  # a month in which it changes has two rows for each key
    match table:
        case "raw_observations":
            return TableChecks(tuple(not_null(["id", "source_month"])), ("id",))
        case "staged":
            columns = [
                "id", "source_month", "eva", "train_number", "train_type", "train_line_ride_id",
                "train_line_station_num", "time", "delay_in_min", "is_canceled",
            ]
            return TableChecks(tuple(not_null(columns)), ("id",))
        case "unioned":
            return TableChecks(
                (*not_null(["id", "ingestion_source"]), accepted_values("ingestion_source", ["monthly", "api"]))
            )
        case "deduped":
            return TableChecks(tuple(not_null([*contract.STOP_KEY, "id"])), grain=tuple(contract.STOP_KEY))
        case "enriched":
            columns = [
                "delay_basis", "delay_recomputed_min", "is_on_time", "service_date", "service_hour",
                "station_coverage_era",
            ]
            return TableChecks(
                (
                    *not_null(columns),
                    accepted_values("delay_basis", ["departure", "arrival"]),
                    accepted_values("station_coverage_era", ["limited_coverage", "full_coverage"]),
                    delay_bounds(),
                    departure_matches_published(),
                    line_null_iff_long_distance(),
                )
            )
        case "dim_station":
            return TableChecks(tuple(not_null(["eva", "station_name"])), ("eva",))
        case "dim_train_line":
            return TableChecks(tuple(not_null(["train_type"])), grain=("train_type", "line_number"))
        case "dim_service_month":
            return TableChecks(tuple(not_null(["service_month"])), ("service_month",))
        case "mart_monthly_station_perf":
            key = ("eva", "service_month")
            return TableChecks(tuple(not_null(["eva", *mart])), grain=(*key, era), coarse_grain=key)
        case "mart_monthly_line_perf":
            key = ("train_type", "line_number", "service_month")
            return TableChecks(tuple(not_null(["train_type", *mart])), grain=(*key, era), coarse_grain=key)
    raise KeyError(table)


def audit(table: DataFrame, name: str, kinds: Sequence[str] | None = None) -> DataFrame | None:
    """The declared checks of a table: all of them, or those of some kinds (the part of the name before the colon)."""

    def wanted(check: str) -> bool:
        return kinds is None or check.split(":")[0] in kinds

    declared = table_checks(name)
    results = []
    if rows := [c for c in declared.rows if wanted(c.name)]:
        results.append(check_rows(table, rows))
    if wanted("unique"):
        results += [unique(table, c) for c in declared.unique_columns]
    if declared.grain and wanted("unique_grain"):
        results.append(unique_grain(table, declared.grain))
    if declared.coarse_grain and wanted("unique_grain"):
        results.append(unique_grain(table, declared.coarse_grain, WARN))
    return _stack([r.select(F.lit(name).alias("table_name"), "check", "severity", "failing_rows") for r in results])


def audit_all(tables: Mapping[str, DataFrame], kinds: Sequence[str] | None = None) -> DataFrame:
    return _stack([r for name, df in tables.items() if (r := audit(df, name, kinds)) is not None])


def _stack(results: list[DataFrame]) -> DataFrame | None:
    return reduce(DataFrame.unionByName, results) if results else None


# --- Bronze gate --------------------------------------------------------------------------------------------


def gate_counts(month_start_ns: Column, month_end_ns: Column) -> list[Column]:
    return [
        F.count("*").alias("row_count"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in contract.REQUIRED_COLUMNS],
        F.count_if(~F.col("time").between(month_start_ns, month_end_ns)).alias("time_outside_month"),
    ]


def first_failure() -> Column:
    """The gate step that stops a file whose counts are known; NULL when it passes."""
    nulls = reduce(Column.__or__, [F.col(f"null_{c}") > 0 for c in contract.REQUIRED_COLUMNS])
    return (
        F.when(F.col("row_count") < 1, "empty")
        .when(nulls, "null_in_required_column")
        .when(F.col("time_outside_month") > 0, "time_outside_month")
    )


def gate_month(landed: DataFrame, month: str) -> DataFrame:
    """One row for one landed file: counts, the step it fails at, and whether it passes.

    Names and order are read from the file footer. Nothing is scanned if they are wrong; else one pass over the
    ten required columns answers the rest.
    """
    start, end = month_bounds_ns(month)
    if landed.columns != contract.OBSERVATION_COLUMNS:
        counted = landed.agg(F.count("*").alias("row_count"))
        failure = F.when(F.col("row_count") < 1, "empty").otherwise("schema")
    else:
        counted = landed.agg(*gate_counts(F.lit(start), F.lit(end)))
        failure = first_failure()
    return counted.select(F.lit(month).alias("month"), "*", failure.alias("failed_at")).withColumn(
        "passed", F.col("failed_at").isNull()
    )


def gate_all_months(landed: DataFrame) -> DataFrame:
    """The data steps of the gate for every month of a landed set in one pass, by the month each file stands for."""
    outside = month_of(decode_ns_truncated(F.col("time"))) != F.col("source_month")
    return (
        landed.groupBy(F.col("source_month").alias("month"))
        .agg(
            F.count("*").alias("row_count"),
            *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in contract.REQUIRED_COLUMNS],
            F.count_if(outside).alias("time_outside_month"),
        )
        .withColumn("failed_at", first_failure())
        .withColumn("passed", F.col("failed_at").isNull())
    )


# --- keys ---------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class KeyCandidate:
    name: str
    kind: str
    columns: tuple[str, ...]
    expected_unique: bool


# Identifiers under test.
KEY_CANDIDATES = (
    KeyCandidate("id", "candidate_primary_key", ("id",), True),
    KeyCandidate("train_line_ride_id", "parent_ride_identifier", ("train_line_ride_id",), False),
    KeyCandidate(
        "train_line_ride_id + train_line_station_num",
        "candidate_business_key",
        ("train_line_ride_id", "train_line_station_num"),
        True,
    ),
)


def key_counts(observations: DataFrame, columns: Sequence[str], period: str = "source_month") -> DataFrame:
    return observations.groupBy(F.col(period).alias("period"), *columns).agg(F.count("*").alias("n"))


def assess_identifier(counts: DataFrame, candidate: KeyCandidate) -> DataFrame:
    """Null-key rows and repeated keys by period; a verdict only where the key is expected to be unique."""
    any_null = reduce(Column.__or__, [F.col(c).isNull() for c in candidate.columns])
    found = counts.groupBy("period").agg(
        F.sum(F.when(any_null, F.col("n")).otherwise(0)).alias("null_key_row_count"),
        F.count_if(F.col("n") > 1).alias("duplicate_group_count"),
    )
    sound = (F.col("null_key_row_count") == 0) & (F.col("duplicate_group_count") == 0)
    return found.select(
        "period",
        F.lit(candidate.name).alias("key_name"),
        F.lit(candidate.kind).alias("key_type"),
        F.to_json(F.array(*[F.lit(c) for c in candidate.columns])).alias("key_columns_json"),
        F.lit(candidate.expected_unique).alias("expected_unique"),
        "null_key_row_count",
        "duplicate_group_count",
        (sound if candidate.expected_unique else F.lit(None).cast("boolean")).alias("passes_initial_check"),
    )


def key_assessment(observations: DataFrame, candidates: Sequence[KeyCandidate] = KEY_CANDIDATES) -> DataFrame:
    """All candidates. A key that is part of a wider candidate is counted from that one's counts, whose shuffle Spark
    then runs once for both."""

    def counts(candidate: KeyCandidate) -> DataFrame:
        wider = next((w for w in candidates if set(candidate.columns) < set(w.columns)), None)
        if wider is None:
            return key_counts(observations, candidate.columns)
        return key_counts(observations, wider.columns).groupBy("period", *candidate.columns).agg(F.sum("n").alias("n"))

    return reduce(DataFrame.unionByName, [assess_identifier(counts(c), c) for c in candidates])


def key_verdicts(assessment: DataFrame) -> DataFrame:
    """Whether a key that should be unique is so in every period."""
    return (
        assessment.where(F.col("expected_unique"))
        .groupBy("key_name")
        .agg(F.bool_and("passes_initial_check").alias("passes_all_samples"))
    )
