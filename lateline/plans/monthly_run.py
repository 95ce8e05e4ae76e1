"""The monthly job: land, gate, load, then each layer with its checks."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from datetime import date

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lateline import contract
from lateline.functions import observation as obs
from lateline.functions.months import expand_months, next_month, previous_month
from lateline.operators import marts as mart_models
from lateline.operators import quality
from lateline.operators.marts import Marts
from lateline.operators.observations import dedup_latest, enrich
from lateline.operators.staging import stage_observations, union_sources
from lateline.plans.catalog import data_files, file_schemas
from lateline.plans.publication import Staged, recover
from lateline.sources.bronze import (
    bronze_path,
    has_landed,
    land_month,
    publish_months,
    read_landed,
    scan_nanos_parquet,
    stage_months,
    staging_folder,
)
from lateline.sources.messages import message_observations, read_messages
from lateline.sources.raw import delete_month, derive_source_month, load_raw, read_raw, write_raw
from lateline.workspace import configure, delete, folders, path_exists, replace_folder, sized_shuffles, stored_bytes

logger = logging.getLogger(__name__)

# How Spark says that files hold no Parquet.
NOT_PARQUET = ("is not a Parquet file", "CANNOT_READ_FILE_FOOTER", "UNABLE_TO_INFER_SCHEMA")


class GateFailed(RuntimeError):
    """A landed file does not meet the contract; nothing was loaded."""


class CheckFailed(RuntimeError):
    """A layer failed a check of severity error; later layers were not built."""


@dataclass(frozen=True)
class Store:
    """Where the layers live. All tables are Parquet folders cut by month."""

    root: str

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze/monthly-raw"

    @property
    def messages(self) -> str:
        return f"{self.root}/bronze/api-raw"

    @property
    def raw(self) -> str:
        return f"{self.root}/raw_observations"

    @property
    def raw_messages(self) -> str:
        """Stops parsed from messages, in the columns of the raw table."""
        return f"{self.root}/raw_api_observations"

    def table(self, name: str) -> str:
        return f"{self.root}/{name}"


def gate(spark: SparkSession, store: Store, month: str, path: str | None = None) -> tuple[bool, int]:
    """Whether the landed file, or another one for the month, passes, and its rows; a file that is missing or not
    Parquet has none."""
    path = path or bronze_path(month, store.bronze)
    if not path_exists(spark, path):
        logger.error("%s: no file", month)
        return False, 0
    try:
        landed = scan_nanos_parquet(spark, path)
    except (PySparkException, Py4JJavaError) as error:
        # Only what says that the file isn't Parquet fails the gate; a storage that can't be read isn't a bad file.
        if not any(sign in str(error) for sign in NOT_PARQUET):
            raise
        logger.exception("%s: no readable file", month)
        return False, 0
    verdict = quality.gate_month(landed, month).first()
    return verdict["passed"], verdict["row_count"]


def require_one_schema(spark: SparkSession, source: str, month: str) -> None:
    """A release of several files must have one schema: Spark reads all of them by the footer of one, so that a column
    that others lack or type differently would be lost or fail late."""
    found = file_schemas(spark, data_files(spark, source))
    if len(found) > 1:
        groups = "; ".join(sorted(f"{len(files)} files like {files[0]}" for files in found.values()))
        raise GateFailed(f"{month}: {len(found)} schemas, {groups}")


def gate_all(spark: SparkSession, store: Store, months: Iterable[str]) -> bool:
    return all([gate(spark, store, month)[0] for month in months])


def require(audited: DataFrame) -> None:
    """Stops the run at failing checks of severity error; warnings pass."""
    failed = audited.where((F.col("severity") == quality.ERROR) & (F.col("failing_rows") > 0)).collect()
    if failed:
        raise CheckFailed("; ".join(f"{r.table_name} {r.check}: {r.failing_rows}" for r in failed))


#: The official release of a month replaces what messages said of a stop before.
PRECEDENCE = ("monthly", "api")

NAMES, LINES = ["eva", "station_name", "xml_station_name"], ["train_type", "line_number"]
ENRICHED, STATION_NAMES, TRAIN_LINES = "int_observations_enriched", "station_names_by_month", "train_lines_by_month"
MARTS = ("mart_monthly_station_perf", "mart_monthly_line_perf")


def _months_between(table: DataFrame) -> list[str]:
    """The service months of a table of rebuilt rows, a few for each month rebuilt."""
    return sorted(str(r[0]) for r in table.select("service_month").distinct().collect() if r[0] is not None)


def around_months(service_months: list[str]) -> list[str]:
    """Source months whose rows may fall into these service months: times are cut for one and rounded for the other."""
    own = {m[:7] for m in service_months}
    return sorted(own | {next_month(m) for m in own} | {previous_month(m) for m in own})


def build_layers(
    spark: SparkSession, store: Store, months: list[str] | None, *, cutover: date = contract.COVERAGE_CUTOVER
) -> Marts:
    """Staging to marts: written aside, audited, then published, so a run that fails leaves the tables as they were.

    What an earlier run began to publish before it broke off is finished first: the tables that this one compares with are whole.

    With ``months`` only the rows of those source months are rebuilt, and the marts of every service month that these
    rows, or the ones they replace, fall into; such a mart is made from all rows of the month, those of neighbouring
    source months included. The result equals a full refresh, which ``None`` asks for: it replaces every table.

    What a run costs follows the months rebuilt. Ids must be unique over all months: those of the new months among
    themselves, and by a semi-join against the others. Dimensions come from small tables of the distinct names and
    lines of each source month.
    """
    recover(spark, store.root)
    whole = months is None
    raw = read_raw(spark, store.raw)
    fresh_raw = raw if whole else raw.where(F.col("source_month").isin(months))
    # Files may hold rows of a neighbouring month, so what is rebuilt is sized by a margin of two more months.
    size = stored_bytes(spark, store.raw)
    share = 1.0 if whole else min(1.0, (len(months) + 2) / max(1, len(folders(spark, store.raw))))
    staged = Staged(spark, store.root, uuid.uuid4().hex)
    try:
        with sized_shuffles(spark, int(size * share)):
            built = _staged_layers(staged, store, raw, fresh_raw, months, cutover)
            staged.publish()
    finally:
        staged.discard()
    return built()


def _staged_layers(
    staged: Staged, store: Store, raw: DataFrame, fresh_raw: DataFrame, months: list[str] | None, cutover: date
) -> Callable[[], Marts]:
    """Writes and audits all tables and notes what they replace; returns how to read them once published."""
    spark, whole = staged.spark, months is None
    require(quality.audit(fresh_raw, "raw_observations"))
    if not whole:
        others = raw.where(~F.col("source_month").isin(months))
        require(quality.ids_loaded_before(fresh_raw, others))
    prepared = stage_observations(fresh_raw)
    sources = {"monthly": prepared}
    if path_exists(spark, store.raw_messages):
        told = read_raw(spark, store.raw_messages)
        sources["api"] = stage_observations(told if whole else told.where(F.col("source_month").isin(months)))
    unioned = union_sources(**sources)
    # Staging only renames and casts, so its ids are unique exactly if the raw ones are, which is settled above.
    require(quality.audit_all({"staged": prepared, "unioned": unioned}, ["not_null", "accepted_values"]))

    # Stops go to their month's task before they get the columns made from them, which the shuffle needn't carry.
    stops = dedup_latest(unioned, PRECEDENCE if len(sources) > 1 else ()).hint("rebalance", "source_month")
    rebuilt = staged.write(enrich(stops, cutover=cutover), ENRICHED, "source_month", gathered=True)
    require(quality.audit_all({"deduped": rebuilt, "enriched": rebuilt}))
    service_month = obs.service_month(F.col("service_date"))

    def with_stored(fresh: DataFrame, name: str) -> DataFrame:
        if whole:
            return fresh
        return staged.stored(name, fresh).where(~F.col("source_month").isin(months)).unionByName(fresh)

    touched = None
    rows = rebuilt
    if not whole:
        before = staged.stored(ENRICHED, rebuilt).where(F.col("source_month").isin(months))
        touched = _months_between(rebuilt.unionByName(before).select(service_month.alias("service_month")))
        near = with_stored(rebuilt, ENRICHED).where(F.col("source_month").isin(around_months(touched)))
        rows = near.where(service_month.cast("string").isin(touched))
    marts = [staged.write(getattr(mart_models, name)(rows), name, "service_month") for name in MARTS]

    small = {
        STATION_NAMES: rebuilt.select("source_month", *NAMES).distinct(),
        TRAIN_LINES: rebuilt.select("source_month", *LINES).distinct(),
    }
    names, lines = [with_stored(staged.write(t, name, "source_month"), name) for name, t in small.items()]
    station_mart = marts[0]
    if not whole:
        kept = staged.stored(MARTS[0], station_mart).where(~F.col("service_month").cast("string").isin(touched))
        station_mart = kept.unionByName(station_mart)
    dimensions = {
        "dim_station": staged.write(mart_models.dim_station(names), "dim_station"),
        "dim_train_line": staged.write(mart_models.dim_train_line(lines), "dim_train_line"),
        "dim_service_month": staged.write(mart_models.dim_service_month(station_mart), "dim_service_month"),
    }
    require(quality.audit_all({**dict(zip(MARTS, marts)), **dimensions}))
    schemas = {**{name: m.schema for name, m in zip(MARTS, marts)}, **{name: d.schema for name, d in dimensions.items()}}

    for name in (ENRICHED, *small):
        staged.replace(name, "source_month", months)
    for name in MARTS:
        staged.replace(name, "service_month", touched)
    for name in dimensions:
        staged.replace(name)

    def built() -> Marts:
        tables = [spark.read.schema(schemas[n]).parquet(store.table(n)) for n in (*MARTS, *dimensions)]
        return Marts(*tables)

    return built


def run_months(
    spark: SparkSession,
    store: Store,
    sources: dict[str, str],
    *,
    force: bool = False,
    full_refresh: bool = False,
    cutover: date = contract.COVERAGE_CUTOVER,
) -> DataFrame:
    """Runs the given months, each from its source path, and reports their row counts.

    Every month is gated before any is loaded; a month that fails stops the run there. A month that has landed before
    and is forced is gated aside: what Bronze holds of it is replaced only by a file that passes.
    """
    configure(spark)
    recover(spark, store.root)
    months = expand_months(sources)
    folder, counts, again = staging_folder(store.bronze), {}, []
    try:
        for month in months:
            if force or not has_landed(spark, month, store.bronze):
                require_one_schema(spark, sources[month], month)
        for month in months:
            if force and has_landed(spark, month, store.bronze):
                again.append(month)
                land_month(spark, sources[month], month, folder)
            else:
                land_month(spark, sources[month], month, store.bronze)
        for month in months:
            passed, counts[month] = gate(spark, store, month, bronze_path(month, folder) if month in again else None)
            if not passed:
                raise GateFailed(f"{month}: {counts[month]} rows")
        for month in again:
            replace_folder(spark, bronze_path(month, folder), bronze_path(month, store.bronze))
    finally:
        delete(spark, folder)
    for month in months:
        load_raw(spark, store.bronze, store.raw, month, force=force)
    build_layers(spark, store, None if full_refresh else months, cutover=cutover)
    return spark.createDataFrame([(m, counts[m]) for m in months], "month string, bronze_row_count long")


def parse_months(spark: SparkSession, store: Store, months: Iterable[str]) -> dict[str, int]:
    """Makes the stops of the given months anew from the landed messages and replaces them in their raw table.

    Plans are fetched before the day they are for and changes after it, so messages fetched in the neighbouring months
    are read too. Returns the stops of each month; a month without any loses those it had.
    """
    configure(spark)
    months = expand_months(months)
    fetched = sorted({m for month in months for m in (previous_month(month), month, next_month(month))})
    stops = derive_source_month(message_observations(read_messages(spark, store.messages, fetched)))
    rows = stops.where(F.col("source_month").isin(months)).withColumn("load_month", F.col("source_month"))
    for month in months:
        delete_month(spark, store.raw_messages, month)
    write_raw(rows, store.raw_messages)
    counted = read_raw(spark, store.raw_messages).where(F.col("load_month").isin(months)).groupBy("load_month").count().collect()
    return dict.fromkeys(months, 0) | {r["load_month"]: r["count"] for r in counted}


def run_messages(
    spark: SparkSession, store: Store, months: Iterable[str], *, cutover: date = contract.COVERAGE_CUTOVER
) -> DataFrame:
    """Parses the landed messages of the given months, rebuilds these months and reports their stops. Where the official
    release of a month is loaded too, its stops win."""
    counts = parse_months(spark, store, months)
    build_layers(spark, store, list(counts), cutover=cutover)
    return spark.createDataFrame(list(counts.items()), "month string, message_stop_count long")


def backfill(
    observations: DataFrame,
    file_month: Column,
    store: Store,
    *,
    force: bool = False,
    cutover: date = contract.COVERAGE_CUTOVER,
) -> DataFrame:
    """All months of a release at once: one job writes them aside, one pass gates them, one job loads them.

    Bronze is left alone unless all of them pass; months that have landed before stay unless forced. Reports the rows
    each landed month has and the stops left after deduplication.
    """
    spark = configure(observations.sparkSession)
    recover(spark, store.root)
    if observations.columns != contract.OBSERVATION_COLUMNS:
        raise GateFailed(f"schema: {observations.columns}")
    folder = staging_folder(store.bronze)
    stage_months(observations, file_month, folder)
    try:
        failed = quality.gate_all_months(read_landed(spark, folder)).where(~F.col("passed"))
        if months := sorted(str(r.month) for r in failed.select("month").collect()):
            raise GateFailed(", ".join(months))
        publish_months(spark, folder, store.bronze, force=force)
    finally:
        delete(spark, folder)
    filed = read_landed(spark, store.bronze)
    gated = quality.gate_all_months(filed)
    # Bronze holds a month to a file, so a task meets few months and rows need no second way across the cluster.
    write_raw(filed.select(*contract.OBSERVATION_COLUMNS, F.col("source_month").alias("load_month")), store.raw, many=False)
    build_layers(spark, store, None, cutover=cutover)
    stops = (
        spark.read.parquet(store.table("int_observations_enriched"))
        .groupBy(F.col("source_month").cast("string").alias("month"))
        .agg(F.count("*").alias("stop_count"))
    )
    return gated.select("month", F.col("row_count").alias("bronze_row_count")).join(stops, "month", "left")


def run_month(spark: SparkSession, store: Store, month: str, source: str, **options) -> DataFrame:
    return run_months(spark, store, {month: source}, **options)
