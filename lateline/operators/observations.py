"""From staged snapshots to one enriched row per stop."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lateline import contract
from lateline.functions import observation as obs

DEDUPED_COLUMNS = [
    "id",
    "source_month",
    "ingestion_source",
    "station_name",
    "xml_station_name",
    "eva",
    "final_destination_station",
    "train_number",
    "line_number",
    "train_type",
    "train_line_ride_id",
    "train_line_station_num",
    "delay_in_min",
    "is_canceled",
    "time",
    "arrival_planned_time",
    "arrival_change_time",
    "departure_planned_time",
    "departure_change_time",
]


def dedup_latest(unioned: DataFrame, precedence: Sequence[str] = ()) -> DataFrame:
    """The last snapshot of each stop and month; the larger id wins among equal times.

    Where several sources know a stop, one that ``precedence`` names earlier wins whatever its times; sources that it
    doesn't name are equal and come last.

    ``row_number() = 1`` makes Catalyst put a group limit in front of the shuffle: every task sends on at most one
    row per stop, so a stop with very many snapshots reaches its reducer as one row per task, not as all of them.
    """
    order = [F.desc_nulls_first("time"), F.desc_nulls_first("id")]
    if precedence:
        place = F.array_position(F.array(*[F.lit(source) for source in precedence]), F.col("ingestion_source"))
        order.insert(0, F.asc_nulls_last(F.nullif(place, F.lit(0))))
    latest_first = Window.partitionBy(*contract.STOP_KEY).orderBy(*order)
    return (
        unioned.select(*DEDUPED_COLUMNS, F.row_number().over(latest_first).alias("observation_rank"))
        .where(F.col("observation_rank") == 1)
        .drop("observation_rank")
    )


def add_delay(observations: DataFrame) -> DataFrame:
    return observations.withColumn("delay_basis", obs.delay_basis()).withColumn(
        "delay_recomputed_min", obs.delay_recomputed_min(F.col("delay_basis"))
    )


def add_calendar(observations: DataFrame, cutover: date = contract.COVERAGE_CUTOVER) -> DataFrame:
    at = F.col("time")
    return observations.withColumns(
        {
            "service_date": F.to_date(at),
            "service_hour": F.hour(at),
            "service_weekday_num": obs.weekday_num(at),
            "service_weekday_name": obs.weekday_name(at),
            "is_weekend": obs.is_weekend(obs.weekday_name(at)),
            "station_coverage_era": obs.coverage_era(F.to_date(at), cutover),
        }
    )


def enrich(
    deduped: DataFrame,
    *,
    cutover: date = contract.COVERAGE_CUTOVER,
    on_time_below: int = contract.ON_TIME_BELOW_MIN,
) -> DataFrame:
    return (
        deduped.transform(add_delay)
        .transform(add_calendar, cutover)
        .withColumn("is_on_time", obs.is_on_time(F.col("delay_recomputed_min"), on_time_below))
    )
