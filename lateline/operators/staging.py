"""Staging: names, types and decoded times; then the point where sources come together."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lateline.contract import OBSERVATION_COLUMNS, OBSERVATION_SCHEMA, TIME_COLUMNS
from lateline.functions.observation import decode_ns_rounded, decode_ns_truncated

STAGED_TYPES = {
    "id": "string",
    "source_month": "string",
    "station_name": "string",
    "xml_station_name": "string",
    "eva": "string",
    "final_destination_station": "string",
    "train_number": "string",
    "line_number": "string",
    "train_type": "string",
    "train_line_ride_id": "string",
    "train_line_station_num": "int",
    "delay_in_min": "int",
    "is_canceled": "boolean",
}


def stage_observations(raw: DataFrame) -> DataFrame:
    return raw.select(
        *[F.col(name).cast(kind).alias(name) for name, kind in STAGED_TYPES.items()],
        *[decode_ns_rounded(F.col(name).cast("long")).alias(name) for name in TIME_COLUMNS],
    )


def _nanoseconds(column: Column, kind: T.DataType) -> Column:
    """A time column of any type as the contract has it. Text that isn't a time is NULL."""
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.unix_micros(column.cast("timestamp")) * 1000
    if isinstance(kind, T.StringType):
        return F.unix_micros(column.try_cast("timestamp")) * 1000
    return column.try_cast("long")


def align_observations(source: DataFrame) -> DataFrame:
    """Any source of stops in the columns and types of the contract, and its ``source_month`` if it has one.

    A column that the source lacks is NULL, and so is a value that has no counterpart in the contract's type; columns
    that the contract lacks go. Times may be timestamps, ISO text or nanoseconds.
    """

    def aligned(field: T.StructField) -> Column:
        if field.name not in source.columns:
            return F.lit(None).cast(field.dataType)
        if field.name in TIME_COLUMNS:
            return _nanoseconds(F.col(field.name), source.schema[field.name].dataType)
        return F.col(field.name).try_cast(field.dataType)

    month = [F.col("source_month").cast("string")] if "source_month" in source.columns else []
    return source.select(*[aligned(OBSERVATION_SCHEMA[c]).alias(c) for c in OBSERVATION_COLUMNS], *month)


def _need_columns(observations: DataFrame, columns: list[str]) -> None:
    if missing := sorted(set(columns) - set(observations.columns)):
        raise ValueError(f"time columns missing from the schema: {missing}")


def decode_times(observations: DataFrame, columns: list[str] = TIME_COLUMNS, suffix: str = "") -> DataFrame:
    """Truncating decode, in place or next to the raw values when a suffix is given."""
    _need_columns(observations, columns)
    return observations.withColumns({f"{c}{suffix}": decode_ns_truncated(F.col(c)) for c in columns})


def tag_source(staged: DataFrame, source: str) -> DataFrame:
    return staged.withColumn("ingestion_source", F.lit(source))


def union_sources(**staged: DataFrame) -> DataFrame:
    """All sources stacked by column name, each row tagged with the source it came from."""
    return reduce(DataFrame.unionByName, [tag_source(df, source) for source, df in staged.items()])
