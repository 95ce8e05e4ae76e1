"""The observation contract: column names, types and the fixed values the rules depend on."""

from __future__ import annotations

from datetime import date

from pyspark.sql import types as T

# The 17 source columns in file order. Time columns are nanoseconds since the epoch.
OBSERVATION_SCHEMA = T.StructType(
    [
        T.StructField("station_name", T.StringType()),
        T.StructField("xml_station_name", T.StringType()),
        T.StructField("eva", T.StringType()),
        T.StructField("train_number", T.StringType()),
        T.StructField("line_number", T.StringType()),
        T.StructField("final_destination_station", T.StringType()),
        T.StructField("delay_in_min", T.IntegerType()),
        T.StructField("time", T.LongType()),
        T.StructField("is_canceled", T.BooleanType()),
        T.StructField("train_type", T.StringType()),
        T.StructField("train_line_ride_id", T.StringType()),
        T.StructField("train_line_station_num", T.IntegerType()),
        T.StructField("arrival_planned_time", T.LongType()),
        T.StructField("arrival_change_time", T.LongType()),
        T.StructField("departure_planned_time", T.LongType()),
        T.StructField("departure_change_time", T.LongType()),
        T.StructField("id", T.StringType()),
    ]
)
OBSERVATION_COLUMNS = OBSERVATION_SCHEMA.fieldNames()

# What the raw table holds: the contract, the month the row's own time falls in, and the month it was loaded as.
RAW_SCHEMA = T.StructType(
    [*OBSERVATION_SCHEMA.fields, T.StructField("source_month", T.StringType()), T.StructField("load_month", T.StringType())]
)

# Columns that are never null in a sound file.
REQUIRED_COLUMNS = [
    "id",
    "eva",
    "train_number",
    "train_type",
    "train_line_ride_id",
    "train_line_station_num",
    "time",
    "is_canceled",
    "xml_station_name",
    "delay_in_min",
]

TIME_COLUMNS = [
    "time",
    "arrival_planned_time",
    "arrival_change_time",
    "departure_planned_time",
    "departure_change_time",
]

# One logical stop of one ride; the snapshots of a month share it.
STOP_KEY = ["train_line_ride_id", "train_line_station_num", "source_month"]

# Train types that carry no line number.
LONG_DISTANCE_TYPES = [
    "ICE", "IC", "RJ", "NJ", "EC", "ECE", "EN", "WB", "TGV", "IR", "KD", "TER", "SDG", "EST",
    "SOE", "LE", "ES", "D", "GV", "UEX", "Sp", "DBK", "LEO", "ÖBA", "MSM", "UEF", "EUR",
]

# Thresholds of the business rules.
ON_TIME_BELOW_MIN = 6
RANKING_FLOOR = 30
COVERAGE_CUTOVER = date(2025, 11, 2)
DELAY_SANITY_RANGE = (-1446, 1439)
DELAY_BANDS_MIN = [5, 15, 30, 60, 120, 300]
PROFILE_PERCENTILES = [0.01, 0.05, 0.25, 0.50, 0.75, 0.90, 0.95, 0.99]

NS_PER_SECOND = 1_000_000_000
NS_PER_MINUTE = 60 * NS_PER_SECOND
