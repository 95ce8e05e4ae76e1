"""Observations made from the driver's tables, so every operator runs on them.

Order lines stand for snapshots: the supplier is the ride, the line number the stop, the supplier's nation the
station, the part's type and brand the train type and line.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lateline.contract import NS_PER_MINUTE, OBSERVATION_COLUMNS
from lateline.functions.observation import decode_ns_truncated, month_of

# The coverage change, moved into the data's years and to the middle of a month on purpose.
CUTOVER = date(1998, 6, 15)
# Part types that play the long-distance types.
LONG_DISTANCE = ("PROMO", "ECONOMY")


def _epoch_ns(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp")) * 1000


def order_line_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No join hints: suppliers and parts grow with the data, so their sides are broadcast only if their size allows.

    What is shuffled for these joins is kept narrow: of an order line what the observation takes from it, and the names
    of stations and regions come last.
    """
    read = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    canceled = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F") & (F.col("l_discount") >= 0.07)
    lines = (
        read("lineitem")
        .select(
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate",
            (F.col("l_quantity").cast("int") - 8).alias("delay_in_min"), canceled.alias("is_canceled"),
        )
        .join(read("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(read("part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(read("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(read("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    delay = F.col("delay_in_min")
    planned = _epoch_ns(F.col("l_shipdate")) + (F.col("l_partkey") % 1440) * NS_PER_MINUTE
    change = planned + delay * NS_PER_MINUTE
    shipped = F.col("l_shipdate")
    ship_day = F.year(shipped) * 10000 + F.month(shipped) * 100 + F.dayofmonth(shipped)
    first, last = F.col("l_linenumber") == 1, F.col("l_linenumber") == 7
    return lines.select(
        F.when(F.col("n_nationkey") != 24, F.col("n_name")).alias("station_name"),
        F.when(F.col("l_linenumber") % 3 == 0, F.concat("n_name", F.lit(" Hbf")))
        .otherwise(F.col("n_name"))
        .alias("xml_station_name"),
        F.col("n_nationkey").cast("string").alias("eva"),
        F.col("l_orderkey").cast("string").alias("train_number"),
        F.when(~F.col("p_type").isin(*LONG_DISTANCE), F.col("p_brand")).alias("line_number"),
        F.col("r_name").alias("final_destination_station"),
        delay,
        change.alias("time"),
        "is_canceled",
        F.col("p_type").alias("train_type"),
        F.col("l_suppkey").cast("string").alias("train_line_ride_id"),
        F.col("l_linenumber").alias("train_line_station_num"),
        F.when(~first, planned).alias("arrival_planned_time"),
        F.when(~first, change).alias("arrival_change_time"),
        F.when(~last, planned).alias("departure_planned_time"),
        F.when(~last, change).alias("departure_change_time"),
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", ship_day).alias("id"),
    ).select(*OBSERVATION_COLUMNS)


def planned_month() -> Column:
    """The month a row is filed under. Delays carry some rows into the next or the previous month."""
    return month_of(decode_ns_truncated(F.coalesce("departure_planned_time", "arrival_planned_time")))


def event_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as heavily repeated snapshots of few stops, at times that are not whole minutes or seconds."""
    k = F.get_json_object("props", "$.k").cast("int")
    at, no_time = _epoch_ns(F.col("ts")), F.lit(None).cast("long")
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(
        F.lit(None).cast("string").alias("station_name"),
        F.concat(F.lit("K"), k.cast("string")).alias("xml_station_name"),
        k.cast("string").alias("eva"),
        F.col("user_id").cast("string").alias("train_number"),
        F.lit(None).cast("string").alias("line_number"),
        F.lit(None).cast("string").alias("final_destination_station"),
        F.floor("value").cast("int").alias("delay_in_min"),
        at.alias("time"),
        (F.col("event_type") == "error").alias("is_canceled"),
        F.col("event_type").alias("train_type"),
        F.col("user_id").cast("string").alias("train_line_ride_id"),
        (k % 7).alias("train_line_station_num"),
        no_time.alias("arrival_planned_time"),
        no_time.alias("arrival_change_time"),
        at.alias("departure_planned_time"),
        at.alias("departure_change_time"),
        F.col("event_id").cast("string").alias("id"),
    )
