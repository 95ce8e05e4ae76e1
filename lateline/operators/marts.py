"""Monthly performance marts and their dimensions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lateline.contract import RANKING_FLOOR
from lateline.functions import observation as obs

STATION_KEY = ["eva"]
LINE_KEY = ["train_type", "line_number"]
PERCENTILES = {"median_delay_min": 0.5, "p90_delay_min": 0.9, "p95_delay_min": 0.95, "p99_delay_min": 0.99}


COUNTED = ["station_coverage_era", "is_canceled", "is_on_time", "delay"]


def count_delays(enriched: DataFrame, key: list[str], period: Column) -> DataFrame:
    """Rows counted by key, period, coverage era, cancellation and delay.

    This is the only step that meets every observation, and a plain count is what Spark combines best before a
    shuffle: generated hash aggregation on the map side, one record per distinct delay after it. A key that holds a
    third of all rows is thereby a few thousand records per task, spread over reducers by delay.
    """
    return enriched.groupBy(
        *key,
        period,
        "station_coverage_era",
        "is_canceled",
        "is_on_time",
        F.col("delay_recomputed_min").alias("delay"),
    ).agg(F.count("*").alias("n"))


def delay_histogram(enriched: DataFrame, key: list[str]) -> DataFrame:
    return count_delays(enriched, key, obs.service_month(F.col("service_date")).alias("service_month"))


def delays_by_day(enriched: DataFrame, key: list[str]) -> DataFrame:
    """The state that daily and monthly figures are made from: counts of days add up to those of any longer period."""
    return count_delays(enriched, key, F.col("service_date"))


def delays_by_month(by_day: DataFrame, key: list[str]) -> DataFrame:
    """Months from days; no observation is read again."""
    month = obs.service_month(F.col("service_date")).alias("service_month")
    return by_day.groupBy(*key, month, *COUNTED).agg(F.sum("n").alias("n"))


def performance(counts: DataFrame, key: list[str], period: str, floor: int = RANKING_FLOOR) -> DataFrame:
    """Counts, exact percentiles and rates by key, period and coverage era, from counted delays.

    Canceled rows count as observations and for the cancellation rate only. A row that is neither canceled nor not
    canceled (NULL) is an observation and nothing else.
    """
    ran = ~F.col("is_canceled")
    n, delay = F.col("n"), F.when(ran, F.col("delay"))
    levels = F.percentile(delay, F.array(*[F.lit(p) for p in PERCENTILES.values()]), n)
    totals = counts.groupBy(*key, period, "station_coverage_era").agg(
        F.sum(n).alias("observation_count"),
        F.sum(F.when(F.col("is_canceled"), n).otherwise(0)).alias("cancellation_count"),
        F.sum(F.when(ran, n).otherwise(0)).alias("non_canceled_observation_count"),
        F.sum(delay * n).alias("delay_sum"),
        F.sum(F.when(delay.isNotNull(), n)).alias("delay_rows"),
        levels.alias("levels"),
        F.sum(F.when(ran & F.col("is_on_time"), n).otherwise(0)).alias("on_time_count"),
    )
    return totals.select(
        *key,
        period,
        "station_coverage_era",
        "observation_count",
        "cancellation_count",
        "non_canceled_observation_count",
        obs.ratio(F.col("delay_sum"), F.col("delay_rows")).alias("avg_delay_min"),
        *[F.col("levels")[i].alias(name) for i, name in enumerate(PERCENTILES)],
        "on_time_count",
        obs.ratio(F.col("cancellation_count"), F.col("observation_count")).alias("cancellation_rate"),
        obs.ratio(F.col("on_time_count"), F.col("non_canceled_observation_count")).alias("on_time_rate"),
        obs.eligible_for_ranking(F.col("observation_count"), floor).alias("eligible_for_ranking"),
    )


def monthly_performance(enriched: DataFrame, key: list[str], floor: int = RANKING_FLOOR) -> DataFrame:
    return performance(delay_histogram(enriched, key), key, "service_month", floor)


def daily_performance(by_day: DataFrame, key: list[str], floor: int = RANKING_FLOOR) -> DataFrame:
    return performance(by_day, key, "service_date", floor)


def monthly_from_days(by_day: DataFrame, key: list[str], floor: int = RANKING_FLOOR) -> DataFrame:
    """Equal to ``monthly_performance`` of the rows that the days were counted from."""
    return performance(delays_by_month(by_day, key), key, "service_month", floor)


def mart_monthly_station_perf(enriched: DataFrame, floor: int = RANKING_FLOOR) -> DataFrame:
    return monthly_performance(enriched, STATION_KEY, floor)


def mart_monthly_line_perf(enriched: DataFrame, floor: int = RANKING_FLOOR) -> DataFrame:
    """A NULL line is a group of its own."""
    return monthly_performance(enriched, LINE_KEY, floor)


def dim_station(enriched: DataFrame) -> DataFrame:
    """One row per station code, named by the resolved name or else by the feed's own.

    Rows collapse to distinct name pairs on the map side first, so no station's rows meet in one task.
    """
    names = enriched.select("eva", "station_name", "xml_station_name").distinct()
    return names.groupBy("eva").agg(
        F.coalesce(F.max("station_name"), F.max("xml_station_name")).alias("station_name"),
        F.count_distinct("xml_station_name").alias("xml_station_name_variant_count"),
    )


def dim_train_line(enriched: DataFrame) -> DataFrame:
    return enriched.select("train_type", "line_number").distinct()


def dim_service_month(station_mart: DataFrame) -> DataFrame:
    months = station_mart.select("service_month").where(F.col("service_month").isNotNull()).distinct()
    return months.select("service_month", *obs.month_attributes(F.col("service_month")))


@dataclass(frozen=True)
class Marts:
    """The five tables the dashboard queries read."""

    station_perf: DataFrame
    line_perf: DataFrame
    dim_station: DataFrame
    dim_train_line: DataFrame
    dim_service_month: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return {
            "mart_monthly_station_perf": self.station_perf,
            "mart_monthly_line_perf": self.line_perf,
            "dim_station": self.dim_station,
            "dim_train_line": self.dim_train_line,
            "dim_service_month": self.dim_service_month,
        }
