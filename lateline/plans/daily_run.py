"""Daily marts: delays counted by day are kept, a late day is counted anew alone, and months are merged from days.

The tables are cut by month, so that years of days don't make thousands of small files: where a day is replaced, the
counted rows of the other days of its month are copied, and no stop of theirs is read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lateline.contract import RANKING_FLOOR
from lateline.functions import observation as obs
from lateline.operators.marts import LINE_KEY, STATION_KEY, daily_performance, delays_by_day, monthly_from_days
from lateline.plans.monthly_run import ENRICHED, Store, around_months
from lateline.plans.publication import Staged, recover
from lateline.workspace import configure, path_exists, sized_shuffles, stored_bytes

#: The counted delays and the mart of each kind, all cut by service month.
STATES = {"station_delays_by_day": STATION_KEY, "line_delays_by_day": LINE_KEY}
DAILY_MARTS = {
    "mart_daily_station_perf": ("station_delays_by_day", STATION_KEY),
    "mart_daily_line_perf": ("line_delays_by_day", LINE_KEY),
}

DAY, MONTH = "service_date", "service_month"
STATE_TYPES = f"{DAY} date, station_coverage_era string, is_canceled boolean, is_on_time boolean, delay bigint, n bigint, {MONTH} date"


def read_by_day(spark: SparkSession, store: Store, name: str) -> DataFrame:
    """A stored state; an absent one reads as an empty one."""
    key = STATES[name]
    schema = T._parse_datatype_string(", ".join(f"{k} string" for k in key) + ", " + STATE_TYPES)
    if not path_exists(spark, store.table(name)):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(store.table(name))


def _in(column: str, days: list[date | None]) -> Column:
    """Whether a date is one of the given ones; None is one that is not known."""
    known = [d for d in days if d is not None]
    among = F.coalesce(F.col(column).isin(known), F.lit(False)) if known else F.lit(False)
    return among | F.col(column).isNull() if None in days else among


def _of_days(table: DataFrame, days: list[date | None]) -> DataFrame:
    return table.where(_in(DAY, days))


def service_days(rows: DataFrame) -> list[date | None]:
    """The days that rows fall into, a few for a late batch."""
    return [r[0] for r in rows.select(DAY).distinct().collect()]


def refresh_days(
    spark: SparkSession, store: Store, days: Iterable[date | None] | None = None, *, floor: int = RANKING_FLOOR
) -> None:
    """Counts the stored stops of the given days anew and replaces the states and daily marts of these days, no others.

    With days, only the source months that may hold their rows are read; a day that has lost all its rows goes. None
    makes all days anew. The tables are written aside and published together; a run that breaks off before that leaves
    all days as they were.
    """
    configure(spark)
    recover(spark, store.root)
    enriched = spark.read.parquet(store.table(ENRICHED)).withColumn("source_month", F.col("source_month").cast("string"))
    months = None
    if days is not None:
        days = list(days)
        months = sorted({d.replace(day=1).isoformat() if d else "__HIVE_DEFAULT_PARTITION__" for d in days})
        if None not in days:  # a row without a time has no month either, so it may be in any folder
            enriched = enriched.where(F.col("source_month").isin(around_months([d.isoformat() for d in days])))
        enriched = _of_days(enriched, days)
    staged = Staged(spark, store.root, uuid.uuid4().hex)

    def stage(fresh: DataFrame, name: str) -> DataFrame:
        """Fresh days beside the stored other days of their months."""
        cut = fresh.withColumn(MONTH, obs.service_month(F.col(DAY)))
        if days is not None:
            kept = staged.stored(name, cut)
            cut = kept.where(_in(MONTH, [d and d.replace(day=1) for d in days]) & ~_in(DAY, days)).unionByName(cut)
        written = staged.write(cut, name, MONTH)
        staged.replace(name, MONTH, months)
        return written

    try:
        with sized_shuffles(spark, stored_bytes(spark, store.table(ENRICHED)) if days is None else 0):
            for mart, (name, key) in DAILY_MARTS.items():
                counts = stage(delays_by_day(enriched, key), name)
                own = counts if days is None else _of_days(counts, days)
                stage(daily_performance(own, key, floor), mart)
        staged.publish()
    finally:
        staged.discard()


def monthly_marts(spark: SparkSession, store: Store, *, floor: int = RANKING_FLOOR) -> dict[str, DataFrame]:
    """The monthly marts merged from the stored days."""
    names = {"mart_monthly_station_perf": "station_delays_by_day", "mart_monthly_line_perf": "line_delays_by_day"}
    return {mart: monthly_from_days(read_by_day(spark, store, name), STATES[name], floor) for mart, name in names.items()}
