"""Features of a delay forecast: what was known before a stop was due, and nothing later."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lateline.functions import observation as obs
from lateline.operators.marts import LINE_KEY, STATION_KEY, delays_by_day

#: Days before the day of a stop that its station's and its line's figures cover.
TRAILING_DAYS = 7


def planned_time() -> Column:
    return F.coalesce("departure_planned_time", "arrival_planned_time")


def trailing(
    by_day: DataFrame, key: list[str], prefix: str, days: int = TRAILING_DAYS, wanted: DataFrame | None = None
) -> DataFrame:
    """For each key and day the figures of the ``days`` days before, the day itself left out: stops, average delay of
    those that ran, share canceled. Without any stop in that span there are no stops and no figures.

    The days are those that the key has counts of, or the ``wanted`` ones (the key and ``service_date``). The window runs over counts, one row for each key and day, however many stops those stand for.
    """
    ran = ~F.col("is_canceled")
    daily = by_day.where("service_date IS NOT NULL").groupBy(*key, "service_date").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("is_canceled"), F.col("n")).otherwise(0)).alias("canceled"),
        F.sum(F.when(ran, F.col("delay") * F.col("n"))).alias("delay"),
        F.sum(F.when(ran & F.col("delay").isNotNull(), F.col("n"))).alias("delayed"),
    )
    if wanted is not None:
        # Asked for without regard to what came on the day itself, which wasn't known before.
        asked = wanted.where("service_date IS NOT NULL").select(*key, "service_date", F.lit(True).alias("asked")).distinct()
        daily = daily.withColumn("asked", F.lit(False)).unionByName(asked, allowMissingColumns=True)
        sums = [F.sum(c).alias(c) for c in ("n", "canceled", "delay", "delayed")]
        daily = daily.groupBy(*key, "service_date").agg(*sums, F.max("asked").alias("asked"))
    before = Window.partitionBy(*key).orderBy(F.unix_date("service_date")).rangeBetween(-days, -1)
    total = lambda c: F.sum(c).over(before)
    figures = daily.select(
        *daily.columns,
        F.coalesce(total("n"), F.lit(0)).alias(f"{prefix}_stops"),
        obs.ratio(total("delay"), total("delayed")).alias(f"{prefix}_avg_delay_min"),
        obs.ratio(total("canceled"), total("n")).alias(f"{prefix}_cancellation_rate"),
    )
    kept = figures if wanted is None else figures.where("asked")
    return kept.select(*key, "service_date", f"{prefix}_stops", f"{prefix}_avg_delay_min", f"{prefix}_cancellation_rate")


def delay_features(
    enriched: DataFrame, station_days: DataFrame | None = None, line_days: DataFrame | None = None, days: int = TRAILING_DAYS
) -> DataFrame:
    """One row for each stop that ran and has a delay: its key, features, and the delay to forecast.

    ``previous_delay_min`` is that of the stop before on the ride, if that was over when this one was due. Station and
    line figures are of whole days before the one that the stop was due on, whatever day it came. States of days that
    are stored already may be passed.
    """
    station_days = delays_by_day(enriched, STATION_KEY) if station_days is None else station_days
    line_days = delays_by_day(enriched, LINE_KEY) if line_days is None else line_days
    along = Window.partitionBy("train_line_ride_id", "source_month").orderBy("train_line_station_num")
    stops = enriched.withColumn("due", planned_time()).withColumns({
        "before": F.lag(F.struct("time", "delay_recomputed_min", "is_canceled")).over(along),
        "stops_before": F.row_number().over(along) - 1,
    })
    over = (F.col("before.time") <= F.col("due")) & ~F.col("before.is_canceled")
    rows = stops.where(~F.col("is_canceled") & F.col("delay_recomputed_min").isNotNull()).select(
        "train_line_ride_id",
        "train_line_station_num",
        "source_month",
        "eva",
        *LINE_KEY,
        F.to_date("due").alias("due_date"),
        F.hour("due").alias("due_hour"),
        obs.weekday_num(F.col("due")).alias("due_weekday_num"),
        "stops_before",
        F.when(over, F.col("before.delay_recomputed_min")).alias("previous_delay_min"),
        F.col("delay_recomputed_min").alias("delay_min"),
    )
    for key, by_day, prefix in ((STATION_KEY, station_days, "station"), (LINE_KEY, line_days, "line")):
        figures = trailing(by_day, key, prefix, days, rows.select(*key, F.col("due_date").alias("service_date")))
        renamed = figures.select(*[F.col(c).alias(f"of_{c}") for c in (*key, "service_date")], *figures.columns[len(key) + 1 :])
        same = F.col("due_date") == F.col("of_service_date")
        for c in key:
            same = same & F.col(c).eqNullSafe(F.col(f"of_{c}"))
        rows = rows.join(renamed, same, "left").drop(*[f"of_{c}" for c in (*key, "service_date")])
    return rows
