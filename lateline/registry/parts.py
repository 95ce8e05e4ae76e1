"""Steps that otherwise only occur inside a larger query, each over its whole table."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lateline.functions import metrics
from lateline.functions import observation as obs
from lateline.plans import reports
from lateline.plans.reports import Filters
from lateline.registry.catalogue import register
from lateline.registry.dashboard import IN_YEAR, MONTH, SELECTED, TWO_MONTHS, YEAR_MONTH
from lateline.registry.shop import Shop
from lateline.registry.sql import CANCELED, DELAY, ON_TIME, VOLUME
from lateline.registry.tables import rounded
from lateline.sources import sinks
from lateline.sources.bronze import land_months, read_landed

STATION_GRAIN = ["eva", "service_month", "station_coverage_era"]


def _landed_again(s: Shop) -> DataFrame:
    """Months that have landed stay, whatever comes later, unless they are forced.

    Half of the rows of the early months land first; then everything comes, which only adds the other months; then one
    early month is forced.
    """
    root = f"{s.space.path('landed_again')}-{uuid.uuid4().hex[:8]}"
    month, half = F.col("source_month"), F.col("train_line_station_num") % 2 == 0
    land_months(s.raw.where((month < "1995") & half), month, root)
    land_months(s.raw, month, root)
    land_months(s.raw.where(month == "1994-05"), month, root, force=True)
    return read_landed(s.spark, root).groupBy("source_month").agg(F.count("*").alias("row_count"))


register(
    "land_months",
    _landed_again,
    """SELECT source_month, count(*) AS row_count FROM raw
       WHERE source_month >= '1995' OR source_month = '1994-05' OR train_line_station_num % 2 = 0 GROUP BY source_month""",
)


def _stored(s: Shop) -> DataFrame:
    """The union as a view, and a table written from it."""
    by_type = sinks.save_view(s.unioned, "lateline_unioned").groupBy("train_type").agg(F.count("*").alias("row_count"))
    return s.space.table("rows_by_type", lambda: by_type)


register("materialize", _stored, "SELECT train_type, count(*) AS row_count FROM unioned GROUP BY train_type")

register(
    "rate",
    lambda s: rounded(
        s.enriched.groupBy("train_type", "eva")
        .agg(F.count_if("is_canceled").alias("canceled"), F.count_if(~F.col("is_canceled")).alias("ran"))
        .select(
            "train_type",
            "eva",
            obs.ratio(F.col("canceled"), F.col("ran")).alias("canceled_per_run"),
            obs.pct(F.col("canceled"), F.col("canceled") + F.col("ran"), 1).alias("canceled_pct"),
        ),
        ["canceled_per_run"],
    ),
    """SELECT train_type, eva,
              round(CAST(count(*) FILTER (is_canceled) AS DOUBLE) / nullif(count(*) FILTER (NOT is_canceled), 0), 6)
                AS canceled_per_run,
              round(100.0 * count(*) FILTER (is_canceled) / nullif(count(*), 0), 1) AS canceled_pct
       FROM enriched GROUP BY train_type, eva""",
)
register(
    "eligible_for_ranking",
    lambda s: s.enriched.groupBy("eva", obs.service_month(F.col("service_date")).alias("service_month"))
    .agg(F.count("*").alias("n"))
    .select("eva", "service_month", obs.eligible_for_ranking(F.col("n")).alias("eligible")),
    """SELECT eva, CAST(date_trunc('month', service_date) AS DATE) AS service_month, count(*) >= 30 AS eligible
       FROM enriched GROUP BY eva, date_trunc('month', service_date)""",
)


def _optionally_filtered(s: Shop) -> DataFrame:
    """Filters that are set narrow the rows; those left out do not."""
    rows, f = s.enriched, Filters(category=["AR", "ECON"], line=None)
    chosen = [*reports.contains(rows["train_type"], f.category), *reports.equals(rows["line_number"], f.line)]
    return reports.where_all(rows, chosen).groupBy("train_type", "line_number").agg(F.count("*").alias("row_count"))


register(
    "optional_filters",
    _optionally_filtered,
    """SELECT train_type, line_number, count(*) AS row_count FROM enriched
       WHERE train_type LIKE '%AR%' OR train_type LIKE '%ECON%' GROUP BY train_type, line_number""",
)
register(
    "volume_floor",
    lambda s: reports.with_volume(s.marts.line_perf, [F.col("train_type"), F.col("line_number"), F.col("service_month")], reports.ACTIVITY),
    f"""SELECT m.train_type, m.line_number, m.service_month, {VOLUME} AS activity_volume
        FROM line_perf m GROUP BY m.train_type, m.line_number, m.service_month
        HAVING sum(m.observation_count) >= 30 AND sum(m.non_canceled_observation_count) > 0""",
)
register(
    "join_station_names",
    lambda s: reports.at_stations(s.marts.station_perf, s.marts, Filters()).select(*STATION_GRAIN, "station_name", "observation_count"),
    """SELECT m.eva, m.service_month, m.station_coverage_era, s.station_name, m.observation_count
       FROM station_perf m JOIN dim_station s ON m.eva = s.eva""",
)
register(
    "rows_in_period",
    lambda s: reports.in_period(s.marts.line_perf, s.marts, YEAR_MONTH).select("train_type", "line_number", "service_month", "observation_count"),
    f"""SELECT m.train_type, m.line_number, m.service_month, m.observation_count FROM line_perf m
        JOIN dim_service_month d ON m.service_month = d.service_month WHERE {IN_YEAR} AND d.month_label = '{MONTH}'""",
)
register(
    "join_month_labels",
    lambda s: s.marts.line_perf.join(s.marts.dim_service_month, "service_month").select(
        "train_type", "line_number", "station_coverage_era", "month_label", "service_year", "observation_count"
    ),
    """SELECT m.train_type, m.line_number, m.station_coverage_era, d.month_label, d.service_year, m.observation_count
       FROM line_perf m JOIN dim_service_month d ON m.service_month = d.service_month""",
)
register(
    "selected_and_previous_month",
    lambda s: reports.selected_and_previous(s.marts.station_perf, s.marts, YEAR_MONTH).select(
        *STATION_GRAIN, "observation_count"
    ),
    f"SELECT eva, service_month, station_coverage_era, observation_count FROM station_perf m WHERE {TWO_MONTHS}",
)
register(
    "latest_month",
    lambda s: s.marts.dim_service_month.agg(F.max("service_month").alias("latest_month")).withColumn(
        "selected_month", reports.selected_month(s.marts, YEAR_MONTH)
    ),
    f"SELECT max(service_month) AS latest_month, {SELECTED} AS selected_month FROM dim_service_month",
)
register(
    "weighted_measures",
    lambda s: s.marts.station_perf.groupBy("eva").agg(
        metrics.weighted_delay().alias("average_delay_min"),
        metrics.on_time_pct().alias("on_time_rate_pct"),
        metrics.cancellation_pct().alias("cancellation_rate_pct"),
    ),
    f"""SELECT m.eva, {DELAY} AS average_delay_min, {ON_TIME} AS on_time_rate_pct, {CANCELED} AS cancellation_rate_pct
        FROM station_perf m GROUP BY m.eva""",
)
register(
    "highest_percentiles",
    lambda s: rounded(
        s.marts.station_perf.groupBy("service_month").agg(
            F.max("median_delay_min").alias("median_delay_min"), F.max("p90_delay_min").alias("p90_delay_min")
        ),
        ["median_delay_min", "p90_delay_min"],
    ),
    """SELECT service_month, round(max(median_delay_min), 6) AS median_delay_min,
              round(max(p90_delay_min), 6) AS p90_delay_min FROM station_perf GROUP BY service_month""",
)
