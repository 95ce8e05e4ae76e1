"""Queries over the features of a delay forecast."""

from __future__ import annotations

from pyspark.sql import functions as F

from lateline.operators.features import TRAILING_DAYS, delay_features, trailing
from lateline.operators.marts import LINE_KEY, STATION_KEY, delays_by_day
from lateline.registry.catalogue import register

MEASURED = ["station_avg_delay_min", "station_cancellation_rate", "line_avg_delay_min", "line_cancellation_rate"]


def _rounded(df):
    return df.withColumns({c: F.round(c, 6) for c in MEASURED if c in df.columns})


def _trailing_sql(key: str, prefix: str, day: str = "service_date") -> str:
    """Sums over the stops themselves, by a join on the span of days."""
    keys = key.split(", ")
    same = " AND ".join(f"d.{k} IS NOT DISTINCT FROM e.{k}" for k in keys)
    return f"""SELECT {", ".join(f"d.{k}" for k in keys)}, d.service_date, count(e.id) AS {prefix}_stops,
         round(avg(CASE WHEN NOT e.is_canceled THEN e.delay_recomputed_min END), 6) AS {prefix}_avg_delay_min,
         round(count(*) FILTER (e.is_canceled) / nullif(count(e.id), 0), 6) AS {prefix}_cancellation_rate
       FROM (SELECT DISTINCT {key}, {day} AS service_date FROM enriched WHERE {day} IS NOT NULL) d
       LEFT JOIN enriched e ON {same} AND e.service_date BETWEEN d.service_date - {TRAILING_DAYS} AND d.service_date - 1
       GROUP BY {", ".join(f"d.{k}" for k in keys)}, d.service_date"""


STATION_SQL, LINE_SQL = _trailing_sql("eva", "station"), _trailing_sql("train_type, line_number", "line")
register("trailing_station_figures", lambda s: _rounded(trailing(delays_by_day(s.enriched, STATION_KEY), STATION_KEY, "station")), STATION_SQL)
register("trailing_line_figures", lambda s: _rounded(trailing(delays_by_day(s.enriched, LINE_KEY), LINE_KEY, "line")), LINE_SQL)


DUE = "CAST(coalesce(departure_planned_time, arrival_planned_time) AS DATE)"
register(
    "delay_features",
    lambda s: _rounded(delay_features(s.enriched)),
    f"""WITH station_days AS ({_trailing_sql("eva", "station", DUE)}), line_days AS ({_trailing_sql("train_type, line_number", "line", DUE)}),
     due AS (
       SELECT *, coalesce(departure_planned_time, arrival_planned_time) AS due,
              lag("time") OVER along AS before_time, lag(delay_recomputed_min) OVER along AS before_delay, lag(is_canceled) OVER along AS before_canceled,
              CAST(row_number() OVER along - 1 AS INTEGER) AS stops_before
       FROM enriched WINDOW along AS (PARTITION BY train_line_ride_id, source_month ORDER BY train_line_station_num))
     SELECT train_line_ride_id, train_line_station_num, source_month, due.eva, due.train_type, due.line_number,
            CAST(due AS DATE) AS due_date, CAST(extract(hour FROM due) AS INTEGER) AS due_hour, CAST(extract(dow FROM due) AS INTEGER) AS due_weekday_num,
            stops_before, CASE WHEN before_time <= due AND NOT before_canceled THEN before_delay END AS previous_delay_min,
            delay_recomputed_min AS delay_min, station_stops, station_avg_delay_min, station_cancellation_rate,
            line_stops, line_avg_delay_min, line_cancellation_rate
     FROM due
     LEFT JOIN station_days s ON s.eva IS NOT DISTINCT FROM due.eva AND s.service_date = CAST(due AS DATE)
     LEFT JOIN line_days l ON l.train_type IS NOT DISTINCT FROM due.train_type AND l.line_number IS NOT DISTINCT FROM due.line_number
          AND l.service_date = CAST(due AS DATE)
     WHERE NOT is_canceled AND delay_recomputed_min IS NOT NULL""",
)
