"""Queries over two sources: reconciliation, messages, and which source wins. Differences are planted by rule."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lateline.operators.observations import dedup_latest
from lateline.operators.reconciliation import COMPARED, differences, match_stops, reconcile, verdicts
from lateline.operators.staging import stage_observations, union_sources
from lateline.registry.catalogue import register
from lateline.registry.shop import Shop

# --- reconciliation -----------------------------------------------------------------------------------------


def _altered(stops: DataFrame) -> DataFrame:
    """An official release of the same stops: some are missing and some say other things, by ride and stop number."""
    ride, stop = F.col("train_line_ride_id").cast("int"), F.col("train_line_station_num")
    change = {
        "delay_in_min": F.when(ride % 13 == 1, F.col("delay_in_min") + 1).otherwise(F.col("delay_in_min")),
        "is_canceled": F.when(ride % 17 != 2, F.col("is_canceled")),
        "train_type": F.when(ride % 19 == 3, F.lit("Ersatz")).otherwise(F.col("train_type")),
        "station_name": F.when(stop == 4, F.coalesce("station_name", F.lit("Resolved"))).otherwise(F.col("station_name")),
        "time": F.when(ride % 23 == 4, F.col("time") + F.expr("INTERVAL 1 SECOND")).otherwise(F.col("time")),
    }
    return stops.where((ride % 11 != 0) | (stop != 2)).withColumns(change)


def _sides(s: Shop) -> tuple[DataFrame, DataFrame]:
    """Here lack the stops with number 5 of some rides; one that both lack is nobody's."""
    stops = dedup_latest(s.unioned)
    ride, stop = F.col("train_line_ride_id").cast("int"), F.col("train_line_station_num")
    return stops.where((ride % 7 != 0) | (stop != 5)), _altered(stops)


def _event_sides(s: Shop) -> tuple[DataFrame, DataFrame]:
    stops = dedup_latest(union_sources(monthly=stage_observations(s.event_raw)))
    ride, stop = F.col("train_line_ride_id").cast("int"), F.col("train_line_station_num")
    return stops.where((ride % 7 != 0) | (stop != 5)), _altered(stops)


def _altered_sql(stops: str) -> str:
    return f"""SELECT * REPLACE (
         CASE WHEN CAST(train_line_ride_id AS INT) % 13 = 1 THEN delay_in_min + 1 ELSE delay_in_min END AS delay_in_min,
         CASE WHEN CAST(train_line_ride_id AS INT) % 17 <> 2 THEN is_canceled END AS is_canceled,
         CASE WHEN CAST(train_line_ride_id AS INT) % 19 = 3 THEN 'Ersatz' ELSE train_type END AS train_type,
         CASE WHEN train_line_station_num = 4 THEN coalesce(station_name, 'Resolved') ELSE station_name END AS station_name,
         CASE WHEN CAST(train_line_ride_id AS INT) % 23 = 4 THEN "time" + INTERVAL 1 SECOND ELSE "time" END AS "time")
       FROM {stops} WHERE CAST(train_line_ride_id AS INT) % 11 <> 0 OR train_line_station_num <> 2"""


def _sides_sql(stops: str) -> str:
    return f"""WITH here AS (SELECT * FROM {stops} WHERE CAST(train_line_ride_id AS INT) % 7 <> 0 OR train_line_station_num <> 5),
       there AS ({_altered_sql(stops)}),
       pairs AS (
         SELECT coalesce(h.source_month, t.source_month) AS source_month, h.id IS NOT NULL AS is_here, t.id IS NOT NULL AS is_there,
                coalesce(h.train_line_ride_id, t.train_line_ride_id) AS train_line_ride_id,
                coalesce(h.train_line_station_num, t.train_line_station_num) AS train_line_station_num,
                {", ".join(f'h."{c}" AS h_{c}, t."{c}" AS t_{c}, h.id IS NOT NULL AND t.id IS NOT NULL AND h."{c}" IS DISTINCT FROM t."{c}" AS d_{c}' for c in COMPARED)}
         FROM here h FULL OUTER JOIN there t
           ON h.train_line_ride_id = t.train_line_ride_id AND h.train_line_station_num = t.train_line_station_num
              AND h.source_month = t.source_month)
       """


REPORT_SQL = f"""SELECT source_month, count(*) FILTER (is_here AND is_there) AS matched, count(*) FILTER (NOT is_there) AS only_here,
         count(*) FILTER (NOT is_here) AS only_there, count(*) FILTER ({" OR ".join(f"d_{c}" for c in COMPARED)}) AS differing,
         {", ".join(f"count(*) FILTER (d_{c}) AS differing_{c}" for c in COMPARED)}
       FROM pairs GROUP BY source_month"""

EVENT_STOPS = """(SELECT * EXCLUDE (rk) FROM (
  SELECT *, row_number() OVER (PARTITION BY train_line_ride_id, train_line_station_num ORDER BY "time" DESC, id DESC) AS rk FROM (
    SELECT CAST(event_id AS VARCHAR) AS id, strftime(ts, '%Y-%m') AS source_month, CAST(NULL AS VARCHAR) AS station_name,
           'K' || json_extract_string(props, '$.k') AS xml_station_name, json_extract_string(props, '$.k') AS eva,
           CAST(NULL AS VARCHAR) AS final_destination_station, CAST(user_id AS VARCHAR) AS train_number, CAST(NULL AS VARCHAR) AS line_number,
           event_type AS train_type, CAST(user_id AS VARCHAR) AS train_line_ride_id,
           CAST(json_extract_string(props, '$.k') AS INTEGER) % 7 AS train_line_station_num, CAST(floor(value) AS INTEGER) AS delay_in_min,
           event_type = 'error' AS is_canceled, make_timestamp(CAST(round(epoch_us(ts) / 1e6) AS BIGINT) * 1000000) AS "time",
           CAST(NULL AS TIMESTAMP) AS arrival_planned_time, CAST(NULL AS TIMESTAMP) AS arrival_change_time,
           "time" AS departure_planned_time, "time" AS departure_change_time
    FROM events)) WHERE rk = 1)"""

register("reconcile_months", lambda s: reconcile(*_sides(s)), _sides_sql("deduped") + REPORT_SQL)
register("reconcile_events", lambda s: reconcile(*_event_sides(s)), _sides_sql(EVENT_STOPS) + REPORT_SQL)
register(
    "reconciliation_verdicts",
    lambda s: verdicts(reconcile(*_sides(s))).select("source_month", "missing_share", "surplus_share", "differing_share", "passed"),
    _sides_sql("deduped")
    + f"""SELECT *, coalesce(missing_share <= 0.001 AND surplus_share <= 0.001 AND differing_share <= 0.01, false) AS passed FROM (
         SELECT source_month, only_there / nullif(matched + only_there, 0) AS missing_share,
                only_here / nullif(matched + only_there, 0) AS surplus_share, differing / nullif(matched + only_there, 0) AS differing_share
         FROM ({REPORT_SQL}))""",
)

KEY = "train_line_ride_id, train_line_station_num, source_month"
# Values that both engines write alike; times are compared as numbers in the pairs below.
TEXTS = [c for c in COMPARED if c not in ("is_canceled", "time") and not c.endswith("_time")]
register(
    "reconciliation_differences",
    lambda s: differences(*_sides(s), columns=TEXTS),
    _sides_sql("deduped")
    + "\nUNION ALL ".join(
        [
            f"""SELECT {KEY}, '{c}' AS "column", CAST(h_{c} AS VARCHAR) AS here, CAST(t_{c} AS VARCHAR) AS there FROM pairs WHERE d_{c}"""
            for c in TEXTS
        ]
        + [
            f"""SELECT {KEY}, CASE WHEN is_here THEN 'only_here' ELSE 'only_there' END, NULL, NULL
                FROM pairs WHERE NOT (is_here AND is_there)"""
        ]
    ),
)


def _pairs(s: Shop) -> DataFrame:
    pairs = match_stops(*_sides(s), columns=["time", "is_canceled"])
    return pairs.select(
        "train_line_ride_id", "train_line_station_num", "source_month",
        *[F.unix_micros(F.col(side)["time"]).alias(f"{side}_time") for side in ("here", "there")],
        *[F.col(side)["is_canceled"].alias(f"{side}_is_canceled") for side in ("here", "there")],
    )


register(
    "match_stops",
    _pairs,
    _sides_sql("deduped")
    + f"""SELECT {KEY}, epoch_us(h_time) AS here_time, epoch_us(t_time) AS there_time,
                 h_is_canceled AS here_is_canceled, t_is_canceled AS there_is_canceled FROM pairs""",
)
