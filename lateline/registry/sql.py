"""The same steps in SQL, as common table expressions for the comparison engine. Written apart from the Spark code."""

from __future__ import annotations

CUTOVER = "DATE '1998-06-15'"

STEPS = f"""
WITH lines AS (
  SELECT l.*, n_nationkey, n_name, r_name, p_type, p_brand,
         CAST(l_quantity AS INTEGER) - 8 AS delay,
         epoch_us(l_shipdate) * 1000 + (l_partkey % 1440) * 60000000000 AS planned
  FROM lineitem l
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  JOIN part ON l_partkey = p_partkey
),
filed AS (
  SELECT CASE WHEN n_nationkey = 24 THEN NULL ELSE n_name END AS station_name,
         CASE WHEN l_linenumber % 3 = 0 THEN n_name || ' Hbf' ELSE n_name END AS xml_station_name,
         CAST(n_nationkey AS VARCHAR) AS eva,
         CAST(l_orderkey AS VARCHAR) AS train_number,
         CASE WHEN p_type IN ('PROMO', 'ECONOMY') THEN NULL ELSE p_brand END AS line_number,
         r_name AS final_destination_station,
         delay AS delay_in_min,
         planned + delay * 60000000000 AS "time",
         l_returnflag = 'R' AND l_linestatus = 'F' AND l_discount >= 0.07 AS is_canceled,
         p_type AS train_type,
         CAST(l_suppkey AS VARCHAR) AS train_line_ride_id,
         l_linenumber AS train_line_station_num,
         CASE WHEN l_linenumber <> 1 THEN planned END AS arrival_planned_time,
         CASE WHEN l_linenumber <> 1 THEN planned + delay * 60000000000 END AS arrival_change_time,
         CASE WHEN l_linenumber <> 7 THEN planned END AS departure_planned_time,
         CASE WHEN l_linenumber <> 7 THEN planned + delay * 60000000000 END AS departure_change_time,
         l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-'
           || strftime(l_shipdate, '%Y%m%d') AS id,
         strftime(make_timestamp(planned // 1000), '%Y-%m') AS file_month
  FROM lines
),
raw AS (
  SELECT *, strftime(make_timestamp("time" // 1000), '%Y-%m') AS source_month FROM filed
),
event_raw AS (
  SELECT CAST(event_id AS VARCHAR) AS id, CAST(user_id AS VARCHAR) AS train_line_ride_id,
         CAST(json_extract_string(props, '$.k') AS INTEGER) % 7 AS train_line_station_num,
         epoch_us(ts) * 1000 AS "time", event_type AS train_type, event_type = 'error' AS is_canceled,
         strftime(ts, '%Y-%m') AS source_month
  FROM events
),
staged AS (
  SELECT id, source_month, station_name, xml_station_name, eva, final_destination_station, train_number,
         line_number, train_type, train_line_ride_id, train_line_station_num, delay_in_min, is_canceled,
         make_timestamp(CAST(round("time" / 1e9) AS BIGINT) * 1000000) AS "time",
         make_timestamp(CAST(round(arrival_planned_time / 1e9) AS BIGINT) * 1000000) AS arrival_planned_time,
         make_timestamp(CAST(round(arrival_change_time / 1e9) AS BIGINT) * 1000000) AS arrival_change_time,
         make_timestamp(CAST(round(departure_planned_time / 1e9) AS BIGINT) * 1000000) AS departure_planned_time,
         make_timestamp(CAST(round(departure_change_time / 1e9) AS BIGINT) * 1000000) AS departure_change_time
  FROM raw
),
unioned AS (SELECT *, 'monthly' AS ingestion_source FROM staged),
deduped AS (
  SELECT * EXCLUDE (rk) FROM (
    SELECT *, row_number() OVER (PARTITION BY train_line_ride_id, train_line_station_num, source_month
                                 ORDER BY "time" DESC NULLS FIRST, id DESC NULLS FIRST) AS rk
    FROM unioned)
  WHERE rk = 1
),
"""


def enrichment(source: str, name: str) -> str:
    return f"""{name} AS (
  SELECT *, delay_recomputed_min < 6 AS is_on_time FROM (
    SELECT *,
           CASE WHEN delay_basis = 'departure'
                THEN date_diff('minute', departure_planned_time, departure_change_time)
                ELSE date_diff('minute', arrival_planned_time, arrival_change_time) END AS delay_recomputed_min,
           CAST("time" AS DATE) AS service_date,
           CAST(extract(hour FROM "time") AS INTEGER) AS service_hour,
           CAST(extract(dow FROM "time") AS INTEGER) AS service_weekday_num,
           strftime("time", '%a') AS service_weekday_name,
           strftime("time", '%a') IN ('Sat', 'Sun') AS is_weekend,
           CASE WHEN CAST("time" AS DATE) < {CUTOVER} THEN 'limited_coverage' ELSE 'full_coverage' END
             AS station_coverage_era
    FROM (
      SELECT *, CASE WHEN departure_planned_time IS NOT NULL AND departure_change_time IS NOT NULL
                     THEN 'departure' ELSE 'arrival' END AS delay_basis
      FROM {source}))
)"""


def performance(name: str, key: str) -> str:
    ran = "CASE WHEN NOT is_canceled THEN delay_recomputed_min END"
    return f"""{name} AS (
  SELECT *, CAST(cancellation_count AS DOUBLE) / nullif(observation_count, 0) AS cancellation_rate,
         CAST(on_time_count AS DOUBLE) / nullif(non_canceled_observation_count, 0) AS on_time_rate,
         observation_count >= 30 AS eligible_for_ranking
  FROM (
    SELECT {key}, CAST(date_trunc('month', service_date) AS DATE) AS service_month, station_coverage_era,
           count(*) AS observation_count,
           CAST(sum(CASE WHEN is_canceled THEN 1 ELSE 0 END) AS BIGINT) AS cancellation_count,
           count(CASE WHEN NOT is_canceled THEN 1 END) AS non_canceled_observation_count,
           avg({ran}) AS avg_delay_min,
           median({ran}) AS median_delay_min,
           quantile_cont({ran}, 0.9) AS p90_delay_min,
           quantile_cont({ran}, 0.95) AS p95_delay_min,
           quantile_cont({ran}, 0.99) AS p99_delay_min,
           CAST(sum(CASE WHEN NOT is_canceled AND is_on_time THEN 1 ELSE 0 END) AS BIGINT) AS on_time_count
    FROM enriched
    GROUP BY {key}, date_trunc('month', service_date), station_coverage_era)
)"""


WAREHOUSE = (
    STEPS
    + ",\n".join(
        [
            enrichment("deduped", "enriched"),
            enrichment("unioned", "all_enriched"),
            performance("station_perf", "eva"),
            performance("line_perf", "train_type, line_number"),
            """dim_station AS (
  SELECT eva, coalesce(max(station_name), max(xml_station_name)) AS station_name,
         count(DISTINCT xml_station_name) AS xml_station_name_variant_count
  FROM enriched GROUP BY eva
)""",
            "dim_train_line AS (SELECT train_type, line_number FROM enriched GROUP BY train_type, line_number)",
            """dim_service_month AS (
  SELECT DISTINCT service_month, strftime(service_month, '%Y') AS service_year,
         CAST(extract(month FROM service_month) AS INTEGER) AS month_number,
         strftime(service_month, '%b') AS month_name, strftime(service_month, '%m - %b') AS month_label
  FROM station_perf WHERE service_month IS NOT NULL
)""",
        ]
    )
    + "\n"
)


def over(select: str) -> str:
    """The select with the tables it reads in front of it; a WITH of its own continues that list."""
    own = select.lstrip()
    return WAREHOUSE.rstrip() + ",\n" + own[len("WITH ") :] if own.startswith("WITH ") else WAREHOUSE + select


DELAY = (
    "round(round(sum(m.avg_delay_min * m.non_canceled_observation_count), 6)"
    " / nullif(sum(m.non_canceled_observation_count), 0), 1)"
)
ON_TIME = "round(100.0 * sum(m.on_time_count) / nullif(sum(m.non_canceled_observation_count), 0), 1)"
CANCELED = "round(100.0 * sum(m.cancellation_count) / nullif(sum(m.observation_count), 0), 1)"
VOLUME = "CAST(sum(m.observation_count) AS BIGINT)"

PERIOD = "JOIN dim_service_month d ON m.service_month = d.service_month"
