"""The profiling reports and the catalog.

Reports take the month a file stands for, as they would over monthly files. Reports with sketched distinct counts return
the exact ones and whether the sketches lie near them; each is registered once more with exact counts alone.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lateline import contract
from lateline.operators import quality
from lateline.plans import catalog, profiling, sketches
from lateline.plans.profile_run import month_schemas
from lateline.registry.catalogue import register
from lateline.registry.shop import Shop
from lateline.registry.tables import CANDIDATES_SQL, CONTRACT, micros
from lateline.sources.bronze import file_sizes

FILED = f"(SELECT {CONTRACT}, file_month AS source_month FROM filed)"
T = 'make_timestamp("time" // 1000)'


def by_month(columns: str, source: str = FILED, where: str = "") -> str:
    return f"SELECT source_month, {columns} FROM {source} {where} GROUP BY source_month"


def count_where(name: str, condition: str) -> str:
    return f"count(*) FILTER ({condition}) AS {name}"


# --- counters by month --------------------------------------------------------------------------------------

NULLS = "\nUNION ALL ".join(
    f"""SELECT source_month, '{c}' AS column_name, count(*) AS row_count, count(*) - count("{c}") AS null_count,
               round(100.0 * (count(*) - count("{c}")) / count(*), 4) AS null_rate_pct
        FROM {FILED} GROUP BY source_month"""
    for c in contract.OBSERVATION_COLUMNS
)

CONTEXT = by_month(
    "count(*) AS row_count, "
    + ", ".join(
        count_where(name, condition)
        for name, condition in {
            "arrival_null_departure_present": "arrival_planned_time IS NULL AND departure_planned_time IS NOT NULL",
            "arrival_present_departure_null": "arrival_planned_time IS NOT NULL AND departure_planned_time IS NULL",
            "both_planned_events_null": "arrival_planned_time IS NULL AND departure_planned_time IS NULL",
            "station_lookup_missing_xml_present": "station_name IS NULL AND xml_station_name IS NOT NULL",
            "station_present_xml_missing": "station_name IS NOT NULL AND xml_station_name IS NULL",
            "line_number_null": "line_number IS NULL",
            "arrival_planned_present_change_null": "arrival_planned_time IS NOT NULL AND arrival_change_time IS NULL",
            "departure_planned_present_change_null":
                "departure_planned_time IS NOT NULL AND departure_change_time IS NULL",
            "arrival_change_equals_planned": "arrival_planned_time = arrival_change_time",
            "departure_change_equals_planned": "departure_planned_time = departure_change_time",
            "time_null": '"time" IS NULL',
        }.items()
    )
)

NAMES = by_month(
    f"""count(*) AS row_count,
        {count_where("resolved_vs_xml_name_mismatch_rows", "station_name <> xml_station_name")},
        {count_where("resolved_missing_xml_present_rows", "station_name IS NULL AND xml_station_name IS NOT NULL")},
        round(100.0 * count(*) FILTER (station_name <> xml_station_name) / count(*), 4) AS name_mismatch_rate_pct"""
)

INTEGRITY = by_month(
    "count(*) AS row_count, "
    + ", ".join(
        count_where(name, condition)
        for name, condition in {
            "planned_arrival_after_departure": "arrival_planned_time > departure_planned_time",
            "effective_arrival_after_departure": "arrival_change_time > departure_change_time",
            "early_arrival_rows": "arrival_change_time < arrival_planned_time",
            "early_departure_rows": "departure_change_time < departure_planned_time",
            "arrival_deltas_not_whole_minutes": "abs(arrival_change_time - arrival_planned_time) % 60000000000 <> 0",
            "departure_deltas_not_whole_minutes":
                "abs(departure_change_time - departure_planned_time) % 60000000000 <> 0",
        }.items()
    )
)

RECOMPUTE = by_month(
    "count(*) AS row_count, "
    + ", ".join(
        f"""count(*) FILTER ({e}_candidate_eligible) AS {e}_eligible_rows,
            count(*) FILTER ({e}_matches_published) AS {e}_match_rows,
            round(100.0 * count(*) FILTER ({e}_matches_published) / nullif(count(*) FILTER ({e}_candidate_eligible), 0), 4)
              AS {e}_match_rate_pct"""
        for e in ("arrival", "departure", "any_event")
    )
    + """, count(*) FILTER (arrival_candidate_eligible AND departure_candidate_eligible)
             AS rows_where_time_matches_both_events,
           count(*) FILTER (arrival_candidate_eligible AND departure_candidate_eligible
                            AND abs(arrival_delay_calc_min - departure_delay_calc_min) < 1e-9)
             AS both_event_rows_with_same_calculated_delay""",
    f"(SELECT * REPLACE (file_month AS source_month) FROM ({CANDIDATES_SQL}))",
)

SCOPE = by_month(
    f"""count(*) AS row_count, {count_where("service_date_null_rows", '"time" IS NULL')},
        {count_where("service_date_outside_source_month_rows", f"strftime({T}, '%Y-%m') <> source_month")}"""
)

MONTHLY_SQL = {
    "null_profile": NULLS,
    "contextual_null_profile": CONTEXT,
    "station_name_comparison": NAMES,
    "timestamp_integrity": INTEGRITY,
    "delay_recompute_validation": RECOMPUTE,
    "service_date_scope_check": SCOPE,
}
for _name, _sql in MONTHLY_SQL.items():
    register(_name, lambda s, name=_name: profiling.monthly_report(s.filed, name), _sql)

register(
    "nonzero_null_profile",
    lambda s: profiling.nonzero_nulls(profiling.monthly_report(s.filed, "null_profile")),
    f"SELECT * FROM ({NULLS}) WHERE null_count > 0",
)


def _from_one_scan(s: Shop) -> DataFrame:
    """One of the reports taken from the counters that serve all six."""
    counters = s.space.table("monthly_counters", lambda: profiling.monthly_counters(s.filed))
    return profiling.reports_from_counters(counters)["delay_recompute_validation"]


register("monthly_counters", _from_one_scan, RECOMPUTE)

# --- volume and cardinality ---------------------------------------------------------------------------------

SPAN = ["minimum_time", "maximum_time"]
SPAN_SQL = 'min("time") // 1000 AS minimum_time, max("time") // 1000 AS maximum_time'
DATES_SQL = f"count(DISTINCT CAST({T} AS DATE)) AS distinct_service_dates"


def _sizes(s: Shop) -> DataFrame:
    return file_sizes(s.spark, s.bronze_root)


def _beside_exact(report: Callable[..., DataFrame], keys: list[str], *sketched: str) -> Callable[[Shop], DataFrame]:
    """The exact report, and whether every sketched count lies within five percent, or two, of the exact one."""

    def build(s: Shop) -> DataFrame:
        exact, sketch = report(s, True), report(s, False)
        near = sketch.select(*keys, *[F.col(c).alias(f"near_{c}") for c in sketched])
        pairs = [(F.col(c.replace("approx_", "")), F.col(f"near_{c}")) for c in sketched]
        within = [F.abs(true - near_by) <= F.greatest(F.lit(2), true * 0.05) for true, near_by in pairs]
        held = reduce(Column.__and__, within).alias("sketch_within_bound")
        return exact.join(near, keys).select(*exact.columns, held)

    return build


def _overview(s: Shop, exact: bool) -> DataFrame:
    return micros(profiling.monthly_overview(s.filed, _sizes(s), exact=exact), SPAN)


OVERVIEW_COUNTS = ["approx_distinct_eva", "approx_distinct_rides", "approx_distinct_train_numbers"]
OVERVIEW_SQL = by_month(
    f"""count(*) AS row_count, {SPAN_SQL}, {DATES_SQL}, count(DISTINCT eva) AS distinct_eva,
        count(DISTINCT train_line_ride_id) AS distinct_rides, count(DISTINCT train_number) AS distinct_train_numbers,
        count(*) FILTER (is_canceled) AS canceled_rows,
        round(100.0 * count(*) FILTER (is_canceled) / count(*), 4) AS cancellation_rate_pct"""
)
SIZED = "'data-' || source_month || '.parquet' AS file_name, true AS file_has_size"


def _file_has_size(report: DataFrame) -> DataFrame:
    """The size itself depends on the writer. That a month has one, of its own file, doesn't; nor that a row takes less
    than a kilobyte."""
    fits = F.col("file_size_mb").isNotNull() & (F.col("file_size_mb") * 1024 < F.col("row_count") + 64)
    return report.withColumn("file_has_size", fits).drop("file_size_mb")


register(
    "monthly_overview",
    lambda s: _file_has_size(_beside_exact(_overview, ["source_month"], *OVERVIEW_COUNTS)(s)),
    f"SELECT *, {SIZED}, true AS sketch_within_bound FROM ({OVERVIEW_SQL})",
)
register(
    "monthly_overview_exact",
    lambda s: micros(profiling.monthly_overview(s.filed, exact=True), SPAN),
    OVERVIEW_SQL,
)
SCOPE_SQL = f"""SELECT count(*) AS row_count, {SPAN_SQL}, {DATES_SQL}, count(DISTINCT eva) AS distinct_eva,
                       count(DISTINCT train_line_ride_id) AS distinct_rides FROM {FILED}"""
register(
    "total_scope_summary",
    _beside_exact(
        lambda s, exact: micros(profiling.total_scope_summary(s.filed, exact=exact), SPAN),
        ["row_count"], "approx_distinct_eva", "approx_distinct_rides",
    ),
    f"SELECT *, true AS sketch_within_bound FROM ({SCOPE_SQL})",
)
register(
    "total_scope_summary_exact",
    lambda s: micros(profiling.total_scope_summary(s.filed, exact=True), SPAN),
    SCOPE_SQL,
)
def _stored_sketches(s: Shop) -> DataFrame:
    return s.space.table("month_sketches", lambda: sketches.month_sketches(s.filed))


register(
    "overview_from_sketches",
    lambda s: _beside_exact(
        lambda s, exact: micros(profiling.monthly_overview(s.filed, exact=True) if exact else sketches.overview(_stored_sketches(s)), SPAN),
        ["source_month"], *OVERVIEW_COUNTS,
    )(s),
    f"SELECT *, true AS sketch_within_bound FROM ({OVERVIEW_SQL})",
)
register(
    "total_from_sketches",
    _beside_exact(
        lambda s, exact: micros(profiling.total_scope_summary(s.filed, exact=True) if exact else sketches.total(_stored_sketches(s)), SPAN),
        ["row_count", "minimum_time", "maximum_time", "distinct_service_dates"], "approx_distinct_eva", "approx_distinct_rides",
    ),
    f"SELECT *, true AS sketch_within_bound FROM ({SCOPE_SQL})",
)
CARDINALITY_SQL = "\nUNION ALL ".join(
    f"SELECT source_month, '{c}' AS column_name, count(DISTINCT {c}) AS distinct_count FROM {FILED} GROUP BY source_month"
    for c in profiling.CARDINALITY_COLUMNS
)
register(
    "cardinality_profile",
    _beside_exact(
        lambda s, exact: profiling.cardinality_profile(s.filed, exact=exact),
        ["source_month", "column_name"], "approx_distinct_count",
    ),
    f"SELECT *, true AS sketch_within_bound FROM ({CARDINALITY_SQL})",
)
register(
    "cardinality_from_sketches",
    _beside_exact(
        lambda s, exact: profiling.cardinality_profile(s.filed, exact=True) if exact else sketches.cardinalities(_stored_sketches(s)),
        ["source_month", "column_name"], "approx_distinct_count",
    ),
    f"SELECT *, true AS sketch_within_bound FROM ({CARDINALITY_SQL})",
)
register(
    "cardinality_profile_exact",
    lambda s: profiling.cardinality_profile(s.filed, exact=True),
    CARDINALITY_SQL,
)
register(
    "top_train_types",
    lambda s: profiling.top_train_types(s.filed, 4),
    f"""SELECT * FROM (
          SELECT source_month, train_type, count(*) AS row_count,
                 CAST(row_number() OVER (PARTITION BY source_month ORDER BY count(*) DESC, train_type ASC NULLS LAST)
                      AS INTEGER) AS rank_in_month
          FROM {FILED} GROUP BY source_month, train_type)
        WHERE rank_in_month <= 4""",
)
register(
    "line_null_by_train_type",
    lambda s: profiling.line_null_by_train_type(s.filed),
    f"""SELECT train_type, count(*) AS row_count, count(*) FILTER (line_number IS NULL) AS line_number_null_count,
               round(100.0 * count(*) FILTER (line_number IS NULL) / count(*), 4) AS line_number_null_rate_pct
        FROM {FILED} GROUP BY train_type""",
)

# --- stations and keys --------------------------------------------------------------------------------------

EVA_NAMES = f"""SELECT eva, count(*) AS row_count, count(DISTINCT station_name) AS distinct_resolved_station_names,
                       count(DISTINCT xml_station_name) AS distinct_xml_station_names,
                       min(station_name) AS sample_station_name_min, max(station_name) AS sample_station_name_max,
                       min(xml_station_name) AS sample_xml_name_min, max(xml_station_name) AS sample_xml_name_max
                FROM {FILED} WHERE eva IS NOT NULL GROUP BY eva"""
register("eva_station_name_profile", lambda s: profiling.eva_station_name_profile(s.filed), EVA_NAMES)
register(
    "unstable_station_names",
    lambda s: profiling.unstable_station_names(profiling.eva_station_name_profile(s.filed)),
    f"SELECT * FROM ({EVA_NAMES}) WHERE distinct_resolved_station_names > 1 OR distinct_xml_station_names > 1",
)
register(
    "id_key_profile",
    lambda s: profiling.id_key_profile(s.filed),
    f"""SELECT source_month, CAST(sum(n) AS BIGINT) AS row_count, count(*) AS distinct_id_groups_including_null,
               CAST(sum(CASE WHEN id IS NULL THEN n ELSE 0 END) AS BIGINT) AS null_id_rows,
               count(*) FILTER (n > 1) AS duplicate_id_groups,
               CAST(sum(CASE WHEN n > 1 THEN n - 1 ELSE 0 END) AS BIGINT) AS duplicate_excess_rows,
               max(n) AS max_observations_per_id
        FROM (SELECT source_month, id, count(*) AS n FROM {FILED} GROUP BY source_month, id) GROUP BY source_month""",
)

GROUPS = f"""SELECT source_month, train_line_ride_id, train_line_station_num, count(*) AS observation_count,
                    count(DISTINCT id) AS distinct_ids, count(DISTINCT "time") AS distinct_time_values,
                    count(DISTINCT delay_in_min) AS distinct_delay_values,
                    count(DISTINCT is_canceled) AS distinct_cancellation_values,
                    count(DISTINCT arrival_change_time) AS distinct_arrival_change_values,
                    count(DISTINCT departure_change_time) AS distinct_departure_change_values,
                    min("time") AS minimum_time_raw, max("time") AS maximum_time_raw,
                    min(delay_in_min) AS minimum_delay, max(delay_in_min) AS maximum_delay
             FROM {FILED} GROUP BY source_month, train_line_ride_id, train_line_station_num"""
CHANGED = {
    "groups_with_time_changes": "distinct_time_values",
    "groups_with_delay_changes": "distinct_delay_values",
    "groups_with_cancellation_changes": "distinct_cancellation_values",
    "groups_with_arrival_updates": "distinct_arrival_change_values",
    "groups_with_departure_updates": "distinct_departure_change_values",
    "groups_with_multiple_ids": "distinct_ids",
}
register("ride_stop_groups", lambda s: profiling.ride_stop_groups(s.filed), GROUPS)
register(
    "ride_stop_duplicate_summary",
    lambda s: profiling.ride_stop_duplicate_summary(s.filed),
    f"""SELECT source_month, count(*) AS duplicate_business_key_groups,
               CAST(sum(observation_count) AS BIGINT) AS rows_in_duplicate_groups,
               CAST(sum(observation_count - 1) AS BIGINT) AS extra_rows_beyond_one_per_key,
               max(observation_count) AS max_observations_per_business_key,
               {', '.join(count_where(name, f"{c} > 1") for name, c in CHANGED.items())}
        FROM ({GROUPS}) WHERE observation_count > 1 GROUP BY source_month""",
)
register(
    "repeated_ride_stop_samples",
    lambda s: profiling.repeated_ride_stop_samples(s.filed),
    f"""SELECT * FROM ({GROUPS}) WHERE observation_count > 1
        ORDER BY observation_count DESC, distinct_delay_values DESC, source_month, train_line_ride_id,
                 train_line_station_num LIMIT 50""",
)
STAMPED = ", ".join(f'"{c}" // 1000 AS "{c}_ts"' for c in contract.TIME_COLUMNS)
register(
    "inspect_ride_stop",
    lambda s: micros(
        profiling.inspect_ride_stop(s.filed, "16", 3), [f"{c}_ts" for c in contract.TIME_COLUMNS]
    ),
    f"""SELECT source_month, id, train_line_ride_id, train_line_station_num, station_name, eva, delay_in_min,
               is_canceled, {STAMPED} FROM {FILED} WHERE train_line_ride_id = '16' AND train_line_station_num = 3""",
)
SAME = ", ".join(f'"{c}"' for c in contract.OBSERVATION_COLUMNS if c != "id")
def _published_twice(s: Shop) -> DataFrame:
    """The data has no semantic duplicates, so canceled rows come once more under another id."""
    again = s.filed.where("is_canceled").withColumn("id", F.concat("id", F.lit("-again")))
    return s.filed.unionByName(again)


TWICE = f"(SELECT * FROM {FILED} UNION ALL SELECT * FROM {FILED} WHERE is_canceled)"
register(
    "semantic_duplicate_summary",
    lambda s: profiling.semantic_duplicate_summary(_published_twice(s)),
    by_month(
        """count(*) AS semantic_duplicate_groups, CAST(sum(n) AS BIGINT) AS rows_in_semantic_duplicate_groups,
           CAST(sum(n - 1) AS BIGINT) AS semantic_duplicate_excess_rows""",
        f"(SELECT source_month, {SAME}, count(*) AS n FROM {TWICE} GROUP BY source_month, {SAME})",
        "WHERE n > 1",
    ),
)

# --- times, delays, cancellations ---------------------------------------------------------------------------


def share_sql(counts: str, name: str) -> str:
    return f"""SELECT *, CAST(sum(row_count) OVER (PARTITION BY source_month) AS BIGINT) AS month_row_count,
                      round(100.0 * row_count / sum(row_count) OVER (PARTITION BY source_month), 4) AS {name}
               FROM ({counts})"""


register(
    "time_match_profile",
    lambda s: profiling.time_match_profile(s.filed),
    share_sql(
        f"""SELECT source_month,
                   CASE WHEN "time" = arrival_change_time AND "time" = departure_change_time THEN 'matches_both'
                        WHEN "time" = arrival_change_time THEN 'matches_arrival_only'
                        WHEN "time" = departure_change_time THEN 'matches_departure_only'
                        ELSE 'matches_neither' END AS time_match_category, count(*) AS row_count
            FROM {FILED} GROUP BY 1, 2""",
        "rate_pct",
    ),
)

PERCENTILES = "delay_percentiles_p01_p05_p25_p50_p75_p90_p95_p99"
register(
    "delay_profile",
    lambda s: profiling.delay_profile(s.filed).withColumn(PERCENTILES, F.concat_ws(",", PERCENTILES)),
    by_month(
        f"""count(*) AS non_canceled_rows, count(delay_in_min) AS delay_non_null_rows,
            {count_where("delay_null_rows", "delay_in_min IS NULL")}, min(delay_in_min) AS minimum_delay_min,
            max(delay_in_min) AS maximum_delay_min, round(avg(delay_in_min), 4) AS average_delay_min,
            round(stddev_samp(delay_in_min), 4) AS stddev_delay_min,
            array_to_string(quantile_disc(delay_in_min, {contract.PROFILE_PERCENTILES}), ',') AS {PERCENTILES},
            {count_where("negative_delay_rows", "delay_in_min < 0")},
            {count_where("zero_delay_rows", "delay_in_min = 0")}, """
        + ", ".join(count_where(f"delay_ge_{b}_min_rows", f"delay_in_min >= {b}") for b in contract.DELAY_BANDS_MIN),
        where="WHERE NOT is_canceled",
    ),
)


def _late_published(s: Shop) -> DataFrame:
    """Deviating published delays: the data has none, so canceled rows get one minute more than their times say."""
    return s.filed.withColumn("delay_in_min", F.col("delay_in_min") + F.col("is_canceled").cast("int"))


MISMATCHES = f"""SELECT source_month, id, station_name, eva, train_type, train_number, line_number, delay_in_min + 1
                          AS delay_in_min, is_canceled, "time", arrival_planned_time, arrival_change_time,
                        CAST(arrival_change_time - arrival_planned_time AS DOUBLE) / 60000000000 AS arrival_delay_calc_min,
                        departure_planned_time, departure_change_time,
                        CAST(departure_change_time - departure_planned_time AS DOUBLE) / 60000000000
                          AS departure_delay_calc_min,
                        arrival_change_time IS NOT NULL AS arrival_candidate_eligible,
                        departure_change_time IS NOT NULL AS departure_candidate_eligible
                 FROM {FILED} WHERE is_canceled"""
register(
    "delay_recompute_mismatches", lambda s: profiling.delay_recompute_mismatches(_late_published(s)), MISMATCHES
)
register(
    "mismatch_sample",
    lambda s: profiling.mismatch_sample(profiling.delay_recompute_mismatches(_late_published(s))),
    f"{MISMATCHES} ORDER BY source_month, id LIMIT 100",
)
register(
    "cancellation_profile",
    lambda s: profiling.cancellation_profile(s.filed),
    share_sql(
        f"""SELECT source_month, is_canceled, count(*) AS row_count, count(delay_in_min) AS delay_non_null_rows,
                   {count_where("delay_null_rows", "delay_in_min IS NULL")},
                   round(avg(delay_in_min), 4) AS average_delay_min, {count_where("time_null_rows", '"time" IS NULL')},
                   {count_where("arrival_planned_null_rows", "arrival_planned_time IS NULL")},
                   {count_where("departure_planned_null_rows", "departure_planned_time IS NULL")}
            FROM {FILED} GROUP BY source_month, is_canceled""",
        "status_rate_pct",
    ),
)

# --- calendar coverage --------------------------------------------------------------------------------------

DAILY = f"""SELECT source_month, CAST({T} AS DATE) AS service_date_profile, count(*) AS row_count,
                   count(DISTINCT eva) AS distinct_eva, count(*) FILTER (is_canceled) AS canceled_rows
            FROM {FILED} GROUP BY 1, 2"""
register(
    "daily_coverage",
    _beside_exact(
        lambda s, exact: profiling.daily_coverage(s.filed, exact=exact),
        ["source_month", "service_date_profile"], "approx_distinct_eva",
    ),
    f"SELECT *, true AS sketch_within_bound FROM ({DAILY})",
)
register("daily_coverage_exact", lambda s: profiling.daily_coverage(s.filed, exact=True), DAILY)
DAILY_SUMMARY = f"""SELECT source_month, count(service_date_profile) AS distinct_service_dates, min(row_count) AS minimum_daily_rows,
               round(avg(row_count), 2) AS average_daily_rows, max(row_count) AS maximum_daily_rows,
               min(distinct_eva) AS minimum_daily_eva, max(distinct_eva) AS maximum_daily_eva
        FROM ({DAILY}) GROUP BY source_month"""
register(
    "daily_coverage_summary",
    _beside_exact(
        lambda s, exact: profiling.daily_coverage_summary(profiling.daily_coverage(s.filed, exact=exact)),
        ["source_month"], "minimum_daily_approx_eva", "maximum_daily_approx_eva",
    ),
    f"SELECT *, true AS sketch_within_bound FROM ({DAILY_SUMMARY})",
)
register(
    "daily_coverage_summary_exact",
    lambda s: profiling.daily_coverage_summary(profiling.daily_coverage(s.filed, exact=True)),
    DAILY_SUMMARY,
)
register(
    "hour_coverage",
    lambda s: profiling.hour_coverage(s.filed),
    f"""SELECT source_month, CAST(extract(hour FROM {T}) AS INTEGER) AS service_hour_profile, count(*) AS row_count
        FROM {FILED} GROUP BY 1, 2""",
)
register(
    "weekday_coverage",
    lambda s: profiling.weekday_coverage(s.filed),
    f"""SELECT source_month, CAST(extract(dow FROM {T}) + 1 AS INTEGER) AS service_weekday_num_profile,
               strftime({T}, '%a') AS service_weekday_name_profile, count(*) AS row_count
        FROM {FILED} GROUP BY 1, 2, 3""",
)
SUMMARY = by_month(f"count(*) AS row_count, 17 AS column_count, {SPAN_SQL}, {DATES_SQL}")
register("dataset_summary", lambda s: micros(profiling.dataset_summary(s.filed), SPAN), SUMMARY)
register(
    "dataset_summary_with_sizes",
    lambda s: _file_has_size(micros(profiling.dataset_summary(s.filed, _sizes(s)), SPAN)),
    f"SELECT *, {SIZED} FROM ({SUMMARY})",
)

# --- schemas and catalog ------------------------------------------------------------------------------------


def _schemas(s: Shop) -> DataFrame:
    """The schema of every landed month, read from one footer each."""
    months = [r.source_month for r in s.filed.select("source_month").distinct().collect()]
    return month_schemas(s.spark, s.bronze_root, sorted(months))


FIRST = "1997-01"
FIELD_ROWS = ", ".join(
    f"({at}, '{f.name}', '{f.dataType.simpleString()}')" for at, f in enumerate(contract.OBSERVATION_SCHEMA, start=1)
)
register(
    "schema_month_summary",
    lambda s: catalog.schema_month_summary(_schemas(s), FIRST),
    """SELECT DISTINCT file_month AS period, 17 AS column_count, true AS matches_reference_schema,
              true AS matches_catalog_column_order, '' AS missing_expected_columns, '' AS unexpected_columns FROM filed""",
)
register(
    "schema_field_comparison",
    lambda s: catalog.schema_field_comparison(_schemas(s), FIRST),
    f"""SELECT file_month AS period, column_name, spark_data_type, true AS nullable, true AS matches_reference
        FROM (SELECT DISTINCT file_month FROM filed)
        JOIN (VALUES {FIELD_ROWS}) AS fields(ordinal, column_name, spark_data_type) ON true""",
)


def _drifting(s: Shop) -> str:
    """Every month as two files, of odd and of even stops. The second one departs from the contract by the number of
    its month: another type and place, two columns swapped, one missing and one new, or not at all."""

    def write(root: str) -> None:
        rows = s.filed.withColumn("file_month", F.col("source_month")).drop("source_month")
        odd, number = F.col("train_line_station_num") % 2 == 1, F.substring("file_month", 6, 2).cast("int") % 4
        names = contract.OBSERVATION_COLUMNS
        swapped = [{"eva": "train_type", "train_type": "eva"}.get(c, c) for c in names]
        variants = {
            0: names,
            1: [*[c for c in names if c != "delay_in_min"], F.col("delay_in_min").cast("bigint").alias("delay_in_min")],
            2: swapped,
            3: [*[c for c in names if c != "line_number"], F.lit("x").alias("platform")],
        }

        def by_month(chosen: DataFrame, mode: str = "append") -> None:
            """One file a month. Given a number, no partition is put together with others or split; with far more than
            there are months, few months share a task."""
            chosen.repartition(1024, "file_month").write.mode(mode).partitionBy("file_month").parquet(root)

        by_month(rows.where(odd).select(*names, "file_month"), "overwrite")
        for n, columns in variants.items():
            by_month(rows.where(~odd & (number == n)).select(*columns, "file_month"))

    return s.space.once("drifting", write)


def _drift(s: Shop) -> DataFrame:
    files = catalog.data_files(s.spark, _drifting(s))
    drift = catalog.schema_drift(s.spark, catalog.file_schemas(s.spark, files))
    month = F.regexp_extract("file", r"file_month=(\d{4}-\d{2})", 1)
    return drift.groupBy(month.alias("period"), "column_name", "drift", "expected", "found").agg(F.count("*").alias("files"))


AFTER_DELAY = contract.OBSERVATION_COLUMNS[contract.OBSERVATION_COLUMNS.index("delay_in_min") + 1 :]
DRIFTS = [
    (1, "delay_in_min", "type", "int", "bigint"),
    (1, "delay_in_min", "position", str(contract.OBSERVATION_COLUMNS.index("delay_in_min") + 1), "17"),
    *[(1, c, "position", str(contract.OBSERVATION_COLUMNS.index(c) + 1), str(contract.OBSERVATION_COLUMNS.index(c))) for c in AFTER_DELAY],
    *[(2, c, "position", str(contract.OBSERVATION_COLUMNS.index(c) + 1), str(contract.OBSERVATION_COLUMNS.index(o) + 1)) for c, o in (("eva", "train_type"), ("train_type", "eva"))],
    (3, "line_number", "missing", "string", None),
    (3, "platform", "unexpected", None, "string"),
]
register(
    "schema_drift",
    _drift,
    """SELECT file_month AS period, column_name, drift, expected, found, CAST(1 AS BIGINT) AS files
       FROM (SELECT DISTINCT file_month FROM filed WHERE train_line_station_num % 2 = 0)
       JOIN (VALUES {}) AS drifts(n, column_name, drift, expected, found)
         ON CAST(substr(file_month, 6, 2) AS INT) % 4 = n""".format(
        ", ".join("({}, {})".format(n, ", ".join("NULL" if v is None else f"'{v}'" for v in values)) for n, *values in DRIFTS)
    ),
)

JSON_BY_MONTH = """'{' || string_agg('"' || source_month || '":' || %s, ',' ORDER BY source_month) || '}'"""
register(
    "dataset_catalog",
    lambda s: catalog.dataset_catalog(
        profiling.dataset_summary(s.filed),
        quality.key_verdicts(quality.key_assessment(s.filed)),
    ),
    f"""WITH summary AS ({SUMMARY}),
             ids AS (SELECT max(n) = 1 AS sound FROM (SELECT count(*) AS n FROM filed GROUP BY file_month, id))
        SELECT 'sample_periods' AS catalog_attribute,
               '[' || string_agg('"' || source_month || '"', ',' ORDER BY source_month) || ']' AS catalog_value FROM summary
        UNION ALL SELECT 'sample_row_counts', {JSON_BY_MONTH % "row_count"} FROM summary
        UNION ALL SELECT 'sample_distinct_service_dates', {JSON_BY_MONTH % "distinct_service_dates"} FROM summary
        UNION ALL SELECT 'sample_time_scope',
                         strftime(make_timestamp(min(minimum_time)), '%Y-%m-%d %H:%M:%S') || ' to '
                         || strftime(make_timestamp(max(maximum_time)), '%Y-%m-%d %H:%M:%S') FROM summary
        UNION ALL SELECT 'column_count', '17'
        UNION ALL SELECT 'candidate_primary_key', 'id'
        UNION ALL SELECT 'candidate_primary_key_passes_samples', CAST(sound AS VARCHAR) FROM ids
        UNION ALL SELECT 'grain_hypothesis', 'one snapshot of one ride at one stop of its sequence'
        UNION ALL SELECT 'source_format', 'Parquet'
        UNION ALL SELECT 'timestamp_storage', 'Nanoseconds'
        UNION ALL SELECT 'coverage_transition_date', '2025-11-02'""",
)
