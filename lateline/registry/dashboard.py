"""The dashboard queries over the stored marts.

The year is 1997. Rankings with a volume floor take the whole year, as no station or line reaches the floor in a
month of the small data set; the month filter is set where the report compares a month with the one before.
"""

from __future__ import annotations

from collections.abc import Sequence

from lateline.plans.reports import REPORTS, Filters, filter_domains, station_lookup
from lateline.registry.catalogue import register
from lateline.registry.sql import CANCELED, DELAY, ON_TIME, PERIOD, VOLUME
from lateline.registry.tables import rounded

YEAR, MONTH, STATION, CATEGORIES, CATEGORY, LINE = "1997", "03 - Mar", "N_3", ["AR", "ECON"], "STANDARD", "#1"
YEAR_ONLY = Filters(year=YEAR)
YEAR_MONTH = Filters(year=YEAR, month_label=MONTH)
STATION_MONTH = Filters(year=YEAR, month_label=MONTH, station="3")
STATION_YEAR = Filters(year=YEAR, station=STATION)
CATEGORY_MONTH = Filters(year=YEAR, month_label=MONTH, category=CATEGORIES)
CATEGORY_YEAR = Filters(year=YEAR, category=CATEGORIES)

IN_YEAR = f"d.service_year = '{YEAR}'"
SELECTED = f"(SELECT max(service_month) FROM dim_service_month d WHERE {IN_YEAR} AND d.month_label = '{MONTH}')"
TWO_MONTHS = f"m.service_month IN ({SELECTED}, CAST({SELECTED} - INTERVAL 1 MONTH AS DATE))"
IN_CATEGORIES = "(m.train_type LIKE '%AR%' OR m.train_type LIKE '%ECON%')"
HAS_LINE = "m.line_number IS NOT NULL AND trim(m.line_number) <> ''"
FLOOR, RAN = "sum(m.observation_count) >= 30", "sum(m.non_canceled_observation_count) > 0"

DELAY_AS = f"{DELAY} AS average_delay_min"
ON_TIME_AS = f"{ON_TIME} AS on_time_rate_pct"
CANCELED_AS = f"{CANCELED} AS cancellation_rate_pct"
VOLUME_AS = f"{VOLUME} AS activity_volume"


def select(
    source: str,
    columns: Sequence[str],
    where: Sequence[str] = (),
    group: Sequence[str] = (),
    having: Sequence[str] = (),
    tail: str = "",
) -> str:
    clauses = [f"SELECT {', '.join(columns)} FROM {source}"]
    if where:
        clauses.append("WHERE " + " AND ".join(where))
    if group:
        clauses.append("GROUP BY " + ", ".join(group))
    if having:
        clauses.append("HAVING " + " AND ".join(having))
    return "\n".join([*clauses, tail])


STATIONS, LINES = "station_perf m", "line_perf m"
STATIONS_IN, LINES_IN = f"{STATIONS} {PERIOD}", f"{LINES} {PERIOD}"
AT_STATION = f"{STATIONS} JOIN dim_station s ON m.eva = s.eva"
STATION_3 = "s.station_name LIKE '%3%'"
MONTH_COLUMN, BY_MONTH = "m.service_month AS month", ["m.service_month"]


def monthly(source: str, measures: Sequence[str], where: Sequence[str], having: Sequence[str] = ()) -> str:
    return select(source, [MONTH_COLUMN, *measures], where, BY_MONTH, having)


def versus(measure: str) -> str:
    here = monthly(
        f"{AT_STATION} {PERIOD}", [f"{measure} AS value"], [IN_YEAR, f"s.station_name LIKE '%{STATION}%'"]
    )
    network = monthly(STATIONS_IN, [f"{measure} AS value"], [IN_YEAR])
    return f"""SELECT a.month, a.value AS selected_station, b.value AS network_average
               FROM ({here}) a JOIN ({network}) b ON a.month = b.month"""


def top(column: str, direction: str, ties: str, n: int | None = None) -> str:
    limit = f" LIMIT {n}" if n else ""
    return f"ORDER BY {column} {direction} NULLS LAST, {ties}{limit}"


WORST_SERVICES = select(
    LINES_IN,
    ["m.train_type", "m.line_number", DELAY_AS, VOLUME_AS],
    [IN_YEAR],
    ["m.train_type", "m.line_number"],
    [FLOOR, RAN],
    top("average_delay_min", "DESC", "m.train_type, m.line_number NULLS LAST", 10),
)

SQL = {
    "kpi_avg_delay": (YEAR_MONTH, monthly(STATIONS, [DELAY_AS], [TWO_MONTHS])),
    "kpi_ontime": (YEAR_MONTH, monthly(STATIONS, [ON_TIME_AS], [TWO_MONTHS])),
    "kpi_cancel": (YEAR_MONTH, monthly(STATIONS, [CANCELED_AS], [TWO_MONTHS])),
    "kpi_activity": (YEAR_MONTH, select(STATIONS, [VOLUME_AS], [f"m.service_month = {SELECTED}"])),
    "trend_delay": (YEAR_ONLY, monthly(STATIONS_IN, [DELAY_AS], [IN_YEAR])),
    "trend_ontime": (YEAR_ONLY, monthly(STATIONS_IN, [ON_TIME_AS], [IN_YEAR])),
    "trend_cancel": (YEAR_ONLY, monthly(STATIONS_IN, [CANCELED_AS], [IN_YEAR])),
    "worst_stations": (
        YEAR_ONLY,
        select(
            f"{AT_STATION} {PERIOD}",
            ["s.station_name", "m.eva", DELAY_AS, VOLUME_AS],
            [IN_YEAR],
            ["s.station_name", "m.eva"],
            [FLOOR, RAN],
            top("average_delay_min", "DESC", "m.eva", 10),
        ),
    ),
    "worst_services": (
        YEAR_ONLY,
        f"""SELECT CASE WHEN line_number IS NULL OR trim(line_number) = '' THEN train_type
                        ELSE train_type || ' ' || line_number END AS service_line, average_delay_min, activity_volume
            FROM ({WORST_SERVICES})""",
    ),
    "cat_avg_delay": (
        YEAR_ONLY,
        select(LINES_IN, ["m.train_type", DELAY_AS], [IN_YEAR], ["m.train_type"], [FLOOR, RAN]),
    ),
    "cat_cancel": (
        YEAR_ONLY,
        select(LINES_IN, ["m.train_type", CANCELED_AS], [IN_YEAR], ["m.train_type"], [FLOOR]),
    ),
    "cat_ontime": (
        YEAR_ONLY,
        select(LINES_IN, ["m.train_type", ON_TIME_AS], [IN_YEAR], ["m.train_type"], [FLOOR, RAN]),
    ),
    "svc_kpi_avg": (
        CATEGORY_MONTH,
        monthly(
            LINES,
            [DELAY_AS],
            [
                f"m.service_month >= CAST({SELECTED} - INTERVAL 1 MONTH AS DATE)",
                f"m.service_month <= {SELECTED}",
                IN_CATEGORIES,
            ],
        ),
    ),
    "svc_kpi_ontime": (CATEGORY_MONTH, monthly(LINES, [ON_TIME_AS], [TWO_MONTHS, IN_CATEGORIES])),
    "svc_kpi_cancel": (CATEGORY_MONTH, monthly(LINES, [CANCELED_AS], [TWO_MONTHS, IN_CATEGORIES])),
    "svc_kpi_activity": (CATEGORY_YEAR, select(LINES_IN, [VOLUME_AS], [IN_YEAR, IN_CATEGORIES])),
    "line_avg_delay": (
        CATEGORY_YEAR,
        select(
            LINES_IN,
            ["m.line_number", DELAY_AS],
            [IN_YEAR, IN_CATEGORIES, HAS_LINE],
            ["m.line_number"],
            [FLOOR, RAN],
            top("average_delay_min", "DESC", "m.line_number", 15),
        ),
    ),
    "line_cancel": (
        Filters(year=YEAR, category=[CATEGORY, "SMALL"]),
        select(
            LINES_IN,
            ["m.line_number", CANCELED_AS],
            [IN_YEAR, f"m.train_type IN ('{CATEGORY}', 'SMALL')", HAS_LINE],
            ["m.line_number"],
            [FLOOR],
            top("cancellation_rate_pct", "DESC", "m.line_number", 15),
        ),
    ),
    "line_details": (
        CATEGORY_YEAR,
        select(
            LINES_IN,
            ["m.line_number", DELAY_AS, ON_TIME_AS, CANCELED_AS, VOLUME_AS],
            [IN_YEAR, IN_CATEGORIES, HAS_LINE],
            ["m.line_number"],
            [FLOOR],
        ),
    ),
    "svc_trend_delay": (
        Filters(year=YEAR, category=CATEGORY, line=LINE),
        monthly(
            LINES_IN, [DELAY_AS], [IN_YEAR, f"m.train_type = '{CATEGORY}'", f"m.line_number LIKE '%{LINE}%'"], [RAN]
        ),
    ),
    "svc_trend_reliability": (
        Filters(year=YEAR, category=CATEGORIES, line=[LINE, "#7"]),
        monthly(
            LINES_IN,
            [ON_TIME_AS, CANCELED_AS],
            [IN_YEAR, IN_CATEGORIES, f"(m.line_number LIKE '%{LINE}%' OR m.line_number LIKE '%#7%')"],
        ),
    ),
    "s_kpi_avg": (STATION_MONTH, monthly(AT_STATION, [DELAY_AS], [STATION_3, TWO_MONTHS])),
    "s_kpi_median": (
        STATION_MONTH,
        monthly(AT_STATION, ["round(max(m.median_delay_min), 6) AS median_delay_min"], [STATION_3, TWO_MONTHS]),
    ),
    "s_kpi_p90": (
        STATION_MONTH,
        monthly(AT_STATION, ["round(max(m.p90_delay_min), 6) AS p90_delay_min"], [STATION_3, TWO_MONTHS]),
    ),
    "s_kpi_ontime": (STATION_MONTH, monthly(AT_STATION, [ON_TIME_AS], [STATION_3, TWO_MONTHS])),
    "s_kpi_cancel": (STATION_MONTH, monthly(AT_STATION, [CANCELED_AS], [STATION_3, TWO_MONTHS])),
    "s_kpi_activity": (STATION_MONTH, select(AT_STATION, [VOLUME_AS], [STATION_3, f"m.service_month = {SELECTED}"])),
    "s_vs_network_delay": (STATION_YEAR, versus(DELAY)),
    "s_vs_network_ontime": (STATION_YEAR, versus(ON_TIME)),
    "s_vs_network_cancel": (STATION_YEAR, versus(CANCELED)),
    "s_delay_profile": (
        STATION_YEAR,
        select(
            f"{AT_STATION} {PERIOD}",
            [
                MONTH_COLUMN,
                "round(m.avg_delay_min, 6) AS avg_delay_min",
                "round(m.median_delay_min, 6) AS median_delay_min",
                "round(m.p90_delay_min, 6) AS p90_delay_min",
            ],
            [IN_YEAR, f"s.station_name LIKE '%{STATION}%'"],
        ),
    ),
}

UNROUNDED = {"avg_delay_min", "median_delay_min", "p90_delay_min"}


def _register(name: str, filters: Filters, sql: str) -> None:
    def build(s):
        report = REPORTS[name](s.marts, filters)
        raw_values = [c for c in report.columns if c in UNROUNDED]
        return rounded(report, raw_values) if raw_values else report

    register(name, build, sql)


for _name, (_filters, _sql) in SQL.items():
    _register(_name, _filters, _sql)

register(
    "filter_domains",
    lambda s: filter_domains(s.marts, Filters(category=[CATEGORY, "ECONOMY"])),
    f"""SELECT DISTINCT * FROM (
          SELECT 'year' AS "filter", service_year AS value FROM dim_service_month
          UNION ALL SELECT 'month', month_label FROM dim_service_month
          UNION ALL SELECT 'station', station_name FROM dim_station
          UNION ALL SELECT 'category', train_type FROM dim_train_line
          UNION ALL SELECT 'line', line_number FROM dim_train_line WHERE train_type IN ('{CATEGORY}', 'ECONOMY'))
        WHERE value IS NOT NULL""",
)
register(
    "station_lookup",
    lambda s: station_lookup(s.marts, Filters(station=["3", "7"])),
    "SELECT station_name, eva FROM dim_station WHERE station_name LIKE '%3%' OR station_name LIKE '%7%'",
)
