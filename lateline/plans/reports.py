"""Dashboard queries over the marts: KPIs, trends, rankings and comparisons.

The joined dimensions carry no broadcast hint. They are stored tables, so Catalyst knows their size and broadcasts
one only below the configured limit; a station dimension that outgrew it would be joined by a shuffle instead.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lateline.contract import RANKING_FLOOR
from lateline.functions import metrics
from lateline.functions.observation import has_line, service_line_label
from lateline.operators.marts import Marts

Values = str | list[str] | tuple[str, ...] | None


@dataclass(frozen=True)
class Filters:
    """Dashboard filters. A filter left out adds no predicate."""

    year: Values = None
    month_label: Values = None
    station: Values = None
    category: Values = None
    line: Values = None


def equals(column: Column, wanted: Values) -> list[Column]:
    return [column.isin(*_as_list(wanted))] if wanted else []


def contains(column: Column, wanted: Values) -> list[Column]:
    """Case-sensitive; several values mean any of them."""
    return [reduce(Column.__or__, [column.contains(v) for v in _as_list(wanted)])] if wanted else []


def _as_list(wanted: Values) -> list[str]:
    return [wanted] if isinstance(wanted, str) else list(wanted)


def where_all(df: DataFrame, predicates: list[Column]) -> DataFrame:
    return reduce(DataFrame.where, predicates, df)


# --- scopes -------------------------------------------------------------------------------------------------


def _period(marts: Marts, f: Filters) -> DataFrame:
    d = marts.dim_service_month
    return where_all(d, [*equals(d["service_year"], f.year), *equals(d["month_label"], f.month_label)])


def in_period(mart: DataFrame, marts: Marts, f: Filters) -> DataFrame:
    return mart.join(_period(marts, f).select("service_month"), "service_month")


def selected_month(marts: Marts, f: Filters) -> Column:
    """The last month the filters allow, as a scalar subquery."""
    return _period(marts, f).agg(F.max("service_month")).scalar()


def selected_and_previous(mart: DataFrame, marts: Marts, f: Filters) -> DataFrame:
    month = selected_month(marts, f)
    return mart.where(F.col("service_month").isin(month, F.add_months(month, -1)))


def _named_stations(marts: Marts, f: Filters) -> DataFrame:
    d = marts.dim_station
    return where_all(d, contains(d["station_name"], f.station)).select("eva", "station_name")


def at_stations(mart: DataFrame, marts: Marts, f: Filters) -> DataFrame:
    return mart.join(_named_stations(marts, f), "eva")


def _of_category(mart: DataFrame, f: Filters) -> DataFrame:
    return where_all(mart, contains(mart["train_type"], f.category))


# --- measures -----------------------------------------------------------------------------------------------

AVERAGE_DELAY, ON_TIME, CANCELLATION, ACTIVITY = (
    "average_delay_min",
    "on_time_rate_pct",
    "cancellation_rate_pct",
    "activity_volume",
)
MEASURES: dict[str, Callable[[], Column]] = {
    AVERAGE_DELAY: metrics.weighted_delay,
    ON_TIME: metrics.on_time_pct,
    CANCELLATION: metrics.cancellation_pct,
    ACTIVITY: metrics.activity,
}


def _measures(*names: str) -> list[Column]:
    return [MEASURES[name]().alias(name) for name in names]


def _by_month(rows: DataFrame, *names: str) -> DataFrame:
    return rows.groupBy(F.col("service_month").alias("month")).agg(*_measures(*names)).orderBy("month")


def with_volume(rows: DataFrame, key: list[Column], *names: str, ran: bool = True) -> DataFrame:
    """Measures by key for groups above the volume floor, and with at least one stop that ran where asked."""
    grouped = rows.groupBy(*key).agg(
        *_measures(*names), metrics.activity().alias("_observations"), metrics.non_canceled().alias("_ran")
    )
    kept = grouped.where(F.col("_observations") >= RANKING_FLOOR)
    return (kept.where(F.col("_ran") > 0) if ran else kept).drop("_observations", "_ran")


# --- network ------------------------------------------------------------------------------------------------


def kpi_avg_delay(m: Marts, f: Filters) -> DataFrame:
    return _by_month(selected_and_previous(m.station_perf, m, f), AVERAGE_DELAY)


def kpi_ontime(m: Marts, f: Filters) -> DataFrame:
    return _by_month(selected_and_previous(m.station_perf, m, f), ON_TIME)


def kpi_cancel(m: Marts, f: Filters) -> DataFrame:
    return _by_month(selected_and_previous(m.station_perf, m, f), CANCELLATION)


def kpi_activity(m: Marts, f: Filters) -> DataFrame:
    return m.station_perf.where(F.col("service_month") == selected_month(m, f)).agg(*_measures(ACTIVITY))


def trend_delay(m: Marts, f: Filters) -> DataFrame:
    return _by_month(in_period(m.station_perf, m, f), AVERAGE_DELAY)


def trend_ontime(m: Marts, f: Filters) -> DataFrame:
    return _by_month(in_period(m.station_perf, m, f), ON_TIME)


def trend_cancel(m: Marts, f: Filters) -> DataFrame:
    return _by_month(in_period(m.station_perf, m, f), CANCELLATION)


def worst_stations(m: Marts, f: Filters) -> DataFrame:
    rows = in_period(m.station_perf, m, f).join(m.dim_station.select("eva", "station_name"), "eva")
    ranked = with_volume(rows, [F.col("station_name"), F.col("eva")], AVERAGE_DELAY, ACTIVITY)
    return ranked.orderBy(F.desc_nulls_last(AVERAGE_DELAY), "eva").limit(10)


def worst_services(m: Marts, f: Filters) -> DataFrame:
    ranked = with_volume(
        in_period(m.line_perf, m, f), [F.col("train_type"), F.col("line_number")], AVERAGE_DELAY, ACTIVITY
    )
    return (
        ranked.orderBy(F.desc_nulls_last(AVERAGE_DELAY), "train_type", F.asc_nulls_last("line_number"))
        .limit(10)
        .select(
            service_line_label(F.col("train_type"), F.col("line_number")).alias("service_line"), AVERAGE_DELAY, ACTIVITY
        )
    )


def cat_avg_delay(m: Marts, f: Filters) -> DataFrame:
    ranked = with_volume(in_period(m.line_perf, m, f), [F.col("train_type")], AVERAGE_DELAY)
    return ranked.orderBy(F.desc_nulls_last(AVERAGE_DELAY), "train_type")


def cat_cancel(m: Marts, f: Filters) -> DataFrame:
    ranked = with_volume(in_period(m.line_perf, m, f), [F.col("train_type")], CANCELLATION, ran=False)
    return ranked.orderBy(F.desc_nulls_last(CANCELLATION), "train_type")


def cat_ontime(m: Marts, f: Filters) -> DataFrame:
    ranked = with_volume(in_period(m.line_perf, m, f), [F.col("train_type")], ON_TIME)
    return ranked.orderBy(F.asc_nulls_last(ON_TIME), "train_type")


# --- service categories and lines ---------------------------------------------------------------------------


def svc_kpi_avg(m: Marts, f: Filters) -> DataFrame:
    month = selected_month(m, f)
    rows = m.line_perf.where(F.col("service_month").between(F.add_months(month, -1), month))
    return _by_month(_of_category(rows, f), AVERAGE_DELAY)


def svc_kpi_ontime(m: Marts, f: Filters) -> DataFrame:
    return _by_month(_of_category(selected_and_previous(m.line_perf, m, f), f), ON_TIME)


def svc_kpi_cancel(m: Marts, f: Filters) -> DataFrame:
    return _by_month(_of_category(selected_and_previous(m.line_perf, m, f), f), CANCELLATION)


def svc_kpi_activity(m: Marts, f: Filters) -> DataFrame:
    """All months the filters allow, not only the last one."""
    return _of_category(in_period(m.line_perf, m, f), f).agg(*_measures(ACTIVITY))


def _lines(rows: DataFrame, *names: str, ran: bool) -> DataFrame:
    return with_volume(rows.where(has_line(F.col("line_number"))), [F.col("line_number")], *names, ran=ran)


def line_avg_delay(m: Marts, f: Filters) -> DataFrame:
    ranked = _lines(_of_category(in_period(m.line_perf, m, f), f), AVERAGE_DELAY, ran=True)
    return ranked.orderBy(F.desc_nulls_last(AVERAGE_DELAY), "line_number").limit(15)


def line_cancel(m: Marts, f: Filters) -> DataFrame:
    """The category must match exactly here."""
    rows = where_all(m.line_perf, equals(m.line_perf["train_type"], f.category))
    ranked = _lines(in_period(rows, m, f), CANCELLATION, ran=False)
    return ranked.orderBy(F.desc_nulls_last(CANCELLATION), "line_number").limit(15)


def line_details(m: Marts, f: Filters) -> DataFrame:
    """Lines of which nothing ran stay in, with NULL delay and on-time rate, ahead of the others."""
    ranked = _lines(
        _of_category(in_period(m.line_perf, m, f), f), AVERAGE_DELAY, ON_TIME, CANCELLATION, ACTIVITY, ran=False
    )
    return ranked.orderBy(F.desc_nulls_first(AVERAGE_DELAY), "line_number")


def svc_trend_delay(m: Marts, f: Filters) -> DataFrame:
    """Exact category, lines by substring; months in which nothing ran drop out."""
    line_perf = m.line_perf
    rows = where_all(
        line_perf, [*equals(line_perf["train_type"], f.category), *contains(line_perf["line_number"], f.line)]
    )
    by_month = (
        in_period(rows, m, f)
        .groupBy(F.col("service_month").alias("month"))
        .agg(*_measures(AVERAGE_DELAY), metrics.non_canceled().alias("_ran"))
    )
    return by_month.where(F.col("_ran") > 0).drop("_ran").orderBy("month")


def svc_trend_reliability(m: Marts, f: Filters) -> DataFrame:
    rows = where_all(m.line_perf, contains(m.line_perf["line_number"], f.line))
    return _by_month(_of_category(in_period(rows, m, f), f), ON_TIME, CANCELLATION)


# --- stations -----------------------------------------------------------------------------------------------


def _station_kpi(m: Marts, f: Filters) -> DataFrame:
    return at_stations(selected_and_previous(m.station_perf, m, f), m, f)


def s_kpi_avg(m: Marts, f: Filters) -> DataFrame:
    return _by_month(_station_kpi(m, f), AVERAGE_DELAY)


def _s_kpi_level(m: Marts, f: Filters, level: str) -> DataFrame:
    """Where several stations match, the highest of their values."""
    return _station_kpi(m, f).groupBy(F.col("service_month").alias("month")).agg(F.max(level).alias(level)).orderBy("month")


def s_kpi_median(m: Marts, f: Filters) -> DataFrame:
    return _s_kpi_level(m, f, "median_delay_min")


def s_kpi_p90(m: Marts, f: Filters) -> DataFrame:
    return _s_kpi_level(m, f, "p90_delay_min")


def s_kpi_ontime(m: Marts, f: Filters) -> DataFrame:
    return _by_month(_station_kpi(m, f), ON_TIME)


def s_kpi_cancel(m: Marts, f: Filters) -> DataFrame:
    return _by_month(_station_kpi(m, f), CANCELLATION)


def s_kpi_activity(m: Marts, f: Filters) -> DataFrame:
    rows = m.station_perf.where(F.col("service_month") == selected_month(m, f))
    return at_stations(rows, m, f).agg(*_measures(ACTIVITY))


def _station_vs_network(m: Marts, f: Filters, measure: Callable[..., Column]) -> DataFrame:
    """Both series from one pass: network rows are all rows, station rows are the flagged ones.

    Months without a row of the station drop out, as they would from a join of the two series.
    """
    named = _named_stations(m, f).select("eva", F.lit(True).alias("at_station"))
    rows = in_period(m.station_perf, m, f).join(named, "eva", "left")
    here = F.col("at_station")
    return (
        rows.groupBy(F.col("service_month").alias("month"))
        .agg(
            measure(here).alias("selected_station"),
            measure().alias("network_average"),
            F.count_if(here).alias("_station_rows"),
        )
        .where(F.col("_station_rows") > 0)
        .drop("_station_rows")
        .orderBy("month")
    )


def s_vs_network_delay(m: Marts, f: Filters) -> DataFrame:
    return _station_vs_network(m, f, metrics.weighted_delay)


def s_vs_network_ontime(m: Marts, f: Filters) -> DataFrame:
    return _station_vs_network(m, f, metrics.on_time_pct)


def s_vs_network_cancel(m: Marts, f: Filters) -> DataFrame:
    return _station_vs_network(m, f, metrics.cancellation_pct)


def s_delay_profile(m: Marts, f: Filters) -> DataFrame:
    """Mart rows as they are: a month cut by the coverage change, or several matching stations, give several rows."""
    return (
        at_stations(in_period(m.station_perf, m, f), m, f)
        .select(F.col("service_month").alias("month"), "avg_delay_min", "median_delay_min", "p90_delay_min")
        .orderBy("month")
    )


REPORTS: dict[str, Callable[[Marts, Filters], DataFrame]] = {
    report.__name__: report
    for report in (
        kpi_avg_delay,
        kpi_ontime,
        kpi_cancel,
        kpi_activity,
        trend_delay,
        trend_ontime,
        trend_cancel,
        worst_stations,
        worst_services,
        cat_avg_delay,
        cat_cancel,
        cat_ontime,
        svc_kpi_avg,
        svc_kpi_ontime,
        svc_kpi_cancel,
        svc_kpi_activity,
        line_avg_delay,
        line_cancel,
        line_details,
        svc_trend_delay,
        svc_trend_reliability,
        s_kpi_avg,
        s_kpi_median,
        s_kpi_p90,
        s_kpi_ontime,
        s_kpi_cancel,
        s_kpi_activity,
        s_vs_network_delay,
        s_vs_network_ontime,
        s_vs_network_cancel,
        s_delay_profile,
    )
}


def filter_domains(m: Marts, f: Filters) -> DataFrame:
    """Values each filter offers; lines are those of the chosen categories."""
    lines = where_all(m.dim_train_line, equals(m.dim_train_line["train_type"], f.category))
    domains = {
        "year": m.dim_service_month.select(F.col("service_year").alias("value")),
        "month": m.dim_service_month.select(F.col("month_label").alias("value")),
        "station": m.dim_station.select(F.col("station_name").alias("value")),
        "category": m.dim_train_line.select(F.col("train_type").alias("value")),
        "line": lines.select(F.col("line_number").alias("value")),
    }
    offered = [df.select(F.lit(name).alias("filter"), "value") for name, df in domains.items()]
    return reduce(DataFrame.unionByName, offered).where(F.col("value").isNotNull()).distinct()


def station_lookup(m: Marts, f: Filters) -> DataFrame:
    """Station names with the code the filter resolves to."""
    return _named_stations(m, f).select("station_name", "eva")
