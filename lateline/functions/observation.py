"""Row-level expressions on observations. All of them stay inside generated code; none needs a shuffle."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from lateline.contract import COVERAGE_CUTOVER, NS_PER_MINUTE, NS_PER_SECOND, ON_TIME_BELOW_MIN, RANKING_FLOOR


def _div(left: Column, right: int) -> Column:
    return F.call_function("div", left, F.lit(right))


def decode_ns_rounded(ns: Column) -> Column:
    """Nanoseconds to a timestamp at the nearest whole second, halves away from zero, in integer arithmetic."""
    half = NS_PER_SECOND // 2
    return F.timestamp_seconds(_div(ns + F.when(ns < 0, -half).otherwise(half), NS_PER_SECOND))


def decode_ns_truncated(ns: Column) -> Column:
    """Nanoseconds to a timestamp with the digits below a microsecond dropped."""
    return F.timestamp_micros(_div(ns, 1000))


def month_of(ts: Column) -> Column:
    """``yyyy-MM``, put together from the numbers; a pattern formatter costs several times as much per row."""
    return F.concat(F.lpad(F.year(ts).cast("string"), 4, "0"), F.lit("-"), F.lpad(F.month(ts).cast("string"), 2, "0"))


def delay_basis() -> Column:
    both = F.col("departure_planned_time").isNotNull() & F.col("departure_change_time").isNotNull()
    return F.when(both, "departure").otherwise("arrival")


def minute_boundaries(start: Column, end: Column) -> Column:
    """Minute boundaries crossed between two timestamps, so 10:00:59 to 10:01:00 is one."""

    def minute(ts: Column) -> Column:
        seconds = F.unix_seconds(ts)
        return _div(seconds - F.pmod(seconds, F.lit(60)), 60)

    return minute(end) - minute(start)


def delay_recomputed_min(basis: Column) -> Column:
    return F.when(
        basis == "departure",
        minute_boundaries(F.col("departure_planned_time"), F.col("departure_change_time")),
    ).otherwise(minute_boundaries(F.col("arrival_planned_time"), F.col("arrival_change_time")))


def weekday_num(ts: Column) -> Column:
    """Sunday is 0."""
    return F.dayofweek(ts) - 1


def weekday_name(ts: Column) -> Column:
    return F.dayname(F.to_date(ts))


def is_weekend(name: Column) -> Column:
    return name.isin("Sat", "Sun")


def coverage_era(service_date: Column, cutover: date = COVERAGE_CUTOVER) -> Column:
    return F.when(service_date < F.lit(cutover), "limited_coverage").otherwise("full_coverage")


def is_on_time(delay: Column, below: int = ON_TIME_BELOW_MIN) -> Column:
    return delay < below


def service_month(service_date: Column) -> Column:
    return F.trunc(service_date, "month")


def month_attributes(month: Column) -> list[Column]:
    return [
        F.date_format(month, "yyyy").alias("service_year"),
        F.month(month).alias("month_number"),
        F.date_format(month, "MMM").alias("month_name"),
        F.date_format(month, "MM - MMM").alias("month_label"),
    ]


def has_line(line: Column) -> Column:
    return line.isNotNull() & (F.trim(line) != "")


def service_line_label(train_type: Column, line: Column) -> Column:
    return F.when(has_line(line), F.concat(train_type, F.lit(" "), line)).otherwise(train_type)


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` as double, NULL where the whole is zero."""
    return part.cast("double") / F.nullif(whole, F.lit(0))


def pct(part: Column, whole: Column, digits: int) -> Column:
    return F.round(F.lit(100.0) * part / F.nullif(whole, F.lit(0)), digits)


def eligible_for_ranking(observations: Column, floor: int = RANKING_FLOOR) -> Column:
    return observations >= floor


def time_match_category() -> Column:
    at, arrival, departure = F.col("time"), F.col("arrival_change_time"), F.col("departure_change_time")
    on_arrival, on_departure = F.coalesce(at == arrival, F.lit(False)), F.coalesce(at == departure, F.lit(False))
    return (
        F.when(at.isNull(), "time_null")
        .when(on_arrival & on_departure, "matches_both")
        .when(on_arrival, "matches_arrival_only")
        .when(on_departure, "matches_departure_only")
        .otherwise("matches_neither")
    )


def delay_candidates() -> dict[str, Column]:
    """Delay by event, whether ``time`` makes the event comparable, and whether it reproduces the published delay."""
    columns: dict[str, Column] = {}
    for event in ("arrival", "departure"):
        planned, change = F.col(f"{event}_planned_time"), F.col(f"{event}_change_time")
        minutes = (change - planned).cast("double") / F.lit(float(NS_PER_MINUTE))
        eligible = (
            F.col("time").isNotNull() & planned.isNotNull() & change.isNotNull() & (F.col("time") == change)
        )
        columns[f"{event}_delay_calc_min"] = minutes
        columns[f"{event}_candidate_eligible"] = eligible
        columns[f"{event}_matches_published"] = (
            eligible & F.col("delay_in_min").isNotNull() & (F.abs(minutes - F.col("delay_in_min")) < 1e-9)
        )
    columns["any_event_candidate_eligible"] = (
        columns["arrival_candidate_eligible"] | columns["departure_candidate_eligible"]
    )
    columns["any_event_matches_published"] = (
        columns["arrival_matches_published"] | columns["departure_matches_published"]
    )
    return columns
