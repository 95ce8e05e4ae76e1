from datetime import date

import numpy as np
import pytest

from lateline.operators import marts as models
from lateline.plans import reports
from lateline.plans.reports import Filters

COLUMNS = (
    "eva string, train_type string, line_number string, station_name string, xml_station_name string, "
    "service_date date, station_coverage_era string, is_canceled boolean, delay_recomputed_min long, is_on_time boolean"
)


@pytest.fixture
def enriched(spark):
    def make(rows):
        base = dict(
            eva="1", train_type="RE", line_number="7", station_name="A", xml_station_name="A",
            service_date=date(2026, 1, 5), station_coverage_era="full_coverage", is_canceled=False, delay_recomputed_min=0,
        )
        full = [{**base, **row} for row in rows]
        for row in full:
            delay = row["delay_recomputed_min"]
            row["is_on_time"] = None if delay is None else delay < 6
        names = [c.split()[0] for c in COLUMNS.split(", ")]
        return spark.createDataFrame([[row[n] for n in names] for row in full], COLUMNS)

    return make


def only(df):
    (row,) = df.collect()
    return row


def test_percentiles_equal_sorting_all_values(enriched):
    delays = [int(v) for v in np.random.default_rng(7).integers(-20, 90, 501)]
    row = only(models.mart_monthly_station_perf(enriched([{"delay_recomputed_min": d} for d in delays])))
    for name, p in models.PERCENTILES.items():
        assert row[name] == pytest.approx(np.quantile(delays, p))
    assert row.avg_delay_min == pytest.approx(np.mean(delays))
    assert row.on_time_count == sum(d < 6 for d in delays)
    assert (row.observation_count, row.service_month) == (501, date(2026, 1, 1))


def test_canceled_rows_count_but_have_no_delay(enriched):
    row = only(models.mart_monthly_station_perf(enriched([{"delay_recomputed_min": 90, "is_canceled": True}, {"delay_recomputed_min": 2}])))
    assert (row.observation_count, row.cancellation_count, row.non_canceled_observation_count) == (2, 1, 1)
    assert (row.avg_delay_min, row.p99_delay_min, row.on_time_count) == (2.0, 2.0, 1)
    assert (row.cancellation_rate, row.on_time_rate) == (0.5, 1.0)


def test_all_canceled_group(enriched):
    row = only(models.mart_monthly_station_perf(enriched([{"is_canceled": True}] * 30)))
    assert (row.avg_delay_min, row.median_delay_min, row.on_time_rate) == (None, None, None)
    assert (row.cancellation_rate, row.eligible_for_ranking) == (1.0, True)


def test_unknown_cancellation_and_unknown_delay(enriched):
    row = only(
        models.mart_monthly_station_perf(
            enriched([{"is_canceled": None, "delay_recomputed_min": 50}, {"delay_recomputed_min": None}, {"delay_recomputed_min": 4}])
        )
    )
    assert (row.observation_count, row.cancellation_count, row.non_canceled_observation_count) == (3, 0, 2)
    assert (row.avg_delay_min, row.on_time_count) == (4.0, 1)


@pytest.mark.parametrize(("n", "eligible"), [(29, False), (30, True)])
def test_ranking_floor(enriched, n, eligible):
    assert only(models.mart_monthly_station_perf(enriched([{}] * n))).eligible_for_ranking is eligible


def test_coverage_change_inside_a_month_gives_two_rows(enriched):
    mart = models.mart_monthly_station_perf(enriched([{"station_coverage_era": "limited_coverage"}, {}]))
    assert mart.count() == 2


def test_null_line_is_a_group(enriched):
    rows = enriched([{"line_number": None}, {"line_number": None}, {}])
    mart = models.mart_monthly_line_perf(rows)
    assert {(r.line_number, r.observation_count) for r in mart.collect()} == {(None, 2), ("7", 1)}
    assert {tuple(r) for r in models.dim_train_line(rows).collect()} == {("RE", None), ("RE", "7")}


def test_hot_station_is_one_record_per_delay(enriched):
    rows = enriched([{"delay_recomputed_min": i % 10} for i in range(5000)])
    assert models.delay_histogram(rows, ["eva"]).count() == 10
    assert only(models.mart_monthly_station_perf(rows)).median_delay_min == 4.5


def test_station_names(enriched):
    rows = enriched(
        [
            {"station_name": None, "xml_station_name": "B"},
            {"station_name": "A", "xml_station_name": "A Hbf"},
            {"eva": "2", "station_name": None, "xml_station_name": "C"},
        ]
    )
    assert {tuple(r) for r in models.dim_station(rows).collect()} == {("1", "A", 2), ("2", "C", 1)}


@pytest.fixture
def marts(enriched):
    def build(rows):
        df = enriched(rows)
        station = models.mart_monthly_station_perf(df)
        return models.Marts(
            station,
            models.mart_monthly_line_perf(df),
            models.dim_station(df),
            models.dim_train_line(df),
            models.dim_service_month(station),
        )

    return build


def values(df):
    return [tuple(r) for r in df.collect()]


def test_month_dimension(marts):
    m = marts([{}, {"service_date": date(2025, 12, 31)}])
    assert set(values(m.dim_service_month)) == {
        (date(2026, 1, 1), "2026", 1, "Jan", "01 - Jan"),
        (date(2025, 12, 1), "2025", 12, "Dec", "12 - Dec"),
    }


def test_selected_month_and_the_one_before(marts):
    m = marts(
        [
            {"service_date": date(2025, 11, 3), "delay_recomputed_min": 1},
            {"service_date": date(2025, 12, 3), "delay_recomputed_min": 2},
            {"service_date": date(2026, 1, 3), "delay_recomputed_min": 4},
        ]
    )
    january = Filters(year="2026", month_label="01 - Jan")
    assert values(reports.kpi_avg_delay(m, january)) == [(date(2025, 12, 1), 2.0), (date(2026, 1, 1), 4.0)]
    assert values(reports.svc_kpi_avg(m, january)) == [(date(2025, 12, 1), 2.0), (date(2026, 1, 1), 4.0)]
    assert values(reports.kpi_activity(m, january)) == [(1,)]
    assert values(reports.kpi_avg_delay(m, Filters(year="1999"))) == []
    assert values(reports.kpi_activity(m, Filters(year="1999"))) == [(None,)]
    assert len(values(reports.trend_delay(m, Filters()))) == 3


def test_weighted_delay_weighs_by_stops_that_ran(marts):
    m = marts([{"eva": "1", "delay_recomputed_min": 10}] + [{"eva": "2", "delay_recomputed_min": 1}] * 3)
    assert values(reports.trend_delay(m, Filters())) == [(date(2026, 1, 1), 3.3)]


def test_half_tenths_round_up_whatever_the_order(marts):
    m = marts([{"eva": str(i), "delay_recomputed_min": d} for i, d in enumerate([17, 17, 17, 18])])
    assert values(reports.trend_delay(m, Filters())) == [(date(2026, 1, 1), 17.3)]


def test_ranking_skips_small_and_canceled_stations(marts):
    m = marts(
        [{"eva": "small", "delay_recomputed_min": 99}] * 29
        + [{"eva": "dead", "is_canceled": True}] * 30
        + [{"eva": "late", "station_name": "L", "delay_recomputed_min": 9}] * 30
        + [{"eva": "fine", "station_name": "F", "delay_recomputed_min": 1}] * 30
    )
    assert values(reports.worst_stations(m, Filters())) == [("L", "late", 9.0, 30), ("F", "fine", 1.0, 30)]


def test_lines_without_a_run_stay_in_the_details(marts):
    m = marts([{"line_number": "dead", "is_canceled": True}] * 30 + [{"line_number": " "}] * 30 + [{"line_number": "ok"}] * 30)
    assert values(reports.line_details(m, Filters())) == [("dead", None, None, 100.0, 30), ("ok", 0.0, 100.0, 0.0, 30)]
    assert values(reports.line_avg_delay(m, Filters())) == [("ok", 0.0)]


def test_category_contains_or_equals(marts):
    m = marts([{"train_type": "RE", "line_number": "a"}] * 30 + [{"train_type": "REX", "line_number": "b"}] * 30)
    assert len(values(reports.line_avg_delay(m, Filters(category="RE")))) == 2
    assert values(reports.line_cancel(m, Filters(category="RE"))) == [("a", 0.0)]
    assert values(reports.line_avg_delay(m, Filters(category="re"))) == []


def test_station_against_network_keeps_only_station_months(marts):
    m = marts(
        [
            {"eva": "1", "station_name": "Xa", "delay_recomputed_min": 10},
            {"eva": "2", "station_name": "Yb", "delay_recomputed_min": 2},
            {"eva": "2", "station_name": "Yb", "service_date": date(2026, 2, 1)},
        ]
    )
    assert values(reports.s_vs_network_delay(m, Filters(station="X"))) == [(date(2026, 1, 1), 10.0, 6.0)]
    assert values(reports.s_kpi_median(m, Filters(month_label="01 - Jan"))) == [(date(2026, 1, 1), 10.0)]


def test_filter_domains(marts):
    m = marts([{"train_type": "RE", "line_number": "7"}, {"train_type": "ICE", "line_number": None}, {"train_type": "S", "line_number": "1"}])
    offered = set(values(reports.filter_domains(m, Filters(category="RE"))))
    assert offered == {
        ("year", "2026"), ("month", "01 - Jan"), ("station", "A"), ("category", "RE"), ("category", "ICE"), ("category", "S"), ("line", "7"),
    }
