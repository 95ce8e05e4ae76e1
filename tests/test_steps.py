"""Staging, deduplication and enrichment on hand-made rows."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from conftest import ns, observation
from lateline.functions import observation as obs
from lateline.operators.observations import DEDUPED_COLUMNS, dedup_latest, enrich
from lateline.operators.staging import decode_times, stage_observations, union_sources
from lateline.sources.raw import derive_source_month, drop_month


def enriched(raw, **options):
    return enrich(dedup_latest(union_sources(monthly=stage_observations(derive_source_month(raw)))), **options)


@pytest.mark.parametrize(
    ("text", "rounded", "truncated"),
    [
        ("2026-01-10T23:33:59.999999999", "2026-01-10T23:34:00", "2026-01-10T23:33:59.999999"),
        ("2026-01-10T10:00:00.499999999", "2026-01-10T10:00:00", "2026-01-10T10:00:00.499999"),
        ("2026-01-10T10:00:00.5", "2026-01-10T10:00:01", "2026-01-10T10:00:00.5"),
        ("1969-12-31T23:59:58.4", "1969-12-31T23:59:58", "1969-12-31T23:59:58.4"),
    ],
)
def test_decoding(spark, text, rounded, truncated):
    df = spark.createDataFrame([(ns(text),), (None,)], "ns long")
    row, empty = df.select(
        obs.decode_ns_rounded(F.col("ns")).alias("r"), obs.decode_ns_truncated(F.col("ns")).alias("t")
    ).collect()
    assert (row.r, row.t) == (datetime.fromisoformat(rounded), datetime.fromisoformat(truncated))
    assert (empty.r, empty.t) == (None, None)


def test_decode_needs_its_columns(observations):
    with pytest.raises(ValueError, match="no_such_time"):
        decode_times(observations(observation("a")), ["time", "no_such_time"])


def test_source_month_is_filled_only_where_missing(spark):
    df = spark.createDataFrame([(ns("2026-01-31T23:59:59"), None), (ns("2026-01-05T00:00:00"), "2025-12")], "time long, source_month string")
    assert [r.source_month for r in derive_source_month(df).collect()] == ["2026-01", "2025-12"]
    assert [r.source_month for r in derive_source_month(df.drop("source_month")).collect()] == ["2026-01", "2026-01"]
    assert [r.source_month for r in drop_month(df, "2025-12").collect()] == [None]


def test_latest_snapshot_wins_and_id_breaks_ties(observations):
    raw = observations(
        observation("a", "2026-01-10T10:00:00", "2026-01-10T10:05:00"),
        observation("c", "2026-01-10T10:00:00", "2026-01-10T10:07:00"),
        observation("b", "2026-01-10T10:00:00", "2026-01-10T10:07:00"),
        observation("z", "2026-02-10T10:00:00"),
        observation("y", train_line_station_num=2),
        observation("x", "2026-01-10T09:00:00", train_line_ride_id=None),
        observation("w", "2026-01-10T08:00:00", train_line_ride_id=None),
    )
    kept = dedup_latest(union_sources(monthly=stage_observations(derive_source_month(raw))))
    assert kept.columns == DEDUPED_COLUMNS
    assert sorted(r.id for r in kept.collect()) == ["c", "x", "y", "z"]


def test_one_stop_with_a_third_of_all_rows_is_cut_before_the_shuffle(observations):
    hot = [observation(f"{i:05d}") for i in range(1000)]
    others = [observation(f"x{i}", train_line_ride_id=f"o{i}") for i in range(2000)]
    kept = dedup_latest(union_sources(monthly=stage_observations(derive_source_month(observations(*hot, *others)))))
    rows = kept.collect()
    assert len(rows) == 2001
    assert [r.id for r in rows if r.train_line_ride_id == "r1"] == ["00999"]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    initial = plan[plan.index("Initial Plan") :] if "Initial Plan" in plan else plan
    assert initial.index(", Final") < initial.index("Exchange") < initial.index(", Partial"), plan


def test_delay_counts_minute_boundaries(observations):
    raw = observations(
        observation("a", "2026-01-10T10:00:59", "2026-01-10T10:01:00", train_line_ride_id="1"),
        observation("b", "2026-01-10T10:01:00", "2026-01-10T10:01:59", train_line_ride_id="2"),
        observation("c", "2026-01-10T10:00:00", "2026-01-10T09:57:00", train_line_ride_id="3"),
        observation("d", "1969-12-31T23:59:30", "1970-01-01T00:00:30", train_line_ride_id="4"),
    )
    got = {r.id: r.delay_recomputed_min for r in enriched(raw).collect()}
    assert got == {"a": 1, "b": 0, "c": -3, "d": 1}


def test_delay_basis_falls_back_to_arrival(observations):
    gone = {"departure_planned_time": None, "departure_change_time": None}
    raw = observations(
        observation("a", "2026-01-10T10:00:00", "2026-01-10T10:06:00", train_line_ride_id="1"),
        observation("b", "2026-01-10T10:00:00", "2026-01-10T10:05:00", train_line_ride_id="2", **gone),
        observation("c", train_line_ride_id="3", departure_change_time=None),
        observation(
            "d", train_line_ride_id="4", arrival_planned_time=None, arrival_change_time=None, time=ns("2026-01-10T10:00:00"), **gone
        ),
    )
    got = {r.id: (r.delay_basis, r.delay_recomputed_min, r.is_on_time) for r in enriched(raw).collect()}
    assert got == {
        "a": ("departure", 6, False),
        "b": ("arrival", 5, True),
        "c": ("arrival", 0, True),
        "d": ("arrival", None, None),
    }


def test_calendar_and_coverage_era(observations):
    raw = observations(
        observation("sun", "2025-11-02T00:00:00", train_line_ride_id="1"),
        observation("sat", "2025-11-01T23:59:00", train_line_ride_id="2"),
        observation("mon", "2026-01-05T07:30:00", train_line_ride_id="3"),
    )
    got = {
        r.id: (r.service_date, r.service_hour, r.service_weekday_num, r.service_weekday_name, r.is_weekend, r.station_coverage_era)
        for r in enriched(raw).collect()
    }
    assert got == {
        "sun": (date(2025, 11, 2), 0, 0, "Sun", True, "full_coverage"),
        "sat": (date(2025, 11, 1), 23, 6, "Sat", True, "limited_coverage"),
        "mon": (date(2026, 1, 5), 7, 1, "Mon", False, "full_coverage"),
    }


def test_line_label(spark):
    df = spark.createDataFrame([("ICE", None), ("ICE", ""), ("ICE", "  "), ("RE", "7")], "t string, l string")
    got = df.select(obs.service_line_label(F.col("t"), F.col("l")).alias("x"), obs.has_line(F.col("l")).alias("h")).collect()
    assert [tuple(r) for r in got] == [("ICE", False), ("ICE", False), ("ICE", False), ("RE 7", True)]


def test_sources_stack_by_name(observations):
    staged = stage_observations(derive_source_month(observations(observation("a"))))
    both = union_sources(monthly=staged, api=staged.select(*reversed(staged.columns)))
    assert sorted((r.id, r.ingestion_source, r.eva) for r in both.collect()) == [("a", "api", "0800"), ("a", "monthly", "0800")]
