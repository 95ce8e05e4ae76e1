import pytest
from pyspark.sql import functions as F

from conftest import observation
from lateline.contract import OBSERVATION_COLUMNS
from lateline.operators import quality
from lateline.sources.raw import derive_source_month


def counts(df):
    return {r.check: (r.severity, r.failing_rows) for r in df.collect()}


@pytest.fixture
def enriched(spark):
    def make(*rows):
        return spark.createDataFrame(
            rows, "train_type string, line_number string, delay_basis string, delay_recomputed_min long, delay_in_min int"
        )

    return make


def test_row_checks_in_one_pass(enriched):
    df = enriched(
        ("ICE", None, "departure", 5, 5),
        ("ICE", "4", "departure", 6, 5),
        ("RE", None, "arrival", 1439, 5),
        ("RE", "1", "departure", None, 5),
        ("RE", "1", "guess", -1447, -1447),
        (None, None, None, 1440, 5),
    )
    checks = [
        *quality.not_null(["train_type"]),
        quality.accepted_values("delay_basis", ["departure", "arrival"]),
        quality.delay_bounds(),
        quality.departure_matches_published(),
        quality.line_null_iff_long_distance(),
    ]
    assert counts(quality.check_rows(df, checks)) == {
        "not_null:train_type": ("error", 1),
        "accepted_values:delay_basis": ("error", 1),
        "delay_sanity_bounds": ("error", 2),
        "departure_delay_matches_published": ("error", 1),
        "line_number_null_matches_train_type": ("warn", 2),
    }
    assert quality.failing_rows(df, checks[-1]).count() == 2


def test_unique_ignores_nulls_but_a_grain_does_not(spark):
    df = spark.createDataFrame([("a", None), ("a", "1"), (None, None), (None, None), ("b", None), ("b", None)], "id string, line string")
    assert counts(quality.unique(df, "id")) == {"unique:id": ("error", 2)}
    assert counts(quality.unique_grain(df, ["id", "line"])) == {"unique_grain:id+line": ("error", 2)}
    assert quality.repeated_keys(df, ["id", "line"]).count() == 2


def test_declared_checks_add_up(spark):
    tables = [
        "raw_observations", "staged", "unioned", "deduped", "enriched", "dim_station", "dim_train_line", "dim_service_month",
        "mart_monthly_station_perf", "mart_monthly_line_perf",
    ]
    declared = [quality.table_checks(t) for t in tables]
    names = [c.name.split(":")[0] for d in declared for c in d.rows]
    assert names.count("not_null") == 36
    assert names.count("accepted_values") == 3
    assert sum(len(d.unique_columns) for d in declared) == 4
    assert sum(bool(d.grain) for d in declared) == 4
    assert len(names) - 39 == 3
    with pytest.raises(KeyError):
        quality.table_checks("nothing")


def test_audit_by_kind(observations):
    raw = derive_source_month(observations(observation("a"), observation("a"), observation(None)))
    assert {(r.check, r.failing_rows) for r in quality.audit(raw, "raw_observations").collect()} == {
        ("not_null:id", 1), ("not_null:source_month", 0), ("unique:id", 1),
    }
    assert [r.check for r in quality.audit(raw, "raw_observations", ["unique"]).collect()] == ["unique:id"]
    assert quality.audit(raw, "raw_observations", ["accepted_values"]) is None


def verdict(df, month="2026-01"):
    row = quality.gate_month(df, month).first()
    return row.passed, row.row_count, row.failed_at


def test_gate_steps_in_order(observations):
    good = observations(observation("a"), observation("b", "2026-01-31T23:59:59.999999999"))
    assert verdict(good) == (True, 2, None)
    assert verdict(good.limit(0)) == (False, 0, "empty")
    assert verdict(good.drop("line_number")) == (False, 2, "schema")
    assert verdict(good.select(*reversed(OBSERVATION_COLUMNS))) == (False, 2, "schema")
    assert verdict(good.select("*", F.lit(1).alias("more")).limit(0)) == (False, 0, "empty")
    assert verdict(observations(observation("a", eva=None))) == (False, 1, "null_in_required_column")
    assert verdict(observations(observation("a", line_number=None, station_name=None))) == (True, 1, None)
    assert verdict(observations(observation("a"), observation("b", "2026-02-01T00:00:00"))) == (False, 2, "time_outside_month")
    assert verdict(observations(observation("a", "2025-12-31T23:59:59.999999999"))) == (False, 1, "time_outside_month")


def test_gate_over_all_months(observations):
    filed = observations(
        observation("a"), observation("b", "2026-02-01T00:00:00"), observation("c", delay_in_min=None)
    ).withColumn("source_month", F.when(F.col("id") == "c", "2026-01").when(F.col("id") == "b", "2026-03").otherwise("2026-05"))
    got = {r.month: (r.passed, r.failed_at) for r in quality.gate_all_months(filed).collect()}
    assert got == {
        "2026-01": (False, "null_in_required_column"),
        "2026-03": (False, "time_outside_month"),
        "2026-05": (False, "time_outside_month"),
    }


def test_key_assessment(observations):
    raw = derive_source_month(
        observations(
            observation("a"), observation("b"), observation("c", train_line_station_num=2), observation(None, train_line_ride_id=None)
        )
    )
    found = {r.key_name: (r.null_key_row_count, r.duplicate_group_count, r.passes_initial_check) for r in quality.key_assessment(raw).collect()}
    assert found == {
        "id": (1, 0, False),
        "train_line_ride_id": (1, 1, None),
        "train_line_ride_id + train_line_station_num": (1, 1, False),
    }
    clean = quality.key_assessment(derive_source_month(observations(observation("a"), observation("b", "2026-02-01T00:00:00"))))
    assert {tuple(r) for r in quality.key_verdicts(clean).collect()} == {("id", True), ("train_line_ride_id + train_line_station_num", True)}
