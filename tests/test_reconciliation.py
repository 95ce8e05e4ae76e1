"""Two sets of stops held against each other, and the monthly job that does it."""

from pyspark.sql import functions as F

from conftest import observation
from lateline.operators.observations import dedup_latest
from lateline.operators.reconciliation import COMPARED, Tolerance, differences, match_stops, reconcile, verdicts
from lateline.operators.staging import stage_observations, union_sources
from lateline.plans.monthly_run import Store, run_months
from lateline.plans.reconcile import DIFFERENCES, REPORT, official_stops, reconcile_months
from lateline.sources.raw import derive_source_month


def stops(df):
    return dedup_latest(union_sources(monthly=stage_observations(derive_source_month(df))))


def row(n, **columns):
    return observation(f"i{n}", train_line_ride_id=f"r{n}", **columns)


def test_counts(observations):
    here = stops(observations(row(1), row(2, line_number=None), row(3, delay_in_min=4), row(4), row(5, station_name=None)))
    there = stops(observations(row(1), row(2, line_number=None), row(3, delay_in_min=5, station_name="X"), row(5), row(6)))
    (got,) = reconcile(here, there).collect()
    found = {k: v for k, v in got.asDict().items() if v and k != "source_month"}
    assert found == {"matched": 4, "only_here": 1, "only_there": 1, "differing": 2, "differing_delay_in_min": 1, "differing_station_name": 2}
    listed = {(r.train_line_ride_id, r["column"], r.here, r.there) for r in differences(here, there).collect()}
    assert listed == {
        ("r3", "delay_in_min", "4", "5"), ("r3", "station_name", "Aville", "X"), ("r5", "station_name", None, "Aville"),
        ("r4", "only_here", None, None), ("r6", "only_there", None, None),
    }


def test_nothing_to_compare(observations):
    some, none = stops(observations(row(1))), stops(observations(row(1))).limit(0)
    assert reconcile(none, none).collect() == [] and differences(none, none).collect() == []
    (got,) = verdicts(reconcile(some, none)).collect()
    assert (got.only_here, got.missing_share, got.passed) == (1, None, False)
    (got,) = verdicts(reconcile(none, some)).collect()
    assert (got.only_there, got.missing_share, got.passed) == (1, 1.0, False)


def test_a_key_with_a_null_matches_nothing(observations):
    rows = stops(observations(row(1, train_line_station_num=None), row(2)))
    (got,) = reconcile(rows, rows).collect()
    assert (got.matched, got.only_here, got.only_there, got.differing) == (1, 1, 1, 0)


def test_verdicts(observations):
    here = stops(observations(*[row(n) for n in range(100)]))
    there = stops(observations(*[row(n, delay_in_min=int(n < 2)) for n in range(100)]))
    report = reconcile(here, there)
    assert not verdicts(report).first().passed
    assert verdicts(report, Tolerance(differing=0.02)).first().passed


def test_the_join_reuses_the_shuffles_of_the_deduplication(observations):
    some = observations(*[row(n) for n in range(20)])
    spark = some.sparkSession
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = match_stops(stops(some), stops(some))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert plan.count("Exchange hashpartitioning") == 2 and "FullOuter" in plan


def test_monthly_job(spark, tmp_path, observations):
    store = Store(f"{tmp_path}/store")

    def released(name, *rows):
        observations(*rows).write.parquet(f"{tmp_path}/{name}")
        return f"{tmp_path}/{name}"

    january = [row(n) for n in range(40)]
    february = [row(n, planned="2026-02-03T10:00:00") for n in range(100, 120)]
    run_months(spark, store, {"2026-01": released("a", *january), "2026-02": released("b", *february)})
    for n, differing in enumerate((0, 1)):  # a second release replaces the report of its month
        official = released(f"official{n}", *january[1:], {**row(0), "delay_in_min": differing})
        got = reconcile_months(spark, store, [official], ["2026-01"]).collect()
        assert [(r.source_month, r.matched, r.differing, r.passed) for r in got] == [("2026-01", 40, differing, not differing)]
    again = reconcile_months(spark, store, [f"{tmp_path}/b"], ["2026-02"]).collect()
    assert [(r.source_month, r.matched, r.only_here, r.only_there, r.differing) for r in again] == [("2026-02", 20, 0, 0, 0)]
    stored = spark.read.parquet(store.table(REPORT))
    assert sorted(str(r.source_month) for r in stored.collect()) == ["2026-01", "2026-02"]
    assert [(r["column"], r.here, r.there) for r in spark.read.parquet(store.table(DIFFERENCES)).collect()] == [("delay_in_min", "0", "1")]


def test_official_stops_have_the_grain_of_the_stored_ones(observations):
    release = observations(row(1), {**row(1), "id": "later", "time": row(1)["time"] + 60_000_000_000})
    (got,) = official_stops(release).collect()
    assert got.id == "later" and set(COMPARED) < set(official_stops(release).columns)
    assert official_stops(release).where(F.col("ingestion_source") == "official").count() == 1
