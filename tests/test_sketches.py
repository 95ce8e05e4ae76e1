"""Stored sketches: months refreshed one by one, totals without a look at the observations."""

from pyspark.sql import functions as F

from conftest import observation
from lateline.plans.monthly_run import Store
from lateline.plans.sketches import cardinalities, month_sketches, overview, read_sketches, refresh_sketches, total
from lateline.sources.raw import write_raw


def test_totals_come_from_stored_rows(spark, tmp_path, observations):
    store = Store(f"{tmp_path}/s")
    january = [observation(f"a{n}", planned=f"2026-01-{1 + n % 9:02d}T10:00:00", eva=str(n % 30), train_line_ride_id=f"r{n % 50}") for n in range(200)]
    february = [observation(f"b{n}", planned="2026-02-03T10:00:00", eva=str(20 + n % 30), train_line_ride_id=f"r{n % 70}", is_canceled=n == 0) for n in range(100)]

    def load(month, rows):
        write_raw(observations(*rows).withColumn("load_month", F.lit(month)), store.raw)
        refresh_sketches(spark, store, [month])

    load("2026-01", january)
    load("2026-02", february)
    load("2026-01", january[:150])  # a reload replaces its month
    stored = read_sketches(spark, store)
    got = total(stored).first()
    assert (got.row_count, got.distinct_service_dates, got.approx_distinct_eva, got.approx_distinct_rides) == (250, 10, 50, 70)
    by_month = {r.source_month: r for r in overview(stored).collect()}
    assert (by_month["2026-01"].row_count, by_month["2026-01"].approx_distinct_eva, by_month["2026-02"].canceled_rows) == (150, 30, 1)
    assert {r.approx_distinct_count for r in cardinalities(stored).where("source_month = '2026-02' AND column_name = 'eva'").collect()} == {30}
    plan = total(stored)._jdf.queryExecution().optimizedPlan().toString()
    assert "raw_observations" not in plan and "month_sketches" in str(stored.inputFiles())


def test_no_months(spark, observations):
    none = month_sketches(observations(observation("x")).withColumn("source_month", F.lit("2026-01")).limit(0))
    got = total(none).first()
    assert overview(none).collect() == [] and (got.row_count, got.distinct_service_dates) == (0, 0)


def test_nulls_are_no_values(observations):
    rows = observations(*[observation(f"i{n}", line_number=None, eva="" if n else None) for n in range(3)]).withColumn("source_month", F.lit("2026-01"))
    found = {r.column_name: r.approx_distinct_count for r in cardinalities(month_sketches(rows)).collect()}
    assert found["line_number"] == 0 and found["eva"] == 1
