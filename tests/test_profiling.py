import json
import math
import random
import statistics
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from conftest import observation
from lateline.contract import DELAY_BANDS_MIN, OBSERVATION_COLUMNS, PROFILE_PERCENTILES
from lateline.functions import observation as obs
from lateline.operators import quality
from lateline.plans import catalog, profile_run, profiling
from lateline.sources import sinks
from lateline.sources.bronze import land_months
from lateline.workspace import Workspace


def scatter(n=400, seed=5):
    """Seeded rows with nulls, repeats, hot stops and odd times in every column a report looks at."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        day, minute, delay = rng.randint(1, 28), rng.randint(0, 59), rng.randint(-9, 40)
        base = f"2026-0{rng.randint(1, 2)}-{day:02d}T{rng.randint(0, 22):02d}"
        planned = f"{base}:{minute:02d}:00"
        row = observation(
            f"i{i if rng.random() < 0.97 else 0}",
            planned,
            delay_in_min=delay,
            station_name=rng.choice([None, "A", "B"]),
            xml_station_name=rng.choice(["A", "B", None]),
            eva=rng.choice(["1", "2", "3"]),
            line_number=rng.choice([None, "5"]),
            train_type=rng.choice(["RE", "ICE", "S"]),
            is_canceled=rng.choice([True, False, False, None]),
            train_line_ride_id="hot" if rng.random() < 0.34 else f"r{rng.randint(0, 40)}",
            train_line_station_num=rng.choice([1, 2]),
        )
        shift = delay * 60 * 10**9 + rng.choice([0, 0, 0, 10**9])
        for event in ("arrival", "departure"):
            row[f"{event}_change_time"] += shift
            if rng.random() < 0.2:
                row[f"{event}_change_time"] = None
            if rng.random() < 0.1:
                row[f"{event}_planned_time"] = None
        row["time"] = row["departure_change_time"] or row["arrival_change_time"]
        row["source_month"] = planned[:7]
        rows.append(row)
    return rows


ROWS = scatter()


@pytest.fixture(scope="module")
def profiled(spark):
    from lateline.contract import OBSERVATION_SCHEMA

    schema = f"{OBSERVATION_SCHEMA.simpleString()[7:-1].replace(':', ' ')}, source_month string"
    names = [*OBSERVATION_COLUMNS, "source_month"]
    return spark.createDataFrame([[r[c] for c in names] for r in ROWS], schema).repartition(5).cache()


def rows_by(df, *key):
    return {tuple(r[k] for k in key) if len(key) > 1 else r[key[0]]: r.asDict() for r in df.collect()}


def by_month(rows=ROWS):
    months = defaultdict(list)
    for r in rows:
        months[r["source_month"]].append(r)
    return months


def test_counters_from_one_scan_equal_the_single_reports(profiled):
    together = profiling.reports_from_counters(profiling.monthly_counters(profiled))
    assert set(together) == set(profiling.MONTHLY_REPORTS)
    for name, report in together.items():
        alone = profiling.monthly_report(profiled, name)
        assert alone.columns == report.columns
        assert sorted(map(str, alone.collect())) == sorted(map(str, report.collect()))


def test_null_profile(profiled):
    got = rows_by(profiling.monthly_report(profiled, "null_profile"), "source_month", "column_name")
    for month, rows in by_month().items():
        for c in OBSERVATION_COLUMNS:
            nulls = sum(r[c] is None for r in rows)
            found = got[month, c]
            assert (found["row_count"], found["null_count"]) == (len(rows), nulls)
            assert found["null_rate_pct"] == pytest.approx(100 * nulls / len(rows), abs=1e-4)
    shown = profiling.nonzero_nulls(profiling.monthly_report(profiled, "null_profile"))
    assert all(r.null_count > 0 for r in shown.collect())


def test_recompute_validation(profiled):
    got = rows_by(profiling.monthly_report(profiled, "delay_recompute_validation"), "source_month")
    for month, rows in by_month().items():
        eligible, matching, both, same = Counter(), Counter(), 0, 0
        for r in rows:
            calc, ok, match = {}, {}, {}
            for e in ("arrival", "departure"):
                p, c = r[f"{e}_planned_time"], r[f"{e}_change_time"]
                calc[e] = None if p is None or c is None else (c - p) / 60e9
                ok[e] = calc[e] is not None and r["time"] == c
                match[e] = ok[e] and abs(calc[e] - r["delay_in_min"]) < 1e-9
            for e in ("arrival", "departure"):
                eligible[e] += ok[e]
                matching[e] += match[e]
            eligible["any_event"] += any(ok.values())
            matching["any_event"] += any(match.values())
            both += all(ok.values())
            same += all(ok.values()) and abs(calc["arrival"] - calc["departure"]) < 1e-9
        found = got[month]
        for e in ("arrival", "departure", "any_event"):
            assert (found[f"{e}_eligible_rows"], found[f"{e}_match_rows"]) == (eligible[e], matching[e])
        assert found["rows_where_time_matches_both_events"] == both
        assert found["both_event_rows_with_same_calculated_delay"] == same
    wrong = profiling.delay_recompute_mismatches(profiled)
    assert wrong.count() == sum(f["any_event_eligible_rows"] - f["any_event_match_rows"] for f in got.values())
    assert profiling.mismatch_sample(wrong, 3).count() == 3


def test_stops_and_samples(profiled):
    groups = defaultdict(list)
    for r in ROWS:
        groups[r["source_month"], r["train_line_ride_id"], r["train_line_station_num"]].append(r)
    distinct = lambda rows, c: len({r[c] for r in rows} - {None})
    got = rows_by(profiling.ride_stop_groups(profiled), *profiling.RIDE_STOP)
    assert set(got) == set(groups)
    for key, rows in groups.items():
        assert got[key]["observation_count"] == len(rows)
        assert got[key]["distinct_ids"] == distinct(rows, "id")
        assert got[key]["distinct_time_values"] == distinct(rows, "time")
        assert got[key]["distinct_arrival_change_values"] == distinct(rows, "arrival_change_time")
        assert got[key]["maximum_delay"] == max(r["delay_in_min"] for r in rows)

    summary = rows_by(profiling.ride_stop_duplicate_summary(profiled), "source_month")
    for month, found in summary.items():
        repeated = [rows for key, rows in groups.items() if key[0] == month and len(rows) > 1]
        assert found["duplicate_business_key_groups"] == len(repeated)
        assert found["rows_in_duplicate_groups"] == sum(map(len, repeated))
        assert found["max_observations_per_business_key"] == max(map(len, repeated))
        for name, c in profiling.CHANGE_COUNTERS.items():
            assert found[name] == sum(distinct(rows, c) > 1 for rows in repeated), name

    samples = [tuple(r[k] for k in profiling.RIDE_STOP) for r in profiling.repeated_ride_stop_samples(profiled, 7).collect()]
    ranked = sorted(
        (k for k, rows in groups.items() if len(rows) > 1),
        key=lambda k: (-len(groups[k]), -distinct(groups[k], "delay_in_min"), *map(str, k)),
    )
    assert samples == ranked[:7]
    assert {s[1] for s in samples[:4]} == {"hot"}


def test_drill_in(profiled):
    rows = profiling.inspect_ride_stop(profiled, "hot", 1, "2026-01").collect()
    assert len(rows) == sum(
        (r["train_line_ride_id"], r["train_line_station_num"], r["source_month"]) == ("hot", 1, "2026-01") for r in ROWS
    )
    assert "departure_change_time_ts" in rows[0].asDict()
    times = [r.time_ts for r in rows if r.time_ts]
    assert times == sorted(times)


def test_ids(profiled):
    got = rows_by(profiling.id_key_profile(profiled), "source_month")
    for month, rows in by_month().items():
        ids = Counter(r["id"] for r in rows)
        assert got[month]["duplicate_id_groups"] == sum(n > 1 for n in ids.values())
        assert got[month]["duplicate_excess_rows"] == sum(n - 1 for n in ids.values())
        assert got[month]["max_observations_per_id"] == max(ids.values())


def test_rows_equal_but_for_the_id(observations):
    df = observations(observation("a"), observation("b"), observation("c", eva="9")).withColumn("source_month", F.lit("2026-01"))
    assert [tuple(r) for r in profiling.semantic_duplicate_summary(df).collect()] == [("2026-01", 1, 2, 1)]


def test_delay_profile(profiled):
    got = rows_by(profiling.delay_profile(profiled), "source_month")
    for month, rows in by_month().items():
        delays = sorted(r["delay_in_min"] for r in rows if r["is_canceled"] is False)
        found = got[month]
        assert found["non_canceled_rows"] == len(delays)
        assert (found["minimum_delay_min"], found["maximum_delay_min"]) == (delays[0], delays[-1])
        nearest = [delays[math.ceil(Fraction(str(p)) * len(delays)) - 1] for p in PROFILE_PERCENTILES]
        assert found["average_delay_min"] == pytest.approx(statistics.mean(delays), abs=1e-4)
        assert found["stddev_delay_min"] == pytest.approx(statistics.stdev(delays), abs=1e-4)
        assert found["delay_percentiles_p01_p05_p25_p50_p75_p90_p95_p99"] == nearest
        for band in DELAY_BANDS_MIN:
            assert found[f"delay_ge_{band}_min_rows"] == sum(d >= band for d in delays)


def test_delay_profile_without_delays(observations):
    rows = [observation("a", delay_in_min=None), observation("b", "2026-02-01T00:00:00", delay_in_min=3)]
    df = observations(*rows, observation("c", is_canceled=True)).withColumn("source_month", F.expr("if(id = 'b', '02', '01')"))
    got = rows_by(profiling.delay_profile(df), "source_month")
    percentiles = "delay_percentiles_p01_p05_p25_p50_p75_p90_p95_p99"
    assert [got["01"][c] for c in ("non_canceled_rows", "delay_null_rows", "average_delay_min", percentiles)] == [1, 1, None, None]
    assert [got["02"][c] for c in ("average_delay_min", "stddev_delay_min", percentiles)] == [3.0, None, [3] * 8]


def test_exact_counts_send_no_row_several_times(spark, profiled):
    reports = [profiling.monthly_overview, profiling.total_scope_summary, profiling.cardinality_profile]
    for report in reports:
        plan = report(profiled, exact=True)._jdf.queryExecution().optimizedPlan().toString()
        assert "Expand" not in plan and "collect_set" not in plan, report.__name__
    lost = profiled.withColumn("source_month", F.when(F.col("source_month") == "2026-01", "2026-01"))
    lost = lost.withColumn("eva", F.when(F.col("source_month").isNotNull() & (F.col("eva") != "2"), F.col("eva")))
    rows = lost.collect()
    overview = {r.source_month: r for r in profiling.monthly_overview(lost, exact=True).collect()}
    assert set(overview) == {None, "2026-01"}
    for month, found in overview.items():
        own = [r for r in rows if r.source_month == month]
        assert (found.row_count, found.canceled_rows) == (len(own), sum(r.is_canceled is True for r in own))
        assert found.distinct_eva == len({r.eva for r in own} - {None})
        assert found.distinct_rides == len({r.train_line_ride_id for r in own})
        assert found.distinct_train_numbers == len({r.train_number for r in own})
        assert found.distinct_service_dates == len({r.time // 86_400_000_000_000 for r in own if r.time is not None})
    empty = profiling.total_scope_summary(profiled.limit(0), exact=True).collect()
    assert [tuple(r) for r in empty] == [(0, None, None, 0, 0, 0)]
    assert profiling.monthly_overview(profiled.limit(0), exact=True).count() == 0


def test_sketches_stay_near_the_exact_counts(profiled):
    exact = rows_by(profiling.cardinality_profile(profiled, exact=True), "source_month", "column_name")
    for key, row in rows_by(profiling.cardinality_profile(profiled), "source_month", "column_name").items():
        assert row["approx_distinct_count"] == pytest.approx(exact[key]["distinct_count"], rel=0.08, abs=0)
    month = "2026-01"
    overview = rows_by(profiling.monthly_overview(profiled), "source_month")[month]
    assert overview["distinct_service_dates"] == rows_by(profiling.dataset_summary(profiled), "source_month")[month]["distinct_service_dates"]
    assert overview["canceled_rows"] == sum(r["is_canceled"] is True for r in by_month()[month])
    total = profiling.total_scope_summary(profiled).first()
    assert total.row_count == len(ROWS)
    daily = profiling.daily_coverage(profiled)
    summary = rows_by(profiling.daily_coverage_summary(daily), "source_month")[month]
    assert summary["maximum_daily_approx_eva"] == 3


def test_shares_add_up(profiled):
    for report, share in ((profiling.time_match_profile, "rate_pct"), (profiling.cancellation_profile, "status_rate_pct")):
        sums = report(profiled).groupBy("source_month").agg(F.sum(share).alias("s"), F.sum("row_count").alias("n"))
        for r in sums.collect():
            assert r.s == pytest.approx(100, abs=0.01)
            assert r.n == len(by_month()[r.source_month])


def test_top_types_and_station_names(profiled):
    top = profiling.top_train_types(profiled, 2).collect()
    for month, rows in by_month().items():
        counts = sorted(Counter(r["train_type"] for r in rows).items(), key=lambda x: (-x[1], x[0]))[:2]
        assert [(r.train_type, r.row_count) for r in top if r.source_month == month] == counts
    names = profiling.eva_station_name_profile(profiled)
    assert {r.distinct_resolved_station_names for r in names.collect()} == {2}
    assert profiling.unstable_station_names(names).count() == 3
    lines = rows_by(profiling.line_null_by_train_type(profiled), "train_type")
    assert lines["RE"]["line_number_null_count"] == sum(r["train_type"] == "RE" and r["line_number"] is None for r in ROWS)


def test_hours_and_weekdays(profiled):
    assert sum(r.row_count for r in profiling.hour_coverage(profiled).collect()) == len(ROWS)
    names = {r.service_weekday_num_profile: r.service_weekday_name_profile for r in profiling.weekday_coverage(profiled).collect()}
    assert names[1] == "Sun" and names[7] == "Sat"


def test_schema_comparison(spark):
    schemas = {
        "2026-01": spark.createDataFrame([], "a int, b string").schema,
        "2026-02": spark.createDataFrame([], "a long, c string").schema,
        "2026-03": spark.createDataFrame([], "b string, a int").schema,
    }
    rows = catalog.schema_rows(spark, schemas)
    compared = catalog.schema_field_comparison(rows, "2026-01")
    assert {(r.period, r.column_name) for r in catalog.schema_differences(compared).collect()} == {
        ("2026-02", "a"), ("2026-02", "b"), ("2026-02", "c"),
    }
    assert compared.count() == 7
    summary = rows_by(catalog.schema_month_summary(rows, "2026-01"), "period")
    assert [summary[m]["matches_reference_schema"] for m in sorted(summary)] == [True, False, False]
    assert not summary["2026-01"]["matches_catalog_column_order"]
    assert summary["2026-02"]["unexpected_columns"] == "a, c"
    assert "station_name" in summary["2026-02"]["missing_expected_columns"].split(", ")


def test_column_catalog(spark, profiled, tmp_path):
    documented = catalog.documented_columns(spark)
    schema = catalog.schema_rows(spark, {"all": profiled.schema})
    columns = catalog.column_catalog(schema, documented)
    found = rows_by(columns, "column_name")
    assert found["eva"]["business_role"] == "identifier"
    assert (found["source_month"]["business_role"], found["source_month"]["verification_status"]) == ("unknown", "to_verify")
    coverage = catalog.catalog_coverage(schema, documented.where("column_name <> 'eva'")).first()
    assert (coverage.columns_without_documentation, coverage.documentation_without_column) == ("eva, source_month", "")
    assert coverage.coverage_pct == pytest.approx(100 * 16 / 18)
    missing = catalog.catalog_coverage(schema.where("column_name <> 'id'"), documented).first()
    assert missing.documentation_without_column == "id"

    facts = catalog.dataset_catalog(profiling.dataset_summary(profiled), quality.key_verdicts(quality.key_assessment(profiled)))
    attributes = rows_by(facts, "catalog_attribute")
    assert json.loads(attributes["sample_row_counts"]["catalog_value"]) == {m: len(r) for m, r in by_month().items()}
    assert attributes["candidate_primary_key_passes_samples"]["catalog_value"] == "false"
    sinks.export_json(catalog.catalog_document(columns, facts), str(tmp_path / "catalog"))
    back = spark.read.json(str(tmp_path / "catalog")).first()
    assert len(back.column_metadata) == 18 and back.catalog.source_format == "Parquet"
    assert catalog.decision_register(spark).count() == 11


def test_exports(spark, observations, tmp_path):
    root, out = str(tmp_path / "bronze"), str(tmp_path / "out")
    plain = observations(*[{c: r[c] for c in OBSERVATION_COLUMNS} for r in ROWS])
    month = obs.month_of(obs.decode_ns_truncated(F.col("time")))
    land_months(plain.where("time IS NOT NULL"), month, root)
    profile_run.export_profile(spark, root, out, Workspace(spark, f"profile-{tmp_path.name}"))
    profile_run.export_catalog(spark, root, out)
    written = {p.name for p in (tmp_path / "out").iterdir()}
    assert len([n for n in written if n.endswith("_csv")]) == 18 + 5
    assert {"delay_profile_parquet", "null_profile_csv", "modelling_decisions_csv", "column_catalog_csv", "catalog_json"} <= written
    assert spark.read.parquet(f"{out}/null_profile_parquet").count() == 17 * len(by_month())
    assert spark.read.json(f"{out}/catalog_json").count() == 1
