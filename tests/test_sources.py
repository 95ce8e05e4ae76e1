import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import observation
from lateline.contract import OBSERVATION_COLUMNS, OBSERVATION_SCHEMA, TIME_COLUMNS
from lateline.plans import monthly_run
from lateline.plans.monthly_run import CheckFailed, GateFailed, Store
from lateline.sources import bronze, raw, sinks

MAKERS = {"string": pa.string(), "integer": pa.int32(), "long": pa.timestamp("ns"), "boolean": pa.bool_()}


def release_file(path, rows, columns=None):
    """A monthly file as published: one Parquet file with zone-less nanosecond timestamps."""
    names = columns or OBSERVATION_COLUMNS
    kinds = {f.name: MAKERS[f.dataType.typeName()] for f in OBSERVATION_SCHEMA}
    pq.write_table(pa.table({n: pa.array([r[n] for r in rows], kinds[n]) for n in names}), path)
    return str(path)


def month_rows(month, n):
    """Two snapshots to a stop; the published delay agrees with the times."""
    return [
        observation(f"{month}-{i}", f"{month}-{i % 27 + 1:02d}T{i % 24:02d}:10:00", train_line_ride_id=f"r{i // 2}")
        for i in range(n)
    ]


def test_nanosecond_files_read_as_longs(spark, tmp_path):
    rows = [observation("a", "2026-01-10T10:00:00.123456789", arrival_planned_time=None)]
    path = release_file(tmp_path / "data-2026-01.parquet", rows)
    scan = bronze.scan_nanos_parquet(spark, path)
    assert scan.columns == OBSERVATION_COLUMNS
    got = scan.first()
    assert [got[c] for c in TIME_COLUMNS] == [rows[0][c] for c in TIME_COLUMNS]


def test_provenance_from_file_names(spark, tmp_path):
    paths = [release_file(tmp_path / f"data-{m}.parquet", month_rows(m, n)) for m, n in (("2026-01", 3), ("2026-02", 2))]
    scan = bronze.with_provenance(bronze.scan_nanos_parquet(spark, *paths))
    got = {(r.source_month, r.source_file.rsplit("/", 1)[1], r["count"]) for r in scan.groupBy("source_month", "source_file").count().collect()}
    assert got == {("2026-01", "data-2026-01.parquet", 3), ("2026-02", "data-2026-02.parquet", 2)}
    sizes = {r.source_month: (r.file_name, r.file_size_mb) for r in bronze.file_sizes(spark, str(tmp_path)).collect()}
    assert sizes == {m: (f"data-{m}.parquet", 0.0 if small < 0.005 else pytest.approx(small, abs=0.005)) for m, small in (
        ("2026-01", (tmp_path / "data-2026-01.parquet").stat().st_size / 1024**2),
        ("2026-02", (tmp_path / "data-2026-02.parquet").stat().st_size / 1024**2),
    )}


def test_landing_keeps_what_is_there_unless_forced(spark, tmp_path):
    root = str(tmp_path / "bronze")
    first = release_file(tmp_path / "one.parquet", month_rows("2026-01", 3))
    second = release_file(tmp_path / "two.parquet", month_rows("2026-01", 5))
    assert bronze.land_month(spark, first, "2026-01", root)
    assert not bronze.land_month(spark, second, "2026-01", root)
    assert bronze.scan_nanos_parquet(spark, bronze.bronze_path("2026-01", root)).count() == 3
    assert bronze.land_month(spark, second, "2026-01", root, force=True)
    landed = bronze.read_landed(spark, root)
    assert [(r.source_month, r["count"]) for r in landed.groupBy("source_month").count().collect()] == [("2026-01", 5)]
    assert bronze.scan_months(spark, root, ["2026-01"]).count() == 5


def test_unfinished_landing_is_repeated(spark, tmp_path):
    root, source = str(tmp_path / "bronze"), release_file(tmp_path / "one.parquet", month_rows("2026-01", 3))
    unmarked = bronze.scan_nanos_parquet(spark, source).limit(1).write
    unmarked.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(bronze.bronze_path("2026-01", root))
    assert bronze.land_month(spark, source, "2026-01", root)
    assert bronze.read_landed(spark, root).count() == 3


def test_landing_many_months_splits_by_month(spark, observations, tmp_path):
    rows = [r for m in ("2026-01", "2026-02", "2025-12") for r in month_rows(m, 4)]
    root = str(tmp_path / "bronze")
    bronze.land_months(observations(*rows), raw.month_of(raw.decode_ns_truncated(F.col("time"))), root)
    one = bronze.read_landed(spark, root).where(F.col("source_month") == "2026-02")
    assert one.count() == 4
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(concat_ws(-, year" in plan
    assert bronze.read_landed(spark, root).columns == [*OBSERVATION_COLUMNS, "source_month"]


@pytest.fixture
def landed(spark, tmp_path):
    root = str(tmp_path / "bronze")

    def land(month, n, force=True):
        bronze.land_month(spark, release_file(tmp_path / f"{month}-{n}.parquet", month_rows(month, n)), month, root, force=force)
        return root

    return land


def test_load_skips_then_reloads(spark, tmp_path, landed):
    table = str(tmp_path / "raw")
    root = landed("2026-01", 10)
    assert raw.read_raw(spark, table).count() == 0
    assert raw.load_raw(spark, root, table, "2026-01") == 10
    landed("2026-01", 15)
    assert raw.load_raw(spark, root, table, "2026-01") == 10
    assert raw.load_raw(spark, root, table, "2026-01", force=True) == 15
    landed("2026-02", 4)
    assert raw.load_raw(spark, root, table, "2026-02") == 4
    assert raw.load_raw(spark, root, table, "2026-01", force=True) == 15
    assert raw.read_raw(spark, table).count() == 19


def test_failed_load_leaves_the_month_as_it_was(spark, tmp_path, landed):
    table, root = str(tmp_path / "raw"), landed("2026-01", 10)
    raw.load_raw(spark, root, table, "2026-01")
    broken = raw.read_raw(spark, table).withColumn("delay_in_min", F.raise_error("disk gone").cast("int"))
    with pytest.raises(Exception, match="disk gone"):
        raw.write_raw(broken, table, many=False)
    assert raw.count_month(spark, table, "2026-01") == 10


def test_stray_rows_do_not_replace_their_month(spark, tmp_path, observations):
    table = str(tmp_path / "raw")
    raw.write_raw(observations(*month_rows("2026-02", 6)).withColumn("load_month", F.lit("2026-02")), table)
    stray = observations(observation("stray", "2026-02-01T00:03:00"), *month_rows("2026-01", 2))
    raw.write_raw(stray.withColumn("load_month", F.lit("2026-01")), table)
    got = {(r.load_month, r.source_month): r["count"] for r in raw.read_raw(spark, table).groupBy("load_month", "source_month").count().collect()}
    assert got == {("2026-02", "2026-02"): 6, ("2026-01", "2026-02"): 1, ("2026-01", "2026-01"): 2}
    assert raw.count_month(spark, table, "2026-01") == 2


def test_load_needs_a_month(spark, tmp_path):
    with pytest.raises(ValueError):
        raw.load_raw(spark, "x", str(tmp_path), "not-a-month")


def test_monthly_run_end_to_end(spark, tmp_path):
    store = Store(str(tmp_path / "store"))
    source = {m: release_file(tmp_path / f"data-{m}.parquet", month_rows(m, 6)) for m in ("2026-01", "2026-02")}
    assert [tuple(r) for r in monthly_run.run_month(spark, store, "2026-01", source["2026-01"]).collect()] == [("2026-01", 6)]
    monthly_run.run_month(spark, store, "2026-02", source["2026-02"])
    read = lambda name: spark.read.parquet(store.table(name))
    assert read("int_observations_enriched").count() == 6
    by_month = {str(r.service_month): r.observation_count for r in read("mart_monthly_station_perf").collect()}
    assert by_month == {"2026-01-01": 3, "2026-02-01": 3}
    assert read("dim_service_month").count() == 2

    more = release_file(tmp_path / "more.parquet", month_rows("2026-01", 8))
    monthly_run.run_month(spark, store, "2026-01", more, force=True)
    partial = sorted(map(tuple, read("mart_monthly_station_perf").select("eva", "service_month", "observation_count").collect()), key=str)
    monthly_run.build_layers(spark, store, None)
    full = sorted(map(tuple, read("mart_monthly_station_perf").select("eva", "service_month", "observation_count").collect()), key=str)
    assert partial == full and {r[2] for r in full} == {3, 4}


def test_failed_gate_stops_before_loading(spark, tmp_path):
    store = Store(str(tmp_path / "store"))
    stray = release_file(tmp_path / "stray.parquet", [*month_rows("2026-01", 6), observation("late", "2026-02-01T00:00:00")])
    with pytest.raises(GateFailed):
        monthly_run.run_month(spark, store, "2026-01", stray)
    assert raw.read_raw(spark, store.raw).count() == 0
    assert monthly_run.gate(spark, store, "2026-01") == (False, 7)
    assert monthly_run.gate(spark, store, "2026-09") == (False, 0)
    assert not monthly_run.gate_all(spark, store, ["2026-01", "2026-09"])


def test_files_that_are_not_what_they_should_be(spark, tmp_path):
    store = Store(str(tmp_path / "store"))
    bronze.land_month(spark, release_file(tmp_path / "16.parquet", month_rows("2026-01", 6), OBSERVATION_COLUMNS[:-1]), "2026-01", store.bronze)
    assert monthly_run.gate(spark, store, "2026-01") == (False, 6)
    bronze.land_month(spark, release_file(tmp_path / "0.parquet", []), "2026-02", store.bronze)
    assert monthly_run.gate(spark, store, "2026-02") == (False, 0)
    junk = tmp_path / "store/bronze/monthly-raw/year=2026/month=03"
    junk.mkdir(parents=True)
    (junk / "data-2026-03.parquet").write_text("not parquet")
    assert monthly_run.gate(spark, store, "2026-03") == (False, 0)


def test_failed_check_stops_the_run(spark, tmp_path):
    store = Store(str(tmp_path / "store"))
    twice = [*month_rows("2026-01", 6), month_rows("2026-01", 6)[0]]
    with pytest.raises(CheckFailed, match="unique:id"):
        monthly_run.run_month(spark, store, "2026-01", release_file(tmp_path / "twice.parquet", twice))
    wrong = [*month_rows("2026-01", 6), observation("off", "2026-01-05T10:00:00", "2026-01-05T10:04:00", delay_in_min=9, train_line_ride_id="q")]
    with pytest.raises(CheckFailed, match="departure_delay_matches_published"):
        monthly_run.run_month(spark, Store(str(tmp_path / "other")), "2026-01", release_file(tmp_path / "wrong.parquet", wrong))


def test_backfill_equals_single_runs(spark, tmp_path, observations):
    rows = [r for m in ("2026-01", "2026-02") for r in month_rows(m, 6)]
    own = raw.month_of(raw.decode_ns_truncated(F.col("time")))
    done = monthly_run.backfill(observations(*rows), own, Store(str(tmp_path / "all")))
    assert {tuple(r) for r in done.collect()} == {("2026-01", 6, 3), ("2026-02", 6, 3)}
    with pytest.raises(GateFailed, match="2026-03"):
        monthly_run.backfill(observations(*rows), F.lit("2026-03"), Store(str(tmp_path / "wrong")))


def test_backfill_shuffles_rows_once_and_stops_without_made_columns(spark, tmp_path, observations, monkeypatch):
    rows = [r for m in ("2026-01", "2026-02") for r in month_rows(m, 6)]
    plans, replace, write = {}, raw.replace_months, monthly_run.Staged.write
    explained = lambda df: df._jdf.queryExecution().optimizedPlan().toString()

    def replaced(table, by, root, *, many):
        plans["raw"] = "RebalancePartitions" if many else explained(table)
        replace(table, by, root, many=many)

    def written(self, model, name, *args, **options):
        plans[name] = explained(model)
        return write(self, model, name, *args, **options)

    monkeypatch.setattr(raw, "replace_months", replaced)
    monkeypatch.setattr(monthly_run.Staged, "write", written)
    store = Store(str(tmp_path / "store"))
    own = raw.month_of(raw.decode_ns_truncated(F.col("time")))
    monthly_run.backfill(observations(*rows), own, store)
    assert "RebalancePartitions" not in plans["raw"]
    stops = plans[monthly_run.ENRICHED]
    assert stops.index("service_hour") < stops.index("RebalancePartitions") < stops.index("Window")
    assert sorted(r.id for r in raw.read_raw(spark, store.raw).collect()) == sorted(r["id"] for r in rows)


def test_sinks(spark, tmp_path):
    report = spark.createDataFrame([("a", [1, 2], 3.5), ("b", None, None)], "k string, v array<int>, d double")
    sinks.export_reports({"r": report}, str(tmp_path))
    assert spark.read.parquet(f"{tmp_path}/r_parquet").schema["v"].dataType.simpleString() == "array<int>"
    csv = sorted((tmp_path / "r_csv").glob("*.csv"))
    assert len(csv) == 1 and csv[0].read_text().splitlines()[:2] == ["k,v,d", 'a,"1,2",3.5']
    sinks.export_json(report.select(F.struct("k", "v").alias("nested")), f"{tmp_path}/j")
    assert spark.read.json(f"{tmp_path}/j").count() == 2
    sinks.export_tables_csv({"t": report}, f"{tmp_path}/tables")
    assert spark.read.option("header", True).csv(f"{tmp_path}/tables/t").count() == 2
    ddl = sinks.table_definitions(spark, {"t": report.select("k", "d"), "u": report.select(F.current_date().alias("x"))}, "gold")
    assert {tuple(r) for r in ddl.collect()} == {
        ("t", "create table if not exists gold.t (k varchar, d double precision);"),
        ("u", "create table if not exists gold.u (x date);"),
    }


def test_stored_tables_and_views(spark, tmp_path):
    df = spark.range(3)
    assert sinks.save_view(df, "three_rows").count() == 3
    assert sinks.save_table(df, "three_rows_stored", str(tmp_path / "t")).count() == 3
    assert sinks.save_table(df.limit(1), "three_rows_stored", str(tmp_path / "t")).count() == 1
    spark.sql("DROP TABLE three_rows_stored")


def mart_counts(spark, store):
    table = spark.read.parquet(store.table("mart_monthly_station_perf"))
    return {str(r.service_month)[:7]: r.n for r in table.groupBy("service_month").agg(F.sum("observation_count").alias("n")).collect()}


def distinct_stops(month, n):
    return [observation(f"{month}-{i}", f"{month}-10T{i:02d}:10:00", train_line_ride_id=f"{month}-{i}") for i in range(n)]


def test_a_reload_keeps_what_the_neighbour_month_rounds_into(spark, tmp_path):
    store = Store(str(tmp_path / "store"))
    release = lambda name, rows: release_file(tmp_path / name, rows)
    monthly_run.run_month(spark, store, "2026-02", release("feb.parquet", distinct_stops("2026-02", 3)))
    late = observation("late", "2026-01-31T23:59:59.700", train_line_ride_id="late")
    monthly_run.run_month(spark, store, "2026-01", release("jan.parquet", [late, *distinct_stops("2026-01", 2)]))
    assert mart_counts(spark, store) == {"2026-01": 2, "2026-02": 4}
    monthly_run.run_month(spark, store, "2026-01", release("jan2.parquet", distinct_stops("2026-01", 2)), force=True)
    assert mart_counts(spark, store) == {"2026-01": 2, "2026-02": 3}
    monthly_run.run_month(spark, store, "2026-02", release("feb2.parquet", distinct_stops("2026-02", 5)), force=True)
    stepwise = mart_counts(spark, store)
    monthly_run.build_layers(spark, store, None)
    assert stepwise == mart_counts(spark, store) == {"2026-01": 2, "2026-02": 5}


def test_a_full_refresh_forgets_deleted_months(spark, tmp_path):
    store = Store(str(tmp_path / "store"))
    for month in ("2026-01", "2026-02"):
        monthly_run.run_month(spark, store, month, release_file(tmp_path / f"{month}.parquet", distinct_stops(month, 2)))
    assert raw.delete_month(spark, store.raw, "2026-01") and not raw.delete_month(spark, store.raw, "2026-01")
    built = monthly_run.build_layers(spark, store, None)
    assert mart_counts(spark, store) == {"2026-02": 2}
    assert built.dim_service_month.count() == 1
    assert spark.read.parquet(store.table("int_observations_enriched")).count() == 2


def test_a_month_that_fails_its_checks_leaves_all_tables(spark, tmp_path):
    store = Store(str(tmp_path / "store"))
    monthly_run.run_month(spark, store, "2026-01", release_file(tmp_path / "a.parquet", distinct_stops("2026-01", 3)))
    wrong = observation("off", "2026-01-05T10:00:00", "2026-01-05T10:04:00", delay_in_min=9, train_line_ride_id="q")
    with pytest.raises(CheckFailed, match="departure_delay_matches_published"):
        monthly_run.run_month(spark, store, "2026-01", release_file(tmp_path / "b.parquet", [*distinct_stops("2026-01", 3), wrong]), force=True)
    assert spark.read.parquet(store.table("int_observations_enriched")).count() == 3
    assert mart_counts(spark, store) == {"2026-01": 3}
    assert not (tmp_path / "store/_staging").exists() or not list((tmp_path / "store/_staging").iterdir())


def test_an_id_of_another_month_stops_the_run(spark, tmp_path):
    store = Store(str(tmp_path / "store"))
    monthly_run.run_month(spark, store, "2026-01", release_file(tmp_path / "a.parquet", distinct_stops("2026-01", 3)))
    again = observation("2026-01-1", "2026-02-05T10:00:00", train_line_ride_id="q")
    with pytest.raises(CheckFailed, match="unique:id_across_months"):
        monthly_run.run_month(spark, store, "2026-02", release_file(tmp_path / "b.parquet", [again]))


def test_the_month_of_the_era_change_passes(spark, tmp_path):
    store = Store(str(tmp_path / "store"))
    rows = [observation(f"n{d}", f"2025-11-{d:02d}T10:00:00", train_line_ride_id=f"r{d}") for d in (1, 2, 3)]
    monthly_run.run_month(spark, store, "2025-11", release_file(tmp_path / "a.parquet", rows))
    eras = spark.read.parquet(store.table("mart_monthly_station_perf")).select("station_coverage_era").distinct().count()
    assert eras == 2


def test_backfill_leaves_landed_months_and_a_failed_gate_leaves_bronze(spark, tmp_path, observations):
    store = Store(str(tmp_path / "store"))
    own = raw.month_of(raw.decode_ns_truncated(F.col("time")))
    landed = lambda: {r.source_month: r["count"] for r in bronze.read_landed(spark, store.bronze).groupBy("source_month").count().collect()}
    monthly_run.run_month(spark, store, "2026-01", release_file(tmp_path / "a.parquet", distinct_stops("2026-01", 3)))
    monthly_run.backfill(observations(*distinct_stops("2026-02", 4), *distinct_stops("2026-01", 1)), own, store)
    assert landed() == {"2026-01": 3, "2026-02": 4}
    with pytest.raises(GateFailed, match="2026-03"):
        monthly_run.backfill(observations(*distinct_stops("2026-02", 9)), F.lit("2026-03"), store, force=True)
    with pytest.raises(GateFailed, match="schema"):
        monthly_run.backfill(observations(*distinct_stops("2026-02", 9)).drop("id"), own, store)
    assert landed() == {"2026-01": 3, "2026-02": 4}
    monthly_run.backfill(observations(*distinct_stops("2026-02", 2)), own, store, force=True)
    assert landed() == {"2026-01": 3, "2026-02": 2}


def test_the_session_keeps_its_shuffle_setting(spark, tmp_path):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    monthly_run.run_month(spark, Store(str(tmp_path / "s")), "2026-01", release_file(tmp_path / "a.parquet", distinct_stops("2026-01", 3)))
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
