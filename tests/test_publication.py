"""Publications that break off at any point, and what later runs make of them."""

import json
import shutil
from pathlib import Path

import pytest

from conftest import observation
from lateline.plans import catalog, publication
from lateline.plans.monthly_run import ENRICHED, MARTS, STATION_NAMES, TRAIN_LINES, GateFailed, Store, build_layers, gate, run_months
from lateline.plans.publication import Staged, journal_folder, recover, replay
from lateline.workspace import files, read_file, write_file

TABLES = (ENRICHED, STATION_NAMES, TRAIN_LINES, *MARTS, "dim_station", "dim_train_line", "dim_service_month")


class Crash(Exception):
    """Not an error that any code expects."""


def content(spark, root):
    """All rows of the tables that a run publishes."""
    tables = {}
    for name in TABLES:
        rows = spark.read.parquet(f"{root}/{name}")
        tables[name] = sorted(map(repr, rows.selectExpr(*[f"cast({c} as string) as {c}" for c in sorted(rows.columns)]).collect()))
    return tables


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    """Two months; then January anew without the row that its rounding carried into February."""
    from lateline.contract import OBSERVATION_SCHEMA

    root = tmp_path_factory.mktemp("publication")

    def release(name, *rows):
        spark.createDataFrame([[r[c] for c in OBSERVATION_SCHEMA.fieldNames()] for r in rows], OBSERVATION_SCHEMA).write.parquet(f"{root}/{name}")
        return f"{root}/{name}"

    edge = observation("edge", planned="2026-01-31T23:59:59.7", train_line_ride_id="edge", eva="0802")
    january = [observation(f"a{n}", train_line_ride_id=f"a{n}") for n in range(5)]
    february = [observation(f"b{n}", planned="2026-02-03T10:00:00", train_line_ride_id=f"b{n}", eva="0801") for n in range(3)]
    lake = Store(f"{root}/store")
    run_months(spark, lake, {"2026-01": release("jan", edge, *january), "2026-02": release("feb", *february)})
    before = content(spark, lake.root)
    again = release("jan2", *january[1:])
    return lake, again, before


@pytest.fixture
def broken_off(spark, store, tmp_path, monkeypatch):
    """A copy of the store with the reload of January staged and its journal written, no folder moved."""
    lake, again, _ = store
    shutil.copytree(lake.root, f"{tmp_path}/store")
    copy = Store(f"{tmp_path}/store")

    def crash(*_):
        raise Crash

    monkeypatch.setattr(publication, "replay", crash)
    with pytest.raises(Crash):
        run_months(spark, copy, {"2026-01": again}, force=True)
    monkeypatch.undo()
    return copy


def test_a_run_that_breaks_off_after_any_move_is_finished_by_the_next(spark, store, broken_off, tmp_path):
    lake, again, before = store
    assert content(spark, broken_off.root) == before  # nothing shows yet
    full = Store(f"{tmp_path}/full")
    shutil.copytree(broken_off.root, full.root)
    shutil.rmtree(journal_folder(full.root))
    build_layers(spark, full, None)
    want = content(spark, full.root)
    assert want != before and not any("0802" in r for r in want[MARTS[0]])
    (name,) = [n for n in files(spark, journal_folder(broken_off.root)) if n.endswith(".json")]
    moves = json.loads(read_file(spark, f"{journal_folder(broken_off.root)}/{name}"))["moves"]
    assert len(moves) >= 10
    for k in range(len(moves) + 1):
        part = f"{tmp_path}/part{k}"
        shutil.copytree(broken_off.root, part)
        journal = f"{journal_folder(part)}/{name}"
        listed = read_file(spark, journal).replace(broken_off.root, part)
        Path(journal).unlink()
        write_file(spark, journal, listed)
        for source, target in [(s and s.replace(broken_off.root, part), t.replace(broken_off.root, part)) for s, t in moves[:k]]:
            shutil.rmtree(target, ignore_errors=True)
            if source:
                shutil.move(source, target)
        if k < len(moves):  # the next move got as far as putting the old folder aside
            target = Path(moves[k][1].replace(broken_off.root, part))
            if moves[k][0] and target.exists():
                target.rename(target.parent / f"_old-{target.name}")
        recover(spark, part)
        assert content(spark, part) == want, k
        assert not Path(part, "_staging").exists() or not list(Path(part, "_staging").iterdir())
        assert not [f for f in Path(part).rglob("_old-*")] and recover(spark, part) == 0


def test_the_next_run_finishes_and_goes_on(spark, store, broken_off, tmp_path):
    _, again, _ = store
    run_months(spark, broken_off, {"2026-01": again}, force=True)
    marts = content(spark, broken_off.root)
    build_layers(spark, broken_off, None)
    assert content(spark, broken_off.root) == marts


def test_an_unfinished_journal_has_no_effect(spark, tmp_path):
    staged = Staged(spark, str(tmp_path), "run")
    staged.write(spark.range(3), "t")
    staged.replace("t")
    write_file(spark, f"{journal_folder(str(tmp_path))}/.run.json.draft", "{")
    assert recover(spark, str(tmp_path)) == 0 and not Path(tmp_path, "t").exists()
    staged.publish()
    assert spark.read.parquet(f"{tmp_path}/t").count() == 3 and files(spark, journal_folder(str(tmp_path))) == []
    staged.discard()
    assert not Path(staged.folder).exists()


def test_a_journal_can_be_replayed_twice(spark, tmp_path):
    staged = Staged(spark, str(tmp_path), "run")
    staged.write(spark.range(4).selectExpr("id", "id % 2 as part"), "t", "part")
    staged.replace("t", "part", ["0", "1", "2"])
    spark.range(1).selectExpr("id", "2 as part").write.partitionBy("part").parquet(staged.target("t"))
    journal = f"{tmp_path}/kept.json"
    Path(journal).write_text(json.dumps({"folder": staged.folder, "moves": staged.moves}))
    shutil.copy(journal, f"{tmp_path}/again.json")
    assert replay(spark, journal) == 2 and replay(spark, f"{tmp_path}/again.json") == 0
    assert sorted(r.part for r in spark.read.parquet(staged.target("t")).collect()) == [0, 0, 1, 1]


def test_a_forced_month_that_fails_its_gate_leaves_what_landed(spark, store, tmp_path):
    lake, again, _ = store
    shutil.copytree(lake.root, f"{tmp_path}/store")
    copy = Store(f"{tmp_path}/store")
    rows = gate(spark, copy, "2026-01")
    bad = f"{tmp_path}/bad"
    spark.read.parquet(again).drop("id").write.parquet(bad)
    with pytest.raises(GateFailed):
        run_months(spark, copy, {"2026-01": bad}, force=True)
    assert gate(spark, copy, "2026-01") == rows == (True, 6)


def test_files_of_one_month_must_have_one_schema(spark, store, tmp_path):
    _, again, _ = store
    mixed = f"{tmp_path}/mixed"
    shutil.copytree(again, mixed)
    rows = spark.read.parquet(again)
    changed = rows.withColumn("delay_in_min", rows["delay_in_min"].cast("bigint")).select(*rows.columns[::-1])
    changed.write.mode("append").parquet(mixed)
    with pytest.raises(GateFailed, match="2 schemas"):
        run_months(spark, Store(f"{tmp_path}/new"), {"2026-01": mixed})
    assert not Path(f"{tmp_path}/new").exists() or not list(Path(f"{tmp_path}/new").rglob("part-*"))
    drift = catalog.schema_drift(spark, catalog.file_schemas(spark, catalog.data_files(spark, mixed)))
    assert {(r.column_name, r.expected, r.found) for r in drift.where("drift = 'type'").collect()} == {("delay_in_min", "int", "bigint")}
    assert drift.select("file").distinct().count() == len(list(Path(mixed).glob("part-*"))) - len(list(Path(again).glob("part-*")))
    assert catalog.schema_drift(spark, catalog.file_schemas(spark, catalog.data_files(spark, again))).collect() == []
