"""Every registered query against its SQL, and what the stored tables promise."""

import pytest

import __spark_entry__ as entry
from lateline.plans.reports import REPORTS
from lateline.registry.shop import shop
from lateline.workspace import Workspace, path_exists, shared_root, sized_shuffles, stored_bytes
from oracle_check import compare, connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", entry.queries())
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, SF_DIR)
    sql = entry.oracle_sql().get(name)
    if sql:
        assert compare(df, duck, sql) is None
    else:
        assert df.count() > 0


def test_flagship_query(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) == 10
    delays = [r.average_delay_min for r in rows]
    assert delays == sorted(delays, reverse=True)


def test_all_reports_are_registered():
    assert len(REPORTS) == 31
    assert set(REPORTS) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_stored_tables_live_in_the_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir", None)
    stored = shop(spark, SF_DIR)
    assert stored is shop(spark, SF_DIR + "/")
    assert stored.space.root.startswith(root.rstrip("/") if root else shared_root(spark))
    built = []
    space = Workspace(spark, "twice")
    for _ in range(2):
        table = space.table("t", lambda: built.append(1) or spark.range(3))
    assert (table.count(), len(built)) == (3, 1)
    assert path_exists(spark, space.path("t")) and not path_exists(spark, space.path("u"))


def test_shuffles_grow_with_the_input(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "b").write_bytes(b"x" * 1000)
    assert stored_bytes(spark, str(tmp_path), str(tmp_path / "absent")) == 1000
    before = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for size, partitions in ((1000, before), (10 * (256 << 20) + 1, 11), (10**14, 372_530)):
        with sized_shuffles(spark, size) as held:
            assert held == int(spark.conf.get("spark.sql.shuffle.partitions")) == partitions
        assert int(spark.conf.get("spark.sql.shuffle.partitions")) == before
    with pytest.raises(KeyError), sized_shuffles(spark, 10**14):
        raise KeyError
    assert int(spark.conf.get("spark.sql.shuffle.partitions")) == before
