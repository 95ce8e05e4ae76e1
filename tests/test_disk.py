"""What stored tables and their building leave on disk and send through shuffles."""

import time
from pathlib import Path

from lateline.registry import adapter
from lateline.registry.shop import Shop
from lateline.registry.tables import _late_days
from lateline.workspace import REMOVE_SHUFFLES, Workspace

SF_DIR = "/root/testdata/sf0.001"


def shuffle_files(spark):
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for d in dirs for f in Path(d).rglob("shuffle_*")}


def test_stored_tables_leave_no_shuffle_files(spark):
    before, setting = shuffle_files(spark), spark.conf.get(REMOVE_SHUFFLES, None)
    space = Workspace(spark, "shuffled")
    counted = space.table("counted", lambda: spark.range(1000).repartition(5).groupBy("id").count())
    space.once("written", lambda path: spark.range(100).repartition(3).write.parquet(path))
    until = time.time() + 20
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before and counted.count() == 1000
    assert spark.conf.get(REMOVE_SHUFFLES, None) == setting


def test_joins_of_order_lines_shuffle_narrow_rows(spark):
    plan = adapter.order_line_observations(spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    joins = [line for line in plan if "Join Inner" in line]
    assert ["r_regionkey" in joins[0], "n_nationkey" in joins[1], "p_partkey" in joins[2], "s_suppkey" in joins[3]] == [True] * 4
    below = plan[plan.index(joins[3]) + 1 :]
    sent = next(line for line in below if "Project" in line)  # of an order line, to its first join
    assert "AS is_canceled" in sent and "AS delay_in_min" in sent


def test_late_days_write_only_their_months(spark):
    shop = Shop(spark, "/root/testdata/sf0.01")
    shop.space = Workspace(spark, "late-days")
    _late_days(shop)
    folders = Path(shop.space.path("daily").removeprefix("file:")).glob("*observations_enriched*/source_month=*")
    runs = {f.name.removeprefix("source_month="): {p.name.split("-", 2)[2][:36] for p in f.glob("part-*")} for f in folders}
    assert all(len(r) == 1 for r in runs.values()) and len(set.union(*runs.values())) == 2
    first = runs["1995-01"]
    assert {m for m, r in runs.items() if r != first} <= {"1997-02", "1997-03"}
