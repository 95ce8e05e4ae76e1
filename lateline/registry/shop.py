"""The stored tables the registered queries share, built once per application and data folder."""

from __future__ import annotations

import hashlib
import threading
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from lateline.operators import marts as models
from lateline.operators.marts import Marts
from lateline.operators.observations import dedup_latest, enrich
from lateline.operators.staging import stage_observations, union_sources
from lateline.registry import adapter
from lateline.sources.bronze import land_months, read_landed, scan_nanos_parquet
from lateline.sources.raw import derive_source_month
from lateline.workspace import Workspace, configure


class Shop:
    """Bronze, the enriched table and the marts are stored; staging, union and deduplication stay lazy."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = configure(spark), sf_dir
        self.space = Workspace(spark, hashlib.sha256(sf_dir.encode()).hexdigest()[:16])

    @property
    def bronze_root(self) -> str:
        return self.space.once(
            "bronze",
            lambda root: land_months(
                adapter.order_line_observations(self.spark, self.sf_dir), adapter.planned_month(), root
            ),
        )

    @cached_property
    def landed(self) -> DataFrame:
        return scan_nanos_parquet(self.spark, self.bronze_root)

    @cached_property
    def filed(self) -> DataFrame:
        """Landed rows with the month their file stands for."""
        return read_landed(self.spark, self.bronze_root)

    @property
    def raw(self) -> DataFrame:
        """Landed rows with the month of their own time."""
        return derive_source_month(self.landed)

    @property
    def unioned(self) -> DataFrame:
        return union_sources(monthly=stage_observations(self.raw))

    @property
    def event_raw(self) -> DataFrame:
        return derive_source_month(adapter.event_observations(self.spark, self.sf_dir))

    @property
    def enriched(self) -> DataFrame:
        return self.space.table(
            "enriched", lambda: enrich(dedup_latest(self.unioned), cutover=adapter.CUTOVER)
        )

    @property
    def marts(self) -> Marts:
        space = self.space
        station_perf = space.table("station_perf", lambda: models.mart_monthly_station_perf(self.enriched))
        return Marts(
            station_perf,
            space.table("line_perf", lambda: models.mart_monthly_line_perf(self.enriched)),
            space.table("dim_station", lambda: models.dim_station(self.enriched)),
            space.table("dim_train_line", lambda: models.dim_train_line(self.enriched)),
            space.table("dim_service_month", lambda: models.dim_service_month(station_perf)),
        )


_shops: dict[tuple[str, str], Shop] = {}
_lock = threading.Lock()


def shop(spark: SparkSession, sf_dir: str) -> Shop:
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    configure(spark)
    with _lock:
        if key not in _shops:
            _shops[key] = Shop(spark, key[1])
        return _shops[key]
