"""Where queries register themselves."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from lateline.registry.shop import Shop, shop
from lateline.registry.sql import over


@dataclass(frozen=True)
class Query:
    build: Callable[[Shop], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return self.build(shop(spark, sf_dir))


QUERIES: dict[str, Query] = {}


def register(name: str, build: Callable[[Shop], DataFrame], select: str | None = None) -> None:
    if name in QUERIES:
        raise ValueError(f"query registered twice: {name}")
    QUERIES[name] = Query(build, over(select) if select else None)


def queries_with_sql() -> dict[str, str]:
    return {name: query.sql for name, query in QUERIES.items() if query.sql}
