"""Two sets of stops held against each other: what only one of them has, and where they say different things."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lateline import contract

#: What both sides say of a stop. Ids are not among it: each side gives its own.
COMPARED = [
    "station_name",
    "xml_station_name",
    "eva",
    "final_destination_station",
    "train_number",
    "line_number",
    "train_type",
    "delay_in_min",
    "is_canceled",
    *contract.TIME_COLUMNS,
]


@dataclass(frozen=True)
class Tolerance:
    """Shares of the official stops up to which a month passes."""

    missing: float = 0.001
    surplus: float = 0.001
    differing: float = 0.01


def match_stops(
    here: DataFrame, there: DataFrame, columns: Sequence[str] = tuple(COMPARED), key: Sequence[str] = tuple(contract.STOP_KEY)
) -> DataFrame:
    """The key, ``here`` and ``there`` as structs of the compared columns (NULL where a side lacks the stop).

    Both sides have a key at most once. A key with a NULL in it matches nothing and stays on its own side. A side that
    was just deduplicated is dealt out by its key already, so that the join needs no shuffle of its own.
    """
    own, official = (
        side.select(*key, F.struct(*columns).alias(name)) for side, name in ((here, "here"), (there, "there"))
    )
    return own.join(official, list(key), "full_outer")


def differs(column: str) -> Column:
    """Whether both sides have the stop and say different things; NULL equals NULL and nothing else."""
    both = F.col("here").isNotNull() & F.col("there").isNotNull()
    return both & ~F.col("here")[column].eqNullSafe(F.col("there")[column])


def reconcile(
    here: DataFrame, there: DataFrame, columns: Sequence[str] = tuple(COMPARED), key: Sequence[str] = tuple(contract.STOP_KEY)
) -> DataFrame:
    """By month: stops on both sides, on one only, with any difference, and with one in each column."""
    both = F.col("here").isNotNull() & F.col("there").isNotNull()
    any_difference = F.lit(False)
    for column in columns:
        any_difference = any_difference | differs(column)
    return (
        match_stops(here, there, columns, key)
        .groupBy("source_month")
        .agg(
            F.count_if(both).alias("matched"),
            F.count_if(F.col("there").isNull()).alias("only_here"),
            F.count_if(F.col("here").isNull()).alias("only_there"),
            F.count_if(any_difference).alias("differing"),
            *[F.count_if(differs(c)).alias(f"differing_{c}") for c in columns],
        )
    )


def verdicts(report: DataFrame, tolerance: Tolerance = Tolerance()) -> DataFrame:
    """Shares of the official stops, and whether a month passes. A month without official stops doesn't."""
    official = F.nullif(F.col("matched") + F.col("only_there"), F.lit(0))
    shares = {"missing_share": "only_there", "surplus_share": "only_here", "differing_share": "differing"}
    passed = (
        (F.col("missing_share") <= tolerance.missing)
        & (F.col("surplus_share") <= tolerance.surplus)
        & (F.col("differing_share") <= tolerance.differing)
    )
    rated = report.select("*", *[(F.col(n) / official).alias(name) for name, n in shares.items()])
    return rated.withColumn("passed", F.coalesce(passed, F.lit(False)))


def differences(
    here: DataFrame, there: DataFrame, columns: Sequence[str] = tuple(COMPARED), key: Sequence[str] = tuple(contract.STOP_KEY)
) -> DataFrame:
    """One row for each stop and column that differ, with both values as text; a stop that a side lacks has one row."""
    listed = [
        F.when(
            differs(c),
            F.struct(
                F.lit(c).alias("column"), F.col("here")[c].cast("string").alias("here"), F.col("there")[c].cast("string").alias("there")
            ),
        )
        for c in columns
    ]
    alone = F.struct(
        F.when(F.col("there").isNull(), "only_here").otherwise("only_there").alias("column"),
        F.lit(None).cast("string").alias("here"),
        F.lit(None).cast("string").alias("there"),
    )
    found = F.when(F.col("here").isNull() | F.col("there").isNull(), F.array(alone)).otherwise(F.array_compact(F.array(*listed)))
    return match_stops(here, there, columns, key).select(*key, F.inline(found))
