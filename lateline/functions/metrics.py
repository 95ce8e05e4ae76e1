"""Dashboard measures over mart rows, as aggregate expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lateline.functions.observation import pct


def _sum(value: Column, only: Column | None) -> Column:
    return F.sum(value if only is None else F.when(only, value))


def non_canceled(only: Column | None = None) -> Column:
    return _sum(F.col("non_canceled_observation_count"), only)


def activity(only: Column | None = None) -> Column:
    return _sum(F.col("observation_count"), only)


def weighted_delay(only: Column | None = None) -> Column:
    """Average delay weighted by non-canceled stops.

    The numerator is a sum of whole minutes that went through a division; rounding it to six places takes the
    floating noise out again, so a value half-way between two tenths does not depend on the order of the sum.
    """
    minutes = F.round(_sum(F.col("avg_delay_min") * F.col("non_canceled_observation_count"), only), 6)
    return F.round(minutes / F.nullif(non_canceled(only), F.lit(0)), 1)


def on_time_pct(only: Column | None = None) -> Column:
    return pct(_sum(F.col("on_time_count"), only), non_canceled(only), 1)


def cancellation_pct(only: Column | None = None) -> Column:
    return pct(_sum(F.col("cancellation_count"), only), activity(only), 1)
