"""Aggregate measures. All have fixed-size buffers and combine on the map side, so a
shuffle carries at most one row per task and group however skewed the groups are."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tarmac.functions.delays import band_tests, cause_tests
from tarmac.functions.months import month_set
from tarmac.model import HIGH_ABOVE, LOW_BELOW


def flight_count() -> Column:
    return F.count("*").alias("num_flights")


def arr_delay_min() -> Column:
    return F.round(F.min("arr_delay"), 2).alias("arr_delay_min")


def arr_delay_max() -> Column:
    return F.round(F.max("arr_delay"), 2).alias("arr_delay_max")


def arr_delay_avg() -> Column:
    return F.round(F.avg("arr_delay"), 2).alias("arr_delay_avg")


def cancellation_rate() -> Column:
    return F.round(F.sum("cancelled") / F.count("*"), 4).alias("cancellation_rate")


def active_months() -> Column:
    """Distinct months as a bit set; ``months.month_names`` unpacks it."""
    return month_set(F.col("month")).alias("months")


def band_counts(low_below: float = LOW_BELOW, high_above: float = HIGH_ABOVE) -> list[Column]:
    return [
        F.count_if(test).alias(f"{name}_count")
        for name, test in band_tests(low_below, high_above).items()
    ]


def band_sums(low_below: float = LOW_BELOW, high_above: float = HIGH_ABOVE) -> list[Column]:
    """Total departure and arrival delay per band; a missing arrival delay adds nothing."""
    return [
        F.coalesce(F.sum(F.when(test, F.col(f"{side}_delay"))), F.lit(0.0)).alias(f"{name}_{side}_sum")
        for name, test in band_tests(low_below, high_above).items()
        for side in ("dep", "arr")
    ]


def band_mean(name: str, side: str) -> Column:
    """Mean delay of a band from its total and its row count, NULL for an empty band.

    The rows without an arrival delay count as well, so this is not ``avg``.
    """
    rows = F.nullif(F.col(f"{name}_count"), F.lit(0))
    return F.round(F.col(f"{name}_{side}_sum") / rows, 2).alias(f"{name}_avg_{side}_delay")


def cause_counts(gate_cancelled: bool = True) -> list[Column]:
    """Flights per cause, one column per label."""
    return [F.count_if(test).alias(label) for label, test in cause_tests(gate_cancelled).items()]
