"""Delay bands and delay or cancellation causes of a single flight."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tarmac.model import (
    BAND_NAMES,
    CANCELLATION_PREFIX,
    CANCELLATION_REASONS,
    DELAY_CAUSES,
    HIGH_ABOVE,
    LOW_BELOW,
    NO_REASON,
)


def operated() -> Column:
    return F.col("cancelled") == 0


def was_cancelled() -> Column:
    return F.col("cancelled") == 1


def band_tests(low_below: float = LOW_BELOW, high_above: float = HIGH_ABOVE) -> dict[str, Column]:
    """For each band, whether an operated flight's departure delay lies in it.

    The bands exclude each other, so the limits must not cross.
    """
    if low_below > high_above:
        raise ValueError(f"a delay below {low_below} and above {high_above} would be in two bands")
    delay = F.col("dep_delay")
    limits = (delay < low_below, delay.between(low_below, high_above), delay > high_above)
    flew = operated()
    return {name: flew & limit for name, limit in zip(BAND_NAMES, limits)}


def delay_band(low_below: float = LOW_BELOW, high_above: float = HIGH_ABOVE) -> Column:
    """Band label; NULL if the flight did not operate or has no departure delay."""
    return F.coalesce(
        *(F.when(test, F.lit(name)) for name, test in band_tests(low_below, high_above).items())
    )


def reason_label(reason: Column) -> Column:
    """Cause label of a cancellation reason."""
    return F.concat(F.lit(CANCELLATION_PREFIX), reason)


def cause_tests(gate_cancelled: bool = True) -> dict[str, Column]:
    """For each cause label, in tie-break order, whether it applies to the flight.

    ``gate_cancelled=False`` also counts the reason of flights that operated although
    they carry a cancellation code.
    """
    flew, stayed = operated(), was_cancelled()
    tests = {label: flew & (F.col(column) > 0) for column, label in DELAY_CAUSES.items()}
    for reason in CANCELLATION_REASONS.values():
        test = F.col("cancellation_reason") == reason
        tests[CANCELLATION_PREFIX + reason] = stayed & test if gate_cancelled else test
    return tests


def possible_causes() -> Column:
    """An array with one place per kind of cause: its label if it applies to the flight, or
    NULL. Taking the gaps out here would leave generated code; filter after exploding."""
    reason, flew = F.col("cancellation_reason"), operated()
    cancelled_for = F.when(was_cancelled() & (reason != NO_REASON), reason_label(reason))
    delayed_by = (
        F.when(flew & (F.col(column) > 0), F.lit(label)) for column, label in DELAY_CAUSES.items()
    )
    return F.array(cancelled_for, *delayed_by)
