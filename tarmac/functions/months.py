"""Month names and sets of months."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tarmac.model import MONTH_NAMES


def month_name(month: Column) -> Column:
    """English name of month 1..12, NULL for any other number."""
    names = F.array(*(F.lit(name) for name in MONTH_NAMES))
    return F.when(month.between(1, 12), F.try_element_at(names, month))


def month_set(month: Column) -> Column:
    """Aggregate: the distinct months of a group as a 12-bit integer.

    A bit set is a fixed-size buffer that stays in the generated hash aggregate;
    ``collect_set`` would need the object aggregate, which starts sorting its input
    once a task has seen 128 groups.
    """
    bit = F.call_function("shiftleft", F.lit(1), month - 1)
    return F.coalesce(F.bit_or(F.when(month.between(1, 12), bit)), F.lit(0))


def month_numbers(months: Column) -> Column:
    """The months in a set as an ascending array of numbers."""
    return F.array_compact(F.array(*(_member(months, m, F.lit(m)) for m in range(1, 13))))


def month_names(months: Column) -> Column:
    """The months in a set as an array of names in calendar order."""
    return F.array_compact(
        F.array(*(_member(months, m, F.lit(name)) for m, name in enumerate(MONTH_NAMES, 1)))
    )


def _member(months: Column, month: int, value: Column) -> Column:
    return F.when(months.bitwiseAND(F.lit(1 << (month - 1))) != 0, value)
