"""The data quality report."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.operators import cleaning
from tarmac.operators.ranking import top_values


def funnel_counts() -> dict[str, Column]:
    """Rows left after each cleaning step, as aggregates over the raw rows."""
    tests = {
        "mandatory_not_null": cleaning.is_complete(),
        "not_diverted": cleaning.is_not_diverted(),
        "delays_present": cleaning.has_delays_if_operated(),
        "valid_month": cleaning.has_valid_month(),
        "keys_not_blank": cleaning.has_keys(),
    }
    passed = list(tests.values())
    counts = {"raw": F.count("*")}
    for i, step in enumerate(tests, 1):
        counts[step] = F.count_if(reduce(and_, passed[:i]))
    return counts


def cleaning_funnel(raw: DataFrame) -> DataFrame:
    """One row per step with the rows left after it; a single pass over the raw data."""
    counts = funnel_counts()
    steps = F.array(
        *(
            F.struct(F.lit(i).alias("step_no"), F.lit(step).alias("step"), F.col(step).alias("rows"))
            for i, step in enumerate(counts)
        )
    )
    one_row = raw.agg(*(count.alias(step) for step, count in counts.items()))
    return one_row.select(F.inline(steps))


def quality_summary(raw: DataFrame) -> DataFrame:
    """Rows read, kept and removed, and the percentage removed (NULL without any rows)."""
    counts = funnel_counts()
    last = list(counts)[-1]
    both = raw.agg(counts["raw"].alias("raw_rows"), counts[last].alias("kept_rows"))
    return both.withColumns(summary_columns())


def summary_columns() -> dict[str, Column]:
    removed = F.col("raw_rows") - F.col("kept_rows")
    return {
        "removed_rows": removed,
        "removed_pct": F.round(removed / F.nullif(F.col("raw_rows"), F.lit(0)) * 100, 1),
    }


def rows_by(flights: DataFrame, key: str) -> DataFrame:
    """Rows per value of ``key``, in order of the values."""
    return flights.groupBy(key).agg(F.count("*").alias("flights")).orderBy(key)


def top_carriers(flights: DataFrame, k: int = 10) -> DataFrame:
    return top_values(flights, "op_unique_carrier", k)


def top_origins(flights: DataFrame, k: int = 10) -> DataFrame:
    return top_values(flights, "origin", k)
