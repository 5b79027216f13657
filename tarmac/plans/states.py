"""The reports from stored states, so that new flights are added without reading the old ones.

A state is a row of one group with all that the report's measures need: counts, sums, extremes and bit sets. States of
two batches of flights merge into the state of both, in any order. A state table is a folder with one folder for each
batch; writing a batch again replaces it, so a repeated job does no harm.

States are made by the keys as they stand in the input; only the few keys of the states are then normalised, and
states whose keys became the same are merged.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.functions.months import month_names, month_set
from tarmac.model import BAND_NAMES, CAUSE_LABELS, HIGH_ABOVE, LOW_BELOW
from tarmac.operators import measures
from tarmac.operators.cleaning import clean, normalize_strings
from tarmac.plans.airport import airport_report, band_columns
from tarmac.plans.carrier import STATISTICS, carrier_report
from tarmac.operators.ranking import ranked_causes
from tarmac.sources.writing import write_table

BATCH = "batch"


class Kind(NamedTuple):
    """What a state has for each group: how it is made from flights, and how two are merged."""

    keys: tuple[str, ...]
    text_keys: tuple[str, ...]
    made: Callable[[], dict[str, Column]]
    merged: dict[str, Callable[[str], Column]]


def _carrier_measures() -> dict[str, Column]:
    return {
        "num_flights": F.count("*"),
        "cancelled_sum": F.sum("cancelled").cast("long"),
        "arr_delay_sum": F.sum("arr_delay"),
        "arr_delay_rows": F.count("arr_delay"),
        "arr_delay_least": F.min("arr_delay"),
        "arr_delay_most": F.max("arr_delay"),
        "month_bits": month_set(F.col("month")),
    }


CARRIER = Kind(
    ("op_unique_carrier", "origin"),
    ("op_unique_carrier", "origin"),
    _carrier_measures,
    {
        "num_flights": F.sum, "cancelled_sum": F.sum, "arr_delay_sum": F.sum, "arr_delay_rows": F.sum,
        "arr_delay_least": F.min, "arr_delay_most": F.max, "month_bits": F.bit_or,
    },
)

_BAND_STATES = [
    *(f"{name}_count" for name in BAND_NAMES),
    *(f"{name}_{side}_sum" for name in BAND_NAMES for side in ("dep", "arr")),
]


def airport_kind(
    low_below: float = LOW_BELOW, high_above: float = HIGH_ABOVE, gate_cancelled: bool = True
) -> Kind:
    """Bands and causes; the limits are part of the state, as flights can't be put into other bands later."""

    def made() -> dict[str, Column]:
        columns = (
            *measures.band_counts(low_below, high_above),
            *measures.band_sums(low_below, high_above),
            *measures.cause_counts(gate_cancelled),
        )
        return dict(zip([*_BAND_STATES, *CAUSE_LABELS], columns))

    return Kind(("origin", "month"), ("origin",), made, dict.fromkeys([*_BAND_STATES, *CAUSE_LABELS], F.sum))


AIRPORT = airport_kind()


def states(flights: DataFrame, kind: Kind) -> DataFrame:
    """The states of flights: one exchange of partially aggregated rows."""
    return flights.groupBy(*kind.keys).agg(*(column.alias(name) for name, column in kind.made().items()))


def merged(found: DataFrame, kind: Kind) -> DataFrame:
    """One state for each group."""
    return found.groupBy(*kind.keys).agg(*(merge(name).alias(name) for name, merge in kind.merged.items()))


def states_of_raw(raw: DataFrame, kind: Kind) -> DataFrame:
    """The states of raw flights, cleaned; keys are normalised once for each group instead of each flight."""
    found = states(clean(raw, normalize=False), kind)
    return merged(normalize_strings(found, kind.text_keys), kind)


def add_batch(found: DataFrame, path: str, batch: str) -> None:
    """Store the states of a batch, in place of an earlier batch of that name."""
    if not batch or "/" in batch or "=" in batch:
        raise ValueError(f"{batch!r} is no name for a folder")
    write_table(found, f"{path}/{BATCH}={batch}")


def stored(spark: SparkSession, path: str, kind: Kind) -> DataFrame:
    """The states of all batches together; a read of a few rows for each group and batch."""
    return merged(spark.read.option("basePath", path).parquet(path).drop(BATCH), kind)


def carrier_airport_stats(found: DataFrame) -> DataFrame:
    """The statistics of ``plans.carrier`` from states."""
    return found.select(
        *CARRIER.keys,
        "num_flights",
        F.round("arr_delay_least", 2).alias("arr_delay_min"),
        F.round("arr_delay_most", 2).alias("arr_delay_max"),
        F.round(F.col("arr_delay_sum") / F.nullif(F.col("arr_delay_rows"), F.lit(0)), 2).alias("arr_delay_avg"),
        F.round(F.col("cancelled_sum") / F.col("num_flights"), 4).alias("cancellation_rate"),
        month_names(F.col("month_bits")).alias("months"),
    )


def airport_month_bands(found: DataFrame) -> DataFrame:
    """The bands of ``plans.airport`` from states."""
    return found.select("origin", "month", *band_columns())


def nested_carrier_report(found: DataFrame) -> DataFrame:
    return carrier_report(carrier_airport_stats(found).select(*CARRIER.keys, *STATISTICS))


def nested_airport_report(found: DataFrame, k: int = 3) -> DataFrame:
    return airport_report(found.select("origin", "month", *band_columns(), ranked_causes(k=k).alias("top_3_causes")))
