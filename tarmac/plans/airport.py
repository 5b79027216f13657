"""Delay bands and causes per airport of departure and month."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.functions.months import month_name
from tarmac.model import BAND_NAMES, HIGH_ABOVE, LOW_BELOW
from tarmac.operators import measures
from tarmac.operators.nesting import nest, unnest
from tarmac.operators.ranking import ranked_causes

KEYS = ("origin", "month")


def band_columns() -> list:
    return [
        column
        for name in BAND_NAMES
        for column in (
            F.col(f"{name}_count"), measures.band_mean(name, "dep"), measures.band_mean(name, "arr"),
        )
    ]


def airport_month_bands(
    flights: DataFrame, low_below: float = LOW_BELOW, high_above: float = HIGH_ABOVE
) -> DataFrame:
    """Flights and mean delays per band: one exchange."""
    return (
        flights.groupBy(*KEYS)
        .agg(*measures.band_counts(low_below, high_above), *measures.band_sums(low_below, high_above))
        .select(*KEYS, *band_columns())
    )


def top_causes(flights: DataFrame, k: int = 3, gate_cancelled: bool = True) -> DataFrame:
    """The most frequent causes as rows (rank, cause, count): one exchange."""
    best = (
        flights.groupBy(*KEYS)
        .agg(*measures.cause_counts(gate_cancelled))
        .select(*KEYS, F.posexplode(ranked_causes(k=k)).alias("pos", "top"))
    )
    return best.select(*KEYS, (F.col("pos") + 1).alias("rank"), "top.cause", "top.count")


def nested_airport_report(
    flights: DataFrame,
    low_below: float = LOW_BELOW,
    high_above: float = HIGH_ABOVE,
    k: int = 3,
    gate_cancelled: bool = True,
) -> DataFrame:
    """Bands and causes from a single aggregation, as one document per airport.

    Months are in calendar order. The second exchange moves aggregated rows only, at most
    twelve per airport.
    """
    monthly = flights.groupBy(*KEYS).agg(
        *measures.band_counts(low_below, high_above),
        *measures.band_sums(low_below, high_above),
        *measures.cause_counts(gate_cancelled),
    )
    return airport_report(monthly.select(*KEYS, *band_columns(), ranked_causes(k=k).alias("top_3_causes")))


def airport_report(monthly: DataFrame) -> DataFrame:
    """One document per airport from rows per airport and month."""
    bands = F.struct(
        *(
            F.struct(
                F.col(f"{name}_count").alias("count"),
                F.col(f"{name}_avg_dep_delay").alias("avg_dep_delay"),
                F.col(f"{name}_avg_arr_delay").alias("avg_arr_delay"),
            ).alias(name)
            for name in BAND_NAMES
        )
    )
    numbered = F.struct("month", bands.alias("bands"), "top_3_causes")
    report = nest(monthly, F.col("origin").alias("airport"), numbered, "months")
    named = F.transform(
        "months",
        lambda m: F.struct(
            month_name(m["month"]).alias("month"), m["bands"].alias("bands"), m["top_3_causes"].alias("top_3_causes")
        ),
    )
    return report.withColumn("months", named)


def flatten_airport_bands(report: DataFrame) -> DataFrame:
    """The bands of the documents as one row per airport and month name."""
    columns = [
        F.col(f"m.bands.{name}.{field}").alias(f"{name}_{field}")
        for name in BAND_NAMES
        for field in ("count", "avg_dep_delay", "avg_arr_delay")
    ]
    return unnest(report, "months", "m").select(
        F.col("airport").alias("origin"), F.col("m.month").alias("month"), *columns
    )


def flatten_airport_causes(report: DataFrame) -> DataFrame:
    """The causes of the documents as one row per airport, month name and rank."""
    causes = unnest(report, "months", "m").select(
        F.col("airport").alias("origin"),
        F.col("m.month").alias("month"),
        F.posexplode("m.top_3_causes").alias("pos", "top"),
    )
    return causes.select("origin", "month", (F.col("pos") + 1).alias("rank"), "top.cause", "top.count")
