"""Statistics per carrier and airport of departure."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.functions.months import month_names
from tarmac.operators import measures
from tarmac.operators.nesting import nest, unnest

STATISTICS = (
    "num_flights", "arr_delay_min", "arr_delay_max", "arr_delay_avg", "cancellation_rate", "months",
)


def carrier_airport_stats(flights: DataFrame) -> DataFrame:
    """Flight count, arrival delays, cancellation rate and active months: one exchange."""
    return (
        flights.groupBy("op_unique_carrier", "origin")
        .agg(
            measures.flight_count(),
            measures.arr_delay_min(),
            measures.arr_delay_max(),
            measures.arr_delay_avg(),
            measures.cancellation_rate(),
            measures.active_months(),
        )
        .withColumn("months", month_names(F.col("months")))
    )


def nested_carrier_report(flights: DataFrame) -> DataFrame:
    """The statistics as one document per carrier, airports in order.

    The second exchange moves aggregated rows only, one per carrier and airport.
    """
    return carrier_report(carrier_airport_stats(flights))


def carrier_report(stats: DataFrame) -> DataFrame:
    """One document per carrier from rows per carrier and airport."""
    airport = F.struct(F.col("origin").alias("airport"), F.struct(*STATISTICS).alias("data"))
    return nest(stats, F.col("op_unique_carrier").alias("carrier"), airport, "airports")


def flatten_carrier_report(report: DataFrame) -> DataFrame:
    """Back from the documents to one row per carrier and airport."""
    return unnest(report, "airports", "a").select(
        F.col("carrier").alias("op_unique_carrier"), F.col("a.airport").alias("origin"), "a.data.*"
    )
