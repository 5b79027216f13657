"""Most frequent values, overall and per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.functions.delays import possible_causes
from tarmac.model import CAUSE_LABELS


def top_values(df: DataFrame, key: str, k: int = 10) -> DataFrame:
    """The k most frequent values of ``key``; the value itself breaks ties."""
    counts = df.groupBy(key).agg(F.count("*").alias("flights"))
    return counts.orderBy(F.desc("flights"), F.asc(key)).limit(k)


def ranked_causes(labels=CAUSE_LABELS, k: int = 3) -> Column:
    """The k largest of the count columns named in ``labels``, as (cause, count) structs.

    The columns are already in the row, so ranking them needs no shuffle. Zero counts are
    left out and the position in ``labels`` breaks ties.
    """
    entries = F.array(
        *(
            F.struct((-F.col(label)).alias("minus"), F.lit(i).alias("place"), F.lit(label).alias("cause"))
            for i, label in enumerate(labels)
        )
    )
    best = F.slice(F.array_sort(F.filter(entries, lambda e: e["minus"] < 0)), 1, k)
    return F.transform(best, lambda e: F.struct(e["cause"].alias("cause"), (-e["minus"]).alias("count")))


def explode_causes(flights: DataFrame, *keep: str) -> DataFrame:
    """One row per flight and cause."""
    places = flights.select(*keep, F.explode(possible_causes()).alias("cause"))
    return places.filter(F.col("cause").isNotNull())


def top_causes_by_window(flights: DataFrame, keys=("origin", "month"), k: int = 3) -> DataFrame:
    """The same ranking for any number of labels: count per label, then a window per group.

    The window sorts at most one row per label and group. Reasons outside the known ones, which
    only uncleaned tables hold, have a label here like any other and come last among equal
    counts; ``ranked_causes`` knows the labels in advance and leaves such reasons out.
    """
    counts = explode_causes(flights, *keys).groupBy(*keys, "cause").agg(F.count("*").alias("count"))
    place = F.array_position(F.array(*(F.lit(label) for label in CAUSE_LABELS)), F.col("cause"))
    order = Window.partitionBy(*keys).orderBy(F.desc("count"), place == 0, place, F.col("cause"))
    return (
        counts.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select(*keys, "rank", "cause", "count")
    )
