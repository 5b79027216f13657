"""Flat groups to nested documents and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def nest(df: DataFrame, key: Column, item: Column, into: str) -> DataFrame:
    """One row per ``key`` with its items as an array, sorted by their first field.

    Meant for aggregated rows: the array holds one item per inner group (airports of a
    carrier, months of an airport), not one per flight. Keys are dealt by range, so that putting the
    documents in order of their key needs no further exchange.
    """
    rows = df.select(key, item.alias("_item"))
    name = rows.columns[0]
    return rows.repartitionByRange(name).groupBy(name).agg(F.array_sort(F.collect_list("_item")).alias(into))


def unnest(df: DataFrame, items: str, item: str) -> DataFrame:
    """One row per item, the items as the struct column ``item``."""
    rest = [name for name in df.columns if name != items]
    return df.select(*rest, F.explode(items).alias(item))
