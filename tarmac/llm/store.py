"""Small things the operators share: stored intermediate tables and safe column names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.sources.scratch import scratch_path

BROADCAST_ROWS = 2_000_000  # of a few numbers each


def saved(df: DataFrame, name: str) -> DataFrame:
    """The table as written to the cluster's shared folder, so that what follows does not
    compute it again and survives the loss of any executor."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def broadcast_if_few(stored: DataFrame) -> DataFrame:
    """A stored table, to be broadcast if it has so few rows of numbers that each machine can hold them."""
    return F.broadcast(stored) if stored.count() <= BROADCAST_ROWS else stored


def documents(spark, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def id_and_text(docs: DataFrame) -> DataFrame:
    """Only ``doc_id`` and ``text`` (null: empty), whatever other columns there are."""
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))


def free_names(df: DataFrame, *names: str) -> dict[str, str]:
    """For each name one that no column of the table has, whatever its case."""
    taken, out = {c.lower() for c in df.columns}, {}
    for name in names:
        free = f"__{name}"
        while free.lower() in taken:
            free = "_" + free
        out[name] = free
        taken.add(free.lower())
    return out
