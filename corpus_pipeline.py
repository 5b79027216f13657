"""From raw documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, directory of the tables) and returns a DataFrame; it is written as Parquet
and read again as the next stage's documents. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm import bagminhash, packing, private_data, toxicity, weak_labels
from tarmac.llm.ship import ship
from tarmac.llm.store import documents, free_names, saved


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity score doesn't reject; null and empty texts stay."""
    ship(spark)
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return _below(docs, toxicity.toxic_score(spark, model), toxicity.CUT_OFF)


def _below(docs: DataFrame, score, limit: float) -> DataFrame:
    """The rows whose text scores below the limit; columns of any name stay as they are."""
    name = free_names(docs, "score")["score"]
    return docs.withColumn(name, score("text")).where(F.col(name) < limit).drop(name)


def without_bad(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't call bad."""
    ship(spark)
    _, scorer = weak_labels.fit(docs)
    return _below(docs, weak_labels.bad_score(spark, scorer), weak_labels.CUT_OFF)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    ship(spark)
    return bagminhash.deduplicated(docs)


def without_private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts masked; ``n_chars`` follows the text."""
    ship(spark)
    masked = private_data.redacted(docs)
    return masked.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' ids in sequences of 1024."""
    ship(spark)
    return packing.packed(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", without_toxic),
    ("quality", without_bad),
    ("near-duplicates", without_copies),
    ("private data", without_private_data),
    ("packing", packed),
]

# No stage but the fixed patterns of private data has an SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
