"""The numbered operators and the pipeline as queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm import (
    bagminhash,
    centroids,
    divergence,
    language_model,
    merges,
    oracle,
    packing,
    pieces,
    private_data,
    rules,
    token_files,
    toxicity,
    vectors,
    weak_labels,
)
from tarmac.llm.ship import ship
from tarmac.llm.store import documents, saved
from tarmac.sources.scratch import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def _query(run: Query) -> Query:
    def shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return run(spark, sf_dir)

    QUERIES[run.__name__] = shipped
    return run


@_query
def op3_private_data(spark, sf_dir):
    found = private_data.find(documents(spark, sf_dir))
    kinds = enumerate(private_data.KINDS)
    return found.select(
        "doc_id",
        *(private_data.counted(F.col("base"), k).alias(f"n_{name}") for k, name in kinds),
        F.sha2(private_data.written(F.col("base")), 256).alias("base_sha256"),
        private_data.written(F.col("spans")).alias("spans"),
    )


@_query
def op6_rule_ledger(spark, sf_dir):
    entries = saved(rules.ledger(documents(spark, sf_dir)), "ledger")
    judged = rules.judged(entries, rules.DEFAULT_POLICY)
    base_failed = rules.fails(rules.BASE_POLICY)
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base_failed.alias("base_failed"),
        "kept",
        "failures",
        "policy",
    )


@_query
def op7_weak_labels(spark, sf_dir):
    docs = documents(spark, sf_dir)
    _, scorer = weak_labels.fit(docs)
    score = weak_labels.bad_score(spark, scorer)
    scored = docs.select("doc_id", score("text").alias("bad_score"))
    return scored.withColumn("kept", F.col("bad_score") < weak_labels.CUT_OFF)


@_query
def op8_bagminhash(spark, sf_dir):
    classes = bagminhash.near_duplicates(documents(spark, sf_dir))
    return classes.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("class_id")))


@_query
def op9_toxicity(spark, sf_dir):
    docs = documents(spark, sf_dir)
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    score = toxicity.toxic_score(spark, model)
    scored = docs.select("doc_id", toxicity.held_out().alias("held_out"), score("text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= toxicity.CUT_OFF).cast("int"))


@_query
def op1_token_files(spark, sf_dir):
    path = scratch_path(spark, "token-files")
    files = token_files.write_token_files(documents(spark, sf_dir), path, public_tokenizers.path("byte_bpe_50k.json"))
    read = token_files.read_token_files(files, path)
    return read.select(
        "doc_id", "start", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )


@_query
def op5_packing(spark, sf_dir):
    return packed_digests(packing.packed(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json")))


def packed_digests(placed: DataFrame) -> DataFrame:
    return placed.select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset"
    )


@_query
def op2_pieces(spark, sf_dir):
    path = public_tokenizers.path("piece_bpe_32k.model")
    spelt = pieces.spelt(documents(spark, sf_dir), path)
    return spelt.select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_pieces"),
        F.crc32("ids").alias("ids_crc32"),
        F.crc32("text").alias("text_crc32"),
    )


@_query
def op4_vectors(spark, sf_dir):
    return vectors.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@_query
def op10_pseudo_likelihood(spark, sf_dir):
    return language_model.scored(*language_model.fit(documents(spark, sf_dir)))


@_query
def op11_merges(spark, sf_dir):
    spelt = merges.spelt(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
    return spelt.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@_query
def op12_centroids(spark, sf_dir):
    found = centroids.with_inertia(*centroids.clustered(spark.read.parquet(f"{sf_dir}/embeddings.parquet")))
    return found.select(
        "vec_id",
        "cluster",
        "distance",
        "cluster_inertia",
        "inertia",
        F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ","), 256).alias("centroid_sha256"),
    )


@_query
def op13_divergence(spark, sf_dir):
    return divergence.audited(documents(spark, sf_dir))


ORACLE["op12_centroids"] = oracle.centroids_sql()
ORACLE["op13_divergence"] = oracle.divergence_sql()
ORACLE["op6_rule_ledger"] = oracle.ledger_sql(
    rules.RULES, rules.BASE_POLICY.mask, rules.DEFAULT_POLICY.mask, f"{rules.DEFAULT_POLICY.name}-{rules.DEFAULT_POLICY.version}"
)
