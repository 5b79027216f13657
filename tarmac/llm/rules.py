"""Quality rules as a ledger of bits.

Every rule looks at each document once. The ledger keeps the counts and one number whose bit i is set
if rule i fails. A policy is a name, a version and a set of rules; applying it, changing it, or
asking what a rule alone removes needs no look at the texts again, only at the bits.

Null and empty texts have no words and fail ``few_words``. A document that occurs in several
rows has as many rows in the ledger. Other columns of the documents are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm import measure

# Name to the condition under which a document fails; the position is the bit.
RULES: dict[str, str] = {
    "few_words": "n_words < 50",
    "repeated_runs": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "duplicate_lines": "10 * n_dup_lines > 3 * n_lines",
    "capitals": "10 * n_upper_words > 3 * n_words",
    "same_words": "10 * n_same_words > n_words",
    "few_distinct_words": "n_words >= 200 and 20 * n_distinct_words < n_words",
    "word_length": "word_chars < 2 * n_words or word_chars > 20 * n_words",
    "digits": "4 * n_digits > word_chars",
}
BASE = ("few_words", "repeated_runs")


@dataclass(frozen=True)
class Policy:
    """A document is kept if none of ``rules`` fails."""

    name: str
    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return mask(self.rules)


def mask(rules) -> int:
    bits = {name: 1 << i for i, name in enumerate(RULES)}
    return sum(bits[name] for name in set(rules))


BASE_POLICY = Policy("base", 1, BASE)
DEFAULT_POLICY = Policy("prose", 1, tuple(RULES))


def ledger(docs: DataFrame) -> DataFrame:
    """doc_id, the counts, and ``failures`` with a bit for each failed rule."""
    counts = docs.select("doc_id", "text").mapInArrow(measure.measured, measure.SCHEMA)
    bits = [F.when(F.expr(condition), F.lit(1 << i)).otherwise(F.lit(0)) for i, condition in enumerate(RULES.values())]
    failures = bits[0].cast("long")
    for bit in bits[1:]:
        failures = failures.bitwiseOR(bit)
    return counts.withColumn("failures", failures)


def fails(policy: Policy, failures: Column | None = None) -> Column:
    bits = F.col("failures") if failures is None else failures
    return bits.bitwiseAND(F.lit(policy.mask)) != 0


def judged(entries: DataFrame, policy: Policy) -> DataFrame:
    """The ledger with the policy's verdict and its version."""
    return entries.withColumns(
        {"kept": ~fails(policy), "policy": F.lit(f"{policy.name}-{policy.version}")}
    )


def ablations(entries: DataFrame, policy: Policy) -> DataFrame:
    """For each rule of the policy: how many documents it fails, and how many it alone removes.

    The ledger is first folded to one row per set of failed rules, at most two to the number
    of rules; everything else is arithmetic on these rows.
    """
    sets = entries.groupBy(F.col("failures").bitwiseAND(F.lit(policy.mask)).alias("bits")).agg(
        F.count("*").alias("documents")
    )
    rules = [F.struct(F.lit(name).alias("rule"), F.lit(mask([name])).cast("long").alias("bit")) for name in policy.rules]
    each = sets.select("bits", "documents", F.explode(F.array(*rules)).alias("r")).select("bits", "documents", "r.*")
    failed = F.col("bits").bitwiseAND(F.col("bit")) != 0
    return each.groupBy("rule").agg(
        F.sum(F.when(failed, F.col("documents")).otherwise(0)).alias("failed"),
        F.sum(F.when(F.col("bits") == F.col("bit"), F.col("documents")).otherwise(0)).alias("removed_alone"),
        F.sum("documents").alias("documents"),
    )
