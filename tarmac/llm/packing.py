"""Documents packed into as few sequences of a fixed size as can be.

A document is its ids and an end id. One that is longer than a sequence is cut into whole sequences, its
first piece being what is left over; others stay in one piece. Only how many pieces there
are of each length matters for what goes together, and there are no more lengths than
``size``: Spark counts them, minimum bin slack runs on the counts, and the plan it gives, so many
sequences of such a combination, is applied to all pieces in parallel.

Minimum bin slack fills one sequence at a time: it takes the longest piece there is and the
combination of others that leaves least room. Which sums can be reached is the set bits of one number,
shifted by each length in turn. The same combination is taken as often as the counts allow.

Null and empty texts are one end id. Rows that repeat are packed as often as they occur; doc_id may be
null. Other columns are left out. An empty table gives an empty one.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarmac.llm.encode import ID, encoder
from tarmac.llm.store import id_and_text, saved

SIZE = 1024
END_ID = 2


def cut(n: int, size: int) -> list[int]:
    """Lengths of the pieces of a document of ``n`` ids."""
    if n <= size:
        return [n]
    rest = n % size
    return ([rest] if rest else []) + [size] * (n // size)


def pieces(docs: DataFrame, tokenizer: str, size: int = SIZE, end_id: int = END_ID) -> DataFrame:
    """A row for each piece: doc_id, piece, start, length, ids (bytes), and ``task`` and ``nth``: it is the
    nth piece of its length that this task has made. Stored, so that these stay as they are."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, ids_of, seen = TaskContext.get().partitionId(), encoder(tokenizer, end_id), Counter()
        for batch in batches:
            rows: list[tuple] = []
            held = 0
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), ids_of.encode(batch.column("text").to_pylist())):
                at = 0
                for k, length in enumerate(cut(len(ids) // ID.itemsize, size)):
                    content = ids[at * ID.itemsize : (at + length) * ID.itemsize]
                    rows.append((doc_id, k, at, length, content, task, seen[length]))
                    seen[length] += 1
                    at += length
                held += len(ids)
                if held > 8_000_000:
                    yield _piece_rows(rows)
                    rows, held = [], 0
            yield _piece_rows(rows)

    kinds = "doc_id long, piece int, start long, length long, ids binary, task long, nth long"
    return saved(id_and_text(docs).mapInArrow(make, kinds), "pieces")


_PIECE = pa.schema(
    [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
     ("task", pa.int64()), ("nth", pa.int64())]
)


def _piece_rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(_PIECE)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _PIECE)], schema=_PIECE)


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """Which lengths, and how often, fill ``room`` best; long ones rather than short ones."""
    reached, mask = 1, (1 << (room + 1)) - 1
    steps: list[tuple[int, int, int]] = []
    for length in sorted((x for x in counts if x <= room), reverse=True):
        left, times = min(counts[length], room // length), 1
        while left and not reached >> room & 1:
            take = min(times, left)
            steps.append((length, take, reached))
            reached |= reached << length * take & mask
            left -= take
            times *= 2
        if reached >> room & 1:
            break
    best, taken = reached.bit_length() - 1, Counter()
    for length, take, before in reversed(steps):
        if not before >> best & 1:
            taken[length] += take
            best -= length * take
    return dict(taken)


def combinations(counts: dict[int, int], size: int = SIZE) -> Iterator[tuple[int, dict[int, int]]]:
    """How many sequences there are of which combination of lengths, until all counts are used up.

    Each combination is taken until a length of it runs short, so their number depends on the number of
    lengths and not on the number of pieces.
    """
    left = {length: n for length, n in counts.items() if n > 0}
    while left:
        longest = max(left)
        left[longest] -= 1
        chosen = Counter(fullest({x: n for x, n in left.items() if n}, size - longest))
        left[longest] += 1
        chosen[longest] += 1
        times = min(left[length] // n for length, n in chosen.items())
        yield times, dict(chosen)
        for length, n in chosen.items():
            left[length] -= times * n
            if not left[length]:
                del left[length]


def packed(docs: DataFrame, tokenizer: str, size: int = SIZE, end_id: int = END_ID) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``: in a sequence they follow each other from 0."""
    made = pieces(docs, tokenizer, size, end_id)
    spark = made.sparkSession
    by_task = made.groupBy("task", "length").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = saved(
        by_task.select("task", "length", "n", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")), "piece-counts"
    )
    counts = {row["length"]: row["n"] for row in before.groupBy("length").agg(F.sum("n").alias("n")).collect()}

    # a row for each length in each combination: pieces of that length from `low` to `high`
    plan, used, sequence = [], Counter(), 0
    for times, chosen in combinations(counts, size):
        offset = 0
        for length in sorted(chosen, reverse=True):
            each = chosen[length]
            plan.append((length, used[length], used[length] + times * each, each, sequence, offset))
            used[length] += times * each
            offset += each * length
        sequence += times
    kinds = "of_length long, low long, high long, each long, sequence long, at long"
    plan_rows = spark.createDataFrame(plan, kinds)

    ranked = (
        made.join(before.select("task", "length", "before"), ["task", "length"])
        .withColumn("rank", F.col("before") + F.col("nth"))
    )
    # the plan's size depends on `size` alone
    placed = ranked.join(
        F.broadcast(plan_rows),
        (F.col("length") == F.col("of_length")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")),
    )
    within = F.col("rank") - F.col("low")
    return placed.select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids",
        (F.col("sequence") + F.floor(within / F.col("each"))).alias("sequence_id"),
        (F.col("at") + (within % F.col("each")) * F.col("length")).alias("offset"),
    )
