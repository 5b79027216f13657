"""Raw file to clean table, quality report and size-graded subsets."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tarmac.model import SUBSET_SEED, SUBSET_SIZES
from tarmac.operators.cleaning import clean
from tarmac.operators.subsets import DRAW, POSITION, RUNG, Draw, dealt, dealt_by_position, permuted, with_draw
from tarmac.plans.quality import funnel_counts
from tarmac.sources import files
from tarmac.sources.writing import header_line, joined, write_csv, write_manifest, write_table


def write_clean(
    raw: DataFrame, path: str, draw: Draw | None = None, lines: Observation | None = None
) -> dict[str, int]:
    """Write the clean table and return the rows left after each cleaning step.

    The counts are taken while the rows pass by, so the raw data is read once. ``draw`` is stored
    with each row, for subsets. ``lines`` is what the scan of ``raw`` observes; the funnel
    then begins with the lines and those that parsed.
    """
    counts = Observation("cleaning_funnel")
    observed = raw.observe(counts, *(count.alias(step) for step, count in funnel_counts().items()))
    flights = clean(observed)
    write_table(with_draw(flights, draw) if draw else flights, path)
    if lines is None:
        return counts.get
    funnel = counts.get
    return {"raw": lines.get["lines"], "parsed": funnel.pop("raw"), **funnel}


def write_shuffled(spark: SparkSession, clean_path: str, path: str, seed: int = SUBSET_SEED, draw: Draw | None = None) -> None:
    """The clean table in seeded random order, each row with its position."""
    write_table(permuted(spark.read.parquet(clean_path), seed, draw), path)


def write_rungs(table: DataFrame, names: list[str], out_dir: str) -> dict[str, int]:
    """Write a dealt table as delimited text, a folder for each rung's own rows, and the manifest that says which
    folders make up which subset; returns the rows of each subset.

    One job, however many rungs there are; each row is written once, and counted as it passes.
    """
    spark = table.sparkSession
    rows = Observation("rungs")
    counts = [F.count_if(F.col(RUNG) <= k).alias(str(k)) for k in range(len(names))]
    write_csv(table.observe(rows, *counts), out_dir, by=RUNG)
    found = rows.get
    written = {name: found[str(k)] for k, name in enumerate(names)}
    with_rows = [k for k in range(len(names)) if written[names[k]] > (written[names[k - 1]] if k else 0)]
    write_manifest(spark, out_dir, {name: [f"{RUNG}={j}" for j in with_rows if j <= k] for k, name in enumerate(names)})
    return written


def write_subsets(
    spark: SparkSession,
    clean_path: str,
    out_dir: str,
    sizes: dict[str, int] = SUBSET_SIZES,
    seed: int = SUBSET_SEED,
    exact: bool = False,
    draw: Draw | None = None,
    layout: str = "folders",
) -> dict[str, int]:
    """Write all rungs of the ladder in one pass over the clean table; returns the rows in each.

    ``draw`` names the draw that is stored in the table, if one is. A table with positions
    (``permuted``) is cut by them, so a rung of n rows is its first n.

    By ``layout`` each subset is a folder or a single file ``flight_<size>.csv``, which holds all its rows; or
    "nested", each row is written once and a manifest says which folders make up a subset.
    """
    table = spark.read.parquet(clean_path)
    if POSITION in table.columns:
        rows, names = dealt_by_position(table.drop(DRAW), sizes)
        rows = rows.drop(POSITION)
    else:
        rows, names = dealt(table, sizes, seed, draw, exact)
    if layout == "nested":
        return write_rungs(rows, names, out_dir)
    counts = Observation("rungs")
    observed = rows.observe(counts, *(F.count_if(F.col(RUNG) <= k).alias(str(k)) for k in range(len(names))))
    # a row goes to the smallest rung that has it and to all larger ones
    labels = F.array(*(F.lit(f"flight_{name}.csv") for name in names))
    each = observed.withColumn("subset", F.explode(F.slice(labels, F.col(RUNG) + 1, len(names)))).drop(RUNG)
    single = layout == "files"
    parts = f"{out_dir}/_subsets"
    write_csv(each, parts, by="subset", header=not single)
    found = counts.get
    written = {name: found[str(k)] for k, name in enumerate(names)}
    for name, rows_in in written.items():
        folder, target = f"{parts}/subset=flight_{name}.csv", f"{out_dir}/flight_{name}.csv"
        if not rows_in:
            write_csv(each.drop("subset").limit(0), folder, header=not single)
        if single:
            joined(spark, folder, target, header_line(rows.drop(RUNG).columns), "")
        else:
            files.rename(spark, folder, target)
    files.delete(spark, parts)
    return written
