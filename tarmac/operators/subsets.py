"""Seeded subsets of a table.

Every row gets a draw, a whole number that is uniform over the rows, and a subset of n rows
is the n rows with the smallest draws. A few counting jobs find where the n-th draw lies;
taking the subset is then a filter inside the scan. Nothing is sorted, and there is no
``limit``, which would send all the rows it keeps through one task. All subsets of a table can be
dealt in one pass as well: each row then has the number of the smallest one it is in.

Draws by the record are the same for copies of a record. A sample tells the copies apart first, so that of
c copies a binomial number stays; an exact subset takes all copies, or at its border as many as it needs.

The input is scanned more than once. A draw that is stored as a column of the table is computed
once and the filter on it reaches the scan; a random draw that is not stored needs the same
rows in the same places each time, which two jobs may not give if they split the files differently.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.model import SUBSET_SEED, SUBSET_SIZES
from tarmac.sources.scratch import scratch_path
from tarmac.sources.writing import write_table

DRAW = "_draw"
RUNG = "rung"
POSITION = "position"
FULL = "full"
STEP = 16  # bits looked at per counting job: at most 65,536 counts for each size
COPIES_PER_CHUNK = 10_000
TIE_SEED = 1_000_003  # of the hash that orders records of equal draws
ROWS_PER_DEAL = 1_000_000  # rows sorted by one task of a permutation, about
MOST_DEALS = 1 << 16


class Draw(NamedTuple):
    """A column of whole numbers from 0 to 2 ** bits - 1; ``alone`` if no rows share theirs but by chance."""

    column: Column
    bits: int
    alone: bool = False


class Cut(NamedTuple):
    """The subset has all rows whose draw is below ``low`` and ``keep`` of the ``rows`` rows
    whose draw lies from ``low`` to ``high``."""

    low: int
    high: int
    keep: int
    rows: int


class Rung(NamedTuple):
    """All rows whose draw lies below ``below`` and ``keep`` of those whose draw is ``tie``."""

    below: int
    tie: int = -1
    keep: int = 0


def random_draw(seed: int) -> Draw:
    """An independent draw for each row, fixed by the seed and the row's place in the input.

    Store it (``with_draw``) if the subsets must not depend on how later jobs split the files.
    """
    return Draw((F.rand(seed) * 2.0**52).cast("long"), 52, alone=True)


def record_draw(columns, seed: int) -> Draw:
    """A draw that depends only on the seed and the record, not on how it is stored.

    Equal records share it. The hash skips NULLs, so their places are hashed as well.
    """
    gaps = (F.col(name).isNull() for name in columns)
    return Draw(F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns, *gaps), 4), 60)


def portable_draw(columns, seed: int) -> Draw:
    """A record's draw that other engines can compute as well, from its text. Slower."""
    cells = (F.coalesce(F.col(name).cast("string"), F.lit("\\N")) for name in columns)
    return Draw(_digest(F.lit(str(seed)), *cells), 60)


def _digest(*cells: Column) -> Column:
    """60 bits of the cells' MD5."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *cells)), 1, 15), 16, 10).cast("long")


def with_draw(df: DataFrame, draw: Draw) -> DataFrame:
    """The table with its draw as a column, to be written and then named by ``stored``."""
    return df.withColumn(DRAW, draw.column)


def stored(draw: Draw) -> Draw:
    """The draw that ``with_draw`` has put into a table."""
    return Draw(F.col(DRAW), draw.bits, draw.alone)


def told_apart(df: DataFrame, draw: Draw) -> DataFrame:
    """The table with a draw for each row, also for each copy of a record.

    The first copy keeps the record's draw, the others get one from it and their number. It takes one exchange of
    the table, in which copies are counted on the map side; they are written out again spread over
    the tasks, so a record that is most of the table is no more work for any of them.
    """
    drawn = df.withColumn(DRAW, draw.column)
    if draw.alone:
        return drawn
    columns = [name for name in df.columns if name != DRAW]
    groups = _stored(drawn.groupBy(DRAW, *columns).agg(F.count("*").alias("_copies")), "copies")
    few = groups.filter(F.col("_copies") <= COPIES_PER_CHUNK)
    few = few.withColumn("_number", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))))
    many = _written_out(groups.filter(F.col("_copies") > COPIES_PER_CHUNK), "_copies")
    number = F.col("_number")
    own = F.shiftright(_digest(F.col(DRAW).cast("string"), number.cast("string")), 60 - draw.bits)
    told = F.when(number == 1, F.col(DRAW)).otherwise(own).alias(DRAW)
    return few.select(*columns, told).unionByName(many.select(*columns, told))


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    write_table(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def permuted(df: DataFrame, seed: int = SUBSET_SEED, draw: Draw | None = None) -> DataFrame:
    """All rows in seeded random order, with their ``position`` in it from 0.

    The order is that of draws by the record, copies told apart, so it does not depend on how the table is stored
    or split. Rows are dealt by the leading bits of their draw and sorted within a deal: one exchange, and
    no scan to sample the draws, which are uniform. The first rows are a random subset of the table.
    """
    draw = draw or record_draw(df.columns, seed)
    told = told_apart(df, draw)
    columns = [name for name in df.columns if name != DRAW]
    total, lead = df.count(), 0
    while total >> lead > ROWS_PER_DEAL and 1 << lead < MOST_DEALS and lead < draw.bits:
        lead += 1
    deal = F.shiftright(DRAW, draw.bits - lead).cast("int")
    sizes = dict(told.groupBy(deal.alias("deal")).agg(F.count("*").alias("rows")).collect())
    before = [0]
    for d in range(1 << lead):
        before.append(before[-1] + sizes.get(d, 0))
    # a deal is a partition, and its rows are numbered in order
    in_deal = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    starts = F.split(F.lit(",".join(map(str, before[:-1]))), ",").cast("array<bigint>")
    start = F.element_at(starts, F.spark_partition_id() + 1)
    ordered = told.repartitionById(1 << lead, deal).sortWithinPartitions(DRAW, record_draw(columns, TIE_SEED).column, *columns)
    return ordered.select(*columns, (start + in_deal).alias(POSITION))


def shuffled(df: DataFrame, seed: int = SUBSET_SEED) -> DataFrame:
    """All rows in seeded random order."""
    return permuted(df, seed).drop(POSITION)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("rows"))


def exact_subset(df: DataFrame, n: int, seed: int = SUBSET_SEED, draw: Draw | None = None) -> DataFrame:
    """Exactly n rows (all, if there are fewer), the same ones however the table is stored."""
    ladder = exact_ladder(df, {"subset": n}, seed, draw)
    return ladder.get("subset", ladder["full"])


def bernoulli_subset(df: DataFrame, n: int, seed: int = SUBSET_SEED, draw: Draw | None = None) -> DataFrame:
    """Each row with probability n / row count, and at most n rows."""
    ladder = size_ladder(df, {"subset": n}, seed, draw)
    return ladder.get("subset", ladder["full"])


def size_ladder(
    df: DataFrame,
    sizes: dict[str, int] = SUBSET_SIZES,
    seed: int = SUBSET_SEED,
    draw: Draw | None = None,
) -> dict[str, DataFrame]:
    """Random samples of at most the given sizes and, as "full", the table.

    Sizes above its row count are left out. A draw that is stored in the table can be named here.
    """
    return _ladder(df, *_drawn_rungs(df, sizes, seed, draw, exact=False))


def exact_ladder(
    df: DataFrame,
    sizes: dict[str, int] = SUBSET_SIZES,
    seed: int = SUBSET_SEED,
    draw: Draw | None = None,
) -> dict[str, DataFrame]:
    """Like ``size_ladder``, but of exactly the given sizes and chosen by the records.

    A draw that is costly to compute can be stored as a column of the table and named here.
    """
    return _ladder(df, *_drawn_rungs(df, sizes, seed, draw, exact=True))


def dealt(
    df: DataFrame,
    sizes: dict[str, int] = SUBSET_SIZES,
    seed: int = SUBSET_SEED,
    draw: Draw | None = None,
    exact: bool = False,
) -> tuple[DataFrame, list[str]]:
    """The table with the number of the smallest rung that has the row, and the rungs' names.

    Rung k of the ladder is the rows with numbers up to k; the last one is "full". One pass
    over the rows gives all rungs, and each row is there once.
    """
    drawn, rungs = _drawn_rungs(df, sizes, seed, draw, exact)
    return _deal(drawn, list(rungs.values())), [*rungs, FULL]


def dealt_by_position(df: DataFrame, sizes: dict[str, int] = SUBSET_SIZES) -> tuple[DataFrame, list[str]]:
    """Like ``dealt`` for a table with positions: a rung of n rows is the first n."""
    total = df.count()
    rungs = {name: Rung(n) for name, n in sorted(sizes.items(), key=lambda item: item[1]) if n <= total}
    return _deal(df.withColumn(DRAW, F.col(POSITION)), list(rungs.values())), [*rungs, FULL]


def _drawn_rungs(df: DataFrame, sizes, seed: int, draw: Draw | None, exact: bool) -> tuple[DataFrame, dict[str, Rung]]:
    """The table with its draws, and the rungs that it has rows for, the smallest first."""
    draw = draw or (record_draw(df.columns, seed) if exact else random_draw(seed))
    drawn = df.withColumn(DRAW, draw.column) if exact else told_apart(df, draw)
    cuts = find_cuts(drawn.select(DRAW), set(sizes.values()), draw.bits)
    total = None if exact else df.count()
    rungs = {}
    for name, n in sorted(sizes.items(), key=lambda item: item[1]):
        if n in cuts:
            limit = 2**draw.bits if exact or n == total else int(n / total * 2**draw.bits)
            rungs[name] = _rung(cuts[n], limit)
    return drawn, rungs


def _rung(cut: Cut, limit: int) -> Rung:
    """The rows up to the cut whose draw lies below the limit."""
    if cut.keep == cut.rows:
        return Rung(min(cut.high + 1, limit))
    return Rung(cut.low, cut.low, cut.keep) if limit > cut.low else Rung(limit)


def _ladder(df: DataFrame, drawn: DataFrame, rungs: dict[str, Rung]) -> dict[str, DataFrame]:
    return {**{name: _up_to(drawn, rung) for name, rung in rungs.items()}, FULL: df.drop(DRAW)}


def _deal(drawn: DataFrame, rungs: list[Rung], level: int = 0) -> DataFrame:
    ties = sorted({rung.tie for rung in rungs if rung.keep})
    place = F.lit(len(rungs))
    for k, rung in reversed(list(enumerate(rungs))):
        place = F.when(F.col(DRAW) < rung.below, F.lit(k)).otherwise(place)
    plain = drawn.filter(~F.col(DRAW).isin(ties)) if ties else drawn
    out = plain.withColumn(RUNG, place).drop(DRAW)
    for tie in ties:
        tied = drawn.filter(F.col(DRAW) == tie).drop(DRAW)
        out = out.unionByName(_deal_tied(tied, {k: r.keep for k, r in enumerate(rungs) if r.keep and r.tie == tie}, rungs, tie, level))
    return out


def _deal_tied(tied: DataFrame, keeps: dict[int, int], rungs: list[Rung], tie: int, level: int) -> DataFrame:
    """Rows of one draw, dealt to the rungs that have some of them by another draw; the rest is in the first
    rung that has all of them."""
    rest = next((k for k, rung in enumerate(rungs) if rung.below > tie), len(rungs))
    order = record_draw(tied.columns, TIE_SEED + level)
    told = told_apart(tied, order)
    cuts = find_cuts(told.select(DRAW), set(keeps.values()), order.bits)
    inner = _deal(told, [_rung(cuts[keep], 2**order.bits) for keep in keeps.values()], level + 1)
    return inner.withColumn(RUNG, F.element_at(F.array(*map(F.lit, [*keeps, rest])), F.col(RUNG) + 1))


def find_cuts(draws: DataFrame, sizes, bits: int) -> dict[int, Cut]:
    """The cut for each size, without those that reach past the last row.

    Each job counts the rows by the next bits of their draw, looking only at rows that share
    the bits found so far, until a cut falls between two counts or, among equal draws, the
    bits are used up. One row per size comes back to the driver.
    """
    if any(n < 1 for n in sizes):
        raise ValueError("a subset needs at least one row")
    found: dict[int, Cut] = {}
    pending = {n: (0, 0) for n in sizes}  # size -> leading bits so far, rows below them
    unseen = bits
    while pending:
        seen, unseen = unseen, max(unseen - STEP, 0)
        rows = draws
        if seen < bits:
            rows = draws.filter(F.shiftright(DRAW, seen).isin({lead for lead, _ in pending.values()}))
        counts = rows.groupBy(F.shiftright(DRAW, unseen).alias("cell")).agg(F.count("*").alias("rows"))
        counts = counts.withColumn("lead", F.shiftright("cell", seen - unseen))
        before = F.sum("rows").over(Window.partitionBy("lead").orderBy("cell")) - F.col("rows")
        wanted = F.array(
            *(
                F.struct(F.lit(n).alias("n"), F.lit(lead).alias("lead"), F.lit(n - below).alias("left"))
                for n, (lead, below) in pending.items()
            )
        )
        hits = (
            counts.withColumn("before", before)
            .withColumn("size", F.explode(wanted))
            .filter(F.col("lead") == F.col("size.lead"))
            .withColumn("keep", F.col("size.left") - F.col("before"))
            .filter((F.col("keep") > 0) & (F.col("keep") <= F.col("rows")))
            .select("size.n", "cell", "keep", "rows")
            .collect()
        )
        pending = {}
        for n, cell, keep, count in hits:
            if keep == count or unseen == 0:
                found[n] = Cut(cell << unseen, ((cell + 1) << unseen) - 1, keep, count)
            else:
                pending[n] = (cell, n - keep)
    return found


def _up_to(drawn: DataFrame, rung: Rung) -> DataFrame:
    below = drawn.filter(F.col(DRAW) < rung.below).drop(DRAW)
    if not rung.keep:
        return below
    return below.unionByName(_some_of(drawn.filter(F.col(DRAW) == rung.tie).drop(DRAW), rung.keep))


def _some_of(tied: DataFrame, keep: int) -> DataFrame:
    """``keep`` of the rows of ``tied``, which all share one draw.

    A hash of the whole record orders them, and is cut as the draw was; what then still ties
    are the copies of one record.
    """
    order = record_draw(tied.columns, TIE_SEED)
    hashed = tied.withColumn(DRAW, order.column)
    cut = find_cuts(hashed.select(DRAW), {keep}, order.bits)[keep]
    if cut.keep == cut.rows:
        return hashed.filter(F.col(DRAW) <= cut.high).drop(DRAW)
    below = hashed.filter(F.col(DRAW) < cut.low).drop(DRAW)
    return below.unionByName(_some_copies(hashed.filter(F.col(DRAW) == cut.low), tied.columns, cut.keep))


def _some_copies(copies: DataFrame, columns: list[str], keep: int) -> DataFrame:
    """``keep`` of the copies of one record (or of a few, should their hashes collide).

    The copies are counted on the map side, so no task ever holds more than one of each.
    """
    groups = copies.groupBy(DRAW, *columns).agg(F.count("*").alias("_copies"))
    before = F.sum("_copies").over(Window.partitionBy(DRAW).orderBy(*columns)) - F.col("_copies")
    taken = groups.withColumn("_take", F.least("_copies", F.lit(keep) - before)).filter("_take > 0")
    return _written_out(taken, "_take").select(*columns)


def _written_out(groups: DataFrame, times: str) -> DataFrame:
    """Each row as often as its column ``times`` says, numbered from 1, in chunks that spread over the tasks."""
    # neither the chunks nor the copies of a chunk are more than about the square root of the copies
    size = F.greatest(F.lit(COPIES_PER_CHUNK), F.ceil(F.sqrt(times)))
    chunks = groups.withColumn("_chunk", F.explode(F.sequence(F.lit(0), F.floor((F.col(times) - 1) / size))))
    rest = F.least(size, F.col(times) - F.col("_chunk") * size)
    return (
        chunks.repartition(DRAW, "_chunk")
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), rest)))
        .withColumn("_number", F.col("_chunk") * size + F.col("_copy"))
    )
