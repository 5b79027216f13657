"""Subsets: size, repeatability, independence of the layout, copies of one record."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tarmac import binding
from tarmac.operators import subsets
from tarmac.sources.writing import write_table
from helpers import exchanges, plan_of


@pytest.fixture(scope="module")
def table(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("subsets") / "flights")
    write_table(binding.flights(spark, sf_dir).repartition(6), path)
    return spark.read.parquet(path)


def bag(df):
    return Counter(tuple(row) for row in df.collect())


@pytest.mark.parametrize("n", [1, 2, 777, 5163, 5164])
def test_exact_size(table, n):
    got, everything = bag(subsets.exact_subset(table, n)), bag(table)
    assert sum(got.values()) == n
    assert not got - everything


def test_more_than_all_is_all(table):
    assert bag(subsets.exact_subset(table, 10_000)) == bag(table)
    assert bag(subsets.bernoulli_subset(table, 10_000)) == bag(table)


def test_exact_subset_does_not_depend_on_the_layout(spark, table, tmp_path):
    path = str(tmp_path / "other")
    write_table(table.orderBy("arr_delay").coalesce(2), path)
    assert bag(subsets.exact_subset(table, 1234)) == bag(subsets.exact_subset(spark.read.parquet(path), 1234))


def test_exact_subset_depends_on_the_seed(table):
    assert bag(subsets.exact_subset(table, 500, seed=1)) != bag(subsets.exact_subset(table, 500, seed=2))


def test_exact_subsets_are_nested(table):
    small, large = (bag(subsets.exact_subset(table, n)) for n in (300, 900))
    assert not small - large


def test_exact_subset_equals_sorting_everything(table):
    for draw in (subsets.record_draw(table.columns, 42), subsets.portable_draw(table.columns, 42)):
        want = table.withColumn("draw", draw.column).orderBy("draw").limit(1000).drop("draw")
        assert bag(subsets.exact_subset(table, 1000, draw=draw)) == bag(want)


def hot_table(spark, path, copies=30_000):
    hot = spark.range(copies).select(F.lit("copy").alias("name"), F.lit(1.5).alias("value"), F.lit(None).cast("int").alias("gap"))
    rest = spark.range(2000).select(
        F.concat(F.lit("r"), "id").alias("name"), (F.col("id") / 2).alias("value"), F.col("id").cast("int").alias("gap")
    )
    write_table(hot.union(rest).repartition(8), path)
    return spark.read.parquet(path)


def test_a_record_with_most_of_the_rows_is_cut_exactly(spark, tmp_path):
    df = hot_table(spark, str(tmp_path / "hot"))
    draws = df.withColumn("draw", subsets.record_draw(df.columns, 42).column)
    below = draws.filter(F.col("draw") < draws.filter("name = 'copy'").first().draw).count()
    for n in (below, below + 1, below + 12_345, below + 29_999, below + 30_000, below + 30_001):
        got = bag(subsets.exact_subset(df, n))
        assert sum(got.values()) == n
        hot = sum(count for row, count in got.items() if row[0] == "copy")
        assert hot == min(max(n - below, 0), 30_000)


def test_bernoulli_rows_are_independent_of_their_content(spark, tmp_path):
    df = hot_table(spark, str(tmp_path / "hot"))
    got = bag(subsets.bernoulli_subset(df, 16_000))
    hot = sum(count for row, count in got.items() if row[0] == "copy")
    assert 14_500 < hot < 15_500
    assert 800 < sum(got.values()) - hot < 1_200


@pytest.mark.parametrize("seed", range(5))
def test_bernoulli_is_at_most_n_and_repeatable(table, seed):
    first, second = (bag(subsets.bernoulli_subset(table, 1000, seed)) for _ in range(2))
    assert first == second
    assert 850 < sum(first.values()) <= 1000
    assert not first - bag(table)


def test_bernoulli_cap_binds_for_some_seeds(table):
    sizes = [subsets.bernoulli_subset(table, 1000, seed).count() for seed in range(6)]
    assert max(sizes) == 1000 and min(sizes) < 1000


def test_ladder_leaves_out_sizes_above_the_table(table):
    ladder = subsets.exact_ladder(table, {"a": 100, "b": 5164, "c": 5165})
    assert {name: df.count() for name, df in ladder.items()} == {"a": 100, "b": 5164, "full": 5164}
    ladder = subsets.size_ladder(table, {"a": 100, "b": 5164, "c": 5165})
    assert list(ladder) == ["a", "b", "full"]
    assert ladder["b"].count() == 5164


def test_empty_table(table):
    none = table.limit(0)
    assert list(subsets.size_ladder(none, {"a": 1})) == ["full"]
    assert subsets.exact_subset(none, 3).count() == 0


def test_sizes_have_to_be_positive(table):
    with pytest.raises(ValueError):
        subsets.exact_subset(table, 0)


def test_shuffle_keeps_all_rows_in_another_order(table):
    shuffled = subsets.shuffled(table)
    assert bag(shuffled) == bag(table)
    rows = [tuple(r) for r in table.collect()]
    got = [tuple(r) for r in shuffled.collect()]
    assert got != rows and got == [tuple(r) for r in subsets.shuffled(table).collect()]
    assert got != [tuple(r) for r in subsets.shuffled(table, 7).collect()]


def test_records_that_differ_in_where_a_value_is_missing_draw_differently(spark):
    df = spark.createDataFrame([(1, None), (None, 1)], "a int, b int")
    draw = subsets.record_draw(df.columns, 42).column
    assert df.select(draw).distinct().count() == 2


def test_a_stored_draw_is_pushed_and_does_not_depend_on_the_splits(spark, table, tmp_path):
    path = str(tmp_path / "drawn")
    draw = subsets.random_draw(2)
    write_table(subsets.with_draw(table, draw), path)
    drawn = spark.read.parquet(path)
    rung = subsets.size_ladder(drawn, {"a": 1000}, draw=subsets.stored(draw))["a"]
    assert rung.columns == table.columns
    assert f"LessThan({subsets.DRAW}," in plan_of(rung) or f"LessThanOrEqual({subsets.DRAW}," in plan_of(rung)
    first = bag(rung)
    settings = {"spark.sql.files.minPartitionNum": "64", "spark.sql.files.openCostInBytes": "1"}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        again = spark.read.parquet(path)
        assert bag(subsets.size_ladder(again, {"a": 1000}, draw=subsets.stored(draw))["a"]) == first
        assert bag(rung) == first and sum(first.values()) <= 1000
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_ties_are_cut_without_a_window_over_all_rows(spark, tmp_path):
    path = str(tmp_path / "shared")
    write_table(spark.range(1000).select((F.col("id") % 40).alias("id")), path)
    coarse = subsets.Draw(F.lit(0).cast("long"), 1)
    got = subsets.exact_subset(spark.read.parquet(path), 333, draw=coarse)
    assert "SinglePartition" not in plan_of(got)
    assert sum(bag(got).values()) == 333


def test_records_that_share_a_draw_are_still_cut_exactly(spark, tmp_path):
    path = str(tmp_path / "shared")
    write_table(spark.range(1000).select((F.col("id") % 40).alias("id")), path)
    df = spark.read.parquet(path)
    coarse = subsets.Draw(F.col("id") % 4, 2)
    for n in (1, 249, 250, 251, 618, 1000):
        got = bag(subsets.exact_subset(df, n, draw=coarse))
        assert sum(got.values()) == n and not got - bag(df)


def copies_table(spark, path):
    write_table(spark.range(200).select((F.col("id") % 20).cast("string").alias("name"), F.lit(1).alias("n")).repartition(3), path)
    return spark.read.parquet(path)


def test_copies_are_drawn_one_by_one(spark, tmp_path):
    """20 records of 10 copies: for each seed at most n rows, and over all seeds the share that was asked for."""
    df = copies_table(spark, str(tmp_path / "copies"))
    n, seeds, kept, parts = 55, 50, 0, set()
    for seed in range(seeds):
        got = bag(subsets.bernoulli_subset(df, n, draw=subsets.portable_draw(df.columns, seed)))
        assert sum(got.values()) <= n and not got - bag(df)
        kept += sum(got.values())
        parts |= set(got.values())
    # the cap takes the upper half of each draw's deviation, 0.4 standard deviations in the mean
    deviation = (200 * 0.275 * 0.725) ** 0.5
    assert abs(kept / seeds - (n - 0.4 * deviation)) < 4 * deviation / seeds**0.5
    assert not parts <= {10}  # neither all copies nor none


def test_copies_told_apart_do_not_depend_on_the_layout(spark, tmp_path):
    df = copies_table(spark, str(tmp_path / "copies"))
    other = spark.createDataFrame(df.orderBy("name").collect(), df.schema).coalesce(1)
    draw = subsets.record_draw(df.columns, 5)
    want = Counter(r[subsets.DRAW] for r in subsets.told_apart(df, draw).collect())
    assert Counter(r[subsets.DRAW] for r in subsets.told_apart(other, draw).collect()) == want
    assert len(want) == 200


def test_a_sample_of_a_record_that_is_most_of_the_table(spark, tmp_path):
    df = hot_table(spark, str(tmp_path / "hot"))
    got = bag(subsets.bernoulli_subset(df, 16_000, draw=subsets.record_draw(df.columns, 3)))
    hot = sum(count for row, count in got.items() if row[0] == "copy")
    assert 14_500 < hot < 15_500 and 800 < sum(got.values()) - hot < 1_200


@pytest.mark.parametrize("exact", [True, False])
@pytest.mark.parametrize("kind", ["record", "coarse", "one", "random"])
def test_one_pass_deals_the_rungs_of_the_ladder(spark, tmp_path, exact, kind):
    df = copies_table(spark, str(tmp_path / "copies"))
    draw = {
        "record": subsets.record_draw(df.columns, 1),
        "coarse": subsets.Draw(F.col("name").cast("long") % 4, 2),
        "one": subsets.Draw(F.lit(0).cast("long"), 1),
        "random": subsets.random_draw(1),
    }[kind]
    sizes = {"large": 120, "a": 7, "b": 8, "same": 8, "all": 200, "more": 201}
    rows, names = subsets.dealt(df, sizes, draw=draw, exact=exact)
    found = Counter(r[subsets.RUNG] for r in rows.collect())
    assert bag(rows.drop(subsets.RUNG)) == bag(df)
    assert set(names) == {"large", "a", "b", "same", "all", "full"} and names[-1] == "full"
    for k, name in enumerate(names[:-1]):
        size = sum(n for rung, n in found.items() if rung <= k)
        assert size == sizes[name] if exact else size <= sizes[name]


def test_one_pass_equals_the_ladder_rung_by_rung(table):
    draw = subsets.portable_draw(table.columns, 42)
    sizes = {"a": 100, "b": 900, "c": 3000}
    for exact, ladder in ((True, subsets.exact_ladder), (False, subsets.size_ladder)):
        rows, names = subsets.dealt(table, sizes, draw=draw, exact=exact)
        for name, df in ladder(table, sizes, draw=draw).items():
            assert bag(rows.filter(F.col(subsets.RUNG) <= names.index(name)).drop(subsets.RUNG)) == bag(df)


def test_dealing_scans_a_stored_draw_once(spark, table, tmp_path):
    path = str(tmp_path / "drawn")
    draw = subsets.random_draw(2)
    write_table(subsets.with_draw(table, draw), path)
    rows, _ = subsets.dealt(spark.read.parquet(path), {"a": 100, "b": 1000}, draw=subsets.stored(draw))
    plan = plan_of(rows, "simple")
    assert plan.count("FileScan") == 1 and "Exchange" not in plan


def test_positions_do_not_depend_on_how_the_table_is_split(spark, table, tmp_path, monkeypatch):
    want = bag(subsets.permuted(table))
    assert sorted(row[-1] for row in want) == list(range(5164))
    other = str(tmp_path / "other")
    write_table(table.orderBy("arr_delay").repartition(13), other)
    assert bag(subsets.permuted(spark.read.parquet(other))) == want
    monkeypatch.setattr(subsets, "ROWS_PER_DEAL", 300)  # more deals, the same order
    dealt = subsets.permuted(table)
    assert bag(dealt) == want and dealt.rdd.getNumPartitions() == 32
    assert [row.position for row in dealt.collect()] == list(range(5164))
    again = subsets.permuted(table)
    # one deals the rows, the other spreads records of very many copies
    assert exchanges(again) == 2 and "rangepartitioning" not in plan_of(again, "simple")


def test_a_permuted_table_is_cut_by_position(spark, table, tmp_path):
    path = str(tmp_path / "shuffled")
    write_table(subsets.permuted(table), path)
    rows, names = subsets.dealt_by_position(spark.read.parquet(path), {"b": 900, "a": 100, "x": 6000})
    assert names == ["a", "b", "full"]
    assert Counter(r.rung for r in rows.collect()) == {0: 100, 1: 800, 2: 4264}
    assert subsets.permuted(table.limit(0)).count() == 0
