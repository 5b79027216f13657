"""The physical plans: shuffles, pruning, aggregation kind, code size."""

import re

import pytest
from tarmac import binding
from tarmac.model import AIRPORT_REPORT_COLUMNS, CARRIER_REPORT_COLUMNS, FLIGHTS, FLIGHTS_RAW, subset_of
from tarmac.operators import cleaning, ranking, subsets
from tarmac.plans import airport, carrier, quality
from tarmac.registry import QUERIES
from tarmac.sources import reading, writing
from tarmac.sources.writing import in_order
from helpers import exchanges, plan_of, times

JIT_LIMIT = 8000  # bytes of a generated method above which Java only interprets it


@pytest.fixture(scope="module")
def tables(spark, sf_dir, tmp_path_factory):
    folder = tmp_path_factory.mktemp("plans")
    writing.write_table(binding.flights_raw(spark, sf_dir), str(folder / "raw"))
    writing.write_table(binding.flights(spark, sf_dir), str(folder / "clean"))
    writing.write_csv(binding.flights_raw(spark, sf_dir), str(folder / "raw.csv"))
    writing.write_csv(binding.flights(spark, sf_dir), str(folder / "clean.csv"))
    return folder


@pytest.fixture(scope="module")
def clean(spark, tables):
    return spark.read.parquet(str(tables / "clean"))


@pytest.fixture(scope="module")
def raw(spark, tables):
    return spark.read.parquet(str(tables / "raw"))


def read_columns(df):
    schemas = re.findall(r"ReadSchema: struct<(.*)>", plan_of(df))
    return {field.split(":")[0] for schema in schemas for field in schema.split(",") if field}


@pytest.mark.parametrize(
    ("report", "most"),
    [
        (carrier.carrier_airport_stats, 1),
        (airport.airport_month_bands, 1),
        (airport.top_causes, 1),
        (ranking.top_causes_by_window, 2),
        (carrier.nested_carrier_report, 2),
        (airport.nested_airport_report, 2),
        (quality.top_carriers, 1),
        (cleaning.drop_empty_keys, 0),
        (subsets.row_count, 1),
    ],
)
def test_shuffles(clean, report, most):
    assert exchanges(report(clean)) <= most


@pytest.mark.parametrize("report", [carrier.nested_carrier_report, airport.nested_airport_report])
def test_a_report_in_order_takes_no_further_shuffle(clean, report):
    assert exchanges(in_order(report(clean))) == 2


def test_cleaning_and_funnel_shuffle_nothing_but_counts(raw):
    assert exchanges(cleaning.clean(raw)) == 0
    assert exchanges(quality.cleaning_funnel(raw)) == 1  # one row per task


@pytest.mark.parametrize(
    "report", [carrier.carrier_airport_stats, airport.airport_month_bands, airport.top_causes, quality.top_origins]
)
def test_aggregation_is_hashed_with_fixed_buffers(clean, report):
    plan = plan_of(report(clean), "simple")
    assert "HashAggregate" in plan and "partial_" in plan
    assert "ObjectHashAggregate" not in plan and "SortAggregate" not in plan


def test_reports_read_only_their_columns(clean):
    assert read_columns(carrier.carrier_airport_stats(clean)) == set(CARRIER_REPORT_COLUMNS)
    assert read_columns(airport.nested_airport_report(clean)) == set(AIRPORT_REPORT_COLUMNS)
    assert read_columns(quality.rows_by(clean, "month")) == {"month"}


def test_csv_scan_parses_only_wanted_columns(spark, tables):
    few = subset_of(FLIGHTS_RAW, ("month", "origin"))
    assert read_columns(reading.scan_csv(spark, str(tables / "raw.csv"), few)) == {"month", "origin"}


def test_cleaning_filters_reach_the_scan(raw):
    pushed = re.search(r"PushedFilters: \[(.*)\]", plan_of(cleaning.clean(raw))).group(1)
    for test in ("IsNotNull(op_unique_carrier)", "IsNotNull(cancelled)", "EqualTo(diverted,0)",
                 "GreaterThanOrEqual(month,1)", "LessThanOrEqual(month,12)", "Or(EqualTo(cancelled,1)"):
        assert test in pushed


def test_an_exact_subset_is_a_filter_in_the_scan(clean):
    plan = plan_of(subsets.exact_subset(clean, 1000), "simple")
    assert not re.search("Exchange|Limit|Sort|Window|Union", plan)


def test_a_sampled_subset_is_a_filter_in_the_scan(clean):
    plan = plan_of(subsets.bernoulli_subset(clean, 1000), "simple")
    assert not re.search("Exchange|Limit|Sort|Window|Union", plan)


def test_generated_code_is_small_enough_to_be_compiled(spark, tables, clean, raw):
    csv = str(tables / "clean.csv")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plans = [
            cleaning.clean(raw),
            cleaning.clean(reading.scan_csv(spark, str(tables / "raw.csv"))),
            carrier.nested_carrier_report(clean),
            airport.nested_airport_report(clean),
            carrier.nested_carrier_report(reading.read_flights(spark, csv, subset_of(FLIGHTS, CARRIER_REPORT_COLUMNS))),
            airport.nested_airport_report(reading.read_flights(spark, csv, subset_of(FLIGHTS, AIRPORT_REPORT_COLUMNS))),
            quality.cleaning_funnel(raw),
            subsets.exact_subset(clean, 1000),
        ]
        for df in plans:
            sizes = [int(size) for size in re.findall(r"maxMethodCodeSize:(\d+)", plan_of(df, "codegen"))]
            assert sizes and max(sizes) < JIT_LIMIT
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_in_any_plan_and_no_join(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir), "simple")
    assert not re.search("Python|Pandas|ArrowEval|Join|CartesianProduct|RDDScan|ExistingRDD", plan)


def test_shuffled_rows_are_bounded_by_tasks_and_groups(spark, clean):
    """However many rows a group has, a task sends one row of it."""
    plan = plan_of(carrier.carrier_airport_stats(times(clean, 20)), "simple")
    before_shuffle = plan.split("Exchange hashpartitioning")[1]
    assert "partial_count" in before_shuffle and "partial_bit_or" in before_shuffle
