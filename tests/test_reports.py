"""Reports on made-up flights: variants, parameters, equivalences, skew."""

import pytest
from pyspark.sql import functions as F

from tarmac import binding
from tarmac.functions.delays import delay_band
from tarmac.functions.months import month_name, month_names, month_numbers, month_set
from tarmac.functions.text import WHITESPACE, from_text, stripped
from tarmac.model import CAUSE_LABELS, FLIGHTS, MONTH_NAMES
from tarmac.operators import cleaning, ranking
from tarmac.plans import airport, carrier
from helpers import flight, flights, rows_of, times

CANCELLED = {"cancelled": 1, "dep_delay": None, "arr_delay": None}


@pytest.fixture(scope="module")
def bound(spark, sf_dir):
    return binding.flights(spark, sf_dir).cache()


def test_binding_has_the_known_counts(spark, sf_dir, bound):
    assert binding.flights_raw(spark, sf_dir).count() == 6000
    assert bound.count() == 5164
    bands = dict(rows_of(bound.groupBy(delay_band().alias("band")).count()))
    assert bands == {"low": 1389, "medium": 1496, "high": 2005, None: 274}


def test_every_cleaning_step_keeps_the_schema_order(spark, sf_dir):
    df = binding.flights(spark, sf_dir)
    assert df.schema.simpleString() == FLIGHTS.simpleString()


@pytest.mark.parametrize(
    ("delay", "band"),
    [(-60.0, "low"), (14.99, "low"), (15.0, "medium"), (60.0, "medium"), (60.01, "high"), (None, None)],
)
def test_band_limits(spark, delay, band):
    df = flights(spark, flight(dep_delay=delay))
    assert df.select(delay_band()).first()[0] == band


def test_band_limits_are_parameters(spark):
    df = flights(spark, flight(dep_delay=20.0), flight(dep_delay=90.0))
    got = airport.airport_month_bands(df, low_below=30, high_above=100).first()
    assert (got.low_count, got.medium_count, got.high_count) == (1, 1, 0)


def test_cancelled_and_odd_flights_have_no_band(spark):
    df = flights(spark, flight(cancelled=1), flight(cancelled=2))
    assert rows_of(df.select(delay_band())) == [(None,), (None,)]


def test_band_mean_divides_by_all_rows_of_the_band(spark):
    df = flights(spark, flight(dep_delay=10.0, arr_delay=9.0), flight(dep_delay=4.0, arr_delay=None))
    got = airport.airport_month_bands(df).first()
    assert (got.low_count, got.low_avg_dep_delay, got.low_avg_arr_delay) == (2, 7.0, 4.5)
    assert (got.high_count, got.high_avg_dep_delay, got.high_avg_arr_delay) == (0, None, None)


def test_band_without_any_arrival_delay_averages_zero(spark):
    got = airport.airport_month_bands(flights(spark, flight(arr_delay=None))).first()
    assert got.low_avg_arr_delay == 0.0


def test_means_round_half_up(spark):
    df = flights(spark, flight(arr_delay=0.125), flight(arr_delay=0.125, origin="BOS"))
    assert {row.arr_delay_avg for row in carrier.carrier_airport_stats(df).collect()} == {0.13}


def test_cancelled_flight_with_arrival_delay_counts_in_it(spark):
    df = flights(spark, flight(arr_delay=1.0), flight(cancelled=1, arr_delay=30.0))
    got = carrier.carrier_airport_stats(df).first()
    assert (got.num_flights, got.arr_delay_max, got.arr_delay_avg, got.cancellation_rate) == (2, 30.0, 15.5, 0.5)


def test_group_without_arrival_delays(spark):
    got = carrier.carrier_airport_stats(flights(spark, flight(**CANCELLED))).first()
    assert (got.arr_delay_min, got.arr_delay_max, got.arr_delay_avg, got.cancellation_rate) == (None, None, None, 1.0)


def test_cancellation_without_a_reason_has_no_cause(spark):
    df = flights(spark, flight(**CANCELLED))
    assert ranking.explode_causes(df, "origin").count() == 0
    assert airport.top_causes(df).count() == 0
    assert airport.nested_airport_report(df).first().months[0].top_3_causes == []


def test_causes_follow_the_state_of_the_flight(spark):
    late = {"carrier_delay": 5.0, "nas_delay": 0.0, "late_aircraft_delay": 1.0}
    df = flights(
        spark,
        flight(**late),
        flight(cancelled=1, cancellation_reason="NAS", **late),
        flight(cancelled=0, cancellation_reason="Weather"),
        flight(cancelled=2, **late),
    )
    causes = rows_of(ranking.explode_causes(df).groupBy("cause").count())
    assert causes == [("Canc_NAS", 1), ("Delay_Carrier", 1), ("Delay_LateAircraft", 1)]
    ungated = airport.top_causes(df, k=9, gate_cancelled=False)
    assert ("Canc_Weather", 1) in rows_of(ungated.select("cause", "count"))


def test_array_and_window_ranking_agree(bound):
    for k in (1, 3, 9):
        assert rows_of(airport.top_causes(bound, k=k)) == rows_of(ranking.top_causes_by_window(bound, k=k))


def test_ranking_ties_follow_the_declared_order(spark):
    every = {"carrier_delay": 1.0, "weather_delay": 1.0, "nas_delay": 1.0, "security_delay": 1.0, "late_aircraft_delay": 1.0}
    reasons = [flight(cancelled=1, cancellation_reason=r) for r in ("Security", "NAS", "Weather", "Carrier")]
    df = flights(spark, *reasons, flight(**every))
    for ranked in (airport.top_causes(df, k=9), ranking.top_causes_by_window(df, k=9)):
        assert [row.cause for row in ranked.orderBy("rank").collect()] == list(CAUSE_LABELS)


def test_top_values_break_ties_by_value(spark):
    df = flights(spark, *(flight(origin=o) for o in ("C", "A", "B", "B")))
    assert [tuple(r) for r in ranking.top_values(df, "origin", 2).collect()] == [("B", 2), ("A", 1)]


def test_months_in_calendar_order(spark):
    df = flights(spark, *(flight(month=m) for m in (12, 4, 8, 1, 4)))
    assert carrier.carrier_airport_stats(df).first().months == ["January", "April", "August", "December"]
    report = airport.nested_airport_report(df).first()
    assert [m.month for m in report.months] == ["January", "April", "August", "December"]


def test_month_set_equals_collect_set(bound):
    got = bound.groupBy("op_unique_carrier", "origin").agg(
        month_numbers(month_set(F.col("month"))).alias("bits"),
        F.array_sort(F.collect_set("month")).alias("set"),
    )
    assert got.filter("bits = set").count() == got.count()


def test_month_set_holds_only_real_months(spark):
    df = spark.range(-40, 80).select(F.col("id").cast("int").alias("month"))
    assert df.agg(month_names(month_set(F.col("month")))).first()[0] == list(MONTH_NAMES)
    assert df.limit(0).agg(month_names(month_set(F.col("month")))).first()[0] == []
    named = df.select("month", month_name(F.col("month")).alias("name")).filter("name is not null")
    assert named.count() == 12
    assert named.filter("month = 7").first().name == "July"


def test_nested_reports_flatten_back(bound):
    flat = carrier.carrier_airport_stats(bound)
    assert rows_of(carrier.flatten_carrier_report(carrier.nested_carrier_report(bound))) == rows_of(flat)
    report = airport.nested_airport_report(bound)
    named = airport.airport_month_bands(bound).withColumn("month", month_name(F.col("month")))
    assert rows_of(airport.flatten_airport_bands(report)) == rows_of(named)
    causes = airport.top_causes(bound).withColumn("month", month_name(F.col("month")))
    assert rows_of(airport.flatten_airport_causes(report)) == rows_of(causes)


def test_keys_meet_after_normalising(spark):
    raw = flights(spark, flight(op_unique_carrier=" aa ", origin="jfk"), flight()).withColumn("diverted", F.lit(0))
    assert carrier.carrier_airport_stats(cleaning.clean(raw)).count() == 1


def test_white_space_around_text(spark):
    df = spark.createDataFrame([(WHITESPACE + "A B" + WHITESPACE,), (WHITESPACE,)], "cell string")
    assert rows_of(df.select(stripped(F.col("cell")))) == [("",), ("A B",)]


@pytest.mark.parametrize(
    ("text", "column", "value"),
    [
        ("1.0", "cancelled", 1), ("0", "cancelled", 0), ("x", "cancelled", None), ("", "cancelled", None),
        ("1e300", "cancelled", None), ("NaN", "cancelled", None), ("7", "month", 7), ("7.0", "month", 7),
        ("7.5", "month", None), ("-3.25", "arr_delay", -3.25), (" 4 ", "arr_delay", 4.0), (None, "arr_delay", None),
        ("AA", "origin", "AA"),
    ],
)
def test_text_to_value(spark, text, column, value):
    df = spark.createDataFrame([(text,)], "cell string")
    assert df.select(from_text(F.col("cell"), FLIGHTS[column])).first()[0] == value


def test_one_hot_group_gives_the_same_statistics(spark, bound):
    """A group with most of the rows: counts grow, everything else stays."""
    hot = times(bound.filter("origin = 'AP7'"), 50).unionByName(bound.filter("origin <> 'AP7'"))
    before = {(r[0], r[1]): r for r in carrier.carrier_airport_stats(bound).collect()}
    after = {(r[0], r[1]): r for r in carrier.carrier_airport_stats(hot).collect()}
    assert before.keys() == after.keys()
    for key, row in after.items():
        factor = 50 if key[1] == "AP7" else 1
        assert row.num_flights == factor * before[key].num_flights
        assert row[3:] == before[key][3:]


def test_unknown_reasons_rank_only_where_labels_are_open(spark):
    rows = [flight(cancelled=1, cancellation_reason="Strike"), flight(cancelled=1, cancellation_reason="Weather")]
    table = flights(spark, *rows)
    known = [(r.cause, r["count"]) for r in airport.top_causes(table).orderBy("rank").collect()]
    open_ = [(r.cause, r["count"]) for r in ranking.top_causes_by_window(table).orderBy("rank").collect()]
    assert known == [("Canc_Weather", 1)]
    assert open_ == [("Canc_Weather", 1), ("Canc_Strike", 1)]
