"""Hand-made lines through the whole chain, with results worked out by hand."""

import pytest
from pyspark.sql import functions as F

from tarmac.model import FLIGHTS_RAW
from tarmac.operators import cleaning
from tarmac.operators.measures import cause_counts
from tarmac.plans import airport, carrier, quality
from tarmac.sources.reading import scan_csv, scan_report, scan_tolerant
from helpers import rows_of, write_lines

LINES = {
    "E1": "1,AA,JFK,-5,-12,0,,0,,,,,",
    "E2": "1,AA,JFK,14,10,0,,0,,,,,",
    "E3": "1,AA,JFK,15,16,0,,0,,,,,",
    "E4": "1,AA,JFK,60,55,0,,0,0,0,50,0,0",
    "E5": "1,AA,JFK,61,70,0,,0,0,0,61,0,0",
    "E6": "1,AA,JFK,,,1,A,0,,,,,",
    "E7": "1,AA,JFK,,,1,X,0,,,,,",
    "E8": "1,AA,JFK,,,1,a,0,,,,,",
    "E9": "1,AA,JFK,,,1,,0,,,,,",
    "E10": "1,AA,JFK,0,2,0,B,0,,,,,",
    "E11": "1,AA,JFK,5,5,0,,1,,,,,",
    "E12": "1,,JFK,5,5,0,,0,,,,,",
    "E13": '1,"  ",JFK,5,5,0,,0,,,,,',
    "E14": "1, aa , jfk ,20,20,0,,0,,,,,",
    "E15": "13,AA,JFK,5,5,0,,0,,,,,",
    "E16": "1,AA,JFK,5,,0,,0,,,,,",
    "E17": "1,AA,JFK,,30,1,C,0,,,,,",
    "E18": "1,AA,JFK,16,18,0,,0,5,5,0,5,5",
    "E19": "1,AA,JFK,5,abc,0,,0,,,,,",
    "E20": "1,AA,JFK,,,1.0,D,0,,,,,",
}


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    path = write_lines(tmp_path_factory.mktemp("edge") / "raw.csv", LINES.values())
    return scan_tolerant(spark, path, FLIGHTS_RAW).cache()


@pytest.fixture(scope="module")
def clean(raw):
    return cleaning.clean(raw).cache()


def test_malformed_line_goes_and_is_reported(spark, raw, tmp_path):
    assert raw.count() == 19
    path = write_lines(tmp_path / "raw.csv", LINES.values())
    assert rows_of(scan_report(spark, path, FLIGHTS_RAW)) == [("kept", 19), ("malformed", 1)]


def test_lenient_scan_keeps_every_line(spark, tmp_path):
    path = write_lines(tmp_path / "raw.csv", LINES.values())
    df = scan_csv(spark, path)
    assert df.count() == 20
    assert cleaning.clean(df).count() == 14


def test_rows_left_after_each_step(raw):
    assert [row.rows for row in quality.cleaning_funnel(raw).orderBy("step_no").collect()] == [19, 18, 17, 16, 15, 14]


def test_one_pass_funnel_equals_counting_step_by_step(raw):
    df, counts = raw, [raw.count()]
    for step in (
        cleaning.drop_null_mandatory, cleaning.exclude_diverted, cleaning.require_delays_if_operated,
        cleaning.valid_month, lambda d: cleaning.drop_empty_keys(cleaning.normalize_strings(d)),
    ):
        df = step(df)
        counts.append(df.count())
    assert counts == [row.rows for row in quality.cleaning_funnel(raw).orderBy("step_no").collect()]


def test_quality_summary(raw):
    assert rows_of(quality.quality_summary(raw)) == [(19, 14, 5, 26.3)]
    assert rows_of(quality.quality_summary(raw.limit(0))) == [(0, 0, 0, None)]


def test_carrier_statistics(clean):
    assert rows_of(carrier.carrier_airport_stats(clean)) == [
        ("AA", "JFK", 14, -12.0, 70.0, 23.22, 0.4286, ["January"])
    ]


def test_bands(clean):
    assert rows_of(airport.airport_month_bands(clean)) == [
        ("JFK", 1, 3, 3.0, 0.0, 4, 27.75, 27.25, 1, 61.0, 70.0)
    ]


def test_cause_counts(clean):
    got = clean.agg(*cause_counts()).first().asDict()
    assert got == {
        "Delay_Carrier": 1, "Delay_Weather": 1, "Delay_NAS": 2, "Delay_Security": 1, "Delay_LateAircraft": 1,
        "Canc_Carrier": 1, "Canc_Weather": 0, "Canc_NAS": 1, "Canc_Security": 1,
    }
    assert clean.agg(*cause_counts(gate_cancelled=False)).first()["Canc_Weather"] == 1


def test_top_causes_break_ties_by_declared_order(clean):
    want = [("JFK", 1, 1, "Delay_NAS", 2), ("JFK", 1, 2, "Delay_Carrier", 1), ("JFK", 1, 3, "Delay_Weather", 1)]
    assert rows_of(airport.top_causes(clean)) == want


def test_code_goes_but_reason_stays_for_operated_flights(clean):
    operated_with_code = clean.filter((F.col("arr_delay") == 2) & (F.col("dep_delay") == 0))
    assert rows_of(operated_with_code.select("cancellation_code", "cancellation_reason")) == [(None, "Weather")]


def test_invalid_codes_mean_no_reason(clean):
    codes = clean.filter("cancelled = 1").select("cancellation_code", "cancellation_reason")
    assert rows_of(codes) == [
        ("A", "Carrier"), ("C", "NAS"), ("D", "Security"),
        (None, "Not Cancelled"), (None, "Not Cancelled"), (None, "Not Cancelled"),
    ]


def test_nested_documents(clean):
    document = carrier.nested_carrier_report(clean).first().asDict(recursive=True)
    assert document == {
        "carrier": "AA",
        "airports": [
            {
                "airport": "JFK",
                "data": {
                    "num_flights": 14, "arr_delay_min": -12.0, "arr_delay_max": 70.0, "arr_delay_avg": 23.22,
                    "cancellation_rate": 0.4286, "months": ["January"],
                },
            }
        ],
    }
    document = airport.nested_airport_report(clean).first().asDict(recursive=True)
    assert document == {
        "airport": "JFK",
        "months": [
            {
                "month": "January",
                "bands": {
                    "low": {"count": 3, "avg_dep_delay": 3.0, "avg_arr_delay": 0.0},
                    "medium": {"count": 4, "avg_dep_delay": 27.75, "avg_arr_delay": 27.25},
                    "high": {"count": 1, "avg_dep_delay": 61.0, "avg_arr_delay": 70.0},
                },
                "top_3_causes": [
                    {"cause": "Delay_NAS", "count": 2},
                    {"cause": "Delay_Carrier", "count": 1},
                    {"cause": "Delay_Weather", "count": 1},
                ],
            }
        ],
    }
