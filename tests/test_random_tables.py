"""Random raw flights, with more disorder than the test tables have, through queries and SQL."""

import random

import duckdb
import pytest

from tarmac import binding, registry
from tarmac.model import FLIGHTS_RAW
from helpers import rows_of
from test_oracle import KINDS

NAMES = (
    "clean_flights", "cleaning_funnel", "quality_summary", "rows_by_month", "top_carriers", "top_origins",
    "carrier_airport_stats", "nested_carrier_report", "airport_month_bands", "band_sums", "top_causes",
    "top_causes_window", "nested_airport_report", "nested_airport_causes", "delay_cause_counts",
    "cancel_reason_counts", "cancel_reason_counts_ungated", "explode_causes", "delay_band", "csv_scan",
    "csv_roundtrip", "json_report_roundtrip", "subset_ladder",
)


def random_flights(seed, rows=3000):
    """Delays are quarters of a minute, so that sums do not depend on the order of adding."""
    rng = random.Random(seed)

    def maybe(value, chance=0.1):
        return None if rng.random() < chance else value

    def delay():
        return maybe(rng.choice([15.0, 60.0, 0.0, rng.randrange(-200, 800) / 4]), 0.15)

    def cause():
        return maybe(rng.choice([0.0, 0.0, -1.0, rng.randrange(0, 100) / 4]), 0.4)

    def flight():
        return (
            maybe(rng.randrange(-1, 15), 0.02),
            maybe(rng.choice(["AA", "aa", " AA ", "B6", "b6 ", "", "   ", "Zz"]), 0.05),
            maybe(rng.choice(["JFK", " jfk", "LAX", "ORD", "", " ", "ünü", 'a,"b"']), 0.05),
            delay(),
            delay(),
            maybe(rng.choice([0, 0, 0, 0, 1, 1, 2]), 0.03),
            maybe(rng.choice(["A", "B", "C", "D", "a", "X", " A"]), 0.5),
            maybe(rng.choice([0, 0, 0, 0, 0, 0, 1]), 0.03),
            *(cause() for _ in range(5)),
        )

    return [flight() for _ in range(rows)]


@pytest.fixture(scope="module", params=[1, 2])
def random_raw(request, spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("random") / "raw")
    spark.createDataFrame(random_flights(request.param), FLIGHTS_RAW).write.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW random_raw AS SELECT * FROM '{path}/*.parquet'")
    return spark.read.parquet(path), con


@pytest.mark.parametrize("name", NAMES)
def test_query_agrees_with_sql_on_random_flights(spark, random_raw, monkeypatch, name):
    raw, con = random_raw
    monkeypatch.setattr(binding, "flights_raw", lambda spark, sf_dir: raw)
    df = registry.QUERIES[name](spark, "unused")
    columns = sorted(df.columns)
    sql = registry.ORACLE[name]
    assert registry._RAW_CTE in sql
    relation = con.sql(sql.replace(registry._RAW_CTE, "flights_raw AS (SELECT * FROM random_raw)"))
    assert {c: KINDS[str(t)] for c, t in zip(relation.columns, relation.types)} == dict(df.dtypes)
    want = relation.select(*(duckdb.ColumnExpression(c) for c in columns)).fetchall()
    got = rows_of(df.select(*columns))
    if name == "csv_scan":  # an empty cell is a missing value
        want = [tuple(None if value == "" else value for value in row) for row in want]
    assert got == sorted(want, key=repr)
    assert got
