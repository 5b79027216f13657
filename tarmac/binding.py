"""Flights derived from the ``lineitem`` test table.

Every line item becomes one flight; the remainders below only decide which values a flight
gets (a missing key, a bad code, a delay exactly on a band limit), never whether it is read.
The text runs unchanged in Spark and in the SQL engine that checks the results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tarmac.operators.cleaning import clean

RAW_COLUMNS = {
    "month": "CASE WHEN l_orderkey % 101 = 0 THEN 13 ELSE CAST(month(l_shipdate) AS INT) END",
    "op_unique_carrier": """CASE WHEN l_orderkey % 97 = 0 THEN NULL
        WHEN l_linenumber % 2 = 0 THEN concat(' ', lower(l_returnflag), lower(l_linestatus), ' ')
        ELSE concat(l_returnflag, l_linestatus) END""",
    "origin": "concat('ap', CAST(l_suppkey % 25 AS STRING))",
    "dep_delay": """CASE WHEN l_partkey % 20 = 0 OR l_suppkey % 53 = 0 THEN NULL
        ELSE l_quantity * 3 - 30 END""",
    "arr_delay": "CASE WHEN l_partkey % 20 = 0 THEN NULL ELSE l_quantity * 3 - 35 + l_linenumber END",
    "cancelled": """CASE WHEN l_orderkey % 103 = 0 THEN NULL
        WHEN l_partkey % 20 = 0 THEN 1 ELSE 0 END""",
    "cancellation_code": """CASE WHEN l_partkey % 20 = 0 THEN (CASE l_linenumber
            WHEN 1 THEN 'A' WHEN 2 THEN 'B' WHEN 3 THEN 'C' WHEN 4 THEN 'D'
            WHEN 5 THEN 'X' WHEN 6 THEN NULL ELSE 'a' END)
        WHEN l_orderkey % 89 = 0 THEN 'B' ELSE NULL END""",
    "diverted": "CASE WHEN l_partkey % 37 = 0 THEN 1 ELSE 0 END",
    "carrier_delay": "CASE WHEN l_quantity >= 16 AND l_linenumber % 2 = 0 THEN l_quantity ELSE NULL END",
    "weather_delay": "CASE WHEN l_quantity >= 16 AND l_linenumber % 3 = 0 THEN l_quantity ELSE NULL END",
    "nas_delay": "CASE WHEN l_quantity >= 16 THEN l_quantity * (l_orderkey % 2) ELSE NULL END",
    "security_delay": "CASE WHEN l_quantity >= 48 AND l_linenumber = 7 THEN l_quantity ELSE NULL END",
    "late_aircraft_delay": "CASE WHEN l_quantity >= 16 AND l_linenumber % 2 = 1 THEN l_quantity ELSE NULL END",
}

# The same flights as untidy text, for the scans that have to cope with it: repeated header
# lines, numbers with a decimal point, junk in a number, blanks and tabs around keys, lower-case or
# missing keys, commas and quotes in keys, fractions in the month.
TEXT_COLUMNS = {
    "month": """CASE WHEN l_orderkey % 211 = 0 THEN 'month' WHEN l_orderkey % 223 = 0 THEN '3.5'
        WHEN l_orderkey % 227 = 0 THEN NULL ELSE CAST(month(l_shipdate) AS STRING) END""",
    "op_unique_carrier": """CASE WHEN l_orderkey % 97 = 0 THEN '  ' WHEN l_orderkey % 101 = 0 THEN chr(9)
        WHEN l_linenumber % 2 = 0 THEN concat(' ', l_returnflag, l_linestatus, ' ')
        ELSE concat(l_returnflag, l_linestatus) END""",
    "origin": """CASE WHEN l_suppkey % 25 = 7 THEN concat('AP,"', CAST(l_linenumber % 2 AS STRING))
        ELSE concat('AP', CAST(l_suppkey % 25 AS STRING)) END""",
    "dep_delay": """CASE WHEN l_partkey % 20 = 0 OR l_suppkey % 53 = 0 THEN NULL
        WHEN l_partkey % 41 = 0 THEN 'late' ELSE CAST(l_quantity * 3 - 30 AS STRING) END""",
    "arr_delay": """CASE WHEN l_partkey % 20 = 0 THEN ' ' WHEN l_partkey % 43 = 0 THEN '5 min' WHEN l_partkey % 47 = 0 THEN '5d'
        ELSE CAST(CAST(l_quantity * 3 - 35 + l_linenumber AS INT) AS STRING) END""",
    "cancelled": """CASE WHEN l_orderkey % 103 = 0 THEN NULL WHEN l_orderkey % 107 = 0 THEN 'no'
        WHEN l_partkey % 20 = 0 THEN '1.0' ELSE '0' END""",
    "cancellation_code": "CASE WHEN l_partkey % 20 = 0 THEN 'A' ELSE NULL END",
    "carrier_delay": "CASE WHEN l_linenumber % 2 = 0 THEN CAST(l_quantity AS STRING) ELSE NULL END",
    "weather_delay": "CASE WHEN l_linenumber % 3 = 0 THEN CAST(l_quantity AS STRING) ELSE NULL END",
    "nas_delay": "CASE WHEN l_orderkey % 109 = 0 THEN 'n/a' ELSE '0.0' END",
    "security_delay": "CASE WHEN l_linenumber = 7 THEN CAST(l_quantity AS STRING) ELSE NULL END",
    "late_aircraft_delay": "CASE WHEN l_linenumber % 2 = 1 THEN CAST(l_quantity AS STRING) ELSE NULL END",
    "cancellation_reason": "CASE WHEN l_partkey % 20 = 0 THEN 'Carrier' ELSE 'Not Cancelled' END",
}


def select_list(columns: dict[str, str]) -> list[str]:
    return [f"{text} AS {name}" for name, text in columns.items()]


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet")


def flights_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineitem(spark, sf_dir).selectExpr(*select_list(RAW_COLUMNS))


def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(flights_raw(spark, sf_dir))


def flights_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineitem(spark, sf_dir).selectExpr(*select_list(TEXT_COLUMNS))
