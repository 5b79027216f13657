"""Small things the tests share."""

from pyspark.sql import functions as F

from tarmac.model import FLIGHTS, FLIGHTS_RAW

HEADER = ",".join(FLIGHTS_RAW.names)


def write_lines(path, lines, header=HEADER):
    """A text file of the given lines; returns its path as text."""
    path.write_text("\n".join([header, *lines]) + "\n")
    return str(path)


def flight(**values):
    """One clean flight: operated, on time, no causes, unless told otherwise."""
    row = {
        "month": 1, "op_unique_carrier": "AA", "origin": "JFK", "dep_delay": 0.0, "arr_delay": 0.0,
        "cancelled": 0, "cancellation_code": None, "carrier_delay": 0.0, "weather_delay": 0.0,
        "nas_delay": 0.0, "security_delay": 0.0, "late_aircraft_delay": 0.0,
        "cancellation_reason": "Not Cancelled",
    }
    assert set(values) <= set(row)
    row.update(values)
    return tuple(row[name] for name in FLIGHTS.names)


def flights(spark, *rows):
    return spark.createDataFrame(list(rows), FLIGHTS)


def rows_of(df):
    """All rows as sorted tuples."""
    return sorted((tuple(row) for row in df.collect()), key=repr)


def plan_of(df, mode="formatted"):
    explain = df.sparkSession._jvm.PythonSQLUtils.explainString
    return explain(df._jdf.queryExecution(), mode)


def exchanges(df):
    """Shuffles in the physical plan, before any runtime re-planning."""
    return plan_of(df, "simple").count("Exchange ")


def times(df, n):
    """Each row n times."""
    copies = df.withColumn("_i", F.explode(F.sequence(F.lit(1), F.lit(n))))
    return copies.drop("_i")
