"""Cleaning steps, each a DataFrame -> DataFrame function for ``df.transform``.

The row tests are kept apart from the steps that apply them, so that the quality report
counts with exactly the tests that the cleaning uses.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.functions.delays import operated, was_cancelled
from tarmac.functions.text import from_text, is_blank, stripped
from tarmac.model import CANCELLATION_REASONS, DELAY_CAUSES, FLIGHTS, FLIGHTS_RAW, MANDATORY, NO_REASON

KEYS = ("op_unique_carrier", "origin")


# --- Row tests ----------------------------------------------------------------------


def is_complete(columns=MANDATORY) -> Column:
    """No NULL in any of the columns; unlike ``dropna`` the test reaches a Parquet scan."""
    return reduce(and_, (F.col(name).isNotNull() for name in columns))


def is_not_diverted() -> Column:
    return F.col("diverted") == 0


def has_delays_if_operated() -> Column:
    return was_cancelled() | (F.col("dep_delay").isNotNull() & F.col("arr_delay").isNotNull())


def has_valid_month() -> Column:
    return F.col("month").between(1, 12)


def has_keys(keys=KEYS) -> Column:
    return reduce(and_, (~is_blank(F.col(key)) for key in keys))


# --- Steps --------------------------------------------------------------------------


def select_columns(df: DataFrame, columns=tuple(FLIGHTS_RAW.names)) -> DataFrame:
    return df.select(*columns)


def cast_columns(df: DataFrame, columns=("month", "arr_delay", "cancelled")) -> DataFrame:
    """Text columns to the types of the schema; cells that do not fit become NULL."""
    return df.withColumns({name: from_text(F.col(name), FLIGHTS_RAW[name]) for name in columns})


def drop_null_mandatory(df: DataFrame, columns=MANDATORY) -> DataFrame:
    return df.filter(is_complete(columns))


def exclude_diverted(df: DataFrame) -> DataFrame:
    return df.filter(is_not_diverted())


def drop_column(df: DataFrame, column: str = "diverted") -> DataFrame:
    return df.drop(column)


def require_delays_if_operated(df: DataFrame) -> DataFrame:
    return df.filter(has_delays_if_operated())


def zero_fill_causes(df: DataFrame) -> DataFrame:
    """Missing causes of delay are 0 minutes if the flight operated, NULL if it did not."""
    flew, zero = operated(), F.lit(0.0)
    return df.withColumns({name: F.when(flew, F.coalesce(name, zero)) for name in DELAY_CAUSES})


def valid_month(df: DataFrame) -> DataFrame:
    return df.filter(has_valid_month())


def normalize_strings(df: DataFrame, columns=KEYS) -> DataFrame:
    """Capitals without white space around them. Blanks, the usual kind, go first and fast."""
    trimmed = df.withColumns({name: F.trim(name) for name in columns})
    return trimmed.withColumns({name: F.upper(stripped(F.col(name))) for name in columns})


def drop_empty_keys(df: DataFrame, keys=KEYS) -> DataFrame:
    return df.filter(has_keys(keys))


def validate_codes(df: DataFrame) -> DataFrame:
    """Unknown cancellation codes become NULL; the test is case-sensitive."""
    code = F.col("cancellation_code")
    return df.withColumn("cancellation_code", F.when(code.isin(*CANCELLATION_REASONS), code))


def map_reason(df: DataFrame) -> DataFrame:
    code = F.col("cancellation_code")
    known = (F.when(code == key, F.lit(reason)) for key, reason in CANCELLATION_REASONS.items())
    return df.withColumn("cancellation_reason", F.coalesce(*known, F.lit(NO_REASON)))


def nullify_code_operated(df: DataFrame) -> DataFrame:
    """Flights that operated keep no code; a reason already derived from it stays."""
    code = F.col("cancellation_code")
    return df.withColumn("cancellation_code", F.when(operated(), F.lit(None)).otherwise(code))


def clean(raw: DataFrame, normalize: bool = True) -> DataFrame:
    """Raw flights to clean flights. No step shuffles: the whole chain runs inside the scan.

    Blank keys go before the keys are normalised, so that the filter does not have to
    normalise them too. ``normalize=False`` leaves that to what groups by them.
    """
    return (
        raw.transform(select_columns)
        .transform(drop_null_mandatory)
        .transform(exclude_diverted)
        .transform(drop_column)
        .transform(require_delays_if_operated)
        .transform(zero_fill_causes)
        .transform(valid_month)
        .transform(drop_empty_keys)
        .transform(normalize_strings if normalize else lambda df: df)
        .transform(validate_codes)
        .transform(map_reason)
        .transform(nullify_code_operated)
        .select(*FLIGHTS.names)
    )
