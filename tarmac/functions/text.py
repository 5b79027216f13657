"""Turning text cells into values without ever failing the job.

Spark runs in ANSI mode, where a plain cast of junk raises; these return NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Every character that counts as white space around a cell.
WHITESPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0"
    "\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029"
    "\u202f\u205f\u3000"
)

VISIBLE = "[^" + "".join(f"\\x{{{ord(c):x}}}" for c in WHITESPACE) + "]"  # one character that is none of these


def stripped(cell: Column) -> Column:
    """The cell without white space around it; searched for it only if its ends may be some."""
    plain = is_visible(cell) & is_visible(F.substring(cell, -1, 1))
    return F.when(plain, cell).otherwise(bare_of(cell))


def bare_of(cell: Column) -> Column:
    """``stripped`` by the search alone: less code, for cells that are seldom looked at."""
    return F.btrim(cell, F.lit(WHITESPACE))


def is_visible(cell: Column) -> Column:
    """Whether the first character is one of ASCII that leaves a mark."""
    return (cell >= "!") & (cell < "\x7f")


def is_blank(cell: Column) -> Column:
    """Whether nothing but white space is in the cell; mostly the first character decides."""
    return ~cell.rlike(VISIBLE)


def number(cell: Column) -> Column:
    """The cell as a double, NULL if it is blank or not a number.

    Type letters and hexadecimal digits, which Java reads as part of a number, are junk.
    """
    return F.when(~cell.rlike("[dDfFxX]"), cell.try_cast("double"))


def truncated(value: Column) -> Column:
    """A double as an int, cutting decimals off; NULL if it is too large or not a number."""
    return value.try_cast("int")


def whole(value: Column) -> Column:
    """A double as an int, NULL if it has a fraction."""
    return F.when(value == F.floor(value), value.try_cast("int"))


def from_number(value: Column, field: T.StructField) -> Column:
    """A double as the field's type; the month has to be a whole number."""
    if field.name == "month":
        return whole(value)
    return truncated(value) if isinstance(field.dataType, T.IntegerType) else value


def from_text(cell: Column, field: T.StructField) -> Column:
    """A text cell as the field's type. "1.0" is a number in every numeric column."""
    if isinstance(field.dataType, T.StringType):
        return cell
    return from_number(number(cell), field)
