"""Column helpers shared by the mapping, the checks and the queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_missing(c: Column) -> Column:
    """Null or blank text."""
    return c.isNull() | (F.trim(c) == "")


def to_double(c: Column) -> Column:
    """Number in a text cell, null when it is none."""
    return F.trim(c).try_cast("double")


def to_int(c: Column) -> Column:
    """Number in a text cell cut to an integer, so '2.0' and '2.7' give 2."""
    return to_double(c).try_cast("int")


def to_whole(c: Column) -> Column:
    """Integer in a text cell; a fractional number is no integer and gives null.

    Most cells are plain digits; only the others ('2.0', '1e3') are read as doubles.
    """
    d = to_double(c)
    return F.coalesce(F.trim(c).try_cast("int"), F.when(d == F.floor(d), d.try_cast("int")))


def to_bool(c: Column) -> Column:
    """Usual spellings of yes and no, blank meaning no; anything else is null."""
    s = F.lower(F.trim(c))
    return (F.when(s.isin("true", "1", "y", "yes", "t"), True)
            .when(s.isin("false", "0", "n", "no", "f", ""), False))


def total(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)


def percent(part: Column, whole: Column, digits: int) -> Column:
    """``100 * part / whole`` rounded half up in decimal, null for an empty whole."""
    p = part.cast("decimal(18,0)") * F.lit(100).cast("decimal(3,0)")
    w = F.when(whole != 0, whole.cast("decimal(18,0)"))
    return F.round(p / w, digits).cast("double")


def round_half_up(value: Column, digits: int) -> Column:
    """Half-up rounding of a double through decimal."""
    return F.round(value.cast("decimal(38,12)"), digits).cast("double")


def count_if(condition: Column) -> Column:
    """Rows for which the condition holds; 0, not null, when there are none."""
    return F.count(F.when(condition, 1))
