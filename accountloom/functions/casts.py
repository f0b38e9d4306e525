"""Number casts that turn bad text into NULL, also under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WIDE = "bigint"

# Text of a decimal number, such as the "12.0" that a float column exports.
_DECIMAL = r"^\s*(?<sign>[+-]?)(?<digits>[0-9]*)\.[0-9]*\s*$"


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_int(c: Column | str, type_name: str = WIDE) -> Column:
    """Whole number, a decimal's fraction cut off; NULL if not a number or too large.

    A strict cast refuses "12.0"; the fallback is only evaluated for such text.
    type_name="int" gives the 32 bits of a narrow source layer, in which larger
    numbers are NULL.
    """
    text = as_column(c)
    whole = F.regexp_replace(text, _DECIMAL, "${sign}0${digits}")
    return F.coalesce(text.try_cast(type_name), whole.try_cast(type_name))


def to_double(c: Column | str) -> Column:
    return as_column(c).try_cast("double")
