"""Column functions: each takes a column or its name and returns a column."""

from accountloom.functions.casts import WIDE, to_double, to_int
from accountloom.functions.dates import (
    days_before,
    days_until,
    month_of,
    parse_date,
    parse_timestamp,
    run_date,
)
from accountloom.functions.text import (
    capitalize_parts,
    capitalize_words,
    normalize_email,
    normalize_enum,
    round_money,
    trim_whitespace,
)

__all__ = [
    "WIDE",
    "capitalize_parts",
    "capitalize_words",
    "days_before",
    "days_until",
    "month_of",
    "normalize_email",
    "normalize_enum",
    "parse_date",
    "parse_timestamp",
    "round_money",
    "run_date",
    "to_double",
    "to_int",
    "trim_whitespace",
]
