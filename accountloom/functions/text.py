"""Text and money normalization."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from accountloom.functions.casts import as_column

Trim = Callable[[Column], Column]

# Characters after which capitalize_parts starts a new word,
# besides whitespace. The apostrophe is not one of them.
WORD_DELIMITERS = r"""[](){}/|\<>!?@"^#$&~_,.:;*%+-"""

_DELIMITER_CLASS = r"\s" + "".join("\\" + ch for ch in WORD_DELIMITERS)
WORD_OR_DELIMITER = f"([^{_DELIMITER_CLASS}]+|[{_DELIMITER_CLASS}])"


def trim_whitespace(c: Column | str) -> Column:
    """Trim every kind of whitespace, where F.trim removes spaces only."""
    edge = r"[\s\p{Z}]+"
    return F.regexp_replace(F.regexp_replace(as_column(c), f"^{edge}", ""), f"{edge}$", "")


def normalize_email(c: Column | str, trim: Trim = F.trim) -> Column:
    return F.lower(trim(as_column(c)))


def normalize_enum(c: Column | str) -> Column:
    return F.lower(as_column(c))


def capitalize_words(c: Column | str, trim: Trim = F.trim) -> Column:
    """Trimmed, first letter of each space-separated word upper, the rest lower."""
    return F.initcap(trim(as_column(c)))


def capitalize_parts(c: Column | str, trim: Trim = F.trim) -> Column:
    """As capitalize_words, but other whitespace and punctuation start a new word as well."""
    parts = F.regexp_extract_all(F.lower(trim(as_column(c))), F.lit(WORD_OR_DELIMITER), 1)
    capitalized = F.transform(
        parts, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.substring(p, 2, 2**31 - 1))
    )
    return F.array_join(capitalized, "")


def round_money(c: Column | str) -> Column:
    return F.round(as_column(c), 2)
