"""Text clean-up expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A "+" and the digits after it, at the start of a phone number.
PHONE_PREFIX = r"^\+\d+"
EDGE_WHITESPACE = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"
WHITESPACE_RUN = r"(?U)[\s\x1c-\x1f]+"


def strip_whitespace(col: Column) -> Column:
    """Removes spaces, tabs, newlines and no-break spaces at both ends (``trim`` takes spaces only)."""
    return F.regexp_replace(col, EDGE_WHITESPACE, "")


def clean_email(col: Column) -> Column:
    return strip_whitespace(F.lower(col))


def phone_country(col: Column, max_digits: int | None = None) -> Column:
    """The leading ``+`` and digits, NULL without them.

    A number written without separators comes back whole; ``max_digits=3`` stops after a country code.
    """
    pattern = PHONE_PREFIX if max_digits is None else rf"^\+\d{{1,{max_digits}}}"
    return F.regexp_substr(col, F.lit(pattern))


def join_tags(col: Column) -> Column:
    """``a|b`` as ``a, b``."""
    return F.replace(col, F.lit("|"), F.lit(", "))


def tag_array(col: Column) -> Column:
    """Tags as an array, from the raw ``a|b`` or the cleaned ``a, b`` form."""
    return F.split(col, r"\||, ")


def clean_query(col: Column) -> Column:
    """Lower case, no outer blanks, single inner blanks."""
    return F.regexp_replace(strip_whitespace(F.lower(col)), WHITESPACE_RUN, " ")
