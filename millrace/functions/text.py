"""Text clean-up expressions. Whitespace means every Unicode space, not just U+0020."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The characters counted as whitespace.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 "
    "           "
    "    　"
)
# Fixed value: a run of anything but those characters.
WORD = r"(?U)[^\s\x1c-\x1f]+"

_DIGITS = r"[0-9]+(?:_[0-9]+)*"
_DECIMAL = rf"^[+-]?(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?$"


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def required_text(text: Column) -> Column:
    """Stripped text, null when nothing is left (a required field then fails)."""
    return F.nullif(strip(text), F.lit(""))


def optional_text(text: Column) -> Column:
    """Stripped text, null when blank. The word ``null`` stays a value."""
    return F.nullif(strip(text), F.lit(""))


def finite_double(text: Column) -> Column:
    """A decimal number, or null for blank, non-numeric, NaN and infinite input."""
    bare = strip(text)
    number = F.replace(bare, F.lit("_"), F.lit("")).try_cast("double")
    return F.when(bare.rlike(_DECIMAL) & is_finite(number), number)


def is_finite(number: Column) -> Column:
    return ~F.isnan(number) & (F.abs(number) < F.lit(float("inf")))


def whole_number(text: Column) -> Column:
    """A 64-bit integer, or null."""
    return strip(text).try_cast("bigint")


def words(text: Column) -> Column:
    """The runs between whitespace; an empty array for a blank line."""
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def is_data_line(fields: Column) -> Column:
    """False for the words of a blank line or a ``#`` comment."""
    return (F.size(fields) > 0) & ~F.get(fields, F.lit(0)).startswith("#")
