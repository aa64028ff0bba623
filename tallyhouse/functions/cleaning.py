"""Turning dirty text into typed values, and flagging what was wrong with it.

Patterns end in ``\\z``: ``$`` would also match before a final line break. Values
are not trimmed before they are matched, so a padded numeral counts as invalid.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted text forms.
NUMERAL = r"^[0-9]+\.?[0-9]*\z"
LETTER = "[A-Za-z]"
YEAR_FIRST = r"^\d{4}-\d{2}-\d{2}\z"
DAY_FIRST = r"^\d{2}-\d{2}-\d{4}\z"

AMOUNT = "decimal(10,2)"


def is_missing(text: Column) -> Column:
    """NULL, or nothing but spaces."""
    return text.isNull() | (F.trim(text) == "")


def has_prefix(text: Column, letter: str) -> Column:
    """Exactly one leading letter before the digits."""
    return F.coalesce(text.rlike(rf"^{letter}[0-9]+\z"), F.lit(False))


def is_invalid_number(text: Column) -> Column:
    return ~F.coalesce(text.rlike(NUMERAL), F.lit(False))


def has_letters(text: Column) -> Column:
    return F.coalesce(text.rlike(LETTER), F.lit(False))


def clean_id(text: Column, letter: str) -> Column:
    """Digits, or one letter and digits, as a number; anything else is NULL."""
    digits = F.ltrim(text, F.lit(letter))
    return F.when(text.rlike(rf"^{letter}?[0-9]+\z"), digits.try_cast("bigint"))


def whole_number(text: Column, to: str = "int") -> Column:
    """The part of a numeral before the point: ``12.9`` gives 12."""
    return F.when(text.rlike(NUMERAL), F.substring_index(text, ".", 1).try_cast(to))


def parse_date(text: Column) -> Column:
    """Year-first or day-first dates; impossible dates are NULL."""
    turned = F.concat_ws("-", F.substring(text, 7, 4), F.substring(text, 4, 2), F.substring(text, 1, 2))
    iso = F.when(text.rlike(YEAR_FIRST), text).when(text.rlike(DAY_FIRST), turned)
    return iso.try_cast("date")


def parse_amount(text: Column) -> Column:
    """A plain numeral rounded half up to two decimals, else NULL."""
    return F.when(text.rlike(NUMERAL), text.try_cast(AMOUNT))


def standard_name(text: Column) -> Column:
    return F.upper(F.trim(text))


def line_subtotal(quantity: Column, price: Column) -> Column:
    return quantity * price


def line_total(quantity: Column, price: Column, tax: Column) -> Column:
    return quantity * price + tax


def is_bulk(quantity: Column) -> Column:
    return F.coalesce(quantity > 3, F.lit(False))


def day_name(day: Column, padded: bool = False) -> Column:
    """Full weekday name; ``padded`` fills it with blanks to nine characters."""
    name = F.date_format(day, "EEEE")
    return F.rpad(name, 9, " ") if padded else name


def month_name(day: Column, padded: bool = False) -> Column:
    name = F.date_format(day, "MMMM")
    return F.rpad(name, 9, " ") if padded else name
