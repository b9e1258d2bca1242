"""Text, number and label expressions (Column in, Column out)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldbook.vocabulary import MENU, NOT_MENU

MONEY = "decimal(18,2)"
RATE = "decimal(18,6)"


def phone(number: Column) -> Column:
    """Last ten digits; a blank number is NULL so that blanks never match each other."""
    digits = F.regexp_replace(number, r"\D", "")
    return F.nullif(F.right(digits, F.lit(10)), F.lit(""))


def counterparty(direction: Column, from_no: Column, to_no: Column) -> Column:
    return phone(F.when(F.lower(direction) == "inbound", from_no).otherwise(to_no))


def chat_direction(from_id: Column, to_id: Column) -> Column:
    return F.when(from_id == to_id, "Inbound").otherwise("Outbound")


def number_class(number: Column, menu_lines: Sequence[str]) -> Column:
    known = phone(number).isin(list(menu_lines))
    return F.when(known, MENU).otherwise(NOT_MENU)


def non_blank(text: Column) -> Column:
    return F.trim(text) != ""


def money(text: Column) -> Column:
    return F.regexp_replace(text, "[, ]", "").try_cast(MONEY)


def percent(text: Column) -> Column:
    bare = F.regexp_replace(text, "[%, ]", "").try_cast(RATE)
    return (bare / F.lit(100)).cast(RATE)


def unreadable(text: Column, parsed: Column) -> Column:
    """Text that says something but could not be parsed."""
    return non_blank(text) & parsed.isNull()


def major_units(minor: Column) -> Column:
    return (minor.cast("decimal(18,0)") / F.lit(100)).cast(MONEY)


def joined_key(*parts: Column) -> Column:
    """NULL as soon as one part is NULL, so an incomplete key matches nothing."""
    return F.concat(*parts)


def city_label(*names: Column, missing: str, short: Mapping[str, str]) -> Column:
    """First known city name, shortened where ``short`` has a name for it."""
    name = F.coalesce(*names)
    return F.coalesce(relabel(name, short), F.lit(missing))


def relabel(value: Column, mapping: Mapping[str, str]) -> Column:
    """Replace the listed values, keep every other one."""
    return F.coalesce(pick(value, mapping), value)


def pick(value: Column, mapping: Mapping[str, str]) -> Column:
    """Value of the listed codes, NULL for an unlisted code."""
    result = F.lit(None).cast("string")
    for code, label in reversed(list(mapping.items())):
        result = F.when(value == F.lit(code), F.lit(label)).otherwise(result)
    return result


def format_inr(amount: Column) -> Column:
    """Lakh-style digit groups with two decimals, ``.00`` dropped; empty amounts show 0."""
    text = F.coalesce(amount.cast(MONEY), F.lit(0).cast(MONEY)).cast("string")
    whole = F.regexp_replace(
        F.substring_index(text, ".", 1), r"(?<=\d)(?=(\d\d)*\d{3}$)", ","
    )
    cents = F.substring_index(text, ".", -1)
    return F.when(cents == "00", whole).otherwise(F.concat(whole, F.lit("."), cents))


def stringify(*names: str) -> list[Column]:
    """Publish as text; a missing value stays NULL."""
    return [F.col(name).cast("string").alias(name) for name in names]
