"""Code lookups and code lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from squadweave.functions.fixed_values import POSITIONS, SIDES
from squadweave.functions.text import null_or_invalid_to_na, strip


def literal_map(mapping: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(text) for entry in mapping.items() for text in entry])


def map_codes(col: Column, mapping: dict[str, str], miss: str = "keep", trim: bool = True) -> Column:
    """The value of a code. An unknown code is kept as it is, or null with ``miss='null'``."""
    value = F.try_element_at(literal_map(mapping), strip(col) if trim else col)
    return F.coalesce(value, col) if miss == "keep" else value


def split_codes(
    col: Column,
    mapping: dict[str, str] = POSITIONS,
    delimiters: str = "/,|",
    unmapped: str = "drop",
    trim: bool = True,
) -> Column:
    """Values of a delimited code list, in order and with repeats; empty for null.

    Empty parts never count. Unknown codes are dropped, or null with ``unmapped='null'``.
    """
    values = literal_map(mapping)
    parts = F.split(col, "[" + "".join("\\" + char for char in delimiters) + "]")
    if trim:
        parts = F.transform(parts, strip)
    found = F.transform(F.filter(parts, lambda part: part != ""), lambda part: F.try_element_at(values, part))
    if unmapped == "drop":
        found = F.array_compact(found)
    return F.coalesce(found, F.array().cast("array<string>"))


def widen(array: Column, width: int, prefix: str = "position") -> list[Column]:
    """The first ``width`` elements as columns ``prefix1`` onwards, null where the array ends."""
    return [F.get(array, F.lit(at)).alias(f"{prefix}{at + 1}") for at in range(width)]


def longest(df: DataFrame, array: str) -> int:
    """Length of the longest array of a column."""
    return df.agg(F.max(F.size(array))).first()[0] or 0


def compact(*columns: Column) -> Column:
    """One array of the columns that are neither null nor empty."""
    return F.filter(F.array(*columns), lambda value: value.isNotNull() & (value != ""))


def split_pair(col: Column, mapping: dict[str, str] = SIDES, invalid: str = "Year") -> tuple[Column, Column]:
    """First and second value of a code pair such as ``R/L`` or ``r-l``; null for an unknown code.

    An empty first part moves the second into its place. A text that holds
    ``invalid`` is not a pair.
    """
    text = F.replace(F.upper(strip(null_or_invalid_to_na(col, invalid))), F.lit("-"), F.lit("/"))
    values = literal_map(mapping)
    first, second = (F.regexp_extract(text, pattern, 1) for pattern in ("([^/]+)", "[^/]/+([^/]+)"))
    return F.try_element_at(values, first), F.try_element_at(values, second)


def positional_fields(items: Column, names: list[str], default: str) -> list[Column]:
    """The items of an array as named columns, ``default`` where an item is missing."""
    return [F.coalesce(F.get(items, F.lit(at)), F.lit(default)).alias(name) for at, name in enumerate(names)]
