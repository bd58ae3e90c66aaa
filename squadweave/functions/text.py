"""Text scalars: trimming, casing, names, numbers and places."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from squadweave.functions.fixed_values import NA_TOKENS, REGIONS

# Every character that counts as white space at the ends of a text.
WHITE_SPACE = "".join(chr(code) for code in range(0x3001) if chr(code).isspace())


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` applied to ``value``, which the plan then holds only once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(col: Column) -> Column:
    return F.trim(col, F.lit(WHITE_SPACE))


def strip_char(col: Column, char: str) -> Column:
    """Remove every ``char``, then trim."""
    return strip(F.replace(col, F.lit(char), F.lit("")))


def na_to_null(col: Column, tokens: tuple[str, ...] = NA_TOKENS) -> Column:
    return F.when(~col.isin(*tokens), col)


def null_or_invalid_to_na(col: Column, marker: str, na: str = "N/A") -> Column:
    """Null, and any text that holds ``marker``, becomes ``na``."""
    return F.when(col.isNull() | F.contains(col, F.lit(marker)), F.lit(na)).otherwise(col)


def first_token(col: Column) -> Column:
    """The text before the first space."""
    return F.substring_index(col, " ", 1)


def title_case(col: Column) -> Column:
    """Capital first letter in every run of letters, small letters elsewhere.

    Unlike ``initcap`` a run also starts after an apostrophe, a hyphen, a period or a digit.
    """
    runs = F.split(F.lower(col), r"(?<!\p{L})(?=\p{L})")
    return F.array_join(
        F.transform(runs, lambda run: F.concat(F.upper(F.substring(run, 1, 1)), F.substring(run, 2, 2**31 - 1))), ""
    )


def normalize_name(col: Column) -> Column:
    """Small letters without punctuation and with single spaces; null for a missing name."""
    words = F.regexp_replace(F.lower(col), r"(?U)[^\p{L}\p{N}_\s]", "")
    clean = strip(F.regexp_replace(words, r"(?U)\s+", " "))
    return F.when(F.upper(strip(col)) != "N/A", clean)


def sort_tokens(col: Column) -> Column:
    """The words of a text in sorted order, joined by single spaces."""
    words = F.filter(F.split(col, r"(?U)\s+"), lambda word: word != "")
    return F.array_join(F.array_sort(words), " ")


def safe_int(col: Column) -> Column:
    """Whole number of a text such as ``74`` or ``74.0``; null where there is none."""
    return col.try_cast("double").try_cast("int")


def height_inches(col: Column) -> Column:
    """Inches of a height such as ``6'2"``; null where feet or inches are not whole numbers."""
    parts = F.split(col, "'")
    feet = strip(F.get(parts, F.lit(0)))
    inches = strip_char(F.get(parts, F.lit(1)), '"')
    whole = r"^[+-]?\d+$"
    return F.when(
        feet.rlike(whole) & inches.rlike(whole),
        feet.try_cast("int") * 12 + inches.try_cast("int"),
    )


def standardize_place(col: Column, regions: dict[str, str] = REGIONS, unknown: str = "Unknown") -> Column:
    """``city, region`` with a title-cased city and a region code.

    The region is the part after the last comma, looked up as written, then
    title-cased, and kept as written if neither is known. A text without comma
    is title-cased; null becomes ``unknown``.
    """
    codes = F.create_map(*[F.lit(text) for entry in regions.items() for text in entry])

    def place(parts: Column) -> Column:
        region = strip(F.element_at(parts, -1))
        code = F.coalesce(F.try_element_at(codes, region), F.try_element_at(codes, title_case(region)), region)
        return F.when(
            F.size(parts) > 1, F.concat(title_case(strip(F.element_at(parts, 1))), F.lit(", "), code)
        ).otherwise(title_case(F.element_at(parts, 1)))

    return F.coalesce(let(F.split(strip(col), ","), place), F.lit(unknown))
