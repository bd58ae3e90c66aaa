"""Roles from free-text staff titles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from squadweave.functions.fixed_values import DEFAULT_ROLE, ROLE_KEYWORDS
from squadweave.functions.text import let, strip

# A role in the list -> the roles it makes redundant, strongest first. A role
# that was itself removed removes nothing.
PRECEDENCE = (
    ("Head Coach", ("Associate Head Coach", "Assistant Coach")),
    ("Associate Head Coach", ("Assistant Coach",)),
    ("Assistant Coach", ("Student Assistant Coach",)),
)

# Bare word -> (full role, what happens to the bare word when the full role is there too).
BARE_WORDS = (
    ("Pitching", "Pitching Coach", "drop"),
    ("Hitting", "Hitting Coach", "drop"),
    ("Outfield", "Outfield Coach", "repeat"),
    ("Infield", "Infield Coach", "keep"),
    ("Strength", "Strength & Conditioning Coach", "drop"),
)


def clean_roles(roles: Column, bare_words: bool = True) -> Column:
    """Drop the roles that a stronger one implies; then spell bare words out.

    ``bare_words=False`` skips the second step, which no role that comes from
    the keyword list can reach.
    """
    for strong, weak in PRECEDENCE:
        roles = let(roles, _removing(strong, weak))
    if not bare_words:
        return roles
    for bare, full, when_both in BARE_WORDS:
        roles = let(roles, _spelling_out(bare, full, when_both))
    return F.array_remove(let(roles, _removing("Strength & Conditioning Coach", ("Conditioning",))), "Recruiting")


def _removing(strong: str, weak: tuple[str, ...]) -> Callable[[Column], Column]:
    return lambda roles: F.when(
        F.array_contains(roles, strong), F.filter(roles, lambda role: ~role.isin(*weak))
    ).otherwise(roles)


def _spelling_out(bare: str, full: str, when_both: str) -> Callable[[Column], Column]:
    def spelled(roles: Column) -> Column:
        rest = F.array_remove(roles, bare)
        appended = F.array_append(rest, F.lit(full))
        both = {"drop": rest, "keep": roles, "repeat": appended}[when_both]
        return (
            F.when(~F.array_contains(roles, bare), roles)
            .when(F.array_contains(roles, full), both)
            .otherwise(appended)
        )

    return spelled


def extract_roles(
    title: Column,
    keywords: tuple[tuple[str, str], ...] = ROLE_KEYWORDS,
    default: str = DEFAULT_ROLE,
    longest_match: bool = False,
) -> Column:
    """Roles named in a title, without repeats and after ``clean_roles``.

    ``&`` and ``/`` part a title. Within a part a keyword counts wherever it
    occurs, also inside a longer one ("associate head coach" holds "head
    coach"). With ``longest_match`` a keyword that lies within another one
    found in the same part does not count.
    """
    text = F.replace(F.lower(strip(title)), F.lit("&"), F.lit("/"))
    text = F.regexp_replace(F.regexp_replace(text, r"[(),]", " "), r"(?U)\s+", " ")
    parts = F.filter(F.transform(F.split(text, "/"), strip), lambda part: part != "")
    known = F.array(*[F.struct(F.lit(k).alias("keyword"), F.lit(role).alias("role")) for k, role in keywords])

    def hits(part: Column) -> Column:
        found = F.filter(known, lambda k: F.contains(part, k["keyword"]))
        if longest_match:
            found = let(
                found,
                lambda all_found: F.filter(
                    all_found,
                    lambda k: ~F.exists(
                        all_found,
                        lambda other: F.contains(other["keyword"], k["keyword"]) & (other["keyword"] != k["keyword"]),
                    ),
                ),
            )
        return F.transform(found, lambda k: k["role"])

    named = F.array_distinct(F.flatten(F.transform(parts, hits)))
    roles = let(named, lambda r: F.when(F.size(r) > 0, r).otherwise(F.array(F.lit(default))))
    return F.when(title.isNotNull(), clean_roles(roles, bare_words=False))
