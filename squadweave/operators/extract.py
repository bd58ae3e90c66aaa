"""Records from raw HTML page tables.

One Arrow-batched job turns each page into an array of cards with raw field
texts. A page stays one row until the error policy is settled, so neither
extraction nor page-wide rejection needs a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from squadweave.functions.codes import positional_fields
from squadweave.functions.fixed_values import MISSING
from squadweave.functions.markup import Card, Field, Layout, Select, cards_of, layout_in, layout_of, parse
from squadweave.functions.text import first_token, height_inches

PARSED = "layout string, cards array<struct<kind string, fields array<string>>>, problem string"

# ---- The two roster page designs. Tags, classes and attributes are fixed values. ----

_SCREEN_READER = Select("span", "class", "sr-only")
_BIO_ITEM = Select("span", "class", "s-person-details__bio-stats-item")


def _location(value: str) -> Field:
    place = Select("span", "data-test-id", f"s-person-card-list__content-location-person-{value}")
    return Field((place,), without=_SCREEN_READER)


def _classic(tag: str, css_class: str | None = None) -> Field:
    return Field((Select(tag, "class", css_class) if css_class else Select(tag),), pieces=True)


PLAYER_FIELDS = (
    "name", "jersey", "position", "class_year", "height", "weight", "bt", "high_school", "hometown",
)
COACH_FIELDS = ("name", "title")

_MODERN_CARD = Select("div", "class", "s-person-card__content")
MODERN = Layout(
    "modern",
    _MODERN_CARD,
    (
        Card(
            "player",
            _MODERN_CARD,
            (
                Field((Select("h3"),)),
                Field(
                    (Select("div", "data-test-id", "s-stamp__root"), Select("span", "class", "s-stamp__text")),
                    without=_SCREEN_READER,
                ),
                *[Field((_BIO_ITEM,), nth=at, without=_SCREEN_READER) for at in range(4)],
                Field((_BIO_ITEM, Select("span", "data-html-wrapper", "")), nth=4),
                _location("high-school"),
                _location("hometown"),
            ),
            test=Select("div", "class", "s-person-details__bio-stats"),
            required=Select("h3"),
        ),
        Card(
            "coach",
            _MODERN_CARD,
            (Field((Select("h3"),)), Field((Select("div", "class", "s-person-details__position"), Select("div")))),
            required=Select("h3"),
        ),
    ),
)

_CLASSIC_PLAYER = Select("li", "class", "sidearm-roster-player")
CLASSIC = Layout(
    "classic",
    _CLASSIC_PLAYER,
    (
        Card(
            "player",
            _CLASSIC_PLAYER,
            (
                _classic("h3"),
                _classic("span", "sidearm-roster-player-jersey-number"),
                _classic("span", "sidearm-roster-player-position-long-short"),
                _classic("span", "sidearm-roster-player-academic-year"),
                _classic("span", "sidearm-roster-player-height"),
                _classic("span", "sidearm-roster-player-weight"),
                _classic("span", "sidearm-roster-player-bats-throws"),
                _classic("span", "sidearm-roster-player-highschool"),
                _classic("span", "sidearm-roster-player-hometown"),
            ),
        ),
        Card(
            "coach",
            Select("li", "class", "sidearm-roster-coach"),
            (_classic("p"), _classic("div", "sidearm-roster-coach-title")),
        ),
    ),
)
ROSTER_LAYOUTS = (MODERN, CLASSIC)


# ---- Operators ----


def parse_pages(pages: DataFrame, layouts: tuple[Layout, ...], html: str = "html") -> DataFrame:
    """``pages`` with ``layout``, ``cards`` and ``problem`` in place of the markup.

    A page of no known layout has a null layout and no cards. A page that
    cannot be parsed has neither, and its problem says why; all others go on.
    Only pages that hold the text of some marker cross into Python.
    """

    with_cards = any(layout.cards for layout in layouts)

    @F.arrow_udf(PARSED)
    def parsed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield as_structs([read_page(text) for text in texts.to_pylist()])

    def ends(lists: list[list]) -> pa.Array:
        return pa.array(accumulate(map(len, lists), initial=0), pa.int32())

    def as_structs(found: list[tuple[str | None, list[dict], str | None]]) -> pa.Array:
        layout, pages, problem = zip(*found, strict=True) if found else ((), (), ())
        empty = pa.array([cards is None for cards in pages], pa.bool_())
        pages = [cards or [] for cards in pages]
        cards = list(chain.from_iterable(pages))
        fields = [card["fields"] for card in cards]
        texts = pa.ListArray.from_arrays(ends(fields), pa.array(chain.from_iterable(fields), pa.string()))
        kinds = pa.array([card["kind"] for card in cards], pa.string())
        structs = pa.StructArray.from_arrays([kinds, texts], ["kind", "fields"])
        lists = pa.ListArray.from_arrays(ends(pages), structs, mask=empty)
        return pa.StructArray.from_arrays(
            [pa.array(layout, pa.string()), lists, pa.array(problem, pa.string())], ["layout", "cards", "problem"]
        )

    def read_page(text: str) -> tuple[str | None, list[dict], str | None]:
        try:
            page = parse(text) if with_cards else None
            layout = layout_in(page, layouts) if with_cards else layout_of(text, layouts)
            return layout.name if layout else None, cards_of(page, layout) if layout and with_cards else [], None
        except Exception as problem:  # the markup is anyone's, and one page must not end the job
            return None, [], f"page cannot be parsed: {type(problem).__name__}: {problem}"

    # Said to be non-deterministic, the parse is not repeated for a filter on its result.
    parsed = parsed.asNondeterministic()
    found = pages.withColumn("_parsed", parsed(F.when(_may_match(F.col(html), layouts), F.col(html)).otherwise("")))
    return found.select(
        *[F.col(name) for name in pages.columns if name != html],
        *[F.col(f"_parsed.{name}").alias(name) for name in ("layout", "cards", "problem")],
    )


def _may_match(html: Column, layouts: tuple[Layout, ...]) -> Column:
    """False only for markup that cannot hold a marker: neither its text nor a character reference."""
    lower = F.lower(html)
    may = F.contains(html, F.lit("&"))
    for layout in layouts:
        marker = layout.marker
        may = may | (F.contains(html, F.lit(marker.value)) if marker.value else F.contains(lower, F.lit("<" + marker.tag)))
    return F.coalesce(may, F.lit(False))


def detect_layout(pages: DataFrame, layouts: tuple[Layout, ...] = ROSTER_LAYOUTS, html: str = "html") -> DataFrame:
    """The first layout whose marker a page holds, ``unknown`` if there is none."""
    markers_only = tuple(Layout(layout.name, layout.marker) for layout in layouts)
    return parse_pages(pages, markers_only, html).withColumn(
        "layout", F.coalesce("layout", F.lit("unknown"))
    ).drop("cards", "problem")


def extract_cards(pages: DataFrame, layouts: tuple[Layout, ...], html: str = "html") -> DataFrame:
    """One row per card: the page columns, ``layout``, ``card_no``, ``kind`` and the field texts."""
    return _explode_cards(parse_pages(pages, layouts, html).drop("problem"))


def _explode_cards(parsed: DataFrame) -> DataFrame:
    cards = parsed.select(
        *[name for name in parsed.columns if name != "cards"], F.posexplode("cards").alias("card_no", "card")
    )
    return cards.select("*", "card.kind", "card.fields").drop("card")


def roster_cards(pages: DataFrame) -> DataFrame:
    """All cards of roster pages with an ``error`` where a record must be rejected.

    A player without a readable height is an error, but on a modern page a
    missing height is not. One error on a modern page rejects the whole page,
    on a classic page only its own card. A page that cannot be parsed is one
    rejected row without kind and fields.
    """
    parsed = parse_pages(pages, ROSTER_LAYOUTS)
    modern = F.col("layout") == MODERN.name
    height = lambda card: F.get(card["fields"], F.lit(PLAYER_FIELDS.index("height")))
    bad = lambda card: (
        (card["kind"] == "player")
        & F.when(height(card).isNull(), ~modern).otherwise(height_inches(height(card)).isNull())
    )
    page_error = F.when(modern & F.exists("cards", bad), F.lit("page holds a card with an unreadable height"))
    no_card = F.array(F.lit(None).cast("struct<kind:string,fields:array<string>>"))
    parsed = parsed.withColumn("page_error", F.coalesce("problem", page_error)).withColumn(
        "cards", F.when(F.col("problem").isNotNull(), no_card).otherwise(F.col("cards"))
    )
    cards = _explode_cards(parsed.drop("problem"))
    card_error = F.when(bad(F.struct("kind", "fields")), F.lit("unreadable height"))
    return cards.withColumn("error", F.coalesce("page_error", card_error)).drop("page_error")


def roster_players(cards: DataFrame) -> DataFrame:
    """Raw player records of the cards that were not rejected."""
    kept = cards.filter((F.col("kind") == "player") & F.col("error").isNull())
    records = kept.select(
        *[F.col(name) for name in cards.columns if name not in ("kind", "fields", "error")],
        *positional_fields(F.col("fields"), list(PLAYER_FIELDS), MISSING),
    )
    return records.withColumn(
        "height", F.coalesce(height_inches(F.col("height")).cast("string"), F.lit(MISSING))
    ).withColumn("weight", first_token(F.col("weight")))


def roster_coaches(cards: DataFrame, word: str = "coach") -> DataFrame:
    """Raw coach records of the cards that were not rejected; only titles that hold ``word``."""
    kept = cards.filter((F.col("kind") == "coach") & F.col("error").isNull())
    records = kept.select(
        *[F.col(name) for name in cards.columns if name not in ("kind", "fields", "error")],
        *positional_fields(F.col("fields"), list(COACH_FIELDS), MISSING),
    )
    return filter_contains(records, "title", word)


def rejected_cards(cards: DataFrame) -> DataFrame:
    """The quarantine table: every card that was rejected, with the reason."""
    return cards.filter(F.col("error").isNotNull())


def route_records(df: DataFrame, test: Column, yes: str = "player", no: str = "coach") -> DataFrame:
    """Every record with the kind that ``test`` decides."""
    return df.withColumn("kind", F.when(test, yes).otherwise(no))


def filter_contains(df: DataFrame, column: str, word: str) -> DataFrame:
    """Rows whose text holds ``word`` in any case."""
    return df.filter(F.contains(F.lower(column), F.lit(word.lower())))


def keep(df: DataFrame, *predicates: Column) -> DataFrame:
    """Rows that meet every predicate."""
    for predicate in predicates:
        df = df.filter(predicate)
    return df


def quarantine(df: DataFrame, error: Column, scope: str = "record", page: list[str] | None = None):
    """Rows that stay and rows that are rejected.

    With ``scope='page'`` one bad row rejects all rows with the same ``page``
    columns. The failed pages are few columns wide and distinct before the
    join, so a page with very many rows costs no more than its own scan.
    """
    bad = F.coalesce(error, F.lit(False))
    if scope == "record":
        return df.filter(~bad), df.filter(bad)
    failed = df.filter(bad).select(*page).distinct()
    return df.join(failed, page, "left_anti"), df.join(failed, page, "left_semi")
