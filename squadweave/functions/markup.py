"""Texts of named elements of an HTML page. The small helper inside the extraction job."""

from __future__ import annotations

from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser
from operator import attrgetter

# Elements that never hold others. Fixed values.
VOID = frozenset(
    "area base basefont bgsound br col command embed frame hr image img input isindex keygen link "
    "menuitem meta nextid param source spacer track wbr".split()
)
NO_TEXT = frozenset(("script", "style", "template"))


class Element:
    """An element with its place in page order; those within it have the places up to ``end``."""

    __slots__ = ("tag", "attrs", "children", "page", "at", "end")

    def __init__(self, tag: str, attrs: dict[str, str], page: dict[str, list["Element"]], at: int):
        self.tag, self.attrs, self.children = tag, attrs, []
        self.page, self.at, self.end = page, at, at


class _Tree(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.by_tag: dict[str, list[Element]] = {}
        self.count = 0
        self.open = [Element("", {}, self.by_tag, 0)]
        self.open_tags: Counter[str] = Counter()

    def updatepos(self, i, j):
        return j  # line numbers are not needed

    def handle_starttag(self, tag, attrs):
        self.count += 1
        element = Element(tag, {name: value or "" for name, value in attrs}, self.by_tag, self.count)
        self.open[-1].children.append(element)
        self.by_tag.setdefault(tag, []).append(element)
        if tag in VOID:
            element.end = self.count
        else:
            self.open.append(element)
            self.open_tags[tag] += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if not self.open_tags[tag]:
            return
        for depth in range(len(self.open) - 1, 0, -1):
            if self.open[depth].tag == tag:
                self.shut(depth)
                return

    def handle_data(self, data):
        self.open[-1].children.append(data)

    def shut(self, depth):
        for element in self.open[depth:]:
            element.end = self.count
            self.open_tags[element.tag] -= 1
        del self.open[depth:]


def parse(html: str) -> Element:
    tree = _Tree()
    tree.feed(html)
    tree.close()
    root = tree.open[0]
    tree.shut(0)
    return root


_place = attrgetter("at")


@dataclass(frozen=True)
class Select:
    """An element by tag and, if given, by an attribute value; for ``class`` by one of its words."""

    tag: str
    attr: str | None = None
    value: str = ""

    def fits(self, element: Element) -> bool:
        return self.fits_tag(element.tag, element.attrs)

    def fits_tag(self, tag: str, attrs: dict[str, str]) -> bool:
        if tag != self.tag:
            return False
        if self.attr is None:
            return True
        given = attrs.get(self.attr)
        if given is None:
            return False
        return given == self.value or (self.attr == "class" and self.value in given.split())

    def all_in(self, element: Element) -> Iterator[Element]:
        """Matches within an element, in page order."""
        same_tag = element.page.get(self.tag, ())
        for at in range(bisect_right(same_tag, element.at, key=_place), len(same_tag)):
            found = same_tag[at]
            if found.at > element.end:
                return
            if self.fits(found):
                yield found

    def first_in(self, element: Element) -> Element | None:
        return next(self.all_in(element), None)


@dataclass(frozen=True)
class Field:
    """Text at the end of a path of selects, each the first match within the one before.

    ``nth`` takes a later match of the first step. ``without`` leaves the first
    such element inside out. ``pieces`` trims every piece of text before they
    are joined; otherwise the joined text is trimmed.
    """

    path: tuple[Select, ...]
    nth: int = 0
    without: Select | None = None
    pieces: bool = False

    def text_in(self, card: Element) -> str | None:
        element = None
        for at, found in enumerate(self.path[0].all_in(card)):
            if at == self.nth:
                element = found
                break
        for step in self.path[1:]:
            element = step.first_in(element) if element is not None else None
        if element is None:
            return None
        skip = self.without.first_in(element) if self.without else None
        texts = _texts(element, skip)
        return "".join(text.strip() for text in texts) if self.pieces else "".join(texts).strip()


def _texts(element: Element, skip: Element | None) -> Iterator[str]:
    stack = list(reversed(element.children))
    while stack:
        child = stack.pop()
        if isinstance(child, str):
            yield child
        elif child is not skip and child.tag not in NO_TEXT:
            stack.extend(reversed(child.children))


@dataclass(frozen=True)
class Card:
    """A repeated element that holds one record.

    Of the cards with the same select, an element belongs to the first whose
    ``test`` it holds. Without a ``required`` element it gives no record.
    """

    kind: str
    select: Select
    fields: tuple[Field, ...]
    test: Select | None = None
    required: Select | None = None

    def takes(self, element: Element) -> bool:
        return self.test is None or self.test.first_in(element) is not None


@dataclass(frozen=True)
class Layout:
    """A page design: the marker that tells it, and its cards."""

    name: str
    marker: Select
    cards: tuple[Card, ...] = ()


class _Found(Exception):
    pass


class _Markers(HTMLParser):
    """The first layout, in the given order, whose marker occurs; no tree is built."""

    def __init__(self, layouts: tuple[Layout, ...]):
        super().__init__(convert_charrefs=False)
        self.left = list(layouts)
        self.found: Layout | None = None

    def updatepos(self, i, j):
        return j

    def handle_starttag(self, tag, attrs):
        for at, layout in enumerate(self.left):
            if tag == layout.marker.tag and layout.marker.fits_tag(tag, {name: value or "" for name, value in attrs}):
                self.found = layout
                del self.left[at:]
                if not self.left:
                    raise _Found
                return

    handle_startendtag = handle_starttag


def layout_of(html: str, layouts: tuple[Layout, ...]) -> Layout | None:
    markers = _Markers(layouts)
    try:
        markers.feed(html)
        markers.close()
    except _Found:
        pass
    return markers.found


def layout_in(page: Element, layouts: tuple[Layout, ...]) -> Layout | None:
    """The same for a page whose tree is there already."""
    return next((layout for layout in layouts if layout.marker.first_in(page) is not None), None)


def cards_of(page: Element, layout: Layout) -> list[dict]:
    """The records of a page, by card select and then in page order."""
    by_select: dict[Select, list[Card]] = {}
    for card in layout.cards:
        by_select.setdefault(card.select, []).append(card)
    records = []
    for select, cards in by_select.items():
        for element in select.all_in(page):
            card = next((c for c in cards if c.takes(element)), None)
            if card is None or (card.required and card.required.first_in(element) is None):
                continue
            records.append({"kind": card.kind, "fields": [field.text_in(element) for field in card.fields]})
    return records
