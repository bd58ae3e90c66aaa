"""Main text of web pages by a tree-structured graphical model over the DOM.

Every element is a binary variable: content or not. Potentials of single
elements come from their tag, names and text, those of parent and child from
both tags' kinds; they are learned by counting on labelled pages. Sum-product
messages go up the tree and down again, which gives each element's exact
marginal, and the text that stands in elements more likely content than not is
the page's main text.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import cache
from html import unescape
from math import exp, log, log1p

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from squadweave.llm.common import broadcast_state, with_state

# Whole pages and fragments have one root: these tags are it, present or not.
ROOT = frozenset(["html", "body"])
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed template svg".split())
INLINE = frozenset(
    "a abbr b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup"
    " time tt u var wbr".split()
)
# An element of the key is closed by the start of an element of the value, at most up to the nearest scope.
_BLOCKS = frozenset(
    "address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol"
    " p pre section table ul".split()
)
CLOSED_BY = {
    "p": _BLOCKS | {"li", "dd", "dt", "td", "th", "tr"},
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "td": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
    "th": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
    "tr": frozenset(["tr", "tbody", "tfoot"]),
    "option": frozenset(["option", "optgroup"]),
}
SCOPE = frozenset("ul ol dl table select body html".split())

# A quote opens a value only after the equals sign of an attribute; one that nothing closes is part of a bare value.
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)"
    r"(?P<rest>(?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>]*+))?+)*+)>?",
    re.DOTALL,
)
NAMES = re.compile(r"""(?:^|[\s"'/])(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
HIDDEN = re.compile(r"""(?:^|\s)(?:hidden(?=[\s=/]|$)|aria-hidden\s*=\s*["']?true)|display\s*:\s*none""", re.IGNORECASE)
SPLIT_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")


class Element:
    __slots__ = ("tag", "names", "parent", "depth", "words", "linked", "own", "label")

    def __init__(self, tag: str, names: frozenset[str], parent: int, depth: int):
        self.tag, self.names, self.parent, self.depth = tag, names, parent, depth
        # Words inside, words inside links, words of its own text.
        self.words = self.linked = self.own = 0
        self.label: int | None = None


def name_tokens(rest: str) -> frozenset[str]:
    """The words that class, id, role and itemprop are made of."""
    found = set()
    if "=" in rest:
        for match in NAMES.finditer(rest):
            found.update(x.lower() for x in SPLIT_NAME.findall(match[2] or match[3] or match[4] or ""))
    if rest and HIDDEN.search(rest):
        found.add("hidden")
    return frozenset(found)


def parse(html: str) -> tuple[list[Element], list[tuple[int, str]]]:
    """The elements, parents before children, and the pieces of text in page order as (element, text).

    A piece that is a lone blank stands for the edge of a block. Scripts, styles
    and the like keep no text. Stray end tags are dropped, open elements end with
    their parent; any input gives a tree.
    """
    elements = [Element("html", frozenset(), -1, 0)]
    pieces: list[tuple[int, str]] = []
    stack, opened = [0], Counter(["html"])
    at, size = 0, len(html)

    def close(upto: int) -> None:
        while len(stack) > upto:
            opened[elements[stack.pop()].tag] -= 1

    while at < size:
        match = TOKEN.search(html, at)
        if match is None:
            pieces.append((stack[-1], unescape(html[at:])))
            break
        if match.start() > at:
            pieces.append((stack[-1], unescape(html[at : match.start()])))
        at = match.end()
        tag = match["tag"]
        if tag is None:
            if match[0].startswith("<![CDATA["):
                pieces.append((stack[-1], match[0][9:].removesuffix("]]>")))
            continue
        tag = tag.lower()
        if match["end"]:
            if opened[tag] and tag not in ROOT:
                upto = len(stack) - 1
                while elements[stack[upto]].tag != tag:
                    upto -= 1
                close(upto)
            if tag not in INLINE:
                pieces.append((stack[-1], " "))
            continue
        for inner, by in CLOSED_BY.items():
            if opened[inner] and tag in by:
                upto = len(stack) - 1
                while upto > 0 and elements[stack[upto]].tag != inner and elements[stack[upto]].tag not in SCOPE:
                    upto -= 1
                if elements[stack[upto]].tag == inner:
                    close(upto)
        if tag not in INLINE:
            pieces.append((stack[-1], " "))
        if tag in VOID or tag in ROOT:
            continue
        rest = match["rest"]
        if tag in RAW:
            if not rest.endswith("/") or tag != "svg":
                stop = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.IGNORECASE).search(html, at)
                at = stop.end() if stop else size
            continue
        parent = stack[-1]
        elements.append(Element(tag, name_tokens(rest), parent, elements[parent].depth + 1))
        if not rest.endswith("/") or tag not in ("path", "circle", "rect", "use"):
            stack.append(len(elements) - 1)
            opened[tag] += 1
    count_words(elements, pieces)
    return elements, pieces


def count_words(elements: list[Element], pieces: list[tuple[int, str]]) -> None:
    for of, text in pieces:
        if not text.isspace():
            elements[of].own += len(text.split())
    for element in reversed(elements):
        element.words += element.own
        if element.tag == "a":
            element.linked = element.words
        if element.parent >= 0:
            above = elements[element.parent]
            above.words += element.words
            above.linked += element.linked


def kind(element: Element) -> str:
    """The coarse kind that parent-child potentials rest on."""
    if element.tag in INLINE:
        return "inline"
    return element.tag if element.tag in KINDS else "block"


KINDS = frozenset("html body div section article main p nav ul ol li header footer aside form h1 h2 h3 table".split())


def features(element: Element) -> list[str]:
    """What one element shows of itself: its tag, the words of its names, and how much of its text is links."""
    found = [f"tag {element.tag}", *(f"name {word}" for word in element.names)]
    if element.words:
        found.append(f"links {int(3.99 * element.linked / element.words)}")
    return found


class Model:
    """Log potentials of elements and of parent and child."""

    def __init__(self) -> None:
        self.single: dict[str, float] = {}
        self.pair: dict[str, list[float]] = {}
        self.default = [0.0] * 4

    def learn(self, pages: list[list[Element]], epochs: int = 12, rate: float = 0.3) -> Model:
        """Count labelled elements for a start, then raise the pages' likelihood page by page.

        The slope of a potential is how often it is seen minus how often the
        messages expect it; steps shrink with the slopes met so far.
        """
        seen: dict[str, list[float]] = {}
        pairs: dict[str, list[float]] = {}
        totals = [0.5, 0.5]
        every = [0.5] * 4
        for elements in pages:
            for element in elements:
                totals[element.label] += 1
                for feature in features(element):
                    seen.setdefault(feature, [0.5, 0.5])[element.label] += 1
                if element.parent >= 0:
                    above = elements[element.parent]
                    where = 2 * above.label + element.label
                    pairs.setdefault(f"{kind(above)} {kind(element)}", [0.5] * 4)[where] += 1
                    every[where] += 1
        prior = log(totals[1] / totals[0])
        self.single = {feature: log(up / down) - prior for feature, (down, up) in seen.items()}

        def logs(n):
            return [*(log(x / (n[0] + n[1])) for x in n[:2]), *(log(x / (n[2] + n[3])) for x in n[2:])]

        self.default = logs(every)
        self.pair = {pair: logs(n) for pair, n in pairs.items()}
        met_single = dict.fromkeys(self.single, 1.0)
        met_pair = {pair: [1.0] * 4 for pair in self.pair}
        for _ in range(epochs):
            for elements in pages:
                likely, joint = self.beliefs(elements)
                slopes: dict[str, float] = {}
                pair_slopes: dict[str, list[float]] = {}
                for k, element in enumerate(elements):
                    for feature in features(element):
                        slopes[feature] = slopes.get(feature, 0.0) + element.label - likely[k]
                    if k:
                        above = elements[element.parent]
                        slope = pair_slopes.setdefault(f"{kind(above)} {kind(element)}", [0.0] * 4)
                        slope[2 * above.label + element.label] += 1
                        for where in range(4):
                            slope[where] -= joint[k][where]
                for feature, slope in slopes.items():
                    met_single[feature] += slope * slope
                    self.single[feature] += rate * slope / met_single[feature] ** 0.5
                for pair, four in pair_slopes.items():
                    for where, slope in enumerate(four):
                        met_pair[pair][where] += slope * slope
                        self.pair[pair][where] += rate * slope / met_pair[pair][where] ** 0.5
        return self

    def beliefs(self, elements: list[Element]) -> tuple[list[float], list[list[float]]]:
        """Each element's probability of being content, and each one's joint with its parent (00, 01, 10, 11).

        Messages go from the leaves to the root, and back.
        """
        n = len(elements)
        inside = [[0.0, sum(self.single.get(x, 0.0) for x in features(element))] for element in elements]
        kinds = [kind(element) for element in elements]
        pairs = [self.pair.get(f"{kinds[x.parent]} {kinds[k]}", self.default) for k, x in enumerate(elements)]
        up: list[tuple[float, float]] = [(0.0, 0.0)] * n
        for k in range(n - 1, 0, -1):
            p, (a, b) = pairs[k], inside[k]
            up[k] = (both(p[0] + a, p[1] + b), both(p[2] + a, p[3] + b))
            above = inside[elements[k].parent]
            above[0] += up[k][0]
            above[1] += up[k][1]
        down = [(0.0, 0.0)] * n
        likely, joint = [0.5] * n, [[1.0, 0.0, 0.0, 0.0]] * n
        for k in range(n):
            if k:
                above = elements[k].parent
                p, rest = pairs[k], [inside[above][y] + down[above][y] - up[k][y] for y in (0, 1)]
                down[k] = (both(rest[0] + p[0], rest[1] + p[2]), both(rest[0] + p[1], rest[1] + p[3]))
                four = [rest[0] + p[0] + inside[k][0], rest[0] + p[1] + inside[k][1]]
                four += [rest[1] + p[2] + inside[k][0], rest[1] + p[3] + inside[k][1]]
                most = max(four)
                four = [exp(x - most) for x in four]
                joint[k] = [x / sum(four) for x in four]
            low, high = inside[k][0] + down[k][0], inside[k][1] + down[k][1]
            likely[k] = 1 / (1 + exp(min(700.0, low - high)))
        return likely, joint

    def marginals(self, elements: list[Element]) -> list[float]:
        return self.beliefs(elements)[0]

    def text(self, html: str) -> str:
        """The page's main text: blocks in page order, joined by one blank."""
        elements, pieces = parse(html)
        # A page without any element is nothing but its text.
        likely = self.marginals(elements) if len(elements) > 1 else [1.0]
        chosen = [text if likely[of] > 0.5 or text == " " else "" for of, text in pieces]
        return " ".join("".join(chosen).split())


def both(a: float, b: float) -> float:
    """log(exp(a) + exp(b))."""
    return a + log1p(exp(b - a)) if a >= b else b + log1p(exp(a - b))


LABEL = re.compile(r"\bdata-main=\"?([01])")


def labelled(html: str) -> list[Element]:
    """The elements of a page whose tags bear ``data-main=1`` or ``=0``; the others are labelled as their parent, the root 0 by default."""
    labels: list[int | None] = []
    for match in TOKEN.finditer(re.sub(r"<(script|style|title|noscript|textarea)\b.*?</\1>", "", html, flags=re.S)):
        tag = (match["tag"] or "").lower()
        if tag and not match["end"] and tag not in VOID and tag not in RAW and tag not in ROOT:
            label = LABEL.search(match["rest"])
            labels.append(int(label[1]) if label else None)
    elements, _ = parse(html)
    elements[0].label = int(html.startswith("<html data-main=1>"))
    for element, label in zip(elements[1:], labels):
        element.label = label if label is not None else elements[element.parent].label or 0
    return elements


# Names that pages give to what is and what is not their main text.
MAIN_NAMES = "article content main post entry story body text".split()
REST_NAMES = (
    "ad ads advert advertisement sponsor promo banner sidebar widget related comment comments reply discussion notice cookie consent"
    " popup modal newsletter subscribe share social menu nav navbar breadcrumb pagination header footer copyright masthead toolbar"
    " login search signup tags meta byline hidden alert recent popular"
).split()
_SENTENCE = "One two three four five six seven eight nine ten eleven twelve thirteen. "


def training_pages() -> list[str]:
    """Labelled pages: main texts of several shapes in wrappers of several kinds, among what commonly surrounds them."""
    menu = '<ul><li><a href="/a">Home</a></li><li><a href="/b">About us</a></li><li><a href="/c">News</a></li></ul>'
    shapes = [
        "<h1>A heading</h1>{0}",
        "<h1>A heading</h1><p><b>{1}<br>{1}</b></p>{0}<h2>Part</h2><p>Short <a href=x>link</a> text.</p>",
        "<header><h1>A heading</h1></header>{0}<ul><li>One point made</li><li>{1}</li></ul>",
        "<h1>A heading</h1><section><h2>Part</h2>{0}</section><blockquote><p>{1}</p></blockquote>",
        "<h2>A heading</h2><div>{1}</div><table><tr><td>Cell one</td><td>Cell two</td></tr></table>{0}",
        "<h1>A heading</h1><p>{1}<em>some</em> <span>words</span> <code>code</code></p><pre>line one</pre>{0}",
        "<p>{1}</p>",
        "{0}{0}<figure><figcaption>A caption</figcaption></figure><dl><dt>Term</dt><dd>{1}</dd></dl>",
    ]
    wrappers = [("article", ""), ("main", ""), ("div", ""), *(("div", f' class="{name}"') for name in MAIN_NAMES), ("article", ' class="post"')]
    boxes = [
        "<div data-main=0 class={n}>{t}</div>",
        "<div data-main=0 class={n}><p>{t}</p><p>{t}</p></div>",
        "<section data-main=0 id={n}><h2>Title</h2><ul><li><p>{t}</p></li><li>{t}</li></ul></section>",
        "<div data-main=0 class={n}><h3>Title</h3><div class={n}><b>Name</b><p>{t}</p></div><a href=/>Go</a></div>",
        "<aside data-main=0 class={n}><h3>More</h3>{m}<p>{t}</p></aside>",
        "<form data-main=0 class={n}><label>{t}</label><input><select><option>One<option>Two</select><button>Send</button></form>",
        "<p data-main=0 class={n}>{t}</p>",
        "<section data-main=0 class={n}><h4>Title</h4><article class={n}><p>{t}</p></article><article><p>{t}</p></article></section>",
        "<ul data-main=0 class={n}><li><a href=/>One</a></li><li>{t}</li></ul>",
        "<aside data-main=0>{t}</aside>",
        "<form data-main=0><p>{t}</p><label>Mail</label><input></form>",
    ]

    def some(k: int) -> str:
        return (_SENTENCE * (1, 3, 1, 8)[k % 4])[: (25, 400, 60, 900)[k % 4]]

    def box(k: int) -> str:
        return boxes[k % len(boxes)].format(n=REST_NAMES[k % len(REST_NAMES)], t=some(k // 3), m=menu)

    pages = []
    for k in range(8 * len(REST_NAMES)):
        tag, names = wrappers[k % len(wrappers)]
        prose = "".join(f"<p>{some(k + j)}</p>" for j in range(1 + k % 5))
        main = shapes[k // 3 % len(shapes)].format(prose, some(k))
        inner = "".join(box(7 * k + j) for j in range(k % 3))
        name = ("<a href=/>Name</a>", "<h1>Name of site</h1>", "<h1><a href=/>Name</a></h1>")[k // 3 % 3]
        header = f"<header data-main=0>{name}<p>{some(k)}</p></header>" if k % 3 else ""
        footer = f"<footer data-main=0>Copyright <a href=/>Name</a> {some(k + 1)}</footer>" if k % 5 else ""
        above = "".join(box(11 * k + 5 * j) for j in range(k % 4))
        below = "".join(box(13 * k + 3 * j + 1) for j in range((k + 2) % 4))
        whole = f"<{tag}{names} data-main=1>{main}{inner}</{tag}>"
        if k % 7 == 0:
            whole = f"<div data-main=0 class=wrapper>{whole}{box(k)}</div>"
        if k % 16 == 5:
            pages.append(f"<html data-main=1><body>{main}{footer}</body></html>")
            continue
        pages.append(f"<html><body>{header}<nav data-main=0>{menu}</nav>{above}{whole}{below}{footer}</body></html>")
    return pages


@cache
def default_model() -> Model:
    return train(training_pages())


def train(pages: list[str]) -> Model:
    """The model of labelled pages, as ``labelled`` reads them."""
    return Model().learn([labelled(html) for html in pages])


def extract(
    pages: DataFrame,
    model: Model | None = None,
    html_col: str = "html",
    keep: tuple[str, ...] = ("page_id", "url"),
) -> DataFrame:
    """``keep`` columns and ``text``, the main text of every page, empty where there is none.

    Null is an empty page. Any text is a page: what cannot be understood as
    markup is text, so no page fails. Repeated rows and nulls in ``keep`` pass
    through; other columns are not read. Pages are independent, nothing is shuffled.
    """
    shared = broadcast_state(pages.sparkSession, model or default_model())

    def run(batches):
        model = with_state(Model, shared)
        for batch in batches:
            texts = [model.text(html.as_py() or "") for html in batch.column(batch.num_columns - 1)]
            columns = [batch.column(k) for k in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], [*keep, "text"])

    wanted = pages.select(*keep, F.col(html_col).cast("string").alias("_html"))
    schema = ", ".join(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in keep)
    return wanted.mapInArrow(run, f"{schema}, text string")
