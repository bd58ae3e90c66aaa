import random
import re
import time
from html import unescape
from itertools import product
from math import exp

import pyarrow.parquet as pq
import pytest

from squadweave.llm import html_extract as X

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model():
    return X.default_model()


def article_of(html):
    """The text of a generated page's article element, by plain patterns."""
    inner = re.search("<article>(.*?)</article>", html, re.S)[1]
    inner = re.sub("</?(?:b|i|a|em|span|strong)\\b[^>]*>", "", inner)
    return " ".join(unescape(re.sub("</?[a-zA-Z][^>]*>", " ", inner)).split())


def test_whole_table_against_its_articles(spark):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    truth = {r["page_id"]: article_of(r["html"]) for r in pq.read_table(f"{SF_DIR}/pages.parquet").to_pylist()}
    assert {r.page_id: r.text for r in X.extract(pages).collect()} == truth


def test_marginals_agree_with_enumeration(model):
    """Sum-product on a tree is exact: compare with the sum over all labellings of small pages."""
    pick = random.Random(1)
    for _ in range(25):
        tags = [pick.choice(["div", "p", "nav", "article", "h1", "ul"]) for _ in range(6)]
        html = "".join(f"<{t} class={pick.choice(['ad', 'post', 'x'])}>words" + pick.choice(["", f"</{t}>"]) for t in tags)
        elements, _ = X.parse(html)
        weights, totals = [0.0] * len(elements), 0.0
        for labels in product((0, 1), repeat=len(elements)):
            score = 0.0
            for k, element in enumerate(elements):
                if labels[k]:
                    score += sum(model.single.get(x, 0.0) for x in X.features(element))
                if k:
                    above = elements[element.parent]
                    pair = model.pair.get(f"{X.kind(above)} {X.kind(element)}", model.default)
                    score += pair[2 * labels[element.parent] + labels[k]]
            totals += exp(score)
            for k, label in enumerate(labels):
                weights[k] += label * exp(score)
        assert model.marginals(elements) == pytest.approx([w / totals for w in weights])


WORDS = "some words of a reader go on " * 6
PAGES = [
    ("<article><p>short</p><div class='newsletter-signup'><p>Sign up " + WORDS + "</p></div><p>tail</p></article>", "short tail"),
    (
        "<body><header><h1>Site</h1></header><main><h1>Title</h1><p>Text &amp; more&nbsp;text</p><aside>" + WORDS + "</aside></main>"
        "<footer>Foot</footer>",
        "Title Text & more text",
    ),
    (
        "<div class=header>Site</div><div class=sidebar><h4>Recent</h4><ul><li><a>One</a><li><a>Two</a></ul></div><div id=content>"
        "<h1>T</h1><p>Main text</p><div class=advert>Buy " + WORDS + "</div><p>Third</p></div><div id=comments><ol><li><p>"
        + WORDS + "</p></ol><form>Reply</form></div>",
        "T Main text Third",
    ),
    ("<article><h1>H</h1><p>p</p><div class='comments'><p>c c c</p></div><form><p>f</p></form><p>q</p></article>", "H p q"),
    ("<p>One<p>Two <b>bo</b>ld<br>line", "One Two bold line"),
    ("<article><script>if (a < b) x()</script><style>p{}</style><p>Kept<!-- not <p>this --> text</p></article>", "Kept text"),
    ("no markup at all", "no markup at all"),
    ("", ""),
]


@pytest.mark.parametrize("html, text", PAGES)
def test_pages_of_other_shapes(model, html, text):
    assert model.text(html) == text


@pytest.mark.parametrize(
    "html", ["<", "<a " + "'" * 5000, "</b>" * 20_000 + "<p>" * 20_000, "<div>" * 50_000 + "x", "<![foo[x]]>", "&#xD800;&#0;&bogus;", "<p" * 9999]
)
def test_any_input_gives_a_text_in_linear_time(model, html):
    start = time.perf_counter()
    assert isinstance(model.text(html), str)
    assert time.perf_counter() - start < 10


@pytest.mark.parametrize(
    "html, text",
    [
        ("<p title=don't>Lost words here, it isn't kept.</p>", "Lost words here, it isn't kept."),
        ('<p class="a"">Lost words here.</p><p class="b">More</p>', "Lost words here. More"),
        ("<p ' class=a>One's</p><p title = 'a>b'>Two's</p>", "One's Two's"),
        ('<p title="a>b" class=c"d>One</p><p id="e"f=\'g>h\'>Two</p>', "One Two"),
        ('<p ="x>One</p><p class="y">Two</p>', "One Two"),
        ('<a href=/?q="x>One</a> <b>"two"</b>', 'One "two"'),
        ('<p>One</p><p title="never closed>Two</p>', "One Two"),
    ],
)
def test_a_quote_opens_only_a_value(html, text):
    """Tags end where browsers end them; a value that is never closed, which browsers take to the end of the page, ends early."""
    _, pieces = X.parse(html)
    assert " ".join("".join(x for _, x in pieces).split()) == text


def test_odd_pages(spark):
    pages = spark.createDataFrame(
        [(1, "u", "<article><p>a</p></article>", "x"), (1, "u", "<article><p>a</p></article>", "x"), (2, None, None, None), (None, "v", "", "x")],
        "page_id long, url string, html string, text string",
    )
    rows = sorted(map(repr, map(tuple, X.extract(pages).collect())))
    assert rows == sorted(map(repr, [(1, "u", "a"), (1, "u", "a"), (2, None, ""), (None, "v", "")]))
    assert X.extract(pages.limit(0)).collect() == []


def test_training_on_other_labels():
    """The potentials come from the labels: turn a page's labels and the other part is its text."""
    page = "<html><body><nav data-main={0}><p>menu</p></nav><article data-main={1}><p>text</p></article></body></html>"
    assert X.train([page.format(0, 1)] * 20).text(page) == "text"
    assert X.train([page.format(1, 0)] * 20).text(page) == "menu"
