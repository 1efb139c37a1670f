"""Main text of the given pages against their known layout, of hand-made pages against what a reader would keep."""

import html
import re

import pytest

from lettora.llm import html_text
from lettora.llm.html_text import density, extract_text, main_text
from lettora.llm.queries import op6_html_text

LONG = "This paragraph has some words, enough of them that nobody takes it for a menu, an advert or a footer of the page."
MENU = "<ul>" + "".join(f'<li><a href="/{i}">Entry number {i}</a></li>' for i in range(12)) + "</ul>"


def test_given_pages(spark):
    pages = {r.page_id: r for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()}
    found = op6_html_text(spark, "/root/testdata/sf0.01").collect()
    assert len(found) == len(pages)
    for row in found:
        inside = re.search(r"<article>(.*?)(</article>|$)", pages[row.page_id].html, re.S)[1]
        blocks = [re.sub("</?b>", "", part.replace("<br>", " ")) for part in re.split("</?(?:p|h1)>", inside)]
        lines = [" ".join(html.unescape(block).split()) for block in blocks]
        assert row.text == "\n".join(filter(None, lines)) and row.n_chars == len(row.text)
        assert row.url == pages[row.page_id].url


@pytest.mark.parametrize(
    "page, expected",
    [
        (None, ""),
        ("", ""),
        ("<html><head><title>x</title></head><body></body></html>", ""),
        ("just text &amp; more\n\n text", "just text & more text"),
        (f"<p>{LONG}<p>{LONG}", f"{LONG}\n{LONG}"),
        (f"<div><div id=nav>{MENU}</div><div><h2>T</h2><p>{LONG}</p><p>Of.</p><p>{LONG}</p></div></div>", f"T\n{LONG}\nOf.\n{LONG}"),
        (f"<nav>{MENU}</nav><div>{MENU}</div><div><p>{LONG}</p><p>{LONG}</p></div><div class='x Side-bar sidebar'><p>{LONG}</p></div>", f"{LONG}\n{LONG}"),
        (f"<article><h1>Head</h1><p>{LONG}</p><form><p>{LONG}</p></form><aside>{LONG}</aside></article><section id='comments'>"
         f"<article>{LONG * 9}</article><p>{LONG * 9}</p></section>", f"Head\n{LONG}"),
        (f"<body class='with sidebar'><header><h1>Site</h1></header><main><header><h1>Head</h1></header><p>{LONG}</p></main>"
         f"<div class='cookie-notice'>{LONG * 3}</div></body>", f"Head\n{LONG}"),
        (f"<div class=widget><nav>{MENU}</nav><article><p>{LONG}</p></article></div>", LONG),
        (f"<body><form action=x><h1>Head</h1><p>{LONG}</p><footer>{LONG}</footer></form></body>", f"Head\n{LONG}"),
        (f"<article><p>Short.</p></article><div class=ad>{LONG * 9}</div><footer><p>{LONG * 9}</p></footer>", "Short."),
        ("<p>a<script>if (1<2) {document.write('</p>')}</script>b<!-- <p>c --><style>p>a{}</style>c</p>", "abc"),
        ("<p>one<br>two<b>bold</b>er &eacute;&#x41;&nbsp;&lt;p&gt; <i>x</i></p>", "one twobolder éA <p> x"),
        (f"<table><tr><td>{LONG}<td>{LONG}<tr><td>{LONG}</table>", "\n".join([LONG] * 3)),
        (f"<ul><li>{LONG}<li>{LONG}<ul><li>{LONG}</ul></ul>", "\n".join([LONG] * 3)),
        ("<p title='a>b' class=x>q</p><p>1 < 2 and 3 > 2</p><p", "q\n1 < 2 and 3 > 2\n<p"),
        (f"<div>{'<div>' * 3000}<p>{LONG}</p>{'</div>' * 2000}", LONG),
        (f"<article>{'<div>' * 40}<header><h1>Head</h1></header><p>{LONG}</p>{'</div>' * 40}</article>", f"Head\n{LONG}"),
        ("<p>\u0130\u0130\u0130\u0130\u0130\u0130 a<script>x</script>b</p><p>c</p>", "\u0130\u0130\u0130\u0130\u0130\u0130 ab\nc"),
        ("<p>a" + "</div></li>" * 50_000 + "</p>" + "<div>" * 50_000 + "</p></li>" * 50_000, "a"),
        ("<p>" + "word " * 400_000 + "</p>", "word " * 399_999 + "word"),
    ],
)
def test_pages(page, expected):
    assert main_text(page) == expected


@pytest.mark.parametrize(
    "page, expected",
    [
        (f"<article><h1>A title of the page</h1><div><p>{LONG * 3}</p><p>{LONG * 3}</p></div></article>", f"A title of the page\n{LONG * 3}\n{LONG * 3}"),
        (f"<article><h1>Head</h1><section><p>{LONG * 4}</p><p>{LONG * 4}</p></section><section><h2>Two</h2><p>{LONG}</p></section></article>",
         f"Head\n{LONG * 4}\n{LONG * 4}\nTwo\n{LONG}"),
        (f"<main>Bare.<div><p>{LONG}</p><p>{LONG}</p></div><ul><li>One<li><a href=x>Two</a></ul></main>", f"Bare.\n{LONG}\n{LONG}\nOne\nTwo"),
        (f"<main><article><p>{LONG}</p></article><article><p>Short.</p></article></main><div>{LONG}</div>", f"{LONG}\nShort."),
        (f"<h1>Head</h1><div><p>{LONG}</p><p>{LONG}</p></div>", f"Head\n{LONG}\n{LONG}"),
    ],
)
def test_nothing_but_noise_is_dropped(page, expected):
    assert main_text(page) == expected


TEXT = f"<h1>Head</h1><p>{LONG}</p><p>{LONG}</p>"
READ = f"Head\n{LONG}\n{LONG}"


@pytest.mark.parametrize(
    "page, expected",
    [
        (f"<nav>{MENU}</nav><div class='content-with-sidebar'>{TEXT}</div><div class=sidebar><p>{LONG}</p></div>", READ),
        (f"<div id='page' class='no-banner has-menu'><div class=menu>{MENU}</div>{TEXT}</div>", READ),
        (f"<div id='page-widget'><div class='banner'>{TEXT}</div><div class=ad>{LONG}</div></div>", READ),
        (f"<div class=comments>{TEXT}</div>", READ),
        (f"<div id=text>{TEXT}</div><div class=comments><p>{LONG * 3}</p></div>", READ),
        (f"<article><div class='article-header'><h1>Head</h1></div><p>{LONG}</p><p>{LONG}</p></article>", READ),
        (f"<article><div class='masthead banner'><h1>Head</h1></div><p>{LONG}</p><p>{LONG}</p><div class=promo>{LONG}</div></article>",
         READ),
        (f"<article>{TEXT}<section class='related-work'><h2 class='section-header'>Two</h2><p>{LONG}</p></section>"
         f"<div class='search-results'><p>{LONG}</p></div></article>", f"{READ}\nTwo\n{LONG}\n{LONG}"),
        (f"<article>{TEXT}<div class='related'>{MENU}</div><div role=search><p>{LONG}</p></div></article>", READ),
        (f"<article><div class='post-navigation'>{TEXT}</div><div class=comments><p>{LONG * 2}</p></div></article>", READ),
        (f"<article>{TEXT}</article><div class='widget'><p>{LONG * 9}</p></div>", READ),
    ],
)
def test_names_of_noise(page, expected):
    assert main_text(page) == expected


def test_density():
    assert density(0, 3, 0, 0, 0.1) == 0
    assert density(500, 5, 0, 0, 0.1) > density(500, 5, 100, 2, 0.1) > density(500, 5, 480, 5, 0.1) >= 0
    assert density(90, 0, 0, 0, 0.0) == 90


def test_odd_rows(spark):
    rows = [(1, None, None), (1, None, None), (None, "u", f"<p>{LONG}</p>"), (2, "v", "")]
    pages = spark.createDataFrame([(*r, 7, "t") for r in rows], "page_id long, url string, html string, n_chars int, text string")
    assert sorted((tuple(r)[:4] for r in extract_text(pages).collect()), key=repr) == sorted(
        [(1, None, "", 0), (1, None, "", 0), (None, "u", LONG, len(LONG)), (2, "v", "", 0)], key=repr
    )
    assert extract_text(pages.limit(0)).count() == 0


def within(node, top):
    while node is not None and node is not top:
        node = node.parent
    return node is top


def chosen_by_definition(html):
    """The subtree of the largest sum of densities, counts of every subtree added up anew; in page order the first."""
    nodes, _ = html_text.parse(html)
    own = {node: (node.chars, node.tags, node.link_chars, node.link_tags) for node in nodes}
    page_links = sum(o[2] for o in own.values()) / max(sum(o[0] for o in own.values()), 1)
    html_text._settle_noise(nodes)
    kept = [node for node in nodes if not node.noise]
    density = {}
    for top in kept:
        below = [node for node in kept if within(node, top)]
        chars, tags, link_chars, link_tags = (sum(own[node][i] for node in below) for i in range(4))
        density[top] = html_text.density(chars, tags + len(below) - 1, link_chars, link_tags, page_links)
    total = {node: sum(density[c] for c in kept if c.parent is node) if any(c.parent is node for c in kept) else density[node] for node in kept}
    best = max(total.values(), default=0.0)
    path = []
    node = next((node for node in kept if total[node] == best), None)
    while node is not None:
        path.append(node.tag)
        node = node.parent
    return "/".join(reversed(path)), best


def random_page(rng):
    def element(depth):
        tag = rng.choice(["div", "p", "section", "ul", "li", "a", "span", "article", "nav", "h1", "main"])
        inner = "".join(element(depth + 1) for _ in range(rng.randint(0, 3))) if depth < 4 else ""
        return f"<{tag}>{'word ' * rng.randint(0, 12)}{inner}{'more ' * rng.randint(0, 4)}</{tag}>"

    return f"<html><body>{''.join(element(0) for _ in range(rng.randint(1, 4)))}</body></html>"


def test_density_is_that_of_the_definition():
    import math
    import random

    import pyarrow.parquet as pq

    rng = random.Random(6)
    pages = [random_page(rng) for _ in range(200)]
    pages += pq.read_table("/root/testdata/sf0.001/pages.parquet").column("html").to_pylist()
    for html in pages:
        _, choice = html_text.extract(html)
        path, total = chosen_by_definition(html)
        assert math.isclose(choice.total, total, rel_tol=1e-9) and choice.path == path


def test_every_given_page_has_a_choice(spark):
    from lettora.llm.queries import LLM_QUERIES

    rows = LLM_QUERIES["op6_html_text"](spark, "/root/testdata/sf0.01").select("chosen", "density", "n_chars").collect()
    assert rows and all(row.density > 0 and row.chosen for row in rows if row.n_chars)


def test_density_chooses_among_articles():
    teaser = "".join(f"<article><h2>Card {i}</h2><a href='/{i}'>Read</a></article>" for i in range(5))
    body = "".join(f"<p>{'Some sentence of the story goes on. ' * 8}</p>" for _ in range(4))
    page = f"<html><body><div>{teaser}</div><article><h1>Title</h1>{body}<p>Short.</p></article></body></html>"
    assert html_text.main_text(page).startswith("Title\nSome") and html_text.main_text(page).endswith("Short.")
    assert "Card" not in html_text.main_text(page)
