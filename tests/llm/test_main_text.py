"""Main text of pages: laid out by hand, generated with a known text, broken and odd."""

from __future__ import annotations

import html
import random
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from schoolmetrics.llm import main_text
from schoolmetrics.llm.main_text import page_blocks

PAGES = "page_id long, url string, html string, text string, blocks int, words double"
LONG = "The harbour was built by monks who needed a place for their boats and who stayed there for two hundred years. "


def frame(spark, pages):
    """Pages with further columns whose names the operator uses inside."""
    return spark.createDataFrame([(i, f"http://x/{i}", h, "t", 1, 2.0) for i, h in pages], PAGES)


@pytest.fixture(scope="module")
def tree(spark):
    return main_text.fit_tree(main_text.labelled_blocks(spark))


def taken(tree, page: str) -> str:
    """The tree walked block by block."""

    def main(node, x):
        while isinstance(node, tuple):
            node = node[2] if x[node[0]] <= node[1] else node[3]
        return node > 0.5

    blocks = page_blocks(page)
    return "\n".join(b[0] for b, x in zip(blocks, main_text.block_features(blocks), strict=True) if main(tree, x))


AROUND = [
    '<nav class="top"><ul><li><a href="/">Home</a><li><a href="/x">A menu entry of some more words than usual</a></ul></nav>',
    "<header><a href=/>Logo</a><p>The paper for the people of the whole north coast since it was founded in 1901</p></header>",
    f"<aside><h2>More</h2><p>{LONG * 3}</p></aside>",
    f'<div id="sidebar-left"><p>{LONG}</p></div>',
    f'<div class="Advertisement box">{LONG}</div>',
    f'<div class="cookieConsent">{LONG}<button>OK</button></div>',
    f"<form><p>{LONG}</p><select><option>One<option>Two</select><textarea>Your words here</textarea><input value=Send></form>",
    '<script>document.write("<article><p>not text</p></article>")</script><style>p > a {color: red}</style>',
    "<!-- <article><p>a remark</p></article> --><noscript><p>Please switch scripts on to read this page in full</p></noscript>",
    f'<section id="comments"><article class="comment"><p>{LONG * 2}</p></article><p>Nice one!</p></section>',
    f"<footer><p>{LONG}</p><p>&copy; 2024</p></footer>",
]


@pytest.mark.parametrize("order", range(6))
@pytest.mark.parametrize("inside", ["<article>{}</article>", "<main>{}</main>", '<div role="main">{}</div>', '<div class="post-content">{}</div>'])
def test_layouts(tree, order, inside):
    rng = random.Random(order)
    around = rng.sample(AROUND, len(AROUND))
    # A header inside an article is the article's own.
    around.sort(key=lambda x: x.startswith("<header"))
    cut = rng.randrange(len(around))
    body = (
        f'<h1>Of monks &amp; boats</h1><p>{LONG}<b>Really</b>.<br>Yes</p>{around[0]}<p>Short.</p><ul><li>One</li><li>Two &lt;b&gt;</ul>'
        f"{around[1]}<p>See <a href='/m?a=1&b=>'>the map</a></p><blockquote>{LONG}</blockquote>"
    )
    page = (
        "<!DOCTYPE html><html lang=en><head><title>Title</title></head><body class='with-sidebar'>"
        + "".join(around[2:cut]) + inside.format(body) + "".join(around[max(2, cut):]) + "</body></html>"
    )
    lines = ["Of monks & boats", f"{LONG}Really. Yes", "Short.", "One", "Two <b>", "See the map", LONG.strip()]
    assert taken(tree, page) == "\n".join(lines)


def test_plain_pages(tree):
    page = (
        f"<p><a href=/>Home</a> <a href=/n>News</a></p><h1>A page without any marks in it at all</h1><p>{LONG}</p><p>{LONG}</p>"
        f"<p>So it goes.</p><p>{LONG}</p><p><a href=/b>Back</a> <a href=/t>Top</a></p>"
    )
    text = taken(tree, page)
    assert text.count(LONG.strip()) == 3 and "So it goes." in text and "Home" not in text and "Back" not in text


def test_the_expression_does_what_the_tree_does(spark, tree):
    pages = [(i, "".join(random.Random(i).sample(AROUND, 4)) + f"<article><p>{LONG}</p></article>") for i in range(30)]
    pages += [(40, None), (41, ""), (42, " \n"), (43, "no markup at all"), (None, "<article>x</article>"), (None, None)]
    pages += [(44, "<article>" + "<p>été  &nbsp; 😀</p>" * 40_000), pages[0]]
    got = main_text.main_text(frame(spark, pages).repartition(2))
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    key = lambda row: (row[0] is None, row[0] or 0, row[1])
    wanted = sorted(((i, f"http://x/{i}", t := taken(tree, h or ""), len(t)) for i, h in pages), key=key)
    assert sorted((tuple(r) for r in got.collect()), key=key) == wanted
    assert {r.text for r in got.where("page_id IN (40, 41, 42)").collect()} == {""}
    assert main_text.main_text(frame(spark, []), tree).collect() == []


WORD = st.text(alphabet="ab<>&\"'é ;\n ", min_size=1, max_size=8)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.tuples(WORD, st.sampled_from(["", "b", "i", "span", "em"])), min_size=1, max_size=4), max_size=8), st.randoms())
def test_generated_pages_give_their_text_back(paragraphs, rng):
    body, wanted = [], []
    for runs in paragraphs:
        inner = ""
        for word, tag in runs:
            word = html.escape(word, quote=rng.random() < 0.5)
            inner += f"<{tag} title='a>b'>{word}</{tag}>" if tag else word
        end = rng.choice(["</p>", ""])
        body.append(f"<p class=x>{inner}{end}{rng.choice(['', '<!-- > -->', '<script>if (a</p>b) {}</script>'])}")
        text = " ".join("".join(w for w, _ in runs).split())
        wanted += [text] if text else []
    assert [b[0] for b in page_blocks("<article>" + "".join(body) + "</article>")] == wanted


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="<>/!-?pa b'\"=&;#x1", max_size=60))
def test_nothing_breaks_the_parser(page):
    blocks = page_blocks(page)
    assert all(b[0] and b[1] == len(b[0].split()) and 0 <= b[2] <= 1 for b in blocks)


@pytest.mark.parametrize("unit", ["<a href='", "<b>", "<p>x", "</div>", "<!--", "<div><b>", "&#x", "<script>", "<", "<a b=\"'>"])
def test_hostile_pages_take_linear_time(unit):
    start = time.perf_counter()
    page_blocks(unit * 100_000)
    assert time.perf_counter() - start < 20
