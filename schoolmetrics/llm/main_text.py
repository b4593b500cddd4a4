"""The main text of web pages: flat text blocks, classified by a decision tree.

A page becomes a flat list of text blocks, cut wherever an element that makes a block begins or ends. Of each block are
known its number of words and its link density (the share of words inside links), the same of the blocks before and
after it, and a few marks of the elements around it (an article, a menu, a sidebar or advert by its class, comments).
A decision tree, fitted by Spark on the small table of `labelled_blocks`, tells main text from the rest. The tree becomes one
column expression; the blocks it takes are joined in page order.

Parsing is one pass in tasks, linear in a page's length and forgiving: elements that are never closed end with what is
around them, a `<` that begins no tag is text, an unfinished tag or comment runs to the end of the page.

Cases: a null or empty page has an empty text; character references are decoded once, after markup is gone; all white
space (no-break spaces included) becomes one space; a page without an article or main element is judged by its blocks
alone; very long pages are read whole; equal pages give equal texts, repeated rows stay; an empty table gives an empty
result. Only id, url and html are read.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Elements by what they do to the flow of text, and words in class names and ids.
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td "
    "tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("iframe noembed noframes script style textarea title xmp".split())
UNSEEN = frozenset("audio button canvas datalist head map noscript object select svg template video".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ENDS = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th"),
    "tr": ("td", "th", "tr"),
}
CONTENT_WORDS = frozenset("article articlebody body content entry main maincontent post story text".split())
OTHER_WORDS = frozenset(
    "ad ads adsense advert advertisement adverts alert banner breadcrumb breadcrumbs consent cookie cookies copyright "
    "disclaimer dropdown footer gdpr hidden legal login masthead menu menubar modal nav navbar navigation newsletter notice "
    "notification outbrain pager pagination paywall popup promo promoted recommended related search share sharing sidebar "
    "signup social sponsor sponsored subscribe taboola toolbar topbar widget".split()
)
COMMENT_WORDS = frozenset("comment commentlist comments disqus replies reply respond".split())
ROLES = {
    "main": "article", "article": "article", "navigation": "frame", "banner": "frame", "contentinfo": "frame",
    "form": "frame", "search": "frame", "complementary": "other", "alert": "other", "dialog": "other", "note": "other",
}

ARTICLE, CONTENT, FRAME, OTHER, COMMENT, HIDDEN, LINK, HEADING = (1 << i for i in range(8))

#: What the tree sees of a block, in this order.
FEATURES = [
    "words", "link_density", "words_before", "links_before", "words_after", "links_after",
    "in_article", "page_has_article", "in_content", "in_frame", "in_other", "in_comments", "is_heading",
]
BLOCKS = "array<struct<text: string, " + ", ".join(f"{name}: double" for name in FEATURES) + ">>"

TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>""")
LOOSE_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
COMMENT_END = re.compile(r"--!?>")

# Pages in pieces, each with 1 where its blocks are main text. "@" stands for a heading, paragraphs of all
# LENGTHS and paragraphs that are links, so that inside marked elements neither length nor links decide.
LENGTHS = (1, 2, 4, 7, 12, 20, 33, 60, 150, 5)
LABELLED = [
    [
        (0, "<header>@</header><nav>@</nav><form>@</form><div class=header>@</div>"),
        (0, "<div class=cookie-notice>@</div><div role=navigation>@</div><p>~9</p>"),
        (1, "<article>@"),
        (0, "<div class=ad>@</div>"),
        (1, "@<header><h1>~6</h1></header><div class=entry-body>@</div>"),
        (0, "<aside>@</aside><nav>@</nav><footer>@</footer>"),
        (1, "@<table><tr><td>~1<td>~3</table><ul><li>~2<li>~5</ul>"),
        (0, "<div class=comments>@<article>@</article></div>"),
        (1, "@</article>"),
        (0, "@<div class=main-menu>@</div><div class=text>@</div><section class=comments><article>@</article></section>"),
        (0, "<aside class=story>@</aside><aside><article>@</article></aside><footer>@</footer>"),
    ],
    [
        (0, "<div id=banner>@</div>@"),
        (1, "<main><h1>~4</h1><div class=content>@</div>@"),
        (0, "<div class=newsletter>@<form>@</form></div>"),
        (1, "@</main>"),
        (0, "<div id=sidebar>@</div><div class=content>@</div><footer>@</footer>"),
    ],
    [
        (0, "<header>@</header><nav>@</nav><div class=sidebar>@</div><form>@</form>"),
        (1, "<div class=post-content>@"),
        (0, "<div class=promo>@</div>"),
        (1, "@</div>"),
        (0, "<div class=comments>@<div class=content>@</div></div><div class=related>@</div><footer class=content>@</footer>"),
        (0, "<p>~3</p><p><a>~1</a> <a>~1</a></p><p>~2 <a>~1</a></p>"),
    ],
    [
        (0, "<p><a>~1</a> <a>~2</a> <a>~1</a></p><p><a>~6</a></p><p>~1 <a>~2</a></p>"),
        (1, "<h1>~5</h1><p>~30</p><p>~3</p><p>~45</p><p>~1</p><p>~10</p><p>~60</p><p>~20 <a>~4</a> ~30</p><p>~8</p><p>~25</p>"),
        (0, "<p><a>~2</a></p><p>~4</p><p>~2 <a>~3</a></p><p>~5</p>"),
    ],
    [
        (0, "<p><a>~3</a></p><p><a>~2</a> ~1 <a>~9</a></p><p><a>~40</a></p>"),
        (1, "<h2>~3</h2><p>~90</p><p>~2</p><p>~14</p><p>~5</p><p>~22</p><p>~12 <a>~3</a> ~6</p><p>~130</p><p>~35</p>"),
        (0, "<p><a>~1</a> <a>~1</a> <a>~1</a></p><p>~6</p>"),
    ],
    [(0, "<p>~3</p><p><a>~2</a></p>"), (1, "<p>~50</p><p>~16</p><p>~4</p><p>~28</p>")],
    [(1, "<h1>~2</h1><p>~70</p><p>~18</p>"), (0, "<p>~4</p><p><a>~7</a></p><p>~3</p>")],
    [(1, "<p>~12</p>")],
    [(1, "<h1>~6</h1><p>~15</p><p>~3</p><p>~40</p>"), (0, "<p>~1</p><p><a>~1</a></p>")],
]


def spelt(piece: str) -> str:
    """A piece of a labelled page with its marks spelt out; ~n are n words."""
    runs = "".join(f"<p>~{n}</p>" for n in LENGTHS) + "<p><a>~1</a></p><p><a>~4</a></p><p><a>~12</a></p><p>~9</p>"
    return re.sub(r"~(\d+)", lambda n: "word " * int(n[1]), piece.replace("@", f"<h2>~3</h2>{runs}"))


def _marks(tag: str, attributes: str, around: int) -> int:
    """Marks of what is inside an element, given those around it."""
    marks, kind = around, ""
    words: set[str] = set()
    if attributes and tag not in ("body", "html"):
        for name, value in ATTRIBUTE.findall(attributes):
            name, value = name.lower(), value.strip("\"'")
            if name in ("class", "id"):
                words.update(w.lower() for w in NAME_PART.findall(value))
            elif name == "role":
                kind = ROLES.get(value.lower(), "")
            elif name == "hidden" or (name == "style" and "display:none" in value.replace(" ", "").lower()):
                marks |= OTHER
    if tag in ("article", "main") or kind == "article":
        # An article does not begin inside a menu or form; such elements were left open.
        marks = (marks | ARTICLE) & ~FRAME
    elif tag in ("nav", "footer", "form", "menu", "search") or kind == "frame" or (tag == "header" and not marks & ARTICLE):
        marks |= FRAME
    elif tag in ("aside", "dialog") or kind == "other":
        marks |= OTHER
    if words & COMMENT_WORDS:
        marks |= COMMENT
    if words & OTHER_WORDS:
        marks |= OTHER
    elif words & CONTENT_WORDS:
        marks |= CONTENT
    elif "header" in words and not marks & ARTICLE:
        marks |= FRAME
    if tag in HEADINGS:
        marks |= HEADING
    return marks


class _Page:
    """The elements that are open, and the blocks found so far."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, int]] = []
        self.open = Counter()
        self.marks = 0
        self.pieces: list[str] = []
        self.linked = 0
        self.blocks: list[tuple[str, int, float, int]] = []

    def text(self, piece: str) -> None:
        if self.marks & HIDDEN:
            return
        if "&" in piece:
            piece = entities.unescape(piece)
        self.pieces.append(piece)
        if self.marks & LINK:
            self.linked += len(piece.split())

    def cut(self) -> None:
        """End the block."""
        words = "".join(self.pieces).split()
        if words:
            self.blocks.append((" ".join(words), len(words), min(1.0, self.linked / len(words)), self.marks))
        self.pieces, self.linked = [], 0

    def push(self, tag: str, marks: int) -> None:
        self.stack.append((tag, marks))
        self.open[tag] += 1
        self.marks = marks

    def pop_to(self, size: int) -> None:
        for tag, _ in self.stack[size:]:
            self.open[tag] -= 1
        del self.stack[size:]
        self.marks = self.stack[-1][1] if self.stack else 0

    def _last_block(self) -> int:
        at = len(self.stack) - 1
        while at >= 0 and self.stack[at][0] not in BLOCK:
            at -= 1
        return at

    def begin(self, tag: str, attributes: str) -> None:
        if tag == "br":
            self.text(" ")
        if tag in BLOCK:
            self.cut()
            if tag == "body":
                self.pop_to(0)
            elif self.open["head"]:
                self.end("head")
            ended = ("p", *ENDS.get(tag, ()))
            while (at := self._last_block()) >= 0 and self.stack[at][0] in ended:
                self.pop_to(at)
        if tag in VOID:
            return
        marks = self.marks
        if tag in BLOCK:
            marks = _marks(tag, attributes, marks)
        elif tag in UNSEEN:
            marks |= HIDDEN
            if attributes.endswith("/"):
                return
        elif tag == "a":
            self.end("a")
            marks = self.marks | LINK
        self.push(tag, marks)

    def end(self, tag: str) -> None:
        if tag in ("body", "html"):
            return
        if tag in BLOCK:
            self.cut()
        if self.open[tag]:
            at = len(self.stack) - 1
            while self.stack[at][0] != tag:
                # Inline elements don't close the blocks they hold.
                if tag not in BLOCK and tag not in UNSEEN and self.stack[at][0] in BLOCK:
                    return
                at -= 1
            self.pop_to(at)


def page_blocks(page: str) -> list[tuple[str, int, float, int]]:
    """(text, words, link density, marks) of every block of a page, in order."""
    found, at, strict = _Page(), 0, True
    while (tag_at := page.find("<", at)) >= 0:
        if tag_at > at:
            found.text(page[at:tag_at])
        match = None
        if strict:
            match = TAG.match(page, tag_at)
        if match is None and (match := LOOSE_TAG.match(page, tag_at)):
            strict = False  # a quote that never ends: from here on tags end at the next ">"
        if match:
            closing, tag, attributes = match[1], match[2].lower(), match[3]
            at = match.end()
            if closing:
                found.end(tag)
            elif tag in RAW:
                close = re.compile(f"</{tag}(?=[\\s/>])[^>]*>?", re.IGNORECASE).search(page, at)
                at = close.end() if close else len(page)
            else:
                found.begin(tag, attributes)
            continue
        following = page[tag_at + 1 : tag_at + 2]
        if page.startswith("<!--", tag_at):
            close = COMMENT_END.search(page, tag_at + 2 if page.startswith("<!-->", tag_at) else tag_at + 4)
            at = close.end() if close else len(page)
        elif following in ("!", "?", "/"):
            close = page.find(">", tag_at)
            at = close + 1 if close >= 0 else len(page)
        elif following.isalpha() and following.isascii():
            at = len(page)  # the page ends inside a tag
        else:
            found.text("<")
            at = tag_at + 1
    if at < len(page):
        found.text(page[at:])
    found.cut()
    return found.blocks


def block_features(blocks: list[tuple[str, int, float, int]]) -> np.ndarray:
    """One row of FEATURES for each block of a page."""
    words = np.array([0, *(b[1] for b in blocks), 0], float)
    links = np.array([0, *(b[2] for b in blocks), 0], float)
    marks = np.array([b[3] for b in blocks], int)
    flags = [(marks & m > 0).astype(float) for m in (ARTICLE, CONTENT, FRAME, OTHER, COMMENT, HEADING)]
    # Comments and teasers may be articles too; they don't make a page one that has its text in an article.
    has_article = np.full(len(blocks), float(((marks & ARTICLE > 0) & (marks & (OTHER | COMMENT) == 0)).any()))
    columns = [
        words[1:-1], links[1:-1], words[:-2], links[:-2], words[2:], links[2:], flags[0], has_article, *flags[1:],
    ]
    return np.stack(columns, axis=1)


def _block_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """page_id, url, html -> page_id, url, blocks; a hundred pages at a time."""
    fields = [pa.field("text", pa.string()), *(pa.field(name, pa.float64()) for name in FEATURES)]
    for batch in batches:
        for at in range(0, batch.num_rows, 100):
            part = batch.slice(at, 100)
            pages = [page_blocks(page or "") for page in part.column("html").to_pylist()]
            rows = np.concatenate([block_features(blocks) for blocks in pages])
            texts = pa.array([b[0] for blocks in pages for b in blocks], pa.string())
            structs = pa.StructArray.from_arrays([texts, *(pa.array(rows[:, i]) for i in range(len(FEATURES)))], fields=fields)
            ends = np.cumsum([0, *(len(blocks) for blocks in pages)])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), structs)
            yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), lists], ["page_id", "url", "blocks"])


def text_blocks(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url and the text blocks of every page with their features."""
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    kinds = [f"{c} {rows.schema[c].dataType.simpleString()}" for c in ("page_id", "url")]
    return rows.mapInArrow(_block_batches, ", ".join([*kinds, f"blocks {BLOCKS}"]))


def labelled_blocks(spark: SparkSession, pages: list[list[tuple[int, str]]] | None = None) -> DataFrame:
    """label and features of the blocks of labelled pages."""
    rows = []
    for page in LABELLED if pages is None else pages:
        blocks = page_blocks("".join(spelt(piece) for _, piece in page))
        # A piece's blocks are those its text adds; a block never runs over into the next piece.
        labels = [main for main, piece in page for _ in page_blocks(spelt(piece))]
        if len(labels) != len(blocks):
            raise ValueError("pieces must hold whole blocks")
        rows += [(float(y), Vectors.dense(x)) for y, x in zip(labels, block_features(blocks), strict=True)]
    return spark.createDataFrame(rows, ["label", "features"])


def _nested(lines: list[str]) -> tuple | float:
    """(feature, threshold, low, high) or a prediction, from the lines of a tree's text, taken from the front."""
    line = lines.pop(0)
    if line.startswith("Predict"):
        return float(line.split(":")[1])
    feature, threshold = re.match(r"If \(feature (\d+) <= (\S+)\)", line).groups()
    low = _nested(lines)
    lines.pop(0)
    return int(feature), float(threshold), low, _nested(lines)


def fit_tree(blocks: DataFrame, depth: int = 8) -> tuple | float:
    """The decision tree of labelled blocks, as nested (feature, threshold, low, high)."""
    fitted = DecisionTreeClassifier(maxDepth=depth, maxBins=64, seed=1).fit(blocks.coalesce(1))
    return _nested([line.strip() for line in fitted.toDebugString.splitlines()[1:] if line.strip()])


def is_main(tree: tuple | float, block: Column) -> Column:
    """Whether the tree takes a block for main text."""
    if not isinstance(tree, tuple):
        return F.lit(tree > 0.5)
    feature, threshold, low, high = tree
    return F.when(block[FEATURES[feature]] <= threshold, is_main(low, block)).otherwise(is_main(high, block))


def main_text(pages: DataFrame, tree: tuple | float | None = None, **columns: str) -> DataFrame:
    """page_id, url, text (main blocks, one a line) and n_chars of every page."""
    tree = fit_tree(labelled_blocks(pages.sparkSession)) if tree is None else tree
    kept = F.filter("blocks", lambda block: is_main(tree, block))
    text = F.array_join(F.transform(kept, lambda block: block["text"]), "\n")
    found = text_blocks(pages, **columns).select("page_id", "url", text.alias("text"))
    return found.withColumn("n_chars", F.length("text").cast("long"))
