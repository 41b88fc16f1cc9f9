"""Main text of web pages by a recurrent block labeller.

A page is cut into leaf blocks (runs of text between tags that break the line).
A bidirectional LSTM reads the whole sequence of blocks, each as the mean vector
of the hashed words of its tag path (element names and the words of class, id and
role), the mean vector of its hashed words, and a few numbers such as its length,
its share of links and its place. So a block is judged by its own looks and by all
that stands before and behind it. Blocks scored above zero are main text and are
joined in their order.

The model is trained on the driver, from a bounded sample: ``TRAIN_PAGES`` pages of
at most ``TRAIN_CHARS`` characters that mark their article themselves
(``article`` or ``main``; menus, headers, asides, forms, footers, adverts and
comments inside it are not part of the text). Sites that mark nothing, or mark
it otherwise, are learnt from the same pages dressed anew: ``DRESSED`` times each,
their texts are set into layouts drawn from the lists below, with menus, notices,
adverts, sidebars, forms and reader comments around and in between, plain ``div``
articles among them. Where no page marks its article, any pages' texts are dressed.

Every page is read whole in the task that scans it; nothing is shuffled. A page
takes some ten times its own size in memory. A null page, or one without text, has
an empty text; null ids and urls stay null; repeated rows give repeated results;
extra columns are ignored, whatever their names; an empty table gives an empty
result.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from html import escape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billmodel.llm.common import CHUNK, arrow_rows, ship_package
from billmodel.llm.html_blocks import Block, blocks_of
from billmodel.llm.html_model import Labeller

RESULT = "page_id long, url string, text string, n_chars long"
#: Pages sampled to train on, their greatest length, the blocks read of each in
#: training, and how often each is dressed anew.
TRAIN_PAGES, TRAIN_CHARS, TRAIN_BLOCKS, DRESSED = 240, 100_000, 60, 5
#: Elements that hold an article, and those whose content is none of it.
HOLDERS = frozenset(("article", "main"))
OTHERS = frozenset("nav header footer aside form dialog menu button select option label fieldset".split())
#: Words of a class, id or role that say the same.
OTHER_WORDS = frozenset(("ad ads advert advertisement banner sponsor sponsored promo cookie consent notice popup modal newsletter subscribe signup "
                         "comment comments reply replies disqus discussion sidebar related share social menu nav navigation navbar breadcrumb "
                         "breadcrumbs footer masthead copyright login search form toolbar widget tags pager pagination").split())
#: Layouts: (element, class) of articles, and kinds of other sections with
#: (element, class) and the looks of their items.
ARTICLES = [("article", ""), ("article", "post"), ("main", ""), ("main", "page"), ("div", "content"), ("div", "main-content"), ("div", "article-body"),
            ("div", "post-body"), ("div", "entry-content"), ("div", "story"), ("section", "story-text"), ("section", "body"), ("td", "text"), ("div", "")]
SECTIONS = {
    "menu": [("nav", ""), ("div", "menu"), ("ul", "nav"), ("div", "navbar"), ("div", "navigation"), ("ul", "breadcrumbs"), ("div", "topbar")],
    "header": [("header", ""), ("div", "header"), ("div", "masthead"), ("header", "site-header")],
    "advert": [("div", "ad"), ("div", "ads banner"), ("aside", "advert"), ("div", "sponsored"), ("div", "promo"), ("section", "advertisement")],
    "notice": [("div", "cookie-notice"), ("div", "consent"), ("div", "notice"), ("dialog", ""), ("div", "alert popup"), ("div", "banner-message")],
    "sidebar": [("aside", ""), ("div", "sidebar"), ("div", "widget related"), ("aside", "related"), ("div", "share social"), ("div", "most-read")],
    "form": [("form", ""), ("form", "search"), ("form", "newsletter"), ("div", "subscribe"), ("form", "login")],
    "footer": [("footer", ""), ("div", "footer"), ("div", "copyright"), ("footer", "site-footer")],
    "comments": [("section", "comments"), ("div", "comments"), ("div", "reader-comments"), ("ol", "comment-list"), ("div", "discussion"), ("div", "replies")],
}
BEFORE, INSIDE, AFTER = ("menu", "header", "notice", "advert", "sidebar", "form"), ("advert", "sidebar", "form", "notice"), ("comments", "sidebar", "advert", "form", "menu", "footer", "notice")


# --- pages to train on ------------------------------------------------------------


def marked(block: Block) -> bool:
    """Whether a page that marks its article has this block in it."""
    inside = False
    for words in block.path:
        name = words[0][1:]
        if name in OTHERS or not OTHER_WORDS.isdisjoint(words[1:]):
            return False
        inside = inside or name in HOLDERS
    return inside


def _section(kind: str, short: list[str], long: list[str], r: random.Random) -> str:
    """HTML of a section that is no main text."""
    name, css = r.choice(SECTIONS[kind])
    text = lambda: escape(r.choice(short), quote=False)
    if kind == "menu" or (kind in ("header", "sidebar", "footer") and r.random() < 0.5):
        item = "li" if name == "ul" or r.random() < 0.6 else r.choice(["span", "div", "p"])
        inner = "".join(f'<{item}><a href="/{i}">{text()[:40]}</a></{item}>' for i in range(r.randint(2, 9)))
        inner = f"<ul>{inner}</ul>" if item == "li" and name != "ul" else inner
    elif kind == "comments":
        item = "li" if name == "ol" else r.choice(["div", "article", "section"])
        css_item = r.choice(["comment", "reply", "comment-body"])
        inner = "".join(f'<{item} class="{css_item}"><b>{text()[:20]}</b><p>{escape(r.choice(long + short), quote=False)}</p></{item}>' for _ in range(r.randint(1, 6)))
        inner = (f"<h3>{text()[:30]}</h3>" if name != "ol" and r.random() < 0.5 else "") + inner
    elif kind == "form":
        inner = f"<label>{text()[:40]}</label><input name=q><button>{text()[:15]}</button>" + (f"<p>{text()}</p>" if r.random() < 0.5 else "")
    else:
        item = r.choice(["p", "div", "span", ""])
        inner = "".join((f"<{item}>" if item else "") + escape(r.choice(short if r.random() < 0.7 else long), quote=False) + (f"</{item}>" if item else " ")
                        for _ in range(r.randint(1, 3)))
        inner = ("&copy; " if kind == "footer" else "") + inner
    attribute = r.choice(["class", "class", "id"])
    return f'<{name} {attribute}="{css}" data-keep="0">{inner}</{name}>' if css else f'<{name} data-keep="0">{inner}</{name}>'


def dressed(article: list[str], short: list[str], long: list[str], r: random.Random) -> str:
    """A page of another layout that holds the article's blocks."""
    name, css = r.choice(ARTICLES)
    some = lambda kinds, share: "".join(_section(k, short, long, r) for k in kinds if r.random() < share)
    parts, first = [], r.random() < 0.7
    for n, text in enumerate(article):
        tag = r.choice(["h1", "h2"]) if n == 0 and first else r.choice(["p"] * 6 + ["li", "blockquote", "h2", "div", "td"])
        parts.append(f"<{tag}>{escape(text, quote=False)}" + (f"</{tag}>" if r.random() < 0.8 else ""))
        if r.random() < 0.08:
            parts.append(some(INSIDE, 0.3))
    holder = f'<{name} class="{css}" data-keep="1">' if css else f'<{name} data-keep="1">'
    body = holder + "".join(parts) + (some(("comments",), 0.15) if name == "article" else "") + f"</{name}>"
    before, after = list(BEFORE), list(AFTER)
    r.shuffle(before), r.shuffle(after)
    page = some(before, 0.4) + body + some(after, 0.4)
    wrapper = r.choice(["", "", "container", "page wrapper", "site"])
    page = f'<div class="{wrapper}" id="{r.choice(["root", "wrap", "app"])}">{page}</div>' if wrapper else page
    return f"<!DOCTYPE html><html><head><title data-keep=\"0\">{escape(article[0][:60], quote=False)}</title></head><body>{page}</body></html>"


def training_pages(pages: list[str], seed: int = 11) -> tuple[list[list[Block]], list[np.ndarray]]:
    """Blocks of pages and their labels: the pages that mark their article, and
    all dressed anew."""
    r = random.Random(seed)
    read = [blocks_of(p) for p in pages]
    known = [(bs, [marked(b) for b in bs]) for bs in read]
    known = [(bs, ys) for bs, ys in known if any(ys)]
    if known:
        articles = [[b.text for b, y in zip(bs, ys) if y] for bs, ys in known]
        short = [b.text for bs, ys in known for b, y in zip(bs, ys) if not y]
    else:
        articles = [[b.text for b in bs] for bs in read if bs] or [["Words of a page."]]
        short = [b.text for bs in read for b in bs if len(b.text) < 100]
    short = [t[:200] for t in short] or ["More", "Home"]
    long = [t for a in articles for t in a[1:]] or short
    out, labels = [], []
    for bs, ys in known:
        out.append(bs[:TRAIN_BLOCKS])
        labels.append(np.array(ys[:TRAIN_BLOCKS], np.float32))
    for a in articles:
        for _ in range(DRESSED):
            start = 0 if len(a) <= TRAIN_BLOCKS // 2 else r.randrange(len(a) - TRAIN_BLOCKS // 2)
            bs = blocks_of(dressed(a[start : start + r.randint(1, TRAIN_BLOCKS // 2)], short, long, r))[: 2 * TRAIN_BLOCKS]
            out.append(bs)
            labels.append(np.array([b.keep == "1" for b in bs], np.float32))
    return out, labels


def train(pages: DataFrame, id_col: str, url_col: str, html_col: str, train_pages: int = TRAIN_PAGES) -> Labeller:
    """A model fitted on at most ``train_pages`` pages, of least hash."""
    html = F.col(f"`{html_col}`").cast("string")
    spot = F.xxhash64(F.col(f"`{id_col}`").cast("string"), F.col(f"`{url_col}`").cast("string"))
    rows = pages.select(html.alias("html"), spot.alias("spot")).filter((F.char_length("html") <= TRAIN_CHARS) & (F.char_length("html") > 0))
    first = lambda some: [x.html for x in some.orderBy("spot", F.xxhash64("html")).limit(train_pages).collect()]
    sample = first(rows.filter(F.col("html").rlike(r"(?i)<(article|main)[\s>]"))) or first(rows)
    examples, labels = training_pages(sample)
    model = Labeller()
    model.fit(examples, labels)
    return model


# --- extraction -------------------------------------------------------------------


def main_texts(model: Labeller, pages: list[str]) -> list[str]:
    """Main text of every page."""
    read = [blocks_of(p) for p in pages]
    return [" ".join(b.text for b, x in zip(bs, score) if x > 0) for bs, score in zip(read, model.scores(read))]


def _extract(model: Labeller):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, urls, pages, held = [], [], [], 0

            def rows() -> Iterator[pa.RecordBatch]:
                texts = main_texts(model, pages)
                return iter(arrow_rows(RESULT, [(i, u, t, len(t)) for i, u, t in zip(ids, urls, texts)]).to_batches())

            for i, u, h in zip(*batch.columns):
                ids.append(i.as_py())
                urls.append(u.as_py())
                pages.append(h.as_py() or "")
                held += len(pages[-1])
                if held >= CHUNK:
                    yield from rows()
                    ids, urls, pages, held = [], [], [], 0
            yield from rows()

    return run


def html_extraction(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                    train_pages: int = TRAIN_PAGES, model: Labeller | None = None) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of ``pages``; ``model`` is one
    that :func:`train` made, else it is trained on these pages."""
    ship_package(pages.sparkSession)
    model = model or train(pages, id_col, url_col, html_col, train_pages)
    rows = pages.select(F.col(f"`{id_col}`").cast("long"), F.col(f"`{url_col}`").cast("string"), F.col(f"`{html_col}`").cast("string"))
    return rows.mapInArrow(_extract(model), RESULT)
