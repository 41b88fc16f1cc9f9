"""Block reader and block labeller: planted pages, held-out accuracy, gradients."""

from __future__ import annotations

import random
import re
from collections import Counter
from html import unescape

import numpy as np
import pytest

from billmodel.llm import html_extraction as extraction
from billmodel.llm import registry
from billmodel.llm.html_blocks import blocks_of, squeezed
from billmodel.llm.html_model import Labeller, word_ids


@pytest.fixture(scope="module")
def pages(spark):
    return [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "url", "html").collect()]


@pytest.fixture(scope="module")
def model(pages):
    examples, labels = extraction.training_pages([h for _, _, h in pages[:120]])
    model = Labeller()
    losses = model.fit(examples, labels)
    assert np.mean(losses[-10:]) < 0.05 < np.mean(losses[:5])
    return model


def article(html: str) -> str:
    """The text of the tables' own kind of page, by a pattern."""
    inside = re.search(r"(?s)<article>(.*?)</article>", html).group(1)
    return " ".join(unescape(re.sub(r"<[^>]+>", " ", inside)).split())


def test_op12_returns_every_article(spark, pages):
    got = Counter(map(tuple, registry.op12_html_extraction(spark, "/root/testdata/sf0.01").collect()))
    assert got == Counter((i, u, article(h), len(article(h))) for i, u, h in pages)


def test_layouts_that_were_not_trained_on(model, pages):
    """Pages of other texts and layouts: blocks and whole pages."""
    examples, labels = extraction.training_pages([h for _, _, h in pages[120:]], seed=77)
    blocks = wrong = 0
    for score, label in zip(model.scores(examples), labels):
        blocks, wrong = blocks + len(label), wrong + int(((score > 0) != (label > 0)).sum())
    assert blocks > 5000 and wrong < 0.02 * blocks


PLANTED = """<html><head><title>T</title><script>if (a < b) document.write("<p>no</p>")</script></head><body>
<div class="cookie-banner consent">We use cookies. <a href="#">OK</a></div>
<ul class="navigation"><li><a href="/">Home</a><li><a href="/n">News</a></ul>
<div class="article-body"><h1>Tom &amp; J&eacute;r&#244;me</h1>
<p>First   paragraph\nwith <b>bo</b>ld and <a href="x">a link</a>, and enough words to be text.
<p>Second one &lt;not a tag&gt;&nbsp;here, which also goes on for a while, as texts do.</p>
<form class="newsletter"><label>Mail</label><input><button>Send</button></form>
<p>Third paragraph, behind the form, that ends what there is to say on this page.</p></div>
<div class="comments"><h3>Comments</h3><div class="comment"><p>I do not agree with anything that was said above, not at all.</p></div></div>
<footer>&copy; 2024 Example <a href="/i">Imprint</a></footer></body></html>"""


def test_planted_page(model):
    assert extraction.main_texts(model, [PLANTED]) == [
        "Tom & Jérôme First paragraph with bold and a link, and enough words to be text. Second one <not a tag> here, which also goes on for "
        "a while, as texts do. Third paragraph, behind the form, that ends what there is to say on this page."]


def test_reader():
    read = lambda h: [b.text for b in blocks_of(h)]
    assert read("<p>a<p>b<li>c<li>d") == ["a", "b", "c", "d"]
    assert read("x<b>y</b>z<br>w<!-- <p>n -->v") == ["xyz", "wv"]
    assert read("<SCRIPT>a<b</SCRIPT >t<style>p{}") == ["t"]
    assert read("<title>a <b> &amp;</title>&am &amp &notit; &#65;") == ["a <b> &", "&am & ¬it; A"]
    assert read('<a title="x>y">t</a><img alt="<p>">u <1 < 2') == ["tu <1 < 2"]
    assert read('<p title="open>t') == ["t"]
    assert read("</div></p>a</b>") == ["a"]
    assert read("<table><tr><td>a<td>b<tr><td>c</table>d") == ["a", "b", "c", "d"]
    paths = [tuple(w[0] for w in b.path) for b in blocks_of("<table><tr><td>a<td>b<tr><td>c</table><div>e")]
    assert paths == [("<table", "<tr", "<td")] * 3 + [("<div",)]
    (b,) = blocks_of('<div class="Main-Story x" id=top><span>t')
    assert b.path == (("<div", "main", "story", "x", "top"),) and b.depth == 2
    assert read("") == [] and read(" \n ") == [] and read("<div><br></div>") == []
    long = "ab \t " * 500_000
    assert squeezed(long) == " ".join(long.split())
    assert sum(map(len, word_ids("w " * 600_000))) == 600_000
    assert len(blocks_of("<div>" * 60_000 + "x" + "<b>" * 60_000 + "y<p>z")) == 2
    assert len(blocks_of("<p>a" * 50_000)) == 50_000


def test_gradients_match_differences():
    model = Labeller(states=3)
    for p in model.parameters:
        p[...] = np.random.default_rng(1).normal(0, 0.3, p.shape)
    pages = [blocks_of("<div class=x><p>one, two<p>three.</div><nav>four"), blocks_of("<p>five six.")]
    labels = [np.array([1, 0, 1], np.float32), np.array([1], np.float32)]
    _, grads = model.step(pages, labels)
    for p, g in zip(model.parameters, grads):
        for flat in np.argsort(-np.abs(g).ravel())[:4]:
            at, e = np.unravel_index(flat, p.shape), 1e-2
            was = p[at]
            p[at] = was + e
            up = model.step(pages, labels)[0]
            p[at] = was - e
            down = model.step(pages, labels)[0]
            p[at] = was
            assert abs((up - down) / (2 * e) - g[at]) < 2e-3 + 0.05 * abs(g[at])


def test_scores_do_not_depend_on_the_pages_beside(model, pages):
    some = [blocks_of(h) for _, _, h in pages[:30]]
    together = model.scores(some)
    for page, score in zip(some, together):
        assert np.allclose(model.scores([page])[0], score, atol=1e-4)


def test_odd_rows(spark, model):
    long = "<article>" + "".join(f"<p>Paragraph {i} says a few words, and then it ends.</p>" for i in range(30_000)) + "</article>"
    rows = [(1, "u", None), (None, None, ""), (2, None, PLANTED), (2, None, PLANTED), (3, "v", "no markup at all, only a long line of text that stands here."),
            (4, "w", long), (5, "x", "<script>only"), (6, "y", "<b>" * 3000 + "é" * 300_000)]
    frame = spark.createDataFrame([(*x, "t", 9, True) for x in rows], "page_id long, url string, html string, text string, n_chars int, spot boolean")
    got = Counter(map(tuple, extraction.html_extraction(frame, model=model).collect()))
    want = [(i, u, t, len(t)) for (i, u, h), t in zip(rows, extraction.main_texts(model, [h or "" for _, _, h in rows]))]
    assert got == Counter(want) and want[5][3] > 1_000_000 and want[0][2] == want[1][2] == want[6][2] == ""
    assert extraction.html_extraction(frame.limit(0)).count() == 0
    assert extraction.html_extraction(frame.filter("page_id < 2")).collect()[0].text == ""


def test_training_without_marked_articles(pages):
    bare = [re.sub(r"</?article>", "", h) for _, _, h in pages[:40]]
    examples, labels = extraction.training_pages(bare)
    assert len(examples) == extraction.DRESSED * len(bare) and any(y.any() for y in labels) and not all(y.all() for y in labels)
    r = random.Random(1)
    assert extraction.dressed(["a"], ["b"], ["c"], r) != extraction.dressed(["a"], ["b"], ["c"], r)
