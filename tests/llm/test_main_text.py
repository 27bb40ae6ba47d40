"""Main text: known pages, made pages, odd markup, messages by enumeration."""

import html
import re
from itertools import product
from math import exp

import pytest

from termfold.llm import main_text as M


@pytest.fixture(scope="module")
def model():
    return M.trained()


def known(page):
    """Blocks of the test pages' article."""
    inside = re.search(r"<article>(.*?)(</article>|<footer|$)", page, re.S).group(1)
    blocks = re.split(r"</?(?:p|h1)>", inside)
    blocks = [" ".join(html.unescape(re.sub(r"</?b>", "", x.replace("<br>", " "))).split()) for x in blocks]
    return "\n\n".join(b for b in blocks if b)


def test_query_on_a_table(spark, sf_dir):
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    got = M.op4_main_text(spark, sf_dir).collect()
    assert len(got) == len(pages)
    for r in got:
        assert (r.text, r.n_chars, r.url) == (known(pages[r.page_id].html), len(r.text), pages[r.page_id].url)


def test_made_pages_that_were_not_seen(model):
    right = 0
    for page in M.labelled_pages(200, seed=99):
        nodes, labels = M.parse(page), []
        for i, n in enumerate(nodes):
            labels.append(1 if n.mark == "main" else 0 if n.mark == "skip" else labels[n.parent] if i else 0)
        right += all((p >= 0.5) == label for n, p, label in zip(nodes, model.marginals(nodes), labels) if n.blocks)
    assert right >= 180


@pytest.mark.parametrize("page", [
    "<article><h1>A title</h1><p>One sentence here.</p><aside><p>More</p></aside></article>",
    "<div class=menu><a href=x>x</a></div><div class=content><p>Text, and text.</p></div>",
])
def test_marginals_equal_enumeration(model, page):
    nodes = M.parse(page)
    own = [sum(model.unary.get(f, 0.0) for f in o) for o in M.observations(nodes)]
    weight, total = [0.0] * len(nodes), 0.0
    for labels in product((0, 1), repeat=len(nodes)):
        w = sum(u for u, x in zip(own, labels) if x) + sum(model.potential(n)[labels[n.parent]][x] for n, x in zip(nodes[1:], labels[1:]))
        total += exp(w)
        for i, x in enumerate(labels):
            weight[i] += exp(w) * x
    assert model.marginals(nodes) == pytest.approx([w / total for w in weight])


def test_parts_of_a_page(model):
    page = """<html><body><header><h1>Site</h1></header><nav><ul><li><a href=a>A</a></li><li><a href=b>B</a></li></ul></nav>
      <div class="cookie-banner"><p>We use cookies, please accept.</p></div>
      <article><h1>Title &amp; more</h1><p>First  paragraph,<br>with &#233; and <b>bold</b> text.<p>Second one.
      <script>var t = "</p>";</script><style>p{}</style><!-- gone --><div class="advertisement"><p>Buy now, it is cheap.</p></div></article>
      <section class="comments"><h3>Comments</h3><p>I like it, very much.</p></section>
      <form><p>Subscribe to our letter.</p><input></form><aside class=sidebar><p>Popular stories.</p></aside>
      <footer><p>Copyright, all rights.</p></footer></body></html>"""
    assert model.text(page) == "Title & more\n\nFirst paragraph, with é and bold text.\n\nSecond one."


def test_odd_pages(spark, model):
    long_page = "<article><h1>T</h1>" + "<p>Some words, here and there.</p>" * 20_000 + "</article>"
    rows = [(1, "u", None), (2, None, ""), (3, "u", "<p>Only this text here.</p><p>And that one.</p>"), (None, "u", "<<<>&&&"), (4, "u", "<script>never closed"),
            (5, "u", long_page), (6, "u", "<div " * 500), (7, "u", "<b><i></p></b>x</i>"), (1, "u", None), (8, "u", "<div>" * 3000 + "deep")]
    schema = "page_id long, url string, html string, text string, n_chars string"
    df = spark.createDataFrame([(*r, "clash", "clash") for r in rows], schema)
    got = M.extract(df).collect()
    assert len(got) == len(rows)
    by = {r.page_id: r for r in got}
    assert (by[1].text, by[1].n_chars, by[2].text, by[4].text) == ("", 0, "", "")
    assert by[3].text == "Only this text here.\n\nAnd that one."
    assert by[5].text.count("Some words") == 20_000
    assert M.extract(spark.createDataFrame([], schema)).collect() == []


@pytest.mark.parametrize("page", [
    "<b>" * 100_000 + "</i>" * 100_000, "<p><table>" + "<b>" * 50_000 + "<h1>x" * 50_000, "<ul>" + "<b>" * 50_000 + "<li>x" * 50_000, "<li>" * 100_000 + "</ul>" * 100_000])
def test_deep_pages_take_linear_time(page):
    import time

    from termfold.llm.main_text import parse

    start = time.process_time()
    parse(page)
    assert time.process_time() - start < 5
