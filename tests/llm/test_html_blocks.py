import time
from html import unescape

import numpy as np
import pytest

from linkrank.llm import html_blocks, registry
from linkrank.llm.html_blocks import Labeller, Vectors, blocks_of, training_page, weak_labels

FOLDER = "/root/testdata/sf0.01"


def texts(page):
    return [b.text for b in blocks_of(page)]


def test_blocks():
    assert texts("") == [] and texts(" \n ") == []
    assert texts("plain &amp; simple") == ["plain & simple"]
    assert texts("<p>a<b>b</b> c<br>d</p>e<div>f<p>g<p>h</div>") == ["ab c d", "e", "f", "g", "h"]
    assert texts("<script>if (a</b) '<p>no</p>'</script><style>p{}</style>x<!-- <p>no</p> -->y") == ["xy"]
    assert texts("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>") == ["a", "b", "c", "d"]
    assert texts('<a href="x>y" title=\'<p>\'>t</a> < 5 &lt; 6 &copy; &#233;&nbsp;z') == ["t < 5 < 6 © é z"]
    assert texts("<p>&am</p><p>&bogus; &#x41;</p></div></p>") == ["&am", "&bogus; A"]
    assert texts("<script>never ends <p>x") == [] and texts("<!-- never ends") == []
    nested = blocks_of('<body><div class="a b"><span><p id=c>t</p></span></div>')[0]
    assert nested.path == ("body", "div class=a b", "p id=c")
    linked = blocks_of("<p>ab<a>cd</a></p><p><a>ef<p>gh</p>")
    assert [b.linked for b in linked][:2] == [2, 2]


def test_deep_and_long_pages():
    deep = "<div>" * 5_000 + "x" + "</div>" * 5_000
    assert texts(deep) == ["x"]
    assert len(texts("<p>a</p>" * 20_000)) == 20_000


HOSTILE = {
    "unclosed tags": "<div" * 1, "open elements": "<div>x", "inline elements": "<b>x", "closers": "</p>x", "closers of open ones": "<div><b></div>x", "quotes": "<p title=\"x>", "single quotes": "<p '>x<i \">",
    "comments": "<!-- x", "declarations": "<!x", "cdata": "<![CDATA[x", "raw": "<script>x", "raw closers": "<svg/><script", "paragraphs": "<b><p>", "items": "<li><b>", "cells": "<td></b>x", "less": "<<<", "references": "&am&#x;",
    "links": "<a href=x>y", "paragraphs in inline ones": "<p></p>x",
}


@pytest.mark.parametrize("kind", HOSTILE)
def test_hostile_pages_take_linear_time(kind):
    """A megabyte of the worst, alone, after many open inline elements, and with everything closed at the end, takes two seconds, or on a slow
    machine a small multiple of an ordinary page of that size."""
    began = time.process_time()
    blocks_of("<p>x</p>" * (1 << 17))
    limit = max(2, 4 * (time.process_time() - began))
    for before, after in (("", ""), ("<div>" + "<b>" * 50_000, ""), ("<p>y", "</p>-->]]></script>\"'>z")):
        page = before + HOSTILE[kind] * ((1 << 20) // len(HOSTILE[kind])) + after
        began = time.process_time()
        found = blocks_of(page)
        Vectors().path(found[-1].element if found else None)
        assert time.process_time() - began < limit


def test_broken_attributes_and_formulas():
    assert texts('<p title="it>bad') == ["bad"] and texts("<p class='a>b</p><p>c") == ["b", "c"]
    assert texts('<p title="a>b" id=x>c') == ["c"] and texts("x < y <p") == ["x < y <p"] and texts("a <3 b") == ["a <3 b"]
    assert texts("<p>so <math><mi>a</mi><mo>&lt;</mo><mn>2</mn></math> and then</p>") == ["so a<2 and then"]


def test_the_whole_path_counts():
    """What stands outermost is seen below any number of wrappers."""
    for depth in (1, 13, 200):
        comment, article = (blocks_of(f"<{tag}>{'<div>' * depth}<p>t")[0] for tag in ("section class=comments", "article"))
        assert len(comment.path) == depth + 2
        a, b = (set(Vectors().path(x.element).tolist()) for x in (comment, article))
        assert a - b and b - a


def test_a_hot_null_id_does_not_make_up_the_sample(spark, monkeypatch):
    rows = [(None if k % 3 == 0 else k, "u", f"<article><p>page {k}</p></article>") for k in range(3000)] + [(7, "u", "<article><p>page 7</p></article>")] * 500
    seen = []
    monkeypatch.setattr(Labeller, "train", lambda self, pages, **_: seen.append(pages))
    html_blocks.learn(spark.createDataFrame(rows, "page_id long, url string, html string"), sample_pages=300)
    real = [b[0].text for b, _ in seen[0] if b and b[0].text.startswith("page ") and len(b) == 1 and b[0].path == ("article", "p")]
    hot = sum(int(t.split()[1]) % 3 == 0 for t in set(real))
    assert 200 < len(set(real)) < 420 and 0.2 < hot / len(set(real)) < 0.47
    html_blocks.learn(spark.createDataFrame(rows, "page_id long, url string, html string"), sample_bytes=3000)
    assert len({b[0].text for b, _ in seen[1] if b and b[0].path == ("article", "p")}) < 200


def test_registered_query(spark):
    folder = "/root/testdata/sf0.001"
    frame = registry.op3_html_blocks(spark, folder)
    assert frame.columns == ["page_id", "url", "text", "n_chars"]
    pages = {r.page_id: r for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    found = frame.collect()
    assert len(found) == len(pages)
    for r in found:
        article = pages[r.page_id].html.split("<article>")[1].split("</article>")[0]
        assert "".join(r.text.split()) == "".join(unescape("".join(x.split(">", 1)[-1] for x in article.split("<"))).split())
        assert r.n_chars == len(r.text) and r.url == pages[r.page_id].url


def test_gradient():
    rng = np.random.default_rng(1)
    pages = [training_page(rng, ["some words to take from here"])[0][:6] for _ in range(3)]
    labeller = Labeller()
    labeller.w = {k: v.astype(np.float64) for k, v in labeller.w.items()}
    x, sizes = Vectors().fill(pages)
    x, y = x.astype(np.float64), (rng.random(x.shape[:2]) > 0.5).astype(float)
    _, grad = labeller.gradient(x, sizes, y)
    for k, g in grad.items():
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        kept, losses = labeller.w[k][at], []
        for step in (1e-3, -1e-3):
            labeller.w[k][at] = kept + step
            losses.append(labeller.gradient(x, sizes, y)[0])
        labeller.w[k][at] = kept
        assert (losses[0] - losses[1]) / 2e-3 == pytest.approx(g[at], rel=1e-3, abs=1e-6)


def test_labels_depend_on_the_whole_page_and_not_on_the_company():
    labeller, vectors, rng = Labeller(seed=3), Vectors(), np.random.default_rng(2)
    pages = [training_page(rng, ["some words to take from here"])[0] for _ in range(8)]
    alone = [labeller.forward(*vectors.fill([p]))[0][: len(p)] for p in pages]
    x, sizes = vectors.fill(pages)
    for row, size, one in zip(labeller.forward(x, sizes), sizes, alone, strict=True):
        np.testing.assert_allclose(row[:size], one, atol=1e-4)


def test_main_text_of_the_test_pages(spark):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet")
    odd = spark.createDataFrame([(-1, None, None), (None, "u", ""), (-2, "u", "<nav><a href='/'>Home</a></nav>"), (-2, "u", "<nav><a href='/'>Home</a></nav>")], "page_id long, url string, html string")
    labeller = html_blocks.learn(pages)
    found = {r.page_id: r for r in html_blocks.extract(pages.unionByName(odd), labeller).collect()}
    for r in pages.collect():
        article = r.html.split("<article>")[1].split("</article>")[0]
        assert "".join(found[r.page_id].text.split()) == "".join(unescape("".join(x.split(">", 1)[-1] for x in article.split("<"))).split())
        assert found[r.page_id].n_chars == len(found[r.page_id].text) and found[r.page_id].url == r.url
    assert found[-1].text == found[None].text == found[-2].text == ""
    # parts of kinds that the test pages lack
    rng, right, all_ = np.random.default_rng(77), 0, 0
    words = [b.text for r in pages.limit(20).collect() for b in blocks_of(r.html)]
    made = [training_page(rng, words) for _ in range(200)]
    for y, (_, main) in zip(labeller.label([b for b, _ in made], Vectors()), made, strict=True):
        right, all_ = right + int((y == main).sum()), all_ + len(main)
    assert right / all_ > 0.97


def test_empty_table(spark):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert html_blocks.extract(none, Labeller()).count() == 0


def test_weak_labels():
    blocks = blocks_of("<nav>m</nav><article><p>t</p><div class='ad'>x</div></article><footer>f</footer>")
    assert weak_labels(blocks).tolist() == [False, True, False, False]
    assert weak_labels(blocks_of("<p>t</p>")) is None
