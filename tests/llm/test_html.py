import html as stdlib_html
import re

import numpy as np
import pytest

from entrygraph.llm import catalog, html, site
from tests.oracle import DATA, PRESENT


def texts(page):
    return [t for _, t, _ in html.read(page)[0]]


def test_blocks_of_broken_markup():
    page = "<title>T &amp; U</title><body><p><b>one<br>two<p>three</b> <i>four\n five</i><div>six<script>var a='</p>';</script> seven</div>&lt;eight&gt; &euro;<ul><li>a<li>b</ul><hr>tail"
    blocks, title = html.read(page)
    assert title == "T & U"
    assert [t for _, t, _ in blocks] == ["one two", "three four five", "six seven", "<eight> €", "a", "b", "tail"]
    assert [tag for tag, _ in blocks[1][0]] == ["body", "p"]


def test_odd_pages():
    assert texts(None) == texts("") == texts("<script>a") == texts("<title>x</title><!-- y -->") == []
    assert texts("<p>cut &am") == ["cut &am"]
    assert texts("plain text") == ["plain text"]
    assert texts("<style>p{}</style><body>a<template>b</template>c") == ["ac"]
    assert texts("<div>" * 3000 + "deep") == ["deep"]
    assert texts("<b>" * 3000 + "deep<p>more") == ["deep", "more"]
    assert len(texts("<p>x" * 20_000)) == 20_000


def test_gradients_agree_with_differences():
    read = [html.labelled(p) for p in site.invented(3, 5)]
    model = html.Labeller(3)
    model.w["word"] += 0.01
    pages, labels = [p for p, _ in read], [y for _, y in read]
    shown = (np.arange(sum(map(len, pages))) % 3 > 0).astype(float)
    grads, _ = model.gradients(pages, labels, shown)
    rng = np.random.default_rng(1)
    for name in ("fx", "fh", "fb", "bx", "bh", "bb", "out", "bias", "path", "word"):
        w = model.w[name]
        places = np.argwhere(grads[name]) if name in ("path", "word") else np.argwhere(np.ones_like(w))
        for at in places[rng.choice(len(places), min(4, len(places)), replace=False)]:
            at, loss = tuple(at), []
            for step in (1e-5, -2e-5):
                w[at] += step
                loss.append(model.gradients(pages, labels, shown)[1])
            w[at] += 1e-5
            assert abs((loss[0] - loss[1]) / 2e-5 - grads[name][at]) < 1e-6


@pytest.fixture(scope="module")
def model():
    return html.fitted()


def test_pages_not_seen_before(model):
    read = [html.labelled(p) for p in site.invented(300, 99)]
    right = [(p >= html.KEEP_FROM) == (y > 0.5) for p, (_, y) in zip(model.predict([a for a, _ in read]), read)]
    assert np.concatenate(right).mean() > 0.99 and np.mean([r.all() for r in right]) > 0.9


def test_a_page_built_by_hand(spark, model):
    page = """<html><head><title>A long walk</title></head><body class="home"><header><a href="/">The Daily Walk</a></header>
      <nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li></ul></nav>
      <div class="cookie-banner"><p>We use cookies to improve this site.</p><button>Accept</button></div>
      <article><h1>A long walk</h1><p>We left at dawn, and the <a href="#">valley</a> was still dark.</p>
      <div class="ad">Buy our boots now!</div><h2>The way up</h2><ul><li>Two hours of forest.</li><li>One hour of scree.</li></ul>
      <p>Nobody was there.</p></article>
      <section class="comments"><h3>2 comments</h3><div class="comment"><cite>Ada</cite><p>What a lovely walk, I did it too last summer with my dog.</p></div></section>
      <aside class="sidebar"><h3>Related</h3><ul><li><a href="/c">Another walk</a></li></ul></aside>
      <footer>&copy; The Daily Walk. All rights reserved.</footer></body></html>"""
    want = "A long walk\nWe left at dawn, and the valley was still dark.\nThe way up\nTwo hours of forest.\nOne hour of scree.\nNobody was there."
    pages = spark.createDataFrame([(1, "u", page, "x"), (2, None, None, "y"), (3, "w", "", "z"), (1, "u", page, "x")], "page_id long, url string, html string, text string")
    rows = sorted(html.main_text(pages, model).collect(), key=lambda r: r.page_id)
    assert [(r.page_id, r.url, r.text, r.n_chars) for r in rows] == [(1, "u", want, len(want)), (1, "u", want, len(want)), (2, None, "", 0), (3, "w", "", 0)]
    assert html.main_text(pages.limit(0), model).count() == 0
    blocks = html.blocks_of(pages.limit(1), model).collect()
    assert "\n".join(r.text for r in blocks if r.kept) == want and len(blocks) == 18


@pytest.mark.skipif(not PRESENT, reason="needs the driver's tables")
def test_query_against_the_articles(spark, model):
    """These pages hold their articles in a tag of that name, which a plain pattern finds."""
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{DATA}/pages.parquet").collect()}
    rows = catalog.queries()["op13_main_text"](spark, DATA).collect()
    assert len(rows) == len(pages)
    for r in rows:
        inside = pages[r.page_id].split("<article>")[1].split("</article>")[0]
        blocks = [" ".join(stdlib_html.unescape(re.sub(r"<[^>]+>", " ", part)).split()) for part in re.split(r"</?(?:p|h1)>", inside)]
        want = "\n".join(b for b in blocks if b)
        assert r.text == want and r.n_chars == len(want)
