from __future__ import annotations

import html
import random
import re

from brute import SF_SMALL

from eventlake.llm import op3_html_text as op3

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{margin:0}</style></head><body class="has-sidebar no-header">
<header><h1>Site</h1><a href=x>Home</a></header><div id="cookie-notice">We use cookies. Accept all of these cookies please.</div>
<div class="wrapper with-sidebar"><main><article><header><h1>Title of it</h1></header>
<p>First   paragraph with <a href=q>a link</a> &amp; text,&#32;long enough &lt;b&gt;.<p>Second&nbsp;one.<br>Still<!-- no --> it.
<div class="advert">Buy this thing now, it is really great. Really.</div><ul><li>item one<li>item two of list</ul>
<table><tr><td>cell a<td>cell b</table><script>var a="<p>x</p>";</script><aside>Side remark here.</aside><p>Last one.</article>
<section id="comments"><h2>Comments</h2><article><p>I like this article very much indeed, thanks for writing it.</p></article></section>
</main><div class="sidebar"><p>Popular posts of the week that you should read now.</p></div></div>
<footer><p>Copyright by us. All rights reserved.</p></footer><form><p>Subscribe to us</p><input></form></body></html>"""


def test_page_parts():
    assert op3.main_text(PAGE).split("\n") == [
        "Title of it", "First paragraph with a link & text, long enough <b>.", "Second one. Still it.",
        "item one", "item two of list", "cell a", "cell b", "Last one.",
    ]


def test_special_pages():
    assert op3.main_text(None) == op3.main_text("") == op3.main_text("<p></p><script>x") == ""
    assert op3.main_text("<p>a < b and 3<4 &am") == "a < b and 3<4 &am"
    assert op3.main_text("Plain text only. It has no markup at all.") == "Plain text only. It has no markup at all."
    for bad in ("<div>" * 5000, '<a "' * 5000, "<" * 9000, "<!--" * 5000, "</p>" * 3000, "<p><b>" * 2000 + "x y"):
        op3.main_text(bad)


def test_min_cut_is_minimal():
    rng = random.Random(5)
    for _ in range(150):
        n = rng.randint(1, 8)
        score = [rng.randint(-9, 9) for _ in range(n)]
        edges = [(a, b, rng.randint(0, 6)) for a in range(n) for b in range(a) if rng.random() < 0.4]

        def cost(side):
            own = sum(max(0, s) if not k else max(0, -s) for s, k in zip(score, side, strict=True))
            return own + sum(w for a, b, w in edges if side[a] != side[b])

        best = min(cost([bool(m >> i & 1) for i in range(n)]) for m in range(1 << n))
        assert cost(op3.min_cut(score, edges)) == best


def test_smoothness_moves_a_label():
    short = "<p>Short.</p>"
    assert op3.main_text(f"<div><p>{'word ' * 40}.</p>{short}<p>{'word ' * 40}.</p></div>").count("\n") == 2


def test_query_on_table(spark):
    """The synthetic pages: every article is exactly its headline and paragraphs."""
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()}
    for r in op3.op3_html_text(spark, SF_SMALL).collect():
        inner = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S)[1]
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
        assert r.text == "\n".join(p for p in parts if p)
        assert r.n_chars == len(r.text)


def test_table_special_rows(spark):
    rows = [(1, "u", None, 7), (1, "u", "", 7), (None, None, "<p>Some text that is there.</p>", 7), (2, "v", "<p>A sentence here.</p>" * 3000, 7)]
    got = op3.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text int")).collect()
    assert len(got) == 4
    assert sorted(r.n_chars for r in got)[:2] == [0, 0]
    assert next(r for r in got if r.page_id == 2).text.count("\n") == 2999
    assert op3.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0

ARTICLE = "<h1>A plain title</h1><p>The first paragraph of it says a little.</p><p>The second one says more than that.</p><p>A third ends it.</p>"
TEXT = "A plain title\nThe first paragraph of it says a little.\nThe second one says more than that.\nA third ends it."


def test_words_on_containers_of_the_article():
    for page in (
        f'<div class="layout has-sidebar">{ARTICLE}</div>',
        f'<div class="no-sidebar">{ARTICLE}</div>',
        f'<div id="pages">{ARTICLE}</div>',
        f'<div class="comments-open"><article>{ARTICLE}</article></div>',
        f'<article class="book-reviews">{ARTICLE}</article>',
        f'<article><div class="related-topics-text">{ARTICLE}</div></article>',
        f'<div class="share"><div class="widget">{ARTICLE}</div></div>',
    ):
        whole = f'<body><nav><a href=x>Home</a></nav>{page}<footer><p>All rights reserved by us.</p></footer></body>'
        assert op3.main_text(whole) == TEXT, page


def test_marked_parts_beside_the_article():
    long = "<p>" + "A reader wrote this at some length, more than the article has. " * 9 + "</p>"
    for part in ('<div id="secondary">', '<section class="comments">', '<div class="related-posts">', '<div class="comment-list"><article>'):
        for page in (f"<article>{ARTICLE}</article>{part}{long}</div>", f'<div class="post">{ARTICLE}</div>{part}{long}</div>'):
            assert op3.main_text(f"<body>{page}</body>") == TEXT, (part, page[:20])
