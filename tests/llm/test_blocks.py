import html
import re
from itertools import product

import numpy as np
import pytest
from wattloom.llm import blocks

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def field(spark):
    return blocks.fit(spark.read.parquet(f"{SF}/pages.parquet"))


def article(page):
    """The article of the table's pages, cut out by hand."""
    inner = page[page.index("<article>") + 9 :].split("</article>")[0].split("<footer>")[0]
    found = (" ".join(html.unescape(re.sub(r"<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", inner))
    return "\n\n".join(x for x in found if x)


def test_articles_of_the_table(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r["page_id"]: r for r in blocks.extracted(pages).collect()}
    truth = {r["page_id"]: article(r["html"]) for r in pages.collect()}
    assert len(got) == len(truth) and all(r["n_chars"] == len(r["text"]) for r in got.values())
    assert np.mean([got[i]["text"] == t for i, t in truth.items()]) > 0.99


PAGE = """<html><head><title>T</title><style>p{}</style></head><body class=page><header><h1>Site name</h1><nav><a href=1>Home</a></nav></header>
<div class="cookie-notice"><p>We use cookies to improve your visit to this site.</p></div>
<article><h1>The real title of this page</h1><p>First <b>bold</b> text &amp; more words, going on.<br>Next line here.</p><script>var x = "</p>";</script>
<aside><p>Related: other stories you may like to read today.</p></aside><p>Last paragraph ends here.<p>Unclosed one follows it.
<section class="comments"><h2>Comments</h2><p>I like this very much, thanks for writing it.</p></section>
<form><label>Email</label><button>Send</button></form><div class="ad">Buy this thing now.</div></article>
<div id="sidebar"><p>Popular posts and many other things to see.</p></div><footer><p>&copy; 2020 Someone</p></footer></body></html>"""
MAIN = (
    "The real title of this page\n\nFirst bold text & more words, going on. Next line here.\n\n"
    "Last paragraph ends here.\n\nUnclosed one follows it."
)


def test_clutter_the_table_lacks(field):
    assert field.extract(PAGE) == MAIN
    hidden = field.extract(PAGE.replace("article>", "div>"))
    assert "First bold text" in hidden and "cookies" not in hidden and "thanks for writing" not in hidden and "Someone" not in hidden


def test_leaf_blocks():
    found = blocks.leaf_blocks("<ul><li>one<li>two <a href='x'>link</a></ul><p>a&nbsp;&lt;b&gt;&#233;<p>c<!-- no --><br>d<table><tr><td>e<td>f</table>g &unknown; &am")
    assert [b.text for b in found] == ["one", "two link", "a <b>é", "c d", "e", "f", "g &unknown; &am"]
    assert found[1].linked == 4 and found[0].tags == ("ul", "li") and found[5].tags == ("table", "tr", "td") and found[6].tags == ()
    assert [b.text for b in blocks.leaf_blocks("<script>x</script><p>kept<style>never closed")] == ["kept"]
    assert blocks.leaf_blocks("") == [] and [b.text for b in blocks.leaf_blocks("plain < text")] == ["plain < text"]


def test_viterbi_and_likelihood_by_enumeration(field):
    rows = blocks.active(blocks.leaf_blocks(PAGE))[:9]

    def score(labels):
        total = sum(field.weights[f, y] for found, y in zip(rows, labels, strict=True) for f in found)
        return total + sum(field.steps[a, b] for a, b in zip(labels, labels[1:]))

    assert list(max(product((0, 1), repeat=len(rows)), key=score)) == field.labels(rows)


def test_training_raises_the_likelihood():
    rng = np.random.default_rng(0)
    pages = [([[0] if y else [1] for y in labels], labels) for labels in (rng.integers(0, 2, 6).tolist() for _ in range(30))]
    long = [([[0]] * 250, [1] * 250)]
    field = blocks.Field().fit(pages + long)
    assert all(field.labels(x) == y for x, y in pages + long)


def test_odd_pages(spark, field):
    rows = [(1, None, None, 1), (2, "u", "", 2), (None, "u", "<p>x", 3), (3, "u", "<div>" * 3000 + "deep", 4), (4, "u", "<article><p>" + "word " * 100_000, 5), (4, "u", "<", 6)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = blocks.main_text(pages, field).collect()
    assert len(got) == 6 and all(r["n_chars"] == len(r["text"]) for r in got)
    assert [r["n_chars"] for r in got if r["text"].startswith("word")] == [499_999]
    assert blocks.extracted(pages.where("false")).count() == 0 and blocks.extracted(pages.where("page_id = 2")).first()["text"] == ""


def test_only_closed_elements_hide_their_text():
    texts = lambda page: [b.text for b in blocks.leaf_blocks(page)]
    for odd in ("<svg-icon a=1></svg-icon>", "<video-player></video-player>", "<svg width=1 />", "<svg/>", "<math/>", "<video src=x>", "<object data=x>", "<canvas>", "<title-bar></title-bar>"):
        assert texts(f"<p>one {odd}two<p>three") == ["one two", "three"], odd
        assert texts(f"<p>one {odd}two<p>three<svg>no</svg><video>no</video><object>no</object><canvas>no</canvas>") == ["one two", "three"], odd
    assert texts("<p>let <math><mi>x</mi><mo>=</mo><mn>1</mn></math> be<p>next") == ["let x=1 be", "next"]
    assert texts("<p>a<svg><svg><text>no</text></svg><title/><style/><text>no</text></svg>b<p>c") == ["ab", "c"]
    assert texts("<p>a<script>var s = '<video>';</script>b<p>c<video>no</video><!-- <object> -->d<object>no</object>") == ["ab", "cd"]
    assert texts("<p>kept<script>never closed <p>x") == ["kept"]


def test_hidden_is_an_attribute_of_its_own():
    hints = lambda rest: blocks.leaf_blocks(f"<div {rest}>text</div>")[0].hints
    for rest in ('class="overflow-hidden"', 'style="overflow: hidden"', 'aria-hidden="false"', "data-hidden=1", "title='not hidden'", "data-x='display:none'"):
        assert "hidden" not in hints(rest), rest
    for rest in ("hidden", 'hidden=""', "a=1 hidden", "aria-hidden=true", "ARIA-HIDDEN='true'", 'style="color: red; display: none"'):
        assert "hidden" in hints(rest), rest


@pytest.mark.parametrize(
    "attributes",
    ['class="has-sidebar"', 'class="single-post comments-open"', 'class="no-js cookie-free"', 'class="page top"', 'style="display:none"', 'id=sidebar'],
)
def test_names_of_the_body_change_nothing(spark, field, attributes):
    pages = [r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    plain, named = (sum(field.extract(p) == article(p) for p in ps) for ps in (pages, [p.replace("<body", f"<body {attributes}", 1) for p in pages]))
    assert plain == named > 0.99 * len(pages)
    inside = [p.replace("<article>", f'<div {attributes}><article class="post sidebar-left top">', 1) for p in pages[:50]]
    assert attributes.startswith("style") or sum(field.extract(p) == article(q) for p, q in zip(inside, pages, strict=False)) == 50


@pytest.mark.parametrize("name", ["meta-analysis", "tags", "author-quote", "top-story", "legal", "story-alert", "related-work", "comment-worthy"])
def test_content_with_unlucky_names(field, name):
    page = PAGE.replace("<p>Last paragraph", f'<p class="{name}">Last paragraph')
    assert field.extract(page) == MAIN
    assert "Last paragraph ends here." in field.extract(page.replace("article>", "div>"))


def test_pages_without_an_article_element(spark, field):
    pages = [r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    for wrap in ("div", "section"):
        got = [field.extract(p.replace("article>", f"{wrap}>")) == article(p) for p in pages]
        assert np.mean(got) > 0.95


def test_comments_that_are_articles(field):
    comments = '<div class="comments-area"><ol class="comment-list"><li><article class="comment"><p>I like this very much, thanks for writing it.</p></article></ol></div>'
    assert field.extract(PAGE.replace("</article>", "</article>" + comments)) == MAIN


def test_many_unclosed_inline_elements_take_linear_time():
    import time

    def seconds(n):
        started = time.process_time()
        assert len(blocks.leaf_blocks("<p>" + "<font>a <b>b</b></i>" * n + "<p>x" * n)) == n + 1
        return time.process_time() - started

    seconds(100)
    assert seconds(40_000) < 30 * max(0.05, seconds(4_000))
