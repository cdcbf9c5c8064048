import html
import re
import time
import tracemalloc
from collections import Counter

import pytest
from pyspark.sql import functions as F

from orderflow.llm import html_extract as H
from orderflow.llm.common import table

PAGE = """<!doctype html><html><head><title>x</title><script>if (a < b) { "</p>" }</script></head><body class="has-sidebar">
<header><h1>Site</h1><nav><a href=/>home</a></nav></header><div class="cookie-notice"><p>We use cookies a lot here</p></div>
{open}<h2 class="post-header">Title  here</h2><p>First para<em>graph</em> text &amp; more&hellip;<p>Second one with
<a href="x>y">link text</a> and words<div class="ad-slot"><p>Buy now cheap</p></div><p>Third para.</p><ul><li>one</li><li>two</li></ul>
<form><label>Mail</label><input name=q></form><!-- <p>no</p> --><blockquote>Said &#233;&lt;b&gt;</blockquote>{close}
<aside class=sidebar><p>Related stuff many words</p></aside><section id="comments"><p>Nice post! really</p></section>
<div role="navigation">next page</div><div class="ad">Buy</div><footer><p>copyright 2020</p></footer></body></html>"""
WANT = "Title here First paragraph text & more… Second one with link text and words Third para. one two Said é<b>"


@pytest.mark.parametrize(("opening", "closing"), [("<article class='post with-comments'>", "</article>"), ("<main>", "</main>"), ("<div id=content>", "</div>")])
def test_article_without_the_rest(opening, closing):
    page = PAGE.replace("{open}", opening).replace("{close}", closing)
    assert H.extract(page, H.Weights({})) == WANT
    assert H.extract(page, H.Weights(H.count_words(PAGE.replace("{open}", "<article>").replace("{close}", "</article>")))) == WANT


def truth(page):
    inner = page[page.index("<article>") + 9:page.index("</article>")]
    inner = re.sub(r"<(?:p|br|h1|/p|/h1)>", " \0 ", inner)
    return " ".join(html.unescape(re.sub(r"<[^>\0]*>", "", inner)).replace("\0", " ").split())


@pytest.mark.parametrize("size", ["0.001", "0.01"])
def test_all_pages_of_the_table(llm_spark, size):
    pages = table(llm_spark, f"/root/testdata/sf{size}", "pages")
    want = {r["page_id"]: truth(r["html"]) for r in pages.collect()}
    got = H.extract_text(pages).collect()
    assert {r["page_id"]: r["text"] for r in got} == want
    assert all(r["n_chars"] == len(r["text"]) for r in got)


@pytest.mark.parametrize("page", ["", "<", "<p", "<!--", "<script>", "</p></p>", "<p '>x", "<a b='", "&", "&#xFFFFFFF;", "<p>" * 3000 + "x", "<div>" * 2000, "<b>" * 500 + "y" + "</b>" * 600])
def test_odd_pages(page):
    text = H.extract(page, H.Weights({}))
    assert isinstance(text, str) and "<p" not in text


def test_best_run():
    assert H.best_run([]) == H.best_run([-1.0, 0.0]) == (0, 0)
    assert H.best_run([1, -2, 3, -1, 3, -9, 4]) == (2, 5)
    assert H.best_run([2, -3, 2]) == (0, 1)  # of equal runs the first


def test_nulls_repeated_rows_clashing_columns_and_empty_tables(llm_spark):
    rows = [(1, None, None), (2, "u", ""), (3, "u", "<article><p>Hi&nbsp;there</article>"), (3, "u", "<article><p>Hi&nbsp;there</article>"), (None, None, "<nav>x</nav>")]
    df = llm_spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'c' AS text", "1 AS n_chars")
    got = sorted(map(tuple, H.extract_text(df).collect()), key=str)
    assert got == sorted([(1, None, "", 0), (2, "u", "", 0), (3, "u", "Hi there", 8), (3, "u", "Hi there", 8), (None, None, "", 0)], key=str)
    assert H.extract_text(df.limit(0)).count() == 0


def test_long_page():
    page = "<article>" + "<p>some words here</p>" * 100_000 + "</article><footer>x</footer>"
    assert len(H.extract(page, H.Weights({})).split()) == 300_000


BODY = "".join(f"<p>Body words number {i} of the long main text</p>" for i in range(30))
BODY_TEXT = " ".join(f"Body words number {i} of the long main text" for i in range(30))
COMMENTS = "".join(f"<article class='comment' id='comment-{i}'><p>Nice post from reader {i} indeed</p></article>" for i in range(8))
TEASERS = "".join(f"<article class='teaser'><h3><a href=/{i}>Read also story {i}</a></h3></article>" for i in range(5))


@pytest.mark.parametrize("page", [
    f"<body><main><h1>Head</h1>{BODY}</main>{COMMENTS}{TEASERS}</body>",
    f"<body>{TEASERS}<main><h1>Head</h1>{BODY}</main><section class=comments>{COMMENTS.replace('class', 'data-x')}</section></body>",
    f"<body>{TEASERS}<div><h1>Head</h1>{BODY}</div>{COMMENTS}</body>",
    f"<body><div><h1>Head</h1>{BODY}</div><aside><article><p>Read also this</p></article></aside></body>",
    f"<body><main><h1>Head</h1>{BODY}{TEASERS}{COMMENTS}</main></body>",
    f"<body><article class='post category-advertising' id=newsletter-changes><h1>Head</h1>{BODY}{COMMENTS}</article>{TEASERS}</body>"])
def test_articles_that_are_comments_or_teasers(page):
    for counts in ({}, H.count_words(page), H.count_words(PAGE.replace("{open}", "<article>").replace("{close}", "</article>"))):
        assert H.extract(page, H.Weights(counts)) == f"Head {BODY_TEXT}"


def test_labels_count_the_content_not_its_teasers():
    side = "<article><p class=x>one two</p></article>"
    for page in (f"<main><p class=y>{BODY}</p></main>{side}", f"<main>{side}<div class=y>{BODY}</div></main>{side}", f"{side}<article><div class=y>{BODY}</div></article>"):
        counts = H.count_words(page)
        assert counts["w", "p", 1] >= 240 and not counts["w", "div.y", 0] and not counts["w", "p.y", 0]
        assert counts["w", "p.x", 0] == 2
    assert H.count_words(f"<div>{BODY}</div>{side}") == {}  # a small article labels nothing


@pytest.mark.parametrize(("middle", "want"), [
    ('<svg class="i"/>', ""), ("<svg/>", ""), ("<math/>", ""), ('<svg class="i">', ""), ("<math>", ""), ("<canvas id=c>", ""), ("<template>", ""),
    ("<noscript>", ""), ("<object data=x>", ""), ("<svg><title/><path d='M0'/></svg>", ""), ("<svg><title>no</title><g><text>no</text></g></svg>", ""),
    ("<svg><svg><text>no</text></svg><text>no</text></svg>", ""), ("<svg><style>p{}</style><script src=x /></svg>", ""),
    ("<p>an <svg><path d='M0'/><text>no</text></svg>icon</p>", "an icon"), ("<svg><path><p>shown</p></svg>", "shown"),
    ("<canvas>no</canvas><template><p>no</p></template><noscript>no <b>no</b></noscript>", ""), ("<!-- <svg> --><script>'<svg>'</script>", ""),
    ("<p>so <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>no</annotation></math> holds</p>", "so x=2 holds"),
    ("<xmp><b>code</b> &amp; more</xmp>", "<b>code</b> &amp; more"), ("<xmp>", ""), ("<object data=x><p>fallback text</p></object>", "fallback text"),
    ("<svg>" * 3 + "<svg><text>no</text></svg>", "")])
def test_embedded_elements_end_where_they_end(middle, want):
    page = f"<body><article><p>one</p>{middle}<p>two</p><p>three</p></article><script>var x = a<b;</script><footer><svg><text>no</text></svg><p>foot</p></footer></body>"
    for counts in ({}, H.count_words(page)):
        assert H.extract(page, H.Weights(counts)) == " ".join(f"one {want} two three".split())


SHARES = "<div class=share-prices><p>" + "Prices rose again in all markets today. " * 12 + "</p></div>"


@pytest.mark.parametrize("name", ["class=related-work", "class=social-history", "class=comments-on-law", "class=form-of-government", "class=login-guide",
                                  "class=subscription-model", "class=popup-book", "class=ad-hoc", "id=notice-of-meeting", "class=share-prices"])
def test_names_that_only_hold_a_word_of_boilerplate(name):
    page = f"<article><p>First words of it.</p><section {name}><p>Second words here.</p></section><p>Last words.</p></article>"
    assert H.extract(page, H.Weights({})) == "First words of it. Second words here. Last words."


@pytest.mark.parametrize("name", ["notice", "cookie-notice-bar", "site-header", "ad-slot", "social-links", "post-comments", "newsletter signup-box", "related-posts", "sidebar2"])
def test_names_of_boilerplate(name):
    page = f"<article><p>First words of it.</p><div class='{name}'><p>Second words here.</p></div><p>Last words.</p></article>"
    assert H.extract(page, H.Weights({})) == "First words of it. Last words."


def test_labels_overrule_names():
    """A section of a boilerplate name that holds much of the labelled articles is content, an advert among them is not."""
    page = ("<body><article><p>First words of it.</p><section class=notice><p>" + "The notice tells at length what the board has decided. " * 12
            + "</p></section><div class=ad-slot><p>Buy now</p></div><p>Last words.</p></article><div class=notice-box>x</div></body>")
    counts = Counter()
    for _ in range(300):
        counts.update(H.count_words(page))
    text = H.extract(page, H.Weights(counts))
    assert "what the board has decided" in text and "Buy now" not in text and text.startswith("First words") and text.endswith("Last words.")
    few = Counter()
    for _ in range(300):
        few.update(H.count_words("<article><p>" + "word " * 50 + "</p><div class=ad-slot><p>Buy now cheap</p></div></article>"))
    assert "Buy" not in H.extract(page, H.Weights(few))


def plain_counts(page):
    """``count_words`` of words by walking all open elements for each text."""
    found, stack, texts = Counter(), [], []
    for kind, value in H.parse(page):
        if kind == "open":
            stack.append(value)
        elif kind == "close":
            del stack[-value:]
        else:
            texts.append((kind, value, [e for e in stack]))
    places, words = H._places(list(H.parse(page)))
    label = H.label_of(words)
    for (kind, value, path), (main, article) in zip(texts, places, strict=True):
        inside = main >= label[0] and (article == label[1] or not label[1])
        held = {d for e in path for d in H._own(e)}
        blamed = {d for d in held if H.is_boilerplate(d)}
        n = len(value.split()) if kind == "text" else 0
        for d in held if inside else blamed or {d for d in held if d[0] in "#@" or "." in d}:
            if n:
                found["w", d, int(inside)] += n
    return found


def test_counts_equal_a_walk_over_all_open_elements(llm_spark):
    pages = [r["html"] for r in table(llm_spark, "/root/testdata/sf0.001", "pages").collect()]
    pages += [PAGE.replace("{open}", "<main>").replace("{close}", "</main>"), f"<article class=a><div class=a><div class=a>x y</div> z</div><p>{BODY}</article><nav class=b><div class=b>q</div></nav>"]
    some = 0
    for page in pages:
        counts = H.count_words(page)
        if counts:
            some += 1
            assert {k: n for k, n in counts.items() if k[0] == "w"} == plain_counts(page)
    assert some > 50


def test_rare_descriptors_come_by_a_join(llm_spark, monkeypatch):
    rows = [(i, f"u{i}", f"<body><div class=box{i}><p>Side words {i} of a box that stands outside</p></div><article><p>Main words number {i} and more of them, always "
             f"the same length of text</p><div class=in{i}>inner {i}</div></article></body>") for i in range(60)] + [(60, None, None), (0, "again", "<p>x</p>")]
    pages = llm_spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("own", F.lit("c"))
    want = sorted(map(tuple, H.extract_text(pages).collect()), key=str)
    monkeypatch.setattr(H, "BROADCAST_DESCRIPTORS", 4)
    assert sorted(map(tuple, H.extract_text(pages).collect()), key=str) == want
    assert all("Side words" not in (r[2] or "") for r in want) and sum("Main words" in r[2] for r in want) == 60


@pytest.mark.parametrize("page", ["<div>" * 40_000 + "x", "<div class=a>y " * 40_000, "<article>" + "<div class=a>y " * 20_000, "<xmp>" * 40_000, "<b></i>" * 40_000,
                                  "<p>a<div>" * 20_000, "<article><main>" * 10_000 + "x", "<svg><g>" * 20_000, "<div>" * 20_000 + "</p>" * 20_000])
def test_deep_and_unclosed_pages_take_linear_time(page):
    began = time.time()
    tracemalloc.start()
    try:
        H.extract(page, H.Weights(H.count_words(page)))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert time.time() - began < 20 and peak < 300e6  # traced, some ten times slower than without
