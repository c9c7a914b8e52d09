import html as h
import itertools
import math
import random
import re
import time

import numpy as np

from quillmark.llm import html, queries

SF = "/root/testdata/sf0.01"


def article_by_tags(page):
    """The <article> of the generated pages, which hold p, b, br and h1 only."""
    inner = re.search(r"<article>(.*?)(?:</article>|<footer>|$)", page, re.S)[1]
    parts = [" ".join(h.unescape(re.sub(r"<[^>]*>", " ", re.sub(r"</?b>", "", x))).split()) for x in re.split(r"</?(?:p|h1)\b[^>]*>", inner)]
    return "\n".join(x for x in parts if x)


def test_whole_table(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r["page_id"]: r for r in html.extract(pages).collect()}
    rows = pages.collect()
    assert len(got) == len(rows)
    for r in rows:
        g = got[r["page_id"]]
        assert g["text"] == article_by_tags(r["html"]) and g["n_chars"] == len(g["text"]) and g["url"] == r["url"]


PAGE = """<!doctype html><html><head><title>T</title><style>p{}</style></head><body>
<header class="site-header"><a href="/">Site name</a><p>The daily paper of record since long ago.</p></header>
<nav><ul><li><a href=a>Home</a><li><a href=b>World news</a></ul></nav>
<div class="cookie-notice">We use cookies to make this site work. By going on you accept them, all of them, for ever.</div>
<main><article><header><h1>Caf&eacute; &amp; bar</h1></header>
<p>First   paragraph with <b>bold</b> and <a href=x>a link</a>
in it, long enough to be text.<p>Second&nbsp;paragraph, not closed, with some more words.
<div class="ad">Buy this now! Cheap things for everyone who reads this, only today in our shop.</div>
<ul><li>One point that matters.<li>Another point, too.</ul>
<blockquote>Someone said this once, and it was right.</blockquote>
<script>var a = "<p>no</p>";</script><!-- no -->
<form><label>Mail</label><input><button>Send</button></form>
</article></main>
<aside class="sidebar"><h3>Related</h3><p>Ten other stories that you will not believe at all, ever.</p></aside>
<section id="comments"><h2>Comments</h2><div class="comment"><p>I think that this article is wrong about everything, as always.</p></div></section>
<footer><p>&copy; 2020 Site. All rights reserved.</p></footer></body></html>"""


def test_kinds_of_boilerplate_go_and_the_article_stays():
    assert html.main_text(PAGE).split("\n") == ["Café & bar", "First paragraph with bold and a link in it, long enough to be text.", "Second paragraph, not closed, with some more words.", "One point that matters.", "Another point, too.", "Someone said this once, and it was right."]


def test_pages_without_article_tags():
    page = "<body><div id=menu><a href=a>Home</a> <a href=b>About us</a></div><div class=content><h1>Title of it</h1>" + "<p>A sentence of a paragraph that goes on for a while, as they do.</p>" * 4 + "<p>Short.</p></div><div id=footer>© 2001 by us</div>"
    assert html.main_text(page).split("\n") == ["Title of it", *["A sentence of a paragraph that goes on for a while, as they do."] * 4, "Short."]


def test_minimum_cut_against_all_labellings():
    rng = random.Random(5)
    for _ in range(200):
        n = rng.randrange(1, 9)
        t = [(rng.randrange(9) / 2, rng.randrange(9) / 2) for _ in range(n)]
        edges = [(a, b, rng.randrange(1, 6) / 2) for a, b in itertools.combinations(range(n), 2) if rng.random() < 0.4]

        def cost(keep, t=t, edges=edges):
            return sum(c[0] if k else c[1] for c, k in zip(t, keep, strict=True)) + sum(w for a, b, w in edges if keep[a] != keep[b])

        best = min(cost(k) for k in itertools.product((False, True), repeat=n))
        assert abs(cost(html.min_cut(t, edges)) - best) < 1e-9


def test_odd_rows(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "v", "<p>"), (3, "v", "<p>"), (None, "w", "plain text without any tag, that is long enough to be content"), (5, "x", "<article>" + "<p>Words of a long page, one after the other." * 20_000), (6, "y", "<div>" * 3000 + "deep"), (7, "z", "<article><p>cut off &am"), (8, "z", "<script>var x=1")]
    df = spark.createDataFrame([(*r, "t", 1) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    got = sorted(html.extract(df).collect(), key=lambda r: r["page_id"] or 0)
    assert [r["text"] for r in got[1:5]] == ["", "", "", ""]
    assert got[0]["text"].startswith("plain text") and got[5]["text"].count("\n") == 19_999 and got[7]["text"] == "cut off &am" and got[8]["text"] == ""
    assert html.extract(df.where("false")).count() == 0


def test_head_without_end_and_unclosed_silent_elements():
    text = "A sentence of a paragraph that goes on for a while, as they do."
    body = f"<article><p>{text}</p><p>{text}</p></article>"
    want = f"{text}\n{text}"
    for page in (
        f"<html><head><title>x</title>{body}", f"<html><head><meta charset=utf-8><title>x</title><script>var a</script><link href=a>{body}", f"<html><head><title>x{body}", f"<head><title>x</title></head><body><select><option>one<option>two{body}",
        f"<body><object data=a>{body}", f"<body><iframe src=a>{body}", f"<head><noscript><img src=a></noscript><title>x</title></head><body>{body}", f"<body><object><p>Words of a closed one, which stay silent as before.</p></object>{body}",
    ):
        assert html.main_text(page) == want, page


def test_formulas_stay_in_their_sentence():
    page = "<article><p>The sum of both is <math><mi>a</mi><mo>+</mo><mi>b</mi></math>, as we have seen in the text above.</p></article>"
    assert html.main_text(page) == "The sum of both is a+b, as we have seen in the text above."


def test_nesting_takes_time_in_proportion():
    deep = "".join(f"<div>Some text of a block, number {k}." for k in range(20_000))
    began = time.time()
    assert html.main_text("<article>" + deep).count("\n") == 19_999
    assert time.time() - began < 20
    assert html.main_text("<div>" * 100_000 + "A sentence of a paragraph that goes on for a while, as they do.").startswith("A sentence")


def test_remarks_of_readers_and_notices_without_telling_names():
    text = "A sentence of a paragraph that goes on for a while, as they do."
    page = f"""<body><div class=x1>We use cookies to make this site work. By going on you accept cookies of ours and of our partners.</div>
    <article><h1>Title of it</h1><p>{text}</p><p>{text}</p></article><div class="user-remarks"><p>I do not think that any of this is right, as I said before.</p></div></body>"""
    assert html.main_text(page).split("\n") == ["Title of it", text, text]


def test_fitted_odds():
    """No slope of the loss at the fitted weights, by plain loops; the loss with its ridge has one minimum."""
    rng = random.Random(2)
    x = [[rng.gauss(0, 1), rng.gauss(3, 2)] for _ in range(60)]
    y = [a + rng.gauss(0, 1) > 0 for a, _ in x]
    odds = html.fit_odds(np.array(x), np.array(y))
    mean, scale = np.mean(x, 0), np.std(x, 0)
    w = [*(odds.weights * scale), odds.bias + mean @ odds.weights]
    slope = [1e-2 * v for v in w]
    for row, content in zip(x, y, strict=True):
        z = [*((row - mean) / scale), 1.0]
        p = 1 / (1 + math.exp(-sum(a * b for a, b in zip(w, z, strict=True))))
        share = 0.5 / (sum(y) if content else len(y) - sum(y))
        slope = [s - share * (content - p) * v for s, v in zip(slope, z, strict=True)]
    assert max(map(abs, slope)) < 1e-8
    assert html.fit_odds(np.array(x), np.ones(60, bool)) is None


def test_fit_reads_a_bounded_sample_and_tells_unmarked_pages_apart(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    odds = html.fit(pages, max_pages=100)
    rest = [r["html"] for r in pages.collect()]
    right = [np.mean((odds.of(x) > 0) == y) for x, y in map(html.marked_blocks, rest)]
    assert np.mean(right) > 0.95
    # the same pages without their marks: the odds do no harm where the points have less to go by
    bare = [re.sub(r"</?(?:article|nav|footer|aside|header)>", lambda m: "</div>" if "/" in m[0] else "<div>", p) for p in rest]
    want = [article_by_tags(p).split("\n") for p in rest]

    def wrong(odds):
        return sum(len(set(w) ^ set(html.main_text(p, odds).split("\n"))) for p, w in zip(bare, want, strict=True))

    assert wrong(odds) <= wrong(None)
    assert html.fit(pages.where("false")) is None
    assert html.fit(spark.createDataFrame([(1, "u", "<p>No marks here"), (2, None, None)], "page_id long, url string, html string")) is None
    assert html.fit(pages.union(pages), max_pages=100).weights.tolist() == odds.weights.tolist()


def test_query_on_the_whole_table(spark):
    got = {r["page_id"]: r["text"] for r in queries.op2_main_text(spark, SF).collect()}
    rows = spark.read.parquet(f"{SF}/pages.parquet").collect()
    assert len(got) == len(rows) and all(got[r["page_id"]] == article_by_tags(r["html"]) for r in rows)
