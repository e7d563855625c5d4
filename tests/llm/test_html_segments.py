import html
import itertools
import random
import re

from matchlake.llm import html_segments as H
from matchlake.llm import queries

PAGE = """<!doctype html><html><head><title>T</title><style>p{a:b}</style><script>var x = "<p>no</p>";</script></head><body>
<header><a href=/>Home</a> Site name</header><nav><ul><li><a href=x>One</a><li><a href=y>Two</a></ul></nav>
<div class="cookie-notice">We use cookies a lot here</div><aside class=sidebar>Popular now today</aside>
<ARTICLE lang=en><header><h1>Big &amp; bold</h1></header><p>First   <b>para</b>graph,
with a <a href="/q?a=1>2">link</a> and 5 &lt; 6.<p>Second<br>line &eacute;&#33;<!-- hidden words --><div class="ad banner">Buy this now</div>
<ul><li>item one<li>item two</ul><form>Your name <input name=n></form><section id="comments"><p>Nice post!</p></section></ARTICLE>
<footer>&copy; someone</footer></body></html>"""
TEXT = "Big & bold\nFirst paragraph, with a link and 5 < 6.\nSecond line é!\nitem one\nitem two"
WEIGHT = H.weights(H.count(PAGE))


def test_one_page():
    assert H.extract(PAGE, WEIGHT) == TEXT


def test_without_the_article_tag():
    plain = re.sub("(?i)article", "div", PAGE).replace("<header><h1>", "<h1>").replace("</h1></header>", "</h1>")
    pages = {("p", True): 90, ("word", True): 900, ("word", False): 300, ("word:link", False): 300, ("word:link", True): 40,
             ("word:other", False): 400, ("div:other", False): 60, ("nav:other", False): 60, ("div", True): 10, ("div", False): 10, ("li", True): 9}
    assert H.extract(plain, H.weights(pages)) == TEXT


def test_odd_pages():
    for page in (None, "", "<p", "<!--", "<script>", "<div><span></div>", "   \n", "<nav>only menu</nav>"):
        assert H.extract(page, WEIGHT) == ""
    assert H.extract("plain words", WEIGHT) == "plain words"
    assert H.extract("<p>cut off in a <b", WEIGHT) == "cut off in a"
    assert H.extract("<p>a</b></i></p></p><p>b", WEIGHT) == "a\nb"
    assert H.extract("<p>" + "w " * 100_000, WEIGHT) == "w " * 99_999 + "w"
    assert H.extract("<div>" * 3000 + "deep", WEIGHT | {"div": 0.0}) == "deep"


def test_scan_against_all_runs():
    rng = random.Random(2)
    for _ in range(300):
        s = [rng.randint(-4, 4) for _ in range(rng.randint(0, 12))]
        best = max((sum(s[i:j]) for i, j in itertools.combinations(range(len(s) + 1), 2)), default=0)
        start, end = H.best_run(s)
        assert sum(s[start:end]) == max(0, best)


def test_operator(spark):
    rows = [(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (3, "v", ""), (None, "w", "<p>x</p>")]
    got = H.report(spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, text string, n_chars int")).collect()
    assert sorted((r.page_id or 0, r.url or "", r.text, r.n_chars) for r in got) == [
        (0, "w", "x", 1), (1, "u", TEXT, len(TEXT)), (1, "u", TEXT, len(TEXT)), (2, "", "", 0), (3, "v", "", 0)]
    assert H.report(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_pages_against_a_reading_of_their_template(spark, sf):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    for r in queries.QUERIES["op10_html_segments"](spark, sf).collect():
        article = re.search(r"(?s)<article>(.*?)(?:</article>|\Z)", pages[r.page_id])[1]
        blocks = (" ".join(html.unescape(re.sub("<b>|</b>", "", b).replace("<br>", " ")).split()) for b in re.split("</?h1>|</?p>", article))
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text)
