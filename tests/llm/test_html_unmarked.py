"""Pages cut without the article mark, and text that only looks like something else."""

import re

import pytest

from matchlake.llm import html_segments as H

W = {"word": 2.0, "word:link": -4.0, "p": -0.05, "div": -0.5, "li": -0.5, "ul": -0.5}
LONG = "<p>" + "many words of the text " * 5 + "</p>"
TEXT = " ".join(["many words of the text"] * 5)


@pytest.fixture(scope="module")
def learnt(spark, sf):
    return H.learn(spark.read.parquet(f"{sf}/pages.parquet"))


def test_the_given_pages_without_their_mark(spark, sf, learnt):
    pages = [r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()]
    plain = [re.sub("(</?)article>", r"\1div>", p) for p in pages]
    assert all("<article" not in p for p in plain)
    assert [H.extract(p, learnt) for p in plain] == [H.extract(p, learnt) for p in pages]
    assert all(H.extract(p, learnt) for p in plain)


def test_weights_are_what_cuts(spark, sf, learnt):
    assert learnt["word"] > 0 > learnt["@nav"] and learnt["word:p"] > 0 > learnt["@ad"] and learnt["p"] < 0
    pages = [r.html for r in spark.read.parquet(f"{sf}/pages.parquet").limit(50).collect()]
    links = [p.replace("<nav>", "<div>").replace("</nav>", "</div>") for p in pages]  # a menu without its name
    assert [H.extract(p, learnt) for p in links] == [H.extract(p, learnt) for p in pages]
    everything = dict.fromkeys(learnt, 1.0)
    assert [H.extract(p, everything) for p in links] != [H.extract(p, learnt) for p in links]


@pytest.mark.parametrize("part", [
    "<figcaption>Kept words</figcaption>", "<math>Kept words</math>", "<noscript>Kept words</noscript>", "<object>Kept words</object>",
    '<div class="side-by-side">Kept words</div>', '<div id="legal-background">Kept words</div>', '<div class="search-theory">Kept words</div>',
    '<p class="add shadow">Kept words</p>', '<section id="notice-of-appeal">Kept words</section>',
])
def test_text_that_stays(part):
    assert "Kept words" in H.extract(f"<body>{LONG}{part}{LONG}</body>", W)


@pytest.mark.parametrize("part", [
    '<div class="ad">Gone</div>', '<div class="x ad-box">Gone</div>', "<aside>Gone</aside>", "<form>Gone</form>", '<div id="comments-list">' + "<p>Gone</p>" * 900 + "</div>",
    '<div class="left-sidebar">Gone</div>', '<div class="cookie-notice">Gone</div>', '<div role="navigation">Gone</div>', '<div class="site-header">Gone</div>',
])
def test_parts_that_go_wherever_they_stand(part):
    assert H.extract(f"<body>{part}{LONG}{part}{LONG}{part}</body>", W) == f"{TEXT}\n{TEXT}"


def test_menus_without_a_name():
    menu = "<ul>" + "".join(f"<li><a href=/{i}>entry {i}</a>" for i in range(9)) + "</ul>"
    assert H.extract(f"<body>{menu}{LONG}<div><a>l1</a><a>l2</a></div></body>", W) == TEXT
    assert "a link" in H.extract("<p>words with <a href=/>a link</a> among them</p>", W)
