"""'hidden' counts as an attribute of that name or a whole class, nowhere else."""

import pytest

from matchlake.llm import html_segments as H


@pytest.mark.parametrize("tag", [
    '<div class="overflow-hidden">', '<p title="a hidden gem">', '<a href="/hidden-valley">', '<a href=/hidden-valley>',
    '<section data-hidden="false">', '<div title=\'x class="ad" y\'>', '<article class="overflow-hidden">', '<article data-hidden=0>',
])
def test_parts_that_are_shown(tag):
    name = tag[1:].split()[0]
    assert H.extract(f"<body>{tag}<article><p>Main words here</article></{name}>", {"word": 1.0, "word:link": 1.0}) == "Main words here"


@pytest.mark.parametrize("tag", ["<div hidden>", '<div HIDDEN="">', '<div class="a hidden b">', "<div class=hidden>", '<div aria-hidden="true">', '<div title=">" class="ad">'])
def test_parts_that_are_not(tag):
    assert H.extract(f"<body><p>Main words here</p>{tag}<p>other words</div>", {"word": 1.0}) == "Main words here"
