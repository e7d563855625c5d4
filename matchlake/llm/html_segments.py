"""Main text of web pages: the maximum-scoring subsequence of words and tags.

A page is a sequence of tokens. The class of a word is the block element it stands in, or ``word:link``
where more than half of its block's letters are links, or the kind of part around it (``@nav``, ``@ad``). The
weights of words and tags are log odds of a token inside against outside the main text, counted over
labelled pages: those whose markup names one article (about ``SAMPLE`` of them, chosen by hash, which
bounds what training reads). The mark serves as label only; a page is cut without looking at it. One
linear scan finds the contiguous run of tokens with the greatest sum, and its words are the main text.

Menus, headers, footers, sidebars, notices, adverts, forms and reader comments count as outside wherever
they stand, and what a run holds of them is left out. Such a part costs a run at most ``LIMIT``, however
long it is: an article goes on behind long comments. Everything else is text, captions and formulas
too; a word in ``class`` or ``id`` names a kind only as a whole (``sidebar``, ``ad-box``, not ``side-by-side``).

Blocks follow the block-level tags; white space inside one becomes one blank. Character references
are decoded after the tags are cut. Cases: a null or empty page, or one without words, gives an empty
text; unclosed and misnested tags end with the part around them; a page cut off in a tag ends there;
very long pages are scanned whole, a text between two tags as one token; repeated rows get equal texts;
an empty table gives no rows; of ties the earlier and longer run wins; other columns are not read.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import sampled, whole

SAMPLE = 2000
#: Added to each count of a token class.
SMOOTH = 1.0
#: A weight stays within this; words on average score MIN_WORD or more, a tag MAX_TAG or less.
LIMIT, MIN_WORD, MAX_TAG = 4.0, 0.5, -0.05

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<raw>script|style|template|textarea)\b[^>]*(?:>.*?(?:</(?P=raw)\s*>|\Z)|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-z][a-z0-9:-]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)",
    re.I | re.S,
)
#: An attribute's name and value; every one is consumed, so that no name is looked for inside a value.
ATTR = re.compile(r"([^\s=\"'<>/]+)(?:\s*=\s*(\"[^\"]*\"?|'[^']*'?|[^\s>]+))?")
#: Elements whose name says what the part is for.
PARTS = frozenset("nav header footer aside form button menu dialog head title label fieldset select option".split())
#: Words that name a kind of part as a whole word of class, id or role, alone or with the affixes below.
KIND = (
    r"ads?|advert|advertisement|advertising|sponsored|sponsor|promo|promotion|cookies?|consent|notice|alert|popup|modal|newsletter"
    r"|subscribe|signup|login|nav|navbar|navigation|menu|breadcrumbs?|sidebar|comments?|respond|replies|disqus|footer|masthead"
    r"|toolbar|pagination|pager|complementary|contentinfo"
)
AFFIX = r"site|page|global|main|top|bottom|left|right|box|bar|banner|list|block|area|wrapper|wrap|container|section|widget|slot|unit|form|links?|header|\d+"
MARKED = re.compile(rf"(?:(?:{AFFIX})[_-])*(?P<kind>{KIND}|(?:site|page|global)[_-]?header)(?:[_-](?:{KIND}|{AFFIX}))*", re.I)
BLOCK = frozenset(
    "address article aside blockquote body center dd details div dl dt fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr li main "
    "nav ol p pre section summary table tbody td tfoot th thead tr ul html head title figcaption".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: An open element of the first kind ends when one of the second kind begins or ends.
CLOSES = {"p": BLOCK, "li": {"li", "ul", "ol"}, "dt": {"dt", "dd", "dl"}, "dd": {"dt", "dd", "dl"}, "td": {"td", "th", "tr", "table"},
          "th": {"td", "th", "tr", "table"}, "tr": {"tr", "table"}, "option": {"option", "select"}}
MAIN = ("article", "main")


def _part(name: str, attrs: str, inside_main: bool) -> str | None:
    """The kind of part that an element opens. A header inside an article holds its heading."""
    if name in PARTS:
        return None if name == "header" and inside_main else name
    for key, value in ATTR.findall(attrs):
        key, value = key.lower(), value.strip("\"'")
        if key == "hidden" or key == "aria-hidden" and value == "true":
            return "hidden"
        if key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return "hidden"
        if key in ("class", "id", "role") and name not in ("html", "body", *MAIN):
            for word in value.split():
                if key == "class" and word.lower() == "hidden":
                    return "hidden"
                if found := MARKED.fullmatch(word):
                    return found["kind"].lower()
    return None


class Token(NamedTuple):
    kind: str  # of a text "blank", "word:<block element>", "word:link" or "@<part>", else the tag's name
    text: str  # empty for a tag
    block: int
    inside: bool  # of an article: the label
    part: int  # the outermost part around a text that is not main text, 0 for none


def tokens(page: str) -> list[Token]:
    """The texts between tags, and the tags outside parts that are not main text."""
    out: list[tuple[Token, bool]] = []  # with whether a text is in a link
    open_: list[tuple[str, str | None, int]] = []  # name, the kind of part around, its number
    letters: Counter = Counter()  # of each block, and of its links
    block, links, mains, parts, at = 0, 0, 0, 0, 0

    def leave(to: int) -> None:
        nonlocal links, mains
        for name, _, _ in open_[to:]:
            links -= name == "a"
            mains -= name in MAIN
        del open_[to:]

    def words(text: str) -> None:
        if not text:
            return
        kind, part = open_[-1][1:] if open_ else (None, 0)
        if not text.strip():
            out.append((Token("blank", text, block, mains > 0, part), False))
        elif kind:
            out.append((Token(f"@{kind}", text, block, False, part), False))
        else:
            size = len(text) - text.count(" ")
            letters[block] += size
            letters[block, "link"] += size if links else 0
            around = next((name for name, _, _ in reversed(open_) if name in BLOCK), "body")
            out.append((Token(f"word:{around}", text, block, mains > 0, 0), links > 0))

    for m in TOKEN.finditer(page):
        words(page[at:m.start()])
        at = m.end()
        name = (m["name"] or "").lower()
        if not name:
            continue
        if m["close"]:
            for i in range(len(open_) - 1, -1, -1):
                if open_[i][0] == name:
                    if not open_[-1][1]:
                        out.append((Token(f"/{name}", "", block, mains > 0, 0), False))
                    leave(i)
                    break
                if open_[i][0] in ("article", "main", "table") and name not in ("body", "html", "article", "main", "table"):
                    break  # a stray end tag does not end the part around it
            block += name in BLOCK
            continue
        while open_ and name in CLOSES.get(open_[-1][0], ()):
            leave(len(open_) - 1)
        if name in BLOCK:
            # an inline element left open (<b> ... <p>) does not hold the blocks that follow
            i = len(open_)
            while i and open_[i - 1][0] not in BLOCK:
                i -= 1
            if i and open_[i - 1][0] == "p":
                leave(i - 1)
            block += 1
        kind, part = open_[-1][1:] if open_ else (None, 0)
        if not kind:
            kind = _part(name, m["attrs"] or "", mains > 0)
            if kind:
                parts += 1
                part = parts
            else:
                out.append((Token(name, "", block, mains > 0, 0), False))
        if name == "br":
            out.append((Token("blank", " ", block, mains > 0, part), False))
        if name not in VOID and not (m["attrs"] or "").rstrip().endswith("/"):
            open_.append((name, kind, part))
            links += name == "a"
            mains += name in MAIN
    words(page[at:])
    dense = lambda t: t.kind.startswith("word:") and 2 * letters[t.block, "link"] > letters[t.block]
    return [t._replace(kind="word:link") if dense(t) else t for t, _ in out]


def named_article(page: str) -> bool:
    """Whether the page's markup names one main part."""
    return any(len(re.findall(rf"<{name}[\s>]", page, re.I)) == 1 for name in MAIN)


def count(page: str) -> Counter:
    """(class, inside) of a labelled page's tokens; a text counts once for each of its words."""
    found: Counter = Counter()
    for kind, text, _, inside, _ in tokens(page):
        if kind == "blank" or kind.lstrip("/") in MAIN:
            continue
        found[kind, inside] += len(text.split()) or 1
        if kind.startswith("word:") and kind != "word:link":
            found["word", inside] += len(text.split())
    return found


def weights(counts: dict[tuple[str, bool], int]) -> dict[str, float]:
    """Log odds of inside against outside, per class; words stay positive on average, tags negative."""
    general = {k: n for k, n in counts.items() if k[0] != "word"} or counts
    total = {side: sum(n for (_, s), n in general.items() if s == side) for side in (True, False)}
    kinds = {k for k, _ in counts}
    out = {}
    for kind in kinds:
        share = [(counts.get((kind, side), 0) + SMOOTH) / (total[side] + SMOOTH * (len(kinds) + 1)) for side in (True, False)]
        odds = max(-LIMIT, min(LIMIT, math.log(share[0] / share[1])))
        tag = kind != "word" and not kind.startswith(("word:", "@"))
        out[kind] = max(MIN_WORD, odds) if kind == "word" else min(MAX_TAG, odds) if tag else odds
    out.setdefault("word", 1.0)
    return out


#: What a tag of a class that no labelled page has scores, and a word in a block of links.
UNKNOWN_TAG, UNKNOWN_LINK = -0.5, -0.5


def scored(sequence: list[Token], weight: dict[str, float]) -> list[float]:
    """The score of each token."""
    spent: Counter = Counter()  # by part
    out = []
    for kind, text, _, _, part in sequence:
        if kind == "blank":
            score = 0.0
        elif not text:
            score = weight.get(kind, UNKNOWN_TAG)
        else:
            unknown = -LIMIT if part else UNKNOWN_LINK if kind == "word:link" else weight.get("word", 1.0)
            score = len(text.split()) * weight.get(kind, unknown)
            if part:
                score = max(score, -LIMIT - spent[part])
                spent[part] += score
        out.append(score)
    return out


def best_run(scores: list[float]) -> tuple[int, int]:
    """Start and end (exclusive) of the contiguous run with the greatest sum, in one pass."""
    best, run, start, found = 0.0, 0.0, 0, (0, 0)
    for i, s in enumerate(scores):
        if run < 0:
            run, start = 0.0, i
        run += s
        if run > best:
            best, found = run, (start, i + 1)
    return found


def extract(page: str | None, weight: dict[str, float]) -> str:
    """The main text: blocks joined by line feeds."""
    if not page:
        return ""
    sequence = tokens(page)
    start, end = best_run(scored(sequence, weight))
    # a block that the run's border cuts belongs to it whole
    while 0 < start < end and sequence[start - 1].block == sequence[start].block:
        start -= 1
    while 0 < end < len(sequence) and sequence[end].block == sequence[end - 1].block:
        end += 1
    blocks: dict[int, list[str]] = {}
    for _, text, block, _, part in sequence[start:end]:
        if text and not part:
            blocks.setdefault(block, []).append(text)
    lines = (" ".join(html.unescape("".join(parts)).split()) for parts in blocks.values())
    return "\n".join(line for line in lines if line)


def learn(pages: DataFrame, source: str = "html") -> dict[str, float]:
    """Weights from a bounded sample of labelled pages; a few hundred counts reach the driver."""
    page = whole(source)
    labelled = pages.select(page.alias("page")).where(F.lower("page").contains("<article") | F.lower("page").contains("<main"))
    chosen = labelled.where(sampled(F.xxhash64("page"), SAMPLE, labelled.count()))

    def mapped(batches):
        for batch in batches:
            found: Counter = Counter()
            for text in set(batch.column(0).to_pylist()):  # a page with many copies counts once here
                if named_article(text):
                    found.update(count(text))
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in found], pa.string()), pa.array([s for _, s in found], pa.bool_()), pa.array(list(found.values()), pa.int64())],
                ["kind", "inside", "n"],
            )

    rows = chosen.mapInArrow(mapped, "kind string, inside boolean, n bigint").groupBy("kind", "inside").agg(F.sum("n").alias("n")).collect()
    return weights({(r.kind, r.inside): r.n for r in rows})


def report(pages: DataFrame, page_id="page_id", url="url", source="html") -> DataFrame:
    """page_id, url, text, n_chars per page."""
    weight = learn(pages, source)
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), whole(source).alias("html_"))

    def mapped(batches):
        for batch in batches:
            texts = [extract(p.as_py(), weight) for p in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    kinds = [rows.schema[c].dataType.simpleString() for c in ("page_id", "url")]
    return rows.mapInArrow(mapped, f"page_id {kinds[0]}, url {kinds[1]}, text string, n_chars bigint")
