"""Toxicity: Levenshtein automata over a lexicon trie, with context windows.

The lexicon is learned from labelled rows: beginnings of words (roots) and words that toxic documents hold
at several different places and others next to never; of roots that begin alike the shortest, of words
those without a root. They go into one trie; the automaton that accepts every string within a term's error
budget (for a root, every string that begins so) is the trie walked with up to two errors, made
deterministic lazily (a state is a set of trie nodes with their errors, a transition is computed when it
is first taken). A word that leads to no term dies after a few letters, so texts are read at about one
dictionary look-up a letter, and every different word of a task is walked once.

A term keeps a number of errors if what comes that close to it is likelier a misspelling than another
word: the share of clean documents that hold such a word must not exceed ``MISSPELT`` times the share of
toxic documents that hold the term, or the share of toxic ones that hold such a word.

A hit is looked at in its window of words: in quotation marks or after words of speaking or naming it
is quotation, next to a word that addresses somebody it is abuse. Plain hits by kind (word, root, one
error, two errors), quoted hits and addressed hits are the features of a logistic model, fitted on about
``SAMPLE`` labelled documents (a bound on what training reads, chosen by hash). Misspellings are rare in
labelled text, so its toxic documents are fitted twice more with one and two letters of every hit
changed; that gives hits with errors weights of their own. The score sees the text only.

Rows with crc32(doc_id) mod 5 = 0 are held out of all learning. Cases: null and empty texts have no
hits and get the score of a text without any; very long texts are read whole; null ids belong to no label
and are not held out; a document labelled twice is toxic if one label says so; without labels the score
is the prior 0.5 less a hair, so nothing is predicted toxic; repeated rows get equal scores; of terms
equally near a whole word, then the first in order counts; other columns are not read; empty tables give no rows.
"""

from __future__ import annotations

import math
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.once import once
from ..session import written
from .common import sampled, whole

FOLDS = 5
SAMPLE = 20_000
#: A term is at this many different places in toxic documents at least, and at this many per toxic
#: document; at least this share of all its places is there.
MIN_PLACES, MIN_RATE, MIN_SHARE = 5, 0.005, 0.9
STEM_LENGTHS = (3, 4, 5, 6, 7)
#: A root is worth a term only if several words begin with it.
MIN_FORMS = 3
#: Errors allowed by a term's length.
ONE_ERROR, TWO_ERRORS = 4, 9
#: The share of a term's places taken to be misspelt, where nothing else is known.
MISSPELT = 0.02
WINDOW = 5
#: Words whose kind a worker remembers.
HELD = 100_000
WORD = re.compile(r"[^\W\d_]+")
QUOTES = frozenset("\"'«»„“”‘’‹›`")
OPENING, CLOSING = frozenset("«‹"), frozenset("»›")
#: Words that name or report a word, and words that address somebody, in four languages.
NAMING = frozenset("said says word words term called quote quoted wrote writes sagte wort begriff schrieb mot terme écrit dit palabra término dijo escribió".split())
ADDRESS = frozenset("you your youre u ur du dein deine ihr euch sie tu toi ton vous votre tú tus usted eres vosotros".split())
#: Kinds of hits.
EXACT, ROOT, ONE, TWO = range(4)
FEATURES = ["word", "root", "one_error", "two_errors", "quoted", "addressed", "share"]


class Lexicon:
    """The trie of words and roots, and its lazily built automaton."""

    def __init__(self, words: list[str], stems: list[str], strict: dict[str, int] | None = None):
        """``strict`` lowers the error budget of single terms."""
        strict = strict or {}
        self.words, self.stems = sorted(set(words)), sorted(set(stems))
        self.children: list[dict[str, int]] = [{}]
        self.word: dict[int, tuple[int, str]] = {}  # a word ends here: errors allowed, and the word
        self.stem: dict[int, tuple[int, str]] = {}  # likewise of a root
        self.reach: list[int] = [0]  # errors allowed by any term below
        for terms, ends in ((self.words, self.word), (self.stems, self.stem)):
            for term in terms:
                errors = min(strict.get(term, 2), 2 if len(term) >= TWO_ERRORS else 1 if len(term) >= ONE_ERROR else 0)
                ends[self._insert(term, errors)] = errors, term
        self._forget()

    def _forget(self) -> None:
        self.states: dict[frozenset, int] = {}
        self.sets: list[dict[int, int]] = []
        self.steps: list[dict[str, int]] = []
        self.ends: list[tuple] = []  # of each state the nearest word, and the nearest root
        self.start = self._state({0: 0})
        self.seen: dict[str, tuple[int, str]] = {}

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k in ("children", "word", "stem", "reach", "words", "stems")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._forget()

    def _insert(self, term: str, errors: int) -> int:
        at = 0
        for c in term:
            self.reach[at] = max(self.reach[at], errors)
            if c not in self.children[at]:
                self.children.append({})
                self.reach.append(0)
                self.children[at][c] = len(self.children) - 1
            at = self.children[at][c]
        self.reach[at] = max(self.reach[at], errors)
        return at

    def _state(self, nodes: dict[int, int]) -> int:
        """The number of a set of (node, errors), closed under letters the text leaves out."""
        closed, todo = {}, list(nodes.items())
        while todo:
            node, errors = todo.pop()
            if errors > self.reach[node] or closed.get(node, 9) <= errors:
                continue
            closed[node] = errors
            todo += [(child, errors + 1) for child in self.children[node].values()]
        key = frozenset(closed.items())
        if key not in self.states:
            self.states[key] = len(self.sets)
            self.sets.append(closed)
            self.steps.append({})
            nearest = lambda ends: min(((e, ends[n][1]) for n, e in closed.items() if n in ends and e <= ends[n][0]), default=NONE)
            self.ends.append((nearest(self.word), nearest(self.stem)))
        return self.states[key]

    def _step(self, state: int, letter: str) -> int:
        """The state after one more letter; -1 if no term can follow."""
        after: dict[int, int] = {}
        for node, errors in self.sets[state].items():
            moves = [(node, errors + 1)]  # a letter too many
            moves += [(child, errors + (c != letter)) for c, child in self.children[node].items()]
            for target, e in moves:
                if e <= self.reach[target] and e < after.get(target, 9):
                    after[target] = e
        number = self._state(after) if after else -1
        self.steps[state][letter] = number
        return number

    def kind(self, word: str) -> tuple[int, str]:
        """EXACT, ROOT, ONE or TWO errors, or -1, and the term met: that with the fewest errors."""
        found = self.seen.get(word)
        if found is not None:
            return found
        state, begun = self.start, NONE
        for letter in word:
            nxt = self.steps[state].get(letter)
            state = self._step(state, letter) if nxt is None else nxt
            if state < 0:
                break
            begun = min(begun, self.ends[state][1])
        whole_word = self.ends[state][0] if state >= 0 else NONE
        root = begun[0] < whole_word[0]
        errors, term = begun if root else whole_word
        found = (-1 if errors > 2 else errors + 1 if errors else ROOT if root else EXACT), term
        if len(self.seen) > HELD:
            self.seen.clear()
        self.seen[word] = found
        return found


#: No term is near.
NONE = (9, "")


def features(text: str, lexicon: Lexicon) -> list[float]:
    """The counts of a text's hits, in the order of FEATURES."""
    low = text.lower()
    words = WORD.findall(low)
    kind = lexicon.kind
    hits = {w: k for w in set(words) if (k := kind(w)[0]) >= 0}
    out = [0.0] * len(FEATURES)
    if not hits:
        return out
    spots = list(WORD.finditer(low))
    for i, spot in enumerate(spots):
        k = hits.get(spot[0])
        if k is None:
            continue
        around = words[max(0, i - WINDOW): i] + words[i + 1: i + 1 + WINDOW]
        left = low[max(0, spot.start() - 2): spot.start()]
        right = low[spot.end(): spot.end() + 2]
        # a blank may stand inside guillemets, but not between a word and the quote of its neighbour
        opened = left[-1:] in QUOTES or left[:1] in OPENING and left[1:].isspace()
        closed = right[:1] in QUOTES or right[1:] in CLOSING and right[:1].isspace()
        quoted = bool(left and right) and bool(opened and closed)
        quoted = quoted or any(w in NAMING for w in words[max(0, i - WINDOW): i])
        out[4 if quoted else k] += 1
        out[5] += any(w in ADDRESS for w in around)
    return [math.log1p(x) for x in out[:6]] + [math.log1p(1000 * sum(out[:4]) / len(words))]


def misspelt(text: str, lexicon: Lexicon, letters: int) -> str:
    """The text with so many letters of every hit changed, at places that follow from the word."""
    def changed(spot: re.Match) -> str:
        word = spot[0]
        if lexicon.kind(word)[0] < 0:
            return word
        at = zlib.crc32(word.encode()) % len(word)
        for place in range(at, at + letters):
            place %= len(word)
            other = ALPHABET[(ALPHABET.find(word[place]) + 7) % len(ALPHABET)]
            word = word[:place] + other + word[place + 1:]
        return word

    return WORD.sub(changed, text.lower())


ALPHABET = "abcdefghijklmnopqrstuvwxyz"


def _scored(rows: DataFrame, lexicon: Lexicon, model: np.ndarray) -> DataFrame:
    """``rows`` (..., text last) with its score."""
    others = rows.columns[:-1]
    shared = rows.sparkSession.sparkContext.broadcast(lexicon)

    def mapped(batches):
        for batch in batches:
            x = np.array([features(t.as_py() or "", shared.value) for t in batch.columns[-1]], float).reshape(-1, len(FEATURES))
            last = pa.array(1 / (1 + np.exp(-np.clip(x @ model[1:] + model[0], -500, 500))), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], last], [*others, "value"])

    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in others)
    return rows.mapInArrow(mapped, f"{schema}, value double")


def remainder(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def training(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str) -> DataFrame:
    """(toxic, text) of the labelled documents to learn from, written once."""
    judged = labels.where(F.col(label).isNotNull()).groupBy(F.col(doc_id).alias("id_")).agg((F.max(label) > 0).cast("int").alias("toxic"))
    judged = written(judged.where(remainder(F.col("id_")) != 0), "toxic")
    chosen = judged.where(sampled(F.xxhash64("id_"), SAMPLE, judged.count()))
    mine = docs.select(F.col(doc_id).alias("id_"), whole(text).alias("t")).where(remainder(F.col("id_")) != 0)
    return written(mine.join(chosen, "id_").select("toxic", "t"), "toxic")


def _forms(rows: DataFrame) -> DataFrame:
    """(word, place): a text's words, each with a hash of its neighbours. Copies of a text, near ones
    too, repeat their places, so counting places instead of texts keeps them from making terms."""
    listed = rows.select(F.regexp_extract_all(F.lower("t"), F.lit(r"[\p{L}]+"), F.lit(0)).alias("w"))
    spots = once(listed, w_=F.col("w")).select(
        F.explode(F.transform("w_", lambda w, i: F.struct(w.alias("word"), F.xxhash64(F.get("w_", i - 1), F.get("w_", i + 1)).alias("place")))).alias("s")
    )
    return spots.select("s.*")


def learn(train: DataFrame) -> Lexicon:
    """Words and stems of toxic documents that other documents do without. Only what several toxic
    documents hold is counted in the others, so the lists stay small whatever the sample's words."""
    toxic, clean = _forms(train.where("toxic = 1")), _forms(train.where("toxic = 0"))
    least = max(MIN_PLACES, int(MIN_RATE * train.where("toxic = 1").count()))
    count = F.count_distinct("place")
    words = written(toxic.groupBy("word").agg(count.alias("count")).where(F.col("count") >= least), "toxic")
    stem = F.explode(F.array(*[F.when(F.length("word") > n, F.substring("word", 1, n)) for n in STEM_LENGTHS])).alias("stem")
    stems = written(
        toxic.select("word", "place", stem).where("stem IS NOT NULL").groupBy("stem").agg(count.alias("count"), F.count_distinct("word").alias("forms"))
        .where((F.col("count") >= 2 * least) & (F.col("forms") >= MIN_FORMS)), "toxic",
    )
    in_clean = clean.join(words.select("word"), "word", "left_semi").groupBy("word").agg(count.alias("others"))
    begun = clean.select("place", stem).where("stem IS NOT NULL").join(stems.select("stem"), "stem", "left_semi").groupBy("stem").agg(count.alias("others"))
    sure = F.col("count") >= MIN_SHARE * (F.col("count") + F.coalesce("others", F.lit(0)))
    begins = [r.stem for r in stems.join(begun, "stem", "left").where(sure).select("stem").collect()]
    roots = [s for s in begins if not any(s != other and s.startswith(other) for other in begins)]
    whole_words = [r.word for r in words.join(in_clean, "word", "left").where(sure).select("word").collect()]
    alone = [w for w in whole_words if not w.startswith(tuple(roots))]
    return Lexicon(alone, roots, _strict(train, Lexicon(alone, roots)))


def _strict(train: DataFrame, lexicon: Lexicon) -> dict[str, int]:
    """Terms near which other words lie, with the errors that remain allowed."""
    shared = train.sparkSession.sparkContext.broadcast(lexicon)

    def mapped(batches):
        for batch in batches:
            hits = [
                (toxic, *h) for toxic, t in zip(batch.column(0).to_pylist(), batch.column(1))
                for h in {(term, max(k - 1, 0)) for k, term in map(shared.value.kind, set(WORD.findall((t.as_py() or "").lower()))) if k >= 0}
            ]
            yield pa.RecordBatch.from_arrays([pa.array([h[i] for h in hits], kind) for i, kind in enumerate((pa.int32(), pa.string(), pa.int32()))], ["toxic", "term", "errors"])

    hits = train.select("toxic", "t").mapInArrow(mapped, "toxic int, term string, errors int").groupBy("toxic", "term", "errors").count()
    documents = {r.toxic: r["count"] for r in train.groupBy("toxic").count().collect()}
    share = {(r.toxic, r.term, r.errors): r["count"] / documents[r.toxic] for r in hits.collect()}  # a few rows per term
    of = lambda toxic, term, errors: share.get((toxic, term, errors), 0.0)
    left = {}
    for term in {term for _, term, _ in share}:
        for errors in (2, 1):
            if of(0, term, errors) > max(MISSPELT * of(1, term, 0), of(1, term, errors)):
                left[term] = errors - 1
    return left


def regression(x: np.ndarray, y: np.ndarray, ridge: float = 0.1, rounds: int = 30) -> np.ndarray:
    """Logistic weights, the constant first, by Newton's method with a ridge."""
    x = np.hstack([np.ones((len(x), 1)), x])
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-3
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + penalty * w
        w -= np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty), slope)
    return w


def _examples(train: DataFrame, lexicon: Lexicon) -> DataFrame:
    """(toxic, value): the features of the training rows, and of the toxic ones again with one and two
    letters of hits changed; in one map, since a map on a map keeps two Python workers for each task."""
    shared = train.sparkSession.sparkContext.broadcast(lexicon)

    def mapped(batches):
        for batch in batches:
            labels, found = [], []
            for y, cell in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = cell.as_py() or ""
                changed = [misspelt(text, shared.value, letters) for letters in (1, 2)] if y else []
                for copy in (text, *(copy for copy in changed if copy != text.lower())):
                    labels.append(y)
                    found.append(features(copy, shared.value))
            yield pa.RecordBatch.from_arrays([pa.array(labels, pa.int32()), pa.array(found, pa.list_(pa.float64()))], ["toxic", "value"])

    return train.select("toxic", "t").mapInArrow(mapped, "toxic int, value array<double>")


def fit(docs: DataFrame, labels: DataFrame, doc_id="doc_id", text="text", label="toxic") -> tuple[Lexicon, np.ndarray]:
    """Lexicon and weights from the labelled rows; about SAMPLE short vectors, three for a toxic document, reach the driver."""
    train = training(docs, labels, doc_id, text, label)
    lexicon = learn(train)
    rows = _examples(train, lexicon).collect()
    y = np.array([r.toxic for r in rows], float)
    if len(set(y)) < 2:
        return lexicon, np.array([-1e-6] + [0.0] * len(FEATURES))
    order = sorted(range(len(rows)), key=lambda i: (rows[i].toxic, rows[i].value))  # sums in a fixed order
    return lexicon, regression(np.array([rows[i].value for i in order]), y[order])


def report(docs: DataFrame, labels: DataFrame, doc_id="doc_id", text="text", label="toxic") -> DataFrame:
    """doc_id, held_out, score, predicted per document."""
    lexicon, model = fit(docs, labels, doc_id, text, label)
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.coalesce(remainder(F.col(doc_id)) == 0, F.lit(False)).alias("held_out"), whole(text).alias("text_")
    )
    return _scored(rows, lexicon, model).select("doc_id", "held_out", F.col("value").alias("score"), (F.col("value") >= 0.5).cast("int").alias("predicted"))
