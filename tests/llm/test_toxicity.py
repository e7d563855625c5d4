import math
import random
import zlib

import pytest
from pyspark.sql import functions as F

from matchlake.llm import queries
from matchlake.llm import toxicity as T

rng = random.Random(4)
WORDS = ["pathetic", "worthless", "idiot", "scum", "moronic"]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_automaton_against_distance():
    lexicon = T.Lexicon(WORDS, ["grum", "abcdefghi", "xy"], {"moronic": 0})
    budget = {"pathetic": 1, "worthless": 2, "idiot": 1, "scum": 1, "moronic": 0}
    stems = {"grum": 1, "abcdefghi": 2, "xy": 0}
    for _ in range(4000):
        word = list(rng.choice(WORDS + ["grumble", "xyz", "abcdefghij"]))
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(word) + 1)
            word[at:at + rng.choice((0, 1))] = rng.choice(("", "a", "t", "s"))
        word = "".join(word) or "a"
        near = min(((d, w) for w in WORDS if (d := distance(word, w)) <= budget[w]), default=(9, ""))
        begun = min(((d, s) for s, n in stems.items() for i in range(1, len(word) + 1) if (d := distance(word[:i], s)) <= n), default=(9, ""))
        errors, term = begun if begun[0] < near[0] else near
        want = -1 if errors > 2 else errors + 1 if errors else T.ROOT if begun[0] < near[0] else T.EXACT
        assert lexicon.kind(word) == (want, term)


def test_context():
    lexicon = T.Lexicon(WORDS, ["grumm"])
    f = lambda t: dict(zip(T.FEATURES, T.features(t, lexicon)))
    assert f('he used "idiot" here')["quoted"] > 0 == f('he used "idiot" here')["word"]
    assert f("the word idiot is old")["quoted"] > 0 and f("« idiot »")["quoted"] > 0 == f('"a" idiot "b"')["quoted"]
    assert f("you are an IDIOT")["addressed"] > 0 and f("you are an IDIOT")["word"] > 0
    assert f("a pathetik thing")["one_error"] > 0 == f("a pathetik thing")["word"]
    assert f("worthlzzs")["two_errors"] > 0 and f("grummeln")["root"] > 0 and f("grimmeln")["one_error"] > 0
    assert f("") == f("nothing to see") == dict.fromkeys(T.FEATURES, 0.0)


def test_features_against_a_plain_reading():
    """Every hit looked up by edit distance, its window read off a list of words."""
    lexicon = T.Lexicon(WORDS, [])
    vocab = WORDS + ["idiots", "pathetik", "you", "said", "plain", "things", "worthlez", "moronic"]
    budget = {w: 2 if len(w) >= 9 else 1 if len(w) >= 4 else 0 for w in WORDS}
    for _ in range(300):
        words = rng.choices(vocab, k=rng.randint(1, 25))
        marks = [rng.random() < 0.2 for _ in words]
        text = " ".join(f'"{w}"' if m else w for w, m in zip(words, marks))
        counts = [0.0] * 6
        for i, w in enumerate(words):
            errors = min((d for t in WORDS if (d := distance(w, t)) <= budget[t]), default=None)
            if errors is None:
                continue
            before, after = words[max(0, i - 5):i], words[i + 1:i + 6]
            quoted = marks[i] or "said" in before
            counts[4 if quoted else 0 if errors == 0 else errors + 1] += 1
            counts[5] += "you" in before + after
        want = [math.log1p(c) for c in counts] + [math.log1p(1000 * sum(counts[:4]) / len(words))]
        assert T.features(text, lexicon) == pytest.approx(want)


def data(spark, n=400):
    vocab = ["".join(rng.choice("bcdfg") + rng.choice("aeiou") for _ in range(3)) for _ in range(300)]
    rows, labels = [], []
    for i in range(n):
        words = rng.choices(vocab, k=30)
        if i % 4 == 0:
            for _ in range(3):
                words.insert(rng.randrange(30), rng.choice(WORDS))
        rows.append((i, " ".join(words), "x", "x"))
        labels.append((i, 1, int(i % 4 == 0)))
    schema = "doc_id long, text string, score string, held_out string"
    return rows, schema, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_learning_and_odd_rows(spark):
    rows, schema, labels = data(spark)
    extra = [(1000, None, "x", "x"), (1001, "", "x", "x"), (None, rows[0][1], "x", "x"), (1003, rows[0][1], "x", "x"), (1003, rows[0][1], "x", "x"),
             (1004, "a worthles idiiot " + "fine " * 20, "x", "x"), (1005, "word " * 200_000, "x", "x")]
    got = T.report(spark.createDataFrame(rows + extra, schema), labels).collect()
    assert len(got) == len(rows) + len(extra)
    by = {r.doc_id: r for r in got}
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert all(by[i].predicted == (i % 4 == 0) for i in range(400))
    assert by[1000].predicted == by[1001].predicted == by[1005].predicted == 0 and by[1004].predicted == 1
    assert by[None].score == by[1003].score and not by[None].held_out
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got if r.doc_id is not None)


def test_held_out_labels_are_not_read(spark):
    rows, schema, labels = data(spark)
    docs = spark.createDataFrame(rows, schema)
    turned = labels.withColumn("toxic", F.when(T.remainder(F.col("doc_id")) == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    score = lambda l: {r.doc_id: r.score for r in T.report(docs, l).collect()}
    assert score(labels) == score(turned)


@pytest.mark.parametrize("kept", ["false", "toxic = 1"])
def test_too_few_labels(spark, kept):
    rows, schema, labels = data(spark, 40)
    got = T.report(spark.createDataFrame(rows, schema), labels.where(kept)).collect()
    assert len(got) == 40 and all(0 <= r.score <= 1 for r in got)
    assert T.report(spark.createDataFrame([], schema), labels).collect() == []


def test_misspelt_and_quoted_terms(spark):
    """Every hit of the held-out toxic documents with one letter changed, as the automaton and without it."""
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    lexicon, model = T.fit(docs, labels)
    held = docs.join(labels.where("toxic = 1"), "doc_id").where(T.remainder(F.col("doc_id")) == 0)
    texts = [r.text for r in held.select("text").collect()]
    score = lambda t, lex: model[0] + model[1:] @ T.features(t, lex)
    recall = lambda change, lex: sum(score(change(t), lex) >= 0 for t in texts) / len(texts)
    exact = T.Lexicon(lexicon.words, lexicon.stems, dict.fromkeys(lexicon.words + lexicon.stems, 0))
    edited = lambda t: T.misspelt(t, exact, 1)
    figures = recall(lambda t: t, lexicon), recall(edited, lexicon), recall(edited, exact)
    print("recall as written, edited, edited without errors:", figures, len(lexicon.words), lexicon.stems)
    assert figures[0] >= 0.9 and figures[1] >= 0.8 and figures[2] < 0.3, figures
    hit = [t for t in texts if any(T.features(t, exact)[:2])]
    marked = lambda t: T.WORD.sub(lambda m: f'"{m[0]}"' if exact.kind(m[0].lower())[0] >= 0 else m[0], t)
    assert hit and all(score(marked(t), lexicon) < score(t, lexicon) for t in hit)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.QUERIES["op5_toxicity"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.toxic for r in got) >= 0.95 * len(got)
    assert sum(r.predicted for r in got if r.toxic) >= 0.6 * sum(r.toxic for r in got)
