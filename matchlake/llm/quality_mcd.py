"""Quality rules: robust multivariate outliers by minimum-covariance-determinant estimates.

Counting runs inside the row: no words leave it and nothing is shuffled. Repeated five-word windows
are found by sorting the hashes of a text's windows, and only in texts in which one occurs twice.

Each document that passes the base rules becomes a vector: log of the mean word length, square root
of the share of symbols, share of repeated lines, share of repeated words. Per language and source
the estimate covers the ``COVER`` share of documents with the least determinant: from two robust
starts (median and quartile range with a tanh correlation, and with spatial signs) concentration
steps select the nearest documents and estimate anew; the start with the smaller determinant wins.
A step is one pass over narrow rows: sums per (group, start, distance bin) are combined in the tasks,
so a hot group costs no more than its rows, and the bins tell which rows are the nearest. Values are
whole ten-thousandths and sums are exact decimals, so reruns agree bit by bit.

``FLOOR`` is the spread that any clean prose may show; its square is added to each variance, since
most clean texts have no symbol and no repeated line and would give a singular estimate. A group's
estimate is drawn towards that of its language, and this towards that of all documents: the documents
beyond ``LEAST``, of which four dimensions need as many, weigh n / (n + SMALL / 10). So verdicts change
smoothly with size, and a group of LEAST or fewer, of which a single one may be junk, follows the others.

Cases: a null or empty text has no words and fails the base rules; null languages and sources are
groups of their own; an empty table gives an empty result; equal rows get equal verdicts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.once import once
from ..session import written
from .common import BLANKS, key_text, packed, whole, words

WINDOW = 5
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 10
MAX_REPEAT_PCT = 20
#: log mean word length, root of the symbol share, share of repeated lines, share of repeated words
FLOOR = (0.10, 0.025, 0.10, 0.06)
DIM = len(FLOOR)
SCALE = 10_000
COVER = 0.75
STEPS = 4
#: Documents beyond LEAST with which a group weighs ten times as much as the wider one it is drawn towards.
LEAST, SMALL = 20, 200
#: Chi-square of 4 degrees of freedom: exceeded by one in a million.
CUTOFF = 33.38
#: Makes the covariance of the nearest 75 % estimate that of all, for 4 normal variables.
CONSISTENCY = 0.75 / 0.5046
#: Bins of distance per power of e.
BINS = 32


def counts(packed_docs: DataFrame, text: str = "text") -> DataFrame:
    """Append n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and n_lines."""
    kept = packed_docs.columns
    t = F.col(text)
    df = once(
        packed_docs,
        w_=words(t),
        word_chars=F.length(F.translate(t, BLANKS, "")).cast("long"),
        n_symbols=(F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long"),
        l_=F.filter(F.split(t, "\n"), lambda line: F.trim(line, F.lit(BLANKS)) != ""),
    )
    numbers = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines"]
    df = df.select(
        *kept, "word_chars", "n_symbols", F.size("w_").cast("long").alias("n_words"), F.size("l_").cast("long").alias("n_lines"),
        (F.size("l_") - F.size(F.array_distinct("l_"))).cast("long").alias("n_dup_lines"),
        F.transform("w_", lambda w: F.xxhash64(w)).alias("h_"),
    )
    df = once(df, h2_=F.col("h_"))  # hashes are made once, not once for each window
    last = F.size("h2_") - WINDOW
    grams = F.when(
        last >= 0,
        F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.xxhash64(*[F.get("h2_", i + k) for k in range(WINDOW)])),
    ).otherwise(F.array().cast("array<bigint>"))
    df = once(df.select(*kept, *numbers, grams.alias("g_")), g2_=F.col("g_")).drop("g_")
    repeats = F.size(F.array_distinct("g2_")) < F.size("g2_")
    ranked = F.when(repeats, F.array_sort(F.transform("g2_", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    df = once(df.select(*kept, *numbers, ranked.alias("s_")), s2_=F.col("s_")).drop("s_")
    places = F.when(
        F.col("s2_").isNotNull(),
        F.array_sort(F.array_compact(F.transform("s2_", lambda x, k: F.when(
            (x["h"] == F.get("s2_", k - 1)["h"]) | (x["h"] == F.get("s2_", k + 1)["h"]), x["i"]
        )))),
    )
    df = once(df.select(*kept, *numbers, places.alias("p_")), p2_=F.col("p_")).drop("p_")
    # a window covers its words up to the next repeated window
    covered = F.aggregate(
        F.transform("p2_", lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get("p2_", k + 1) - p, F.lit(WINDOW)))),
        F.lit(0).cast("long"), lambda a, x: a + x,
    )
    return df.select(*kept, *numbers, F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PCT)


def vector() -> list[Column]:
    n, chars = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("word_chars"), F.lit(1))
    values = (
        F.log(chars / n), F.sqrt(F.col("n_symbols") / chars),
        F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)), F.col("n_repeat_words") / n,
    )
    return [F.round(v * SCALE).cast("long").alias(f"x{i}") for i, v in enumerate(values)]


def _sums() -> list[Column]:
    square = [
        F.sum((F.col(f"x{i}") * F.col(f"x{j}")).cast("decimal(20,0)")).alias(f"s{i}{j}") for i in range(DIM) for j in range(i + 1)
    ]
    return [F.count("*").alias("n"), *[F.sum(F.col(f"x{i}").cast("decimal(20,0)")).alias(f"s{i}") for i in range(DIM)], *square]


def _factored(df: DataFrame, keys: list[str], c: float) -> DataFrame:
    """From covariance columns c{i}{j} (i >= j) and means m{i}: the inverse Cholesky factor l{i}{j}
    of ``c`` times the covariance plus the squared floors, that product as v{i}{j}, and log_det."""
    means = [f"m{i}" for i in range(DIM)]
    products = [f"v{i}{j}" for i in range(DIM) for j in range(i + 1)]
    df = df.select(*keys, *means, *[(F.col(f"c{v[1:]}") * c).alias(v) for v in products], *[
        (F.col(f"c{i}{j}") * c + (FLOOR[i] ** 2 if i == j else 0.0)).alias(f"a{i}{j}") for i in range(DIM) for j in range(i + 1)
    ])
    for j in range(DIM):  # column by column; rounding cannot reach the floor
        diagonal = F.sqrt(F.greatest(
            F.col(f"a{j}{j}") - sum((F.col(f"f{j}{k}") * F.col(f"f{j}{k}") for k in range(j)), F.lit(0.0)), F.lit(FLOOR[j] ** 2 / 4)
        ))
        df = df.withColumn(f"f{j}{j}", diagonal)
        df = df.withColumns({
            f"f{i}{j}": (F.col(f"a{i}{j}") - sum((F.col(f"f{i}{k}") * F.col(f"f{j}{k}") for k in range(j)), F.lit(0.0))) / F.col(f"f{j}{j}")
            for i in range(j + 1, DIM)
        } or {f"f{j}{j}": F.col(f"f{j}{j}")})
    for j in range(DIM):
        df = df.withColumn(f"l{j}{j}", 1.0 / F.col(f"f{j}{j}"))
        for i in range(j + 1, DIM):
            df = df.withColumn(
                f"l{i}{j}", -sum((F.col(f"f{i}{k}") * F.col(f"l{k}{j}") for k in range(j, i)), F.lit(0.0)) / F.col(f"f{i}{i}")
            )
    log_det = sum((F.log(f"f{i}{i}") for i in range(DIM)), F.lit(0.0)) * 2
    return df.select(*keys, *means, *products, *[f"l{i}{j}" for i in range(DIM) for j in range(i + 1)], log_det.alias("log_det"))


def distance() -> Column:
    """Squared Mahalanobis distance of x0.. from the estimate in the same row."""
    z = [F.col(f"x{i}") / float(SCALE) - F.col(f"m{i}") for i in range(DIM)]
    parts = [sum((F.col(f"l{i}{j}") * z[j] for j in range(i + 1)), F.lit(0.0)) for i in range(DIM)]
    return sum((p * p for p in parts), F.lit(0.0))


def _moments(sums: DataFrame, keys: list[str]) -> DataFrame:
    n = F.col("n").cast("double")
    mean = lambda i: F.col(f"s{i}").cast("double") / n / SCALE
    return sums.select(*keys, *[mean(i).alias(f"m{i}") for i in range(DIM)], *[
        (F.col(f"s{i}{j}").cast("double") / n / SCALE**2 - mean(i) * mean(j)).alias(f"c{i}{j}") for i in range(DIM) for j in range(i + 1)
    ])


def _starts(vectors: DataFrame) -> DataFrame:
    """Two robust first estimates per group, around the medians."""
    tagged = vectors.select("grp", F.explode(F.array(*[F.struct(F.lit(i).alias("dim"), F.col(f"x{i}").alias("x")) for i in range(DIM)])).alias("v"))
    tally = tagged.groupBy("grp", "v.dim", "v.x").count()
    part = Window.partitionBy("grp", "dim")
    ranked = tally.withColumns({"upto": F.sum("count").over(part.orderBy("x")), "all": F.sum("count").over(part)})
    at = lambda q: F.min(F.when(F.col("upto") >= F.ceil(F.col("all") * q), F.col("x"))) / float(SCALE)
    quartiles = ranked.groupBy("grp", "dim").agg(at(0.5).alias("mid"), ((at(0.75) - at(0.25)) / 1.349).alias("spread"))
    centre = written(
        quartiles.groupBy("grp").agg(
            *[F.max(F.when(F.col("dim") == i, F.col("mid"))).alias(f"m{i}") for i in range(DIM)],
            *[F.max(F.when(F.col("dim") == i, F.greatest(F.col("spread"), F.lit(FLOOR[i])))).alias(f"d{i}") for i in range(DIM)],
        ), "mcd",
    )
    z = [((F.col(f"x{i}") / float(SCALE) - F.col(f"m{i}")) / F.col(f"d{i}")) for i in range(DIM)]
    norm = F.sqrt(sum((v * v for v in z), F.lit(0.0)) + 1e-12)
    fixed = lambda v: F.round(v * SCALE).cast("long")
    both = F.array(
        F.struct(F.lit(0).alias("start"), *[fixed(F.tanh(v)).alias(f"x{i}") for i, v in enumerate(z)]),
        F.struct(F.lit(1).alias("start"), *[fixed(v / norm).alias(f"x{i}") for i, v in enumerate(z)]),
    )
    turned = vectors.join(centre, "grp").select("grp", F.explode(both).alias("v")).select("grp", "v.*")
    shapes = _moments(turned.groupBy("grp", "start").agg(*_sums()), ["grp", "start"]).drop(*[f"m{i}" for i in range(DIM)])
    full = shapes.join(centre, "grp")
    # the shape's correlations, with the quartile spreads for scale
    scaled = full.select("grp", "start", *[f"m{i}" for i in range(DIM)], *[
        (F.col(f"c{i}{j}") / F.sqrt((F.col(f"c{i}{i}") + 1e-6) * (F.col(f"c{j}{j}") + 1e-6)) * F.col(f"d{i}") * F.col(f"d{j}")).alias(f"c{i}{j}")
        for i in range(DIM) for j in range(i + 1)
    ])
    return _factored(scaled, ["grp", "start"], 1.0)


def _step(vectors: DataFrame, model: DataFrame) -> DataFrame:
    """One concentration step: an estimate from the COVER share of the group nearest to the last."""
    binned = F.floor(F.log(F.greatest(distance(), F.lit(1e-6))) * BINS).cast("int")
    near = vectors.join(model, "grp").withColumn("bin", binned).groupBy("grp", "start", "bin").agg(*_sums())
    part = Window.partitionBy("grp", "start")
    chosen = near.withColumns({"upto": F.sum("n").over(part.orderBy("bin")), "all": F.sum("n").over(part)}).where(
        F.col("upto") - F.col("n") < F.ceil(F.col("all") * COVER)
    )
    names = ["n", *[f"s{i}" for i in range(DIM)], *[f"s{i}{j}" for i in range(DIM) for j in range(i + 1)]]
    sums = chosen.groupBy("grp", "start").agg(*[F.sum(c).alias(c) for c in names])
    return _factored(_moments(sums, ["grp", "start"]), ["grp", "start"], CONSISTENCY)


def fit(stats: DataFrame) -> DataFrame:
    """Estimates by (lang_key, source_key), from narrow rows with these and the counts."""
    sound = stats.where(~base_failed()).select("lang_key", "source_key", *vector())
    groups = {
        "cell": F.concat(F.lit("s"), "lang_key", F.lit("|"), "source_key"), "lang": F.concat(F.lit("l"), "lang_key"), "all": F.lit("all"),
    }
    vectors = written(sound.select(F.explode(F.array(*groups.values())).alias("grp"), *[f"x{i}" for i in range(DIM)]), "mcd")
    model = written(_starts(vectors), "mcd")
    for _ in range(STEPS):
        model = written(_step(vectors, model), "mcd")
    best = model.withColumn(
        "rank", F.row_number().over(Window.partitionBy("grp").orderBy("log_det", "start"))
    ).where("rank = 1")
    names = [*[f"m{i}" for i in range(DIM)], *[f"v{i}{j}" for i in range(DIM) for j in range(i + 1)]]
    best = written(best.join(vectors.groupBy("grp").agg(F.count("*").cast("double").alias("n")), "grp").select("grp", "n", *names), "mcd")
    cells = sound.select("lang_key", "source_key").distinct().select("lang_key", "source_key", *[g.alias(k) for k, g in groups.items()])
    for k in groups:
        cells = cells.join(best.select(F.col("grp").alias(k), *[F.col(c).alias(f"{k}_{c}") for c in ("n", *names)]), k)
    beyond = lambda k: F.greatest(F.col(f"{k}_n") - LEAST, F.lit(0.0))
    share = lambda k: beyond(k) / (beyond(k) + SMALL / 10)
    drawn = lambda c: F.col(f"cell_{c}") * share("cell") + (F.col(f"lang_{c}") * share("lang") + F.col(f"all_{c}") * (1 - share("lang"))) * (1 - share("cell"))
    keys = ["lang_key", "source_key"]
    blended = written(cells.select(*keys, *[drawn(c).alias(c.replace("v", "c")) for c in names]), "mcd")
    factors = _factored(blended, keys, 1.0).drop("log_det", *[c for c in names if c[0] == "v"])
    return written(factors, "mcd")


def judged(stats: DataFrame, model: DataFrame) -> DataFrame:
    """Append base_failed, distance2 (null for failed rows) and kept. A language and source without
    an estimate have only failed documents."""
    keys = [F.col(c) for c in stats.columns]
    joined = stats.join(model, ["lang_key", "source_key"], "left")
    d = F.when(~F.col("base_failed"), distance())
    out = joined.withColumn("base_failed", base_failed()).withColumns({f"x{i}": c for i, c in enumerate(vector())})
    return out.select(*keys, "base_failed", d.alias("distance2")).withColumn(
        "kept", ~F.col("base_failed") & F.coalesce(F.col("distance2") <= CUTOFF, F.lit(False))
    )


def _keys(lang: str, source: str) -> dict[str, Column]:
    return {"lang_key": key_text(F.col(lang)), "source_key": key_text(F.col(source))}


def report(docs: DataFrame, doc_id="doc_id", text="text", lang="lang", source="source") -> DataFrame:
    """One narrow row per document with its counts and verdict."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), whole(text).alias("text_"), *[v.alias(k) for k, v in _keys(lang, source).items()])
    stats = written(counts(rows, "text_").drop("text_"), "mcd")
    return judged(stats, fit(stats)).drop("lang_key", "source_key", "n_lines")


def keep(docs: DataFrame, doc_id="doc_id", text="text", lang="lang", source="source") -> DataFrame:
    """The documents that pass, with the columns of ``docs``. Texts are counted a second time here
    instead of being stored or shuffled."""
    rows = packed(docs, text_=whole(text), **_keys(lang, source))
    model = fit(written(counts(rows.drop("doc"), "text_").drop("text_"), "mcd"))
    return judged(counts(rows, "text_"), model).where("kept").select("doc.*")
