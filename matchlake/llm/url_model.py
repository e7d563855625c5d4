"""URL filter: rules first, then a likelihood ratio of character models.

Two variable-order Markov models, one of URLs that a rule allows and one of those that a rule blocks,
give each character's probability from up to ``ORDER`` characters before it. An order's estimate is
mixed with that of the next shorter one by how often its context was seen (Witten-Bell), so unseen
contexts fall back. The verdict is the difference of log-likelihoods per character against a
threshold calibrated on labelled URLs that were kept out of the counts.

Characters map to 32 classes (a letter, any digit, dot, slash, joiner, mark, begin, other), so a model
has at most 32^4 n-grams however many URLs there are: that is the proven bound of what is sent to the
tasks. Every URL counts: counts are combined in the tasks before their shuffle, and scoring is a
lookup inside the row, with no shuffle of URLs at all.

Cases: a null URL, or one without ``://``, has an empty host and path, fits no rule and is judged by
the model on its text; if no URL is labelled, all scores are 0 and the verdict is allow; repeated
rows get equal verdicts; an empty table gives an empty result; a very long URL is scored whole, in its
own row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.once import once
from ..session import written
from .common import lower_ascii, whole

#: (host, path, verdict): a rule fits its host and all subdomains, and the longest fitting rule wins.
RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"))
ORDER = 3
CLASSES = 32
#: One labelled URL in this many calibrates and is not counted.
HELD = 4
#: Steps of the score (natural log per character) for the threshold.
STEP = 0.01
REACH = 20.0


def _parts(df: DataFrame, url: str) -> DataFrame:
    rest = F.regexp_extract(F.col(url), r"(?s)^.*?://(.*)$", 1)
    df = once(df, rest_=rest)
    return df.withColumns({
        "host": lower_ascii(F.regexp_extract("rest_", r"(?s)^([^/?#]*)", 1)),
        "path": F.regexp_extract("rest_", r"(?s)^[^/?#]*([^?#]*)", 1),
    }).drop("rest_")


def _ruled(rules=RULES) -> tuple[Column, Column]:
    """Name and verdict of the longest fitting rule; null where none fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for host, path, what in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((F.col("host") == host) | F.col("host").endswith(f".{host}")) & F.col("path").startswith(path)
        name, verdict = F.when(fits, F.lit(host + path)).otherwise(name), F.when(fits, F.lit(what)).otherwise(verdict)
    return name, verdict


def _classes(url: Column) -> Column:
    """The classes of a URL's characters, after ORDER begin marks."""
    # one text of single class letters: a-z, 0 digit, . / - and ? kept, ~ for the rest
    plain = F.regexp_replace(F.translate(lower_ascii(url), "123456789_=&#%:;,+", "000000000-?????---"), r"(?s)[^a-z0./?-]", "~")
    code = lambda c: (
        F.when(c.between("a", "z"), F.ascii(c) - 97).when(c == "0", 26).when(c == ".", 27).when(c == "/", 28)
        .when(c == "-", 29).when(c == "?", 30).otherwise(31)
    )
    letters = F.filter(F.split(plain, ""), lambda c: c != "")
    return F.concat(F.array_repeat(F.lit(31), ORDER), F.transform(letters, lambda c: code(c).cast("int")))


def _grams(classes: str) -> Column:
    """The n-gram of ORDER + 1 classes at each character, as one number."""
    at = lambda i, k: F.get(classes, i + k)
    number = lambda i: sum((at(i, k) * CLASSES ** (ORDER - k) for k in range(ORDER + 1)), F.lit(0)).cast("int")
    n = F.size(classes) - ORDER
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), number)).otherwise(F.array().cast("array<int>"))


def judged_parts(pages: DataFrame, url: str, rules=RULES) -> DataFrame:
    """Append host, path, rule, ruled (its verdict) and grams."""
    df = _parts(pages, url)
    name, verdict = _ruled(rules)
    df = once(df, rule=name, ruled=verdict, classes_=_classes(F.col(url)))
    return once(df, grams_=_grams("classes_")).drop("classes_")


def likelihoods(labelled: DataFrame) -> DataFrame:
    """(gram, lr) for every n-gram there can be: natural log odds of allow against block.

    ``labelled`` has gram, allow and block, its counts. An n-gram that no labelled URL holds has the
    probability that its longest seen context leaves for it.
    """
    sides = ("allow", "block")
    levels = labelled.withColumn("level", F.lit(ORDER))
    everything = levels
    for k in range(ORDER - 1, -1, -1):  # an n-gram's shorter forms drop its first class
        levels = levels.select((F.col("gram") % CLASSES ** (k + 1)).alias("gram"), *sides).groupBy("gram").agg(
            *[F.sum(s).alias(s) for s in sides]
        ).withColumn("level", F.lit(k))
        everything = everything.unionByName(levels)
    counts = written(everything.select("level", F.col("gram").cast("long").alias("gram"), *sides), "url")
    contexts = written(counts.groupBy("level", F.floor(F.col("gram") / CLASSES).alias("context")).agg(
        *[F.sum(s).alias(f"{s}_n") for s in sides], *[F.sum((F.col(s) > 0).cast("long")).alias(f"{s}_kinds") for s in sides]
    ), "url")
    # from the shortest order up, over all n-grams: p = (count + kinds * p_shorter) / (n + kinds)
    out = labelled.sparkSession.range(1).select(F.lit(0).cast("long").alias("shorter"), *[F.lit(1.0 / CLASSES).alias(f"p_{s}") for s in sides])
    for k in range(ORDER + 1):
        grid = labelled.sparkSession.range(CLASSES ** (k + 1)).select(
            F.col("id").alias("gram"), (F.col("id") % CLASSES ** k).alias("shorter"), F.floor(F.col("id") / CLASSES).alias("context"))
        seen, context = [df.where(F.col("level") == k).drop("level") for df in (counts, contexts)]
        rows = grid.join(out, "shorter").join(seen, "gram", "left").join(context, "context", "left")
        out = rows.select(F.col("gram").alias("shorter"), *[
            F.when(F.col(f"{s}_n") > 0, (F.coalesce(s, F.lit(0)) + F.col(f"{s}_kinds") * F.col(f"p_{s}")) / (F.col(f"{s}_n") + F.col(f"{s}_kinds")))
            .otherwise(F.col(f"p_{s}")).alias(f"p_{s}") for s in sides
        ])
    return out.select(F.col("shorter").alias("gram"), (F.ln("p_allow") - F.ln("p_block")).alias("lr"))


def _bounded(ratios: DataFrame) -> DataFrame:
    """One row with the ratios as an array indexed by n-gram, CLASSES ** (ORDER + 1) floats (4 MB)."""
    pairs = ratios.agg(F.array_sort(F.collect_list(F.struct("gram", F.col("lr").cast("float").alias("lr")))).alias("pairs"))
    return pairs.select(F.transform("pairs", lambda p: p["lr"]).alias("ratios"))


def score(parts: DataFrame, ratios: DataFrame) -> DataFrame:
    """Append score: the mean ratio over a URL's characters, 0 for an empty one."""
    lookup = F.aggregate("grams_", F.lit(0.0), lambda total, g: total + F.coalesce(F.get("ratios", g), F.lit(0.0)))
    with_model = parts.select("*", ratios.scalar().alias("ratios"))
    return with_model.withColumn("score", F.round(lookup / F.greatest(F.size("grams_"), F.lit(1)), 6)).drop("ratios")


def threshold(scored: DataFrame) -> DataFrame:
    """One row, ``cut``: the score that errs least on labelled URLs, both errors as shares of their
    side; 0 if a side is missing. Ties go to the cut nearest 0, then the lower."""
    step = F.least(F.lit(REACH), F.greatest(F.lit(-REACH), F.col("score")))
    bins = scored.groupBy(F.floor(step / STEP).cast("int").alias("bin")).agg(
        *[F.sum((F.col("ruled") == s).cast("long")).alias(s) for s in ("allow", "block")]
    )
    every, below = Window.partitionBy(), Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    errs = bins.select(
        "bin", F.sum("allow").over(every).alias("allows"), F.sum("block").over(every).alias("blocks"),
        F.coalesce(F.sum("allow").over(below), F.lit(0)).alias("lost"), F.coalesce(F.sum("block").over(below), F.lit(0)).alias("caught"),
    ).where("allows > 0 and blocks > 0").withColumn("error", F.col("lost") / F.col("allows") + 1 - F.col("caught") / F.col("blocks"))
    best = errs.agg(F.min_by("bin", F.struct("error", F.abs("bin"), "bin")).alias("bin"))
    return best.select(F.coalesce(F.col("bin") * STEP, F.lit(0.0)).alias("cut"))


def report(pages: DataFrame, page_id="page_id", url="url", rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, score per page."""
    rows = pages.select(F.col(page_id).alias("page_id"), whole(url).alias("url_"))
    parts = judged_parts(rows, "url_", rules)
    held = F.pmod(F.xxhash64("url_"), F.lit(HELD)) == 0
    counted = parts.where(F.col("ruled").isNotNull() & ~held).select("ruled", F.explode("grams_").alias("gram"))
    counts = counted.groupBy("gram").agg(*[F.sum((F.col("ruled") == s).cast("long")).alias(s) for s in ("allow", "block")])
    ratios = written(_bounded(likelihoods(written(counts, "url"))), "url")
    cut = written(threshold(score(parts.where(F.col("ruled").isNotNull() & held), ratios)), "url")
    scored = score(parts, ratios)
    verdict = F.coalesce("ruled", F.when(F.col("score") >= F.col("cut"), F.lit("allow")).otherwise(F.lit("block")))
    return scored.select("*", cut.scalar().alias("cut")).select("page_id", "host", "path", "rule", verdict.alias("verdict"), "score")
