"""Personal data: patterns propose, checksums confirm, nearby words adjust the score.

Base kinds are e-mail, IP address, payment card and phone number; a base match that fails its check is
dropped and not tried again. Added kinds are IBAN (mod 97), and national ids and local phone numbers,
which need a word such as "ssn" or "call" close by. Each span carries a score: its kind's trust, plus
or minus the words within ``NEAR`` code points. Base spans stay whatever their score; added ones need
``MIN_SCORE``.

Possessive patterns keep a search linear in the text: a run of letters is read once, not once from
each of its letters. ``\\G`` admits a match that begins where the last one ended inside a run.

Everything happens inside the row. Cases: null and empty texts have no spans; very long texts are
searched whole; repeated rows give equal results; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.once import once
from .common import packed, whole
from .spans import blocks, found, listed, number, of_kinds, part, running

BASE = ("email", "ip", "card", "phone")
ADDED = ("iban", "national_id", "local_phone")
LOCAL = r"[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?)(?![A-Za-z0-9])",
    "national_id": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "local_phone": r"(?<![0-9+().-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[.-][0-9]{4}(?![0-9-])",
}
TRUST = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.8, "national_id": 0.4, "local_phone": 0.4}
FOR = {
    "email": "mail|contact|correo|courriel|kontakt", "ip": "ip|address|host|server|login|client",
    "card": "card|visa|mastercard|amex|credit|tarjeta|carte|karte", "phone": "phone|call|tel|mobile|fax|telefon",
    "iban": "iban|account|bank|konto|cuenta|compte", "national_id": "ssn|social|security|taxpayer|passport",
    "local_phone": "phone|call|tel|mobile|fax|telefon",
}
AGAINST = "example|sample|test|dummy|version|isbn|order|invoice"
STEP = 0.2
NEAR = 40
MIN_SCORE = 0.5


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(match: Column) -> Column:
    d = _digits(match)
    n = F.length(d)

    def add(total: Column, i: Column) -> Column:
        value = F.ascii(F.substring(d, i, F.lit(1))) - 48
        double = value * 2
        return total + F.when((n - i) % 2 == 1, F.when(double > 9, double - 9).otherwise(double)).otherwise(value)

    return F.when(n.between(13, 19), F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0).otherwise(F.lit(False))


def _mod97(match: Column) -> Column:
    plain = F.translate(match, " ", "")
    turned = F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4))

    def add(rest: Column, i: Column) -> Column:
        code = F.ascii(F.substring(turned, i, F.lit(1)))
        return F.when(code >= 65, rest * 100 + code - 55).otherwise(rest * 10 + code - 48) % 97

    return F.length(plain).between(15, 34) & (F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), add) == 1)


def _small_parts(match: Column) -> Column:
    stripped = F.transform(F.split(match, r"\."), lambda p: F.regexp_replace(p, "^0+", ""))
    return F.forall(stripped, lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (p <= "255")))


def _valid(s: Column) -> Column:
    return (
        F.when(s["kind"] == "ip", _small_parts(s["match"])).when(s["kind"] == "card", _luhn(s["match"]))
        .when(s["kind"] == "phone", F.length(_digits(s["match"])).between(9, 15)).when(s["kind"] == "iban", _mod97(s["match"]))
        .otherwise(F.lit(True))
    )


def _score(cut: Column, s: Column) -> Column:
    """Trust in the kind, a step up for a fitting word nearby and a step down for one against it."""
    around = F.lower(F.concat(part(cut, F.greatest(F.lit(0), s["start"] - NEAR), s["start"]), F.lit(" "), part(cut, s["end"], s["end"] + NEAR)))
    return F.get(F.transform(F.array(around), lambda near: _trusted(near, s["kind"])), 0)


def _trusted(around: Column, kind: Column) -> Column:
    trust, words = F.lit(None).cast("double"), F.lit(False)
    for k in TRUST:
        trust = F.when(kind == k, F.lit(TRUST[k])).otherwise(trust)
        words = F.when(kind == k, around.rlike(rf"(?<!\p{{L}})(?:{FOR[k]})")).otherwise(words)
    against = around.rlike(rf"(?<!\p{{L}})(?:{AGAINST})(?!\p{{L}})")
    score = trust + F.when(words, STEP).otherwise(0.0) - F.when(against, STEP).otherwise(0.0)
    return F.round(F.least(F.lit(1.0), F.greatest(F.lit(0.0), score)), 2)


def spans(df: DataFrame, text: str, to: str = "spans_") -> DataFrame:
    """Append ``to``: array of (kind, start, end, match, score), by kind and then by place."""
    keep = df.columns
    t = F.col(text)
    digit = t.rlike("[0-9]")
    guards = {"email": t.contains("@"), "ip": digit, "card": digit, "phone": t.contains("+")}
    guards |= {k: digit for k in ADDED}
    df = found(df, text, {k: (guards[k], p) for k, p in PATTERNS.items()}, "proposed_")
    df = once(df, confirmed_=F.filter("proposed_", _valid))
    df = once(df.drop("proposed_"), cut_=F.when(F.size("confirmed_") > 0, blocks(t)))
    scored = F.transform("confirmed_", lambda s: F.struct(s["kind"], s["start"], s["end"], s["match"], _score(F.col("cut_"), s).alias("score")))
    df = once(df, scored_=scored)
    sure = F.filter("scored_", lambda s: s["kind"].isin(*BASE) | (s["score"] >= MIN_SCORE))
    return df.select(*keep, sure.alias(to))


def report(docs: DataFrame, doc_id="doc_id", text="text") -> DataFrame:
    """Counts, digest and spans of each document."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), whole(text).alias("text_"))
    df = spans(rows, "text_").drop("text_")
    every = F.col("spans_")
    return df.select(
        "doc_id", *[number(every, k).alias(f"n_{k}") for k in BASE],
        F.sha2(listed(of_kinds(every, BASE)), 256).alias("base_sha256"), listed(every).alias("spans"),
        *[number(every, k).alias(f"n_{k}") for k in ADDED],
        F.array_join(F.transform(every, lambda s: s["score"].cast("string")), ",").alias("scores"),
    )


def redacted(docs: DataFrame, text="text", n_chars: str | None = "n_chars") -> DataFrame:
    """``docs`` with each span replaced by its kind in brackets; overlapping spans become one, named
    after the first. ``n_chars``, if the table has it, follows the new text. A text without spans,
    a null one included, stays as it is."""
    df = spans(packed(docs, text_=whole(text)), "text_")
    ordered = F.array_sort(F.transform("spans_", lambda s: F.struct(s["start"], s["end"], s["kind"])))
    df = once(df, ordered_=ordered)
    df = running(df, {"reach_": (F.transform("ordered_", lambda s: s["end"]), F.greatest)})
    every = F.when(F.size("ordered_") > 0, F.sequence(F.lit(0), F.size("ordered_") - 1))
    begins = lambda i: F.get(F.col("ordered_"), i)["start"] >= F.coalesce(F.get(F.col("reach_"), i - 1), F.lit(0))
    df = once(df, heads_=F.filter(every, begins))  # the spans that no earlier one reaches

    def merged(i: Column, k: Column) -> Column:
        head, after = F.get(F.col("ordered_"), i), F.coalesce(F.get(F.col("heads_"), k + 1), F.size("ordered_"))
        return F.struct(head["start"].alias("start"), F.get(F.col("reach_"), after - 1).alias("end"), head["kind"].alias("kind"))

    df = once(df, merged_=F.transform("heads_", merged), cut_=F.when(F.size("ordered_") > 0, blocks(F.col("text_"))))
    t, cut = F.col("text_"), F.col("cut_")
    pieces = F.transform("merged_", lambda s, i: F.concat(
        part(cut, F.coalesce(F.get(F.col("merged_"), i - 1)["end"], F.lit(0)), s["start"]), F.lit("["), F.upper(s["kind"]), F.lit("]")))
    tail = F.substring(t, F.element_at("merged_", -1)["end"] + 1, F.length(t))
    clean = F.when(F.col("merged_").isNotNull(), F.concat(F.array_join(pieces, ""), tail)).otherwise(F.col(f"doc.{text}"))
    df = once(df, clean_=clean)
    return df.select(*[
        F.col("clean_").alias(c) if c == text
        else F.when(F.col("merged_").isNotNull(), F.length("clean_")).otherwise(F.col(f"doc.`{c}`")).cast(docs.schema[c].dataType).alias(c)
        if c == n_chars else F.col(f"doc.`{c}`")
        for c in docs.columns
    ])
