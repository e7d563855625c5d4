"""Places of regular-expression matches, as columns.

``split`` and ``regexp_extract_all`` walk a text in the same way, so the gaps of the one and the
matches of the other add up to positions (code points, end exclusive). Running totals are taken in
blocks of ``RUN`` numbers, so that the time of a text with very many matches stays in proportion to
them; parts of a long text are cut from its blocks of ``CUT`` code points and not from its beginning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.once import once

#: What ``found`` gives for each match.
SPAN = "array<struct<kind:string,start:int,end:int,match:string>>"
#: Numbers added up, and code points cut, together.
RUN, CUT = 256, 1024


def found(df: DataFrame, text: str, patterns: dict[str, tuple[Column, str]], to: str) -> DataFrame:
    """Append ``to``: the matches of each (guard, pattern) in order of the patterns, then of place.

    The guard is a cheap test without which a text has no match; its text is then not searched.
    """
    keep = df.columns
    none = F.array().cast("array<string>")
    t = F.col(text)
    gaps = {f"gap_{k}": F.when(guard, F.split(t, pattern, -1)).otherwise(none) for k, (guard, pattern) in patterns.items()}
    hits = {f"hit_{k}": F.when(guard, F.regexp_extract_all(t, F.lit(pattern), F.lit(0))).otherwise(none) for k, (guard, pattern) in patterns.items()}
    df = once(df, **gaps, **hits)

    step = {k: F.transform(F.col(f"hit_{k}"), lambda m, i: F.length(F.get(F.col(f"gap_{k}"), i)) + F.length(m)) for k in patterns}
    df = running(df, {f"end_{k}": (numbers, lambda x, y: x + y) for k, numbers in step.items()})

    def placed(kind: str) -> Column:
        def span(match: Column, i: Column) -> Column:
            end = F.get(F.col(f"end_{kind}"), i)
            return F.struct(F.lit(kind).alias("kind"), (end - F.length(match)).alias("start"), end.alias("end"), match.alias("match"))

        return F.when(F.size(f"hit_{kind}") > 0, F.transform(f"hit_{kind}", span)).otherwise(F.array().cast(SPAN))

    return once(df, **{to: F.flatten(F.array(*[placed(k) for k in patterns]))}).select(*keep, to)


def running(df: DataFrame, totals: dict) -> DataFrame:
    """Append, by name, the running totals of (array of integers, operation); 0 is before the first."""
    keep, none = df.columns, F.array().cast("array<int>")
    last = lambda array: F.get(array, F.size(array) - 1)

    def inside(numbers: Column, add) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(numbers) - 1) / RUN).cast("int")), lambda b: F.slice(numbers, b * RUN + 1, F.lit(RUN)))
        grow = lambda out, x: F.concat(out, F.array(add(F.coalesce(last(out), F.lit(0)), x)))
        return F.when(F.size(numbers) > 0, F.transform(blocks, lambda block: F.aggregate(block, none, grow)))

    df = once(df, **{f"numbers_{k}": numbers for k, (numbers, _) in totals.items()})
    df = once(df, **{f"blocks_{k}": inside(F.col(f"numbers_{k}"), add) for k, (_, add) in totals.items()})
    before = lambda k, add: F.aggregate(f"blocks_{k}", F.array(F.lit(0)), lambda out, block: F.concat(out, F.array(add(last(out), last(block)))))
    df = once(df, **{f"before_{k}": before(k, add) for k, (_, add) in totals.items()})

    def joined(k: str, add) -> Column:
        moved = F.transform(f"blocks_{k}", lambda block, b: F.transform(block, lambda x: add(F.get(F.col(f"before_{k}"), b), x)))
        return F.coalesce(F.flatten(moved), none)

    return once(df, **{k: joined(k, add) for k, (_, add) in totals.items()}).select(*keep, *totals)


def blocks(text: Column) -> Column:
    """A text in blocks of ``CUT`` code points."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CUT}}}"), F.lit(0))


def part(cut: Column, start: Column, end: Column) -> Column:
    """The code points from ``start`` to ``end`` of a text in ``blocks``."""
    first, last = (F.floor(place / CUT).cast("int") for place in (start, end))
    inner = F.array_join(F.slice(cut, first + 1, last - first + 1), "")
    return F.when(end > start, F.substring(inner, start % CUT + 1, end - start)).otherwise(F.lit(""))


def listed(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def of_kinds(spans: Column, kinds) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))


def number(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
