"""Regular-expression matches with their places, as column expressions.

A span is a struct of ``start`` and ``end`` (code points, end exclusive) and
``hit`` (its text). Everything here stays in the JVM.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "struct<start:int,end:int,hit:string>"


def no_spans() -> Column:
    return F.array().cast(f"array<{SPAN}>")


def matches(text: Column, pattern: str, worth: Column) -> Column:
    """Leftmost non-overlapping matches of a pattern, in order.

    ``worth`` is a cheap test without which no match is possible; rows that fail
    it are not searched. The gaps between matches come from splitting at the
    same pattern, so a match starts where all gaps and matches before it end.
    """
    gaps = F.split(text, pattern, -1)
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    steps = F.zip_with(gaps, hits, lambda gap, hit: F.struct(F.length(gap).alias("gap"), hit.alias("hit")))

    def step(done: Column, x: Column) -> Column:
        start = done["at"] + x["gap"]
        end = start + F.length(x["hit"])
        span = F.struct(start.alias("start"), end.alias("end"), x["hit"].alias("hit"))
        moved = F.struct(end.alias("at"), F.concat(done["out"], F.array(span)).alias("out"))
        return F.when(x["hit"].isNull(), done).otherwise(moved)

    first = F.struct(F.lit(0).alias("at"), no_spans().alias("out"))
    found = F.aggregate(steps, first, step, lambda done: done["out"])
    return F.coalesce(F.when(worth, found), no_spans())


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def passes_luhn(number: Column) -> Column:
    """Luhn's check of a text of digits; every second digit from the right counts double."""

    def worth(place: Column) -> Column:
        digit = F.substring(number, -place, F.lit(1)).cast("int")
        return F.when(place % 2 == 1, digit).when(digit > 4, digit * 2 - 9).otherwise(digit * 2)

    places = F.sequence(F.lit(1), F.greatest(F.length(number), F.lit(1)))
    total = F.aggregate(places, F.lit(0), lambda total, place: total + worth(place))
    return (F.length(number) > 0) & (total % 10 == 0)


def of_kind(spans: Column, kind: str) -> Column:
    return F.filter(spans, lambda s: s["kind"] == kind)


def overlaps(a: Column, b: Column) -> Column:
    return (a["start"] < b["end"]) & (b["start"] < a["end"])


def apart(candidates: Column, taken: Column) -> Column:
    """The candidates that touch none of the spans taken before or kept earlier in this order."""

    def step(kept: Column, c: Column) -> Column:
        free = ~F.exists(kept, lambda k: overlaps(k, c)) & ~F.exists(taken, lambda t: overlaps(t, c))
        return F.when(free, F.concat(kept, F.array(c))).otherwise(kept)

    return F.aggregate(candidates, F.slice(candidates, 1, 0), step)


def listed(spans: Column, kinds: Sequence[str]) -> Column:
    """``kind:start:end`` of all spans by start, then in the order of the kinds, comma-joined."""
    order = F.array(*[F.lit(k) for k in kinds])
    keyed = F.transform(
        spans,
        lambda s: F.struct(s["start"].alias("start"), F.array_position(order, s["kind"]).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")),
    )
    texts = F.transform(F.array_sort(keyed), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(texts, ",")
