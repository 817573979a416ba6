"""Spans of pattern matches with code-point positions, from built-in functions only."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "struct<start:int,end:int,value:string>"
_GROUP = 256


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row."""
    return F.transform(F.array(value), body)[0]


def running(steps: Column, join: Callable[[Column, Column], Column]) -> Column:
    """Running results of an int array from 0 on, in groups, so that long arrays are not copied once per element."""

    def within(part: Column, start: Column) -> Column:
        return F.aggregate(
            part,
            F.struct(start.alias("t"), F.expr("cast(array() AS array<int>)").alias("r")),
            lambda s, x: F.struct(join(s.t, x).alias("t"), F.array_append(s.r, join(s.t, x)).alias("r")),
        ).r

    parts = F.transform(_group_numbers(F.size(steps)), lambda g: F.slice(steps, g * _GROUP + 1, F.lit(_GROUP)))

    def joined(p: Column) -> Column:
        sums = F.transform(p, lambda a: F.aggregate(a, F.lit(0), join))
        return let(
            within(sums, F.lit(0)),
            lambda ends: F.flatten(
                F.transform(
                    p,
                    lambda a, i: within(a, F.when(i == 0, F.lit(0)).otherwise(F.element_at(ends, F.greatest(i, F.lit(1))))),
                )
            ),
        )

    return let(parts, joined)


def _group_numbers(size: Column) -> Column:
    numbers = F.sequence(F.lit(0), F.floor((size - 1) / _GROUP).cast("int"))
    return F.when(size > 0, numbers).otherwise(F.expr("cast(array() AS array<int>)"))


def running_totals(steps: Column) -> Column:
    """Running sums of an int array."""
    return running(steps, lambda a, b: a + b)


def with_reach(spans: Column) -> Column:
    """The spans, ordered by start, as (span, at): at is where the spans before it have ended."""
    most = running(F.transform(spans, lambda s: s.end), lambda a, b: F.greatest(a, b))

    def paired(m: Column) -> Column:
        before = lambda i: F.when(i == 0, F.lit(0)).otherwise(F.get(m, i - 1))
        return F.transform(spans, lambda s, i: F.struct(s.alias("span"), before(i).alias("at")))

    return let(most, paired)


def gaps(text: Column, reached: Column, margin: int = 0) -> Column:
    """The text before each of the spans (of ``with_reach``) from where those before it end, empty if they overlap.

    A gap has ``margin`` characters more on both sides; the text is padded for that. A piece of
    text is cut out for a group of spans first, as finding a place takes as long as the way to it.
    """

    def of_group(own: Column) -> Column:
        begin, last = own[0].at, F.element_at(own, -1).span.start
        piece = F.substring(text, begin + 1, F.greatest(last - begin, F.lit(0)) + 2 * margin)

        def cut(p: Column) -> Column:
            inner = lambda x: F.substring(p, x.at - begin + 1, x.span.start - x.at + 2 * margin)
            return F.transform(own, lambda x: F.when(x.span.start >= x.at, inner(x)).otherwise(""))

        return let(piece, cut)

    groups = F.transform(_group_numbers(F.size(reached)), lambda g: F.slice(reached, g * _GROUP + 1, F.lit(_GROUP)))
    return F.flatten(F.transform(groups, of_group))


def rest(text: Column, reached: Column) -> Column:
    """The text behind all spans (of ``with_reach``), of which there is at least one."""
    last = F.element_at(reached, -1)
    return F.substring(text, F.greatest(last.at, last.span.end) + 1, F.length(text))


def matches(text: Column, pattern: str, group: int = 0) -> Column:
    """Array of (start, end, value) of all leftmost non-overlapping matches; value is the given group.

    Start and end count code points; the end is exclusive. No match may be empty.
    """
    none = F.expr(f"cast(array() AS array<{SPAN}>)")

    def located(s: Column) -> Column:
        gaps = F.transform(
            s.found,
            lambda m, i: F.length(F.get(s.pieces, i)) + F.when(i == 0, F.lit(0)).otherwise(F.length(F.get(s.found, i - 1))),
        )
        return let(
            running_totals(gaps),
            lambda starts: F.transform(
                s.found,
                lambda m, i: F.struct(
                    F.get(starts, i).alias("start"),
                    (F.get(starts, i) + F.length(m)).alias("end"),
                    F.get(s.inner, i).alias("value"),
                ),
            ),
        )

    pieces = F.struct(
        F.split(text, pattern, -1).alias("pieces"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("inner"),
    )
    return F.when(F.rlike(text, F.lit(pattern)), let(pieces, located)).otherwise(none)


def labelled(spans: Column, kind: str, rank: int) -> Column:
    return F.transform(
        spans,
        lambda s: F.struct(s.start.alias("start"), F.lit(rank).alias("rank"), s.end.alias("end"), F.lit(kind).alias("kind"), s.value.alias("value")),
    )


def ordered(arrays: Sequence[Column]) -> Column:
    """All spans by start, then kind as listed."""
    return F.array_sort(F.concat(*arrays))


def written(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s.kind == kind)).cast("bigint")
