"""Spans of pattern matches as native columns.

Spark returns the texts of all matches but not where they are. The pieces
between matches do tell: splitting by the same pattern gives them in order, so
the start of match i is the length of the pieces up to it and of the matches
before it. Lengths count code points. The cost grows with the length of a text
and a little faster than the number of its matches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


# Numbers that are summed up at a time: appending to an array copies it, so a
# text with n matches costs n * BLOCK, not n * n.
BLOCK = 512


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def _appended(numbers: Column) -> Column:
    """0 and the running sums of a short array."""
    zero = F.array(F.lit(0))
    return F.aggregate(numbers, zero, lambda sums, n: F.concat(sums, F.array(F.element_at(sums, -1) + n)))


def running(numbers: Column) -> Column:
    """Sum of all numbers before each number of an array."""

    def summed(blocks):
        def joined_(sums):
            begins = _appended(F.transform(sums, lambda one: F.element_at(one, -1)))
            whole = F.zip_with(sums, F.slice(begins, 1, F.size(sums)), lambda one, begin: F.transform(F.slice(one, 1, F.size(one) - 1), lambda n: n + begin))
            return F.flatten(whole)

        return bound(F.transform(blocks, _appended), joined_)

    def cut(whole):
        places = F.sequence(F.lit(0), F.greatest(F.size(whole) - 1, F.lit(0)), F.lit(BLOCK))
        return bound(F.transform(places, lambda at: F.slice(whole, at + 1, BLOCK)), summed)

    return bound(numbers, cut)


SPANS = "array<struct<start:int,end:int,match:string,before:string,after:string>>"


# A match has at least so many code points; it bounds how many matches lie within a width.
SHORTEST = 4


def _context(pieces: Column, found: Column, width: int, side: str) -> Column:
    """For each match, up to ``width`` code points of the text before or after it."""
    reach = 2 * (width // SHORTEST + 1)
    if side == "before":
        # The text as pieces and matches in turn; piece i stands at place 2 i + 1.
        parts = F.flatten(F.zip_with(F.transform(F.slice(pieces, 1, F.size(found)), lambda p: F.right(p, F.lit(width))), found, lambda p, m: F.array(p, m)))
        return bound(
            parts,
            lambda whole: F.transform(
                found,
                lambda _, i: F.right(F.array_join(F.slice(whole, F.greatest(F.lit(1), 2 * i + 1 - reach), F.least(2 * i + 1, F.lit(reach + 1))), ""), F.lit(width)),
            ),
        )
    # The text behind the first match: piece i + 1 stands at place 2 i + 1.
    after = F.transform(F.slice(pieces, 2, F.size(found)), lambda p: F.substring(p, 1, width))
    parts = F.flatten(F.zip_with(after, F.slice(F.concat(found, F.array(F.lit(""))), 2, F.size(found)), lambda p, m: F.array(p, m)))
    return bound(parts, lambda whole: F.transform(found, lambda _, i: F.substring(F.array_join(F.slice(whole, 2 * i + 1, F.lit(reach + 1)), ""), 1, width)))


def _struct(at, match, before, after):
    return F.struct(at["start"].alias("start"), at["end"].alias("end"), match.alias("match"), before.alias("before"), after.alias("after"))


def matches(text: Column, pattern: str, present: Column, width: int = 0) -> Column:
    """array<struct<start,end,match,before,after>> of leftmost non-overlapping matches.

    ``before`` and ``after`` are up to ``width`` code points of the text next to
    a match. ``present`` is a cheap necessary condition; texts that fail it are
    not searched. Patterns match ``SHORTEST`` code points or more and must be
    possessive or bounded where a long run could make a search quadratic.
    """
    none = F.array().cast(SPANS)

    def located(found, pieces):
        sizes = F.zip_with(F.slice(pieces, 1, F.size(found)), found, lambda p, m: F.struct(F.length(p).alias("gap"), F.length(m).alias("own")))

        def placed(sizes):
            begins = running(F.transform(sizes, lambda x: x["gap"] + x["own"]))
            at = F.zip_with(begins, sizes, lambda begin, x: F.struct((begin + x["gap"]).alias("start"), (begin + x["gap"] + x["own"]).alias("end")))
            if not width:
                blank = F.lit("")
                return F.zip_with(at, found, lambda a, m: _struct(a, m, blank, blank))
            sides = F.zip_with(_context(pieces, found, width, "before"), _context(pieces, found, width, "after"), lambda x, y: F.struct(x.alias("before"), y.alias("after")))
            texts = F.zip_with(found, sides, lambda m, x: F.struct(m.alias("match"), x["before"].alias("before"), x["after"].alias("after")))
            return F.zip_with(at, texts, lambda a, t: _struct(a, t["match"], t["before"], t["after"]))

        return bound(sizes, placed)

    def searched(found):
        return F.when(F.size(found) == 0, none).otherwise(bound(F.split(text, pattern, -1), lambda pieces: located(found, pieces)))

    return F.when(present, bound(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), searched)).otherwise(none)


def around(span: Column) -> Column:
    """Lower-cased text next to a span."""
    return F.lower(F.concat(span["before"], F.lit(" "), span["after"]))


def scored(kind: str, spans: Column, keep: Callable[[Column], Column], score: Callable[[Column], Column]) -> Column:
    """Spans of one kind that their check confirms, with a score."""
    return F.transform(
        F.filter(spans, keep),
        lambda s: F.struct(
            F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
            F.least(F.lit(1.0), F.greatest(F.lit(0.0), score(s))).alias("score"),
            s["match"].alias("match"),
        ),
    )


def joined(spans: Column) -> Column:
    """kind:start:end of every span, comma-joined in their order."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
