"""Positions of regex matches as column expressions, without leaving the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Length of the runs in which an array is folded: a text with k matches costs k times this.
RUN = 128
# Code points that a text is cut into so that any place in it is found at once.
CUT = 1024


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often the body names it."""
    return F.transform(F.array(value), body)[0]


Fold = Callable[[Column, Column], Column]


def folds_before(values: Column, start: Column, step: Fold, levels: int = 2) -> Column:
    """For every element of an array, the fold of ``start`` and those before it.

    An array cannot be extended in place, so one pass over all elements would copy the result for
    each of them. Runs of RUN elements are folded separately, each from the fold of the runs before
    it, and these come the same way from the folds of the runs. ``step`` must be associative, and
    ``start`` neutral.
    """

    def run(first: Column, base: Column) -> Column:
        state = F.struct(base.alias("at"), F.slice(F.array(base), 1, 0).alias("out"))
        return F.aggregate(
            F.slice(values, first + 1, RUN),
            state,
            lambda s, x: F.struct(step(s["at"], x).alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out")),
            lambda s: s["out"],
        )

    firsts = F.sequence(F.lit(0), F.size(values) - 1, F.lit(RUN))
    if levels:
        totals = F.transform(firsts, lambda first: F.aggregate(F.slice(values, first + 1, RUN), start, step))
        bases = let(totals, lambda t: folds_before(t, start, step, levels - 1))
        runs = F.transform(bases, lambda base, i: run(i * RUN, base))
    else:
        runs = F.transform(firsts, lambda first: run(first, F.aggregate(F.slice(values, 1, first), start, step)))
    return F.when(F.size(values) > 0, F.flatten(runs)).otherwise(F.slice(F.array(start), 1, 0))


def sums_before(lengths: Column) -> Column:
    """For every element of an int array, the sum of those before it."""
    return folds_before(lengths, F.lit(0), lambda a, x: a + x)


def cut(text: Column) -> Column:
    """The text in parts of CUT code points."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CUT}}}"), F.lit(0))


def between(parts: Column, start: Column, end: Column) -> Column:
    """The text from code point ``start`` to before ``end``, out of its parts.

    Spark counts code points from the start of a string, so that many places of a long one would
    cost its length each; here a place costs a part at most.
    """
    first, last = F.floor(start / CUT).cast("int"), F.floor(end / CUT).cast("int")
    head, tail = start % CUT, end % CUT

    def part(i: Column) -> Column:
        return F.coalesce(F.get(parts, i), F.lit(""))

    inside = F.substr(part(first), head + 1, end - start)
    across = F.concat(
        F.substr(part(first), head + 1, F.lit(CUT)),
        F.array_join(F.slice(parts, first + 2, F.greatest(last - first - 1, F.lit(0))), ""),
        F.substr(part(last), F.lit(1), tail),
    )
    return F.when(first == last, inside).otherwise(across)


def match_spans(text: Column, regex: Column, context: int = 1, across: int = 0) -> Column:
    """array<struct<start, end, match, before>> of all matches, leftmost and non-overlapping.

    ``before`` is the text between the previous match and this one, at most its last ``context``
    code points. Positions count code points from 0, the end is exclusive. The pieces between the
    matches give the positions: Spark has no function that returns all of them. The regex must not
    match the empty string and must have no group but non-capturing ones.

    With ``across``, ``before`` and a further ``after`` are the ``context`` code points on either
    side, over as many other matches as ``across`` says at most. Only the ends of pieces and
    matches are joined, so that the work stays in proportion to the text.
    """

    def sides(pieces: Column, matches: Column) -> Column:
        def end(part: Column) -> Column:
            return F.coalesce(F.substr(part, F.lit(-context)), F.lit(""))

        def head(part: Column) -> Column:
            return F.coalesce(F.substr(part, F.lit(1), F.lit(context)), F.lit(""))

        ends = F.transform(pieces, lambda p, i: F.concat(F.when(i > 0, end(F.get(matches, i - 1))).otherwise(""), end(p)))
        heads = F.transform(matches, lambda m, i: F.concat(head(F.get(pieces, i + 1)), head(F.get(matches, i + 1))))
        return F.struct(ends.alias("ends"), heads.alias("heads"))

    def windows(units: Column) -> Callable[[Column], list[Column]]:
        def of(i: Column) -> list[Column]:
            # A slice would copy the whole array for each match.
            to, last = F.size(units["heads"]) - 1, i + across - 1
            before = F.transform(F.sequence(F.greatest(i + 1 - across, F.lit(0)), i), lambda j: F.get(units["ends"], j))
            after = F.transform(F.sequence(i, F.least(last, to)), lambda j: F.get(units["heads"], j))
            return [
                F.substr(F.array_join(before, ""), F.lit(-context)).alias("before"),
                F.substr(F.array_join(after, ""), F.lit(1), F.lit(context)).alias("after"),
            ]

        return of

    def placed(x: Column) -> Column:
        pieces, matches = x["pieces"], x["matches"]
        lengths = F.transform(matches, lambda m, i: F.length(m) + F.length(F.get(pieces, i)))

        def row(starts: Column, near: Callable[[Column], list[Column]] | None) -> Callable[[Column, Column], Column]:
            def of(match: Column, i: Column) -> Column:
                piece = F.get(pieces, i)
                first = F.get(starts, i) + F.length(piece)
                return F.struct(
                    first.alias("start"),
                    (first + F.length(match)).alias("end"),
                    match.alias("match"),
                    *(near(i) if near else [F.substr(piece, F.lit(-context)).alias("before")]),
                )

            return of

        def rows(near: Callable[[Column], list[Column]] | None) -> Column:
            return let(let(lengths, sums_before), lambda starts: F.transform(matches, row(starts, near)))

        return let(sides(pieces, matches), lambda units: rows(windows(units))) if across else rows(None)

    parts = F.struct(
        F.split(text, regex, -1).alias("pieces"), F.regexp_extract_all(text, regex, F.lit(0)).alias("matches")
    )
    return let(parts, placed)
