"""Column helpers the native operators share."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Blank, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = r"[\x20\x09-\x0D]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    The optimizer may copy an expression into every place that names it; inside
    a lambda that would mean once per element. A lambda variable is bound once.
    """
    return F.element_at(F.transform(F.array(value), lambda bound: body(bound)), 1)


def split_words(text: Column) -> Column:
    return F.filter(F.split(text, BLANKS + "+"), lambda w: w != "")


def matches_and_gaps(text: Column, pattern: str) -> tuple[Column, Column]:
    """All matches, and the stretches before, between and after them."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)


def starts(gaps: Column, matches: Column) -> Column:
    """Code point offset of each match, from the lengths of what comes before it.

    Sums run over blocks of about the square root of the number of matches, so a
    text with very many matches does not cost the square of their number.
    """
    lengths = F.transform(
        F.sequence(F.lit(1), F.size(matches)),
        lambda k: F.struct(
            F.length(F.element_at(gaps, k)).cast("long").alias("gap"),
            F.length(F.element_at(matches, k)).cast("long").alias("own"),
        ),
    )
    zero = F.lit(0).cast("long")

    def summed(part: Column) -> Column:
        return F.aggregate(part, zero, lambda total, x: total + x["gap"] + x["own"])

    def offsets(pairs: Column) -> Column:
        width = F.ceil(F.sqrt(F.size(pairs))).cast("int")
        cut = F.transform(
            F.sequence(F.lit(0), F.ceil(F.size(pairs) / width).cast("int") - 1),
            lambda b: F.slice(pairs, b * width + 1, width),
        )

        def joined(blocks: Column) -> Column:
            def carried(sums: Column) -> Column:
                return F.flatten(
                    F.transform(
                        blocks,
                        lambda block, b: let(
                            F.aggregate(F.slice(sums, F.lit(1), b), zero, lambda t, x: t + x),
                            lambda before: F.transform(
                                block,
                                lambda pair, k: before
                                + summed(F.slice(block, F.lit(1), k))
                                + pair["gap"],
                            ),
                        ),
                    )
                )

            return let(F.transform(blocks, summed), carried)

        return let(cut, joined)

    return F.when(F.size(matches) == 0, F.array().cast("array<bigint>")).otherwise(
        let(lengths, offsets)
    )


def joined_spans(spans: Column, kinds: Sequence[str]) -> Column:
    """``kind:start:end`` of spans, by start, then the kinds' order, comma-joined."""
    named = F.transform(
        F.array_sort(
            F.transform(
                spans, lambda s: F.struct(s["start"], s["kind"].alias("k"), s["end"].alias("end"))
            )
        ),
        lambda s: F.concat_ws(
            ":",
            F.element_at(F.array(*map(F.lit, kinds)), s["k"] + 1),
            s["start"].cast("string"),
            s["end"].cast("string"),
        ),
    )
    return F.array_join(named, ",")
