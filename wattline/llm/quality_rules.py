"""Quality rules: a table of thresholds compiled into one projection.

Every measure is a built-in expression over the row's own text, so the whole
operator is one scan without a shuffle and without user functions.

Defined cases: a null or empty text has no words and fails; repeated rows are
judged one by one. Words are runs without blanks; lines end at line feeds.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.llm.expressions import let, split_words

#: Words in a window whose repetition counts.
REPEAT_WINDOW = 5

SYMBOLS = r"[#*$%&|<>]"

# Frequent short words of four languages.
STOP_WORDS = (
    "the of and to in is that was for on "
    "der die und das ist von zu den mit nicht ein "
    "le la les de et des un une est que qui pour "
    "el los las y en que del por con para una no"
).split()


#: A text of fewer words may well do without frequent ones.
STOP_WORDS_FROM = 20


class Rule(NamedTuple):
    """A document fails if ``measure`` lies below ``low`` or above ``high``."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None


BASE_RULES = (
    Rule("too_few_words", "n_words", low=10),
    Rule("repeated_words", "repeat_percent", high=20),
)

#: The method's own thresholds: generous, so that only clear junk fails.
RULES = (
    Rule("too_many_words", "n_words", high=10_000_000),
    Rule("word_length", "mean_word_chars", low=1.5, high=20),
    Rule("symbols", "symbol_ratio", high=0.05),
    Rule("stop_words", "stop_word_ratio", low=0.002),
    Rule("duplicate_lines", "dup_line_ratio", high=0.4),
)


def _repeated(words: Column, n: int = REPEAT_WINDOW) -> Column:
    """Words inside an n-word window that the text holds twice or more.

    Windows are compared by a 64-bit hash chained over their words. Sorting
    ``(hash, place)`` puts equal windows side by side; the places that have an
    equal neighbour, in order, then cover ``min(n, distance to the next)`` words.
    """

    def keyed(w: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(w) - n),
            lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(n)]),
        )

    def places(keys: Column) -> Column:
        pairs = F.array_sort(F.transform(keys, lambda key, i: F.struct(key.alias("key"), i.alias("at"))))

        def twins(p: Column) -> Column:
            found = F.filter(
                p,
                lambda x, i: (x["key"] == F.get(p, i - 1)["key"]).eqNullSafe(True)
                | (x["key"] == F.get(p, i + 1)["key"]).eqNullSafe(True),
            )
            return F.array_sort(F.transform(found, lambda x: x["at"]))

        return let(pairs, twins)

    def covered(at: Column) -> Column:
        return F.aggregate(
            F.transform(at, lambda x, i: F.least(F.lit(n), F.coalesce(F.get(at, i + 1) - x, F.lit(n)))),
            F.lit(0).cast("long"),
            lambda total, x: total + x,
        )

    def counted(keys: Column) -> Column:
        return F.when(F.size(F.array_distinct(keys)) == F.size(keys), F.lit(0).cast("long")).otherwise(
            let(places(keys), covered)
        )

    return F.when(F.size(words) <= n, F.lit(0).cast("long")).otherwise(let(keyed(words), counted))


def measures(text: Column) -> Column:
    """All measures of a text as one struct."""
    whole = F.coalesce(text, F.lit(""))
    stops = F.array(*map(F.lit, sorted(set(STOP_WORDS))))

    def of_words(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.aggregate(
                words, F.lit(0).cast("long"), lambda total, w: total + F.length(w)
            ).alias("word_chars"),
            _repeated(words).alias("n_repeat_words"),
            F.size(F.filter(words, lambda w: F.array_contains(stops, F.lower(w))))
            .cast("long")
            .alias("n_stop_words"),
        )

    def of_lines(lines: Column) -> Column:
        return F.struct(
            F.size(lines).cast("long").alias("n_lines"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        )

    lines = F.filter(F.split(whole, "\n", -1), lambda x: F.rlike(x, F.lit(r"[^\x20\x09-\x0D]")))
    return F.struct(
        let(split_words(whole), of_words).alias("w"),
        let(lines, of_lines).alias("l"),
        F.regexp_count(whole, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
    )


def _measured(documents: DataFrame) -> DataFrame:
    """One row of measures per document; ratios are null where their base is zero."""
    m = documents.select("doc_id", measures(F.col("text")).alias("m"))
    flat = m.select(
        "doc_id", "m.w.n_words", "m.w.word_chars", "m.n_symbols", "m.l.n_dup_lines",
        "m.w.n_repeat_words", "m.w.n_stop_words", "m.l.n_lines",
    )

    def ratio(top: str, base: str, times: int = 1) -> Column:
        return F.when(F.col(base) > 0, times * F.col(top) / F.col(base))

    return flat.withColumns(
        {
            "repeat_percent": ratio("n_repeat_words", "n_words", 100),
            "mean_word_chars": ratio("word_chars", "n_words"),
            "symbol_ratio": ratio("n_symbols", "word_chars"),
            "stop_word_ratio": F.when(F.col("n_words") >= STOP_WORDS_FROM, ratio("n_stop_words", "n_words")),
            "dup_line_ratio": ratio("n_dup_lines", "n_lines"),
        }
    )


def broken(rule: Rule) -> Column:
    value, tests = F.col(rule.measure), []
    if rule.low is not None:
        tests.append(value < rule.low)
    if rule.high is not None:
        tests.append(value > rule.high)
    return F.coalesce(reduce(lambda a, b: a | b, tests), F.lit(False))


def any_broken(rules: Sequence[Rule]) -> Column:
    return reduce(lambda a, b: a | b, [broken(r) for r in rules], F.lit(False))


def apply_rules(
    documents: DataFrame, base: Sequence[Rule] = BASE_RULES, rules: Sequence[Rule] = RULES
) -> DataFrame:
    """Per row of ``documents (doc_id, text)``: the measures, the verdicts, the broken rules."""
    return _measured(documents).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        any_broken(base).alias("base_failed"),
        (~any_broken([*base, *rules])).alias("kept"),
        F.concat_ws(",", *[F.when(broken(r), F.lit(r.name)) for r in (*base, *rules)]).alias("broken"),
    )

