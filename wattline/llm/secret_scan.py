"""Secret scan: fixed grammars plus two character Markov models.

One model knows random strings, the other ordinary identifiers; a token counts
as a secret when its log-likelihood ratio per transition exceeds a threshold. Both are
trained from labelled samples of strings by one grouped count over transitions
between character classes. The tables have ``CLASSES ** 2`` cells at any input
size and enter the scan as one literal. The scan is a single projection.

Kinds ``assign access hex`` follow fixed grammars; the method adds ``random``.
Spans are code points, end exclusive. A random token that touches a base span is
not reported again.

Defined cases: a null or empty text has no span; repeated rows are reported one
by one; empty samples give flat models, which find nothing.
"""

from __future__ import annotations

import math
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.llm.expressions import joined_spans, let, matches_and_gaps, starts

KINDS = ("assign", "access", "hex", "random")

# The base grammars. Group 2 of the first is the secret itself.
ASSIGN = (
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ASSIGN_LEAST = 8
# Runs below the least length fail as a whole, so the length is part of the pattern.
ACCESS = "AKIA[A-Z0-9]{12,}"
HEX = "[0-9a-f]{32,}"

#: What the models judge: unbroken tokens of this least length that hold a digit.
TOKEN = "[A-Za-z0-9+/_=-]{20,}"

#: Log-likelihood ratio per transition beyond which a token is random.
THRESHOLD = 0.35

#: Strings of each label in the training sample.
SAMPLE = 20_000

#: Consecutive words that one set of identifiers is made of.
RUN = 8

ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
CLASSES = len(ALPHABET) + 1


def labelled_sample(documents: DataFrame, size: int = SAMPLE) -> DataFrame:
    """``token, random`` strings: digests in three spellings against joined words of the corpus.

    Identifiers are made of the corpus's own words in snake, kebab, camel, path
    and constant spelling, some with a counter. The words come from about ``size``
    distinct texts, chosen by a hash of the text: all runs of ``RUN`` words of each.
    """
    spark = documents.sparkSession
    texts = documents.select("text").where("text is not null")
    distinct = texts.agg(F.approx_count_distinct("text")).first()[0]
    share = min(1.0, size / max(distinct, 1))
    number = F.col("id").cast("string")
    digest = F.sha2(number, 256)
    spelt = F.array(
        F.substring(digest, 1, 40),
        F.substring(F.base64(F.unhex(digest)), 1, 40),
        F.substring(F.translate(F.base64(F.unhex(F.sha2(digest, 256))), "+/=", "Aa0"), 1, 32),
    )
    random = spark.range(size).select(F.explode(spelt).alias("token"), F.lit(True).alias("random"))

    picked = texts.where(F.abs(F.xxhash64("text") % 1_000_003) < share * 1_000_003).dropDuplicates()
    found = F.filter(F.split(F.col("text"), "[^A-Za-z]+"), lambda w: F.length(w) > 1)
    runs = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size("found"), F.lit(1)), F.lit(RUN)),  # the last one begins early enough to be whole
        lambda k: F.slice("found", F.greatest(F.least(k, F.size("found") - (RUN - 1)), F.lit(1)), RUN),
    )
    w = [F.lower(F.coalesce(F.get("w", k), F.lit("x"))) for k in range(RUN)]
    year = (2000 + F.abs(F.xxhash64("w") % 30)).cast("string")
    forms = F.array(
        F.concat_ws("_", *w[:4]),
        F.concat_ws("-", *w[2:6], year),
        F.concat(w[1], *[F.initcap(x) for x in w[2:6]]),
        F.concat_ws("/", *w[:5]),
        F.upper(F.concat_ws("_", *w[3:7])),
        F.concat(F.concat_ws("_", *w[4:8]), F.lit("_"), F.substring(year, 3, 2)),
        F.concat(*[F.initcap(x) for x in w[:4]], year),
    )
    plain = (
        picked.select(found.alias("found"))
        .where(F.size("found") > 3)
        .select(F.explode(runs).alias("w"))
        .select(F.explode(forms).alias("token"), F.lit(False).alias("random"))
    )
    return random.unionByName(plain)


def _transitions(token: Column) -> Column:
    """Cell numbers of a token's consecutive character pairs."""
    alphabet = F.lit(ALPHABET)

    def number(c: Column) -> Column:
        place = F.position(c, alphabet)
        return F.when(place > 0, place - 1).otherwise(CLASSES - 1)

    def pairs(codes: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(1), F.size(codes) - 1),
            lambda k: F.element_at(codes, k) * CLASSES + F.element_at(codes, k + 1),
        )

    codes = F.transform(F.filter(F.split(token, ""), lambda c: c != ""), number)
    return F.when(F.length(token) < 2, F.array().cast("array<int>")).otherwise(let(codes, pairs))


def train(sample: DataFrame) -> list[float]:
    """Log-likelihood ratio of every transition, add-one smoothed, rounded to six places."""
    counts = (
        sample.select("random", F.explode(_transitions(F.col("token"))).alias("cell"))
        .groupBy("cell")
        .agg(
            F.count_if("random").alias("random"),
            F.count_if(~F.col("random")).alias("plain"),
        )
        .collect()  # at most CLASSES ** 2 rows
    )
    seen = {r["cell"]: (r["random"], r["plain"]) for r in counts}
    ratios = []
    for a in range(CLASSES):
        row = [seen.get(a * CLASSES + b, (0, 0)) for b in range(CLASSES)]
        totals = [sum(x[side] for x in row) + CLASSES for side in (0, 1)]
        ratios += [
            round(math.log((r + 1) / totals[0]) - math.log((p + 1) / totals[1]), 6) for r, p in row
        ]
    return ratios


def ratio(token: Column, model: list[float]) -> Column:
    """Mean log-likelihood ratio over a token's transitions."""
    table = F.split(F.lit(",".join(map(str, model))), ",").cast("array<double>")  # one constant

    def mean(cells: Column) -> Column:
        return F.aggregate(
            cells, F.lit(0.0), lambda total, cell: total + F.get(table, cell)
        ) / F.greatest(F.size(cells), F.lit(1))

    return let(_transitions(token), mean)


def is_random(token: Column, model: list[float], threshold: float = THRESHOLD) -> Column:
    return token.rlike("[0-9]") & (ratio(token, model) > threshold)


def _found(text: Column, kind: str, pattern: str, passes) -> Column:
    """Spans ``kind, start, end`` of the matches that pass."""
    matches, gaps = matches_and_gaps(text, pattern)

    def located(m: Column) -> Column:
        def spans(at: Column) -> Column:
            return F.filter(
                F.zip_with(
                    m,
                    at,
                    lambda own, start: F.struct(
                        F.lit(KINDS.index(kind)).alias("kind"),
                        start.alias("start"),
                        (start + F.length(own)).alias("end"),
                        passes(own).alias("passed"),
                    ),
                ),
                lambda s: s["passed"],
            )

        return let(starts(gaps, m), spans)

    empty = F.array().cast("array<struct<kind:int,start:bigint,end:bigint,passed:boolean>>")
    return F.when(text.rlike(pattern), let(matches, located)).otherwise(empty)


def _assigned(match: Column) -> Column:
    return F.length(F.regexp_extract(match, ASSIGN, 2)) >= ASSIGN_LEAST


def find_secrets(documents: DataFrame, model: list[float], threshold: float = THRESHOLD) -> DataFrame:
    """Per row of ``documents (doc_id, text)``: counts of base kinds, their digest, all spans."""
    text = F.coalesce(F.col("text"), F.lit(""))
    always = lambda own: F.lit(True)
    base = F.concat(
        _found(text, "assign", ASSIGN, _assigned),
        _found(text, "access", ACCESS, always),
        _found(text, "hex", HEX, always),
    )
    added = _found(text, "random", TOKEN, lambda own: is_random(own, model, threshold))
    rows = documents.select("doc_id", base.alias("base"), added.alias("added"))
    fresh = F.filter(
        "added",
        lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])),
    )

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(kind))).cast("long")

    return rows.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in KINDS[:3]],
        F.sha2(joined_spans(F.col("base"), KINDS), 256).alias("base_sha256"),
        joined_spans(F.concat("base", fresh), KINDS).alias("spans"),
    )


def redact(text: Column, model: list[float], by: str = "[REDACTED]") -> Column:
    """``text`` with every secret replaced, one kind after another; null stays null.

    Of an assignment only the value goes.
    """

    def replaced(whole: Column, pattern: str, change) -> Column:
        matches, gaps = matches_and_gaps(whole, pattern)
        joined = F.array_join(
            F.zip_with(gaps, matches, lambda gap, own: F.concat(gap, F.coalesce(change(own), F.lit("")))),
            "",
        )
        return F.when(whole.rlike(pattern), joined).otherwise(whole)

    def value_only(own: Column) -> Column:
        secret = F.length(F.regexp_extract(own, ASSIGN, 2))
        kept = F.substring(own, F.lit(1), F.length(own) - secret)
        return F.when(_assigned(own), F.concat(kept, F.lit(by))).otherwise(own)

    steps = (
        (ASSIGN, value_only),
        (ACCESS, lambda own: F.when(own.isNotNull(), F.lit(by))),
        (HEX, lambda own: F.when(own.isNotNull(), F.lit(by))),
        (TOKEN, lambda own: F.when(is_random(own, model), F.lit(by)).otherwise(own)),
    )
    for step in steps:
        text = let(text, partial(_step, replaced, step))
    return text


def _step(replaced, step, whole: Column) -> Column:
    return replaced(whole, *step)


def sample_and_train(spark: SparkSession, documents: DataFrame) -> list[float]:
    return train(labelled_sample(documents))
