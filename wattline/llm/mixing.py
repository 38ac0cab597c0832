"""Mixing sources to target weights by iterative proportional fitting.

Tokens are summed per cell (source, language, topic); every later step works on
that table of cells, which is checkpointed, never collected and never windowed:
each marginal is a grouped sum joined back on its key. Fitting scales the cells
until their sums meet the three target marginals. As no row can be taken more than once,
the expected tokens are then fitted again under the cells' own sizes: a full cell
stays full while its marginals lack tokens, and the open ones are raked to what is
left. Where the sizes leave a target out of reach, the budget is still met: open
cells are scaled up together. ``marginals`` reports what came of each target.

A row is kept if a uniform number made from its id lies below its cell's
probability: the choice does not depend on partitioning or order.

Defined cases: a null source, language or topic is a category of its own; a null
text has no tokens; cells without tokens get the overall share as probability;
rows with equal ids share one fate; rows without an id count as id 0; an empty
table stays empty.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.llm.tables import Scratch
from wattline.operators.storage import cut_lineage

MARGINS = ("source", "lang", "topic")

#: Rounds over the three marginals without and with the cells' sizes, and rounds of calibration.
ROUNDS = 6
BOUNDED_ROUNDS = 6
CALIBRATIONS = 6

#: A cell is full at this part of its tokens, so that rounding cannot decide it.
FULL = 1 - 1e-9

#: Share of all tokens that the sample should hold.
BUDGET = 0.5

#: Targets are proportional to tokens to this power: below 1 lifts small categories.
TEMPER = {"source": 0.7, "lang": 0.5, "topic": 0.7}

#: Bytes that one token stands for.
TOKEN_BYTES = 4

NONE = "(none)"


def topic_of(text: Column) -> Column:
    """A coarse topic by cues in the text, the first that applies."""
    return (
        F.when(F.contains(text, F.lit(" | ")), "table")
        .when(text.rlike("(?i)licen[sc]e|all rights reserved|copyright"), "legal")
        .when(F.contains(text, F.lit("@")) | F.contains(text, F.lit("+1 (")), "contact")
        .when(F.octet_length(text) < 400, "short")
        .when(F.octet_length(text) > 8000, "long")
        .otherwise("prose")
    )


def token_estimate(text: Column) -> Column:
    return F.coalesce(F.ceil(F.octet_length(text) / TOKEN_BYTES), F.lit(0)).cast("long")


def uniform(key: Column) -> Column:
    """A number in [0, 1) made from the first 13 hex digits of the key's MD5."""
    digits = F.substring(F.md5(F.coalesce(key, F.lit(0)).cast("string")), 1, 13)
    return F.conv(digits, 16, 10).cast("double") / float(16**13)


def tempered(cells: DataFrame, margin: str, power: float) -> DataFrame:
    """Target shares of one marginal: tokens to a power, before they are normalised."""
    return cells.groupBy(margin).agg(
        F.pow(F.sum("tokens").cast("double"), F.lit(power)).alias("target")
    )


def _targets(
    cells: DataFrame, given: Mapping[str, DataFrame], temper: Mapping[str, float]
) -> dict[str, DataFrame]:
    """Per marginal the target shares ``(margin, target)``, which add up to one."""
    out = {}
    for margin in MARGINS:
        wanted = given.get(margin)
        if wanted is None:
            wanted = tempered(cells, margin, temper[margin])
        else:  # only categories that have tokens can be filled
            wanted = wanted.select(margin, "target").join(
                cells.select(margin).distinct(), margin, "left_semi"
            )
        total = wanted.agg(F.sum("target")).first()[0] or 1.0
        out[margin] = cut_lineage(wanted.select(margin, (F.col("target") / total).alias("target")))
    return out


def _aimed(cells: DataFrame, targets: Mapping[str, DataFrame]) -> DataFrame:
    """Cells with the target of each of their categories; one without a target gets nothing."""
    for margin in MARGINS:
        aim = targets[margin].select(margin, F.col("target").alias(f"_{margin}_target"))
        cells = cells.join(aim, margin, "left")
    return cells.na.fill(0.0, [f"_{m}_target" for m in MARGINS])


def rake(cells: DataFrame, targets: Mapping[str, DataFrame], rounds: int = ROUNDS) -> DataFrame:
    """Cells with ``share``: scaled in turn until source, language and topic sums fit."""
    total = cells.agg(F.sum("tokens")).first()[0] or 1
    fitted = cells.withColumn("share", F.col("tokens") / F.lit(float(total)))
    fitted = cut_lineage(_aimed(fitted, targets))
    columns = fitted.columns
    for _ in range(rounds):
        for margin in MARGINS:
            factor = fitted.groupBy(margin).agg(
                F.try_divide(F.max(f"_{margin}_target"), F.sum("share")).alias("_factor")
            )
            share = F.col("share") * F.coalesce(F.col("_factor"), F.lit(0.0))
            fitted = fitted.join(factor, margin).withColumn("share", share).select(*columns)
        fitted = cut_lineage(fitted)
    return fitted.select(*MARGINS, "tokens", "share")


def rake_bounded(
    fitted: DataFrame, targets: Mapping[str, DataFrame], budget: float, rounds: int = BOUNDED_ROUNDS
) -> DataFrame:
    """Cells whose ``share`` of the budget asks for no more tokens than the cell has.

    A category with too much is scaled down as a whole; in one with too little the open
    cells take what the full ones leave, each up to its size. A full cell may so become
    open again, and no cell falls to nothing because others are full.
    """
    wanted = float(budget * (fitted.agg(F.sum("tokens")).first()[0] or 0))
    size = F.col("tokens").cast("double")
    cells = _aimed(fitted.withColumn("share", F.least(size, F.col("share") * F.lit(wanted))), targets)
    cells = cut_lineage(cells.withColumnRenamed("share", "_expected"))
    columns = cells.columns
    full = F.col("_expected") >= size * F.lit(FULL)
    for _ in range(rounds):
        for margin in MARGINS:
            aims = cells.groupBy(margin).agg(
                (F.max(f"_{margin}_target") * F.lit(wanted)).alias("_aim"),
                F.sum("_expected").alias("_have"),
                F.coalesce(F.sum(F.when(full, F.col("_expected"))), F.lit(0.0)).alias("_taken"),
                F.coalesce(F.sum(F.when(~full, F.col("_expected"))), F.lit(0.0)).alias("_open"),
            )
            expected = (
                F.when(F.col("_have") > F.col("_aim"), F.col("_expected") * (F.col("_aim") / F.col("_have")))
                .when(full | (F.col("_open") <= 0), F.col("_expected"))
                .otherwise(
                    F.least(size, F.col("_expected") * ((F.col("_aim") - F.col("_taken")) / F.col("_open")))
                )
            )
            # Each step reads the cells twice, so a longer plan would read them ever more often.
            cells = cut_lineage(cells.join(aims, margin).withColumn("_expected", expected).select(*columns))
    share = F.coalesce(F.try_divide("_expected", F.lit(wanted)), F.lit(0.0))
    return cells.select(*MARGINS, "tokens", share.alias("share"))


def marginals(odds: DataFrame, targets: Mapping[str, DataFrame]) -> DataFrame:
    """Per category ``(margin, category, target, expected)``: shares asked for and expected.

    ``odds`` are cells with ``tokens`` and ``probability``. A target that the cells'
    sizes leave out of reach shows as a difference.
    """
    taken = F.sum(F.col("tokens") * F.col("probability"))
    whole = odds.agg(taken).first()[0] or 1.0
    parts = [
        odds.groupBy(m)
        .agg((taken / F.lit(float(whole))).alias("expected"))
        .join(targets[m], m, "full")
        .select(
            F.lit(m).alias("margin"),
            F.col(m).alias("category"),
            F.coalesce("target", F.lit(0.0)).alias("target"),
            F.coalesce("expected", F.lit(0.0)).alias("expected"),
        )
        for m in MARGINS
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def calibrate(fitted: DataFrame, budget: float, rounds: int = CALIBRATIONS) -> DataFrame:
    """Cells with ``probability``: expected tokens meet ``budget`` times all tokens.

    Each round fixes the cells that would need more than they have and scales the
    others to what is left of the budget.
    """
    total = fitted.agg(F.sum("tokens")).first()[0] or 0
    wanted, scale = budget * total, budget * total
    need = F.col("share") / F.col("tokens")
    for _ in range(rounds):
        full = need * F.lit(scale) >= FULL
        fixed, open_share = fitted.agg(
            F.coalesce(F.sum(F.when(full, F.col("tokens"))), F.lit(0)),
            F.coalesce(F.sum(F.when(~full, F.col("share"))), F.lit(0.0)),
        ).first()
        if not open_share:
            break
        scale = max(scale, (wanted - fixed) / open_share)
    return fitted.withColumn("probability", F.least(F.lit(1.0), need * F.lit(float(scale))))


def mix(
    documents: DataFrame,
    targets: Mapping[str, DataFrame] | None = None,
    budget: float = BUDGET,
    topic: Column | None = None,
    temper: Mapping[str, float] = TEMPER,
) -> DataFrame:
    """The sampled rows of ``documents``, with ``mix_topic, mix_tokens, mix_probability``.

    ``targets`` maps a marginal to a frame ``(marginal, target)``; a marginal
    without one is tempered. Columns of the input keep their names and values.
    """
    text = F.col("text")
    drawn = documents.withColumns(
        {
            "_source": F.coalesce("source", F.lit(NONE)),
            "_lang": F.coalesce("lang", F.lit(NONE)),
            "mix_topic": F.coalesce(topic_of(text) if topic is None else topic, F.lit(NONE)),
            "mix_tokens": token_estimate(text),
        }
    )
    cells = cut_lineage(
        drawn.groupBy(
            F.col("_source").alias("source"), F.col("_lang").alias("lang"), F.col("mix_topic").alias("topic")
        )
        .agg(F.sum("mix_tokens").alias("tokens"))
        .where("tokens > 0")
    )
    aims = _targets(cells, targets or {}, temper)
    fitted = rake_bounded(rake(cells, aims), aims, budget)
    odds = calibrate(fitted, budget).select(
        F.col("source").alias("_source"),
        F.col("lang").alias("_lang"),
        F.col("topic").alias("mix_topic"),
        F.col("probability").alias("_chance"),
    )
    # As files the table has a size the optimizer knows: a small one is broadcast
    # by the session's own threshold, and the texts are not moved.
    odds = Scratch(documents.sparkSession, "mixing").stored(odds, "odds")
    chance = F.coalesce(F.col("_chance"), F.lit(float(budget)))
    return (
        drawn.join(odds, ["_source", "_lang", "mix_topic"], "left")
        .where(uniform(F.col("doc_id")) < chance)
        .select(*documents.columns, "mix_topic", "mix_tokens", F.round(chance, 6).alias("mix_probability"))
    )


def oracle_sql(
    rounds: int = ROUNDS,
    bounded: int = BOUNDED_ROUNDS,
    calibrations: int = CALIBRATIONS,
    budget: float = BUDGET,
) -> str:
    """The whole operator as one DuckDB statement, a step per common table expression."""
    steps: list[tuple[str, str]] = [
        (
            "drawn",
            f"""select *, coalesce(source, '{NONE}') as _source, coalesce(lang, '{NONE}') as _lang,
                  case when text is null then 'prose' when contains(text, ' | ') then 'table'
                       when regexp_matches(text, '(?i)licen[sc]e|all rights reserved|copyright') then 'legal'
                       when contains(text, '@') or contains(text, '+1 (') then 'contact'
                       when strlen(text) < 400 then 'short' when strlen(text) > 8000 then 'long'
                       else 'prose' end as mix_topic,
                  coalesce(ceil(strlen(text) / {TOKEN_BYTES}.0), 0)::bigint as mix_tokens
                from documents""",
        ),
        (
            "cells",
            """select _source as source, _lang as lang, mix_topic as topic,
                  sum(mix_tokens)::bigint as tokens from drawn group by all having sum(mix_tokens) > 0""",
        ),
        ("fit0", "select *, tokens / (select sum(tokens) from cells)::double as share from cells"),
    ]
    for margin in MARGINS:
        steps.append(
            (
                f"target_{margin}",
                f"""select {margin}, t / sum(t) over () as target from
                    (select {margin}, pow(sum(tokens)::double, {TEMPER[margin]}) as t from cells group by all)""",
            )
        )
    last = "fit0"
    for k in range(rounds * len(MARGINS)):
        margin = MARGINS[k % len(MARGINS)]
        steps.append(
            (
                f"fit{k + 1}",
                f"""select f.source, f.lang, f.topic, f.tokens, f.share * (t.target / h.have) as share
                    from {last} f join target_{margin} t using ({margin})
                    join (select {margin}, sum(share) as have from {last} group by all) h using ({margin})""",
            )
        )
        last = f"fit{k + 1}"
    steps.append(("goal", f"select {budget}::double * sum(tokens)::double as wanted from cells"))
    steps.append(
        (
            "even0",
            f"""select source, lang, topic, tokens, least(tokens::double, share * wanted) as expected
                from {last}, goal""",
        )
    )
    for k in range(bounded * len(MARGINS)):
        margin = MARGINS[k % len(MARGINS)]
        steps.append(
            (
                f"even{k + 1}",
                f"""select e.source, e.lang, e.topic, e.tokens,
                      case when have > aim then expected * (aim / have)
                           when filled or untaken <= 0 then expected
                           else least(e.tokens::double, expected * ((aim - taken) / untaken)) end as expected
                    from (select *, expected >= tokens::double * {FULL!r}::double as filled from even{k}) e
                    join (select {margin}, sum(expected) as have, any_value(target) * any_value(wanted) as aim,
                            coalesce(sum(expected) filter (expected >= tokens::double * {FULL!r}::double), 0) as taken,
                            coalesce(sum(expected) filter (expected < tokens::double * {FULL!r}::double), 0) as untaken
                          from even{k} join target_{margin} using ({margin}), goal group by all) using ({margin})""",
            )
        )
    steps.append(
        (
            "fitted",
            f"""select source, lang, topic, tokens, coalesce(expected / nullif(wanted, 0), 0) as share
                from even{bounded * len(MARGINS)}, goal""",
        )
    )
    last = "fitted"
    steps.append(("scale0", "select wanted, wanted as scale from goal"))
    for k in range(calibrations):
        steps.append(
            (
                f"scale{k + 1}",
                f"""select any_value(wanted) as wanted, case when coalesce(sum(share) filter (not filled), 0) = 0
                      then any_value(scale) else greatest(any_value(scale),
                      (any_value(wanted) - coalesce(sum(tokens) filter (filled), 0)) / sum(share) filter (not filled)) end as scale
                    from (select *, share / tokens * scale >= {FULL!r}::double as filled from {last}, scale{k})""",
            )
        )
    steps.append(
        (
            "odds",
            f"""select source as _source, lang as _lang, topic as mix_topic,
                  least(1.0, share / tokens * scale) as probability from {last}, scale{calibrations}""",
        )
    )
    body = ",\n".join(f"{name} as materialized ({sql})" for name, sql in steps)
    return f"""with {body}
        select doc_id, text, lang, source, n_chars, mix_topic, mix_tokens,
               round(coalesce(probability, {budget}), 6) as mix_probability
        from drawn left join odds using (_source, _lang, mix_topic)
        where ('0x' || substr(md5(coalesce(doc_id, 0)::varchar), 1, 13))::bigint / {16**13}.0
              < coalesce(probability, {budget})"""
