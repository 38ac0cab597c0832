"""Language identification by fusing evidence.

``P(l | everything) ~ P(l | host) P(text | l) P(declared | l) P(suffix | l)``

* Text: byte trigrams hashed into ``BUCKETS`` cells per language, trained from a
  bounded sample of each language's distinct labelled texts. The summed log-likelihood is tempered to
  ``EVIDENCE`` independent trigrams, because neighbouring trigrams are not.
* Unknown languages: a text whose trigrams its best language hardly has (``known``
  below ``least_known``) belongs to no known one. It is rejected whatever else is
  declared, and is no evidence about its host, suffix or declared language.
* Declared markup language and address suffix: tables ``P(value | language)``
  counted over the whole corpus by grouped aggregation, where a row's language is
  its text's best one.
* Host: counts of the host's texts per language, smoothed towards its suffix,
  which is smoothed towards the whole corpus.

Counts are pre-aggregated in the map tasks, so a hot host sends a few rows.

Defined cases: null text, declared language, host or suffix is no evidence;
without any evidence the corpus prior decides and the row is rejected; repeated
rows count one by one, but train the text model once; an empty table trains nothing and returns no rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.llm.blocks import ascii_lower, blocks, mixed, row_of
from wattline.llm.sieve import passes, sieve_of
from wattline.llm.tables import Scratch
from wattline.operators.storage import cut_lineage

BUCKETS = 1 << 15

#: Distinct labelled texts of each language that the text model is fitted on, about.
#: A language with no more of them than that is taken whole.
SAMPLE = 20_000

#: Labels that the model can hold; there are fewer languages with two-letter codes.
MOST_LABELS = 200

#: Trigrams whose likelihood counts in full.
EVIDENCE = 60.0

#: Weight of the level above in a smoothed count.
PRIOR_WEIGHT = 20.0

#: A row is rejected if its best language is less likely than this.
LEAST_POSTERIOR = 0.5

#: Share of any language's trigrams that may be noise, spread evenly over the cells.
#: It bounds what an unseen trigram costs, so the measure does not depend on how
#: much text a language was trained on.
NOISE = 0.05

#: Least mean log-ratio of a text's trigrams, best language against even cells, and
#: what chance may take from it in a text of one trigram (of n: by the root of n).
#: On held-out given documents the ratio is 3.6 and more in 99 of 100; random
#: letters have -2.5 and real sentences of unseen languages up to 0.6.
LEAST_KNOWN = 1.0
KNOWN_SPREAD = 3.0

_LOWER = ascii_lower()
# A run of anything that is not a letter is one blank.
_PLAIN = _LOWER.copy()
_PLAIN[[c for c in range(128) if not chr(c).isalpha()]] = 32


def _cells(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed trigram cells with at least two letters, and each row's first one."""
    if len(data) < 3:
        return np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    plain = _PLAIN[data]
    wide = plain.astype(np.uint64)
    code = (wide[:-2] << np.uint64(16)) | (wide[1:-1] << np.uint64(8)) | wide[2:]
    blank = (plain == 32).astype(np.int8)
    use = (blank[:-2] + blank[1:-1] + blank[2:]) < 2
    for edge in offsets[1:-1]:  # a trigram must not cross rows
        use[max(edge - 2, 0) : edge] = False
    at = np.flatnonzero(use)
    return (mixed(code[at]) >> np.uint64(64 - 15)).astype(np.int64), np.searchsorted(at, offsets)


def sampled_rows(labelled: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """At most about ``sample`` distinct texts of each language of ``labelled (text, lang)``, copies included.

    Distinct texts are counted per language over the whole table. A language with more
    than ``sample`` of them gives a share chosen by a hash of the text, any other all.
    """
    rows = labelled.where("lang is not null and text is not null").select("text", "lang")
    counts = (
        rows.groupBy("lang")
        .agg(F.least(F.count("*"), F.approx_count_distinct("text")).alias("n"))
        .limit(MOST_LABELS + 1)
        .collect()
    )
    if len(counts) > MOST_LABELS:
        raise ValueError(f"more than {MOST_LABELS} different labels; clean the label column first")
    shares = [(r["lang"], sample / r["n"]) for r in counts if r["n"] > sample]
    if shares:
        share = F.try_element_at(F.create_map(*[F.lit(x) for pair in shares for x in pair]), F.col("lang"))
        rows = rows.where(
            share.isNull() | (F.abs(F.xxhash64("text") % 1_000_003) < share * 1_000_003)
        )
    return rows


def training_rows(labelled: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The sample with every text once, so that a large group of copies cannot fill it."""
    return sampled_rows(labelled, sample).dropDuplicates()


def train_text(labelled: DataFrame, sample: int = SAMPLE) -> tuple[list[str], np.ndarray]:
    """Languages and their log-probabilities per cell, from ``labelled (text, lang)``.

    Every label of the table is known that has a text with a trigram, at any size; more
    than ``MOST_LABELS`` labels are an error. Copies of a text take part once: only texts
    whose hash comes up again are shuffled, and compared whole, all others are counted
    where they are read.
    """
    scratch = Scratch(labelled.sparkSession, "training")
    picked = sampled_rows(labelled, sample).withColumn("hash", F.xxhash64("text", "lang"))
    again = picked.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1")
    sieve = sieve_of(again, "hash")

    def count(batches: Iterator[pa.RecordBatch], sifting: bool = True) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for whole in batches:
            if sifting:
                copied = pa.array(passes(sieve.value, whole.column("hash").to_numpy()))
                copies, whole = whole.filter(copied), whole.filter(pc.invert(copied))
                none = pa.nulls(copies.num_rows, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [copies.column("lang"), none, none, copies.column("text")], names=["lang", "cell", "n", "text"]
                )
            for batch, data, offsets in blocks([whole]):
                cells, first = _cells(data, offsets)
                for k, lang in enumerate(batch.column("lang").to_pylist()):
                    table = totals.setdefault(lang, np.zeros(BUCKETS, np.int64))
                    np.add.at(table, cells[first[k] : first[k + 1]], 1)
        for lang, table in totals.items():
            used = np.flatnonzero(table)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(used), pa.string()), pa.array(used), pa.array(table[used]), pa.nulls(len(used), pa.string())],
                names=["lang", "cell", "n", "text"],
            )

    shape = "lang string, cell long, n long, text string"
    first = scratch.stored(picked.select("text", "lang", "hash").mapInArrow(count, shape), "counted")
    copies = first.where("text is not null").select("text", "lang").dropDuplicates()
    counted = (
        first.where("text is null")
        .unionByName(copies.mapInArrow(lambda batches: count(batches, False), shape))
        .groupBy("lang", "cell")
        .agg(F.sum("n").alias("n"))
        .toPandas()  # MOST_LABELS times BUCKETS rows at most
    )
    scratch.drop("counted")
    sieve.destroy()
    langs = sorted(counted["lang"].unique())
    table = np.ones((len(langs), BUCKETS))
    for k, lang in enumerate(langs):
        own = counted[counted["lang"] == lang]
        table[k, own["cell"].to_numpy()] += own["n"].to_numpy()
    return langs, np.log(table / table.sum(axis=1, keepdims=True))


def against_even(model: np.ndarray) -> np.ndarray:
    """Log-ratio per language and cell: its text with some noise, against even cells."""
    own = np.exp(model)
    own -= own.min(axis=1, keepdims=True)  # without the count added to every cell
    share = own / np.maximum(own.sum(axis=1, keepdims=True), np.finfo(float).tiny)
    return np.log((1 - NOISE) * BUCKETS * share + NOISE)


def least_known(n_grams: Column) -> Column:
    """Least ``known`` of a text with that many trigrams to count as a known language."""
    return F.lit(LEAST_KNOWN) - KNOWN_SPREAD / F.sqrt(F.greatest(n_grams, F.lit(1)))


def score_text(rows: DataFrame, langs: Sequence[str], model: np.ndarray) -> DataFrame:
    """Replace ``text`` by ``n_grams``, ``known`` and ``text_log``.

    ``known`` is the best language's mean log-ratio against even cells, ``text_log``
    the tempered log-likelihoods, one per language.
    """
    kept = [c for c in rows.columns if c != "text"]
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast(model.astype(np.float32).T.copy())
    ratios = spark.sparkContext.broadcast(against_even(model).astype(np.float32))
    width = len(langs)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in blocks(batches):
            cells, first = _cells(data, offsets)
            n = np.diff(first)
            total = np.zeros((batch.num_rows, width))
            filled = n > 0
            if filled.any():
                total[filled] = np.add.reduceat(
                    shared.value[cells], first[:-1][filled], axis=0, dtype=np.float64
                )
            best = np.repeat(total.argmax(axis=1), n)
            summed = np.bincount(row_of(first), ratios.value[best, cells], minlength=batch.num_rows)
            known = np.round(summed / np.maximum(n, 1), 9)
            total *= np.minimum(1.0, EVIDENCE / np.maximum(n, 1))[:, None]
            total -= total.max(axis=1, keepdims=True)
            logs = pa.ListArray.from_arrays(
                pa.array(np.arange(batch.num_rows + 1) * width, pa.int32()),
                pa.array(np.round(total, 9).ravel()),
            )
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in kept], pa.array(n.astype(np.int64)), pa.array(known), logs],
                names=[*kept, "n_grams", "known", "text_log"],
            )

    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in kept)
    return rows.mapInArrow(score, f"{schema}, n_grams long, known double, text_log array<double>")


def _counted(rows: DataFrame, by: Sequence[str], langs: Sequence[str]) -> DataFrame:
    """Per group of ``by``: how many texts of a known language each language is best for."""
    return rows.where("text_best is not null").groupBy(*by).agg(
        F.array(*[F.count_if(F.col("text_best") == k).cast("double") for k in range(len(langs))]).alias("n")
    )


def _smoothed(own: Column, above: Column, weight: float = PRIOR_WEIGHT) -> Column:
    total = F.aggregate(own, F.lit(0.0), lambda a, x: a + x)
    return F.zip_with(own, above, lambda x, p: (x + weight * p) / (total + weight))


def _emission(rows: DataFrame, column: str, langs: Sequence[str]) -> DataFrame:
    """``log P(value | language)`` for the values of ``column``, add-one smoothed."""
    counted = _counted(rows.where(F.col(column).isNotNull()), [column], langs)
    sums = [F.coalesce(F.sum(F.get("n", F.lit(k))), F.lit(0.0)) for k in range(len(langs))]
    *totals, values = counted.agg(*sums, F.count("*")).first()
    bases = F.array(*[F.lit(t + values) for t in totals])
    return counted.select(
        column, F.zip_with("n", bases, lambda x, t: F.log((x + 1) / t)).alias(f"{column}_log")
    )


def identify(
    rows: DataFrame,
    langs: Sequence[str],
    model: np.ndarray,
    least_posterior: float = LEAST_POSTERIOR,
    also: Sequence[str] = (),
) -> DataFrame:
    """Language of each row of ``rows (doc_id, text, declared, suffix, host)``.

    Returns ``doc_id, language, posterior, text_language, n_grams, kept`` and the columns
    ``also`` of its rows. A text of an unknown language has no ``text_language`` and is not
    kept.
    """
    k = len(langs)
    kind = rows.schema["doc_id"].dataType.simpleString()
    if not k:
        return rows.select(
            "doc_id", *[F.lit(None).cast(t).alias(c) for c, t in (
                ("language", "string"), ("posterior", "double"), ("text_language", "string"), ("n_grams", "bigint"),
            )], F.lit(False).alias("kept"), *also,
        )
    best = F.array_position("text_log", F.array_max("text_log")).cast("int") - 1
    within = (F.col("n_grams") > 0) & (F.col("known") >= least_known(F.col("n_grams")))
    scored = cut_lineage(
        score_text(rows.select("doc_id", "text", "declared", "suffix", "host"), langs, model)
        .withColumn("text_best", F.when(within, best))
        .drop("known")
    )
    flat = F.array(*[F.lit(1.0 / k)] * k)
    corpus = _counted(scored, [], langs).select(_smoothed(F.col("n"), flat)).first()[0]
    whole = F.array(*map(F.lit, corpus))
    of_suffix = _counted(scored, ["suffix"], langs).withColumnRenamed("n", "suffix_n")
    of_host = _counted(scored, ["suffix", "host"], langs).withColumnRenamed("n", "host_n")
    priors = (
        of_host.join(of_suffix, of_host["suffix"].eqNullSafe(of_suffix["suffix"]))
        .drop(of_suffix["suffix"])
        .select(
            F.col("suffix").alias("_suffix"),
            F.col("host").alias("_host"),
            _smoothed(F.col("host_n"), _smoothed(F.col("suffix_n"), whole)).alias("prior"),
        )
    )
    fused = (
        scored.join(
            priors,
            scored["suffix"].eqNullSafe(F.col("_suffix")) & scored["host"].eqNullSafe(F.col("_host")),
            "left",
        )
        .join(_emission(scored, "declared", langs), "declared", "left")
        .join(_emission(scored, "suffix", langs), "suffix", "left")
    )
    none = F.array(*[F.lit(0.0)] * k)
    # What the text itself contributed to its host's prior is a small share by design.
    prior = F.transform(F.coalesce(F.col("prior"), whole), lambda p: F.log(p))
    logs = F.transform(
        F.arrays_zip(
            prior.alias("p"),
            F.coalesce("text_log", none).alias("t"),
            F.coalesce("declared_log", none).alias("d"),
            F.coalesce("suffix_log", none).alias("s"),
        ),
        lambda x: x["p"] + x["t"] + x["d"] + x["s"],
    )
    names = F.array(*map(F.lit, langs))
    weighed = fused.withColumn("logs", logs).withColumn("top", F.array_max("logs"))
    posterior = 1 / F.aggregate("logs", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("top")))
    foreign = (F.col("n_grams") > 0) & F.col("text_best").isNull()
    informed = (F.col("n_grams") > 0) | F.col("declared_log").isNotNull()
    return weighed.select(
        F.col("doc_id").cast(kind),
        F.get(names, F.array_position("logs", F.col("top")).cast("int") - 1).alias("language"),
        F.round(posterior, 6).alias("posterior"),
        F.get(names, "text_best").alias("text_language"),
        "n_grams",
        (informed & ~foreign & (posterior >= least_posterior)).alias("kept"),
        *also,
    )


def keep_identified(
    documents: DataFrame, rows: DataFrame, langs: Sequence[str], model: np.ndarray
) -> DataFrame:
    """The rows of ``documents`` that are not rejected, all columns kept.

    ``rows`` holds the evidence under the same ``doc_id``; the label in ``lang``
    becomes the language found. Rows with equal ids go or stay together, by the
    most certain of them; rows without an id are judged as one.

    Only what is rejected or gets another label is joined back; where that is little,
    the texts are not shuffled.
    """
    same = (F.col("_v.language") == F.col("_low")) & (F.col("_low") == F.col("_high")) & F.col("_all")
    changes = (
        identify(rows, langs, model, also=["declared"])
        .groupBy(F.col("doc_id").alias("_id"))
        .agg(
            F.max(F.struct("kept", "posterior", "language")).alias("_v"),
            F.min("declared").alias("_low"),
            F.max("declared").alias("_high"),
            F.bool_and(F.col("declared").isNotNull()).alias("_all"),
        )
        .where(~F.coalesce(F.col("_v.kept") & same, F.lit(False)))
        .select("_id", F.col("_v.kept").alias("_kept"), F.col("_v.language").alias("_language"))
    )
    changes = Scratch(documents.sparkSession, "languages").stored(changes, "changes")
    joined = documents.join(changes, documents["doc_id"].eqNullSafe(F.col("_id")), "left")
    return joined.where(F.col("_kept").isNull() | F.col("_kept")).select(
        *[F.coalesce("_language", documents[c]).alias(c) if c == "lang" else documents[c] for c in documents.columns]
    )
