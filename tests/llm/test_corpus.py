"""Quality rules, language, mixing and the stages of the pipeline."""

import collections
import random
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm import brute
from tests.llm.conftest import SMALL, TINY
from wattline.llm import langid, mixing, quality_rules, queries
from wattline.llm.workers import importable

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def plain_measures(text):
    text = text or ""
    words = [w for w in re.split(brute.BLANK + "+", text) if w]
    windows = collections.defaultdict(list)
    for i in range(len(words) - 4):
        windows[tuple(words[i : i + 5])].append(i)
    twice = {i + k for own in windows.values() if len(own) > 1 for i in own for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)), len(twice), len(words) < 10 or 100 * len(twice) > 20 * len(words),
    )


def test_quality_measures(documents, given):
    rng = random.Random(4)
    texts = [None, "", " \n\x0b\x0c\r", "a\xa0b", "one\n one\none\r\none\n", "a b c d e f", "a " * 9, "a " * 10, "#*$%&|<> é"]
    texts += [" ".join(rng.choices("abc", k=rng.randint(4, 60))) for _ in range(200)]
    texts += ["\n".join(rng.choices(["x y", "x  y", "", " ", "z"], k=8)) for _ in range(50)]
    texts += ["a b c d e f g " * 3000, " ".join(map(str, range(20_000)))]
    texts += [r["text"] for r in given("documents").collect()]
    found = {r["doc_id"]: r for r in quality_rules.apply_rules(documents(texts)).collect()}
    for k, text in enumerate(texts):
        assert tuple(found[k])[1:7] == plain_measures(text), text
        assert not (found[k]["base_failed"] and found[k]["kept"])
    assert quality_rules.apply_rules(documents([])).count() == 0


def test_quality_runs_without_user_functions(documents):
    plan = quality_rules.apply_rules(documents(["a"]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_thresholds_are_a_table(documents):
    rule = quality_rules.Rule("short", "n_words", low=3)
    rows = quality_rules.apply_rules(documents(["a b", "a b c"]), base=[rule], rules=[])
    assert [(r["kept"], r["broken"]) for r in rows.orderBy("doc_id").collect()] == [(False, "short"), (True, "")]


@pytest.fixture(scope="module")
def language_model(spark):
    importable(spark)
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").where("doc_id % 2 = 0")
    return langid.train_text(rows.select("text", "lang"))


def evidence(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, declared string, suffix string, host string")


def test_language_of_held_out_documents(given, language_model):
    held = given("documents").where("doc_id % 2 = 1")
    rows = queries.language_rows(held).withColumn("declared", F.lit(None).cast("string"))
    found = langid.identify(rows, *language_model).join(held.select("doc_id", "lang"), "doc_id").collect()
    right = sum(r["language"] == r["lang"] for r in found)
    assert len(found) == held.count() and right >= 0.99 * len(found)
    assert all(r["kept"] for r in found)


def test_evidence_decides_where_the_text_does_not(spark, given, language_model):
    texts = {r["lang"]: r["text"] for r in given("documents").where("doc_id % 2 = 1").collect()}
    rows = [(k, texts["fr"], "fr", "fr", "a.fr") for k in range(40)]
    rows += [(100 + k, texts["de"], "de", "de", "b.de") for k in range(40)]
    rows += [(200, "123", "fr", "fr", "a.fr"), (201, "123", "de", None, "unknown"), (202, None, None, "de", "b.de"),
             (203, "", None, None, None), (204, texts["de"], "fr", "fr", "a.fr")]
    found = {r["doc_id"]: r for r in langid.identify(evidence(spark, rows), *language_model).collect()}
    assert (found[200]["language"], found[200]["kept"]) == ("fr", True)
    assert (found[201]["language"], found[201]["kept"]) == ("de", True)
    assert (found[202]["language"], found[202]["kept"]) == ("de", False)
    assert not found[203]["kept"] and found[203]["n_grams"] == 0
    assert found[204]["text_language"] == "de"


def test_language_without_rows(spark, documents):
    importable(spark)
    langs, model = langid.train_text(documents([]).withColumn("lang", F.lit(None).cast("string")))
    assert langs == []
    assert langid.identify(evidence(spark, []), langs, model).count() == 0
    assert not langid.identify(evidence(spark, [(1, "x", None, None, None)]), langs, model).first()["kept"]


FOREIGN = (
    "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw.",
    "Все люди рождаются свободными и равными в своем достоинстве и правах.",
    "Alla människor är födda fria och lika i värde och rättigheter. De är utrustade med förnuft och samvete.",
    "人人生而自由,在尊严和权利上一律平等。他们赋有理性和良心,并应以兄弟关系的精神相对待。",
)


def test_gibberish_and_unseen_languages_are_rejected(spark, given, language_model):
    rng = random.Random(3)
    letters = "abcdefghijklmnopqrstuvwxyz"
    texts = ["".join(rng.choices(letters, k=rng.randint(20, 400))) for _ in range(200)]
    texts += [" ".join("".join(rng.choices(letters, k=rng.randint(2, 9))) for _ in range(30)) for _ in range(200)]
    texts += FOREIGN
    # Neither a declared language nor the host's other texts save them.
    rows = [(2 * k + d, t, ("fr" if d else None), None, "src1") for k, t in enumerate(texts) for d in (0, 1)]
    found = langid.identify(evidence(spark, rows), *language_model).collect()
    assert len(found) == len(rows)
    assert not any(r["kept"] or r["text_language"] for r in found)
    documents = given("documents")
    known = langid.identify(queries.language_rows(documents), *langid.train_text(documents.select("text", "lang")))
    assert known.where("not kept").count() == 0  # every given document has a language


def test_a_language_left_out_of_training_is_rejected(given):
    documents = given("documents")
    model = langid.train_text(documents.where("lang <> 'es'").select("text", "lang"))
    spanish = queries.language_rows(documents.where("lang = 'es'"))
    found = langid.identify(spanish, *model).collect()
    assert model[0] == ["de", "en", "fr"] and len(found) > 50
    assert not any(r["kept"] for r in found)


def test_rare_languages_are_known_at_every_size(spark):
    importable(spark)
    rows = [(f"the number {k} of many", "en") for k in range(6000)] + [(f"numéro rare {k}", "fr") for k in range(3)]
    labelled = spark.createDataFrame(rows, "text string, lang string")
    assert langid.train_text(labelled, sample=60)[0] == ["en", "fr"]
    taken = collections.Counter(r["lang"] for r in langid.training_rows(labelled, sample=60).collect())
    assert taken["fr"] == 3 and 20 < taken["en"] < 120


def test_copies_train_once(spark):
    importable(spark)
    rows = [("always the same words", "en")] * 500 + [("toujours les mots", "fr")] * 9
    labelled = spark.createDataFrame(rows, "text string, lang string")
    assert sorted(r["lang"] for r in langid.training_rows(labelled, sample=20).collect()) == ["en", "fr"]


def plain_mix(rows, budget):
    """Raking, calibration and sampling of ``(doc_id, tokens, cell)`` rows in plain Python."""
    import hashlib

    cells = collections.Counter()
    for _, tokens, cell in rows:
        cells[cell] += tokens
    cells = {c: n for c, n in cells.items() if n}
    total = sum(cells.values())
    share = {c: n / total for c, n in cells.items()}
    for _ in range(mixing.ROUNDS):
        for axis, margin in enumerate(mixing.MARGINS):
            have, tokens = collections.Counter(), collections.Counter()
            for c, s in share.items():
                have[c[axis]] += s
                tokens[c[axis]] += cells[c]
            aim = {k: n ** mixing.TEMPER[margin] for k, n in tokens.items()}
            whole = sum(aim.values())
            share = {c: s * aim[c[axis]] / whole / have[c[axis]] for c, s in share.items()}
    scale = budget * total
    taken = {c: min(n, share[c] * scale) for c, n in cells.items()}
    for _ in range(mixing.BOUNDED_ROUNDS):
        for axis, margin in enumerate(mixing.MARGINS):
            sizes = collections.Counter()
            for c, n in cells.items():
                sizes[c[axis]] += n
            aims = {k: n ** mixing.TEMPER[margin] for k, n in sizes.items()}
            whole = sum(aims.values())
            for k in sizes:
                own = [c for c in cells if c[axis] == k]
                aim, have = scale * aims[k] / whole, sum(taken[c] for c in own)
                free = [c for c in own if taken[c] < cells[c] * mixing.FULL]
                left, space = aim - sum(taken[c] for c in own if c not in free), sum(taken[c] for c in free)
                for c in own if have > aim else free:
                    taken[c] = taken[c] * aim / have if have > aim else min(cells[c], taken[c] * left / space)
    share = {c: n / scale for c, n in taken.items()}
    for _ in range(mixing.CALIBRATIONS):
        full = {c for c in cells if share[c] / cells[c] * scale >= mixing.FULL}
        left = sum(share[c] for c in cells if c not in full)
        if left:
            scale = max(scale, (budget * total - sum(cells[c] for c in full)) / left)
    odds = {c: min(1.0, share[c] / cells[c] * scale) for c in cells}
    u = lambda i: int(hashlib.md5(str(i or 0).encode()).hexdigest()[:13], 16) / 16**13
    return sorted(i or 0 for i, _, cell in rows if u(i) < odds.get(cell, budget)), odds, cells


def test_mixing_equals_the_plain_version(spark):
    rng = random.Random(9)
    rows = [
        (k, "x" * rng.randint(0, 3000), rng.choice(["en"] * 6 + ["de", "fr", None]), f"s{min(rng.randrange(12), 5)}", 0)
        for k in range(3000)
    ]
    rows += [(None, "abc", "en", None, 1), (7, None, "en", "s1", 1), (7, "x", "en", "s1", 1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    label = F.when(F.col("doc_id") % 3 == 0, "a").otherwise("b")
    mixed = mixing.mix(docs, topic=label, budget=0.4).collect()
    cell = lambda r: (r[3] or mixing.NONE, r[2] or mixing.NONE, "a" if (r[0] is not None and r[0] % 3 == 0) else "b")
    kept, odds, cells = plain_mix([(r[0], -(-len(r[1] or "") // 4), cell(r)) for r in rows], 0.4)
    assert sorted(r["doc_id"] or 0 for r in mixed) == kept
    assert abs(sum(odds[c] * n for c, n in cells.items()) / sum(cells.values()) - 0.4) < 0.01
    assert mixing.mix(spark.createDataFrame([], SCHEMA)).count() == 0


def test_mixing_meets_given_targets(spark):
    cells = spark.createDataFrame(
        [(s, g, t, 1000 + 137 * k) for k, (s, g, t) in enumerate((s, g, t) for s in "xyz" for g in "ab" for t in "pq")],
        "source string, lang string, topic string, tokens long",
    )
    wanted = {"source": {"x": 0.6, "y": 0.3, "z": 0.1}, "lang": {"a": 0.5, "b": 0.5}, "topic": {"p": 0.8, "q": 0.2}}
    given = {m: spark.createDataFrame(list(w.items()), f"{m} string, target double") for m, w in wanted.items()}
    fitted = mixing.rake(cells, mixing._targets(cells, given, {}))
    for margin, aims in wanted.items():
        for r in fitted.groupBy(margin).agg(F.sum("share").alias("s")).collect():
            assert abs(r["s"] - aims[r[margin]]) < 1e-6


def test_mixing_meets_targets_after_calibration(spark):
    """Two cells cannot give what raking asks of them; the others make up for it."""
    names = [(s, g, t) for s in "xyz" for g in "ab" for t in "pq"]
    cells = spark.createDataFrame(
        [(*c, 1000 + 137 * k) for k, c in enumerate(names)], "source string, lang string, topic string, tokens long"
    )
    wanted = {"source": {"x": 0.4, "y": 0.4, "z": 0.2}, "lang": {"a": 0.5, "b": 0.5}, "topic": {"p": 0.6, "q": 0.4}}
    given = {m: spark.createDataFrame(list(w.items()), f"{m} string, target double") for m, w in wanted.items()}
    aims = mixing._targets(cells, given, {})
    raked = mixing.rake(cells, aims)
    loose = mixing.marginals(mixing.calibrate(raked, 0.5), aims).collect()
    odds = mixing.calibrate(mixing.rake_bounded(raked, aims, 0.5), 0.5)
    bound = mixing.marginals(odds, aims).collect()
    assert max(abs(r["target"] - r["expected"]) for r in loose) > 0.01
    assert max(abs(r["target"] - r["expected"]) for r in bound) < 0.002
    assert len(bound) == 7 and 0 < odds.agg(F.min("probability")).first()[0]
    assert odds.agg(F.max("probability")).first()[0] == 1.0
    used = odds.agg(F.sum(F.col("tokens") * F.col("probability")) / F.sum("tokens")).first()[0]
    assert abs(used - 0.5) < 1e-6


def test_mixing_out_of_reach_keeps_the_budget(spark):
    cells = spark.createDataFrame(
        [("x", "a", "p", 10), ("y", "a", "p", 990)], "source string, lang string, topic string, tokens long"
    )
    given = {
        "source": spark.createDataFrame([("x", 0.9), ("y", 0.1)], "source string, target double"),
        "lang": spark.createDataFrame([("a", 1.0)], "lang string, target double"),
        "topic": spark.createDataFrame([("p", 1.0)], "topic string, target double"),
    }
    aims = mixing._targets(cells, given, {})
    odds = mixing.calibrate(mixing.rake_bounded(mixing.rake(cells, aims), aims, 0.5), 0.5)
    got = {r["source"]: r["probability"] for r in odds.collect()}
    assert abs(got["x"] - 1) < 1e-9 and abs(got["y"] - 490 / 990) < 1e-9
    rows = {(r["margin"], r["category"]): r["expected"] for r in mixing.marginals(odds, aims).collect()}
    assert abs(rows["source", "x"] - 0.02) < 1e-9


def test_mixing_keeps_clashing_columns(spark):
    docs = spark.createDataFrame([(k, "some text", "en", "s", 9, "t", 1.0) for k in range(50)],
                                 SCHEMA + ", topic string, probability double")
    mixed = mixing.mix(docs, budget=1.0)
    assert mixed.columns[:7] == docs.columns and mixed.count() == 50


# ---- pipeline -----------------------------------------------------------------------


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage returned, in order, beginning with the documents."""
    importable(spark)
    out = [spark.read.parquet(f"{TINY}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, out[-1], TINY).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def test_stages_do_what_the_plain_versions_do(spark, stages):
    docs, known, single, clean, safe, mixed = stages
    for frame in (known, single, clean, safe):
        assert frame.dtypes == docs.dtypes
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert {r["doc_id"] for r in known.collect()} == set(texts)  # every given document has a language
    groups = brute.components([(r["doc_id"], r["text"]) for r in known.collect()])
    assert {r["doc_id"] for r in single.collect()} == {i for i, (_, c) in groups.items() if i == c}
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{TINY}/benchmark.parquet").collect()]
    unleaked = {r["doc_id"] for r in single.collect() if not brute.leaks(r["text"], items)[1]}
    assert {r["doc_id"] for r in clean.collect()} == unleaked
    for r in safe.collect():
        assert (r["text"] == texts[r["doc_id"]]) == (not brute.secret_base(texts[r["doc_id"]]))
        assert r["n_chars"] == len(r["text"])
    assert {r["doc_id"] for r in safe.collect()} == unleaked
    assert {r["doc_id"] for r in mixed.collect()} <= unleaked


def test_run_equals_the_stages(spark, stages):
    whole = corpus_pipeline.run(spark, TINY)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, stages[-1].collect()))


def test_stages_take_odd_rows(spark):
    importable(spark)
    rows = [
        (None, None, None, None, None, 1), (1, "", "en", None, 0, 1), (1, "", "en", None, 0, 1),
        (2, "x " * 100_000, None, "s", 1, None), (3, "the of and to in is " * 3, "en", "s", 1, 1),
    ]
    docs = spark.createDataFrame(rows, SCHEMA + ", kept long")
    for frame in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, frame, TINY)
            assert out.columns[: len(docs.columns)] == docs.columns
            out.collect()


def test_queries_are_registered():
    names = {f"op{n}_" for n in range(1, 14)}
    assert {re.match(r"op\d+_", q)[0] for q in queries.QUERIES if q.startswith("op")} == names


def test_too_many_labels_are_an_error(documents, monkeypatch):
    monkeypatch.setattr(langid, "MOST_LABELS", 3)
    rows = documents([f"text number {k}" for k in range(9)]).withColumn("lang", F.col("doc_id").cast("string"))
    with pytest.raises(ValueError, match="labels"):
        langid.train_text(rows)


def test_copies_train_once(documents):
    texts = [f"some words of text {k} and more" for k in range(6)]
    once = documents(texts).withColumn("lang", F.lit("en"))
    many = documents(texts + [texts[0]] * 50).withColumn("lang", F.lit("en"))
    assert (langid.train_text(once)[1] == langid.train_text(many)[1]).all()


def test_changes_of_rows_that_share_an_id(documents, language_model, given):
    some = given("documents").where("lang = 'fr'").limit(3).collect()
    rows = [(1, some[0]["text"], "fr"), (1, some[0]["text"], "en"), (2, some[1]["text"], "fr"), (2, some[1]["text"], None),
            (3, some[2]["text"], "fr"), (None, some[2]["text"], "de"), (4, "", None)]
    frame = documents([]).sparkSession.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("source", F.lit("s"))
    kept = langid.keep_identified(frame, queries.language_rows(frame), *language_model)
    assert sorted((str(r["doc_id"]), r["lang"]) for r in kept.collect()) == [
        ("1", "fr"), ("1", "fr"), ("2", "fr"), ("2", "fr"), ("3", "fr"), ("None", "fr")]
