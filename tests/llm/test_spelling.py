"""Spelling variants against a plain search, and the cases that need a cut or a join."""

import random

import numpy as np
import pytest

from tests.llm import brute_more
from wattline.llm import spelling
from wattline.llm.tables import Scratch


def found(df):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()}


def test_given_documents(documents, given):
    docs = [(r["doc_id"], r["text"]) for r in given("documents").collect()]
    assert found(spelling.group_spellings(documents(docs))) == brute_more.variants(docs)


def families(rng, n):
    words = set()
    for _ in range(n):
        base = "".join(rng.choices("abcdeéÀ", k=rng.randint(7, 9)))
        words.add(base)
        for _ in range(4):
            k, c = rng.randrange(len(base)), rng.choice("abcdeéÀ")
            words.add(rng.choice([base[:k] + base[k + 1 :], base[:k] + c + base[k + 1 :], base[:k] + c + base[k:]]))
    return sorted(w for w in words if len(w) >= 7)


def plain_pairs(words):
    by = {}
    for w in words:
        for k in range(len(w)):
            by.setdefault((k, w[:k] + w[k + 1 :]), set()).add(w)
    out = {(min(a, b), max(a, b)) for own in by.values() for a in own for b in own if a != b}
    known = set(words)
    return out | {
        (min(w, s), max(w, s)) for w in words for k in range(len(w)) if (s := w[:k] + w[k + 1 :]) in known
    }


@pytest.mark.parametrize("shard, probes", [(4096, 1 << 16), (40, 50), (1, 1000)])
def test_every_cut_finds_all_pairs(spark, documents, monkeypatch, shard, probes):
    monkeypatch.setattr(spelling, "SHARD", shard)
    monkeypatch.setattr(spelling, "PROBES", probes)
    words = families(random.Random(4), 80)
    # Anagrams share a leaf at any depth; these are a leaf larger than a shard of one word.
    words = sorted({*words, "abcdefgh", "hgfedcba", "abcdefhg", "abcdefg", "bbcdefgh", "áÁáÁáÁáÁ", "ÁáÁáÁáÁá"})
    rows = spelling.with_counts(spark.createDataFrame([(w, 2) for w in words], "word string, n long"))
    got = [(r["a"], r["b"]) for r in spelling.near_words(rows, Scratch(spark, "t")).collect()]
    pairs = {(min(p), max(p)) for p in got}
    assert len(got) == len(pairs) and pairs == plain_pairs(words)


def test_one_edit_by_letters():
    left = ["abcdefg", "abcdefg", "abcdefg", "abcdefg", "abcdefg", "aabbcc"]
    right = ["abcdefh", "bcdefg", "abcdef", "abcdgf", "badcefg", "abbcc"]
    at = np.arange(len(left))
    near = spelling.one_edit(spelling.letters_of(left), spelling.letters_of(right), at, at)
    assert near.tolist() == [True, True, True, False, False, True]


def test_roots_follow_a_chain(spark):
    forms = [(chr(97 + k), chr(98 + k)) for k in range(9)]
    got = spelling.rooted(spark.createDataFrame(forms, "word string, form string"), 10**9, Scratch(spark, "t")).collect()
    assert {tuple(r) for r in got} == {(w, "j") for w, _ in forms}


def test_odd_rows(spark, documents):
    long_ = "z" * 50_000
    docs = [(None, "Wonderful wonderful"), (None, None), (1, ""), (2, "12 !! #"), (3, f"{long_} {long_}y"),
            (3, f"{long_} {long_}y"), (4, "wonderfull " * 30), (4, "wonderfull " * 30), (5, "ÀÉÎõü×÷ ÀÉÎõü×÷")]
    frame = documents(docs)
    expected = brute_more.variants(docs)
    assert found(spelling.group_spellings(frame)) == expected
    wide = frame.selectExpr("*", "'k' as word", "1 as n", "'x' as node", "2 as state", "'r' as run", "'i' as id")
    assert found(spelling.group_spellings(wide)) == expected
    assert spelling.group_spellings(documents([])).count() == 0
