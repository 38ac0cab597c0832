"""Removed bytes against a plain count of all strings."""

import random

import numpy as np
import pytest

from tests.llm import brute
from wattline.llm import suffix_dedup
from wattline.llm.blocks import prefixes, spans


def check(df, docs):
    expected = brute.repeats(docs)
    found = {r["doc_id"]: tuple(r)[1:5] for r in df.collect()}
    assert len(found) == len(docs)
    for i, wanted in expected.items():
        assert found[i] == wanted, i


def test_given_documents(documents, given):
    docs = [(r["doc_id"], r["text"]) for r in given("documents").limit(600).collect()]
    check(suffix_dedup.remove_repeats(documents(docs)), docs)


@pytest.mark.parametrize("seed", range(3))
def test_overlaps_edges_and_low_entropy(documents, seed):
    rng = random.Random(seed)
    noise = lambda n: "".join(rng.choices("abcdefghij klmnopé\n", k=n))
    passage, long = noise(420), noise(3000)
    texts = [None, "", "x" * 199, "x" * 200, "x" * 201, "y" * 5000, "ab" * 400, noise(199)]
    for _ in range(25):
        cut = rng.randrange(250)
        texts.append(noise(rng.randrange(300)) + passage[cut : cut + rng.randint(150, 300)] + noise(rng.randrange(300)))
    for _ in range(25):  # edited copies
        own = list(long)
        for _ in range(rng.randint(1, 12)):
            own[rng.randrange(len(own))] = rng.choice("XYZ")
        texts.append("".join(own[rng.randrange(400) :]))
    for size in (199, 200, 201, 250):  # exact lengths at either end
        texts += [noise(50) + long[100 : 100 + size], long[700 : 700 + size] + noise(50)]
    texts += [passage + passage, noise(100) + long[:199] + "|", long[1000:1350], long[1000:1350]]
    rng.shuffle(texts)
    check(suffix_dedup.remove_repeats(documents(texts)), list(enumerate(texts)))


def test_colliding_names_take_no_clean_byte(documents):
    rng = random.Random(9)
    noise = lambda n: "".join(rng.choices("abcdefghij", k=n))
    shared = noise(260)
    texts = [noise(rng.randrange(150, 600)) for _ in range(60)]
    texts += [noise(80) + shared[:240] + noise(90), noise(10) + shared + noise(20), noise(120) + shared[20:] + noise(40)]
    docs = list(enumerate(texts))
    # Of 16 bits: thousands of strings, so hundreds of names are shared by different strings.
    check(suffix_dedup.remove_repeats(documents(texts), name_bits=16), docs)
    check(suffix_dedup.remove_repeats(documents(texts), name_bits=4), docs)


def test_words_of_alternating_structure_are_told_apart():
    word = [0]
    while len(word) < 2048:
        word += [1 - x for x in word]
    data = np.array([[97 + x for x in word], [98 - x for x in word]], np.uint8)
    marks = [suffix_dedup._mark(suffix_dedup._grams(d), np.array([0]), np.array([len(d)]))[0] for d in data]
    sums = [spans(prefixes(d), np.array([0]), np.array([len(d)]))[0] for d in data]
    assert sums[0] == sums[1] and marks[0] != marks[1]


def test_repeated_rows_missing_ids_and_left_text(documents):
    a, b = "".join(map(chr, range(33, 120))) * 3, "0123456789" * 10
    rows = documents([(1, a), (1, a), (None, a + b), (2, b), (3, None)])
    found = sorted(
        ((str(r["doc_id"]), r["n_removed"], bytes(r["kept"]).decode()) for r in suffix_dedup.remove_repeats(rows, True).collect())
    )
    n = len(a)
    assert found == [("1", n, ""), ("1", n, ""), ("2", 0, b), ("3", 0, ""), ("None", n, b)]
    assert suffix_dedup.remove_repeats(documents([])).count() == 0
