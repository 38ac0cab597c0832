"""Near-duplicate groups against a plain comparison of all sets, and the sketch itself."""

import random

import numpy as np
import pyarrow as pa
import pytest

from tests.llm import brute
from wattline.llm import blocks, near_dedup
from wattline.llm.components import connected

WORDS = [f"w{k}" for k in range(3000)]


def text_of(rng, n=120):
    return " ".join(rng.choices(WORDS, k=n))


def edited(rng, text, n):
    words = text.split()
    for _ in range(n):
        words[rng.randrange(len(words))] = rng.choice(WORDS)
    return " ".join(words)


def check(df, docs):
    expected = brute.components(docs)
    found = {r["doc_id"]: r for r in df.collect()}
    assert len(found) == len(docs)
    for i, (n, component) in expected.items():
        r = found[i]
        assert (r["n_shingles"], r["component_id"], r["kept"]) == (n, component, component == i), i


def test_given_documents(documents, given):
    docs = [(r["doc_id"], r["text"]) for r in given("documents").collect()]
    check(near_dedup.find_groups(documents(docs)), docs)


def test_chains_hot_groups_and_odd_texts(documents):
    rng = random.Random(3)
    base = text_of(rng)
    chain = [base]
    for _ in range(60):
        chain.append(edited(rng, chain[-1], 2))
    near = [edited(rng, base, rng.randint(1, 5)) for _ in range(300)]
    passage = text_of(rng, 60)
    shared = [f"{passage} {text_of(rng, 60)}" for _ in range(150)]
    odd = [None, "", " \n\t", "one", "ONE", "one two three four", "One two\tthree\nfour", "one two three four five",
           "é é é é é é", "a b c d e " * 4000, "a b c d e " * 4001, "one two three four five six"]
    copies = [text_of(rng, 30)] * 200
    texts = chain + near + shared + odd + copies + [text_of(rng) for _ in range(100)]
    rng.shuffle(texts)
    docs = list(enumerate(texts))
    check(near_dedup.find_groups(documents(docs)), docs)


def test_blocks_of_a_large_bucket_find_all_links(documents, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 7)
    rng = random.Random(11)
    families = []
    for _ in range(6):
        base = text_of(rng, 100)
        families += [edited(rng, base, rng.randint(2, 9)) for _ in range(30)]
    docs = list(enumerate(families))
    check(near_dedup.find_groups(documents(docs)), docs)


def test_equal_missing_ids_and_extra_columns(spark, documents):
    near = " ".join(f"x{k}" for k in range(100))
    rows = documents([(1, "a b c d e f"), (1, near), (2, near + " y"), (None, near), (3, "a b c d e f"), (4, None)])
    found = sorted((str(r["doc_id"]), str(r["component_id"]), r["kept"]) for r in near_dedup.find_groups(rows).collect())
    assert found == [("1", "1", True)] * 2 + [("2", "1", False), ("3", "1", False), ("4", "4", True), ("None", "None", True)]
    wide = rows.selectExpr("*", "'k' as key", "1 as n", "2 as u", "3 as component", "true as kept")
    kept = near_dedup.keep_first(wide)
    assert kept.columns == wide.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "1", "4", "None"]
    assert near_dedup.find_groups(documents([])).count() == 0
    assert near_dedup.keep_first(documents([])).count() == 0


def _sketch(texts):
    found, first = near_dedup.shingle_sets(*blocks.text_bytes(pa.array(texts)))
    return found, first, near_dedup.registers(found, first)


def test_registers_merge_and_estimate():
    rng = random.Random(5)
    for share in (0.3, 0.6, 0.75, 0.9):
        size = 4000
        both = int(2 * size * share / (1 + share))
        pool = np.array([rng.getrandbits(64) for _ in range(2 * size - both)], np.uint64)
        a, b = np.sort(pool[:size]), np.sort(pool[size - both :])
        one = near_dedup.registers(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
        union = near_dedup.registers(np.unique(pool), np.array([0, len(np.unique(pool))]))
        assert (near_dedup.merge(one[0], one[1]) == union[0]).all()
        greater, smaller = (one[0] > one[1]).sum(), (one[0] < one[1]).sum()
        guess, open_ = near_dedup.estimate([greater], [smaller], [size], [size])
        assert abs(guess[0] - share) < 0.15
        assert open_[0] or share < 0.75


def test_shingles_equal_the_plain_version():
    texts = [None, "", "A b", "a B c d e f g", "É b c d e", "é b c d e", "x " * 50]
    found, first, _ = _sketch(texts)
    plain = [brute.shingles(t) for t in texts]
    assert np.diff(first).tolist() == [len(s) for s in plain]
    assert (found[first[4]] == found[first[5]]) == (plain[4] == plain[5])


@pytest.mark.parametrize("shape", ["path", "star", "random"])
def test_components(spark, shape):
    rng = random.Random(2)
    edges = {
        "path": [(k, k + 1) for k in range(200)],
        "star": [(0, k) for k in range(1, 300)] + [(500, 501)],
        "random": [(rng.randrange(300), rng.randrange(300)) for _ in range(220)],
    }[shape]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    found = {r["node"]: r["component"] for r in connected(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert found == {x: root(x) for x in list(parent)}


def test_a_block_returns_a_forest_not_its_pairs(documents):
    """Many pairs near the threshold: all compared, few returned."""
    rng = random.Random(8)
    base = text_of(rng, 146)
    docs = list(enumerate(edited(rng, base, rng.randint(3, 7)) for _ in range(260)))
    check(near_dedup.find_groups(documents(docs)), docs)
    texts = [t for _, t in docs]
    found, first, own = _sketch(texts)
    ids, every = np.arange(len(texts)), np.ones(len(texts), bool)
    pairs = []
    for band in range(near_dedup.REGISTERS // near_dedup.ROWS):
        pairs += near_dedup._forest(ids, ids, np.diff(first), own, found, first, every, every, band)
        assert len(pairs) <= (band + 1) * (len(texts) - 1)


def test_words_that_collide_in_any_polynomial_stay_apart(documents):
    one = "".join("ab"[k.bit_count() % 2] for k in range(1024))
    other = one.translate(str.maketrans("ab", "ba"))
    docs = [(0, one), (1, other), (2, f"{one} x y z w"), (3, f"{other} x y z w")]
    check(near_dedup.find_groups(documents(docs)), docs)


def test_word_hashes_see_every_byte():
    words = ["", "a", "b", "aa", "a" * 7, "a" * 8, "a" * 9, "a" * 16, "a" * 17, "\0", "\0\0", "b" + "a" * 16]
    data, offsets = blocks.text_bytes(pa.array(words))
    found = blocks.word_hashes(data, offsets[:-1], offsets[1:])
    assert len(set(found.tolist())) == len(words)
    again = blocks.word_hashes(*(lambda d, o: (d, o[:-1], o[1:]))(*blocks.text_bytes(pa.array(["zz", *words]))))
    assert again[1:].tolist() == found.tolist()
