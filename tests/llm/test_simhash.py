"""SimHash groups against all pairs, and the cover's guarantee."""

import itertools
import random

import numpy as np

from tests.llm import brute_more
from wattline.llm import blocks, simhash_dedup
from wattline.llm.tables import Scratch

ALL = (1 << 64) - 1


def check(df, docs):
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in df.collect()}
    assert got == brute_more.print_groups(docs)


def test_given_documents(documents, given):
    docs = [(r["doc_id"], r["text"]) for r in given("documents", "/root/testdata/sf0.001").collect()]
    check(simhash_dedup.find_groups(documents(docs)), docs)


def test_odd_and_long_texts(documents, monkeypatch):
    monkeypatch.setattr(simhash_dedup, "CHUNK", 7)
    rng = random.Random(1)
    words = [f"w{k}" for k in range(50)]
    texts = [None, "", " \n\t", "one", "ONE", "One two", "one two three", "one  two\tthree\n", "é É é É"]
    texts += [" ".join(rng.choices(words, k=rng.randint(1, 90))) for _ in range(60)]
    texts += ["a b c " * 9000, "x" * 100_000]
    check(simhash_dedup.find_groups(documents(texts)), list(enumerate(texts)))


def test_every_pair_in_the_radius_meets():
    rng = random.Random(3)
    for free in (ALL, simhash_dedup.kept_bits(5) ^ ALL, simhash_dedup.kept_bits(5 * 16 + 9) ^ ALL):
        masks = simhash_dedup.cover(free)
        places = [b for b in range(64) if free >> b & 1]
        some = itertools.combinations(places, 3)
        if len(places) > 20:
            some = (rng.sample(places, rng.randint(1, 3)) for _ in range(5000))
        for flipped in some:
            apart = sum(1 << b for b in flipped)
            assert any(not apart & m for m in masks)
    assert all((simhash_dedup.kept_bits(a * 256 + b * 16 + c) ^ ALL).bit_count() <= 8
               for a, b, c in itertools.product(range(1, 16), repeat=3))


def test_crowded_buckets_lose_no_link(spark, documents):
    rng = random.Random(8)
    centers = [rng.getrandbits(64) for _ in range(3)]
    centers.append(centers[0] ^ 0b1111)  # four bits apart: linked only through others
    values = set(centers)
    for _ in range(6000):
        near = rng.choice(centers)
        for b in rng.sample(range(64), rng.randint(1, 6)):
            near ^= 1 << b
        values.add(near)
    values = sorted(values)
    parent = list(range(len(values)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    prints = np.array(values, np.uint64)
    for a, b in zip(*np.nonzero(np.triu(np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 3, 1))):
        x, y = root(int(a)), root(int(b))
        parent[max(x, y)] = min(x, y)
    rows = spark.createDataFrame([(int(v),) for v in prints.view(np.int64)], "print long")
    none = spark.createDataFrame([], "u long, v long")
    got = {r["node"]: r["component"] for r in simhash_dedup.linked_prints(rows, none, Scratch(spark, "t")).collect()}
    signed = prints.view(np.int64).tolist()
    sets, plain = {}, {}
    for k, v in enumerate(signed):
        sets.setdefault(got.get(v, v), set()).add(v)
        plain.setdefault(root(k), set()).add(v)
    assert sorted(map(sorted, sets.values())) == sorted(map(sorted, plain.values()))


def test_fingerprints_do_not_depend_on_the_block():
    import pyarrow as pa

    texts = ["a b c d e", "", "q", "a b c d e f g h"] * 3
    data, offsets = blocks.text_bytes(pa.array(texts))
    together = simhash_dedup.majority(*simhash_dedup.shingle_hashes(data, offsets))
    assert together.tolist() == [brute_more.fingerprint(t) for t in texts]


def test_equal_missing_ids_and_extra_columns(documents):
    rows = documents([(1, "a b c d"), (1, "p q r s t"), (2, "P q r s t"), (None, "a b c d"), (3, "a b c d"), (9, None), (8, "")])
    wide = rows.selectExpr("*", "5 as print", "1 as path", "2 as part", "3 as u", "4 as component", "6 as node")
    for frame in (rows, wide):
        got = sorted((str(r["doc_id"]), str(r["component_id"])) for r in simhash_dedup.find_groups(frame).collect())
        assert got == [("1", "1"), ("1", "1"), ("2", "1"), ("3", "1"), ("8", "8"), ("9", "8"), ("None", "None")]
    assert simhash_dedup.find_groups(documents([])).count() == 0
