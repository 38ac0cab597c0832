"""Near-duplicate detection by SimHash fingerprints and covering locality-sensitive hashing.

A fingerprint has a bit for every bit of a 64-bit hash: set if the hash of over half
of the text's word shingles, repeats included, has it. Two fingerprints are linked if
they differ in at most ``RADIUS`` bits.

The free bits of a fingerprint get the nonzero vectors of ``RADIUS + 1`` bits as
labels, in turn. For every nonzero vector ``v`` there is a table whose key keeps the
bits whose label has an odd product with ``v``. Up to ``RADIUS`` labels never span
all vectors, so some ``v`` is orthogonal to all of them: the table of that ``v`` keeps
none of the bits in which a linked pair differs. Every linked pair therefore meets
in some table, without any chance involved.

1. Equal fingerprints collapse to one; every other step sees distinct ones.
2. A bucket of up to ``BUCKET`` fingerprints is compared inside a task, which returns
   a forest over its links and never its pairs.
3. A larger bucket compares its members with its smallest one only. If they are not
   all in one component then, the same cover is laid over the bits its key left free.
   The third cover leaves at most eight free bits, so its buckets hold ``BUCKET``
   fingerprints at most, at any number of documents.

Defined cases: a null, empty or blank text has fingerprint zero, which is linked like
any other; a text of fewer words than a shingle is one shingle; rows with equal ids
are one document, linked by any of its texts; rows without an id have a fingerprint,
no component and link nothing; a very long text is hashed in pieces of ``CHUNK``
shingles; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.llm.blocks import ascii_lower, blocks, byte_set, words
from wattline.llm.components import connected
from wattline.llm.tables import Scratch

#: Words in a shingle, seed of their hash, and the most differing bits of a link.
SHINGLE = 3
SEED = 42
RADIUS = 3

#: Members of a bucket that are compared in one task; not below the 2 ** 8 of the last cover.
BUCKET = 256

#: Shingles whose bits are spread out at a time.
CHUNK = 1 << 15

WIDTH = 64
LABELS = (1 << (RADIUS + 1)) - 1
BLANKS = byte_set((0x20, 0x20), (0x09, 0x0D))

_LOWER = ascii_lower()


def _joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
    """All words with one space after each, and the start and end of every word therein."""
    sizes = ends - starts
    low = np.cumsum(sizes + 1) - sizes - 1
    inner = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out = np.full(int((sizes + 1).sum()), 0x20, np.uint8)
    out[np.repeat(low, sizes) + inner] = data[np.repeat(starts, sizes) + inner]
    return out.tobytes(), low, low + sizes


def shingle_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of all rows, and each row's first one."""
    data = _LOWER[data]
    starts, ends, first = words(data, offsets, BLANKS)
    whole, low, high = _joined(data, starts, ends)
    count = np.diff(first)
    n = np.where(count >= SHINGLE, count - SHINGLE + 1, np.minimum(count, 1))
    head = np.concatenate(([0], np.cumsum(n)))
    at = np.repeat(first[:-1] - head[:-1], n) + np.arange(head[-1])
    last = at + np.repeat(np.minimum(count, SHINGLE), n) - 1
    view, digest = memoryview(whole), xxhash.xxh64_intdigest
    found = (digest(view[a:b], SEED) for a, b in zip(low[at].tolist(), high[last].tolist()))
    return np.fromiter(found, np.uint64, len(at)), head


def majority(hashes: np.ndarray, head: np.ndarray) -> np.ndarray:
    """One fingerprint per row: the bits set in over half its hashes."""
    n = np.diff(head)
    ones = np.zeros((len(n), WIDTH), np.int64)
    for low in range(0, len(hashes), CHUNK):
        high = min(low + CHUNK, len(hashes))
        a, b = np.searchsorted(head, low, "right") - 1, np.searchsorted(head, high, "left")
        rows = a + np.flatnonzero(n[a:b])  # those with a hash in this piece
        bits = np.unpackbits(hashes[low:high].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones[rows] += np.add.reduceat(bits, np.maximum(head[rows], low) - low, axis=0, dtype=np.int64)
    return np.packbits(2 * ones > n[:, None], axis=1, bitorder="little").view(np.uint64).ravel()


def fingerprints(documents: DataFrame) -> DataFrame:
    """``doc_id, print`` for every row of ``documents (doc_id, text)``."""
    kind = documents.schema["doc_id"].dataType.simpleString()

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in blocks(batches):
            found = majority(*shingle_hashes(data, offsets))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found.view(np.int64))], names=["doc_id", "print"]
            )

    return documents.select("doc_id", "text").mapInArrow(sketch, f"doc_id {kind}, print long")


def cover(free: int) -> list[int]:
    """Masks of the bits kept by each table of the cover over the bits of ``free``."""
    places = [b for b in range(WIDTH) if free >> b & 1]
    return [
        sum(1 << b for k, b in enumerate(places) if ((1 + k % LABELS) & v).bit_count() % 2)
        for v in range(1, LABELS + 1)
    ]


@cache
def kept_bits(path: int) -> int:
    """Bits fixed by the key of a bucket whose covers were entered at the tables of ``path``."""
    if not path:
        return 0
    above, table = divmod(path, LABELS + 1)
    fixed = kept_bits(above)
    return fixed | cover(fixed ^ ((1 << WIDTH) - 1))[table - 1]


def _dealt(frame: DataFrame) -> DataFrame:
    """``path, part, print``: each fingerprint of ``frame (path, print)`` in all tables of its next cover."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            path, value = batch.column("path").to_numpy(), batch.column("print").to_numpy()
            above, group = np.unique(path, return_inverse=True)
            for table in range(1, LABELS + 1):
                below = above * (LABELS + 1) + table
                masks = np.array([kept_bits(int(p)) for p in below], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(below[group]), pa.array(value & masks[group]), batch.column("print")],
                    names=["path", "part", "print"],
                )

    return frame.mapInArrow(deal, "path long, part long, print long")


def forest(prints: np.ndarray) -> list[tuple[int, int]]:
    """As few linked pairs of distinct ``prints`` as join all that their links join."""
    bits = prints.view(np.uint64)  # of a negative number the bits of its absolute value would count
    apart = np.bitwise_count(bits[:, None] ^ bits[None, :])
    left, right = np.nonzero(np.triu(apart <= RADIUS, 1))
    group, out = np.arange(len(prints)), []
    for a, b in zip(left.tolist(), right.tolist()):
        if group[a] != group[b]:
            out.append((a, b))
            group[group == group[b]] = group[a]
    return out


def _inside(buckets: DataFrame) -> DataFrame:
    """Links ``u, v`` of the small buckets ``prints``, a list each."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("prints")
            values, ends = column.flatten().to_numpy(), np.concatenate(([0], np.cumsum(column.value_lengths().to_numpy())))
            u, v = [], []
            for low, high in zip(ends[:-1].tolist(), ends[1:].tolist()):
                own = values[low:high]
                for a, b in forest(own):
                    u.append(own[a])
                    v.append(own[b])
            yield pa.RecordBatch.from_arrays(
                [pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"]
            )

    return buckets.select("prints").mapInArrow(compare, "u long, v long")


def linked_prints(prints: DataFrame, more: DataFrame, scratch: Scratch) -> DataFrame:
    """``node, component`` over the distinct ``print`` values and the further links ``more (u, v)``."""
    links, frame, level = more, prints.select(F.lit(0).cast("long").alias("path"), "print"), 0
    while True:
        members = scratch.stored(_dealt(frame), f"members{level}")
        counted = members.groupBy("path", "part").agg(F.count("*").alias("n"), F.min("print").alias("center"))
        counted = scratch.stored(counted.where("n > 1"), f"buckets{level}")
        small = (
            members.join(counted.where(F.col("n") <= BUCKET), ["path", "part"])
            .groupBy("path", "part")
            .agg(F.collect_list("print").alias("prints"))
        )
        large = members.join(counted.where(F.col("n") > BUCKET), ["path", "part"])
        stars = large.where(F.bit_count(F.col("print").bitwiseXOR(F.col("center"))).between(1, RADIUS))
        found = _inside(small).unionByName(stars.select(F.col("center").alias("u"), F.col("print").alias("v")))
        links = links.unionByName(scratch.stored(found.distinct(), f"links{level}"))
        components = connected(links)
        if counted.where(F.col("n") > BUCKET).isEmpty():
            scratch.drop(f"members{level}", f"buckets{level}")
            return components
        placed = large.join(components, large["print"] == components["node"], "left").select(
            "path", "part", "print", F.coalesce("component", "print").alias("component")
        )
        mixed = placed.groupBy("path", "part").agg(F.min("component").alias("a"), F.max("component").alias("b"))
        frame = scratch.stored(
            large.join(mixed.where("a <> b"), ["path", "part"], "left_semi").select("path", "print"),
            f"open{level}",
        )
        scratch.drop(f"members{level}", f"buckets{level}")
        level += 1


def find_groups(documents: DataFrame) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``documents (doc_id, text)``."""
    scratch = Scratch(documents.sparkSession, "simhash")
    rows = scratch.stored(fingerprints(documents), "rows")
    named = rows.where("doc_id is not null")
    prints = scratch.stored(named.groupBy("print").agg(F.min("doc_id").alias("first")), "prints")
    several = named.groupBy("doc_id").agg(F.min("print").alias("u"), F.max("print").alias("w")).where("u <> w")
    same = named.join(several, "doc_id").where(F.col("print") != F.col("u"))
    components = linked_prints(prints, same.select("u", F.col("print").alias("v")).distinct(), scratch)

    placed = prints.join(components, prints["print"] == components["node"], "left").select(
        "print", "first", F.coalesce("component", "print").alias("component")
    )
    least = placed.groupBy("component").agg(F.min("first").alias("component_id"))
    named_by = placed.join(least, "component").select("print", "component_id")
    out = rows.join(named_by, "print", "left")
    return out.select(
        "doc_id",
        F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"),
    )
