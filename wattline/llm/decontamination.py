"""Benchmark decontamination: find and remove test items inside training text.

The benchmark's n-grams of normalised words form a hash set that is broadcast
when its measured size is small; every training text is scanned once, window by
window, and a hash hit counts only if the words themselves agree. A set beyond
the size bound is joined by shuffle instead, with the same result.

Defined cases: a null text has no words; an item without words has no window; an
item shorter than the window is one window; rows with equal ids are reported one
by one; an item without an id still marks words but is not listed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline.llm.blocks import (
    ascii_lower,
    blocks,
    byte_set,
    prefixes,
    rolling,
    row_of,
    spans,
    words,
)
from wattline.llm.sieve import passes, sieve_of
from wattline.llm.tables import Scratch

#: Words in a window.
WINDOW = 10

#: Largest n-gram set, in bytes of its words and item ids, that is broadcast.
BROADCAST_BYTES = 64 << 20

#: Counted for each pair of window and item besides their text.
_ROW_BYTES = 24

#: Everything in ASCII but digits and lower-case letters separates words.
SEPARATORS = byte_set((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))

_LOWER = ascii_lower()
_SIEVE_BITS = 20


def _windows(hashes: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-word windows and whether each stays inside one row."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, bool)
    return rolling(prefixes(hashes), n), row[:count] == row[n - 1 :]


def _tokens(data: np.ndarray, offsets: np.ndarray):
    data = _LOWER[data]
    starts, ends, first = words(data, offsets, SEPARATORS)
    return data, starts, ends, first, spans(prefixes(data), starts, ends), row_of(first)


def _gram(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, at: int, n: int) -> str:
    pieces = (data[starts[i] : ends[i]].tobytes() for i in range(at, at + n))
    return b" ".join(pieces).decode("utf-8", "replace")


def ngrams(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct ``(n, hash, gram, item)`` of ``benchmark (item_id, text)``: a row for each
    window and each item that holds it."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in blocks(batches):
            data, starts, ends, first, hashes, _ = _tokens(data, offsets)
            out: dict[str, list] = {"n": [], "hash": [], "gram": [], "item": []}
            for k, item in enumerate(batch.column("item").to_pylist()):
                low, high = first[k], first[k + 1]
                n = int(min(window, high - low))
                if n == 0:
                    continue
                found, _ = _windows(hashes[low:high], np.zeros(high - low, int), n)
                for at, value in enumerate(found.view(np.int64).tolist()):
                    out["n"].append(n)
                    out["hash"].append(value)
                    out["gram"].append(_gram(data, starts, ends, low + at, n))
                    out["item"].append(item)
            yield pa.RecordBatch.from_pydict(
                out,
                pa.schema([("n", pa.int32()), ("hash", pa.int64()), ("gram", pa.string()), ("item", pa.string())]),
            )

    texts = benchmark.select(F.col("item_id").cast("string").alias("item"), "text")
    return texts.mapInArrow(cut, "n int, hash long, gram string, item string").distinct()


class _Set:
    """The broadcast form: sorted hashes per window length, each with words and items."""

    def __init__(self, rows):
        self.by_length = {}
        for n in sorted({r["n"] for r in rows}):
            own = sorted((r for r in rows if r["n"] == n), key=lambda r: r["hash"] % (1 << 64))
            hashes = np.array([r["hash"] for r in own], np.int64).view(np.uint64)
            sieve = np.zeros(1 << _SIEVE_BITS, bool)
            sieve[hashes >> np.uint64(64 - _SIEVE_BITS)] = True
            self.by_length[n] = (hashes, sieve, [(r["gram"], r["items"]) for r in own])

    def hits(self, data, starts, ends, hashes, row):
        """``(first word, n, items)`` of each verified window."""
        for n, (known, sieve, entries) in self.by_length.items():
            found, whole = _windows(hashes, row, n)
            near = np.flatnonzero(sieve[found >> np.uint64(64 - _SIEVE_BITS)] & whole)
            if not len(near):
                continue
            low = np.searchsorted(known, found[near], "left")
            high = np.searchsorted(known, found[near], "right")
            for at, a, b in zip(near[low < high], low[low < high], high[low < high]):
                words_here = _gram(data, starts, ends, at, n)
                for gram, items in entries[a:b]:
                    if gram == words_here:
                        yield int(at), n, items


def _covered(count: int, places: list[tuple[int, int]]) -> np.ndarray:
    steps = np.zeros(count + 1, np.int64)
    for at, n in places:
        steps[at] += 1
        steps[at + n] -= 1
    return np.cumsum(steps[:-1]) > 0


#: What a scan adds to a row; the names stay clear of the input's.
_ADDED = T.StructType(
    [
        T.StructField("_n_words", T.LongType()),
        T.StructField("_n_hit", T.LongType()),
        T.StructField("_items", T.ArrayType(T.StringType())),
        T.StructField(
            "_hit_spans",
            T.ArrayType(
                T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
            ),
        ),
    ]
)


def _with_added(batch: pa.RecordBatch, names: list[str], first, n_hit, items, found) -> pa.RecordBatch:
    ranges = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    added = [
        pa.array(np.diff(first), pa.int64()),
        pa.array(n_hit, pa.int64()),
        pa.array(items, pa.list_(pa.string())),
        pa.array(found, ranges),
    ]
    return pa.RecordBatch.from_arrays(
        [*[batch.column(c) for c in names], *added], names=[*names, *_ADDED.names]
    )


def _byte_spans(covered: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[dict]:
    """Runs of covered words as byte ranges of the row."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], covered.astype(np.int8), [0]))))
    return [{"start": int(starts[a]), "end": int(ends[b - 1])} for a, b in edge.reshape(-1, 2)]


def _scanned(
    documents: DataFrame, benchmark: DataFrame, window: int, broadcast_bytes: int
) -> DataFrame:
    """All columns of ``documents`` and what the scan adds, row by row."""
    spark = documents.sparkSession
    stored = Scratch(spark, "decontamination")
    grams = stored.stored(ngrams(benchmark, window), "grams")
    ids = F.coalesce(F.octet_length("item"), F.lit(0))
    size = grams.agg(F.sum(F.octet_length("gram") + ids + _ROW_BYTES)).first()[0] or 0
    if size > broadcast_bytes:
        return _joined(documents, grams)
    # Within the bound, so one window's items are as well.
    listed = grams.groupBy("n", "hash", "gram").agg(F.collect_set("item").alias("items"))
    known = spark.sparkContext.broadcast(_Set(listed.collect()))
    stored.drop("grams")
    names = documents.columns

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in blocks(batches):
            data, starts, ends, first, hashes, row = _tokens(data, offsets)
            places, items = [], [set() for _ in range(batch.num_rows)]
            for at, n, own in known.value.hits(data, starts, ends, hashes, row):
                places.append((at, n))
                items[row[at]].update(own)
            covered = _covered(len(starts), places)
            hit = np.bincount(row[covered], minlength=batch.num_rows)
            found = [
                _byte_spans(
                    covered[first[k] : first[k + 1]],
                    starts[first[k] : first[k + 1]] - offsets[k],
                    ends[first[k] : first[k + 1]] - offsets[k],
                )
                if hit[k]
                else []
                for k in range(batch.num_rows)
            ]
            yield _with_added(batch, names, first, hit, [sorted(x) for x in items], found)

    return documents.mapInArrow(scan, T.StructType([*documents.schema.fields, *_ADDED.fields]))


def _joined(documents: DataFrame, grams: DataFrame) -> DataFrame:
    """The same result for a set too large to broadcast: windows join n-grams by hash.

    Equal texts have equal hits, so texts are what is joined. Windows that a bitmap of
    the benchmark's hashes rules out are not shuffled. Items are looked up for the
    windows that were hit, once for each text, so a window of many items is never one row.
    """
    known = sieve_of(grams, "hash")
    lengths = [r["n"] for r in grams.select("n").distinct().collect()]  # at most the window
    names = documents.columns
    keyed = documents.withColumn("_text_key", F.sha2("text", 256))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in blocks(batches, limit=1 << 18):
            data, starts, ends, first, hashes, row = _tokens(data, offsets)
            for n in lengths:
                found, whole = _windows(hashes, row, n)
                at = np.flatnonzero(whole)
                at = at[passes(known.value, found[at])]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("_text_key").take(pa.array(row[at])),
                        pa.array(at - first[row[at]], pa.int64()),
                        pa.array(np.full(len(at), n), pa.int32()),
                        pa.array(found[at].view(np.int64)),
                        pa.array([_gram(data, starts, ends, i, n) for i in at], pa.string()),
                    ],
                    names=["_text_key", "at", "n", "hash", "gram"],
                )

    texts = keyed.where("text is not null").select("_text_key", "text").dropDuplicates(["_text_key"])
    windows = texts.mapInArrow(cut, "_text_key string, at long, n int, hash long, gram string")
    gram = ["n", "hash", "gram"]
    hits = windows.join(grams.select(*gram).distinct(), gram)
    hits = Scratch(documents.sparkSession, "decontamination").stored(hits, "hits")
    places = hits.groupBy("_text_key").agg(F.collect_set(F.struct("at", "n")).alias("_places"))
    items = (
        hits.select("_text_key", *gram)
        .distinct()
        .join(grams, gram)
        .groupBy("_text_key")
        .agg(F.collect_set("item").alias("_found"))
    )
    per_text = places.join(items, "_text_key")

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in blocks(batches):
            data, starts, ends, first, _, _ = _tokens(data, offsets)
            n_hit, found = [], []
            for k, places in enumerate(batch.column("_places").to_pylist()):
                low, high = first[k], first[k + 1]
                covered = _covered(high - low, [(p["at"], p["n"]) for p in places or []])
                n_hit.append(int(covered.sum()))
                found.append(
                    _byte_spans(covered, starts[low:high] - offsets[k], ends[low:high] - offsets[k])
                )
            items = [sorted(x or []) for x in batch.column("_found").to_pylist()]
            yield _with_added(batch, names, first, n_hit, items, found)

    return keyed.join(per_text, "_text_key", "left").mapInArrow(
        close, T.StructType([*documents.schema.fields, *_ADDED.fields])
    )


def find_leaks(
    documents: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Per row of ``documents (doc_id, text)``: words, hit words, items, hit byte spans."""
    found = _scanned(documents.select("doc_id", "text"), benchmark, window, broadcast_bytes)
    return found.select("doc_id", *[F.col(c).alias(c[1:]) for c in _ADDED.names])


def remove_documents(
    documents: DataFrame, benchmark: DataFrame, window: int = WINDOW
) -> DataFrame:
    """The rows of ``documents`` in which no benchmark window occurs, all columns kept."""
    found = _scanned(documents, benchmark, window, BROADCAST_BYTES)
    return found.where("_n_hit = 0").select(*documents.columns)


def remove_spans(
    documents: DataFrame, benchmark: DataFrame, by: str = " ", window: int = WINDOW
) -> DataFrame:
    """``documents`` with every hit span of the text replaced by ``by``."""
    found = _scanned(documents, benchmark, window, BROADCAST_BYTES)
    names = documents.columns
    place = names.index("text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, ranges in zip(
                batch.column("text").to_pylist(), batch.column("_hit_spans").to_pylist()
            ):
                if text is not None and ranges:
                    raw, parts, end = text.encode(), [], 0
                    for r in ranges:
                        parts += [raw[end : r["start"]], by.encode()]
                        end = r["end"]
                    text = b"".join([*parts, raw[end:]]).decode()
                out.append(text)
            columns = [batch.column(c) for c in names]
            columns[place] = pa.array(out, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return found.mapInArrow(cut, documents.schema)
