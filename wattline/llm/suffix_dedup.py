"""Removal of repeated byte strings by a distributed difference cover.

A byte goes if a string of ``LENGTH`` bytes covers it that also starts anywhere
else. Sorting every suffix of a corpus is out of reach, so a sample of positions
is sorted and everything else follows from it, as in a difference-cover suffix
array:

0. Texts that occur more than once go whole; one of each stays in the search.
1. *Sample.* A position is sampled if its gram has the smallest hash among the
   ``SPAN`` grams of some window. Two equal strings have their first window's
   sample at the same offset: the cover property, here from the content, with
   about three positions in two hundred instead of two in three.
2. *Sampled triples.* Each sampled suffix is named by three consecutive blocks,
   which every string it stands for contains. A name that occurs once stands for
   strings that occur once, and is dropped.
3. *Recurse on names.* Suffixes of one name are named again by the triple of what
   lies left, the name, and what lies right, up to the full length of all the
   strings they stand for. Where two suffixes have equal names, every string they
   stand for is repeated: that settles the inside of copies.
4. *Merge the remaining suffixes.* Where one first name has several second names,
   an edge of a copy is near. One suffix of each second name contributes all its
   strings, and strings that meet an equal one are the repeats.
5. The bytes covered by repeated strings are removed from each row.

Only equality of prefixes matters for the result, so "sorting" is grouping by
names; each later name is compared within an earlier one only. What is taken as
equal agrees in a 64-bit name and in 32 bits of a hash of another kind. Groups of
any size are counted with partial sums and joined back, never gathered.

Defined cases: a null text is empty; texts shorter than ``LENGTH`` lose nothing;
repeated rows are copies of each other; rows without an id are documents too.
What is left may be invalid UTF-8, therefore it is returned as binary.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline.llm.blocks import blocks, mixed, prefixes, rolling, spans
from wattline.llm.sieve import passes, sieve_of, sifted
from wattline.llm.tables import Scratch

#: Length of the strings that must not repeat.
LENGTH = 200

#: Grams in a sampling window, and bytes in a gram.
SPAN = 128
GRAM = 16

#: Bytes of text that a task works on at a time; every byte takes about a hundred.
BLOCK_BYTES = 1 << 19

#: Bytes right of a sampled position that every string it stands for contains.
COMMON = LENGTH - SPAN + 1


def _window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, by block prefixes and suffixes."""
    count = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    parts = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(parts, axis=1).ravel()
    back = np.minimum.accumulate(parts[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:count], ahead[width - 1 : width - 1 + count])


def sampled(data: np.ndarray, offsets: np.ndarray):
    """Sampled suffixes of all rows: ``row, at, low, high`` and the running sums.

    Suffix ``at`` stands for the strings that start at ``low`` to ``high``, all
    positions in the block. Every string of every row belongs to exactly one.
    """
    running = prefixes(data)
    none = np.zeros(0, np.int64)
    if len(data) < LENGTH:
        return none, none, none, none, running
    keyed = rolling(running, GRAM)
    bits = np.uint64(max(len(data), 2).bit_length())
    # The place sits in the low bits, reversed, so that of equal grams the last is taken.
    top = np.uint64((1 << int(bits)) - 1)
    keyed &= ~top
    keyed |= np.arange(int(top), int(top) - len(keyed), -1).astype(np.uint64)
    at = _window_minima(keyed, SPAN)
    del keyed
    at = (top - (at & top)).astype(np.int64)

    strings = np.diff(offsets) - LENGTH + 1
    rows = np.flatnonzero(strings > 0)
    count = strings[rows]
    row = np.repeat(rows, count)
    begin = np.repeat(offsets[:-1][rows] - np.concatenate(([0], np.cumsum(count)[:-1])), count)
    string = begin + np.arange(len(row))
    at = at[string]
    fresh = np.ones(len(row), bool)
    fresh[1:] = (at[1:] != at[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(fresh)
    last = np.concatenate((first[1:], [len(row)])) - 1 if len(first) else first
    return row[first], at[first], string[first], string[last], running


def _names(running, at, low, high) -> tuple[np.ndarray, np.ndarray]:
    """First name: the triple of blocks right of the sample. Second: all that it stands for."""
    edges = [at, at + COMMON // 3, at + 2 * COMMON // 3, at + COMMON]
    first = spans(running, edges[0], edges[1])
    for a, b in zip(edges[1:], edges[2:]):
        first = mixed(first * np.uint64(0x9E3779B97F4A7C15) + spans(running, a, b))
    left, right = spans(running, low, at), spans(running, at + COMMON, high + LENGTH)
    shape = ((at - low) * (SPAN + 1) + (high - low)).astype(np.uint64)
    return first, mixed(mixed(left + shape) * np.uint64(0x9E3779B97F4A7C15) + right)


def _grams(data: np.ndarray) -> np.ndarray:
    """Running sums over mixed grams of eight bytes, for ``_mark``.

    Mixing the grams first leaves no structure that the sums over bytes share.
    """
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    return prefixes(mixed(np.ndarray((len(data),), "<u8", padded, strides=(1,))))


def _mark(grams: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """32 bits of each span ``[start, end)`` of eight bytes or more."""
    return (spans(grams, starts, ends - 7) >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _shortened(names: np.ndarray, bits: int) -> np.ndarray:
    return names & np.uint64((1 << bits) - 1)


def _keyed(documents: DataFrame) -> DataFrame:
    """Rows ``id, text_key, text, row_key``; equal rows have equal keys."""
    return documents.select(
        F.col("doc_id").alias("id"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).withColumn("row_key", _row_key())


def _row_key() -> Column:
    return F.xxhash64("id", "text_key")


def _searched(batches: Iterator[pa.RecordBatch], firsts) -> Iterator[pa.RecordBatch]:
    """The rows that stand for their text; a sieve may let another copy pass, which does no harm."""
    for batch in batches:
        keys = batch.column("row_key").to_numpy(zero_copy_only=False)
        yield batch.filter(pa.array(passes(firsts.value, keys)))


def _first_names(rows: DataFrame, firsts, bits: int) -> DataFrame:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, data, offsets in blocks(_searched(batches, firsts), limit=BLOCK_BYTES):
            _, at, low, high, running = sampled(data, offsets)
            names, _ = _names(running, at, low, high)
            # Counted within the block already, so a frequent passage sends little.
            own, n = np.unique(_shortened(names, bits), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(own.view(np.int64)), pa.array(n)], names=["name", "n"])

    return rows.select("text", "row_key").mapInArrow(cut, "name long, n long")


def _schema(id_type, longs: list[str], integers: list[str]) -> T.StructType:
    return T.StructType(
        [T.StructField("id", id_type)]
        + [T.StructField(c, T.LongType()) for c in longs]
        + [T.StructField(c, T.IntegerType()) for c in integers]
    )


def _suffixes(rows: DataFrame, firsts, sieve, bits: int) -> DataFrame:
    """``id, text_key, name, second, mark, low, high`` of sampled suffixes that may repeat."""
    schema = _schema(rows.schema["id"].dataType, ["text_key", "name", "second"], ["mark", "low", "high"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in blocks(_searched(batches, firsts), limit=BLOCK_BYTES):
            row, at, low, high, running = sampled(data, offsets)
            first, second = (_shortened(names, bits) for names in _names(running, at, low, high))
            kept = passes(sieve.value, first)
            row, low, high = row[kept], low[kept], high[kept]
            owner = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(owner),
                    batch.column("text_key").take(owner),
                    pa.array(first[kept].view(np.int64)),
                    pa.array(second[kept].view(np.int64)),
                    pa.array(_mark(_grams(data), low, high + LENGTH)),
                    pa.array(low - offsets[row], pa.int32()),
                    pa.array(high - offsets[row], pa.int32()),
                ],
                names=schema.names,
            )

    return rows.select("id", "text_key", "text", "row_key").mapInArrow(cut, schema)


def _strings_of(batch: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray, bits: int):
    """Row, start, name and mark of every string of the listed suffixes."""
    wanted = batch.column("wanted")
    sizes = np.diff(np.asarray(wanted.offsets))
    each = wanted.flatten()
    low, high = each.field("low").to_numpy(), each.field("high").to_numpy()
    row = np.repeat(np.repeat(np.arange(batch.num_rows), sizes), high - low + 1)
    begin = np.concatenate(([0], np.cumsum(high - low + 1)))
    start = np.arange(begin[-1]) - np.repeat(begin[:-1] - low, high - low + 1)
    at = offsets[row] + start
    names = _shortened(spans(prefixes(data), at, at + LENGTH), bits)
    return row, start, names, _mark(_grams(data), at, at + LENGTH)


def _string_counts(texts: DataFrame, bits: int) -> DataFrame:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in blocks(batches, limit=BLOCK_BYTES):
            _, _, own, mark = _strings_of(batch, data, offsets, bits)
            order = np.argsort(own)
            own, mark = own[order], mark[order]
            fresh = np.ones(len(own), bool)
            fresh[1:] = (own[1:] != own[:-1]) | (mark[1:] != mark[:-1])
            at = np.flatnonzero(fresh)
            yield pa.RecordBatch.from_arrays(
                [pa.array(own[at].view(np.int64)), pa.array(mark[at]), pa.array(np.diff(at, append=len(own)))],
                names=["string", "mark", "n"],
            )

    return texts.mapInArrow(cut, "string long, mark int, n long")


def _strings(texts: DataFrame, sieve, bits: int) -> DataFrame:
    """``id, text_key, string, mark, start`` of the strings that may repeat."""
    schema = _schema(texts.schema["id"].dataType, ["text_key", "string"], ["mark", "start"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in blocks(batches, limit=BLOCK_BYTES):
            row, start, string, mark = _strings_of(batch, data, offsets, bits)
            kept = passes(sieve.value, string)
            owner = pa.array(row[kept])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(owner),
                    batch.column("text_key").take(owner),
                    pa.array(string[kept].view(np.int64)),
                    pa.array(mark[kept]),
                    pa.array(start[kept], pa.int32()),
                ],
                names=schema.names,
            )

    return texts.mapInArrow(cut, schema)


def _same_row(a: DataFrame, b: DataFrame) -> Column:
    return a["text_key"].eqNullSafe(b["_key"]) & a["id"].eqNullSafe(b["_id"])


def _per_row(frame: DataFrame, name: str, *columns: str) -> DataFrame:
    """One row per document row with a list; a list is never longer than the text."""
    return frame.groupBy(F.col("id").alias("_id"), F.col("text_key").alias("_key")).agg(
        F.collect_list(F.struct(*columns)).alias(name)
    )


def _holding(rows: DataFrame, lists: DataFrame) -> DataFrame:
    """The document rows that have a list, with it."""
    near = sifted(rows.drop("row_key"), "text_key", sieve_of(lists, "_key"))
    return near.join(lists, _same_row(near, lists)).drop("_id", "_key")


def _hashed(keys: DataFrame) -> DataFrame:
    """Each key once: a partition of them fits a hash table, so nothing need be sorted."""
    return keys.hint("shuffle_hash")


def _repeated_ranges(rows: DataFrame, firsts, scratch: Scratch, bits: int) -> DataFrame:
    """``_id, _key, ranges`` of the rows with repeated strings: their starts, as ranges."""
    counted = _first_names(rows, firsts, bits).groupBy("name").agg(F.sum("n").alias("n"))
    twice = scratch.stored(counted.where("n > 1").select("name"), "names")
    suffixes = scratch.stored(
        _suffixes(rows, firsts, sieve_of(twice, "name"), bits).join(_hashed(twice), "name", "left_semi"),
        "suffixes",
    )
    # Nulls count for first(), so the four values come from one suffix, whichever.
    classes = scratch.stored(
        suffixes.groupBy("name", "second", "mark").agg(
            F.count("*").alias("n"), *[F.first(c).alias(c) for c in ("id", "text_key", "low", "high")]
        ),
        "classes",
    )
    again = classes.where("n > 1").select("name", "second", "mark")
    inside = (
        sifted(suffixes, "second", sieve_of(again, "second"))
        .join(_hashed(again), ["name", "second", "mark"], "left_semi")
        .select("id", "text_key", "low", "high")
    )

    kinds = classes.groupBy("name").agg(F.count("*").alias("kinds"))
    edges = scratch.stored(kinds.where("kinds > 1").select("name"), "edges")
    open_ = sifted(classes.drop("second", "mark", "n"), "name", sieve_of(edges, "name"))
    open_ = open_.join(_hashed(edges), "name", "left_semi").drop("name")
    wanted = scratch.stored(_per_row(open_, "wanted", "low", "high"), "wanted")
    texts = scratch.stored(_holding(rows, wanted), "texts")
    repeated = _string_counts(texts, bits).groupBy("string", "mark").agg(F.sum("n").alias("n"))
    repeated = scratch.stored(repeated.where("n > 1").select("string", "mark"), "strings")
    edge = (
        _strings(texts, sieve_of(repeated, "string"), bits)
        .join(_hashed(repeated), ["string", "mark"], "left_semi")
        .select("id", "text_key", F.col("start").alias("low"), F.col("start").alias("high"))
    )
    return _per_row(inside.unionByName(edge), "ranges", "low", "high")


def _covered(size: int, ranges: pa.StructArray) -> np.ndarray:
    steps = np.zeros(size + 1, np.int64)
    low, high = ranges.field("low").to_numpy(), ranges.field("high").to_numpy()
    np.add.at(steps, low, 1)
    np.add.at(steps, high + LENGTH, -1)
    return np.cumsum(steps[:-1]) > 0


def _cut(texts: DataFrame, with_text: bool) -> DataFrame:
    """Rows ``id, text_key`` and what removing the listed ranges leaves."""
    schema = T.StructType(
        [texts.schema["id"], texts.schema["text_key"]]
        + [T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans")]
        + [T.StructField("kept_sha256", T.StringType())]
        + [T.StructField("kept", T.BinaryType())] * with_text
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in blocks(batches, limit=BLOCK_BYTES):
            removed, runs, digests, left = [], [], [], []
            for k, ranges in enumerate(batch.column("ranges")):
                own = data[offsets[k] : offsets[k + 1]]
                gone = _covered(len(own), ranges.values)
                kept = own[~gone].tobytes()
                removed.append(int(gone.sum()))
                runs.append(int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum()))
                digests.append(hashlib.sha256(kept).hexdigest())
                left.append(kept if with_text else b"")
            columns = [
                batch.column("id"),
                batch.column("text_key"),
                pa.array(np.diff(offsets), pa.int64()),
                pa.array(removed, pa.int64()),
                pa.array(runs, pa.int64()),
                pa.array(digests, pa.string()),
            ]
            if with_text:
                columns.append(pa.array(left, pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return texts.mapInArrow(cut, schema)


_RESULT = ("n_bytes", "n_removed", "n_spans", "kept_sha256")


def remove_repeats(documents: DataFrame, with_text: bool = False, name_bits: int = 64) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` per row of ``documents (doc_id, text)``.

    With ``with_text``, ``kept`` holds the bytes that are left. Names of fewer than 64 bits
    collide more often, which costs time; the mark beside them still tells strings apart.
    """
    scratch = Scratch(documents.sparkSession, "suffix-dedup")
    rows = _keyed(documents)
    whole = rows.select(
        "id", "text_key", F.xxhash64("text", F.lit(1)).alias("other_key"),
        F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha"),
    )
    whole = scratch.stored(whole, "whole")
    texts = ["text_key", "other_key", "n_bytes"]
    groups = scratch.stored(
        whole.groupBy(*texts).agg(F.count("*").alias("copies"), F.min("id").alias("first")), "groups"
    )
    firsts = groups.select(F.col("first").alias("id"), "text_key").select(_row_key().alias("row_key"))

    copied = groups.where("copies > 1").select(*texts)
    long_ = F.col("n_bytes") >= LENGTH
    zero = F.lit(0).cast("long")
    gone = whole.join(copied, texts).select(
        "id", "text_key", "n_bytes",
        F.when(long_, F.col("n_bytes")).otherwise(zero).alias("n_removed"),
        F.when(long_, F.lit(1)).otherwise(zero).cast("long").alias("n_spans"),
        F.when(long_, F.sha2(F.lit(""), 256)).otherwise(F.col("sha")).alias("kept_sha256"),
    )
    single = whole.join(copied, texts, "left_anti")

    ranges = _repeated_ranges(rows, sieve_of(firsts, "row_key"), scratch, name_bits)
    of_single = single.select(F.col("id").alias("_i"), F.col("text_key").alias("_k"))
    lists = scratch.stored(
        ranges.join(
            of_single,
            ranges["_key"].eqNullSafe(of_single["_k"]) & ranges["_id"].eqNullSafe(of_single["_i"]),
            "left_semi",
        ),
        "ranges",
    )
    scratch.drop("names", "suffixes", "classes", "edges", "wanted", "texts", "strings")
    changed = _cut(_holding(rows, lists), with_text)
    same = single.join(lists, _same_row(single, lists), "left_anti").select(
        "id", "text_key", "n_bytes", zero.alias("n_removed"), zero.alias("n_spans"), F.col("sha").alias("kept_sha256")
    )
    if with_text:
        own = rows.select(F.col("id").alias("_id"), F.col("text_key").alias("_key"), F.encode("text", "UTF-8").alias("_raw"))
        own = own.dropDuplicates(["_id", "_key"])
        same = same.join(own, _same_row(same, own)).select(*same.columns, F.col("_raw").alias("kept"))
        gone = gone.join(own, _same_row(gone, own)).select(
            *gone.columns, F.when(F.col("n_removed") == 0, F.col("_raw")).otherwise(F.lit(b"")).alias("kept")
        )
    out = same.unionByName(gone).unionByName(changed)
    return out.select(F.col("id").alias("doc_id"), *_RESULT, *["kept"] * with_text)
