"""Near-duplicate detection with SetSketch registers.

A text's set of word shingles becomes ``REGISTERS`` registers. Register ``i``
holds ``floor(1 - log_b x)``, truncated to 16 bits, where ``x`` is the set's
smallest exponential variate under hash function ``i``: exponentially spaced
minima, which merge by taking the larger register and agree between two sets
with about the probability of their similarity.

1. Equal sets collapse to the document with the smallest id.
2. Bands of ``ROWS`` registers are bucket keys. Every bucket compares its members
   with its smallest id only, never with each other: a bucket of any size costs
   one pair a member.
3. A pair's similarity is estimated jointly from the two sketches and both set
   sizes by likelihood; pairs that cannot be similar enough go.
4. The best pair of each document is verified on the full sets, and components
   are built. What a bucket's members have not been compared with is then only
   of interest across components. Those members meet in blocks inside tasks,
   where pairs are array cells: estimated first, the open ones verified on the
   full sets. A block returns a forest over its components, never its pairs.

A pair at the threshold shares no bucket with a probability of 2.5e-7; every
link that is reported has been confirmed on the full sets of shingles. A shingle counts
as the 64 bits of a hash that is mixed after every eight bytes and every word: two given
shingles agree by chance with 5e-20, whatever their structure.

Defined cases: a null, empty or blank text has no shingles and is linked with
nothing; a text of fewer words than a shingle is one shingle; rows with equal ids
are one document, linked by any of its texts; rows without an id are linked with
nothing, have no component and are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.llm.blocks import ascii_lower, blocks, byte_set, mixed, row_of, runs_of, text_bytes, word_hashes, words
from wattline.llm.components import connected
from wattline.llm.tables import Scratch

#: Words in a shingle, and the least similarity of a link in percent.
SHINGLE = 5
PERCENT = 75

REGISTERS = 160
ROWS = 4
BASE = 1.001
RATE = 20.0
TOP = (1 << 16) - 2

#: Likelihood-ratio statistic beyond which a pair is given up: five standard deviations.
GIVE_UP = 25.0

#: Members of a bucket, and shingles of theirs, that make a block; two blocks meet in a task.
BLOCK = 1024
BLOCK_SHINGLES = 1_000_000

BLANKS = byte_set((0x20, 0x20), (0x09, 0x0D))

_LOWER = ascii_lower()
_MULTIPLIERS = np.random.default_rng(20240229).integers(0, 1 << 63, REGISTERS, np.uint64) * np.uint64(2) + np.uint64(1)
_SECOND = np.uint64(0xA24BAED4963EE407)


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all rows, sorted within each row, and each row's first one."""
    data = _LOWER[data]
    starts, ends, first = words(data, offsets, BLANKS)
    hashes, row, count = word_hashes(data, starts, ends), row_of(first), np.diff(first)
    at = np.arange(max(len(hashes) - SHINGLE + 1, 0))
    at = at[row[at] == row[at + SHINGLE - 1]]
    full, owner = runs_of(hashes, at, SHINGLE), row[at]
    parts, sizes = [], np.zeros(len(count), np.int64)
    low = np.searchsorted(owner, np.arange(len(count) + 1))
    alone: dict[int, np.ndarray] = {}
    for n in range(1, SHINGLE):
        short = np.flatnonzero(count == n)
        alone |= zip(short.tolist(), runs_of(hashes, first[short], n))
    for k in range(len(count)):
        own = np.unique(full[low[k] : low[k + 1]]) if k not in alone else alone[k].reshape(1)
        parts.append(own)
        sizes[k] = len(own)
    found = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    return found, np.concatenate(([0], np.cumsum(sizes)))


def registers(found: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One row of 16-bit registers for each set; an empty set has zeros."""
    out = np.zeros((len(first) - 1, REGISTERS), np.uint16)
    filled = first[:-1] < first[1:]
    if not filled.any():
        return out
    at, buffer = first[:-1][filled], np.empty_like(found)
    least = np.empty((len(at), REGISTERS))
    for k, multiplier in enumerate(_MULTIPLIERS):
        np.multiply(found, multiplier, out=buffer)
        least[:, k] = np.minimum.reduceat(buffer, at)
    smallest = -np.log1p(-(least + 0.5) / 2.0**64) / RATE
    out[filled] = np.clip(np.floor(1 - np.log(smallest) / np.log(BASE)), 0, TOP + 1)
    return out


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union of two sets."""
    return np.maximum(a, b)


def _shares(size_a, size_b):
    total = size_a + size_b
    return size_a / total, size_b / total


def likelihood(greater, smaller, size_a, size_b, similarity):
    """Joint log-likelihood of a similarity.

    ``greater`` and ``smaller`` count the registers in which the first sketch lies
    above or below the second; sizes are those of the sets.
    """
    u, v = _shares(size_a, size_b)

    def chance(x):
        x = np.clip(x, 1e-9, 1)
        return np.clip(-np.log1p(-x * (BASE - 1) / BASE) / np.log(BASE), 1e-12, 1)

    above, below = chance(u - v * similarity), chance(v - u * similarity)
    equal = np.clip(1 - above - below, 1e-12, 1)
    return greater * np.log(above) + smaller * np.log(below) + (REGISTERS - greater - smaller) * np.log(equal)


_GRID = np.linspace(0.0, 1.0, 101)


def estimate(greater, smaller, size_a, size_b) -> tuple[np.ndarray, np.ndarray]:
    """Per pair the likeliest similarity, and whether ``PERCENT`` cannot be ruled out."""
    size_a, size_b = np.asarray(size_a, float), np.asarray(size_b, float)
    most = np.minimum(size_a, size_b) / np.maximum(size_a, size_b)
    logs = likelihood(
        np.asarray(greater)[:, None], np.asarray(smaller)[:, None],
        size_a[:, None], size_b[:, None], np.minimum(_GRID[None, :], most[:, None]),
    )
    best = logs.argmax(axis=1)
    enough = logs[:, _GRID >= PERCENT / 100].max(axis=1)
    open_ = (2 * (logs.max(axis=1) - enough) <= GIVE_UP) & (100 * most >= PERCENT)
    return np.minimum(_GRID[best], most), open_


def sketches(documents: DataFrame) -> DataFrame:
    """``doc_id, n, key_a, key_b, registers`` per row; equal keys mean equal sets."""
    kind = documents.schema["doc_id"].dataType.simpleString()

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in blocks(batches):
            found, first = shingle_sets(data, offsets)
            sizes = np.diff(first)
            filled, keys = sizes > 0, np.zeros((2, len(sizes)), np.uint64)
            if filled.any():
                for k, values in enumerate((mixed(found), mixed(found ^ _SECOND))):
                    keys[k, filled] = np.add.reduceat(values, first[:-1][filled])
            packed = registers(found, first)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(sizes, pa.int64()),
                    pa.array(keys[0].view(np.int64)),
                    pa.array(keys[1].view(np.int64)),
                    pa.array([r.tobytes() for r in packed], pa.binary()),
                ],
                names=["doc_id", "n", "key_a", "key_b", "registers"],
            )

    return documents.select("doc_id", "text").mapInArrow(
        sketch, f"doc_id {kind}, n long, key_a long, key_b long, registers binary"
    )


def _registers_of(column: pa.Array) -> np.ndarray:
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, np.uint16).reshape(-1, REGISTERS)


def _bands(sets: DataFrame) -> DataFrame:
    """``key, band, id``: one row for each band of each set."""
    kind = sets.schema["id"].dataType.simpleString()
    count = REGISTERS // ROWS

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = _registers_of(batch.column("registers")).reshape(-1, count, ROWS).astype(np.uint64)
            key = np.zeros(own.shape[:2], np.uint64)
            for k in range(ROWS):
                key = (key << np.uint64(16)) | own[:, :, k]
            key = mixed(key ^ mixed(np.arange(1, count + 1, dtype=np.uint64))[None, :])
            rows = pa.array(np.repeat(np.arange(len(own)), count))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(key.ravel().view(np.int64)),
                    pa.array(np.tile(np.arange(count, dtype=np.int16), len(own))),
                    batch.column("id").take(rows),
                ],
                names=["key", "band", "id"],
            )

    return sets.select("id", "registers").mapInArrow(cut, f"key long, band short, id {kind}")


def _estimated(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``u, v, similarity`` of the pairs that may be similar enough, by their sketches."""
    kind = sets.schema["id"].dataType.simpleString()
    left = sets.select(F.col("id").alias("u"), F.col("n").alias("u_n"), F.col("registers").alias("u_r"))
    right = sets.select(F.col("id").alias("v"), F.col("n").alias("v_n"), F.col("registers").alias("v_r"))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = _registers_of(batch.column("u_r")), _registers_of(batch.column("v_r"))
            similarity, open_ = estimate(
                (a > b).sum(axis=1), (a < b).sum(axis=1),
                batch.column("u_n").to_numpy(), batch.column("v_n").to_numpy(),
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column("u"), batch.column("v"), pa.array(similarity)], names=["u", "v", "similarity"]
            ).filter(pa.array(open_))

    joined = pairs.join(left, "u").join(right, "v")
    sizes = F.least("u_n", "v_n") * 100 >= F.greatest("u_n", "v_n") * PERCENT
    return joined.where(sizes).mapInArrow(judge, f"u {kind}, v {kind}, similarity double")


def _first_band(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """First band in which sketch ``a`` agrees with each of ``b``; a band's registers are 64 bits."""
    return (a.view(np.uint64) == b.view(np.uint64)).argmax(axis=1)


def _forest(ids, component, n, own, found, first, left, right, band):
    """Links between components of one block or two, as few as join what is linked.

    ``left`` and ``right`` say which members are compared with which. A pair that
    meets in an earlier band is that band's business.
    """
    _, local = np.unique(found, return_inverse=True)
    group = np.unique(component, return_inverse=True)[1]
    mark = np.zeros(local.max(initial=-1) + 1, bool)
    pairs = []
    for k in np.flatnonzero(left):
        rest = np.flatnonzero(right & (group != group[k]))
        if left[rest].any() and right[k]:
            rest = rest[(rest > k) | ~left[rest]]
        if not len(rest):
            continue
        rest = rest[_first_band(own[k], own[rest]) == band]
        if not len(rest):
            continue
        _, open_ = estimate(
            (own[k] > own[rest]).sum(axis=1), (own[k] < own[rest]).sum(axis=1), np.full(len(rest), n[k]), n[rest]
        )
        rest = rest[open_]
        if not len(rest):
            continue
        mark[local[first[k] : first[k + 1]]] = True
        sizes = first[rest + 1] - first[rest]
        at = np.repeat(first[rest] - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes) + np.arange(sizes.sum())
        both = np.add.reduceat(mark[local[at]].astype(np.int64), np.concatenate(([0], np.cumsum(sizes)[:-1])))
        mark[local[first[k] : first[k + 1]]] = False
        linked = rest[100 * both >= PERCENT * (first[k + 1] - first[k] + sizes - both)]
        joined, one = np.unique(group[linked], return_index=True)
        for other in linked[one]:
            pairs.append((min(ids[k], ids[other]), max(ids[k], ids[other])))
        if len(joined):
            group[np.isin(group, joined)] = group[k]
    return pairs


def _across(members: DataFrame, sets: DataFrame, texts: DataFrame, scratch: Scratch) -> DataFrame:
    """Verified links ``u, v`` inside a bucket but across components.

    ``members`` has ``key, band, id, component``. Of a bucket that one block cannot hold,
    the members of its largest component are linked among themselves already, so they
    only meet the others: both are dealt into blocks by a hash, and every block of others
    meets every block. A group of near copies with few others costs in proportion.
    """
    kind = sets.schema["id"].dataType.simpleString()
    parts = members.groupBy("key", "component").agg(F.count("*").alias("size"))
    mixed_up = (
        parts.groupBy("key")
        .agg(F.count("*").alias("parts"), F.max_by("component", F.struct("size", "component")).alias("main"))
        .where("parts > 1")
        .select("key", "main")
    )
    rows = scratch.stored(members.join(mixed_up, "key").join(sets.select("id", "n"), "id"), "crossing")

    def fill(among: Column) -> Column:
        size = F.greatest(F.count_if(among) / BLOCK, F.sum(F.when(among, F.col("n"))) / BLOCK_SHINGLES)
        return F.ceil(size).cast("int")

    is_main = F.col("component") == F.col("main")
    weight = rows.groupBy("key").agg(
        fill(F.lit(True)).alias("n_all"), fill(~is_main).alias("n_others"), fill(is_main).alias("n_main")
    )
    one_block = F.col("n_all") <= 1
    others = F.when(one_block, 1).otherwise(F.col("n_others"))
    held = is_main & ~one_block
    dealt = F.pmod(F.xxhash64("id"), F.when(held, F.col("n_main")).otherwise(others)).cast("int")
    last = others - 1 + F.when(held | one_block, 0).otherwise(F.col("n_main"))
    met = rows.join(weight, "key").withColumn("block", dealt + F.when(held, others).otherwise(0)).withColumn(
        "other", F.explode(F.sequence(F.lit(0), last))
    )
    met = met.join(sets.select("id", "registers"), "id")
    met = met.join(texts.select(F.col("doc_id").alias("id"), "text"), "id").select(
        "key", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"),
        "block", "band", "id", "component", "n", "registers", "text",
    )

    def join_up(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        values = {c: group.column(c).to_numpy() for c in ("id", "component", "n", "block", "one", "two", "band")}
        found, first = shingle_sets(*text_bytes(group.column("text").combine_chunks()))
        left, right = values["block"] == values["one"], values["block"] == values["two"]
        own = _registers_of(group.column("registers"))
        pairs = _forest(
            values["id"], values["component"], values["n"], own, found, first, left, right, values["band"][0]
        )
        u, v = zip(*pairs) if pairs else ((), ())
        return pa.table({"u": np.array(u, values["id"].dtype), "v": np.array(v, values["id"].dtype)})

    return met.groupBy("key", "one", "two").applyInArrow(join_up, f"u {kind}, v {kind}")


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs ``u, v`` whose full sets are similar enough."""
    kind = texts.schema["doc_id"].dataType.simpleString()
    far = texts.select(F.col("doc_id").alias("v"), F.col("text").alias("v_text"))
    near = texts.select(F.col("doc_id").alias("u"), F.col("text").alias("u_text"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, kept = None, None  # neighbouring rows often share the first text
        for whole in batches:
            for batch, data, offsets in blocks([whole], "v_text"):
                found, first = shingle_sets(data, offsets)
                linked = np.zeros(batch.num_rows, bool)
                near_texts = batch.column("u_text")
                for k in range(batch.num_rows):
                    text = near_texts[k].as_py()
                    if text != last:
                        last, kept = text, shingle_sets(*text_bytes(pa.array([text])))[0]
                    own = found[first[k] : first[k + 1]]
                    both = len(np.intersect1d(kept, own, assume_unique=True))
                    linked[k] = both > 0 and 100 * both >= PERCENT * (len(kept) + len(own) - both)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("u"), batch.column("v")], names=["u", "v"]
                ).filter(pa.array(linked))

    return pairs.join(far, "v").join(near, "u").mapInArrow(compare, f"u {kind}, v {kind}")


def find_groups(documents: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``documents (doc_id, text)``."""
    scratch = Scratch(documents.sparkSession, "near-dedup")
    rows = scratch.stored(sketches(documents), "rows")
    linkable = rows.where("n > 0 and doc_id is not null")
    sets = scratch.stored(
        linkable.groupBy("key_a", "key_b", "n")
        .agg(F.min(F.struct("doc_id", "registers")).alias("own"))
        .select("key_a", "key_b", "n", F.col("own.doc_id").alias("id"), "own.registers"),
        "sets",
    )
    copies = (
        linkable.join(sets.select("key_a", "key_b", "n", "id"), ["key_a", "key_b", "n"])
        .where("doc_id <> id")
        .select(F.col("doc_id").alias("u"), F.col("id").alias("v"))
    )

    bands = _bands(sets)
    buckets = bands.groupBy("key").agg(F.min("id").alias("center"), F.count("*").alias("size"))
    members = bands.join(buckets.where("size > 1"), "key").select("key", "band", "id", "center", "size")
    members = scratch.stored(members, "members")
    stars = members.where("id <> center").select(F.col("center").alias("u"), F.col("id").alias("v")).distinct()
    candidates = scratch.stored(_estimated(stars, sets), "candidates")

    # The only texts that can be needed from here on, moved once.
    wanted = members.select(F.col("id").alias("doc_id")).distinct()
    texts = scratch.stored(documents.select("doc_id", "text").join(wanted, "doc_id", "left_semi"), "texts")

    best = candidates.groupBy("v").agg(F.max_by("u", F.struct("similarity", -F.col("u"))).alias("u"))
    tried = scratch.stored(best.select("u", "v"), "tried")
    links = scratch.stored(_verified(tried, texts), "links")
    component = connected(links)

    def placed(frame: DataFrame, column: str, name: str) -> DataFrame:
        own = component.select(F.col("node").alias(column), F.col("component").alias(f"_{name}"))
        return frame.join(own, column, "left").withColumn(name, F.coalesce(f"_{name}", column)).drop(f"_{name}")

    # Two members are a pair, already estimated; more meet in blocks.
    twos = members.where("size = 2 and id <> center").select(F.col("center").alias("u"), F.col("id").alias("v"))
    apart = placed(placed(candidates, "u", "cu"), "v", "cv").where("cu <> cv").select("u", "v")
    rest = apart.join(twos.distinct(), ["u", "v"], "left_semi").join(tried, ["u", "v"], "left_anti")
    rest = scratch.stored(_verified(rest, texts), "rest")
    scratch.drop("candidates", "tried")
    several = members.where("size > 2").select("key", "band", "id")
    crossing = scratch.stored(_across(placed(several, "id", "component"), sets, texts, scratch), "across")
    scratch.drop("members", "texts", "crossing")

    final = connected(links.unionByName(rest).unionByName(crossing).unionByName(copies))
    out = scratch.stored(
        rows.select("doc_id", "n").join(final, F.col("doc_id") == final["node"], "left").select(
            "doc_id",
            F.col("n").alias("n_shingles"),
            F.coalesce("component", "doc_id").alias("component_id"),
        ),
        "groups",
    )
    scratch.drop("rows", "sets", "links", "rest", "across")
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_first(documents: DataFrame) -> DataFrame:
    """The rows of ``documents`` that are the first of their group, all columns kept."""
    dropped = find_groups(documents).where("not kept").select("doc_id").distinct()
    return documents.join(dropped, "doc_id", "left_anti").select(*documents.columns)
