"""Spelling variants of the words of a corpus, found in a trie of letter-group counts.

The letters are dealt into ``GROUPS`` groups. A word's counts per group, one group a
level, are its path in a trie. Inserting or deleting a letter moves one count by one,
replacing it moves at most one up and one down. So all words within one edit lie where
a depth-first search comes that starts from the word's own counts and may spend a
surplus and a deficit of one each. Words at the leaves it reaches are verified.

Each pair is searched once: from the longer word, from the one whose counts come first,
or, where counts are equal, from the smaller one. So a surplus is spent before a
deficit, and one that is not made up for leads nowhere.

The trie is cut into shards at every fourth level: a node of up to ``SHARD`` words is a
shard, a larger one is cut further down. Searches walk the levels above the cut as rows,
keeping only nodes that exist; the rest of the walk happens in a task that holds one
shard and up to ``PROBES`` searches. A leaf that alone is larger than a shard is
joined by the words with one letter left out, which leaves groups of the alphabet's size.

A form chain grows tenfold with each step, so the roots take a few joins.

Defined cases: null, empty and letterless texts have no words; a null id counts as an
empty one where the damage is drawn; repeated rows count again; near words of equal
count are taken in code-point order; an empty table gives an empty result; a very
long run is a word like any other; other columns are not read.
"""

from __future__ import annotations

import math
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.llm.tables import Scratch

LETTERS = "[A-Za-zÀ-ÿ]+"

#: One run in so many loses a letter.
DAMAGE = 31

#: Least letters and occurrences of a word, and how much more frequent a form is.
LEAST_LETTERS = 7
LEAST_COUNT = 2
FORM_TIMES = 10

#: Letters in the order of the levels they head, frequent ones first, so that upper levels tell
#: words apart. The rest of the alphabet joins these groups by code point.
LEVELS = "etaoinsrhldcumfpgwybvkxj"

#: Letter groups, levels between cuts, most words of a shard and most searches in a task with it.
GROUPS = len(LEVELS)
CUT = 4
SHARD = 4096
PROBES = 1 << 16

#: States of a walk that are expanded together, and letters compared at a time.
STATES = 1 << 16
CELLS = 1 << 22

#: What a walk has spent: nothing, a surplus, a deficit, a surplus and then a deficit.
FRESH, OWING, SHORTER, BALANCED = range(4)


def counted_words(documents: DataFrame) -> DataFrame:
    """``word, n`` of the damaged words of ``documents (doc_id, text)`` that are long and frequent enough."""
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    runs = documents.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(lowered, F.lit(f"({LETTERS})"), F.lit(1))).alias("run"),
    ).where(F.length("run") >= LEAST_LETTERS)
    draw = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    at = (F.col("draw") % F.length("run")).cast("int")
    short = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    word = F.when(F.col("draw") % DAMAGE == 0, short).otherwise(F.col("run"))
    return (
        runs.withColumn("draw", draw)
        .select(word.alias("word"))
        .where(F.length("word") >= LEAST_LETTERS)
        .groupBy("word")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") >= LEAST_COUNT)
    )


_GROUP_OF = np.arange(256, dtype=np.int64) % GROUPS
_GROUP_OF[[ord(c) for c in LEVELS]] = np.arange(GROUPS)


def letters_of(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words together, and the offset of each word."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32), np.concatenate(([0], np.cumsum(sizes)))


def group_counts(words: list[str]) -> np.ndarray:
    """One row of letter-group counts per word."""
    codes, offsets = letters_of(words)
    cell = np.repeat(np.arange(len(words)) * GROUPS, np.diff(offsets)) + _GROUP_OF[codes]
    return np.bincount(cell, minlength=len(words) * GROUPS).reshape(-1, GROUPS).astype(np.int32)


def _packed(counts: np.ndarray) -> pa.Array:
    """Rows of counts as binary values; equal beginnings are equal prefixes."""
    counts = np.ascontiguousarray(counts, np.int32)
    width = counts.shape[1] * 4
    ends = pa.array(np.arange(len(counts) + 1) * width, pa.int32())
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, ends.buffers()[1], pa.py_buffer(counts.tobytes())])


def _counts(column: pa.Array) -> np.ndarray:
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), np.int32).reshape(len(values), -1)


def with_counts(words: DataFrame) -> DataFrame:
    """Add the letter-group ``counts`` to ``words (word, n)``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.append_column("counts", _packed(group_counts(batch.column("word").to_pylist())))

    return words.select("word", "n").mapInArrow(count, "word string, n long, counts binary")


def _spent(own: np.ndarray, state: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Ways on from a node: which walks take each, the counts they go to, and their states then."""

    def way(takes: np.ndarray, by: int, after: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at = np.flatnonzero(takes)
        return at, own[at] + by, np.full(len(at), after, state.dtype)

    fresh, owing = state == FRESH, state == OWING
    return [
        (np.arange(len(own)), own, state),
        way(fresh, 1, OWING),
        way(fresh & (own > 0), -1, SHORTER),
        way(owing & (own > 0), -1, BALANCED),
    ]


def _descended(walks: DataFrame, depth: int) -> DataFrame:
    """``word, n, state, node``: the walks of that shape carried on to ``depth``."""

    def descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for low in range(0, whole.num_rows, STATES // 16):
                batch = whole.slice(low, STATES // 16)
                own, node = group_counts(batch.column("word").to_pylist()), _counts(batch.column("node"))
                at, state = np.arange(len(own)), batch.column("state").to_numpy()
                for level in range(depth - CUT, depth):
                    ways = _spent(own[at, level], state)
                    step, taken, state = (np.concatenate(part) for part in zip(*ways))
                    at, node = at[step], np.column_stack((node[step], taken)).astype(np.int32)
                rows = pa.array(at)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).take(rows) for c in ("word", "n")), pa.array(state, pa.int32()), _packed(node)],
                    names=["word", "n", "state", "node"],
                )

    return walks.mapInArrow(descend, "word string, n long, state int, node binary")


class Shard:
    """The part of the trie below one node, searched depth first.

    ``counts`` has a row of the remaining levels for each word; ``place`` lists the
    words in the order of the leaves.
    """

    def __init__(self, counts: np.ndarray):
        self.place = np.lexsort(counts.T[::-1]) if counts.shape[1] else np.arange(len(counts))
        counts = counts[self.place]
        node, self.levels = np.zeros(len(counts), np.int64), []
        for column in counts.T:
            key, node = np.unique(node << 32 | column, return_inverse=True)
            self.levels.append(key)
        self.first = np.searchsorted(node, np.arange(int(node[-1]) + 2))

    def reached(self, own: np.ndarray, state: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Pieces of ``walk, place, state``: words at the leaves that the walks come to."""
        stack = [(0, np.arange(len(own)), np.zeros(len(own), np.int64), state)]
        while stack:
            level, walk, node, state = stack.pop()
            if len(walk) > STATES:
                half = len(walk) // 2
                stack += [(level, walk[s], node[s], state[s]) for s in (slice(half, None), slice(half))]
                continue
            if level == len(self.levels):
                done = state != OWING
                walk, node, state = walk[done], node[done], state[done]
                sizes = self.first[node + 1] - self.first[node]
                for low, high in _pieces(sizes):
                    n = sizes[low:high]
                    inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                    yield np.repeat(walk[low:high], n), np.repeat(self.first[node[low:high]], n) + inner, np.repeat(state[low:high], n)
                continue
            keys, ways = self.levels[level], _spent(own[walk, level], state)
            step, taken, after = (np.concatenate(part) for part in zip(*ways))
            wanted = node[step] << 32 | taken
            child = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            there = keys[child] == wanted
            if there.any():
                stack.append((level + 1, walk[step[there]], child[there], after[there]))


def _pieces(sizes: np.ndarray, most: int = STATES) -> Iterator[tuple[int, int]]:
    """Stretches of ``sizes`` that add up to about ``most`` at most."""
    ends, low = np.cumsum(sizes), 0
    while low < len(sizes):
        before = ends[low - 1] if low else 0
        high = max(int(np.searchsorted(ends, before + most, "right")), low + 1)
        yield low, high
        low = high


def one_edit(left, right, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether ``left[a]`` becomes ``right[b]``, as long or one letter shorter, by one edit.

    ``left`` and ``right`` are words as ``letters_of`` gives them.
    """
    near = np.zeros(len(a), bool)
    (one, one_at), (two, two_at) = left, right
    long_, short = np.diff(one_at)[a], np.diff(two_at)[b]
    order = np.argsort(long_, kind="stable")
    for low, high in _pieces(long_[order], CELLS // 16):
        k = order[low:high]
        width = np.arange(long_[k].max())
        inside, within = width < long_[k][:, None], width < short[k][:, None]
        x = np.where(inside, one[np.minimum(one_at[a[k]][:, None] + width, len(one) - 1)], 0)
        y = np.where(within, two[np.minimum(two_at[b[k]][:, None] + width, len(two) - 1)], 0)
        differs = x != y
        same = long_[k] == short[k]
        # One letter shorter: behind the first difference, everything has moved by one.
        split = differs.argmax(axis=1)
        moved = np.zeros_like(differs)
        moved[:, 1:] = x[:, 1:] != y[:, :-1]
        rest = (moved & (width > split[:, None])).any(axis=1)
        near[k] = np.where(same, differs.sum(axis=1) == 1, (long_[k] == short[k] + 1) & ~rest)
    return near


def _searched(rows: DataFrame) -> DataFrame:
    """``a, a_n, b, b_n``: near words among ``rows (node, part, word, n, state)``; own words have no state."""

    def search(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        owns = table.filter(pa.compute.is_null(table.column("state")))
        walks = table.filter(pa.compute.is_valid(table.column("state")))
        found = []
        if owns.num_rows and walks.num_rows:
            depth = len(table.column("node")[0].as_py()) // 4
            left, right = walks.column("word").to_pylist(), owns.column("word").to_pylist()
            shard = Shard(group_counts(right)[:, depth:])
            spent = walks.column("state").to_numpy()
            # A walk that has spent nothing is among the shard's own words; it takes the greater ones.
            rank = {word: k for k, word in enumerate(sorted(right))}
            above = np.fromiter((-1 if s else rank[w] for w, s in zip(left, spent)), np.int64, len(left))
            ranks = np.fromiter((rank[w] for w in right), np.int64, len(right))
            own, left, right = group_counts(left)[:, depth:], letters_of(left), letters_of(right)
            for walk, leaf, state in shard.reached(own, spent):
                word = shard.place[leaf]
                once = (state != FRESH) | (above[walk] < ranks[word])
                walk, word = walk[once], word[once]
                near = one_edit(left, right, walk, word)
                found.append((walk[near], word[near]))
        a, b = (np.concatenate(side) for side in zip(*found)) if found else (np.zeros(0, np.int64),) * 2
        return pa.Table.from_arrays(
            [*(walks.column(c).take(pa.array(a)) for c in ("word", "n")), *(owns.column(c).take(pa.array(b)) for c in ("word", "n"))],
            names=["a", "a_n", "b", "b_n"],
        )

    return rows.groupBy("node", "part").applyInArrow(search, "a string, a_n long, b string, b_n long")


def _lacking_one(rows: DataFrame) -> DataFrame:
    """Each row once for each letter, with ``place`` and the ``rest`` of the word."""
    rest = F.transform(
        F.sequence(F.lit(1), F.length("word")),
        lambda k: F.concat(F.substring("word", F.lit(1), k - 1), F.substring("word", k + 1, F.length("word"))),
    )
    return rows.select("*", F.posexplode(rest).alias("place", "rest"))


def _by_rests(walks: DataFrame, owns: DataFrame) -> DataFrame:
    """``a, a_n, b, b_n`` at leaves of any size: the words agree without one letter."""
    a = walks.select("node", "word", "state", F.col("word").alias("a"), F.col("n").alias("a_n"))
    b = owns.select("node", "word", F.col("word").alias("b"), F.col("n").alias("b_n"))
    once = (F.col("state") != FRESH) | (F.col("a") < F.col("b"))
    replaced = _lacking_one(a.where(F.col("state") != SHORTER)).drop("word").join(
        _lacking_one(b).drop("word"), ["node", "place", "rest"]
    ).where(once & (F.col("a") != F.col("b")))
    shorter = _lacking_one(a.where(F.col("state") == SHORTER)).select("node", "a", "a_n", F.col("rest").alias("word")).distinct()
    return replaced.select("a", "a_n", "b", "b_n").unionByName(
        shorter.join(b, ["node", "word"]).select("a", "a_n", "b", "b_n")
    )


def near_words(words: DataFrame, scratch: Scratch) -> DataFrame:
    """``a, a_n, b, b_n``: each pair of ``words (word, n, counts)`` that are one edit apart, once."""
    walks = words.select("word", "n", F.lit(FRESH).alias("state"), F.lit(b"").alias("node"))
    rest, found = words, []
    for depth in range(CUT, GROUPS + 1, CUT):
        owns = rest.withColumn("node", F.substring("counts", 1, 4 * depth))
        sizes = scratch.stored(owns.groupBy("node").agg(F.count("*").alias("size")), f"nodes{depth}")
        walks = scratch.stored(_descended(walks, depth).join(sizes, "node"), f"walks{depth}")
        owns = owns.join(sizes, "node")
        fits = F.col("size") <= SHARD
        dealt = walks.where(fits).groupBy("node").agg(F.ceil(F.count("*") / PROBES).cast("int").alias("parts"))
        part = F.pmod(F.xxhash64("word"), F.col("parts")).cast("int")
        columns = ["node", "part", "word", "n", "state"]
        searches = walks.where(fits).join(dealt, "node").withColumn("part", part).select(columns)
        held = (
            owns.where(fits)
            .join(dealt, "node")
            .select("*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(None).cast("int").alias("state"))
            .select(columns)
        )
        found.append(scratch.stored(_searched(searches.unionByName(held)), f"near{depth}"))
        if sizes.where(~fits).isEmpty():
            break
        rest, walks = owns.where(~fits).select("word", "n", "counts"), walks.where(~fits).drop("size")
        if depth == GROUPS:
            found.append(scratch.stored(_by_rests(walks, owns.where(~fits)), "near"))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def rooted(forms: DataFrame, most: int, scratch: Scratch) -> DataFrame:
    """``word, root`` of ``forms (word, form)``, following forms to the last; no count exceeds ``most``."""
    steps = max(int(math.log(max(most, 1), FORM_TIMES)) + 1, 1)
    out = forms.select("word", F.col("form").alias("root"))
    for k in range(math.ceil(math.log2(steps)) + 1 if steps > 1 else 0):
        on = out.select(F.col("word").alias("_w"), F.col("root").alias("_r"))
        out = out.join(on, out["root"] == F.col("_w"), "left").select("word", F.coalesce("_r", "root").alias("root"))
        out = scratch.stored(out, f"roots{k}")
    return out


def variants(words: DataFrame, scratch: Scratch) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of ``words (word, n)``, distinct."""
    words = scratch.stored(with_counts(words), "words")
    pairs = near_words(words, scratch)
    both = pairs.unionByName(pairs.selectExpr("b as a", "b_n as a_n", "a as b", "a_n as b_n"))
    near = both.groupBy("a", "a_n").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("b_n")).alias("minus"), F.col("b").alias("word"))).alias("best")
    )
    taken = -F.col("best.minus") >= FORM_TIMES * F.col("a_n")
    near = scratch.stored(
        near.select(
            F.col("a").alias("word"),
            "n_near",
            F.when(taken, F.col("best.word")).alias("form"),
            F.when(taken, -F.col("best.minus")).alias("form_n"),
        ),
        "near_counts",
    )
    most = words.agg(F.max("n")).first()[0]
    roots = rooted(near.where("form is not null"), most or 1, scratch)
    return (
        words.select("word", "n")
        .join(near, "word", "left")
        .join(roots, "word", "left")
        .select(
            "word", "form", F.coalesce("root", "word").alias("root"), "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n",
        )
    )


def group_spellings(documents: DataFrame) -> DataFrame:
    """Every frequent word of ``documents (doc_id, text)`` with its near words counted, its form and its root."""
    scratch = Scratch(documents.sparkSession, "spelling")
    counted = scratch.stored(counted_words(documents), "counted")
    return variants(counted, scratch)
