"""Arrow text columns as byte arrays, cut into blocks of bounded size.

A block holds whole rows and about ``BLOCK_BYTES`` of text; a single longer text
is a block of its own. All kernels below are array operations over one block.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 21

_BASE = np.uint64(0x9E3779B97F4A7C15)
_POWERS: dict[str, np.ndarray] = {}


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows together and the n + 1 row offsets; null is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(
    batches: Iterable[pa.RecordBatch], text: str = "text", limit: int = BLOCK_BYTES
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Consecutive rows of each batch with their bytes and offsets."""
    for batch in batches:
        data, offsets = text_bytes(batch.column(text))
        low = 0
        while low < batch.num_rows:
            fits = int(np.searchsorted(offsets, offsets[low] + limit, "right")) - 1
            high = min(max(low + 1, fits), batch.num_rows)
            yield (
                batch.slice(low, high - low),
                data[offsets[low] : offsets[high]],
                offsets[low : high + 1] - offsets[low],
            )
            low = high


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    """Membership table of byte values, ranges inclusive."""
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


def ascii_lower() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[ord("A") : ord("Z") + 1] += 32
    return table


def words(
    data: np.ndarray, offsets: np.ndarray, separator: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs free of separators, and each row's first word index."""
    inside = ~separator[data]
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    filled = offsets[:-1] < offsets[1:]
    first, last = offsets[:-1][filled], offsets[1:][filled] - 1
    starts[first] = inside[first]
    ends[last] = inside[last]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the spans ``[start, end)``, mixed anew after every eight bytes.

    Unlike a polynomial over the bytes it has no inputs that collide by their structure.
    """
    sizes = ends - starts
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    eight = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))  # the eight bytes from each place on
    out, open_, done = mixed(sizes.astype(np.uint64) + _BASE), np.flatnonzero(sizes > 0), 0
    while len(open_):
        left = np.minimum(sizes[open_] - done, 8).astype(np.uint64)
        own = eight[starts[open_] + done] & (~np.uint64(0) >> (np.uint64(64) - np.uint64(8) * left))
        out[open_] = mixed((out[open_] ^ own) * _BASE + left)
        done += 8
        open_ = open_[sizes[open_] > done]
    return out


def runs_of(hashes: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """64-bit hashes of the ``width`` consecutive ``hashes`` from each of ``at`` on."""
    out = np.full(len(at), width, np.uint64)
    for k in range(width):
        out = mixed((out ^ hashes[at + k]) * _BASE + np.uint64(1))
    return out


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least ``n`` of each."""
    if len(_POWERS.get("up", ())) < n:
        size = max(n, 1 << 16)
        for name, base in (("up", int(_BASE)), ("down", pow(int(_BASE), -1, 1 << 64))):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _POWERS[name] = np.multiply.accumulate(table)
    return _POWERS["up"], _POWERS["down"]


def prefixes(values: np.ndarray) -> np.ndarray:
    """Running polynomial sums, from which any span's hash follows in constant time."""
    up, _ = _powers(len(values) + 1)
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * up[: len(values)], out=out[1:])
    return out


def spans(running: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Mixed 64-bit hashes of the spans ``[start, end)``."""
    _, down = _powers(len(running))
    raw = (running[ends] - running[starts]) * down[starts]
    return mixed(raw + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def rolling(running: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all spans of ``width`` items; equal to ``spans`` over each of them."""
    _, down = _powers(len(running))
    count = max(len(running) - width, 0)
    raw = running[width : width + count] - running[:count]
    raw *= down[:count]
    raw += np.uint64(width * 0xD6E8FEB86659FD93 % (1 << 64))
    return mixed(raw)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every input bit over the whole word."""
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x


def row_of(first: np.ndarray) -> np.ndarray:
    """The row of every item, from each row's first item index."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))
