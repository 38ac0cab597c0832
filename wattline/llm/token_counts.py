"""Token counts by a public tokenizer: batch encoding that returns lengths only.

Texts are cut into pieces at safe boundaries, a single space between two
characters that are not white space: the pre-tokenizer always starts a new token
at such a space, so the pieces' counts add up to the text's. Pieces are then
gathered into batches of about equal bytes, so one long text neither grows a
batch without bound nor leaves the others waiting.

Defined cases: a null or empty text has no tokens; a text without a safe
boundary is encoded whole; special strings inside a text count as the library's
default has it.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

#: Characters after which the next safe boundary is looked for, and bytes in a batch.
PIECE_CHARS = 16_384
BATCH_BYTES = 1 << 20

SAFE = re.compile(r"(?<=\S) (?=\S)")

_LOADED: dict[str, object] = {}


def _tokenizer(path: str):
    if path not in _LOADED:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core belongs to a task
        from tokenizers import Tokenizer

        _LOADED[path] = Tokenizer.from_file(path)
    return _LOADED[path]


def pieces(text: str, chars: int = PIECE_CHARS) -> Iterator[str]:
    """Consecutive parts of ``text``, cut at safe boundaries only."""
    low = 0
    while len(text) - low > chars:
        cut = SAFE.search(text, low + chars)
        if cut is None:
            break
        yield text[low : cut.start()]
        low = cut.start()
    yield text[low:]


def _counted(texts: list[str], path: str) -> list[int]:
    """Tokens of each text; the pieces of all of them share batches."""
    encode, totals = _tokenizer(path).encode_batch_fast, [0] * len(texts)
    owners, parts, size = [], [], 0

    def flush() -> None:
        for owner, found in zip(owners, encode(parts, add_special_tokens=False)):
            totals[owner] += len(found)
        owners.clear()
        parts.clear()

    for owner, text in enumerate(texts):
        for part in pieces(text):
            owners.append(owner)
            parts.append(part)
            size += len(part)
            if size >= BATCH_BYTES:
                flush()
                size = 0
    if parts:
        flush()
    return totals


def count_tokens(documents: DataFrame, tokenizer_path: str, limit: int = 512) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row of ``documents``.

    ``tokenizer_path`` names a file that every executor has.
    """
    rows = documents.select("doc_id", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 1000):
                part = batch.slice(low, 1000)
                texts = [x or "" for x in part.column("text").to_pylist()]
                found = _counted(texts, tokenizer_path)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array([len(x.encode()) for x in texts], pa.int64()),
                        pa.array(found, pa.int64()),
                        pa.array([n > limit for n in found], pa.bool_()),
                    ],
                    names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
                )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        count, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean"
    )
