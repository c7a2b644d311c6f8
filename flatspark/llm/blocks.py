"""Packed exchange of what many documents have in common.

A block is a run of whole documents that one task reads. Its distinct values (words, digests)
are dealt over ``parts`` by a hash, one packed row per (block, part) instead of one row per
value: an exchange moves few rows, and a value that all blocks hold costs one entry per block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


PART = "_part"


def in_blocks(
    batches: Iterator[pa.RecordBatch], text: str, block_bytes: int
) -> Iterator[tuple[int, pa.RecordBatch, bool]]:
    """Slices of the batches with the id of their block, and whether the block ends with them.

    A block ends after the document that brings it to ``block_bytes``. Ids start from the column
    ``PART``, the number of the input's partition, so they depend only on the partition's rows
    and their order. (A task's own number would not do: a union counts its tasks through.)
    """
    block, size = None, 0
    for b in batches:
        if block is None and b.num_rows:
            block = b[PART][0].as_py() << 24
        lengths = np.array([0 if x is None else len(x) for x in b[text].cast(pa.large_binary()).to_pylist()], np.int64)
        start = 0
        for i, n in enumerate(lengths):
            size += n
            if size >= block_bytes:
                yield block, b.slice(start, i + 1 - start), True
                start, size, block = i + 1, 0, block + 1
        if start < b.num_rows:
            yield block, b.slice(start), False


def record(columns: dict[str, tuple[list, pa.DataType]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in columns.values()], list(columns))


def pack_words(words: list[bytes]) -> bytes:
    """Lengths, then the words."""
    return np.array([len(w) for w in words], np.uint32).tobytes() + b"".join(words)


def unpack_words(n: int, data: bytes) -> list[bytes]:
    at = (4 * n + np.concatenate([[0], np.cumsum(np.frombuffer(data, np.uint32, n), dtype=np.int64)])).tolist()
    return [data[a:b] for a, b in zip(at[:-1], at[1:])]


def squeezed(data: bytes) -> bytes:
    """Compressed, behind its length."""
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def unsqueezed(data: bytes) -> bytes:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)


def planes(numbers: np.ndarray) -> bytes:
    """Unsigned 32-bit integers, compressed byte place by byte place: the high places are mostly zero."""
    parts = np.ascontiguousarray(numbers, "<u4").view(np.uint8).reshape(-1, 4)
    return squeezed(np.ascontiguousarray(parts.T).tobytes())


def from_planes(data: bytes) -> np.ndarray:
    parts = np.frombuffer(unsqueezed(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(parts.T).view("<u4").reshape(-1)
