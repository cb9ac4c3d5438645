"""Blocks of whole documents with a dictionary of their own.

A block is a run of documents of one task. What repeats in it (white-space
chunks, linked token ids) is listed once; its documents refer to that list by
position. Only the lists are joined across the corpus, so a value has at most
one row per block in such a join, however often and in however many documents
it stands: no key can be hot. What the join found goes back to the block, whose
size is bounded (a longer text is a block of its own).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext

from tempora.llm.text import U64, RollingHash, text_bytes


class BlockIds:
    """Numbers of the blocks of this task; no other task has them."""

    def __init__(self):
        ctx = TaskContext.get()
        self._next = (ctx.partitionId() if ctx else 0) << 32

    def __call__(self) -> int:
        self._next += 1
        return self._next


def squeeze(x: np.ndarray) -> bytes:
    """Non-negative integers as zstd-compressed 32-bit numbers, led by their count."""
    raw = np.ascontiguousarray(x, np.uint32).tobytes()
    return len(x).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unsqueeze(b: bytes) -> np.ndarray:
    n = int.from_bytes(b[:8], "little")
    return np.frombuffer(pa.decompress(b[8:], 4 * n, codec="zstd", asbytes=True), np.uint32).astype(np.int64)


def squeeze_rising(x: np.ndarray, first: np.ndarray) -> bytes:
    """Numbers that rise from each of the places ``first`` on, as steps."""
    step = np.diff(x, prepend=0)
    step[first] = x[first]
    return squeeze(step)


def unsqueeze_rising(b: bytes, first: np.ndarray) -> np.ndarray:
    step = unsqueeze(b)
    total = np.cumsum(step)
    before = total[first] - step[first]
    return total - np.repeat(before, np.diff(np.append(first, len(step))))


def pack_strings(a: pa.Array) -> bytes:
    """Strings as their zstd-compressed lengths and bytes."""
    data, offs = text_bytes(a)
    sizes = squeeze(np.diff(offs))
    return len(sizes).to_bytes(8, "little") + len(data).to_bytes(8, "little") + sizes + pa.compress(data.tobytes(), codec="zstd", asbytes=True)


def unpack_strings(b: bytes) -> pa.Array:
    at, size = int.from_bytes(b[:8], "little"), int.from_bytes(b[8:16], "little")
    sizes = unsqueeze(b[16:16 + at])
    offs = np.append(0, np.cumsum(sizes)).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(sizes), pa.py_buffer(offs), pa.py_buffer(pa.decompress(b[16 + at:], size, codec="zstd", asbytes=True)))


def string_hash(a: pa.Array) -> np.ndarray:
    """A 64-bit hash of every string, the same in every task; it only deals strings to buckets."""
    data, offs = text_bytes(a)
    return RollingHash(data)(offs[:-1], offs[1:]) if len(data) else np.zeros(len(a), U64)


def coded(a: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Codes of strings, and the distinct strings."""
    d = a.dictionary_encode()
    d = d.combine_chunks() if isinstance(d, pa.ChunkedArray) else d
    return d.indices.to_numpy().astype(np.int64), d.dictionary


def rising(x: np.ndarray) -> np.ndarray:
    """The distinct values of integers, in order."""
    x = np.sort(x, kind="stable")
    return x[np.append(True, x[1:] != x[:-1])] if len(x) else x
