"""Helpers shared by the corpus operators: whole texts as numpy bytes, word
spans, 64-bit hashes, packed exchange blocks and size-checked joins."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.session import cut_lineage

#: Text bytes handled at once inside a task; a longer text is a slice of its own.
SLICE_BYTES = 2 << 20
#: Rows (of at most a few dozen bytes) that may be broadcast, checked by a count.
BROADCAST_ROWS = 1_000_000

U64 = np.uint64
_B = U64(0x9E3779B97F4A7C15 | 1)
_BINV = U64(pow(int(_B), -1, 1 << 64))
_POW: dict[str, np.ndarray] = {}

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: bytes of the words [^\x20\x09-\x0D]+
WORD = ~SPACE
#: bytes of the words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ of a lower-cased text
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> U64(33))
    x = x * U64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U64(33))
    x = x * U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U64(33))


BYTE_CODE = mix(np.arange(1, 257, dtype=U64))
BYTE_CODE_LOWER = BYTE_CODE[LOWER]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    have = len(_POW.get("p", ()))
    if have < n:
        size = max(n, 2 * have, 1 << 16)
        for name, base in (("p", _B), ("q", _BINV)):
            a = np.full(size, base, U64)
            a[0] = 1
            _POW[name] = np.cumprod(a, dtype=U64)
    return _POW["p"], _POW["q"]


class RollingHash:
    """Hashes of any byte range of ``buf`` from one prefix sum."""

    def __init__(self, buf: np.ndarray, code: np.ndarray = BYTE_CODE):
        p, self._q = _powers(len(buf) + 1)
        self._h = np.zeros(len(buf) + 1, U64)
        np.cumsum(code[buf] * p[:len(buf)], out=self._h[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self._h[end] - self._h[start]) * self._q[start])


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of a string column; null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_binary()).fill_null(b"")
    offs = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1] if len(col) else np.zeros(1, np.int64)
    data = col.buffers()[2]
    buf = np.frombuffer(data, np.uint8)[offs[0]:offs[-1]] if data is not None and len(col) else np.zeros(0, np.uint8)
    return buf, offs - offs[0]


def slices(batches: Iterator[pa.RecordBatch], col: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in slices of about ``limit`` text bytes."""
    for b in batches:
        if not b.num_rows:
            continue
        _, offs = text_bytes(column(b, col))
        i = 0
        while i < b.num_rows:
            j = int(np.searchsorted(offs, offs[i] + limit, side="right")) - 1
            j = min(max(j, i + 1), b.num_rows)
            yield b.slice(i, j - i)
            i = j


def column(b: pa.RecordBatch, name: str) -> pa.Array:
    """A column, or a field of a struct column (``_row.text``), which need not
    be sent to the task a second time."""
    head, *path = name.split(".")
    out = b.column(b.schema.get_field_index(head))
    for field in path:
        out = out.field(field)
    return out


def word_spans(buf: np.ndarray, offs: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the index of each text's first word
    (one more entry than texts)."""
    n = len(buf)
    w = np.zeros(n + 2, bool)
    w[1:-1] = is_word[buf]
    edge = np.zeros(n + 1, bool)
    edge[offs] = True
    starts = np.flatnonzero(w[1:-1] & (~w[:-2] | edge[:-1]))
    ends = np.flatnonzero(w[1:-1] & (~w[2:] | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offs)


def spread(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Concatenated ranges ``first[i] .. first[i] + count[i] - 1``."""
    total = int(count.sum())
    at = np.cumsum(count) - count
    return np.arange(total) + np.repeat(first - at, count)


def pack(key: np.ndarray, rows: np.ndarray, buckets: int) -> tuple[np.ndarray, list[bytes]]:
    """Records dealt into buckets by hash ``key``: the buckets present and one
    binary block for each."""
    b = (key % U64(buckets)).astype(np.int64)
    order = np.argsort(b, kind="stable")
    b, rows = b[order], rows[order]
    cut = np.flatnonzero(np.concatenate(([True], b[1:] != b[:-1]))) if len(b) else np.zeros(0, np.int64)
    stop = np.append(cut[1:], len(b))
    return b[cut], [rows[i:j].tobytes() for i, j in zip(cut, stop)]


def unpack(table: pa.Table, dtype: np.dtype, name: str = "block") -> np.ndarray:
    parts = [np.frombuffer(x.as_buffer(), dtype) for x in table.column(name)]
    return np.concatenate(parts) if parts else np.zeros(0, dtype)


def signed(x: np.ndarray) -> np.ndarray:
    return x.astype(U64, copy=False).view(np.int64)


def read_documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared checkpoint folder and read back."""
    return cut_lineage(df, name)


def attach(texts: DataFrame, small: DataFrame, on: Callable[[DataFrame, DataFrame], Column], how: str = "inner",
           rows: int | None = None, bound: int = BROADCAST_ROWS) -> DataFrame:
    """Join whole texts with a written table. Its counted size decides: up to
    ``bound`` rows it is broadcast, so that the texts stay where they are;
    beyond, both sides are shuffled."""
    n = small.count() if rows is None else rows
    side = F.broadcast(small) if n <= bound else small.hint("shuffle_hash") if how == "left_semi" else small
    return texts.join(side, on(texts, small), how)


def buckets_for(records: int, per_bucket: int = 1_000_000, least: int = 12) -> int:
    return max(least, -(-records // per_bucket))
