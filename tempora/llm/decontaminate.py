"""Benchmark decontamination with suffix arrays of the training text.

Each task builds a word suffix array of its shard (a slice of whole documents)
and binary-searches every benchmark suffix in it. A shard's array holds the
suffixes whose first words open some benchmark window; no other suffix can
match one. Suffixes are sorted by their first ``window`` words, so the range
that a binary search finds are all verbatim occurrences; occurrences on one
diagonal join to the longest matches, with their places.

The benchmark is small and stated: its words are collected in blocks of at
most ``BLOCK_WORDS``, and each block is searched in turn; within a block the
work grows with the documents only, and no text is shuffled.

Defined results: null or word-less texts have no words and no hits; an item
with fewer words than the window is one window, an item without words none;
items are told apart by item_id (repeated ids are one item, a null id is the
item ``null``); repeated documents each get their row; empty tables give empty
or clean results. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tempora.llm.text import (ALNUM, BYTE_CODE_LOWER, U64, RollingHash, column, mix, read_documents, slices, spread,
                              text_bytes, word_spans)

WINDOW = 10
#: Leading words by which suffixes are let into an array.
LEAD = 3
#: Benchmark words searched at once (their hashes are what is broadcast).
BLOCK_WORDS = 1_000_000

_NONE = hashlib.sha256(b"").hexdigest()


def word_hashes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A hash of every word, and each text's first word (one more entry)."""
    buf, offs = text_bytes(col)
    starts, ends, first = word_spans(buf, offs, ALNUM)
    return RollingHash(buf, BYTE_CODE_LOWER)(starts, ends), first


def _lead(words: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    h = np.full(len(at), U64(k))
    for j in range(k):
        h = mix(h + words[at + j])
    return h


class Windows:
    """The windows of a block of items, as rows of word hashes."""

    def __init__(self, words: list[np.ndarray], items: list[str], window: int):
        rows: list[np.ndarray] = []
        self.items, self.places, sizes = [], [], []
        for w, item in zip(words, items):
            m = min(window, len(w))
            for i in range(len(w) - m + 1 if m else 0):
                row = np.zeros(window, U64)
                row[:m] = w[i:i + m]
                rows.append(row)
                sizes.append(m)
                self.items.append(item)
                self.places.append(i)
        table = np.array(rows, U64).reshape(-1, window)
        self.size = np.array(sizes, np.int64)
        self.items = np.array(self.items, object)
        self.places = np.array(self.places, np.int64)
        self.table = table
        #: by number of leading words, the sorted lead hashes
        self.leads: dict[int, np.ndarray] = {}
        for k in range(1, LEAD + 1):
            own = table[np.minimum(self.size, LEAD) == k]
            if len(own):
                self.leads[k] = np.unique(_lead(own.reshape(-1), np.arange(len(own)) * window, k))


def suffix_array(words: np.ndarray, ends: np.ndarray, at: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes ``at`` sorted by their first ``window`` words (a text's
    end sorts first), as (sorted places, table of word hashes)."""
    table = np.zeros((len(at), window), U64)
    for j in range(window):
        p = at + j
        ok = p < ends
        table[ok, j] = words[p[ok]]
    order = np.lexsort(table.T[::-1])
    return at[order], table[order]


def search(table: np.ndarray, win: Windows) -> tuple[np.ndarray, np.ndarray]:
    """For every window, the range of sorted suffixes that begin with it: two
    binary searches of all windows at once."""
    n, width = len(table), table.shape[1]
    out = []
    for upper in (False, True):
        lo, hi = np.zeros(len(win.size), np.int64), np.full(len(win.size), n)
        while (lo < hi).any():
            run = lo < hi
            mid = np.where(run, (lo + hi) // 2, 0)
            order = np.zeros(len(mid), np.int8)  # of the suffix against the window
            for j in range(width):
                open_ = (order == 0) & (j < win.size)
                if not open_.any():
                    break
                a, b = table[mid, j], win.table[:, j]
                order = np.where(open_, np.where(a < b, -1, np.where(a > b, 1, 0)), order).astype(np.int8)
            go = (order < 0) | ((order == 0) & upper)
            lo = np.where(run & go, mid + 1, lo)
            hi = np.where(run & ~go, mid, hi)
        out.append(lo)
    return out[0], out[1]


def occurrences(words: np.ndarray, first: np.ndarray, win: Windows) -> tuple[np.ndarray, np.ndarray]:
    """(word place, window number) of every occurrence of every window."""
    none = np.zeros(0, np.int64)
    if not len(win.size) or not len(words):
        return none, none
    ends = np.repeat(first[1:], np.diff(first))
    found = []
    for k, leads in win.leads.items():
        at = np.flatnonzero(np.arange(len(words)) + k <= ends)
        h = _lead(words, at, k)
        i = np.searchsorted(leads, h)
        found.append(at[leads[np.minimum(i, len(leads) - 1)] == h])
    at = np.unique(np.concatenate(found))
    if not len(at):
        return none, none
    places, table = suffix_array(words, ends[at], at, win.table.shape[1])
    lo, hi = search(table, win)
    return places[spread(lo, hi - lo)], np.repeat(np.arange(len(lo)), hi - lo)


def benchmark_blocks(benchmark: DataFrame, window: int, block_words: int = BLOCK_WORDS) -> Iterator[Windows]:
    """Items in blocks of a bounded number of words."""
    words, items, n = [], [], 0
    for r in benchmark.select(F.col("item_id").cast("string").alias("i"), "text").distinct().toLocalIterator():
        h, _ = word_hashes(pa.array([r.text], pa.string()))
        words.append(h)
        items.append(r.i or "null")
        n += len(h)
        if n >= block_words:
            yield Windows(words, items, window)
            words, items, n = [], [], 0
    if words:
        yield Windows(words, items, window)


def _hits(n_words: int, place: np.ndarray, size: np.ndarray) -> np.ndarray:
    mark = np.zeros(n_words + 1, np.int32)
    np.add.at(mark, place, 1)
    np.add.at(mark, place + size, -1)
    return np.cumsum(mark[:-1]) > 0


def scan(docs: DataFrame, benchmark: DataFrame, keep: list[str], window: int = WINDOW,
         block_words: int = BLOCK_WORDS) -> DataFrame:
    """Per document the columns ``keep``, n_words, n_hit, n_items,
    items_sha256, contaminated and matches: the longest verbatim matches as
    (item, item_word, word, length)."""
    spark = docs.sparkSession
    blocks = [spark.sparkContext.broadcast(w) for w in benchmark_blocks(benchmark, window, block_words)]
    match = pa.list_(pa.struct([("item", pa.string()), ("item_word", pa.int64()), ("word", pa.int64()), ("length", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "_text"):
            words, first = word_hashes(column(b, "_text"))
            n = b.num_rows
            place, size, item, at = [], [], [], []
            for shared in blocks:
                win = shared.value
                p, w = occurrences(words, first, win)
                place.append(p), size.append(win.size[w]), item.append(win.items[w]), at.append(win.places[w])
            empty = np.zeros(0, np.int64)
            place, size = np.concatenate([empty, *place]), np.concatenate([empty, *size])
            item, at = np.concatenate([np.zeros(0, object), *item]), np.concatenate([empty, *at])
            hit = _hits(len(words), place, size)
            total = np.concatenate(([0], np.cumsum(hit)))
            n_hit = total[first[1:]] - total[first[:-1]]
            doc = np.searchsorted(first, place, side="right") - 1
            n_items, digest, spans = np.zeros(n, np.int64), [_NONE] * n, [[] for _ in range(n)]
            order = np.argsort(doc, kind="stable")
            for run_ in np.split(order, np.flatnonzero(np.diff(doc[order])) + 1) if len(order) else ():
                d = int(doc[run_[0]])
                names = sorted(set(item[run_]))
                n_items[d] = len(names)
                digest[d] = hashlib.sha256(",".join(names).encode()).hexdigest()
                spans[d] = longest(item[run_], at[run_], place[run_] - first[d], size[run_])
            yield pa.RecordBatch.from_arrays(
                [column(b, c) for c in keep] + [pa.array(np.diff(first), pa.int64()), pa.array(n_hit, pa.int64()), pa.array(n_items),
                                                pa.array(digest, pa.string()), pa.array(n_hit > 0), pa.array(spans, match)],
                names=[*keep, "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "matches"])

    place_ = T.StructType().add("item", "string").add("item_word", "long").add("word", "long").add("length", "long")
    schema = docs.select(*keep).schema
    for name, kind in (("n_words", "long"), ("n_hit", "long"), ("n_items", "long"), ("items_sha256", "string"), ("contaminated", "boolean"),
                       ("matches", T.ArrayType(place_))):
        schema = schema.add(name, kind)
    return docs.select(*keep, F.col("text").alias("_text")).mapInArrow(run, schema)


def longest(item: np.ndarray, at: np.ndarray, place: np.ndarray, size: np.ndarray) -> list[dict]:
    """Windows that follow each other in the same item and text are one match."""
    rows = sorted(zip(item, place - at, place, at, size))
    out: list[dict] = []
    last = None
    for name, diagonal, p, a, m in rows:
        if last and last[:2] == (name, diagonal) and p <= out[-1]["word"] + out[-1]["length"] - m + 1:
            out[-1]["length"] = int(max(out[-1]["length"], p + m - out[-1]["word"]))
        else:
            out.append({"item": name, "item_word": int(a), "word": int(p), "length": int(m)})
        last = (name, diagonal)
    return out


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(read_documents(spark, sf_dir), read_documents(spark, sf_dir, "benchmark"), ["doc_id"]).drop("matches")


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without any benchmark window; the columns of ``docs``."""
    rows = docs.select(F.struct("*").alias("_row"), "text")
    return scan(rows, benchmark, ["_row"]).filter(~F.col("contaminated")).select("_row.*")
