"""Line dedup by a deletion-neighbourhood join.

A line is its words, lower-cased; the edit bound is one word put in, left out
or replaced, for lines of at least ``NEAR_WORDS`` words (two shorter lines must
be equal). A line goes if an earlier line is within the bound; earlier is by
doc_id (null last), text key and line number.

1. Every line's words are hashed; equal lines are one class, of which the
   earliest line stands for all others.
2. Of two lines one edit apart, either the first or the last half of the words
   is equal, so only classes that share such a half with another class go on.
3. Those emit their deletion neighbourhood as hashed keys: the line, and the
   line without each word. Equal keys join: the same gap in lines of one
   length is a replacement, the whole of one line against a gap of another an
   insertion. A key's group is never paired up: its earliest line is enough,
   as every other member is within the bound of it.
4. The edit distance is verified on the words: for the keys that could hold a
   pair, the variants themselves are read from the texts again, and lines pair
   up by equal words (and gap), not by hash.

Blank lines are never removed. Defined results: a null text has no lines and
stays null; rows with one doc_id and equal text are one document and keep the
same lines; empty tables give empty results; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.llm.text import (BYTE_CODE_LOWER, LOWER, U64, WORD, RollingHash, attach, column, materialise, mix, read_documents, signed,
                              slices, spread, text_bytes, word_spans)

NEAR_WORDS = 8
#: Text bytes handled at once, words whose variants are made at once, and bytes of variants sent at once.
SCAN_BYTES, SCAN_WORDS, SENT_BYTES = 1 << 18, 50_000, 2 << 20
_P = U64(0x9E3779B97F4A7C15)
LOWER_BYTES = bytes(LOWER)


def lines(col: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all texts: each line's text, its number there, its first word (one more entry), and the word hashes."""
    buf, offs = text_bytes(col)
    null = np.asarray(col.is_null())
    at = np.flatnonzero(buf == 10)
    begin = np.sort(np.concatenate((offs[:-1][~null], at + 1)))
    owner = np.searchsorted(offs, begin, side="right") - 1
    # a line that begins where its text ends belongs to the text before
    first = np.flatnonzero(~null)
    n_lines = np.zeros(len(null), np.int64)
    inside = np.searchsorted(offs, at, side="right") - 1
    np.add.at(n_lines, inside, 1)
    n_lines[first] += 1
    owner = np.repeat(np.arange(len(null)), n_lines)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(n_lines) - n_lines, n_lines)
    starts, ends, _ = word_spans(buf, offs, WORD)
    words = RollingHash(buf, BYTE_CODE_LOWER)(starts, ends)
    return owner, number, np.append(np.searchsorted(starts, begin), len(starts)), words


class _Sums:
    """Order-dependent hashes of word ranges."""

    def __init__(self, words: np.ndarray, base: np.uint64):
        n = len(words)
        self.p = np.cumprod(np.concatenate((np.ones(1, U64), np.full(n + 1, base, U64))), dtype=U64)
        inv = U64(pow(int(base), -1, 1 << 64))
        self.q = np.cumprod(np.concatenate((np.ones(1, U64), np.full(n + 1, inv, U64))), dtype=U64)
        self.h = np.concatenate((np.zeros(1, U64), np.cumsum(words * self.p[:n], dtype=U64)))

    def raw(self, i, j):
        return (self.h[j] - self.h[i]) * self.q[i]

    def of(self, i, j):
        return mix(self.raw(i, j) + (j - i).astype(U64))

    def without(self, i, j, k):
        """Of words i..j without word k."""
        return mix(self.raw(i, k) + self.raw(k + 1, j) * self.p[k - i] + (j - i - 1).astype(U64))


def _half(n):
    """Words of the half that two lines of n and n or n + 1 words share."""
    return np.maximum(n - 1, 0) // 2


def describe(docs: DataFrame) -> DataFrame:
    """Written once: a row per line with words: doc_id, key, line, n, full and its halves' hashes (null for short lines)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", SCAN_BYTES):
            owner, number, first, words = lines(column(b, "text"))
            i, j = first[:-1], first[1:]
            ok = j > i
            owner, number, i, j = owner[ok], number[ok], i[ok], j[ok]
            n = j - i
            s = _Sums(words, _P)
            halves = []
            for size in (_half(n), _half(n - 1)):
                tag = size.astype(U64) * U64(4)
                halves += [mix(s.raw(i, i + size) + tag), mix(s.raw(j - size, j) + tag + U64(1))]
            near = n >= NEAR_WORDS - 1  # a line may lose a word to a shorter one
            keys = np.stack(halves, 1).view(np.int64) if len(n) else np.zeros((0, 4), np.int64)
            keys = [np.unique(k) if x else None for k, x in zip(keys, near)]
            yield pa.record_batch({"doc_id": column(b, "doc_id").cast(pa.int64()).take(pa.array(owner)), "key": column(b, "key").take(pa.array(owner)),
                                   "line": pa.array(number), "n": pa.array(n), "full": pa.array(signed(s.of(i, j))), "halves": pa.array(keys, pa.list_(pa.int64()))})

    return materialise(docs.mapInArrow(run, "doc_id long, key long, line long, n long, full long, halves array<long>"), "line-hashes")


def order() -> Column:
    """Where a line stands among all lines."""
    return F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "key", "line")


def variants(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The deletion neighbourhood of the wanted lines (doc_id, key, line):
    (k, kind, gap, full, doc_id, key, line) with kind 0 for the line itself, 1 for a line
    without a word (the one at ``gap``), 2 for the same with the length and the gap in the key."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", SCAN_BYTES):
            owner, number, first, words = lines(column(b, "text"))
            want = column(b, "lines")
            # the place of each wanted line among all
            start = np.searchsorted(owner, np.arange(b.num_rows))
            count = np.diff(want.offsets.to_numpy())
            text = np.repeat(np.arange(b.num_rows), count)
            at = start[text] + want.flatten().to_numpy()
            s = _Sums(words, _P)
            part = (np.cumsum(first[at + 1] - first[at]) - 1) // SCAN_WORDS
            for mine in np.split(np.arange(len(at)), np.flatnonzero(np.diff(part)) + 1):
                yield made(b, s, text[mine], at[mine], first, number)

    def made(b: pa.RecordBatch, s: _Sums, text: np.ndarray, at: np.ndarray, first: np.ndarray, number: np.ndarray) -> pa.RecordBatch:
        i, j = first[at], first[at + 1]
        n = j - i
        gaps = np.where(n >= NEAR_WORDS, n, 0)  # a shorter line is only compared as a whole
        gap, run_ = spread(i, gaps), np.repeat(np.arange(len(n)), gaps)
        whole, less = s.of(i, j), s.without(i[run_], j[run_], gap)
        place = gap - i[run_]
        own = np.concatenate((np.arange(len(n)), run_, run_))
        keys = variant_key(np.concatenate((whole, less, mix(less + mix(place.astype(U64) * U64(1 << 32) + n[run_].astype(U64))))))
        kinds = np.repeat(np.arange(3), [len(n), len(gap), len(gap)])
        gaps = np.concatenate((np.full(len(n), -1), place, place))
        row = pa.array(text[own])
        return pa.record_batch({"k": pa.array(signed(keys)), "kind": pa.array(kinds.astype(np.int32)), "gap": pa.array(gaps.astype(np.int32)),
                                "full": pa.array(signed(whole[own])), "doc_id": column(b, "doc_id").cast(pa.int64()).take(row),
                                "key": column(b, "key").take(row), "line": pa.array(number[at][own])})

    lists = wanted.groupBy("doc_id", "key").agg(F.collect_list("line").alias("lines"))
    lists = materialise(lists.select(F.col("doc_id").alias("_id"), F.col("key").alias("_key"), "lines"), "line-wanted")
    rows = lists.agg(F.sum(F.size("lines"))).first()[0] or 0
    texts = attach(docs, lists, lambda d, w: (d.key == w["_key"]) & d.doc_id.eqNullSafe(w["_id"]), rows=rows)
    return texts.select("doc_id", "key", "lines", "text").mapInArrow(
        run, "k long, kind int, gap int, full long, doc_id long, key long, line long")


def variant_key(h: np.ndarray) -> np.ndarray:
    """What variants are joined by; the words decide afterwards, so any function of the hash will do."""
    return h


def reread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of the wanted variants (line, kind, gap, full) of each text, ``SENT_BYTES`` at a time."""
    for b in slices(batches, "text", SCAN_BYTES):
        buf, offs = text_bytes(column(b, "text"))
        wanted = column(b, "wanted")
        flat, cut = wanted.flatten(), wanted.offsets.to_numpy() - wanted.offsets[0].as_py()
        line, kind, gap, full = (flat.field(c).to_numpy() for c in ("line", "kind", "gap", "full"))

        def sent(made: list[bytes], own: list[int], at: list[int]) -> pa.RecordBatch:
            row = pa.array(own, pa.int64())
            return pa.record_batch({"variant": pa.array(made, pa.binary()), "kind": pa.array(kind[at].astype(np.int32)), "full": pa.array(full[at]),
                                    "doc_id": column(b, "doc_id").take(row), "key": column(b, "key").take(row), "line": pa.array(line[at])})

        made, own, at, size = [], [], [], 0
        for i in range(b.num_rows):
            parts, last, words = buf[offs[i]:offs[i + 1]].tobytes().split(b"\n"), -1, []
            for k in (cut[i] + np.argsort(line[cut[i]:cut[i + 1]], kind="stable")).tolist():  # a line's words are split once
                if line[k] != last:
                    last = line[k]
                    words = parts[last].translate(LOWER_BYTES).split()  # white space as in ``WORD``
                g = gap[k]
                variant = b" ".join(words if g < 0 else words[:g] + words[g + 1:])
                made.append(variant + b"\n%d" % g if kind[k] == 2 else variant)
                own.append(i)
                at.append(k)
                size += len(variant) + 100
                if size > SENT_BYTES:
                    yield sent(made, own, at)
                    made, own, at, size = [], [], [], 0
        if made:
            yield sent(made, own, at)


def exact_variants(docs: DataFrame, asked: DataFrame) -> DataFrame:
    """(variant, kind, full, doc_id, key, line): the words of the asked variants
    (doc_id, key, line, kind, gap, full), with the gap where kind is 2."""
    lists = asked.groupBy("doc_id", "key").agg(F.collect_list(F.struct("line", "kind", "gap", "full")).alias("wanted"))
    lists = materialise(lists.select(F.col("doc_id").alias("_id"), F.col("key").alias("_key"), "wanted"), "line-asked")
    rows = lists.agg(F.sum(F.size("wanted"))).first()[0] or 0
    texts = attach(docs, lists, lambda d, w: (d.key == w["_key"]) & d.doc_id.eqNullSafe(w["_id"]), rows=rows)
    return texts.select(F.col("doc_id").cast("long").alias("doc_id"), "key", "wanted", "text").mapInArrow(
        reread, "variant binary, kind int, full long, doc_id long, key long, line long")


def near_lines(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """The classes (full) that have an earlier line within the bound."""
    half = classes.filter("halves is not null").select("full", F.explode("halves").alias("h"))
    shared = half.groupBy("h").agg(F.min("full").alias("a"), F.max("full").alias("b")).filter("a <> b").select("h")
    wanted = half.join(shared, "h", "left_semi").select("full").distinct()
    wanted = classes.join(wanted, "full", "left_semi").select("first.doc_id", "first.key", "first.line")
    v = materialise(variants(docs, wanted), "line-variants")
    # keys that could hold a pair: a whole line and a line with a gap, or two lines with the same gap
    open_ = v.groupBy("k").agg(F.max(F.col("kind") == 0).alias("whole"), F.max(F.col("kind") == 1).alias("gap"), F.count_if(F.col("kind") == 2).alias("swaps"))
    asked = v.join(open_.filter("(whole and gap) or swaps > 1").select("k"), "k", "left_semi").drop("k").distinct()
    v = materialise(exact_variants(docs, asked).withColumn("at", order()).select("variant", "kind", "full", "at"), "line-exact")
    least = v.groupBy("variant").agg(
        F.min(F.when(F.col("kind") == 0, F.col("at"))).alias("whole"), F.min(F.when(F.col("kind") == 1, F.col("at"))).alias("gap"),
        F.min(F.when(F.col("kind") == 2, F.col("at"))).alias("swap"))
    j = v.join(least, "variant")
    hit = (F.when(F.col("kind") == 0, F.col("gap") < F.col("at")).when(F.col("kind") == 1, F.col("whole") < F.col("at"))
           .otherwise(F.col("swap") < F.col("at")))
    return j.filter(hit).select("full").distinct()


def dropped_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, key, line) of every line that an earlier one makes superfluous."""
    rows = describe(docs)
    classes = materialise(rows.groupBy("full").agg(F.min(order()).alias("first"), F.first("n").alias("n"), F.first("halves").alias("halves"))
                          .withColumn("halves", F.when(F.col("n") >= NEAR_WORDS - 1, F.col("halves"))), "line-classes")
    near = materialise(near_lines(docs, classes), "line-near").withColumn("_near", F.lit(True))
    own = rows.select("doc_id", "key", "line", "full").join(classes.select("full", "first"), "full").join(near, "full", "left")
    return own.filter(F.col("_near").isNotNull() | (order() != F.col("first"))).select("doc_id", "key", "line")


def dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 and kept (the text without the dropped lines) per document."""
    docs = docs.select("doc_id", "text", F.xxhash64("text").alias("key"))
    gone = dropped_lines(docs).groupBy("doc_id", "key").agg(F.collect_set("line").alias("lines"))
    gone = materialise(gone.select(F.col("doc_id").alias("_id"), F.col("key").alias("_key"), "lines"), "line-gone")
    rows = gone.agg(F.sum(F.size("lines"))).first()[0] or 0
    texts = attach(docs, gone, lambda d, g: (d.key == g["_key"]) & d.doc_id.eqNullSafe(g["_id"]), "left", rows=rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", SCAN_BYTES):
            out = {"n_lines": [], "n_dropped": [], "kept_sha256": [], "kept": []}
            for text, lost in zip(column(b, "text").to_pylist(), column(b, "lines").to_pylist()):
                parts = text.split("\n") if text is not None else []
                lost = set(lost or ())
                kept = "\n".join(p for i, p in enumerate(parts) if i not in lost) if text is not None else None
                out["n_lines"].append(len(parts))
                out["n_dropped"].append(len(lost))
                out["kept_sha256"].append(hashlib.sha256((kept or "").encode()).hexdigest())
                out["kept"].append(kept)
            yield pa.RecordBatch.from_arrays([column(b, "doc_id").cast(pa.int64()), pa.array(out["n_lines"], pa.int64()), pa.array(out["n_dropped"], pa.int64()),
                                              pa.array(out["kept_sha256"], pa.string()), pa.array(out["kept"], pa.string())],
                                             names=["doc_id", *out])

    return texts.select("doc_id", "text", "lines").mapInArrow(
        run, "doc_id long, n_lines long, n_dropped long, kept_sha256 string, kept string")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(read_documents(spark, sf_dir)).drop("kept")
