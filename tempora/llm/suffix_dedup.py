"""Removal of long repeated byte strings by blockwise suffix sorting.

A byte goes if a string of ``length`` bytes that covers it also starts
anywhere else. The suffixes to compare are those that start a window of
``length`` bytes; they are dealt into buckets and sorted one bucket at a time:

1. *Cover.* Every window holds one designated anchor: its least ``GRAM``-byte
   gram (leftmost if tied), chosen by content alone, so equal windows have it
   at equal offsets. Anchors are the bucket keys; about one byte in 80 is one.
   Windows that share an anchor form a run; a run whose anchor is nowhere else
   holds no repeat and is done. Runs of one anchor with equal bytes are
   repeats as they stand, and one of them stands for all from here on.
2. *Buckets.* Only runs that share an anchor with a different run ship their
   bytes. Within a bucket all suffixes of one anchor are aligned, so the
   difference of two suffixes' places is 0 and the positions = 0 modulo
   ``PERIOD`` from the anchor are a difference cover. Their ranks by 32, 64
   and 128 bytes are computed first; suffixes are then sorted by anchor,
   offset and leading bytes, and ties beyond are resolved by the ranks of
   their first cover positions, never by reading on. A bucket's memory is
   bounded by the runs dealt to it; an anchor of more than ``HOT_RUNS`` opened
   runs goes to no bucket: its windows are dealt by offset and bytes. Step 1
   still takes all runs of an anchor (36 bytes each) in one task.
3. Neighbours that agree on ``length`` bytes are repeats.

Texts stay where they are: their spans come back by a size-checked join.

Defined results: null is empty; texts shorter than ``length`` lose nothing;
equal texts of at least that length lose everything, repeated rows included;
matches never cross documents; empty tables give empty results. Other columns
are not read. Texts are told apart by a 64-bit hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.llm.kneser_ney import lookup
from tempora.llm.text import (BROADCAST_ROWS, BYTE_CODE, U64, RollingHash, attach, buckets_for, column, materialise, mix, pack, read_documents, signed,
                              slices, spread, text_bytes, unpack)

LENGTH = 200
GRAM = 40
PERIOD = 32
#: Bytes whose windows are designated at once (some 100 bytes of memory each), and bits for a place in them.
PIECE, PLACE_BITS = 1 << 18, 24
#: Runs that one sorted bucket holds on average.
RUNS_PER_BUCKET = 5_000
#: Opened runs of one anchor beyond which its windows are dealt one by one.
HOT_RUNS = 5_000

RUN = np.dtype([("anchor", "<u8"), ("bytes", "<u8"), ("text", "<i8"), ("start", "<u4"), ("n", "<u2"), ("off", "<u2")])


def _least(key: np.ndarray, width: int) -> np.ndarray:
    """Sliding minimum over ``width`` entries."""
    m, w = key, 1
    while 2 * w <= width:
        m = np.minimum(m[:-w], m[w:])
        w *= 2
    return np.minimum(m[:len(key) - width + 1], m[width - w:]) if width > w else m


def pieces(offs: np.ndarray) -> Iterator[tuple[int, int]]:
    """Texts as pieces of at most ``PIECE`` bytes: several whole ones, or a part
    of a longer one, cut at places of its own, so that equal texts are cut alike."""
    i = 0
    while i < len(offs) - 1:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + PIECE, side="right")) - 1)
        for lo in range(int(offs[i]), int(offs[j]), PIECE):
            yield lo, min(lo + PIECE, int(offs[j]))
        i = j


def runs(buf: np.ndarray, offs: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Of all texts: the runs of windows with one anchor, and each run's text."""
    width = length - GRAM + 1
    out, owner = [], []
    for lo, hi in pieces(offs):
        piece = buf[lo:hi + length - 1]
        if len(piece) < length:
            continue
        h = RollingHash(piece)
        at = np.arange(len(piece) - GRAM + 1)
        gram = h(at, at + GRAM)
        key = (gram & ~U64((1 << PLACE_BITS) - 1)) | at.astype(U64)
        low = _least(key, width)
        anchor = (low & U64((1 << PLACE_BITS) - 1)).astype(np.int64)
        start = np.arange(len(anchor)) + lo
        text = np.searchsorted(offs, start, side="right") - 1
        ok = (start + length <= offs[text + 1]) & (start < hi)
        start, text, anchor = start[ok] - lo, text[ok], anchor[ok]
        if not len(start):
            continue
        cut = np.flatnonzero(np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1]) | (start[1:] != start[:-1] + 1))))
        n = np.diff(np.append(cut, len(start)))
        r = np.zeros(len(cut), RUN)
        first, c = start[cut], anchor[cut]
        r["anchor"], r["n"], r["off"] = gram[c], n, c - first
        r["bytes"] = mix(h(first, first + n - 1 + length) + (c - first).astype(U64) * U64(0x10001) + n.astype(U64))
        r["start"] = first + lo - offs[text[cut]]
        out.append(r)
        owner.append(text[cut])
    if not out:
        return np.zeros(0, RUN), np.zeros(0, np.int64)
    return np.concatenate(out), np.concatenate(owner)


def describe(docs: DataFrame, length: int, buckets: int) -> DataFrame:
    """Blocks of runs by bucket of their anchor."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            buf, offs = text_bytes(column(b, "text"))
            r, owner = runs(buf, offs, length)
            if len(r):
                r["text"] = column(b, "key").to_numpy()[owner]
                at, blocks = pack(mix(r["anchor"]), r, buckets)
                yield pa.record_batch({"bucket": pa.array(at), "block": pa.array(blocks, pa.binary())})

    return docs.mapInArrow(run, "bucket long, block binary")


def shared_runs(blocks: DataFrame) -> DataFrame:
    """Runs whose anchor is not alone: ``same`` if another run has the same
    bytes, ``open`` if it stands for its bytes among others of the anchor."""
    def run(t: pa.Table) -> pa.Table:
        r = unpack(t, RUN)
        r = r[np.lexsort((r["start"], r["text"], r["bytes"], r["anchor"]))]
        new = np.ones(len(r), bool)
        new[1:] = (r["anchor"][1:] != r["anchor"][:-1]) | (r["bytes"][1:] != r["bytes"][:-1]) | (r["text"][1:] != r["text"][:-1]) | (r["start"][1:] != r["start"][:-1])
        r = r[new]  # the runs of equal texts count once
        a = np.ones(len(r), bool)
        a[1:] = r["anchor"][1:] != r["anchor"][:-1]
        b = a.copy()
        b[1:] |= r["bytes"][1:] != r["bytes"][:-1]
        kind = np.cumsum(b) - 1
        same = np.bincount(kind)[kind] > 1 if len(r) else a
        kinds = np.bincount((np.cumsum(a) - 1)[b]) if len(r) else np.zeros(0, np.int64)
        open_ = b & (kinds[np.cumsum(a) - 1] > 1) if len(r) else a
        ok = same | open_
        r = r[ok]
        return pa.table({"same": pa.array(same[ok]), "open": pa.array(open_[ok]), "anchor": pa.array(signed(r["anchor"])), "key": pa.array(r["text"]),
                         "start": pa.array(r["start"].astype(np.int64)), "n": pa.array(r["n"].astype(np.int64)), "off": pa.array(r["off"].astype(np.int64))})

    return blocks.groupBy("bucket").applyInArrow(run, "same boolean, open boolean, anchor long, key long, start long, n long, off long")


def ship(docs: DataFrame, opened: DataFrame, length: int, rows: int) -> DataFrame:
    """The bytes of every opened run, from one text of each key."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            buf, offs = text_bytes(column(b, "text"))
            lists = column(b, "runs")
            flat = lists.flatten()
            count = np.diff(lists.offsets.to_numpy())
            f = {c: flat.field(c).to_numpy() for c in ("anchor", "start", "n", "off")}
            at = np.repeat(offs[:-1], count) + f["start"]
            stop = at + f["n"] - 1 + length
            yield pa.record_batch({"anchor": pa.array(f["anchor"]), "key": pa.array(np.repeat(column(b, "key").to_numpy(), count)),
                                   **{c: pa.array(f[c]) for c in ("start", "n", "off")},
                                   "bytes": pa.array([buf[i:j].tobytes() for i, j in zip(at, stop)], pa.binary())})

    lists = opened.groupBy("key", "rep").agg(F.collect_list(F.struct("anchor", "start", "n", "off")).alias("runs"))
    lists = materialise(lists.select(F.col("key").alias("_key"), F.col("rep").alias("_rep"), "runs"), "suffix-opened")
    texts = attach(docs, lists, lambda d, o: (d.key == o["_key"]) & d.doc_id.eqNullSafe(o["_rep"]), rows=rows)
    return texts.select("key", "runs", "text").mapInArrow(run, "anchor long, key long, start long, n long, off long, bytes binary")


def _words(buf: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Eight bytes from each place, as big-endian numbers."""
    w = np.zeros(len(at), U64)
    for j in range(8):
        w = (w << U64(8)) | buf[at + j]
    return w


def _rank(cols: list[np.ndarray]) -> np.ndarray:
    order = np.lexsort(cols[::-1])
    new = np.zeros(len(order), bool)
    for c in cols:
        s = c[order]
        new[1:] |= s[1:] != s[:-1]
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(new)
    return rank


def repeated(anchor: np.ndarray, n: np.ndarray, off: np.ndarray, pieces: list[bytes], length: int) -> np.ndarray:
    """Sorts a bucket's suffixes; for every window (run by run) whether it agrees with a neighbour on ``length`` bytes."""
    size = np.array([len(p) for p in pieces], np.int64)
    base = np.cumsum(size) - size
    buf = np.frombuffer(b"".join(pieces), np.uint8)
    # cover sample: PERIOD bytes from every place = 0 modulo PERIOD from the anchor
    lead = off % PERIOD
    blocks = (size - lead) // PERIOD
    first = np.cumsum(blocks) - blocks
    at = np.repeat(base + lead - first * PERIOD, blocks) + np.arange(int(blocks.sum())) * PERIOD
    rank = {PERIOD: _rank([_words(buf, at + j) for j in range(0, PERIOD, 8)])}
    w = PERIOD
    while w < 128:  # a rank is only read where its bytes are all in the piece
        nxt = np.minimum(np.arange(len(at)) + w // PERIOD, len(at) - 1)
        rank[2 * w] = _rank([rank[w], rank[w][nxt]])
        w *= 2
    run = np.repeat(np.arange(len(n)), n)
    j = np.arange(len(run)) - np.repeat(np.cumsum(n) - n, n)
    s = base[run] + j
    skip = (lead[run] - j) % PERIOD
    q = first[run] + (j + skip - lead[run]) // PERIOD
    assert length >= 128 + 2 * PERIOD
    _, order_of = np.unique(anchor, return_inverse=True)
    cols = [order_of[run] * 512 + (off[run] - j + 256),           # anchor and offset
            _words(buf, s),                                        # leading bytes
            rank[128][q], rank[PERIOD][q + 128 // PERIOD]]         # then the cover
    cols += [_words(buf, s + k) for k in range(8, PERIOD, 8)]
    cols += [_words(buf, s + k) for k in range(128 + PERIOD, length - 7, 8)] + [_words(buf, s + length - 8)]
    order = np.lexsort(cols[::-1])
    same = np.ones(len(order) - 1, bool)
    for c in cols:
        x = c[order]
        same &= x[1:] == x[:-1]
    out = np.zeros(len(order), bool)
    out[order[1:]] |= same
    out[order[:-1]] |= same
    return out


def sorted_buckets(pieces: DataFrame, length: int, buckets: int) -> DataFrame:
    """(key, start, stop): bytes of the opened runs covered by repeated windows."""
    def run(t: pa.Table) -> pa.Table:
        c = {k: t.column(k).to_numpy() for k in ("anchor", "key", "start", "n", "off")}
        once = np.unique(np.stack([c["anchor"], c["key"], c["start"]], 1), axis=0, return_index=True)[1]  # repeated rows
        c = {k: v[once] for k, v in c.items()}
        blob = t.column("bytes").take(pa.array(once)).to_pylist()
        hit = repeated(c["anchor"], c["n"], c["off"], blob, length)
        own = np.repeat(np.arange(len(c["n"])), c["n"])
        j = np.arange(len(own)) - np.repeat(np.cumsum(c["n"]) - c["n"], c["n"])
        own, j = own[hit], j[hit]
        cut = np.flatnonzero(np.concatenate((np.ones(min(1, len(j)), bool), (own[1:] != own[:-1]) | (j[1:] != j[:-1] + 1))))
        last = np.append(cut[1:], len(j)) - 1 if len(cut) else cut
        at = c["start"][own[cut]]
        return pa.table({"key": pa.array(c["key"][own[cut]]), "start": pa.array(at + j[cut]), "stop": pa.array(at + j[last] + length)})

    return (pieces.withColumn("bucket", F.pmod(F.xxhash64("anchor"), F.lit(buckets))).groupBy("bucket")
            .applyInArrow(run, "key long, start long, stop long"))


def dealt_windows(pieces: DataFrame, length: int) -> DataFrame:
    """(key, start, stop) of the repeated windows among the runs of hot anchors.

    Windows can only be equal at one offset from one anchor: they are dealt by
    anchor, offset and two 64-bit hashes of all their bytes, and met again with
    what is known of their kind; kinds of many windows are salted."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "bytes"):
            c = {k: column(b, k).to_numpy() for k in ("anchor", "key", "start", "n", "off")}
            buf, offs = text_bytes(column(b, "bytes"))
            own = np.repeat(np.arange(b.num_rows), c["n"])
            j = np.arange(len(own)) - np.repeat(np.cumsum(c["n"]) - c["n"], c["n"])
            at = offs[own] + j
            yield pa.record_batch({"anchor": pa.array(c["anchor"][own]), "place": pa.array(c["off"][own] - j),
                                   "h": pa.array(signed(RollingHash(buf)(at, at + length))), "g": pa.array(signed(RollingHash(buf, mix(BYTE_CODE))(at, at + length))),
                                   "key": pa.array(c["key"][own]), "start": pa.array(c["start"][own] + j)})

    kind = ["anchor", "place", "h", "g"]
    windows = materialise(pieces.mapInArrow(run, "anchor long, place long, h long, g long, key long, start long"), "suffix-windows")
    where = F.struct("key", "start")  # repeated rows of a text are one place
    kinds = windows.groupBy(*kind).agg(F.min(where).alias("lo"), F.max(where).alias("hi"), F.count("*").alias("rows")).filter("lo <> hi")
    kinds = materialise(kinds.select(*kind, "rows"), "suffix-kinds")
    hit = lookup(windows, kinds.select(*kind, F.lit(True).alias("hit")), kind, kinds).filter("hit")
    return hit.select("key", "start", (F.col("start") + length).alias("stop")).distinct()


def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each key's sorted spans, overlapping and touching ones as one."""
    for b in batches:
        lists = column(b, "spans")
        flat = lists.flatten()
        start, stop = flat.field("start").to_numpy(), flat.field("stop").to_numpy()
        cut = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        out = []
        for i, j in zip(cut[:-1], cut[1:]):
            reach = np.maximum.accumulate(stop[i:j])
            new = np.flatnonzero(np.concatenate(([True], start[i + 1:j] > reach[:-1])))
            out.append([{"start": x, "stop": y} for x, y in zip(start[i:j][new].tolist(), reach[np.append(new[1:], j - i) - 1].tolist())])
        yield pa.RecordBatch.from_arrays([column(b, "key"), pa.array(out, lists.type)], names=["key", "spans"])


def find(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Per text key with anything to remove: key, whole, spans (start, stop)."""
    size = docs.agg(F.sum(F.length(F.col("text").cast("binary")))).first()[0] or 0
    blocks = describe(docs.select("key", "text"), length, buckets_for(size // 60, 400_000))
    found = materialise(shared_runs(blocks), "suffix-runs")
    texts = docs.groupBy("key").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"),
                                    F.max(F.length(F.col("text").cast("binary"))).alias("n_bytes"))
    texts = materialise(texts.filter(F.col("n_bytes") >= length), "suffix-texts")
    opened = found.filter("open").join(texts, "key").select("key", "rep", "anchor", "start", "n", "off")
    n_open = found.filter("open").count()
    hot = materialise(found.filter("open").groupBy("anchor").count().filter(F.col("count") > HOT_RUNS).select("anchor"), "suffix-hot")
    n_hot = hot.count()
    if n_hot:
        side = F.broadcast(hot.withColumn("hot", F.lit(True))) if n_hot <= BROADCAST_ROWS else hot.withColumn("hot", F.lit(True))
        opened = materialise(opened.join(side, "anchor", "left"), "suffix-open")
        many, opened = opened.filter("hot"), opened.filter("hot is null").drop("hot")
    pieces = ship(docs, opened, length, n_open)
    late = sorted_buckets(pieces, length, buckets_for(n_open, RUNS_PER_BUCKET))
    if n_hot:
        late = late.unionByName(dealt_windows(ship(docs, many.drop("hot"), length, n_open), length))
    spans = found.filter("same").select("key", "start", (F.col("start") + F.col("n") - 1 + length).alias("stop")).unionByName(late)
    spans = spans.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("spans"))
    spans = spans.mapInArrow(joined, "key long, spans array<struct<start:bigint,stop:bigint>>")
    # a text that stands twice goes as a whole; the others by their spans
    whole = texts.filter("copies > 1").select("key", F.lit(True).alias("whole"), F.lit(None).cast("array<struct<start:bigint,stop:bigint>>").alias("spans"))
    part = spans.join(texts.filter("copies > 1").select("key"), "key", "left_anti").select("key", F.lit(False).alias("whole"), "spans")
    return materialise(whole.unionByName(part), "suffix-spans")


def keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("key"))


def cut(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, removed (the maximal
    runs, as start and stop) and kept (the remaining bytes) per document."""
    docs = keyed(docs)
    spans = find(docs, length)
    rows = spans.agg(F.sum(F.lit(1) + F.coalesce(F.size("spans"), F.lit(0)))).first()[0] or 0
    small = spans.select(F.col("key").alias("_key"), "whole", "spans")
    texts = attach(docs, small, lambda d, s: d.key == s["_key"], "left", rows=rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            buf, offs = text_bytes(column(b, "text"))
            whole, lists = column(b, "whole").to_pylist(), column(b, "spans")
            out = {"n_bytes": np.diff(offs), "n_removed": [], "n_spans": [], "kept_sha256": [], "removed": [], "kept": []}
            for i in range(b.num_rows):
                data = buf[offs[i]:offs[i + 1]]
                gone: list[list[int]] = [[0, len(data)]] if whole[i] else []
                s = lists[i].values if lists[i].is_valid else None
                if s is not None:
                    for lo, hi in zip(s.field("start").to_pylist(), s.field("stop").to_pylist()):
                        if gone and lo <= gone[-1][1]:
                            gone[-1][1] = max(gone[-1][1], hi)
                        else:
                            gone.append([lo, hi])
                keep = np.ones(len(data), bool)
                for lo, hi in gone:
                    keep[lo:hi] = False
                kept = (data[keep] if gone else data).tobytes()
                out["n_removed"].append(len(data) - len(kept))
                out["n_spans"].append(len(gone))
                out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
                out["removed"].append([{"start": x, "stop": y} for x, y in gone])
                out["kept"].append(kept)
            kinds = {"n_bytes": pa.int64(), "n_removed": pa.int64(), "n_spans": pa.int64(), "kept_sha256": pa.string(),
                     "removed": pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])), "kept": pa.binary()}
            yield pa.RecordBatch.from_arrays([column(b, "doc_id").cast(pa.int64())] + [pa.array(out[c], k) for c, k in kinds.items()], names=["doc_id", *kinds])

    return texts.select("doc_id", "text", "whole", "spans").mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, removed array<struct<start:bigint,stop:bigint>>, kept binary")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cut(read_documents(spark, sf_dir)).drop("removed", "kept")
