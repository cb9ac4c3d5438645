"""Interpolated modified Kneser-Ney over words, in shards of packed n-grams.

Words are runs of letters and digits, and single marks; each is a 64-bit hash
of its bytes, nothing is folded, and 0 stands before a text's first word. An
n-gram is the columns u, v, w (two words before, one before, the word). Every
text belongs to one of two halves by its hash. The trusted text of either half
trains the model ``m`` that scores the texts of the other half, so that no text
is scored by its own counts, and a trusted text's perplexity is comparable with
any other's.

An n-gram goes to a shard by its middle word v, where its counts, those of its
context (u, v) and those of (v, w) meet. A v with more than ``SHARD_WORDS``
occurrences is dealt over several shards by u; its counts of (v, w) are summed
up apart and sent to each of them. A shard with many n-grams to score is dealt
over parts by text, to each of which its counts go.

N-grams move as sorted, compressed blocks. The ``SHORT_CODES`` most frequent
words have short codes in them, the others their hashes; this changes sizes,
no result. Texts are scored in ``ROUNDS`` rounds, so that only a part of all
n-grams is on disk at a time; the model's counts stay as one table.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempora.llm.text import ALNUM, SPACE, U64, RollingHash, column, materialise, mix, signed, slices, text_bytes, word_spans
from tempora.session import clear_layers, files_dropped, layer_mark

#: rows of one key, and parts of all rows, beyond which the key is salted
HOT_ROWS, HOT_PARTS = 20_000, 10_000
#: words of the documents in a shard; words with a short code (broadcast); rounds of scoring
SHARD_WORDS, SHORT_CODES, ROUNDS = 2_000_000, 1_000_000, 4
#: text bytes packed at once, and hashed at once
SCAN_BYTES, HASH_BYTES = 2 << 20, 1 << 18
MARK = ~ALNUM & ~SPACE
#: a code from here on is a word's hash
HASHED = U64(1 << 63)
_C = U64(0x9E3779B97F4A7C15)

ROWS = pa.schema([("kind", pa.string()), ("s", pa.int32()), ("m", pa.int32()), ("i", pa.int64()), ("n", pa.int64()), ("block", pa.binary())])
ROWS_DDL = "kind string, s int, m int, i long, n long, block binary"


def words(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Text and hash of every word; what a byte takes is held for ``HASH_BYTES`` (or one longer text) at a time."""
    buf, offs = text_bytes(col)
    text, out, i = [np.zeros(0, np.int64)], [np.zeros(0, U64)], 0
    while i < len(offs) - 1:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + HASH_BYTES, side="right")) - 1)
        of, w = _words(buf[offs[i]:offs[j]], offs[i:j + 1] - offs[i])
        text.append(of + i)
        out.append(w)
        i = j
    return np.concatenate(text), np.concatenate(out)


def _words(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    start, end, _ = word_spans(buf, offs, ALNUM)
    marks = np.flatnonzero(MARK[buf])
    start, end = np.concatenate((start, marks)), np.concatenate((end, marks + 1))
    order = np.argsort(start, kind="stable")
    start, end = start[order], end[order]
    w = RollingHash(buf)(start, end) if len(start) else np.zeros(0, U64)
    return np.searchsorted(offs, start, side="right") - 1, w


def before(x: np.ndarray, text: np.ndarray, k: int) -> np.ndarray:
    """Of the word ``k`` places before, in the same text; else 0."""
    out = np.zeros_like(x)
    out[k:] = np.where(text[k:] == text[:-k], x[:-k], U64(0))
    return out


def hashed(*cols: np.ndarray) -> np.ndarray:
    h = np.zeros(len(cols[0]), U64)
    for x in cols:
        h = mix(h * _C + x.astype(U64))
    return h


def find(table: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``asked`` in a sorted table, and whether it is there."""
    if not len(table):
        return np.zeros(len(asked), np.int64), np.zeros(len(asked), bool)
    at = np.minimum(np.searchsorted(table, asked), len(table) - 1)
    return at, table[at] == asked


def grouped(h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order that brings equal values together, where each value starts in it, and which one each row has."""
    order = np.argsort(h)
    new = np.ones(len(h), bool)
    new[1:] = h[order[1:]] != h[order[:-1]]
    which = np.empty(len(h), np.int64)
    which[order] = np.cumsum(new) - 1
    return order, np.flatnonzero(new), which


def merged(keys: list[np.ndarray], n: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows of ``keys``, sorted, and the sum of ``n`` of each."""
    order = np.lexsort(keys[::-1])
    keys, n = [k[order] for k in keys], n[order]
    new = np.ones(len(n), bool)
    new[1:] = reduce(np.logical_or, [k[1:] != k[:-1] for k in keys])
    at = np.flatnonzero(new)
    return [k[at] for k in keys], np.add.reduceat(n, at) if len(at) else n


def packed(*cols: np.ndarray) -> bytes:
    """Columns of 64 bits, byte by byte, compressed."""
    raw = b"".join(np.ascontiguousarray(x.astype(U64, copy=False).view(np.uint8).reshape(-1, 8).T).tobytes() for x in cols)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def unpacked(blocks: list[bytes], k: int) -> list[np.ndarray]:
    parts: list[list[np.ndarray]] = [[] for _ in range(k)]
    for b in blocks:
        raw = np.frombuffer(pa.decompress(b[8:], int.from_bytes(b[:8], "little"), "zstd"), np.uint8).reshape(k, 8, -1)
        for part, x in zip(parts, raw):
            part.append(np.ascontiguousarray(x.T).reshape(-1).view(U64))
    return [np.concatenate(p) if p else np.zeros(0, U64) for p in parts]


def dealt(to: np.ndarray, near: np.ndarray, *cols: np.ndarray) -> tuple[np.ndarray, list[list[np.ndarray]]]:
    """The destinations that occur and the rows of each, with equal ``near`` (44 bits) together."""
    order = np.argsort((to.astype(U64) << U64(44)) | near, kind="stable")
    to, cols = to[order], tuple(c[order] for c in cols)
    cut = np.flatnonzero(np.concatenate(([True], to[1:] != to[:-1]))) if len(to) else np.zeros(0, np.int64)
    return to[cut], [[c[i:j] for c in cols] for i, j in zip(cut, np.append(cut[1:], len(to)))]


def near(v: np.ndarray, u: np.ndarray) -> np.ndarray:
    return (np.minimum(v, U64((1 << 22) - 1)) << U64(22)) | np.minimum(u, U64((1 << 22) - 1))


def _rows(kind: str, size: int, s=0, m=0, i=0, n=0, block: list[bytes] | None = None) -> pa.Table:
    whole = lambda x, t: pa.array(np.broadcast_to(np.asarray(x), size).astype(t))
    return pa.table([pa.array([kind] * size, pa.string()), whole(s, np.int32), whole(m, np.int32), whole(i, np.int64), whole(n, np.int64),
                     pa.array(block, pa.binary()) if block is not None else pa.nulls(size, pa.binary())], schema=ROWS)


def _sent(kind: str, to: np.ndarray, by: np.ndarray, *cols: np.ndarray) -> pa.Table:
    at, parts = dealt(to, by, *cols)
    return _rows(kind, len(at), s=at, block=[packed(*p) for p in parts])


def _repeats(kind: str, m: np.ndarray, c: np.ndarray) -> list[pa.Table]:
    """How many n-grams of either model occur once, twice, 3 and 4 times."""
    return [_rows(kind, 4, m=x, i=np.arange(1, 5), n=np.bincount(np.minimum(c[m == U64(x)], 5).astype(np.int64), minlength=6)[1:5]) for x in (0, 1)]


def _blocks(t: pa.Table, kind: str, k: int) -> list[np.ndarray]:
    return unpacked([b for x, b in zip(t.column("kind").to_pylist(), t.column("block").to_pylist()) if x == kind], k)


def lookup(rows: DataFrame, table: DataFrame, keys: list[str], sizes: DataFrame | None = None) -> DataFrame:
    """Left join with a table of distinct keys. A key with many rows (``sizes``:
    keys and rows, counted here if not given) is dealt over salts, to each of
    which the table's row goes."""
    sizes = sizes if sizes is not None else rows.groupBy(*keys).agg(F.count("*").alias("rows"))
    large = materialise(sizes.filter(F.col("rows") > HOT_ROWS).select(*keys, "rows"), "kn-large")
    total = large.agg(F.sum("rows")).first()[0]
    if total is None:
        return rows.join(table, keys, "left")
    limit = max(HOT_ROWS, total // HOT_PARTS)
    hot = F.broadcast(large.filter(F.col("rows") > limit).select(*keys, F.ceil(F.col("rows") / limit).cast("int").alias("_salts")))
    dealt = rows.join(hot, keys, "left").withColumn("_salt", F.coalesce(F.pmod(F.xxhash64(*rows.columns), F.col("_salts")).cast("int"), F.lit(0))).drop("_salts")
    wide = table.join(hot, keys, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1))).drop("_salts")
    return dealt.join(wide, [*keys, "_salt"], "left").drop("_salt")


class Plan:
    """Short codes of frequent words, and the shards of n-grams."""

    def __init__(self, vocabulary: DataFrame, per_shard: int, short: int):
        total = vocabulary.agg(F.sum("n")).first()[0] or 0
        self.shards = max(1, -(-total // per_shard))
        cut, have = None, 0
        for r in sorted(vocabulary.groupBy(F.least("n", F.lit(100_000)).alias("n")).agg(F.count("*").alias("words")).collect(), key=lambda r: -r["n"]):
            have += r["words"]
            if have > short:
                break
            cut = r["n"]
        got = vocabulary.filter(F.col("n") >= cut if cut else F.lit(False)).toArrow()
        w, n = got.column("w").to_numpy().view(U64), got.column("n").to_numpy()
        w = w[np.lexsort((w, -n))]
        order = np.argsort(w)
        self.known, self.code = w[order], (order + 1).astype(np.uint32)
        often = vocabulary.filter(F.col("n") > per_shard).toArrow()  # at most one for each shard
        v = often.column("w").to_numpy().view(U64)
        order = np.argsort(v)
        self.hot, self.ways = v[order], -(-often.column("n").to_numpy()[order] // per_shard).astype(np.int64)
        self.hot_code = self.encode(self.hot)

    def encode(self, w: np.ndarray) -> np.ndarray:
        x, back = np.unique(w, return_inverse=True)
        at, there = find(self.known, x)
        return (np.where(there, self.code[at].astype(U64), x | HASHED) if len(self.known) else x | HASHED)[back]

    def shard(self, u: np.ndarray, v: np.ndarray) -> np.ndarray:
        """Of the hashes of the two words before; ``v`` alone decides unless it is hot."""
        at, hot = find(self.hot, v)
        way = np.zeros(len(v), U64)
        way[hot] = mix(u[hot]) % self.ways[at[hot]].astype(U64)
        return self.place(v, way)

    def place(self, v: np.ndarray, way: np.ndarray) -> np.ndarray:
        return (mix(v + _C * (way + U64(1))) % U64(self.shards)).astype(np.int64)

    def bucket(self, *codes: np.ndarray) -> np.ndarray:
        return (hashed(*codes) % U64(self.shards)).astype(np.int64)


def vocabulary(docs: DataFrame) -> DataFrame:
    """(w, n): every word's hash and its occurrences."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", SCAN_BYTES):
            w, n = np.unique(words(column(b, "text"))[1], return_counts=True)
            yield pa.record_batch({"w": pa.array(signed(w)), "n": pa.array(n.astype(np.int64))})

    return docs.select("text").mapInArrow(run, "w long, n long").groupBy("w").agg(F.sum("n").alias("n"))


def counts(flagged: DataFrame, plan) -> DataFrame:
    """By shard: the counts of the trained n-grams (``model``), those of the
    lower orders as far as the shard has them (``two``: of hot words, ``one``),
    its words to score (``size``) and those of them that have no short code (``ask``)."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = plan.value
        for b in slices(batches, "text", SCAN_BYTES):
            text, w = words(column(b, "text"))
            m = (column(b, "key").to_numpy() & 1).astype(U64)[text]
            c = p.encode(w)
            s = p.shard(before(w, text, 2), before(w, text, 1))
            n = np.bincount(s, minlength=p.shards)
            yield from _rows("size", p.shards, s=np.arange(p.shards), n=n).filter(pa.array(n > 0)).to_batches()
            rare = c >= HASHED
            (to, x, k), _ = merged([s[rare], m[rare], c[rare]], np.ones(int(rare.sum()), np.int64))
            yield from _sent("ask", to, np.zeros(len(to), U64), x, k).to_batches()
            t = np.flatnonzero(column(b, "trains").to_numpy(zero_copy_only=False)[text])
            u, v, x = before(c, text, 2)[t], before(c, text, 1)[t], m[t] ^ U64(1)
            order, first, _ = grouped(hashed(x, u, v, c[t]))
            at, n = order[first], np.diff(first, append=len(order))
            yield from _sent("gram", s[t][at], near(v[at], u[at]), x[at], v[at], u[at], c[t][at], n).to_batches()

    def train(t: pa.Table) -> pa.Table:
        p, s = plan.value, t.column("s")[0].as_py()
        *keys, c = _blocks(t, "gram", 5)
        (m, v, u, w), c = merged(keys, c)
        out = [_rows("size", 1, s=s, n=sum(t.column("n").to_pylist())), *_repeats("n3", m, c)]
        if len(m):
            out.append(_rows("model", 1, s=s, block=[packed(m, v, u, w, c)]))
        (m, v, w), c = merged([m, v, w], np.ones(len(m), U64))
        hot = np.isin(v, p.hot_code)
        out += [_sent("two", p.bucket(v[hot], w[hot]), near(v[hot], w[hot]), m[hot], v[hot], w[hot], c[hot]), *_repeats("n2", m[~hot], c[~hot])]
        (m, w), c = merged([m[~hot], w[~hot]], np.ones(int((~hot).sum()), U64))
        out.append(_sent("one", p.bucket(w), near(w, m), m, w, c))
        (m, w), _ = merged(_blocks(t, "ask", 2), np.ones(len(_blocks(t, "ask", 2)[0]), U64))
        out.append(_rows("ask", len(m), s=s, m=m, i=signed(w)))
        return pa.concat_tables(out)

    return flagged.select("key", "text", "trains").mapInArrow(scan, ROWS_DDL).groupBy("s").applyInArrow(train, ROWS_DDL)


def hot_counts(two: DataFrame, plan) -> DataFrame:
    """The counts of (v, w) of hot words v, sent to each of their shards."""
    def run(t: pa.Table) -> pa.Table:
        p = plan.value
        *keys, c = _blocks(t, "two", 4)
        (m, v, w), c = merged(keys, c)
        out = _repeats("n2", m, c)
        for code in np.unique(v):
            x, at = v == code, int(np.flatnonzero(p.hot_code == code)[0])
            to = np.unique(p.place(np.full(p.ways[at], p.hot[at]), np.arange(p.ways[at]).astype(U64)))
            out.append(_rows("hot", len(to), s=to, block=[packed(m[x], v[x], w[x], c[x])] * len(to)))
        (m, w), c = merged([m, w], np.ones(len(m), U64))
        return pa.concat_tables([*out, _sent("one", p.bucket(w), near(w, m), m, w, c)])

    return two.groupBy("s").applyInArrow(run, ROWS_DDL)


def word_counts(one: DataFrame) -> DataFrame:
    """In how many contexts each word stands: of short codes in blocks (``known``), of others a row each (``rare``)."""
    def run(t: pa.Table) -> pa.Table:
        *keys, c = _blocks(t, "one", 3)
        (m, w), c = merged(keys, c)
        out = _repeats("n1", m, c)
        for x in (0, 1):
            out.append(_rows("n1", 2, m=x, i=[0, -1], n=[int((m == U64(x)).sum()), int(c[m == U64(x)].sum())]))
        k = w < HASHED
        out += [_rows("known", 1, block=[packed(m[k], w[k], c[k])]), _rows("rare", int((~k).sum()), m=m[~k], i=signed(w[~k]), n=c[~k])]
        return pa.concat_tables(out)

    return one.groupBy("s").applyInArrow(run, ROWS_DDL)


class Model:
    """What all shards share: discounts by order, and the words' own level (of short codes)."""

    def __init__(self, stats: DataFrame, known: list[bytes], codes: int):
        n = {(r["kind"], r["m"], r["i"]): r["n"] for r in stats.groupBy("kind", "m", "i").agg(F.sum("n").alias("n")).collect()}
        of = lambda k, m, i: float(n.get((f"n{k}", m, i)) or 0)
        self.off = {}
        for m in (0, 1):
            for k in (1, 2, 3):
                y = of(k, m, 1) / max(of(k, m, 1) + 2 * of(k, m, 2), 1.0)
                self.off[m, k] = np.array([0.0] + [max(0.05, min(i, i - (i + 1) * y * of(k, m, i + 1) / max(of(k, m, i), 1.0))) for i in (1.0, 2.0, 3.0)])
        self.total = [of(1, m, -1) for m in (0, 1)]
        less = [float(self.off[m, 1] @ [0, of(1, m, 1), of(1, m, 2), of(1, m, 0) - of(1, m, 1) - of(1, m, 2)]) for m in (0, 1)]
        self.low = [x / max(t, 1.0) / (of(1, m, 0) + 1) for m, (x, t) in enumerate(zip(less, self.total))]
        m, w, c = unpacked(known, 3)
        self.words = np.zeros((2, codes + 1), np.uint32 if c.max(initial=0) < 1 << 32 else U64)  # sent to every executor
        self.words[m.astype(np.int64), w.astype(np.int64)] = c

    def less(self, m: int, order: int, c: np.ndarray) -> np.ndarray:
        return np.minimum(self.off[m, order][np.minimum(c, 3).astype(np.int64)], c)


def asked(docs: DataFrame, plan, parts: np.ndarray) -> DataFrame:
    """The n-grams of the texts by part of their shard (``s``), and the keys of the block's texts."""
    first = np.cumsum(parts) - parts

    def shared(p: Plan, b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, list[list[np.ndarray]]]:
        text, w = words(column(b, "text"))
        key, of = np.unique(column(b, "key").to_numpy().view(U64), return_inverse=True)
        s = p.shard(before(w, text, 2), before(w, text, 1))
        to = first[s] + (mix(key)[of[text]] % parts[s].astype(U64)).astype(np.int64)
        w = p.encode(w)
        v, u = before(w, text, 1), before(w, text, 2)
        return key, *dealt(to, near(v, u), v, u, w, of[text].astype(U64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = plan.value
        for b in slices(batches, "text", SCAN_BYTES):
            key, at, grams = shared(p, b)
            out = {"s": pa.array(at.astype(np.int32)), "block": [], "texts": []}
            for x in grams:
                there = np.bincount(x[3].astype(np.int64), minlength=len(key)) > 0
                out["block"].append(packed(*x[:3], (np.cumsum(there) - 1)[x[3].astype(np.int64)]))
                out["texts"].append(packed(key[there]))
            size = len(at)
            yield pa.record_batch([pa.array(["asked"] * size, pa.string()), out["s"], pa.array(np.zeros(size, np.int32)), pa.array(np.zeros(size, np.int64)),
                                   pa.array(np.zeros(size, np.int64)), pa.array(out["block"], pa.binary()), pa.array(out["texts"], pa.binary())],
                                  schema=ROWS.append(pa.field("texts", pa.binary())))

    return docs.select("key", "text").mapInArrow(run, ROWS_DDL + ", texts binary")


def scored(rows: DataFrame, plan, model, buckets: int) -> DataFrame:
    """(bucket, block): each text's sum of log probabilities and its words in each part of a shard, by bucket of texts."""
    def run(t: pa.Table) -> pa.Table:
        kind = np.array(t.column("kind").to_pylist())
        keys, v, u, w, doc, have = [], [], [], [], [], 0
        for block, texts in zip(t.column("block").to_pylist(), t.column("texts").to_pylist()):
            if texts is not None:
                (k,), x = unpacked([texts], 1), unpacked([block], 4)
                for to, a in zip((keys, v, u, w, doc), (k, *x[:3], x[3] + U64(have))):
                    to.append(a)
                have += len(k)
        if not have:
            return pa.table({"bucket": pa.array([], pa.int32()), "block": pa.array([], pa.binary())})
        keys, v, u, w, doc = (np.concatenate(x) for x in (keys, v, u, w, doc))
        doc, gram = doc.astype(np.int64), hashed(v, u, w)
        of = (keys & U64(1))[doc]
        rare = np.flatnonzero(kind == "rare")
        lone = [t.column(x).to_numpy()[rare] for x in ("m", "i", "n")]
        grams, hot = _blocks(t, "model", 5), _blocks(t, "hot", 4)
        half = np.searchsorted(grams[0], U64(1))  # one block, sorted
        total, n = np.zeros(have), np.bincount(doc, minlength=have)
        for m in (0, 1):
            mine = np.flatnonzero(of == U64(m))
            if not model.value.total[m]:
                n[keys & U64(1) == U64(m)] = 0  # no text trains its model
            elif len(mine):
                order, first, back = grouped(gram[mine])
                at = mine[order[first]]
                p = _probabilities(model.value, plan.value, m, [x[half:] if m else x[:half] for x in grams[1:]], [x[hot[0] == U64(m)] for x in hot[1:]],
                                   [x[lone[0] == m] for x in lone[1:]], v[at], u[at], w[at])
                total += np.bincount(doc[mine], weights=np.log(p)[back], minlength=have)
        known, of = np.unique(keys[n > 0], return_inverse=True)  # a text comes in several blocks if it is repeated
        total, n = np.bincount(of, weights=total[n > 0], minlength=len(known)), np.bincount(of, weights=n[n > 0], minlength=len(known))
        at, sums = dealt((mix(known) % U64(buckets)).astype(np.int64), np.zeros(len(known), U64), known, total.view(U64), n.astype(np.int64).view(U64))
        return pa.table({"bucket": pa.array(at.astype(np.int32)), "block": pa.array([packed(*x) for x in sums], pa.binary())})

    return rows.groupBy("s").applyInArrow(run, "bucket int, block binary")


def summed(sums: DataFrame) -> DataFrame:
    """(key, log_ppl) from the sums of all parts."""
    def run(t: pa.Table) -> pa.Table:
        keys, s, n = unpacked(t.column("block").to_pylist(), 3)
        keys, of = np.unique(keys, return_inverse=True)
        s, n = np.bincount(of, weights=s.view(np.float64), minlength=len(keys)), np.bincount(of, weights=n.view(np.int64), minlength=len(keys))
        return pa.table({"key": pa.array(signed(keys)), "log_ppl": pa.array(-s / n)})

    return sums.groupBy("bucket").applyInArrow(run, "key long, log_ppl double").select("key", F.round("log_ppl", 9).alias("log_ppl"))


def _probabilities(model: Model, plan: Plan, m: int, grams: list[np.ndarray], hot: list[np.ndarray], lone: list[np.ndarray],
                   v: np.ndarray, u: np.ndarray, w: np.ndarray) -> np.ndarray:
    """p(w | u, v) of the asked n-grams by the counts of their shard."""
    def share(order: int, table: np.ndarray, back: np.ndarray, contexts: np.ndarray, c: np.ndarray, ask: np.ndarray, ask_context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The discounted share of its context (``back``: which), and the context's weight of the lower order."""
        less = model.less(m, order, c)
        total, off = np.bincount(back, weights=c, minlength=len(contexts)), np.bincount(back, weights=less, minlength=len(contexts))
        a, b = np.zeros(len(ask)), np.ones(len(ask))
        line = np.argsort(table)
        at, there = find(table[line], ask)
        at = line[at[there]]
        a[there] = (c[at] - less[at]) / total[back[at]]
        line = np.argsort(contexts)
        at, there = find(contexts[line], ask_context)
        at = line[at[there]]
        b[there] = off[at] / total[at]
        return a, b

    gv, gu, gw, gc = grams
    new = np.ones(len(gv), bool)
    new[1:] = (gv[1:] != gv[:-1]) | (gu[1:] != gu[:-1])  # sorted by v, u
    a3, b3 = share(3, hashed(gv, gu, gw), np.cumsum(new) - 1, hashed(gv[new], gu[new]), gc.astype(np.float64), hashed(v, u, w), hashed(v, u))
    cold = ~np.isin(gv, plan.hot_code)
    gv, gw = gv[cold], gw[cold]
    pair = hashed(gv, gw)
    order, first, _ = grouped(pair)
    at = order[first]
    v2 = np.concatenate((gv[at], hot[0]))
    known, back = np.unique(v2, return_inverse=True)
    c2 = np.concatenate((np.diff(first, append=len(order)), hot[2])).astype(np.float64)
    a2, b2 = share(2, np.concatenate((pair[at], hashed(hot[0], hot[1]))), back, known, c2, hashed(v, w), v)
    c1, short = np.zeros(len(w)), w < HASHED
    c1[short] = model.words[m][w[short].astype(np.int64)]
    order = np.argsort(lone[0].view(U64))
    at, there = find(lone[0].view(U64)[order], w[~short])
    c1[np.flatnonzero(~short)[there]] = lone[1][order][at[there]]
    p1 = (c1 - model.less(m, 1, c1)) / model.total[m] + model.low[m]
    return a3 + b3 * (a2 + b2 * p1)


def perplexities(docs: DataFrame, flagged: DataFrame) -> DataFrame:
    """(key, log_ppl): mean negative log probability per word of every text
    with a word. Equal texts share a key; their sums grow alike. ``flagged``:
    the same rows with ``trains``, whether the text trains the model."""
    spark = docs.sparkSession
    with files_dropped(spark):
        mark = layer_mark()
        made = Plan(materialise(vocabulary(docs), "kn-vocabulary"), SHARD_WORDS, SHORT_CODES)
        clear_layers(spark, mark)  # the plan holds what is needed of it
        plan = spark.sparkContext.broadcast(made)
        three = materialise(counts(flagged, plan), "kn-counts")
        two = materialise(hot_counts(three.filter("kind = 'two'"), plan), "kn-hot")
        one = materialise(word_counts(three.union(two).filter("kind = 'one'")), "kn-words")
        known = [r["block"] for r in one.filter("kind = 'known'").select("block").toLocalIterator()]  # at most SHORT_CODES words
        model = spark.sparkContext.broadcast(Model(three.union(two).union(one).filter("kind in ('n1', 'n2', 'n3')"), known, len(made.known)))
        lone = one.filter("kind = 'rare'").select("m", "i", F.col("n").alias("c"))
        lone = three.filter("kind = 'ask'").join(lone, ["m", "i"]).select("kind", "s", "m", "i", F.col("c").alias("n"), "block").withColumn("kind", F.lit("rare"))
        base = three.filter("kind = 'model'").union(two.filter("kind = 'hot'")).union(materialise(lone, "kn-rare"))
        size = np.zeros(made.shards, np.int64)
        for r in three.filter("kind = 'size'").select("s", "n").collect():  # a row for each shard
            size[r["s"]] = r["n"]
        parts = np.maximum(1, -(-2 * size // (3 * SHARD_WORDS)))
        first = np.cumsum(parts) - parts
        dests = F.broadcast(spark.createDataFrame([(s, int(first[s]), int(parts[s])) for s in range(made.shards)], "s int, first int, parts int"))
        base = materialise(base, "kn-model")  # a shard's counts once, however many parts it has
        clear_layers(spark, mark, keep=1)  # all else has been read
        base = base.join(dests, "s").select("kind", F.explode(F.sequence("first", F.col("first") + F.col("parts") - 1)).alias("s"), "m", "i", "n", "block", F.lit(None).cast("binary").alias("texts"))
        out = []
        for k in range(ROUNDS):
            mine = docs.filter(F.pmod(F.shiftright("key", 1), F.lit(ROUNDS)) == k)
            sums = scored(base.unionByName(asked(mine, plan, parts)), plan, model, 12 + made.shards // 8)
            out.append(materialise(summed(sums), "kn-perplexities"))
        return reduce(DataFrame.union, out)
