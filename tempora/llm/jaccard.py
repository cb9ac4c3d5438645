"""N-gram Jaccard join with a token-group matrix.

A document's set holds its distinct word shingles (64-bit hashes). Documents
with equal sets are one class. The join then runs on classes:

1. *Groups.* Classes whose minima under three hash orders agree are put
   together (in parts of bounded size), their exact similarities are taken
   within each part, and similar ones (well below a link) become one group
   with a pivot; pivots are grouped again under other orders. Links within a
   group are looked for among the members of a part and with its pivot.
2. *Matrix.* Each group stores the union of its members' prefix tokens, dealt
   out by token. Under one global order (hash, with frequent tokens last), two
   sets that are similar enough share tokens of their prefixes; a pair of
   groups is opened only if its overlap in the matrix reaches the least
   overlap that two of their members need (an upper bound, so no link is lost).
3. *Opening.* Pairs of groups are first checked by their pivots; then all
   members of a pair, and of each group, meet in parts of bounded size, but
   for parts that are wholly in one component already.

Frequent tokens are counted over all documents; at most ``FREQUENT`` can reach
their share of all tokens, so their table has a proven bound. They only change
the order, never the result.

Defined results: a null, empty or word-less text has an empty set, no links
and its own component; with fewer words than a shingle the whole sequence is
one; equal texts are linked; repeated rows each get their row; a null doc_id is
counted after all others (a class of null ids alone has a null component).
Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tempora.llm.components import components
from tempora.llm.text import (BYTE_CODE_LOWER, U64, WORD, RollingHash, attach, buckets_for, column, materialise, mix, pack,
                              read_documents, signed, slices, spread, text_bytes, unpack, word_spans)

#: Orders whose minima make a group key, and rounds of grouping with other orders.
MINIMA, ROUNDS = 3, 3
#: Similarity that makes a group, in percent of that of a link.
NEAR = 65
#: Members of a part, whose similarities are taken at once.
PART = 256
#: Pivots of the largest groups that all pivots of a key with many parts meet.
HUBS = 16
#: Tokens that at most can be frequent: those above 1 / FREQUENT of all.
FREQUENT = 4_000_000
#: Texts of one slice that share a token, for it to be counted.
SEEN = 2
POSTING = np.dtype([("token", "<u8"), ("group", "<i8"), ("n", "<i4"), ("place", "<i4")])
#: Tokens of an opened part whose matrix columns are in memory at once.
COLUMNS = 4096


#: Pairs held in a task before they are summed up, and postings of a bucket.
HELD, POSTINGS = 500_000, 500_000


class Rule:
    """Shingle length and similarity (percent), with the bounds they give."""

    def __init__(self, words: int, percent: int):
        self.words, self.percent = words, percent

    def prefix(self, n):
        """A similar set shares a token with the first ``prefix(n)``."""
        return n - -(-n * self.percent // 100) + 1

    def overlap(self, a, b):
        """Least intersection of similar sets of sizes a and b."""
        return -(-(a + b) * self.percent // (100 + self.percent))

    def linked(self, inter, a, b):
        return 100 * inter >= self.percent * (a + b - inter)


def shingle_sets(col: pa.Array, words: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    buf, offs = text_bytes(col)
    starts, ends, first = word_spans(buf, offs, WORD)
    h = RollingHash(buf, BYTE_CODE_LOWER)(starts, ends)
    n = np.diff(first)
    m = np.where(n >= words, n - words + 1, np.minimum(n, 1))
    at, stop = spread(first[:-1], m), np.repeat(first[1:], m)
    acc = np.zeros(len(at), U64)
    for j in range(words):
        p = at + j
        ok = p < stop
        acc[ok] = mix(acc[ok] * U64(0x9E3779B97F4A7C15) + h[p[ok]])
    cut = np.concatenate(([0], np.cumsum(m)))
    out = []
    for i, j in zip(cut[:-1], cut[1:]):
        s = np.sort(acc[i:j])
        out.append(s[np.concatenate(([True], s[1:] != s[:-1]))] if j > i else s)
    return out


def signature(s: np.ndarray) -> int:
    """Of a whole set, whatever its order."""
    return int(mix(np.array([mix(s).sum(dtype=U64) ^ U64(len(s))], U64)).view(np.int64)[0]) if len(s) else 0


def group_keys(s: np.ndarray) -> list[int]:
    """A key for every round: the minima of the set under ``MINIMA`` orders."""
    keys = []
    for r in range(ROUNDS):
        k = np.array([r + 1], U64)
        for i in range(MINIMA):
            k = mix(k + (s * U64(2 * (r * MINIMA + i) + 0x5851F42D4C957F2D)).min(keepdims=True))
        keys.append(int(k.view(np.int64)[0]))
    return keys


def describe(docs: DataFrame, rule: Rule) -> DataFrame:
    """Written once: a row per document (doc_id, n, sig, keys), and rows
    (token, seen) with kind 1 for tokens that several texts of a slice share."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            sets = shingle_sets(column(b, "text"), rule.words)
            sigs = [signature(s) for s in sets]
            keys = [group_keys(s) if len(s) else [0] * ROUNDS for s in sets]
            other = {g: s for g, s in zip(sigs, sets) if len(s)}
            tokens = np.sort(np.concatenate([np.zeros(0, U64), *other.values()]))
            cut = np.flatnonzero(np.concatenate((np.ones(min(1, len(tokens)), bool), tokens[1:] != tokens[:-1])))
            seen = np.diff(np.append(cut, len(tokens)))
            often = seen >= SEEN
            n, m = b.num_rows, int(often.sum())
            null = pa.nulls(m, pa.int64())
            yield pa.record_batch({
                "kind": pa.array([0] * n + [1] * m, pa.int32()),
                "doc_id": pa.concat_arrays([column(b, "doc_id").cast(pa.int64()), null]),
                "n": pa.array(np.append([len(s) for s in sets], seen[often]).astype(np.int64)),
                "sig": pa.array(np.append(np.array(sigs, np.int64), signed(tokens[cut][often]))),
                "keys": pa.array(keys + [None] * m, pa.list_(pa.int64()))})

    rows = docs.select("doc_id", "text").mapInArrow(run, "kind int, doc_id long, n long, sig long, keys array<long>")
    return materialise(rows, "jaccard-sets")


def frequent_tokens(rows: DataFrame) -> np.ndarray:
    total = rows.filter("kind = 0").agg(F.sum("n")).first()[0] or 0
    least = max(16, total // FREQUENT)
    got = rows.filter("kind = 1").groupBy("sig").agg(F.sum("n").alias("n")).filter(F.col("n") >= least).select("sig").toArrow()
    return np.sort(got.column("sig").to_numpy().astype(np.int64).view(U64))


# ------------------------------------------------------------- exact similarity
SET_SCHEMA = "sig long, n long, tokens binary"


def whole_sets(docs: DataFrame, wanted: DataFrame, rule: Rule, name: str) -> DataFrame:
    """The whole sets of the classes in ``wanted`` (sig, rep), from their texts, written once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            sets = shingle_sets(column(b, "text"), rule.words)
            want = column(b, "sig").to_pylist()
            hit = [(g, s) for g, s in zip(want, sets) if signature(s) == g]
            yield pa.record_batch({"sig": pa.array([g for g, _ in hit], pa.int64()), "n": pa.array([len(s) for _, s in hit], pa.int64()),
                                   "tokens": pa.array([s.tobytes() for _, s in hit], pa.binary())})

    wanted = wanted.select("sig", F.col("rep").alias("_rep"))
    texts = attach(docs.select("doc_id", "text"), wanted, lambda d, w: d.doc_id.eqNullSafe(w["_rep"]))
    return materialise(texts.select("sig", "text").mapInArrow(run, SET_SCHEMA), name)


def similar(tokens: list[np.ndarray], sizes: np.ndarray, rule: Rule) -> np.ndarray:
    """Matrix of exact links between whole sets: columns are the tokens that
    at least two of them hold, multiplied in blocks."""
    m = len(tokens)
    flat = np.concatenate(tokens)
    row = np.repeat(np.arange(m), sizes)
    order = np.argsort(flat, kind="stable")
    flat, row = flat[order], row[order]
    new = np.concatenate(([True], flat[1:] != flat[:-1]))
    col = np.cumsum(new) - 1
    many = np.bincount(col) > 1
    ok = many[col]
    col, row = (np.cumsum(many) - 1)[col[ok]], row[ok]
    inter = np.zeros((m, m), np.float64)
    for c in range(0, int(many.sum()), COLUMNS):
        i, j = np.searchsorted(col, [c, c + COLUMNS])
        block = np.zeros((m, COLUMNS), np.float32)
        block[row[i:j], col[i:j] - c] = 1
        inter += block @ block.T
    link = rule.linked(inter, sizes[:, None], sizes[None, :])
    np.fill_diagonal(link, False)
    return link


def forest(link: np.ndarray, ids: np.ndarray) -> list[tuple[int, int, int]]:
    """(id, smallest id it reaches, number of links) for every linked node."""
    most = np.iinfo(np.int64).max
    root = ids.copy()
    while True:
        least = np.minimum(root, np.where(link, root[None, :], most).min(1, initial=most))
        if (least == root).all():
            return [(int(a), int(r), int(n)) for a, r, n in zip(ids, root, link.sum(1)) if n]
        root = least


def _table(t: pa.Table) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    ids, at = np.unique(t.column("sig").to_numpy(), return_index=True)  # repeated rows have one class
    t = t.take(pa.array(at))
    ids, sizes = t.column("sig").to_numpy().astype(np.int64), t.column("n").to_numpy().astype(np.int64)
    return ids, sizes, [np.frombuffer(x.as_buffer(), U64) for x in t.column("tokens")]


EDGES = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("links", pa.int64())])


def _edges(rows: list[tuple[int, int, int]]) -> pa.Table:
    return pa.table({c: pa.array([x[i] for x in rows], pa.int64()) for i, c in enumerate(EDGES.names)}, schema=EDGES)


def link_parts(members: DataFrame, rule: Rule) -> DataFrame:
    """Edges (a, b) that span the exact links within each part of ``members`` (part, salt, sig, n, tokens)."""
    def run(t: pa.Table) -> pa.Table:
        ids, sizes, tokens = _table(t)
        return _edges(forest(similar(tokens, sizes, rule), ids) if len(ids) > 1 else [])

    return members.groupBy("part", "salt").applyInArrow(run, "a long, b long, links long")


def open_parts(sides: DataFrame, rule: Rule) -> DataFrame:
    """Edges among the members of each opened pair of parts (x, y, sx, sy, sig, n, tokens)."""
    def run(t: pa.Table) -> pa.Table:
        ids, sizes, tokens = _table(t)
        return _edges(forest(similar(tokens, sizes, rule), ids) if len(ids) > 1 else [])

    return sides.groupBy("x", "y", "sx", "sy").applyInArrow(run, "a long, b long, links long")


# ----------------------------------------------------------------- the matrix
def postings(docs: DataFrame, classes: DataFrame, rule: Rule, often: np.ndarray, tokens: int) -> DataFrame:
    """Token-group matrix: prefix tokens of every class under the global order, dealt into blocks by token."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(often)
    n_buckets = buckets_for(tokens * (100 - rule.percent + 2) // 100, POSTINGS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = shared.value
        for b in slices(batches, "text"):
            sets = shingle_sets(column(b, "text"), rule.words)
            want, group = column(b, "sig").to_pylist(), column(b, "root").to_numpy()
            rows = []
            for s, g, root in zip(sets, want, group):
                if not len(s) or signature(s) != g:
                    continue
                if len(last):
                    at = np.searchsorted(last, s)
                    hot = last[np.minimum(at, len(last) - 1)] == s
                    s = np.concatenate((s[~hot], s[hot]))
                p = s[:rule.prefix(len(s))]
                r = np.empty(len(p), POSTING)
                r["token"], r["group"], r["n"], r["place"] = p, root, len(s), np.arange(len(p))
                rows.append(r)
            if rows:
                flat = np.concatenate(rows)
                at, blocks = pack(mix(flat["token"]), flat, n_buckets)
                yield pa.record_batch({"bucket": pa.array(at.astype(np.int64)), "block": pa.array(blocks, pa.binary())})

    c = classes.select("sig", "root", F.col("rep").alias("_rep"))
    texts = attach(docs.select("doc_id", "text"), c, lambda d, w: d.doc_id.eqNullSafe(w["_rep"]))
    return texts.select("sig", "root", "text").mapInArrow(run, "bucket long, block binary")


def overlaps(matrix: DataFrame, rule: Rule) -> DataFrame:
    """(x, y, shared, px, py): pairs of groups, x < y, of fitting sizes, how
    many tokens their unions share, and the place of the last of them in
    either order (exact for groups of one)."""
    def run(t: pa.Table) -> pa.Table:
        r = unpack(t, POSTING)
        r = r[np.lexsort((r["group"], r["token"]))]
        same = (r["token"][1:] == r["token"][:-1])
        near = np.concatenate(([False], same)) | np.concatenate((same, [False]))
        r = r[near]
        out: list[np.ndarray] = []
        if len(r):
            # one row per token and group, with the sizes of the members that hold it
            first = np.flatnonzero(np.concatenate(([True], (r["token"][1:] != r["token"][:-1]) | (r["group"][1:] != r["group"][:-1]))))
            n = r["n"].astype(np.int64)
            lo, hi = np.minimum.reduceat(n, first) * rule.percent, np.maximum.reduceat(n, first) * 100
            token, g, place = r["token"][first], r["group"][first], r["place"][first].astype(np.int64)
            cut = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1])))
            run_ = np.diff(np.append(cut, len(g)))
            after = np.repeat(cut + run_, run_) - np.arange(len(g)) - 1  # later groups of the token
            at, d, held = np.flatnonzero(after > 0), 1, 0
            while len(at):  # every group against the d-th later one
                ok = (hi[at + d] >= lo[at]) & (hi[at] >= lo[at + d])
                i, j = at[ok], at[ok] + d
                out.append(np.column_stack((g[i], g[j], np.ones(len(i), np.int64), place[i], place[j])))
                held += len(out[-1])
                if held > HELD:
                    out, held = [_sum(out)], 0
                d += 1
                at = at[after[at] >= d]
        pairs = _sum(out)
        return pa.table({c: pa.array(pairs[:, i]) for i, c in enumerate(("x", "y", "shared", "px", "py"))})

    got = matrix.groupBy("bucket").applyInArrow(run, "x long, y long, shared long, px long, py long")
    return got.groupBy("x", "y").agg(F.sum("shared").alias("shared"), F.max("px").alias("px"), F.max("py").alias("py"))


def _sum(parts: list[np.ndarray]) -> np.ndarray:
    """Rows (x, y, count, place, place) brought together by (x, y)."""
    if not parts:
        return np.zeros((0, 5), np.int64)
    rows = np.concatenate(parts)
    rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
    cut = np.flatnonzero(np.concatenate((np.ones(min(1, len(rows)), bool), (rows[1:, :2] != rows[:-1, :2]).any(1))))
    if not len(cut):
        return rows
    return np.column_stack((rows[cut, :2], np.add.reduceat(rows[:, 2], cut), np.maximum.reduceat(rows[:, 3:], cut, axis=0)))


# ------------------------------------------------------------------- the join
def _rooted(groups: DataFrame, edges: DataFrame) -> DataFrame:
    """(sig, ..., root) after the roots that ``edges`` join become one group;
    its new root is the class with most links, which a family of copies of
    one text needs to stay together."""
    cc = components(edges, "a", "b")
    links = edges.groupBy(F.col("a").alias("node")).agg(F.max("links").alias("_l"))
    cc = materialise(cc.join(links, "node", "left").withColumn("_l", F.coalesce("_l", F.lit(0))), "jaccard-merged")
    pivot = cc.groupBy("root").agg(F.max_by("node", F.struct("_l", "node")).alias("_new"))
    cc = cc.join(pivot, "root").select("node", "_new")
    return materialise(groups.join(cc, groups["root"] == cc.node, "left").withColumn("root", F.coalesce("_new", "root")).drop("node", "_new"), "jaccard-roots")


def regroup(grouped: DataFrame, held: DataFrame, r: int, rule: Rule) -> DataFrame:
    """One round of grouping by the ``r``-th keys of the pivots. A key with
    more than ``PART`` pivots is dealt into parts at random; then all its
    pivots meet those of its largest groups."""
    for again in (False, True):
        size = grouped.groupBy("root").agg(F.count("*").alias("_size"))
        pivots = grouped.filter("sig = root").select("sig", "root", F.col("keys")[r].alias("part")).join(size, "root")
        count = pivots.groupBy("part").agg(F.count("*").alias("_c")).filter(F.col("_c") > (PART if again else 1))
        if again and count.isEmpty():
            break
        salted = materialise(pivots.join(count, "part").withColumn("salt", F.pmod(F.xxhash64("sig", F.lit(r)), F.ceil(F.col("_c") / PART)))
                             .select(F.col("sig").alias("_sig"), "part", "salt", "_size"), "jaccard-pivots")
        meet = salted.select("_sig", "part", "salt")
        if again:
            hubs = salted.groupBy("part", (F.col("salt") % HUBS).alias("_h")).agg(F.max_by("_sig", F.struct("_size", "_sig")).alias("_sig"))
            meet = meet.unionByName(salted.select("part", "salt").distinct().join(hubs, "part").select("_sig", "part", "salt"))
        edges = materialise(link_parts(attach(held, materialise(meet, "jaccard-meet"), lambda h, s: h.sig == s["_sig"]), rule), "jaccard-links")
        if not edges.isEmpty():
            grouped = _rooted(grouped, edges)
    return grouped


def within(grouped: DataFrame, held: DataFrame, rule: Rule) -> DataFrame:
    """Exact links inside each group, as far as they show among the members of
    a part and with the group's pivot: linear in the group's size."""
    big = grouped.groupBy("root").agg(F.count("*").alias("_c")).filter("_c > 1")
    parts = F.ceil(F.col("_c") / PART)
    m = grouped.join(big, "root").withColumn("salt", F.pmod(F.xxhash64("sig"), parts))
    meet = m.select(F.col("sig").alias("_sig"), F.col("root").alias("part"), "salt").unionByName(
        m.filter("sig = root").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
        .select(F.col("sig").alias("_sig"), F.col("root").alias("part"), "salt"))
    meet = materialise(meet, "jaccard-within")
    return materialise(link_parts(attach(held, meet, lambda h, s: h.sig == s["_sig"]), rule), "jaccard-inner-links")


def parts_of(members: DataFrame) -> DataFrame:
    """(sig, g, comp, part, pure): the members of each group g in parts of about
    ``PART``. A component with that many members has parts of its own
    (``pure`` is its root there), the others share parts."""
    cell = members.groupBy("g", "comp").agg(F.count("*").alias("_n"))
    # only large components and groups need their sizes: at most one of either for every PART members,
    # so the members of a hot group stay where they are
    large = materialise(cell.filter(F.col("_n") >= PART).select(F.col("g").alias("_g"), F.col("comp").alias("pure"), "_n"), "jaccard-cells")
    pool = cell.filter(F.col("_n") < PART).groupBy(F.col("g").alias("_h")).agg(F.sum("_n").alias("_pool"))
    pool = materialise(pool.filter(F.col("_pool") > PART), "jaccard-pools")
    m = attach(members, large, lambda x, c: (x.g == c["_g"]) & (x.comp == c["pure"]), "left")
    m = attach(m, pool, lambda x, c: (x.g == c["_h"]) & x["pure"].isNull(), "left")
    n = F.ceil(F.coalesce("_n", "_pool", F.lit(1).cast("long")) / PART)
    return m.select("sig", "g", "comp", "pure", F.xxhash64("pure", F.pmod(F.xxhash64("sig"), n)).alias("part"))


def clusters(docs: DataFrame, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The documents' sets (doc_id, n, sig), and per class of equal sets (sig)
    its smallest doc_id (rep) and its component (root)."""
    rule, near = Rule(words, percent), Rule(words, percent * NEAR // 100)
    rows = describe(docs, rule)
    often = frequent_tokens(rows)
    sets = rows.filter("kind = 0")
    classes = materialise(sets.filter("n > 0").groupBy("sig").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"),
                                                                  F.first("keys").alias("keys")), "jaccard-classes")
    tokens = classes.agg(F.sum("n")).first()[0] or 0

    # 1. groups of similar classes, round by round, and the links that show within them
    grouped = classes.withColumn("root", F.col("sig"))
    alike = None
    for r in range(ROUNDS):
        key = F.col("keys")[r]
        k = classes.select(key.alias("part")).groupBy("part").count().filter("count > 1").select("part")
        k = classes.select("sig", "rep", key.alias("part")).join(k, "part", "left_semi").select("sig", "rep")
        alike = k if alike is None else alike.unionByName(k)
    wanted = materialise(alike.distinct(), "jaccard-shared")
    held = whole_sets(docs, wanted, rule, "jaccard-held")
    for r in range(ROUNDS):
        grouped = regroup(grouped, held, r, near)
    edges = within(grouped, held, rule).select("a", "b")

    # 2. the matrix: pairs of groups that could hold a link
    groups = grouped.groupBy("root").agg(F.min("n").alias("lo"), F.max("n").alias("hi"), F.count("*").alias("size"))
    groups = materialise(groups, "jaccard-groups")
    gx = groups.select(F.col("root").alias("x"), F.col("lo").alias("lx"), F.col("hi").alias("hx"), F.col("size").alias("cx"))
    gy = groups.select(F.col("root").alias("y"), F.col("lo").alias("ly"), F.col("hi").alias("hy"), F.col("size").alias("cy"))
    rest = lambda c: F.ceil(F.col(c) * percent / 100) - 1  # noqa: E731  tokens beyond the prefix
    # what can still follow: tokens beyond the prefix that ends first, and of two
    # single sets also no more than the tokens after their last common prefix token
    beyond = F.greatest(rest("hx"), rest("hy"))
    after = (F.when((F.col("cx") == 1) & (F.col("cy") == 1), F.least(beyond, F.col("lx") - 1 - F.col("px"), F.col("ly") - 1 - F.col("py")))
             .otherwise(beyond))
    need = F.ceil((F.col("lx") + F.col("ly")) * percent / (100 + percent))
    pairs = (overlaps(postings(docs, grouped, rule, often, tokens), rule)
             .join(gx, "x").join(gy, "y").filter(F.col("shared") + after >= need).select("x", "y"))
    pairs = materialise(pairs, "jaccard-pairs")

    # 3. open them: pivots first
    reps = grouped.select("sig", "rep", "root")
    both = pairs.select(F.col("x").alias("root")).unionByName(pairs.select(F.col("y").alias("root"))).distinct()
    need_sets = reps.join(both, "root", "left_semi").join(wanted.select("sig"), "sig", "left_anti")
    held = held.unionByName(whole_sets(docs, materialise(need_sets, "jaccard-wanted"), rule, "jaccard-opened"))
    side = lambda c, i: pairs.select("x", "y", F.lit(0).alias("sx"), F.lit(0).alias("sy"), F.lit(i).alias("side"), F.col(c).alias("_sig"))
    sides = materialise(side("x", 0).unionByName(side("y", 1)), "jaccard-sides")
    edges = edges.unionByName(materialise(open_parts(attach(held, sides, lambda h, s: h.sig == s["_sig"]), rule), "jaccard-opened-pivots").select("a", "b"))

    # then every part of a group against every part of the other, or of its own, but for parts of one component
    now = materialise(components(edges, "a", "b"), "jaccard-connected")
    big = groups.filter("size > 1").select(F.col("root").alias("x"), F.col("root").alias("y"))
    some = groups.filter("size > 1").select("root")
    more = pairs.join(some.select(F.col("root").alias("x")), "x", "left_semi").select("x", "y").unionByName(
        pairs.join(some.select(F.col("root").alias("y")), "y", "left_semi").select("x", "y")).distinct().unionByName(big)
    member = reps.join(now.withColumnRenamed("root", "_comp"), reps.sig == F.col("node"), "left")
    member = member.select("sig", F.col("root").alias("g"), F.coalesce("_comp", "sig").alias("comp"))
    member = materialise(parts_of(member), "jaccard-parts")
    part = member.groupBy("g", "part", "pure").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1"))
    px = part.select(F.col("g").alias("x"), F.col("part").alias("sx"), F.col("c0").alias("x0"), F.col("c1").alias("x1"))
    py = part.select(F.col("g").alias("y"), F.col("part").alias("sy"), F.col("c0").alias("y0"), F.col("c1").alias("y1"))
    meet = (more.join(px, "x").join(py, "y").filter((F.col("x") != F.col("y")) | (F.col("sx") <= F.col("sy")))
            .filter(~((F.col("x0") == F.col("x1")) & (F.col("y0") == F.col("y1")) & (F.col("x0") == F.col("y0")))).select("x", "y", "sx", "sy"))
    meet = materialise(meet, "jaccard-meet")
    mine = lambda g, s, i: meet.join(member, (F.col(g) == F.col("g")) & (F.col(s) == F.col("part"))).select(
        "x", "y", "sx", "sy", F.lit(i).alias("side"), F.col("sig").alias("_sig"))
    last = materialise(mine("x", "sx", 0).unionByName(mine("y", "sy", 1)).distinct(), "jaccard-members")
    late = materialise(open_parts(attach(held, last, lambda h, s: h.sig == s["_sig"]), rule), "jaccard-opened-members").select("a", "b")

    final = components(now.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(late), "a", "b").withColumnRenamed("root", "_new")
    out = reps.select("sig").join(final, F.col("sig") == final.node, "left").select("sig", F.coalesce("_new", "sig").alias("root"))
    out = materialise(out, "jaccard-components")
    return sets, materialise(classes.select("sig", "rep").join(out, "sig"), "jaccard-ids")


def join(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id reachable by
    links) and class_id (the smallest doc_id with an equal set) per document."""
    sets, ids = clusters(docs, words, percent)
    least = ids.groupBy("root").agg(F.min("rep").alias("component_id"))
    ids = ids.join(least, "root").select("sig", F.col("rep").alias("class_id"), "component_id")
    full = F.col("n_shingles") > 0
    return (sets.select("doc_id", F.col("n").alias("n_shingles"), "sig").join(ids, "sig", "left")
            .select("doc_id", "n_shingles", F.when(full, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
                    F.when(full, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id")))


def unique_documents(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One document of each component, that of the smallest doc_id (of rows
    that share it and the set, the smallest text); all documents with an empty
    set. The columns of ``docs``."""
    rule = Rule(words, percent)
    sets, ids = clusters(docs, words, percent)
    first = ids.groupBy("root").agg(F.min(F.struct(F.col("rep").isNull().alias("last"), "rep", "sig")).alias("f")).select("f.rep", "f.sig")
    rows = sets.groupBy("doc_id", "sig").agg(F.count("*").alias("rows"))
    chosen = first.join(rows, (F.col("doc_id").eqNullSafe(F.col("rep"))) & (rows.sig == first.sig)).select(F.col("rep").alias("_rep"), first.sig.alias("_sig"), "rows")
    chosen = materialise(chosen.unionByName(rows.filter("sig = 0").select(F.col("doc_id").alias("_rep"), F.col("sig").alias("_sig"), F.lit(1).cast("long").alias("rows"))), "jaccard-chosen")
    texts = attach(docs.select(F.struct("*").alias("_row")), chosen, lambda d, c: d["_row"]["doc_id"].eqNullSafe(c["_rep"]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "_row.text"):
            sig = np.array([signature(s) for s in shingle_sets(column(b, "_row.text"), rule.words)], np.int64)
            yield b.filter(pa.array(sig == column(b, "_sig").to_numpy()))

    texts = texts.select("_row", "_rep", "_sig", "rows")
    kept = texts.mapInArrow(run, texts.schema)
    if chosen.filter("rows > 1").isEmpty():
        return kept.select("_row.*")
    again = kept.filter("rows > 1").withColumn("_n", F.row_number().over(Window.partitionBy("_rep", "_sig").orderBy("_row.text"))).filter("_n = 1")
    return kept.filter("rows = 1").select("_row.*").unionByName(again.select("_row.*"))


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(read_documents(spark, sf_dir), words=4, percent=85)
