"""Exact top-k search by inner product with MaxScore.

The terms of a query are the vector's components; a shard's postings of a term
are its rows with their contributions. Contributions are taken above the
shard's least one for the term, so they are not negative, and the shard's
largest bounds them. With a threshold (the k-th best score found so far), the
terms split: the non-essential ones are the longest tail, by bound, whose sum
of bounds cannot lift a row above the threshold on its own. The essential
postings are traversed for all rows; the others are probed, largest bound
first, for rows that are still competitive. Bounds never exclude a row that
could tie, so results are exact; shards give at most k rows per query, which
are merged by a last top-k.

The queries are a stated set; they meet the shards in blocks (``QUERY_BLOCK``
by ``SHARD_ROWS`` rows), never as single pairs.

Defined results: vectors that are null or hold null or non-finite components
take no part; vectors of different lengths are padded with zeros, so an empty
one scores 0; a null
vec_id is never a query and no candidate; rows with the query's vec_id are the
query's own; with fewer than k candidates all are returned; ties go to the
smaller vec_id. Repeated rows are candidates as often as they stand; a query
id that repeats asks once, with its smallest vector. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tempora.llm.text import column, materialise, read_documents

K = 10
SCALE = 1024
SHARD_ROWS, QUERY_BLOCK = 8192, 512
#: Rows scored first, for a threshold, and terms probed at once.
SEED_ROWS, STEP = 64, 8


def integers(vectors: DataFrame) -> DataFrame:
    """(vec_id, v): floor(1024 x) of every vector that takes part."""
    x = F.col("embedding").cast("array<double>")
    ok = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & F.forall(
        x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    return vectors.filter(F.coalesce(ok, F.lit(False))).select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(x, lambda e: F.floor(e * SCALE)).alias("v"))


def blocks(rows: DataFrame, size: int, name: str) -> DataFrame:
    """Rows packed in blocks: number of components, ids and vectors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vs = [], []

        def out():
            width = max(len(v) for v in vs)
            m = np.zeros((len(vs), width), np.int64)
            for i, v in enumerate(vs):
                m[i, :len(v)] = v
            return pa.record_batch({f"{name}_width": pa.array([width], pa.int32()), f"{name}_ids": pa.array([np.array(ids, np.int64).tobytes()], pa.binary()),
                                    f"{name}_rows": pa.array([m.tobytes()], pa.binary())})

        for b in batches:
            lists = column(b, "v")
            flat, cut = lists.flatten().to_numpy(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
            for i, vid in enumerate(column(b, "vec_id").to_pylist()):
                ids.append(vid)
                vs.append(flat[cut[i]:cut[i + 1]])
                if len(ids) == size:
                    yield out()
                    ids, vs = [], []
        if ids:
            yield out()

    return rows.mapInArrow(run, f"{name}_width int, {name}_ids binary, {name}_rows binary")


def maxscore(x: np.ndarray, ids: np.ndarray, q: np.ndarray, own: int, k: int) -> list[tuple[int, int]]:
    """The k best (score, id) of the rows ``x`` for the query ``q``, ties to the smaller id; ``ids`` ascend."""
    lo, hi = x.min(0) * q, x.max(0) * q
    low, bound = np.minimum(lo, hi), np.abs(hi - lo)
    order = np.argsort(-bound, kind="stable")
    base, tail = low.sum(), np.append(np.cumsum(bound[order][::-1])[::-1], 0)
    alive = np.flatnonzero(ids != own)
    # a threshold from the rows that stand out on the first terms
    lead = order[:STEP]
    part = x[alive][:, lead] @ q[lead] - low[lead].sum()
    seed = alive[np.argsort(-part, kind="stable")[:max(SEED_ROWS, k)]]
    full = x[seed] @ q
    theta = np.sort(full)[-k] if len(full) >= k else -np.inf
    # essential: all terms but the tail that cannot reach the threshold by itself
    essential = max(int((base + tail[:-1] >= theta).sum()), STEP)
    head = order[STEP:essential]
    part = part + x[alive][:, head] @ q[head] - low[head].sum()
    at = essential
    while True:
        ok = base + part + tail[min(at, len(order))] >= theta
        alive, part = alive[ok], part[ok]
        if at >= len(order):
            break
        probe = order[at:at + STEP]
        part = part + x[alive][:, probe] @ q[probe] - low[probe].sum()
        at += STEP
        if len(part) >= k:
            theta = max(theta, base + np.partition(part, len(part) - k)[len(part) - k])
    score = x[alive] @ q
    best = np.lexsort((ids[alive], -score))[:k]
    return [(int(score[i]), int(ids[alive[i]])) for i in best]


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                get = lambda n: column(b, n)[i].as_py()  # noqa: E731, B023
                qid, xid = (np.frombuffer(get(f"{s}_ids"), np.int64) for s in "qx")
                q, x = (np.frombuffer(get(f"{s}_rows"), np.int64).reshape(len(n), get(f"{s}_width")) for s, n in (("q", qid), ("x", xid)))
                width = max(q.shape[1], x.shape[1])
                q, x = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (q, x))
                exact = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * width < 2 ** 52
                order = np.argsort(xid, kind="stable")
                x, xid = x[order], xid[order]
                if exact:  # integers that a double holds exactly
                    q, x = q.astype(np.float64), x.astype(np.float64)
                rows = [(int(a), vid, s) for a, row in zip(qid, q) for s, vid in maxscore(x, xid, row, int(a), k)]
                yield pa.record_batch({c: pa.array([r[j] for r in rows], pa.int64()) for j, c in enumerate(("query_id", "vec_id", "score"))})
    return run


def search(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k best rows."""
    x = materialise(blocks(integers(vectors), SHARD_ROWS, "x"), "topk-shards")
    ask = integers(queries).groupBy("vec_id").agg(F.min("v").alias("v"))
    q = materialise(blocks(ask, QUERY_BLOCK, "q"), "topk-queries")
    # every block of queries meets every shard: blocks by shard numbers
    n = max(1, x.count())
    x = x.withColumn("shard", F.pmod(F.xxhash64("x_ids", F.md5("x_rows")), F.lit(n)))
    q = q.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))))
    hits = x.join(q, "shard").select("x_width", "x_ids", "x_rows", "q_width", "q_ids", "q_rows").mapInArrow(_search(k), "query_id long, vec_id long, score long")
    by = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_documents(spark, sf_dir, "embeddings")
    return search(vectors, vectors.filter(F.col("vec_id") % 100 == 0))
