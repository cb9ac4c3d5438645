"""Top-k search: empty vectors, clashing columns, all queries by brute force."""
import math
from collections import Counter

from tempora.llm import topk


def brute(rows, queries, k):
    clean = lambda v: v is not None and all(x is not None and math.isfinite(x) for x in v)
    ints = [(i, [math.floor(x * 1024) for x in v]) for i, v in rows if i is not None and clean(v)]
    out = Counter()
    for q in sorted({i for i, v in queries if i is not None and clean(v)}):
        mine = min([math.floor(x * 1024) for x in v] for i, v in queries if i == q and clean(v))
        best = sorted(((-sum(a * b for a, b in zip(mine, v)), i) for i, v in ints if i != q))[:k]
        out.update((q, n, i, -s) for n, (s, i) in enumerate(best, 1))
    return out


def _run(spark, rows, k, schema="vec_id long, embedding array<float>"):
    df = spark.createDataFrame(rows, schema)
    return Counter(tuple(r) for r in topk.search(df, df.filter("vec_id % 2 = 0"), k).collect())


def test_empty_vectors_score_zero(spark):
    rows = [(0, []), (1, [1.0, -2.0]), (2, [0.5, 0.25]), (3, []), (4, None), (5, [float("nan")]), (6, [None, 1.0]), (7, [float("inf")]), (8, [-1.0]), (None, [1.0]), (2, [0.5, 0.25])]
    assert _run(spark, rows, 3) == brute(rows, [r for r in rows if r[0] is not None and r[0] % 2 == 0], 3)


def test_only_empty_vectors(spark):
    rows = [(0, []), (1, []), (2, [])]
    assert _run(spark, rows, 10) == brute(rows, rows[::2], 10)


def test_clashing_columns(spark):
    schema = "vec_id long, embedding array<float>, v string, shard int, x_ids int, q_rows int, rank int, score long, query_id long"
    rows = [(i, [float((i * j) % 7 - 3) for j in range(5)]) for i in range(30)]
    assert _run(spark, [(*r, "a", 1, 2, 3, 4, 5, 6) for r in rows], 4, schema) == brute(rows, rows[::2], 4)
    assert not _run(spark, [], 4, schema)
