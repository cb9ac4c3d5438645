"""op10_line_dedup: what a task holds does not grow with the variants of its texts."""
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tempora.llm import line_dedup


def _texts(n, lines, seed):
    r = np.random.default_rng(seed)
    line = lambda: "  ".join("".join(r.choice(list("abcdeF"), 5)) for _ in range(int(r.integers(1, 15))))
    return ["\n".join(line() for _ in range(lines)) for _ in range(n)]


def test_exact_variants_in_parts():
    texts = ["", *_texts(3, 700, 1), "a b", *_texts(1, 3000, 2)]
    wanted, want = [], Counter()
    for d, t in enumerate(texts):
        mine = []
        for i, line in enumerate(t.split("\n")):
            w = line.lower().encode().split()
            asked = [(0, -1), *((k, g) for g in range(len(w)) for k in (1, 2))] if w else []
            mine += [{"line": i, "kind": k, "gap": g, "full": 10 * d + k} for k, g in asked]
            for k, g in asked:
                v = b" ".join(w if g < 0 else w[:g] + w[g + 1:]) + (b"\n%d" % g if k == 2 else b"")
                want[v, k, 10 * d + k, d, -d, i] += 1
        wanted.append(mine[::-1])
    kind = pa.list_(pa.struct([("line", pa.int64()), ("kind", pa.int32()), ("gap", pa.int32()), ("full", pa.int64())]))
    b = pa.record_batch({"doc_id": pa.array(range(len(texts)), pa.int64()), "key": pa.array([-d for d in range(len(texts))], pa.int64()),
                         "wanted": pa.array(wanted, kind), "text": pa.array(texts)})
    got, most = Counter(), 0
    for x in line_dedup.reread(iter([b.slice(0, 2), b.slice(2)])):
        assert x.schema.names == ["variant", "kind", "full", "doc_id", "key", "line"]
        most = max(most, x.nbytes)
        got.update(zip(*x.to_pydict().values()))
    assert got == want and len(want) > 50_000
    assert most < 2 * line_dedup.SENT_BYTES
    del got, want, wanted
    tracemalloc.start()
    for _ in line_dedup.reread(iter([b])):
        pass
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 12 << 20, peak


def test_variants_in_parts(spark, monkeypatch):
    docs = spark.createDataFrame(list(enumerate([None, "", *_texts(4, 30, 3)])), "doc_id long, text string").withColumn("key", F.xxhash64("text"))
    wanted = docs.filter("text > ''").select("doc_id", "key", F.explode(F.sequence(F.lit(0), F.lit(29))).alias("line")).filter("line % 3 < 2")
    want = Counter(map(tuple, line_dedup.variants(docs, wanted).collect()))
    assert len(want) > 1000
    for words in (1, 40):
        monkeypatch.setattr(line_dedup, "SCAN_WORDS", words)
        assert Counter(map(tuple, line_dedup.variants(docs, wanted).collect())) == want


def test_last_line_of_one_word(spark):
    """A slice of texts may end in a line of one word."""
    rows = [(1, "a b c\nword"), (2, "word"), (3, "\nA B  c\n other")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.kept) for r in line_dedup.dedup(docs).collect()}
    assert got == {1: (2, 0, "a b c\nword"), 2: (1, 1, ""), 3: (3, 1, "\n other")}
