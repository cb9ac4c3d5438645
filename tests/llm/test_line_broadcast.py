"""op10_line_dedup: what decides a broadcast is the lines, not the documents."""
from pyspark.sql import functions as F

from tempora.llm import line_dedup


def test_wanted_lines_are_counted(spark, monkeypatch):
    line = lambda i, k: " ".join(f"w{i}x{j}" for j in range(10) if j != k)
    docs = spark.createDataFrame([(d, "\n".join(line(i, d) for i in range(40))) for d in (1, 2)], "doc_id long, text string")
    seen = []
    attach = line_dedup.attach
    monkeypatch.setattr(line_dedup, "attach", lambda *a, **k: seen.append(k.get("rows")) or attach(*a, **k))
    docs = docs.withColumn("key", F.xxhash64("text"))
    wanted = docs.select("doc_id", "key", F.explode(F.sequence(F.lit(0), F.lit(39))).alias("line"))
    assert line_dedup.variants(docs, wanted).count() > 0
    assert seen == [80]


def _texts():
    base = [" ".join(f"w{i}x{j}" for j in range(9 + i % 3)) for i in range(12)]
    rows = []
    for d in range(40):
        lines = []
        for i, b in enumerate(base):
            w = b.split()
            if (d + i) % 5 == 1:
                w[(d * 3 + i) % len(w)] = f"Z{d % 4}"
            elif (d + i) % 5 == 2:
                del w[(d + i) % len(w)]
            elif (d + i) % 5 == 3:
                w[1:2], w[4:5] = [f"q{d}"], [f"r{d}"]
            lines.append(" ".join(w).upper() if d % 7 == 3 else "  ".join(w))
        rows.append((d, "\n".join(lines)))
    return rows


def test_words_decide_not_hashes(spark, monkeypatch):
    """A hash that tells almost nothing apart changes no line."""
    docs = spark.createDataFrame(_texts(), "doc_id long, text string")
    want = sorted(map(tuple, line_dedup.dedup(docs).collect()))
    assert 0 < sum(r[2] for r in want) < sum(r[1] for r in want)
    monkeypatch.setattr(line_dedup, "variant_key", lambda h: h % line_dedup.U64(3))
    assert sorted(map(tuple, line_dedup.dedup(docs).collect())) == want
