"""The corpus operators against brute force on small tables with nulls, empty
and long texts, ties, repeated rows, and columns with clashing names; and over
a whole test table."""
import hashlib
import re
import sys
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from tempora.llm import decontaminate, jaccard, langid, line_dedup, mixing, pii, quality, sharding, suffix_dedup, topk  # noqa: E402
from tempora.llm import queries as corpus  # noqa: E402

SF = "/root/testdata/sf0.001"
DDL = "doc_id long, text string, lang string, source string, n_chars long, score double, _row int, rows long, shard int, place string"
WORDS = re.compile("[^\x20\x09-\x0D]+")
lower = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def _texts():
    r = np.random.default_rng(3)
    vocab = ["".join(r.choice(list("abcdefgh"), 4)) for _ in range(300)]
    sent = lambda n: " ".join(r.choice(vocab, n))
    base, line, passage = sent(120), sent(12), sent(60)
    edit = lambda t, k: " ".join(w if i % k else "zz" + w for i, w in enumerate(t.split(), 1))
    out = [None, "", " \n\t ", "one", "one", "One two three", "!!! 123 ???", base, base, base.upper(), edit(base, 60), edit(base, 90), edit(base, 10),
           sent(50) + "\n" + line + "\n" + sent(20), sent(40) + "\n" + edit(line, 7) + "\n" + sent(20), line, line + " more", sent(30) + " " + passage + " " + sent(9),
           passage + " " + sent(40), "a" * 450, "a" * 199, "é" * 300, sent(40_000), "mail x.y@example.com now +1 (264) 555-5961 or 10.0.0.300 1.2.3.4 card 4111 1111 1111 1111"]
    return out + [sent(int(n)) for n in r.integers(1, 90, 25)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = []
    for i, t in enumerate(_texts()):
        row = (i * 7 % 53, t, ("en", "de", None)[i % 3], ("a", "b", "c", "d", None)[i % 5], None, 0.1, 1, 2, 3, "x")
        rows += [row] * (1 + (i in (7, 13, 20)))  # repeated rows
    rows += [(None, "null id " * 9, "en", "a", 1, 0.0, 0, 0, 0, "")] * 2 + [(5, "another text with id five", "en", "b", 1, 0.0, 0, 0, 0, "")]
    return spark.createDataFrame(rows, DDL).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DDL)


def _pairs(df, *cols):
    return Counter(tuple(r) for r in df.select(*cols).collect())


def _sets(text, k):
    w = WORDS.findall(lower(text))
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def _jaccard(rows, k, pct):
    s = [_sets(t, k) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if s[i] and s[j] and 100 * len(s[i] & s[j]) >= pct * len(s[i] | s[j]):
                root[find(i)] = find(j)
    least = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        least[find(i)].append(d)
    return Counter((d, len(s[i]), min((x for x in least[find(i)] if x is not None), default=None)) for i, (d, _) in enumerate(rows))


@pytest.mark.parametrize("k,pct", [(4, 85), (5, 80)])
def test_jaccard(docs, k, pct):
    want = _jaccard([(r.doc_id, r.text) for r in docs.collect()], k, pct)
    assert _pairs(jaccard.join(docs, k, pct), "doc_id", "n_shingles", "component_id") == want


def test_jaccard_many_copies(spark):
    """More near copies than a part holds, not all of them linked to each other."""
    r = np.random.default_rng(1)
    base = [f"w{i}" for i in range(100)]
    rows = []
    for d in range(330):
        t = list(base)
        for p in r.choice(100, int(r.integers(1, 6)), replace=False):
            t[p] = f"x{d}_{p}"
        rows.append((d, " ".join(t)))
    got = jaccard.join(spark.createDataFrame(rows, "doc_id long, text string"), 4, 85)
    assert _pairs(got, "doc_id", "n_shingles", "component_id") == _jaccard(rows, 4, 85)


def test_unique_documents(docs):
    rows = docs.collect()
    out = jaccard.unique_documents(docs)
    assert out.columns == docs.columns
    kept = out.collect()
    comps = {c for (d, n, c) in _jaccard([(r.doc_id, r.text) for r in rows], 5, 80) if n}
    empty = sum(not _sets(r.text, 5) for r in rows)
    assert sum(not _sets(r.text, 5) for r in kept) == empty
    assert {r.doc_id for r in kept if _sets(r.text, 5)} == comps


def test_pii_base_and_added(docs):
    for t in _texts():
        t = t or ""
        want = [(0, m.start(), m.end()) for m in pii.EMAIL.finditer(t)]
        for k, rx in ((1, pii.IP), (2, pii.CARD), (3, pii.PHONE)):
            want += [(k, m.start(), m.end()) for m in rx.finditer(t) if pii.valid(k, m[0])]
        assert sorted(pii.base_spans(t)) == sorted(want)
    got = pii.detect(docs)
    assert got.count() == docs.count()
    one = got.filter("n_email > 0").first()
    assert (one.n_email, one.n_ip, one.n_card, one.n_phone) == (1, 1, 1, 1) and "email:5:20" in one.spans.split(",")


def test_pii_gradient():
    m = pii.Tagger()
    m.p = {k: v.astype(np.float64) for k, v in m.p.items()}
    g = np.random.default_rng(0)
    x, y = g.integers(0, pii.CLASSES, (3, 6)), g.integers(0, pii.TAGS, (3, 6))
    _, grad = m.step(x, y)
    for name in ("E", "Wf", "Ub", "O", "T", "bf"):
        at = tuple(0 if name != "E" else x[0, 0] for _ in (0,)) + tuple(1 for _ in m.p[name].shape[1:])
        e = 1e-3
        old = m.p[name][at]
        m.p[name][at] = old + e
        hi = m.step(x, y)[0]
        m.p[name][at] = old - e
        lo = m.step(x, y)[0]
        m.p[name][at] = old
        assert abs((hi - lo) / (2 * e) - grad[name][at]) < 2e-2


def test_mixing(docs):
    rows = [(r.doc_id, r.source, len(WORDS.findall(r.text or ""))) for r in docs.collect()]
    size = Counter()
    for _, s, n in rows:
        size[s] += n
    names = sorted([s for s in size if s is not None]) + [s for s in size if s is None]
    w = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, left, open_ = {}, 1.5 * sum(size.values()), set(names)
    while True:
        share = {s: left * w[s] / sum(w[x] for x in open_) for s in open_}
        full = {s for s in open_ if share[s] > 2 * size[s]}
        if not full:
            target |= share
            break
        for s in full:
            target[s] = 2.0 * size[s]
            left -= target[s]
        open_ -= full
    got = mixing.mix(docs).collect()
    assert Counter((r.doc_id, r.source, r.size) for r in got) == Counter(rows)
    taken = Counter()
    for r in got:
        assert abs(r.target - target[r.source]) < 1e-6 and 0 <= r.taken <= 2 * r.size and r.source_size == size[r.source]
        taken[r.source] += r.taken
    assert all(abs(taken[s] - target[s]) <= 1 for s in names)
    again = _pairs(mixing.mix(docs.repartition(5)), "doc_id", "size", "taken")
    assert again == Counter((r.doc_id, r.size, r.taken) for r in got)
    made = mixing.mixed_documents(docs)
    assert made.columns == docs.columns
    words = Counter()
    for r in made.collect():
        words[r.source] += len(WORDS.findall(r.text))
    assert words == +taken


def _removed(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(b[i:i + length] for b in data for i in range(len(b) - length + 1))
    out = []
    for b in data:
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = True
        runs = int((gone[1:] & ~gone[:-1]).sum()) + int(gone[0])
        out.append((len(b), int(gone.sum()), runs, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return out


def test_suffix_dedup(docs):
    rows = [r for r in docs.collect()]
    want = Counter((r.doc_id, *x) for r, x in zip(rows, _removed([r.text for r in rows], 200)))
    assert _pairs(suffix_dedup.cut(docs), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == want


def test_sharding(docs):
    def jump(key, n):
        b, j = -1, 0
        while j < n:
            b, key = j, (key * 2862933555777941757 + 1) % 2**64
            j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
        return b

    got = sharding.shard(docs).collect()
    assert len(got) == docs.count()
    slots = defaultdict(list)
    for r in got:
        assert (r.shard, r.grown_shard) == (jump(r.doc_id or 0, 8), jump(r.doc_id or 0, 9)) and r.law == "key"
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.sharded_documents(docs).columns == [c for c in docs.columns if c != "shard"] + ["shard"]


def test_topk(spark):
    r = np.random.default_rng(2)
    rows = [(i * 5, [float(x) for x in r.integers(-2, 3, 24) / 4]) for i in range(400)]  # many ties
    rows += [(3, None), (4, [1.0, None] * 12), (6, [float("nan")] * 24), (None, rows[0][1]), (7, []), rows[5], (11, [9.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    ok = [(i, np.pad(np.floor(1024 * np.array(v)), (0, 24 - len(v)))) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    want = set()
    for q in {i for i, _ in ok if i % 100 == 0}:
        v = dict(ok)[q]
        best = sorted((-int(v @ x), i) for i, x in ok if i != q)[:10]
        want |= {(q, k + 1, i, -s) for k, (s, i) in enumerate(best)}
    old = topk.SHARD_ROWS
    topk.SHARD_ROWS = 100
    try:
        got = topk.search(df, df.filter("vec_id % 100 = 0"))
        assert set(_pairs(got, "query_id", "rank", "vec_id", "score")) == want
    finally:
        topk.SHARD_ROWS = old
    assert topk.search(df.limit(0), df.limit(0)).count() == 0


def test_decontamination(spark, docs):
    rows = docs.collect()
    rx = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    src = next(r.text for r in rows if r.text and len(rx.findall(r.text)) > 50)
    words = rx.findall(lower(src))
    items = [(1, " ".join(words[3:30])), (2, "One! Two, three"), (3, None), (4, "..."), (None, " ".join(words[20:32])), (1, " ".join(words[3:30])), (10, "one")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    wins = defaultdict(set)
    for i, t in items:
        w = rx.findall(lower(t))
        for j in range(len(w) - min(10, len(w)) + 1 if w else 0):
            wins[tuple(w[j:j + min(10, len(w))])].add(str(i) if i is not None else "null")
    want = Counter()
    for r in rows:
        w = rx.findall(lower(r.text))
        hit, found = [0] * len(w), set()
        for m in {len(k) for k in wins}:
            for i in range(len(w) - m + 1):
                if tuple(w[i:i + m]) in wins:
                    found |= wins[tuple(w[i:i + m])]
                    hit[i:i + m] = [1] * m
        want[(r.doc_id, len(w), sum(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), sum(hit) > 0)] += 1
    cols = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert _pairs(decontaminate.scan(docs, bench, ["doc_id"]), *cols) == want
    assert _pairs(decontaminate.scan(docs, bench, ["doc_id"], block_words=20), *cols) == want  # the benchmark in blocks
    assert decontaminate.clean_documents(docs, bench).columns == docs.columns


def test_quality(spark):
    big = SF.replace("0.001", "0.01")  # enough labelled documents for a rate
    docs = spark.read.parquet(f"{big}/documents.parquet")
    labels = spark.read.parquet(f"{big}/labels.parquet")
    got = quality.classify(docs, labels)
    j = got.join(labels, "doc_id")
    good, bad = j.filter("quality = 1 and toxic = 0"), j.filter("quality = 0")
    assert good.filter("keep").count() >= 0.97 * good.count() and bad.filter("keep").count() <= 0.3 * bad.count()
    none = quality.classify(docs.limit(5), labels.limit(0)).collect()
    assert all(r.perplexity is None and not r.keep for r in none)


def test_langid(spark, docs):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    got = langid.identify(table, ["doc_id", "lang"]).withColumn("held", langid.held_out(F.col("doc_id")))
    held = got.filter("held and lang_pred <> 'und'")
    assert held.filter("lang = lang_pred").count() >= 0.95 * held.count()
    mine = langid.identify(docs, ["doc_id", "text"]).collect()
    for r in mine:
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or "")) and 0 <= r.score <= 1
    assert langid.accepted_documents(docs).columns == docs.columns


def _edit(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    j = 0
    while j < min(len(a), len(b)) - i and a[-1 - j] == b[-1 - j]:
        j += 1
    return max(len(a), len(b)) - i - j <= 1


def test_line_dedup(docs):
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("key")).collect()
    rows = sorted({(r.doc_id is None, r.doc_id or 0, r.key, r.text) for r in keyed if r.text is not None})
    seen, kept = [], {}
    for last, d, k, text in rows:
        out = []
        for line in text.split("\n"):
            w = WORDS.findall(lower(line))
            near = w and any(w == x or (max(len(w), len(x)) >= line_dedup.NEAR_WORDS and _edit(w, x)) for x in seen)
            if w:
                seen.append(w)
            if not near:
                out.append(line)
        kept[(None if last else d, text)] = "\n".join(out)
    got = line_dedup.dedup(docs).collect()
    want = Counter((r.doc_id, kept.get((r.doc_id, r.text))) for r in keyed)
    assert Counter((r.doc_id, r.kept) for r in got) == want


def test_empty_tables(spark, nothing):
    bench = spark.createDataFrame([], "item_id long, text string")
    for df in (jaccard.join(nothing), pii.detect(nothing), mixing.mix(nothing), suffix_dedup.cut(nothing), sharding.shard(nothing),
               decontaminate.scan(nothing, bench, ["doc_id"]), langid.identify(nothing, ["doc_id"]), line_dedup.dedup(nothing),
               quality.classify(nothing, spark.createDataFrame([], "doc_id long, quality int, toxic int"))):
        assert df.count() == 0


def test_pipeline(spark, docs):
    out = docs
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, out, SF)
        assert set(docs.columns) <= set(out.columns)
    assert 0 < out.count() < 2 * docs.count()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "benchmark", "mix", "shard"]


def test_names():
    assert {f"op{n}_" for n in range(1, 14)} == {re.match(r"op\d+_", k)[0] for k in corpus.queries()}
