"""Every pipeline stage against a brute force of what it decides, row by row,
and on empty tables and clashing columns; texts by the shuffle side of joins."""
import datetime as dt
import re
from collections import Counter

import pytest
from test_corpus import DDL, _jaccard, _sets, _texts

import corpus_pipeline
from tempora.llm import decontaminate, jaccard, mixing, sharding, suffix_dedup, text

SF = "/root/testdata/sf0.001"
STAGE = dict(corpus_pipeline.STAGES)
WORD, ITEM = re.compile("[^\x20\x09-\x0D]+"), re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
lower = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


@pytest.fixture(scope="module")
def docs(spark):
    bench = [r.text for r in text.read_documents(spark, SF, "benchmark").limit(3).collect()]
    rows = []
    for i, t in enumerate([*_texts(), *bench, "lead in " + bench[0] + " and out"]):
        row = (i * 7 % 53, t, ("en", "de", None)[i % 3], ("a", "b", "c", "d", None)[i % 5], None, 0.1, 1, 2, 3, "x")
        rows += [row] * (1 + (i in (7, 13, 20)))
    rows += [(None, "null id " * 9, "en", "a", 1, 0.0, 0, 0, 0, "")] * 2
    return spark.createDataFrame(rows, DDL).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DDL)


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


def run(spark, name, docs):
    return STAGE[name](spark, docs, SF)


@pytest.mark.parametrize("name", list(STAGE))
def test_empty_table(spark, nothing, name):
    out = run(spark, name, nothing)
    assert sorted(out.columns) == sorted(nothing.columns) and out.collect() == []


def test_language_keeps_what_has_a_letter(spark, docs):
    want = Counter(tuple(r) for r in docs.collect() if any(c.isalpha() for c in r.text or ""))
    assert rows_of(run(spark, "language", docs)) == want


def test_near_duplicates_keep_one_row_of_each_group(spark, docs):
    rows = docs.collect()
    kept = run(spark, "near_duplicates", docs).collect()
    groups = _jaccard([(r.doc_id, r.text) for r in rows], 5, 80)
    assert not Counter(map(tuple, kept)) - Counter(map(tuple, rows))            # whole rows of the input
    full = [r for r in kept if _sets(r.text, 5)]
    assert Counter(r.doc_id for r in full) == Counter({c for _, n, c in groups if n})
    assert sum(not _sets(r.text, 5) for r in kept) == sum(not _sets(r.text, 5) for r in rows)


def test_benchmark_drops_every_window(spark, docs):
    items = [ITEM.findall(lower(r.text)) for r in text.read_documents(spark, SF, "benchmark").collect()]
    windows = {tuple(w[i:i + 10]) for w in items if w for i in range(max(len(w) - 9, 1))}
    sizes = {len(w) for w in windows}

    def hit(t):
        w = ITEM.findall(lower(t))
        return any(tuple(w[i:i + n]) in windows for n in sizes for i in range(len(w) - n + 1))

    want = Counter(tuple(r) for r in docs.collect() if not hit(r.text))
    assert 0 < sum(want.values()) < docs.count()
    assert rows_of(run(spark, "benchmark", docs)) == want


def test_mix_takes_what_the_operator_says(spark, docs):
    rows = docs.collect()
    out = run(spark, "mix", docs).collect()
    taken = Counter()
    for r in mixing.mix(docs).select("doc_id", "taken").collect():
        taken[r.doc_id] += r.taken
    got = Counter()
    whole = {(r.doc_id, r.text or "") for r in rows}
    for r in out:
        n = len(WORD.findall(r.text or ""))
        got[r.doc_id] += n
        assert n and r.n_chars == len(r.text)
        assert (r.doc_id, r.text) in whole or any(d == r.doc_id and t.startswith(r.text) for d, t in whole)  # whole, or its first words
    assert +got == +taken
    assert max(Counter((r.doc_id, r.text) for r in out).values()) <= 2 * max(Counter((r.doc_id, r.text) for r in rows).values())


def jump(key, buckets):
    key, b, j = key % 2**64, -1, 0
    while j < buckets:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_shard_is_the_jump_hash(spark, docs):
    rows = docs.collect()
    at = docs.columns.index("shard")
    want = Counter()
    for r in rows:
        t = list(r)
        del t[at]
        want[(*t, jump(r.doc_id or 0, sharding.SHARDS))] += 1
    out = run(spark, "shard", docs)
    assert out.columns == [c for c in docs.columns if c != "shard"] + ["shard"]
    assert rows_of(out) == want


def test_clashing_columns_change_nothing(spark, docs):
    """Columns named as the stages' own are kept as they are."""
    names = ["_rep", "_sig", "root", "lang_pred", "contaminated", "whole", "heads", "_cut", "_shard", "_id", "key"]
    more = docs.selectExpr("*", *[f"'{n}!' AS {n}" for n in names])
    for name in list(STAGE)[:3]:
        out = run(spark, name, more)
        assert out.columns == more.columns
        assert rows_of(out.select(docs.columns)) == rows_of(run(spark, name, docs))
        assert all(r[n] == f"{n}!" for r in out.collect() for n in names)
    assert run(spark, "shard", run(spark, "mix", more)).count() == run(spark, "mix", docs).count()


def test_texts_shuffled_instead_of_a_broadcast(spark, docs, monkeypatch):
    """The other side of the size check gives the same rows."""
    bench = text.read_documents(spark, SF, "benchmark")
    runs = {"op1": lambda: jaccard.join(docs, 4, 85).drop("class"), "op4": lambda: suffix_dedup.cut(docs),
            "op7": lambda: decontaminate.scan(docs, bench, ["doc_id"]), **{n: (lambda n=n: run(spark, n, docs)) for n in ("near_duplicates", "mix")}}
    every = lambda: {n: Counter(str(tuple(r)) for r in f().collect()) for n, f in runs.items()}
    want = every()
    real = text.attach
    calls = []

    def shuffled(texts, small, on, how="inner", rows=None, bound=0):
        calls.append(1)
        return real(texts, small, on, how, rows, bound=-1)

    for module in (jaccard, suffix_dedup, decontaminate, mixing):
        if hasattr(module, "attach"):
            monkeypatch.setattr(module, "attach", shuffled)
    got = every()
    assert calls and got == want


def test_the_whole_pipeline(spark):
    t = dt.datetime.now()
    out = corpus_pipeline.run(spark, SF)
    docs = text.read_documents(spark, SF)
    assert set(docs.columns) < set(out.columns) and 0 < out.count() < 2 * docs.count()
    assert (dt.datetime.now() - t).seconds < 600
