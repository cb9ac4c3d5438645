"""The word model and the limits of op8_quality against brute force."""
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tempora.llm import kneser_ney, quality

WORDS = re.compile(r"[0-9A-Za-z\x80-\U0010ffff]+|[^\s]")


def _model(texts):
    """log p(w | u, v) of modified Kneser-Ney over the texts' words, or None without any."""
    c3 = Counter(g for t in texts for g in _grams(t))
    c2 = Counter((v, w) for _, v, w in c3)
    c1 = Counter((w,) for _, w in c2)
    if not c1:
        return None
    levels = []
    for c in (c1, c2, c3):
        n = Counter(c.values())
        y = n[1] / max(n[1] + 2 * n[2], 1)
        d = [0] + [max(0.05, min(i, i - (i + 1) * y * n[i + 1] / max(n[i], 1))) for i in (1, 2, 3)]
        less = {g: min(x, d[min(x, 3)]) for g, x in c.items()}
        total, off = Counter(), Counter()
        for g, x in c.items():
            total[g[:-1]] += x
            off[g[:-1]] += less[g]
        levels.append((c, less, total, off))

    def p(g):
        low = 1 / (len(c1) + 1)
        for k, (c, less, total, off) in enumerate(levels, 1):
            h = g[-k:]
            if total[h[:-1]]:
                low = ((c[h] - less[h]) if h in c else 0) / total[h[:-1]] + off[h[:-1]] / total[h[:-1]] * low
        return math.log(low)

    return p


def _grams(text):
    w = ["", "", *WORDS.findall(text or "")]
    return list(zip(w, w[1:], w[2:]))


@pytest.fixture(scope="module")
def tables(spark):
    r = np.random.default_rng(5)
    vocab = ["the", "The", "of", "7", "8", "größe", "x"] + ["".join(r.choice(list("abcde"), 3)) for _ in range(60)]
    say = lambda n: " ".join(r.choice(vocab, n, p=np.arange(len(vocab), 0, -1) / sum(range(len(vocab) + 1)))) + "."
    texts = [None, "", " \n", "The The The The The", "the of", "7 8", "### $$$"] + [say(int(n)) for n in r.integers(1, 40, 120)]
    texts += [texts[20]] * 6  # copies
    rows = [(i, t, ("en", "en", "de", None)[i % 4]) for i, t in enumerate(texts)]
    rows += [rows[30], (None, "no id the of", "en")]
    labels = [(i, int(i % 5 != 0), int(i % 7 == 0)) for i in range(10, 100)] + [(11, 1, 0), (13, 1, 1)]
    return (spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def _want(docs, labels):
    bad = {r.doc_id for r in labels.collect() if r.quality != 1 or r.toxic != 0}
    good = {r.doc_id for r in labels.collect()} - bad
    rows = docs.select("doc_id", "text", "lang", F.xxhash64(F.coalesce("text", F.lit(""))).alias("key")).collect()
    model = [_model([r.text for r in rows if r.doc_id in good and (r.key & 1) != m]) for m in (0, 1)]
    ppl = []
    for r in rows:
        g = _grams(r.text)
        ppl.append(-sum(map(model[r.key & 1], g)) / len(g) if g and model[r.key & 1] else None)
    return rows, good, ppl


@pytest.mark.parametrize("hot", [20_000, 2])
def test_perplexity(tables, hot, monkeypatch):
    monkeypatch.setattr(kneser_ney, "HOT_ROWS", hot)  # 2: nearly every shared key is salted
    docs, labels = tables
    rows, good, ppl = _want(docs, labels)
    got = quality.classify(docs, labels).collect()
    fine = lambda x: None if x is None else round(math.log(x), 6)
    assert Counter((r.doc_id, r.lang, r.trusted, fine(r.perplexity)) for r in got) == Counter(
        (r.doc_id, r.lang, r.doc_id in good, None if p is None else round(p, 6)) for r, p in zip(rows, ppl))


def test_probabilities_sum_to_one(tables):
    p = _model(["the of the x.", "of the x x", "the x of of of x"])
    words = ["the", "of", "x", ".", "unseen"]
    for u, v in (("", ""), ("the", "of"), ("new", "x"), ("new", "new")):
        assert abs(sum(math.exp(p((u, v, w))) for w in words) - 1) < 1e-9


def test_limits_are_each_languages_own(tables):
    """Languages of a few trusted documents, and one without any."""
    docs, labels = tables
    docs = docs.unionByName(docs.filter("doc_id = 1").select(F.lit(900).cast("long").alias("doc_id"), F.lit("the of the").alias("text"), F.lit("es").alias("lang")))
    rows, good, ppl = _want(docs, labels)
    of = defaultdict(list)
    for r, p in zip(rows, ppl):
        if r.doc_id in good and p is not None:
            of[r.lang].append(math.ceil(round(p, 9) / quality.STEP))
    limit = {k: sorted(x)[math.ceil(len(x) * quality.QUANTILE) - 1] * quality.STEP for k, x in of.items()}
    assert set(limit) == {"en", "de", None} and len(set(limit.values())) == 3
    for r in quality.classify(docs, labels).collect():
        assert (r.threshold is None) == (r.lang not in limit)
        assert r.threshold is None or abs(math.log(r.threshold) - limit[r.lang]) < 1e-6
        assert r.keep == (r.threshold is not None and r.perplexity is not None and r.perplexity <= r.threshold)


def test_long_text_and_clashing_columns(spark, tables):
    """A long text among the others, and columns named as the model's own, change no other row's result."""
    docs, labels = tables
    want = {(r.doc_id, r.lang, r.keep, r.perplexity) for r in quality.classify(docs, labels).collect()}
    clash = docs.selectExpr("*", "1 AS key", "'x' AS trusted", "2.0 AS log_ppl", "3 AS m", "4L AS rows", "'u' AS u", "5L AS c", "6 AS keep")
    assert {(r.doc_id, r.lang, r.keep, r.perplexity) for r in quality.classify(clash, labels).collect()} == want
    long = docs.unionByName(spark.createDataFrame([(5000, "the of größe 7 8 x " * 40_000, "en")], "doc_id long, text string, lang string"))
    got = {(r.doc_id, r.lang, r.keep, r.perplexity) for r in quality.classify(long, labels).collect()}
    (row,) = [r for r in got if r[0] == 5000]
    assert row[3] is not None and got - {row} == want
