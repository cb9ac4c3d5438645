"""Naive Bayes by brute force, rare letters, and more languages than a part holds."""
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tempora.llm import langid
from tempora.llm.text import U64, mix


def _grams(text):
    """Hashed n-grams of letters, runs of others as one space."""
    out, s = [], []
    for c in text.lower():
        if c.isalpha():
            s.append(ord(c))
        elif not s or s[-1] != 32 or not other:
            s.append(32)
        other = not c.isalpha()
    for k in langid.ORDERS:
        for i in range(len(s) - k + 1):
            h = k
            for c in s[i:i + k]:
                h = (h * 1_000_003 + c) % 2**64
            out.append(int(mix(np.array([h], U64))[0] % U64(langid.BUCKETS)))
    return out


def brute(rows):
    counts, texts = defaultdict(Counter), Counter()
    for doc_id, text, lang in rows:
        if lang is not None and doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 != 1:
            counts[lang].update(_grams(text or ""))
            texts[lang] += 1
    out = []
    for doc_id, text, _ in rows:
        if not texts or not any(c.isalpha() for c in text or ""):
            out.append((doc_id, "und", 0.0))
            continue
        like = {}
        for lang in texts:
            total = sum(counts[lang].values()) + langid.SMOOTHING * langid.BUCKETS
            like[lang] = math.log(texts[lang] / sum(texts.values())) + sum(math.log((counts[lang][g] + langid.SMOOTHING) / total) for g in _grams(text))
        best = max(sorted(like), key=like.get)
        out.append((doc_id, best, 1 / sum(math.exp(v - like[best]) for v in like.values())))
    return out


def _same(got, want):
    got, want = sorted(got, key=str), sorted(want, key=str)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert [g[2] for g in got] == pytest.approx([w[2] for w in want], abs=1e-9)


def made(n, langs=("en", "de", "fr")):
    r = np.random.default_rng(5)
    alphabets = {x: list("abcdefghijklmnopqrstuvwxyzäöüßéèçà")[i * 5 % 20:i * 5 % 20 + 12] for i, x in enumerate(langs)}
    rows = []
    for i in range(n):
        lang = langs[i % len(langs)]
        rows.append((i, " ".join("".join(r.choice(alphabets[lang], 4)) for _ in range(int(r.integers(1, 20)))) + "! 12", lang if i % 7 else None))
    return rows


def run(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    return [tuple(r) for r in langid.identify(df, ["doc_id"]).collect()]


def test_against_brute_force(spark):
    rows = made(60) + [(None, "abc", "en"), (70, None, "en"), (71, "", "de"), (72, "123 !", None), (73, "\U00030001", "en"), (74, "\U00031350 x", None), (0, "again", "fr")]
    got = run(spark, rows)
    _same(got, brute(rows))
    assert next(g for g in got if g[0] == 73)[1] != "und"


@pytest.mark.parametrize("size", [1, 2, 5])
def test_parts_of_languages(spark, monkeypatch, size):
    rows = made(60, ("en", "de", "fr", "a", "zz"))
    want = run(spark, rows)
    monkeypatch.setattr(langid, "MAX_LANGS", size)
    _same(run(spark, rows), want)


def test_nothing_to_learn_from(spark):
    rows = [(1, "abc", None), (2, None, None)]
    assert sorted(run(spark, rows)) == [(1, "und", 0.0), (2, "und", 0.0)]
    assert run(spark, []) == []
