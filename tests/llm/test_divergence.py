"""Source divergence against a brute force over whole texts."""
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from tempora.llm import divergence as dv

COLUMNS = ["lang", "source", "part", "item", "value", "rank"]
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(rows, least=10, top=10):
    docs, n, groups = Counter(), Counter(), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        found = TERM.findall(low)
        docs.update({(lang, t) for t in found})
        n.update((lang, source, t) for t in found)
    out = Counter()
    by = lambda x: (-x[1], x[0].encode())
    for lang in {g[0] for g in groups}:
        kept = [t for (a, t), c in docs.items() if a == lang and c >= least]
        sources = [s for a, s in groups if a == lang]
        per = {s: [n[lang, s, t] for t in kept] for s in sources}
        weigh = lambda c: [1 + 10**9 * (x + 2) // (sum(c) + 2 * len(kept)) for x in c]
        p = {s: weigh(c) for s, c in per.items()}
        q = weigh([sum(c) for c in zip(*per.values())])
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pairs = sorted([(o, sum(map(f, p[s], p[o]))) for o in sources if o != s], key=by)
            terms = sorted([(t, f(a, b)) for t, a, b, c in zip(kept, p[s], q, per[s]) if c and a > b], key=by)[:top]
            for part, ranked in (("pair", pairs), ("term", terms)):
                out.update((lang, s, part, item, value, i) for i, (item, value) in enumerate(ranked, 1))
    return out


def run(spark, rows, schema="text string, lang string, source string", **how):
    return Counter(tuple(r) for r in dv.audit(spark.createDataFrame(rows, schema), **how).select(*COLUMNS).collect())


def made(n):
    words = ["Alpha", "beta,", "GAMMA", "über", "a-b", "x1y", "δέλτα", "(eps)", "don't", "42"]
    return [(" ".join(words[(i * j + i) % 10] + ("" if j % 3 else f"z{chr(97 + j % 5)}") for j in range(i % 13)), ["en", "de", None][i % 3],
             ["s1", "s2", None, "S1"][i * i % 4]) for i in range(n)]


def test_against_brute_force(spark):
    rows = made(150) + [(None, "en", "s9"), ("", "fr", "only"), ("\t \n", "en", "s1"), ("... 123", "xx", "u"), ("!!", "xx", "v")]
    assert run(spark, rows) == brute(rows)


@pytest.mark.parametrize("how", [{"bucket_bytes": 64}, {"cells": 7}, {"least": 1, "top": 3}])
def test_small_buckets_and_tables(spark, how):
    rows = made(90)
    assert run(spark, rows, **how) == brute(rows, how.get("least", 10), how.get("top", 10))


def test_blocks_of_one_document(spark, monkeypatch):
    monkeypatch.setattr(dv, "BLOCK_BYTES", 1)
    rows = made(60)
    assert run(spark, rows) == brute(rows)


def test_long_text_copies_and_ties(spark):
    rows = [("word " * 50_000 + "x" * 100_000, "en", "a")] + [("same text here", "en", s) for s in "abcabcabcabcabc"]
    assert run(spark, rows) == brute(rows)


def test_empty_table_and_clashing_columns(spark):
    clash = "text string, lang string, source string, block long, bucket int, term string, n long, rank int"
    assert not run(spark, [], clash)
    rows = made(40)
    assert run(spark, [(*r, 1, 2, "t", 3, 4) for r in rows], clash) == brute(rows)


def test_weights_beyond_64_bits():
    import numpy as np
    big = np.array([10**13, 0], np.int64)
    assert dv.weight(big, 10**13, 2).tolist() == [1 + 10**9 * (10**13 + 2) // (10**13 + 4), 1 + 10**9 * 2 // (10**13 + 4)]


def test_chunks_split_as_the_pattern_does():
    chunks = ["a-b", "ABC", "éÉ!x", "...", "", "a\x00b\x7fc", "Σσς7t", "x@y_z`q{r~"]
    held, terms = dv.split_chunks(pa.array(chunks, pa.large_string()))
    want = [TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in x)) for x in chunks]
    assert held.tolist() == [len(w) for w in want] and terms.to_pylist() == [t for w in want for t in w]
