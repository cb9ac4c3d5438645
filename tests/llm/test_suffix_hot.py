"""op4_suffix_dedup: one passage in many different surroundings."""
from collections import Counter

import numpy as np
import pytest

from tempora.llm import suffix_dedup
from test_corpus import _removed


@pytest.fixture(scope="module")
def passages(spark):
    r = np.random.default_rng(8)
    say = lambda n: " ".join("".join(r.choice(list("abcdefgh"), 5)) for _ in range(n))
    passage = say(45)
    texts = [say(int(r.integers(5, 30))) + " " + passage + " " + say(int(r.integers(5, 30))) for _ in range(60)]
    texts += [texts[3]] * 2 + [passage[:210] + say(20), say(50), None, ""]
    rows = list(enumerate(texts)) + [(7, texts[7])]
    return rows, spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


def test_hot_anchors(passages, monkeypatch):
    rows, docs = passages
    monkeypatch.setattr(suffix_dedup, "HOT_RUNS", 10, raising=False)
    most = []
    sort = suffix_dedup.sorted_buckets

    def seen(pieces, length, buckets):
        most.append(pieces.select("anchor", "key", "start").distinct().groupBy("anchor").count().agg({"count": "max"}).first()[0] or 0)
        return sort(pieces, length, buckets)

    monkeypatch.setattr(suffix_dedup, "sorted_buckets", seen)
    got = Counter(tuple(r) for r in suffix_dedup.cut(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect())
    want = Counter((d, *x) for (d, _), x in zip(rows, _removed([t for _, t in rows], 200)))
    assert got == want
    assert most and max(most) <= 10  # no sorted bucket takes a hot anchor's runs
