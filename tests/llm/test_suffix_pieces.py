"""op4_suffix_dedup: long texts are designated piece by piece."""
import tracemalloc
from collections import Counter

import numpy as np

from tempora.llm import suffix_dedup
from test_corpus import _removed


def _bytes(texts):
    parts = [t.encode() for t in texts]
    return np.frombuffer(b"".join(parts), np.uint8), np.cumsum([0] + [len(p) for p in parts])


def test_memory_of_long_text():
    """What a task holds does not grow with a text's length, but for its runs."""
    r = np.random.default_rng(3)
    buf = r.integers(97, 123, 6 << 20).astype(np.uint8)
    offs = np.array([0, len(buf)])
    suffix_dedup.runs(buf[:1000], np.array([0, 1000]), 200)
    tracemalloc.start()
    suffix_dedup.runs(buf, offs, 200)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 8 * len(buf), most


def test_pieces_cover_all_windows(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PIECE", 1000)
    r = np.random.default_rng(4)
    say = lambda n: "".join(r.choice(list("abcdefgh "), n))
    texts = ["", say(150), say(200), say(999), "", say(5300), say(1000), say(201), say(1001), ""]
    buf, offs = _bytes(texts)
    got, owner = suffix_dedup.runs(buf, offs, 200)
    places = Counter((int(t), int(s) + i) for t, s, n in zip(owner, got["start"], got["n"]) for i in range(n))
    want = {(t, i): 1 for t, x in enumerate(texts) for i in range(max(0, len(x) - 199))}
    assert places == want
    # a text is cut alike wherever it stands
    long = texts[5]
    alone = suffix_dedup.runs(*_bytes([long]), 200)[0]
    both = suffix_dedup.runs(*_bytes([say(700), long, say(10), long]), 200)
    for t in (1, 3):
        mine = both[0][both[1] == t]
        assert all((mine[c] == alone[c]).all() for c in ("anchor", "bytes", "start", "n", "off"))


def test_repeats_across_pieces(spark, monkeypatch):
    r = np.random.default_rng(5)
    say = lambda n: "".join(r.choice(list("abcdefgh "), n))
    cut = suffix_dedup.pieces

    def small(offs):  # the module of a worker process keeps its own PIECE
        suffix_dedup.PIECE = 700
        return cut(offs)

    passage = say(900)
    texts = [say(300 + 97 * i) + passage[i * 20:] + say(50) for i in range(12)]
    texts += [texts[0], say(2500), passage[:230], None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    monkeypatch.setattr(suffix_dedup, "pieces", small)
    got = {tuple(x) for x in suffix_dedup.cut(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()}
    assert got == {(i, *x) for i, x in enumerate(_removed(texts, 200))}
