"""The shards, parts and rounds of op8_quality's word model, and the disk they take."""
import math
import threading
import tracemalloc
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from test_quality_words import _want, tables  # noqa: F401

from tempora.llm import kneser_ney, quality
from tempora.llm.text import text_bytes
from tempora.session import ensure_checkpoint_dir

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("words, short, rounds", [(60, 10, 3), (7, 0, 1), (400, 1000, 2)])
def test_any_sizes_give_the_same(tables, words, short, rounds, monkeypatch):  # noqa: F811
    """Hot words over several shards, full shards in parts, and words without a short code against brute force."""
    for name, x in (("SHARD_WORDS", words), ("SHORT_CODES", short), ("ROUNDS", rounds)):
        monkeypatch.setattr(kneser_ney, name, x)
    docs, labels = tables
    rows, good, ppl = _want(docs, labels)
    got = quality.classify(docs, labels).collect()
    fine = lambda x: None if x is None else round(math.log(x), 6)
    assert Counter((r.doc_id, r.trusted, fine(r.perplexity)) for r in got) == Counter(
        (r.doc_id, r.doc_id in good, None if p is None else round(p, 6)) for r, p in zip(rows, ppl))


def test_disk(spark):
    """Shuffle files and layers on disk at one time take few bytes a word."""
    docs, labels = (spark.read.parquet(f"{SF}/{x}.parquet") for x in ("documents", "labels"))
    n = sum(len(r.text.split()) for r in docs.collect() if r.text)
    local = [Path(str(d)) for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    layers = Path(ensure_checkpoint_dir(spark).removeprefix("file:"))

    def used():
        total = 0
        for top, kind in (*((d, "*/shuffle_*") for d in local), (layers, "kn-*/**/*.parquet")):
            for f in top.glob(kind):
                try:
                    total += f.stat().st_size
                except OSError:
                    pass  # gone meanwhile
        return total

    most, done, start = [0], threading.Event(), used()

    def watch():
        while not done.wait(0.05):
            most[0] = max(most[0], used() - start)

    t = threading.Thread(target=watch)
    t.start()
    try:
        quality.classify(docs, labels).count()
    finally:
        done.set()
        t.join()
    assert 0 < most[0] < 12 * n, most[0] / n


def test_model_is_written_once(tables, monkeypatch):  # noqa: F811
    """The counts of a shard are one copy on disk, though several parts read them."""
    monkeypatch.setattr(kneser_ney, "SHARD_WORDS", 60)
    kept, parts = [], []
    write, ask = kneser_ney.materialise, kneser_ney.asked
    monkeypatch.setattr(kneser_ney, "materialise", lambda df, name: [kept.append((out := write(df, name), out.filter("kind = 'model'").groupBy("s").count().collect())) if name == "kn-model" else (out := write(df, name))] and out)
    monkeypatch.setattr(kneser_ney, "asked", lambda docs, plan, n: parts.append(n) or ask(docs, plan, n))
    quality.classify(*tables).count()
    (_, model), = kept
    assert max(parts[0]) > 1
    assert model and {r["count"] for r in model} == {1} and max(r["s"] for r in model) < len(parts[0])


def test_words_in_parts():
    """Texts are hashed part by part, with the same words and hashes, in memory that the words take."""
    r = np.random.default_rng(1)
    say = lambda n: "".join(r.choice(list("abé ,.9\n"), n))
    texts = ["", None, *(say(int(n)) for n in r.integers(0, 3000, 60)), "", say(300_000), "x", None]
    col = pa.array(texts)
    text, w = kneser_ney.words(col)
    one = [kneser_ney._words(*text_bytes(pa.array([t]))) for t in texts]
    assert (text == np.repeat(np.arange(len(texts)), [len(x) for _, x in one])).all()
    assert (w == np.concatenate([x for _, x in one])).all()
    long = pa.array(["abcdefghi jklmnopqr " * 50] * 4000)  # 4 MB
    tracemalloc.start()
    kneser_ney.words(long)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 32 << 20, peak
