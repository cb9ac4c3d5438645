"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts every n-gram of every labelled training text (no sample): each
task sums the counts of its texts per language and bucket, Spark adds them up.
The log-probability matrix (languages x buckets) does not grow with the input
but with the number of languages; it is broadcast, in parts of at most
``MAX_LANGS`` languages, and whole texts are scored in numpy batches.

A text is lower-cased; runs of non-letters count as one space. The score is the posterior
of the predicted language. Defined results: a null or empty text, and one
without a letter, is ``und`` with score 0; ties go to the smaller language
name; a null ``lang`` or doc_id is not learned from; without any training text
everything is ``und``; ``held_out`` is false for a null doc_id; repeated rows
count as often as they stand. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.llm.text import U64, column, materialise, mix, read_documents, slices, text_bytes

ORDERS = (1, 2, 3)
BUCKETS = 1 << 14
MAX_LANGS = 1000
SMOOTHING = 0.5
FOLDS = 3
UNKNOWN = "und"
#: text bytes handled at once inside a task
SLICE = 1 << 18

_LETTER: list[np.ndarray] = []


def _letters() -> np.ndarray:
    if not _LETTER:
        t = np.zeros(0x110000, bool)
        t[[i for i in range(0x110000) if chr(i).isalpha()]] = True
        _LETTER.append(t)
    return _LETTER[0]


def ngrams(col: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed n-grams of all texts, the text of each, and whether a text has a letter."""
    texts = [(t or "").lower() for t in col.to_pylist()]
    n = len(texts)
    chars = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    doc = np.repeat(np.arange(n), [len(t) for t in texts])
    letter = _letters()[np.minimum(chars, 0x10FFFF)]
    has = np.bincount(doc[letter], minlength=n) > 0
    # letters as they are; of each run of others its first, as a space
    first = np.ones(len(chars), bool)
    first[1:] = (letter[:-1] | (doc[1:] != doc[:-1]))
    keep = letter | first
    c, d = np.where(letter, chars, 32)[keep].astype(U64), doc[keep]
    hs, ds = [], []
    for k in ORDERS:
        if len(c) < k:
            continue
        h = np.full(len(c) - k + 1, U64(k))
        for j in range(k):
            h = h * U64(1_000_003) + c[j:len(c) - k + 1 + j]
        same = d[:len(c) - k + 1] == d[k - 1:]
        hs.append((mix(h[same]) % U64(BUCKETS)).astype(np.int32))
        ds.append(d[:len(c) - k + 1][same])
    if not hs:
        return np.zeros(0, np.int32), np.zeros(0, np.int64), has
    return np.concatenate(hs), np.concatenate(ds), has


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 1, F.lit(False))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[str, np.ndarray] = {}
    texts: dict[str, int] = {}
    for b in slices(batches, "text", SLICE):
        h, d, _ = ngrams(column(b, "text"))
        langs = np.asarray(column(b, "lang").to_pylist(), object)
        names, code = np.unique(langs.astype(str), return_inverse=True)
        per = np.bincount(code[d] * BUCKETS + h, minlength=len(names) * BUCKETS).reshape(-1, BUCKETS)
        for i, name in enumerate(names):
            total[name] = total.get(name, 0) + per[i]
            texts[name] = texts.get(name, 0) + int((code == i).sum())
    for name, counts in total.items():
        at = np.flatnonzero(counts)
        yield pa.record_batch({"lang": pa.array([name] * (len(at) + 1), pa.string()),
                               "bucket": pa.array(np.append(at, -1).astype(np.int32)),
                               "n": pa.array(np.append(counts[at], texts[name]).astype(np.int64))})


class Part(NamedTuple):
    """Some languages, in order of their names, and their log probabilities, buckets by rows."""
    names: list[str]
    table: np.ndarray
    prior: np.ndarray


def train(labelled: DataFrame) -> list[Part]:
    """From (text, lang); rows without a language are left out. One part, or
    as many as it takes to have at most ``MAX_LANGS`` languages in each."""
    counts = (labelled.filter(F.col("lang").isNotNull()).select("text", "lang")
              .mapInArrow(_count, "lang string, bucket int, n long")
              .groupBy("lang", "bucket").agg(F.sum("n").alias("n")))
    counts = materialise(counts, "lang-counts")
    texts = {r.lang: r.n for r in counts.filter("bucket < 0").select("lang", "n").collect()}  # a row a language
    names, parts = sorted(texts, key=lambda x: x.encode()), []
    for i in range(0, len(names), MAX_LANGS):
        mine = names[i:i + MAX_LANGS]
        at = {x: j for j, x in enumerate(mine)}
        got = counts.filter((F.col("lang") >= mine[0]) & (F.col("lang") <= mine[-1]) & (F.col("bucket") >= 0)).toArrow()
        table = np.zeros((BUCKETS, len(mine)))
        table[got.column("bucket").to_numpy(), [at[x] for x in got.column("lang").to_pylist()]] = got.column("n").to_numpy()
        table = np.log(table + SMOOTHING) - np.log(table.sum(0) + SMOOTHING * BUCKETS)
        parts.append(Part(mine, table, np.log(np.array([texts[x] for x in mine]) / sum(texts.values()))))
    return parts


def predict(docs: DataFrame, model: list[Part], keep: list[str], text: str = "text") -> DataFrame:
    """The columns ``keep`` of ``docs``, lang_pred and score. ``text`` may be a field of a kept struct."""
    spark = docs.sparkSession
    shared = [spark.sparkContext.broadcast(p) for p in model]
    fields = docs.select(*keep)
    sent = docs.select(*keep) if text.split(".")[0] in keep else docs.select(*keep, text)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, text, SLICE):
            h, d, has = ngrams(column(b, text))
            n = b.num_rows
            pred, best, total = np.full(n, UNKNOWN, object), np.full(n, -np.inf), np.zeros(n)
            for part in shared:
                m = part.value
                like = np.stack([np.bincount(d, m.table[h, i], n) for i in range(len(m.names))], 1) + m.prior
                top, most = like.argmax(1), like.max(1)
                higher = np.maximum(best, most)
                total = total * np.exp(best - higher) + np.exp(like - most[:, None]).sum(1) * np.exp(most - higher)
                pred = np.where(most > best, np.asarray(m.names, object)[top], pred)  # an earlier name wins a tie
                best = higher
            known = has & bool(shared)
            pred = np.where(known, pred, UNKNOWN)
            post = np.where(known, 1 / np.where(known, total, 1), 0.0)
            yield pa.RecordBatch.from_arrays([column(b, c) for c in keep] + [pa.array(pred, pa.string()), pa.array(post, pa.float64())],
                                             names=[*keep, "lang_pred", "score"])

    schema = fields.schema.add("lang_pred", "string").add("score", "double")
    return sent.mapInArrow(score, schema)


def learn(docs: DataFrame) -> list[Part]:
    """Train on the documents that are not held out."""
    return train(docs.filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))))


def identify(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Train on the documents that are not held out, predict all."""
    return predict(docs, learn(docs), keep)


def op9_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir)
    return identify(docs, ["doc_id"]).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def accepted_documents(docs: DataFrame) -> DataFrame:
    """The documents whose language is known, with their columns as they are;
    those without text or without a letter are rejected (null text included),
    and all are where no document teaches a language. Rows count one by one."""
    rows = docs.select(F.struct("*").alias("_row"))
    return predict(rows, learn(docs), ["_row"], "_row.text").filter(F.col("lang_pred") != UNKNOWN).select("_row.*")
