"""Cross-tokenizer alignment against a per-text brute force."""
import hashlib
from collections import Counter

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tempora.llm import alignment as al

COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def brute(rows):
    v = al.Vocabularies.at(al.VOCABULARIES)
    na, nb = v.bytes_a.to_pylist(), v.bytes_b.to_pylist()
    docs, counts = [], Counter()
    for doc_id, text in rows:
        a = v.a.encode(" " + text, add_special_tokens=False).ids if text else []
        b = v.b.encode(text) if text else []
        whole = (" " + (text or "")).encode()
        if not text or b"".join(na[i] for i in a) != whole or b"".join(nb[i] for i in b) != whole:
            docs.append((doc_id, [], [], [], ""))
            continue
        ends = []
        for ids, names in ((a, na), (b, nb)):
            at, out = 0, {}
            for i in ids:
                at += len(names[i])
                out[at] = i
            ends.append(out)
        both = sorted(set(ends[0]) & set(ends[1]))
        links = [(ends[0][e], ends[1][e]) for e in both]
        counts.update(links)
        groups, lo = [], 0
        for e in both:
            groups.append("|".join(",".join(str(i) for at, i in side.items() if lo < at <= e) for side in ends))
            lo = e
        docs.append((doc_id, a, b, links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    return Counter((d, len(a), len(b), len(links), len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links), h)
                   for d, a, b, links, h in docs)


def run(spark, rows, schema="doc_id long, text string"):
    return Counter(tuple(r) for r in al.align_documents(spark.createDataFrame(rows, schema)).select(*COLUMNS).collect())


EDGES = [(1, "the cat sat on the mat"), (2, None), (3, ""), (4, " "), (5, "  two  spaces \n\n and\ttabs "), (6, "Ñandú ñócill 😀😀 <|endoftext|> <s> </s> <unk>"),
         (7, "the cat sat on the mat"), (None, "the cat"), (1, "the cat sat on the mat"), (8, "▁x ▁"), (9, "é ﬁne ½ 　"), (10, "\x00\x01\x7f"), (11, "<0x41> A"),
         (12, "漢字かな交じり文"), (13, "a" * 300)]


def test_edge_texts(spark):
    assert run(spark, EDGES) == brute(EDGES)


def test_a_piece_sign_in_the_text_has_no_tokens(spark):
    got = run(spark, [(8, "▁x")])
    assert got == Counter([(8, 0, 0, 0, 0, 0, 0, "")])


def test_pieces_change_no_token():
    v = al.Vocabularies.at(al.VOCABULARIES)
    texts = [t for _, t in EDGES if t] + ["  ".join("alpha beta, gamma\n delta".split(" ")) for _ in range(3)] + ["a b\u00a0 c \u3000d e\u2003 f é è\u0085 g\x1f h \x7f i",
             "it's  we 'll x" * 50, " lead and trail ", "1 2 3 4 11 22 ! ?", "\u00e9 \u00e8 \u4e2d \u6587 \u00a0"]
    got = v.encode(pa.array(texts)).ids(0, len(texts))
    assert v.parts
    assert got[0].to_pylist() == [v.a.encode(" " + t, add_special_tokens=False).ids for t in texts]
    assert got[1].to_pylist() == [v.b.encode(t) for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab'1. \n\té\u00a0\u3000\u2003中😀-"), max_size=40), max_size=6))
def test_pieces_of_any_text(texts):
    v = al.Vocabularies.at(al.VOCABULARIES)
    got = v.encode(pa.array(texts, pa.string())).ids(0, len(texts))
    assert got[0].to_pylist() == [v.a.encode(" " + t, add_special_tokens=False).ids if t else [] for t in texts]
    assert got[1].to_pylist() == [v.b.encode(t) if t else [] for t in texts]


def test_small_blocks(spark, monkeypatch):
    rows = [(i, " ".join(["alpha", "beta,", "gamma\n", "  delta"][(i * j) % 4] for j in range(40 + i))) for i in range(30)]
    monkeypatch.setattr(al, "BLOCK_BYTES", 500)
    monkeypatch.setattr(al, "SLICE", 100)
    assert run(spark, rows) == brute(rows)


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    got = Counter(tuple(r) for r in al.align_documents(docs.repartition(7)).select(*COLUMNS).collect())
    assert got == brute(rows)


@pytest.mark.parametrize("schema", ["doc_id long, text string, block long, a int, b int, total int"])
def test_clashing_columns_and_empty_table(spark, schema):
    assert not run(spark, [], schema)
    assert run(spark, [(1, "the cat", 5, 6, 7, 8)], schema) == brute([(1, "the cat")])


def test_links_of_ranges(spark, monkeypatch):
    import numpy as np
    doc = np.repeat(np.arange(3), 5).astype(np.int64)
    end = np.tile(np.arange(1, 6), 3).astype(np.int64)
    a = (doc, np.arange(15, dtype=np.int32), end)
    b = (doc[::2], np.arange(8, dtype=np.int32), end[::2])
    got = al._links(a, b)
    assert sorted(zip(*(got.column(c).to_pylist() for c in ("doc", "end")))) == sorted(zip(doc[::2].tolist(), end[::2].tolist()))
