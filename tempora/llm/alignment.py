"""Cross-tokenizer alignment: where the tokens of two vocabularies end together.

A text is encoded twice: space+text by the byte-level BPE (A), the text by the
sentence-piece BPE (B), which leads with a space of its own. Inside a task all
of it is Arrow:

1. token ids are lists; flattened, with parent indices, they become rows
   (doc, id), and segmented cumulative sums of the tokens' byte lengths their
   end offsets;
2. an Acero hash join on (doc, end) gives the links; the common ends cut the
   tokens into groups;
3. ``Table.group_by`` counts the id pairs of a block, and of each document.

Spark adds up the pair counts of all blocks, finds the highest of every B id,
joins both back to the blocks' lists of pairs (a pair has one row per block at
most, see ``factor``), and each block adds them up per document.

Token bytes come from the vocabulary files alone. Neither vocabulary has a
token that goes on from a non-space into a space (checked when they are read),
so cutting a text before a single space between two non-spaces changes no token
(B's own leading space then stands for that space). A block's texts are cut
there, and every distinct piece of the block is encoded once; lists of ids are
put together by Arrow again. Joins run over ranges of tokens, so a long text
is not joined at once.

Defined results: a text that is null or empty, or whose joined A or B bytes
differ from space+text, has no tokens: zeros and ''; equal rows are documents
of their own and each count; doc_id may be null or repeat; an empty table gives
no rows; other columns are not read. The vocabulary files' folder is a
parameter; it must be readable on every executor.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.llm.factor import BlockIds, coded, rising, squeeze, squeeze_rising, unsqueeze, unsqueeze_rising
from tempora.llm.text import column, materialise, read_documents, slices, text_bytes

VOCABULARIES = "/opt/tokenizers"
FILE_A, FILE_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: text bytes joined at once, and of a block
SLICE, BLOCK_BYTES = 1 << 20, 16 << 20

BLOCKS = ("block long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, groups_sha256 array<string>, "
          "sizes binary, at binary, m binary, a array<int>, b array<int>, n array<long>")
RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
WHOLE = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")


def byte_of_char() -> dict[str, int]:
    """Byte-level BPE writes a byte as the character of its code where that is
    printable in Latin-1, and the others, in order, as characters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabularies:
    """Both tokenizers with the bytes of every token; one per worker process."""

    _kept: dict[str, Vocabularies] = {}

    def __init__(self, folder: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer
        path = os.path.join(folder, FILE_A)
        self.a = Tokenizer.from_file(path)
        self.a.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            special = {t["id"] for t in json.load(f).get("added_tokens", ())}
        of = byte_of_char()
        names = self.a.get_vocab(with_added_tokens=True)
        self.bytes_a = self._table({i: t.encode() if i in special else bytes(of[c] for c in t) for t, i in names.items()})
        self.b = SentencePieceProcessor(model_file=os.path.join(folder, FILE_B))
        self.bytes_b = self._table({i: self._piece(i) for i in range(self.b.get_piece_size())})
        # the law that lets long texts be cut: no token goes on from a non-space into a space
        self.parts = not any(re.search(r"\S ", x.decode(errors="replace")) for t in (self.bytes_a, self.bytes_b) for x in t.to_pylist())

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    @staticmethod
    def _table(names: dict[int, bytes]) -> pa.Array:
        return pa.array([names.get(i, b"") for i in range(max(names) + 1)], pa.large_binary())

    @classmethod
    def at(cls, folder: str) -> Vocabularies:
        if folder not in cls._kept:
            cls._kept[folder] = cls(folder)
        return cls._kept[folder]

    def encode(self, texts: pa.Array) -> Encoded:
        """Token ids of a block of texts by A (of space+text) and by B; '' has none."""
        lead = pc.binary_join_element_wise(pa.scalar("", pa.large_string()), texts.cast(pa.large_string()), pa.scalar(" ", pa.large_string()))
        buf, offs = text_bytes(pc.if_else(pc.equal(texts, ""), pa.scalar("", pa.large_string()), lead))
        start = rising(np.append(cuts(buf) if self.parts else np.zeros(0, np.int64), offs[:-1][np.diff(offs) > 0]))
        pieces = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(np.append(start, len(buf)).astype(np.int64)), pa.py_buffer(buf))
        code, distinct = coded(pieces)
        whole = distinct.to_pylist()
        sides = []
        for ids in ([e.ids for e in self.a.encode_batch_fast(whole, add_special_tokens=False)] if whole else [],
                    self.b.encode([x[1:] for x in whole], num_threads=1) if whole else []):
            sides.append(pa.array(ids, pa.list_(pa.int32())))
        return Encoded(np.searchsorted(start, offs), code, sides[0], sides[1])


class Encoded(NamedTuple):
    """Every text's pieces (from ``first``, one more entry than texts) as codes of distinct pieces, and these pieces' ids."""
    first: np.ndarray
    code: np.ndarray
    a: pa.ListArray
    b: pa.ListArray

    def ids(self, i: int, j: int) -> tuple[pa.ListArray, pa.ListArray]:
        """The ids of texts i to j - 1 by A and by B."""
        code = pa.array(self.code[self.first[i]:self.first[j]])
        out = []
        for side in (self.a, self.b):
            mine = side.take(code)
            ends = np.append(0, np.cumsum(pc.list_value_length(mine).to_numpy()))[self.first[i:j + 1] - self.first[i]]
            out.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pc.list_flatten(mine)))
        return out[0], out[1]


def cuts(buf: np.ndarray) -> np.ndarray:
    """Places of the single spaces between two characters that are not white
    space. Control characters, and the characters of the four lead bytes that
    other white space begins with, count as white space: no cut, no harm."""
    if len(buf) < 3:
        return np.zeros(0, np.int64)
    plain = (buf > 0x20) & (buf != 0x7F)
    two, three = buf == 0xC2, (buf >= 0xE1) & (buf <= 0xE3)
    for lead, size in ((two, 2), (three, 3)):
        at = np.flatnonzero(lead)
        for k in range(size):
            plain[np.minimum(at + k, len(buf) - 1)] = False
    return np.flatnonzero((buf[1:-1] == 0x20) & plain[:-2] & plain[2:]) + 1


def _tokens(ids: pa.ListArray, names: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """doc, id and end of every token, and all token bytes with every document's first (one more entry)."""
    doc, flat = pc.list_parent_indices(ids).to_numpy(), pc.list_flatten(ids)
    data, offs = text_bytes(names.take(flat))
    first = offs[ids.offsets.to_numpy()]
    return doc, flat.to_numpy(), offs[1:] - first[doc], data, first


def _same_bytes(data: np.ndarray, first: np.ndarray, want: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Which documents' bytes are the wanted ones."""
    same = np.diff(first) == np.diff(offs)
    for i in np.flatnonzero(same):
        same[i] = np.array_equal(data[first[i]:first[i + 1]], want[offs[i]:offs[i + 1]])
    return same


def _links(a: tuple, b: tuple) -> pa.Table:
    """(doc, end, a, b): tokens (doc, id, end) of both sides that end together, joined over ranges of the first side's tokens."""
    parts, step = [], 1 << 20
    key = [(x[0] << 40) + x[2] for x in (a, b)]
    cuts = key[0][::step]
    for lo, hi in zip(cuts, [*cuts[1:], None]):
        rows = []
        for k, (doc, ident, end), name in ((key[0], a, "a"), (key[1], b, "b")):
            i, j = np.searchsorted(k, lo), len(k) if hi is None else np.searchsorted(k, hi)
            rows.append(pa.table({"doc": doc[i:j], "end": end[i:j], name: ident[i:j]}))
        parts.append(rows[0].join(rows[1], keys=["doc", "end"], join_type="inner", use_threads=False))
    none = pa.schema([("doc", pa.int64()), ("end", pa.int64()), ("a", pa.int32()), ("b", pa.int32())]).empty_table()
    return pa.concat_tables([none, *(p.select(none.column_names) for p in parts)]).combine_chunks()


def _listed(ids: np.ndarray, group: np.ndarray, groups: int) -> pa.Array:
    """The ids of every group, comma-joined."""
    ends = np.append(0, np.cumsum(np.bincount(group, minlength=groups)))
    text = pa.array(ids).cast(pa.string())
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), text), ",")


def align(texts: pa.Array, ids: tuple[pa.ListArray, pa.ListArray], vocabularies: Vocabularies) -> tuple[dict[str, np.ndarray | list], pa.Table]:
    """n_a, n_b, n_groups, n_links and groups_sha256 of every text, and its counted id pairs (doc, a, b, m)."""
    n = len(texts)
    want, offs = text_bytes(pc.binary_join_element_wise(pa.scalar("", pa.large_string()), texts.cast(pa.large_string()), pa.scalar(" ", pa.large_string())))
    sides = [_tokens(x, t) for x, t in zip(ids, (vocabularies.bytes_a, vocabularies.bytes_b))]
    good = np.array(pc.not_equal(texts, "").to_numpy(zero_copy_only=False), bool)
    for _, _, _, data, first in sides:
        good &= _same_bytes(data, first, want, offs)
    a, b = (tuple(x[good[doc]] for x in (doc.astype(np.int64), ident, end)) for doc, ident, end, _, _ in sides)
    links = _links(a, b)
    ends = rising((links.column("doc").to_numpy() << 40) + links.column("end").to_numpy())
    of = ends >> 40
    joined = pc.binary_join_element_wise(*(_listed(x[1], np.searchsorted(ends, (x[0] << 40) + x[2]), len(ends)) for x in (a, b)), "|")
    first = np.searchsorted(of, np.arange(n + 1))
    lines = pc.binary_join(pa.ListArray.from_arrays(pa.array(first, pa.int32()), joined), ";")
    per = {"n_a": np.bincount(a[0], minlength=n), "n_b": np.bincount(b[0], minlength=n), "n_groups": np.diff(first),
           "n_links": np.bincount(links.column("doc").to_numpy(), minlength=n),
           "groups_sha256": [hashlib.sha256(x.as_buffer()).hexdigest() if g else "" for x, g in zip(lines, good)]}
    return per, links.group_by(["doc", "a", "b"], use_threads=False).aggregate([([], "count_all")]).rename_columns(["doc", "a", "b", "m"])


def _block(ident: int, doc_id: list, per: list[dict], pairs: list[pa.Table]) -> pa.RecordBatch:
    n = len(doc_id)
    rows = pa.concat_tables(pairs)
    counted = rows.group_by(["a", "b"], use_threads=False).aggregate([("m", "sum")]).sort_by([("a", "ascending"), ("b", "ascending")])
    a, b = counted.column("a").to_numpy(), counted.column("b").to_numpy()
    at = np.searchsorted((a.astype(np.int64) << 32) + b, (rows.column("a").to_numpy().astype(np.int64) << 32) + rows.column("b").to_numpy())
    doc = rows.column("doc").to_numpy()
    order = np.lexsort((at, doc))
    sizes = np.bincount(doc, minlength=n)
    first = (np.cumsum(sizes) - sizes)[sizes > 0]
    out = {"block": [ident], "doc_id": [doc_id]}
    for c in WHOLE[1:]:
        out[c] = [np.concatenate([p[c] for p in per]) if c != "groups_sha256" else [x for p in per for x in p[c]]]
    out |= {"sizes": [squeeze(sizes)], "at": [squeeze_rising(at[order], first)], "m": [squeeze(rows.column("m").to_numpy()[order])],
            "a": [a], "b": [b], "n": [counted.column("m_sum").to_numpy()]}
    kinds = {"block": pa.int64(), "groups_sha256": pa.list_(pa.string()), "sizes": pa.binary(), "at": pa.binary(), "m": pa.binary(),
             "a": pa.list_(pa.int32()), "b": pa.list_(pa.int32())}
    return pa.record_batch({c: pa.array(x, kinds.get(c, pa.list_(pa.int64()))) for c, x in out.items()})


def aligned_blocks(docs: DataFrame, folder: str = VOCABULARIES) -> DataFrame:
    """Blocks of documents (doc_id, text) with their alignment and id pairs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        new, vocabularies = BlockIds(), Vocabularies.at(folder)
        for b in slices(batches, "text", BLOCK_BYTES):
            texts, per, pairs, i = column(b, "text").fill_null(""), [], [], 0
            encoded = vocabularies.encode(texts)
            size = pc.binary_length(texts).to_numpy().cumsum()
            while i < len(texts):
                j = max(i + 1, int(np.searchsorted(size, (size[i - 1] if i else 0) + SLICE)))
                got, found = align(texts.slice(i, j - i), encoded.ids(i, j), vocabularies)
                per.append(got)
                pairs.append(found.set_column(0, "doc", pc.add(found.column("doc"), i)))
                i = j
            yield _block(new(), column(b, "doc_id").to_pylist(), per, pairs)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, BLOCKS)


def _judge(found: pa.Table, blocks: pa.Table) -> pa.Table:
    """The result rows of one block, from its pairs' corpus-wide counts."""
    row = {c: blocks.column(c)[0] for c in (*WHOLE, "sizes", "at", "m")}
    sizes = unsqueeze(row["sizes"].as_py())
    first = (np.cumsum(sizes) - sizes)[sizes > 0]
    best, total = (np.zeros(len(sizes), np.int64) for _ in range(2))
    if found.num_rows:
        at, m = unsqueeze_rising(row["at"].as_py(), first), unsqueeze(row["m"].as_py())
        pos = found.column("pos").to_numpy()
        count, top = (np.zeros(len(pos), np.int64) for _ in range(2))
        count[pos], top[pos] = found.column("total").to_numpy(), found.column("best").to_numpy(zero_copy_only=False)
        some = sizes > 0
        best[some], total[some] = np.add.reduceat(m * top[at], first), np.add.reduceat(m * count[at], first)
    lists = {c: row[c].values for c in WHOLE}
    lists |= {"n_best": pa.array(best), "count_sum": pa.array(total)}
    return pa.table({f.split()[0]: lists[f.split()[0]] for f in RESULT.split(", ")})


def align_documents(docs: DataFrame, folder: str = VOCABULARIES) -> DataFrame:
    """Per document its tokens, groups and links of both vocabularies, and how its links count in the corpus."""
    blocks = materialise(aligned_blocks(docs, folder), "alignment-blocks")
    pairs = blocks.select("block", F.posexplode(F.arrays_zip("a", "b", "n")).alias("pos", "p")).select("block", "pos", "p.a", "p.b", "p.n")
    totals = materialise(pairs.groupBy("a", "b").agg(F.sum("n").alias("total")), "alignment-pairs")
    # one row per B id: bounded by that vocabulary
    highest = totals.groupBy("b").agg(F.max("total").alias("most"))
    judged = totals.join(F.broadcast(highest), "b").select("a", "b", "total", (F.col("total") == F.col("most")).alias("best"))
    found = pairs.drop("n").join(judged, ["a", "b"]).select("block", "pos", "total", "best")
    own = blocks.select(F.col("block").alias("own"), *WHOLE, "sizes", "at", "m")
    return found.groupBy("block").cogroup(own.groupBy("own")).applyInArrow(_judge, RESULT)


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_documents(read_documents(spark, sf_dir))
