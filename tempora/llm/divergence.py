"""Source divergence audit by chunk factorisation.

How far the vocabulary of each (language, source) group lies from the other
sources of its language, and which terms set it apart from the language.

1. A block of documents is split at white space with Arrow; its chunks are
   counted per document and listed once per block (``factor``).
2. The blocks' chunk lists are dealt to buckets by the chunk's hash; a bucket
   splits every distinct chunk of the corpus that falls to it into terms, once.
3. The terms go back to the blocks, and a block adds up, per group and term,
   its distinct documents and occurrences.
4. These sums are dealt to buckets by the term's hash, where those of all blocks
   are added up. All of a term is in one bucket, so the bucket decides which
   languages keep it: those with at least ``least`` documents that hold it.
5. Every group and every language gives each kept term, zero counts included,
   the weight p = 1 + floor(10^9 (count + 2) / (N + 2 V)). With the totals of all
   buckets known, each bucket adds up every pair of sources over its terms, in
   tables of sources by terms of bounded size, and gives each group's highest
   terms; Spark adds up the pairs and ranks.

What is shuffled are packed lists (strings and numbers, zstd); a chunk or term
is in at most one list of a block, so none is hot. Buckets grow in number with
the text bytes, so their size is bounded.

Arithmetic is exact (integers throughout; Python's own beyond 64 bits).
Defined results: null text, lang and source are ''; a language without a kept
term has value 0 for every pair and no term rows; a language with a single
source has no pair rows; an empty table gives no rows; equal rows are
documents of their own; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tempora.llm.factor import BlockIds, coded, pack_strings, squeeze, squeeze_rising, string_hash, unpack_strings, unsqueeze, unsqueeze_rising
from tempora.llm.text import U64, column, materialise, read_documents, slices, spread

#: what lies between two terms [^\x00-\x40\x5B-\x60\x7B-\x7F]+ of a lower-cased chunk
BETWEEN = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
LEAST = 10
TOP = 10
SCALE = 1_000_000_000
#: text bytes of a block, text bytes to a bucket, numbers of a table of sources by terms
BLOCK_BYTES, BUCKET_BYTES, CELLS = 16 << 20, 32 << 20, 1 << 20
#: counts up to here keep SCALE * (count + 2) within 64 bits
EXACT = (1 << 63) // SCALE - 3

GROUPS = "langs array<string>, sources array<string>"
BLOCKS = f"block long, {GROUPS}, groups binary, sizes binary, at binary, n binary, lists array<struct<bucket:int, first:int, chunks:binary>>"
SPLIT = "block long, first int, held binary, terms binary"
SUMS = f"bucket int, {GROUPS}, terms binary, held binary, grp binary, docs binary, n binary"
KEPT = "lang string, bucket int, v long, lang_total long, names array<string>, totals array<long>, terms binary, lang_n binary, held binary, src binary, n binary"
PARTS = "lang string, source string, part string, item string, value long"


def _arrow(schema: str, spark: SparkSession) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(spark.createDataFrame([], schema).schema)


def _record(schema: pa.Schema, rows: list[tuple]) -> pa.Table:
    return pa.table([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


def _dealt(strings: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of distinct strings by bucket and code points, and the buckets in that order."""
    of = (string_hash(strings) % U64(buckets)).astype(np.int64)
    order = pc.sort_indices(strings).to_numpy().astype(np.int64)
    order = order[np.argsort(of[order], kind="stable")]
    return order, of[order]


def _runs(x: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(value, start, stop) of every run of a sorted array."""
    cut = np.flatnonzero(np.diff(x, prepend=-1))
    for i, j in zip(cut, np.append(cut[1:], len(x))):
        yield int(x[i]), int(i), int(j)


def chunk_blocks(docs: DataFrame, buckets: int) -> DataFrame:
    """Blocks of documents (text, lang, source): chunk counts per document, by position in the block's chunks, which are listed by bucket."""
    schema = _arrow(BLOCKS, docs.sparkSession)

    def block(b: pa.RecordBatch, ident: int) -> tuple:
        words = pc.ascii_split_whitespace(column(b, "text").cast(pa.large_string()))
        doc, word = pc.list_parent_indices(words), pc.list_flatten(words)
        some = pc.not_equal(word, "")
        at, chunks = coded(word.filter(some))
        order, of = _dealt(chunks, buckets)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        size = max(len(chunks), 1)
        pair, n = np.unique(doc.filter(some).to_numpy().astype(np.int64) * size + place[at], return_counts=True)
        doc, at = pair // size, pair % size
        first = np.flatnonzero(np.diff(doc, prepend=-1))
        names: dict[tuple[str, str], int] = {}
        group = np.array([names.setdefault(g, len(names)) for g in zip(column(b, "lang").to_pylist(), column(b, "source").to_pylist())], np.int64)
        chunks = chunks.take(pa.array(order))
        return (ident, [g[0] for g in names], [g[1] for g in names], squeeze(group[doc[first]]), squeeze(np.diff(np.append(first, len(doc)))),
                squeeze_rising(at, first), squeeze(n), [{"bucket": k, "first": i, "chunks": pack_strings(chunks[i:j])} for k, i, j in _runs(of)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        new = BlockIds()
        for b in slices(batches, "text", BLOCK_BYTES):
            yield from _record(schema, [block(b, new())]).to_batches()

    return docs.select("text", "lang", "source").mapInArrow(run, BLOCKS)


def split_chunks(chunks: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Number of terms of every chunk, and all terms."""
    parts = pc.split_pattern_regex(pc.ascii_lower(chunks), BETWEEN)
    of, term = pc.list_parent_indices(parts), pc.list_flatten(parts)
    some = pc.not_equal(term, "")
    return np.bincount(of.filter(some).to_numpy(), minlength=len(chunks)), term.filter(some)


def split_lists(lists: DataFrame) -> DataFrame:
    """Per block and bucket the terms of its chunks; every distinct chunk is split once."""
    schema = _arrow(SPLIT, lists.sparkSession)

    def run(t: pa.Table) -> pa.Table:
        rows = [unpack_strings(x.as_py()) for x in t.column("chunks")]
        code, distinct = coded(pa.concat_arrays(rows))
        held, terms = split_chunks(distinct)
        start = np.cumsum(held) - held
        out, at = [], 0
        for block, first, mine in zip(t.column("block").to_pylist(), t.column("first").to_pylist(), rows):
            c = code[at:at + len(mine)]
            at += len(mine)
            out.append((block, first, squeeze(held[c]), pack_strings(terms.take(pa.array(spread(start[c], held[c]))))))
        return _record(schema, out)

    return lists.groupBy("bucket").applyInArrow(run, SPLIT)


def block_sums(split: DataFrame, blocks: DataFrame, buckets: int) -> DataFrame:
    """Per block and bucket of terms: documents and occurrences of every term in every group."""
    schema = _arrow(SUMS, blocks.sparkSession)

    def run(found: pa.Table, block: pa.Table) -> pa.Table:
        if not found.num_rows:
            return schema.empty_table()
        found = found.sort_by("first")
        row = {c: block.column(c)[0].as_py() for c in ("langs", "sources", "groups", "sizes", "at", "n")}
        group, sizes = unsqueeze(row["groups"]), unsqueeze(row["sizes"])
        first = np.cumsum(sizes) - sizes
        at, n = unsqueeze_rising(row["at"], first), unsqueeze(row["n"])
        doc = np.repeat(np.arange(len(sizes)), sizes)
        held = np.concatenate([unsqueeze(x.as_py()) for x in found.column("held")])
        code, terms = coded(pa.concat_arrays([unpack_strings(x.as_py()) for x in found.column("terms")]))
        if not len(terms):
            return schema.empty_table()
        order, of = _dealt(terms, buckets)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        code, terms = place[code], terms.take(pa.array(order))
        start, many = np.cumsum(held) - held, held[at]
        term, doc, n = code[spread(start[at], many)], np.repeat(doc, many), np.repeat(n, many)
        # documents count once per term, then groups add up, by term
        size, k = len(terms), len(row["langs"])
        pair, inv = np.unique(doc * size + term, return_inverse=True)
        n = np.bincount(inv, n).astype(np.int64)
        key, inv = np.unique(pair % size * k + group[pair // size], return_inverse=True)
        docs, n = np.bincount(inv), np.bincount(inv, n).astype(np.int64)
        first, grp = np.searchsorted(key, np.arange(size + 1) * k), key % k
        out = []
        for bucket, i, j in _runs(of):
            a, b = first[i], first[j]
            here, g = np.unique(grp[a:b], return_inverse=True)
            out.append((bucket, [row["langs"][x] for x in here], [row["sources"][x] for x in here], pack_strings(terms[i:j]),
                        squeeze(np.diff(first[i:j + 1])), squeeze(g), squeeze(docs[a:b]), squeeze(n[a:b])))
        return _record(schema, out)

    own = blocks.select(F.col("block").alias("own"), "langs", "sources", "groups", "sizes", "at", "n")
    return split.groupBy("block").cogroup(own.groupBy("own")).applyInArrow(run, SUMS)


def kept_terms(sums: DataFrame, least: int) -> DataFrame:
    """Per language and bucket the kept terms with their counts by source."""
    schema = _arrow(KEPT, sums.sparkSession)

    def run(t: pa.Table) -> pa.Table:
        names: dict[tuple[str, str], int] = {}
        terms, group, docs, n = [], [], [], []
        for r in t.to_batches(1):
            row = {c: r.column(i)[0].as_py() for i, c in enumerate(r.schema.names)}
            code = np.array([names.setdefault(g, len(names)) for g in zip(row["langs"], row["sources"])], np.int64)
            terms.append((unpack_strings(row["terms"]), unsqueeze(row["held"])))
            group.append(code[unsqueeze(row["grp"])])
            docs.append(unsqueeze(row["docs"]))
            n.append(unsqueeze(row["n"]))
        code, distinct = coded(pa.concat_arrays([x for x, _ in terms]))
        term = np.repeat(code, np.concatenate([h for _, h in terms]))
        size, k = len(distinct), len(names)
        key, inv = np.unique(term * k + np.concatenate(group), return_inverse=True)
        docs, n = (np.bincount(inv, np.concatenate(x)).astype(np.int64) for x in (docs, n))
        term, group = key // k, key % k
        langs, sources = sorted({g[0] for g in names}), [g[1] for g in names]
        at = {x: i for i, x in enumerate(langs)}
        of = np.array([at[g[0]] for g in names], np.int64)[group]
        pair, inv = np.unique(of * size + term, return_inverse=True)
        good = np.bincount(inv, docs) >= least
        lang_n = np.bincount(inv, n).astype(np.int64)
        rows = np.flatnonzero(good[inv])
        rows = rows[np.argsort(inv[rows], kind="stable")]
        out, bucket = [], t.column("bucket")[0].as_py()
        for i, a, b in _runs(of[rows]):
            mine = rows[a:b]
            here, held = np.unique(inv[mine], return_counts=True)
            used, src = np.unique(group[mine], return_inverse=True)
            out.append((langs[i], bucket, len(here), int(lang_n[here].sum()), [sources[x] for x in used], np.bincount(src, n[mine]).astype(np.int64).tolist(),
                        pack_strings(distinct.take(pa.array(pair[here] % size))), pack_longs(lang_n[here]), squeeze(held), squeeze(src), pack_longs(n[mine])))
        return _record(schema, out)

    return sums.groupBy("bucket").applyInArrow(run, KEPT)


def weight(count: np.ndarray, total: np.ndarray | int, kept: int) -> np.ndarray:
    """p = 1 + floor(SCALE (count + 2) / (total + 2 kept)), exact."""
    if len(count) and int(count.max()) > EXACT:
        count = count.astype(object)
    return (1 + (count + 2) * SCALE // (total + 2 * kept)).astype(np.int64)


def gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def bucket_parts(kept: DataFrame, stats: DataFrame, top: int, cells: int) -> DataFrame:
    """Partial sums of every pair of sources, and the highest terms of every group, of each language and bucket."""
    schema = _arrow(PARTS, kept.sparkSession)

    def run(t: pa.Table, all_sources: pa.Table) -> pa.Table:
        if not t.num_rows:
            return schema.empty_table()
        row = {c: t.column(c)[0].as_py() for c in ("lang", "names", "terms", "lang_n", "held", "src", "n")}
        names = all_sources.column("source").combine_chunks()
        total = all_sources.column("total").to_numpy()
        v, lang_total = (all_sources.column(c)[0].as_py() for c in ("v", "lang_total"))
        src = pc.index_in(pa.array(row["names"], pa.string()), names).to_numpy(zero_copy_only=False)[unsqueeze(row["src"])].astype(np.int64)
        held, n, terms = unsqueeze(row["held"]), unpack_longs(row["n"]), unpack_strings(row["terms"])
        term = np.repeat(np.arange(len(held)), held)
        p, q = weight(n, total[src], v), weight(unpack_longs(row["lang_n"]), lang_total, v)[term]
        p0 = weight(np.zeros(len(total), np.int64), total, v)

        k, value = len(names), np.zeros((len(names), len(names)), np.int64)
        step, first = max(1, cells // k), np.append(0, np.cumsum(held))
        for lo in range(0, len(held) if k > 1 else 0, step):
            hi = min(lo + step, len(held))
            a, b = first[lo], first[hi]
            table = np.repeat(p0[:, None], hi - lo, 1)
            table[src[a:b], term[a:b] - lo] = p[a:b]
            for i in range(k - 1):
                value[i, i + 1:] += gap(table[i], table[i + 1:]).sum(1)
        value += value.T
        one, two = np.nonzero(~np.eye(k, dtype=bool))

        above = np.flatnonzero(p > q)
        f = gap(p[above], q[above])
        rank = np.argsort(pc.sort_indices(terms).to_numpy(), kind="stable")  # of every term by its bytes
        order = np.lexsort((rank[term[above]], -f, src[above]))
        s = src[above][order]
        place = np.arange(len(s)) - np.searchsorted(s, s)
        best = order[place < top]
        item = terms.take(pa.array(term[above][best])).cast(pa.string())
        of = np.concatenate((one, src[above][best]))
        return pa.table([pa.array([row["lang"]] * len(of), pa.string()), names.take(pa.array(of)), pa.array(["pair"] * len(one) + ["term"] * len(best), pa.string()),
                         pa.concat_arrays([names.take(pa.array(two)), item]), pa.array(np.concatenate((value[one, two], f[best])))], schema=schema)

    wide = (kept.select("lang", "bucket").join(stats, "lang")
            .select(F.col("lang").alias("of"), F.col("bucket").alias("place"), "source", "total", "v", "lang_total"))
    return kept.groupBy("lang", "bucket").cogroup(wide.groupBy("of", "place")).applyInArrow(run, PARTS)


def pack_longs(x: np.ndarray) -> bytes:
    """Non-negative 64-bit integers, high halves apart."""
    low = squeeze(x & 0xFFFFFFFF)
    return len(low).to_bytes(8, "little") + low + squeeze(x >> 32)


def unpack_longs(b: bytes) -> np.ndarray:
    at = 8 + int.from_bytes(b[:8], "little")
    return unsqueeze(b[8:at]) + (unsqueeze(b[at:]) << 32)


def audit(docs: DataFrame, least: int = LEAST, top: int = TOP, bucket_bytes: int = BUCKET_BYTES, cells: int = CELLS) -> DataFrame:
    """(lang, source, part, item, value, rank) over documents (text, lang, source)."""
    docs = docs.select(*(F.coalesce(c, F.lit("")).alias(c) for c in ("text", "lang", "source")))
    sizes = materialise(docs.groupBy("lang", "source").agg(F.sum(F.octet_length("text")).alias("bytes")), "divergence-groups")
    groups = sizes.select("lang", "source")
    buckets = max(12, -(-(sizes.agg(F.sum("bytes")).first()[0] or 0) // bucket_bytes))

    blocks = materialise(chunk_blocks(docs, buckets), "divergence-blocks")
    split = split_lists(blocks.select("block", F.explode("lists").alias("l")).select("block", "l.bucket", "l.first", "l.chunks"))
    kept = materialise(kept_terms(block_sums(split, blocks, buckets), least), "divergence-kept")

    per_lang = kept.groupBy("lang").agg(F.sum("v").alias("v"), F.sum("lang_total").alias("lang_total"))
    per_group = (kept.select("lang", F.explode(F.arrays_zip("names", "totals")).alias("x"))
                 .groupBy("lang", F.col("x.names").alias("source")).agg(F.sum("x.totals").alias("total")))
    stats = materialise(groups.join(per_lang, "lang").join(per_group, ["lang", "source"], "left").na.fill(0, ["total"]), "divergence-stats")
    parts = materialise(bucket_parts(kept, stats, top, cells), "divergence-parts")
    # pairs of languages without a kept term
    zero = groups.join(groups.select("lang", F.col("source").alias("item")), "lang").filter("source <> item").select("lang", "source", F.lit("pair").alias("part"), "item", F.lit(0).cast("long").alias("value"))
    none = zero.join(per_lang.select("lang"), "lang", "left_anti")
    pairs = parts.filter("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    terms = parts.filter("part = 'term'").select(*pairs.columns)  # a term is in one bucket
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = lambda df: df.withColumn("rank", F.row_number().over(order))
    # apart, so that every task keeps only the first terms of a group before they are shuffled
    return ranked(pairs.unionByName(none.select(*pairs.columns))).unionByName(ranked(terms).filter(F.col("rank") <= top))


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(read_documents(spark, sf_dir))
