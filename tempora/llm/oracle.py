"""DuckDB SQL of the corpus queries that SQL can express."""

from __future__ import annotations

from tempora.llm.licenses import TEMPLATES

WORD = r"[^\x20\x09-\x0D]+"
ITEM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

MIXING = rf"""
WITH s AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, 'null')) AS k, md5(coalesce(text, '')) AS tie
  FROM documents),
per AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS n
  FROM s GROUP BY source),
weighed AS (
  SELECT *, [5.0, 2.0, 1.0][(n - 1) % 3 + 1]::DOUBLE AS weight, (2 * source_size)::DOUBLE AS cap FROM per),
want AS (SELECT sum(source_size)::DOUBLE * 1.5 AS words FROM per),
-- the level that is reached when exactly the sources filling up before this one are full
tried AS (
  SELECT a.n, a.cap / a.weight AS fills, a.cap, a.weight,
         ((SELECT words FROM want) - coalesce(sum(b.cap) FILTER (b.cap / b.weight < a.cap / a.weight
             OR b.cap / b.weight = a.cap / a.weight AND b.n < a.n), 0))
         / sum(b.weight) FILTER (b.cap / b.weight > a.cap / a.weight
             OR b.cap / b.weight = a.cap / a.weight AND b.n >= a.n) AS level
  FROM weighed a, weighed b GROUP BY a.n, a.cap, a.weight),
chosen AS (SELECT level FROM tried WHERE level * weight <= cap ORDER BY fills, level LIMIT 1),
goal AS (
  SELECT source, source_size, least(cap, coalesce((SELECT level FROM chosen) * weight, cap)) AS target FROM weighed),
placed AS (
  SELECT s.*, g.source_size, g.target, floor(g.target)::BIGINT AS budget,
         coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY k, tie, size
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS place
  FROM s JOIN goal g ON s.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
       CASE WHEN source_size = 0 THEN 0
            ELSE (budget // source_size) * size + least(size, greatest(0, budget % source_size - place)) END::BIGINT AS taken
FROM placed
"""

#: The CRC-32 step for four bits: table[i] is i run through four steps of the reversed polynomial 0xEDB88320.
NIBBLES = """[0, 498536548, 997073096, 651767980, 1994146192, 1802195444, 1303535960, 1342533948,
              3988292384, 4027552580, 3604390888, 3412177804, 2607071920, 2262029012, 2685067896, 3183342108]"""

SHARDING = f"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rid, doc_id, encode(coalesce(text, '')) AS b,
         md5(coalesce(doc_id::VARCHAR, 'null')) AS k, md5(coalesce(text, '')) AS tie
  FROM documents),
bytes AS (
  SELECT rid, list_transform(regexp_extract_all(hex(b), '..'), lambda h: ('0x' || h)::BIGINT) AS v FROM d),
crc AS (
  SELECT rid, xor(list_reduce(list_prepend(4294967295::BIGINT, v), lambda c, x:
    xor(xor(c, x) >> 8, xor({NIBBLES}[(xor(xor(c, x) >> 4, {NIBBLES}[(xor(c, x) & 15) + 1]) & 15) + 1],
                            {NIBBLES}[(xor(c, x) & 15) + 1] >> 4))), 4294967295)::BIGINT AS text_crc32
  FROM bytes),
shards(n) AS (VALUES (8), (9)),
jump(id, n, state, b, j) AS (
  SELECT i, n, CASE WHEN i < 0 THEN i + 18446744073709551616 ELSE i END, 0::BIGINT, 0::BIGINT
  FROM (SELECT DISTINCT coalesce(doc_id, 0)::HUGEINT AS i FROM documents), shards
  UNION ALL
  SELECT id, n, next, j, floor((j + 1)::DOUBLE * (2147483648.0::DOUBLE / ((next // 8589934592)::DOUBLE + 1.0)))::BIGINT
  FROM (SELECT *, (state * 2862933555777941757::HUGEINT + 1) % 18446744073709551616::HUGEINT AS next
        FROM jump WHERE j < n)),
found AS (SELECT id, n, b FROM jump WHERE j >= n),
rows AS (
  SELECT d.*, octet_length(d.b) + 1 AS size, text_crc32, s.b::INTEGER AS shard, g.b::INTEGER AS grown_shard
  FROM d JOIN crc USING (rid) JOIN found s ON s.id = coalesce(doc_id, 0) AND s.n = 8
  JOIN found g ON g.id = coalesce(doc_id, 0) AND g.n = 9)
SELECT doc_id, size::BIGINT AS size, text_crc32, 'key' AS law, shard,
       (row_number() OVER (PARTITION BY shard ORDER BY k, doc_id NULLS FIRST, tie) - 1)::BIGINT AS slot, grown_shard
FROM rows
"""

TOPK = """
WITH v AS (
  SELECT vec_id::BIGINT AS vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 1024)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
q AS (SELECT vec_id, min(v) AS v FROM v WHERE vec_id % 100 = 0 GROUP BY vec_id),
scored AS (
  SELECT q.vec_id AS query_id, v.vec_id, CASE WHEN len(q.v) = 0 OR len(v.v) = 0 THEN 0 ELSE list_inner_product(q.v, v.v) END::BIGINT AS score
  FROM q JOIN v ON q.vec_id <> v.vec_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 10
"""

DECONTAMINATION = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{ITEM_WORD}') AS w
  FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{ITEM_WORD}') AS w
  FROM benchmark),
item AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS win
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT n FROM item),
cut AS (
  SELECT rid, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lengths WHERE len(w) >= n)),
hits AS (SELECT DISTINCT c.rid, c.n, c.i FROM cut c SEMI JOIN item t ON c.n = t.n AND c.win = t.win),
hit AS (SELECT rid, count(DISTINCT place) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS place FROM hits) GROUP BY rid),
found AS (
  SELECT rid, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT c.rid, t.item_id::VARCHAR AS item_id FROM cut c JOIN item t ON c.n = t.n AND c.win = t.win)
  GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (rid) LEFT JOIN found USING (rid)
"""

SUFFIX_DEDUP = """
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, encode(coalesce(text, '')) AS b FROM documents),
win AS (
  SELECT rid, i, md5(b[i:i + 199]) AS w
  FROM (SELECT rid, b, unnest(range(1, octet_length(b) - 198)) AS i FROM d WHERE octet_length(b) >= 200)),
often AS (SELECT w FROM win GROUP BY w HAVING count(*) > 1),
rep AS (
  SELECT rid, i, coalesce(i > lag(i) OVER (PARTITION BY rid ORDER BY i) + 200, true)::INTEGER AS opens
  FROM win SEMI JOIN often USING (w)),
runs AS (
  SELECT rid, min(i) AS s, max(i) + 199 AS e
  FROM (SELECT rid, i, sum(opens) OVER (PARTITION BY rid ORDER BY i) AS g FROM rep) GROUP BY rid, g),
gaps AS (
  SELECT rid, coalesce(lag(e) OVER (PARTITION BY rid ORDER BY s), 0) + 1 AS s, s - 1 AS e FROM runs
  UNION ALL
  SELECT rid, coalesce(max(r.e), 0) + 1, max(octet_length(b)) FROM d LEFT JOIN runs r USING (rid) GROUP BY rid),
kept AS (
  SELECT rid, string_agg(hex(b[g.s:g.e]), '' ORDER BY g.s) AS h
  FROM gaps g JOIN d USING (rid) WHERE g.s <= g.e GROUP BY rid),
gone AS (SELECT rid, sum(e - s + 1) AS n_removed, count(*) AS n_spans FROM runs GROUP BY rid)
SELECT doc_id, octet_length(b)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
       coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(h, ''))) AS kept_sha256
FROM d LEFT JOIN gone USING (rid) LEFT JOIN kept USING (rid)
"""

DIVERGENCE = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
groups AS (SELECT DISTINCT lang, source FROM d),
per_doc AS (SELECT rid, lang, source, term, count(*) AS n FROM (SELECT rid, lang, source, unnest(w) AS term FROM d) GROUP BY ALL),
kept AS (SELECT lang, term, sum(n)::BIGINT AS n FROM per_doc GROUP BY lang, term HAVING count(*) >= 10),
held AS (SELECT lang, source, term, sum(p.n)::BIGINT AS n FROM per_doc p SEMI JOIN kept k USING (lang, term) GROUP BY ALL),
langs AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
totals AS (SELECT lang, source, sum(n) AS total FROM held GROUP BY lang, source),
-- every kept term in every group of its language
dense AS (
  SELECT g.lang, g.source, k.term, coalesce(h.n, 0) AS n,
         (1 + (1000000000::HUGEINT * (coalesce(h.n, 0) + 2)) // (coalesce(t.total, 0) + 2 * l.v))::BIGINT AS p,
         (1 + (1000000000::HUGEINT * (k.n + 2)) // (l.total + 2 * l.v))::BIGINT AS q
  FROM groups g JOIN kept k USING (lang) JOIN langs l USING (lang)
       LEFT JOIN totals t ON t.lang = g.lang AND t.source = g.source
       LEFT JOIN held h ON h.lang = g.lang AND h.source = g.source AND h.term = k.term),
sums AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p))::BIGINT AS value
  FROM dense a JOIN dense b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
parts AS (
  SELECT g.lang, g.source, 'pair' AS part, o.source AS item, coalesce(s.value, 0)::BIGINT AS value
  FROM groups g JOIN groups o ON g.lang = o.lang AND g.source <> o.source
       LEFT JOIN sums s ON s.lang = g.lang AND s.source = g.source AND s.item = o.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q) // (p + q))::BIGINT FROM dense WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM parts)
WHERE part = 'pair' OR rank <= 10
"""

LICENSES = rf"""
WITH templates AS (
  SELECT * FROM (VALUES
    {", ".join(f"({i}, '{t.label}', '{t.text}', {t.k}, {t.slack}, {t.need}::DOUBLE, {t.base})" for i, t in enumerate(TEMPLATES))})
  AS t(template, label, text, k, slack, need, base)),
listed AS (SELECT *, string_split(text, ' ') AS w FROM templates),
positions AS (
  SELECT template, label, k, slack, need, base, len(w) AS size, tpos, array_to_string(w[tpos + 1:tpos + k], ' ') AS gram
  FROM (SELECT *, unnest(range(0, len(w) - k + 1)) AS tpos FROM listed)),
d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{ITEM_WORD}') AS w
  FROM documents),
words AS (SELECT rid, unnest(w) AS w1, unnest(range(0, len(w))) AS pos FROM d),
next AS (SELECT rid, pos, w1, lead(w1) OVER o AS w2, lead(w1, 2) OVER o AS w3 FROM words WINDOW o AS (PARTITION BY rid ORDER BY pos)),
grams AS (
  SELECT rid, pos, 2 AS k, w1 || ' ' || w2 AS gram FROM next WHERE w2 IS NOT NULL
  UNION ALL SELECT rid, pos, 3, w1 || ' ' || w2 || ' ' || w3 FROM next WHERE w3 IS NOT NULL),
votes AS (SELECT g.rid, p.*, g.pos - p.tpos AS diagonal FROM grams g JOIN positions p USING (k, gram)),
banded AS (
  SELECT *, diagonal AS band FROM votes WHERE slack = 0
  UNION ALL SELECT *, floor(diagonal / slack)::BIGINT FROM votes WHERE slack > 0
  UNION ALL SELECT *, floor(diagonal / slack)::BIGINT + 1 FROM votes WHERE slack > 0),
covered AS (
  SELECT rid, template, band, label, base, need, size, unnest(range(tpos, tpos + k)) AS word FROM banded),
spans AS (
  SELECT rid, template, band, label, base, count(DISTINCT word) / size AS share, share >= need AS found
  FROM covered GROUP BY rid, template, band, label, base, need, size),
per AS (
  SELECT rid, count(*) FILTER (base AND found) AS n_base, min(band) FILTER (base AND found) AS first_word, max(band) FILTER (base AND found) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base AND found) AS base_labels,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (found) AS labels, max(share) AS score
  FROM spans GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0)::DOUBLE AS score
FROM d LEFT JOIN per USING (rid)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op3_mixing": MIXING,
        "op4_suffix_dedup": SUFFIX_DEDUP,
        "op5_sharding": SHARDING,
        "op6_topk": TOPK,
        "op7_decontamination": DECONTAMINATION,
        "op11_divergence": DIVERGENCE,
        "op12_licenses": LICENSES,
    }
