"""DuckDB SQL of the corpus queries that SQL can express."""

from __future__ import annotations

#: Words as the contracts define them.
_SPLIT = r"regexp_extract_all(coalesce({}, ''), '[^\x20\x09-\x0D]+')"
_ROWS = "rows_ AS (SELECT row_number() OVER () AS rn, doc_id, text FROM documents)"

# The reflected polynomial of CRC-32 and its table, by the rule; the text's bytes go through it one by one.
_CRC = """bits AS (SELECT range AS i, list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, range) AS v FROM range(256)),
crc AS (SELECT list(v ORDER BY i) AS t FROM bits),
bytes AS (SELECT rn, doc_id, hex(encode(coalesce(text, ''))) AS h FROM rows_),
sums AS (SELECT rn, doc_id, strlen(h) // 2 + 1 AS size, xor(list_reduce(list_transform(range(strlen(h) // 2), lambda i: ('0x' || substr(h, CAST(2 * i + 1 AS INT), 2))::BIGINT), lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1]), 4294967295::BIGINT), 4294967295) AS text_crc32 FROM bytes, crc)"""

OP4 = f"""WITH {_ROWS}, {_CRC},
keyed AS (SELECT s.*, ('0x' || substr(sha256(coalesce(r.text, '')), 1, 15))::BIGINT AS ord FROM sums s JOIN rows_ r USING (rn)),
ranked AS (SELECT *, row_number() OVER o - 1 AS rank, sum(size) OVER (ORDER BY ord, doc_id, text_crc32, rn ROWS UNBOUNDED PRECEDING) AS upto, sum(size) OVER () AS total FROM keyed WINDOW o AS (ORDER BY ord, doc_id, text_crc32, rn)),
placed AS (SELECT *, CAST(least(15, ((2 * upto - size) * 16) // (2 * total)) AS INT) AS shard FROM ranked)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'bytes' AS law, shard, CAST(rank - min(rank) OVER (PARTITION BY shard) AS BIGINT) AS slot, CAST(NULL AS INT) AS grown_shard FROM placed"""

OP7 = f"""WITH {_ROWS},
w AS (SELECT rn, doc_id, {_SPLIT.format('text')} AS ws FROM rows_),
starts AS (SELECT rn, ws, unnest(range(1, len(ws) - 33)) AS s FROM w WHERE len(ws) >= 35),
win AS MATERIALIZED (SELECT rn, s, sha256(array_to_string(ws[s : s + 34], ' ')) AS k FROM starts),
often AS (SELECT k FROM win GROUP BY k HAVING count(*) > 1),
gone AS (SELECT DISTINCT rn, unnest(range(s, s + 35)) AS i FROM win WHERE k IN (SELECT k FROM often)),
words AS (SELECT rn, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM w),
kept AS (SELECT words.rn, count(gone.i) AS n_removed, string_agg(word, ' ' ORDER BY words.i) FILTER (gone.i IS NULL) AS t FROM words LEFT JOIN gone ON words.rn = gone.rn AND words.i = gone.i GROUP BY words.rn)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM w LEFT JOIN kept USING (rn)"""

OP9 = f"""WITH RECURSIVE {_ROWS},
w AS (SELECT rn, doc_id, {_SPLIT.format("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS ws FROM rows_),
sets AS MATERIALIZED (SELECT rn, doc_id, CASE WHEN len(ws) >= 5 THEN list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i : i + 4], ' '))) WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END AS s FROM w),
items AS MATERIALIZED (SELECT rn, len(s) AS n, unnest(s) AS item FROM sets),
pairs AS (SELECT a.rn AS a, b.rn AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS c FROM items a JOIN items b ON a.item = b.item AND a.rn <> b.rn GROUP BY a.rn, b.rn),
links AS MATERIALIZED (SELECT a, b FROM pairs WHERE 100 * c >= 75 * (na + nb - c)),
reach AS (SELECT rn, rn AS root FROM sets UNION SELECT links.b AS rn, reach.root FROM reach JOIN links ON links.a = reach.rn),
least AS (SELECT reach.rn, min(sets.doc_id) AS component_id FROM reach JOIN sets ON sets.rn = reach.root GROUP BY reach.rn)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id FROM sets JOIN least USING (rn)"""

_FIELD = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen(CAST({0} AS VARCHAR)) || ':' || CAST({0} AS VARCHAR) END"
_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_FIELD.format(x) for x in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def _side(places: str) -> str:
    return f"coalesce(array_to_string(r[{places}], ''), '')"


def _fold(start: str, levels: str, name: str) -> str:
    """Each row of start (rn, g, idx, n, a, b, proof) carried up through levels (k, g, idx, n, h): a as it is, b as tampered with."""
    left, right = _side("1 : s.idx % 16"), _side("s.idx % 16 + 2 :")
    return f"""{name}_runs AS MATERIALIZED (SELECT k, g, idx // 16 AS up, list(h ORDER BY idx) AS r FROM {levels} WHERE n > 1 GROUP BY ALL),
{name} AS (SELECT 0 AS k, * FROM {start} UNION ALL SELECT s.k + 1, s.rn, s.g, s.idx // 16, (s.n + 15) // 16, sha256({left} || a || {right}), sha256({left} || b || {right}), proof || {left} || {right} FROM {name} s JOIN {name}_runs t ON s.k = t.k AND s.g = t.g AND s.idx // 16 = t.up WHERE s.n > 1)"""


def _levels(name: str, start: str) -> str:
    return f"""{name} AS (SELECT 0 AS k, g, idx, n, h FROM {start} UNION ALL SELECT k + 1, g, idx // 16, (max(n) + 15) // 16, sha256(string_agg(h, '' ORDER BY idx)) FROM {name} WHERE n > 1 GROUP BY k, g, idx // 16)"""


OP11 = f"""WITH RECURSIVE all_ AS (SELECT row_number() OVER () AS rn, * FROM documents),
bits AS (SELECT range AS i, list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, range) AS v FROM range(256)),
crc AS (SELECT list(v ORDER BY i) AS t FROM bits),
hexed AS (SELECT rn, hex(encode(CAST(doc_id AS VARCHAR))) AS x FROM all_),
sums AS (SELECT rn, xor(list_reduce(list_transform(range(strlen(x) // 2), lambda i: ('0x' || substr(x, CAST(2 * i + 1 AS INT), 2))::BIGINT), lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1]), 4294967295::BIGINT), 4294967295) AS crc FROM hexed, crc),
base AS (SELECT rn, doc_id, CASE WHEN source IS NULL THEN '0' ELSE '1' || source END AS g, {_leaf('text')} AS h, CASE WHEN crc % 5 = 0 THEN {_leaf(_LOWERED)} ELSE {_leaf('text')} END AS tampered FROM all_ JOIN sums USING (rn)),
leaves AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, h, rn) - 1 AS idx, count(*) OVER (PARTITION BY g) AS n FROM base),
{_levels('lev', 'leaves')},
subroots AS MATERIALIZED (SELECT '' AS g, g AS own, h, row_number() OVER (ORDER BY g) - 1 AS idx, count(*) OVER () AS n FROM lev WHERE n = 1),
{_levels('toplev', 'subroots')},
low AS (SELECT rn, g, idx, n, h AS a, tampered AS b, '' AS proof FROM leaves),
{_fold('low', 'lev', 'inner_')},
high AS (SELECT rn, s.g, s.idx, s.n, i.a, i.b, i.proof FROM inner_ i JOIN subroots s ON i.n = 1 AND i.g = s.own),
{_fold('high', 'toplev', 'outer_')}
SELECT doc_id, l.h AS leaf, i.a AS subroot, t.h AS root, sha256(o.proof) AS proof_sha256, o.b AS folded_root, o.b = t.h AS verified
FROM leaves l JOIN inner_ i ON i.rn = l.rn AND i.n = 1 JOIN outer_ o ON o.rn = l.rn AND o.n = 1, (SELECT h FROM toplev WHERE n = 1) t"""

OP13 = f"""WITH {_ROWS},
norm AS (SELECT rn, doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM rows_)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size, row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS LAST, rn) = 1 AS kept, sha256(t) AS text_sha256 FROM norm"""

SQL = {"op4_sharding": OP4, "op7_substrings": OP7, "op9_jaccard": OP9, "op11_merkle": OP11, "op13_exact_dedup": OP13}
