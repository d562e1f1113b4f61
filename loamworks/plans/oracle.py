"""The DuckDB twins of the queries."""

from __future__ import annotations

from . import queries as Q

_WS = r"\t-\r\x{85}\p{Z}"


def _values(rows: tuple) -> str:
    def one(v: object) -> str:
        if v is None:
            return "NULL"
        return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)

    return ", ".join("(" + ", ".join(map(one, r if isinstance(r, tuple) else (r,))) + ")" for r in rows)


def _list(values: tuple[str, ...]) -> str:
    return "[" + ", ".join("'" + v + "'" for v in values) + "]"


_NAMES = f"(SELECT doc_id, source || '-' || doc_id || {_list(Q.ENDINGS)}[doc_id % {len(Q.ENDINGS)} + 1] AS name FROM documents)"

_WORDS = (
    f"SELECT doc_id, unnest(regexp_extract_all(regexp_replace(text, '([{_WS}][^{_WS}])', chr(1) || '\\1', 'g'),"
    f" '(''s|''t|''re|''ve|''m|''ll|''d| ?\\p{{L}}+| ?\\p{{N}}+| ?[^{_WS}\\p{{L}}\\p{{N}}\\x01]+|[{_WS}]+)', 1)) AS w FROM documents"
)
_COUNTS = f"SELECT w, count(*) AS n FROM ({_WORDS}) GROUP BY w"


def _symbols(x: str) -> str:
    return f"regexp_replace(hex(encode({x})), '(..)', '<\\1>', 'g')"


_LIST = "string_split(s[2:-2], '><')"


def _pairs(words: str) -> str:
    """Pair counts of a relation (s, n)."""
    return (
        f"SELECT p.l AS l, p.r AS r, CAST(sum(n) AS BIGINT) AS c FROM (SELECT n, unnest(list_transform(range(1, len(a)),"
        f" lambda i: {{'l': a[i], 'r': a[i + 1]}})) AS p FROM (SELECT n, {_LIST} AS a FROM {words})) GROUP BY ALL"
    )


def _merge_ctes() -> str:
    """counts, steps (every word before the first merge and after each) and merges, by recursion."""
    best = f"SELECT * FROM ({_pairs('steps')}) WHERE c >= 2 ORDER BY c DESC, l, r LIMIT 1"
    return (
        f"WITH RECURSIVE counts AS MATERIALIZED ({_COUNTS}), steps(step, w, s, n, l, r, c) AS (SELECT 0, w, {_symbols('w')}, n, '', '', 0::BIGINT FROM counts"
        " UNION ALL SELECT steps.step + 1, steps.w, replace(steps.s, '<' || b.l || '><' || b.r || '>', '<' || b.l || b.r || '>'), steps.n, b.l, b.r, b.c"
        f" FROM steps, ({best}) b WHERE steps.step < {Q.MERGES}), every AS MATERIALIZED (SELECT * FROM steps),"
        " done AS MATERIALIZED (SELECT w, len(string_split(s[2:-2], '><')) AS k FROM every WHERE step = (SELECT max(step) FROM every)),"
        " merges AS (SELECT DISTINCT step, l, r, c FROM every WHERE step > 0)"
    )


def _encoded() -> str:
    return f"SELECT doc_id, CAST(sum(k) AS BIGINT) AS n_tokens FROM ({_WORDS}) JOIN done USING (w) GROUP BY doc_id"


_BYTES = f"SELECT byte, CAST(sum(n) AS BIGINT) AS n FROM (SELECT unnest({_LIST}) AS byte, n FROM (SELECT {_symbols('w')} AS s, n FROM ({_COUNTS}))) GROUP BY byte"
_ALPHABET = "SELECT byte, CAST(CASE WHEN kept THEN byte ELSE 255 + row_number() OVER (PARTITION BY kept ORDER BY byte) END AS INT) AS codepoint FROM (SELECT CAST(range AS INT) AS byte, range BETWEEN 33 AND 126 OR range BETWEEN 161 AND 172 OR range BETWEEN 174 AND 255 AS kept FROM range(256))"


def _plain(x: str) -> str:
    """A text with one letter for each reserved token."""
    for t in Q.SPECIAL_TOKENS:
        x = f"replace({x}, '{t}', 'x')"
    return x


_SAME = f"SELECT d.doc_id, coalesce(j.t, '') = d.text AS same FROM documents d LEFT JOIN (SELECT doc_id, string_agg(w, '' ORDER BY k) AS t FROM (SELECT doc_id, w, generate_subscripts AS k FROM (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS generate_subscripts FROM (SELECT doc_id, regexp_extract_all(regexp_replace(text, '([{_WS}][^{_WS}])', chr(1) || '\\1', 'g'), '(''s|''t|''re|''ve|''m|''ll|''d| ?\\p{{L}}+| ?\\p{{N}}+| ?[^{_WS}\\p{{L}}\\p{{N}}\\x01]+|[{_WS}]+)', 1) AS ws FROM documents))) GROUP BY doc_id) j USING (doc_id)"
_UNIT = "(VALUES (1024.0::DOUBLE, 'KiB', 1), (1048576.0::DOUBLE, 'MiB', 2), (1073741824.0::DOUBLE, 'GiB', 3), (1099511627776.0::DOUBLE, 'TiB', 4)) u(unit, name, k)"


def oracle_sql() -> dict[str, str]:
    ctes = _merge_ctes()
    sql = {
        "shard_filter": f"SELECT name FROM {_NAMES} WHERE regexp_matches(name, '\\.(jsonl|ndjson|txt|text)(\\.gz)?$', 'i')",
        "detect_format": f"SELECT name, regexp_matches(name, '\\.(jsonl|ndjson)(\\.gz)?$', 'i') AS json, lower(name) LIKE '%.gz' AS gzip FROM {_NAMES}",
        "cache_plan": f"SELECT name, CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN 'skip' ELSE 'fetch' END AS action FROM {_NAMES}",
        "records": f"SELECT doc_id, text FROM documents WHERE regexp_matches(text, '[^{_WS}]')",
        "text_lines": f"SELECT doc_id, line, count(*) AS n FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) WHERE regexp_matches(line, '[^{_WS}]') GROUP BY ALL",
        "jsonl_text": "SELECT doc_id, text FROM documents WHERE text <> ''",
        "jsonl_nonstring": "SELECT event_type, count(CASE WHEN json_type(props, '$.k') = 'VARCHAR' THEN 1 END) AS kept, count(CASE WHEN coalesce(json_type(props, '$.k'), '') <> 'VARCHAR' THEN 1 END) AS skipped FROM events GROUP BY event_type",
        "malformed_count": "WITH l AS (SELECT lang, doc_id % 5 AS kind, CAST(to_json({'text': text}) AS VARCHAR) AS whole, text, n_chars FROM documents), x AS (SELECT lang, CASE kind WHEN 0 THEN whole WHEN 1 THEN left(whole, length(whole) - 1) WHEN 2 THEN CAST(to_json({'text': n_chars}) AS VARCHAR) WHEN 3 THEN CAST(to_json([text]) AS VARCHAR) ELSE ' ' || chr(9) END AS line FROM l), v AS (SELECT lang, line, json_valid(line) AS ok FROM x) SELECT lang, count(*) FILTER (NOT ok AND trim(line, ' ' || chr(9)) <> '') AS malformed, count(*) FILTER (ok AND json_type(CASE WHEN ok THEN line END, '$.text') = 'VARCHAR' AND json_extract_string(CASE WHEN ok THEN line END, '$.text') <> '') AS kept FROM v GROUP BY lang",
        "sample_prefix": "SELECT doc_id, text FROM (SELECT doc_id, text, coalesce(sum(length(text) + 1) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b FROM documents WHERE text <> '') WHERE b < 65536",
        "pretoken_counts": _COUNTS,
        "byte_histogram": _BYTES,
        "byte_alphabet": f"SELECT a.byte, codepoint, n FROM ({_ALPHABET}) a JOIN (SELECT CAST(('0x' || byte) AS INT) AS byte, n FROM ({_BYTES})) h ON a.byte = h.byte",
        "pair_counts": f"WITH w AS (SELECT {_symbols('w')} AS s, n FROM ({_COUNTS})) {_pairs('w')}",
        "merges_k": f"{ctes} SELECT CAST(step AS INT) AS step, l, r, c FROM merges",
        "encode_counts": f"{ctes} {_encoded()}",
        "chars_per_token": f"{ctes}, e AS ({_encoded()}), g AS (SELECT lang, CAST(sum(length(text)) AS BIGINT) AS chars, CAST(coalesce(sum(n_tokens), 0) AS BIGINT) AS n_tokens FROM documents LEFT JOIN e USING (doc_id) GROUP BY lang) SELECT lang, chars, n_tokens, CASE WHEN n_tokens = 0 THEN 0.0 ELSE round(chars::DOUBLE / n_tokens, 6) END AS ratio, CASE WHEN n_tokens = 0 THEN 0.0 ELSE round(chars::DOUBLE / n_tokens, 6) END BETWEEN 3.0 AND 4.5 AS in_band FROM g",
        "round_trip": _SAME,
        "report": f"{ctes}, e AS ({_encoded()}), r AS ({_SAME}) SELECT {Q.bpe.FLOOR} + (SELECT count(*) FROM merges) AS vocab_size, round((SELECT sum(length(text)) FROM documents)::DOUBLE / (SELECT sum(n_tokens) FROM e), 6) AS chars_per_token, (SELECT bool_and(same) FROM r) AS round_trips",
        "specials": " UNION ALL ".join(f"SELECT CAST({i} AS INT) AS id, '{t}' AS token, count(*) FILTER (contains(text, '{t}')) AS n FROM (SELECT text FROM documents UNION ALL SELECT text FROM conversations)" for i, t in enumerate(Q.SPECIAL_TOKENS)),
        "special_atomic": f"SELECT doc_id, CAST(strlen({_plain('text')}) + 1 AS BIGINT) AS n_ids, true AS last FROM documents",
        "vocab": f"{ctes} SELECT CAST(id AS INT) AS id, hex(encode(token)) AS token, 'special' AS kind FROM (VALUES {_values(tuple(enumerate(Q.SPECIAL_TOKENS)))}) t(id, token) UNION ALL SELECT CAST(5 + range AS INT), printf('%02X', range), 'byte' FROM range(256) UNION ALL SELECT CAST({Q.bpe.FLOOR - 1} + step AS INT), l || r, 'merge' FROM merges",
        "shift_pairs": f"SELECT cur, nxt, count(*) AS n FROM (SELECT doc_id, b AS cur, lead(b) OVER (PARTITION BY doc_id ORDER BY k) AS nxt FROM (SELECT doc_id, unnest(a) AS b, generate_subscripts(a, 1) AS k FROM (SELECT doc_id, {_LIST} AS a FROM (SELECT doc_id, {_symbols('text')} AS s FROM documents WHERE text <> '')))) WHERE nxt IS NOT NULL GROUP BY ALL",
        "cross_entropy": "SELECT vec_id, round(ln(list_sum(list_transform(z, lambda v: exp(v - m)))) + m - z[label + 1], 6) AS loss FROM (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS z, CAST(list_max(embedding) AS DOUBLE) AS m FROM embeddings)",
        "uniform_loss": "SELECT lang, count(DISTINCT text) AS vocab_size, round(ln(count(DISTINCT text)::DOUBLE), 9) AS loss FROM documents GROUP BY lang",
        "context_guard": f"{ctes} SELECT * FROM ({_encoded()}) WHERE n_tokens <= {Q.CONTEXT}",
        "causal_mask": "WITH l AS (SELECT conv_id, max(turn) + 1 AS n FROM conversations GROUP BY conv_id), a AS (SELECT conv_id, unnest(range(n)) AS q FROM l) SELECT conv_id, q, unnest(range(q + 1)) AS k FROM a",
        "det_tokens": f"SELECT doc_id, doc_id * 7919 % {Q.SIZE} AS token FROM documents",
        "layered_config": "SELECT o_orderkey, CAST(coalesce(CASE WHEN o_orderkey % 11 = 0 THEN 300 END, CASE WHEN o_orderkey % 7 = 0 THEN o_orderkey % 64 END, CASE WHEN o_orderpriority LIKE '1%' THEN o_orderkey % 512 END, CASE WHEN o_orderstatus = 'F' THEN o_orderkey % 4096 END, o_custkey) AS BIGINT) AS resolved FROM orders",
        "env_parse": "SELECT event_id, lower(event_type) AS key, CASE WHEN json_valid(v) THEN CAST(json(CASE WHEN json_valid(v) THEN v END) AS VARCHAR) ELSE '\"' || v || '\"' END AS value FROM (SELECT event_id, event_type, CASE event_id % 3 WHEN 0 THEN props WHEN 1 THEN CAST(user_id AS VARCHAR) ELSE event_type END AS v FROM events WHERE event_id % 4 <> 0)",
        "model_sizes": f"WITH m AS (SELECT p_partkey, p_size * 1000::BIGINT AS v, {Q.CONTEXT}::BIGINT AS ctx, p_size * 12::BIGINT AS d, p_size * 48::BIGINT AS f, p_size::BIGINT AS layers, p_partkey % 13 AS heads FROM part) SELECT p_partkey, CASE WHEN heads > 0 AND d % heads = 0 THEN CAST(d // heads AS BIGINT) ELSE 0 END AS head_dim, CAST((v + ctx) * d + layers * (4 * d * d + 4 * d + 4 * d + 2 * d * f + f + d) + 2 * d AS BIGINT) AS parameters FROM m",
        "run_json": f"SELECT o_orderkey, o_orderkey AS vocab_size, {Q.CONTEXT}::BIGINT AS context_length, o_custkey AS d_model, o_custkey * 4 AS d_ff, o_orderkey % 48 AS num_layers, o_orderkey % 16 AS num_heads, o_orderstatus = 'F' AS norm_first, o_totalprice AS learning_rate, 100000::BIGINT AS max_steps FROM orders",
        "progress_fold": "WITH e AS (SELECT strftime(ts, '%Y-%m-%d') AS day, event_id AS seq, CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in Q.KINDS.items()) + f" ELSE 'other' END AS kind, user_id, CAST(round(value * 100) AS BIGINT) AS bytes FROM events) SELECT day, CAST(coalesce(sum(bytes) FILTER (kind = 'advanced'), 0) AS BIGINT) AS run_bytes, count(*) FILTER (kind = 'finished') AS downloaded, count(*) FILTER (kind = 'cached') AS cached, arg_max(user_id, seq) FILTER (kind IN ('started', 'cached')) AS total, coalesce(sum(bytes) FILTER (kind = 'advanced'), 0)::DOUBLE / {Q.SECONDS} AS rate FROM e GROUP BY day",
        "shard_records": f"WITH r AS (SELECT true AS json, text FROM documents WHERE doc_id % 3 < 2 AND text <> '' UNION ALL SELECT false, regexp_replace(unnest(string_split(text, chr(10))), chr(13) || '$', '') FROM documents WHERE doc_id % 3 = 2) SELECT json, text, count(*) AS n FROM r WHERE json OR regexp_matches(text, '[^{_WS}]') GROUP BY ALL",
        "format_bytes": f"WITH b AS (SELECT DISTINCT bytes FROM (SELECT bytes FROM (VALUES {_values(Q.BYTE_SIZES)}) t(bytes) UNION ALL SELECT n_chars FROM documents)), k AS (SELECT bytes, unit, name FROM b JOIN {_UNIT} ON bytes >= unit QUALIFY row_number() OVER (PARTITION BY bytes ORDER BY k DESC) = 1) SELECT CAST(b.bytes AS BIGINT) AS bytes, CASE WHEN k.unit IS NULL THEN b.bytes || ' B' ELSE printf('%.1f', b.bytes::DOUBLE / k.unit) || ' ' || k.name END AS shown FROM b LEFT JOIN k USING (bytes)",
    }
    return {q: sql[q.split("_", 1)[1]] for q in Q.queries()}
