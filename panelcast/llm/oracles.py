"""DuckDB SQL of the operators that SQL can express over whole tables.

Repeated passages: every 400-byte window by its position, windows that occur twice, islands of them,
and the bytes between.  Near duplicates: distinct shingles, all pairs that share one, a recursive walk.
Conversation repair: a recursive walk over the rows with the cheapest (cost, audit) of four states.
Vector codes: the rounds of Lloyd one after another.  Search: all scores of the queries.
The other operators rest on learnt models, sketches, tokenizers or file formats; their tests hold
them against brute force, exact round trips or held-out rows.
"""

SUFFIX_DEDUP = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
w AS MATERIALIZED (SELECT doc_id, i, md5_number(substr(h, 2 * i + 1, 800)) AS k FROM (SELECT doc_id, h, unnest(range(0, n - 399)) AS i FROM d WHERE n >= 400)),
often AS (SELECT k FROM w GROUP BY k HAVING count(*) > 1),
c AS (SELECT doc_id, i FROM w WHERE k IN (SELECT k FROM often)),
runs AS (SELECT doc_id, i, sum(CASE WHEN i <= before + 400 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS g
         FROM (SELECT *, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM c)),
spans AS (SELECT doc_id, min(i) AS lo, max(i) + 400 AS hi FROM runs GROUP BY doc_id, g),
pieces AS (SELECT doc_id, lo, hi, coalesce(lag(hi) OVER (PARTITION BY doc_id ORDER BY lo), 0) AS prior FROM spans),
gone AS (SELECT p.doc_id, sum(hi - lo) AS n_removed, count(*) AS n_spans, max(hi) AS tail,
                string_agg(substr(h, CAST(2 * prior + 1 AS BIGINT), CAST(2 * (lo - prior) AS BIGINT)), '' ORDER BY lo) AS head
         FROM pieces p JOIN d ON d.doc_id = p.doc_id GROUP BY p.doc_id)
SELECT d.doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(CASE WHEN n_spans IS NULL THEN h ELSE head || substr(h, CAST(2 * tail + 1 AS BIGINT)) END)) AS kept_sha256
FROM d LEFT JOIN gone ON gone.doc_id = d.doc_id"""

MINHASH_FOREST = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS MATERIALIZED (SELECT doc_id, list_sort(list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
       ELSE [array_to_string(ws[i:i + 4], ' ') FOR i IN range(1, len(ws) - 3)] END)) AS sh FROM w),
c AS MATERIALIZED (SELECT min(doc_id) AS cid, len(sh) AS n, sh FROM s WHERE len(sh) > 0 GROUP BY sh),
x AS MATERIALIZED (SELECT cid, n, hash(t) AS t FROM (SELECT cid, n, unnest(sh) AS t FROM c)),
e AS MATERIALIZED (SELECT a.cid AS a, b.cid AS b FROM x a JOIN x b ON a.t = b.t AND a.cid < b.cid AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
      GROUP BY a.cid, b.cid HAVING 100 * count(*) >= 85 * (max(a.n) + max(b.n) - count(*))),
sides AS MATERIALIZED (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
reach AS (SELECT DISTINCT a AS node, a AS low FROM sides UNION SELECT sides.b, reach.low FROM reach JOIN sides ON sides.a = reach.node WHERE reach.low < sides.b),
comp AS (SELECT node, min(low) AS low FROM reach GROUP BY node)
SELECT s.doc_id, CAST(len(s.sh) AS BIGINT) AS n_shingles, coalesce(comp.low, c.cid, s.doc_id) AS component_id, s.doc_id = coalesce(comp.low, c.cid, s.doc_id) AS kept
FROM s LEFT JOIN c ON c.sh = s.sh LEFT JOIN comp ON comp.node = c.cid"""



def _and(state: str, cost: str, letter: str) -> str:
    """A state's value is its cost in six digits, then the audit; NULL if the state can't be reached."""
    return f"(lpad(CAST(CAST(left({state}, 6) AS INTEGER) + {cost} AS VARCHAR), 6, '0') || substr({state}, 7) || '{letter}')"


def _kept(state: str, initial: str) -> str:
    """Keep a row that has the wanted initial, or change its role."""
    return f"CASE WHEN gone THEN NULL WHEN initial = '{initial}' THEN {_and(state, 'extra', 'K')} ELSE {_and(state, '2 + extra', 'R')} END"


_OPEN = f"""s0 AS c0, ss AS cs, least(su, {_and('s0', '2', 'I')}, {_and('ss', '2', 'I')}, {_and('sa', '2', 'I')}) AS cu,
       least(sa, {_and('su', '2', 'I')}, {_and(_and('s0', '2', 'I'), '2', 'I')}, {_and(_and('ss', '2', 'I'), '2', 'I')}) AS ca"""

CONVERSATION_REPAIR = rf"""
WITH RECURSIVE k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
       xor(list_reduce(list_prepend(4294967295, [CAST(ord(c) AS BIGINT) FOR c IN string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), '')]),
           lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 20 AS f FROM conversations),
r AS (SELECT conv_id, turn, copy, CASE WHEN f = 4 THEN 'user' ELSE role END AS role, CASE WHEN f = 1 THEN '' WHEN f = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
      FROM k, range(2) c(copy) WHERE f <> 0 AND (copy = 0 OR f = 3)),
g AS (SELECT *, row_number() OVER w AS i, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again, left(role, 1) AS initial,
             rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy)),
q AS MATERIALIZED (SELECT *, body = '' AS blank, body <> '' AND again AS dup, body <> '' AND NOT again AND right(body, 1) NOT IN ('.', '!', '?') AS cut, body = '' OR again AS gone,
             CASE WHEN body <> '' AND NOT again AND right(body, 1) NOT IN ('.', '!', '?') THEN 1 ELSE 0 END AS extra,
             lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS prior FROM g),
n AS (SELECT c.conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (dup) AS duplicate,
             count(*) FILTER (cut) AS truncated, count(*) FILTER (prior IS NOT NULL AND prior || initial NOT IN ('su', 'ua', 'au')) AS illegal, count(i) AS n
      FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN q ON q.conv_id IS NOT DISTINCT FROM c.conv_id GROUP BY c.conv_id),
dp AS (SELECT conv_id, CAST(0 AS BIGINT) AS i, '000000' AS s0, CAST(NULL AS VARCHAR) AS ss, CAST(NULL AS VARCHAR) AS su, CAST(NULL AS VARCHAR) AS sa FROM n
  UNION ALL
  SELECT o.conv_id, o.i + 1, {_and('c0', '3', 'D')}, least({_and('cs', '3', 'D')}, CASE WHEN initial = 's' AND NOT gone THEN {_and('c0', 'extra', 'K')} END),
         least({_and('cu', '3', 'D')}, {_kept('c0', 'u')}, {_kept('cs', 'u')}, {_kept('ca', 'u')}), least({_and('ca', '3', 'D')}, {_kept('cu', 'a')})
  FROM (SELECT conv_id, i, {_OPEN} FROM dp) o JOIN q ON q.conv_id IS NOT DISTINCT FROM o.conv_id AND q.i = o.i + 1),
best AS (SELECT o.conv_id, least(c0, ca) AS b FROM (SELECT conv_id, i, {_OPEN} FROM dp) o JOIN n ON n.conv_id IS NOT DISTINCT FROM o.conv_id AND n.n = o.i),
a AS (SELECT conv_id, CAST(left(b, 6) AS BIGINT) AS cost, substr(b, 7) AS audit FROM best),
l AS (SELECT conv_id, j, substr(audit, CAST(j AS BIGINT), 1) AS e, len(replace(left(audit, j), 'I', '')) AS i, len(replace(left(audit, j), 'D', '')) AS o FROM a, range(1, 100000) t(j) WHERE j <= len(audit)),
m AS (SELECT l.conv_id, l.o, l.e, q.role, q.text, bool_or(l.o = 1 AND l.e = 'K' AND q.initial = 's') OVER (PARTITION BY l.conv_id) AS led
      FROM l LEFT JOIN q ON q.conv_id IS NOT DISTINCT FROM l.conv_id AND q.i = l.i WHERE l.e <> 'D'),
h AS (SELECT conv_id, string_agg(CASE WHEN e = 'K' THEN role || ':' || text ELSE (CASE WHEN (o - CASE WHEN led THEN 1 ELSE 0 END) % 2 = 1 THEN 'user' ELSE 'assistant' END) || ':' || CASE WHEN e = 'R' THEN text ELSE '' END END,
             chr(10) ORDER BY o) AS t FROM m GROUP BY conv_id)
SELECT n.conv_id, CAST(gaps AS BIGINT) AS gaps, CAST(blank AS BIGINT) AS blank, CAST(duplicate AS BIGINT) AS duplicate, CAST(truncated AS BIGINT) AS truncated, CAST(illegal AS BIGINT) AS illegal,
       cost, audit, sha256(coalesce(t, '')) AS repaired_sha256
FROM n JOIN a ON a.conv_id IS NOT DISTINCT FROM n.conv_id LEFT JOIN h ON h.conv_id IS NOT DISTINCT FROM n.conv_id"""

_VECTORS = """v AS MATERIALIZED (SELECT row_number() OVER () AS rid, *, [CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT) FOR x IN embedding] AS e FROM embeddings
      WHERE embedding IS NOT NULL AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0)"""


def _nearest(books: str) -> str:
    return f"""(SELECT rid, p.part, min(list_sum([(p.x[i] - b.x[i]) * (p.x[i] - b.x[i]) FOR i IN range(1, len(p.x) + 1)]) * 64 + b.entry) AS m
      FROM p JOIN {books} b ON b.part = p.part GROUP BY rid, p.part)"""


def _moved(books: str, nearest: str) -> str:
    return f"""(SELECT b.part, b.entry, [coalesce(CAST(floor(CAST(n.s[i] AS DOUBLE) / n.c) AS BIGINT), b.x[i]) FOR i IN range(1, len(b.x) + 1)] AS x
      FROM {books} b LEFT JOIN (SELECT part, entry, any_value(c) AS c, list(s ORDER BY i) AS s FROM (SELECT a.part, m % 64 AS entry, i, count(*) AS c, sum(p.x[i]) AS s
        FROM {nearest} a JOIN p ON p.rid = a.rid AND p.part = a.part, range(1, 10000) t(i) WHERE i <= len(p.x) GROUP BY a.part, m % 64, i) GROUP BY part, entry) n ON n.part = b.part AND n.entry = b.entry)"""


VECTOR_CODES = f"""
WITH {_VECTORS},
p AS MATERIALIZED (SELECT rid, vec_id, part, e[CAST(part * len(e) // 16 + 1 AS BIGINT):CAST((part + 1) * len(e) // 16 AS BIGINT)] AS x FROM v, range(16) t(part)),
b0 AS MATERIALIZED (SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, x FROM p QUALIFY entry < 64),
a1 AS MATERIALIZED {_nearest('b0')}, b1 AS MATERIALIZED {_moved('b0', 'a1')},
a2 AS MATERIALIZED {_nearest('b1')}, b2 AS MATERIALIZED {_moved('b1', 'a2')},
a3 AS MATERIALIZED {_nearest('b2')},
c AS (SELECT rid, string_agg(printf('%02x', CAST(m % 64 AS BIGINT)), '' ORDER BY part) AS code, CAST(sum(m // 64) AS BIGINT) AS error FROM a3 GROUP BY rid)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       sha256((SELECT string_agg(array_to_string(x, ','), ',' ORDER BY part, entry) FROM b2)) AS codebooks_sha256
FROM c JOIN v ON v.rid = c.rid"""

TOPK_SEARCH = f"""
WITH {_VECTORS},
s AS (SELECT q.rid AS q, q.vec_id AS query_id, c.rid, c.vec_id, CAST(list_sum([q.e[i] * c.e[i] FOR i IN range(1, len(q.e) + 1)]) AS BIGINT) AS score
      FROM v q JOIN v c ON q.rid <> c.rid WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY q ORDER BY score DESC, vec_id, rid) AS INTEGER) AS rank, vec_id, score FROM s QUALIFY rank <= 5"""
