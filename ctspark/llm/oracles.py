"""DuckDB SQL for the corpus operators that SQL can express."""

TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 64)) AS vec FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, v.vec_id, CAST(list_inner_product(q.vec, v.vec) AS BIGINT) AS score
  FROM v q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20"""

COMPONENTS = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
sh AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) >= 3 THEN list_transform(range(1, len(words) - 1), lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2])
    WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END) AS s FROM w),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM i JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 90 * (x.n + y.n - i)),
reach AS (SELECT doc_id, doc_id AS c FROM documents UNION SELECT reach.doc_id, e.b FROM reach JOIN e ON e.a = reach.c)
SELECT doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(c) AS component_id FROM reach LEFT JOIN n USING (doc_id) GROUP BY doc_id"""

#: Bytes as hex text; every window of 200 bytes by its MD5.
REPEATS = """
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT rid, i, md5(substr(h, 2 * i + 1, 400)) AS k FROM (SELECT rid, h, unnest(range(0, length(h) // 2 - 199)) AS i FROM d WHERE length(h) >= 400)),
r AS (SELECT rid, i FROM w WHERE k IN (SELECT k FROM w GROUP BY k HAVING count(*) > 1)),
n AS (SELECT rid, i, CASE WHEN i - lag(i) OVER (PARTITION BY rid ORDER BY i) <= 200 THEN 0 ELSE 1 END AS fresh FROM r),
g AS (SELECT rid, i, sum(fresh) OVER (PARTITION BY rid ORDER BY i) AS run FROM n),
runs AS (SELECT rid, min(i) AS s, max(i) + 200 AS e FROM g GROUP BY rid, run),
p AS (SELECT rid, s, e, coalesce(lag(e) OVER (PARTITION BY rid ORDER BY s), 0) AS b FROM runs),
k AS (
  SELECT d.rid, CAST(sum(e - s) AS BIGINT) AS n_removed, count(*) AS n_spans,
    string_agg(substr(h, 2 * b + 1, 2 * (s - b)), '' ORDER BY s) || any_value(substr(h, 2 * z + 1)) AS kept
  FROM (SELECT *, max(e) OVER (PARTITION BY rid) AS z FROM p) JOIN d USING (rid) GROUP BY d.rid)
SELECT doc_id, length(h) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(from_hex(coalesce(kept, h))) AS kept_sha256
FROM d LEFT JOIN k USING (rid)"""

#: CRC-32 of a string of ASCII letters, bit by bit.
_CRC = """xor(list_reduce(list_transform(range(1, len({s}) + 1), lambda i: ord({s}[i])::BIGINT),
  lambda c, b: list_reduce(range(8), lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END, xor(c, b)), 4294967295::BIGINT), 4294967295::BIGINT)"""


def _leaf(text: str) -> str:
    fields = (f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR) || ':' || {c}::VARCHAR END" for c in ("doc_id", "source", "lang", "n_chars", text))
    return f"sha256({' || '.join(fields)})"


MANIFEST = f"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rid, doc_id, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS s, {_leaf("text")} AS leaf,
    CASE WHEN {_CRC.format(s="(doc_id::VARCHAR)")} % 5 = 0 THEN {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS given
  FROM documents),
l AS (SELECT *, row_number() OVER (PARTITION BY s ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY s) AS n FROM d),
nodes AS (
  SELECT s, 0 AS lvl, i, n, leaf AS h FROM l
  UNION ALL
  SELECT s, lvl + 1, i // 16, (n + 15) // 16, sha256(string_agg(h, '' ORDER BY i)) FROM nodes WHERE n > 1 GROUP BY s, lvl, n, i // 16),
sub AS (SELECT s, h, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS lvl, s AS i, n, h FROM sub
  UNION ALL
  SELECT lvl + 1, i // 16, (n + 15) // 16, sha256(string_agg(h, '' ORDER BY i)) FROM tops WHERE n > 1 GROUP BY lvl, n, i // 16),
sib AS (
  SELECT l.rid, x.lvl, x.i, x.h FROM l JOIN nodes x ON x.s = l.s AND x.i // 16 = l.i // (16 ** (x.lvl + 1))::BIGINT AND x.i <> l.i // (16 ** x.lvl)::BIGINT
  UNION ALL
  SELECT l.rid, 100 + x.lvl, x.i, x.h FROM l JOIN tops x ON x.i // 16 = l.s // (16 ** (x.lvl + 1))::BIGINT AND x.i <> l.s // (16 ** x.lvl)::BIGINT),
proof AS (SELECT rid, sha256(string_agg(h, '' ORDER BY lvl, i)) AS p FROM sib GROUP BY rid),
f AS (
  SELECT rid, s, 0 AS lvl, i, n, coalesce(given, leaf) AS h FROM l
  UNION ALL
  SELECT f.rid, f.s, f.lvl + 1, f.i // 16, (f.n + 15) // 16, sha256(string_agg(CASE WHEN x.i = f.i THEN f.h ELSE x.h END, '' ORDER BY x.i))
  FROM f JOIN nodes x ON x.s = f.s AND x.lvl = f.lvl AND x.i // 16 = f.i // 16 WHERE f.n > 1 GROUP BY f.rid, f.s, f.lvl, f.i, f.n),
g AS (
  SELECT f.rid, 0 AS lvl, f.s AS i, (SELECT count(*) FROM sub) AS n, f.h FROM f WHERE f.n = 1
  UNION ALL
  SELECT g.rid, g.lvl + 1, g.i // 16, (g.n + 15) // 16, sha256(string_agg(CASE WHEN x.i = g.i THEN g.h ELSE x.h END, '' ORDER BY x.i))
  FROM g JOIN tops x ON x.lvl = g.lvl AND x.i // 16 = g.i // 16 WHERE g.n > 1 GROUP BY g.rid, g.lvl, g.i, g.n)
SELECT l.doc_id, l.leaf, sub.h AS subroot, r.h AS root, coalesce(p, sha256('')) AS proof_sha256, g.h AS folded_root, g.h = r.h AS verified
FROM l JOIN sub ON sub.s = l.s JOIN g ON g.rid = l.rid AND g.n = 1 CROSS JOIN (SELECT h FROM tops WHERE n = 1) r LEFT JOIN proof ON proof.rid = l.rid"""

_ROUND = """
d{r} AS (SELECT v.rid, c.c, v.x2 - 2 * list_inner_product(v.e, c.e) + list_inner_product(c.e, c.e) AS d FROM v CROSS JOIN c{r} c),
a{r} AS (SELECT rid, c, d FROM d{r} QUALIFY row_number() OVER (PARTITION BY rid ORDER BY d, c) = 1),
m{r} AS (
  SELECT c, list(floor(s / n) ORDER BY p) AS e FROM (
    SELECT c, p, sum(x) AS s, count(*) AS n FROM (SELECT a.c, unnest(v.e) AS x, unnest(range(64)) AS p FROM a{r} a JOIN v USING (rid)) GROUP BY c, p) GROUP BY c),
c{s} AS (SELECT c{r}.c, coalesce(m{r}.e, c{r}.e) AS e FROM c{r} LEFT JOIN m{r} USING (c)),"""

CLUSTERS = f"""
WITH k AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 256)) AS e FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
v AS (SELECT row_number() OVER () AS rid, vec_id, e, list_inner_product(e, e) AS x2 FROM k),
c0 AS (SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id::VARCHAR), e) - 1 AS c, e FROM v WHERE vec_id IS NOT NULL QUALIFY c < 40),
{"".join(_ROUND.format(r=r, s=r + 1) for r in range(6))}
t AS (SELECT c, CAST(sum(d) AS BIGINT) AS s FROM a5 GROUP BY c)
SELECT v.vec_id, CAST(a5.c AS INTEGER) AS cluster, CAST(a5.d AS BIGINT) AS distance, t.s AS cluster_inertia, CAST((SELECT sum(s) FROM t) AS BIGINT) AS inertia,
  sha256(array_to_string(list_transform(c5.e, lambda x: x::BIGINT::VARCHAR), ',')) AS centroid_sha256
FROM a5 JOIN v USING (rid) JOIN c5 ON c5.c = a5.c JOIN t ON t.c = a5.c"""



def _sql(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _hits(name: str, pattern: str) -> str:
    """Common table expressions: (rid, s, st) of a pattern's matches in ``d`` (rid, t), st counted from 0."""
    length = "lambda x: length(x)"
    return f"""{name}_m AS (SELECT rid, regexp_extract_all(t, {_sql(pattern)}) AS ms, string_split_regex(t, {_sql(pattern)}) AS bs FROM d WHERE regexp_matches(t, {_sql(pattern)})),
{name} AS (
  SELECT rid, ms[k] AS s, CAST(list_sum(list_transform(bs[1:k], {length})) + coalesce(list_sum(list_transform(ms[1:k - 1], {length})), 0) AS BIGINT) AS st
  FROM (SELECT *, unnest(range(1, len(ms) + 1)) AS k FROM {name}_m))"""


def _credentials() -> str:
    from .credential_links import ACCESS, ASSIGN, CANDIDATES, HEX, KINDS, LOGIN_URL, MIXED, PARTS, REACH, SCOPE, SHORT_HEX

    first = " ".join(f"WHEN regexp_matches(s, {_sql(f'^(?:{p})')}) THEN {i}" for i, (_, p) in enumerate(CANDIDATES))
    last = len(CANDIDATES) - 1
    mixed = " AND ".join(f"regexp_matches(s, '{p}')" for p in MIXED)
    opaque = f"(length(s) >= 20 AND {mixed}) OR (regexp_full_match(s, '{SHORT_HEX}') AND regexp_matches(s, '[0-9]') AND regexp_matches(s, '[a-f]'))"
    roles = "[" + ", ".join(f"'{r}'" for r, _ in CANDIDATES) + "]"
    names = "[" + ", ".join(f"'{k}'" for k in KINDS) + "]"
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
{_hits("assign", ASSIGN)},
{_hits("access", ACCESS)},
{_hits("hex", HEX)},
{_hits("parts", PARTS)},
base AS (
  SELECT rid, 0 AS kind, st, st + length(s) AS en FROM assign WHERE length(regexp_extract(s, {_sql(ASSIGN)}, 2)) >= 6
  UNION ALL SELECT rid, 1, st, st + length(s) FROM access UNION ALL SELECT rid, 2, st, st + length(s) FROM hex),
c AS (SELECT rid, s, st, st + length(s) AS en, CASE {first} END AS alt FROM parts),
w AS (
  SELECT rid, st, en, {roles}[alt + 1] AS role, {roles}[alt + 1] = 'endpoint' AND regexp_matches(s, '{LOGIN_URL}') AS whole FROM c
  WHERE (alt <> {last} OR {opaque}) AND NOT EXISTS (SELECT 1 FROM base b WHERE b.rid = c.rid AND b.st < c.en AND b.en > c.st)),
p AS (
  SELECT x.*, len(regexp_extract_all(left(d.t, x.st), '{SCOPE}')) AS scope FROM (
    SELECT rid, st, en, role, whole, true AS weak FROM w
    UNION ALL SELECT rid, st, en, CASE WHEN kind = 1 THEN 'id' ELSE 'key' END, false, false FROM base) x JOIN d USING (rid)),
met AS (
  SELECT a.rid, a.st, a.en, a.role, bool_or(b.role = 'id') AS i, bool_or(b.role = 'key') AS k, bool_or(b.role = 'endpoint') AS e
  FROM p a JOIN p b ON a.rid = b.rid AND a.scope = b.scope AND a.role <> b.role AND b.st - a.en <= {REACH} AND a.st - b.en <= {REACH}
  WHERE a.weak GROUP BY a.rid, a.st, a.en, a.role),
more AS (
  SELECT rid, st, en, role FROM met WHERE CASE role WHEN 'id' THEN k WHEN 'key' THEN i OR e ELSE i AND k END
  UNION SELECT rid, st, en, role FROM p WHERE whole),
spans AS (SELECT rid, kind, st, en FROM base UNION ALL SELECT rid, list_position({names}, role) - 1, st, en FROM more),
b AS (SELECT rid, string_agg(concat_ws(':', {names}[kind + 1], st, en), ',' ORDER BY st, kind) AS t, count(*) FILTER (kind = 0) AS n0, count(*) FILTER (kind = 1) AS n1, count(*) FILTER (kind = 2) AS n2 FROM base GROUP BY rid),
a AS (SELECT rid, string_agg(concat_ws(':', {names}[kind + 1], st, en), ',' ORDER BY st, kind) AS t FROM spans GROUP BY rid)
SELECT d.doc_id, coalesce(n0, 0) AS n_assign, coalesce(n1, 0) AS n_access, coalesce(n2, 0) AS n_hex, sha256(coalesce(b.t, '')) AS base_sha256, coalesce(a.t, '') AS spans
FROM d LEFT JOIN b USING (rid) LEFT JOIN a USING (rid)"""


ORACLE_SQL = {"op6_dc3_dedup": REPEATS, "op7_jaccard_join": COMPONENTS, "op9_impact_topk": TOP_K, "op11_merkle_intervals": MANIFEST, "op12_heap_centroids": CLUSTERS, "op13_credential_links": _credentials()}
