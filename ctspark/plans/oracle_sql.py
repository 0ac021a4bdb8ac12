"""DuckDB oracle SQL: the fixture rules (D1-D6) and every query, written independently of the
DataFrame code so the driver can compare the two."""

from __future__ import annotations

from . import oracle_lists as E
from .fixtures import ERROR_CASES, LEDGER_FAILURES


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# ---- fixtures -------------------------------------------------------------------------------
CERTS = """
c AS (SELECT c_custkey AS k, c_custkey % 12 AS cls, c_name, c_mktsegment FROM customer),
certs AS (
  SELECT k, cls,
    CASE WHEN cls IN (8, 9) THEN NULL
         WHEN cls = 3 THEN 'www.c' || CAST(k AS VARCHAR) || '.example.net'
         WHEN cls = 4 THEN 'www.c' || CAST(k AS VARCHAR) || '.example.org'
         WHEN cls = 5 THEN upper('www.c' || CAST(k AS VARCHAR) || '.example.com')
         WHEN cls = 10 THEN 'com'
         WHEN cls = 11 THEN ''
         ELSE 'www.c' || CAST(k AS VARCHAR) || '.example.com' END AS common_name,
    CASE WHEN cls IN (8, 9) THEN NULL
         WHEN cls = 1 THEN ''
         WHEN cls = 2 THEN 'Domain Control Validated'
         WHEN cls = 3 THEN 'c' || CAST(k AS VARCHAR) || '.example.net'
         WHEN cls = 4 THEN 'c' || CAST(k AS VARCHAR) || 'corp'
         ELSE c_name END AS organization,
    CASE WHEN cls IN (8, 9) THEN NULL WHEN cls IN (4, 10, 11) THEN '' ELSE c_mktsegment END AS organizational_unit,
    CASE WHEN cls IN (8, 9) THEN NULL WHEN cls = 10 THEN 0 WHEN cls IN (4, 5, 6, 11) THEN 1 ELSE 2 END AS dns_count
  FROM c WHERE cls <> 7),
names AS (
  SELECT k, cls, 0 AS position, common_name AS name, 'CN' AS source FROM certs WHERE cls NOT IN (8, 9, 11)
  UNION ALL SELECT k, cls, 1, 'api.c' || CAST(k AS VARCHAR) || '.example.com', 'SAN' FROM certs WHERE cls IN (0, 1, 2, 6)
  UNION ALL SELECT k, cls, 2, 'www.c' || CAST(k AS VARCHAR) || '.example.com', 'SAN' FROM certs WHERE cls IN (0, 1, 2)
  UNION ALL SELECT k, cls, 1, 'c' || CAST(k AS VARCHAR) || '.example.net', 'SAN' FROM certs WHERE cls = 3
  UNION ALL SELECT k, cls, 2, 'api.c' || CAST(k AS VARCHAR) || '.example.net', 'SAN' FROM certs WHERE cls = 3
  UNION ALL SELECT k, cls, 1, 'api.c' || CAST(k AS VARCHAR) || '.example.org', 'SAN' FROM certs WHERE cls = 4
  UNION ALL SELECT k, cls, 1, '*.c' || CAST(k AS VARCHAR) || '.example.com', 'SAN' FROM certs WHERE cls = 5),
mappings AS (
  SELECT CASE WHEN n.name = 'com' THEN '' ELSE regexp_extract(lower(n.name), '([^.]+\\.[^.]+)$', 1) END AS domain,
         n.name, ce.organization, ce.organizational_unit, n.source, n.k AS sequence_number, n.position
  FROM names n JOIN certs ce ON ce.k = n.k
  WHERE n.cls IN (0, 4, 5, 6, 10))
"""

# ---- certificate bytes: DER and TLS records as hex text, built in SQL ------------------------
_N = iter(range(1_000_000))


def _bound(value: str, body) -> str:
    """``body`` of a variable bound to ``value``, which is then written once."""
    v = f"v{next(_N)}"
    return f"list_transform([{value}], lambda {v}: {body(v)})[1]"


def _der_length(n: str) -> str:
    return f"CASE WHEN {n} < 128 THEN printf('%02X', {n}) WHEN {n} < 256 THEN printf('81%02X', {n}) WHEN {n} < 65536 THEN printf('82%04X', {n}) ELSE printf('83%06X', {n}) END"


def _tlv(tag: str, content: str) -> str:
    return _bound(content, lambda v: f"'{tag}' || {_der_length(f'(length({v}) // 2)')} || {v}")


def _u24(content: str) -> str:
    return _bound(content, lambda v: f"printf('%06X', length({v}) // 2) || {v}")


def _name(*pairs: tuple[str, str]) -> str:
    """A Name of (OID, SQL value); a null value has no part."""
    parts = [f"CASE WHEN {value} IS NULL THEN '' ELSE {_tlv('31', _tlv('30', f"{_q(oid)} || {_tlv('0C', f'hex({value})')}"))} END" for oid, value in pairs]
    return _tlv("30", " || ".join(parts))


# Object identifiers and constant parts of the fixture certificates.
_O, _OU, _CN, _SAN = "060355040A", "060355040B", "0603550403", "0603551D11"
_ALGORITHM, _VERSION, _KEY, _SIGNATURE = "300D06092A864886F70D01010B0500", "A003020102", "302A300506032B6570032100" + "00" * 32, "030100"


def _certificate(o: str, ou: str, cn: str, sans: str, serial: str) -> str:
    dates = _tlv("30", f"'17' || printf('%02X', 13) || hex('240101000000Z') || '17' || printf('%02X', 13) || hex('340101000000Z')")
    names = f"array_to_string(list_transform({sans}, lambda s: '82' || {_der_length('length(s)')} || hex(s)), '')"
    extensions = f"CASE WHEN len({sans}) = 0 THEN '' ELSE {_tlv('A3', _tlv('30', _tlv('30', f"{_q(_SAN)} || {_tlv('04', _tlv('30', names))}")))} END"
    issuer = _name((_O, "'Fixture CA'"), (_CN, "'Fixture Root'"))
    number = f"'020901' || printf('%016X', {serial})"
    tbs = _tlv("30", f"'{_VERSION}' || {number} || '{_ALGORITHM}' || {issuer} || {dates} || {_name((_O, o), (_OU, ou), (_CN, cn))} || '{_KEY}' || {extensions}")
    return _tlv("30", f"{tbs} || '{_ALGORITHM}{_SIGNATURE}'")


DER = f"""
df AS (
  SELECT c_custkey AS k, c_custkey % 12 AS cls,
    CASE c_custkey % 12 WHEN 1 THEN NULL WHEN 2 THEN 'Domain Control Validated' WHEN 3 THEN 'c' || c_custkey::VARCHAR || '.example.net' WHEN 4 THEN 'c' || c_custkey::VARCHAR || 'corp' ELSE c_name END AS o,
    CASE WHEN c_custkey % 12 IN (4, 10, 11) THEN NULL ELSE c_mktsegment END AS ou,
    CASE c_custkey % 12 WHEN 3 THEN 'www.c' || c_custkey::VARCHAR || '.example.net' WHEN 4 THEN 'www.c' || c_custkey::VARCHAR || '.example.org' WHEN 5 THEN 'WWW.C' || c_custkey::VARCHAR || '.EXAMPLE.COM'
      WHEN 10 THEN 'com' WHEN 11 THEN NULL ELSE 'www.c' || c_custkey::VARCHAR || '.example.com' END AS cn,
    CASE c_custkey % 12 WHEN 3 THEN ['c' || c_custkey::VARCHAR || '.example.net', 'api.c' || c_custkey::VARCHAR || '.example.net'] WHEN 4 THEN ['api.c' || c_custkey::VARCHAR || '.example.org'] WHEN 5 THEN ['*.c' || c_custkey::VARCHAR || '.example.com']
      WHEN 6 THEN ['api.c' || c_custkey::VARCHAR || '.example.com'] WHEN 10 THEN [] WHEN 11 THEN [' '] ELSE ['api.c' || c_custkey::VARCHAR || '.example.com', 'www.c' || c_custkey::VARCHAR || '.example.com'] END AS sans
  FROM customer),
dc AS (
  SELECT k, cls, {_certificate("o", "ou", "cn", "sans", "k")} AS whole, {_certificate("'Leaf TBS Organization'", "NULL::VARCHAR", "cn", "sans", "k")} AS tbs,
    {_certificate("'Fixture CA'", "NULL::VARCHAR", "'Fixture Root'", "[]::VARCHAR[]", "1")} AS issuer FROM df),
de AS (SELECT k, cls, tbs, issuer, CASE WHEN cls = 8 THEN substr(whole, 1, 40) ELSE whole END AS cert FROM dc),
entries AS (
  SELECT k, cls, cert, tbs,
    '0000' || printf('%016X', 1700000000000 + k * 1000) || CASE cls WHEN 6 THEN '0001' || upper(sha256('fixture issuer key')) || {_u24("tbs")} WHEN 7 THEN '0002' || {_u24("cert")} ELSE '0000' || {_u24("cert")} END || '0000' AS leaf,
    CASE WHEN cls = 6 THEN {_u24("cert")} || {_u24(_u24("issuer"))} ELSE {_u24(_u24("issuer"))} END AS extra
  FROM de)
"""


BATCH_LINES = """
bl AS (
  SELECT 'batch-' || CAST(doc_id % 10 AS VARCHAR) || '.gz' AS file, doc_id,
    CASE WHEN doc_id % 13 = 12 THEN ''
         WHEN doc_id % 11 = 10 THEN md5(text)
         WHEN doc_id % 17 = 16 THEN '9223372036854775808' || repeat(' ', CAST(1 + doc_id % 3 AS INTEGER)) || md5(text)
         ELSE CAST(doc_id AS VARCHAR) || repeat(' ', CAST(1 + doc_id % 3 AS INTEGER)) || md5(text) END AS line,
    md5(text) AS h
  FROM documents),
parsed AS (
  SELECT file, doc_id, line,
    CASE WHEN doc_id % 13 = 12 THEN 'line is empty'
         WHEN doc_id % 11 = 10 THEN 'line does not match expected format ''sequence_number certificate_data'''
         WHEN doc_id % 17 = 16 THEN 'invalid sequence number ''9223372036854775808'''
         ELSE NULL END AS error,
    h
  FROM bl)
"""

OBJECTS = """
objects AS (
  SELECT source || '/' || CAST(doc_id AS VARCHAR) || '.batch' ||
           CASE WHEN doc_id % 5 <= 2 THEN '.gz' WHEN doc_id % 5 = 3 THEN '.GZ' ELSE '.txt' END AS key,
         n_chars AS size,
         CASE WHEN doc_id % 4 = 1 THEN '"' || md5(text) || CASE WHEN doc_id % 7 = 0 THEN '-2' ELSE '' END || '"'
              ELSE md5(text) || CASE WHEN doc_id % 7 = 0 THEN '-2' ELSE '' END END AS etag,
         TIMESTAMP '2024-01-01 00:00:00' + to_seconds(doc_id) AS last_modified,
         doc_id, text
  FROM documents),
ledger AS (
  SELECT key, CASE WHEN doc_id % 6 = 0 THEN md5(text || 'v0') ELSE etag END AS etag, size,
         last_modified + INTERVAL 1 HOUR AS event_ts, 1 AS seq, 'processed' AS status, '' AS error_msg, doc_id
  FROM objects WHERE doc_id % 3 = 0
  UNION ALL
  SELECT key, etag, 0 AS size, last_modified + INTERVAL 2 HOUR, 2, 'failed',
         (%(failures)s)[doc_id %% 4 + 1], doc_id
  FROM objects WHERE doc_id %% 9 = 0),
cur AS (
  SELECT key, etag, CASE WHEN status = 'failed' THEN 0 ELSE size END AS size, event_ts, status, error_msg FROM (
    SELECT *, row_number() OVER (PARTITION BY key ORDER BY event_ts DESC, seq DESC) AS rn FROM ledger) WHERE rn = 1)
""".replace("%(failures)s", "[" + ", ".join(_q(m) for m in LEDGER_FAILURES) + "]").replace("%%", "%")

FETCH = """
flog AS (
  SELECT 'endpoint-' || CAST(user_id % 8 AS VARCHAR) AS endpoint, ts, event_id,
         'obj/' || CAST(event_id AS VARCHAR) || '.gz' AS key, event_type <> 'error' AS success,
         value AS duration_ms, event_id % 4096 AS bytes, CAST(event_id % 4 AS INTEGER) AS retries, event_id % 256 AS entries
  FROM events)
"""

ERRORS = (
    """
cases AS (SELECT * FROM (VALUES %s) t(i, message, context, kind)),
errs AS (
  SELECT e.event_id AS sequence, e.ts, c.message, c.context, c.kind, CAST(e.event_id %% 12 AS INTEGER) AS attempt,
         'batch-' || CAST(e.event_id %% 10 AS VARCHAR) || '.gz' AS source_file
  FROM events e JOIN cases c ON c.i = e.event_id %% %d)
"""
    % (", ".join(f"({i}, {_q(m)}, {_q(c)}, {_q(k)})" for i, (m, c, k) in enumerate(ERROR_CASES)), len(ERROR_CASES))
).replace("%%", "%")


def _any(col: str, pats) -> str:
    return "(" + " OR ".join(f"contains({col}, {_q(p.lower())})" for p in pats) + ")"


def classify_sql(m: str, x: str) -> str:
    """E1 as a SQL CASE over lower-cased message m and context x."""
    return f"""(CASE
  WHEN {m} IS NULL THEN 'UNKNOWN'
  WHEN contains({x}, 's3') OR contains({m}, 's3') THEN
    CASE WHEN {_any(m, E.S3_ACCESS_MSG)} OR {_any(x, E.S3_ACCESS_CTX)} THEN 'S3_ACCESS'
         WHEN {_any(m, E.S3_DOWNLOAD_MSG)} OR {_any(x, E.S3_DOWNLOAD_CTX)} THEN 'S3_DOWNLOAD'
         WHEN {_any(x, E.S3_STATE_CTX)} THEN 'S3_STATE' ELSE 'S3_ACCESS' END
  WHEN {_any(m, E.MEMORY_MSG)} OR (contains({m}, 'memory') AND NOT contains({m}, 'file')) THEN 'MEMORY'
  WHEN {_any(m, E.NETWORK_MSG)} THEN 'NETWORK'
  WHEN {_any(m, E.FILE_MSG)} OR {_any(x, E.FILE_CTX)} THEN 'FILE'
  WHEN {_any(m, E.PARSING_MSG)} OR {_any(x, E.PARSING_CTX)} THEN 'PARSING'
  WHEN {_any(m, E.OUTPUT_MSG)} OR {_any(x, E.OUTPUT_CTX)} THEN 'OUTPUT'
  WHEN {_any(x, E.PROCESSING_CTX)} THEN 'PROCESSING'
  ELSE 'UNKNOWN' END)"""


def classify_s3_sql(m: str, o: str) -> str:
    return f"""(CASE
  WHEN {m} IS NULL THEN 'UNKNOWN'
  WHEN {_any(m, E.S3C_ACCESS_MSG)} OR {_any(o, E.S3C_ACCESS_OP)} THEN 'S3_ACCESS'
  WHEN {_any(m, E.S3C_DOWNLOAD_MSG)} OR {_any(o, E.S3C_DOWNLOAD_OP)} THEN 'S3_DOWNLOAD'
  WHEN {_any(o, E.S3C_STATE_OP)} OR {_any(m, E.S3C_STATE_MSG)} THEN 'S3_STATE'
  ELSE {classify_sql(m, o)} END)"""


def retryable_sql(m: str, t: str) -> str:
    parts = []
    for typ, (_, _, _, _, pats) in E.RETRY_CONFIG.items():
        parts.append(f"WHEN {t} = {_q(typ)} THEN ({_any(m, pats)} OR {_any(m, E.COMMON_RETRYABLE)})")
    return f"(CASE WHEN {m} IS NULL THEN false " + " ".join(parts) + " ELSE false END)"


def _map_sql(t: str, table: dict, default) -> str:
    def lit(v):
        return _q(v) if isinstance(v, str) else ("true" if v is True else "false" if v is False else repr(v))

    return "(CASE " + " ".join(f"WHEN {t} = {_q(k)} THEN {lit(v)}" for k, v in table.items()) + f" ELSE {lit(default)} END)"


def delay_sql(a: str, t: str) -> str:
    init = _map_sql(t, {k: v[1] for k, v in E.RETRY_CONFIG.items()}, E.DEFAULT_DELAY[0])
    cap = _map_sql(t, {k: v[2] for k, v in E.RETRY_CONFIG.items()}, E.DEFAULT_DELAY[1])
    return f"least({init} * pow(2.0, CAST({a} AS DOUBLE)), {cap})"


def action_sql(m: str, o: str, k: str, a: str) -> str:
    s3t = classify_s3_sql(m, o)
    rate = _any(m, E.RATE_LIMIT)
    auth = _any(m, E.AUTH)
    pt = classify_sql(m, "'processing'")
    return f"""(CASE WHEN {m} IS NULL THEN 'RETRY'
  WHEN {k} = 's3' THEN CASE WHEN {rate} THEN 'WAIT' WHEN {auth} THEN 'FAIL' WHEN contains({m}, 'nosuchbucket') THEN 'FAIL'
                            WHEN {retryable_sql(m, s3t)} THEN 'RETRY' ELSE 'SKIP' END
  WHEN {k} = 'download' THEN CASE WHEN {a} >= 10 THEN 'FAIL' WHEN {retryable_sql(m, "'S3_DOWNLOAD'")} THEN (CASE WHEN {rate} THEN 'WAIT' ELSE 'RETRY' END) ELSE 'SKIP' END
  WHEN {k} = 'processing' THEN CASE WHEN {pt} = 'MEMORY' THEN 'WAIT' WHEN {pt} = 'FILE' THEN 'RETRY'
                                    WHEN {pt} = 'PROCESSING' AND contains({m}, 'lock') THEN 'RETRY' ELSE 'SKIP' END
  WHEN {k} = 'state' THEN CASE WHEN {retryable_sql(m, "'S3_STATE'")} THEN 'RETRY' WHEN contains({m}, 'corruption') THEN 'FAIL' ELSE 'SKIP' END
  ELSE 'SKIP' END)"""


def hint_sql(m: str, t: str, raw: str) -> str:
    h = {k: _q(v) for k, v in E.HINTS.items()}
    return f"""(CASE WHEN {raw} IS NULL THEN ''
  WHEN {t} = 'S3_ACCESS' THEN CASE WHEN contains({m}, 'access denied') OR contains({m}, 'forbidden') THEN {h['access']}
       WHEN contains({m}, 'no such bucket') OR contains({m}, 'nosuchbucket') THEN {h['bucket']}
       WHEN contains({m}, 'invalid access key') THEN {h['key']} WHEN contains({m}, 'region') THEN {h['region']} ELSE {h['s3_default']} END
  WHEN {t} = 'S3_DOWNLOAD' THEN CASE WHEN contains({m}, 'timeout') THEN {h['dl_timeout']} WHEN contains({m}, 'connection') THEN {h['dl_connection']}
       WHEN contains({m}, 'slowdown') OR contains({m}, 'rate') THEN {h['dl_rate']} WHEN contains({m}, 'no such key') THEN {h['dl_missing']} ELSE {h['dl_default']} END
  WHEN {t} = 'S3_STATE' THEN CASE WHEN contains({m}, 'permission') THEN {h['state_permission']} WHEN contains({m}, 'corruption') THEN {h['state_corruption']}
       WHEN contains({m}, 'lock') THEN {h['state_lock']} ELSE {h['state_default']} END
  WHEN {t} = 'NETWORK' THEN CASE WHEN contains({m}, 'dns') THEN {h['net_dns']} WHEN contains({m}, 'timeout') THEN {h['net_timeout']} ELSE {h['net_default']} END
  WHEN {t} = 'MEMORY' THEN {h['memory']}
  WHEN {t} = 'FILE' THEN {h['file']}
  ELSE 'Error: ' || {raw} || '. See the logs; a retry may help.' END)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"


EL = "lower(message)"
EX = "lower(context)"
ETYPE = classify_sql(EL, EX)
