"""Registered queries: name -> (DataFrame builder, DuckDB oracle SQL or None).

Every builder reads the driver tables (or data Spark derives from them) in full; no row caps.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import errors as E
from ..functions.encoding import base64_error, decode_base64_strict
from ..functions.steps import spread
from ..operators import errlog, ledger, monitor, objects, ordering, stats
from ..operators.hosts import clean_log_name, default_psl, file_ext, is_gzip, normalize_host, output_name, registered_domain
from ..operators.leaf import decode_leaf, leaf_payload
from ..operators.mappings import certificates, drop_self_referential, explode_names, extract, filter_org, format_mapping, validate_certificate, validate_entry, validate_mapping
from ..session import read_table
from ..sources.batch_files import file_profile, parse_lines, read_batch_lines, write_batch_fixture
from ..sources.pages import explode_entries
from . import fixtures as fx
from . import oracle_sql as O

QUERIES: dict = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = (fn, sql)
        return fn

    return deco


def _extract(spark, sf_dir):
    from ..shipping import ensure_shipped

    ensure_shipped(spark)
    return extract(spread(fx.ct_lines(spark, sf_dir)), default_psl(spark))


# ---- flagship and decode ---------------------------------------------------------------------


@query("extract_mappings", O.with_(O.CERTS) + "SELECT domain, name, organization, organizational_unit, source, sequence_number FROM mappings")
def q_extract_mappings(spark, sf_dir):
    return _extract(spark, sf_dir)[0].drop("position")


@query(
    "entry_status",
    O.with_(O.CERTS)
    + """SELECT k AS sequence_number,
  CASE WHEN cls IN (8, 9) THEN 'parse' WHEN cls = 11 THEN 'extract' ELSE 'ok' END AS stage,
  CASE cls WHEN 1 THEN 'no_org' WHEN 2 THEN 'dcv' WHEN 3 THEN 'self_referential' END AS skip_reason,
  CAST(CASE cls WHEN 0 THEN 3 WHEN 4 THEN 2 WHEN 5 THEN 2 WHEN 6 THEN 2 WHEN 10 THEN 1 ELSE 0 END AS BIGINT) AS mappings_emitted
FROM certs""",
)
def q_entry_status(spark, sf_dir):
    return _extract(spark, sf_dir)[1].drop("error")


@query(
    "processing_stats",
    """SELECT count(*) AS total_processed,
  count(*) FILTER (WHERE c_custkey % 12 NOT IN (8, 9, 11)) AS successful_parsed,
  count(*) FILTER (WHERE c_custkey % 12 IN (8, 9, 11)) AS errors,
  round(CASE WHEN count(*) = 0 THEN 0 ELSE 100.0 * count(*) FILTER (WHERE c_custkey % 12 NOT IN (8, 9, 11)) / count(*) END, 6) AS success_rate,
  round(CASE WHEN count(*) = 0 THEN 0 ELSE 100.0 * count(*) FILTER (WHERE c_custkey % 12 IN (8, 9, 11)) / count(*) END, 6) AS error_rate
FROM customer WHERE c_custkey % 12 <> 7""",
)
def q_processing_stats(spark, sf_dir):
    return stats.processing_stats(_extract(spark, sf_dir)[1])


@query(
    "decode_leaf",
    O.with_(O.DER)
    + """SELECT k AS log_index, 1700000000000 + k * 1000 AS timestamp_ms, CAST(CASE cls WHEN 6 THEN 1 WHEN 7 THEN 2 ELSE 0 END AS BIGINT) AS entry_type,
  CASE WHEN cls <> 7 THEN lower(cert) END AS der, CASE WHEN cls = 7 THEN 'unsupported log entry type' END AS error FROM entries""",
)
def q_decode_leaf(spark, sf_dir):
    d = decode_leaf(fx.ct_entries(spark, sf_dir))
    return d.select("log_index", "timestamp_ms", "entry_type", F.lower(F.hex("der")).alias("der"), "error")


@query(
    "leaf_payload",
    O.with_(O.DER)
    + """SELECT k AS log_index, CAST(CASE WHEN cls = 7 THEN NULL WHEN cls = 6 THEN 1 ELSE 0 END AS BIGINT) AS entry_type,
  CASE WHEN cls = 6 THEN lower(tbs) WHEN cls <> 7 THEN lower(cert) END AS payload, CASE WHEN cls = 7 THEN 'unsupported log entry type' END AS error FROM entries""",
)
def q_leaf_payload(spark, sf_dir):
    d = leaf_payload(fx.ct_entries(spark, sf_dir).drop("extra_data"))
    return d.select("log_index", "entry_type", F.lower(F.hex("payload")).alias("payload"), "error")


_B64_SRC = """SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN md5(text) WHEN 1 THEN md5(text) || '='
  WHEN 2 THEN substr(md5(text), 1, 30) || '==' WHEN 3 THEN '   ' ELSE substr(md5(text), 1, 10) || '!' || substr(md5(text), 12) END AS s FROM documents"""


@query(
    "decode_base64",
    f"""SELECT doc_id,
  CASE doc_id % 5 WHEN 1 THEN 'failed to decode base64 certificate data' WHEN 3 THEN 'certificate data is empty'
       WHEN 4 THEN 'failed to decode base64 certificate data' END AS error,
  CAST(CASE doc_id % 5 WHEN 0 THEN 24 WHEN 2 THEN 22 END AS INTEGER) AS decoded_len
FROM ({_B64_SRC})""",
)
def q_decode_base64(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    h = F.md5("text")
    i = F.col("doc_id")
    s = (
        F.when(i % 5 == 0, h)
        .when(i % 5 == 1, F.concat(h, F.lit("=")))
        .when(i % 5 == 2, F.concat(F.substring(h, 1, 30), F.lit("==")))
        .when(i % 5 == 3, F.lit("   "))
        .otherwise(F.concat(F.substring(h, 1, 10), F.lit("!"), F.substring(h, 12, 100)))
    )
    d = d.select("doc_id", s.alias("s"))
    return d.select("doc_id", base64_error(F.col("s")).alias("error"), F.length(decode_base64_strict(F.col("s"))).alias("decoded_len"))


def _certs(spark, sf_dir):
    from ..shipping import ensure_shipped

    ensure_shipped(spark)
    return certificates(spread(fx.ct_lines(spark, sf_dir)))


@query(
    "cert_fields",
    O.with_(O.CERTS)
    + """, sans AS (SELECT k, cls, CASE cls WHEN 3 THEN 'c' || k::VARCHAR || '.example.net,api.c' || k::VARCHAR || '.example.net' WHEN 4 THEN 'api.c' || k::VARCHAR || '.example.org' WHEN 5 THEN '*.c' || k::VARCHAR || '.example.com'
  WHEN 6 THEN 'api.c' || k::VARCHAR || '.example.com' WHEN 10 THEN '' WHEN 11 THEN ' ' ELSE 'api.c' || k::VARCHAR || '.example.com,www.c' || k::VARCHAR || '.example.com' END AS dns_names FROM c)
SELECT k AS sequence_number, cls NOT IN (8, 9) AS parse_ok, common_name, organization, organizational_unit, CASE WHEN cls NOT IN (8, 9) THEN dns_names END AS dns_names FROM certs JOIN sans USING (k, cls)""",
)
def q_cert_fields(spark, sf_dir):
    c = _certs(spark, sf_dir)
    ok = F.col("parse_error").isNull() & F.col("decode_error").isNull()
    return c.select(
        "sequence_number",
        ok.alias("parse_ok"),
        "common_name",
        F.when(ok, F.col("organization")).alias("organization"),
        F.when(ok, F.col("organizational_unit")).alias("organizational_unit"),
        F.when(ok, F.array_join("dns_names", ",")).alias("dns_names"),
    )


@query("subject_org", O.with_(O.CERTS) + "SELECT k AS sequence_number, organization, organizational_unit FROM certs WHERE cls NOT IN (8, 9)")
def q_subject_org(spark, sf_dir):
    c = _certs(spark, sf_dir)
    return c.filter(F.col("parse_error").isNull() & F.col("decode_error").isNull()).select("sequence_number", "organization", "organizational_unit")


@query("explode_names", O.with_(O.CERTS) + "SELECT k AS sequence_number, position, name, source FROM names")
def q_explode_names(spark, sf_dir):
    c = _certs(spark, sf_dir).filter(F.col("parse_error").isNull() & F.col("decode_error").isNull())
    return explode_names(c)


@query("filter_org", O.with_(O.CERTS) + "SELECT k AS sequence_number FROM certs WHERE cls NOT IN (1, 2, 8, 9)")
def q_filter_org(spark, sf_dir):
    c = _certs(spark, sf_dir).filter(F.col("parse_error").isNull() & F.col("decode_error").isNull())
    return filter_org(c).select("sequence_number")


@query("self_referential", O.with_(O.CERTS) + "SELECT k AS sequence_number FROM certs WHERE cls NOT IN (1, 2, 3, 8, 9)")
def q_self_referential(spark, sf_dir):
    """F2 after F1: the certificates whose organisation is not one of their own hosts."""
    c = _certs(spark, sf_dir).filter(F.col("parse_error").isNull() & F.col("decode_error").isNull())
    return drop_self_referential(filter_org(c), default_psl(spark)).select("sequence_number")


@query(
    "validate_certificate",
    O.with_(O.CERTS)
    + "SELECT k AS sequence_number, CASE WHEN cls = 11 THEN 'certificate has no valid names (CN or SAN)' END AS certificate_error FROM certs WHERE cls NOT IN (8, 9)",
)
def q_validate_certificate(spark, sf_dir):
    c = _certs(spark, sf_dir).filter(F.col("parse_error").isNull() & F.col("decode_error").isNull())
    return validate_certificate(c).select("sequence_number", "certificate_error")


@query(
    "format_mapping",
    O.with_(O.CERTS) + "SELECT sequence_number, position, name || ' -> ' || organization || ' (' || source || ') [seq:' || CAST(sequence_number AS VARCHAR) || ']' AS line FROM mappings",
)
def q_format_mapping(spark, sf_dir):
    m = _extract(spark, sf_dir)[0]
    return m.select("sequence_number", "position", format_mapping(m, with_seq=True).alias("line"))


# ---- hosts -----------------------------------------------------------------------------------

# xn--bcher-kva and xn--ls8h are valid; the others break a label rule, and have no host
_LABELS = ["xn--bcher-kva", "xn--ls8h", "ab--cd", "-a", "a-", "xn--99999999", "XN--Bcher-KVA", "xn--0"]
_HOST_SQL = f"""h AS (SELECT page_id, regexp_extract(url, '^[a-zA-Z]+://([^/?#:]+)', 1) AS host0 FROM pages),
hv AS (SELECT page_id, CASE page_id % 4 WHEN 1 THEN '*.' || upper(host0) WHEN 2 THEN '.' || host0 || '..' WHEN 3 THEN ({_LABELS})[page_id // 4 % 8 + 1] || '.' || host0 ELSE host0 END AS raw,
  page_id % 4 = 3 AND page_id // 4 % 8 IN (2, 3, 4, 5, 7) AS broken FROM h),
hn AS (SELECT page_id, raw, CASE WHEN broken THEN '' ELSE trim(regexp_replace(lower(raw), '^\\*\\.', ''), '.') END AS host FROM hv)"""


def _hosts(spark, sf_dir):
    p = read_table(spark, sf_dir, "pages").select("page_id", "url")
    h0 = F.regexp_extract("url", r"^[a-zA-Z]+://([^/?#:]+)", 1)
    i = F.col("page_id")
    label = F.element_at(F.array(*map(F.lit, _LABELS)), (F.floor(i / 4) % 8 + 1).cast("int"))
    raw = F.when(i % 4 == 1, F.concat(F.lit("*."), F.upper(h0))).when(i % 4 == 2, F.concat(F.lit("."), h0, F.lit(".."))).when(i % 4 == 3, F.concat(label, F.lit("."), h0)).otherwise(h0)
    return p.select("page_id", raw.alias("raw"))


@query("normalize_host", O.with_(_HOST_SQL) + "SELECT page_id, raw, host FROM hn")
def q_normalize_host(spark, sf_dir):
    from ..shipping import ensure_shipped

    ensure_shipped(spark)
    return _hosts(spark, sf_dir).select("page_id", "raw", normalize_host(F.col("raw")).alias("host"))


# a host of every kind of rule, and its registered domain
_SUFFIX_SQL = """sx AS (SELECT page_id, unnest(['www.p' || page_id || '.co.uk', 'a.x.p' || page_id || '.ck', 'a.www.ck', 'x.y.p' || page_id || '.kawasaki.jp', 'a.city.kawasaki.jp', 'a.p' || page_id || '.nosuchsuffix', 'co.uk', 'p' || page_id || '..com']) AS host,
  unnest(['p' || page_id || '.co.uk', 'x.p' || page_id || '.ck', 'www.ck', 'y.p' || page_id || '.kawasaki.jp', 'city.kawasaki.jp', 'p' || page_id || '.nosuchsuffix', '', '']) AS domain FROM pages)"""


@query(
    "registered_domain",
    O.with_(_HOST_SQL + ", " + _SUFFIX_SQL) + "SELECT page_id, host, regexp_extract(host, '([^.]+\\.[^.]+)$', 1) AS domain FROM hn UNION ALL SELECT page_id, host, domain FROM sx",
)
def q_registered_domain(spark, sf_dir):
    from ..shipping import ensure_shipped

    ensure_shipped(spark)
    h = _hosts(spark, sf_dir).select("page_id", normalize_host(F.col("raw")).alias("host"))
    p = F.concat(F.lit("p"), F.col("page_id").cast("string"))
    parts = (("www.", p, ".co.uk"), ("a.x.", p, ".ck"), ("a.www.ck",), ("x.y.", p, ".kawasaki.jp"), ("a.city.kawasaki.jp",), ("a.", p, ".nosuchsuffix"), ("co.uk",), (p, "..com"))
    more = F.array(*(F.concat(*(x if not isinstance(x, str) else F.lit(x) for x in xs)) for xs in parts))
    h = h.unionByName(read_table(spark, sf_dir, "pages").select("page_id", F.explode(more).alias("host")))
    return registered_domain(h, "host", default_psl(spark)).select("page_id", "host", "domain")


@query(
    "clean_log_name",
    """SELECT page_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(url, '^https://', ''), '^http://', ''),
  '[:/]', '_', 'g'), '[^A-Za-z0-9._-]', '', 'g'), '_$', '') AS file_name FROM pages""",
)
def q_clean_log_name(spark, sf_dir):
    return read_table(spark, sf_dir, "pages").select("page_id", clean_log_name(F.col("url")).alias("file_name"))


@query(
    "output_name",
    O.with_(O.OBJECTS)
    + """SELECT key, regexp_replace(regexp_extract(key, '([^/]*)$', 1), '\\.gz$', '') || '.json' AS json_name,
  regexp_replace(regexp_extract(key, '([^/]*)$', 1), '\\.gz$', '') || '.csv' AS csv_name,
  'out/' || regexp_replace(regexp_extract(key, '([^/]*)$', 1), '\\.gz$', '') || '.txt' AS txt_path FROM objects""",
)
def q_output_name(spark, sf_dir):
    o = fx.objects(spark, sf_dir)
    return o.select("key", output_name(F.col("key"), "json").alias("json_name"), output_name(F.col("key"), "csv").alias("csv_name"), output_name(F.col("key"), "txt", "out/").alias("txt_path"))


@query("file_ext", O.with_(O.OBJECTS) + "SELECT key, lower(regexp_extract(key, '(\\.[^./]*)$', 1)) AS ext, lower(regexp_extract(key, '(\\.[^./]*)$', 1)) = '.gz' AS is_gzip FROM objects")
def q_file_ext(spark, sf_dir):
    o = fx.objects(spark, sf_dir)
    return o.select("key", file_ext(F.col("key")).alias("ext"), is_gzip(F.col("key")).alias("is_gzip"))


# ---- report formatting ----------------------------------------------------------------------


def _hb_sql(x: str) -> str:
    return f"""CASE WHEN {x} < 1024 THEN printf('%d B', {x})
  WHEN {x} < 1048576 THEN printf('%.1f KB', round_even({x} / 1024.0, 1))
  WHEN {x} < 1073741824 THEN printf('%.1f MB', round_even({x} / 1048576.0, 1))
  ELSE printf('%.1f GB', round_even({x} / 1073741824.0, 1)) END"""


@query(
    "human_units",
    f"""SELECT doc_id, {_hb_sql('n_chars * 1000')} AS bytes_h,
  CASE WHEN n_chars * 10 < 1000 THEN printf('%d', n_chars * 10) WHEN n_chars * 10 < 1000000 THEN printf('%.1fK', round_even(n_chars * 10 / 1000.0, 1)) ELSE printf('%.1fM', round_even(n_chars * 10 / 1000000.0, 1)) END AS count_h,
  CASE WHEN n_chars / 10.0 < 60 THEN printf('%.1fs', round_even(n_chars / 10.0, 1)) WHEN n_chars / 10.0 < 3600 THEN printf('%.1fm', round_even(n_chars / 10.0 / 60, 1)) ELSE printf('%.1fh', round_even(n_chars / 10.0 / 3600, 1)) END AS seconds_h
FROM documents""",
)
def q_human_units(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return d.select(
        "doc_id",
        stats.human_bytes(F.col("n_chars") * 1000).alias("bytes_h"),
        stats.human_count(F.col("n_chars") * 10).alias("count_h"),
        stats.human_seconds(F.col("n_chars") / 10.0).alias("seconds_h"),
    )


@query(
    "stats_string",
    O.with_(O.BATCH_LINES)
    + """SELECT file,
  CASE WHEN count(error) > 0 THEN printf('%d Success, Errors: %d, Duration: %.3fs', count(*) - count(error), count(error), count(*) / 100000.0 * 3.0)
       ELSE printf('%d Success, Duration: %.3fs', count(*) - count(error), count(*) / 100000.0 * 3.0) END AS compact,
  printf('Processed: %d, Success: %d (%.2f%%), Errors: %d (%.2f%%), Duration: %s', count(*), count(*) - count(error), 100.0 * (count(*) - count(error)) / count(*), count(error), 100.0 * count(error) / count(*),
    CASE WHEN count(*) * 30 < 1000 THEN CAST(count(*) * 30 AS VARCHAR) || 'µs'
         WHEN count(*) * 30 < 1000000 THEN regexp_replace(regexp_replace(printf('%.6f', count(*) * 30 / 1000.0), '0+$', ''), '\\.$', '') || 'ms'
         ELSE regexp_replace(regexp_replace(printf('%.6f', count(*) * 30 / 1000000.0), '0+$', ''), '\\.$', '') || 's' END) AS long_form
FROM parsed GROUP BY file""",
)
def q_stats_string(spark, sf_dir):
    p = parse_lines(fx.batch_lines(spark, sf_dir), col="line")
    g = p.groupBy("file").agg(F.count(F.lit(1)).alias("total"), F.count("error").alias("errors"))
    ok = F.col("total") - F.col("errors")
    return g.select(
        "file",
        stats.stats_string(ok, F.col("errors"), F.col("total") / 100000.0 * 3.0).alias("compact"),
        stats.stats_long_string(F.col("total"), ok, F.col("errors"), F.col("total") / 100000.0 * 3.0).alias("long_form"),
    )


# ---- validation ------------------------------------------------------------------------------

_VM_SRC = """SELECT c_custkey AS k,
  CASE c_custkey % 5 WHEN 0 THEN '' WHEN 1 THEN '  ' ELSE 'n' || CAST(c_custkey AS VARCHAR) END AS name,
  CASE WHEN c_custkey % 7 = 0 THEN '' ELSE c_name END AS org,
  CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment ELSE '' END AS ou,
  CASE c_custkey % 11 WHEN 0 THEN 'XYZ' WHEN 1 THEN 'SAN' ELSE 'CN' END AS source,
  CASE WHEN c_custkey % 13 = 0 THEN -c_custkey - 1 ELSE c_custkey END AS seq FROM customer"""


@query(
    "validate_mapping",
    f"""SELECT k, CASE WHEN trim(name) = '' THEN 'name cannot be empty'
  WHEN trim(org) = '' AND ou = '' THEN 'organization cannot be empty'
  WHEN source NOT IN ('CN', 'SAN') THEN 'source must be either ''CN'' or ''SAN'''
  WHEN seq < 0 THEN 'sequence number must be non-negative' END AS reason FROM ({_VM_SRC})""",
)
def q_validate_mapping(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    name = F.when(k % 5 == 0, F.lit("")).when(k % 5 == 1, F.lit("  ")).otherwise(F.concat(F.lit("n"), k.cast("string")))
    org = F.when(k % 7 == 0, F.lit("")).otherwise(F.col("c_name"))
    ou = F.when(k % 3 == 0, F.col("c_mktsegment")).otherwise(F.lit(""))
    src = F.when(k % 11 == 0, F.lit("XYZ")).when(k % 11 == 1, F.lit("SAN")).otherwise(F.lit("CN"))
    seq = F.when(k % 13 == 0, -k - 1).otherwise(k)
    return c.select(k.alias("k"), validate_mapping(name, org, ou, src, seq).alias("reason"))


@query(
    "validate_entry",
    """SELECT c_custkey AS k, CASE WHEN c_custkey % 5 = 0 THEN 'sequence number must be non-negative'
  WHEN c_custkey % 3 IN (0, 1) THEN 'certificate data cannot be empty' END AS reason FROM customer""",
)
def q_validate_entry(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    seq = F.when(k % 5 == 0, F.lit(-1)).otherwise(k)
    data = F.when(k % 3 == 0, F.lit("")).when(k % 3 == 1, F.lit(" ")).otherwise(F.col("c_name"))
    return c.select(k.alias("k"), validate_entry(seq, data).alias("reason"))


# ---- batch files -------------------------------------------------------------------------------


@query(
    "parse_lines",
    O.with_(O.BATCH_LINES)
    + "SELECT doc_id, CASE WHEN error IS NULL THEN doc_id END AS sequence_number, CASE WHEN error IS NULL THEN h END AS certificate_data, error FROM parsed",
)
def q_parse_lines(spark, sf_dir):
    return parse_lines(fx.batch_lines(spark, sf_dir), col="line").select("doc_id", "sequence_number", "certificate_data", "error")


def _written_batches(spark, sf_dir):
    """D2 written as gzip batch files under the shared folder (once per input folder)."""
    path = fx.fixture_path(spark, sf_dir, "batch_files")
    if path not in _WRITTEN:
        write_batch_fixture(fx.batch_lines(spark, sf_dir), path)
        _WRITTEN.add(path)
    return path


_WRITTEN: set = set()


@query("batch_scan", O.with_(O.BATCH_LINES) + "SELECT file, line AS value FROM bl")
def q_batch_scan(spark, sf_dir):
    path = _written_batches(spark, sf_dir)
    df = read_batch_lines(spark, path, recursive=True)
    return df.select(F.regexp_extract("file", r"file=([^/]+)/", 1).alias("file"), "value")


@query(
    "file_profile",
    O.with_(O.BATCH_LINES)
    + """SELECT file, count(*) AS line_count, true AS has_size, round(count(*) / 100000.0 * 3.0, 6) AS estimated_seconds, CAST(NULL AS VARCHAR) AS error FROM bl GROUP BY file
UNION ALL SELECT 'gone.gz', 0, true, 0.0, 'file is empty or unreadable'""",
)
def q_file_profile(spark, sf_dir):
    path = _written_batches(spark, sf_dir)
    df = read_batch_lines(spark, path, recursive=True)
    listing = objects.filter_objects(objects.list_objects(spark, path), [".gz"]).select("key", "size")
    listing = listing.unionByName(spark.createDataFrame([("/file=gone.gz/x.gz", 0)], "key string, size long"))
    p = file_profile(df, listing)
    return p.select(F.regexp_extract("file", r"file=([^/]+)/", 1).alias("file"), "line_count", F.col("size").isNotNull().alias("has_size"), "estimated_seconds", "error")


@query(
    "profile_summary",
    O.with_(O.BATCH_LINES)
    + """SELECT count(*) AS files_ok, count(*) AS files_total, CAST(sum(n) AS BIGINT) AS total_certificates,
  CASE WHEN count(*) > 1 THEN CAST(sum(n) // count(*) AS BIGINT) END AS avg_per_file,
  round(sum(n) / 100000.0 * 3.0, 6) AS estimated_seconds FROM (SELECT file, count(*) AS n FROM bl GROUP BY file)""",
)
def q_profile_summary(spark, sf_dir):
    return stats.profile_summary(file_profile(fx.batch_lines(spark, sf_dir).withColumnRenamed("line", "value")))


@query(
    "progress_marks",
    O.with_(O.BATCH_LINES)
    + "SELECT file, doc_id, line_no AS position FROM (SELECT file, doc_id, row_number() OVER (PARTITION BY file ORDER BY doc_id) AS line_no FROM bl) WHERE line_no % 10 = 0",
)
def q_progress_marks(spark, sf_dir):
    b = fx.batch_lines(spark, sf_dir)
    return ordering.progress_marks(b, "file", "doc_id", F.floor(F.col("doc_id") / 1000), interval=10).select("file", "doc_id", "position")


@query("explode_entries", O.with_(O.DER) + "SELECT k AS log_index, base64(from_hex(leaf)) AS leaf_input, base64(from_hex(extra)) AS extra_data FROM entries")
def q_explode_entries(spark, sf_dir):
    e = explode_entries(fx.ct_pages(spark, sf_dir))
    return e.select("log_index", "leaf_input", "extra_data")


# ---- objects and ledger ------------------------------------------------------------------------


@query(
    "filter_objects",
    O.with_(O.OBJECTS) + "SELECT key, size FROM objects WHERE lower(key) LIKE '%.gz' AND size BETWEEN 1000 AND 5000",
)
def q_filter_objects(spark, sf_dir):
    return objects.filter_objects(fx.objects(spark, sf_dir), [".gz"], 1000, 5000, sort_by_key=True).select("key", "size")


@query(
    "validate_objects",
    O.with_(O.OBJECTS)
    + "SELECT key, CASE WHEN doc_id % 19 = 0 THEN 'S3 object ETag cannot be empty' END AS validation_error FROM objects",
)
def q_validate_objects(spark, sf_dir):
    o = fx.objects(spark, sf_dir)
    o = o.withColumn("etag", F.when(F.col("doc_id") % 19 == 0, F.lit("")).otherwise(F.col("etag")))
    return objects.validate_objects(o).select("key", "validation_error")


@query(
    "object_totals",
    O.with_(O.OBJECTS) + "SELECT count(*) AS object_count, CAST(coalesce(sum(size), 0) AS BIGINT) AS total_bytes FROM objects WHERE lower(key) LIKE '%.gz'",
)
def q_object_totals(spark, sf_dir):
    return objects.object_totals(objects.filter_objects(fx.objects(spark, sf_dir), [".gz"]))


def _current(spark, sf_dir):
    return ledger.ledger_apply(fx.ledger_events(spark, sf_dir))


@query("ledger_apply", O.with_(O.OBJECTS) + "SELECT key, etag, size, status, error_msg FROM cur")
def q_ledger_apply(spark, sf_dir):
    return _current(spark, sf_dir).select("key", "etag", "size", "status", "error_msg")


@query(
    "pending_files",
    O.with_(O.OBJECTS) + "SELECT key, etag FROM objects o WHERE NOT EXISTS (SELECT 1 FROM cur WHERE cur.key = o.key AND cur.etag = o.etag AND cur.status = 'processed')",
)
def q_pending_files(spark, sf_dir):
    return ledger.pending_files(fx.objects(spark, sf_dir), _current(spark, sf_dir)).select("key", "etag")


@query(
    "ledger_counts",
    O.with_(O.OBJECTS) + "SELECT count(*) FILTER (WHERE status = 'processed') AS processed_files, count(*) FILTER (WHERE status = 'failed') AS failed_files FROM cur",
)
def q_ledger_counts(spark, sf_dir):
    return ledger.ledger_counts(_current(spark, sf_dir))


@query(
    "verify_integrity",
    O.with_(O.OBJECTS)
    + """SELECT o.key, o.size, o.etag, f.actual_size,
  CASE WHEN f.actual_size IS NULL THEN 'failed to stat file'
       WHEN f.actual_size <> o.size THEN 'size mismatch: expected ' || CAST(o.size AS VARCHAR) || ', got ' || CAST(f.actual_size AS VARCHAR)
       WHEN NOT contains(o.etag, '-') AND trim(o.etag, '"') <> f.actual_md5 THEN 'MD5 mismatch: expected ' || trim(o.etag, '"') || ', got ' || f.actual_md5 END AS integrity_error
FROM objects o LEFT JOIN (SELECT key, CAST(octet_length(encode(text)) AS BIGINT) AS actual_size, md5(text) AS actual_md5 FROM objects WHERE doc_id % 23 <> 0) f ON f.key = o.key""",
)
def q_verify_integrity(spark, sf_dir):
    o = fx.objects(spark, sf_dir)
    files = o.filter(F.col("doc_id") % 23 != 0).select("key", F.octet_length("text").cast("long").alias("actual_size"), F.md5("text").alias("actual_md5"))
    return objects.verify_integrity(o.select("key", "size", "etag"), files).select("key", "size", "etag", "actual_size", "integrity_error")


@query(
    "bucket_stats",
    O.with_(O.OBJECTS, O.FETCH)
    + """, pend AS (SELECT key FROM objects o WHERE NOT EXISTS (SELECT 1 FROM cur WHERE cur.key = o.key AND cur.etag = o.etag AND cur.status = 'processed')),
cc AS (SELECT cur.* FROM cur JOIN objects o ON o.key = cur.key AND o.etag = cur.etag),
a AS (SELECT (SELECT count(*) FROM objects) AS total_files, (SELECT count(*) FROM pend) AS pending,
  (SELECT count(*) FROM cc WHERE status = 'processed') AS processed_files, (SELECT count(*) FROM cc WHERE status = 'failed') AS failed_files,
  (SELECT coalesce(sum(size), 0) FROM cc WHERE status = 'processed') AS pbytes,
  (SELECT coalesce(sum(bytes), 0) FROM flog) AS dbytes, (SELECT coalesce(sum(duration_ms), 0) FROM flog) AS dms)
SELECT total_files, processed_files, failed_files, total_files - pending AS skipped_files,
  CAST(CASE WHEN processed_files > 0 THEN pbytes // processed_files ELSE 0 END AS BIGINT) AS avg_file_size,
  round(CASE WHEN dms > 0 THEN dbytes / 1048576.0 / (dms / 1000.0) ELSE 0 END, 6) AS throughput_mbps,
  round(CASE WHEN total_files = 0 THEN 0 ELSE 100.0 * processed_files / total_files END, 6) AS success_rate,
  round(CASE WHEN total_files = 0 THEN 0 ELSE 100.0 * failed_files / total_files END, 6) AS failure_rate FROM a""",
)
def q_bucket_stats(spark, sf_dir):
    o = fx.objects(spark, sf_dir)
    cur = _current(spark, sf_dir)
    return stats.bucket_stats(o, ledger.pending_files(o, cur), cur, fx.fetch_log(spark, sf_dir))


@query(
    "download_stats",
    O.with_(O.FETCH)
    + """SELECT count(*) AS total_downloads, count(*) FILTER (WHERE success) AS successful_downloads, count(*) FILTER (WHERE NOT success) AS failed_downloads,
  CAST(coalesce(sum(bytes), 0) AS BIGINT) AS total_bytes, CAST(coalesce(sum(retries), 0) AS BIGINT) AS retry_count,
  round(coalesce(sum(duration_ms), 0), 3) AS total_duration_ms,
  round(CASE WHEN sum(duration_ms) > 0 THEN sum(bytes) / 1048576.0 / (sum(duration_ms) / 1000.0) ELSE 0 END, 6) AS avg_speed_mbps,
  round(coalesce(sum(bytes), 0) / 1048576.0, 6) AS total_size_mb,
  round(CASE WHEN count(*) = 0 THEN 0 ELSE sum(retries) / count(*) END, 6) AS avg_retries,
  round(CASE WHEN count(*) = 0 THEN 0 ELSE sum(duration_ms) / count(*) END, 3) AS avg_duration_ms,
  round(CASE WHEN count(*) = 0 THEN 0 ELSE 100.0 * count(*) FILTER (WHERE success) / count(*) END, 6) AS success_rate,
  round(CASE WHEN count(*) = 0 THEN 0 ELSE 100.0 * count(*) FILTER (WHERE NOT success) / count(*) END, 6) AS failure_rate FROM flog""",
)
def q_download_stats(spark, sf_dir):
    return stats.download_stats(fx.fetch_log(spark, sf_dir))


_PLAN = f""", ok AS (SELECT key, max(event_ts) AS done FROM ledger WHERE status = 'processed' GROUP BY key),
att AS (SELECT l.key, count(*) AS attempt FROM ledger l LEFT JOIN ok USING (key) WHERE status = 'failed' AND (done IS NULL OR l.event_ts > done) GROUP BY l.key),
f AS (SELECT cur.*, CAST(att.attempt AS INTEGER) AS attempt, {O.classify_s3_sql('lower(error_msg)', "'download'")} AS error_type FROM cur JOIN att USING (key) WHERE status = 'failed'),
plan AS (
  SELECT key, etag, error_msg, error_type, attempt, {O.retryable_sql('lower(error_msg)', 'error_type')} AS retryable,
    {O.action_sql('lower(error_msg)', "'download'", "'download'", 'attempt')} AS action,
    {O.delay_sql('attempt', 'error_type')} AS delay_s,
    event_ts + to_microseconds(CAST(round(1000000 * ({O.delay_sql('attempt', 'error_type')})) AS BIGINT)) AS next_attempt_ts FROM f)
"""


@query("plan_retries", O.with_(O.OBJECTS) + _PLAN + "SELECT * FROM plan")
def q_plan_retries(spark, sf_dir):
    return ledger.plan_retries(fx.ledger_events(spark, sf_dir))


def _recover_docs(spark, sf_dir):
    """Legacy JSON ledger documents derived from the D3 ledger: one per (source, doc_id div 10)."""
    ev = fx.ledger_events(spark, sf_dir).withColumn("grp", F.concat(F.split("key", "/")[0], F.lit("-"), F.floor(F.regexp_extract("key", r"/(\d+)\.", 1).cast("long") / 10).cast("string")))
    entry = F.struct("key", "etag", "size", F.date_format("event_ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("processed_at"), "error_msg")
    g = ev.groupBy("grp").agg(
        F.map_from_entries(F.collect_list(F.when(F.col("status") == "processed", F.struct("key", entry)))).alias("processed_files"),
        F.map_from_entries(F.collect_list(F.when(F.col("status") == "failed", F.struct("key", entry)))).alias("failed_files"),
    )
    return g.select(F.to_json(F.struct("processed_files", "failed_files", F.lit("1.0").alias("version"))).alias("value"))


@query("ledger_recover", O.with_(O.OBJECTS) + "SELECT key, etag, CAST(size AS BIGINT) AS size, event_ts, status, error_msg FROM ledger")
def q_ledger_recover(spark, sf_dir):
    return ledger.ledger_recover(_recover_docs(spark, sf_dir)).select("key", "etag", "size", "event_ts", "status", "error_msg")


# ---- errors ------------------------------------------------------------------------------------


def _errs(spark, sf_dir):
    return fx.errors(spark, sf_dir)


@query("classify_error", O.with_(O.ERRORS) + f"SELECT sequence, {O.ETYPE} AS error_type FROM errs")
def q_classify_error(spark, sf_dir):
    return _errs(spark, sf_dir).select("sequence", E.classify_error("message", "context").alias("error_type"))


@query("classify_s3_error", O.with_(O.ERRORS) + f"SELECT sequence, {O.classify_s3_sql(O.EL, O.EX)} AS s3_type FROM errs")
def q_classify_s3_error(spark, sf_dir):
    return _errs(spark, sf_dir).select("sequence", E.classify_s3_error(F.col("message"), F.col("context")).alias("s3_type"))


@query(
    "should_retry",
    O.with_(O.ERRORS)
    + f"SELECT sequence, {O._map_sql(O.ETYPE, O.E.MAX_RETRIES, 1)} AS max_retries, attempt < {O._map_sql(O.ETYPE, O.E.MAX_RETRIES, 1)} AS should_retry FROM errs",
)
def q_should_retry(spark, sf_dir):
    e = _errs(spark, sf_dir)
    t = E.classify_error(F.col("message"), F.col("context"))
    return e.select("sequence", E.max_retries(t).alias("max_retries"), E.should_retry(F.col("message"), F.col("context"), F.col("attempt")).alias("should_retry"))


@query("recovery_action", O.with_(O.ERRORS) + f"SELECT sequence, {O._map_sql(O.ETYPE, O.E.RECOVERY, 'SKIP')} AS action FROM errs")
def q_recovery_action(spark, sf_dir):
    return _errs(spark, sf_dir).select("sequence", E.recovery_action(E.classify_error(F.col("message"), F.col("context"))).alias("action"))


@query("is_retryable", O.with_(O.ERRORS) + f"SELECT sequence, {O.retryable_sql(O.EL, O.classify_s3_sql(O.EL, O.EX))} AS retryable FROM errs")
def q_is_retryable(spark, sf_dir):
    e = _errs(spark, sf_dir)
    return e.select("sequence", E.is_retryable(F.col("message"), E.classify_s3_error(F.col("message"), F.col("context"))).alias("retryable"))


@query("error_flags", O.with_(O.ERRORS) + f"SELECT sequence, {O._any(O.EL, O.E.RATE_LIMIT)} AS rate_limit, {O._any(O.EL, O.E.AUTH)} AS auth_error FROM errs")
def q_error_flags(spark, sf_dir):
    e = _errs(spark, sf_dir)
    return e.select("sequence", E.is_rate_limit(F.col("message")).alias("rate_limit"), E.is_auth_error(F.col("message")).alias("auth_error"))


@query("error_action", O.with_(O.ERRORS) + f"SELECT sequence, {O.action_sql(O.EL, O.EX, 'kind', 'attempt')} AS action FROM errs")
def q_error_action(spark, sf_dir):
    e = _errs(spark, sf_dir)
    return errlog.error_actions(e).select("sequence", "action")


@query("retry_delay", O.with_(O.ERRORS) + f"SELECT sequence, round({O.delay_sql('attempt', O.classify_s3_sql(O.EL, O.EX))}, 6) AS delay_s FROM errs")
def q_retry_delay(spark, sf_dir):
    e = _errs(spark, sf_dir)
    return e.select("sequence", F.round(E.retry_delay(F.col("attempt"), E.classify_s3_error(F.col("message"), F.col("context"))), 6).alias("delay_s"))


@query("backoff", O.with_(O.ERRORS) + "SELECT sequence, least(pow(2.0, attempt), 60.0) AS download_backoff_s, CAST(attempt * 2 AS DOUBLE) AS fetch_backoff_s FROM errs")
def q_backoff(spark, sf_dir):
    e = _errs(spark, sf_dir)
    return e.select("sequence", E.download_backoff(F.col("attempt")).alias("download_backoff_s"), E.fetch_backoff(F.col("attempt")).alias("fetch_backoff_s"))


@query("download_retryable", O.with_(O.ERRORS) + f"SELECT sequence, {O._any(O.EL, O.E.DOWNLOAD_RETRYABLE)} AS retryable FROM errs")
def q_download_retryable(spark, sf_dir):
    return _errs(spark, sf_dir).select("sequence", E.download_retryable(F.col("message")).alias("retryable"))


@query("error_hint", O.with_(O.ERRORS) + f"SELECT sequence, {O.hint_sql(O.EL, O.classify_s3_sql(O.EL, O.EX), 'message')} AS hint FROM errs")
def q_error_hint(spark, sf_dir):
    e = _errs(spark, sf_dir)
    return e.select("sequence", E.error_hint(F.col("message"), E.classify_s3_error(F.col("message"), F.col("context"))).alias("hint"))


@query("error_text", O.with_(O.ERRORS) + f"SELECT sequence, '[' || {O.ETYPE} || '] seq:' || CAST(sequence AS VARCHAR) || ' ' || context || ': ' || message AS text FROM errs")
def q_error_text(spark, sf_dir):
    e = _errs(spark, sf_dir)
    return e.select("sequence", E.error_text(E.classify_error(F.col("message"), F.col("context")), F.col("sequence"), F.col("context"), F.col("message")).alias("text"))


@query("error_summary", O.with_(O.ERRORS) + f"SELECT error_type, count(*) AS errors FROM (SELECT {O.ETYPE} AS error_type FROM errs) GROUP BY ROLLUP (error_type)")
def q_error_summary(spark, sf_dir):
    return errlog.error_summary(_errs(spark, sf_dir))


@query("recent_errors", O.with_(O.ERRORS) + "SELECT sequence, ts, message FROM errs ORDER BY ts DESC, sequence DESC LIMIT 100")
def q_recent_errors(spark, sf_dir):
    return errlog.recent_errors(_errs(spark, sf_dir)).select("sequence", "ts", "message")


@query(
    "sample_errors",
    O.with_(O.ERRORS)
    + f"""SELECT sequence, error_type, type_count,
  CASE error_type WHEN 'PARSING' THEN type_count <= 10 OR type_count % 100 = 0 WHEN 'PROCESSING' THEN type_count <= 5 OR type_count % 50 = 0 ELSE true END AS logged,
  CASE WHEN error_type IN ('FILE', 'OUTPUT') THEN 'ERROR' WHEN error_type IN ('MEMORY', 'NETWORK') THEN 'CRITICAL' WHEN error_type IN ('PARSING', 'PROCESSING') THEN 'WARNING' ELSE 'ERROR' END AS level
FROM (SELECT sequence, error_type, row_number() OVER (PARTITION BY error_type ORDER BY ts, sequence) AS type_count FROM (SELECT *, {O.ETYPE} AS error_type FROM errs))""",
)
def q_sample_errors(spark, sf_dir):
    return errlog.sample_errors(_errs(spark, sf_dir)).select("sequence", "error_type", "type_count", "logged", "level")


@query(
    "error_budget",
    O.with_(O.ERRORS)
    + "SELECT source_file, sequence AS stop_sequence, ts AS stop_ts, n AS errors_at_stop FROM (SELECT *, row_number() OVER (PARTITION BY source_file ORDER BY ts, sequence) AS n FROM errs) WHERE n = 100",
)
def q_error_budget(spark, sf_dir):
    return errlog.error_budget(_errs(spark, sf_dir), max_errors=100)


# ---- ordering ------------------------------------------------------------------------------------

_ORD = "kept AS (SELECT c_custkey AS i FROM customer WHERE NOT (c_custkey > 1000 AND c_custkey % 97 = 96 OR c_custkey BETWEEN 1200 AND 1220))"


def _kept(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("log_index"))
    k = F.col("log_index")
    return c.filter(~(((k > 1000) & (k % 97 == 96)) | k.between(1200, 1220)))


@query(
    "contiguous_prefix",
    O.with_(_ORD)
    + """, nx AS (SELECT min(m) AS next_index FROM (SELECT i + 1 AS m FROM kept WHERE i + 1 NOT IN (SELECT i FROM kept) UNION ALL SELECT 0 WHERE 0 NOT IN (SELECT i FROM kept)))
SELECT CAST(0 AS BIGINT) AS start, CASE WHEN next_index > 0 THEN next_index - 1 END AS committed_through, next_index AS committed_entries, next_index FROM nx""",
)
def q_contiguous_prefix(spark, sf_dir):
    return ordering.contiguous_prefix(_kept(spark, sf_dir), start=0, batch_size=64)


@query(
    "next_index",
    O.with_(_ORD) + "SELECT min(m) AS next_index FROM (SELECT i + 1 AS m FROM kept WHERE i + 1 NOT IN (SELECT i FROM kept) UNION ALL SELECT 0 WHERE 0 NOT IN (SELECT i FROM kept))",
)
def q_next_index(spark, sf_dir):
    return ordering.next_index(_kept(spark, sf_dir))


@query(
    "saved_index",
    O.with_(_ORD)
    + """, nx AS (SELECT min(m) AS n FROM (SELECT i + 1 AS m FROM kept WHERE i + 1 NOT IN (SELECT i FROM kept) UNION ALL SELECT 0 WHERE 0 NOT IN (SELECT i FROM kept)))
SELECT CAST(0 AS BIGINT) AS before, least(n, 501) AS early, n AS reached, n AS reloaded FROM nx""",
)
def q_saved_index(spark, sf_dir):
    """The checkpoint of an ingest, moved on twice and read again."""
    import uuid

    from ..streaming.checkpoint import commit_progress, load_index

    path = fx.fixture_path(spark, sf_dir, f"state_{uuid.uuid4().hex}/state")
    have = _kept(spark, sf_dir)
    before = load_index(spark, path)
    early = commit_progress(spark, have.where("log_index <= 500"), path)
    reached = commit_progress(spark, have, path)
    return spark.createDataFrame([(before, early, reached, load_index(spark, path))], "before long, early long, reached long, reloaded long")


@query(
    "gap_report",
    O.with_(_ORD)
    + """, g AS (SELECT i + 1 AS gap_start, lead(i) OVER (ORDER BY i) - 1 AS gap_end FROM kept)
SELECT gap_start, gap_end, gap_end - gap_start + 1 AS missing, (SELECT count(*) FROM kept WHERE i > g.gap_end) AS entries_behind
FROM g WHERE gap_end >= gap_start
UNION ALL SELECT 0, min(i) - 1, min(i), count(*) FROM kept HAVING min(i) > 0""",
)
def q_gap_report(spark, sf_dir):
    return ordering.gap_report(_kept(spark, sf_dir), start=0, batch_size=64)


@query(
    "assign_batches",
    "SELECT event_id - event_id % 1000 AS batch_start, count(DISTINCT event_id) AS entries, min(event_id) AS min_index, max(event_id) AS max_index, count(DISTINCT event_id) = 1000 AS complete FROM events GROUP BY 1",
)
def q_assign_batches(spark, sf_dir):
    return ordering.batch_summary(read_table(spark, sf_dir, "events"), "event_id", 1000)


@query("plan_ranges", "SELECT s AS start, least(s + 63, (SELECT count(*) FROM customer) - 1) AS \"end\" FROM generate_series(0, (SELECT count(*) FROM customer) - 1, 64) t(s)")
def q_plan_ranges(spark, sf_dir):
    tree = read_table(spark, sf_dir, "customer").count()  # tree head: a scalar, as the head poll reads it
    return ordering.plan_ranges(spark, 0, tree, 64)


@query("dedupe_index", "SELECT DISTINCT 'log0' AS log, c_custkey AS log_index FROM customer")
def q_dedupe_index(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer").select(F.lit("log0").alias("log"), F.col("c_custkey").alias("log_index"))
    replays = c.filter(F.col("log_index") % 5 == 0)
    return ordering.dedupe_index(c.unionByName(replays)).select("log", "log_index")


# ---- monitoring ------------------------------------------------------------------------------------


@query(
    "endpoint_latency",
    O.with_(O.FETCH)
    + """SELECT endpoint, round(avg(d), 3) AS mean_ms, round(quantile_disc(d, 0.95), 3) AS p95_ms, round(quantile_disc(d, 0.99), 3) AS p99_ms,
  round(max(d), 3) AS max_ms, CAST(coalesce(sum(CASE WHEN success THEN entries END), 0) AS BIGINT) AS entries_downloaded, count(d) AS recorded_calls
FROM (SELECT *, CASE WHEN duration_ms > 0 THEN duration_ms END AS d FROM flog) GROUP BY endpoint""",
)
def q_endpoint_latency(spark, sf_dir):
    return monitor.endpoint_latency(fx.fetch_log(spark, sf_dir), exact=True)


_SAMPLES_SQL = O.FETCH.strip() + """,
samples AS (SELECT endpoint, ts, event_id, count(*) OVER (PARTITION BY endpoint ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS value FROM flog),
gsamples AS (SELECT ts, event_id, count(*) OVER (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS value FROM events)"""

_CODE = "greatest(length(bin(v)) - 11, 0)"


@query(
    "endpoint_latency_histogram",
    O.with_(O.FETCH)
    + f""", v AS (SELECT endpoint, duration_ms, CAST(round(duration_ms * 1e6) AS BIGINT) AS v FROM flog WHERE duration_ms > 0),
m AS (SELECT endpoint, duration_ms, (((v >> {_CODE}) << {_CODE}) + ((1::BIGINT << {_CODE}) - 1) / 2.0) / 1e6 AS ms FROM v)
SELECT endpoint, round(avg(ms), 3) AS mean_ms, round(quantile_disc(ms, 0.95), 3) AS p95_ms, round(quantile_disc(ms, 0.99), 3) AS p99_ms, round(max(ms), 3) AS max_ms, count(*) AS recorded_calls,
  abs(quantile_disc(ms, 0.95) / quantile_disc(duration_ms, 0.95) - 1) <= 0.001 AND abs(quantile_disc(ms, 0.99) / quantile_disc(duration_ms, 0.99) - 1) <= 0.001 AS within_a_thousandth
FROM m GROUP BY endpoint""",
)
def q_endpoint_latency_histogram(spark, sf_dir):
    """A5 by histograms of a day each, merged; beside the exact percentiles."""
    log = fx.fetch_log(spark, sf_dir)
    days = monitor.latency_histogram(log, slot_s=86_400)
    h = monitor.histogram_latency(monitor.merge_histograms(days.where("slot % 2 = 0"), days.where("slot % 2 <> 0")))
    exact = monitor.endpoint_latency(log, exact=True).select("endpoint", F.col("p95_ms").alias("x95"), F.col("p99_ms").alias("x99"))
    near = lambda a, b: F.abs(F.col(a) / F.col(b) - 1) <= 0.0011  # noqa: E731  both are rounded to microseconds
    return h.join(exact, "endpoint").withColumn("within_a_thousandth", near("p95_ms", "x95") & near("p99_ms", "x99")).drop("x95", "x99")


_WINDOWS = """, o AS (SELECT *, unnest(range(24)) AS back FROM samples),
b AS (SELECT endpoint, ts, event_id, value, time_bucket(INTERVAL 1 HOUR, ts, TIMESTAMP '1970-01-01') + (back + 1) * INTERVAL 1 HOUR AS window_end FROM o),
g AS (SELECT endpoint, window_end, count(*) AS samples, min(ts) AS t0, max(ts) AS t1, min(value) AS v0, max(value) AS v1 FROM b GROUP BY ALL)
SELECT endpoint, window_end, samples, round(CASE WHEN samples < 2 OR (epoch_us(t1) - epoch_us(t0)) / 1e6 < 1 THEN 0.0 ELSE (v1 - v0) / ((epoch_us(t1) - epoch_us(t0)) / 1e6) * 60 END, 6) AS rate FROM g"""


@query("stream_rate", "WITH " + _SAMPLES_SQL + _WINDOWS)
def q_stream_rate(spark, sf_dir):
    """W6 as a stream: rates of the last day at every hour, by endpoint, over samples that arrive in several triggers."""
    import uuid

    from ..streaming.rates import current_rates, start_rate_stream

    base = fx.fixture_path(spark, sf_dir, f"rates_{uuid.uuid4().hex}")
    s = fx.samples(spark, sf_dir).select("endpoint", "ts", "value")
    # small row groups, so that a file of any size is read by many tasks
    s.repartition(4).write.option("parquet.block.size", 4 << 20).parquet(f"{base}/in")
    stream = spark.readStream.schema(s.schema).option("maxFilesPerTrigger", "2").parquet(f"{base}/in")
    start_rate_stream(stream, f"{base}/out", f"{base}/ckpt", window_s=86_400, slide_s=3600, part=("endpoint",), watermark="3650 days", per_minute=True).awaitTermination()
    return current_rates(spark, f"{base}/out", ("endpoint",))


@query(
    "endpoint_health",
    O.with_(O.FETCH)
    + """, x AS (SELECT *, sum(CASE WHEN success THEN 1 ELSE 0 END) OVER (PARTITION BY endpoint ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS isl FROM flog)
SELECT endpoint, event_id, CAST(CASE WHEN success THEN 0 ELSE row_number() OVER (PARTITION BY endpoint, isl ORDER BY ts, event_id) - CASE WHEN isl > 0 THEN 1 ELSE 0 END END AS BIGINT) AS consecutive_failures,
  (CASE WHEN success THEN 0 ELSE row_number() OVER (PARTITION BY endpoint, isl ORDER BY ts, event_id) - CASE WHEN isl > 0 THEN 1 ELSE 0 END END) < 5 AS healthy FROM x""",
)
def q_endpoint_health(spark, sf_dir):
    return monitor.endpoint_health(fx.fetch_log(spark, sf_dir)).select("endpoint", "event_id", "consecutive_failures", "healthy")


_RATE = """(CASE WHEN count(*) OVER w < 2 OR (epoch_us(ts) - epoch_us(min(ts) OVER w)) / 1e6 < 1 THEN 0.0
  ELSE (value - arg_min(value, ts) OVER w) / ((epoch_us(ts) - epoch_us(min(ts) OVER w)) / 1e6) END)"""


def _global_samples(spark, sf_dir):
    return fx.global_samples(spark, sf_dir)


@query(
    "rolling_rate",
    "WITH " + _SAMPLES_SQL + f"\nSELECT event_id, value, round({_RATE}, 6) AS rate FROM gsamples WINDOW w AS (ORDER BY ts RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW)",
)
def q_rolling_rate(spark, sf_dir):
    return monitor.rolling_rate(_global_samples(spark, sf_dir), window_s=3600).select("event_id", "value", "rate")


@query(
    "endpoint_rate",
    "WITH " + _SAMPLES_SQL + f"\nSELECT endpoint, event_id, value, round({_RATE} * 60, 6) AS rate FROM samples WINDOW w AS (PARTITION BY endpoint ORDER BY ts RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW)",
)
def q_endpoint_rate(spark, sf_dir):
    return monitor.endpoint_rate(fx.samples(spark, sf_dir), window_s=3600).select("endpoint", "event_id", "value", "rate")


@query(
    "progress_eta",
    "WITH "
    + _SAMPLES_SQL
    + f""", r AS (SELECT event_id, value, round({_RATE}, 6) AS rate FROM gsamples WINDOW w AS (ORDER BY ts RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW)),
t AS (SELECT count(*) AS total FROM events)
SELECT event_id, round(100.0 * value / total, 6) AS percent, CASE WHEN rate < 1 OR total <= value THEN NULL ELSE CAST(floor((total - value) / rate) AS BIGINT) END AS eta_s FROM r, t""",
)
def q_progress_eta(spark, sf_dir):
    r = monitor.rolling_rate(_global_samples(spark, sf_dir), window_s=3600)
    total = read_table(spark, sf_dir, "events").count()  # the tree head: one scalar
    return monitor.progress_eta(r, total).select("event_id", "percent", "eta_s")


@query(
    "transfer_rate",
    O.with_(O.FETCH)
    + """, s AS (SELECT endpoint AS key, ts, event_id, CAST(sum(bytes) OVER (PARTITION BY endpoint ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS bytes_done FROM flog),
r AS (SELECT *, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER w) > 0 THEN (bytes_done - lag(bytes_done) OVER w) / 1048576.0 / ((epoch_us(ts) - epoch_us(lag(ts) OVER w)) / 1e6) END AS raw,
  row_number() OVER (PARTITION BY key ORDER BY ts DESC, event_id DESC) = 1 AS completed FROM s WINDOW w AS (PARTITION BY key ORDER BY ts, event_id))
SELECT key, event_id, bytes_done, round(coalesce(last_value(raw IGNORE NULLS) OVER (PARTITION BY key ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING), 0.0), 6) AS rate_mbps, completed FROM r""",
)
def q_transfer_rate(spark, sf_dir):
    f = fx.fetch_log(spark, sf_dir).select(F.col("endpoint").alias("key"), "ts", "event_id", "bytes")
    s = ordering.running_total(f, ["key"], ["ts", "event_id"], F.date_trunc("hour", F.col("ts")), "bytes", "bytes_done")
    return monitor.transfer_rate(s).select("key", "event_id", "bytes_done", "rate_mbps", "completed")


# ---- sinks (write, then read back what was written) ----------------------------------------------


def _sink_path(spark, sf_dir, name):
    return fx.fixture_path(spark, sf_dir, f"sink_{name}")


@query("sink_text", O.with_(O.CERTS) + "SELECT name || ' -> ' || organization || ' (' || source || ') [seq:' || CAST(sequence_number AS VARCHAR) || ']' AS value FROM mappings")
def q_sink_text(spark, sf_dir):
    from ..sinks.writers import write_text

    path = _sink_path(spark, sf_dir, "text")
    write_text(_extract(spark, sf_dir)[0], path)
    return spark.read.text(path)


@query(
    "sink_csv",
    O.with_(O.CERTS) + 'SELECT name AS "Name", organization AS "Organization", source AS "Source", CAST(sequence_number AS VARCHAR) AS "SequenceNumber" FROM mappings',
)
def q_sink_csv(spark, sf_dir):
    from ..sinks.writers import write_csv

    path = _sink_path(spark, sf_dir, "csv")
    write_csv(_extract(spark, sf_dir)[0], path)
    return spark.read.option("header", "true").option("escape", '"').option("inferSchema", "false").csv(path)


@query(
    "sink_jsonl",
    O.with_(O.CERTS) + "SELECT domain, name, organization, NULLIF(organizational_unit, '') AS organizational_unit, source, sequence_number FROM mappings",
)
def q_sink_jsonl(spark, sf_dir):
    from ..sinks.writers import write_jsonl

    path = _sink_path(spark, sf_dir, "jsonl")
    write_jsonl(_extract(spark, sf_dir)[0], path)
    return spark.read.schema("domain string, name string, organization string, organizational_unit string, source string, sequence_number long").json(path)


@query("sink_batches", O.with_(O.DER) + "SELECT k AS log_index, k - k % 100 AS batch_start, k::VARCHAR || ' ' || base64(from_hex(cert)) AS line FROM entries WHERE cls <> 7")
def q_sink_batches(spark, sf_dir):
    from ..sinks.writers import write_batches
    from ..sources.batch_files import parse_lines, read_batch_lines

    path = _sink_path(spark, sf_dir, "batches")
    d = decode_leaf(fx.ct_entries(spark, sf_dir)).filter(F.col("error").isNull())
    write_batches(d, path, batch_size=100, mode="overwrite")
    back = parse_lines(read_batch_lines(spark, path, recursive=True))
    return back.select(F.col("sequence_number").alias("log_index"), F.regexp_extract("file", r"batch_start=(\d+)", 1).cast("long").alias("batch_start"), F.col("value").alias("line"))


# ---- CT log source and streaming ingest -------------------------------------------------------


#: The most triggers that a log is read in: each costs some seconds, whatever it reads.
TRIGGERS = 25


def _per_trigger(spark, sf_dir, least):
    """Pages a trigger: ``least``, and more where a log of many pages would take more than ``TRIGGERS``."""
    return max(least, -(-fx.ct_pages(spark, sf_dir).count() // TRIGGERS))


def _log_dir(spark, sf_dir):
    from ..streaming.ct_source import write_log_dir

    path = fx.fixture_path(spark, sf_dir, "ct_log_dir")
    if path not in _WRITTEN:
        write_log_dir(fx.ct_pages(spark, sf_dir), path)
        _WRITTEN.add(path)
    return path


@query(
    "ct_source_batch",
    """SELECT c_custkey AS log_index, 1700000000000 + c_custkey * 1000 AS timestamp_ms,
  CAST(CASE c_custkey % 12 WHEN 6 THEN 1 WHEN 7 THEN 2 ELSE 0 END AS BIGINT) AS entry_type, CAST(NULL AS VARCHAR) AS page_error FROM customer""",
)
def q_ct_source_batch(spark, sf_dir):
    """Every entry of the log folder, with what its leaf bytes say."""
    from ..streaming.ct_source import read_log

    d = decode_leaf(read_log(spark, _log_dir(spark, sf_dir), keep_errors=True))
    return d.select("log_index", "timestamp_ms", "entry_type", "page_error")


@query(
    "stream_ingest",
    O.with_(O.DER)
    + """SELECT 'log0' AS log, k AS log_index, 1700000000000 + k * 1000 AS timestamp_ms, CASE WHEN cls <> 7 THEN k::VARCHAR || ' ' || base64(from_hex(cert)) END AS line,
  CASE WHEN cls = 7 THEN 'unsupported log entry type' END AS error FROM entries""",
)
def q_stream_ingest(spark, sf_dir):
    import uuid

    from ..streaming.ingest import start_ingest

    base = fx.fixture_path(spark, sf_dir, f"stream_{uuid.uuid4().hex}")
    start_ingest(spark, _log_dir(spark, sf_dir), f"{base}/out", f"{base}/ckpt").awaitTermination()
    out = spark.read.parquet(f"{base}/out")
    return out.select("log", "log_index", "timestamp_ms", "line", "error")


@query(
    "stream_dedupe",
    O.with_(O.DER) + "SELECT k AS log_index, CASE WHEN cls <> 7 THEN sha256(k::VARCHAR || ' ' || base64(from_hex(cert))) END AS line_sha256, CAST(1 AS BIGINT) AS times FROM entries",
)
def q_stream_dedupe(spark, sf_dir):
    """T4 as a stream: a log whose pages are all served again later, read a part of them a trigger and restarted between.

    Replays reach back over the whole log, and its pages come in no order: the delay covers its entries' time, 30 days at least.
    """
    import uuid

    from ..streaming.ct_source import write_log_dir
    from ..streaming.ingest import start_ingest

    base = fx.fixture_path(spark, sf_dir, f"replay_{uuid.uuid4().hex}")
    span = decode_leaf(fx.ct_entries(spark, sf_dir)).agg(F.max("timestamp_ms") - F.min("timestamp_ms")).first()[0] or 0
    delay = f"{max(30, span // 86_400_000 + 2)} days"
    each = _per_trigger(spark, sf_dir, 40)
    for _ in range(2):
        write_log_dir(fx.ct_pages(spark, sf_dir).repartition(4), f"{base}/log", mode="append")
        start_ingest(spark, f"{base}/log", f"{base}/out", f"{base}/ckpt", max_files_per_trigger=each, dedupe=delay).awaitTermination()
    out = spark.read.parquet(f"{base}/out")
    return out.groupBy("log_index").agg(F.sha2(F.max("line"), 256).alias("line_sha256"), F.count(F.lit(1)).alias("times"))


@query("tree_head", "SELECT c_custkey AS log_index, (SELECT max(c_custkey) - max(c_custkey) % 3 - 50 FROM customer) AS tree_size FROM customer WHERE c_custkey < (SELECT max(c_custkey) - max(c_custkey) % 3 - 50 FROM customer)")
def q_tree_head(spark, sf_dir):
    """The log read up to its tree head, which a smaller one told later does not move back."""
    import uuid

    from ..streaming.ct_source import read_log, tree_head, write_log_dir, write_tree_head

    path = fx.fixture_path(spark, sf_dir, f"headed_{uuid.uuid4().hex}")
    write_log_dir(fx.ct_pages(spark, sf_dir), path)
    last = read_table(spark, sf_dir, "customer").agg(F.max("c_custkey")).first()[0]
    top = last - last % 3 - 50
    for size, at in ((10, 1), (top, 2), (top - 7, 3)):
        write_tree_head(spark, path, size, at)
    head = tree_head(spark, path)
    return read_log(spark, path, tree_size=head).select("log_index", F.lit(head).cast("long").alias("tree_size"))


# ---- incremental bucket job and listing ---------------------------------------------------------


def _ct_batch_files(spark, sf_dir):
    """D1 lines written as ten gzip batch files (file = sequence % 10)."""
    return _batch_files(spark, sf_dir, fx.fixture_path(spark, sf_dir, "ct_batch_files"))


def _bucket_files(spark, sf_dir):
    """The same with odd files beside them."""
    path = fx.fixture_path(spark, sf_dir, "ct_bucket")
    if path not in _WRITTEN:
        _batch_files(spark, sf_dir, path)
        _put_files(spark, _odd_files(spark, path))
    return path


def _batch_files(spark, sf_dir, path):
    if path not in _WRITTEN:
        lines = fx.ct_lines(spark, sf_dir)
        df = lines.select(
            F.concat(F.lit("ct-"), (F.col("sequence_number") % 10).cast("string"), F.lit(".gz")).alias("file"),
            F.col("sequence_number"),
            F.concat(F.col("sequence_number").cast("string"), F.lit(" "), F.col("certificate_data")).alias("line"),
        )
        write_batch_fixture(df, path, order_col="sequence_number")
        _WRITTEN.add(path)
    return path


@query(
    "list_objects",
    """SELECT DISTINCT 'f' || CAST(c_custkey % 10 AS VARCHAR) || '/part ' || CAST(c_custkey % 100 AS VARCHAR) || '+%.txt' AS rel_key,
  CAST(sum(length(c_name) + 1) OVER (PARTITION BY c_custkey % 100) AS BIGINT) AS size FROM customer
UNION ALL SELECT 'f0/zero.txt', 0""",
)
def q_list_objects(spark, sf_dir):
    """A tree of files, listed by tasks: names as they are, sizes in bytes, empty files too."""
    o = objects.list_objects(spark, _object_tree(spark, sf_dir))
    return objects.filter_objects(o, [".TXT"]).select("rel_key", "size")


def _object_tree(spark, sf_dir):
    """A folder per last digit with a file per last two digits of customers, holding their names, and an empty file."""
    path = fx.fixture_path(spark, sf_dir, "object_tree")
    if path not in _WRITTEN:
        c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name")
        name = F.concat(F.lit(f"{path}/f"), (F.col("c_custkey") % 10).cast("string"), F.lit("/part "), (F.col("c_custkey") % 100).cast("string"), F.lit("+%.txt"))
        per = c.groupBy(name.alias("name")).agg(F.array_join(F.array_sort(F.collect_list(F.concat("c_name", F.lit("\n")))), "").alias("body"))
        per = per.unionByName(spark.createDataFrame([(f"{path}/f0/zero.txt", "")], "name string, body string"))
        _put_files(spark, per)
        _WRITTEN.add(path)
    return path


def _put_files(spark, files):
    """Write (name, body) rows as files of exactly these names; a handful of small fixture files."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for r in files.toLocalIterator():
        p = jvm.org.apache.hadoop.fs.Path(r["name"])
        out = p.getFileSystem(conf).create(p, True)
        out.write(bytearray(r["body"] if isinstance(r["body"], (bytes, bytearray)) else r["body"].encode()))
        out.close()


def _odd_files(spark, src):
    """(name, body): a gzip file cut short, an empty one, one of no bytes, and one of several members, of unparsable but well-formed lines."""
    import gzip

    line = f"{2**40} !\n".encode()
    bodies = {"damaged": gzip.compress(line * 500)[:-11], "empty": gzip.compress(b""), "zero": b"", "members": gzip.compress(line) + gzip.compress(line * 3)}
    return spark.createDataFrame([(f"{src}/odd/{n}.gz", bytearray(b)) for n, b in bodies.items()], "name string, body binary")


_LEDGERS: dict = {}


@query(
    "bucket_ledger",
    """SELECT 'ct-' || CAST(c_custkey % 10 AS VARCHAR) || '.gz' AS file, 'processed' AS status, '' AS error_msg, c_custkey % 10 < 3 AS earlier FROM customer WHERE c_custkey % 12 <> 7 GROUP BY ALL
UNION ALL SELECT unnest(['damaged.gz', 'empty.gz', 'zero.gz', 'members.gz']), unnest(['failed', 'failed', 'failed', 'processed']),
  unnest(['unexpected end of file', 'file is empty or unreadable', 'file is empty or unreadable', '']), false""",
)
def q_bucket_ledger(spark, sf_dir):
    """The ledger after a run of ``process_bucket`` over good files, a damaged one, two empty ones and one of several gzip members."""
    from .bucket_job import read_ledger

    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _LEDGERS:
        q_process_bucket(spark, sf_dir)
    current = ledger.ledger_apply(read_ledger(spark, _LEDGERS[key]))
    file = F.regexp_extract("key", r"(?:file=|odd/)([^/]+)", 1)
    return current.select(file.alias("file"), "status", "error_msg", (F.col("event_ts") == F.lit("2024-01-01 00:00:00").cast("timestamp")).alias("earlier"))


@query(
    "bucket_retries",
    O.with_(O.OBJECTS)
    + _PLAN
    + """, pend AS (SELECT o.key, o.etag FROM objects o WHERE NOT EXISTS (SELECT 1 FROM cur WHERE cur.key = o.key AND cur.etag = o.etag AND cur.status = 'processed')),
t AS (SELECT unnest([TIMESTAMP '2024-01-01 02:00:00', TIMESTAMP '2024-01-01 02:15:00', TIMESTAMP '2025-01-01 00:00:00']) AS now)
SELECT t.now, p.key FROM t, pend p WHERE NOT EXISTS (SELECT 1 FROM plan r WHERE r.key = p.key AND r.etag = p.etag AND (r.action IN ('FAIL', 'SKIP') OR r.next_attempt_ts > t.now))""",
)
def q_bucket_retries(spark, sf_dir):
    """E12 in T7: which pending files a run takes at three times."""
    from datetime import datetime

    from .bucket_job import due_files

    events = fx.ledger_events(spark, sf_dir)
    pending = ledger.pending_files(fx.objects(spark, sf_dir), ledger.ledger_apply(events))
    plan = ledger.plan_retries(events)
    out = None
    for now in (datetime(2024, 1, 1, 2, 0), datetime(2024, 1, 1, 2, 15), datetime(2025, 1, 1)):
        due = due_files(pending, plan, now).select(F.lit(now).cast("timestamp").alias("now"), "key")
        out = due if out is None else out.unionByName(due)
    return out


@query(
    "process_bucket",
    O.with_(O.CERTS) + "SELECT domain, name, organization, organizational_unit, source, sequence_number FROM mappings WHERE sequence_number % 10 >= 3",
)
def q_process_bucket(spark, sf_dir):
    import uuid

    from .bucket_job import listing_with_fingerprint, process_bucket

    src = _bucket_files(spark, sf_dir)
    run = fx.fixture_path(spark, sf_dir, f"bucket_{uuid.uuid4().hex}")
    # an earlier run already processed the files of ct-0, ct-1 and ct-2
    done = listing_with_fingerprint(spark, src).filter(F.col("key").rlike(r"file=ct-[012]\.gz/")).select(
        "key", "etag", "size", F.lit("2024-01-01 00:00:00").cast("timestamp").alias("event_ts"), F.lit(1).alias("seq"),
        F.lit("processed").alias("status"), F.lit("").alias("error_msg"),
    )
    done.write.parquet(f"{run}/ledger")
    process_bucket(spark, src, f"{run}/out", f"{run}/ledger", fmt="jsonl")
    _LEDGERS[(spark.sparkContext.applicationId, sf_dir)] = f"{run}/ledger"
    back = spark.read.schema("domain string, name string, organization string, organizational_unit string, source string, sequence_number long").json(f"{run}/out")
    return back.select("domain", "name", "organization", F.coalesce("organizational_unit", F.lit("")).alias("organizational_unit"), "source", "sequence_number")


@query(
    "processing_stats_by_file",
    """SELECT file, count(*) AS total_processed, count(*) FILTER (WHERE cls NOT IN (8, 9, 11)) AS successful_parsed,
  count(*) FILTER (WHERE cls IN (8, 9, 11)) AS errors,
  round(100.0 * count(*) FILTER (WHERE cls NOT IN (8, 9, 11)) / count(*), 6) AS success_rate,
  round(100.0 * count(*) FILTER (WHERE cls IN (8, 9, 11)) / count(*), 6) AS error_rate
FROM (SELECT 'ct-' || CAST(c_custkey % 10 AS VARCHAR) || '.gz' AS file, c_custkey % 12 AS cls FROM customer WHERE c_custkey % 12 <> 7)
GROUP BY ROLLUP (file)""",
)
def q_processing_stats_by_file(spark, sf_dir):
    from ..shipping import ensure_shipped

    ensure_shipped(spark)
    lines = parse_lines(read_batch_lines(spark, _ct_batch_files(spark, sf_dir), recursive=True))
    lines = lines.withColumn("file", F.regexp_extract("file", r"file=([^/]+)/", 1))
    _m, status = extract(lines.filter(F.col("error").isNull()), default_psl(spark), keep=("file",))
    return stats.processing_stats(status, by=["file"], with_total=True)


@query(
    "sink_json",
    O.with_(O.CERTS) + "SELECT domain, name, organization, NULLIF(organizational_unit, '') AS organizational_unit, source, sequence_number FROM mappings",
)
def q_sink_json(spark, sf_dir):
    from ..sinks.writers import write_json

    from pyspark.sql import Observation

    from ..shipping import ensure_shipped

    ensure_shipped(spark)
    path = _sink_path(spark, sf_dir, "json")
    obs = Observation("run_stats")
    m, _status = extract(fx.ct_lines(spark, sf_dir), default_psl(spark), observation=obs)
    write_json(m.drop("position"), path)
    # the run's counters arrive with the write; they are one small row
    spark.createDataFrame([obs.get]).write.mode("overwrite").json(f"{path}/stats")
    return spark.read.schema("domain string, name string, organization string, organizational_unit string, source string, sequence_number long").json(f"{path}/mappings")


@query(
    "stream_batches",
    O.with_(O.DER) + "SELECT k AS log_index, k - k % 100 AS batch_start, true AS in_order, CAST(1 AS BIGINT) AS files, sha256(k::VARCHAR || ' ' || base64(from_hex(cert))) AS line_sha256 FROM entries WHERE cls <> 7",
)
def q_stream_batches(spark, sf_dir):
    """T1 + K5: the CT log streamed two pages a trigger, or a 25th of them if that is more, into gzip batch files, each written when complete, the last one by the final flush; read back with S1/S2."""
    import uuid

    from ..streaming.ingest import flush_incomplete, start_ingest_to_batches

    base = fx.fixture_path(spark, sf_dir, f"stream_batches_{uuid.uuid4().hex}")
    start_ingest_to_batches(spark, _log_dir(spark, sf_dir), f"{base}/out", f"{base}/ckpt", batch_size=100, max_files_per_trigger=_per_trigger(spark, sf_dir, 2)).awaitTermination()
    flush_incomplete(spark, f"{base}/out", batch_size=100)
    lines = read_batch_lines(spark, f"{base}/out", recursive=True)
    back = parse_lines(lines).withColumn("batch_start", F.regexp_extract("file", r"batch_start=(\d+)", 1).cast("long"))
    files = back.groupBy("batch_start").agg(F.count_distinct("file").alias("files"))
    before = F.lag("sequence_number").over(Window.partitionBy("file").orderBy("line_id"))  # a batch file holds 100 lines at most
    return back.select(
        F.col("sequence_number").alias("log_index"),
        "batch_start",
        (before.isNull() | (before < F.col("sequence_number"))).alias("in_order"),
        F.sha2("value", 256).alias("line_sha256"),
    ).join(files, "batch_start")


@query(
    "sink_per_source",
    O.with_(O.CERTS)
    + "SELECT domain, name, organization, NULLIF(organizational_unit, '') AS organizational_unit, source, sequence_number, 'ct-' || CAST(sequence_number % 10 AS VARCHAR) || '.jsonl' AS output_name FROM mappings",
)
def q_sink_per_source(spark, sf_dir):
    """K6: one output per source, written twice (a re-run changes nothing) and read back."""
    from ..sinks.writers import write_per_source

    path = _sink_path(spark, sf_dir, "per_source")
    m = _extract(spark, sf_dir)[0].drop("position").withColumn("output_name", F.concat(F.lit("ct-"), (F.col("sequence_number") % 10).cast("string"), F.lit(".jsonl")))
    for _ in range(2):
        write_per_source(m, path, sources=m.select("output_name").distinct())
    return spark.read.schema("domain string, name string, organization string, organizational_unit string, source string, sequence_number long, output_name string").json(path)


@query(
    "sink_dispatch",
    O.with_(O.CERTS)
    + """, f AS (SELECT unnest(['json', 'JSONL', 'csv', 'text']) AS fmt)
SELECT lower(fmt) AS fmt, count(*) AS n_rows, count(*) FILTER (WHERE fmt IN ('json', 'JSONL') AND organizational_unit <> '') AS n_units FROM mappings, f GROUP BY fmt""",
)
def q_sink_dispatch(spark, sf_dir):
    """K7: each format by name, in any case, read back."""
    from ..sinks.writers import write_mappings

    m = _extract(spark, sf_dir)[0].drop("position")
    out = None
    for fmt in ("json", "JSONL", "csv", "text"):
        path = _sink_path(spark, sf_dir, f"dispatch_{fmt}")
        write_mappings(m, path, fmt)
        if fmt.lower() in ("json", "jsonl"):
            back = spark.read.schema("name string, organizational_unit string").json(f"{path}/mappings" if fmt == "json" else path)
        elif fmt == "csv":
            back = spark.read.option("header", "true").csv(path).selectExpr("Name AS name", "CAST(NULL AS STRING) AS organizational_unit")
        else:
            back = spark.read.text(path).selectExpr("value AS name", "CAST(NULL AS STRING) AS organizational_unit")
        one = back.groupBy(F.lit(fmt.lower()).alias("fmt")).agg(F.count(F.lit(1)).alias("n_rows"), F.count("organizational_unit").alias("n_units"))
        out = one if out is None else out.unionByName(one)
    return out


@query(
    "log_list",
    """SELECT CAST(n_regionkey AS INTEGER) AS operator_pos, CAST(row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1 AS INTEGER) AS log_pos,
  n_name AS description, 'id' || CAST(n_nationkey AS VARCHAR) AS log_id,
  CAST(n_nationkey AS INTEGER) AS download_jobs, CAST(n_nationkey * 100 AS BIGINT) AS download_size FROM nation""",
)
def q_log_list(spark, sf_dir):
    """A log list document (an operator per region, a log per nation), flattened."""
    from ..sources.pages import flatten_log_list

    log = F.struct(
        F.col("n_nationkey").alias("n"),
        F.col("n_name").alias("description"),
        F.concat(F.lit("id"), F.col("n_nationkey").cast("string")).alias("log_id"),
        F.concat(F.lit("https://ct.example.com/"), F.lower("n_name"), F.lit("/")).alias("url"),
        F.col("n_nationkey").cast("int").alias("certspotter_download_jobs"),
        (F.col("n_nationkey") * 100).cast("long").alias("certspotter_download_size"),
    )
    ops = read_table(spark, sf_dir, "nation").groupBy("n_regionkey").agg(F.sort_array(F.collect_list(log)).alias("logs"))
    one = F.struct("n_regionkey", F.concat(F.lit("operator "), F.col("n_regionkey").cast("string")).alias("name"), "logs")
    doc = ops.agg(F.to_json(F.struct(F.sort_array(F.collect_list(one)).alias("operators"))).alias("json"))
    return flatten_log_list(doc).select("operator_pos", "log_pos", "description", "log_id", "download_jobs", "download_size")
