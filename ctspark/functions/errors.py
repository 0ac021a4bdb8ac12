"""Error classification, retry and recovery rules as native ``when`` chains.

Every rule is a substring test over the lower-cased message (and context / operation), and the
order of the tests matters.  The pattern lists below are the fixed values the rules use.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col_


def _memo(fn):
    """Reuse the (large, unresolved) rule expression when called again with the same column
    names: building it costs hundreds of driver round trips, evaluating it costs nothing extra."""
    cache: dict = {}

    @functools.wraps(fn)
    def wrapper(*args, **kw):
        if kw or not all(isinstance(a, str) for a in args):
            return fn(*args, **kw)
        if args not in cache:
            cache[args] = fn(*args)
        return cache[args]

    return wrapper

# ---- fixed values ------------------------------------------------------------------------
# Error types
FILE, PARSING, PROCESSING, OUTPUT, NETWORK, MEMORY = "FILE", "PARSING", "PROCESSING", "OUTPUT", "NETWORK", "MEMORY"
S3_ACCESS, S3_DOWNLOAD, S3_STATE, UNKNOWN = "S3_ACCESS", "S3_DOWNLOAD", "S3_STATE", "UNKNOWN"
ERROR_TYPES = [FILE, PARSING, PROCESSING, OUTPUT, NETWORK, MEMORY, S3_ACCESS, S3_DOWNLOAD, S3_STATE, UNKNOWN]

# General classifier (E1), in evaluation order
S3_ACCESS_MSG = ["access denied", "forbidden", "invalid access key", "no such bucket"]
S3_ACCESS_CTX = ["list", "access"]
S3_DOWNLOAD_MSG = ["no such key"]
S3_DOWNLOAD_CTX = ["download", "get"]
S3_STATE_CTX = ["state"]
MEMORY_MSG = ["out of memory", "allocation failed"]
NETWORK_MSG = ["network", "connection", "timeout", "dns"]
FILE_MSG = ["no such file", "permission denied", "file not found", "cannot open"]
FILE_CTX = ["file"]
PARSING_MSG = ["parse", "decode", "invalid", "malformed", "base64", "certificate"]
PARSING_CTX = ["parse", "decode"]
OUTPUT_MSG = ["write", "output"]
OUTPUT_CTX = ["write", "output"]
PROCESSING_CTX = ["process", "extract", "mapping"]

# Object-store classifier (E2), in evaluation order
S3C_ACCESS_MSG = ["access denied", "forbidden", "invalid access key", "no such bucket", "bucket not found"]
S3C_ACCESS_OP = ["list", "access"]
S3C_DOWNLOAD_MSG = ["no such key", "download"]
S3C_DOWNLOAD_OP = ["download", "get"]
S3C_STATE_OP = ["state"]
S3C_STATE_MSG = ["state", "lock", "corruption"]

# Retry limits per type (E3); other types retry once
MAX_RETRIES = {NETWORK: 3, MEMORY: 1, FILE: 2, OUTPUT: 2, PARSING: 0, PROCESSING: 1, S3_ACCESS: 3, S3_DOWNLOAD: 10, S3_STATE: 2}
# Recovery actions (E4); other types SKIP
RECOVERY = {MEMORY: "REDUCE_LOAD", NETWORK: "RETRY_WITH_DELAY", FILE: "RETRY", OUTPUT: "RETRY", S3_ACCESS: "RETRY_WITH_DELAY", S3_DOWNLOAD: "RETRY_WITH_DELAY", S3_STATE: "RETRY"}

# Retry configurations (E5, E8): max retries, initial delay s, max delay s, jitter, patterns
RETRY_CONFIG = {
    S3_ACCESS: (3, 1.0, 30.0, True, ["RequestTimeout", "ServiceUnavailable", "SlowDown", "InternalError"]),
    S3_DOWNLOAD: (10, 0.5, 60.0, True, ["RequestTimeout", "ServiceUnavailable", "SlowDown", "InternalError", "connection", "timeout"]),
    S3_STATE: (2, 0.1, 5.0, False, ["permission", "lock", "busy"]),
    NETWORK: (5, 1.0, 30.0, True, ["timeout", "connection", "dns", "network"]),
}
DEFAULT_DELAY = (1.0, 30.0, True)
COMMON_RETRYABLE = [
    "requesttimeout",
    "serviceunavailable",
    "slowdown",
    "internalerror",
    "connection reset",
    "connection refused",
    "timeout",
    "temporary failure",
    "try again",
]
RATE_LIMIT = ["slowdown", "rate", "throttl", "too many requests"]
AUTH = ["access denied", "forbidden", "invalid access key", "invalidaccesskeyid", "signature", "credential"]
# Download-manager retryable substrings
DOWNLOAD_RETRYABLE = [
    "timeout",
    "connection reset",
    "connection refused",
    "temporary failure",
    "service unavailable",
    "internal server error",
    "bad gateway",
    "gateway timeout",
    "too many requests",
    "throttling",
    "rate limit",
]
DOWNLOAD_MAX_ATTEMPTS = 10


def _any(c: Column, pats) -> Column:
    out = None
    for p in pats:
        t = c.contains(p.lower())
        out = t if out is None else (out | t)
    return out if out is not None else F.lit(False)


def _low(c) -> Column:
    return F.lower(F.coalesce(col_(c), F.lit("")))


@_memo
def classify_error(message, context) -> Column:
    """Error type from message and context; null message -> UNKNOWN."""
    m, x = _low(message), _low(context)
    is_s3 = x.contains("s3") | m.contains("s3")
    s3 = (
        F.when(_any(m, S3_ACCESS_MSG) | _any(x, S3_ACCESS_CTX), F.lit(S3_ACCESS))
        .when(_any(m, S3_DOWNLOAD_MSG) | _any(x, S3_DOWNLOAD_CTX), F.lit(S3_DOWNLOAD))
        .when(_any(x, S3_STATE_CTX), F.lit(S3_STATE))
        .otherwise(F.lit(S3_ACCESS))
    )
    return (
        F.when(col_(message).isNull(), F.lit(UNKNOWN))
        .when(is_s3, s3)
        .when(_any(m, MEMORY_MSG) | (m.contains("memory") & ~m.contains("file")), F.lit(MEMORY))
        .when(_any(m, NETWORK_MSG), F.lit(NETWORK))
        .when(_any(m, FILE_MSG) | _any(x, FILE_CTX), F.lit(FILE))
        .when(_any(m, PARSING_MSG) | _any(x, PARSING_CTX), F.lit(PARSING))
        .when(_any(m, OUTPUT_MSG) | _any(x, OUTPUT_CTX), F.lit(OUTPUT))
        .when(_any(x, PROCESSING_CTX), F.lit(PROCESSING))
        .otherwise(F.lit(UNKNOWN))
    )


@_memo
def classify_s3_error(message, operation) -> Column:
    """Object-store classification, falling back to E1 with the operation as context."""
    m, o = _low(message), _low(operation)
    return (
        F.when(col_(message).isNull(), F.lit(UNKNOWN))
        .when(_any(m, S3C_ACCESS_MSG) | _any(o, S3C_ACCESS_OP), F.lit(S3_ACCESS))
        .when(_any(m, S3C_DOWNLOAD_MSG) | _any(o, S3C_DOWNLOAD_OP), F.lit(S3_DOWNLOAD))
        .when(_any(o, S3C_STATE_OP) | _any(m, S3C_STATE_MSG), F.lit(S3_STATE))
        .otherwise(classify_error(message, operation))
    )


def _lookup(t: Column, table: dict, default) -> Column:
    out = None
    for k, v in table.items():
        out = F.when(t == k, F.lit(v)) if out is None else out.when(t == k, F.lit(v))
    return out.otherwise(F.lit(default))


def max_retries(error_type) -> Column:
    """Retry limit per type."""
    return _lookup(col_(error_type), MAX_RETRIES, 1)


def should_retry(message, context, attempt) -> Column:
    """Attempt < limit of the classified type."""
    return col_(attempt) < max_retries(classify_error(message, context))


def recovery_action(error_type) -> Column:
    """Recovery action per type."""
    return _lookup(col_(error_type), RECOVERY, "SKIP")


def is_retryable(message, error_type) -> Column:
    """E5: only types with a retry configuration; per-type or common pattern matches."""
    m = _low(message)
    t = col_(error_type)
    out = F.lit(False)
    cases = None
    for typ, (_, _, _, _, pats) in RETRY_CONFIG.items():
        cond = _any(m, pats) | _any(m, COMMON_RETRYABLE)
        cases = F.when(t == typ, cond) if cases is None else cases.when(t == typ, cond)
    out = cases.otherwise(F.lit(False))
    return F.when(col_(message).isNull(), F.lit(False)).otherwise(out)


def is_rate_limit(message) -> Column:
    """E6 (substring match, so 'rate' also hits words such as "generated")."""
    return F.coalesce(_any(_low(message), RATE_LIMIT) & col_(message).isNotNull(), F.lit(False))


def is_auth_error(message) -> Column:
    return F.coalesce(_any(_low(message), AUTH) & col_(message).isNotNull(), F.lit(False))


@_memo
def error_action(message, operation, kind, attempt, s3_type=None, proc_type=None) -> Column:
    """RETRY / SKIP / FAIL / WAIT by handler kind (s3, download, processing, state).

    ``s3_type`` / ``proc_type`` take precomputed classifications (see ``errlog.error_actions``)."""
    m = _low(message)
    k = F.lower(F.coalesce(col_(kind), F.lit("")))
    s3_type = col_(s3_type) if s3_type is not None else classify_s3_error(message, operation)
    s3 = (
        F.when(is_rate_limit(message), F.lit("WAIT"))
        .when(is_auth_error(message), F.lit("FAIL"))
        .when(m.contains("nosuchbucket"), F.lit("FAIL"))
        .when(is_retryable(message, s3_type), F.lit("RETRY"))
        .otherwise(F.lit("SKIP"))
    )
    download = (
        F.when(col_(attempt) >= RETRY_CONFIG[S3_DOWNLOAD][0], F.lit("FAIL"))
        .when(is_retryable(message, F.lit(S3_DOWNLOAD)), F.when(is_rate_limit(message), F.lit("WAIT")).otherwise(F.lit("RETRY")))
        .otherwise(F.lit("SKIP"))
    )
    ptype = col_(proc_type) if proc_type is not None else classify_error(message, F.lit("processing"))
    processing = (
        F.when(ptype == MEMORY, F.lit("WAIT"))
        .when(ptype == FILE, F.lit("RETRY"))
        .when((ptype == PROCESSING) & m.contains("lock"), F.lit("RETRY"))
        .otherwise(F.lit("SKIP"))
    )
    state = (
        F.when(is_retryable(message, F.lit(S3_STATE)), F.lit("RETRY"))
        .when(m.contains("corruption"), F.lit("FAIL"))
        .otherwise(F.lit("SKIP"))
    )
    return (
        F.when(col_(message).isNull(), F.lit("RETRY"))
        .when(k == "s3", s3)
        .when(k == "download", download)
        .when(k == "processing", processing)
        .when(k == "state", state)
        .otherwise(F.lit("SKIP"))
    )


def retry_delay(attempt, error_type, jitter: Column | None = None) -> Column:
    """min(initial * 2^attempt, max) seconds, plus up to 10 % jitter when the type allows it.

    ``jitter`` is a column of uniform [0,1) draws (e.g. ``F.rand(seed)``); None means no jitter.
    """
    t = col_(error_type)
    init = _lookup(t, {k: v[1] for k, v in RETRY_CONFIG.items()}, DEFAULT_DELAY[0])
    cap = _lookup(t, {k: v[2] for k, v in RETRY_CONFIG.items()}, DEFAULT_DELAY[1])
    use_j = _lookup(t, {k: v[3] for k, v in RETRY_CONFIG.items()}, DEFAULT_DELAY[2])
    base = F.least(init * F.pow(F.lit(2.0), col_(attempt).cast("double")), cap)
    if jitter is None:
        return base
    return base + F.when(use_j, jitter * base * 0.1).otherwise(F.lit(0.0))


def download_backoff(attempt, jitter: Column | None = None) -> Column:
    """min(2^attempt, 60) s, +/- up to 50 % when a [0,1) jitter column and a sign column are given."""
    base = F.least(F.pow(F.lit(2.0), col_(attempt).cast("double")), F.lit(60.0))
    if jitter is None:
        return base
    return base + (jitter - 0.5) * base


def fetch_backoff(attempt) -> Column:
    """Page fetch waits 2 * attempt seconds between its attempts."""
    return (col_(attempt) * 2).cast("double")


def download_retryable(message) -> Column:
    """E10."""
    return F.coalesce(_any(_low(message), DOWNLOAD_RETRYABLE) & col_(message).isNotNull(), F.lit(False))


# Operator guidance keys for E11 (wording is ours).
HINTS = {
    "access": "Check credentials and the bucket policy for list and read rights.",
    "bucket": "Check the bucket name and region.",
    "key": "Check the access key pair or role configuration.",
    "region": "Check that the configured region is the bucket's region.",
    "s3_default": "Check credentials, bucket name and region.",
    "dl_timeout": "Download timed out: large object or slow link; raise the timeout.",
    "dl_connection": "Connection to the object store failed; retries follow.",
    "dl_rate": "The object store is throttling; lower the download concurrency.",
    "dl_missing": "The object no longer exists.",
    "dl_default": "Download failed; check connectivity and service status.",
    "state_permission": "Ledger cannot be read or written; check folder rights.",
    "state_corruption": "Ledger is corrupt; rebuilding it reprocesses every file.",
    "state_lock": "Another run may hold the ledger.",
    "state_default": "Ledger error; check rights and free space.",
    "net_dns": "Name resolution failed; check DNS.",
    "net_timeout": "Request timed out; check the network or raise the timeout.",
    "net_default": "Network error; check connectivity.",
    "memory": "Out of memory; lower batch size or concurrency.",
    "file": "Local file-system error; check space and rights.",
}


@_memo
def error_hint(message, error_type) -> Column:
    """Guidance text by type and keyword."""
    m, t = _low(message), col_(error_type)
    h = {k: F.lit(v) for k, v in HINTS.items()}
    s3 = (
        F.when(m.contains("access denied") | m.contains("forbidden"), h["access"])
        .when(m.contains("no such bucket") | m.contains("nosuchbucket"), h["bucket"])
        .when(m.contains("invalid access key"), h["key"])
        .when(m.contains("region"), h["region"])
        .otherwise(h["s3_default"])
    )
    dl = (
        F.when(m.contains("timeout"), h["dl_timeout"])
        .when(m.contains("connection"), h["dl_connection"])
        .when(m.contains("slowdown") | m.contains("rate"), h["dl_rate"])
        .when(m.contains("no such key"), h["dl_missing"])
        .otherwise(h["dl_default"])
    )
    st = (
        F.when(m.contains("permission"), h["state_permission"])
        .when(m.contains("corruption"), h["state_corruption"])
        .when(m.contains("lock"), h["state_lock"])
        .otherwise(h["state_default"])
    )
    net = F.when(m.contains("dns"), h["net_dns"]).when(m.contains("timeout"), h["net_timeout"]).otherwise(h["net_default"])
    return (
        F.when(col_(message).isNull(), F.lit(""))
        .when(t == S3_ACCESS, s3)
        .when(t == S3_DOWNLOAD, dl)
        .when(t == S3_STATE, st)
        .when(t == NETWORK, net)
        .when(t == MEMORY, h["memory"])
        .when(t == FILE, h["file"])
        .otherwise(F.concat(F.lit("Error: "), col_(message), F.lit(". See the logs; a retry may help.")))
    )


def error_text(error_type, sequence, context, message) -> Column:
    """E13: '[TYPE] seq:N context: message', the seq part only for N >= 0."""
    return F.when(
        col_(sequence) >= 0,
        F.format_string("[%s] seq:%d %s: %s", col_(error_type), col_(sequence), col_(context), col_(message)),
    ).otherwise(F.format_string("[%s] %s: %s", col_(error_type), col_(context), col_(message)))


def severity(error_type) -> Column:
    """W9 log level per type."""
    t = col_(error_type)
    return (
        F.when(t.isin(FILE, OUTPUT), F.lit("ERROR"))
        .when(t.isin(MEMORY, NETWORK), F.lit("CRITICAL"))
        .when(t.isin(PARSING, PROCESSING), F.lit("WARNING"))
        .otherwise(F.lit("ERROR"))
    )
