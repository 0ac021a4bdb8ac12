"""Fixed values of the error rules as the oracles have them, typed apart from ``functions/errors.py`` so that
a wrong value in either place shows as a difference."""

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
S3C_ACCESS_MSG = ["access denied", "forbidden", "invalid access key", "no such bucket", "bucket not found"]
S3C_ACCESS_OP = ["list", "access"]
S3C_DOWNLOAD_MSG = ["no such key", "download"]
S3C_DOWNLOAD_OP = ["download", "get"]
S3C_STATE_OP = ["state"]
S3C_STATE_MSG = ["state", "lock", "corruption"]
MAX_RETRIES = {"NETWORK": 3, "MEMORY": 1, "FILE": 2, "OUTPUT": 2, "PARSING": 0, "PROCESSING": 1, "S3_ACCESS": 3, "S3_DOWNLOAD": 10, "S3_STATE": 2}
RECOVERY = {"MEMORY": "REDUCE_LOAD",
 "NETWORK": "RETRY_WITH_DELAY",
 "FILE": "RETRY",
 "OUTPUT": "RETRY",
 "S3_ACCESS": "RETRY_WITH_DELAY",
 "S3_DOWNLOAD": "RETRY_WITH_DELAY",
 "S3_STATE": "RETRY"}
RETRY_CONFIG = {"S3_ACCESS": (3, 1.0, 30.0, True, ["RequestTimeout", "ServiceUnavailable", "SlowDown", "InternalError"]),
 "S3_DOWNLOAD": (10, 0.5, 60.0, True, ["RequestTimeout", "ServiceUnavailable", "SlowDown", "InternalError", "connection", "timeout"]),
 "S3_STATE": (2, 0.1, 5.0, False, ["permission", "lock", "busy"]),
 "NETWORK": (5, 1.0, 30.0, True, ["timeout", "connection", "dns", "network"])}
DEFAULT_DELAY = (1.0, 30.0, True)
COMMON_RETRYABLE = ["requesttimeout",
 "serviceunavailable",
 "slowdown",
 "internalerror",
 "connection reset",
 "connection refused",
 "timeout",
 "temporary failure",
 "try again"]
RATE_LIMIT = ["slowdown", "rate", "throttl", "too many requests"]
AUTH = ["access denied", "forbidden", "invalid access key", "invalidaccesskeyid", "signature", "credential"]
DOWNLOAD_RETRYABLE = ["timeout",
 "connection reset",
 "connection refused",
 "temporary failure",
 "service unavailable",
 "internal server error",
 "bad gateway",
 "gateway timeout",
 "too many requests",
 "throttling",
 "rate limit"]
DOWNLOAD_MAX_ATTEMPTS = 10
HINTS = {'access': 'Check credentials and the bucket policy for list and read rights.',
 'bucket': 'Check the bucket name and region.',
 'key': 'Check the access key pair or role configuration.',
 'region': "Check that the configured region is the bucket's region.",
 's3_default': 'Check credentials, bucket name and region.',
 'dl_timeout': 'Download timed out: large object or slow link; raise the timeout.',
 'dl_connection': 'Connection to the object store failed; retries follow.',
 'dl_rate': 'The object store is throttling; lower the download concurrency.',
 'dl_missing': 'The object no longer exists.',
 'dl_default': 'Download failed; check connectivity and service status.',
 'state_permission': 'Ledger cannot be read or written; check folder rights.',
 'state_corruption': 'Ledger is corrupt; rebuilding it reprocesses every file.',
 'state_lock': 'Another run may hold the ledger.',
 'state_default': 'Ledger error; check rights and free space.',
 'net_dns': 'Name resolution failed; check DNS.',
 'net_timeout': 'Request timed out; check the network or raise the timeout.',
 'net_default': 'Network error; check connectivity.',
 'memory': 'Out of memory; lower batch size or concurrency.',
 'file': 'Local file-system error; check space and rights.'}
