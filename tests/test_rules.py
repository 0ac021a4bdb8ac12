import pytest
from pyspark.sql import functions as F

from ctspark.functions import errors as E
from ctspark.sources.batch_files import parse_lines


def test_line_grammar(spark):
    rows = ["123 MIIabc", "456   MIIdef", "", " \t ", "123", "MIIabc", "abc MIIabc", "-1 MIIabc", "123  ", "123 ", "9223372036854775808 MII", "7 MII\r"]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, value string")
    out = {r.i: r for r in parse_lines(df).collect()}
    assert (out[0].sequence_number, out[0].certificate_data) == (123, "MIIabc")
    assert (out[1].sequence_number, out[1].certificate_data) == (456, "MIIdef")
    assert out[2].error == out[3].error == "line is empty"
    for i in (4, 5, 6, 7, 9):
        assert out[i].error.startswith("line does not match expected format"), i
    assert out[8].error == "certificate data is empty"
    assert out[10].error.startswith("invalid sequence number")
    assert out[11].certificate_data == "MII"


def test_abort_file_keeps_rows_before_first_error(spark):
    df = spark.createDataFrame([("f", 0, "1 A"), ("f", 1, "2 B"), ("f", 2, "bad"), ("f", 3, "4 D"), ("g", 0, "5 E")], "file string, line_id long, value string")
    kept = sorted(r.sequence_number for r in parse_lines(df, mode="abort_file").collect())
    assert kept == [1, 2, 5]


CLASSIFY = [
    ("access denied", "s3 listing", "S3_ACCESS"),
    ("no such key", "s3 object", "S3_DOWNLOAD"),
    ("oops", "s3 state save", "S3_STATE"),
    ("oops", "s3 put", "S3_ACCESS"),
    ("out of memory", "x", "MEMORY"),
    ("memory file mapping", "x", "UNKNOWN"),
    ("connection reset", "x", "NETWORK"),
    ("cannot open input", "x", "FILE"),
    ("malformed thing", "x", "PARSING"),
    ("write failed", "x", "OUTPUT"),
    ("oops", "extracting", "PROCESSING"),
    ("oops", "x", "UNKNOWN"),
    (None, "x", "UNKNOWN"),
]


def test_classify_table(spark):
    df = spark.createDataFrame(CLASSIFY, "m string, c string, want string")
    for r in df.select("want", E.classify_error(F.col("m"), F.col("c")).alias("got")).collect():
        assert r.got == r.want


ACTIONS = [
    ("SlowDown", "list", "s3", 0, "WAIT"),
    ("Access Denied", "get", "s3", 0, "FAIL"),
    ("NoSuchBucket", "get", "s3", 0, "FAIL"),
    ("RequestTimeout", "list", "s3", 0, "RETRY"),
    ("weird", "list", "s3", 0, "SKIP"),
    ("connection reset", "", "download", 10, "FAIL"),
    ("connection reset", "", "download", 1, "RETRY"),
    ("timeout: too many requests, slowdown", "", "download", 1, "WAIT"),
    ("bad data", "", "download", 1, "SKIP"),
    ("out of memory", "", "processing", 0, "WAIT"),
    ("no such file", "", "processing", 0, "RETRY"),
    ("corrupt", "", "processing", 0, "SKIP"),
    ("lock busy", "", "state", 0, "RETRY"),
    ("corruption found", "", "state", 0, "FAIL"),
    ("weird", "", "state", 0, "SKIP"),
    (None, "", "state", 0, "RETRY"),
]


def test_error_action_table(spark):
    df = spark.createDataFrame(ACTIONS, "m string, o string, k string, a int, want string")
    got = df.select("want", E.error_action(F.col("m"), F.col("o"), F.col("k"), F.col("a")).alias("got")).collect()
    assert [r.got for r in got] == [r.want for r in got]


def test_retry_delay_and_limits(spark):
    df = spark.createDataFrame([(0, "S3_ACCESS"), (10, "S3_ACCESS"), (3, "S3_DOWNLOAD"), (2, "S3_STATE"), (1, "PARSING")], "a int, t string")
    r = df.select(E.retry_delay(F.col("a"), F.col("t")).alias("d"), E.max_retries(F.col("t")).alias("m"), E.recovery_action(F.col("t")).alias("ra")).collect()
    assert [x.d for x in r] == [1.0, 30.0, 4.0, 0.4, 2.0]
    assert [x.m for x in r] == [3, 3, 10, 2, 0]
    assert [x.ra for x in r] == ["RETRY_WITH_DELAY", "RETRY_WITH_DELAY", "RETRY_WITH_DELAY", "RETRY", "SKIP"]
    j = df.select(E.retry_delay(F.col("a"), F.col("t"), F.lit(0.999)).alias("d")).collect()
    assert abs(j[0].d - 1.0999) < 1e-9 and j[3].d == 0.4  # state errors have no jitter


def test_flags(spark):
    df = spark.createDataFrame([("generated failure",), ("Signature mismatch",), ("bad gateway",)], "m string")
    r = df.select(E.is_rate_limit(F.col("m")).alias("rl"), E.is_auth_error(F.col("m")).alias("au"), E.download_retryable(F.col("m")).alias("dr")).collect()
    assert [x.rl for x in r] == [True, False, False]  # "rate" inside "generated"
    assert [x.au for x in r] == [False, True, False]
    assert [x.dr for x in r] == [False, False, True]


def test_strict_base64(spark):
    from ctspark.functions.encoding import base64_error, decode_base64_strict

    bad = "failed to decode base64 certificate data"
    rows = [
        ("QUJD", None, 3),
        ("QUI=", None, 2),
        ("QQ==", None, 1),
        ("QU" + chr(13) + chr(10) + "JD", None, 3),  # CR LF inside are ignored
        ("QUI", bad, None),
        ("QU JD", bad, None),
        ("QUJD!", bad, None),
        ("  ", "certificate data is empty", None),
        ("Q===", bad, None),
    ]
    df = spark.createDataFrame(rows, "s string, err string, n int")
    for r in df.select("err", "n", base64_error(F.col("s")).alias("e"), F.length(decode_base64_strict(F.col("s"))).alias("m")).collect():
        assert r.e == r.err and r.m == r.n
    lenient = spark.createDataFrame([("QU JD",)], "s string").select(base64_error(F.col("s"), lenient=True).alias("e")).first()
    assert lenient.e is None


def test_line_grammar_against_regex(spark):
    """parse_lines (anchored expressions) against the grammar as one regular expression."""
    import random
    import re

    from ctspark.functions.idna_host import GO_SPACE

    rnd = random.Random(5)
    alphabet = ["1", "2", "0", "9", " ", " ", "\t", "\r", "a", "Z", "=", "+", "-", "\x0b", "　"]
    lines = ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(0, 9))) for _ in range(3000)]
    lines += ["12 ", "12  ", "12 \t", "9223372036854775807 x", "9223372036854775808 x", "00012 x"]

    def expected(line):
        if line.strip(GO_SPACE) == "":
            return ("line is empty", None, None)
        m = re.fullmatch(r"([0-9]+)[\t\n\f\r ]+(.+)", line)
        if not m:
            return ("format", None, None)
        seq = int(m.group(1))
        if seq > 2**63 - 1:
            return ("sequence", None, None)
        data = m.group(2).strip(GO_SPACE)
        if data == "":
            return ("certificate data is empty", None, None)
        return (None, seq, data)

    df = spark.createDataFrame([(i, l) for i, l in enumerate(lines)], "i int, value string")
    got = {r.i: r for r in parse_lines(df).collect()}
    for i, line in enumerate(lines):
        e = expected(line)
        r = got[i]
        kind = None if r.error is None else ("format" if r.error.startswith("line does not match") else "sequence" if r.error.startswith("invalid sequence") else r.error)
        assert (kind, r.sequence_number, r.certificate_data) == e, (repr(line), r)


def test_strict_base64_against_python_decoder(spark):
    import base64
    import binascii
    import random

    from ctspark.functions.encoding import base64_error, decode_base64_strict

    rnd = random.Random(9)
    alphabet = "QUJDabc019+/=" + "\r\n !"
    values = ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(1, 13))) for _ in range(3000)]

    def expected(v):
        if v.strip() == "":
            return "empty"
        s = v.replace("\r", "").replace("\n", "")
        # padding only at the end, then the standard strict decoder
        if "=" in s.rstrip("="):
            return None
        try:
            out = base64.b64decode(s, validate=True)
        except (binascii.Error, ValueError):
            return None
        return out

    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    got = {r.i: r for r in df.select("i", base64_error(F.col("v")).alias("e"), decode_base64_strict(F.col("v")).alias("d")).collect()}
    for i, v in enumerate(values):
        e = expected(v)
        r = got[i]
        if e == "empty":
            assert r.e == "certificate data is empty", repr(v)
        elif e is None:
            assert r.e == "failed to decode base64 certificate data", repr(v)
        else:
            assert bytes(r.d) == e and (r.e is None or (len(e) == 0 and r.e.startswith("decoded"))), repr(v)
