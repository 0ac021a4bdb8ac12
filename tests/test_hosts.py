from pyspark.sql import functions as F

from ctspark.operators.hosts import clean_log_name, file_ext, normalize_host, output_name, registered_domain


def test_registered_domain_rules(spark, psl):
    hosts = ["larch.com", "*.larch.com", "north.gate.larch.com", "one.two.birch.co.uk", "a.b.ck", "www.ck", "x.city.kawasaki.jp", "a.b.kawasaki.jp", "co.uk", "unknowntld", "a.b.zz", "a..b.com"]
    df = spark.createDataFrame([(h,) for h in hosts], "raw string").select("raw", normalize_host(F.col("raw")).alias("host"))
    got = {r.raw: r.domain for r in registered_domain(df, "host", psl).collect()}
    assert got["larch.com"] == "larch.com"
    assert got["*.larch.com"] == "larch.com"
    assert got["north.gate.larch.com"] == "larch.com"
    assert got["one.two.birch.co.uk"] == "birch.co.uk"
    assert got["a.b.ck"] == "a.b.ck"  # *.ck makes b.ck the suffix
    assert got["www.ck"] == "www.ck"  # !www.ck: suffix is ck
    assert got["x.city.kawasaki.jp"] == "city.kawasaki.jp"
    assert got["a.b.kawasaki.jp"] == "a.b.kawasaki.jp"
    assert got["co.uk"] == ""
    assert got["unknowntld"] == ""
    assert got["a.b.zz"] == "b.zz"  # unknown TLD: last label is the suffix
    assert got["a..b.com"] == ""


def test_normalize_unicode(spark):
    df = spark.createDataFrame([("*.Bücher.Example",), (".Www.Example.COM..",)], "h string")
    assert [r.n for r in df.select(normalize_host(F.col("h")).alias("n")).collect()] == ["xn--bcher-kva.example", "www.example.com"]


def test_name_helpers(spark):
    df = spark.createDataFrame([("https://ct.example.com:443/logs/2024/", "logs/a/file1.gz"), ("http://x.y/z?q=1", "b.GZ")], "url string, key string")
    r = df.select(clean_log_name(F.col("url")).alias("c"), output_name(F.col("key"), "csv", "out/").alias("o"), file_ext(F.col("key")).alias("e")).collect()
    assert r[0].c == "ct.example.com_443_logs_2024" and r[0].o == "out/file1.csv" and r[0].e == ".gz"
    assert r[1].c == "x.y_zq1" and r[1].o == "out/b.GZ.csv" and r[1].e == ".gz"


def test_lookup_rules_of_labels(spark):
    """Punycode labels are decoded and checked, and hyphens, marks, joiners and directions follow the rules."""
    good = {
        "xn--bcher-kva.example": "xn--bcher-kva.example",
        "XN--BCHER-KVA.example": "xn--bcher-kva.example",
        "*.xn--ls8h.la": "xn--ls8h.la",  # a symbol: valid for lookup
        "a--b.example": "a--b.example",
        "xn--Bcher-Kva-.example": "bcher-kva.example",  # decodes to ASCII, and is written so
        "a_b.example": "a_b.example",  # no STD3 rules
        "xn--fa-hia.de": "xn--fa-hia.de",  # sharp s, kept by the non-transitional mapping
        "fa\u00df.de": "xn--fa-hia.de",
        "a..b.com": "a..b.com",
        "\u05d0\u05d1.example": "xn--4dbc.example",
        "b\u00fccher\u3002example": "xn--bcher-kva.example",  # an ideographic full stop divides labels
        "": "",
    }
    bad = [
        "xn--99999999.example",  # no punycode
        "xn--0.example",
        "ab--cd.example",  # hyphens in third and fourth place
        "r3---sn.example",
        "-a.example",
        "a-.example",
        "x.-.y",
        "xn--a-ccb.example",  # decodes to a letter with a mark that the mapping puts together
        "\u0301a.example",  # a leading combining mark
        "a\u200db.example",  # a joiner out of context
        "\u05d0a.example",  # mixed directions
        "a\ufffdb.example",  # a disallowed character
    ]
    rows = [(h,) for h in [*good, *bad]]
    got = {r.h: r.n for r in spark.createDataFrame(rows, "h string").select("h", normalize_host(F.col("h")).alias("n")).collect()}
    assert {h: got[h] for h in good} == good
    assert {h: got[h] for h in bad} == dict.fromkeys(bad, "")


def test_punycode_round_trip(spark):
    """Names that the mapping accepts come back from their ASCII form unchanged."""
    names = ["b\u00fccher", "\u4f8b\u3048", "\u0440\u0444", "\u0e44\u0e17\u0e22", "\u00e9l\u00e8ve-1", "\U0001f4a9"]
    df = spark.createDataFrame([(f"{n}.example",) for n in names], "h string").select(normalize_host(F.col("h")).alias("a"))
    again = df.select("a", normalize_host(F.col("a")).alias("b")).collect()
    assert all(r.a == r.b and r.a.startswith("xn--") for r in again)
    assert [r.a.split(".")[0][4:].encode().decode("punycode") for r in again] == names
