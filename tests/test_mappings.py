import base64

from derutil import cert
from pyspark.sql import functions as F

from ctspark.operators.mappings import extract


def lines(spark, certs):
    rows = [(i, base64.b64encode(c).decode() if isinstance(c, bytes) else c) for i, c in enumerate(certs)]
    return spark.createDataFrame(rows, "sequence_number long, certificate_data string")


def run(spark, psl, certs):
    m, s = extract(lines(spark, certs), psl)
    return sorted(tuple(r) for r in m.drop("position").collect()), {r.sequence_number: r for r in s.collect()}


def test_generated_certificate_cases(spark, psl):
    certs = [
        cert([("O", "Example Corp"), ("CN", "example.com")], ["api.example.com", "www.example.com"]),
        cert([("CN", "example.com")], ["api.example.com"]),
        cert([("O", "Example Corp"), ("CN", "example.com")]),
        cert([("O", "Example Corp")], ["api.example.com", "www.example.com"]),
    ]
    rows, status = run(spark, psl, certs)
    per_seq = {}
    for r in rows:
        per_seq.setdefault(r[5], []).append(r)
    assert len(per_seq[0]) == 3 and 1 not in per_seq and len(per_seq[2]) == 1 and len(per_seq[3]) == 2
    assert {r[4] for r in per_seq[3]} == {"SAN"}
    assert all(st.stage == "ok" for st in status.values())
    assert status[1].skip_reason == "no_org"


def test_filters_and_domains(spark, psl):
    certs = [
        cert([("O", "Domain Control Validated"), ("CN", "a.example.com")]),
        cert([("O", "b.example.net"), ("CN", "www.b.example.net")], ["b.example.net"]),  # self-referential
        cert([("O", "lowercase"), ("CN", "www.example.co.uk")], ["*.Shop.Example.co.uk"]),
        cert([("O", "Org"), ("CN", "com")]),  # bare suffix: row kept, domain ''
        cert([("O", "Org")], [" "]),  # only a blank SAN: extraction error
        "@@@",
        cert([("O", " Padded  "), ("OU", " Unit "), ("CN", "  x.www.ck ")]),
    ]
    rows, status = run(spark, psl, certs)
    assert status[0].skip_reason == "dcv"
    assert status[1].skip_reason == "self_referential"
    assert ("example.co.uk", "www.example.co.uk", "lowercase", "", "CN", 2) in rows
    assert ("example.co.uk", "*.Shop.Example.co.uk", "lowercase", "", "SAN", 2) in rows
    assert ("", "com", "Org", "", "CN", 3) in rows
    assert status[4].stage == "extract"
    assert status[5].stage == "parse"
    # exception rule !www.ck: suffix 'ck', so x.www.ck -> www.ck; names and org are trimmed
    assert ("www.ck", "x.www.ck", "Padded", "Unit", "CN", 6) in rows


def test_cn_repeated_as_san_not_deduplicated(spark, psl):
    rows, _ = run(spark, psl, [cert([("O", "Org"), ("CN", "a.example.com")], ["a.example.com"])])
    assert len(rows) == 2


def test_certificate_level_filters(spark, psl):
    from ctspark.operators.mappings import certificates, drop_self_referential, filter_org, no_names_error

    certs = [
        cert([("O", "Domain Control Validated"), ("CN", "a.example.com")]),
        cert([("O", "b.example.net"), ("CN", "www.b.example.net")], ["b.example.net"]),
        cert([("O", "Org"), ("CN", "c.example.com")]),
        cert([("O", "Org")], [" "]),
    ]
    c = certificates(lines(spark, certs))
    kept = filter_org(c)
    assert sorted(r.sequence_number for r in kept.collect()) == [1, 2, 3]
    assert sorted(r.sequence_number for r in drop_self_referential(kept, psl).collect()) == [2, 3]
    flags = {r.sequence_number: r.no_names_error for r in no_names_error(kept).collect()}
    assert flags == {1: False, 2: False, 3: True}


def test_non_ascii_common_name(spark, psl):
    rows, status = run(spark, psl, [cert([("O", "Org"), ("CN", " Bücher.Example.COM ")], ["shop.example.com"])])
    assert ("example.com", "Bücher.Example.COM", "Org", "", "CN", 0) in rows
    assert ("example.com", "shop.example.com", "Org", "", "SAN", 0) in rows
    # an organisation equal to the IDNA form of a name is self-referential
    rows2, status2 = run(spark, psl, [cert([("O", "bücher.example.com"), ("CN", "Bücher.example.com")])])
    assert rows2 == [] and status2[0].skip_reason == "self_referential"
