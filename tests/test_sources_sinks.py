import json

import pytest
from pyspark.sql import functions as F

from ctspark.sinks.writers import write_mappings
from ctspark.sources.pages import first_log, flatten_log_list

LOG_LIST = {
    "operators": [
        {"name": "A", "logs": [{"description": "Log One", "log_id": "id1", "url": "https://ct.example.com/logs/one/", "certspotter_download_jobs": 4, "certspotter_download_size": 256}]},
        {"name": "B", "logs": [{"description": "Log Two", "log_id": "id2", "url": "http://two.example.net:8080/", "certspotter_download_jobs": 2, "certspotter_download_size": 32}]},
    ]
}


def test_log_list(spark):
    docs = spark.createDataFrame([(json.dumps(LOG_LIST),)], "json string")
    logs = flatten_log_list(docs)
    assert logs.count() == 2
    f = first_log(logs).first()
    assert (f.description, f.download_size, f.file_name) == ("Log One", 256, "ct.example.com_logs_one")


MAPS = [("example.com", "www.example.com", 'Acme, "Inc"', "", "CN", 1), ("example.com", "api.example.com", "  Acme  ", "Unit", "SAN", 1), ("", "", "X", "", "CN", 2)]
SCHEMA = "domain string, name string, organization string, organizational_unit string, source string, sequence_number long"


def test_write_formats(spark, tmp_path):
    df = spark.createDataFrame(MAPS, SCHEMA)
    write_mappings(df, str(tmp_path / "t"), "TXT")
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "t")).collect()) == sorted(
        ['www.example.com -> Acme, "Inc" (CN) [seq:1]', "api.example.com ->   Acme   (SAN) [seq:1]"]
    )
    write_mappings(df, str(tmp_path / "c"), "csv")
    raw = "".join(open(p).read() for p in sorted((tmp_path / "c").glob("part-*.csv")))
    assert "Name,Organization,Source,SequenceNumber" in raw
    assert '"Acme, ""Inc"""' in raw and "  Acme  " in raw
    write_mappings(df, str(tmp_path / "j"), "json")
    rows = [json.loads(line) for p in sorted((tmp_path / "j" / "mappings").glob("part-*.json")) for line in open(p)]
    assert len(rows) == 2 and sum("organizational_unit" in r for r in rows) == 1
    with pytest.raises(ValueError):
        write_mappings(df, str(tmp_path / "x"), "xml")
    with pytest.raises(ValueError):
        write_mappings(df, " ", "json")


def test_entry_smoke(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.columns == ["domain", "name", "organization", "organizational_unit", "source", "sequence_number"]
    assert df.count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_json_document(spark, tmp_path):
    from ctspark.sinks.writers import write_json_document

    df = spark.createDataFrame(MAPS + [("example.org", "a.example.org", "A <&> B", "", "SAN", 3)], SCHEMA)
    write_json_document(df, str(tmp_path / "doc"), stats={"TotalProcessed": 3, "Errors": 0})
    text = "".join(open(p).read() for p in sorted((tmp_path / "doc").glob("part-*")))
    doc = json.loads(text)
    assert [m["sequence_number"] for m in doc["mappings"]] == [1, 1, 3]
    assert doc["stats"]["TotalProcessed"] == 3
    assert "\\u003c\\u0026\\u003e" in text and '\n  "mappings": [\n    {\n      "domain"' in text
    assert sum("organizational_unit" in m for m in doc["mappings"]) == 1
    write_json_document(df.limit(0), str(tmp_path / "none"))
    assert json.loads("".join(open(p).read() for p in sorted((tmp_path / "none").glob("part-*")))) == {"mappings": [], "stats": {}}


def test_per_source_outputs_are_idempotent_and_cleared(spark, tmp_path):
    from ctspark.sinks.writers import write_per_source

    df = spark.createDataFrame(MAPS, SCHEMA).selectExpr("*", "'a b.jsonl' AS output_name")
    more = df.unionByName(df.selectExpr("* EXCEPT (output_name)", "'x%y.jsonl' AS output_name"))
    both = more.select("output_name").distinct()
    for _ in range(2):
        write_per_source(more, str(tmp_path / "o"), sources=both)
    valid = 2  # one of the mappings has no name
    assert spark.read.json(str(tmp_path / "o")).count() == 2 * valid
    write_per_source(df, str(tmp_path / "o"), sources=both)  # the second source has no rows any more
    back = spark.read.json(str(tmp_path / "o"))
    assert back.count() == valid and {r.output_name for r in back.collect()} == {"a b.jsonl"}


def test_batches_in_index_order(spark, tmp_path):
    import gzip
    import random

    from ctspark.sinks.writers import write_batches

    idx = list(range(0, 250))
    random.Random(1).shuffle(idx)
    df = spark.createDataFrame([(i, bytes([i % 256, 1, 2])) for i in idx], "log_index long, der binary").repartition(5)
    write_batches(df, str(tmp_path / "b"), batch_size=100, mode="overwrite")
    dirs = sorted((tmp_path / "b").glob("batch_start=*"))
    assert [d.name for d in dirs] == ["batch_start=0", "batch_start=100", "batch_start=200"]
    for d in dirs:
        lines = [l for p in sorted(d.glob("*.gz")) for l in gzip.open(p, "rt").read().splitlines()]
        nums = [int(l.split(" ")[0]) for l in lines]
        assert nums == sorted(nums) and len(nums) == (50 if d.name.endswith("200") else 100)


def test_write_per_source_formats_and_rerun(spark, tmp_path):
    from ctspark.sinks.writers import write_per_source

    df = spark.createDataFrame([m + ("f1.csv",) for m in MAPS[:2]] + [("example.net", "x.example.net", "Y", "", "SAN", 9, "f2.csv")], SCHEMA + ", output_name string")
    write_per_source(df, str(tmp_path / "c"), "csv")
    parts = sorted(p.name for p in (tmp_path / "c").iterdir() if p.is_dir())
    assert parts == ["output_name=f1.csv", "output_name=f2.csv"]
    # a re-run for f2 only replaces f2's partition
    write_per_source(df.filter("output_name = 'f2.csv'").withColumn("organization", F.lit("Z")), str(tmp_path / "c"), "csv")
    back = spark.read.option("header", "true").option("escape", "\"").option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(str(tmp_path / "c"))
    assert sorted((r.output_name, r.Organization) for r in back.select("output_name", "Organization").collect()) == [
        ("f1.csv", "  Acme  "), ("f1.csv", 'Acme, "Inc"'), ("f2.csv", "Z")
    ]
    write_per_source(df, str(tmp_path / "t"), "txt")
    assert spark.read.text(str(tmp_path / "t")).count() == 3
