import datetime as dt

from pyspark.sql import functions as F

from ctspark.operators import ledger, objects, stats

T0 = dt.datetime(2024, 1, 1)
OBJS = [
    ("ct/oak-0.gz", 700, "etag1", T0),
    ("ct/oak-1.gz", 1900, "etag2", T0 + dt.timedelta(hours=1)),
    ("ct/oak-2.csv", 300, "etag3", T0 + dt.timedelta(hours=2)),
    ("other/elm.txt", 4500, "etag4", T0 + dt.timedelta(hours=3)),
    ("ct/oak-3.gz", 9001, "etag5", T0 + dt.timedelta(hours=4)),
]


def test_filter_and_totals(spark):
    df = spark.createDataFrame(OBJS, "key string, size long, etag string, last_modified timestamp")
    assert objects.filter_objects(df, [".gz"]).count() == 3
    assert objects.filter_objects(df, (), 600, 5000).count() == 3
    assert objects.filter_objects(df, [".gz"], 1500).count() == 2
    assert df.filter(F.col("key").startswith("ct/")).count() == 4
    t = objects.object_totals(objects.filter_objects(df, [".gz"])).first()
    assert (t.object_count, t.total_bytes) == (3, 11601)


def test_pending_skips_processed(spark):
    objs = spark.createDataFrame(OBJS[:2], "key string, size long, etag string, last_modified timestamp")
    ev = spark.createDataFrame([("ct/oak-0.gz", "etag1", 1024, T0, 1, "processed", "")], ledger.LEDGER_SCHEMA)
    cur = ledger.ledger_apply(ev)
    pend = ledger.pending_files(objs, cur)
    assert [r.key for r in pend.collect()] == ["ct/oak-1.gz"]
    # same key, new etag -> pending again; a later failure replaces the success
    ev2 = spark.createDataFrame(
        [("ct/oak-0.gz", "old", 1024, T0, 1, "processed", ""), ("ct/oak-1.gz", "etag2", 2048, T0, 1, "processed", ""), ("ct/oak-1.gz", "etag2", 5, T0 + dt.timedelta(hours=1), 2, "failed", "boom")],
        ledger.LEDGER_SCHEMA,
    )
    cur2 = ledger.ledger_apply(ev2)
    assert sorted(r.key for r in ledger.pending_files(objs, cur2).collect()) == ["ct/oak-0.gz", "ct/oak-1.gz"]
    f = cur2.filter(F.col("status") == "failed").first()
    assert f.size == 0 and f.error_msg == "boom"


def test_download_stats(spark):
    df = spark.createDataFrame([(True, 700, 1000.0, 0), (False, 300, 2000.0, 2), (True, 1900, 1000.0, 1)], "success boolean, bytes long, duration_ms double, retries int")
    s = stats.download_stats(df).first()
    assert (s.total_downloads, s.successful_downloads, s.failed_downloads, s.total_bytes, s.retry_count) == (3, 2, 1, 2900, 3)
    assert abs(s.success_rate - 66.666667) < 1e-6
    empty = stats.download_stats(df.limit(0)).first()
    assert empty.total_downloads == 0 and empty.success_rate == 0.0 and empty.avg_speed_mbps == 0.0


def test_ledger_recover(spark):
    good = '{"processed_files":{"a":{"key":"a","etag":"e1","size":3,"processed_at":"2024-01-01T00:00:00Z"}},"failed_files":{"b":{"key":"b","etag":"e2","size":0,"processed_at":"2024-01-01T00:00:00Z","error_msg":"x"}}}'
    bad_entry = '{"processed_files":{"c":{"key":"","etag":"e","size":1,"processed_at":"nope"}},"version":"1.0"}'
    whole = '{"processed_files":{"w":{"key":"","etag":"e","size":1}},"failed_files":{},"version":"1.0"}'
    df = spark.createDataFrame([(good,), (bad_entry,), ('{"processed_files": {"a"',), (whole,)], "value string")
    out = sorted((r.key, r.status) for r in ledger.ledger_recover(df).collect())
    # no version: recovered entry by entry; bad time: recovery drops the entry; truncated: nothing;
    # a well-formed document is taken whole, as loaded
    assert out == [("", "processed"), ("a", "processed"), ("b", "failed")]


def test_human_units(spark):
    df = spark.createDataFrame([(512,), (1536,), (1280,), (5 * 1024 * 1024,)], "b long")
    assert [r.h for r in df.select(stats.human_bytes(F.col("b")).alias("h")).collect()] == ["512 B", "1.5 KB", "1.2 KB", "5.0 MB"]


def test_list_objects_prefix(spark, tmp_path):
    for rel in ("ct/oak-0.gz", "ct/oak-1.gz", "ct/oak-2.csv", "other/elm.txt", "ct/oak-3.gz"):
        p = tmp_path / rel
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_bytes(b"x" * 10)
    assert objects.list_objects(spark, str(tmp_path), prefix="ct/").count() == 4
    rel = sorted(r.rel_key for r in objects.list_objects(spark, str(tmp_path)).collect())
    assert rel[0] == "ct/oak-0.gz" and rel[-1] == "other/elm.txt"
