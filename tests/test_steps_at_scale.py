"""Steps that must not grow faster than their input: partitions by rows, expressions computed once, bounded triggers, hashed windows."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def customers(spark, path, keys):
    rows = [(k, f"Customer {k}", "BUILDING") for k in keys]
    spark.createDataFrame(rows, "c_custkey long, c_name string, c_mktsegment string").coalesce(1).write.parquet(str(path / "customer.parquet"))
    return str(path)


def test_rows_are_dealt_out_by_their_number(spark, tmp_path):
    from ctspark.functions.steps import spread
    from ctspark.plans import fixtures as fx

    few = spark.range(100, numPartitions=1)
    assert spread(few).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert spread(few, 5).rdd.getNumPartitions() == 20 and spread(few, 5).count() == 100
    # a table in one piece does not have its certificates built in one task
    assert fx._ct_entries(spark, customers(spark, tmp_path, range(24))).rdd.getNumPartitions() > 1


def test_common_parts_of_certificates(spark):
    from ctspark.functions import der

    null = F.lit(None).cast("string")
    root = der.certificate_hex(F.lit("Fixture CA"), null, F.lit("Fixture Root"), F.array().cast("array<string>"), F.col("id"))
    row = spark.range(1, 2).select(root, der.name_hex(F.lit("Fixture CA"), null, F.lit("Fixture Root")), der.u24(der.u24(F.repeat(F.lit("00"), F.lit(200))))).first()
    assert tuple(row) == (der.ISSUER_CERTIFICATE, der.ISSUER, der.fixed_u24(der.fixed_u24("00" * 200)))
    for n in (0, 127, 128, 255, 256, 70_000):
        assert spark.range(1).select(der.tlv("04", F.repeat(F.lit("AB"), F.lit(n)))).first()[0] == der.fixed_tlv("04", "AB" * n)


def test_a_filter_on_the_error_does_not_decode_again(spark):
    from ctspark.operators.leaf import decode_leaf

    d = decode_leaf(spark.createDataFrame([], "log_index long, leaf_input string, extra_data string"))
    once = plan(spark.range(1).select(F.unbase64(F.lit("AA==")))).count("unbase64")
    assert once <= 1 and plan(d.where("error is null")).count("unbase64") <= plan(d).count("unbase64")


def test_names_are_listed_once_for_all_that_reads_them(spark, psl):
    from ctspark.operators.mappings import extract

    lines = spark.createDataFrame([(1, "AAAA")], "sequence_number long, certificate_data string").repartition(1)
    assert plan(extract(lines, psl)[0]).count("dns_names") < 12


def test_pages_are_parsed_once(spark):
    from ctspark.sources.pages import explode_entries

    pages = spark.createDataFrame([(0, '{"entries":[{"leaf_input":"AA==","extra_data":""}]}'), (5, "no")], "start long, json string").repartition(1)
    assert plan(explode_entries(pages)).lower().count("from_json") + plan(explode_entries(pages)).lower().count("jsontostructs") == 1
    assert [tuple(r) for r in explode_entries(pages).collect()] == [(0, "AA==", "")]
    assert sorted((r.log_index, r.page_error is None) for r in explode_entries(pages, keep_errors=True).collect()) == [(0, True), (5, False)]


def test_windows_of_samples_are_hashed(spark):
    from ctspark.operators.monitor import windowed_rate

    t0 = datetime(2024, 1, 1)
    # equal times: the smallest value is first and the largest last; a missing value comes before any
    rows = [("a", t0, 7), ("a", t0, -5), ("a", t0 + timedelta(seconds=4), 3), ("a", t0 + timedelta(seconds=4), 11), ("b", t0, 5), ("b", t0, None), ("b", t0 + timedelta(seconds=2), 2**62)]
    s = spark.createDataFrame(rows, "endpoint string, ts timestamp, value long").repartition(3)
    r = windowed_rate(s, 10, 10, ("endpoint",))
    assert "SortAggregate" not in r._jdf.queryExecution().executedPlan().toString()
    expected = [("a", 4, 4.0), ("b", 3, None)]
    assert sorted((x.endpoint, x.samples, x.rate) for x in r.collect()) == expected
    real = s.withColumn("value", F.col("value").cast("double"))
    assert sorted((x.endpoint, x.samples, x.rate) for x in windowed_rate(real, 10, 10, ("endpoint",)).collect()) == expected


def test_triggers_do_not_grow_with_the_log(spark, tmp_path):
    from ctspark.plans import catalog

    here = customers(spark, tmp_path, range(0, 30_000, 100))  # 300 pages of one entry
    assert catalog._per_trigger(spark, here, 2) * catalog.TRIGGERS >= 300
    assert catalog._per_trigger(spark, here, 40) == 40


def test_a_log_longer_than_a_month_loses_no_entry(spark, tmp_path):
    """The stream's delay covers the entries' time, whatever the order of pages."""
    from ctspark.plans import catalog

    here = customers(spark, tmp_path, range(0, 120 * 40_000, 40_000))  # 55 days
    rows = catalog.QUERIES["stream_dedupe"][0](spark, here).collect()
    assert len(rows) == 120 and {r.times for r in rows} == {1}


def test_certificates_of_the_bucket_are_parsed_once(spark, psl, tmp_path, monkeypatch):
    import base64
    import gzip

    from derutil import cert

    from ctspark.plans import bucket_job

    src, kept = tmp_path / "in", []
    src.mkdir()
    (src / "a.gz").write_bytes(gzip.compress(f"1 {base64.b64encode(cert([('O', 'Org'), ('CN', 'h.example.com')])).decode()}\n".encode()))
    real = bucket_job.keep
    monkeypatch.setattr(bucket_job, "keep", lambda df, name: kept.append(name) or real(df, name))
    written = []
    write = bucket_job.write_per_source
    monkeypatch.setattr(bucket_job, "write_per_source", lambda df, *a, **k: written.append(plan(df)) or write(df, *a, **k))
    bucket_job.process_bucket(spark, str(src), str(tmp_path / "out"), str(tmp_path / "ledger"), psl=psl)
    assert kept.count("mappings") == 1 and "MapInArrow" not in written[0]
    assert [r.sequence_number for r in spark.read.json(str(tmp_path / "out")).collect()] == [1]


def most_tasks(spark, group):
    """The most tasks that any stage of a job group had."""
    told = spark.sparkContext.statusTracker()
    stages = [told.getStageInfo(s) for j in told.getJobIdsForGroup(group) for s in told.getJobInfo(j).stageIds]
    return max((s.numTasks for s in stages if s), default=0)


def test_pages_are_listed_in_few_tasks_and_written_in_many(spark, tmp_path):
    from ctspark.session import LISTING_TASKS
    from ctspark.streaming import ct_source
    from ctspark.streaming.ingest import start_ingest

    cores = spark.sparkContext.defaultParallelism
    n = (LISTING_TASKS + 1) * cores + 40
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    spark.conf.set(key, "10000")
    pages = spark.range(0, n, 1, 1).selectExpr("id AS start", """'{"entries":[{"leaf_input":"AA==","extra_data":""}]}' AS json""")
    try:
        spark.sparkContext.setJobGroup("pages-written", "")
        ct_source.write_log_dir(pages, f"{tmp_path}/log")
        spark.sparkContext.setJobGroup("pages-listed", "")
        read = ct_source.read_log(spark, f"{tmp_path}/log")
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    assert most_tasks(spark, "pages-written") >= cores
    assert 0 < most_tasks(spark, "pages-listed") <= LISTING_TASKS * cores
    assert sorted(r.log_index for r in read.collect()) == list(range(n))
    spark.conf.set(key, "10000")
    q = start_ingest(spark, f"{tmp_path}/log", f"{tmp_path}/out", f"{tmp_path}/ckpt")
    q.awaitTermination()
    assert most_tasks(spark, str(q.runId)) < n
    assert spark.read.parquet(f"{tmp_path}/out").count() == n
    spark.conf.set(key, "7")  # a lower setting stays
    ct_source.read_log(spark, f"{tmp_path}/log")
    assert spark.conf.get(key) == "7"
    spark.conf.set(key, "10000")


def test_batch_files_are_listed_in_few_tasks(spark, tmp_path):
    from ctspark.session import LISTING_TASKS
    from ctspark.sinks.writers import write_batches
    from ctspark.sources.batch_files import read_batch_lines

    cores = spark.sparkContext.defaultParallelism
    n = (LISTING_TASKS + 1) * cores + 40
    spark.conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism", "10000")
    write_batches(spark.range(n).selectExpr("id AS log_index", "encode('x', 'UTF-8') AS der"), f"{tmp_path}/batches", batch_size=1)
    try:
        spark.sparkContext.setJobGroup("batches-listed", "")
        lines = read_batch_lines(spark, f"{tmp_path}/batches", recursive=True)
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    assert 0 < most_tasks(spark, "batches-listed") <= LISTING_TASKS * cores
    assert lines.count() == n


def test_hosts_do_not_meet_by_their_suffix(spark, psl):
    """Whatever the session's threshold, hosts are looked up where they are: nearly all share the key "com"."""
    from ctspark.operators.hosts import registered_domain

    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        d = registered_domain(spark.range(3).selectExpr("concat('www.c', id, '.example.com') AS host"), "host", psl)
        assert "SortMergeJoin" not in d._jdf.queryExecution().executedPlan().toString()
        assert sorted(r.domain for r in d.collect()) == ["example.com"] * 3
    finally:
        spark.conf.set(key, before)


def test_pages_are_built_in_tasks_by_entries(spark, tmp_path):
    from ctspark.plans import fixtures as fx

    pages = fx._ct_pages(spark, customers(spark, tmp_path, range(250)))
    assert "RepartitionByExpression" in plan(pages)
    assert sorted((r.start, r.json.count("leaf_input")) for r in pages.collect()) == [(0, 100), (100, 100), (200, 50)]
