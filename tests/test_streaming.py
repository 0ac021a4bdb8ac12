import base64
import gzip
import json

from derutil import cert, x509_leaf

from ctspark.plans.bucket_job import read_ledger


def entries(start, n):
    return [{"leaf_input": base64.b64encode(x509_leaf(cert([("O", "Org"), ("CN", f"h{start + i}.example.com")]))).decode(), "extra_data": ""} for i in range(n)]


def put_pages(spark, log, pages, mode="append"):
    from ctspark.streaming.ct_source import write_log_dir

    rows = [(start, n if isinstance(n, str) else json.dumps({"entries": entries(start, n)})) for start, n in pages]
    write_log_dir(spark.createDataFrame(rows, "start long, json string"), str(log), mode)


def test_log_pages_of_any_size_lose_nothing(spark, tmp_path):
    """Short pages at odd starts, a bad page, a bounded trigger, a restart after growth."""
    from ctspark.streaming.ct_source import read_log
    from ctspark.streaming.ingest import start_ingest

    log, out, ck = tmp_path / "log", str(tmp_path / "out"), str(tmp_path / "ck")
    put_pages(spark, log, [(0, 70), (70, 70), (140, 60), (200, "{not json")])
    assert sorted(r.log_index for r in read_log(spark, str(log)).collect()) == list(range(200))
    assert [(r.log_index, r.page_error) for r in read_log(spark, str(log), keep_errors=True).where("page_error is not null").collect()] == [(200, "get-entries page cannot be decoded")]
    start_ingest(spark, str(log), out, ck, max_files_per_trigger=1).awaitTermination()
    put_pages(spark, log, [(201, 99)])
    start_ingest(spark, str(log), out, ck, max_files_per_trigger=1).awaitTermination()
    rows = spark.read.parquet(out).collect()
    assert sorted(r.log_index for r in rows) == list(range(300))
    assert [(r.log_index, r.error) for r in rows if r.error] == [(200, "get-entries page cannot be decoded")]
    assert all(r.line.startswith(f"{r.log_index} ") for r in rows if not r.error)


def test_empty_log_has_no_rows(spark, tmp_path):
    from ctspark.streaming.ct_source import read_log
    from ctspark.streaming.ingest import start_ingest

    assert read_log(spark, str(tmp_path / "none")).count() == 0
    start_ingest(spark, str(tmp_path / "none"), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    put_pages(spark, tmp_path / "none", [(5, 3)])
    start_ingest(spark, str(tmp_path / "none"), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    assert sorted(r.log_index for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [5, 6, 7]


def batch_files(out):
    """Lines of each batch by its start; a batch is one file."""
    found = {}
    for d in out.glob("batch_start=*"):
        files = sorted(d.glob("*.gz"))
        assert len(files) == 1, d
        found[int(d.name.split("=")[1])] = [int(x.split(" ")[0]) for x in gzip.open(files[0], "rt").read().splitlines()]
    return found


def test_replayed_micro_batch_changes_nothing(spark, tmp_path):
    from ctspark.operators.leaf import decode_leaf
    from ctspark.streaming.ct_source import read_log
    from ctspark.streaming.ingest import write_epoch

    out = tmp_path / "out"
    put_pages(spark, tmp_path / "log", [(0, 10)])
    df = decode_leaf(read_log(spark, str(tmp_path / "log")))
    for epoch, rows in ((0, "log_index < 6"), (0, "log_index < 6"), (1, "log_index >= 6"), (1, "log_index >= 6")):
        write_epoch(df.where(rows), epoch, str(out), 4)
        assert batch_files(out) == ({0: [0, 1, 2, 3]} if epoch == 0 else {0: [0, 1, 2, 3], 4: [4, 5, 6, 7]})


def test_batches_are_written_when_complete(spark, tmp_path):
    """K5: pages out of order and served twice, one a trigger; an unsupported entry counts; the rest waits for a flush."""
    from ctspark.streaming.ingest import flush_incomplete, start_ingest_to_batches

    log, out, ck = tmp_path / "log", tmp_path / "batches", str(tmp_path / "ck")
    bad = json.dumps({"entries": [{"leaf_input": base64.b64encode(b"\0\0" + b"\0" * 8 + b"\0\7" + b"\0" * 9).decode(), "extra_data": ""}]})

    def run():
        start_ingest_to_batches(spark, str(log), str(out), ck, batch_size=40, max_files_per_trigger=1).awaitTermination()
        return batch_files(out)

    put_pages(spark, log, [(70, 30), (0, 33)])
    assert run() == {}
    put_pages(spark, log, [(33, 6), (40, 30), (0, 33)])
    assert run() == {40: list(range(40, 80))}
    put_pages(spark, log, [(39, bad)])
    full = {0: list(range(39)), 40: list(range(40, 80))}
    assert run() == full
    flush_incomplete(spark, str(out), 40)
    assert batch_files(out) == full | {80: list(range(80, 100))}
    put_pages(spark, log, [(100, 20)])
    assert run() == full | {80: list(range(80, 120))}
    states = sorted(int(p.name.split("=")[1]) for p in (tmp_path / "batches_state").glob("epoch=*"))
    assert len(states) == 2 and states[1] == states[0] + 1  # older ones are gone


def test_entries_past_the_tree_head_wait(spark, tmp_path):
    """The head clips the range, never falls, and lets go when it has grown."""
    from ctspark.streaming.ct_source import read_log, tree_head, write_tree_head
    from ctspark.streaming.ingest import start_ingest_to_batches

    log, out, ck = tmp_path / "log", tmp_path / "out", str(tmp_path / "ck")
    put_pages(spark, log, [(0, 30), (30, 30)])
    assert tree_head(spark, str(log)) is None and read_log(spark, str(log), tree_size=None).count() == 60
    write_tree_head(spark, str(log), 25, 1)
    write_tree_head(spark, str(log), 7, 2)
    assert tree_head(spark, str(log)) == 25 and tree_head(spark, str(log), least=40) == 40
    assert sorted(r.log_index for r in read_log(spark, str(log), tree_size=25).collect()) == list(range(25))
    start_ingest_to_batches(spark, str(log), str(out), ck, batch_size=20).awaitTermination()
    assert batch_files(out) == {0: list(range(20))}
    write_tree_head(spark, str(log), 45, 3)
    put_pages(spark, log, [(60, 1)])  # an arrival starts a micro-batch
    start_ingest_to_batches(spark, str(log), str(out), ck, batch_size=20).awaitTermination()
    assert batch_files(out) == {0: list(range(20)), 20: list(range(20, 40))}


def test_replays_are_dropped_across_triggers_and_restarts(spark, tmp_path):
    """T4 as a stream: state by key in the checkpoint; an entry older than the watermark is late."""
    from ctspark.streaming.ingest import start_ingest

    log, out, ck = tmp_path / "log", str(tmp_path / "out"), str(tmp_path / "ck")
    for pages in ([(0, 20), (10, 20)], [(5, 30)]):
        put_pages(spark, log, pages)
        start_ingest(spark, str(log), out, ck, max_files_per_trigger=1, dedupe="10 days").awaitTermination()
    assert sorted(r.log_index for r in spark.read.parquet(out).collect()) == list(range(35))


def test_sliding_rates_equal_the_rolling_rate_at_window_ends(spark, tmp_path):
    """W5/W6 as a stream: out-of-order samples in several triggers against the batch form asked at the window ends."""
    import random
    from datetime import datetime, timedelta

    from ctspark.operators.monitor import rolling_rate, windowed_rate
    from ctspark.streaming.rates import current_rates, start_rate_stream

    rng, t0 = random.Random(4), datetime(2024, 1, 1)
    rows, value = [], {"a": 0, "b": 0}
    for i in range(300):
        key = rng.choice("ab")
        value[key] += rng.randint(0, 50)
        rows.append((key, t0 + timedelta(seconds=i * 7 + 0.5), value[key], i))
    schema = "endpoint string, ts timestamp, value long, event_id long"
    for at in range(0, 300, 100):
        part = rows[at : at + 100]
        rng.shuffle(part)
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", "1").parquet(str(tmp_path / "in")).drop("event_id")
    start_rate_stream(stream, str(tmp_path / "out"), str(tmp_path / "ck"), 120, 30, ("endpoint",), "1 hour").awaitTermination()
    got = {(r.endpoint, r.window_end): (r.samples, r.rate) for r in current_rates(spark, str(tmp_path / "out"), ("endpoint",)).collect()}
    batch = windowed_rate(spark.createDataFrame(rows, schema), 120, 30, ("endpoint",)).collect()
    assert got == {(r.endpoint, r.window_end): (r.samples, r.rate) for r in batch}
    # the rolling rate asked at a window's end, where the counter still has its last value
    for (endpoint, end), (samples, rate) in list(got.items())[::17]:
        mine = [r for r in rows if r[0] == endpoint and end - timedelta(seconds=120) <= r[1] < end]
        last = mine[-1]
        rolled = rolling_rate(spark.createDataFrame(mine, schema), 120, part=["endpoint"]).where(f"event_id = {last[3]}").first().rate
        assert (len(mine), rolled) == (samples, rate)


def test_saved_index(spark, tmp_path):
    """Replaced at once, 0 when missing or blank, an error when damaged, and never backwards."""
    import pytest

    from ctspark.operators.ordering import next_index
    from ctspark.streaming.checkpoint import commit_progress, load_index, save_index

    path = str(tmp_path / "state" / "index")
    assert load_index(spark, path) == 0
    for value in (0, 5, 1 << 40, (1 << 64) - 1):
        save_index(spark, path, value)
        assert load_index(spark, path) == value and (tmp_path / "state" / "index").read_text() == str(value)
    assert [p.name for p in (tmp_path / "state").iterdir() if not p.name.endswith(".crc")] == ["index"]
    for wrong in (-1, 1 << 64, "7", True):
        with pytest.raises(ValueError):
            save_index(spark, path, wrong)
    raw = tmp_path / "raw"
    for text, expected in (("", 0), (" \n", 0), ("12\n", 12)):
        raw.write_text(text)
        assert load_index(spark, str(raw)) == expected
    for text in ("x", "-1", "1.5", "1 2", str(1 << 64), "٣"):
        raw.write_text(text)
        with pytest.raises(ValueError, match="could not parse state file"):
            load_index(spark, str(raw))
    # a crash between writing and moving leaves the old value
    (tmp_path / "state" / "state-left.tmp").write_text("99")
    save_index(spark, path, 10)
    entries = spark.createDataFrame([(i,) for i in [*range(50), 60]], "log_index long")
    assert commit_progress(spark, entries, path) == 50 and load_index(spark, path) == 50
    assert commit_progress(spark, entries.where("log_index < 20"), path) == 50
    assert next_index(entries).first()[0] == 50


def test_extraction_stream_processes_new_files_once(spark, psl, tmp_path):
    import base64
    import gzip

    from derutil import cert

    from ctspark.streaming.extract_stream import start_extraction_stream

    src = tmp_path / "in"
    src.mkdir()

    def put(name, seqs):
        with gzip.open(src / name, "wt") as fh:
            for s in seqs:
                fh.write(f"{s} {base64.b64encode(cert([('O', 'Org'), ('CN', f'h{s}.example.com')])).decode()}\n")

    put("a.gz", [1, 2])
    put("b.GZ", [3])
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    start_extraction_stream(spark, str(src), out, ck, psl=psl).awaitTermination()
    schema = "domain string, name string, organization string, source string, sequence_number long, output_name string"
    first = sorted((r.sequence_number, r.domain) for r in spark.read.schema(schema).json(out).collect())
    assert first == [(1, "example.com"), (2, "example.com"), (3, "example.com")]
    put("c.gz", [4])
    start_extraction_stream(spark, str(src), out, ck, psl=psl).awaitTermination()
    rows = spark.read.schema(schema).json(out).collect()
    assert sorted(r.sequence_number for r in rows) == [1, 2, 3, 4]
    assert {r.output_name for r in rows} == {"a.jsonl", "b.GZ.jsonl", "c.jsonl"}


def test_extraction_stream_reports_bad_lines(spark, psl, tmp_path):
    from ctspark.streaming.extract_stream import start_extraction_stream

    src = tmp_path / "in"
    src.mkdir()
    good = lambda s: f"{s} {base64.b64encode(cert([('O', 'Org'), ('CN', f'h{s}.example.com')])).decode()}"
    with gzip.open(src / "a b.gz", "wt") as fh:
        fh.write("\n".join([good(1), "bad", good(2)]) + "\n")
    out = str(tmp_path / "out")
    start_extraction_stream(spark, str(src), out, str(tmp_path / "ck"), psl=psl).awaitTermination()
    assert [r.sequence_number for r in spark.read.json(out).collect()] == [1]
    events = read_ledger(spark, f"{out}_ledger").collect()
    assert len(events) == 1 and events[0].key.endswith("/a b.gz") and events[0].status == "failed" and events[0].error_msg.startswith("line does not match")
    assert spark.read.parquet(f"{out}_status").count() == 1


def test_extraction_stream_records_damaged_files_and_goes_on(spark, psl, tmp_path):
    """T7 as a stream: damaged files among good ones, one file a trigger; a restart adds nothing; an arrival is taken."""
    from ctspark.streaming.extract_stream import start_extraction_stream

    src, out, ck = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ck")
    src.mkdir()
    good = lambda s: f"{s} {base64.b64encode(cert([('O', 'Org'), ('CN', f'h{s}.example.com')])).decode()}\n"
    whole = gzip.compress("".join(good(s) for s in range(1, 300)).encode())
    (src / "half.gz").write_bytes(whole[: len(whole) // 2])
    (src / "zero.gz").write_bytes(b"")
    (src / "nothing.gz").write_bytes(gzip.compress(b""))
    (src / "fine.gz").write_bytes(gzip.compress(good(1001).encode()))
    (src / "noise.gz").write_bytes(b"no gzip data")

    def run():
        start_extraction_stream(spark, str(src), out, ck, psl=psl, max_files_per_trigger=1).awaitTermination()
        return sorted((r.key.rsplit("/", 1)[-1], r.status, r.error_msg) for r in read_ledger(spark, f"{out}_ledger").collect())

    first = run()
    assert first == [
        ("fine.gz", "processed", ""),
        ("half.gz", "failed", "unexpected end of file"),
        ("noise.gz", "failed", "file is empty or unreadable"),
        ("nothing.gz", "failed", "file is empty or unreadable"),
        ("zero.gz", "failed", "file is empty or unreadable"),
    ]
    assert run() == first
    (src / "more.gz").write_bytes(gzip.compress(good(1002).encode()))
    assert run() == sorted([*first, ("more.gz", "processed", "")])
    assert sorted(r.sequence_number for r in spark.read.json(out).collect()) == [1001, 1002]


def test_replayed_epoch_writes_the_same_events(spark, psl, tmp_path):
    from pyspark.sql import functions as F

    from ctspark.sources.remote import list_files
    from ctspark.streaming.extract_stream import write_epoch

    src, out, ledger = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ledger")
    src.mkdir()
    line = f"7 {base64.b64encode(cert([('O', 'Org'), ('CN', 'h7.example.com')])).decode()}\n"
    (src / "a.gz").write_bytes(gzip.compress(line.encode()))
    (src / "b.gz").write_bytes(gzip.compress(line.encode())[:-9])
    seen = []
    for _ in range(3):
        files = list_files(spark, str(src)).where(F.lower("key").endswith(".gz"))
        write_epoch(files, 4, str(src), out, ledger, "jsonl", psl)
        seen.append(sorted(tuple(r) for r in read_ledger(spark, ledger).collect()))
    assert len(seen[0]) == 2 and seen[0] == seen[1] == seen[2]
    assert [r.sequence_number for r in spark.read.json(out).collect()] == [7]
