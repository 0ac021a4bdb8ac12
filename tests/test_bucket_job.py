import base64
import gzip

from derutil import cert
from pyspark.sql import functions as F

from ctspark.operators import ledger as L
from ctspark.plans.bucket_job import process_bucket, read_ledger


def test_bucket_job_is_incremental(spark, psl, tmp_path):
    src = tmp_path / "bucket"
    (src / "p1").mkdir(parents=True)
    (src / "p2").mkdir(parents=True)

    def put(rel, lines):
        with gzip.open(src / rel, "wt") as fh:
            fh.write("\n".join(lines) + "\n")

    good = lambda s: f"{s} {base64.b64encode(cert([('O', 'Org'), ('CN', f'h{s}.example.com')])).decode()}"
    put("p1/a.gz", [good(1), good(2)])
    put("p2/a.gz", [good(3)])  # same basename under another prefix: outputs must not collide
    put("p2/bad.gz", [good(4), "not a line", good(5)])
    (src / "p2" / "notes.txt").write_text("ignored")
    out, led = str(tmp_path / "out"), str(tmp_path / "ledger")
    r1 = process_bucket(spark, str(src), out, led, fmt="jsonl", psl=psl)
    assert (r1["total_files"], r1["pending_files"]) == (3, 3)
    cur = {r.key.split("bucket/")[-1]: r for r in L.ledger_apply(read_ledger(spark, led)).collect()}
    assert cur["p1/a.gz"].status == "processed" and cur["p2/a.gz"].status == "processed"
    assert cur["p2/bad.gz"].status == "failed" and cur["p2/bad.gz"].error_msg.startswith("line does not match")
    rows = spark.read.json(out).select("sequence_number", "output_name").collect()
    # the failed file keeps the rows before its first bad line
    assert sorted(r.sequence_number for r in rows) == [1, 2, 3, 4]
    assert {r.output_name for r in rows} == {"p1/a.jsonl", "p2/a.jsonl", "p2/bad.jsonl"}
    # second run: processed files are skipped, the failed one is retried
    r2 = process_bucket(spark, str(src), out, led, fmt="jsonl", psl=psl)
    assert r2["pending_files"] == 1


def test_bucket_job_with_manifest_checks_integrity(spark, psl, tmp_path):
    import hashlib

    from ctspark.operators.objects import list_objects

    src = tmp_path / "b"
    src.mkdir()
    good = lambda s: f"{s} {base64.b64encode(cert([('O', 'Org'), ('CN', f'h{s}.example.com')])).decode()}"
    for name, seqs in (("ok.gz", [1]), ("badsize.gz", [2]), ("badmd5.gz", [3])):
        with gzip.open(src / name, "wt") as fh:
            fh.write("\n".join(good(s) for s in seqs) + "\n")
    listing = {r.key.rsplit("/", 1)[-1]: r for r in list_objects(spark, str(src)).collect()}
    md5 = {n: hashlib.md5((src / n).read_bytes()).hexdigest() for n in listing}
    manifest = spark.createDataFrame(
        [
            (listing["ok.gz"].key, listing["ok.gz"].size, f'"{md5["ok.gz"]}"'),
            (listing["badsize.gz"].key, listing["badsize.gz"].size + 1, md5["badsize.gz"]),
            (listing["badmd5.gz"].key, listing["badmd5.gz"].size, "0" * 32),
        ],
        "key string, size long, etag string",
    )
    out, led = str(tmp_path / "out"), str(tmp_path / "ledger")
    r = process_bucket(spark, str(src), out, led, psl=psl, manifest=manifest)
    assert r["pending_files"] == 3
    cur = {x.key.rsplit("/", 1)[-1]: x for x in L.ledger_apply(read_ledger(spark, led)).collect()}
    assert cur["ok.gz"].status == "processed"
    assert cur["badsize.gz"].status == "failed" and cur["badsize.gz"].error_msg.startswith("size mismatch")
    assert cur["badmd5.gz"].status == "failed" and cur["badmd5.gz"].error_msg.startswith("MD5 mismatch")
    assert [x.sequence_number for x in spark.read.json(out).collect()] == [1]


def test_bucket_job_survives_a_corrupt_file(spark, psl, tmp_path):
    src = tmp_path / "c"
    src.mkdir()
    good = lambda s: f"{s} {base64.b64encode(cert([('O', 'Org'), ('CN', f'h{s}.example.com')])).decode()}"
    with gzip.open(src / "fine.gz", "wt") as fh:
        fh.write(good(1) + "\n")
    (src / "broken.gz").write_bytes(b"this is not gzip data at all")
    out, led = str(tmp_path / "out"), str(tmp_path / "ledger")
    process_bucket(spark, str(src), out, led, psl=psl)
    cur = {x.key.rsplit("/", 1)[-1]: x for x in L.ledger_apply(read_ledger(spark, led)).collect()}
    assert cur["fine.gz"].status == "processed"
    assert cur["broken.gz"].status == "failed" and cur["broken.gz"].error_msg == "file is empty or unreadable"
    assert [x.sequence_number for x in spark.read.json(out).collect()] == [1]


def test_bucket_job_fails_damaged_files_only(spark, psl, tmp_path):
    src = tmp_path / "d"
    src.mkdir()
    good = lambda s: f"{s} {base64.b64encode(cert([('O', 'Org'), ('CN', f'h{s}.example.com')])).decode()}"
    whole = gzip.compress(("\n".join(good(s) for s in range(1, 300)) + "\n").encode())
    (src / "half.gz").write_bytes(whole[: len(whole) // 2])
    (src / "zero.gz").write_bytes(b"")
    (src / "nothing.gz").write_bytes(gzip.compress(b""))
    (src / "a b.gz").write_bytes(gzip.compress((good(1001) + "\n").encode()))
    (src / "c%20d+e.gz").write_bytes(gzip.compress(good(1002).encode()))
    (src / "two members.gz").write_bytes(gzip.compress((good(1003) + "\n").encode()) + gzip.compress((good(1004) + "\n").encode()))
    out, led = str(tmp_path / "out"), str(tmp_path / "ledger")
    r = process_bucket(spark, str(src), out, led, psl=psl)
    cur = {x.key.rsplit("/", 1)[-1]: (x.status, x.error_msg) for x in L.ledger_apply(read_ledger(spark, led)).collect()}
    assert cur == {
        "half.gz": ("failed", "unexpected end of file"),
        "zero.gz": ("failed", "file is empty or unreadable"),
        "nothing.gz": ("failed", "file is empty or unreadable"),
        "a b.gz": ("processed", ""),
        "c%20d+e.gz": ("processed", ""),
        "two members.gz": ("processed", ""),
    }
    assert sorted(x.sequence_number for x in spark.read.json(out).collect()) == [1001, 1002, 1003, 1004]
    assert {x.key.rsplit("/", 1)[-1]: x.status for x in r["status"].collect()} == {k: v[0] for k, v in cur.items()}
    assert process_bucket(spark, str(src), out, led, psl=psl)["pending_files"] == 3


def test_manifest_and_listing_need_not_agree(spark, psl, tmp_path):
    from ctspark.operators.objects import list_objects

    src = tmp_path / "m"
    src.mkdir()
    good = lambda s: f"{s} {base64.b64encode(cert([('O', 'Org'), ('CN', f'h{s}.example.com')])).decode()}\n"
    (src / "listed.gz").write_bytes(gzip.compress(good(1).encode()))
    key = list_objects(spark, str(src)).first().key
    manifest = spark.createDataFrame([(key.replace("listed", "gone"), 10, "x")], "key string, size long, etag string")
    out, led = str(tmp_path / "out"), str(tmp_path / "ledger")
    process_bucket(spark, str(src), out, led, psl=psl, manifest=manifest)
    cur = {x.key.rsplit("/", 1)[-1]: (x.status, x.error_msg) for x in L.ledger_apply(read_ledger(spark, led)).collect()}
    assert cur == {"listed.gz": ("processed", ""), "gone.gz": ("failed", "failed to stat file")}


def test_retry_plan_decides_what_is_tried_again(spark, psl, tmp_path):
    """E12 in T7: three runs at three times take three sets of files."""
    from datetime import datetime, timedelta

    from ctspark.operators.objects import list_objects
    from ctspark.plans.bucket_job import listing_with_fingerprint

    src, led = tmp_path / "r", str(tmp_path / "ledger")
    src.mkdir()
    good = lambda s: f"{s} {base64.b64encode(cert([('O', 'Org'), ('CN', f'h{s}.example.com')])).decode()}\n"
    for name, s in (("new", 1), ("slow", 2), ("denied", 3), ("spent", 4)):
        (src / f"{name}.gz").write_bytes(gzip.compress(good(s).encode()))
    t0 = datetime(2024, 1, 1)
    names = {r.key.rsplit("/", 1)[-1][:-3]: r for r in listing_with_fingerprint(spark, str(src)).collect()}
    past = [(names["slow"].key, names["slow"].etag, 0, t0, 1, "failed", "connection timeout"), (names["denied"].key, names["denied"].etag, 0, t0, 1, "failed", "AccessDenied: no permission")]
    past += [(names["spent"].key, names["spent"].etag, 0, t0 - timedelta(hours=20 - i), 1, "failed", "connection timeout") for i in range(20)]
    spark.createDataFrame(past, L.LEDGER_SCHEMA).write.parquet(led)
    plan = {r.key.rsplit("/", 1)[-1][:-3]: r for r in L.plan_retries(read_ledger(spark, led)).collect()}
    assert plan["slow"].action in ("RETRY", "WAIT") and plan["slow"].next_attempt_ts > t0 and plan["denied"].action in ("SKIP", "FAIL") and plan["spent"].action == "FAIL"

    def run(now):
        before = {(r.key, r.event_ts) for r in read_ledger(spark, led).collect()}
        process_bucket(spark, str(src), str(tmp_path / "out"), led, psl=psl, now=now, follow_retry_plan=True)
        return sorted(r.key.rsplit("/", 1)[-1][:-3] for r in read_ledger(spark, led).collect() if (r.key, r.event_ts) not in before)

    assert run(t0 + timedelta(milliseconds=1)) == ["new"]
    assert run(plan["slow"].next_attempt_ts) == ["slow"]
    (src / "denied.gz").write_bytes(gzip.compress((good(3) + good(5)).encode()))  # another file under the same key
    assert run(t0 + timedelta(days=1)) == ["denied"]
    assert run(t0 + timedelta(days=2)) == []
    assert list_objects(spark, str(src)).count() == 4


def test_listing_is_made_by_tasks_and_names_everything(spark, tmp_path):
    from ctspark.sources.remote import list_files

    root = tmp_path / "l"
    for rel, n in (("a.gz", 3), ("x/b c+%20é.gz", 0), ("x/y/z/d.gz", 5), ("_tmp/no.gz", 1), (".hid", 1), ("k=v/e.gz", 2)):
        (root / rel).parent.mkdir(parents=True, exist_ok=True)
        (root / rel).write_bytes(b"z" * n)
    got = {r.key: r.size for r in list_files(spark, str(root)).collect()}
    assert got == {f"file:{root}/{rel}": n for rel, n in (("a.gz", 3), ("x/b c+%20é.gz", 0), ("x/y/z/d.gz", 5), ("k=v/e.gz", 2))}
    scan = {r.path: r.modificationTime for r in spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(str(root)).select("path", "modificationTime").collect()}
    assert {r.key: r.last_modified for r in list_files(spark, str(root)).where("size > 0").collect()} == scan
    assert [r.size for r in list_files(spark, str(root), recursive=False).collect()] == [3]


def test_gzip_ends_and_whole_reads(spark, tmp_path):
    """Intact files are told by four bytes; others are decompressed in pieces."""
    import io
    import os
    import random

    import pytest

    from ctspark.sources import batch_files, remote

    body = random.Random(1).randbytes(3_000_000) + b"\0" * 5_000_000
    whole = gzip.compress(body)
    cases = {
        "whole": (whole, None), "members": (whole + gzip.compress(b"x"), None), "padded": (whole + b"\0" * 700, None), "cut": (whole[:-1], "unexpected end of file"), "half": (whole[: len(whole) // 2], "unexpected end of file"),
        "flipped": (whole[:1000] + bytes([whole[1000] ^ 1]) + whole[1001:], "any"), "tail": (whole + b"garbage", "file is empty or unreadable"), "empty": (gzip.compress(b""), "file is empty or unreadable"), "zero": (b"", "file is empty or unreadable"),
        "cut second": (whole + gzip.compress(b"x" * 99)[:-3], "unexpected end of file"), "noise": (os.urandom(50), "file is empty or unreadable"),
    }
    for name, (data, error) in cases.items():
        found = remote.inflate(io.BytesIO(data).read)
        assert found is not None if error == "any" else found == error, name
        (tmp_path / f"{name}.gz").write_bytes(data)
    files = remote.list_files(spark, str(tmp_path)).selectExpr("key AS file")
    told = {r.file.rsplit("/", 1)[-1]: (r.length, r.told) for r in remote.gzip_sizes(files).collect()}
    assert told["whole.gz"] == (len(whole), len(body)) and told["zero.gz"] == (0, None)
    by_task = {r.file.rsplit("/", 1)[-1][:-3]: r.file_error for r in remote.gzip_errors(files).collect()}
    assert by_task == {n: remote.inflate(io.BytesIO(d).read) for n, (d, _) in cases.items()}
    with pytest.raises(ValueError, match="empty.gz: file is empty or unreadable"):
        batch_files.read_batch_lines(spark, str(tmp_path), fail_on_empty=True)
    facts = {r.key.rsplit("/", 1)[-1]: r for r in remote.file_facts(files).collect()}
    import hashlib

    assert (facts["whole.gz"].actual_size, facts["whole.gz"].actual_md5) == (len(whole), hashlib.md5(whole).hexdigest())


def test_passes_of_a_few_files_and_a_run_that_breaks(spark, psl, tmp_path, monkeypatch):
    """The ledger has every finished pass, and the next run goes on behind it."""
    import pytest

    from ctspark.plans import bucket_job

    src, led, out = tmp_path / "p", str(tmp_path / "ledger"), str(tmp_path / "out")
    src.mkdir()
    good = lambda s: f"{s} {base64.b64encode(cert([('O', 'Org'), ('CN', f'h{s}.example.com')])).decode()}\n"
    for i in range(7):
        (src / f"f{i}.gz").write_bytes(gzip.compress(good(i).encode()) if i else b"")
    real, calls = bucket_job.run_files, []

    def breaking(*args, **kw):
        calls.append(1)
        if len(calls) == 3:
            raise RuntimeError("lost")
        return real(*args, **kw)

    monkeypatch.setattr(bucket_job, "run_files", breaking)
    with pytest.raises(RuntimeError, match="lost"):
        process_bucket(spark, str(src), out, led, psl=psl, files_per_pass=2)
    first = {r.key: r.status for r in read_ledger(spark, led).collect()}
    assert 0 < len(first) < 7
    monkeypatch.setattr(bucket_job, "run_files", real)
    r = process_bucket(spark, str(src), out, led, psl=psl, files_per_pass=2)
    assert r["pending_files"] == 7 - sum(s == "processed" for s in first.values())
    current = {x.key.rsplit("/", 1)[-1]: x.status for x in L.ledger_apply(read_ledger(spark, led)).collect()}
    assert current == {f"f{i}.gz": "processed" if i else "failed" for i in range(7)}
    assert sorted(x.sequence_number for x in spark.read.json(out).collect()) == list(range(1, 7))
