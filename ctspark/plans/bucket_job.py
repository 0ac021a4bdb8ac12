"""The incremental bucket job, as one Spark plan per run.

listing (metadata only) -> F7 filter -> J1 pending against the ledger, by the plan of E12 if wanted ->
read only the pending files -> S2 parse (abort-file semantics) -> P10 extraction -> K6 per-source outputs -> T5
ledger events appended.  A failed file is recorded as failed and the others go on; a re-run
skips files whose (key, fingerprint) is already processed and overwrites only the outputs it
produces.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import ledger as L
from ..operators.hosts import OUTPUT_EXT, PublicSuffixTable, default_psl
from ..operators.mappings import extract
from ..operators.objects import filter_objects, list_objects, verify_integrity
from ..session import keep
from ..sinks.writers import write_per_source
from ..sources.batch_files import damaged_files, parse_lines, read_batch_lines
from ..sources.remote import UNREADABLE, file_facts


def listing_with_fingerprint(spark: SparkSession, path: str) -> DataFrame:
    """S6 listing plus an ETag stand-in from metadata (size and modification time), so that
    a changed file is pending again without reading any content."""
    o = list_objects(spark, path).select("key", "size", "last_modified")
    return o.withColumn("etag", F.concat(F.col("size").cast("string"), F.lit("-"), F.unix_micros(F.col("last_modified")).cast("string")))


def read_ledger(spark: SparkSession, ledger_path: str) -> DataFrame:
    """The ledger event table; empty on the first run."""
    from ..session import path_exists

    if path_exists(spark, ledger_path):
        return spark.read.schema(L.LEDGER_SCHEMA).option("recursiveFileLookup", "true").parquet(ledger_path)
    return spark.createDataFrame([], L.LEDGER_SCHEMA)


_SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?"


def relative_output_name(key, root: str, fmt: str):
    """Output name from the key relative to the input root ('.gz' dropped, format extension
    added); keeping the sub-path avoids collisions between equal basenames.  File-system
    schemes (file:, hdfs://host, s3a://bucket) are ignored on both sides."""
    import re

    root_path = re.sub(_SCHEME, "", root).rstrip("/")
    rel = F.regexp_replace(F.regexp_replace(key, _SCHEME, ""), "^" + re.escape(root_path) + "/?", "")
    rel = F.regexp_replace(rel, r"\.gz\z", "")
    return F.concat(rel, F.lit(OUTPUT_EXT.get(fmt, ".json")))


def process_bucket(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    ledger_path: str,
    fmt: str = "jsonl",
    extensions=(".gz",),
    min_size: int = 0,
    max_size: int = 0,
    psl: PublicSuffixTable | None = None,
    now: datetime | None = None,
    manifest: DataFrame | None = None,
    follow_retry_plan: bool = False,
    files_per_pass: int = 20_000,
) -> dict:
    """Run one incremental pass.

    ``manifest`` (key, size, etag) replaces the metadata fingerprint with real ETags; pending files
    are then checked with J2 (existence, size, and MD5 for single-part ETags) and a file that fails
    the check is recorded as failed, not read.  A listed file that the manifest lacks keeps its
    fingerprint and is read unchecked.  A file whose gzip data end early, are damaged or are empty is
    recorded as failed with its reason, and none of its rows are published.

    With ``follow_retry_plan`` a failed file waits for its next attempt by the plan of E12, and one that
    the plan gives up is left until its ETag changes; without it every run tries failed files again.

    Every pending file is decompressed once: its parsed lines are written to the shared checkpoint folder,
    and the outputs and the ledger both come from there.  Files are dealt to passes of about ``files_per_pass``, and the
    ledger is appended after each, so a broken run goes on behind its last pass and no reader gets more names at once.
    """
    psl = psl or default_psl(spark)
    now = now or datetime.now(timezone.utc).replace(tzinfo=None)
    listing = listing_with_fingerprint(spark, input_path).withColumn("present", F.col("size") > 0).withColumn("void", F.col("size") == 0).withColumn("checked", F.lit(False))
    if manifest is not None:
        m = manifest.select("key", F.col("size").alias("m_size"), F.col("etag").alias("m_etag"))
        listing = listing.join(m, "key", "full_outer").select(
            "key",
            F.coalesce("m_size", "size").alias("size"),
            F.coalesce("m_etag", "etag").alias("etag"),
            "last_modified",
            F.coalesce("present", F.lit(False)).alias("present"),
            F.coalesce("void", F.lit(False)).alias("void"),
            F.col("m_etag").isNotNull().alias("checked"),
        )
    listing = keep(filter_objects(listing, list(extensions), min_size, max_size), "listing")
    events = read_ledger(spark, ledger_path)
    pending = L.pending_files(listing, L.ledger_apply(events))
    if follow_retry_plan:
        pending = due_files(pending, L.plan_retries(events), now)
    pending = keep(pending, "pending")
    total, n_pending = listing.count(), pending.count()
    if not n_pending:
        return {"total_files": total, "pending_files": 0, "status": None}
    bad = None
    if manifest is not None:
        facts = file_facts(pending.filter("present and checked").select(F.col("key").alias("file")))
        checked = verify_integrity(pending.filter("checked and not void").select("key", "size", "etag"), facts)
        bad = keep(checked.filter(~F.col("ok")).select(F.col("key").alias("file"), F.col("integrity_error").alias("file_error")), "bad")
    passes, status = -(-n_pending // files_per_pass), None
    for i in range(passes):
        part = pending.filter(F.pmod(F.xxhash64("key"), F.lit(passes)) == i)
        done = keep(run_files(spark, part, input_path, output_path, psl, fmt, now, bad), "events")
        done.write.mode("append").parquet(ledger_path)
        status = done if status is None else status.unionByName(done)
    return {"total_files": total, "pending_files": n_pending, "status": status}


def due_files(pending: DataFrame, plan: DataFrame, now: datetime) -> DataFrame:
    """J1 pending files without those that failed at the same ETag and wait for a later attempt, or get none any more."""
    waits = F.col("action").isin("FAIL", "SKIP") | (F.col("next_attempt_ts") > F.lit(now).cast("timestamp"))
    return pending.join(plan.filter(waits).select("key", "etag"), ["key", "etag"], "left_anti")


def run_files(spark: SparkSession, pending: DataFrame, input_path: str, output_path: str, psl: PublicSuffixTable, fmt: str, now: datetime, bad: DataFrame | None = None, status_path: str | None = None) -> DataFrame:
    """Extract the files of ``pending`` (key, size, etag, present, void) to per-source outputs; their ledger events.

    ``bad`` (file, file_error) has files that are not to be read.  No failure of a file stops the others.
    With ``status_path`` every entry's status is written there.
    """
    if bad is None:
        bad = spark.createDataFrame([], "file string, file_error string")
    void = pending.filter("void").select(F.col("key").alias("file"), F.lit(UNREADABLE).alias("file_error"))
    # what is known of other files does not matter here
    errs = bad.join(pending.select(F.col("key").alias("file")), "file", "left_semi").unionByName(void)
    files = pending.filter("present").select(F.col("key").alias("file")).join(bad.select("file"), "file", "left_anti")
    # a file source takes its files as a list, which its index holds on the driver in any case
    paths = [r.file for r in files.collect()]
    if paths:
        lines = read_batch_lines(spark, paths, ignore_corrupt=True, with_size=True)
        parsed = keep(parse_lines(lines).select("file", "line_id", "n_bytes", "error", "sequence_number", "certificate_data"), "lines")
        per_file = parsed.groupBy("file").agg(F.sum("n_bytes").alias("n_bytes"), F.min(F.when(F.col("error").isNotNull(), F.struct("line_id", "error"))).alias("first"))
        damaged = keep(damaged_files(files, per_file.select("file", "n_bytes")), "damaged")
        file_err = per_file.select("file", F.col("first.error").alias("file_error"), F.col("first.line_id").alias("first_bad")).filter(F.col("file_error").isNotNull())
        # a file fails at its first bad line: the lines before it are still processed
        ok = (
            parsed.join(damaged.select("file"), "file", "left_anti")
            .join(file_err.select("file", "first_bad"), "file", "left")
            .filter(F.col("error").isNull() & (F.col("first_bad").isNull() | (F.col("line_id") < F.col("first_bad"))))
            .select("file", "sequence_number", "certificate_data")
        )
        errs = errs.unionByName(damaged).unionByName(file_err.select("file", "file_error").join(damaged.select("file"), "file", "left_anti"))
        mappings, status = extract(ok, psl, keep=("file",))
        # certificates are parsed once: the outputs are written from what is kept, and the sources without rows found in it
        out = keep(mappings.withColumn("output_name", relative_output_name(F.col("file"), input_path, fmt)).drop("file", "position"), "mappings")
        done = pending.filter("present").select(relative_output_name(F.col("key"), input_path, fmt).alias("output_name"))
        write_per_source(out, output_path, fmt, sources=done)
        if status_path:
            status.write.mode("overwrite").parquet(status_path)
    return _events(pending, errs, now)


def _events(pending: DataFrame, file_err: DataFrame, now) -> DataFrame:
    """T5 events of this run: processed, or failed with the file's first error."""
    return pending.join(file_err.select(F.col("file").alias("key"), "file_error"), "key", "left").select(
        "key",
        "etag",
        F.when(F.col("file_error").isNull(), F.col("size")).otherwise(F.lit(0)).cast("long").alias("size"),
        F.lit(now).cast("timestamp").alias("event_ts"),
        F.lit(1).alias("seq"),
        F.when(F.col("file_error").isNull(), F.lit("processed")).otherwise(F.lit("failed")).alias("status"),
        F.coalesce(F.col("file_error"), F.lit("")).alias("error_msg"),
    )
