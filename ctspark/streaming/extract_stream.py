"""T7 as a stream: new batch files in a folder -> mapping outputs and ledger events.

The stream reads names, sizes and times of new files (the file source's columns without the content),
which the query checkpoint remembers; every micro-batch then runs the bucket job's plan over its files
through ``foreachBatch``.  Outputs are written with dynamic partition overwrite per source file and
ledger events under ``epoch=<id>`` with overwrite, both with the micro-batch's own times, so a replay
adds nothing.  Entries' status lies beside the outputs by epoch.  A damaged, empty or malformed file is an event with its reason and stops neither
the micro-batch nor the stream.  Files without any bytes, which file sources leave out, come from a listing.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import ledger as L
from ..operators.hosts import PublicSuffixTable, default_psl
from ..plans.bucket_job import listing_with_fingerprint, read_ledger, run_files
from ..session import keep, path_exists


def new_files_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming (key, size, last_modified) of the *.gz files that arrive under ``path``; contents are not read."""
    r = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("pathGlobFilter", "*.[gG][zZ]").option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path).select(F.col("path").alias("key"), F.col("length").alias("size"), F.col("modificationTime").alias("last_modified"))


def write_epoch(files: DataFrame, epoch_id: int, input_path: str, output_path: str, ledger_path: str, fmt: str, psl: PublicSuffixTable) -> None:
    """One micro-batch: the files' outputs, and their ledger events under ``epoch=<id>``.

    The events' time is that of the newest file seen, so a replay writes the same events.  A file that an
    earlier epoch or run has processed at its present state is left.
    """
    spark = files.sparkSession
    at = f"{ledger_path.rstrip('/')}/epoch={epoch_id}"
    etag = F.concat(F.col("size").cast("string"), F.lit("-"), F.unix_micros("last_modified").cast("string"))
    files = keep(files.withColumn("etag", etag), "epoch")
    newest = files.agg(F.max("last_modified")).first()[0] or datetime(1970, 1, 1)
    void = listing_with_fingerprint(spark, input_path).where((F.col("size") == 0) & F.lower("key").endswith(".gz"))
    seen = files.unionByName(void).withColumn("present", F.col("size") > 0).withColumn("void", F.col("size") == 0)
    events = read_ledger(spark, ledger_path)
    if path_exists(spark, at):  # a replay: what this epoch has written does not count
        own = spark.read.schema(L.LEDGER_SCHEMA).parquet(at).select("key", "etag")
        events = keep(events.join(own, ["key", "etag"], "left_anti"), "earlier")
    current = L.ledger_apply(events)
    pending = L.pending_files(seen, current)
    # an empty file is told once
    pending = keep(pending.join(current.where("status = 'failed'").select("key", "etag", F.lit(True).alias("void")), ["key", "etag", "void"], "left_anti"), "pending")
    done = keep(run_files(spark, pending, input_path, output_path, psl, fmt, newest, status_path=f"{output_path.rstrip('/')}_status/epoch={epoch_id}"), "events")
    done.write.mode("overwrite").parquet(at)


def start_extraction_stream(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    checkpoint: str,
    fmt: str = "jsonl",
    psl: PublicSuffixTable | None = None,
    available_now: bool = True,
    interval: str = "1 minute",
    max_files_per_trigger: int | None = None,
    ledger_path: str | None = None,
):
    """Start the stream; the ledger lies at ``ledger_path``, or beside the outputs as ``<output_path>_ledger``."""
    psl = psl or default_psl(spark)
    ledger = ledger_path or f"{output_path.rstrip('/')}_ledger"

    def run_batch(df: DataFrame, epoch_id: int) -> None:
        write_epoch(df, epoch_id, input_path, output_path, ledger, fmt, psl)

    w = new_files_stream(spark, input_path, max_files_per_trigger).writeStream.foreachBatch(run_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)
    return w.start()
