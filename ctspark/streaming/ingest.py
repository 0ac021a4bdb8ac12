"""Continuous or fixed-range ingest of a CT log.

``start_ingest`` runs log folder -> leaf decode -> sink, with ``trigger(availableNow=True)`` up to the
pages present or ``processingTime`` as a follower.  The streaming checkpoint holds what was read:
a restart goes on from there.  With ``dedupe`` replayed entries are dropped by T4's streaming form.

``start_ingest_to_batches`` writes batch files (K5).  A batch is written once, when its last index is
there; until then its entries wait in a table beside the output, one folder per micro-batch: a micro-batch takes
what the one before left and leaves what is still incomplete, or past the tree head.  All it writes is overwritten by its
replay, which starts from the same folder, so a crash at any point loses and doubles nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.encoding import base64_line
from ..operators.leaf import decode_leaf
from ..operators.ordering import assign_batches, dedupe_stream
from ..session import delete, keep, path_exists
from .ct_source import below, log_stream, tree_head


def _decoded(spark: SparkSession, log_dir: str, max_files_per_trigger: int | None) -> DataFrame:
    """Decoded leaves; a page that cannot be read is one row whose ``error`` says so."""
    d = decode_leaf(log_stream(spark, log_dir, max_files_per_trigger))
    return d.withColumn("error", F.coalesce("page_error", "error")).drop("page_error")


def ingest_stream(spark: SparkSession, log_dir: str, log_name: str = "log0", max_files_per_trigger: int | None = None, dedupe: str | None = None) -> DataFrame:
    """Streaming DataFrame (log, log_index, timestamp_ms, line, error) of a log folder.

    ``dedupe`` is how far replays reach back in the entries' own time ("7 days"): an entry seen within it is
    dropped.  Entries without a time (pages that cannot be read) are kept out of this and are not passed on.
    """
    d = _decoded(spark, log_dir, max_files_per_trigger)
    if dedupe:
        d = dedupe_stream(d.where("timestamp_ms is not null").withColumn("event_ts", F.timestamp_millis("timestamp_ms")), dedupe, ("log_index",))
    line = F.when(F.col("error").isNull(), F.concat(F.col("log_index").cast("string"), F.lit(" "), base64_line(F.col("der"))))
    return d.select(F.lit(log_name).alias("log"), "log_index", "timestamp_ms", line.alias("line"), "error")


def _trigger(writer, continuous: bool, interval: str):
    return writer.trigger(processingTime=interval) if continuous else writer.trigger(availableNow=True)


def start_ingest(spark: SparkSession, log_dir: str, out_path: str, checkpoint: str, continuous: bool = False, interval: str = "5 minutes", **kw):
    """Write decoded entries, errors included, as parquet; availableNow stops at the last page."""
    q = ingest_stream(spark, log_dir, **kw).writeStream.format("parquet").option("path", out_path).option("checkpointLocation", checkpoint)
    return _trigger(q, continuous, interval).start()


def _state(out_path: str, epoch_id: int) -> str:
    return f"{out_path.rstrip('/')}_state/epoch={epoch_id}"


def _waiting(spark: SparkSession, out_path: str, epoch_id: int) -> DataFrame:
    """(log_index, line) that the micro-batch before ``epoch_id`` left; a null line is an entry without one."""
    before = _state(out_path, epoch_id - 1)
    if epoch_id > 0 and path_exists(spark, before):
        return spark.read.schema(WAITING).parquet(before)
    return spark.createDataFrame([], WAITING)


WAITING = "log_index long, line string"


def write_epoch(df: DataFrame, epoch_id: int, out_path: str, batch_size: int, tree_size: int | None = None) -> None:
    """One micro-batch of decoded leaves: the batches it completes, as one gzip file each under ``batch_start=<index>``; the rest waits.

    An index whose entry has no line (an unsupported type) counts for its batch.  An index given again is
    the same entry; a batch given again as a whole is written again with the same lines.  Errors go to
    ``<out_path>_errors``.
    """
    spark = df.sparkSession
    line = F.when(F.col("error").isNull(), F.concat(F.col("log_index").cast("string"), F.lit(" "), base64_line(F.col("der"))))
    # a page that cannot be read stands for no index
    here = df.where("timestamp_ms is not null").select("log_index", line.alias("line"))
    rows = _waiting(spark, out_path, epoch_id).unionByName(here).groupBy("log_index").agg(F.max("line").alias("line"))
    rows = keep(assign_batches(rows, "log_index", batch_size), "ingest")
    full = below(rows, tree_size).groupBy("batch_start").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == batch_size).select("batch_start")
    _write_lines(rows.join(full, "batch_start"), out_path)
    rows.join(full, "batch_start", "left_anti").select("log_index", "line").write.mode("overwrite").parquet(_state(out_path, epoch_id))
    df.filter(F.col("error").isNotNull()).select("log_index", "error").write.mode("overwrite").json(f"{out_path}_errors/epoch={epoch_id}")
    delete(spark, _state(out_path, epoch_id - 2))


def _write_lines(rows: DataFrame, out_path: str) -> None:
    """Batch files of (batch_start, log_index, line), replacing those of the same batches."""
    (
        rows.where("line is not null")
        .repartition("batch_start")
        .sortWithinPartitions("batch_start", "log_index")
        .select("batch_start", F.col("line").alias("value"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_start")
        .option("compression", "gzip")
        .option("lineSep", "\n")
        .text(out_path)
    )


def flush_incomplete(spark: SparkSession, out_path: str, batch_size: int = 100_000, tree_size: int | None = None) -> None:
    """Write what waits as incomplete batch files, for the end of a fixed range; it waits on, and a later run replaces them."""
    folder = f"{out_path.rstrip('/')}_state"
    if path_exists(spark, folder):
        left = spark.read.schema(f"{WAITING}, epoch int").parquet(folder)
        last = left.join(left.agg(F.max("epoch").alias("epoch")), "epoch")
        _write_lines(assign_batches(below(last.select("log_index", "line"), tree_size), "log_index", batch_size), out_path)


def start_ingest_to_batches(
    spark: SparkSession,
    log_dir: str,
    out_path: str,
    checkpoint: str,
    batch_size: int = 100_000,
    continuous: bool = False,
    interval: str = "5 minutes",
    max_files_per_trigger: int | None = None,
):
    """T1 + K5: the ingest stream written as '<index> <base64>' gzip batch files, each when it is complete.

    The log's tree head is read for every micro-batch; it never falls, and entries past it wait.
    """
    head = [0]

    def run_batch(df: DataFrame, epoch_id: int) -> None:
        tree_size = tree_head(spark, log_dir, head[0])
        head[0] = tree_size or 0
        write_epoch(df, epoch_id, out_path, batch_size, tree_size)

    w = _decoded(spark, log_dir, max_files_per_trigger).writeStream.foreachBatch(run_batch).option("checkpointLocation", checkpoint)
    return _trigger(w, continuous, interval).start()
