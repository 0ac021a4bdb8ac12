"""T5/T6 ledger tables, J1 pending files, A8 counts, E12 retry plan.

The ledger is an append-only event table (key, etag, size, event_ts, seq, status, error_msg);
the current state of a key is its latest event.  That is one aggregation keyed by ``key``
(``max_by`` over a struct), so it spreads over the cluster with the keys and needs no ordering
of the whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import errors as E
from ..functions.text import is_blank

LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("etag", T.StringType()),
        T.StructField("size", T.LongType()),
        T.StructField("event_ts", T.TimestampType()),
        T.StructField("seq", T.IntegerType()),
        T.StructField("status", T.StringType()),
        T.StructField("error_msg", T.StringType()),
    ]
)


def ledger_apply(events: DataFrame) -> DataFrame:
    """T5: current state per key = latest event (ties broken by seq); key and etag required.

    A processed event removes an earlier failure for the key and vice versa; failed rows keep
    size 0 and their message.
    """
    ok = events.filter(~is_blank("key") & ~is_blank("etag"))
    latest = F.max_by(F.struct("etag", "size", "event_ts", "seq", "status", "error_msg"), F.struct("event_ts", "seq"))
    return ok.groupBy("key").agg(latest.alias("s")).select(
        "key",
        "s.etag",
        F.when(F.col("s.status") == "failed", F.lit(0).cast("long")).otherwise(F.col("s.size")).alias("size"),
        "s.event_ts",
        "s.status",
        F.coalesce(F.col("s.error_msg"), F.lit("")).alias("error_msg"),
    )


def pending_files(objects: DataFrame, current: DataFrame) -> DataFrame:
    """Listing rows not yet processed at their current ETag (failed files are pending again)."""
    done = current.filter(F.col("status") == "processed").select("key", "etag")
    return objects.join(done, ["key", "etag"], "left_anti")


def ledger_counts(current: DataFrame) -> DataFrame:
    """Processed and failed counts of the current state."""
    return current.agg(
        F.count_if(F.col("status") == "processed").alias("processed_files"),
        F.count_if(F.col("status") == "failed").alias("failed_files"),
    )


# JSON shape of a legacy ledger document.
_ENTRY = "struct<key:string,etag:string,size:bigint,processed_at:string,error_msg:string>"
_DOC = f"struct<processed_files:map<string,{_ENTRY}>,failed_files:map<string,{_ENTRY}>,last_updated:string,version:string>"


# RFC 3339 timestamp shape.
RFC3339 = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]+)?(Z|[+-][0-9]{2}:[0-9]{2})\z"


def _rfc3339(c):
    return F.when(c.rlike(RFC3339), F.try_to_timestamp(c))


def ledger_recover(docs: DataFrame, col: str = "value") -> DataFrame:
    """Legacy JSON ledger documents -> ledger events.

    A well-formed document (both maps present, a version, every given time in RFC 3339) is
    taken whole.  Otherwise, as in recovery, each entry is kept only when it has a non-blank
    key and etag, size >= 0 (absent = 0) and a valid RFC 3339 time; a document that is not a
    JSON object gives no rows.  Entries are exploded per document, so many documents are
    handled in parallel.
    """
    parsed = docs.select(F.from_json(F.col(col), _DOC, {"mode": "PERMISSIVE"}).alias("d"))
    times_ok = lambda m: F.forall(F.map_values(m), lambda e: e["processed_at"].isNull() | _rfc3339(e["processed_at"]).isNotNull())
    whole = (
        F.col("d").isNotNull()
        & F.col("d.processed_files").isNotNull()
        & F.col("d.failed_files").isNotNull()
        & (F.coalesce(F.col("d.version"), F.lit("")) != "")
        & times_ok(F.col("d.processed_files"))
        & times_ok(F.col("d.failed_files"))
    )
    parsed = parsed.select("d", whole.alias("whole"))
    rows = []
    for status, field in (("processed", "processed_files"), ("failed", "failed_files")):
        rows.append(
            parsed.select(F.explode(F.coalesce(F.col(f"d.{field}"), F.create_map().cast(f"map<string,{_ENTRY}>"))).alias("k", "e"), "whole").select(
                F.col("e.key").alias("key"),
                F.col("e.etag").alias("etag"),
                F.coalesce(F.col("e.size"), F.lit(0)).alias("size"),
                _rfc3339(F.col("e.processed_at")).alias("event_ts"),
                F.lit(1 if status == "processed" else 2).alias("seq"),
                F.lit(status).alias("status"),
                F.coalesce(F.col("e.error_msg"), F.lit("")).alias("error_msg"),
                "whole",
            )
        )
    out = rows[0].unionByName(rows[1])
    valid = ~is_blank("key") & ~is_blank("etag") & F.col("event_ts").isNotNull() & (F.col("size") >= 0)
    return out.filter(F.col("whole") | valid).drop("whole")


def plan_retries(events: DataFrame) -> DataFrame:
    """For every currently failed file: error type, attempt (failures since its last success),
    retryable, next action, delay (no jitter) and next attempt time."""
    current = ledger_apply(events)
    at = F.struct("event_ts", "seq")
    done = events.filter(F.col("status") == "processed").groupBy("key").agg(F.max(at).alias("done"))
    since = events.filter(F.col("status") == "failed").join(done, "key", "left").filter(F.col("done").isNull() | (at > F.col("done")))
    attempts = since.groupBy("key").agg(F.count(F.lit(1)).alias("attempt"))
    failed = current.filter(F.col("status") == "failed").join(attempts, "key", "left")
    etype = E.classify_s3_error(F.col("error_msg"), F.lit("download"))
    delay = E.retry_delay(F.col("attempt"), etype)
    return failed.select(
        "key",
        "etag",
        "error_msg",
        etype.alias("error_type"),
        F.col("attempt").cast("int").alias("attempt"),
        E.is_retryable(F.col("error_msg"), etype).alias("retryable"),
        E.error_action(F.col("error_msg"), F.lit("download"), F.lit("download"), F.col("attempt")).alias("action"),
        delay.alias("delay_s"),
        (F.col("event_ts") + F.make_dt_interval(secs=delay)).alias("next_attempt_ts"),
    )
