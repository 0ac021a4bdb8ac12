"""Object listings: F7 filter, F8 validation, J2 integrity, A6 totals, P12/P13 columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import is_blank
from ..sources.remote import file_facts, list_files


def validate_filter_criteria(extensions=(), min_size: int = 0, max_size: int = 0) -> None:
    """F7 argument checks (driver-side, on parameters only)."""
    if min_size < 0:
        raise ValueError("minimum size cannot be negative")
    if max_size < 0:
        raise ValueError("maximum size cannot be negative")
    if min_size > 0 and max_size > 0 and min_size > max_size:
        raise ValueError("minimum size cannot be greater than maximum size")
    for ext in extensions:
        if ext.strip() == "":
            raise ValueError("extension cannot be empty")
        if not ext.startswith("."):
            raise ValueError(f"extension must start with a dot: {ext}")


def filter_objects(df: DataFrame, extensions=(".gz",), min_size: int = 0, max_size: int = 0, sort_by_key: bool = False) -> DataFrame:
    """any-suffix match (case-insensitive), inclusive size bounds where 0 means unbounded."""
    validate_filter_criteria(extensions, min_size, max_size)
    cond = F.lit(True)
    if extensions:
        low = F.lower(F.col("key"))
        m = None
        for e in extensions:
            t = low.endswith(e.lower())
            m = t if m is None else (m | t)
        cond = cond & m
    if min_size > 0:
        cond = cond & (F.col("size") >= min_size)
    if max_size > 0:
        cond = cond & (F.col("size") <= max_size)
    out = df.filter(cond)
    return out.orderBy("key") if sort_by_key else out


def validate_objects(df: DataFrame) -> DataFrame:
    """F8: first failing rule per listing row, null when valid."""
    # The listing validation messages, in check order.
    reason = (
        F.when(is_blank("key"), F.lit("S3 object key cannot be empty"))
        .when(F.col("size") < 0, F.lit("S3 object size must be non-negative"))
        .when(is_blank("etag"), F.lit("S3 object ETag cannot be empty"))
        .when(F.col("last_modified").isNull(), F.lit("S3 object LastModified cannot be zero"))
    )
    return df.withColumn("validation_error", reason)


def validate_file_state(df: DataFrame, ts_col: str = "event_ts") -> DataFrame:
    """F8 for ledger rows."""
    # The ledger entry validation messages, in check order.
    reason = (
        F.when(is_blank("key"), F.lit("key cannot be empty"))
        .when(is_blank("etag"), F.lit("etag cannot be empty"))
        .when(F.col("size") < 0, F.lit("size must be non-negative"))
        .when(F.col(ts_col).isNull(), F.lit("processed_at cannot be zero"))
    )
    return df.withColumn("validation_error", reason)


def object_totals(df: DataFrame) -> DataFrame:
    """Count and total bytes."""
    return df.agg(F.count(F.lit(1)).alias("object_count"), F.coalesce(F.sum("size"), F.lit(0)).cast("long").alias("total_bytes"))


def verify_integrity(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """Listing (key, size, etag) against the bytes actually present (key, actual_size, actual_md5).

    Size must match; a single-part ETag (no '-') must equal the MD5 of the content, quotes
    stripped; multipart ETags are checked by size only.  Missing content is its own reason.
    Both sides are keyed by the object key, so this is a shuffle join on key at scale.
    """
    j = manifest.join(files, "key", "left")
    expected = F.regexp_replace(F.col("etag"), r'^"+|"+\z', "")
    reason = (
        F.when(F.col("actual_size").isNull(), F.lit("failed to stat file"))
        .when(F.col("actual_size") != F.col("size"), F.format_string("size mismatch: expected %d, got %d", F.col("size"), F.col("actual_size")))
        .when(
            ~F.col("etag").contains("-") & (expected != F.col("actual_md5")),
            F.format_string("MD5 mismatch: expected %s, got %s", expected, F.col("actual_md5")),
        )
    )
    return j.select("key", "size", "etag", "actual_size", reason.alias("integrity_error"), reason.isNull().alias("ok"))


def list_objects(spark, path: str, prefix: str = "", recursive: bool = True) -> DataFrame:
    """Listing rows (key, rel_key, size, etag, last_modified) of the files under ``path``.

    ``rel_key`` is the key relative to ``path`` (what an object-store prefix is matched
    against); ``prefix`` keeps the keys whose relative form starts with it.  The listing is made by
    tasks, folder level by folder level, and contents are not read.  Listings carry no ETag; a content
    MD5 can be added with ``with_content_md5``.
    """
    import re

    scheme = r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?"
    root = re.sub(scheme, "", path).rstrip("/")
    df = list_files(spark, path, recursive).withColumn("rel_key", F.regexp_replace(F.regexp_replace("key", scheme, ""), "^" + re.escape(root) + "/?", ""))
    if prefix:
        df = df.filter(F.col("rel_key").startswith(prefix))
    return df.withColumn("etag", F.lit(None).cast("string"))


def with_content_md5(spark, path: str, recursive: bool = True) -> DataFrame:
    """(key, actual_size, actual_md5) computed from file contents, piece by piece."""
    return file_facts(list_files(spark, path, recursive).select(F.col("key").alias("file")))
