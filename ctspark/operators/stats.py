"""A1/A2/A3/A7 run statistics and P14/P15 report formatting, as single-pass aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import col_, safe_div

MIB = 1024.0 * 1024.0
# Certificates per second used for time estimates (100,000 per 3 s).
EST_SECONDS_PER_100K = 3.0


def processing_stats(status: DataFrame, by: list[str] | None = None, with_total: bool = False) -> DataFrame:
    """A1: total, success (incl. no mappings), errors and the two rates (0 when total is 0).

    ``by`` groups (e.g. per source file); ``with_total`` adds the overall row via ``rollup``
    (grouping columns null on that row)."""
    g = (status.rollup(*by) if with_total else status.groupBy(*by)) if by else status
    agg = g.agg(
        F.count(F.lit(1)).alias("total_processed"),
        F.count_if(F.col("stage") == "ok").alias("successful_parsed"),
        F.count_if(F.col("stage") != "ok").alias("errors"),
    )
    return agg.withColumn("success_rate", F.round(safe_div(F.col("successful_parsed"), F.col("total_processed")) * 100, 6)).withColumn(
        "error_rate", F.round(safe_div(F.col("errors"), F.col("total_processed")) * 100, 6)
    )


def stats_string(successful, errors, duration_s) -> Column:
    """P15 compact form: 'N Success, Errors: E, Duration: x.xxxs' (Errors part only when > 0)."""
    return F.when(
        col_(errors) > 0, F.format_string("%d Success, Errors: %d, Duration: %.3fs", col_(successful), col_(errors), col_(duration_s))
    ).otherwise(F.format_string("%d Success, Duration: %.3fs", col_(successful), col_(duration_s)))


def duration_string(seconds) -> Column:
    """A duration to the microsecond in the largest units that it needs: '1h2m3.5s', '4.25ms', '7µs', '0s'."""
    us = F.round(col_(seconds) * 1e6).cast("long")

    def short(x):
        return F.regexp_replace(F.regexp_replace(F.format_string("%.6f", x.cast("double")), "0+$", ""), "\\.$", "")

    hours, minutes = F.floor(us / 3_600_000_000), F.floor(us / 60_000_000) % 60
    rest = F.concat(short(F.pmod(us, F.lit(60_000_000)) / 1e6), F.lit("s"))
    return (
        F.when(us == 0, F.lit("0s"))
        .when(us < 1_000, F.concat(us.cast("string"), F.lit("µs")))
        .when(us < 1_000_000, F.concat(short(us / 1e3), F.lit("ms")))
        .when(hours > 0, F.concat(hours.cast("string"), F.lit("h"), minutes.cast("string"), F.lit("m"), rest))
        .when(minutes > 0, F.concat(minutes.cast("string"), F.lit("m"), rest))
        .otherwise(rest)
    )


# Fixed value: the long form of the run statistics.
LONG_FORM = "Processed: %d, Success: %d (%.2f%%), Errors: %d (%.2f%%), Duration: %s"


def stats_long_string(total, successful, errors, duration_s) -> Column:
    """P15 long form with rates and duration."""
    sr = safe_div(col_(successful), col_(total)) * 100
    er = safe_div(col_(errors), col_(total)) * 100
    return F.format_string(LONG_FORM, col_(total), col_(successful), sr, col_(errors), er, duration_string(duration_s))


def human_bytes(c) -> Column:
    """1024-based, one decimal: '512 B', '1.5 KB', ... 'EB'.

    The one-decimal values are rounded half-to-even before formatting (Java's formatter
    rounds half-up, the reference's formatter rounds exact ties to even)."""
    b = col_(c).cast("long")
    exp = F.floor(F.log(1024.0, F.greatest(b.cast("double"), F.lit(1.0)))).cast("int")
    # guard the float log at exact powers of 1024
    exp = F.when(F.pow(F.lit(1024.0), exp + 1) <= b, exp + 1).when(F.pow(F.lit(1024.0), exp) > b, exp - 1).otherwise(exp)
    unit = F.substring(F.lit("KMGTPE"), exp, 1)
    return F.when(b < 1024, F.format_string("%d B", b)).otherwise(
        F.format_string("%.1f %sB", F.bround(b / F.pow(F.lit(1024.0), exp), 1), unit)
    )


def human_count(c) -> Column:
    n = col_(c).cast("long")
    return (
        F.when(n < 1000, F.format_string("%d", n))
        .when(n < 1000000, F.format_string("%.1fK", F.bround(n / 1000.0, 1)))
        .otherwise(F.format_string("%.1fM", F.bround(n / 1000000.0, 1)))
    )


def human_seconds(c) -> Column:
    s = col_(c).cast("double")
    return (
        F.when(s < 60, F.format_string("%.1fs", F.bround(s, 1)))
        .when(s < 3600, F.format_string("%.1fm", F.bround(s / 60, 1)))
        .otherwise(F.format_string("%.1fh", F.bround(s / 3600, 1)))
    )


def estimated_seconds(certs) -> Column:
    return col_(certs).cast("double") / 100000.0 * EST_SECONDS_PER_100K


def profile_summary(profile: DataFrame) -> DataFrame:
    """Files ok / total, certificates, integer average (only with > 1 file), estimate."""
    ok = F.col("error").isNull()
    return profile.agg(
        F.count_if(ok).alias("files_ok"),
        F.count(F.lit(1)).alias("files_total"),
        F.coalesce(F.sum(F.when(ok, F.col("line_count"))), F.lit(0)).cast("long").alias("total_certificates"),
    ).select(
        "files_ok",
        "files_total",
        "total_certificates",
        F.when(F.col("files_ok") > 1, (F.col("total_certificates") / F.col("files_ok")).cast("long")).alias("avg_per_file"),
        F.round(estimated_seconds(F.col("total_certificates")), 6).alias("estimated_seconds"),
    )


def download_stats(fetch_log: DataFrame) -> DataFrame:
    """A3: totals including failures; MB/s over all durations; zeros on empty input."""
    a = fetch_log.agg(
        F.count(F.lit(1)).alias("total_downloads"),
        F.count_if(F.col("success")).alias("successful_downloads"),
        F.count_if(~F.col("success")).alias("failed_downloads"),
        F.coalesce(F.sum("bytes"), F.lit(0)).cast("long").alias("total_bytes"),
        F.coalesce(F.sum("duration_ms"), F.lit(0.0)).alias("total_duration_ms"),
        F.coalesce(F.sum("retries"), F.lit(0)).cast("long").alias("retry_count"),
    )
    secs = F.col("total_duration_ms") / 1000.0
    return a.select(
        "total_downloads",
        "successful_downloads",
        "failed_downloads",
        "total_bytes",
        "retry_count",
        F.round(F.col("total_duration_ms"), 3).alias("total_duration_ms"),
        F.round(F.when(secs > 0, F.col("total_bytes") / MIB / secs).otherwise(0.0), 6).alias("avg_speed_mbps"),
        F.round(F.col("total_bytes") / MIB, 6).alias("total_size_mb"),
        F.round(safe_div(F.col("retry_count"), F.col("total_downloads")), 6).alias("avg_retries"),
        F.round(safe_div(F.col("total_duration_ms"), F.col("total_downloads")), 3).alias("avg_duration_ms"),
        F.round(safe_div(F.col("successful_downloads"), F.col("total_downloads")) * 100, 6).alias("success_rate"),
        F.round(safe_div(F.col("failed_downloads"), F.col("total_downloads")) * 100, 6).alias("failure_rate"),
    )


def bucket_stats(objects: DataFrame, pending: DataFrame, current: DataFrame, fetch_log: DataFrame) -> DataFrame:
    """A2: total / processed / failed / skipped (= total - pending), average processed size
    (integer division), MB/s over download time, and rates over total."""
    # one tagged union and a single aggregate: no join between the four inputs
    cur = current.join(objects.select("key", "etag"), ["key", "etag"], "left_semi")
    def part(df, tag, status=None, size=None, ms=None):
        return df.select(
            F.lit(tag).alias("part"),
            (status if status is not None else F.lit(None).cast("string")).alias("status"),
            (size if size is not None else F.lit(None).cast("long")).cast("long").alias("nbytes"),
            (ms if ms is not None else F.lit(None).cast("double")).cast("double").alias("ms"),
        )
    u = (
        part(objects, "obj")
        .unionByName(part(pending, "pend"))
        .unionByName(part(cur, "cur", F.col("status"), F.col("size")))
        .unionByName(part(fetch_log, "dl", None, F.col("bytes"), F.col("duration_ms")))
    )
    j = u.agg(
        F.count_if(F.col("part") == "obj").alias("total_files"),
        F.count_if(F.col("part") == "pend").alias("pending_files"),
        F.count_if((F.col("part") == "cur") & (F.col("status") == "processed")).alias("processed_files"),
        F.count_if((F.col("part") == "cur") & (F.col("status") == "failed")).alias("failed_files"),
        F.coalesce(F.sum(F.when((F.col("part") == "cur") & (F.col("status") == "processed"), F.col("nbytes"))), F.lit(0)).alias("processed_bytes"),
        F.coalesce(F.sum(F.when(F.col("part") == "dl", F.col("nbytes"))), F.lit(0)).alias("download_bytes"),
        F.coalesce(F.sum(F.when(F.col("part") == "dl", F.col("ms"))), F.lit(0.0)).alias("download_ms"),
    )
    return j.select(
        "total_files",
        "processed_files",
        "failed_files",
        (F.col("total_files") - F.col("pending_files")).alias("skipped_files"),
        F.when(F.col("processed_files") > 0, (F.col("processed_bytes") / F.col("processed_files")).cast("long")).otherwise(F.lit(0)).alias("avg_file_size"),
        F.round(F.when(F.col("download_ms") > 0, F.col("download_bytes") / MIB / (F.col("download_ms") / 1000.0)).otherwise(0.0), 6).alias("throughput_mbps"),
        F.round(safe_div(F.col("processed_files"), F.col("total_files")) * 100, 6).alias("success_rate"),
        F.round(safe_div(F.col("failed_files"), F.col("total_files")) * 100, 6).alias("failure_rate"),
    )


# the survey's name for the P15 compact form
compact_stats = stats_string
