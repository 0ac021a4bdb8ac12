"""Fetch monitoring over a fetch log / counter samples.

Per-endpoint series are few and long (a handful of endpoints may carry the whole log), so
ordered windows are never partitioned by endpoint alone: rows are also cut into time buckets,
and whatever crosses a bucket edge is carried explicitly (duplicated context rows for range
windows, a small per-bucket table for running state).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import wall_micros

MIB = 1024.0 * 1024.0
# Fixed value: unhealthy threshold default.
DEFAULT_MAX_FAILURES = 5
DEFAULT_BUCKET_S = 86_400
HEALTH_BUCKET_S = 3_600


def endpoint_latency(fetch_log: DataFrame, accuracy: int = 10_000, exact: bool = False, ceiling_ms: float | None = None) -> DataFrame:
    """A5: per endpoint mean, p95, p99, max latency (ms) of recorded calls, and entries
    downloaded on success.  Durations of 0, and those above ``ceiling_ms`` if it is given, are not recorded.
    ``exact`` percentiles merge one count per distinct duration."""
    rec = F.col("duration_ms") > 0
    if ceiling_ms is not None:
        rec = rec & (F.col("duration_ms") <= ceiling_ms)
    d = F.when(rec, F.col("duration_ms"))
    if exact:
        fetch_log, d = fetch_log.withColumn("__d", d), F.col("__d")
        p95, p99 = (F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY __d)") for p in (0.95, 0.99))
    else:
        p95, p99 = F.percentile_approx(d, 0.95, accuracy), F.percentile_approx(d, 0.99, accuracy)
    return fetch_log.groupBy("endpoint").agg(
        F.round(F.avg(d), 3).alias("mean_ms"),
        F.round(p95, 3).alias("p95_ms"),
        F.round(p99, 3).alias("p99_ms"),
        F.round(F.max(d), 3).alias("max_ms"),
        F.coalesce(F.sum(F.when(F.col("success"), F.col("entries"))), F.lit(0)).cast("long").alias("entries_downloaded"),
        F.count(d).alias("recorded_calls"),
    )


#: Sub-buckets of a power of two in latency histograms: three significant digits.
SUB_BUCKETS = 1024


def _histogram_code(ns: Column) -> Column:
    """Log-linear bucket of a whole number: its 11 leading bits, and how many more there are."""
    more = F.greatest(F.length(F.bin(ns)) - 11, F.lit(0))
    return (more * (2 * SUB_BUCKETS) + F.call_function("shiftright", ns, more)).cast("int")


def _histogram_value(code: Column) -> Column:
    """The middle of a bucket."""
    more = F.floor(code / (2 * SUB_BUCKETS)).cast("int")
    low = F.call_function("shiftleft", F.pmod(code, F.lit(2 * SUB_BUCKETS)).cast("long"), more)
    return low + (F.call_function("shiftleft", F.lit(1).cast("long"), more) - 1) / 2.0


def latency_histogram(fetch_log: DataFrame, by: tuple = ("endpoint",), slot_s: int | None = None) -> DataFrame:
    """A5, mergeable: (by..., [slot,] code, calls), the recorded durations in log-linear buckets of nanoseconds.

    A bucket holds its values to within a thousandth.  With ``slot_s`` histograms are also cut by time, so that those of
    any span are the sum of its slots; the raw rows are not needed again.
    """
    d = fetch_log.where("duration_ms > 0").withColumn("code", _histogram_code(F.round(F.col("duration_ms") * 1e6).cast("long")))
    keys = [*by]
    if slot_s:
        d = d.withColumn("slot", F.floor(wall_micros("ts") / (slot_s * 1_000_000)).cast("long"))
        keys.append("slot")
    return d.groupBy(*keys, "code").agg(F.count(F.lit(1)).alias("calls"))


def merge_histograms(*histograms: DataFrame, by: tuple = ("endpoint",)) -> DataFrame:
    """The histogram of all that several were made of, whatever their slots."""
    every = None
    for h in histograms:
        h = h.select(*by, "code", "calls")
        every = h if every is None else every.unionByName(h)
    return every.groupBy(*by, "code").agg(F.sum("calls").alias("calls"))


def histogram_latency(histogram: DataFrame, by: tuple = ("endpoint",)) -> DataFrame:
    """Per key mean, p95, p99 and max in milliseconds and the recorded calls, from a merged histogram.

    The ordered pass has at most one row a bucket and key, some ten thousands whatever the calls.
    """
    w = Window.partitionBy(*by).orderBy("code")
    whole = Window.partitionBy(*by)
    ms = _histogram_value(F.col("code")) / 1e6
    d = histogram.select(*by, "calls", ms.alias("ms"), F.sum("calls").over(w).alias("upto"), F.sum("calls").over(whole).alias("n"))
    reached = lambda p: F.min(F.when(F.col("upto") >= F.ceil(F.col("n") * p), F.col("ms")))
    return d.groupBy(*by).agg(
        F.round(F.sum(F.col("ms") * F.col("calls")) / F.sum("calls"), 3).alias("mean_ms"),
        F.round(reached(0.95), 3).alias("p95_ms"),
        F.round(reached(0.99), 3).alias("p99_ms"),
        F.round(F.max("ms"), 3).alias("max_ms"),
        F.sum("calls").alias("recorded_calls"),
    )


def _sample_order(samples: DataFrame) -> Column:
    """What orders samples by time, then value, a missing one first: one number for whole values, else a struct."""
    if samples.schema["value"].dataType.typeName() not in ("byte", "short", "integer", "long"):
        return F.struct("ts", "value")
    value = F.coalesce(F.col("value").cast("decimal(20,0)") + F.lit(Decimal(2**63 + 1)), F.lit(Decimal(0)))
    return F.unix_micros("ts").cast("decimal(20,0)") * F.lit(Decimal(2**64 + 1)) + value


def windowed_rate(samples: DataFrame, window_s: int = 60, slide_s: int = 10, part: tuple = (), watermark: str | None = None, per_minute: bool = False) -> DataFrame:
    """W5 / W6 by sliding windows: (part..., window_end, samples, rate) for samples (ts, value), batch or streaming.

    The rate of a window is (last - first) / elapsed seconds, 0 with fewer than two samples or under a second, that
    is the rolling rate asked at the window's end.  As a stream the state is the first and last sample of each open window;
    with ``watermark`` ("5 minutes") windows older than that are closed and rows for them are late and dropped.
    """
    d = samples.withColumn("ts", F.col("ts").cast("timestamp"))
    d = d.withColumn("__at", _sample_order(d))
    d = d.withWatermark("ts", watermark) if watermark else d
    w = F.window("ts", f"{window_s} seconds", f"{slide_s} seconds").alias("w")
    # plain values in the buffers: a row goes to many windows, and those copies are hashed where structs would have them sorted
    ends = [F.min("ts").alias("t0"), F.max("ts").alias("t1"), F.min_by("value", "__at").alias("v0"), F.max_by("value", "__at").alias("v1")]
    g = d.groupBy(w, *part).agg(*ends, F.count(F.lit(1)).alias("samples"))
    elapsed = (F.unix_micros("t1") - F.unix_micros("t0")) / 1e6
    rate = F.when((F.col("samples") < 2) | (elapsed < 1), F.lit(0.0)).otherwise((F.col("v1") - F.col("v0")) / elapsed)
    return g.select(*part, F.col("w.end").alias("window_end"), "samples", F.round(rate * 60 if per_minute else rate, 6).alias("rate"))


def _with_overlap(df: DataFrame, ts_us, window_us: int, bucket_us: int) -> DataFrame:
    """Assign each row to its time bucket and, as context, to the next bucket when it lies
    within ``window_us`` of that bucket's start.  bucket_us must be >= window_us."""
    b = F.floor(ts_us / bucket_us).cast("long")
    nb = b + 1
    ctx = ts_us >= nb * bucket_us - window_us
    return df.withColumn(
        "__bk",
        F.explode(
            F.filter(
                F.array(F.struct(b.alias("b"), F.lit(False).alias("ctx")), F.when(ctx, F.struct(nb.alias("b"), F.lit(True).alias("ctx")))),
                lambda x: x.isNotNull(),
            )
        ),
    )


def rolling_rate(samples: DataFrame, window_s: int = 60, part: list[str] | None = None, bucket_s: int | None = None, per_minute: bool = False) -> DataFrame:
    """W5 (W6 with ``part=["endpoint"]`` and ``per_minute``): (last - first) / elapsed seconds over
    the samples in [ts - window, ts]; 0 with fewer than 2 samples or under 1 s elapsed.

    Windows run per (part, time bucket); rows within ``window_s`` of a bucket's start are also
    copied into that bucket as context, so every row sees its whole window and each row is
    duplicated at most once.  Buckets default to five windows.  A window's first sample is found by one
    pass: every row also asks at the time its window begins, and going back in time the last
    sample seen before the question is the answer.  Nothing is evaluated per window."""
    part = part or []
    bucket_s = max(bucket_s or 5 * window_s, window_s)
    ts_us = wall_micros("ts")
    d = _with_overlap(samples.withColumn("__us", ts_us), F.col("__us"), window_s * 1_000_000, bucket_s * 1_000_000)
    asks = F.array(F.struct(F.lit(1).alias("k"), F.col("__us").alias("t")), F.struct(F.lit(0).alias("k"), (F.col("__us") - window_s * 1_000_000).alias("t")))
    d = d.withColumn("__q", F.explode(asks)).filter((F.col("__q.k") == 1) | ~F.col("__bk.ctx"))
    w = Window.partitionBy(*part, F.col("__bk.b")).orderBy(F.col("__q.t").desc(), F.col("__q.k").desc(), F.col("event_id").desc())
    sample = F.when(F.col("__q.k") == 1, F.struct(F.col("__us").alias("us"), F.col("value").alias("v")))
    d = d.withColumn("__first", F.last(sample, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))).filter(F.col("__q.k") == 0)
    elapsed = (F.col("__us") - F.col("__first.us")) / 1e6
    rate = F.when(elapsed < 1, F.lit(0.0)).otherwise((F.col("value") - F.col("__first.v")) / elapsed)
    if per_minute:
        rate = rate * 60
    return d.withColumn("rate", F.round(rate, 6)).drop("__bk", "__us", "__q", "__first")


def progress_eta(rated: DataFrame, total, current: str = "value") -> DataFrame:
    """Percent done and ETA seconds (null = 'n/a' when the rate is < 1 or nothing remains)."""
    tot = F.col(total) if isinstance(total, str) else F.lit(total)
    cur = F.col(current)
    return rated.withColumn("percent", F.round(F.when(tot > 0, cur / tot * 100).otherwise(F.lit(0.0)), 6)).withColumn(
        "eta_s", F.when((F.col("rate") < 1) | (tot <= cur), F.lit(None)).otherwise(F.floor((tot - cur) / F.col("rate")).cast("long"))
    )


def endpoint_health(fetch_log: DataFrame, max_failures: int = DEFAULT_MAX_FAILURES, bucket_s: int = HEALTH_BUCKET_S) -> DataFrame:
    """Consecutive failures per endpoint after each call (reset by a success) and health.

    Rows are numbered inside (endpoint, hour) windows; the failure streak carried into a bucket
    is found from a per-bucket table: each bucket contributes its trailing failures (if it has
    a success) or all its rows (if it has none), summed back to the last bucket with a success.
    """
    d = fetch_log.withColumn("__b", F.floor(wall_micros("ts") / (bucket_s * 1_000_000)).cast("long"))
    w = Window.partitionBy("endpoint", "__b").orderBy("ts", "event_id")
    d = d.withColumn("__succ_sofar", F.sum(F.col("success").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    d = d.withColumn("__rn", F.row_number().over(w))
    wi = Window.partitionBy("endpoint", "__b", "__succ_sofar").orderBy("ts", "event_id")
    d = d.withColumn("__local", F.when(F.col("success"), F.lit(0)).otherwise(F.row_number().over(wi) - F.when(F.col("__succ_sofar") > 0, 1).otherwise(0)))
    per = d.groupBy("endpoint", "__b").agg(
        F.count(F.lit(1)).alias("n"),
        F.max(F.col("success").cast("int")).alias("has_succ"),
        F.max_by("__local", F.struct("ts", "event_id")).alias("trailing"),
    )
    wb = Window.partitionBy("endpoint").orderBy("__b")
    per = per.withColumn("g", F.sum("has_succ").over(wb.rowsBetween(Window.unboundedPreceding, 0)))
    per = per.withColumn("contrib", F.when(F.col("has_succ") == 1, F.col("trailing")).otherwise(F.col("n")))
    per = per.withColumn("cum", F.sum("contrib").over(Window.partitionBy("endpoint", "g").orderBy("__b").rowsBetween(Window.unboundedPreceding, 0)))
    per = per.withColumn("carry", F.coalesce(F.lag("cum").over(wb), F.lit(0))).select("endpoint", "__b", "carry")
    out = d.join(per, ["endpoint", "__b"]).withColumn(
        "consecutive_failures",
        F.when(F.col("success"), F.lit(0)).when(F.col("__succ_sofar") == 0, F.col("__local") + F.col("carry")).otherwise(F.col("__local")).cast("long"),
    )
    return out.withColumn("healthy", F.col("consecutive_failures") < max_failures).drop("__b", "__succ_sofar", "__rn", "__local", "carry")


def transfer_rate(
    samples: DataFrame, key: str = "key", ts: str = "ts", nbytes: str = "bytes_done", order: str = "event_id", bucket_s: int = HEALTH_BUCKET_S
) -> DataFrame:
    """Per key (file), MB/s between consecutive byte counters; a zero time step keeps the
    earlier rate; 0 before the first measurable step; the last sample of a key is flagged
    completed.

    Two-level, so a long series is not one task: ``lag`` and the running last rate work inside
    (key, hour) windows.  One table per bucket holds its first and last sample and its last rate; an
    ordered pass over that table gives each bucket the sample and the rate before it.
    """
    us = wall_micros(ts)
    d = samples.withColumn("__us", us).withColumn("__b", F.floor(F.col("__us") / (bucket_s * 1_000_000)).cast("long"))
    w = Window.partitionBy(key, "__b").orderBy("__us", order)

    def rate(t1, n1, t0, n0):
        dt = (t1 - t0) / 1e6
        return F.when(dt > 0, (n1 - n0) / MIB / dt)

    d = d.withColumn("__raw", rate(F.col("__us"), F.col(nbytes), F.lag("__us").over(w), F.lag(nbytes).over(w)))
    d = d.withColumn("__local", F.last("__raw", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    d = d.withColumn("__is_last", F.lead("__us").over(w).isNull())
    at = F.struct("__us", order)
    sample = F.struct(F.col("__us").alias("us"), F.col(nbytes).alias("nb"))
    per = d.groupBy(key, "__b").agg(F.min_by(sample, at).alias("first"), F.max_by(sample, at).alias("last"), F.max_by("__local", at).alias("local"))
    wb = Window.partitionBy(key).orderBy("__b")
    prev = F.lag("last").over(wb)
    per = per.withColumn("__edge", rate(F.col("first.us"), F.col("first.nb"), prev["us"], prev["nb"]))
    per = per.select(
        key,
        "__b",
        "__edge",
        F.last(F.coalesce("local", "__edge"), ignorenulls=True).over(wb.rowsBetween(Window.unboundedPreceding, -1)).alias("__carry"),
        F.lead("__b").over(wb).isNull().alias("__final"),
    )
    d = d.join(per, [key, "__b"])
    out = d.withColumn("rate_mbps", F.round(F.coalesce("__local", "__edge", "__carry", F.lit(0.0)), 6)).withColumn("completed", F.col("__final") & F.col("__is_last"))
    return out.drop("__us", "__b", "__edge", "__final", "__raw", "__local", "__is_last", "__carry")


def endpoint_rate(samples: DataFrame, window_s: int = 60, bucket_s: int | None = None) -> DataFrame:
    """Per-endpoint rate in entries per minute over the trailing window."""
    return rolling_rate(samples, window_s, part=["endpoint"], bucket_s=bucket_s, per_minute=True)
