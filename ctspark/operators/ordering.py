"""Log-index ordering operators without a global window.

Index space is cut into batches of N consecutive indexes.  Per-batch facts (count, min, max)
are one distributed aggregate; the only ordered pass runs over the batch table, which is the
data size divided by N.  Row-level ordering happens inside one batch (at most N rows).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import keep

DEFAULT_BATCH = 100_000


def assign_batches(df: DataFrame, idx: str = "log_index", batch_size: int = DEFAULT_BATCH) -> DataFrame:
    """batch_start = floor(idx / N) * N for every row."""
    return df.withColumn("batch_start", F.col(idx) - F.pmod(F.col(idx), F.lit(batch_size)))


def batch_summary(df: DataFrame, idx: str = "log_index", batch_size: int = DEFAULT_BATCH) -> DataFrame:
    """W2 per batch: distinct indexes, min, max, and whether the batch is complete."""
    b = assign_batches(df.select(idx), idx, batch_size)
    return (
        b.groupBy("batch_start")
        .agg(F.count_distinct(idx).alias("entries"), F.min(idx).alias("min_index"), F.max(idx).alias("max_index"))
        .withColumn("complete", F.col("entries") == batch_size)
    )


#: Bits of Spark's bitmap aggregate: the most indexes one presence bitmap can hold.
BITMAP_BITS = 32_768


def _presence(df: DataFrame, idx: str, start: int, bits: int) -> DataFrame:
    """(b, bm, n): for each run of ``bits`` indexes the bitmap of those present, and their number.

    Bitmaps are merged before the shuffle, so repeated rows cost nothing and one shuffle of
    a few kilobytes per run of indexes is all that the row-level data need.
    """
    if not 0 < bits <= BITMAP_BITS:
        raise ValueError(f"a bitmap holds at most {BITMAP_BITS} indexes")
    at = F.col(idx) - F.lit(start)
    d = df.filter(at >= 0).select(F.floor(at / bits).cast("long").alias("b"), F.pmod(at, F.lit(bits)).cast("long").alias("pos"))
    return d.groupBy("b").agg(F.bitmap_construct_agg("pos").alias("bm")).withColumn("n", F.bitmap_count("bm"))


def _is_set(bm, pos):
    """Whether bit ``pos`` of a bitmap is set."""
    byte = F.conv(F.hex(F.substring(bm, F.floor(pos / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.pmod(F.floor(byte / F.pow(F.lit(2.0), F.pmod(pos, F.lit(8)).cast("double"))).cast("int"), F.lit(2)) == 1


#: Runs of indexes that one task orders together.
CHUNK = 4096


def _runs(per: DataFrame, batch_size: int) -> DataFrame:
    """(b, n, lo, hi) of each present run of indexes: how many, and the first and last place in it."""
    # full runs need no look at their bits
    ends = [F.when(F.col("n") == batch_size, F.lit(whole).cast("long")).otherwise(place) for whole, place in ((0, _first_bit("bm")), (batch_size - 1, _last_bit("bm")))]
    return per.select("b", "n", ends[0].alias("lo"), ends[1].alias("hi"))


def _nonzero_hex(bm: str, keep_tail: bool):
    """The bitmap's hex text without the zeros before its first (or behind its last) digit, and the whole text's length."""
    text = F.hex(bm)
    return F.regexp_replace(text, "^0+" if keep_tail else "0+$", ""), F.length(text)


def _first_bit(bm: str):
    """The lowest bit set in a bitmap whose bytes rise."""
    rest, size = _nonzero_hex(bm, True)
    at = F.floor((size - F.length(rest)) / 2)
    byte = F.conv(F.substring(F.hex(bm), (at * 2 + 1).cast("int"), F.lit(2)), 16, 10).cast("int")
    low = F.bit_count(byte.bitwiseXOR(byte - 1)) - 1
    return (at * 8 + low).cast("long")


def _last_bit(bm: str):
    """The highest bit set."""
    rest, _ = _nonzero_hex(bm, False)
    at = F.ceil(F.length(rest) / 2) - 1
    byte = F.conv(F.substring(F.hex(bm), (at * 2 + 1).cast("int"), F.lit(2)), 16, 10)
    return (at * 8 + F.length(F.bin(byte.cast("long"))) - 1).cast("long")


def _with_before(runs: DataFrame) -> DataFrame:
    """Adds what lies before each run: ``prev``, the number of the run before (-1 for none), ``prev_hi``, its last place, and ``before``, the indexes in all earlier runs.

    Two levels: runs are ordered inside chunks of ``CHUNK`` run numbers, and only one row a chunk enters the pass without a key.
    """
    d = runs.withColumn("chunk", F.floor(F.col("b") / CHUNK))
    tail = F.struct(F.col("b").alias("b"), F.col("hi").alias("hi"))
    per = d.groupBy("chunk").agg(F.sum("n").alias("n"), F.max_by(tail, "b").alias("tail"))
    over = Window.orderBy("chunk")
    per = per.select("chunk", F.lag("tail").over(over).alias("carry"), F.coalesce(F.sum("n").over(over.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    w = Window.partitionBy("chunk").orderBy("b")
    d = d.withColumn("own", F.lag(tail).over(w)).withColumn("sofar", F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    d = d.join(per, "chunk").withColumn("last", F.coalesce("own", "carry"))
    return d.select(*runs.columns, F.coalesce("last.b", F.lit(-1)).alias("prev"), F.col("last.hi").alias("prev_hi"), (F.col("sofar") + F.col("base")).alias("before"))


def contiguous_prefix(df: DataFrame, idx: str = "log_index", start: int = 0, batch_size: int = BITMAP_BITS) -> DataFrame:
    """One row (start, committed_through, committed_entries, next_index) for the longest
    run start, start+1, ... of present indexes.

    Presence is one bitmap per run of ``batch_size`` indexes.  (number, count, first, last) of the runs alone are ordered,
    in chunks; the first run that is incomplete, or absent, is joined back to its bitmap, whose first bit not set is the answer.
    """
    per = keep(_presence(df, idx, start, batch_size), "presence")  # small, and read more than once
    runs = _with_before(_runs(per, batch_size))
    # runs absent between prev and b make prev + 1 the first bad one, without a bitmap
    bad = F.when(F.col("b") != F.col("prev") + 1, F.col("prev") + 1).when(F.col("n") < batch_size, F.col("b"))
    first = runs.agg(F.min(bad).alias("bad"), F.max("b").alias("top"))
    first = first.join(per.where(F.col("n") < batch_size).select("b", "bm"), F.col("bad") == F.col("b"), "left")
    offset = F.filter(F.sequence(F.lit(0), F.lit(batch_size - 1)), lambda p: ~_is_set(F.col("bm"), p))[0]
    res = first.select(
        F.lit(start).cast("long").alias("start"),
        (F.lit(start) + F.coalesce("bad", F.col("top") + 1, F.lit(0)) * batch_size + F.when(F.col("bm").isNotNull(), offset).otherwise(0)).cast("long").alias("next_index"),
    )
    return res.select(
        "start",
        F.when(F.col("next_index") > F.col("start"), F.col("next_index") - 1).alias("committed_through"),
        (F.col("next_index") - F.col("start")).alias("committed_entries"),
        "next_index",
    )


def gap_report(df: DataFrame, idx: str = "log_index", start: int = 0, tree_size: int | None = None, batch_size: int = BITMAP_BITS) -> DataFrame:
    """Missing index ranges [gap_start, gap_end] in [start, tree_size) with the number of
    present entries stuck behind each gap (present indexes above gap_end).

    Presence is one bitmap per run of ``batch_size`` indexes.  (number, count, first, last) of the runs alone are
    ordered, in chunks, which gives the gaps between runs and the counts before them; incomplete runs are joined
    back to their bitmaps for the gaps inside.
    """
    d = df.select(F.col(idx).cast("long").alias("i"))
    if tree_size is not None:
        # the tree head counts as present, so that what is missing below it ends there
        d = d.filter(F.col("i") < tree_size).unionByName(df.sparkSession.range(tree_size, tree_size + 1).select(F.col("id").alias("i")))
    extra = 0 if tree_size is None else 1
    per = keep(_presence(d, "i", start, batch_size), "presence")  # small, and read more than once
    runs = _with_before(_runs(per, batch_size))
    total = runs.agg((F.sum("n") - extra).alias("total"))
    origin = F.lit(start).cast("long")
    runs = runs.withColumn("base", origin + F.col("b") * batch_size)
    since = F.coalesce(origin + F.col("prev") * batch_size + F.col("prev_hi") + 1, origin)
    between = runs.select("before", since.alias("s"), (F.col("base") + F.col("lo") - 1).alias("e"), F.lit(0).cast("long").alias("k")).where("e >= s")
    partial = runs.where((F.col("n") < batch_size) & (F.col("hi") - F.col("lo") + 1 > F.col("n"))).join(per.select("b", "bm"), "b").repartition("b")
    every = F.sequence(F.lit(0), F.lit(batch_size - 1))
    partial = partial.select("before", "base", F.filter(every, lambda p: _is_set(F.col("bm"), p)).alias("at"))
    inside = F.transform(
        F.filter(F.sequence(F.lit(1), F.size("at") - 1), lambda k: F.col("at")[k] - F.col("at")[k - 1] > 1),
        lambda k: F.struct((F.col("base") + F.col("at")[k - 1] + 1).alias("s"), (F.col("base") + F.col("at")[k] - 1).alias("e"), k.cast("long").alias("k")),
    )
    gaps = between.unionByName(partial.select("before", F.explode(inside).alias("g")).select("before", "g.*")).join(F.broadcast(total))
    return gaps.select(
        F.col("s").alias("gap_start"),
        F.col("e").alias("gap_end"),
        (F.col("e") - F.col("s") + 1).alias("missing"),
        (F.col("total") - F.col("before") - F.col("k")).cast("long").alias("entries_behind"),
    )


def plan_ranges(spark: SparkSession, start: int, tree_size: int, download_size: int, partitions: int | None = None) -> DataFrame:
    """Inclusive (start, end) ranges of ``download_size``; the last one ends at tree_size - 1."""
    if tree_size <= start:
        return spark.range(0).select(F.col("id").alias("start"), F.col("id").alias("end"))
    r = spark.range(start, tree_size, download_size, numPartitions=partitions)
    return r.select(F.col("id").alias("start"), F.least(F.col("id") + download_size - 1, F.lit(tree_size - 1)).alias("end"))


def dedupe_index(df: DataFrame, keys=("log", "log_index")) -> DataFrame:
    """T4: one row per (log, index)."""
    return df.dropDuplicates(list(keys))


def dedupe_stream(stream: DataFrame, delay: str, keys=("log", "log_index"), time_col: str = "event_ts") -> DataFrame:
    """T4 as a stream: the first row of each key; state is kept per key until the watermark, ``delay`` behind the newest time, has passed it.

    A replay within ``delay`` of event time is dropped, across triggers and restarts from the checkpoint; a row
    older than the watermark is late and dropped too, so ``delay`` must cover how far replays reach back.
    """
    return stream.withWatermark(time_col, delay).dropDuplicatesWithinWatermark(list(keys))


def positions(df: DataFrame, part: list[str], order: list[str], bucket) -> DataFrame:
    """1-based row number within ``part`` ordered by ``order`` without a per-part window.

    ``bucket`` is a column monotone in the ordering (e.g. an hour of the timestamp, a chunk of
    the line id).  Rows are numbered inside (part, bucket) windows and shifted by the row
    counts of earlier buckets, so a part that holds a third of the table still spreads over
    many tasks.
    """
    d = df.withColumn("__bk", bucket)
    counts = d.groupBy(*part, "__bk").agg(F.count(F.lit(1)).alias("__n"))
    wc = Window.partitionBy(*part).orderBy("__bk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("__off", F.coalesce(F.sum("__n").over(wc), F.lit(0))).drop("__n")
    w = Window.partitionBy(*part, "__bk").orderBy(*order)
    return d.withColumn("__rn", F.row_number().over(w)).join(offsets, [*part, "__bk"]).withColumn(
        "position", F.col("__rn") + F.col("__off")
    ).drop("__bk", "__rn", "__off")


def running_total(df: DataFrame, part: list[str], order: list[str], bucket, value: str, out: str = "running") -> DataFrame:
    """Running sum of ``value`` within ``part`` ordered by ``order``, computed two-level like
    ``positions``: a cumulative sum inside (part, bucket) windows plus the totals of earlier
    buckets from a per-bucket table."""
    d = df.withColumn("__bk", bucket)
    sums = d.groupBy(*part, "__bk").agg(F.sum(value).alias("__s"))
    wc = Window.partitionBy(*part).orderBy("__bk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.withColumn("__off", F.coalesce(F.sum("__s").over(wc), F.lit(0))).drop("__s")
    w = Window.partitionBy(*part, "__bk").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return d.withColumn("__rs", F.sum(value).over(w)).join(offsets, [*part, "__bk"]).withColumn(out, F.col("__rs") + F.col("__off")).drop(
        "__bk", "__rs", "__off"
    )


def progress_marks(df: DataFrame, part: str, order: str, bucket, interval: int = 100_000) -> DataFrame:
    """The rows at every ``interval``-th processed entry of each part (file)."""
    return positions(df, [part], [order], bucket).filter(F.col("position") % interval == 0)


def next_index(df: DataFrame, idx: str = "log_index", start: int = 0, batch_size: int = BITMAP_BITS) -> DataFrame:
    """T2 for batch runs: the next index to fetch = end of the committed contiguous prefix + 1."""
    return contiguous_prefix(df, idx, start, batch_size).select("next_index")
