import random

from pyspark.sql import functions as F

from ctspark.operators import ordering


def brute_gaps(idx, start):
    s = sorted(set(i for i in idx if i >= start))
    gaps, prev = [], start - 1
    for i in s:
        if i - prev > 1:
            gaps.append((prev + 1, i - 1, sum(1 for j in s if j > i - 1)))
        prev = i
    return gaps


def test_gaps_and_prefix_against_brute_force(spark):
    rnd = random.Random(7)
    for trial in range(3):
        idx = [i for i in range(0, 700) if rnd.random() > 0.05] + [rnd.randrange(700) for _ in range(20)]
        start = rnd.choice([0, 3, 50])
        df = spark.createDataFrame([(i,) for i in idx], "log_index long")
        got = sorted((r.gap_start, r.gap_end, r.entries_behind) for r in ordering.gap_report(df, start=start, batch_size=32).collect())
        assert got == brute_gaps(idx, start)
        s = set(idx)
        nxt = start
        while nxt in s:
            nxt += 1
        r = ordering.contiguous_prefix(df, start=start, batch_size=32).first()
        assert r.next_index == nxt and r.committed_entries == nxt - start


def test_positions_two_level(spark):
    rows = [("a" if i % 3 else "b", i) for i in range(500)]
    df = spark.createDataFrame(rows, "k string, o long")
    out = ordering.positions(df, ["k"], ["o"], F.floor(F.col("o") / 37)).collect()
    for k in ("a", "b"):
        got = sorted((r.o, r.position) for r in out if r.k == k)
        assert [p for _, p in got] == list(range(1, len(got) + 1))


def test_plan_ranges(spark):
    r = [(x.start, x.end) for x in ordering.plan_ranges(spark, 10, 35, 10).orderBy("start").collect()]
    assert r == [(10, 19), (20, 29), (30, 34)]
    assert ordering.plan_ranges(spark, 5, 5, 10).count() == 0


def test_transfer_rate_two_level_matches_single_window(spark):
    import datetime as dt
    import random

    from pyspark.sql import Window

    from ctspark.operators.monitor import MIB, transfer_rate

    rnd = random.Random(4)
    t0 = dt.datetime(2024, 1, 1)
    rows, total = [], {"a": 0, "b": 0}
    for i in range(600):
        k = "a" if rnd.random() < 0.7 else "b"
        total[k] += rnd.randrange(0, 5000)
        step = rnd.choice([0, 7, 13, 40])  # zero steps keep the earlier rate
        t0 = t0 + dt.timedelta(seconds=step)
        rows.append((k, t0, i, total[k]))
    df = spark.createDataFrame(rows, "key string, ts timestamp, event_id long, bytes_done long")
    got = {(r.key, r.event_id): (r.rate_mbps, r.completed) for r in transfer_rate(df, bucket_s=60).collect()}
    # single ordered window per key, as a plain reference
    w = Window.partitionBy("key").orderBy("ts", "event_id")
    us = F.unix_micros(F.col("ts"))
    dts = (us - F.lag(us).over(w)) / 1e6
    raw = F.when(dts > 0, (F.col("bytes_done") - F.lag("bytes_done").over(w)) / MIB / dts)
    ref = df.withColumn("raw", raw).withColumn("r", F.coalesce(F.last("raw", True).over(w.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0.0)))
    ref = ref.withColumn("c", F.row_number().over(Window.partitionBy("key").orderBy(F.col("ts").desc(), F.col("event_id").desc())) == 1)
    want = {(r.key, r.event_id): (round(r.r, 6), r.c) for r in ref.collect()}
    assert got == want


def test_rolling_rate_and_eta_edges(spark):
    import datetime as dt

    from ctspark.operators.monitor import progress_eta, rolling_rate

    t0 = dt.datetime(2024, 1, 1)
    rows = [
        (t0, 1, 100),  # first sample: fewer than 2 -> 0
        (t0 + dt.timedelta(milliseconds=500), 2, 150),  # under 1 s elapsed -> 0
        (t0 + dt.timedelta(seconds=10), 3, 200),  # (200 - 100) / 10 s
        (t0 + dt.timedelta(seconds=200), 4, 1000),  # window 60 s: only itself -> 0
        (t0 + dt.timedelta(seconds=230), 5, 1300),  # (1300 - 1000) / 30 s
    ]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, event_id long, value long")
    r = {x.event_id: x for x in progress_eta(rolling_rate(df, window_s=60, bucket_s=100), total=1300).collect()}
    assert [r[i].rate for i in range(1, 6)] == [0.0, 0.0, 10.0, 0.0, 10.0]
    assert r[3].eta_s == 110 and r[1].eta_s is None and r[5].eta_s is None  # rate < 1 / nothing left
    assert r[5].percent == 100.0


def test_running_total_and_health_two_level(spark):
    import datetime as dt
    import random

    from pyspark.sql import Window

    from ctspark.operators.monitor import endpoint_health

    rnd = random.Random(8)
    t0 = dt.datetime(2024, 1, 1)
    rows = [("e" + str(rnd.randrange(2)), t0 + dt.timedelta(seconds=17 * i), i, rnd.random() < 0.4, rnd.randrange(100)) for i in range(800)]
    df = spark.createDataFrame(rows, "endpoint string, ts timestamp_ntz, event_id long, success boolean, bytes long")
    got = {r.event_id: r.run for r in ordering.running_total(df, ["endpoint"], ["ts", "event_id"], F.floor(F.col("event_id") / 50), "bytes", "run").collect()}
    w = Window.partitionBy("endpoint").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    want = {r.event_id: r.run for r in df.select("event_id", F.sum("bytes").over(w).alias("run")).collect()}
    assert got == want
    # consecutive failures with 10-minute buckets against a plain sequential count
    health = {r.event_id: r.consecutive_failures for r in endpoint_health(df, max_failures=3, bucket_s=600).collect()}
    streak = {}
    for ep, _ts, i, ok, _b in rows:
        streak[ep] = 0 if ok else streak.get(ep, 0) + 1
        assert health[i] == streak[ep], i


def test_histograms_are_mergeable_and_within_a_thousandth(spark):
    import math
    import random
    from datetime import datetime, timedelta

    from ctspark.operators.monitor import histogram_latency, latency_histogram, merge_histograms

    rng = random.Random(5)
    rows = [(f"e{rng.randint(0, 2)}", datetime(2024, 1, 1) + timedelta(minutes=i), math.exp(rng.uniform(-3, 11))) for i in range(3000)] + [("e0", datetime(2024, 1, 1), 0.0)]
    df = spark.createDataFrame(rows, "endpoint string, ts timestamp, duration_ms double")
    slots = latency_histogram(df, slot_s=3600)
    whole = {tuple(r) for r in latency_histogram(df).collect()}
    assert {tuple(r) for r in merge_histograms(slots.where("slot % 3 = 0"), slots.where("slot % 3 = 1"), slots.where("slot % 3 = 2")).select("endpoint", "code", "calls").collect()} == whole
    for r in histogram_latency(merge_histograms(slots)).collect():
        mine = sorted(d for e, _, d in rows if e == r.endpoint and d > 0)
        for p, got in ((0.95, r.p95_ms), (0.99, r.p99_ms), (1.0, r.max_ms)):
            exact = mine[math.ceil(len(mine) * p) - 1]
            assert abs(got / exact - 1) <= 0.001, (p, got, exact)
        assert r.recorded_calls == len(mine) and abs(r.mean_ms / (sum(mine) / len(mine)) - 1) < 0.001


def test_gaps_and_prefix_across_chunks(spark, monkeypatch):
    """Runs and chunks of a few indexes: the two-level pass against brute force."""
    import random

    from ctspark.operators import ordering

    monkeypatch.setattr(ordering, "CHUNK", 3)
    rng = random.Random(9)
    for share, start in ((0.5, 0), (0.97, 7), (1.0, 0), (0.05, 3)):
        have = sorted(i for i in range(start, 900) if rng.random() < share and not 300 <= i < 420) or [start]
        df = spark.createDataFrame([(i,) for i in have for _ in range(1 + i % 2)], "log_index long")
        present, gaps, at = set(have), [], start
        for i in have:
            if i > at:
                gaps.append((at, i - 1, i - at, sum(j > i - 1 for j in have)))
            at = i + 1
        got = ordering.gap_report(df, start=start, batch_size=8).collect()
        assert sorted(tuple(r) for r in got) == gaps
        nxt = next(i for i in range(start, 1000) if i not in present)
        assert ordering.contiguous_prefix(df, start=start, batch_size=8).first().next_index == nxt
        assert ordering.next_index(df, start=start).first()[0] == nxt


def test_no_window_over_bitmaps(spark):
    from ctspark.operators import ordering

    df = spark.range(100).selectExpr("id AS log_index")
    for d in (ordering.gap_report(df), ordering.contiguous_prefix(df)):
        plan = d._jdf.queryExecution().optimizedPlan().toString()
        windows = [line for line in plan.splitlines() if "Window [" in line]
        assert windows and not any("bm" in line or "bitmap" in line for line in windows)
