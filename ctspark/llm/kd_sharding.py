"""Shards of equal bytes by a k-d tree over document metadata.

The space has one axis per metadata value: source, language and id, each scaled to 0..1 over the
whole table (names by their place in hash order).  A node is split across its widest axis at the weighted median, the
weight being the bytes of a document, until the number of leaves is reached, which fixes the bytes
of a leaf.  Where the number of leaves is odd the cut is the matching quantile.

A median is found exactly in distributed histograms: positions on the axis are whole numbers of 63
bits, the upper bits the scaled value, the lower ones a hash of the text and of the row, so equal
values (a hot source, a group of copies) can be cut anywhere, and copies stay next to each other.
Four passes of sixteen bits each count bytes by bucket and narrow every node's cut down; a pass returns
one row per node.  Slots are numbered in two steps, by shard and input partition.

Only DataFrame operations are used.  A null text has no bytes and weighs 1, null metadata lie at 0.
Repeated rows are rows of their own.  An empty table gives an empty result; further columns do not
matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import settle

#: Bits of a position: the scaled value, the text's hash, the row's hash.
VALUE_BITS, TEXT_BITS, ROW_BITS = 24, 19, 20
STEP_BITS = 16


def _axis(value: Column, low, high) -> Column:
    """``value`` scaled to 0 .. 2 ** VALUE_BITS - 1; 0 where it is null or the axis has no width."""
    if low is None or high is None or high <= low:
        return F.lit(0).cast("long")
    scaled = F.floor((value - F.lit(low)) / F.lit(high - low) * ((1 << VALUE_BITS) - 1)).cast("long")
    return F.coalesce(F.greatest(F.lit(0), F.least(F.lit((1 << VALUE_BITS) - 1), scaled)), F.lit(0)).cast("long")


def _by_node(nodes: dict[int, int], values: dict[int, Column | int]) -> Column:
    out = None
    for node in nodes:
        v = values[node] if isinstance(values[node], Column) else F.lit(values[node])
        out = F.when(F.col("node") == node, v) if out is None else out.when(F.col("node") == node, v)
    return out


def shard(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text", metadata: tuple = ("source", "lang"), with_text_crc: bool = False) -> DataFrame:
    """(id, size, shard, slot[, text_crc32]) of every row; shards differ by about one document's bytes."""
    text = F.col(text_col).cast("string")
    size = (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")
    raw = {"x_id": F.coalesce(F.col(id_col).try_cast("double"), F.pmod(F.xxhash64(id_col), F.lit(1 << 30)).cast("double"))}
    for name in metadata:
        if name in docs.columns:
            raw[f"x_{name}"] = F.pmod(F.xxhash64(F.col(name).cast("string")), F.lit(1 << 30)).cast("double")
    points = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias("id"),
        size.alias("bytes"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("crc"),
        F.pmod(F.xxhash64(text), F.lit(1 << TEXT_BITS)).alias("t"),
        *(c.alias(f"raw_{n}") for n, c in raw.items()),
    )
    points = settle(points, "points")
    axes = list(raw)
    ends = points.agg(*(f(f"raw_{a}").alias(f"{f.__name__}_{a}") for a in axes for f in (F.min, F.max))).first()
    tail = F.shiftleft(F.col("t"), ROW_BITS) + F.pmod(F.xxhash64("row"), F.lit(1 << ROW_BITS))
    points = points.select("row", "id", "bytes", "crc", tail.alias("tail"), *(_axis(F.col(f"raw_{a}"), ends[f"min_{a}"], ends[f"max_{a}"]).alias(a) for a in axes)).withColumn("node", F.lit(0))
    leaves = {0: shards}  # node: how many leaves are below it; node numbers are the first leaf's
    while max(leaves.values()) > 1:
        open_nodes = {n: k for n, k in leaves.items() if k > 1}
        stats = points.where(F.col("node").isin(list(open_nodes))).groupBy("node").agg(F.sum("bytes").alias("w"), *(f(a).alias(f"{f.__name__}_{a}") for a in axes for f in (F.min, F.max))).collect()
        stats = {r["node"]: r for r in stats}
        widest = {n: max(axes, key=lambda a, r=stats[n]: r[f"max_{a}"] - r[f"min_{a}"]) for n in open_nodes if n in stats}
        position = {n: F.shiftleft(F.col(a), TEXT_BITS + ROW_BITS) + F.col("tail") for n, a in widest.items()}
        goal = {n: stats[n]["w"] * (k // 2) / k for n, k in open_nodes.items() if n in stats}
        cuts = _cuts(points, widest, position, goal) if widest else {}
        following = dict(leaves)
        for n, k in open_nodes.items():
            following[n], following[n + k // 2] = k // 2, k - k // 2
        if cuts:
            step = _by_node(cuts, {n: F.when(position[n] >= cuts[n], F.lit(n + open_nodes[n] // 2)).otherwise(F.lit(n)) for n in cuts})
            points = settle(points.withColumn("node", F.coalesce(step, F.col("node"))), "nodes")
        leaves = following
    placed = points.select("row", "id", "bytes", "crc", F.col("node").cast("int").alias("shard"), F.shiftright("row", 33).alias("part"))
    counts = placed.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
    before = counts.select("shard", "part", (F.sum("n").over(Window.partitionBy("shard").orderBy("part")) - F.col("n")).alias("first"))
    within = F.row_number().over(Window.partitionBy("shard", "part").orderBy("row")) - 1
    out = placed.withColumn("slot", within).join(before, ["shard", "part"])
    extra = [F.col("crc").alias("text_crc32")] if with_text_crc else []
    return out.select(F.col("id").alias(id_col), F.col("bytes").alias("size"), *extra, "shard", (F.col("slot") + F.col("first")).cast("long").alias("slot"))


def _cuts(placed: DataFrame, widest: dict, position: dict, goal: dict) -> dict[int, int]:
    """For each node the position at which the bytes before come nearest to its goal."""
    placed = placed.where(F.col("node").isin(list(widest))).select("node", "bytes", _by_node(widest, position).alias("x"))
    total_bits = VALUE_BITS + TEXT_BITS + ROW_BITS
    prefix, left = {n: 0 for n in widest}, dict(goal)
    bits = 0
    while bits < total_bits:
        step = min(STEP_BITS, total_bits - bits)
        shift = total_bits - bits - step
        here = placed if not bits else placed.where(F.shiftright("x", total_bits - bits) == _by_node(widest, prefix))
        found = here.groupBy("node", F.shiftright("x", shift).alias("b")).agg(F.sum("bytes").alias("w"))
        w = Window.partitionBy("node").orderBy("b")  # 2 ** STEP_BITS buckets at most
        upto = found.withColumn("upto", F.sum("w").over(w))
        # the bucket that holds the goal: the last one that begins before it
        start = F.col("upto") - F.col("w")
        target = _by_node(widest, {n: float(v) for n, v in left.items()})
        row = upto.where(start <= target).groupBy("node").agg(F.max_by(F.struct(F.col("b").alias("b"), start.alias("s"), F.col("w").alias("w")), "b").alias("r")).collect()
        for r in row:
            prefix[r["node"]] = r["r"]["b"]
            left[r["node"]] -= r["r"]["s"]
            last = r["r"]["w"]
            if shift == 0 and left[r["node"]] > last / 2:  # the row at the border goes where less is missing
                prefix[r["node"]] += 1
        bits += step
    return prefix
