"""Merkle manifest of a dataset by nested-interval labels, with proofs for every row.

Every row is a leaf: the SHA-256 of its fields, each as ``-`` if null, else byte count, ``:``, value.
The leaves of a group (a source) are ranked, and a node carries the interval [lo, hi) of the ranks it
covers.  Nodes of one level that share a cell of ``fanout`` times their width become their parent, until
one node is left: the group's subroot.  Subroots are ranked by group and hashed up to the root alike.

* Ranks come from a range partitioning by group, order and leaf: a row's rank is its place in its
  partition and the partition's offset, so a hot group is spread over many tasks.
* A node is given its parent by a containment join: the parent's interval holds its own.  Levels are
  joined apart, and both sides are dealt by the cell of the parent's width, so a key has ``fanout`` rows at most.
* What the parent's interval holds besides the node's own are its siblings: those that end before it
  to the left, those that start behind it to the right.
* The join goes from the top down, so a parent already has its path to the root.  Runs are collected in
  arrays of ``fanout`` digests, and the tree's height is the number of passes.

Groups are ordered bytewise, null first; so are null orders in a group.  Rows that repeat a group and
order are ordered by their leaf, and equal leaves have equal proofs.  Empty texts and texts of any length
are values like others.  An empty table gives an empty result without a root.  Columns that are not
named do not matter, whatever they are called.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import settle

FANOUT = 16
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PART_BITS = 33  # monotonically_increasing_id(): partition above, place below


class Manifest(NamedTuple):
    """A dataset's tree: ``leaves`` (tree, n, lo, hi, digest and what was kept), its levels, and those above the subroots."""

    leaves: DataFrame
    levels: list
    groups: DataFrame
    tops: list
    root: str | None
    fanout: int


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of strings put together."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def leaf(values: list[Column]) -> Column:
    """The leaf of a row's fields."""
    texts = [v.cast("string") for v in values]
    return digest(*(F.when(t.isNull(), "-").otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts))


def lowered(text: Column) -> Column:
    """``text`` with A-Z in lower case, other letters as they are."""
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def _ranked(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Adds ``rank``, the place of each row in the order of ``keys``; equal rows are dealt by a running number."""
    df = df.withColumn("at", F.monotonically_increasing_id())
    df = df.repartitionByRange(*keys, "at").sortWithinPartitions(*keys, "at").withColumn("at", F.monotonically_increasing_id())
    df = settle(df.withColumn("part", F.shiftright("at", _PART_BITS)), name)
    # one row per partition of the order, so the window and the broadcast are as small as their number
    sizes = df.groupBy("part").agg(F.count(F.lit(1)).alias("size"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))
    place = F.col("at").bitwiseAND(F.lit((1 << _PART_BITS) - 1))
    return df.join(F.broadcast(bases), "part").withColumn("rank", F.col("base") + place).drop("part", "base", "at")


def _levels(nodes: DataFrame, fanout: int, name: str) -> list[DataFrame]:
    """Levels 1, 2, ... over ``nodes`` (tree, n, lo, hi, digest): (tree, n, lo, hi, digest, run), run being a node's children."""
    most = nodes.agg(F.max("n")).first()[0] or 0
    out, width, below = [], 1, nodes
    while width < most:
        cell = F.floor(F.col("lo") / (width * fanout)).alias("cell")
        runs = below.where(F.col("n") > width).groupBy("tree", "n", cell).agg(F.sort_array(F.collect_list(F.struct("lo", "hi", "digest"))).alias("run"))
        whole = digest(F.array_join(F.transform("run", lambda x: x["digest"]), ""))
        below = settle(runs.select("tree", "n", F.element_at("run", 1)["lo"].alias("lo"), F.element_at("run", -1)["hi"].alias("hi"), whole.alias("digest"), "run"), name)
        out.append(below)
        width *= fanout
    return out


def _tops(nodes: DataFrame, levels: list[DataFrame], fanout: int) -> DataFrame:
    """(tree, n, digest) of the node that is left of each tree."""
    out = nodes.where("n = 1").select("tree", "n", "digest")
    for i, level in enumerate(levels, 1):
        out = out.union(level.where(F.col("n").between(fanout ** (i - 1) + 1, fanout**i)).select("tree", "n", "digest"))
    return out


def build(docs: DataFrame, fields: list[str], group: str = "source", order: str = "doc_id", keep: dict[str, Column] | None = None, fanout: int = FANOUT) -> Manifest:
    """The manifest of ``docs``; ``keep`` names further values of each row that stay beside its leaf."""
    kept = [v.alias(f"kept_{k}") for k, v in (keep or {}).items()]
    rows = docs.select(F.col(group).alias("group"), F.col(order).alias("order"), leaf([F.col(f) for f in fields]).alias("digest"), *kept)
    # hashed once: the range partitioning reads its input twice
    rows = _ranked(settle(rows, "leaves"), ["group", "order", "digest"], "order")
    groups = rows.groupBy("group").agg(F.min("rank").alias("tree"), F.count(F.lit(1)).alias("n"))
    groups = settle(_ranked(settle(groups, "groups"), ["tree"], "group-order").withColumnRenamed("rank", "ordinal"), "groups")
    leaves = rows.join(groups.select(F.col("group").alias("g"), "tree", "n"), F.col("group").eqNullSafe(F.col("g"))).drop("g")
    leaves = settle(leaves.withColumn("lo", F.col("rank") - F.col("tree")).withColumn("hi", F.col("lo") + 1).drop("rank"), "ranked")
    levels = _levels(leaves, fanout, "level")
    many = groups.count()
    subroots = groups.select("tree", "ordinal").join(_tops(leaves, levels, fanout).select("tree", "digest"), "tree")
    subroots = settle(subroots.select(F.lit(0).cast("long").alias("tree"), F.lit(many).cast("long").alias("n"), F.col("ordinal").alias("lo"), (F.col("ordinal") + 1).alias("hi"), "digest", F.col("tree").alias("group_tree")), "subroots")
    tops = _levels(subroots, fanout, "top")
    root = _tops(subroots, tops, fanout).select("digest").first()
    return Manifest(leaves, levels, subroots, tops, root[0] if root else None, fanout)


def _attach(nodes: DataFrame, parents: DataFrame, width: int) -> DataFrame:
    """``nodes`` with ``path``: the siblings under the parent that contains each, and the parent's own path."""
    cells = F.sequence(F.floor(F.col("lo") / width), F.floor((F.col("hi") - 1) / width))
    above = parents.select(F.col("tree").alias("t"), F.col("lo").alias("from"), F.col("hi").alias("to"), "run", F.col("path").alias("on"), F.explode(cells).alias("c"))
    inside = (F.col("tree") == F.col("t")) & (F.floor(F.col("lo") / width) == F.col("c")) & (F.col("from") <= F.col("lo")) & (F.col("hi") <= F.col("to"))
    left = F.filter("run", lambda x: x["hi"] <= F.col("lo"))
    right = F.filter("run", lambda x: x["lo"] >= F.col("hi"))
    sides = F.struct(*(F.array_join(F.transform(side, lambda x: x["digest"]), "").alias(name) for side, name in ((left, "left"), (right, "right"))))
    return nodes.join(above, inside).withColumn("path", F.concat(F.array(sides), F.col("on"))).drop("t", "from", "to", "on", "c", *(() if "run" in nodes.columns else ("run",)))


def _paths(nodes: DataFrame, levels: list[DataFrame], fanout: int, starts: DataFrame) -> DataFrame:
    """``nodes`` with their paths; ``starts`` (tree, path) has those of the trees' tops."""
    first = starts.select(F.col("tree").alias("t"), F.col("path"))
    done = None
    for i in range(len(levels), -1, -1):
        level, width = ([nodes, *levels][i], fanout**i)
        here = level.where(F.col("n") <= width).where(F.col("n") > width // fanout).join(first, F.col("tree") == F.col("t")).drop("t")
        if done is not None:
            inner = level.where(F.col("n") > width)
            if i:
                inner = inner.withColumnRenamed("run", "own")
            inner = _attach(inner, done, width * fanout)
            here = here.unionByName(inner.withColumnRenamed("own", "run") if i else inner)
        done = here
    return done


def proofs(manifest: Manifest) -> DataFrame:
    """Every leaf with ``subroot`` and ``path``: per level up to the root the digests to its left and right, put together."""
    spark = manifest.leaves.sparkSession
    step = "array<struct<left: string, right: string>>"
    start = spark.range(1).select(F.lit(0).cast("long").alias("tree"), F.from_json(F.lit("[]"), step).alias("path"))
    groups = _paths(manifest.groups, manifest.tops, manifest.fanout, start)
    groups = settle(groups.select(F.col("group_tree").alias("tree"), "path", F.col("digest").alias("subroot")), "group-paths")
    out = _paths(manifest.leaves, manifest.levels, manifest.fanout, groups)
    return out.join(groups.select(F.col("tree").alias("t"), "subroot"), F.col("tree") == F.col("t")).drop("t")


def proof_digest(path: Column) -> Column:
    """SHA-256 of all siblings of a path, level by level, left to right."""
    return digest(F.array_join(F.transform(path, lambda x: F.concat(x["left"], x["right"])), ""))


def folded(own: Column, path: Column) -> Column:
    """The root that a leaf and its path give."""
    return F.aggregate(path, own, lambda acc, x: digest(x["left"], acc, x["right"]))
