"""Exact Jaccard join in the metric space of shingle sets, by pivots and their Voronoi regions.

d(x, y) = 1 - |x & y| / |x | y| is a metric.  Documents as pivots do not divide a corpus: two
unrelated documents are at distance 1 from each other and from nearly every pivot, so the window
of twice the radius would copy each document into each region.  The first pivots are therefore
single shingles: a document is nearer than 1 to {s} exactly if it holds s.  It lies on the border of all
its shingles' regions, and how many of them it must be copied to follows from the radius:

* Shingles are ordered by hash.  With p = |x| - ceil(t |x|) + 1, documents within the radius share at
  least l = q - p + 1 of their q lowest shingles, q = min(|x|, p + |x| / 10 + 1).  Only these q (a
  fifth of a document at t = 0.9) are counted over the corpus, and a document with fewer than l
  shingles that also occur elsewhere has no partner and goes.
* The whole sets of the others are counted among themselves and put in order of rising frequency.
  Partners share one of their first p shingles; those that occur elsewhere are a document's regions.

Inside a region documents are close, and documents serve as pivots: the one with the fewest shingles
of its own is compared with all members.  Members within the radius are linked by this alone, so a
group of copies costs one comparison each.  Regions that still hold several components elect a further pivot
from another component, and so on, until a member has few possible partners on average (``CELL``) or a turn no longer
halves the pairs.  The rest is
compared in rings around the first pivot: by the triangle inequality partners' distances to any pivot differ by
the radius at most, so a document is copied to its own ring and the next ones.  At the first region that two
documents share, what either has before it is missing in the other, which bounds their distance from below: one
of two partners has the region early in its order, so only such members look for partners.  A bitmap of 1,024
bits in which every shingle of a set turns one bit gives another bound, as differing bits are differing shingles.
Pairs already in one component are not compared again.  A region's rows carry its size, and members of
large regions are dealt by salt.

Texts of any length are read whole.  Ties in the order of shingles go by their hash.  Equal sets are collapsed first.  A null text or one without words has the empty set and is linked
with nothing.  Repeated rows are copies of each other.  Null ids are allowed; a component's id is its
smallest non-null one.  Further columns do not matter.  An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Temporary, bitmap, connected_components, filter_bits, pieces, released, settle, utf8

#: Words that a worker remembers the hash of, and bytes of text that it takes together.
CACHE_ENTRIES = 200_000
PIECE = 8 << 20
#: Members of a region that one task takes together, and partners a member may have without another pivot.
CELL = 1000
#: Words of 64 bits of a set's parity bitmap.
WORDS = 16
#: Earlier regions that a region's row names; more would only spare more repeats.
PRIOR = 8


class Shingler:
    """Distinct shingle hashes of a text, ascending (signed 64 bits)."""

    def __init__(self, width: int):
        from xxhash import xxh3_64_intdigest

        self.width, self.digest, self.known = width, xxh3_64_intdigest, {}

    def __call__(self, raw: bytes) -> np.ndarray:
        words = raw.lower().split()  # ASCII letters and blanks only
        if not words:
            return np.empty(0, np.int64)
        known = self.known
        try:
            ids = list(map(known.__getitem__, words))
        except KeyError:
            if len(known) > CACHE_ENTRIES:
                known.clear()
            for w in words:
                if w not in known:
                    known[w] = self.digest(w)
            ids = list(map(known.__getitem__, words))
        h = np.array(ids, np.uint64)
        if len(words) < self.width:
            parts, seed = [h[i : i + 1] for i in range(len(words))], len(words)
        else:
            parts, seed = [h[i : len(h) - self.width + 1 + i] for i in range(self.width)], 0
        out = np.full(len(parts[0]), 0x9E3779B97F4A7C15 + seed, np.uint64)
        for x in parts:
            out = (out ^ x) * np.uint64(0xD6E8FEB86659FD93)
            out ^= out >> np.uint64(32)
        return np.unique((out * np.uint64(0x9E3779B97F4A7C15)).view(np.int64))


def _prefix(n: int, num: int, den: int) -> tuple[int, int]:
    """(p, q) of a set of n shingles."""
    p = n + (-num * n) // den + 1
    return p, min(n, p + n // 10 + 1)


def _need(n: int, num: int, den: int) -> int:
    """Shared shingles that any partner implies among the q lowest of a set of n."""
    smallest = -((-num * n) // den)
    p, q = _prefix(smallest, num, den)
    return q - p + 1


def link_components(docs: DataFrame, width: int = 3, num: int = 90, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id) of every row; sets link when den * |x & y| >= num * |x | y|."""
    kind = docs.schema[id_col].dataType.simpleString()
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def sketch(batches):
        from xxhash import xxh3_128_digest

        shingles = Shingler(width)
        for b in pieces(batches, PIECE):
            sets = [shingles(r) for r in utf8(b.column(2))]
            # the order is that of the whole hashes; 48 bits of them are enough to filter by
            low = [(s[: _prefix(len(s), num, den)[1]] >> 16) & _LOW if len(s) else s for s in sets]
            at = np.concatenate([[0], np.cumsum([len(x) for x in low])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0),
                    b.column(1),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                    pa.array([_need(len(s), num, den) if len(s) else 0 for s in sets], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(low), pa.int64())),
                ],
                ["row", "id", "n", "key", "need", "low"],
            )

    with Temporary() as tables:
        return _components(src, sketch, kind, width, num, den, id_col, tables)


def _components(src: DataFrame, sketch, kind: str, width: int, num: int, den: int, id_col: str, tables: Temporary) -> DataFrame:
    rows = settle(src.select(F.monotonically_increasing_id().alias("row"), "id", "text").mapInArrow(released(sketch), f"row long, id {kind}, n long, key binary, need long, low array<long>"), "sketch")
    tables.keep(rows)
    entries = rows.where("n > 0").select("row", F.explode("low").alias("h"))
    shared = entries.groupBy("h").agg(F.count(F.lit(1)).alias("df")).where("df > 1").select("h")
    mine = entries.join(shared, "h").groupBy("row").agg(F.count(F.lit(1)).alias("shared"))
    wanted = rows.select("row", "key", "need").join(mine, "row").where("shared >= need").groupBy("key").agg(F.min("row").alias("row"))
    members = _member_sets(src, settle(wanted, "wanted"), width)
    regions = settle(_regions(members, num, den), "regions")
    component = connected_components(_links(regions, members, num, den))
    component = tables.keep(settle(members.select("key", "row").join(component, F.col("row") == F.col("node"), "left").select("key", "component"), "members"))

    groups = rows.where("n > 0").groupBy("key").agg(F.min("id").alias("first")).join(component, "key", "left")
    big = groups.where("component is not null").groupBy("component").agg(F.min("first").alias("least"))
    named = groups.join(big, "component", "left").select("key", F.coalesce("least", "first").alias("component_id"))
    out = rows.select("id", "n", "key").join(named, "key", "left")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("component_id")).alias("component_id"))


_LOW = (1 << 48) - 1


def _member_sets(src: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(row, key, hs, parity): the whole shingle set of each wanted (key, row), and its parity bitmap.

    The texts are read a second time.  A bitmap of the wanted keys, sized by their number, lets most
    texts be skipped; the join decides.
    """
    power = filter_bits(wanted.count())
    mask = (1 << power) - 1
    bits = bitmap(wanted.select(F.conv(F.hex(F.substring("key", 1, 4)), 16, 10).cast("long").bitwiseAND(F.lit(mask)).alias("b")), power)
    shared = src.sparkSession.sparkContext.broadcast(bits)

    def again(batches):
        from xxhash import xxh3_128_digest

        shingles, known = Shingler(width), shared.value
        for b in pieces(batches, PIECE):
            keys, sets, seen = [], [], set()
            for r in utf8(b.column(0)):
                s = shingles(r)
                key = xxh3_128_digest(s.tobytes())
                spot = int.from_bytes(key[:4], "big") & mask
                if key not in seen and (int(known[spot >> 5]) >> (spot & 31)) & 1:
                    seen.add(key)
                    keys.append(key)
                    sets.append(s)
            if keys:
                at = np.concatenate([[0], np.cumsum([len(x) for x in sets])]).astype(np.int32)
                words = np.arange(0, WORDS * (len(sets) + 1), WORDS, np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.binary()), pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(sets), pa.int64())), pa.ListArray.from_arrays(pa.array(words), pa.array(np.concatenate([parity(s) for s in sets])))],
                    ["key", "hs", "parity"],
                )

    found = src.select("text").mapInArrow(released(again), "key binary, hs array<long>, parity array<long>")
    return settle(found.join(wanted, "key").groupBy("row", "key").agg(F.first("hs").alias("hs"), F.first("parity").alias("parity")), "sets")


def parity(hashes: np.ndarray) -> np.ndarray:
    """A bitmap in which each hash turns one bit: two sets differ in as many elements as their bitmaps do in bits, or more."""
    odd = np.bincount((hashes & (64 * WORDS - 1)).astype(np.int64), minlength=64 * WORDS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _salts(size: Column) -> Column:
    """How many salts the members of a region of this size are dealt to."""
    return F.ceil(size / CELL)


def _regions(members: DataFrame, num: int, den: int) -> DataFrame:
    """(row, n, own, h, size, salt, pos, prior): a document's regions, and the place of each in its order by frequency.

    ``own`` counts the shingles that no other member has; they come first in the order.  ``prior`` has
    the first few regions before this one, by which most repeats of a pair are seen.
    """
    entries = members.select("row", F.explode("hs").alias("h"))
    shared = entries.groupBy("h").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    mine = entries.join(shared, "h").groupBy("row").agg(F.sort_array(F.collect_list(F.struct("df", "h"))).alias("xs"))
    mine = mine.join(members.select("row", F.size("hs").cast("long").alias("n")), "row")
    mine = mine.select("row", "n", (F.col("n") - F.size("xs")).alias("own"), F.expr(f"n - ({num} * n + {den - 1}) div {den} + 1").alias("p"), "xs").where("own < p")
    mine = mine.select("row", "n", "own", F.expr("slice(xs, 1, cast(greatest(p - own, 0) as int))").alias("xs"), F.expr(f"transform(slice(xs, 1, {PRIOR}), x -> x.h)").alias("first"))
    # all that a region's row needs is in its element, so that no list is copied to each of its rows
    one = lambda x, k: F.struct(x["h"].alias("h"), x["df"].alias("size"), k.alias("k"), F.slice("first", F.lit(1), F.least(k, F.lit(PRIOR))).alias("prior"))
    flat = mine.select("row", "n", "own", F.explode(F.transform("xs", one)).alias("x"))
    size = F.col("x.size")
    return flat.select("row", "n", "own", "x.h", size.alias("size"), F.pmod(F.xxhash64("row"), _salts(size)).alias("salt"), (F.col("own") + F.col("x.k")).alias("pos"), "x.prior")


def _distances(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """Adds ``i`` and ``u``, the sizes of intersection and union, to distinct pairs (a, b, size).

    A ``b`` is a pivot; ``size`` tells of how large a region, and its set is copied to as many salts.
    """
    left = members.select(F.col("row").alias("a"), F.col("hs").alias("x"))
    pivots = pairs.groupBy("b").agg(F.max("size").alias("most")).join(members.select(F.col("row").alias("b"), F.col("hs").alias("y")), "b")
    right = pivots.select("b", "y", F.explode(F.sequence(F.lit(0).cast("long"), _salts(F.col("most")) - 1)).alias("salt"))
    both = pairs.join(left, "a").withColumn("salt", F.pmod(F.xxhash64("a"), _salts(F.col("size")))).join(right, ["b", "salt"])
    both = both.select("a", "b", F.size(F.array_intersect("x", "y")).alias("i"), (F.size("x") + F.size("y")).alias("s"))
    return both.select("a", "b", F.col("i").cast("long").alias("i"), (F.col("s") - F.col("i")).cast("long").alias("u"))


def _spread(by_region: DataFrame) -> DataFrame:
    """A table of one row a region, copied to all salts of its members."""
    return by_region.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), _salts(F.col("size")) - 1))).drop("size")


def _turn(rest: DataFrame, members: DataFrame, links: DataFrame | None, turn: int, linked: str) -> tuple[DataFrame, DataFrame]:
    """One election: (regions that still hold pairs to compare, all links so far).

    Adds ``d<turn>``, each member's distance to its region's pivot ``b<turn>``; ``c`` is its component.
    """
    able = rest if turn == 1 else rest.where("not array_contains(tried, c)")
    pivots = able.groupBy("h").agg(F.min(F.struct("own", "row")).alias("p"), F.max("size").alias("size")).select("h", "size", F.col("p.row").alias("b"))
    # regions whose components have all had a pivot wait for the last step
    near = rest.drop("tried").join(_spread(pivots), ["h", "salt"], "left")
    asked = near.where("row <> b").groupBy(F.col("row").alias("a"), "b").agg(F.max("size").alias("size"))
    dist = settle(_distances(asked, members), f"dist{turn}")
    new = dist.where(linked).select("a", "b")
    links = new if links is None else links.union(new)
    placed = near.withColumnRenamed("row", "a").join(dist, ["a", "b"], "left").withColumnRenamed("a", "row")
    placed = placed.withColumn(f"d{turn}", F.when(F.col("row") == F.col("b"), 0.0).otherwise(1.0 - F.col("i") / F.col("u"))).withColumnRenamed("b", f"b{turn}").drop("i", "u", "c")
    c = connected_components(links)
    placed = placed.join(c, placed.row == c.node, "left").withColumn("c", F.coalesce("component", "row")).drop("node", "component")
    was_pivot = F.coalesce(F.col("row").isin(*(F.col(f"b{t}") for t in range(1, turn + 1))), F.lit(False))
    # a region goes on while two members in different components were no pivots yet
    others = F.when(~was_pivot, F.col("c"))
    alive = placed.groupBy("h").agg(F.max("size").alias("size"), F.min(others).alias("lo"), F.max(others).alias("hi"), F.collect_set(F.when(was_pivot, F.col("c"))).alias("tried")).where("lo <> hi").drop("lo", "hi")
    return settle(placed.join(_spread(alive), ["h", "salt"]), f"rest{turn}"), links


def _early(num: int, den: int) -> Column:
    """Whether a member has its region so early that it is the first of two partners: their places add up to what they may differ in."""
    return 2 * F.col("pos") * num <= F.col("n") * (den - num)


def _links(regions: DataFrame, members: DataFrame, num: int, den: int) -> DataFrame:
    """Links (a, b) whose components are those of all links of the regions' members."""
    linked = f"{den} * i >= {num} * u"
    busy = regions.groupBy("h").agg(F.max("size").alias("size"), F.count(F.lit(1)).alias("m")).where("m > 1").drop("m")
    rest = regions.join(_spread(busy), ["h", "salt"]).withColumn("c", F.col("row"))
    links, turn, before = None, 0, None
    while True:
        turn += 1
        rest, links = _turn(rest, members, links, turn, linked)
        by = rest.groupBy("h").agg(F.count_if(_early(num, den)).alias("e"), F.count(F.lit(1)).alias("m"), F.count_if(~F.array_contains("tried", F.col("c"))).alias("new"))
        left = by.agg(F.sum(F.col("e") * F.col("m")).alias("pairs"), F.sum("m").alias("rows"), F.sum("new").alias("new")).first()
        if not left["pairs"]:
            return links
        if not left["new"] or left["pairs"] <= CELL * left["rows"] or (before is not None and 2 * left["pairs"] > before):
            break
        before = left["pairs"]
    pairs = settle(_close_pairs(rest, members, num, den, turn), "pairs")
    last = settle(_distances(pairs.select("a", "b", F.lit(1).alias("size")), members).where(linked).select("a", "b"), "last")
    return links.union(last)


def _close_pairs(rest: DataFrame, members: DataFrame, num: int, den: int, turns: int) -> DataFrame:
    """Distinct (a, b) of different components in one region, not ruled out by any bound."""
    radius, eps = 1.0 - num / den, 1e-9
    numbers = range(1, turns + 1)
    rest = rest.join(members.select("row", "parity"), "row").withColumn("ring", F.floor(F.col("d1") / radius).cast("long"))

    def side(df: DataFrame, mark: str) -> DataFrame:
        names = ["row", "n", "pos", "prior", "c", "parity", *(f"{x}{t}" for t in numbers for x in "bd")]
        return df.select("h", "salt", "ring", *(F.col(x).alias(f"{mark}_{x}") for x in names))

    x = side(rest.where(_early(num, den)).withColumn("ring", F.explode(F.array(F.col("ring") - 1, F.col("ring"), F.col("ring") + 1))), "a")
    y = side(rest.drop("salt").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), _salts(F.col("size")) - 1))), "b")
    n = F.col("a_n") + F.col("b_n")
    # |x - y| + |y - x| is at most |x| + |y| less twice the intersection that a link needs
    differ = n - 2 * F.ceil(n * num / (num + den))
    keep = (
        (F.col("a_c") != F.col("b_c"))
        & ((F.col("a_pos") < F.col("b_pos")) | ((F.col("a_pos") == F.col("b_pos")) & (F.col("a_row") < F.col("b_row"))))
        & (F.least("a_n", "b_n") * den >= F.greatest("a_n", "b_n") * num)
        & (F.col("a_pos") + F.col("b_pos") <= differ)
    )
    for t in numbers:
        ruled_out = (F.abs(F.col(f"a_d{t}") - F.col(f"b_d{t}")) > radius + eps) | F.col(f"a_b{t}").isin(F.col("a_row"), F.col("b_row"))
        keep &= ~F.coalesce(ruled_out, F.lit(False))
    bits = sum((F.bit_count(F.col("a_parity")[i].bitwiseXOR(F.col("b_parity")[i])) for i in range(WORDS)), F.lit(0))
    # a pair with an earlier region in common has been there
    met = x.join(y, ["h", "salt", "ring"]).where(keep & (bits <= differ) & ~F.arrays_overlap("a_prior", "b_prior"))
    return met.select(F.col("a_row").alias("a"), F.col("b_row").alias("b")).distinct()


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` without those that a smaller id of their component stands for.

    An id is one document: rows that share an id stay or go together.  Rows with a null id stay.
    """
    with Temporary() as tables:
        found = link_components(docs, id_col=id_col, text_col=text_col, **options)
        gone = tables.keep(settle(found.where(F.col("component_id") != F.col(id_col)).select(F.col(id_col).alias("gone")).distinct(), "gone"))
    return docs.join(gone, docs[id_col] == gone["gone"], "left_anti")
