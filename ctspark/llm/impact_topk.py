"""Exact top-k by inner product with an impact-ordered index, score at a time.

Vectors of whole numbers are indexed in blocks.  A posting is a vector's value in a dimension; a block keeps its
postings in planes by quantised magnitude, positive and negative values apart, so that a plane holds the
posting segments of one magnitude class of all dimensions.  A query turns a posting into an impact (its component times the
value) and takes the segments by falling class of impact, for a batch of queries at a time: first the positive impacts of
large values, then those of the others.  What is not taken yet can add to a vector's score at most the class's limit in every
dimension, and nothing once all positive impacts are in, so the sum and this rest are a bound.  The exact scores of the
best bounds give a floor; vectors whose bound is below the floor are proven out.  Taking stops only when few enough possible
members are left or no positive impact is; these are scored exactly.

Vectors are shuffled once: a block and the blocks of queries that ask it meet in a task, where the block is indexed and
the queries pass by.  A first pass asks one block for each query; the k-th best score there is a floor for all others,
which then tell only what is not below it.  A last step takes the k best, ties to the smaller id.

Vectors that are null, or hold null components, take no part.  Missing components count as 0 where lengths differ.  Rows with a
null id take no part either; rows that repeat an id are separate candidates.  An empty table gives an empty result;
further columns do not matter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import release, released, settle

#: Vectors and queries of a block, and components that a block of vectors holds at most.
BLOCK = 16_384
QUERY_BLOCK = 256
COMPONENTS = 1 << 20
#: Shares of the largest value at which the classes of magnitude begin, falling.
CLASSES = (0.5, 0.0)
_FLOOR = -(1 << 62)


class ImpactIndex:
    """Posting planes of one block of vectors."""

    def __init__(self, vectors: np.ndarray, classes: tuple = CLASSES):
        self.vectors = vectors  # (rows, dimensions), whole numbers
        self.spread = max(1, int(np.abs(vectors).max(initial=1)))
        self.limits = [int(self.spread * c) for c in classes]
        self.planes, self.kind = [], None
        self.classes = classes

    def _prepare(self, kind) -> None:
        """The planes in a float kind that is exact for the sums to come."""
        if kind is self.kind:
            return
        self.kind, self.floats, self.planes, top = kind, self.vectors.astype(kind), [], self.spread + 1
        both = np.concatenate([np.maximum(self.vectors, 0), np.maximum(-self.vectors, 0)], axis=1)
        for limit in self.limits:  # values above the limit, up to the class before
            self.planes.append(np.where((both > limit) & (both < top), both, 0).astype(kind).T)
            top = limit + 1

    def search(self, queries: np.ndarray, floors: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each query the rows with their exact scores that hold the k best at or above its floor; rows left out are proven to be worse."""
        n, dims = self.vectors.shape
        most = self.spread * max(1, int(np.abs(queries).max(initial=1))) * max(1, dims)
        if most >= 1 << 53:  # no float is exact
            scores = [self.vectors @ q for q in queries]
            return [(np.flatnonzero(s >= f), s[s >= f]) for s, f in zip(scores, floors, strict=True)]
        self._prepare(np.float32 if most < 1 << 24 else np.float64)
        ask = queries.astype(self.kind)
        sides = np.concatenate([np.maximum(ask, 0), np.maximum(-ask, 0)], axis=1)
        size = np.abs(ask).sum(axis=1)
        total, floors = np.zeros((len(ask), n), self.kind), floors.astype(np.float64)
        alive: list = [None] * len(ask)
        some = min(n, 4 * k)
        for limit, plane in zip(self.limits, self.planes, strict=True):
            total += sides @ plane
            left = 0
            for i in range(len(ask)):
                best = np.argpartition(total[i], n - some)[n - some :]
                reached = np.sort(self.floats[best] @ ask[i])[-k] if n >= k else _FLOOR
                floors[i] = max(floors[i], float(reached))
                alive[i] = np.flatnonzero(total[i] >= floors[i] - float(size[i]) * limit)
                left = max(left, len(alive[i]))
            if left <= some:
                break
        out = []
        for i, rows in enumerate(alive):
            score = (self.floats[rows] @ ask[i]).astype(np.int64)
            good = score >= floors[i]
            out.append((rows[good], score[good]))
        return out


def _packed(size: int, components: int):
    """Batches of (id, vec) to rows of one block: ids, and components in as few bytes as they need."""

    def row(ids, vecs):
        dims = max(map(len, vecs), default=0)
        m = np.zeros((len(vecs), dims), np.int64)
        for i, v in enumerate(vecs):
            m[i, : len(v)] = v
        spread = int(np.abs(m).max(initial=0))
        width = 2 if spread < 1 << 15 else 4 if spread < 1 << 31 else 8
        cols = [pa.array([np.array(ids, "<i8").tobytes()], pa.binary()), pa.array([m.astype(f"<i{width}").tobytes()], pa.binary()), pa.array([width], pa.int32()), pa.array([dims], pa.int32())]
        return pa.RecordBatch.from_arrays(cols, ["ids", "data", "width", "dims"])

    def run(batches):
        ids, vecs, held = [], [], 0
        for b in batches:
            for i, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if ids and (len(ids) == size or held + len(v) > components):
                    yield row(ids, vecs)
                    ids, vecs, held = [], [], 0
                ids.append(i)
                vecs.append(v)
                held += len(v)
        if ids:
            yield row(ids, vecs)

    return run


def _blocks(df: DataFrame, size: int, components: int, id_col: str, vec_col: str, name: str) -> tuple[DataFrame, int]:
    """(block, ids, data, width, dims), blocks numbered from 0, and their number; nothing is shuffled but the numbers."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<long>").alias("v")).where("id is not null and v is not null and not exists(v, x -> x is null)")
    packed = rows.mapInArrow(released(_packed(size, components)), "ids binary, data binary, width int, dims int").withColumn("key", F.monotonically_increasing_id())
    packed = settle(packed, name)
    numbers = packed.select("key", (F.row_number().over(Window.orderBy("key")) - 1).alias("block"))  # one row a block
    return packed.join(numbers, "key").drop("key"), packed.count()


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vec_col: str = "vec", block: int = BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query row its k best rows of ``vectors`` but itself.

    Both frames have an id and an array of whole numbers.
    """
    rows, n_rows = _blocks(vectors, block, COMPONENTS, id_col, vec_col, "vectors")
    asks, n_asks = _blocks(queries, query_block, COMPONENTS, id_col, vec_col, "queries")
    if not n_rows or not n_asks:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    rows, asks = settle(rows, "vector-blocks"), settle(asks, "query-blocks")
    # few blocks of vectors are copied to several tasks, which share the blocks of queries
    split = max(1, min(n_asks, -(-vectors.sparkSession.sparkContext.defaultParallelism // n_rows)))
    none = F.lit(None).cast("binary").alias("floors")
    first = asks.select(F.pmod("block", F.lit(n_rows)).cast("int").alias("at"), F.col("block").alias("ask"), "ids", "data", "width", "dims", none)
    floors = settle(_asked(rows, first, k, split, n_rows).where("floors is not null").select("ask", "floors"), "floors")
    every = F.explode(F.sequence(F.lit(0), F.lit(n_rows - 1)))
    rest = asks.withColumnRenamed("block", "ask").join(floors, "ask").select(every.alias("at"), "ask", "ids", "data", "width", "dims", "floors")
    found = settle(_asked(rows, rest, k, split, n_rows).where("floors is null").select("query_id", "vec_id", "score"), "found")
    for t in (rows, asks, floors):
        release(t)
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.select("query_id", F.row_number().over(w).cast("int").alias("rank"), "vec_id", "score").where(F.col("rank") <= k)


def _asked(rows: DataFrame, asks: DataFrame, k: int, split: int, n_rows: int) -> DataFrame:
    """What the blocks ``asks`` find in the blocks ``rows`` named by ``at``, and the floors that this gives to each (ask, floors)."""
    none = [F.lit(None).cast("int").alias("ask"), F.lit(None).cast("binary").alias("floors")]
    part = F.explode(F.sequence(F.lit(0), F.lit(split - 1)))
    own = rows.select(F.col("block").cast("int").alias("at"), part.alias("part"), F.lit(0).alias("side"), none[0], "ids", "data", "width", "dims", none[1])
    other = asks.select("at", F.pmod("ask", F.lit(split)).cast("int").alias("part"), F.lit(1).alias("side"), F.col("ask").cast("int").alias("ask"), "ids", "data", "width", "dims", "floors")
    met = own.unionByName(other).repartition(n_rows * split, "at", "part").sortWithinPartitions("at", "part", "side", "ask")
    return met.mapInArrow(released(_searcher(k)), "query_id long, vec_id long, score long, ask int, floors binary")


def _matrix(row: dict) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(row["ids"], "<i8")
    return ids, np.frombuffer(row["data"], f"<i{row['width']}").reshape(len(ids), row["dims"]).astype(np.int64)


def _fitted(m: np.ndarray, dims: int) -> np.ndarray:
    """A matrix with ``dims`` columns: what a block of vectors does not have counts as 0."""
    out = np.zeros((len(m), dims), np.int64)
    out[:, : min(dims, m.shape[1])] = m[:, :dims]
    return out


def _searcher(k: int):
    def run(batches):
        index, ids = None, None
        for b in batches:
            for row in (r for i in range(b.num_rows) for r in b.slice(i, 1).to_pylist()):
                own, m = _matrix(row)
                if row["side"] == 0:
                    ids, index = own, ImpactIndex(m)
                    continue
                given = np.full(len(own), _FLOOR, np.int64) if row["floors"] is None else np.frombuffer(row["floors"], "<i8")
                q_ids, v_ids, scores, reached = [], [], [], np.full(len(own), _FLOOR, np.int64)
                asked = _fitted(m, index.vectors.shape[1])
                for at in range(0, len(own), 64):
                    for i, (rows, score) in enumerate(index.search(asked[at : at + 64], given[at : at + 64], k + 1), at):
                        other = ids[rows] != own[i]
                        rows, score = rows[other], score[other]
                        best = np.lexsort((ids[rows], -score))[:k]
                        if len(best) == k:
                            reached[i] = score[best[-1]]
                        q_ids.append(np.full(len(best), own[i]))
                        v_ids.append(ids[rows][best])
                        scores.append(score[best])
                if row["floors"] is None:  # the first pass tells floors alone
                    yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64())] * 3 + [pa.array([row["ask"]], pa.int32()), pa.array([reached.astype("<i8").tobytes()], pa.binary())], ["query_id", "vec_id", "score", "ask", "floors"])
                else:
                    cols = [pa.array(np.concatenate(x).astype(np.int64)) for x in (q_ids, v_ids, scores)]
                    yield pa.RecordBatch.from_arrays([*cols, pa.nulls(len(cols[0]), pa.int32()), pa.nulls(len(cols[0]), pa.binary())], ["query_id", "vec_id", "score", "ask", "floors"])

    return run
