"""Exact Lloyd clustering of whole-number vectors with heap-ordered bounds.

Vectors lie in blocks of some thousand, one row each, and every block keeps a heap per cluster.  An entry
is a vector with the gap between a lower bound of its distance to any other centroid and an upper bound of
that to its own.  When centroids move, a gap of cluster c shrinks by at most its own drift and the largest
drift of the others; instead of touching entries, this is added to the cluster's drift so far, and an entry's key
is its gap plus the drift at the time it was pushed.  So a round pops the entries whose key is at or
below the drift: only these vectors are compared with all centroids again, exactly, and pushed anew.  A
vector that stays in its heap has its old centroid as the only nearest one.

A round is one pass of independent tasks over the blocks, whose heaps are written beside the vectors to
the checkpoint folder; the table of the round before goes then.  Blocks report the sums of moved vectors, Spark
adds them up, and ``k`` centroids with one whole number a dimension reach the driver, where a centroid becomes
the floor of sum by count.  Bounds are floats made smaller by more than their rounding; distances, assignments
and sums are whole numbers, ties go to the smaller centroid number.

Rows with a null vector, another length, or a null component take no part.  A null id is allowed.  Repeated rows
are vectors of their own.  With fewer vectors than centroids each is a centroid; without vectors the
result is empty.  Components of 2 ** 27 and more in magnitude raise an error, since distances would leave
64 bits.  Further columns do not matter.
"""

from __future__ import annotations

import heapq
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import release, released, settle

BLOCK = 4096
_LIMIT = 1 << 27
_STATE = "heap_rows binary, heap_keys binary, heap_sizes binary, moved array<struct<cluster: int, n: long, sums: array<long>>>, scanned long"


class Clustering(NamedTuple):
    """``rows`` (id, cluster, distance), settled; the centroids as lists; vectors compared with all centroids, by round."""

    rows: DataFrame
    centroids: list
    scanned: list


class _Centres:
    """Centroids with the drift that each cluster's gaps have lost so far."""

    def __init__(self, points: np.ndarray):
        self.points, self.lost = points, np.zeros(len(points))
        self.squares = (points * points).sum(axis=1)

    def moved(self, points: np.ndarray) -> _Centres:
        out = _Centres(points)
        # a little more than the distance, so that rounding never keeps a vector in its heap
        drift = np.sqrt(((points - self.points) ** 2).sum(axis=1).astype(np.float64)) * (1 + 1e-9)
        order = np.sort(drift)
        out.lost = self.lost + drift + (np.where(drift == order[-1], order[-2], order[-1]) if len(drift) > 1 else 0)
        return out

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(cluster, key) of each row of ``x``."""
        big = max(1, int(np.abs(x).max(initial=1))) * max(1, int(np.abs(self.points).max(initial=1))) * x.shape[1]
        if big < 1 << 50:  # floats multiply faster, and are exact here
            inner = (x.astype(np.float64) @ self.points.astype(np.float64).T).astype(np.int64)
        else:
            inner = x @ self.points.T
        d = (x * x).sum(axis=1)[:, None] - 2 * inner + self.squares[None, :]
        own = d.argmin(axis=1)  # the first of equals
        if d.shape[1] == 1:
            return own, np.full(len(x), np.inf)
        two = np.sqrt(np.partition(d, 1, axis=1)[:, :2].astype(np.float64))
        gap = two[:, 1] - two[:, 0]
        return own, gap - 1e-9 * (1 + two.sum(axis=1)) + self.lost[own]


def _matrix(raw: bytes, width: int, dims: int) -> np.ndarray:
    return np.frombuffer(raw, f"<i{width}").reshape(-1, dims).astype(np.int64)


def _blocked(dims: int, size: int, kind: pa.DataType):
    """Batches of (id, vec) to rows of one block: ids, components in as few bytes as they need, empty heaps."""

    def row(ids, parts):
        m = np.concatenate(parts)
        spread = int(np.abs(m).max(initial=0))
        if spread >= _LIMIT:
            raise ValueError("a component is too large for distances of 64 bits")
        width = 2 if spread < 1 << 15 else 4
        none = pa.array([b""], pa.binary())
        moved = pa.array([[]], pa.list_(pa.struct([("cluster", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.int64()))])))
        return pa.RecordBatch.from_arrays([pa.array([ids], pa.list_(kind)), pa.array([m.astype(f"<i{width}").tobytes()], pa.binary()), pa.array([width], pa.int32()), none, none, none, moved, pa.array([0], pa.int64())], ["ids", "data", "width", "heap_rows", "heap_keys", "heap_sizes", "moved", "scanned"])

    def run(batches):
        ids, parts, held = [], [], 0
        for b in batches:
            at = 0
            m = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
            while at < b.num_rows:
                take = min(size - held, b.num_rows - at)
                ids += b.column(0).slice(at, take).to_pylist()
                parts.append(m[at : at + take])
                held, at = held + take, at + take
                if held == size:
                    yield row(ids, parts)
                    ids, parts, held = [], [], 0
        if held:
            yield row(ids, parts)

    return run


def _heaps(row: dict, k: int) -> list[list]:
    sizes = np.frombuffer(row["heap_sizes"], np.int32)
    if not len(sizes):
        return [[] for _ in range(k)]
    entries = list(zip(np.frombuffer(row["heap_keys"]).tolist(), np.frombuffer(row["heap_rows"], np.int32).tolist(), strict=True))
    ends = np.cumsum(sizes).tolist()
    return [entries[e - n : e] for e, n in zip(ends, sizes.tolist(), strict=True)]


def _assigned(heaps: list[list], n: int) -> np.ndarray:
    own = np.full(n, -1, np.int64)
    for c, heap in enumerate(heaps):
        own[[i for _, i in heap]] = c
    return own


def _pass(row: dict, x: np.ndarray, centres: _Centres) -> tuple[list[list], np.ndarray, np.ndarray, np.ndarray]:
    """Pops expired entries, compares their vectors with all centroids, pushes them: (heaps, popped rows, old, new cluster)."""
    heaps = _heaps(row, len(centres.points))
    if not row["heap_sizes"]:
        popped, old = list(range(len(x))), [-1] * len(x)
    else:
        popped, old = [], []
        for c, heap in enumerate(heaps):
            lost = centres.lost[c]
            while heap and heap[0][0] <= lost:
                popped.append(heapq.heappop(heap)[1])
                old.append(c)
    popped, old = np.array(popped, np.int64), np.array(old, np.int64)
    if not len(popped):
        return heaps, popped, old, old
    own, keys = centres.nearest(x[popped])
    for c, key, i in zip(own.tolist(), keys.tolist(), popped.tolist(), strict=True):
        heapq.heappush(heaps[c], (key, i))
    return heaps, popped, old, own


def _round(shared, dims: int):
    def run(batches):
        centres = shared.value
        k = len(centres.points)
        for b in batches:
            for row in (r for i in range(b.num_rows) for r in b.slice(i, 1).to_pylist()):
                x = _matrix(row["data"], row["width"], dims)
                heaps, popped, old, own = _pass(row, x, centres)
                went = old != own
                # sums of whole numbers: what joins a cluster, less what leaves it
                gone = went & (old >= 0)
                sums = np.zeros((k, dims), np.int64)
                np.add.at(sums, own[went], x[popped[went]])
                np.subtract.at(sums, old[gone], x[popped[gone]])
                joined, left = np.bincount(own[went], minlength=k), np.bincount(old[gone], minlength=k)
                row["moved"] = [{"cluster": int(c), "n": int(joined[c] - left[c]), "sums": sums[c].tolist()} for c in np.flatnonzero(joined + left)]
                row["scanned"] = len(popped)
                row["heap_keys"] = np.array([e[0] for h in heaps for e in h]).tobytes()
                row["heap_rows"] = np.array([e[1] for h in heaps for e in h], np.int32).tobytes()
                row["heap_sizes"] = np.array([len(h) for h in heaps], np.int32).tobytes()
                yield pa.RecordBatch.from_pylist([row], schema=b.schema)

    return run


def _last(shared, dims: int, kind: pa.DataType):
    def run(batches):
        centres = shared.value
        for b in batches:
            for row in (r for i in range(b.num_rows) for r in b.slice(i, 1).to_pylist()):
                x = _matrix(row["data"], row["width"], dims)
                heaps, popped, _, _ = _pass(row, x, centres)
                own = _assigned(heaps, len(x))
                far = x - centres.points[own]
                again = np.zeros(len(x), bool)
                again[popped] = True
                yield pa.RecordBatch.from_arrays([pa.array(row["ids"], kind), pa.array(own, pa.int32()), pa.array((far * far).sum(axis=1), pa.int64()), pa.array(again)], ["id", "cluster", "distance", "again"])

    return run


def cluster(vectors: DataFrame, starts: DataFrame, dims: int, rounds: int, id_col: str = "vec_id", vec_col: str = "vec", block: int = BLOCK) -> Clustering:
    """``rounds`` rounds of Lloyd's algorithm and a last assignment of ``vectors`` (id, array of whole numbers).

    ``starts`` has the first centroids in the column ``vec_col``, in order; it must be few rows, as they go to the driver.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    spark = vectors.sparkSession
    id_type = vectors.schema[id_col].dataType
    kind, arrow = id_type.simpleString(), to_arrow_type(id_type)
    points = np.array([r[0] for r in starts.select(F.col(vec_col).cast("array<long>")).collect()], np.int64).reshape(-1, dims)
    usable = vectors.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<long>").alias("vec")).where((F.size("vec") == dims) & ~F.exists("vec", lambda x: x.isNull()))
    if not len(points):
        return Clustering(usable.limit(0).select("id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), [], [])
    table = settle(usable.mapInArrow(released(_blocked(dims, block, arrow)), f"ids array<{kind}>, data binary, width int, {_STATE}"), "blocks")
    centres, totals, counts, scanned = _Centres(points), np.zeros(points.shape, object), np.zeros(len(points), object), []
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(centres)
        table = settle(table.mapInArrow(released(_round(shared, dims)), table.schema), "heaps", instead_of=(table,))
        moved = table.select(F.explode("moved").alias("m")).select("m.*")
        whole = moved.select("cluster", F.posexplode("sums").alias("d", "s")).groupBy("cluster", "d").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
        for r in whole.collect():  # at most one row a centroid and dimension
            totals[r["cluster"], r["d"]] += int(r["s"])
        for r in moved.groupBy("cluster").agg(F.sum("n").alias("n")).collect():
            counts[r["cluster"]] += r["n"]
        scanned.append(table.agg(F.sum("scanned")).first()[0] or 0)
        after = [[t // n for t in row] if n else old.tolist() for row, n, old in zip(totals, counts, centres.points, strict=True)]
        centres = centres.moved(np.array(after, np.int64))
    shared = spark.sparkContext.broadcast(centres)
    rows = settle(table.mapInArrow(released(_last(shared, dims, arrow)), f"id {kind}, cluster int, distance long, again boolean"), "clusters")
    release(table)
    scanned.append(rows.where("again").count())
    return Clustering(rows.drop("again"), centres.points.tolist(), scanned)
