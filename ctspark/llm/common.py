"""Shared helpers of the corpus operators."""

from __future__ import annotations

import ctypes
import gc
import uuid
import weakref

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from ..shipping import ensure_shipped


def prepare(spark: SparkSession) -> None:
    """Make the package importable on executors."""
    ensure_shipped(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Where each settled table lies, for as long as its DataFrame is held.
_PLACES: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()


def settle(df: DataFrame, name: str, instead_of: tuple = ()) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back.

    This cuts the lineage: values such as row ids are fixed from here on, whatever executor
    is lost later.  ``instead_of`` names settled tables that nothing reads once this one is written; they go.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _PLACES[out] = path
    if Temporary._open:
        Temporary._open[-1].tables.append(out)
    for old in instead_of:
        release(old)
    return out


class Temporary:
    """Tables settled inside a ``with`` block; at its end all go but those kept."""

    _open: list = []

    def __init__(self):
        self.tables, self.kept = [], []

    def __enter__(self):
        Temporary._open.append(self)
        return self

    def keep(self, settled: DataFrame) -> DataFrame:
        self.kept.append(settled)
        return settled

    def __exit__(self, *_):
        Temporary._open.remove(self)
        for t in self.tables:
            if any(t is k for k in self.kept):
                if Temporary._open:  # a surrounding block has it next
                    Temporary._open[-1].tables.append(t)
            else:
                release(t)


def release(settled: DataFrame) -> None:
    """Delete the files of a settled table; nothing may read it, or a frame made from it, any more."""
    path = _PLACES.pop(settled, None)
    if path is not None:
        spark = settled.sparkSession
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def released(run):
    """``run`` (Arrow batches to Arrow batches) that gives its memory back to the system at its end.

    Python workers are reused; without this a worker keeps the most that any of its tasks has needed.
    """

    def tidy(batches):
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (OSError, AttributeError):  # another C library
                pass

    return tidy


def utf8(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string column; a null counts as the empty text."""
    return [b"" if v is None else v for v in column.cast(pa.binary()).to_pylist()]


def pieces(batches, max_bytes: int = 32 << 20, max_rows: int = 4096):
    """Cut Arrow batches so that a piece holds few megabytes of text, however long single texts are."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        step = max(1, min(max_rows, int(n * max_bytes / max(1, batch.nbytes))))
        for at in range(0, n, step):
            yield batch.slice(at, step)


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """(node, component) of the undirected ``edges``; the component is its smallest node.

    Alternating large-star and small-star steps: every node hands its neighbours to the smallest
    one, first the larger neighbours, then the smaller ones.  The number of edges never grows and
    a step needs one shuffle for the minimum and one for the neighbours, so a component of any
    size is never gathered in one place.  Stops when a round changes no edge; each round is
    written to the checkpoint folder.
    """
    e = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    e = settle(e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc")
    before = None
    for _ in range(rounds):
        e_before = e
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        e = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = e.groupBy("u").agg(F.min("v").alias("m"))
        small = e.join(low, "u")
        e = settle(small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v"))).distinct(), "cc", instead_of=(e_before,))
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        # a star forest is a fixed point: no node that is a centre points elsewhere
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("connected components did not settle")
    nodes = e.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node")
    centres = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return nodes.union(centres)


def filter_bits(keys: int) -> int:
    """Bits (as a power of two) of a bitmap that ``keys`` hashes fill to an eighth at most, between 8 KB and 128 MB."""
    return min(30, max(16, (8 * max(1, keys) - 1).bit_length()))


def bitmap(spots: DataFrame, bits: int) -> np.ndarray:
    """A bitmap of 2 ** ``bits`` bits, as 32-bit words, with the long column ``b``'s values set.

    The bits are merged by Spark; one row of 4 KB per 32,768 bits reaches the driver.
    """
    out = np.zeros((1 << bits) >> 3, np.uint8)
    rows = spots.groupBy(F.shiftright("b", 15).alias("k")).agg(F.bitmap_construct_agg(F.col("b").bitwiseAND(F.lit(32_767))).alias("m"))
    for r in rows.toLocalIterator():
        m = np.frombuffer(bytes(r["m"]), np.uint8)
        at = r["k"] << 12
        out[at : at + len(m)] = m[: len(out) - at]
    return out.view("<u4")


def codepoints(raw: bytes) -> int:
    """Code points of valid UTF-8 bytes."""
    if not raw:
        return 0
    return int(np.count_nonzero((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80))
