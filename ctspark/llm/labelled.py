"""Bounded samples of labelled documents for the classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import settle


def fold(id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 3; fold 1 is held out from learning.  A null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 3


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, per_class: int, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, dict[int, float]]:
    """At most ``per_class`` rows (i, y, t) of either class, outside fold 1, with their whole texts, and how many usable labels a drawn one stands for, by class.

    Ids are drawn from the labels alone, in an order by hash, so only the drawn rows' texts travel.
    They are written once to the checkpoint folder; ``i`` is the id as text.  An id with several
    labels takes the smallest.
    """
    ids = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1) & (fold(id_col) != 1)).groupBy(F.col(id_col).alias("i")).agg(F.min(label_col).cast("int").alias("y"))
    total = {r.y: r.n for r in ids.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    order = F.xxhash64(F.col("i").cast("string"), F.lit("sample"))
    drawn = None
    for y in (0, 1):
        part = ids.where(F.col("y") == y).orderBy(order, "i").limit(per_class)
        drawn = part if drawn is None else drawn.union(part)
    # at most 2 * per_class ids: a proven bound
    d = docs.select(F.col(id_col).alias("i"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))
    rows = d.join(F.broadcast(drawn), "i").groupBy("i", "y").agg(F.min("t").alias("t")).select(F.col("i").cast("string").alias("i"), "y", "t")
    return settle(rows, "labelled"), {y: n / min(n, per_class) for y, n in total.items()}
