"""Steps of a plan that are computed once a row, and rows dealt out by their number."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows that one task takes where every row costs much (certificates built or parsed).
ROWS_PER_TASK = 20_000


def computed(df: DataFrame, keep: list[str], **columns) -> DataFrame:
    """``keep`` and the given columns, which later steps read and do not compute again.

    Spark moves a filter below the projections it reads from, and writes out every expression it is made of each time it
    occurs there; a filter is not moved below a generator whose output it reads, so one that makes a single row ends this.
    """
    one = F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))
    return df.select(*keep, F.explode(one).alias("__one")).select(*keep, *[F.col(f"__one.{n}").alias(n) for n in columns])


def spread(df: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """``df`` dealt out evenly, to more partitions the more rows it has and to no fewer than the cluster's cores.

    For a table in few, large pieces whose rows are to be worked on; its rows are counted first, which a columnar file tells without being read.
    """
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // rows_per_task)))
