"""A CT log folder as a native file source, batch and streaming.

Transport is file-backed: get-entries pages as JSON lines under ``pages/start=<first index>/``.
Both forms read the pages with Spark's text source, on any file system; the page's start comes from
its folder, so pages may start and end anywhere, as log servers serve them.  The streaming form
remembers which files it has read in the query checkpoint, and admission
(``max_files_per_trigger``) is decided in the source's offset: what one trigger leaves is read
by the next.  A page that cannot be decoded gives one row with ``page_error``.

A log's tree heads lie beside the pages as JSON lines (``tree_size``, ``timestamp``) under ``sth/``.  The tree head
is the largest size that any of them has told, so it never falls; entries at or past it are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.steps import spread
from ..session import few_listing_tasks, make_dirs, path_exists
from ..sources.pages import explode_entries

PAGES = "value string, start long"
#: Pages that one task writes: each is a file of its own, which takes longer than its bytes.
PAGES_PER_TASK = 500


def _pages_path(path: str) -> str:
    return f"{path.rstrip('/')}/pages"


def tree_head(spark: SparkSession, path: str, least: int = 0) -> int | None:
    """The number of entries that the log stands for: the largest tree size told so far, ``least`` at least; None before the first tree head.

    A smaller size told later changes nothing, nor does a line that is none.
    """
    heads = f"{path.rstrip('/')}/sth"
    if not path_exists(spark, heads):
        return least or None
    told = spark.read.schema("tree_size long, timestamp long").json(heads).where("tree_size >= 0").agg(F.max("tree_size")).first()[0]
    return least or None if told is None else max(told, least)


def below(entries: DataFrame, tree_size: int | None) -> DataFrame:
    """Entries that a tree of this size holds; all where it is not known."""
    return entries if tree_size is None else entries.where(F.col("log_index") < tree_size)


def read_log(spark: SparkSession, path: str, keep_errors: bool = False, tree_size: int | None = None) -> DataFrame:
    """(log_index, leaf_input, extra_data) of all pages of a log folder; none before its first page.

    With ``tree_size`` (see ``tree_head``) the range is clipped: pages that start past it are not opened.
    """
    pages = _pages_path(path)
    if path_exists(spark, pages):
        few_listing_tasks(spark)
        raw = spark.read.schema(PAGES).option("lineSep", "\n").text(pages)
    else:
        raw = spark.createDataFrame([], PAGES)
    if tree_size is not None:
        raw = raw.where(F.col("start") < tree_size)
    return below(explode_entries(raw, "value", "start", keep_errors), tree_size)


def log_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None, keep_errors: bool = True) -> DataFrame:
    """The streaming form of ``read_log``; the folder may still be empty."""
    pages = _pages_path(path)
    make_dirs(spark, pages)
    few_listing_tasks(spark)
    reader = spark.readStream.schema(PAGES).option("lineSep", "\n")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return explode_entries(reader.text(pages), "value", "start", keep_errors)


def write_tree_head(spark: SparkSession, path: str, tree_size: int, timestamp: int) -> None:
    """Add a tree head to a file-backed log."""
    spark.createDataFrame([(tree_size, timestamp)], "tree_size long, timestamp long").write.mode("append").json(f"{path.rstrip('/')}/sth")


def write_log_dir(pages_df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Lay out a file-backed log from (start, json) pages."""
    spread(pages_df.selectExpr("json AS value", "start"), PAGES_PER_TASK).write.mode(mode).partitionBy("start").text(_pages_path(path))
