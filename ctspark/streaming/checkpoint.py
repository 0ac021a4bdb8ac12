"""The next index to fetch, saved as a single value that is replaced at once.

The value is written beside its place and moved over it by the Hadoop file system's rename with
overwrite, so a reader sees the old or the new value and a crash in between leaves the old one (on
object stores, whose rename is a copy, a reader may find the file missing for a moment).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..operators.ordering import next_index
from ..session import path_exists

#: Fixed value: an index has 64 bits without a sign.
MAX_INDEX = (1 << 64) - 1


def _hadoop(spark: SparkSession, path: str):
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    return jvm, conf, jvm.org.apache.hadoop.fs.Path(path)


def save_index(spark: SparkSession, path: str, index: int) -> None:
    """Replace the saved index; nothing is ever half written."""
    if isinstance(index, bool) or not isinstance(index, int) or not 0 <= index <= MAX_INDEX:
        raise ValueError(f"not an index: {index!r}")
    jvm, conf, target = _hadoop(spark, path)
    fs = target.getFileSystem(conf)
    target = fs.makeQualified(target)
    beside = jvm.org.apache.hadoop.fs.Path(target.getParent(), f"state-{uuid.uuid4().hex}.tmp")
    try:
        out = fs.create(beside, False)
        out.write(bytearray(str(index).encode()))
        out.hsync()
        out.close()
        over = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        over[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf).rename(beside, target, over)
    finally:
        fs.delete(beside, False)


def load_index(spark: SparkSession, path: str) -> int:
    """The saved index; 0 if the file is missing or blank, an error if it holds anything but an index."""
    if not path_exists(spark, path):
        return 0
    jvm, conf, target = _hadoop(spark, path)
    stream = target.getFileSystem(conf).open(target)
    try:
        # more than any index needs, so that a large wrong file is not read as one
        raw = bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(jvm.org.apache.commons.io.input.BoundedInputStream(stream, 4096)))
    finally:
        stream.close()
    text = raw.decode("utf-8", "replace").strip()
    if not text:
        return 0
    if not (text.isascii() and text.isdigit()) or int(text) > MAX_INDEX:
        raise ValueError(f"could not parse state file content: {text[:40]!r}")
    return int(text)


def commit_progress(spark: SparkSession, entries: DataFrame, path: str, idx: str = "log_index") -> int:
    """Move the saved index on to the first one missing in ``entries`` from there on, and return it; it never falls."""
    start = load_index(spark, path)
    reached = max(start, next_index(entries, idx, start).first()[0])
    save_index(spark, path, reached)
    return reached
