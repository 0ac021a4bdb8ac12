"""Listings and positioned reads in tasks, on the stores that Arrow's file systems know.

Spark's file sources read a file from end to end, and their file index lists on the driver.  What
only needs names, sizes or the last bytes of many files is done here by tasks: a listing descends folder
level by folder level, and a file's end is read where it is.  Stores that Arrow does not know (see
``KNOWN``) are served by Spark's own sources, as said at each function.

Paths are written as Spark's listings write them: ``file:/dir/name``, ``hdfs://host/dir/name``, unescaped.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import keep
from ..shipping import ensure_shipped

KNOWN = ("file", "hdfs", "viewfs", "s3", "s3a", "gs", "abfs", "abfss")
_PARTS = re.compile(r"^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/]*))?(.*)$", re.S)
LISTING = "key string, size long, last_modified timestamp"
_CHUNK = 1 << 20
#: The shortest gzip file: header, empty block, checksum and size.
GZIP_LEAST = 18
UNREADABLE, CUT = "file is empty or unreadable", "unexpected end of file"


def known(path: str) -> bool:
    return (_PARTS.match(path)[1] or "file") in KNOWN


def file_system(path: str):
    """(Arrow file system, path in it) of a path with scheme."""
    from pyarrow import fs

    scheme, host, inner = _PARTS.match(path).groups()
    if scheme in (None, "file"):
        return fs.LocalFileSystem(), inner
    found, base = fs.FileSystem.from_uri(f"{'s3' if scheme == 's3a' else scheme}://{host or ''}/")
    return found, base.rstrip("/") + inner


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme and host of the session's file system."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toString()


def _hidden(name: str) -> bool:
    """What Spark's file index leaves out."""
    return name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")


def _rows(infos, prefix: str, base: str):
    """Arrow rows of a listing; ``base`` is where the folder lies for Arrow, ``prefix`` for Spark."""
    kept = [i for i in infos if not _hidden(i.base_name)]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([prefix + i.path[len(base) :] for i in kept], pa.string()),
            pa.array([0 if i.size is None else i.size for i in kept], pa.int64()),
            pa.array([(i.mtime_ns or 0) // 1_000_000 * 1000 for i in kept], pa.int64()).cast(pa.timestamp("us", "UTC")),
            pa.array([not i.is_file for i in kept]),
        ],
        ["key", "size", "last_modified", "is_folder"],
    )


def _list(batches):
    from pyarrow import fs

    for b in batches:
        for folder in b.column(0).to_pylist():
            store, inner = file_system(folder)
            infos = store.get_file_info(fs.FileSelector(inner, recursive=False))
            for at in range(0, len(infos), 10_000):
                yield _rows(infos[at : at + 10_000], folder.rstrip("/"), inner.rstrip("/"))


def list_files(spark: SparkSession, path: str, recursive: bool = True) -> DataFrame:
    """(key, size, last_modified) of the files under ``path``, those without any bytes too.

    Folders are listed by tasks, one level of folders after the other; no row passes through the driver.
    A missing folder is an error.  Stores that Arrow does not know are listed by Spark's file index,
    which leaves out files of zero bytes.
    """
    ensure_shipped(spark)
    root = qualified(spark, path)
    if not known(root):
        raw = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(path)
        return raw.select(F.col("path").alias("key"), F.col("length").alias("size"), F.col("modificationTime").alias("last_modified"))
    folders, found = spark.createDataFrame([(root,)], "folder string"), None
    while True:
        level = keep(folders.repartition(spark.sparkContext.defaultParallelism).mapInArrow(_list, f"{LISTING}, is_folder boolean"), "listing")
        files = level.where("not is_folder").drop("is_folder")
        found = files if found is None else found.unionByName(files)
        folders = level.where("is_folder").select(F.col("key").alias("folder"))
        if not recursive or folders.isEmpty():
            return found


def _ends(batches):
    for b in batches:
        lengths, told = [], []
        for path in b.column(0).to_pylist():
            store, inner = file_system(path)
            with store.open_input_file(inner) as f:
                n = f.size()
                lengths.append(n)
                told.append(int.from_bytes(f.read_at(4, n - 4), "little") if n >= GZIP_LEAST else None)
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(lengths, pa.int64()), pa.array(told, pa.int64())], ["file", "length", "told"])


def gzip_sizes(files: DataFrame) -> DataFrame:
    """(file, length, told) for the column ``file``: bytes of the file, and the size of its content modulo 2 ** 32 that its last four bytes tell.

    Only these bytes are read.  ``told`` is null for a file too short to be one.
    """
    return files.select("file").mapInArrow(_ends, "file string, length long, told long")


def inflate(read) -> str | None:
    """Why gzip data from ``read(n)`` do not decompress to their end, or hold nothing; None if they do.

    The data pass through in pieces, whatever their size; a file may have several members, and zeros behind the last.
    """
    import zlib

    member, data, inside, members, empty = zlib.decompressobj(31), b"", False, 0, True
    try:
        while True:
            data = data or read(_CHUNK)
            if not inside and members:
                data = data.lstrip(b"\x00")
                if not data:
                    data = read(_CHUNK)
                    if not data:
                        break
                    continue
            out = member.decompress(data, _CHUNK)
            ended = not data and not out
            inside, empty, data = True, empty and not out, member.unconsumed_tail
            if member.eof:
                inside, members, data, member = False, members + 1, member.unused_data, zlib.decompressobj(31)
            elif ended:
                break
    except zlib.error:
        return UNREADABLE
    if inside and (members or not empty):
        return CUT
    return UNREADABLE if empty else None


def _inflated(batches):
    for b in batches:
        errors = []
        for path in b.column(0).to_pylist():
            store, inner = file_system(path)
            with store.open_input_stream(inner, compression=None) as f:
                errors.append(inflate(f.read))
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(errors, pa.string())], ["file", "file_error"])


def gzip_errors(files: DataFrame) -> DataFrame:
    """(file, file_error) for the column ``file``: each decompressed by a task, piece by piece, and nothing kept."""
    return files.select("file").mapInArrow(_inflated, "file string, file_error string")


def _facts(batches):
    import hashlib

    for b in batches:
        sizes, sums = [], []
        for path in b.column(0).to_pylist():
            store, inner = file_system(path)
            size, md5 = 0, hashlib.md5()
            with store.open_input_stream(inner, compression=None) as f:
                while piece := f.read(_CHUNK):
                    size += len(piece)
                    md5.update(piece)
            sizes.append(size)
            sums.append(md5.hexdigest())
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int64()), pa.array(sums, pa.string())], ["key", "actual_size", "actual_md5"])


def of_known_stores(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The names in the column ``file`` that tasks can open, dealt out a few to a task, and the others."""
    ours = F.regexp_extract("file", "^([A-Za-z][A-Za-z0-9+.-]*):", 1).isin(*KNOWN, "")
    return files.where(ours).repartition(4 * files.sparkSession.sparkContext.defaultParallelism), files.where(~ours)


def values(files: DataFrame) -> DataFrame:
    """(file, length, content) of whole files of up to 2 GB by Spark's reader, which takes their names as a list."""
    spark, paths = files.sparkSession, [r[0] for r in files.select("file").collect()]
    if not paths:
        return spark.createDataFrame([], "file string, length long, content binary")
    return spark.read.format("binaryFile").load(paths).select(F.col("path").alias("file"), "length", "content")


def file_facts(files: DataFrame) -> DataFrame:
    """(key, actual_size, actual_md5) for the column ``file``, read piece by piece by tasks."""
    here, other = of_known_stores(files)
    found = here.select("file").mapInArrow(_facts, "key string, actual_size long, actual_md5 string")
    return found.unionByName(values(other).select(F.col("file").alias("key"), F.col("length").alias("actual_size"), F.md5("content").alias("actual_md5")))
