"""Gzip batch files of '<index> <base64 DER>' lines.

gzip is not splittable, so a file is one scan task; the scan is followed by the parse, which is
pure Catalyst.  Lines keep their file and a line id that is ordered within each file
(``monotonically_increasing_id`` at the scan), which is what the abort-file mode and the
line numbers of the progress report need.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import go_trim, is_blank
from ..session import few_listing_tasks, keep
from . import remote

# The line grammar and its failure reasons.
LINE_RE = r"(?s)^([0-9]+)[\t\n\f\r ]+(.+)\z"
ERR_EMPTY = "line is empty"
ERR_FORMAT = "line does not match expected format 'sequence_number certificate_data'"
ERR_SEQUENCE = "invalid sequence number"
ERR_DATA = "certificate data is empty"


def file_path() -> Column:
    """The scanned file's path as listings name it; the scan's own metadata column is URL-escaped."""
    return F.url_decode(F.regexp_replace(F.col("_metadata.file_path"), r"\+", "%2B"))


def read_batch_lines(spark: SparkSession, path, recursive: bool = False, min_partitions: int | None = None, ignore_corrupt: bool = False, with_size: bool = False, fail_on_empty: bool = False) -> DataFrame:
    """(file, line_id, value) for every line of every *.gz (any case) under ``path``.

    Lines are split on LF only and one trailing CR is dropped.  ``path`` may be a directory or a
    list of files; files that hold fewer lines than cores are spread with a repartition.  With
    ``ignore_corrupt`` a file that cannot be decompressed yields the lines read before the fault
    instead of failing the job; the caller finds such files with ``damaged_files``.  With ``fail_on_empty``
    a folder with a file that holds nothing is an error, found by the files' last bytes before any is read.
    """
    if fail_on_empty and not isinstance(path, (list, tuple)):
        first = empty_files(spark, path, recursive).orderBy("file").first()
        if first:
            raise ValueError(f"{first.file}: {first.file_error}")
    few_listing_tasks(spark)
    reader = spark.read.option("lineSep", "\n").option("pathGlobFilter", "*.[gG][zZ]").option("recursiveFileLookup", str(recursive).lower())
    if ignore_corrupt:
        reader = reader.option("ignoreCorruptFiles", "true")
    df = reader.text(path if isinstance(path, (list, tuple)) else [path])
    df = df.select(
        file_path().alias("file"),
        F.monotonically_increasing_id().alias("line_id"),
        F.regexp_replace(F.col("value"), r"\r\z", "").alias("value"),
        *([(F.octet_length("value") + 1).cast("long").alias("n_bytes")] if with_size else []),
    )
    if min_partitions:
        df = df.repartition(min_partitions)
    return df


def parse_lines(df: DataFrame, col: str = "value", mode: str = "quarantine", file_col: str = "file", order_col: str = "line_id") -> DataFrame:
    """(sequence_number, certificate_data, error) per line, in the order of the checks.

    mode="quarantine" keeps every line with its error; mode="abort_file" additionally drops all
    lines of a file from its first bad line on (the earlier rows are kept), as the reference
    does.  Lines may be of any length.
    """
    # The grammar is LINE_RE; it is evaluated with short expressions anchored at the start of
    # the line (digits, then the blank run), so a long certificate is never scanned by a regex.
    # Staged projections: every expression below is computed once per line.
    v = F.col(col)
    d = df.select(
        "*",
        F.regexp_extract(v, r"^([0-9]+)", 1).alias("__digits"),
        F.regexp_extract(v, r"^[0-9]+([\t\n\f\r ]+)", 1).alias("__blanks"),
        is_blank(v).alias("__blank"),
    )
    nd, nb = F.length("__digits"), F.length("__blanks")
    rest = F.substring(v, nd + nb + 1, F.length(v))
    d = d.select("*", rest.alias("__rest"), F.expr("try_cast(__digits AS BIGINT)").alias("__seq"))
    # '.+' needs one character: with nothing after the blanks the last blank is taken as data
    nr = F.length("__rest")
    matched = (nd > 0) & (nb > 0) & ((nr > 0) | (nb > 1))
    d = d.select("*", matched.alias("__matched"), go_trim(F.when(nr > 0, F.col("__rest")).otherwise(F.substring("__blanks", -1, 1))).alias("__data"))
    err = (
        F.when(F.col("__blank"), F.lit(ERR_EMPTY))
        .when(~F.col("__matched"), F.lit(ERR_FORMAT))
        .when(F.col("__seq").isNull(), F.concat(F.lit(ERR_SEQUENCE + " '"), F.col("__digits"), F.lit("'")))
        .when(F.col("__data") == "", F.lit(ERR_DATA))
    )
    d = d.select("*", err.alias("error"))
    out = d.select(
        *df.columns,
        "error",
        F.when(F.col("error").isNull(), F.col("__seq")).alias("sequence_number"),
        F.when(F.col("error").isNull(), F.col("__data")).alias("certificate_data"),
    )
    if mode == "abort_file":
        first_bad = out.filter(F.col("error").isNotNull()).groupBy(file_col).agg(F.min(order_col).alias("__first_bad"))
        out = out.join(first_bad, file_col, "left").filter(F.col("__first_bad").isNull() | (F.col(order_col) < F.col("__first_bad"))).drop("__first_bad")
    elif mode != "quarantine":
        raise ValueError(f"unknown mode {mode}")
    return out


def damaged_files(files: DataFrame, read_bytes: DataFrame) -> DataFrame:
    """(file, file_error) of the gzip files in ``files`` (file) that did not decompress to their end.

    ``read_bytes`` has (file, n_bytes), the size of the lines read from each file.  A gzip file ends with
    the size of its content modulo 2 ** 32; these four bytes are read by tasks, and an intact file needs
    nothing more.  Where both differ (damage, or several gzip members in one file), the file is
    decompressed by a task, piece by piece, and nothing of its content is kept.  Files may be of any size.
    On stores that Arrow does not know, a file is read as one value of at most 2 GB.
    """
    here, other = remote.of_known_stores(files)
    told = remote.gzip_sizes(here).unionByName(remote.values(other).mapInPandas(_sizes, "file string, length long, told long"))
    told = told.join(read_bytes, "file", "left")
    short = F.pmod(F.col("n_bytes") - F.col("told"), F.lit(1 << 32))
    doubt = keep(told.filter(F.col("told").isNull() | F.col("n_bytes").isNull() | ~short.isin(0, 1)).select("file"), "doubt")
    here, other = remote.of_known_stores(doubt)
    found = remote.gzip_errors(here).unionByName(remote.values(other).mapInPandas(_inflate, "file string, file_error string"))
    return found.filter(F.col("file_error").isNotNull())


def empty_files(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """(file, file_error) of the *.gz files under ``path`` that hold nothing, told by their size and last bytes."""
    files = remote.list_files(spark, path, recursive).where(F.lower("key").endswith(".gz")).select(F.col("key").alias("file"))
    told = remote.gzip_sizes(remote.of_known_stores(files)[0]).where("told is null or told = 0")
    return told.select("file", F.lit(remote.UNREADABLE).alias("file_error"))


def _sizes(frames):
    for f in frames:
        told = [int.from_bytes(c[-4:], "little") if len(c) >= remote.GZIP_LEAST else None for c in f["content"]]
        yield f[["file", "length"]].assign(told=told).astype({"told": "Int64"})


def _inflate(frames):
    import io

    for f in frames:
        yield f[["file"]].assign(file_error=[remote.inflate(io.BytesIO(c).read) for c in f["content"]])


def file_profile(lines: DataFrame, files: DataFrame | None = None, file_col: str = "file") -> DataFrame:
    """Per file: line count (malformed lines count too), byte size when a listing is given,
    estimated seconds at 100,000 lines per 3 s.  Files of the listing with no readable lines
    are reported with an error instead of failing the run."""
    counts = lines.groupBy(file_col).agg(F.count(F.lit(1)).alias("line_count"))
    if files is not None:
        counts = files.select(F.col("key").alias(file_col), F.col("size")).join(counts, file_col, "left")
    else:
        counts = counts.withColumn("size", F.lit(None).cast("long"))
    return counts.select(
        file_col,
        F.coalesce(F.col("line_count"), F.lit(0)).alias("line_count"),
        "size",
        F.round(F.coalesce(F.col("line_count"), F.lit(0)) / 100000.0 * 3.0, 6).alias("estimated_seconds"),
        F.when(F.col("line_count").isNull(), F.lit("file is empty or unreadable")).alias("error"),
    )


def line_numbers(lines: DataFrame, file_col: str = "file", order_col: str = "line_id") -> DataFrame:
    """1-based line number per file, two-level: line ids from the scan carry their partition in
    the high bits, so (file, id >> 33) buckets are ordered chunks of a file."""
    from ..operators.ordering import positions

    return positions(lines, [file_col], [order_col], F.shiftright(F.col(order_col), 33)).withColumnRenamed("position", "line_no")


def write_batch_fixture(df: DataFrame, path: str, file_col: str = "file", line_col: str = "line", order_col: str = "doc_id") -> None:
    """Write lines as gzip text files, one output file per ``file_col`` value, lines in order."""
    (
        df.repartition(F.col(file_col))
        .sortWithinPartitions(file_col, order_col)
        .select(file_col, line_col)
        .write.mode("overwrite")
        .partitionBy(file_col)
        .option("compression", "gzip")
        .option("lineSep", "\n")
        .text(path)
    )

