"""K1-K7 sinks: mapping table to json / jsonl / csv / text, CT batch files, per-source outputs.

All writers are distributed DataFrame writes (one part file per task); none gathers the
result on the driver.  Run statistics go to a side directory next to the rows.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.encoding import base64_line
from ..operators.mappings import MAPPING_COLUMNS, format_mapping, validate_mapping
from ..operators.ordering import assign_batches

# Accepted formats (case-insensitive) and the CSV header names.
FORMATS = ("json", "jsonl", "csv", "txt", "text")
CSV_HEADER = {"name": "Name", "organization": "Organization", "source": "Source", "sequence_number": "SequenceNumber"}


def _valid(df: DataFrame) -> DataFrame:
    """rows that fail mapping validation are not written."""
    return df.filter(validate_mapping(F.col("name"), F.col("organization"), F.col("organizational_unit"), F.col("source"), F.col("sequence_number")).isNull())


def _omit_empty_ou(df: DataFrame) -> DataFrame:
    return df.withColumn("organizational_unit", F.when(F.col("organizational_unit") == "", F.lit(None)).otherwise(F.col("organizational_unit")))


def write_json(df: DataFrame, path: str, stats: DataFrame | None = None, mode: str = "overwrite") -> None:
    """K1: mapping objects (organizational_unit omitted when empty) under path/mappings and the
    run statistics under path/stats."""
    _omit_empty_ou(_valid(df).select(*MAPPING_COLUMNS)).write.mode(mode).option("ignoreNullFields", "true").json(f"{path}/mappings")
    if stats is not None:
        stats.write.mode(mode).json(f"{path}/stats")


def write_jsonl(df: DataFrame, path: str, stats: DataFrame | None = None, mode: str = "overwrite") -> None:
    """K2: one object per line; statistics (real values) as a side directory."""
    _omit_empty_ou(_valid(df).select(*MAPPING_COLUMNS)).write.mode(mode).option("ignoreNullFields", "true").json(path)
    if stats is not None:
        stats.write.mode(mode).json(f"{path}_stats")


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K3: Name,Organization,Source,SequenceNumber; quotes doubled, blanks kept as they are."""
    out = _valid(df).select(*[F.col(c).alias(h) for c, h in CSV_HEADER.items()])
    (
        out.write.mode(mode)
        .option("header", "true")
        .option("escape", '"')
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
        .csv(path)
    )


def write_text(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K4: 'name -> org (SOURCE) [seq:N]' lines."""
    _valid(df).select(format_mapping(df, with_seq=True).alias("value")).write.mode(mode).text(path)


def write_mappings(df: DataFrame, path: str, fmt: str, stats: DataFrame | None = None, mode: str = "overwrite") -> None:
    """K7: dispatch on the format name (case-insensitive)."""
    if not path or not path.strip():
        raise ValueError("output path is required")
    f = (fmt or "").lower()
    if f not in FORMATS:
        raise ValueError(f"unsupported output format: {fmt}")
    if f == "json":
        write_json(df, path, stats, mode)
    elif f == "jsonl":
        write_jsonl(df, path, stats, mode)
    elif f == "csv":
        write_csv(df, path, mode)
    else:
        write_text(df, path, mode)


def write_batches(entries: DataFrame, path: str, batch_size: int = 100_000, idx: str = "log_index", der: str = "der", mode: str = "append", log_name: str | None = None) -> None:
    """K5: '<index> <base64 DER>' lines, one gzip directory per batch of N consecutive indexes,
    lines in index order, under ``<log_name>/certs`` when a (clean) log name is given.  The only
    shuffle is by batch; rows are sorted inside each batch."""
    if log_name:
        path = f"{path.rstrip('/')}/{log_name}/certs"
    b = assign_batches(entries.select(idx, der), idx, batch_size)
    line = F.concat(F.col(idx).cast("string"), F.lit(" "), base64_line(F.col(der)))
    (
        b.repartition("batch_start")
        .sortWithinPartitions("batch_start", idx)
        .select("batch_start", line.alias("value"))
        .write.mode(mode)
        .partitionBy("batch_start")
        .option("compression", "gzip")
        .option("lineSep", "\n")
        .text(path)
    )


def write_per_source(df: DataFrame, path: str, fmt: str = "jsonl", source_col: str = "output_name", sources: DataFrame | None = None) -> None:
    """K6: one output per input file, partitioned by its output name; a re-run overwrites only
    the partitions it produces (dynamic partition overwrite), so it is idempotent.

    ``sources`` names the outputs this run stands for: one that gets no rows now is cleared.  Rows
    are rebalanced by source: a source below the session's advisory partition size is one file, and a
    larger one is cut into several tasks by its size at run time.
    """
    f = fmt.lower()
    if f in ("txt", "text"):
        out = _valid(df).select(source_col, format_mapping(df, with_seq=True).alias("value"))
    elif f == "csv":
        out = _valid(df).select(source_col, *[F.col(c).alias(h) for c, h in CSV_HEADER.items()])
    else:
        out = _omit_empty_ou(_valid(df))
    if sources is not None:
        _clear(sources.select(source_col).join(out.select(source_col).distinct(), source_col, "left_anti"), path, source_col)
    w = out.hint("rebalance", F.col(source_col)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(source_col)
    if f == "csv":
        (
            w.option("header", "true")
            .option("escape", '"')
            .option("emptyValue", "")
            .option("ignoreLeadingWhiteSpace", "false")
            .option("ignoreTrailingWhiteSpace", "false")
            .csv(path)
        )
    elif f in ("txt", "text"):
        w.text(path)
    else:
        w.option("ignoreNullFields", "true").json(path)


def _clear(empty: DataFrame, path: str, source_col: str) -> None:
    """Remove the partitions of sources that have no rows any more.

    A dynamic overwrite replaces the partitions it has rows for; only folder names travel, and a
    source without rows is an exception, not the rule.
    """
    spark = empty.sparkSession
    jvm = spark.sparkContext._jvm
    unesc = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    for r in empty.distinct().toLocalIterator():
        p = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{source_col}={unesc.escapePathName(r[0])}")
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def _go_json(c):
    """JSON text of a value with the HTML characters escaped the way Go's encoder does."""
    j = F.to_json(F.array(c))
    j = F.regexp_replace(F.regexp_replace(F.regexp_replace(j, "<", "\\\\u003c"), ">", "\\\\u003e"), "&", "\\\\u0026")
    return F.regexp_replace(F.regexp_replace(j, r"^\[", ""), r"\]\z", "")


def write_json_document(df: DataFrame, path: str, stats: dict | None = None) -> None:
    """K1 single-document form: {"mappings": [...], "stats": {...}} with 2-space indentation,
    ``organizational_unit`` omitted when empty and HTML characters escaped.

    The document is the part files under ``path``, one after the other in the order of their names:
    the rows are range-sorted by sequence number, so no task holds more than its range.
    """
    rows = _valid(df).select(*MAPPING_COLUMNS)
    fields = [
        F.concat(F.lit('      "domain": '), _go_json(F.col("domain"))),
        F.concat(F.lit('      "name": '), _go_json(F.col("name"))),
        F.concat(F.lit('      "organization": '), _go_json(F.col("organization"))),
        F.when(F.col("organizational_unit") != "", F.concat(F.lit('      "organizational_unit": '), _go_json(F.col("organizational_unit")))),
        F.concat(F.lit('      "source": '), _go_json(F.col("source"))),
        F.concat(F.lit('      "sequence_number": '), F.col("sequence_number").cast("string")),
    ]
    obj = F.concat(F.lit("    {\n"), F.concat_ws(",\n", *fields), F.lit("\n    }"))
    st = stats or {}
    stats_txt = "{\n" + ",\n".join(f'    "{k}": {json.dumps(v)}' for k, v in st.items()) + "\n  }" if st else "{}"
    body = rows.select(F.lit(1).alias("k"), "sequence_number", obj.alias("o")).groupBy("k", "sequence_number", "o").agg(F.count(F.lit(1)).alias("n"))
    last = body.agg(F.max(F.struct("sequence_number", "o")).alias("x")).first()["x"]
    if last is None:
        lines = df.sparkSession.createDataFrame([(0, '{\n  "mappings": [],\n  "stats": ' + stats_txt + "\n}")], "k int, value string")
    else:
        # equal rows are one line repeated; only the last one of the document has no comma
        is_last = (F.col("sequence_number") == F.lit(last["sequence_number"])) & (F.col("o") == F.lit(last["o"]))
        many = F.array_join(F.array_repeat("o", F.col("n").cast("int")), ",\n")
        text = F.when(is_last, many).otherwise(F.concat(many, F.lit(",")))
        edge = df.sparkSession.createDataFrame([(0, 0, '{\n  "mappings": ['), (2, 0, '  ],\n  "stats": ' + stats_txt + "\n}")], "k int, sequence_number long, value string")
        lines = body.select("k", "sequence_number", "o", text.alias("value")).unionByName(edge.withColumn("o", F.lit(""))).orderBy("k", "sequence_number", "o")
    lines.select("value").write.mode("overwrite").text(path)
