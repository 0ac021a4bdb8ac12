"""S3 get-entries pages and S5 log lists (JSON documents)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.encoding import base64_valid
from ..functions.steps import computed
from ..operators.hosts import clean_log_name

PAGE_SCHEMA = "struct<entries:array<struct<leaf_input:string,extra_data:string>>>"


def _b64_ok(c):
    return c.isNull() | base64_valid(c)


# Fixed value: what a page that cannot be decoded is reported with.
ERR_PAGE = "get-entries page cannot be decoded"


def explode_entries(pages: DataFrame, json_col: str = "json", start_col: str = "start", keep_errors: bool = False) -> DataFrame:
    """S3: (log_index, leaf_input, extra_data) from (start, json) pages.

    Entry index = page start + position in the page.  A page that is not valid JSON, or that
    has a field that is not valid base64 (the JSON decoder decodes the bytes), yields no entry;
    with ``keep_errors`` it yields one row at the page's start, and a column ``page_error``.
    """
    p = computed(pages.withColumnRenamed(start_col, "start"), ["start"], p=F.from_json(F.col(json_col), PAGE_SCHEMA, {"mode": "PERMISSIVE"}))
    ok = F.coalesce(F.forall("p.entries", lambda e: _b64_ok(e["leaf_input"]) & _b64_ok(e["extra_data"])), F.lit(False))
    p = p.select("start", "p", ok.alias("ok"))
    if not keep_errors:
        rows = p.filter("ok").select("start", "ok", F.posexplode("p.entries").alias("pos", "e"))
    else:
        none = F.array(F.lit(None).cast("struct<leaf_input:string,extra_data:string>"))
        rows = p.select("start", "ok", F.posexplode(F.when(F.col("ok"), F.col("p.entries")).otherwise(none)).alias("pos", "e"))
    out = [(F.col("start") + F.col("pos")).alias("log_index"), F.col("e.leaf_input").alias("leaf_input"), F.col("e.extra_data").alias("extra_data")]
    if keep_errors:
        out.append(F.when(~F.col("ok"), F.lit(ERR_PAGE)).alias("page_error"))
    return rows.select(*out)


def read_get_entries(spark: SparkSession, path: str) -> DataFrame:
    """S3 from files: one JSON page per file, the page start taken from the file name's first
    integer (e.g. ``entries-1000-1999.json``)."""
    raw = spark.read.option("wholetext", "true").text(path).select(F.col("value").alias("json"), F.col("_metadata.file_name").alias("name"))
    start = F.regexp_extract(F.col("name"), r"(\d+)", 1).cast("long")
    return explode_entries(raw.select(start.alias("start"), "json"))


LOG_LIST_SCHEMA = (
    "struct<operators:array<struct<name:string,logs:array<struct<description:string,log_id:string,url:string,"
    "certspotter_download_jobs:int,certspotter_download_size:bigint>>>>>"
)


def read_log_list(spark: SparkSession, path: str) -> DataFrame:
    """Flat logs table (operator_pos, log_pos, description, log_id, url, jobs, download_size,
    file_name) from log-list JSON documents."""
    raw = spark.read.option("wholetext", "true").text(path)
    return flatten_log_list(raw.select(F.col("value").alias("json")))


def flatten_log_list(docs: DataFrame, col: str = "json") -> DataFrame:
    d = docs.select(F.from_json(F.col(col), LOG_LIST_SCHEMA).alias("d"))
    ops = d.select(F.posexplode(F.coalesce("d.operators", F.array())).alias("operator_pos", "op"))
    logs = ops.select("operator_pos", F.posexplode(F.coalesce("op.logs", F.array())).alias("log_pos", "l"))
    return logs.select(
        "operator_pos",
        "log_pos",
        F.col("l.description").alias("description"),
        F.col("l.log_id").alias("log_id"),
        F.col("l.url").alias("url"),
        F.col("l.certspotter_download_jobs").alias("download_jobs"),
        F.col("l.certspotter_download_size").alias("download_size"),
        clean_log_name(F.col("l.url")).alias("file_name"),
    )


def first_log(logs: DataFrame) -> DataFrame:
    """The log the ingest job uses: operator 0, log 0 (empty when there is none)."""
    return logs.filter((F.col("operator_pos") == 0) & (F.col("log_pos") == 0))
