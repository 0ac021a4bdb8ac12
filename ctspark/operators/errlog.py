"""Error table reports (summary, newest errors, log sampling, error budget)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import errors as E
from .ordering import positions

# Log sampling (first n, then every m-th) for the two frequent types.
SAMPLING = {E.PARSING: (10, 100), E.PROCESSING: (5, 50)}
DEFAULT_MAX_ERRORS = 1000


def classify(errors: DataFrame) -> DataFrame:
    return errors.withColumn("error_type", E.classify_error(F.col("message"), F.col("context")))


def error_actions(errors: DataFrame, message: str = "message", operation: str = "context", kind: str = "kind", attempt: str = "attempt") -> DataFrame:
    """E7 over an error table, staged: the two classifications are computed once per row in
    their own projection and the action reads them (a much smaller expression to plan)."""
    staged = errors.select(
        "*",
        E.classify_s3_error(message, operation).alias("__s3_type"),
        E.classify_error(F.col(message), F.lit("processing")).alias("__proc_type"),
    )
    act = E.error_action(F.col(message), F.col(operation), F.col(kind), F.col(attempt), s3_type="__s3_type", proc_type="__proc_type")
    return staged.select(*errors.columns, act.alias("action"))


def error_summary(errors: DataFrame) -> DataFrame:
    """A4: count per error type plus a grand-total row (error_type null), via rollup."""
    return classify(errors).rollup("error_type").agg(F.count(F.lit(1)).alias("errors"))


def recent_errors(errors: DataFrame, n: int = 100) -> DataFrame:
    """The newest n errors (a top-k: TakeOrderedAndProject, no full sort)."""
    return errors.orderBy(F.col("ts").desc(), F.col("sequence").desc()).limit(n)


def sample_errors(errors: DataFrame, bucket=None) -> DataFrame:
    """Which errors are logged: PARSING first 10 then every 100th, PROCESSING first 5 then
    every 50th, all others always; with the log level of the type.  The per-type count is a
    two-level row number (type x hour), so one dominant type does not land in one task."""
    c = classify(errors)
    bucket = bucket if bucket is not None else F.date_trunc("hour", F.col("ts"))
    p = positions(c, ["error_type"], ["ts", "sequence"], bucket).withColumnRenamed("position", "type_count")
    t, k = F.col("error_type"), F.col("type_count")
    logged = F.lit(True)
    for typ, (first, every) in SAMPLING.items():
        logged = F.when(t == typ, (k <= first) | (k % every == 0)).otherwise(logged)
    return p.withColumn("logged", logged).withColumn("level", E.severity(t))


def error_budget(errors: DataFrame, max_errors: int = DEFAULT_MAX_ERRORS, part: str = "source_file", bucket=None) -> DataFrame:
    """Per job (source file), the error at which the count reaches the budget; processing
    stops there.  A budget <= 0 means the default 1000.  One row per job that hits the budget."""
    m = max_errors if max_errors > 0 else DEFAULT_MAX_ERRORS
    bucket = bucket if bucket is not None else F.date_trunc("hour", F.col("ts"))
    p = positions(errors, [part], ["ts", "sequence"], bucket)
    return p.filter(F.col("position") == m).select(part, F.col("sequence").alias("stop_sequence"), F.col("ts").alias("stop_ts"), F.col("position").alias("errors_at_stop"))
