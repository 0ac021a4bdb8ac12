"""W5 / W6 as a stream: sliding rates over arriving counter samples.

Every micro-batch writes the windows that it changed under its epoch, with overwrite, so a replay changes
nothing; the rate of a window is that of its newest epoch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.monitor import windowed_rate


def start_rate_stream(samples: DataFrame, out_path: str, checkpoint: str, window_s: int = 60, slide_s: int = 10, part: tuple = (), watermark: str = "10 minutes", per_minute: bool = False, available_now: bool = True, interval: str = "10 seconds"):
    """Start the stream over streaming samples (ts, value, part...)."""

    def run_batch(df: DataFrame, epoch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{out_path.rstrip('/')}/epoch={epoch_id}")

    rates = windowed_rate(samples, window_s, slide_s, part, watermark, per_minute)
    w = rates.writeStream.outputMode("update").foreachBatch(run_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)
    return w.start()


def current_rates(spark: SparkSession, out_path: str, part: tuple = ()) -> DataFrame:
    """(part..., window_end, samples, rate): what the newest epoch says of each window."""
    d = spark.read.parquet(out_path)
    newest = F.max_by(F.struct("samples", "rate"), "epoch").alias("x")
    return d.groupBy(*part, "window_end").agg(newest).select(*part, "window_end", "x.samples", "x.rate")
