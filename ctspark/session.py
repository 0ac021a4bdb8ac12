"""Spark session helpers.

Library code never creates its own session; it takes the caller's. These helpers exist for
tests, the bench and local runs.  ``checkpoint_dir`` honours a cluster-provided
``spark.checkpoint.dir`` and only falls back to a fresh scratch folder when it is unset.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # PSL and other reference tables are broadcast explicitly after a size check; keep the
    # automatic threshold at its default so large relations are never broadcast by accident.
    "spark.sql.autoBroadcastJoinThreshold": str(10 * 1024 * 1024),
}


def get_spark(master: str | None = None, shuffle_partitions: int = 8, app: str = "ctspark") -> SparkSession:
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    builder = SparkSession.builder.master(master).appName(app)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("CTSPARK_DRIVER_MEMORY", _default_driver_memory()))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    from .shipping import ensure_shipped

    ensure_shipped(spark)
    return spark


def _default_driver_memory() -> str:
    """8 GB, or 60 % of the machine's memory when that is smaller (local runs only)."""
    try:
        total = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES")
        return f"{max(1, min(8, int(total * 0.6 / 2**30)))}g"
    except (ValueError, OSError, AttributeError):
        return "4g"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; create a scratch one only when the cluster gave none."""
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="ctspark-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir()


def keep(df, name: str):
    """Write ``df`` to the shared checkpoint folder and read it back, so that later steps see the same rows."""
    import uuid

    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/kept-{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Tasks a core that list folders: listing one takes less than starting a task for it.
LISTING_TASKS = 4


def few_listing_tasks(spark: SparkSession) -> None:
    """From now on the session lists many folders or files in a few tasks a core, not in one task each.

    A streaming source lists its folder at every trigger, by the session's setting of that moment, so it stays.
    """
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    most = LISTING_TASKS * spark.sparkContext.defaultParallelism
    if int(spark.conf.get(key)) > most:
        spark.conf.set(key, str(most))


def make_dirs(spark: SparkSession, path: str) -> None:
    """Create a folder through the Hadoop file system of ``path``."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(p)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder through its Hadoop file system, if it is there."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str):
    return spark.read.parquet(table_path(sf_dir, name))


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop file system of ``path`` (works for any scheme)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))
