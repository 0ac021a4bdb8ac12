"""Make the package importable on executors (Python stages unpickle functions by module)."""

from __future__ import annotations

import io
import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_SHIPPED: set = set()


def ensure_shipped(spark: SparkSession) -> None:
    """Zip this package once per SparkContext and register it with ``addPyFile``."""
    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for base, _dirs, files in os.walk(pkg_dir):
            if "__pycache__" in base:
                continue
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(base, f)
                    z.write(full, os.path.relpath(full, root))
    # the archive is a driver-side artifact; Spark copies it to every executor
    fd, path = tempfile.mkstemp(prefix="ctspark-", suffix=".zip")
    with os.fdopen(fd, "wb") as fh:
        fh.write(buf.getvalue())
    sc.addPyFile(path)
    _SHIPPED.add(key)
