"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame

_own: str | None = None


def saved(df: DataFrame, label: str) -> DataFrame:
    """Write a frame below ``spark.checkpoint.dir`` and read it back, which ends its lineage.

    Without that setting a temporary folder of this process is used on a local master; on a
    cluster, where executors would each write to a disk of their own, it is an error.
    Folders go when the JVM ends.
    """
    global _own
    spark = df.sparkSession
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not re.match(r"local($|\[)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        if _own is None:
            _own = tempfile.mkdtemp(prefix="ladderline-scratch-")
            atexit.register(shutil.rmtree, _own, ignore_errors=True)
        base = f"file://{_own}"
    out = f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(out)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)
    df.write.parquet(out)
    return spark.read.schema(df.schema).parquet(out)
