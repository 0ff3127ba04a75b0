"""A folder that driver and executors share, for files that jobs derive."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below spark.checkpoint.dir; where that is unset, below a new local folder if Spark runs on this machine alone."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        path = f"file://{tempfile.mkdtemp(prefix='spark-')}"
        spark.conf.set("spark.checkpoint.dir", path)
    return f"{path.rstrip('/')}/{name}-{uuid.uuid4().hex}"
