"""Tables of a session in the folder that the driver and all executors share."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; only a session in one process may leave that unset, and then gets a temporary folder."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = tempfile.mkdtemp(prefix="cytoflux-")
        atexit.register(shutil.rmtree, found, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def place(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, which goes when the session ends."""
    path = f"{folder(spark)}/{name}-{uuid.uuid4().hex}"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def written(df: DataFrame, name: str = "table") -> DataFrame:
    """``df`` as a stored table: later jobs read the same rows in the same partitions."""
    path = place(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_lines(lines: DataFrame, name: str) -> str:
    """The path of a folder of text files, compressed at the fastest level, with ``lines`` (one text column)."""
    path = place(lines.sparkSession, name)
    lines.write.option("zlib.compress.level", "BEST_SPEED").text(path, compression="gzip")
    return path
