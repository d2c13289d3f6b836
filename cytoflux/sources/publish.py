"""Several outputs of one run, published together.

Outputs are written under a name of their own run; what readers follow is one small pointer file, replaced at the end in one step.  A run that is
lost before that leaves the earlier outputs whole and its own files unseen.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

POINTER = "CURRENT"


def _files(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path
    return path, path(folder).getFileSystem(spark._jsc.hadoopConfiguration())


def _put(spark: SparkSession, folder: str, name: str, text: str) -> None:
    """A small file, written aside and moved to its name in one step."""
    path, fs = _files(spark, folder)
    aside = path(f"{folder}/.{name}-{uuid.uuid4().hex}")
    out = fs.create(aside, True)
    out.write(bytearray(text.encode()))
    out.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = spark._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(aside, path(f"{folder}/{name}"), options)


def _get(spark: SparkSession, folder: str, name: str) -> str | None:
    path, fs = _files(spark, folder)
    if not fs.exists(path(f"{folder}/{name}")):
        return None
    return "\n".join(r["value"] for r in spark.read.text(f"{folder}/{name}").collect())  # a pointer or one row of a summary


def digested(df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df`` with an observation of its rows and of a digest that does not depend on their order, taken while it is written."""
    seen = Observation()
    h = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), F.coalesce(F.bit_xor(h), F.lit(0)).alias("hash_xor"), F.coalesce(F.sum(h.cast("decimal(38,0)")), F.lit(0)).cast("string").alias("hash_sum")), seen


def publish(base: DataFrame, outputs: dict[str, Callable[[DataFrame], DataFrame]], folder: str, settings: dict[str, object], counters: dict[str, F.Column] | None = None, before: Callable[[str], None] | None = None) -> dict[str, object]:
    """Write ``base`` once and each output from it, then a one-row summary, then the pointer; returns the summary.

    The summary has ``settings``, the ``counters`` (aggregates over ``base``, taken while it is written) and, of each output, its rows and digest.  ``before`` is called with
    the name of each step before it is taken.
    """
    spark = base.sparkSession
    run = f"run-{uuid.uuid4().hex}"
    here = f"{folder}/{run}"
    tell = before or (lambda step: None)
    tell("base")
    counted = Observation() if counters else None
    seen = base.observe(counted, *[c.alias(k) for k, c in counters.items()]) if counters else base
    seen.write.parquet(f"{here}/_base")
    kept = spark.read.schema(base.schema).parquet(f"{here}/_base")
    summary: dict[str, object] = {"run": run, **settings, **(counted.get if counted else {})}
    for name, make in outputs.items():
        tell(name)
        df, digest = digested(make(kept))
        df.write.parquet(f"{here}/{name}")
        summary |= {f"{name}_{k}": v for k, v in digest.get.items()}
    tell("summary")
    _put(spark, here, "summary.json", json.dumps(summary, sort_keys=True, default=str))
    tell("pointer")
    _put(spark, folder, POINTER, run)
    return summary


def published(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """An output of the last whole run."""
    run = _get(spark, folder, POINTER)
    if run is None:
        raise FileNotFoundError(f"nothing is published in {folder}")
    return spark.read.parquet(f"{folder}/{run}/{name}")


def summary_of(spark: SparkSession, folder: str) -> dict[str, object]:
    run = _get(spark, folder, POINTER)
    if run is None:
        raise FileNotFoundError(f"nothing is published in {folder}")
    return json.loads(_get(spark, f"{folder}/{run}", "summary.json"))


def verified(spark: SparkSession, folder: str, names: list[str]) -> DataFrame:
    """Per output: rows and digest as summed up and as found, and whether they agree."""
    told = summary_of(spark, folder)
    out = []
    for n in names:
        t = published(spark, folder, n)
        h = F.xxhash64(*[F.col(f"`{c}`") for c in t.columns])
        found = t.agg(F.count("*").alias("rows"), F.coalesce(F.bit_xor(h), F.lit(0)).alias("hash_xor"), F.coalesce(F.sum(h.cast("decimal(38,0)")), F.lit(0)).cast("string").alias("hash_sum"))
        same = (F.col("rows") == F.lit(told[f"{n}_rows"])) & (F.col("hash_xor") == F.lit(told[f"{n}_hash_xor"])) & (F.col("hash_sum") == F.lit(str(told[f"{n}_hash_sum"])))
        out.append(found.select(F.lit(n).alias("output"), "rows", same.alias("whole")))
    first, *rest = out
    for t in rest:
        first = first.unionByName(t)
    return first
