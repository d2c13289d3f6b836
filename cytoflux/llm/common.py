"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import atexit
import ctypes
import gc
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ARROW = {
    "boolean": pa.bool_(),
    "int": pa.int32(),
    "long": pa.int64(),
    "double": pa.float64(),
    "string": pa.string(),
    "binary": pa.binary(),
    "array<int>": pa.list_(pa.int32()),
    "array<long>": pa.list_(pa.int64()),
    "array<string>": pa.list_(pa.string()),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors see.

    A cluster names it in ``spark.checkpoint.dir``.  Only a session in one process, as in
    tests, may leave that unset and then gets a temporary folder; elsewhere it is an error, as
    executors would write to disks of their own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="cytoflux-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    This cuts the lineage: a later job, or a retry after an executor is lost, starts
    at the files.  They go when the session ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)
    return spark.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, name: str) -> str:
    """``name``, or a longer one if a column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def rows_where(docs: DataFrame, outputs: list[str], operator: Callable[[DataFrame], DataFrame], condition: Column) -> DataFrame:
    """Rows of ``docs`` for which ``condition`` holds over columns that ``operator`` appends; the columns of ``docs``.

    Columns of ``docs`` that have an output's name stand aside meanwhile.
    """
    aside: dict[str, str] = {}
    frame = docs
    for c in [c for c in docs.columns if c in outputs]:
        aside[c] = unused(frame, f"{c}_input")
        frame = frame.withColumnRenamed(c, aside[c])
    found = operator(frame).where(condition)
    return found.select(*[F.col(f"`{aside.get(c, c)}`").alias(c) for c in docs.columns])


def group_starts(t: pa.Table, keys: list[str]) -> np.ndarray:
    """The rows of a table sorted by ``keys`` where a group begins, and the number of rows; no key is null."""
    if not t.num_rows:
        return np.zeros(1, np.int64)
    n, other = t.num_rows, np.zeros(t.num_rows - 1, dtype=bool)
    for c in keys:
        column = t.column(c).combine_chunks()
        other |= pc.not_equal(column.slice(1), column.slice(0, n - 1)).to_numpy(zero_copy_only=False).astype(bool)
    return np.concatenate([[0], np.flatnonzero(other) + 1, [n]])


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Batches that come sorted by ``keys``, cut so that no group is spread over two tables."""
    rest: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        t = pa.Table.from_batches([batch])
        t = t if rest is None else pa.concat_tables([rest, t])
        at = int(group_starts(t, keys)[-2])
        rest = t.slice(at)
        if at:
            yield t.slice(0, at)
    if rest is not None:
        yield rest


def per_salt(rows: DataFrame, keys: list[str], *more: Column, salts: int = 64) -> DataFrame:
    """One row per group of ``keys`` and salt in it, with the number of the group's rows ``n`` and ``more`` of it; groups of two or more.

    ``rows`` have a column ``salt`` below ``salts``, which is 64 at most.  Tasks send one row a group, with its salts as bits.  Joined by keys and salt,
    no task gets a whole group.
    """
    whole = rows.groupBy(*keys).agg(F.count("*").alias("n"), F.bit_or(F.expr("shiftleft(1L, salt)")).alias("bits"), *more).where("n > 1")
    there = F.filter(F.sequence(F.lit(0), F.lit(salts - 1)), lambda k: F.getbit("bits", k) == 1)
    return whole.withColumn("salt", F.explode(there)).drop("bits")


def small_side(keys: DataFrame, most: int) -> DataFrame:
    """``keys``, marked for broadcast if a count finds no more than ``most`` rows of a few numbers each; else as they are."""
    return F.broadcast(keys) if keys.limit(most + 1).count() <= most else keys


_KEPT: dict[str, object] = {}


def kept(name: str, build: Callable[[], object]):
    """What the tasks of a Python worker share, such as a cache; a worker holds that of one operator at a time."""
    if name not in _KEPT:
        if _KEPT:
            _KEPT.clear()
            _give_back_memory()
        _KEPT[name] = build()
    return _KEPT[name]


def _give_back_memory() -> None:
    """Free pages go back to the system, where the C library can do that; workers live through many stages."""
    gc.collect()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def id_class(column: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as an empty text."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % modulus


def hash_share(column: Column, sample: int, n: int) -> Column:
    """Whether a 64-bit hash is below the bound that lets ``sample`` of ``n`` rows through on average; all where ``n`` is no more.

    The bound has 62 bits, so a sample neither vanishes nor grows, however many rows there are.
    """
    return F.pmod(column, F.lit(1 << 62)) < F.lit(share_bound(sample, n))


def share_bound(sample: int, n: int, bits: int = 62) -> int:
    return -(-(min(sample, n) << bits) // max(n, 1))


def slices(text: pa.Array, most_bytes: int) -> Iterator[tuple[int, int]]:
    """Row ranges of ``text`` that hold about ``most_bytes`` each, and a row at least."""
    sizes = pc.fill_null(pc.binary_length(text), 0).to_pylist()
    start = total = 0
    for row, size in enumerate(sizes):
        if row > start and total + size > most_bytes:
            yield start, row
            start, total = row, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def with_columns_from(
    df: DataFrame,
    inputs: list[str],
    outputs: dict[str, str],
    make: Callable[[], Callable],
    most_bytes: int = 1 << 20,
) -> DataFrame:
    """Append columns that an Arrow function computes row by row; no shuffle.

    ``make`` runs once in a task and returns the function, which gets the arrays of
    ``inputs`` for some rows (cut by the bytes of the first input, a text) and returns
    one list for each of ``outputs`` (name to type).  The other columns pass through; an
    input column that has an output's name is replaced.
    """
    kept = [c for c in df.columns if c not in outputs]
    passed = [c for c in kept if c not in inputs]
    df = df.select(*[F.col(f"`{c}`") for c in passed], *[F.col(f"`{c}`") for c in inputs])
    order = [*passed, *[c for c in inputs if c in kept]]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in (df.schema[c] for c in order)] + [f"`{k}` {v}" for k, v in outputs.items()])
    types = [ARROW[v] for v in outputs.values()]
    names = [*order, *outputs]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = make()
        for batch in batches:
            for start, stop in slices(batch.column(inputs[0]), most_bytes):
                part = batch.slice(start, stop - start)
                found = compute(*[part.column(c) for c in inputs])
                arrays = [x if isinstance(x, pa.Array) else pa.array(x, type=t) for x, t in zip(found, types, strict=True)]
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in order], *arrays], names=names)

    return df.mapInArrow(run, schema)
