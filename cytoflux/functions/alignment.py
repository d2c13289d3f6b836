"""Column functions over CIGAR strings, geometry, bases and phase votes."""

from __future__ import annotations

import functools
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

#: CIGARs whose parse a worker keeps.
KEPT = 1 << 16
LENGTHS = ("reference", "query", "leading", "trailing")


def cigar_ops(cigar: Column) -> Column:
    """Array of (n, op).  An operation other than M, I, D, S, H is an error."""
    lengths = F.regexp_extract_all(cigar, F.lit(r"(\d+)[MIDSH]"), F.lit(1))
    ops = F.regexp_extract_all(cigar, F.lit(r"\d+([MIDSH])"), F.lit(1))
    parsed = F.zip_with(lengths, ops, lambda n, op: F.struct(n.cast("int").alias("n"), op.alias("op")))
    return F.when(cigar.rlike(r"^(\d+[MIDSH])+$"), parsed).otherwise(F.raise_error(F.concat(F.lit("unsupported CIGAR "), cigar)))


def _total(ops: Column, kinds: str) -> Column:
    return F.aggregate(ops, F.lit(0), lambda total, x: total + F.when(x["op"].isin(*kinds), x["n"]).otherwise(0))


def reference_length(ops: Column) -> Column:
    return _total(ops, "MD")


def query_length(ops: Column) -> Column:
    return _total(ops, "MI")


def leading_clip(ops: Column) -> Column:
    """Bases of all clips before the first aligned operation."""
    start = F.struct(F.lit(0).alias("n"), F.lit(True).alias("open"))

    def step(acc: Column, x: Column) -> Column:
        clip = acc["open"] & x["op"].isin("S", "H")
        return F.struct((acc["n"] + F.when(clip, x["n"]).otherwise(0)).alias("n"), clip.alias("open"))

    return F.aggregate(ops, start, step, lambda acc: acc["n"])


def trailing_clip(ops: Column) -> Column:
    return leading_clip(F.reverse(ops))


def query_start(ops: Column, reverse: Column) -> Column:
    """Clipped bases before the read's 5' end."""
    return F.when(reverse, trailing_clip(ops)).otherwise(leading_clip(ops))


def aligned_blocks(ops: Column, start: Column) -> Column:
    """M blocks as an array of (ref_start, query_start, n)."""
    empty = F.array().cast("array<struct<ref_start:bigint,query_start:int,n:int>>")
    zero = F.struct(start.cast("bigint").alias("r"), F.lit(0).alias("q"), empty.alias("blocks"))

    def step(acc: Column, x: Column) -> Column:
        block = F.array(F.struct(acc["r"].alias("ref_start"), acc["q"].alias("query_start"), x["n"].alias("n")))
        return F.struct(
            (acc["r"] + F.when(x["op"].isin("M", "D"), x["n"]).otherwise(0)).alias("r"),
            (acc["q"] + F.when(x["op"].isin("M", "I", "S"), x["n"]).otherwise(0)).alias("q"),
            F.when(x["op"] == "M", F.concat(acc["blocks"], block)).otherwise(acc["blocks"]).alias("blocks"),
        )

    return F.aggregate(ops, zero, step, lambda acc: acc["blocks"])


@functools.lru_cache(KEPT)
def parsed(cigar: str | None) -> tuple[tuple[int, int, int, int], tuple[tuple[int, int, int], ...]]:
    """Bases on the reference, of the query, of leading and of trailing clips; and M blocks as (reference offset, query start, n)."""
    if cigar is None or not re.fullmatch(r"([0-9]+[MIDSH])+", cigar):
        raise ValueError(f"unsupported CIGAR {cigar}")
    reference = query = leading = trailing = at = 0
    inside, blocks = False, []
    for digits, op in re.findall(r"([0-9]+)(.)", cigar):
        n = int(digits)
        if op in "SH":
            leading, trailing = leading + (0 if inside else n), trailing + n
            at += n if op == "S" else 0
            continue
        inside, trailing = True, 0
        if op == "M":
            blocks.append((reference, at, n))
        reference += n if op in "MD" else 0
        query, at = (query + n, at + n) if op in "MI" else (query, at)
    return (reference, query, leading, trailing), tuple(blocks)


@F.arrow_udf(StructType([StructField(c, IntegerType()) for c in LENGTHS]))
def cigar_lengths(cigar: pa.Array) -> pa.Array:
    """What ``reference_length``, ``query_length``, ``leading_clip`` and ``trailing_clip`` say, from one parse for each different CIGAR of a batch."""
    each = cigar.dictionary_encode("encode")
    lengths = np.array([parsed(c)[0] for c in each.dictionary.to_pylist()], np.int64).reshape(-1, 4).take(each.indices.to_numpy(), axis=0)
    return pa.StructArray.from_arrays([pa.array(lengths[:, k]).cast(pa.int32()) for k in range(4)], list(LENGTHS))


@F.arrow_udf(IntegerType())
def query_index(cigar: pa.Array, offset: pa.Array) -> pa.Array:
    """The place in the sequence of the base that is aligned ``offset`` bases after the start; null where none is."""
    found = zip(cigar.to_pylist(), offset.to_pylist(), strict=True)
    return pa.array([next((q + o - r for r, q, n in parsed(c)[1] if r <= o < r + n), None) for c, o in found], pa.int32())


# So that neither is computed again for a filter, nor before rows are made distinct.
cigar_lengths, query_index = cigar_lengths.asNondeterministic(), query_index.asNondeterministic()


def base_at(seq: Column, query_index: Column) -> Column:
    return F.substring(seq, query_index + 1, F.lit(1))


def quality_at(qual: Column, query_index: Column) -> Column:
    return F.ascii(F.substring(qual, query_index + 1, F.lit(1))) - 33


def phase_verdict(n0: Column, n1: Column) -> Column:
    """0 or 1 where all evidence is on one side, else ``.``."""
    return F.when((n0 > 0) & (n1 == 0), "0").when((n1 > 0) & (n0 == 0), "1").otherwise(".")
