"""Quality control: counts, sex calls, contamination, adapters, TSS profiles, metadata assembly, contract checks."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.names import natural_key
from .intervals import point_join

#: Poly-T, one base that is not T, any base, then the restriction site (fixed value).
CONTAMINATION = "TTTTTTTT[ACG][ACGT]GATC"
#: Names of the mitochondrion (fixed values).
MITOCHONDRION = ("chrM", "Mt", "MT")
#: Adapter sequences by kit (fixed values).
ADAPTERS = {"illumina": "AGATCGGAAGAGC", "nextera": "CTGTCTCTTATA", "small_rna": "TGGAATTCTCGG"}


def flag_counts(alignments: DataFrame, key: list[str], contact_mapq: int, sex_mapq: int, x: str = "chrX", y: str = "chrY") -> DataFrame:
    """Alignments in all, mapped, good enough for contacts, and on X and Y under the bound of their own."""
    mapped = F.col("flag").bitwiseAND(F.lit(4)) == 0
    strict = mapped & (F.col("mapq") >= sex_mapq)
    return alignments.groupBy(*key).agg(
        F.count("*").alias("total"),
        F.count_if(mapped).alias("mapped"),
        F.count_if(mapped & (F.col("mapq") >= contact_mapq)).alias("qualifying"),
        F.count_if(strict & (F.col("chrom") == x)).alias("x"),
        F.count_if(strict & (F.col("chrom") == y)).alias("y"),
    )


def sex_call(counts: DataFrame, threshold: str = "0.015", fallback: str = "XX") -> DataFrame:
    """States and call of each row of ``flag_counts``.

    A cell without alignments, without mapped ones or without good ones has no call (empty, ``not_applicable``), so it passes neither as female nor as male.  The
    ratio is Y / X rounded to six places and compared strictly.  Without X, any Y is XY, and the effective ratio is Y itself, which is not
    measured; without either the fallback stands, with an effective ratio of 0, or of the threshold and 1 for XY.
    """
    if fallback not in ("XX", "XY"):
        raise ValueError("the fallback is XX or XY")
    x, y, bound = F.col("x"), F.col("y"), F.lit(threshold).cast("decimal(38,6)")
    ratio = F.round((y.cast("decimal(18,0)") / F.greatest(x, F.lit(1)).cast("decimal(18,0)")).cast("decimal(38,12)"), 6).cast("decimal(38,6)")
    state = F.when(F.col("total") == 0, "header_only").when(F.col("mapped") == 0, "unmapped_only").when(F.col("qualifying") == 0, "low_mapq_only").otherwise("qualifying_mapped_records")
    known = state == "qualifying_mapped_records"
    neither, only_y = (x == 0) & (y == 0), (x == 0) & (y > 0)
    male = only_y | (~neither & (ratio > bound))
    sex = F.when(~known, "not_applicable").when(neither, "undetermined_no_xy").when(only_y, "xy_y_only").when(y == 0, F.when(male, "xy_ratio").otherwise("xx_x_only")).when(male, "xy_ratio").otherwise("xx_ratio")
    call = F.when(~known, "").when(neither, fallback).when(male, "XY").otherwise("XX")
    kind = F.when(~known, "not_applicable").when(neither, "undefined_zero_zero").when(only_y, "positive_infinity").otherwise("finite")
    measured = known & (x > 0)
    effective = F.when(known, F.when(neither, F.lit(0) if fallback == "XX" else bound + 1).otherwise(ratio)).cast("decimal(38,6)")
    return counts.select(
        "*",
        state.alias("input_state"),
        sex.alias("sex_state"),
        call.alias("sex_call"),
        (known & neither).alias("fallback_applied"),
        kind.alias("ratio_state"),
        measured.alias("measured"),
        F.when(measured, ratio).alias("measured_yperx"),
        effective.alias("effective_yperx"),
    )


def contamination(reads: DataFrame, key: list[str], seq: str = "seq", pattern: str = CONTAMINATION) -> DataFrame:
    t = reads.groupBy(*key).agg(F.count("*").alias("reads"), F.count_if(F.col(seq).rlike(pattern)).alias("hits"))
    return t.withColumn("percent", F.try_divide(F.col("hits"), F.col("reads")) * 100)


def adapter_counts(reads: DataFrame, order: str, lines: int | None = 1_000_000, adapters: dict[str, str] = ADAPTERS, seq: str = "seq") -> DataFrame:
    """How many of the reads in the first ``lines`` lines of a FASTQ file hold each adapter, and which is the most frequent.

    ``order`` is a read's number in its file, from 0, so the reads are a filter and nothing is sorted.  Of equals the first name is the most frequent; it is
    empty if no read has an adapter.
    """
    hits = reads.where(F.col(order) < -(-lines // 4)) if lines is not None else reads
    counts = hits.agg(*[F.count_if(F.col(seq).contains(a)).alias(k) for k, a in adapters.items()])
    most = F.greatest(*adapters) if len(adapters) > 1 else F.col(next(iter(adapters)))
    best = reduce(lambda rest, k: F.when(F.col(k) == most, F.lit(k)).otherwise(rest), reversed(sorted(adapters)), F.lit(""))
    return counts.select(*adapters, F.when(most == 0, "").otherwise(best).alias("best"))


def tss_pileup(sites: DataFrame, tss: DataFrame, flank: int = 1000, exclude: tuple[str, ...] = MITOCHONDRION) -> DataFrame:
    """Insertions per cell and offset within ``flank`` bases of transcription starts (chrom, pos, strand); minus strands flip.

    Insertions are summed per cell and place before the range join, so its work follows distinct places.  Starts on chromosomes named in ``exclude`` do not count.
    """
    windows = tss.where(~F.col("chrom").cast("string").isin(*exclude)) if exclude else tss
    windows = windows.select("chrom", (F.col("pos") - flank).alias("start"), (F.col("pos") + flank + 1).alias("end"), F.col("pos").alias("tss"), "strand")
    places = sites.groupBy("cell", "chrom", F.col("site").alias("pos")).agg(F.count("*").alias("n"))
    hits = point_join(windows, places, ["chrom"], width=max(512, 2 * flank))
    offset = F.col("r_pos") - F.col("l_tss")
    offset = F.when(F.col("l_strand") == "-", -offset).otherwise(offset)
    return hits.groupBy(F.col("r_cell").alias("cell"), offset.alias("offset")).agg(F.sum("r_n").alias("n"))


def tss_score(pileup: DataFrame, cells: DataFrame, flank: int = 1000, edge: int = 100, core: tuple[int, int] = (-501, 499)) -> DataFrame:
    """Mean of the core offsets (both bounds included) over the mean of the flanks per cell; an empty flank takes the mean over cells.

    All offsets count, those without an insertion as zero.  The score is null for a cell without insertions.
    """
    low, high = F.col("offset") < -flank + edge, F.col("offset") > flank - edge
    middle = F.col("offset").between(*core)
    per = pileup.groupBy("cell").agg(F.sum(F.when(low | high, F.col("n")).otherwise(0)).alias("edge_n"), F.sum(F.when(middle, F.col("n")).otherwise(0)).alias("core_n"), F.sum("n").alias("all_n"))
    t = cells.join(per, "cell", "left").na.fill(0, ["edge_n", "core_n", "all_n"])
    t = t.withColumn("flank_mean", F.col("edge_n") / (2 * edge))
    mean = t.agg(F.avg("flank_mean").alias("cohort_mean"))
    t = t.join(F.broadcast(mean))  # one row
    base = F.when(F.col("flank_mean") == 0, F.col("cohort_mean")).otherwise(F.col("flank_mean"))
    score = F.try_divide(F.col("core_n") / (core[1] - core[0] + 1), base)
    return t.select("cell", F.col("all_n").alias("insertions"), F.when(F.col("all_n") > 0, score).alias("tss_score"))


def tss_status(bin_count: Column, score: Column) -> Column:
    """``ok`` for a finite score of a cell with counts; without counts, or with another score, ``insufficient_data``."""
    finite = score.isNotNull() & ~F.isnan(score) & (F.abs(score) != float("inf"))
    return F.when((bin_count > 0) & finite, "ok").otherwise("insufficient_data")


def bulk_tss_profile(sites: DataFrame, tss: DataFrame, edge: int = 2000, bins: int = 400) -> DataFrame:
    """Mean insertions per bin around starts over the mean of the outer bins."""
    width = 2 * edge // bins
    outer = int(100 / (2 * edge / bins))
    pile = tss_pileup(sites.withColumn("cell", F.lit(0)), tss, edge, ()).where(F.col("offset") < edge)
    t = pile.groupBy(F.floor((F.col("offset") + edge) / width).alias("bin")).agg(F.sum("n").alias("n"))
    noise = t.agg((F.sum(F.when((F.col("bin") < outer) | (F.col("bin") >= bins - outer), F.col("n")).otherwise(0)) / (2 * outer)).alias("noise"))
    return t.join(F.broadcast(noise)).select("bin", "n", F.try_divide("n", "noise").alias("signal"))  # one row


def left_join_all(cells: DataFrame, tables: list[DataFrame], key: str) -> DataFrame:
    """The cohort with the columns of all tables; a cell that a table lacks has nulls."""
    return reduce(lambda a, b: a.join(b, key, "left"), tables, cells)


def full_join_all(tables: list[DataFrame], key: str) -> DataFrame:
    return reduce(lambda a, b: a.join(b, key, "full"), tables)


def metadata_ratios(t: DataFrame) -> DataFrame:
    """Derived ratios of a metadata table; null where the denominator is 0."""
    return t.select(
        "*",
        F.try_divide(F.col("rna_reads"), F.col("dna_reads")).alias("rna_reads_ratio"),
        F.try_divide(F.col("pairs"), F.col("dna_reads")).alias("pairs_per_read"),
        F.try_divide(F.col("inter_pairs"), F.col("pairs")).alias("inter_pairs_ratio"),
    )


def filled(t: DataFrame, keep: str = "rmsd_") -> DataFrame:
    """Null and NaN become 0 in numeric columns, but for those that begin with ``keep``."""
    out = []
    for f in t.schema:
        c = F.col(f.name)
        if f.name.startswith(keep) or f.dataType.typeName() not in ("integer", "long", "double", "float"):
            out.append(c)
        elif f.dataType.typeName() in ("double", "float"):
            out.append(F.coalesce(F.nanvl(c, F.lit(0.0)), F.lit(0.0)).alias(f.name))
        else:
            out.append(F.coalesce(c, F.lit(0).cast(f.dataType)).alias(f.name))
    return t.select(*out)


def set_differences(expected: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """Keys on one side only: ``missing`` from ``found``, or ``unexpected`` in it."""
    e, f = expected.select(key).distinct(), found.select(key).distinct()
    return e.join(f, key, "left_anti").select(key, F.lit("missing").alias("status")).union(f.join(e, key, "left_anti").select(key, F.lit("unexpected").alias("status")))


def field_differences(stored: DataFrame, live: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Changed fields of keys on both sides, and added or removed keys: key, field, stored, live."""
    tall = lambda d, name: d.select(key, F.explode(F.map_from_arrays(F.array(*[F.lit(c) for c in fields]), F.array(*[F.col(c).cast("string") for c in fields]))).alias("field", name))
    return tall(stored, "stored").join(tall(live, "live"), [key, "field"], "full").where(~F.col("stored").eqNullSafe(F.col("live")))


def checked(df: DataFrame, good: Column, message: str) -> DataFrame:
    """``df`` where every row must satisfy ``good``: an offending row is an error when it is read."""
    return df.where(F.when(F.coalesce(good, F.lit(False)), True).otherwise(F.raise_error(F.lit(message)).cast("boolean")))


def unsorted_rows(df: DataFrame, keys: list[str], order: str, value: str) -> DataFrame:
    """Rows whose ``value`` is below that of the row before them."""


    return df.withColumn("before", F.lag(value).over(W.partitionBy(*keys).orderBy(order))).where(F.col(value) < F.col("before"))


def contract_hash(cells: DataFrame, fan: int = 4096) -> DataFrame:
    """One SHA-256 over the cohort in its order (``ord``, from 0): of blocks of ``fan`` cells, of blocks of blocks, and of all of these.

    No task holds more than ``fan`` rows up to ``fan`` cubed cells.
    """
    shown = cells.select(F.col("ord").cast("long").alias("k"), F.to_json(F.struct("ord", "sample_name", "safe_code")).alias("text"))
    of = lambda text: F.sha2(text.cast("binary"), 256)
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("k", "text"))), lambda x: x["text"]), "\n")
    for _ in range(2):
        shown = shown.groupBy(F.floor(F.col("k") / fan).alias("next")).agg(of(joined).alias("text")).select(F.col("next").alias("k"), "text")
    return shown.agg(of(joined).alias("sha256"))


def _hash_stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the texts of one sorted stream, comma-joined in brackets; a task holds one of them at a time."""
    state, first = hashlib.sha256(b"["), True
    for batch in batches:
        for text in batch.column(batch.schema.get_field_index("text")).to_pylist():
            state.update(text.encode() if first else b"," + text.encode())
            first = False
    state.update(b"]")
    yield pa.RecordBatch.from_arrays([pa.array([state.hexdigest()])], names=["sha256"])


def normalized_contract_hash(cells: DataFrame, fan: int = 4096) -> DataFrame:
    """The hash of a cohort's normalised contract: SHA-256 of the JSON list of its cells in order, keys sorted, no blanks.

    ``cells`` have ord (from 0), sample_name, safe_code and, of both mates, ``r1_bytes`` and ``r1_first_record_sha256``.  Cells are put together by ``fan``; one
    stream over these parts, sorted, is hashed, as its definition asks.  Names are ASCII.
    """
    fields = ["r1_bytes", "r1_first_record_sha256", "r2_bytes", "r2_first_record_sha256", "safe_code", "sample_name"]
    shown = cells.select(F.col("ord").cast("long").alias("k"), F.to_json(F.struct(*fields)).alias("text"))
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("k", "text"))), lambda x: x["text"]), ",")
    parts = shown.groupBy(F.floor(F.col("k") / fan).alias("part")).agg(joined.alias("text"))
    return parts.repartition(1).sortWithinPartitions("part").mapInArrow(_hash_stream, "sha256 string")


def natural_order_faults(names: DataFrame, keys: list[str], order: str, name: str = "name") -> DataFrame:
    """Rows whose name comes, in natural order, before that of the row before them (``order`` within ``keys``)."""
    d = names.withColumn("_key", natural_key(F.col(name)))
    return unsorted_rows(d, keys, order, "_key").drop("_key", "before")


def in_natural_order(names: DataFrame, keys: list[str], order: str, name: str = "name") -> DataFrame:
    """``names``, where a name out of natural order is an error when it is read."""
    w = W.partitionBy(*keys).orderBy(order)
    key = natural_key(F.col(name))
    d = names.withColumn("_sorted", F.coalesce(key >= F.lag(key).over(w), F.lit(True)))
    return checked(d, F.col("_sorted"), "names are not in natural order").drop("_sorted")


def assigned_totals(reads: DataFrame, cells: DataFrame, cell: str = "cell", status: str = "xs") -> DataFrame:
    """Per cell of the cohort: its reads and those assigned to a gene; zeros for a cell without reads.  Reads of no cell are an error."""
    n = reads.groupBy(cell).agg(F.count("*").alias("total"), F.count_if(F.col(status) == "Assigned").alias("assigned"))
    t = cells.select(cell, F.lit(True).alias("_known")).join(n, cell, "full").na.fill(0, ["total", "assigned"])
    return checked(t, F.col("_known"), "reads of a cell that is not in the cohort").drop("_known")


def exact_cohort(stats: DataFrame, cells: DataFrame, name: str = "sample_name", values: tuple[str, ...] = ("n",)) -> DataFrame:
    """Faults of a table of counts that must list the cohort in order (``ord`` on both sides), each cell once, with whole numbers that are not negative.

    Rows: the cell's place, what both sides have there, and the fault.
    """
    side = stats.select("ord", F.col(name).alias("found"), *values)
    both = cells.select("ord", F.col(name).alias("expected")).join(side, "ord", "full")
    bad = reduce(lambda a, b: a | b, [F.col(v).isNull() | (F.col(v) < 0) | (F.col(v) != F.floor(v)) for v in values])
    fault = F.when(F.col("found").isNull(), "missing").when(F.col("expected").isNull(), "unexpected").when(F.col("found") != F.col("expected"), "out of order").when(bad, "bad count")
    return both.select("ord", "expected", "found", fault.alias("fault")).where("fault IS NOT NULL")


def audit(checks: dict[str, DataFrame]) -> DataFrame:
    """One row per named table of faults: check, faults, status."""
    rows = [d.agg(F.count("*").alias("faults")).select(F.lit(k).alias("check"), "faults", F.when(F.col("faults") == 0, "pass").otherwise("fail").alias("status")) for k, d in checks.items()]
    return reduce(DataFrame.union, rows)


def expected_grid(cells: DataFrame, values: list[str], name: str) -> DataFrame:
    """Every cell with every one of a few values."""
    return cells.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))
