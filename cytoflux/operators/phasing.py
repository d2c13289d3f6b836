"""Haplotype votes of alignments over phased SNPs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.alignment import base_at, cigar_lengths, phase_verdict, quality_at, query_index
from .fragments import FIRST, REVERSE, SECOND, has_flag, mapped
from .intervals import point_join, sweep_point_join

#: Bins of the range join: a few reads long.
WIDTH = 512


def snp_votes(alignments: DataFrame, snps: DataFrame, ids: list[str], base: str = "base", width: int = WIDTH) -> DataFrame:
    """Votes per alignment with one observed base: SNPs (chrom, pos, a0, a1) inside [start, end)."""
    hits = point_join(alignments, snps, ["chrom"], width=width)
    seen = [F.col(f"l_{c}").alias(c) for c in dict.fromkeys([*ids, base])]
    return votes(hits.select(*seen, F.col("r_a0").alias("a0"), F.col("r_a1").alias("a1")), ids, base)


def votes(observed: DataFrame, ids: list[str], base: str = "base") -> DataFrame:
    """From observed bases to per-alignment counts and the verdict."""
    counted = observed.groupBy(*ids).agg(
        F.count_if(F.col(base) == F.col("a0")).alias("n0"),
        F.count_if(F.col(base) == F.col("a1")).alias("n1"),
        F.count_if((F.col(base) != F.col("a0")) & (F.col(base) != F.col("a1"))).alias("other"),
    )
    return counted.withColumn("phase", phase_verdict(F.col("n0"), F.col("n1")))


def swept_join(intervals: DataFrame, points: DataFrame, keys: list[str], width: int = WIDTH) -> DataFrame:
    """A second way to find the SNPs of reads, which has nothing in common with the bins of the first but its result."""
    return sweep_point_join(intervals, points, keys)


def phase_alignments(alignments: DataFrame, snps: DataFrame, min_quality: int = 20, width: int = WIDTH, join: Callable[..., DataFrame] = point_join) -> DataFrame:
    """Phase of each alignment (id, chrom, start, cigar, seq, qual) from the bases in its aligned blocks.

    A base counts from ``min_quality`` on, or if the read does not have a quality for each base (``*``).  An aligned base beyond the sequence is an error.
    Alignments without a vote are unphased.  ``join`` finds the SNPs between a read's first and last aligned base: a read is one row there, and its blocks are looked up for the SNPs found.
    """
    reads = alignments.withColumn("lengths", cigar_lengths("cigar")).select("id", "chrom", F.col("start").cast("long").alias("start"), (F.col("start").cast("long") + F.col("lengths.reference")).alias("end"), "cigar", "seq", "qual")
    hits = join(reads, snps, ["chrom"], width=width)
    hits = hits.withColumn("at", query_index("l_cigar", (F.col("r_pos") - F.col("l_start")).cast("long"))).where(F.col("at").isNotNull())
    at = F.col("at")
    at = F.when(at < F.length("l_seq"), at).otherwise(F.raise_error(F.concat(F.lit("the CIGAR goes beyond the sequence of "), F.col("l_id").cast("string"))).cast("int"))
    good = (F.length("l_qual") != F.length("l_seq")) | (quality_at(F.col("l_qual"), at) >= min_quality)
    seen = hits.where(good).select(F.col("l_id").alias("id"), base_at(F.col("l_seq"), at).alias("base"), F.col("r_a0").alias("a0"), F.col("r_a1").alias("a1"))
    zero = F.lit(0).cast("long")
    return alignments.join(votes(seen, ["id"]), "id", "left").select(*alignments.columns, *[F.coalesce(c, zero).alias(c) for c in ("n0", "n1", "other")], F.coalesce("phase", F.lit(".")).alias("phase"))


def annotated(alignments: DataFrame, snps: DataFrame, min_mapq: int = 20, min_quality: int = 20, join: Callable[..., DataFrame] = point_join) -> DataFrame:
    """One row of 15 columns per mapped alignment (id, qname, flag, chrom, start, mapq, cigar, seq, qual) that is good enough: place, geometry on the read and SNP votes.

    ``strand`` is that of the DNA strand that was read, so it turns for second reads; ``q_start`` and ``q_end`` count from the read's 5' end.
    """
    good = alignments.where(mapped(min_mapq))
    t = phase_alignments(good, snps, min_quality, join=join).withColumn("lengths", cigar_lengths("cigar"))
    reverse, origin = has_flag(REVERSE), F.when(has_flag(FIRST), "R1").when(has_flag(SECOND), "R2").otherwise(".")
    used, leading, trailing = (F.col(f"lengths.{c}") for c in ("query", "leading", "trailing"))
    begin = F.when(reverse, trailing).otherwise(leading)
    end = leading + used + trailing - F.when(reverse, leading).otherwise(trailing)
    return t.select(
        "qname",
        origin.alias("origin"),
        "flag",
        "chrom",
        "start",
        (F.col("start") + F.col("lengths.reference")).alias("end"),
        F.when(reverse != (origin == "R2"), "-").otherwise("+").alias("strand"),
        "mapq",
        begin.alias("q_start"),
        end.alias("q_end"),
        used.alias("aligned_query_length"),
        "phase",
        F.col("n0").alias("phase0_count"),
        F.col("n1").alias("phase1_count"),
        F.col("other").alias("other_allele_count"),
    )
