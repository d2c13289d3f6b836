"""Fragments: selection of one alignment per read, phase fallback, endpoint de-duplication, complexity, insertions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.alignment import cigar_ops, query_length
from .intervals import first_of_islands, union_components

#: FLAG bits of an alignment (fixed values of the SAM format).
UNMAPPED, REVERSE, FIRST, SECOND, SECONDARY, DUPLICATE, SUPPLEMENTARY = 0x4, 0x10, 0x40, 0x80, 0x100, 0x400, 0x800


def has_flag(bit: int, flag: str = "flag") -> Column:
    return F.col(flag).bitwiseAND(F.lit(bit)) != 0


def mapped(min_mapq: int, flag: str = "flag", mapq: str = "mapq") -> Column:
    return ~has_flag(UNMAPPED, flag) & (F.col(mapq) >= min_mapq)


def proper_primary(min_mapq: int = 30) -> Column:
    """Mapped in a proper pair, primary, no duplicate or failed read, at least ``min_mapq``."""
    return (F.col("flag").bitwiseAND(F.lit(1804)) == 0) & has_flag(0x2) & (F.col("mapq") >= min_mapq)


def candidate_order(length: str = "aligned_length", ties: tuple[str, ...] = ()) -> list[Column]:
    """Least clipped 5' end first, primary before supplementary, then quality, aligned bases of the read, place."""
    return [F.col("q_start"), has_flag(SUPPLEMENTARY).cast("int"), F.col("mapq").desc(), F.col(length).desc(), F.col("chrom"), F.col("start"), F.col("end"), F.col("strand"), F.col("flag"), *[F.col(c) for c in ties]]


def select_best(alignments: DataFrame, origin: str = "R2", ties: tuple[str, ...] = ()) -> DataFrame:
    """The first non-secondary alignment of ``origin`` for each qname.

    ``aligned_length`` is the number of the read's bases in aligned and inserted blocks; see ``with_aligned_length``.
    """
    own = alignments.where((F.col("origin") == origin) & ~has_flag(SECONDARY))
    w = W.partitionBy("qname").orderBy(*candidate_order(ties=ties))
    return own.withColumn("rank", F.row_number().over(w)).where("rank = 1").drop("rank")


def with_aligned_length(alignments: DataFrame, cigar: str = "cigar") -> DataFrame:
    return alignments.withColumn("aligned_length", query_length(cigar_ops(F.col(cigar))).cast("long"))


def unclipped(selected: DataFrame) -> DataFrame:
    return selected.where(F.col("q_start") == 0)


def with_fallback_phase(selected: DataFrame, alignments: DataFrame, ties: tuple[str, ...] = ()) -> DataFrame:
    """Phase of the selected alignment, else of the first phased R1, with conflict flags.

    ``phase`` is 0, 1 or ``.``.  Secondary alignments of R1 say nothing.  ``r1_conflict``: phased R1 alignments disagree; ``conflict``: R1 and R2
    disagree.
    """
    r1 = alignments.where((F.col("origin") == "R1") & ~has_flag(SECONDARY) & (F.col("phase") != "."))
    rank = F.row_number().over(W.partitionBy("qname").orderBy(*candidate_order(ties=ties)))
    summary = r1.withColumn("rank", rank).groupBy("qname").agg(F.max(F.when(F.col("rank") == 1, F.col("phase"))).alias("r1_phase"), F.count("*").alias("r1_informative"), (F.min("phase") != F.max("phase")).alias("r1_conflict"))
    own = F.when(F.col("phase") != ".", F.col("phase"))
    return selected.join(summary, "qname", "left").select(
        *selected.columns,
        F.coalesce(own, "r1_phase", F.lit(".")).alias("final_phase"),
        F.when(own.isNotNull(), "R2").when(F.col("r1_phase").isNotNull(), "R1").otherwise("unphased").alias("phase_source"),
        F.coalesce("r1_informative", F.lit(0)).alias("r1_informative"),
        F.coalesce("r1_conflict", F.lit(False)).alias("r1_conflict"),
        F.coalesce(own != F.col("r1_phase"), F.lit(False)).alias("conflict"),
    )


def five_prime() -> Column:
    return F.when(F.col("strand") == "+", F.col("start")).otherwise(F.col("end") - 1)


def other_end() -> Column:
    return F.when(F.col("strand") == "-", F.col("start")).otherwise(F.col("end") - 1)


def dedup_endpoints(fragments: DataFrame, keys: list[str], order: list[str], gap: int = 1, both_ends: bool = True) -> DataFrame:
    """Keep the first fragment of each island of 5' ends, then of each island of the other ends among what is left.

    The passes do not commute.  Ties of the second pass follow the order of the first.
    """
    once = first_of_islands(fragments, keys, five_prime(), order, gap)
    if not both_ends:
        return once.drop("pos")
    once = once.withColumnRenamed("pos", "pos1")
    return first_of_islands(once, keys, other_end(), ["pos1", *order], gap).drop("pos", "pos1")


def point_clusters(fragments: DataFrame, keys: list[str], distance: int, order: list[str]) -> DataFrame:
    """Append ``point`` (the start of a forward fragment, the end of a reverse one) and ``component``: clusters of such points, each a base long, with at most
    ``distance`` bases between neighbours."""
    points = fragments.withColumn("point", F.when(F.col("strand") == "+", F.col("start")).otherwise(F.col("end"))).withColumn("point_end", F.col("point") + 1)
    return union_components(points, keys, order, distance, "point", "point_end").drop("point_end")


def best_of_clusters(clustered: DataFrame, keys: list[str], best: list[Column]) -> DataFrame:
    """The first row of each cluster by ``best``."""
    w = W.partitionBy(*keys, "component").orderBy(*best)
    return clustered.withColumn("rank", F.row_number().over(w)).where("rank = 1").drop("rank", "component")


def extended_points(clustered: DataFrame, extension: int = 75) -> DataFrame:
    """Points as fragments of ``extension`` bases on both sides."""
    return clustered.withColumn("start", F.col("point") - extension).withColumn("end", F.col("point") + 1 + extension).drop("point")


def duplication_rate(raw: DataFrame, kept: DataFrame, key: str) -> DataFrame:
    """Per ``key``: rows before and after, and 1 - after / before (null without rows before)."""
    a, b = raw.groupBy(key).agg(F.count("*").alias("raw")), kept.groupBy(key).agg(F.count("*").alias("kept"))
    n = F.coalesce("kept", F.lit(0))
    return a.join(b, key, "left").select(key, "raw", n.alias("kept"), (1 - F.try_divide(n, F.col("raw"))).alias("rate"))


def combined_rate(*rates: Column) -> Column:
    """Duplication over consecutive stages."""
    return 1 - reduce(lambda a, b: a * b, [1 - r for r in rates])


def cohort_fragments(fragments: DataFrame) -> DataFrame:
    """Distinct (chrom, start, end, cell, 1); sort with ``sources.writers.write_sorted`` when written."""
    return fragments.select("chrom", "start", "end", "cell", F.lit(1).alias("n")).distinct()


def library_complexity(fragments: DataFrame, key: list[str]) -> DataFrame:
    """Total and distinct fragments, singletons, doubletons, NRF, PBC1, PBC2 (-1 without doubletons)."""
    each = fragments.groupBy(*key).agg(F.count("*").alias("n"))
    sums = each.agg(F.sum("n").alias("total"), F.count("*").alias("distinct"), F.count_if(F.col("n") == 1).alias("singletons"), F.count_if(F.col("n") == 2).alias("doubletons"))
    pbc2 = F.when(F.col("doubletons") > 0, F.col("singletons") / F.col("doubletons")).otherwise(F.lit(-1.0))
    return sums.select("*", F.try_divide("distinct", "total").alias("nrf"), F.try_divide("singletons", "distinct").alias("pbc1"), pbc2.alias("pbc2"))


def insertion_sites(fragments: DataFrame, forward: int = 4, reverse: int = -5, extension: int = 0) -> DataFrame:
    """The shifted insertion of each fragment's 5' end, widened by ``extension`` on both sides."""
    site = F.when(F.col("strand") == "+", F.col("start") + forward).otherwise(F.col("end") + reverse)
    return fragments.withColumn("site", site).withColumn("start", F.greatest(F.col("site") - extension, F.lit(0))).withColumn("end", F.col("site") + 1 + extension)


def cut_sites(fragments: DataFrame) -> DataFrame:
    """Both cut ends of each fragment, its first and its last base, as ``site``."""
    return fragments.withColumn("site", F.explode(F.array(F.col("start"), F.col("end") - 1)))


def mark_duplicates(alignments: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """Append ``duplicate``: true for all but the first of equal coordinates."""
    return alignments.withColumn("duplicate", F.row_number().over(W.partitionBy(*key).orderBy(*order)) > 1)


def insert_sizes(alignments: DataFrame, length: Column) -> DataFrame:
    return alignments.groupBy(F.abs(length).alias("insert_size")).agg(F.count("*").alias("n"))


def selection_counters(alignments: DataFrame, keys: list[str], min_mapq: int, ties: tuple[str, ...] = ()) -> DataFrame:
    """Twelve counters of the selection of fragments per ``keys``, from all alignments of all reads; a read belongs to one key.

    Reads; those with a good alignment, and these alignments; those with a good R2 that is not secondary; selected R2, clipped and written ones; written
    ones by where their phase is from; conflicts within R1 and between R1 and R2.
    """
    is_good = mapped(min_mapq)
    reads = alignments.groupBy(*keys, "qname").agg(F.count_if(is_good).alias("good"), F.count_if(is_good & (F.col("origin") == "R2") & ~has_flag(SECONDARY)).alias("good_r2"))
    first = reads.groupBy(*keys).agg(F.count("*").alias("reads"), F.count_if(F.col("good") > 0).alias("reads_with_good"), F.sum("good").alias("good_alignments"), F.count_if(F.col("good_r2") > 0).alias("reads_with_good_r2"))
    good = alignments.where(is_good)
    chosen = with_fallback_phase(select_best(good, ties=ties), good, ties)
    written = F.col("q_start") == 0
    source = lambda s: F.count_if(written & (F.col("phase_source") == s))
    rest = chosen.groupBy(*keys).agg(
        F.count("*").alias("selected"),
        F.count_if(~written).alias("clipped"),
        F.count_if(written).alias("written"),
        source("R2").alias("phased_by_r2"),
        source("R1").alias("phased_by_r1"),
        source("unphased").alias("unphased"),
        F.count_if(written & F.col("r1_conflict")).alias("r1_conflicts"),
        F.count_if(written & F.col("conflict")).alias("r1_r2_conflicts"),
    )
    t = first.join(rest, keys, "left")
    return t.na.fill(0, [c for c in rest.columns if c not in keys])


def dedup_reads(bed: DataFrame, split_pool: bool = False, gap: int = 1, min_score: int = 0, both_ends: bool = True, order: tuple[str, ...] = ("read_id", "start", "end")) -> DataFrame:
    """BED rows (chrom, start, end, read_id, score, strand) without duplicates; then those with a score above ``min_score``.

    The score is looked at last, so a bad row can stand for a better one of its island.  A split pool has ``<read>_<cell>`` as read id: cells are kept apart, and reads
    of the cell ``unmatched`` go first.
    """
    keys = ["chrom"]
    if split_pool:
        part = F.split("read_id", "_")
        bed = bed.withColumn("cell", F.get(part, F.lit(1))).withColumn("read_id", F.get(part, F.lit(0))).where("cell <> 'unmatched'")
        keys = ["cell", "chrom"]
    return dedup_endpoints(bed, keys, list(order), gap, both_ends).where(F.col("score") > min_score)


def without_chromosomes(rows: DataFrame, containing: tuple[str, ...] = ("chrM", "GL", "NC", "chrhs37d5"), chrom: str = "chrom") -> DataFrame:
    """Rows whose chromosome has none of these in its name: the mitochondrion, scaffolds and decoys (fixed values)."""
    return rows.where(reduce(lambda a, b: a & b, [~F.col(chrom).contains(x) for x in containing]))


def reads_by_id(reads: DataFrame, wanted: DataFrame, key: str = "read_id") -> DataFrame:
    """A row per wanted id and read of it; an id without a read gives a row of nulls."""
    return wanted.select(key).join(reads, key, "left")
