"""RNA: read-to-gene assignment, R1/R2 gene compatibility, UMI counting, matrices."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.scratch import written
from .graph import components
from .intervals import overlap_join, union_components
from .umis import PIECE, between_pieces, within_pieces

CLASSES = ("r1_uninformative", "r2_uninformative", "r2_genome_only", "concordant", "incompatible")


def confident_unique(min_mapq: int) -> Column:
    """Mapped, primary, not supplementary, good enough, and reported once (``nh`` is there and 1)."""
    return (F.col("flag").bitwiseAND(F.lit(0x4 | 0x100 | 0x800)) == 0) & (F.col("mapq") >= min_mapq) & F.coalesce(F.col("nh") == 1, F.lit(False))


def assigned_genes(status: Column, genes: Column) -> Column:
    """The gene names of an assigned read; empty for any other status."""
    names = F.filter(F.split(F.coalesce(genes, F.lit("")), ","), lambda g: g != "")
    return F.when(F.coalesce(status == "Assigned", F.lit(False)), names).otherwise(F.array().cast("array<string>"))


def gene_spans(gtf: DataFrame) -> DataFrame:
    """Least start and greatest end of each (chrom, gene_id) over all rows with a gene id; closed coordinates."""
    return gtf.where(F.col("gene_id").isNotNull() & (F.col("gene_id").cast("string") != "")).groupBy("chrom", "gene_id").agg(F.min("start1").alias("start1"), F.max("end1").alias("end1"))


def gene_components(spans: DataFrame) -> DataFrame:
    """Genes whose closed spans overlap share a token ``chrom:n``; a gene has one per chromosome."""
    c = union_components(spans, ["chrom"], ["end1", "gene_id"], 0, "start1", "end1")
    return c.groupBy("gene_id").agg(F.sort_array(F.collect_set(F.concat_ws(":", "chrom", "component"))).alias("tokens"))


def assign_features(reads: DataFrame, features: DataFrame, ids: list[str], stranded: bool = True) -> DataFrame:
    """Sorted gene names that each read overlaps, comma-joined; reads without one are left out."""
    hits = overlap_join(reads, features, ["chrom", "strand"] if stranded else ["chrom"])
    return hits.groupBy(*[F.col(f"l_{c}").alias(c) for c in ids]).agg(F.array_join(F.sort_array(F.collect_set("r_gene")), ",").alias("genes"))


def compatibility() -> Column:
    """The class of a read pair from g1, g2 (gene arrays), t1, t2 (component tokens) and r2_mapped, which is looked at where R2 has no gene."""
    shared = F.arrays_overlap("g1", "g2") | F.arrays_overlap("t1", "t2")
    return (
        F.when(F.size("g1") == 0, CLASSES[0])
        .when(F.size("g2") == 0, F.when(F.coalesce("r2_mapped", F.lit(False)), CLASSES[2]).otherwise(CLASSES[1]))
        .when(shared, CLASSES[3])
        .otherwise(CLASSES[4])
    )


def compatibility_counts(classified: DataFrame, cell: str = "cell", category: str = "category") -> DataFrame:
    """Counts of the classes per cell and, under ``ALL``, in total, with shares that are null where there is nothing to share."""
    counts = [F.count_if(F.col(category) == c).alias(c) for c in CLASSES]
    t = _with_total(classified.groupBy(cell).agg(F.count("*").alias("pairs"), *counts), cell)
    name = F.when(F.col("whole") == 1, "ALL").otherwise(F.col(cell).cast("string"))
    kept = F.col("pairs") - F.col("r2_genome_only") - F.col("incompatible")
    return t.select(name.alias("cell"), "pairs", *CLASSES, kept.alias("compatible"), F.try_divide(kept, F.col("pairs")).alias("compatible_share"), F.try_divide(F.col("concordant"), F.col("pairs")).alias("concordant_share"))


def _with_total(per_cell: DataFrame, cell: str) -> DataFrame:
    """Sums per cell and, from these, of all cells, with ``whole`` 1."""
    sums = [c for c in per_cell.columns if c != cell]
    t = per_cell.rollup(cell).agg(F.grouping(cell).alias("whole"), *[F.sum(c).alias(c) for c in sums])
    return t.na.fill(0, sums)


def unique_umis(reads: DataFrame, keys: list[str]) -> DataFrame:
    return reads.groupBy(*keys).agg(F.count_distinct("umi").alias("n"))


def directional_umis(reads: DataFrame, keys: list[str], piece: int = PIECE) -> DataFrame:
    """UMIs per group after joining each UMI to one that differs in one base and has at least 2n - 1 of its n reads.

    Clusters are followed outwards from the most frequent UMI.  That leaves one cluster for each UMI of several reads that none is above, and one for each component of UMIs
    of one read (these are above each other) without a UMI above any of them.  Counts per UMI are summed before the shuffle.  UMIs one base apart share their first or their second
    half.  Sorted by group and first half, they are compared in pieces of bounded size; groups that a piece holds whole are done there.  The others' UMIs are dealt by their second
    half, where clusters meet, and what is left are ties of clusters, whose components are found.  UMIs of a half that is too frequent for a piece meet by the UMI with one base left out.
    """
    counts = reads.groupBy(*keys, "umi").agg(F.count("*").alias("reads"))
    counts = written(counts.withColumn("u", F.monotonically_increasing_id()), "umis")
    middle = F.floor(F.length("umi") / 2).cast("int")
    first, second = F.substring(F.col("umi"), F.lit(1), middle), F.substring(F.col("umi"), middle + 1, F.length("umi"))
    types = T.StructType([*counts.select(*keys).schema, *T.StructType.fromDDL("u long, umi string, reads long, below boolean, side int, n long")])
    dealt = counts.withColumn("length", F.length("umi")).repartitionByRange(*keys, "length", first).sortWithinPartitions(*keys, "length", "umi")
    dealt = dealt.select(*keys, "u", "umi", "reads", F.xxhash64(*keys, "length", first).alias("block"))
    found = dealt.mapInArrow(within_pieces(keys, piece), types)
    types = T.StructType([*types[: len(keys) + 1], T.StructField("root", T.LongType()), *types[len(keys) + 1 :]])
    dealt = found.select("*", F.xxhash64(*keys, F.length("umi"), second).alias("block")).repartition("block").sortWithinPartitions("block")
    met = written(dealt.mapInArrow(between_pieces(keys, piece), types), "met")
    large = written(_met_by_masks(met.where("side > 0"), keys, middle), "large")
    # Clusters that were counted but are below another or tied to others: the components of these that none is above count once.
    part = met.where("n IS NULL AND side IS NULL").select(*keys, "u", "root", "below").unionByName(large)
    each = part.groupBy(*keys, "u").agg(F.max("below").alias("below"))
    alone = components(part.where("root <> u").select(F.col("u").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "u")
    tied = each.join(alone, "u", "left").groupBy(*keys, F.coalesce("root", "u").alias("root")).agg(F.max("below").alias("below"))
    parts = [met.where("n IS NOT NULL").select(*keys, "n"), each.select(*keys, F.lit(-1).cast("long").alias("n")), tied.where("NOT below").select(*keys, F.lit(1).cast("long").alias("n"))]
    return reduce(DataFrame.unionByName, parts).groupBy(*keys).agg(F.sum("n").cast("long").alias("n"))


def _met_by_masks(umis: DataFrame, keys: list[str], middle: Column) -> DataFrame:
    """Clusters that are below another or tied to it by UMIs that share their first (``side`` 1) or second half, by the UMI with each base of the other half left out."""
    other = F.when(F.col("side") == 1, F.sequence(middle + 1, F.length("umi"))).otherwise(F.sequence(F.lit(1), middle))
    masked = umis.withColumn("i", F.explode(other)).withColumn("mask", F.concat(F.expr("substring(umi, 1, i - 1)"), F.lit("."), F.expr("substring(umi, i + 1)")))
    met, one = W.partitionBy(*keys, "i", F.length("umi"), "mask", "side"), F.col("reads") == 1
    masked = masked.withColumn("most", F.max("reads").over(met)).withColumn("least", F.min(F.when(one & ~F.col("below"), F.col("u"))).over(met)).withColumn("lost", F.coalesce(F.max(F.when(one, F.col("below"))).over(met), F.lit(False)))
    lower = ((F.col("most") > 1) & (F.col("most") >= 2 * F.col("reads") - 1)) | (one & F.col("lost"))
    masked = masked.where(~F.col("below")).select(*keys, "u", F.when(one, F.col("least")).otherwise(F.col("u")).alias("root"), lower.alias("below"), F.when(one, F.col("least") != F.col("u")).otherwise(False).alias("far"))
    return masked.where("below OR far").drop("far")


def split_multigene(counts: DataFrame, keys: list[str]) -> DataFrame:
    """Counts of comma-joined genes shared out equally among them."""
    names = F.split("gene", ",")
    each = counts.select(*keys, F.explode(names).alias("gene"), (F.col("n") / F.size(names)).alias("n"))
    return each.groupBy(*keys, "gene").agg(F.sum("n").alias("n"))


def wide_matrix(counts: DataFrame, cells: list, row: str = "gene", column: str = "cell", value: str = "n") -> DataFrame:
    """A column per cell of the cohort, in its order, zero where nothing was counted."""
    wide = counts.groupBy(row).pivot(column, cells).agg(F.sum(value))
    return wide.na.fill(0)


def matrix_per_cell(counts: DataFrame, cell: str = "cell") -> DataFrame:
    return counts.groupBy(cell).agg(F.sum("n").alias("umis"), F.count_if(F.col("n") != 0).alias("features"))


def matrix_summary(per_cell: DataFrame) -> DataFrame:
    return per_cell.agg(F.count("*").alias("cells"), F.sum("umis").alias("total"), F.median("umis").alias("median"), F.min("umis").alias("least"), F.max("umis").alias("most"), F.sum("features").alias("cell_features"))


def genome_split(phased: DataFrame) -> DataFrame:
    """Alignments by haplotype: genome1, genome2 or unassigned."""
    return phased.withColumn("genome", F.when(F.col("phase") == "0", "genome1").when(F.col("phase") == "1", "genome2").otherwise("unassigned"))


def first_row(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    return df.withColumn("rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where("rank = 1").drop("rank")


def compatibility_counters(classified: DataFrame, cell: str = "cell", category: str = "category") -> DataFrame:
    """Per cell and under ``ALL``: reads, informative R1, informative R2, well mapped R2 (these overlap), classes, and shares of the informative R1 reads.

    Rows have gene sets ``g1`` and ``g2`` and the flag ``r2_mapped``.  A share without informative reads is null.
    """
    overlapping = [F.count("*").alias("reads"), F.count_if(F.size("g1") > 0).alias("r1_informative"), F.count_if(F.size("g2") > 0).alias("r2_informative"), F.count_if("r2_mapped").alias("r2_well_mapped")]
    t = _with_total(classified.groupBy(cell).agg(*overlapping, *[F.count_if(F.col(category) == c).alias(c) for c in CLASSES]), cell)
    share = lambda c: F.try_divide(F.col(c), F.col("r1_informative")).alias(f"{c}_share")
    name = F.when(F.col("whole") == 1, "ALL").otherwise(F.col(cell).cast("string"))
    kept = F.col("reads") - F.col("r2_genome_only") - F.col("incompatible")
    return t.select(name.alias("cell"), "reads", "r1_informative", "r2_informative", "r2_well_mapped", *CLASSES, kept.alias("r1_compatible"), *[share(c) for c in ("r2_genome_only", "incompatible", "concordant")])
