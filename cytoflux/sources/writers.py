"""Writers: sorted fragments, matrices, pairs, headers of empty outputs, order-free digests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import written

#: The most folders of chromosome and bin.
FOLDERS = 4096


def write_sorted(fragments: DataFrame, path: str, partitions: int | None = None, keys: tuple[str, ...] = ("chrom", "start", "end", "cell")) -> None:
    """Range-partitioned and sorted Parquet, so scans of a place read few row groups."""
    ranged = fragments.repartitionByRange(partitions, *keys) if partitions else fragments.repartitionByRange(*keys)
    ranged.sortWithinPartitions(*keys).write.mode("overwrite").parquet(path)


def write_tsv(df: DataFrame, path: str, header: bool = True, missing: str = "NA") -> None:
    df.write.mode("overwrite").csv(path, sep="\t", header=header, nullValue=missing, compression="gzip")


def write_by_chromosome(df: DataFrame, path: str, key: str = "chrom") -> None:
    """A partition folder per chromosome, sorted by position."""
    df.repartition(key).sortWithinPartitions(key, "pos").write.mode("overwrite").partitionBy(key).parquet(path)


def digest(df: DataFrame) -> DataFrame:
    """Rows and a digest that does not depend on their order: exclusive or and sum of row hashes."""
    h = F.xxhash64(*df.columns)
    return df.agg(F.count("*").alias("rows"), F.bit_xor(h).alias("hash_xor"), F.sum(h.cast("decimal(20,0)")).alias("hash_sum"))


def without_tags(alignments: DataFrame, names: tuple[str, ...] = ("XS", "XN", "XT")) -> DataFrame:
    return alignments.withColumn("tags", F.map_filter("tags", lambda k, v: ~k.isin(*names)))


def pairs_lines(pairs: DataFrame) -> DataFrame:
    """Contacts as tab-separated lines."""
    names = ["read_id", "chr1", "pos1", "chr2", "pos2", "strand1", "strand2", "phase1", "phase2"]
    return pairs.select(F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit(".")) for c in names if c in pairs.columns]).alias("value"))


def ncc_lines(pairs: DataFrame, least: float = 0.75) -> DataFrame:
    """Contacts as NCC lines (blank-separated); contacts with a phase probability below ``least`` are left out."""
    p = F.greatest("p00", "p01", "p10", "p11")
    leg = lambda k: [F.col(f"chr{k}"), F.col(f"pos{k}"), F.col(f"pos{k}"), F.col(f"pos{k}"), F.col(f"pos{k}"), F.col(f"strand{k}")]
    return pairs.where(p >= least).select(F.concat_ws(" ", *[c.cast("string") for c in [*leg(1), *leg(2)]]).alias("value"))


def empty_like(df: DataFrame) -> DataFrame:
    """No rows with the same schema: a valid empty output."""
    return df.where(F.lit(False))


def pairs_header(sizes: DataFrame) -> DataFrame:
    """``#chromosome:`` lines."""
    return sizes.select(F.concat_ws(" ", F.lit("#chromosome:"), "chrom", F.col("size").cast("string")).alias("value"))


#: The layout of a SNP index (fixed value).
SNP_INDEX_VERSION = "1"


def snp_manifest(snps: DataFrame, skipped_rows: int = 0) -> DataFrame:
    """One row per chromosome of a SNP index: its folder, number of SNPs, first and last place, and a digest of its rows that does not depend on their order."""
    h = F.xxhash64("pos", "a0", "a1")
    each = snps.groupBy("chrom").agg(F.count("*").alias("count"), F.min("pos").alias("first_pos"), F.max("pos").alias("last_pos"), F.hex(F.bit_xor(h)).alias("digest"))
    return each.select(F.lit(SNP_INDEX_VERSION).alias("index_version"), "chrom", F.concat(F.lit("chrom="), F.col("chrom").cast("string")).alias("folder"), "count", "first_pos", "last_pos", "digest", F.lit(skipped_rows).alias("source_skipped_rows"))


def write_snp_index(snps: DataFrame, path: str, skipped_rows: int = 0) -> None:
    """A folder per chromosome below ``path``/snps, sorted by place, and then the manifest, which a reader needs; see ``read_snp_index``."""
    write_by_chromosome(snps, f"{path}/snps")
    snp_manifest(snps, skipped_rows).coalesce(1).write.mode("overwrite").json(f"{path}/manifest")  # a row per chromosome


def read_snp_index(spark: SparkSession, path: str) -> DataFrame:
    """The SNPs of an index whose manifest fits them; another version, or a chromosome with other rows than the manifest has, is an error."""
    told = spark.read.json(f"{path}/manifest")
    snps = spark.read.parquet(f"{path}/snps").select(F.col("chrom").cast("string").alias("chrom"), "pos", "a0", "a1")
    found = snp_manifest(snps)
    both = told.select("chrom", *[F.col(c).alias(f"{c}_told") for c in ("index_version", "count", "digest")]).join(found, "chrom", "full")
    same = F.col("index_version_told").eqNullSafe(F.lit(SNP_INDEX_VERSION)) & F.col("count").eqNullSafe(F.col("count_told")) & F.col("digest").eqNullSafe(F.col("digest_told"))
    bad = [r["chrom"] for r in both.where(~same).select("chrom").limit(10).collect()]
    if bad or told.isEmpty():
        raise ValueError(f"the SNP index {path} does not fit its manifest: {', '.join(map(str, bad)) or 'it is empty'}")
    return snps


def write_regions(fragments: DataFrame, path: str, width: int = 1_000_000) -> None:
    """Fragments (chrom, start, end, ...) in a folder per chromosome and bin of their starts, sorted, and the greatest length on each chromosome; see ``read_region``.

    If there are more than ``FOLDERS`` such folders, bins are twice, four times ... as wide: a folder costs more than its rows if these are few.
    """
    each = written(fragments.groupBy("chrom", F.floor(F.col("start") / width).alias("bin")).agg(F.max(F.col("end") - F.col("start")).alias("longest")), "bins")
    folders, times = each.count(), 1
    reach = each.agg(F.max(F.abs("bin"))).first()[0] or 0
    while folders > FOLDERS and times <= reach:  # beyond, a chromosome has one bin, or two around 0
        times *= 2
        folders = each.select("chrom", F.floor(F.col("bin") / times).alias("bin")).distinct().count()
    placed = fragments.withColumn("bin", F.floor(F.col("start") / (width * times)))
    placed.repartition("chrom", "bin").sortWithinPartitions("chrom", "bin", "start", "end").write.mode("overwrite").partitionBy("chrom", "bin").parquet(f"{path}/fragments")
    longest = each.groupBy("chrom").agg(F.max("longest").alias("longest"))
    longest.withColumn("width", F.lit(width * times)).coalesce(1).write.mode("overwrite").parquet(f"{path}/lengths")  # a row per chromosome


def read_region(spark: SparkSession, path: str, chrom: object, start: int, end: int) -> DataFrame:
    """The fragments that overlap [start, end) of a chromosome.

    Only bins where such a fragment can begin are opened: from the greatest length before ``start`` on up to ``end``.
    """
    t = spark.read.parquet(f"{path}/fragments")
    told = spark.read.parquet(f"{path}/lengths").where(F.col("chrom") == F.lit(chrom)).first()
    if told is None:
        return t.where(F.lit(False)).drop("bin")
    first, last = (start - told["longest"] + 1) // told["width"], (end - 1) // told["width"]
    here = (F.col("chrom") == F.lit(chrom)) & F.col("bin").between(first, last)
    return t.where(here & (F.col("start") < end) & (F.col("end") > start)).drop("bin")
