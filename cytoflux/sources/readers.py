"""Readers of text formats into flat tables with explicit schemas."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

GTF = "seqname string, source string, feature string, start1 bigint, end1 bigint, score string, strand string, frame string, attributes string"
BED6 = "chrom string, start bigint, end bigint, read_id string, score int, strand string"
BED3 = "chrom string, start bigint, end bigint"


def _lines(spark: SparkSession, path: str, comment: str = "#") -> DataFrame:
    return spark.read.text(path).where((F.trim("value") != "") & ~F.col("value").startswith(comment))


def _field(n: int, kind: str = "string") -> Column:
    return F.element_at(F.split("value", "\t"), n).cast(kind)


def _wide(lines: DataFrame, least: int, what: str) -> DataFrame:
    """Lines with at least ``least`` fields; a shorter one is an error."""
    fine = F.size(F.split("value", "\t")) >= least
    return lines.where(F.when(fine, True).otherwise(F.raise_error(F.lit(f"{what}: a line has fewer than {least} fields")).cast("boolean")))


def read_sam(spark: SparkSession, path: str) -> DataFrame:
    """Alignments of SAM text, header lines left out; optional fields as a map."""
    rows = _wide(_lines(spark, path, "@"), 11, "SAM")
    f = F.split("value", "\t")
    optional = F.slice(f, F.lit(12), F.greatest(F.size(f) - 11, F.lit(0)))
    tags = F.map_from_entries(F.transform(F.filter(optional, lambda x: x.rlike("^..:.:")), lambda x: F.struct(F.substring(x, 1, 2), F.substring(x, F.lit(6), F.length(x)))))
    return rows.select(
        _field(1).alias("qname"),
        _field(2, "int").alias("flag"),
        _field(3).alias("chrom"),
        (_field(4, "bigint") - 1).alias("start"),
        _field(5, "int").alias("mapq"),
        _field(6).alias("cigar"),
        _field(10).alias("seq"),
        _field(11).alias("qual"),
        tags.alias("tags"),
    )


def read_sam_header(spark: SparkSession, path: str) -> DataFrame:
    """Chromosomes and sizes of ``@SQ`` lines."""
    rows = spark.read.text(path).where(F.col("value").startswith("@SQ"))
    return rows.select(F.regexp_extract("value", r"\tSN:([^\t]+)", 1).alias("chrom"), F.regexp_extract("value", r"\tLN:(\d+)", 1).cast("bigint").alias("size"))


def read_bed6(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BED6).csv(path, sep="\t", comment="#")


def read_bed3(spark: SparkSession, path: str) -> DataFrame:
    return _wide(_lines(spark, path), 3, "BED").select(_field(1).alias("chrom"), _field(2, "bigint").alias("start"), _field(3, "bigint").alias("end"))


def read_gtf(spark: SparkSession, path: str) -> DataFrame:
    """GTF rows with a gene id; closed 1-based coordinates stay."""
    t = spark.read.schema(GTF).csv(path, sep="\t", comment="#", quote="")
    attribute = lambda k: F.regexp_extract("attributes", rf'{k} "([^"]+)"', 1)
    t = t.select(F.col("seqname").alias("chrom"), "feature", "start1", "end1", "strand", attribute("gene_id").alias("gene_id"), F.nullif(attribute("gene_name"), F.lit("")).alias("gene_name"))
    return t.where("gene_id <> ''")


def read_pairs(spark: SparkSession, path: str) -> DataFrame:
    """Contacts; columns that a file lacks are null."""
    rows = _wide(_lines(spark, path), 4, "pairs")
    at = lambda n: F.get(F.split("value", "\t"), F.lit(n - 1))
    names = [("read_id", "string"), ("chr1", "string"), ("pos1", "bigint"), ("chr2", "string"), ("pos2", "bigint"), ("strand1", "string"), ("strand2", "string"), ("phase1", "string"), ("phase2", "string")]
    return rows.select(*[at(k).cast(t).alias(n) for k, (n, t) in enumerate(names, 1)])


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """A read per line: name, then items ``chrom!start!end!strand!phase!mapq!n!origin``; the origin is ``R1`` or ``R2`` (``read_num`` 1 or 2), or else 0."""
    f = F.split("value", "\t")

    def item(x: Column) -> Column:
        p = F.split(x, "!")
        at = lambda n: F.element_at(p, n)
        return F.struct(
            at(1).alias("chrom"), at(2).cast("bigint").alias("start"), at(3).cast("bigint").alias("end"), at(4).alias("strand"), at(5).alias("phase"), at(6).cast("int").alias("mapq"), at(7).cast("int").alias("n_hits"), F.when(F.get(p, F.lit(7)) == "R1", 1).when(F.get(p, F.lit(7)) == "R2", 2).otherwise(0).alias("read_num")
        )

    return _lines(spark, path).select(F.element_at(f, 1).alias("qname"), F.transform(F.filter(F.slice(f, F.lit(2), F.size(f)), lambda x: x != ""), item).alias("segs"))


def read_phased_snps(spark: SparkSession, path: str) -> DataFrame:
    """chrom, pos (0-based), a0, a1; alleles of more than one base are left out."""
    rows = _wide(_lines(spark, path), 4, "SNP table")
    t = rows.select(_field(1).alias("chrom"), (_field(2, "bigint") - 1).alias("pos"), F.upper(_field(3)).alias("a0"), F.upper(_field(4)).alias("a1"))
    return t.where((F.length("a0") == 1) & (F.length("a1") == 1))


def ordered_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their place: ``file``, ``block`` (where the split of the file begins) and ``ord``, which grows within a block."""
    t = spark.read.option("lineSep", "\n").text(path)
    return t.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("ord"))


def snp_table_faults(spark: SparkSession, path: str) -> DataFrame:
    """Counts over SNP tables: rows, rows skipped for alleles of more than one base, rows out of order, chromosomes that come in several blocks.

    A row's predecessor is looked up within a split; across splits it comes from a small table of their last rows.
    """
    t = _wide(ordered_lines(spark, path).where((F.trim("value") != "") & ~F.col("value").startswith("#")), 4, "SNP table")
    t = t.select("file", "block", "ord", F.struct(_field(1).alias("chrom"), _field(2, "bigint").alias("pos")).alias("at"), ((F.length(_field(3)) != 1) | (F.length(_field(4)) != 1)).alias("skipped"))
    good = t.where("NOT skipped")
    ends = good.groupBy("file", "block").agg(F.max_by("at", "ord").alias("last"))
    ends = ends.select("file", "block", F.lag("last").over(W.partitionBy("file").orderBy("block")).alias("carried"))
    own = F.lag("at").over(W.partitionBy("file", "block").orderBy("ord"))
    rows = good.withColumn("own", own).join(ends, ["file", "block"]).select("file", "at", F.coalesce("own", "carried").alias("before"))
    opens = F.coalesce(F.col("at.chrom") != F.col("before.chrom"), F.lit(True))
    runs = rows.where(opens).groupBy("file", "at.chrom").agg(F.count("*").alias("n")).agg(F.count_if(F.col("n") > 1).alias("split_chromosomes"))
    unsorted = rows.agg(F.count_if(~opens & (F.col("at.pos") < F.col("before.pos"))).alias("unsorted_rows"))
    return t.agg(F.count("*").alias("rows"), F.count_if("skipped").alias("skipped_rows")).join(unsorted).join(runs)  # one row each


def read_vcf_phased(spark: SparkSession, path: str, indels: bool = False) -> DataFrame:
    """Phased heterozygous variants of the first sample that pass: chrom, pos1, a0, a1."""
    rows = _wide(_lines(spark, path), 10, "VCF").where(_field(7).isin(".", "PASS"))
    alleles = F.split(F.concat_ws(",", _field(4), _field(5)), ",")
    gt = lambda k: F.nullif(F.regexp_extract(_field(10), r"^(\d+)\|(\d+)", k), F.lit("")).try_cast("int")
    t = rows.select(_field(1).alias("chrom"), _field(2, "bigint").alias("pos1"), alleles.alias("alleles"), gt(1).alias("g0"), gt(2).alias("g1")).where("g0 <> g1")
    t = t.select("chrom", "pos1", F.get("alleles", F.col("g0")).alias("a0"), F.get("alleles", F.col("g1")).alias("a1"))
    return t if indels else t.where((F.length("a0") == 1) & (F.length("a1") == 1))


def read_con(spark: SparkSession, path: str) -> DataFrame:
    """Contacts as two legs ``chr,pos,phase``."""
    leg = lambda k, n: F.element_at(F.split(_field(k), ","), n)
    return _lines(spark, path).select(
        leg(1, 1).alias("chr1"), leg(1, 2).cast("bigint").alias("pos1"), leg(2, 1).alias("chr2"), leg(2, 2).cast("bigint").alias("pos2"), leg(1, 3).alias("phase1"), leg(2, 3).alias("phase2")
    )


def read_particles(spark: SparkSession, path: str) -> DataFrame:
    """Particles of structures; the file is the structure."""
    rows = _wide(_lines(spark, path), 5, "3dg")
    return rows.select(F.input_file_name().alias("structure"), _field(1).alias("chrom"), _field(2, "bigint").alias("pos"), *[_field(k, "double").alias(n) for k, n in ((3, "x"), (4, "y"), (5, "z"))])


def read_fai(spark: SparkSession, path: str) -> DataFrame:
    return _lines(spark, path).select(_field(1).alias("chrom"), _field(2, "bigint").alias("size"))


def read_matrix(spark: SparkSession, path: str, cells: list[str]) -> DataFrame:
    """A wide matrix (gene and a column per cell, in cohort order) as gene, cell, n; another header is an error."""
    t = spark.read.csv(path, sep="\t", header=True, schema=", ".join(["gene string", *[f"`{c}` double" for c in cells]]), enforceSchema=False)
    return t.unpivot("gene", cells, "cell", "n")


def read_stat(spark: SparkSession, path: str, names: str = "path string, n bigint") -> DataFrame:
    return spark.read.schema(names).csv(path, sep="\t")


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """Sequences as lines with their place: name, ord, line, start (bases before the line).

    Lines are numbered within a split of the file; what a split carries over from the ones before it (the open record's name, lines and bases) comes from a
    small table of splits.
    """
    t = ordered_lines(spark, path).withColumn("value", F.rtrim("value"))
    head = F.col("value").startswith(">")
    along = W.partitionBy("file", "block").orderBy("ord")
    here = along.rowsBetween(W.unboundedPreceding, W.currentRow)
    t = t.where("value <> ''").withColumn("name", F.when(head, F.regexp_extract("value", r"^>\s*(\S*)", 1))).withColumn("record", F.count("name").over(here))
    splits = t.groupBy("file", "block").agg(F.max("record").alias("records"), F.max_by("name", F.when(head, F.col("ord"))).alias("open_name"))
    after = t.join(splits, ["file", "block"]).where((F.col("record") == F.col("records")) & ~head).groupBy("file", "block").agg(F.count("*").alias("lines"), F.sum(F.length("value")).alias("bases"))
    splits = splits.join(after, ["file", "block"], "left").na.fill(0, ["lines", "bases"])
    by_split = W.partitionBy("file").orderBy("block")
    splits = splits.withColumn("run", F.count_if(F.col("records") > 0).over(by_split.rowsBetween(W.unboundedPreceding, W.currentRow)))
    in_run = W.partitionBy("file", "run").orderBy("block").rowsBetween(W.unboundedPreceding, W.currentRow)
    splits = splits.withColumn("all_lines", F.sum("lines").over(in_run)).withColumn("all_bases", F.sum("bases").over(in_run))
    carried = [F.lag(c).over(by_split).alias(c) for c in ("all_lines", "all_bases")]
    splits = splits.select("file", "block", F.last("open_name", ignorenulls=True).over(by_split.rowsBetween(W.unboundedPreceding, -1)).alias("carried_name"), *carried)
    within = W.partitionBy("file", "block", "record").orderBy("ord")
    t = t.withColumn("own_name", F.last("name", ignorenulls=True).over(here)).where(~head)
    t = t.withColumn("n", F.row_number().over(within) - 1).withColumn("bases", F.coalesce(F.sum(F.length("value")).over(within.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    t = t.join(splits, ["file", "block"])
    more = lambda c: F.when(F.col("record") == 0, F.coalesce(c, F.lit(0))).otherwise(0)
    return t.select(F.coalesce("own_name", "carried_name").alias("name"), (F.col("n") + more("all_lines")).cast("int").alias("ord"), F.col("value").alias("line"), (F.col("bases") + more("all_bases")).alias("start"))


def read_tabfastq(spark: SparkSession, path: str) -> DataFrame:
    """Reads as one line each: read_id, index, seq, qual."""
    return spark.read.schema("read_id string, index string, seq string, qual string").csv(path, sep="\t", quote="")


def first_records(spark: SparkSession, path: str) -> DataFrame:
    """The SHA-256 of the first FASTQ record of each file, its four lines with their line ends; a bad record is an error.

    Only the first split of a file is ranked.  A file without a line gives no row.
    """
    t = ordered_lines(spark, path).where("block = 0")
    t = t.withColumn("k", F.row_number().over(W.partitionBy("file").orderBy("ord"))).where("k <= 4")
    t = t.groupBy("file").agg(F.transform(F.sort_array(F.collect_list(F.struct("k", "value"))), lambda x: x["value"]).alias("l"))
    bare = lambda k: F.regexp_replace(F.get("l", F.lit(k)), "\r$", "")
    fault = (
        F.when(F.size("l") < 4, "truncated first record")
        .when(~F.get("l", F.lit(0)).startswith("@") | ~F.get("l", F.lit(2)).startswith("+"), "invalid first record")
        .when(bare(1) == "", "empty sequence in the first record")
        .when(F.length(bare(1)) != F.length(bare(3)), "sequence and quality of the first record differ in length")
    )
    digest = F.sha2(F.concat(F.array_join("l", "\n"), F.lit("\n")).cast("binary"), 256)
    return t.select("file", F.when(fault.isNotNull(), F.raise_error(F.concat(fault, F.lit(": "), F.col("file"))).cast("string")).otherwise(digest).alias("sha256"))


def read_contract(spark: SparkSession, path: str, version: int, digest: str = "contract_sha256") -> DataFrame:
    """Samples (sample_name, safe_code, ord) of a cohort's contract, a JSON document with ``schema_version``, its own checksum and ``samples``.

    The checksum is that of the document without it, with sorted keys and no blanks.  Another version, another checksum, no sample, names out of order or
    repeated, and bad or repeated codes are errors.
    """
    text = spark.read.text(path, wholetext=True).first()
    contract = json.loads(text["value"]) if text else {}
    core = {k: v for k, v in contract.items() if k != digest}
    found = hashlib.sha256(json.dumps(core, sort_keys=True, separators=(",", ":")).encode()).hexdigest()
    samples = contract.get("samples") or []
    names, codes = [s.get("sample_name") for s in samples], [s.get("safe_code") for s in samples]
    for fault, what in (
        (contract.get("schema_version") != version, "an unknown version"),
        (contract.get(digest) != found, "a wrong checksum"),
        (not samples, "no samples"),
        (not all(isinstance(n, str) for n in names) or names != sorted(set(names)), "names that are out of order or repeated"),
        (len(set(codes)) < len(codes) or not all(isinstance(c, str) and len(c) == 17 and c[0] == "C" and set(c[1:]) <= set("0123456789abcdef") for c in codes), "bad or repeated codes"),
    ):
        if fault:
            raise ValueError(f"the contract {path} has {what}")
    return spark.createDataFrame([(n, c, k) for k, (n, c) in enumerate(zip(names, codes, strict=True))], "sample_name string, safe_code string, ord int")


def read_log_values(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """The first number that ``pattern`` captures on each matching line, and the file."""
    t = spark.read.text(path).where(F.col("value").rlike(pattern))
    return t.select(F.input_file_name().alias("file"), F.regexp_extract("value", pattern, 1).try_cast("double").alias("value"))


def record_count(spark: SparkSession, path: str) -> DataFrame:
    return _lines(spark, path).agg(F.count("*").alias("n"))


def read_fastq(spark: SparkSession, path: str) -> DataFrame:
    """Records of FASTQ text (also compressed), wherever Spark reads: file, ord, read_id, comment, seq, qual.

    Lines are numbered within a split, and splits by a small table of their lines, so a record may lie across a border.  A truncated record, one without ``@`` and ``+``, or one whose
    sequence and quality differ in length is an error.
    """
    t = ordered_lines(spark, path).withColumn("n", F.row_number().over(W.partitionBy("file", "block").orderBy("ord")) - 1)
    sizes = t.groupBy("file", "block").agg(F.count("*").alias("lines"))
    before = sizes.select("file", "block", F.coalesce(F.sum("lines").over(W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    t = t.join(before, ["file", "block"]).withColumn("n", F.col("n") + F.col("before"))
    line = F.struct((F.col("n") % 4).alias("k"), F.regexp_replace("value", "\r$", "").alias("value"))
    r = t.groupBy("file", F.floor(F.col("n") / 4).alias("ord")).agg(F.transform(F.sort_array(F.collect_list(line)), lambda x: x["value"]).alias("l"))
    at = lambda k: F.get("l", F.lit(k))
    fault = F.when(F.size("l") < 4, "truncated record in ").when(~at(0).startswith("@") | ~at(2).startswith("+") | (F.length(at(1)) != F.length(at(3))), "malformed record in ")
    name = F.regexp_extract(at(0), r"^@(\S*)\s*(.*)$", 1)
    return r.select("file", "ord", F.when(fault.isNotNull(), F.raise_error(F.concat(fault, F.col("file"))).cast("string")).otherwise(name).alias("read_id"), F.regexp_extract(at(0), r"^@(\S*)\s*(.*)$", 2).alias("comment"), at(1).alias("seq"), at(3).alias("qual"))
