"""The registered queries over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import names as N
from ..operators import adapters, contacts, fragments, intervals, phasing, qc, rna, structure
from ..sources import writers
from ..streaming import sessions
from . import more
from .fixtures import view
from .oracle import ORACLES

TIES = ("price", "ln", "cell", "base", "phase")
ORDER = ["q", "ln", "price", "start", "end", "cell", "strand"]


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _selected(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = view(spark, sf_dir, "alignments").where(fragments.mapped(10))
    return fragments.unclipped(fragments.select_best(a, ties=TIES))


def fragment_bin_counts(spark, sf_dir):
    """Select, de-duplicate, make distinct and count per 100-base bin and cell."""
    s = _selected(spark, sf_dir).withColumnRenamed("qname", "q")
    kept = fragments.dedup_endpoints(s, ["cell", "chrom"], ORDER)
    return intervals.bin_counts(fragments.cohort_fragments(kept), ["cell", "chrom"], 100).select("cell", "chrom", "bin", "n")


def select_best_per_qname(spark, sf_dir):
    return _selected(spark, sf_dir).select("qname", "chrom", "start", "end", "strand", "mapq", "flag", "price")


def select_with_fallback_phase(spark, sf_dir):
    a = view(spark, sf_dir, "alignments").where(fragments.mapped(10))
    t = fragments.with_fallback_phase(fragments.unclipped(fragments.select_best(a, ties=TIES)), a, TIES)
    return t.select("qname", "chrom", "start", "phase", "final_phase", "phase_source", "r1_informative", "r1_conflict", "conflict")


def fragment_selection_counters(spark, sf_dir):
    a = view(spark, sf_dir, "alignments").where(fragments.mapped(10))
    best = fragments.select_best(a, ties=TIES)
    t = fragments.with_fallback_phase(best, a, TIES)
    keep = F.col("q_start") == 0
    return t.groupBy("cell").agg(
        F.count("*").alias("selected"), F.count_if(~keep).alias("clipped"), F.count_if(keep).alias("written"), F.count_if(keep & (F.col("final_phase") != ".")).alias("phased"), F.count_if(keep & (F.col("phase_source") == "R1")).alias("by_r1"), F.count_if(keep & F.col("conflict")).alias("conflicts")
    )


def _dedup(keys: list[str], both: bool):
    def query(spark, sf_dir):
        f = view(spark, sf_dir, "fragments")
        return fragments.dedup_endpoints(f, keys, ORDER, 1, both).select("chrom", "start", "end", "strand", "cell", "q", "ln", "price")

    return query


def dup_rate_by_cell(spark, sf_dir):
    f = view(spark, sf_dir, "fragments")
    return fragments.duplication_rate(f, fragments.dedup_endpoints(f, ["cell", "chrom"], ORDER), "cell")


def cohort_fragments_distinct_sorted(spark, sf_dir):
    return fragments.cohort_fragments(view(spark, sf_dir, "fragments")).orderBy("chrom", "start", "end", "cell")


def bin_counts_5k(spark, sf_dir):
    f = view(spark, sf_dir, "fragments")
    return intervals.bin_counts(f, ["cell", "chrom"], 5000)


def overlap_join_points(spark, sf_dir):
    hits = intervals.point_join(view(spark, sf_dir, "fragments"), view(spark, sf_dir, "snps"), ["chrom"], width=512)
    return hits.select(F.col("l_chrom").alias("chrom"), F.col("l_q").alias("q"), F.col("l_ln").alias("ln"), F.col("l_start").alias("start"), F.col("r_pos").alias("pos"), F.col("r_a0").alias("a0"))


def overlap_join_intervals(spark, sf_dir):
    """Fragments and shared bases per gene."""
    hits = intervals.overlap_join(view(spark, sf_dir, "fragments").select("chrom", "start", "end"), view(spark, sf_dir, "genes").select("chrom", "gene", "start", "end"), ["chrom"], 512)
    shared = F.least("l_end", "r_end") - F.greatest("l_start", "r_start")
    return hits.groupBy(F.col("r_gene").alias("gene")).agg(F.count("*").alias("n"), F.sum(shared).alias("bases"))


def overlap_anti(spark, sf_dir):
    f = view(spark, sf_dir, "fragments").select("q", "ln", "price", "chrom", "start", "end")
    return intervals.overlap_anti(f, view(spark, sf_dir, "genes"), ["chrom"], ["q", "ln", "price", "chrom", "start", "end"], 512)


def overlap_semi_counts(spark, sf_dir):
    """Fragments in TSS windows and windows hit, per chromosome."""
    t = view(spark, sf_dir, "tss").select("chrom", "pos", (F.col("pos") - 20).alias("start"), (F.col("pos") + 20).alias("end"))
    hits = intervals.overlap_join(view(spark, sf_dir, "fragments").select("q", "ln", "price", "chrom", "start", "end"), t, ["chrom"], 512)
    return hits.groupBy(F.col("l_chrom").alias("chrom")).agg(F.count("*").alias("hits"), F.count_distinct("r_pos").alias("windows"))


def overlap_fraction_filter(spark, sf_dir):
    regions = intervals.merged_intervals(view(spark, sf_dir, "genes").select("chrom", "start", (F.col("end") + 25).alias("end")), ["chrom"])
    f = view(spark, sf_dir, "fragments").select("q", "ln", "price", "chrom", "start", "end").distinct()
    return intervals.covered_fraction_filter(f, regions, ["chrom"], ["q", "ln", "price", "chrom", "start", "end"], 30, 0.5, 512)


def interval_union_components(spark, sf_dir):
    g = view(spark, sf_dir, "genes")
    return intervals.union_components(g, ["chrom"], ["end", "gene"], 0).select("chrom", "gene", "start", "end", "component")


CLUSTER_TIES = ("start", "end", "q", "ln", "price", "strand")


def cluster_best_mapq(spark, sf_dir):
    """Good fragments of wanted chromosomes by clusters of their 5' points: the best of each, widened by 75 bases."""
    f = view(spark, sf_dir, "fragments").where("mapq > 20 AND chrom BETWEEN 1 AND 19")
    c = fragments.point_clusters(f, ["cell", "chrom"], 10, list(CLUSTER_TIES))
    best = fragments.best_of_clusters(c, ["cell", "chrom"], [F.col("mapq").desc(), "point", *[F.col(x) for x in CLUSTER_TIES]])
    return fragments.extended_points(best).select("cell", "chrom", "start", "end", "mapq", "q", "ln", "price")


def cluster_then_filter(spark, sf_dir):
    """Clusters of the 5' points of all fragments first, quality after; distinct reads."""
    c = fragments.point_clusters(view(spark, sf_dir, "fragments"), ["cell", "chrom"], 10, list(CLUSTER_TIES)).where("mapq >= 20")
    return fragments.best_of_clusters(c, ["cell", "chrom"], [F.col("mapq").desc(), "point", *[F.col(x) for x in CLUSTER_TIES]]).select("q").distinct()


def coverage_steps(spark, sf_dir):
    return intervals.coverage_steps(view(spark, sf_dir, "fragments"), ["chrom"], segment_width=4096)


def coverage_cpm(spark, sf_dir):
    """Coverage per million fragments of its chromosome."""
    f = view(spark, sf_dir, "fragments")
    n = f.groupBy("chrom").agg(F.count("*").alias("n"))
    t = intervals.coverage_steps(f, ["chrom"], segment_width=4096).join(n, "chrom")
    return t.select("chrom", "start", "end", F.round(F.col("depth") * 1e6 / F.col("n"), 6).alias("cpm"))


def binned_rpkm(spark, sf_dir):
    f = view(spark, sf_dir, "fragments")
    n = f.groupBy("cell").agg(F.count("*").alias("total"))
    t = intervals.bin_counts(f, ["cell", "chrom"], 100).join(n, "cell")
    return t.select("cell", "chrom", "bin", F.round(F.col("n") * 1e9 / (F.col("total") * 100), 6).alias("rpkm"))


def snp_vote_phase(spark, sf_dir):
    ids = ["qname", "ln", "price", "chrom", "start", "end"]
    a = view(spark, sf_dir, "alignments").select(*ids, "base").distinct()
    return phasing.snp_votes(a, view(spark, sf_dir, "snps"), [*ids, "base"])


def _records(spark, sf_dir, dealt=None):
    """Records of the test tables with CIGAR, sequence and qualities; rows that are equal in all count once.

    ``dealt`` is a column by which they are dealt and sorted to be made distinct, so that a later join by it neither shuffles nor sorts them.
    """
    t = view(spark, sf_dir, "records")
    if dealt:
        same = W.partitionBy(dealt, *[c for c in t.columns if c != dealt]).orderBy(dealt)
        t = t.repartition(dealt).withColumn("copy", F.lag(F.lit(True)).over(same)).where("copy IS NULL").drop("copy")
    else:
        t = t.distinct()
    n = lambda c, op: F.concat(F.col(c).cast("string"), F.lit(op))
    rest = (F.col("mapq") + 5 - F.col("del")).cast("string")
    length = F.col("clip") + 35 + F.col("ins") + F.col("mapq") + 5 - F.col("del")
    cigar = F.concat(F.when(F.col("clip") > 0, n("clip", "S")).otherwise(""), F.lit("20M"), n("ins", "I"), F.lit("15M"), n("del", "D"), rest, F.lit("M"))
    t = t.select("qname", F.col("qname").alias("id"), "flag", "chrom", "start", "mapq", cigar.alias("cigar"), F.substring(F.lit("ACGT" * 40), F.col("letter") + 1, length).alias("seq"), F.substring(F.lit("I+5J#" * 40), F.col("grade") + 1, length).alias("qual"))
    return t


def annotated_records(spark, sf_dir):
    """Geometry and haplotype votes of each good record, its bases read along the CIGAR."""
    return phasing.annotated(_records(spark, sf_dir, "qname"), view(spark, sf_dir, "snps"), 10, 20)


def annotated_records_by_sweep(spark, sf_dir):
    """The same through the sweep over both tables in order of place."""
    return phasing.annotated(_records(spark, sf_dir, "qname"), view(spark, sf_dir, "snps"), 10, 20, join=phasing.swept_join)


def flag_mapq_counts(spark, sf_dir):
    a = view(spark, sf_dir, "alignments").withColumn("chrom", F.when(F.col("chrom") == 0, "chrY").when(F.col("chrom") < 4, "chrX").otherwise("chr1"))
    return qc.flag_counts(a, ["cell"], 10, 8)


def sex_call_state(spark, sf_dir):
    counts = flag_mapq_counts(spark, sf_dir).withColumn("qualifying", F.when(F.col("cell") == 7, 0).otherwise(F.col("qualifying")))
    t = qc.sex_call(counts, "0.3")
    return t.select("cell", "input_state", "sex_state", "sex_call", "fallback_applied", "ratio_state", "measured", *[F.col(c).cast("double").alias(c) for c in ("measured_yperx", "effective_yperx")])


def _classified(spark, sf_dir):
    t = _read(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("q"), (F.col("l_suppkey") % 50).alias("cell"), (F.col("l_linenumber") % 2).alias("mate"), F.when(F.col("l_returnflag") != "R", F.concat(F.lit("G"), (F.col("l_partkey") % 40).cast("string"))).alias("gene"), (F.col("l_partkey") % 8).alias("token"), F.col("l_quantity").alias("mapq")
    )
    side = lambda k, what: F.collect_set(F.when((F.col("mate") == k) & F.col("gene").isNotNull(), F.col(what)))
    pairs = t.groupBy("q").agg(F.min("cell").alias("cell"), side(1, "gene").alias("g1"), side(0, "gene").alias("g2"), side(1, "token").alias("t1"), side(0, "token").alias("t2"), F.coalesce(F.max(F.when(F.col("mate") == 0, F.col("mapq"))) >= 25, F.lit(False)).alias("r2_mapped"))
    return pairs.withColumn("category", rna.compatibility())


def compat_classes_rollup(spark, sf_dir):
    return rna.compatibility_counts(_classified(spark, sf_dir))


def gene_component_tokens(spark, sf_dir):
    g = view(spark, sf_dir, "genes")
    gtf = g.select("chrom", (F.col("gene") % 2000).alias("gene_id"), F.col("start").alias("start1"), F.col("end").alias("end1"))
    t = rna.gene_components(rna.gene_spans(gtf))
    return t.select("gene_id", F.array_join("tokens", ",").alias("tokens"))


def feature_assignment(spark, sf_dir):
    f = view(spark, sf_dir, "fragments").where("mapq >= 30").select("q", "ln", "price", "chrom", "start", "end", "strand").distinct()
    g = view(spark, sf_dir, "genes").select("chrom", F.col("gene").cast("string").alias("gene"), "start", "end", "strand")
    return rna.assign_features(f, g, ["q", "ln", "price", "chrom", "start", "end", "strand"])


def umi_unique_counts(spark, sf_dir):
    return rna.unique_umis(view(spark, sf_dir, "umis"), ["cell", "gene"])


def umi_matrix_pivot(spark, sf_dir):
    counts = rna.unique_umis(view(spark, sf_dir, "umis"), ["cell", "gene"])
    cells = [*range(50), 777]  # the whole cohort and a cell without a read
    wide = rna.wide_matrix(counts, cells)
    return wide.select("gene", *[F.col(f"`{k}`").alias(f"cell_{k}") for k in cells])


def fraction_split_sum(spark, sf_dir):
    counts = rna.unique_umis(view(spark, sf_dir, "umis"), ["cell", "gene"])
    return rna.split_multigene(counts, ["cell"]).select("cell", "gene", F.round("n", 6).alias("n"))


def matrix_mode_summary(spark, sf_dir):
    u = view(spark, sf_dir, "umis")
    modes = {"all": u, "single": u.where(~F.col("gene").contains(","))}
    out = [rna.matrix_summary(rna.matrix_per_cell(rna.unique_umis(d, ["cell", "gene"]))).select(F.lit(k).alias("mode"), "*") for k, d in modes.items()]
    return out[0].union(out[1])


def directional_umi(spark, sf_dir):
    bases = F.translate(F.conv(F.col("l_orderkey").cast("string"), 10, 4), "0123", "ACGT")
    r = _read(spark, sf_dir, "lineitem").select((F.col("l_suppkey") % 50).alias("cell"), (F.col("l_partkey") % 5).alias("gene"), F.lpad(bases, 12, "A").alias("umi"))
    return rna.directional_umis(r, ["cell", "gene"])


def cell_qc_metadata(spark, sf_dir):
    li = view(spark, sf_dir, "contacts").join(_read(spark, sf_dir, "supplier").select((F.col("s_suppkey") % 50).alias("c")).distinct(), F.col("cell") == F.col("c"), "left_semi")
    reads = li.groupBy("cell").agg(F.count("*").alias("dna_reads"))
    both = contacts.interchromosomal(li, "cell").select("cell", "pairs", F.col("inter").alias("inter_pairs"))
    rna_reads = view(spark, sf_dir, "umis").groupBy("cell").agg(F.count("*").alias("rna_reads"))
    cells = view(spark, sf_dir, "cells").select("cell")
    t = qc.metadata_ratios(qc.left_join_all(cells, [reads, both, rna_reads], "cell"))
    t = t.withColumn("gigabases", N.gigabases(F.col("dna_reads")))
    out = qc.filled(t)
    return out.select("cell", "dna_reads", "pairs", "inter_pairs", "rna_reads", *[F.round(c, 9).alias(c) for c in ("rna_reads_ratio", "pairs_per_read", "inter_pairs_ratio", "gigabases")])


def split_read_totals(spark, sf_dir):
    """Reads per split, outer-joined over splits."""
    c = view(spark, sf_dir, "contacts").groupBy("q", (F.col("ln") % 3).alias("split")).agg(F.count("*").alias("n"))
    return qc.full_join_all([c.where(f"split = {k}").select("q", F.col("n").alias(f"reads_{k}")) for k in range(3)], "q")


def cohort_set_diff(spark, sf_dir):
    """The cohort against the cells of all reads, under a shifted code."""
    found = _read(spark, sf_dir, "lineitem").select((F.col("l_suppkey") + 3).alias("cell"))
    return qc.set_differences(view(spark, sf_dir, "cells"), found, "cell")


def contract_field_diff(spark, sf_dir):
    """Suppliers as stored against the customers of the same numbers: names all differ, nations here and there, most customers are new."""
    s = _read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("cell"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"))
    live = _read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("cell"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"))
    return qc.field_differences(s, live, "cell", ["name", "nation"])


def expected_missing(spark, sf_dir):
    """Cells and resolutions that no order has, with a customer's number as cell."""
    grid = qc.expected_grid(view(spark, sf_dir, "cells").select("cell"), ["20k", "50k", "100k"], "resolution")
    there = _read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("cell"), F.when(F.col("o_orderkey") % 3 == 0, "20k").when(F.col("o_orderkey") % 3 == 1, "50k").otherwise("1m").alias("resolution")).distinct()
    return grid.join(there, ["cell", "resolution"], "left_anti")


def cell_codes(spark, sf_dir):
    return view(spark, sf_dir, "cells").select("cell", "sample_name", N.cell_code(F.col("sample_name")).alias("code"))


def inter_chrom_counts(spark, sf_dir):
    return contacts.interchromosomal(view(spark, sf_dir, "contacts"), "cell")


def pair_dedup(spark, sf_dir):
    c = view(spark, sf_dir, "contacts")
    return contacts.dedup_pairs(c, ["chr1", "chr2", "strand1", "strand2"], ["pos2", "q", "ln", "price", "cell"], 500).select("chr1", "pos1", "chr2", "pos2", "strand1", "strand2", "q", "ln", "price")


def chrom_whitelist_pairs(spark, sf_dir):
    return contacts.standard_pairs(view(spark, sf_dir, "contacts")).groupBy("chr1", "chr2").agg(F.count("*").alias("n"))


def segment_merge(spark, sf_dir):
    t = contacts.merge_hits(view(spark, sf_dir, "hits"), ("ln", "price", "start", "chrom", "strand", "phase"))
    return t.select("qname", F.col("segment").cast("long").alias("segment"), "chrom", "start", "end", "strand", "phase", "mapq", "n_hits")


def adjacent_segment_pairs(spark, sf_dir):
    t = contacts.adjacent_pairs(contacts.resolve_reads(view(spark, sf_dir, "hits"), ("ln", "price", "start", "chrom", "strand", "phase")))
    return t.select("qname", F.col("i").cast("long").alias("i"), "chr1", "pos1", "chr2", "pos2", "strand1", "strand2", "phase1", "phase2")


def segments_to_bed(spark, sf_dir):
    return contacts.segments_to_bed(contacts.resolve_reads(view(spark, sf_dir, "hits"), ("ln", "price", "start", "chrom", "strand", "phase")))


def clean_crowded_legs(spark, sf_dir):
    c = view(spark, sf_dir, "contacts").select("cell", "q", "ln", "price", "chr1", "pos1", "chr2", "pos2").distinct()
    return contacts.clean_legs(c, ["cell", "q", "ln", "price"], 20_000, 12).select("cell", "q", "ln", "price")


def clean_isolated_contacts(spark, sf_dir):
    c = view(spark, sf_dir, "contacts").select("cell", "q", "ln", "price", "chr1", "pos1", "chr2", "pos2").distinct()
    return contacts.clean_isolated(c, ["cell", "q", "ln", "price"], 400_000, 2).select("cell", "q", "ln", "price")


def clean_spliced_contacts(spark, sf_dir):
    c = view(spark, sf_dir, "contacts").select("cell", "q", "ln", "price", "chr1", "pos1", "chr2", "pos2").distinct()
    exons = _read(spark, sf_dir, "part").select(F.concat(F.lit("chr"), (F.col("p_partkey") % 23).cast("string")).alias("chrom"), (F.col("p_partkey") * 900).alias("start"), (F.col("p_partkey") * 900 + 40_000).alias("end"), (F.col("p_partkey") % 200).alias("gene"))
    return contacts.clean_splicing(c, ["cell", "q", "ln", "price"], exons).select("cell", "q", "ln", "price")


def library_complexity(spark, sf_dir):
    f = view(spark, sf_dir, "fragments").select("chrom", F.floor(F.col("start") / 700).alias("start"), "strand", "mapq")
    t = fragments.library_complexity(f, ["chrom", "start", "strand", "mapq"])
    return t.select("total", "distinct", "singletons", "doubletons", *[F.round(c, 9).alias(c) for c in ("nrf", "pbc1", "pbc2")])


def contamination_regex(spark, sf_dir):
    d = _read(spark, sf_dir, "documents").select("source", F.col("text").alias("seq"))
    return qc.contamination(d, ["source"], pattern="th[aeiou][a-z]{2} [aeo]").select("source", "reads", "hits", F.round("percent", 9).alias("percent"))


def adapter_argmax(spark, sf_dir):
    d = _read(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("seq"))
    return qc.adapter_counts(d, "doc_id", adapters={"a": "thing", "b": "ation", "c": "queue"})


def adapter_match(spark, sf_dir):
    d = _read(spark, sf_dir, "documents").select("doc_id", F.upper("text").alias("seq"))
    return adapters.match_prefix(d, "THERNTION", 0.25, 4).select("doc_id", "matched", "trimmed")


def demultiplex_prefix(spark, sf_dir):
    d = _read(spark, sf_dir, "documents").select("doc_id", F.upper("text").alias("seq"))
    return adapters.demultiplex(d, {"x": ("NNTH", 3), "y": ("QUEN", 2), "z": ("LENA", 2)}).groupBy("split").agg(F.count("*").alias("n"))


def umi_extraction(spark, sf_dir):
    d = _read(spark, sf_dir, "documents").select("doc_id", N.umi_of(F.col("text")).alias("umi"), N.cell_code(F.col("source")).alias("code"))
    return d.groupBy("code").agg(F.count("*").alias("reads"), F.count_distinct("umi").alias("umis"))


def tss_profile_score(spark, sf_dir):
    """Scores and their status by cell over both cut ends of all fragments."""
    f = view(spark, sf_dir, "fragments")
    pile = qc.tss_pileup(fragments.cut_sites(f), view(spark, sf_dir, "tss"), 1000)
    t = qc.tss_score(pile, f.groupBy("cell").agg(F.count("*").alias("fragments")))
    return t.select("cell", "insertions", F.round("tss_score", 9).alias("tss_score"), qc.tss_status(F.col("insertions"), F.col("tss_score")).alias("status"))


def bulk_tss_signal(spark, sf_dir):
    sites = fragments.insertion_sites(view(spark, sf_dir, "fragments"))
    return qc.bulk_tss_profile(sites, view(spark, sf_dir, "tss")).select("bin", "n", F.round("signal", 9).alias("signal"))


def tn5_shift_extend(spark, sf_dir):
    return fragments.insertion_sites(view(spark, sf_dir, "fragments"), extension=75).groupBy("chrom", "strand").agg(F.sum("start").alias("starts"), F.sum("end").alias("ends"), F.min("site").alias("least"))


def mark_duplicates(spark, sf_dir):
    f = view(spark, sf_dir, "fragments").withColumn("five", fragments.five_prime())
    t = fragments.mark_duplicates(f, ["chrom", "strand", "five"], [F.col("mapq").desc(), *[F.col(c) for c in ("q", "ln", "price", "cell", "end")]])
    return t.groupBy("chrom").agg(F.count("*").alias("n"), F.count_if("duplicate").alias("duplicates"))


def insert_size_histogram(spark, sf_dir):
    return fragments.insert_sizes(view(spark, sf_dir, "fragments"), F.col("start") - F.col("end"))


def sample_summary(spark, sf_dir):
    f = view(spark, sf_dir, "fragments")
    t = f.groupBy("cell").agg(F.count("*").alias("reads"), F.count_if(F.col("chrom") == 3).alias("mt_reads"), F.count_if(F.col("mapq") >= 30).alias("final_reads"))
    return t.select("cell", "reads", "mt_reads", "final_reads", N.truncated(F.col("mt_reads") / F.col("reads")).alias("mt_rate"), N.truncated(F.col("final_reads") / F.col("reads")).alias("final_rate"))


def common_particles(spark, sf_dir):
    t = structure.common_particles(view(spark, sf_dir, "particles"), 3)
    return t.select("chrom", "pos").distinct()


def compartment_score(spark, sf_dir):
    cpg = _read(spark, sf_dir, "part").groupBy((F.col("p_partkey") % 20).alias("chrom"), (F.col("p_partkey") % 50).alias("bin")).agg((F.max("p_size") / 100).alias("cpg"))
    return structure.compartment_score(view(spark, sf_dir, "pairs_bins"), cpg).select("chrom", "bin1", F.round("score", 9).alias("score"))


def cpg_windows(spark, sf_dir):
    d = _read(spark, sf_dir, "documents").select(F.col("source").alias("chrom"), F.col("doc_id").alias("start"), (F.col("doc_id") + 1).alias("end"), F.col("text").alias("seq"))
    return structure.cpg_density(d).select("chrom", "start", F.col("cpg").cast("long").alias("cpg"), F.col("valid").cast("long").alias("valid"), F.round("density", 9).alias("density"))


def next_positions(spark, sf_dir):
    p = view(spark, sf_dir, "particles").select("chrom", "pos").distinct()
    return structure.next_position(p, "chrom", F.col("pos"))


def _structures(spark, sf_dir):
    """Five structures of each of three cells: a particle per embedding, three of its numbers as place, near a place that its locus has in all structures."""
    e = _read(spark, sf_dir, "embeddings")
    locus = F.floor(F.col("vec_id") / 15)
    places = [(F.get("embedding", F.lit(k)).cast("double") + 3 * F.sin(locus * (k + 1))).alias(n) for k, n in enumerate("xyz")]
    return e.select((F.floor(F.col("vec_id") / 5) % 3).alias("cell"), (F.col("vec_id") % 5).cast("int").alias("structure"), F.concat(F.lit("chr"), (locus % 4).cast("string")).alias("chrom"), locus.alias("pos"), *places)


def rmsd_best3(spark, sf_dir):
    return structure.structure_summary(_structures(spark, sf_dir))


def rmsd_per_locus(spark, sf_dir):
    return structure.locus_rmsd(structure.deviations(_structures(spark, sf_dir))).select("cell", "chrom", "pos", F.round("rmsd", 9).alias("rmsd"))


def aligned_structures(spark, sf_dir):
    return structure.aligned(_structures(spark, sf_dir))


def rmsd_pivot(spark, sf_dir):
    t = _read(spark, sf_dir, "orders").select((F.col("o_custkey") % 100).alias("cell"), F.when(F.col("o_orderkey") % 3 == 0, "20k").when(F.col("o_orderkey") % 3 == 1, "50k").otherwise("100k").alias("resolution"), F.col("o_totalprice").alias("rmsd"))
    t = t.groupBy("cell", "resolution").agg(F.max("rmsd").alias("rmsd"))
    return structure.pivot_resolutions(t, ["20k", "50k", "100k"])


def one_hot_phases(spark, sf_dir):
    t = view(spark, sf_dir, "contacts").select("cell", N.one_hot_phase((F.col("q") % 5).cast("int")).alias("p"))
    return t.groupBy("cell").agg(*[F.sum(F.get("p", F.lit(k))).alias(f"p{k}") for k in range(4)])


def merged_gene_spans(spark, sf_dir):
    return intervals.merged_intervals(view(spark, sf_dir, "genes").select("chrom", "start", "end"), ["chrom"])


def genome_split_counts(spark, sf_dir):
    return rna.genome_split(view(spark, sf_dir, "alignments")).groupBy("cell", "genome").agg(F.count("*").alias("n"))


def standard_reads(spark, sf_dir):
    """Reads all of whose segments are on one wanted chromosome."""
    t = contacts.resolve_reads(view(spark, sf_dir, "hits"), ("ln", "price", "start", "chrom", "strand", "phase"))
    return contacts.standard_reads(t, "^chr0$").select("qname", F.size("segs").cast("long").alias("segments"))


def pairs_text(spark, sf_dir):
    c = view(spark, sf_dir, "contacts").withColumn("read_id", F.col("q")).withColumn("phase1", F.when(F.col("ln") > 3, F.lit("0")))
    return writers.pairs_lines(c)


def ncc_text(spark, sf_dir):
    c = view(spark, sf_dir, "contacts")
    p = {f"p{k}": F.when(F.col("q") % 5 == i, 0.9).otherwise(F.lit(0.1)) for i, k in enumerate(("00", "01", "10", "11"))}
    return writers.ncc_lines(c.withColumns(p), 0.75)


def read_id_tags(spark, sf_dir):
    base = F.concat(F.lit("r"), F.col("o_orderkey").cast("string"), F.lit("_"), F.when(F.col("o_orderkey") % 3 == 0, "ACGTACGT").otherwise("ACG"))
    t = _read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), N.tagged_read_id(base, N.cell_code(F.col("o_orderpriority"))).alias("tagged"))
    return t.withColumn("umi", N.read_id_parts(F.col("tagged"))["umi"])


def fragment_selection_all_counters(spark, sf_dir):
    return fragments.selection_counters(view(spark, sf_dir, "alignments").withColumn("cell", F.col("qname") % 50), ["cell"], 10, TIES)


def dedup_then_score(spark, sf_dir):
    """De-duplication of a split pool with unmatched reads, then a strict bound of the score."""
    f = view(spark, sf_dir, "fragments")
    name = F.when(F.col("cell") < 5, "unmatched").otherwise(F.concat(F.lit("c"), F.col("cell").cast("string")))
    bed = f.select("chrom", "start", "end", F.concat_ws("_", F.col("q").cast("string"), name, F.lit("x")).alias("read_id"), F.col("mapq").alias("score"), "strand", "ln", "price")
    return fragments.dedup_reads(bed, True, 1, 20, True, ("read_id", "ln", "price", "start", "end", "strand")).select("chrom", "start", "end", "read_id", "score", "strand", "cell", "ln", "price")


def strand_collapse(spark, sf_dir):
    reads = contacts.resolve_reads(view(spark, sf_dir, "hits"), ("ln", "price", "start", "chrom", "strand", "phase"))
    return contacts.collapsed_strands(contacts.segment_lines(reads))


def chromosome_exclusions(spark, sf_dir):
    c = view(spark, sf_dir, "contacts").select(F.col("chr2").alias("chrom"), "cell")
    return fragments.without_chromosomes(c, ("chrUn", "X", "chr1")).groupBy("chrom").agg(F.count("*").alias("n"))


def compat_counters_rollup(spark, sf_dir):
    return rna.compatibility_counters(_classified(spark, sf_dir))


def reads_by_id(spark, sf_dir):
    """Line items of wanted orders; a third of the wanted numbers is no order's."""
    reads = _read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("read_id"), F.col("l_linenumber").alias("ln"))
    wanted = _read(spark, sf_dir, "customer").select((F.col("c_custkey") * 3).alias("read_id"))
    return fragments.reads_by_id(reads, wanted)


def plain_numbers(spark, sf_dir):
    return _read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), N.plain_number(F.col("o_totalprice") / 8).alias("shown"), N.plain_number(F.col("o_orderkey") * 100).alias("whole"))


def presence_of_adapter(spark, sf_dir):
    d = _read(spark, sf_dir, "documents").select("doc_id", F.translate(F.upper("text"), " ", "T").alias("seq"))
    return adapters.with_adapter(d, "XNNNNT{1}NN;o=4", 0.1).select("doc_id")


def session_gap_events(spark, sf_dir):
    t = sessions.gap_sessions(_read(spark, sf_dir, "events"))
    return t.select("user_id", "n", "first_ts", "last_ts")


def windowed_event_counts(spark, sf_dir):
    return sessions.windowed_counts(_read(spark, sf_dir, "events"), ["event_type"])


QUERIES = {
    "fragment_bin_counts": fragment_bin_counts,
    "select_best_per_qname": select_best_per_qname,
    "select_with_fallback_phase": select_with_fallback_phase,
    "fragment_selection_counters": fragment_selection_counters,
    "dedup_islands_one_pass": _dedup(["chrom"], False),
    "dedup_islands_two_pass": _dedup(["chrom"], True),
    "dedup_islands_splitpool": _dedup(["cell", "chrom"], True),
    "dup_rate_by_cell": dup_rate_by_cell,
    "cohort_fragments_distinct_sorted": cohort_fragments_distinct_sorted,
    "bin_counts_5k": bin_counts_5k,
    "overlap_join_points": overlap_join_points,
    "overlap_join_intervals": overlap_join_intervals,
    "overlap_anti": overlap_anti,
    "overlap_semi_counts": overlap_semi_counts,
    "overlap_fraction_filter": overlap_fraction_filter,
    "interval_union_components": interval_union_components,
    "cluster_best_mapq": cluster_best_mapq,
    "cluster_then_filter": cluster_then_filter,
    "coverage_steps": coverage_steps,
    "coverage_cpm": coverage_cpm,
    "binned_rpkm": binned_rpkm,
    "snp_vote_phase": snp_vote_phase,
    "annotated_records": annotated_records,
    "annotated_records_by_sweep": annotated_records_by_sweep,
    "flag_mapq_counts": flag_mapq_counts,
    "sex_call_state": sex_call_state,
    "compat_classes_rollup": compat_classes_rollup,
    "gene_component_tokens": gene_component_tokens,
    "feature_assignment": feature_assignment,
    "umi_unique_counts": umi_unique_counts,
    "umi_matrix_pivot": umi_matrix_pivot,
    "fraction_split_sum": fraction_split_sum,
    "matrix_mode_summary": matrix_mode_summary,
    "directional_umi": directional_umi,
    "cell_qc_metadata": cell_qc_metadata,
    "split_read_totals": split_read_totals,
    "cohort_set_diff": cohort_set_diff,
    "contract_field_diff": contract_field_diff,
    "expected_missing": expected_missing,
    "cell_codes": cell_codes,
    "inter_chrom_counts": inter_chrom_counts,
    "pair_dedup": pair_dedup,
    "chrom_whitelist_pairs": chrom_whitelist_pairs,
    "segment_merge": segment_merge,
    "adjacent_segment_pairs": adjacent_segment_pairs,
    "segments_to_bed": segments_to_bed,
    "clean_crowded_legs": clean_crowded_legs,
    "clean_isolated_contacts": clean_isolated_contacts,
    "clean_spliced_contacts": clean_spliced_contacts,
    "library_complexity": library_complexity,
    "contamination_regex": contamination_regex,
    "adapter_argmax": adapter_argmax,
    "adapter_match": adapter_match,
    "demultiplex_prefix": demultiplex_prefix,
    "umi_extraction": umi_extraction,
    "tss_profile_score": tss_profile_score,
    "bulk_tss_signal": bulk_tss_signal,
    "tn5_shift_extend": tn5_shift_extend,
    "mark_duplicates": mark_duplicates,
    "insert_size_histogram": insert_size_histogram,
    "sample_summary": sample_summary,
    "common_particles": common_particles,
    "compartment_score": compartment_score,
    "cpg_windows": cpg_windows,
    "next_positions": next_positions,
    "rmsd_best3": rmsd_best3,
    "rmsd_pivot": rmsd_pivot,
    "one_hot_phases": one_hot_phases,
    "merged_gene_spans": merged_gene_spans,
    "genome_split_counts": genome_split_counts,
    "standard_reads": standard_reads,
    "pairs_text": pairs_text,
    "ncc_text": ncc_text,
    "read_id_tags": read_id_tags,
    "fragment_selection_all_counters": fragment_selection_all_counters,
    "dedup_then_score": dedup_then_score,
    "strand_collapse": strand_collapse,
    "chromosome_exclusions": chromosome_exclusions,
    "compat_counters_rollup": compat_counters_rollup,
    "reads_by_id": reads_by_id,
    "plain_numbers": plain_numbers,
    "presence_of_adapter": presence_of_adapter,
    "rmsd_per_locus": rmsd_per_locus,
    "aligned_structures": aligned_structures,
    "session_gap_events": session_gap_events,
    "windowed_event_counts": windowed_event_counts,
}

QUERIES |= more.QUERIES
ORACLES |= more.ORACLES
