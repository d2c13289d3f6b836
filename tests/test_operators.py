"""Small hand-made cases of the operators, and differential tests against plain Python."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cytoflux.functions import alignment as A
from cytoflux.functions import names as N
from cytoflux.operators import adapters, cohort, contacts, fragments, intervals, phasing, qc, rna, structure


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_islands_keep_the_first_of_each_chain(spark):
    d = spark.createDataFrame([("c", p, i) for i, p in enumerate([10, 11, 12, 14])], "chrom string, start long, ord int")
    kept = intervals.first_of_islands(d, ["chrom"], F.col("start"), ["ord"], 1)
    assert rows(kept, "start") == [(10,), (14,)]


def test_islands_across_segment_borders(spark):
    random.seed(1)
    places = sorted(random.randrange(3000) for _ in range(600))
    d = spark.createDataFrame([("c", p, i) for i, p in enumerate(places)], "chrom string, start long, ord int")
    got = rows(intervals.island_starts(d, ["chrom"], F.col("start"), ["ord"], 3, segment_width=16).where("opens"), "ord")
    want = [(i,) for i, p in enumerate(places) if i == 0 or p - places[i - 1] > 3]
    assert got == want


def test_components_of_closed_spans(spark):
    g = spark.createDataFrame([("c", "a", 1, 5), ("c", "b", 5, 9), ("c", "x", 10, 12)], "chrom string, gene_id string, start1 long, end1 long")
    assert rows(rna.gene_components(rna.gene_spans(g)), "gene_id", "tokens") == [("a", ["c:1"]), ("b", ["c:1"]), ("x", ["c:2"])]


def test_components_and_coverage_against_plain_python(spark):
    random.seed(2)
    spans = [(i, s, s + random.randrange(1, 60)) for i, s in enumerate(random.randrange(4000) for _ in range(300))]
    d = spark.createDataFrame([("c", *s) for s in spans], "chrom string, id int, start long, end long")
    got = dict(rows(intervals.union_components(d, ["chrom"], ["end", "id"], segment_width=64), "id", "component"))
    assert got == dict(rows(intervals.union_components(d, ["chrom"], ["end", "id"], segment_width=None), "id", "component"))
    top, n, want = None, 0, {}
    for i, s, e in sorted(spans, key=lambda x: (x[1], x[2], x[0])):
        if top is None or s > top:
            n += 1
        top = e if top is None else max(top, e)
        want[i] = n
    assert got == want
    depth = {}
    for _, s, e in spans:
        for p in range(s, e):
            depth[p] = depth.get(p, 0) + 1
    steps = intervals.coverage_steps(d, ["chrom"], segment_width=64).collect()
    assert {p: r.depth for r in steps for p in range(r.start, r.end)} == depth


def test_overlap_join_finds_each_pair_once(spark):
    random.seed(3)
    a = [("c", i, s, s + random.randrange(1, 300)) for i, s in enumerate(random.randrange(2000) for _ in range(80))]
    b = [("c", i, s, s + random.randrange(1, 300)) for i, s in enumerate(random.randrange(2000) for _ in range(80))]
    x, y = (spark.createDataFrame(v, "chrom string, id int, start long, end long") for v in (a, b))
    want = sorted((i, j) for _, i, s, e in a for _, j, s2, e2 in b if s < e2 and s2 < e)
    assert rows(intervals.overlap_join(x, y, ["chrom"], 64), "l_id", "r_id") == want
    hit = {i for i, _ in want}
    assert {r.id for r in intervals.overlap_anti(x, y, ["chrom"], ["id"], 64).collect()} == {r[1] for r in a} - hit
    assert {r.id for r in intervals.overlap_semi(x, y, ["chrom"], ["id"], 64).collect()} == hit


def test_candidate_order_prefers_less_clipping_then_primary(spark):
    a = spark.createDataFrame([("q", "R2", 0x800, 60, 0, "c", 1, 50, "+", 49), ("q", "R2", 0, 60, 3, "c", 9, 70, "+", 61)], "qname string, origin string, flag int, mapq int, q_start int, chrom string, start long, end long, strand string, aligned_length long")
    assert rows(fragments.select_best(a), "q_start", "flag") == [(0, 0x800)]
    secondary = a.withColumn("flag", F.when(F.col("q_start") == 0, 0x100).otherwise(0))
    best = fragments.select_best(secondary)
    assert rows(best, "q_start") == [(3,)]
    assert fragments.unclipped(best).count() == 0


SELECTION = "qname string, origin string, flag int, mapq int, q_start int, chrom string, start long, end long, strand string, cigar string, phase string"


def test_selection_counts_aligned_bases_of_the_read(spark):
    """A deletion widens an alignment on the chromosome and adds no base of the read; an insertion does."""
    a = spark.createDataFrame([("q", "R2", 0, 60, 0, "c", 1, 61, "+", "20M20D20M", "."), ("q", "R2", 0, 60, 0, "c", 5, 46, "+", "41M", "."), ("p", "R2", 0, 60, 0, "c", 1, 42, "+", "41M", "."), ("p", "R2", 0, 60, 0, "c", 5, 45, "+", "20M2I20M", ".")], SELECTION)
    assert rows(fragments.select_best(fragments.with_aligned_length(a)), "qname", "start", "aligned_length") == [("p", 5, 42), ("q", 5, 41)]


def test_secondary_r1_alignments_say_nothing(spark):
    r2 = ("R2", 0, 60, 0, "c", 1, 11, "+", "10M", ".")
    r1 = lambda flag, phase, start=50: ("R1", flag, 60, 0, "c", start, start + 10, "+", "10M", phase)
    reads = {"a": [r2, r1(0x100, "1", 40), r1(0, "0")], "b": [r2, r1(0x100, "1")], "d": [r2, r1(0, "1"), r1(0x800, "0")], "e": [(*r2[:-1], "0"), r1(0, "1")]}
    a = fragments.with_aligned_length(spark.createDataFrame([(q, *x) for q, v in reads.items() for x in v], SELECTION))
    t = fragments.with_fallback_phase(fragments.select_best(a), a)
    assert rows(t, "qname", "final_phase", "phase_source", "r1_informative", "r1_conflict", "conflict") == [
        ("a", "0", "R1", 1, False, False),
        ("b", ".", "unphased", 0, False, False),
        ("d", "1", "R1", 2, True, False),
        ("e", "0", "R2", 1, False, True),
    ]


def test_clusters_of_points(spark):
    """Points of clusters are at most the distance apart, ends of reverse fragments count, and the best is widened around its point."""
    f = spark.createDataFrame([("a", 100, 300, "+", 20), ("b", 50, 105, "-", 40), ("d", 117, 400, "+", 30), ("e", 106, 117, "-", 10)], "q string, start long, end long, strand string, mapq int").withColumn("chrom", F.lit("c"))
    c = fragments.point_clusters(f, ["chrom"], 10, ["q"])
    assert rows(c, "q", "point") == [("a", 100), ("b", 105), ("d", 117), ("e", 117)]
    best = fragments.best_of_clusters(c, ["chrom"], [F.col("mapq").desc(), F.col("q")])
    assert rows(fragments.extended_points(best), "q", "start", "end") == [("b", 30, 181), ("d", 42, 193)]
    assert rows(fragments.best_of_clusters(fragments.point_clusters(f, ["chrom"], 11, ["q"]), ["chrom"], [F.col("mapq").desc()]), "q") == [("b",)]


def test_phase_verdict(spark):
    d = spark.createDataFrame([(2, 0), (0, 1), (1, 1), (0, 0)], "a int, b int")
    assert [r[0] for r in d.select(A.phase_verdict(F.col("a"), F.col("b"))).collect()] == ["0", "1", ".", "."]


def test_cigar(spark):
    d = spark.createDataFrame([("3S10M2I5M1D4M6S",)], "cigar string").withColumn("ops", A.cigar_ops(F.col("cigar")))
    r = d.select(A.reference_length(F.col("ops")), A.query_length(F.col("ops")), A.leading_clip(F.col("ops")), A.trailing_clip(F.col("ops")), A.aligned_blocks(F.col("ops"), F.lit(100))).first()
    assert tuple(r)[:4] == (20, 21, 3, 6)
    assert [tuple(b) for b in r[4]] == [(100, 3, 10), (110, 15, 5), (116, 20, 4)]
    for bad in ("5N3M", "3=", "2X", "4P"):
        with pytest.raises(Exception, match="unsupported CIGAR"):
            spark.createDataFrame([(bad,)], "cigar string").select(A.cigar_ops(F.col("cigar"))).collect()


def test_phase_from_bases(spark):
    a = spark.createDataFrame([(1, "c", 100, "2S4M", "TTACGT", "IIIIII"), (2, "c", 100, "4M", "ACGT", "!!!!"), (3, "c", 100, "4M", "ACGT", "*")], "id int, chrom string, start long, cigar string, seq string, qual string")
    s = spark.createDataFrame([("c", 101, "C", "G"), ("c", 104, "A", "C")], "chrom string, pos long, a0 string, a1 string")
    assert rows(phasing.phase_alignments(a, s), "id", "n0", "phase") == [(1, 1, "0"), (2, 0, "."), (3, 1, "0")]
    assert rows(phasing.phase_alignments(a, s, join=phasing.swept_join), "id", "n0", "phase") == [(1, 1, "0"), (2, 0, "."), (3, 1, "0")]
    short = a.withColumn("seq", F.lit("A")).where("id = 1")
    with pytest.raises(Exception, match="beyond the sequence"):
        phasing.phase_alignments(short, s).collect()


def test_sweep_join_finds_the_pairs_of_the_bin_join(spark):
    """Long and short intervals, several segments and small batches; nulls and empty intervals meet nothing."""
    random.seed(6)
    iv = [(random.choice("ab"), i, s, s + random.choice([0, 1, 5, 60, 3000])) for i, s in enumerate(random.randrange(5000) for _ in range(300))] + [("a", 900, None, 5), (None, 901, 0, 9000)]
    pt = [(random.choice("abz"), i, random.randrange(6000)) for i in range(400)] + [("a", 900, None), (None, 901, 5)]
    x, y = spark.createDataFrame(iv, "chrom string, id int, start long, end long"), spark.createDataFrame(pt, "chrom string, id int, pos long")
    want = sorted((i, j) for c, i, s, e in iv for d, j, p in pt if c and c == d and s is not None and p is not None and s <= p < e)
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for size, width in ((10_000, 1 << 18), (7, 512), (1, 64)):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(size))
            assert rows(intervals.sweep_point_join(x, y, ["chrom"], width=width), "l_id", "r_id") == want
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert intervals.sweep_point_join(x.where("false"), y, ["chrom"]).count() == 0
    assert intervals.point_join(x.where("start < end"), y, ["chrom"], width=64).count() == len(want)


def test_sex_calls(spark):
    cases = [("a", 0, 0), ("b", 0, 3), ("c", 100, 0), ("d", 100, 2), ("e", 2000, 30), ("f", 2_000_000, 1)]
    d = spark.createDataFrame([(k, 9, 9, 9, x, y) for k, x, y in cases], "cell string, total long, mapped long, qualifying long, x long, y long")
    shown = lambda v: None if v is None else f"{v:.6f}"
    got = {r.cell: (r.sex_state, r.sex_call, r.fallback_applied, r.ratio_state, r.measured, shown(r.measured_yperx), shown(r.effective_yperx)) for r in qc.sex_call(d, "0.015").collect()}
    assert got == {
        "a": ("undetermined_no_xy", "XX", True, "undefined_zero_zero", False, None, "0.000000"),
        "b": ("xy_y_only", "XY", False, "positive_infinity", False, None, "3.000000"),
        "c": ("xx_x_only", "XX", False, "finite", True, "0.000000", "0.000000"),
        "d": ("xy_ratio", "XY", False, "finite", True, "0.020000", "0.020000"),
        "e": ("xx_ratio", "XX", False, "finite", True, "0.015000", "0.015000"),
        "f": ("xx_ratio", "XX", False, "finite", True, "0.000001", "0.000001"),
    }
    male = qc.sex_call(d.where("cell = 'a'"), "0.015", "XY").first()
    assert (male.sex_call, shown(male.effective_yperx)) == ("XY", "1.015000")


def test_states_of_empty_cells(spark):
    """Cells without a good read have no call, whatever their counts on X and Y."""
    d = spark.createDataFrame([("a", 0, 0, 0, 0, 0), ("b", 5, 0, 0, 0, 0), ("c", 5, 5, 0, 3, 1)], "cell string, total long, mapped long, qualifying long, x long, y long")
    got = rows(qc.sex_call(d), "cell", "input_state", "sex_state", "sex_call", "ratio_state", "effective_yperx")
    assert got == [(c, s, "not_applicable", "", "not_applicable", None) for c, s in (("a", "header_only"), ("b", "unmapped_only"), ("c", "low_mapq_only"))]


def test_counts_on_x_and_y_have_a_bound_of_their_own(spark):
    a = spark.createDataFrame([("k", 0, 15, "chrX"), ("k", 0, 25, "chrY"), ("k", 4, 60, "chrX"), ("k", 0, 5, "chrX")], "cell string, flag int, mapq int, chrom string")
    assert rows(qc.flag_counts(a, ["cell"], 20, 10), "total", "mapped", "qualifying", "x", "y") == [(4, 3, 1, 1, 1)]
    assert rows(qc.flag_counts(a, ["cell"], 10, 20), "qualifying", "x", "y") == [(2, 0, 1)]


def test_tss_offsets(spark):
    """The core runs from -501 to 499, flanks are the outer 100 offsets, the mitochondrion does not count."""
    tss = spark.createDataFrame([("chr1", 5000, "+"), ("chrM", 5000, "+")], "chrom string, pos long, strand string")
    def score(*offsets):
        sites = spark.createDataFrame([("x", c, 5000 + o) for c in ("chr1", "chrM") for o in offsets], "cell string, chrom string, site long")
        return qc.tss_score(qc.tss_pileup(sites, tss), spark.createDataFrame([("x",)], "cell string")).first()
    for o, inside in ((-502, 0), (-501, 1), (0, 1), (499, 1), (500, 0)):
        r = score(o, -1000, -901, 901, 1000)
        assert r.insertions == 5 and r.tss_score == pytest.approx(inside / 1001 / (4 / 200))
    assert score(-900, 900).tss_score is None and score(-900).insertions == 1
    ends = fragments.cut_sites(spark.createDataFrame([(10, 20)], "start long, end long"))
    assert sorted(x.site for x in ends.collect()) == [10, 19]


def test_multigene_counts_are_shared_out(spark):
    d = spark.createDataFrame([("x", "A,B", 2.0), ("x", "A", 1.0)], "cell string, gene string, n double")
    assert rows(rna.split_multigene(d, ["cell"]), "gene", "n") == [("A", 2.0), ("B", 1.0)]


def test_compatibility_classes(spark):
    s = "array<string>"
    d = spark.createDataFrame(
        [(1, [], ["a"], [], ["t"], True), (2, ["a"], [], ["t"], [], False), (3, ["a"], [], ["t"], [], True), (4, ["a"], ["a"], ["t"], ["u"], True), (5, ["a"], ["b"], ["t"], ["t"], True), (6, ["a"], ["b"], ["t"], ["u"], True), (7, ["a"], ["a"], ["t"], ["t"], False), (8, ["a"], ["b"], ["t"], ["u"], False)],
        f"q int, g1 {s}, g2 {s}, t1 {s}, t2 {s}, r2_mapped boolean",
    ).withColumn("cell", F.lit("x"))
    c = d.withColumn("category", rna.compatibility())
    assert [x for _, x in rows(c, "q", "category")] == ["r1_uninformative", "r2_uninformative", "r2_genome_only", "concordant", "concordant", "incompatible", "concordant", "incompatible"]
    total = rna.compatibility_counts(c).where("cell = 'ALL'").first()
    assert total.pairs == sum(total[k] for k in rna.CLASSES) and total.compatible == 5


def test_matrix_has_all_cells_in_order(spark):
    d = spark.createDataFrame([("g", "b", 2), ("h", "a", 3)], "gene string, cell string, n long")
    wide = rna.wide_matrix(d, ["b", "zero", "a"])
    assert wide.columns == ["gene", "b", "zero", "a"]
    assert rows(wide, "gene", "b", "zero", "a") == [("g", 2, 0, 0), ("h", 0, 0, 3)]


def test_assigned_genes_and_unique_reads(spark):
    d = spark.createDataFrame([("Assigned", "A,,B", 0, 40, 1), ("Unassigned", "A", 0, 40, None), (None, None, 0x100, 40, 1)], "xs string, xt string, flag int, mapq int, nh int")
    got = d.select(rna.assigned_genes(F.col("xs"), F.col("xt")), rna.confident_unique(30)).collect()
    assert [(r[0], r[1]) for r in got] == [(["A", "B"], True), ([], False), ([], False)]


def test_directional_umis(spark):
    reads = [("ACGT", 10), ("ACGA", 3), ("ACCA", 1), ("TTTT", 4), ("TTTA", 4)]
    d = spark.createDataFrame([("c", u) for u, n in reads for _ in range(n)], "cell string, umi string")
    assert rows(rna.directional_umis(d, ["cell"]), "cell", "n") == [("c", 3)]


HITS = "qname string, read_num int, q_start int, chrom string, start long, end long, strand string, phase string, mapq int"


@pytest.mark.parametrize(("strand", "distance", "merges"), [(s, d, -500 <= d < 500) for s in "+-" for d in (-501, -500, -499, 499, 500)])
def test_hits_merge_up_to_500_bases(spark, strand, distance, merges):
    """On the forward strand the distance is from the end of the hit before to the start, on the reverse strand from its start to the end."""
    second = (3000 + distance, 3900) if strand == "+" else (1000, 2000 + distance)
    h = spark.createDataFrame([("q", 1, 0, "c", 2000, 3000, strand, ".", 10), ("q", 1, 5, "c", *second, strand, "1", 30)], HITS)
    got = contacts.merge_hits(h).orderBy("segment").collect()
    assert len(got) == (1 if merges else 2)
    if merges:
        ends = (2000, 3900) if strand == "+" else (1000, 3000)
        assert (got[0].start, got[0].end, got[0].mapq, got[0].n_hits, got[0].phase) == (*ends, 30, 2, ".")


def test_contacts_are_from_the_end_of_the_left_to_the_start_of_the_right(spark):
    h = spark.createDataFrame([("q", 1, 0, "a", 100, 200, "-", ".", 10), ("q", 2, 0, "b", 300, 400, "-", "0", 30), ("q", 2, 9, "d", 500, 600, "+", "1", 30)], HITS)
    assert rows(contacts.adjacent_pairs(contacts.resolve_reads(h)), "i", "chr1", "pos1", "chr2", "pos2", "strand1", "strand2") == [(0, "a", 200, "b", 300, "-", "-"), (1, "b", 400, "d", 500, "-", "+")]


def test_r2_segments_become_bed(spark):
    """R2 has read number 2; an unphased segment of it takes the first phase that R1 has."""
    h = [("q", 1, 0, "a", 1, 9, "+", ".", 7), ("q", 1, 9, "b", 1, 9, "+", "1", 7), ("q", 1, 19, "d", 1, 9, "+", "0", 7), ("q", 2, 0, "e", 30, 40, "-", ".", 8), ("q", 2, 9, "f", 50, 60, "+", "0", 9), ("p", 1, 0, "a", 1, 9, "+", ".", 7), ("p", 2, 0, "e", 3, 4, "-", ".", 8)]
    reads = contacts.resolve_reads(spark.createDataFrame(h, HITS))
    assert rows(contacts.segments_to_bed(reads), "qname", "chrom", "start", "end", "phase", "mapq", "strand") == [("p", "e", 3, 4, ".", 8, "-"), ("q", "e", 30, 40, "1", 8, "-"), ("q", "f", 50, 60, "0", 9, "+")]
    assert sorted(x.value for x in contacts.segment_lines(reads).collect())[0] == "p\ta!1!9!+!.!7!1!R1\te!3!4!-!.!8!1!R2"


def test_reads_with_scaffold_or_covered_segment_go(spark):
    seg = "array<struct<chrom:string,start:bigint,end:bigint,strand:string,phase:string,mapq:int,n_hits:int,read_num:int>>"
    d = spark.createDataFrame([("a", [("chr1", 0, 60, "+", ".", 1, 1, 1), ("chrUn", 0, 60, "+", ".", 1, 1, 2)]), ("b", [("chrX", 0, 60, "+", "0", 1, 1, 1), ("chrY", 100, 160, "+", ".", 1, 1, 2)])], f"qname string, segs {seg}")
    assert rows(contacts.standard_reads(d), "qname") == [("b",)]
    assert rows(contacts.standard_reads(d, contacts.NO_Y), "qname") == []
    for length, left in ((29, 1), (30, 0)):
        par = spark.createDataFrame([("chrX", 0, length)], "chrom string, start long, end long")
        assert contacts.without_regions(d.where("qname = 'b'"), par).count() == left
    assert rows(contacts.segments_to_bed(d.where("qname = 'b'")), "chrom", "phase") == [("chrY", "0")]


def test_empty_inputs(spark):
    f = spark.createDataFrame([], "chrom string, start long, end long, strand string, cell string, ord int")
    assert fragments.dedup_endpoints(f, ["cell", "chrom"], ["ord"]).count() == 0
    assert intervals.coverage_steps(f, ["chrom"]).count() == 0
    r = fragments.library_complexity(f, ["chrom", "start"]).first()
    assert r.nrf is None and r.pbc2 == -1.0


def test_dedup_rates(spark):
    raw = spark.createDataFrame([("x",)] * 4, "cell string")
    assert rows(fragments.duplication_rate(raw, raw.limit(1), "cell"), "cell", "raw", "kept", "rate") == [("x", 4, 1, 0.75)]
    assert spark.range(1).select(fragments.combined_rate(F.lit(0.5), F.lit(0.5))).first()[0] == 0.75


def test_names(spark):
    code = "C" + "0" * 16
    d = spark.createDataFrame([(f"r_{code}_ACGTACGT", "x_ACGTACGT", "@r/1")], "a string, b string, c string")
    r = d.select(N.read_id_parts(F.col("a")), N.tagged_read_id(F.col("b"), F.lit(code)), N.mate_suffix(F.col("c")), N.cell_code(F.lit("abc"))).first()
    assert tuple(r[0]) == ("r", code, "ACGTACGT") and r[1] == f"x_{code}_ACGTACGT" and r[2] == "@r 1" and r[3] == "Cba7816bf8f01cfea"


def test_adapters(spark):
    assert adapters.prefix_errors("ACGTTGCATTT", "GGACGTTGCA", 0.1, 6) == 8
    assert adapters.prefix_errors("ACGATGCATTT", "GGACGTTGCA", 0.13, 6) == 8
    assert adapters.prefix_errors("TTTTTTTTTTT", "GGACGTTGCA", 0.1, 6) is None
    d = spark.createDataFrame([("ACGTAGATCGGAAGAGCTT",), ("ACGTAGATCG",), ("ACGT",), ("ACAAAAAAAAAAAA",)], "seq string")
    assert [r[0] for r in d.select(adapters.trim_tail(F.col("seq"), qc.ADAPTERS["illumina"])).collect()] == ["ACGT", "ACGT", "ACGT", "ACAAAAAAAAAAAA"]
    assert d.select(adapters.trim_homopolymer(F.col("seq"), "A")).collect()[3][0] == "AC"


def test_structures(spark):
    import numpy as np

    rng = np.random.default_rng(0)
    base = rng.normal(size=(30, 3))
    turn = np.linalg.qr(rng.normal(size=(3, 3)))[0]
    shapes = [base, base @ turn + 5, base * 1.0 + 0.01 * rng.normal(size=base.shape), base + rng.normal(size=base.shape)]
    d = spark.createDataFrame([("x", k, "c", i, *map(float, p)) for k, s in enumerate(shapes) for i, p in enumerate(s)], "cell string, structure int, chrom string, pos long, x double, y double, z double")
    pairs = structure.pair_rmsd(structure.deviations(d))
    assert {(r.i, r.j): r.rmsd for r in pairs.collect()}[0, 1] < 1e-9
    s = structure.structure_summary(d).first()
    assert s.structures == 4 and s.top3_rmsd < 0.1 < s.rmsd
    few = structure.structure_summary(d.where("structure < 2")).first()
    assert few.top3_rmsd is None and few.rmsd < 1e-9
    # A structure that shares no particle with the others leaves none to all; then there is nothing to say.
    apart = d.withColumn("pos", F.when(F.col("structure") == 3, F.col("pos") + 100).otherwise(F.col("pos")))
    assert tuple(structure.structure_summary(apart).first()) == ("x", 4, 0, None, None, None, None)
    missing = d.withColumn("x", F.when((F.col("structure") == 2) & (F.col("pos") < 5), F.lit(float("nan"))).otherwise(F.col("x")))
    assert structure.structure_summary(missing).first().particles == 25


def test_rmsd_by_brute_force(spark):
    """Deviations by numpy over all pairs: per locus, per pair, the best three, and every structure turned onto every other."""
    rng = np.random.default_rng(1)
    rows, shapes = [], {}
    for cell in ("x", "y"):
        base = rng.normal(size=(40, 3))
        for k in range(5):
            shape = base + rng.normal(size=base.shape) * 0.2 * (k + 1) + k
            if k % 2:
                shape = shape @ np.diag([1, 1, -1.0]) @ np.linalg.qr(rng.normal(size=(3, 3)))[0]
            shapes[cell, k] = shape
            rows += [(cell, k, f"c{i % 2}", i, *map(float, p)) for i, p in enumerate(shape) if (i, k) != (7, 3)]
    d = spark.createDataFrame(rows, "cell string, structure int, chrom string, pos long, x double, y double, z double").repartition(3)
    common = [i for i in range(40) if i != 7]
    loci = {(r.cell, r.pos): r.rmsd for r in structure.locus_rmsd(structure.deviations(d)).collect()}
    summary = {r.cell: r for r in structure.structure_summary(d).collect()}
    turned = {(r.cell, r.structure, r.other, r.pos): (r.x, r.y, r.z) for r in structure.aligned(d).collect()}
    for cell in ("x", "y"):
        columns, medians = {}, {}
        for i, j in itertools.permutations(range(5), 2):
            a, b = shapes[cell, i][common], shapes[cell, j][common]
            u, _, v = np.linalg.svd((b - b.mean(axis=0)).T @ (a - a.mean(axis=0)))
            d2 = np.linalg.norm((b - b.mean(axis=0)) @ u @ v - (a - a.mean(axis=0)), axis=1)
            if i < j:
                columns[i, j], medians[i, j] = d2, np.median(d2)
            moved = (shapes[cell, j] - b.mean(axis=0)) @ u @ v + a.mean(axis=0)
            assert all(np.allclose(turned[cell, i, j, k], moved[k]) for k in range(40) if (k, j) != (7, 3))
        per_locus = np.sqrt((np.stack(list(columns.values()), axis=1) ** 2).mean(axis=1))
        assert np.allclose([loci[cell, k] for k in common], per_locus)
        best = min(itertools.combinations(range(5), 3), key=lambda t: sum(medians[p] for p in itertools.combinations(t, 2)))
        three = [np.sqrt((columns[p] ** 2).mean()) for p in itertools.combinations(best, 2)]
        want = (5, 39, np.sqrt((per_locus**2).mean()), np.median(per_locus), np.sqrt(np.mean(np.square(three))), np.median(three))
        assert np.allclose(tuple(summary[cell])[1:], want)


def test_windows_of_sequence(spark):
    r = random.Random(2)
    text = "".join(r.choices("ACGTN", weights=[2, 3, 3, 2, 1], k=700))
    lines = spark.createDataFrame([("c", k, text[i : i + 30], i) for k, i in enumerate(range(0, 700, 30))], "name string, ord int, line string, start long")
    spans = [(0, 700), (10, 40), (29, 31), (300, 333), (650, 700)]
    w = structure.padded_windows(spark.createDataFrame([("c", *x) for x in spans], "chrom string, start long, end long"), spark.createDataFrame([("c", 700)], "chrom string, size long"), 60)
    assert {(x["start"], x["end"]): (x["from"], x["until"]) for x in w.collect()} == {(0, 700): (0, 700), (10, 40): (0, 55), (29, 31): (0, 60), (300, 333): (287, 346), (650, 700): (645, 700)}
    for width in (64, 100_000):
        for x in structure.window_cpg(lines, w, width).collect():
            a, b = {(10, 40): (0, 55), (29, 31): (0, 60), (300, 333): (287, 346), (650, 700): (645, 700)}.get((x.start, x.end), (x.start, x.end))
            part = text[a:b]
            assert (x.cpg, x.valid) == (part.count("CG"), sum(part.count(c) for c in "ACGT")) and x.density == round(x.cpg / x.valid, 6)


def test_adapters_of_many_reads(spark):
    """The vectorised table gives the cuts of the plain one; short forms are written out."""
    r = random.Random(3)
    for adapter, rate, least in (("GGACGTTGCA", 0.1, 6), ("ACGNNTTTTT", 0.2, 4), ("ACGTACGTACGT", 0.25, 5), ("A", 0.1, 1)):
        reads = ["", None]
        for _ in range(300):
            x = list(adapter.replace("N", r.choice("ACGT"))[r.randrange(len(adapter)) :] + "".join(r.choices("ACGT", k=r.randrange(8))))
            for _ in range(r.randrange(3)):
                k = r.randrange(len(x) + 1)
                x[k : k + r.randrange(2)] = r.choice(["", "A", "T"])
            reads.append("".join(x))
        want = [adapters.prefix_errors(x, adapter, rate, least) if x else None for x in reads]
        assert adapters.cuts_of(reads, adapter, rate, least).tolist() == [-1 if w is None else w for w in want]
    assert adapters.written_out("XN{8}T{15};o=18") == ("N" * 8 + "T" * 15, 18) and adapters.written_out("ACGT") == ("ACGT", None)
    tail = "T" * 15
    d = spark.createDataFrame([(1, "ACGTACGT" + tail + "A"), (2, "CGT" + tail), (3, "T" + tail), (4, "ACGTACGTTTTATTTTTTTTTTTG"), (5, "ACGT"), (6, None)], "id int, seq string")
    assert sorted(x.id for x in adapters.with_adapter(d, "XNNNNNNNNT{15};o=18").collect()) == [1, 2, 4]


def test_adapter_counts_of_lines(spark):
    d = spark.createDataFrame([(0, "AGATCGGAAGAGC"), (1, "CTGTCTCTTATA"), (2, "CTGTCTCTTATA")], "ord int, seq string")
    assert qc.adapter_counts(d, "ord", lines=8).first().best == "illumina" and qc.adapter_counts(d, "ord", lines=9).first().nextera == 2
    assert qc.adapter_counts(d, "ord").first().best == "nextera"
    assert qc.adapter_counts(d.withColumn("seq", F.lit("AAAA")), "ord").first().best == ""


def test_crowded_and_isolated_contacts(spark):
    r = random.Random(4)
    rows = [(i, r.randrange(2), "a", r.randrange(3000), "b", r.randrange(3000)) for i in range(150)] + [(1000 + i, 0, "a", 5000 + r.randrange(40), "b", 100 + r.randrange(40)) for i in range(60)] + [(2000, 0, "a", 5130, "b", 150), (2001, 0, "a", 9999, "b", 9999)]
    d = spark.createDataFrame(rows, "id int, cell int, chr1 string, pos1 long, chr2 string, pos2 long")
    for support in (1, 2, 5):
        want = {a[0] for a in rows if sum(a[1] == b[1] and a[0] != b[0] and abs(a[3] - b[3]) <= 100 and abs(a[5] - b[5]) <= 100 for b in rows) >= support}
        assert {x.id for x in contacts.clean_isolated(d, ["id", "cell"], 100, support).collect()} == want
    legs = [(a[0], a[1], c, p) for a in rows for c, p in ((a[2], a[3]), (a[4], a[5]))]
    bad = {a[0] for a in legs if sum(a[1] == b[1] and a[2] == b[2] and abs(a[3] - b[3]) <= 50 for b in legs) - 1 > 4}
    for width in (60, 1_000_000):
        assert {x.id for x in contacts.clean_legs(d, ["id", "cell"], 50, 4, width).collect()} == {a[0] for a in rows} - bad


def test_reads_that_are_annotated(spark):
    rows = [(1, "q", 0x40 | 16, "c", 10, 60, "2S3M1I2M4H", "TTACGTAC", "IIIIIIII"), (2, "q", 0x80 | 16, "c", 10, 60, "2S3M1D2M", "TTACGAC", "*"), (3, "q", 0, "c", 10, 5, "4M", "ACGT", "IIII"), (4, "r", 0x80, "c", 10, 60, "4M", "ACGT", "II!I")]
    d = spark.createDataFrame(rows, "id int, qname string, flag int, chrom string, start long, mapq int, cigar string, seq string, qual string")
    snps = spark.createDataFrame([("c", 11, "C", "A"), ("c", 12, "A", "G"), ("c", 14, "A", "T")], "chrom string, pos long, a0 string, a1 string")
    got = {x.flag: tuple(x)[4:] for x in phasing.annotated(d, snps).collect()}
    assert got == {
        0x40 | 16: (10, 15, "-", 60, 4, 10, 6, ".", 1, 1, 1),
        0x80 | 16: (10, 16, "+", 60, 0, 5, 5, ".", 2, 1, 0),
        0x80: (10, 14, "-", 60, 0, 4, 4, "0", 1, 0, 0),
    }


def test_small_functions(spark):
    from cytoflux.functions import alignment, names

    one = spark.createDataFrame([("a/b/c.bed.gz", "chr1_x y", 1.5, 100.0, None)], "path string, chrom string, v double, w double, n double")
    r = one.select(
        names.path_part(F.col("path"), -1, r"\.bed\.gz$"), names.path_part(F.col("path"), 1), names.safe_name(F.lit(7), F.col("chrom")), names.plain_number(F.col("v")), names.plain_number(F.col("w")), names.plain_number(F.lit(0.0)), names.plain_number(F.col("n")), names.plain_number(F.lit(1e-12)),
        alignment.query_start(alignment.cigar_ops(F.lit("3S4M2H")), F.lit(True)), alignment.query_start(alignment.cigar_ops(F.lit("3S4M2H")), F.lit(False)),
    ).first()
    assert tuple(r) == ("c", "a", "0007_chr1_x_y", "1.5", "100", "0", None, "0", 2, 3)
    flags = spark.createDataFrame([(1, 3, 30), (2, 3, 29), (3, 1, 60), (4, 3 | 0x400, 60), (5, 3 | 0x100, 60)], "id int, flag int, mapq int")
    assert [x.id for x in flags.where(fragments.proper_primary()).collect()] == [1]
    status = spark.createDataFrame([(0, 1.0), (5, 1.0), (5, None), (5, float("nan"))], "n int, v double").select(qc.tss_status(F.col("n"), F.col("v"))).collect()
    assert [x[0] for x in status] == ["insufficient_data", "ok", "insufficient_data", "insufficient_data"]
    targets = spark.createDataFrame([("a", True), ("b", True), ("c", True), ("d", False)], "path string, enabled boolean")
    assert sorted(x.path for x in cohort.missing_targets(targets, spark.createDataFrame([("a", 5), ("b", 0)], "path string, length long")).collect()) == ["b", "c"]


def test_cohort_checks(spark):
    cells = spark.createDataFrame([(k, f"s{k}", f"C{k}") for k in range(40)], "ord int, sample_name string, safe_code string")
    first = qc.contract_hash(cells, 4).first().sha256
    assert first == qc.contract_hash(cells.orderBy(F.desc("ord")).repartition(5), 4).first().sha256 and len(first) == 64
    assert first != qc.contract_hash(cells.withColumn("safe_code", F.when(F.col("ord") == 9, "Cx").otherwise(F.col("safe_code"))), 4).first().sha256
    stats = cells.where("ord < 4").select("ord", "sample_name", F.lit(3.0).alias("n"))
    few = cells.where("ord < 4")
    assert qc.exact_cohort(stats, few).count() == 0
    bad = stats.where("ord <> 0").withColumn("n", F.when(F.col("ord") == 1, -1.0).otherwise(2.0)).withColumn("sample_name", F.when(F.col("ord") == 2, "s9").otherwise(F.col("sample_name")))
    assert {(x.ord, x.fault) for x in qc.exact_cohort(bad.union(spark.createDataFrame([(7, "z", 1.0)], bad.schema)), few).collect()} == {(0, "missing"), (1, "bad count"), (2, "out of order"), (7, "unexpected")}
    table = qc.audit({"cohort": qc.exact_cohort(stats, few), "bad": qc.exact_cohort(bad, few)})
    assert {tuple(x) for x in table.collect()} == {("cohort", 0, "pass"), ("bad", 3, "fail")}


def test_checks(spark):
    d = spark.createDataFrame([(1, 5), (2, 3)], "ord int, pos int").withColumn("k", F.lit("x"))
    assert rows(qc.unsorted_rows(d, ["k"], "ord", "pos"), "ord") == [(2,)]
    with pytest.raises(Exception, match="negative"):
        qc.checked(d, F.col("pos") > 4, "negative").collect()
    e, f = (spark.createDataFrame([(x,) for x in v], "c string") for v in (["a", "b"], ["b", "z"]))
    assert rows(qc.set_differences(e, f, "c"), "c", "status") == [("a", "missing"), ("z", "unexpected")]
    t = spark.createDataFrame([("a", None, float("nan"), None)], "c string, n long, v double, rmsd_20k double")
    assert tuple(qc.filled(t).first()) == ("a", 0, 0.0, None)


def test_cells_get_their_place(spark):
    d = spark.createDataFrame([(f"s{k:02d}",) for k in (7, 1, 30, 2)], "sample_name string")
    assert rows(cohort.with_order(d), "ord", "sample_name") == [(0, "s01"), (1, "s02"), (2, "s07"), (3, "s30")]
    cells = d.withColumn("safe_code", N.cell_code(F.col("sample_name")))
    with pytest.raises(Exception, match="unknown cell code"):
        cohort.named(spark.createDataFrame([("Cx", 1)], "cell_code string, n int"), cells).collect()


def test_islands_are_numbered_across_segments(spark):
    random.seed(11)
    places = sorted(random.randrange(3000) for _ in range(500))
    d = spark.createDataFrame([("c", p, i) for i, p in enumerate(places)], "chrom string, start long, ord int")
    n, want = 0, []
    for i, p in enumerate(places):
        n += i == 0 or p - places[i - 1] > 3
        want.append((i, n))
    assert rows(intervals.islands(d, ["chrom"], F.col("start"), ["ord"], 3, segment_width=16), "ord", "island") == want


def test_demultiplex_with_errors(spark):
    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                same = y in "ACGTN" if x == "N" else x == y
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (not same)))
            row = new
        return min(row)  # against any prefix of b

    def fits(read, adapter, least):
        tails = [adapter[k:] for k in range(len(adapter) - least + 1)]
        return read is not None and any(distance(t, read) <= 0.1 * (len(t) - t.count("N")) for t in tails)

    splits = {"ct": ("GGTTGAGGTAGTGGTATAGCTTCGTGTATAAGAGACAG", 32), "atac": ("GGTTGAGGTAGTAAGTCCTGGATGTGTATAAGAGACAG", 32), "n": ("NNNNNNNNTTTTTTTTTTTTTTT", 18), "short": ("ACGT", 3)}
    r = random.Random(7)
    reads = [None, "", "ACGT", "CGTT", "NNACGT"]
    for adapter, least in list(splits.values())[:3]:
        adapter = adapter.replace("N", "C")
        for k in range(200):
            read = list(adapter[r.randrange(len(adapter) - least + 3) :])
            for _ in range(k % 6):
                at, kind = r.randrange(len(read)), r.randrange(3)
                read[at : at + 1] = [[r.choice("ACGTN")], [], [read[at], r.choice("ACGT")]][kind]
            reads.append("".join(read) + "".join(r.choice("ACGT") for _ in range(r.choice([0, 5, 60]))))
    d = spark.createDataFrame(list(enumerate(reads)), "id int, seq string")
    want = {(i, k) for i, x in enumerate(reads) for k, (a, n) in splits.items() if fits(x, a, n)}
    got = [(x.id, x.split) for x in adapters.demultiplex(d, splits).collect()]
    exact = {(x.id, x.split) for x in adapters.demultiplex(d, splits, rate=0.0).collect()}
    assert len(got) == len(set(got)) and set(got) == want
    assert exact < want and len(exact) < 0.6 * len(want)


def test_isolated_contacts_are_dealt_once(spark):
    """Contacts at the borders of tiles, twins in their ids, and few rows shuffled: a contact goes to few tiles, not to nine squares."""
    r = random.Random(31)
    rows = [(i // 2 if i < 40 else i, i % 3, "a", 1600 * r.randrange(3) + r.randrange(-150, 150), r.choice("ab"), 1600 * r.randrange(3) + r.randrange(-150, 150)) for i in range(400)]
    rows += [(1000 + i, 0, "a", 20_000 + 300 * i, "b", 20_000 + 300 * i) for i in range(300)] + [(5000, None, "a", 0, "b", 0), (5001, 0, "a", None, "b", 0)]
    d = spark.createDataFrame(rows, "id int, cell int, chr1 string, pos1 long, chr2 string, pos2 long")
    for support in (1, 2, 4):
        n = {}
        for a in rows:
            for b in rows:
                if None not in (*a, *b) and (a[1], a[2], a[4]) == (b[1], b[2], b[4]) and a[0] != b[0] and abs(a[3] - b[3]) <= 100 and abs(a[5] - b[5]) <= 100:
                    n[a[:2]] = n.get(a[:2], 0) + 1
        kept = contacts.clean_isolated(d, ["id", "cell"], 100, support)
        assert sorted((x.id, x.cell) for x in kept.collect()) == sorted(a[:2] for a in rows if n.get(a[:2], 0) >= support)
    plan = kept._jdf.queryExecution().toString()
    assert plan.split("== Physical Plan ==")[1].split("+- == Initial Plan ==")[0].count("Exchange hashpartitioning") <= 4
