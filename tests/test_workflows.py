"""The end-to-end plans on small cases."""

import pytest
from pyspark.sql import functions as F

from cytoflux.plans import workflows as P


def test_settings():
    with pytest.raises(ValueError, match="experiment"):
        P.Settings(experiment="x")
    with pytest.raises(ValueError, match="twice"):
        P.Settings(resolutions=("1k", "1k"))
    assert P.overlaid({"a": {"b": 1, "c": 2}}, {"a": {"b": 3}, "d": 4}) == {"a": {"b": 3, "c": 2}, "d": 4}


def test_settings_from_dictionaries():
    s = P.settings_of({"min_mapq": 20, "resolutions": ["1k"]}, {"min_mapq": 30}, entries=["experiment=hic", "bin_width=10", "sex_threshold=abc"])
    assert (s.min_mapq, s.resolutions, s.experiment, s.bin_width, s.sex_threshold) == (30, ("1k",), "hic", 10, "abc")
    assert P.with_values({}, ["a={\"b\": 1}", "c=x=y"]) == {"a": {"b": 1}, "c": "x=y"}
    for entries, fault in ((["novalue"], "KEY=VALUE"), (["1a=2"], "KEY=VALUE"), (["other=2"], "unknown")):
        with pytest.raises(ValueError, match=fault):
            P.settings_of({}, entries=entries)


def test_alignments_that_differ_in_cigar_alone(spark):
    """Votes of two alignments of a read stay apart, and no row is multiplied."""
    schema = "qname string, origin string, flag int, mapq int, q_start int, chrom string, start long, end long, strand string, cell string, cigar string, seq string, qual string"
    row = lambda cigar, seq: ("a", "R2", 0, 60, 0, "c", 100, 104, "+", "x", cigar, seq, "I" * len(seq))
    d = spark.createDataFrame([row("4M", "ACGT"), row("2M1I2M", "ACTAT"), row("4M", "ACGT")], schema)
    snps = spark.createDataFrame([("c", 102, "G", "A")], "chrom string, pos long, a0 string, a1 string")
    out = P.fragment_plan(d, snps, P.Settings(), ties=("cigar",))
    assert [(r.qname, r.final_phase) for r in out["phase_table"].collect()] == [("a", "1")]


def test_fragments(spark):
    schema = "qname string, origin string, flag int, mapq int, q_start int, chrom string, start long, end long, strand string, cell string, cigar string, seq string, qual string"
    rows = [
        ("a", "R2", 0, 60, 0, "c", 100, 104, "+", "x", "4M", "ACGT", "IIII"),
        ("a", "R1", 0, 60, 0, "c", 200, 204, "-", "x", "4M", "CCCC", "IIII"),
        ("b", "R2", 0, 60, 0, "c", 101, 105, "+", "x", "4M", "CGTA", "IIII"),
        ("d", "R2", 0, 60, 2, "c", 400, 404, "+", "x", "2S4M", "TTACGT", "IIIIII"),
        ("e", "R2", 0, 10, 0, "c", 500, 504, "+", "x", "4M", "ACGT", "IIII"),
    ]
    snps = spark.createDataFrame([("c", 202, "A", "C")], "chrom string, pos long, a0 string, a1 string")
    out = P.fragment_plan(spark.createDataFrame(rows, schema), snps, P.Settings())
    table = {r.qname: (r.final_phase, r.phase_source) for r in out["phase_table"].collect()}
    assert table == {"a": ("1", "R1"), "b": (".", "unphased")}
    assert [r.qname for r in out["fragments"].collect()] == ["a"]
    assert [tuple(r) for r in out["rates"].collect()] == [("x", 2, 1, 0.5)]
    assert out["cohort"].count() == 1 and out["bins"].first().n == 1


def test_contacts(spark):
    h = "qname string, read_num int, q_start int, chrom string, start long, end long, strand string, phase string, mapq int"
    rows = [("a", 1, 0, "chr1", 100, 200, "+", ".", 9), ("a", 1, 5, "chr2", 900, 990, "+", "1", 9), ("b", 0, 0, "chr1", 120, 210, "+", ".", 9), ("b", 1, 5, "chr2", 910, 999, "+", "1", 9), ("c", 0, 0, "chr1", 1, 9, "+", ".", 9), ("c", 0, 1, "chrM", 1, 9, "+", ".", 9)]
    out = P.contact_plan(spark.createDataFrame(rows, h), None, P.Settings())
    assert out["pairs"].count() == 2 and out["deduplicated"].count() == 1
    par = spark.createDataFrame([("chr2", 880, 995)], "chrom string, start long, end long")
    assert P.contact_plan(spark.createDataFrame(rows, h), par, P.Settings())["reads"].count() == 0


def test_rna(spark):
    s = "array<string>"
    pairs = spark.createDataFrame([(1, "x", "u1", ["A"], ["A"], True), (2, "x", "u2", ["A"], ["B"], True), (3, "y", "u1", ["A", "B"], ["Z"], True), (4, "y", "u1", [], ["Z"], True)], f"pair int, cell string, umi string, g1 {s}, g2 {s}, r2_mapped boolean")
    comps = spark.createDataFrame([("A", ["c:1"]), ("B", ["c:1"])], f"gene_id string, tokens {s}")
    out = P.rna_plan(pairs, comps, ["x", "y"], P.Settings())
    assert {r.cell: (r.concordant, r.incompatible, r.r1_uninformative) for r in out["classes"].collect()} == {"x": (2, 0, 0), "y": (0, 1, 1), "ALL": (2, 1, 1)}
    assert sorted(tuple(r) for r in out["matrix_r1_all"].collect()) == [("A", 2, 0), ("A,B", 0, 1)]
    assert sorted(tuple(r) for r in out["matrix_r1r2_concordant"].collect()) == [("A", 2, 0)]
    assert sorted((r.cell, r.gene, r.n) for r in out["fractions_r1_all"].collect()) == [("x", "A", 2.0), ("y", "A", 0.5), ("y", "B", 0.5)]


def test_sex(spark):
    a = spark.createDataFrame([("x", 0, 60, "chrX"), ("x", 0, 60, "chrY"), ("x", 4, 0, "chr1")], "cell string, flag int, mapq int, chrom string")
    assert P.sex_plan(a, P.Settings()).first().sex_call == "XY"
    assert P.sex_plan(a.where(F.lit(False)), P.Settings()).count() == 0
