"""Readers, the FASTQ source, writers and streaming forms on small files."""

import gzip

import pytest
from pyspark.sql import functions as F

from cytoflux.operators import cohort
from cytoflux.sources import fastq, readers, writers
from cytoflux.streaming import sessions


def put(tmp_path, name, text):
    p = tmp_path / name
    p.write_text(text)
    return str(p)


def test_sam(spark, tmp_path):
    line = "q\t16\tchr1\t101\t60\t4M\t*\t0\t0\tACGT\tIIII\tNH:i:1\tXS:Z:Assigned"
    p = put(tmp_path, "a.sam", f"@SQ\tSN:chr1\tLN:1000\n{line}\n")
    r = readers.read_sam(spark, p).first()
    assert (r.qname, r.flag, r.start, r.tags["XS"], r.tags["NH"]) == ("q", 16, 100, "Assigned", "1")
    assert tuple(readers.read_sam_header(spark, p).first()) == ("chr1", 1000)
    assert writers.without_tags(readers.read_sam(spark, p)).first().tags == {"NH": "1"}
    with pytest.raises(Exception, match="fewer than 11"):
        readers.read_sam(spark, put(tmp_path, "b.sam", "q\t0\tchr1\n")).collect()


def test_tables(spark, tmp_path):
    gtf = put(tmp_path, "a.gtf", '#x\nchr1\ts\tgene\t5\t9\t.\t+\t.\tgene_id "G1"; gene_name "A";\nchr1\ts\tgene\t5\t9\t.\t+\t.\tnone\n')
    assert [tuple(r) for r in readers.read_gtf(spark, gtf).collect()] == [("chr1", "gene", 5, 9, "+", "G1", "A")]
    vcf = put(tmp_path, "a.vcf", "##x\nchr1\t7\t.\tA\tC,G\t.\tPASS\t.\tGT\t0|2\nchr1\t8\t.\tA\tC\t.\tq10\t.\tGT\t0|1\nchr1\t9\t.\tA\tC\t.\t.\t.\tGT\t1|1\nchr1\t10\t.\tAT\tC\t.\t.\t.\tGT\t0|1\n")
    assert [tuple(r) for r in readers.read_vcf_phased(spark, vcf).collect()] == [("chr1", 7, "A", "G")]
    snps = put(tmp_path, "a.snp", "#x\nchr1\t7\tA\tC\nchr1\t8\tAA\tC\n")
    assert [tuple(r) for r in readers.read_phased_snps(spark, snps).collect()] == [("chr1", 6, "A", "C")]
    pairs = put(tmp_path, "a.pairs", "## pairs\n#chromosome: chr1 9\nr\tchr1\t1\tchr2\t2\n\n")
    r = readers.read_pairs(spark, pairs).first()
    assert (r.read_id, r.pos2, r.strand1) == ("r", 2, None)
    seg = put(tmp_path, "a.seg", "r\tchr1!1!9!+!.!60!1!R1\tchr2!3!8!-!1!50!2!R2\tchr3!3!8!-!1!50!2!.\n")
    assert [tuple(s) for s in readers.read_segments(spark, seg).first().segs] == [("chr1", 1, 9, "+", ".", 60, 1, 1), ("chr2", 3, 8, "-", "1", 50, 2, 2), ("chr3", 3, 8, "-", "1", 50, 2, 0)]
    con = put(tmp_path, "a.con", "chr1,5,0\tchr2,6,1\n")
    assert tuple(readers.read_con(spark, con).first()) == ("chr1", 5, "chr2", 6, "0", "1")
    matrix = put(tmp_path, "m.tsv", "gene\ta\tb\nG\t1\t2.5\n")
    assert sorted(tuple(r) for r in readers.read_matrix(spark, matrix, ["a", "b"]).collect()) == [("G", "a", 1.0), ("G", "b", 2.5)]
    fasta = put(tmp_path, "a.fa", ">s1 x\nACGT\nGG\n>s2\nT\n")
    assert sorted(tuple(r) for r in readers.read_fasta(spark, fasta).collect()) == [("s1", 0, "ACGT", 0), ("s1", 1, "GG", 4), ("s2", 0, "T", 0)]
    log = put(tmp_path, "x.log", "hello\noverall alignment rate: 93.5%\n")
    assert readers.read_log_values(spark, log, r"rate: ([0-9.]+)%").first().value == 93.5
    assert readers.record_count(spark, pairs).first().n == 1


def test_fastq(spark, tmp_path):
    with gzip.open(tmp_path / "a.fq.gz", "wt") as f:
        f.write("@r1 c\nACGT\n+\nIIII\n@r2\nGG\n+\nII\n")
    fastq.register(spark)
    got = spark.read.format("fastq").load(str(tmp_path / "a.fq.gz"))
    assert [(r.ord, r.read_id, r.comment, r.seq) for r in got.orderBy("ord").collect()] == [(0, "r1", "c", "ACGT"), (1, "r2", "", "GG")]
    with pytest.raises(ValueError, match="truncated"):
        list(fastq.records(iter(["@r\n", "AC\n"]), "x"))
    with pytest.raises(ValueError, match="malformed"):
        list(fastq.records(iter(["@r\n", "AC\n", "+\n", "I\n"]), "x"))


def test_discovery(spark, tmp_path):
    for cell in ("b1", "a1"):
        (tmp_path / cell).mkdir()
        for mate in (1, 2):
            (tmp_path / cell / f"{cell}_R{mate}.fq.gz").write_bytes(b"x")
    got = cohort.discover(spark, str(tmp_path)).orderBy("ord").collect()
    assert [r.sample_name for r in got] == ["a1", "b1"] and all(r.r1.endswith("_R1.fq.gz") for r in got)
    (tmp_path / "a1" / "a1_R2.fq.gz").unlink()
    with pytest.raises(Exception, match="not one pair"):
        cohort.discover(spark, str(tmp_path)).collect()


def test_discovery_of_other_names(spark, tmp_path):
    def folder(name, *files):
        (tmp_path / name).mkdir(parents=True)
        for f in files:
            (tmp_path / name / f).write_bytes(b"x")
        return str(tmp_path / name.split("/")[0])

    good = folder("good/a", "a_1.fq.gz", "a_2.fq.gz", ".hidden.fq.gz", "notes.txt")
    assert [(r.sample_name, r.ord) for r in cohort.discover(spark, good).collect()] == [("a", 0)]
    for name, files, fault in (
        ("other/a", ("b_1.fq.gz", "b_2.fq.gz"), "names of other files"),
        ("more/a", ("a_1.fq.gz", "a_2.fq.gz", "a_3.fq.gz"), "names of other files"),
        ("long/a", ("a_1.fastq.gz", "a_2.fastq.gz"), "names of other files"),
        ("both/a", ("a_1.fq.gz", "a_2.fq.gz", "a_R1.fq.gz", "a_R2.fq.gz"), "not one pair"),
        ("bad/-a", ("-a_1.fq.gz", "-a_2.fq.gz"), "bad name"),
    ):
        with pytest.raises(Exception, match=fault):
            cohort.discover(spark, folder(name, *files)).collect()
    folder("two/x/a", "a_1.fq.gz", "a_2.fq.gz")
    with pytest.raises(Exception, match="two folders"):
        cohort.discover(spark, folder("two/y/a", "a_1.fq.gz", "a_2.fq.gz")).collect()


def test_sorted_fragments_and_digest(spark, tmp_path):
    d = spark.range(100).select((F.col("id") % 3).alias("chrom"), (100 - F.col("id")).alias("start"), (101 - F.col("id")).alias("end"), F.lit("x").alias("cell"))
    writers.write_sorted(d, str(tmp_path / "f"), 4)
    back = spark.read.parquet(str(tmp_path / "f"))
    assert writers.digest(back.select(*d.columns)).first() == writers.digest(d).first()
    assert writers.empty_like(d).schema == d.schema


def test_stream_sessions_equal_batch(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    events.repartition(1).sortWithinPartitions("ts").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))
    q = sessions.stream_sessions(stream).writeStream.format("memory").queryName("s").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).start()
    q.processAllAvailable()
    q.stop()
    closed = {tuple(r) for r in spark.table("s").collect()}
    batch = {tuple(r) for r in sessions.gap_sessions(events).collect()}
    assert closed and closed <= batch
    unique = sessions.stream_dedup(stream, ["event_id"]).writeStream.format("memory").queryName("u").outputMode("append").option("checkpointLocation", str(tmp_path / "d")).start()
    unique.processAllAvailable()
    unique.stop()
    assert spark.table("u").count() == events.select("event_id").distinct().count()


def test_long_lines_are_whole(spark, tmp_path):
    """More tags, longer values and more segments than any bound of old."""
    tags = [f"{a}{b}:Z:{a}{b}" for a in "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghij" for b in "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"]
    line = "\t".join(["q", "0", "c", "1", "60", "4M", "*", "0", "0", "ACGT", "IIII", *tags[1:], "AA:Z:" + "x" * 1_500_000])
    r = readers.read_sam(spark, put(tmp_path, "a.sam", line + "\n")).select(F.size("tags").alias("n"), F.length(F.col("tags")["AA"]).alias("long")).first()
    assert (r.n, r.long) == (len(tags), 1_500_000) and len(tags) > 1240
    plain = readers.read_sam(spark, put(tmp_path, "b.sam", "q\t0\tc\t1\t60\t4M\t*\t0\t0\tACGT\tIIII\n")).first()
    assert plain.tags == {}
    seg = "r\t" + "\t".join(["c!1!9!+!.!60!1!R1"] * 1_000_500)
    assert readers.read_segments(spark, put(tmp_path, "a.seg", seg + "\n")).select(F.size("segs")).first()[0] == 1_000_500


def test_snp_table_faults(spark, tmp_path):
    rows = [("c1", 5), ("c1", 9), ("c2", 4), ("c2", 3), ("c1", 20), ("c3", 1)]
    text = "#x\n" + "".join(f"{c}\t{p}\tA\tC\n" for c, p in rows) + "c3\t2\tAA\tC\n"
    p = put(tmp_path, "a.tsv", text)
    assert tuple(readers.snp_table_faults(spark, p).first()) == (7, 1, 1, 1)
    spark.conf.set("spark.sql.files.maxPartitionBytes", 16)  # splits of a line or two
    try:
        assert tuple(readers.snp_table_faults(spark, p).first()) == (7, 1, 1, 1)
        fasta = put(tmp_path, "a.fa", ">s1 x\nACGTAC\nGG\nTTTTTT\nA\n>s2\nT\nCCCCCCCCCCCCCCCCCCCCCCCC\nG\n")
        got = sorted(tuple(r) for r in readers.read_fasta(spark, fasta).collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == [("s1", 0, "ACGTAC", 0), ("s1", 1, "GG", 6), ("s1", 2, "TTTTTT", 8), ("s1", 3, "A", 14), ("s2", 0, "T", 0), ("s2", 1, "C" * 24, 1), ("s2", 2, "G", 25)]


def test_first_records(spark, tmp_path):
    import hashlib

    record = "@r1 c\nACGT\n+\nIIII\n"
    with gzip.open(tmp_path / "a.fq.gz", "wt") as f:
        f.write(record + "@r2\nGG\n+\nII\n")
    assert readers.first_records(spark, str(tmp_path / "a.fq.gz")).first().sha256 == hashlib.sha256(record.encode()).hexdigest()
    for text, fault in (("@r\nAC\n", "truncated"), ("r\nAC\n+\nII\n", "invalid"), ("@r\n\n+\n\n", "empty sequence"), ("@r\nACG\n+\nII\n", "differ in length")):
        with pytest.raises(Exception, match=fault):
            readers.first_records(spark, put(tmp_path, "x.fq", text)).collect()
    tab = put(tmp_path, "a.tab", 'r1\tACG\tAC"GT\tII"I\n')
    assert tuple(readers.read_tabfastq(spark, tab).first()) == ("r1", "ACG", 'AC"GT', 'II"I')


def test_contract(spark, tmp_path):
    import hashlib
    import json

    def write(**changed):
        core = {"schema_version": 2, "samples": [{"sample_name": n, "safe_code": "C" + c * 16} for n, c in (("a", "0"), ("b", "f"))]} | changed
        digest = hashlib.sha256(json.dumps(core, sort_keys=True, separators=(",", ":")).encode()).hexdigest()
        return put(tmp_path, "c.json", json.dumps({"contract_sha256": digest, **core}, indent=1))

    assert [tuple(r) for r in readers.read_contract(spark, write(), 2).orderBy("ord").collect()] == [("a", "C" + "0" * 16, 0), ("b", "C" + "f" * 16, 1)]
    code = lambda c: "C" + c * 16
    for changed, fault in (
        ({"schema_version": 3}, "unknown version"),
        ({"contract_sha256": "0"}, "checksum"),
        ({"samples": []}, "no samples"),
        ({"samples": [{"sample_name": "b", "safe_code": code("0")}, {"sample_name": "a", "safe_code": code("1")}]}, "out of order"),
        ({"samples": [{"sample_name": "a", "safe_code": code("0")}, {"sample_name": "b", "safe_code": code("0")}]}, "repeated codes"),
        ({"samples": [{"sample_name": "a", "safe_code": "Cx"}]}, "bad or repeated"),
    ):
        with pytest.raises(ValueError, match=fault):
            readers.read_contract(spark, write(**changed), 2)


def test_small_readers_and_writers(spark, tmp_path):
    bed = put(tmp_path, "a.bed", "#x\nc\t1\t9\tr\t60\t-\n")
    assert tuple(readers.read_bed6(spark, bed).first()) == ("c", 1, 9, "r", 60, "-") and tuple(readers.read_bed3(spark, bed).first()) == ("c", 1, 9)
    dg = put(tmp_path, "a.3dg", "c\t100\t1.5\t-2\t0\n")
    assert tuple(readers.read_particles(spark, dg).drop("structure").first()) == ("c", 100, 1.5, -2.0, 0.0)
    assert tuple(readers.read_fai(spark, put(tmp_path, "a.fai", "c\t99\t3\t60\t61\n")).first()) == ("c", 99)
    assert tuple(readers.read_stat(spark, put(tmp_path, "a.stat", "x/y\t7\n")).first()) == ("x/y", 7)
    d = spark.createDataFrame([("b", 2, None), ("a", 5, 1.5), ("a", 1, 2.0)], "chrom string, pos long, v double")
    writers.write_tsv(d.coalesce(1), str(tmp_path / "t"))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "t")).collect()) == ["a\t1\t2.0", "a\t5\t1.5", "b\t2\tNA", "chrom\tpos\tv"]
    writers.write_by_chromosome(d, str(tmp_path / "p"))
    assert sorted(x.name for x in (tmp_path / "p").iterdir() if x.name.startswith("chrom")) == ["chrom=a", "chrom=b"]
    assert [r.pos for r in spark.read.parquet(str(tmp_path / "p" / "chrom=a")).collect()] == [1, 5]
    assert [r.value for r in writers.pairs_header(spark.createDataFrame([("c", 9)], "chrom string, size long")).collect()] == ["#chromosome: c 9"]
