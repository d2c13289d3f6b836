"""BAM files: whole and in splits of any size, against the SAM reader and plain rows."""

import random
import struct

import pytest
from pyspark.sql import functions as F

from cytoflux.sources import bam, readers

CHROMS = [("chr1", 10_000), ("chr2", 5_000), ("chrUn_x", 70)]


def made(n, seed=1):
    r = random.Random(seed)
    out = []
    for i in range(n):
        length = r.choice((0, 1, 7, 50, 151, 4000 if i % 40 == 0 else 30))
        seq, mapped = "".join(r.choices("ACGTN", k=length)), r.random() < 0.9
        cigar = "*" if not mapped or length < 10 else f"3S{length - 8}M2I1D3M"
        tags = {"NH": str(r.randrange(5)), "XT": r.choice(["geneA,geneB", "g", "-7", "007"])} if r.random() < 0.7 else {}
        out.append((f"read{i}:{r.randrange(99)}", 0 if mapped else 4, r.choice(CHROMS)[0] if mapped else "*", r.randrange(9000) if mapped else -1, r.randrange(61), cigar, "*", -1, r.randrange(-300, 300), seq or "*", "".join(chr(33 + r.randrange(42)) for _ in seq) or "*", tags))
    return out


def put(path, alignments, most=0xFF00):
    number = {c: i for i, (c, _) in enumerate(CHROMS)}
    data = bam.header_bytes(CHROMS) + b"".join(bam.alignment_bytes(a, number) for a in alignments)
    path.write_bytes(bam.compressed(data, most) + bam._EOF)
    return str(path)


@pytest.mark.parametrize("most", [300, 5000, 0xFF00])
def test_splits_of_any_size_give_each_row_once(tmp_path, most):
    """Alignments lie across blocks, and blocks across splits."""
    want = made(400)
    path = put(tmp_path / "a.bam", want, most)
    size = (tmp_path / "a.bam").stat().st_size
    assert bam.header(path)[0] == CHROMS and list(bam.rows(path, 0, size)) == want
    for step in (size // 2 + 1, size // 7, 1000, 333):
        got = [x for a in range(0, size, step) for x in bam.rows(path, a, min(a + step, size))]
        assert got == want


def test_empty_short_and_damaged_files(tmp_path):
    assert list(bam.rows(put(tmp_path / "e.bam", []), 0, 1 << 30)) == []
    one = made(1)
    path = put(tmp_path / "o.bam", one)
    assert list(bam.rows(path, 0, 1 << 30)) == one and list(bam.rows(path, 5, 1 << 30)) == []
    raw = (tmp_path / "o.bam").read_bytes()
    (tmp_path / "d.bam").write_bytes(raw[:40] + bytes([raw[40] ^ 255]) + raw[41:])
    with pytest.raises(Exception, match="block|decompress|Error|invalid"):
        list(bam.rows(str(tmp_path / "d.bam"), 0, 1 << 30))
    number = {c: i for i, (c, _) in enumerate(CHROMS)}
    cut = bam.header_bytes(CHROMS) + bam.alignment_bytes(made(3)[2], number)[:-3]
    (tmp_path / "t.bam").write_bytes(bam.compressed(cut) + bam._EOF)
    with pytest.raises(ValueError, match="truncated"):
        list(bam.rows(str(tmp_path / "t.bam"), 0, 1 << 30))
    (tmp_path / "n.bam").write_bytes(bam.compressed(b"no header at all") + bam._EOF)
    with pytest.raises(ValueError, match="no BAM"):
        bam.header(str(tmp_path / "n.bam"))


def test_tags_of_all_types(tmp_path):
    number = {c: i for i, (c, _) in enumerate(CHROMS)}
    row = made(3)[1][:-1]
    body = bam.alignment_bytes((*row, {}), number)[4:]
    body += b"XaAq" + b"Xbc" + struct.pack("<b", -3) + b"XCC" + bytes([200]) + b"Xss" + struct.pack("<h", -300) + b"XSS" + struct.pack("<H", 60_000) + b"XiI" + struct.pack("<I", 4_000_000_000) + b"Xff" + struct.pack("<f", 1.5) + b"XHH1AFF\0" + b"XBBs" + struct.pack("<ihh", 2, -1, 9)
    (tmp_path / "x.bam").write_bytes(bam.compressed(bam.header_bytes(CHROMS) + struct.pack("<i", len(body)) + body) + bam._EOF)
    got = list(bam.rows(str(tmp_path / "x.bam"), 0, 1 << 30))[0][-1]
    assert got == {"Xa": "q", "Xb": "-3", "XC": "200", "Xs": "-300", "XS": "60000", "Xi": "4000000000", "Xf": "1.5", "XH": "1AFF", "XB": "s,-1,9"}


def test_source_equals_the_sam_reader(spark, tmp_path):
    """Written by tasks, read in small splits, with tags stripped; only wanted columns are decoded."""
    bam.register(spark)
    want = made(300, 5)
    d = spark.createDataFrame(want, bam.SCHEMA)
    out = str(tmp_path / "cohort")
    d.repartition(3).write.format("bam").option("chromosomes", ",".join(f"{c}:{n}" for c, n in CHROMS)).mode("append").save(out)
    got = spark.read.format("bam").option("splitBytes", 2000).load(out)
    plain = lambda row: str([sorted(v.items()) if isinstance(v, dict) else v for v in row])
    key = lambda rows: sorted(map(plain, rows))
    assert key(tuple(x) for x in got.collect()) == key(want)
    sam = tmp_path / "a.sam"
    sam.write_text("@SQ\tSN:chr1\tLN:10000\n" + "".join("\t".join(map(str, [q, f, c, s + 1, m, g, mc, ms + 1, i, seq, qual, *[f"{k}:Z:{v}" for k, v in t.items()]])) + "\n" for q, f, c, s, m, g, mc, ms, i, seq, qual, t in want))
    columns = ["qname", "flag", "chrom", "start", "mapq", "cigar", "seq", "qual", "tags"]
    assert key(tuple(x) for x in got.select(*columns).collect()) == key(tuple(x) for x in readers.read_sam(spark, str(sam)).select(*columns).collect())
    few = spark.read.format("bam").option("columns", "chrom,start").load(out)
    assert few.where("seq IS NULL AND tags IS NULL AND qname IS NULL").count() == 300
    assert few.groupBy("chrom").agg(F.count("*").alias("n")).count() == len({w[2] for w in want})
