"""End trimming, natural order, symmetric blocks, particle support, publishing, stream islands, receipts and configurations, against plain Python."""

import datetime as dt
import functools
import hashlib
import json
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from cytoflux.functions import names as N
from cytoflux.operators import adapters, cohort, qc, structure
from cytoflux.plans import workflows as P
from cytoflux.sources import publish, writers


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


# 3' ends of reads


def cut_plainly(read, adapter, rate, least):
    n, m = len(read), len(adapter)
    table = [[(0, 0)] * (n + 1) for _ in range(m + 1)]
    for j in range(n + 1):
        table[0][j] = (0, j)
    for i in range(1, m + 1):
        table[i][0] = (i, 0)
    for j in range(1, n + 1):
        for i in range(1, m + 1):
            same = adapter[i - 1] in ("N", read[j - 1])
            (e1, s1), (e2, s2), (e3, s3) = table[i - 1][j - 1], table[i][j - 1], table[i - 1][j]
            table[i][j] = min((e1 + (not same), s1), (e2 + 1, s2), (e3 + 1, s3))
    best = None
    for i, j in [(m, j) for j in range(1, n + 1)] + ([(i, n) for i in range(max(least, 1), m)] if n else []):
        errors, start = table[i][j]
        if errors <= rate * (i - adapter[:i].count("N")):
            key = (i - 2 * errors, -start)
            best = key if best is None or key > best else best
    return -best[1] if best else -1


def test_end_cuts_by_plain_tables():
    """10,000 reads with whole, partial, damaged and absent adapters."""
    r = random.Random(4)
    for adapter, rate, least in (("AAAANNNCATTGCG", 0.1, 3), ("AGATCGGAAGAGC", 0.2, 4), ("ACGT", 0.0, 1), ("AAAAAAAAAANNCATTGCGCAAT", 0.1, 3)):
        reads = [None, "", adapter, adapter[:5], "N" * 20]
        while len(reads) < 2500:
            body = "".join(r.choices("ACGT", k=r.randrange(0, 25)))
            part = [r.choice("ACGT") if c == "N" else c for c in adapter[: r.randrange(len(adapter) + 1)]]
            for _ in range(r.choice((0, 0, 1, 2))):
                if part:
                    k = r.randrange(len(part))
                    r.choice((lambda k=k, part=part: part.pop(k), lambda k=k, part=part: part.insert(k, r.choice("ACGT")), lambda k=k, part=part: part.__setitem__(k, r.choice("ACGTN"))))()
            reads.append(body + "".join(part) + "".join(r.choices("ACGT", k=r.choice((0, 0, 3, 9)))))
        got = adapters.end_cuts(reads, adapter, rate, least)
        assert got.tolist() == [cut_plainly(x or "", adapter, rate, least) for x in reads]


def tail_plainly(read, base, least, rate=0.2):
    best, n, total, others = 0, 0, 0, 0
    for k, c in enumerate(reversed(read), 1):
        total, others = total + (1 if c == base else -2), others + (c != base)
        if total > best and others <= rate * k:
            best, n = total, k
    return n if n >= least else 0


def test_tails_by_plain_sums():
    r = random.Random(5)
    reads = ["".join(r.choices("ACGT", weights=(w, 1, 1, 1), k=r.randrange(40))) for w in (1, 3, 9, 30) for _ in range(500)] + [None, "A" * 30]
    assert adapters.tail_lengths(reads, "A").tolist() == [tail_plainly(x or "", "A", 3) for x in reads]


def test_reads_are_trimmed_with_their_qualities(spark):
    d = spark.createDataFrame([(1, "ACGTTAGATCGGAAG", "0123456789abcde"), (2, "AGATCGGAAGAGCTT", "0123456789abcde"), (3, "CCCC", "0123"), (4, None, None)], "id int, seq string, qual string")
    t = adapters.trim_adapter_end(d, "AGATCGGAAGAGC", qual="qual")
    assert sorted((tuple(x) for x in t.collect()), key=str) == [(1, "ACGTT", "01234"), (2, "", ""), (3, "CCCC", "0123"), (4, None, None)]
    assert rows(adapters.trim_adapter_end(d, "AGATCGGAAGAGC", minimum=1), "id") == [(1,), (3,)]
    p = spark.createDataFrame([(1, "ACGTAAAAA", "012345678"), (2, "TTTTTGGC", "01234567"), (3, "AAAA", "0123")], "id int, seq string, qual string")
    assert rows(adapters.trim_poly(p, qual="qual"), "id", "seq", "qual") == [(1, "ACGT", "0123"), (2, "TTTTTGGC", "01234567"), (3, "", "")]
    assert rows(adapters.trim_poly(p, "T", head=True, qual="qual", minimum=4), "id", "seq", "qual") == [(1, "ACGTAAAAA", "012345678"), (3, "AAAA", "0123")]


# Natural order


def compared(a, b):
    """A pairwise comparison: runs of digits as numbers where both have one, else characters."""
    x, y = (re.findall(r"[0-9]+|[^0-9]", s) for s in (a, b))
    for p, q in zip(x, y, strict=False):
        if p[0].isdigit() and q[0].isdigit() and p[0] in "0123456789" and q[0] in "0123456789":
            if int(p) != int(q):
                return -1 if int(p) < int(q) else 1
        elif p[0] != q[0]:
            return -1 if p[0] < q[0] else 1
    return (len(x) > len(y)) - (len(x) < len(y))


def test_natural_order_by_pairwise_comparison(spark):
    r = random.Random(7)
    bits = ["0", "1", "7", "10", "007", "123456789012345678901234567890", "a", "b", ":", "-", ".", "_", "é", "日", "A"]
    names = ["", "a", "a1", "a01", "a1b", "x9", "x10", "x9.2", "x9-2"] + ["".join(r.choices(bits, k=r.randrange(7))) for _ in range(400)]
    d = spark.createDataFrame([(n,) for n in names], "name string").withColumn("key", N.natural_key(F.col("name")))
    by_key = [x["name"] for x in d.repartition(4).orderBy("key", "name").collect()]
    assert by_key == sorted(sorted(names), key=functools.cmp_to_key(compared))
    keys = {x["name"]: x["key"] for x in d.collect()}
    assert all((keys[a] > keys[b]) - (keys[a] < keys[b]) == compared(a, b) for a in names[:80] for b in names[:80])


def test_names_out_of_natural_order(spark):
    d = spark.createDataFrame([("f", k, n) for k, n in enumerate(["r2", "r10", "r010", "r9"])] + [("g", 0, "a")], "file string, ord int, name string")
    assert rows(qc.natural_order_faults(d, ["file"], "ord"), "ord", "name") == [(3, "r9")]
    assert qc.in_natural_order(d.where("ord < 3"), ["file"], "ord").count() == 4
    with pytest.raises(Exception, match="natural order"):
        qc.in_natural_order(d, ["file"], "ord").collect()


# Contact matrices and particles


@pytest.mark.parametrize("width", [4, 7, 256])
def test_symmetric_product_equals_the_dense_one(spark, width):
    """Either half, both halves and repeats of contacts give the product with the whole matrix."""
    r = np.random.default_rng(3)
    n, want = 30, {}
    pairs = [(c, int(a), int(b), int(k)) for c in ("x", "y") for a, b, k in r.integers(0, [n, n, 3], (120, 3))]
    cpg = {(c, b): float(r.random()) for c in ("x", "y") for b in range(n + 3)}
    for c in ("x", "y"):
        m = np.zeros((n + 3, n + 3))
        for d, a, b, k in pairs:
            if d == c and k > 0:
                m[a, b] = m[b, a] = 1
        x = np.array([cpg[c, b] for b in range(n + 3)])
        want |= {(c, b): s for b, s in enumerate(m @ x / (m.sum(axis=0) + 1))}
    p = spark.createDataFrame(pairs + pairs[:20], "chrom string, bin1 long, bin2 long, n long")
    v = spark.createDataFrame([(*k, s) for k, s in cpg.items()], "chrom string, bin long, cpg double")
    got = {(x.chrom, x.bin): x.score for x in structure.symmetric_compartment_score(p, v, width).collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)
    blocks = structure.contact_blocks(p, width)
    assert blocks.where("block1 > block2").count() == 0
    assert structure.symmetric_compartment_score(p.where("false"), v, width).where("score <> 0").count() == 0


def test_particle_support_by_brute_force(spark):
    r = random.Random(8)
    parts = [(s, r.choice("ab"), r.randrange(4000)) for s in (0, 1) for _ in range(150)]
    cons = [(r.choice("ab"), r.randrange(4000), r.choice("abz"), r.randrange(4000)) for _ in range(300)]
    legs = [(c, p) for x in cons for c, p in (x[:2], x[2:])]
    want = {(s, c, p): sum(d == c and abs(q - p) <= 90 for d, q in legs) for s, c, p in parts}
    p = spark.createDataFrame(parts, "structure int, chrom string, pos long")
    c = spark.createDataFrame(cons, "chr1 string, pos1 long, chr2 string, pos2 long")
    both = c.select(F.explode(F.array(*[F.struct(F.col(f"chr{k}").alias("chrom"), F.col(f"pos{k}").alias("pos")) for k in (1, 2)])).alias("l")).select("l.*")
    got = structure.leg_support(p, both, 90, ["chrom"], segment_width=100)
    assert rows(got, "structure", "chrom", "pos", "support") == sorted((*k, want[k]) for k in parts)
    kept = {tuple(x)[:3]: x.kept for x in structure.clean_particles(p, c, 90, 0.2).select("structure", "chrom", "pos", "kept").collect()}
    for s in (0, 1):
        bound = np.percentile([want[k] for k in parts if k[0] == s], 20)
        assert all(kept[k] == (want[k] > bound) for k in parts if k[0] == s)
    none = structure.clean_particles(p, c.where("false"), 90)
    assert none.where("kept OR support <> 0").count() == 0


def test_rmsd_table_has_every_cell_in_order(spark):
    cells = spark.createDataFrame([("b", 1), ("a", 0)], "cell string, ord int")
    v = spark.createDataFrame([("a", "20k", 1.5), ("b", "1m", 2.0)], "cell string, resolution string, rmsd double")
    t = structure.rmsd_table(cells, v, ["20k", "1m"]).orderBy("ord", "at")
    assert [tuple(x)[0:1] + tuple(x)[3:] for x in t.collect()] == [("a", "20k", "1.5"), ("a", "1m", "NA"), ("b", "20k", "NA"), ("b", "1m", "2.0")]
    with pytest.raises(Exception, match="no cell"):
        structure.rmsd_table(cells, v.union(spark.createDataFrame([("z", "1m", 1.0)], v.schema)), ["20k", "1m"]).collect()


# Publishing


def test_outputs_are_published_together(spark, tmp_path):
    folder = str(tmp_path / "out")
    base = spark.range(100).select("id", (F.col("id") % 3).alias("k"))
    outputs = {"small": lambda d: d.where("k = 0").select("id"), "sums": lambda d: d.groupBy("k").agg(F.count("*").alias("n"))}
    with pytest.raises(FileNotFoundError):
        publish.published(spark, folder, "small")
    told = publish.publish(base, outputs, folder, {"sample": "s1"}, {"ids": F.sum("id")})
    assert (told["sample"], told["ids"], told["small_rows"], told["sums_rows"]) == ("s1", 4950, 34, 3)
    assert publish.summary_of(spark, folder)["small_hash_xor"] == told["small_hash_xor"]
    assert rows(publish.verified(spark, folder, ["small", "sums"]), "output", "rows", "whole") == [("small", 34, True), ("sums", 3, True)]
    # A run that is lost at any step leaves the outputs of the one before.
    for step in ("sums", "summary", "pointer"):
        def lost(name, step=step):
            if name == step:
                raise RuntimeError("lost")

        with pytest.raises(RuntimeError, match="lost"):
            publish.publish(base.where("id < 10"), outputs, folder, {"sample": "s2"}, before=lost)
        assert publish.summary_of(spark, folder)["sample"] == "s1" and publish.published(spark, folder, "small").count() == 34
    publish.publish(base.where("id < 10"), outputs, folder, {"sample": "s2"})
    assert publish.summary_of(spark, folder)["sample"] == "s2" and publish.published(spark, folder, "small").count() == 4
    publish.publish(base.where("false"), outputs, folder, {"sample": "s3"})
    assert publish.published(spark, folder, "small").count() == 0 and rows(publish.verified(spark, folder, ["small"]), "whole") == [(True,)]


def test_snp_index_fits_its_manifest(spark, tmp_path):
    path = str(tmp_path / "index")
    s = spark.createDataFrame([("chr1", 5, "A", "C"), ("chr1", 3, "G", "T"), ("chr2", 9, "A", "T")], "chrom string, pos long, a0 string, a1 string")
    writers.write_snp_index(s, path, 4)
    assert rows(spark.read.json(f"{path}/manifest"), "chrom", "count", "first_pos", "last_pos", "source_skipped_rows") == [("chr1", 2, 3, 5, 4), ("chr2", 1, 9, 9, 4)]
    assert rows(writers.read_snp_index(spark, path), "chrom", "pos", "a0", "a1") == [("chr1", 3, "G", "T"), ("chr1", 5, "A", "C"), ("chr2", 9, "A", "T")]
    writers.write_by_chromosome(s.withColumn("a1", F.when(F.col("pos") == 9, "G").otherwise(F.col("a1"))), f"{path}/snps")
    with pytest.raises(ValueError, match="chr2"):
        writers.read_snp_index(spark, path)


# Streams


@pytest.fixture
def state_store(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    old = spark.conf.get(key)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    yield
    spark.conf.set(key, old)


@pytest.mark.parametrize("batches", [1, 3, 12])
def test_stream_islands_equal_the_batch(spark, state_store, tmp_path, batches):
    """Events out of order within the watermark, dealt to any number of micro-batches."""
    from cytoflux.streaming.islands import islands_of, stream_islands

    r = random.Random(9)
    start = dt.datetime(2024, 1, 1)
    times = sorted(r.choices(range(0, 200_000), k=300))
    events = [(r.choice("ab"), start + dt.timedelta(seconds=t), f"e{i:03}") for i, t in enumerate(times)]
    last = [("z", start + dt.timedelta(days=30), "end")]
    schema = "user string, ts timestamp, id string"
    chunks = np.array_split(np.arange(len(events)), batches)
    for k, part in enumerate(chunks):
        own = [events[i] for i in part]
        r.shuffle(own)
        spark.createDataFrame(own, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in" / f"{k:02}"))
    spark.createDataFrame(last, schema).coalesce(1).write.parquet(str(tmp_path / "in" / "98"))
    spark.createDataFrame([("z", start + dt.timedelta(days=60), "end")], schema).coalesce(1).write.parquet(str(tmp_path / "in" / "99"))
    import os
    import time

    for k, name in enumerate(sorted(os.listdir(tmp_path / "in"))):  # files are taken by age
        for f in os.listdir(tmp_path / "in" / name):
            os.utime(tmp_path / "in" / name / f, (time.time() - 1000 + k, time.time() - 1000 + k))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in" / "*"))
    got = stream_islands(stream, ["user"], gap_seconds=1800, late="3 days", row_id="id")
    q = got.writeStream.format("memory").queryName(f"islands{batches}").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    q.awaitTermination(240)
    want = rows(islands_of(spark.createDataFrame(events, schema), ["user"], gap_seconds=1800, row_id="id"), "user", "n", "first_ts", "last_ts", "first_id")
    assert rows(spark.table(f"islands{batches}").where("user <> 'z'"), "user", "n", "first_ts", "last_ts", "first_id") == want
    by_hand = []
    for u in "ab":
        own = [(t, i) for v, t, i in events if v == u]
        for k, (t, i) in enumerate(own):
            if k and (t - own[k - 1][0]).total_seconds() <= 1800:
                by_hand[-1][1:4:2] = [by_hand[-1][1] + 1, t]
            else:
                by_hand.append([u, 1, t, t, i])
    assert want == sorted(tuple(x) for x in by_hand)


# Contracts, receipts and configurations


def test_normalized_contract_hash(spark):
    cells = [{"sample_name": f"s.{k}-x", "safe_code": f"C{k}", "r1_bytes": 10 + k, "r1_first_record_sha256": "ab", "r2_bytes": 20 + k, "r2_first_record_sha256": "cd"} for k in range(11)]
    want = hashlib.sha256(json.dumps(cells, sort_keys=True, separators=(",", ":")).encode()).hexdigest()
    d = spark.createDataFrame([{**c, "ord": k} for k, c in enumerate(cells)]).repartition(5)
    assert [qc.normalized_contract_hash(d, fan).first().sha256 for fan in (3, 4096)] == [want, want]


def test_receipt_and_totals(spark):
    cells = spark.createDataFrame([("one", "Ca", 0), ("two", "Cb", 1), ("three", "Cc", 2)], "sample_name string, safe_code string, ord int")
    seen = spark.createDataFrame([("Cb",), ("Cb",)], "cell_code string")
    r = cohort.matrix_receipt(cells, seen, 7, "abc").first().asDict()
    assert r == {"contract_sha256": "abc", "expected_cells": 3, "observed_cells": 1, "missing_cells_filled_zero": 2, "unexpected_cells": 0, "missing_cell_codes": "Ca,Cc", "missing_cell_names": "one,three", "feature_rows": 7, "cell_column_contract": "PASS"}
    assert cohort.matrix_receipt(cells, cells.select(F.col("safe_code").alias("cell_code")), 7, "abc").first().missing_cell_codes == "none"
    with pytest.raises(Exception, match="no cell"):
        cohort.matrix_receipt(cells, spark.createDataFrame([("Cz",)], "cell_code string"), 7, "abc").collect()
    reads = spark.createDataFrame([("a", "Assigned"), ("a", "Unassigned_NoFeatures"), ("a", None)], "cell string, xs string")
    own = spark.createDataFrame([("a",), ("b",)], "cell string")
    assert rows(qc.assigned_totals(reads, own), "cell", "total", "assigned") == [("a", 3, 1), ("b", 0, 0)]
    with pytest.raises(Exception, match="not in the cohort"):
        qc.assigned_totals(reads.union(spark.createDataFrame([("z", None)], reads.schema)), own).collect()


def test_places_of_rows(spark):
    d = spark.createDataFrame([(k * 7919 % 5000,) for k in range(5000)], "v int").repartition(6)
    got = cohort.with_order(d, ("v",), 1)
    assert rows(got, "v", "ord") == [(k, k + 1) for k in range(5000)]


CONFIG = {**P.FROZEN, "rna_output_types": ["r1_all", " r1_compatible"], "rna_primary_output_type": "r1_all"}


def test_configuration_files(spark, tmp_path):
    (tmp_path / "base.json").write_text(json.dumps(CONFIG))
    (tmp_path / "over.json").write_text(json.dumps({"rna_align_ends_type": "EndToEnd", "other": {"a": 1}}))
    found = P.config_of(spark, str(tmp_path / "base.json"), [str(tmp_path / "over.json")], ["rna_primary_output_type=r1_compatible"])
    assert (found["rna_align_ends_type"], found["rna_output_types"], found["rna_primary_output_type"], found["other"]) == ("EndToEnd", ["r1_all", "r1_compatible"], "r1_compatible", {"a": 1})
    pytest.importorskip("yaml")
    (tmp_path / "base.yaml").write_text("a:\n  b: 1\n  c: [x, y]\n")
    assert P.read_config(spark, str(tmp_path / "base.yaml")) == {"a": {"b": 1, "c": ["x", "y"]}}
    (tmp_path / "list.yaml").write_text("- a\n")
    with pytest.raises(ValueError, match="no mapping"):
        P.read_config(spark, str(tmp_path / "list.yaml"))


@pytest.mark.parametrize(
    ("change", "fault"),
    [
        ({"cuttag_fragments": {**P.FROZEN["cuttag_fragments"], "min_mapq": 30}}, "min_mapq"),
        ({"cuttag_fragments": {**P.FROZEN["cuttag_fragments"], "allow_opposite_end_clipping": 1}}, "allow_opposite"),
        ({"rna_gene_compatibility": {}}, "rna_gene_compatibility"),
        ({"rna_align_ends_type": "Global"}, "rna_align_ends_type"),
        ({"rna_output_types": []}, "rna_output_types"),
        ({"rna_output_types": ["r1_all", "r1_all "]}, "different"),
        ({"rna_output_types": ["r1_all", "x"]}, "different"),
        ({"rna_primary_output_type": "r1r2_concordant"}, "primary"),
    ],
)
def test_configurations_that_are_refused(change, fault):
    with pytest.raises(ValueError, match=fault):
        P.checked_config({**CONFIG, **change})


# Components and UMIs


def test_components_of_chains_and_stars(spark):
    from cytoflux.operators.graph import components

    r = random.Random(11)
    links = [(k, k + 1) for k in range(500)] + [(1000, k) for k in range(1001, 1100)] + [(r.randrange(2000, 2400), r.randrange(2000, 2400)) for _ in range(150)] + [(7, 7)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        if a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    got = dict(rows(components(spark.createDataFrame(links, "a long, b long")), "node", "root"))
    assert got == {x: find(x) for x in list(root)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def umis_plainly(counts):
    order, seen, n = sorted(counts, key=lambda u: (-counts[u], u)), set(), 0
    for u in order:
        if u in seen:
            continue
        n += 1
        todo = [u]
        seen.add(u)
        while todo:
            a = todo.pop()
            for b in counts:
                if b not in seen and len(a) == len(b) and sum(x != y for x, y in zip(a, b, strict=True)) == 1 and counts[a] >= 2 * counts[b] - 1:
                    seen.add(b)
                    todo.append(b)
    return n


def test_directional_clusters_by_brute_force(spark):
    from cytoflux.operators import rna

    r, reads, want = random.Random(12), [], {}
    for g in range(40):
        counts = {}
        for _ in range(r.randrange(1, 60)):
            counts["".join(r.choices("AC" if g % 2 else "ACGT", k=5))] = r.choice((1, 1, 1, 2, 3, 5, 9))
        want[g % 7 if g > 35 else g + 10, None if g == 3 else "x"] = umis_plainly(counts)
        reads += [(g % 7 if g > 35 else g + 10, None if g == 3 else "x", u) for u, n in counts.items() for _ in range(n)]
    got = rna.directional_umis(spark.createDataFrame(reads, "cell int, gene string, umi string"), ["cell", "gene"])
    assert {(x.cell, x.gene): x.n for x in got.collect()} == want


# Peaks


def test_poisson_tails():
    """By exact fractions for small rates, and by the sum from the other side for depths below the rate."""
    from fractions import Fraction

    from cytoflux.operators.peaks import tail_scores

    for rate in (0.01, 0.5, 3.0, 40.0):
        for k in (0, 1, 2, 5, 30, 41, 60):
            term, below = Fraction(1), Fraction(0)
            for i in range(k):
                below += term
                term = term * Fraction(rate) / (i + 1)
            above, i = Fraction(0), k
            while i < k + 400:
                above += term
                i += 1
                term = term * Fraction(rate) / i
            p = above / (above + below)
            log_p = np.log10(p.numerator / p.denominator) if p > Fraction(1, 10**300) else 0
            assert tail_scores(np.array([k]), np.array([rate]))[0] == pytest.approx(-log_p, rel=1e-9, abs=1e-9)


def test_peaks_of_a_crowded_place(spark):
    from cytoflux.operators import peaks

    r = random.Random(13)
    f = [("c", s, s + 50) for s in (r.randrange(200_000) for _ in range(4000))] + [("c", s, s + 50) for s in (r.randrange(120_000, 120_060) for _ in range(60))]
    d = spark.createDataFrame(f, "chrom string, start long, end long")
    got = peaks.call_peaks(d, ["chrom"], 200_000, cutoff=3.0, segment_width=10_000).collect()
    assert len(got) == 1 and 119_990 <= got[0].start <= 120_030 and 120_060 <= got[0].end <= 120_130 and got[0].start <= got[0].summit < got[0].end
    whole = peaks.call_peaks(d, ["chrom"], 200_000, cutoff=3.0, segment_width=1_000_000).collect()
    assert [tuple(x) for x in got] == [tuple(x) for x in whole]
    assert peaks.call_peaks(d.where("false"), ["chrom"], 200_000).count() == 0


def test_discovery_rates_by_ranks(spark):
    from cytoflux.operators import peaks

    rates = [(k * 10, k * 10 + 1 + k % 3, k % 9, 0.5 + (k % 4)) for k in range(60)]
    d = spark.createDataFrame(rates, "start long, end long, depth long, background double")
    got = {x.start: (x.score, x.q_score) for x in peaks.scored_steps(d).collect()}
    bases = sorted((got[s][0] for s, e, *_ in rates for _ in range(e - s)), reverse=True)
    for s, *_ in rates:
        q = min(10.0**-v * len(bases) / sum(b >= v for b in bases) for v in set(bases) if v <= got[s][0])
        assert got[s][1] == pytest.approx(max(-np.log10(q), 0), abs=1e-9)


# Imputed phases


def test_imputed_phases_by_brute_force(spark):
    from cytoflux.operators import imputation

    r = random.Random(14)
    data = [(r.choice("xy"), i, "a", r.randrange(400), r.choice("ab"), r.randrange(400), r.choice("01..."), r.choice("01...")) for i in range(160)] + [("x", 900, "a", 5000, "b", 5000, ".", "1"), ("x", 901, "a", None, "b", 3, "0", ".")]
    d = spark.createDataFrame(data, "cell string, id int, chr1 string, pos1 long, chr2 string, pos2 long, phase1 string, phase2 string")
    ways = [(a, b) for a in "01" for b in "01"]
    fits = {x[1]: np.array([float(x[6] in (".", a) and x[7] in (".", b)) for a, b in ways]) for x in data}
    p = {i: f / f.sum() for i, f in fits.items()}
    for n in range(1, 4):
        new = {}
        for c, i, c1, p1, c2, p2, *_ in data:
            v = np.zeros(4)
            for e, j, d1, q1, d2, q2, *_ in data:
                if i != j and (c, c1, c2) == (e, d1, d2) and p1 is not None and q1 is not None:
                    dx, dy = abs(p1 // 50 - q1 // 50), abs(p2 // 50 - q2 // 50)
                    if max(dx, dy) <= 1:
                        v += imputation.WEIGHTS[dx + dy] * p[j]
            v = fits[i] * (v + 0.1)
            new[i] = v / v.sum()
        p = new
        got = imputation.impute_phases(d, ["cell"], 50, n, 0.0)
        assert all(np.allclose([x.p00, x.p01, x.p10, x.p11], p[x.id]) for x in got.collect())
    settled = imputation.impute_phases(d, ["cell"], 50, 60, 1e-3)
    assert settled.first().rounds < 60
    for x in imputation.called_phases(settled).collect():
        assert x.phase1 in (".", x.called1) or x.called1 == "."
    assert imputation.impute_phases(d.where("false"), ["cell"], 50).count() == 0


# Regions


def test_regions_open_their_bins_only(spark, tmp_path):
    r = random.Random(15)
    f = [(r.choice("ab"), s, s + r.choice((1, 40, 900 if i % 50 == 0 else 60)), i) for i, s in enumerate(r.randrange(50_000) for _ in range(2000))]
    path = str(tmp_path / "frags")
    writers.write_regions(spark.createDataFrame(f, "chrom string, start long, end long, id int"), path, 1000)
    for chrom, start, end in (("a", 20_000, 20_500), ("b", 0, 1), ("a", 49_990, 60_000), ("b", 999, 1001), ("a", 70_000, 80_000), ("z", 0, 9)):
        got = writers.read_region(spark, path, chrom, start, end)
        assert rows(got, "id") == sorted((i,) for c, s, e, i in f if c == chrom and s < end and e > start)
    region = writers.read_region(spark, path, "a", 20_000, 20_500)
    region.collect()
    leaves = region._jdf.queryExecution().executedPlan().collectLeaves()
    assert [leaves.apply(i).metrics().apply("numFiles").value() for i in range(leaves.size())] == [2]  # of a hundred: where a fragment of 900 bases can begin


def test_phases_across_tiles_and_legs(spark, monkeypatch):
    """Small tiles and legs give what one tile gives, rows of many batches too; lone contacts are not part of the stored state."""
    from cytoflux.operators import imputation

    r = random.Random(32)
    data = [(r.randrange(2), i, "a", r.randrange(-900, 900), "b", r.randrange(900), r.choice("01..."), r.choice("01...")) for i in range(700)] + [(0, 5000, "a", 90_000, "b", 90_000, ".", ".")]
    d = spark.createDataFrame(data, "cell int, id int, chr1 string, pos1 long, chr2 string, pos2 long, phase1 string, phase2 string")
    ids = lambda t: {x.id: ([round(x[w], 9) for w in imputation.WAYS], x.rounds) for x in t.collect()}
    want = ids(imputation.impute_phases(d, ["cell"], 30, 12, 0.02))
    assert len(want) == len(data) and want[5000][0] == [0.25] * 4
    stored = []
    monkeypatch.setattr(imputation, "written", lambda t, name: (w := imputation_written(t, name), stored.append((name, w.count())))[0])
    monkeypatch.setattr(imputation, "LEG", 3)
    assert ids(imputation.impute_phases(d, ["cell"], 30, 12, 0.02)) == want
    assert all(n < len(data) for name, n in stored if name == "phases")


def imputation_written(t, name):
    from cytoflux.sources.scratch import written

    return written(t, name)


def test_umis_meet_by_halves(spark, monkeypatch):
    """Lengths of all kinds by brute force (an empty UMI is near none), and at most two rows are dealt for a UMI."""
    from cytoflux.operators import rna

    r, reads, want = random.Random(33), [], {}
    for g in range(30):
        counts = {"": 1, "A": 1} if g == 5 else {}
        for _ in range(r.randrange(1, 50)):
            counts["".join(r.choices("AC", k=r.randrange(1, 8)))] = r.choice((1, 1, 1, 2, 3, 5))
        want[g] = umis_plainly(counts)
        reads += [(g, u) for u, n in counts.items() for _ in range(n)]
    d = spark.createDataFrame(reads, "gene int, umi string")
    plans, kept = [], rna.written
    monkeypatch.setattr(rna, "written", lambda t, name: (plans.append(t._jdf.queryExecution().executedPlan().toString()), kept(t, name))[1])
    assert {x.gene: x.n for x in rna.directional_umis(d, ["gene"]).collect()} == want
    assert all("Join" not in p for p in plans)  # masks are not joined with masks


def test_umis_meet_in_pieces(spark, monkeypatch):
    """Groups that a piece holds whole are done in it: no base is left out, and little is stored for the clusters to meet."""
    from cytoflux.operators import rna

    r, reads, want = random.Random(34), [], {}
    for g in range(40):
        counts = {"".join(r.choices("ACGT", k=5)): r.choice((1, 1, 1, 1, 2, 3, 9)) for _ in range(120)}
        want[g] = umis_plainly(counts)
        reads += [(g, u) for u, n in counts.items() for _ in range(n)]
    d = spark.createDataFrame(reads, "gene int, umi string")
    plans, tables, kept = {}, {}, rna.written

    def written(t, name):
        plans[name] = t._jdf.queryExecution().executedPlan().toString()
        tables[name] = kept(t, name)
        return tables[name]

    monkeypatch.setattr(rna, "written", written)
    assert {x.gene: x.n for x in rna.directional_umis(d, ["gene"]).collect()} == want
    assert all("Generate" not in plans[name] for name in ("umis", "met"))
    assert tables["met"].count() < tables["umis"].count() / 10


@pytest.mark.parametrize("piece", [1, 60, 700, 9000])
def test_umis_in_pieces_of_any_size(spark, piece):
    """Groups cut anywhere, and halves too large for a piece, by brute force, with keys and letters of all kinds."""
    from cytoflux.operators import rna

    r, reads, want = random.Random(35), [], {}
    letters = ("AC", "ACGT", "ACGTN", "AC\u00e9\U0001f600", "AB")
    for g in range(25):
        counts, seed = {}, "".join(r.choices("AB", k=70))
        for _ in range(r.randrange(1, 70)):
            i = r.randrange(70)
            counts[seed[:i] + r.choice("AB") + seed[i + 1 :] if g % 5 == 4 else "".join(r.choices(letters[g % 5], k=r.randrange(1, 7)))] = r.choice((1, 1, 1, 1, 2, 3, 5))
        key = (None if g == 3 else float("nan") if g == 4 else g / 2, None if g == 7 else (g, "x"))
        want[str(key)] = umis_plainly(counts) + (g == 8) + (g == 9)
        reads += [(*key, u) for u, n in {**counts, **{8: {None: 2}, 9: {"": 1}}.get(g, {})}.items() for _ in range(n)]
    d = spark.createDataFrame(reads, "cell double, gene struct<a: int, b: string>, umi string").repartition(3)
    got = rna.directional_umis(d, ["cell", "gene"], piece).collect()
    assert {str((x.cell, x.gene and tuple(x.gene))): x.n for x in got} == want


def test_links_are_contracted_before_the_rounds(spark):
    from cytoflux.operators import graph

    chain = [(i, i + 1) for i in range(500)] + [(1000 + i, 1000 + (i * 7) % 50) for i in range(50)] + [(3, 3)]
    batches = list(graph._forest(iter(spark.createDataFrame(chain, "a long, b long").toArrow().to_batches())))
    assert sum(b.num_rows for b in batches) <= 549 and all(y == 0 for b in batches for x, y in zip(b["a"].to_pylist(), b["b"].to_pylist(), strict=True) if x < 1000)
    found = {x.node: x.root for x in graph.components(spark.createDataFrame(chain, "a long, b long").repartition(3)).collect()}
    assert all(found[i] == 0 for i in range(501))
