"""Growth: work per row that does not rise with the tables."""

import random

import pytest
from pyspark.sql import functions as F


def test_background_by_brute_force_without_frames(spark):
    from cytoflux.operators import peaks

    r = random.Random(41)
    rows, at = [], {"a": -500, "b": 7}
    for i in range(900):
        c = r.choice("ab")
        at[c] += r.randrange(1, 9)
        rows.append((c, at[c], at[c] + r.randrange(1, 3), r.randrange(1, 30)))
    d = spark.createDataFrame(rows, "chrom string, start long, end long, depth long")
    got = peaks.local_background(d, ["chrom"], (10, 60, 200), 2.5, 100)
    mass = lambda c, s, w: sum(n * (f - b) for k, b, f, n in rows if k == c and abs(b - s) <= w // 2) / w
    assert {(x.chrom, x.start): x.background for x in got.collect()} == {(c, s): max(2.5, *[mass(c, s, w) for w in (10, 60, 200)]) for c, s, *_ in rows}
    assert got.columns == ["chrom", "start", "end", "depth", "background"] and "Window" not in got._jdf.queryExecution().toString()  # a frame is summed anew for each row

def test_peaks_find_their_coverage_once(spark, monkeypatch):
    from cytoflux.operators import peaks

    r, n, kept = random.Random(42), [], peaks.coverage_steps
    f = [("c", s, s + 50) for s in (r.randrange(50_000) for _ in range(500))] + [("c", s, s + 50) for s in range(20_000, 20_060)]
    seen = spark.sparkContext.accumulator(0)

    def counted(*a, **k):
        steps = kept(*a, **k)

        def rows(batches):
            for b in batches:
                seen.add(b.num_rows)
                yield b

        n.append(steps.count())
        return steps.mapInArrow(rows, steps.schema)

    monkeypatch.setattr(peaks, "coverage_steps", counted)
    assert peaks.call_peaks(spark.createDataFrame(f, "chrom string, start long, end long"), ["chrom"], 50_000, cutoff=3.0).count() >= 1
    assert seen.value == n[0]

def test_folders_of_regions_are_few(spark, tmp_path, monkeypatch):
    from cytoflux.sources import writers

    r = random.Random(43)
    f = [(r.choice("ab"), s, s + r.choice((1, 40, 900)), i) for i, s in enumerate(r.randrange(-500, 50_000) for _ in range(400))]
    d = spark.createDataFrame(f, "chrom string, start long, end long, id int")
    for most, least in ((20, 5), (1, 1)):
        monkeypatch.setattr(writers, "FOLDERS", most)
        path = tmp_path / str(most)
        writers.write_regions(d, str(path), 100)
        assert least <= len(list(path.glob("fragments/chrom=*/bin=*"))) <= max(most, 2 * 2)  # starts below 0 have a bin of their own
        for chrom, start, end in (("a", 20_000, 20_500), ("b", -600, 1), ("a", 49_990, 60_000), ("z", 0, 9)):
            got = writers.read_region(spark, str(path), chrom, start, end)
            assert sorted(x.id for x in got.collect()) == sorted(i for c, s, e, i in f if c == chrom and s < end and e > start)

def test_spliced_contacts_stay_one_row(spark):
    """By brute force, with genes on two chromosomes, twins in their ids, nulls and long exons; contacts are not joined with exons row by row."""
    from cytoflux.operators import contacts

    r = random.Random(44)
    exons = [(r.choice("ab"), s, s + r.choice((0, 50, 40_000)), r.choice((1, 2, 3, None))) for s in (r.randrange(200_000) for _ in range(12))]
    rows = [(i // 2 if i < 60 else i, r.randrange(2), r.choice("abc"), r.randrange(250_000), r.choice("ab"), r.randrange(250_000)) for i in range(400)]
    rows += [(None, 0, "a", exons[0][1], "a", exons[0][1]), (900, 0, None, 5, "a", 5), (901, 0, "a", None, "a", 5)]
    legs = {}
    for i, cell, c1, p1, c2, p2 in rows:
        for k, c, p in ((1, c1, p1), (2, c2, p2)):
            for x, s, e, g in exons:
                if None not in (i, c, p) and x == c and s <= p < e:
                    legs.setdefault((i, cell, g), set()).add(k)
    bad = {k[:2] for k, v in legs.items() if len(v) == 2}
    d = spark.createDataFrame(rows, "id int, cell int, chr1 string, pos1 long, chr2 string, pos2 long")
    kept = contacts.clean_splicing(d, ["id", "cell"], spark.createDataFrame(exons, "chrom string, start long, end long, gene int"))
    assert bad and kept.columns == d.columns
    assert sorted(map(str, map(tuple, kept.collect()))) == sorted(str(x) for x in rows if x[:2] not in bad)
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 2 and "LeftAnti" not in plan  # the contacts are not read again

def test_text_lines_are_compressed(spark):
    from pathlib import Path

    from cytoflux.sources import scratch

    lines = spark.range(20_000).select(F.concat(F.lit("ACGT" * 30), F.col("id").cast("string")).alias("value"))
    path = scratch.text_lines(lines, "sam")
    assert sum(p.stat().st_size for p in Path(path).glob("part-*")) < 20_000 * 120 / 5
    assert spark.read.text(path).exceptAll(lines).count() == 0 and spark.read.text(path).count() == 20_000


def test_a_read_is_one_row_in_the_range_join(spark):
    """Whatever its CIGAR has; the sweep's groups are columns, and several keys work over small batches."""
    from cytoflux.operators import intervals, phasing

    rows = [(i, "c", 100 + i, "2S3M1I2M1D4M", "TTACGTACGTAC", "*") for i in range(20)]
    a = spark.createDataFrame(rows, "id int, chrom string, start long, cigar string, seq string, qual string")
    s = spark.createDataFrame([("c", p, "A", "C") for p in range(100, 130)], "chrom string, pos long, a0 string, a1 string")
    many, got = [], []
    for join in (phasing.swept_join, intervals.point_join):

        def counted(reads, *rest, join=join, **k):
            many.append(reads.count())
            return join(reads, *rest, **k)

        got.append(sorted(tuple(x) for x in phasing.phase_alignments(a, s, join=counted).collect()))
    assert many == [20, 20] and got[0] == got[1] and all(sum(x[6:9]) == 9 for x in got[0])
    r = random.Random(45)
    iv = [(r.choice("ab"), r.randrange(3), i, b, b + r.choice((1, 40, 700))) for i, b in enumerate(r.randrange(2000) for _ in range(150))]
    pt = [(r.choice("ab"), r.randrange(3), i, r.randrange(2500)) for i in range(150)]
    x, y = spark.createDataFrame(iv, "chrom string, cell int, id int, start long, end long"), spark.createDataFrame(pt, "chrom string, cell long, id int, pos long")
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for size in (5, 10_000):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(size))
            swept = intervals.sweep_point_join(x, y, ["chrom", "cell"], width=256)
            assert sorted((z.l_id, z.r_id) for z in swept.collect()) == sorted((i, j) for c, m, i, b, e in iv for d, n, j, p in pt if (c, m) == (d, n) and b <= p < e)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert "json" not in swept._jdf.queryExecution().toString()


def test_each_cigar_is_parsed_once(spark):
    """As the column functions have it, and above the rows that are made distinct, once a branch."""
    import pyarrow as pa

    from cytoflux.functions import alignment as A
    from cytoflux.operators import phasing

    r = random.Random(46)
    cigars = sorted({"".join(f"{r.randrange(12)}{r.choice('MIDSH')}" for _ in range(r.randrange(1, 8))) for _ in range(150)} | {"5S", "2H3S", "3S4M2S1H", "0M"})
    d = spark.createDataFrame([(c,) for c in cigars], "cigar string").coalesce(1)
    ops = A.cigar_ops(F.col("cigar"))
    plain = d.select("cigar", A.reference_length(ops), A.query_length(ops), A.leading_clip(ops), A.trailing_clip(ops), A.aligned_blocks(ops, F.lit(0))).collect()
    assert {x.cigar: tuple(x.v) for x in d.select("cigar", A.cigar_lengths("cigar").alias("v")).collect()} == {x[0]: tuple(x)[1:5] for x in plain}
    assert {(x.cigar, x.o): x.at for x in d.withColumn("o", F.explode(F.sequence(F.lit(0), F.lit(60)))).withColumn("at", A.query_index("cigar", F.col("o").cast("long"))).where("at IS NOT NULL").collect()} == {
        (x[0], o): b.query_start + o - b.ref_start for x in plain for b in x[5] for o in range(b.ref_start, min(b.ref_start + b.n, 61))
    }
    A.parsed.cache_clear()
    assert len(A.cigar_lengths.func(pa.array(["3M", "1S2M"] * 500))) == 1000 and A.parsed.cache_info().hits + A.parsed.cache_info().misses == 2
    a = spark.createDataFrame([(1, "q", 64, "c", 1, 60, "4M", "ACGT", "*")], "id int, qname string, flag int, chrom string, start long, mapq int, cigar string, seq string, qual string").distinct()
    s = spark.createDataFrame([("c", 2, "C", "A")], "chrom string, pos long, a0 string, a1 string")
    for join in (phasing.point_join, phasing.swept_join):
        plan = phasing.annotated(a, s, join=join)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("ArrowEvalPython [cigar_lengths") == 2 and plan.count("ArrowEvalPython [query_index") == 1
    for bad in ("*", "", "4M1X", None):
        with pytest.raises(Exception, match="unsupported CIGAR"):
            phasing.annotated(a.withColumn("cigar", F.lit(bad).cast("string")), s).collect()


def test_peaks_read_their_scores_once(spark, monkeypatch):
    from cytoflux.operators import peaks

    r, n, kept = random.Random(47), [], peaks.scored_steps
    f = [("c", s, s + 50) for s in (r.randrange(50_000) for _ in range(500))] + [("c", s, s + 50) for s in range(20_000, 20_060)]
    seen = spark.sparkContext.accumulator(0)

    def counted(steps):
        scored = kept(steps)

        def rows(batches):
            for b in batches:
                seen.add(b.num_rows)
                yield b

        n.append(scored.count())
        return scored.mapInArrow(rows, scored.schema)

    monkeypatch.setattr(peaks, "scored_steps", counted)
    assert peaks.call_peaks(spark.createDataFrame(f, "chrom string, start long, end long"), ["chrom"], 50_000, cutoff=3.0).count() >= 1
    assert seen.value == n[0]


@pytest.mark.parametrize("name", ["annotated_records", "annotated_records_by_sweep"])
def test_records_are_dealt_by_name_once(spark, tmp_path, name):
    """They are made distinct where the votes meet them; equal rows count once, and records of one name share their votes as in SQL."""
    import duckdb

    import __spark_entry__ as entry

    sf = "/root/testdata/sf0.001"
    t = spark.read.parquet(f"{sf}/lineitem.parquet").where("l_quantity >= 10")
    other = t.where("l_orderkey % 3 = 0").withColumn("l_suppkey", F.col("l_suppkey") + 60)
    t.unionByName(t.where("l_orderkey % 2 = 0")).unionByName(other).unionByName(other.withColumn("l_suppkey", F.col("l_suppkey") + 1)).repartition(5).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.read.parquet(f"{sf}/part.parquet").write.parquet(f"{tmp_path}/part.parquet")
    got = entry.queries()[name](spark, str(tmp_path))
    with duckdb.connect() as c:
        for x in ("lineitem", "part"):
            c.execute(f"CREATE VIEW {x} AS SELECT * FROM '{tmp_path}/{x}.parquet/*.parquet'")
        cursor = c.execute(entry.oracle_sql()[name])
        columns = [x[0] for x in cursor.description]
        want = cursor.fetchall()
    plain = lambda rows: sorted(tuple(map(str, x)) for x in rows)
    assert plain(got.select(*columns).collect()) == plain(want) and len(want) > len({x[0] for x in want})
    assert got._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(id#") == 1  # of the votes; records are there
