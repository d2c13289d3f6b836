"""Further registered queries, each with its SQL: readers over files written from the test tables, checks of cohorts and contracts, matrices and names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import names as N
from ..operators import adapters, cohort, contacts, imputation, intervals, peaks, qc, rna, structure
from ..sources import readers, scratch, writers
from ..streaming import islands
from .fixtures import cte, view
from .oracle import _COVERAGE, _READS, _union

QUERIES: dict[str, object] = {}
ORACLES: dict[str, str] = {}


def _query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _tabs(*columns) -> F.Column:
    return F.concat_ws("\t", *[F.col(c).cast("string") if isinstance(c, str) else c.cast("string") for c in columns]).alias("value")


# Readers over files written from the test tables

_SAM = cte("records") + """, d AS (SELECT DISTINCT * FROM records)
SELECT chrom::VARCHAR AS chrom, flag, count(*) AS n, sum(start)::BIGINT AS starts, sum(mapq)::BIGINT AS mapqs, sum(clip + 35 + ins + mapq + 5 - del)::BIGINT AS bases, min('b' || (start % 7)) AS first_tag FROM d GROUP BY ALL"""


@_query(_SAM)
def sam_records(spark, sf_dir):
    """SAM text with a header and tags, written and read: sums per chromosome and flag."""
    from .queries import _records

    t = _records(spark, sf_dir)
    tag = F.concat(F.lit("XB:Z:b"), (F.col("start") % 7).cast("string"))
    lines = t.select(_tabs("qname", "flag", "chrom", F.col("start") + 1, "mapq", "cigar", F.lit("*"), F.lit(0), F.lit(0), "seq", "qual", tag, F.lit("NH:i:1")))
    head = spark.range(20).select(F.concat(F.lit("@SQ\tSN:"), F.col("id").cast("string"), F.lit("\tLN:1000000")).alias("value"))
    s = readers.read_sam(spark, scratch.text_lines(head.union(lines), "sam"))
    return s.groupBy("chrom", "flag").agg(F.count("*").alias("n"), F.sum("start").alias("starts"), F.sum("mapq").alias("mapqs"), F.sum(F.length("seq")).alias("bases"), F.min(F.col("tags")["XB"]).alias("first_tag"))


@_query(cte("fragments") + """ SELECT chrom::VARCHAR AS chrom, strand, count(*) AS n, sum(start)::BIGINT AS starts, sum("end")::BIGINT AS ends, sum(mapq)::BIGINT AS scores, count(DISTINCT q) AS reads FROM fragments GROUP BY ALL""")
def bed_rows(spark, sf_dir):
    """BED rows, written and read."""
    f = view(spark, sf_dir, "fragments")
    b = readers.read_bed6(spark, scratch.text_lines(f.select(_tabs("chrom", "start", "end", "q", "mapq", "strand")), "bed"))
    return b.groupBy("chrom", "strand").agg(F.count("*").alias("n"), F.sum("start").alias("starts"), F.sum("end").alias("ends"), F.sum("score").alias("scores"), F.count_distinct("read_id").alias("reads"))


@_query(cte("contacts") + " SELECT chr1, chr2, count(*) AS n, sum(pos1)::BIGINT AS pos1, sum(pos2)::BIGINT AS pos2, count(*) FILTER (strand1 = '+') AS forward FROM contacts GROUP BY ALL")
def pairs_rows(spark, sf_dir):
    """Contacts under a header, written and read."""
    c = view(spark, sf_dir, "contacts").withColumn("read_id", F.col("q"))
    head = writers.pairs_header(spark.range(3).select(F.concat(F.lit("chr"), F.col("id").cast("string")).alias("chrom"), F.lit(9).alias("size")))
    p = readers.read_pairs(spark, scratch.text_lines(head.union(writers.pairs_lines(c)), "pairs"))
    return p.groupBy("chr1", "chr2").agg(F.count("*").alias("n"), F.sum("pos1").alias("pos1"), F.sum("pos2").alias("pos2"), F.count_if(F.col("strand1") == "+").alias("forward"))


@_query(_READS + """ SELECT read_num, strand, phase, count(*) AS n, sum(start)::BIGINT AS starts, sum("end")::BIGINT AS ends, sum(n_hits)::BIGINT AS hits, count(DISTINCT qname) AS reads FROM segs GROUP BY ALL""")
def segment_rows(spark, sf_dir):
    """Reads as lines of segments, written and read: sums per read number and strand."""
    reads = contacts.resolve_reads(view(spark, sf_dir, "hits"), ("ln", "price", "start", "chrom", "strand", "phase"))
    s = readers.read_segments(spark, scratch.text_lines(contacts.segment_lines(reads), "seg")).select("qname", F.explode("segs").alias("s")).select("qname", "s.*")
    return s.groupBy("read_num", "strand", "phase").agg(F.count("*").alias("n"), F.sum("start").alias("starts"), F.sum("end").alias("ends"), F.sum("n_hits").alias("hits"), F.count_distinct("qname").alias("reads"))


@_query(cte("genes") + """ SELECT chrom::VARCHAR AS chrom, strand, 'G' || (gene % 500) AS gene_id, min(start) AS start1, max("end") AS end1, count(*) AS n FROM genes GROUP BY ALL""")
def gtf_gene_spans(spark, sf_dir):
    """GTF text, written and read, to the span of each gene."""
    g = view(spark, sf_dir, "genes")
    attributes = F.concat(F.lit('gene_id "G'), (F.col("gene") % 500).cast("string"), F.lit('"; gene_name "n'), F.col("gene").cast("string"), F.lit('";'))
    path = scratch.text_lines(g.select(_tabs("chrom", F.lit("x"), F.lit("gene"), "start", "end", F.lit("."), "strand", F.lit("."), attributes)), "gtf")
    t = readers.read_gtf(spark, path)
    return t.groupBy("chrom", "strand", "gene_id").agg(F.min("start1").alias("start1"), F.max("end1").alias("end1"), F.count("*").alias("n"))


@_query(cte("snps") + " SELECT chrom::VARCHAR AS chrom, count(*) AS n, sum(pos)::BIGINT AS places, count(*) FILTER (a0 = 'A') AS a_first FROM snps WHERE pos % 5 > 0 AND a0 <> a1 GROUP BY chrom")
def vcf_snps(spark, sf_dir):
    """Phased variants of VCF text, those that pass, written as a SNP table and read again."""
    s = view(spark, sf_dir, "snps")
    state = F.when(F.col("pos") % 5 == 0, "q10").when(F.col("pos") % 2 == 0, "PASS").otherwise(".")
    lines = s.select(_tabs("chrom", F.col("pos") + 1, F.lit("."), "a0", "a1", F.lit("."), state, F.lit("."), F.lit("GT"), F.lit("0|1")))
    v = readers.read_vcf_phased(spark, scratch.text_lines(lines, "vcf"))
    t = readers.read_phased_snps(spark, scratch.text_lines(v.select(_tabs("chrom", "pos1", "a0", "a1")), "snp"))
    return t.groupBy("chrom").agg(F.count("*").alias("n"), F.sum("pos").alias("places"), F.count_if(F.col("a0") == "A").alias("a_first"))


@_query(cte("particles") + " SELECT chrom::VARCHAR AS chrom, count(*) AS n, sum(pos)::BIGINT AS places, round(sum(pos / 8.0), 3)::DOUBLE AS x FROM (SELECT DISTINCT * FROM particles) GROUP BY chrom")
def particle_rows(spark, sf_dir):
    """Particles of structures, written and read."""
    p = view(spark, sf_dir, "particles").distinct()
    t = readers.read_particles(spark, scratch.text_lines(p.select(_tabs("chrom", "pos", F.col("pos") / 8, F.lit(0.5), F.lit(-1.0))), "particles"))
    return t.groupBy("chrom").agg(F.count("*").alias("n"), F.sum("pos").alias("places"), F.round(F.sum("x"), 3).alias("x"))


@_query("SELECT o_orderpriority AS comment, count(*) AS n, sum(length(o_clerk_like))::BIGINT AS bases, min('r' || o_orderkey) AS first_id FROM (SELECT *, repeat('ACGT', (1 + o_orderkey % 9)::INT) AS o_clerk_like FROM orders) GROUP BY 1")
def fastq_reads(spark, sf_dir):
    """FASTQ text, written and read: records and bases by comment."""
    o = _read(spark, sf_dir, "orders")
    seq = F.expr("repeat('ACGT', cast(1 + o_orderkey % 9 as int))")
    record = F.concat_ws("\n", F.concat(F.lit("@r"), F.col("o_orderkey").cast("string"), F.lit(" "), "o_orderpriority"), seq, F.lit("+"), F.translate(seq, "ACGT", "IIII"))
    t = readers.read_fastq(spark, scratch.text_lines(o.select(record.alias("value")), "fastq"))
    return t.groupBy("comment").agg(F.count("*").alias("n"), F.sum(F.length("seq")).alias("bases"), F.min("read_id").alias("first_id"))


@_query(cte("umis") + ", c AS (SELECT cell, gene, count(DISTINCT umi) AS n FROM umis GROUP BY ALL), g AS (SELECT DISTINCT gene FROM c) SELECT gene, k AS cell, coalesce(n, 0)::DOUBLE AS n FROM g CROSS JOIN (SELECT unnest(range(50)) AS k) LEFT JOIN c ON c.cell = k AND c.gene = g.gene".replace("gene, k AS cell", "g.gene, k::VARCHAR AS cell"))
def matrix_rows(spark, sf_dir):
    """The wide matrix of UMIs, written as a table with a column per cell and read as rows."""
    wide = rna.wide_matrix(rna.unique_umis(view(spark, sf_dir, "umis"), ["cell", "gene"]), list(range(50)))
    path = scratch.place(spark, "matrix")
    writers.write_tsv(wide, path)
    return readers.read_matrix(spark, path, [str(k) for k in range(50)])


@_query("SELECT count(*) AS n, sum(o_custkey)::BIGINT AS total FROM orders")
def stat_rows(spark, sf_dir):
    """A two-column table of counts, written and read."""
    o = _read(spark, sf_dir, "orders")
    t = readers.read_stat(spark, scratch.text_lines(o.select(_tabs(F.concat(F.lit("x/"), F.col("o_orderkey").cast("string")), "o_custkey")), "stat"))
    return t.agg(F.count("path").alias("n"), F.sum("n").alias("total"))


# Names, contracts, cohorts


@_query("""WITH n AS (SELECT o_orderkey AS k, o_custkey % 40 AS file, o_custkey * 7 % 1000 AS a, o_orderkey % 977 AS b, CASE WHEN o_orderkey % 3 = 0 THEN 'x' ELSE '' END AS c FROM orders)
SELECT k, file, (rank() OVER (PARTITION BY file ORDER BY a, b, c))::BIGINT AS place FROM n""")
def names_in_natural_order(spark, sf_dir):
    """The place of each name, with zeros in front of some numbers, in the natural order of its file."""
    from pyspark.sql import Window as W

    o = _read(spark, sf_dir, "orders")
    number = lambda c, zeros: F.concat(F.expr(f"repeat('0', cast(o_orderkey % {zeros} as int))"), c.cast("string"))
    name = F.concat(F.lit("run"), number(F.col("o_custkey") * 7 % 1000, 4), F.lit("."), number(F.col("o_orderkey") % 977, 3), F.when(F.col("o_orderkey") % 3 == 0, "x").otherwise(""))
    t = o.select(F.col("o_orderkey").alias("k"), (F.col("o_custkey") % 40).alias("file"), N.natural_key(name).alias("key"))
    return t.select("k", "file", F.rank().over(W.partitionBy("file").orderBy("key")).cast("long").alias("place"))


_CELLS = """cells AS (SELECT (row_number() OVER (ORDER BY s_name) - 1) AS ord, s_name AS sample_name, 'C' || substr(sha256(s_name), 1, 16) AS safe_code, s_suppkey AS k FROM supplier)"""


def _cells(spark, sf_dir) -> DataFrame:
    s = _read(spark, sf_dir, "supplier").select(F.col("s_name").alias("sample_name"), N.cell_code(F.col("s_name")).alias("safe_code"), F.col("s_suppkey").alias("k"))
    return cohort.with_order(s)


@_query(f"""WITH {_CELLS} SELECT sha256('[' || string_agg('{{"r1_bytes":' || k || ',"r1_first_record_sha256":"' || sha256(sample_name) || '","r2_bytes":' || (k + 1) || ',"r2_first_record_sha256":"' || sha256(safe_code) || '","safe_code":"' || safe_code || '","sample_name":"' || sample_name || '"}}', ',' ORDER BY ord) || ']') AS sha256 FROM cells""")
def normalized_contract(spark, sf_dir):
    """The hash of the cohort's normalised contract."""
    c = _cells(spark, sf_dir)
    of = lambda x: F.sha2(F.col(x).cast("binary"), 256)
    c = c.select("ord", "sample_name", "safe_code", F.col("k").alias("r1_bytes"), (F.col("k") + 1).alias("r2_bytes"), of("sample_name").alias("r1_first_record_sha256"), of("safe_code").alias("r2_first_record_sha256"))
    return qc.normalized_contract_hash(c)


@_query(f"""WITH {_CELLS}, m AS (SELECT *, k % 5 = 0 AS gone FROM cells)
SELECT 'abc' AS contract_sha256, count(*) AS expected_cells, count(*) FILTER (NOT gone) AS observed_cells, count(*) FILTER (gone) AS missing_cells_filled_zero, 0 AS unexpected_cells, string_agg(safe_code, ',' ORDER BY ord) FILTER (gone) AS missing_cell_codes,
string_agg(sample_name, ',' ORDER BY ord) FILTER (gone) AS missing_cell_names, 7 AS feature_rows, 'PASS' AS cell_column_contract FROM m""")
def matrix_receipt(spark, sf_dir):
    """The receipt of a matrix that lacks every fifth cell."""
    c = _cells(spark, sf_dir)
    return cohort.matrix_receipt(c, c.where("k % 5 > 0").select(F.col("safe_code").alias("cell_code")), 7, "abc")


@_query(f"""WITH {_CELLS}, f AS (SELECT ord, CASE WHEN k % 7 = 0 THEN sample_name || '?' ELSE sample_name END AS found, CASE WHEN k % 11 = 0 THEN -1 ELSE k END AS n FROM cells WHERE k % 13 > 0)
SELECT ord::INT AS ord, sample_name AS expected, found, CASE WHEN found IS NULL THEN 'missing' WHEN found <> sample_name THEN 'out of order' ELSE 'bad count' END AS fault FROM cells LEFT JOIN f USING (ord) WHERE found IS NULL OR found <> sample_name OR n < 0""")
def cohort_faults(spark, sf_dir):
    """Faults of a table of counts that should list the cohort: missing cells, other names, negative counts."""
    c = _cells(spark, sf_dir)
    name = F.when(F.col("k") % 7 == 0, F.concat("sample_name", F.lit("?"))).otherwise(F.col("sample_name"))
    stats = c.where("k % 13 > 0").select("ord", name.alias("sample_name"), F.when(F.col("k") % 11 == 0, -1).otherwise(F.col("k")).alias("n"))
    return qc.exact_cohort(stats, c)


@_query(cte("fragments") + " SELECT c.s_suppkey AS cell, count(f.cell) AS total, count(*) FILTER (mapq >= 25) AS assigned FROM supplier c LEFT JOIN fragments f ON f.cell = c.s_suppkey GROUP BY 1".replace("f.cell = c.s_suppkey", "f.cell + 1 = c.s_suppkey"))
def assigned_totals(spark, sf_dir):
    """Reads and assigned reads of each cell of the cohort, zeros where a cell has none."""
    f = view(spark, sf_dir, "fragments").select((F.col("cell") + 1).alias("cell"), F.when(F.col("mapq") >= 25, "Assigned").otherwise("Unassigned_Ambiguity").alias("xs"))
    cells = _read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("cell"))
    return qc.assigned_totals(f.join(cells, "cell", "left_semi"), cells)


@_query("""WITH g AS (SELECT s_suppkey AS cell, resolution FROM supplier, (VALUES ('20k'), ('50k'), ('1m')) AS r(resolution)), t AS (SELECT o_custkey AS cell, CASE o_orderkey % 3 WHEN 0 THEN '20k' WHEN 1 THEN '50k' ELSE '1m' END AS resolution, max(o_orderkey) AS v FROM orders GROUP BY ALL)
SELECT cell, resolution, coalesce(v::VARCHAR, 'NA') AS rmsd FROM g LEFT JOIN t USING (cell, resolution)""")
def rmsd_table(spark, sf_dir):
    """Every cell at every resolution, NA where there is no value."""
    cells = _read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("cell"), F.col("s_suppkey").alias("ord"))
    t = _read(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("cell"), F.when(F.col("o_orderkey") % 3 == 0, "20k").when(F.col("o_orderkey") % 3 == 1, "50k").otherwise("1m").alias("resolution")).agg(F.max("o_orderkey").alias("rmsd"))
    return structure.rmsd_table(cells, t.join(cells, "cell", "left_semi"), ["20k", "50k", "1m"]).select("cell", "resolution", "rmsd")


@_query(cte("snps") + " SELECT chrom, count(*) AS count, min(pos) AS first_pos, max(pos) AS last_pos, 'chrom=' || chrom AS folder FROM (SELECT DISTINCT * FROM snps) GROUP BY chrom")
def snp_manifest(spark, sf_dir):
    return writers.snp_manifest(view(spark, sf_dir, "snps").distinct()).select("chrom", "count", "first_pos", "last_pos", "folder")


@_query("""SELECT o_orderkey AS k, ((o_orderpriority || 'x') || chr(32) || '1') AS header, '0' || lpad((o_orderkey % 900)::VARCHAR, 3, '0') || '_' || regexp_replace(o_orderpriority, '[^A-Za-z0-9._-]', '_', 'g') AS safe, o_orderpriority AS part FROM orders""")
def read_headers(spark, sf_dir):
    """Headers of mates, safe file names and parts of paths."""
    o = _read(spark, sf_dir, "orders")
    path = F.concat(F.lit("a/b/"), "o_orderpriority", F.lit(".bed.gz"))
    return o.select(F.col("o_orderkey").alias("k"), N.mate_suffix(F.concat("o_orderpriority", F.lit("x/1"))).alias("header"), N.safe_name(F.col("o_orderkey") % 900, F.col("o_orderpriority")).alias("safe"), N.path_part(path, -1, r"\.bed\.gz$").alias("part"))


@_query(cte("alignments") + """ SELECT cell, count(*) AS n, sum(CASE WHEN ln % 3 = 0 THEN 0 WHEN ln % 2 = 0 THEN 2 ELSE 1 END)::BIGINT AS genes FROM alignments WHERE (flag & 4) = 0 AND (flag & 256) = 0 AND (flag & 2048) = 0 AND mapq >= 30 AND ln <> 4 GROUP BY cell""")
def confident_genes(spark, sf_dir):
    """Reads that are mapped well, once and primarily, and the genes that they are assigned to."""
    a = view(spark, sf_dir, "alignments").withColumn("nh", F.when(F.col("ln") != 4, 1).otherwise(2))
    genes = rna.assigned_genes(F.when(F.col("ln") % 3 == 0, "Unassigned").otherwise("Assigned"), F.when(F.col("ln") % 2 == 0, "A,,B").otherwise("A"))
    return a.where(rna.confident_unique(30)).groupBy("cell").agg(F.count("*").alias("n"), F.sum(F.size(genes)).alias("genes"))


# Matrices and structures


@_query(cte("pairs_bins") + """, u AS (SELECT chrom, bin1 AS a, bin2 AS b FROM pairs_bins WHERE n > 0 UNION SELECT chrom, bin2, bin1 FROM pairs_bins WHERE n > 0), g AS (SELECT p_partkey % 20 AS chrom, p_partkey % 60 AS bin, max(p_size) / 100 AS cpg FROM part GROUP BY ALL)
SELECT g.chrom, g.bin, round(coalesce(sum(h.cpg), 0) / (count(u.b) + 1), 9) AS score FROM g LEFT JOIN u ON u.chrom = g.chrom AND u.a = g.bin LEFT JOIN g h ON h.chrom = u.chrom AND h.bin = u.b GROUP BY ALL""")
def symmetric_compartments(spark, sf_dir):
    """Compartment scores of all bins, contacts counted from both of their ends; the last bins have none."""
    cpg = _read(spark, sf_dir, "part").groupBy((F.col("p_partkey") % 20).alias("chrom"), (F.col("p_partkey") % 60).alias("bin")).agg((F.max("p_size") / 100).alias("cpg"))
    return structure.symmetric_compartment_score(view(spark, sf_dir, "pairs_bins"), cpg, 16).select("chrom", "bin", F.round("score", 9).alias("score"))


@_query(cte("particles", "contacts") + """, p AS (SELECT DISTINCT structure, 'chr' || chrom AS chrom, pos * 1000 AS pos FROM particles), l AS (SELECT chr1 AS chrom, pos1 AS pos FROM contacts UNION ALL SELECT chr2, pos2 FROM contacts),
g AS (SELECT chrom, pos, count(*) AS n FROM l GROUP BY ALL), d AS (SELECT DISTINCT chrom, pos FROM p), s AS (SELECT d.chrom, d.pos, coalesce(sum(g.n), 0)::BIGINT AS support FROM d LEFT JOIN g ON g.chrom = d.chrom AND g.pos BETWEEN d.pos - 20000 AND d.pos + 20000 GROUP BY ALL),
t AS (SELECT p.*, s.support FROM p JOIN s USING (chrom, pos)), q AS (SELECT structure, quantile_cont(support, 0.06) AS bound FROM t GROUP BY structure) SELECT structure, chrom, pos, support, support > bound AS kept FROM t JOIN q USING (structure)""")
def supported_particles(spark, sf_dir):
    """Particles with the contact legs near them, without the worst six in a hundred of a structure."""
    p = view(spark, sf_dir, "particles").select("structure", F.concat(F.lit("chr"), F.col("chrom").cast("string")).alias("chrom"), (F.col("pos") * 1000).alias("pos")).distinct()
    return structure.clean_particles(p, view(spark, sf_dir, "contacts"), 20_000).select("structure", "chrom", "pos", "support", "kept")


@_query(r"""WITH d AS (SELECT doc_id::VARCHAR AS chrom, upper(regexp_replace(replace(text, chr(10), ''), '[^\x00-\x7F]', 'N', 'g')) AS s, length(replace(text, chr(10), '')) AS size FROM documents), w AS (SELECT chrom, s, size, 100 AS start, 150 AS "end" FROM d WHERE size >= 150),
p AS (SELECT *, greatest(start - 275, 0) AS a, least("end" + 275, size) AS b FROM w), c AS (SELECT *, substr(s, (a + 1)::INT, (b - a)::INT) AS x FROM p)
SELECT chrom, start::BIGINT AS start, "end"::BIGINT AS "end", ((length(x) - length(replace(x, 'CG', ''))) / 2)::BIGINT AS cpg, length(regexp_replace(x, '[^ACGT]', '', 'g'))::BIGINT AS valid,
coalesce(round(((length(x) - length(replace(x, 'CG', ''))) / 2) / nullif(length(regexp_replace(x, '[^ACGT]', '', 'g')), 0), 6), 0)::DOUBLE AS density FROM c""")
def padded_cpg_windows(spark, sf_dir):
    """CpG density of windows that grow to 600 bases, over sequences cut in lines."""
    from pyspark.sql import Window as W

    d = _read(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("name"), F.posexplode(F.split(F.regexp_replace("text", r"[^\x00-\x7F]", "N"), "\n")).alias("ord", "line"))
    before = F.coalesce(F.sum(F.length("line")).over(W.partitionBy("name").orderBy("ord").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    lines = d.where("line <> ''").withColumn("start", before.cast("long"))
    sizes = lines.groupBy(F.col("name").alias("chrom")).agg(F.sum(F.length("line")).alias("size"))
    windows = sizes.where("size >= 150").select("chrom", F.lit(100).cast("long").alias("start"), F.lit(150).cast("long").alias("end"))
    t = structure.window_cpg(lines, structure.padded_windows(windows, sizes, 600))
    return t.select("chrom", "start", "end", F.col("cpg").cast("long").alias("cpg"), F.col("valid").cast("long").alias("valid"), F.col("density").cast("double").alias("density"))


# Ends of reads and islands in time


def _reads(spark, sf_dir) -> DataFrame:
    """Reads of some bases, an adapter in part or whole, now and then with a changed base, and a tail."""
    o = _read(spark, sf_dir, "orders")
    bases = F.translate(F.conv((F.col("o_orderkey") * 2654435761 % 1000003).cast("string"), 10, 4), "0123", "ACGT")
    adapter = F.substring(F.lit("AGATCGGAAGAGCACACGT"), F.lit(1), (F.col("o_custkey") % 20).cast("int"))
    adapter = F.when(F.col("o_orderkey") % 5 == 0, F.translate(adapter, "T", "G")).otherwise(adapter)
    tail = F.expr("repeat('A', cast(o_custkey % 8 as int))")
    return o.select(F.col("o_orderkey").alias("k"), F.concat(bases, adapter, F.when(F.col("o_orderkey") % 2 == 0, tail).otherwise("")).alias("seq"))


@_query()
def trimmed_adapter_ends(spark, sf_dir):
    """Reads cut at a 3' adapter with errors, those with a base left."""
    return adapters.trim_adapter_end(_reads(spark, sf_dir), "AGATCGGAAGAGC", 0.1, 3, 1)


@_query()
def trimmed_tails(spark, sf_dir):
    """Reads without their tails of A."""
    return adapters.trim_poly(_reads(spark, sf_dir), minimum=1)


@_query("""WITH o AS (SELECT *, CASE WHEN ts - lag(ts) OVER w <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS o FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id::VARCHAR)), s AS (SELECT *, sum(o) OVER (PARTITION BY user_id ORDER BY ts, event_id::VARCHAR) AS k FROM o)
SELECT user_id, count(*) AS n, min(ts) AS first_ts, max(ts) AS last_ts, arg_min(event_id::VARCHAR, (ts, event_id::VARCHAR)) AS first_id FROM s GROUP BY user_id, k""")
def event_islands(spark, sf_dir):
    """Islands of events in time with their first event: the batch form of the stream with its own state."""
    return islands.islands_of(_read(spark, sf_dir, "events"), ["user_id"], row_id="event_id")


# Peaks

_PEAKED = (
    cte("fragments")
    + """, fragments_ AS (SELECT chrom, start - m AS start, "end" - m AS "end" FROM (SELECT *, CASE WHEN start % 7000 < 350 THEN start % 350 ELSE 0 END AS m FROM fragments) WHERE q % 3 = 0 OR m > 0)"""
    + _COVERAGE.replace("FROM fragments", "FROM fragments_")
    + """, st AS (SELECT chrom, pos AS start, nxt AS "end", depth::BIGINT AS depth, depth * (nxt - pos) AS mass FROM run WHERE depth > 0),
b AS (SELECT *, greatest((SELECT sum(mass) FROM st) / 4000000, sum(mass) OVER (PARTITION BY chrom ORDER BY start RANGE BETWEEN 100 PRECEDING AND 100 FOLLOWING) / 200, sum(mass) OVER (PARTITION BY chrom ORDER BY start RANGE BETWEEN 500 PRECEDING AND 500 FOLLOWING) / 1000,
  sum(mass) OVER (PARTITION BY chrom ORDER BY start RANGE BETWEEN 5000 PRECEDING AND 5000 FOLLOWING) / 10000) AS background FROM st),
s AS (SELECT *, greatest(round(-log10(list_sum(list_transform(range(depth, depth + 250), lambda i: exp(-background + i * ln(background) - lgamma(i + 1))))), 2), 0) + 0 AS score FROM b),
e AS (SELECT score, sum("end" - start) AS bases FROM s GROUP BY score), r AS (SELECT score, sum(bases) OVER (ORDER BY score DESC) AS rank, sum(bases) OVER () AS whole FROM e),
q AS (SELECT score, greatest(max(score + log10(rank) - log10(whole)) OVER (ORDER BY score ROWS UNBOUNDED PRECEDING), 0) AS q_score FROM r)"""
)


def _peaked(spark, sf_dir) -> DataFrame:
    """Fragments that crowd in some places, where they are put together, and a third of the others."""
    moved = F.when(F.col("start") % 7000 < 350, F.col("start") % 350).otherwise(0)
    f = view(spark, sf_dir, "fragments").withColumn("m", moved).where("q % 3 = 0 OR m > 0")
    return f.select("chrom", (F.col("start") - F.col("m")).alias("start"), (F.col("end") - F.col("m")).alias("end"))


@_query(_PEAKED + ' SELECT chrom, start, "end", depth, round(background, 6)::DOUBLE AS background, score::DOUBLE AS score, round(q_score, 6)::DOUBLE AS q_score FROM s JOIN q USING (score)')
def scored_coverage(spark, sf_dir):
    """Steps of coverage with their background, the score of their depth over it, and their false discovery rate."""
    steps = scratch.written(intervals.coverage_steps(_peaked(spark, sf_dir), ["chrom"], segment_width=4096), "steps")
    mass = steps.agg(F.sum(F.col("depth") * (F.col("end") - F.col("start")))).first()[0] or 0
    t = peaks.scored_steps(peaks.local_background(steps, ["chrom"], (200, 1000, 10_000), max(mass / 4_000_000, 1e-9), 16_384))
    return t.select("chrom", "start", "end", "depth", F.round("background", 6).alias("background"), "score", F.round("q_score", 6).alias("q_score"))


@_query(
    _PEAKED
    + ', good AS (SELECT * FROM s JOIN q USING (score) WHERE q_score >= 1.3), '
    + _union("chrom", "good", '"end"', 30)
    + ' SELECT chrom, min(start) AS start, max("end") AS "end", max(depth) AS depth, arg_min(start, (-depth, start)) AS summit, max(score)::DOUBLE AS score, round(max(q_score), 6)::DOUBLE AS q_score FROM v GROUP BY chrom, component HAVING max("end") - min(start) >= 50'
)
def called_peaks(spark, sf_dir):
    """Peaks of coverage over the local background."""
    t = peaks.call_peaks(_peaked(spark, sf_dir), ["chrom"], 4_000_000, (200, 1000, 10_000), segment_width=16_384)
    return t.withColumn("q_score", F.round("q_score", 6))


# Phases of contacts

@_query()
def imputed_phases(spark, sf_dir):
    """Contacts by cell with the phases that their neighbours suggest: how many are known, called and open."""
    c = view(spark, sf_dir, "contacts").distinct()
    phase = lambda k: F.when(F.col("q") % k == 0, "0").when(F.col("q") % k == 1, "1").otherwise(".")
    t = imputation.called_phases(imputation.impute_phases(c.withColumn("phase1", phase(5)).withColumn("phase2", phase(7)), ["cell"], 500_000, 4))
    known = (F.col("phase1") != ".") & (F.col("phase2") != ".")
    return t.groupBy("cell").agg(F.count("*").alias("contacts"), F.count_if(known).alias("known"), F.count_if(~known & (F.col("called1") != ".")).alias("called"), F.count_if(F.col("called1") == ".").alias("open"))


@_query(cte("fragments") + """ SELECT q, ln, price, start, "end", chrom::INT AS chrom FROM (SELECT DISTINCT q, ln, price, chrom, start, "end" FROM fragments) WHERE chrom = 3 AND start < 9000 AND "end" > 2000""")
def fragments_of_a_region(spark, sf_dir):
    """All fragments written by chromosome and bin, and those of one region read back."""
    f = view(spark, sf_dir, "fragments").select("q", "ln", "price", F.col("chrom").cast("int").alias("chrom"), "start", "end").distinct()
    path = scratch.place(spark, "regions")
    writers.write_regions(f, path, 4096)
    return writers.read_region(spark, path, 3, 2000, 9000)
