"""DuckDB SQL for the registered queries: independent statements of the same results."""

from __future__ import annotations

from .fixtures import cte

_BEST = (
    cte("alignments")
    + """, a AS (SELECT * FROM alignments WHERE (flag & 4) = 0 AND mapq >= 10),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY qname ORDER BY q_start, CASE WHEN (flag & 2048) <> 0 THEN 1 ELSE 0 END, mapq DESC, aligned_length DESC, chrom, start, "end", strand, flag, price, ln, cell, base, phase) AS rk
  FROM a WHERE origin = 'R2' AND (flag & 256) = 0
), chosen AS (SELECT * FROM ranked WHERE rk = 1), sel AS (SELECT * FROM chosen WHERE q_start = 0)"""
)

_R1 = """, r1 AS (
  SELECT *, row_number() OVER (PARTITION BY qname ORDER BY q_start, CASE WHEN (flag & 2048) <> 0 THEN 1 ELSE 0 END, mapq DESC, aligned_length DESC, chrom, start, "end", strand, flag, price, ln, cell, base, phase) AS rk1
  FROM a WHERE origin = 'R1' AND phase <> '.' AND (flag & 256) = 0
), s1 AS (SELECT qname, max(CASE WHEN rk1 = 1 THEN phase END) AS p1, count(*) AS n1, count(DISTINCT phase) > 1 AS c1 FROM r1 GROUP BY qname)"""


def _dedup_sql(keys: str, source: str, columns: str, both: bool = True, tie: str = 'q, ln, price, start, "end", cell, strand') -> str:
    sql = f"""p1 AS (
  SELECT *, CASE WHEN strand = '+' THEN start ELSE "end" - 1 END AS pos1 FROM {source}
), c1 AS (
  SELECT *, CASE WHEN pos1 - lag(pos1) OVER (PARTITION BY {keys} ORDER BY pos1, {tie}) <= 1 THEN 0 ELSE 1 END AS opens1 FROM p1
), i1 AS (
  SELECT *, sum(opens1) OVER (PARTITION BY {keys} ORDER BY pos1, {tie} ROWS UNBOUNDED PRECEDING) AS island1 FROM c1
), k1 AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {keys}, island1 ORDER BY pos1, {tie}) AS r1 FROM i1) WHERE r1 = 1
)"""
    if not both:
        return sql + f" SELECT {columns} FROM k1"
    return (
        sql
        + f""", p2 AS (
  SELECT *, CASE WHEN strand = '-' THEN start ELSE "end" - 1 END AS pos2 FROM k1
), c2 AS (
  SELECT *, CASE WHEN pos2 - lag(pos2) OVER (PARTITION BY {keys} ORDER BY pos2, pos1, {tie}) <= 1 THEN 0 ELSE 1 END AS opens2 FROM p2
), i2 AS (
  SELECT *, sum(opens2) OVER (PARTITION BY {keys} ORDER BY pos2, pos1, {tie} ROWS UNBOUNDED PRECEDING) AS island2 FROM c2
), k2 AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {keys}, island2 ORDER BY pos2, pos1, {tie}) AS r2 FROM i2) WHERE r2 = 1
) SELECT {columns} FROM k2"""
    )


_F = 'chrom, start, "end", strand, cell, q, ln, price'
_UMI_COUNTS = cte("umis") + ", c AS (SELECT cell, gene, count(DISTINCT umi) AS n FROM umis GROUP BY cell, gene)"
_DISTINCT_CONTACTS = cte("contacts") + ", c AS (SELECT DISTINCT cell, q, ln, price, chr1, pos1, chr2, pos2 FROM contacts)"

_HITS = (
    cte("hits")
    + """, o AS (
  SELECT *, row_number() OVER w AS place, lag(strand) OVER w AS bs, lag(chrom) OVER w AS bc, lag(start) OVER w AS bst, lag("end") OVER w AS be
  FROM hits WINDOW w AS (PARTITION BY qname ORDER BY read_num, q_start, ln, price, start, chrom, strand, phase)
), d AS (
  SELECT *, CASE WHEN strand = bs AND chrom = bc AND (CASE WHEN strand = '+' THEN start - be ELSE "end" - bst END) BETWEEN -500 AND 499 THEN 0 ELSE 1 END AS opens FROM o
), g AS (SELECT *, sum(opens) OVER (PARTITION BY qname ORDER BY place) AS segment FROM d),
m AS (
  SELECT qname, segment, arg_min(read_num, place) AS read_num, arg_min(chrom, place) AS chrom, arg_min(strand, place) AS strand,
    CASE WHEN arg_min(strand, place) = '+' THEN arg_min(start, place) ELSE arg_max(start, place) END AS start,
    CASE WHEN arg_min(strand, place) = '+' THEN arg_max("end", place) ELSE arg_min("end", place) END AS "end",
    arg_min(phase, place) AS phase, max(mapq) AS mapq, count(*) AS n_hits
  FROM g GROUP BY qname, segment
)"""
)
_READS = (
    _HITS
    + """, counted AS (SELECT qname, count(*) AS ns, sum(n_hits) AS nh FROM m GROUP BY qname HAVING count(*) >= 2 AND sum(n_hits) >= 2),
four AS (
  SELECT a.qname FROM counted x JOIN m a ON a.qname = x.qname AND a.segment = 1 JOIN m b ON b.qname = x.qname AND b.segment = 2
  JOIN m c ON c.qname = x.qname AND c.segment = 3 JOIN m d4 ON d4.qname = x.qname AND d4.segment = 4
  WHERE x.ns = 4 AND a.chrom = c.chrom AND a.strand = c.strand AND b.chrom = d4.chrom AND b.strand = d4.strand
    AND least(a."end", c."end") - greatest(a.start, c.start) > 0.5 * least(a."end" - a.start, c."end" - c.start)
    AND least(b."end", d4."end") - greatest(b.start, d4.start) > 0.5 * least(b."end" - b.start, d4."end" - d4.start)
), segs AS (SELECT m.* FROM m JOIN counted USING (qname) WHERE m.qname NOT IN (SELECT qname FROM four) OR m.segment <= 2)"""
)

_SITES = ", sites AS (SELECT cell, chrom, CASE WHEN strand = '+' THEN start + 4 ELSE \"end\" - 5 END AS site FROM fragments)"


def _pile(flank: int) -> str:
    return (
        _SITES
        + f""", pile AS (
  SELECT s.cell, CASE WHEN t.strand = '-' THEN t.pos - s.site ELSE s.site - t.pos END AS off
  FROM tss t JOIN sites s ON s.chrom = t.chrom AND s.site BETWEEN t.pos - {flank} AND t.pos + {flank}
)"""
    )


_COVERAGE = """, edges AS (SELECT chrom, start AS pos, 1 AS d FROM fragments UNION ALL SELECT chrom, "end", -1 FROM fragments),
steps AS (SELECT chrom, pos, sum(d) AS d FROM edges GROUP BY chrom, pos),
run AS (SELECT chrom, pos, sum(d) OVER w AS depth, lead(pos) OVER w AS nxt FROM steps WINDOW w AS (PARTITION BY chrom ORDER BY pos))"""


def _union(keys: str, source: str, tie: str, distance: int) -> str:
    return f"""u AS (
  SELECT *, CASE WHEN start > max("end") OVER (PARTITION BY {keys} ORDER BY start, {tie} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + {distance} THEN 1 ELSE 0 END AS o FROM {source}
), v AS (
  SELECT *, sum(o) OVER (PARTITION BY {keys} ORDER BY start, {tie} ROWS UNBOUNDED PRECEDING) + 1 AS component FROM u
)"""


_POINTS = """, f AS (
  SELECT cell, chrom, q, ln, price, mapq, strand, start AS s0, "end" AS e0, CASE WHEN strand = '+' THEN start ELSE "end" END AS start, CASE WHEN strand = '+' THEN start ELSE "end" END + 1 AS "end" FROM fragments WHERE {}
), """
_POINT_TIES = "s0, e0, q, ln, price, strand"

#: A record's bases by hand: where a SNP lies in the first 20 bases, in the next 15, in the deletion, or behind it.
_RECORDS = (
    cte("records", "snps")
    + """, d AS (SELECT DISTINCT * FROM records WHERE (flag & 4) = 0 AND mapq >= 10),
b AS (
  SELECT d.*, s.a0, s.a1, s.pos - d.start AS o FROM d JOIN snps s ON s.chrom = d.chrom AND s.pos >= d.start AND s.pos < d.start + 40 + d.mapq
), q AS (
  SELECT *, clip + o + CASE WHEN o < 20 THEN 0 WHEN o < 35 THEN ins ELSE ins - del END AS spot FROM b WHERE o < 35 OR o >= 35 + del
), seen AS (
  SELECT qname, substr('ACGT', ((letter + spot) % 4 + 1)::INT, 1) AS base, [40, 10, 20, 41, 2][((grade + spot) % 5 + 1)::INT] AS quality, a0, a1 FROM q
), n AS (
  SELECT qname, count(*) FILTER (base = a0) AS n0, count(*) FILTER (base = a1) AS n1, count(*) FILTER (base <> a0 AND base <> a1) AS other FROM seen WHERE quality >= 20 GROUP BY qname
)
SELECT d.qname, CASE WHEN (flag & 64) <> 0 THEN 'R1' ELSE 'R2' END AS origin, flag, chrom, start, start + 40 + mapq AS "end",
  CASE WHEN ((flag & 16) <> 0) <> ((flag & 128) <> 0) THEN '-' ELSE '+' END AS strand, mapq,
  CASE WHEN (flag & 16) <> 0 THEN 0 ELSE clip END AS q_start, 40 + mapq - del + ins + CASE WHEN (flag & 16) <> 0 THEN 0 ELSE clip END AS q_end, 40 + mapq - del + ins AS aligned_query_length,
  CASE WHEN n0 > 0 AND n1 = 0 THEN '0' WHEN n1 > 0 AND n0 = 0 THEN '1' ELSE '.' END AS phase, coalesce(n0, 0) AS phase0_count, coalesce(n1, 0) AS phase1_count, coalesce(other, 0) AS other_allele_count
FROM d LEFT JOIN n USING (qname)"""
)

ORACLES: dict[str, str] = {
    "fragment_bin_counts": _BEST.replace("SELECT * FROM chosen WHERE q_start = 0", "SELECT *, qname AS q FROM chosen WHERE q_start = 0")
    + ", kept AS (WITH "
    + _dedup_sql("cell, chrom", "sel", "*")
    + """), coh AS (SELECT DISTINCT chrom, start, "end", cell FROM kept)
SELECT cell, chrom, bin, count(*) AS n FROM (SELECT cell, chrom, unnest(range(start // 100, ("end" - 1) // 100 + 1)) AS bin FROM coh) GROUP BY ALL""",
    "select_best_per_qname": _BEST + ' SELECT qname, chrom, start, "end", strand, mapq, flag, price FROM sel',
    "select_with_fallback_phase": _BEST
    + _R1
    + """ SELECT sel.qname, chrom, start, phase, CASE WHEN phase <> '.' THEN phase ELSE coalesce(p1, '.') END AS final_phase,
CASE WHEN phase <> '.' THEN 'R2' WHEN p1 IS NOT NULL THEN 'R1' ELSE 'unphased' END AS phase_source, coalesce(n1, 0) AS r1_informative, coalesce(c1, false) AS r1_conflict,
coalesce(phase <> '.' AND phase <> p1, false) AS conflict FROM sel LEFT JOIN s1 USING (qname)""",
    "fragment_selection_counters": _BEST
    + _R1
    + """ SELECT cell, count(*) AS selected, count(*) FILTER (q_start <> 0) AS clipped, count(*) FILTER (q_start = 0) AS written,
count(*) FILTER (q_start = 0 AND (phase <> '.' OR p1 IS NOT NULL)) AS phased, count(*) FILTER (q_start = 0 AND phase = '.' AND p1 IS NOT NULL) AS by_r1,
count(*) FILTER (q_start = 0 AND phase <> '.' AND phase <> p1) AS conflicts FROM chosen LEFT JOIN s1 USING (qname) GROUP BY cell""",
    "dedup_islands_one_pass": cte("fragments") + ", " + _dedup_sql("chrom", "fragments", _F, False),
    "dedup_islands_two_pass": cte("fragments") + ", " + _dedup_sql("chrom", "fragments", _F),
    "dedup_islands_splitpool": cte("fragments") + ", " + _dedup_sql("cell, chrom", "fragments", _F),
    "dup_rate_by_cell": cte("fragments")
    + ", k AS (WITH "
    + _dedup_sql("cell, chrom", "fragments", "cell")
    + "), a AS (SELECT cell, count(*) AS n FROM fragments GROUP BY cell), b AS (SELECT cell, count(*) AS m FROM k GROUP BY cell) SELECT cell, n AS raw, coalesce(m, 0) AS kept, 1 - coalesce(m, 0) / n AS rate FROM a LEFT JOIN b USING (cell)",
    "cohort_fragments_distinct_sorted": cte("fragments") + ' SELECT DISTINCT chrom, start, "end", cell, 1 AS n FROM fragments',
    "bin_counts_5k": cte("fragments") + ' SELECT cell, chrom, bin, count(*) AS n FROM (SELECT cell, chrom, unnest(range(start // 5000, ("end" - 1) // 5000 + 1)) AS bin FROM fragments) GROUP BY ALL',
    "overlap_join_points": cte("fragments", "snps") + ' SELECT f.chrom, f.q, f.ln, f.start, s.pos, s.a0 FROM fragments f JOIN snps s ON s.chrom = f.chrom AND s.pos >= f.start AND s.pos < f."end"',
    "overlap_join_intervals": cte("fragments", "genes")
    + ' SELECT g.gene, count(*) AS n, sum(least(f."end", g."end") - greatest(f.start, g.start))::BIGINT AS bases FROM fragments f JOIN genes g ON f.chrom = g.chrom AND f.start < g."end" AND g.start < f."end" GROUP BY g.gene',
    "overlap_anti": cte("fragments", "genes") + ' SELECT q, ln, price, chrom, start, "end" FROM fragments f WHERE NOT EXISTS (SELECT 1 FROM genes g WHERE f.chrom = g.chrom AND f.start < g."end" AND g.start < f."end")',
    "overlap_semi_counts": cte("fragments", "tss") + ' SELECT f.chrom, count(*) AS hits, count(DISTINCT t.pos) AS windows FROM fragments f JOIN tss t ON f.chrom = t.chrom AND f.start < t.pos + 20 AND t.pos - 20 < f."end" GROUP BY f.chrom',
    "overlap_fraction_filter": cte("fragments", "genes")
    + ', g AS (SELECT chrom, start, "end" + 25 AS "end" FROM genes), '
    + _union("chrom", "g", '"end"', 0)
    + """, r AS (SELECT chrom, component, min(start) AS start, max("end") AS "end" FROM v GROUP BY ALL),
f AS (SELECT DISTINCT q, ln, price, chrom, start, "end" FROM fragments),
c AS (SELECT f.q, f.ln, f.price, f.chrom, f.start, f."end", sum(least(f."end", r."end") - greatest(f.start, r.start)) AS n FROM f JOIN r ON f.chrom = r.chrom AND f.start < r."end" AND r.start < f."end" GROUP BY ALL)
SELECT * FROM f ANTI JOIN (SELECT * FROM c WHERE n >= 30 AND n >= 0.5 * ("end" - start)) USING (q, ln, price, chrom, start, "end")""",
    "interval_union_components": cte("genes") + ", " + _union("chrom", "genes", '"end", gene', 0) + ' SELECT chrom, gene, start, "end", component::BIGINT AS component FROM v',
    "cluster_best_mapq": cte("fragments")
    + _POINTS.format("mapq > 20 AND chrom BETWEEN 1 AND 19")
    + _union("cell, chrom", "f", _POINT_TIES, 10)
    + f' SELECT cell, chrom, start - 75 AS start, "end" + 75 AS "end", mapq, q, ln, price FROM v QUALIFY row_number() OVER (PARTITION BY cell, chrom, component ORDER BY mapq DESC, start, {_POINT_TIES}) = 1',
    "cluster_then_filter": cte("fragments")
    + _POINTS.format("true")
    + _union("cell, chrom", "f", _POINT_TIES, 10)
    + f" SELECT DISTINCT q FROM (SELECT q FROM v WHERE mapq >= 20 QUALIFY row_number() OVER (PARTITION BY cell, chrom, component ORDER BY mapq DESC, start, {_POINT_TIES}) = 1)",
    "coverage_steps": cte("fragments") + _COVERAGE + ' SELECT chrom, pos AS start, nxt AS "end", depth::BIGINT AS depth FROM run WHERE depth > 0',
    "coverage_cpm": cte("fragments") + _COVERAGE + ', t AS (SELECT chrom, count(*) AS n FROM fragments GROUP BY chrom) SELECT chrom, pos AS start, nxt AS "end", round(depth::DOUBLE * 1e6 / n, 6) AS cpm FROM run JOIN t USING (chrom) WHERE depth > 0',
    "binned_rpkm": cte("fragments")
    + """, b AS (SELECT cell, chrom, bin, count(*) AS n FROM (SELECT cell, chrom, unnest(range(start // 100, ("end" - 1) // 100 + 1)) AS bin FROM fragments) GROUP BY ALL),
t AS (SELECT cell, count(*) AS total FROM fragments GROUP BY cell) SELECT cell, chrom, bin, round(n * 1e9::DOUBLE / (total * 100), 6) AS rpkm FROM b JOIN t USING (cell)""",
    "snp_vote_phase": cte("alignments", "snps")
    + """, a AS (SELECT DISTINCT qname, ln, price, chrom, start, "end", base FROM alignments),
v AS (SELECT a.qname, a.ln, a.price, a.chrom, a.start, a."end", a.base, count(*) FILTER (base = a0) AS n0, count(*) FILTER (base = a1) AS n1, count(*) FILTER (base <> a0 AND base <> a1) AS other
FROM a JOIN snps s ON a.chrom = s.chrom AND s.pos >= a.start AND s.pos < a."end" GROUP BY ALL)
SELECT *, CASE WHEN n0 > 0 AND n1 = 0 THEN '0' WHEN n1 > 0 AND n0 = 0 THEN '1' ELSE '.' END AS phase FROM v""",
    "annotated_records": _RECORDS,
    "annotated_records_by_sweep": _RECORDS,
    "flag_mapq_counts": cte("alignments")
    + """ SELECT cell, count(*) AS total, count(*) FILTER ((flag & 4) = 0) AS mapped, count(*) FILTER ((flag & 4) = 0 AND mapq >= 10) AS qualifying,
count(*) FILTER ((flag & 4) = 0 AND mapq >= 8 AND chrom BETWEEN 1 AND 3) AS x, count(*) FILTER ((flag & 4) = 0 AND mapq >= 8 AND chrom = 0) AS y FROM alignments GROUP BY cell""",
    "sex_call_state": cte("alignments")
    + """, c AS (SELECT cell, count(*) FILTER ((flag & 4) = 0 AND mapq >= 10 AND cell <> 7) AS good,
count(*) FILTER ((flag & 4) = 0 AND mapq >= 8 AND chrom BETWEEN 1 AND 3) AS x, count(*) FILTER ((flag & 4) = 0 AND mapq >= 8 AND chrom = 0) AS y FROM alignments GROUP BY cell),
r AS (SELECT *, round(y / greatest(x, 1)::DOUBLE, 6) AS r FROM c)
SELECT cell, 'low_mapq_only' AS input_state, 'not_applicable' AS sex_state, '' AS sex_call, false AS fallback_applied, 'not_applicable' AS ratio_state, false AS measured, NULL::DOUBLE AS measured_yperx, NULL::DOUBLE AS effective_yperx FROM r WHERE good = 0
UNION ALL SELECT cell, 'qualifying_mapped_records', 'undetermined_no_xy', 'XX', true, 'undefined_zero_zero', false, NULL, 0 FROM r WHERE good > 0 AND x = 0 AND y = 0
UNION ALL SELECT cell, 'qualifying_mapped_records', 'xy_y_only', 'XY', false, 'positive_infinity', false, NULL, r FROM r WHERE good > 0 AND x = 0 AND y > 0
UNION ALL SELECT cell, 'qualifying_mapped_records', CASE WHEN y = 0 THEN 'xx_x_only' WHEN r > 0.3 THEN 'xy_ratio' ELSE 'xx_ratio' END, CASE WHEN r > 0.3 THEN 'XY' ELSE 'XX' END, false, 'finite', true, r, r FROM r WHERE good > 0 AND x > 0""",
    "compat_classes_rollup": """WITH t AS (
  SELECT l_orderkey AS q, l_suppkey % 50 AS cell, l_linenumber % 2 AS mate, CASE WHEN l_returnflag <> 'R' THEN 'G' || (l_partkey % 40) END AS gene, l_partkey % 8 AS token, l_quantity AS mapq FROM lineitem
), p AS (
  SELECT q, min(cell) AS cell, coalesce(list(DISTINCT gene) FILTER (mate = 1 AND gene IS NOT NULL), []) AS g1, coalesce(list(DISTINCT gene) FILTER (mate = 0 AND gene IS NOT NULL), []) AS g2,
    coalesce(list(DISTINCT token) FILTER (mate = 1 AND gene IS NOT NULL), []) AS t1, coalesce(list(DISTINCT token) FILTER (mate = 0 AND gene IS NOT NULL), []) AS t2,
    coalesce(max(mapq) FILTER (mate = 0) >= 25, false) AS r2 FROM t GROUP BY q
), c AS (
  SELECT cell, CASE WHEN len(g1) = 0 THEN 'a' WHEN len(g2) = 0 THEN CASE WHEN r2 THEN 'c' ELSE 'b' END WHEN list_has_any(g1, g2) OR list_has_any(t1, t2) THEN 'd' ELSE 'e' END AS k FROM p
), s AS (
  SELECT CASE WHEN grouping(cell) = 1 THEN 'ALL' ELSE cell::VARCHAR END AS cell, count(*) AS pairs, count(*) FILTER (k = 'a') AS r1_uninformative, count(*) FILTER (k = 'b') AS r2_uninformative,
    count(*) FILTER (k = 'c') AS r2_genome_only, count(*) FILTER (k = 'd') AS concordant, count(*) FILTER (k = 'e') AS incompatible FROM c GROUP BY ROLLUP (cell)
) SELECT *, pairs - r2_genome_only - incompatible AS compatible, (pairs - r2_genome_only - incompatible) / pairs AS compatible_share, concordant / pairs AS concordant_share FROM s""",
    "gene_component_tokens": cte("genes")
    + """, s AS (SELECT chrom, gene % 2000 AS gene_id, min(start) AS start, max("end") AS "end" FROM genes GROUP BY ALL), """
    + _union("chrom", "s", '"end", gene_id', 0)
    + " SELECT gene_id, string_agg(DISTINCT chrom || ':' || component, ',' ORDER BY chrom || ':' || component) AS tokens FROM v GROUP BY gene_id",
    "feature_assignment": cte("fragments", "genes")
    + """, f AS (SELECT DISTINCT q, ln, price, chrom, start, "end", strand FROM fragments WHERE mapq >= 30)
SELECT f.q, f.ln, f.price, f.chrom, f.start, f."end", f.strand, string_agg(DISTINCT g.gene::VARCHAR, ',' ORDER BY g.gene::VARCHAR) AS genes
FROM f JOIN genes g ON f.chrom = g.chrom AND f.strand = g.strand AND f.start < g."end" AND g.start < f."end" GROUP BY ALL""",
    "umi_unique_counts": _UMI_COUNTS + " SELECT * FROM c",
    "umi_matrix_pivot": _UMI_COUNTS + " SELECT gene, " + ", ".join(f"coalesce(sum(n) FILTER (cell = {k}), 0)::BIGINT AS cell_{k}" for k in (*range(50), 777)) + " FROM c GROUP BY gene",
    "fraction_split_sum": _UMI_COUNTS + " SELECT cell, g AS gene, round(sum(n / len(string_split(gene, ','))), 6) AS n FROM (SELECT *, unnest(string_split(gene, ',')) AS g FROM c) GROUP BY cell, g",
    "matrix_mode_summary": _UMI_COUNTS
    + """, m AS (SELECT 'all' AS mode, * FROM c UNION ALL SELECT 'single', * FROM c WHERE gene NOT LIKE '%,%'), p AS (SELECT mode, cell, sum(n)::BIGINT AS umis, count(*) FILTER (n <> 0) AS features FROM m GROUP BY ALL)
SELECT mode, count(*) AS cells, sum(umis)::BIGINT AS total, median(umis) AS median, min(umis) AS least, max(umis) AS most, sum(features)::BIGINT AS cell_features FROM p GROUP BY mode""",
    "cell_qc_metadata": cte("contacts", "umis")
    + """, li AS (SELECT * FROM contacts WHERE cell IN (SELECT s_suppkey % 50 FROM supplier)), d AS (SELECT cell, count(*) AS dna_reads FROM li GROUP BY cell),
b AS (SELECT cell, count(*) AS pairs, count(*) FILTER (chr1 <> chr2) AS inter_pairs FROM li GROUP BY cell), r AS (SELECT cell, count(*) AS rna_reads FROM umis GROUP BY cell)
SELECT s_suppkey AS cell, coalesce(dna_reads, 0) AS dna_reads, coalesce(pairs, 0) AS pairs, coalesce(inter_pairs, 0) AS inter_pairs, coalesce(rna_reads, 0) AS rna_reads,
round(coalesce(rna_reads / dna_reads, 0), 9) AS rna_reads_ratio, round(coalesce(pairs / dna_reads, 0), 9) AS pairs_per_read, round(coalesce(inter_pairs / pairs, 0), 9) AS inter_pairs_ratio, round(coalesce(dna_reads / 2 * 300 / 1e9::DOUBLE, 0), 9) AS gigabases
FROM supplier LEFT JOIN d ON d.cell = s_suppkey LEFT JOIN b ON b.cell = s_suppkey LEFT JOIN r ON r.cell = s_suppkey""",
    "split_read_totals": cte("contacts")
    + ", "
    + ", ".join(f"p{k} AS (SELECT q, count(*) AS reads_{k} FROM contacts WHERE ln % 3 = {k} GROUP BY q)" for k in range(3))
    + " SELECT q, reads_0, reads_1, reads_2 FROM p0 FULL JOIN p1 USING (q) FULL JOIN p2 USING (q)",
    "cohort_set_diff": """WITH e AS (SELECT DISTINCT s_suppkey AS cell FROM supplier), f AS (SELECT DISTINCT l_suppkey + 3 AS cell FROM lineitem)
SELECT cell, 'missing' AS status FROM (SELECT * FROM e EXCEPT SELECT * FROM f) UNION ALL SELECT cell, 'unexpected' FROM (SELECT * FROM f EXCEPT SELECT * FROM e)""",
    "contract_field_diff": """WITH a AS (SELECT s_suppkey AS cell, 'name' AS field, s_name AS v FROM supplier UNION ALL SELECT s_suppkey, 'nation', s_nationkey::VARCHAR FROM supplier),
b AS (SELECT c_custkey AS cell, 'name' AS field, c_name AS v FROM customer UNION ALL SELECT c_custkey, 'nation', c_nationkey::VARCHAR FROM customer)
SELECT cell, field, a.v AS stored, b.v AS live FROM a FULL JOIN b USING (cell, field) WHERE a.v IS DISTINCT FROM b.v""",
    "expected_missing": """WITH g AS (SELECT s_suppkey AS cell, resolution FROM supplier, (VALUES ('20k'), ('50k'), ('100k')) AS r(resolution)),
t AS (SELECT DISTINCT o_custkey AS cell, CASE o_orderkey % 3 WHEN 0 THEN '20k' WHEN 1 THEN '50k' ELSE '1m' END AS resolution FROM orders) SELECT * FROM g EXCEPT SELECT * FROM t""",
    "cell_codes": "SELECT s_suppkey AS cell, s_name AS sample_name, 'C' || substr(sha256(s_name), 1, 16) AS code FROM supplier",
    "inter_chrom_counts": cte("contacts") + " SELECT cell, count(*) AS pairs, count(*) FILTER (chr1 <> chr2) AS inter FROM contacts GROUP BY cell",
    "pair_dedup": cte("contacts")
    + """, a AS (SELECT *, CASE WHEN pos1 - lag(pos1) OVER w <= 500 THEN 0 ELSE 1 END AS o1 FROM contacts WINDOW w AS (PARTITION BY chr1, chr2, strand1, strand2 ORDER BY pos1, pos2, q, ln, price, cell)),
b AS (SELECT *, sum(o1) OVER (PARTITION BY chr1, chr2, strand1, strand2 ORDER BY pos1, pos2, q, ln, price, cell ROWS UNBOUNDED PRECEDING) AS i1 FROM a),
c AS (SELECT *, CASE WHEN pos2 - lag(pos2) OVER (PARTITION BY chr1, chr2, strand1, strand2, i1 ORDER BY pos2, pos1, q, ln, price, cell) <= 500 THEN 0 ELSE 1 END AS o2 FROM b)
SELECT chr1, pos1, chr2, pos2, strand1, strand2, q, ln, price FROM c WHERE o2 = 1""",
    "chrom_whitelist_pairs": cte("contacts") + " SELECT chr1, chr2, count(*) AS n FROM contacts WHERE regexp_matches(chr1, '^(chr)?([0-9]+|[XY])$') AND regexp_matches(chr2, '^(chr)?([0-9]+|[XY])$') GROUP BY ALL",
    "segment_merge": _HITS + ' SELECT qname, segment::BIGINT AS segment, chrom, start, "end", strand, phase, mapq, n_hits FROM m',
    "adjacent_segment_pairs": _READS
    + """, l AS (SELECT *, lead(chrom) OVER w AS c2, lead(start) OVER w AS s2, lead("end") OVER w AS e2, lead(strand) OVER w AS d2, lead(phase) OVER w AS p2, row_number() OVER w - 1 AS i FROM segs WINDOW w AS (PARTITION BY qname ORDER BY segment))
SELECT qname, i, chrom AS chr1, "end" AS pos1, c2 AS chr2, s2 AS pos2, strand AS strand1, d2 AS strand2, phase AS phase1, p2 AS phase2 FROM l WHERE c2 IS NOT NULL""",
    "segments_to_bed": _READS
    + """, f AS (SELECT qname, arg_min(phase, segment) FILTER (read_num = 1 AND phase <> '.') AS fb FROM segs GROUP BY qname)
SELECT chrom, start, "end", qname, mapq, strand, CASE WHEN phase = '.' THEN coalesce(fb, '.') ELSE phase END AS phase FROM segs JOIN f USING (qname) WHERE read_num = 2""",
    "clean_crowded_legs": _DISTINCT_CONTACTS
    + """, legs AS (SELECT cell, q, ln, price, chr1 AS chrom, pos1 AS pos FROM c UNION ALL SELECT cell, q, ln, price, chr2, pos2 FROM c),
n AS (SELECT *, count(*) OVER (PARTITION BY cell, chrom ORDER BY pos RANGE BETWEEN 20000 PRECEDING AND 20000 FOLLOWING) - 1 AS near FROM legs)
SELECT cell, q, ln, price FROM c ANTI JOIN (SELECT DISTINCT cell, q, ln, price FROM n WHERE near > 12) USING (cell, q, ln, price)""",
    "clean_isolated_contacts": _DISTINCT_CONTACTS
    + """ SELECT cell, q, ln, price FROM c SEMI JOIN (
SELECT a.cell, a.q, a.ln, a.price FROM c a JOIN c b ON a.cell = b.cell AND a.chr1 = b.chr1 AND a.chr2 = b.chr2 AND abs(a.pos1 - b.pos1) <= 400000 AND abs(a.pos2 - b.pos2) <= 400000 AND (a.q, a.ln, a.price) <> (b.q, b.ln, b.price)
GROUP BY a.cell, a.q, a.ln, a.price HAVING count(*) >= 2) USING (cell, q, ln, price)""",
    "clean_spliced_contacts": _DISTINCT_CONTACTS
    + """, e AS (SELECT 'chr' || (p_partkey % 23) AS chrom, p_partkey * 900 AS s, p_partkey * 900 + 40000 AS f, p_partkey % 200 AS gene FROM part),
legs AS (SELECT cell, q, ln, price, 1 AS leg, chr1 AS chrom, pos1 AS pos FROM c UNION ALL SELECT cell, q, ln, price, 2, chr2, pos2 FROM c),
g AS (SELECT cell, q, ln, price, gene FROM legs JOIN e ON legs.chrom = e.chrom AND pos >= s AND pos < f GROUP BY ALL HAVING count(DISTINCT leg) = 2)
SELECT cell, q, ln, price FROM c ANTI JOIN (SELECT DISTINCT cell, q, ln, price FROM g) USING (cell, q, ln, price)""",
    "library_complexity": cte("fragments")
    + """, e AS (SELECT chrom, start // 700 AS start, strand, mapq, count(*) AS n FROM fragments GROUP BY ALL), s AS (SELECT sum(n)::BIGINT AS total, count(*) AS distinct_, count(*) FILTER (n = 1) AS s1, count(*) FILTER (n = 2) AS s2 FROM e)
SELECT total, distinct_ AS "distinct", s1 AS singletons, s2 AS doubletons, round(distinct_ / total, 9) AS nrf, round(s1 / distinct_, 9) AS pbc1, round(CASE WHEN s2 > 0 THEN s1 / s2 ELSE -1.0 END, 9) AS pbc2 FROM s""",
    "contamination_regex": "SELECT source, count(*) AS reads, count(*) FILTER (regexp_matches(text, 'th[aeiou][a-z]{2} [aeo]')) AS hits, round(count(*) FILTER (regexp_matches(text, 'th[aeiou][a-z]{2} [aeo]')) / count(*) * 100, 9) AS percent FROM documents GROUP BY source",
    "adapter_argmax": """WITH h AS (SELECT text FROM documents WHERE doc_id < 250000), c AS (SELECT count(*) FILTER (contains(text, 'thing')) AS a, count(*) FILTER (contains(text, 'ation')) AS b, count(*) FILTER (contains(text, 'queue')) AS c FROM h)
SELECT a, b, c, CASE WHEN greatest(a, b, c) = 0 THEN '' WHEN a = greatest(a, b, c) THEN 'a' WHEN b = greatest(a, b, c) THEN 'b' ELSE 'c' END AS best FROM c""",
    "demultiplex_prefix": """WITH d AS (SELECT upper(text) AS s FROM documents) SELECT split, count(*) AS n FROM (
SELECT 'x' AS split FROM d WHERE regexp_matches(s, '^[ACGTN][ACGTN]TH') OR regexp_matches(s, '^[ACGTN]TH') UNION ALL
SELECT 'y' FROM d WHERE regexp_matches(s, '^QUE[ACGTN]|^UE[ACGTN]|^E[ACGTN]') UNION ALL SELECT 'z' FROM d WHERE regexp_matches(s, '^LE[ACGTN]A|^E[ACGTN]A|^[ACGTN]A')) GROUP BY split""",
    "umi_extraction": "SELECT 'C' || substr(sha256(source), 1, 16) AS code, count(*) AS reads, count(DISTINCT substr(text, 1, 8)) AS umis FROM documents GROUP BY source",
    "tss_profile_score": cte("fragments", "tss")
    + """, cuts AS (SELECT cell, chrom, start AS site FROM fragments UNION ALL SELECT cell, chrom, "end" - 1 FROM fragments), pile AS (
  SELECT s.cell, CASE WHEN t.strand = '-' THEN t.pos - s.site ELSE s.site - t.pos END AS off FROM tss t JOIN cuts s ON s.chrom = t.chrom AND s.site BETWEEN t.pos - 1000 AND t.pos + 1000
), p AS (SELECT cell, count(*) FILTER (off BETWEEN -1000 AND -901 OR off BETWEEN 901 AND 1000) AS e, count(*) FILTER (off BETWEEN -501 AND 499) AS k, count(*) AS n FROM pile GROUP BY cell),
t AS (SELECT c.cell, coalesce(e, 0) / 200 AS flank, coalesce(k, 0) AS k, coalesce(n, 0) AS n FROM (SELECT DISTINCT cell FROM fragments) c LEFT JOIN p USING (cell)), a AS (SELECT avg(flank) AS m FROM t),
z AS (SELECT cell, n AS insertions, CASE WHEN n > 0 THEN round(k / 1001 / nullif(CASE WHEN flank = 0 THEN m ELSE flank END, 0), 9) END AS tss_score FROM t, a)
SELECT *, CASE WHEN insertions > 0 AND isfinite(tss_score) THEN 'ok' ELSE 'insufficient_data' END AS status FROM z""",
    "bulk_tss_signal": cte("fragments", "tss")
    + _pile(2000)
    + """, b AS (SELECT floor((off + 2000) / 10)::BIGINT AS bin, count(*) AS n FROM pile WHERE off < 2000 GROUP BY 1), z AS (SELECT sum(CASE WHEN bin < 10 OR bin >= 390 THEN n ELSE 0 END) / 20 AS noise FROM b)
SELECT bin, n, round(n / nullif(noise, 0), 9) AS signal FROM b, z""",
    "tn5_shift_extend": cte("fragments")
    + """, s AS (SELECT chrom, strand, CASE WHEN strand = '+' THEN start + 4 ELSE "end" - 5 END AS site FROM fragments)
SELECT chrom, strand, sum(greatest(site - 75, 0))::BIGINT AS starts, sum(site + 76)::BIGINT AS ends, min(site) AS least FROM s GROUP BY ALL""",
    "mark_duplicates": cte("fragments")
    + """, r AS (SELECT chrom, row_number() OVER (PARTITION BY chrom, strand, CASE WHEN strand = '+' THEN start ELSE "end" - 1 END ORDER BY mapq DESC, q) AS k FROM fragments)
SELECT chrom, count(*) AS n, count(*) FILTER (k > 1) AS duplicates FROM r GROUP BY chrom""",
    "insert_size_histogram": cte("fragments") + ' SELECT abs(start - "end") AS insert_size, count(*) AS n FROM fragments GROUP BY 1',
    "sample_summary": cte("fragments")
    + """, c AS (SELECT cell, count(*) AS reads, count(*) FILTER (chrom = 3) AS mt_reads, count(*) FILTER (mapq >= 30) AS final_reads FROM fragments GROUP BY cell)
SELECT *, floor(mt_reads / reads * 10000) / 10000 AS mt_rate, floor(final_reads / reads * 10000) / 10000 AS final_rate FROM c""",
    "common_particles": cte("particles") + " SELECT chrom, pos FROM particles GROUP BY chrom, pos HAVING count(DISTINCT structure) = 3",
    "compartment_score": cte("pairs_bins")
    + """, o AS (SELECT DISTINCT chrom, bin1, bin2 FROM pairs_bins WHERE n > 0), g AS (SELECT p_partkey % 20 AS chrom, p_partkey % 50 AS bin2, max(p_size) / 100 AS cpg FROM part GROUP BY ALL)
SELECT chrom, bin1, round(sum(coalesce(cpg, 0)) / (count(*) + 1), 9) AS score FROM o LEFT JOIN g USING (chrom, bin2) GROUP BY chrom, bin1""",
    "cpg_windows": """WITH d AS (SELECT source AS chrom, doc_id AS start, upper(text) AS s FROM documents), c AS (SELECT chrom, start, ((length(s) - length(replace(s, 'CG', ''))) / 2)::BIGINT AS cpg, length(regexp_replace(s, '[^ACGT]', '', 'g'))::BIGINT AS valid FROM d)
SELECT *, round(cpg / nullif(valid, 0), 9) AS density FROM c""",
    "next_positions": cte("particles") + " SELECT chrom, pos, lead(pos) OVER (PARTITION BY chrom ORDER BY pos) AS next_pos FROM (SELECT DISTINCT chrom, pos FROM particles)",
    "rmsd_pivot": """WITH t AS (SELECT o_custkey % 100 AS cell, o_orderkey % 3 AS r, max(o_totalprice) AS v FROM orders GROUP BY ALL) SELECT cell, max(v) FILTER (r = 0) AS rmsd_20k, max(v) FILTER (r = 1) AS rmsd_50k, max(v) FILTER (r = 2) AS rmsd_100k FROM t GROUP BY cell""",
    "one_hot_phases": cte("contacts") + " SELECT cell, " + ", ".join(f"(count(*) FILTER (q % 5 = {k}))::DOUBLE AS p{k}" for k in range(4)) + " FROM contacts GROUP BY cell",
    "merged_gene_spans": cte("genes") + ", g AS (SELECT chrom, start, \"end\" FROM genes), " + _union("chrom", "g", '"end"', 0) + ' SELECT chrom, min(start) AS start, max("end") AS "end" FROM v GROUP BY chrom, component',
    "genome_split_counts": cte("alignments") + " SELECT cell, CASE phase WHEN '0' THEN 'genome1' WHEN '1' THEN 'genome2' ELSE 'unassigned' END AS genome, count(*) AS n FROM alignments GROUP BY ALL",
    "standard_reads": _READS + " SELECT qname, count(*) AS segments FROM segs GROUP BY qname HAVING bool_and(chrom = 'chr0')",
    "pairs_text": cte("contacts") + " SELECT concat_ws(chr(9), q, chr1, pos1, chr2, pos2, strand1, strand2, CASE WHEN ln > 3 THEN '0' ELSE '.' END) AS value FROM contacts",
    "ncc_text": cte("contacts") + " SELECT concat_ws(' ', chr1, pos1, pos1, pos1, pos1, strand1, chr2, pos2, pos2, pos2, pos2, strand2) AS value FROM contacts WHERE q % 5 < 4",
    "read_id_tags": """SELECT o_orderkey AS k, CASE WHEN o_orderkey % 3 = 0 THEN 'r' || o_orderkey || '_C' || substr(sha256(o_orderpriority), 1, 16) || '_ACGTACGT' END AS tagged,
CASE WHEN o_orderkey % 3 = 0 THEN 'ACGTACGT' END AS umi FROM orders""",
    "fragment_selection_all_counters": cte("alignments")
    + """, al AS (SELECT * REPLACE (qname % 50 AS cell) FROM alignments), good AS (SELECT *, (flag & 4) = 0 AND mapq >= 10 AS ok FROM al),
reads AS (SELECT cell, qname, count(*) FILTER (ok) AS g, count(*) FILTER (ok AND origin = 'R2' AND (flag & 256) = 0) AS g2 FROM good GROUP BY ALL),
f AS (SELECT cell, count(*) AS reads, count(*) FILTER (g > 0) AS reads_with_good, sum(g)::BIGINT AS good_alignments, count(*) FILTER (g2 > 0) AS reads_with_good_r2 FROM reads GROUP BY cell), """
    + (_BEST.split(", a AS", 1)[1].replace("FROM alignments WHERE", "FROM al WHERE") + _R1).replace(" (SELECT", "a AS (SELECT", 1)
    + """, c AS (SELECT chosen.cell, count(*) AS selected, count(*) FILTER (q_start <> 0) AS clipped, count(*) FILTER (q_start = 0) AS written, count(*) FILTER (q_start = 0 AND phase <> '.') AS phased_by_r2,
count(*) FILTER (q_start = 0 AND phase = '.' AND p1 IS NOT NULL) AS phased_by_r1, count(*) FILTER (q_start = 0 AND phase = '.' AND p1 IS NULL) AS unphased, count(*) FILTER (q_start = 0 AND coalesce(c1, false)) AS r1_conflicts,
count(*) FILTER (q_start = 0 AND phase <> '.' AND phase <> p1) AS r1_r2_conflicts FROM chosen LEFT JOIN s1 USING (qname) GROUP BY chosen.cell)
SELECT cell, reads, reads_with_good, good_alignments, reads_with_good_r2, """
    + ", ".join(f"coalesce({c}, 0) AS {c}" for c in ("selected", "clipped", "written", "phased_by_r2", "phased_by_r1", "unphased", "r1_conflicts", "r1_r2_conflicts"))
    + " FROM f LEFT JOIN c USING (cell)",
    "dedup_then_score": cte("fragments")
    + """, bed AS (SELECT chrom, start, "end", q::VARCHAR AS read_id, mapq AS score, strand, 'c' || cell AS cell, ln, price FROM fragments WHERE cell >= 5), kept AS (WITH """
    + _dedup_sql("cell, chrom", "bed", "*", tie='read_id, ln, price, start, "end", strand')
    + ') SELECT chrom, start, "end", read_id, score, strand, cell, ln, price FROM kept WHERE score > 20',
    "strand_collapse": _READS
    + """ SELECT replace(qname || chr(9) || string_agg(concat_ws('!', chrom, start, "end", strand, phase, mapq, n_hits, 'R' || read_num), chr(9) ORDER BY segment), '-', '+') AS value FROM segs GROUP BY qname""",
    "chromosome_exclusions": cte("contacts") + " SELECT chr2 AS chrom, count(*) AS n FROM contacts WHERE NOT contains(chr2, 'chrUn') AND NOT contains(chr2, 'X') AND NOT contains(chr2, 'chr1') GROUP BY chr2",
    "compat_counters_rollup": """WITH t AS (
  SELECT l_orderkey AS q, l_suppkey % 50 AS cell, l_linenumber % 2 AS mate, CASE WHEN l_returnflag <> 'R' THEN 'G' || (l_partkey % 40) END AS gene, l_partkey % 8 AS token, l_quantity AS mapq FROM lineitem
), p AS (
  SELECT q, min(cell) AS cell, coalesce(list(DISTINCT gene) FILTER (mate = 1 AND gene IS NOT NULL), []) AS g1, coalesce(list(DISTINCT gene) FILTER (mate = 0 AND gene IS NOT NULL), []) AS g2,
    coalesce(list(DISTINCT token) FILTER (mate = 1 AND gene IS NOT NULL), []) AS t1, coalesce(list(DISTINCT token) FILTER (mate = 0 AND gene IS NOT NULL), []) AS t2,
    coalesce(max(mapq) FILTER (mate = 0) >= 25, false) AS r2 FROM t GROUP BY q
), c AS (
  SELECT *, CASE WHEN len(g1) = 0 THEN 'a' WHEN len(g2) = 0 THEN CASE WHEN r2 THEN 'c' ELSE 'b' END WHEN list_has_any(g1, g2) OR list_has_any(t1, t2) THEN 'd' ELSE 'e' END AS k FROM p
), s AS (
  SELECT CASE WHEN grouping(cell) = 1 THEN 'ALL' ELSE cell::VARCHAR END AS cell, count(*) AS reads, count(*) FILTER (len(g1) > 0) AS r1_informative, count(*) FILTER (len(g2) > 0) AS r2_informative, count(*) FILTER (r2) AS r2_well_mapped,
    count(*) FILTER (k = 'a') AS r1_uninformative, count(*) FILTER (k = 'b') AS r2_uninformative, count(*) FILTER (k = 'c') AS r2_genome_only, count(*) FILTER (k = 'd') AS concordant, count(*) FILTER (k = 'e') AS incompatible FROM c GROUP BY ROLLUP (cell)
) SELECT *, reads - r2_genome_only - incompatible AS r1_compatible, r2_genome_only / nullif(r1_informative, 0) AS r2_genome_only_share, incompatible / nullif(r1_informative, 0) AS incompatible_share, concordant / nullif(r1_informative, 0) AS concordant_share FROM s""",
    "reads_by_id": "SELECT c_custkey * 3 AS read_id, l_linenumber AS ln FROM customer LEFT JOIN lineitem ON l_orderkey = c_custkey * 3",
    "plain_numbers": r"SELECT o_orderkey AS k, regexp_replace(regexp_replace(printf('%.10f', o_totalprice / 8), '0+$', ''), '\.$', '') AS shown, (o_orderkey * 100)::VARCHAR AS whole FROM orders",
    "presence_of_adapter": "SELECT doc_id FROM documents WHERE regexp_matches(translate(upper(text), ' ', 'T'), '^([ACGTN]{4}T[ACGTN]{2}|[ACGTN]{3}T[ACGTN]{2}|[ACGTN]{2}T[ACGTN]{2}|[ACGTN]T[ACGTN]{2})')",
    "session_gap_events": """WITH o AS (SELECT *, CASE WHEN ts - lag(ts) OVER w <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS o FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), s AS (SELECT *, sum(o) OVER (PARTITION BY user_id ORDER BY ts) AS k FROM o)
SELECT user_id, count(*) AS n, min(ts) AS first_ts, max(ts) AS last_ts FROM s GROUP BY user_id, k""",
    "windowed_event_counts": "SELECT event_type, date_trunc('hour', ts) AS window_start, count(*) AS n, round(sum(value), 6) AS total FROM events GROUP BY ALL",
}
