"""Test tables in the shape of the domain, as select lists that Spark and DuckDB both read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: name: (source table, [(column, expression)])
VIEWS: dict[str, tuple[str, list[tuple[str, str]]]] = {
    "fragments": (
        "lineitem",
        [
            ("chrom", "l_suppkey % 20"),
            ("start", "l_partkey * 7"),
            ("end", "l_partkey * 7 + 40 + cast(l_quantity as bigint)"),
            ("strand", "case when l_linenumber % 2 = 0 then '+' else '-' end"),
            ("cell", "l_suppkey % 50"),
            ("q", "l_orderkey"),
            ("ln", "l_linenumber"),
            ("price", "cast(round(l_extendedprice * 100) as bigint)"),
            ("mapq", "cast(l_quantity as int)"),
        ],
    ),
    "alignments": (
        "lineitem",
        [
            ("qname", "l_orderkey"),
            ("origin", "case when l_linenumber % 2 = 0 then 'R2' else 'R1' end"),
            ("flag", "case when l_linenumber > 5 then 2048 when l_linenumber = 5 then 4 when l_linenumber > 2 and l_orderkey % 4 = 1 then 256 else 0 end"),
            ("mapq", "cast(l_quantity as int)"),
            ("q_start", "cast(round(l_tax * 100) as int)"),
            ("aligned_length", "40 + cast(l_quantity as bigint) - l_partkey % 3 + l_orderkey % 4"),
            ("chrom", "l_suppkey % 20"),
            ("start", "l_partkey * 7"),
            ("end", "l_partkey * 7 + 40 + cast(l_quantity as bigint)"),
            ("strand", "case when l_linenumber % 2 = 0 then '+' else '-' end"),
            ("cell", "l_suppkey % 50"),
            ("ln", "l_linenumber"),
            ("price", "cast(round(l_extendedprice * 100) as bigint)"),
            ("base", "substr('ACGT', cast(l_linenumber % 4 as int) + 1, 1)"),
            ("phase", "case when l_discount < 0.03 then '0' when l_discount < 0.06 then '1' else '.' end"),
        ],
    ),
    # Records with clips, an insertion and a deletion: q_start S, 20 M, ins I, 15 M, del D, and what is left of 40 + mapq bases of the chromosome.
    "records": (
        "lineitem",
        [
            ("qname", "concat(cast(l_orderkey as varchar(20)), '.', cast(l_linenumber as varchar(20)), '.', cast(l_partkey as varchar(20)), '.', cast(cast(round(l_extendedprice * 100) as bigint) as varchar(20)))"),
            ("flag", "cast((case when l_linenumber % 2 = 0 then 128 else 64 end) + (case when l_suppkey % 3 = 0 then 16 else 0 end) + (case when l_linenumber = 5 then 4 else 0 end) as int)"),
            ("chrom", "l_suppkey % 20"),
            ("start", "l_partkey * 7"),
            ("mapq", "cast(l_quantity as int)"),
            ("clip", "cast(round(l_tax * 100) as int)"),
            ("ins", "cast(1 + l_orderkey % 3 as int)"),
            ("del", "cast(1 + l_partkey % 3 as int)"),
            ("letter", "cast(l_partkey % 4 as int)"),
            ("grade", "cast(l_suppkey % 5 as int)"),
        ],
    ),
    "snps": (
        "part",
        [
            ("chrom", "p_partkey % 20"),
            ("pos", "p_partkey * 7 + 11"),
            ("a0", "substr('ACGT', cast(p_partkey % 4 as int) + 1, 1)"),
            ("a1", "substr('ACGT', cast((p_partkey + 1) % 4 as int) + 1, 1)"),
        ],
    ),
    "tss": ("part", [("chrom", "p_partkey % 20"), ("pos", "p_partkey * 7 + 11"), ("strand", "case when p_partkey % 3 = 0 then '-' else '+' end")]),
    "genes": (
        "orders",
        [("chrom", "o_custkey % 10"), ("gene", "o_orderkey"), ("start", "o_orderkey * 3"), ("end", "o_orderkey * 3 + cast(floor(o_totalprice / 60000) as bigint) + 1"), ("strand", "case when o_orderkey % 2 = 0 then '+' else '-' end")],
    ),
    "umis": (
        "lineitem",
        [("cell", "l_suppkey % 50"), ("gene", "case when l_partkey % 3 = 0 then concat('G', cast(l_partkey % 25 as varchar(9)), ',H', cast(l_partkey % 7 as varchar(9))) else concat('G', cast(l_partkey % 25 as varchar(9))) end"), ("umi", "cast(l_orderkey % 4096 as varchar(9))")],
    ),
    "contacts": (
        "lineitem",
        [
            ("cell", "l_suppkey % 50"),
            ("chr1", "concat('chr', cast(l_suppkey % 23 as varchar(9)))"),
            ("pos1", "l_partkey * 1000"),
            ("chr2", "case when l_partkey % 23 = 22 then 'chrX' when l_partkey % 23 = 21 then 'chrUn_1' else concat('chr', cast(l_partkey % 23 as varchar(9))) end"),
            ("pos2", "l_orderkey * 100"),
            ("strand1", "case when l_linenumber % 2 = 0 then '+' else '-' end"),
            ("strand2", "case when l_orderkey % 2 = 0 then '+' else '-' end"),
            ("q", "l_orderkey"),
            ("ln", "l_linenumber"),
            ("price", "cast(round(l_extendedprice * 100) as bigint)"),
        ],
    ),
    "hits": (
        "lineitem",
        [
            ("qname", "l_orderkey"),
            ("read_num", "cast(2 - l_linenumber % 2 as int)"),
            ("q_start", "cast(l_quantity as int)"),
            ("chrom", "concat('chr', cast(l_suppkey % 2 as varchar(9)))"),
            ("start", "l_partkey % 2000"),
            ("end", "l_partkey % 2000 + 50 + cast(l_quantity as bigint)"),
            ("strand", "case when l_partkey % 3 = 0 then '-' else '+' end"),
            ("phase", "case when l_discount < 0.03 then '0' when l_discount < 0.06 then '1' else '.' end"),
            ("mapq", "cast(l_quantity as int)"),
            ("price", "cast(round(l_extendedprice * 100) as bigint)"),
            ("ln", "l_linenumber"),
        ],
    ),
    "pairs_bins": ("lineitem", [("chrom", "l_suppkey % 20"), ("bin1", "l_partkey % 50"), ("bin2", "l_orderkey % 50"), ("n", "cast(l_quantity as bigint)")]),
    "particles": ("lineitem", [("structure", "cast(l_linenumber % 3 as int)"), ("chrom", "l_suppkey % 20"), ("pos", "l_partkey")]),
    "cells": ("supplier", [("cell", "s_suppkey"), ("sample_name", "s_name")]),
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    source, columns = VIEWS[name]
    return spark.read.parquet(f"{sf_dir}/{source}.parquet").selectExpr(*[f"{e} as `{c}`" for c, e in columns])


def cte(*names: str) -> str:
    """The views as DuckDB common table expressions."""
    parts = []
    for n in names:
        source, columns = VIEWS[n]
        parts.append(f"{n} AS (SELECT {', '.join(f'{e} AS "{c}"' for c, e in columns)} FROM {source})")
    return "WITH " + ", ".join(parts)
