"""Chromatin contacts: segments of a read, pairs of segments, filters, de-duplication and cleaning."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .intervals import BIN, SEGMENT, bins, island_starts, islands, overlap_join

#: Wanted chromosomes (fixed values).
STANDARD = r"^(chr)?([0-9]+|[XY])$"
NO_Y = r"^(chr)?([0-9]+|X)$"
#: Squares along a side of the tiles by which contacts are dealt.
TILE = 16


def merge_hits(hits: DataFrame, ties: tuple[str, ...] = (), gap: int = 500) -> DataFrame:
    """Segments of a read: adjacent hits of one strand and chromosome, nearer than ``gap``, become one.

    Hits (qname, read_num, q_start, chrom, start, end, strand, phase, mapq) are in the order of the read; ``read_num`` is 1 for R1 and 2 for R2.  A
    hit is compared with the hit before it, not with the merged segment: its start less the other's end, on the reverse strand its end less the other's
    start, from -``gap`` up to but without ``gap``.  A segment runs from its first hit to its last, has the phase of the first, the greatest mapq and the
    number of hits.
    """
    order = W.partitionBy("qname").orderBy("read_num", "q_start", *ties)
    before = lambda c: F.lag(c).over(order)
    distance = F.when(F.col("strand") == "+", F.col("start") - before("end")).otherwise(F.col("end") - before("start"))
    joins = (F.col("strand") == before("strand")) & (F.col("chrom") == before("chrom")) & (distance >= -gap) & (distance < gap)
    h = hits.withColumn("opens", F.when(joins, 0).otherwise(1)).withColumn("place", F.row_number().over(order))
    h = h.withColumn("segment", F.sum("opens").over(order.rowsBetween(W.unboundedPreceding, W.currentRow)))
    g = h.groupBy("qname", "segment").agg(
        F.min_by("chrom", "place").alias("chrom"),
        F.min_by("strand", "place").alias("strand"),
        F.min_by("start", "place").alias("first_start"),
        F.min_by("end", "place").alias("first_end"),
        F.max_by("start", "place").alias("last_start"),
        F.max_by("end", "place").alias("last_end"),
        F.min_by("phase", "place").alias("phase"),
        F.min_by("read_num", "place").alias("read_num"),
        F.max("mapq").alias("mapq"),
        F.count("*").alias("n_hits"),
    )
    forward = F.col("strand") == "+"
    return g.select(
        "qname", "segment", "read_num", "chrom", F.when(forward, F.col("first_start")).otherwise(F.col("last_start")).alias("start"), F.when(forward, F.col("last_end")).otherwise(F.col("first_end")).alias("end"), "strand", "phase", "mapq", "n_hits"
    )


def resolve_reads(hits: DataFrame, ties: tuple[str, ...] = (), gap: int = 500) -> DataFrame:
    """Segment lists per read with at least two hits and two segments.

    Four segments where 1 and 3, and 2 and 4, overlap by more than half of the shorter one on the same chromosome and strand are two mates that read
    the same two places: the first two stay.
    """
    s = merge_hits(hits, ties, gap)
    lists = s.groupBy("qname").agg(F.sort_array(F.collect_list(F.struct("segment", "chrom", "start", "end", "strand", "phase", "mapq", "n_hits", "read_num"))).alias("segs"), F.sum("n_hits").alias("hits"))
    lists = lists.where((F.col("hits") >= 2) & (F.size("segs") >= 2))

    def alike(i: int, j: int) -> Column:
        a, b = F.element_at("segs", i), F.element_at("segs", j)
        shared = F.least(a["end"], b["end"]) - F.greatest(a["start"], b["start"])
        shorter = F.least(a["end"] - a["start"], b["end"] - b["start"])
        return (a["chrom"] == b["chrom"]) & (a["strand"] == b["strand"]) & (shared > 0.5 * shorter)

    four = (F.size("segs") == 4) & F.when(F.size("segs") == 4, alike(1, 3) & alike(2, 4)).otherwise(False)
    return lists.select("qname", F.when(four, F.slice("segs", 1, 2)).otherwise(F.col("segs")).alias("segs"))


def adjacent_pairs(reads: DataFrame) -> DataFrame:
    """Contacts between neighbouring segments: the end of the left one and the start of the right one, whatever their strands."""
    n = F.size("segs")
    pairs = reads.where(n >= 2).select("qname", F.posexplode(F.arrays_zip(F.slice("segs", F.lit(1), n - 1).alias("l"), F.slice("segs", F.lit(2), n - 1).alias("r"))).alias("i", "p"))
    l, r = F.col("p.l"), F.col("p.r")  # noqa: E741
    return pairs.select(
        "qname",
        "i",
        l["chrom"].alias("chr1"),
        l["end"].alias("pos1"),
        r["chrom"].alias("chr2"),
        r["start"].alias("pos2"),
        l["strand"].alias("strand1"),
        r["strand"].alias("strand2"),
        l["phase"].alias("phase1"),
        r["phase"].alias("phase2"),
    )


def standard_pairs(pairs: DataFrame, pattern: str = STANDARD) -> DataFrame:
    return pairs.where(F.col("chr1").rlike(pattern) & F.col("chr2").rlike(pattern))


def standard_reads(reads: DataFrame, pattern: str = STANDARD) -> DataFrame:
    """Reads all of whose segments lie on wanted chromosomes."""
    return reads.where(F.forall("segs", lambda s: s["chrom"].rlike(pattern)))


def without_regions(reads: DataFrame, regions: DataFrame, min_length: int = 30, min_fraction: float = 0.5) -> DataFrame:
    """Drop reads with a segment that ``regions`` (disjoint; chrom, start, end) cover by length and fraction."""
    items = reads.select("qname", F.posexplode("segs").alias("i", "s")).select("qname", "i", "s.chrom", "s.start", "s.end")
    hits = overlap_join(items, regions, ["chrom"])
    shared = F.least("l_end", "r_end") - F.greatest("l_start", "r_start")
    bad = hits.groupBy(F.col("l_qname").alias("qname"), "l_i").agg(F.sum(shared).alias("covered"), F.first(F.col("l_end") - F.col("l_start")).alias("n"))
    bad = bad.where((F.col("covered") >= min_length) & (F.col("covered") >= min_fraction * F.col("n"))).select("qname").distinct()
    return reads.join(bad, "qname", "left_anti")


def collapsed_strands(lines: DataFrame, value: str = "value") -> DataFrame:
    """Lines of segments without strands: every ``-`` of a line, in names too, becomes ``+``."""
    return lines.withColumn(value, F.translate(F.col(value), "-", "+"))


def segment_lines(reads: DataFrame) -> DataFrame:
    """Reads as lines of segments, ``chrom!start!end!strand!phase!mapq!hits!read`` each, where the read is ``R1``, ``R2`` or ``.``."""
    read = lambda s: F.when(s["read_num"] == 1, "R1").when(s["read_num"] == 2, "R2").otherwise(".")
    item = lambda s: F.concat_ws("!", *[s[c].cast("string") for c in ("chrom", "start", "end", "strand", "phase", "mapq", "n_hits")], read(s))
    return reads.select(F.concat_ws("\t", F.col("qname").cast("string"), F.array_join(F.transform("segs", item), "\t")).alias("value"))


def segments_to_bed(reads: DataFrame, origin: int = 2) -> DataFrame:
    """R2 segments as BED rows; an unphased one takes the first phase of an R1 segment of the read."""
    r1 = F.filter("segs", lambda s: (s["read_num"] == 3 - origin) & (s["phase"] != "."))
    fallback = F.coalesce(F.get(r1, F.lit(0))["phase"], F.lit("."))
    items = reads.select("qname", fallback.alias("fallback"), F.explode(F.filter("segs", lambda s: s["read_num"] == origin)).alias("s"))
    return items.select("s.chrom", "s.start", "s.end", "qname", "s.mapq", "s.strand", F.when(F.col("s.phase") == ".", F.col("fallback")).otherwise(F.col("s.phase")).alias("phase"))


def interchromosomal(pairs: DataFrame, key: str) -> DataFrame:
    return pairs.groupBy(key).agg(F.count("*").alias("pairs"), F.count_if(F.col("chr1") != F.col("chr2")).alias("inter"))


def dedup_pairs(pairs: DataFrame, keys: list[str], order: list[str], distance: int) -> DataFrame:
    """One contact per group whose two legs chain within ``distance``: islands along pos1, then along pos2 in each.

    ``keys`` hold chromosomes and strands.  Greedy: islands of the first leg are not revised.
    """
    first = islands(pairs, keys, F.col("pos1"), order, distance).drop("pos")
    return island_starts(first, [*keys, "island"], F.col("pos2"), ["pos1", *order], distance).where("opens").drop("pos", "opens", "island")


def _legs(pairs: DataFrame, ids: list[str]) -> DataFrame:
    """Both legs of each contact, from one pass over the contacts."""
    leg = lambda k: F.struct(F.col(f"chr{k}").alias("chrom"), F.col(f"pos{k}").alias("pos"), F.lit(k).alias("leg"))
    return pairs.select(*ids, F.explode(F.array(leg(1), leg(2))).alias("l")).select(*ids, "l.*")


def clean_legs(pairs: DataFrame, ids: list[str], max_distance: int, max_count: int, segment_width: int = SEGMENT) -> DataFrame:
    """Drop contacts with a leg that has more than ``max_count`` other legs within ``max_distance``.

    Counts come from a RANGE frame, so a crowded place costs no pairs.  Frames run along segments of a chromosome; legs near a segment's border
    also go to the next one, where they are only counted.
    """
    cell = [c for c in ids if c == "cell"]
    width = max(segment_width, max_distance + 1)
    place = lambda shift: F.floor((F.col("pos") + shift) / width)
    legs = _legs(pairs, ids).withColumn("home", place(0)).withColumn("segment", F.explode(F.sequence(place(-max_distance), place(max_distance))))
    near = W.partitionBy(*cell, "chrom", "segment").orderBy("pos").rangeBetween(-max_distance, max_distance)
    crowded = legs.withColumn("near", F.count("*").over(near) - 1).where((F.col("segment") == F.col("home")) & (F.col("near") > max_count)).select(*ids).distinct()
    return pairs.join(crowded, ids, "left_anti")


def clean_isolated(pairs: DataFrame, ids: list[str], distance: int, min_support: int) -> DataFrame:
    """Keep contacts with at least ``min_support`` others whose legs are both within ``distance``.

    Contacts are dealt once, by tiles of ``TILE`` by ``TILE`` squares with sides of ``distance``; those within ``distance`` of a border also go to the next tile, where they only count.
    All else happens within a tile: contacts without another near by on both axes go, and those of a square with enough contacts stay without a comparison.
    Only the few of sparse squares are compared with their neighbourhood, ``min_support`` of a square at most.
    """
    cell = [c for c in ids if c == "cell"]
    others = [c for c in ids if c not in cell]
    keys = [*cell, "chr1", "chr2"]
    tile = [*keys, "_tx", "_ty"]
    names = list(dict.fromkeys([*ids, "chr1", "pos1", "chr2", "pos2"]))
    side = TILE * distance
    tiles = lambda c: F.explode(F.sequence(F.floor((F.col(c) - distance) / side), F.floor((F.col(c) + distance) / side)))
    d = pairs.select(*names).na.drop(subset=[*keys, "pos1", "pos2"]).withColumn("_tx", tiles("pos1")).withColumn("_ty", tiles("pos2")).repartition(*tile)
    if min_support > 0:  # contacts of one square are near each other, so squares stay whole
        for c in ("pos1", "pos2"):
            along = W.partitionBy(*tile).orderBy(c)
            gap = F.least(F.col(c) - F.lag(c).over(along), F.lead(c).over(along) - F.col(c))
            d = d.withColumn("_gap", gap).where(F.col("_gap") <= distance).drop("_gap")
    d = d.withColumn("_x", F.floor(F.col("pos1") / distance)).withColumn("_y", F.floor(F.col("pos2") / distance))
    home = (F.floor(F.col("pos1") / side) == F.col("_tx")) & (F.floor(F.col("pos2") / side) == F.col("_ty"))
    d = d.withColumn("_n", F.count("*").over(W.partitionBy(*tile, "_x", "_y")))
    d = d.withColumn("_sure", home & (F.col("_n") > min_support)).withColumn("_asks", home & (F.col("_n") <= min_support))
    at = lambda x, y, asks: F.struct((F.col("_x") + x).alias("x"), (F.col("_y") + y).alias("y"), F.lit(asks).alias("asks"))
    around = [at(x, y, True) for x in (-1, 0, 1) for y in (-1, 0, 1)]
    d = d.withColumn("_at", F.explode(F.when(F.col("_asks"), F.array(at(0, 0, False), *around)).otherwise(F.array(at(0, 0, False)))))
    d = d.withColumn("_asking", F.collect_list(F.when(F.col("_at.asks"), F.struct(*names))).over(W.partitionBy(*tile, "_at.x", "_at.y"))).where("NOT _at.asks")
    near = lambda a: (F.abs(a["pos1"] - F.col("pos1")) <= distance) & (F.abs(a["pos2"] - F.col("pos2")) <= distance) & reduce(lambda p, q: p | q, [a[c] != F.col(c) for c in others])
    vote = lambda of, n: F.struct(*[of(c).alias(c) for c in ids], F.lit(n).alias("support"))
    own = F.filter(F.array(vote(F.col, min_support)), lambda _: F.col("_sure"))
    votes = F.concat(own, F.transform(F.filter("_asking", near), lambda a: vote(lambda c: a[c], 1)))
    support = d.select(F.explode(votes).alias("v")).select("v.*").groupBy(*ids).agg(F.sum("support").alias("support"))
    return pairs.join(support.where(F.col("support") >= min_support).select(*ids), ids, "left_semi")


def clean_splicing(pairs: DataFrame, ids: list[str], exons: DataFrame) -> DataFrame:
    """Drop contacts whose two legs fall in exons (chrom, start, end, gene) of one gene.

    A bin's exons are one row, so a contact meets them once for each leg and stays one row; rows of equal ``ids`` count as one contact.
    """
    each = exons.select("chrom", "start", "end", F.struct("gene").alias("gene"), F.explode(bins(F.col("start"), F.col("end"), BIN)).alias("bin"))
    binned = each.where("start < end").groupBy("chrom", "bin").agg(F.collect_set(F.struct("start", "end", "gene")).alias("_exons"))
    d = pairs
    for k in (1, 2):
        pos = F.col(f"pos{k}")
        d = d.withColumn("_chrom", F.col(f"chr{k}")).withColumn("_bin", F.floor(pos / BIN))
        d = d.join(binned.select(F.col("chrom").alias("_chrom"), F.col("bin").alias("_bin"), "_exons"), ["_chrom", "_bin"], "left")
        here = F.transform(F.filter("_exons", lambda e: (e["start"] <= pos) & (pos < e["end"])), lambda e: e["gene"])  # noqa: B023
        d = d.withColumn(f"_genes{k}", F.when(F.size(here) > 0, here)).drop("_chrom", "_bin", "_exons")
    same = W.partitionBy(*ids)
    genes = [F.flatten(F.collect_list(f"_genes{k}").over(same)) for k in (1, 2)]
    named = reduce(lambda p, q: p & q, [F.col(c).isNotNull() for c in ids])
    return d.withColumn("_bad", named & F.arrays_overlap(*genes)).where("NOT _bad").select(*pairs.columns)
