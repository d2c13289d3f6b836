"""3D structures: common particles, superposition, RMSD, compartment scores, CpG density."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, DoubleType

from .intervals import SEGMENT, overlap_join


def common_particles(particles: DataFrame, structures: int) -> DataFrame:
    """Particles (chrom, pos) that all structures have."""
    keys = particles.groupBy("chrom", "pos").agg(F.count_distinct("structure").alias("n")).where(F.col("n") == structures)
    return particles.join(keys.select("chrom", "pos"), ["chrom", "pos"], "left_semi")


def _complete(particles: DataFrame, cell: str) -> DataFrame:
    """Particles with finite coordinates that all structures of their cell have."""
    finite = [F.col(c).isNotNull() & ~F.isnan(c) for c in "xyz"]
    good = particles.select(cell, "structure", "chrom", "pos", *[F.col(c).cast("double").alias(c) for c in "xyz"]).where(finite[0] & finite[1] & finite[2])
    size = particles.groupBy(cell).agg(F.count_distinct("structure").alias("structures"))
    there = good.groupBy(cell, "chrom", "pos").agg(F.count_distinct("structure").alias("n")).join(size, cell).where("n = structures")
    return good.join(there.select(cell, "chrom", "pos"), [cell, "chrom", "pos"], "left_semi")


def _centred(common: DataFrame, cell: str) -> tuple[DataFrame, DataFrame]:
    """Common particles relative to their structure's centroid, and the centroids."""
    centre = common.groupBy(cell, "structure").agg(*[F.avg(c).alias(f"c{c}") for c in "xyz"])
    moved = common.join(centre, [cell, "structure"])
    return moved.select(cell, "structure", "chrom", "pos", *[(F.col(c) - F.col(f"c{c}")).alias(c) for c in "xyz"]), centre


@F.pandas_udf(ArrayType(DoubleType()))
def best_rotation(sums: pd.Series) -> pd.Series:
    """From the nine sums of b's coordinates times a's: the orthogonal matrix, row by row, that turns b onto a best; mirrored if that fits better."""
    m = np.array(sums.tolist(), dtype=float).reshape(-1, 3, 3)
    u, _, v = np.linalg.svd(m)
    return pd.Series(list((u @ v).reshape(-1, 9)))


def rotations(particles: DataFrame, cell: str = "cell") -> tuple[DataFrame, DataFrame]:
    """Of each pair i < j of a cell's structures: both common particles side by side (centred), and the rotation of j onto i.

    Nine sums per pair are aggregated by Spark; the singular values of nine numbers are all that Python sees.
    """
    moved, _ = _centred(_complete(particles, cell), cell)
    a = moved.select(cell, "chrom", "pos", F.col("structure").alias("i"), *[F.col(c).alias(f"a{c}") for c in "xyz"])
    b = moved.select(cell, "chrom", "pos", F.col("structure").alias("j"), *[F.col(c).alias(f"b{c}") for c in "xyz"])
    both = a.join(b, [cell, "chrom", "pos"]).where("i < j")
    sums = both.groupBy(cell, "i", "j").agg(F.array(*[F.sum(F.col(f"b{p}") * F.col(f"a{q}")) for p in "xyz" for q in "xyz"]).alias("sums"))
    return both, sums.select(cell, "i", "j", best_rotation("sums").alias("r"))


def deviations(particles: DataFrame, cell: str = "cell") -> DataFrame:
    """Per cell, pair i < j and common particle: the distance ``d`` after superposition."""
    both, turns = rotations(particles, cell)
    turned = [sum((F.col(f"b{p}") * F.get("r", F.lit(3 * k + q)) for k, p in enumerate("xyz")), F.lit(0.0)) - F.col(f"a{c}") for q, c in enumerate("xyz")]
    return both.join(turns, [cell, "i", "j"]).select(cell, "chrom", "pos", "i", "j", F.sqrt(sum((t * t for t in turned), F.lit(0.0))).alias("d"))


def pair_rmsd(deviation: DataFrame, cell: str = "cell") -> DataFrame:
    """Per cell and pair of structures, from ``deviations``: RMSD and median deviation over the particles that all structures of the cell have."""
    return deviation.groupBy(cell, "i", "j").agg(F.count("*").alias("particles"), F.sqrt(F.avg(F.col("d") * F.col("d"))).alias("rmsd"), F.median("d").alias("median"))


def locus_rmsd(deviation: DataFrame, cell: str = "cell") -> DataFrame:
    """Per cell and particle, from ``deviations``: the RMS over all pairs of structures."""
    return deviation.groupBy(cell, "chrom", "pos").agg(F.sqrt(F.avg(F.col("d") * F.col("d"))).alias("rmsd"))


def structure_summary(particles: DataFrame, cell: str = "cell") -> DataFrame:
    """Per cell: its structures and common particles, the RMS and the median of the particles' RMSDs, and RMS and median RMSD of the three structures that agree best.

    The best three have the least sum of pair medians; of equals the last triple in order wins.  Values are null where there is no common particle, or
    fewer than two (for the best three, three) structures.
    """
    d = deviations(particles, cell)
    cells = particles.groupBy(cell).agg(F.count_distinct("structure").cast("int").alias("structures"))
    loci = locus_rmsd(d, cell).groupBy(cell).agg(F.count("*").alias("particles"), F.sqrt(F.avg(F.col("rmsd") * F.col("rmsd"))).alias("rmsd"), F.median("rmsd").alias("median_rmsd"))
    pairs = pair_rmsd(d, cell)
    side = lambda i, j, k: pairs.select(cell, F.col("i").alias(i), F.col("j").alias(j), F.col("rmsd").alias(f"rmsd{k}"), F.col("median").alias(f"median{k}"))
    triples = side("a", "b", 1).join(side("b", "c", 2), [cell, "b"]).join(side("a", "c", 3), [cell, "a", "c"])
    total = F.col("median1") + F.col("median2") + F.col("median3")
    order = W.partitionBy(cell).orderBy(total, F.col("a").desc(), F.col("b").desc(), F.col("c").desc())
    best = triples.withColumn("rank", F.row_number().over(order)).where("rank = 1")
    three = F.array_sort(F.array("rmsd1", "rmsd2", "rmsd3"))
    squares = F.col("rmsd1") * F.col("rmsd1") + F.col("rmsd2") * F.col("rmsd2") + F.col("rmsd3") * F.col("rmsd3")
    best = best.select(cell, F.sqrt(squares / 3).alias("top3_rmsd"), F.get(three, F.lit(1)).alias("top3_median_rmsd"))
    return cells.join(loci, cell, "left").join(best, cell, "left").na.fill(0, ["particles"])


def aligned(particles: DataFrame, cell: str = "cell") -> DataFrame:
    """Every structure ``other`` of a cell, with all its particles, turned onto every structure ``structure`` of it: cell, structure, other, chrom, pos, x, y, z."""
    _, centre = _centred(_complete(particles, cell), cell)
    _, turns = rotations(particles, cell)
    back = F.transform(F.sequence(F.lit(0), F.lit(8)), lambda k: F.get("r", ((k % 3) * 3 + F.floor(k / 3)).cast("int")))
    turns = turns.select(cell, F.col("i").alias("structure"), F.col("j").alias("other"), "r").union(turns.select(cell, F.col("j"), F.col("i"), back))
    at = lambda which, tag: centre.select(cell, F.col("structure").alias(which), *[F.col(f"c{c}").alias(f"{tag}{c}") for c in "xyz"])
    turns = turns.join(at("structure", "to_"), [cell, "structure"]).join(at("other", "from_"), [cell, "other"])
    rows = particles.select(cell, F.col("structure").alias("other"), "chrom", "pos", "x", "y", "z").join(turns, [cell, "other"])
    moved = [sum(((F.col(p) - F.col(f"from_{p}")) * F.get("r", F.lit(3 * k + q)) for k, p in enumerate("xyz")), F.lit(0.0)) + F.col(f"to_{c}") for q, c in enumerate("xyz")]
    return rows.select(cell, "structure", "other", "chrom", "pos", *[m.alias(c) for m, c in zip(moved, "xyz", strict=True)])


def contact_blocks(contacts: DataFrame, width: int = 256) -> DataFrame:
    """A symmetric 0/1 matrix of contacts (chrom, bin1, bin2, n > 0; in any order of bins) as sparse blocks of its upper triangle.

    A row is a block of ``width`` by ``width`` bins that has a contact: chrom, block1 <= block2, and the places ``i`` and ``j`` of its contacts within it.
    """
    low, high = F.least("bin1", "bin2"), F.greatest("bin1", "bin2")
    upper = contacts.where(F.col("n") > 0).select("chrom", low.alias("a"), high.alias("b")).distinct()
    at = lambda c: F.floor(F.col(c) / width)
    inside = F.struct((F.col("a") - at("a") * width).cast("int").alias("i"), (F.col("b") - at("b") * width).cast("int").alias("j"))
    blocks = upper.groupBy("chrom", at("a").alias("block1"), at("b").alias("block2")).agg(F.sort_array(F.collect_list(inside)).alias("e"))
    return blocks.select("chrom", "block1", "block2", F.col("e.i").alias("i"), F.col("e.j").alias("j"))


def symmetric_product(blocks: DataFrame, vector: DataFrame, width: int = 256) -> DataFrame:
    """The product of ``contact_blocks`` with a vector (chrom, bin, value) and with ones: chrom, bin, total, degree; bins of neither are left out.

    Only the upper triangle is stored and moved: each block adds to the bins of its rows and, mirrored, to those of its columns, in one pass over it.  The vector comes in pieces
    of ``width`` bins; a bin that it lacks is 0.
    """
    piece = lambda c: F.floor(F.col(c) / width)
    entry = F.struct((F.col("bin") - piece("bin") * width).cast("int").alias("at"), F.col("value").cast("double").alias("value"))
    pieces = vector.groupBy("chrom", piece("bin").alias("block")).agg(F.collect_list(entry).alias("x"))
    of = lambda k: pieces.select("chrom", F.col("block").alias(f"block{k}"), F.col("x").alias(f"x{k}"))
    t = blocks.join(of(1), ["chrom", "block1"], "left").join(of(2), ["chrom", "block2"], "left")
    t = t.select("chrom", "block1", "block2", "i", "j", *[F.col(f"x{k}.{c}").alias(f"{c}{k}") for k in (1, 2) for c in ("at", "value")])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chroms, bins, totals, degrees = [], [], [], []
            for chrom, b1, b2, i, j, at1, value1, at2, value2 in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                x = [np.zeros(width), np.zeros(width)]
                for side, at, value in ((x[0], at1, value1), (x[1], at2, value2)):
                    if at:
                        np.add.at(side, at, np.array(value, float))
                i, j = np.array(i), np.array(j)
                off = np.flatnonzero((i != j) | (b1 != b2))  # the diagonal is its own mirror image
                for block, place, other in ((b1, i, x[1][j]), (b2, j[off], x[0][i[off]])):
                    total, degree = np.bincount(place, weights=other, minlength=width), np.bincount(place, minlength=width)
                    some = np.flatnonzero(degree)
                    chroms += [chrom] * len(some)
                    bins += (some + block * width).tolist()
                    totals += total[some].tolist()
                    degrees += degree[some].tolist()
            yield pa.RecordBatch.from_arrays([pa.array(chroms, chrom_type), pa.array(bins, pa.int64()), pa.array(totals, pa.float64()), pa.array(degrees, pa.int64())], names=["chrom", "bin", "total", "degree"])

    chrom_kind = blocks.schema["chrom"].dataType
    chrom_type = to_arrow_type(chrom_kind)
    parts = t.mapInArrow(add, f"chrom {chrom_kind.simpleString()}, bin long, total double, degree long")
    return parts.groupBy("chrom", "bin").agg(F.sum("total").alias("total"), F.sum("degree").alias("degree"))


def symmetric_compartment_score(contacts: DataFrame, cpg: DataFrame, width: int = 256) -> DataFrame:
    """Per bin of ``cpg`` (chrom, bin, cpg): the sum of the densities of the bins that it touches, in either order, over their number + 1; 0 for a bin without a contact."""
    x = cpg.select("chrom", "bin", F.col("cpg").alias("value"))
    y = symmetric_product(contact_blocks(contacts, width), x, width)
    score = F.coalesce(F.col("total"), F.lit(0.0)) / (F.coalesce("degree", F.lit(0)) + 1)
    return cpg.select("chrom", "bin").join(y, ["chrom", "bin"], "left").select("chrom", "bin", score.alias("score"))


def leg_support(particles: DataFrame, legs: DataFrame, distance: int, keys: list[str], pos: str = "pos", segment_width: int = SEGMENT) -> DataFrame:
    """Particles with ``support``: the number of contact legs (keys, pos) within ``distance`` of them.

    Legs are summed per place first; a RANGE frame along segments of a chromosome counts them, with those near a border also in the next segment, so
    no particle is paired with a leg.
    """
    width = max(segment_width, distance + 1)
    at = lambda shift: F.floor((F.col("pos") + shift) / width)
    places = particles.select(*keys, F.col(pos).alias("pos")).distinct().withColumn("n", F.lit(0).cast("long")).withColumn("own", F.lit(1))
    counted = legs.groupBy(*keys, "pos").agg(F.count("*").alias("n")).withColumn("own", F.lit(0))
    rows = places.withColumn("segment", at(0)).unionByName(counted.withColumn("segment", F.explode(F.sequence(at(-distance), at(distance)))))
    near = W.partitionBy(*keys, "segment").orderBy("pos").rangeBetween(-distance, distance)
    found = rows.withColumn("support", F.sum("n").over(near)).where("own = 1").select(*keys, F.col("pos").alias(pos), "support")
    return particles.join(found, [*keys, pos], "left")


def clean_particles(particles: DataFrame, contacts: DataFrame, distance: int = 500_000, quantile: float = 0.06, structure: str = "structure") -> DataFrame:
    """Particles (structure, chrom, pos) that contacts (chr1, pos1, chr2, pos2) support, with ``support`` and ``kept``.

    A particle goes if the legs within ``distance`` of it are no more than the given quantile of all particles' numbers, in its structure.
    """
    leg = lambda k: F.struct(F.col(f"chr{k}").alias("chrom"), F.col(f"pos{k}").alias("pos"))
    legs = contacts.select(F.explode(F.array(leg(1), leg(2))).alias("l")).select("l.*")
    t = leg_support(particles, legs, distance, ["chrom"])
    bounds = t.groupBy(structure).agg(F.percentile("support", F.lit(quantile)).alias("bound"))
    return t.join(bounds, structure).withColumn("kept", F.col("support") > F.col("bound")).drop("bound")


def rmsd_table(cells: DataFrame, rmsd: DataFrame, resolutions: list[str], cell: str = "cell") -> DataFrame:
    """Every cell of the cohort (``ord`` is its place) at every resolution, as text, in order of ``ord`` and ``at``: ``NA`` where there is no value.  A value of no cell or resolution is an error."""
    grid = cells.select(cell, "ord").withColumn("r", F.explode(F.array(*[F.struct(F.lit(k).alias("at"), F.lit(r).alias("resolution")) for k, r in enumerate(resolutions)])))
    grid = grid.select(cell, "ord", "r.at", "r.resolution")
    t = grid.join(rmsd.select(cell, "resolution", "rmsd"), [cell, "resolution"], "full")
    name = F.when(F.col("ord").isNotNull(), F.col(cell)).otherwise(F.raise_error(F.concat(F.lit("a value of no cell and resolution: "), F.col(cell).cast("string"))).cast(cells.schema[cell].dataType))
    return t.select(name.alias(cell), "ord", "at", "resolution", F.coalesce(F.col("rmsd").cast("string"), F.lit("NA")).alias("rmsd"))


def compartment_score(contacts: DataFrame, cpg: DataFrame) -> DataFrame:
    """Per (chrom, bin1): sum of the CpG densities of the bins it touches, over their number + 1; contacts count once.

    For a matrix that is given in both halves; ``symmetric_compartment_score`` takes either half.
    """
    once = contacts.where(F.col("n") > 0).select("chrom", "bin1", "bin2").distinct()
    d = cpg.select("chrom", F.col("bin").alias("bin2"), "cpg")
    t = once.join(d, ["chrom", "bin2"], "left").groupBy("chrom", "bin1").agg(F.sum(F.coalesce("cpg", F.lit(0.0))).alias("total"), F.count("*").alias("n"))
    return t.select("chrom", "bin1", (F.col("total") / (F.col("n") + 1)).alias("score"))


def cpg_density(windows: DataFrame, seq: str = "seq") -> DataFrame:
    """CpGs over valid bases of each window's sequence; null without a valid base."""
    s = F.upper(F.col(seq))
    valid = F.length(F.regexp_replace(s, "[^ACGT]", ""))
    return windows.select("chrom", "start", "end", F.regexp_count(s, F.lit("CG")).alias("cpg"), valid.alias("valid"), F.try_divide(F.regexp_count(s, F.lit("CG")), valid).alias("density"))


def padded_windows(windows: DataFrame, sizes: DataFrame, least: int = 100_000) -> DataFrame:
    """Windows (chrom, start, end) shorter than ``least`` grow to it, half on each side, cut at the ends of the chromosome (chrom, size)."""
    half = F.floor(F.greatest(F.lit(least) - (F.col("end") - F.col("start")), F.lit(0)) / 2)
    t = windows.join(sizes, "chrom")
    return t.select("chrom", "start", "end", F.greatest(F.col("start") - half, F.lit(0)).alias("from"), F.least(F.col("end") + half, F.col("size")).alias("until"))


def window_cpg(lines: DataFrame, windows: DataFrame, width: int = 16_384) -> DataFrame:
    """CpGs over valid bases in [from, until) of each window (chrom, start, end, from, until), from lines of sequence (name, ord, line, start).

    A line sees the first base of the next, so no sequence is put together.
    """
    following = F.lead(F.substring("line", 1, 1)).over(W.partitionBy("name", F.floor(F.col("start") / width)).orderBy("ord"))
    first = lines.groupBy("name", F.floor(F.col("start") / width).alias("part")).agg(F.min_by(F.substring("line", 1, 1), "ord").alias("next_first"))
    first = first.select("name", (F.col("part") - 1).alias("part"), "next_first")
    t = lines.withColumn("following", following).withColumn("part", F.floor(F.col("start") / width)).join(first, ["name", "part"], "left")
    t = t.select(F.col("name").alias("chrom"), "start", (F.col("start") + F.length("line")).alias("end"), F.upper("line").alias("line"), F.upper(F.coalesce("following", "next_first", F.lit(""))).alias("following"))
    w = windows.select("chrom", F.col("start").alias("s"), F.col("end").alias("e"), F.col("from").alias("start"), F.col("until").alias("end"))
    hits = overlap_join(w, t, ["chrom"], width)
    low, high = F.greatest("l_start", "r_start"), F.least("l_end", "r_end")
    part = F.substring(F.col("r_line"), (low - F.col("r_start") + 1).cast("int"), (high - low).cast("int"))
    over = F.when(high < F.col("l_end"), F.when(high < F.col("r_end"), F.substring(F.col("r_line"), (high - F.col("r_start") + 1).cast("int"), F.lit(1))).otherwise(F.col("r_following"))).otherwise("")
    sums = hits.groupBy(F.col("l_chrom").alias("chrom"), F.col("l_s").alias("start"), F.col("l_e").alias("end")).agg(F.sum(F.regexp_count(F.concat(part, over), F.lit("CG"))).alias("cpg"), F.sum(F.length(F.regexp_replace(part, "[^ACGT]", ""))).alias("valid"))
    return sums.withColumn("density", F.coalesce(F.round(F.try_divide("cpg", "valid"), 6), F.lit(0.0)))


def next_position(rows: DataFrame, key: str, order: Column, pos: str = "pos") -> DataFrame:
    """Append ``next_pos``, the position of the next row of the key."""
    return rows.withColumn("next_pos", F.lead(pos).over(W.partitionBy(key).orderBy(order)))


def pivot_resolutions(rmsd: DataFrame, resolutions: list[str], cell: str = "cell") -> DataFrame:
    """One row per cell with a column ``rmsd_<resolution>`` each."""
    return rmsd.groupBy(cell).pivot("resolution", resolutions).agg(F.first("rmsd")).select(cell, *[F.col(f"`{r}`").alias(f"rmsd_{r}") for r in resolutions])
