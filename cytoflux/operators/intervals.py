"""Interval operators: overlap joins, islands, union components, coverage.

Coordinates are 0-based half-open (``start``, ``end``) unless a name says ``closed``.  Two devices keep
them scalable however long a chromosome's share of the rows is:

* range joins explode intervals to fixed-width bins and join on equal (keys, bin), and
* computations along a chromosome run per bin of positions, with a prefix over the small table
  of bins for what crosses a border.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

BIN = 16_384
SEGMENT = 1_000_000
#: Segments of the sweep.
SWEEP = 1 << 18


def bins(start: Column, end: Column, width: int) -> Column:
    """All bins that [start, end) touches."""
    return F.sequence(F.floor(start / width), F.floor((F.greatest(end, start + 1) - 1) / width))


def _side(df: DataFrame, tag: str) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{tag}_{c}") for c in df.columns])


def overlap_join(left: DataFrame, right: DataFrame, keys: list[str], width: int = BIN, start: str = "start", end: str = "end") -> DataFrame:
    """All overlapping pairs, once each; columns get the prefixes ``l_`` and ``r_``.

    A pair counts in the bin where the later of the two begins.  Work per bin depends on local depth, not on
    the length of a chromosome.
    """
    a = _side(left, "l").withColumn("bin", F.explode(bins(F.col(f"l_{start}"), F.col(f"l_{end}"), width)))
    b = _side(right, "r").withColumn("bin", F.explode(bins(F.col(f"r_{start}"), F.col(f"r_{end}"), width)))
    on = [F.col(f"l_{k}") == F.col(f"r_{k}") for k in keys] + [a["bin"] == b["bin"]]
    hit = (F.col(f"l_{start}") < F.col(f"r_{end}")) & (F.col(f"r_{start}") < F.col(f"l_{end}"))
    home = a["bin"] == F.floor(F.greatest(f"l_{start}", f"r_{start}") / width)
    joined = a.join(b, on, "inner").where(hit & home)
    return joined.select(*[c for c in joined.columns if c != "bin"])


def point_join(intervals: DataFrame, points: DataFrame, keys: list[str], pos: str = "pos", width: int = BIN, start: str = "start", end: str = "end") -> DataFrame:
    """Points within intervals (start <= pos < end); points need no explosion."""
    a = _side(intervals, "l").withColumn("bin", F.explode(bins(F.col(f"l_{start}"), F.col(f"l_{end}"), width)))
    b = _side(points, "r").withColumn("bin", F.floor(F.col(f"r_{pos}") / width))
    on = [F.col(f"l_{k}") == F.col(f"r_{k}") for k in keys] + [a["bin"] == b["bin"]]
    joined = a.join(b, on, "inner").where((F.col(f"r_{pos}") >= F.col(f"l_{start}")) & (F.col(f"r_{pos}") < F.col(f"l_{end}")))
    return joined.select(*[c for c in joined.columns if c != "bin"])


def _open_intervals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Events sorted by (keys, at, point) to pairs (l, r): each point with the intervals that are open there."""
    held: pa.Table | None = None
    last: list | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        t = pa.Table.from_batches([batch])
        keys = [batch.column(c) for c in batch.schema.names if c not in ("at", "stop", "point", "l", "r")]
        fresh = np.zeros(batch.num_rows, bool)  # begins a group
        for k in keys:
            fresh[1:] |= pc.not_equal(k[1:], k[:-1]).to_numpy(zero_copy_only=False)
        if last is not None and last != [k[0].as_py() for k in keys]:
            fresh[0], held = True, None
        last = [k[-1].as_py() for k in keys]
        group = np.cumsum(fresh)  # what is held is of group 0
        t = t.append_column("group", pa.array(group))
        point = t.column("point")
        p, new = t.filter(point), t.filter(pc.invert(point))
        iv = pa.concat_tables([held.set_column(held.num_columns - 1, "group", pa.array(np.zeros(held.num_rows, group.dtype))), new]) if held is not None else new
        number = lambda d: d.column("group").to_numpy() << 44
        places = number(p) + p.column("at").to_numpy()
        begin, stop = (np.searchsorted(places, number(iv) + iv.column(c).to_numpy()) for c in ("at", "stop"))
        many = np.maximum(stop - begin, 0)
        for lo, hi in _even(many, 1 << 16):
            i = np.repeat(np.arange(lo, hi), many[lo:hi])
            j = np.arange(len(i)) - np.repeat(np.cumsum(many[lo:hi]) - many[lo:hi], many[lo:hi]) + np.repeat(begin[lo:hi], many[lo:hi])
            if len(i):
                yield from pa.table({"l": iv.column("l").take(pa.array(i)), "r": p.column("r").take(pa.array(j))}).combine_chunks().to_batches()
        still = pc.and_(pc.equal(iv.column("group"), pa.scalar(group[-1])), pc.greater(iv.column("stop"), t.column("at")[-1]))
        held = iv.filter(still).combine_chunks()


def _even(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose sizes add up to about ``most``."""
    total = np.cumsum(sizes)
    cuts = [0, *np.searchsorted(total, np.arange(most, int(total[-1]), most) if len(total) else []).tolist(), len(sizes)]
    return ((a, b) for a, b in itertools.pairwise(cuts) if b > a)


def sweep_point_join(intervals: DataFrame, points: DataFrame, keys: list[str], pos: str = "pos", width: int = SWEEP, start: str = "start", end: str = "end") -> DataFrame:
    """As ``point_join``, by one pass over both sides in order of place.

    Both sides are dealt by keys and segment of ``width`` bases (an interval goes to each segment that it touches, so a long one has few copies), sorted by place and
    streamed: a task holds the intervals that are open where it stands, and no bin's rows are compared pair by pair.  Rows with a null key or place meet
    nothing; places are not negative and below 2**44.
    """
    left, right = intervals.na.drop(subset=[*keys, start, end]).where(F.col(start) < F.col(end)), points.na.drop(subset=[*keys, pos])
    kind = {"l": StructType(left.schema.fields), "r": StructType(right.schema.fields)}
    names = [*[f"k{i}" for i in range(len(keys))], "segment"]
    group = lambda segment: [c.alias(n) for c, n in zip([*[F.col(k).cast("string") for k in keys], segment], names, strict=True)]
    row = lambda d, side: [(F.struct(*[F.col(f"`{c}`") for c in d.columns]) if t == side else F.lit(None).cast(kind[t])).alias(t) for t in "lr"]
    each = left.select(F.explode(bins(F.col(start), F.col(end), width)).alias("_segment"), "*")
    opened = each.select(*group(F.col("_segment")), F.col(start).cast("long").alias("at"), F.col(end).cast("long").alias("stop"), F.lit(False).alias("point"), *row(left, "l"))
    seen = right.select(*group(F.floor(F.col(pos) / width)), F.col(pos).cast("long").alias("at"), F.col(pos).cast("long").alias("stop"), F.lit(True).alias("point"), *row(right, "r"))
    events = opened.unionByName(seen).repartition(*names).sortWithinPartitions(*names, "at", "point")
    pairs = events.mapInArrow(_open_intervals, StructType([StructField(t, kind[t]) for t in "lr"]))
    return pairs.select(*[F.col(f"{t}.`{f.name}`").alias(f"{t}_{f.name}") for t in "lr" for f in kind[t]])


def _any_overlap(left: DataFrame, right: DataFrame, keys: list[str], ids: list[str], width: int, start: str, end: str) -> DataFrame:
    hits = overlap_join(left.select(*ids, *[c for c in (*keys, start, end) if c not in ids]), right.select(*keys, start, end), keys, width, start, end)
    return hits.select(*[F.col(f"l_{c}").alias(c) for c in ids]).distinct()


def overlap_semi(left: DataFrame, right: DataFrame, keys: list[str], ids: list[str], width: int = BIN, start: str = "start", end: str = "end") -> DataFrame:
    """Rows of ``left`` (identified by ``ids``) that overlap any row of ``right``."""
    return left.join(_any_overlap(left, right, keys, ids, width, start, end), ids, "left_semi")


def overlap_anti(left: DataFrame, right: DataFrame, keys: list[str], ids: list[str], width: int = BIN, start: str = "start", end: str = "end") -> DataFrame:
    """Rows of ``left`` that overlap no row of ``right``, such as a blacklist."""
    return left.join(_any_overlap(left, right, keys, ids, width, start, end), ids, "left_anti")


def covered_fraction_filter(left: DataFrame, regions: DataFrame, keys: list[str], ids: list[str], min_length: int = 30, min_fraction: float = 0.5, width: int = BIN) -> DataFrame:
    """Drop rows covered by disjoint ``regions`` over at least ``min_length`` bases and ``min_fraction`` of their length."""
    hits = overlap_join(left.select(*dict.fromkeys([*ids, *keys, "start", "end"])), regions, keys, width)
    shared = F.least("l_end", "r_end") - F.greatest("l_start", "r_start")
    covered = hits.groupBy(*[F.col(f"l_{c}").alias(c) for c in ids]).agg(F.sum(shared).alias("covered"), F.first(F.col("l_end") - F.col("l_start")).alias("length"))
    bad = covered.where((F.col("covered") >= min_length) & (F.col("covered") >= min_fraction * F.col("length"))).select(*ids)
    return left.join(bad, ids, "left_anti")


def _before(df: DataFrame, keys: list[str], segment: str, aggregate: Column, combine) -> DataFrame:
    """Per segment, ``combine`` of the aggregates of all earlier segments, as column ``carried``."""
    each = df.groupBy(*keys, segment).agg(aggregate.alias("own"))
    earlier = W.partitionBy(*keys).orderBy(segment).rowsBetween(W.unboundedPreceding, -1)
    return each.select(*keys, segment, combine("own").over(earlier).alias("carried"))


def _opened(df: DataFrame, keys: list[str], pos: Column, order: list[str], gap: int, width: int) -> DataFrame:
    """Rows in their segment and, near its end, in the next one too, with ``opens``; a row's own place is where ``segment`` is ``home``."""
    place, last = F.floor(F.col("pos") / width), F.floor((F.col("pos") + gap) / width)
    d = df.withColumn("pos", pos).withColumn("home", place).withColumn("segment", F.explode(F.sequence(place, last)))
    before = F.lag("pos").over(W.partitionBy(*keys, "segment").orderBy("pos", *order))
    return d.withColumn("opens", F.coalesce(F.col("pos") - before > gap, F.lit(True)))


def island_starts(df: DataFrame, keys: list[str], pos: Column, order: list[str], gap: int, segment_width: int = SEGMENT) -> DataFrame:
    """Append ``pos`` and ``opens``: does a row open an island, that is, is the row before it more than ``gap`` away?

    Rows are ordered by (pos, order).  An island is a chain of rows each within ``gap`` of the one before, so keeping the
    rows that open one keeps the first of each cluster.  One shuffle by (keys, segment): rows within ``gap`` of a segment's
    end also go to the next one, where they only serve as neighbours.
    """
    d = _opened(df, keys, pos, order, gap, max(segment_width, gap + 1))
    return d.where("segment = home").drop("segment", "home")


def islands(df: DataFrame, keys: list[str], pos: Column, order: list[str], gap: int, segment_width: int = SEGMENT) -> DataFrame:
    """Append ``pos`` and ``island``, the number of a row's island along its key.

    Islands are counted in the windows that find where they open, so rows are shuffled and sorted once; what earlier segments have comes from the small table of segments.
    """
    d = _opened(df, keys, pos, order, gap, max(segment_width, gap + 1))
    within = W.partitionBy(*keys, "segment").orderBy("pos", *order).rowsBetween(W.unboundedPreceding, W.currentRow)
    own = F.col("opens") & (F.col("segment") == F.col("home"))
    d = d.withColumn("local", F.sum(own.cast("long")).over(within)).where("segment = home")
    counted = _before(d, keys, "segment", F.max("local"), F.sum)
    d = d.join(counted, [*keys, "segment"])
    return d.withColumn("island", F.col("local") + F.coalesce("carried", F.lit(0))).drop("opens", "segment", "home", "local", "carried")


def first_of_islands(df: DataFrame, keys: list[str], pos: Column, order: list[str], gap: int) -> DataFrame:
    return island_starts(df, keys, pos, order, gap).where("opens").drop("opens")


def union_components(df: DataFrame, keys: list[str], order: list[str], distance: int = 0, start: str = "start", end: str = "end", segment_width: int | None = SEGMENT) -> DataFrame:
    """Append ``component`` (1, 2, ... along each key): a row opens one when start > greatest end so far + ``distance``.

    With closed coordinates, intervals that share a coordinate merge.  Windows hold a segment of a key, and prefixes over its segments are
    joined; without ``segment_width`` a key is one window, as fits keys of bounded size (a cell's chromosome).
    """
    if segment_width is None:
        w = W.partitionBy(*keys).orderBy(start, *order)
        top = F.max(end).over(w.rowsBetween(W.unboundedPreceding, -1))
        d = df.withColumn("opens", F.coalesce((F.col(start) > top + distance).cast("long"), F.lit(1)))
        return d.withColumn("component", F.sum("opens").over(w.rowsBetween(W.unboundedPreceding, W.currentRow))).drop("opens")
    d = df.withColumn("segment", F.floor(F.col(start) / segment_width))
    carried = _before(d, keys, "segment", F.max(end), F.max)
    within = W.partitionBy(*keys, "segment").orderBy(start, *order)
    d = d.withColumn("top", F.max(end).over(within.rowsBetween(W.unboundedPreceding, -1))).join(carried, [*keys, "segment"])
    d = d.withColumn("opens", F.coalesce((F.col(start) > F.greatest("top", "carried") + distance).cast("long"), F.lit(1)))
    counted = _before(d, keys, "segment", F.sum("opens"), F.sum)
    d = d.drop("carried").withColumn("local", F.sum("opens").over(within.rowsBetween(W.unboundedPreceding, W.currentRow))).join(counted, [*keys, "segment"])
    return d.withColumn("component", F.col("local") + F.coalesce("carried", F.lit(0))).drop("segment", "top", "opens", "local", "carried")


def merged_intervals(df: DataFrame, keys: list[str], start: str = "start", end: str = "end") -> DataFrame:
    """The union of intervals as disjoint ones."""
    return union_components(df, keys, [end], 0, start, end).groupBy(*keys, "component").agg(F.min(start).alias(start), F.max(end).alias(end)).drop("component")


def cluster_best(df: DataFrame, keys: list[str], distance: int, best: list[Column], order: list[str], start: str = "start", end: str = "end") -> DataFrame:
    """One row per cluster of intervals at most ``distance`` apart: the first by ``best``."""
    clustered = union_components(df, keys, order, distance, start, end)
    w = W.partitionBy(*keys, "component").orderBy(*best)
    return clustered.withColumn("rank", F.row_number().over(w)).where("rank = 1").drop("rank", "component")


def coverage_steps(df: DataFrame, keys: list[str], start: str = "start", end: str = "end", segment_width: int = SEGMENT) -> DataFrame:
    """Steps of constant positive depth: keys, start, end, depth.

    Windows hold a segment; the depth at its start and the first position after it come from one small table of segments.
    """
    change = lambda c, d: F.struct(F.col(c).alias("pos"), F.lit(d).cast("long").alias("d"))
    edges = df.select(*keys, F.explode(F.array(change(start, 1), change(end, -1))).alias("e")).select(*keys, F.col("e.pos").alias("pos"), F.col("e.d").alias("d"))
    edges = edges.withColumn("segment", F.floor(F.col("pos") / segment_width))
    along = W.partitionBy(*keys).orderBy("segment")
    each = edges.groupBy(*keys, "segment").agg(F.sum("d").alias("own"), F.min("pos").alias("first"))
    around = each.select(*keys, "segment", F.sum("own").over(along.rowsBetween(W.unboundedPreceding, -1)).alias("carried"), F.lead("first").over(along).alias("following"))
    steps = edges.groupBy(*keys, "segment", "pos").agg(F.sum("d").alias("d"))
    within = W.partitionBy(*keys, "segment").orderBy("pos")
    d = steps.withColumn("local", F.sum("d").over(within.rowsBetween(W.unboundedPreceding, W.currentRow))).withColumn("next", F.lead("pos").over(within))
    d = d.join(around, [*keys, "segment"])
    depth = F.col("local") + F.coalesce("carried", F.lit(0))
    return d.select(*keys, F.col("pos").alias("start"), F.coalesce("next", "following").alias("end"), depth.alias("depth")).where("depth > 0")


def bin_counts(df: DataFrame, keys: list[str], width: int, start: str = "start", end: str = "end") -> DataFrame:
    """Per bin of ``width`` bases, how many intervals touch it."""
    return df.select(*keys, F.explode(bins(F.col(start), F.col(end), width)).alias("bin")).groupBy(*keys, "bin").agg(F.count("*").alias("n"))
