"""Embedding near-duplicates by collision counting over one-dimensional projections.

All vectors are projected on many random lines, once.  For some of the lines, those that sort, all vectors of a label are sorted
by their projection, and each is the centre of a window on the line.  For each pair in a window the collisions are counted, that is the
lines, sorting or not, on which the two are within the window of each other, and a pair whose count passes a bound goes on to its exact
cosine in double precision.  The number of sorting lines and the bound are calibrated so that a pair exactly at the threshold is
missed with a probability under ``MISS``.

Windows of a label grow with it, so a large label is first divided: for each sorting line, more lines cut the vectors into
intervals of a randomly shifted grid, and the windows are opened within a cell of these; more sorting lines make good for pairs that a
cell parts.  ``calibrate`` chooses how many lines of each kind cost least for the largest label.

A pair belongs to the first sorting line that it is found on, so each link is found once.  Tasks return sums of
links per vector and a spanning forest, never the pairs.  A group with many vectors is split into blocks, and each pair
of blocks is a piece of work of its own.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import group_starts, kept, per_salt, stored, table, whole_groups
from .components import components

THRESHOLD, MISS = 0.98, 1e-3
#: Windows that ``calibrate`` tries, and the intervals of a cell, as multiples of the greatest distance of a linked pair (on the unit sphere).
WINDOWS, CELL = (1.5, 2.0, 2.5, 3.0), 6.0
#: Collisions are counted on so many lines at least; projections are whole numbers of the UNITS-th part of a window.
COUNTED, UNITS = 32, 64
#: Groups above this are split into blocks of half of it; what sending a row to a group costs, in pairs that are compared.
MOST, COPY = 8192, 400
PAIRS, SALTS = 50_000, 64


def _within(window: float, deviation: float) -> float:
    return math.erf(window / deviation / math.sqrt(2))


def _same_cell(width: float, deviation: float) -> float:
    """Chance that two projections whose difference is normal share an interval of a shifted grid."""
    x = np.linspace(0, width, 2001)
    y = (1 - x / width) * 2 * np.exp(-((x / deviation) ** 2) / 2) / (deviation * math.sqrt(2 * math.pi))
    return float((y[1:] + y[:-1]).sum() / 2 * (x[1] - x[0]))


def _bound(lines: int, p: float, miss: float) -> int:
    """The greatest count that a pair with the chance ``p`` per line fails to reach with a probability of ``miss`` at most."""
    tail = 0.0
    for k in range(lines + 1):
        tail += math.exp(math.lgamma(lines + 1) - math.lgamma(k + 1) - math.lgamma(lines - k + 1) + k * math.log(p) + (lines - k) * math.log1p(-p))
        if tail > miss:
            return k
    return lines


def calibrate(n: int, threshold: float = THRESHOLD, miss: float = MISS) -> dict:
    """Parameters for labels of at most ``n`` vectors; half of ``miss`` is for pairs that meet nowhere, half for those that fail the count."""
    d = math.sqrt(2 - 2 * threshold)
    width = CELL * d
    far, near = _same_cell(width, math.sqrt(2)), _same_cell(width, d)
    best: tuple = (math.inf,)
    for multiple in WINDOWS:
        window = multiple * d
        p = _within(window * (UNITS - 1) / UNITS, d)
        for depth in range(64):
            tables = max(1, math.ceil(math.log(miss / 2) / math.log1p(-p * near**depth)))
            group = n * far**depth
            blocks = 1 if group <= MOST else 2 * group / MOST
            cost = tables * (blocks * COPY + group * _within(window, math.sqrt(2)) / 2)
            if cost < best[0]:
                best = (cost, window, depth, tables, p)
            if group < 1:
                break
    _, window, depth, tables, p = best
    lines = max(COUNTED, tables * (1 + depth))
    return {"window": window, "width": width, "depth": depth, "tables": tables, "lines": lines, "bound": _bound(lines, p, miss / 2), "places": "<i2" if 64 * UNITS / window < 32_000 else "<i4", "threshold": threshold}


def _lines(dimensions: int, lines: int) -> np.ndarray:
    """Random lines, drawn once in a worker for each number of dimensions; the first ``tables`` sort."""
    drawn = kept(f"lines {lines}", dict)
    if dimensions not in drawn:
        drawn[dimensions] = np.random.default_rng(20_240_917).standard_normal((dimensions, lines))
    return drawn[dimensions]


def _projections(p: dict, element: np.dtype):
    """Per vector: its cell for each sorting line, its projections in units, and its numbers as bytes."""
    passed = ["label", "k", "id", "copies"]

    def run(batches):
        shift = np.random.default_rng(7).random(p["lines"]) * p["width"]
        tables, depth = p["tables"], p["depth"]
        for batch in batches:
            at = {n: k for k, n in enumerate(batch.schema.names)}
            vectors = batch.column(at["embedding"])
            sizes = np.array(vectors.value_lengths().to_pylist(), dtype=np.int64)
            flat = vectors.flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(sizes)
            keys, places, raw = ([None] * len(sizes) for _ in range(3))
            for d in np.unique(sizes):
                own = np.flatnonzero(sizes == d)
                x = flat[(ends[own] - d)[:, None] + np.arange(d)].astype(np.float64)
                largest = np.abs(x).max(axis=1, keepdims=True)
                # As exact as they came, unless squares of float64 numbers would overflow or vanish.
                raw_rows = flat[(ends[own] - d)[:, None] + np.arange(d)].astype(element)
                x /= largest
                if element.itemsize == 8:
                    raw_rows = np.where((largest > 1e-140) & (largest < 1e140), raw_rows, x)
                line = (x / np.linalg.norm(x, axis=1, keepdims=True)) @ _lines(int(d), p["lines"])
                unit = np.floor(line * (UNITS / p["window"])).astype(p["places"])
                strip = np.floor((line + shift) / p["width"]).astype(np.int64)[:, tables : tables * (1 + depth)].reshape(len(own), tables, depth)
                h = np.full((len(own), tables), np.uint64(d))
                for k in range(depth):
                    h = (h ^ strip[:, :, k].astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
                    h = h ^ (h >> np.uint64(29))
                for i, cells, q, v in zip(own, h.astype(np.int64), unit, raw_rows, strict=True):
                    keys[i], places[i], raw[i] = cells.tolist(), q.tobytes(), v.tobytes()
            columns = [*[batch.column(at[c]) for c in passed], pa.array(keys, pa.list_(pa.int64())), pa.array(places, pa.binary()), pa.array(raw, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=[*passed, "cells", "places", "v"])

    return run


def _join(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Join the sets of the pairs i, j; ``root`` names each row's set by a row."""
    while True:
        a, b = root[i], root[j]
        apart = a != b
        if not apart.any():
            return
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        up = np.arange(len(root))
        np.minimum.at(up, np.maximum(a, b), np.minimum(a, b))
        while (up != up[up]).any():
            up = up[up]
        root[:] = up[root]


def _links_of_group(g: dict, level: int, p: dict):
    """Links of a group (or of two of its blocks): rows with links, the least row that each is joined with, and the linked copies."""
    order = np.lexsort((g["k"], g["id"], g["places"][:, level]))
    copies, cells, places, x, block = (g[c][order] for c in ("copies", "cells", "places", "x", "block"))
    line = places[:, level].astype(np.int32)
    n = np.searchsorted(line, line + UNITS, side="right") - np.arange(len(line)) - 1
    norm = np.linalg.norm(x, axis=1)
    linked, root = np.zeros(len(line)), np.arange(len(line))
    two, at = len(np.unique(block)) > 1, 0
    split_after = np.searchsorted(np.cumsum(n), np.arange(1, n.sum() // PAIRS + 2) * PAIRS, side="right")
    for end in [*split_after, len(line)]:
        end = max(int(end), at)
        i = np.repeat(np.arange(at, end), n[at:end])
        j = np.arange(len(i)) - np.repeat(np.cumsum(n[at:end]) - n[at:end], n[at:end]) + i + 1
        at = end
        if two:
            i, j = i[block[i] != block[j]], j[block[i] != block[j]]
        for a in range(0, len(i), PAIRS):
            one, other = i[a : a + PAIRS], j[a : a + PAIRS]
            close = np.abs(places[one] - places[other]) <= UNITS
            keep = close.sum(axis=1) >= p["bound"]
            met = ((cells[one, :level] == cells[other, :level]) & close[:, :level]).any(axis=1)
            one, other = one[keep & ~met], other[keep & ~met]
            same = np.einsum("ij,ij->i", x[one], x[other]) / (norm[one] * norm[other]) >= p["threshold"]
            one, other = one[same], other[same]
            linked += np.bincount(one, weights=copies[other], minlength=len(line)) + np.bincount(other, weights=copies[one], minlength=len(line))
            _join(root, one, other)
    by_id = np.lexsort((g["k"][order], g["id"][order]))
    place = np.argsort(by_id)
    least = np.full(len(line), len(line))
    np.minimum.at(least, root, place)
    some = linked > 0
    return order[some], order[by_id[least[root[some]]]], linked[some].astype(np.int64)


def _linker(p: dict, element: np.dtype):
    keys = ["label", "level", "cell", "first", "second"]

    def run(batches):
        for t in whole_groups(batches, keys):
            out = []
            for a, b in itertools.pairwise(group_starts(t, keys)):
                if b - a < 2:
                    continue
                part = t.slice(a, b - a)
                g = {c: part.column(c).to_numpy() for c in ("id", "k", "copies", "block")}
                g["cells"] = np.array(part.column("cells").to_pylist(), dtype=np.int64)
                g["places"] = np.frombuffer(b"".join(part.column("places").to_pylist()), p["places"]).reshape(b - a, -1)
                g["x"] = np.frombuffer(b"".join(part.column("v").to_pylist()), element).reshape(b - a, -1).astype(np.float64)
                row, root, n = _links_of_group(g, part.column("level")[0].as_py(), p)
                out.append(np.stack([g["id"][row], g["k"][row], g["id"][root], g["k"][root], n]))
            columns = np.concatenate(out, axis=1) if out else np.zeros((5, 0), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["id", "k", "root_id", "root_k", "n"])

    return run


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, miss: float = MISS) -> DataFrame:
    """One row per row of ``vectors``: ``vec_id``, ``n_links``, ``component_id``, ``kept``.

    Vectors of the same label link from the cosine ``threshold`` on.  A null label, a null id, and a vector that is null, empty, zero or holds a
    null or non-finite number link with nothing.  Equal vectors of a label are compared once and count as links
    of each other; repeated rows are vectors of their own.  Vectors of other lengths do not compare.  Other columns are not read.
    An empty table gives an empty result.
    """
    rows = vectors.select("vec_id", "embedding", "label")
    element = np.dtype("<f4" if vectors.schema["embedding"].dataType.elementType.typeName() == "float" else "<f8")
    fine = (
        F.col("vec_id").isNotNull()
        & F.col("label").isNotNull()
        & (F.size("embedding") > 0)
        & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("embedding", lambda x: x != 0)
    )
    fine = F.coalesce(fine, F.lit(False))
    same = F.md5(F.concat_ws(",", F.col("embedding").cast("array<string>")).cast("binary"))
    keyed = rows.select("vec_id", F.col("label").cast("string").alias("label"), F.when(fine, same).alias("copy"), F.when(fine, F.col("embedding")).alias("embedding"))
    good = keyed.where("copy IS NOT NULL")
    largest = good.groupBy("label").agg(F.approx_count_distinct("copy", 0.02).alias("n")).agg(F.max("n")).first()[0] or 1
    p = calibrate(largest, threshold, miss)

    # A node is a distinct vector of a label: its least id first, then a hash that tells vectors of one id apart.
    nodes = good.groupBy("label", "copy").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies"), F.first("embedding").alias("embedding"))
    nodes = nodes.select("label", F.xxhash64("label", "copy").alias("k"), F.col("id").cast("long").alias("id"), "copies", "embedding")
    nodes = stored(nodes.mapInArrow(_projections(p, element), "label string, k long, id long, copies long, cells array<long>, places binary, v binary"))
    group = ["label", "level", "cell"]
    spots = nodes.select("label", "id", "k", F.posexplode("cells").alias("level", "cell")).withColumn("salt", F.pmod(F.xxhash64("id", "k"), F.lit(SALTS)).cast("int"))
    blocks = F.when(F.col("n") > MOST, F.ceil(F.col("n") / (MOST // 2))).otherwise(1).cast("int")
    crowded = stored(per_salt(spots, group, salts=SALTS).withColumn("blocks", blocks))
    # Ids alone meet the table of groups; vectors follow once it is known which groups they go to.
    places = spots.join(crowded, [*group, "salt"]).groupBy("id", "k").agg(F.collect_list(F.struct("level", "cell", "blocks")).alias("groups"))
    each = nodes.join(places, ["id", "k"]).select("label", "id", "k", "copies", "cells", "places", "v", F.explode("groups").alias("g")).select("*", "g.level", "g.cell", "g.blocks").drop("g")
    each = each.withColumn("block", F.pmod(F.xxhash64("id", "k", "level"), F.col("blocks")).cast("int"))
    each = each.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    each = each.select("id", "k", "copies", "cells", "places", "v", "block", *group, F.least("block", "with").alias("first"), F.greatest("block", "with").alias("second"))
    key = [*group, "first", "second"]
    found = each.repartition(*key).sortWithinPartitions(*key).mapInArrow(_linker(p, element), "id long, k long, root_id long, root_k long, n long")
    found = stored(found.select(F.struct("id", "k").alias("node"), F.struct(F.col("root_id").alias("id"), F.col("root_k").alias("k")).alias("root"), "n"))

    sums = found.groupBy("node").agg(F.sum("n").alias("n"))
    groups = components(found.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")))
    summary = nodes.select(F.struct("id", "k").alias("node"), "k", "copies").join(sums, "node", "left").join(groups, "node", "left")
    summary = stored(summary.select("k", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("component.id", "node.id").alias("component_id")))
    # Vectors that link with nothing have no key, and are no row of the join.
    alone = keyed.where("copy IS NULL").select("vec_id", *[F.lit(None).cast(summary.schema[c].dataType).alias(c) for c in ("n_links", "component_id")])
    out = keyed.where("copy IS NOT NULL").select("vec_id", F.xxhash64("label", "copy").alias("k")).join(summary, "k", "left").select("vec_id", "n_links", "component_id").unionByName(alone)
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"))


def op9_collision_counting(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "embeddings"))
