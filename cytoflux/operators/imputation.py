"""Haplotypes of contacts from those of their neighbours, in rounds."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from ..sources.scratch import written

#: The four ways in which two legs can be phased (fixed order), and the weight of votes from the square itself, those beside it and those at its corners.
WAYS = ("p00", "p01", "p10", "p11")
WEIGHTS = (1.0, 0.5, 0.25)
#: Squares along a side of a tile, the most rounds between two stored states, and about how many rows are worked on at once.
TILE, LEG, ROWS = 128, 10, 1 << 16


def _fits(kind: np.ndarray) -> np.ndarray:
    """The allowed ways of kinds, three times the first leg's and the second's: 0 and 1 are known, 2 is open."""
    legs = np.stack([kind // 3, kind % 3])
    return np.stack([((legs[0] == 2) | (legs[0] == int(w[1]))) & ((legs[1] == 2) | (legs[1] == int(w[2]))) for w in WAYS], axis=1).astype(np.float64)


def _whole(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Sorted rows as tables of whole groups by ``names``, with the number of each row's group."""
    held = None
    for batch in _and_end(batches):
        if batch is not None and batch.num_rows:
            new = pa.Table.from_batches([batch])
            held = new if held is None else pa.concat_tables([held, new])
        if held is None or (batch is not None and held.num_rows < ROWS):
            continue
        opens = np.zeros(held.num_rows, bool)
        for c in names:
            column = held.column(c).combine_chunks()
            opens[1:] |= pc.not_equal(column.slice(1), column.slice(0, len(column) - 1)).to_numpy(zero_copy_only=False)
        cut = held.num_rows if batch is None else int(np.flatnonzero(opens)[-1]) if opens.any() else 0
        if cut:
            yield held.slice(0, cut).combine_chunks(), np.cumsum(opens[:cut])
            held = held.slice(cut).combine_chunks()


def _and_end(batches: Iterator) -> Iterator:
    yield from batches
    yield None


def _rounds(tile: list[str], rounds: int, doubt: float, halo: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``rounds`` rounds over whole tiles with their ``halo``: the states of a tile's own squares but lone ones, and on a first row the greatest change of each round."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, group in _whole(batches, tile):
            x, y, kind, n, tx, ty = (t.column(c).to_numpy() for c in ("_x", "_y", "_k", "_n", "_tx", "_ty"))
            lx, ly, side = x - tx * TILE + halo + 1, y - ty * TILE + halo + 1, TILE + 2 * halo + 2  # an empty rim keeps neighbours within a tile
            places, at = np.unique((group.astype(np.int64) * side + lx) * side + ly, return_inverse=True)
            around = []
            for dx in (-1, 0, 1):
                for dy in (-1, 0, 1):
                    if dx or dy:
                        i = np.minimum(np.searchsorted(places, places + dx * side + dy), len(places) - 1)
                        there = np.flatnonzero(places[i] == places + dx * side + dy)
                        around.append((there, i[there], WEIGHTS[abs(dx) + abs(dy)]))
            met = np.bincount(at, n, len(places)) > 1
            for there, *_ in around:
                met[there] = True
            rows = np.flatnonzero(met[at])
            if not len(rows):
                continue
            at, n, own = at[rows], n[rows].astype(np.float64), ((x // TILE == tx) & (y // TILE == ty))[rows]
            fits = _fits(kind[rows])
            p = np.stack([t.column(w).to_numpy()[rows] for w in WAYS], axis=1) if WAYS[0] in t.column_names else fits / fits.sum(axis=1, keepdims=True)
            moved = []
            for _ in range(rounds):
                sums = np.stack([np.bincount(at, p[:, k] * n, len(places)) for k in range(len(WAYS))], axis=1)
                votes = sums * WEIGHTS[0]
                for there, source, weight in around:
                    votes[there] += weight * sums[source]
                seen = fits * (np.maximum(votes[at] - p * WEIGHTS[0], 0) + doubt)
                new = seen / seen.sum(axis=1, keepdims=True)
                moved.append(float(np.abs(new - p)[own].max(initial=0.0)))
                p = new
            kept = t.select([c for c in t.column_names if c not in ("_tx", "_ty", *WAYS)]).take(pa.array(rows[own]))
            for k, w in enumerate(WAYS):
                kept = kept.append_column(w, pa.array(p[own, k]))
            changes = pa.array([moved, *[None] * (kept.num_rows - 1)] if kept.num_rows else [], pa.list_(pa.float64()))
            yield from kept.append_column("_moved", changes).combine_chunks().to_batches()

    return run


def _advanced(state: DataFrame, square: list[str], rounds: int, doubt: float) -> DataFrame:
    """The stored state (square, _k, _n and, but at the beginning, the probabilities) after ``rounds`` rounds."""
    tiles = lambda c: F.explode(F.sequence(F.floor((F.col(c) - rounds) / TILE), F.floor((F.col(c) + rounds) / TILE)))
    tile = [*[c for c in square if c not in ("_x", "_y")], "_tx", "_ty"]
    dealt = state.withColumn("_tx", tiles("_x")).withColumn("_ty", tiles("_y")).repartition(*tile).sortWithinPartitions(*tile)
    fields = [f for f in state.schema.fields if f.name not in WAYS]
    schema = StructType([*fields, *[StructField(w, DoubleType()) for w in WAYS], StructField("_moved", ArrayType(DoubleType()))])
    return written(dealt.mapInArrow(_rounds(tile, rounds, doubt, rounds), schema), "phases")


def impute_phases(contacts: DataFrame, keys: list[str], side: int, rounds: int = 10, change: float = 1e-3, doubt: float = 0.1) -> DataFrame:
    """Contacts (keys, chr1, pos1, chr2, pos2, phase1, phase2) with the probabilities p00, p01, p10 and p11 of their four phases, and ``rounds``, how many it took.

    A phase of ``0`` or ``1`` is known and stays; all ways that fit it begin as equal.  In each round a contact gets the votes of the contacts around it, the probabilities of all others in its
    square of the grid (sides of ``side`` bases, within ``keys`` and both chromosomes) and in the eight around, with ``WEIGHTS``; its new probabilities are the allowed ways' votes and ``doubt``
    for each, scaled to 1.  Rounds end when no probability changes by more than ``change``, or after ``rounds``.  Without neighbours a contact keeps its beginning; a null place has none.

    Contacts of a square of which the same is known have the same probabilities, so a square has nine rows at most.  These go to tiles of ``TILE`` by ``TILE`` squares with as many squares
    around as there are rounds, so a tile, which is of bounded size, runs up to ``LEG`` rounds by itself; then the state is stored.
    """
    square = [*keys, "chr1", "chr2", "_x", "_y"]
    leg = lambda c: F.when(F.col(c) == "0", 0).when(F.col(c) == "1", 1).otherwise(2)
    t = contacts.withColumn("_x", F.floor(F.col("pos1") / side)).withColumn("_y", F.floor(F.col("pos2") / side))
    t = written(t.withColumn("_k", 3 * leg("phase1") + leg("phase2")), "contacts")
    state = t.na.drop(subset=square).groupBy(*square, "_k").agg(F.count("*").alias("_n"))
    n = 0
    while n < rounds:
        ahead = min(LEG, rounds - n)
        new = _advanced(state, square, ahead, doubt)
        most = new.where("_moved IS NOT NULL").agg(*[F.max(F.get("_moved", F.lit(i))) for i in range(ahead)]).first()
        still = [i for i in range(ahead) if (most[i] or 0.0) <= change]
        if still and still[0] + 1 < ahead:
            new = _advanced(state, square, still[0] + 1, doubt)
        n += still[0] + 1 if still else ahead
        state = new.drop("_moved")
        if still:
            break
    if n:
        found = state.select(*square, "_k", *[F.col(w).alias(f"_{w}") for w in WAYS])
        t = t.join(found, [*square, "_k"], "left")
    fits = _fits(np.arange(9))
    begins = fits / fits.sum(axis=1, keepdims=True)
    begin = {w: F.get(F.array(*[F.lit(float(v)) for v in begins[:, k]]), F.col("_k")) for k, w in enumerate(WAYS)}
    new = {w: F.coalesce(F.col(f"_{w}"), b) if n else b for w, b in begin.items()}
    return t.select(*contacts.columns, *[v.alias(w) for w, v in new.items()], F.lit(n).alias("rounds"))


def called_phases(imputed: DataFrame, least: float = 0.75) -> DataFrame:
    """Append ``called1`` and ``called2``: the phases of the likeliest way, or ``.`` for both if it is below ``least``; of equals the first."""
    best = F.greatest(*WAYS)
    way = F.coalesce(*[F.when(F.col(w) == best, F.lit(w)) for w in WAYS])
    leg = lambda k: F.when(best >= least, F.substring(way, k + 1, 1)).otherwise(".")
    return imputed.withColumn("called1", leg(1)).withColumn("called2", leg(2))
