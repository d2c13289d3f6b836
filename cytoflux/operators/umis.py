"""Networks of UMIs one base apart, found by pieces of a sorted table."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .graph import join_roots

#: Bytes of UMIs (and four for each) that a task compares at once.
PIECE = 1 << 23


def _numbers(t: pa.Table, keys: list[str]) -> tuple[np.ndarray, int]:
    """A number for each row's keys, equal for equal keys only, and a bound of the numbers."""
    n, most = np.zeros(t.num_rows, np.int64), 1
    for k in keys:
        c = t[k].combine_chunks()
        if pa.types.is_nested(c.type):
            c = pa.array(map(repr, c.to_pylist()), pa.string())
        c = pc.dictionary_encode(c, null_encoding="encode")
        n, most = n * max(1, len(c.dictionary)) + c.indices.to_numpy(), most * max(1, len(c.dictionary))
        if most > 1 << 31:
            found, n = np.unique(n, return_inverse=True)
            most = len(found)
    return n, most


def _pieces(batches: Iterator[pa.RecordBatch], keys: list[str], piece: int) -> Iterator[tuple[pa.Table, bool, bool, bool]]:
    """Whole blocks (runs of ``block``) up to about ``piece`` bytes, cut between groups of ``keys`` where they can be.

    With each come whether its first and its last group are known to be whole on that side, and whether it is part of a block that is too large to be held.
    """
    held, size, whole, large = [], 0, False, None
    for batch in batches:
        if large is not None:
            k = int(np.argmax(np.append(batch.column("block").to_numpy() != large, True)))
            if k:
                yield pa.Table.from_batches([batch[:k]]), False, False, True
            batch, large = batch[k:], large if k == batch.num_rows else None
        held.append(batch)
        size += (pc.sum(pc.binary_length(batch.column("umi"))).as_py() or 0) + 4 * batch.num_rows
        if size < piece:
            continue
        t = pa.Table.from_batches(held).combine_chunks()
        block, group = t["block"].to_numpy(), _numbers(t, keys)[0]
        cuts, borders = np.flatnonzero(block[1:] != block[:-1]) + 1, np.flatnonzero(group[1:] != group[:-1]) + 1
        cut = int(borders[-1] if len(borders) else cuts[-1] if len(cuts) else 0)
        if cut:
            yield t[:cut], whole, len(borders) > 0, False
            held, whole = t[cut:].to_batches(), len(borders) > 0
            size = (pc.sum(pc.binary_length(t["umi"][cut:])).as_py() or 0) + 4 * (t.num_rows - cut)
        else:
            yield t, False, False, True
            held, size, whole, large = [], 0, False, block[0]
    if any(b.num_rows for b in held):
        yield pa.Table.from_batches(held).combine_chunks(), whole, False, False


def _characters(umis: pa.StringArray, length: int) -> tuple[np.ndarray, int]:
    """A row of small numbers for each text of ``length`` characters, and how many numbers there are."""
    ends = np.frombuffer(umis.buffers()[1], np.int32)[umis.offset : umis.offset + len(umis) + 1]
    if ends[-1] - ends[0] == len(umis) * length:
        found = np.frombuffer(umis.buffers()[2], np.uint8)[ends[0] : ends[-1]]
        there = np.bincount(found, minlength=256) > 0
        return (np.cumsum(there) - 1).astype(np.uint8)[found].reshape(-1, length), int(there.sum())
    kinds, found = np.unique(np.frombuffer("".join(umis.to_pylist()).encode("utf-32-le"), np.uint32), return_inverse=True)
    return found.reshape(-1, length), len(kinds)


def _masked(chars: np.ndarray, kinds: int, group: np.ndarray, groups: int, positions: int) -> Iterator[np.ndarray]:
    """For each of the first ``positions``, a number of each row that is equal for rows of a group that are equal elsewhere."""
    n, length = chars.shape
    width = max(1, (kinds - 1).bit_length())
    per = (62 - max(n, groups).bit_length()) // width
    words = [sum(chars[:, i].astype(np.int64) << width * (i - k) for i in range(k, min(k + per, length))) for k in range(0, length, per)]
    for k in range(0, positions, per):
        rest = group
        for w in (*words[: k // per], *words[k // per + 1 :]):
            rest = np.unique(rest << width * per | w, return_inverse=True)[1]
        rest = rest << width * per
        for i in range(k, min(k + per, positions)):
            yield rest | words[k // per] & ~(((1 << width) - 1) << width * (i - k))


def _meet(t: pa.Table, keys: list[str], member: np.ndarray, root: np.ndarray, share: int) -> np.ndarray:
    """Rows below a more frequent neighbour in the first ``1 / share`` of the bases; ``root`` joins the ``member`` numbers of neighbours of one read."""
    umis, reads = t["umi"].combine_chunks().cast(pa.string()), t["reads"].to_numpy()
    group, groups = _numbers(t, keys)
    below, lengths = np.zeros(t.num_rows, bool), pc.fill_null(pc.utf8_length(umis), 0).to_numpy()
    for length in np.unique(lengths[lengths >= share]).tolist():
        at = np.flatnonzero(lengths == length)
        if len(at) < 2:
            continue
        chars, kinds = _characters(umis if len(at) == len(umis) else umis.take(pa.array(at)), length)
        for mask in _masked(chars, kinds, group[at], groups, length // share):
            order = np.argsort(mask)
            mask = mask[order]
            same = np.concatenate([[False], mask[1:] == mask[:-1], [False]])
            met = same[1:] | same[:-1]
            if not met.any():
                continue
            rows, start = at[order[met]], np.flatnonzero(~same[:-1][met])
            n, place = reads[rows], np.repeat(np.arange(len(start)), np.diff(start, append=len(rows)))
            most = np.maximum.reduceat(n, start)[place]
            below[rows[(most > 1) & (most >= 2 * n - 1)]] = True  # the greatest of a place is never above itself
            rows, place = member[rows[n == 1]], place[n == 1]
            if len(rows):
                first = np.flatnonzero(np.diff(place, prepend=-1))
                join_roots(root, rows, np.repeat(rows[first], np.diff(first, append=len(rows))))
    return below


def _rows(schema: pa.Schema, t: pa.Table, keys: list[str], which: np.ndarray, **columns: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The keys of rows ``which`` with the given columns, null elsewhere."""
    t = t.select(keys).take(pa.array(which))
    full = [t[f.name] if f.name in keys else pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(len(which), f.type) for f in schema]
    yield from pa.table(full, [f.name for f in schema]).to_batches()


def _types(t: pa.Table, keys: list[str], **columns: pa.DataType) -> pa.Schema:
    return pa.schema([t.schema.field(k) for k in keys] + [pa.field(k, v) for k, v in columns.items()])


def within_pieces(keys: list[str], piece: int = PIECE) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """UMIs (u, umi, reads) in blocks by their first half, to clusters: ``n`` of them for a group, and for groups that may go on elsewhere the UMIs with their cluster ``u``.

    ``below``: it has a UMI that a more frequent one is above, and is not counted in ``n``.  ``side`` is 1 for UMIs of a block too large to be held, each a cluster of its own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, left, right, large in _pieces(batches, keys, piece):
            schema = _types(t, keys, u=pa.int64(), umi=pa.string(), reads=pa.int64(), below=pa.bool_(), side=pa.int32(), n=pa.int64())
            at = root = np.arange(t.num_rows)
            below = np.zeros(t.num_rows, bool)
            if not large:
                root = root.copy()
                below[root[_meet(t, keys, at, root, 1)]] = True
                below = below[root]
            found, first, group = np.unique(_numbers(t, keys)[0], return_index=True, return_inverse=True)
            yield from _rows(schema, t, keys, first, n=np.bincount(group, (root == at) & ~below, len(found)).astype(np.int64))
            lasting = np.zeros(len(found), bool)
            lasting[group[0]] |= not left
            lasting[group[-1]] |= not right
            # A UMI of one base has met all that it can.
            on = np.flatnonzero(lasting[group] & (pc.fill_null(pc.utf8_length(t["umi"]), 0).to_numpy() > 1) | large)
            if len(on):
                yield from _rows(schema, t, keys, on, u=t["u"].to_numpy()[root[on]], umi=t["umi"].combine_chunks().take(pa.array(on)), reads=t["reads"].to_numpy()[on], below=below[on], side=np.full(len(on), int(large), np.int32))

    return run


def between_pieces(keys: list[str], piece: int = PIECE) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows of ``within_pieces`` in blocks by their second half: clusters ``u`` that were counted and are below another (``below``) or tied to cluster ``root``.

    Rows of groups (``n``) pass, and so do those of a block that was too large (``side`` 1) or is so here (2).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, _, _, large in _pieces(batches, [], piece):
            schema = _types(t, keys, u=pa.int64(), root=pa.int64(), umi=pa.string(), reads=pa.int64(), below=pa.bool_(), side=pa.int32(), n=pa.int64())
            n, side = t["n"].combine_chunks(), pc.fill_null(t["side"], 0).to_numpy()
            yield from _rows(schema, t, keys, np.flatnonzero(n.is_valid().to_numpy(False)), n=n.drop_null())
            umi = np.flatnonzero(n.is_null().to_numpy(False))
            for s, rows in ((1, np.flatnonzero(side == 1)), (2, umi if large else umi[:0])):
                if len(rows):
                    some = t.take(pa.array(rows))
                    yield from _rows(schema, t, keys, rows, **{c: some[c].combine_chunks() for c in ("u", "umi", "reads", "below")}, side=np.full(len(rows), s, np.int32))
            if large or not len(umi):
                continue
            t = t.take(pa.array(umi)).combine_chunks()
            u, first, member = np.unique(t["u"].to_numpy(), return_index=True, return_inverse=True)
            known, root = t["below"].to_numpy()[first], np.arange(len(u))
            now = known.copy()
            now[member[_meet(t, keys, member, root, 2)]] = True
            # One that is below another takes its component with it, so only components that are free of it stay tied.
            below = np.zeros(len(u), bool)
            below[root[now]] = True
            below = below[root]
            tied = np.bincount(root, minlength=len(u))[root] > 1
            on = np.flatnonzero(~known & (below | tied))
            yield from _rows(schema, t, keys, first[on], u=u[on], root=np.where(below, u, u[root])[on], below=below[on])

    return run
