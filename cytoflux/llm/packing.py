"""Packing documents into sequences: dominance reduction, then best fit.

Only documents longer than a sequence are cut.  The instance is the histogram of piece
lengths, which has at most ``CAPACITY`` entries however many documents there are, so the
packing is planned on the histogram: Martello and Toth's reduction fixes sets of one to three
pieces that dominate all other sets with their largest piece, which loses no optimal packing;
what remains goes best fit in decreasing order, in bulk.  The plan says, for each length,
which ranks go where; ranks within a length come from counts of salted groups, so a length that a
third of all pieces share is numbered by many tasks.
"""

from __future__ import annotations

import json
import re
import unicodedata
import zlib
from array import array
from bisect import bisect_left, insort
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import kept, stored, table, unused, with_columns_from

CAPACITY, END_ID, SALTS = 4096, 1, 256
#: Blank-separated parts whose ids a worker keeps.
KEPT_PARTS = 400_000
PIECES = {"pieces": "array<long>", "crcs": "array<long>"}


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class PartIds:
    """Ids of blank-separated parts of a text, as bytes.

    A tokenizer that never looks across white space needs to see each part once only.  One that also
    ignores case and takes letters or digits apart from what follows sees a part in lower case, and a tail of
    punctuation marks on its own.  Both are read from the tokenizer's file (``cuts``); without the first, whole texts are encoded.
    """

    TAIL = b".,!#*$%&|\""

    def __init__(self, path: str) -> None:
        self.tokenizer = _tokenizer(path)
        self.at_blanks, self.at_marks = cuts(json.loads(self.tokenizer.to_str()))
        self.keep: dict[bytes, bytes] = {}

    def __call__(self, texts: list[str]) -> list[bytes]:
        if not self.at_blanks:
            return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        keep, tail_marks = self.keep, self.TAIL if self.at_marks else b""
        values, holes = [], []
        for x in texts:
            raw = x.encode()
            parts = (raw if b"<|" in raw or not self.at_marks else raw.lower()).split()
            found = list(map(keep.get, parts))
            values.append(found)
            if None in found:
                holes.append((found, [(i, parts[i]) for i, v in enumerate(found) if v is None]))
        new = {p for _, missing in holes for _, p in missing}
        cut, whole = {}, set()
        for p in new:
            head = p.rstrip(tail_marks) if tail_marks and p[-1] in tail_marks else p
            if len(head) < len(p) and head and (chr(head[-1]).isalnum() if head[-1] < 128 else _ends_in_letter(head.decode())):
                cut[p] = (head, p[len(head) :])
                whole.update(x for x in cut[p] if x not in keep)
            else:
                whole.add(p)
        order = list(whole)
        coded = self.tokenizer.encode_batch_fast([p.decode() for p in order], add_special_tokens=False)
        fresh = {p: array("I", e.ids).tobytes() for p, e in zip(order, coded, strict=True)}
        for p, (head, tail) in cut.items():
            fresh[p] = (fresh[head] if head in fresh else keep[head]) + (fresh[tail] if tail in fresh else keep[tail])
        for found, missing in holes:
            for i, p in missing:
                found[i] = fresh[p]
        if len(keep) < KEPT_PARTS:
            keep.update(fresh)
        return [b"".join(v) for v in values]


def _ends_in_letter(head: str) -> bool:
    """Is the last character a letter once it is normalised and in lower case?  Some letters become a letter and a mark, which joins the punctuation behind it."""
    return unicodedata.normalize("NFC", unicodedata.normalize("NFC", head).lower())[-1].isalpha()


def cuts(rules: dict) -> tuple[bool, bool]:
    """What a tokenizer's file lets us do with ASCII white space: encode parts alone, and parts in lower case with their tails apart.

    A part stands alone if all normalizers work character by character, and the splitting pattern drops white space and
    matches none.  Case and tails are free if letters are made lower case and the pattern takes runs of letters, single digits, and runs
    of neither.
    """
    steps = lambda x: x.get("normalizers") or x.get("pretokenizers") or [x] if x else []
    normal, split = steps(rules.get("normalizer")), steps(rules.get("pre_tokenizer"))
    pattern = next((x["pattern"].get("Regex", "") for x in split if x["type"] == "Split" and x["behavior"] == "Removed" and x["invert"]), "")
    harmless = all(x["type"] in ("NFC", "Lowercase") or (x["type"] == "Replace" and x["pattern"].get("Regex") == r"\s+") for x in normal)
    added = all(not t["lstrip"] and not t["rstrip"] and not t["normalized"] and t["content"].startswith("<|") for t in rules.get("added_tokens") or [])
    choices = pattern.split("|")
    alone = bool(pattern) and harmless and added and not rules.get("truncation") and not any(x.get("add_prefix_space") for x in split) and choices[-1] == r"[^\s\p{L}\p{N}]+" and all(re.fullmatch(r"'[a-z]+|\[\\p\{[LN]\}\]\+?", c) for c in choices[:-1])
    marks = alone and any(x["type"] == "Lowercase" for x in normal) and r"[\p{N}]" in choices and r"[\p{L}]+" in choices
    return alone, marks


def _tokenizer(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def part_ids(path: str) -> PartIds:
    """The parts of a worker process; a function of the module, so that tasks of a worker share them."""
    return kept(f"parts {path}", lambda: PartIds(path))


def _piece_maker(path: str, capacity: int, end_id: int):
    def make():
        ids_of = part_ids(path)
        end = array("I", [end_id]).tobytes()

        def compute(column: pa.Array):
            lengths, crcs = [], []
            for ids in ids_of([x or "" for x in column.to_pylist()]):
                ids += end
                cut = [ids[i : i + 4 * capacity] for i in range(0, len(ids), 4 * capacity)]
                lengths.append([len(c) // 4 for c in cut])
                crcs.append([zlib.crc32(c) for c in cut])
            return lengths, crcs

        return compute

    return make


def tokenized_pieces(docs: DataFrame, text: str = "text", path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece of each document: ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``."""
    found = with_columns_from(docs.select("doc_id", text), [text], PIECES, _piece_maker(path or model_path(), capacity, end_id))
    each = found.select("doc_id", F.posexplode(F.arrays_zip("pieces", "crcs")).alias("piece", "x"))
    return each.select("doc_id", F.col("piece").cast("int").alias("piece"), (F.col("piece") * capacity).cast("long").alias("start"), F.col("x.pieces").alias("length"), F.col("x.crcs").alias("ids_crc32"))


def reduce_instance(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[tuple[tuple[int, ...], int]], Counter]:
    """Dominance reduction of a histogram of lengths.

    For the largest length a, with rest r = capacity - a: nothing fits beside it, so it goes alone; or the
    largest partner b <= r fills the rest exactly or no two pieces fit beside it, so {a, b} dominates
    every other set with a; or two pieces at most fit and the best pair {b, c} consists of the two largest
    that can be there, so {a, b, c} dominates.  Such sets are fixed, in bulk; other lengths are left.
    Returns the fixed sets with their numbers, and the histogram that is left.
    """
    left = Counter({k: v for k, v in counts.items() if v > 0})
    sizes = sorted(left)
    fixed: list[tuple[tuple[int, ...], int]] = []

    def take(lengths: tuple[int, ...], times: int) -> None:
        fixed.append((lengths, times))
        for x in lengths:
            left[x] -= times
            if not left[x]:
                del left[x]
                sizes.pop(bisect_left(sizes, x))

    def largest(limit: int, without: Counter) -> int | None:
        at = bisect_left(sizes, limit + 1) - 1
        while at >= 0 and left[sizes[at]] <= without[sizes[at]]:
            at -= 1
        return sizes[at] if at >= 0 else None

    def smallest(n: int, without: Counter) -> list[int]:
        out: list[int] = []
        for x in sizes:
            out += [x] * min(n - len(out), left[x] - without[x])
            if len(out) == n:
                break
        return out

    for a in sorted(left, reverse=True):
        while left.get(a):
            room, own = capacity - a, Counter({a: 1})
            b = largest(room, own)
            if b is None:
                take((a,), left[a])
                continue
            two = smallest(2, own)
            if b == room or len(two) < 2 or sum(two) > room:
                take((a, b), left[a] // 2 if a == b else min(left[a], left[b]))
                continue
            three = smallest(3, own)
            if len(three) < 3 or sum(three) > room:
                # Of a pair that fits, the larger piece is at most b; the smaller one, at most half of the room, must be at most c.
                c = largest(room - b, Counter([a, b]))
                if c is not None and largest(room // 2, own) == c:
                    need = Counter([a, b, c])
                    take((a, b, c), min(left[x] // n for x, n in need.items()))
                    continue
            break
    return fixed, left


def best_fit(counts: Counter, capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Best fit in decreasing order on a histogram: groups of equal sequences are filled in bulk."""
    open_by_room: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    rooms: list[int] = []
    closed: list[tuple[tuple[int, ...], int]] = []

    def put(lengths: tuple[int, ...], times: int, room: int) -> None:
        if not times:
            return
        if not room:
            closed.append((lengths, times))
            return
        if room not in open_by_room:
            open_by_room[room] = []
            insort(rooms, room)
        open_by_room[room].append((lengths, times))

    for a in sorted(counts, reverse=True):
        n = counts[a]
        while n:
            at = bisect_left(rooms, a)
            if at < len(rooms):
                room = rooms[at]
                lengths, times = open_by_room[room].pop()
                if not open_by_room[room]:
                    del open_by_room[room]
                    rooms.pop(at)
            else:
                lengths, times, room = (), n, capacity
            each = min(room // a, n)
            full = min(times, n // each)
            if lengths:
                put(lengths, times - full, room)
            put(lengths + (a,) * each, full, room - each * a)
            n -= full * each
    for groups in open_by_room.values():
        closed += groups
    return closed


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> dict[int, np.ndarray]:
    """For each length a table of (first rank, first sequence, offset); ranks up to the next row's go to consecutive sequences."""
    fixed, left = reduce_instance(counts, capacity)
    used: Counter = Counter()
    rows: dict[int, list[tuple[int, int, int]]] = {}
    sequence = 0
    for lengths, times in [*fixed, *best_fit(left, capacity)]:
        offset = 0
        for x in lengths:
            rows.setdefault(x, []).append((used[x], sequence, offset))
            used[x] += times
            offset += x
        sequence += times
    return {k: np.array(v, dtype=np.int64) for k, v in rows.items()}


def pack(pieces: DataFrame, capacity: int = CAPACITY, salts: int = SALTS) -> DataFrame:
    """Append ``sequence_id`` and ``offset`` to pieces (with ``doc_id``, ``piece``, ``length`` and more).

    Pieces of a length are ranked in ``salts`` groups or more, so that a group stays small when one length holds a third of all pieces.

    Groups go by the number of a stored row, so null or repeated ids crowd no group.
    Null ids, repeated rows and equal pieces each get a place of their own; no piece, no sequence.  Input columns may have any
    names; ``sequence_id`` and ``offset`` of the input are replaced.
    """
    spark = pieces.sparkSession
    columns = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    row, group, place_in_length, earlier = (unused(pieces, c) for c in ("row", "salt", "rank", "before"))
    pieces = stored(pieces.select(*[F.col(f"`{c}`") for c in columns]).withColumn(row, F.monotonically_increasing_id()))
    salts = max(salts, pieces.count() // 200_000)
    salted = pieces.withColumn(group, F.pmod(F.xxhash64(row), F.lit(salts)).cast("int"))
    counts = stored(salted.groupBy("length", group).agg(F.count("*").alias("n")))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # an entry per length: capacity at most
    places = spark.sparkContext.broadcast(plan(histogram, capacity))
    before = counts.select("length", group, (F.sum("n").over(W.partitionBy("length").orderBy(group).rowsBetween(W.unboundedPreceding, -1))).alias(earlier))
    within = F.row_number().over(W.partitionBy("length", group).orderBy(row)) - 1
    ranked = salted.withColumn(place_in_length, within).join(before, ["length", group])
    ranked = ranked.withColumn(place_in_length, F.col(place_in_length) + F.coalesce(earlier, F.lit(0)))
    schema = ", ".join([f"`{c}` {pieces.schema[c].dataType.simpleString()}" for c in columns] + ["sequence_id long", "offset long"])

    def place(batches):
        for batch in batches:
            length, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("length", place_in_length))
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for x in np.unique(length):
                own = np.flatnonzero(length == x)
                t = places.value[int(x)]
                at = np.searchsorted(t[:, 0], rank[own], side="right") - 1
                sequence[own], offset[own] = t[at, 1] + rank[own] - t[at, 0], t[at, 2]
            yield pa.RecordBatch.from_arrays([*[batch.column(batch.schema.get_field_index(c)) for c in columns], pa.array(sequence), pa.array(offset)], names=[*columns, "sequence_id", "offset"])

    return ranked.select(*[F.col(f"`{c}`") for c in columns], place_in_length).mapInArrow(place, schema)


def pack_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Tokenize and pack whole documents; a null or empty text is one piece with the end id alone."""
    return pack(tokenized_pieces(docs, path=path))


def op10_best_fit_packing(spark, sf_dir):
    return pack_documents(table(spark, sf_dir, "documents"))
