"""Alignment of two tokenizers' tokens over the same bytes, by an event sweep.

Each token ends at a byte of its document.  The end events of both tokenizers, in blocks, are one table; they are dealt by document, sorted
by offset, and streamed through a machine that knows no more than the tokens since the last common end.  Where both end at once, a group closes, and
each A token of a group is linked with each B token of it.

How many documents hold a linked pair of ids is a property of the corpus.  Each document's distinct pairs are counted in two steps; the ``LOOKUP``
most frequent pairs are broadcast, and pairs beyond are joined.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import kept, slices, stored, table

#: End events in a row; tokens that the machine takes at a time; links that are held at a time.
BLOCK, SLICE, LINKS = 1 << 14, 1 << 20, 1 << 22
#: Groups with no more links than this are swept together, larger ones one by one.
SMALL = 4096
#: Parts of texts whose ids a worker keeps, and the longest that it keeps.
KEPT_PARTS, PART_CHARS = 250_000, 40
#: Pairs that are broadcast at most, 12 bytes each.
LOOKUP = 1_000_000
#: Pair counts that a task sums before it sends them.
GATHERED = 1 << 22
#: Bins of pair counts to an octave, for the lookup's bound.
BINS = 64

_EVENTS = "row long, doc_id long, side byte, start long, n int, ids binary"
_SWEPT = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary, times binary"
_PLACES = re.compile(r"(?<=\S) (?=\S)")


def model_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def _byte_letters() -> dict[str, int]:
    """The letter that a byte-level vocabulary writes for each byte: printable bytes as they are, the others from 256 on, in order."""
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Tokens:
    """Both tokenizers and the bytes of their tokens.

    A text is cut at single blanks between other characters: there neither tokenizer joins what stands left and right, so parts are encoded
    once and kept, and their ids put together.
    """

    def __init__(self, a: str, b: str) -> None:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b)
        letters = _byte_letters()
        vocabulary = self.a.get_vocab(with_added_tokens=False)
        self.a_bytes = [b""] * (max(self.a.get_vocab().values()) + 1)
        for token, i in vocabulary.items():
            self.a_bytes[i] = bytes(letters[c] for c in token)
        self.b_bytes = [b""] * self.b.get_piece_size()
        for i in range(len(self.b_bytes)):
            piece = self.b.id_to_piece(i)
            self.b_bytes[i] = bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else b"" if self.b.is_control(i) else piece.replace("▁", " ").encode()
        self.type = np.dtype("<u2" if max(len(self.a_bytes), len(self.b_bytes)) <= 1 << 16 else "<u4")
        self.lengths = [np.array([len(x) for x in v], np.int64) for v in (self.a_bytes, self.b_bytes)]
        # What stands for a token in the digest: followed by another of its side in the group, or the last of it.
        self.shown = [f"{i}{end}".encode() for v, ends in ((self.a_bytes, ",|"), (self.b_bytes, ",;")) for i in range(len(v)) for end in ends]
        self.keep: dict[str, tuple[bytes, bytes] | None] = {}

    def encode_all(self, texts: list[str]) -> list[tuple[bytes, bytes] | None]:
        """The ids of each text under A (of a blank and the text) and B (of the text); None where there are none, or their bytes are not the text's."""
        split = [_PLACES.split(t) if t else [] for t in texts]
        keep = self.keep
        new = list(set().union(*split).difference(keep))
        if new:
            in_a = self.a.encode_batch_fast([f" {p}" for p in new], add_special_tokens=False)
            in_b = self.b.encode(new, num_threads=1)
            for p, x, y in zip(new, in_a, in_b, strict=True):
                x, raw = x.ids, f" {p}".encode()
                same = b"".join(map(self.a_bytes.__getitem__, x)) == raw == b"".join(map(self.b_bytes.__getitem__, y))
                keep[p] = (np.array(x, self.type).tobytes(), np.array(y, self.type).tobytes()) if same else None
        out = []
        for parts in split:
            found = [keep[p] for p in parts]
            if not found or None in found:
                out.append(None)
            else:
                out.append((b"".join([x[0] for x in found]), b"".join([x[1] for x in found])))
        for p in new if len(keep) > KEPT_PARTS else [p for p in new if len(p) > PART_CHARS]:
            del keep[p]
        return out


def tokens(paths: tuple[str, str]) -> Tokens:
    """The tokenizers of a worker process, built once."""
    return kept(f"alignment {paths}", lambda: Tokens(*paths))


def end_events(docs: DataFrame, text: str, paths: tuple[str, str]) -> DataFrame:
    """End events of both tokenizers in one table: ``row`` (a number for each row of ``docs``), doc_id, ``side`` (0 for A, 1 for B), and ``n`` tokens
    from byte ``start`` on, whose ids (compressed) tell where they end.  A row without tokens has one event of none."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokens(paths)
        width = t.type.itemsize
        for batch in batches:
            for start, stop in slices(batch.column(2), 1 << 20):
                part = batch.slice(start, stop - start)
                out: list[tuple] = []
                for row, doc_id, ids in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), t.encode_all([x or "" for x in part.column(2).to_pylist()]), strict=True):
                    if ids is None:
                        out.append((row, doc_id, 0, 0, 0, b""))
                        continue
                    for side, raw in enumerate(ids):
                        at = 0
                        for i in range(0, len(raw), BLOCK * width):
                            piece = raw[i : i + BLOCK * width]
                            out.append((row, doc_id, side, at, len(piece) // width, pa.compress(piece, "zstd", asbytes=True)))
                            if i + BLOCK * width < len(raw):
                                at += int(t.lengths[side][np.frombuffer(piece, t.type)].sum())
                columns = zip(*out, strict=True)
                types = [pa.int64(), pa.int64(), pa.int8(), pa.int64(), pa.int32(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, types, strict=True)], names=["row", "doc_id", "side", "start", "n", "ids"])

    return rows.mapInArrow(run, _EVENTS)


class Machine:
    """The sweep over sorted events.  Between calls it holds the tokens of one document since its last common end, and that document's sums."""

    def __init__(self, t: Tokens) -> None:
        self.t = t
        self.row = self.doc_id = None
        self.open: list[np.ndarray] = [np.zeros(0, np.int64)] * 4  # ids and ends of A, ids and ends of B
        self.done: list[tuple] = []
        self._begin(None, None)

    def _begin(self, row, doc_id) -> None:
        self.row, self.doc_id = row, doc_id
        self.sums = [0, 0, 0, 0]
        self.digest, self.begun = hashlib.sha256(), False
        self.pairs: list[np.ndarray] = []
        self.times: list[np.ndarray] = []

    def _end(self) -> None:
        if self.row is None:
            return
        if len(self.pairs) > 1:
            pairs, place = np.unique(np.concatenate(self.pairs), return_inverse=True)
            times = np.bincount(place, weights=np.concatenate(self.times)).astype(np.int64)
        else:
            pairs, times = (self.pairs[0], self.times[0]) if self.pairs else (np.zeros(0, np.int64),) * 2
        self.done.append((self.row, self.doc_id, *self.sums, self.digest.hexdigest() if self.sums[0] else "", packed(np.diff(pairs, prepend=0)), packed(times)))

    def take(self, rows: list[tuple]) -> None:
        """Event rows (row, doc_id, side, start, n, ids) in order; sums of documents that end among them go to ``done``."""
        docs = [(self.row, self.doc_id)] if self.row is not None else []
        places = {row: d for d, (row, _) in enumerate(docs)}
        parts: tuple[list, list] = ([], [])  # (document, ids, ends) of each side
        for side in (0, 1) if docs else ():
            parts[side].append((0, self.open[2 * side], self.open[2 * side + 1]))
        for row, doc_id, side, start, n, raw in rows:
            d = places.get(row)
            if d is None:
                d = places[row] = len(docs)
                docs.append((row, doc_id))
            if n:
                ids = np.frombuffer(pa.decompress(raw, n * self.t.type.itemsize, "zstd"), self.t.type).astype(np.int64)
                parts[side].append((d, ids, start + np.cumsum(self.t.lengths[side][ids])))
        flat = []
        for side in (0, 1):
            of = np.repeat([p[0] for p in parts[side]], [len(p[1]) for p in parts[side]]).astype(np.int64)
            flat.append((of, *(np.concatenate([p[k] for p in parts[side]]) if parts[side] else np.zeros(0, np.int64) for k in (1, 2))))
        (da, ia, ea), (db, ib, eb) = flat
        # One line of places for all documents: the first end of each lies behind the last end of the one before.
        low, high = np.full(len(docs), np.iinfo(np.int64).max), np.zeros(len(docs), np.int64)
        for of, _, e in flat:
            np.minimum.at(low, of, e)
            np.maximum.at(high, of, e)
        base = np.concatenate([[0], np.cumsum(np.maximum(high - low, 0) + 1)])
        pa_, pb_ = (base[of] + e - low[of] for of, e in ((da, ea), (db, eb)))
        mark = np.zeros(int(base[-1]) + 1, bool)
        mark[pa_] = True
        common = pb_[mark[pb_]]
        ga, gb = np.searchsorted(common, pa_), np.searchsorted(common, pb_)
        groups = len(common)
        doc_of = db[mark[pb_]]
        # What is open belongs to the last document and to no group.
        open_a, open_b = (np.flatnonzero((of == len(docs) - 1) & (g >= groups)) for of, g in ((da, ga), (db, gb)))
        self.open = [ia[open_a], ea[open_a], ib[open_b], eb[open_b]]
        a, b = slice(0, len(ia) - len(open_a)), slice(0, len(ib) - len(open_b))
        ia, ga, da, ib, gb, db = ia[a], ga[a], da[a], ib[b], gb[b], db[b]
        na, nb = np.bincount(ga, minlength=groups), np.bincount(gb, minlength=groups)
        n_docs = len(docs)
        sums = [np.bincount(da, minlength=n_docs), np.bincount(db, minlength=n_docs), np.bincount(doc_of, minlength=n_docs), np.bincount(doc_of, weights=na * nb, minlength=n_docs).astype(np.int64)]
        shown, cuts = self._shown(ia, ga, ib, gb, na, nb, doc_of, n_docs)
        pairs, times, starts = self._pairs(ia, ib, na, nb, doc_of, n_docs)
        for d, (row, doc_id) in enumerate(docs):
            if row != self.row:
                self._end()
                self._begin(row, doc_id)
            for k in range(4):
                self.sums[k] += int(sums[k][d])
            text = b"".join(map(self.t.shown.__getitem__, shown[cuts[d] : cuts[d + 1]]))
            if text:
                self.digest.update(b";" + text[:-1] if self.begun else text[:-1])
                self.begun = True
            if starts[d] < starts[d + 1]:
                self.pairs.append(pairs[starts[d] : starts[d + 1]])
                self.times.append(times[starts[d] : starts[d + 1]])

    def _shown(self, ia, ga, ib, gb, na, nb, doc_of, n_docs) -> tuple[list[int], np.ndarray]:
        """Places in ``Tokens.shown`` of all tokens, group by group, A before B; and where each document begins."""
        before_a, before_b = np.cumsum(na), np.cumsum(nb)
        out = np.empty(len(ia) + len(ib), np.int64)
        if len(out):
            at_a, at_b = np.arange(len(ia)), np.arange(len(ib))
            out[at_a + (before_b - nb)[ga]] = 2 * ia + (at_a + 1 == before_a[ga])
            out[at_b + before_a[gb]] = 2 * (len(self.t.a_bytes) + ib) + (at_b + 1 == before_b[gb])
        cuts = np.concatenate([[0], np.cumsum(np.bincount(doc_of, weights=na + nb, minlength=n_docs).astype(np.int64))])
        return out.tolist(), cuts

    def _pairs(self, ia, ib, na, nb, doc_of, n_docs) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct linked pairs of each document (a number for two ids), how often each is linked there, and where each document begins."""
        width = len(self.t.b_bytes)
        span = len(self.t.a_bytes) * width
        first_a, first_b, links = np.cumsum(na) - na, np.cumsum(nb) - nb, na * nb
        keys, times = [], []
        small = np.flatnonzero(links <= SMALL)
        total = np.cumsum(links[small])
        for g in np.split(small, np.searchsorted(total, np.arange(LINKS, total[-1], LINKS))) if len(small) else ():
            if not len(g):
                continue
            of = np.repeat(g, links[g])
            nth = np.arange(len(of)) - np.repeat(np.cumsum(links[g]) - links[g], links[g])
            q, r = np.divmod(nth, nb[of])
            k, n = np.unique(doc_of[of] * span + ia[first_a[of] + q] * width + ib[first_b[of] + r], return_counts=True)
            keys.append(k)
            times.append(n)
        for g in np.flatnonzero(links > SMALL):
            a, ta = np.unique(ia[first_a[g] : first_a[g] + na[g]], return_counts=True)
            b, tb = np.unique(ib[first_b[g] : first_b[g] + nb[g]], return_counts=True)
            step = max(LINKS // len(b), 1)
            for i in range(0, len(a), step):
                keys.append((doc_of[g] * span + a[i : i + step, None] * width + b[None, :]).ravel())
                times.append((ta[i : i + step, None] * tb[None, :]).ravel())
        if len(keys) == 1:
            key, n = keys[0], times[0]
        elif keys:
            key, place = np.unique(np.concatenate(keys), return_inverse=True)
            n = np.bincount(place, weights=np.concatenate(times)).astype(np.int64)
        else:
            key = n = np.zeros(0, np.int64)
        doc, pair = np.divmod(key, span)
        return pair, n, np.searchsorted(doc, np.arange(n_docs + 1))

    def swept(self) -> pa.RecordBatch:
        types = [*[pa.int64()] * 6, pa.string(), pa.binary(), pa.binary()]
        columns = list(zip(*self.done, strict=True)) if self.done else [()] * 9
        self.done = []
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, types, strict=True)], names=[x.split()[0] for x in _SWEPT.split(", ")])


def packed(numbers: np.ndarray) -> bytes:
    """Whole numbers below 2**32, compressed, with their number in front; read by ``unpacked``."""
    return len(numbers).to_bytes(4, "little") + (pa.compress(numbers.astype("<u4").tobytes(), "zstd", asbytes=True) if len(numbers) else b"")


def unpacked(raw: bytes) -> np.ndarray:
    n = int.from_bytes(raw[:4], "little")
    return np.frombuffer(pa.decompress(raw[4:], 4 * n, "zstd"), "<u4").astype(np.int64) if n else np.zeros(0, np.int64)


def sweep(events: DataFrame, paths: tuple[str, str]) -> DataFrame:
    """Sums of each document, the digest of its groups and its distinct linked pairs, as in ``_SWEPT``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Machine(tokens(paths))
        for batch in batches:
            sizes = np.cumsum(batch.column(4).to_numpy())
            at = 0
            while at < batch.num_rows:
                stop = max(int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + SLICE)), at + 1)
                part = batch.slice(at, stop - at)
                m.take(list(zip(*(c.to_pylist() for c in part.columns), strict=True)))
                at = stop
                yield m.swept()
        m._end()
        yield m.swept()

    return events.repartition("row").sortWithinPartitions("row", "start", "side").mapInArrow(run, _SWEPT)


def _pair_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packed pairs of documents to (pair, n), summed over a bounded number of them."""
    held, size = [], 0

    def out():
        pair, n = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(pair), pa.array(n)], names=["pair", "n"])

    for batch in batches:
        for raw in batch.column(0).to_pylist():
            held.append(np.cumsum(unpacked(raw)))
            size += len(held[-1])
            if size >= GATHERED:
                yield out()
                held, size = [], 0
    if size:
        yield out()


def frequent_pairs(counts: DataFrame, most: int = LOOKUP) -> tuple[np.ndarray, np.ndarray, bool]:
    """Pairs of the largest counts, sorted, with their counts, and whether these are all.

    The bound is found on a histogram of counts, so that no more than ``most`` rows leave their tasks.
    """
    bin_of = F.floor(F.log2("n") * BINS)
    sizes = {r["bin"]: r["rows"] for r in counts.groupBy(bin_of.alias("bin")).agg(F.count("*").alias("rows")).collect()}
    total, least = 0, 1 << 20  # above all bins
    for k in sorted(sizes, reverse=True):
        total += sizes[k]
        if total > most:
            break
        least = k
    chosen = counts.where(bin_of >= least).toArrow()
    pair, n = (chosen.column(c).to_numpy() for c in ("pair", "n"))
    order = np.argsort(pair)
    return pair[order], n[order], total <= most


def _scored(lookup: Broadcast, width: int):
    """Documents' packed pairs to sums over those that the lookup has, and the others as lists."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts, best = lookup.value
        for batch in batches:
            out = []
            for p, t in zip(batch.column(-2).to_pylist(), batch.column(-1).to_pylist(), strict=True):
                pair, times = np.cumsum(unpacked(p)), unpacked(t)
                at = np.minimum(np.searchsorted(known, pair), max(len(known) - 1, 0))
                there = known[at] == pair if len(known) else np.zeros(len(pair), bool)
                n, k = counts[at[there]], times[there]
                out.append((int((n * k).sum()), int(k[n == best[pair[there] // width]].sum()), pair[~there], times[~there]))
            cells = [pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64())]
            for j in (2, 3):
                ends = np.cumsum([0, *(len(x[j]) for x in out)])
                flat = np.concatenate([x[j] for x in out]) if out else np.zeros(0, np.int64)
                cells.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int64())))
            names = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "count_sum", "n_best", "rare", "times"]
            yield pa.RecordBatch.from_arrays([*batch.columns[:7], *cells], names=names)

    return run


def align(docs: DataFrame, text: str = "text", paths: tuple[str, str] | None = None, lookup: int = LOOKUP) -> DataFrame:
    """Per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256.

    A text that is null or empty, or whose tokens' bytes differ from a blank and the text under either tokenizer, has no tokens: zeros and an empty
    digest.  Each row is a document of its own, also where rows repeat or an id is null; other columns are not read; an empty table gives an empty
    result.  Links of equal counts are all best.
    """
    paths = paths or model_paths()
    spark = docs.sparkSession
    swept = stored(sweep(end_events(docs, text, paths), paths))
    here = Tokens(*paths)
    width = len(here.b_bytes)
    counts = stored(swept.where("n_links > 0").select("pairs").mapInArrow(_pair_counts, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")))
    best = np.zeros(len(here.a_bytes), np.int64)
    per_id = counts.groupBy(F.expr(f"pair div {width}").alias("a")).agg(F.max("n").alias("n")).toArrow()
    best[per_id.column("a").to_numpy()] = per_id.column("n").to_numpy()
    known, known_counts, all_there = frequent_pairs(counts, lookup)
    shared = spark.sparkContext.broadcast((known, known_counts, best))
    columns = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, count_sum long, n_best long, rare array<long>, times array<long>"
    scored = swept.mapInArrow(_scored(shared, width), columns)
    if not all_there:
        scored = stored(scored)
        rare = scored.where(F.size("rare") > 0).select("row", F.explode(F.arrays_zip("rare", "times")).alias("x")).select("row", F.col("x.rare").alias("pair"), F.col("x.times").alias("k"))
        highest = F.broadcast(spark.createDataFrame(per_id.rename_columns(["a", "highest"]).to_pandas()))  # a row per id of A
        tail = rare.join(counts, "pair").withColumn("a", F.expr(f"pair div {width}")).join(highest, "a")
        tail = tail.groupBy("row").agg(F.sum(F.col("n") * F.col("k")).alias("more"), F.sum(F.when(F.col("n") == F.col("highest"), F.col("k")).otherwise(0)).alias("more_best"))
        scored = scored.drop("rare", "times").join(tail, "row", "left")
        scored = scored.withColumn("count_sum", F.col("count_sum") + F.coalesce("more", F.lit(0))).withColumn("n_best", F.col("n_best") + F.coalesce("more_best", F.lit(0)))
    return scored.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op13_token_alignment(spark, sf_dir):
    return align(table(spark, sf_dir, "documents"))
