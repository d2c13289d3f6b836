"""A hidden Markov language model.

Counts of all training tokens go through one shuffle.  The most frequent tokens are symbols of their own; every other
token is emitted as the symbol of its class, one of ``CLASSES`` by hash, and then drawn from the class's tokens by add-one
counts, with one place for all tokens never seen.  So each state has a distribution over the whole vocabulary, tail included, and each
text a proper probability.  Baum-Welch runs over all training tokens of whole texts: tasks add up expected
counts of starts, moves and emissions, Spark sums them, and the driver, which holds only the model, normalises.  Scores
come from the scaled forward recursion in double precision.  Long texts are cut, for both, into pieces that are worked on side by side: a piece's
transfer matrix carries the forward vector into the next piece and the backward vector into the one before, which gives the same numbers
as one run over the whole text.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_class, slices, stored, table

#: Hidden states, rounds of Baum-Welch, symbols of frequent tokens and of classes, and tokens whose counts every task holds, of so many bytes each at most.
STATES, ROUNDS, SYMBOLS, CLASSES, LOOKUP, TOKEN_BYTES = 6, 4, 16_384, 16_384, 131_072, 256
#: Tokens of a piece, and pieces of one matrix.
PIECE, TOGETHER = 2048, 256
#: How much likelier than another state the same state follows at the start.
STAY = 16.0
#: Tokens that count as one emission of each state's unigram prior.
PRIOR = 10.0
HELD = 400_000
SLICE_BYTES = 4 << 20


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def _count(batches):
    seen: Counter = Counter()

    def rows():
        out = pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()).cast(pa.string()), pa.array(list(seen.values()), pa.int64())], names=["token", "c"])
        seen.clear()
        return out

    for batch in batches:
        for a, b in slices(batch.column(0), SLICE_BYTES):
            for text in batch.column(0).slice(a, b - a).to_pylist():
                seen.update(words_of(text))
            if len(seen) > HELD:
                yield rows()
    if seen:
        yield rows()


class _Numbers(dict):
    def __missing__(self, token: bytes) -> int:
        return -1


def _encoder(shared):
    """Symbols of each text, what its known tokens add to the sums, and the other tokens.

    A token outside the lookup adds here what does not depend on its count; the rest of its share follows when the counts are joined.
    """

    def run(batches):
        m = shared.value
        n_symbols, n_classes, n_known = m["symbols"], m["classes"], len(m["tokens"])
        number = _Numbers(zip(m["tokens"], range(n_known), strict=True))
        end = n_symbols + n_classes
        symbol_of = np.array([k if k < n_symbols else n_symbols + zlib.crc32(t) % n_classes for k, t in enumerate(m["tokens"])], np.int64)
        for batch in batches:
            names = batch.schema.names
            text = batch.column(names.index("text"))
            others = [k for k, n in enumerate(names) if n != "text"]
            for a, b in slices(text, SLICE_BYTES):
                words = [words_of(t) for t in text.slice(a, b - a).to_pylist()]
                sizes = np.array([len(w) for w in words], np.int64)
                flat = [w for ws in words for w in ws]
                ids = np.fromiter(map(number.__getitem__, flat), np.int64, len(flat))
                row = np.repeat(np.arange(len(words)), sizes)
                total = lambda x: np.bincount(row, weights=x, minlength=len(words)).astype(np.float64)  # noqa: E731, B023
                unknown = np.flatnonzero(ids < 0)
                symbol, base, rare = np.zeros(len(flat), np.int64), np.full(len(flat), -m["log_below"]), np.zeros(len(flat))
                known = ids >= 0
                symbol[known] = symbol_of[ids[known]]
                symbol[unknown] = [n_symbols + zlib.crc32(flat[i]) % n_classes for i in unknown]
                base[known] += m["log_count"][ids[known]]
                in_class = symbol >= n_symbols
                rare[in_class] = -m["log_class"][symbol[in_class] - n_symbols]
                rare[in_class & known] += m["log_count"][ids[in_class & known]]
                ends = np.cumsum(sizes)
                coded = [np.append(symbol[e - n : e], end).astype(m.get("code", "<u2")).tobytes() for e, n in zip(ends, sizes, strict=True)]
                tail = pa.array([flat[i] for i in unknown], pa.binary()).cast(pa.string())
                offsets = np.concatenate([[0], np.cumsum(np.bincount(row[unknown], minlength=len(words)))])
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(k).slice(a, b - a) for k in others], pa.array(sizes + 1), pa.array(total(known).astype(np.int64)), pa.array(total(base) + m["end_base"]), pa.array(total(rare)), pa.array(coded, pa.binary()), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), tail)],
                    names=[*[names[k] for k in others], "n_tokens", "known", "base", "rare", "symbols", "tail"],
                )

    return run


def _by_time(pieces: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pieces in decreasing length as a matrix over time, their lengths, and how many go on at each time."""
    n = np.array([len(p) for p in pieces])
    x = np.zeros((n[0], len(pieces)), np.int64)
    for k, p in enumerate(pieces):
        x[: len(p), k] = p
    return x, n, np.searchsorted(-n, -np.arange(n[0]), side="left")


def expected_counts(pieces: list[np.ndarray], before: np.ndarray, first: np.ndarray, after: np.ndarray, model: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expected starts, moves and emissions of pieces.

    ``first`` marks pieces that begin a text; the others go on from the forward vectors ``before``.  ``after`` has the backward vectors at their ends.
    """
    a, e = model["moves"], model["emissions"]
    order = np.argsort([-len(p) for p in pieces], kind="stable")
    pieces, before, first, after = [pieces[k] for k in order], before[order], first[order], after[order]
    x, n, live = _by_time(pieces)
    steps, many, s = len(x), len(pieces), len(a)
    alpha, scale, ones = np.zeros((steps, many, s)), np.ones((steps, many)), np.ones(s)
    for t in range(steps):
        k = live[t]
        v = np.where(first[:, None], model["start"], before @ a) if t == 0 else alpha[t - 1, :k] @ a
        v *= np.take(e, x[t, :k], axis=0)
        scale[t, :k] = v @ ones
        np.divide(v, scale[t, :k, None], out=alpha[t, :k])
    moves, back = np.zeros((s, s)), np.ascontiguousarray(a.T)
    beta = after / (alpha[n - 1, np.arange(many)] * after).sum(axis=1, keepdims=True)  # posteriors at the ends add up to 1
    for t in range(steps - 1, -1, -1):
        k = live[t]
        if t + 1 < steps:
            j = live[t + 1]
            seen = np.take(e, x[t + 1, :j], axis=0)
            seen *= beta[:j]
            seen /= scale[t + 1, :j, None]
            moves += alpha[t, :j].T @ seen
            np.matmul(seen, back, out=beta[:j])
        if t == 0:
            seen = e[x[0]] * beta / scale[0][:, None]
            moves += before[~first].T @ seen[~first]
        alpha[t, :k] *= beta[:k]  # now the state's posterior
    inside = np.arange(steps)[:, None] < n[None]
    symbol, weight = x[inside], alpha[inside]
    emissions = np.stack([np.bincount(symbol, weights=weight[:, k], minlength=len(e)) for k in range(s)], axis=1)
    return alpha[0][first].sum(axis=0), moves * a, emissions


def _forward(pieces: list[np.ndarray], v: np.ndarray, model: dict, started: bool) -> tuple[np.ndarray, np.ndarray]:
    """Scaled forward vectors after each piece and their log10 scales, from start vectors ``v``; pieces by decreasing length."""
    a, e = model["moves"], model["emissions"]
    x, _, live = _by_time(pieces)
    out, log, ones = v.copy(), np.zeros(len(pieces)), np.ones(len(a))
    for t in range(len(x)):
        k = live[t]
        w = np.take(e, x[t, :k], axis=0)
        w *= out[:k] if t == 0 and not started else out[:k] @ a
        z = w @ ones
        np.divide(w, z[:, None], out=out[:k])
        log[:k] += np.log10(z)
    return out, log


def _ends(texts: list[np.ndarray], model: dict, piece: int) -> tuple[list[list[np.ndarray]], list[list[np.ndarray]], np.ndarray]:
    """Per text: the forward vector after each piece, the transfer matrix of each later piece (up to a factor), and the log10 probability."""
    s, vectors, matrices, logs = len(model["moves"]), [[] for _ in texts], [[] for _ in texts], np.zeros(len(texts))
    order = sorted(range(len(texts)), key=lambda k: -min(len(texts[k]), piece))
    for a in range(0, len(order), TOGETHER):
        block = order[a : a + TOGETHER]
        v, log = _forward([texts[k][:piece] for k in block], np.tile(model["start"], (len(block), 1)), model, started=False)
        logs[block] = log
        for k, row in zip(block, v, strict=True):
            vectors[k].append(row)
    rest = [(k, texts[k][i : i + piece]) for k in range(len(texts)) for i in range(piece, len(texts[k]), piece)]
    most = max(1, TOGETHER // s)
    for a in range(0, len(rest), most):
        block = sorted(range(a, min(a + most, len(rest))), key=lambda q: -len(rest[q][1]))
        m, scale = _forward([rest[q][1] for q in block for _ in range(s)], np.tile(np.eye(s), (len(block), 1)), model, started=True)
        at = {q: i * s for i, q in enumerate(block)}
        for q in range(a, min(a + most, len(rest))):
            k, i = rest[q][0], at[q]
            top = scale[i : i + s].max()
            matrix = m[i : i + s] * 10.0 ** (scale[i : i + s] - top)[:, None]
            w = vectors[k][-1] @ matrix
            z = w.sum()
            vectors[k].append(w / z)
            matrices[k].append(matrix)
            logs[k] += top + np.log10(z)
    return vectors, matrices, logs


def log_likelihoods(texts: list[np.ndarray], model: dict, piece: int = PIECE) -> np.ndarray:
    """log10 of the model's probability of each symbol sequence; exact for any length."""
    return _ends(texts, model, piece)[2]


def text_counts(texts: list[np.ndarray], model: dict, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expected starts, moves and emissions of whole texts, each of any length."""
    s = len(model["moves"])
    start, moves, emissions = np.zeros(s), np.zeros((s, s)), np.zeros_like(model["emissions"])
    rows: list[tuple[np.ndarray, np.ndarray, bool, np.ndarray]] = [(t, np.ones(s), True, np.ones(s)) for t in texts if len(t) <= piece]
    long = [t for t in texts if len(t) > piece]
    vectors, matrices, _ = _ends(long, model, piece)
    for k, text in enumerate(long):
        after = np.ones(s)
        for p in range(len(vectors[k]) - 1, -1, -1):
            rows.append((text[p * piece : (p + 1) * piece], vectors[k][p - 1] if p else after, p == 0, after))
            if p:
                after = matrices[k][p - 1] @ after
                after = after / after.max()
    rows.sort(key=lambda r: -len(r[0]))  # like lengths go together
    for a in range(0, len(rows), TOGETHER):
        pieces, before, first, after = zip(*rows[a : a + TOGETHER], strict=True)
        x = expected_counts(list(pieces), np.stack(before), np.array(first), np.stack(after), model)
        start, moves, emissions = start + x[0], moves + x[1], emissions + x[2]
    return start, moves, emissions


def _expectation(shared, most: int = 1 << 19):
    """Sums of the task, over texts of about ``most`` tokens at a time."""

    def run(batches):
        m = shared.value
        s = len(m["moves"])
        start, moves, emissions = np.zeros(s), np.zeros((s, s)), np.zeros_like(m["emissions"])
        texts: list[np.ndarray] = []
        held = 0

        def flush():
            nonlocal start, moves, emissions, held
            x = text_counts(texts, m)
            start, moves, emissions = start + x[0], moves + x[1], emissions + x[2]
            texts.clear()
            held = 0

        for batch in batches:
            for raw in batch.column(0).to_pylist():
                texts.append(np.frombuffer(raw, shared.value.get("code", "<u2")))
                held += len(texts[-1])
                if held >= most:
                    flush()
        if texts:
            flush()
        some = np.flatnonzero(emissions.any(axis=1))
        key = np.concatenate([[-1], -2 - np.arange(s), some])
        value = np.concatenate([start[None], moves, emissions[some]])
        yield pa.RecordBatch.from_arrays([pa.array(key.astype(np.int64)), *[pa.array(value[:, k]) for k in range(s)]], names=["k", *[f"s{k}" for k in range(s)]])

    return run


def _scorer(shared):
    def run(batches):
        for batch in batches:
            names = batch.schema.names
            raw = batch.column(names.index("symbols")).to_pylist()
            found = [log_likelihoods([np.frombuffer(r, shared.value.get("code", "<u2")) for r in raw[i : i + 1024]], shared.value) for i in range(0, len(raw), 1024)]
            kept = [k for k, n in enumerate(names) if n != "symbols"]
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in kept], pa.array(np.concatenate(found) if found else [], pa.float64())], names=[*[names[k] for k in kept], "log"])

    return run


def first_model(counts: np.ndarray, states: int = STATES) -> dict:
    """A start around the unigram distribution: fixed random factors tell the states apart, and states tend to last."""
    rng = np.random.default_rng(11)
    unigram = (counts + 1.0) / (counts + 1.0).sum()
    e = unigram[:, None] * rng.exponential(1.0, (len(counts), states))
    moves = rng.uniform(0.5, 1.5, (states, states)) + STAY * states * np.eye(states)
    mean = np.full(states, 1 / states)
    return {"start": mean, "moves": moves / moves.sum(axis=1, keepdims=True), "emissions": e / e.sum(axis=0), "unigram": unigram}


def _renewed(model: dict, start: np.ndarray, moves: np.ndarray, emissions: np.ndarray) -> dict:
    e = emissions + PRIOR * model["unigram"][:, None]
    moves, start = moves + 1.0, start + 1.0
    return model | {"start": start / start.sum(), "moves": moves / moves.sum(axis=1, keepdims=True), "emissions": e / e.sum(axis=0)}


def baum_welch(coded: DataFrame, model: dict, rounds: int = ROUNDS) -> dict:
    """Train on the column ``symbols``; one pass over all rows a round."""
    spark, s = coded.sparkSession, len(model["moves"])
    schema = "k long, " + ", ".join(f"s{k} double" for k in range(s))
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(model)
        sums = coded.select("symbols").mapInArrow(_expectation(shared), schema).groupBy("k").agg(*[F.sum(f"s{k}").alias(f"s{k}") for k in range(s)])
        start, moves, emissions = np.zeros(s), np.zeros((s, s)), np.zeros_like(model["emissions"])
        for k, *value in sums.collect():  # a row per symbol and state of the model
            if k == -1:
                start[:] = value
            elif k < 0:
                moves[-2 - k] = value
            else:
                emissions[k] = value
        model = _renewed(model, start, moves, emissions)
    return model


def _filled(bins: list[tuple[int, int]], most: int) -> tuple[list[int], int | None, int]:
    """Of bins (key, number) in order: the keys that fit into ``most`` together, the first that does not, and what room is left."""
    room, whole = most, []
    for key, n in bins:
        if n > room:
            return whole, key, room
        whole.append(key)
        room -= n
    return whole, None, room


def most_frequent(counts: DataFrame, most: int, fine: int = 65_536) -> list:
    """The ``most`` most frequent tokens, nearly, by decreasing count; the driver gets no others.

    They are found on a histogram of the logarithms of counts, which has a few thousand bins at most, so nothing is sorted.  Of the bin at the bound, as
    many tokens come along as there is room for, in the order of ``fine`` classes by hash, whole classes only.
    """
    level, spread = F.floor(F.log2("c") * 64), F.pmod(F.xxhash64("token"), F.lit(fine))
    bins = sorted(((r["b"], r["n"]) for r in counts.groupBy(level.alias("b")).agg(F.count("*").alias("n")).collect()), reverse=True)
    whole, edge, room = _filled(bins, most)
    wanted = level > edge if edge is not None else F.lit(True)
    if edge is not None and room:
        parts = counts.where(level == edge).groupBy(spread.alias("h")).agg(F.count("*").alias("n"))
        some, stop, _ = _filled(sorted((r["h"], r["n"]) for r in parts.collect()), room)
        if some:
            wanted = wanted | ((level == edge) & (spread < stop))
    return sorted(counts.where(wanted).collect(), key=lambda r: (-r["c"], r["token"]))


def score(docs: DataFrame, held_out, rounds: int = ROUNDS, symbols: int = SYMBOLS, lookup: int = LOOKUP, classes: int = CLASSES) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from rows where ``held_out`` is false.  A null or empty text is the end token alone.  Repeated rows are scored one
    by one, a null id keeps its row, an empty table gives an empty result, other columns are not read.  Without a training row all scores
    come from tokens that were never seen.  Tokens of more than ``TOKEN_BYTES`` bytes are never in the lookup, which bounds its bytes; their counts are joined.
    """
    code = "<u2" if symbols + classes < 1 << 16 else "<u4"
    spark = docs.sparkSession
    rows = docs.select("doc_id", held_out.alias("held_out"), "text")
    training = rows.where("NOT held_out")
    counts = stored(training.select("text").mapInArrow(_count, "token string, c long").groupBy("token").agg(F.sum("c").alias("c")))
    ends = training.count()
    whole = counts.agg(F.sum("c"), F.count("*")).first()
    n, v = (whole[0] or 0) + ends, whole[1] + (1 if ends else 0)
    head = most_frequent(counts.where(F.octet_length("token") <= TOKEN_BYTES), lookup)
    c = np.array([r["c"] for r in head], dtype=np.float64)
    tokens = [r["token"].encode() for r in head]
    k = min(symbols, len(head))
    below = n + v + 1
    # Of each class: tokens in training, and different ones, without those that are symbols.
    kind = F.pmod(F.crc32(F.col("token").cast("binary")), F.lit(classes)).cast("int")
    in_class = np.zeros((classes, 2))
    for r in counts.groupBy(kind.alias("h")).agg(F.sum("c").alias("c"), F.count("*").alias("n")).collect():  # a row per class
        in_class[r["h"]] = r["c"], r["n"]
    for t, x in zip(tokens[:k], c[:k], strict=True):
        in_class[zlib.crc32(t) % classes] -= x, 1
    shared = {
        "tokens": tokens,
        "symbols": k,
        "classes": classes,
        "code": code,
        "log_count": np.log10(c + 1),
        "log_below": float(np.log10(below)),
        "log_class": np.log10(in_class.sum(axis=1) + 1),
        "end_base": float(np.log10((ends + 1) / below)),
    }
    schema = "doc_id long, held_out boolean, row long, n_tokens long, known long, base double, rare double, symbols binary, tail array<string>"
    numbered = rows.select(F.col("doc_id").cast("long").alias("doc_id"), "held_out", F.monotonically_increasing_id().alias("row"), "text")
    coded = stored(numbered.mapInArrow(_encoder(spark.sparkContext.broadcast(shared)), schema))

    seen = np.concatenate([c[:k], in_class[:, 0], [float(ends)]])
    model = baum_welch(coded.where("NOT held_out"), first_model(seen) | {"code": code}, rounds)

    tail = coded.select("row", F.explode("tail").alias("token")).join(counts, "token", "left")
    more = tail.groupBy("row").agg(F.sum(F.log10(F.coalesce("c", F.lit(0)) + 1.0)).alias("more"), F.count("c").alias("more_known"))
    scored = coded.select("row", "doc_id", "held_out", "n_tokens", "known", "base", "rare", "symbols")
    scored = scored.mapInArrow(_scorer(spark.sparkContext.broadcast(model)), "row long, doc_id long, held_out boolean, n_tokens long, known long, base double, rare double, log double")
    more_of_it = F.coalesce("more", F.lit(0.0))
    return scored.join(more, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("more_known", F.lit(0)) + (1 if ends else 0)).cast("long").alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + more_of_it).alias("base_score"),
        (F.col("log") + F.col("rare") + more_of_it).alias("score"),
    )


def op7_hmm_lm(spark, sf_dir):
    return score(table(spark, sf_dir, "documents"), id_class(F.col("doc_id"), 7) == 2)
