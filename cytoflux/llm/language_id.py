"""Language identification by nearest centroids with distance-based rejection.

A text becomes a TF-IDF vector of hashed character 1- to 3-grams inside words, normalised to
length 1.  Each language has several centroids, found by spherical k-means.  A text gets the
language of the centroid with the greatest cosine, and is rejected where that cosine is far
below all that the language's own training texts of like size show.
"""

from __future__ import annotations

import unicodedata
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import hash_share, id_class, rows_where, slices, table, with_columns_from

DIMENSIONS, CENTROIDS, ROUNDS, BLOCK = 4096, 4, 8, 256
#: Labelled texts per language that centroids are fitted to; document frequencies use all.
SAMPLE = 1500
#: Texts are rejected under this share of a low quantile of the cosines seen in training, by size class; cosines are counted in so many bins.
SLACK, SIZE_CLASSES, TAIL, COSINE_BINS = 0.6, 12, 0.001, 2000
#: Size classes with fewer training texts are judged together with their neighbours.
THIN = 20
UNKNOWN = "und"
OUTPUTS = {"lang_pred": "string", "score": "double", "rejected": "boolean"}

_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    if not _LETTERS:
        _LETTERS.append(np.array([unicodedata.category(chr(i))[0] == "L" for i in range(0x110000)]))
    return _LETTERS[0]


def gram_counts(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Counts of hashed n-grams, a row per text, and whether a text has a letter."""
    letters = _letters()
    parts, sizes = [], []
    for t in texts:
        codes = np.frombuffer((t or "").lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        parts += [np.zeros(1, np.uint32), codes, np.zeros(1, np.uint32)]
        sizes.append(len(codes) + 2)
    codes = np.concatenate(parts)
    codes = np.where(letters[codes], codes, 0).astype(np.uint32)
    row = np.repeat(np.arange(len(texts), dtype=np.int64), sizes)
    keep = codes > 0
    keep[1:] |= codes[:-1] > 0
    codes, row = codes[keep], row[keep]
    some = np.bincount(row[codes > 0], minlength=len(texts)) > 0
    if len(codes):
        codes, row = np.concatenate([np.zeros(1, np.uint32), codes]), np.concatenate([row[:1], row])
    found = []
    for n in (1, 2, 3):
        if len(codes) < n:
            continue
        gram = [codes[k : len(codes) - n + 1 + k] for k in range(n)]
        h = np.full(len(gram[0]), n, np.uint32)
        for g in gram:
            h = (h ^ g) * np.uint32(0x9E3779B1)
            h ^= h >> np.uint32(15)
        whole = gram[0] > 0 if n == 1 else (gram[0] > 0) | (gram[1] > 0) if n == 2 else gram[1] > 0
        at = row[n - 1 :].copy() if n < 3 else row[1:-1]
        if n == 2:
            at = np.where(gram[1] > 0, row[1:], row[:-1])
        if n == 3:
            whole &= (gram[0] > 0) | (gram[2] > 0)
        found.append((at * DIMENSIONS + (h % np.uint32(DIMENSIONS)))[whole])
    flat = np.concatenate(found) if found else np.zeros(0, np.int64)
    return np.bincount(flat, minlength=len(texts) * DIMENSIONS).reshape(len(texts), DIMENSIONS), some


def vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(counts.astype(np.float32)) * idf
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def _size_class(counts: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(1 + (counts > 0).sum(axis=1)).astype(int), SIZE_CLASSES - 1)


def _frequencies(batches):
    """Per task: in how many texts each n-gram is; under -1 the number of texts."""
    total, n = np.zeros(DIMENSIONS, np.int64), 0
    for batch in batches:
        for start, stop in slices(batch.column(0), 1 << 20):
            texts = batch.column(0).slice(start, stop - start).to_pylist()
            for i in range(0, len(texts), BLOCK):
                counts, _ = gram_counts(texts[i : i + BLOCK])
                total += (counts > 0).sum(axis=0)
                n += len(counts)
    if n:
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, DIMENSIONS)), pa.array(np.concatenate([[n], total]))], names=["gram", "n"])


def _fit_language(idf: np.ndarray):
    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("order")
        counts = np.concatenate([gram_counts(rows["text"].tolist()[i : i + BLOCK])[0].astype(np.float32) for i in range(0, len(rows), BLOCK)])
        x = vectors(counts, idf)
        k = min(CENTROIDS, len(x))
        chosen = [0]
        while len(chosen) < k:  # the text farthest from the chosen ones comes next
            chosen.append(int(np.argmin((x @ x[chosen].T).max(axis=1))))
        c = x[chosen]
        for _ in range(ROUNDS):
            near = np.argmax(x @ c.T, axis=1)
            c = np.stack([x[near == j].sum(axis=0) if (near == j).any() else c[j] for j in range(k)])
            c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-9)
        return pd.DataFrame({"lang": rows["lang"].iloc[0], "centroids": [c.astype(np.float32).tobytes()]})

    return fit


def _cosine_counts(shared):
    """Per task: of each language and size class, how many training texts with a letter have a cosine with the language's centroids in each bin."""

    def run(batches):
        m = shared.value
        at = {lang: i for i, lang in enumerate(m["langs"])}
        seen = np.zeros((len(at), SIZE_CLASSES, COSINE_BINS), np.int64)
        for batch in batches:
            for start, stop in slices(batch.column(1), 1 << 20):
                part = batch.slice(start, stop - start)
                langs, texts = part.column(0).to_pylist(), part.column(1).to_pylist()
                for i in range(0, len(texts), BLOCK):
                    counts, some = gram_counts(texts[i : i + BLOCK])
                    own = np.array([at.get(x, -1) for x in langs[i : i + BLOCK]])
                    cos = vectors(counts, m["idf"]) @ m["centroids"].T
                    best = np.where(m["owner"] == own[:, None], cos, -1).max(axis=1)
                    ok = some & (own >= 0)
                    place = np.clip((best[ok] * COSINE_BINS).astype(np.int64), 0, COSINE_BINS - 1)
                    np.add.at(seen, (own[ok], _size_class(counts)[ok], place), 1)
        i, s, b = np.nonzero(seen)
        if len(i):
            yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(s), pa.array(b), pa.array(seen[i, s, b])], names=["lang", "size", "bin", "n"])

    return run


def _low(seen: np.ndarray) -> float:
    """The cosine that the share ``TAIL`` of texts, by bins, lies below; the least of fewer texts than would make one."""
    total = np.cumsum(seen)
    return int(np.searchsorted(total, TAIL * total[-1], side="right")) / COSINE_BINS


def floors(seen: np.ndarray) -> np.ndarray:
    """The rejection floor of each (language, size class) from training texts counted by bins of their cosine.

    It follows a low quantile, so it neither sinks with the number of texts nor hangs on a few odd ones.
    From the longest class down, classes are pooled until ``THIN`` texts are together; a rest at the short end joins the last
    pool.  An unseen class takes the floor of the next shorter one; classes shorter than any seen lose a factor of the square root
    of 2 a class, as cosines of so few n-grams do.  No class has a higher floor than a longer one.  A language with fewer than ``THIN`` texts takes the
    least floor of the others, or 0.
    """
    n = seen.sum(axis=2)
    found = np.zeros(n.shape)
    judged = n.sum(axis=1) >= THIN
    for i in np.flatnonzero(judged):
        classes = np.flatnonzero(n[i])[::-1]
        pools, open_ = [], []
        for s in classes:
            open_.append(s)
            if n[i, open_].sum() >= THIN:
                pools.append(open_)
                open_ = []
        pools[-1] = pools[-1] + open_
        row = np.full(SIZE_CLASSES, np.nan)
        for pool in pools:
            row[min(pool) : max(pool) + 1] = SLACK * _low(seen[i, pool].sum(axis=0))
        for k in range(classes[-1] + 1, SIZE_CLASSES):
            row[k] = row[k - 1] if np.isnan(row[k]) else row[k]
        row[classes[-1] :] = np.minimum.accumulate(row[classes[-1] :][::-1])[::-1]
        for k in range(classes[-1] - 1, -1, -1):
            row[k] = row[k + 1] * 0.5**0.5
        found[i] = np.maximum(row, 0)
    if judged.any():
        found[~judged] = found[judged].min(axis=0)
    return found


def fit(docs: DataFrame, training: Column, sample: int = SAMPLE) -> dict:
    """Learn from the rows where ``training`` holds and text and ``lang`` are there.

    Document frequencies and rejection floors come from all these rows; centroids from about ``sample`` rows
    of each language, chosen by a hash of id and text.
    """
    rows = docs.where(training & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "lang", "text")
    known = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not known:
        return {"langs": [], "idf": np.ones(DIMENSIONS, np.float32)}
    grams = rows.select("text").mapInArrow(_frequencies, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    df = {r["gram"]: r["n"] for r in grams.collect()}
    idf = np.array([np.log((1 + df[-1]) / (1 + df.get(g, 0))) + 1 for g in range(DIMENSIONS)], dtype=np.float32)
    wanted = reduce(lambda a, b: a | b, [(F.col("lang") == k) & hash_share(F.col("order"), sample, n) for k, n in sorted(known.items())])
    chosen = rows.withColumn("order", F.xxhash64("doc_id", F.md5(F.col("text").cast("binary")))).where(wanted)
    chosen = chosen.groupBy("lang", "order").agg(F.first("text").alias("text"))  # rows that repeat id and text count once
    models = chosen.groupBy("lang").applyInPandas(_fit_language(idf), "lang string, centroids binary").collect()
    models = sorted(models, key=lambda r: r["lang"])
    c = [np.frombuffer(bytes(r["centroids"]), np.float32).reshape(-1, DIMENSIONS) for r in models]
    model = {
        "langs": [r["lang"] for r in models],
        "idf": idf,
        "centroids": np.concatenate(c) if c else np.zeros((0, DIMENSIONS), np.float32),
        "owner": np.repeat(np.arange(len(c)), [len(x) for x in c]),
    }
    seen = np.zeros((len(c), SIZE_CLASSES, COSINE_BINS), np.int64)
    if c:
        shared = docs.sparkSession.sparkContext.broadcast(model)
        parts = rows.select("lang", "text").mapInArrow(_cosine_counts(shared), "lang long, size long, bin long, n long")
        for r in parts.groupBy("lang", "size", "bin").agg(F.sum("n").alias("n")).collect():  # a row per language, size class and bin
            seen[r["lang"], r["size"], r["bin"]] = r["n"]
    return {**model, "floor": floors(seen)}


def predict(docs: DataFrame, model: dict, text: str = "text") -> DataFrame:
    """Append ``lang_pred``, ``score`` (the cosine, 0 to 1) and ``rejected``.

    A null text, or one without a letter, is ``und`` with score 0 and rejected.  Under a model without
    languages all others are ``und`` with score 0 too, but kept.  Rows are independent; an input column named as an output is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        m = shared.value

        def compute(column: pa.Array):
            texts = column.to_pylist()
            langs, scores, rejected = [], [], []
            for i in range(0, len(texts), BLOCK):
                counts, some = gram_counts(texts[i : i + BLOCK])
                known = some & bool(m["langs"])
                if not m["langs"]:
                    best, near = np.zeros(len(some)), np.zeros(len(some), int)
                    floor = best
                else:
                    cos = vectors(counts, m["idf"]) @ m["centroids"].T
                    at = np.argmax(cos, axis=1)
                    best, near = np.clip(cos[np.arange(len(at)), at], 0, 1), m["owner"][at]
                    floor = m["floor"][near, _size_class(counts)]
                langs += [m["langs"][k] if ok else UNKNOWN for k, ok in zip(near, known, strict=True)]
                scores += np.where(some, best, 0.0).astype(float).tolist()
                rejected += (~some | (best < floor)).tolist()
            return langs, scores, rejected

        return compute

    return with_columns_from(docs, [text], OUTPUTS, make)


def known_language(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose language is not rejected by a model of all their labelled rows; the columns of ``docs``."""
    model = fit(docs, F.lit(True))
    return rows_where(docs, list(OUTPUTS), lambda d: predict(d, model), ~F.col("rejected"))


def op1_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    held_out = id_class(F.col("doc_id"), 3) == 1
    model = fit(docs, ~held_out)
    return predict(docs.select("doc_id", "text"), model).select("doc_id", held_out.alias("held_out"), *OUTPUTS)
